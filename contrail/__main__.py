"""Command line: ``python -m contrail run|stream ...`` (or spark-submit).

run     one batch pass: new landing JSON -> Bronze -> Silver -> Gold -> checks
stream  incremental pass over new landing files (availableNow), a load a
        micro-batch
"""

from __future__ import annotations

import argparse
import json

from contrail.session import cluster_conf, get_session


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="contrail")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run", help="batch pass over the new landing files")
    r.add_argument("--landing", required=True)
    r.add_argument("--warehouse", required=True)
    r.add_argument("--mode", choices=("upsert", "append"), default="upsert")
    r.add_argument("--multi-line", action="store_true",
                   help="landing files hold one JSON array each")
    r.add_argument("--force", action="store_true", help="load every file again, not only new and changed ones")
    r.add_argument("--days", nargs=2, metavar=("FIRST", "LAST"), help="only these date partitions (YYYY-MM-DD)")
    r.add_argument("--database", help="also keep Silver (bucketed), Gold and the country summary as tables of this database")
    s = sub.add_parser("stream", help="incremental pass over new landing files")
    s.add_argument("--landing", required=True)
    s.add_argument("--warehouse", required=True)
    s.add_argument("--max-files", type=int, default=1000)
    ap.add_argument("--master", default=None)
    ap.add_argument("--input-gb", type=float, default=None,
                    help="size of the landing data: sets partition sizes for a cluster")
    args = ap.parse_args(argv)

    extra = cluster_conf(int(args.input_gb * 2**30)) if args.input_gb else None
    spark = get_session(args.master, extra=extra)
    if args.cmd == "run":
        from contrail.plans.medallion import run
        res = run(spark, args.landing, args.warehouse, mode=args.mode, multi_line=args.multi_line, force=args.force,
                  days=tuple(args.days) if args.days else None, database=args.database)
        print(json.dumps({"silver_rows": res.silver_rows, "gold_rows": res.gold_rows}))
    else:
        from contrail.streaming import incremental as STR
        wh = args.warehouse.rstrip("/")
        q = STR.medallion_stream(spark, STR.bronze_stream(spark, args.landing, args.max_files), wh,
                                 f"{wh}/_stream_checkpoint")
        STR.run_available(q)
        print(json.dumps({"batches": q.lastProgress["batchId"] + 1 if q.lastProgress else 0}))


if __name__ == "__main__":
    main()
