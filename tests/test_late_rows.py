"""Late rows are kept aside, corrections come out once a micro-batch."""

import random
from collections import Counter

from contrail.operators import silver as S
from contrail.schemas import SILVER
from contrail.streaming import late as LATE
from contrail.streaming.incremental import run_available
from helpers import silver_df, ts


def _row(icao, at, load, call="C", alt=900.0):
    return (icao, call, "FRANCE", ts(f"2024-01-01 {at}:00"), 1.5, 2.5, alt, 100.0, False,
            None if load is None else ts(f"2024-01-02 0{load}:00:00"))


def _arrive(spark, root, *rows):
    silver_df(spark, list(rows)).coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = spark.readStream.schema(SILVER).parquet(f"{root}/in")
    run_available(LATE.outcome_stream(stream, f"{root}/out", f"{root}/check", "1 hour"))


def test_kept_and_late_add_up(spark, scratch):
    before = spark.conf.get(LATE.PROVIDER, None)
    _arrive(spark, scratch, _row("a", "05:00", 1), _row("a", "05:00", 2), _row("b", "05:10", 1))
    _arrive(spark, scratch, _row("a", "05:00", 3), _row("a", "05:00", 0), _row("b", "05:10", 1), _row("c", "09:00", 1))
    _arrive(spark, scratch, _row("a", "05:00", 9), _row("d", "07:59", 1), _row("d", "08:00", 1), _row("c", "09:00", 5))
    got = LATE.read_outcomes(spark, f"{scratch}/out").collect()
    assert Counter(r.outcome for r in got) == {"first": 4, "correction": 2, "superseded": 3, "late": 2}
    late = LATE.late_rows(spark, f"{scratch}/out").collect()
    assert {(r.icao24, r.time_position) for r in late} == {("a", ts("2024-01-01 05:00:00")), ("d", ts("2024-01-01 07:59:00"))}
    kept = {(r.icao24, r.time_position.hour): r.ingested_at.hour for r in LATE.kept_silver(spark, f"{scratch}/out").collect()}
    assert kept == {("a", 5): 3, ("b", 5): 1, ("c", 9): 5, ("d", 8): 1}
    assert spark.conf.get(LATE.PROVIDER, None) == before


def test_newest_is_what_silver_calls_newest(spark, scratch):
    rng = random.Random(3)
    rows = [_row(rng.choice("ab"), "05:00", rng.choice((None, 1, 2)), rng.choice((None, "", "C", "É", "🛩")),
                 rng.choice((None, float("nan"), -0.5, 7.0))) for _ in range(60)]
    for k in range(0, 60, 20):
        _arrive(spark, scratch, *rows[k:k + 20])
    want = S.latest(silver_df(spark, rows))
    assert sorted(map(repr, LATE.kept_silver(spark, f"{scratch}/out").collect())) == sorted(map(repr, want.collect()))
    # no key's newest row comes out more than once a micro-batch
    counts = Counter((r.icao24, r.outcome) for r in LATE.read_outcomes(spark, f"{scratch}/out").collect())
    assert all(counts[key, "first"] == 1 and counts[key, "correction"] <= 2 for key in "ab") and sum(counts.values()) == 60


def test_no_rows(spark, scratch):
    spark.createDataFrame([], SILVER).write.parquet(f"{scratch}/in")
    stream = spark.readStream.schema(SILVER).parquet(f"{scratch}/in")
    run_available(LATE.outcome_stream(stream, f"{scratch}/out", f"{scratch}/check"))
    assert LATE.read_outcomes(spark, f"{scratch}/out").count() == 0


def test_a_replayed_batch_changes_nothing(spark, scratch):
    batches = [[_row("a", "05:00", 1), _row("b", "05:10", 1)], [_row("a", "05:00", 2), _row("c", "09:00", 1)], [_row("b", "05:10", 3)]]
    handle = LATE.outcome_batch(spark, f"{scratch}/out", "1 hour")
    for k, rows in enumerate(batches):
        handle(silver_df(spark, rows), k)
        first = sorted(map(repr, LATE.read_outcomes(spark, f"{scratch}/out").collect()))
        handle(silver_df(spark, rows), k)
        assert sorted(map(repr, LATE.read_outcomes(spark, f"{scratch}/out").collect())) == first
    assert Counter(r.outcome for r in LATE.read_outcomes(spark, f"{scratch}/out").collect()) == {"first": 3, "correction": 1, "late": 1}


def test_a_batch_is_one_shuffle_without_python_and_reads_live_days(spark, scratch):
    handle = LATE.outcome_batch(spark, f"{scratch}/out", "1 hour")
    for k, day in enumerate(("01", "02", "03")):
        handle(silver_df(spark, [_row("a", "05:00", 1)[:3] + (ts(f"2024-01-{day} 05:00:00"),) + _row("a", "05:00", 1)[4:]]), k)
    days = [f"day=2024-01-{d}" for d in ("02", "03")]
    stored = LATE._kept_before(spark, f"{scratch}/out", 3, days)
    assert stored.count() == 2 and LATE._kept_before(spark, f"{scratch}/out", 2, days).count() == 1
    assert LATE._watermark(spark, f"{scratch}/out", 3, "1 hour") == 1704254400 * 10**6       # 2024-01-03 04:00
    made = LATE.outcomes(stored, silver_df(spark, [_row("a", "05:00", 2)]), 0)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan
    assert [r.outcome for r in made.collect()] == ["first"]
