"""Best-two-fit packing of documents into fixed-size sequences.

Only documents longer than a sequence are cut: full pieces fill a sequence
each, and the one shorter piece (the first) is packed with the shorter
documents.  Bins are filled greedily with the longest piece that still fits;
then the smallest piece of a bin of two or more is exchanged for the two
unpacked pieces that fill the widened gap best, if that is fuller.  (A piece
alone in its bin fits with no piece that waits, so it needs a bin of its own.)

Pieces are packed in groups of about ``GROUP`` / 4 sequences' tokens dealt out by
a hash of a row number, so no task holds more than a group whatever keys
repeat.  Each group can leave one bin under half full, its last.  The last bins
of all groups are packed together in a second round, again in such groups, so
one in about ``GROUP`` / 4 last bins can stay so.  Both rounds see lengths only;
the pieces are joined with their places once.

Defined cases: a null or empty text is the end id alone; repeated rows and
doc_ids are packed as often as they occur; an empty table gives no rows; extra
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm.tokens import token_ids
from contrail.plans.tables import materialize

SIZE = 1024
GROUP = 4096


def best_two_fit(lengths, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece."""
    lengths = np.asarray(lengths, dtype=np.int64)
    if len(lengths) and (lengths.min() < 1 or lengths.max() > size):
        raise ValueError(f"piece lengths must be 1 to {size}")
    waiting: dict[int, list[int]] = {}
    for i in np.argsort(-lengths, kind="stable")[::-1].tolist():
        waiting.setdefault(int(lengths[i]), []).append(i)
    there = 0                                   # bit n: a piece of length n waits
    for n in waiting:
        there |= 1 << n
    where, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)

    def fitting(gap: int) -> int:
        """Length of the longest waiting piece of at most ``gap``, else 0."""
        return (there & ((1 << (gap + 1)) - 1)).bit_length() - 1 if gap > 0 and there & ((1 << (gap + 1)) - 1) else 0

    def take(n: int) -> int:
        nonlocal there
        i = waiting[n].pop()
        if not waiting[n]:
            there &= ~(1 << n)
        return i

    def pair(gap: int, above: int) -> tuple[int, int]:
        """The two waiting lengths that fill ``gap`` best, over ``above``."""
        best, found = above, (0, 0)
        a = fitting(gap - 1)
        while 2 * a > best and a:
            b = fitting(min(a, gap - a))
            if b == a and len(waiting[a]) < 2:
                b = fitting(a - 1)
            if b and a + b > best:
                best, found = a + b, (a, b)
                if best == gap:
                    break
            a = fitting(a - 1)
        return found

    n_bins = 0
    while there:
        inside, gap = [], size
        while n := fitting(gap):
            inside.append(take(n))
            gap -= n
        if gap and len(inside) > 1:
            smallest = int(lengths[inside[-1]])     # filled in falling order
            a, b = pair(gap + smallest, smallest)
            if a:
                two = [take(a), take(b)]
                back = inside.pop()
                waiting[smallest].append(back)
                there |= 1 << smallest
                inside += two
        at = 0
        for i in inside:
            where[i], offset[i] = n_bins, at
            at += int(lengths[i])
        n_bins += 1
    return where, offset


def pieces(docs: DataFrame, path: str, end_id: int, size: int = SIZE) -> DataFrame:
    """doc_id, piece, start, length, ids (little-endian unsigned 32-bit)."""
    ids = docs.select("doc_id", token_ids(F.col("text"), path, end_id).alias("ids"))
    n = (F.length("ids") / 4).cast("int")
    short = F.pmod(n - 1, F.lit(size)) + 1             # length of the first piece
    cut = ids.select("doc_id", "ids", short.alias("short"),
                     F.explode(F.sequence(F.lit(0), ((n - short) / size).cast("int"))).alias("piece"))
    start = F.when(F.col("piece") == 0, 0).otherwise(F.col("short") + (F.col("piece") - 1) * size)
    length = F.when(F.col("piece") == 0, F.col("short")).otherwise(size)
    return cut.select("doc_id", "piece", start.cast("long").alias("start"), length.cast("long").alias("length"),
                      F.substring("ids", start * 4 + 1, length * 4).alias("ids"))


def pack(spark: SparkSession, docs: DataFrame, path: str, end_id: int, size: int = SIZE,
         group: int = GROUP) -> DataFrame:
    """``pieces`` with sequence_id and offset.  The pieces are written once to
    the shared folder: texts are encoded once, and a lost executor reads them
    again from there."""
    cut = materialize(spark, pieces(docs, path, end_id, size)
                      .withColumn("row", F.monotonically_increasing_id()), "pieces")
    full = cut.filter(F.col("length") == size)
    rest = cut.filter(F.col("length") < size)
    most = max(1, group * size // 4)                    # tokens of a group
    groups = _groups(rest, most)
    grp = F.pmod(F.xxhash64("row"), F.lit(groups))
    first = materialize(spark, rest.select("row", "length", grp.alias("grp")).groupBy("grp")
                        .applyInArrow(lambda t: _packed(t, size), PLACES), "places")
    places = first
    if groups > 1:
        last = first.filter("last")
        again = last.withColumn("grp", F.pmod(F.xxhash64("sequence_id"), F.lit(_groups(last, most))))
        again = again.groupBy("grp").applyInArrow(lambda t: _packed(t, size, groups), PLACES)
        places = first.filter("NOT last").unionByName(again)
    out = ["doc_id", "piece", "start", "length", "ids"]
    short = rest.join(places.select("row", "sequence_id", "offset"), "row").select(*out, "sequence_id", "offset")
    return full.select(*out, (-1 - F.col("row")).alias("sequence_id"),
                       F.lit(0).cast("long").alias("offset")).unionByName(short)


PLACES = "row long, length long, sequence_id long, offset long, last boolean"


def _groups(rows: DataFrame, most: int) -> int:
    return max(1, -(-(rows.agg(F.sum("length").alias("n")).first().n or 0) // most))


def _packed(table: pa.Table, size: int, base: int = 0) -> pa.Table:
    """``PLACES`` of a group (its number and ``base`` lead the sequence ids).
    Rows that have a place keep it unless the new packing needs fewer bins."""
    table = table.sort_by([("row", "ascending")])
    where, offset = best_two_fit(table["length"].to_numpy(), size)
    last = where == where.max(initial=-1)
    if "sequence_id" in table.column_names and len(where) and \
            where.max() + 1 >= len(np.unique(table["sequence_id"].to_numpy())):
        ids, offset = table["sequence_id"].to_numpy(), table["offset"].to_numpy()
    else:
        ids = where + ((int(table["grp"][0].as_py()) + base) << 32) if len(where) else where
    return pa.table({"row": table["row"].cast(pa.int64()), "length": table["length"].cast(pa.int64()),
                     "sequence_id": pa.array(ids, pa.int64()), "offset": pa.array(offset, pa.int64()),
                     "last": pa.array(last, pa.bool_())})
