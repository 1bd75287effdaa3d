"""Near-duplicate documents by ProbMinHash, banding and verification.

A text is the multiset of its five-word shingles.  Every shingle is a Poisson
process whose rate is its count; each arrival falls into a random register,
and a register keeps the shingle that came first.  Arrivals are drawn round
by round and a process stops as soon as its next arrival is later than the
last first arrival of any register, so a text costs little more than its
shingles.  Registers of two texts agree with the probability Jaccard
similarity (for shingles that occur once: the plain Jaccard similarity).

Texts that share a band of registers are candidates, and a candidate pair is
linked if its exact probability Jaccard similarity is 0.8 or more.  Classes are
the connected components of the links.

* Equal texts are one node from the start, so copies are never compared.
* In a band bucket each node is first held against one pivot, the node with the
  most company over all bands.  Most buckets end there: all their nodes are in
  one class.
* In the other buckets the nodes outside the pivot's class are held against
  all nodes, in blocks of at most ``BLOCK`` texts a side, so a bucket of any
  size is spread over tasks; a pair that shares several bands is compared in
  the first of them only.  A block reports only links that join classes: never
  all pairs.

With 125 registers in 25 bands of 5, a pair of similarity 0.8 is a candidate
with probability 0.99995.

Defined cases: null texts are in a class of their own each (null class_id if
doc_id is null, too); empty texts and texts without words are linked to equal
texts only; a text of 1 to 4 words is one shingle; repeated rows have the
class of their text; the class id is the smallest doc_id of the class; an
empty table gives no rows; extra columns are kept by ``dedup`` and not read by
``classes``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm import textkernel as K
from contrail.plans.tables import materialize

BANDS, ROWS = 25, 5
SIMILARITY = 0.8
BLOCK = 512

_U = np.uint64


def signatures(doc: np.ndarray, h: np.ndarray, count: np.ndarray, n: int, k: int = BANDS * ROWS) -> np.ndarray:
    """n x k registers (0 where a text has no shingle).  (doc, h) distinct."""
    first = np.full(n * k, np.inf)
    who = np.zeros(n * k, _U)
    left, at, rate = np.arange(len(h)), np.zeros(len(h)), count.astype(float)
    base, turn = doc.astype(np.int64) * k, 0
    empty, last = np.full(n, k), np.full(n, np.inf)      # last first arrival: none while a register is empty
    while len(left):
        turn += 1
        r = K.mix(h[left] + _U(turn * 0x9E3779B97F4A7C15 % (1 << 64)))
        gap = -np.log(((r >> _U(11)).astype(float) + 0.5) * 2.0**-53)
        at[left] += gap / rate[left]
        # the register has the low 32 bits, which move the gap by 2**-32 at most
        register = base[left] + ((r & _U(0xFFFFFFFF)) * _U(k) >> _U(32)).astype(np.int64)
        t, of = at[left], doc[left]
        unseen = np.isinf(first[register])
        np.minimum.at(first, register, t)
        won = first[register] == t
        who[register[won]] = h[left][won]
        empty -= np.bincount(of[won & unseen], minlength=n)
        full = np.unique(of[won & (empty[of] == 0)])
        last[full] = first.reshape(n, k)[full].max(axis=1)
        left = left[t < last[of]]
    return who.reshape(n, k)


def band_keys(column, bands: int = BANDS, rows: int = ROWS) -> list[np.ndarray | None]:
    """One hash a band for each text; none for a text without words."""
    out: list = []
    for w in K.runs(column):
        doc, h, n = K.weighted(*K.shingles(w))
        sig = signatures(doc, h, n, w.n, bands * rows).reshape(w.n, bands, rows)
        key = np.zeros((w.n, bands), _U)
        for r in range(rows):
            key = K.mix(key * _U(0x9FB21C651E98DF25) + sig[:, :, r])
        key += np.arange(bands, dtype=_U) * _U(0xD6E8FEB86659FD93)
        inked = w.per_doc(doc) > 0
        out += [k.view(np.int64) if some else None for k, some in zip(key, inked)]
    return out


def probability_jaccard(h: np.ndarray, v: np.ndarray, g: np.ndarray, w: np.ndarray) -> float:
    """Exact similarity of two texts (ascending distinct shingles, counts)."""
    _, a, b = np.intersect1d(h, g, assume_unique=True, return_indices=True)
    if len(a) == 0:
        return 0.0
    if len(v) == v.sum() and len(w) == w.sum():
        return len(a) / (len(h) + len(g) - len(a))
    x, y = v[a].astype(float), w[b].astype(float)
    ratio = x / y
    order = np.argsort(ratio, kind="stable")
    low = np.concatenate([[0.0], np.cumsum(y[order])])          # w of smaller ratios
    high = np.concatenate([[0.0], np.cumsum(x[order])])         # v of smaller ratios
    below = np.searchsorted(ratio[order], ratio, side="right")
    only_v, only_w = v.sum() - x.sum(), w.sum() - y.sum()       # infinite and zero ratios
    total = (x.sum() - high[below] + only_v) / x + (low[below] + only_w) / y
    return float((1 / total).sum())


def _shingle_sets(texts) -> list[tuple[np.ndarray, np.ndarray]]:
    out: list = []
    for w in K.runs(texts):
        doc, h, n = K.weighted(*K.shingles(w))
        edge = np.searchsorted(doc, np.arange(w.n + 1))
        out += [(h[i:j], n[i:j]) for i, j in zip(edge[:-1], edge[1:])]
    return out


def similar_column(a: Column, b: Column) -> Column:
    @F.arrow_udf("double")
    def similar(left: pa.Array, right: pa.Array) -> pa.Array:
        return pa.array([probability_jaccard(*x, *y) for x, y in zip(_shingle_sets(left), _shingle_sets(right))],
                        pa.float64())

    return similar(a, b)


class _Union:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def block_links(sets, label, probe, similarity: float = SIMILARITY, keys: np.ndarray | None = None,
                band: int = 0) -> list[tuple[int, int]]:
    """Links that join different labels: every text of ``probe`` against all.
    With ``keys`` (a row of band keys a text), pairs that share a band before
    ``band`` are left to the bucket there."""
    ids: dict = {}
    union = _Union(len(sets))
    for i, x in enumerate(label):
        union.join(ids.setdefault(x, i), i)
    total = np.array([n.sum() for _, n in sets], float)
    flat = np.concatenate([h for h, _ in sets])
    size = np.array([len(h) for h, _ in sets])
    once = total == size                                 # no shingle repeats: the plain Jaccard similarity
    weight = np.concatenate([n for _, n in sets]).astype(float)
    owner = np.repeat(np.arange(len(sets)), size)
    order = np.argsort(flat, kind="stable")
    posted, weight_of = owner[order], weight[order]
    new = np.ones(len(flat), bool)
    new[1:] = flat[order][1:] != flat[order][:-1]
    starts = np.append(np.flatnonzero(new), len(flat))
    rank = np.empty(len(flat), np.int64)
    rank[order] = np.cumsum(new) - 1                     # posting list of each shingle
    begin = np.append(0, np.cumsum(size))
    root = np.array([union.find(i) for i in range(len(sets))])
    links = []
    for i in probe:
        open_ = root != root[i]
        if keys is not None and band:
            open_ &= ~(keys[:, :band] == keys[i, :band]).any(axis=1)
        if not open_.any():
            continue
        lists = rank[begin[i]:begin[i + 1]]
        n = starts[lists + 1] - starts[lists]
        at = np.repeat(starts[lists] - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
        if once[i] and once.all():
            shared = np.bincount(posted[at], minlength=len(sets))
            near = np.flatnonzero(open_ & (shared / (total[i] + total - shared) >= similarity))
            sure = np.ones(len(near), bool)
        else:
            # shared counts bound the similarity from above, in shares of either text
            mine = np.bincount(posted[at], np.repeat(weight[begin[i]:begin[i + 1]], n), len(sets)) / max(total[i], 1)
            theirs = np.bincount(posted[at], weight_of[at], len(sets)) / np.maximum(total, 1)
            near = np.flatnonzero(open_ & (mine >= similarity) & (theirs >= similarity))
            sure = np.zeros(len(near), bool)
            if once[i]:
                shared = np.bincount(posted[at], minlength=len(sets))[near]
                exact = shared / (total[i] + total[near] - shared) >= similarity
                near, sure = near[exact | ~once[near]], once[near][exact | ~once[near]]
        for j, known in zip(near.tolist(), sure.tolist()):
            if root[i] != root[j] and (known or probability_jaccard(*sets[i], *sets[j]) >= similarity):
                root[root == root[j]] = root[i]
                links.append((i, j))
    return links


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """node, label (smallest node of its component) of every linked node, by
    alternating large and small stars; each round is a written table."""
    edges = materialize(spark, links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .where("a <> b").distinct(), "edges")
    before = None
    while not edges.isEmpty():
        # large star: larger neighbours move to the smallest of a node's neighbourhood
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        # small star: a node's smaller neighbours (and itself) move to the smallest
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(
            F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        edges = materialize(spark, small.select("e.a", "e.b").where("a <> b").distinct(), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))


def _of_nodes(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, bands, text: joined by doc_id and text, so copies under other ids (a hot
    text) stay apart."""
    own = nodes.select("node", "bands", F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
    keyed = _keyed(docs)
    return keyed.join(own, (F.col("text_key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id"))) \
                .select("node", "bands", "text")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.md5("text").alias("text_key")).where("text IS NOT NULL")


def classes_by_text(spark: SparkSession, docs: DataFrame, bands: int = BANDS, rows: int = ROWS,
                    similarity: float = SIMILARITY, block: int = BLOCK) -> DataFrame:
    """text_key (MD5 of the text), doc_id (the text's smallest), label and
    class_id of its class, of every distinct text."""
    @F.arrow_udf("array<bigint>")
    def keys(texts: pa.Array) -> pa.Array:
        return pa.array(band_keys(texts, bands, rows), pa.list_(pa.int64()))

    own = _keyed(docs).select("text_key", "doc_id", keys("text").alias("bands"))
    nodes = materialize(spark, own.groupBy("text_key").agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"))
                        .withColumn("node", F.monotonically_increasing_id()), "nodes")
    spread = nodes.where("bands IS NOT NULL").select("node", F.posexplode("bands").alias("band", "key"))
    buckets = spread.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = materialize(spark, spread.join(buckets, ["band", "key"]).select("band", "key", "n", "node"), "shared")
    # the pivot has the most company over all its buckets: the middle of a family
    company = shared.groupBy("node").agg(F.sum("n").alias("company"))
    pivots = shared.select("band", "key", "node").join(company, "node").groupBy("band", "key").agg(
        F.max_by("node", F.struct("company", -F.col("node"))).alias("pivot"))
    members = materialize(spark, shared.join(pivots, ["band", "key"]), "members")
    # texts of nodes with company, one row each
    wanted = members.select("node").distinct().join(nodes.select("node", "bands", "doc_id", "text_key"), "node")
    texts = materialize(spark, _of_nodes(docs, wanted).dropDuplicates(["node"]), "texts")
    pairs = members.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    verified = pairs.join(right, "b").join(left, "a")
    links = materialize(spark, verified.select("a", "b", similar_column(F.col("text_a"), F.col("text_b")).alias("s"))
                        .where(F.col("s") >= similarity).select("a", "b"), "links")
    label = components(spark, links)
    # links between classes join labels: the second run sees only these
    top = components(spark, _rest(spark, members, label, texts, similarity, block)).select(
        F.col("node").alias("label"), F.col("label").alias("top"))
    named = nodes.join(label, "node", "left").select("text_key", "doc_id", F.coalesce("label", "node").alias("label")) \
                 .join(top, "label", "left").select("text_key", "doc_id", F.coalesce("top", "label").alias("label"))
    least = named.groupBy("label").agg(F.min("doc_id").alias("class_id"))
    return named.join(least, "label").select("text_key", "doc_id", "label", "class_id")


def _rest(spark: SparkSession, members: DataFrame, label: DataFrame, texts: DataFrame, similarity: float,
          block: int) -> DataFrame:
    """Links between classes (their labels) inside a bucket that the pivots did not
    find.  A pair is held against each other in the first band that it shares."""
    at = members.where("n > 2").join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    to_pivot = label.select(F.col("node").alias("pivot"), F.col("label").alias("pivot_label"))
    at = at.join(to_pivot, "pivot", "left").withColumn("pivot_label", F.coalesce("pivot_label", "pivot"))
    # outside: not in the pivot's class; these are held against everything but
    # the pivot, which needs two other nodes
    at = materialize(spark, at.select("band", "key", "node", "label", (F.col("label") != F.col("pivot_label")).alias("outside")),
                     "labelled")
    size = materialize(spark, at.groupBy("band", "key").agg(
        F.count_if("outside").alias("n_out"), F.count_if(~F.col("outside")).alias("n_in")).where("n_out > 0"), "sizes")
    at = at.join(size, ["band", "key"])
    outs, ins = F.ceil(F.col("n_out") / block).cast("int"), F.ceil(F.col("n_in") / block).cast("int")
    hash_ = F.xxhash64("node", "band")
    dealt = at.select("band", "key", "node", "label", "outside", outs.alias("outs"), ins.alias("ins"),
                      F.pmod(hash_, F.when(F.col("outside"), outs).otherwise(ins)).cast("int").alias("mine"))
    # a task is (block of outside nodes, another block): outside ones are 0 .. outs - 1, the others follow
    as_probe = F.transform(F.sequence(F.lit(0), F.col("outs") + F.col("ins") - 1),
                           lambda j: F.struct(F.least(F.col("mine"), F.when(j < F.col("outs"), j).otherwise(F.col("mine"))).alias("i"),
                                              F.greatest(j, F.when(j < F.col("outs"), F.col("mine")).otherwise(j)).alias("j")))
    as_other = F.transform(F.sequence(F.lit(0), F.col("outs") - 1),
                           lambda i: F.struct(i.alias("i"), (F.col("outs") + F.col("mine")).alias("j")))
    tasks = dealt.select("band", "key", "node", "label", "outside",
                         F.explode(F.when(F.col("outside"), as_probe).otherwise(as_other)).alias("t"))
    rows = tasks.select("band", "key", "node", "label", "outside", "t.i", "t.j").join(texts, "node")

    def inside(table: pa.Table) -> pa.Table:
        table = table.sort_by([("node", "ascending")])
        label, probe = table["label"].to_pylist(), np.flatnonzero(table["outside"].to_numpy(zero_copy_only=False)).tolist()
        found = []
        if probe and len(set(label)) > 1:
            keys = pa.concat_arrays(table["bands"].chunks).flatten().to_numpy().reshape(len(label), -1)
            found = block_links(_shingle_sets(table["text"]), label, probe, similarity, keys, table["band"][0].as_py())
        return pa.table({"a": pa.array([label[i] for i, _ in found], pa.int64()),
                         "b": pa.array([label[j] for _, j in found], pa.int64())})

    return materialize(spark, rows.groupBy("band", "key", "i", "j").applyInArrow(inside, "a long, b long").distinct(), "more")


def classes(spark: SparkSession, docs: DataFrame, **settings) -> DataFrame:
    """doc_id, class_id of every row."""
    named = classes_by_text(spark, docs, **settings).select("text_key", "class_id")
    rows = docs.select("doc_id", F.md5("text").alias("text_key"))
    return rows.join(named, "text_key", "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))


def dedup(spark: SparkSession, docs: DataFrame, **settings) -> DataFrame:
    """One row of each class: of the class's smallest doc_id; all columns."""
    named = classes_by_text(spark, docs, **settings)
    # of several texts with that doc_id the one with the smallest key
    best = materialize(spark, named.where(F.col("doc_id").eqNullSafe(F.col("class_id")))
                       .groupBy("label").agg(F.min("text_key").alias("keep_key"), F.min("doc_id").alias("keep_id"))
                       .drop("label"), "best")
    keyed = docs.select(F.struct("*").alias("row"), F.md5("text").alias("key"), F.col("doc_id").alias("id"))
    match = (F.col("key") == F.col("keep_key")) & F.col("id").eqNullSafe(F.col("keep_id"))
    kept = keyed.join(best, match)
    again = (docs.where("text IS NOT NULL").groupBy("doc_id", F.md5("text")).count().where("count > 1"))
    if not again.isEmpty():         # repeated rows: same doc_id and text
        kept = kept.dropDuplicates(["keep_key", "keep_id"])
    return kept.select("row.*").unionByName(docs.where("text IS NULL"))
