"""The k best documents of every benchmark item, by branch-and-bound over
document FP-trees.

A term is a maximal run of ASCII letters, digits and characters beyond ASCII,
A-Z lower-cased.  With N documents that hold a term, L terms in them, n terms
in one document (repeats count) and df documents that hold the term:

    w     = floor(1000 * ln((2N + 2) / (2df + 1)))
    m     = 50 + (50 * n * N) div L
    score = sum over the item's terms of w * ((10**9 * tf) div (1000 * tf + 20 * m))

1. One pass over the texts writes each document's vector: n and, of the terms
   that any item has, the tf.  N, L and df are aggregates of that table; the
   texts are not read again.
2. A task takes its vectors in blocks.  In a block, terms are ordered by
   frequency, and vectors of the same terms, tf and m are one entry.  Sorted
   entries are a trie: a node is a range of entries that share a path; chains
   are one node, and subtrees of few entries are buckets.  The largest tf of each
   term and the smallest m below a node bound every score below it from above.
3. For each item the tree is walked depth first, best child first, and a child
   is left out if its bound is less than the item's k-th score so far (over all
   blocks of the task).
4. The tasks' k best per item are merged in two steps, by item and hash, then by
   item.

Terms are compared by 64-bit hashes of their bytes; two different terms agree
with probability about 2**-64.  Items are taken in loads of at most ``LOAD``
distinct terms (one load for usual benchmarks; each further load is a pass over
the texts), and the trees of a load in turns of at most ``TURN`` terms, so what a
task holds is bounded for benchmarks of any size.

Defined cases: a null, empty or term-free text counts nowhere and is no result;
an item without terms, or none of whose terms occurs, has no rows; repeated
rows are documents of their own; equal scores go by ascending doc_id, null
doc_ids last; every benchmark row is an item of its own, so a repeated one is
ranked again; empty tables give no rows; a very long text is one vector like any
other; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.llm import textkernel as K
from contrail.plans.tables import materialize

TOP = 50
LOAD, LOAD_ITEMS, TURN = 1 << 17, 1 << 14, 1 << 13
ENTRIES, POSTINGS, BUCKET = 1 << 14, 1 << 21, 32
SALTS = 64

_U = np.uint64
_TERM = np.array([b if b >= 0x80 else ord(chr(b).lower()) if chr(b).isalnum() else 0x20 for b in range(256)], np.uint8)


def term_runs(column, chunk: int = K.CHUNK) -> Iterator[K.Words]:
    """Runs of whole texts with their terms as words: what is no term character
    becomes a space, which changes no byte position."""
    data, at = K.raw(column)
    n, i = len(at) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + chunk, side="right")) - 1)
        yield K._words(i, _TERM[data[at[i]:at[j]]], at[i:j + 1] - at[i])
        i = j


def term_hashes(texts: list) -> list[np.ndarray]:
    """Distinct terms of each text, ascending."""
    out: list = []
    for w in term_runs(pa.array(texts, pa.string())):
        doc, h, _ = K.weighted(w.doc, w.hashes(w.start, w.end))
        edge = np.searchsorted(doc, np.arange(w.n + 1))
        out += [h[a:b] for a, b in zip(edge[:-1], edge[1:])]
    return out


# --- vectors -------------------------------------------------------------------

VECTORS = "doc_id long, n long, terms array<int>, tfs array<int>"


def vectors(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """Vector of every document that holds a term: places in the (ascending)
    vocabulary."""
    def restrict(batches):
        for b in batches:
            ids = b.column("doc_id")
            for w in term_runs(b.column("text")):
                h = w.hashes(w.start, w.end)
                at = np.searchsorted(vocabulary, h)
                known = vocabulary[np.minimum(at, len(vocabulary) - 1)] == h if len(vocabulary) else np.zeros(len(h), bool)
                doc, term, tf = K.weighted(w.doc[known], at[known])
                n = w.per_doc(w.doc)
                some = np.flatnonzero(n)
                edge = np.append(np.searchsorted(doc, some), len(doc)).astype(np.int32)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": ids.slice(w.first, w.n).take(pa.array(some)), "n": pa.array(n[some], pa.int64()),
                    "terms": pa.ListArray.from_arrays(pa.array(edge), pa.array(term.astype(np.int32))),
                    "tfs": pa.ListArray.from_arrays(pa.array(edge), pa.array(tf.astype(np.int32)))})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text IS NOT NULL") \
               .mapInArrow(restrict, VECTORS)


# --- the tree of a block --------------------------------------------------------

def gain(tf, m):
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


class Tree:
    """FP-tree of a block's entries.

    ``entries``: (ranks ascending, tfs, m, ids) of each distinct vector, where
    rank 0 is the most frequent term; ``terms`` is the number of ranks."""

    def __init__(self, entries: list[tuple[np.ndarray, np.ndarray, int, list]], terms: int, bucket: int = BUCKET):
        entries = sorted(entries, key=lambda e: e[0].astype(">u4").tobytes())
        self.ids = [e[3] for e in entries]
        size = np.array([len(e[0]) for e in entries])
        self.begin = np.append(0, np.cumsum(size))
        self.rank = np.concatenate([e[0] for e in entries])
        tf = np.concatenate([e[1] for e in entries]).astype(np.int64)
        m = np.array([e[2] for e in entries], np.int64)
        self.gain = gain(tf, np.repeat(m, size))
        shared = [0] + [self._shared(a[0], b[0]) for a, b in zip(entries, entries[1:])]
        self.range, self.children = [], []
        self._grow(0, len(entries), np.array(shared), bucket)
        # subtree maxima of tf and minima of m, as the largest gain per term
        self.best = np.zeros((len(self.range), terms), np.int32)
        for node, (a, b) in enumerate(self.range):
            top = np.zeros(terms, np.int64)
            np.maximum.at(top, self.rank[self.begin[a]:self.begin[b]], tf[self.begin[a]:self.begin[b]])
            self.best[node] = gain(top, m[a:b].min())

    @staticmethod
    def _shared(a: np.ndarray, b: np.ndarray) -> int:
        k = min(len(a), len(b))
        other = np.flatnonzero(a[:k] != b[:k])
        return int(other[0]) if len(other) else k

    def _grow(self, a: int, b: int, shared: np.ndarray, bucket: int) -> None:
        """Nodes of entries a .. b - 1; a child has a longer common path."""
        todo = [(a, b, -1)]
        while todo:
            a, b, parent = todo.pop()
            node = len(self.range)
            self.range.append((a, b))
            self.children.append([])
            if parent >= 0:
                self.children[parent].append(node)
            if b - a <= bucket:
                continue
            depth = shared[a + 1:b].min()
            cuts = [a, *(np.flatnonzero(shared[a + 1:b] == depth) + a + 1).tolist(), b]
            lo = 0
            while lo < len(cuts) - 1:
                hi = lo + 1                 # neighbours that fit one bucket stay together
                while hi < len(cuts) - 1 and cuts[hi + 1] - cuts[lo] <= bucket:
                    hi += 1
                todo.append((cuts[lo], cuts[hi], node))
                lo = hi

    def search(self, terms: np.ndarray, weights: np.ndarray, best: Best) -> int:
        """Adds what beats ``best``; returns the number of entries scored."""
        bound = self.best[:, terms].astype(np.int64) @ weights
        weight = np.zeros(self.best.shape[1], np.int64)
        weight[terms] = weights
        todo, scored = [0], 0
        while todo:
            node = todo.pop()
            if bound[node] == 0 or bound[node] < best.least():
                continue
            if self.children[node]:
                todo += sorted(self.children[node], key=bound.__getitem__)
                continue
            a, b = self.range[node]
            scored += b - a
            score = np.add.reduceat(weight[self.rank[self.begin[a]:self.begin[b]]] * self.gain[self.begin[a]:self.begin[b]],
                                    self.begin[a:b] - self.begin[a])
            for k in np.flatnonzero((score > 0) & (score >= best.least())).tolist():
                best.add(int(score[k]), self.ids[a + k])
        return scored


class Best:
    """The k best (score, doc_id): higher scores, then smaller ids, nulls last."""

    def __init__(self, k: int):
        self.k, self.heap = k, []

    def least(self) -> int:
        return self.heap[0][0] if len(self.heap) == self.k else 0

    def add(self, score: int, ids: list) -> None:
        """``ids`` ascending: as soon as one does not enter, none after it does."""
        for i in ids:
            entry = (score, i is not None, -i if i is not None else 0)
            if len(self.heap) < self.k:
                heapq.heappush(self.heap, entry)
            elif entry > self.heap[0]:
                heapq.heapreplace(self.heap, entry)
            else:
                return

    def rows(self) -> list[tuple[int, int | None]]:
        return [(s, -i if known else None) for s, known, i in self.heap]


def _id_order(i):
    return (i is None, i or 0)


# --- search ----------------------------------------------------------------------

def _search(table: DataFrame, place: np.ndarray, items: list[tuple[int, np.ndarray, np.ndarray]], n_docs: int,
            n_terms: int, top: int, entries: int, bucket: int) -> DataFrame:
    """row, doc_id, score: the k best of each task.  ``place`` maps a term of the
    vocabulary to its rank, or -1."""
    ranks = int((place >= 0).sum())

    def search(batches):
        best = {row: Best(top) for row, _, _ in items}
        block: dict[bytes, tuple] = {}
        held = 0

        def flush():
            nonlocal held
            tree = Tree([(r, f, m, sorted(ids, key=_id_order)[:top]) for r, f, m, ids in block.values()], ranks, bucket)
            for row, terms, weights in items:
                tree.search(terms, weights, best[row])
            block.clear()
            held = 0

        for b in batches:
            ids, n = b.column("doc_id").to_pylist(), b.column("n").to_pylist()
            edge = b.column("terms").offsets.to_numpy()
            term, tf = (b.column(c).values.to_numpy() for c in ("terms", "tfs"))
            rank = place[term]
            for i, a, z in zip(range(len(ids)), edge[:-1].tolist(), edge[1:].tolist()):
                r, f = rank[a:z], tf[a:z]
                known = r >= 0
                if not known.any():
                    continue
                r, f = r[known], f[known]
                order = np.argsort(r)
                r, f, m = r[order], f[order], 50 + (50 * n[i] * n_docs) // n_terms
                key = r.tobytes() + f.tobytes() + str(m).encode()
                if key in block:
                    block[key][3].append(ids[i])
                else:
                    block[key] = (r, f, m, [ids[i]])
                    held += len(r)
                if len(block) >= entries or held >= POSTINGS:
                    flush()
        if block:
            flush()
        found = [(row, i, s) for row, x in best.items() for s, i in x.rows()]
        yield pa.RecordBatch.from_pydict({
            "row": pa.array([r for r, _, _ in found], pa.int64()), "doc_id": pa.array([i for _, i, _ in found], pa.int64()),
            "score": pa.array([s for _, _, s in found], pa.int64())})

    return table.mapInArrow(search, "row long, doc_id long, score long")


def merged(found: DataFrame, top: int) -> DataFrame:
    """The k best per row, by row and hash first: no task gets all of an item."""
    order = (F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))
    few = found.withColumn("salt", salt).withColumn("rank", F.row_number().over(Window.partitionBy("row", "salt").orderBy(*order))) \
               .where(F.col("rank") <= top).drop("rank", "salt")
    return few.withColumn("rank", F.row_number().over(Window.partitionBy("row").orderBy(*order))).where(F.col("rank") <= top)


def _loads(items: DataFrame) -> Iterator[list[tuple[object, np.ndarray]]]:
    """(item_id, distinct terms) of the items, in loads of bounded size."""
    load, seen = [], set()
    for r in items.select("item_id", "text").where("text IS NOT NULL").toLocalIterator():
        terms = term_hashes([r["text"]])[0]
        if load and (len(seen | set(terms.tolist())) > LOAD or len(load) >= LOAD_ITEMS):
            yield load
            load, seen = [], set()
        seen.update(terms.tolist())
        load.append((r["item_id"], terms))
    if load:
        yield load


def _turns(terms_of: list[np.ndarray], limit: int) -> Iterator[list[int]]:
    """Items of a load whose terms together are at most ``limit`` (or one item)."""
    turn, seen = [], set()
    for k, terms in enumerate(terms_of):
        if turn and len(seen | set(terms.tolist())) > limit:
            yield turn
            turn, seen = [], set()
        seen.update(terms.tolist())
        turn.append(k)
    if turn:
        yield turn


def rank(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, top: int = TOP, turn: int = TURN,
         entries: int = ENTRIES, bucket: int = BUCKET) -> DataFrame:
    """item_id, rank, doc_id, score of the ``top`` best documents of each item."""
    kind = benchmark.schema["item_id"].dataType
    out = None
    for load in _loads(benchmark):
        vocabulary = np.unique(np.concatenate([t for _, t in load]))
        table = materialize(spark, vectors(docs, vocabulary), "term_vectors")
        n_docs, n_terms = table.agg(F.count(F.lit(1)), F.sum("n")).first()
        df = np.zeros(len(vocabulary), np.int64)
        for r in table.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
            df[r["t"]] = r["count"]
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        terms_of = [np.searchsorted(vocabulary, t) for _, t in load]
        found = None
        for rows in _turns(terms_of, turn):
            own = np.unique(np.concatenate([terms_of[k] for k in rows]))
            own = own[(df[own] > 0) & (weight[own] > 0)]
            if len(own) == 0:
                continue
            place = np.full(len(vocabulary), -1, np.int32)
            place[own[np.lexsort((own, -df[own]))]] = np.arange(len(own), dtype=np.int32)    # by frequency
            known = [(k, terms_of[k][place[terms_of[k]] >= 0]) for k in rows]
            part = _search(table, place, [(k, place[t], weight[t]) for k, t in known if len(t)], n_docs, n_terms, top,
                           entries, bucket)
            found = part if found is None else found.unionByName(part)
        if found is None:
            continue
        names = spark.createDataFrame(list(enumerate(i for i, _ in load)),
                                      T.StructType([T.StructField("row", T.LongType()), T.StructField("item_id", kind)]))
        ranked = merged(found, top).join(F.broadcast(names), "row").select("item_id", "rank", "doc_id", "score")
        out = ranked if out is None else out.unionByName(ranked)
    if out is None:
        return spark.createDataFrame([], T.StructType([
            T.StructField("item_id", kind), T.StructField("rank", T.IntegerType()), T.StructField("doc_id", T.LongType()),
            T.StructField("score", T.LongType())]))
    return out
