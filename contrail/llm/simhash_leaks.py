"""Benchmark decontamination by SimHash windows.

A document window has as many words as the item it is held against.  Its
fingerprint is the SimHash of its weighted five-word shingles; the item
fingerprints lie in a multi-index: 64 bits are cut into 4 blocks of 16, and two
fingerprints within radius 21 differ in at most 5 bits of one block at least (four
blocks with 6 would be 24).  A table per block lists for each of its 65,536 values the
items that near, as a bit set, so four look-ups give a window's candidates among all
items of its size; a random fingerprint passes for an item in 36 % of cases, and its
distance decides.  Candidates are then verified by the exact weighted Jaccard
similarity of the shingles (sum of the smaller counts over sum of the larger), 0.8
or more.

Windows slide by one word over the whole text.  Those that share no shingle
with any item have similarity 0 and get no fingerprint.

Where neither the window nor the item repeats a shingle, a similarity of 0.8
means fingerprints about 10 of 64 bits apart (standard deviation 2.9); the
radius of 21 keeps all but about 1 in 20,000 such pairs.  With repeated
shingles the sign sums follow the cosine of the counts instead, which no useful
radius bounds; such windows skip the fingerprint, and their similarity is
counted exactly as they slide (``Index.running``), so none of them is missed.

Items are handled in blocks of about ``BLOCK`` items, so the index in a task
is bounded however large the benchmark is.

Defined cases: a null or word-less text leaks nothing, a null or word-less
item is never found; an item of 1 to 4 words is one shingle and is found only
as a document of exactly these words; a document shorter than an item is one
window; equal items are all reported; repeated rows repeat their result; extra
columns are kept by ``clean`` and not read by ``leaks``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm import textkernel as K
from contrail.plans.tables import materialize

BITS, RADIUS, BLOCKS = 64, 21, 4
WINDOWS = 4096              # fingerprints looked up at a time
SIMILARITY = 0.8
BLOCK = 2000
HITS = "array<struct<item_id:bigint,similarity:double,word:int>>"


def _signs(h: np.ndarray) -> np.ndarray:
    """+1 / -1 for each bit of each hash."""
    bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.astype(np.int32) * 2 - 1


def _fingerprints(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1, bitorder="little").view("<u8").ravel()


def _block(fp: np.ndarray, b: int) -> np.ndarray:
    return ((fp >> np.uint64(16 * b)) & np.uint64(0xFFFF)).astype(np.int64)


def block_tables(prints: np.ndarray, radius: int = RADIUS) -> list[np.ndarray]:
    """Per block: value -> bit set of the items within ``radius // 4`` bits there
    (32 KB an item in all)."""
    values, tables = np.arange(1 << 16), []
    for b in range(BLOCKS):
        t = np.zeros((1 << 16, -(-len(prints) // 8)), np.uint8)
        for i, v in enumerate(_block(prints, b).tolist()):
            t[np.bitwise_count(values ^ v) <= radius // BLOCKS, i >> 3] |= np.uint8(1 << (i & 7))
        tables.append(t)
    return tables


@lru_cache(maxsize=1)
def _tables(prints: bytes, radius: int) -> tuple[np.ndarray, ...]:
    """The tables are built where they are used, and kept for a worker's next tasks."""
    return tuple(block_tables(np.frombuffer(prints, np.uint64), radius))


@dataclass
class Index:
    ids: list
    size: np.ndarray            # words of each item
    sets: list                  # (distinct shingles ascending, counts) of each item
    prints: np.ndarray
    shingles: np.ndarray        # all distinct shingles, ascending
    first: np.ndarray           # shingle k is in items[first[k]:first[k + 1]]
    items: np.ndarray
    radius: int
    similarity: float

    @property
    def tables(self) -> tuple[np.ndarray, ...]:
        return _tables(self.prints.tobytes(), self.radius)

    @classmethod
    def of(cls, ids, texts, radius: int = RADIUS, similarity: float = SIMILARITY) -> Index:
        kept, size, sets, prints = [], [], [], []
        for i, text in zip(ids, texts):
            for w in K.runs(pa.array([text], pa.string())):
                doc, h = K.shingles(w)
                if len(h):
                    _, u, n = K.weighted(doc, h)
                    kept.append(i)
                    size.append(len(w.start))
                    sets.append((u, n))
                    prints.append(_fingerprints(_signs(h).sum(0, keepdims=True))[0])
        by_size = np.argsort(size, kind="stable").tolist()      # the items of one size lie together
        kept, size, sets, prints = ([part[i] for i in by_size] for part in (kept, size, sets, prints))
        prints = np.array(prints, np.uint64)
        flat = np.concatenate([u for u, _ in sets]) if sets else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(sets)), [len(u) for u, _ in sets]) if sets else np.zeros(0, np.int64)
        order = np.argsort(flat, kind="stable")
        shingles, first = np.unique(flat[order], return_index=True)
        return cls(kept, np.array(size, np.int64), sets, prints, shingles, np.append(first, len(flat)),
                   owner[order], radius, similarity)

    def candidates(self, prints: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) pairs that the multi-index finds among the items lo to hi."""
        first, last = lo >> 3, -(-hi // 8)
        found = np.zeros((len(prints), last - first), np.uint8)
        for b, t in enumerate(self.tables):
            found |= t[_block(prints, b), first:last]
        window, item = np.nonzero(np.unpackbits(found, axis=1, bitorder="little")[:, lo - 8 * first:hi - 8 * first])
        return window, item + lo

    def near(self, prints: np.ndarray, item: int) -> np.ndarray:
        """The windows within the radius of one item."""
        return np.array([w for w, _ in self.near_pairs(prints, item, item + 1)], np.int64)

    def near_pairs(self, prints: np.ndarray, lo: int, hi: int) -> list[tuple[int, int]]:
        """(window, item) pairs within the radius, among the items lo to hi."""
        out = []
        for at in range(0, len(prints), WINDOWS):
            window, item = self.candidates(prints[at:at + WINDOWS], lo, hi)
            close = np.bitwise_count(prints[at + window] ^ self.prints[item]) <= self.radius
            out += zip((at + window[close]).tolist(), item[close].tolist())
        return out

    def overlap(self, h: np.ndarray, item: int) -> float:
        """Exact weighted Jaccard similarity of a window's shingles and an item's."""
        u, n = np.unique(h, return_counts=True)
        v, m = self.sets[item]
        _, a, b = np.intersect1d(u, v, assume_unique=True, return_indices=True)
        both = int(np.minimum(n[a], m[b]).sum())
        return both / (len(h) + int(m.sum()) - both)

    def search(self, column) -> list[list[dict]]:
        out: list[list[dict]] = []
        for w in K.runs(column):
            hits: list[list[dict]] = [[] for _ in range(w.n)]
            doc, h = K.shingles(w)
            if len(h) and len(self.shingles):
                k = np.minimum(np.searchsorted(self.shingles, h), len(self.shingles) - 1)
                for d in np.unique(doc[self.shingles[k] == h]).tolist():
                    lo, hi = np.searchsorted(doc, [d, d + 1])
                    hits[d] = self._document(h[lo:hi], k[lo:hi])
            out += hits
        return out

    def running(self, k: np.ndarray, item: int, n: int) -> np.ndarray:
        """Exact weighted Jaccard similarity of an item and each window of ``n``
        of the shingles ``k`` (places in ``shingles``, -1 for others).  Of a
        shingle that the item has m times, an occurrence counts in the windows
        that hold it but not the m-th occurrence before it."""
        v, m = self.sets[item]
        of = np.searchsorted(self.shingles, v)
        at = np.flatnonzero(np.isin(k, of))
        at = at[np.argsort(k[at], kind="stable")]           # by shingle, then by place
        j, most = np.arange(len(at)), m[np.searchsorted(of, k[at])]
        back = np.maximum(j - most, 0)
        capped = (j >= most) & (k[at[back]] == k[at])
        lo = np.maximum(np.where(capped, at[back] + 1, 0), np.maximum(at - n + 1, 0))
        hi = np.minimum(at, len(k) - n)
        some = lo <= hi
        change = np.zeros(len(k) - n + 2, np.int64)
        np.add.at(change, lo[some], 1)
        np.add.at(change, hi[some] + 1, -1)
        both = np.cumsum(change[:-1])
        return both / (n + int(m.sum()) - both)

    def _document(self, h: np.ndarray, k: np.ndarray) -> list[dict]:
        known = self.shingles[k] == h
        at = np.flatnonzero(known)
        of = [(p, i) for p in at.tolist() for i in self.items[self.first[k[p]]:self.first[k[p] + 1]].tolist()]
        where: dict[int, list[int]] = {}
        for p, i in of:
            where.setdefault(i, []).append(p)
        known_k = np.where(known, k, -1)
        order = np.argsort(h, kind="stable")
        before = np.full(len(h), -1)                        # place of the same shingle before
        same = h[order[1:]] == h[order[:-1]]
        before[order[1:][same]] = order[:-1][same]
        before = np.maximum.accumulate(before)
        best: dict[int, tuple[float, int]] = {}             # item -> similarity, - first word

        def seen(i: int, similar: float, word: int) -> None:
            best[i] = max(best.get(i, (0.0, 0)), (similar, -word))

        # shingles of a window of each item, rising with the items
        window = np.minimum(np.maximum(self.size - K.SHINGLE + 1, 1), len(h))
        for n in np.unique(window[list(where)]).tolist():
            lo, hi = np.searchsorted(window, [n, n + 1]).tolist()
            starts = {i: np.unique(np.concatenate([np.arange(max(p - n + 1, 0), min(p, len(h) - n) + 1) for p in where[i]]))
                      for i in range(lo, hi) if i in where}
            # SimHash follows the similarity only where no shingle repeats
            for i, own in starts.items():
                repeats = (before[own + n - 1] >= own) | bool((self.sets[i][1] > 1).any())
                if repeats.any():
                    exact = self.running(known_k, i, n)[own[repeats]]
                    seen(i, float(exact.max()), int(own[repeats][exact.argmax()]))
            own = np.unique(np.concatenate(list(starts.values())))
            own = own[before[own + n - 1] < own]
            if len(own):
                base = int(own[0])
                signs = _signs(h[base:int(own[-1]) + n])
                sums = np.zeros((len(signs) + 1, BITS), np.int32)
                np.cumsum(signs, axis=0, out=sums[1:])
                at = own - base
                for w, i in self.near_pairs(_fingerprints(sums[at + n] - sums[at]), lo, hi):
                    if not (self.sets[i][1] > 1).any():
                        s = int(own[w])
                        seen(i, self.overlap(h[s:s + n], i), s)
        return [{"item_id": self.ids[i], "similarity": similar, "word": -word}
                for i, (similar, word) in sorted(best.items()) if similar >= self.similarity]


def indexes(benchmark: DataFrame, block: int = BLOCK, **settings):
    """One index after another; each holds a block of the distinct items."""
    items = benchmark.select("item_id", "text").where("text IS NOT NULL").distinct()
    blocks = max(1, -(-items.count() // block))
    for b in range(blocks):
        rows = (items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
                .orderBy("item_id", "text").collect())
        yield Index.of([r.item_id for r in rows], [r.text for r in rows], **settings)


def hits_column(text: Column, index: Index) -> Column:
    @F.arrow_udf(HITS)
    def search(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("item_id", pa.int64()), ("similarity", pa.float64()), ("word", pa.int32())]))
        return pa.array(index.search(texts), kind)

    return search(text)


def leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, block: int = BLOCK) -> DataFrame:
    """doc_id, hits (item, similarity, first word of its best window) of every row."""
    rows = docs.select("doc_id", "text", F.array().cast(HITS).alias("hits"))
    for k, index in enumerate(indexes(benchmark, block)):
        if k:
            rows = materialize(spark, rows, f"hits{k}")      # one index in a task at a time
        rows = rows.withColumn("hits", F.concat("hits", hits_column(F.col("text"), index)))
    return rows.select("doc_id", "hits")


def clean(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` in which no item is found, with all their columns."""
    for k, index in enumerate(indexes(benchmark, block)):
        if k:
            docs = materialize(spark, docs, f"clean{k}")
        docs = docs.where(F.size(hits_column(F.col("text"), index)) == 0)
    return docs
