"""Edit-aware token counts.

Each document keeps a segment tree: its leaves are blocks of pre-tokens, cut
where the tokenizer certainly cuts, and every inner node holds the token sum
below it, so the root is the document's count.  An edit re-encodes only the
leaves it touches, widened by the neighbouring leaf wherever the edit comes
near a cut (the boundary context), and then the sums on the way to the root.
Leaves that an insertion makes too large are split where they are.

Defined cases: a null text counts as the empty text (0 tokens, one empty
leaf); a tokenizer without certain cuts has one leaf per text, and so has a text
without any (one word, however long), which an edit encodes again as a whole; a missing or
empty edit list changes nothing; edit positions are code points of the text
before any edit, are clamped to it, and apply in ascending order (of
overlapping edits the later one starts where the earlier one ended).  Rows are
independent: repeated rows give repeated results, extra columns stay.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.tokens import _SPACES, encoder

LEAF_CHARS = 256
TREE_TYPE = "struct<leaf_end:array<int>,sums:array<int>>"
EDIT_TYPE = "array<struct<start:int,stop:int,replacement:string>>"
RESULT_TYPE = "struct<text:string,leaf_end:array<int>,sums:array<int>,reencoded_chars:int>"


class Tree:
    """Token sums over the leaves of one text; ``sums[1]`` is the root and
    leaf k sits at ``len(sums) // 2 + k``."""

    def __init__(self, text: str, count, cut, leaf_chars: int = LEAF_CHARS):
        self.text, self.count, self.cut, self.leaf_chars = text, count, cut, leaf_chars
        self.reencoded = 0
        self.build()

    @classmethod
    def stored(cls, text, leaf_end, sums, count, cut, leaf_chars: int = LEAF_CHARS) -> Tree:
        t = cls.__new__(cls)
        t.text, t.ends, t.sums, t.reencoded = text, list(leaf_end), list(sums), 0
        t.count, t.cut, t.leaf_chars = count, cut, leaf_chars
        return t

    def build(self) -> None:
        self.ends = self._ends(0, len(self.text), max(1, -(-len(self.text) // self.leaf_chars)))
        begin, counts = 0, []
        for end in self.ends:
            counts.append(self.count(self.text[begin:end]))
            begin = end
        self._sum(counts)

    def _ends(self, begin: int, end: int, k: int) -> list[int]:
        """k leaf ends for text[begin:end], at certain cuts; the last is end."""
        out, size = [], end - begin
        for j in range(1, k):
            at = self.cut(self.text, max(begin + j * size // k, (out or [begin])[-1]), end)
            out.append(at)
        return [*out, end]

    def edit(self, start: int, stop: int, replacement: str) -> None:
        n = len(self.text)
        start = min(max(start, 0), n)
        stop = min(max(stop, start), n)
        ends, width = self.ends, len(self.sums) // 2
        first = last = 0
        # A cut stays certain while the characters on both sides of it stay.
        while first + 1 < len(ends) and ends[first] + 1 < start:
            first += 1
        last = first
        while last + 1 < len(ends) and ends[last] - 1 <= stop:
            last += 1
        begin, end = (ends[first - 1] if first else 0), ends[last]
        grown = len(replacement) - (stop - start)
        self.text = self.text[:start] + replacement + self.text[stop:]
        if end + grown - begin > 4 * self.leaf_chars * (last - first + 1):
            self._split(first, last, begin, end + grown, grown)
            return
        ends[first:last + 1] = self._ends(begin, end + grown, last - first + 1)
        if grown:
            ends[last + 1:] = [e + grown for e in ends[last + 1:]]
        for k in range(first, last + 1):
            self.sums[width + k] = self.count(self.text[begin:ends[k]])
            self.reencoded += ends[k] - begin
            begin = ends[k]
        lo, hi = (width + first) // 2, (width + last) // 2
        while lo:
            for i in range(lo, hi + 1):
                self.sums[i] = self.sums[2 * i] + self.sums[2 * i + 1]
            lo, hi = lo // 2, hi // 2

    def _split(self, first: int, last: int, begin: int, end: int, grown: int) -> None:
        """Put as many leaves as text[begin:end] needs in the place of some that have
        outgrown their size.  All others keep their counts; inner sums are added anew."""
        width = len(self.sums) // 2
        counts = self.sums[width:width + len(self.ends)]
        made, at, new = sorted(set(self._ends(begin, end, -(-(end - begin) // self.leaf_chars)))), begin, []
        for e in made:
            new.append(self.count(self.text[at:e]))
            at = e
        self.reencoded += end - begin
        self.ends[first:] = [*made, *(e + grown for e in self.ends[last + 1:])]
        self._sum([*counts[:first], *new, *counts[last + 1:]])

    def _sum(self, counts: list[int]) -> None:
        width = 1 << max(0, (len(counts) - 1).bit_length())
        self.sums = [0] * width + counts + [0] * (width - len(counts))
        for i in range(width - 1, 0, -1):
            self.sums[i] = self.sums[2 * i] + self.sums[2 * i + 1]

    @property
    def total(self) -> int:
        return self.sums[1]


#: Places where the byte-level pre-tokenizer certainly cuts, whatever lies around:
#: before the last white space of a run (the run's rest is one token, with or without
#: the word after it), and after a letter that a sign or digit follows.  The last
#: form is a place inside a run of letters without spaces: see ``joined``.
_HAN = "ぁ-ゖァ-ヺ一-鿿가-힣"
_BYTE_CUT = re.compile(
    rf"(?=[ \t\n\r](?!{_SPACES.pattern})[\s\S])"
    rf"|(?<=[A-Za-zÀ-ÖØ-öø-ÿ{_HAN}])(?=[!-@\[-`{{-~、。！，：；？（）])"
    rf"|(?P<inside>(?<=[{_HAN}])(?=[{_HAN}]))")
_WORD_CUT = re.compile("[ \n]")


def joined(e) -> frozenset[tuple[int, int]]:
    """(last byte of a character, first byte of the next) of all characters that some
    token of a byte-level vocabulary holds side by side.  Merges only make tokens of
    the vocabulary, so no merge joins two characters whose bytes are not listed."""
    back = {ord(letter): b for b, letter in e.letters.items()}
    out = set()
    for token in e.tok.get_vocab(with_added_tokens=False):
        if not all(ord(c) in back for c in token):
            continue
        raw = [back[ord(c)] for c in token]
        out.update((a, b) for a, b in zip(raw, raw[1:]) if 0x80 <= a < 0xC0 <= b)
    return frozenset(out)


def cutter(kind: str, pairs: frozenset | None = None):
    """cut(text, at, end): the next certain cut at or after ``at``, else end.
    ``pairs`` (``joined``): without it runs of letters are not cut."""
    def cut(text: str, at: int, end: int) -> int:
        if at <= 0:
            at = 1
        if kind == "word":
            m = _WORD_CUT.search(text, at, end)
            return m.start() if m else end
        if kind == "byte":
            for m in _BYTE_CUT.finditer(text, at):
                k = m.start()
                if k >= end:
                    break
                if m["inside"] is None or pairs is not None and (text[k - 1].encode()[-1], text[k].encode()[0]) not in pairs:
                    return k
        return end
    return cut


@lru_cache(maxsize=2)
def _tools(path: str):
    e = encoder(path)
    return (lambda text: len(e.encode(text)) // 4), cutter(e.kind, joined(e) if e.kind == "byte" else None)


def tree_column(text: Column, path: str, leaf_chars: int = LEAF_CHARS) -> Column:
    @F.arrow_udf(TREE_TYPE)
    def build(texts: pa.Array) -> pa.Array:
        count, cut = _tools(path)
        ends, sums = [], []
        for t in texts:
            tree = Tree(t.as_py() or "", count, cut, leaf_chars)
            ends.append(array("i", tree.ends))
            sums.append(array("i", tree.sums))
        return pa.StructArray.from_arrays(
            [pa.array(ends, pa.list_(pa.int32())), pa.array(sums, pa.list_(pa.int32()))], ["leaf_end", "sums"])

    return build(text)


def edited_column(text: Column, tree: Column, edits: Column, path: str,
                  leaf_chars: int = LEAF_CHARS) -> Column:
    @F.arrow_udf(RESULT_TYPE)
    def apply(texts: pa.Array, trees: pa.Array, edit_lists: pa.Array) -> pa.Array:
        count, cut = _tools(path)
        out = []
        for t, stored, todo in zip(texts, trees, edit_lists.to_pylist()):
            stored = stored.as_py()
            tree = Tree.stored(t.as_py() or "", stored["leaf_end"], stored["sums"], count, cut, leaf_chars)
            shift, free = 0, 0
            for e in sorted((e for e in todo or [] if e and e["start"] is not None),
                            key=lambda e: (e["start"], e["stop"] or 0)):
                start = max(e["start"], free)
                stop = max(start, e["stop"] if e["stop"] is not None else start)
                free, before = stop, len(tree.text)
                tree.edit(start + shift, stop + shift, e["replacement"] or "")
                shift += len(tree.text) - before
            out.append({"text": tree.text, "leaf_end": array("i", tree.ends), "sums": array("i", tree.sums),
                        "reencoded_chars": tree.reencoded})
        kind = pa.struct([("text", pa.string()), ("leaf_end", pa.list_(pa.int32())),
                          ("sums", pa.list_(pa.int32())), ("reencoded_chars", pa.int32())])
        return pa.array(out, kind)

    return apply(text, tree, edits.cast(EDIT_TYPE))


def count_trees(docs: DataFrame, path: str, leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """doc_id, text, tree: the state to keep beside the documents."""
    return docs.select("doc_id", "text", tree_column(F.col("text"), path, leaf_chars).alias("tree"))


def apply_edits(trees: DataFrame, edits: Column | DataFrame, path: str,
                leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """``trees`` with texts and trees after the edits.  ``edits``: a column of
    ``trees``, or a table (doc_id, edits); documents it lacks stay as they are."""
    if isinstance(edits, DataFrame):
        table = edits.select(F.col("doc_id").alias("_edited"), F.col("edits").alias("_edits"))
        trees = trees.join(table, F.col("doc_id") == F.col("_edited"), "left")
        edits = F.col("_edits")
    made = trees.select("doc_id", "tree", F.size(edits).alias("n_edits"),
                        edited_column(F.col("text"), F.col("tree"), edits, path, leaf_chars).alias("e"))
    return made.select(
        "doc_id", F.col("e.text").alias("text"),
        F.struct(F.col("e.leaf_end").alias("leaf_end"), F.col("e.sums").alias("sums")).alias("tree"),
        F.element_at("tree.sums", 2).alias("n_tokens_before"),
        F.element_at("e.sums", 2).alias("n_tokens"),
        F.greatest(F.col("n_edits"), F.lit(0)).alias("n_edits"),
        F.col("e.reencoded_chars").alias("reencoded_chars"))
