"""Token ids of texts by the ``tokenizers`` library.

BPE merges never cross the pre-tokens that a tokenizer cuts out of a text, so
a text can be encoded piece by piece and each distinct piece only once: a
per-worker table of pieces (bounded, aged) turns most of the work into
lookups.  A new piece that ends in signs takes the ids of its word from the
table, too.  Pieces are cut at single spaces and line ends only, where the
pre-tokenizers of the two families below certainly cut, too:

* byte level: a space belongs to the word after it, a line end is its own
  pre-token.  A text with two separators in a row, or any other white space,
  goes through the library whole.
* word ends: white space is dropped, so any space or line end separates.

Tokenizers of another form always encode whole texts.  Strings of special
tokens in a text are ordinary text.
"""

from __future__ import annotations

import json
import re
import sys
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

TABLE_LIMIT = 500_000         # pieces a generation
#: Latin letters that every stage leaves alone but for their case, then ASCII
#: signs without the apostrophe (contractions).
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
_LATIN = re.compile("[\0-\u00ff]*")      # lower case stays in this range, and there is nothing to compose
_SPACES = re.compile(r"[\s\x1c-\x1f\x85\xa0  -‏ -  ⁠　﻿]")


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level BPE."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}  # for str.translate


class _Odd(Exception):
    """A piece that can't be encoded apart from its text."""


class _Pieces(dict):
    """piece -> its ids as little-endian unsigned 32-bit integers, in two
    generations of at most ``limit``: what was not looked up since the last
    change of generations is forgotten, the rest stays."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.old, self.made = make, limit, {}, 0

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.pop(piece, None)
        if ids is None:
            ids = self.make(piece)
            self.made += 1
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[piece] = ids
        return ids


class Encoder:
    def __init__(self, path: str, table_limit: int = TABLE_LIMIT):
        from tokenizers import Tokenizer

        spec = json.load(open(path, encoding="utf-8"))
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        self.model = self.tok.model
        self.letters = _byte_letters()
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        self.kind = "whole"
        if model.get("type") == "BPE" and not spec.get("truncation") and not spec.get("padding"):
            if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") \
                    and spec.get("normalizer") is None:
                self.kind = "byte"
            elif model.get("end_of_word_suffix") and pre.get("type") == "Sequence" \
                    and pre["pretokenizers"][0].get("behavior") == "Removed":
                self.kind = "word"
        self.bare = _Pieces(self._byte_bare if self.kind == "byte" else self._word, table_limit)
        self.spaced = _Pieces(self._byte_spaced, table_limit)
        self.signs = _Pieces(self._pre_token, max(1, table_limit // 8))
        self.line_end = self.whole("\n") if self.kind == "byte" else b""

    def whole(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _pre_token(self, piece: str) -> bytes:
        mapped = piece.encode().decode("latin-1").translate(self.letters)
        ids = array("I", [t.id for t in self.model.tokenize(mapped)])
        return ids.tobytes() if sys.byteorder == "little" else np.array(ids, "<u4").tobytes()

    def _split(self, table: _Pieces, lead: str, piece: str) -> bytes:
        m = _PLAIN.fullmatch(piece)
        if not m:
            if _SPACES.search(piece):
                raise _Odd
            return self.whole(lead + piece)
        word, signs = m.groups()
        return table[word] + self.signs[signs] if signs else self._pre_token(lead + word)

    def _byte_bare(self, piece: str) -> bytes:
        return self._split(self.bare, "", piece)

    def _byte_spaced(self, piece: str) -> bytes:
        return self._split(self.spaced, " ", piece)

    def _word(self, piece: str) -> bytes:
        """Whole texts in Latin-1 come in lower case, pieces of others may not."""
        if not piece:
            return b""
        if not _PLAIN.fullmatch(piece):
            return self.whole(piece)
        low = piece.lower()
        return self._split(self.bare, "", low) if low == piece else self.bare[low]

    def _byte(self, text: str) -> bytes:
        out, bare, spaced = [], self.bare, self.spaced
        for k, line in enumerate(text.split("\n")):
            head, *rest = line.split(" ")
            if "" in rest or not head and not rest:
                raise _Odd
            if k:
                out.append(self.line_end)
            if head:                        # else a single space leads the line
                out.append(bare[head])
            out.extend(map(spaced.__getitem__, rest))
        return b"".join(out)

    def encode(self, text: str | None) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers (null: none)."""
        if not text:
            return b""
        if self.kind == "word":
            if text.isascii() or _LATIN.fullmatch(text):
                text = text.lower()
            return b"".join(map(self.bare.__getitem__, text.replace("\n", " ").split(" ")))
        if self.kind == "byte":
            try:
                return self._byte(text)
            except _Odd:
                pass
        return self.whole(text)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per Python worker and vocabulary."""
    return Encoder(path)


def token_ids(text: Column, path: str, end_id: int | None = None) -> Column:
    """Binary column: ids of each text as little-endian unsigned 32-bit
    integers, then ``end_id``; null counts as the empty text."""
    tail = b"" if end_id is None else np.array([end_id], dtype="<u4").tobytes()

    @F.arrow_udf("binary")
    def encode(texts: pa.Array) -> pa.Array:
        e = encoder(path)
        return pa.array([e.encode(t.as_py()) + tail for t in texts], pa.binary())

    return encode(text)
