"""Token ids of texts through content-defined chunks, and back.

A rolling hash over the last ``WINDOW`` bytes cuts a text into chunks, so a
passage that documents share is cut alike in all of them.  A worker keeps the
ids of each chunk in a table (bounded, aged in two generations): the chunks of
copies, boilerplate and shared passages are encoded once.

A chunk that is encoded alone is wrong at its edges, so joins are repaired.
There are places that end a pre-token whatever else is in the text, for they
depend on the two or three characters around them only (``CERTAIN``).  Between
its first and its last such place a chunk has the same ids alone and in any
text: these are kept.  A join is encoded from the last such place of a chunk to
the first one of the next, where the encodings agree again; if the next chunk
has none, the repair goes on into the chunk after it.

Decoding concatenates the ids' bytes and reads them as UTF-8.

Strings of the vocabulary's added tokens in a text become their ids, as the
library does by default; the text between them is encoded piece by piece.
Tokenizers of another form than byte-level BPE encode and decode whole texts by
the library.

Defined cases: a null text counts as empty: no ids, and decoded to the empty
text; a very long text is many chunks; one without any certain place (say, one
letter repeated) is repaired from end to end, that is, encoded whole; equal
texts and repeated rows have equal ids; an empty table gives no rows; all
columns are kept, new ones have the names that the caller gives.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from contrail.llm import textkernel as K
from contrail.llm.tokens import Encoder

WINDOW, MEAN, LEAST, MOST = 32, 1024, 256, 8192     # bytes
TABLE_BYTES = 48 << 20

_LETTER, _SIGN, _QUOTED = "A-Za-zÀ-ÖØ-öø-ÿ", r"!-/:-@\[-`{-~", r"!-&(-/:-@\[-`{-~"
#: A pre-token ends here in any text: white space begins, a single line end is
#: over, or letters, digits and signs change (but not after an apostrophe:
#: contractions).
CERTAIN = re.compile(
    rf"(?<=[\w{_SIGN}])(?=[ \n])|(?<=[\w{_SIGN}]\n)(?=[\w{_SIGN}])|(?<=[{_LETTER}])(?=[0-9{_SIGN}])"
    rf"|(?<=[0-9])(?=[{_LETTER}{_SIGN}])|(?<=[{_QUOTED}])(?=[{_LETTER}0-9])")

_LINE_BEGIN, _LINE_OVER = re.compile(rf"\n(?=[\w{_SIGN}])"), re.compile(rf"(?<=[\w{_SIGN}])\n\Z")

_U = np.uint64


def _last_certain(text: str) -> int:
    """Last certain place inside a text, or 0."""
    back = 48
    while True:
        first = max(1, len(text) - back)
        last = 0
        for m in CERTAIN.finditer(text, first):
            if m.start() < len(text):
                last = m.start()
        if last or first == 1:
            return last
        back *= 4


def cuts(data: np.ndarray) -> list[int]:
    """Where chunks begin and end in a text's UTF-8 bytes."""
    n = len(data)
    if n <= LEAST:
        return [0, n] if n else [0]
    up, down = K._powers(max(2 * K.CHUNK, 1 << int(n + 1).bit_length()))
    prefix = np.zeros(n + 1, _U)
    np.cumsum(K._BYTE[data] * up[:n], out=prefix[1:])
    h = (prefix[WINDOW:] - prefix[:-WINDOW]) * down[:n + 1 - WINDOW]    # of the bytes i .. i + WINDOW - 1
    # the top bits of a product depend on all bytes; cut between characters only
    ends = np.flatnonzero((h * _U(0x9FB21C651E98DF25)) >> _U(54) < _U(1024 // MEAN)) + WINDOW
    ends = ends[ends < n]
    ends = ends[(data[ends] & 0xC0) != 0x80].tolist()
    out = [0]
    for end in [*ends, n]:
        if end - out[-1] < LEAST and end < n:
            continue
        while end - out[-1] > MOST:
            forced = out[-1] + MOST
            while (data[forced] & 0xC0) == 0x80:
                forced -= 1
            out.append(forced)
        if end > out[-1]:
            out.append(end)
    return out


class _Aged:
    """A table of at most ``limit`` bytes a generation: what was not used since
    the last change of generations is forgotten."""

    def __init__(self, make, limit: int):
        self.make, self.limit = make, limit
        self.young: dict = {}
        self.old: dict = {}
        self.size = 0

    def __call__(self, key: bytes):
        entry = self.young.get(key)
        if entry is None:
            entry = self.old.pop(key, None) or self.make(key)
            if self.size >= self.limit:
                self.old, self.young, self.size = self.young, {}, 0
            self.young[key] = entry
            self.size += len(key) + entry[0].nbytes + 400
        return entry


class ChunkCodec:
    """Encoder and decoder of one vocabulary, with a worker's chunk table."""

    def __init__(self, path: str, table_bytes: int = TABLE_BYTES):
        self.encoder = Encoder(path)
        spec = json.load(open(path, encoding="utf-8"))
        self.tok = self.encoder.tok
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        plain = not any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec.get("added_tokens", []))
        self.chunked = self.encoder.kind == "byte" and plain and (spec.get("decoder") or {}).get("type") == "ByteLevel"
        if not self.chunked:
            self.tok.encode_special_tokens = False
            self.tok.no_truncation()
            self.tok.no_padding()
            return
        longest = sorted(map(re.escape, self.added), key=len, reverse=True)
        self.special = re.compile("(" + "|".join(longest) + ")") if longest else None
        byte_of = {c: b for b, c in self.encoder.letters.items()}
        names = {i: t for t, i in self.tok.get_vocab(with_added_tokens=True).items()}
        self.bytes_of = [b""] * (max(names) + 1)
        for i, t in names.items():
            self.bytes_of[i] = t.encode() if t in self.added else bytes(byte_of[ord(c)] if len(c) == 1 and ord(c) in byte_of
                                                                        else byte_of[c] for c in t)
        self.length = np.array([len(b) for b in self.bytes_of], np.int64)
        self.table = _Aged(self._chunk, table_bytes)
        self.encoded = self.taken = 0           # bytes of chunks made, and of all chunks

    def _ids(self, text: str) -> np.ndarray:
        """Ids of a text between certain places.  A line end at its edge is a
        pre-token by itself there."""
        lead, trail = _LINE_BEGIN.match(text) is not None, _LINE_OVER.search(text) is not None
        ids = self.encoder.encode(text[lead:len(text) - trail])
        return np.frombuffer(self.encoder.line_end * lead + ids + self.encoder.line_end * trail, "<u4")

    def _chunk(self, key: bytes) -> tuple[np.ndarray, int, int]:
        """First and last certain place of a chunk, and the ids between them."""
        text = key.decode()
        self.encoded += len(key)
        first = CERTAIN.search(text, 1)
        if first is None or first.start() >= len(text):
            return np.zeros(0, "<u4"), 0, 0
        head, tail = first.start(), _last_certain(text)
        return self._ids(text[head:tail]), head, tail

    def _run(self, text: str) -> list[np.ndarray]:
        """Ids of a text without added tokens, in parts."""
        raw = text.encode()
        at = cuts(np.frombuffer(raw, np.uint8))
        self.taken += len(raw)
        out, open_ = [], []                      # open: text from the last certain place on
        for a, b in zip(at[:-1], at[1:]):
            key = raw[a:b]
            ids, head, tail = self.table(key)
            chunk = key.decode()
            if not head:                        # no place to agree at: go on into the next chunk
                open_.append(chunk)
                continue
            out += [self._ids("".join(open_) + chunk[:head]), ids]
            open_ = [chunk[tail:]]
        out.append(self._ids("".join(open_)))
        return out

    def encode(self, text: str | None) -> np.ndarray:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return np.zeros(0, "<u4")
        if not self.chunked:
            return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4")
        parts = self.special.split(text) if self.special and self.special.search(text) else [text]
        out: list[np.ndarray] = []
        for k, part in enumerate(parts):
            if k % 2:
                out.append(np.array([self.added[part]], "<u4"))
            elif part:
                out += self._run(part)
        return np.concatenate(out)

    def decode(self, ids: np.ndarray) -> str:
        if not self.chunked:
            return self.tok.decode(ids.tolist(), skip_special_tokens=False)
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str) -> ChunkCodec:
    """One per Python worker and vocabulary."""
    return ChunkCodec(path)


def encoded(text: Column, path: str) -> Column:
    """Binary column: ids as little-endian unsigned 32-bit integers."""
    @F.arrow_udf("binary")
    def encode(texts: pa.Array) -> pa.Array:
        c = codec(path)
        return pa.array([c.encode(t.as_py()).tobytes() for t in texts], pa.binary())

    return encode(text)


def decoded(ids: Column, path: str) -> Column:
    """The text of a binary column of ids (null: null)."""
    @F.arrow_udf("string")
    def decode(column: pa.Array) -> pa.Array:
        c = codec(path)
        return pa.array([None if x is None else c.decode(np.frombuffer(x, "<u4"))
                         for x in (v.as_py() for v in column)], pa.string())

    return decode(ids)
