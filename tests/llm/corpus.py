"""Small fixtures with the awkward cases, and plain reference versions."""

import random
import re

from pyspark.sql import types as T

import public_tokenizers
from tokenizers import Tokenizer

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")
SPACE = r"[^\x20\x09-\x0D]+"

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # extra columns whose names clash with the operators' own
    T.StructField("score", T.StringType()), T.StructField("tokens", T.ArrayType(T.StringType())),
    T.StructField("row", T.IntegerType()), T.StructField("text_key", T.StringType()),
])


def prose(seed, n):
    r = random.Random(seed)
    parts = ["the", "ing", "an", "er", "on", "es", "ti", "ou", "re", "st", "ü", "é"]
    words = ["".join(r.choices(parts, k=r.randint(1, 4))) for _ in range(n)]
    return " ".join(w + ("." if r.random() < 0.1 else "") for w in words)


ODD = [None, "", " ", "\n\n", "one", "two words", "a  b\t c\n\n d ", "x" * 5000, "\u00a0 \u3000 \x1c z",
       "'Tis don't I'LL <|endoftext|> \u0130stanbul e\u0301", "$$$ %%% &&& ||| ###", "same line\nsame line\nsame line"]


def rows(texts, first=0):
    return [(first + i, t, "en", f"src{i % 3}", None if t is None else len(t), "s", ["t"], i, "k") for i, t in enumerate(texts)]


def frame(spark, data, n=3):
    return spark.createDataFrame(data, DOCS).repartition(n)


def mixed(spark):
    """Odd texts, prose, a very long text, a repeated row, a repeated doc_id
    with another text, null doc_ids."""
    data = rows(ODD + [prose(k, 30 + 7 * k) for k in range(12)] + [prose(99, 20_000)])
    data += [data[15], data[15], (15, "another text of the same id and more words",) + data[15][2:]]
    data += [(None, "a text without any id but with some words",) + data[0][2:], (None, None) + data[0][2:]]
    return frame(spark, data)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def ids(path, text):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t.encode(text or "", add_special_tokens=False).ids


def words(text):
    return re.findall(SPACE, text or "")


def shingles(text, k=5):
    w = words(text)
    return [tuple(w[i:i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [tuple(w)] if w else []
