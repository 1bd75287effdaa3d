"""Chunk codec, heap-ordered clusters and ranked search against plain versions."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from contrail.llm import chunk_codec, fp_search, heap_clusters, queries
from contrail.llm.shipping import ship
from tests.llm import corpus as C


# --- chunk codec -----------------------------------------------------------------

def library():
    t = Tokenizer.from_file(C.BYTE)
    t.no_truncation()
    t.no_padding()
    return t


def test_chunks_give_the_ids_of_whole_texts(monkeypatch):
    for name, small in (("WINDOW", 3), ("MEAN", 16), ("LEAST", 4), ("MOST", 64)):
        monkeypatch.setattr(chunk_codec, name, small)
    codec, lib, r = chunk_codec.ChunkCodec(C.BYTE, table_bytes=50_000), library(), random.Random(7)
    letters = [*"ab \n\t.'$1éS漢字　’_", "'ll", "'re", "<|endoftext|>", "\r\n"]
    texts = [t for t in C.ODD if t] + [C.prose(k, 200) for k in range(5)]
    texts += ["".join(r.choices(letters, k=r.randint(1, 80))) for _ in range(4000)]
    texts += ["".join(r.choices("ab 'l.\n1", k=r.randint(5, 200))) for _ in range(4000)]
    for t in texts:
        ids = codec.encode(t)
        want = lib.encode(t, add_special_tokens=False).ids
        assert ids.tolist() == want, repr(t)
        assert codec.decode(ids) == lib.decode(want, skip_special_tokens=False)
    assert codec.encode(None).tolist() == codec.encode("").tolist() == []


def test_shared_passages_are_encoded_once():
    codec, shared = chunk_codec.ChunkCodec(C.BYTE), C.prose(1, 20_000)
    for k in range(20):
        codec.encode(C.prose(100 + k, 30 + k) + " " + shared)
    assert codec.encoded < 0.08 * codec.taken


@pytest.mark.parametrize("text", ["x" * 60_000, "漢字仮名" * 8_000, "line\n" * 20_000, "a  b " * 15_000, "7" * 30_000])
def test_long_texts_with_few_joins(text):
    codec, lib = chunk_codec.ChunkCodec(C.BYTE), library()
    ids = codec.encode(text)
    assert ids.tolist() == lib.encode(text, add_special_tokens=False).ids and codec.decode(ids) == text


def test_cuts_cover_the_text_between_characters():
    raw = np.frombuffer(("aé漢" * 9_000 + C.prose(3, 4_000)).encode(), np.uint8)
    at = chunk_codec.cuts(raw)
    assert at[0] == 0 and at[-1] == len(raw) and max(np.diff(at)) <= chunk_codec.MOST
    assert b"".join(raw[a:b].tobytes().decode().encode() for a, b in zip(at, at[1:])) == raw.tobytes()


def test_other_tokenizers_go_through_the_library():
    codec = chunk_codec.ChunkCodec(C.WORD)
    t = Tokenizer.from_file(C.WORD)
    ids = codec.encode("Some Words, and more")
    assert ids.tolist() == t.encode("Some Words, and more", add_special_tokens=False).ids
    assert codec.decode(ids) == t.decode(ids.tolist(), skip_special_tokens=False)


def test_codec_columns(spark):
    ship(spark)
    for docs in (C.mixed(spark), C.empty(spark)):
        got = docs.withColumn("ids", chunk_codec.encoded(F.col("text"), C.BYTE)) \
                  .withColumn("back", chunk_codec.decoded(F.col("ids"), C.BYTE)).collect()
        assert len(got) == docs.count()
        for r in got:
            assert np.frombuffer(r.ids, "<u4").tolist() == library().encode(r.text or "", add_special_tokens=False).ids
            assert r.back == (r.text or "")


# --- clusters ----------------------------------------------------------------------

VEC = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                    T.StructField("block", T.StringType()), T.StructField("cluster", T.StringType())])


def plain_clusters(rows, k, rounds):
    kept = [(i, v) for i, v in rows if v is not None and len(v) == 64
            and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return [], None
    x = np.array([[math.floor(1024 * float(np.float32(c))) for c in v] for _, v in kept])
    order = sorted(range(len(kept)), key=lambda j: (hashlib.sha256(f"3:{'' if kept[j][0] is None else kept[j][0]}".encode()).hexdigest(),
                                                    [float(np.float32(c)) for c in kept[j][1]]))
    c = x[order[:k]].copy()
    near = lambda: ((x[:, None, :] - c) ** 2).sum(2)        # noqa: E731
    for _ in range(rounds):
        a = near().argmin(1)
        for j in range(len(c)):
            if (a == j).any():
                c[j] = [int(s) // int((a == j).sum()) for s in x[a == j].sum(0)]
    d = near()
    return [(kept[i][0], int(d[i].argmin()), int(d[i].min())) for i in range(len(kept))], c


def vectors(seed, n, centres=5, spread=0.05):
    r = np.random.default_rng(seed)
    middle = r.normal(size=(centres, 64))
    return [(int(i), (middle[i % centres] + spread * r.normal(size=64)).astype(np.float32).tolist()) for i in range(n)]


def order(rows):
    return sorted(rows, key=lambda t: (t[0] is None, t[0] or 0, t[1], t[2]))


@pytest.mark.parametrize("spread", [0.05, 0.8])
def test_clusters_equal_plain_rounds(spark, spread):
    ship(spark)
    data = vectors(1, 700, spread=spread)
    data += [data[3], data[3], (9001, None), (9002, [1.0]), (9003, [None] * 64), (9004, [float("nan")] * 64),
             (9005, [float("inf")] + [0.0] * 63), (None, data[8][1]), (9006, [60_000.0] + [-3.5] * 63), (9007, [0.0] * 64)]
    rows = spark.createDataFrame([(i, v, "b", "c") for i, v in data], VEC).repartition(3)
    got, centroids, scanned = heap_clusters.cluster(spark, rows, block=64)
    want, c = plain_clusters(data, 8, 10)
    assert order([tuple(r) for r in got.collect()]) == order(want)
    assert (centroids == c).all()
    assert scanned[0] == len(want) and sum(scanned[1:]) < 0.8 * len(want) * len(scanned[1:]) if spread < 0.1 else True
    full = heap_clusters.report(got, centroids).toPandas()
    assert (full.inertia == sum(d for _, _, d in want)).all()
    for k, part in full.groupby("cluster"):
        assert (part.cluster_inertia == part.distance.sum()).all()
        assert (part.centroid_sha256 == hashlib.sha256(",".join(map(str, c[k])).encode()).hexdigest()).all()


def test_clusters_of_little(spark):
    ship(spark)
    none = spark.createDataFrame([], VEC)
    rows, centroids, scanned = heap_clusters.cluster(spark, none)
    assert rows.count() == 0 and heap_clusters.report(rows, centroids).count() == 0 and scanned == []
    few = [(7, [0.5] * 64), (7, [0.5] * 64), (8, [0.25] * 64)]
    rows, centroids, _ = heap_clusters.cluster(spark, spark.createDataFrame([(i, v, "", "") for i, v in few], VEC))
    assert order([tuple(r) for r in rows.collect()]) == order(plain_clusters(few, 8, 10)[0])
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("contrail_")]
    with pytest.raises(Exception, match="do not fit 64 bits"):
        heap_clusters.cluster(spark, spark.createDataFrame([(1, [1e6] * 64, "", "")], VEC))


def test_a_round_moves_no_vector(spark):
    """The heaps' table is read beside the vectors' without an exchange."""
    with heap_clusters._bucketed(spark) as (save, _):
        a = save(spark.range(9).selectExpr("id block", "array(id) ids", "2 width", "cast('' as binary) parts"), 3, "vectors")
        b = save(spark.range(9).selectExpr("id block", "cast('' as binary) sizes", "cast('' as binary) keys",
                                           "cast('' as binary) members", "id scanned", "array('1') moved"), 3, "heaps")
        both = heap_clusters._side_by_side(spark.table(a), spark.table(b))
        assert "Exchange" not in both._jdf.queryExecution().executedPlan().toString() and both.count() == 9


def test_heaps_pop_only_what_expires():
    h = heap_clusters.Heaps([[], []])
    h.push(np.arange(6), np.array([0, 0, 0, 1, 1, 1]), np.array([5.0, 1, 3, 2, 9, 4]), np.zeros(2))
    h = heap_clusters.Heaps.read(*h.write())
    places, owners = h.expired(np.array([3.0, 1.0]))
    assert sorted(zip(places.tolist(), owners.tolist())) == [(1, 0), (2, 0)]
    assert h.expired(np.array([3.0, 1.0]))[0].size == 0


# --- search ------------------------------------------------------------------------

TERM = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")
ITEM = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("doc_id", T.LongType()), T.StructField("row", T.StringType())])


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def plain_search(docs, items, top=50):
    docs = [(i, Counter(terms(t))) for i, t in docs]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    n_docs, total = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, n in docs:
            m = 50 + 50 * n * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                    for t in set(terms(text)) if t in c)
            if s > 0:
                scored.append((s, i))
        scored.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        out += [(item, k + 1, i, s) for k, (s, i) in enumerate(scored[:top])]
    return out


def by_rank(rows):
    return sorted(rows, key=lambda t: (t[0] is None, t[0] or 0, t[1], t[3], t[2] is None, t[2] or 0))


@pytest.mark.parametrize("settings", [{}, {"top": 3, "turn": 40, "entries": 20, "bucket": 2}])
def test_search_equals_brute_force(spark, settings):
    ship(spark)
    docs = C.mixed(spark).unionByName(C.frame(spark, C.rows([C.prose(5, 60)] * 70 + [C.prose(k % 9, 40) for k in range(90)], 500)))
    items = [(k, C.prose(k, 12 + k)) for k in range(8)]
    items += [(100, None), (101, ""), (102, "?!"), (103, "NotThere xyzzy"), (None, "one TWO words é é"), (2, C.prose(2, 14)),
              (104, C.prose(99, 3_000)), (105, "the the THE same line")]
    bench = spark.createDataFrame([(i, t, 1, "r") for i, t in items], ITEM)
    got = [tuple(r) for r in fp_search.rank(spark, docs, bench, **settings).collect()]
    want = plain_search([(r.doc_id, r.text) for r in docs.collect()], items, settings.get("top", 50))
    assert by_rank(got) == by_rank(want)


def test_search_of_nothing(spark):
    ship(spark)
    none, bench = C.empty(spark), spark.createDataFrame([(1, "some text", 1, "r")], ITEM)
    assert fp_search.rank(spark, none, bench).count() == 0
    assert fp_search.rank(spark, C.mixed(spark), bench.where("false")).count() == 0
    assert fp_search.rank(spark, C.mixed(spark), bench.where("false")).schema.names == ["item_id", "rank", "doc_id", "score"]


def test_tree_leaves_out_subtrees():
    r = random.Random(4)
    ranks = lambda k: np.array(sorted(r.sample(range(200), k)))      # noqa: E731
    entries = [(ranks(6), np.ones(6, np.int64), 60, [k]) for k in range(4_000)]
    entries += [(np.array([150, 160, 170]), np.array([9, 9, 9]), 50, [9_000 + k]) for k in range(3)]
    tree = fp_search.Tree(entries, 200)
    best = fp_search.Best(2)
    seen = tree.search(np.array([150, 160, 170]), np.array([900, 900, 900]), best)
    assert sorted(i for _, i in best.rows()) == [9_000, 9_001] and seen < 2_000


def test_sql_of_the_search(spark):
    base = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{base}/{t}.parquet'")
    want = con.sql(queries.OP13_SQL).fetchall()
    got = [tuple(r) for r in queries.op13_fp_search(spark, base).collect()]
    assert by_rank(got) == by_rank(want)
