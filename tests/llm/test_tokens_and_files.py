"""Token ids, Arrow files, packing and edit-aware counts against plain versions."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from contrail.llm import arrow_store, best_two_fit, edit_counts
from contrail.llm.tokens import Encoder
from contrail.llm.shipping import ship
from tests.llm import corpus as C


def key(doc_id, text):
    return (doc_id is not None, doc_id or 0, text or "")


@pytest.mark.parametrize("path", [C.BYTE, C.WORD])
def test_pieces_give_the_ids_of_whole_texts(path):
    e = Encoder(path, table_limit=50)       # the table empties again and again
    r = random.Random(3)
    texts = [t for t in C.ODD if t] + [C.prose(k, 80) for k in range(20)]
    texts += ["".join(r.choices("ab \n\t.'$1\u00e9\u00a0S", k=r.randint(1, 30))) for _ in range(3000)]
    for t in texts:
        assert e.encode(t) == e.whole(t), repr(t)
    assert e.encode(None) == e.encode("") == b""


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_arrow_files_hold_the_stream(spark, scratch):
    ship(spark)
    docs = C.mixed(spark)
    manifest = arrow_store.write(spark, docs, C.WORD, 1, f"file://{scratch}/store", seq_len=64, batch=4)
    got = arrow_store.read(manifest).toPandas()
    have = sorted(((None if r.doc_id is None else r.doc_id, r.text) for r in docs.collect()), key=lambda x: key(*x))
    assert len(got) == len(have)
    want = defaultdict(list)
    for i, t in have:
        ids = C.ids(C.WORD, t) + [1]
        want[i].append((len(ids), crc(ids)))
    at = 0
    for r in got.sort_values("start").itertuples():
        i = None if np.isnan(r.doc_id) else int(r.doc_id)
        assert r.start == at
        want[i].remove((r.n_tokens, zlib.crc32(r.ids)))
        at += r.n_tokens
    assert not any(want.values())
    order = got.sort_values("start").doc_id.dropna()
    assert list(order) == sorted(order)
    # sequences: equal length, masks only false on the padding of a file's end
    for f in manifest.collect():
        shard, seen = arrow_store.Shard(f"{f.path}.arrow"), 0
        n = -(-f.n_tokens // 64)
        stream = []
        for k in reversed(range(n)):        # random access, any order
            ids, mask = shard.sequence(k)
            assert len(ids) == len(mask) == 64
            seen += mask.sum()
            stream.insert(0, ids[mask])
        assert seen == f.n_tokens
        assert (np.concatenate(stream) == shard.ids(0, f.n_tokens)).all()


def test_arrow_files_of_nothing_and_again(spark, scratch):
    ship(spark)
    manifest = arrow_store.write(spark, C.empty(spark), C.WORD, 1, f"{scratch}/none")
    assert manifest.count() == 0 and arrow_store.read(manifest).count() == 0
    docs = C.frame(spark, C.rows(["b", "a"]))
    for _ in range(2):                      # a repeated attempt replaces the files
        m = arrow_store.write(spark, docs, C.WORD, 1, f"{scratch}/twice")
        assert [r.doc_id for r in arrow_store.read(m).orderBy("start").collect()] == [0, 1]


def test_best_two_fit_exchanges_the_smallest():
    # greedy 6 + 3 leaves 1; the pair 2 + 2 fills the gap of 4 that the 3 leaves
    where, offset = best_two_fit.best_two_fit([6, 3, 2, 2], 10)
    assert where.tolist() == [0, 1, 0, 0]
    assert sorted(offset[[0, 2, 3]].tolist()) == [0, 6, 8]


@pytest.mark.parametrize("seed", range(5))
def test_best_two_fit_is_a_packing(seed):
    r = random.Random(seed)
    lengths = [r.randint(1, 64) for _ in range(r.choice([0, 1, 7, 500]))]
    where, offset = best_two_fit.best_two_fit(lengths, 64)
    fill = defaultdict(list)
    for n, b, o in zip(lengths, where.tolist(), offset.tolist()):
        fill[b].append((o, n))
    for parts in fill.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 64
    least = -(-sum(lengths) // 64)
    # never worse than first fit in falling order
    bins = []
    for n in sorted(lengths, reverse=True):
        k = next((k for k, b in enumerate(bins) if b + n <= 64), None)
        if k is None:
            bins.append(n)
        else:
            bins[k] += n
    assert least <= len(fill) <= len(bins) + 1
    with pytest.raises(ValueError):
        best_two_fit.best_two_fit([65], 64)


def test_packing_round_trip(spark):
    ship(spark)
    docs = C.mixed(spark)
    got = best_two_fit.pack(spark, docs, C.BYTE, 2, size=128, group=8).toPandas()
    want = defaultdict(int)
    for r in docs.collect():
        ids = C.ids(C.BYTE, r.text) + [2]
        short = (len(ids) - 1) % 128 + 1
        cuts = [0, *range(short, len(ids) + 1, 128)]
        for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[r.doc_id, p, a, b - a, crc(ids[a:b])] += 1
    have = defaultdict(int)
    for r in got.itertuples():
        have[None if np.isnan(r.doc_id) else int(r.doc_id), r.piece, r.start, r.length, zlib.crc32(r.ids)] += 1
    assert have == want
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert list(g.offset) == [0, *np.cumsum(g.length)[:-1]] and g.length.sum() <= 128
    assert best_two_fit.pack(spark, C.empty(spark), C.BYTE, 2).count() == 0


def test_packing_of_short_pieces_leaves_few_part_full(spark):
    ship(spark)
    docs = C.frame(spark, C.rows([C.prose(k, 1 + k % 5) for k in range(1500)]))
    got = best_two_fit.pack(spark, docs, C.BYTE, 2, size=256, group=8).toPandas()
    assert sorted(got.doc_id) == list(range(1500))
    fill = got.groupby("sequence_id").length.sum()
    assert fill.max() <= 256
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert list(g.offset) == [0, *np.cumsum(g.length)[:-1]]
    groups = -(-got.length.sum() // (8 * 256 // 4))
    assert groups > 10
    # a group holds about two sequences, so without the second round each leaves a remainder
    assert len(fill) <= -(-got.length.sum() // 256) + groups // 3


def edited(text, edits):
    out, free, shift = text or "", 0, 0
    for e in sorted(edits, key=lambda e: (e[0], e[1])):
        a = max(e[0], free)
        b = max(a, e[1])
        a, b, free = a, b, b
        a, b = min(a + shift, len(out)), min(b + shift, len(out))
        new = out[:a] + e[2] + out[b:]
        shift += len(new) - len(out)
        out = new
    return out


@pytest.mark.parametrize("path", [C.BYTE, C.WORD])
def test_edits_equal_a_full_recount(path):
    e = Encoder(path)
    count, cut = (lambda t: len(e.encode(t)) // 4), edit_counts.cutter(e.kind)
    r = random.Random(5)
    for k in range(150):
        text = r.choice(["", C.prose(k, r.randint(1, 400)), r.choice(C.ODD) or "",
                         "".join(r.choices("ab \n\t.'1", k=200))])
        tree = edit_counts.Tree(text, count, cut, leaf_chars=32)
        assert tree.total == count(text)
        for _ in range(6):
            a = r.randint(0, len(text))
            b = min(len(text), a + r.randint(0, 20))
            new = r.choice(["", " ", "\n", "word", " two words", "'s", C.prose(a, 40)])
            tree.edit(a, b, new)
            text = text[:a] + new + text[b:]
            assert tree.text == text and tree.total == count(text), (text, a, b, new)


ODD_JOINS = ["\n", "  ", "\n\n", " \t", "\r\n", "", "。", "'s ", "\u3000", "\u00a0", ", ", "1", "'", " \n "]


@pytest.mark.parametrize("path", [C.BYTE, C.WORD])
def test_cuts_are_certain(path):
    """A text is encoded as its parts are, wherever it is cut."""
    e, r = Encoder(path), random.Random(8)
    count, cut = edit_counts._tools(path)
    words = ["the", "Wort", "straße", "漢字", "の", "한국어", "東京都", "it's", "we'll", "42", "!?", "a", "🛩", "é", "'s"]
    for _ in range(400):
        text = "".join(r.choice(words) + r.choice([" ", *ODD_JOINS]) for _ in range(r.randint(1, 30)))
        at = 0
        while (k := cut(text, at + 1, len(text))) < len(text):
            assert e.encode(text[:k]) + e.encode(text[k:]) == e.encode(text), (text, k)
            at = k


@pytest.mark.parametrize("kind", ["line", "double", "single", "han"])
def test_edits_stay_local(kind):
    """A small edit and an insertion encode little more than themselves again."""
    e, r = Encoder(C.BYTE), random.Random(4)
    count, cut = edit_counts._tools(C.BYTE)
    if kind == "han":
        text = "".join(chr(0x4E00 + int(3000 * r.random() ** 2)) for _ in range(20_000))
    else:
        text = {"line": "\n", "double": "  ", "single": " "}[kind].join(C.prose(1, 40_000).split())[:200_000]
    tree = edit_counts.Tree(text, count, cut)
    n = len(text)
    assert tree.total == len(e.encode(text)) // 4 and n >= 20_000
    tree.edit(n // 2, n // 2 + 3, "xyz")
    small = tree.reencoded
    tree.edit(n // 3, n // 3, text[:1800])
    assert small <= 0.05 * n and tree.reencoded - small <= 1800 + 0.05 * n
    tree.edit(n // 3 + 900, n // 3 + 950, "")
    assert tree.total == len(e.encode(tree.text)) // 4
    assert tree.sums[1] == sum(tree.sums[len(tree.sums) // 2:])


def test_edit_operator(spark):
    ship(spark)
    docs = C.mixed(spark)
    trees = edit_counts.count_trees(docs, C.BYTE)
    edits = [(10, 14, "NEW"), (2, 3, ""), (12, 20, " x "), (10**6, 10**6, " tail")]
    column = F.array(*[F.struct(F.lit(a).alias("start"), F.lit(b).alias("stop"), F.lit(t).alias("replacement"))
                       for a, b, t in edits])
    got = edit_counts.apply_edits(trees.withColumn("edits", column), F.col("edits"), C.BYTE)
    for r in got.join(docs.select("doc_id", F.col("text").alias("was")).dropDuplicates(["doc_id"]), "doc_id").collect():
        if r.doc_id == 15:
            continue
        assert r.text == edited(r.was, edits)
        assert r.n_tokens == len(C.ids(C.BYTE, r.text)) and r.n_tokens_before == len(C.ids(C.BYTE, r.was))
    assert got.count() == docs.count()
    long = got.where("doc_id = 24").first()
    assert 0 < long.reencoded_chars < len(long.text) / 10
    # a table of edits: documents it lacks stay
    table = spark.createDataFrame([(4, [(0, 3, "three")])], "doc_id long, edits " + edit_counts.EDIT_TYPE)
    some = edit_counts.apply_edits(trees, table, C.BYTE).where("doc_id in (4, 5)").orderBy("doc_id").collect()
    assert [(r.text, r.n_edits) for r in some] == [("three", 1), ("two words", 0)]
    assert edit_counts.count_trees(C.empty(spark), C.BYTE).count() == 0
