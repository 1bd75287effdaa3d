"""Near duplicates, benchmark leaks, shards, the pipeline: against brute force."""

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from contrail.llm import kk_shards, prob_minhash, simhash_leaks, textkernel
from contrail.llm import textkernel as K
from contrail.llm.shipping import ship
from tests.llm import corpus as C


def plain_jaccard(a, b):
    """Probability Jaccard similarity by its definition."""
    v, w = Counter(C.shingles(a)), Counter(C.shingles(b))
    total = 0.0
    for d in v.keys() & w.keys():
        total += 1 / sum(max(v[e] / v[d], w[e] / w[d]) for e in v.keys() | w.keys())
    return total


def edit(text, k, r):
    w = text.split()
    for _ in range(k):
        w[r.randrange(len(w))] = f"w{r.randrange(10**6)}"
    return " ".join(w)


def test_probability_jaccard_is_exact():
    r = random.Random(1)
    for k in range(60):
        a = C.prose(k, 40)
        b = edit(a, r.randint(0, 3), r)
        if k % 2:
            a, b = a + (" x y z u v" * r.randint(0, 4)), b + (" x y z u v" * r.randint(0, 4))
        (x, n), (y, m) = prob_minhash._shingle_sets(pa.array([a, b]))
        assert prob_minhash.probability_jaccard(x, n, y, m) == pytest.approx(plain_jaccard(a, b))


def test_registers_estimate_the_similarity():
    a = C.prose(1, 400) + " p q r s t" * 5
    b = " ".join(a.split()[:330]) + " " + C.prose(2, 60)
    doc, h, n = K.weighted(*K.shingles(next(K.runs(pa.array([a, b])))))
    sig = prob_minhash.signatures(doc, h, n, 2, 4000)
    assert (sig[0] == sig[1]).mean() == pytest.approx(plain_jaccard(a, b), abs=0.03)


def brute_classes(texts, similarity=0.8):
    """Index classes of distinct non-null texts."""
    own = sorted({t for t in texts if t is not None})
    up = {t: t for t in own}

    def find(t):
        while up[t] != t:
            t = up[t]
        return t
    for i, a in enumerate(own):
        for b in own[:i]:
            if set(C.shingles(a)) & set(C.shingles(b)) and plain_jaccard(a, b) >= similarity:
                up[find(a)] = find(b)
    return {t: find(t) for t in own}


def near_corpus():
    r = random.Random(4)
    base = C.prose(500, 60)
    family = [base] + [edit(base, r.randint(1, 4), r) for _ in range(40)]
    chain = [C.prose(501, 50)]
    for _ in range(6):
        chain.append(edit(chain[-1], 1, r))
    copies = [C.prose(502, 30)] * 12
    other = [C.prose(600 + k, 25) for k in range(15)] + ["one two three", "one two three", "one two four"]
    return family + chain + copies + other + [t for t in C.ODD if t is not None] + ["", " "]


def classes_of(rows, texts):
    got = defaultdict(set)
    for r in rows:
        got[r.class_id].add(r.doc_id)
    assert all(c == min(ids) for c, ids in got.items())
    named = brute_classes(texts)
    want = defaultdict(set)
    for i, t in enumerate(texts):
        want[("null", i) if t is None else named[t]].add(i)
    return {frozenset(x) for x in got.values()}, {frozenset(x) for x in want.values()}


def test_classes_equal_brute_force(spark):
    ship(spark)
    texts = near_corpus() + [None, None]
    docs = C.frame(spark, C.rows(texts))
    for block in (512, 4):          # large buckets in many blocks give the same classes
        got, want = classes_of(prob_minhash.classes(spark, docs, block=block).collect(), texts)
        assert got == want
    kept = prob_minhash.dedup(spark, docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(min(x) for x in want)


def test_dedup_of_awkward_rows(spark):
    ship(spark)
    docs = C.mixed(spark)
    kept = prob_minhash.dedup(spark, docs).collect()
    texts = [r.text for r in kept]
    assert len(set(texts)) + texts.count(None) - 1 == len(texts)        # texts once, null texts all
    assert set(texts) == {r.text for r in docs.collect()}
    assert prob_minhash.classes(spark, docs).count() == docs.count()
    none = C.empty(spark)
    assert prob_minhash.dedup(spark, none).count() == prob_minhash.classes(spark, none).count() == 0


def test_block_links_span_classes_only():
    texts = [C.prose(1, 60)] * 2 + [C.prose(2, 60)]
    texts.append(edit(texts[0], 1, random.Random(1)))
    sets = prob_minhash._shingle_sets(pa.array(texts))
    links = prob_minhash.block_links(sets, ["a", "b", "c", "d"], [0, 1, 2, 3])
    assert len(links) == 2 and 2 not in {i for x in links for i in x}
    assert prob_minhash.block_links(sets, ["a", "a", "c", "a"], [0, 1, 2, 3]) == []


def brute_leaks(text, items, similarity=0.8):
    out = {}
    s = C.shingles(text)
    for i, t in items:
        want = Counter(C.shingles(t))
        if not want:
            continue
        n = min(max(len(C.words(t)) - 4, 1), len(s))
        for k in range(len(s) - n + 1):
            have = Counter(s[k:k + n])
            both = sum((have & want).values())
            value = both / (n + sum(want.values()) - both) if n else 0
            if value >= similarity and value > out.get(i, 0):
                out[i] = value
    return out


def test_leaks_equal_brute_force(spark):
    ship(spark)
    r = random.Random(2)
    items = [(k, C.prose(700 + k, r.randint(10, 50))) for k in range(12)]
    items += [(50, items[0][1]), (51, None), (52, ""), (53, "only three words"), (54, "a b c d e a b c d e a b")]
    texts = []
    for k in range(12):
        w = items[k][1].split()
        for _ in range(k % 4):
            w[r.randrange(len(w))] = "changed"
        texts.append(f"{C.prose(k, 30)} {' '.join(w)}\n{C.prose(k + 50, 30)}")
    texts += [items[3][1], " ".join(items[4][1].split()[:-1]), "only three words", "and only three words here",
              "z a b c d e a b c d e a b z", f"{items[5][1]} {items[6][1]} {items[5][1]}"] + C.ODD
    docs = C.frame(spark, C.rows(texts))
    bench = spark.createDataFrame(items + [items[1]], "item_id long, text string")
    for block in (2000, 5):         # several index blocks give the same
        for row in simhash_leaks.leaks(spark, docs, bench, block).collect():
            assert {h.item_id: pytest.approx(h.similarity) for h in row.hits} == brute_leaks(texts[row.doc_id], items), row
        kept = {row.doc_id for row in simhash_leaks.clean(spark, docs, bench, block).collect()}
        assert kept == {i for i, t in enumerate(texts) if not brute_leaks(t, items)}
    assert simhash_leaks.leaks(spark, C.empty(spark), bench).count() == 0
    nothing = bench.where("false")
    assert simhash_leaks.clean(spark, docs, nothing).count() == len(texts)


def test_multi_index_finds_all_within_the_radius():
    r = np.random.default_rng(3)
    prints = r.integers(0, 2**63, 200, dtype=np.uint64)
    index = simhash_leaks.Index.of([0], [C.prose(1, 30)])
    flips = np.zeros(200, np.uint64)
    for k in range(200):
        for b in r.choice(64, r.integers(0, 40), replace=False):
            flips[k] |= np.uint64(1) << np.uint64(b)
    prints = index.prints[0] ^ flips
    want = np.flatnonzero(np.bitwise_count(flips) <= simhash_leaks.RADIUS)
    assert index.near(prints, 0).tolist() == want.tolist()


def test_multi_index_of_many_items():
    """No pair within the radius is lost, and a random fingerprint passes the tables for
    at most 40 % of the items; items of other sizes are not looked at."""
    r = np.random.default_rng(4)
    index = simhash_leaks.Index.of(range(60), [C.prose(k, (20, 30, 45)[k % 3]) for k in range(60)])
    assert index.size.tolist() == sorted(index.size.tolist())
    prints = r.integers(0, 2**63, 9000, dtype=np.uint64) * np.uint64(2) + r.integers(0, 2, 9000, dtype=np.uint64)
    for k in range(4500):               # half of them at 0 to 30 bits from an item
        prints[k] = index.prints[k % 60]
        for b in r.choice(64, r.integers(0, 31), replace=False):
            prints[k] ^= np.uint64(1) << np.uint64(b)
    for lo, hi in ((0, 60), (20, 40), (19, 20), (59, 60)):
        apart = np.bitwise_count(prints[:, None] ^ index.prints[None, lo:hi])
        want = {(int(w), int(i) + lo) for w, i in zip(*np.nonzero(apart <= simhash_leaks.RADIUS))}
        assert set(index.near_pairs(prints, lo, hi)) == want
    window, _ = index.candidates(prints[4500:], 0, 60)
    assert 0.3 < len(window) / (4500 * 60) < 0.4


@pytest.mark.parametrize("n, changed", [(164, 13), (204, 18), (304, 29), (404, 36)])
def test_leaks_with_repeated_shingles(n, changed):
    for seed in range(8):
        item = [f"w{seed}x{k}" for k in range(n)]
        held = item[:n // 2] + ["***"] * changed + item[n // 2 + changed:]
        around = C.prose(seed, 20)
        for a, b in ((item, held), (held, item)):           # the document or the item repeats a shingle
            text, asked = f"{around} {' '.join(b)} {around}", [(7, " ".join(a))]
            want = brute_leaks(text, asked)
            assert want
            got = simhash_leaks.Index.of([7], [asked[0][1]]).search(pa.array([text]))[0]
            assert {x["item_id"]: pytest.approx(x["similarity"]) for x in got} == want


def test_running_overlap_equals_each_window():
    r = random.Random(5)
    for _ in range(60):
        item, text = (" ".join(r.choices("abc", [6, 1, 1], k=r.randint(5, 30))) for _ in range(2))
        index = simhash_leaks.Index.of([0], [item])
        for w in textkernel.runs(pa.array([text])):
            _, h = textkernel.shingles(w)
        k = np.minimum(np.searchsorted(index.shingles, h), len(index.shingles) - 1)
        k = np.where(index.shingles[k] == h, k, -1)
        n = min(int(index.size[0]) - 4, len(h))
        assert index.running(k, 0, n).tolist() == [index.overlap(h[s:s + n], 0) for s in range(len(h) - n + 1)]


def test_differencing_combines_the_largest_spreads():
    sums = np.array([[8, 0], [7, 0], [6, 0], [5, 0], [4, 0]])
    top, place = kk_shards.difference(sums)
    assert top.tolist() == [16, 14]                     # the known result of differencing
    got = [0, 0]
    for s, p in zip(sums, place):
        got[p[0]] += s[0]
    assert sorted(got, reverse=True) == top.tolist()


def test_shards(spark):
    texts = [C.prose(k, 5 + k % 40) for k in range(300)] + [C.prose(1, 6)] * 30 + C.ODD + ["", None]
    data = C.rows(texts)
    docs = C.frame(spark, data + [data[3], data[3]])
    for items in (8192, 30):        # every group an item, or packages of light groups
        got = kk_shards.shard(spark, docs, k=4, items=items).toPandas()
        assert len(got) == len(data) + 2
        size = [len((t or "").encode()) + 1 for t in texts]
        assert all(size[r.doc_id] == r.size for r in got.itertuples())
        sums = got.groupby("shard")["size"].sum()
        assert len(sums) == 4 and sums.max() - sums.min() <= sum(size) / 50
        got["text"] = [texts[i] or "" for i in got.doc_id]
        assert (got.groupby("text").shard.nunique() == 1).all()
        for _, g in got.groupby("shard"):
            assert sorted(g.slot) == list(range(len(g)))
    assert kk_shards.shard(spark, C.empty(spark)).count() == 0
    # one group of more than a shard's share has a shard for itself
    hot = C.frame(spark, C.rows(["hot " * 50] * 200 + [C.prose(k, 20) for k in range(100)]))
    got = kk_shards.shard(spark, hot, k=4).toPandas()
    own = got[got.doc_id < 200].shard.unique()
    assert len(own) == 1 and (got[got.doc_id >= 200].shard != own[0]).all()
    rest = got[got.doc_id >= 200].groupby("shard")["size"].sum()
    assert rest.max() - rest.min() <= got["size"].max()


def test_pipeline_stages(spark, scratch):
    import corpus_pipeline as P
    from contrail.llm import secret_forest

    r = random.Random(9)
    good = [C.prose(k, 60) for k in range(40)]
    bench = [C.prose(900 + k, 30) for k in range(3)]
    junk = [" ".join(w + "$$$" for w in C.prose(300 + k, 40).split()) for k in range(20)]
    secret = [f"{C.prose(400 + k, 30)} password={k:02d}97f409e51a76f6b0 {C.prose(450 + k, 30)}" for k in range(5)]
    near = [edit(good[0], 1, r), good[1]]
    leaked = [f"{C.prose(800, 40)} {bench[0]} {C.prose(801, 40)}"]
    texts = good + junk + secret + near + leaked
    data = [row[:5] for row in C.rows(texts)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame([(i, int(not (40 <= i < 60)), 0) for i in range(len(texts))],
                          "doc_id long, quality int, toxic int").write.parquet(f"{scratch}/labels.parquet")
    spark.createDataFrame(list(enumerate(bench)), "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    assert [name for name, _ in P.STAGES] == ["quality", "near_duplicates", "decontamination", "secrets", "packing"]
    now, left = spark.read.parquet(f"{scratch}/documents.parquet"), []
    for name, stage in P.STAGES[:-1]:
        out = f"{scratch}/{name}"
        stage(spark, now, scratch).write.parquet(out)
        now = spark.read.parquet(out)
        assert now.columns == docs.columns
        left.append({row.doc_id: row.text for row in now.collect()})
    n = len(texts)
    assert set(left[0]) == set(range(n)) - set(range(40, 60))
    assert set(left[1]) == set(left[0]) - {65, 66}
    assert set(left[2]) == set(left[1]) - {67}
    assert set(left[3]) == set(left[2])
    assert all(secret_forest.MARK in left[3][i] for i in range(60, 65))
    assert all(left[3][i] == texts[i] for i in range(40))
    packed = P.run(spark, scratch).toPandas()
    tokens = packed.groupby("doc_id").length.sum().to_dict()
    assert tokens == {i: len(C.ids(C.BYTE, t)) + 1 for i, t in left[3].items()}
