"""Scores of the quality model and the secret forest against plain Python."""

import math
import re
from bisect import bisect_left
from collections import Counter
from itertools import groupby

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from contrail.llm import quality_gam, secret_forest
from contrail.llm.shipping import ship
from tests.llm import corpus as C
from tests.llm.test_rules_and_models import TEXTS, junk, with_secret


def share(a, b):
    return a / max(b, 1)


def plain_features(text):
    text = text or ""
    w = C.words(text)
    n, chars = len(w), len(text)
    raw = text.encode()
    count = lambda pattern: len(re.findall(pattern, text))
    win = Counter(tuple(w[i:i + 5]) for i in range(n - 4))
    lines = [x for x in text.split("\n") if re.search(C.SPACE, x)]
    lone = sum(bool(re.fullmatch(r"[\x00-\x7f]", x)) and not re.fullmatch("[A-Za-z0-9]", x) for x in w)
    return [math.log1p(n), share(sum(map(len, w)), n), share(count(r"[#*$%&|<>]"), n), share(text.count("!"), n),
            share(count("[A-Z]"), count("[A-Za-z]")), share(count("[0-9]"), chars), share(count("[.,;:?]"), n),
            share(len(set(w)), n), share(max(Counter(w).values(), default=0), n),
            share(sum(c for c in win.values() if c > 1), sum(win.values())),
            share(len(lines) - len(set(lines)), len(lines)), share(n, text.count("\n") + 1), share(lone, n),
            share(sum(b >= 0x80 for b in raw), chars)]


def test_quality_features_are_plain_counts():
    got = quality_gam.features(pa.array(TEXTS + [junk(1), "A1 b! # a A1 # $"]))
    want = [plain_features(t) for t in TEXTS + [junk(1), "A1 b! # a A1 # $"]]
    for name, a, b in zip(quality_gam.FEATURES, got.T, np.array(want).T):
        assert np.allclose(a, b, rtol=0, atol=1e-12), name


def test_quality_scores_are_plain_sums_of_table_entries():
    r = np.random.default_rng(4)
    x = r.random((900, 5)).round(2)                             # ties with the bins' edges
    y = ((x[:, 0] > 0.4) ^ (x[:, 1] > 0.6) | (x[:, 2] > 0.9)).astype(float)
    m = quality_gam.train(x, y)
    assert m.pairs

    def plain(row):
        at = [bisect_left(list(e), v) for e, v in zip(m.edges, row)]
        z = m.intercept + sum(t[b] for t, b in zip(m.tables, at)) + sum(t[at[i]][at[j]] for (i, j), t in m.pairs)
        return 1 / (1 + math.exp(-min(max(z, -30), 30)))

    beyond = np.vstack([x, np.full(5, -9.0), np.full(5, 9.0)])
    assert np.allclose(m.score(beyond), [plain(row) for row in beyond], rtol=0, atol=1e-12)


def secret_docs(spark):
    texts = [with_secret(k) for k in range(60)] + [
        f"{C.prose(k, 15)} password=changeme_please 4{k:03d}{k * 98765432101 % 10**12:012d} {C.prose(k, 9)}" for k in range(60)]
    return C.frame(spark, C.rows(texts))


@pytest.mark.parametrize("depth", [2, 6])
def test_sql_forest_gives_the_models_probabilities(spark, monkeypatch, depth):
    ship(spark)
    fitted = []

    class Kept(secret_forest.RandomForestClassifier):
        def _fit(self, dataset):
            fitted.append(super()._fit(dataset))
            return fitted[-1]

    monkeypatch.setattr(secret_forest, "RandomForestClassifier", Kept)
    monkeypatch.setattr(secret_forest, "DEPTH", depth)
    docs = secret_docs(spark)
    forest = secret_forest.fit(spark, docs)
    rows = secret_forest.candidates(docs).select(F.struct("f", "label").alias("s")).select("s.f", F.expr(forest.sql).alias("sql")).collect()
    own = [fitted[0].predictProbability(Vectors.dense(r.f))[1] for r in rows]
    assert len(rows) >= 120 and len({round(p, 6) for p in own}) > 2
    assert max(abs(r.sql - p) for r, p in zip(rows, own)) < 1e-12


def kind(c):
    return 0 if "0" <= c <= "9" else 1 if "A" <= c <= "Z" else 2 if "a" <= c <= "z" else 3


def plain_secret_features(v, path):
    n = max(len(v), 1)
    of = lambda chars: sum(bool(re.fullmatch(f"[{chars}]", c)) for c in v) / n
    return {"length": len(v), "digits": of("0-9"), "upper": of("A-Z"), "lower": of("a-z"), "signs": of("+/_=."),
            "transitions": (len(list(groupby(v, kind))) - 1) / n, "distinct": len(set(v)) / n,
            "hex": int(bool(re.fullmatch("[0-9a-fA-F]+", v))),
            "coverage": 1 - len(re.sub(secret_forest.PARTS, "", v.lower())) / n,
            "letter_run": max(map(len, re.split("[^A-Za-z]+", v))),
            "path_depth": path.count("/"), "path_test": int(bool(re.search("(?i)test|example|sample|mock|doc", path)))}


def test_sql_features_are_plain_counts(spark):
    docs = secret_docs(spark).withColumn("source", F.concat(F.lit("a/Test/b"), (F.col("doc_id") % 3).cast("string")))
    rows = secret_forest.candidates(docs).collect()
    assert len(rows) >= 120
    for r in rows:
        want = plain_secret_features(r.value, f"a/Test/b{r.doc_id % 3}")
        got = dict(zip(secret_forest.NAMES, r.f))
        assert all(abs(got[k] - v) < 1e-12 for k, v in want.items()), (r.value, got, want)
