"""The pipeline's stages on awkward rows, with an account of every row."""

from collections import Counter

import numpy as np
import pyarrow as pa

import corpus_pipeline as P
from contrail.llm import quality_gam, secret_forest, simhash_leaks
from contrail.llm.queries import train_rows
from tests.llm import corpus as C

SECRET = "97f409e51a76f6b0a1"


def tables(spark, folder, data, bench):
    spark.createDataFrame(data, C.DOCS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(not 30 <= i < 50), 0) for i in range(60)] + [(None, 1, 0), (3, None, 0), (10**9, 0, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(bench)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def stages(spark, folder):
    """Columns and rows (doc_id, text) after each filtering stage, the input first."""
    now = spark.read.parquet(f"{folder}/documents.parquet")
    out = [(now.columns, [(r.doc_id, r.text) for r in now.collect()])]
    for name, stage in P.STAGES[:-1]:
        stage(spark, now, folder).write.parquet(f"{folder}/out-{name}")
        now = spark.read.parquet(f"{folder}/out-{name}")
        out.append((now.columns, [(r.doc_id, r.text) for r in now.collect()]))
    packed = P.packing(spark, now, folder).collect()
    return out, packed


def test_every_row_is_accounted_for(spark, scratch):
    bench = [C.prose(900, 30), None, "", C.prose(901, 25)]
    texts = [C.prose(k, 60) for k in range(30)] + [" ".join(w + "$$$" for w in C.prose(300 + k, 40).split()) for k in range(20)]
    texts += C.ODD + [C.prose(99, 20_000), f"{C.prose(70, 40)} password={SECRET} {C.prose(71, 40)}",
                      f"{C.prose(72, 40)} {bench[0]} {C.prose(73, 40)}"]
    long, secret, leaked = (len(texts) - k for k in (3, 2, 1))
    data = C.rows(texts)
    data += [data[5], data[5], (6, texts[7]) + data[6][2:], (5, C.prose(74, 50)) + data[5][2:],
             (None, C.prose(75, 50)) + data[5][2:], (None, None) + data[5][2:]]
    tables(spark, scratch, data, bench)
    (first, *kept), packed = stages(spark, scratch)
    assert all(columns == first[0] == C.DOCS.fieldNames() for columns, _ in kept)
    given, quality, unique, clean, redacted = (rows for _, rows in [first, *kept])

    # quality: exactly the rows that the model accepts, copies and null texts judged alike
    docs = spark.read.parquet(f"{scratch}/documents.parquet")
    model = quality_gam.fit(docs, train_rows(spark.read.parquet(f"{scratch}/labels.parquet")))
    score = model.score(quality_gam.features(pa.array([t for _, t in given], pa.string())))
    assert Counter(quality) == Counter(row for row, s in zip(given, score) if s >= 0.5)
    assert {i for i, _ in quality} >= set(range(30)) | {long, secret, leaked} and not {i for i, _ in quality} & set(range(30, 50))

    # near duplicates: every text once, null texts all, copies at their smallest id
    assert Counter(t for _, t in unique if t is not None) == Counter({t for _, t in quality if t is not None})
    assert [t for _, t in unique].count(None) == [t for _, t in quality].count(None)
    assert Counter(unique) - Counter(quality) == Counter() and (6, texts[7]) in unique and (7, texts[7]) not in unique

    # decontamination: one row goes, null and empty items find nothing
    assert Counter(unique) - Counter(clean) == Counter([(leaked, texts[leaked])]) and len(clean) == len(unique) - 1
    # secrets: all rows stay, one text changes
    changed = texts[secret].replace(SECRET, secret_forest.MARK)
    assert Counter(redacted) == Counter((i, changed if i == secret else t) for i, t in clean)

    # packing: every token of every row, sequences without gaps or overlaps
    tokens = Counter()
    for i, t in redacted:
        tokens[i] += len(C.ids(C.BYTE, t)) + 1
    got, places = Counter(), {}
    for r in packed:
        got[r.doc_id] += r.length
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert got == tokens
    for at in places.values():
        at.sort()
        ends = np.cumsum([n for _, n in at])
        assert [o for o, _ in at] == [0, *ends[:-1]] and ends[-1] <= 1024


def test_empty_documents_pass_through(spark, scratch):
    tables(spark, scratch, [], [C.prose(1, 20)])
    out, packed = stages(spark, scratch)
    assert all(columns == C.DOCS.fieldNames() and rows == [] for columns, rows in out) and packed == []
    assert P.run(spark, scratch).count() == 0


def test_an_empty_benchmark_keeps_all(spark, scratch):
    docs = C.mixed(spark)
    none = spark.createDataFrame([], "item_id long, text string")
    assert simhash_leaks.clean(spark, docs, none).count() == docs.count()
