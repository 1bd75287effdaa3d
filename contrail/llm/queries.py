"""The registered queries opN_<name> over the given tables, and their SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm import (arrow_store, best_two_fit, chunk_codec, edit_counts, fp_search, heap_clusters, kk_shards,
                          prob_minhash, quality_gam, rule_ledger, secret_forest, simhash_leaks, url_boost)
from contrail.llm.shipping import ship

#: Folder of the public vocabulary files; a parameter, they are not copied here.
TOKENIZERS = os.environ.get("CONTRAIL_TOKENIZERS", "")


def vocabulary(name: str) -> str:
    if TOKENIZERS:
        return os.path.join(TOKENIZERS, name)
    import public_tokenizers
    return public_tokenizers.path(name)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def train_rows(labels: DataFrame) -> DataFrame:
    """Labelled rows that may be learned from; the others are held out."""
    return labels.where(F.crc32(F.col("doc_id").cast("string")) % 3 != 1) \
                 .select("doc_id", F.col("quality").alias("label"))


def op1_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents, kept up to date under three edits of
    each text: a deletion after a quarter, a replacement in the middle and an
    insertion at the end."""
    path = vocabulary("byte_bpe_50k.json")
    trees = edit_counts.count_trees(read(spark, sf_dir, "documents"), path)
    n = F.length("text")
    edits = F.when(F.col("text").isNotNull(), F.array(*[
        F.struct(a.cast("int").alias("start"), b.cast("int").alias("stop"), F.lit(r).alias("replacement"))
        for a, b, r in ((n / 4, n / 4 + 24, ""), (n / 2, n / 2 + 9, " an edited span, "), (n, n, "\nthe end"))]))
    edited = edit_counts.apply_edits(trees.withColumn("edits", edits), F.col("edits"), path)
    return edited.select("doc_id", "n_tokens_before", "n_tokens", "n_edits", F.length("text").alias("n_chars"),
                         "reencoded_chars", F.crc32("text").alias("text_crc32"))


def op2_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = quality_gam.fit(docs, train_rows(read(spark, sf_dir, "labels")))
    rows = docs.select("doc_id", (F.crc32(F.col("doc_id").cast("string")) % 3 == 1).alias("held_out"),
                       quality_gam.score_column(F.col("text"), model).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op3_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = rule_ledger.ledger(read(spark, sf_dir, "documents"))
    kept = rule_ledger.apply_policy(entries)
    return kept.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       rule_ledger.fails(F.col("failed"), rule_ledger.POLICIES["base"]).alias("base_failed"),
                       "kept", "n_lines", "n_shouts", "failed")


def op4_prob_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prob_minhash.classes(spark, read(spark, sf_dir, "documents"))


def op5_url_boost(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return url_boost.judge(pages, url_boost.fit(pages))


def op6_arrow_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = arrow_store.write(spark, read(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), 1,
                                 arrow_store.store_folder(spark))
    return arrow_store.read(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_simhash_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_leaks.leaks(spark, read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", (F.size("hits") > 0).alias("contaminated"), F.size("hits").alias("n_items"),
                        F.array_sort(F.transform("hits", lambda h: h.item_id)).alias("item_ids"),
                        F.array_max(F.transform("hits", lambda h: h.similarity)).alias("similarity"))


def op8_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return secret_forest.scan(docs, secret_forest.fit(spark, docs))


def op9_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = best_two_fit.pack(spark, read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), 2)
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op10_kk_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = kk_shards.shard(spark, read(spark, sf_dir, "documents"))
    return made.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))


def op11_chunk_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary("byte_bpe_50k.json")
    rows = read(spark, sf_dir, "documents").select("doc_id", chunk_codec.encoded(F.col("text"), path).alias("ids"))
    rows = rows.withColumn("decoded", chunk_codec.decoded(F.col("ids"), path))
    return rows.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_heap_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, centroids, _ = heap_clusters.cluster(spark, read(spark, sf_dir, "embeddings"))
    return heap_clusters.report(rows, centroids)


def op13_fp_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fp_search.rank(spark, read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_edit_counts, op2_quality_gam, op3_rule_ledger, op4_prob_minhash, op5_url_boost, op6_arrow_store,
           op7_simhash_leaks, op8_secret_forest, op9_best_two_fit, op10_kk_shards, op11_chunk_codec, op12_heap_clusters,
           op13_fp_search, pipeline)
    return {q.__name__: q for q in own}


_SPACE = r"\x20\x09-\x0D"

#: The ledger's measurements and policy v3, by window functions over words.
OP3_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT r, doc_id, text, regexp_extract_all(text, '[^{_SPACE}]+') AS ws FROM d),
win AS (
  SELECT r, unnest(range(1, len(ws) - 3)) AS i, ws FROM w WHERE len(ws) >= 5),
keyed AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, array_to_string(ws[i:i + 4], ' ')) AS n FROM win),
repeated AS (
  SELECT r, count(*) AS n_repeat_words FROM (
    SELECT DISTINCT r, i + k AS word FROM keyed, (SELECT unnest(range(0, 5)) AS k) WHERE n > 1) GROUP BY r),
line AS (
  SELECT r, unnest(string_split(text, chr(10))) AS line FROM d),
lines AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM line WHERE regexp_matches(line, '[^{_SPACE}]') GROUP BY r),
m AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words,
         length(array_to_string(ws, ''))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         coalesce(n_lines, 0)::BIGINT AS n_lines,
         (length(text) - length(replace(text, '!', '')))::BIGINT AS n_shouts
  FROM w LEFT JOIN repeated USING (r) LEFT JOIN lines USING (r)),
f AS (
  SELECT *, n_words < 10 AS f0, 100 * n_repeat_words > 20 * n_words AS f1, 10 * n_symbols > n_words AS f2,
         n_lines >= 4 AND 2 * n_dup_lines > n_lines AS f3, word_chars < 2 * n_words AS f4,
         word_chars > 15 * n_words AS f5, 10 * n_shouts > 3 * n_words AS f6
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f0 OR f1 AS base_failed,
       NOT (f0 OR f1 OR f2 OR f3 OR f5 OR f6) AS kept, n_lines, n_shouts,
       (f0::INT + 2 * f1::INT + 4 * f2::INT + 8 * f3::INT + 16 * f4::INT + 32 * f5::INT + 64 * f6::INT)::BIGINT AS failed
FROM f
"""


_LOWER, _TERMS = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')", \
    r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Postings, weights and scores by joins; integers are wide until the end.
OP13_SQL = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all({_LOWER}, '{_TERMS}') AS ws
  FROM documents WHERE text IS NOT NULL),
items AS (SELECT row_number() OVER () AS q, item_id,
    list_distinct(regexp_extract_all({_LOWER}, '{_TERMS}')) AS ws
  FROM benchmark WHERE text IS NOT NULL),
stat AS (SELECT count(*)::HUGEINT AS n_docs, sum(len(ws))::HUGEINT AS n_terms FROM docs WHERE len(ws) > 0),
asked AS (SELECT q, item_id, unnest(ws) AS term FROM items),
words AS (SELECT r, unnest(ws) AS term FROM docs),
posted AS (SELECT r, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY r, term),
weights AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::HUGEINT AS w
  FROM (SELECT term, count(*) AS df FROM posted GROUP BY term), stat),
lengths AS (SELECT r, doc_id, 50 + (50 * len(ws)::HUGEINT * n_docs) // n_terms AS m FROM docs, stat),
scored AS (SELECT q, item_id, doc_id, sum(w * ((1000000000 * tf::HUGEINT) // (1000 * tf + 20 * m))) AS score
  FROM asked JOIN posted USING (term) JOIN weights USING (term) JOIN lengths USING (r) GROUP BY q, item_id, r, doc_id),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score::BIGINT AS score FROM ranked WHERE rank <= 50
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_rule_ledger": OP3_SQL, "op13_fp_search": OP13_SQL}
