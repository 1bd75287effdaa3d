"""Quality rules as a bitmask ledger.

Every rule is evaluated once for each document and leaves its measurement and
one failure bit.  A policy is a version name and a set of rules; applying one
is a single bitwise test of the stored ledger, and an ablation of many
policies or rules is one aggregation over the bits, without reading a text.

Words are runs of other than ASCII white space, over the whole text.

Defined cases: a null text has no words and fails ``few_words``; a text below
five words has no five-word window; rows are independent (repeated rows repeat
their entry); an empty table gives an empty ledger; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm import textkernel as K
from contrail.llm.quality_gam import _FIRST, _SHOUT, _SYMBOL, repeated_lines

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_shouts")


def measures(column) -> list[np.ndarray]:
    parts = [_run_measures(w) for w in K.runs(column)]
    if not parts:
        return [np.zeros(0, np.int64)] * len(MEASURES)
    return [np.concatenate(m) for m in zip(*parts)]


def _run_measures(w: K.Words) -> tuple[np.ndarray, ...]:
    owner = w.bytes_of()
    lines, dup = repeated_lines(w)
    return (w.per_doc(w.doc), w.per_doc(owner[_FIRST[w.data] & ~w.space]), w.per_doc(owner[_SYMBOL[w.data]]),
            lines, dup, repeated_words(w), w.per_doc(owner[_SHOUT[w.data]]))


def repeated_words(w: K.Words) -> np.ndarray:
    """Words inside five-word windows that occur twice or more in their text."""
    at, h = K.windows(w)
    if len(at) == 0:
        return np.zeros(w.n, np.int64)
    order = np.lexsort((h, w.doc[at]))
    hs, ds = h[order], w.doc[at][order]
    same = (hs[1:] == hs[:-1]) & (ds[1:] == ds[:-1])
    twice = np.zeros(len(at), bool)
    twice[1:] |= same
    twice[:-1] |= same
    depth = np.zeros(len(w.doc) + 1, np.int64)
    hit = at[order][twice]
    np.add.at(depth, hit, 1)
    np.add.at(depth, hit + K.SHINGLE, -1)
    return w.per_doc(w.doc[np.cumsum(depth)[:-1] > 0])


def _rules() -> dict[str, Column]:
    """Rule -> failure; a rule's place is its bit.  New rules go at the end."""
    c = F.col
    return {
        "few_words": c("n_words") < 10,
        "repeated_words": 100 * c("n_repeat_words") > 20 * c("n_words"),
        "symbols": 10 * c("n_symbols") > c("n_words"),
        "duplicate_lines": (c("n_lines") >= 4) & (2 * c("n_dup_lines") > c("n_lines")),
        "short_words": c("word_chars") < 2 * c("n_words"),
        "long_words": c("word_chars") > 15 * c("n_words"),
        "shouts": 10 * c("n_shouts") > 3 * c("n_words"),
    }


RULES = ("few_words", "repeated_words", "symbols", "duplicate_lines", "short_words", "long_words", "shouts")
#: version -> rules that a kept document must not fail
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols"),
    "v2": ("few_words", "repeated_words", "symbols", "duplicate_lines", "long_words"),
    "v3": ("few_words", "repeated_words", "symbols", "duplicate_lines", "long_words", "shouts"),
}
CURRENT = "v3"


def mask(rules) -> int:
    return sum(1 << RULES.index(r) for r in rules)


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements, and ``failed``: bit k is set if rule k fails."""
    kind = "struct<" + ",".join(f"{m}:bigint" for m in MEASURES) + ">"

    @F.arrow_udf(kind)
    def measure(texts: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays([pa.array(m.astype(np.int64)) for m in measures(texts)], list(MEASURES))

    rows = docs.select("doc_id", measure(F.col("text")).alias("m")).select("doc_id", "m.*")
    failed = F.lit(0).cast("long")
    for bit, rule in enumerate(RULES):
        failed = failed.bitwiseOR(F.when(_rules()[rule], F.lit(1 << bit)).otherwise(F.lit(0)).cast("long"))
    return rows.withColumn("failed", failed)


def store(docs: DataFrame, path: str) -> None:
    """Evaluate every rule once and write the ledger, with the rules its bits stand for:
    later policies and ablations read numbers only."""
    entries = ledger(docs)
    named = entries.withMetadata("failed", {"rules": list(RULES)})
    named.write.mode("overwrite").parquet(path)


def stored(spark: SparkSession, path: str) -> DataFrame:
    """A stored ledger.  Rules are only ever added at the end; one that was written
    under other rules is an error, a shorter list means that the newer rules' bits
    were not evaluated, and policies that use them are refused."""
    entries = spark.read.parquet(path)
    rules = entries.schema["failed"].metadata.get("rules", [])
    if list(RULES[:len(rules)]) != rules or not rules:
        raise ValueError(f"{path} holds a ledger of other rules: {rules}")
    return entries


def _evaluated(entries: DataFrame, rules) -> None:
    known = entries.schema["failed"].metadata.get("rules", RULES)
    missing = [r for r in rules if r not in known]
    if missing:
        raise ValueError(f"the ledger has no bits for {missing}")


def fails(failed: Column, rules) -> Column:
    return failed.bitwiseAND(F.lit(mask(rules)).cast("long")) != 0


def apply_policy(entries: DataFrame, version: str = CURRENT) -> DataFrame:
    _evaluated(entries, POLICIES[version])
    return entries.withColumn("kept", ~fails(F.col("failed"), POLICIES[version]))


def ablation(entries: DataFrame, version: str = CURRENT) -> DataFrame:
    """For each rule of a policy: documents that fail it, that fail it alone
    (they would come back without it), and what the policy keeps without it."""
    rules = POLICIES[version]
    _evaluated(entries, rules)
    of_policy = F.col("failed").bitwiseAND(F.lit(mask(rules)).cast("long"))
    sums = [F.count(F.lit(1)).alias("n")]
    for r in rules:
        sums += [F.count_if(fails(F.col("failed"), [r])).alias(f"fail_{r}"),
                 F.count_if(of_policy == mask([r])).alias(f"only_{r}"),
                 F.count_if(~fails(F.col("failed"), [x for x in rules if x != r])).alias(f"kept_{r}")]
    wide = entries.agg(*sums)
    rows = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"fail_{r}").alias("n_failed"),
                              F.col(f"only_{r}").alias("n_failed_alone"),
                              F.col(f"kept_{r}").alias("n_kept_without")) for r in rules])
    return wide.select(F.lit(version).alias("version"), "n", F.explode(rows).alias("r")).select("version", "n", "r.*")
