import random

import numpy as np

from contrail.operators.quantiles import exact_quantiles, value_counts


def test_exact_quantiles_match_numpy(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice("abc"), round(rnd.gammavariate(2, 50), 2)) for _ in range(3000)]
    rows += [("a", 1e6), ("b", 5.0)] * 3 + [("d", 7.0)]  # outliers, a one-value group
    df = spark.createDataFrame(rows, "g string, x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    got = {(r.g, r.q): r.quantile for r in exact_quantiles(df, "x", probs, "g").collect()}
    for grp in "abcd":
        xs = np.array([x for g, x in rows if g == grp])
        for p in probs:
            assert got[(grp, p)] == np.percentile(xs, p * 100)
    overall = {r.q: r.quantile for r in exact_quantiles(df, "x", probs).collect()}
    allx = np.array([x for _, x in rows])
    for p in probs:
        assert overall[p] == np.percentile(allx, p * 100)


def test_one_outlier_moves_no_cut(spark):
    df = spark.range(20_000).selectExpr("'g' AS g", "CAST(id AS DOUBLE) / 7 AS x").unionByName(
        spark.createDataFrame([("g", 1e9)], "g string, x double"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in value_counts(df, "x", "g").groupBy("_b").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) > 1 and max(sizes) <= 2 * sum(sizes) / len(sizes)


def test_box_stats_reads_its_rows_once(spark, scratch):
    from contrail.operators import distributions as D
    spark.range(500).selectExpr("id % 3 AS g", "CAST(id AS DOUBLE) AS x").write.parquet(f"{scratch}/rows")
    rows = spark.read.parquet(f"{scratch}/rows")
    plan = D.box_stats(rows, "x", "g")._jdf.queryExecution().optimizedPlan().toString()
    assert f"{scratch}/rows" not in plan        # only the written value counts are left


def test_gold_does_not_expand_rows(spark):
    from contrail.operators import gold as G
    from contrail.schemas import SILVER
    plan = G.sector_aggregates(G.base_vectors(spark.createDataFrame([], SILVER)))._jdf.queryExecution()
    assert "Expand" not in plan.executedPlan().toString()
