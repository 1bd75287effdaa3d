import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from contrail.operators import distributions as D
from contrail.operators import insights as I
from contrail.operators import quality as Q
from contrail.schemas import GOLD

H = dt.datetime(2024, 1, 1, 5)


def gold_rows(spark, rows):
    full = []
    for i, (country, phase, uniq, air, speed, alt) in enumerate(rows):
        full.append((H, country, f"s{i:03d}", 1.0, 2.0, phase, uniq, uniq, air, uniq - air,
                     alt, alt, alt, speed, 1))
    return spark.createDataFrame(full, GOLD)


def test_kpis_and_ties(spark):
    g = gold_rows(spark, [("B", "Mid Altitude", 3, 2, 100.0, 20000.0),
                          ("A", "Mid Altitude", 1, 1, None, 21000.0),
                          ("B", "High Cruise", 2, 2, 300.0, 30000.0),
                          ("A", "High Cruise", 5, 5, 200.0, 31000.0)])
    k = I.kpi_cards(g).first()
    assert (k.total_tracked_aircraft, k.airborne_aircraft_volume) == (11, 10)
    assert k.busiest_country == "A"  # 2 rows each: alphabetical first
    assert k.avg_ground_speed_knots == 200.0  # nulls skipped
    empty = I.kpi_cards(g.limit(0)).first()
    assert (empty.total_tracked_aircraft, empty.busiest_country, empty.avg_ground_speed_knots) == (
        0, "N/A", 0.0)
    top = I.country_volume(g, 1).collect()
    assert [(r.origin_country, r.unique_aircraft_count) for r in top] == [("A", 6)]


def test_histogram_matches_numpy(spark):
    xs = [float(v) for v in (np.random.default_rng(7).gamma(3.0, 40.0, 300).round(2))]
    groups = ["A" if i % 3 else "B" for i in range(len(xs))]
    df = spark.createDataFrame(list(zip(groups, xs)), "g string, x double")
    got = {(r["g"], r["bin"]): (r["count"], r["density"])
           for r in D.density_histogram(df, "x", "g").collect()}
    edges = np.histogram_bin_edges(np.array(xs), bins="auto")
    for grp in ("A", "B"):
        sub = np.array([x for x, g in zip(xs, groups) if g == grp])
        counts, _ = np.histogram(sub, bins=len(edges) - 1, range=(edges[0], edges[-1]))
        dens, _ = np.histogram(sub, bins=len(edges) - 1, range=(edges[0], edges[-1]), density=True)
        for b, (c, d) in enumerate(zip(counts, dens)):
            if c:
                assert got[(grp, b)][0] == c
                assert abs(got[(grp, b)][1] - d) < 1e-9


def test_kde_matches_formula(spark):
    xs = [1.0, 2.0, 2.5, 4.0, 7.0, 3.0]
    df = spark.createDataFrame([("A", x) for x in xs], "g string, x double")
    out = sorted(D.kde_curves(df, "x", "g").collect(), key=lambda r: r.grid_index)
    assert len(out) == 200
    a = np.array(xs)
    h = a.std(ddof=1) * len(a) ** -0.2
    grid = np.linspace(a.min(), a.max(), 200)
    ref = np.exp(-0.5 * ((grid[:, None] - a[None, :]) / h) ** 2).sum(1) / (len(a) * h * np.sqrt(2 * np.pi))
    assert np.allclose([r.density for r in out], ref, atol=1e-9)


def test_box_stats_quartiles_and_whiskers(spark):
    xs = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 100.0, -50.0]
    df = spark.createDataFrame([("p", x) for x in xs], "g string, x double")
    r = D.box_stats(df, "x", "g").first()
    q1, med, q3 = np.percentile(xs, [25, 50, 75])
    assert (r.q1, r.median, r.q3) == (round(q1, 6), round(med, 6), round(q3, 6))
    assert (r.whislo, r.whishi, r.n_fliers) == (1.0, 8.0, 2)
    fl = sorted(x.x for x in D.box_outliers(df, "x", "g").collect())
    assert fl == [-50.0, 100.0]


def test_quality_rows(spark):
    g = gold_rows(spark, [("A", "Mid Altitude", 1, 1, None, 1.0)])
    n = {r.check: r for r in Q.null_checks(g, "gold", ("snapshot_hour",)).collect()}
    assert n["nulls:avg_ground_speed_knots"].observed == 1 and n["nulls:avg_ground_speed_knots"].passed
    d = Q.duplicate_checks(g.unionByName(g), "gold", ("snapshot_hour", "spatial_sector")).first()
    assert (d.observed, d.failed_rows, d.passed) == (1, 1, False)
    try:
        Q.assert_passed(Q.row_count_check(g.limit(0), "gold"))
        raise AssertionError("should fail")
    except ValueError as e:
        assert "row_count" in str(e)
    prof = {r.column_name: r.null_count for r in I.null_profile(g).collect()}
    assert prof["avg_ground_speed_knots"] == 1 and prof["origin_country"] == 0
    assert I.null_mask(g).filter(F.col("avg_ground_speed_knots")).count() == 1


def test_histogram_fixed_bin_count(spark):
    xs = [float(v) for v in np.random.default_rng(5).normal(100, 15, 500).round(2)]
    df = spark.createDataFrame([("A", x) for x in xs], "g string, x double")
    got = {r["bin"]: (r["count"], r["density"]) for r in
           D.density_histogram(df, "x", "g", bins=12).collect()}
    counts, _ = np.histogram(xs, bins=12)
    dens, _ = np.histogram(xs, bins=12, density=True)
    assert {b: c for b, (c, _) in got.items()} == {b: c for b, c in enumerate(counts) if c}
    assert all(abs(got[b][1] - dens[b]) < 1e-9 for b in got)
