import numpy as np
import pytest
from pyspark.sql import functions as F

from yieldloom.operators import ranking
from yieldloom.operators.ranking import exact_quantiles, first_by_hash, prefix_sums


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows share one value, one group holds most rows."""
    random = np.random.default_rng(3)
    n = 6000
    value = np.where(random.random(n) < 0.33, 7.0, random.exponential(5, n))
    group = np.where(random.random(n) < 0.7, "a", random.choice(["b", "c"], n))
    rows = [(i, str(g), float(v)) for i, (g, v) in enumerate(zip(group, value))]
    return spark.createDataFrame(rows, "id long, g string, v double").repartition(8)


@pytest.mark.parametrize("ranges", [2, 16, 200])
def test_prefix_sums_are_exact_for_any_number_of_ranges(skewed, ranges):
    counts = skewed.groupBy("g", "v").agg(F.count("*").alias("n"))
    got = prefix_sums(counts, ["g"], "v", ["n"], ranges).toPandas().sort_values(["g", "v"])
    want = got.groupby("g")["n"].cumsum() - got["n"]
    assert (got["n_before"] == want).all()
    assert (got["n_total"] == got.groupby("g")["n"].transform("sum")).all()
    assert len(got) == counts.count()


def test_large_groups_are_joined_in_parts(spark, monkeypatch):
    monkeypatch.setattr(ranking, "ROWS_PER_RANGE", 50)
    sizes = {f"g{i}": n for i, n in enumerate((1, 3, 49, 51, 120, 700, 2000))}
    rows = [(g, float(v)) for g, n in sizes.items() for v in range(n)]
    counts = spark.createDataFrame(rows, "g string, v double").repartition(6).withColumn("n", (F.col("v") % 3 + 1).cast("long"))
    counted = counts.groupBy("g").agg(F.count("*").alias("size"))
    parts = {r.g: r["__parts"] for r in ranking.large_groups(counted, ["g"], "size").collect()}
    assert parts == {"g3": 2, "g4": 3, "g5": 14, "g6": 40}
    ranked = prefix_sums(counts, ["g"], "v", ["n"], 4)
    plan = ranked._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join " in line and "g#" in line and "broadcast" not in line]
    assert joins and all("__part#" in line or "__range#" in line for line in joins)
    got = ranked.toPandas().sort_values(["g", "v"])
    assert (got["n_before"] == got.groupby("g")["n"].cumsum() - got["n"]).all() and len(got) == len(rows)
    assert (got["n_total"] == got.groupby("g")["n"].transform("sum")).all()


def test_prefix_sums_without_groups(skewed):
    counts = skewed.groupBy("v").agg(F.count("*").alias("n"))
    got = prefix_sums(counts, [], "v", ["n"], 8).toPandas().sort_values("v")
    assert (got["n_before"] == got["n"].cumsum() - got["n"]).all()


def test_quantiles_interpolate_like_numpy(skewed):
    probs = {"p10": 0.1, "p50": 0.5, "p993": 0.993, "top": 1.0}
    got = {r.g: r for r in exact_quantiles(skewed, ["g"], "v", probs).collect()}
    for g, rows in skewed.toPandas().groupby("g"):
        for name, p in probs.items():
            assert got[g][name] == pytest.approx(np.quantile(rows["v"], p))


def test_quantiles_of_one_value_and_of_nothing(spark):
    df = spark.createDataFrame([(1.5,)], "v double")
    assert exact_quantiles(df, [], "v", {"p": 0.3}).first().p == 1.5
    assert [r.p for r in exact_quantiles(df.where("false"), [], "v", {"p": 0.3}).collect()] in ([], [None])


def test_first_by_hash_takes_exactly_that_many(skewed):
    df = skewed.withColumn("digest", F.md5(F.col("id").cast("string"))).withColumn("one_third", (F.col("id") % 3 == 0).cast("int"))
    sizes = {"a": [1, 10, 500], "b": [3]}
    wanted = df.sparkSession.createDataFrame([(g, n) for g, ns in sizes.items() for n in ns], "g string, take long")
    cuts = first_by_hash(df.select("g", "digest", "one_third"), ["g"], "digest", wanted, ["one_third"]).collect()
    assert sorted((r.g, r["take"]) for r in cuts) == [("a", 1), ("a", 10), ("a", 500), ("b", 3)]
    rows = df.toPandas()
    for r in cuts:
        inside = rows[(rows.g == r.g) & (rows.digest <= r.cut)]
        assert len(inside) == r["take"]
        assert inside.one_third.sum() == r.one_third_taken
