"""Joins against plain ones, on nulls, ties, hot keys and names that clash."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import asof_join, hot_keys, interval_join, ordered_pairs, overlap_join, range_join, salted_join, skew_join


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def nearest_by_hand(left, right, direction, tolerance, exact):
    """left: (k, t, id); right: (k, t, v). Ties: backward the greatest v, forward the least."""
    out = []
    for k, t, i in left:
        own = [(rt, v) for rk, rt, v in right if None not in (k, t, rk, rt) and rk == k]
        back = max((r for r in own if (r[0] <= t if exact else r[0] < t)), default=None)
        ahead = min((r for r in own if (r[0] >= t if exact else r[0] > t)), default=None)
        back = back if back and (tolerance is None or t - back[0] <= tolerance) else None
        ahead = ahead if ahead and (tolerance is None or ahead[0] - t <= tolerance) else None
        hit = back if direction == "backward" else ahead if direction == "forward" else ahead if back is None or (ahead and ahead[0] - t < t - back[0]) else back
        out.append((k, t, i, *(hit or (None, None))))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def sides(spark):
    rnd = random.Random(7)
    pick = lambda n: [(rnd.choice(["hot"] * 6 + ["a", "b", "lonely", None]), rnd.choice([None, *range(0, 400, 3)])) for _ in range(n)]
    left = [(k, t, i) for i, (k, t) in enumerate(pick(300))] + [("hot", 9, 1000)] * 3
    right = [(k, t, rnd.choice([1, 2, 3, None]) or i + 10) for i, (k, t) in enumerate(pick(200)) if k != "lonely"]
    return left, right


@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
@pytest.mark.parametrize("tolerance,exact,width", [(None, True, None), (5, True, 7), (None, False, 1), (4, False, 100000)])
def test_asof(spark, sides, direction, tolerance, exact, width):
    left, right = sides
    l, r = spark.createDataFrame(left, "`_k0` string, t long, side int"), spark.createDataFrame(right, "`_k0` string, t long, v int")
    got = asof_join(l, r, ["_k0"], "t", ["v"], direction=direction, tolerance=tolerance, exact=exact, width=width)
    assert got.columns == ["_k0", "t", "side", "last_t", "last_v"]
    assert rows_of(got) == nearest_by_hand(left, right, direction, tolerance, exact)


@pytest.mark.parametrize("kind,step", [("timestamp", "1 hour"), ("timestamp_ntz", "1 hour"), ("date", "1 month"), ("double", 0.5), ("decimal(10,2)", 1)])
def test_asof_kinds_of_time(spark, kind, step):
    at = {"timestamp": "timestamp_seconds(id * 1777)", "timestamp_ntz": "cast(timestamp_seconds(id * 1777) as timestamp_ntz)", "date": "date_add(date'2024-01-25', cast(id as int))", "double": "id / 7D", "decimal(10,2)": "cast(id / 7 as decimal(10,2))"}[kind]
    both = spark.range(200).selectExpr("id % 3 AS k", f"{at} AS t", "id")
    left, right = both.filter("id % 2 = 0"), both.filter("id % 5 = 1").select("k", "t", F.col("id").alias("v"))
    far = f"interval {step}" if isinstance(step, str) else str(step)
    pairs = left.alias("l").join(right.alias("r"), F.expr(f"l.k = r.k and r.t <= l.t and r.t >= l.t - {far}"), "left").groupBy("id").agg(F.max("r.t").alias("last_t"), F.max("v").alias("last_v"))
    assert rows_of(asof_join(left, right, ["k"], "t", ["v"], tolerance=step).select("id", "last_t", "last_v")) == rows_of(pairs)


def test_asof_spreads_a_hot_key(spark):
    """A third of all rows on one key go to many groups, not to one."""
    df = spark.range(30000).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k", "id AS t", "id AS v")
    plan = asof_join(df, df, ["k"], "t", ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(k0" in plan and ", b" in plan.split("Window", 1)[1]
    with pytest.raises(ValueError):
        asof_join(df.withColumn("last_v", F.lit(1)), df, ["k"], "t", ["v"])
    with pytest.raises(ValueError):
        asof_join(df, df, ["k"], "t", ["v"], direction="sideways")


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("after,kind", [("1 hour", "timestamp_ntz"), ("3 months", "timestamp_ntz"), ("1 month", "timestamp"), ("1 day 2 hours", "timestamp"), ("1 second", "timestamp_ntz")])
def test_interval_join_is_a_plain_join(spark, zone, after, kind):
    """Months of any length, and the hours around a change of the clocks."""
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        step = "cast(id * 1201 as int)" if "month" not in after else "cast(id * 86400 + id % 7 as int)"
        rows = spark.range(400).selectExpr("CASE WHEN id % 17 = 0 THEN NULL ELSE id % 2 END AS k", f"CASE WHEN id % 19 <> 0 THEN cast(timestamp_ntz'2024-11-02' + make_dt_interval(0, 0, 0, {step}) as {kind}) END AS t", "id")
        left, right = rows.select("k", F.col("t").alias("a"), F.col("id").alias("_bin")), rows.select("k", F.col("t").alias("b"), F.col("id").alias("y"))
        plain = left.alias("l").join(right.alias("r"), F.expr(f"l.k = r.k and b > a and b <= a + interval {after}")).select("_bin", "y")
        got = rows_of(interval_join(left, right, ["k"], "a", "b", after).select("_bin", "y"))
        assert got == rows_of(plain) and (got or after == "1 second")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_interval_must_be_positive(spark):
    df = spark.createDataFrame([], "k long, a timestamp_ntz, b timestamp_ntz")
    for bad in ("0 seconds", "-1 hour"):
        with pytest.raises(ValueError):
            interval_join(df.select("k", "a"), df.select("k", "b"), ["k"], "a", "b", bad)


@pytest.fixture(scope="module")
def ranges(spark):
    """Ranges of all widths, empty and null ones."""
    rnd = random.Random(3)
    rows = [(i, i % 2, low, low + rnd.choice([-1, 0, 0, 1, 3, 64, 1000, 10**6, 10**12])) for i in range(200) for low in [rnd.randrange(-2000, 2000)]]
    rows += [(900, 0, None, 5), (901, 0, 5, None), (902, 0, -(2**63), 2**63 - 1), (903, None, 0, 10)]
    return spark.createDataFrame(rows, "r long, k long, low long, high long")


@pytest.mark.parametrize("kind", ["long", "double", "date", "timestamp_ntz"])
def test_range_join_is_a_plain_join(spark, ranges, kind):
    to = {"long": "{0}", "double": "{0} / 3D", "date": "date_add(date'2024-01-01', cast(least(greatest({0}, -30000), 30000) as int))", "timestamp_ntz": "cast(timestamp_seconds(least(greatest({0}, -100000000), 100000000)) as timestamp_ntz)"}[kind]
    cut = ranges.selectExpr("r", "k", f"{to.format('low')} AS low", f"{to.format('high')} AS high")
    points = spark.range(-300, 300).selectExpr("CASE WHEN id = 5 THEN NULL ELSE id % 2 END AS k", "CASE WHEN id % 50 = 7 THEN NULL ELSE id * 7 END AS p", "id AS `_Bin`").selectExpr("k", f"{to.format('p')} AS p", "`_Bin`")
    plain = points.alias("a").join(cut.alias("b"), F.expr("a.k = b.k and p between low and high")).select("_Bin", "r")
    assert rows_of(range_join(points, cut, "p", "low", "high", ["k"]).select("_Bin", "r")) == rows_of(plain)
    free_of_keys = points.drop("k").crossJoin(cut.drop("k")).filter("p between low and high").select("_Bin", "r")
    assert rows_of(range_join(points.drop("k"), cut.drop("k"), "p", "low", "high").select("_Bin", "r")) == rows_of(free_of_keys)


def test_range_join_writes_two_bins_a_range(ranges):
    from tessera.operators.joins import binned_by_width

    assert binned_by_width(ranges, "low", "high", "_l", "_b").groupBy("r").count().agg(F.max("count")).first()[0] <= 2


def test_range_join_of_odd_numbers(spark):
    nan = float("nan")
    points = spark.createDataFrame([(1, nan), (2, 0.5), (3, float("inf")), (4, -1e300)], "i int, p double")
    cut = spark.createDataFrame([("a", 0.0, nan), ("b", -float("inf"), 0.5), ("c", 0.5, 0.5)], "r string, low double, high double")
    assert rows_of(range_join(points, cut.filter("r <> 'a'"), "p", "low", "high").select("i", "r")) == [(2, "b"), (2, "c"), (4, "b")]
    assert range_join(points, cut.filter("1 = 0"), "p", "low", "high").count() == 0


def test_overlap_join_is_a_plain_join(ranges):
    other = ranges.selectExpr("r AS s", "k", "low AS a", "high AS b")
    plain = ranges.alias("x").join(other.alias("y"), F.expr("x.k = y.k and low <= high and a <= b and low <= b and a <= high")).select("r", "s")
    assert rows_of(overlap_join(ranges, other, ("low", "high"), ("a", "b"), ["k"]).select("r", "s")) == rows_of(plain)


@pytest.fixture(scope="module")
def skewed(spark):
    big = spark.range(6000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 WHEN id % 50 = 1 THEN NULL ELSE id % 900 END AS k", "id % 4 AS j", "id AS `_salt`")
    small = spark.range(0, 800, 2).selectExpr("id AS k", "id % 4 AS j", "id * 10 AS v").union(spark.createDataFrame([(7, 0, 1), (7, 0, 2), (None, 0, 3), (7, 3, 4)], "k long, j long, v long"))
    return big, small


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_is_a_plain_join(skewed, how):
    big, small = skewed
    for keys in (["k"], ["k", "j"]):
        right = small if "j" in keys else small.drop("j")
        plain = big.join(right, keys, how)
        assert rows_of(skew_join(big, right, keys, how).select(*plain.columns)) == rows_of(plain)
        assert rows_of(salted_join(big, right, keys, 4, how).select(*plain.columns)) == rows_of(plain)


def test_skew_join_copies_hot_keys_alone(spark, skewed):
    big, _ = skewed
    assert [c for _, c in hot_keys(big, ["k"], 0.05)] == pytest.approx([2000], abs=160)
    assert hot_keys(big.filter("1 = 0"), ["k"], 0.05) == []
    # no hot key is missed, whatever the counters are
    for share in (0.3, 0.01, 0.001):
        exact = {r[0] for r in big.filter("k is not null").groupBy(F.xxhash64("k")).count().filter(F.col("count") > share * 5900).collect()}
        assert exact <= {h for h, _ in hot_keys(big, ["k"], share)}


def test_skew_join_refuses_outer(skewed):
    with pytest.raises(ValueError):
        skew_join(*skewed, ["k"], "full")


@pytest.mark.parametrize("size", [7, 2048])
def test_ordered_pairs_are_those_of_a_plain_join(spark, monkeypatch, size):
    """Two thirds of the rows are of one key, some tie, some are null."""
    monkeypatch.setattr("tessera.operators.joins.SLICE", size)
    df = spark.range(300).selectExpr("CASE WHEN id % 3 > 0 THEN 1 WHEN id % 33 = 0 THEN NULL ELSE id % 5 END AS k", "CASE WHEN id % 29 <> 0 THEN id % 90 END AS v", "id AS `_slice`").repartition(6)
    plain = df.alias("x").join(df.alias("y"), F.expr("x.k = y.k and x.v < y.v")).selectExpr("x.k", "x.v", "x._slice", "y.v", "y._slice")
    got = ordered_pairs(df, ["k"], "v")
    assert got.columns == ["k", "a_v", "a__slice", "b_v", "b__slice"]
    assert rows_of(got) == rows_of(plain)
    assert ordered_pairs(df.filter("1 = 0"), ["k"], "v").count() == 0


def test_ordered_pairs_come_from_lists(spark, monkeypatch):
    """The join meets rows with whole lists and the pairs are formed after it, in more tasks than one for TASK_PAIRS of them; columns may be of types without an order."""
    monkeypatch.setattr("tessera.operators.joins.SLICE", 16)
    monkeypatch.setattr("tessera.operators.joins.TASK_PAIRS", 10_000)
    df = spark.range(0, 400, 1, 1).selectExpr("id % 2 AS k", "id AS v", "map(id, 'x') AS m", "CASE WHEN id % 3 > 0 THEN struct(id AS i) END AS x")
    out = ordered_pairs(df, ["k"], "v")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" in plan.split("Join")[0]
    want = df.alias("x").join(df.alias("y"), F.expr("x.k = y.k and x.v < y.v")).selectExpr("x.k", "x.v", "x.m", "x.x", "y.v", "y.m", "y.x")
    assert rows_of(out) == rows_of(want)
    parts = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert max(parts) < 0.2 * sum(parts)


def test_self_join_spreads_over_tasks(spark):
    """Its pairs come from more than the tasks that read the table."""
    from tessera.plans import catalog

    for name in ("join_self", "join_theta"):
        parts = [r["count"] for r in catalog.QUERIES[name](spark, "/root/testdata/sf0.01").groupBy(F.spark_partition_id()).count().collect()]
        assert len(parts) > 1 and max(parts) < 0.8 * sum(parts)


def test_range_join_cuts_bins_into_pieces(spark, monkeypatch):
    """All points are in one bin of all ranges; no task holds most pairs, with slices of any size."""
    points = spark.range(0, 500, 1, 1).selectExpr("id AS i", "id % 7 AS p")
    cut = spark.range(90).selectExpr("id AS r", "-8L AS low", "id % 5 AS high")
    want = rows_of(points.crossJoin(cut).filter("p BETWEEN low AND high").select("i", "r"))
    for size in (16, 2048):
        monkeypatch.setattr("tessera.operators.joins.SLICE", size)
        out = range_join(points, cut, "p", "low", "high").select("i", "r")
        assert rows_of(out) == want
        parts = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert size > 16 or max(parts) < 0.8 * sum(parts)


def test_salted_join_deals_rows_over_tasks(spark, monkeypatch):
    """The small side's copies are not broadcast, and the number of tasks goes by the rows, one split or not."""
    monkeypatch.setattr("tessera.operators.joins.TASK_ROWS", 500)
    big, small = spark.range(0, 6000, 1, 1).selectExpr("id % 700 AS k", "id AS x"), spark.range(0, 600, 1, 1).selectExpr("id AS k", "id * 10 AS v")
    for how in ("inner", "left"):
        out = salted_join(big, small, ["k"], 4, how)
        assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
        assert rows_of(out.select("k", "x", "v")) == rows_of(big.join(small, ["k"], how).select("k", "x", "v"))
        parts = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert max(parts) < sum(parts) / 6
