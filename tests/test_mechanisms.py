"""Ranks, sketches, series, user functions, upserts, the commit log and state on nulls, ties, skew and empty tables."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import chunked_map, inequality_totals, ntile, ranks, row_numbers, running, sketches
from tessera.operators.aggregates import LeastSquares, user_aggregate
from tessera.operators.islands import islands
from tessera.operators.series import fill_gaps
from tessera.sources import commit_log, rate_stream, register_commit_log
from tessera.streaming import Landing, first_seen, not_followed, rocksdb_state, run_to_table, upsert


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows tie, some are null."""
    return spark.range(900).selectExpr("CASE WHEN id % 3 = 0 THEN 5 WHEN id % 41 = 1 THEN NULL ELSE id % 60 END AS v", "id AS `_part`").repartition(7)


def test_ranks_are_those_of_windows(skewed):
    for down in (False, True):
        w = Window.orderBy(F.desc("v") if down else F.asc("v"))
        want = skewed.select("v", "_part", F.rank().over(w).cast("long"), F.dense_rank().over(w).cast("long"), F.percent_rank().over(w), F.cume_dist().over(w))
        assert rows_of(ranks(skewed, ["v"], {"rank": "r", "dense_rank": "d", "percent_rank": "p", "cume_dist": "c"}, down)) == rows_of(want)
    assert ranks(skewed.filter("1 = 0"), ["v"], {"rank": "r"}).count() == 0


def test_numbers_and_tiles_are_those_of_windows(skewed):
    w = Window.orderBy("v", "_part")
    assert rows_of(row_numbers(skewed, ["v", "_part"])) == rows_of(skewed.select("*", F.row_number().over(w).cast("long")))
    for n in (1, 7, 899, 2000):
        assert rows_of(ntile(skewed, ["v", "_part"], n)) == rows_of(skewed.select("*", F.ntile(n).over(w).cast("long")))
    with pytest.raises(ValueError):
        ntile(skewed, ["v"], 0)


def test_running_is_that_of_a_window(skewed):
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)
    got = running(skewed, ["_part"], {"s": ("sum", "v"), "n": ("count", "v"), "lo": ("min", "v"), "hi": ("max", "v")})
    assert rows_of(got) == rows_of(skewed.select("*", F.sum("v").over(w), F.count("v").over(w), F.min("v").over(w), F.max("v").over(w)))
    with pytest.raises(ValueError):
        running(skewed, ["_part"], {"a": ("avg", "v")})


def test_states_merge_to_the_same(spark):
    df = spark.range(20000).selectExpr("id % 2 AS k", "id % 17 AS day", "id % 5000 AS v", "CASE WHEN id % 3 > 0 THEN id END AS w")
    days = sketches.states(df, ["k", "day"], {"d": "v"}, {"q": "w"})
    whole = sketches.merged(days, ["k"], ["d"], ["q"]).select("k", sketches.distinct_of("d").alias("d"), sketches.quantile_of("q", 0.5).alias("q")).collect()
    for r in whole:
        assert abs(r.d - 2500) <= 2500 * sketches.distinct_error()
        assert abs(r.q / 20000 - 0.5) <= 2 * sketches.RANK_ERROR
    exact = sketches.bitmap_counts(sketches.merged_bitmaps(sketches.bitmaps(df, ["k", "day"], "w"), ["k"]), ["k"])
    assert rows_of(exact) == rows_of(df.groupBy("k").agg(F.countDistinct("w")))


def test_user_aggregate(spark):
    """Nulls as keys and values, more keys than a batch, and a fit numpy agrees with."""
    rnd = np.random.default_rng(2)
    pdf = pd.DataFrame({"k": rnd.choice([1.0, 2.0, 2.0, np.nan], 3000), "y": rnd.normal(size=3000), "a": rnd.normal(size=3000) + 1e6, "b": rnd.normal(size=3000)})
    pdf.loc[::50, "y"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("k", F.when(~F.isnan("k"), F.col("k").cast("long"))).withColumn("y", F.when(~F.isnan("y"), F.col("y"))).repartition(5)
    got = {r[0]: r[1:] for r in user_aggregate(df, ["k"], ["y", "a", "b"], LeastSquares(3), "b0 double, b1 double, b2 double").collect()}
    for k, own in pdf.groupby("k", dropna=False):
        own = own.dropna(subset=["y"])
        slope = np.linalg.lstsq(np.column_stack([np.ones(len(own)), own.a - own.a.mean(), own.b]), own.y, rcond=None)[0]
        assert np.allclose(got[None if k != k else int(k)][1:], slope[1:], rtol=1e-6, atol=1e-9)
    none = user_aggregate(df.withColumn("y", F.lit(None).cast("double")), ["k"], ["y", "a", "b"], LeastSquares(3), "b0 double, b1 double, b2 double").collect()
    assert {r[1:] for r in none} == {(None, None, None)}
    assert user_aggregate(df.filter("1 = 0"), ["k"], ["y", "a", "b"], LeastSquares(3), "b0 double, b1 double, b2 double").count() == 0


def test_islands(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (1, None, 3), (1, None, 4), (1, "a", 5), (None, "b", 1)], "k long, `Value` string, t int")
    assert rows_of(islands(df, ["k"], "Value", "t")) == sorted([(1, "a", 1, 2, 2), (1, None, 3, 4, 2), (1, "a", 5, 5, 1), (None, "b", 1, 1, 1)], key=repr)
    with pytest.raises(Exception, match="no column"):
        spark.sql("SELECT * FROM islands(TABLE(SELECT 1 AS a) PARTITION BY (a) ORDER BY (a), 'b', 'a')")


def test_gaps(spark):
    df = spark.createDataFrame([("a", 0, 1.0), ("a", 5, 3.0), ("a", 61, None), ("a", 300, 9.0), ("b", 10, 2.0), (None, 0, 1.0), ("a", None, 5.0)], "k string, s long, v double").selectExpr("k", "cast(timestamp_seconds(s) as timestamp_ntz) AS ts", "v")
    out = fill_gaps(df, ["k"], "ts", "1 minute", {"n": F.count(F.lit(1)), "c": F.max("v"), "l": F.max("v")}, ["c"], ["l"])
    got = [tuple(r) for r in out.filter("k = 'a'").select(F.minute("bucket"), "n", "c", "l", "filled").orderBy("bucket").collect()]
    assert got == [(0, 2, 3.0, 3.0, False), (1, 1, 3.0, None, False), (2, None, 3.0, None, True), (3, None, 3.0, None, True), (4, None, 3.0, None, True), (5, 1, 9.0, 9.0, False)]
    assert out.filter("k = 'b' OR k IS NULL").count() == 2
    near = fill_gaps(df, ["k"], "ts", "1 minute", {"c": F.max("v")}, ["c"], longest=2)
    assert [r.c for r in near.filter("k = 'a'").orderBy("bucket").collect()] == [3.0, 3.0, None, None, None, 9.0]
    with pytest.raises(ValueError):
        fill_gaps(df, ["k"], "ts", "1 month", {"n": F.count("v")})


def files_of(spark, path):
    return {r.f for r in spark.read.parquet(path).select(F.input_file_name().alias("f")).distinct().collect()}


def test_upsert_rewrites_touched_partitions_alone(spark, tmp_path):
    to, schema = f"file://{tmp_path}/t", "p int, k long, at long, v string"
    first = spark.createDataFrame([(1, 1, 5, "a"), (1, 2, 5, "b"), (2, 1, 5, "c"), (None, 1, 5, "n")], schema)
    second = spark.createDataFrame([(1, 1, 6, "A"), (1, 2, 4, "old"), (1, 3, 1, "new"), (1, 3, 2, "newer"), (3, 1, None, "x")], schema)
    upsert(first, to, ["p", "k"], ["p"], "at")
    before = files_of(spark, to)
    upsert(second, to, ["p", "k"], ["p"], "at")
    want = sorted([(1, 1, 6, "A"), (1, 2, 5, "b"), (1, 3, 2, "newer"), (2, 1, 5, "c"), (None, 1, 5, "n"), (3, 1, None, "x")], key=repr)
    assert rows_of(spark.read.schema(schema).parquet(to).select("p", "k", "at", "v")) == want
    after = files_of(spark, to)
    assert {f for f in before if "p=1" not in f} <= after and not {f for f in before if "p=1" in f} & after
    for again in (second, first):  # a batch that runs again, and one that comes late
        upsert(again, to, ["p", "k"], ["p"], "at")
        assert rows_of(spark.read.schema(schema).parquet(to).select("p", "k", "at", "v")) == want
    with pytest.raises(ValueError):
        upsert(first, to, ["k"], ["p"], "at")


def test_commit_log(spark, tmp_path):
    register_commit_log(spark)
    to = f"{tmp_path}/t"
    for a, b in ((0, 100), (100, 200)):
        spark.range(a, b, 1, 2).selectExpr("id", "CASE WHEN id % 9 > 0 THEN date_add(date'2024-01-01', cast(id as int)) END AS d", "CASE WHEN id = 3 THEN double('NaN') ELSE id / 2 END AS x", "array(id) AS a").write.format("tessera_log").mode("append").save(to)
    df = spark.read.format("tessera_log").load(to)
    assert df.count() == 200 and df.filter("id >= 150").count() == 50 and df.filter("x > 1000").count() == 1 and df.filter("d < date'2024-01-11'").count() == 8
    assert df.select("a", "id").filter("id = 7").first() == ([7], 7)
    held = [f for c in commit_log.commits(to) for f in c["files"] if commit_log.may_hold(f, [("id", ">=", 150)])]
    assert len(held) == 1 and len([f for c in commit_log.commits(to) for f in c["files"]]) == 4
    spark.range(5).selectExpr("id", "date'2024-01-01' AS d", "1D AS x", "array(id) AS a").write.format("tessera_log").mode("overwrite").save(to)
    assert spark.read.format("tessera_log").load(to).count() == 5


def test_commit_log_shows_nothing_of_a_failed_write(spark, tmp_path):
    register_commit_log(spark)
    to = f"{tmp_path}/t"
    spark.range(10).write.format("tessera_log").mode("append").save(to)
    with pytest.raises(Exception, match="at 7"):
        spark.range(20).select(F.when(F.col("id") == 7, F.raise_error(F.lit("at 7")).cast("long")).otherwise(F.col("id")).alias("id")).write.format("tessera_log").mode("append").save(to)
    assert spark.read.format("tessera_log").load(to).count() == 10
    schema = spark.range(1).schema
    for _ in range(2):  # a micro-batch that is committed again
        commit_log.commit(to, [], schema, batch="s:0")
    assert len(commit_log.log_files(to)) == 2


def test_rate_stream_repeats(spark, tmp_path):
    assert rate_stream(spark, 5, 2).isStreaming and rate_stream(spark, 5).columns == ["timestamp", "value"]


def test_no_follow_up_with_late_rows(spark):
    """A signup that comes late, after its click, waits for nothing; a click behind the watermark comes after its signup was told."""
    at = lambda h: f"2024-01-01 {int(h):02d}:{int(h * 60 % 60):02d}:00"
    rows = [(1, 1, "signup", at(1)), (1, 2, "click", at(2)), (2, 3, "signup", at(1)), (3, 4, "signup", at(5)), (9, 5, "view", at(5)), (2, 6, "click", at(6)), (3, 7, "click", at(6)), (4, 8, "signup", at(7)), (9, 9, "click", at(23)), (5, 10, "click", at(4.5)), (5, 11, "signup", at(4))]
    df = spark.createDataFrame(rows, "user_id long, event_id long, event_type string, at string").selectExpr("user_id", "event_id", "event_type", "cast(at as timestamp_ntz) AS ts")
    landing = Landing(df, "2 hours")
    with rocksdb_state(spark):
        out = run_to_table(not_followed(landing.stream, "signup", "click", "1 hour"), "append", landings=[landing], arrivals=["event_id IN (1, 3, 4, 5, 10)", "event_id IN (2, 6, 7, 8, 11)", "event_id = 9"])
    assert sorted(r.event_id for r in out.collect()) == [1, 3, 8]


def test_first_seen_forgets(spark):
    rnd = random.Random(1)
    df = spark.createDataFrame([(rnd.randrange(5), i, f"2024-01-{1 + i % 20:02d}") for i in range(200)], "user_id long, event_id long, d string").selectExpr("user_id", "event_id", "cast(d as timestamp_ntz) AS ts")
    for ttl, times in (("30 days", 1), ("1 millisecond", 2)):
        landing = Landing(df)
        with rocksdb_state(spark, idle_batches=False):
            out = run_to_table(first_seen(landing.stream, ttl), "append", landings=[landing], arrivals=["event_id < 100", "event_id >= 100"])
        assert sorted(r.user_id for r in out.collect()) == sorted(list(range(5)) * times)


@pytest.mark.parametrize("op", ["<", "<=", ">", ">="])
@pytest.mark.parametrize("by", [["k"], []])
def test_inequality_totals_are_those_of_a_plain_join(spark, op, by):
    """One key has two thirds of the rows, a third tie at one place, keys and places may be null, left rows repeat."""
    left = spark.range(240).selectExpr("id % 80 AS id", "CASE WHEN id % 3 > 0 THEN 1 WHEN id % 21 = 0 THEN NULL ELSE id % 7 END AS k", "CASE WHEN id % 3 = 1 THEN 5 WHEN id % 29 = 0 THEN NULL ELSE id % 40 END AS `_place`").repartition(5)
    right = spark.range(200).selectExpr("CASE WHEN id % 3 > 0 THEN 1 WHEN id % 19 = 0 THEN NULL ELSE id % 8 END AS k", "CASE WHEN id % 3 = 2 THEN 5 WHEN id % 31 = 0 THEN NULL ELSE id % 50 END AS at", "CASE WHEN id % 4 > 0 THEN id - 90 END AS v")
    got = inequality_totals(left, right, by, ("_place", "at"), op, {"n": ("count", F.lit(1)), "m": ("count", "v"), "s": ("sum", "v")})
    assert got.columns == ["id", "k", "_place", "n", "m", "s"]
    rows = [tuple(r) for r in right.collect()]
    test = {"<": int.__lt__, "<=": int.__le__, ">": int.__gt__, ">=": int.__ge__}[op]
    want = []
    for i, k, x in left.collect():
        v = [r[2] for r in rows if x is not None and r[1] is not None and (not by or (k is not None and r[0] == k)) and test(r[1], x)]
        some = [e for e in v if e is not None]
        want.append((i, k, x, len(v), len(some), sum(some) if some else None))
    assert rows_of(got) == sorted(want, key=repr)
    none = inequality_totals(left, right.filter("1 = 0"), by, ("_place", "at"), op, {"n": ("count", F.lit(1)), "s": ("sum", "v")})
    assert {(r.n, r.s) for r in none.collect()} == {(0, None)} and none.count() == 240
    assert inequality_totals(left.filter("1 = 0"), right, by, ("_place", "at"), op, {"n": ("count", "v")}).count() == 0


def test_inequality_totals_refuse(spark):
    df = spark.range(3)
    for op, totals in (("=", {"n": ("count", "id")}), ("<", {"n": ("max", "id")}), ("<", {"id": ("count", "id")})):
        with pytest.raises(ValueError):
            inequality_totals(df, df, [], ("id", "id"), op, totals)


@pytest.mark.parametrize("rows,before", [(1000, 7), (16, 7), (7, 7), (50, 0)])
def test_chunked_map_is_a_grouped_map(spark, rows, before):
    """Two thirds of the rows are of one key, some of null; sums run over the rows before within reach."""
    df = spark.range(600).selectExpr("CASE WHEN id % 3 > 0 THEN 'a' WHEN id % 33 = 0 THEN NULL ELSE concat('b', id % 5) END AS k", "(id * 37) % 600 AS t", "id % 11 AS `_at`").repartition(6)
    seen = []

    def sums(f):
        assert len(f) <= rows + before and f.k.nunique(dropna=False) == 1
        return pd.DataFrame({"t": f.t, "s": f["_at"].rolling(before + 1, min_periods=1).sum().astype("int64")})

    got = rows_of(chunked_map(df, ["k"], ["t"], sums, "t long, s long", rows, before))
    groups = {}
    for k, t, v in sorted(map(tuple, df.collect()), key=lambda r: r[1]):
        own = groups.setdefault(k, [])
        own.append(v)
        seen.append((t, sum(own[-before - 1 :])))
    assert got == sorted(seen, key=repr)
    assert chunked_map(df.filter("1 = 0"), ["k"], ["t"], sums, "t long, s long", rows, before).count() == 0


def test_chunked_map_refuses(spark):
    with pytest.raises(ValueError):
        chunked_map(spark.range(3), ["id"], [], lambda f: f, "id long", 5, 6)
    with pytest.raises(Exception, match="how gave 0 rows"):
        chunked_map(spark.range(3), [], ["id"], lambda f: f[:0], "id long").collect()


def test_bitmaps_of_sparse_values(spark):
    """States of values far apart take bytes a value, not kilobytes; values may be negative, null or at the ends of a long."""
    df = spark.range(4000).selectExpr("id % 3 AS k", "id % 50 AS day", "CASE WHEN id % 90 = 1 THEN NULL WHEN id % 90 = 2 THEN 9223372036854775807 WHEN id % 90 = 3 THEN -9223372036854775808 ELSE (id % 1500 - 700) * 100003 END AS v")
    days = sketches.bitmaps(df, ["k", "day"], "v")
    assert days.select(F.max(F.octet_length(F.col("bits").cast("string")))).first()[0] <= 20 and days.count() <= 4000
    exact = sketches.bitmap_counts(sketches.merged_bitmaps(days, ["k"]), ["k"])
    assert rows_of(exact) == rows_of(df.groupBy("k").agg(F.countDistinct("v")))


@pytest.mark.parametrize("name", ["sketch_bitmap_rollup", "sketch_distinct_rollup"])
def test_rollups_keep_no_large_buffers(spark, name):
    """Exact counts by day come from hash aggregates of words, not from sorted buffers of kilobytes."""
    from tessera.plans import catalog

    plan = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "bitmap_construct_agg" not in plan and "bit_or" in plan


def test_bitmaps_deal_words_over_tasks_by_rows(spark, monkeypatch):
    """No task holds most words, however few splits are read; a third of the rows are of one word, some are null."""
    monkeypatch.setattr(sketches, "TASK_WORDS", 500, raising=False)
    df = spark.range(0, 6000, 1, 1).selectExpr("id % 2 AS `_salt`", "id % 50 AS day", "CASE WHEN id % 3 = 0 THEN id % 60 WHEN id % 90 = 1 THEN NULL ELSE (id % 2100 - 700) * 100003 END AS v")
    days = sketches.bitmaps(df, ["_salt", "day"], "v")
    parts = [r["count"] for r in days.groupBy(F.spark_partition_id()).count().collect()]
    assert days.count() == days.select("_salt", "day", "bucket").distinct().count() == sum(parts) and max(parts) < sum(parts) / 4
    exact = sketches.bitmap_counts(sketches.merged_bitmaps(days, ["_salt"]), ["_salt"])
    assert rows_of(exact) == rows_of(df.groupBy("_salt").agg(F.countDistinct("v")))
    assert sketches.bitmaps(df.filter("1 = 0"), ["_salt"], "v").count() == 0


def test_exact_counts_of_flags_form_no_words_by_day(spark):
    from tessera.plans import catalog

    plan = catalog.QUERIES["sketch_distinct_rollup"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    words = [line for line in plan.splitlines() if "bit_or(" in line]
    assert words and not any("day#" in line for line in words)
