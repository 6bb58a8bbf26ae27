"""Streams on rows around the ends of runs, and state that serves many keys, against DuckDB and plain versions."""

import duckdb
import pytest
from pyspark.sql import functions as F

from tessera.plans import catalog
from tessera.streaming import Landing, deduplicated, run_to_table

ROWS = [  # event_id, day and time, user_id, event_type
    (1, "09 22:10", 1, "view"), (2, "09 23:55", 1, "view"), (50, "09 23:30", 1, "click"), (100, "09 22:30", 2, "click"), (150, "09 23:58", 2, "view"),
    (3, "10 00:05", 1, "view"), (4, "10 00:30", 2, "view"), (5, "19 23:59", 2, "click"), (6, "20 00:01", 2, "click"), (7, "20 00:02", 1, "view"), (8, "25 12:00", 3, "view"), (9, "25 12:01", 3, "view"),
]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    to = tmp_path_factory.mktemp("events")
    df = spark.createDataFrame([(i, f"2024-01-{at}:00", u, kind, i / 4) for i, at, u, kind in ROWS], "event_id long, at string, user_id long, event_type string, value double")
    df.selectExpr("event_id", "cast(at as timestamp_ntz) AS ts", "user_id", "event_type", "value").write.parquet(f"file://{to}/events.parquet")
    return str(to)


@pytest.mark.parametrize("name", ["stream_append_late", "stream_deduplicated"])
def test_rows_at_the_ends_of_runs(spark, base, name):
    """A late row of a window that the first run left open; keys seen minutes before and after a run's end."""
    df = catalog.QUERIES[name](spark, base)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW events AS SELECT * FROM '{base}/events.parquet/*.parquet'")
    assert rows_of(df) == sorted(duck.execute(f"SELECT {', '.join(df.columns)} FROM ({catalog.ORACLE_SQL[name]})").fetchall(), key=repr)


def test_deduplicated_forgets(spark):
    """A key is new again once the watermark has passed it, and not before."""
    df = spark.createDataFrame([(1, "00:00"), (2, "00:55"), (3, "01:00"), (1, "01:02"), (2, "01:01"), (3, "09:00")], "k long, at string").selectExpr("k", "cast('2024-01-01 ' || at as timestamp_ntz) AS ts")
    landing = Landing(df)
    out = run_to_table(deduplicated(landing.stream, ["k"]), "append", landings=[landing], arrivals=["ts <= timestamp_ntz '2024-01-01 01:00:00'", "ts > timestamp_ntz '2024-01-01 01:00:00'"])
    assert rows_of(out.groupBy("k").agg(F.count(F.lit(1)))) == [(1, 2), (2, 1), (3, 1)]


@pytest.mark.parametrize("name", ["not_followed", "kind_counts", "running_totals"])
def test_state_serves_many_keys(spark, monkeypatch, tmp_path, name):
    """400 keys, one of them null, in a few states: results are those of a plain aggregate."""
    from tessera.streaming import events as ev

    monkeypatch.setattr(ev, "GROUPS", 5, raising=False)
    df = spark.range(2000).selectExpr("CASE WHEN id % 400 > 0 THEN id % 400 END AS user_id", "id AS event_id", "CASE WHEN id % 3 = 0 THEN 'signup' WHEN id % 3 = 1 THEN 'click' ELSE 'view' END AS event_type", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, cast(id as int)) AS ts", "id / 4 AS value")
    landing, got = Landing(df), []
    landing.land()
    out, mode = {"not_followed": lambda: (ev.not_followed(landing.stream, "signup", "click", "1 hour"), "append"), "kind_counts": lambda: (ev.kind_counts(landing.stream), "update"), "running_totals": lambda: (ev.running_totals(landing.stream), "update")}[name]()
    with ev.rocksdb_state(spark):
        q = out.writeStream.foreachBatch(lambda b, _: got.extend(tuple(r)[:2] if name == "not_followed" else tuple(r) for r in b.collect())).outputMode(mode).option("checkpointLocation", f"file://{tmp_path}/state").trigger(availableNow=True).start()
        q.awaitTermination()
    assert max(s.numRowsTotal for p in q.recentProgress for s in p.stateOperators) <= 5 * (3 if name == "not_followed" else 1)
    want = {"kind_counts": df.groupBy("user_id", "event_type").count(), "running_totals": df.groupBy("user_id").agg(F.count(F.lit(1)), F.sum("value")), "not_followed": df.filter("event_type = 'signup' AND event_id < 1929").select("user_id", "event_id")}[name]
    assert sorted(got, key=repr) == rows_of(want)
