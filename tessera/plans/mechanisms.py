"""Queries of joins, ranks, sketches, series, user functions, sources and streams that Spark has no operator for."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import asof_join, inequality_totals, ntile, overlap_join, range_join, ranks, row_numbers, running, skew_join, sketches
from tessera.operators.aggregates import LeastSquares, user_aggregate
from tessera.operators.islands import islands
from tessera.operators.series import fill_gaps
from tessera.sources import deleted, load, register_commit_log, scratch
from tessera.streaming import events as ev
from tessera.streaming.upserts import upsert

from .registry import Registry

MECHANISMS = Registry()
paired = MECHANISMS.paired


# as-of joins: five hot keys, one of them a hundredth


@paired("""SELECT a.event_id, b.event_id AS next_event_id, b.ts AS next_ts FROM events a
    ASOF LEFT JOIN (SELECT * FROM events WHERE event_id % 7 = 3) b ON a.event_type = b.event_type AND a.ts <= b.ts""")
def join_asof_forward(spark, base):
    """The next row of the same type that is not earlier, itself included."""
    events = load(spark, base, "events")
    some = events.filter("event_id % 7 = 3")
    return asof_join(events.select("event_id", "event_type", "ts"), some, ["event_type"], "ts", ["event_id"], "next_", "forward").select("event_id", "next_event_id", "next_ts")


@paired("""SELECT a.event_id, CASE WHEN b.ts >= a.ts - INTERVAL 20 MINUTE THEN b.event_id END AS last_event_id FROM events a
    ASOF LEFT JOIN (SELECT * FROM events WHERE event_id % 3 = 0) b ON a.event_type = b.event_type AND a.ts > b.ts""")
def join_asof_tolerance(spark, base):
    """The latest row before, not at, the same time, if it is 20 minutes back at most."""
    events = load(spark, base, "events")
    some = events.filter("event_id % 3 = 0")
    return asof_join(events.select("event_id", "event_type", "ts"), some, ["event_type"], "ts", ["event_id"], tolerance="20 minutes", exact=False).select("event_id", "last_event_id")


@paired("""WITH b AS (SELECT event_type, ts, event_id FROM events WHERE event_id % 11 = 5),
    l AS (SELECT a.event_id, a.ts, b.ts AS t, b.event_id AS i FROM events a ASOF LEFT JOIN b ON a.event_type = b.event_type AND a.ts >= b.ts),
    r AS (SELECT a.event_id, b.ts AS t, b.event_id AS i FROM events a ASOF LEFT JOIN b ON a.event_type = b.event_type AND a.ts <= b.ts)
    SELECT l.event_id, CASE WHEN l.i IS NULL OR r.t - l.ts < l.ts - l.t THEN r.i ELSE l.i END AS near_event_id FROM l JOIN r USING (event_id)""")
def join_asof_nearest(spark, base):
    events = load(spark, base, "events")
    some = events.filter("event_id % 11 = 5")
    return asof_join(events.select("event_id", "event_type", "ts"), some, ["event_type"], "ts", ["event_id"], "near_", "nearest").select("event_id", "near_event_id")


# ranges


@paired("SELECT p.p_partkey, s.s_suppkey FROM part p JOIN supplier s ON p.p_retailprice BETWEEN s.s_acctbal AND s.s_acctbal + CASE s.s_suppkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 20 WHEN 2 THEN 90 ELSE 300 END")
def join_range_widths(spark, base):
    """Ranges of widths far apart, each in two bins at most."""
    width = F.when(F.col("s_suppkey") % 4 == 0, 1).when(F.col("s_suppkey") % 4 == 1, 20).when(F.col("s_suppkey") % 4 == 2, 90).otherwise(300)
    ranges = load(spark, base, "supplier").select("s_suppkey", F.col("s_acctbal").alias("low"), (F.col("s_acctbal") + width).alias("high"))
    return range_join(load(spark, base, "part").select("p_partkey", "p_retailprice"), ranges, "p_retailprice", "low", "high").select("p_partkey", "s_suppkey")


@paired("""SELECT a.event_id AS a_id, b.event_id AS b_id FROM events a JOIN events b ON a.user_id = b.user_id AND a.event_type = 'view' AND b.event_type = 'purchase'
    AND a.ts <= b.ts + INTERVAL 3 HOUR AND b.ts <= a.ts + to_minutes(5 + a.event_id % 600)""")
def join_overlap(spark, base):
    """Views of 5 minutes to 10 hours and three hours around purchases of the same user, where they overlap."""
    events = load(spark, base, "events")
    views = events.filter("event_type = 'view'").select("user_id", F.col("event_id").alias("a_id"), F.col("ts").alias("a_from"), (F.col("ts") + F.make_dt_interval(mins=(5 + F.col("event_id") % 600).cast("int"))).alias("a_to"))
    buys = events.filter("event_type = 'purchase'").select("user_id", F.col("event_id").alias("b_id"), F.col("ts").alias("b_from"), (F.col("ts") + F.expr("interval 3 hours")).alias("b_to"))
    return overlap_join(views, buys, ("a_from", "a_to"), ("b_from", "b_to"), ["user_id"]).select("a_id", "b_id")


# skew


@paired("SELECT event_id, c_custkey, c_name FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 7 ELSE event_id % 2000 END AS k FROM events) e LEFT JOIN customer ON k = c_custkey")
def join_skew(spark, base):
    """A key on a third of all rows is dealt over tasks; only its row of the other side is copied."""
    rows = load(spark, base, "events").select("event_id", F.when(F.col("event_id") % 3 == 0, 7).otherwise(F.col("event_id") % 2000).cast("long").alias("k"))
    customers = load(spark, base, "customer").select(F.col("c_custkey").alias("k"), "c_custkey", "c_name")
    return skew_join(rows, customers, ["k"], "left").select("event_id", "c_custkey", "c_name")


# ranks over whole tables


@paired("""SELECT a.o_orderkey, count(b.o_orderkey) AS n, CAST(sum(CAST(b.o_totalprice AS DECIMAL(18,4))) AS DOUBLE) AS total FROM orders a
    LEFT JOIN orders b ON a.o_orderpriority = b.o_orderpriority AND b.o_totalprice < a.o_totalprice GROUP BY a.o_orderkey""")
def join_theta_totals(spark, base):
    """Number and sum of the cheaper orders of the same priority; five priorities hold all rows, and no pair is formed."""
    orders = load(spark, base, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    out = inequality_totals(orders, orders, ["o_orderpriority"], ("o_totalprice", "o_totalprice"), "<", {"n": ("count", "o_orderkey"), "total": ("sum", F.col("o_totalprice").cast("decimal(18,4)"))})
    return out.select("o_orderkey", "n", F.col("total").cast("double").alias("total"))


@paired("SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS rn, ntile(7) OVER (ORDER BY o_totalprice, o_orderkey) AS tile FROM orders")
def rank_row_numbers(spark, base):
    orders = load(spark, base, "orders").select("o_orderkey", "o_totalprice")
    order = ["o_totalprice", "o_orderkey"]
    return ntile(row_numbers(orders, order, "rn"), order, 7, "tile").select("o_orderkey", "rn", "tile")


@paired("""SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, rank() OVER w AS rk, dense_rank() OVER w AS dr, percent_rank() OVER w AS pr, cume_dist() OVER w AS cd FROM lineitem WINDOW w AS (ORDER BY l_quantity)""")
def rank_whole_table(spark, base):
    """Fifty keys share all rows: ranks of keys are worked out once, and looked up."""
    rows = load(spark, base, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return ranks(rows, ["l_quantity"], {"rank": "rk", "dense_rank": "dr", "percent_rank": "pr", "cume_dist": "cd"})


@paired("""SELECT event_id, CAST(sum(CAST(value AS DECIMAL(18,4))) OVER w AS DOUBLE) AS total, max(value) OVER w AS top, count(*) FILTER (WHERE event_type = 'click') OVER w AS clicks
    FROM events WINDOW w AS (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def running_totals_whole_table(spark, base):
    rows = load(spark, base, "events").withColumn("exact", F.col("value").cast("decimal(18,4)"))
    out = running(rows, ["ts", "event_id"], {"total": ("sum", "exact"), "top": ("max", "value"), "clicks": ("count", F.when(F.col("event_type") == "click", 1))})
    return out.select("event_id", F.col("total").cast("double").alias("total"), "top", "clicks")


# mergeable states


@paired("SELECT l_returnflag, year(l_shipdate) AS y, count(DISTINCT l_orderkey) AS n FROM lineitem GROUP BY ALL")
def sketch_bitmap_rollup(spark, base):
    """Exact distinct orders by year from bitmaps stored by day."""
    rows = load(spark, base, "lineitem").withColumn("day", F.to_date("l_shipdate"))
    days = sketches.bitmaps(rows, ["l_returnflag", "day"], "l_orderkey")
    years = sketches.merged_bitmaps(days.withColumn("y", F.year("day").cast("long")), ["l_returnflag", "y"])
    return sketches.bitmap_counts(years, ["l_returnflag", "y"])


@paired("SELECT l_returnflag, count(DISTINCT CAST(l_shipdate AS DATE)) AS days, true AS within_bound FROM lineitem GROUP BY l_returnflag")
def sketch_distinct_rollup(spark, base):
    """Distinct parts of each flag from states stored by day, against exact counts: the estimate is within three standard deviations."""
    rows = load(spark, base, "lineitem").withColumn("day", F.to_date("l_shipdate"))
    days = sketches.states(rows, ["l_returnflag", "day"], distinct={"parts": "l_partkey"})
    whole = sketches.merged(days, ["l_returnflag"], distinct=["parts"])
    exact = sketches.bitmap_counts(sketches.bitmaps(rows, ["l_returnflag"], "l_partkey"), ["l_returnflag"], "exact")
    n = days.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("days"))
    near = F.abs(sketches.distinct_of("parts") - F.col("exact")) <= F.col("exact") * sketches.distinct_error() + 1
    return whole.join(exact, "l_returnflag").join(n, "l_returnflag").select("l_returnflag", "days", near.alias("within_bound"))


@paired("SELECT l_returnflag, CAST(q AS DOUBLE) AS q, count(*) AS n, true AS within_bound FROM lineitem, (VALUES (0.05), (0.5), (0.95)) v(q) GROUP BY ALL")
def sketch_quantile_rollup(spark, base):
    """Quantiles of each flag from states stored by day; the share of rows up to each is near what was asked for."""
    rows = load(spark, base, "lineitem").withColumn("day", F.to_date("l_shipdate"))
    days = sketches.states(rows, ["l_returnflag", "day"], quantiles={"price": "l_extendedprice"})
    whole = sketches.merged(days, ["l_returnflag"], quantiles=["price"])
    asked = whole.select("l_returnflag", F.explode(F.array(*[F.struct(F.lit(q).alias("q"), sketches.quantile_of("price", q).alias("at")) for q in (0.05, 0.5, 0.95)])).alias("z")).select("l_returnflag", "z.q", "z.at")
    share = rows.select("l_returnflag", "l_extendedprice").join(F.broadcast(asked), "l_returnflag").groupBy("l_returnflag", "q").agg(F.count(F.lit(1)).alias("n"), F.avg((F.col("l_extendedprice") <= F.col("at")).cast("double")).alias("share"))
    return share.select("l_returnflag", "q", "n", (F.abs(F.col("share") - F.col("q")) <= sketches.RANK_ERROR + 1 / F.col("n")).alias("within_bound"))


# user functions


@paired("""WITH m AS (SELECT l_returnflag, regr_sxx(l_extendedprice, l_quantity) AS sqq, regr_sxx(l_extendedprice, l_discount) AS sdd, regr_sxy(l_extendedprice, l_quantity) AS syq, regr_sxy(l_extendedprice, l_discount) AS syd,
    regr_sxy(l_quantity, l_discount) AS sqd, avg(l_extendedprice) AS y, avg(l_quantity) AS q, avg(l_discount) AS d FROM lineitem GROUP BY l_returnflag),
    b AS (SELECT *, (syq * sdd - syd * sqd) / (sqq * sdd - sqd * sqd) AS b1, (syd * sqq - syq * sqd) / (sqq * sdd - sqd * sqd) AS b2 FROM m)
    SELECT l_returnflag, round(y - b1 * q - b2 * d, 3) AS b0, round(b1, 3) AS b1, round(b2, 3) AS b2 FROM b""")
def udaf_least_squares(spark, base):
    """A fit of the price on quantity and discount; each task sends one state for each flag."""
    fit = user_aggregate(load(spark, base, "lineitem"), ["l_returnflag"], ["l_extendedprice", "l_quantity", "l_discount"], LeastSquares(3), "b0 double, b1 double, b2 double")
    return fit.select("l_returnflag", *[F.round(c, 3).alias(c) for c in ("b0", "b1", "b2")])


@paired("""SELECT user_id, event_type AS value, min(ts) AS first_at, max(ts) AS last_at, count(*) AS n FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts) - row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts) AS g FROM events) GROUP BY user_id, event_type, g""")
def udtf_islands(spark, base):
    return islands(load(spark, base, "events"), ["user_id"], "event_type", "ts")


# series


@paired("""WITH b AS (SELECT user_id, time_bucket(INTERVAL 6 HOUR, ts) AS b, count(*) AS n, max(value) AS v FROM events GROUP BY ALL),
    g AS (SELECT *, lead(b) OVER w AS nb, lead(v) OVER w AS nv FROM b WINDOW w AS (PARTITION BY user_id ORDER BY b)),
    s AS (SELECT *, unnest(range(coalesce(CAST(epoch_us(nb) - epoch_us(b) AS BIGINT) // 21600000000, 1))) AS i, coalesce((epoch_us(nb) - epoch_us(b)) // 21600000000, 1) AS k FROM g)
    SELECT user_id, b + i * INTERVAL 6 HOUR AS bucket, CASE WHEN i = 0 THEN n END AS n, v AS carried, round(CASE WHEN i = 0 THEN v ELSE v + (nv - v) * (i / k) END, 6) AS line, i > 0 AS filled FROM s""")
def series_gaps_filled(spark, base):
    """Six-hour steps of each user without holes: counts as they are, values carried on and on a line."""
    out = fill_gaps(load(spark, base, "events"), ["user_id"], "ts", "6 hours", {"n": F.count(F.lit(1)), "carried": F.max("value"), "line": F.max("value")}, ["carried"], ["line"])
    return out.withColumn("line", F.round("line", 6))


# sources


@paired("SELECT event_id, user_id, ts, value FROM events WHERE ts >= TIMESTAMP '2024-01-20' AND ts < TIMESTAMP '2024-01-22' AND event_type = 'click'")
def source_commit_log(spark, base):
    """Written through the data source in two commits, read back with filters that leave out files."""
    register_commit_log(spark)
    events, to = load(spark, base, "events"), scratch(spark, "log")
    for half in ("ts < timestamp_ntz'2024-01-15'", "ts >= timestamp_ntz'2024-01-15'"):
        events.filter(half).write.format("tessera_log").mode("append").save(to)
    rows = spark.read.format("tessera_log").load(to)
    return rows.filter("ts >= timestamp_ntz'2024-01-20' AND ts < timestamp_ntz'2024-01-22' AND event_type = 'click'").select("event_id", "user_id", "ts", "value")


# streams

#: Runs in the order of time, and ones of which the last brings rows that are late.
IN_ORDER = ["ts < timestamp_ntz '2024-01-10'", "ts >= timestamp_ntz '2024-01-10' AND ts < timestamp_ntz '2024-01-20'", "ts >= timestamp_ntz '2024-01-20'"]
LATE = ["ts < timestamp_ntz '2024-01-10' AND event_id % 50 <> 0", IN_ORDER[1], f"{IN_ORDER[2]} OR ts < timestamp_ntz '2024-01-10' AND event_id % 50 = 0"]
#: The same late rows, with the run after that of their time.
LATE_AFTER_ONE = [LATE[0], "ts < timestamp_ntz '2024-01-20' AND (ts >= timestamp_ntz '2024-01-10' OR event_id % 50 = 0)", IN_ORDER[2]]


@paired("""SELECT s.user_id, s.event_id, s.ts FROM events s, (SELECT max(ts) - INTERVAL 10 MINUTE AS mark FROM events WHERE event_type IN ('signup', 'click')) m
    WHERE s.event_type = 'signup' AND s.ts + INTERVAL 8 HOUR < m.mark
    AND NOT EXISTS (SELECT 1 FROM events c WHERE c.user_id = s.user_id AND c.event_type = 'click' AND c.ts > s.ts AND c.ts <= s.ts + INTERVAL 8 HOUR)""")
def stream_no_follow_up(spark, base):
    """Event-time timers: signups without a click within eight hours, told when the watermark has passed them."""
    landing = ev.Landing(load(spark, base, "events"))
    with ev.rocksdb_state(spark):
        out = ev.run_to_table(ev.not_followed(landing.stream, "signup", "click", "8 hours"), "append", landings=[landing], arrivals=IN_ORDER)
    return out.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@paired("SELECT user_id, min(event_id) AS event_id FROM events GROUP BY user_id")
def stream_first_seen(spark, base):
    """State with a time to live: the first event of each user, over three runs."""
    landing = ev.Landing(load(spark, base, "events"))
    with ev.rocksdb_state(spark, idle_batches=False):
        return ev.run_to_table(ev.first_seen(landing.stream, "30 days"), "append", landings=[landing], arrivals=IN_ORDER)


@paired("""WITH p AS (SELECT a.event_id AS click, b.event_id AS purchase FROM events a JOIN events b ON a.user_id = b.user_id AND a.event_type = 'click' AND b.event_type = 'purchase' AND b.ts > a.ts AND b.ts <= a.ts + INTERVAL 6 HOUR),
    m AS (SELECT least(max(ts) FILTER (event_type = 'click'), max(ts) FILTER (event_type = 'purchase')) - INTERVAL 10 MINUTE AS mark FROM events)
    SELECT click, purchase FROM p UNION ALL
    SELECT event_id, NULL FROM events, m WHERE event_type = 'click' AND ts + INTERVAL 6 HOUR < mark AND event_id NOT IN (SELECT click FROM p)""")
def stream_outer_join(spark, base):
    """Clicks with purchases of the next six hours, and those without once the watermark rules purchases out."""
    events = load(spark, base, "events")
    sides = [ev.Landing(events.filter(f"event_type = '{kind}'").select("event_id", "user_id", "ts")) for kind in ("click", "purchase")]
    rows = ev.interval_pairs_or_none(sides[0].stream.alias("l"), sides[1].stream.alias("r"), "user_id", "l.ts", "r.ts", "6 hours")
    return ev.run_to_table(rows.select(F.col("l.event_id").alias("click"), F.col("r.event_id").alias("purchase")), "append", landings=sides, arrivals=IN_ORDER)


@paired("SELECT event_type, user_id, max(ts) AS ts, max_by(event_id, ts) AS event_id, max_by(value, ts) AS value FROM events GROUP BY event_type, user_id")
def stream_partitioned_upsert(spark, base):
    """The last event of each user and type, in a table partitioned by type; runs bring late rows, which don't replace later ones."""
    landing, to = ev.Landing(load(spark, base, "events")), scratch(spark, "last")
    rows = landing.stream.select("event_type", "user_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "event_id", "value")
    ev.run_to_table(rows, "append", landings=[landing], arrivals=LATE, put=lambda batch, _: upsert(batch, to, ["event_type", "user_id"], ["event_type"], "ts"))
    return spark.read.schema(rows.schema).parquet(to)


@paired("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def stream_commit_log(spark, base):
    """A stream into the commit log and one out of it, each in three runs."""
    register_commit_log(spark)
    events, (to, state) = load(spark, base, "events"), (scratch(spark, n) for n in ("log", "state"))
    landing = ev.Landing(events.select("event_type", "event_id", "ts"))
    for rows in IN_ORDER:
        landing.land(rows)
        landing.stream.writeStream.format("tessera_log").option("path", to).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    landing.close()
    deleted(spark, state)
    counts = spark.readStream.format("tessera_log").load(to).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return ev.run_to_table(counts)
