"""Event-time operators; each works on batch and streaming frames alike."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tessera.shipping import ship
from tessera.sources import deleted, scratch, stream
from tessera.sources.tables import free

#: Groups that the keys of custom state are dealt to; a state holds its group's keys as arrays, so calls into Python and into the store go by groups and micro-batches, not by keys. It must stay as it is for the life of a stream.
GROUPS = 1024


def dealt(df: DataFrame, key: str, *others: str) -> tuple[DataFrame, str, str]:
    """The key (0 for null), the other columns, whether the key was null, and its group; with the names of the last two, as names that begin with _ do not reach state functions."""
    none, group = free(df, "null_key"), free(df, "key_group")
    return df.select(F.coalesce(key, F.lit(0)).cast("long").alias(key), *others, F.col(key).isNull().alias(none), F.pmod(F.xxhash64(key), F.lit(GROUPS)).cast("int").alias(group)), none, group


def event_time(df: DataFrame, ts: str = "ts", late: str = "10 minutes") -> DataFrame:
    """With ts as an instant (watermarks need one) and a watermark."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)


def tumbling(df: DataFrame, width: str, keys: list[str], ts: str = "ts") -> DataFrame:
    return df.groupBy(F.window(ts, width).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(18,4)")).cast("double").alias("total")).select(F.col("w.start").alias("window_start"), *keys, "n", "total")


def sliding(df: DataFrame, width: str, slide: str, ts: str = "ts") -> DataFrame:
    return df.groupBy(F.window(ts, width, slide).alias("w")).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), "n")


def session_counts(df: DataFrame, gap: str, key: str = "user_id", ts: str = "ts") -> DataFrame:
    return df.groupBy(F.session_window(ts, gap).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(key, F.col("w.start").alias("session_start"), "n")


def deduplicated(df: DataFrame, keys: list[str]) -> DataFrame:
    """First arrival of each key within the watermark, so state does not grow with the stream."""
    return df.dropDuplicatesWithinWatermark(keys)


def running_totals(df: DataFrame, key: str = "user_id", value: str = "value") -> DataFrame:
    """Custom state: rows and total so far of each key, sent on at each trigger."""
    rows, none, group = dealt(df, key, value)

    def add(_, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = {k: (n, total) for k, n, total in zip(*state.get, strict=True)} if state.exists else {}
        new = {}
        for b in batches:
            sums = b.groupby([none, key])[value].agg(["size", "sum"])
            for (is_none, k), n, total in sums.itertuples():
                k = None if is_none else int(k)
                before = held.get(k, (0, 0.0))
                new[k] = held[k] = (before[0] + int(n), before[1] + float(total))
        state.update((list(held), [n for n, _ in held.values()], [t for _, t in held.values()]))
        yield pd.DataFrame({key: pd.Series(list(new), dtype="Int64"), "n": [n for n, _ in new.values()], "total": [t for _, t in new.values()]})

    return rows.groupBy(group).applyInPandasWithState(add, f"{key} long, n long, total double", "keys array<long>, n array<long>, total array<double>", "update", GroupStateTimeout.NoTimeout)


class KindCounts(StatefulProcessor):
    """Value state of a group of keys: rows so far of each key and kind; those of the kinds in a micro-batch are sent on."""

    def __init__(self, key: str, kind: str, none: str):
        self.key, self.kind, self.none = key, kind, none

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counts = handle.getValueState("counts", "keys array<bigint>, kinds array<string>, n array<bigint>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = {(k, kind): n for k, kind, n in zip(*self.counts.get(), strict=True)} if self.counts.exists() else {}
        new = {}
        for b in rows:
            for (is_none, k, kind), n in b.groupby([self.none, self.key, self.kind], dropna=False).size().items():
                at = (None if is_none else int(k), kind if isinstance(kind, str) else None)
                new[at] = held[at] = held.get(at, 0) + int(n)
        self.counts.update(([k for k, _ in held], [kind for _, kind in held], list(held.values())))
        yield pd.DataFrame({self.key: pd.Series([k for k, _ in new], dtype="Int64"), self.kind: [kind for _, kind in new], "n": list(new.values())})

    def close(self) -> None:
        pass


def kind_counts(df: DataFrame, key: str = "user_id", kind: str = "event_type") -> DataFrame:
    """transformWithState: the count so far of each key and kind; runs within rocksdb_state."""
    ship(df.sparkSession)
    rows, none, group = dealt(df, key, kind)
    return rows.groupBy(group).transformWithStateInPandas(KindCounts(key, kind, none), f"{key} long, {kind} string, n long", "Update", "None")


@contextmanager
def rocksdb_state(spark: SparkSession, idle_batches: bool = True) -> Iterator[None]:
    """Streams started within keep their state in RocksDB, outside the executors' heap.

    idle_batches: whether batches without rows run, as timers of event time
    need. State that expires by the clock would have them run for ever, so a
    run to the end of what is there must go without.
    """
    conf = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider", "spark.sql.streaming.noDataMicroBatches.enabled": str(idle_batches).lower()}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def interval_pairs(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, after: str) -> DataFrame:
    """Stream-stream join: pairs of equal keys with right_ts in (left_ts, left_ts + after]; with watermarks on both, state is bounded by the interval."""
    later = F.col(left_ts) + F.expr(f"interval {after}")
    return left.join(right, (F.col(f"l.{key}") == F.col(f"r.{key}")) & (F.col(right_ts) > F.col(left_ts)) & (F.col(right_ts) <= later))


def interval_pairs_or_none(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, after: str) -> DataFrame:
    """As interval_pairs, and each left row without a partner once, with nulls, when the watermark says that none can come any more.

    Both sides need watermarks: they bound the state, and a left row leaves it
    when the watermark has passed its interval.
    """
    later = F.col(left_ts) + F.expr(f"interval {after}")
    return left.join(right, (F.col(f"l.{key}") == F.col(f"r.{key}")) & (F.col(right_ts) > F.col(left_ts)) & (F.col(right_ts) <= later), "leftOuter")


class NoFollowUp(StatefulProcessor):
    """Event-time timers: first events that no second event of the key follows within some time.

    State of a group of keys: first events that still wait, and times of
    second events that first events which come late may still need. Its one
    timer is at the earliest end of a first event's time or time of a second
    event; when it fires, the first events whose time the watermark has passed
    are told and the second ones behind it are forgotten, as rows before the
    watermark are dropped. So state is bounded by what happens within the time
    and the watermark's delay, and a group is called once a micro-batch.
    """

    def __init__(self, key: str, kind: str, first: str, second: str, ts: str, row_id: str, within_ms: int, none: str):
        self.key, self.kind, self.first, self.second, self.ts, self.row_id, self.span, self.none = key, kind, first, second, ts, row_id, within_ms * 1000, none

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "first_keys array<bigint>, first_none array<boolean>, first_ids array<bigint>, first_at array<bigint>, second_keys array<bigint>, second_at array<bigint>, timer bigint")

    def load(self) -> tuple[pd.DataFrame, pd.DataFrame, int | None]:
        keys, none, ids, at, second_keys, second_at, timer = self.held.get() if self.held.exists() else ([], [], [], [], [], [], None)
        whole = lambda v: pd.Series(v, dtype="int64")
        return pd.DataFrame({"key": whole(keys), "none": pd.Series(none, dtype="bool"), "id": whole(ids), "at": whole(at)}), pd.DataFrame({"key": whole(second_keys), "at": whole(second_at)}), timer

    def store(self, firsts: pd.DataFrame, seconds: pd.DataFrame, before: int | None) -> None:
        """What is left, with a timer at the earliest time that something of it is due."""
        ends = [int(at.min()) // 1000 + 1 for at in (firsts["at"] + self.span, seconds["at"]) if len(at)]
        timer = min(ends, default=None)
        if timer != before:
            if before is not None:
                self.handle.deleteTimer(before)
            if timer is not None:
                self.handle.registerTimer(timer)
        if timer is None:
            self.held.clear()
        else:
            self.held.update((*[firsts[c].tolist() for c in ("key", "none", "id", "at")], seconds["key"].tolist(), seconds["at"].tolist(), timer))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        waiting, known, timer = self.load()
        firsts, seconds = [waiting], [known]
        for b in rows:
            own = pd.DataFrame({"key": b[self.key].to_numpy("int64"), "none": b[self.none].to_numpy("bool"), "id": b[self.row_id].to_numpy("int64"), "at": b[self.ts].to_numpy("datetime64[us]").astype("int64")})
            firsts.append(own[(b[self.kind] == self.first).to_numpy()])
            seconds.append(own.loc[(b[self.kind] == self.second).to_numpy() & ~own["none"], ["key", "at"]])
        first = pd.concat(firsts, ignore_index=True).drop_duplicates(["key", "none", "id"], keep="last").sort_values("at", kind="stable")
        second = pd.concat(seconds, ignore_index=True).drop_duplicates().sort_values("at", kind="stable")
        after = pd.merge_asof(first, second.assign(none=False, next=second["at"]), on="at", by=["none", "key"], direction="forward", allow_exact_matches=False, tolerance=self.span)
        self.store(first[after["next"].isna().to_numpy()], second, timer)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        firsts, seconds, timer = self.load()
        now = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs()) * 1000
        told = firsts[firsts["at"] + self.span < now]
        # the timer that fires is deleted by the engine
        self.store(firsts[firsts["at"] + self.span >= now], seconds[seconds["at"] >= now], None if timer == expiredTimerInfo.getExpiryTimeInMs() else timer)
        if len(told):
            yield pd.DataFrame({self.key: told["key"].astype("Int64").mask(told["none"]), self.row_id: told["id"], self.ts: pd.to_datetime(told["at"], unit="us", utc=True)})

    def close(self) -> None:
        pass


def not_followed(df: DataFrame, first: str, second: str, within: str, key: str = "user_id", kind: str = "event_type", ts: str = "ts", row_id: str = "event_id") -> DataFrame:
    """key, row_id and ts of events of kind `first` after which no event of kind `second` of the same key came in (ts, ts + within].

    df: a stream with a watermark; a row comes out once the watermark has
    passed its time. Runs within rocksdb_state; time zones play no part.
    """
    ship(df.sparkSession)
    micros = df.sparkSession.sql(f"SELECT timestampdiff(MICROSECOND, timestamp_ntz'2001-01-01', timestamp_ntz'2001-01-01' + INTERVAL {within})").first()[0]
    rows, none, group = dealt(df.filter(F.col(kind).isin(first, second)), key, kind, ts, row_id)
    return rows.groupBy(group).transformWithStateInPandas(NoFollowUp(key, kind, first, second, ts, row_id, micros // 1000, none), f"{key} long, {row_id} long, {ts} timestamp", "Append", "EventTime")


class FirstSeen(StatefulProcessor):
    """Value state that expires: the first row of a key, and again if the key was not seen for so long by the clock."""

    def __init__(self, key: str, row_id: str, ttl_ms: int):
        self.key, self.row_id, self.ttl_ms = key, row_id, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "id bigint", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        least = min(int(b[self.row_id].min()) for b in rows)
        if not self.seen.exists():
            yield pd.DataFrame({self.key: [key[0]], self.row_id: [least]})
            self.seen.update((least,))
        else:
            self.seen.update(self.seen.get())  # seen again: its time starts anew

    def close(self) -> None:
        pass


def first_seen(df: DataFrame, ttl: str, key: str = "user_id", row_id: str = "event_id") -> DataFrame:
    """key and row_id of the first row of each key; state of a key goes after ttl without rows, so it is bounded by the keys of that time. Runs within rocksdb_state, without idle batches if it is to end."""
    ship(df.sparkSession)
    micros = df.sparkSession.sql(f"SELECT timestampdiff(MICROSECOND, timestamp_ntz'2001-01-01', timestamp_ntz'2001-01-01' + INTERVAL {ttl})").first()[0]
    return df.select(key, row_id).groupBy(key).transformWithStateInPandas(FirstSeen(key, row_id, micros // 1000), f"{key} long, {row_id} long", "Append", "ProcessingTime")


class Landing:
    """A folder where rows arrive in files, and the stream that reads it; arrivals are written by as many tasks as their rows come in."""

    def __init__(self, df: DataFrame, late: str = "10 minutes", ts: str = "ts"):
        self.df, self.path = df, scratch(df.sparkSession, "landing")
        df.limit(0).write.parquet(self.path)
        self.stream = event_time(stream(df.sparkSession, self.path, df.schema), ts, late)

    def land(self, rows: str | None = None) -> None:
        """Add the rows that meet a condition, as a batch of files."""
        (self.df.filter(rows) if rows else self.df).write.mode("append").parquet(self.path)

    def close(self) -> None:
        """Delete the folder."""
        deleted(self.df.sparkSession, self.path)


def run_to_table(df: DataFrame, mode: str = "complete", keys: tuple[str, ...] = (), landings: Sequence[Landing] = (), arrivals: Sequence[str] = (), put: Callable[[DataFrame, int], None] | None = None) -> DataFrame:
    """Run a stream over all that is there now, and its result, from files in the shared folder.

    With landings, the stream runs once after each of the arrivals (conditions
    on the rows of each landing), from where it stopped, as a job that is
    started each day would: state and watermark go on, and each run reads its
    files in parallel. Each micro-batch writes a folder of its own, so one
    that is run again replaces what it wrote. complete: the last batch's rows;
    append: the rows of all; update: for each of keys the row that came last.
    put: what is done with a batch instead; then no rows are returned. State
    and landings are deleted at the end.
    """
    spark, to = df.sparkSession, scratch(df.sparkSession, "stream")
    seen: list[int] = []

    def stored(rows: DataFrame, batch: int) -> None:
        if put:
            put(rows, batch)
        else:
            rows.write.mode("overwrite").parquet(f"{to}/rows/batch={batch}")
            seen.append(batch)

    for rows in arrivals or [None]:
        for landing in landings:
            landing.land(rows)
        query = df.writeStream.foreachBatch(stored).outputMode(mode).option("checkpointLocation", f"{to}/state").trigger(availableNow=True).start()
        query.awaitTermination()
    deleted(spark, f"{to}/state")
    for landing in landings:
        landing.close()
    if not seen:
        return spark.createDataFrame([], df.schema)
    out = spark.read.parquet(f"{to}/rows")
    if mode == "complete":
        return out.filter(F.col("batch") == max(seen)).drop("batch")
    if mode == "update":
        last = out.groupBy(*keys).agg(F.max("batch").alias("batch"))
        out = out.join(last, [*keys, "batch"])
    return out.drop("batch").select(*df.columns)
