"""Alerts for follow-ups that are missing: a stateful streaming query, started anew for each batch of arrivals on one checkpoint."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from . import common

HOUR = 3_600_000_000
#: Spark's event time counts milliseconds. The clock is rescaled, a millisecond of it being a microsecond, so that watermark and timers are exact; its zero is 1900,
#: as a watermark is never below zero, and its end is what a timestamp can hold.
ZERO, MOST, END = 2_208_988_800_000_000, 8_900_000_000_000_000, 9_000_000_000_000_000
#: Events of a batch that the clients of one state key have on average.
EVENTS_PER_KEY = 500
#: Events in one element of the buffer's list.
RUN = 4096
CLICK, SALE = 0, 1
# the worker that Spark starts on the driver to look at a state's schema knows no files that were sent to the executors
cloudpickle.register_pickle_by_value(sys.modules[__name__])
EVENT = "client_id long, us long, kind int, n long"
OUT = "batch int, client_id long, opened_us long, due_us long, n_rows long"


def micros(df: DataFrame, name: str) -> Column:
    """Microseconds since 1970 UTC of a timestamp; one without a zone is taken as UTC, whatever the session's zone."""
    if dict(df.dtypes)[name] != "timestamp_ntz":
        return F.unix_micros(F.col(name).cast("timestamp"))
    since = f"(`{name}` - TIMESTAMP_NTZ'1970-01-01 00:00:00')"
    return F.expr(f"extract(DAY FROM {since}) * 86400000000L + extract(HOUR FROM {since}) * 3600000000L + extract(MINUTE FROM {since}) * 60000000L + CAST(extract(SECOND FROM {since}) * 1000000 AS BIGINT)")


def batch_of(arrived_us: Column, row_id: Column, batches: int, hours: int) -> Column:
    """The batch in which a row arrives: its arrival's whole hours since 2024, plus 80 for each step of its id's checksum mod 4. A null arrival is in the last one."""
    whole = (arrived_us - F.pmod(arrived_us, F.lit(HOUR))) / F.lit(HOUR) - F.lit(473352)
    late = F.crc32(F.coalesce(row_id.cast("string"), F.lit("")).cast("binary")) % 4 * 80
    return F.coalesce(F.greatest(F.lit(0), F.least(F.lit(batches - 1), F.floor((whole + late) * batches / hours))), F.lit(batches - 1)).cast("int")


def events(clicks: DataFrame, sales: DataFrame, batches: int = 8, hours: int = 3648) -> DataFrame:
    """batch, client_id, us, kind, n: error clicks, equal rows once, and sales, those with a client and a time; n of them at one time of a client are one row, added up
    before they are dealt to their client."""
    c = clicks.filter("kind = 'error' AND client_id IS NOT NULL AND ts IS NOT NULL").distinct()
    c = c.select(batch_of(micros(c, "arrived_at"), F.col("click_id"), batches, hours).alias("batch"), "client_id", micros(c, "ts").alias("us"), F.lit(CLICK).alias("kind"))
    s = sales.filter("client_id IS NOT NULL AND sold_at IS NOT NULL")
    s = s.select(batch_of(micros(s, "arrived_at"), F.col("sale_id"), batches, hours).alias("batch"), "client_id", micros(s, "sold_at").alias("us"), F.lit(SALE).alias("kind"))
    return c.union(s).groupBy("batch", "client_id", "us", "kind").agg(F.count("*").alias("n"))


def clock(us: np.ndarray) -> np.ndarray:
    return np.clip(us + ZERO, 0, MOST)


class Obligations(StatefulProcessor):
    """Clients' events in the order of their times, and what each client owes.

    Events that aren't late wait in a list state until the watermark has passed them; obligations that are open are a value state; timers wake a key when its
    first event can be taken out of the buffer and when its first obligation is due. A key is a client, or a group of clients of which every row names its own."""

    def __init__(self, batch: int, open_us: int) -> None:
        self.batch, self.open_us = batch, open_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buffer = handle.getListState("buffer", "events binary")
        self.owed = handle.getValueState("owed", "obligations binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        late: dict[int, int] = {}
        new = []
        for part in rows:
            e = part[["client_id", "us", "kind", "n"]].to_numpy("int64")
            e = e[e[:, 3] > 0]
            behind = clock(e[:, 1]) < now
            for client, n in e[behind][:, [0, 3]].tolist():
                late[client] = late.get(client, 0) + n
            new.append(e[~behind])
        if late:
            yield self._rows([(client, -1, -1, n) for client, n in late.items()])
        yield from self._settle(np.concatenate(new), now)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._settle(np.empty((0, 4), "int64"), timerValues.getCurrentWatermarkInMs())

    def _rows(self, found: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame([(self.batch, *r) for r in found], columns=["batch", "client_id", "opened_us", "due_us", "n_rows"])

    def _settle(self, new: np.ndarray, now: int) -> Iterator[pd.DataFrame]:
        """Takes what lies before the watermark out of the buffer, applies it in order, and alerts what is due before the watermark."""
        waiting = np.concatenate([new, *(np.frombuffer(x[0], "int64").reshape(-1, 4) for x in self.buffer.get())])
        ready = clock(waiting[:, 1]) < now
        rest = waiting[~ready]
        if ready.any() or len(new):
            self.buffer.clear()
            if len(rest):
                self.buffer.put([(rest[i : i + RUN].tobytes(),) for i in range(0, len(rest), RUN)])
        held = self.owed.get()
        owed = {c: [opened, n] for c, opened, n in np.frombuffer(held[0], "int64").reshape(-1, 3).tolist()} if held else {}
        alerts = self._apply(owed, waiting[ready])
        for client in [c for c, (opened, _) in owed.items() if clock(np.int64(opened + self.open_us)) < now]:
            alerts.append((client, *owed.pop(client)))
        if owed:
            self.owed.update((np.array([(c, *x) for c, x in owed.items()], "int64").tobytes(),))
        elif held:
            self.owed.clear()
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        # a timer at t runs when the watermark is beyond t
        wake = ([int(clock(rest[:, 1].min()))] if len(rest) else []) + ([int(clock(np.int64(min(x[0] for x in owed.values()) + self.open_us)))] if owed else [])
        for t in sorted({*wake}):
            self.handle.registerTimer(t)
        if alerts:
            yield self._rows([(client, opened, opened + self.open_us, n) for client, opened, n in alerts])

    def _apply(self, owed: dict[int, list[int]], e: np.ndarray) -> list[tuple[int, int, int]]:
        """Goes through events by client and time, clicks first on ties; events of clients who owe nothing and click nothing change nothing."""
        active = np.isin(e[:, 0], np.concatenate([e[e[:, 2] == CLICK, 0], np.fromiter(owed, "int64", len(owed))]))
        e = e[active]
        alerts = []
        for client, us, kind, n in e[np.lexsort((e[:, 2], e[:, 1], e[:, 0]))].tolist():
            x = owed.get(client)
            if x is not None and us > x[0] + self.open_us:
                alerts.append((client, *owed.pop(client)))
                x = None
            if kind == SALE:
                owed.pop(client, None)
            elif x is None:
                owed[client] = [us, n]
            else:
                x[1] += n
        return alerts


def missing_follow_ups(clicks: DataFrame, sales: DataFrame, batches: int = 8, hours: int = 3648, wait_us: int = 96 * HOUR, open_us: int = 24 * HOUR, single: bool = False) -> DataFrame:
    """batch, client_id, opened_us, due_us, n_rows: an alert per obligation that no sale cancels in time, and, with -1 for both times, late events per batch and client.

    A micro-batch is run per batch, each by a query started anew on one checkpoint, and last one that ends all obligations. A tick, which counts for nothing, keeps
    an empty batch from being left out and, in the end, moves the clock on. With `single` each client has a state key of its own; else clients share keys by hash,
    EVENTS_PER_KEY events of a batch to a key, which saves most calls between Spark and Python. Null clients and times are left out; equal clicks count once, equal
    sales each; an empty table gives an empty result; further columns only tell equal clicks apart. Times before 1900 and after 2182 count as those for the watermark."""
    spark = clicks.sparkSession
    s = spark.newSession()
    for k, v in {
        "spark.sql.shuffle.partitions": spark.conf.get("spark.sql.shuffle.partitions"), "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true", "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false", "spark.sql.streaming.stateStore.maintenanceInterval": "5s", "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    }.items():
        s.conf.set(k, v)
    where = common.folder(spark, "alerts")
    events(clicks, sales, batches, hours).write.partitionBy("batch").parquet(f"{where}/cut")
    cut = s.read.schema(f"{EVENT}, batch int").parquet(f"{where}/cut")
    keys = max(1, cut.count() // (batches * EVENTS_PER_KEY))
    key = F.col("client_id") if single else F.pmod(F.xxhash64("client_id"), F.lit(keys))
    for b in range(batches + 1):
        tick = s.createDataFrame([(0, 0, CLICK, 0)], EVENT).withColumn("clock", F.lit(END if b == batches else 0).cast("long"))
        rows = cut.filter(F.col("batch") == b).drop("batch").withColumn("clock", F.least(F.greatest(F.col("us") + ZERO, F.lit(0)), F.lit(MOST)).cast("long"))
        rows.unionByName(tick).write.mode("append").parquet(f"{where}/feed")
        s.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", str(b == batches).lower())
        fed = s.readStream.schema(f"{EVENT}, clock long").parquet(f"{where}/feed").withColumn("at", F.timestamp_millis("clock")).withWatermark("at", f"{wait_us} milliseconds")
        # without the clock's column Spark drops no late row: they are counted
        found = fed.select(key.alias("key"), "client_id", "us", "kind", "n").groupBy("key").transformWithStateInPandas(Obligations(b, open_us), OUT, "append", "eventtime")
        found.writeStream.format("parquet").option("path", f"{where}/found").option("checkpointLocation", f"{where}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(OUT).parquet(f"{where}/found")
