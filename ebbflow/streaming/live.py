"""Structured Streaming: bars with a watermark, online break alarms and regime filters, idempotent monthly ingestion."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..operators import series
from ..sources import dumps


def tumbling_bars(ticks: DataFrame, window: str, late: str) -> DataFrame:
    """Open, high, low, close and count of ticks (key, ts, value, tie) by key and window; later rows than the watermark are dropped."""
    order = F.struct("ts", "tie")
    return ticks.withWatermark("ts", late).groupBy("key", F.window("ts", window)).agg(
        F.min_by("value", order).alias("o"), F.max("value").alias("hi"), F.min("value").alias("lo"), F.max_by("value", order).alias("c"), F.count("*").alias("n")
    ).select("key", F.col("window.start").alias("start"), "o", "hi", "lo", "c", "n")


def keep_typed_state(spark: SparkSession) -> None:
    """State in typed columns needs the RocksDB store; call this before such a query starts. It is a setting of the session."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class _Detector(StatefulProcessor):
    """Feeds a series, in order of t, to a detector of operators.series whose fields are typed state.

    `warm` lists the first values of a series, until there are enough to make its detector; `model` holds the detector's fields after
    that. A series that has had no rows for idle_ms starts anew.
    """

    def __init__(self, fields: str, out: str, warmup: int, idle_ms: int | None):
        self.fields, self.out, self.warmup, self.idle_ms = fields, out, warmup, idle_ms

    def make(self, warm: list[float]):
        """A detector of the first values, and what it says of the last of them."""
        raise NotImplementedError

    def load(self, fields: tuple):
        raise NotImplementedError

    def save(self, model) -> tuple:
        raise NotImplementedError

    def add(self, model, x: float):
        raise NotImplementedError

    def init(self, handle) -> None:
        self.warm = handle.getListState("warm", "x double", self.idle_ms)
        self.model = handle.getValueState("model", self.fields, self.idle_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows)).sort_values("t", ignore_index=True)
        model = self.load(self.model.get()) if self.model.exists() else None
        warm = [] if model else [v for (v,) in self.warm.get()]
        held, got = len(warm), []
        for x in frame["x"]:
            if model:
                got.append(self.add(model, float(x)))
                continue
            warm.append(float(x))
            value = None
            if len(warm) >= self.warmup:
                model, value = self.make(warm)
            got.append(value)
        if model:
            self.model.update(self.save(model))
            self.warm.clear()
        else:
            self.warm.appendList([(v,) for v in warm[held:]])
        yield pd.DataFrame({"series_id": key[0], "t": frame["t"], self.out: got})

    def close(self) -> None:
        pass


class _Breaks(_Detector):
    FIELDS = ("mean", "sd", "up", "down", "since", "last")

    def make(self, warm):
        model = series.Cusum(warm)
        return model, [self.add(model, v) for v in warm][-1]

    def load(self, fields):
        model = series.Cusum([0.0])
        vars(model).update(zip(self.FIELDS, fields, strict=True), last=list(fields[-1]))
        return model

    def save(self, model):
        return (*[float(getattr(model, f)) for f in self.FIELDS[:4]], int(model.since), [float(v) for v in model.last])

    def add(self, model, x):
        return int(model.add(x))


#: Series whose hash leaves the same remainder are taken up together. State is laid out by it, so a checkpoint holds for one number.
BUCKETS = 256


class _Regimes(StatefulProcessor):
    """Feeds the series of a bucket, each in order of t, to series.AdaptiveRegimes side by side; state is typed, by bucket and series.

    `warm` lists the first values of a series until there are enough to fit its model; `model` holds the model's fields after that.
    """

    #: Field and its shape for two states of one feature.
    FIELDS = {"mean": (1, 2), "var": (1, 2), "move": (2, 2), "now": (2,), "n": (2,), "sum": (1, 2), "squares": (1, 2), "moves": (2, 2)}

    def __init__(self, warmup: int, idle_ms: int | None):
        self.warmup, self.idle_ms = warmup, idle_ms

    def init(self, handle) -> None:
        fields = "keep double, least double, " + ", ".join(f"`{f}` array<double>" for f in self.FIELDS)
        self.warm = handle.getMapState("warm", "series_id string", "x array<double>", self.idle_ms)
        self.model = handle.getMapState("model", "series_id string", fields, self.idle_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows)).sort_values(["series_id", "t"], ignore_index=True)
        code = frame["series_id"].factorize(use_na_sentinel=False)[0]
        starts = np.flatnonzero(np.diff(code, prepend=-1))
        frame["p1"] = np.nan
        known, fresh = [], []
        for lo, hi in zip(starts, [*starts[1:], len(frame)]):
            name, x = frame.at[lo, "series_id"], frame["x"].to_numpy(float)[lo:hi]
            fields = self.model.getValue((name,))
            if fields is not None:
                known.append((name, lo, x, fields))
                continue
            held = self.warm.getValue((name,))
            held = [] if held is None else list(held[0])
            if len(held) + len(x) < self.warmup:
                self.warm.updateValue((name,), ([*held, *x.tolist()],))
                continue
            if held:
                self.warm.removeKey((name,))
            fresh.append((name, lo - len(held), np.concatenate((held, x)), lo))
        known.sort(key=lambda s: -len(s[2]))
        fresh.sort(key=lambda s: -len(s[2]))
        p1 = frame["p1"].to_numpy(copy=True)
        if known:
            model = object.__new__(series.AdaptiveRegimes)
            model.keep, model.least = known[0][3][:2]
            for k, (f, shape) in enumerate(self.FIELDS.items()):
                setattr(model, f, np.array([s[3][2 + k] for s in known], float).T.reshape(*shape, -1))
            self.follow(model, known, p1)
        if fresh:
            model = series.AdaptiveRegimes(np.stack([s[2][: self.warmup] for s in fresh], axis=1)[None])
            self.follow(model, fresh, p1, self.warmup - 1)
        yield frame[["series_id", "t"]].assign(p1=p1)

    def follow(self, model, found: list[tuple], p1: np.ndarray, silent: int = 0) -> None:
        """Adds the values of each series (name, place of the first value in p1, values, ...), longest first, and stores its fields; the first `silent` say nothing."""
        n = np.array([len(s[2]) for s in found])
        x, places = np.zeros((n[0], len(n))), np.array([s[1] for s in found])
        for j, s in enumerate(found):
            x[: n[j], j] = s[2]
        for t, row in enumerate(x):
            m = int((n > t).sum())
            got = model.add(row[None, :m])[1]
            if t >= silent:
                p1[places[:m] + t] = got
        flat = [getattr(model, f).reshape(-1, len(n)).T.tolist() for f in self.FIELDS]
        for j, s in enumerate(found):
            self.model.updateValue((s[0],), (float(model.keep), float(model.least), *[f[j] for f in flat]))

    def close(self) -> None:
        pass


def _detect(stream: DataFrame, detector: _Detector, kind: str) -> DataFrame:
    mode = "none" if detector.idle_ms is None else "processingTime"
    return stream.groupBy("series_id").transformWithStateInPandas(detector, f"series_id string, t long, {detector.out} {kind}", "append", mode)


def online_cusum(stream: DataFrame, warmup: int = 24, idle_ms: int | None = None) -> DataFrame:
    """changepoint of stream (series_id, t, x), from the sums and the last values of each series; 0 before its warm-up has passed.

    Like cusum() on a series of four warm-ups or more, but that a stream has no breaks before its warm-up has
    passed: its first rows are then taken up at once. Rows of a series must come in order of t over the batches. State is typed
    (keep_typed_state()), and a query that goes on from a checkpoint gives what one that never stopped would. With idle_ms a series without rows
    for so long is forgotten; such a query goes by the clock, so it takes a trigger that goes on, not availableNow.
    """
    fields = "mean double, sd double, up double, down double, since long, last array<double>"
    got = _detect(stream, _Breaks(fields, "changepoint", warmup, idle_ms), "int")
    return got.select("series_id", "t", F.coalesce("changepoint", F.lit(0)).alias("changepoint"))


def online_regimes(stream: DataFrame, warmup: int = 48, idle_ms: int | None = None) -> DataFrame:
    """p1, the second regime's probability, of stream (series_id, t, x), null before the warm-up has passed.

    State holds the discounted sums as typed columns; checkpoints and idle_ms are as in online_cusum(). Series are fitted and followed many at
    a time: a task holds a batch's rows of one of BUCKETS groups of them.
    """
    mode = "none" if idle_ms is None else "processingTime"
    dealt = stream.withColumn("bucket", F.pmod(F.xxhash64("series_id"), F.lit(BUCKETS)))
    return dealt.groupBy("bucket").transformWithStateInPandas(_Regimes(warmup, idle_ms), "series_id string, t long, p1 double", "append", mode)


def score_new_months(stream: DataFrame, score: Callable[[DataFrame], DataFrame], path: str, checkpoint: str):
    """Start a query that scores each batch once: a month and version that the table has is skipped."""
    return stream.writeStream.foreachBatch(lambda batch, _: dumps.append_scores(score(batch), path) and None).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ingest(spark, folder: str, store: str, checkpoint: str):
    """Start a query that takes up new monthly files of a folder and appends their records, partitioned by month."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").load(folder)

    def take(batch: DataFrame, _: int) -> None:
        paths = [r["path"] for r in batch.select("path").collect()]  # names of new files
        if paths:
            rows = dumps.unioned([dumps.records(dumps.read_dumps(spark, p)) for p in paths])
            rows.write.mode("append").partitionBy("month_int").parquet(store)

    return files.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
