"""Streams of snapshots and of staged rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from granary.operators.ingest import detect_changes, merge_staged
from granary.sources import batches_done, current, refresh


def changed_within(batch: DataFrame, key: str) -> DataFrame:
    """Snapshots of a batch (key, fingerprint, seen, ...) whose fingerprint differs from the one
    before of the same key, in order of time: A, B, A are three changes.  Equal times: the
    smaller fingerprint comes first; fully equal rows are one."""
    by = Window.partitionBy(key).orderBy("seen", "fingerprint")
    before = F.lag("fingerprint").over(by)
    return batch.dropDuplicates([key, "seen", "fingerprint"]).withColumn("_before", before).where(F.col("_before").isNull() | (F.col("_before") != F.col("fingerprint"))).drop("_before")


def fingerprint_changes(stream: DataFrame, key: str, expire_ms: int | None = None, late: str = "1 hour") -> DataFrame:
    """key, fingerprint, seen, action of the snapshots of a stream (key, fingerprint, seen) that
    are new or updated against the last of their key, by Spark's keyed state.

    The state is a fingerprint and a time for each key, so a micro-batch costs its own rows and
    nothing stored is read or written again.  Rows no newer than the key's last are late and
    skipped, unless they are of one batch.  With `expire_ms` (for times that are timestamps) a
    key that isn't seen for longer is new again, and a timer forgets it once the watermark, `late`
    behind the latest time, is past that.  A null key is a key; null fingerprints and times are an
    error of the source and skipped.
    """
    key_type = stream.schema[key].dataType.simpleString()
    seen_type = stream.schema["seen"].dataType.simpleString()
    timed = seen_type in ("timestamp", "timestamp_ntz")
    if expire_ms and seen_type != "timestamp":
        raise ValueError("timers go by timestamps")
    timeout = GroupStateTimeout.EventTimeTimeout if expire_ms else GroupStateTimeout.NoTimeout

    def run(keys: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(batches))
        rows = rows.sort_values(["seen_us", "fingerprint"], kind="stable").drop_duplicates(["seen_us", "fingerprint"])
        last, at = state.get if state.exists else (None, None)
        if at is not None:
            rows = rows[rows["seen_us"] > at]
        before, then = rows["fingerprint"].shift(1), rows["seen_us"].shift(1).astype("Int64")
        if len(rows):
            before.iloc[0], then.iloc[0] = last, pd.NA if at is None else at
            state.update((rows["fingerprint"].iloc[-1], int(rows["seen_us"].iloc[-1])))
        if expire_ms and state.exists:
            state.setTimeoutTimestamp(max(state.get[1] // 1000 + expire_ms, state.getCurrentWatermarkMs() + 1))
        new = then.isna()
        if expire_ms:  # a key may come back before its timer has run
            new |= (rows["seen_us"] - then > expire_ms * 1000).fillna(False)
        changed = new | (before != rows["fingerprint"])
        took = rows[changed]
        action = ["new" if n else "updated" for n in new[changed]]
        yield pd.DataFrame({key: [keys[0]] * len(took), "fingerprint": took["fingerprint"].to_numpy(), "seen_us": took["seen_us"].to_numpy(), "action": action})

    micros = F.unix_micros(F.col("seen").cast("timestamp")) if timed else F.col("seen").cast("long")
    good = stream.where(F.col("fingerprint").isNotNull() & F.col("seen").isNotNull())
    good = good.withWatermark("seen", late) if expire_ms else good
    rows = good.select(key, "seen", F.col("fingerprint").cast("string").alias("fingerprint"), micros.alias("seen_us"))
    out = rows.groupBy(key).applyInPandasWithState(run, f"{key} {key_type}, fingerprint string, seen_us long, action string", "fingerprint string, seen_us long", "append", timeout)
    back = (F.timestamp_micros("seen_us") if timed else F.col("seen_us")).cast(seen_type)
    return out.select(key, "fingerprint", back.alias("seen"), "action")


def append_changes(stream: DataFrame, path: str, key: str, expire_ms: int | None = None, late: str = "1 hour") -> Callable[[str], StreamingQuery]:
    """`fingerprint_changes` appended to Parquet files at `path`; `latest` reads the current state."""
    return lambda checkpoint: fingerprint_changes(stream, key, expire_ms, late).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest(changes: DataFrame, key: str) -> DataFrame:
    """key, fingerprint, first_seen, last_seen from appended changes."""
    return changes.groupBy(key).agg(F.max(F.struct("seen", "fingerprint"))["fingerprint"].alias("fingerprint"), F.min("seen").alias("first_seen"), F.max("seen").alias("last_seen"))


def snapshot_stream(stream: DataFrame, path: str, key: str, tracked: Sequence[str] = ()) -> Callable[[str], StreamingQuery]:
    """Change detection against the stored table at `path` (key, fingerprint, first_seen,
    last_seen, tracked), for tables that others write too.  Each micro-batch keeps the last change
    of a key and rewrites the table; where the stream alone knows the keys, use `append_changes`.
    A batch that runs twice changes nothing, as its rows are then no newer than the stored ones."""

    def batch(df: DataFrame, _: int) -> None:
        spark = df.sparkSession
        last = changed_within(df, key).groupBy(key).agg(F.max(F.struct("seen", "fingerprint", *tracked)).alias("_l")).select(key, "_l.*")
        merged = detect_changes(current(spark, path), last, key, tracked)
        refresh(merged.drop("action"), path)

    return lambda checkpoint: stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def merge_batch(path: str, allow: DataFrame, key: str, pair: Sequence[str], fields: Sequence[str], order: Sequence[str], name: str = "merge") -> Callable[[DataFrame, int], None]:
    """Staged merge of one micro-batch into the table at `path`.  The batch number is committed
    with the version that holds it, so a batch that is repeated, whether it died before or after
    its commit, is merged once."""

    def batch(df: DataFrame, no: int) -> None:
        spark = df.sparkSession
        if batches_done(spark, path).get(name, -1) >= no:
            return
        merged, _summary = merge_staged(current(spark, path), df, allow, key, pair, fields, order)
        refresh(merged, path, (name, no))

    return batch


def merge_stream(stream: DataFrame, path: str, allow: DataFrame, key: str, pair: Sequence[str], fields: Sequence[str], order: Sequence[str], name: str = "merge") -> Callable[[str], StreamingQuery]:
    """`merge_batch` of each micro-batch; `name` tells this stream's batches from another's, and
    goes with its checkpoint."""
    batch = merge_batch(path, allow, key, pair, fields, order, name)
    return lambda checkpoint: stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
