"""What several operators share: shared-folder tables, two-level ranks, word patterns."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows that one window of a two-level rank holds on average.
RANK_ROWS = 10_000

#: Buckets that are summed along in one task.
RUN = 1_000


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder, from `spark.checkpoint.dir` or the session.

    Where neither is set, a local session (one machine) takes a folder of its own in the warehouse;
    a cluster's is an error, since executors could not read each other's local folders.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints")
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as Parquet in the shared folder and read it back: lineage is cut there,
    later plans read the same rows however often, and a lost executor loses nothing.

    Zstandard, since the buffers of the default codec are outside the heap and, where many small
    files are written, freed late.  The tables are those of one run: the folder is the cluster's
    checkpoint folder, whose cleaning removes them.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def once(rows: DataFrame, key: str, more: Sequence[str]) -> DataFrame:
    """One row of each of `key` and `more`, whose rows are equal.  Only rows of keys that are
    repeated are shuffled; where none are, the keys alone are read for it."""
    many = rows.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > 1).select(key)
    many = materialize(many, "repeated")  # of a known size: mostly few
    return rows.join(many, key, "left_anti").unionByName(rows.join(many, key, "left_semi").dropDuplicates([key, *more]))


def whole_ids(docs: DataFrame, key: str) -> DataFrame:
    """`docs`, whose ids are whole numbers; other types are an error before any job runs."""
    if not isinstance(docs.schema[key].dataType, IntegralType):
        raise TypeError(f"{key} has to be a whole number, since documents are ordered by it")
    return docs


def hash_bucket(hashed: Column, buckets: Column) -> Column:
    """Order-preserving bucket 0..buckets-1 of a signed 64-bit hash."""
    upper = F.shiftrightunsigned(hashed.bitwiseXOR(F.lit(-(1 << 63))), 33)  # 31 bits, unsigned order
    return F.shiftright(upper * buckets.cast("long"), 31)


def two_level(
    df: DataFrame,
    by: Sequence[str],
    bucket: str,
    order: Sequence[Column],
    weight: str | None = None,
    out: str = "_rank",
) -> DataFrame:
    """Exclusive running count (or sum of `weight`) in `by`, ordered by (`bucket`, `order`).

    `bucket` must be monotone in the wanted order.  Counts per bucket are combined before
    the shuffle and summed along runs of RUN buckets and along the buckets of a run; rows only
    meet the rows of their own bucket, so a `by` value with a third of the rows is spread over
    its buckets.
    """
    one = F.col(weight) if weight else F.lit(1).cast("long")
    keys = [*by, bucket]
    per = df.groupBy(*keys).agg(F.sum(one).alias("_in_bucket")).withColumn("_run", F.floor(F.col(bucket) / RUN))
    runs = per.groupBy(*by, "_run").agg(F.sum("_in_bucket").alias("_in_run"))
    sofar = lambda w, c: F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    along = Window.partitionBy(*by).orderBy("_run") if by else Window.orderBy("_run")  # one row for RUN buckets
    runs = runs.select(*[F.col(c).alias(f"_k_{c}") for c in (*by, "_run")], sofar(along, "_in_run").alias("_before_run"))
    per = per.join(runs, _null_safe([*by, "_run"])).withColumn("_before", F.col("_before_run") + sofar(Window.partitionBy(*by, "_run").orderBy(bucket), "_in_bucket"))
    per = materialize(per.select(*[F.col(c).alias(f"_k_{c}") for c in keys], "_before"), "buckets")  # of a known size, so that a few need no shuffle of `df`
    here = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = df.join(per, _null_safe(keys), "inner")
    return joined.withColumn(out, F.col("_before") + F.sum(one).over(here) - one).drop("_before", *[f"_k_{c}" for c in keys])


def _null_safe(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in keys])
