"""Scans, sinks, snapshots and rollback."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def read_csv(spark: SparkSession, path: str, schema: str, header: bool = True) -> DataFrame:
    """CSV with a schema (no inference pass); empty fields are null."""
    return spark.read.schema(schema).csv(path, header=header, nullValue="", multiLine=False)


def read_jsonl(spark: SparkSession, path: str, schema: str, partitions: int | None = None) -> DataFrame:
    """JSON lines, gzip too; malformed lines are dropped.  A gzip file is one split, so give
    `partitions` to spread a large one."""
    df = spark.read.schema(schema).json(path, mode="DROPMALFORMED")
    return df.repartition(partitions) if partitions else df


def quarantine_jsonl(spark: SparkSession, path: str, schema: str, out: str) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """(good, bad, counts) of JSON lines, in one pass: rows that fit the schema, and the lines that
    don't with their file, as two partitions of the table written at `out`; counts (good, bad) are
    observed while it is written."""
    rows = spark.read.schema(f"{schema}, _line string").json(path, mode="PERMISSIVE", columnNameOfCorruptRecord="_line")
    seen = Observation()
    rows = rows.withColumns({"_file": F.regexp_extract(F.col("_metadata.file_path"), "([^/]+)$", 1), "_bad": F.col("_line").isNotNull()})
    rows.observe(seen, F.count_if(~F.col("_bad")).alias("good"), F.count_if("_bad").alias("bad")).write.partitionBy("_bad").parquet(out)
    stored = spark.read.schema(rows.schema).parquet(out)
    good = stored.where(~F.col("_bad")).drop("_line", "_file", "_bad")
    return good, stored.where("_bad").select(F.col("_line").alias("line"), F.col("_file").alias("file")), seen.get


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Files that are one JSON array each; a file is the unit of parallelism."""
    return spark.read.schema(schema).json(path, multiLine=True)


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet table, all of it; pruned to `columns`."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_many(spark: SparkSession, glob: str) -> DataFrame:
    """Parquet files by pattern, with the name of each row's file."""
    return spark.read.option("mergeSchema", "true").parquet(glob).withColumn("file", F.regexp_extract(F.col("_metadata.file_path"), "([^/]+)$", 1))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Page snapshots: page_id, url, html, and the page's fingerprint."""
    return spark.read.parquet(path).select("page_id", "url", "html", F.md5("html").alias("fingerprint"))


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """grp, token of a rule file `name:` / `  - item`, one YAML mapping of lists; other lines and
    comments are skipped.  A file is read by one task: rule files are small."""
    text = spark.read.text(path, wholetext=True)
    block = F.explode(F.regexp_extract_all("value", F.lit(r"(?m)^([^\s#:][^:\n]*:[ \t]*(?:\n[ \t]+[^\n]*)*)"), F.lit(1)))
    rows = text.select(block.alias("_b")).select(F.trim(F.regexp_extract("_b", "^([^:]+):", 1)).alias("grp"), F.explode(F.regexp_extract_all("_b", F.lit(r"\n[ \t]+-[ \t]*([^\n]*)"), F.lit(1))).alias("_t"))
    return rows.select("grp", F.regexp_replace(F.trim("_t"), "^[\"']|[\"']$", "").alias("token"))


def load_rules(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A rule table from plain rows; operators check its size before they broadcast it."""
    return spark.createDataFrame(list(rows), schema)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the cluster's shared folder, `spark.checkpoint.dir`; without one, a local
    session takes its warehouse and a cluster is refused, as executors share no other."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder and spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{(folder or spark.conf.get('spark.sql.warehouse.dir')).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write as a table of the warehouse and read it back."""
    df.write.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def _commits(spark: SparkSession, path: str) -> tuple:
    """Hadoop's file system and paths of a table's versions and commits, and the last commit:
    its number (0: none), its folder and the batch of each stream that it holds."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder, commits = (hadoop.Path(f"{path.rstrip('/')}.{x}") for x in ("versions", "commits"))
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [x.getPath().getName() for x in fs.listStatus(commits)] if fs.exists(commits) else []
    last = max((n for n in names if n.isdigit()), default=None)
    if last is None:
        return fs, folder, commits, 0, None, {}
    stream = fs.open(hadoop.Path(commits, last))
    said = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    stream.close()
    return fs, folder, commits, int(last), said["data"], said["batches"]


def current(spark: SparkSession, path: str) -> DataFrame:
    """The table at `path` as last refreshed, or as first written."""
    _, folder, _, _, data, _ = _commits(spark, path)
    return spark.read.parquet(f"{folder}/{data}" if data else path)


def batches_done(spark: SparkSession, path: str) -> dict[str, int]:
    """The last batch of each stream that the table at `path` holds."""
    return _commits(spark, path)[-1]


def refresh(df: DataFrame, path: str, batch: tuple[str, int] | None = None) -> DataFrame:
    """Recompute a stored table, even one that `df` reads.

    Each attempt writes a folder of its own beside the table and then commits it under the next
    number by a rename that fails if the number is taken; `current` reads the last commit.  So
    readers always have a whole table, a job that dies leaves the old one in force, and of two
    writers that meet one gets an error and changes nothing.  With `batch` (a stream's name and
    batch number) the commit says that the table holds it.  The version before the last stays for
    those who still read it; older ones, and what dead attempts left, go.
    """
    spark = df.sparkSession
    fs, folder, commits, last, before, batches = _commits(spark, path)
    jvm, at = spark._jvm, last + 1
    hadoop = jvm.org.apache.hadoop.fs
    data = f"v{at:09d}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(f"{folder}/{data}")
    draft = hadoop.Path(commits, f"_{data}")
    out = fs.create(draft, False)
    out.write(json.dumps({"data": data, "batches": batches | (dict([batch]) if batch else {})}).encode())
    out.close()
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(draft, hadoop.Path(commits, f"{at:09d}"), none)
    except Exception:
        fs.delete(draft, False)
        fs.delete(hadoop.Path(folder, data), True)
        raise
    for x in fs.listStatus(folder):
        name = x.getPath().getName()
        if name not in (data, before) and int(name[1:10]) < at:
            fs.delete(x.getPath(), True)
    return spark.read.parquet(f"{folder}/{data}")


def snapshot(df: DataFrame, folder: str, tag: str) -> str:
    """Keep `df` under a tag; an existing tag is an error, so no backup is lost."""
    path = f"{folder.rstrip('/')}/{tag}"
    df.write.mode("errorifexists").parquet(path)
    return path


def rollback(current: DataFrame, kept: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """`columns` of each key as in the snapshot; rows without one stay as they are."""
    old = kept.select(key, F.lit(True).alias("_had"), *[F.col(c).alias(f"_s_{c}") for c in columns])
    joined = current.join(old, key, "left")
    return joined.withColumns({c: F.when(F.col("_had"), F.col(f"_s_{c}")).otherwise(F.col(c)) for c in columns}).drop("_had", *[f"_s_{c}" for c in columns])
