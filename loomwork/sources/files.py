"""Reading and writing files: CSV, text, JSON and month-partitioned Parquet."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable, Iterator
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomwork.functions.text import strip
from loomwork.operators.panel import keep_last

PRICE_SCHEMA = T.StructType([
    T.StructField("date", T.DateType(), False),
    T.StructField("ticker", T.StringType(), False),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.LongType()),
])

TRANSACTION_SCHEMA = T.StructType(
    [T.StructField("Time", T.DoubleType())]
    + [T.StructField(f"V{i}", T.DoubleType()) for i in range(1, 29)]
    + [T.StructField("Amount", T.DoubleType()), T.StructField("Class", T.IntegerType())]
)


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType = TRANSACTION_SCHEMA) -> DataFrame:
    """Headered CSV with a stated schema (no inference pass)."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


# What Spark calls the folder of a missing key, and the characters it escapes in one.
NO_KEY = "__HIVE_DEFAULT_PARTITION__"
ESCAPED = re.compile("[\x01-\x1f\"#%'*/:=?\\\\\x7f{\\[\\]^]")


def mounted(spark: SparkSession, path: str) -> str | None:
    """The path as the operating system names it, where the folder is on a file system that all executors mount."""
    where = urlsplit(path)
    home = urlsplit(spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///")
    return unquote(where.path) if (where.scheme or home.scheme) == "file" else None


def _write_files(root: str, key: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come in the order of their keys; a file appears under its name once it is whole."""
        name, out, done = None, None, 0
        own = f"part-{uuid.uuid4().hex}.tmp"

        def close() -> int:
            if out is None:
                return 0
            out.close()
            os.replace(f"{root}/{name}/{own}", f"{root}/{name}/part-00000.txt")
            return 1

        for batch in batches:
            for value, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                folder = f"{key}={ESCAPED.sub(lambda c: f'%{ord(c[0]):02X}', value) if value else NO_KEY}"
                if folder != name:
                    done += close()
                    name = folder
                    os.makedirs(f"{root}/{name}", exist_ok=True)
                    out = open(f"{root}/{name}/{own}", "wb")
                out.write((text or b"") + b"\n")
        done += close()
        yield pa.RecordBatch.from_pydict({"files": pa.array([done], pa.int64())})

    return write


def write_text_docs(texts: DataFrame, path: str, key: str = "doc_id") -> None:
    """One text file per ``key`` (its folder named by it) in a new folder, from a key and one text column.

    On a mounted file system tasks write the files themselves: Spark's writer starts a ``chmod`` for each of them and moves
    them into place one by one. Elsewhere Spark writes them, every task moving its own files (commit algorithm 2).
    """
    root = mounted(texts.sparkSession, path)
    if root is None:
        writer = texts.repartition(key).write.option("mapreduce.fileoutputcommitter.algorithm.version", "2")
        writer.partitionBy(key).text(path)
        return
    os.makedirs(root)
    text = next(c for c in texts.columns if c != key)
    named = texts.select(F.col(key).cast("string").alias("key"), F.col(text).cast("binary").alias("text"))
    # a missing key and an empty one share a folder, so they go to one task and come together
    dealt = named.withColumn("key", F.coalesce("key", F.lit(""))).repartition("key").sortWithinPartitions("key")
    dealt.mapInArrow(_write_files(root, key), "files bigint").write.format("noop").mode("overwrite").save()


def read_text_docs(spark: SparkSession, folder: str, suffix: str = ".txt") -> DataFrame:
    """Every text file below a folder as one row, undecodable bytes replaced, outer white space stripped."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}").load(folder)
    )
    return as_documents(files, suffix)


def as_documents(files: DataFrame, suffix: str) -> DataFrame:
    """Whole files as documents, U+FFFD in place of bytes that are not UTF-8."""
    text = strip(F.make_valid_utf8(F.col("content").cast("string")))
    return files.select(
        text.alias("content"),
        F.col("path").alias("source"),
        F.element_at(F.split("path", "/"), -1).alias("filename"),
        F.lit(1).alias("page"),
        F.lit(1).alias("total_pages"),
        F.lit(suffix.lstrip(".")).alias("file_type"),
    )


def price_table(bars: DataFrame, path: str) -> None:
    """Daily bars with the stated columns, one row per (date, ticker), in month folders."""
    typed = bars.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in PRICE_SCHEMA.fields])
    rest = [F.col(f.name) for f in PRICE_SCHEMA.fields if f.name not in ("date", "ticker")]
    write_month_partitions(keep_last(typed, ["date", "ticker"], rest), path)


def write_month_partitions(panel: DataFrame, path: str, mode: str = "overwrite", only_touched: bool = False) -> None:
    """One folder per month (``ym=yyyyMM``).

    AQE's rebalance gathers a month's rows in few files and splits a month that is too large for one task. With
    ``only_touched`` an overwrite replaces only the months that ``panel`` holds (dynamic partition overwrite).
    """
    writer = panel.withColumn("ym", F.date_format("date", "yyyyMM")).hint("rebalance", "ym").write.mode(mode).partitionBy("ym")
    if only_touched:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def upsert_months(spark: SparkSession, path: str, incoming: DataFrame, keys: tuple[str, ...] = ("date", "asset")) -> DataFrame:
    """Merge ``incoming`` bars into the month folders at ``path``; returns the stored panel.

    Only the months the batch touches are read, merged (incoming rows win on equal keys) and written back, by dynamic
    partition overwrite; other months keep their files. The merge is staged in the shared folder first, as a month can't
    be read and overwritten by one job. Running the same batch again gives the same folders.
    """
    from loomwork.operators.panel import upsert
    from loomwork.session import fresh_path

    months = [r["ym"] for r in incoming.select(F.date_format("date", "yyyyMM").alias("ym")).distinct().collect()]  # one row a month
    current = spark.read.parquet(path).where(F.col("ym").cast("string").isin(months)).drop("ym")
    staged = fresh_path(spark, "upsert")
    upsert(current, incoming.select(*current.columns), keys).write.parquet(staged)
    write_month_partitions(spark.read.parquet(staged), path, only_touched=True)
    return spark.read.parquet(path)


def read_monthly_panel(spark: SparkSession, paths: str, keys: tuple[str, ...] = ("date", "asset")) -> DataFrame:
    """Every slice of a panel; of rows with equal keys the one in the last file name stays."""
    rows = spark.read.option("recursiveFileLookup", True).parquet(paths).withColumn("_file", F.col("_metadata.file_path"))
    return keep_last(rows, list(keys), ["_file"]).drop("_file")


def concat_monthlies(spark: SparkSession, folder: str, stem: str, columns: str) -> DataFrame:
    """All ``stem_*`` CSV files or folders as one table with a DATE; ``columns`` is a DDL list after ``date``."""
    reader = spark.read.schema(f"date string, {columns}").option("header", True).option("recursiveFileLookup", True)
    raw = reader.csv(f"{folder}/{stem}_*")
    return raw.withColumn("date", F.to_date("date"))


def write_monthly_csv(series: DataFrame, folder: str, stem: str) -> None:
    """Series as headered CSV below ``folder/stem_csv``, one folder per month."""
    dated = series.withColumn("ym", F.date_format("date", "yyyyMM")).hint("rebalance", "ym")
    dated.write.mode("overwrite").partitionBy("ym").option("header", True).csv(f"{folder}/{stem}_csv")


def write_metrics_json(metrics: DataFrame, path: str) -> None:
    """Run metrics as JSON lines."""
    metrics.write.mode("overwrite").json(path)


def storage_profile(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """Files, month folders and bytes below a path, each file counted once; no file content is read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    files = listed.select("path", "length").dropDuplicates(["path"])
    month = F.nullif(F.regexp_extract("path", r"/ym=(\d{6})/", 1), F.lit(""))
    return files.agg(
        F.count("*").alias("n_files"), F.count_distinct(month).alias("n_months"), F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes")
    )


def write_vectors(chunks: DataFrame, path: str, mode: str = "append") -> None:
    """Chunks with their embeddings; appending is how a collection grows."""
    chunks.write.mode(mode).parquet(path)


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def vector_profile(chunks: DataFrame, embedding: str = "embedding") -> DataFrame:
    """Dimension and number of stored vectors."""
    return chunks.agg(F.max(F.size(embedding)).alias("dim"), F.count("*").alias("total"))
