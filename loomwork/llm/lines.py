"""Line deduplication over levelled sorted runs of line hashes.

``LineRuns`` keeps what is known of all line keys as Parquet runs of (key hash, number of documents, largest document),
hash-partitioned and sorted by hash. A batch of documents adds one run at level 0; when a level holds ``fanout`` runs they
are compacted into one run of the next level. ``fresh_lines`` is the incremental form: a new batch anti-joins the runs, so
only keys never seen before survive, and then adds its own. ``drop_repeated_lines`` is the form for a whole table: all
batches are added, then every batch is held against the runs and loses the lines whose key is frequent and owned by a
larger document.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends and with A-Z lowered; hashes have 128 bits.

Defined cases: a null text has one empty line and stays null; a row without ``doc_id`` is not counted and loses nothing;
rows that share a ``doc_id`` count as one document; a line repeated inside the owning document stays there every time.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomwork.session import fresh_path

STRIP = b" \t\n\x0b\x0c\r"
MIN_CHARS = 20
MIN_DOCUMENTS = 3
BATCHES = 4
SLICE_ROWS = 256


def line_hash(line: bytes, min_chars: int) -> bytes | None:
    """The 128-bit hash of a line's key, or None when the key is shorter than ``min_chars`` code points."""
    key = line.strip(STRIP).lower()  # bytes.lower() touches A-Z only
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode("utf-8", "surrogatepass")) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key)


def lines_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split(b"\n")


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of at most ``rows``, so that a task holds the lines of few texts at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, key): the distinct line hashes of every row; read once, nothing but hashes leaves the scan."""
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("key", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            index, keys = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                found = {h for h in (line_hash(line, min_chars) for line in lines_of(text)) if h}
                keys += found
                index += [i] * len(found)
            ids = batch.column(0).take(pa.array(index, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(keys, pa.binary())], names=["doc_id", "key"])

    return docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text").mapInArrow(run, schema)


class LineRuns:
    """Levelled sorted runs in ``folder``; every run is written whole before it counts."""

    def __init__(self, spark: SparkSession, folder: str, fanout: int = 4):
        self.spark, self.folder, self.fanout = spark, folder, fanout
        self.levels: dict[int, list[str]] = {}
        self.written = 0

    def _write(self, level: int, rows: DataFrame) -> None:
        path = f"{self.folder}/level{level}-run{self.written}"
        rows.sortWithinPartitions("key").write.parquet(path)
        self.written += 1
        self.levels.setdefault(level, []).append(path)

    def add(self, keys: DataFrame) -> None:
        """Add a batch of (doc_id, key); its documents must not have been in an earlier batch."""
        once = keys.dropDuplicates(["key", "doc_id"])
        self._write(0, once.groupBy("key").agg(F.count("*").alias("documents"), F.max("doc_id").alias("owner")))
        level = 0
        while len(self.levels.get(level, [])) >= self.fanout:
            merged = self._merged(self.levels[level])
            self.levels[level] = []
            self._write(level + 1, merged)
            level += 1

    def _merged(self, paths: list[str]) -> DataFrame:
        runs = self.spark.read.parquet(*paths)
        return runs if len(paths) == 1 else runs.groupBy("key").agg(
            F.sum("documents").alias("documents"), F.max("owner").alias("owner"))

    def merged(self) -> DataFrame | None:
        """What all runs say together, one row per key."""
        paths = [p for level in self.levels.values() for p in level]
        return self._merged(paths) if paths else None

    def fresh_lines(self, keys: DataFrame) -> DataFrame:
        """Incremental form: the (doc_id, key) rows whose key no run holds yet. Add the batch afterwards."""
        known = self.merged()
        return keys if known is None else keys.join(known, "key", "left_anti")

    def dropped(self, keys: DataFrame, min_documents: int) -> DataFrame:
        """(doc_id, key) of lines to drop: what an anti-join with the frequent keys that others own takes away."""
        known = self.merged()
        if known is None:
            return keys.limit(0)
        frequent = known.where(F.col("documents") >= min_documents).select("key", "owner")
        return keys.join(frequent, "key").where(F.col("doc_id") != F.col("owner")).select("doc_id", "key")


def _rebuild(docs: DataFrame, min_chars: int) -> DataFrame:
    """Take the lines listed in ``_drop`` out of ``text``; adds ``n_lines`` and ``n_dropped``."""
    kept = [f for f in docs.schema.fields if f.name not in ("_drop", "n_lines", "n_dropped")]
    schema = T.StructType([*kept, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            at = batch.schema.get_field_index
            texts, lines, dropped = [], [], []
            for text, drop in zip(batch.column(at("text")).to_pylist(), batch.column(at("_drop")).to_pylist()):
                all_lines = lines_of(text)
                if drop:
                    gone = set(drop)
                    stay = [line for line in all_lines if line_hash(line, min_chars) not in gone]
                    text = b"\n".join(stay).decode("utf-8", "surrogatepass")
                    dropped.append(len(all_lines) - len(stay))
                else:
                    dropped.append(0)
                texts.append(text)
                lines.append(len(all_lines))
            columns = [pa.array(texts, batch.column(at("text")).type) if f.name == "text" else batch.column(at(f.name)) for f in kept]
            columns += [pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.mapInArrow(run, schema)


def drop_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS,
                        batches: int = BATCHES, fanout: int = 4) -> DataFrame:
    """``docs`` without the lines of frequent keys, but for the largest document; adds ``n_lines`` and ``n_dropped``.

    Keys of at least ``min_chars`` code points found in at least ``min_documents`` documents count as frequent. The texts
    are scanned once for their keys and shuffled once for the rebuilding; in between only hashes move. Hot keys are
    pre-aggregated before each shuffle, and the join with the runs is one whose hot partitions adaptive execution splits.
    """
    spark = docs.sparkSession
    folder = fresh_path(spark, "lines")
    line_keys(docs, min_chars).withColumn("batch", F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int")) \
        .write.partitionBy("batch").parquet(f"{folder}/keys")
    stored = spark.read.schema(T.StructType([docs.schema["doc_id"], T.StructField("key", T.BinaryType()),
                                             T.StructField("batch", T.IntegerType())])).parquet(f"{folder}/keys")
    runs = LineRuns(spark, folder, fanout)
    for batch in range(batches):
        runs.add(stored.where(F.col("batch") == batch).select("doc_id", "key"))
    gone = runs.dropped(stored.select("doc_id", "key"), min_documents)
    lists = gone.repartition("doc_id").groupBy("doc_id").agg(F.collect_set("key").alias("_drop"))
    joined = docs.join(lists.withColumnRenamed("doc_id", "_doc"), F.col("doc_id") == F.col("_doc"), "left").drop("_doc")
    return _rebuild(joined, min_chars)
