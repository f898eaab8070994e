"""Token counts of flat, unindexed token files by a scan for separators.

A flat file is a run of token ids, each document followed by the end-of-document id, without any index. It is read as blocks
of a fixed number of ids. Every block is searched for separators with numpy and says only how many ids and separators it
has, where the first and the last separator are and how long the documents between them are. A prefix scan stitches the
boundaries: for every block the number of ids, the number of separators and the last separator before it. The scan has two
levels, within runs of blocks and over the runs of a file, so a huge file is never in one task.

``read_blocks`` reads raw files (little-endian unsigned integers); ``write_flat`` writes documents through a tokenizer as
blocks in Parquet, which hold the same ids and no boundaries, and keeps apart which document was written when.

Defined cases: an empty document has 0 tokens; null texts count as empty; two separators in a row enclose an empty document;
ids behind the last separator are a document that is not closed; a file without ids has no document; an end-of-document
marker spelled out in a text is ordinary text and never becomes the separator.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomwork.session import cut_lineage

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
SPLIT_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SEPARATOR = 50256
BLOCK = 1 << 16
RUN = 1024
_ENCODERS: dict[int, object] = {}


def encoder(vocabulary: bytes):
    """The tokenizer of a rank file, made once per Python worker."""
    import tiktoken

    number = hash(vocabulary)
    if number not in _ENCODERS:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in vocabulary.splitlines() if line)}
        _ENCODERS[number] = tiktoken.Encoding("flat", pat_str=SPLIT_PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[number]


def write_flat(docs: DataFrame, folder: str, vocabulary: str = VOCABULARY, separator: int = SEPARATOR, block: int = BLOCK) -> None:
    """Write ``docs`` (doc_id, text) as flat token files to ``folder``/kind=tokens, one file per task, and the order of the
    documents to ``folder``/kind=order."""
    with open(vocabulary, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(shared.value).encode_ordinary
        file, held, number, ordinal = TaskContext.get().partitionId(), np.empty(0, np.uint16), 0, 0
        names = ["kind", "file", "block", "data", "doc_id"]
        for batch in batches:
            ids = batch.column(0)
            texts = batch.column(1).to_pylist()
            pieces = [held]
            for text in texts:
                pieces += [np.array(encode(text or ""), np.uint16), np.array([separator], np.uint16)]
            held = np.concatenate(pieces)
            whole = len(held) // block
            data = [held[i * block:(i + 1) * block].tobytes() for i in range(whole)]
            held = held[whole * block:].copy()
            yield pa.RecordBatch.from_arrays([
                pa.array(["tokens"] * whole + ["order"] * len(texts), pa.string()), pa.array([file] * (whole + len(texts)), pa.int32()),
                pa.array([*range(number, number + whole), *range(ordinal, ordinal + len(texts))], pa.int64()),
                pa.array(data + [None] * len(texts), pa.binary()), pa.concat_arrays([pa.nulls(whole, ids.type), ids])], names=names)
            number, ordinal = number + whole, ordinal + len(texts)
        if len(held):
            yield pa.RecordBatch.from_arrays([pa.array(["tokens"]), pa.array([file], pa.int32()), pa.array([number], pa.int64()),
                                              pa.array([held.tobytes()], pa.binary()), pa.nulls(1, ids.type)], names=names)

    flat = docs.select("doc_id", "text").mapInArrow(run, f"kind string, file int, block long, data binary, doc_id {kind}")
    flat.write.partitionBy("kind").option("compression", "zstd").parquet(folder)


def read_blocks(spark: SparkSession, path: str, width: int = 2, block: int = BLOCK) -> DataFrame:
    """(file, block, data) of raw token files of ``width`` bytes an id."""
    raw = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "content")
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.length("content") - 1) / (block * width))))
    return raw.where(F.length("content") > 0).select("file", "content", F.explode(starts).alias("block")).select(
        "file", "block", F.substring(F.col("content"), (F.col("block") * block * width + 1).cast("int"), F.lit(block * width)).alias("data"))


def count_tokens(blocks: DataFrame, separator: int = SEPARATOR, width: int = 2) -> DataFrame:
    """(file, ordinal, n_tokens, closed) of every document in flat files given as (file, block, data)."""
    file = blocks.schema["file"].dataType.simpleString()
    number = {1: np.dtype("<u1"), 2: np.dtype("<u2"), 4: np.dtype("<u4"), 8: np.dtype("<u8")}[width]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, seps, first, last, inner = [], [], [], [], []
            for data in batch.column(2).to_pylist():
                ids = np.frombuffer(data or b"", number)
                at = np.flatnonzero(ids == separator)
                sizes.append(len(ids))
                seps.append(len(at))
                first.append(int(at[0]) if len(at) else None)
                last.append(int(at[-1]) if len(at) else None)
                inner.append(np.diff(at) - 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(seps, pa.int64()),
                                              pa.array(first, pa.int64()), pa.array(last, pa.int64()), pa.array(inner, pa.list_(pa.int64()))],
                                             names=["file", "block", "size", "seps", "first", "last", "inner"])

    found = blocks.select("file", F.col("block").cast("long").alias("block"), "data").mapInArrow(
        scan, f"file {file}, block long, size long, seps long, first long, last long, inner array<long>")
    stored = cut_lineage(found.withColumn("run", F.floor(F.col("block") / RUN)))
    zero = F.lit(0).cast("long")
    inside = Window.partitionBy("file", "run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    local = stored.withColumns({"_start": F.coalesce(F.sum("size").over(inside), zero), "_done": F.coalesce(F.sum("seps").over(inside), zero)}) \
        .withColumn("_last", F.col("_start") + F.col("last")).withColumn("_before", F.max("_last").over(inside))
    runs = local.groupBy("file", "run").agg(F.sum("size").alias("size"), F.sum("seps").alias("seps"), F.max("_last").alias("last"))
    over = Window.partitionBy("file").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    bases = runs.withColumns({"_base": F.coalesce(F.sum("size").over(over), zero), "_closed": F.coalesce(F.sum("seps").over(over), zero)}) \
        .withColumn("_end", F.col("_base") + F.col("last")).withColumn("_known", F.coalesce(F.max("_end").over(over), F.lit(-1).cast("long")))
    heads = bases.select(F.col("file").alias("_file"), F.col("run").alias("_run"), "_base", "_closed", "_known")
    placed = local.join(heads, (F.col("file") == F.col("_file")) & (F.col("run") == F.col("_run")))
    before = F.coalesce(F.col("_base") + F.col("_before"), F.col("_known"))  # where the document at the block's start began, less one
    head = F.array(F.col("_base") + F.col("_start") + F.col("first") - before - 1)
    closed = placed.where("seps > 0").select("file", (F.col("_closed") + F.col("_done")).alias("_first"), F.posexplode(F.concat(head, "inner")).alias("_at", "n_tokens")) \
        .select("file", (F.col("_first") + F.col("_at")).alias("ordinal"), "n_tokens", F.lit(True).alias("closed"))
    ends = bases.groupBy("file").agg(F.sum("size").alias("_size"), F.sum("seps").alias("ordinal"), F.coalesce(F.max("_end"), F.lit(-1).cast("long")).alias("_last"))
    tail = ends.select("file", "ordinal", (F.col("_size") - F.col("_last") - 1).alias("n_tokens"), F.lit(False).alias("closed")).where("n_tokens > 0")
    return closed.unionByName(tail)


def document_tokens(docs: DataFrame, folder: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_tokens): write ``docs`` flat below ``folder``, scan the files, name the documents by their order."""
    spark = docs.sparkSession
    write_flat(docs, folder, vocabulary)
    kind = docs.schema["doc_id"].dataType.simpleString()
    flat = spark.read.schema(f"file int, block long, data binary, doc_id {kind}, kind string").parquet(folder)
    counts = count_tokens(flat.where("kind = 'tokens'").select("file", "block", "data"))
    order = flat.where("kind = 'order'").select(F.col("file").alias("_file"), F.col("block").alias("_ordinal"), "doc_id")
    return order.join(counts, (F.col("_file") == F.col("file")) & (F.col("_ordinal") == F.col("ordinal"))).select("doc_id", "n_tokens")
