"""Repeated byte strings across documents, by bucket-pointer refinement over sampled suffixes.

Every string of ``LENGTH`` bytes that also starts in a document with a smaller id is removed. As in suffix sorting by
bucket-pointer refinement, suffixes first fall into buckets by their q-gram; a bucket is then refined by sorting its members
on the bucket identifiers of later offsets, and identifiers of longer strings are put together from those already there
(1, 2, 4, ... 64 bytes by doubling, any length from two of them). Two things make it a distributed job: identifiers are
64-bit hashes instead of ranks, so buckets far apart agree on them without a global sort, and only sampled suffixes are
sent: the q-grams with the least hash of some string of ``LENGTH`` bytes around them. Equal strings choose equal samples, so
every repeated string has its sample in a bucket with the other occurrence.

1. Samples go to the part of their q-gram with the identifier of their *surroundings*, all bytes that any string of
   ``LENGTH`` bytes around the sample can have. Within a bucket, members are sorted by that identifier. All strings around
   a member repeat if its surroundings occur in a smaller document: settled. A bucket with one kind of surroundings needs
   nothing more; of the others the smallest document of each kind goes on.
2. Only for these, at the borders of repeated passages, the single strings are refined: their identifiers go to parts and
   are sorted, and a string repeats if a smaller document has it.
3. Settled surroundings and strings are laid over the text and its other bytes are kept.

Surroundings that reach over an end of the text hold a mark that is no byte, so whole copies are settled in the first step.
Copies and hot passages are even work: entries are dealt by hash, every task packs what it sends, and a part's members are
sorted with numpy. Long texts are read in overlapping pieces.

Defined cases: null counts as empty; texts shorter than ``LENGTH`` lose nothing; rows without ``doc_id`` neither lose bytes
nor make others lose any; rows that share a ``doc_id`` don't touch each other. The kept bytes may cut a character, so they
are binary. ``doc_id`` is a whole number.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm.packing import PACKED, entries, read_entries, split_by
from loomwork.session import fresh_path

LENGTH = 50
GRAM = 20
REACH = LENGTH - GRAM
MARK = 256
BUFFER = 1 << 18
PIECE = 1 << 20
MARGIN = 2 * LENGTH
FLUSH = 400_000
PART_ENTRIES = 500_000
SLICE_ROWS = 2_000
OWNER_BYTES = 16 << 20
FACTORS = [np.uint64(v) for v in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                                  0xA0761D6478BD642F, 0x8EBC6AF09C88C6E3, 0x2127599BF4325C37)]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25)
    return x ^ (x >> np.uint64(29))


def identifiers(letters: np.ndarray, most: int) -> dict[int, np.ndarray]:
    """Identifiers of the strings of 1, 2, 4, ... ``most`` letters at every place, each from two of the former."""
    out = {1: mix(np.arange(1, MARK + 2, dtype=np.uint64) * FACTORS[0])[letters]}
    size = 1
    while size < most:
        shorter = out[size]
        out[2 * size] = mix(shorter[:-size] * FACTORS[size.bit_length()] + shorter[size:])
        size *= 2
    return out


def identifier(parts: dict[int, np.ndarray], places: np.ndarray, length: int) -> np.ndarray:
    """Identifiers of the strings of ``length`` letters at ``places``."""
    out, at = np.zeros(len(places), np.uint64), 0
    for size in sorted(parts, reverse=True):
        while length - at >= size:
            out = mix(out * FACTORS[3] + parts[size][places + at])
            at += size
    return out


def slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` over every run of ``width`` values, by doubling."""
    size = 1
    while 2 * size <= width:
        x = pick(x[:-size], x[size:])
        size *= 2
    return pick(x[:len(x) - (width - size)], x[width - size:]) if width > size else x


class Buffer:
    """Texts or pieces of them side by side, with marks between; knows samples and strings by place."""

    def __init__(self, pieces: list[tuple[int, int, bytes, int, int]]):
        """Pieces are (document, offset, bytes, first, last): places from first to last of the document are this piece's."""
        lengths = np.array([len(p[2]) for p in pieces])
        self.starts = LENGTH + np.concatenate([[0], np.cumsum(lengths + LENGTH)[:-1]])
        letters = np.full(LENGTH + int((lengths + LENGTH).sum()) + LENGTH, MARK, np.uint16)
        ends = np.zeros(len(letters), np.int64)
        for start, piece in zip(self.starts, pieces):
            letters[start:start + len(piece[2])] = np.frombuffer(piece[2], np.uint8)
            ends[start:start + len(piece[2])] = start + len(piece[2])
        self.doc, self.offset, self.first, self.last = (np.array([p[k] for p in pieces]) for k in (0, 1, 3, 4))
        self.parts = identifiers(letters, 64)
        whole = np.arange(len(letters) - LENGTH + 1)
        self.valid = whole + LENGTH <= ends[:len(whole)]
        places = np.arange(len(letters) - GRAM + 1)
        self.grams = mix(self.parts[16][places] * FACTORS[5] + self.parts[4][places + 16])
        least = slide(self.grams, REACH + 1, np.minimum)
        self.least = np.where(self.valid, least[:len(whole)], np.uint64(0))  # 0: no string here

    def samples(self) -> np.ndarray:
        """Places that are the least q-gram of some string."""
        held = slide(np.concatenate([np.zeros(REACH, np.uint64), self.least]), REACH + 1, np.maximum)
        return np.flatnonzero((held == self.grams[:len(held)]) & (held != 0))

    def strings(self, samples: np.ndarray) -> np.ndarray:
        """Places of the strings whose least q-gram is one of ``samples``."""
        around = samples[:, None] - np.arange(REACH + 1)
        return np.unique(around[self.least[around] == self.grams[samples][:, None]])

    def owned(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(places, document, position in it) of those that belong to their piece."""
        piece = np.searchsorted(self.starts, places, side="right") - 1
        at = places - self.starts[piece] + self.offset[piece]
        own = (at >= self.first[piece]) & (at < self.last[piece])
        return places[own], self.doc[piece[own]], at[own]

    def place_of(self, doc: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Places of (document, position) pairs that belong to a piece here; the pieces are in the order of both."""
        key = self.doc.astype(np.int64) << 40 | self.first
        piece = np.searchsorted(key, doc.astype(np.int64) << 40 | at, side="right") - 1
        inside = (piece >= 0) & (self.doc[piece] == doc) & (at < self.last[piece])
        return self.starts[piece[inside]] + at[inside] - self.offset[piece[inside]]


def buffers(texts: list[bytes]) -> Iterator[Buffer]:
    """All texts in buffers of bounded size; long ones in overlapping pieces."""
    held, size = [], 0
    for number, text in enumerate(texts):
        if len(text) < LENGTH:
            continue
        for first in range(0, len(text), PIECE):
            last = min(first + PIECE, len(text))
            begin = max(0, first - MARGIN)
            held.append((number, begin, text[begin:last + MARGIN], first, last))
            size += len(held[-1][2])
            if size >= BUFFER:
                yield Buffer(held)
                held, size = [], 0
    if held:
        yield Buffer(held)


def encoded(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def naming(ids: list[int], texts: list[bytes]) -> np.ndarray:
    """Rows of (id, tag): the tag, a short hash of the text, tells rows apart that share an id."""
    tags = np.array([xxhash.xxh3_64_intdigest(t) & 0xFFFFFF for t in texts], np.int64)
    return np.stack([np.array(ids, np.int64), tags], axis=1) if ids else np.empty((0, 2), np.int64)


def part_of(identifier_: np.ndarray, parts: int) -> np.ndarray:
    return ((identifier_ >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def owner_of(names: np.ndarray, owners: int) -> np.ndarray:
    return np.mod(names[:, 0], owners)


def sampled(docs: DataFrame, parts: int) -> DataFrame:
    """Packed samples with the lower half of their q-gram's identifier and the identifier of their surroundings."""

    def flush(found, names):
        grams, around, doc, pos = (np.concatenate(x) for x in zip(*found))
        grams = mix(grams * FACTORS[6])  # the least of hashes are small; spread them again
        return entries(part_of(grams, parts), doc, pos, names, gram=grams.astype(np.uint32), around=around)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                rows = batch.slice(start, SLICE_ROWS)
                texts = [encoded(t) for t in rows.column(1).to_pylist()]
                names, found, held = naming(rows.column(0).to_pylist(), texts), [], 0
                for buffer in buffers(texts):
                    places, doc, pos = buffer.owned(buffer.samples())
                    found.append((buffer.grams[places], identifier(buffer.parts, places - REACH, LENGTH + REACH), doc, pos))
                    held += len(places)
                    if held >= FLUSH:
                        yield flush(found, names)
                        found, held = [], 0
                if found:
                    yield flush(found, names)

    return docs.mapInArrow(run, PACKED + ", gram binary, around binary")


def refined(samples: DataFrame, parts: int, owners: int) -> DataFrame:
    """(part, docs, who, pos, settled): members settled by their surroundings, and those whose strings must be looked at."""

    def run(table: pa.Table) -> pa.Table:
        doc, pos, names, more = read_entries(table, gram=np.uint32, around=np.uint64)
        del table
        ids = names[:, 0][doc]
        order = np.lexsort((ids, more["around"], more["gram"]))
        gram, around, ids = more.pop("gram")[order], more.pop("around")[order], ids[order]
        new_bucket = np.concatenate([[True], gram[1:] != gram[:-1]])
        new_kind = new_bucket | np.concatenate([[True], around[1:] != around[:-1]])
        kind, bucket = np.cumsum(new_kind) - 1, np.cumsum(new_bucket) - 1
        least = ids[np.flatnonzero(new_kind)]  # members are sorted by id within a kind
        settled = ids > least[kind]
        starts = np.flatnonzero(new_bucket)
        mixed = np.minimum.reduceat(ids, starts) < np.maximum.reduceat(ids, starts)
        several = np.bincount(bucket[new_kind]) > 1
        open_ = (ids == least[kind]) & (mixed & several)[bucket]
        # one member of a kind speaks for it, but all rows and places of its smallest document may lose bytes
        out = []
        for flag, chosen in ((True, settled), (False, open_)):
            at = order[chosen]
            batch = entries(owner_of(names, owners)[doc[at]], doc[at], pos[at], names)
            out.append(pa.RecordBatch.from_arrays([*batch.columns, pa.array([flag] * batch.num_rows, pa.bool_())], names=[*batch.schema.names, "settled"]))
        return pa.Table.from_batches(out)

    return samples.repartition(parts, "part").groupBy("part").applyInArrow(run, PACKED + ", settled boolean")


def packed_texts(docs: DataFrame, owners: int) -> DataFrame:
    """(part, ids, sizes, texts): whole texts of a batch by owner, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), [encoded(t) for t in batch.column(1).to_pylist()]
            owner = np.array([(i or 0) % owners for i in ids], np.int64)
            rows = [(number, [ids[k] for k in at], [len(texts[k]) for k in at],
                     zstandard.ZstdCompressor(level=3).compress(b"".join(texts[k] for k in at))) for number, at in split_by(owner)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.list_(pa.int64())),
                                              pa.array([r[2] for r in rows], pa.list_(pa.int64())), pa.array([r[3] for r in rows], pa.binary())],
                                             names=["part", "ids", "sizes", "texts"])

    return docs.mapInArrow(run, "part int, ids array<long>, sizes array<long>, texts binary")


def unpacked_texts(table: pa.Table) -> tuple[list[int | None], list[bytes]]:
    ids, texts = [], []
    for own, sizes, data in zip(*(table.column(c).to_pylist() for c in ("ids", "sizes", "texts"))):
        whole, at = zstandard.ZstdDecompressor().decompress(data, max_output_size=sum(sizes) + 1), 0
        for size in sizes:
            texts.append(whole[at:at + size])
            at += size
        ids += own
    return ids, texts


def own_rows(names: np.ndarray, ids: list[int | None], texts: list[bytes]) -> dict[int, list[int]]:
    """Which rows of the texts each name means."""
    wanted = {tuple(n): k for k, n in enumerate(names.tolist())}
    tagged = naming([i if i is not None else 0 for i in ids], texts).tolist() if ids else []
    out: dict[int, list[int]] = {}
    for row, name in enumerate(tagged):
        number = wanted.get(tuple(name))
        if number is not None and ids[row] is not None:
            out.setdefault(number, []).append(row)
    return out


def open_strings(texts: DataFrame, members: DataFrame, parts: int) -> DataFrame:
    """Packed strings around open members, with their identifiers."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = pa.schema([("part", pa.int32()), *((c, pa.binary()) for c in ("docs", "who", "pos", "string"))]).empty_table()
        if not left.num_rows or not right.num_rows:
            return empty
        ids, all_texts = unpacked_texts(left)
        doc, pos, names, _ = read_entries(right)
        rows = own_rows(names, ids, all_texts)
        chosen = sorted(n for n in rows)
        number = np.full(len(names), -1)
        number[chosen] = np.arange(len(chosen))
        order = np.lexsort((pos, number[doc]))
        doc, pos = number[doc][order], pos[order]
        doc, pos = doc[doc >= 0], pos[doc >= 0]
        out = []
        for buffer in buffers([all_texts[rows[n][0]] for n in chosen]):
            low, high = np.searchsorted(doc, [buffer.doc[0], buffer.doc[-1] + 1])
            samples = buffer.place_of(doc[low:high], pos[low:high])
            if len(samples):
                places = buffer.strings(samples)
                piece = np.searchsorted(buffer.starts, places, side="right") - 1
                out.append((identifier(buffer.parts, places, LENGTH), buffer.doc[piece], places - buffer.starts[piece] + buffer.offset[piece]))
        if not out:
            return empty
        string, doc, pos = (np.concatenate(x) for x in zip(*out))
        return pa.Table.from_batches([entries(part_of(string, parts), doc, pos, names[chosen], string=string)])

    return texts.groupBy("part").cogroup(members.groupBy("part")).applyInArrow(run, PACKED + ", string binary")


def repeated_strings(strings: DataFrame, parts: int, owners: int) -> DataFrame:
    """Packed strings that a smaller document has."""

    def run(table: pa.Table) -> pa.Table:
        doc, pos, names, more = read_entries(table, string=np.uint64)
        ids = names[:, 0][doc]
        order = np.lexsort((ids, more["string"]))
        string, ids = more["string"][order], ids[order]
        new = np.concatenate([[True], string[1:] != string[:-1]])
        at = order[ids > ids[np.flatnonzero(new)][np.cumsum(new) - 1]]
        return pa.Table.from_batches([entries(owner_of(names, owners)[doc[at]], doc[at], pos[at], names)])

    return strings.repartition(parts, "part").groupBy("part").applyInArrow(run, PACKED)


def kept_bytes(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) from the texts and the packed places with ``settled``."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, all_texts = unpacked_texts(left)
        out = {"doc_id": ids, "n_bytes": [len(t) for t in all_texts], "n_removed": [0] * len(ids), "n_spans": [0] * len(ids), "kept": all_texts}
        if right.num_rows and ids:
            flags = np.array(right.column("settled").to_pylist())
            found: dict[int, list[np.ndarray]] = {}
            for settled in (True, False):
                doc, pos, names, _ = read_entries(right.filter(pa.array(flags == settled)))
                rows = own_rows(names, ids, all_texts)
                begin, end = (pos - REACH, pos + LENGTH) if settled else (pos, pos + LENGTH)
                for number, at in split_by(doc):
                    for row in rows.get(number, []):
                        found.setdefault(row, []).append(np.stack([begin[at], end[at]]))
            for row, parts in found.items():
                size = len(all_texts[row])
                begin, end = np.clip(np.concatenate(parts, axis=1), 0, size)
                depth = np.bincount(begin, minlength=size + 1) - np.bincount(end, minlength=size + 1)
                gone = np.cumsum(depth)[:size] > 0
                out["n_removed"][row] = int(gone.sum())
                out["n_spans"][row] = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                out["kept"][row] = np.frombuffer(all_texts[row], np.uint8)[~gone].tobytes()
        kinds = [pa.int64()] * 4 + [pa.binary()]
        return pa.table([pa.array(v, k) for v, k in zip(out.values(), kinds)], names=list(out))

    return texts.groupBy("part").cogroup(spans.groupBy("part")).applyInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) for every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    owners = max(16, math.ceil(total / OWNER_BYTES))
    parts = max(16, math.ceil(total / 15 / PART_ENTRIES))
    path = fresh_path(spark, "suffixes")
    refined(sampled(rows.where(F.col("doc_id").isNotNull()), parts), parts, owners).write.parquet(f"{path}/members")
    members = spark.read.parquet(f"{path}/members")
    open_ = members.where(~F.col("settled")).drop("settled")
    strings = open_strings(packed_texts(rows.where(F.col("doc_id").isNotNull()), owners), open_, parts)
    repeated_strings(strings, parts, owners).withColumn("settled", F.lit(False)).write.parquet(f"{path}/strings")
    spans = members.where("settled").unionByName(spark.read.parquet(f"{path}/strings"))
    return kept_bytes(packed_texts(rows, owners), spans)
