"""Exact set-similarity join of word shingles: size-aware, light sets by subsets, heavy sets by inverted lists.

A document is its set of distinct word shingles. Documents with equal sets are one class, named by a hash of the set that
every task works out for itself, so texts stay where they are read: a class is sent at most once by each task, and what
several tasks sent of it counts once. The similarity bounds how many elements a set may lack in a linked one.

* *Light* sets, below the boundary, enumerate their subsets of all sizes a link can leave; two linked light sets share one.
* *Heavy* sets go into inverted lists. Elements are dealt by hash and counted; those of a single set can't link anything and
  are left out. Of the others a set is listed under as many of the rarest as it may lack, and one more, counting the
  unshared ones first: the rarest common element of two linked sets lies within both of these prefixes.

The boundary is chosen by cost: the size at which enumerating subsets takes more rows than the lists and their scans, over
the measured sizes of the sets. Light sets within reach of heavy ones are handled on both sides.

Every list is a star around its smallest member; stars that touch form a cluster, so linked sets always meet in a cluster.
Clusters are cut into blocks by weight and every pair of blocks is one task: it scans the inverted lists of one block's
elements for each set of the other, which counts all intersections exactly, and gives out a spanning forest of the links.
No pairs are emitted. Components of these links are the components of all links.

Elements travel packed: one row holds what a batch of documents sends to one part, sorted with numpy in the tasks.

Defined cases: documents without words have an empty set, link with nothing and are their own component; fewer words than
a shingle make one shingle of the whole; a row without ``doc_id`` has no component; rows that share a ``doc_id`` are one
vertex. ``doc_id`` is a whole number.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm.components import components
from loomwork.session import cut_lineage, fresh_path, sized

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
PART_ELEMENTS = 2_000_000
FLUSH_ELEMENTS = 2_000_000
BLOCK_ELEMENTS = 300_000
ELEMENT_COST = 1.0  # cost of sending and scanning one element of a heavy set, in rows of a light one


def shingles(text: str | None, width: int) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles."""
    words = WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())  # bytes.lower() touches A-Z only
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words))], np.uint64)
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
    out = np.zeros(len(words) - width + 1, np.uint64)
    for k in range(width):
        out = mix(out + hashes[k:k + len(out)] * np.uint64(2 * k + 0x9E3779B97F4A7C15))
    return np.unique(out)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def missing(size: int, percent: int) -> int:
    """Elements that a set of this size may lack in a linked one."""
    return size - -(-percent * size // 100)


def light_rows(size: int, percent: int) -> float:
    return float(sum(math.comb(size, d) for d in range(missing(size, percent) + 1)))


def heavy_rows(size: int, percent: int) -> float:
    return missing(size, percent) + 1 + ELEMENT_COST * size


def boundary(sizes: list[tuple[int, int]], percent: int) -> int:
    """First size of heavy sets: the one with the least cost over the (size, number of sets) counts."""
    candidates = sorted({1, *(s + 1 for s, _ in sizes if light_rows(s, percent) <= 64 * heavy_rows(s, percent))})
    return min(candidates, key=lambda x: (sum(n * (light_rows(s, percent) if s < x else heavy_rows(s, percent)) for s, n in sizes), x))


def subset_keys(elements: np.ndarray, percent: int) -> np.ndarray:
    """One key for each subset of a light set that a link can leave."""
    size, hashed = len(elements), mix(elements)
    out = []
    for gone in range(missing(size, percent) + 1):
        taken = np.array([hashed[list(c)].sum(dtype=np.uint64) for c in combinations(range(size), gone)], np.uint64)
        out.append(mix(hashed.sum(dtype=np.uint64) - taken + np.uint64(size - gone)))
    return np.unique(np.concatenate(out))


def set_key(elements: np.ndarray) -> int:
    """The name of a class: a 64-bit hash of its sorted elements, as a signed number."""
    value = xxhash.xxh3_64_intdigest(elements.tobytes())
    return value - (1 << 64) if value >> 63 else value


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, size, id): size of the set and the key of its class, null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(text, width) for text in batch.column(1).to_pylist()]
            sizes, keys = [len(s) for s in sets], [set_key(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.int64())], names=["doc_id", "size", "id"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, size long, id long")


def light_lists(docs: DataFrame, width: int, percent: int, limit: int) -> DataFrame:
    """(id, key): the subset keys of the light sets of ``docs`` (text); a class may come from several tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            ids, keys = [], []
            for text in batch.column(0).to_pylist():
                elements = shingles(text, width)
                if 0 < len(elements) < limit and (key := set_key(elements)) not in seen:
                    seen.add(key)
                    keys.append(subset_keys(elements, percent))
                    ids.append(np.full(len(keys[-1]), key, np.int64))
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids)), pa.array(np.concatenate(keys).view(np.int64))], names=["id", "key"])

    return docs.select("text").mapInArrow(run, "id long, key long")


def packed(part: np.ndarray, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """One row per part with the packed values of its entries."""
    order = np.argsort(part, kind="stable")
    names, starts = np.unique(part[order], return_index=True)
    ends = [*starts[1:], len(part)]
    out = {name: [values[order[b:e]].tobytes() for b, e in zip(starts, ends)] for name, values in columns.items()}
    return pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), *(pa.array(v, pa.binary()) for v in out.values())], names=["part", *out])


def joined(rows: list[bytes], kind) -> np.ndarray:
    return np.frombuffer(b"".join(rows), kind)


def sent_elements(docs: DataFrame, width: int, least: int, parts: int) -> DataFrame:
    """(part, keys, who, ids): elements of sets of at least ``least``, dealt by hash. A part's number is the upper half of a
    key and is not sent; ``who`` counts within ``ids``, the keys of the classes. A task sends a class once."""

    def flush(sets, ids):
        flat = np.concatenate(sets)
        who = np.repeat(np.arange(len(sets), dtype=np.uint32), [len(x) for x in sets])
        part = ((flat >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        names, starts = np.unique(part[order], return_index=True)
        keys, whos, owners = [], [], []
        for begin, end in zip(starts, [*starts[1:], len(flat)]):
            present, local = np.unique(who[order[begin:end]], return_inverse=True)
            keys.append(flat[order[begin:end]].astype(np.uint32).tobytes())
            whos.append(local.astype(np.uint16).tobytes())
            owners.append(ids[present].tobytes())
        return pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), *(pa.array(x, pa.binary()) for x in (keys, whos, owners))],
                                          names=["part", "keys", "who", "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, sets, ids, held = set(), [], [], 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                elements = shingles(text, width)
                if len(elements) >= max(least, 1) and (key := set_key(elements)) not in seen:
                    seen.add(key)
                    sets.append(elements)
                    ids.append(key)
                    held += len(elements)
                    if held >= FLUSH_ELEMENTS or len(sets) == 65535:
                        yield flush(sets, np.array(ids, np.int64))
                        sets, ids, held = [], [], 0
        if sets:
            yield flush(sets, np.array(ids, np.int64))

    return docs.select("text").mapInArrow(run, "part int, keys binary, who binary, ids binary")


def shared_elements(sent: DataFrame, owners: int) -> DataFrame:
    """(part, ids, keys, counts): entries of the elements that several sets hold, dealt by owner (id modulo ``owners``).

    Every sender of a class sends the same entries of it to a part; those of one sender are taken.
    """

    def run(table: pa.Table) -> pa.Table:
        number = table.column("part")[0].as_py()
        owns = [np.frombuffer(own, np.int64) for own in table.column("ids").to_pylist()]
        begins = np.cumsum([0, *(len(own) for own in owns)])
        owner = np.concatenate(owns)
        first = np.zeros(len(owner), bool)
        first[np.unique(owner, return_index=True)[1]] = True
        place = np.concatenate([np.frombuffer(who, np.uint16) + begin for who, begin in zip(table.column("who").to_pylist(), begins)])
        taken = first[place]
        ids, keys = owner[place][taken], joined(table.column("keys").to_pylist(), np.uint32)[taken]
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        counts = np.repeat(np.diff(np.append(starts, len(keys))), np.diff(np.append(starts, len(keys))))
        some = counts > 1
        ids, keys, counts = ids[order][some], keys[some], counts[some]
        full = (np.uint64(number) << np.uint64(32)) | keys.astype(np.uint64)
        return pa.Table.from_batches([packed(np.mod(ids, owners).astype(np.int32), {"ids": ids, "keys": full, "counts": counts.astype(np.int64)})])

    return sent.groupBy("part").applyInArrow(run, "part int, ids binary, keys binary, counts binary")


def heavy_lists(shared: DataFrame, sizes: DataFrame, percent: int, owners: int) -> DataFrame:
    """(id, key): every heavy set under the rarest of its elements, as far as the prefix reaches into the shared ones."""
    known = sizes.select(F.pmod("id", F.lit(owners)).cast("int").alias("part"), F.col("id").cast("long").alias("id"), F.col("size").cast("long").alias("size"))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = pa.schema([("id", pa.int64()), ("key", pa.int64())])
        if not left.num_rows or not right.num_rows:
            return out.empty_table()
        ids, keys, counts = (joined(left.column(c).to_pylist(), k) for c, k in (("ids", np.int64), ("keys", np.uint64), ("counts", np.int64)))
        order = np.lexsort((keys, counts, ids))
        ids, keys = ids[order], keys[order]
        names, starts, shares = np.unique(ids, return_index=True, return_counts=True)
        owner, size = right.column("id").to_numpy(), right.column("size").to_numpy()
        by = np.argsort(owner)
        place = np.minimum(np.searchsorted(owner[by], names), len(owner) - 1)
        size = np.where(owner[by][place] == names, size[by][place], 0)
        reach = size + -(-percent * size // 100) * -1 + 1 - (size - shares)
        rank = np.arange(len(ids)) - np.repeat(starts, shares)
        kept = rank < np.repeat(np.where(size > 0, reach, 0), shares)
        return pa.table({"id": ids[kept], "key": keys[kept].view(np.int64)}, schema=out)

    return shared.groupBy("part").cogroup(known.groupBy("part")).applyInArrow(run, "id long, key long")


def linked_in_cell(ids: np.ndarray, sets: list[np.ndarray], left: np.ndarray, percent: int) -> list[tuple]:
    """A spanning forest of the links between ``left`` sets and all sets of the cell, by scanning inverted lists."""
    sizes = np.array([len(s) for s in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    label, out = np.arange(len(sets)), []
    for a in np.flatnonzero(left):
        begin, end = np.searchsorted(flat, sets[a], "left"), np.searchsorted(flat, sets[a], "right")
        counts = np.zeros(len(sets), np.int64)
        lists = [owner[b:e] for b, e in zip(begin, end) if e - b > 1]
        if not lists:
            continue
        counts += np.bincount(np.concatenate(lists), minlength=len(sets))
        found = np.flatnonzero(100 * counts >= percent * (sizes + sizes[a] - counts))
        found = found[label[found] != label[a]]
        if len(found):
            others, first = np.unique(label[found], return_index=True)
            out += [(ids[a], ids[found[f]]) for f in first]
            label[np.isin(label, others)] = label[a]
    return out


def links(docs: DataFrame, clusters: DataFrame, width: int, percent: int) -> DataFrame:
    """(u, v): links that connect what is linked inside the clusters (id, root, size, least).

    A class's elements are those of its rows with id ``least``. The texts are first narrowed to such ids; which of several
    texts under one id is meant shows once its set is known. Repeated rows are dropped in their task and in the cell.
    """
    weights = clusters.groupBy("root").agg(F.sum("size").alias("_weight")).withColumnRenamed("root", "_root")
    dealt = clusters.join(weights, F.col("root") == F.col("_root")).select(
        "id", "least", "root", F.ceil(F.col("_weight") / BLOCK_ELEMENTS).cast("int").alias("blocks")).withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    wanted = sized(dealt)
    texts = docs.select(F.col("doc_id").alias("_doc"), "text").join(wanted, F.col("_doc") == F.col("least"), "left_semi")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            rows, keys, values = [], [], []
            for i, (doc, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                elements = shingles(text, width)
                key = set_key(elements)
                if (doc, key) not in seen:
                    seen.add((doc, key))
                    rows.append(i)
                    keys.append(key)
                    values.append(elements.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(keys, pa.int64()), pa.array(values, pa.binary())],
                                             names=["_doc", "_key", "elements"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    filled = texts.mapInArrow(sets, f"_doc {kind}, _key long, elements binary").join(
        wanted, (F.col("_key") == F.col("id")) & (F.col("_doc") == F.col("least"))).select("id", "root", "block", "blocks", "elements")
    # block b meets every block c: cell (min, max); in a cell of two blocks only the first one's sets are asked
    cells = filled.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "id", "elements", "root", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"),
        (F.col("block") <= F.col("other")).alias("asks"))

    def cell(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates("id")
        found = linked_in_cell(rows["id"].to_numpy(), [np.frombuffer(e, np.uint64) for e in rows["elements"]], rows["asks"].to_numpy(), percent)
        return pd.DataFrame(found, columns=["u", "v"])

    return cells.groupBy("root", "a", "b").applyInPandas(cell, "u long, v long")


def similar_components(docs: DataFrame, width: int = 3, percent: int = 90) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``: components of sets with Jaccard >= ``percent`` / 100.

    Vertices of the search are classes (distinct sets) under their 64-bit keys; the text of a class is taken from its row
    with the smallest id and this very set, so a second text under a repeated id is a class like any other.
    Classes that share a ``doc_id`` are joined by an edge (rows that share an id are one vertex). A component's id is the
    smallest ``doc_id`` among its rows; every row of an id takes that id's component.
    """
    spark = docs.sparkSession
    path = fresh_path(spark, "shingles")
    shingle_sets(docs, width).write.parquet(path)
    stored = spark.read.parquet(path)
    named = stored.where("size > 0 AND doc_id IS NOT NULL")
    classes = cut_lineage(named.groupBy("id").agg(F.min("doc_id").alias("least"), F.max("size").alias("size")))
    counts = classes.groupBy(F.least("size", F.lit(128)).alias("size")).agg(F.count("*").alias("sets"), F.sum("size").alias("elements")).collect()
    limit = boundary([(r["size"], r["sets"]) for r in counts], percent) if counts else 1
    parts = max(16, math.ceil(sum(r["elements"] for r in counts) / PART_ELEMENTS))
    rows = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull())
    reach = -(-limit * percent // 100)
    sent = sent_elements(rows, width, reach, parts)
    heavy = heavy_lists(shared_elements(sent, parts), classes.where(F.col("size") >= reach), percent, parts)
    kept = fresh_path(spark, "lists")
    heavy.unionByName(light_lists(rows, width, percent, limit)).write.parquet(kept)
    entries = spark.read.parquet(kept)
    lists = entries.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last")).where(F.col("first") < F.col("last"))
    shared = lists.select(F.col("key").alias("_key"), "first")
    stars = entries.join(shared, F.col("key") == F.col("_key")).where(F.col("id") != F.col("first")).select(F.col("id").alias("u"), F.col("first").alias("v"))
    clusters = cut_lineage(components(stars).join(classes, "id"))
    # rows of one id hold one or more classes: those classes are one vertex
    owned = cut_lineage(named.select("doc_id", "id").distinct().join(classes.select("id", "least"), "id"))
    firsts = owned.groupBy("doc_id").agg(F.min("id").alias("_first"))
    together = owned.join(firsts, "doc_id").where(F.col("id") != F.col("_first")).select(F.col("id").alias("u"), F.col("_first").alias("v"))
    found = components(links(rows, clusters, width, percent).unionByName(together))
    rooted = owned.join(found, "id", "left").select("doc_id", F.coalesce("root", "id").alias("root"), "least")
    least = rooted.groupBy("root").agg(F.min("least").alias("_component"))
    per_id = rooted.join(least, "root").groupBy(F.col("doc_id").alias("_id")).agg(F.min("_component").alias("_component"))
    return stored.join(per_id, F.col("doc_id") == F.col("_id"), "left").select(
        "doc_id", F.col("size").alias("n_shingles"), F.coalesce("_component", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component, the smallest id; columns as they were."""
    found = similar_components(docs, width, percent).where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(found, F.col("doc_id") == F.col("_gone"), "left_anti")
