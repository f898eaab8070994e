"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

DataFrame functions only. A source is read as one stream of words: its documents follow each other in the order of a hash
of their ids. The stream is cut into blocks of equal length. A source's quota is the number of block draws that comes
nearest to its target; beyond one pass over the source a second pass over newly permuted blocks begins. A binary tree over
the output shards splits the quotas of all sources: at every node the left half draws its counts from a multivariate
hypergeometric distribution, source after source, each by inverting the distribution with a hashed uniform number, so that
shard counts add up to the quotas exactly. A shard then takes the next run of permuted block draws of each source, which
makes the draws of shards disjoint, and orders them by a hash (the local shuffle).

The place of a document in its stream needs no sort of a source: documents are dealt into slices by hash, the slice totals
are added up, and only within a slice rows are ordered. Hot sources have many slices.

Defined cases: null and wordless texts have size 0 and take nothing; a null source is a source of its own, last in order;
rows that share a ``doc_id`` are taken one by one; a source without words has target 0. The same input and seed always give
the same mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomwork.session import cut_lineage, sized

WORD, GAP = r"[^\x20\x09-\x0D]+", r"[\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_REPEATS = 2
BLOCK_WORDS = 512
SHARDS = 16
SLICE_ROWS = 64
MAX_SLICES = 65536
STEP, JUMP = 1_000_003, 7_919  # primes; the step is replaced by one block for the sources it divides


def count_words(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")).cast("long")


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) that depends on the arguments only."""
    return (F.pmod(F.xxhash64(*parts), F.lit(1 << 40)).cast("double") + 0.5) / float(1 << 40)


def water_fill(totals: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, repeats: int = MAX_REPEATS) -> DataFrame:
    """``totals`` (source, words, ...) with ``target``: ``share`` of all words by weight, none above ``repeats`` times its size.

    What is cut at a ceiling goes to the others by weight. Sorted by size over weight the ceilings are reached in that
    order, so the level is found by running sums over the summary and no iteration is needed.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighed = totals.withColumn("weight", F.get(cycle, F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))))
    ceiling = F.lit(float(repeats)) * F.col("words")
    by_level = Window.orderBy(F.col("_level"), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(0))
    ranked = weighed.withColumn("_ceiling", ceiling).withColumn("_level", F.col("_ceiling") / F.col("weight")).withColumns({
        "_budget": F.sum("words").over(everything) * share,
        "_spent": F.coalesce(F.sum("_ceiling").over(before), F.lit(0.0)),
        "_weights": F.sum("weight").over(rest),
    })
    # the level at which the budget is spent if this source is the first that stays below its ceiling
    levelled = ranked.withColumn("_water", (F.col("_budget") - F.col("_spent")) / F.col("_weights"))
    open_level = F.max(F.when(F.col("_water") <= F.col("_level"), F.col("_water"))).over(everything)
    return levelled.withColumn("_open", open_level).withColumn(
        "target", F.when(F.col("_open").isNull(), F.col("_ceiling")).otherwise(F.least(F.col("_ceiling"), F.col("_open") * F.col("weight")))
    ).drop("_ceiling", "_level", "_budget", "_spent", "_weights", "_water", "_open")


def hypergeometric(total: Column, good: Column, drawn: Column, u: Column) -> Column:
    """Number of ``good`` ones among ``drawn`` of ``total``, by inverting the distribution at ``u``.

    Probabilities are summed over twelve standard deviations to either side, relative to the lowest of these counts.
    """
    n, k, m = total.cast("double"), good.cast("double"), drawn.cast("double")
    safe = F.greatest(n, F.lit(1.0))
    mean = m * k / safe
    wide = F.lit(12.0) * F.sqrt(mean * (1 - k / safe) * (n - m) / F.greatest(n - 1, F.lit(1.0))) + 12
    low = F.greatest(F.lit(0), F.greatest(drawn + good - total, F.floor(mean - wide))).cast("long")
    high = F.least(F.least(good, drawn), F.ceil(mean + wide)).cast("long")

    def ratio(x: Column) -> Column:
        x = x.cast("double")
        return (k - x) * (m - x) / ((x + 1) * (n - k - m + x + 1))

    steps = F.when(high > low, F.sequence(low, high - 1)).otherwise(F.array().cast("array<bigint>"))
    first = F.lit(1e-30)
    mass = F.aggregate(steps, F.struct(first.alias("p"), first.alias("sum")), lambda acc, x: F.struct(
        (acc["p"] * ratio(x)).alias("p"), (acc["sum"] + acc["p"] * ratio(x)).alias("sum")), lambda acc: acc["sum"])
    return F.aggregate(
        steps, F.struct(first.alias("p"), first.alias("sum"), low.alias("at"), (u * mass).alias("goal")),
        lambda acc, x: F.when(acc["sum"] >= acc["goal"], acc).otherwise(F.struct(
            (acc["p"] * ratio(x)).alias("p"), (acc["sum"] + acc["p"] * ratio(x)).alias("sum"), (x + 1).alias("at"), acc["goal"].alias("goal"))),
        lambda acc: acc["at"])


def splitting_tree(quotas: DataFrame, shards: int = SHARDS, seed: int = 0) -> DataFrame:
    """(source_no, starts): for each source where the draws of each shard begin, from ``quotas`` (source_no, quota).

    ``shards`` is a power of two. A level of the tree is one fold over the sources for each of its nodes; the rows are nodes.
    """
    levels = shards.bit_length() - 1
    if 1 << levels != shards:
        raise ValueError("shards must be a power of two")
    nodes = quotas.agg(F.array_sort(F.collect_list(F.struct(F.col("source_no"), F.col("quota")))).alias("counts")).withColumn("node", F.lit(0))
    for level in range(levels):
        total = F.aggregate("counts", F.lit(0).cast("long"), lambda acc, c: acc + c["quota"])
        at_node = nodes.withColumn("_total", total)

        def left(acc, c):
            u = uniform(F.lit(seed), F.lit(level), F.col("node"), c["source_no"])
            got = hypergeometric(acc["total"], c["quota"], acc["drawn"], u)
            return F.struct((acc["total"] - c["quota"]).alias("total"), (acc["drawn"] - got).alias("drawn"),
                            F.concat(acc["out"], F.array(F.struct(c["source_no"].alias("source_no"), got.alias("quota")))).alias("out"))

        kind = "array<struct<source_no:int,quota:bigint>>"
        halves = at_node.withColumn("_left", F.aggregate(
            "counts", F.struct(F.col("_total").alias("total"), F.expr("_total div 2").alias("drawn"), F.array().cast(kind).alias("out")),
            left, lambda acc: acc["out"]))
        rest = F.zip_with("counts", "_left", lambda c, a: F.struct(c["source_no"].alias("source_no"), (c["quota"] - a["quota"]).alias("quota")))
        sides = F.explode(F.array(F.struct((F.col("node") * 2).alias("node"), F.col("_left").alias("counts")),
                                  F.struct((F.col("node") * 2 + 1).alias("node"), rest.alias("counts"))))
        nodes = halves.select(sides.alias("_side")).select("_side.node", "_side.counts")
    leaves = nodes.select("node", F.explode("counts").alias("c")).select("node", "c.source_no", "c.quota")
    before = Window.partitionBy("source_no").orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
    offsets = leaves.withColumn("start", F.coalesce(F.sum("quota").over(before), F.lit(0)))
    return offsets.groupBy("source_no").agg(F.transform(F.array_sort(F.collect_list(F.struct("node", "start"))), lambda s: s["start"]).alias("starts"))


def source_plan(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, block_words: int = BLOCK_WORDS,
                shards: int = SHARDS, seed: int = 0) -> DataFrame:
    """One row per source: size, target, block length, number of blocks, quota of draws and where each shard's draws begin.

    A block is at most a 1024th of its source, so that quotas of small sources are fine enough, and at least a millionth of
    the corpus, so that the tree costs the same at any size.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("words"), F.count("*").alias("rows"))
    filled = water_fill(totals, weights, share)
    order = Window.orderBy(F.col("source").asc_nulls_last())
    grain = F.greatest(F.lit(float(block_words)), F.sum("words").over(Window.partitionBy(F.lit(0))) / 1e6)
    plan = filled.withColumn("block", F.greatest(F.lit(1), F.least(F.floor(grain), F.floor(F.col("words") / 1024))).cast("long")) \
        .withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("words") / F.col("block"))).cast("long")) \
        .withColumn("quota", F.least(F.col("blocks") * MAX_REPEATS, F.round(F.col("target") / F.col("block"))).cast("long")) \
        .withColumn("source_no", F.row_number().over(order)) \
        .withColumn("slices", F.least(F.lit(MAX_SLICES), F.ceil(F.col("rows") / SLICE_ROWS)).cast("long"))
    stored = cut_lineage(plan)
    tree = splitting_tree(stored.select("source_no", "quota"), shards, seed)
    return stored.join(tree, "source_no")


def draw_no(block: Column, epoch: int, blocks: Column, seed: int) -> Column:
    """Which draw of its source brings this block in pass ``epoch``: a permutation of the blocks, another one per pass."""
    step = F.when(blocks % STEP == 0, F.lit(1)).otherwise(F.lit(STEP))
    return F.pmod(block * step + F.lit((seed + 1) * JUMP * (epoch + 1)), blocks) + blocks * epoch


def mix(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, block_words: int = BLOCK_WORDS,
        shards: int = SHARDS, seed: int = 0) -> DataFrame:
    """Per row of ``docs``: (doc_id, source, size, source_size, target, pieces).

    ``pieces`` lists what the mix takes of the document: (shard, order, epoch, first, words), ``first`` counted in words from
    the start of the document, ``order`` the place of the block in the shard's local shuffle.
    """
    sizes = cut_lineage(docs.select("doc_id", "source", count_words(F.col("text")).alias("size"),
                                    F.xxhash64(F.lit(seed), F.col("doc_id").cast("string")).alias("place")))
    plan = sized(source_plan(sizes, weights, share, block_words, shards, seed).withColumnRenamed("source", "_source"))
    placed = sizes.join(plan, F.col("source").eqNullSafe(F.col("_source"))).drop("_source", "rows") \
        .withColumn("slice", F.pmod(F.shiftright("place", 20), F.col("slices")))
    slices = placed.groupBy("source_no", "slice").agg(F.sum("size").alias("_words"))
    earlier = Window.partitionBy("source_no").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = slices.select(F.col("source_no").alias("_no"), F.col("slice").alias("_slice"), F.coalesce(F.sum("_words").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("source_no", "slice").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    ranked = placed.withColumn("_within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    spans = ranked.join(starts, (F.col("source_no") == F.col("_no")) & (F.col("slice") == F.col("_slice"))) \
        .withColumn("_from", F.col("_before") + F.col("_within")).withColumn("_to", F.col("_from") + F.col("size"))
    first, last = F.expr("_from div block"), F.expr("(_to - 1) div block")
    touched = F.when(F.col("size") > 0, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))

    def piece(block, epoch):
        draw = draw_no(block, epoch, F.col("blocks"), seed)
        begin = F.greatest(F.col("_from"), block * F.col("block"))
        end = F.least(F.col("_to"), (block + 1) * F.col("block"))
        shard = F.size(F.filter("starts", lambda s: s <= draw)) - 1
        return F.struct(shard.alias("shard"), F.xxhash64(F.lit(seed), F.col("source_no"), draw).alias("order"), F.lit(epoch).alias("epoch"),
                        (begin - F.col("_from")).alias("first"), (end - begin).alias("words"))

    def pieces_of(epoch):
        drawn = F.filter(touched, lambda b: draw_no(b, epoch, F.col("blocks"), seed) < F.col("quota"))
        return F.transform(drawn, lambda b: piece(b, epoch))

    taken = F.concat(*[pieces_of(epoch) for epoch in range(MAX_REPEATS)])
    return spans.select("doc_id", "source", "size", F.col("words").alias("source_size"), "target", taken.alias("pieces"))


def taken_words(pieces: Column) -> Column:
    return F.aggregate(pieces, F.lit(0).cast("long"), lambda acc, p: acc + p["words"])


def shard_rows(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The mix itself: (shard, order, doc_id, epoch, text) pieces, dealt by shard and order so that writers get whole runs.

    Sorting by ``order`` within a shard is the local shuffle; a large shard spreads over several partitions in that order.
    Rows of ``docs`` must have distinct ids here.
    """
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"({WORD})"), F.lit(1))
    pieces = mixed.select("doc_id", F.explode("pieces").alias("p"))
    cut = docs.select("doc_id", words.alias("_words")).join(pieces, "doc_id").select(
        "p.shard", "p.order", "doc_id", "p.epoch", F.array_join(F.slice("_words", (F.col("p.first") + 1).cast("int"), F.col("p.words").cast("int")), " ").alias("text"))
    return cut.repartitionByRange("shard", "order").sortWithinPartitions("shard", "order", "doc_id")
