"""Benchmark decontamination: training windows against a broadcast hash set of normalised benchmark n-grams.

DataFrame functions only. Words are runs of ASCII letters, digits and non-ASCII characters, with A-Z lowered. Every item
gives its windows of ``window`` words (a shorter item is one window of its own length). Every document's windows are hashed
in place, unrolled and probed in the hash set; hits are verified on the words themselves, so hash collisions do no harm.

The scan hashes fully lowered words, which finds a superset, since equal normalised words are equal when lowered; the
verification then compares words with only A-Z lowered.

Defined cases: null and wordless texts have no words and no hits; items without words give no window; repeated items all
count; rows that share ``doc_id`` and text share one result. An item id that is null is listed as nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.session import sized

BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW = 10
FILTER_BITS = 1 << 16


def raw_words(text: Column) -> Column:
    """The words in their own case; the empty strings a split leaves at the ends are taken out."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BREAK), "")


def phrase(words: Column, start: Column, length: int | Column) -> Column:
    """A window as one string, A-Z lowered."""
    return F.translate(F.array_join(F.slice(words, start + 1, length), " "), UPPER, LOWER)


def window_hashes(hashes: Column, length: int) -> Column:
    """One hash for every window of ``length`` words, in order; empty for shorter texts."""
    places = F.size(hashes) - length
    return F.when(places >= 0, F.transform(
        F.sequence(F.lit(0), F.greatest(places, F.lit(0))),
        lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(length)]),
    )).otherwise(F.array().cast("array<bigint>"))


def hashed_words(text: Column) -> Column:
    return F.transform(raw_words(text), lambda w: F.xxhash64(F.lower(w)))


def flags(places: list[int]) -> Column:
    """A constant array of ``FILTER_BITS`` booleans, true at ``places``; folded before the scan starts."""
    marks = ["0"] * FILTER_BITS
    for place in places:
        marks[place] = "1"
    return F.split(F.lit(",".join(marks)), ",").cast("array<boolean>")


def count_words(text: Column) -> Column:
    return F.size(raw_words(text)).cast("long")


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item, length, hash, phrase): the distinct windows of every item."""
    words = benchmark.select(F.col("item_id").cast("string").alias("item"), raw_words(F.col("text")).alias("words"))
    words = words.where(F.size("words") > 0).withColumn("length", F.least(F.size("words"), F.lit(window)))
    places = words.select("item", "length", "words", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("length"))).alias("start"))
    return places.select("item", "length", phrase(F.col("words"), F.col("start"), F.col("length")).alias("phrase")).distinct().withColumn(
        "hash", F.aggregate(F.split("phrase", " "), F.array().cast("array<bigint>"),
                            lambda acc, w: F.concat(acc, F.array(F.xxhash64(F.lower(w))))))


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_hash, item, start, length): verified occurrences of item windows in documents."""
    items = item_windows(benchmark, window)
    lengths = sorted(r["length"] for r in items.select("length").distinct().collect())  # at most ``window`` of them
    if not lengths:
        lengths = [window]
    keyed = None
    for length in lengths:
        part = items.where(F.col("length") == length).select(
            "item", "phrase", F.col("length").alias("item_length"), F.xxhash64(*[F.get("hash", F.lit(k)) for k in range(length)]).alias("item_hash"))
        keyed = part if keyed is None else keyed.unionByName(part)
    targets = sized(keyed)
    words = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), raw_words(F.col("text")).alias("words"))
    hashed = words.select("doc_id", "text_hash", "words", F.transform("words", lambda w: F.xxhash64(F.lower(w))).alias("hashes"))
    found = None
    for length in lengths:
        # windows whose first two words begin no item window are passed over before they are hashed and unrolled
        lead = min(2, length)
        begins = F.xxhash64(*[F.get("hash", F.lit(k)) for k in range(lead)])
        heads = items.where(F.col("length") == length).select(F.pmod(begins, F.lit(FILTER_BITS)).alias("place")).distinct().collect()
        marked = flags([r["place"] for r in heads])
        starts = F.filter(
            F.transform(window_hashes(F.col("hashes"), lead), lambda h, i: F.when(F.get(marked, F.pmod(h, F.lit(FILTER_BITS)).cast("int")), i)),
            lambda i: i.isNotNull() & (i <= F.size("hashes") - length))
        windows = F.transform(starts, lambda i: F.struct(i.alias("start"), F.xxhash64(*[F.get("hashes", i + k) for k in range(length)]).alias("hash")))
        scanned = hashed.select("doc_id", "text_hash", "words", F.inline(windows).alias("start", "hash"))
        part = scanned.join(targets.where(F.col("item_length") == length), F.col("hash") == F.col("item_hash")).where(
            phrase(F.col("words"), F.col("start"), length) == F.col("phrase")
        ).select("doc_id", "text_hash", "item", "start", F.lit(length).alias("length"))
        found = part if found is None else found.unionByName(part)
    return found


def covered(spans: Column) -> Column:
    """Number of places covered by a sorted array of (start, length)."""
    return F.aggregate(
        spans, F.struct(F.lit(0).alias("end"), F.lit(0).alias("total")),
        lambda acc, s: F.struct(F.greatest(acc["end"], s["start"] + s["length"]).alias("end"),
                                (acc["total"] + F.greatest(F.lit(0), s["start"] + s["length"] - F.greatest(acc["end"], s["start"]))).alias("total")),
        lambda acc: acc["total"],
    )


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items, spans, contaminated) for every row of ``docs``."""
    per_text = hits(docs, benchmark, window).groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.collect_set(F.struct("start", "length"))).alias("spans"),
        F.array_sort(F.collect_set("item")).alias("items"))
    found = per_text.select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash"), "spans", "items",
                            covered(F.col("spans")).cast("long").alias("n_hit"))
    counted = docs.select("doc_id", F.xxhash64("text").alias("_text"), count_words(F.col("text")).alias("n_words"))
    joined = counted.join(found, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_text") == F.col("_hash")), "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return joined.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        items.alias("items"), F.coalesce("spans", F.array().cast("array<struct<start:int,length:int>>")).alias("spans"),
        (F.coalesce("n_hit", F.lit(0).cast("long")) > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, min_share: float = 0.0) -> DataFrame:
    """``docs`` without the documents of which more than ``min_share`` of the words are hit; columns as they were."""
    per_text = hits(docs, benchmark, window).groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.collect_set(F.struct("start", "length"))).alias("spans"))
    bad = per_text.select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash"), covered(F.col("spans")).alias("_hit"))
    joined = docs.join(bad, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.xxhash64("text") == F.col("_hash")), "left")
    share = F.when(F.col("_hit").isNull(), F.lit(0.0)).otherwise(F.col("_hit") / F.greatest(count_words(F.col("text")), F.lit(1)))
    return joined.where(share <= min_share).select(*[F.col(f"`{c}`") for c in docs.columns])


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the hit words cut out of ``text``; texts with a hit come out as their other words, one space apart."""
    per_text = hits(docs, benchmark, window).groupBy("doc_id", "text_hash").agg(
        F.array_distinct(F.flatten(F.collect_set(F.sequence(F.col("start"), F.col("start") + F.col("length") - 1)))).alias("_places"))
    bad = per_text.select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash"), F.map_from_arrays("_places", F.transform("_places", lambda p: F.lit(True))).alias("_gone"))
    joined = docs.join(bad, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.xxhash64("text") == F.col("_hash")), "left")
    rest = F.array_join(F.filter(raw_words(F.col("text")), lambda w, i: ~F.coalesce(F.map_contains_key(F.col("_gone"), i), F.lit(False))), " ")
    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(rest)
    return joined.withColumn("text", text).select(*[F.col(f"`{c}`") for c in docs.columns])
