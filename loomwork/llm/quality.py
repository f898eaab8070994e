"""Quality rules: plain counts, then a hashed n-gram log-likelihood ratio between a trusted target and the raw corpus.

DataFrame functions only. Word unigrams and bigrams are hashed into a fixed number of buckets. Two smoothed multinomials are
counted, one over the trusted documents and one over all; a text's score is the mean log ratio of its n-grams, so length
does not matter, and every document is kept or dropped by the same threshold. Counts cover every document; the trusted set
is a bounded, documented number of labelled rows, picked by a hash of their ids.

Defined cases: null and empty texts have no words, no n-grams and score 0, and fail the base rules; with no trusted row the
ratio is 0 everywhere and only the base rules decide; rows that share a ``doc_id`` are scored one by one and are all trusted
when it is.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.llm.contamination import window_hashes

GAP = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = r"[#*$%&|<>]"
REPEAT_WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
BUCKETS = 1 << 14
TRUSTED_ROWS = 20_000
THRESHOLD = -0.1


def split_words(text: Column) -> Column:
    return F.array_remove(F.split(text, GAP), "")


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda line: F.length(F.btrim(line, F.lit(BLANKS))) > 0)
    return F.size(lines) - F.size(F.array_distinct(lines))


def covered_words(windows: Column, width: int) -> Column:
    """Words inside windows whose hash occurs at least twice; texts without any take the short way."""
    placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    # a fold over the sorted hashes collects the places of equal neighbours
    pairs = F.zip_with(F.slice(placed, 1, F.size(windows) - 1), F.slice(placed, 2, F.size(windows) - 1),
                       lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    places = F.array_sort(F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull()))))
    cover = F.aggregate(
        places, F.struct(F.lit(0).alias("end"), F.lit(0).alias("total")),
        lambda acc, p: F.struct((p + width).alias("end"), (acc["total"] + p + width - F.greatest(acc["end"], p)).alias("total")),
        lambda acc: acc["total"])
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(cover)


def grams(hashes: Column, buckets: int) -> Column:
    """Bucket numbers of all word unigrams and bigrams."""
    one = F.transform(hashes, lambda h: F.pmod(h, F.lit(buckets)).cast("int"))
    two = F.transform(window_hashes(hashes, 2), lambda h: F.pmod(h, F.lit(buckets)).cast("int"))
    return F.concat(one, two)


def trusted_ids(labels: DataFrame, rows: int = TRUSTED_ROWS) -> DataFrame:
    """At most ``rows`` ids of documents labelled good, those with the lowest hashes."""
    good = labels.where(F.col("quality") == 1).select("doc_id").distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def ratio_table(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, smoothing: float = 1.0) -> list[float]:
    """The log ratio of every bucket, as many numbers as there are buckets. ``trusted`` (doc_id) must be bounded; it is broadcast."""
    marked = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(
        F.broadcast(trusted.select(F.col("doc_id").alias("_good"))), F.col("doc_id") == F.col("_good"), "left")
    hashed = marked.select(F.col("_good").isNotNull().cast("long").alias("good"),
                           F.transform(split_words(F.col("text")), lambda w: F.xxhash64(w)).alias("hashes"))
    counted = hashed.select("good", F.explode(grams(F.col("hashes"), buckets)).alias("bucket")).groupBy("bucket").agg(
        F.sum("good").alias("good"), F.count("*").alias("raw")).collect()
    goods, raws = sum(r["good"] for r in counted), sum(r["raw"] for r in counted)
    table = [0.0] * buckets
    if goods:
        table = [log(smoothing / (goods + smoothing * buckets)) - log(smoothing / (raws + smoothing * buckets))] * buckets
        for r in counted:
            table[r["bucket"]] = log((r["good"] + smoothing) / (goods + smoothing * buckets)) - log((r["raw"] + smoothing) / (raws + smoothing * buckets))
    return table


def judge(docs: DataFrame, table: list[float], threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, counts, base_failed, log_ratio, kept) for every row of ``docs``."""
    text = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    words = text.select("doc_id", "text", split_words(F.col("text")).alias("words"))
    counted = words.select(
        "doc_id", F.size("words").cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, ""))).cast("long").alias("n_symbols"), repeated_lines(F.col("text")).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    shingled = counted.withColumns({"windows": window_hashes(F.col("hashes"), REPEAT_WINDOW), "grams": grams(F.col("hashes"), len(table))}).drop("hashes")
    # one constant of fixed size: the optimizer folds it into an array before the scan starts
    ratios = F.split(F.lit(",".join(f"{x:.6f}" for x in table)), ",").cast("array<double>")
    scored = shingled.withColumns({
        "n_repeat_words": covered_words(F.col("windows"), REPEAT_WINDOW).cast("long"),
        "log_ratio": F.aggregate("grams", F.lit(0.0), lambda acc, g: acc + F.get(ratios, g)) / F.greatest(F.size("grams"), F.lit(1)),
    }).drop("windows", "grams")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return scored.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("log_ratio") >= threshold))
