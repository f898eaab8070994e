"""Document fingerprints by closed syncmers, in Spark SQL functions only.

A text's tokens are its words ``[^\\x20\\x09-\\x0D]+``, each hashed to 64 bits. A k-mer is ``K`` consecutive words and
its inner substrings are its ``S``-word s-mers (hashed likewise). The k-mer is a closed syncmer when the smallest s-mer
hash inside it sits at its first or its last s-mer; that depends on the k-mer alone, so equal passages give equal
anchors wherever they stand (no window of neighbours decides, unlike minimizers). About 2 / (K - S + 1) of all positions
are anchors. A fingerprint is the text's anchors (64-bit hash of the k-mer) in text order; likeness of two fingerprints
is the Jaccard index of their distinct anchors.

Everything is arrays and higher-order functions inside one row: no Python worker, no shuffle for the fingerprint itself.

Defined cases: a null text is empty; an empty or blank text has no words and the empty fingerprint; a text of 1 to
``K - 1`` words has one anchor, the hash of all its words; two empty fingerprints are alike (1.0), an empty and a
non-empty one are not (0.0); equal texts have equal fingerprints; very long texts are handled whole, in time linear in
their words times ``K``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 10
S = 4
WORDS = r"[^\x20\x09-\x0D]+"


def bound(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once: nested lambdas see a variable, not an expression to evaluate anew."""
    return F.element_at(F.transform(F.array(value), body), 1)


def anchors(text: Column, k: int = K, s: int = S) -> Column:
    """array<long>: the closed-syncmer anchors of ``text`` in text order."""
    words = F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORDS), 0), lambda w: F.xxhash64(w))

    def from_hashes(h: Column) -> Column:
        n = F.size(h)
        smers = F.transform(F.sequence(F.lit(0), F.greatest(n - s, F.lit(0))), lambda i: F.xxhash64(F.slice(h, i + 1, s)))

        def from_smers(sm: Column) -> Column:
            closed = F.filter(
                F.sequence(F.lit(0), F.greatest(n - k, F.lit(0))),
                lambda p: F.array_min(F.slice(sm, p + 1, k - s + 1)).isin(sm[p], sm[p + (k - s)]))
            return (F.when(n >= k, F.transform(closed, lambda p: F.xxhash64(F.slice(h, p + 1, k))))
                    .when(n > 0, F.array(F.xxhash64(h)))
                    .otherwise(F.array().cast("array<bigint>")))

        return bound(smers, from_smers)

    return bound(words, from_hashes)


def likeness(a: Column, b: Column) -> Column:
    """Jaccard index of the distinct anchors of two fingerprints (1.0 when both are empty)."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def as_text(a: Column) -> Column:
    """A fingerprint as text: its anchors as 16 lowercase hex digits, space-separated, in text order."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), " ")


SAMPLE_PER_BUCKET = 100  # sampled sort keys per bucket when the bucket bounds are placed (speed only, never results)


def order_key(doc_id: Column, h: Column, place: Column) -> Column:
    """The total order of rows: doc_id ascending with nulls last, then text hash, then place in the scan."""
    return F.struct(doc_id.isNull().alias("k0"), F.coalesce(doc_id.cast("long"), F.lit(0).cast("long")).alias("k1"),
                    h.cast("long").alias("k2"), place.cast("long").alias("k3"))


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", buckets: int | None = None, carry=None) -> DataFrame:
    """(doc_id, t, next_t): every row and the text of the row after it in ascending doc_id (nulls last), the last one
    followed by the first. ``carry`` maps names to functions of the text; each is computed once a row, before the
    shuffle, and comes as ``name`` and ``next_name``.

    Ties of doc_id are ordered by a hash of the text and the row's place in the scan, so a hot id is split over
    buckets too. Bucket bounds are placed on a bounded sample of the sort keys (``SAMPLE_PER_BUCKET`` a bucket); every
    row finds its bucket by its key, map-side, and the texts are dealt by bucket in the only shuffle of texts. The
    successor inside a bucket is ``lead`` over that partitioning. The last row of a bucket takes the first row of the
    next non-empty bucket: those first rows (one a bucket) are found by an aggregate of keys and a filtered scan, and
    broadcast.
    """
    spark = docs.sparkSession
    parts = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    base = base.select("doc_id", "t", F.xxhash64("t").alias("h"), F.monotonically_increasing_id().alias("place"))
    base = base.select("doc_id", "t", "place", order_key(F.col("doc_id"), F.col("h"), F.col("place")).alias("key"))
    keys = base.select("key")
    total = keys.count()
    fraction = min(1.0, SAMPLE_PER_BUCKET * parts / max(total, 1))
    drawn = sorted(tuple(r["key"]) for r in keys.sample(fraction=fraction, seed=13).collect())
    bounds = [drawn[len(drawn) * i // parts] for i in range(1, parts)] if drawn else []
    literal = F.array(*[F.struct(F.lit(b[0]).alias("k0"), F.lit(b[1]).cast("long").alias("k1"), F.lit(b[2]).cast("long").alias("k2"),
                                 F.lit(b[3]).cast("long").alias("k3")) for b in bounds])
    placed = base.withColumn("bucket", F.size(F.filter(literal, lambda b: b <= F.col("key"))) if bounds else F.lit(0))
    # first row of every non-empty bucket: keys only, one row a bucket, then its text by a filtered scan
    heads = sorted((r["bucket"], tuple(r["first"])) for r in placed.groupBy("bucket").agg(F.min("key").alias("first")).collect())
    carry = carry or {}
    if not heads:
        made = [c for name, fn in carry.items() for c in (fn(F.col("t")).alias(name), fn(F.col("t")).alias(f"next_{name}"))]
        return base.select("doc_id", "t", F.col("t").alias("next_t"), *made).limit(0)
    following = {heads[i][0]: heads[(i + 1) % len(heads)][1][3] for i in range(len(heads))}
    wanted = sorted(set(following.values()))
    texts = {r["place"]: r["t"] for r in placed.where(F.col("place").isin(wanted)).select("place", "t").collect()}
    firsts = spark.createDataFrame([(b, texts[p]) for b, p in following.items()], "bucket int, first_t string")
    firsts = firsts.select("bucket", "first_t", *[fn(F.col("first_t")).alias(f"first_{name}") for name, fn in carry.items()])
    dealt = placed.select("doc_id", "t", "key", "bucket", *[fn(F.col("t")).alias(name) for name, fn in carry.items()]).repartition(parts, "bucket")
    inside = Window.partitionBy("bucket").orderBy("key")
    rows = dealt.select("doc_id", "t", "bucket", *carry, F.lead("t").over(inside).alias("lead_t"),
                        *[F.lead(name).over(inside).alias(f"lead_{name}") for name in carry])
    last = F.col("lead_t").isNull()
    return rows.join(F.broadcast(firsts), "bucket", "left").select(
        "doc_id", "t", F.when(last, F.col("first_t")).otherwise(F.col("lead_t")).alias("next_t"),
        *[c for name in carry for c in (F.col(name), F.when(last, F.col(f"first_{name}")).otherwise(F.col(f"lead_{name}")).alias(f"next_{name}"))])


def fingerprint_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = K, s: int = S) -> DataFrame:
    """Per row: doc_id, n_chars, edited text and its sha256, fingerprints of text and edited text, near_edited and
    near_next (likeness to the edited text's and to the next document's fingerprint)."""
    paired = with_next(docs, doc_id, text, carry={"own": lambda t: anchors(t, k, s)})
    edited = paired.select(
        "doc_id", "t", "next_t", "own", "next_own",
        F.expr("concat(substring(t, 1, char_length(t) - char_length(t) DIV 4), substring(next_t, 1, char_length(t) DIV 4))").alias("edited"))
    own = F.col("own")
    summary = bound(anchors(F.col("edited"), k, s), lambda changed: F.struct(
        as_text(own).alias("fingerprint"), as_text(changed).alias("edited_fingerprint"),
        likeness(own, changed).cast("double").alias("near_edited"),
        likeness(own, F.col("next_own")).cast("double").alias("near_next")))
    marked = edited.select("doc_id", "t", "edited", summary.alias("f"))
    return marked.select(
        "doc_id", F.char_length("t").cast("long").alias("n_chars"), "edited", F.sha2("edited", 256).alias("edited_sha256"),
        "f.fingerprint", "f.edited_fingerprint", "f.near_edited", "f.near_next")
