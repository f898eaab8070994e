"""Documents: chunking, lengths, prompts, extraction from answers, TF-IDF scores."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.functions.text import hard_split, split_text, strip, words
from loomwork.operators.explore import histogram
from loomwork.operators.ordered import exact_quantiles
from loomwork.session import cut_lineage

SINGLE_IDF = 1.0 + math.log(1.5)  # a word in one of two texts; a word in both weighs 1


# Common English function words. Every scorer takes another list as a parameter.
STOP_WORDS = """
a about above after again against all am an and any are as at be because been before being below between both but by
can could did do does doing down during each few for from further had has have having he her here hers herself him
himself his how i if in into is it its itself just me more most my myself no nor not now of off on once only or other
our ours ourselves out over own same she should so some such than that the their theirs them themselves then there
these they this those through to too under until up very was we were what when where which while who whom why will
with would you your yours yourself yourselves
""".split()


def _unrolled(documents: DataFrame, pieces: Column) -> DataFrame:
    """One row per piece. Index and count are those before blank pieces are dropped.

    A document without pieces gives a row without content, dropped below: a plain ``posexplode`` would have the optimiser
    ask for the number of pieces first, and cut every text twice.
    """
    rest = [c for c in documents.columns if c != "content"]
    rows = documents.select(*rest, pieces.alias("_p")).select(*rest, F.size("_p").alias("chunk_count"), F.posexplode_outer("_p").alias("chunk_index", "content"))
    return rows.withColumn("content", strip("content")).filter(F.length("content") > 0)


def chunk_documents(documents: DataFrame, size: int = 512, overlap: int = 50) -> DataFrame:
    """Chunks of each document's ``content``, other columns kept."""
    return _unrolled(documents, split_text("content", size, overlap))


def hard_split_documents(documents: DataFrame, size: int = 512, overlap: int = 50) -> DataFrame:
    """Character windows of each document."""
    return _unrolled(documents, hard_split(F.col("content"), size, overlap))


def chunk_size_sweep(documents: DataFrame, settings: list[tuple[int, int]]) -> DataFrame:
    """Number of chunks per (size, overlap); the texts are read once for all settings."""
    counts = [F.size(F.filter(split_text("content", s, o), lambda p: F.length(strip(p)) > 0)).alias(f"n_{i}") for i, (s, o) in enumerate(settings)]
    sums = documents.select(*counts).agg(*[F.sum(f"n_{i}").alias(f"n_{i}") for i in range(len(settings))])
    rows = F.array(*[F.struct(F.lit(s).alias("size"), F.lit(o).alias("overlap"), F.col(f"n_{i}").alias("n_chunks")) for i, (s, o) in enumerate(settings)])
    return sums.select(F.inline(rows))


def length_counts(chunks: DataFrame) -> DataFrame:
    """``(len, n)``: chunks of each length. Stored, because the summaries below read it more than once."""
    return cut_lineage(chunks.groupBy(F.length("content").alias("len")).agg(F.count("*").alias("n")))


def chunk_length_stats(chunks: DataFrame) -> DataFrame:
    """Mean, median, shortest and longest chunk."""
    counts = length_counts(chunks)
    median = exact_quantiles(counts, "len", [0.5], weight="n").select("value").scalar()
    return counts.agg(
        (F.sum(F.col("len") * F.col("n")) / F.sum("n")).alias("mean_len"), F.min("len").alias("min_len"), F.max("len").alias("max_len"),
        F.sum("n").alias("n_chunks"),
    ).withColumn("median_len", median)


def chunk_length_hist(chunks: DataFrame, bins: int = 15) -> DataFrame:
    """Histogram of the chunk lengths."""
    return histogram(length_counts(chunks), "len", bins, weight="n")


def chunk_length_quartiles(chunks: DataFrame) -> DataFrame:
    """Box-plot quartiles of the chunk lengths."""
    return exact_quantiles(chunks.select(F.length("content").alias("len")), "len", [0.25, 0.5, 0.75])


def document_lengths(documents: DataFrame, preview: int = 500) -> DataFrame:
    """Type, name, characters and the first characters of each document."""
    return documents.select(
        "doc_id", "file_type", "filename", F.length("content").alias("n_chars"), F.substring("content", 1, preview).alias("preview")
    )


def append_documents(existing: DataFrame, added: DataFrame) -> DataFrame:
    """Collection with new chunks; adding a document twice keeps both copies."""
    return existing.unionByName(added, allowMissingColumns=True)


# --- prompts and answers -----------------------------------------------------------

# The wording of the prompt.
PROMPT_HEAD = "Answer based on context:\n\n"
PROMPT_QUESTION = "\n\nQuestion: "
PROMPT_END = "\n\nAnswer:"

def assemble_prompt(found: DataFrame, questions: DataFrame, key: str = "query_id") -> DataFrame:
    """Prompt per question from its ranked chunks ``(key, rank, filename, content)``; at most k chunks each."""
    block = F.concat(
        F.lit("["), F.col("rank").cast("string"), F.lit("] (source: "), F.coalesce("filename", F.lit("unknown")), F.lit(")\n"), F.col("content")
    )
    blocks = found.select(key, F.struct(F.col("rank"), block.alias("text")).alias("b")).groupBy(key).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("b")), lambda b: b["text"]), "\n\n").alias("context")
    )
    return questions.join(blocks, key, "left").select(
        key,
        F.concat(
            F.lit(PROMPT_HEAD), F.coalesce("context", F.lit("")), F.lit(PROMPT_QUESTION), F.col("question"), F.lit(PROMPT_END)
        ).alias("prompt"),
    )


def source_preview(found: DataFrame, top: int = 3, width: int = 200) -> DataFrame:
    """The first sources of each query with a one-line preview."""
    return found.filter(F.col("rank") <= top).select(
        "query_id", "rank", F.coalesce("filename", F.lit("unknown")).alias("filename"), F.round("score", 3).alias("score"),
        F.concat(F.replace(F.substring("content", 1, width), F.lit("\n"), F.lit(" ")), F.lit("...")).alias("preview"),
    )


# How SQL and verdicts are marked in an answer.
FENCED = r"(?s)```sql\s*(.*?)\s*```"
BARE_SELECT = r"(?is)(SELECT .+?)(?:;|$)"
GOOD, BAD = "ANSWER:", "RETRY:"


def extract_sql_block(rows: DataFrame, column: str = "text") -> DataFrame:
    """Fenced SQL, else the first SELECT up to a semicolon, else the text itself."""
    text = F.col(column)
    picked = (
        F.when(text.rlike(FENCED), F.regexp_extract(text, FENCED, 1))
        .when(text.rlike(BARE_SELECT), F.regexp_extract(text, BARE_SELECT, 1))
        .otherwise(text)
    )
    return rows.withColumn("sql", strip(picked))


def parse_verdict(rows: DataFrame, column: str = "text") -> DataFrame:
    """Whether the text is an answer, and the text without its mark."""
    text = F.col(column)
    good = F.startswith(text, F.lit(GOOD))
    return rows.withColumns({
        "verdict": F.when(good, F.lit("answer")).otherwise(F.lit("retry")),
        "body": strip(F.replace(text, F.when(good, F.lit(GOOD)).otherwise(F.lit(BAD)), F.lit(""))),
    })


# --- TF-IDF scores -------------------------------------------------------------------

def content_words(text: str | Column, stop_words: list[str]) -> Column:
    """Words of a text without stop words, repeats kept."""
    return F.filter(words(text), lambda w: ~w.isin(*stop_words))


def pair_cosine(a: str | Column, b: str | Column, stop_words: list[str]) -> Column:
    """Cosine of two texts under the TF-IDF of just these two.

    The words of both texts are sorted together and folded with a state of seven numbers, so a pair is scored
    inside its row: nothing is shuffled and a long text costs its sort.
    """
    def tagged(text, side):
        return F.transform(content_words(text, stop_words), lambda w: F.struct(w.alias("w"), F.lit(side).alias("side")))

    merged = F.array_sort(F.concat(tagged(a, 0), tagged(b, 1)))
    zero = F.lit(0.0)

    def state(w, ca, cb, dot, na, nb):
        return F.struct(w.alias("w"), ca.alias("ca"), cb.alias("cb"), dot.alias("dot"), na.alias("na"), nb.alias("nb"))

    def closed(s):
        """Sums with the open word's counts added."""
        shared = (s["ca"] > 0) & (s["cb"] > 0)
        weight = F.when(shared, F.lit(1.0)).otherwise(F.lit(SINGLE_IDF * SINGLE_IDF))
        return s["dot"] + s["ca"] * s["cb"], s["na"] + s["ca"] * s["ca"] * weight, s["nb"] + s["cb"] * s["cb"] * weight

    def add(s, x):
        first, second = F.when(x["side"] == 0, F.lit(1.0)).otherwise(zero), F.when(x["side"] == 1, F.lit(1.0)).otherwise(zero)
        dot, na, nb = closed(s)
        return F.when(x["w"] == s["w"], state(s["w"], s["ca"] + first, s["cb"] + second, s["dot"], s["na"], s["nb"])).otherwise(
            state(x["w"], first, second, dot, na, nb)
        )

    def finish(s):
        dot, na, nb = closed(s)
        return F.when((na > 0) & (nb > 0), dot / F.sqrt(na * nb)).otherwise(zero)

    return F.aggregate(merged, state(F.lit(""), zero, zero, zero, zero, zero), add, finish)


def tfidf_pair_cosine(rows: DataFrame, a: str, b: str, stop_words: list[str], name: str = "cosine") -> DataFrame:
    """Add the pair cosine; a blank text scores 0."""
    usable = (F.length(strip(a)) > 0) & (F.length(strip(b)) > 0)
    return rows.withColumn(name, F.when(usable, pair_cosine(a, b, stop_words)).otherwise(F.lit(0.0)))


def answer_relevancy(rows: DataFrame, stop_words: list[str]) -> DataFrame:
    """Answer against question."""
    return tfidf_pair_cosine(rows, "question", "answer", stop_words, "answer_relevancy")


def answer_faithfulness(rows: DataFrame, stop_words: list[str]) -> DataFrame:
    """Answer against its ``contexts`` joined by blanks; no context scores 0."""
    joined = rows.withColumn("_context", F.array_join("contexts", " "))
    return tfidf_pair_cosine(joined, "answer", "_context", stop_words, "answer_faithfulness").drop("_context")


def context_relevance_tfidf(rows: DataFrame, keys: list[str], stop_words: list[str]) -> DataFrame:
    """Mean cosine of ``question`` with each of its ``contexts`` under the TF-IDF of the question and its contexts.

    ``keys`` (a unique key, and whatever else is to be kept) stay in the result. Rows are dealt by key once; the
    four aggregates after that all group by the key and more, so they need no further shuffle.
    """
    dealt = rows.select(*keys, F.concat(F.array("question"), F.col("contexts")).alias("texts")).repartition(*keys)
    texts = dealt.select(*keys, F.size("texts").alias("n"), F.posexplode("texts").alias("place", "text"))
    token = texts.select(*keys, "n", "place", F.explode_outer(content_words("text", stop_words)).alias("w"))
    counted = token.groupBy(*keys, "n", "place", "w").agg(F.count("w").cast("double").alias("c"))
    per_word = counted.groupBy(*keys, "n", "w").agg(
        F.count_if(F.col("c") > 0).alias("df"), F.max(F.when(F.col("place") == 0, F.col("c")).otherwise(F.lit(0.0))).alias("q"),
        F.collect_list(F.struct("place", "c")).alias("texts"),  # at most one entry per text of the question
    )
    idf = F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1
    weighed = per_word.select(*keys, "n", F.inline("texts"), (F.col("q") * idf).alias("qw"), idf.alias("idf"))
    per_text = weighed.groupBy(*keys, "n", "place").agg(
        F.sum(F.col("c") * F.col("idf") * F.col("qw")).alias("dot"), F.sum(F.pow(F.col("c") * F.col("idf"), F.lit(2.0))).alias("norm")
    )
    q_norm = F.max(F.when(F.col("place") == 0, F.col("norm")))
    parts = F.sum(F.when(F.col("place") > 0, F.try_divide(F.col("dot"), F.sqrt("norm"))))
    score = F.try_divide(F.try_divide(parts, F.sqrt(q_norm)), F.col("n") - 1)
    return per_text.groupBy(*keys, "n").agg(F.coalesce(score, F.lit(0.0)).alias("context_relevance")).drop("n")


def rag_scores(rows: DataFrame, keys: list[str], stop_words: list[str]) -> DataFrame:
    """The three scores and their mean (of unrounded values), to four digits."""
    pairs = rows.transform(answer_faithfulness, stop_words).transform(answer_relevancy, stop_words)
    names = ["context_relevance", "answer_faithfulness", "answer_relevancy"]
    scored = context_relevance_tfidf(pairs, [*keys, *names[1:]], stop_words)
    overall = (F.col(names[0]) + F.col(names[1]) + F.col(names[2])) / 3
    return scored.select(*keys, *[F.round(n, 4).alias(n) for n in names], F.round(overall, 4).alias("overall"))
