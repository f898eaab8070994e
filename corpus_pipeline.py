"""From raw documents to a mixed corpus, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next one's
``docs``. All but the last return the columns of documents; the last gives one row per kept document with the number of
words the mix takes from it.

1. language: documents whose text has no letter, or fits no learned language, go.
2. line dedup: lines found in three documents or more stay in the largest document only; ``n_chars`` follows the text.
3. near duplicates: of each group linked by five-word shingles at a similarity of 0.8 or more, the smallest document stays.
4. decontamination: documents that hold a window of ten benchmark words go.
5. mixing: the kept documents are mixed to the target weights of their sources.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.llm import contamination, jaccard, language, lines, mixing
from loomwork.llm.common import documents, held_out
from loomwork.session import fresh_path


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_known(docs, language.fit(docs.where(~held_out(F.col("doc_id")))))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = lines.drop_repeated_lines(docs)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs, width=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return contamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(docs)
    return mixed.select("doc_id", "source", "size", "source_size", "target", mixing.taken_words(F.col("pieces")).alias("taken"))


STAGES = [
    ("language", known_language),
    ("line dedup", line_dedup),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", source_mixing),
]

ORACLE_SQL = None  # language identification and the mix have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for number, (_, stage) in enumerate(STAGES):
        path = fresh_path(spark, f"stage{number + 1}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
