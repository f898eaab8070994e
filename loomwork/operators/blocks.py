"""Work on every pair of keys without pairing rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def by_block_pair(df: DataFrame, key: str, block: int) -> DataFrame:
    """Hand each pair of key blocks the rows it needs: adds ``_own``, ``bi`` ≤ ``bj``.

    Keys are hashed into blocks of about ``block``; a row is sent once per block and never joined with other rows.
    A group (bi, bj) then holds the rows of two blocks, whatever the number of keys.
    """
    n_blocks = df.agg(F.ceil(F.count_distinct(key) / F.lit(block)).cast("int")).scalar()
    placed = df.withColumn("_n", n_blocks).withColumn("_own", F.pmod(F.xxhash64(key), F.col("_n")).cast("int"))
    sent = placed.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    return sent.withColumns({"bi": F.least("_own", "_other"), "bj": F.greatest("_own", "_other")}).drop("_n", "_other")
