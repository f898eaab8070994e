"""Running totals and exact quantiles over tables of any size and skew.

A window without a partition, or over one hot key, would gather its rows in a single task. Here rows are range
partitioned by their order columns, so every task holds a contiguous slice of about equal size; each slice
then only needs the totals of the slices before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomwork.session import cut_lineage


def running_totals(df: DataFrame, order: Sequence[str], totals: dict[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Add inclusive running sums over ``order`` (a unique order), within ``by``.

    The sliced rows are checkpointed: slice numbers come from the shuffle, so they must not be computed twice.
    The carry table has at most one row per slice (only the first group of a slice can have begun before it).
    """
    valued = df.select("*", *[value.alias(f"_v_{name}") for name, value in totals.items()])
    sliced = cut_lineage(valued.repartitionByRange(*by, *order).withColumn("_slice", F.spark_partition_id()))
    keys = ["_slice", *by]
    per_slice = sliced.groupBy(*keys).agg(*[F.sum(f"_v_{name}").alias(f"_c_{name}") for name in totals])
    before = W.partitionBy(*by).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    carry = per_slice.select(*keys, F.count("*").over(before).alias("_earlier"),
                             *[F.sum(f"_c_{name}").over(before).alias(f"_c_{name}") for name in totals])
    carry = carry.filter("_earlier > 0").drop("_earlier")
    inside = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    local = sliced.select("*", *[F.sum(f"_v_{name}").over(inside).alias(f"_l_{name}") for name in totals])
    joined = local.join(F.broadcast(carry), keys, "left")
    return joined.select(*df.columns, *[
        (F.col(f"_l_{name}") + F.coalesce(F.col(f"_c_{name}"), F.lit(0))).alias(name) for name in totals
    ])


def exact_quantiles(df: DataFrame, column: str, points: Sequence[float], by: Sequence[str] = (),
                    weight: str | None = None) -> DataFrame:
    """Linear-interpolated quantiles ``(by…, q, value)`` without gathering a group's values in one place.

    Equal values are counted first; a value covers the ranks between two running counts, so the one or two rows
    each quantile needs are picked by rank. ``weight`` names a column of counts where rows are already counted.
    """
    counted = df.filter(F.col(column).isNotNull()).groupBy(*by, F.col(column).cast("double").alias("_x")).agg(
        (F.sum(weight) if weight else F.count("*")).alias("_n")
    )
    ranked = running_totals(counted, ["_x"], {"_upto": F.col("_n")}, by)
    sizes = counted.groupBy(*by).agg(F.sum("_n").alias("_total"))
    wanted = sizes.select(*by, "_total", F.explode(F.array(*[F.lit(float(q)) for q in points])).alias("q")).select(
        *by, "q", (F.col("q") * (F.col("_total") - 1)).alias("_pos")
    )
    # the ranks looked for, a few per group, against the row whose rank interval holds them
    ends = wanted.select(*by, "q", "_pos", F.explode(F.array(F.floor("_pos"), F.ceil("_pos"))).alias("_rank")).distinct()
    spans = ranked.select(*by, "_x", (F.col("_upto") - F.col("_n")).alias("_from"), "_upto")
    hit = (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_upto"))
    ranks = ends.groupBy(*by).agg(F.collect_set(F.struct("q", "_pos", "_rank")).alias("_ends"))
    if by:
        paired = spans.join(ranks, list(by))
    else:
        paired = spans.withColumn("_ends", ranks.select("_ends").scalar())
    found = paired.select(*by, "_x", "_from", "_upto", F.inline("_ends")).filter(hit)
    share = F.col("_pos") - F.floor("_pos")
    low = F.max(F.when(F.col("_rank") == F.floor("_pos"), F.col("_x")))
    high = F.max(F.when(F.col("_rank") == F.ceil("_pos"), F.col("_x")))
    return found.groupBy(*by, "q", "_pos").agg(low.alias("_low"), high.alias("_high")).select(
        *by, "q", (F.col("_low") + (F.col("_high") - F.col("_low")) * share).alias("value")
    )


def trailing_sums(events: DataFrame, time: str, ident: str, value: str, span: float, by: Sequence[str] = (),
                  digits: int = 6) -> DataFrame:
    """Count and sum of earlier rows at most ``span`` back: rows in [t − span, self) in (time, id) order.

    Each row also sends a probe at t − span into the same ordered stream. The rows between probe and row are the
    difference of two running totals, so a busy hour or a busy key costs no more than any other rows. Every row has a
    number of its own, so rows with equal ids stay apart (their order among each other is arbitrary); only numbers and
    values travel, and the record comes back by one join. Values are summed exactly, to ``digits`` decimals (at most 10),
    as whole numbers of the last digit, since sums of wide decimals would give up digits behind the point.
    """
    if not 0 <= digits <= 10:
        raise ValueError("digits must be between 0 and 10")
    exact, unit = "decimal(38,0)", F.lit(10**digits).cast(f"decimal({digits + 1},0)")
    numbered = cut_lineage(events.withColumn("_key", F.monotonically_increasing_id()))
    zero = F.lit(0).cast(exact)

    def entry(kind: int, at: Column, n: int, amount: Column) -> Column:
        return F.struct(at.alias("_t"), F.lit(kind).alias("_kind"), F.lit(n).alias("_n"), amount.alias("_v"))

    both = F.array(entry(1, F.col(time), 1, F.coalesce((F.col(value).cast(f"decimal(26,{digits})") * unit).cast(exact), zero)), entry(0, F.col(time) - span, 0, zero))
    stream = numbered.select(*by, "_key", F.col(ident).alias("_id"), F.inline(both))
    summed = running_totals(stream, ["_t", "_kind", "_id", "_key"], {"_count": F.col("_n"), "_sum": F.col("_v")}, by)
    sign = F.when(F.col("_kind") == 1, F.lit(1)).otherwise(F.lit(-1))
    merged = summed.groupBy("_key").agg(
        F.sum(sign * (F.col("_count") - F.col("_n"))).alias("trailing_count"),
        (F.sum(sign * (F.col("_sum") - F.col("_v"))).cast("double") / float(10**digits)).alias("trailing_sum"),
    )
    return numbered.join(merged, "_key").drop("_key")
