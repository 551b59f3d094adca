"""Exact interpolating percentile whose groups never meet in one task.

Spark's exact ``percentile`` keeps a value histogram of a whole group in one
aggregation buffer.  With a day, or the whole table, as the group that buffer
grows with the data.  Here the histogram stays a distributed table:

1. count rows per (group, value): partial aggregation, hashed on both;
2. sum those counts per (group, value >> 16) and run a cumulative count over the
   coarse slots only, which finds the one or two slots holding the wanted ranks;
3. run the cumulative count over the values of those slots only, at most 65,536
   each, and interpolate between the two neighbours.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_SLOT_BITS = 16


def exact_percentile(
    df: DataFrame, keys: Sequence[str], value: str, fraction: float, output: str
) -> DataFrame:
    """Continuous percentile of an integral column per ``keys``; NULLs ignored.

    Groups without any value give no row.  ``keys`` may be empty for one global
    row (none when the input holds no value at all).
    """
    keys = list(keys)
    if not keys:
        whole = exact_percentile(
            df.select(F.lit(0).alias("__all"), value), ["__all"], value, fraction, output
        )
        return whole.drop("__all")

    histogram = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).cast("long").alias("__v"))
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__slot", F.shiftright("__v", _SLOT_BITS))
    )

    per_key = Window.partitionBy(*keys)
    up_to_here = per_key.orderBy("__slot").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    slots = (
        histogram.groupBy(*keys, "__slot")
        .agg(F.sum("__n").alias("__slot_n"))
        .withColumn("__upto", F.sum("__slot_n").over(up_to_here))
        .withColumn("__total", F.sum("__slot_n").over(per_key))
        .withColumn("__before", F.col("__upto") - F.col("__slot_n"))
        .withColumn("__pos", F.lit(float(fraction)) * (F.col("__total") - 1))
        .withColumn("__lo", F.floor("__pos"))
        .withColumn("__hi", F.ceil("__pos"))
        .where(
            ((F.col("__before") <= F.col("__lo")) & (F.col("__lo") < F.col("__upto")))
            | ((F.col("__before") <= F.col("__hi")) & (F.col("__hi") < F.col("__upto")))
        )
        .select(*keys, "__slot", "__before", "__pos", "__lo", "__hi")
    )

    within_slot = (
        Window.partitionBy(*keys, "__slot")
        .orderBy("__v")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # A null-safe slot: plain equality would push its own null test into one of the two branches only,
    # and the histogram would be computed, and its input read, twice.
    wanted = slots.withColumnRenamed("__slot", "__wanted")
    for k in keys:
        wanted = wanted.withColumnRenamed(k, f"__of_{k}")
    met = F.col("__slot").eqNullSafe(F.col("__wanted"))
    for k in keys:
        met = met & (F.col(k) == F.col(f"__of_{k}"))
    ranked = (
        histogram.join(wanted, met)
        .withColumn("__end", F.col("__before") + F.sum("__n").over(within_slot))
        .withColumn("__start", F.col("__end") - F.col("__n"))
    )
    holds = lambda rank: (F.col("__start") <= F.col(rank)) & (F.col(rank) < F.col("__end"))
    low = F.max(F.when(holds("__lo"), F.col("__v")))
    high = F.max(F.when(holds("__hi"), F.col("__v")))
    weight = F.max(F.col("__pos") - F.col("__lo"))
    return (
        ranked.groupBy(*keys)
        .agg(low.alias("__low"), high.alias("__high"), weight.alias("__w"))
        .select(
            *keys,
            (
                F.col("__low").cast("double")
                + (F.col("__high") - F.col("__low")).cast("double") * F.col("__w")
            ).alias(output),
        )
    )
