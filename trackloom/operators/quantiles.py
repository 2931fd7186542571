"""Exact percentiles without gathering a column in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rank error of the bracket as a share of a group's rows.
ERROR = 1e-4
#: Parts that a group's values are dealt to where they meet the group's row.
PARTS = 32


def met(values: DataFrame, by: list[str], column: str, groups: DataFrame) -> DataFrame:
    """values, each with its group's row. One group may hold most values, so they are dealt by their hash to parts, and the
    group's row goes to each part. Equal values stay together: count them before. Without `by` there is one row for all."""
    if not by:
        return values.join(F.broadcast(groups))
    dealt = values.withColumn("part__", F.pmod(F.xxhash64(column), F.lit(PARTS)))
    parts = F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1)).cast("array<long>"))
    return dealt.join(groups.withColumn("part__", parts), [*by, "part__"]).drop("part__")


def percentiles(rows: DataFrame, by: list[str], column: str, fractions: tuple[float, ...], error: float = ERROR) -> DataFrame:
    """by, q: array of the exact percentiles of `column` at the fractions, by linear interpolation between ranks.

    Two passes over the rows. Sketches bracket each percentile between two values that lie a few errors of rank around it.
    Then, with groups, equal values are one row with their number, which meets its group's bounds in parts. For each
    fraction, the values below its bracket are one row with their number, and of those inside, a share of some errors, equal
    values are one; running counts of these give the ranks. Groups of fewer than 10 / error rows are their own bracket. Nulls
    don't count; groups without values are left out, so an empty table gives an empty result."""
    v = F.col(column).cast("double")
    values = rows.select(*by, v.alias("v__")).filter("v__ is not null")
    accuracy, v = int(2 / error), F.col("v__")
    at = lambda shift: F.array(*[F.lit(min(1.0, max(0.0, f + shift))) for f in fractions])
    bounds = values.groupBy(*by).agg(
        F.count("*").alias("n__"), F.percentile_approx(v, at(-2 * error), accuracy).alias("low__"),
        F.percentile_approx(v, at(2 * error), accuracy).alias("high__"),
    )
    small = F.col("n__") < 10 / error
    edge = lambda name, all_: F.transform(name, lambda x: F.when(small, F.lit(all_)).otherwise(x)).alias(name)
    bounds = bounds.filter("n__ > 0").select(*by, "n__", edge("low__", float("-inf")), edge("high__", float("inf")))
    counts = values.groupBy(*by, "v__").agg(F.count("*").alias("m__")) if by else values.withColumn("m__", F.lit(1))
    bracketed = met(counts, by, "v__", bounds)
    # A null value stands for all rows below the bracket.
    place = lambda k: F.struct(F.lit(k).alias("k__"), F.when(v >= F.col("low__")[k], v).alias("w__"), (v <= F.col("high__")[k]).alias("in__"))
    placed = bracketed.select(*by, "n__", "m__", F.inline(F.array(*map(place, range(len(fractions)))))).filter("in__")
    counted = placed.groupBy(*by, "k__", "w__").agg(F.sum("m__").alias("c__"), F.first("n__").alias("n__"))
    counted = counted.withColumn("end__", F.sum("c__").over(Window.partitionBy(*by, "k__").orderBy(F.col("w__").asc_nulls_first())))
    rank = F.element_at(F.array(*map(F.lit, map(float, fractions))), F.col("k__") + 1) * (F.col("n__") - 1)
    value = lambda r: F.max(F.when((r >= F.col("end__") - F.col("c__")) & (r < F.col("end__")), F.col("w__")))
    found = counted.withColumn("rank__", rank).groupBy(*by, "k__").agg(
        F.first("rank__").alias("rank__"), value(F.floor("rank__")).alias("a__"), value(F.ceil("rank__")).alias("b__"),
    )
    q = F.col("a__") + (F.col("b__") - F.col("a__")) * (F.col("rank__") - F.floor("rank__"))
    return found.groupBy(*by).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("k__", q.alias("q")))), lambda x: x["q"]).alias("q")
    ).filter("size(q) > 0")
