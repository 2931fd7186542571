"""Binned dose response: quantile-bounded bins, their means and errors, and the Hill fit."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.functions import hill
from trackloom.operators.quantiles import met, percentiles

QUANTILES = (0.025, 0.85)
BIN_SIZE = 2.5


def complete(xy: DataFrame) -> DataFrame:
    """The first two columns as dose and response, rows with a missing value left out; the input stays as it is."""
    dose, response = (F.nullif(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))) for c in xy.columns[:2])
    return xy.select(dose.alias("dose"), response.alias("response"), *[F.col(f"`{c}`") for c in xy.columns[2:]]).dropna("any")


def rounded_quantiles(xy: DataFrame, fractions: tuple[float, ...] = QUANTILES) -> DataFrame:
    """q: doses at the fractions, by linear interpolation, rounded half to even; one row, or none without doses."""
    return percentiles(xy, [], "dose", fractions).select(F.transform("q", lambda q: F.bround(q, 0)).alias("q"))


def quantiles(xy: DataFrame, fractions: tuple[float, ...] = QUANTILES) -> tuple[float, ...]:
    row = rounded_quantiles(xy, fractions).first()
    return tuple(row["q"]) if row else ()


def edges(low: float, high: float, size: float = BIN_SIZE) -> list[float]:
    """From half the low quantile by `size`, as far as it stays under one and a half times the high one."""
    begin = 0.5 * low
    return [begin + i * size for i in range(max(0, math.ceil((1.5 * high - begin) / size)))]


def with_bin(xy: DataFrame, low: float, high: float, size: float = BIN_SIZE) -> DataFrame:
    """Adds bin (from 0; null outside): left < dose <= right. The bin follows from arithmetic, not from a range join."""
    found = edges(low, high, size)
    if len(found) < 2:
        return xy.withColumn("bin", F.lit(None).cast("long"))
    left = lambda b: F.lit(found[0]) + b * F.lit(size)
    near = F.ceil((F.col("dose") - found[0]) / size) - 1
    exact = F.when(F.col("dose") <= left(near), near - 1).when(F.col("dose") > left(near + 1), near + 1).otherwise(near)
    return xy.withColumn("bin", F.when((exact >= 0) & (exact < len(found) - 1), exact).cast("long"))


def bounds(bin_: Column, low: float, size: float = BIN_SIZE) -> tuple[Column, Column]:
    left = F.lit(0.5 * low) + bin_ * F.lit(size)
    return left, left + F.lit(size)


def bin_means(binned: DataFrame) -> DataFrame:
    """bin, dose, response of bins with rows."""
    return binned.filter("bin is not null").groupBy("bin").agg(F.avg("dose").alias("dose"), F.avg("response").alias("response"))


def bin_sizes(binned: DataFrame, n_bins: int) -> DataFrame:
    """bin, n of every bin, empty ones included."""
    counts = binned.filter("bin is not null").groupBy("bin").agg(F.count("*").alias("n"))
    return binned.sparkSession.range(n_bins).toDF("bin").join(F.broadcast(counts), "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


def bin_stderrs(binned: DataFrame) -> DataFrame:
    """bin and the standard errors of both columns; bins of one row are left out."""
    n = F.count("*")
    return binned.filter("bin is not null").groupBy("bin").agg(
        (F.stddev_samp("dose") / F.sqrt(n)).alias("dose"), (F.stddev_samp("response") / F.sqrt(n)).alias("response"),
        n.alias("n"),
    ).filter("n > 1").drop("n")


def subtract_minimum(xy: DataFrame, column: str) -> DataFrame:
    least = xy.agg(F.min(column).alias("least__"))
    return xy.join(F.broadcast(least)).withColumn(column, F.col(column) - F.col("least__")).drop("least__")


def fit(xy: DataFrame, by: list[str], fractions: tuple[float, ...] = QUANTILES, size: float = BIN_SIZE) -> DataFrame:
    """A row per group: the four parameters and a status. Rows are summed up by dose, binned and averaged by Spark; a task
    fits the means of one group, some dozens. The bins' bounds are each group's own quantiles."""
    q = percentiles(xy, by, "dose", fractions)
    q = q.select(*by, F.bround(F.col("q")[0], 0).alias("low"), F.bround(F.element_at("q", -1), 0).alias("high"))
    doses = xy.groupBy(*by, "dose").agg(F.count("*").alias("n__"), F.sum("response").alias("total__"))
    joined = met(doses, by, "dose", q)
    begin = F.col("low") * 0.5
    n_edges = F.greatest(F.ceil((F.col("high") * 1.5 - begin) / size), F.lit(0))
    near = F.ceil((F.col("dose") - begin) / size) - 1
    exact = F.when(F.col("dose") <= begin + near * size, near - 1).when(F.col("dose") > begin + (near + 1) * size, near + 1).otherwise(near)
    binned = joined.withColumn("bin", exact).filter((F.col("bin") >= 0) & (F.col("bin") < n_edges - 1))
    n = F.sum("n__")
    means = binned.groupBy(*by, "bin").agg(
        (F.sum(F.col("dose") * F.col("n__")) / n).alias("dose"), (F.sum("total__") / n).alias("response"), F.first("low").alias("low"),
        F.first("high").alias("high"),
    )
    kinds = dict(xy.dtypes)

    def one(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("bin")
        x, y = group["dose"].to_numpy(float), group["response"].to_numpy(float)
        start = np.array([y.min(), y.max(), 5.0, (group["low"].iloc[0] + group["high"].iloc[0]) / 4])
        p, status = hill.fit(x, y, start)
        return pd.DataFrame({**{k: [group[k].iloc[0]] for k in by}, **dict(zip(hill.PARAMETERS, [[float(v)] for v in p])), "status": [status]})

    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in by), *(f"{n} double" for n in hill.PARAMETERS), "status string"])
    return means.groupBy(*by).applyInPandas(one, schema)


def plot_limit(xy: DataFrame, fraction: float = 0.99) -> DataFrame:
    """y_limit: the response's percentile that a plot's axis ends at, rounded half to even."""
    return percentiles(xy, [], "response", (fraction,)).select(F.bround(F.col("q")[0], 0).alias("y_limit"))


def fitted_curve(fits: DataFrame, upper: float, by: list[str]) -> DataFrame:
    """x = 0, 1, ... under `upper` and the fitted curve there, for plots."""
    x = F.explode(F.sequence(F.lit(0), F.lit(max(0, math.ceil(upper) - 1))))
    return fits.select("*", x.alias("x")).withColumn("x", F.col("x").cast("double")).withColumn(
        "y", hill.hill(F.col("x"), *map(F.col, hill.PARAMETERS)),
    ).select(*by, "x", "y")
