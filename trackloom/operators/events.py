"""Mitotic events: runs of the smoothed state, steps, and counts per track.

On a 0/1 trace closed by zeros, a peak is a run of ones that does not begin at the track's first row; its width is its
length, and its left base the row before it. Runs that touch the track's last row count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TRACK = ["movie_id", "particle"]


def with_position(rows: DataFrame) -> DataFrame:
    """pos: the row's number in its track, from 0."""
    return rows.withColumn("pos", (F.row_number().over(Window.partitionBy(*TRACK).orderBy("frame")) - 1).cast("long"))


def with_runs(rows: DataFrame, min_width: int = 3) -> DataFrame:
    """Adds pos, width (rows of the run) and counted: true at the first row of each run that counts. All windows are
    within tracks, so one partitioning serves them."""
    placed = with_position(rows)
    same = Window.partitionBy(*TRACK, "semantic_smoothed").orderBy("frame")
    placed = placed.withColumn("island", F.col("pos") - F.row_number().over(same))
    placed = placed.withColumn("width", F.count("*").over(Window.partitionBy(*TRACK, "semantic_smoothed", "island")))
    before = F.lag("semantic_smoothed").over(Window.partitionBy(*TRACK).orderBy("frame"))
    return placed.withColumn(
        "counted", F.coalesce((F.col("semantic_smoothed") > 0) & (before == 0), F.lit(False)) & (F.col("width") >= min_width),
    ).drop("island")


def runs(rows: DataFrame, min_width: int = 3) -> DataFrame:
    """movie_id, particle, mito_start, mitosis: a row per counted run of mitotic tracks."""
    found = with_runs(rows.filter("mitotic = 1").select(*TRACK, "frame", "semantic_smoothed"), min_width).filter("counted")
    return found.select(*TRACK, (F.col("pos") - 1).alias("mito_start"), F.col("width").cast("double").alias("mitosis"))


def peaks_per_track(rows: DataFrame, min_width: int = 3) -> DataFrame:
    """n_peaks of every mitotic track, 0 included."""
    found = with_runs(rows.filter("mitotic = 1").select(*TRACK, "frame", "semantic_smoothed"), min_width)
    return found.groupBy(*TRACK).agg(F.count(F.when(F.col("counted"), 1)).alias("n_peaks"))


def peak_histogram(peaks: DataFrame, bins: int = 14) -> DataFrame:
    """movie_id, n_peaks 0..13 and `track number` of each movie; the last bin is closed, so 14 falls into it, and more
    than 14 are left out. One aggregation: a count per bin, then a row per count."""
    n = F.when(F.col("n_peaks") <= bins, F.least("n_peaks", F.lit(bins - 1)))
    counts = peaks.groupBy("movie_id").agg(*[F.count(F.when(n == i, 1)).alias(f"n{i}") for i in range(bins)])
    rows = F.array(*[F.struct(F.lit(i).cast("long").alias("n_peaks"), F.col(f"n{i}").alias("track number")) for i in range(bins)])
    return counts.select("movie_id", F.inline(rows))


def displacement(rows: DataFrame) -> DataFrame:
    """Adds displacement: the step from the track's row before, null for its first; gaps in frames don't matter."""
    w = Window.partitionBy(*TRACK).orderBy("frame")
    dx, dy = (F.col(c) - F.lag(c).over(w) for c in ("x", "y"))
    return rows.withColumn("displacement", F.sqrt(dx * dx + dy * dy))
