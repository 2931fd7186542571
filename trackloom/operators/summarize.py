"""Per-track statistics, the summary table of tracks with one event, and quality relations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackloom.operators import events
from trackloom.params import CHANNELS

TRACK = events.TRACK


def _stats(value: Column, fallback: float) -> tuple[Column, Column]:
    """(mean, population deviation) of the rows in mitosis; if the whole trace is zero, (fallback, 0). A missing value
    counts as non-zero for that test and is left out of the statistics."""
    zero = F.max((value.isNull() | (value != 0)).cast("int")) == 0
    inside = F.when(F.col("semantic_smoothed") != 0, value)
    return F.when(zero, F.lit(fallback)).otherwise(F.avg(inside)), F.when(zero, F.lit(0.0)).otherwise(F.stddev_pop(inside))


def channels_of(rows: DataFrame) -> list[str]:
    return [c for c in CHANNELS if c in rows.columns]


def channel_stats(rows: DataFrame) -> list[Column]:
    """Aggregates of a track for each measured channel: signal, background and illumination factor, area, each with its
    deviation."""
    out = []
    for c in channels_of(rows):
        for source, name, std, fallback in (
            (c, c, f"{c}_std", 0.0), (f"{c}_bkg_corr", f"{c}_bkg_corr", f"{c}_bkg_corr_std", 0.0),
            (f"{c}_int_corr", f"{c}_int_corr", f"{c}_int_corr_std", 1.0), ("area", f"{c}_area_mean", f"{c}_area_std", 1.0),
        ):
            mean, deviation = _stats(F.nullif(F.col(f"`{source}`").cast("double"), F.lit(float("nan"))), fallback)
            out += [mean.alias(name), deviation.alias(std)]
    return out


def _stats_of(rows: DataFrame) -> list[Column]:
    return [
        F.count("*").alias("track_length"), F.max("displacement").alias("max_displacement"), F.avg("area").alias("cell_area"),
        F.stddev_samp("area").alias("area_std"), *channel_stats(rows),
    ]


def track_stats(rows: DataFrame) -> DataFrame:
    """A row per mitotic track: length, mean and deviation of its area, largest step, channel statistics."""
    return events.displacement(rows.filter("mitotic = 1")).groupBy(*TRACK).agg(*_stats_of(rows))


def summary(rows: DataFrame, min_width: int = 3) -> DataFrame:
    """A row per mitotic track with exactly one event, columns in the order that summary files have. Events and statistics
    come from one aggregation over the tracks."""
    found = events.with_runs(events.displacement(rows.filter("mitotic = 1")), min_width)
    at_event = lambda v: F.max(F.when(F.col("counted"), v))
    single = found.groupBy(*TRACK).agg(
        F.count(F.when(F.col("counted"), 1)).alias("n"), at_event(F.col("pos") - 1).alias("mito_start"),
        at_event(F.col("width").cast("double")).alias("mitosis"), *_stats_of(rows),
    ).filter("n = 1")
    first = [*TRACK, "track_length", "max_displacement", "mito_start", "cell_area", "mitosis"]
    return single.select(*first, *[F.col(f"`{n}`") for n in single.columns if n not in (*first, "n", "area_std")])


def quality(rows: DataFrame, min_width: int = 3) -> tuple[DataFrame, DataFrame]:
    """(histogram of events per track, `Area std.` of each mitotic track)."""
    return events.peak_histogram(events.peaks_per_track(rows, min_width)), track_stats(rows).select(*TRACK, F.col("area_std").alias("Area std."))


def quality_sheet(histogram: DataFrame, area_std: DataFrame) -> DataFrame:
    """Each movie's sheet, a left join by row number: the histogram is cut to as many rows as there are tracks, and the
    tracks beyond it have none. `row` numbers a movie's tracks."""
    numbered = area_std.withColumn("row", (F.row_number().over(Window.partitionBy("movie_id").orderBy("particle")) - 1).cast("long"))
    bins = histogram.withColumnRenamed("movie_id", "of_movie")
    joined = numbered.join(bins, (F.col("movie_id") == F.col("of_movie")) & (F.col("row") == F.col("n_peaks")), "left")
    return joined.select("movie_id", "row", F.col("`Area std.`"), "n_peaks", F.col("`track number`"))
