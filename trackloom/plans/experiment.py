"""From planes to tracks, measurements and summaries: the whole analysis as relations over many movies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom import params
from trackloom.functions.names import canonical_channel
from trackloom.operators import images, linking, measure, regions, smoothing, summarize
from trackloom.params import CellParams
from trackloom.sources import sheets


def regions_with_state(labels: DataFrame, states: DataFrame) -> DataFrame:
    """The region table with the state at each region's centre. Regions come from the labels as they are; erosion is for
    measuring alone."""
    return regions.state_at_centre(regions.region_table(labels), states)


def track(
    labels: DataFrame, states: DataFrame, p: CellParams, mode: str | None = None, radius: float | None = None,
    memory: int | None = None, scope: str = "global",
) -> DataFrame:
    """Label and state planes -> tracks."""
    return track_regions(regions_with_state(labels, states), p, mode, radius, memory, scope)


def track_regions(
    found: DataFrame, p: CellParams, mode: str | None = None, radius: float | None = None, memory: int | None = None,
    scope: str = "global",
) -> DataFrame:
    """Regions with states -> tracks: regions of fit size are linked, short tracks go, states are smoothed."""
    fit = regions.area_filter(found, p.min_cell_size, p.max_cell_size)
    linked = linking.link(fit, linking.options(p, mode, radius, memory)).filter("particle is not null").drop("link_error")
    return smoothing.smooth(linking.stub_filter(linked, p.min_track_length), scope, p.min_track_length)


def measure_channel(
    tracks: DataFrame, labels: DataFrame, channel: DataFrame, name: str, p: CellParams, background: DataFrame | None = None,
    intensity: DataFrame | None = None, ids: int | list[int] | DataFrame | None = None,
) -> DataFrame:
    """tracks with the channel's signal and factors under eroded masks, for mitotic tracks or the given ones."""
    rows = measure.chosen(tracks, ids).select("movie_id", "frame", "label").distinct()
    wanted = labels.join(rows.select("movie_id", "frame").distinct(), images.PLANE, "left_semi")
    found = measure.signals(images.eroded(wanted, p.erosion_radius), channel, background, intensity)
    return measure.with_channel(tracks, found.join(rows, [*images.PLANE, "label"], "left_semi"), canonical_channel(name))


def correction_maps(backgrounds: DataFrame, intensities: DataFrame, p: CellParams) -> tuple[DataFrame, DataFrame]:
    """(background planes, one intensity plane per movie) from raw stacks."""
    return images.medianed(backgrounds), images.intensity_map(intensities, p.gaussian_sigma)


def summary(tracks: DataFrame, p: CellParams) -> DataFrame:
    return summarize.summary(tracks, p.min_mitotic_frames)


def display_frames(tracks: DataFrame) -> DataFrame:
    """What a viewer needs of tracks: particle, frame, x, y, ordered."""
    return tracks.select(
        "movie_id", "particle", "frame", "x", "y", F.col("semantic_smoothed").alias("state"),
    ).orderBy("movie_id", "particle", "frame")


def save_tracks(tracks: DataFrame, folder: str) -> None:
    """`<movie_id>_tracks.xlsx` for each movie; Parquet is for anything larger than a sheet."""
    sheets.write_workbooks(folder, {"cell_data": _file(tracks, "tracks")}, {"cell_data": ["particle", "frame"]})


def save_analysis(tracks: DataFrame, files: DataFrame, p: CellParams, folder: str) -> None:
    """`<movie_id>_analysis.xlsx` for each movie: measured tracks with the files (a row for each movie_id) and parameters
    they come from."""
    parts = {"cell_data": tracks, "file_data": key_values(files), "parameters": parameters(files, p)}
    sheets.write_workbooks(folder, {k: _file(v, "analysis") for k, v in parts.items()}, {"cell_data": ["particle", "frame"], "parameters": ["name"]})


def save_summary(tracks: DataFrame, files: DataFrame, p: CellParams, folder: str) -> None:
    """`<movie_id>_summary.xlsx` for each movie: summary, files, parameters, and the quality sheet (areas' deviation
    beside the histogram of events)."""
    quality = summarize.quality_sheet(*summarize.quality(tracks, p.min_mitotic_frames))
    parts = {"Summary": summary(tracks, p), "file_data": key_values(files), "parameters": parameters(files, p), "quality": quality}
    sheets.write_workbooks(
        folder, {k: _file(v, "summary") for k, v in parts.items()},
        {"Summary": ["particle"], "parameters": ["name"], "quality": ["row"]},
    )


def _file(rows: DataFrame, kind: str) -> DataFrame:
    """rows with the workbook's name in place of the movie; the place of a row in its sheet is not a column."""
    return rows.withColumn("file", F.concat(F.col("movie_id").cast("string"), F.lit(f"_{kind}.xlsx"))).drop("movie_id")


def parameters(files: DataFrame, p: CellParams) -> DataFrame:
    """movie_id, name, value: the parameters once for each movie."""
    return files.select("movie_id").distinct().join(F.broadcast(params.key_values(files.sparkSession, p)))  # some dozen rows


def key_values(row: DataFrame) -> DataFrame:
    """Rows of movie_id and other columns as (movie_id, name, value) rows, one for each other column."""
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").cast("string").alias("value")) for c in row.columns if c != "movie_id"])
    return row.select("movie_id", F.inline(pairs))
