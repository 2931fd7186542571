"""A run from a root folder: movies are found by file names, tracked and measured, saved beside their masks, and the
saved summaries become one experiment table."""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom import params, schemas
from trackloom.operators import images, measure, wells
from trackloom.params import CHANNELS, CellParams
from trackloom.plans import experiment, stacks
from trackloom.sources import discovery, sheets, tiff
from trackloom.sources.tables import kept

Reader = Callable[[SparkSession, str, str], DataFrame]


@dataclass
class Run:
    """movies: movie_id (the path of the masks' folder with prefix and stub), stub, prefix, instance, semantic, home (the
    folder of the masks), data_dir (that of the images); tracks: all movies' rows with the measured channels, kept."""

    movies: DataFrame
    tracks: DataFrame
    p: CellParams

    def save(self, root: str) -> None:
        """Tracks, analysis and summary workbooks of every movie, in the folder of its masks."""
        files = self.movies.select("movie_id", "instance", "semantic")
        experiment.save_tracks(self.tracks, root)
        experiment.save_analysis(self.tracks, files, self.p, root)
        experiment.save_summary(self.tracks, files, self.p, root)


def analyse(
    spark: SparkSession, root: str, cell_type: str = "hela", mode: str | None = None, radius: float | None = None,
    memory: int | None = None, channels: tuple[str, ...] = CHANNELS, read: Reader | None = None,
) -> Run:
    """Every movie below root: an _inference folder with instance and semantic masks, channel images of the same stub in the
    folder above it, and the correction maps that apply to all movies. Channels without images are not measured; of those
    that have some, only planes that hold a mitotic track are read.

    Tasks open files at the offsets of the planes they need (`files.opened`). For a store that only Spark's readers open,
    `read` reads whole stacks (`tiff.read_stacks`)."""
    p = params.for_cell_type(cell_type)
    found = discovery.files(spark, root)
    movies = discovery.movies(found).persist()
    if read is None:
        regions = stacks.regions_with_state(movies)
    else:
        labels, states = (_planes(read, spark, root, f"*{role}*.tif", movies.select("movie_id", F.col(role).alias("path"))) for role in ("instance", "semantic"))
        regions = experiment.regions_with_state(labels, states)
    tracks = kept(experiment.track_regions(kept(regions), p, mode, radius, memory))
    images_of = discovery.channels(found, movies).persist()
    maps = {r["correction_map"]: r["path"] for r in discovery.correction_maps(found).collect()}  # two a channel at most
    wanted = measure.chosen(tracks).select("movie_id", "frame", "label").distinct().persist()
    for channel in channels:
        files = images_of.filter(F.col("channel") == channel).select("movie_id", "path")
        if files.isEmpty():
            continue
        of_channel = {k: maps.get(f"{channel}_{k}_map") for k in ("background", "intensity")}
        if read is None:
            measured = _signals(spark, movies, files, p, wanted, of_channel)
        else:
            background, intensity = (read(spark, path, "*").drop("path") if path else None for path in of_channel.values())
            intensity = intensity.drop("frame") if intensity is not None else None
            measured = measure.signals(images.eroded(labels, p.erosion_radius), _planes(read, spark, root, f"*{channel}*.{{tif,tiff}}", files), background, intensity)
        tracks = measure.with_channel(tracks, measured.join(wanted, ["movie_id", "frame", "label"], "left_semi"), channel)
    return Run(movies, kept(tracks), p)


def _planes(read: Reader, spark: SparkSession, root: str, pattern: str, files: DataFrame) -> DataFrame:
    return read(spark, root, pattern).join(files, "path").drop("path")


def _signals(spark: SparkSession, movies: DataFrame, files: DataFrame, p: CellParams, wanted: DataFrame, maps: dict[str, str | None]) -> DataFrame:
    """Signals of the wanted regions' planes, by offsets. A map is one file for all movies: its planes' places are few."""
    places = {k: tiff.plane_index(spark.createDataFrame([(path,)], "path string")) if path else None for k, path in maps.items()}
    background = places["background"]
    if background is not None:
        background = background.select("frame", F.col("path").alias("background_path"), F.col("offset").alias("background_offset"))
    intensity = places["intensity"].orderBy("frame").first() if places["intensity"] is not None else None
    labels = stacks.index(movies.select("movie_id", F.col("instance").alias("path")), "labels")
    plane = (intensity["path"], intensity["offset"]) if intensity is not None else None
    return stacks.signals(labels, stacks.index(files, "channel"), p, wanted, background, plane)


def create_correction_maps(spark: SparkSession, sources: dict[str, str], p: CellParams) -> list[str]:
    """Makes a map of each stack and keeps it beside it, where `analyse` finds it: `<stem>_intensity_map.tif` if the key
    holds "intensity", `<stem>_background_map.tif` if it holds "background". Other keys are errors."""
    kept = []
    for key, path in sources.items():
        kind = next((k for k in ("intensity", "background") if k in key), None)
        if kind is None:
            raise ValueError(f"{key!r} names neither an intensity nor a background map")
        folder, stem = os.path.dirname(path), os.path.splitext(os.path.basename(path))[0]
        file = spark.createDataFrame([(stem, path)], "movie_id string, path string")
        planes = tiff.read_planes(stacks.spread(tiff.plane_index(file)))
        made = images.intensity_map(planes, p.gaussian_sigma).withColumn("frame", F.lit(0)) if kind == "intensity" else images.medianed(planes)
        file = f"{stem}_{kind}_map.tif"
        tiff.write_stacks(made.withColumn("file", F.lit(file)), folder, "float16" if kind == "intensity" else "int16")
        kept.append(os.path.join(folder, file))
    return kept


def experiment_table(
    spark: SparkSession, root: str, wellmap: DataFrame, expt_length: int, delta_t: float, order: str,
    channels: tuple[str, ...] = CHANNELS,
) -> DataFrame:
    """The filtered rows of all saved summaries below root, with well, position, storage_location and the code of each
    group of the well map that has the well. order: the column that numbers the well map's rows."""
    more = ", ".join(
        f"`{c}{s}` double" for c in channels for s in (
            "", "_std", "_bkg_corr", "_bkg_corr_std", "_int_corr", "_int_corr_std", "_area_mean", "_area_std",
        )
    )
    groups = wells.wellmap(wellmap, order)
    rows = sheets.read_workbooks(spark, root, f"{schemas.SUMMARY}, {more}")
    compiled = wells.compile_summaries(rows, groups.select(F.explode("wells").alias("well")), root)
    return wells.import_experiment(groups, compiled, expt_length, delta_t)
