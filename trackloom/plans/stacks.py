"""Planes met where they are read: indexes of the stacks' planes (`tiff.plane_index`) are joined by movie and frame, dealt to
tasks, and a task reads the planes of a row together. What is shuffled is a row of paths and offsets per plane; pixels stay
in the task that reads them, in the type the file has."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.operators import images, measure, regions
from trackloom.operators.images import PLANE
from trackloom.params import CellParams
from trackloom.sources import tiff

#: Frames of one movie that a task reads one after another.
FRAMES_PER_TASK = 16


def index(files: DataFrame, name: str) -> DataFrame:
    """movie_id, frame, and where each plane of the files (movie_id, path) is, as `<name>_path` and `<name>_offset`."""
    found = tiff.plane_index(files.select("movie_id", "path"))
    return found.select(*PLANE, F.col("path").alias(f"{name}_path"), F.col("offset").alias(f"{name}_offset"))


def dealt(rows: DataFrame, planes: int) -> DataFrame:
    """Rows by movie and runs of frames, FRAMES_PER_TASK planes a task of `planes` in all; the number is given, as the rows'
    bytes say nothing of the work."""
    tasks = max(1, -(-planes // FRAMES_PER_TASK))
    return rows.repartition(tasks, "movie_id", F.floor(F.col("frame") / FRAMES_PER_TASK)).sortWithinPartitions(*PLANE)


def spread(index: DataFrame) -> DataFrame:
    """A `plane_index`, dealt."""
    index = index.persist()
    return dealt(index, index.count())


def _two(b: pa.RecordBatch, i: int, name: str) -> tuple[str | None, int | None]:
    return b.column(f"{name}_path")[i].as_py(), b.column(f"{name}_offset")[i].as_py()


class _Stacks:
    """A reader for each stack, so that none has to change files with every plane; the last plane is kept."""

    def __init__(self, *names: str):
        self.readers = {n: tiff.PlaneReader() for n in names}
        self.last: dict[str, tuple] = {}

    def plane(self, b: pa.RecordBatch, i: int, name: str) -> np.ndarray | None:
        at = _two(b, i, name)
        if at[0] is None:
            return None
        if self.last.get(name, (None,))[0] != at:
            self.last[name] = at, self.readers[name].plane(*at)
        return self.last[name][1]

    def __enter__(self) -> _Stacks:
        return self

    def __exit__(self, *_) -> None:
        for r in self.readers.values():
            r.close()


def regions_with_state(movies: DataFrame) -> DataFrame:
    """The region table of movies (movie_id, instance, semantic: paths) with semantic_raw, the state at each region's centre,
    from one visit to each label plane and its state plane. A frame without a state plane has null states."""
    stacks = {"labels": "instance", "states": "semantic"}
    found = [index(movies.select("movie_id", F.col(c).alias("path")), n) for n, c in stacks.items()]
    rows = found[0].join(found[1], PLANE, "left").persist()
    kind = dict(rows.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _Stacks(*stacks) as read:
            for b in batches:
                for i in range(b.num_rows):
                    found, states = regions.moments(read.plane(b, i, "labels")), read.plane(b, i, "states")
                    x, y = found["sr"] // np.maximum(found["n"], 1), found["sc"] // np.maximum(found["n"], 1)
                    inside = (x < states.shape[0]) & (y < states.shape[1]) if states is not None else np.zeros(len(x), bool)
                    state = np.zeros(len(x), np.int64)
                    if inside.any():
                        state[inside] = states[x[inside], y[inside]]
                    columns = [*map(pa.array, found.values()), pa.array(state, mask=~inside)]
                    plane = pa.RecordBatch.from_arrays(columns, names=[*found, "semantic_raw"])
                    yield measure.with_plane(plane, b, i)

    fields = f"movie_id {kind['movie_id']}, frame {kind['frame']}, {regions.MOMENTS}, semantic_raw long"
    return regions.from_moments(dealt(rows, rows.count()).mapInArrow(run, fields), "semantic_raw")


def signals(labels: DataFrame, channel: DataFrame, p: CellParams, wanted: DataFrame, background: DataFrame | None = None, intensity: tuple[str, int] | None = None) -> DataFrame:
    """`measure.signals` under eroded labels, of the planes (movie_id, frame) in `wanted` only. labels, channel, background
    are indexes under these names; background without a movie_id is for all movies. intensity is one plane's path and offset,
    for all movies."""
    rows = wanted.select(*PLANE).distinct().join(labels, PLANE).join(channel, PLANE)
    names = ["labels", "channel"]
    if background is not None:
        rows, names = rows.join(background, [k for k in PLANE if k in background.columns], "left"), [*names, "background"]
    if intensity is not None:
        rows, names = rows.withColumn("intensity_path", F.lit(intensity[0])).withColumn("intensity_offset", F.lit(intensity[1]).cast("long")), [*names, "intensity"]
    rows, offsets = rows.persist(), images.disk(p.erosion_radius)
    kind = dict(rows.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _Stacks(*names) as read:
            for b in batches:
                for i in range(b.num_rows):
                    planes = {n: read.plane(b, i, n) for n in names}
                    eroded = images.erode(planes["labels"].astype(np.int32), offsets)
                    yield measure.with_plane(measure.plane_signals(eroded, planes["channel"], planes.get("background"), planes.get("intensity")), b, i)

    return dealt(rows, rows.count()).mapInArrow(run, f"movie_id {kind['movie_id']}, frame {kind['frame']}, {measure.SIGNALS}")
