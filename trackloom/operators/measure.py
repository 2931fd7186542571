"""Signals under eroded labels, with background and illumination factors beside them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.operators.images import PLANE, lists


def masked_mean(v: Column) -> Column:
    """Mean of a group's pixels; null if there are none or all are zero."""
    return F.when(F.max(F.abs(v)) > 0, F.avg(v))


def _means(labels: np.ndarray, values: np.ndarray) -> np.ndarray:
    """masked_mean of each label's pixels, all labels in one pass."""
    n = int(labels.max(initial=0)) + 1
    count = np.bincount(labels, minlength=n)
    total = np.bincount(labels, values, n)
    any_ = np.bincount(labels, values != 0, n) > 0
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(any_, total / count, np.nan)


#: Signals of a plane's labels, and the factors where there is no map.
SIGNALS = "label int, signal double, bkg_corr double, int_corr double"
WITHOUT = {"bkg_corr": 0.0, "int_corr": 1.0}


def plane_signals(labels: np.ndarray, channel: np.ndarray, background: np.ndarray | None = None, intensity: np.ndarray | None = None, scale: int = 2) -> pa.RecordBatch:
    """SIGNALS of one plane: means of a channel, and of the planes of its maps, under each label above 0; null for nan. A
    channel pixel (R, C) belongs to the label at (R // scale, C // scale); nothing is magnified."""
    height, width = channel.shape
    mask = labels[np.arange(height)[:, None] // scale, np.arange(width)[None] // scale].reshape(-1)
    mask = np.maximum(mask, 0).astype(np.int64)
    found = np.unique(mask)
    found = found[found > 0]
    columns = [_means(mask, channel.reshape(-1))[found]]
    for values, without in ((background, WITHOUT["bkg_corr"]), (intensity, WITHOUT["int_corr"])):
        columns.append(np.full(len(found), without) if values is None else _means(mask, values.reshape(-1))[found])
    names = [c.split()[0] for c in SIGNALS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), *(pa.array(c, pa.float64(), from_pandas=True) for c in columns)], names=names)


def with_plane(found: pa.RecordBatch, batch: pa.RecordBatch, row: int) -> pa.RecordBatch:
    """found with the movie and frame of a batch's row before its columns."""
    key = [pa.repeat(batch.column(k)[row], found.num_rows) for k in PLANE]
    return pa.RecordBatch.from_arrays([*key, *found.columns], names=[*PLANE, *found.schema.names])


def signals(
    labels: DataFrame, channel: DataFrame, background: DataFrame | None = None, intensity: DataFrame | None = None,
    scale: int = 2,
) -> DataFrame:
    """movie_id, frame, label, signal, bkg_corr, int_corr: plane_signals of planes that meet by movie and frame. background
    has a plane per frame, intensity one per movie; maps without a movie_id are for all movies, so that such an intensity
    map is one plane. Without a movie's map its factor is 0 or 1. Planes are shuffled in the type they have;
    `plans.stacks` reads them together instead."""
    joined = labels.select(*PLANE, F.col("width").alias("label_width"), F.col("pixels").alias("labels")).join(
        channel.select(*PLANE, "width", F.col("pixels").alias("values")), PLANE,
    )
    for maps, name, keys in ((background, "background", PLANE), (intensity, "intensity", ["movie_id"])):
        if maps is None:
            joined = joined.withColumn(name, F.lit(None).cast("array<double>"))
        elif keys := [k for k in keys if k in maps.columns]:
            joined = joined.join(maps.select(*keys, F.col("pixels").alias(name)), keys, "left")
        else:
            joined = joined.join(F.broadcast(maps.select(F.col("pixels").alias(name)).limit(1)), how="left")  # one plane

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = []
            for i, planes in enumerate(zip(*(lists(b, c) for c in ("labels", "values", "background", "intensity")))):
                if planes[0] is None or planes[1] is None:
                    continue
                label_width, width = b.column("label_width")[i].as_py(), b.column("width")[i].as_py()
                shaped = [p.reshape(-1, w) if p is not None else None for p, w in zip(planes, (label_width, width, width, width))]
                done.append(with_plane(plane_signals(*shaped, scale), b, i))
            if done:
                yield pa.concat_batches(done)

    kind = dict(joined.dtypes)
    rows = joined.select(*PLANE, "label_width", "labels", "width", "values", "background", "intensity")
    return rows.mapInArrow(run, f"movie_id {kind['movie_id']}, frame {kind['frame']}, {SIGNALS}")


def chosen(tracks: DataFrame, ids: int | list[int] | DataFrame | None = None) -> DataFrame:
    """Rows to measure: mitotic tracks, or those chosen. Particles are numbered anew in each movie, so what chooses tracks
    of many movies is a relation of (movie_id, particle); a particle, or a list of them, chooses in tracks of one movie. An
    id that no track has is an error, and so are particles alone where they would choose in several movies."""
    if ids is None:
        return tracks.filter("mitotic = 1")
    if isinstance(ids, DataFrame):
        wanted = ids.select("movie_id", "particle").distinct()
        missing = wanted.join(tracks, ["movie_id", "particle"], "left_anti").limit(10).collect()
        if missing:
            raise ValueError(f"no tracks {sorted(map(tuple, missing))}")
        return tracks.join(wanted, ["movie_id", "particle"], "left_semi")
    ids = [ids] if isinstance(ids, int) else list(ids)
    met = tracks.filter(F.col("particle").isin(ids)).select("movie_id", "particle").distinct().limit(2 * len(ids) + 1).collect()
    if missing := set(ids) - {r["particle"] for r in met}:
        raise ValueError(f"no tracks {sorted(missing)}")
    if len({r["movie_id"] for r in met}) > 1:
        raise ValueError("particles are numbered by movie: choose (movie_id, particle) pairs")
    return tracks.filter(F.col("particle").isin(ids))


def with_channel(tracks: DataFrame, measured: DataFrame, channel: str) -> DataFrame:
    """tracks with the channel's three columns: unmeasured rows have a null signal, background 0 and illumination 1."""
    names = measured.select(
        *PLANE, "label", F.col("signal").alias(channel), F.col("bkg_corr").alias("b__"), F.col("int_corr").alias("i__"),
        F.lit(True).alias("m__"),
    )
    joined = tracks.join(names, [*PLANE, "label"], "left")
    return joined.withColumn(
        f"{channel}_bkg_corr", F.when(F.col("m__"), F.col("b__")).otherwise(0.0),
    ).withColumn(f"{channel}_int_corr", F.when(F.col("m__"), F.col("i__")).otherwise(1.0)).drop("b__", "i__", "m__")
