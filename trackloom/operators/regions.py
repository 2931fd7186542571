"""Region table of label planes, the area filter, and the state at a region's centre."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.operators.images import PLANE, lists

#: What is added up of a region's pixels, and how the sums of its parts become one.
SUMS = ["n", "sr", "sc", "srr", "scc", "src"]
ENDS = {"r0": F.min, "c0": F.min, "r1": F.max, "c1": F.max}
MOMENTS = ", ".join(f"{c} long" for c in ["label", *SUMS, *ENDS])


def moments(plane: np.ndarray, top: int = 0, left: int = 0) -> dict[str, np.ndarray]:
    """label, SUMS and ENDS of each label other than 0: number of pixels, sums of their rows, columns, squares and products,
    first and last row and column. The plane may be a tile of a larger one whose first pixel is at (top, left)."""
    r, c = np.nonzero(plane)
    labels, of = np.unique(plane[r, c], return_inverse=True)
    r, c = r.astype(np.int64) + top, c.astype(np.int64) + left
    order = np.argsort(of, kind="stable")
    starts = np.searchsorted(of[order], np.arange(len(labels)))
    r, c = r[order], c[order]
    total = lambda v: np.add.reduceat(v, starts) if len(v) else v
    ends = {k: (f.reduceat(v, starts) if len(v) else v) for k, f, v in (("r0", np.minimum, r), ("c0", np.minimum, c), ("r1", np.maximum, r), ("c1", np.maximum, c))}
    sums = zip(SUMS, (np.ones_like(r), r, c, r * r, c * c, r * c))
    return {"label": labels.astype(np.int64), **{k: total(v) for k, v in sums}, **ends}


def partial_moments(labels: DataFrame) -> DataFrame:
    """MOMENTS of each plane's labels, a row for each: planes movie_id, frame, width, pixels, or tiles of planes with `top` and
    `left` as well. Pixels never become rows."""
    tiles = {"top", "left"} <= set(labels.columns)
    kind = dict(labels.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = []
            for i, pixels in enumerate(lists(b, "pixels")):
                width = b.column("width")[i].as_py()
                if pixels is None or not width:
                    continue
                at = (b.column("top")[i].as_py(), b.column("left")[i].as_py()) if tiles else (0, 0)
                found = moments(pixels.reshape(-1, width), *at)
                n = len(found["label"])
                key = [pa.repeat(b.column(k)[i], n) for k in PLANE]
                done.append(pa.RecordBatch.from_arrays([*key, *map(pa.array, found.values())], names=[*PLANE, *found]))
            if done:
                yield pa.concat_batches(done)

    rows = labels.select(*PLANE, "width", "pixels", *(["top", "left"] if tiles else []))
    return rows.mapInArrow(run, f"movie_id {kind['movie_id']}, frame {kind['frame']}, {MOMENTS}")


def region_table(labels: DataFrame) -> DataFrame:
    """A row per (movie_id, frame, label other than 0): x (row) and y (column) of the centre cut to whole numbers, area,
    eccentricity and half-open bounding box. Pieces of one label are one region. Moments are added up where planes or their
    tiles are read; a row per region and tile is shuffled."""
    sums = [F.sum(c).alias(c) for c in SUMS] + [f(c).alias(c) for c, f in ENDS.items()]
    return from_moments(partial_moments(labels).groupBy(*PLANE, "label").agg(*sums))


def from_moments(sums: DataFrame, *more: str) -> DataFrame:
    """region_table of whole regions' moments, with other columns kept. Variances come from whole numbers, so nothing cancels."""
    n = F.col("n").cast("double")
    spread = lambda product, a, b: (_exact("n") * _exact(product) - _exact(a) * _exact(b)).cast("double") / (n * n)
    vr, vc, vrc = spread("srr", "sr", "sr"), spread("scc", "sc", "sc"), spread("src", "sr", "sc")
    sums = sums.select("*", vr.alias("vr"), vc.alias("vc"), vrc.alias("vrc"))
    half, apart = (F.col("vr") + F.col("vc")) / 2, F.sqrt(F.pow((F.col("vr") - F.col("vc")) / 2, F.lit(2)) + F.pow("vrc", F.lit(2)))
    large, small = half + apart, F.greatest(half - apart, F.lit(0.0))
    eccentricity = F.when(large > 0, F.sqrt(F.greatest(1 - small / large, F.lit(0.0)))).otherwise(0.0)
    return sums.select(
        *PLANE, F.col("label").cast("int").alias("label"), F.floor(F.col("sr") / n).cast("int").alias("x"), F.floor(F.col("sc") / n).cast("int").alias("y"), n.alias("area"),
        eccentricity.alias("eccentricity"), F.col("r0").cast("int").alias("bbox-0"), F.col("c0").cast("int").alias("bbox-1"), (F.col("r1") + 1).cast("int").alias("bbox-2"),
        (F.col("c1") + 1).cast("int").alias("bbox-3"), *more,
    )


def _exact(name: str) -> Column:
    return F.col(name).cast("decimal(19,0)")


def area_filter(regions: DataFrame, min_size: float, max_size: float) -> DataFrame:
    """Strictly between both limits."""
    return regions.filter((F.col("area") < max_size) & (F.col("area") > min_size))


def state_at_centre(regions: DataFrame, states: DataFrame) -> DataFrame:
    """Adds semantic_raw: the state plane's value at (x, y) of the same movie and frame."""
    planes = states.select(*PLANE, "width", F.col("pixels").alias("states"))
    found = regions.join(planes, PLANE)
    return found.withColumn(
        "semantic_raw", F.try_element_at("states", (F.col("x") * F.col("width") + F.col("y") + 1).cast("int")).cast("long"),
    ).drop("states", "width")
