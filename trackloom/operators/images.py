"""Operators on image planes: a row per plane, pixels row-major. Kernels run per plane in Arrow batches; projections add
up planes where they are read, so that pixels are never rows of a shuffle."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PLANE = ["movie_id", "frame"]


def disk(radius: int = 3) -> list[tuple[int, int]]:
    """Offsets within the radius: 29 for 3."""
    span = range(-radius, radius + 1)
    return [(r, c) for r in span for c in span if r * r + c * c <= radius * radius]


def erode(plane: np.ndarray, offsets: list[tuple[int, int]]) -> np.ndarray:
    """The minimum over the offsets inside the plane: of touching labels the lower grows into the higher."""
    reach = max(max(abs(r), abs(c)) for r, c in offsets)
    top = np.iinfo(plane.dtype).max if plane.dtype.kind == "i" else np.inf
    padded = np.pad(plane, reach, constant_values=top)
    h, w = plane.shape
    return np.minimum.reduce([padded[reach + r : reach + r + h, reach + c : reach + c + w] for r, c in offsets])


def median3x3(plane: np.ndarray) -> np.ndarray:
    """3x3 median with edges repeated, cut to whole numbers."""
    padded = np.pad(plane, 1, mode="symmetric")
    h, w = plane.shape
    return np.trunc(np.median([padded[r : r + h, c : c + w] for r in range(3) for c in range(3)], axis=0))


def gaussian(plane: np.ndarray, sigma: float, truncate: float = 4.0) -> np.ndarray:
    """Separable blur, edges repeated, cut at `truncate` sigmas: a product of spectra along each axis, so that its cost
    doesn't follow sigma."""
    reach = int(truncate * sigma + 0.5)
    taps = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    taps /= taps.sum()
    out = plane.astype(np.float64)
    for _ in range(2):
        padded = np.pad(out, ((0, 0), (reach, reach)), mode="edge")
        size = _smooth_size(padded.shape[1])
        spectrum = np.fft.rfft(padded, size) * np.fft.rfft(taps, size)
        # What wraps around falls on the first 2 * reach places only.
        out = np.fft.irfft(spectrum, size)[:, 2 * reach : 2 * reach + out.shape[1]].T
    return np.ascontiguousarray(out)


def _smooth_size(n: int) -> int:
    """The least product of powers of 2, 3 and 5 from n on: lengths that transform fast."""
    best = 1 << max(0, n - 1).bit_length()
    five = 1
    while five < best:
        three = five
        while three < best:
            two = three << max(0, -(-n // three) - 1).bit_length()
            best, three = min(best, two), three * 3
        five *= 5
    return best


def block_max(plane: np.ndarray) -> np.ndarray:
    """Maxima of 2x2 blocks; odd rests are blocks of their own."""
    h, w = plane.shape
    padded = np.pad(plane.astype(float), ((0, h % 2), (0, w % 2)), constant_values=-np.inf)
    return padded.reshape((h + 1) // 2, 2, (w + 1) // 2, 2).max(axis=(1, 3))


def zoom2(plane: np.ndarray) -> np.ndarray:
    """Nearest-neighbour doubling: out[i] = in[i // 2]."""
    return plane.repeat(2, axis=0).repeat(2, axis=1)


def lists(batch: pa.RecordBatch, column: str) -> Iterator[np.ndarray | None]:
    """Each row's list of numbers, without a copy and in its own type where no value is null; None for a null list."""
    for value in batch.column(batch.schema.get_field_index(column)):
        yield value.values.to_numpy(zero_copy_only=False) if value.is_valid else None


def _on_planes(planes: DataFrame, kernel: Callable[[np.ndarray], np.ndarray], to: pa.DataType, spark_type: str) -> DataFrame:
    """kernel on the pixels of every row; other columns stay. No shuffle."""
    names = planes.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i in range(b.num_rows):
                row = b.slice(i, 1)
                h, w = row.column("height")[0].as_py(), row.column("width")[0].as_py()
                pixels = row.column("pixels").flatten().to_numpy(zero_copy_only=False)
                if len(pixels) == h * w:
                    out = kernel(pixels.reshape(h, w))
                    row = row.set_column(
                        names.index("height"), "height", pa.array([out.shape[0]], pa.int32()),
                    ).set_column(names.index("width"), "width", pa.array([out.shape[1]], pa.int32()))
                    row = row.set_column(names.index("pixels"), "pixels", pa.array([out.reshape(-1).astype(to.to_pandas_dtype())], pa.list_(to)))
                rows.append(row)
            if rows:
                yield pa.concat_batches(rows)

    typed = planes.withColumns(
        {"height": F.col("height").cast("int"), "width": F.col("width").cast("int"), "pixels": F.col("pixels").cast(f"array<{spark_type}>")}
    )
    return typed.mapInArrow(run, typed.schema)


def eroded(planes: DataFrame, radius: int = 3) -> DataFrame:
    offsets = disk(radius)
    return _on_planes(planes, lambda p: erode(p, offsets), pa.int32(), "int")


def medianed(planes: DataFrame) -> DataFrame:
    """Background correction maps: each plane's own median filter."""
    return _on_planes(planes, median3x3, pa.float64(), "double")


def blurred(planes: DataFrame, sigma: float) -> DataFrame:
    return _on_planes(planes, lambda p: gaussian(p, sigma), pa.float64(), "double")


def shrunk(planes: DataFrame) -> DataFrame:
    return _on_planes(planes, block_max, pa.float64(), "double")


def zoomed(planes: DataFrame) -> DataFrame:
    return _on_planes(planes, zoom2, pa.float64(), "double")


def normalised(planes: DataFrame) -> DataFrame:
    """Each plane divided by its own maximum."""
    return planes.withColumn("pixels", F.transform("pixels", lambda v: v / F.array_max("pixels")))


def pixels(planes: DataFrame, name: str = "v") -> DataFrame:
    """A row per pixel: r, c and its value."""
    rows = planes.select(*[c for c in planes.columns if c not in ("pixels", "height", "width")], "width", F.posexplode("pixels").alias("at", name))
    return rows.withColumn(
        "r", F.floor(F.col("at") / F.col("width")).cast("int"),
    ).withColumn("c", (F.col("at") % F.col("width")).cast("int")).drop("at", "width")


def central_slab(planes: DataFrame) -> DataFrame:
    """The planes [c - h, c + h) of each movie's n: c is n // 2, one less for even n, and h half of c. Under 5 planes there are none."""
    movies = planes.groupBy("movie_id").agg(F.count("*").alias("n"), F.collect_list("frame").alias("frames"))
    centre = F.when(F.col("n") % 2 == 1, F.floor(F.col("n") / 2)).otherwise(F.floor(F.col("n") / 2) - 1)
    slab = movies.withColumn("centre", centre).withColumn("half", F.floor(F.col("centre") / 2)).filter("half > 0")
    wanted = F.slice(F.sort_array("frames"), (F.col("centre") - F.col("half") + 1).cast("int"), (F.col("half") * 2).cast("int"))
    return planes.join(slab.select("movie_id", F.explode(wanted).alias("frame")), PLANE, "left_semi")


#: The projections by name, and how two planes join in each; pixels that are nan have no value.
PROJECTIONS: dict[str, np.ufunc] = {"max": np.fmax, "min": np.fmin, "average": np.add}


class _Projected:
    """The planes of one movie so far, as one plane, and how many values each of its pixels has had."""

    def __init__(self, kind: str):
        self.kind, self.movie, self.shape, self.plane, self.n = kind, None, (0, 0), None, None

    def add(self, plane: np.ndarray, n: np.ndarray) -> None:
        if self.plane is not None and plane.shape != self.plane.shape:
            raise ValueError(f"planes of movie {self.movie} differ in size")
        if self.kind == "average":
            plane = np.where(n > 0, plane, 0.0)
        self.plane = plane if self.plane is None else PROJECTIONS[self.kind](self.plane, plane)
        self.n = n if self.n is None else self.n + n


def _projected(planes: DataFrame, kind: str, partial: bool) -> DataFrame:
    """A plane for each run of rows of one movie; the first step gives each movie one per task, the last one in all."""
    names = ["movie_id", "height", "width", "pixels", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[object, _Projected] = {}

        def out(x: _Projected) -> pa.RecordBatch:
            pixels = x.plane
            if not partial:
                with np.errstate(all="ignore"):
                    pixels = np.where(x.n > 0, x.plane / x.n if kind == "average" else x.plane, np.nan)
            values = pa.array(pixels, from_pandas=True)
            lists = [pa.ListArray.from_arrays(pa.array([0, len(p)], pa.int32()), p) for p in (values, pa.array(x.n, pa.int64()))]
            return pa.RecordBatch.from_arrays([pa.array([x.movie], movie), *(pa.array([n], pa.int32()) for n in x.shape), *lists], names=names)

        for b in batches:
            movie = b.schema.field("movie_id").type
            for i in range(b.num_rows):
                row = {n: b.column(n)[i] for n in b.schema.names}
                key = row["movie_id"].as_py()
                if not partial and held and key not in held:  # rows come sorted by movie
                    yield out(held.popitem()[1])
                pixels = row["pixels"].values.cast(pa.float64()).to_numpy(zero_copy_only=False) if row["pixels"].is_valid else np.zeros(0)
                n = row["n"].values.to_numpy(zero_copy_only=False) if not partial else (~np.isnan(pixels)).astype(np.int64)
                x = held.setdefault(key, _Projected(kind))
                x.movie, x.shape = key, (row["height"].as_py(), row["width"].as_py())
                x.add(pixels, n)
                if len(held) > MOVIES_AT_ONCE:  # the movies met first have most of their planes
                    yield out(held.pop(next(iter(held))))
        for x in held.values():
            yield out(x)

    kind_of = dict(planes.dtypes)["movie_id"]
    return planes.mapInArrow(run, f"movie_id {kind_of}, height int, width int, pixels array<double>, n array<long>")


#: Movies of which a task holds the planes so far.
MOVIES_AT_ONCE = 8


def projection(planes: DataFrame, kind: str) -> DataFrame:
    """movie_id, height, width, pixels: the projection of each movie's central slab, a plane per movie. A task adds up the
    planes it reads, so a movie is shuffled as one plane per task. A movie with under 5 planes has no row for max and
    min, and null pixels for average; null pixels don't count."""
    if kind not in PROJECTIONS:
        raise ValueError(f"unknown projection {kind!r}; known: {', '.join(PROJECTIONS)}")
    slab = central_slab(planes).select("movie_id", "height", "width", F.col("pixels").cast("array<double>").alias("pixels"))
    found = _projected(_projected(slab, kind, True).repartition("movie_id").sortWithinPartitions("movie_id"), kind, False).drop("n")
    if kind != "average":
        return found
    size = F.col("height_") * F.col("width_")
    every = planes.groupBy("movie_id").agg(F.max("height").cast("int").alias("height_"), F.max("width").cast("int").alias("width_"))
    joined = every.join(found, "movie_id", "left")
    return joined.select(
        "movie_id", F.col("height_").alias("height"), F.col("width_").alias("width"),
        F.coalesce("pixels", F.array_repeat(F.lit(None).cast("double"), size.cast("int"))).alias("pixels"),
    )


def intensity_map(planes: DataFrame, sigma: float = 45.0) -> DataFrame:
    """Illumination map of each movie: its average projection blurred and divided by its maximum, as one plane. A movie
    whose projection has null pixels has none."""
    flat = projection(planes, "average").filter(~F.exists("pixels", lambda v: v.isNull()))
    return normalised(blurred(flat, sigma))
