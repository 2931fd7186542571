"""Linking detections into tracks, movie by movie, and what follows it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackloom.functions.linker import Linker, Options, OversizeError
from trackloom.operators.components import parts
from trackloom.params import CellParams, mode_or_default
from trackloom.sources.tables import kept


def options(p: CellParams, mode: str | None = None, radius: float | None = None, memory: int | None = None) -> Options:
    """Linking options of a cell type, with anything given here instead."""
    return Options(
        p.max_pixel_movement if radius is None else radius, p.memory if memory is None else memory, mode_or_default(mode, p),
        adaptive_step=p.adaptive_step, adaptive_stop=p.adaptive_stop, span=p.predict_span,
    )


#: Detections that a task may hold as one movie.
WHOLE_MOVIE = 1 << 20


def link(detections: DataFrame, o: Options, split: bool | None = None) -> DataFrame:
    """detections with particle (long) and link_error: a movie that can't be solved keeps its rows, with a null
    particle and the reason; the other movies are not touched. Particles count up by first frame, in a frame by x, y, label.

    Movies are independent, and so are the parts of a movie that no chain of possible links joins, unless positions are
    predicted, which takes velocities from any neighbour. With `split` each part is linked by itself (`components.parts`),
    without it each movie; by default movies are split if one has over WHOLE_MOVIE detections, which are counted for that.
    Either way a task goes through sorted points frame by frame and holds one movie or part; all columns go with them."""
    if o.mode == "predictive":
        split = False
    if split is None:
        most = detections.groupBy("movie_id").count().agg(F.max("count")).first()[0] or 0
        split = most > WHOLE_MOVIE
    if not split:
        none = F.lit(None).cast("struct<frame: bigint, label: bigint>")
        return _linked(detections.withColumn("part__", none), o).drop("part__", "born__", "failed__")
    detections = kept(detections)
    found = parts(detections.select("movie_id", "frame", "label", "x", "y"), o.radius, o.memory).withColumnRenamed("part", "part__")
    rows = kept(_linked(detections.join(found, ["movie_id", "frame", "label"]), o))
    first = (F.col("frame") == F.col("born__.frame")) & (F.col("label") == F.col("born__.label"))
    births = rows.filter(first & F.col("link_error").isNull()).select("movie_id", "frame", "label", "x", "y")
    before = Window.partitionBy("movie_id").orderBy("frame").rowsBetween(Window.unboundedPreceding, -1)
    offsets = births.groupBy("movie_id", "frame").agg(F.count("*").alias("n")).withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
    nth = F.row_number().over(Window.partitionBy("movie_id", "frame").orderBy("x", "y", "label")) - 1
    numbered = births.withColumn("nth", nth).join(offsets, ["movie_id", "frame"]).select(
        "movie_id", F.struct(F.col("frame").cast("long").alias("frame"), F.col("label").cast("long").alias("label")).alias("born__"), (F.col("offset") + F.col("nth")).alias("id__"),
    )
    failed = rows.filter("link_error is not null").groupBy("movie_id").agg(F.min_by("link_error", F.struct("failed__", "link_error")).alias("why__"))
    joined = rows.join(numbered, ["movie_id", "born__"], "left").join(failed, "movie_id", "left")
    return joined.select(
        *[F.col(f"`{c}`") for c in detections.columns], F.when(F.col("why__").isNull(), F.col("id__")).alias("particle"), F.col("why__").alias("link_error"),
    )


def _linked(detections: DataFrame, o: Options) -> DataFrame:
    """detections (with part__) with particle, numbered within the part, link_error, born__ (frame and label of the particle's
    first detection) and failed__ (the frame that couldn't be solved)."""
    names = detections.columns
    keys = ["movie_id", "part__"]
    born = pa.struct([("frame", pa.int64()), ("label", pa.int64())])

    def solved(part: pa.Table) -> pa.Table:
        frame, label, x, y = (part.column(c).to_numpy() for c in ("frame", "label", "x", "y"))
        linker, ids, error, failed = Linker(o), np.zeros(len(frame), np.int64), None, None
        cuts = np.flatnonzero(np.diff(frame, prepend=frame[0] - 1))
        try:
            for b, e in zip(cuts, [*cuts[1:], len(frame)]):
                failed = int(frame[b])
                ids[b:e] = linker.step(failed, list(zip(x[b:e].astype(float).tolist(), y[b:e].astype(float).tolist())))
        except OversizeError as e:
            error = f"movie {part.column('movie_id')[0].as_py()}: {e}"
        gone = np.full(len(frame), error is not None)
        first = np.unique(ids, return_index=True)[1][ids] if error is None else np.zeros(len(frame), np.int64)
        births = pa.StructArray.from_arrays([pa.array(v[first].astype(np.int64)) for v in (frame, label)], fields=list(born), mask=pa.array(gone))
        more = {"particle": pa.array(ids, mask=gone), "link_error": pa.array([error] * len(frame), pa.string()), "born__": births, "failed__": pa.array([failed if error else None] * len(frame), pa.int64())}
        for name, column in more.items():
            part = part.append_column(name, column)
        return part

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for b in batches:
            if not b.num_rows:
                continue
            of = [b.column(k).to_pylist() for k in keys]
            of = list(zip(of[0], (tuple(p.values()) if p else None for p in of[1])))
            cuts = [i for i in range(len(of)) if of[i] != (of[i - 1] if i else last)]
            at = 0
            for cut in [*cuts, len(of)]:
                if cut > at:
                    held.append(b.slice(at, cut - at))
                if cut < len(of) and held:
                    yield from solved(pa.Table.from_batches(held)).to_batches()
                    held = []
                at = cut
            last = of[-1]
        if held:
            yield from solved(pa.Table.from_batches(held)).to_batches()

    in_order = detections.repartition(*keys).sortWithinPartitions(*keys, "frame", "x", "y", "label")
    kinds = dict(detections.dtypes)
    fields = ", ".join([*(f"`{c}` {kinds[c]}" for c in names), "particle long, link_error string, born__ struct<frame: bigint, label: bigint>, failed__ long"])
    return in_order.mapInArrow(run, fields)


def stub_filter(tracks: DataFrame, min_length: int = 10) -> DataFrame:
    """Tracks with at least min_length rows."""
    n = F.count("*").over(Window.partitionBy("movie_id", "particle"))
    return tracks.withColumn("n__", n).filter(F.col("n__") >= min_length).drop("n__")


def candidates(regions: DataFrame, radius: int) -> DataFrame:
    """Pairs of regions of consecutive frames within the radius: movie_id, frame, label, next_label, d2. Regions meet by
    grid cells as wide as the radius, so the join is on equal cells and not on distance."""
    cell = lambda c: F.floor(F.col(c) / radius)
    now = regions.select("movie_id", "frame", "label", "x", "y", cell("x").alias("cx"), cell("y").alias("cy"))
    near = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1)])
    reach = now.select("movie_id", (F.col("frame") + 1).alias("frame"), "label", "x", "y", "cx", "cy", F.explode(near).alias("o")).select(
        "movie_id", "frame", "label", F.col("x").alias("x0"), F.col("y").alias("y0"), (F.col("cx") + F.col("o.a")).alias("cx"),
        (F.col("cy") + F.col("o.b")).alias("cy"),
    )
    pairs = reach.join(now.withColumnRenamed("label", "next_label"), ["movie_id", "frame", "cx", "cy"])
    d2 = F.pow(F.col("x") - F.col("x0"), F.lit(2)) + F.pow(F.col("y") - F.col("y0"), F.lit(2))
    return pairs.withColumn("d2", d2).filter(F.col("d2") <= radius * radius).select(
        "movie_id", (F.col("frame") - 1).alias("frame"), "label", "next_label", F.col("d2").cast("long").alias("d2"),
    )
