"""State traces: recoding, median filter, closing, and the mitotic flag.

A movie's traces are filtered as one vector in the order (particle, frame), so the end of one track touches the start
of the next. A window over whole movies would put each into one task. A row depends on three rows either side only, so
each track is extended by the last rows before it and the first rows after it, of as many tracks as have them, filtered
by itself, and the extension is dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def recode(semantic: Column) -> Column:
    """States under 100 are interphase, 1; others stay."""
    return F.when(semantic < 100, F.lit(1)).otherwise(semantic).cast("long")


def level(semantic: Column) -> Column:
    """1 -> 0, 100 and 101 -> 1, 199 and more -> 2."""
    return F.floor((semantic - 1) / 99).cast("long")


def median3(v: Column, w: WindowSpec) -> Column:
    """The middle of three, zeros beyond the ends."""
    a, c = F.coalesce(F.lag(v).over(w), F.lit(0)), F.coalesce(F.lead(v).over(w), F.lit(0))
    return F.greatest(F.least(a, v), F.least(F.greatest(a, v), c))


def _filtered(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    near = w.rowsBetween(-1, 1)
    rows = rows.withColumn("semantic", median3(F.col("recoded"), w))
    rows = rows.withColumn("dilated", F.max(level(F.col("semantic"))).over(near))
    return rows.withColumn("semantic_smoothed", F.min("dilated").over(near))


#: Particle ids that a task orders together.
IDS_AT_ONCE = 4096


def _neighbours(lengths: DataFrame, size: int) -> DataFrame:
    """movie_id, particle, before, after: the `size` tracks before and after each in its movie, nearest first, as (track,
    length). Tracks are ordered in ranges of ids; of each range only its first and last tracks are ordered by movie."""
    at = F.struct(F.col("particle").alias("track"), "length")
    ranged = lengths.withColumn("range", F.floor(F.col("particle") / IDS_AT_ONCE))
    by_id = Window.partitionBy("movie_id", "range").orderBy("particle")
    seen = lambda away: F.filter(F.array(*[away(at, k).over(by_id) for k in range(1, size + 1)]), lambda x: x.isNotNull())
    inside = ranged.select("movie_id", "particle", "range", seen(F.lag).alias("before"), seen(F.lead).alias("after"))
    ends = ranged.groupBy("movie_id", "range").agg(F.array_sort(F.collect_list(at)).alias("all"))
    ends = ends.select("movie_id", "range", F.slice("all", 1, size).alias("first"), F.slice(F.reverse("all"), 1, size).alias("last"))
    by_range = Window.partitionBy("movie_id").orderBy("range")
    none = F.array().cast("array<struct<track: bigint, length: bigint>>")
    reached = lambda away, end: F.slice(F.concat(*[F.coalesce(away(end, k).over(by_range), none) for k in range(1, size + 1)]), 1, size)
    ends = ends.select("movie_id", "range", reached(F.lag, "last").alias("earlier"), reached(F.lead, "first").alias("later"))
    both = inside.join(ends, ["movie_id", "range"])
    return both.select("movie_id", "particle", *[F.slice(F.concat(a, b), 1, size).alias(a) for a, b in (("before", "earlier"), ("after", "later"))])


def _halo(rows: DataFrame, size: int) -> DataFrame:
    """Each row under its own track, and near a track's ends also under those of the `size` tracks before and after whose
    extension it is in; `side` says how many tracks away it stands. Every track has a row, so no extension is longer."""
    lengths = rows.groupBy("movie_id", F.col("particle").cast("long").alias("particle")).agg(F.count("*").alias("length"))
    # gap: how many rows stand between this track and the one k tracks away.
    gap = lambda tracks, k: F.aggregate(F.slice(tracks, 1, k), F.lit(0).cast("long"), lambda total, t: total + t["length"])
    placed = lambda tracks, step: F.transform(tracks, lambda t, k: F.struct(t["track"].alias("track"), ((k + 1) * step).alias("side"), gap(tracks, k).alias("gap")))
    near = F.concat(placed(F.col("before"), 1), placed(F.col("after"), -1))
    places = _neighbours(lengths, size).select("movie_id", "particle", near.alias("near"))
    own = Window.partitionBy("movie_id", "particle")
    ranked = rows.withColumn("from_start", F.row_number().over(own.orderBy("frame"))).withColumn(
        "from_end", F.row_number().over(own.orderBy(F.desc("frame"))),
    )
    ranked = ranked.join(places, ["movie_id", "particle"])
    mine = F.array(F.struct(F.col("particle").cast("long").alias("track"), F.lit(0).alias("side"), F.lit(0).cast("long").alias("gap")))
    held = F.filter("near", lambda p: p["gap"] + F.when(p["side"] > 0, F.col("from_start")).otherwise(F.col("from_end")) <= size)
    return ranked.select("*", F.inline(F.concat(mine, held))).drop("from_start", "from_end", "near", "gap")


def smooth(tracks: DataFrame, scope: str = "global", min_track_length: int = 10) -> DataFrame:
    """Adds semantic (median-filtered), semantic_smoothed and mitotic to (movie_id, particle, frame, semantic_raw).

    scope "global": as one vector per movie; "track": each track by itself, zeros beyond its ends. Tracks may have any
    number of rows; with a min_track_length under three movies are filtered whole.
    """
    if scope not in ("global", "track"):
        raise ValueError(f"unknown scope {scope!r}")
    rows = tracks.withColumn("recoded", recode(F.col("semantic_raw")))
    if scope == "track":
        found = _filtered(rows, ["movie_id", "particle"], ["frame"])
    elif min_track_length < 3:
        found = _filtered(rows, ["movie_id"], ["particle", "frame"])
    else:
        # The rows that stay have track = particle; under that name their partitioning serves what follows.
        found = _filtered(_halo(rows, 3), ["movie_id", "track"], ["side", "frame"]).filter("side = 0")
        found = found.drop("particle", "side").withColumnRenamed("track", "particle").select(
            *[F.col(f"`{c}`") for c in rows.columns], "semantic", "semantic_smoothed",
        )
    return flag(found.drop("recoded", "dilated"))


def flag(rows: DataFrame) -> DataFrame:
    """mitotic: 1 if any median-filtered state of the track is exactly 101."""
    return rows.withColumn("mitotic", F.max((F.col("semantic") == 101).cast("int")).over(Window.partitionBy("movie_id", "particle")))
