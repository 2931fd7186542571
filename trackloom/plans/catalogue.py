"""The registered queries of the track analytics and their SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom import params
from trackloom.functions import hill, names
from trackloom.operators import dose, events, images, linking, measure, regions, smoothing, summarize, wells
from trackloom.plans import experiment, views
from trackloom.sources import discovery, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

TRACK = ["movie_id", "particle"]
RADIUS = 3
CURVE = (5.0, 40.0, 3.0, 20.0)


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


#: Means of decimals may lie exactly between two rounded values, where the order of a sum would decide; this moves them off.
OFF_TIES = 1.000000000001


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(f"`{c}`") * OFF_TIES, digits) for c in columns})


def rounded_sql(value: str, digits: int = 6) -> str:
    return f"round(({value}) * {OFF_TIES!r}::DOUBLE, {digits})"


def longs(*columns: str) -> list[Column]:
    return [F.col(c).cast("long").alias(c) for c in columns]


# Tracks ------------------------------------------------------------------------------------------------------------


def _smoothed(spark: SparkSession, d: str, scope: str = "global") -> DataFrame:
    return smoothing.smooth(views.tracks(spark, d), scope)


@query(f"WITH {views.TRACKS} SELECT movie_id, particle, frame, area FROM tracks WHERE area < 4000 AND area > 250")
def area_filter(spark: SparkSession, d: str) -> DataFrame:
    return regions.area_filter(views.tracks(spark, d), 250, 4000).select(*TRACK, "frame", "area")


@query(
    f"""
WITH {views.TRACKS}, kept AS (SELECT * FROM tracks WHERE area < 4000 AND area > 250) SELECT movie_id, particle, frame FROM kept
QUALIFY count(*) OVER (PARTITION BY movie_id, particle) >= 60
"""
)
def stub_filter(spark: SparkSession, d: str) -> DataFrame:
    return linking.stub_filter(regions.area_filter(views.tracks(spark, d), 250, 4000), 60).select(*TRACK, "frame")


@query(
    f"""
WITH {views.TRACKS} SELECT movie_id, particle, frame, CAST(CASE WHEN semantic_raw < 100 THEN 1
ELSE semantic_raw END AS BIGINT) AS recoded, CAST(floor((CASE WHEN semantic_raw < 100 THEN 1
ELSE semantic_raw END - 1) / 99) AS BIGINT) AS lvl FROM tracks
"""
)
def semantic_recode(spark: SparkSession, d: str) -> DataFrame:
    recoded = smoothing.recode(F.col("semantic_raw"))
    return views.tracks(spark, d).select(*TRACK, "frame", recoded.alias("recoded"), smoothing.level(recoded).alias("lvl"))


@query(f"WITH {views.SMOOTH} SELECT movie_id, particle, frame, CAST(semantic AS BIGINT) AS semantic FROM smooth")
def median_smooth(spark: SparkSession, d: str) -> DataFrame:
    return _smoothed(spark, d).select(*TRACK, "frame", "semantic")


@query(f"WITH {views.SMOOTH} SELECT movie_id, particle, frame, CAST(semantic_smoothed AS BIGINT) AS semantic_smoothed FROM smooth")
def closing_smooth(spark: SparkSession, d: str) -> DataFrame:
    return _smoothed(spark, d).select(*TRACK, "frame", "semantic_smoothed")


@query(f"WITH {views.SMOOTH_TRACK} SELECT movie_id, particle, frame, CAST(semantic_smoothed AS BIGINT) AS semantic_smoothed FROM smooth")
def closing_smooth_track(spark: SparkSession, d: str) -> DataFrame:
    return _smoothed(spark, d, "track").select(*TRACK, "frame", "semantic_smoothed")


@query(f"WITH {views.SMOOTH} SELECT movie_id, particle, frame, x, y, CAST(semantic_smoothed AS BIGINT) AS state FROM smooth")
def display_frames(spark: SparkSession, d: str) -> DataFrame:
    return experiment.display_frames(_smoothed(spark, d))


@query(
    f"""
WITH {views.SMOOTH}, ids AS (SELECT movie_id, min(particle) AS first, max(particle) AS last FROM smooth GROUP BY movie_id)
SELECT movie_id, particle, count(*) AS n FROM smooth JOIN ids USING (movie_id) WHERE particle IN (first, last) GROUP BY ALL
"""
)
def chosen_tracks(spark: SparkSession, d: str) -> DataFrame:
    """The first and the last track of each movie."""
    rows = _smoothed(spark, d)
    ends = rows.groupBy("movie_id").agg(F.array(F.min("particle"), F.max("particle")).alias("ends"))
    return measure.chosen(rows, ends.select("movie_id", F.explode("ends").alias("particle"))).groupBy(*TRACK).agg(F.count("*").alias("n"))


@query(
    f"""
WITH {views.TRACKS} SELECT movie_id, particle, frame, CASE WHEN frame % 3 = 0 THEN "GFP" END AS signal,
  CASE WHEN frame % 3 = 0 THEN "GFP_bkg_corr" ELSE 0 END AS bkg_corr, CASE WHEN frame % 3 = 0 THEN "GFP_int_corr" ELSE 1 END AS int_corr FROM tracks
"""
)
def channel_defaults(spark: SparkSession, d: str) -> DataFrame:
    """A third of the frames are measured."""
    rows = views.tracks(spark, d)
    keys = [F.col("movie_id"), F.col("frame"), F.col("particle").alias("label")]
    measured = rows.filter("frame % 3 = 0").select(
        *keys, *[F.col(f"GFP{a}").alias(b) for a, b in (("", "signal"), ("_bkg_corr", "bkg_corr"), ("_int_corr", "int_corr"))],
    )
    found = measure.with_channel(rows.select(*keys, "particle"), measured, "DAPI")
    return found.select(
        *TRACK, "frame", F.col("DAPI").alias("signal"), F.col("DAPI_bkg_corr").alias("bkg_corr"),
        F.col("DAPI_int_corr").alias("int_corr"),
    )


@query(f"WITH {views.SMOOTH} SELECT DISTINCT movie_id, particle, CAST(mitotic AS BIGINT) AS mitotic FROM smooth")
def mitotic_flag(spark: SparkSession, d: str) -> DataFrame:
    return _smoothed(spark, d).groupBy(*TRACK).agg(F.max("mitotic").cast("long").alias("mitotic"))


@query(f"WITH {views.RUNS} SELECT * FROM runs")
def mitotic_runs(spark: SparkSession, d: str) -> DataFrame:
    return events.runs(_smoothed(spark, d))


@query(f"WITH {views.RUNS} SELECT * FROM peaks")
def peaks_per_track(spark: SparkSession, d: str) -> DataFrame:
    return events.peaks_per_track(_smoothed(spark, d))


HISTOGRAM_SQL = """histogram AS (SELECT b.movie_id, b.n_peaks, count(p.n_peaks) AS "track number" FROM (SELECT * FROM (SELECT DISTINCT movie_id FROM peaks), range(14) r(n_peaks)) b LEFT JOIN peaks p ON p.movie_id = b.movie_id AND p.n_peaks <= 14 AND least(p.n_peaks, 13) = b.n_peaks GROUP BY ALL)"""
HISTOGRAM = f"{views.RUNS}, {HISTOGRAM_SQL}"


@query(f"WITH {HISTOGRAM} SELECT * FROM histogram")
def peak_histogram(spark: SparkSession, d: str) -> DataFrame:
    return events.peak_histogram(events.peaks_per_track(_smoothed(spark, d)))


@query(
    f"""
WITH {views.SMOOTH}
SELECT movie_id, particle, count(*) AS track_length, {rounded_sql("avg(area)")} AS mean_area, {rounded_sql("stddev_samp(area)")} AS area_std FROM smooth
WHERE mitotic = 1 GROUP BY ALL
"""
)
def track_areas(spark: SparkSession, d: str) -> DataFrame:
    found = summarize.track_stats(_smoothed(spark, d)).select(*TRACK, "track_length", F.col("cell_area").alias("mean_area"), "area_std")
    return rounded(found, "mean_area", "area_std")


STEPS = f"""{views.TRACKS}, steps AS (SELECT movie_id, particle, frame, sqrt((x - lag(x) OVER w) ** 2 + (y - lag(y) OVER w) ** 2) AS displacement
FROM tracks WHERE area < 4000 AND area > 250 WINDOW w AS (PARTITION BY movie_id, particle ORDER BY frame))"""


@query(f"WITH {STEPS} SELECT movie_id, particle, frame, round(displacement, 6) AS displacement FROM steps")
def displacement(spark: SparkSession, d: str) -> DataFrame:
    found = events.displacement(regions.area_filter(views.tracks(spark, d), 250, 4000))
    return rounded(found.select(*TRACK, "frame", "displacement"), "displacement")


@query(f"WITH {STEPS} SELECT movie_id, particle, round(max(displacement), 6) AS max_displacement FROM steps GROUP BY ALL")
def max_displacement(spark: SparkSession, d: str) -> DataFrame:
    found = events.displacement(regions.area_filter(views.tracks(spark, d), 250, 4000))
    return rounded(found.groupBy(*TRACK).agg(F.max("displacement").alias("max_displacement")), "max_displacement")


def _stat_sql(source: str, name: str, std: str, fallback: int) -> str:
    zero, inside = f'max(CASE WHEN "{source}" IS NULL OR "{source}" <> 0 THEN 1 ELSE 0 END) = 0', f'CASE WHEN semantic_smoothed <> 0 THEN "{source}" END'
    mean, deviation = (rounded_sql(f"CASE WHEN {zero} THEN {x} ELSE {f}({inside}) END") for x, f in ((fallback, "avg"), (0, "stddev_pop")))
    return f'{mean} AS "{name}", {deviation} AS "{std}"'


CHANNEL_SQL = ", ".join(
    _stat_sql(*x) for c in params.CHANNELS for x in (
        (c, c, f"{c}_std", 0), (f"{c}_bkg_corr", f"{c}_bkg_corr", f"{c}_bkg_corr_std", 0),
        (f"{c}_int_corr", f"{c}_int_corr", f"{c}_int_corr_std", 1), ("area", f"{c}_area_mean", f"{c}_area_std", 1),
    )
)
CHANNEL_NAMES = [
    f"{c}{s}" for c in params.CHANNELS for s in ("", "_std", "_bkg_corr", "_bkg_corr_std", "_int_corr", "_int_corr_std", "_area_mean", "_area_std")
]
STATS = f"""{views.RUNS}, moved AS (SELECT *, sqrt((x - lag(x) OVER w) ** 2 + (y - lag(y) OVER w) ** 2) AS step FROM smooth WHERE mitotic = 1 WINDOW
w AS (PARTITION BY movie_id, particle ORDER BY frame)),
stats AS (SELECT movie_id, particle, count(*) AS track_length, round(max(step), 6) AS max_displacement, {rounded_sql("avg(area)")} AS cell_area, {rounded_sql("stddev_samp(area)")} AS area_std, {CHANNEL_SQL}
FROM moved GROUP BY movie_id, particle), single AS (SELECT movie_id, particle, min(mito_start) AS mito_start, min(mitosis) AS mitosis
FROM runs GROUP BY ALL HAVING count(*) = 1),
summary AS (SELECT movie_id, particle, track_length, max_displacement, mito_start, cell_area, mitosis, {', '.join(f'"{n}"' for n in CHANNEL_NAMES)}
FROM stats JOIN single USING (movie_id, particle))"""


@query(f"WITH {STATS} SELECT movie_id, particle, {', '.join(f'"{n}"' for n in CHANNEL_NAMES)} FROM stats")
def channel_stats(spark: SparkSession, d: str) -> DataFrame:
    return rounded(summarize.track_stats(_smoothed(spark, d)).select(*TRACK, *[F.col(f"`{n}`") for n in CHANNEL_NAMES]), *CHANNEL_NAMES)


def _summary(spark: SparkSession, d: str) -> DataFrame:
    return rounded(summarize.summary(_smoothed(spark, d)), "max_displacement", "cell_area", *CHANNEL_NAMES)


@query(f"WITH {STATS} SELECT * FROM summary")
def mitotic_summary(spark: SparkSession, d: str) -> DataFrame:
    return _summary(spark, d)


@query(
    f"""
WITH {STATS}, {HISTOGRAM_SQL}
SELECT a.movie_id, a.row, "Area std.", CAST(n_peaks AS DOUBLE) AS n_peaks, CAST("track number" AS DOUBLE) AS "track number"
FROM (SELECT movie_id, row_number() OVER (PARTITION BY movie_id ORDER BY particle) - 1 AS row, area_std AS "Area std." FROM stats) a LEFT
JOIN histogram h ON a.movie_id = h.movie_id AND a.row = h.n_peaks
"""
)
def quality_sheet(spark: SparkSession, d: str) -> DataFrame:
    sheet = summarize.quality_sheet(*summarize.quality(_smoothed(spark, d)))
    return rounded(sheet.withColumns({c: F.col(f"`{c}`").cast("double") for c in ("n_peaks", "track number")}), "Area std.")


# Planes ------------------------------------------------------------------------------------------------------------

PLANE = images.PLANE


@query(
    f"""
WITH {views.REGIONS}
SELECT movie_id, frame, label, x, y, area, round(eccentricity, 6) AS eccentricity, "bbox-0", "bbox-1", "bbox-2", "bbox-3" FROM regions
"""
)
def region_props(spark: SparkSession, d: str) -> DataFrame:
    found = regions.region_table(views.labels(spark, d))
    return rounded(found, "eccentricity").select(
        *PLANE, "label", *longs("x", "y"), "area", "eccentricity",
        *[F.col(f"`bbox-{i}`").cast("long").alias(f"bbox-{i}") for i in range(4)],
    )


def _pixel_rows(df: DataFrame, name: str, kind: str = "double") -> DataFrame:
    return images.pixels(df, name).select(*PLANE, *longs("r", "c"), F.col(name).cast(kind).alias(name))


@query(
    f"""
WITH {views.PIXELS} SELECT a.movie_id, a.frame, a.r, a.c, CAST(min(b.label) AS BIGINT) AS label FROM pixels a JOIN pixels b
ON a.movie_id = b.movie_id AND a.frame = b.frame AND (a.r - b.r) ** 2 + (a.c - b.c) ** 2 <= 9 GROUP BY ALL
"""
)
def erode_labels(spark: SparkSession, d: str) -> DataFrame:
    return _pixel_rows(images.eroded(views.labels(spark, d)), "label", "long")


@query(
    f"""
WITH {views.PIXELS} SELECT movie_id, frame, 2 * r + p AS r, 2 * c + q AS c, CAST(label AS BIGINT) AS label
FROM pixels, range(2) i(p), range(2) j(q)
"""
)
def zoom_lookup(spark: SparkSession, d: str) -> DataFrame:
    return _pixel_rows(images.zoomed(views.labels(spark, d)), "label", "long")


@query(f"WITH {views.PIXELS} SELECT movie_id, frame, r // 2 AS r, c // 2 AS c, max(v) AS v FROM pixels GROUP BY ALL")
def block_max(spark: SparkSession, d: str) -> DataFrame:
    return _pixel_rows(images.shrunk(views.planes(spark, d)), "v")


@query(
    f"""
WITH {views.PIXELS}, near AS (SELECT movie_id, frame, r, c, greatest(least(r + p - 1, 7), 0) AS r2, greatest(least(c + q - 1, 7), 0) AS c2
FROM pixels, range(3) i(p), range(3) j(q)) SELECT n.movie_id, n.frame, n.r, n.c, trunc(list_sort(list(b.v * 100))[5]) AS v FROM near n
JOIN pixels b ON n.movie_id = b.movie_id AND n.frame = b.frame AND n.r2 = b.r AND n.c2 = b.c GROUP BY ALL
"""
)
def median3x3(spark: SparkSession, d: str) -> DataFrame:
    return _pixel_rows(images.medianed(views.channel(spark, d)), "v")


def _slab_sql(f: str) -> str:
    return f"""WITH {views.PIXELS}, movies AS (SELECT movie_id, count(DISTINCT frame) AS n FROM pixels GROUP BY movie_id), slab AS (SELECT movie_id, CASE
WHEN n % 2 = 1 THEN n // 2 ELSE n // 2 - 1 END AS centre FROM movies) SELECT p.movie_id, r, c, round({f}(v), 9) AS v FROM pixels p
JOIN slab s ON p.movie_id = s.movie_id AND frame >= centre - centre // 2 AND frame < centre + centre // 2 GROUP BY ALL"""


def _slab(kind: str) -> Query:
    return lambda spark, d: rounded(
        images.pixels(images.projection(views.planes(spark, d), kind)).select("movie_id", *longs("r", "c"), "v"), "v", digits=9,
    )


for _kind, _f in (("max", "max"), ("min", "min"), ("average", "avg")):
    QUERIES[f"slab_{_f}"] = _slab(_kind)
    ORACLE_SQL[f"slab_{_f}"] = _slab_sql(_f)


@query(
    f"""
WITH {views.PIXELS}, taps AS (SELECT o, exp(-0.5 * o * o) / (SELECT sum(exp(-0.5 * o * o)) FROM range(-4, 5) t(o)) AS w
FROM range(-4, 5) t(o)),
near AS (SELECT p.movie_id, p.frame, p.r, p.c, greatest(least(p.r + a.o, 7), 0) AS r2, greatest(least(p.c + b.o, 7), 0) AS c2, a.w * b.w AS w
FROM pixels p, taps a, taps b) SELECT n.movie_id, n.frame, n.r, n.c, round(sum(n.w * b.v), 6) AS v FROM near n JOIN pixels b
ON n.movie_id = b.movie_id AND n.frame = b.frame AND n.r2 = b.r AND n.c2 = b.c GROUP BY ALL
"""
)
def gaussian_small(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_pixel_rows(images.blurred(views.planes(spark, d), 1.0), "v"), "v")


@query(
    f"""
WITH {views.PIXELS}, {views.BLUR}, down AS (SELECT movie_id, frame, s.c AS r, p.c, sum(s.w * v) AS v FROM pixels p JOIN share s ON p.r = s.c2 GROUP BY ALL)
SELECT movie_id, frame, r, s.c, round(sum(s.w * v), 6) AS v FROM down d JOIN share s ON d.c = s.c2 GROUP BY ALL
"""
)
def gaussian_large(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_pixel_rows(images.blurred(views.planes(spark, d), 45.0), "v"), "v")


@query(
    f"""
WITH {views.PIXELS}, {views.BLUR}, movies AS (SELECT movie_id, count(DISTINCT frame) AS n FROM pixels GROUP BY movie_id HAVING n >= 5),
slab AS (SELECT movie_id, CASE WHEN n % 2 = 1 THEN n // 2 ELSE n // 2 - 1 END AS centre FROM movies),
flat AS (SELECT p.movie_id, r, c, avg(v + 1) AS v FROM pixels p JOIN slab s ON p.movie_id = s.movie_id
  AND frame >= centre - centre // 2 AND frame < centre + centre // 2 GROUP BY ALL),
down AS (SELECT movie_id, s.c AS r, p.c, sum(s.w * v) AS v FROM flat p JOIN share s ON p.r = s.c2 GROUP BY ALL),
blurred AS (SELECT movie_id, r, s.c, sum(s.w * v) AS v FROM down d JOIN share s ON d.c = s.c2 GROUP BY ALL)
SELECT movie_id, r, c, round(v / max(v) OVER (PARTITION BY movie_id), 9) AS v FROM blurred
"""
)
def intensity_map(spark: SparkSession, d: str) -> DataFrame:
    """Pixels are raised by one, so that they are positive."""
    raised = views.planes(spark, d).withColumn("pixels", F.transform("pixels", lambda v: v + 1))
    return rounded(images.pixels(images.intensity_map(raised)).select("movie_id", *longs("r", "c"), "v"), "v", digits=9)


@query(f"WITH {views.PIXELS} SELECT movie_id, frame, r, c, round(v / max(v) OVER (PARTITION BY movie_id, frame), 6) AS v FROM pixels")
def normalise_max(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_pixel_rows(images.normalised(views.planes(spark, d)), "v"), "v")


@query(
    f"""
WITH {views.PIXELS} SELECT movie_id, frame, CAST(label AS BIGINT) AS label, {rounded_sql("CASE WHEN max(abs(v)) > 0 THEN avg(v) END")} AS signal
FROM pixels WHERE label <> 0 GROUP BY ALL
"""
)
def masked_mean(spark: SparkSession, d: str) -> DataFrame:
    found = measure.signals(views.labels(spark, d), views.planes(spark, d), scale=1)
    return rounded(found.select(*PLANE, F.col("label").cast("long").alias("label"), "signal"), "signal")


def _mean_sql(v: str, name: str) -> str:
    return f"{rounded_sql(f'CASE WHEN max(abs({v})) > 0 THEN avg({v}) END')} AS {name}"


@query(
    f"""
WITH {views.PIXELS}
SELECT p.movie_id, p.frame, CAST(l.label AS BIGINT) AS label, {_mean_sql('p.v * 100', 'signal')}, {_mean_sql('floor(p.v * 100)', 'bkg_corr')}, {rounded_sql("CASE WHEN count(m.v) = 0 THEN 1 WHEN max(abs(m.v)) > 0 THEN avg(m.v) END")}
AS int_corr FROM pixels p JOIN pixels l
ON p.movie_id = l.movie_id AND p.frame = l.frame AND l.r = p.r // 2 * 2 AND l.c = p.c // 2 * 2 LEFT JOIN pixels m
ON m.movie_id = p.movie_id AND m.frame = 0 AND m.r = p.r AND m.c = p.c WHERE l.label <> 0 GROUP BY ALL
"""
)
def corrected_measure(spark: SparkSession, d: str) -> DataFrame:
    background = views.channel(spark, d).withColumn("pixels", F.transform("pixels", lambda v: F.floor(v).cast("double")))
    intensity = views.planes(spark, d).filter("frame = 0")
    found = measure.signals(views.small_labels(spark, d), views.channel(spark, d), background, intensity)
    return rounded(found.withColumn("label", F.col("label").cast("long")), "signal", "bkg_corr", "int_corr")


@query(
    f"""
WITH {views.REGIONS} SELECT g.movie_id, g.frame, CAST(g.label AS BIGINT) AS label, g.x, g.y, CAST(CASE WHEN p.v > 0.05 THEN 101
WHEN p.v > -0.05 THEN 100 ELSE 2 END AS BIGINT) AS semantic_raw FROM regions g JOIN pixels p
ON g.movie_id = p.movie_id AND g.frame = p.frame AND g.x = p.r AND g.y = p.c
"""
)
def semantic_lookup(spark: SparkSession, d: str) -> DataFrame:
    found = regions.state_at_centre(regions.region_table(views.labels(spark, d)), views.states(spark, d))
    return found.select(*PLANE, *longs("label", "x", "y"), "semantic_raw")


@query(
    f"""
WITH {views.REGIONS}
SELECT a.movie_id, a.frame, CAST(a.label AS BIGINT) AS label, CAST(b.label AS BIGINT) AS next_label, CAST((a.x - b.x) ** 2 + (a.y - b.y) ** 2 AS BIGINT) AS d2
FROM regions a JOIN regions b
ON a.movie_id = b.movie_id AND b.frame = a.frame + 1 AND (a.x - b.x) ** 2 + (a.y - b.y) ** 2 <= {RADIUS * RADIUS}
"""
)
def link_candidates(spark: SparkSession, d: str) -> DataFrame:
    found = linking.candidates(regions.region_table(views.labels(spark, d)), RADIUS)
    return found.select(*PLANE, *longs("label", "next_label"), "d2")


def _link(mode: str) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        options = linking.options(params.for_cell_type("hela"), mode)
        return linking.link(views.drift(spark, d), options).select(*PLANE, F.col("label").cast("long").alias("label"), "particle")

    return run


for _mode in params.MODES:
    QUERIES[f"link_{_mode}"] = _link(_mode)
    ORACLE_SQL[f"link_{_mode}"] = f"WITH {views.DRIFT} SELECT * FROM linked"


def _links(detections: DataFrame, mode: str, split: bool | None = None) -> DataFrame:
    found = linking.link(detections, linking.options(params.for_cell_type("hela"), mode), split)
    return found.select(*PLANE, F.col("label").cast("long").alias("label"), "particle")


@query(f"WITH {views.JUMP} SELECT * FROM jumped")
def link_adaptive_jump(spark: SparkSession, d: str) -> DataFrame:
    """The radius shrinks until the crowd comes apart, and a jump that vanilla links is too far."""
    return _links(views.jump(spark, d), "adaptive")


@query(f"WITH {views.MARCH} SELECT * FROM marched")
def link_predictive_march(spark: SparkSession, d: str) -> DataFrame:
    """Points are followed by their velocity where the nearest one is another's."""
    return _links(views.march(spark, d), "predictive")


@query(f"WITH {views.DRIFT} SELECT * FROM linked")
def link_parts(spark: SparkSession, d: str) -> DataFrame:
    """Independent parts of each movie linked by themselves, as a movie too large for a task is."""
    return _links(views.drift(spark, d), "vanilla", split=True)


@query()
def link_regions(spark: SparkSession, d: str) -> DataFrame:
    """Crowded regions: the links of tests against all permutations, on a table."""
    options = linking.options(params.for_cell_type("hela"), "vanilla", radius=RADIUS)
    return linking.link(regions.region_table(views.labels(spark, d)), options).select(*PLANE, "label", "particle")


# Dose response -----------------------------------------------------------------------------------------------------

Q = f"{views.DOSE}, q AS (SELECT round_even(quantile_cont(dose, 0.025), 0) AS low, round_even(quantile_cont(dose, 0.85), 0) AS high FROM dose)"
BINS = f"""{Q}, edges AS (SELECT i AS bin, 0.5 * low + i * 2.5 AS lft, 0.5 * low + (i + 1) * 2.5 AS rgt FROM q, range(0, 1000) t(i)
WHERE 0.5 * low + (i + 1) * 2.5 < 1.5 * high), binned AS (SELECT bin, dose, response, code FROM dose JOIN edges
ON dose > lft AND dose <= rgt)"""


@query(f"WITH {Q} SELECT low, high FROM q")
def dose_quantiles(spark: SparkSession, d: str) -> DataFrame:
    q = dose.rounded_quantiles(dose.complete(views.dose(spark, d)))
    return q.select(F.col("q")[0].alias("low"), F.col("q")[1].alias("high"))


def _binned(spark: SparkSession, d: str) -> tuple[DataFrame, float, float]:
    xy = dose.complete(views.dose(spark, d))
    low, high = dose.quantiles(xy)
    return dose.with_bin(xy, low, high), low, high


@query(f"WITH {BINS} SELECT DISTINCT d.dose, e.lft, e.rgt FROM dose d LEFT JOIN edges e ON d.dose > lft AND d.dose <= rgt")
def dose_bins(spark: SparkSession, d: str) -> DataFrame:
    binned, low, _ = _binned(spark, d)
    left, right = dose.bounds(F.col("bin"), low)
    return binned.select("dose", "bin").distinct().select("dose", left.alias("lft"), right.alias("rgt"))


@query(f"WITH {BINS} SELECT bin, {rounded_sql("avg(dose)")} AS dose, {rounded_sql("avg(response)")} AS response FROM binned GROUP BY bin")
def bin_means(spark: SparkSession, d: str) -> DataFrame:
    return rounded(dose.bin_means(_binned(spark, d)[0]), "dose", "response")


@query(f"WITH {BINS} SELECT e.bin, count(b.bin) AS n FROM edges e LEFT JOIN binned b ON e.bin = b.bin GROUP BY e.bin")
def bin_sizes(spark: SparkSession, d: str) -> DataFrame:
    binned, low, high = _binned(spark, d)
    return dose.bin_sizes(binned, len(dose.edges(low, high)) - 1)


@query(
    f"""
WITH {BINS} SELECT bin, {rounded_sql("stddev_samp(dose) / sqrt(count(*))")} AS dose, {rounded_sql("stddev_samp(response) / sqrt(count(*))")} AS response
FROM binned GROUP BY bin HAVING count(*) > 1
"""
)
def bin_stderrs(spark: SparkSession, d: str) -> DataFrame:
    return rounded(dose.bin_stderrs(_binned(spark, d)[0]), "dose", "response")


@query(
    f"""
WITH {views.DOSE} SELECT round(dose - (SELECT min(dose) FROM dose), 6) AS dose, count(*) AS n, {rounded_sql("sum(response)")} AS response FROM dose
GROUP BY 1
"""
)
def min_subtract(spark: SparkSession, d: str) -> DataFrame:
    shifted = rounded(dose.subtract_minimum(dose.complete(views.dose(spark, d)), "dose"), "dose")
    return rounded(shifted.groupBy("dose").agg(F.count("*").alias("n"), F.sum("response").alias("response")), "response")


@query(
    f"""
WITH {views.DOSE}
SELECT DISTINCT dose, round({CURVE[0]} + ({CURVE[1]} - {CURVE[0]}) * dose ** {CURVE[2]} / (dose ** {CURVE[2]} + {CURVE[3]}::DOUBLE ** {CURVE[2]}), 6) AS y
FROM dose
"""
)
def hill_curve(spark: SparkSession, d: str) -> DataFrame:
    xy = dose.complete(views.dose(spark, d)).select("dose").distinct()
    return rounded(xy.withColumn("y", hill.hill(F.col("dose"), *map(F.lit, CURVE))), "y")


def _exact_fit(spark: SparkSession, d: str) -> DataFrame:
    xy = views.exact_dose(spark, d).select(
        "dose", hill.hill(F.col("dose"), F.lit(4.0), F.col("high"), F.lit(3.0), F.lit(18.0)).alias("response"), "code",
    )
    return dose.fit(dose.complete(xy), ["code"])


@query(
    """
SELECT code, 4.0::DOUBLE AS min_duration, CASE code WHEN 'A' THEN 20.0 WHEN 'N' THEN 30.0
ELSE 40.0 END::DOUBLE AS max_duration, 3.0::DOUBLE AS hill_exponent, 18.0::DOUBLE AS ec50, 'converged' AS status
FROM (SELECT DISTINCT l_returnflag AS code FROM lineitem)
"""
)
def hill_fit(spark: SparkSession, d: str) -> DataFrame:
    """Responses on known curves give the curves' parameters."""
    return rounded(_exact_fit(spark, d), *hill.PARAMETERS, digits=3).select(
        "code", *[F.col(a).alias(b) for a, b in zip(hill.PARAMETERS, ("min_duration", "max_duration", "hill_exponent", "ec50"))],
        "status",
    )


@query(
    """
WITH codes AS (SELECT DISTINCT l_returnflag AS code, CASE l_returnflag WHEN 'A' THEN 20.0 WHEN 'N' THEN 30.0 ELSE 40.0 END::DOUBLE AS high FROM lineitem)
SELECT code, x, round(4 + (high - 4) * x ** 3 / (x ** 3 + 18.0::DOUBLE ** 3), 2) AS y FROM codes, (SELECT i::DOUBLE AS x FROM range(31) t(i))
"""
)
def fitted_curve(spark: SparkSession, d: str) -> DataFrame:
    """The curves that are fitted to each code's doses."""
    return rounded(dose.fitted_curve(_exact_fit(spark, d), 30.5, ["code"]), "y", digits=2)


@query()
def hill_fit_prices(spark: SparkSession, d: str) -> DataFrame:
    return dose.fit(dose.complete(views.dose(spark, d)), ["code"])


@query(f"WITH {views.DOSE} SELECT round_even(quantile_cont(response, 0.99), 0) AS y_limit FROM dose")
def plot_limit(spark: SparkSession, d: str) -> DataFrame:
    return dose.plot_limit(dose.complete(views.dose(spark, d)))


# Wells and experiments ---------------------------------------------------------------------------------------------


@query(f"WITH {views.WELLMAP} SELECT * FROM wellmap")
def wellmap(spark: SparkSession, d: str) -> DataFrame:
    return wells.wellmap(views.wellmap(spark, d), order="p_partkey").select(
        *wells.GROUP, F.array_join("wells", ",").alias("wells"), F.size("wells").cast("long").alias("n_wells"),
    )


@query(f"WITH {views.WELLMAP} SELECT * FROM wellmap")
def wellmap_lists(spark: SparkSession, d: str) -> DataFrame:
    found = wells.wellmap(views.wellmap_lists(spark, d), order="p_partkey")
    return found.select(*wells.GROUP, F.array_join("wells", ",").alias("wells"), F.size("wells").cast("long").alias("n_wells"))


@query(
    f"""
WITH {views.FILES} SELECT movie_id, name, value FROM movies, (VALUES ('cell_type', 'u2os'), ('min_cell_size', '250'), ('max_cell_size', '9500'), ('max_pixel_movement', '30'), ('memory', '1'),
  ('min_track_length', '10'), ('track_mode', 'predictive'), ('adaptive_step', '0.9'), ('adaptive_stop', '10.0'), ('predict_span', '3'),
  ('median_frames', '3'), ('closing_frames', '3'), ('erosion_radius', '3'), ('min_mitotic_duration', '30'), ('frame_interval', '10'),
  ('gaussian_sigma', '45.0')) AS t(name, value)
"""
)
def parameter_sheet(spark: SparkSession, d: str) -> DataFrame:
    """The parameters that each movie's workbooks come from."""
    return experiment.parameters(discovery.movies(discovery.classified(views.files(spark, d))), params.for_cell_type("U2OS"))


@query(
    "SELECT CAST(c_custkey AS VARCHAR) AS movie_id, unnest(['c_name', 'c_mktsegment']) AS name, unnest([c_name, c_mktsegment]) AS value FROM customer"
)
def file_sheet(spark: SparkSession, d: str) -> DataFrame:
    rows = tables.table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("movie_id"), "c_name", "c_mktsegment")
    return experiment.key_values(rows)


@query(f"WITH {views.FILES} SELECT DISTINCT home, folder FROM files WHERE contains(folder, '_inference')")
def inference_folders(spark: SparkSession, d: str) -> DataFrame:
    return discovery.inference_folders(discovery.classified(views.files(spark, d)))


@query(f"WITH {views.FILES} SELECT * FROM movies")
def movie_files(spark: SparkSession, d: str) -> DataFrame:
    return discovery.movies(discovery.classified(views.files(spark, d)))


@query(
    f"""
WITH {views.FILES}
SELECT movie_id, CASE WHEN ch = 'phs' THEN 'phase' ELSE ch END AS channel, path FROM movies m JOIN files f
ON f.home = m.data_dir AND contains(f.file, m.stub || '_') WHERE ch <> '' AND map = '' AND role = ''
QUALIFY row_number() OVER (PARTITION BY movie_id, ch ORDER BY ends_with(path, '.tiff') DESC, path DESC) = 1
"""
)
def channel_files(spark: SparkSession, d: str) -> DataFrame:
    found = discovery.classified(views.files(spark, d))
    return discovery.channels(found, discovery.movies(found))


@query(
    f"WITH {views.FILES} SELECT concat(ch, '_', map, '_map') AS correction_map, max(path) AS path FROM files WHERE map <> '' AND ch <> '' GROUP BY ALL"
)
def map_files(spark: SparkSession, d: str) -> DataFrame:
    return discovery.correction_maps(discovery.classified(views.files(spark, d)))


STUB_SQL, POSITION_SQL, CHANNEL_SQL_, MAP_SQL, ROLE_SQL = names.STUB, names.POSITION, names.CHANNEL, names.MAP_KIND, names.MASK_ROLE


@query(
    f"""
WITH {views.NAMES} SELECT id, regexp_extract(file, '{STUB_SQL}', 0) AS stub, CASE WHEN regexp_extract(file, '{STUB_SQL}', 0) = '' THEN ''
ELSE split_part(file, regexp_extract(file, '{STUB_SQL}', 0), 1) END AS prefix, regexp_extract(file, '{POSITION_SQL}', 2) AS position
FROM names
"""
)
def name_parse(spark: SparkSession, d: str) -> DataFrame:
    file = F.col("file")
    return views.names(spark, d).select(
        "id", names.stub(file).alias("stub"), names.prefix(file).alias("prefix"), names.position(file).alias("position"),
    )


@query(
    f"""
WITH {views.NAMES} SELECT id, CASE WHEN regexp_extract(image, '{CHANNEL_SQL_}') = 'phs' THEN 'phase'
WHEN regexp_extract(image, '{CHANNEL_SQL_}') <> '' THEN regexp_extract(image, '{CHANNEL_SQL_}') END AS channel, CASE
WHEN regexp_extract(image, '{MAP_SQL}') <> '' AND regexp_extract(image, '{CHANNEL_SQL_}') <> '' THEN concat(regexp_extract(image, '{CHANNEL_SQL_}'), '_', regexp_extract(image, '{MAP_SQL}'), '_map') END AS correction_map, CASE
WHEN regexp_extract(image, '{ROLE_SQL}') <> '' AND ends_with(image, '.tif') THEN regexp_extract(image, '{ROLE_SQL}') END AS role
FROM names
"""
)
def channel_classify(spark: SparkSession, d: str) -> DataFrame:
    image = F.col("image")
    return views.names(spark, d).select(
        "id", names.channel(image).alias("channel"), names.correction_map(image).alias("correction_map"),
        names.mask_role(image).alias("role"),
    )


@query(
    f"""
WITH {views.NAMES}, listed AS (SELECT DISTINCT well FROM names WHERE id % 50 = 0)
SELECT n.id, l.well, regexp_extract(n.file, '{POSITION_SQL}', 2) AS position, '/data' AS storage_location FROM names n JOIN listed l
ON contains(n.folder, '_' || l.well || '_') AND ends_with(n.folder, '_inference')
"""
)
def well_folders(spark: SparkSession, d: str) -> DataFrame:
    rows = views.names(spark, d)
    return wells.compile_summaries(
        rows.select("id", "folder", "file"), rows.filter("id % 50 = 0").select("well"), "/data",
    ).select("id", "well", "position", "storage_location")


@query(
    f"""
WITH {STATS} SELECT movie_id, particle, mitosis, CASE WHEN movie_id <> 0 THEN "GFP" END AS "GFP", CASE
WHEN movie_id = 0 THEN cell_area END AS cell_area FROM summary
"""
)
def compile_union(spark: SparkSession, d: str) -> DataFrame:
    rows = _summary(spark, d)
    first, others = rows.filter("movie_id = 0").select(*TRACK, "mitosis", "cell_area"), rows.filter("movie_id <> 0").select(*TRACK, "mitosis", "GFP")
    return wells.union_all(spark, [first, others], "movie_id long, particle long, mitosis double, cell_area double, GFP double")


EVENTS_SQL = f"""{STATS}, kept AS (SELECT movie_id, particle, mito_start, mitosis * 10 AS mitosis FROM summary
WHERE mito_start > 0 AND mito_start + mitosis < 60)"""


@query(f"WITH {EVENTS_SQL} SELECT * FROM kept")
def event_filter(spark: SparkSession, d: str) -> DataFrame:
    return wells.event_filter(_summary(spark, d).select(*TRACK, "mito_start", "mitosis"), 60, 10)


@query(
    f"""
WITH {EVENTS_SQL}, {views.WELLMAP}, named AS (SELECT k.*, ['small', 'ring', 'bolt', 'nut'][particle % 4 + 1] AS well FROM kept k)
SELECT n.movie_id, n.particle, n.mito_start, n.mitosis, n.well, concat(f.celltype, '_', f.transfection, '_', f.drug) AS code FROM named n
JOIN firsts f ON n.well = f.well
"""
)
def experiment_import(spark: SparkSession, d: str) -> DataFrame:
    names_ = F.array(*[F.lit(w) for w in ("small", "ring", "bolt", "nut")])
    rows = _summary(spark, d).select(*TRACK, "mito_start", "mitosis", F.element_at(names_, (F.col("particle") % 4 + 1).cast("int")).alias("well"))
    groups = wells.wellmap(views.wellmap(spark, d), order="p_partkey")
    return wells.import_experiment(groups, rows, 60, 10).select(*TRACK, "mito_start", "mitosis", "well", "code")


@query(
    f"""
WITH {EVENTS_SQL}, {views.WELLMAP}, named AS (SELECT ['small', 'ring', 'bolt', 'nut'][particle % 4 + 1] AS well FROM kept),
rows_ AS (SELECT celltype, transfection, drug, count(*) AS n FROM named n JOIN firsts f ON n.well = f.well GROUP BY ALL)
SELECT concat(celltype, '_', transfection, '_', drug) AS code, n_wells AS wells, coalesce(n, 0) AS rows,
  CASE WHEN n IS NULL THEN 'no rows' ELSE 'loaded' END AS status FROM wellmap LEFT JOIN rows_ USING (celltype, transfection, drug)
"""
)
def import_report(spark: SparkSession, d: str) -> DataFrame:
    groups = wells.wellmap(views.wellmap(spark, d), order="p_partkey")
    return wells.import_report(groups, experiment_import(spark, d)).withColumn("wells", F.col("wells").cast("long"))


@query(
    f"""
WITH {views.TRACKS}, types AS (SELECT *
FROM (VALUES ('hela', 250::BIGINT, 4000::BIGINT, 20::BIGINT, 1::BIGINT, 10::BIGINT, 'vanilla'), ('ht1080', 250, 9000, 30, 1, 10, 'predictive'), ('u2os', 250, 9500, 30, 1, 10, 'predictive'), ('rpe1', 250, 9500, 30, 1, 10, 'predictive')) AS t(cell_type, min_size, max_size, radius, memory, min_length, mode)),
fit AS (SELECT cell_type, min_length, movie_id, particle, count(*) AS n FROM tracks JOIN types ON area > min_size AND area < max_size GROUP BY ALL),
kept AS (SELECT cell_type, sum(n) AS regions, count(*) FILTER (WHERE n >= min_length) AS tracks FROM fit GROUP BY cell_type)
SELECT t.*, CAST(coalesce(regions, 0) AS BIGINT) AS regions, coalesce(tracks, 0) AS tracks FROM types t LEFT JOIN kept USING (cell_type)
"""
)
def cell_params(spark: SparkSession, d: str) -> DataFrame:
    """Each cell type's parameters, with the regions of fit size and the tracks of fit length that they leave."""
    types = [params.for_cell_type(t) for t in params.CELL_TYPES]
    limits = F.array(*[F.struct(F.lit(t).alias("cell_type"), F.lit(p.min_cell_size).alias("low"), F.lit(p.max_cell_size).alias("high")) for t, p in zip(params.CELL_TYPES, types)])
    rows = views.tracks(spark, d).select(*TRACK, "area", F.inline(limits)).filter("area > low and area < high")
    fit = rows.groupBy("cell_type", *TRACK).agg(F.count("*").alias("n"))
    known = params.as_table(spark).select("cell_type", *longs("min_size", "max_size", "radius", "memory", "min_length"), "mode")
    kept = fit.join(F.broadcast(known), "cell_type").groupBy("cell_type").agg(F.sum("n").alias("regions"), F.count(F.when(F.col("n") >= F.col("min_length"), 1)).alias("tracks"))
    return known.join(F.broadcast(kept), "cell_type", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("regions", "tracks")})  # a row per cell type
