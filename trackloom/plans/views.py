"""Track, plane, dose and well views over the given tables, each as a DataFrame and as SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackloom.functions.names import CHANNEL, MAP_KIND, MASK_ROLE, STUB
from trackloom.sources.tables import table


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per event: users are particles, three movies by user_id, frames in order of time, errors are mitotic."""
    k = F.regexp_extract("props", r"\d+", 0).try_cast("long")
    frame = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1
    rows = table(spark, sf_dir, "events").select(
        (F.col("user_id") % 3).alias("movie_id"), F.col("user_id").alias("particle"), frame.cast("long").alias("frame"), k.alias("k"), F.col("value").alias("value"),
        F.when(F.col("event_type") == "error", 101).otherwise(F.col("event_id") % 3).cast("long").alias("semantic_raw"),
    )
    kk, v = F.col("k"), F.col("value")
    return rows.select(
        "movie_id", "particle", "frame", "semantic_raw", F.floor(v).cast("long").alias("x"), kk.alias("y"), (200.0 + kk * 50).alias("area"),
        v.alias("GFP"), (kk / 10).alias("GFP_bkg_corr"), (1 + kk % 5 / 10).alias("GFP_int_corr"),
        (v * kk / 100).alias("Texas Red"), F.lit(0.0).alias("Texas Red_bkg_corr"), F.lit(1.0).alias("Texas Red_int_corr"),
        F.when(kk >= 10, v - kk).alias("Cy5"), F.lit(0.0).alias("Cy5_bkg_corr"), F.lit(0.0).alias("Cy5_int_corr"),
    )


TRACKS = r"""tracks AS (
  SELECT user_id % 3 AS movie_id, user_id AS particle, frame, semantic_raw, CAST(floor(value) AS BIGINT) AS x, k AS y, 200.0::DOUBLE + k * 50 AS area,
    value AS "GFP", k / 10 AS "GFP_bkg_corr", 1 + k % 5 / 10 AS "GFP_int_corr",
    value * k / 100 AS "Texas Red", 0::DOUBLE AS "Texas Red_bkg_corr", 1::DOUBLE AS "Texas Red_int_corr",
    CASE WHEN k >= 10 THEN value - k END AS "Cy5", 0::DOUBLE AS "Cy5_bkg_corr", 0::DOUBLE AS "Cy5_int_corr"
  FROM (SELECT *, TRY_CAST(regexp_extract(props, '\d+') AS BIGINT) AS k,
      row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame,
      CASE WHEN event_type = 'error' THEN 101 ELSE event_id % 3 END AS semantic_raw FROM events))"""


def _smooth_sql(keys: str, order: str, name: str = "smooth") -> str:
    return f"""
recoded AS (SELECT *, CASE WHEN semantic_raw < 100 THEN 1 ELSE semantic_raw END AS s FROM tracks),
filtered AS (SELECT *, list_sort([coalesce(lag(s) OVER w, 0), s, coalesce(lead(s) OVER w, 0)])[2] AS semantic FROM recoded WINDOW w AS (PARTITION BY {keys} ORDER BY {order})),
leveled AS (SELECT *, CAST(floor((semantic - 1) / 99) AS BIGINT) AS lvl FROM filtered),
dilated AS (SELECT *, max(lvl) OVER (PARTITION BY {keys} ORDER BY {order} ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS d FROM leveled),
closed AS (SELECT *, min(d) OVER (PARTITION BY {keys} ORDER BY {order} ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS semantic_smoothed FROM dilated),
{name} AS (SELECT *, max(CASE WHEN semantic = 101 THEN 1 ELSE 0 END) OVER (PARTITION BY movie_id, particle) AS mitotic FROM closed)"""


SMOOTH = TRACKS + "," + _smooth_sql("movie_id", "particle, frame")
SMOOTH_TRACK = TRACKS + "," + _smooth_sql("movie_id, particle", "frame")
RUNS = (
    SMOOTH
    + """,
placed AS (SELECT movie_id, particle, frame, semantic_smoothed, row_number() OVER (PARTITION BY movie_id, particle ORDER BY frame) - 1 AS pos FROM smooth WHERE mitotic = 1),
islands AS (SELECT *, pos - row_number() OVER (PARTITION BY movie_id, particle, semantic_smoothed ORDER BY frame) AS island FROM placed),
runs AS (SELECT movie_id, particle, min(pos) - 1 AS mito_start, CAST(count(*) AS DOUBLE) AS mitosis FROM islands WHERE semantic_smoothed > 0
  GROUP BY movie_id, particle, island HAVING min(pos) > 0 AND count(*) >= 3),
peaks AS (SELECT t.movie_id, t.particle, count(r.mitosis) AS n_peaks FROM (SELECT DISTINCT movie_id, particle FROM smooth WHERE mitotic = 1) t
  LEFT JOIN runs r ON t.movie_id = r.movie_id AND t.particle = r.particle GROUP BY t.movie_id, t.particle)"""
)

#: Planes of 8 x 8 pixels.
SIDE = 8


def planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plane per vector, ten to a movie; pixels are the components."""
    return table(spark, sf_dir, "embeddings").select(
        F.floor(F.col("vec_id") / 10).alias("movie_id"), (F.col("vec_id") % 10).alias("frame"), F.lit(SIDE).alias("height"),
        F.lit(SIDE).alias("width"), F.col("embedding").cast("array<double>").alias("pixels"),
    )


def channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels a hundredfold."""
    return planes(spark, sf_dir).withColumn("pixels", F.transform("pixels", lambda v: v * 100))


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """2 over 0.1, 1 over 0, else 0."""
    return planes(spark, sf_dir).withColumn("pixels", F.transform("pixels", lambda v: F.when(v > 0.1, 2).when(v > 0, 1).otherwise(0)))


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planes(spark, sf_dir).withColumn("pixels", F.transform("pixels", lambda v: F.when(v > 0.05, 101).when(v > -0.05, 100).otherwise(2)))


def small_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels at every other row and column, so that a channel plane has twice their size."""
    at = F.array(*[F.lit(2 * SIDE * r + 2 * c + 1) for r in range(SIDE // 2) for c in range(SIDE // 2)])
    return labels(spark, sf_dir).withColumn(
        "pixels", F.transform(at, lambda i: F.element_at("pixels", i)),
    ).withColumn("height", F.lit(SIDE // 2)).withColumn("width", F.lit(SIDE // 2))


PIXELS = """pixels AS (
  SELECT movie_id, frame, (i - 1) // 8 AS r, (i - 1) % 8 AS c, CAST(v AS DOUBLE) AS v, CASE WHEN v > 0.1 THEN 2 WHEN v > 0 THEN 1 ELSE 0 END AS label
  FROM (SELECT vec_id // 10 AS movie_id, vec_id % 10 AS frame, unnest(embedding) AS v, unnest(range(1, 65)) AS i FROM embeddings))"""
REGIONS = (
    PIXELS
    + """,
moments AS (SELECT movie_id, frame, label, CAST(count(*) AS DOUBLE) AS area, avg(r) AS mr, avg(c) AS mc, var_pop(r) AS vr, var_pop(c) AS vc, covar_pop(r, c) AS vrc,
  min(r) AS b0, min(c) AS b1, max(r) + 1 AS b2, max(c) + 1 AS b3 FROM pixels WHERE label <> 0 GROUP BY ALL),
axes AS (SELECT *, (vr + vc) / 2 AS half, sqrt(((vr - vc) / 2) ** 2 + vrc ** 2) AS apart FROM moments),
regions AS (SELECT movie_id, frame, label, CAST(trunc(mr) AS BIGINT) AS x, CAST(trunc(mc) AS BIGINT) AS y, area,
  CASE WHEN half + apart > 0 THEN sqrt(greatest(1 - greatest(half - apart, 0) / (half + apart), 0)) ELSE 0 END AS eccentricity, b0 AS "bbox-0", b1 AS "bbox-1", b2 AS "bbox-2", b3 AS "bbox-3" FROM axes)"""
)


def dose(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_quantity").alias("dose"), (F.col("l_extendedprice") / 1000).alias("response"),
        F.col("l_returnflag").alias("code"),
    )


DOSE = "dose AS (SELECT CAST(l_quantity AS DOUBLE) AS dose, l_extendedprice / 1000 AS response, l_returnflag AS code FROM lineitem WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL)"


def wellmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("celltype"), F.col("p_type").alias("transfection"),
        F.concat(F.lit("d"), (F.col("p_size") % 3).cast("string")).alias("drug"), F.col("p_name").alias("well_ids"), "p_partkey",
    )


WELLMAP = r"""wells AS (
  SELECT p_brand AS celltype, p_type AS transfection, 'd' || (p_size % 3) AS drug, p_partkey, unnest(list_filter(regexp_split_to_array(p_name, '[,;\s]+'), lambda x: x <> '')) AS well,
    generate_subscripts(list_filter(regexp_split_to_array(p_name, '[,;\s]+'), lambda x: x <> ''), 1) AS nth FROM part),
firsts AS (SELECT celltype, transfection, drug, well, min([p_partkey, nth]) AS first FROM wells WHERE celltype IS NOT NULL AND transfection IS NOT NULL AND drug IS NOT NULL GROUP BY ALL),
wellmap AS (SELECT celltype, transfection, drug, string_agg(well, ',' ORDER BY first, well) AS wells, count(*) AS n_wells FROM firsts GROUP BY ALL)"""


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File and folder names made up from customer keys."""
    key = F.col("c_custkey")
    row = F.element_at(F.array(*[F.lit(x) for x in "ABCDEFGH"]), (key % 8 + 1).cast("int"))
    well = F.concat(row, F.lpad((key % 14).cast("string"), 2, "0"))
    site = F.concat(F.lit("s"), (key % 120).cast("string"))
    dated = F.when(key % 7 == 0, F.lit("exp_20240101")).otherwise(F.lit("exp"))
    kind = F.element_at(
        F.array(*[F.lit(x) for x in ("GFP", "Texas Red", "Cy5", "phs", "GFP_background", "Cy5_intensity", "instance", "other")]),
        (F.floor(key / 8) % 8 + 1).cast("int"),
    )
    return table(spark, sf_dir, "customer").select(
        key.alias("id"), F.concat_ws("_", dated, well, site, F.lit("summary.xlsx")).alias("file"), F.concat_ws(
            "_", dated, well, site, F.concat(kind, F.when(key % 3 == 0, ".tiff").otherwise(".tif")),
        ).alias("image"),
        F.concat_ws("_", dated, well, site, F.lit("inference")).alias("folder"), well.alias("well"),
    )


NAMES = r"""names AS (
  SELECT c_custkey AS id, concat(dated, '_', well, '_', site, '_summary.xlsx') AS file, concat(dated, '_', well, '_', site, '_', kind, CASE WHEN c_custkey % 3 = 0 THEN '.tiff' ELSE '.tif' END) AS image,
    concat(dated, '_', well, '_', site, '_inference') AS folder, well
  FROM (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'exp_20240101' ELSE 'exp' END AS dated, 'ABCDEFGH'[c_custkey % 8 + 1] || lpad(CAST(c_custkey % 14 AS VARCHAR), 2, '0') AS well, 's' || (c_custkey % 120) AS site,
    ['GFP', 'Texas Red', 'Cy5', 'phs', 'GFP_background', 'Cy5_intensity', 'instance', 'other'][(c_custkey // 8) % 8 + 1] AS kind FROM customer))"""


def drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six points a plane, 100 apart, that move by a pixel or two from frame to frame and are missing now and then."""
    e = F.col("embedding")
    point = lambda j: F.struct(F.lit(j).alias("label"), (100 * j + 4 * e[j]).alias("x"), (4 * e[j + 8]).alias("y"), (e[j + 16] > 0.1).alias("missing"))
    points = table(spark, sf_dir, "embeddings").select(
        F.floor(F.col("vec_id") / 10).alias("movie_id"), (F.col("vec_id") % 10).alias("frame"),
        F.inline(F.array(*map(point, range(6)))),
    )
    return points.filter("not missing").drop("missing")


#: A point keeps its particle over one missing frame; particles are counted by first frame, then from left to right.
DRIFT = """points AS (
  SELECT vec_id // 10 AS movie_id, vec_id % 10 AS frame, j AS label FROM embeddings, range(6) t(j) WHERE embedding[j + 17] <= 0.1),
gaps AS (SELECT *, frame - lag(frame) OVER w > 2 AS fresh FROM points WINDOW w AS (PARTITION BY movie_id, label ORDER BY frame)),
runs_ AS (SELECT *, sum(CASE WHEN fresh THEN 1 ELSE 0 END) OVER (PARTITION BY movie_id, label ORDER BY frame) AS run FROM gaps),
firsts_ AS (SELECT movie_id, label, run, min(frame) AS first FROM runs_ GROUP BY movie_id, label, run),
born AS (SELECT movie_id, label, run, row_number() OVER (PARTITION BY movie_id ORDER BY first, label) - 1 AS particle FROM firsts_),
linked AS (SELECT movie_id, frame, CAST(label AS BIGINT) AS label, particle FROM runs_ JOIN born USING (movie_id, label, run))"""


def jump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """25 points a plane on a grid 16 apart, which tremble along y; the last one jumps by 17 before the sixth frame."""
    e = F.col("embedding")
    away = lambda j: F.when((F.lit(j) == 24) & (F.col("vec_id") % 10 >= 5), 17.0).otherwise(0.0)
    point = lambda j: F.struct(F.lit(j).alias("label"), (16.0 * (j // 5) + away(j)).alias("x"), (16.0 * (j % 5) + e[j]).alias("y"))
    return table(spark, sf_dir, "embeddings").select(F.floor(F.col("vec_id") / 10).alias("movie_id"), (F.col("vec_id") % 10).alias("frame"), F.inline(F.array(*map(point, range(25)))))


#: Too many points are within the radius of each other; under the radius that tells them apart, the jump is too far.
JUMP = """jumped AS (SELECT vec_id // 10 AS movie_id, vec_id % 10 AS frame, j AS label, CASE WHEN j = 24 AND vec_id % 10 >= 5 THEN 25 ELSE j END AS particle
  FROM embeddings, range(25) t(j))"""

#: Where a row of points stands in each frame: it speeds up to 15 a frame.
MARCH_STEPS = [0, 5, 15, 30, 45, 60, 75, 90, 105, 120]


def march(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six points 25 apart in a row that marches on along x, so that a point comes nearer to where its follower was than to
    where it was itself."""
    frame = (F.col("vec_id") % 10).cast("int")
    at = F.element_at(F.array(*[F.lit(float(s)) for s in MARCH_STEPS]), frame + 1)
    point = lambda j: F.struct(F.lit(j).alias("label"), (25.0 * j + at + F.col("embedding")[j]).alias("x"), F.col("embedding")[j + 8].cast("double").alias("y"))
    return table(spark, sf_dir, "embeddings").select(F.floor(F.col("vec_id") / 10).alias("movie_id"), frame.cast("long").alias("frame"), F.inline(F.array(*map(point, range(6)))))


MARCH = "marched AS (SELECT vec_id // 10 AS movie_id, vec_id % 10 AS frame, j AS label, j AS particle FROM embeddings, range(6) t(j))"


def exact_dose(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses on a Hill curve for each code, with one dose to a bin: the fit must give its parameters back."""
    dose_ = 2.5 * (F.floor("l_quantity") % 20 + 1) - 0.5
    high = F.when(F.col("l_returnflag") == "A", 20.0).when(F.col("l_returnflag") == "N", 30.0).otherwise(40.0)
    return table(spark, sf_dir, "lineitem").select(dose_.alias("dose"), high.alias("high"), F.col("l_returnflag").alias("code"))


def wellmap_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The well map with its wells as lists, blanks and nulls among them."""
    wells = F.concat(F.split("well_ids", "[,;\\s]+"), F.array(F.lit(" "), F.lit(None).cast("string")))
    return wellmap(spark, sf_dir).withColumn("well_ids", F.transform(wells, lambda w: F.concat(F.lit(" "), w, F.lit(" "))))


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """path, home, file of made-up masks and images. Each name lies in two of three experiments, masks in an inference folder
    there (every fourth has no semantic mask), images beside it; sites of three digits are cut short by the stub."""
    made = names(spark, sf_dir).withColumn("e", F.explode(F.array(*map(F.lit, range(3))))).filter("(id + e) % 3 <> 0")
    above, stem = F.concat(F.lit("/data/e"), F.col("e").cast("string")), F.replace("file", F.lit("_summary.xlsx"))
    masks = F.concat_ws("/", above, "folder")
    file = lambda home, name: F.struct(home.alias("home"), name.alias("file"))
    listed = F.array(
        file(masks, F.concat(stem, F.lit("_instance.tif"))), file(masks, F.when(F.col("id") % 4 > 0, F.concat(stem, F.lit("_semantic.tif")))),
        file(above, F.col("image")), file(above, F.concat(F.lit("A01_s1_"), F.col("image"))),
    )
    rows = made.select(F.inline(listed)).filter("file is not null").distinct()
    return rows.select(F.concat_ws("/", "home", "file").alias("path"), "home", "file")


FILES = (
    NAMES
    + f""",
made_ AS (SELECT *, '/data/e' || e AS above, replace(file, '_summary.xlsx', '') AS stem FROM names, range(3) t(e) WHERE (id + e) % 3 <> 0),
listed_ AS (SELECT above || '/' || folder AS home, stem || '_instance.tif' AS file FROM made_
  UNION SELECT above || '/' || folder, stem || '_semantic.tif' FROM made_ WHERE id % 4 > 0
  UNION SELECT above, image FROM made_ UNION SELECT above, 'A01_s1_' || image FROM made_),
files AS (SELECT concat(home, '/', file) AS path, home, split_part(home, '/', -1) AS folder, file, regexp_extract(file, '{CHANNEL}') AS ch,
    regexp_extract(file, '{MAP_KIND}') AS map, CASE WHEN ends_with(file, '.tif') THEN regexp_extract(file, '{MASK_ROLE}') ELSE '' END AS role FROM listed_),
pairs_ AS (SELECT home, min(file) FILTER (WHERE role = 'instance') AS i, min(file) FILTER (WHERE role = 'semantic') AS s FROM files WHERE contains(folder, '_inference') GROUP BY home),
movies AS (SELECT concat(home, '/', split_part(i, regexp_extract(s, '{STUB}', 0), 1), regexp_extract(s, '{STUB}', 0)) AS movie_id, regexp_extract(s, '{STUB}', 0) AS stub,
    split_part(i, regexp_extract(s, '{STUB}', 0), 1) AS prefix, concat(home, '/', i) AS instance, concat(home, '/', s) AS semantic, home, regexp_replace(home, '/[^/]*$', '') AS data_dir
  FROM pairs_ WHERE i IS NOT NULL AND s IS NOT NULL AND regexp_extract(s, '{STUB}', 0) <> '')"""
)

#: Shares of an 8-pixel line's pixel c2 in the blurred pixel c, edges repeated.
BLUR = """taps AS (SELECT o, exp(-0.5 * (o / 45.0) ** 2) / (SELECT sum(exp(-0.5 * (o / 45.0) ** 2)) FROM range(-180, 181) t(o)) AS w FROM range(-180, 181) t(o)),
share AS (SELECT c, greatest(least(c + o, 7), 0) AS c2, sum(w) AS w FROM range(8) i(c), taps GROUP BY ALL)"""
