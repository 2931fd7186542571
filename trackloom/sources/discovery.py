"""What lies under an experiment's root folder: a row per file, classified by name. A movie is an inference folder's pair
of masks; its images lie in the folder above, whatever other experiments below the root are called."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackloom.functions import names


def parent(path: Column) -> Column:
    """The folder of a path, by its whole name."""
    return F.regexp_replace(path, "/[^/]*$", "")


def files(spark: SparkSession, root: str) -> DataFrame:
    """path, home (its folder's path), folder (that folder's name), file, and what the names say: stub, prefix, role
    (instance, semantic), channel, correction_map."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path")
    return classified(found.select("path", parent(F.col("path")).alias("home"), F.element_at(F.split("path", "/"), -1).alias("file")))


def classified(found: DataFrame) -> DataFrame:
    """found: path, home, file."""
    file = F.col("file")
    image = file.endswith(".tif") | file.endswith(".tiff")
    kind = names.correction_map(file)
    return found.select(
        "path", "home", F.element_at(F.split("home", "/"), -1).alias("folder"), "file", names.stub(file).alias("stub"), names.prefix(file).alias("prefix"),
        names.mask_role(file).alias("role"), F.when(image & kind.isNull(), names.channel(file)).alias("channel"), kind.alias("correction_map"),
    )


def _once(found: DataFrame, *columns: str) -> DataFrame:
    """The columns' different rows, found by hashes in each task. The first or last string of a group is found by sorting
    all rows of a task, before which Spark drops a plain distinct(); it keeps one whose count is used."""
    return found.groupBy(*columns).agg(F.count("*").alias("n__")).filter("n__ > 0").drop("n__")


def inference_folders(found: DataFrame) -> DataFrame:
    """home, folder: each folder with results once."""
    return found.filter(names.is_inference(F.col("folder"))).select("home", "folder").distinct()


def movies(found: DataFrame) -> DataFrame:
    """movie_id, stub, prefix, instance, semantic, home, data_dir: a movie for each inference folder that has both masks,
    the first file by path of each role. The semantic mask's name says well and site, what the instance mask's name holds
    before them is the prefix. movie_id is the folder's path with prefix and stub; images are looked for in data_dir, the
    folder above."""
    of_role = lambda r: F.min(F.when(F.col("role") == r, F.struct("path", "file"))).alias(r)
    masks = _once(found.filter(names.is_inference(F.col("folder")) & F.col("role").isNotNull()), "home", "role", "path", "file")
    pairs = masks.groupBy("home").agg(of_role("instance"), of_role("semantic")).dropna()
    named = pairs.withColumn("stub", names.stub(F.col("semantic.file"))).filter("stub <> ''")
    prefix = F.split_part(F.col("instance.file"), F.col("stub"), F.lit(1))
    return named.select(
        F.concat("home", F.lit("/"), prefix, "stub").alias("movie_id"), "stub", prefix.alias("prefix"), F.col("instance.path").alias("instance"),
        F.col("semantic.path").alias("semantic"), "home", parent(F.col("home")).alias("data_dir"),
    )


def channels(found: DataFrame, of: DataFrame) -> DataFrame:
    """movie_id, channel, path: for each of the movies `of` and each channel the last image by path, .tiff after .tif, in the
    movie's data_dir whose name holds the movie's stub and an underscore: A2_s123 isn't A2_s12. A folder's images are reduced
    to the last of each stub and channel before they meet movies."""
    named = found.filter(F.col("channel").isNotNull() & F.col("role").isNull())
    images = named.select(F.col("home").alias("lies_in"), "channel", "path", F.explode(F.array_distinct(names.stubs(F.col("file")))).alias("of_stub"))
    last = F.max_by("path", F.struct(F.col("path").endswith(".tiff"), F.col("path"))).alias("path")
    lasts = _once(images, "lies_in", "of_stub", "channel", "path").groupBy("lies_in", "of_stub", "channel").agg(last)
    met = of.join(lasts, (F.col("data_dir") == F.col("lies_in")) & (F.col("stub") == F.col("of_stub")))
    return met.groupBy("movie_id", "channel").agg(last)


def correction_maps(found: DataFrame) -> DataFrame:
    """correction_map, path: the last by path of each. Maps apply to all movies below the root."""
    maps = _once(found.filter("correction_map is not null"), "correction_map", "path")
    return maps.groupBy("correction_map").agg(F.max("path").alias("path"))
