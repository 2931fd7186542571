"""Well maps, summaries by well, and the labelled experiment table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.functions.names import position

GROUP = ["celltype", "transfection", "drug"]


def parse_wells(wells: Column, is_array: bool = False) -> Column:
    """Wells of a cell: text split at commas, semicolons and white space, or a list; null and blanks are none."""
    parts = F.transform(wells, lambda w: F.trim(w.cast("string"))) if is_array else F.split(wells, r"[,;\s]+")
    return F.coalesce(F.filter(parts, lambda w: w.isNotNull() & (w != "")), F.array().cast("array<string>"))


def wellmap(table: DataFrame, order: str, wells: str = "well_ids") -> DataFrame:
    """A row per (celltype, transfection, drug): its distinct wells in the order first met, rows ordered by the column
    `order`, since a table's rows have no order of their own.
    Groups with a null key are left out. A group's wells are a list; first places are found by well before."""
    missing = [c for c in (*GROUP, wells, order) if c not in table.columns]
    if missing:
        raise KeyError(f"required columns not found: {', '.join(missing)}")
    is_array = dict(table.dtypes)[wells].startswith("array")
    parsed = table.dropna(subset=GROUP).select(*GROUP, F.col(order).alias("rank__"), parse_wells(F.col(wells), is_array).alias("w__"))
    first = parsed.select(
        *GROUP, "rank__", F.posexplode_outer("w__").alias("at__", "well"),
    ).groupBy(*GROUP, "well").agg(F.min(F.struct("rank__", "at__")).alias("first__"))
    listed = first.groupBy(*GROUP).agg(F.sort_array(F.collect_list(F.when(F.col("well").isNotNull(), F.struct("first__", "well")))).alias("l__"))
    return listed.select(*GROUP, F.transform("l__", lambda s: s["well"]).alias("wells"))


def code() -> Column:
    return F.concat_ws("_", *GROUP)


def union_all(spark: SparkSession, parts: list[DataFrame], schema: str) -> DataFrame:
    """Rows of all parts under all their columns; no parts give an empty table of `schema`."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) if parts else spark.createDataFrame([], schema)


def well_parts(folder: Column) -> Column:
    """What may be a well in a folder's name: every run of its tokens that has an underscore on both sides. Joining on
    these is an equi join, where `contains` would pair all wells with all folders."""
    tokens = F.split(folder, "_")
    inner = F.sequence(F.lit(1), F.size(tokens) - 2)
    runs = F.flatten(
        F.transform(inner, lambda i: F.transform(F.sequence(i, F.size(tokens) - 2), lambda j: F.array_join(F.slice(tokens, i + 1, j - i + 1), "_")))
    )
    return F.when((F.size(tokens) > 2) & folder.endswith("_inference"), F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))


def compile_summaries(summaries: DataFrame, wells: DataFrame, storage_location: str) -> DataFrame:
    """Summary rows of each well's folders with well, position and storage_location. summaries has folder and file (names);
    wells has well, a row each. Positions come from the file's name; no wells give an empty table."""
    found = summaries.withColumn("well", F.explode(well_parts(F.col("folder"))))
    return found.join(wells.select("well").distinct(), "well").withColumn("position", position(F.col("file"))).withColumn("storage_location", F.lit(storage_location)).drop("folder", "file")


def event_filter(rows: DataFrame, expt_length: int, delta_t: float) -> DataFrame:
    """Events that begin after the first frame and end before the last; their duration in units of time."""
    kept = rows.filter((F.col("mito_start") > 0) & (F.col("mito_start") + F.col("mitosis") < expt_length))
    return kept.withColumn("mitosis", F.col("mitosis") * delta_t)


def import_experiment(groups: DataFrame, summaries: DataFrame, expt_length: int, delta_t: float) -> DataFrame:
    """Filtered rows of every group's wells, tagged with the group's code; a well in several groups gives its rows to each.
    groups: a well map; summaries: rows with a well. Groups without wells give none."""
    by_well = groups.filter(F.size("wells") > 0).select(code().alias("code"), F.explode("wells").alias("well"))
    return event_filter(summaries, expt_length, delta_t).join(by_well, "well")


def import_report(groups: DataFrame, imported: DataFrame) -> DataFrame:
    """code, wells, rows, status of each group: what the import found, in place of messages."""
    rows = imported.groupBy("code").agg(F.count("*").alias("rows"))
    named = groups.select(code().alias("code"), F.size("wells").alias("wells"))
    status = F.when(F.col("wells") == 0, "skipped: no wells").when(F.col("rows") == 0, "no rows").otherwise("loaded")
    return named.join(rows, "code", "left").select("code", "wells", F.coalesce("rows", F.lit(0)).alias("rows")).withColumn("status", status)
