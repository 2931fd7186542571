"""What the operators share: the cluster's shared folder, written intermediates, bounded samples, word rules."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word is a run of characters outside ASCII white space; bytes.split() of Python has the same rule.
WORD = r"[^\x20\x09-\x0D]+"
#: Folders that this process has set up, and the tables written so far.
_owned: set[str] = set()
_made: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which driver and executors share. Where the session names none, a temporary
    one is set in local mode; on a cluster executors would write to disks of their own, so that is an error."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="trackloom-")
        sc.setCheckpointDir(named)
    return named.rstrip("/")


def run_dir(spark: SparkSession) -> str:
    """The application's own folder below the shared one. It belongs to the application: its tables can be read for as
    long as it runs, and Spark's JVM removes the folder when it ends."""
    sc = spark.sparkContext
    folder = f"{shared_dir(spark)}/trackloom/{sc.applicationId}"
    path = sc._jvm.org.apache.hadoop.fs.Path(folder)
    if folder not in _owned:
        files = path.getFileSystem(sc._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _owned.add(folder)
    return folder


def written(df: DataFrame, tag: str, large_rows: bool = False) -> DataFrame:
    """df as a Parquet table in the run's folder, read again: lineage ends there, and lost executors cost no rework
    before it. Row order is not kept. Rows of half a megabyte or more are large: readers hold a row group of them at
    once, so these get row groups of 16."""
    spark = df.sparkSession
    path = f"{run_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    how = {"parquet.block.row.count.limit": 16} if large_rows else {}
    df.write.options(**how).parquet(path)
    _made.append(path)
    return spark.read.schema(df.schema).parquet(path)


def step(spark: SparkSession, make: Callable[[], DataFrame], tag: str) -> DataFrame:
    """What `make` returns, written; the tables written on the way to it are removed."""
    begun = len(_made)
    out = written(make(), tag)
    sc = spark.sparkContext
    for old in _made[begun:-1]:
        path = sc._jvm.org.apache.hadoop.fs.Path(old)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
    del _made[begun:-1]
    return out


def ids_and_texts(docs: DataFrame) -> DataFrame:
    """doc_id long and text string, whatever else docs holds."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def plain_names(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """docs with its columns named c0, c1, ..., so that no name clashes or needs quoting; the new name of each old one."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    return docs.toDF(*names), dict(zip(docs.columns, names))


def crc_bucket(doc_id: Column, n: int) -> Column:
    """crc32 of the id's decimal text, modulo n; null for a null id."""
    return F.crc32(doc_id.cast("string")) % F.lit(n)


def bounded_sample(df: DataFrame, key: str, n: int, by: str | None = None, most_values: int = 256) -> DataFrame:
    """(key, by): at most n distinct keys with their least `by`, those with the smallest hash of the key (ties by the key
    itself): the same on every run, however often a key repeats. With `by`, an equal part of n, one key at least, for each
    of its most_values most frequent values, of which at most n are kept. Counts of distinct keys say first which hashes
    can be among them, so no task meets many more rows of a value than it keeps."""
    digest = F.md5(F.col(key).cast("string"))
    hashed = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(16.0**8)
    share = lambda of, rows: (1.5 * of + 6 * of**0.5 + 30) / max(1, rows) + 1e-6  # noqa: E731  fewer than `of` hashes below it: never
    if by is None:
        keys = df.select(key).distinct()
        return keys.filter(hashed < share(n, keys.count())).orderBy(digest, F.col(key)).limit(n)
    keys = df.groupBy(key).agg(F.min(by).alias(by))
    counts = keys.groupBy(by).count().orderBy(F.desc("count"), by).limit(min(n, most_values)).collect()
    if not counts:
        return df.select(key, by).limit(0)
    each = max(1, n // len(counts))
    shares = F.create_map(*[F.lit(x) for r in counts for x in (r[0], share(each, r[1]))])
    near = keys.filter(hashed < F.element_at(shares, F.col(by)))
    ranked = near.withColumn("nth__", F.row_number().over(Window.partitionBy(by).orderBy(digest, F.col(key))))
    return ranked.filter(F.col("nth__") <= each).drop("nth__")


def labelled_texts(docs: DataFrame, picked: DataFrame) -> DataFrame:
    """picked, with the text of each document: a row for each doc_id of picked that docs has, however often it is there
    (the least text counts). picked has a row for each doc_id and some thousands in all, so it is broadcast."""
    labels = [c for c in picked.columns if c != "doc_id"]
    known = F.broadcast(picked.select(F.col("doc_id").alias("picked__"), *labels))
    rows = ids_and_texts(docs).join(known, F.col("doc_id") == F.col("picked__"))
    return rows.groupBy("doc_id").agg(*[F.first(c).alias(c) for c in labels], F.min("text").alias("text"))


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about max_bytes of `column` each, a single larger row aside: large batches are cut and
    small ones joined."""
    held: list[pa.RecordBatch] = []
    total = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_numpy(zero_copy_only=False)
        begin = 0
        for i, size in enumerate(sizes.tolist()):
            if total and total + size > max_bytes:
                held.append(batch.slice(begin, i - begin))
                yield _joined(held)
                begin, held, total = i, [], 0
            total += size
        held.append(batch.slice(begin))
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    parts = [p for p in parts if p.num_rows] or parts[:1]
    return parts[0] if len(parts) == 1 else pa.concat_batches(parts)
