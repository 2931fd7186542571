"""Mixing sources to target weights by weighted fair queueing. DataFrame functions only.

Every source is a queue of its documents in a shuffled order, repeated up to `max_repeats` times, and sends them in
packets of at most `packet_words` words. A packet's virtual finish time is the number of words that its source has sent
by the packet's end, divided by the source's target. All packets of all sources are range-sorted by that time and the
sorted stream is cut where it reaches the total budget, the words of all documents: what stands before the cut is the
mix. No source has a quota; its share follows from its finish times, and is off its target by about a packet.

Targets share the budget by weight; a target stops at `max_repeats` times its source's words, and the excess goes to
the others by weight (water filling).

`mix` cuts documents into packets, so that a source with few but long documents meets its target too. `apply_mix` keeps
documents whole: a packet is a document, and one that begins before the cut is in the mix.

Running sums over skewed sources come from range sorts: rows are dealt to ranges of about RANGE_ROWS by (source, key,
row), sums of the ranges give each range's beginning and a window inside a range the rest. So neither a large source nor
a repeated doc_id gathers in one task. Packets that can't be before the cut are left out beforehand, by the proof in
`_latest`.

Defined results: a row is a document, however many rows share its doc_id or have none, and is reported and mixed by
itself; a null text has 0 words and is never taken; a null source is a source of its own, last in order; packets that
finish together are sent in order of doc_id, pass and place, and rows that share these in any order; very long texts are
counted whole; an empty table gives an empty result; other columns, whatever their names, are ignored by `mix` and
carried by `apply_mix`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackloom.llm.common import WORD, written

PACKET_WORDS = 64
#: Rows of a range on average, up to MAX_RANGES ranges, beyond which ranges grow.
RANGE_ROWS, MAX_RANGES = 50_000, 20_000


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...], max_repeats: int) -> DataFrame:
    """(source, source_size) with a row per source -> plus weight, target double.

    Sorted by cap over weight, the sources that end at their cap come first. A source is capped if the level that
    remains when all before it are capped would take it over its cap; the first that is not has the level of all the
    rest. Rows are sources, not documents."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    by_need = Window.orderBy((F.col("cap") / F.col("weight")), F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(0))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    level = (F.col("total") - F.col("caps_before")) / F.col("weight_left")
    return (
        sources.withColumn("weight", weight.cast("double"))
        .withColumn("cap", F.col("source_size").cast("double") * max_repeats)
        .withColumn("total", F.sum("source_size").over(everything).cast("double"))
        .withColumn("caps_before", F.coalesce(F.sum("cap").over(by_need.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("weight_left", F.sum("weight").over(by_need.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("capped", F.col("cap") <= level * F.col("weight"))
        .withColumn("level", F.max(F.when(~F.col("capped"), level)).over(everything))
        .withColumn("target", F.when(F.col("capped"), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("level") * F.col("weight"))))
        .select("source", "source_size", "weight", "target")
    )


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def sized(rows: DataFrame) -> DataFrame:
    """rows (rid, doc_id, source, text) -> rid, doc_id, source, size, key: what the queues need; key is the shuffled
    order."""
    return rows.select(
        "rid", F.col("doc_id").alias("doc_id"), F.col("source").alias("source"), words(F.col("text")).alias("size"),
        F.md5(F.concat(F.lit("mix:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("key"),
    )


def _ranged(df: DataFrame, n_rows: int, order: list[Column | str], tag: str) -> DataFrame:
    """df sorted into ranges by `order`, with the range's number."""
    n = max(1, min(MAX_RANGES, -(-n_rows // RANGE_ROWS)))
    return written(df.repartitionByRange(n, *order).withColumn("range", F.spark_partition_id()), tag)


def _before(*keys: str) -> Window:
    return Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)


def queued(base: DataFrame, weights: tuple[int, ...], max_repeats: int) -> DataFrame:
    """rid, doc_id, source, size, source_size, target, start: words of the source's queue before each row."""
    ranged = _ranged(base, base.count(), [F.col("source").asc_nulls_last(), "key", "rid"], "mix-queues")
    held = written(ranged.groupBy("source", "range").agg(F.sum("size").alias("held")), "mix-sums")
    goal = targets(held.groupBy("source").agg(F.sum("held").alias("source_size")), weights, max_repeats)
    places = held.withColumn("range_start", F.coalesce(F.sum("held").over(_before("source").orderBy("range")), F.lit(0)))
    places = places.join(goal.withColumnRenamed("source", "of"), _same("source", "of")).select(
        "of", F.col("range").alias("of_range"), "range_start", "source_size", "target",
    )
    inside = ranged.withColumn("inside", F.coalesce(F.sum("size").over(_before("range", "source").orderBy("key", "doc_id", "size", "rid")), F.lit(0)))
    placed = inside.join(places, (F.col("range") == F.col("of_range")) & _same("source", "of"))
    return placed.select("rid", "doc_id", "source", "size", "source_size", "target", (F.col("range_start") + F.col("inside")).alias("start"))


def _latest(queue: DataFrame, max_repeats: int, packet: Column) -> tuple[int, float]:
    """(the budget, a virtual time that the cut can't pass). At time 1 + x a source has sent min((1 + x) target, all it
    has) less at most a packet. All targets together are the budget, so the cut is no later than an x at which what
    sources may send beyond their targets makes up for a packet each."""
    per_source = queue.groupBy("source").agg(F.max("source_size").alias("all"), F.max("target").alias("target"), F.max(packet).alias("packet"))
    steps = (1 / 64, 1 / 8, 1.0)
    spare = [F.sum(F.least(F.col("target") * x, F.col("all") * max_repeats - F.col("target"))) for x in steps]
    row = per_source.agg(F.coalesce(F.sum("all"), F.lit(0)), F.coalesce(F.sum("packet"), F.lit(0)), *spare).first()
    enough = [1 + x for x, more in zip(steps, row[2:]) if (more or 0) > row[1] + 1]
    return row[0], enough[0] if enough else float("inf")


def packets(queue: DataFrame, max_repeats: int, packet_words: int | None) -> tuple[DataFrame, int]:
    """(rid, doc_id, pass, place, words, finish, range: every packet that may be before the cut, sorted into ranges by
    finish; the budget). A source's n-th pass follows its (n-1)-th."""
    size = F.col("size")
    budget, latest = _latest(queue, max_repeats, size if packet_words is None else F.least(size, F.lit(packet_words)))
    passes = queue.filter("size > 0").select("*", F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))).alias("pass"))
    passes = passes.withColumn("begin", F.col("start") + F.col("pass") * F.col("source_size")).filter(F.col("begin") <= F.col("target") * latest)
    if packet_words is None:
        cut = passes.select("rid", "doc_id", "source", "target", "begin", "pass", F.lit(0).alias("place"), size.alias("words"), size.alias("end"))
    else:
        at = passes.select("*", F.explode(F.sequence(F.lit(0), F.floor((size - 1) / packet_words).cast("int"))).alias("place"))
        end = F.least(size, (F.col("place") + 1) * packet_words)
        cut = at.select(
            "rid", "doc_id", "source", "target", "begin", "pass", "place", (end - F.col("place") * packet_words).alias("words"),
            end.alias("end"),
        )
    cut = cut.withColumn("finish", (F.col("begin") + F.col("end")) / F.col("target")).filter(F.col("finish") <= latest).drop("begin", "end", "target")
    cut = written(cut, "mix-packets")
    return _ranged(cut, cut.count(), ["finish", "doc_id", "pass", "place", "rid"], "mix-stream"), budget


def stream(sent: DataFrame, budget: int) -> DataFrame:
    """The mix in order: doc_id, source, pass (from 0), place, words, finish, range and mixed_before (words before it);
    the packet in which the budget ends is cut there."""
    sums = sent.groupBy(F.col("range").alias("r")).agg(F.sum("words").alias("held"))
    sums = sums.select("r", F.coalesce(F.sum("held").over(_before().orderBy("r")), F.lit(0)).alias("range_start"))
    inside = sent.withColumn(
        "inside", F.coalesce(F.sum("words").over(_before("range").orderBy("finish", "doc_id", "pass", "place", "rid")), F.lit(0)),
    )
    placed = inside.join(sums, F.col("range") == F.col("r")).withColumn(
        "mixed_before", F.col("range_start") + F.col("inside"),
    ).filter(F.col("mixed_before") < budget)
    return placed.withColumn("words", F.least("words", budget - F.col("mixed_before"))).drop("r", "range_start", "inside", "rid")


def taken(sent: DataFrame, budget: int) -> DataFrame:
    """rid, taken (words), times: what of each row is before the cut. Ranges before the one in which the budget ends are
    taken as they are; only that one is gone through."""
    sums = sent.groupBy("range").agg(F.sum("words").alias("held"))
    sums = sums.withColumn("range_start", F.coalesce(F.sum("held").over(_before().orderBy("range")), F.lit(0)))
    last = sums.filter(F.col("range_start") < budget).orderBy(F.desc("range")).select("range", "range_start").first() or (-1, 0)
    left = F.lit(budget - last[1]) - F.coalesce(F.sum("words").over(_before("range").orderBy("finish", "doc_id", "pass", "place", "rid")), F.lit(0))
    crossed = sent.filter(F.col("range") == last[0]).withColumn("left", left).filter("left > 0").select("rid", "words", "left")
    before = sent.filter(F.col("range") < last[0]).select("rid", "words", F.col("words").alias("left"))
    return before.union(crossed).groupBy("rid").agg(F.sum(F.least("words", "left")).cast("long").alias("taken"), F.count("*").alias("times"))


def _numbered(docs: DataFrame) -> DataFrame:
    return docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "source", "text")


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeats: int = 3, packet_words: int = PACKET_WORDS) -> tuple[DataFrame, DataFrame]:
    """(stream, per document: doc_id, source, size, source_size, target, taken, a row for each row of docs)."""
    queue = written(queued(written(sized(_numbered(docs)), "mix-sizes"), weights, max_repeats), "mix-queued")
    sent, budget = packets(queue, max_repeats, packet_words)
    found = queue.join(taken(sent, budget).withColumnRenamed("rid", "t"), F.col("rid") == F.col("t"), "left")
    return stream(sent, budget), found.select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
    )


def apply_mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeats: int = 3) -> DataFrame:
    """docs with each row once for each pass in which the mix takes it, whole documents only; columns unchanged. Rows are
    numbered in a written copy, so that a decision belongs to a row and not to a doc_id."""
    rows = written(docs.select(F.monotonically_increasing_id().alias("rid"), F.struct("*").alias("row")), "mix-rows")
    base = sized(rows.select("rid", *[F.col("row").getField(c).alias(c) for c in ("doc_id", "source", "text")]))
    sent, budget = packets(written(queued(written(base, "mix-sizes"), weights, max_repeats), "mix-queued"), max_repeats, None)
    copies = taken(sent, budget).select(F.col("rid").alias("t"), F.col("times").cast("int").alias("times")).hint("shuffle_hash")  # not broadcast: rows grow with the corpus
    kept = rows.join(copies, F.col("rid") == F.col("t")).select("row", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


#: The report per document in DuckDB: packets in order of finish time, cut at the budget.
ORACLE_SQL = r"""
WITH base AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key
  FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM base GROUP BY source),
weighted AS (
  SELECT *, CAST([1, 2, 3][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight,
         CAST(source_size AS DOUBLE) * 3 AS cap, CAST(sum(source_size) OVER () AS DOUBLE) AS total
  FROM sources),
levels AS (
  SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted),
goal AS (
  SELECT source, source_size, CASE WHEN cap <= level * weight THEN cap
         ELSE least(cap, (max(CASE WHEN NOT cap <= level * weight THEN level END) OVER ()) * weight) END AS target
  FROM levels),
queued AS (
  SELECT b.doc_id, b.source, b.size, g.source_size, g.target,
         CAST(coalesce(sum(b.size) OVER (PARTITION BY b.source ORDER BY b.key, b.doc_id, b.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM base b JOIN goal g ON b.source IS NOT DISTINCT FROM g.source),
packets AS (
  SELECT doc_id, pass, place, least(64, size - 64 * place) AS words,
         CAST(start + pass * source_size + least(size, 64 * (place + 1)) AS DOUBLE) / target AS finish
  FROM (SELECT *, unnest(range((size + 63) // 64)) AS place FROM (SELECT *, unnest(range(3)) AS pass FROM queued WHERE size > 0))),
stream AS (
  SELECT doc_id, words, coalesce(sum(words) OVER (ORDER BY finish, doc_id, pass, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS mixed_before
  FROM packets),
mixed AS (
  SELECT doc_id, sum(greatest(0, least(words, (SELECT sum(size) FROM base) - mixed_before))) AS taken FROM stream GROUP BY doc_id)
SELECT q.doc_id, q.source, q.size, q.source_size, q.target, CAST(coalesce(m.taken, 0) AS BIGINT) AS taken
FROM queued q LEFT JOIN mixed m ON q.doc_id IS NOT DISTINCT FROM m.doc_id
"""
