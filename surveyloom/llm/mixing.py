"""Mixing sources to target weights by a low-discrepancy schedule (operator 3).

Every source gets a target of tokens (words): its share of all words by weight, at most ``MOST_REPEATS`` times what
it has, the excess going to the others by weight. The mix is a sequence of slots of ``BLOCK`` tokens. Slot ``i``
takes the golden-ratio point ``frac(i * phi)``, which cumulative target shares map to a source, so any stretch of
slots is close to the targets; slots are ranked per source. Each source's documents are shuffled by a hash,
laid end to end and repeated as often as needed, and cut into blocks of equal tokens. Block ``r`` of a source is
joined to its slot of rank ``r``. A source whose points don't suffice for its blocks gets the missing slots at the
end of the sequence; its last block ends where its target is met.

Defined cases: a null text has no words; a null source is one source, after all others; a document without words
is taken zero words; repeated rows are documents of their own; an empty table gives an empty result; columns beyond
the needed ones are ignored.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from surveyloom.llm.common import binary_list, map_slices, running_total, saved, slices_for, table, whole_text

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
BLOCK = 1024
# Points are whole numbers below 2**40; the step is the odd number next to 2**40 / golden ratio.
_BITS = 40
_STEP = 679540190581
_HALF = 1 << 20


def sized(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Add ``size``, the number of words, to the columns in ``keep``."""

    def run(batch: pa.RecordBatch) -> dict:
        return {"size": pa.array([len(text.split()) for text in binary_list(batch.column("_text"))], pa.int64())}

    return map_slices(docs.select(*keep, whole_text().alias("_text")), "_text", "size bigint", run, keep)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """Per source: ``source_no`` (order by code point, null last), ``source_size``, ``target`` and ``goal``.

    ``goal`` is the target in whole words. The level ``l`` of the targets ``min(most * size, l * weight)`` rises
    until their sum is reached: sources above their limit are fixed at it and the rest is shared out again.
    """
    found = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    kinds = F.array(*[F.lit(w) for w in weights])
    sources = saved(
        found.withColumn("source_no", place.cast("bigint"))
        .withColumn("weight", F.element_at(kinds, (F.col("source_no") % len(weights) + 1).cast("int"))), "sources",
    )
    limit = F.col("source_size") * most
    level = 0.0
    while True:
        above = F.lit(level) * F.col("weight") > limit
        row = sources.agg(
            F.sum("source_size").alias("total"),
            F.sum(F.when(above, limit).otherwise(0)).alias("fixed"),
            F.sum(F.when(above, 0).otherwise(F.col("weight"))).alias("open"),
        ).first()
        new = (row["total"] - row["fixed"]) / row["open"] if row["open"] else level  # no open source: all fixed, or none
        if new <= level:
            break
        level = new
    target = F.least(limit.cast("double"), F.lit(level) * F.col("weight"))
    return sources.withColumn("target", target).withColumn(
        "goal", F.least(limit, F.floor(F.col("target") + 0.5)).cast("bigint")
    ).select("source", "source_no", "source_size", "target", "goal")


def _point(i: Column) -> Column:
    """``i * _STEP mod 2**40`` without leaving 64 bits."""
    full = 1 << _BITS
    i = F.pmod(i, F.lit(full))
    high, low = F.floor(i / _HALF).cast("bigint"), i % _HALF
    return (((high * _STEP) % full) * _HALF % full + low * _STEP % full) % full


def schedule(plan: DataFrame, block: int = BLOCK) -> DataFrame:
    """Slots of the mix as (slot, source_no, rank); ``plan`` is the result of ``targets``.

    Points and sources meet in buckets of the point range, so that no point is compared with all sources.
    """
    spark = plan.sparkSession
    row = plan.agg(F.sum("goal").alias("goal"), F.sum(F.ceil(F.col("goal") / block)).alias("blocks")).first()
    n = row["blocks"] or 0
    if not n:
        return spark.createDataFrame([], "slot bigint, source_no bigint, rank bigint")
    buckets = max(1, n // 64)
    width = -(-(1 << _BITS) // buckets)
    ahead = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, -1)
    edge = plan.where("goal > 0").withColumn("_before", F.coalesce(F.sum("goal").over(ahead), F.lit(0)))

    def at(tokens: Column) -> Column:
        return F.floor(tokens.cast("decimal(20,0)") * F.lit(1 << _BITS).cast("decimal(13,0)") / F.lit(row["goal"])).cast("bigint")

    edge = edge.select(
        "source_no", F.ceil(F.col("goal") / block).alias("need"), at(F.col("_before")).alias("low"),
        at(F.col("_before") + F.col("goal")).alias("high"),
    )
    spread = edge.where("high > low").withColumn(
        "bucket", F.explode(F.sequence(F.floor(F.col("low") / width), F.floor((F.col("high") - 1) / width)))
    )
    points = spark.range(n).select(F.col("id").alias("slot"), _point(F.col("id") + 1).alias("point"))
    points = points.withColumn("bucket", F.floor(F.col("point") / width))
    hits = points.join(spread, "bucket").where("point >= low AND point < high").select("slot", "source_no", "need")
    slices = slices_for(n)
    hits = hits.withColumn("_one", F.lit(1)).withColumn("_part", F.floor(F.col("slot") * slices / n).cast("int"))
    ranked = running_total(hits, ["source_no"], ["slot"], "_part", "_one", "rank")
    drawn = ranked.where("rank < need").select("slot", "source_no", "rank")
    have = drawn.groupBy("source_no").agg(F.count(F.lit(1)).alias("have"))
    short = edge.join(have, "source_no", "left").withColumn("have", F.coalesce("have", F.lit(0))).where("have < need")
    late = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, -1)
    short = short.withColumn("_first", F.coalesce(F.sum(F.col("need") - F.col("have")).over(late), F.lit(0)) + n)
    tail = short.select("source_no", "have", "_first", F.explode(F.sequence("have", F.col("need") - 1)).alias("rank"))
    return drawn.unionByName(
        tail.select((F.col("_first") + F.col("rank") - F.col("have")).alias("slot"), "source_no", "rank")
    )


def placed(sizes: DataFrame, plan: DataFrame) -> DataFrame:
    """Documents with their source's plan and ``before``, the words ahead of them in the shuffled source."""
    rows = sizes.count()
    slices = slices_for(rows)
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    first = F.conv(F.substring(order, 1, 8), 16, 10).cast("bigint")
    other = plan.withColumnRenamed("source", "_source")
    joined = sizes.join(other, sizes["source"].eqNullSafe(other["_source"])).drop("_source")
    joined = joined.withColumn("_hash", order).withColumn("_part", F.floor(first * slices / (1 << 32)).cast("int"))
    placed_docs = running_total(joined, ["source_no"], ["_hash", "doc_id", "size"], "_part", "size", "before")
    return placed_docs.drop("_hash", "_part")


def mix(documents: DataFrame, slots: DataFrame, block: int = BLOCK) -> DataFrame:
    """Pieces of the mix: (slot, source_no, before, doc_id, start, length), ``start`` being a word of the document.

    A document that lies in a block several times, or in several blocks, gives several pieces.
    """
    lap = F.ceil(F.col("goal") / F.col("source_size"))
    laps = documents.where("size > 0 AND goal > 0").withColumn("_lap", F.explode(F.sequence(F.lit(0), (lap - 1).cast("int"))))
    laps = laps.withColumn("_from", F.col("before") + F.col("_lap") * F.col("source_size")).where("_from < goal")
    laps = laps.withColumn("_to", F.least(F.col("_from") + F.col("size"), F.col("goal")))
    parts = laps.withColumn(
        "rank", F.explode(F.sequence(F.floor(F.col("_from") / block), F.floor((F.col("_to") - 1) / block)))
    )
    start = F.greatest(F.col("_from"), F.col("rank") * block)
    end = F.least(F.col("_to"), (F.col("rank") + 1) * block)
    parts = parts.select(
        "source_no", "rank", "before", "doc_id", (start - F.col("_from")).alias("start"), (end - start).alias("length")
    )
    return parts.join(slots, ["source_no", "rank"]).select("slot", "source_no", "before", "doc_id", "start", "length")


def mixed(docs: DataFrame) -> DataFrame:
    """One row per document: its size, its source's size and target, and the words of it that the mix takes."""
    sizes = saved(sized(docs, ["doc_id", "source"]), "sizes")
    plan = saved(targets(sizes), "targets")
    documents = saved(placed(sizes, plan), "placed")
    pieces = mix(documents, schedule(plan))
    taken = pieces.groupBy(F.col("source_no").alias("_no"), F.col("before").alias("_before")).agg(F.sum("length").alias("_taken"))
    # documents with words have distinct places in their source
    found = documents.join(
        taken, (F.col("size") > 0) & (F.col("source_no") == F.col("_no")) & (F.col("before") == F.col("_before")), "left"
    )
    return found.select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("_taken", F.lit(0)).cast("bigint").alias("taken")
    )


def repeat_documents(docs: DataFrame) -> DataFrame:
    """Each document as often as the mix takes it, with all its columns.

    Only the document at which a source's last lap ends is taken in part; it counts as taken from half its words on.
    A document without words stays once.
    """
    counts = saved(mixed(docs), "mixed")
    copies = F.when(F.col("size") == 0, 1).otherwise(F.floor(F.col("taken") / F.col("size") + 0.5).cast("int"))
    # rows of equal id, source and size are alike to the mix, so their copies are dealt to them in any order
    keys = ["doc_id", "source", "size"]
    times = counts.withColumn("copies", copies).groupBy(*keys).agg(F.sort_array(F.collect_list("copies")).alias("_times"))
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "doc_id", "source", "text")
    measured = sized(row, ["_row", "doc_id", "source"])
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(1)))
    other = times.select(*[F.col(k).alias(f"_{k}") for k in keys], "_times")
    joined = measured.join(other, [measured[k].eqNullSafe(other[f"_{k}"]) for k in keys])
    several = joined.withColumn("_copies", F.element_at("_times", number))
    repeated = several.where("_copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return repeated.select(*[F.col("_row")[c].alias(c) for c in docs.columns])


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP3_SQL = r"""
WITH sizes AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
sources AS (
    SELECT source, source_size, n - 1 AS source_no, [5, 2, 1][((n - 1) % 3) + 1] AS weight FROM (
        SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS n
        FROM sizes GROUP BY source)),
-- sources reach their limit in the order of limit / weight; the level is that after which no further one does
reached AS (
    SELECT *, 3.0 * source_size / weight AS own_level,
        coalesce(sum(3 * source_size) OVER earlier, 0) AS fixed, sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0) AS open,
        sum(source_size) OVER () AS total
    FROM sources
    WINDOW earlier AS (ORDER BY 3.0 * source_size / weight, source_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT CAST(total - fixed AS DOUBLE) / CAST(open AS DOUBLE) AS l FROM reached
    WHERE CAST(total - fixed AS DOUBLE) / CAST(open AS DOUBLE) <= own_level ORDER BY own_level, source_no LIMIT 1),
planned AS (
    SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE), l * weight) AS target FROM sources, level),
goals AS (SELECT *, CAST(least(3 * source_size, floor(target + 0.5)) AS BIGINT) AS goal FROM planned),
placed AS (
    SELECT s.doc_id, s.size, g.source_size, g.target, g.goal,
        coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY md5(coalesce(CAST(s.doc_id AS VARCHAR), '')), s.doc_id, s.size
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM sizes s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
    CAST(CASE WHEN source_size = 0 THEN 0 ELSE (goal // source_size) * size
        + greatest(0, least(size, goal % source_size - before)) END AS BIGINT) AS taken
FROM placed"""
