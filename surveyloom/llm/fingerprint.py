"""Document fingerprints by threshold-scaled sketches (operator 1), on SQL functions alone.

A fingerprint keeps every hash of a text's five-word shingles that lies below a fixed fraction of the hash range, so
its size follows the text's, the fingerprint of two texts together is the union of theirs, and the share of a short
text in a long one can be estimated. Where fewer than ``LEAST`` hashes lie below the fraction the ``LEAST`` smallest
are kept (all, if a text has no more), so short texts have one too. Two fingerprints are compared below the point up
to which both are complete.

The query also fingerprints an edited form of each text, whose second half is the beginning of the next document.
Keys alone are dealt into ranges in order first; texts then cross one exchange, by range, in which each finds the next
behind it, and one text per range is looked up for the range before.

Defined cases: a null text is an empty one, whose fingerprint is empty; two empty fingerprints have likeness 1, an
empty and another one 0; words keep their case; a text of one to four words has one shingle, all its words;
documents of one id go by the hash of their text; equal rows count as one when the next document is looked for, and
each get a row; a null id comes first; of a single document the next is itself; an empty table gives an empty result;
columns beyond the needed ones are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from surveyloom.llm.common import in_order, table, whole_text

WIDTH = 5
FRACTION = 1 / 8
LEAST = 128

_LOWEST, _HIGHEST = -(1 << 63), (1 << 63) - 1
# Hashes are signed: those of the lowest fraction lie below this number.
_BOUND = _LOWEST + int(FRACTION * (1 << 64))


def shingles(text: Column) -> Column:
    """Hashes of a text's shingles, repeated ones included."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    none = F.array().cast("array<bigint>")

    def hashed(ws: Column) -> Column:
        runs = F.transform(
            F.sequence(F.lit(0), F.size(ws) - WIDTH), lambda i: F.xxhash64(*[ws[i + j] for j in range(WIDTH)])
        )
        whole = F.array(F.xxhash64(F.concat_ws(" ", ws)))
        return F.when(F.size(ws) >= WIDTH, runs).when(F.size(ws) > 0, whole).otherwise(none)

    return F.transform(F.array(words), hashed)[0]


def sketch(text: Column) -> Column:
    """The sorted hashes that the fingerprint of a text keeps."""

    def kept(all_hashes: Column) -> Column:
        low = F.array_distinct(F.filter(all_hashes, lambda h: h < F.lit(_BOUND)))
        return F.transform(
            F.array(low),
            lambda few: F.when(F.size(few) >= LEAST, F.array_sort(few)).otherwise(
                F.slice(F.array_sort(F.array_distinct(all_hashes)), 1, LEAST)
            ),
        )[0]

    return F.transform(F.array(shingles(text)), kept)[0]


def complete_to(kept: Column) -> Column:
    """Up to which hash a sketch holds all hashes of its text."""
    last = F.element_at(kept, -1)
    return F.when(F.size(kept) < LEAST, F.lit(_HIGHEST)).when(last >= F.lit(_BOUND), last).otherwise(F.lit(_BOUND - 1))


def merged(one: Column, two: Column) -> Column:
    """The sketch of two texts' shingles together, from their sketches."""
    every = F.array_sort(F.array_union(one, two))
    low = F.filter(every, lambda h: h < F.lit(_BOUND))
    return F.when(F.size(low) >= LEAST, low).otherwise(F.slice(every, 1, LEAST))


def _common(one: Column, two: Column) -> tuple[Column, Column]:
    to = F.least(complete_to(one), complete_to(two))
    return F.filter(one, lambda h: h <= to), F.filter(two, lambda h: h <= to)


def likeness(one: Column, two: Column) -> Column:
    """Estimated share of common shingles in all shingles of two texts."""
    a, b = _common(one, two)
    shared, every = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when((F.size(one) == 0) & (F.size(two) == 0), 1.0).when(every == 0, 0.0).otherwise(shared / every)


def containment(one: Column, two: Column) -> Column:
    """Estimated share of the first text's shingles that the second has; null where that can't be told."""
    a, b = _common(one, two)
    return F.when(F.size(a) > 0, F.size(F.array_intersect(a, b)) / F.size(a))


def digits(kept: Column) -> Column:
    """A sketch as text: 16 hexadecimal digits a hash."""
    return F.array_join(F.transform(kept, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


_KEY = ["at_id", "has_id", "text_hash"]


def _keyed(docs: DataFrame) -> DataFrame:
    """Texts under a key that has no nulls: the id, whether there is one, and the text's hash."""
    return docs.select("doc_id", whole_text().alias("text")).select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LOWEST)).alias("at_id"),
        F.col("doc_id").isNotNull().alias("has_id"), F.xxhash64("text").alias("text_hash"), "text",
    )


def _range_starts(docs: DataFrame) -> list[tuple[int, bool, int]]:
    """The smallest key of each range, in order, after dealing the keys alone into ranges of about one size.

    One row per range, of which there are as many as shuffle partitions.
    """
    keys = in_order(_keyed(docs).select(*_KEY), _KEY, "ids")
    firsts = keys.groupBy("_range").agg(F.min(F.struct(*_KEY)).alias("_first")).select("_first.*").collect()
    return sorted((row["at_id"], row["has_id"], row["text_hash"]) for row in firsts)


def _range_of(starts: list[tuple[int, bool, int]]) -> Column:
    """Number of the range a key lies in: how many ranges start at it or before, by binary search."""
    ids, has, hashes = (F.array(*[F.lit(start[i]) for start in starts]) for i in range(3))
    steps = max(1, len(starts).bit_length())

    def halve(bounds: Column, _: Column) -> Column:
        middle = F.shiftright(bounds["low"] + bounds["high"], 1)
        at = F.least(middle, F.lit(len(starts) - 1))
        start = F.struct(F.get(ids, at).alias("at_id"), F.get(has, at).alias("has_id"), F.get(hashes, at).alias("text_hash"))
        before = start <= F.struct(*_KEY)
        done = bounds["low"] >= bounds["high"]
        return F.struct(
            F.when(done, bounds["low"]).when(before, middle + 1).otherwise(bounds["low"]).alias("low"),
            F.when(done, bounds["high"]).when(before, bounds["high"]).otherwise(middle).alias("high"),
        )

    first = F.struct(F.lit(0).alias("low"), F.lit(len(starts)).alias("high"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), first, halve, lambda bounds: bounds["low"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and its edited form, and how near it is to that and to the next document.

    Texts cross one exchange, by range of their key; the next text of most lies in the same range, behind it in
    descending order. Of each range only the first text is looked up for the range before.
    """
    starts = _range_starts(docs)
    if not starts:
        return _compared(docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"), whole_text().alias("next_text"),
        ).withColumns({"kept": sketch(F.col("text")), "next_kept": sketch(F.col("text"))}))
    keyed = _keyed(docs)
    dealt = keyed.withColumn("_range", _range_of(starts)).repartition("_range").withColumn("kept", sketch(F.col("text")))
    back = Window.partitionBy("_range").orderBy(*[F.desc(name) for name in _KEY])
    here = F.struct(*_KEY)
    other = F.lag(F.struct(here.alias("key"), "text", "kept")).over(back)
    led = dealt.withColumn("_behind", other)
    # equal rows have one next document: the last other key seen
    new = F.when(F.col("_behind")["key"] != here, F.struct(F.col("_behind")["text"].alias("text"), F.col("_behind")["kept"].alias("kept")))
    led = led.withColumn("_next", F.last(new, ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    # the first text of each range, for the end of the range before; the last range goes on with the first
    wanted = docs.sparkSession.createDataFrame(
        [(*start, (i if i else len(starts))) for i, start in enumerate(starts)],
        "at_id bigint, has_id boolean, text_hash bigint, _before int",
    )
    heads = keyed.join(F.broadcast(wanted), _KEY).dropDuplicates(["_before"]).select(
        F.col("_before").alias("_range"), F.struct("text", sketch(F.col("text")).alias("kept")).alias("_head")
    )
    both = led.join(heads, "_range").withColumn("_next", F.coalesce("_next", "_head"))
    return _compared(both.select(
        F.when(F.col("has_id"), F.col("at_id")).alias("doc_id"), "text", "kept",
        F.col("_next")["text"].alias("next_text"), F.col("_next")["kept"].alias("next_kept"),
    ))


def _compared(both: DataFrame) -> DataFrame:
    """The query's columns from each text, the next one, and their sketches."""
    sized = both.withColumn("n_chars", F.char_length("text").cast("bigint"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    head = F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half)
    edited = F.concat(head, F.substring("next_text", F.lit(1), half))
    made = sized.withColumn("edited", edited).withColumn("edited_kept", sketch(F.col("edited")))
    return made.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), digits(F.col("kept")).alias("fingerprint"),
        digits(F.col("edited_kept")).alias("edited_fingerprint"),
        likeness(F.col("kept"), F.col("edited_kept")).alias("near_edited"),
        likeness(F.col("kept"), F.col("next_kept")).alias("near_next"),
        containment(F.col("kept"), F.col("edited_kept")).alias("held_by_edited"),
    )


def op1_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
