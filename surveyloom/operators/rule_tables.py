"""Classification by a table of text rules of any length: the first rule that matches gives the label.

A chain of conditions tests every rule on every row. Here values and rules meet by equi-joins on anchors that a match
must hold, the pairs found are tested where the anchor leaves a doubt, and the first rule of each value is taken:

- ``equals`` meets the value's digest,
- ``starts`` meets the prefix as long as the fragment itself (of long fragments: the power of two below it),
- ``contains`` meets, of short fragments, the run of three characters that is rarest in the data. A fragment of
  ``2 * size - 1`` characters holds a whole block of any text that is cut into blocks of ``size``, so longer ones meet
  the text's blocks by ``size`` neighbouring runs, those that are rarest together. Of a text only its blocks are
  looked up, not the runs at all of its places, and only those found in some fragment are written.

The work grows with the matches of anchors, not with rules times rows; only rules with different fragments count.

Rules are rows ``(place, how, fragment, label)`` with ``how`` one of ``starts``, ``contains`` and ``equals``; the
smallest place wins. An empty fragment matches every value for ``starts`` and ``contains``. Null values and null
fragments match nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import named
from ..session import scratch_path

RUN = 3
BLOCKS = (4, 8, 16)
EXACT_PREFIX = 32


def _runs(text: Column, size: int) -> Column:
    """The different runs of so many characters of a text, from an array of its characters."""

    def joined(chars: Column) -> Column:
        last = F.size(chars) - size
        runs = F.transform(F.sequence(F.lit(0), last), lambda i: F.concat(*[F.get(chars, i + j) for j in range(size)]))
        return F.when(last >= 0, F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))

    chars = F.when(text != "", F.split(text, "")).otherwise(F.array().cast("array<string>"))
    return F.transform(F.array(chars), joined)[0]


def _blocks(text: Column, size: int) -> Column:
    """The different blocks of a text cut every so many characters; a shorter rest is left out."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s).{{{size}}}"), F.lit(0)))


def _written(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _anchor_size(fragment: Column) -> Column:
    """Characters in the anchors of a fragment searched anywhere; no two forms of anchors have as many."""
    size = F.least(F.char_length(fragment), F.lit(RUN))
    for block in BLOCKS:
        size = F.when(F.char_length(fragment) >= 2 * block - 1, block).otherwise(size)
    return size


def _prefix_size(fragment: Column) -> Column:
    length = F.char_length(fragment)
    power = F.pow(F.lit(2), F.length(F.bin(length)) - 1).cast("int")  # the greatest that is no longer
    return F.when(length <= EXACT_PREFIX, length).otherwise(power)


def _candidate_keys(rules: DataFrame) -> DataFrame:
    """Every run a fragment searched anywhere could be met by, one row each.

    ``width`` neighbours from ``at`` on are an anchor, for ``at`` up to ``last``.
    """
    fragment, size = F.col("fragment"), F.col("size")
    places = F.sequence(F.lit(1), F.char_length(fragment) - size + 1)
    keys = F.transform(places, lambda i: F.substring(fragment, i, size))
    width = F.when(size > RUN, size).otherwise(1)
    sized = rules.withColumn("size", _anchor_size(fragment)).withColumn("width", width)
    last = F.char_length(fragment) - size - F.col("width") + 1
    each = F.posexplode(keys).alias("at", "key")
    return sized.select("place", "fragment", "label", "width", last.alias("last"), each)


def _value_keys(values: DataFrame, sizes: list[int]) -> DataFrame:
    """``(id, key)`` for the sizes of anchors that the rules use."""
    text = F.col("value")
    keys = F.concat(*[_blocks(text, size) if size > RUN else _runs(text, size) for size in sizes])
    return values.select("id", F.explode(keys).alias("key"))


def _rarest(options: DataFrame, met: DataFrame) -> DataFrame:
    """The runs of each rule's anchor: those neighbours that meet the fewest values."""
    often = met.groupBy("key").agg(F.count("*").alias("often"))
    counted = options.join(often, "key", "left").withColumn("often", F.coalesce("often", F.lit(0)))
    rule = Window.partitionBy("place")
    total = F.col("often")
    for block in BLOCKS:
        neighbours = F.sum("often").over(rule.orderBy("at").rowsBetween(0, block - 1))
        total = F.when(F.col("width") == block, neighbours).otherwise(total)
    anchors = F.when(F.col("at") <= F.col("last"), F.struct(total.alias("total"), "at"))
    best = F.min("anchor").over(rule)["at"]
    chosen = counted.withColumn("anchor", anchors).withColumn("best", best)
    inside = (F.col("at") >= F.col("best")) & (F.col("at") < F.col("best") + F.col("width"))
    return chosen.where(inside).select("place", "fragment", "label", "key").distinct()


def _starting(df: DataFrame, text: Column, rules: DataFrame, sizes: list[int], most: int) -> DataFrame:
    """``(id, place, label)`` of the rules that a value starts with."""
    start = F.substring(text, 1, most).alias("head")
    heads, head = df.where(text.isNotNull()).select(_id(text).alias("id"), start).distinct(), F.col("head")
    keys = [
        F.when(F.char_length(head) >= size, F.struct(
            F.substring(head, 1, size).alias("key"),
            # a key below the exact lengths is the fragment; others anchor fragments of up to twice their length
            (F.substring(head, 1, 2 * size) if size >= EXACT_PREFIX else F.lit(None).cast("string")).alias("more"),
        ))
        for size in sizes
    ]
    met = heads.select("id", F.explode(F.array(*keys)).alias("met")).where("met IS NOT NULL").select("id", "met.*")
    keyed = rules.withColumn("key", F.substring("fragment", F.lit(1), _prefix_size(F.col("fragment"))))
    holds = F.coalesce("more", "key").startswith(F.col("fragment"))
    return met.join(keyed, "key").where(holds).select("id", "place", "label")


def _containing(df: DataFrame, text: Column, rules: DataFrame, sizes: list[int]) -> DataFrame:
    """``(id, place, label)`` of the rules that a value contains."""
    options = _written(_candidate_keys(rules), "rule-keys")
    distinct = df.where(text.isNotNull()).select(_id(text).alias("id"), text.alias("value"))
    values = distinct.groupBy("id").agg(F.first("value").alias("value"))
    met = _written(
        _value_keys(values, sizes).join(options.select("key").distinct(), "key", "left_semi"), "value-keys"
    )
    anchors = _written(_rarest(options, met), "rule-anchors")
    pairs = met.join(anchors, "key").select("id", "place", "fragment", "label").join(values, "id")
    return pairs.where(F.col("value").contains(F.col("fragment"))).select("id", "place", "label")


def _id(text: Column) -> Column:
    return F.unhex(F.md5(text))


def classify_by_table(
    df: DataFrame, column: str, rules: DataFrame, output: str, otherwise: str | None, ignore_case: bool = False
) -> DataFrame:
    """Add the label of the first matching rule to every row; ``otherwise`` where none matches.

    Equal values are looked at once. With ``ignore_case`` values and fragments are compared in lower case.
    """
    if rules.groupBy("place").agg(F.count("*").alias("n")).where("n > 1").isEmpty() is False:
        raise ValueError("two rules have the same place")
    text, fragment = named(column), F.col("fragment")
    if ignore_case:
        text, fragment = F.lower(text), F.lower(fragment)
    how = F.coalesce("how", F.lit("equals"))
    stated = rules.select("place", how.alias("how"), fragment.alias("fragment"), "label").where("fragment IS NOT NULL")
    # of rules with the same condition only the first can win
    known = _written(
        stated.groupBy("how", "fragment").agg(F.min("place").alias("place"), F.min_by("label", "place").alias("label")),
        "rules",
    )
    if not known.where(~F.col("how").isin("starts", "contains", "equals")).isEmpty():
        raise ValueError("a rule is neither 'starts', 'contains' nor 'equals'")
    fragment = F.col("fragment")
    starts = known.where((F.col("how") == "starts") & (fragment != ""))
    contains = known.where((F.col("how") == "contains") & (fragment != ""))
    # sizes of anchors in use: at most RUN and the blocks, and the exact lengths and powers of two of prefixes
    longest = F.max(F.char_length(fragment)).alias("most")
    prefixes = starts.groupBy(_prefix_size(fragment).alias("size")).agg(longest).collect()
    runs = sorted(row["size"] for row in contains.select(_anchor_size(fragment).alias("size")).distinct().collect())
    hits = known.where("how = 'equals'").select(_id(fragment).alias("id"), "place", "label")
    if prefixes:
        sizes, most = sorted(row["size"] for row in prefixes), max(row["most"] for row in prefixes)
        hits = hits.unionByName(_starting(df, text, starts, sizes, most))
    if runs:
        hits = hits.unionByName(_containing(df, text, contains, runs))
    first = hits.groupBy("id").agg(
        F.min("place").alias("_place"), F.min_by("label", "place").alias("_label"), F.lit(True).alias("_found")
    )
    marked = df.withColumn("_id", _id(text))
    joined = marked.join(first.withColumnRenamed("id", "_id"), "_id", "left")
    label = F.when(F.col("_found"), F.col("_label"))
    every = known.where((F.col("how") != "equals") & (fragment == "")).agg(
        F.count("*").alias("n"), F.min("place").alias("place"), F.min_by("label", "place").alias("label")
    ).first()
    if every["n"]:
        sooner = F.col("_found") if every["place"] is None else F.col("_place") < F.lit(every["place"])
        label = F.when(sooner, F.col("_label")).when(F.col("_id").isNotNull(), F.lit(every["label"]))
    label = label.otherwise(F.lit(otherwise))
    return joined.select(*[named(c) for c in df.columns if c != output], label.alias(output))
