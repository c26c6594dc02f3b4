"""Rule tables and label maps turned into column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import named

TextRule = tuple[str, "str | Sequence[str]", str]


def _matches(value: Column, how: str, fragment: str) -> Column:
    if how == "starts":
        return value.startswith(fragment)
    if how == "contains":
        return value.contains(fragment)
    if how == "equals":
        return value == fragment
    raise ValueError(f"unknown rule {how!r}")


def any_match(value: Column, how: str, fragments: str | Sequence[str]) -> Column:
    """Whether the value matches at least one fragment."""
    texts = [fragments] if isinstance(fragments, str) else list(fragments)
    test = _matches(value, how, texts[0])
    for text in texts[1:]:
        test = test | _matches(value, how, text)
    return test


def classify(value: Column, rules: Sequence[TextRule], otherwise: str, ignore_case: bool = False) -> Column:
    """Label of the first rule ``(how, fragments, label)`` that matches, in the order given."""
    text = F.lower(value) if ignore_case else value
    return first_true([(any_match(text, how, what), label) for how, what, label in rules], otherwise)


def first_true(rules: Sequence[tuple[Column, str]], otherwise: str | Column) -> Column:
    """Label of the first condition that holds; a null condition does not hold."""
    condition, label = rules[0]
    out = F.when(condition, label)
    for condition, label in rules[1:]:
        out = out.when(condition, label)
    return out.otherwise(otherwise)


def tier_flag(band: Column, contains: Sequence[str], starts: str) -> Column:
    """1 where the band text holds a fragment or has the prefix, else 0, also for null."""
    hit = any_match(band, "contains", contains) | band.startswith(starts)
    return F.when(hit, 1).otherwise(0)


def recode(year: Column, value: Column, rules: Sequence[tuple[int, Sequence[str], str]]) -> Column:
    """Replace listed values of listed years; everything else stays."""
    return first_true(
        [((year.cast("string") == str(when)) & value.isin(*values), label) for when, values, label in rules], value
    )


def map_values(value: Column, labels: Mapping[str, str], keep_unmapped: bool = False) -> Column:
    """Mapped label; an unmapped value stays as it is or becomes null.

    The literal is searched entry by entry for each row; ``map_by_table`` joins a long list instead.
    """
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(labels.items())])
    mapped = table[value]
    return F.coalesce(mapped, value) if keep_unmapped else mapped


def map_by_table(
    df: DataFrame, column: str, table: DataFrame, output: str, keep_unmapped: bool = False, check: bool = True
) -> DataFrame:
    """``map_values`` for a label table ``(source, target)`` of any length.

    A source listed twice would multiply rows, so the table is checked for it first. There is no
    broadcast hint: Spark broadcasts the table only while its size is below the session's
    threshold. Beyond it both sides are joined straight from their shuffles, which lets adaptive
    execution split a hot value.
    """
    if check and not table.groupBy("source").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        raise ValueError("the label table lists a source twice")
    labels = table.select(F.col("source").alias("_source"), F.col("target").alias("_label"))
    mapped = F.coalesce(F.col("_label"), named(column)) if keep_unmapped else F.col("_label")
    joined = df.join(labels, named(column) == F.col("_source"), "left")
    return joined.select(*[named(c) for c in df.columns if c != output], mapped.alias(output))
