"""Editions of a questionnaire in one frame split by year, with a map of the columns each year has.

What is asked of all editions is then one aggregate or projection over one frame: a table that holds every edition is
scanned once, however many editions and options there are. A column that an edition lacks is null in its rows; the
map tells that from a question nobody answered.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import coerce_number, named, percent
from .reshape import literal_rows
from .unify import tag_year, unify


@dataclass(frozen=True)
class Stack:
    """Rows of all editions, and the columns that each year has."""

    rows: DataFrame
    present: Mapping[int, frozenset[str]]
    year: str = "ano"

    def has(self, *columns: str) -> Column:
        """Whether the edition of a row has all of the columns."""
        years = [year for year, names in self.present.items() if names.issuperset(columns)]
        return named(self.year).isin(*years) if years else F.lit(False)

    def knows(self, column: str) -> bool:
        """Whether any edition has the column."""
        return any(column in names for names in self.present.values())

    def map_rows(self, change: Callable[[DataFrame], DataFrame]) -> Stack:
        """The stack with its rows changed by a step that keeps names, such as a cleaning projection."""
        return Stack(change(self.rows), self.present, self.year)


def stack_of(editions: Mapping[int, DataFrame] | Stack, year: str = "ano") -> Stack:
    """Editions given as frames on top of each other, each scanned once; columns take the widest type."""
    if isinstance(editions, Stack):
        return editions
    present = {when: frozenset(df.columns) for when, df in editions.items()}
    tagged = {when: tag_year(df.drop(year) if year in df.columns else df, when, year) for when, df in editions.items()}
    return Stack(unify(tagged, "outer", lead=()), present, year)


def stack_from(df: DataFrame, year: str, layouts: Mapping[int, Mapping[str, str]]) -> Stack:
    """Editions that lie in one frame under names of their own, from ``{year: {column: the frame's column}}``.

    One projection gives every column its source in the row's year; rows of other years are left out.
    """
    names = dict.fromkeys(name for layout in layouts.values() for name in layout)
    when = named(year)

    def column(name: str) -> Column:
        years_of: dict[str, list[int]] = {}
        for edition, layout in layouts.items():
            if name in layout:
                years_of.setdefault(layout[name], []).append(edition)
        value: Column | None = None
        for source, years in years_of.items():
            value = F.when(when.isin(*years), named(source)) if value is None else value.when(when.isin(*years), named(source))
        return value.alias(name)

    rows = df.where(when.isin(*layouts)).select(when, *[column(name) for name in names if name != year])
    return Stack(rows, {edition: frozenset(layout) for edition, layout in layouts.items()}, year)


def read_stack(spark: SparkSession, folders: Mapping[int, str], year: str = "ano") -> Stack:
    """Editions written to a folder each, whatever columns each has; the files' footers tell which."""
    return stack_of({when: spark.read.parquet(path) for when, path in folders.items()}, year)


def totals_across(
    editions: Mapping[int, DataFrame] | Stack, twins: Mapping[str, Sequence[str]], label: str = "option", total: str = "total"
) -> DataFrame:
    """Ticks per option over all editions, from ``{label: twin columns}``.

    An edition counts the greatest sum among the twins it has, and nothing where it has none. All sums of all years
    come from one aggregate; twins are compared on its few rows.
    """
    stack = stack_of(editions)
    wanted = list(dict.fromkeys(c for columns in twins.values() for c in columns if stack.knows(c)))
    place = {c: f"s{i}" for i, c in enumerate(wanted)}
    years = stack.rows.groupBy(named(stack.year)).agg(
        F.count("*").alias("_rows"), *[F.sum(coerce_number(stack.rows, c)).alias(place[c]) for c in wanted]
    )

    def greatest(columns: Sequence[str]) -> Column:
        sums = [F.when(stack.has(c), F.col(place[c])) for c in columns if c in place]
        best = F.greatest(*sums) if len(sums) > 1 else sums[0] if sums else F.lit(None)
        return F.coalesce(best.cast("bigint"), F.lit(0).cast("bigint"))

    entries = [F.struct(F.lit(text).alias(label), greatest(columns).alias(total)) for text, columns in twins.items()]
    long = years.select(F.inline(F.array(*entries)))
    # every option is listed, also where there are no rows at all
    every = literal_rows(stack.rows.sparkSession, [(text, 0) for text in twins], f"`{label}` string, `{total}` bigint")
    summed = long.unionByName(every).groupBy(named(label)).agg(F.sum(named(total)).alias(total))
    return summed.orderBy(F.desc(total), F.asc(label))


def percents_by_year(editions: Mapping[int, DataFrame] | Stack, columns: Mapping[str, str]) -> DataFrame:
    """Sum of each column in percent of the year's rows, from ``{name: column}``; null where the edition lacks it."""
    stack = stack_of(editions)
    sums = {name: F.sum(coerce_number(stack.rows, c)) if stack.knows(c) else F.lit(None).cast("double") for name, c in columns.items()}
    years = stack.rows.groupBy(named(stack.year)).agg(*[percent(total, F.count("*")).alias(name) for name, total in sums.items()])
    return years.select(
        named(stack.year), *[F.when(stack.has(c), F.col(name)).alias(name) for name, c in columns.items()]
    ).orderBy(stack.year)
