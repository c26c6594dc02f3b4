"""Indicators: counts, shares, rates, flag sums, rankings, growth.

Every function aggregates first, which combines map-side, so what is shuffled is one row per
group and task. Windows, unpivots and sorts run on the aggregated rows only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import as_flag, named, percent
from .reshape import wide_row_to_long


def _keys(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def _sorted(df: DataFrame, order: Sequence[Column] | None) -> DataFrame:
    return df.orderBy(*order) if order else df


def counts(df: DataFrame, by: str | Sequence[str], total: str = "total", order=None) -> DataFrame:
    """Rows per group; a null key is a group of its own."""
    grouped = df.groupBy(*[named(k) for k in _keys(by)]).agg(F.count("*").alias(total))
    return _sorted(grouped, order)


def value_counts(df: DataFrame, column: str, nulls: bool = False) -> DataFrame:
    """Rows per value, most frequent first."""
    rows = df if nulls else df.where(named(column).isNotNull())
    return counts(rows, column, order=[F.desc("total"), F.asc(f"`{column}`")])


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Values that occur, null included."""
    return df.select(named(column)).distinct()


def top_k(df: DataFrame, category: str, k: int) -> DataFrame:
    """The k most frequent values; equal counts go by value."""
    return counts(df, category).orderBy(F.desc("total"), F.asc(f"`{category}`")).limit(k)


def share(
    df: DataFrame, category: str, by: str | Sequence[str] = (), flag: str | None = None,
    share_name: str = "pct", rate_name: str = "pct_top",
) -> DataFrame:
    """Count and percentage of each category within its ``by`` group, or of the whole.

    With ``flag``, the rate of that 0/1 column in each category stands beside the share. The whole is added up in a
    subquery, not in a window, which would bring all categories into one task.
    """
    keys = _keys(by)
    measures = [F.count("*").alias("total")]
    if flag:
        measures.append(F.sum(as_flag(df, flag)).alias("_flagged"))
    grouped = df.groupBy(*[named(k) for k in [*keys, category]]).agg(*measures)
    if keys:
        whole = F.sum("total").over(Window.partitionBy(*[named(k) for k in keys]))
    else:
        whole = grouped.agg(F.sum("total")).scalar()
    columns = [*[named(k) for k in [*keys, category]], F.col("total")]
    if flag:
        columns.append(percent(F.col("_flagged"), F.col("total")).alias(rate_name))
    columns.append(percent(F.col("total"), whole).alias(share_name))
    first = F.desc(rate_name) if flag else F.desc("total")
    return grouped.select(*columns).orderBy(*[F.asc(f"`{k}`") for k in keys], first, F.asc(f"`{category}`"))


def rate(
    df: DataFrame, by: str | Sequence[str], flag: str, name: str = "pct_top", with_total: bool = True
) -> DataFrame:
    """Percentage of each group whose flag is 1; the last group key is ranked by it."""
    keys = _keys(by)
    grouped = df.groupBy(*[named(k) for k in keys]).agg(
        F.count("*").alias("total"), F.sum(as_flag(df, flag)).alias("_flagged")
    )
    columns = [*[named(k) for k in keys]]
    if with_total:
        columns.append(F.col("total"))
    columns.append(percent(F.col("_flagged"), F.col("total")).alias(name))
    order = [*[F.asc(f"`{k}`") for k in keys[:-1]], F.desc(name), F.asc(f"`{keys[-1]}`")]
    return grouped.select(*columns).orderBy(*order)


def conditional_share(df: DataFrame, by: str | Sequence[str], conditions: Mapping[str, Column]) -> DataFrame:
    """Percentage of each group that meets each condition, side by side."""
    keys = _keys(by)
    grouped = df.groupBy(*[named(k) for k in keys]).agg(
        *[percent(F.count_if(test), F.count("*")).alias(name) for name, test in conditions.items()]
    )
    return grouped.orderBy(*[F.asc(f"`{k}`") for k in keys])


def conditional_rate(
    df: DataFrame, by: str | Sequence[str], conditions: Mapping[str, tuple[Column, Column]]
) -> DataFrame:
    """Percentage of the rows meeting ``base`` that also meet ``hit``, from ``{name: (hit, base)}``.

    Null where no row of the group meets the base.
    """
    keys = _keys(by)
    grouped = df.groupBy(*[named(k) for k in keys]).agg(
        *[
            percent(F.count_if(hit & base), F.count_if(base)).alias(name)
            for name, (hit, base) in conditions.items()
        ]
    )
    return grouped.orderBy(*[F.asc(f"`{k}`") for k in keys])


def flag_sums(
    df: DataFrame, by: str | Sequence[str], flags: Mapping[str, str], with_total: bool = False, order=None
) -> DataFrame:
    """Ticks of each flag per group, side by side, from ``{name: column}``."""
    keys = _keys(by)
    measures = [F.count("*").alias("total")] if with_total else []
    measures += [F.sum(as_flag(df, column)).alias(name) for name, column in flags.items()]
    grouped = df.groupBy(*[named(k) for k in keys]).agg(*measures)
    return _sorted(grouped, order or [F.asc(f"`{k}`") for k in keys])


def flag_percents(df: DataFrame, by: str | Sequence[str], flags: Mapping[str, str]) -> DataFrame:
    """Ticks of each flag in percent of all rows of the group, from ``{name: column}``."""
    keys = _keys(by)
    measures = [
        percent(F.sum(as_flag(df, column)), F.count("*")).alias(name) for name, column in flags.items()
    ]
    return df.groupBy(*[named(k) for k in keys]).agg(*measures).orderBy(*[F.asc(f"`{k}`") for k in keys])


def ranking(
    df: DataFrame, flags: Mapping[str, str], by: str | Sequence[str] = (), label: str = "option", total: str = "total"
) -> DataFrame:
    """Ticks per option as rows, most ticked first, from ``{label: column}``.

    One scan sums every flag; only the summed row of each group is unpivoted.
    """
    keys = _keys(by)
    measures = [
        F.coalesce(F.sum(as_flag(df, column)), F.lit(0).cast("bigint")).alias(text) for text, column in flags.items()
    ]
    wide = df.groupBy(*[named(k) for k in keys]).agg(*measures)
    long = wide_row_to_long(wide, label, total, keys)
    return long.orderBy(*[F.asc(f"`{k}`") for k in keys], F.desc(total), F.asc(label))


def growth(df: DataFrame, year: str, first: int, last: int, change: str = "variacao_pct") -> DataFrame:
    """Rows in two years and the change in percent; null where the first year has none.

    The filter on the two years reaches the scan, and prunes partitions of a table split by year.
    """
    before, after = F.col(f"total_{first}"), F.col(f"total_{last}")
    totals = df.where(named(year).isin(first, last)).agg(
        F.count_if(named(year) == first).alias(f"total_{first}"),
        F.count_if(named(year) == last).alias(f"total_{last}"),
    )
    return totals.select(before, after, percent(after - before, before).alias(change))
