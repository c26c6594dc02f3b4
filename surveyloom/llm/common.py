"""What the operators share: reading tables, bounded Arrow slices, saved tables, and totals over split groups."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from surveyloom.session import scratch_path

SLICE_BYTES = 1 << 20
ROWS_PER_SLICE = 20_000

GOLD = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whatever store ``sf_dir`` lies in."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared scratch folder and read it back, so later steps neither repeat nor lose its work."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_text(name: str = "text") -> Column:
    """The text with null as the empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def text_slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive row ranges of a batch of at most ``most`` text bytes each, or one row where that alone is longer."""
    offsets = text_offsets(batch.column(column))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[start] + most, side="right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


def text_offsets(column: pa.Array) -> np.ndarray:
    """Byte offsets of a text column's values in its data buffer, one more than there are rows."""
    width = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    if not len(column):
        return np.zeros(1, np.int64)
    return np.frombuffer(column.buffers()[1], width)[column.offset: column.offset + len(column) + 1].astype(np.int64)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column without nulls, joined, and the offsets of its values in them."""
    offsets = text_offsets(column)
    data = column.buffers()[2] if len(column) else None
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0]: offsets[-1]], offsets - offsets[0]


def binary_list(column: pa.Array) -> list[bytes]:
    """The values of a text column as UTF-8 bytes."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def map_slices(
    df: DataFrame, column: str, schema: str, fn: Callable[[pa.RecordBatch], dict], keep: list[str], most: int = SLICE_BYTES
) -> DataFrame:
    """Apply ``fn`` to bounded slices of a frame; it returns the new columns, which follow those in ``keep``.

    ``fn`` gets a record batch and returns lists or arrays by name, one value per row, in the order of ``schema``.
    """
    kept = [f"`{name}` {df.schema[name].dataType.simpleString()}" for name in keep]
    full = ", ".join([*kept, *([schema] if schema else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, column, most):
                made = fn(part)
                yield pa.RecordBatch.from_arrays(
                    [part.column(name) for name in keep]
                    + [v if isinstance(v, pa.Array) else pa.array(v) for v in made.values()],
                    names=[*keep, *made],
                )

    return df.mapInArrow(run, full)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_LOWER = np.arange(256, dtype=np.uint64) + np.uint64(1)
_LOWER[65:91] += np.uint64(32)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0xD6E8FEB86659FD93
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers of a base, in 64 bits; short runs are kept."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
        steps[0] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        if n <= 4 * SLICE_BYTES:
            _powers[base] = have
    return have[:n]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and 64-bit hash of each word (a run without ASCII white space), A-Z taken as a-z, in order of the text.

    A word's hash is a polynomial of its bytes, read from one running sum over the slice.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    solid = ~_SPACE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    inner = offsets[:-1][np.diff(offsets) > 0]
    first[inner] = solid[inner]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    after = np.append(starts[1:], n)
    # the end of a word: the first white space or row end behind its start
    breaks = ~solid
    stops = np.union1d(np.flatnonzero(breaks), offsets[1:])
    ends = np.minimum(stops[np.searchsorted(stops, starts, side="right")], after)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_LOWER[data] * powers(_BASE, n), dtype=np.uint64, out=total[1:])
    back = powers(pow(_BASE, -1, 1 << 64), n)[starts]
    hashes = mix64((total[ends] - total[starts]) * back + (ends - starts).astype(np.uint64) * GOLD)
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return rows, hashes


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every run of ``width`` words; a text with fewer words, but some, gives one of all its words."""
    rows, words = word_hashes(data, offsets)
    n = len(words)
    if not n:
        return rows, words
    factors = [np.uint64(pow(int(GOLD), j + 1, 1 << 64)) for j in range(width)]
    at = np.zeros(0, np.int64)
    hashes = np.zeros(0, np.uint64)
    if n >= width:
        whole = rows[: n - width + 1] == rows[width - 1:]
        total = np.zeros(n - width + 1, np.uint64)
        for j, factor in enumerate(factors):
            total += words[j: n - width + 1 + j] * factor
        at, hashes = rows[: n - width + 1][whole], mix64(total[whole])
    counts = np.bincount(rows, minlength=len(offsets) - 1)
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        begins = np.cumsum(counts) - counts
        totals = np.zeros(len(short), np.uint64)
        for j, factor in enumerate(factors[:-1]):
            some = counts[short] > j
            totals[some] += words[begins[short][some] + j] * factor
        at, hashes = np.concatenate([at, short]), np.concatenate([hashes, mix64(totals)])
        order = np.argsort(at, kind="stable")
        at, hashes = at[order], hashes[order]
    return at, hashes


# Fewer keys than this can each hold more than its inverse of all rows.
HEAVY_KEYS = 64


def looked_up(rows: DataFrame, values: DataFrame, keys: list[str]) -> DataFrame:
    """Left join of ``rows`` to ``values``, which has one row per key (null is a key), safe against hot keys.

    Rows of a key that holds over one in ``HEAVY_KEYS`` of all rows stay where they are: the values of those keys,
    fewer than ``HEAVY_KEYS`` rows, are broadcast. All other rows are shuffled. ``rows`` is read three times, so it
    should be a written table.
    """
    fields = [c for c in values.columns if c not in keys]
    named = values.select(*[F.col(k).alias(f"_at_{k}") for k in keys], *fields)
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    total = rows.count()
    heavy = saved(
        counts.where(F.col("_rows") * HEAVY_KEYS > total).select(*[F.col(k).alias(f"_hot_{k}") for k in keys], F.lit(True).alias("_heavy")),
        "heavy",
    )

    def same(one: DataFrame, two: DataFrame, prefix: str) -> Column:
        on = [one[k].eqNullSafe(two[f"{prefix}{k}"]) for k in keys]
        return reduce(lambda a, b: a & b, on)

    marked = rows.join(F.broadcast(heavy), same(rows, heavy, "_hot_"), "left").drop(*[f"_hot_{k}" for k in keys])
    hot = named.join(F.broadcast(heavy), reduce(lambda a, b: a & b, [named[f"_at_{k}"].eqNullSafe(heavy[f"_hot_{k}"]) for k in keys]), "left_semi")
    hot_rows, cold_rows = marked.where("_heavy").drop("_heavy"), marked.where("_heavy IS NULL").drop("_heavy")
    parts = [
        hot_rows.join(F.broadcast(hot), same(hot_rows, hot, "_at_"), "left"),
        cold_rows.join(named, same(cold_rows, named, "_at_"), "left"),
    ]
    return parts[0].select(*rows.columns, *fields).unionByName(parts[1].select(*rows.columns, *fields))


def slices_for(rows: int, per_slice: int = ROWS_PER_SLICE) -> int:
    """Slices that a group of this many rows is split into."""
    return max(1, -(-rows // per_slice))


def running_total(df: DataFrame, keys: list[str], order: list[str], slot: str, value: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the earlier rows of the same keys, in the given order.

    ``slot`` names the slice of a row and must not fall while the order rises. A group of any size is summed slice
    by slice: each window holds one slice, and a window over slice sums carries the totals from slice to slice.
    """
    group = [*keys, slot]
    sums = df.groupBy(*group).agg(F.sum(value).alias("_slice_sum"))
    ahead = Window.partitionBy(*keys).orderBy(slot).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*group, F.coalesce(F.sum("_slice_sum").over(ahead), F.lit(0)).alias("_carried"))
    here = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = df.withColumn("_inside", F.coalesce(F.sum(value).over(here), F.lit(0)))
    on = [inside[name].eqNullSafe(sums[name]) for name in group]
    return inside.join(sums, on).select(
        *[inside[c] for c in df.columns], (F.col("_inside") + F.col("_carried")).cast("bigint").alias(out)
    )


def in_order(df: DataFrame, order: list[str], label: str) -> DataFrame:
    """Save a frame dealt into ranges of the given order, with the number of each range as ``_range``."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(parts, *[F.col(c).asc_nulls_first() for c in order])
    return saved(dealt.withColumn("_range", F.spark_partition_id()), label)
