"""Vector code compression with equal-average search (operator 12).

A vector is cut into ``PARTS`` equal consecutive parts, and each part is replaced by the index of the nearest entry of
its position's codebook. Codebooks start as parts of the vectors with the smallest ids and are refined by ``ROUNDS``
rounds of assignment and replacement by the floored mean. All arithmetic is on whole numbers: a component ``x``
becomes ``floor(256 * x)``, in the tasks, each time the vectors are read; no copy of them is written.

The nearest entry is found by equal-average search. Entries are sorted by the sum of their components. A part starts
at its own sum's place and goes outward on both sides, one entry a step and a side. By the Cauchy-Schwarz inequality
an entry whose sum lies ``g`` away is at least ``g * g / d`` away (``d`` components), so a side is closed when
``g * g`` strictly exceeds ``d`` times the best distance; entries that can tie are still looked at, and the lower
index wins. The parts of a slice of rows take their steps together as numpy arrays, those that are done drop out.

Tasks return sums and counts per codebook entry, at most ``PARTS * ENTRIES`` rows a task, so a round moves a few
numbers whatever the number of vectors, and a hot vector or label gathers nowhere. Only codebooks
(``PARTS * ENTRIES`` entries) reach the driver and the tasks.

Defined cases: rows whose vector is null, empty, of a length that 16 doesn't divide, or of another length than the
kept vector with the smallest id are dropped, as are rows with null or non-finite components, or with components so
large that squared distances would not fit 64 bits (``largest``: beyond 2^26 after scaling, for four components a
part). Null ids come last when codebooks start; repeated rows each count and each get a row; with fewer than
``ENTRIES`` rows a codebook has fewer entries; null labels are one label; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.llm.common import looked_up, saved, table

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
ROWS_AT_ONCE = 4_096


def largest(part_length: int) -> int:
    """The largest component after scaling for which every sum of the search fits 64 bits."""
    return math.isqrt((1 << 56) // part_length**2)


def usable(column: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of an Arrow list column whose vectors have this length and can be used, and those as whole numbers."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    rows = np.flatnonzero((np.diff(offsets) == length) & column.is_valid().to_numpy(zero_copy_only=False))
    if not length or not len(rows):
        return rows[:0], np.zeros((0, length), np.int64)
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)  # nulls become NaN
    scaled = np.floor(values[offsets[rows][:, None] + np.arange(length)] * SCALE)
    fine = (np.abs(scaled) <= largest(length // PARTS)).all(axis=1)  # false for NaN and infinities
    return rows[fine], scaled[fine].astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch], vector: str, length: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of rows with the places of those that can be used, and their whole numbers."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(start, ROWS_AT_ONCE)
            yield part, *usable(part.column(vector), length)


def _smallest(keys: pa.Array, whole: np.ndarray) -> np.ndarray:
    """Places of the ``ENTRIES`` smallest keys, null last, equal keys in order of their vectors."""
    if not len(keys):
        return np.zeros(0, np.int64)
    rank = pc.rank(keys, sort_keys="ascending", null_placement="at_end", tiebreaker="dense").to_numpy()
    last = np.partition(rank, min(ENTRIES, len(rank)) - 1)[min(ENTRIES, len(rank)) - 1]
    few = np.flatnonzero(rank <= last)
    return few[np.lexsort((*whole[few].T[::-1], rank[few]))[:ENTRIES]]


def first_codebooks(vectors: DataFrame, key: str, vector: str) -> np.ndarray | None:
    """Codebooks (part, entry, component) of the vectors with the smallest ids, or None without any vector.

    Each task sends its smallest ids only, ``ENTRIES`` of each length of vectors it has.
    """
    kind = vectors.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[pa.Array, np.ndarray]] = {}
        for batch in batches:
            lengths = np.unique(pc.list_value_length(batch.column(1)).drop_null().to_numpy())
            for length in lengths[(lengths > 0) & (lengths % PARTS == 0)].tolist():
                rows, whole = usable(batch.column(1), length)
                keys = batch.column(0).take(pa.array(rows))
                if length in best:
                    keys, whole = pa.concat_arrays([best[length][0], keys]), np.concatenate([best[length][1], whole])
                first = _smallest(keys, whole)
                best[length] = keys.take(pa.array(first)), whole[first]
        for length, (keys, whole) in best.items():
            ends = np.arange(len(whole) + 1, dtype=np.int32) * length
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(np.full(len(whole), length)), pa.ListArray.from_arrays(pa.array(ends), pa.array(whole.ravel()))],
                names=["at", "length", "v"],
            )

    given = vectors.select(key, vector)
    firsts = saved(given.mapInArrow(run, f"at {kind.simpleString()}, length bigint, v array<bigint>"), "firsts")
    order = [F.col("at").asc_nulls_last(), "v"]
    first = firsts.orderBy(*order).limit(1).collect()
    if not first:
        return None
    length = first[0]["length"]
    rows = firsts.where(F.col("length") == length).orderBy(*order).limit(ENTRIES).select("v").collect()
    start = np.array([row["v"] for row in rows], np.int64)
    return np.ascontiguousarray(start.reshape(len(rows), PARTS, length // PARTS).transpose(1, 0, 2))


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of each part's nearest entry, ties to the lower index, by equal-average search."""
    d = parts.shape[1]
    sums = entries.sum(axis=1)
    order = np.argsort(sums, kind="stable")
    sorted_sums, sorted_entries = sums[order], entries[order]
    own = parts.sum(axis=1)
    right = np.searchsorted(sorted_sums, own)
    best = np.full(len(parts), np.iinfo(np.int64).max)
    index = np.zeros(len(parts), np.int64)
    sides = [(np.arange(len(parts)), right - 1, -1), (np.arange(len(parts)), right, 1)]
    while any(len(todo) for todo, _, _ in sides):
        after = []
        for todo, at, step in sides:
            inside = (at >= 0) & (at < len(entries))
            todo, at = todo[inside], at[inside]
            gap = sorted_sums[at] - own[todo]
            # gap * gap > d * best, without a product that could pass 64 bits while there is no best yet
            near = gap * gap <= d * np.minimum(best[todo], np.iinfo(np.int64).max // d)
            todo, at = todo[near], at[near]
            apart = parts[todo] - sorted_entries[at]
            far = np.einsum("ij,ij->i", apart, apart)
            found = order[at]
            better = (far < best[todo]) | ((far == best[todo]) & (found < index[todo]))
            best[todo[better]], index[todo[better]] = far[better], found[better]
            after.append((todo, at + step, step))
        sides = after
    return index, best


def assign(vectors: np.ndarray, codebooks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry index and squared distance of every part of every vector."""
    split = vectors.reshape(len(vectors), PARTS, codebooks.shape[2])
    index = np.empty((len(vectors), PARTS), np.int64)
    far = np.empty((len(vectors), PARTS), np.int64)
    for p in range(PARTS):
        index[:, p], far[:, p] = nearest(np.ascontiguousarray(split[:, p]), codebooks[p])
    return index, far


def refined(vectors: DataFrame, codebooks: np.ndarray, vector: str) -> np.ndarray:
    """Codebooks after one round: each entry is the floored mean of its parts, unused ones stay."""
    length = codebooks.shape[0] * codebooks.shape[2]
    shape = codebooks.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(shape[0] * shape[1], np.int64)
        total = np.zeros((shape[0] * shape[1], shape[2]), np.int64)
        for _, _, whole in _blocks(batches, vector, length):
            index, _ = assign(whole, codebooks)
            seat = (index + np.arange(shape[0]) * shape[1]).ravel()
            np.add.at(count, seat, 1)
            np.add.at(total, seat, whole.reshape(-1, shape[2]))
        used = np.flatnonzero(count)
        ends = np.arange(len(used) + 1, dtype=np.int32) * shape[2]
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(count[used]), pa.ListArray.from_arrays(pa.array(ends), pa.array(total[used].ravel()))],
            names=["seat", "n", "sums"],
        )

    sums = vectors.select(vector).mapInArrow(run, "seat bigint, n bigint, sums array<bigint>")
    wide = sums.groupBy("seat").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[j]).alias(f"s{j}") for j in range(shape[2])])
    out = codebooks.copy().reshape(-1, shape[2])
    for row in wide.collect():  # a row per codebook entry
        out[row["seat"]] = [row[f"s{j}"] // row["n"] for j in range(shape[2])]
    return out.reshape(shape)


def trained(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", rounds: int = ROUNDS) -> np.ndarray | None:
    """Codebooks (part, entry, component) after the given rounds, or None without any usable vector."""
    codebooks = first_codebooks(vectors, key, vector)
    for _ in range(rounds if codebooks is not None else 0):
        codebooks = refined(vectors, codebooks, vector)
    return codebooks


def encoded(vectors: DataFrame, codebooks: np.ndarray, keep: list[str], vector: str = "embedding") -> DataFrame:
    """Columns in ``keep`` with ``code`` (two hexadecimal digits a part) and ``error``, the squared distance.

    Rows whose vector can't be used are left out.
    """
    length = PARTS * codebooks.shape[2]
    digits = np.array([f"{i:02x}" for i in range(codebooks.shape[1])], "S2")
    kept = [f"`{name}` {vectors.schema[name].dataType.simpleString()}" for name in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows, whole in _blocks(batches, vector, length):
            index, far = assign(whole, codebooks)
            codes = digits[index].view(f"S{2 * PARTS}").ravel().astype(f"U{2 * PARTS}")
            picked = part.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [*[picked.column(name) for name in keep], pa.array(codes, pa.string()), pa.array(far.sum(axis=1))],
                names=[*keep, "code", "error"],
            )

    return vectors.select(*keep, vector).mapInArrow(run, ", ".join([*kept, "code string", "error bigint"]))


def decoded(code: str, codebooks: np.ndarray) -> np.ndarray:
    """The vector of whole numbers that a code stands for."""
    index = [int(code[2 * p: 2 * p + 2], 16) for p in range(PARTS)]
    return np.concatenate([codebooks[p, i] for p, i in enumerate(index)])


def digest(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


CODE_COLUMNS = "vec_id bigint, code string, error bigint, label_error bigint, codebooks_sha256 string"


def op12_equal_average_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compressed(table(spark, sf_dir, "embeddings"))


def compressed(vectors: DataFrame) -> DataFrame:
    """Codes of all vectors, their errors, and the error of each label."""
    vectors = vectors.select("vec_id", "label", "embedding")
    codebooks = trained(vectors)
    if codebooks is None:
        return vectors.sparkSession.createDataFrame([], CODE_COLUMNS)
    codes = saved(encoded(vectors, codebooks, ["vec_id", "label"]), "codes")
    errors = codes.groupBy("label").agg(F.sum("error").alias("label_error"))
    return looked_up(codes, errors, ["label"]).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(codebooks)).alias("codebooks_sha256")
    )


_ROUND = """
near{i} AS (
    SELECT v.vec_id, v.p, d.e, sum((v.x - d.x) * (v.x - d.x)) AS far
    FROM parts v JOIN book{i} d ON v.p = d.p AND v.j = d.j GROUP BY ALL),
best{i} AS (
    SELECT vec_id, p, e, far FROM near{i}
    QUALIFY row_number() OVER (PARTITION BY vec_id, p ORDER BY far, e) = 1),"""

_REPLACED = """
book{next} AS (
    SELECT d.p, d.e, d.j, coalesce(m.x, d.x) AS x FROM book{i} d LEFT JOIN (
        SELECT b.p, b.e, v.j, CAST(floor(CAST(sum(v.x) AS DOUBLE) / count(*)) AS BIGINT) AS x
        FROM best{i} b JOIN parts v ON b.vec_id = v.vec_id AND b.p = v.p GROUP BY ALL
    ) m ON d.p = m.p AND d.e = m.e AND d.j = m.j),"""

OP12_SQL = (
    """
WITH kept AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
flat AS (SELECT vec_id, unnest(v) AS x, unnest(range(len(v))) AS pos, divide(len(v), 16) AS d FROM kept),
parts AS (SELECT vec_id, divide(pos, d) AS p, pos % d AS j, x FROM flat),
starts AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT 64),
book0 AS (SELECT p, e, j, x FROM parts JOIN starts USING (vec_id)),"""
    + "".join(_ROUND.format(i=i) + _REPLACED.format(i=i, next=i + 1) for i in range(ROUNDS))
    + _ROUND.format(i=ROUNDS)
    + f"""
codes AS (
    SELECT vec_id, string_agg(lower(lpad(to_hex(e), 2, '0')), '' ORDER BY p) AS code, CAST(sum(far) AS BIGINT) AS error
    FROM best{ROUNDS} GROUP BY vec_id)
SELECT c.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error,
    (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, j)) FROM book{ROUNDS}) AS codebooks_sha256
FROM codes c JOIN kept k USING (vec_id)
"""
)
