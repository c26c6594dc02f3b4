"""Near-duplicate documents by DartMinHash (operator 6).

A document is the weighted set of its five-word shingles; a shingle that occurs ``c`` times weighs ``1 + ln c``, so a
line repeated hundreds of times doesn't make documents alike. Darts are thrown at the region under the weights: every
unit of a shingle's weight is a cell that gets darts from a hash of itself, at exponentially spaced ranks, each marked
for one of ``COORDINATES`` coordinates; of a last cell that is not full, darts beyond the weight are dropped. Only darts of rank below
``theta`` are made, with ``theta`` chosen so that a document gets ``k ln k + 2k`` of them however long it is; where
a coordinate stays empty ``theta`` is doubled. The earliest dart of each coordinate is the signature, and two
documents share one with the probability of their weighted Jaccard likeness.

Signatures are cut into bands. Documents that share a band are joined, first each with one leader of the bucket, the
document with the most company in all its buckets, later those of a bucket that are still in different classes with
each other, once a pair however many bands it shares, unless a link is ruled out: by their weights (the lighter text
has less than 0.8 of the heavier's), by their known likeness to the leader (the Jaccard distance is a metric), or by
finer signatures of ``FINE`` coordinates that agree in so few as a likeness of 0.8 gives once in 300,000 pairs. Every
joined pair is verified on whole texts, so a link means a likeness of at least ``LIKENESS``. Classes are the connected
components of the links.

Equal texts are one node from the start, found by the 128-bit hash of the text.

Defined cases: a null text is an empty one; a text of one to four words has one shingle, all its words; texts
without words are near only to their equals; A-Z count as a-z; repeated rows each get a row; a class is named by
its smallest doc_id that is not null; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.llm.common import (
    GOLD, binary_list, map_slices, mix64, saved, shingle_hashes, table, text_bytes, whole_text,
)

WIDTH = 5
LIKENESS = 0.8
BANDS = 25
ROWS = 5
COORDINATES = BANDS * ROWS
# Finer signatures of the texts that are still in question estimate a likeness, by four bits a coordinate.
FINE = 1024
FINE_ROWS = 64
LONGS = FINE // 16
COARSE = 256  # of these, looked at first


def least_agreeing(coordinates: int) -> int:
    """So few coordinates agree once in 300,000 pairs of a likeness of LIKENESS (4.5 standard deviations below).

    Four bits agree by chance once in 16.
    """
    rate = LIKENESS + (1 - LIKENESS) / 16
    return math.floor(coordinates * rate - 4.5 * math.sqrt(coordinates * rate * (1 - rate)))


def cells(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, hash and width of every cell: each unit of a shingle's weight is one, the last may be narrower."""
    rows, hashes = shingle_hashes(data, offsets, WIDTH)
    if not len(rows):
        return rows, hashes, np.zeros(0)
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    opens = np.flatnonzero(np.r_[True, (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])])
    weight = 1 + np.log(np.diff(np.r_[opens, len(rows)]))
    n = np.ceil(weight).astype(np.int64)
    unit = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    width = np.minimum(1.0, np.repeat(weight, n) - unit)
    keys = mix64(np.repeat(hashes[opens], n) + unit.astype(np.uint64) * GOLD)
    return np.repeat(rows[opens], n), keys, width


def signatures(data: np.ndarray, offsets: np.ndarray, k: int = COORDINATES) -> tuple[np.ndarray, np.ndarray]:
    """The dart that came first at each coordinate, a row per document, and which documents have any."""
    n = len(offsets) - 1
    rows, keys, width = cells(data, offsets)
    weight = np.bincount(rows, weights=width, minlength=n)
    best = np.full(n * k, np.inf)
    sig = np.zeros(n * k, np.uint64)
    theta = (k * math.log(k) + 2 * k) / np.maximum(weight, 1e-9)
    missing = weight > 0
    while missing.any():
        use = missing[rows]
        _throw(rows[use], keys[use], width[use], theta, k, best, sig)
        missing &= ~np.isfinite(best.reshape(n, k)).all(axis=1)
        theta[missing] *= 2
    return sig.reshape(n, k), weight > 0


def _throw(
    rows: np.ndarray, keys: np.ndarray, width: np.ndarray, theta: np.ndarray, k: int, best: np.ndarray, sig: np.ndarray
) -> None:
    """Darts of rank below each document's ``theta``: ``best`` gets the earliest ranks, ``sig`` their darts."""
    rank = np.zeros(len(rows))
    seats, ranks, darts = [], [], []
    turn = 0
    while len(rows):
        turn += 1
        dart = mix64(keys + np.uint64(turn * 0xC2B2AE3D27D4EB4F % (1 << 64)))
        rank = rank - np.log((np.float64(1) + (dart >> np.uint64(11))) * 2.0**-53)
        alive = rank < theta[rows]
        rows, keys, width, rank, dart = rows[alive], keys[alive], width[alive], rank[alive], dart[alive]
        more = mix64(dart)
        hit = (width == 1) | ((more >> np.uint64(11)) * 2.0**-53 < width)
        seats.append(rows[hit] * k + (mix64(more[hit]) % np.uint64(k)).astype(np.int64))
        ranks.append(rank[hit])
        darts.append(dart[hit])
    if not seats:
        return
    seat, rank, dart = np.concatenate(seats), np.concatenate(ranks), np.concatenate(darts)
    np.minimum.at(best, seat, rank)
    first = rank == best[seat]
    sig[seat[first]] = dart[first]


def bands(batch: pa.RecordBatch) -> dict:
    """One hash per band of each text's signature, none for a text without words."""
    data, offsets = text_bytes(batch.column("_text"))
    sig, some = signatures(data, offsets)
    total = np.zeros((len(sig), BANDS), np.uint64)
    for row in range(ROWS):
        total = mix64(total * GOLD + sig[:, row::ROWS])
    total = mix64(total + np.arange(BANDS, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
    ends = np.concatenate([[0], np.cumsum(some * BANDS)]).astype(np.int32)
    return {"bands": pa.ListArray.from_arrays(pa.array(ends), pa.array(total[some].ravel().view(np.int64)))}


def fine_bits(batch: pa.RecordBatch) -> dict:
    """Four bits of each coordinate of a finer signature of each text, packed, and the text's whole weight.

    However short texts are, each gets thousands of darts, so few are taken at once.
    """
    data, offsets = text_bytes(batch.column("_text"))
    n = batch.num_rows
    packed, weight = np.zeros((n, LONGS), np.uint64), np.zeros(n)
    for start in range(0, n, FINE_ROWS):
        here = offsets[start: start + FINE_ROWS + 1]
        part, ends = data[here[0]: here[-1]], here - here[0]
        sig, _ = signatures(part, ends, FINE)
        rows, _, width = cells(part, ends)
        nibbles = (sig & np.uint64(15)).reshape(len(sig), LONGS, 16) << (np.arange(16, dtype=np.uint64) * np.uint64(4))
        packed[start: start + len(sig)] = nibbles.sum(axis=2, dtype=np.uint64)
        weight[start: start + len(sig)] = np.bincount(rows, weights=width, minlength=len(sig))
    ends = np.arange(n + 1, dtype=np.int32) * LONGS
    return {"bits": pa.ListArray.from_arrays(pa.array(ends), pa.array(packed.ravel().view(np.int64))), "weight": pa.array(weight)}


def _differing(x: Column) -> Column:
    """How many groups of four bits are not all zero."""
    folded = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseOR(F.shiftrightunsigned(x, 2)).bitwiseOR(F.shiftrightunsigned(x, 3))
    return F.bit_count(folded.bitwiseAND(F.lit(0x1111111111111111)))


def may_be_linked(one: str, two: str) -> Column:
    """Whether two packed fine signatures agree in as many coordinates as a link has; a part of them is tried first."""
    apart = [_differing(F.col(one)[i].bitwiseXOR(F.col(two)[i])) for i in range(COARSE // 16)]
    coarse = F.lit(COARSE) - sum(apart[1:], apart[0])
    every = F.aggregate(
        F.zip_with(one, two, lambda x, y: _differing(x.bitwiseXOR(y))), F.lit(0), lambda total, n: total + n
    )
    return (coarse >= least_agreeing(COARSE)) & (F.lit(FINE) - every >= least_agreeing(FINE))


def likeness(a: bytes, b: bytes) -> float:
    """Weighted Jaccard likeness of two texts: the weight they share of the weight they cover."""
    joined = np.frombuffer(a + b, np.uint8)
    rows, keys, width = cells(joined, np.array([0, len(a), len(a) + len(b)]))
    n = int((rows == 0).sum())
    _, mine, other = np.intersect1d(keys[:n], keys[n:], assume_unique=True, return_indices=True)
    shared = np.minimum(width[:n][mine], width[n:][other]).sum()
    total = width.sum() - shared
    return float(shared / total) if total else 0.0


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Likeness of pairs (a, b) of node keys; ``texts`` holds one text per node."""
    left = texts.select(F.col("key").alias("a"), F.col("text").alias("_text"))
    right = texts.select(F.col("key").alias("b"), F.col("text").alias("_other"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "_text", "_other")

    def run(batch: pa.RecordBatch) -> dict:
        mine, other = binary_list(batch.column("_text")), binary_list(batch.column("_other"))
        return {"likeness": pa.array([likeness(x, y) for x, y in zip(mine, other)], pa.float64())}

    return map_slices(both, "_text", "likeness double", run, ["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """Smallest key reachable over links (a, b) from each key, as (key, class_key).

    Each round takes the smallest class among a key's neighbours, then the class of that class, and is saved.
    """
    both = saved(links.select("a", "b").union(links.select("b", "a")), "links")
    labels = saved(both.groupBy(F.col("a").alias("key")).agg(F.least(F.min("b"), F.col("key")).alias("class_key")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["key"]).groupBy("a").agg(F.min("class_key").alias("near"))
        own = labels.join(near, labels["key"] == near["a"]).select(
            "key", F.least("class_key", "near").alias("class_key"), F.col("class_key").alias("was")
        )
        over = labels.select(F.col("key").alias("_at"), F.col("class_key").alias("_over"))
        jumped = saved(
            own.join(over, own["class_key"] == over["_at"], "left").select(
                "key", F.least("class_key", F.coalesce("_over", "class_key")).alias("class_key"), "was"
            ), "labels",
        )
        labels = jumped.select("key", "class_key")
        if jumped.where("class_key <> was").isEmpty():
            return labels


def _classed(entries: DataFrame, classes: DataFrame) -> DataFrame:
    """Band entries (bucket, leader, key) with the class of each key so far."""
    return entries.join(classes, "key", "left").select(
        "bucket", "leader", "key", F.coalesce("class_key", "key").alias("class_key")
    )


def _open(entries: DataFrame) -> DataFrame:
    """Entries of buckets that hold keys of different classes."""
    sums = entries.groupBy("bucket").agg(F.min("class_key").alias("_low"), F.max("class_key").alias("_high"))
    return entries.join(sums.where("_low <> _high").select("bucket"), "bucket")


def near_classes(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``key`` (its text's hash), ``class_id`` and ``class_key``."""
    given = docs.select("doc_id", F.unhex(F.md5(whole_text())).alias("key"), whole_text().alias("_text"))
    signed = saved(map_slices(given, "_text", "bands array<bigint>", bands, ["doc_id", "key"]), "signed")
    nodes = signed.groupBy("key").agg(F.min("doc_id").alias("first_id"))
    shared = signed.select("key", F.explode("bands").alias("bucket")).distinct()
    crowded = shared.groupBy("bucket").agg(F.count(F.lit(1)).alias("company")).where("company > 1")
    met = saved(shared.join(crowded, "bucket").select("bucket", "key", "company"), "entries")
    company = met.groupBy("key").agg(F.sum("company").alias("hub"))
    leaders = met.join(company, "key").groupBy("bucket").agg(F.max(F.struct("hub", "key")).alias("_most"))
    entries = saved(
        met.join(leaders, "bucket").select("bucket", "key", F.col("_most")["key"].alias("leader")), "entries"
    )

    # one text per node that shares a bucket
    wanted = nodes.join(entries.select("key").distinct(), "key")
    texts = saved(
        given.join(wanted, (given["key"] == wanted["key"]) & given["doc_id"].eqNullSafe(wanted["first_id"]), "left_semi")
        .select("key", F.col("_text").alias("text")).dropDuplicates(["key"]), "texts",
    )

    pairs = entries.where("key <> leader").select(F.col("leader").alias("a"), F.col("key").alias("b")).distinct()
    tested = saved(_verified(pairs, texts), "tested")
    links = tested.where(F.col("likeness") >= LIKENESS)
    classes = components(links)

    # what is left: keys of one bucket in different classes, not yet compared with each other
    left = _open(_classed(entries, classes))
    known = tested.select(F.col("a").alias("leader"), F.col("b").alias("key"), (1 - F.col("likeness")).alias("_far"))
    left = saved(
        left.join(known, ["leader", "key"], "left").withColumn(
            "far", F.when(F.col("key") == F.col("leader"), 0.0).otherwise(F.col("_far"))
        ).select("bucket", "leader", "key", "class_key", "far"), "left",
    )
    open_texts = texts.join(left.select("key").distinct(), "key", "left_semi").withColumnRenamed("text", "_text")
    fine = map_slices(open_texts, "_text", "bits array<bigint>, weight double", fine_bits, ["key"])
    of_key = saved(fine.join(signed.select("key", "bands").dropDuplicates(["key"]), "key"), "fine")
    left = saved(left.join(of_key, "key"), "left")
    one, two = left.alias("one"), left.alias("two")
    lighter, heavier = F.least("one.weight", "two.weight"), F.greatest("one.weight", "two.weight")
    rest = one.join(
        two, (F.col("one.bucket") == F.col("two.bucket")) & (F.col("one.key") < F.col("two.key"))
        & (F.col("one.class_key") != F.col("two.class_key"))
        & (F.col("one.key") != F.col("one.leader")) & (F.col("two.key") != F.col("two.leader"))
        & (lighter >= LIKENESS * heavier * (1 - 1e-9))
        & (F.abs(F.col("one.far") - F.col("two.far")) <= 1 - LIKENESS + 1e-9)
        & may_be_linked("one.bits", "two.bits")
        # each pair comes from the first bucket it shares
        & (F.array_min(F.array_intersect("one.bands", "two.bands")) == F.col("one.bucket")),
    ).select(F.col("one.key").alias("a"), F.col("two.key").alias("b"))
    known_pairs = tested.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = rest.join(known_pairs, ["a", "b"], "left_anti")
    more = saved(_verified(rest, texts), "tested").where(F.col("likeness") >= LIKENESS)
    if not more.isEmpty():
        classes = components(links.unionByName(more))

    named = nodes.join(classes, "key", "left").select("key", "first_id", F.coalesce("class_key", "key").alias("class_key"))
    ids = named.groupBy("class_key").agg(F.min("first_id").alias("class_id"))
    classed = saved(named.join(ids, "class_key").select("key", "class_key", "class_id"), "classes")
    return signed.select("doc_id", "key").join(classed, "key")


def keep_first(docs: DataFrame) -> DataFrame:
    """One document of each class, with all its columns: the one that names it, or any where no doc_id is given."""
    classes = near_classes(docs)
    firsts = classes.groupBy("class_key").agg(F.min("class_id").alias("_id"), F.min("key").alias("_low"))
    # the smallest key among the rows that carry the class's id; repeated rows are equal in both
    chosen = classes.join(firsts, "class_key").where(F.col("doc_id").eqNullSafe(F.col("_id"))).groupBy("class_key").agg(
        F.min("key").alias("_key"), F.min("_id").alias("_id")
    )
    row = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "doc_id",
        F.unhex(F.md5(whole_text())).alias("key"),
    )
    kept = row.join(chosen, (row["key"] == chosen["_key"]) & row["doc_id"].eqNullSafe(chosen["_id"]))
    single = kept.dropDuplicates(["class_key"])
    return single.select(*[F.col("_row")[c].alias(c) for c in docs.columns])


def op6_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id")
