"""Phrase collocation mining after Toivonen (operator 13).

Texts are cut into pieces at punctuation and line ends, pieces into words. Frequent phrases (contiguous words of one
piece, per language) are found in these steps:

1. A sample of documents proposes phrases: level by level, those frequent in it by a lowered threshold.
2. A full pass counts every proposed phrase, and the negative border with it: all phrases that were not proposed
   although both phrases of one word less within them were. All single words belong to one or the other.
3. Border phrases that turn out frequent are the failures of the proposal. If there are any, an expansion pass counts
   what they bring into reach: every phrase not counted yet, of any length, that holds no phrase known to be rare. A
   frequent phrase holds only frequent phrases, so it has then been counted: the expansion is closed after one pass,
   and the sample decides how much is counted and nothing else.
4. These passes count 64-bit hashes, so that two numbers a phrase and task are shuffled. Hashes that collide add up,
   which can only make more phrases look frequent. The last pass counts the few that are left by their whole texts.

What has been proposed reaches the tasks as a bit map of phrase hashes of at most ``2 ** MOST_BITS`` bits, whatever
the number of phrases. A phrase belongs to a pass by the bits of itself and its inner phrases alone, the same in every
task: bits that collide make a pass count more phrases than needed, never fewer or in part, and a phrase is counted in
one pass at most. A phrase that occurs everywhere sends one number a task.

Scores are whole numbers of up to 38 digits. A candidate is dropped where a longer one as frequent holds it; it is
enough to look at candidates of one word more, as all phrases between the two are as frequent.

Defined cases: a null text is an empty one; a null language is ``und``; A-Z count as a-z, no other letters change;
words of any characters but space and tab; texts without words add nothing; repeated rows each count; an empty table
or one without frequent phrases gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from surveyloom.llm.common import GOLD, looked_up, mix64, powers, saved, table, text_bytes, text_slices, whole_text

LONGEST = 5
LEAST = 100
TOP = 2_000
SAMPLE = 8
SLICE = 1 << 19
LEAST_BITS, MOST_BITS = 20, 28
# Expected share of the threshold in the sample, less two standard deviations.
LOWERED = max(2, math.floor(LEAST / SAMPLE - 2 * math.sqrt(LEAST / SAMPLE)))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_BLANK = np.zeros(256, bool)
_BLANK[[9, 32]] = True
_BASE = 0xD6E8FEB86659FD93
_FACTORS = [np.uint64(pow(int(GOLD), j + 1, 1 << 64)) for j in range(LONGEST)]


def lang_seed(lang: str) -> int:
    return int.from_bytes(hashlib.md5(lang.encode()).digest()[:8], "little")


class Words:
    """The words of a slice of texts: where they lie, which run of words they belong to, and hashes of phrases."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, seeds: np.ndarray):
        low = _LOWER[data]
        breaks = _BREAK[low]
        solid = ~(breaks | _BLANK[low])
        opens = np.zeros(len(low) + 1, bool)
        opens[offsets] = True  # a text's first byte, or the end
        before = np.r_[False, solid[:-1]]
        starts = np.flatnonzero(solid & (~before | opens[:-1]))
        ends = np.flatnonzero(np.r_[before, solid[-1:]] & (np.r_[~solid, True] | opens))
        self.starts, self.ends = starts, ends
        self.rows = np.searchsorted(offsets, starts, side="right") - 1
        self.runs = np.cumsum(breaks)[starts] + self.rows if len(starts) else self.rows
        # the same words with one space behind each
        keep = solid.copy()
        keep[1:] |= solid[:-1]
        self.text = np.where(solid, low, np.uint8(32))[keep]
        moved = np.cumsum(keep) - 1
        self.text_starts = moved[starts]
        self.text_ends = self.text_starts + (ends - starts)
        total = np.zeros(len(low) + 1, np.uint64)
        np.cumsum((low.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(low)), dtype=np.uint64, out=total[1:])
        back = powers(pow(_BASE, -1, 1 << 64), len(low))[starts]
        self.hashes = mix64((total[ends] - total[starts]) * back + (ends - starts).astype(np.uint64) * GOLD)
        self.seeds = seeds[self.rows]

    def phrases(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First words of all phrases of this many words, and the phrases' hashes, whose language is part of them."""
        n = len(self.starts) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        first = np.flatnonzero(self.runs[:n] == self.runs[size - 1:])
        return first, self.combined(first, size, np.uint64(0))

    def combined(self, first: np.ndarray, size: int, form: np.uint64) -> np.ndarray:
        """A hash of the phrases that start at these words; each form is a hash of its own."""
        total = self.seeds[first] + np.uint64(size) + form * GOLD
        for j in range(size):
            word = self.hashes[first + j]
            total += (mix64(word + form) if form else word) * _FACTORS[j]
        return mix64(total)


def phrase_hash(lang: str, phrase: str) -> int:
    """The hash under which a phrase of lower-case words is proposed and counted."""
    data = np.frombuffer(phrase.encode(), np.uint8)
    words = Words(data, np.array([0, len(data)]), np.array([lang_seed(lang)], np.uint64))
    return int(words.phrases(len(words.starts))[1].view(np.int64)[0])


def within(bits: np.ndarray | None, hashes: np.ndarray) -> np.ndarray:
    """Whether the bits of these hashes are set; nothing is in a map that there isn't."""
    if bits is None:
        return np.zeros(len(hashes), bool)
    at = hashes >> np.uint64(64 - (len(bits) * 64).bit_length() + 1)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def in_reach(
    words: Words, proposed: np.ndarray | None, known: np.ndarray | None, sizes: Sequence[int]
) -> Iterator[np.ndarray]:
    """Hashes of the phrases that a pass counts, occurrence by occurrence, size by size.

    The first pass (``known`` is None) counts words, and phrases whose two inner phrases are proposed. The second
    counts what the first left out, unless an inner phrase can't be frequent: one that was counted can if it is
    ``known`` to be, one that was left out if its own inner phrases can.
    """
    first = was = can = None
    for size in range(1, max(sizes) + 1):
        inner_first, inner_was, inner_can = first, was, can
        first, hashes = words.phrases(size)
        if size == 1:
            counted = np.ones(len(first), bool)
        else:
            left = np.searchsorted(inner_first, first)
            counted = inner_was[left] & inner_was[left + 1]
        if known is None:
            use = counted
        else:
            can = within(known, hashes)
            if size > 1:
                can = np.where(counted, can, inner_can[left] & inner_can[left + 1])
            use = can & ~counted
        was = within(proposed, hashes)
        if size in sizes:
            yield hashes[use]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Words, list[str]]]:
    """The words of bounded slices of rows, and the rows' languages."""
    for batch in batches:
        for part in text_slices(batch, "_text", SLICE):
            langs = part.column("lang").to_pylist()
            seeds = {lang: lang_seed(lang) for lang in set(langs)}
            yield Words(*text_bytes(part.column("_text")), np.array([seeds[x] for x in langs], np.uint64)), langs


def hash_counts(docs: DataFrame, proposed: Broadcast | None, known: Broadcast | None, sizes: Sequence[int]) -> DataFrame:
    """Occurrences ``f`` of the phrases in reach, by ``hash``: two numbers a phrase and task are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, _ in _slices(batches):
            found = list(in_reach(words, proposed and proposed.value, known and known.value, sizes))
            seen, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(seen.view(np.int64)), pa.array(n.astype(np.int64))], names=["hash", "n"])

    made = docs.select("lang", "_text").mapInArrow(run, "hash bigint, n bigint")
    return made.groupBy("hash").agg(F.sum("n").alias("f"))


def text_counts(docs: DataFrame, wanted: Broadcast) -> DataFrame:
    """Occurrences ``f`` by ``lang``, ``size`` and ``phrase`` of the phrases whose hash has its bit set.

    Rows of size 0 hold the number of words of each language.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, langs in _slices(batches):
            yield _totals(words, langs)
            for size in range(1, LONGEST + 1):
                first, hashes = words.phrases(size)
                use = within(wanted.value, hashes)
                if use.any():
                    yield _rows(words, langs, size, first[use], hashes[use])

    made = docs.select("lang", "_text").mapInArrow(run, "size int, n bigint, lang string, phrase string")
    return made.groupBy("size", "lang", "phrase").agg(F.sum("n").alias("f"))


def _totals(words: Words, langs: list[str]) -> pa.RecordBatch:
    of_row = np.bincount(words.rows, minlength=len(langs))
    totals: dict[str, int] = {}
    for lang, n in zip(langs, of_row.tolist()):
        totals[lang] = totals.get(lang, 0) + n
    return pa.RecordBatch.from_arrays(
        [pa.array([0] * len(totals), pa.int32()), pa.array(list(totals.values()), pa.int64()),
         pa.array(list(totals), pa.string()), pa.array([""] * len(totals), pa.string())],
        names=["size", "n", "lang", "phrase"],
    )


def _rows(words: Words, langs: list[str], size: int, first: np.ndarray, hashes: np.ndarray) -> pa.RecordBatch:
    """The different phrases of a slice and their counts."""
    begin, end = words.text_starts[first], words.text_ends[first + size - 1]
    again = words.combined(first, size, np.uint64(1))  # 128 bits together tell phrases apart
    order = np.lexsort((again, hashes))
    opens = np.r_[True, (np.diff(hashes[order]) != 0) | (np.diff(again[order]) != 0)]
    at, n = order[opens], np.diff(np.r_[np.flatnonzero(opens), len(order)])
    begin, end = begin[at], end[at]
    ends = np.concatenate([[0], np.cumsum(end - begin)])
    places = np.arange(ends[-1]) + np.repeat(begin - ends[:-1], end - begin)
    phrase = pa.StringArray.from_buffers(
        len(at), pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(words.text[places].tobytes())
    )
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(at), size, np.int32)), pa.array(n.astype(np.int64)),
         pa.array([langs[row] for row in words.rows[first[at]]], pa.string()), phrase],
        names=["size", "n", "lang", "phrase"],
    )


def map_size(n: int) -> int:
    """Bits of a map for this many phrases, as a power of two: 16 a phrase, within the bounds."""
    return min(MOST_BITS, max(LEAST_BITS, (16 * n).bit_length()))


def bit_map(proposed: DataFrame, size: int) -> np.ndarray:
    """A map of ``2 ** size`` bits with the bit of each ``hash`` set."""
    at = F.shiftrightunsigned("hash", 64 - size)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), at.bitwiseAND(F.lit(63)).cast("int"))
    chunks = proposed.groupBy(F.shiftrightunsigned(at, 6).alias("chunk")).agg(F.bit_or(bit).alias("bits"))
    rows = chunks.toArrow()  # at most 2 ** (MOST_BITS - 6) rows of 16 bytes
    bits = np.zeros(1 << (size - 6), np.uint64)
    bits[rows.column("chunk").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return bits


def _words_of(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), whole_text().alias("_text"), "doc_id")


def proposal(given: DataFrame, lowered: int = LOWERED, one_in: int = SAMPLE) -> DataFrame:
    """Hashes of phrases up to one word shorter than the longest that are frequent in a sample, level by level."""
    spark = given.sparkSession
    chosen = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-1)), F.lit(13)), F.lit(one_in)) == 0
    sample = saved(given.where(chosen).select("lang", "_text"), "sample")
    levels = found = saved(hash_counts(sample, None, None, [1]).where(F.col("f") >= lowered).select("hash"), "proposed")
    for size in range(2, LONGEST):
        n = found.count()
        if not n:
            break
        bits = spark.sparkContext.broadcast(bit_map(found, map_size(n)))
        found = saved(hash_counts(sample, bits, None, [size]).where(F.col("f") >= lowered).select("hash"), "proposed")
        levels = levels.unionByName(found)
    return levels


def frequent(docs: DataFrame, least: int = LEAST, proposed: DataFrame | None = None) -> DataFrame:
    """Phrases of 1 to ``LONGEST`` words that occur ``least`` times or more: ``lang``, ``size``, ``phrase``, ``f``.

    Rows of size 0 give each language's number of words. ``proposed`` replaces the sample's proposal.
    """
    spark = docs.sparkSession
    given = _words_of(docs)
    every = range(1, LONGEST + 1)
    proposed = (proposal(given) if proposed is None else proposed).select("hash")
    bits = bit_map(proposed, map_size(proposed.count()))
    shared = spark.sparkContext.broadcast(bits)
    often = F.col("f") >= least
    found = saved(hash_counts(given, shared, None, every).where(often).select("hash"), "frequent")
    if not _outside(found, bits).isEmpty():
        known = spark.sparkContext.broadcast(bit_map(found, map_size(4 * found.count())))
        found = found.unionByName(saved(hash_counts(given, shared, known, every[1:]).where(often).select("hash"), "frequent"))
    wanted = spark.sparkContext.broadcast(bit_map(found, map_size(4 * found.count())))
    return saved(text_counts(given, wanted).where(often | (F.col("size") == 0)), "phrases")


def _outside(found: DataFrame, bits: np.ndarray) -> DataFrame:
    """Hashes of found phrases whose bit isn't set."""
    shared = found.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column("hash").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(hashes[~within(shared.value, hashes.view(np.uint64))])], names=["hash"])

    return found.select("hash").mapInArrow(run, "hash bigint")


def _part(name: str, start, length) -> Column:
    words = F.split(F.col(name), " ")
    return F.array_join(F.slice(words, start, length), " ")


def collocations(counts: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """The best phrases of each language, from written counts of all frequent phrases."""
    longer = counts.where("size > 2")
    inside = longer.select("lang", F.explode(F.array(
        _part("phrase", F.lit(1), F.col("size") - 1), _part("phrase", F.lit(2), F.col("size") - 1)
    )).alias("phrase"), "f").distinct()
    candidates = counts.where("size > 1").select("lang", "phrase", "size", "f").join(inside, ["lang", "phrase", "f"], "left_anti")
    cuts = candidates.select(
        "lang", "phrase", F.col("f").alias("a"), F.posexplode(F.transform(
            F.sequence(F.lit(1), F.col("size") - 1),
            lambda k: F.struct(_part("phrase", F.lit(1), k).alias("first"), _part("phrase", k + 1, F.col("size") - k).alias("rest")),
        )).alias("k", "cut"),
    ).select("lang", "phrase", "a", "k", "cut.first", "cut.rest")
    known = counts.where("size > 0")
    cuts = saved(cuts, "cuts")
    with_left = saved(looked_up(cuts, known.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"]), "cuts")
    with_both = looked_up(with_left, known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    totals = counts.where("size = 0").select("lang", F.col("f").alias("n"))
    scored = looked_up(saved(with_both, "cuts"), totals, ["lang"]).withColumn("score", _score())
    worst = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("_cut")).select(
        "lang", "phrase", "a", "_cut.l", "_cut.r", "n", "_cut.score"
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = worst.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _score() -> Column:
    """floor(1000 * a * n / (l * r)) in whole numbers of up to 38 digits."""
    whole = "cast({} as decimal(18, 0))"
    a, n, left, right = (whole.format(x) for x in ("a", "n", "l", "r"))
    return F.expr(f"cast((cast(1000 as decimal(4, 0)) * ({a} * {n})) div ({left} * {right}) as bigint)")


def op13_toivonen_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(frequent(table(spark, sf_dir, "documents")))


OP13_SQL = """
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
spots AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded WHERE len(w) > 0),
grams AS (
    SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
    FROM spots, (SELECT unnest(range(1, 6)) AS m) WHERE i + m - 1 <= len(w)),
totals AS (SELECT lang, count(*) AS n FROM spots GROUP BY lang),
known AS (SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
inner_phrases AS (
    SELECT lang, f, unnest([
        array_to_string(string_split(phrase, ' ')[1:m - 1], ' '), array_to_string(string_split(phrase, ' ')[2:], ' ')
    ]) AS phrase FROM known WHERE m > 2),
candidates AS (SELECT * FROM known WHERE m > 1 AND (lang, phrase, f) NOT IN (SELECT (lang, phrase, f) FROM inner_phrases)),
cuts AS (
    SELECT lang, phrase, f AS a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS one,
        array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS two
    FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates)),
scored AS (
    SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, t.n,
        CAST(divide(1000::HUGEINT * c.a * t.n, x.f::HUGEINT * y.f) AS BIGINT) AS score
    FROM cuts c JOIN known x ON x.lang = c.lang AND x.phrase = c.one
    JOIN known y ON y.lang = c.lang AND y.phrase = c.two JOIN totals t ON t.lang = c.lang),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM worst)
WHERE rank <= 2000
"""
