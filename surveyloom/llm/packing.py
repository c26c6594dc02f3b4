"""Best-fit packing of token pieces into sequences by bin completion (operator 2).

Texts are encoded, ended by a separator and cut into pieces of at most the sequence length. How many pieces of each
length there are is all the search needs, and that table has at most one row per length whatever the input. The
search fills sequences around the longest piece left: it enumerates the fillings of the space beside it that no other
dominates (a filling dominates another whose pieces fit into its own), takes as many sequences of a filling as the
counts allow, and goes on with the next longest. A branch whose waste so far leaves no chance to beat the best
solution known is pruned; that solution, the incumbent, starts as best-fit decreasing, and a solution at the lower
bound, all tokens over the sequence length, ends the search. A budget of steps in proportion to the number of lengths
(``STEPS``, ``STEPS_A_LENGTH``) is its only limit; what is best by then is used.

The solution is a list of runs, "the next pieces of this length go to these sequences at this offset". Pieces are
numbered within their length, over split groups, and look up their run; no piece is gathered anywhere.

Defined cases: a null text is an empty one and gives one piece of the separator alone; repeated rows are packed each;
an empty table gives an empty result; columns beyond the needed ones are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.llm.common import binary_list, running_total, saved, slices_for, table, text_slices, whole_text
from surveyloom.llm.tokens import Encoder

SEQUENCE = 2048
# Budget of the search: so many steps, and so many more for each different length.
STEPS = 1_000_000
STEPS_A_LENGTH = 500


def pieces(
    docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE, separator: int = 0, keep_ids: bool = False
) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32) of the encoded texts, with ``ids`` if kept.

    ``ids`` are unsigned 32-bit little-endian numbers. ``tokenizer`` is a file that every executor can read.
    """
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * keep_ids
    end = np.uint32(separator).tobytes()
    step = 4 * sequence

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer)
        for batch in batches:
            for part in text_slices(batch, "_text"):
                rows = []
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), encoder.encode(binary_list(part.column("_text")))):
                    ids += end
                    for at in range(0, len(ids), step):
                        cut = ids[at: at + step]
                        rows.append((doc_id, at // step, at // 4, len(cut) // 4, zlib.crc32(cut), cut))
                columns = list(zip(*rows))[: 6 if keep_ids else 5]
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(columns)],
                )

    given = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("_text"))
    return given.mapInArrow(run, schema)


Filling = tuple[tuple[int, int], ...]  # (length, how many), longest first


def dominates(one: list[int], two: list[int]) -> bool:
    """Whether the pieces of ``two`` can be put into the pieces of ``one``, each of ``one`` holding several."""
    space = sorted(one)
    for length in sorted(two, reverse=True):
        fit = next((i for i, room in enumerate(space) if room >= length), None)
        if fit is None:
            return False
        space[fit] -= length
        space.sort()
    return True


class Budget:
    """Steps that a search may still take; a step looks at one piece for one place."""

    def __init__(self, steps: int):
        self.left = steps

    def spend(self) -> bool:
        self.left -= 1
        return self.left >= 0


def fillings(
    counts: dict[int, int], lengths: list[int], room: int, waste_left: int, budget: Budget | None = None,
    few_first: bool = True,
) -> Iterator[list[int]]:
    """Undominated sets of pieces for a space that waste no more than ``waste_left``, one by one.

    Sets come in bands of growing waste; in a band either those of few pieces first, which leave short pieces for
    later, or those of the longest pieces first, however many there are. A single piece that fills the space dominates
    every other set, so it is the only one then; a set that an earlier one dominates, or that a further piece would
    fit, is left out.
    """
    if counts.get(room, 0):
        yield [room]
        return
    budget = budget or Budget(1 << 62)
    smallest = next((x for x in lengths if counts[x]), None)
    if smallest is None or smallest > room:
        if room <= waste_left:
            yield []
        return
    kept: list[list[int]] = []
    least = -1
    for most in sorted({0, waste_left // 64, waste_left // 8, waste_left}) if waste_left >= 0 else []:
        for pieces_left in range(1, room // smallest + 1) if few_first else [None]:
            for filling in _grown(counts, lengths, [], room, room, pieces_left, (least, most), budget):
                if not any(dominates(other, filling) for other in kept):
                    kept.append(filling)
                    yield filling
            if budget.left <= 0:
                return
        least = most


def _grown(
    counts: dict[int, int], lengths: list[int], chosen: list[int], space: int, top: int, pieces_left: int | None,
    waste: tuple[int, int], budget: Budget,
) -> Iterator[list[int]]:
    """Sets of so many (or any number of) more pieces of at most ``top``, longest first, within a band of waste.

    A band holds the sets whose waste lies above its first bound and not above the second.
    """
    least, most = waste
    smallest = next((x for x in lengths if counts[x] > chosen.count(x)), None)
    full = smallest is None or smallest > space
    if full or pieces_left == 0:
        if full and not pieces_left and least < space <= most:
            yield chosen
        return
    longest = min(top, space)
    if pieces_left:  # those still to come take the smallest at least, and none of them is longer than this one
        longest = min(longest, space - (pieces_left - 1) * smallest, space - least - 1 if pieces_left == 1 else space)
    at = bisect_right(lengths, longest) - 1
    while at >= 0:
        length = lengths[at]
        if pieces_left and length * pieces_left < space - most:
            return
        if space - smallest < length < space - most:  # it would leave too much, and nothing fits beside it
            at = bisect_right(lengths, space - smallest) - 1
            continue
        at -= 1
        if not budget.spend():
            return
        if counts[length] > chosen.count(length):
            left = pieces_left and pieces_left - 1
            yield from _grown(counts, lengths, [*chosen, length], space - length, length, left, waste, budget)


Step = tuple[int, list[int], int]  # longest piece, its filling, how many sequences


def best_fit(counts: dict[int, int], sequence: int) -> list[Step]:
    """Best-fit decreasing on counts: beside the longest piece goes the longest that still fits, and so on."""
    left = {k: v for k, v in counts.items() if v}
    lengths = sorted(left)
    steps: list[Step] = []
    while lengths:
        longest, chosen, used = lengths[-1], [], {lengths[-1]: 1}
        space = sequence - longest
        while space:
            at = bisect_right(lengths, space) - 1
            while at >= 0 and left[lengths[at]] <= used.get(lengths[at], 0):
                at -= 1
            if at < 0:
                break
            chosen.append(lengths[at])
            used[lengths[at]] = used.get(lengths[at], 0) + 1
            space -= lengths[at]
        steps.append((longest, chosen, _take(left, lengths, used)))
    return steps


def _take(left: dict[int, int], lengths: list[int], used: dict[int, int]) -> int:
    """Take a filling as often as the counts allow, and return how often."""
    times = min(left[x] // n for x, n in used.items())
    for x, n in used.items():
        left[x] -= times * n
        if not left[x]:
            del left[x]
            lengths.remove(x)
    return times


def complete(counts: dict[int, int], sequence: int = SEQUENCE, steps: int | None = None) -> list[Step]:
    """Fillings and how often each is used, for as few sequences as the search finds within its budget of steps.

    The search runs in waves. A wave leaves the first choice at no more places than its limit, which doubles from wave
    to wave, so early choices are reconsidered as soon as late ones; the last waves have no limit. Each limit serves
    both orders of fillings. A choice is a filling and how often it is used: as often as the counts allow first, then
    half as often, down to once.
    """
    total = sum(x * n for x, n in counts.items())
    floor = -(-total // sequence)
    incumbent = best_fit(counts, sequence)
    best = sum(times for *_, times in incumbent)
    budget = Budget(STEPS + STEPS_A_LENGTH * len(counts) if steps is None else steps)
    waves = [(limit, few_first) for limit in (1, 2, 4, 8, 16, None) for few_first in (True, False)]
    for number, (limit, few_first) in enumerate(waves):
        share = Budget(budget.left // min(4, len(waves) - number))
        given = share.left
        while best > floor and share.left > 0:
            found = _better(counts, sequence, total, best, limit, few_first, share)
            if found is None:
                break
            incumbent = found
            best = sum(times for *_, times in incumbent)
        budget.left -= given - max(0, share.left)
    return incumbent


def _better(
    counts: dict[int, int], sequence: int, total: int, best: int, limit: int | None, few_first: bool, budget: Budget
) -> list[Step] | None:
    """A solution of fewer than ``best`` sequences, or None where the wave has none or the budget is spent."""

    def options(left: dict[int, int], lengths: list[int], made: int, rest: int) -> Iterator[tuple[int, list[int], int]]:
        longest = lengths[-1]
        wasted = made * sequence - (total - rest)
        left[longest] -= 1
        given = dict(left)
        left[longest] += 1
        for chosen in fillings(given, lengths, sequence - longest, (best - 1) * sequence - total - wasted, budget, few_first):
            used = Counter([longest, *chosen])
            times = min(left[x] // n for x, n in used.items())
            while times:
                yield longest, chosen, times
                times //= 2

    start = {k: v for k, v in counts.items() if v}
    stack = [(start, 0, None, 0, options(start, sorted(start), 0, total))]
    while stack and budget.spend():
        left, made, path, turned, choices = stack[-1]
        step = next(choices, None)
        if step is None:
            stack.pop()
            continue
        # every choice but a node's first uses up one of the wave's turns
        stack[-1] = (left, made, path, turned + 1, choices)
        if limit is not None and turned > limit:
            stack.pop()
            continue
        longest, chosen, times = step
        after = dict(left)
        for x, n in Counter([longest, *chosen]).items():
            after[x] -= times * n
            if not after[x]:
                del after[x]
        rest = sum(x * n for x, n in after.items())
        here = (path, step)
        if made + times + -(-rest // sequence) >= best:
            continue
        if not after:
            return _unwound(here)
        stack.append((after, made + times, here, turned, options(after, sorted(after), made + times, rest)))
    return None


def _unwound(path: tuple | None) -> list[Step]:
    """The steps of a path, first one first."""
    steps = []
    while path:
        path, step = path
        steps.append(step)
    return steps[::-1]


def runs(steps: list[Step]) -> pd.DataFrame:
    """Runs of pieces by (length, first number): their first sequence, offset, and pieces of that length a sequence."""
    used: dict[int, int] = {}
    rows, sequence_id = [], 0
    for longest, chosen, times in steps:
        offset, groups = 0, {}
        for x in [longest, *chosen]:
            groups[x] = groups.get(x, 0) + 1
        for length, n in groups.items():
            rows.append((length, used.get(length, 0), sequence_id, offset, n))
            used[length] = used.get(length, 0) + times * n
            offset += length * n
        sequence_id += times
    frame = pd.DataFrame(rows, columns=["length", "first", "sequence_id", "offset", "each"], dtype="int64")
    return frame.sort_values(["length", "first"], ignore_index=True)


def pack(cut: DataFrame, sequence: int = SEQUENCE, steps: int | None = None) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to saved pieces (doc_id, piece, length and any other columns)."""
    counts = {row["length"]: row["n"] for row in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = runs(complete(counts, sequence, steps))  # bounded by the sequence length, not by the input
    slices = slices_for(sum(counts.values()))
    hashed = F.xxhash64("doc_id", "piece", "ids_crc32")
    numbered = running_total(
        cut.withColumn("_hash", hashed).withColumn("_part", F.pmod("_hash", F.lit(slices)).cast("int")).withColumn("_one", F.lit(1)),
        ["length"], ["_hash", "doc_id", "piece"], "_part", "_one", "_number",
    ).drop("_hash", "_part", "_one")
    # one sortable key for (length, number): counts stay below 2**48
    keys = (plan["length"].to_numpy() << 48) + plan["first"].to_numpy()
    first, start = plan["first"].to_numpy(), plan["sequence_id"].to_numpy()
    offset, each = plan["offset"].to_numpy(), plan["each"].to_numpy()

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def place(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        size, at = length.to_numpy(), number.to_numpy()
        row = np.searchsorted(keys, (size << 48) + at, side="right") - 1
        nth = at - first[row]
        return pd.DataFrame({
            "sequence_id": start[row] + nth // each[row], "offset": offset[row] + nth % each[row] * size,
        })

    placed = numbered.withColumn("_place", place("length", "_number"))
    return placed.select(*cut.columns, "_place.sequence_id", "_place.offset")


def best_fit_pack(docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE, separator: int = 0) -> DataFrame:
    """Encode, cut and pack documents."""
    return pack(saved(pieces(docs, tokenizer, sequence, separator), "pieces"), sequence)


def op2_bin_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return best_fit_pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
