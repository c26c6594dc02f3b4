"""CSV records whose quoted fields may span lines, read by many tasks.

Whether a line starts inside a quoted field depends on all lines before it, which is why such a file is usually read
by one task. Here a first pass condenses each block of a file (the part that one task reads) to a function: the state
at its end, for either state at its start. Composing the functions of the blocks before it gives every block its
start, and a second pass joins lines to records, block by block. The text is never shuffled; only the pieces of a
record that lies on a block's edge are, at most two a block.

A quote opens a field only at the field's start, so a quote inside an unquoted field is plain text; inside a quoted
field a quote is written twice. Lines end with a line feed, or a carriage return and a line feed; records of white
space alone are skipped. The first record of each file is its header.

Rows of metadata reach the driver and the tasks: one per block and per file, and one per distinct header.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Places in a table are file number and line in one whole number.
LINE_BITS = 40
_BLOCK_SCHEMA = "file string, start bigint, block bigint, lines bigint, from_outside int, from_inside int, header string"
_RECORD_SCHEMA = "place bigint, header int, kind int, closed boolean, record string"
_WHOLE, _OPENING, _GOING_ON = 0, 1, 2


def state_after(inside: bool, line: str, delimiter: str = ",") -> bool:
    """Whether the end of a line lies inside a quoted field, from the same question at its start."""
    return bool(states(pa.array([line], pa.string()), inside, delimiter)[-1])


def _turns(lines: pa.Array, delimiter: str) -> tuple[np.ndarray, np.ndarray]:
    """Pieces that change the state: the line each lies in, and whether it turns the state or ends a field.

    A piece lies between delimiters or ends of lines. One with an even number of quotes changes nothing; of the others
    one that starts with a quote opens a field outside and closes one inside, any other closes a field inside and is
    plain text outside, so that the state behind it is outside in both cases.
    """
    wide = np.int64 if pa.types.is_large_string(lines.type) else np.int32
    offsets = np.frombuffer(lines.buffers()[1], wide)[lines.offset: lines.offset + len(lines) + 1].astype(np.int64)
    data = np.frombuffer(lines.buffers()[2] or b"", np.uint8)[offsets[0]: offsets[-1]]
    offsets = offsets - offsets[0]
    quotes = np.flatnonzero(data == 34)
    if not len(quotes):
        return quotes, np.zeros(0, bool)
    starts = np.zeros(len(data) + 1, bool)
    starts[1:][data == ord(delimiter)] = True
    starts[offsets[:-1]] = True
    piece = np.cumsum(starts, dtype=np.int32)[quotes]
    first = np.flatnonzero(np.r_[True, piece[1:] != piece[:-1]])
    odd = np.diff(np.r_[first, len(quotes)]) % 2 == 1
    at = quotes[first[odd]]
    return np.searchsorted(offsets, at, side="right") - 1, starts[at]


def states(lines: pa.Array, inside: bool, delimiter: str) -> np.ndarray:
    """The state at the start of each line, and behind the last one."""
    line, turning = _turns(lines, delimiter)
    turned = np.cumsum(turning)
    ended = np.maximum.accumulate(np.where(turning, -1, np.arange(len(line))))  # the last piece that ended a field
    since = turned - np.where(ended >= 0, turned[ended], 0)
    after = np.r_[inside, (since + np.where(ended >= 0, 0, int(inside))) % 2 == 1]
    return after[np.r_[0, np.searchsorted(line, np.arange(len(lines)), side="right")]]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with a hash of their block (file, start and length), the start of the block, and the file."""
    at = F.struct("_metadata.file_path", "_metadata.file_block_start", "_metadata.file_block_length")
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.xxhash64(at).alias("block"), F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_path").alias("file"),
    )


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, dict, pa.Array]]:
    """Consecutive lines of one block: whether the block begins with them, its numbers, and the lines."""
    last = None
    for batch in batches:
        blocks = batch.column("block").to_numpy()
        edges = np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1]]) if len(blocks) else []
        for begin, end in zip(edges, [*edges[1:], len(blocks)]):
            block = int(blocks[begin])
            numbers = {name: batch.column(name)[begin].as_py() for name in batch.schema.names if name != "value"}
            yield block != last, numbers, batch.column("value").slice(begin, end - begin)
            last = block


def _condensed(delimiter: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_block: dict | None = None
        for begins, numbers, lines in _by_block(batches):
            if begins:
                if open_block:
                    yield _block_row(open_block)
                open_block = {**numbers, "lines": 0, "states": [False, True], "header": [], "in_header": numbers["start"] == 0}
            _condense(open_block, lines, delimiter)
        if open_block:
            yield _block_row(open_block)

    return run


def _condense(block: dict, lines: pa.Array, delimiter: str) -> None:
    block["lines"] += len(lines)
    if block["in_header"]:
        after = states(lines, block["states"][0], delimiter)[1:]
        closed = np.flatnonzero(~after)
        block["header"] += lines.slice(0, closed[0] + 1 if len(closed) else len(lines)).to_pylist()
        block["in_header"] = not len(closed)
    _, turning = _turns(lines, delimiter)
    ends = np.flatnonzero(~turning)
    turned = bool(turning[ends[-1] + 1 if len(ends) else 0:].sum() % 2)
    block["states"] = [turned, turned] if len(ends) else [state != turned for state in block["states"]]


def _block_row(block: dict) -> pa.RecordBatch:
    header = "\n".join(block["header"]) if block["start"] == 0 else None
    return pa.RecordBatch.from_arrays(
        [pa.array([block["file"]], pa.string()), pa.array([block["start"]]), pa.array([block["block"]]), pa.array([block["lines"]]),
         pa.array([int(block["states"][0])], pa.int32()), pa.array([int(block["states"][1])], pa.int32()),
         pa.array([header], pa.string())],
        names=["file", "start", "block", "lines", "from_outside", "from_inside", "header"],
    )


@dataclass
class Layout:
    """What the second pass has to know of each block, sorted by ``block``, and of the files and headers."""

    block: np.ndarray
    inside: np.ndarray
    place: np.ndarray
    first: np.ndarray
    header: np.ndarray
    headers: list[list[str]]
    files: list[str]
    delimiter: str
    edges: bool  # whether a record lies on a block's edge, or a file ends inside a field

    def of(self, block: int) -> tuple[bool, int, bool, int]:
        at = int(np.searchsorted(self.block, block))
        if at == len(self.block) or self.block[at] != block:
            raise RuntimeError("the files or their splits changed between two passes; read them again")
        return bool(self.inside[at]), int(self.place[at]), bool(self.first[at]), int(self.header[at])


def _starts(blocks: DataFrame) -> DataFrame:
    """Blocks with the state at their start and the lines before them, by composing the blocks of a file in order."""
    until = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    fixed = F.col("from_outside") == F.col("from_inside")
    swaps = F.when(~fixed & (F.col("from_outside") == 1), 1).otherwise(0)
    turned = blocks.withColumn("_turns", F.sum(swaps).over(until) % 2)
    # a block that ends in one state whatever its start was sets the state; later swaps turn it
    turned = turned.withColumn("_set", F.when(fixed, F.col("from_outside").bitwiseXOR(F.col("_turns").cast("int"))))
    state = F.coalesce(F.last("_set", ignorenulls=True).over(before), F.lit(0)).bitwiseXOR(
        F.coalesce(F.lag("_turns").over(Window.partitionBy("file").orderBy("start")), F.lit(0)).cast("int")
    )
    ahead = F.coalesce(F.sum("lines").over(before), F.lit(0))
    starts = turned.select(*blocks.columns, state.alias("inside"), ahead.alias("ahead"))
    return starts.withColumn("ends", F.when(F.col("inside") == 1, F.col("from_inside")).otherwise(F.col("from_outside")))


def header_names(text: str, delimiter: str = ",") -> list[str]:
    """Column names of a header record, by Spark's rule: an empty name is ``_c<place>``, repeats get their place."""
    text = text.removeprefix("﻿").removesuffix("\r")
    names = next(csv.reader(io.StringIO(text, newline=""), delimiter=delimiter), [])
    low = [name.lower() for name in names]
    return [f"_c{i}" if not name else f"{name}{i}" if low.count(name.lower()) > 1 else name for i, name in enumerate(names)]


def layout(spark: SparkSession, path: str, delimiter: str = ",") -> Layout:
    """The first pass over the files of a path; the delimiter is one ASCII character."""
    if len(delimiter) != 1 or not delimiter.isascii() or delimiter == '"':
        raise ValueError("the delimiter is one ASCII character and no quote")
    lines = _lines(spark, path)
    blocks = lines.mapInArrow(_condensed(delimiter), _BLOCK_SCHEMA)
    found = _starts(blocks).toArrow()  # one row a block
    column = {name: found.column(name).to_pylist() for name in found.column_names}
    files = sorted(set(column["file"]))
    number = {file: i for i, file in enumerate(files)}
    texts: dict[str, int] = {}
    header_of = {}
    for file, start, text in zip(column["file"], column["start"], column["header"]):
        if start == 0:
            header_of[file] = texts.setdefault(text, len(texts))
    order = np.argsort(np.array(column["block"], np.int64))
    place = [(number[f] << LINE_BITS) + n + 1 for f, n in zip(column["file"], column["ahead"])]
    return Layout(
        np.array(column["block"], np.int64)[order], np.array(column["inside"], bool)[order],
        np.array(place, np.int64)[order], (np.array(column["start"], np.int64) == 0)[order],
        np.array([header_of[f] for f in column["file"]], np.int32)[order],
        [header_names(text, delimiter) for text in texts], files, delimiter, 1 in column["ends"],
    )


class _Joiner:
    """Joins the lines of one block to records."""

    def __init__(self, known: Layout, block: int):
        self.inside, self.line, self.skip, self.header = known.of(block)
        self.delimiter = known.delimiter
        self.open: list[str] = []
        self.kind = _GOING_ON if self.inside else _WHOLE
        self.place = self.line
        self.whole: list[tuple[np.ndarray, pa.Array]] = []  # records of one line
        self.rows: list[tuple[int, int, bool, str]] = []

    def add(self, lines: pa.Array) -> None:
        within = states(lines, self.inside, self.delimiter)
        number = np.arange(self.line, self.line + len(lines))
        self.line += len(lines)
        self.inside = bool(within[-1])
        alone = ~within[:-1] & ~within[1:]
        if self.skip and alone[0]:
            self.skip, alone[0] = False, False
            within, lines, number, alone = within[1:], lines.slice(1), number[1:], alone[1:]
        self.whole.append((number[alone], lines.filter(pa.array(alone))))
        rest = np.flatnonzero(~alone)
        for i, line in zip(rest.tolist(), lines.take(pa.array(rest)).to_pylist()):
            if not within[i]:
                self.place, self.kind = int(number[i]), _WHOLE
            self.open.append(line)
            if not within[i + 1]:
                self._close()

    def _close(self) -> None:
        if self.skip:
            self.skip = False
        else:
            self.rows.append((self.place, self.kind, True, "\n".join(self.open)))
        self.open = []

    def end(self) -> None:
        """The rest of a block that ends inside a field."""
        if self.open and not self.skip:
            kind = _OPENING if self.kind == _WHOLE else _GOING_ON
            self.rows.append((self.place, kind, False, "\n".join(self.open)))

    def batches(self, boundary: bool) -> Iterator[pa.RecordBatch]:
        """What is joined so far; with ``boundary`` the pieces of records on the block's edges alone."""
        for places, texts in self.whole if not boundary else ():
            yield self._batch(places, np.full(len(places), _WHOLE, np.int32), np.ones(len(places), bool), texts)
        rows = [row for row in self.rows if row[1] != _WHOLE] if boundary else self.rows
        if rows:
            yield self._batch(*zip(*rows))
        self.whole, self.rows = [], []

    def _batch(self, places, kinds, closed, texts) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(places, pa.int64()), pa.array(np.full(len(places), self.header, np.int32)), pa.array(kinds, pa.int32()),
             pa.array(closed, pa.bool_()), texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())],
            names=["place", "header", "kind", "closed", "record"],
        )


def _joined(shared: Broadcast, boundary: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        joiner: _Joiner | None = None
        for begins, numbers, lines in _by_block(batches):
            if begins:
                if joiner:
                    joiner.end()
                    yield from joiner.batches(boundary)
                joiner = _Joiner(shared.value, numbers["block"])
            joiner.add(lines)
            yield from joiner.batches(boundary)
        if joiner:
            joiner.end()
            yield from joiner.batches(boundary)

    return run


def records(spark: SparkSession, path: str, known: Layout) -> DataFrame:
    """Every record: ``place`` (file number and first line), number of the file's ``header``, text, and ``closed``.

    ``closed`` is false for the last record of a file that ends inside a quoted field.
    """
    shared = spark.sparkContext.broadcast(known)
    lines = _lines(spark, path).select("value", "block")
    every = lines.mapInArrow(_joined(shared, False), _RECORD_SCHEMA)
    found = every.where(F.col("kind") == _WHOLE).drop("kind")
    if known.edges:
        # pieces in order of their lines; each opening piece begins a record
        pieces = lines.mapInArrow(_joined(shared, True), _RECORD_SCHEMA).where(F.col("kind") != _WHOLE)
        order = Window.partitionBy(F.shiftright("place", LINE_BITS)).orderBy("place")
        begun = F.last(F.when(F.col("kind") == _OPENING, F.col("place")), ignorenulls=True).over(order)
        texts = F.transform(F.sort_array(F.collect_list(F.struct("place", "record"))), lambda piece: piece["record"])
        edges = pieces.withColumn("_begun", begun).groupBy("_begun", "header").agg(
            F.max_by("closed", "place").alias("closed"), F.array_join(texts, "\n").alias("record")
        )
        found = found.unionByName(edges.withColumnRenamed("_begun", "place"))
    # the carriage return before a record's last line feed belongs to the line end
    text = F.when(F.endswith("record", F.lit("\r")), F.expr("substring(record, 1, char_length(record) - 1)")).otherwise(F.col("record"))
    return found.withColumn("record", text).where(F.btrim("record") != "")


def file_names(spark: SparkSession, known: Layout) -> DataFrame:
    """``file_number`` and ``file`` (path) of the files of a layout."""
    return spark.createDataFrame([(i, unquote(f)) for i, f in enumerate(known.files)], "file_number bigint, file string")
