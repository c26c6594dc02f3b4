"""Byte-level BPE encoding and decoding by batched merge rounds (operator 11).

Texts are cut into pre-tokens, and only pre-tokens not met before by the process are encoded. The symbols of all new
pre-tokens lie in one flat array. A round finds the rank of every neighbouring pair by binary search over the sorted
keys of the merge list, takes each word's lowest rank, merges all its places from the left, closes the gaps, and goes
on with the words that still have a pair to merge; only pairs beside a merge are looked up again. All places of a
word's lowest pair may merge in one round because a merge only makes pairs of higher rank; where a file's merges
don't have that property (two merges make one string), a round merges a word's leftmost place alone.

Ids are decoded by joining the bytes of their tokens and reading them as UTF-8, invalid bytes as U+FFFD.

Special strings of the file are taken out of texts first, longest first at one place, and are one id each. Texts of
characters whose classes all versions of Unicode agree on are split by the pattern of such files; all other texts are
split by the library's pre-tokenizer, and merged here like the rest.

Defined cases: a null text is an empty one and has no ids, its digests are those of no bytes; a text of any length is
encoded whole, one pre-token of any length included; repeated rows each get a row; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.llm.common import map_slices, table, whole_text
from surveyloom.llm.tokens import _BYTES, _settled, _split, load

# Kept pre-tokens of a process: at most so many, and of so many bytes together.
KEPT_WORDS = 600_000
KEPT_BYTES = 24 << 20
_NONE = np.iinfo(np.int32).max

_char_bytes = {chr(n): b for b, n in _BYTES.items()} | {chr(b): b for b in range(256) if b not in _BYTES}


def ragged(offsets: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Places of the elements of the given groups, one group after the other; group i lies at offsets[i:i + 2]."""
    sizes = (offsets[1:] - offsets[:-1])[which]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(offsets[which] - (ends - sizes), sizes)


class Merges:
    """The merge list of a byte-level BPE file, as sorted pair keys, and the bytes of its tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        vocab = model["model"]["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = left << 32 | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int32), made
        first = {}
        for rank, token in enumerate(made.tolist()):
            first.setdefault(token, rank)
        later = np.array([max(first.get(int(a), -1), first.get(int(b), -1)) for a, b in zip(left, right)], np.int64)
        self.rising = len(first) == len(made) and bool((later < np.arange(len(made))).all())
        self.byte_ids = np.array([vocab[chr(_BYTES.get(b, b))] for b in range(256)], np.int64)
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        tokens: dict[int, bytes] = {i: self._bytes(s) for s, i in vocab.items()}
        tokens.update((i, self._bytes(s)) for s, i in self.special.items())
        table = [tokens.get(i, b"") for i in range(max(tokens) + 1)]
        self.token_offsets = np.concatenate([[0], np.cumsum([len(t) for t in table])]).astype(np.int64)
        self.token_bytes = np.frombuffer(b"".join(table), np.uint8)
        decimal = [b"%d," % i for i in range(len(table))]
        self.digit_offsets = np.concatenate([[0], np.cumsum([len(t) for t in decimal])]).astype(np.int64)
        self.digit_bytes = np.frombuffer(b"".join(decimal), np.uint8)

    @staticmethod
    def _bytes(token: str) -> bytes:
        """Bytes that a token stands for; a token with a character outside the byte alphabet is its own text."""
        if all(c in _char_bytes for c in token):
            return bytes(_char_bytes[c] for c in token)
        return token.encode()

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols, by binary search over the sorted pair keys."""
        key = a << 32 | b
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.ranks[at], _NONE) if len(self.keys) else np.full(len(a), _NONE, np.int32)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and the words' offsets in it."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), sizes)
        out_symbols, out_words = [], []
        # rank of the pair that starts at each symbol; a word's last symbol starts none
        rank = np.full(len(symbols), _NONE, np.int32)
        inner = np.flatnonzero(word[1:] == word[:-1])
        rank[inner] = self.rank(symbols[inner], symbols[inner + 1])
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            lengths = np.diff(np.r_[starts, len(word)])
            lowest = np.minimum.reduceat(rank, starts)
            done = lowest == _NONE
            if done.any():
                over = np.repeat(done, lengths)
                out_symbols.append(symbols[over])
                out_words.append(word[over])
                symbols, word, rank = symbols[~over], word[~over], rank[~over]
                lengths, lowest = lengths[~done], lowest[~done]
                if not len(symbols):
                    break
            hit = np.flatnonzero(rank == np.repeat(lowest, lengths))
            hit = self._apart(hit) if self.rising else hit[np.r_[True, word[hit][1:] != word[hit][:-1]]]
            symbols[hit] = self.made[rank[hit]]
            stay = np.ones(len(symbols), bool)
            stay[hit + 1] = False
            moved = np.cumsum(stay) - 1
            symbols, word, rank = symbols[stay], word[stay], rank[stay]
            at = moved[hit]
            self._look_again(symbols, word, rank, np.union1d(at, np.maximum(at - 1, 0)))
        if not out_symbols:
            return np.zeros(0, np.int64), np.zeros(len(words) + 1, np.int64)
        symbols, word = np.concatenate(out_symbols), np.concatenate(out_words)
        order = np.argsort(word, kind="stable")
        return symbols[order], np.concatenate([[0], np.cumsum(np.bincount(word, minlength=len(words)))])

    @staticmethod
    def _apart(hit: np.ndarray) -> np.ndarray:
        """Of places side by side (a pair of one symbol with itself) every second one, from the left."""
        run = np.r_[True, hit[1:] != hit[:-1] + 1]
        first = np.flatnonzero(run)
        within = np.arange(len(hit)) - np.repeat(first, np.diff(np.r_[first, len(hit)]))
        return hit[within % 2 == 0]

    def _look_again(self, symbols: np.ndarray, word: np.ndarray, rank: np.ndarray, at: np.ndarray) -> None:
        rank[at] = _NONE
        at = at[at + 1 < len(symbols)]
        at = at[word[at] == word[at + 1]]
        rank[at] = self.rank(symbols[at], symbols[at + 1])

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of ids, as UTF-8."""
        raw = self.token_bytes[ragged(self.token_offsets, ids)].tobytes()
        return raw.decode(errors="replace").encode()


class Encoder:
    """Ids of texts under one byte-level file; known pre-tokens are numbered, their ids lie in one growing array."""

    _made: dict[str, Encoder] = {}

    def __init__(self, path: str):
        self.merges = Merges(path)
        self.library = load(path)
        special = sorted(self.merges.special, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else re.compile("(?!)")
        self._clear()

    @classmethod
    def of(cls, path: str) -> Encoder:
        """This process's encoder of a file."""
        return cls._made.get(path) or cls._made.setdefault(path, cls(path))

    def _clear(self) -> None:
        names = list(self.merges.special)
        self.known: dict[str, int] = {}
        self.markers = {name: i for i, name in enumerate(names)}
        self.ids = np.array([self.merges.special[name] for name in names], np.int64)
        self.offsets = np.arange(len(names) + 1, dtype=np.int64)
        self.bytes = 0

    def split(self, text: str) -> list[str]:
        """The pre-tokens of a text without special strings."""
        if not _settled.search(text):
            return _split.findall(text)
        pieces = self.library.pre_tokenizer.pre_tokenize_str(text)
        return [bytes(map(_char_bytes.__getitem__, piece)).decode() for piece, _ in pieces]

    def _learn(self, words: list[str]) -> None:
        raw = [word.encode() for word in words]
        ids, offsets = self.merges.encode(raw)
        start = len(self.offsets) - 1
        self.known.update(zip(words, range(start, start + len(words))))
        self.offsets = np.concatenate([self.offsets, offsets[1:] + len(self.ids)])
        self.ids = np.concatenate([self.ids, ids])
        self.bytes += sum(map(len, raw))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and the texts' offsets in it."""
        if len(self.known) > KEPT_WORDS or self.bytes > KEPT_BYTES:
            self._clear()
        parts: list[list[tuple[bool, list[str]]]] = []
        new: set[str] = set()
        for text in texts:
            mine = []
            for i, piece in enumerate(self.special.split(text) if self.special.search(text) else (text,)):
                words = [piece] if i % 2 else self.split(piece)
                mine.append((bool(i % 2), words))
                if not i % 2:
                    new.update(words)
            parts.append(mine)
        self._learn(list(new.difference(self.known)))
        find, marker = self.known.__getitem__, self.markers.__getitem__
        counts = [sum(len(words) for _, words in mine) for mine in parts]
        numbers = np.fromiter(
            (number for mine in parts for special, words in mine for number in map(marker if special else find, words)),
            np.int64, sum(counts),
        )
        sizes = (self.offsets[1:] - self.offsets[:-1])[numbers]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return self.ids[ragged(self.offsets, numbers)], ends[np.concatenate([[0], np.cumsum(counts)])]


def digests(path: str, texts: list[str]) -> tuple[list[int], list[str], list[str]]:
    """Per text: number of ids, digest of the ids written in decimal, digest of the decoded ids."""
    encoder = Encoder.of(path)
    merges = encoder.merges
    ids, offsets = encoder.encode(texts)
    written = merges.digit_bytes[ragged(merges.digit_offsets, ids)].tobytes()
    ends = np.concatenate([[0], np.cumsum((merges.digit_offsets[1:] - merges.digit_offsets[:-1])[ids])])[offsets]
    counts, id_digests, text_digests = [], [], []
    for start, end, a, b in zip(offsets[:-1], offsets[1:], ends[:-1], ends[1:]):
        counts.append(int(end - start))
        id_digests.append(hashlib.sha256(written[a: max(a, b - 1)]).hexdigest())
        text_digests.append(hashlib.sha256(merges.decode(ids[start:end])).hexdigest())
    return counts, id_digests, text_digests


def encode_texts(docs: DataFrame, tokenizer: str, keep: list[str]) -> DataFrame:
    """Columns in ``keep`` and the text's ``ids``; ``tokenizer`` is a file every executor can read."""

    def run(batch: pa.RecordBatch) -> dict:
        ids, offsets = Encoder.of(tokenizer).encode(batch.column("_text").to_pylist())
        return {"ids": pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.astype(np.int32)))}

    return map_slices(docs.select(*keep, whole_text().alias("_text")), "_text", "ids array<int>", run, keep)


def decode_texts(encoded: DataFrame, tokenizer: str, keep: list[str]) -> DataFrame:
    """Columns in ``keep`` and the ``decoded`` text of the column ``ids``; null ids decode to the empty text."""
    from collections.abc import Iterator

    kept = [f"`{name}` {encoded.schema[name].dataType.simpleString()}" for name in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            merges = Encoder.of(tokenizer).merges
            texts = [merges.decode(np.array(ids, np.int64)).decode() for ids in batch.column("_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(texts, pa.string())], names=[*keep, "decoded"])

    given = encoded.select(*keep, F.coalesce("ids", F.array().cast("array<int>")).alias("_ids"))
    return given.mapInArrow(run, ", ".join([*kept, "decoded string"]))


def round_trip(docs: DataFrame, tokenizer: str, keep: list[str]) -> DataFrame:
    """Columns in ``keep`` and ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` of each whole text."""

    def run(batch: pa.RecordBatch) -> dict:
        counts, ids, texts = digests(tokenizer, batch.column("_text").to_pylist())
        return {"n_tokens": pa.array(counts, pa.int64()), "ids_sha256": pa.array(ids, pa.string()), "decoded_sha256": pa.array(texts, pa.string())}

    given = docs.select(*keep, whole_text().alias("_text"))
    return map_slices(given, "_text", "n_tokens bigint, ids_sha256 string, decoded_sha256 string", run, keep)


def op11_batched_merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), ["doc_id"])
