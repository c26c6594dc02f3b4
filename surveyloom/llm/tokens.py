"""Token ids of whole texts, and token counts by the whole-token shortcut (operator 4).

Counting splits a text into the tokenizer's pre-tokens. Which vocabulary strings encode alone as one token is proved
beforehand by encoding every one of them; a pre-token among them counts one, and only the rest is merged, once per
distinct pre-token.

Texts with a special string of the tokenizer, or with characters outside the blocks whose classes all versions of
Unicode agree on, are counted by the library as a whole, so results are the library's in every case.

Defined cases: a null text is an empty one and has no tokens; repeated rows each get a row; an empty table gives an
empty result; columns beyond the needed ones are ignored.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.llm.common import binary_list, map_slices, table, whole_text

LIMIT = 512
KEPT_WORDS = 1_200_000
LONGEST_KEPT = 64


@lru_cache(maxsize=4)
def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks run side by side already
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def specials(path: str) -> list[str]:
    """Strings that the tokenizer takes as one special token wherever they occur."""
    return [token.content for token in load(path).get_added_tokens_decoder().values()]


def _stem(word: bytes) -> tuple[bytes, bytes]:
    """A part between white space in lower case, without and with the full stop or comma behind its last letter.

    The tokenizer lower-cases letters and splits them from other characters, so these have the part's ids together.
    Parts that may hold a special string stay as they are.
    """
    if b"<|" in word:
        return word, b""
    low = word.lower()
    if len(low) > 1 and low[-1] in b".," and 97 <= low[-2] <= 122:
        return low[:-1], low[-1:]
    return low, b""


# Small letters of ASCII and Latin-1, which lower-casing and normalising leave alone: one pre-token.
_letters = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+").fullmatch
# Byte-level vocabularies write bytes that are visible in Latin-1 as themselves and number the others from 256 on.
_VISIBLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTES = {b: 256 + i for i, b in enumerate(sorted({*range(256)} - _VISIBLE))}


class Encoder:
    """Ids of texts by a lower-casing byte-level tokenizer that drops white space and splits letters from the rest.

    Parts between ASCII white space are encoded once and kept, up to ``KEPT_WORDS`` of them. Parts of small letters
    alone go to the merges directly, all others through the whole tokenizer.
    """

    _made: dict[str, Encoder] = {}

    def __init__(self, path: str):
        self.tokenizer = load(path)
        self.known: dict[bytes, bytes] = {}

    @classmethod
    def of(cls, path: str) -> Encoder:
        """This process's encoder of a file."""
        return cls._made.get(path) or cls._made.setdefault(path, cls(path))

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as unsigned 32-bit little-endian numbers."""
        parts = [text.split() for text in texts]
        if len(self.known) > KEPT_WORDS:
            self.known.clear()
        new = list(set().union(*parts).difference(self.known))
        split = [_stem(word) for word in new]
        stems = list({s for pair in split for s in pair}.difference(self.known))
        words, others = [s for s in stems if _letters(s)], [s for s in stems if not _letters(s)]
        merge = self.tokenizer.model.tokenize
        for stem in words:
            self.known[stem] = np.array([t.id for t in merge(stem.decode("latin1").translate(_BYTES))], "<u4").tobytes()
        found = self.tokenizer.encode_batch([stem.decode() for stem in others], add_special_tokens=False)
        self.known.update((stem, np.array(one.ids, "<u4").tobytes()) for stem, one in zip(others, found))
        for word, (stem, tail) in zip(new, split):
            self.known[word] = self.known[stem] + self.known[tail]
        out = [b"".join(map(self.known.__getitem__, words)) for words in parts]
        for word in {*new, *stems}:  # long parts aren't kept
            if len(word) > LONGEST_KEPT:
                del self.known[word]
        return out


# The split of the byte-level vocabularies, a fixed pattern of that tokenizer.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_split = regex.compile(PATTERN)
_settled = re.compile(r"[^\x00-ɏ‐-‧‰-⁞]")


@lru_cache(maxsize=4)
def whole_tokens(path: str) -> frozenset[str]:
    """Vocabulary strings that the tokenizer encodes, alone, as exactly their one token, and that are one pre-token."""
    tokenizer = load(path)
    ids = range(tokenizer.get_vocab_size(with_added_tokens=False))
    strings = tokenizer.decode_batch([[i] for i in ids], skip_special_tokens=False)
    encoded = tokenizer.encode_batch(strings, add_special_tokens=False)
    return frozenset(
        s for i, s, e in zip(ids, strings, encoded) if e.ids == [i] and not _settled.search(s) and _split.findall(s) == [s]
    )


class Counter:
    """Token counts of texts under one byte-level tokenizer file."""

    _made: dict[str, Counter] = {}

    def __init__(self, path: str):
        self.tokenizer = load(path)
        self.known = dict.fromkeys(whole_tokens(path), 1)
        self.whole = len(self.known)
        self.special = re.compile("|".join(map(re.escape, specials(path))) or r"(?!)")

    @classmethod
    def of(cls, path: str) -> Counter:
        return cls._made.get(path) or cls._made.setdefault(path, cls(path))

    def count(self, texts: list[str]) -> list[int]:
        plain = [not self.special.search(text) and not _settled.search(text) for text in texts]
        odd = self.tokenizer.encode_batch([t for t, p in zip(texts, plain) if not p], add_special_tokens=False)
        by_library = iter([len(one.ids) for one in odd])
        parts = [_split.findall(text) if p else None for text, p in zip(texts, plain)]
        if len(self.known) > KEPT_WORDS + self.whole:
            whole = list(self.known)[: self.whole]
            self.known = dict.fromkeys(whole, 1)
        new = list({word for words in parts if words for word in words}.difference(self.known))
        merged = self.tokenizer.encode_batch(new, add_special_tokens=False)
        self.known.update((word, len(one.ids)) for word, one in zip(new, merged))
        known = self.known
        out = [next(by_library) if words is None else sum(map(known.__getitem__, words)) for words in parts]
        for word in new:
            if len(word) > LONGEST_KEPT:
                del known[word]
        return out


def counted(docs: DataFrame, tokenizer: str, keep: list[str]) -> DataFrame:
    """Add ``n_bytes`` and ``n_tokens`` to the columns in ``keep``; ``tokenizer`` is a file every executor can read."""

    def run(batch: pa.RecordBatch) -> dict:
        column = batch.column("_text")
        return {
            "n_bytes": pa.array([len(text) for text in binary_list(column)], pa.int64()),
            "n_tokens": pa.array(Counter.of(tokenizer).count(column.to_pylist()), pa.int64()),
        }

    given = docs.select(*keep, whole_text().alias("_text"))
    return map_slices(given, "_text", "n_bytes bigint, n_tokens bigint", run, keep)


def op4_whole_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = counted(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), ["doc_id"])
    return docs.withColumn("over_limit", F.col("n_tokens") > LIMIT)
