"""Toxic documents by a subsequence string kernel (operator 8).

The kernel of two words sums, over all three-character subsequences that span at most ``SPAN`` characters of each,
``DECAY`` to the power of both spans, and is normalised to 1 for equal words; so an inserted or a dropped character
lowers the likeness of two words and doesn't end it. Landmark words span a Nyström feature space, in which a linear
support vector machine (squared hinge) is trained on the sentences of labelled documents. A sentence counts as
much as its worst word; which sentences and words of a toxic document carry its label is found by
multiple-instance rounds: train, keep those with a positive margin (the best at least), train again.

The last rounds learn inserted letters: the ``WIDENED`` words that carry most toxic documents' labels, of those that
carry a ``WIDE_SHARE`` of the most at least, join as positives with a letter inserted at each inner place, and as
landmarks with an open place there. Words of fewer documents are not widened, as many of them carry labels by chance.

The kernel used is a power of that sum, which is a kernel too and tells words apart more sharply. The score of a document is a logistic curve,
fitted on the training documents, of its worst word's margin, where margins end at 1, the machine's aim.

The training sample is bounded: ``MOST_TOXIC`` and ``MOST_CLEAN`` labelled documents of at most ``MOST_CHARS``
characters, first by the hash of their id. Scoring covers every whole text.

Defined cases: a null or empty text and a text without letters or digits score 0; repeated rows each get a row; a
label that is null is none, and of several labels of a document the highest holds; without labels of both kinds
nothing can be learnt and every score is 0; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.llm.common import map_slices, table, whole_text

MOST_TOXIC = 700
MOST_CLEAN = 1400
MOST_CHARS = 20_000
LANDMARKS = 128
DECAY = 0.6
SPAN = 5
LONGEST = 24
THRESHOLD = 0.7
ROUNDS = 4
RIDGE = 1e-3
POWER = 2
WIDENED = 48
WIDE_SHARE = 0.25
# Weight of a widened word's variants together against the word's own documents, and their rounds' part of the ridge.
WIDE_WEIGHT = 3.0
WIDE_RIDGE = 0.1
ONCE = 20_000
CACHE_WORDS = 1_000_000
# Rows of a training step held in double precision at once.
BLOCK = 2_048

_SYMBOLS = 32
_STEPS = [(a, b) for b in range(2, SPAN) for a in range(1, b)]
_SPACED = re.compile(r"(?<!\S)\w(?:[\s.*_-]+\w){2,}(?!\S)")
_PART = re.compile(r"[^\W_]+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n")
_DECAYS = (DECAY ** np.arange(8)).astype(np.float32)
_EDGES = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())
_FLOOR = 0.0
_NEVER = -9.0
_CEILING = 1.0
_OPEN = "\0"  # a place for any letter; no word has this symbol
_LETTERS = "abcdefghijklmnopqrstuvwxyz"


def _symbol(c: str) -> int:
    if c == _OPEN:
        return 0
    if "a" <= c <= "z":
        return 2 + ord(c) - 97
    return 28 if c.isdigit() else 29 + ord(c) % 3


def pieces(token: str) -> set[str]:
    """The words that a token may hide: its letters and digits joined, and each run of them of three or more.

    Words longer than ``LONGEST`` are read through overlapping windows of that length.
    """
    if len(token) <= LONGEST and token.isalnum():
        return {token}
    bare = token.strip(_EDGES)
    if len(bare) <= LONGEST and bare.isalnum():
        return {bare}
    parts = _PART.findall(token)
    words = {"".join(parts), *(p for p in parts if len(p) > 2)} if parts else set()
    return {
        w[i: i + LONGEST] for w in words
        for i in range(0, max(1, len(w) - LONGEST // 2), LONGEST // 2) if len(w) > LONGEST or not i
    }


def tokens(text: str) -> set[str]:
    """Distinct lower-case tokens of a text, with runs of spaced single letters joined as well."""
    low = text.lower()
    found = set(low.split())
    found.update("".join(_PART.findall(m)) for m in _SPACED.findall(low))
    return found


def opened(word: str) -> list[str]:
    """The word with an open place at each inner place; words of three characters or fewer are left alone."""
    return [word[:k] + _OPEN + word[k:] for k in range(1, len(word))] if len(word) > 3 else []


def variants(word: str) -> list[str]:
    """The word with a letter inserted at each inner place, three letters a place."""
    return [
        w.replace(_OPEN, _LETTERS[(7 * k + 11 * j + len(word)) % 26]) for k, w in enumerate(opened(word), 1) for j in range(3)
    ]


def triples(words: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For words of each length: their places in the list, triple codes, triple weights, and the kernel's norms."""
    by_length: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        by_length.setdefault(len(word), []).append(i)
    made = []
    for length, places in by_length.items():
        joined = "".join(words[i] for i in places)
        chars = {c: _symbol(c) for c in set(joined)}
        body = np.fromiter((chars[c] for c in joined), np.int32, len(joined)).reshape(len(places), length)
        rows = np.zeros((len(places), length + 2), np.int32)
        rows[:, 1:-1], rows[:, -1] = body, 1
        n = length + 2
        codes, spans = [], []
        for a, b in _STEPS:
            if n > b:
                codes.append((rows[:, : n - b] * _SYMBOLS + rows[:, a: n - b + a]) * _SYMBOLS + rows[:, b:])
                spans.append(np.full(n - b, b + 1, np.int32))
        code = np.concatenate(codes, axis=1)
        span = np.concatenate(spans)
        weight = (DECAY**span).astype(np.float32)
        ranked = np.sort(code * 8 + span, axis=1)
        heavy = _DECAYS[ranked & 7]
        ranked >>= 3
        total = np.cumsum(heavy, axis=1)
        last = np.ones(ranked.shape, bool)
        last[:, :-1] = ranked[:, 1:] != ranked[:, :-1]
        before = np.zeros_like(total)
        before[:, 1:] = np.maximum.accumulate(np.where(last, total, 0), axis=1)[:, :-1]
        norm = np.sqrt(np.where(last, (total - before) ** 2, 0).sum(axis=1))
        made.append((np.array(places), code, weight, norm))
    return made


class Marks:
    """Landmarks' triple tables, one column a landmark, kept for the triples that occur in some landmark."""

    def __init__(self, table_of: np.ndarray):
        there = table_of.any(axis=1)
        self.seat = np.where(there, np.cumsum(there), 0).astype(np.int32)
        self.dense = np.concatenate([np.zeros((1, table_of.shape[1]), np.float32), table_of[there]])


@dataclass
class Model:
    """The landmarks' triples, one weight per landmark, the machine's bias, and the logistic curve of margins."""

    landmarks: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def __post_init__(self):
        gains = self.weights > 0
        self.gain, self.loss = Marks(self.landmarks[:, gains]), Marks(self.landmarks[:, ~gains])
        self.gain_weights, self.loss_weights = self.weights[gains], self.weights[~gains]

    def margins(self, words: list[str]) -> np.ndarray:
        """Margins of words, those below ``_FLOOR`` raised to it and those above ``_CEILING`` lowered.

        The landmarks of positive weight bound a margin from above; the others are looked up only for words whose
        bound exceeds the floor.
        """
        bound = _kernel(words, self.gain) @ self.gain_weights + self.bias
        unsure = np.flatnonzero(bound > _FLOOR)
        if len(unsure):
            bound[unsure] += _kernel([words[i] for i in unsure], self.loss) @ self.loss_weights
        return np.clip(bound, _FLOOR, _CEILING)

    def probability(self, margin: np.ndarray) -> np.ndarray:
        made = 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -40, 40)))
        return np.where(margin <= _NEVER, 0.0, made)


NOTHING_LEARNT = Model(np.zeros((_SYMBOLS**3, 1), np.float32), np.zeros(1, np.float32), _NEVER, 1.0, 0.0)


def _kernel(words: list[str], marks: Marks) -> np.ndarray:
    """Powers of the normalised kernel of words with the landmarks."""
    out = np.zeros((len(words), marks.dense.shape[1]), np.float32)
    for places, code, weight, norm in triples(words):
        seats = marks.seat[code]
        for start in range(0, len(places), 256):
            here = slice(start, start + 256)
            sums = np.matmul(weight, marks.dense[seats[here]]) / norm[here][:, None]
            out[places[here]] = sums**POWER
    return out


def _tables(words: list[str]) -> np.ndarray:
    """The normalised triple weights of each word, one column a word."""
    out = np.zeros((_SYMBOLS**3, len(words)), np.float32)
    for places, code, weight, norm in triples(words):
        for row, place in enumerate(places):
            np.add.at(out[:, place], code[row], weight / norm[row])
    return out


def _times(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """``x @ w`` in double precision, block by block."""
    return np.concatenate([x[i: i + BLOCK].astype(np.float64) @ w for i in range(0, len(x), BLOCK)])


def _squared_hinge(x: np.ndarray, rows: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float) -> np.ndarray:
    """Minimise ``ridge * |w|^2 + sum weight * max(0, 1 - y * xw)^2`` over the given rows, by Newton steps.

    A step needs the rows within the margin only, whose normal equations are added up block by block.
    """
    w = np.zeros(x.shape[1])
    damp = ridge * np.eye(x.shape[1])
    damp[-1, -1] = 1e-6
    for _ in range(25):
        inside = np.flatnonzero(y * _times(x, w)[rows] < 1)
        left, right = damp.copy(), np.zeros(x.shape[1])
        for start in range(0, len(inside), BLOCK):
            here = inside[start: start + BLOCK]
            part = x[rows[here]].astype(np.float64)
            weighted = part * weight[here][:, None]
            left += weighted.T @ part
            right += weighted.T @ y[here]
        new = np.linalg.solve(left, right)
        if np.allclose(new, w, atol=1e-6):
            break
        w = new
    return w


def _root(marks: list[str], tables_of: np.ndarray) -> np.ndarray:
    """The inverse root of the landmarks' kernel, which makes features of a word's kernel with them."""
    values, vectors = np.linalg.eigh(_kernel(marks, Marks(tables_of)).astype(np.float64))
    return vectors / np.sqrt(np.maximum(values, 1e-2))


def _features(words: list[str], tables_of: np.ndarray, root: np.ndarray) -> np.ndarray:
    """Features of words and a constant one; words are taken block by block, so only the result is as long as they are."""
    marks = Marks(tables_of)
    out = np.ones((len(words), root.shape[1] + 1), np.float32)
    for start in range(0, len(words), BLOCK):
        out[start: start + BLOCK, :-1] = _kernel(words[start: start + BLOCK], marks) @ root
    return out


def train(sample: list[tuple[str, int]]) -> Model:
    """Learn from (text, label) rows; the order of rows doesn't matter."""
    sample = sorted((text, label) for text, label in sample)
    labels = np.array([label for _, label in sample])
    if not len(sample) or labels.min() == labels.max():
        return NOTHING_LEARNT
    number: dict[str, int] = {}
    bags: list[list[np.ndarray]] = []  # of each document, of each sentence: word numbers
    for text, _ in sample:
        bag = []
        for sentence in _SENTENCE.split(text):
            words = sorted({w for token in tokens(sentence) for w in pieces(token)})
            if words:
                bag.append(np.array([number.setdefault(w, len(number)) for w in words]))
        bags.append(bag)
    words = list(number)
    toxic_in, clean_in = np.zeros(len(words)), np.zeros(len(words))
    for bag, label in zip(bags, labels):
        if bag:
            (toxic_in if label else clean_in)[np.unique(np.concatenate(bag))] += 1
    # words seen in clean documents are negative; others start positive where toxic documents repeat them
    least = 3 if labels.sum() >= 100 else 2
    started = (clean_in == 0) & (toxic_in >= least)
    if not started.any():
        started = clean_in == 0
    used = np.flatnonzero(started | (clean_in >= 2))
    once = np.flatnonzero(clean_in == 1)
    used = np.union1d(used, once[np.linspace(0, len(once) - 1, min(len(once), ONCE)).astype(int)] if len(once) else once)
    words, toxic_in, clean_in = [words[i] for i in used], toxic_in[used], clean_in[used]
    place = np.full(len(number), -1)
    place[used] = np.arange(len(used))
    bags = [[p for s in bag if len(p := place[s][place[s] >= 0])] for bag in bags]
    strength = np.where((clean_in == 0) & (toxic_in >= least), toxic_in, 0.0)
    if not (strength > 0).any():
        strength = np.where(clean_in == 0, toxic_in, 0.0)
    negative = np.flatnonzero(clean_in > 0)
    lead = np.lexsort((words, -strength))[: LANDMARKS // 2]
    plain = np.lexsort((words, -clean_in))[: LANDMARKS // 4]
    marks = list(dict.fromkeys([*lead, *plain]))
    f = np.zeros(len(words))
    for turn in range(ROUNDS):
        if turn < 2 and len(negative):  # clean words that look worst join the landmarks
            worst = negative[np.lexsort((np.arange(len(negative)), -f[negative]))] if turn else negative[:: max(1, len(negative) * 4 // LANDMARKS)]
            marks = list(dict.fromkeys([*marks, *worst[: LANDMARKS // 4]]))
            tables_of = _tables([words[i] for i in marks])
            root = _root([words[i] for i in marks], tables_of)
            x = _features(words, tables_of, root)
        positive = np.flatnonzero(strength > 0)
        if not len(positive):
            return NOTHING_LEARNT
        rows = np.concatenate([positive, negative])
        y = np.concatenate([np.ones(len(positive)), -np.ones(len(negative))])
        weight = np.concatenate([np.sqrt(strength[positive]), np.sqrt(clean_in[negative])])
        weight[: len(positive)] *= 0.5 * weight[len(positive):].sum() / weight[: len(positive)].sum()
        ridge = RIDGE * max(1.0, MOST_CLEAN / len(sample)) * weight.sum()
        w = _squared_hinge(x, rows, y, weight, ridge)
        f = _times(x, w)
        # each toxic sentence's positive words carry the label; the worst of the document's words does at least
        strength[:] = 0
        for bag, label in zip(bags, labels):
            if label and bag:
                free = np.unique(np.concatenate(bag))
                free = free[clean_in[free] == 0]
                if len(free):
                    strength[free[f[free] > 0] if (f[free] > 0).any() else free[[np.argmax(f[free])]]] += 1
    learnt = np.flatnonzero((strength >= max(least, WIDE_SHARE * strength.max())) & (f > 0))
    learnt = learnt[np.lexsort((learnt, -strength[learnt]))][:WIDENED]
    wide: dict[str, float] = {}  # inserted forms, without those that some training document has
    for at in learnt:
        made = [v for v in variants(words[at]) if v not in number]
        wide |= {v: strength[at] / len(made) for v in made}
    if wide:
        every = [*words, *wide]
        positive = np.flatnonzero(strength > 0)
        rows = np.concatenate([positive, np.arange(len(words), len(every)), negative])
        gains = len(positive) + len(wide)
        y = np.concatenate([np.ones(gains), -np.ones(len(negative))])
        weight = np.concatenate([
            np.sqrt(strength[positive]), WIDE_WEIGHT * np.array(list(wide.values())), np.sqrt(clean_in[negative]),
        ])
        weight[:gains] *= 0.5 * weight[gains:].sum() / weight[:gains].sum()
        ridge = WIDE_RIDGE * RIDGE * max(1.0, MOST_CLEAN / len(sample)) * weight.sum()
        names = [*[words[i] for i in marks], *[w for at in learnt for w in opened(words[at])]]
        for turn in range(2):
            if turn:  # clean words that look like inserted forms join the landmarks
                worst = negative[np.lexsort((np.arange(len(negative)), -f[negative]))]
                names += [words[i] for i in worst[: LANDMARKS // 2]]
            names = list(dict.fromkeys(names))
            tables_of = _tables(names)
            root = _root(names, tables_of)
            x = _features(every, tables_of, root)
            w = _squared_hinge(x, rows, y, weight, ridge)
            f = _times(x, w)[: len(words)]
    f = np.minimum(f, _CEILING)
    alpha = root @ w[:-1]
    margin = np.array([max((max(f[s].max(), _FLOOR) for s in bag), default=_NEVER) for bag in bags])
    seen = margin > _NEVER
    slope, shift = _logistic(margin[seen], labels[seen])
    return Model(tables_of, alpha.astype(np.float32), float(w[-1]), slope, shift)


def _logistic(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Logistic curve of margins, by Newton steps with a small ridge and both kinds of label weighing the same."""
    x = np.stack([margin, np.ones(len(margin))], axis=1)
    weight = np.where(label == 1, 0.5 / max(1, (label == 1).sum()), 0.5 / max(1, (label == 0).sum()))
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        grad = x.T @ (weight * (p - label)) + 1e-4 * w * [1, 0]
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag([1e-4, 1e-9])
        step = np.linalg.solve(hess, grad)
        w -= step / max(1.0, np.abs(step).max() / 4)
    return float(w[0]), float(w[1])


def held_out() -> Column:
    """Rows whose label must not be learnt from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame) -> list[tuple[str, int]]:
    """The bounded sample: ids are chosen first, so texts of chosen documents alone are read to the driver."""
    marks = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("toxic")
    ).where(~held_out())
    texts = docs.select("doc_id", whole_text().alias("text")).where(F.char_length("text") <= MOST_CHARS)
    order = [F.md5(F.col("doc_id").cast("string")), "doc_id"]
    there = marks.join(texts.select("doc_id"), "doc_id", "left_semi")
    chosen = there.where("toxic = 1").orderBy(*order).limit(MOST_TOXIC).union(
        there.where("toxic = 0").orderBy(*order).limit(MOST_CLEAN)
    )
    # at most MOST_TOXIC + MOST_CLEAN ids
    found = texts.join(F.broadcast(chosen), "doc_id").select("text", "toxic").dropDuplicates()
    return [(row["text"], row["toxic"]) for row in found.collect()]


_scores: dict[str, float] = {}
_scorer: list = []


def _score_slice(model: Model, texts: list[str]) -> np.ndarray:
    """Worst margin of each text; margins of tokens are kept from slice to slice, up to ``CACHE_WORDS`` of them."""
    if not _scorer or _scorer[0] is not model:
        _scores.clear()
        _scorer[:] = [model]
    if len(_scores) > CACHE_WORDS:
        _scores.clear()
    found = [tokens(text) for text in texts]
    new = list(set().union(*found).difference(_scores))
    hidden = [pieces(token) for token in new]
    words = list(set().union(*hidden))
    margin = dict(zip(words, model.margins(words).tolist()))
    margin[""] = _NEVER
    for token, ws in zip(new, hidden):
        _scores[token] = max(map(margin.__getitem__, ws), default=_NEVER)
    return np.array([max(map(_scores.__getitem__, ts), default=_NEVER) for ts in found])


def scored(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """Add ``score`` to the columns in ``keep``."""
    given = docs.sparkSession.sparkContext.broadcast(model)  # a table of fixed size

    def run(batch: pa.RecordBatch) -> dict:
        score = given.value.probability(_score_slice(given.value, batch.column("_text").to_pylist()))
        return {"score": pa.array(score, pa.float64())}

    return map_slices(docs.select(*keep, whole_text().alias("_text")), "_text", "score double", run, keep)


def predicted() -> Column:
    return (F.col("score") >= THRESHOLD).cast("int")


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that aren't predicted toxic, with all their columns."""
    model = train(training_rows(docs, labels))
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "text")
    kept = scored(row, model, ["_row"]).where(predicted() == 0)
    return kept.select(*[F.col("_row")[c].alias(c) for c in docs.columns])


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(training_rows(docs, table(spark, sf_dir, "labels")))
    return scored(docs, model, ["doc_id"]).select(
        "doc_id", held_out().alias("held_out"), "score", predicted().alias("predicted")
    )
