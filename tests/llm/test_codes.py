"""BPE merges, vector codes and phrase mining, each against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from surveyloom.llm import merges, phrases, vectors
from surveyloom.llm.common import looked_up

BYTES = public_tokenizers.path("byte_bpe_50k.json")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- byte-pair encoding

ODD_TEXTS = [
    "", "a" * 5000, "aaaa aaa aa", "hello<|endoftext|>world <|endoftext|><|endoftext|>", "\x1c a\x1d\x85b \xa0 c　d​",
    "漢字かな 12３４ ½²", "😀😀 ok", "ǅ́x", "don't we'll 'S 's", "  \n\n  x \t y  ", "\x00\x01\x7f\xad", "ﬁ Ⅷ ⅷ 𝔘 𞤀", "<|endoftext|", "x\x0b\x0c y",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTES)


def test_round_trip_of_all_documents(spark, docs, library):
    given = {r.doc_id: r.text or "" for r in docs.collect()}
    for row in merges.round_trip(docs, BYTES, ["doc_id"]).collect():
        ids = library.encode(given[row.doc_id], add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        assert (row.n_tokens, row.ids_sha256, row.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(back))
        assert back == given[row.doc_id]


def test_ids_of_odd_texts(library):
    rng = random.Random(5)
    wide = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    near = [chr(i) for i in range(0x250)] + [chr(i) for i in range(0x2000, 0x2060)]
    texts = ODD_TEXTS + ["".join(rng.choices(c, k=50)) for c in (wide, near, "ab", "abcdefgh") for _ in range(200)]
    texts.append("".join(rng.choices("abcdefghij", k=30_000)))
    ids, offsets = merges.Encoder(BYTES).encode(texts)
    for i, one in enumerate(library.encode_batch(texts, add_special_tokens=False)):
        assert ids[offsets[i]: offsets[i + 1]].tolist() == one.ids, texts[i][:40]


def test_decoding_of_any_ids(library):
    rng = random.Random(6)
    made = merges.Merges(BYTES)
    for _ in range(300):
        ids = [rng.randrange(50_257) for _ in range(rng.randrange(30))]
        assert made.decode(np.array(ids, np.int64)).decode() == library.decode(ids, skip_special_tokens=False)


def test_rounds_without_rising_ranks_take_the_leftmost_place(library):
    encoder = merges.Encoder(BYTES)
    encoder.merges.rising = False
    for text in ODD_TEXTS[1:3] + ["mississippi banana " * 3]:
        ids, _ = encoder.encode([text])
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_full_memory_is_cleared(library, monkeypatch):
    monkeypatch.setattr(merges, "KEPT_WORDS", 3)
    encoder = merges.Encoder(BYTES)
    for text in ["one two three four", "five <|endoftext|> six", "one two"]:
        assert encoder.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_round_trip_of_odd_rows(spark, odd, empty):
    found = merges.round_trip(odd, BYTES, ["doc_id", "kept"]).collect()
    assert len(found) == odd.count() and merges.round_trip(empty, BYTES, ["doc_id"]).count() == 0
    by_id = {r.doc_id: r for r in found}
    assert by_id[1].ids_sha256 == by_id[2].decoded_sha256 == sha("") and by_id[1].n_tokens == 0
    assert by_id[8].decoded_sha256 == sha("a" * 50_000)
    encoded = merges.encode_texts(odd, BYTES, ["doc_id"])
    back = {r.doc_id: r.decoded for r in merges.decode_texts(encoded, BYTES, ["doc_id"]).collect()}
    assert back == {r.doc_id: r.text or "" for r in odd.collect()}


# ---- vector codes


def test_nearest_is_that_of_all_entries():
    rng = np.random.default_rng(1)
    for high in (2, 5, 1000):  # few values make ties
        for d in (1, 4):
            parts, entries = rng.integers(-high, high, (500, d)), rng.integers(-high, high, (64, d))
            far = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
            index, best = vectors.nearest(parts, entries)
            assert (best == far.min(axis=1)).all() and (index == far.argmin(axis=1)).all()
    big = vectors.largest(4)
    index, best = vectors.nearest(np.array([[big] * 4, [-big] * 4]), np.array([[-big] * 4]))
    assert best.tolist() == [16 * big * big, 0] and vectors.PARTS * 16 * big * big < 1 << 63


def brute_codes(rows):
    """Codes by the definition, from (vec_id, whole numbers) in order of ids."""
    d = len(rows[0][1]) // 16
    cut = [[tuple(v[p * d: (p + 1) * d]) for p in range(16)] for _, v in rows]
    books = [[c[p] for c in cut[:64]] for p in range(16)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), i) for i, e in enumerate(book))

    for _ in range(2):
        for p in range(16):
            groups = {}
            for c in cut:
                groups.setdefault(near(c[p], books[p])[1], []).append(c[p])
            books[p] = [
                tuple(sum(x) // len(groups[i]) for x in zip(*groups[i])) if i in groups else e for i, e in enumerate(books[p])
            ]
    out = {}
    for (key, _), c in zip(rows, cut):
        best = [near(c[p], books[p]) for p in range(16)]
        out[key] = ("".join(f"{i:02x}" for _, i in best), sum(far for far, _ in best))
    return out, sha(",".join(str(x) for book in books for e in book for x in e))


def test_codes_against_brute_force(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([-1.5, -0.25, 0.0, 0.125, 0.7, 2.0]) for _ in range(32)], rng.choice([1, 2, None])) for i in range(150)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").repartition(5)
    found = vectors.compressed(frame).collect()
    floats = {i: [int(np.floor(256 * float(np.float32(x)))) for x in v] for i, v, _ in rows}
    codes, digest = brute_codes(sorted(floats.items()))
    assert {r.vec_id: (r.code, r.error) for r in found} == codes
    assert {r.codebooks_sha256 for r in found} == {digest}
    label = {i: x for i, _, x in rows}
    total = Counter()
    for r in found:
        total[label[r.vec_id]] += r.error
    assert all(r.label_error == total[label[r.vec_id]] for r in found)


def test_codes_of_odd_rows(spark):
    schema = "vec_id bigint, embedding array<float>, label int, code string, _v int"
    good = [0.5] * 16
    rows = [
        (1, good, 1, "x", 7), (1, good, 1, "x", 7), (None, [0.25] * 16, None, "x", 7), (2, None, 1, "x", 7), (3, [], 1, "x", 7),
        (4, [0.5] * 15 + [None], 1, "x", 7), (5, [0.5] * 15 + [float("nan")], 1, "x", 7), (6, [0.5] * 15 + [float("inf")], 1, "x", 7),
        (7, [0.5] * 17, 1, "x", 7), (8, [0.5] * 32, 1, "x", 7), (9, [3e38] + [0.5] * 15, 1, "x", 7), (10, [-1.0] * 16, None, "x", 7),
    ]
    found = vectors.compressed(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.vec_id is None, r.vec_id or 0, r.error) for r in found) == [(False, 1, 0), (False, 1, 0), (False, 10, 0), (True, 0, 0)]
    # the two rows of id 1 are the first two entries: the lower index wins; the null id comes last
    assert {r.vec_id: r.code[:2] for r in found} == {1: "00", 10: "02", None: "03"}
    assert vectors.compressed(spark.createDataFrame([], schema)).columns == list(found[0].asDict())
    assert vectors.compressed(spark.createDataFrame(rows[3:5], schema)).count() == 0


def test_codes_stand_for_near_vectors(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    books = vectors.trained(table)
    given = {r.vec_id: np.floor(256 * np.array(r.embedding, np.float64)) for r in table.collect()}
    for r in vectors.encoded(table, books, ["vec_id"]).collect():
        assert ((vectors.decoded(r.code, books) - given[r.vec_id]) ** 2).sum() == r.error


def test_lookup_with_hot_keys(spark, tmp_path):
    rows = spark.range(10_000).select("id", F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 5000).alias("k"))
    rows.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    values = spark.createDataFrame([(None, "null"), (1, "one"), (4999, "last")], "k bigint, v string")
    found = looked_up(rows, values, ["k"]).groupBy("v").count().collect()
    assert {r.v: r["count"] for r in found} == {"null": 3334, "one": 1, "last": 1, None: 10_000 - 3336}


# ---- phrases


def brute_phrases(rows, least):
    counts, totals = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for m in range(1, 6):
                for i in range(len(words) - m + 1):
                    counts[lang, tuple(words[i: i + m])] += 1
    return {k: n for k, n in counts.items() if n >= least}, totals


def brute_collocations(rows, least, top):
    counts, totals = brute_phrases(rows, least)
    out = []
    for (lang, words), a in counts.items():
        if len(words) < 2:
            continue
        longer = (w for (other, w), f in counts.items() if other == lang and len(w) > len(words) and f >= a)
        if any(w[i: i + len(words)] == words for w in longer for i in range(len(w) - len(words) + 1)):
            continue
        cuts = [(counts[lang, words[:k]], counts[lang, words[k:]], k) for k in range(1, len(words))]
        score, _, left, right = min((1000 * a * totals[lang] // (x * y), k, x, y) for x, y, k in cuts)
        out.append((lang, " ".join(words), a, left, right, totals[lang], score))
    ranked = []
    for lang in {r[0] for r in out}:
        mine = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:top]
        ranked += [(r[0], i, *r[1:]) for i, r in enumerate(mine, 1)]
    return sorted(ranked)


@pytest.fixture(scope="module")
def wordy(spark):
    rng = random.Random(4)
    stock = ["the", "The", "of", "ÄRGER", "new york", "new\tyork city", "a b c d e f", "a  b c d e", "x", "y,", "z.", "ß\x1cq", "!", "\n", "\x0b"]
    rows = [
        (i, None if i % 50 == 0 else " ".join(rng.choices(stock, k=rng.randrange(40))), rng.choice(["en", "de", None, "und", ""]))
        for i in range(400)
    ]
    rows += rows[:20]
    return rows, spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, lang string, phrase string, size int").repartition(6)


@pytest.mark.parametrize("share", [0, 0.3, 1])
def test_phrases_whatever_is_proposed(spark, wordy, share):
    """An empty, a partial and a full proposal give the same phrases: failures of the border bring in the rest."""
    rows, frame = wordy
    expected, totals = brute_phrases(rows, 12)
    rng = random.Random(1)
    proposed = [(phrases.phrase_hash(lang, " ".join(words)),) for lang, words in expected if rng.random() < share]
    full = phrases.frequent(frame, 12, spark.createDataFrame(proposed, "hash bigint"))
    found = [tuple(r) for r in full.where("size > 0").select("lang", "phrase", "f").collect()]
    assert len(found) == len(set(found))
    assert {(lang, tuple(p.split(" "))): f for lang, p, f in found} == expected
    assert {r.lang: r.f for r in full.where("size = 0").collect() if r.f} == {k: n for k, n in totals.items() if n}


def test_sample_proposes_and_border_completes(spark, wordy):
    rows, frame = wordy
    given = phrases._words_of(frame)
    proposed = phrases.proposal(given, 3, 2)
    assert proposed.count() > 0
    found = phrases.frequent(frame, 12, proposed).where("size > 0").select("lang", "phrase", "f").collect()
    assert {(r.lang, tuple(r.phrase.split(" "))): r.f for r in found} == brute_phrases(rows, 12)[0]


def test_colliding_bits_change_nothing(spark, wordy, monkeypatch):
    rows, frame = wordy
    monkeypatch.setattr(phrases, "LEAST_BITS", 6)
    monkeypatch.setattr(phrases, "MOST_BITS", 6)
    found = phrases.frequent(frame, 12).where("size > 0").select("lang", "phrase", "f").collect()
    assert {(r.lang, tuple(r.phrase.split(" "))): r.f for r in found} == brute_phrases(rows, 12)[0]


def test_collocations_against_brute_force(spark, wordy):
    rows, frame = wordy
    for top in (5, 2000):
        found = phrases.collocations(phrases.frequent(frame, 12), 12, top)
        assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert sorted(tuple(r) for r in found.collect()) == brute_collocations(rows, 12, top)


def test_phrases_of_odd_rows(spark, odd, empty):
    repeated = phrases.frequent(odd, 4).where("size = 5").select("phrase").collect()
    assert {r.phrase for r in repeated} >= {"lorem ipsum dolor sit amet", "amet lorem ipsum dolor sit"}
    assert phrases.collocations(phrases.frequent(empty)).count() == 0


def test_scores_beyond_64_bits(spark):
    rows = [("en", 0, "", 10**14), ("en", 1, "a", 10**12 + 7), ("en", 1, "b", 10**12 + 9), ("en", 2, "a b", 10**12 + 1)]
    made = phrases.collocations(spark.createDataFrame(rows, "lang string, size int, phrase string, f bigint")).first()
    assert made.score == 1000 * (10**12 + 1) * 10**14 // ((10**12 + 7) * (10**12 + 9))
