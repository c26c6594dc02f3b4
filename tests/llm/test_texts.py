"""Operators on single texts: fingerprints, tokens, quality, licenses, toxicity."""

import hashlib
import random
import re
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from surveyloom.llm import fingerprint, licenses, quality, tokens, toxicity
from surveyloom.llm.fingerprint import fingerprints
from surveyloom.llm.tokens import counted

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {tuple(words[i: i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_fingerprints_of_all_documents(spark, docs):
    given = sorted((r.doc_id, r.text or "") for r in docs.collect())
    found = {r.doc_id: r for r in fingerprints(docs).collect()}
    assert len(found) == len(given)
    off = []
    for i, (doc_id, text) in enumerate(given):
        after = given[(i + 1) % len(given)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        row = found[doc_id]
        assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        a, b = shingles(text), shingles(edited)
        off.append(row.near_edited - len(a & b) / max(1, len(a | b)))
        if len(a) <= fingerprint.LEAST:
            assert len(row.fingerprint) == 16 * len(a)
    assert abs(sum(off) / len(off)) < 0.02 and max(map(abs, off)) < 0.4


def test_likeness_of_short_and_usual_texts(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("length(text) < 20000 AND doc_id % 2 = 0")
    given = sorted((r.doc_id, r.text or "") for r in docs.collect())
    found = {r.doc_id: r.near_edited for r in fingerprints(docs).collect()}
    off = []
    for i, (doc_id, text) in enumerate(given):
        half = len(text) // 2
        a, b = shingles(text), shingles(text[: len(text) - half] + given[(i + 1) % len(given)][1][:half])
        off.append(abs(found[doc_id] - len(a & b) / max(1, len(a | b))))
        if len(a) < 128 and len(b) < 128:
            assert off[-1] < 1e-9
    off.sort()
    assert off[int(len(off) * 0.95)] < 0.1 and off[-1] < 0.15


def test_fingerprints_of_odd_rows(odd, empty):
    found = fingerprints(odd).collect()
    assert len(found) == 10 and fingerprints(empty).count() == 0
    by_id = {r.doc_id: r for r in found}
    assert by_id[1].fingerprint == by_id[2].fingerprint == by_id[6].fingerprint == ""
    assert by_id[4].fingerprint == by_id[5].fingerprint != ""
    # ids in order: null, 1, 2, ...; the last is followed by the null id
    assert by_id[8].edited_sha256 == hashlib.sha256(("a" * 25_000 + "alone here").encode()).hexdigest()
    assert by_id[1].near_next == 1.0 and by_id[2].near_next == 0.0
    single = fingerprints(odd.where("doc_id = 7")).first()
    assert single.near_next == 1.0


def test_merged_sketch_is_that_of_both_texts(spark):
    words = [f"w{i}" for i in range(3000)]
    frame = spark.createDataFrame([(" ".join(words[:2000]), " ".join(words[1996:]), " ".join(words))], "a string, b string, c string")
    kept = [fingerprint.sketch(F.col(c)) for c in "abc"]
    row = frame.select(fingerprint.merged(kept[0], kept[1]).alias("m"), kept[2].alias("whole"),
                       fingerprint.containment(kept[0], kept[2]).alias("inside")).first()
    assert row.m == row.whole and row.inside == 1.0


def test_whole_tokens_are_one_token():
    some = sorted(tokens.whole_tokens(BYTES))
    library = Tokenizer.from_file(BYTES)
    assert len(some) > 40_000 and all(len(e.ids) == 1 for e in library.encode_batch(some[::50], add_special_tokens=False))


TEXTS = [
    "<|endoftext|> <|ENDOFTEXT|>. It's. É. é. A.B. 1.  don't, İ. Σ. x \x1c a.\x85b  ", "", ".", "a.<|endoftext|>b.", "日本語 text 🙂",
    "x" * 3000, "  \n\n\t ", "ſ ﬁ Ǆ \u0301e e\u0301",
]


def test_encoder_and_counter_equal_the_library(docs):
    texts = TEXTS + [r.text or "" for r in docs.limit(60).collect()]
    library = Tokenizer.from_file(WORDS)
    import numpy as np

    for text, ids in zip(texts, tokens.Encoder(WORDS).encode([t.encode() for t in texts])):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    library = Tokenizer.from_file(BYTES)
    assert tokens.Counter(BYTES).count(texts) == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_counts_of_odd_rows(odd, empty):
    found = [(r.doc_id, r.n_bytes, r.n_tokens) for r in counted(odd, BYTES, ["doc_id"]).collect()]
    assert (1, 0, 0) in found and (2, 0, 0) in found and found.count((4, 7, 2)) == 2
    assert counted(empty, BYTES, ["doc_id"]).count() == 0


@pytest.mark.parametrize("text, want", [
    ("", (0, 0, 0, 0, 0)), ("a b c a b c", (6, 6, 0, 0, 6)), ("a a a a", (4, 4, 0, 0, 4)), ("x y z", (3, 3, 0, 0, 0)),
    ("a b c d a b c", (7, 7, 0, 0, 6)), ("é#$\n é#$\né#$\n\n", (3, 9, 6, 1, 0)),
])
def test_measures(text, want):
    assert quality.measure(text.encode()) == want


def test_quality_of_odd_rows(odd, empty):
    found = quality.quality(odd).collect()
    assert len(found) == 10 and not any(r.kept for r in found)
    assert quality.quality(empty).count() == 0 and quality.keep_good(empty).columns == empty.columns


def test_host_verdicts_shrink_small_hosts(spark):
    names = list(quality.rules())
    columns = "source string, n_docs bigint, " + ", ".join(f"fail_{n} bigint" for n in names)
    hosts = [(f"h{i}", 1000, 10 + i, 5, 5, 5, 5) for i in range(20)]
    hosts += [(None, 1000, 10, 5, 5, 5, 5)]
    for odd_one, rejected in (("bad", 1000, 990, 5, 5, 5, 5), True), (("tiny", 1, 1, 0, 0, 0, 0), False):
        found = quality.host_verdicts(spark.createDataFrame([*hosts, odd_one], columns)).collect()
        assert [r.source for r in found if r.host_rejected] == [odd_one[0]] * rejected


def test_documents_that_fail_a_rule_go(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {r.doc_id for r in quality.keep_good(docs).collect()}
    failing, base = set(), set()
    for row in docs.collect():
        words, chars, symbols, lines, repeated = quality.measure((row.text or "").encode())
        if words < 50 or repeated * 2 > words:
            base.add(row.doc_id)
        elif symbols * 10 > words or lines * 10 > words or chars < words * 2 or chars > words * 12:
            failing.add(row.doc_id)
    assert len(failing) == 68 and not kept & failing
    judged = quality.quality(docs).collect()
    assert {r.doc_id for r in judged if r.kept} == kept  # the query and the pipeline's stage agree
    assert sum(r.kept != (not r.base_failed) for r in judged) >= 68
    good = {r.doc_id for r in spark.read.parquet(f"{folder}/labels.parquet").where("quality = 1").collect()}
    there = {r.doc_id for r in docs.select("doc_id").collect()}
    assert (good & there) - base <= kept


def test_bars_follow_the_host(spark):
    rows = [("a", 100, 500, 6, 0, 0), ("b", 100, 500, 6, 0, 0), (None, 100, 500, 0, 0, 0)]
    measured = spark.createDataFrame(rows, "source string, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint")
    rates = ", ".join(f"{{}} AS rate_{n}" for n in quality.rules())
    verdicts = spark.sql(" UNION ALL ".join(
        f"SELECT {host} AS source, false AS host_rejected, " + rates.format(0, 0, symbols, 0, 0)
        for host, symbols in (("'a'", 0.1), ("'b'", 0.5), ("CAST(NULL AS STRING)", 0.1))
    ))
    found = quality.judge(measured, verdicts).where("kept").select("source").collect()
    assert {r[0] for r in found} == {"a", None}


def test_template_automata():
    one = licenses.compile_template("this {{2}} is [[very]] free")
    accept = lambda t: one.run(licenses.words_of(t.encode()), 0)[1]
    assert all(map(accept, ["This work is free", "this big work, is VERY free", "this a is free now"]))
    assert not any(map(accept, ["this is free", "this a b c is free", "this work is quite free", "this work"]))
    for wrong in ("{{2}} a", "a [[b", ""):
        with pytest.raises(ValueError):
            licenses.compile_template(wrong)


def as_pattern(template):
    """A template as a regular expression over words that each have a space behind them."""
    made = re.sub(r"\{\{(\d+)\}\} ?", r"(?:\\S+ ){1,\1}", template + " ")
    made = re.sub(r"\[\[([^\]]*)\]\] ?", lambda m: f"(?:{m[1]} )?", made)
    return re.compile(r"(?<!\S)" + made)


def variant(template, rnd):
    """A text of the template's wording, with some optional parts and replaceable words, and sometimes a fault."""
    text = re.sub(r"\[\[([^\]]*)\]\]", lambda m: m[1] if rnd.random() < 0.5 else "", template)
    text = re.sub(r"\{\{(\d+)\}\}", lambda m: " ".join(rnd.choices(["acme", "the", "2024"], k=rnd.randint(1, int(m[1]) + 1))), text)
    words = text.split()
    fault = rnd.randrange(4)
    if fault == 1:
        words[rnd.randrange(1, len(words))] = "not"
    elif fault == 2:
        del words[rnd.randrange(1, len(words))]
    elif fault == 3:
        words.insert(rnd.randrange(1, len(words)), "except")
    return "before, " + rnd.choice([" ", "\n * "]).join(w.upper() if rnd.random() < 0.2 else w for w in words) + ". after"


def test_templates_equal_an_independent_matcher(docs):
    patterns = {label: as_pattern(text) for label, text in licenses.TEMPLATES.items()}
    scanner = licenses.Scanner()
    rnd = random.Random(8)
    texts = [variant(t, rnd) for t in licenses.TEMPLATES.values() for _ in range(60)] + [r.text or "" for r in docs.collect()]
    accepted = 0
    for text in texts:
        words = "".join(f"{w} " for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)))
        want = {label for label, pattern in patterns.items() if pattern.search(words)}
        found = scanner.scan(text.encode())
        assert set(found[5].split(",")) - {""} == want | (set(found[4].split(",")) - {""}), text
        accepted += bool(want)
    assert accepted > 200


def test_altered_licenses_are_not_accepted():
    whole = licenses.TEMPLATES["mit-text"].replace("[[including the next paragraph]]", "")
    scanner = licenses.Scanner()
    assert scanner.scan(whole.encode())[5:] == ("mit-text", 1.0)
    for changed in (whole.replace("without restriction", "without restriction except that commercial use is forbidden"), whole[:-20]):
        labels, score = scanner.scan(changed.encode())[5:]
        assert labels == "" and 0 < score < 1


def test_base_places_equal_brute_force(docs):
    for row in licenses.scanned(docs, ["doc_id", "text"]).collect():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), row.text or ""))
        found = [(i, label) for phrase, label in licenses.BASE.items() for i in range(len(words))
                 if words[i: i + len(phrase.split())] == phrase.split()]
        starts = [i for i, _ in found]
        assert (row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels) == (
            len(words), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in found})))
        assert set(row.base_labels.split(",")) - {""} <= set(row.labels.split(","))


def test_licenses_of_odd_rows(odd, empty):
    found = licenses.scanned(odd, ["doc_id"]).collect()
    assert len(found) == 10 and all(r.labels == "" and r.first_word is None for r in found)
    assert licenses.scanned(empty, ["doc_id"]).count() == 0


def test_kernel_is_one_for_equal_words_and_bears_gaps():
    marks = toxicity.Marks(toxicity._tables(["worthless", "banana"]))
    near = toxicity._kernel(["worthless", "worthxless", "banana", "xyzzy"], marks)
    assert near[0, 0] == pytest.approx(1, abs=1e-4) and near[2, 1] == pytest.approx(1, abs=1e-4)
    assert near[0, 0] > near[1, 0] > near[2, 0] and near[3, 0] == 0


def test_toxicity_held_out(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet").where("toxic IS NOT NULL")
    model = toxicity.train(toxicity.training_rows(docs, labels))
    test = docs.join(labels.select("doc_id", "toxic"), "doc_id").where(toxicity.held_out())
    found = [(r.toxic, r.score) for r in toxicity.scored(test, model, ["toxic"]).collect()]
    right = sum((score >= toxicity.THRESHOLD) == toxic for toxic, score in found)
    assert right / len(found) > 0.95
    word = "worthless"
    hidden = [word, word.upper() + "!", ".".join(word), " ".join(word), "-".join(word)]
    assert model.probability(toxicity._score_slice(model, [f"the and {w} of" for w in hidden])).min() > 0.7


def test_toxicity_of_inserted_letters(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet").where("toxic IS NOT NULL")
    model = toxicity.train(toxicity.training_rows(docs, labels))
    insults = "disgusting trash stupid pathetic clown worthless idiot loser scum moron".split()
    inserted = [w[:k] + c + w[k:] for w in insults for k in range(1, len(w)) for c in "abcdefghijklmnopqrstuvwxyz"]
    hidden = model.probability(toxicity._score_slice(model, [f"the and {w} of" for w in inserted]))
    assert (hidden >= toxicity.THRESHOLD).mean() > 0.95
    # held-out toxic documents, each insult written with an inserted letter
    test = docs.join(labels.where("toxic = 1").select("doc_id"), "doc_id").where(toxicity.held_out())
    insult = re.compile(rf"\b({'|'.join(insults)})\b", re.IGNORECASE)
    texts = [r.text for r in test.select("text").collect() if insult.search(r.text or "")]
    changed = [insult.sub(lambda m: m[0][:2] + "xq"[len(m[0]) % 2] + m[0][2:], t) for t in texts]
    found = model.probability(toxicity._score_slice(model, changed))
    assert len(texts) > 50 and (found >= toxicity.THRESHOLD).mean() > 0.95


def test_held_out_is_crc(spark):
    frame = spark.range(50).withColumnRenamed("id", "doc_id").select("doc_id", toxicity.held_out().alias("h"))
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in frame.collect())


def test_toxicity_of_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1), (1, None), (2, 0), (None, 1)], "doc_id bigint, toxic int")
    kept = toxicity.keep_clean(odd, labels)
    assert kept.columns == odd.columns and kept.count() == 10
    assert toxicity.keep_clean(empty, labels).count() == 0
