"""Operators over documents together: near duplicates, mixing, packing, revisits, chat, and the pipeline."""

import datetime
import hashlib
import itertools
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from surveyloom.llm import chat, mixing, neardup, packing, revisits

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def classes_by_brute_force(texts):
    """Smallest id reachable over equal texts and likeness of 0.8; ``texts`` by id."""
    parent = {i: i for i in texts}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    first, having = {}, defaultdict(list)
    for i in sorted(texts):
        if texts[i] in first:
            parent[i] = first[texts[i]]
            continue
        first[texts[i]] = i
        data = texts[i].encode()
        for cell in neardup.cells(np.frombuffer(data, np.uint8), np.array([0, len(data)]))[1].tolist():
            having[cell].append(i)
    for a, b in {p for ids in having.values() for p in itertools.combinations(ids, 2)}:
        if neardup.likeness(texts[a].encode(), texts[b].encode()) >= neardup.LIKENESS:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in texts}


def test_classes_equal_brute_force(spark, docs):
    rnd = random.Random(1)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for group in range(4):
        words = texts[group * 7].split() or ["a"]
        for copy in range(20):
            edited = list(words)
            for _ in range(rnd.randint(0, max(1, len(words) // 25))):
                edited[rnd.randrange(len(edited))] = f"zz{rnd.randrange(99)}"
            texts[10_000 + 100 * group + copy] = " ".join(edited)
    for i in range(10):
        texts[20_000 + i] = "Is onhe. " * 200 + texts[50 + i][:400]
    frame = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    found = {r.doc_id: r.class_id for r in neardup.near_classes(frame).collect()}
    assert found == classes_by_brute_force(texts)


def test_darts_estimate_weighted_likeness():
    a, b = [f"w{i}" for i in range(600)], [f"w{i}" for i in range(150, 750)]
    texts = [" ".join(a).encode(), " ".join(b).encode()]
    data = np.frombuffer(b"".join(texts), np.uint8)
    sig, _ = neardup.signatures(data, np.array([0, len(texts[0]), len(data)]), k=2000)
    assert (sig[0] == sig[1]).mean() == pytest.approx(neardup.likeness(*texts), abs=0.05)


def test_near_duplicates_of_odd_rows(odd, empty):
    found = sorted((r.doc_id or 0, r.class_id or 0) for r in neardup.near_classes(odd).collect())
    assert found == [(0, 0), (1, 1), (2, 1), (3, 3), (4, 4), (4, 4), (5, 4), (6, 6), (7, 7), (8, 8)]
    kept = neardup.keep_first(odd)
    assert kept.columns == odd.columns and Counter(r.doc_id for r in kept.collect()) == Counter([None, 1, 3, 4, 6, 7, 8])
    assert neardup.near_classes(empty).count() == 0 and neardup.keep_first(empty).count() == 0


def test_mix_meets_targets_and_repeats(spark, docs):
    rows = mixing.mixed(docs).collect()
    again = mixing.mixed(docs).collect()
    assert sorted(rows) == sorted(again)
    taken = defaultdict(int)
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source, r.target] += r.taken
    assert all(abs(t - target) <= 1 for (_, target), t in taken.items())


def test_schedule_spreads_sources(spark):
    plan = spark.createDataFrame([("a", 0, 9, 1.0, 50 * 1024), ("b", 1, 9, 1.0, 20 * 1024), ("c", 2, 9, 1.0, 10 * 1024 + 5)],
                                 "source string, source_no bigint, source_size bigint, target double, goal bigint")
    slots = sorted((r.slot, r.source_no, r["rank"]) for r in mixing.schedule(plan).collect())
    assert len({s for s, _, _ in slots}) == len(slots) == 81
    for number, need in ((0, 50), (1, 20), (2, 11)):
        assert [r for _, n, r in slots if n == number] == list(range(need))
    early = Counter(n for _, n, _ in slots[:40])
    assert abs(early[0] - 25) <= 3 and abs(early[1] - 10) <= 3


def test_mix_of_odd_rows(odd, empty):
    rows = mixing.mixed(odd).collect()
    assert len(rows) == 10 and all(r.taken == 0 for r in rows if r.size == 0)
    assert mixing.mixed(empty).count() == 0
    repeated = mixing.repeat_documents(odd)
    assert repeated.columns == odd.columns and {1, 2, 6} <= {r.doc_id for r in repeated.collect()}
    assert mixing.repeat_documents(empty).count() == 0


def check_packed(rows, sequence):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        places.sort()
        assert places[0][0] == 0 and sum(n for _, n in places) <= sequence
        assert all(a + n == b for (a, n), (b, _) in zip(places, places[1:]))
    return len(by)


def test_packing_reaches_the_lower_bound(docs):
    rows = packing.best_fit_pack(docs, WORDS).collect()
    assert check_packed(rows, 2048) == -(-sum(r.length for r in rows) // 2048)


def planted(bins, low, high, seed):
    """Lengths that fill so many sequences exactly, each cut into ``low`` to ``high`` pieces."""
    rnd = random.Random(seed)
    made = []
    for _ in range(bins):
        cuts = [0, *sorted(rnd.sample(range(1, 2048), rnd.randint(low, high) - 1)), 2048]
        made += [b - a for a, b in zip(cuts, cuts[1:])]
    return Counter(made)


@pytest.mark.parametrize("bins, low, high", [(10, 3, 3), (20, 3, 3), *[(n, 2, 5) for n in (10, 20, 40, 80)], *[(n, 3, 8) for n in (10, 20, 40, 80)]])
def test_planted_packings_are_found(bins, low, high):
    for seed in range(2):
        counts = planted(bins, low, high, seed)
        steps = packing.complete(counts)
        used = Counter()
        for longest, chosen, times in steps:
            assert longest + sum(chosen) <= 2048
            for x in [longest, *chosen]:
                used[x] += times
        assert used == counts and sum(times for *_, times in steps) == bins


def test_fillings_come_in_both_orders_and_are_undominated():
    counts = {5: 1, 4: 2, 3: 2, 2: 3, 1: 2}
    few = list(packing.fillings(counts, [1, 2, 3, 4, 5], 7, 0))
    longest = list(packing.fillings(counts, [1, 2, 3, 4, 5], 7, 0, few_first=False))
    assert few[0] == longest[0] == [5, 2] and [4, 3] in few and sorted(map(len, few)) == list(map(len, few))
    assert all(sum(f) == 7 for f in few + longest)
    assert list(packing.fillings({9: 1}, [9], 7, 7)) == [[]] and list(packing.fillings({9: 1}, [9], 7, 6)) == []


def test_effort_of_fillings_does_not_grow_with_the_waste_allowed():
    counts = {5: 1, 4: 2, 3: 2, 2: 3, 1: 2}
    assert list(packing.fillings(counts, [1, 2, 3, 4, 5], 7, -1)) == []
    tracemalloc.start()
    try:
        found = {tuple(f) for f in packing.fillings(counts, [1, 2, 3, 4, 5], 7, 1_000_000)}
        steps = packing.complete({1500: 2_000, 400: 1_000}, steps=20)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found == {tuple(f) for f in packing.fillings(counts, [1, 2, 3, 4, 5], 7, 7)} and (5, 2) in found
    assert sum(times for *_, times in steps) == 2_000
    assert peak < 1 << 20


def test_pieces_equal_the_library(docs):
    library = Tokenizer.from_file(WORDS)
    given = {r.doc_id: r.text or "" for r in docs.collect()}
    found = defaultdict(list)
    for r in packing.pieces(docs, WORDS).collect():
        found[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    for doc_id, text in given.items():
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 0], "<u4")
        cut = [ids[i: i + 2048] for i in range(0, len(ids), 2048)]
        assert sorted(found[doc_id]) == [(i, 2048 * i, len(c), zlib.crc32(c.tobytes())) for i, c in enumerate(cut)]


@pytest.mark.parametrize("seed", range(6))
def test_completion_against_all_packings(seed):
    rnd = random.Random(seed)
    sizes = [rnd.randint(2, 9) for _ in range(9)]

    def fewest(left, bins):
        if not left:
            return len(bins)
        best = 99
        for room in {r for r in bins if r >= left[0]}:
            rest = list(bins)
            rest.remove(room)
            best = min(best, fewest(left[1:], [*rest, room - left[0]]))
        return min(best, fewest(left[1:], [*bins, 10 - left[0]]))

    found = packing.complete(dict(Counter(sizes)), 10)
    used = Counter()
    for longest, chosen, times in found:
        assert longest + sum(chosen) <= 10
        for x in [longest, *chosen]:
            used[x] += times
    assert used == Counter(sizes) and sum(t for *_, t in found) == fewest(sorted(sizes, reverse=True), [])


def test_dominance():
    assert packing.dominates([6, 2], [4, 2, 2]) and not packing.dominates([4, 4], [6])


def test_packing_of_odd_rows(odd, empty):
    rows = packing.best_fit_pack(odd, WORDS).collect()
    check_packed(rows, 2048)
    pieces = Counter((r.doc_id, r.piece) for r in rows)
    assert {d for d, _ in pieces} == {None, *range(1, 9)} and pieces[4, 0] == 2
    assert [r.length for r in rows if r.doc_id in (1, 2, 6)] == [1, 1, 1]
    assert packing.best_fit_pack(empty, WORDS).count() == 0


@pytest.mark.parametrize("text", ["", "\\", "<|", "a\\|<|im_end|>\n", "\\n\n<\\|", "<<||>|", "\n"])
def test_escape_round_trip(text):
    assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
    assert chat.parse(chat.turn_text(text, text))[0][:2] == (text, text)


def check_chat(frame):
    turns = defaultdict(list)
    for r in frame.collect():
        turns[r.conv_id].append((r.turn is not None, r.turn, r.role or "", r.text or ""))
    made = chat.windows(frame, BYTES)
    found = {r.conv_id: r for r in chat.digests(made).collect()}
    assert set(found) == set(turns)
    for conv, rows in turns.items():
        rows.sort(key=lambda r: (r[0], r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest()))
        said = "".join(t for _, _, role, t in rows if role == "assistant")
        row = found[conv]
        assert (row.n_turns, row.loss_chars) == (len(rows), len(said))
        assert row.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for _, _, r, t in rows).encode()).hexdigest()
        assert row.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    return made


def check_windows(rows, budget=chat.BUDGET):
    """No window costs more than it says, or than the budget unless one turn alone does."""
    library = Tokenizer.from_file(BYTES)
    for r, found in zip(rows, library.encode_batch([r.formatted for r in rows], add_special_tokens=False)):
        assert r.tokens == len(found.ids)
        if r.tokens > budget:
            own = chat.parse(r.formatted)[r.n_repeated:]
            assert r.n_own == 1 and len(library.encode(chat.turn_text(*own[0][:2]), add_special_tokens=False).ids) > budget


def test_chat_of_all_conversations(spark, sf_dir):
    frame = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = check_chat(frame).collect()
    check_windows(rows)
    later = [r for r in rows if r.part]
    history = [[t for t in chat.parse(r.formatted)[: r.n_repeated] if t[0] != "system"] for r in later]
    assert later and sum(map(bool, history)) >= 0.7 * len(later)
    many = [r for r in rows if any(o.conv_id == r.conv_id and o.part > r.part for o in later)]
    assert sum(r.tokens for r in many) >= 0.7 * chat.BUDGET * len(many)  # windows that another one follows are filled


@pytest.mark.parametrize("chunk", [4, 16, 1024])
def test_chat_in_chunks(spark, sf_dir, monkeypatch, chunk):
    monkeypatch.setattr(chat, "CHUNK", chunk)
    frame = spark.read.parquet(f"{sf_dir}/conversations.parquet").where("conv_id < 40")
    long = [(1_000, i, "system" if i in (0, 7) else "assistant" if i % 2 else "user", f"turn {i} " * (i % 40)) for i in range(-3, 300)]
    more = [(1_001, i, "system" if i in (0, 7) else "assistant" if i % 2 else "user", f"turn {i} " * (i % 40)) for i in range(300)]
    frame = frame.select("conv_id", "turn", "role", "text").unionByName(
        spark.createDataFrame(long + more, "conv_id bigint, turn bigint, role string, text string")
    )
    rows = check_chat(frame).collect()
    check_windows(rows)
    firsts = {r.conv_id: chat.parse(r.formatted)[0][:2] for r in rows if r.conv_id in (1_000, 1_001) and (r.chunk > 0 or r.part)}
    assert firsts[1_001] == ("system", "") and firsts[1_000][0] != "system"
    single = {r.conv_id: r for r in chat.conversation_digests(frame, BYTES).collect()}
    assert single == {r.conv_id: r for r in chat.digests(chat.windows(frame, BYTES)).collect()}


def test_chat_of_odd_rows(spark):
    rows = [(1, 0, "system", "be kind"), *[(1, i, "assistant" if i % 2 else "user", f"turn {i} " * 90) for i in range(1, 60)],
            (None, 0, "user", "x"), (2, None, None, None), (2, 1, "assistant", ""), (2, 1, "assistant", ""), (3, 0, "assistant", "b <|im_end|>\n" * 3000),
            (4, 0, "system", "s " * 300), (4, 1, "user", "u " * 1000), (4, 2, "assistant", "ok")]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    made = check_chat(frame.selectExpr("*", "1 AS nth", "2 AS cost", "3 AS window", "4 AS chunk", "5 AS kind"))
    found = made.collect()
    check_windows(found)
    one = [r for r in found if r.conv_id == 1]
    assert len(one) > 10 and all(chat.parse(r.formatted)[0][:2] == ("system", "be kind") for r in one)
    assert sum(r.n_repeated == 2 for r in one) >= len(one) - 2  # the system turn and the one before
    four = [chat.parse(r.formatted)[0][0] for r in found if r.conv_id == 4]
    assert four == ["system", "user", "system"]  # the second doesn't fit beside the system turn
    assert chat.digests(chat.windows(frame.limit(0), BYTES)).count() == 0
    assert chat.conversation_digests(frame.limit(0), BYTES).count() == 0


def record(i, url, minute, kind, headers=None, digest=None):
    day = None if minute is None else datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=minute)
    return (i, url, day, kind, headers, digest, None if digest is None else 5)


def test_revisits(spark):
    rows = [
        record(1, "http://www.a.org/x/?ref=1&b=2&a=1", 0, "response", {"ETag": '"1"', "Content-Length": "5"}, "d1"),
        record(2, "https://A.org:443/x?a=1&b=2#f", 5, "response", {"ETag": '"2"', "Last-Modified": "m"}, "d2"),
        record(3, "http://a.org/x?b=2&a=1", 3, "revisit", {"etag": 'W/"1"', "Content-Length": "0", "Age": "9"}),
        record(4, "http://a.org/x?b=2&a=1", 5, "revisit", {"etag": '"1"'}),
        record(5, "http://a.org/x?b=2&a=1", 9, "revisit", {"etag": '"1"'}),
        record(6, "http://a.org/x?b=2&a=1", 9, "revisit", {"Last-Modified": "m"}),
        record(7, "http://a.org/x?b=2&a=1", 9, "revisit", None),
        record(8, "http://b.org/", 9, "revisit"), record(9, None, 9, "revisit"), record(10, "http://b.org/", None, "revisit"),
        record(11, "http://b.org/", 9, "response", None, "d3"), record(12, "x", 1, "request"),
    ]
    schema = ("record_id bigint, url string, date timestamp, kind string, headers map<string,string>, payload_digest string,"
              " payload_bytes bigint")
    found = {r.record_id: r for r in revisits.resolve(spark.createDataFrame(rows, schema)).collect()}
    assert {i: (r.response_id, r.status) for i, r in found.items()} == {
        3: (1, "resolved"), 4: (1, "resolved"), 5: (2, "mismatch"), 6: (2, "resolved"), 7: (2, "unverified"),
        8: (None, "no_response"), 9: (None, "no_response"), 10: (None, "no_response")}
    assert found[3].headers == {"etag": 'W/"1"', "content-length": "5", "age": "9"} and found[3].payload_digest == "d1"
    assert found[5].headers is None
    assert revisits.resolve(spark.createDataFrame([], schema)).count() == 0


def test_one_url_with_many_captures(spark):
    rows = [record(i, "http://a.org/", i, "revisit" if i % 3 else "response", {"etag": f'"{i // 3}"'}, None if i % 3 else f"d{i}")
            for i in range(900)]
    schema = ("record_id bigint, url string, date timestamp, kind string, headers map<string,string>, payload_digest string,"
              " payload_bytes bigint")
    found = revisits.resolve(spark.createDataFrame(rows, schema)).collect()
    assert len(found) == 600 and all(r.status == "resolved" and r.response_id == r.record_id // 3 * 3 for r in found)


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "near_duplicates", "mix", "pack"]
    given = {r.doc_id: r.text or "" for r in docs.collect()}
    seen = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.saved(stage(spark, seen, sf_dir), name)
        assert after.columns == docs.columns
        before, now = Counter(r.doc_id for r in seen.collect()), Counter(r.doc_id for r in after.collect())
        assert set(now) <= set(before) and all(r.text == given[r.doc_id] for r in after.collect())
        if name == "near_duplicates":
            classes = classes_by_brute_force({i: given[i] for i in before})
            assert sorted(now) == sorted(set(classes.values())) and max(now.values()) == 1
        if name == "mix":
            assert max(now.values()) <= 3
        seen = after
    packed = corpus_pipeline.STAGES[-1][1](spark, seen, sf_dir).collect()
    check_packed(packed, 2048)
    assert Counter(r.doc_id for r in packed if r.piece == 0) == now
    assert corpus_pipeline.run(spark, sf_dir).count() == len(packed)


def test_pipeline_of_odd_tables(spark, odd, empty, tmp_path):
    rnd = random.Random(3)
    prose = [" ".join("".join(rnd.choices("abcdefghij", k=5)) for _ in range(80)) for _ in range(6)]
    schema = odd.schema
    good = [(100 + i, t, None, "s" if i % 2 else None, None, None, "x", "k", 1) for i, t in enumerate(prose)]
    good += [(None, prose[0] + " tail", "en", None, 1, True, None, None, None), good[1], good[1], (200, prose[2], "en", "s", 1, None, "x", "k", 1)]
    tables = {
        "good": (odd.unionByName(spark.createDataFrame(good, schema)), [(100, 1, 0), (101, 0, None), (None, None, 1), (102, 1, 0)]),
        "empty": (empty, []), "unlabelled": (spark.createDataFrame(good, schema), []),
    }
    for name, (docs, labels) in tables.items():
        folder = f"{tmp_path}/{name}"
        docs.write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        kept = docs
        for stage, function in corpus_pipeline.STAGES[:-1]:
            kept = function(spark, kept, folder)
            assert kept.columns == docs.columns, stage
            if stage == "near_duplicates":  # one of each text and its near copies
                assert kept.count() == (0 if name == "empty" else 6)
        pieces = corpus_pipeline.run(spark, folder)
        assert {"doc_id", "sequence_id", "offset", "length"} <= set(pieces.columns)
        ids = {r.doc_id for r in pieces.collect()}
        assert ids <= {100, 101, 102, 103, 104, 105, 200, None} and bool(ids) == (name != "empty")
