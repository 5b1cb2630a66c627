"""Operators that run Python in tasks: brute force, exact round trips, held-out accuracy."""

from __future__ import annotations

import base64
import hashlib
import random
import zipfile
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rankloom.llm import decontamination, mixing, ngram_join, token_files, toxicity, warc_archives
from rankloom.llm.components import components
from rankloom.llm.sieve import sieve_of, sifted
from rankloom.llm.words import words_of

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


# --- decontamination ---------------------------------------------------------

WORDS = [f"w{i}" for i in range(30)]


def hits_by_hand(text, items):
    words = words_of(text)
    hit, found = set(), set()
    for item_id, item in items:
        own = words_of(item)
        if not own:
            continue
        n = min(13, len(own))
        grams = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)}
        for i in range(len(words) - n + 1):
            if tuple(words[i : i + n]) in grams:
                hit |= set(range(i, i + n))
                found.add(item_id)
    names = sorted(str(i) for i in found if i is not None)
    digest = hashlib.sha256(",".join(names).encode()).hexdigest()
    return len(words), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(words)


@pytest.mark.parametrize("pack_words", [decontamination.PACK_WORDS, 20])
@pytest.mark.parametrize("least", [1, 4, 13])
def test_contamination(spark, docs_of, monkeypatch, pack_words, least):
    rng = random.Random(least)
    items = [(i, " ".join(rng.choices(WORDS, k=rng.randint(least, 25)))) for i in range(8)]
    items += [(8, items[0][1]), (9, ""), (10, None), (None, " ".join(rng.choices(WORDS, k=20)))]
    items += [(None, items[-1][1][:30])]
    texts = [None, "", "w1", items[1][1].upper(), "x " + items[-2][1]]
    for _ in range(30):
        parts = [" ".join(rng.choices(WORDS, k=rng.randint(0, 40)))]
        for _, item in rng.sample(items[:8], 2):
            own = item.split()
            at = rng.randint(0, len(own))
            parts += [" ".join(own[at : at + rng.randint(1, 20)]), rng.choice(WORDS)]
        texts.append(", ".join(parts))
    texts.append(" ".join(["w1 w2"] * 5000 + [items[2][1]]))
    docs = docs_of(*enumerate(texts), (None, texts[5]), (5, texts[5]))
    table = spark.createDataFrame(items, "item_id long, text string")
    default = decontamination.find
    monkeypatch.setattr(decontamination, "find", lambda d, i: default(d, i, pack_words))
    rows = decontamination.report(docs, table).collect()
    got = Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows)
    given_rows = [*enumerate(texts), (None, texts[5]), (5, texts[5])]
    assert got == Counter((i, *hits_by_hand(t, items)) for i, t in given_rows)
    kept = decontamination.keep_clean(docs, table)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not r.contaminated for r in rows)


def test_hit_spans_are_cut_from_clean_documents(spark):
    item = " ".join(f"i{k}" for k in range(60))
    filler = " ".join(f"é{k}" for k in range(1000))
    texts = [f"{filler}. ({item.upper()}), {filler}!", f"{filler} {item[:30]}", item, None]
    docs = spark.createDataFrame(
        [(k, t, t and len(t)) for k, t in enumerate(texts)], "doc_id long, text string, n_chars long"
    )
    table = spark.createDataFrame([(1, item)], "item_id long, text string")
    kept = {r.doc_id: r for r in decontamination.keep_clean(docs, table).collect()}
    assert set(kept) == {0, 1, 3}
    assert kept[0].text == f"{filler}. (\n), {filler}!"
    assert kept[0].n_chars == len(kept[0].text)
    assert (kept[1].text, kept[3].text, kept[3].n_chars) == (texts[1], None, None)
    again = decontamination.report(decontamination.keep_clean(docs, table), table)
    assert again.where("n_hit > 0").count() == 0


def test_no_items_no_hits(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    row = decontamination.report(docs_of((1, "a b")), none).first()
    assert (row.n_words, row.n_hit, row.contaminated) == (2, 0, False)


# --- token files -------------------------------------------------------------


@given(st.integers(1, 32), st.lists(st.integers(0, 2**32 - 1), max_size=100))
def test_packing_round_trip(bits, ids):
    ids = np.array([i % (1 << bits) for i in ids], np.uint32)
    packed = token_files.pack(ids, bits)
    assert len(packed) == -(-len(ids) * bits // 8)
    assert token_files.unpack(packed, len(ids), bits).tolist() == ids.tolist()


@pytest.mark.parametrize("bits", [7, 16, 17])
def test_any_document_of_a_shard(tmp_path, bits):
    rng = np.random.default_rng(bits)
    docs = [rng.integers(0, 1 << bits, n).astype(np.uint32) for n in (0, 5, 1, 300, 0, 64, 33)]
    writer = token_files.ShardWriter(str(tmp_path), bits, block=16)
    for k, ids in enumerate(docs):
        writer.add(None if k == 2 else k, ids)
    writer.close()
    shard = token_files.Shard(str(tmp_path), writer.path)
    for k in (6, 0, 3, 2, 5, 4, 1):
        assert shard.document(k).tolist() == docs[k].tolist()
    assert [d.tolist() for d in shard.documents(many=40)] == [d.tolist() for d in docs]
    assert shard.named.tolist() == [1, 1, 0, 1, 1, 1, 1]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=40))
def test_words_encode_as_the_whole(text):
    encode, _ = token_files.encoder(TOKENIZER)
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(TOKENIZER)
    for form in (text, text.replace("a", " "), f"The End, {text} <|EndOfText|>\n\nİ Σ {text}é"):
        ids = np.frombuffer(encode(form), "<u4").tolist()
        assert ids == whole.encode(form, add_special_tokens=False).ids


def test_token_files(docs_of, monkeypatch):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(TOKENIZER)
    texts = [None, "", "Hello world", "é" * 9000, "x y", "x y", "the end. " * 4000]
    rows = [*enumerate(texts), (None, "no id")]
    got = token_files.write_and_read(docs_of(*reversed(rows)), TOKENIZER).collect()
    at, expected = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 2]
        expected.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert Counter(map(tuple, got)) == Counter(expected)
    assert token_files.write_and_read(docs_of().limit(0), TOKENIZER).count() == 0


# --- WARC --------------------------------------------------------------------


@pytest.mark.parametrize("zip64", [False, True])
def test_packages(tmp_path, zip64):
    writer = warc_archives.PackageWriter(str(tmp_path), zip64)
    payloads = {1: b"<p>\r\n\r\nx", 2: b"", None: "é".encode() * 5000}
    for page, payload in payloads.items():
        writer.add(page, warc_archives.warc_record(page, "http://a/\r\nb", payload, None))
    writer.add(9, warc_archives.warc_record(9, "u", payloads[1], 1))
    writer.close()
    package = warc_archives.Package(str(tmp_path), writer.path)
    for entry in reversed(list(package.index())):
        fields, length, payload = warc_archives.parse_record(package.record(entry))
        if entry["page"] == 9:
            assert (fields["WARC-Type"], length, payload) == ("revisit", len(payloads[1]), b"")
        else:
            assert payload == payloads[entry["page"]] and length == len(payload)
    with zipfile.ZipFile(writer.path) as other:
        assert other.testzip() is None
        assert set(other.namelist()) == {warc_archives.WARC, warc_archives.CDX}


@pytest.mark.parametrize("compressed", [False, True])
def test_packages_of_other_writers(tmp_path, compressed):
    path = tmp_path / "a.zip"
    kind = zipfile.ZIP_DEFLATED if compressed else zipfile.ZIP_STORED
    with zipfile.ZipFile(path, "w", kind) as out:
        out.comment = b"c" * 100
        with out.open(zipfile.ZipInfo("archive/x"), "w", force_zip64=True) as member:
            member.write(b"abc" * 100)
        out.writestr("é", b"z" * 50)
    package = warc_archives.Package(str(tmp_path), str(path))
    assert set(package.members) == {"archive/x", "é"}
    assert b"".join(package.read("archive/x", 7)) == b"abc" * 100
    if compressed:
        with pytest.raises(ValueError):
            package.locate("é")


def test_broken_packages(tmp_path):
    for name, data in (("empty", b""), ("text", b"no archive" * 50)):
        (tmp_path / name).write_bytes(data)
        with pytest.raises(ValueError):
            warc_archives.Package(str(tmp_path), str(tmp_path / name))


@pytest.mark.parametrize("least", [0, 3])
def test_pages(spark, least):
    rows = [(i, "u", "same") for i in (7, 3, 3, 9)] + [(1, None, None), (2, "u", ""), (4, "\n", "é" * 99)]
    rows += [(None, "u", "same"), (None, "u", "alone"), (11, "u", "ab"), (12, "u", "ab")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = warc_archives.write_and_read(pages.selectExpr("*", "1 AS refers_to"), least).collect()
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    expected = []
    for i, _, html in rows:
        data = (html or "").encode()
        lead = first.get(html or "") if len(data) >= least else None
        alone = lead is None or lead == i
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        kind = "response" if alone else "revisit"
        expected.append((i, len(data), digest, kind, None if alone else lead))
    assert Counter(map(tuple, got)) == Counter(expected)
    assert warc_archives.write_and_read(pages.limit(0)).count() == 0


# --- n-gram join --------------------------------------------------------------


def grams_by_hand(text):
    words = words_of(text)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def links_by_hand(rows):
    sets = [grams_by_hand(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    degree = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                degree[i] += 1
                degree[j] += 1
                root[find(i)] = find(j)
    groups: dict[int, list[int]] = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(i)
    return degree, groups


@pytest.fixture
def near_copies():
    rng = random.Random(4)
    rows = [(0, None), (1, ""), (2, "one"), (3, "One!"), (4, "one two three"), (5, "one two three")]
    for base in range(6):
        words = rng.choices(WORDS, k=300)
        for copy in range(25 if base == 0 else 4):
            own = list(words)
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(len(own))] = f"x{rng.randint(0, 99)}"
            rows.append((len(rows), " ".join(own)))
    rows += [(None, rows[10][1]), (10, rows[10][1]), (None, "all alone here now with no id")]
    return rows


@pytest.mark.parametrize("block", [ngram_join.BLOCK, 4])
def test_links(docs_of, monkeypatch, near_copies, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    degree, groups = links_by_hand(near_copies)
    expected = Counter()
    for members in groups.values():
        named = [near_copies[i][0] for i in members if near_copies[i][0] is not None]
        for i in members:
            expected[near_copies[i][0], degree[i], min(named, default=None)] += 1
    rows = ngram_join.links_per_row(docs_of(*near_copies)).collect()
    assert Counter((r.doc_id, r.n_links, r.group_id) for r in rows) == expected


def test_one_of_each_group_stays(docs_of, near_copies):
    docs = docs_of(*near_copies)
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    _, groups = links_by_hand(near_copies)
    expected = Counter(
        min((near_copies[i][0] for i in members if near_copies[i][0] is not None), default=None)
        for members in groups.values()
    )
    assert Counter(r.doc_id for r in kept.collect()) == expected
    assert ngram_join.keep_one(docs.limit(0)).count() == 0


def test_banding_reaches_the_recall():
    bands, rows = ngram_join.banding(0.8, 0.9999, 128)
    assert bands * rows <= 128 and 1 - (1 - 0.8**rows) ** bands >= 0.9999


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
def test_components(spark, edges):
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in components(frame).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    assert got == {x: find(x) for x in root}


def test_a_sieve_lets_no_key_go(spark):
    keys = spark.range(0, 3000, 3).select(F.xxhash64("id").alias("k"))
    rows = spark.range(3000).select("id", F.xxhash64("id").alias("k"))
    sieve = sieve_of(keys, "k")
    inside = {r.id for r in sifted(rows, "k", sieve, True).collect()}
    outside = {r.id for r in sifted(rows, "k", sieve, False).collect()}
    assert set(range(0, 3000, 3)) <= inside and inside | outside == set(range(3000))
    assert not inside & outside and len(inside) < 1100


# --- mixing ------------------------------------------------------------------


def edf_by_hand(counts):
    slots, given, order = sum(counts), [0] * len(counts), []
    for t in range(slots):
        ready = [
            (-(-(g + 1) * slots // c), i)
            for i, (g, c) in enumerate(zip(given, counts))
            if g * slots // c <= t
        ]
        order.append(min(ready)[1])
        given[order[-1]] += 1
    return order


def test_the_schedule_stays_within_a_block(spark):
    weights = spark.createDataFrame([("a", 0.5), ("b", 0.3), ("c", 0.15), ("d", 0.0)], "stream string, weight double")
    rows = {r.stream: r for r in mixing.schedule(weights, 100).collect()}
    names = sorted(rows)
    counts = [rows[n].c for n in names]
    assert sum(counts) == 100 and min(counts) >= 1
    order = edf_by_hand(counts)
    assert {n: rows[n].turns for n in names} == {
        n: [t for t, i in enumerate(order) if names[i] == n] for n in names
    }
    for n, c in zip(names, counts):
        for t in range(101):
            given = sum(turn < t for turn in rows[n].turns)
            assert abs(given - t * c / 100) < 1


def test_mix(spark, docs_of):
    rng = random.Random(1)
    rows = [(i, "x" * rng.randint(0, 40), "ab"[i % 3 == 0]) for i in range(300)]
    rows += [(300, None, None), (301, "y" * 5000, None), (None, "z", "a"), (5, rows[5][1], "a")]
    docs = docs_of(*rows)
    got = mixing.mix(docs, block=100, slots=50).collect()
    assert Counter((r.doc_id, r.source) for r in got) == Counter((r[0], r[2]) for r in rows)
    assert all(r.release_slot <= r.slot < r.deadline_slot for r in got)
    by_slot = {}
    for r in got:
        assert by_slot.setdefault(r.slot, (r.source, r.block)) == (r.source, r.block)
    kept = mixing.keep_mix(docs)
    assert kept.columns == docs.columns
    assert mixing.keep_mix(docs.limit(0)).count() == 0


def test_the_mix_cuts_what_is_over_its_target(spark, docs_of):
    rows = [(i, "x" * 50, "big" if i % 4 else "small") for i in range(800)]
    targets = spark.createDataFrame([("big", 0.5), ("small", 0.5)], "source string, weight double")
    got = mixing.mix(docs_of(*rows), targets, block=100, slots=10).collect()
    assert all(r.in_mix for r in got if r.source == "small")
    share = sum(r.in_mix for r in got if r.source == "big") / sum(r.in_mix for r in got)
    assert abs(share - 0.5) < 0.02


def test_every_source_has_its_own_weight(spark, docs_of):
    docs = docs_of(*[(i, "x" * 100, f"s{i % 400}") for i in range(800)])
    got = mixing.mix(docs, block=100, slots=50).collect()
    assert all(r.in_mix for r in got)
    assert len({r.slot for r in got}) == 800
    assert all(r.release_slot <= r.slot < r.deadline_slot for r in got)
    first = {r.source for r in got if r.slot < 400}
    assert len(first) > 300
    targets = spark.createDataFrame([("s7", 1.0), ("s8", 3.0)], "source string, weight double")
    rows = [(i, "x" * 100, f"s{i % 400}") for i in range(4000)]
    rows += [(i, "x" * 100, "s8") for i in range(4000, 4050)]
    got = mixing.mix(docs_of(*rows), targets, block=100, slots=50).collect()
    mixed = Counter(r.source for r in got if r.in_mix)
    assert mixed == {"s7": 10, "s8": 30}


def test_the_schedule_keeps_to_the_given_targets(spark, docs_of):
    names = [f"s{i}" for i in range(60)]
    given_weights = {n: 0.75 / 59 for n in names} | {"s0": 0.25}
    counts = {n: 50 for n in names} | {"s0": 1000}
    rows = [(i, "x" * 10, n) for n in names for i in range(counts[n])]
    targets = spark.createDataFrame(list(given_weights.items()), "source string, weight double")
    got = mixing.mix(docs_of(*rows), targets, block=10, slots=100).collect()
    slots = {n: sorted(r.slot for r in got if r.source == n) for n in names}
    until = min(50 / w for n, w in given_weights.items() if n != "s0") - 100
    for n, w in given_weights.items():
        for t in range(0, int(until), 7):
            given = sum(slot < t for slot in slots[n])
            assert abs(given - t * w) < 4, (n, t)
    assert abs(sum(slot < 3000 for slot in slots["s0"]) - 750) < 2


# --- toxicity ----------------------------------------------------------------


def test_toxicity_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    scored = toxicity.score(docs, toxicity.train(docs, labels)).join(labels, "doc_id")
    rows = scored.where("held_out").select("score", "predicted", "toxic").collect()
    score = np.array([r.score for r in rows])
    toxic = np.array([r.toxic for r in rows])
    rank = np.argsort(np.argsort(score))
    n = toxic.sum()
    auc = (rank[toxic == 1].sum() - n * (n - 1) / 2) / (n * (len(rows) - n))
    assert auc > 0.9


def test_a_repeated_id_is_one_training_row(spark, docs_of):
    docs = docs_of((2, "b"), (2, "a"), (3, "c"), (2, None))
    labels = spark.createDataFrame([(2, 1), (2, 1), (3, 0)], "doc_id long, toxic int")
    ids = [r.doc_id for r in toxicity._sample(docs, labels).collect()]
    assert sorted(ids) == [i for i in (2, 3) if zlib.crc32(str(i).encode()) % 5]


def test_dictionaries_hold_what_sets_their_class_apart(spark, docs_of):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5]
    names = [f"w{i * 7919 % 1009:04d}x" for i in range(60)]
    texts = {
        i: " ".join([*(names[(i * k) % 60] for k in range(1, 40)), *(["blighter"] * (i % 4 == 0))])
        for i in ids
    }
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in ids], "doc_id long, toxic int")
    docs = docs_of(*texts.items())
    model = toxicity.train(docs, labels)
    assert b"blight" in model.dictionaries.toxic
    assert b"blight" not in model.dictionaries.ordinary
    assert len(model.dictionaries.toxic) == len(model.dictionaries.ordinary)
    rows = toxicity.score(docs, model).collect()
    assert all(r.predicted == (r.doc_id % 4 == 0) for r in rows)


def test_an_id_with_both_labels_is_toxic_and_copies_train_once(spark, docs_of):
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5][:4]
    docs = docs_of(*zip(ids, ["a", "b", "b", None]))
    labels = spark.createDataFrame(
        [(ids[0], 1), (ids[0], 0), (ids[1], 0), (ids[2], 0), (ids[3], 0)], "doc_id long, toxic int"
    )
    rows = toxicity._sample(docs, labels).collect()
    assert sorted((r.text, r.doc_id, r.toxic) for r in rows) == [
        ("", ids[3], 0), ("a", ids[0], 1), ("b", ids[1], 0)
    ]


def test_toxicity_of_odd_rows(spark, docs_of):
    docs = docs_of((1, None), (2, ""), (None, "you idiot"), (2, ""), (3, "é " * 30000))
    none = spark.createDataFrame([], "doc_id long, toxic int")
    rows = toxicity.score(docs, toxicity.train(docs, none)).collect()
    assert len(rows) == 5 and all(0 <= r.score < 0.5 and r.predicted == 0 for r in rows)
    assert {r.doc_id: r.held_out for r in rows}[1] == (zlib.crc32(b"1") % 5 == 0)
    assert {r.doc_id: r.held_out for r in rows}[None] is False
    few = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, toxic int")
    assert toxicity.score(docs.limit(0), toxicity.train(docs, few)).count() == 0
