"""Operators over the whole corpus, against brute force: repeats, ranked search, alignment."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rankloom.llm import alignment, lexical_search, suffix_dedup
from rankloom.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
NO_DOCS = [(None, None)]


def prose(rng, words, least, most):
    return " ".join(rng.choices(words, k=rng.randint(least, most)))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# --- repeats -----------------------------------------------------------------


def repeats_by_hand(docs):
    size = suffix_dedup.LENGTH
    texts = [(i, (text or "").encode()) for i, text in docs]
    starts = Counter(t[s : s + size] for _, t in texts for s in range(len(t) - size + 1))
    out = []
    for i, text in texts:
        end, kept, spans, before = 0, bytearray(), 0, False
        for s in range(len(text)):
            if s <= len(text) - size and starts[text[s : s + size]] > 1:
                end = s + size
            spans += s < end and not before
            before = s < end
            if not before:
                kept.append(text[s])
        out.append((i, len(text), len(text) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def cut(docs):
    left = suffix_dedup.cut(docs)
    removed = F.col("n_bytes") - F.octet_length("kept")
    return rows(left.select("doc_id", "n_bytes", removed, F.size("spans"), F.sha2("kept", 256)))


@pytest.fixture
def parted_buckets(spark):
    """Many buckets, so that one anchor fills several of them."""
    given = {
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key) for key in given}
    for key, value in given.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def repeated_docs():
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(2, 8))) for _ in range(300)]
    passage, other, base = (prose(rng, words, n, n) for n in (90, 75, 200))
    docs = [(0, None), (1, ""), (2, "a" * 5000), (3, "ab" * 3000), (4, passage), (5, passage)]
    for k in range(40):
        docs.append((10 + k, " ".join([prose(rng, words, 0, 80), passage, prose(rng, words, 0, 80)])))
        docs.append((100 + k, prose(rng, words, 0, 20) + other[rng.randint(0, 40) :]))
        near = base.split()
        near[rng.randrange(200)] = "zzz"
        docs.append((200 + k, " ".join(near)))
    docs += [(300, (prose(rng, words, 60, 60) + " ") * 5), (300, "x" * 399), (301, "x" * 399)]
    return docs + [(302, "x" * 400), (None, "y" * 400), (303, "z" * 401)]


@pytest.mark.parametrize("parts", [1, 12])
@pytest.mark.parametrize("hot_rows", [suffix_dedup.HOT_ROWS, 3])
def test_repeats(spark, docs_of, monkeypatch, parted_buckets, parts, hot_rows):
    monkeypatch.setattr(suffix_dedup, "HOT_ROWS", hot_rows)
    docs = repeated_docs()
    assert cut(docs_of(*docs).repartition(parts)) == repeats_by_hand(docs)


def test_repeats_of_long_texts_in_pieces(spark, docs_of, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 700)
    monkeypatch.setattr(suffix_dedup, "HELD_BYTES", 5000)
    monkeypatch.setattr(suffix_dedup, "HOT_ROWS", 1)
    monkeypatch.setattr(suffix_dedup, "SORT_ROWS", 8)
    docs = repeated_docs()
    assert cut(docs_of(*docs)) == repeats_by_hand(docs)


def test_repeats_of_the_tables(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert rows(QUERIES["op11_suffix_dedup"](spark, SMALL)) == repeats_by_hand(docs)


def test_no_texts_to_repeat(spark, docs_of):
    assert cut(docs_of(*NO_DOCS).limit(0)) == []
    assert cut(docs_of(*NO_DOCS)) == repeats_by_hand(NO_DOCS)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=24), min_size=1, max_size=30))
def test_multikey_sort(strings):
    words = suffix_dedup._words(strings, 24)
    order, shared = suffix_dedup.multikey_sort(words)
    padded = [strings[i].ljust(24, b"\0") for i in order]
    assert padded == sorted(padded)
    for k in range(1, len(padded)):
        equal = [a == b for a, b in zip(padded[k - 1], padded[k])]
        assert shared[k] == (equal.index(False) if False in equal else 24)


def test_sliding_least():
    rng = np.random.default_rng(1)
    for n, width in ((10, 3), (241, 241), (700, 241)):
        values = rng.integers(0, 50, n).astype(np.uint64)
        windows = np.lib.stride_tricks.sliding_window_view(values, width)
        assert suffix_dedup.sliding_least(values, width).tolist() == windows.min(1).tolist()


# --- ranked search -----------------------------------------------------------


def ranks_by_hand(docs, items, k=10):
    def terms(text):
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)

    texts = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, total = len(texts), sum(sum(c.values()) for _, c in texts)
    df = Counter(term for _, c in texts for term in c)
    out = []
    for item_id, text in set(items):
        scored = []
        for doc_id, counts in texts:
            m = 100 - 90 + 90 * sum(counts.values()) * n_docs // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * (1000000000 * counts[t] // (1000 * counts[t] + 8 * m))
                for t in set(terms(text)) if counts[t]
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id, score))
        for rank, (_, _, doc_id, score) in enumerate(sorted(scored, key=lambda s: s[:3])[:k], 1):
            out.append((item_id, rank, doc_id, score))
    return sorted(out, key=str)


@pytest.mark.parametrize("segment_docs", [lexical_search.SEGMENT_DOCS, 7])
@pytest.mark.parametrize("wave", [lexical_search.WAVE, 1])
def test_ranks(spark, docs_of, monkeypatch, segment_docs, wave):
    monkeypatch.setattr(lexical_search, "SEGMENT_DOCS", segment_docs)
    monkeypatch.setattr(lexical_search, "WAVE", wave)
    monkeypatch.setattr(lexical_search, "BLOCK_ITEMS", 3)
    rng = random.Random(wave)
    words = [f"W{i}" for i in range(12)] + ["É", "x_y", "the"]
    docs = [(i, prose(rng, words, 0, 30)) for i in range(80)]
    docs += [(80, None), (81, ""), (82, "!?"), (5, docs[5][1]), (None, docs[6][1]), (83, "the " * 20_000)]
    items = [(i, prose(rng, words, 0, 8)) for i in range(9)]
    items += [(9, None), (10, ""), (0, items[0][1]), (1, "other the"), (None, "w1 w2"), (11, "absent")]
    asked = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, item int")
    found = lexical_search.search(lexical_search.build(docs_of(*docs)), asked)
    assert rows(found) == ranks_by_hand(docs, items)


def test_nothing_to_rank(spark, docs_of):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    empty = lexical_search.build(docs_of(*NO_DOCS).limit(0))
    assert rows(lexical_search.search(empty, items)) == []
    some = lexical_search.build(docs_of((1, "a b")))
    assert rows(lexical_search.search(some, items.limit(0))) == []
    assert rows(lexical_search.search(some, items)) == ranks_by_hand([(1, "a b")], [(1, "a b")])


def test_few_intervals_are_split():
    """Bounds must spare most documents when a few stand out."""
    rng = np.random.default_rng(2)
    n = 4000
    docs = np.arange(n, dtype=np.int32)
    tfs = np.ones(n, np.int32)
    tfs[rng.choice(n, 20, replace=False)] = 50
    norms = np.full(n, 100)
    postings = lexical_search.Postings([(docs, tfs), (docs[::7], tfs[::7])], norms)
    looked = []
    postings.maxima, plain = lambda s, e: looked.append(s.shape[1]) or plain(s, e), postings.maxima
    best = postings.best(np.array([0, 1]), np.array([900, 500]), 10)
    assert len(best) == 10 and sum(looked) < n / 4


# --- alignment ---------------------------------------------------------------

PATH_A, PATH_B = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def aligned_by_hand(docs):
    a_model = Tokenizer.from_file(PATH_A)
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=PATH_B)
    symbols = alignment._byte_symbols()
    found, counts = [], Counter()
    for doc_id, text in docs:
        whole = (" " + (text or "")).encode()
        a = a_model.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_model.encode(text) if text else []
        a_bytes = [bytes(symbols[c] for c in a_model.id_to_token(i)) for i in a]
        b_bytes = [
            bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()
            for p in map(b_model.id_to_piece, b)
        ]
        if not text or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            found.append((doc_id, [], [], [], []))
            continue
        a_ends = np.cumsum([len(x) for x in a_bytes]).tolist()
        b_ends = dict(zip(np.cumsum([len(x) for x in b_bytes]).tolist(), range(len(b))))
        links = [(x, b[b_ends[e]]) for x, e in zip(a, a_ends) if e in b_ends]
        groups, i, j = [], 0, 0
        for k, end in enumerate(a_ends):
            if end in b_ends:
                groups.append((a[i : k + 1], b[j : b_ends[end] + 1]))
                i, j = k + 1, b_ends[end] + 1
        counts.update(links)
        found.append((doc_id, a, b, groups, links))
    highest = Counter()
    for (_, y), n in counts.items():
        highest[y] = max(highest[y], n)
    out = []
    for doc_id, a, b, groups, links in found:
        text = ";".join("|".join(",".join(map(str, side)) for side in group) for group in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        best = sum(counts[link] == highest[link[1]] for link in links)
        total = sum(counts[link] for link in links)
        out.append((doc_id, len(a), len(b), len(groups), len(links), best, total, digest))
    return sorted(out, key=str), counts, found


TEXTS = [
    "", None, "a", " a", "hello world", "<|endoftext|> <s> </s> <0x41>", "x▁y", "\x00\x01\t\n\n  ", " ",
    "é" * 50 + " ñandú 漢字 🙂" * 5, "the the the cat the", "a" * 9000, "word " * 3000,
]


@pytest.mark.parametrize("links", [alignment.CONTAINER_LINKS, 50])
def test_alignment(spark, docs_of, monkeypatch, links):
    monkeypatch.setattr(alignment, "CONTAINER_LINKS", links)
    monkeypatch.setattr(alignment, "BATCH_CHARS", 200)
    docs = [*enumerate(TEXTS), (None, "the cat"), (3, "the cat"), (3, "the cat")]
    expected, counts, found = aligned_by_hand(docs)
    indexed = alignment.index(docs_of(*docs).repartition(3), PATH_A, PATH_B)
    scores = alignment.pair_scores(indexed)
    assert rows(alignment.report(indexed, scores)) == expected
    in_docs = Counter(pair for *_, own in found for pair in set(own))
    assert {(r.a, r.b): (r.n_docs, r.n_links) for r in scores.collect()} == {
        pair: (in_docs[pair], n) for pair, n in counts.items()
    }


def test_alignment_of_the_tables(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert rows(QUERIES["op13_alignment"](spark, SMALL)) == aligned_by_hand(docs)[0]


def test_common_pairs_take_bit_sets(spark, docs_of):
    docs = [(i, "the the cat" if i % 3 else "the dog") for i in range(5000)]
    indexed = alignment.index(docs_of(*docs).coalesce(1), PATH_A, PATH_B)
    assert indexed.where(F.octet_length("docs") == 8192).count() > 0
    assert rows(alignment.report(indexed, alignment.pair_scores(indexed))) == aligned_by_hand(docs)[0]


def test_nothing_to_align(spark, docs_of):
    assert rows(alignment.align(docs_of(*NO_DOCS).limit(0), PATH_A, PATH_B)) == []
    assert rows(alignment.align(docs_of(*NO_DOCS), PATH_A, PATH_B)) == aligned_by_hand(NO_DOCS)[0]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 9999)), max_size=60), st.booleans())
def test_bitmaps_round_trip(entries, many):
    found = sorted({(0, d) for d in range(5000)} | set(entries) if many else set(entries))
    keys, docs = (np.array([e[c] for e in found], np.int64) for c in (0, 1))
    bitmaps = alignment.bitmaps_of(keys, docs, 6)
    place, number = alignment.expanded(bitmaps)
    assert sorted(zip(place.tolist(), number.tolist())) == found
    assert alignment.popcounts(bitmaps).tolist() == np.bincount(keys, minlength=6).tolist()


def test_every_id_encodes_itself():
    """The rank merger takes a piece that is a token whole, and so must the file's merges."""
    tokenizer = Tokenizer.from_file(PATH_A)
    pieces = alignment.byte_side(PATH_A).pieces
    texts = {}
    for i, piece in enumerate(pieces[:-1]):
        try:
            texts[i] = piece.decode()
        except UnicodeDecodeError:
            continue
    found = tokenizer.encode_batch(list(texts.values()), add_special_tokens=False)
    assert [e.ids for e in found] == [[i] for i in texts]
