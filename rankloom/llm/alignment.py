"""Alignment of two tokenizers over one corpus, by inverted pair bitmaps.

Both tokenizers split the same bytes. Offsets where tokens of both end cut a text into
groups, and each such offset links the two tokens that end there. A pair of ids is
scored by how often the corpus links it, and documents by the scores of their links.

Documents are dealt into containers of bounded size and numbered inside them. For each
pair and container there are compressed bitmaps of document numbers: multiplicity plane j
holds the documents whose number of links of the pair has bit j set, and the planes
OR-merged are the pair's documents. A bitmap is a sorted list of 16-bit numbers or, from
`DENSE` of them on, a bit set of 8 KiB. A pair's document count is the popcount of the
merged bitmaps, its link count the popcounts of the planes times their places. The pairs'
scores then go back along the postings to the containers, where each document adds up
those of its own links.

Defined results: texts that are null or empty, or whose tokens do not give back the
text's bytes, have no tokens: zeros and an empty digest. Rows without id and repeated rows
are documents of their own. Extra columns are not looked at. Very long texts are encoded
whole. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from typing import Any
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.staging import stage

# A container closes at the first batch of texts that reaches either bound.
CONTAINER_DOCS = 1 << 16
CONTAINER_LINKS = 1 << 21
# Texts are aligned together up to this many characters, or one text.
BATCH_CHARS = 1 << 19
# From here on a bit set takes less room than a list of numbers; it has 4096 16-bit words.
DENSE = _SET = 4096
ROWS_A_BATCH = 1 << 15
# The rank merger is quadratic in a piece; beyond this length of one the other encoder is used.
LONG_PIECE = 2000

_B_BITS = 15
_ROW = (
    "container string, pair long, docs binary, planes array<binary>, row int, doc_id long,"
    " n_a long, n_b long, n_groups long, groups_sha256 string"
)
_SCHEMA = pa.schema(
    [
        ("container", pa.string()),
        ("pair", pa.int64()),
        ("docs", pa.binary()),
        ("planes", pa.list_(pa.binary())),
        ("row", pa.int32()),
        ("doc_id", pa.int64()),
        ("n_a", pa.int64()),
        ("n_b", pa.int64()),
        ("n_groups", pa.int64()),
        ("groups_sha256", pa.string()),
    ]
)
_OWN_NAMES = ["row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256"]
_REPORT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long,"
    " count_sum long, groups_sha256 string"
)
_REPORT_NAMES = [part.split()[0] for part in _REPORT.split(", ")]


class Side:
    """One tokenizer: how it encodes, and the bytes of each of its ids."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], pieces: list[bytes]) -> None:
        self.encode = encode
        self.pieces = pieces
        self.sizes = np.array([len(piece) for piece in pieces], np.int64)

    def encoded(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text, none where their bytes are not those of a blank and the text."""
        found = self.encode(texts)
        for k, text in enumerate(texts):
            if b"".join(map(self.pieces.__getitem__, found[k])) != b" " + text.encode():
                found[k] = []
        return found


def _byte_symbols() -> dict[str, int]:
    """Byte-level vocabularies write each byte as a printable character."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def byte_side(path: str) -> Side:
    """A byte-level BPE file of the tokenizers library, given a blank before each text.

    Where its merges stand in the order of the ids they make, the same merges are done
    by id rank, which is several times faster; a test compares both encoders.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    special = {token["id"] for token in told["added_tokens"]}
    symbols = _byte_symbols()
    vocabulary = {i: token for token, i in told["model"]["vocab"].items()}
    pieces = [
        vocabulary[i].encode() if i in special else bytes(map(symbols.__getitem__, vocabulary[i]))
        for i in range(len(vocabulary))
    ]
    slow = Tokenizer.from_file(path)
    slow.encode_special_tokens = True

    def by_merges(text: str) -> list[int]:
        return slow.encode(" " + text, add_special_tokens=False).ids

    merges = [m if isinstance(m, list) else m.split(" ") for m in told["model"]["merges"]]
    made = [told["model"]["vocab"]["".join(merge)] for merge in merges]
    if made != list(range(256, 256 + len(made))):
        return Side(lambda texts: [by_merges(t) for t in texts], pieces)
    ranks = {pieces[i]: i for i in range(len(pieces)) if i not in special}
    fast = tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    long_piece = re.compile(rf"\S{{{LONG_PIECE}}}|\s{{{LONG_PIECE}}}")

    def encode(texts: list[str]) -> list[list[int]]:
        return [
            by_merges(t)
            if len(t) >= LONG_PIECE and long_piece.search(t)
            else fast.encode_ordinary(" " + t)
            for t in texts
        ]

    return Side(encode, pieces)


def piece_side(path: str) -> Side:
    """A sentencepiece file, which puts the blank before each text itself."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    pieces = [
        bytes([int(name[3:5], 16)])
        if re.fullmatch("<0x[0-9A-F]{2}>", name)
        else name.replace("▁", " ").encode()
        for name in names
    ]
    return Side(lambda texts: model.encode(texts, num_threads=1), pieces)


class Aligned:
    """The alignment of a few texts: one array of ids a side, texts one after another."""

    def __init__(self, side_a: Side, side_b: Side, texts: list[str], written: np.ndarray) -> None:
        a, b = side_a.encoded(texts), side_b.encoded(texts)
        for k in range(len(texts)):
            if not a[k] or not b[k]:
                a[k], b[k] = [], []
        self.n_a = np.array([len(ids) for ids in a], np.int64)
        self.n_b = np.array([len(ids) for ids in b], np.int64)
        ids_a = np.array([i for ids in a for i in ids], np.int64)
        ids_b = np.array([i for ids in b for i in ids], np.int64)
        ends_a, ends_b = np.cumsum(side_a.sizes[ids_a]), np.cumsum(side_b.sizes[ids_b])
        # Sides without tokens of no bytes: each offset ends at most one token of a side.
        place = np.minimum(np.searchsorted(ends_b, ends_a), max(0, len(ends_b) - 1))
        meets = ends_b[place] == ends_a if len(ends_b) else np.zeros(0, bool)
        last_a = np.flatnonzero(meets)
        last_b = place[last_a]
        self.pairs = ids_a[last_a] << _B_BITS | ids_b[last_b]
        self.doc = np.searchsorted(np.cumsum(self.n_a), last_a, "right")
        self.n_groups = np.bincount(self.doc, minlength=len(texts))
        self.digests = self._digests(ids_a, ids_b, last_a, last_b, written)

    def _digests(self, ids_a, ids_b, last_a, last_b, written) -> list[str]:
        """Hash of each text's groups, written out token by token."""
        n_a, n_b = len(ids_a), len(ids_b)
        closes_a, closes_b = np.zeros(n_a, bool), np.zeros(n_b, bool)
        closes_a[last_a], closes_b[last_b] = True, True
        group_a, group_b = np.cumsum(closes_a) - closes_a, np.cumsum(closes_b) - closes_b
        first_b, end_a = np.insert(last_b + 1, 0, 0), last_a + 1
        order = np.empty(n_a + n_b, np.int64)
        order[np.arange(n_a) + first_b[group_a]] = closes_a.astype(np.int64) << 16 | ids_a
        order[np.arange(n_b) + end_a[group_b]] = closes_b.astype(np.int64) << 17 | ids_b
        words = written[order]
        ends = np.cumsum(self.n_a + self.n_b)
        return [
            hashlib.sha256("".join(words[end - size : end])[:-1].encode()).hexdigest() if size else ""
            for end, size in zip(ends.tolist(), (self.n_a + self.n_b).tolist())
        ]


def written_ids() -> np.ndarray:
    """Ids as text with what follows them: `,` and, a bit higher each, `|` and `;`."""
    rows = [[f"{i}{mark}" for i in range(1 << 16)] for mark in ",|;"]
    return np.array(rows[0] + rows[1] + rows[2], object)


def bitmaps_of(keys: np.ndarray, docs: np.ndarray, n: int) -> pa.Array:
    """One compressed bitmap for each key below n; keys and the documents of each ascend."""
    counts = np.bincount(keys, minlength=n)
    room = np.where(counts < DENSE, counts, _SET)
    starts = np.cumsum(room) - room
    out = np.zeros(int(room.sum()), "<u2")
    firsts = np.cumsum(counts) - counts
    sparse = counts[keys] < DENSE
    inside = np.arange(len(keys)) - firsts[keys]
    out[(starts[keys] + inside)[sparse]] = docs[sparse]
    for key in np.flatnonzero(counts >= DENSE).tolist():
        bits = np.zeros(1 << 16, bool)
        bits[docs[firsts[key] : firsts[key] + counts[key]]] = True
        out[starts[key] : starts[key] + _SET] = np.packbits(bits, bitorder="little").view("<u2")
    offsets = np.append(starts, len(out)).astype(np.int32) * np.int32(2)
    parts = [None, pa.py_buffer(offsets), pa.py_buffer(out)]
    return pa.Array.from_buffers(pa.binary(), n, parts)


def _halfwords(bitmaps: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the bitmaps as 16-bit numbers, and where each bitmap ends and begins."""
    _, offsets, data = bitmaps.buffers()
    if not len(bitmaps) or data is None:
        return np.zeros(0, "<u2"), np.zeros(len(bitmaps) + 1, np.int64)
    bounds = np.frombuffer(offsets, np.int32)[bitmaps.offset : bitmaps.offset + len(bitmaps) + 1]
    used = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]].view("<u2")
    return used, (bounds.astype(np.int64) - bounds[0]) // 2


def popcounts(bitmaps: pa.Array) -> np.ndarray:
    words, bounds = _halfwords(bitmaps)
    sizes = np.diff(bounds)
    for k in np.flatnonzero(sizes == _SET).tolist():
        sizes[k] = int(np.bitwise_count(words[bounds[k] : bounds[k + 1]]).sum())
    return sizes


def expanded(bitmaps: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Every document of the bitmaps, with the place of its bitmap."""
    words, bounds = _halfwords(bitmaps)
    sizes = np.diff(bounds)
    places, docs = [], []
    listed = np.repeat(np.arange(len(sizes)), sizes)
    plain = (sizes < _SET)[listed]
    places.append(listed[plain])
    docs.append(words[plain].astype(np.int64))
    for k in np.flatnonzero(sizes == _SET).tolist():
        bits = np.unpackbits(words[bounds[k] : bounds[k + 1]].view(np.uint8), bitorder="little")
        docs.append(np.flatnonzero(bits))
        places.append(np.full(len(docs[-1]), k))
    return np.concatenate(places), np.concatenate(docs)


def postings_of(pairs: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """Of links given as pair and document: the pairs, their documents, and their planes.

    Planes are left out (null) for a pair that no document has twice: they would be its
    documents again.
    """
    entries, times = np.unique(pairs << 16 | docs, return_counts=True)
    keys, row = np.unique(entries >> 16, return_inverse=True)
    docs = entries & 0xFFFF
    most = np.zeros(len(keys), np.int64)
    np.maximum.at(most, row, times)
    n_planes = np.where(most > 1, np.frexp(most.astype(np.float64))[1], 0)
    ends = np.cumsum(n_planes)
    child, number = [], []
    for plane in range(int(n_planes.max(initial=0))):
        chosen = (times >> plane & 1 == 1) & (n_planes[row] > 0)
        child.append((ends - n_planes)[row[chosen]] + plane)
        number.append(docs[chosen])
    if child:
        order = np.argsort(np.concatenate(child), kind="stable")
        child, number = np.concatenate(child)[order], np.concatenate(number)[order]
    planes = bitmaps_of(np.asarray(child, np.int64), np.asarray(number, np.int64), int(n_planes.sum()))
    offsets = pa.array(np.insert(ends, 0, 0).astype(np.int32), mask=np.append(n_planes == 0, False))
    return keys, bitmaps_of(row, docs, len(keys)), pa.ListArray.from_arrays(offsets, planes)


class _Container:
    def __init__(self) -> None:
        self.name = uuid4().hex
        self.docs = self.links = 0
        self.pairs: list[np.ndarray] = []
        self.numbers: list[np.ndarray] = []

    def add(self, ids: list[int | None], found: Aligned) -> pa.RecordBatch:
        """Keep the links; give the documents' own rows."""
        first, n = self.docs, len(ids)
        self.pairs.append(found.pairs)
        self.numbers.append(first + found.doc)
        self.docs, self.links = first + n, self.links + len(found.pairs)
        return _rows(
            self.name,
            n,
            row=np.arange(first, first + n),
            doc_id=ids,
            n_a=found.n_a,
            n_b=found.n_b,
            n_groups=found.n_groups,
            groups_sha256=found.digests,
        )

    def postings(self) -> Iterator[pa.RecordBatch]:
        if self.links:
            keys, docs, planes = postings_of(np.concatenate(self.pairs), np.concatenate(self.numbers))
            for at in range(0, len(keys), ROWS_A_BATCH):
                part = slice(at, at + ROWS_A_BATCH)
                size = len(keys[part])
                yield _rows(self.name, size, pair=keys[part], docs=docs[part], planes=planes[part])


def _rows(container: str, n: int, **given: Any) -> pa.RecordBatch:
    given["container"] = [container] * n
    columns = []
    for field in _SCHEMA:
        values = given.get(field.name)
        if values is None:
            values = pa.nulls(n, field.type)
        columns.append(values if isinstance(values, pa.Array) else pa.array(values, field.type))
    return pa.RecordBatch.from_arrays(columns, schema=_SCHEMA)


def _batches(batch: pa.RecordBatch) -> Iterator[tuple[list[int | None], list[str]]]:
    ids, texts, size = [], [], 0
    for doc_id, text in zip(*batch.columns):
        ids.append(doc_id.as_py())
        texts.append(text.as_py() or "")
        size += len(texts[-1])
        if size >= BATCH_CHARS:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def index(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Written: a posting for each container and pair, and a row without pair for each document."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        side_a, side_b, written = byte_side(path_a), piece_side(path_b), written_ids()
        box = _Container()
        for batch in batches:
            for ids, texts in _batches(batch):
                if box.docs + len(ids) > CONTAINER_DOCS or box.links >= CONTAINER_LINKS:
                    yield from box.postings()
                    box = _Container()
                yield box.add(ids, Aligned(side_a, side_b, texts, written))
        yield from box.postings()

    texts = docs.select(F.col("doc_id").cast("long"), "text")
    return stage(texts.mapInArrow(align, _ROW), "alignment-index")


def pair_scores(indexed: DataFrame) -> DataFrame:
    """Per pair its ids `a` and `b`, its documents, its links, and if no pair of `b` has more."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, docs, planes = batch.columns
            n_docs = popcounts(docs)
            offsets = planes.offsets.to_numpy().astype(np.int64)
            n_planes = np.diff(offsets)
            n_planes[planes.is_null().to_numpy(zero_copy_only=False)] = 0
            plane = np.arange(int(n_planes.sum())) - np.repeat(np.cumsum(n_planes) - n_planes, n_planes)
            n_links = np.where(n_planes == 0, n_docs, 0)
            row = np.repeat(np.arange(len(n_docs)), n_planes)
            np.add.at(n_links, row, popcounts(planes.flatten()) << plane)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_docs, pa.int64()), pa.array(n_links, pa.int64())],
                names=["pair", "n_docs", "n_links"],
            )

    postings = indexed.where("pair IS NOT NULL").select("pair", "docs", "planes")
    counted = postings.mapInArrow(count, "pair long, n_docs long, n_links long")
    counts = counted.groupBy("pair").agg(
        F.sum("n_docs").alias("n_docs"), F.sum("n_links").alias("n_links")
    )
    counts = stage(
        counts.select(
            "pair",
            F.shiftright("pair", _B_BITS).cast("int").alias("a"),
            F.col("pair").bitwiseAND((1 << _B_BITS) - 1).cast("int").alias("b"),
            "n_docs",
            "n_links",
        ),
        "alignment-pairs",
    )
    highest = counts.groupBy("b").agg(F.max("n_links").alias("_highest"))
    scored = counts.join(highest, "b").withColumn("best", F.col("n_links") == F.col("_highest"))
    return scored.select("pair", "a", "b", "n_docs", "n_links", "best")


def _score_container(group: pa.Table) -> pa.Table:
    """The documents of one container with the sums over their links."""
    is_doc = pc.is_null(group.column("pair"))
    own = group.filter(is_doc).sort_by("row")
    postings = group.filter(pc.invert(is_doc)).combine_chunks()
    sums = {name: np.zeros(own.num_rows, np.int64) for name in ("n_links", "n_best", "count_sum")}
    if postings.num_rows:
        docs, planes = (postings.column(c).chunk(0) for c in ("docs", "planes"))
        score = postings.column("score").to_numpy()
        best = postings.column("best").to_numpy().astype(np.int64)
        lone = planes.is_null()
        n_planes = pc.fill_null(pc.list_value_length(planes), 0).to_numpy().astype(np.int64)
        plane = np.arange(int(n_planes.sum())) - np.repeat(np.cumsum(n_planes) - n_planes, n_planes)
        parts = (
            (docs.filter(lone), np.flatnonzero(lone), np.zeros(lone.true_count, np.int64)),
            (planes.flatten(), np.repeat(np.arange(len(n_planes)), n_planes), plane),
        )
        for bitmaps, row, power in parts:
            place, number = expanded(bitmaps)
            links = np.int64(1) << power[place]
            np.add.at(sums["n_links"], number, links)
            np.add.at(sums["n_best"], number, links * best[row[place]])
            np.add.at(sums["count_sum"], number, links * score[row[place]])
    columns = [
        pa.array(sums[name]) if name in sums else own.column(name) for name in _REPORT_NAMES
    ]
    return pa.Table.from_arrays(columns, names=_REPORT_NAMES)


def report(indexed: DataFrame, scores: DataFrame) -> DataFrame:
    """Per document its tokens, groups and links, and what the scores say of its links."""
    postings = indexed.where("pair IS NOT NULL").select("container", "pair", "docs", "planes")
    scores = scores.select("pair", F.col("n_links").alias("score"), "best")
    scored = postings.join(scores, "pair")
    own = indexed.where("pair IS NULL").select("container", *_OWN_NAMES)
    parts = scored.unionByName(own, allowMissingColumns=True)
    return parts.groupBy("container").applyInArrow(_score_container, _REPORT)


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    indexed = index(docs, path_a, path_b)
    return report(indexed, pair_scores(indexed))
