"""Removal of long repeats, by a sparse suffix array over the cluster.

A string of `LENGTH` bytes that starts at two places of the corpus is removed wherever it
stands. Not every suffix is sorted: each string has an anchor, the place of its least
hash of `GRAM` bytes, and equal strings have it at the same distance. So the strings of
one anchor are one row, the text around it, and only rows whose gram stands
elsewhere too (counted first, let through by a bitmap) are sorted at all.

Rows are range-partitioned by the leading bytes of the anchor's suffix, at splitters that
Spark samples. A gram of more than `HOT_ROWS` rows may fill several buckets. A bucket
sorts the suffixes from the anchors on, and the texts before them backwards, by multikey
quicksort, eight bytes a key. For each distance, two strings are equal if their
suffixes agree as far as they reach to the right and their prefixes to the left,
which the sorted neighbours' common lengths say. Last, buckets are compared across their
boundaries: of a gram that may be parted, strings of a bucket's first and last anchor
meet by their digests, each distinct one once a bucket.

Defined results: null texts are empty; shorter texts than `LENGTH` bytes are kept whole.
Repeated rows are copies of each other, so long ones lose all. Rows without id are
treated as others. Bytes are cut where the strings end, so that what is left may begin
inside a character and is binary. Extra columns are not looked at. Very long texts are
taken in overlapping pieces. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm.sieve import hits, sieve_of
from rankloom.staging import stage

# Bytes of a repeat, of the gram that anchors it, and of the suffix that picks the bucket.
LENGTH = 400
GRAM = 160
LEAD = 64
# Texts are hashed together up to this many bytes; a longer one in pieces of as many.
PIECE = 1 << 18
# Rows of this many bytes are looked through for equal ones before they leave a task.
HELD_BYTES = 1 << 22
# A gram of more rows is parted among buckets.
HOT_ROWS = 1 << 12
# Rows that a bucket sorts together, or all of one anchor if they are more.
SORT_ROWS = 1 << 13

_REACH = LENGTH - GRAM
_BASE = 0x9E3779B97F4A7C15
_BLOCKS = (
    "lead binary, block binary, before int, low int, digest binary, begin long, known boolean,"
    " hot boolean"
)
_FOUND = "digest binary, begin long, end long, window binary"


def _byte_values() -> np.ndarray:
    """A 64-bit number for each byte, from the bytes' own digests."""
    digests = [hashlib.sha256(bytes([b])).digest()[:8] for b in range(256)]
    return np.frombuffer(b"".join(digests), "<u8")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class GramHashes:
    """Hashes of the `GRAM` bytes from each place on, in 64-bit arithmetic."""

    def __init__(self) -> None:
        self.values = _byte_values()
        self.powers = self.back = np.zeros(0, np.uint64)

    def __call__(self, data: np.ndarray) -> np.ndarray:
        n = len(data)
        if n > len(self.powers):
            self.powers = self._powers(_BASE, n)
            self.back = self._powers(pow(_BASE, -1, 1 << 64), n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.values[data] * self.powers[:n], dtype=np.uint64, out=sums[1:])
        return _mixed((sums[GRAM:] - sums[:-GRAM]) * self.back[: n - GRAM + 1])

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        factors = np.full(n, base, np.uint64)
        factors[0] = 1
        return np.cumprod(factors, dtype=np.uint64)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each run of `width` values: a suffix and a prefix of two fixed blocks."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


class Runs(NamedTuple):
    """Strings of one anchor: places of the first and last, of the anchor, and its hash."""

    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray
    gram: np.ndarray


def runs_of(data: np.ndarray, ends: np.ndarray, hashes: GramHashes) -> Runs:
    """All strings of texts that stand one after another and end at `ends`."""
    if len(data) < LENGTH:
        nothing = np.zeros(0, np.int64)
        return Runs(nothing, nothing, nothing, nothing)
    grams = hashes(data)
    places = np.arange(len(grams), dtype=np.uint64)
    least = sliding_least((grams & np.uint64(0xFFFFFFFF00000000)) | places, _REACH + 1)
    anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    start = np.arange(len(anchor))
    # The end of the text that holds each place; strings do not cross it.
    text = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))[: len(anchor)]
    whole = start + LENGTH <= ends[text]
    start, anchor, text = start[whole], anchor[whole], text[whole]
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1) | (text[1:] != text[:-1])
    firsts = np.flatnonzero(new)
    lasts = np.append(firsts[1:], len(start)) - 1 if len(start) else firsts
    at = anchor[firsts]
    return Runs(start[firsts], start[lasts], at, grams[at].view(np.int64))


class Piece(NamedTuple):
    digest: bytes
    offset: int
    data: bytes


def _pieces(text: bytes, digest: bytes) -> Iterator[Piece]:
    """Each string of a text lies in exactly one of its pieces."""
    for offset in range(0, len(text) - LENGTH + 1, PIECE):
        yield Piece(digest, offset, text[offset : offset + PIECE + LENGTH - 1])


def chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[list[Piece]]:
    """Pieces of the texts that are long enough, some at a time; of equal texts of a batch one."""
    for batch in batches:
        seen, held, size = set(), [], 0
        for text in batch.column(0):
            data = text.as_buffer().to_pybytes()
            digest = hashlib.sha256(data).digest()
            if len(data) < LENGTH or digest in seen:
                continue
            seen.add(digest)
            for piece in _pieces(data, digest):
                held.append(piece)
                size += len(piece.data)
                if size >= PIECE:
                    yield held
                    held, size = [], 0
        if held:
            yield held


def _joined(held: list[Piece], hashes: GramHashes) -> tuple[bytes, np.ndarray, Runs]:
    data = b"".join(piece.data for piece in held)
    ends = np.cumsum([len(piece.data) for piece in held])
    return data, ends, runs_of(np.frombuffer(data, np.uint8), ends, hashes)


def _grams(texts: DataFrame) -> DataFrame:
    """Anchors' grams that stand at more than one place, and how often."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = GramHashes()
        for held in chunks(batches):
            grams, times = np.unique(_joined(held, hashes)[2].gram, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(grams), pa.array(times)], names=["gram", "n"])

    counted = texts.mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return counted.where("n > 1")


def _blocks(texts: DataFrame, sieve: Broadcast, hot: Broadcast) -> DataFrame:
    """Rows of anchors whose gram may stand elsewhere; equal rows, as far as held, as one.

    Strings of such equal rows repeat for certain. They are told as found at once (rows
    with `lead` NULL and `before` the end), and the one row that is sorted is `known`.
    """

    def rows_of(equal: dict[tuple, list[tuple[bytes, int]]]) -> pa.RecordBatch:
        rows = []
        for (block, before, is_hot), members in equal.items():
            known = len(members) > 1
            low = before - (len(block) - LENGTH)
            rows.append((block[before : before + LEAD], block, before, low, *members[0], known, is_hot))
            if known:
                rows += [(None, None, len(block), 0, *member, True, False) for member in members]
        return _batch(rows, _BLOCKS)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = GramHashes()
        equal: dict[tuple, list[tuple[bytes, int]]] = {}
        size = 0
        for held in chunks(batches):
            data, ends, runs = _joined(held, hashes)
            chosen = np.flatnonzero(hits(sieve.value, runs.gram))
            piece = np.searchsorted(ends, runs.first[chosen], "right")
            starts = np.insert(ends, 0, 0)
            is_hot = hits(hot.value, runs.gram[chosen])
            for row, k, often in zip(chosen.tolist(), piece.tolist(), is_hot.tolist()):
                first, last = int(runs.first[row]), int(runs.last[row])
                key = data[first : last + LENGTH], int(runs.anchor[row]) - first, often
                place = held[k].offset + first - int(starts[k])
                equal.setdefault(key, []).append((held[k].digest, place))
                size += len(key[0])
            if size >= HELD_BYTES:
                yield rows_of(equal)
                equal, size = {}, 0
        if equal:
            yield rows_of(equal)

    return texts.mapInArrow(cut, _BLOCKS)


_KINDS = {"binary": pa.binary(), "int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_()}


def _batch(rows: list[tuple], shape: str) -> pa.RecordBatch:
    fields = [part.split(" ") for part in shape.split(", ")]
    columns = [pa.array([r[c] for r in rows], _KINDS[kind]) for c, (_, kind) in enumerate(fields)]
    return pa.RecordBatch.from_arrays(columns, names=[name for name, _ in fields])


def multikey_sort(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows of big-endian words, and the bytes each shares with the row before.

    Rows that agree in all words so far are sorted by the next one; those that stand
    alone are done.
    """
    n, depth = words.shape
    order, shared = np.arange(n), np.full(n, 8 * depth)
    group, active = np.zeros(n, np.int64), np.arange(n)
    shared[:1] = 0
    for w in range(depth):
        if len(active) < 2:
            break
        rows, own = order[active], group[active]
        key = words[rows, w]
        sort = np.lexsort((key, own))
        order[active], key = rows[sort], key[sort]
        new = np.ones(len(active), bool)
        new[1:] = (own[1:] != own[:-1]) | (key[1:] != key[:-1])
        parted = np.flatnonzero(new[1:] & (own[1:] == own[:-1])) + 1
        differ = key[parted] ^ key[parted - 1]
        same = sum((differ >> np.uint64(56 - 8 * b) == 0).astype(np.int64) for b in range(8))
        shared[active[parted]] = 8 * w + same
        numbers = np.cumsum(new)
        group[active] = numbers
        active = active[np.bincount(numbers)[numbers] > 1]
    return order, shared


def _words(strings: list[bytes], size: int) -> np.ndarray:
    padded = b"".join(s.ljust(size, b"\0") for s in strings)
    return np.frombuffer(padded, ">u8").reshape(len(strings), -1).astype(np.uint64)


class Resolved(NamedTuple):
    """For each row and distance: if it has that string, if others have it, if it is the first."""

    has: np.ndarray
    repeated: np.ndarray
    first: np.ndarray


def resolve(blocks: list[bytes], before: np.ndarray, low: np.ndarray, known: np.ndarray) -> Resolved:
    """Which strings of the rows are equal. A string at distance d begins d bytes before the anchor.

    A row has the distances from `low` to `before`. The strings of `known` rows count twice.
    """
    n = len(blocks)
    right = [block[b:] for block, b in zip(blocks, before.tolist())]
    left = [block[:b][::-1] for block, b in zip(blocks, before.tolist())]
    after, after_shared = multikey_sort(_words(right, LENGTH))
    place = np.empty(n, np.int64)
    place[after] = np.cumsum(after_shared < GRAM)
    ahead = np.hstack([place[:, None].astype(np.uint64), _words(left, -(-_REACH // 8) * 8)])
    back, back_shared = multikey_sort(ahead)
    has, repeated, first = (np.zeros((n, _REACH + 1), bool) for _ in range(3))
    left_class, right_class = np.empty(n, np.int64), np.empty(n, np.int64)
    for d in range(_REACH + 1):
        own = np.flatnonzero((low <= d) & (d <= before))
        if not len(own):
            continue
        right_class[after] = np.cumsum(after_shared < LENGTH - d)
        left_class[back] = np.cumsum(back_shared < 8 + d)
        both = (right_class[own] << 32) | left_class[own]
        _, index, inverse = np.unique(both, return_index=True, return_inverse=True)
        times = np.bincount(inverse, weights=1 + known[own])
        has[own, d], repeated[own, d] = True, times[inverse] > 1
        first[own[index], d] = True
    return Resolved(has, repeated, first)


def _spans(digests: list[bytes], anchor: np.ndarray, flags: np.ndarray) -> list[tuple]:
    """Bytes under neighbouring strings that repeat, row by row."""
    edges = np.diff(np.pad(flags, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    rows, first = np.nonzero(edges == 1)
    _, last = np.nonzero(edges == -1)
    begins, ends = anchor[rows] - (last - 1), anchor[rows] - first + LENGTH
    return [
        (digests[r], b, e, None) for r, b, e in zip(rows.tolist(), begins.tolist(), ends.tolist())
    ]


def _sort_buckets(blocks: DataFrame) -> DataFrame:
    """Spans under strings that repeat inside a bucket, and windows to meet across buckets.

    Only grams that may be parted have such windows, one for each distinct string. A
    window has its digest and, unless it repeats inside its bucket, its place.
    """

    def told(table: pa.Table, edges: set[bytes]) -> Iterator[pa.RecordBatch]:
        leads = table.column("lead").to_pylist()
        texts = table.column("block").to_pylist()
        digests = table.column("digest").to_pylist()
        before, low, begin = (
            table.column(c).to_numpy().astype(np.int64) for c in ("before", "low", "begin")
        )
        known = table.column("known").to_numpy(zero_copy_only=False)
        found = resolve(texts, before, low, known)
        out = _spans(digests, begin + before, found.repeated)
        parted = table.column("hot").to_numpy(zero_copy_only=False)
        edge = np.array([lead in edges for lead in leads]) & parted
        rows, distances = np.nonzero(found.has & found.first & edge[:, None])
        for row, d in zip(rows.tolist(), distances.tolist()):
            at = int(before[row]) - d
            window = xxhash.xxh3_128_digest(texts[row][at : at + LENGTH])
            place = digests[row], int(begin[row]) + at
            out.append((*((None, None) if found.repeated[row, d] else place), None, window))
            if len(out) > 1 << 14:
                yield _batch(out, _FOUND)
                out = []
        if out:
            yield _batch(out, _FOUND)

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, first = None, None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            if first is None and held.num_rows:
                first = held.column("lead")[0].as_py()
            while held.num_rows >= 2 * SORT_ROWS:
                # Up to the last anchor begun, whose other rows may be in the next batch.
                leads = held.column("lead")
                cut = _start_of(leads, SORT_ROWS)
                if cut == 0:
                    break
                yield from told(held.slice(0, cut), {first})
                held = held.slice(cut)
        if held is not None and held.num_rows:
            last = held.column("lead")[held.num_rows - 1].as_py()
            yield from told(held, {first, last})

    return blocks.mapInArrow(sort, _FOUND)


def _start_of(leads: pa.ChunkedArray, place: int) -> int:
    """Where the run of equal leads around a place begins; if that is 0, where it ends."""
    values = leads.to_pylist()
    start = place
    while start and values[start - 1] == values[place]:
        start -= 1
    if start:
        return start
    while place < len(values) and values[place] == values[0]:
        place += 1
    return place if place < len(values) else 0


def repeats(docs: DataFrame) -> DataFrame:
    """Spans (`begin`, `end`) of texts, named by their digest, that repeated strings cover."""
    texts = docs.select(F.col("text").cast("binary").alias("text"))
    texts = texts.where(F.octet_length("text") >= LENGTH)
    grams = stage(_grams(texts), "repeat-grams")
    sieve, hot = sieve_of(grams, "gram"), sieve_of(grams.where(F.col("n") > HOT_ROWS), "gram")
    blocks = stage(_blocks(texts, sieve, hot), "repeat-blocks")
    told = blocks.where("lead IS NULL")
    told = told.select("digest", "begin", (F.col("begin") + F.col("before")).alias("end"))
    # The rows of a parted gram differ in the key beyond its lead, those of others do not.
    beyond = F.when(F.col("hot"), F.xxhash64("digest", "begin"))
    buckets = blocks.where("lead IS NOT NULL").repartitionByRange("lead", beyond)
    found = stage(_sort_buckets(buckets.sortWithinPartitions("lead")), "repeat-spans")
    # A window has at most one row a bucket here, however often it stands there.
    meeting = found.where("window IS NOT NULL").groupBy("window").agg(
        F.count("*").alias("n"), F.collect_list(F.struct("digest", "begin")).alias("places")
    )
    met = meeting.where("n > 1").select(F.inline("places")).where("digest IS NOT NULL")
    spans = found.where("window IS NULL").select("digest", "begin", "end")
    spans = spans.unionByName(told)
    return spans.unionByName(met.withColumn("end", F.col("begin") + LENGTH)).distinct()


_SPANS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
_KEPT = "doc_id long, n_bytes long, spans array<struct<begin:long,end:long>>, kept binary"


def cut(docs: DataFrame) -> DataFrame:
    """Per document its bytes, the maximal spans to remove, and what is left (`kept`)."""
    whole = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(F.col("doc_id").cast("long"), whole.alias("_bytes"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("_bytes", 256)))
    size = F.octet_length("_bytes").cast("long")
    copies = (
        rows.where(size >= LENGTH)
        .groupBy("digest")
        .agg(F.count("*").alias("n"), F.max(size).alias("end"))
        .where("n > 1")
        .select("digest", F.lit(0).cast("long").alias("begin"), "end")
    )
    spans = repeats(docs).unionByName(copies).groupBy("digest")
    spans = spans.agg(F.collect_list(F.struct("begin", "end")).alias("spans"))

    def rows_of(out: list[tuple]) -> pa.RecordBatch:
        kinds = pa.int64(), pa.int64(), _SPANS, pa.binary()
        columns = [pa.array([r[c] for r in out], kind) for c, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "spans", "kept"])

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = [], 0
            for doc_id, text, spans in zip(*batch.columns):
                data = text.as_buffer().to_pybytes()
                merged = _merged([(s["begin"], s["end"]) for s in spans.as_py() or []])
                ends = [0, *[e for _, e in merged]]
                begins = [*[b for b, _ in merged], len(data)]
                kept = b"".join(data[e:b] for e, b in zip(ends, begins))
                told = [{"begin": b, "end": e} for b, e in merged]
                out.append((doc_id.as_py(), len(data), told, kept))
                size += len(kept)
                if size >= HELD_BYTES:
                    yield rows_of(out)
                    out, size = [], 0
            if out:
                yield rows_of(out)

    located = rows.join(spans, "digest", "left").select("doc_id", "_bytes", "spans")
    return located.mapInArrow(remove, _KEPT)


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((begin, end))
    return out
