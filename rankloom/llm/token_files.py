"""Token ids in bit-packed files.

Documents are sorted by id over the cluster, encoded, and written as shards. Each
id takes the fewest bits that the vocabulary needs. A shard is

    magic, bits, ids a block, documents, ids           (header, little-endian)
    blocks of packed ids, each starting on a byte
    for each block its byte offset                     (unsigned 64 bits)
    for each document the number of its first id       (unsigned 64 bits, one more at the end)
    for each document its id, then a byte that says if it has one
    header again, byte offsets of the three tables     (trailer)

so that any document is read by seeking to its blocks, which numpy unpacks whole.
A shard closes after `SHARD_IDS` ids or `SHARD_DOCS` documents, whatever its partition
holds, and blocks are written as they fill, so memory is bounded by one batch of
texts and the tables of one shard.

The tokenizer encodes each distinct run of non-blank characters once; the words'
ids are kept in a table of bounded size, from one task of a worker to the next. It must be one that puts no token across
a blank and none for a blank, which `encoder` tests.

Defined results: null texts are empty and hold the end id only; rows without id
come first; equal ids are ordered by text. Extra columns are not looked at.
"""

from __future__ import annotations

import re
import string
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rankloom.llm.columns import whole
from rankloom.llm.files import new_file, store_of
from rankloom.llm.process import kept
from rankloom.staging import fresh_folder, stage

END_ID = 2
BLOCK_IDS = 1 << 12
SHARD_IDS = 1 << 25
SHARD_DOCS = 1 << 20
WORDS_KEPT = 1 << 20

_HEAD, _TAIL = "<4sHHIQQ", "<QQQ"
_HEAD_SIZE, _TAIL_SIZE = struct.calcsize(_HEAD), struct.calcsize(_TAIL)
_MAGIC = b"RLTK"
_BLANKS = re.compile(rb"[ \t\n\r]+")


def bits_for(size: int) -> int:
    """Bits that hold every id of a vocabulary of this size."""
    return max(1, (size - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids as one run of bits, the lowest first."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    raw = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    planes = np.unpackbits(raw, axis=1, bitorder="little")[:, :bits]
    return np.packbits(planes.ravel(), bitorder="little").tobytes()


def unpack(packed: bytes, count: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(packed, f"<u{bits // 8}", count).astype(np.uint32)
    planes = np.unpackbits(np.frombuffer(packed, np.uint8), bitorder="little")
    full = np.zeros((count, 32), np.uint8)
    full[:, :bits] = planes[: count * bits].reshape(count, bits)
    return np.packbits(full, axis=1, bitorder="little").view("<u4").ravel()


def encoder(path: str, words_kept: int = WORDS_KEPT) -> tuple[Callable[[str], bytes], int]:
    """A function from text to ids as 32-bit bytes, and the size of the vocabulary."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)

    def ids_of(text: str) -> list[int]:
        return tokenizer.encode(text, add_special_tokens=False).ids

    by_word = ids_of("a") + ids_of("b") == ids_of("a \n\t\r b")
    letters = string.ascii_letters
    lowers = ids_of(letters) == ids_of(letters.lower())
    special = [token.content for token in tokenizer.get_added_tokens_decoder().values()]
    known: dict[bytes, bytes] = {}

    def learn(new: list[bytes]) -> None:
        """Encode words as one text and part the ids by the words they begin in."""
        words = [word.decode() for word in new]
        found = tokenizer.encode(" ".join(words), add_special_tokens=False)
        ends = np.cumsum([len(w) + 1 for w in words])
        ids = np.array(found.ids, "<u4")
        at = np.array([start for start, _ in found.offsets], np.int64)
        cuts = [0, *np.searchsorted(at, ends).tolist()]
        packed = ids.tobytes()
        for k, word in enumerate(new):
            known[word] = packed[4 * cuts[k] : 4 * cuts[k + 1]]

    def encode(text: str) -> bytes:
        if not by_word:
            return np.array(ids_of(text), "<u4").tobytes()
        if lowers and text.isascii():
            lower = text.lower()
            if not any(token in lower for token in special):
                text = lower
        data = text.encode()
        # `split` parts at two control characters more.
        words = _BLANKS.split(data) if b"\v" in data or b"\f" in data else data.split()
        new = list(set(words).difference(known))
        if len(known) + len(new) > words_kept:
            known.clear()
            new = list(set(words))
        if new:
            learn(new)
        return b"".join(map(known.__getitem__, words))

    return encode, tokenizer.get_vocab_size(with_added_tokens=True)


class ShardWriter:
    """One shard file, written as ids arrive."""

    def __init__(self, folder: str, bits: int, block: int = BLOCK_IDS) -> None:
        store, self.path = new_file(folder, "shard.tok")
        self.out = store.open_output_stream(self.path)
        self.bits, self.block = bits, block
        self.out.write(struct.pack(_HEAD, _MAGIC, bits, 0, block, 0, 0))
        self.at = _HEAD_SIZE
        self.names: list[int | None] = []
        self.offsets: list[int] = []
        self.firsts = [0]
        self.waiting: list[np.ndarray] = []
        self.held = 0

    @property
    def ids(self) -> int:
        return self.firsts[-1]

    def add(self, name: int | None, ids: np.ndarray) -> None:
        self.names.append(name)
        self.firsts.append(self.ids + len(ids))
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= 16 * self.block:
            self._flush(self.held - self.held % self.block)

    def _flush(self, count: int) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        for start in range(0, count, self.block):
            packed = pack(ids[start : min(count, start + self.block)], self.bits)
            self.offsets.append(self.at)
            self.out.write(packed)
            self.at += len(packed)
        self.waiting, self.held = [ids[count:]], len(ids) - count

    def close(self) -> None:
        self._flush(self.held)
        firsts = self.at + 8 * len(self.offsets)
        tables = self.at, firsts, firsts + 8 * len(self.firsts)
        self.out.write(np.array(self.offsets, "<u8").tobytes())
        self.out.write(np.array(self.firsts, "<u8").tobytes())
        self.out.write(np.array([n or 0 for n in self.names], "<i8").tobytes())
        self.out.write(bytes(n is not None for n in self.names))
        head = struct.pack(_HEAD, _MAGIC, self.bits, 0, self.block, len(self.names), self.ids)
        self.out.write(head + struct.pack(_TAIL, *tables))
        self.out.close()


class Shard:
    """Random access to the documents of a shard file."""

    def __init__(self, folder: str, path: str) -> None:
        self.file = store_of(folder).open_input_file(path)
        end = _HEAD_SIZE + _TAIL_SIZE
        tail = self.file.read_at(end, self.file.size() - end)
        magic, self.bits, _, self.block, self.docs, self.ids = struct.unpack(_HEAD, tail[:_HEAD_SIZE])
        if magic != _MAGIC:
            raise ValueError(f"no token shard: {path}")
        blocks, firsts, names = struct.unpack(_TAIL, tail[_HEAD_SIZE:])
        self.end = blocks
        self.offsets = np.frombuffer(self.file.read_at(firsts - blocks, blocks), "<u8")
        self.firsts = np.frombuffer(self.file.read_at(8 * (self.docs + 1), firsts), "<u8")
        self.names = np.frombuffer(self.file.read_at(8 * self.docs, names), "<i8")
        self.named = np.frombuffer(self.file.read_at(self.docs, names + 8 * self.docs), np.uint8)

    def span(self, first: int, last: int) -> np.ndarray:
        """Ids number `first` up to `last`, exclusive."""
        if first >= last:
            return np.zeros(0, np.uint32)
        low, high = first // self.block, (last - 1) // self.block + 1
        start = int(self.offsets[low])
        stop = int(self.offsets[high]) if high < len(self.offsets) else self.end
        packed = self.file.read_at(stop - start, start)
        # Whole blocks fill whole bytes if a block's bits do: see BLOCK_IDS.
        count = min(high * self.block, self.ids) - low * self.block
        return unpack(packed, count, self.bits)[first - low * self.block : last - low * self.block]

    def document(self, k: int) -> np.ndarray:
        return self.span(int(self.firsts[k]), int(self.firsts[k + 1]))

    def documents(self, many: int = 1 << 20) -> Iterator[np.ndarray]:
        """All documents in order, about `many` ids read at a time."""
        k = 0
        while k < self.docs:
            limit = int(self.firsts[k]) + many
            stop = max(k + 1, int(np.searchsorted(self.firsts, limit, "right")) - 1)
            base = int(self.firsts[k])
            ids = self.span(base, int(self.firsts[stop]))
            for i in range(k, stop):
                yield ids[int(self.firsts[i]) - base : int(self.firsts[i + 1]) - base]
            k = stop


_SHARDS = "part int, nr int, path string, ids long"
_READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def write(
    docs: DataFrame,
    tokenizer: str,
    folder: str,
    end_id: int = END_ID,
    words_kept: int = WORDS_KEPT,
) -> DataFrame:
    """Write all texts; per shard its place in the order, its path and its number of ids.

    A worker keeps the ids of up to `words_kept` words, some 250 bytes each, for speed alone.
    """
    ordered = (
        docs.select("doc_id", whole().alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
        .withColumn("part", F.spark_partition_id())
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_ids, size = kept(
            ("encoder", tokenizer, words_kept), lambda: encoder(tokenizer, words_kept)
        )
        bits = bits_for(max(size, end_id + 1))
        tail = np.array([end_id], "<u4").tobytes()
        writer, nr, part = None, 0, 0

        def closed() -> pa.RecordBatch:
            writer.close()
            row = [[part], [nr], [writer.path], [writer.ids]]
            kinds = pa.int32(), pa.int32(), pa.string(), pa.int64()
            columns = [pa.array(v, kind) for v, kind in zip(row, kinds)]
            return pa.RecordBatch.from_arrays(columns, names=["part", "nr", "path", "ids"])

        for batch in batches:
            for doc_id, text, own in zip(*batch.columns):
                if writer is None:
                    writer, part = ShardWriter(folder, bits), own.as_py()
                ids = np.frombuffer(to_ids(text.as_py()) + tail, "<u4")
                writer.add(doc_id.as_py(), ids)
                if writer.ids >= SHARD_IDS or len(writer.names) >= SHARD_DOCS:
                    yield closed()
                    writer, nr = None, nr + 1
        if writer is not None:
            yield closed()

    return stage(ordered.mapInArrow(encode, _SHARDS), "token-shards")


def read(shards: DataFrame, folder: str) -> DataFrame:
    """Per document of the shards its id, the ids before it, its count and checksum."""
    # One row a shard of some 30 million ids, so the window over all of them stays small.
    upto = W.orderBy("part", "nr").rowsBetween(W.unboundedPreceding, W.currentRow)
    before = F.sum("ids").over(upto) - F.col("ids")
    placed = shards.select("path", before.alias("before"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                shard, rows = Shard(folder, path), []
                for k, ids in enumerate(shard.documents()):
                    name = int(shard.names[k]) if shard.named[k] else None
                    start = before + int(shard.firsts[k])
                    rows.append((name, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    if len(rows) == 10_000:
                        yield _columns(rows)
                        rows = []
                if rows:
                    yield _columns(rows)

    cores = placed.sparkSession.sparkContext.defaultParallelism
    return placed.repartition(max(1, 4 * cores), "path").mapInArrow(decode, _READ)


def _columns(rows: list[tuple[int | None, int, int, int]]) -> pa.RecordBatch:
    columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
    return pa.RecordBatch.from_arrays(
        columns, names=["doc_id", "start", "n_tokens", "ids_crc32"]
    )


def write_and_read(docs: DataFrame, tokenizer: str, words_kept: int = WORDS_KEPT) -> DataFrame:
    folder = fresh_folder(docs.sparkSession, "tokens")
    return read(write(docs, tokenizer, folder, words_kept=words_kept), folder)
