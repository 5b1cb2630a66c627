"""N-gram Jaccard join: MinHash banding, then full n-gram sets.

Texts with the same set of n-grams (five words, lower-cased) form a class, and only
classes are joined. Their signatures are cut into bands; classes that share a band
meet in a bucket. A pair is looked at in the first band it shares and nowhere else.
A bucket of any size is dealt into blocks of about `BLOCK` classes, and each pair of
blocks is a unit of work of bounded size, which finds its pairs, compares their whole
sets and gives, for each class, how much it is linked to, and enough links to
connect what is linked. Pairs themselves are never written out.

Bands and rows follow from the recall wanted at the threshold. What banding
proposes is verified on the full sets, so there are no false links; a link just at
the threshold is missed with a chance of `1 - RECALL` at most.

Defined results: a text without words has no n-grams, no links, and is a class and a
group of its own; one of fewer words than an n-gram has the one of all its words.
Ids may be null or repeat: rows are told apart by id and text. A class is named by
its smallest id. N-grams are 64-bit hashes; two that differ are taken for equal with a
chance of 2^-64.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm.columns import whole
from rankloom.llm.components import components
from rankloom.llm.sieve import hits, sieve_of, sifted
from rankloom.llm.words import words_of
from rankloom.staging import stage

WORDS = 5
THRESHOLD = Fraction(4, 5)
RECALL = 0.9999
HASHES = 128
BLOCK = 128
WORDS_KEPT = 1 << 16


class Banding(NamedTuple):
    bands: int
    rows: int


def banding(
    threshold: float = float(THRESHOLD), recall: float = RECALL, hashes: int = HASHES
) -> Banding:
    """The longest rows, thus the fewest candidates, that reach `recall` at `threshold`."""
    for rows in range(hashes, 0, -1):
        for bands in range(1, hashes // rows + 1):
            if 1 - (1 - threshold**rows) ** bands >= recall:
                return Banding(bands, rows)
    raise ValueError("more hashes are needed for this recall")


_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ngram_hasher(n: int = WORDS) -> Callable[[str | None], np.ndarray]:
    """A function from text to the sorted set of its n-grams' hashes."""
    known: dict[bytes, int] = {}

    def hashes(text: str | None) -> np.ndarray:
        words = words_of(text)
        if not words:
            return np.zeros(0, np.uint64)
        if len(known) > WORDS_KEPT:
            known.clear()
        for word in set(words):
            if word not in known:
                known[word] = xxhash.xxh64_intdigest(word)
        codes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        count = max(1, len(codes) - n + 1)
        grams = np.zeros(count, np.uint64)
        for i in range(min(n, len(codes))):
            grams = grams * _ODD + codes[i : i + count]
        return np.unique(_mixed(grams))

    return hashes


def signer(shape: Banding) -> Callable[[np.ndarray], np.ndarray]:
    """A function from a set of hashes to one hash a band of its MinHash signature."""
    factors = np.random.default_rng(2).integers(0, 1 << 63, shape.bands * shape.rows, np.uint64)
    factors = factors * np.uint64(2) + np.uint64(1)

    def sign(grams: np.ndarray) -> np.ndarray:
        least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(grams), 4096):
            part = grams[at : at + 4096]
            least = np.minimum(least, (factors[:, None] * part[None, :]).min(axis=1))
        rows = least.reshape(shape.bands, shape.rows)
        band = np.zeros(shape.bands, np.uint64)
        for i in range(shape.rows):
            band = _mixed(band * _ODD + rows[:, i])
        return band.view(np.int64)

    return sign


def _keyed(docs: DataFrame) -> DataFrame:
    """`id`, `text`, and `k`, which tells rows apart by both."""
    return docs.select(
        F.col("doc_id").alias("id"),
        whole().alias("text"),
        F.xxhash64("doc_id", "text").alias("k"),
    )


def _signed(rows: DataFrame, shape: Banding) -> DataFrame:
    """Per row its id and key, the digest of its n-gram set (null for none), and its bands."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, bands_of = ngram_hasher(), signer(shape)
        for batch in batches:
            digests, bands = [], []
            for text in batch.column(1):
                grams = hashes(text.as_py())
                if len(grams):
                    digests.append(hashlib.blake2b(grams.tobytes(), digest_size=16).digest())
                    bands.append(bands_of(grams))
                else:
                    digests.append(None)
                    bands.append(np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(digests, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                names=["id", "k", "digest", "bands"],
            )

    return rows.mapInArrow(sign, "id long, k long, digest binary, bands array<bigint>")


# Rows of a batch that are Python objects at a time.
_ROWS_AT_ONCE = 256


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[dict]]:
    """Rows of sorted batches by equal values of the first `keys` columns."""
    held: list[dict] = []
    at: tuple | None = None
    for batch in batches:
        names = batch.schema.names[:keys]
        parts = (batch.slice(at, _ROWS_AT_ONCE) for at in range(0, len(batch), _ROWS_AT_ONCE))
        for row in (row for part in parts for row in part.to_pylist()):
            key = tuple(row[name] for name in names)
            if key != at:
                if held:
                    yield held
                held, at = [], key
            held.append(row)
    if held:
        yield held


def _first_shared(left: np.ndarray, right: np.ndarray, band: int) -> np.ndarray:
    """Which pairs of signatures share this band and none before it."""
    same = left[:, None, band] == right[None, :, band]
    for earlier in range(band):
        same &= left[:, None, earlier] != right[None, :, earlier]
    return same


def _sides(rows: list[dict]) -> tuple[list[dict], list[dict], bool]:
    """The two blocks of a unit of work; one twice where it is a block with itself."""
    if rows[0]["i"] == rows[0]["j"]:
        return rows, rows, True
    left = [r for r in rows if r["block"] == r["i"]]
    return left, [r for r in rows if r["block"] == r["j"]], False


def _proposed(rows: list[dict]) -> tuple[list[dict], list[dict], np.ndarray]:
    """Both sides of a unit of work and the pairs to be looked at in it."""
    left, right, same = _sides(rows)
    if not left or not right:
        return left, right, np.zeros((len(left), len(right)), bool)
    a = np.array([r["bands"] for r in left])
    b = a if same else np.array([r["bands"] for r in right])
    pairs = _first_shared(a, b, rows[0]["band"])
    return left, right, np.triu(pairs, 1) if same else pairs


def _units(classes: DataFrame) -> DataFrame:
    """Classes in their buckets' units of work, those alone in a bucket left out."""
    entries = classes.select("digest", F.posexplode("bands").alias("band", "value"))
    shared = entries.groupBy("band", "value").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    met = entries.join(shared, ["band", "value"]).select(
        "band",
        "value",
        "digest",
        F.pmod(F.xxhash64("digest"), blocks).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"),
    )
    return met.select(
        "band",
        "value",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        "block",
        "digest",
    )


_UNIT = ["band", "value", "i", "j"]
_WANTED = (
    "band int, value long, i int, j int, block int, "
    "digest binary, k long, size long, bands array<bigint>"
)


def _wanted(units: DataFrame, classes: DataFrame) -> DataFrame:
    """The units' rows that have a pair to look at there."""
    rows = units.join(classes.select("digest", "k", "size", "bands"), "digest").select(
        *_UNIT, "block", "digest", "k", "size", "bands"
    )

    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        schema = None
        for batch_rows, schema in _with_schema(batches):
            left, right, pairs = _proposed(batch_rows)
            out += [r for r, some in zip(left, pairs.any(axis=1)) if some]
            other = pairs.any(axis=0)
            if left is right:
                other &= ~pairs.any(axis=1)
            out += [r for r, some in zip(right, other) if some]
            if len(out) >= 2_000:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return rows.repartition(*_UNIT).sortWithinPartitions(*_UNIT).mapInArrow(propose, _WANTED)


def _with_schema(
    batches: Iterator[pa.RecordBatch],
) -> Iterator[tuple[list[dict], pa.Schema]]:
    schema: list[pa.Schema] = []

    def noting() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not schema:
                schema.append(batch.schema)
            yield batch

    for rows in _runs(noting(), len(_UNIT)):
        yield rows, schema[0]


def _sets(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The n-gram sets of the rows with these keys, as packed hashes.

    No text is shuffled: a sieve of the keys picks the texts where they are read.
    It may let some more through, which the join on the key leaves out.
    """
    sieve = sieve_of(keys, "k")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = ngram_hasher()
        for batch in batches:
            batch = batch.filter(pa.array(hits(sieve.value, batch.column(0).to_numpy())))
            packed = [hashes(text.as_py()).tobytes() for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(packed, pa.binary())], names=["k", "grams"]
            )

    found = rows.select("k", "text").mapInArrow(hashed, "k long, grams binary")
    return found.dropDuplicates(["k"])


def _linked(left: list[dict], right: list[dict], pairs: np.ndarray) -> np.ndarray:
    """Which of the proposed pairs reach the threshold on their full sets."""
    sets = [np.frombuffer(r["grams"], np.uint64) for r in right]
    sizes = np.array([len(s) for s in sets])
    words, codes = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(sizes)
    flags = np.zeros(len(words) + 1, np.int64)
    links = np.zeros_like(pairs)
    for p in np.flatnonzero(pairs.any(axis=1)):
        own = np.frombuffer(left[p]["grams"], np.uint64)
        at = np.searchsorted(words, own)
        at = at[(at < len(words)) & (words[np.minimum(at, len(words) - 1)] == own)]
        flags[at] = 1
        mates = np.flatnonzero(pairs[p])
        if len(mates) * 2 > len(sets):
            counted = np.concatenate([[0], np.cumsum(flags[codes])])
            common = (counted[ends] - counted[ends - sizes])[mates]
        else:
            common = np.array([flags[codes[ends[q] - sizes[q] : ends[q]]].sum() for q in mates])
        union = len(own) + sizes[mates] - common
        links[p, mates] = common * THRESHOLD.denominator >= union * THRESHOLD.numerator
        flags[at] = 0
    return links


def _forest(left: list[dict], right: list[dict], links: np.ndarray) -> list[tuple[bytes, bytes]]:
    """Links that connect all that is linked here, one fewer than there are ends."""
    parent: dict[bytes, bytes] = {}

    def root(x: bytes) -> bytes:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    edges = []
    for p, q in zip(*np.nonzero(links)):
        a, b = root(left[p]["digest"]), root(right[q]["digest"])
        if a != b:
            parent[a] = b
            edges.append((left[p]["digest"], right[q]["digest"]))
    return edges


_LINKS = "a binary, b binary, texts long, classes long"


def _links(wanted: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows of two kinds: (a, b) a link of the forest; (a, null) what class a is linked to here."""
    rows = wanted.join(sets, "k").select(*_UNIT, "block", "digest", "size", "bands", "grams")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in _runs(batches, len(_UNIT)):
            left, right, pairs = _proposed(unit)
            if not pairs.any():
                continue
            links = _linked(left, right, pairs)
            out = [(a, b, 0, 0) for a, b in _forest(left, right, links)]
            for own, others, matrix in ((left, right, links), (right, left, links.T)):
                texts = matrix @ np.array([r["size"] for r in others], np.int64)
                counts = matrix.sum(axis=1)
                out += [
                    (r["digest"], None, int(t), int(c)) for r, t, c in zip(own, texts, counts) if c
                ]
            if out:
                kinds = pa.binary(), pa.binary(), pa.int64(), pa.int64()
                columns = [pa.array(c, kind) for c, kind in zip(zip(*out), kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "texts", "classes"])

    return rows.repartition(*_UNIT).sortWithinPartitions(*_UNIT).mapInArrow(verify, _LINKS)


class Joined(NamedTuple):
    """`members`: id, k, digest of each row. `classes`: per digest its representative and group."""

    members: DataFrame
    classes: DataFrame


def join(docs: DataFrame) -> Joined:
    shape = banding()
    rows = _keyed(docs)
    signed = stage(_signed(rows, shape), "ngram-signed")
    known = signed.where("digest IS NOT NULL")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "k")).alias("first")
    classes = known.groupBy("digest").agg(
        first, F.count("*").alias("size"), F.first("bands").alias("bands")
    )
    classes = classes.select("digest", "first.id", "first.k", "size", "bands")
    classes = stage(classes, "ngram-classes")
    wanted = stage(_wanted(_units(classes), classes), "ngram-wanted")
    sets = _sets(rows, wanted.select("k").distinct())
    links = stage(_links(wanted, sets), "ngram-links")

    degree = links.where("b IS NULL").groupBy(F.col("a").alias("digest")).agg(
        F.sum("texts").alias("texts"), F.sum("classes").alias("linked")
    )
    groups = components(links.where("b IS NOT NULL").select("a", "b"))
    named = classes.select("digest", "id", "k", "size").join(
        groups.select(F.col("node").alias("digest"), "root"), "digest", "left"
    )
    root = F.coalesce("root", "digest")
    leader = F.struct(F.col("id").isNull().alias("no_id"), "id", "k")
    leaders = named.where("root IS NOT NULL").groupBy("root").agg(F.min(leader).alias("lead"))
    found = named.withColumn("root", root).join(degree, "digest", "left")
    found = found.join(leaders, "root", "left")
    return Joined(
        signed.select("id", "k", "digest"),
        found.select(
            "digest",
            "id",
            "k",
            (F.col("size") - 1 + F.coalesce("texts", F.lit(0))).alias("n_links"),
            F.coalesce("linked", F.lit(0)).alias("n_linked_classes"),
            F.coalesce("lead.id", "id").alias("group_id"),
            F.coalesce("lead.k", "k").alias("group_k"),
        ),
    )


def links_per_row(docs: DataFrame) -> DataFrame:
    """Per row `doc_id`, its class, its number of links to other rows, and its group.

    `n_links` counts every other row at or above the threshold, copies too.
    `class_id` and `group_id` are the smallest ids of the class and of all that
    links connect.
    """
    joined = join(docs)
    classes = joined.classes.withColumnRenamed("id", "class_id").drop("k", "group_k")
    return joined.members.join(classes, "digest", "left").select(
        F.col("id").alias("doc_id"),
        F.coalesce("class_id", F.when(F.col("digest").isNull(), F.col("id"))).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("n_linked_classes", F.lit(0)).alias("n_linked_classes"),
        F.coalesce("group_id", F.when(F.col("digest").isNull(), F.col("id"))).alias("group_id"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each group, that of the smallest id, and every row without words.

    Only rows that a sieve of the doubtful ones lets through are shuffled: those of
    groups of several rows, and few more.
    """
    joined = join(docs)
    classes = joined.classes.select("digest", "k", "group_k")
    members = joined.members.where("digest IS NOT NULL").join(
        classes.withColumnRenamed("k", "class_k"), "digest"
    )
    leads = (F.col("k") == F.col("class_k")) & (F.col("k") == F.col("group_k"))
    judged = members.groupBy("k").agg(F.count("*").alias("n"), F.max(leads).alias("leads"))
    doubtful = stage(judged.where("n > 1 OR NOT leads").select("k", "leads"), "ngram-doubtful")
    rows = docs.select(F.struct("*").alias("_row"), F.xxhash64("doc_id", whole()).alias("k"))
    sieve = sieve_of(doubtful, "k")
    inside = sifted(rows, "k", sieve, True).join(doubtful, "k", "left")
    alone = inside.where("leads IS NULL").select("_row")
    first = inside.where("leads").dropDuplicates(["k"]).select("_row")
    passed = sifted(rows, "k", sieve, False).select("_row")
    return passed.unionByName(alone).unionByName(first).select("_row.*")
