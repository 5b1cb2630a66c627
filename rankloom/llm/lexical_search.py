"""Ranked lexical search over range-maximum tables.

`build` cuts the documents into segments of bounded size and writes, for each segment
and term, a posting list: documents in order of their ids, and how often the term stands
in each. A segment's documents are in no other, so segments are searched side by side
and only their best rows meet.

`search` gives each posting its impact, which needs the counts of the whole corpus, and
each list a sparse table of range maxima. An item starts with one interval, all
documents of a segment. The sum over its terms of the largest impact inside an interval
bounds the score of every document there. The intervals with the largest bounds are
taken first; each is split at the document of its largest summand, which is scored, and
the two rests are bounded by range-maximum answers again. Intervals that cannot reach
the k-th best score are dropped, and the search ends when none is left: results are exact.

Defined results: texts without a term (null, empty) are no documents of the corpus.
Rows without id come last among equal scores. Repeated rows are documents of their own,
repeated items are one item, and items that share an id but not a text are ranked each on
its own. Extra columns are not looked at. Very long texts are read whole. An empty
corpus or an empty list of items gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rankloom.staging import stage

# A segment closes at the first text that reaches either bound.
SEGMENT_BYTES = 1 << 25
SEGMENT_DOCS = 1 << 16
# Items that one task searches a segment for.
BLOCK_ITEMS = 1 << 12
# Intervals that are split together.
WAVE = 64

# Letters A-Z lower-cased, digits and all beyond ASCII kept, the rest parts words.
_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)

_INDEX = "segment string, term binary, df long, docs array<int>, tfs array<int>, ids array<bigint>"
_FOUND = "item string, doc_id long, score long"


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_WORDS).split()


class _Segment:
    """Documents of one segment while they are read."""

    def __init__(self) -> None:
        self.terms: defaultdict[bytes, int] = defaultdict()
        self.terms.default_factory = self.terms.__len__
        self.ids: list[int | None] = []
        self.found: list[np.ndarray] = []
        self.bytes = 0

    def add(self, doc_id: int | None, text: str) -> None:
        words = words_of(text)
        if words:
            self.ids.append(doc_id)
            self.found.append(
                np.fromiter(map(self.terms.__getitem__, words), np.int32, len(words))
            )
            self.bytes += len(text)

    def full(self) -> bool:
        return self.bytes >= SEGMENT_BYTES or len(self.ids) >= SEGMENT_DOCS

    def rows(self) -> Iterator[pa.RecordBatch]:
        """One row a term, and one without a term for the documents themselves."""
        name = uuid4().hex
        order = sorted(range(len(self.ids)), key=lambda i: (self.ids[i] is None, self.ids[i] or 0))
        sizes = np.array([len(self.found[i]) for i in order], np.int64)
        term = np.concatenate([self.found[i] for i in order]).astype(np.int64)
        doc = np.repeat(np.arange(len(order)), sizes)
        pairs, tfs = np.unique(term << 32 | doc, return_counts=True)
        ends = np.append(np.flatnonzero(np.diff(pairs >> 32)) + 1, len(pairs))
        terms = list(self.terms)
        docs = (pairs & 0xFFFFFFFF).astype(np.int32)
        tfs = tfs.astype(np.int32)
        yield _index_rows(
            [name], [None], [len(order)], pa.array([np.arange(len(order), dtype=np.int32)]),
            pa.array([sizes.astype(np.int32)]), pa.array([[self.ids[i] for i in order]], pa.list_(pa.int64())),
        )
        for first in range(0, len(ends), 1 << 14):
            upto = ends[first : first + (1 << 14)]
            start = int(ends[first - 1]) if first else 0
            part = slice(start, int(upto[-1]))
            offsets = pa.array(np.insert(upto - start, 0, 0).astype(np.int32))
            yield _index_rows(
                [name] * len(upto),
                terms[first : first + len(upto)],
                np.diff(offsets.to_numpy()).astype(np.int64),
                pa.ListArray.from_arrays(offsets, pa.array(docs[part])),
                pa.ListArray.from_arrays(offsets, pa.array(tfs[part])),
                pa.nulls(len(upto), pa.list_(pa.int64())),
            )


def _index_rows(segment, term, df, docs, tfs, ids) -> pa.RecordBatch:
    columns = [pa.array(segment, pa.string()), pa.array(term, pa.binary()), pa.array(df, pa.int64())]
    return pa.RecordBatch.from_arrays(
        [*columns, docs, tfs, ids], names=["segment", "term", "df", "docs", "tfs", "ids"]
    )


def build(docs: DataFrame) -> DataFrame:
    """The index of `doc_id` and `text`, written: one row a segment and term."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = _Segment()
        for batch in batches:
            for doc_id, text in zip(*batch.columns):
                segment.add(doc_id.as_py(), text.as_py())
                if segment.full():
                    yield from segment.rows()
                    segment = _Segment()
        if segment.ids:
            yield from segment.rows()

    texts = docs.select(F.col("doc_id").cast("long"), "text").where("text IS NOT NULL")
    return stage(texts.mapInArrow(index, _INDEX), "lexical-index")


def _item_terms(items: DataFrame) -> DataFrame:
    """Distinct items by a key of id and text, each with its distinct terms."""

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(words_of(t or ""))) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.binary()))], names=["item", "terms"]
            )

    return items.select("item", "text").mapInArrow(terms, "item string, terms array<binary>")


class Postings:
    """The lists of a segment's terms in one array, under one sparse table.

    Lists stand one after another, sorted by term number and document, so that one
    search finds a document in many lists at once. No range crosses a list.
    """

    def __init__(self, lists: list[tuple[np.ndarray, np.ndarray]], norms: np.ndarray) -> None:
        sizes = [len(docs) for docs, _ in lists]
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        docs = np.concatenate([docs for docs, _ in lists]).astype(np.int64)
        tfs = np.concatenate([tfs for _, tfs in lists]).astype(np.int64)
        self.docs = docs
        self.keys = np.repeat(np.arange(len(lists)), sizes) << 32 | docs
        self.impacts = 1000000000 * tfs // (1000 * tfs + 8 * norms[docs])
        # Row j holds the place of the maximum of 2^j postings from each place on.
        rows = [np.arange(len(docs), dtype=np.int32)]
        while (1 << len(rows)) <= max(sizes):
            half = 1 << (len(rows) - 1)
            first, second = rows[-1][:-half], rows[-1][half:]
            longer = np.where(self.impacts[second] > self.impacts[first], second, first)
            rows.append(np.append(longer, np.zeros(len(docs) - len(longer), np.int32)))
        self.table = np.stack(rows)

    def maxima(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Place of the largest impact of each range, the first of equal ones; -1 for none."""
        size = end - start
        level = np.frexp(np.maximum(size, 1).astype(np.float64))[1] - 1
        last = len(self.keys) - 1
        first = self.table[level, np.minimum(start, last)]
        second = self.table[level, np.maximum(end - (1 << level), 0)]
        best = np.where(self.impacts[second] > self.impacts[first], second, first)
        return np.where(size > 0, best, -1)

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The k documents with the highest scores, as (document, score)."""
        weights = weights[:, None]
        numbers = (terms.astype(np.int64) << 32)[:, None]

        def bounded(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Bound of each interval, and the document of its largest summand."""
            place = self.maxima(start, end)
            parts = np.where(place >= 0, weights * self.impacts[place], 0)
            top = place[parts.argmax(0), np.arange(parts.shape[1])]
            return parts.sum(0), self.docs[top]

        start, end = self.starts[terms][:, None], self.ends[terms][:, None]
        bound, split = bounded(start, end)
        found_docs, found_scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        least, last = 1, -1
        while len(bound):
            if len(bound) > WAVE:
                order = np.argpartition(-bound, WAVE)
                now, rest = order[:WAVE], order[WAVE:]
            else:
                now, rest = np.arange(len(bound)), np.arange(0)
            doc = split[now]
            place = np.searchsorted(self.keys, numbers | doc)
            held = self.keys[np.minimum(place, len(self.keys) - 1)] == (numbers | doc)
            held &= place < self.ends[terms][:, None]
            impact = self.impacts[np.minimum(place, len(self.keys) - 1)]
            found_docs = np.append(found_docs, doc)
            found_scores = np.append(found_scores, np.where(held, weights * impact, 0).sum(0))
            order = np.lexsort((found_docs, -found_scores))[:k]
            found_docs, found_scores = found_docs[order], found_scores[order]
            if len(order) == k:
                least, last = found_scores[-1], found_docs[-1]
            halves = np.hstack([start[:, now], place + held]), np.hstack([place, end[:, now]])
            new_bound, new_split = bounded(*halves)
            start = np.hstack([start[:, rest], halves[0]])
            end = np.hstack([end[:, rest], halves[1]])
            bound = np.append(bound[rest], new_bound)
            split = np.append(split[rest], new_split)
            # An equal score counts only for a document before the k-th.
            keep = bound > least
            equal = np.flatnonzero(bound == least)
            if len(equal):
                first = self.docs[np.minimum(start[:, equal], len(self.keys) - 1)]
                first = np.where(start[:, equal] < end[:, equal], first, 1 << 32).min(0)
                keep[equal] = (last < 0) | (first < last)
            start, end = start[:, keep], end[:, keep]
            bound, split = bound[keep], split[keep]
        return list(zip(found_docs.tolist(), found_scores.tolist()))


def _search_segment(group: pa.Table, k: int) -> pa.Table:
    """The best documents of one segment for the items of one block."""
    terms = group.column("term").to_pylist()
    own = terms.index(None)
    ids = group.column("ids")[own].as_py()
    lengths = group.column("tfs")[own].values.to_numpy().astype(np.int64)
    n, total = group.column("n_docs")[own].as_py(), group.column("n_words")[own].as_py()
    norms = 100 - 90 + 90 * lengths * n // total
    lists, weights, wanted = [], [], defaultdict(list)
    for row, term in enumerate(terms):
        weight = group.column("weight")[row].as_py()
        if term is None or weight <= 0:
            continue
        for item in group.column("items")[row].as_py():
            wanted[item].append(len(lists))
        weights.append(weight)
        docs, tfs = group.column("docs")[row], group.column("tfs")[row]
        lists.append((docs.values.to_numpy(), tfs.values.to_numpy()))
    rows: list[tuple[str, int | None, int]] = []
    if lists:
        postings, weights = Postings(lists, norms), np.array(weights, np.int64)
        for item, own_terms in wanted.items():
            numbers = np.array(own_terms)
            for doc, score in postings.best(numbers, weights[numbers], k):
                rows.append((item, ids[doc], score))
    kinds = pa.string(), pa.int64(), pa.int64()
    columns = [pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)]
    return pa.Table.from_arrays(columns, names=["item", "doc_id", "score"])


def search(index: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """Per item (`item_id`, `text`) its k best documents with their rank and score."""
    keyed = items.select("item_id", "text").distinct()
    keyed = stage(keyed.withColumn("item", F.sha2(F.to_json(F.struct("item_id", "text")), 256)), "items")
    blocks = -(-keyed.count() // BLOCK_ITEMS)
    block = F.pmod(F.xxhash64("item"), F.lit(max(1, blocks))).cast("int")
    wanted = (
        _item_terms(keyed)
        .select("item", block.alias("block"), F.explode("terms").alias("term"))
        .groupBy("term", "block")
        .agg(F.collect_list("item").alias("items"))
    )
    documents = index.where("term IS NULL")
    corpus = documents.agg(
        F.sum("df").alias("n_docs"),
        F.sum(F.aggregate("tfs", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n_words"),
    ).first()
    n, total = corpus.n_docs or 0, corpus.n_words or 0
    # The terms' counts are read from two narrow columns, before any posting is.
    df = index.select("term", "df").join(wanted.select("term").distinct(), "term")
    df = df.groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.ln((F.lit(2.0 * n + 2)) / (2 * F.col("df") + 1)))
    weighed = stage(wanted.join(df.select("term", weight.alias("weight")), "term"), "item-terms")
    numbers = [F.lit(n).alias("n_docs"), F.lit(total).alias("n_words")]
    shape = ["segment", "block", "term", "weight", "items", "docs", "tfs", "ids", "n_docs", "n_words"]
    postings = index.join(weighed, "term").select("*", *numbers).select(shape)
    every = F.explode(F.sequence(F.lit(0), F.lit(max(0, blocks - 1)))).alias("block")
    whole = documents.select("*", every, *numbers).select(
        *[F.lit(None).cast(kind).alias(name) if name in ("weight", "items") else F.col(name)
          for name, kind in zip(shape, ["", "", "", "long", "array<string>", "", "", "", "", ""])]
    )
    parts = whole.unionByName(postings)
    found = parts.groupBy("segment", "block").applyInArrow(lambda g: _search_segment(g, k), _FOUND)
    order = W.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(keyed, "item").select("item_id", "rank", "doc_id", "score")
