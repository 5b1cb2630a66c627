"""Benchmark decontamination by a generalised suffix automaton of the test items.

The automaton holds every substring of every item's words. Training words are
streamed through it: at each word it gives the longest ending that some item
contains. Where that is 13 words or more, or a whole item of fewer, the words are
hit. Documents of which a share is hit are then removed, and from all others the
spans of hit words are cut, however short their share: what stood between the first
and the last character of a span's words becomes one line break. The words on both
sides of a cut are not looked up again as neighbours.

Benchmarks are taken in packs of a bounded number of words, so that one
automaton, which is all that is broadcast, has a bounded size. A pack is one pass
over the documents; a benchmark beyond one pack takes more passes, with the spans
found so far written in between.

A document can only have a hit where it shares a run of a few words, looked up at
every so many words, with an item. Documents without one are not streamed.

Defined results: a null or empty text has no words and no hits; items without
words are no items. Equal items each count by their own id, and
all items without id hit as one item, which the digest of ids leaves out. Repeated rows are judged each
by itself, and extra columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankloom.llm.words import word_places, words_of
from rankloom.staging import stage

WINDOW = 13
PACK_WORDS = 200_000
COVERAGE_PCT = 5
PROBE = 5

SPANS = "array<struct<start:int,end:int>>"
FOUND = f"n_words bigint, spans {SPANS}, items array<bigint>"


class SuffixAutomaton:
    """All substrings of the items; what each 13-word window and each short item is part of."""

    def __init__(self, items: list[tuple[int, list[bytes]]]) -> None:
        self.next: list[dict[bytes, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        items = [(item_id, words) for item_id, words in items if words]
        for _, words in items:
            last = 0
            for word in words:
                last = self._extend(last, word)
        # State of every window -> (its length, ids of the items it is of).
        self.ends: dict[int, dict[int, set[int]]] = {}
        for item_id, words in items:
            size = min(WINDOW, len(words))
            state = 0
            for i, word in enumerate(words):
                state = self.next[state][word]
                if i + 1 >= size:
                    own = state
                    while self.length[self.link[own]] >= size:
                        own = self.link[own]
                    self.ends.setdefault(own, {}).setdefault(size, set()).add(item_id)
        self.nearest = self._nearest()
        shortest = min((min(WINDOW, len(words)) for _, words in items), default=WINDOW)
        self.probe = min(PROBE, shortest)
        self.stride = shortest - self.probe + 1
        self.probes = {
            tuple(words[i : i + self.probe])
            for _, words in items
            for i in range(len(words) - self.probe + 1)
        }

    def _add(self, length: int, link: int, moves: dict[bytes, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(moves)
        return len(self.next) - 1

    def _split(self, p: int, word: bytes, q: int) -> int:
        """`q` itself where it is one word longer than `p`, else its clone of that length."""
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._add(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, word: bytes) -> int:
        known = self.next[last].get(word)
        if known is not None:
            return self._split(last, word, known)
        new = self._add(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, word, self.next[p][word])
        return new

    def _nearest(self) -> list[int]:
        """For each state the nearest of itself and its suffixes that ends a window, or -1."""
        found = [-1] * len(self.next)
        for state in sorted(range(len(self.next)), key=self.length.__getitem__):
            if state in self.ends:
                found[state] = state
            elif state:
                found[state] = found[self.link[state]]
        return found

    def may_hit(self, words: list[bytes]) -> bool:
        """False only if no window can occur: each one covers one of the runs looked up."""
        probe, probes = self.probe, self.probes
        if probe == 0 or not probes:
            return False
        return any(
            tuple(words[i : i + probe]) in probes for i in range(0, len(words), self.stride)
        )

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Merged spans of hit words, ends exclusive, and the ids of the items they are of."""
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        if not self.may_hit(words):
            return spans, items
        moves, link, length = self.next, self.link, self.length
        state = matched = 0
        for i, word in enumerate(words):
            while state and word not in moves[state]:
                state = link[state]
                matched = length[state]
            if word in moves[state]:
                state = moves[state][word]
                matched += 1
            end = self.nearest[state]
            while end >= 0:
                for size, ids in self.ends[end].items():
                    if size <= matched:
                        items |= ids
                        spans.append((i + 1 - size, i + 1))
                end = self.nearest[link[end]] if end else -1
        return merged(spans), items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _packs(items: DataFrame, pack_words: int) -> Iterator[list[tuple[int, str]]]:
    """The items in packs of about `pack_words` words, one pack in memory at a time."""
    items = items.select("item_id", "text").where("text IS NOT NULL")
    pack, size = [], 0
    for item in items.toLocalIterator(prefetchPartitions=False):
        pack.append((item.item_id, item.text))
        size += len(words_of(item.text))
        if size >= pack_words:
            yield pack
            pack, size = [], 0
    if pack:
        yield pack


def find(docs: DataFrame, items: DataFrame, pack_words: int = PACK_WORDS) -> DataFrame:
    """Every row whole in `_row`, with `n_words`, the hit `spans` in words and the `items` hit."""
    spark = docs.sparkSession
    rows = docs.select(
        F.struct("*").alias("_row"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast(SPANS).alias("spans"),
        F.array().cast("array<bigint>").alias("items"),
    )
    packs = _packs(items, pack_words)
    pack = next(packs, [])
    while True:
        rows = _pass(spark, rows, pack)
        pack = next(packs, None)
        if pack is None:
            return rows
        rows = stage(rows, "decontamination")


def _pass(spark: SparkSession, rows: DataFrame, pack: list[tuple[int, str]]) -> DataFrame:
    shared = spark.sparkContext.broadcast(pack)
    built: list[SuffixAutomaton] = []

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not built:
            built.append(SuffixAutomaton([(i, words_of(text)) for i, text in shared.value]))
        automaton = built[0]
        for batch in batches:
            row, counts, all_spans, all_items = batch.column(0), [], [], []
            texts = row.field("text")
            for k in range(batch.num_rows):
                words = words_of(texts[k].as_py())
                spans, items = automaton.hits(words)
                counts.append(len(words))
                if spans or batch.column(2)[k].values:
                    spans += [(s["start"], s["end"]) for s in batch.column(2)[k].as_py()]
                    items |= set(batch.column(3)[k].as_py())
                all_spans.append([{"start": s, "end": e} for s, e in merged(spans)])
                all_items.append(sorted(items, key=lambda i: (i is None, i or 0)))
            yield pa.RecordBatch.from_arrays(
                [
                    row,
                    pa.array(counts, pa.int64()),
                    pa.array(all_spans, batch.schema.field(2).type),
                    pa.array(all_items, batch.schema.field(3).type),
                ],
                schema=batch.schema,
            )

    return rows.mapInArrow(stream, rows.schema)


def _hit(spans: str = "spans"):
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def _contaminated():
    hit = _hit()
    return (hit > 0) & (hit * 100 >= F.col("n_words") * COVERAGE_PCT)


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per row `doc_id` and what was found: counts, a digest of the items, the verdict."""
    found = find(docs.select("doc_id", "text"), items)
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "_row.doc_id",
        "n_words",
        _hit().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        _contaminated().alias("contaminated"),
        F.transform("spans", lambda s: F.concat_ws("-", s["start"], s["end"])).alias("spans"),
    )


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text less the spans of words, a line break in the place of each."""
    places, parts, at = word_places(text), [], 0
    for start, end in spans:
        parts.append(text[at : places[start][0]])
        at = places[end - 1][1]
    return "\n".join([*parts, text[at:]])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whole, and the text without its spans where there are any, else null."""
    for batch in batches:
        texts, spans = batch.column(0).field("text"), batch.column(1)
        cut = [
            without(texts[k].as_py(), [(s["start"], s["end"]) for s in spans[k].as_py()])
            if spans[k].values
            else None
            for k in range(batch.num_rows)
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(cut, pa.string())], names=["_row", "_cut"]
        )


def keep_clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows that are not contaminated, less their hit spans, with the columns they came with.

    Where a text is cut, a column `n_chars` gives its new length.
    """
    clean = find(docs, items).where(~_contaminated()).select("_row", "spans")
    schema = T.StructType([clean.schema["_row"], T.StructField("_cut", T.StringType())])
    rows = clean.mapInArrow(_cut, schema)
    new = {"text": F.col("_cut"), "n_chars": F.length("_cut")}

    def column(name: str):
        own = F.col(f"_row.`{name}`")
        if name not in new:
            return own
        changed = F.when(F.col("_cut").isNull(), own).otherwise(new[name])
        return changed.cast(docs.schema[name].dataType).alias(name)

    return rows.select(*[column(name) for name in docs.columns])
