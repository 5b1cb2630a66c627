"""Toxicity by compression distance.

zstandard trains two dictionaries: one on windows of ordinary texts, one on windows of
toxic texts without the words that ordinary texts use as often. The toxic one goes on from
the ordinary one, so that what both classes say costs the same under either. A
window of words that compresses better with the toxic one is suspect. A text's
windows are summed up in a few numbers (how many save 2, 3 or 4 bytes, the most
saved, the mean), and a logistic curve over them, fitted on training rows and moved to
the threshold that is best there, gives the score.

Which words ordinary texts use as often follows from counts of documents by word, over the
training sample, in Spark. The training sample is bounded: `MOST_TOXIC` toxic and
`MOST_ORDINARY` ordinary rows, the first by the hash of their id, and of each class
`MOST_WINDOWS` windows for its dictionary. Whole texts are scored, every window of them.

Defined results: null and empty texts have one empty window and the score that
follows from it. A row without id is not held out. Without training rows of both
labels every score is near 1 if there are toxic ones, else near 0. An id with both labels
is toxic; equal texts train once. Repeated rows are scored each by
itself; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.llm.columns import whole
from rankloom.llm.process import kept
from rankloom.staging import stage

MOST_TOXIC, MOST_ORDINARY = 4_000, 16_000
MOST_WINDOWS = 40_000
# A telling word is in this share of the toxic texts, and more often than in others by this z-score.
LEAST_SHARE, LEAST_DOCS, LEAST_Z = 0.02, 3, 6.0
ORDINARY_BYTES, TOXIC_BYTES = 8192, 1024
SEGMENT, MATCHED = 24, 6
# zstandard takes no empty dictionary, and looks for nothing in the last bytes of one.
SHORTEST, UNSEEN = 64, 16
WINDOW, STEP = 8, 3
FOLDS, HELD_OUT = 5, 0

_WORD = re.compile(r"\w+")


class Dictionaries(NamedTuple):
    toxic: bytes
    ordinary: bytes


class Model(NamedTuple):
    """Dictionaries, and the logistic curve over the standardised features."""

    dictionaries: Dictionaries
    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    base: float


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def windows(text: str) -> list[bytes]:
    """Windows of 8 words, every third word on; the last ones may be shorter."""
    words = _WORD.findall(text.lower())
    last = max(1, len(words) - WINDOW + STEP)
    return [f" {' '.join(words[i : i + WINDOW])} ".encode() for i in range(0, last, STEP)]


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    """Matches of 6 bytes or more: shorter ones are common to any text."""
    parameters = zstandard.ZstdCompressionParameters(
        format=zstandard.FORMAT_ZSTD1_MAGICLESS,
        window_log=17,
        chain_log=12,
        hash_log=14,
        search_log=6,
        min_match=6,
        target_length=64,
        strategy=zstandard.STRATEGY_LAZY,
        write_content_size=False,
        write_checksum=False,
        write_dict_id=False,
    )
    content = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    content.precompute_compress(compression_params=parameters)
    return zstandard.ZstdCompressor(compression_params=parameters, dict_data=content)


def measurer(dictionaries: Dictionaries) -> Callable[[str], tuple[float, ...]]:
    """A function from text to its features."""
    toxic, ordinary = _compressor(dictionaries.toxic), _compressor(dictionaries.ordinary)

    def features(text: str) -> tuple[float, ...]:
        saved = np.array(
            [len(ordinary.compress(w)) - len(toxic.compress(w)) for w in windows(text)]
        )
        top = np.sort(saved)[::-1][:3]
        counts = [(saved >= least).sum() for least in (2, 3, 4)]
        return (
            float(top[0]),
            float(top.mean()),
            float(saved.mean()),
            *[float(np.log1p(n)) for n in counts],
            *[float(n / len(saved)) for n in counts],
        )

    return features


FEATURES = 9


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Training rows: `doc_id`, `text`, `toxic`, none of them held out."""
    known = labels.select("doc_id", "toxic").where("toxic IS NOT NULL AND doc_id IS NOT NULL")
    known = known.where(fold(F.col("doc_id")) != HELD_OUT)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64("doc_id"), F.col("doc_id")
    toxic = known.where("toxic = 1").orderBy(*order).limit(MOST_TOXIC)
    chosen = toxic.unionByName(known.where("toxic = 0").orderBy(*order).limit(MOST_ORDINARY))
    # The chosen ids are bounded by the two parameters, so no other text is shuffled.
    rows = docs.select("doc_id", whole().alias("text")).join(F.broadcast(chosen), "doc_id")
    # An id that many rows have counts once, or it would break the bound.
    rows = rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    # So does a text, or its copies would make its words telling.
    return rows.groupBy("text").agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic"))


def _telling(sample: DataFrame, toxic: int, ordinary: int) -> frozenset[str]:
    """Words in many toxic texts that ordinary ones have less often, by the documents they are in.

    Each is in a fixed share of the toxic texts, so there are at most 1 / share times as many as
    words in a text.
    """

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, labels = [], []
            for text, label in zip(batch.column(0), batch.column(1).to_pylist()):
                own = set(_WORD.findall(text.as_py().lower()))
                found += own
                labels += [label] * len(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.string()), pa.array(labels, pa.int32())],
                names=["word", "toxic"],
            )

    listed = sample.select("text", F.col("toxic").cast("int").alias("toxic"))
    counts = listed.mapInArrow(words, "word string, toxic int").groupBy("word").agg(
        F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b")
    )
    a, b = F.col("a"), F.col("b")
    share = (a + b) / (toxic + ordinary)
    spread = F.sqrt(share * (1 - share) * (1 / toxic + 1 / ordinary) + 1e-12)
    frequent = counts.where(a >= max(LEAST_DOCS, LEAST_SHARE * toxic))
    return frozenset(
        r.word
        for r in frequent.where((a / toxic - b / ordinary) / spread > LEAST_Z).select("word").collect()
    )


def _pieces(sample: DataFrame, label: int, telling: frozenset[str] | None = None) -> list[bytes]:
    """Windows of a class's texts, of their telling words alone if given: the first by hash."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column(0):
                words = _WORD.findall(text.as_py().lower())
                if telling is not None:
                    words = [w for w in words if w in telling]
                found += [
                    f" {' '.join(words[i : i + WINDOW])} " for i in range(0, len(words), WINDOW)
                ]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["piece"])

    pieces = sample.where(F.col("toxic") == label).select("text").mapInArrow(cut, "piece string")
    first = pieces.orderBy(F.xxhash64("piece"), "piece").limit(MOST_WINDOWS)
    # A word of any length may stand in a text; no dictionary has room for a longer piece.
    return [r.piece.encode()[:ORDINARY_BYTES] for r in first.collect()]


def _trained(pieces: list[bytes], size: int) -> bytes:
    """What zstandard picks of the pieces; too few for it to pick from are taken as they are."""
    try:
        found = zstandard.train_dictionary(size, pieces, k=SEGMENT, d=MATCHED)
    except (zstandard.ZstdError, ValueError):
        return b"".join(pieces)[:size]
    return found.as_bytes()


def _dictionaries(sample: DataFrame, telling: frozenset[str]) -> Dictionaries:
    """Both of one length, so that what they share is as far off in either."""
    shared = _trained(_pieces(sample, 0), ORDINARY_BYTES).rjust(SHORTEST)
    own = _trained(_pieces(sample, 1, telling), TOXIC_BYTES) if telling else b""
    end = b" " * UNSEEN
    return Dictionaries(toxic=shared + own + end, ordinary=shared + b" " * len(own) + end)


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 4000, ridge: float = 1e-3) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= 0.5 * (x.T @ (p - y) / len(y) + ridge * w)
    return w


def _best_cut(score: np.ndarray, y: np.ndarray) -> float:
    """The cut that gives the best F1 on the training rows, midway between two scores."""
    order = np.argsort(-score, kind="stable")
    found = np.cumsum(y[order])
    f1 = 2 * found / (np.arange(1, len(y) + 1) + y.sum())
    last = np.append(score[order][1:] != score[order][:-1], True)
    at = int(np.argmax(np.where(last, f1, -1)))
    below = score[order][at + 1] if at + 1 < len(y) else score[order][at] - 1
    return float((score[order][at] + below) / 2)


def train(docs: DataFrame, labels: DataFrame) -> Model:
    sample = stage(_sample(docs, labels), "toxicity-sample")
    counts = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    toxic, ordinary = counts.get(1, 0), counts.get(0, 0)
    if not toxic or not ordinary:
        share = 1.0 if toxic else 0.0
        zero = (0.0,) * FEATURES
        blank = b" " * SHORTEST
        return Model(Dictionaries(blank, blank), zero, zero, zero, 30.0 * (2 * share - 1))
    dictionaries = _dictionaries(sample, _telling(sample, toxic, ordinary))
    # A few numbers a row of the bounded sample come to the driver.
    rows = _measured(sample.select("text", "toxic"), dictionaries).collect()
    x = np.array([r.features for r in rows])
    y = np.array([r.toxic for r in rows], float)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    weights = _logistic(np.c_[(x - mean) / scale, np.ones(len(x))], y)
    cut = _best_cut(((x - mean) / scale) @ weights[:-1], y)
    return Model(dictionaries, tuple(mean), tuple(scale), tuple(weights[:-1]), -cut)


def _measured(rows: DataFrame, dictionaries: Dictionaries) -> DataFrame:
    """`rows` with the array `features` in place of `text`, their first column."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = kept(("toxicity", dictionaries), lambda: measurer(dictionaries))
        for batch in batches:
            found = [features(text.as_py()) for text in batch.column(0)]
            columns = [*batch.columns[1:], pa.array(found, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(
                columns, names=[*batch.schema.names[1:], "features"]
            )

    kinds = [f"`{name}` {kind}" for name, kind in rows.dtypes[1:]]
    return rows.mapInArrow(measure, ", ".join([*kinds, "features array<double>"]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per row `doc_id`, `held_out`, `score` and `predicted`."""
    rows = docs.select(whole().alias("text"), "doc_id")
    measured = _measured(rows, model.dictionaries)
    total = F.lit(model.base)
    for i, (mean, scale, weight) in enumerate(zip(model.mean, model.scale, model.weights)):
        if weight:
            total = total + (F.get("features", F.lit(i)) - mean) / scale * weight
    scored = measured.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out"),
        (1 / (1 + F.exp(-F.greatest(F.least(total, F.lit(30.0)), F.lit(-30.0))))).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
