"""Mixing sources to target weights by Pfair scheduling of blocks.

A source's documents, in the order of a hash, are cut into blocks of about equal
size. A period has `SLOTS` slots. A source of weight w has floor(w * SLOTS) slots of
its own in each; with c of N slots, its block b may not start before slot
floor(b*N/c) and must be out by slot ceil((b+1)*N/c). Each slot goes to the
eligible block of the earliest deadline; as the counts fill every slot, no
deadline is missed. The pattern repeats, so it is worked out once for one period,
and every document finds its slot by itself.

What the whole slots leave of the weights is not rounded. The slots left over are
one stream more, the rest. It is split in two, and each half again, by the bits
of the source's hash, down to single sources. Of a split's slots a side has the
floor of its share at any time, or the ceiling, so the place of its block j is a
closed form in whole numbers. So every source has its own weight exactly, however
many sources there are and however small they are, and needs no table for it.

The mix ends where the last source that has no more than its target share is used
up. What other sources hold beyond that is left out of the mix (`in_mix` false):
this is the sampling that weights ask for, and no row is dropped here.

No source is ever sorted or summed in one task. Documents are dealt by source
and by the first bits of their hash; the running size within such a chunk is
added to the sum of the chunks before.

Defined results: null and empty texts have size 0 and a place; documents without
source form a source of their own. A source without text counts as one character.
A source whose target is missing, null or not above 0 has no slots and is not in the mix.
Equal rows stand side by side. Other columns are passed on.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rankloom.llm.columns import let
from rankloom.staging import stage

BLOCK_CHARS = 1 << 16
SLOTS = 1000
MAX_SHARE = 0.25
CHUNK_BITS = 12
HASH_BITS = 60
# Parts of a slot that what is left of a weight is counted in.
PARTS = 1 << 40


def _source(column: str) -> Column:
    """The source as a key that is never null."""
    return F.when(F.col(column).isNull(), "").otherwise(F.concat(F.lit("="), F.col(column)))


def _order(row: str) -> Column:
    """60 bits of the MD5 of id and text."""
    named = F.concat_ws("\n", F.col(f"{row}.doc_id").cast("string"), F.col(f"{row}.text"))
    return F.conv(F.substring(F.md5(named), 1, HASH_BITS // 4), 16, 10).cast("long")


def _weights(sizes: DataFrame, targets: DataFrame | None, most: float = MAX_SHARE) -> DataFrame:
    """Per stream `size` and `weight`, which add up to 1, and whether it has `less` than that.

    Without targets the weight is the share of the corpus, `most` at the most.
    """
    size = F.greatest("size", F.lit(1))
    if targets is None:
        everything = sizes.agg(F.sum(size)).first()[0] or 1
        given = sizes.withColumn("_given", F.least(size / F.lit(everything), F.lit(most)))
    else:
        asked = targets.select(_source("source").alias("stream"), F.col("weight").alias("_given"))
        asked = asked.where("_given > 0").groupBy("stream").agg(F.sum("_given").alias("_given"))
        given = sizes.join(asked, "stream")
    sums = given.agg(F.sum("_given").cast("double"), F.sum(size)).first()
    weight = F.col("_given") / F.lit(sums[0] or 1.0)
    share = size / F.lit(sums[1] or 1)
    return given.select(
        "stream", "size", weight.alias("weight"), (share <= weight * (1 + 1e-9)).alias("less")
    )


def _in_slots(weights: DataFrame, slots: int) -> DataFrame:
    """Weights in whole slots by largest remainder, one for a weight of zero; in all `slots`."""
    everything = W.partitionBy()
    none = F.sum((F.col("weight") <= 0).cast("int")).over(everything)
    total = F.sum("weight").over(everything)
    exact = F.when(F.col("weight") > 0, F.col("weight") * (slots - none) / total).otherwise(1.0)
    n = F.count("*").over(everything)
    exact = F.when(total > 0, exact).otherwise(F.lit(slots) / n)
    floors = weights.select("stream", exact.alias("_exact"), F.floor(exact).alias("_floor"))
    left = slots - F.sum("_floor").over(everything)
    by_rest = W.orderBy(F.desc(F.col("_exact") - F.col("_floor")), "stream")
    extra = (F.row_number().over(by_rest) <= left).cast("int")
    counts = floors.select("stream", (F.col("_floor") + extra).cast("int").alias("c"))
    return counts.where("c > 0")


def _edf(streams: Column, slots: int) -> Column:
    """The stream that each slot of the period goes to, by its place in `streams`."""
    zero = F.struct(
        F.transform(streams, lambda s: F.lit(0)).alias("given"),
        F.array().cast("array<int>").alias("order"),
    )

    def step(state: Column, slot: Column) -> Column:
        windows = F.transform(
            streams,
            lambda s, i: F.struct(
                F.ceil((F.get(state["given"], i) + 1) * slots / s["c"]).alias("deadline"),
                i.alias("i"),
                F.floor(F.get(state["given"], i) * slots / s["c"]).alias("release"),
            ),
        )
        first = F.array_min(F.filter(windows, lambda w: w["release"] <= slot))
        return let(
            first["i"],
            lambda pick: F.struct(
                F.transform(
                    state["given"], lambda g, i: F.when(i == pick, g + 1).otherwise(g)
                ).alias("given"),
                F.array_append(state["order"], pick).alias("order"),
            ),
        )

    return F.aggregate(F.sequence(F.lit(0), F.lit(slots - 1)), zero, step, lambda s: s["order"])


def schedule(weights: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Per `stream` its slots a period, `c`, and their numbers in order, `turns`.

    `weights` has rows of `stream` and `weight`, no more than `slots`.
    """
    packed = _in_slots(weights, slots).agg(
        F.array_sort(F.collect_list(F.struct("stream", "c"))).alias("streams")
    )
    dealt = packed.where(F.size("streams") > 0).select(
        "streams", F.posexplode(_edf(F.col("streams"), slots)).alias("slot", "i")
    )
    turns = dealt.select(F.get("streams", F.col("i")).alias("s"), "slot")
    return turns.groupBy(F.col("s.stream").alias("stream"), F.col("s.c").alias("c")).agg(
        F.array_sort(F.collect_list("slot")).alias("turns")
    )


def _whole(product: Column, by: Column, up: bool = False) -> Column:
    """The quotient of whole numbers, rounded down, or up."""
    if up:
        product = product + by - 1
    return F.call_function("div", product, by)


def _times(a: Column, b: Column) -> Column:
    return a.cast("decimal(19,0)") * b.cast("decimal(18,0)")


def _paths(parts: DataFrame) -> DataFrame:
    """Per stream the splits on the way from it up to the rest: its side, and the parts it is of.

    `parts` has `stream` and `q`, its parts of the rest.
    """
    bits = F.conv(F.substring(F.md5("stream"), 1, HASH_BITS // 4), 16, 10).cast("long")
    depths = F.sequence(F.lit(0), F.lit(HASH_BITS))
    at = parts.select("stream", "q", bits.alias("h"), F.explode(depths).alias("depth")).select(
        "stream", "q", "depth", F.call_function("shiftright", "h", HASH_BITS - F.col("depth")).alias("prefix")
    )
    nodes = at.groupBy("depth", "prefix").agg(F.sum("q").alias("parts"))
    step = F.struct((-F.col("depth")).alias("up"), (F.col("prefix") % 2).alias("side"), "parts")
    ways = at.join(nodes, ["depth", "prefix"]).groupBy("stream")
    ways = ways.agg(F.array_sort(F.collect_list(step)).alias("steps"))
    path = F.transform(
        "steps",
        lambda s, i: F.struct(
            s["side"].alias("side"),
            s["parts"].alias("own"),
            F.get("steps", i + 1)["parts"].alias("of"),
        ),
    )
    return ways.select("stream", F.filter(path, lambda s: s["own"] < s["of"]).alias("path"))


def _in_rest(j: Column) -> Column:
    """The place in the rest of a stream's part `j` of it, and its window there, beside `path`."""
    start = F.struct(j.alias("at"), j.alias("from"), (j + 1).alias("to"))

    def up(s: Column, step: Column) -> Column:
        own, of = step["own"], step["of"]
        first = _whole(_times(s["at"], of), own)
        last = _whole(_times(s["at"] + 1, of), own, True) - 1
        return F.struct(
            F.when(step["side"] == 0, last).otherwise(first).alias("at"),
            _whole(_times(s["from"], of), own).alias("from"),
            _whole(_times(s["to"], of), own, True).alias("to"),
        )

    return F.aggregate("path", start, up)


class _Period(NamedTuple):
    """The slots of a period, and the numbers of those of the rest."""

    slots: int
    rest: list[int]


def _plan(weights: DataFrame, slots: int) -> tuple[DataFrame, _Period]:
    """`weights` with whole slots `c`, their `turns`, parts `q` of the rest and the `path` to it."""
    exact = F.col("weight") * slots
    c = F.floor(exact).cast("int")
    q = F.round((exact - c) * PARTS).cast("long")
    counted = weights.withColumn("c", c).withColumn(
        "q", F.when(c == 0, F.greatest(q, F.lit(1))).otherwise(q)
    )
    counted = stage(counted, "mix-weights")
    sums = counted.agg(F.sum("c"), F.sum("q")).first()
    fixed, parts = sums[0] or 0, sums[1] or 0
    rest = max(round(parts / PARTS), 1) if parts else 0
    whole = counted.where("c > 0").select("stream", F.col("c").alias("weight"))
    spark = weights.sparkSession
    named = whole.unionByName(
        spark.range(1 if rest else 0).select(F.lit("~").alias("stream"), F.lit(rest).alias("weight"))
    )
    turns = stage(schedule(named, fixed + rest).drop("c"), "mix-turns")
    own = turns.where("stream = '~'").first()
    plan = counted.join(turns, "stream", "left").join(_paths(counted.where("q > 0")), "stream", "left")
    return plan, _Period(fixed + rest, list(own.turns) if own else [])


def _slot_of(block: Column, period: _Period) -> Column:
    """A block's slot and window, beside its stream's `c`, `q`, `turns` and `path`."""
    c, q, n, r = F.col("c"), F.col("q"), period.slots, max(len(period.rest), 1)
    parts = c.cast("long") * PARTS + q
    before = _whole(_times(block, q), parts)
    then = _whole(_times(block + 1, q), parts)
    rest = F.array(*[F.lit(t) for t in period.rest]).cast("array<int>")

    def turn(j: Column, count: Column | int, turns: Column | str) -> Column:
        k = j % count
        return ((j - k) / count * n + F.get(turns, k.cast("int"))).cast("long")

    own = let(
        block - before,
        lambda j: F.struct(
            turn(j, c, "turns").alias("slot"),
            F.floor(j * n / c).alias("release"),
            F.ceil((j + 1) * n / c).alias("deadline"),
        ),
    )
    shared = let(
        _in_rest(before),
        lambda s: F.struct(
            turn(s["at"], r, rest).alias("slot"),
            F.floor(s["from"] * n / r).alias("release"),
            F.ceil(s["to"] * n / r).alias("deadline"),
        ),
    )
    return F.when(then > before, shared).when(c > 0, own)


def _placed(
    docs: DataFrame, targets: DataFrame | None, block: int, slots: int, carried: Sequence[str]
) -> DataFrame:
    """The carried columns in `_row`, with each row's block, slot and whether the mix has it.

    A text that is not carried is measured where it is read and not shuffled.
    """
    rows = docs.select(F.struct("*").alias("_all")).select(
        F.struct(*[F.col(f"_all.`{name}`") for name in carried]).alias("_row"),
        _source("_all.source").alias("_source"),
        F.coalesce(F.length("_all.text"), F.lit(0)).cast("long").alias("_size"),
        _order("_all").alias("_hash"),
    )
    chunk = F.shiftright("_hash", HASH_BITS - CHUNK_BITS)
    rows = rows.withColumn("_chunk", chunk)
    by_source = stage(
        rows.groupBy("_source", "_chunk").agg(F.sum("_size").alias("_size")), "mix-chunks"
    )
    chunks = by_source.withColumnRenamed("_source", "stream")
    before = F.sum("_size").over(
        W.partitionBy("stream").orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    )
    offsets = chunks.select("stream", "_chunk", F.coalesce(before, F.lit(0)).alias("_before"))

    sizes = chunks.groupBy("stream").agg(F.sum("_size").alias("size"))
    plan, period = _plan(_weights(sizes, targets), slots)
    plan = stage(plan, "mix-plan")
    used_up = F.col("size") / (F.col("weight") * block)
    until = plan.where("less").agg(F.max(F.ceil(used_up))).first()[0] or 0

    started = rows.withColumnRenamed("_source", "stream").join(offsets, ["stream", "_chunk"])
    run = W.partitionBy("stream", "_chunk").orderBy("_hash", "_row.doc_id")
    running = F.sum("_size").over(run.rowsBetween(W.unboundedPreceding, W.currentRow))
    start = F.col("_before") + running - F.col("_size")
    placed = started.withColumn("_block", F.floor(start / block)).join(plan, "stream", "left")
    placed = placed.withColumn("_place", _slot_of(F.col("_block"), period))
    mixed = F.col("less") | (F.col("_place.slot") < until)
    return placed.withColumn("_in_mix", F.coalesce(mixed, F.lit(False)))


def mix(
    docs: DataFrame,
    targets: DataFrame | None = None,
    block: int = BLOCK_CHARS,
    slots: int = SLOTS,
) -> DataFrame:
    """Per row `doc_id`, `source`, its block in the source, and the block's window and slot.

    `targets` has `source` and `weight`; without it the weights are the sources'
    shares of the corpus, capped at `MAX_SHARE`. Slots are numbered over the whole
    mix, and a source that is used up leaves its later slots empty.
    """
    return _placed(docs, targets, block, slots, ("doc_id", "source")).select(
        "_row.doc_id",
        "_row.source",
        F.col("_block").alias("block"),
        F.col("_place.release").alias("release_slot"),
        F.col("_place.deadline").alias("deadline_slot"),
        F.col("_place.slot").alias("slot"),
        F.col("_in_mix").alias("in_mix"),
    )


def keep_mix(docs: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """The rows of the mix, with the columns they came with."""
    placed = _placed(docs, targets, BLOCK_CHARS, SLOTS, docs.columns)
    return placed.where("_in_mix").select("_row.*")
