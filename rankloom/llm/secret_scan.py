"""Secret scan: three fixed patterns, and runs of characters that look drawn at random.

A window slides over every candidate run. Its Shannon entropy follows from the
counts of its characters: a step takes one out and puts one in, which changes
two terms of the sum of c * log2(c). The sum is kept in whole numbers (a table
of rounded values times 2^16), so no step adds an error. Each class of
characters has its own threshold. Runs on the allow-list, windows with a piece on it and
runs that a fixed pattern has found are suppressed. All of it is one projection of built-in
functions.

Defined results: null and empty texts have no spans. The time for a text grows with its length,
and with the power 4/3 of its number of spans. Positions are code points,
ends exclusive. Repeated rows are judged each by itself; other columns are not
looked at.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.functions.text import parse_once
from rankloom.llm.columns import let, matches, running_max, whole

# The patterns, and how long what they find must be.
ASSIGN = (
    r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
MIN_ASSIGNED, MIN_ACCESS, MIN_HEX = 6, 20, 24

# Long enough runs only: what the plain pattern and the length test find together.
LONG_HEX = rf"[0-9a-f]{{{MIN_HEX},}}"

CANDIDATE = r"[A-Za-z0-9+/_-]{24,}={0,2}"
WINDOW = 24
SCALE = 1 << 16


class CharacterClass(NamedTuple):
    """Runs that fit `pattern` are suspect where a window has `bits` a character or more."""

    name: str
    pattern: str
    bits: float


# The first that fits counts.
CLASSES = (
    CharacterClass("hexadecimal", r"^[0-9A-Fa-f]+$", 3.0),
    CharacterClass("one case", r"^(?:[0-9a-z+/_-]+|[0-9A-Z+/_-]+)=*$", 3.8),
    CharacterClass("mixed", r"^[A-Za-z0-9+/_-]+=*$", 3.9),
)

# Runs that are random or long by nature and no secrets: identifiers, numbers, words of one case, words
# joined by signs, words joined by capitals. Repetition gives nothing back, so long runs need no stack.
ALLOWED = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^[0-9]+$",
    r"^(?:[a-z+/_-]+|[A-Z+/_-]+)=*$",
    r"^(?:[A-Za-z]++[0-9]{0,4}+[/_-]++)++[A-Za-z]*[0-9]{0,4}$",
    r"^(?:[A-Z]?+[a-z]++|[+/_-]++)++=*$",
)
# Pieces that no window is judged with.
ALLOWED_PIECE = r"(?i)example|0123456789|abcdefghij|(.)\1{7,}"

KINDS = ("assign", "access", "hex", "entropy")


def _entropy_sums() -> list[int]:
    return [round(c * math.log2(c) * SCALE) if c else 0 for c in range(WINDOW + 2)]


def largest_sum(bits: float) -> int:
    """The sum of c * log2(c) that a window of this entropy has; less means more entropy."""
    return round(WINDOW * (math.log2(WINDOW) - bits) * SCALE)


def _least_sum(run: Column) -> Column:
    """The least sum of c * log2(c) over the run's windows."""
    terms = F.array(*[F.lit(s) for s in _entropy_sums()])
    codes = F.transform(F.split(run, ""), lambda ch: F.ascii(ch))

    def slide(codes: Column) -> Column:
        zero = F.struct(
            F.array_repeat(F.lit(0), 128).alias("counts"),
            F.lit(0).alias("sum"),
            F.lit(2**31 - 1).alias("least"),
        )

        def change(counts: Column, total: Column, code: Column, by: int) -> tuple[Column, Column]:
            old = F.get(counts, code)
            counts_then = F.transform(counts, lambda c, k: F.when(k == code, c + by).otherwise(c))
            return counts_then, total - F.get(terms, old) + F.get(terms, old + by)

        def step(state: Column, i: Column) -> Column:
            def leave(state: Column) -> Column:
                counts, total = change(state["counts"], state["sum"], F.get(codes, i - WINDOW), -1)
                full = F.struct(
                    counts.alias("counts"), total.alias("sum"), state["least"].alias("least")
                )
                return F.when(i >= WINDOW, full).otherwise(state)

            def enter(state: Column) -> Column:
                counts, total = change(state["counts"], state["sum"], F.get(codes, i), 1)
                least = F.when(i >= WINDOW - 1, F.least(state["least"], total)).otherwise(
                    state["least"]
                )
                return F.struct(counts.alias("counts"), total.alias("sum"), least.alias("least"))

            return let(leave(state), enter)

        steps = F.sequence(F.lit(0), F.size(codes) - 1)
        return F.aggregate(steps, zero, step, lambda state: state["least"])

    return let(codes, slide)


def _suspect(run: Column) -> Column:
    """Whether a run has a window at or above its class's entropy, and is not allowed."""
    allowed = F.lit(False)
    for pattern in ALLOWED:
        allowed = allowed | run.rlike(pattern)
    most = F.lit(-1)
    for kind in reversed(CLASSES):
        most = F.when(run.rlike(kind.pattern), largest_sum(kind.bits)).otherwise(most)
    pieces = F.filter(F.split(run, ALLOWED_PIECE), lambda piece: F.length(piece) >= WINDOW)
    return F.when(allowed, False).otherwise(
        let(most, lambda most: F.exists(pieces, lambda piece: _least_sum(piece) <= most))
    )


def _untouched(runs: Column, base: Column) -> Column:
    """The runs that share no character with a span of the base; runs do not overlap each other.

    In the order of their starts, a span that touches a run is the next one or one of those before
    that reaches beyond the run's start.
    """
    nothing = F.lit(None).cast("string")
    marks = F.concat(
        F.transform(
            base,
            lambda b: F.struct(
                b["start"].alias("start"), F.lit(0).alias("run"), b["end"].alias("end"), nothing.alias("text")
            ),
        ),
        F.transform(
            runs,
            lambda r: F.struct(
                r["start"].alias("start"), F.lit(1).alias("run"), r["end"].alias("end"), r["text"].alias("text")
            ),
        ),
    )

    def sweep(marks: Column) -> Column:
        ends = F.transform(marks, lambda m: F.when(m["run"] == 0, m["end"]).otherwise(0))

        def free(reached: Column) -> Column:
            return F.filter(
                marks,
                lambda m, i: (m["run"] == 1)
                & (F.get(reached, i) <= m["start"])
                & ~F.coalesce(
                    (F.get(marks, i + 1)["run"] == 0) & (F.get(marks, i + 1)["start"] < m["end"]),
                    F.lit(False),
                ),
            )

        return let(running_max(ends, 0), free)

    return let(F.sort_array(marks), sweep)


def _spans(found: Column, kind: str) -> Column:
    order = KINDS.index(kind)
    return F.transform(
        found,
        lambda m: F.struct(
            m["start"].alias("start"), F.lit(order).alias("kind"), m["end"].alias("end")
        ),
    )


def _none() -> Column:
    return F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")


def _assigned(text: Column) -> Column:
    pattern = F.lit(ASSIGN)
    values = F.regexp_extract_all(text, pattern, F.lit(1))
    pairs = F.zip_with(
        matches(text, pattern),
        values,
        lambda m, v: F.struct(
            m["start"].alias("start"), m["end"].alias("end"), (F.length(v) >= MIN_ASSIGNED).alias("ok")
        ),
    )
    return F.filter(pairs, lambda m: m["ok"])


def _long(text: Column, pattern: str, least: int) -> Column:
    found = matches(text, F.lit(pattern))
    return F.filter(found, lambda m: (m["end"] - m["start"]) >= least)


def _written(spans: Column) -> Column:
    """kind:start:end, comma-joined, by start and then kind."""
    names = F.array(*[F.lit(k) for k in KINDS])
    parts = F.transform(
        F.array_sort(spans),
        lambda s: F.concat_ws(
            ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
        ),
    )
    return F.array_join(parts, ",")


def scan(docs: DataFrame) -> DataFrame:
    """Per row `doc_id`, the counts of each kind, and the spans as text."""
    text = F.col("_text")

    def where(pattern: str, found: Column) -> Column:
        return F.when(text.rlike(pattern), found).otherwise(_none())

    based = docs.select("doc_id", whole().alias("_text")).select(
        "doc_id",
        "_text",
        parse_once(
            F.struct(
                where(ASSIGN, _spans(_assigned(text), "assign")).alias("_assign"),
                where(ACCESS, _spans(_long(text, ACCESS, MIN_ACCESS), "access")).alias("_access"),
                where(LONG_HEX, _spans(_long(text, LONG_HEX, MIN_HEX), "hex")).alias("_hex"),
            )
        ),
    )

    def beyond(base: Column) -> Column:
        """Suspect runs that touch no span of the base."""
        free = _untouched(matches(text, F.lit(CANDIDATE)), base)
        return _spans(F.filter(free, lambda m: _suspect(m["text"])), "entropy")

    base = F.concat("_assign", "_access", "_hex")
    found = based.select(
        "doc_id",
        *[F.size(f"_{kind}").cast("long").alias(f"n_{kind}") for kind in KINDS[:3]],
        parse_once(
            F.struct(
                base.alias("_base"), where(CANDIDATE, let(base, beyond)).alias("_beyond")
            )
        ),
    )
    return found.select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2(_written(F.col("_base")), 256).alias("base_sha256"),
        _written(F.concat("_base", "_beyond")).alias("spans"),
        F.size("_beyond").cast("long").alias("n_entropy"),
    )
