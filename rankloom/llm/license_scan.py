"""License scan: ordered signature rules behind a keyword gate.

Words are runs of letters, digits and characters beyond ASCII, A-Z lower-cased.
A rule is a regular expression over words parted by single blanks, with a
priority, a confidence and a keyword, with which a word begins in all it matches. Only texts that hold a gate word are
normalised, and of the rules only those whose keyword the text holds are run.
Detections inside a longer one are suppressed, and of two in the same place the
one of higher priority stays. All of it is one projection: no row is exploded or
shuffled.

Defined results: null and empty texts have no words, no places and score 0.
The time for a text grows with its length, and with the power 4/3 of its number of matches.
Repeated rows are judged each by itself; other columns are not looked at.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.functions.text import parse_once
from rankloom.llm.columns import (
    NOT_WORD,
    ascii_lower,
    let,
    matches,
    running_max,
    running_sum,
    spaced_words,
    spaces,
    whole,
    word_count,
)

# Phrases and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
PHRASE_CONFIDENCE = 60


class Family(NamedTuple):
    """Licenses of one name: how a word that gates them begins, a pattern of the name, versions."""

    label: str
    keyword: str
    name: str
    versions: tuple[str, ...] = ()


FAMILIES = (
    Family("apache", "apache", "apache(?: software)?", ("1.0", "1.1", "2.0")),
    Family("mit", "mit", "mit"),
    Family("mit", "expat", "expat"),
    Family("mit-0", "mit", "mit (?:no attribution|0)"),
    Family("bsd-2-clause", "bsd", "(?:simplified bsd|bsd 2 clause|2 clause bsd)"),
    Family("bsd-2-clause", "freebsd", "freebsd"),
    Family("bsd-3-clause", "bsd", "(?:(?:new|modified|revised) bsd|bsd 3 clause|3 clause bsd)"),
    Family("bsd-4-clause", "bsd", "(?:original bsd|bsd 4 clause|4 clause bsd)"),
    Family("bsd", "bsd", "bsd"),
    Family("0bsd", "bsd", "(?:zero clause bsd|bsd zero clause)"),
    Family("0bsd", "0bsd", "0bsd"),
    Family("gpl", "general public", "(?:gnu )?general public", ("1.0", "2.0", "3.0")),
    Family("gpl", "gpl", "(?:gnu )?gpl", ("1.0", "2.0", "3.0")),
    Family("lgpl", "lesser", "(?:gnu )?lesser general public", ("2.1", "3.0")),
    Family("lgpl", "library general", "(?:gnu )?library general public", ("2.0",)),
    Family("lgpl", "lgpl", "(?:gnu )?lgpl", ("2.0", "2.1", "3.0")),
    Family("agpl", "affero", "(?:gnu )?affero general public", ("1.0", "3.0")),
    Family("agpl", "agpl", "(?:gnu )?agpl", ("1.0", "3.0")),
    Family("gfdl", "documentation", "(?:gnu )?free documentation", ("1.1", "1.2", "1.3")),
    Family("mpl", "mozilla", "mozilla public", ("1.0", "1.1", "2.0")),
    Family("mpl", "mpl", "mpl", ("1.0", "1.1", "2.0")),
    Family("epl", "eclipse", "eclipse public", ("1.0", "2.0")),
    Family("edl", "eclipse", "eclipse distribution", ("1.0",)),
    Family("cddl", "common development", "common development and distribution", ("1.0", "1.1")),
    Family("cddl", "cddl", "cddl", ("1.0", "1.1")),
    Family("cpl", "common public", "common public", ("1.0",)),
    Family("eupl", "european union", "european union public", ("1.0", "1.1", "1.2")),
    Family("eupl", "eupl", "eupl", ("1.0", "1.1", "1.2")),
    Family("artistic", "artistic", "artistic", ("1.0", "2.0")),
    Family("isc", "isc", "isc"),
    Family("zlib", "zlib", "zlib(?: libpng)?"),
    Family("boost", "boost", "boost(?: software)?", ("1.0",)),
    Family("unlicense", "unlicense", "(?:the )?unlicense"),
    Family("wtfpl", "wtfpl", "wtfpl", ("1.0", "2.0")),
    Family("ofl", "sil open", "sil open font", ("1.0", "1.1")),
    Family("odbl", "open database", "open database", ("1.0",)),
    Family("odc-by", "open data commons", "open data commons attribution", ("1.0",)),
    Family("python", "python", "python(?: software foundation)?", ("2.0",)),
    Family("php", "php", "php", ("3.0", "3.01")),
    Family("ruby", "ruby", "ruby"),
    Family("openssl", "openssl", "openssl"),
    Family("postgresql", "postgresql", "postgresql"),
    Family("ms-pl", "microsoft", "microsoft public"),
    Family("ms-rl", "microsoft", "microsoft reciprocal"),
    Family("academic", "academic free", "academic free", ("1.1", "1.2", "2.0", "2.1", "3.0")),
    Family("osl", "open software", "open software", ("1.0", "2.0", "2.1", "3.0")),
    Family("qpl", "q public", "q public", ("1.0",)),
    Family("w3c", "w3c", "w3c(?: software)?"),
    Family("vim", "vim", "vim"),
    Family("sspl", "server side", "server side public", ("1.0",)),
    Family("busl", "business source", "business source", ("1.0", "1.1")),
    Family("elastic", "elastic", "elastic", ("1.0", "2.0")),
    Family("cc0", "cc0", "cc0", ("1.0",)),
    Family("cc0", "cc zero", "cc zero", ("1.0",)),
)

# The kinds of Creative Commons licenses.
COMMONS = {
    "by": "attribution",
    "by sa": "attribution share ?alike",
    "by nd": "attribution no ?deriv(?:ative)?s?",
    "by nc": "attribution non ?commercial",
    "by nc sa": "attribution non ?commercial share ?alike",
    "by nc nd": "attribution non ?commercial no ?deriv(?:ative)?s?",
}
COMMONS_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")

# Notices that name no license: label, keyword, pattern, confidence.
NOTICES = (
    ("public-domain", "public domain", "(?:in|into|to) the public domain", 70),
    ("public-domain", "public domain", "dedicated to the public domain", 90),
    ("proprietary", "proprietary", "proprietary and confidential", 80),
    ("proprietary", "confidential", "confidential and proprietary", 80),
    ("proprietary", "permission", "without (?:the )?(?:prior )?written permission", 60),
    ("copyright", "copyright", "copyright (?:c )?(?:19|20)[0-9]{2}", 50),
    ("copyright", "copyright", "copyright (?:c|by|the)", 40),
    ("permissive", "permission", "permission is hereby granted free of charge", 85),
    ("permissive", "redistribution", "redistribution and use in source and binary forms", 85),
    ("no-warranty", "warranty", "without warranty of any kind", 40),
    ("no-warranty", "warranties", "without warranties or conditions of any kind", 40),
    ("reserved", "rights", "some rights reserved", 50),
    ("free-use", "free", "free for (?:personal|non ?commercial|educational) use", 60),
)


class Rule(NamedTuple):
    keyword: str
    pattern: str
    label: str
    priority: int
    confidence: int


def _forms(label: str, keyword: str, name: str, at: int) -> Iterator[Rule]:
    """The sentences that apply a license of this name, the most telling first."""
    licensed = "(?:licen[cs]ed|released|distributed|published|available|covered)"
    terms = "(?:the )?(?:terms of (?:the )?)?"
    yield Rule(keyword, f"{licensed} under {terms}{name}", label, at + 3, 95)
    yield Rule(keyword, f"spdx licen[cs]e identifier {name}", label, at + 3, 100)
    yield Rule(keyword, f"{name} licen[cs]e", label, at + 2, 80)


def _rules() -> Iterator[Rule]:
    version = r"(?: public)?(?: licen[cs]e)?(?: version| v)? ?v?"
    for family in FAMILIES:
        name = f"{family.name}(?: licen[cs]e)?"
        yield from _forms(family.label, family.keyword, name, 0)
        for number in family.versions:
            major = number.removesuffix(".0").replace(".", " ")
            digits = major + "(?: 0)?" * number.endswith(".0")
            named = f"{family.name}{version}{digits}"
            label = f"{family.label}-{number}"
            yield Rule(family.keyword, named, label, 5, 90)
            yield from _forms(label, family.keyword, named, 6)
    for letters, words in COMMONS.items():
        label = "cc-" + letters.replace(" ", "-")
        names = {"cc": f"cc {letters}", "creative commons": f"creative commons {words}"}
        for keyword, name in names.items():
            yield from _forms(label, keyword, name, len(letters))
            for number in COMMONS_VERSIONS:
                digits = number.replace(".", " ")
                named = f"{name}(?: licen[cs]e)?(?: version| v)? {digits}"
                yield Rule(keyword, named, f"{label}-{number}", 10 + len(letters), 90)
                yield from _forms(f"{label}-{number}", keyword, named, 11 + len(letters))
    for label, keyword, pattern, confidence in NOTICES:
        yield Rule(keyword, pattern, label, 0, confidence)


RULES = tuple(_rules())
RULE_TABLE = (
    "array<struct<keyword:string,rules:"
    "array<struct<pattern:string,label:string,priority:int,confidence:int>>>>"
)


def _gate(rules: tuple[Rule, ...]) -> str:
    """A pattern of the raw text, in either case, that every text with a keyword fits.

    Grouped by first letter, so that most words fail after a few comparisons.
    """
    by_letter: dict[str, set[str]] = {}
    for keyword in {r.keyword for r in rules} | set(PHRASES):
        rest = keyword[1:].replace(" ", NOT_WORD)
        by_letter.setdefault(keyword[0], set()).add(rest)
    branches = [f"{x}(?:{'|'.join(sorted(rests))})" for x, rests in sorted(by_letter.items())]
    return f"(?i)(?<![0-9A-Za-z])(?:{'|'.join(branches)})"


def _phrase_places(spaced: Column, phrase: str) -> Column:
    """First words of a phrase's occurrences, overlapping ones too."""
    nowhere = F.array().cast("array<bigint>")
    pieces = F.split(spaced, f"(?= {phrase} )")

    def placed(pieces: Column) -> Column:
        before = running_sum(F.transform(pieces, lambda p: spaces(p).cast("long")))
        here = F.zip_with(
            pieces, before, lambda p, at: F.when(p.rlike(f"^ {phrase}(?: |$)"), at)
        )
        return F.array_compact(here)

    return F.when(F.contains(spaced, F.lit(f" {phrase} ")), let(pieces, placed)).otherwise(nowhere)


def _detections(spaced: Column, rules: tuple[Rule, ...]) -> Column:
    """All intervals of the rules whose keyword the text holds."""
    by_keyword: dict[str, list[dict]] = {}
    for rule in rules:
        found = rule._asdict() | {"pattern": f"(?<= ){rule.pattern}(?= )"}
        by_keyword.setdefault(rule.keyword, []).append(found)
    # One literal: a constant to the optimiser, and cheap to build.
    table = [{"keyword": f" {keyword}", "rules": own} for keyword, own in by_keyword.items()]
    groups = F.from_json(F.lit(json.dumps(table)), RULE_TABLE)

    def run(rule: Column) -> Column:
        # The text starts with a blank, so the word at the first match is one less.
        return F.transform(
            matches(spaced, rule["pattern"], spaces),
            lambda m: F.struct(
                (m["start"] - 1).alias("start"),
                (-m["end"]).alias("before_end"),
                (-rule["priority"]).alias("order"),
                rule["label"].alias("label"),
                rule["confidence"].alias("confidence"),
            ),
        )

    held = F.filter(groups, lambda g: F.contains(spaced, g["keyword"]))
    chosen = F.flatten(F.transform(held, lambda g: g["rules"]))
    fitting = F.filter(chosen, lambda r: F.regexp_like(spaced, r["pattern"]))
    return F.flatten(F.transform(fitting, run))


def _uncontained(detections: Column) -> Column:
    """Detections that no longer one contains, in order, as (start, end, label, confidence)."""

    def kept(ordered: Column) -> Column:
        reach = running_max(F.transform(ordered, lambda d: -d["before_end"]), -1)
        spans = F.zip_with(
            ordered,
            reach,
            lambda d, reach: F.when(
                -d["before_end"] > reach,
                F.struct(
                    d["start"].alias("start"),
                    (-d["before_end"]).alias("end"),
                    d["label"].alias("label"),
                    d["confidence"].alias("confidence"),
                ),
            ),
        )
        return F.array_compact(spans)

    return let(F.array_sort(detections), kept)


def _joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per row `doc_id`, the word count, the phrases' places and labels, and the `detections`.

    A detection is (start, end, label, confidence) in words, the end exclusive.
    `score` is the largest confidence found, in 0 to 1.
    """
    text = F.col("_text")
    gated = docs.select("doc_id", whole().alias("_text")).select(
        "doc_id",
        parse_once(
            let(
                spaced_words(text),
                lambda spaced: F.struct(
                    word_count(spaced).alias("n_words"),
                    F.when(text.rlike(_gate(rules)), ascii_lower(spaced)).alias("_spaced"),
                ),
            )
        ),
    )
    spaced = F.col("_spaced")
    nothing = F.array().cast("array<struct<start:bigint,end:bigint,label:string,confidence:int>>")
    nowhere = F.array().cast("array<bigint>")
    places = {
        label: F.coalesce(_phrase_places(spaced, phrase), nowhere)
        for phrase, label in PHRASES.items()
    }
    found = gated.select(
        "doc_id",
        "n_words",
        parse_once(
            F.struct(
                *[p.alias(f"_{label}") for label, p in places.items()],
                F.when(spaced.isNull(), nothing)
                .otherwise(let(_detections(spaced, rules), _uncontained))
                .alias("detections"),
            )
        ),
    )
    starts = F.concat(*[F.col(f"`_{label}`") for label in places])
    base = F.array_compact(
        F.array(*[F.when(F.size(f"`_{label}`") > 0, F.lit(label)) for label in places])
    )
    labels = F.concat(base, F.transform("detections", lambda d: d["label"]))
    surest = F.array_max(F.transform("detections", lambda d: d["confidence"]))
    of_phrase = F.when(F.size(base) > 0, PHRASE_CONFIDENCE)
    return found.select(
        "doc_id",
        "n_words",
        F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        _joined(base).alias("base_labels"),
        _joined(labels).alias("labels"),
        (F.coalesce(F.greatest(surest, of_phrase), F.lit(0)) / 100).alias("score"),
        "detections",
    )
