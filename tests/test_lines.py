"""Line decoding, quarantine, payloads and JSON records."""

from __future__ import annotations

import csv
import io
import json
import random

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from samples import HEADER, SECOND_DAY

from rankloom import sinks, sources, staging
from rankloom.functions import first_name, last_name
from rankloom.operators import json_records
from rankloom.schemas import FEED, NA_WORDS
from rankloom.sources import large_payload, records, runs


@pytest.fixture
def decode(spark):
    def run(*lines: str):
        frame = spark.createDataFrame([(line,) for line in lines], "value string")
        decoded = sources.decode_lines(frame)
        good = [row.asDict() for row in sources.accepted(decoded).collect()]
        bad = {row.raw_line: row.reject_reason for row in sources.rejected(decoded).collect()}
        return good, bad

    return run


GOOD = "501,1,Ada Korhan,Norland,888,888,2024-12-27,Flat,7000,3,"


def test_sample_decodes_as_pandas_reads_it(decode):
    good, bad = decode(HEADER, *SECOND_DAY)
    expected = pd.read_csv(
        io.StringIO("\n".join(SECOND_DAY)), names=FEED.names, dtype={"faceImageId": str}
    )
    assert not bad
    got = pd.DataFrame(good)
    pd.testing.assert_frame_equal(got, expected, check_dtype=False)


def test_headers_are_dropped_wherever_they_stand(decode):
    good, bad = decode(HEADER, GOOD, HEADER, GOOD, "id,anything")
    assert len(good) == 2 and not bad


def test_short_line_is_padded(decode):
    good, bad = decode(GOOD.rsplit(",", 1)[0], "1,2,Ann")
    assert not bad
    assert good[0]["countryId"] == 3 and good[0]["difference"] is None
    assert good[1]["name"] == "Ann" and good[1]["country"] is None


def test_lines_that_cannot_be_read_are_kept_apart(decode):
    surplus = GOOD + "1.0,more"
    empty_surplus = GOOD + ","
    text_rank = GOOD.replace(",1,", ",first,")
    open_quote = '1,2,"Ann'
    good, bad = decode(GOOD, surplus, empty_surplus, text_rank, open_quote, "")
    assert len(good) == 1
    assert bad == {
        surplus: "too many fields",
        empty_surplus: "too many fields",
        text_rank: "not a number",
        open_quote: "open quote",
        "": "blank line",
    }


def test_quotes_and_blanks(decode):
    line = '1,2,"Venn, ""Dar"" D", Isla Verde ,5,5,2024-12-27,Up,1,3,1.5'
    good, bad = decode(line)
    assert not bad
    assert good[0]["name"] == 'Venn, "Dar" D'
    assert good[0]["country"] == " Isla Verde "
    assert good[0]["difference"] == 1.5
    _, bad = decode(line + ",x")
    assert bad == {line + ",x": "too many fields"}


def test_a_line_beyond_the_parsers_limit_fails_nothing(decode):
    endless = "1" + ",2" * 30_000
    quoted = GOOD.replace("Ada Korhan", '"' + "," * 30_000 + '"')
    good, bad = decode(endless, GOOD, quoted)
    assert bad == {endless: "too many fields"}
    assert sorted(len(row["name"]) for row in good) == [10, 30_000]


@settings(max_examples=15, deadline=None)
@given(
    st.lists(
        st.tuples(st.text(alphabet='ab,"é -', max_size=6), st.integers(1, 14)),
        min_size=1,
        max_size=15,
    )
)
def test_lines_decode_as_a_csv_reader_reads_them(spark, cases):
    """Any text in the text columns, any number of fields."""
    lines = []
    for number, (text, width) in enumerate(cases):
        fields = [str(number), "2", text, text, "5", "5", text, text, text, "3", "1.5", "x", "y", "z"]
        buffer = io.StringIO()
        csv.writer(buffer, lineterminator="").writerow(fields[:width])
        lines.append(buffer.getvalue())
    frame = spark.createDataFrame([(line,) for line in lines], "value string")
    decoded = sources.decode_lines(frame)
    got = {row.id: row for row in sources.accepted(decoded).collect()}
    rejects = {row.raw_line for row in sources.rejected(decoded).collect()}
    for number, (line, (text, width)) in enumerate(zip(lines, cases, strict=True)):
        if width > len(FEED):
            assert line in rejects
            continue
        expected = [f or None for f in next(csv.reader([line]))]
        expected += [None] * (len(FEED) - len(expected))
        row = got[number]
        assert [row[c] for c in ("name", "country", "lastUpdatedOn", "trend", "faceImageId")] == [
            expected[i] for i in (2, 3, 6, 7, 8)
        ]


@pytest.mark.parametrize("word", [w for w in NA_WORDS if w])
def test_missing_value_words(decode, word):
    good, bad = decode(f"1,{word},{word},{word},5,5,{word},{word},{word},3,{word}")
    assert not bad
    assert [good[0][c] for c in ("rank", "name", "country", "trend", "difference")] == [None] * 5


def test_csv_round_trip(spark, feed_of, tmp_path):
    rows = [
        {"id": 1, "name": 'A "q", b', "country": " x ", "difference": -1.0},
        {"id": 2, "rank": 3, "name": "Ann  Lee", "lastUpdatedOn": "2024-12-27"},
    ]
    df = feed_of(*rows)
    shuffled = df.select(*reversed(FEED.names))
    sinks.write_feed_csv(shuffled, str(tmp_path / "csv"))
    for read in (
        sources.read_feed_csv(spark, str(tmp_path / "csv")),
        sources.accepted(sources.decode_lines(sources.read_lines(spark, str(tmp_path / "csv")))),
    ):
        assert sorted(read.collect()) == sorted(df.collect())


RECORD = {
    "id": "733",
    "rank": "1",
    "name": "Wren Adler",
    "country": "Talamar",
    "rating": "640",
    "difference": 1,
    "points": "640",
    "lastUpdatedOn": "2024-11-02",
    "trend": "Up",
    "faceImageId": "9105",
    "countryId": "49",
}


def test_payload_is_bound_by_name(spark, tmp_path):
    flat = {**RECORD, "id": "2", "trend": "Flat"}
    del flat["difference"]
    (tmp_path / "a.json").write_text(json.dumps({"rank": [RECORD, flat]}, indent=2))
    (tmp_path / "b.json").write_text(json.dumps({"other": [RECORD]}, indent=2))
    (tmp_path / "c.json").write_text(json.dumps({"rank": []}))
    documents = sources.read_payload(spark, str(tmp_path))
    assert documents.count() == 3
    rows = sorted(sources.flatten_payload(documents).collect())
    assert [tuple(row) for row in rows] == [
        (2, 1, "Wren Adler", "Talamar", 640, 640, "2024-11-02", "Flat", "9105", 49, None),
        (733, 1, "Wren Adler", "Talamar", 640, 640, "2024-11-02", "Up", "9105", 49, 1.0),
    ]


def test_payload_of_many_lines(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("\n".join(json.dumps({"rank": [RECORD]}) for _ in range(5)))
    documents = sources.read_payload(spark, str(tmp_path), one_per_file=False)
    assert sources.flatten_payload(documents).count() == 5


def test_a_large_payload_is_cut_as_if_read_whole(spark, tmp_path, monkeypatch):
    """Small splits; braces, brackets and quotes in texts, nested values, and files of other shapes."""
    rng = random.Random(11)
    bits = ["}", "{", "[", "]", '"', "\\", ",", '\\"', "é", "\n", "a b", "},{"]

    def record(i):
        name = "".join(rng.choices(bits, k=rng.randint(0, 7)))
        extra = [{}, {"more": {"x": [1, {"y": "}"}]}}, {"rating": "high"}][rng.choice([0, 0, 1, 2])]
        return {**RECORD, "id": i, "name": name, **extra}

    usual = [record(i) for i in range(60)]
    shapes = {
        "plain": json.dumps({"rank": usual}),
        "spread": json.dumps({"rank": usual[:20]}, indent=2) + "\n",
        "one": json.dumps({"rank": usual[:1]}),
        "none": json.dumps({"rank": []}),
        "empty": "",
        "other": json.dumps({"other": usual[:3], "rank": usual[3:5]}),
        "after": json.dumps({"rank": usual[:3], "other": usual[3:5]}),
        "mixed": json.dumps({"rank": [usual[0], 3, "}", None, usual[1]]}),
        "cut": json.dumps({"rank": usual[:9]})[:-40],
        "unparted": json.dumps({"rank": usual[:4]}).replace('}, {"id"', '} {"id"'),
        "twice": json.dumps({"rank": usual[:2]}) * 2,
        "repeated": '{"rank": [{"id": 1, "id": 2}]}',
    }
    for name, text in shapes.items():
        (tmp_path / f"{name}.json").write_text(text)
    expected = sources.decode_payload(sources.read_payload(spark, str(tmp_path)))
    whole = []

    def decode_whole(texts):
        whole.extend(r.f for r in texts.select(F.col("_metadata.file_name").alias("f")).collect())
        return sources.decode_payload(texts)

    monkeypatch.setattr(large_payload, "decode_payload", decode_whole)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
    try:
        got = sources.decode_large_payload(spark, str(tmp_path)).collect()
        assert spark.read.text(str(tmp_path / "plain.json")).rdd.getNumPartitions() > 5
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert sorted(map(repr, got)) == sorted(map(repr, expected.collect()))
    assert len(got) > 90
    # A file without bytes is no document for any reader.
    cut = {f"{name}.json" for name in shapes} - set(whole) - {"empty.json"}
    assert cut == {"plain.json", "spread.json", "one.json"}


def test_json_records(spark):
    lines = [HEADER, GOOD, "1,2,Ann", '1,"a,b"', GOOD + "1.0,surplus"]
    frame = spark.createDataFrame([(line,) for line in lines], "value string")
    got = [row.record for row in json_records(frame).collect()]
    for line, record in zip(lines[1:], got, strict=True):
        expected = dict(zip(FEED.names, line.split(","), strict=False))
        assert json.loads(record) == expected
        assert list(json.loads(record)) == list(expected)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(alphabet="Ab é-𝄞 ", max_size=8), min_size=1, max_size=20))
def test_names_split_as_python_does(spark, names):
    frame = spark.createDataFrame([(n,) for n in names], "name string")
    got = frame.select(first_name(frame.name), last_name(frame.name)).collect()
    assert [tuple(row) for row in got] == [
        (n.split(" ")[0], " ".join(n.split(" ")[1:])) for n in names
    ]


def test_missing_name_stays_missing(spark):
    frame = spark.createDataFrame([(None,)], "name string")
    assert tuple(frame.select(first_name(frame.name), last_name(frame.name)).first()) == (None, None)


def test_records_with_line_breaks_in_fields(spark, tmp_path):
    """Small splits, so that records begin in one and end in another."""
    rng = random.Random(3)
    parts = ["A", "b", '"', "\n", ",", "x y", "\r\n", "é"]
    expected = []
    for file in range(3):
        text = io.StringIO(newline="")
        writer = csv.writer(text, lineterminator="\r\n" if file == 1 else "\n")
        writer.writerow(FEED.names)
        for i in range(120):
            name = "".join(rng.choices(parts, k=rng.randint(1, 9))) if i % 3 else "Ann"
            writer.writerow([i, 1, name, "C", 5, 6, "2024-12-26", "Up", "7", 3, 1.5])
            expected.append((i, name))
        (tmp_path / f"{file}.csv").write_text(text.getvalue(), newline="")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        decoded = sources.decode_csv(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert sorted((r.id, r.name) for r in decoded) == sorted(expected)
    assert not [r for r in decoded if r.reject_reason]


def test_a_quote_that_is_never_closed_spoils_its_line_alone(spark, tmp_path):
    lines = [
        '1,1,"A\nB",C,5,6,2024-12-26,Up,7,3,1.5',
        '2,1,"open,C,5,6,2024-12-26,Up,7,3,1.5',
        "3,1,Ann,C,5,6,2024-12-26,Up,7,3,1.5",
    ]
    (tmp_path / "a.csv").write_text("\n".join([",".join(FEED.names), *lines]) + "\n")
    decoded = {r.raw_line: r for r in sources.decode_csv(spark, str(tmp_path)).collect()}
    assert [decoded[line].reject_reason for line in lines] == [None, "open quote", None]
    assert (decoded[lines[0]].name, decoded[lines[2]].id) == ("A\nB", 3)


def test_files_with_line_breaks_and_other_headers_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name\n1,"A\nB"\n')
    (tmp_path / "b.csv").write_text("name,id\nA,1\n")
    with pytest.raises(ValueError, match="headers"):
        sources.decode_csv(spark, str(tmp_path))


@pytest.fixture
def staged(spark, monkeypatch):
    """What the readers stage, by label, with small splits and batches."""
    frames = {}

    def stage(df, label):
        frames[label] = staging.stage(df, label)
        return frames[label]

    for module in (runs, records, large_payload):
        monkeypatch.setattr(module, "stage", stage)
    small = {
        "spark.sql.files.maxPartitionBytes": "20000",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "50",
    }
    before = {key: spark.conf.get(key) for key in small}
    for key, value in small.items():
        spark.conf.set(key, value)
    yield frames
    for key, value in before.items():
        spark.conf.set(key, value)


def _few_parts(frames):
    """Whether records are joined where they are read, but for those that a batch or a split cuts."""
    found = frames["runs"]
    parts, whole = (found.where(f"{word} (starts AND ends)").count() for word in ("NOT", ""))
    return 0 < parts < whole / 5


def test_lines_of_a_record_are_joined_where_they_are_read(spark, tmp_path, staged):
    rows = [(i, f"A {i}\nB\nC" if i % 3 else "D") for i in range(3000)]
    with (tmp_path / "a.csv").open("w", newline="") as file:
        writer = csv.writer(file, lineterminator="\n")
        writer.writerow(FEED.names)
        writer.writerows([i, 1, name, "C", 5, 6, "2024-12-26", "Up", "7", 3, 1.5] for i, name in rows)
    decoded = sources.decode_csv(spark, str(tmp_path)).collect()
    assert sorted((r.id, r.name) for r in decoded) == rows
    assert _few_parts(staged)


def test_pieces_of_a_payload_are_joined_where_they_are_read(spark, tmp_path, staged):
    names = [f'{i} }}, {{ ] "' if i % 3 else f"{i}" for i in range(3000)]
    rank = [{**RECORD, "id": i, "name": name, "more": {"x": [i]}} for i, name in enumerate(names)]
    (tmp_path / "a.json").write_text(json.dumps({"rank": rank}))
    decoded = sources.decode_large_payload(spark, str(tmp_path)).collect()
    assert sorted((r.id, r.name) for r in decoded) == list(enumerate(names))
    assert _few_parts(staged)


def test_payloads_of_tasks_are_documents(spark, tmp_path):
    """A task without rows has none."""
    rows = spark.range(0, 9, 1, 3).where("id < 6 AND id <> 4").repartition(4, "id")
    records = rows.selectExpr("to_json(struct(id)) AS value")
    sinks.write_large_payload(records, str(tmp_path / "out"))
    texts = [f.read_text() for f in (tmp_path / "out").glob("part-*")]
    documents = [json.loads(text) for text in texts if text]
    assert sorted(r["id"] for d in documents for r in d["rank"]) == [0, 1, 2, 3, 5]
    assert all(list(d) == ["rank"] and d["rank"] for d in documents)
