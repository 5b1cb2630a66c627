"""Streams: what they take in, and that they agree with the batch forms."""

from __future__ import annotations

import base64
import json

from samples import FIRST_DAY, SECOND_DAY, with_header
from test_load import contents, lines_of, sizes

from rankloom import plans, sources, streaming
from rankloom.sinks import Warehouse

FILE = "rankings.csv"


def land(folder, run, text, name=FILE):
    (folder / f"run={run}").mkdir(parents=True, exist_ok=True)
    (folder / f"run={run}" / name).write_text(text)
    (folder / f"run={run}" / "_SUCCESS").touch()


def arrive(spark, warehouse, tmp_path, files_per_batch=None):
    lines = streaming.arriving_lines(spark, str(tmp_path / "landing"), FILE, files_per_batch)
    streaming.load_arrivals(lines, warehouse, str(tmp_path / "checkpoint")).awaitTermination()


def test_each_arrival_is_loaded_once(spark, warehouse, tmp_path):
    landing = tmp_path / "landing"
    land(landing, 1, with_header(FIRST_DAY))
    land(landing, 1, with_header(SECOND_DAY), name="other.csv")
    arrive(spark, warehouse, tmp_path)
    assert sizes(warehouse)["rankings"] == 15

    land(landing, 2, with_header(SECOND_DAY))
    arrive(spark, warehouse, tmp_path)
    assert sizes(warehouse)["rankings"] == 30
    arrive(spark, warehouse, tmp_path)
    assert sizes(warehouse)["rankings"] == 30


def test_a_marker_above_completes_folders_below_it(spark, warehouse, tmp_path):
    landing = tmp_path / "landing"
    for part, day in enumerate((FIRST_DAY, SECOND_DAY)):
        (landing / "run=1" / f"part={part}").mkdir(parents=True)
        (landing / "run=1" / f"part={part}" / FILE).write_text(with_header(day))
    (landing / "_SUCCESS").touch()
    arrive(spark, warehouse, tmp_path)
    assert sizes(warehouse)["rankings"] == 0, "the landing folder itself is no delivery"
    (landing / "run=1" / "_SUCCESS").touch()
    arrive(spark, warehouse, tmp_path)
    assert sizes(warehouse)["rankings"] == 30


def test_deliveries_there_at_once_are_one_load(spark, warehouse, tmp_path):
    """As if one after another: a date that two of them have comes from the first."""
    for run in range(12):
        day = [line.replace("2024-12-26", f"2024-12-{10 + run // 2}") for line in FIRST_DAY]
        land(tmp_path / "landing", f"{run:02d}", with_header([*day[: 15 - run % 2], f"x,{run},Ann"]))
    arrive(spark, warehouse, tmp_path)
    assert warehouse.read("commits").where("has_facts").count() == 1
    assert sizes(warehouse)["rankings"] == 6 * 15
    assert warehouse.read("rejected_lines").count() == 12
    other = Warehouse(spark, f"{warehouse.database}_single", str(tmp_path / "single"))
    for run in range(12):
        lines = sources.read_lines(spark, str(tmp_path / "landing" / f"run={run:02d}"))
        plans.load_lines(other, lines, delivery=str(run))
    assert contents(warehouse) == contents(other)
    assert streaming.arrivals.waiting(warehouse).count() == 0


def test_stream_equals_batch(spark, warehouse, tmp_path):
    for run, day in enumerate((FIRST_DAY, SECOND_DAY)):
        land(tmp_path / "landing", run, with_header(day))
    arrive(spark, warehouse, tmp_path, files_per_batch=1)
    other = Warehouse(spark, f"{warehouse.database}_batch", str(tmp_path / "batch"))
    plans.load_lines(other, lines_of(spark, FIRST_DAY + SECOND_DAY))
    assert contents(warehouse)["player_dim"] == contents(other)["player_dim"]
    assert sizes(warehouse) == sizes(other)


def test_a_replayed_batch_changes_nothing(spark, warehouse, tmp_path):
    """A new checkpoint offers every file again."""
    land(tmp_path / "landing", 1, with_header(FIRST_DAY + SECOND_DAY))
    arrive(spark, warehouse, tmp_path)
    before = contents(warehouse)
    lines = streaming.arriving_lines(spark, str(tmp_path / "landing"), FILE)
    streaming.load_arrivals(lines, warehouse, str(tmp_path / "again")).awaitTermination()
    assert contents(warehouse) == before


def message(status, timestamp, encoded=True):
    text = json.dumps({"status": status, "timestamp": timestamp})
    return base64.b64encode(text.encode()).decode() if encoded else text


def refresh(spark, warehouse, tmp_path, **options):
    messages = streaming.arriving_status(spark, str(tmp_path / "messages"))
    query = streaming.refresh_on_success(
        messages, warehouse, str(tmp_path / "status-checkpoint"), **options
    )
    query.awaitTermination()


def test_decoding(spark):
    texts = [message("success", 1.5), message("näh", 2), "no base64!", base64.b64encode(b"{}").decode()]
    frame = spark.createDataFrame([(t,) for t in texts], "value string")
    assert [tuple(r) for r in sources.decode_status(frame).collect()] == [
        ("success", 1.5),
        ("näh", 2.0),
        (None, None),
        (None, None),
    ]
    plain = spark.createDataFrame([(message("failed", 3.0, encoded=False),)], "value string")
    assert tuple(sources.decode_status(plain, encoded=False).first()) == ("failed", 3.0)


def test_only_a_success_builds_the_mart(spark, warehouse, tmp_path):
    plans.load_lines(warehouse, lines_of(spark, FIRST_DAY))
    folder = tmp_path / "messages"
    folder.mkdir()
    (folder / "1").write_text(message("failed", 1.0) + "\n")
    refresh(spark, warehouse, tmp_path)
    assert not warehouse.exists("analytics")
    (folder / "2").write_text("\n".join([message("success", 2.0), message("failed", 3.0)]) + "\n")
    refresh(spark, warehouse, tmp_path)
    assert warehouse.read("analytics").count() == 15
    assert warehouse.read("status_log").count() == 3


def test_latest_status_is_kept_by_batch(spark, warehouse, tmp_path):
    """Late batches do not win, and replayed ones are kept once."""
    folder = tmp_path / "messages"
    folder.mkdir()
    for name, times in (("1", (5.0, 4.0)), ("2", (1.0, 2.0))):
        (folder / name).write_text("\n".join(message("success", t) for t in times) + "\n")
        refresh(spark, warehouse, tmp_path, refresh=False)
    kept = sorted(r.timestamp for r in warehouse.read("status_latest").collect())
    assert kept == [2.0, 5.0]
    assert streaming.latest_status(warehouse.read("status_latest")).first().timestamp == 5.0
    for file in ("1", ".1.crc"):
        (tmp_path / "status-checkpoint" / "commits" / file).unlink()
    refresh(spark, warehouse, tmp_path, refresh=False)
    assert warehouse.read("status_log").count() == 4
    assert warehouse.read("status_latest").count() == 2


def test_the_latest_status_may_decide(spark, warehouse, tmp_path):
    plans.load_lines(warehouse, lines_of(spark, FIRST_DAY))
    folder = tmp_path / "messages"
    folder.mkdir()
    (folder / "1").write_text("\n".join([message("success", 2.0), message("failed", 3.0)]) + "\n")
    refresh(spark, warehouse, tmp_path, by_latest=True)
    assert not warehouse.exists("analytics")
    (folder / "2").write_text(message("success", 4.0) + "\n")
    refresh(spark, warehouse, tmp_path, by_latest=True)
    assert warehouse.read("analytics").count() == 15
    assert tuple(streaming.latest_status(warehouse.read("status_log")).first()) == ("success", 4.0)
