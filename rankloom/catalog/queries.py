"""One registered query per operator of the library."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce, wraps
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom import operators as ops
from rankloom import plans, sinks, sources, streaming
from rankloom.catalog.feed import feed, spread, table
from rankloom.functions import coerce_date, csv_line, epoch_seconds, iso_text
from rankloom.schemas import FEED, RANKINGS
from rankloom.session import tune
from rankloom.staging import fresh_folder, stage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The test feed up to here stands for what was loaded before.
LOADED_BEFORE = "1998-01-01"


def query(function: Query) -> Query:
    """Register under the function's own name, in a tuned session."""

    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(tune(spark), sf_dir)

    QUERIES[function.__name__] = run
    return run


def _filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.fill_defaults(feed(spark, sf_dir))


def _star(spark: SparkSession, sf_dir: str, distinct_facts: bool = True) -> plans.Star:
    return plans.build_star(_filled(spark, sf_dir), distinct_facts)


def _known(rows: DataFrame) -> DataFrame:
    earlier = rows.where(F.col("updated_on") < F.lit(LOADED_BEFORE).cast("date"))
    return stage(ops.date_dim(earlier), "known")


@contextmanager
def _warehouse(spark: SparkSession) -> Iterator[sinks.Warehouse]:
    """A database of its own, gone from the catalog when the query is built."""
    name = f"rankloom_{uuid4().hex}"
    store = sinks.Warehouse(spark, name, fresh_folder(spark, name))
    try:
        yield store
    finally:
        spark.sql(f"DROP DATABASE `{name}` CASCADE")


def _landed(spark: SparkSession, sf_dir: str) -> str:
    path = f"{fresh_folder(spark, 'landing')}/feed"
    sinks.write_feed_csv(feed(spark, sf_dir), path)
    return path


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed(spark, sf_dir).select(csv_line(*FEED.names).alias("value"))


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as encoded status messages; a purchase stands for a success."""
    kind = F.col("event_type")
    status = F.when(kind == "purchase", streaming.status.SUCCESS).otherwise(kind)
    return spread(table(spark, sf_dir, "events")).select(
        sources.encode_status(status, epoch_seconds(F.col("ts"))).alias("value")
    )


# --- scans -----------------------------------------------------------------


@query
def feed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.read_feed_csv(spark, _landed(spark, sf_dir))


@query
def csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = sources.read_lines(spark, _landed(spark, sf_dir))
    return sources.accepted(sources.decode_lines(lines))


@query
def line_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.rejected(sources.decode_lines(_spoilt_lines(spark, sf_dir)))


def _spoilt_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines spoilt by their own data: a field too many, or text for a number."""
    line = csv_line(*FEED.names)
    text_rating = csv_line(
        *[F.lit("high").alias(c) if c == "rating" else F.col(c) for c in FEED.names]
    )
    spoilt = (
        F.when(F.col("trend").isNull(), F.concat(line, F.lit(",surplus")))
        .when(F.col("faceImageId").isNull(), text_rating)
        .otherwise(line)
    )
    path = f"{fresh_folder(spark, 'spoilt')}/lines"
    sinks.write_lines(feed(spark, sf_dir).select(spoilt.alias("value")), path)
    return sources.read_lines(spark, path)


@query
def rejects_by_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line twice in one load, once in another, and in a delivery taken up twice."""
    lines = _spoilt_lines(spark, sf_dir)
    with _warehouse(spark) as store:
        plans.load_lines(store, lines.unionByName(lines))
        plans.load_lines(store, lines)
        for _ in range(2):
            plans.load_lines(store, lines, delivery="run=1")
        return stage(store.read("rejected_lines"), "result")


@query
def payload_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order's document holds its record twice: as it is, and a day later."""
    row = [F.col(c).cast("string").alias(c) if c != "difference" else F.col(c) for c in FEED.names]
    later = iso_text(F.date_add(F.col("lastUpdatedOn").cast("date"), 1)).alias("lastUpdatedOn")
    moved = [later if c == "lastUpdatedOn" else row[i] for i, c in enumerate(FEED.names)]
    body = F.to_json(F.struct(F.array(F.struct(*row), F.struct(*moved)).alias("rank")))
    rows = feed(spark, sf_dir)
    texts = rows.select(body.alias("value")).union(rows.select(F.lit("{}")))
    return sources.flatten_payload(texts)


@query
def payload_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with one document each, of the records of one task; cut by splits when read."""
    path = f"{fresh_folder(spark, 'payload')}/documents"
    records = feed(spark, sf_dir).select(F.to_json(F.struct(*FEED.names)).alias("value"))
    sinks.write_large_payload(records, path)
    return sources.accepted(sources.decode_large_payload(spark, path))


def _payload_text(**changed: Column) -> Column:
    """A document with one record, some of its values replaced."""
    values = [changed.get(c, F.col(c).cast("string")).alias(c) for c in FEED.names]
    return F.to_json(F.struct(F.array(F.struct(*values)).alias("rank")))


def _spoilt_payload() -> Column:
    """Broken documents, records that hold text for a number, and good ones."""
    return (
        F.when(F.col("trend") == "Up", F.concat(F.lit("{broken "), F.col("id")))
        .when(F.col("trend") == "Down", _payload_text(rating=F.lit("high")))
        .otherwise(_payload_text())
    )


@query
def payload_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{fresh_folder(spark, 'payload')}/documents"
    sinks.write_lines(feed(spark, sf_dir).select(_spoilt_payload().alias("value")), path)
    texts = sources.read_payload(spark, path, one_per_file=False)
    decoded = sources.decode_payload(texts)
    return sources.rejected(decoded).groupBy("reject_reason").agg(F.count("*").alias("n"))


@query
def payload_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload files land as CSV and load into the star."""
    folder = fresh_folder(spark, "payload")
    sinks.write_lines(feed(spark, sf_dir).select(_payload_text().alias("value")), f"{folder}/json")
    with _warehouse(spark) as store:
        texts = sources.read_payload(spark, f"{folder}/json", one_per_file=False)
        plans.land_payload(texts, f"{folder}/landed", store)
        plans.load_lines(store, sources.read_lines(spark, f"{folder}/landed"))
        return stage(store.read("rankings"), "result")


@query
def status_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that are no base64, no JSON or have no status, with their text."""
    kind = F.col("event_type")
    text = (
        F.when(kind == "click", F.concat(F.lit("?"), F.col("event_id")))
        .when(kind == "view", F.base64(F.encode(F.concat(F.lit("{"), F.col("event_id")), "UTF-8")))
        .otherwise(F.base64(F.encode(F.lit("{}"), "UTF-8")))
    )
    messages = table(spark, sf_dir, "events").select(text.alias("value"))
    rejects = sources.rejected_status(messages)
    return rejects.groupBy("reject_reason").agg(F.count("*").alias("n"))


@query
def feed_scan_reordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns in another order, one left out, and whole numbers written as decimals."""
    names = ["difference", *[n for n in reversed(FEED.names) if n not in ("difference", "trend")]]
    decimals = {"rank", "rating", "points"}
    columns = [
        F.concat(F.col(n), F.lit(".0")).alias(n) if n in decimals else F.col(n) for n in names
    ]
    path = f"{fresh_folder(spark, 'reordered')}/feed"
    feed(spark, sf_dir).select(*columns).write.csv(path, header=True)
    return sources.read_feed_csv(spark, path)


@query
def csv_line_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that hold line breaks and quotes, written as CSV and read again."""
    broken = F.concat(F.lit('"'), F.replace("name", F.lit(" "), F.lit("\n")), F.lit('",\r\n'))
    name = F.when(F.col("id") % 3 == 0, broken).otherwise(F.col("name"))
    path = f"{fresh_folder(spark, 'broken')}/feed"
    sinks.write_feed_csv(feed(spark, sf_dir).withColumn("name", name), path)
    return sources.read_feed_csv(spark, path)


@query
def table_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = _star(spark, sf_dir, distinct_facts=False).rankings
    return ops.preview(facts.distinct(), 10, *RANKINGS.names)


@query
def table_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.preview(ops.date_dim(_filled(spark, sf_dir)), 5, "date_id")


@query
def status_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streaming.status.successes(sources.decode_status(_messages(spark, sf_dir)))


# --- projections, filters, functions ----------------------------------------


@query
def missing_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filled(spark, sf_dir)


@query
def coerce_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates in ISO form, in day/month/year form, and unreadable ones."""
    iso = F.col("lastUpdatedOn")
    text = (
        F.when(F.col("trend") == "Up", F.date_format(iso.cast("date"), "dd/MM/yyyy"))
        .when(F.col("trend") == "Down", F.concat(F.lit("on "), iso))
        .otherwise(iso)
    )
    rows = feed(spark, sf_dir).select("id", "points", text.alias("written"))
    return rows.select(
        "*",
        coerce_date(F.col("written")).alias("iso_date"),
        coerce_date(F.col("written"), ["dd/MM/yyyy"]).alias("any_date"),
    )


@query
def date_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filled(spark, sf_dir).select("id", "points", iso_text(F.col("updated_on")).alias("day"))


@query
def date_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.datetime_dim(table(spark, sf_dir, "events"), "ts")


@query
def country_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed(spark, sf_dir).where("country = 'NATION_3'")


@query
def jsonl_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{fresh_folder(spark, 'records')}/jsonl"
    sinks.write_json_records(ops.json_records(_lines(spark, sf_dir)), path)
    return sources.read_lines(spark, path).withColumnRenamed("value", "record")


# --- star -------------------------------------------------------------------


@query
def player_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.player_dim(_filled(spark, sf_dir))


@query
def player_dim_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.player_dim(feed(spark, sf_dir), with_image=True)


@query
def country_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.country_dim(_filled(spark, sf_dir))


@query
def date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.date_dim(_filled(spark, sf_dir))


@query
def new_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _filled(spark, sf_dir)
    return ops.new_dates(rows, _known(rows))


@query
def incremental_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _filled(spark, sf_dir)
    return ops.only_new(rows, _known(rows))


@query
def incremental_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stage(_filled(spark, sf_dir), "rows")
    known = _known(rows)
    dates = stage(ops.new_dates(rows, known), "dates")
    return ops.rankings(ops.only_new(rows, known), dates)


@query
def rankings_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _filled(spark, sf_dir)
    return ops.rankings(rows, stage(ops.date_dim(rows), "dates"))


def _timed_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = F.concat_ws(" ", "lastUpdatedOn", F.format_string("%02d:00:00", "rank"))
    return feed(spark, sf_dir).withColumn("lastUpdatedOn", timed)


@query
def datetime_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The star stamped by time: each row at an hour of its own rank."""
    rows = stage(ops.fill_defaults(_timed_feed(spark, sf_dir), keep_time=True), "rows")
    return ops.rankings(rows, stage(ops.datetime_dim(rows, "updated_on"), "dates"))


@query
def tagged_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = _tagged(spark, sf_dir)
    return tagged.groupBy("type").agg(F.count("*").alias("n"))


@query
def tagged_rankings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.records_of(ops.stage_tagged(_tagged(spark, sf_dir)), "ranking", RANKINGS)


def _tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stage(_filled(spark, sf_dir), "rows")
    return ops.tag_rows(rows, stage(ops.date_dim(rows), "dates"))


# --- mart and reports -------------------------------------------------------


@query
def analytics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.analytics(_star(spark, sf_dir, distinct_facts=False))


@query
def analytics_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.analytics_distinct(_star(spark, sf_dir, distinct_facts=False))


@query
def team_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.team_performance(analytics(spark, sf_dir))


@query
def score_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.score_distribution(analytics(spark, sf_dir))


@query
def trend_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.trend_by_month(analytics(spark, sf_dir))


@query
def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.profile(feed(spark, sf_dir), "lastUpdatedOn")


@query
def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.column_profile(feed(spark, sf_dir))


@query
def latest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streaming.latest_status(sources.decode_status(_messages(spark, sf_dir)))


@query
def param_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed value, table name and frame handed to one SQL text."""
    rows = _filled(spark, sf_dir)
    facts = ops.rankings(rows, stage(ops.date_dim(rows), "dates"))
    text = """
        SELECT c.country, r.player_id, r.points
        FROM {facts} r JOIN IDENTIFIER(:countries) c ON r.country_id = c.country_id
        WHERE r.points >= :parameter
    """
    with _warehouse(spark) as store:
        store.append("country_dim", ops.country_dim(rows))
        args = {"parameter": 400, "countries": store.name("country_dim")}
        return stage(sinks.run_sql(spark, text, args, facts=facts), "result")


# --- sinks ------------------------------------------------------------------


@query
def csv_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.without_headers(sources.read_lines(spark, _landed(spark, sf_dir)))


@query
def raw_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    with _warehouse(spark) as store:
        store.append("raw_landing", feed(spark, sf_dir))
        return stage(store.read("raw_landing"), "result")


@query
def append_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = stage(_star(spark, sf_dir).rankings, "facts")
    with _warehouse(spark) as store:
        store.append("rankings", facts)
        store.append("rankings", facts)
        return stage(store.read("rankings"), "result")


@query
def incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The earlier part of the feed, then all of it: only what is new comes in."""
    rows = feed(spark, sf_dir)
    with _warehouse(spark) as store:
        plans.load_rows(store, rows.where(F.col("lastUpdatedOn") < LOADED_BEFORE))
        plans.load_rows(store, rows)
        return stage(store.read("rankings"), "result")


@query
def incremental_datetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`incremental_load` of the star stamped by time."""
    rows = _timed_feed(spark, sf_dir)
    with _warehouse(spark) as store:
        plans.load_rows(store, rows.where(F.col("lastUpdatedOn") < LOADED_BEFORE), timed=True)
        plans.load_rows(store, rows, timed=True)
        return stage(store.read("rankings"), "result")


@query
def stored_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimensions and the calendar after two loads, as one column of text."""
    rows = feed(spark, sf_dir)
    with _warehouse(spark) as store:
        plans.load_rows(store, rows.where(F.col("lastUpdatedOn") < LOADED_BEFORE))
        plans.load_rows(store, rows)
        tables = [
            store.read(name).select(
                F.lit(name).alias("table_name"),
                F.concat_ws("|", *[F.col(c).cast("string") for c in store.read(name).columns]).alias(
                    "stored"
                ),
            )
            for name in ("player_dim", "country_dim", "date_dim")
        ]
        return stage(reduce(DataFrame.unionByName, tables), "result")


@query
def undated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads with unreadable dates in both: what became of every row."""
    undated = F.when(F.col("trend") == "Up", F.concat(F.lit("on "), F.col("lastUpdatedOn")))
    rows = feed(spark, sf_dir).withColumn("first", F.col("lastUpdatedOn") < LOADED_BEFORE)
    rows = rows.withColumn("lastUpdatedOn", F.coalesce(undated, F.col("lastUpdatedOn")))
    with _warehouse(spark) as store:
        plans.load_rows(store, rows.where("first").drop("first"))
        plans.load_rows(store, rows.where("NOT first").drop("first"))
        facts = store.read("rankings").select(F.lit("fact").alias("became"))
        rejects = store.read("rejected_lines").select(F.col("reject_reason").alias("became"))
        found = facts.unionByName(rejects).groupBy("became").agg(F.count("*").alias("n"))
        return stage(found, "result")


@query
def sql_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file with a bound value and a table name, read where the cluster reads files."""
    rows = _filled(spark, sf_dir)
    path = f"{fresh_folder(spark, 'sql')}/query"
    text = (
        "SELECT country_id, country FROM IDENTIFIER(:countries) "
        "WHERE country_id >= :parameter ORDER BY country_id"
    )
    sinks.write_lines(spark.range(1).select(F.lit(text).alias("value")), path)
    with _warehouse(spark) as store:
        store.append("country_dim", ops.country_dim(rows))
        args = {"parameter": 10, "countries": store.name("country_dim")}
        return stage(sinks.run_sql_file(spark, path, args), "result")


@query
def replace_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart of the earlier part, replaced by the mart of the whole."""
    rows = feed(spark, sf_dir)
    with _warehouse(spark) as store:
        plans.load_rows(store, rows.where(F.col("lastUpdatedOn") < LOADED_BEFORE))
        plans.replace_analytics(store)
        plans.load_rows(store, rows)
        plans.replace_analytics(store)
        return stage(store.read("analytics"), "result")


@query
def mart_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart brought up after each of three loads, the last of which renames players."""
    rows = feed(spark, sf_dir)
    day = F.col("lastUpdatedOn")
    renamed = F.when(F.col("id") % 7 == 0, F.concat(F.lit("A"), "name")).otherwise(F.col("name"))
    with _warehouse(spark) as store:
        for part in (
            rows.where(day < "1995-01-01"),
            rows.where(day.between("1995-01-01", "1997-12-31")),
            rows.where(day >= LOADED_BEFORE).withColumn("name", renamed),
        ):
            plans.load_rows(store, part)
            plans.refresh_analytics(store)
        return stage(store.read("analytics"), "result")


@query
def drop_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows each stored table had, and whether it is still there after the drop."""
    names = ["player_dim", "country_dim", "date_dim", "rankings", "analytics"]
    with _warehouse(spark) as store:
        plans.load_rows(store, feed(spark, sf_dir))
        plans.refresh_analytics(store)
        counts = [
            store.read(name).agg(F.lit(name).alias("table_name"), F.count("*").alias("n_rows"))
            for name in names
        ]
        held = stage(reduce(DataFrame.unionByName, counts), "held")
        store.drop(names)
        left = [name for name in names if store.exists(name)]
    return held.withColumn("still_there", F.col("table_name").isin(left))


# --- streams ----------------------------------------------------------------


@query
def arrival_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries, each taken in by a run of its own; other files are ignored."""
    folder = fresh_folder(spark, "arrivals")
    rows = feed(spark, sf_dir)
    earlier = F.col("lastUpdatedOn") < LOADED_BEFORE
    with _warehouse(spark) as store:
        for run, part in enumerate((rows.where(earlier), rows.where(~earlier))):
            sinks.write_feed_csv(part, f"{folder}/landing/run={run}")
            sinks.write_lines(_lines(spark, sf_dir), f"{folder}/landing/run={run}/notes")
            lines = streaming.arriving_lines(spark, f"{folder}/landing", "part-*.csv")
            streaming.load_arrivals(lines, store, f"{folder}/checkpoint").awaitTermination()
        return stage(store.read("rankings"), "result")


@query
def arrival_stream_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days that lie in many files, taken in one file at a time."""
    folder = fresh_folder(spark, "bounded")
    rows = feed(spark, sf_dir)
    with _warehouse(spark) as store:
        sinks.write_feed_csv(rows.repartition(4, "id"), f"{folder}/landing/run=1")
        lines = streaming.arriving_lines(spark, f"{folder}/landing", "part-*.csv", 1)
        streaming.load_arrivals(lines, store, f"{folder}/checkpoint").awaitTermination()
        return stage(store.read("rankings"), "result")


@query
def arrivals_together(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifty deliveries there at once under one marker; two have each date, with other points."""
    folder = fresh_folder(spark, "together")
    rows = feed(spark, sf_dir)
    run = F.pmod(F.unix_date(F.col("lastUpdatedOn").cast("date")), F.lit(50))
    first, second = rows.withColumn("run", run), rows.withColumn("run", (run + 1) % 50)
    both = first.unionByName(second.withColumn("points", F.col("points") + 1))
    lines = both.select(csv_line(*FEED.names).alias("value"), F.format_string("%02d", "run").alias("run"))
    lines.repartition("run").write.partitionBy("run").text(f"{folder}/landing/day=1")
    with _warehouse(spark) as store:
        arriving = streaming.arriving_lines(spark, f"{folder}/landing", "part-*.txt")
        streaming.load_arrivals(arriving, store, f"{folder}/checkpoint").awaitTermination()
        return stage(store.read("rankings"), "result")


@query
def status_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message twice, in batches of one file: each is kept as often as it came."""
    folder = fresh_folder(spark, "history")
    messages = _messages(spark, sf_dir)
    sinks.write_lines(messages, f"{folder}/messages/1")
    sinks.write_lines(messages, f"{folder}/messages/2")
    arriving = streaming.arriving_status(spark, f"{folder}/messages/*")
    with _warehouse(spark) as store:
        streaming.keep_status(arriving, store, f"{folder}/checkpoint").awaitTermination()
        return stage(store.read("status_log"), "result")


@query
def status_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The star is stored, the messages arrive, a success among them builds the mart."""
    folder = fresh_folder(spark, "status")
    sinks.write_lines(_messages(spark, sf_dir), f"{folder}/messages")
    messages = streaming.arriving_status(spark, f"{folder}/messages")
    with _warehouse(spark) as store:
        plans.load_rows(store, feed(spark, sf_dir))
        streaming.refresh_on_success(messages, store, f"{folder}/checkpoint").awaitTermination()
        return stage(store.read("analytics"), "result")


@query
def latest_status_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stateful form of `latest_status`, its last state written out."""
    folder = fresh_folder(spark, "latest")
    sinks.write_lines(_messages(spark, sf_dir), f"{folder}/messages")
    messages = streaming.arriving_status(spark, f"{folder}/messages")
    newest = streaming.track_latest_status(messages)

    def keep(state: DataFrame, batch_id: int) -> None:
        state.write.mode("overwrite").parquet(f"{folder}/state/batch={batch_id}")

    (
        newest.writeStream.outputMode("complete")
        .foreachBatch(keep)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    states = spark.read.parquet(f"{folder}/state")
    return states.orderBy(F.desc("batch")).limit(1).select("status", "timestamp")
