"""Table contracts: column names, order and types at both ends of the library."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_int, _long, _double = T.IntegerType(), T.LongType(), T.DoubleType()
_text, _date, _stamp = T.StringType(), T.DateType(), T.TimestampNTZType()

# The eleven columns of a feed line, in file order.
FEED = _struct(
    id=_long,
    rank=_long,
    name=_text,
    country=_text,
    rating=_long,
    points=_long,
    lastUpdatedOn=_text,
    trend=_text,
    faceImageId=_text,
    countryId=_long,
    difference=_double,
)

# The untyped landing table some users keep next to the star.
RAW_LANDING = _struct(
    id=_long,
    rank=_text,
    name=_text,
    country=_text,
    rating=_long,
    points=_long,
    lastUpdatedOn=_text,
    trend=_text,
    faceImageId=_long,
    countryId=_long,
    difference=_text,
)

# Columns of the dimensions, the facts and the mart.
PLAYER_DIM = _struct(player_id=_long, first_name=_text, last_name=_text)
PLAYER_DIM_IMAGE = _struct(player_id=_long, first_name=_text, last_name=_text, face_image_id=_text)
COUNTRY_DIM = _struct(country_id=_long, country=_text)
DATE_DIM = _struct(date_id=_long, date=_date, day_of_week=_text, month=_int, year=_int)
# The calendar with a time of day, for feeds stamped finer than a day.
DATETIME_DIM = _struct(
    date_id=_long, date=_stamp, hour=_int, day_of_week=_text, month=_int, year=_int
)
# The highest key that a load gave.
DATETIME_LAST = _struct(date_id=_long)
RANKINGS = _struct(
    player_id=_long,
    country_id=_long,
    date_id=_long,
    rank=_long,
    rating=_long,
    points=_long,
    difference=_double,
    trend=_text,
)
ANALYTICS = _struct(
    player_id=_long,
    country_id=_long,
    date_id=_long,
    rank=_long,
    rating=_long,
    points=_long,
    difference=_double,
    trend=_text,
    first_name=_text,
    last_name=_text,
    country=_text,
    date=_date,
    day_of_week=_text,
    month=_int,
    year=_int,
)
REJECTED_LINES = _struct(raw_line=_text, reject_reason=_text)
# Folders in which files were seen, below what landing folder, and those loaded.
ARRIVALS = _struct(delivery=_text, file_name=_text, landing=_text)
DELIVERIES = _struct(delivery=_text, file_name=_text)
STATUS = _struct(status=_text, timestamp=_double)

# The manifest: one row for each load whose rows count, and if it brought facts in.
COMMITS = _struct(load_key=_long, name=_text, has_facts=T.BooleanType())
# Which refresh of the mart holds the rows of which load, and of what kind they are.
MART_PARTS = _struct(facts_key=_long, refresh_key=_long, kind=_text)

# Columns that tables are partitioned by, besides the contract: the load that wrote a row
# and, of dimensions, a bucket of the key, so that a load reads those it touches.
LOAD, BUCKET, BUCKETS = "load_key", "bucket", 32
# The calendar with a time of day has no bound; a load reads the months it touches.
MONTH = "month_key"
_BY_LOAD, _BY_BUCKET, _BY_MONTH = (LOAD,), (LOAD, BUCKET), (LOAD, MONTH)

# Tables a warehouse holds, each with its partition columns.
TABLES = {
    "player_dim": (PLAYER_DIM, _BY_BUCKET),
    "country_dim": (COUNTRY_DIM, _BY_BUCKET),
    "date_dim": (DATE_DIM, _BY_LOAD),
    "datetime_dim": (DATETIME_DIM, _BY_MONTH),
    "datetime_last": (DATETIME_LAST, _BY_LOAD),
    "rankings": (RANKINGS, _BY_LOAD),
    "analytics": (ANALYTICS, ()),
    "analytics_rows": (ANALYTICS, ("refresh_key", "facts_key")),
    "mart_parts": (MART_PARTS, ()),
    "status_log": (STATUS, _BY_LOAD),
    "status_latest": (STATUS, _BY_LOAD),
    "raw_landing": (RAW_LANDING, ()),
    "rejected_lines": (REJECTED_LINES, _BY_LOAD),
    "arrivals": (ARRIVALS, _BY_LOAD),
    "deliveries": (DELIVERIES, _BY_LOAD),
    "commits": (COMMITS, ()),
}

# Defaults for the only three columns that are filled.
DEFAULTS = {"difference": 0.0, "trend": "Flat", "faceImageId": "0"}

# The words pandas' CSV reader takes for a missing value.
NA_WORDS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)
