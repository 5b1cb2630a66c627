"""SQL with the same result as each registered query, in DuckDB's dialect."""

from __future__ import annotations

_FEED = """
feed AS (
  SELECT o.o_custkey AS id,
         CAST(substr(o.o_orderpriority, 1, 1) AS BIGINT) AS rank,
         replace(c.c_name, '#', ' ') AS name,
         n.n_name AS country,
         CAST(floor(o.o_totalprice / 1000) AS BIGINT) AS rating,
         CAST(floor(o.o_totalprice / 1000) AS BIGINT) AS points,
         CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR) AS "lastUpdatedOn",
         CASE o.o_orderstatus WHEN 'F' THEN 'Up' WHEN 'P' THEN 'Down' END AS trend,
         CASE WHEN o.o_orderkey % 5 <> 0
              THEN CAST(o.o_custkey + 300000 AS VARCHAR) END AS "faceImageId",
         CAST(c.c_nationkey AS BIGINT) AS "countryId",
         CASE WHEN o.o_orderstatus <> 'O'
              THEN CAST(o.o_orderkey % 7 - 3 AS DOUBLE) END AS difference
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

_FILLED = """
filled AS (
  SELECT id, rank, name, country, rating, points, coalesce(trend, 'Flat') AS trend,
         coalesce("faceImageId", '0') AS "faceImageId", "countryId",
         coalesce(difference, 0.0) AS difference,
         CASE WHEN TRY_CAST("lastUpdatedOn" AS DATE)
                   BETWEEN DATE '1677-09-22' AND DATE '2262-04-11'
              THEN TRY_CAST("lastUpdatedOn" AS DATE) END AS updated_on
  FROM feed
)"""

_STAR = """
date_dim AS (
  SELECT CAST(row_number() OVER (ORDER BY updated_on NULLS LAST) AS BIGINT) AS date_id,
         updated_on AS date, dayname(updated_on) AS day_of_week,
         CAST(month(updated_on) AS INTEGER) AS month, CAST(year(updated_on) AS INTEGER) AS year
  FROM (SELECT DISTINCT updated_on FROM filled)
),
player_dim AS (
  SELECT DISTINCT id AS player_id, string_split(name, ' ')[1] AS first_name,
         array_to_string(string_split(name, ' ')[2:], ' ') AS last_name
  FROM filled
),
country_dim AS (SELECT DISTINCT "countryId" AS country_id, country FROM filled),
rankings AS (
  SELECT DISTINCT f.id AS player_id, f."countryId" AS country_id, d.date_id, f.rank, f.rating,
         f.points, f.difference, f.trend
  FROM filled f LEFT JOIN date_dim d ON f.updated_on IS NOT DISTINCT FROM d.date
)"""

_MART = """
joined AS (
  SELECT r.*, p.first_name, p.last_name, c.country, d.date, d.day_of_week, d.month, d.year
  FROM rankings r
  JOIN player_dim p USING (player_id)
  JOIN country_dim c USING (country_id)
  JOIN date_dim d USING (date_id)
),
analytics AS (
  SELECT * FROM joined
  QUALIFY row_number() OVER (
    PARTITION BY player_id, date_id
    ORDER BY rank DESC NULLS LAST, points DESC NULLS LAST, rating DESC NULLS LAST,
             difference DESC NULLS LAST, trend NULLS FIRST, country_id, country, date,
             first_name, last_name
  ) = 1
)"""

_STATUS = """
messages AS (
  SELECT CASE event_type WHEN 'purchase' THEN 'success' ELSE event_type END AS status,
         CAST(epoch_us(ts) AS DOUBLE) / 1e6 AS timestamp
  FROM events
)"""

_LINE_PARTS = (
    "CAST(id AS VARCHAR)",
    "CAST(rank AS VARCHAR)",
    "name",
    "country",
    "CAST(rating AS VARCHAR)",
    "CAST(points AS VARCHAR)",
    '"lastUpdatedOn"',
    "coalesce(trend, '')",
    "coalesce(\"faceImageId\", '')",
    'CAST("countryId" AS VARCHAR)',
    "coalesce(CAST(difference AS VARCHAR), '')",
)
_NAMES = (
    "id",
    "rank",
    "name",
    "country",
    "rating",
    "points",
    "lastUpdatedOn",
    "trend",
    "faceImageId",
    "countryId",
    "difference",
)
_LINE = " || ',' || ".join(_LINE_PARTS)
_TEXT_RATING = " || ',' || ".join("'high'" if "rating" in p else p for p in _LINE_PARTS)
_JSON = (
    "'{' || "
    + " || ',' || ".join(f"'\"{n}\":\"' || {p} || '\"'" for n, p in zip(_NAMES, _LINE_PARTS))
    + " || '}'"
)


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


_ON_FEED = _with(_FEED)
_ON_FILLED = _with(_FEED, _FILLED)
_ON_STAR = _with(_FEED, _FILLED, _STAR)
_ON_MART = _with(_FEED, _FILLED, _STAR, _MART)
_ON_STATUS = _with(_STATUS)

_NEW = "date >= DATE '1998-01-01'"

ORACLE: dict[str, str] = {
    "feed_scan": _ON_FEED + "SELECT * FROM feed",
    "csv_lines": _ON_FEED + "SELECT * FROM feed",
    "line_rejects": _ON_FEED
    + f"""
SELECT {_LINE} || ',surplus' AS raw_line, 'too many fields' AS reject_reason
FROM feed WHERE trend IS NULL
UNION ALL
SELECT {_TEXT_RATING}, 'not a number'
FROM feed WHERE trend IS NOT NULL AND "faceImageId" IS NULL""",
    "payload_flatten": _ON_FEED
    + """
SELECT * FROM feed
UNION ALL
SELECT * REPLACE (CAST(CAST("lastUpdatedOn" AS DATE) + 1 AS VARCHAR) AS "lastUpdatedOn")
FROM feed""",
    "payload_large": _ON_FEED + "SELECT * FROM feed",
    "payload_rejects": _ON_FEED
    + """
SELECT CASE trend WHEN 'Up' THEN 'broken document' ELSE 'not a number' END AS reject_reason,
       count(*) AS n
FROM feed WHERE trend IS NOT NULL GROUP BY 1""",
    "payload_files": _ON_STAR + "SELECT * FROM rankings",
    "status_rejects": """
SELECT CASE event_type WHEN 'click' THEN 'not base64' WHEN 'view' THEN 'no JSON'
       ELSE 'no status' END AS reject_reason, count(*) AS n
FROM events GROUP BY 1""",
    "feed_scan_reordered": _ON_FEED
    + "SELECT * REPLACE (CAST(NULL AS VARCHAR) AS trend) FROM feed",
    "table_preview": _ON_STAR
    + """
SELECT * FROM rankings
ORDER BY player_id, country_id, date_id, rank, rating, points, difference, trend LIMIT 10""",
    "table_head": _ON_STAR + "SELECT * FROM date_dim ORDER BY date_id LIMIT 5",
    "status_gate": _ON_STATUS + "SELECT * FROM messages WHERE status = 'success'",
    "missing_defaults": _ON_FILLED + "SELECT * FROM filled",
    "coerce_dates": _ON_FEED
    + """,
written AS (
  SELECT id, points, CAST("lastUpdatedOn" AS DATE) AS day,
         CASE trend WHEN 'Up' THEN strftime(CAST("lastUpdatedOn" AS DATE), '%d/%m/%Y')
                    WHEN 'Down' THEN 'on ' || "lastUpdatedOn"
                    ELSE "lastUpdatedOn" END AS written
  FROM feed
)
SELECT id, points, written, TRY_CAST(written AS DATE) AS iso_date,
       coalesce(TRY_CAST(written AS DATE),
                CAST(try_strptime(written, '%d/%m/%Y') AS DATE)) AS any_date
FROM written""",
    "date_format": _ON_FILLED
    + "SELECT id, points, strftime(updated_on, '%Y-%m-%d') AS day FROM filled",
    "date_hour": """
SELECT CAST(row_number() OVER (ORDER BY ts) AS BIGINT) AS date_id, ts AS date,
       CAST(hour(ts) AS INTEGER) AS hour, dayname(ts) AS day_of_week,
       CAST(month(ts) AS INTEGER) AS month, CAST(year(ts) AS INTEGER) AS year
FROM (SELECT DISTINCT ts FROM events)""",
    "country_filter": _ON_FEED + "SELECT * FROM feed WHERE country = 'NATION_3'",
    "jsonl_records": _ON_FEED + f"SELECT {_JSON} AS record FROM feed",
    "player_dim": _ON_STAR + "SELECT * FROM player_dim",
    "player_dim_image": _ON_FEED
    + """
SELECT DISTINCT id AS player_id, string_split(name, ' ')[1] AS first_name,
       array_to_string(string_split(name, ' ')[2:], ' ') AS last_name,
       "faceImageId" AS face_image_id
FROM feed""",
    "country_dim": _ON_STAR + "SELECT * FROM country_dim",
    "date_dim": _ON_STAR + "SELECT * FROM date_dim",
    "new_dates": _ON_STAR + f"SELECT * FROM date_dim WHERE {_NEW}",
    "incremental_rows": _ON_FILLED
    + """,
known AS (SELECT DISTINCT updated_on AS loaded FROM filled WHERE updated_on < DATE '1998-01-01')
SELECT * FROM filled
WHERE NOT EXISTS (SELECT 1 FROM known WHERE loaded IS NOT DISTINCT FROM updated_on)""",
    "incremental_fact": _ON_STAR
    + f"SELECT * FROM rankings WHERE date_id IN (SELECT date_id FROM date_dim WHERE {_NEW})",
    "rankings_fact": _ON_STAR + "SELECT * FROM rankings",
    "datetime_fact": _ON_FEED
    + """,
timed AS (
  SELECT *, CAST("lastUpdatedOn" || ' 0' || rank || ':00:00' AS TIMESTAMP) AS stamp FROM feed
),
stamps AS (
  SELECT stamp, CAST(row_number() OVER (ORDER BY stamp) AS BIGINT) AS date_id
  FROM (SELECT DISTINCT stamp FROM timed)
)
SELECT DISTINCT id AS player_id, "countryId" AS country_id, date_id, rank, rating, points,
       coalesce(difference, 0.0) AS difference, coalesce(trend, 'Flat') AS trend
FROM timed JOIN stamps USING (stamp)""",
    "tagged_counts": _ON_STAR
    + """
SELECT 'player' AS type, count(*) AS n FROM player_dim
UNION ALL SELECT 'country', count(*) FROM country_dim
UNION ALL SELECT 'date', count(*) FROM date_dim
UNION ALL SELECT 'ranking', count(*) FROM rankings""",
    "tagged_rankings": _ON_STAR + "SELECT * FROM rankings",
    "analytics": _ON_MART + "SELECT * FROM analytics",
    "analytics_distinct": _ON_MART + "SELECT DISTINCT * FROM joined",
    "team_performance": _ON_MART
    + """
SELECT country, count(*) AS n_rankings, count(DISTINCT player_id) AS n_players,
       min(rank) AS best_rank, max(rating) AS top_rating, avg(rating) AS avg_rating
FROM analytics GROUP BY country""",
    "score_distribution": _ON_MART
    + """
SELECT CAST(floor(rating / 50.0) * 50 AS BIGINT) AS rating_from, count(*) AS n_rankings
FROM analytics GROUP BY 1""",
    "trend_by_month": _ON_MART
    + """
SELECT year, month, trend, count(*) AS n_rankings, avg(rating) AS avg_rating
FROM analytics GROUP BY year, month, trend""",
    "profile": _ON_FEED
    + "SELECT count(*) AS n_rows, 11 AS n_columns, "
    + ", ".join(f'count("{n}") AS "{n}_filled"' for n in _NAMES)
    + ', count(DISTINCT "lastUpdatedOn") AS "lastUpdatedOn_distinct" FROM feed',
    "column_profile": _ON_FEED
    + """
SELECT 0 AS position, 'id' AS column_name, 'bigint' AS dtype, count(id) AS filled FROM feed
UNION ALL SELECT 1, 'rank', 'bigint', count(rank) FROM feed
UNION ALL SELECT 2, 'name', 'string', count(name) FROM feed
UNION ALL SELECT 3, 'country', 'string', count(country) FROM feed
UNION ALL SELECT 4, 'rating', 'bigint', count(rating) FROM feed
UNION ALL SELECT 5, 'points', 'bigint', count(points) FROM feed
UNION ALL SELECT 6, 'lastUpdatedOn', 'string', count("lastUpdatedOn") FROM feed
UNION ALL SELECT 7, 'trend', 'string', count(trend) FROM feed
UNION ALL SELECT 8, 'faceImageId', 'string', count("faceImageId") FROM feed
UNION ALL SELECT 9, 'countryId', 'bigint', count("countryId") FROM feed
UNION ALL SELECT 10, 'difference', 'double', count(difference) FROM feed""",
    "latest_status": _ON_STATUS
    + "SELECT * FROM messages ORDER BY timestamp DESC, status DESC LIMIT 1",
    "param_query": _ON_STAR
    + """
SELECT country, player_id, points FROM rankings JOIN country_dim USING (country_id)
WHERE points >= 400""",
    "csv_sink": _ON_FEED + f"SELECT {_LINE} AS value FROM feed",
    "raw_landing": _ON_FEED
    + """
SELECT id, CAST(rank AS VARCHAR) AS rank, name, country, CAST(rating AS BIGINT) AS rating,
       CAST(points AS BIGINT) AS points, "lastUpdatedOn", trend,
       CAST("faceImageId" AS BIGINT) AS "faceImageId", "countryId",
       CAST(difference AS VARCHAR) AS difference
FROM feed""",
    "append_sink": _ON_STAR + "SELECT * FROM rankings UNION ALL SELECT * FROM rankings",
    "incremental_load": _ON_STAR + "SELECT * FROM rankings",
    "stored_star": _ON_STAR
    + """
SELECT 'player_dim' AS table_name, concat_ws('|', player_id, first_name, last_name) AS stored
FROM player_dim
UNION ALL SELECT 'country_dim', concat_ws('|', country_id, country) FROM country_dim
UNION ALL SELECT 'date_dim', concat_ws('|', date_id, date, day_of_week, month, year)
FROM date_dim""",
    "undated_rows": _ON_STAR
    + """
SELECT 'fact' AS became, count(*) AS n
FROM (SELECT DISTINCT id, "countryId", updated_on, rank, rating, points, difference, trend
      FROM filled WHERE trend <> 'Up')
UNION ALL
SELECT 'no readable date', count(*) FROM filled WHERE trend = 'Up'""",
    "sql_file": _ON_STAR + "SELECT country_id, country FROM country_dim WHERE country_id >= 10",
    "replace_sink": _ON_MART + "SELECT * FROM analytics",
    "drop_tables": _ON_MART
    + """
SELECT 'player_dim' AS table_name, count(*) AS n_rows, false AS still_there FROM player_dim
UNION ALL SELECT 'country_dim', count(*), false FROM country_dim
UNION ALL SELECT 'date_dim', count(*), false FROM date_dim
UNION ALL SELECT 'rankings', count(*), false FROM rankings
UNION ALL SELECT 'analytics', count(*), false FROM analytics""",
    "arrival_stream": _ON_STAR + "SELECT * FROM rankings",
    "arrival_stream_bounded": _ON_STAR + "SELECT * FROM rankings",
    "status_history": _ON_STATUS + "SELECT * FROM messages UNION ALL SELECT * FROM messages",
    "status_refresh": _ON_MART + "SELECT * FROM analytics",
    "latest_status_stream": _ON_STATUS
    + "SELECT * FROM messages ORDER BY timestamp DESC, status DESC LIMIT 1",
}
ORACLE["incremental_datetime"] = ORACLE["datetime_fact"]
ORACLE["rejects_by_load"] = (
    f"SELECT raw_line, reject_reason FROM ({ORACLE['line_rejects']}) CROSS JOIN range(4)"
)
# A renamed player is shown by the first of the names, also on the dates before.
ORACLE["mart_increments"] = ORACLE["replace_sink"].replace(
    "SELECT id, rank, name,",
    """SELECT id, rank, CASE WHEN id % 7 = 0 AND "lastUpdatedOn" >= '1998-01-01'
              THEN 'A' || name ELSE name END AS name,""",
)
# Of two deliveries with one date, the first by name brings it in.
ORACLE["arrivals_together"] = ORACLE["rankings_fact"].replace(
    "SELECT id, rank, name, country, rating, points,",
    """SELECT id, rank, name, country, rating,
         points + CASE WHEN date_diff('day', DATE '1970-01-01', TRY_CAST("lastUpdatedOn" AS DATE))
                            % 50 = 49 THEN 1 ELSE 0 END AS points,""",
)
ORACLE["csv_line_breaks"] = (
    _ON_FEED
    + """SELECT * REPLACE (CASE WHEN id % 3 = 0
       THEN '"' || replace(name, ' ', chr(10)) || '",' || chr(13) || chr(10) ELSE name END AS name)
FROM feed"""
)
