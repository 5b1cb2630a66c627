"""Stored tables of one database."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankloom.functions.dates import month_key
from rankloom.schemas import BUCKET, BUCKETS, LOAD, MONTH, TABLES


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """`df` by name in the order and types of `schema`.

    A missing column is NULL and a surplus one an error. A value that does not
    fit its type fails the write, as casts do in ANSI mode, Spark's default.
    """
    surplus = set(df.columns) - set(schema.names)
    if surplus:
        raise ValueError(f"no such columns in the table: {sorted(surplus)}")
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


class Warehouse:
    """Typed access to the tables of `rankloom.schemas.TABLES`."""

    def __init__(self, spark: SparkSession, database: str, location: str | None = None) -> None:
        self.spark = spark
        self.database = database
        quoted = (location or "").replace("\\", "\\\\").replace("'", "\\'")
        place = f" LOCATION '{quoted}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{place}")

    def on(self, spark: SparkSession) -> Warehouse:
        """The same tables through another session, as a stream's batches have one."""
        return Warehouse(spark, self.database)

    def name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def create(self, table: str) -> None:
        """Create `table` if it is not there."""
        schema, partitions = TABLES[table]
        columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema]
        columns += [f"`{p}` bigint" for p in partitions]
        clause = f" PARTITIONED BY ({', '.join(f'`{p}`' for p in partitions)})" if partitions else ""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({', '.join(columns)})"
            f" USING parquet{clause}"
        )

    def stored(self, table: str) -> DataFrame:
        """The table with its partition columns, as far as its loads are committed.

        Empty if it does not exist yet. A load that broke off left rows that no commit
        names, and so does one that is still being written.
        """
        schema, partitions = TABLES[table]
        if not self.exists(table):
            shape = T.StructType([*schema, *[T.StructField(p, T.LongType()) for p in partitions]])
            return conform(self.spark.range(0).select(), shape)
        if not partitions:
            # Another session, as a stream has one, may have added files since.
            for name in (table, "mart_parts") if table == "analytics" else (table,):
                if self.exists(name):
                    self.spark.catalog.refreshTable(self.name(name))
        rows = self.spark.table(self.name(table))
        if LOAD in partitions:
            rows = rows.join(self.read("commits").select(LOAD), LOAD, "left_semi")
        return rows

    def read(self, table: str) -> DataFrame:
        """The committed rows of the table, empty if it does not exist yet."""
        return self.stored(table).select(*TABLES[table][0].names)

    def read_months(self, table: str, days: DataFrame) -> DataFrame:
        """`read` of a table parted by month, in the months of the only column of `days`.

        At most some 7,000 months come to the driver, and name the partitions to read.
        """
        day = F.col(days.columns[0])
        months = days.where(day.isNotNull()).select(month_key(day).alias("m")).distinct()
        rows = self.stored(table).where(F.col(MONTH).isin([r.m for r in months.collect()]))
        return rows.select(*TABLES[table][0].names)

    @staticmethod
    def new_load() -> int:
        """A number for the partitions of one load, that no other load has."""
        return uuid4().int >> 65

    def committed(self, name: str) -> bool:
        """Whether a load of this name is committed."""
        return not self.read("commits").where(F.col("name") == name).isEmpty()

    def commit(self, load: int, name: str | None = None, has_facts: bool = False) -> None:
        """Let the rows of a load count, those of all tables at once: one row in one file."""
        row = self.spark.createDataFrame([(load, name, has_facts)], TABLES["commits"][0])
        self._insert("commits", row.coalesce(1), {}, "INTO")

    def _insert(self, table: str, df: DataFrame, partition: dict[str, int], how: str) -> None:
        """Write `df`, with values for the partitions that it has no column for."""
        schema, partitions = TABLES[table]
        self.create(table)
        given = [f"`{p}` = {partition[p]}" if p in partition else f"`{p}`" for p in partitions]
        into = f" PARTITION ({', '.join(given)})" if partitions else ""
        by_row = [p for p in partitions if p not in partition]
        shape = T.StructType([*schema, *[T.StructField(p, T.LongType()) for p in by_row]])
        rows = conform(df, shape)
        if by_row:
            # One file a partition, but for hot ones, which AQE splits by their size.
            rows = rows.hint("rebalance", *[F.col(p) for p in by_row])
        self.spark.sql(
            f"INSERT {how} {self.name(table)}{into} SELECT * FROM {{rows}}", rows=rows
        )

    def append(self, table: str, df: DataFrame) -> None:
        """Add all rows, as a load of their own."""
        if LOAD not in TABLES[table][1]:
            self._insert(table, df, {}, "INTO")
            return
        load = self.new_load()
        self.write_load(table, df, load)
        self.commit(load)

    def unseen(self, table: str, df: DataFrame) -> DataFrame:
        """The distinct rows that the table does not hold yet.

        Of a bucketed table only the buckets are read that these rows are in.
        """
        fresh = conform(df, TABLES[table][0]).distinct()
        stored = self.stored(table)
        if BUCKET in TABLES[table][1]:
            # At most BUCKETS rows.
            buckets = [r.b for r in fresh.select(_bucket(table).alias("b")).distinct().collect()]
            stored = stored.where(F.col(BUCKET).isin(buckets))
        stored = stored.select(*[F.col(c).alias(f"_stored_{c}") for c in fresh.columns])
        same = [F.col(c).eqNullSafe(F.col(f"_stored_{c}")) for c in fresh.columns]
        return fresh.join(stored, reduce(and_, same), "left_anti")

    def append_unseen(self, table: str, df: DataFrame) -> None:
        """Add the distinct rows the table does not hold yet, as a load of their own."""
        self.append(table, self.unseen(table, df))

    def write_load(self, table: str, df: DataFrame, load: int) -> None:
        """Write rows of one load, whose number no try before it had. `commit` lets them count."""
        df = conform(df, TABLES[table][0])
        if BUCKET in TABLES[table][1]:
            df = df.withColumn(BUCKET, _bucket(table))
        if MONTH in TABLES[table][1]:
            df = df.withColumn(MONTH, month_key(F.col("date")))
            last = df.agg(F.max("date_id").alias("date_id"))
            self._insert("datetime_last", last, {LOAD: load}, "INTO")
        self._insert(table, df, {LOAD: load}, "INTO")

    def write_refresh(self, rows: DataFrame, parts: DataFrame, refresh: int) -> None:
        """Rows of the mart by `facts_key`, which from now on stand for those loads."""
        self._insert("analytics_rows", rows, {"refresh_key": refresh}, "OVERWRITE")
        self._insert("mart_parts", parts.coalesce(1), {}, "INTO")
        if "analytics_rows" not in self._viewed("analytics"):
            if not self._is_view("analytics"):
                self._drop_tables(["analytics"])
            columns = ", ".join(f"`{name}`" for name in TABLES["analytics"][0].names)
            self.spark.sql(
                f"CREATE OR REPLACE VIEW {self.name('analytics')} AS SELECT {columns}"
                f" FROM {self.name('analytics_rows')} JOIN (SELECT facts_key,"
                f" max(refresh_key) AS refresh_key FROM {self.name('mart_parts')}"
                f" GROUP BY facts_key) USING (facts_key, refresh_key)"
            )

    def sweep(self) -> None:
        """Drop what loads and refreshes that broke off have left, and parts of the mart replaced.

        No load may be under way, and readers of a replaced mart must have ended.
        """
        for table, (_, partitions) in TABLES.items():
            if LOAD in partitions and self.exists(table):
                parts = self.spark.table(self.name(table)).select(*partitions).distinct()
                for row in parts.join(self.read("commits"), LOAD, "left_anti").collect():
                    self._drop_partition(table, **row.asDict())
        if self.exists("analytics_rows"):
            parts = self.spark.table(self.name("analytics_rows")).select("facts_key", "refresh_key")
            shown = self.read("mart_parts").groupBy("facts_key")
            shown = shown.agg(F.max("refresh_key").alias("refresh_key"))
            for row in parts.distinct().join(shown, parts.columns, "left_anti").collect():
                self._drop_partition("analytics_rows", **row.asDict())

    def _drop_partition(self, table: str, **values: int) -> None:
        spec = ", ".join(f"`{column}` = {value}" for column, value in values.items())
        self.spark.sql(f"ALTER TABLE {self.name(table)} DROP IF EXISTS PARTITION ({spec})")

    def _versions(self, table: str) -> set[str]:
        shown = self.spark.sql(f"SHOW TABLES IN `{self.database}` LIKE '{table}__v*'")
        return {row.tableName for row in shown.collect()}

    def _is_view(self, table: str) -> bool:
        return self.exists(table) and (
            self.spark.catalog.getTable(self.name(table)).tableType == "VIEW"
        )

    def _viewed(self, table: str) -> str:
        """Definition of the view, which names the version it shows."""
        if not self._is_view(table):
            return ""
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(table)}")
        return described.where("col_name = 'View Text'").first().data_type

    def replace(self, table: str, df: DataFrame) -> None:
        """Put `df` in the place of the whole table.

        The rows go to a new version and a view is then pointed at it, in one
        catalog operation: readers see the old table or the new one. The version
        before stays for those still reading it, any others are dropped.
        """
        stale = {v for v in self._versions(table) if v not in self._viewed(table)}
        version = f"{table}__v{uuid4().hex}"
        conform(df, TABLES[table][0]).write.format("parquet").saveAsTable(self.name(version))
        if not self._is_view(table):
            self._drop_tables([table])
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.name(table)} AS SELECT * FROM {self.name(version)}"
        )
        self._drop_tables(stale)

    def _drop_tables(self, tables: Iterable[str]) -> None:
        for table in tables:
            self.spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:t)", args={"t": self.name(table)})

    def drop(self, tables: Iterable[str]) -> None:
        """Drop tables with their data; names that do not exist are passed over.

        The manifest goes with the last table that it speaks of.
        """
        for table in tables:
            if self._is_view(table):
                self.spark.sql("DROP VIEW IDENTIFIER(:t)", args={"t": self.name(table)})
                self._drop_tables([*self._versions(table), f"{table}_rows", "mart_parts"])
            else:
                self._drop_tables([table])
                if table == "datetime_dim":
                    self._drop_tables(["datetime_last"])
        if not any(LOAD in p and self.exists(t) for t, (_, p) in TABLES.items()):
            self._drop_tables(["commits"])


def _bucket(table: str) -> Column:
    """Bucket of a row by the first column of its contract."""
    return F.pmod(F.xxhash64(TABLES[table][0].names[0]), F.lit(BUCKETS)).cast("bigint")
