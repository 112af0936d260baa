"""Zones on the lake, and warehouse tables that are replaced or merged without a gap for readers."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from patronlake import schemas as S
from patronlake.functions.periods import yyyymm
from patronlake.functions.stamps import whole_seconds


class NullViolation(ValueError):
    """A NOT NULL column holds NULLs."""


# Lake ----------------------------------------------------------------------------------------


class Zones:
    """Parquet tables under one base path. The clean and serving tables are also attributes, so
    zones can be queried as a star."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")

    def path(self, table: str) -> str:
        """customer_360 belongs to the serving zone, other known tables to clean, the rest to raw."""
        zone = S.TABLES[table].zone if table in S.TABLES else "raw"
        return f"{self.base}/{zone}/{table}"

    def read(self, table: str) -> DataFrame:
        reader = self.spark.read
        if table in S.TABLES:
            reader = reader.schema(S.TABLES[table].schema)
        return reader.parquet(self.path(table))

    def write(self, df: DataFrame, table: str) -> None:
        df.write.mode("overwrite").option("compression", "snappy").parquet(self.path(table))

    def __getattr__(self, name: str) -> DataFrame:
        if name in S.TABLES:
            return self.read(name)
        raise AttributeError(name)


# Layout --------------------------------------------------------------------------------------


def conform(df: DataFrame, spec: S.TableSpec) -> DataFrame:
    """Columns of the table in order and type. Stamps of seconds resolution lose their fraction."""
    columns = []
    for f in spec.schema.fields:
        column = F.col(f.name).cast(f.dataType)
        if f.name in spec.whole_seconds:
            column = whole_seconds(column)
        columns.append(column.alias(f.name))
    return df.select(*columns)


def _layout_keys(spec: S.TableSpec) -> list[str]:
    return (["yyyymm"] if spec.month_of else []) + list(spec.sort_key)


def spread(df: DataFrame, spec: S.TableSpec) -> DataFrame:
    """Range-partition on (month, sort key, row key).

    Ranges follow the data, so a month that holds a third of all rows is split over as many tasks
    as its size asks for, and each file covers a narrow key range. The row key at the end lets even
    equal sort keys be split.
    """
    if spec.month_of:
        df = df.withColumn("yyyymm", yyyymm(F.col(spec.month_of)))
    keys = _layout_keys(spec)
    row_key = spec.columns[0]
    return df.repartitionByRange(*keys, *([] if row_key in keys else [row_key]))


def newest_by_key(batches: DataFrame, key: str, seq: str = "load_seq") -> DataFrame:
    """One row per key, from its newest load; keys missing from newer loads stay.

    ``row_number() = 1`` keeps one row per key and task before the shuffle.
    """
    newest = W.partitionBy(key).orderBy(F.desc(seq))
    return (
        batches.withColumn("nth", F.row_number().over(newest)).filter("nth = 1").drop("nth", seq)
    )


def write_days(df: DataFrame, path: str, day_of: str, row_key: str) -> None:
    """Rewrite only the days present in ``df``; running the same day again changes nothing."""
    (
        df.withColumn("day", F.to_date(day_of))
        .repartitionByRange("day", day_of, row_key)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day")
        .parquet(path)
    )


# Warehouse -----------------------------------------------------------------------------------


@dataclass(frozen=True)
class LoadResult:
    table: str
    rows: int
    version: int | None
    skipped: bool
    rejected: int = 0


class Warehouse:
    """Tables as numbered versions behind a view of the plain name.

    A load writes the next version beside the current one and then points the view at it, which the
    catalog does in one step. Readers see the old table or the new one, never a part; a load that
    dies before that leaves only a version nobody points at, which the next load drops. The version
    before the current one is kept for queries still running on it. One loader per table at a time.
    """

    def __init__(self, spark: SparkSession, database: str):
        self.spark = spark
        self.database = database
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")

    def _version_table(self, table: str, version: int) -> str:
        return f"{self.database}.{table}__v{version}"

    def versions(self, table: str) -> list[int]:
        names = [t.name for t in self.spark.catalog.listTables(self.database, f"{table}__v*")]
        found = (re.fullmatch(rf"{table}__v(\d+)", name) for name in names)
        return sorted(int(m.group(1)) for m in found if m)

    def current_version(self, table: str) -> int | None:
        if not self.spark.catalog.tableExists(f"{self.database}.{table}"):
            return None
        row = self.spark.sql(
            f"SHOW TBLPROPERTIES {self.database}.{table} ('version')"
        ).first()
        return int(row["value"])

    def read(self, table: str) -> DataFrame:
        return self.spark.table(f"{self.database}.{table}")

    def __getattr__(self, name: str) -> DataFrame:
        if name in S.TABLES:
            return self.read(name)
        raise AttributeError(name)

    def _drop(self, table: str, version: int) -> None:
        for suffix in ("", "_rejects"):
            self.spark.sql(f"DROP TABLE IF EXISTS {self._version_table(table, version)}{suffix}")

    def stage(self, df: DataFrame, spec: S.TableSpec, version: int) -> dict[str, int]:
        """Write one version; returns its row count and the NULLs per required column.

        Both are counted behind the last shuffle, in the tasks that write, where a retried task is
        counted once.
        """
        seen = Observation(f"load_{spec.name}")
        nulls = [F.count_if(F.col(c).isNull()).alias(c) for c in spec.required]
        laid_out = (
            spread(conform(df, spec), spec)
            .observe(seen, F.count(F.lit(1)).alias("__rows"), *nulls)
            .sortWithinPartitions(*_layout_keys(spec))
        )
        writer = laid_out.write.mode("overwrite").format("parquet")
        if spec.month_of:
            writer = writer.partitionBy("yyyymm")
        writer.saveAsTable(self._version_table(spec.name, version))
        return seen.get

    def publish(self, table: str, version: int) -> None:
        """The switch: one catalog operation."""
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.database}.{table} "
            f"TBLPROPERTIES ('version' = '{version}') "
            f"AS SELECT * FROM {self._version_table(table, version)}"
        )

    def rejects(self, table: str) -> DataFrame:
        """Rows that the current version of a table was loaded without."""
        version = self.current_version(table)
        return self.spark.table(f"{self._version_table(table, version)}_rejects")

    def _set_apart(self, df: DataFrame, spec: S.TableSpec, version: int) -> tuple[DataFrame, int]:
        """Writes the rows with NULLs in required columns beside the version; returns the others."""
        seen = Observation(f"reject_{spec.name}")
        broken = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in spec.required])
        (
            df.filter(broken).observe(seen, F.count(F.lit(1)).alias("rows"))
            .write.mode("overwrite").format("parquet")
            .saveAsTable(f"{self._version_table(spec.name, version)}_rejects")
        )
        return df.filter(~broken), seen.get["rows"]

    def load(self, df: DataFrame, spec: S.TableSpec, on_null: str = "fail") -> LoadResult:
        """Full replace, or a merge by key where the table has one.

        An empty snapshot leaves the old data in place. NULLs in required columns stop the load, or
        with ``on_null="quarantine"`` their rows go to the version's rejects: rows loaded and rows
        rejected are the rows read. ``rejects`` reads them.
        """
        if on_null not in ("fail", "quarantine"):
            raise ValueError(f"on_null is 'fail' or 'quarantine', not {on_null!r}")
        current = self.current_version(spec.name)
        for version in self.versions(spec.name):
            if current is None or version > current:
                self._drop(spec.name, version)
        version, rejected = (current or 0) + 1, 0
        if on_null == "quarantine":
            df, rejected = self._set_apart(df, spec, version)
        if spec.replace_key:
            if df.isEmpty():
                self._drop(spec.name, version)
                return LoadResult(spec.name, 0, current, True, rejected)
            batches = conform(df, spec).withColumn("load_seq", F.lit(1))
            if current is not None:
                old = self.read(spec.name).withColumn("load_seq", F.lit(0))
                batches = old.unionByName(batches)
            df = newest_by_key(batches, spec.replace_key)

        counts = dict(self.stage(df, spec, version))
        rows = counts.pop("__rows")
        broken = {column: n for column, n in counts.items() if n}
        if broken or rows == 0:
            self._drop(spec.name, version)
        if broken:
            raise NullViolation(f"{spec.name}: NULLs in required columns {broken}")
        if rows == 0:
            return LoadResult(spec.name, 0, current, True, rejected)

        self.publish(spec.name, version)
        for old_version in self.versions(spec.name):
            if old_version < version - 1:
                self._drop(spec.name, old_version)
        return LoadResult(spec.name, rows, version, False, rejected)
