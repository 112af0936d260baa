"""Tables that are merged by key: only the buckets that a batch touches are written again.

Rows lie in buckets by a hash of the key, each bucket in a folder of its own, as Spark's bucketed tables
have them. A merge writes the buckets of its batch as a new *generation*; a view says which generation
holds which bucket and is replaced in one catalog step. Files of other buckets stay as they are.

A bucket's old rows are read where they lie: their scan is partitioned by the key as the batch is after
its own shuffle, so neither the old rows nor the result are shuffled.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronlake.sources.tables import NullViolation

GONE = "__gone"
_SEQ = "__seq"
BUCKETS, GENERATIONS = 64, 8


@dataclass(frozen=True)
class MergeResult:
    version: int | None
    buckets: int
    skipped: bool


class KeyedTable:
    """Rows of `schema`, one for each value of the columns `unique`, which begin with `key`.

    `buckets` is fixed when the table is made; choose it so that a bucket fits a task's memory for sorting
    with ease (some hundred megabytes). With more than `generations` generations a merge writes all
    buckets again. One writer at a time; readers see the table before or after a merge. What a merge
    replaces is kept until the next one, for queries still running on it; what a crash leaves behind is
    dropped by it.
    """

    def __init__(
        self, spark: SparkSession, database: str, name: str, schema: T.StructType, key: str,
        unique: tuple[str, ...] = (), buckets: int = BUCKETS, generations: int = GENERATIONS,
    ):
        self.spark, self.database, self.name, self.schema = spark, database, name, schema
        self.key, self.unique = key, unique or (key,)
        self.buckets, self.generations = buckets, generations
        if self.unique[0] != key or {GONE, _SEQ, "bucket"} & set(schema.fieldNames()):
            raise ValueError(f"unique columns begin with {key!r}, and {GONE}, {_SEQ} and bucket are taken")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")

    # State: in the properties of the view, so that it changes together with it.

    def _view(self) -> str:
        return f"{self.database}.{self.name}"

    def _generation(self, n: int) -> str:
        return f"{self.database}.{self.name}__g{n}"

    def _state(self) -> tuple[int | None, dict[int, set[int]]]:
        """The version, and the buckets that each generation holds."""
        if not self.spark.catalog.tableExists(self._view()):
            return None, {}
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self._view()}").collect()
        found = {r["key"]: r["value"] for r in rows}
        if int(found["buckets"]) != self.buckets:
            raise ValueError(f"{self._view()} has {found['buckets']} buckets, not {self.buckets}")
        owners = {
            int(n): {b for b in range(self.buckets) if int(held, 16) >> b & 1}
            for n, held in json.loads(found["owners"]).items()
        }
        return int(found["version"]), owners

    def _publish(self, version: int, owners: dict[int, set[int]]) -> None:
        columns = ", ".join(f"`{c}`" for c in self.schema.fieldNames())
        parts = [
            f"SELECT {columns} FROM {self._generation(n)} WHERE bucket IN ({', '.join(map(str, sorted(held)))})"
            for n, held in sorted(owners.items())
        ]
        held = json.dumps({n: f"{sum(1 << b for b in held):x}" for n, held in owners.items()})
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self._view()} "
            f"TBLPROPERTIES ('version' = '{version}', 'buckets' = '{self.buckets}', 'owners' = '{held}') "
            f"AS {' UNION ALL '.join(parts)}"
        )

    def _stored_generations(self) -> set[int]:
        names = [t.name for t in self.spark.catalog.listTables(self.database, f"{self.name}__g*")]
        found = (re.fullmatch(rf"{self.name}__g(\d+)", name) for name in names)
        return {int(m.group(1)) for m in found if m}

    def _drop(self, generations: set[int]) -> None:
        for n in generations:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._generation(n)}")

    # Reads.

    def exists(self) -> bool:
        return self._state()[0] is not None

    def read(self) -> DataFrame:
        if not self.exists():
            return self.spark.createDataFrame([], self.schema)
        return self.spark.table(self._view())

    def _bucket(self) -> Column:
        """As Spark's bucketed tables place a key."""
        return F.pmod(F.hash(F.col(f"`{self.key}`")), F.lit(self.buckets)).cast("int")

    def _buckets_of(self, keys: DataFrame) -> set[int]:
        return {r["bucket"] for r in keys.select(self._bucket().alias("bucket")).distinct().collect()}

    def _stored(self, buckets: set[int]) -> list[DataFrame]:
        """Rows of these buckets from the generations that hold them; no other folder is opened."""
        found = []
        for n, held in sorted(self._state()[1].items()):
            if wanted := sorted(held & buckets):
                rows = self.spark.table(self._generation(n)).filter(F.col("bucket").isin(*wanted))
                found.append(rows.select(*self.schema.fieldNames()))
        return found

    def rows_of(self, keys: DataFrame) -> DataFrame:
        """All rows of the keys in column `key` of `keys`. Only the keys are shuffled."""
        wanted = keys.select(F.col(f"`{self.key}`").cast(self.schema[self.key].dataType).alias(self.key)).distinct()
        parts = self._stored(self._buckets_of(wanted))
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        stored = reduce(DataFrame.union, parts)
        return stored.join(wanted.repartition(self.buckets, self.key), self.key, "left_semi").select(
            *self.schema.fieldNames()
        )

    # Merge.

    def _batch(self) -> str:
        return f"{self.database}.{self.name}__batch"

    def _typed(self, batch: DataFrame) -> DataFrame:
        gone = F.coalesce(F.col(GONE), F.lit(False)) if GONE in batch.columns else F.lit(False)
        typed = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema.fields]
        return batch.select(*typed, gone.alias(GONE))

    def _rows_by_bucket(self, rows: DataFrame) -> dict[int, int]:
        """Rows by bucket. NULLs in the unique columns, or in required ones of rows that stay, are an error."""
        required = {f.name for f in self.schema.fields if not f.nullable}
        rules = {c: F.col(f"`{c}`").isNull() & (F.lit(c in self.unique) | ~F.col(GONE)) for c in sorted(required | set(self.unique))}
        seen = rows.groupBy("bucket").agg(F.count("*").alias("n"), *[F.count_if(x).alias(f"no_{c}") for c, x in rules.items()]).collect()
        if broken := [c for c in rules if any(r[f"no_{c}"] for r in seen)]:
            raise NullViolation(f"{self._view()}: NULLs in {broken}")
        return {r["bucket"]: r["n"] for r in seen}

    def stage(self, batch: DataFrame) -> dict[int, int]:
        """Writes the batch, so that it is evaluated once; its rows by bucket."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self._batch()}")
        (
            self._typed(batch).withColumn("bucket", self._bucket())
            .write.format("parquet").mode("overwrite").saveAsTable(self._batch())
        )
        return self._rows_by_bucket(self.spark.table(self._batch()))

    def _newest(self, batch: DataFrame, old: list[DataFrame]) -> DataFrame:
        """Of rows with equal unique columns the one that counts; it may be one that goes."""
        columns = self.schema.fieldNames()
        new = batch.select(*columns, GONE, F.lit(1).alias(_SEQ)).repartition(self.buckets, self.key)
        old = [part.select(*columns, F.lit(False).alias(GONE), F.lit(0).alias(_SEQ)) for part in old]
        newest = W.partitionBy(*self.unique).orderBy(F.desc(_SEQ), GONE, *[F.desc(c) for c in columns])
        return reduce(DataFrame.union, [new, *old]).withColumn("nth", F.row_number().over(newest)).filter(F.col("nth") == 1)

    def merged(self, buckets: set[int]) -> DataFrame:
        """The rows of these buckets after the merge, with their bucket. Only the staged batch is shuffled."""
        rows = self._newest(self.spark.table(self._batch()), self._stored(buckets)).filter(~F.col(GONE))
        return rows.select(*self.schema.fieldNames(), self._bucket().alias("bucket"))

    def _write(self, rows: DataFrame, generation: int) -> None:
        (
            rows.write.format("parquet").mode("overwrite").partitionBy("bucket")
            .bucketBy(self.buckets, self.key).sortBy(*self.unique).saveAsTable(self._generation(generation))
        )

    def _first(self, batch: DataFrame) -> bool:
        """Writes the first generation straight from the batch, which has no old rows to meet, and checks what
        was written. False if nothing stays."""
        broken = reduce(lambda a, b: a | b, [F.col(f"`{c}`").isNull() for c in self.unique])
        rows = self._newest(self._typed(batch), []).filter(~F.col(GONE) | broken)
        self._write(rows.select(*self.schema.fieldNames(), self._bucket().alias("bucket")), 1)
        return bool(self._rows_by_bucket(self.spark.table(self._generation(1)).withColumn(GONE, F.lit(False))))

    def merge(self, batch: DataFrame) -> MergeResult:
        """Rows of the batch take the place of rows with equal `unique` columns, or are added.

        Rows with a true column `GONE` delete. Of rows with equal `unique` columns in one batch a row that
        stays wins over one that goes, then the greatest. An empty batch changes nothing. NULLs in the
        unique columns, or in required ones of rows that stay, stop the merge.
        """
        version, owners = self._state()
        live = set(owners)
        self._drop({n for n in self._stored_generations() if version is None or n > version})
        if version is None and self._first(batch):
            self._publish(1, {1: set(range(self.buckets))})
            return MergeResult(1, self.buckets, False)
        touched = set(self.stage(batch))
        if not touched:
            return MergeResult(version, 0, True)
        if version is None or len(live) >= self.generations:
            touched = set(range(self.buckets))
        following = (version or 0) + 1
        self._write(self.merged(touched), following)
        left = {n: held - touched for n, held in owners.items()}
        self._publish(following, {**{n: held for n, held in left.items() if held}, following: touched})
        self._drop(self._stored_generations() - live - {following})
        self.spark.sql(f"DROP TABLE IF EXISTS {self._batch()}")
        return MergeResult(following, len(touched), False)
