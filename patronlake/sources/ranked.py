"""Tables in a total order, with a directory of ranks: a page at any offset opens the ranges that hold it.

Rows are dealt into ranges of the order, sorted, and numbered within their range as they are written.
Beside them lies the directory: of each range its count, its first rank, and its first and last key. A page
looks its ranges up there and reads the rows with the places it wants; Parquet's statistics of the places
skip the rest of a long range. So what a page reads depends on its length, not on its offset.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

RANGE, PLACE, RANK = "__range", "__place", "__rank"
ROWS_PER_RANGE, MAX_RANGES = 65_536, 8_192
_PLACE_BITS = 33  # of monotonically_increasing_id, which counts the rows of a partition in these


class RankedTable:
    """Rows in the order of `order`: pairs (column, descending), NULLs last, which no two rows share.

    Ranges hold about `rows_per_range` rows; a table of more than `MAX_RANGES` such ranges has longer ones.
    Rows that are equal in all columns of the order stand in some order that stays until the next load.
    A load replaces the table: it writes a version and its directory, then switches a view in one catalog
    step. A load that dies changes nothing, and the next one drops what it left. The version before the
    current one is kept for queries still running on it. One loader at a time.
    """

    def __init__(
        self, spark: SparkSession, database: str, name: str, order: list[tuple[str, bool]],
        rows_per_range: int = ROWS_PER_RANGE,
    ):
        self.spark, self.database, self.name = spark, database, name
        self.order, self.rows_per_range = order, rows_per_range
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")

    def _view(self) -> str:
        return f"{self.database}.{self.name}"

    def _rows(self, version: int | str) -> str:
        return f"{self.database}.{self.name}__r{version}"

    def _ranges(self, version: int | str) -> str:
        return f"{self._rows(version)}_ranges"

    def version(self) -> int | None:
        if not self.spark.catalog.tableExists(self._view()):
            return None
        return int(self.spark.sql(f"SHOW TBLPROPERTIES {self._view()} ('version')").first()["value"])

    def _drop_all_but(self, kept: set[int]) -> None:
        names = [t.name for t in self.spark.catalog.listTables(self.database, f"{self.name}__r*")]
        for name in names:
            found = re.fullmatch(rf"{self.name}__r(\d+)(_ranges)?", name)
            if name == f"{self.name}__rbatch" or found and int(found.group(1)) not in kept:
                self.spark.sql(f"DROP TABLE IF EXISTS {self.database}.{name}")

    def _sorted_by(self) -> list[Column]:
        return [F.desc_nulls_last(f"`{c}`") if down else F.asc_nulls_last(f"`{c}`") for c, down in self.order]

    # Load.

    def load(self, rows: DataFrame) -> int:
        """Replaces the table; returns the number of rows. `rows` is evaluated once."""
        if taken := {RANGE, PLACE, RANK} & set(rows.columns):
            raise ValueError(f"columns {sorted(taken)} are taken")
        current = self.version()
        self._drop_all_but(set() if current is None else {current})
        rows.write.format("parquet").mode("overwrite").saveAsTable(self._rows("batch"))
        batch = self.spark.table(self._rows("batch"))
        n = batch.count()
        following = (current or 0) + 1
        self._write(batch, min(MAX_RANGES, max(1, -(-n // self.rows_per_range))), following)
        self._write_directory(following)
        columns = ", ".join(f"`{c}`" for c in rows.columns)
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self._view()} TBLPROPERTIES ('version' = '{following}') "
            f"AS SELECT {columns} FROM {self._rows(following)}"
        )
        self._drop_all_but({following} if current is None else {current, following})
        return n

    def _write(self, batch: DataFrame, ranges: int, version: int) -> None:
        """One task writes one range. The number of a row says its partition and its place in it."""
        number = F.monotonically_increasing_id()
        numbered = (
            batch.repartitionByRange(ranges, *self._sorted_by()).sortWithinPartitions(*self._sorted_by())
            .withColumn("__number", number)
            .withColumns({
                RANGE: F.shiftright("__number", _PLACE_BITS).cast("int"),
                PLACE: F.col("__number").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)),
            })
            .drop("__number").sortWithinPartitions(RANGE, PLACE)
        )
        numbered.write.format("parquet").mode("overwrite").partitionBy(RANGE).saveAsTable(self._rows(version))

    def _write_directory(self, version: int) -> None:
        """A row for each range: at most MAX_RANGES, so one task may number them."""
        key = F.struct(*[F.col(f"`{c}`") for c, _ in self.order])
        counted = self.spark.table(self._rows(version)).groupBy(RANGE).agg(
            F.count("*").alias("n"), F.min_by(key, PLACE).alias("first"), F.max_by(key, PLACE).alias("last")
        )
        before = W.orderBy(RANGE).rowsBetween(W.unboundedPreceding, -1)
        counted.withColumn("first_rank", F.coalesce(F.sum("n").over(before), F.lit(0))).write.format("parquet").mode(
            "overwrite"
        ).saveAsTable(self._ranges(version))

    # Reads.

    def read(self) -> DataFrame:
        return self.spark.table(self._view())

    def directory(self) -> DataFrame:
        """(__range, n, first, last, first_rank) of the current version."""
        return self.spark.table(self._ranges(self.version()))

    def count(self) -> int:
        return self.directory().agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    def page(self, offset: int, limit: int) -> DataFrame:
        """The rows of ranks offset to offset + limit - 1, from 0, in order, with their rank in `__rank`.

        Past the end: no rows. Ranges without a row of the page are not opened.
        """
        if offset < 0 or limit < 0:
            raise ValueError("offset and limit must not be negative")
        version, end = self.version(), offset + limit
        columns = self.read().columns
        held = self.spark.table(self._ranges(version)).filter(
            (F.col("first_rank") < end) & (F.col("first_rank") + F.col("n") > offset)
        ).select(RANGE, "first_rank").collect() if limit else []
        rows = self.spark.table(self._rows(version))
        if not held:
            return rows.filter(F.lit(False)).select(*[f"`{c}`" for c in columns], F.lit(0).cast("long").alias(RANK))
        place = F.col(PLACE)
        wanted = [
            (F.col(RANGE) == r[RANGE]) & (place >= offset - r["first_rank"]) & (place < end - r["first_rank"])
            for r in held
        ]
        # the directory's ranks go into the plan as a literal, so that no range but these is looked up
        first_rank = F.element_at(F.create_map(*[F.lit(x) for r in held for x in (r[RANGE], r["first_rank"])]), F.col(RANGE))
        return (
            rows.filter(F.col(RANGE).isin(*[r[RANGE] for r in held]) & reduce(or_, wanted))
            .select(*[f"`{c}`" for c in columns], (first_rank + place).alias(RANK))
            .orderBy(RANK)
        )

    def _before(self, values: tuple, key: str | None = None, or_equal: bool = False) -> Column:
        """Whether a row, or the key in a column of the directory, stands before `values`: a beginning of a key."""
        at = [F.col(key)[c] if key else F.col(f"`{c}`") for c, _ in self.order[: len(values)]]
        schema = self.read().schema
        found, equal = [], F.lit(True)
        for column, value, (name, down) in zip(at, values, self.order):
            given = F.lit(value).cast(schema[name].dataType)
            less = column.isNotNull() if value is None else F.coalesce(column > given if down else column < given, F.lit(False))
            found.append(and_(equal, less))
            equal = equal & column.eqNullSafe(given)
        return reduce(or_, [*found, equal] if or_equal else found)

    def position(self, values: tuple, after: bool = False) -> int:
        """The number of rows before those whose key begins with `values`; `after`: with these rows.

        The directory counts ranges that lie wholly before them; only ranges that hold the border are read.
        """
        if not 0 < len(values) <= len(self.order):
            raise ValueError(f"values for {[c for c, _ in self.order]} or a beginning of them")
        first, last = (self._before(values, key, after) for key in ("first", "last"))
        ranges = self.directory().select(RANGE, "n", first.alias("begins"), last.alias("ends")).filter("begins")
        whole = ranges.agg(F.coalesce(F.sum(F.when(F.col("ends"), F.col("n"))), F.lit(0))).first()[0]
        border = [r[RANGE] for r in ranges.filter("NOT ends").select(RANGE).collect()]
        if not border:
            return whole
        rows = self.spark.table(self._rows(self.version())).filter(F.col(RANGE).isin(*border))
        return whole + rows.filter(self._before(values, None, after)).count()

    def page_from(self, values: tuple, offset: int, limit: int) -> DataFrame:
        """A page of the rows from `values` on, with `total` and `has_more` as of these rows."""
        start, total = self.position(values), self.count()
        return self.page(start + offset, limit).withColumns({
            "total": F.lit(total - start).cast("long"), "has_more": F.lit(start + offset + limit < total),
        })

    def after(self, values: tuple, limit: int) -> DataFrame:
        """The page that follows the row with this key."""
        return self.page(self.position(values, after=True), limit)
