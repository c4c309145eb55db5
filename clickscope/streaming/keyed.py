"""K5: keyed serving tables on plain Parquet.

The reference writes the latest value per key into Redis hashes from every
micro-batch.  Here a micro-batch writes the rows of the keys it changed to its
own folder ``batch=<id>``, and a reader takes, for each key, the rows of the
newest batch that has it.  Writing a batch again replaces its folder, so a
retried micro-batch never counts twice; nothing is deleted while a query runs.

Batch ids are only meaningful within one streaming query, that is, one
checkpoint.  ``claim`` ties a table to a checkpoint when a query starts: with
another checkpoint over a table that has rows (a reset, or a second query) it
raises an error, unless the caller asks for a fresh table (``reset``), which
starts in a folder of its own; the rows of before stay where they are.

Tables that one query writes can share a ``CommitLog``: a record per micro-batch,
written when all of them have its rows.  Readers then see every table as of the
last recorded batch, also in the middle of the next one, and a batch that is
run again after its record is skipped.

With ``partition_by`` (the day) a batch folder is partitioned by that column,
so a read of some days lists and scans only those.  ``compact`` writes the
newest rows once and lets later reads start from there: maintenance, to be
called while the query is stopped.

The query that owns a table holds it ``pinned``: who owns it and where its rows
are can't change while it runs, so a micro-batch looks up neither again, nor
the columns of rows it has read before.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _note(spark: SparkSession, path: str) -> list[str]:
    """Lines of a small text file, none if it is not there."""
    try:
        return [r[0] for r in spark.read.text(path, wholetext=False).collect()]
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return []
        raise


def _write_note(spark: SparkSession, path: str, line: str) -> None:
    """A small text file; callers only write where no note is, so overwriting just clears what a crash left."""
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def distinct_values(batch: DataFrame, column: str) -> list:
    """The values of a column with few in a micro-batch, such as its days."""
    return [r[0] for r in batch.select(column).distinct().collect()]


class CommitLog:
    """The micro-batches of one query whose rows are complete in all its tables."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def last(self, spark: SparkSession) -> int:
        """The newest complete batch (-1: none)."""
        return max(map(int, _note(spark, self.path)), default=-1)

    def record(self, spark: SparkSession, batch_id: int) -> None:
        _write_note(spark, f"{self.path}/batch={batch_id}", str(batch_id))


class TableClaimed(RuntimeError):
    """The serving table belongs to another checkpoint."""


class KeyedTable:
    """A keyed serving table with one folder per micro-batch; ``unique``: a key has one row."""

    def __init__(self, path: str, keys: list[str], partition_by: str | None = None, unique: bool = False):
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self.partition_by = partition_by
        self.unique = unique
        self._pinned: list[str] | None = None
        self._columns: StructType | None = None

    def pinned(self, spark: SparkSession) -> KeyedTable:
        """This table for the query that has claimed it, for as long as it runs."""
        self._pinned = self._head(spark) or None
        return self

    # ------------------------------------------------------------ ownership
    def claim(self, spark: SparkSession, checkpoint: str, reset: bool = False, commits: CommitLog | None = None) -> None:
        """Tie the table to the query of this checkpoint and its commit log (call before the query starts)."""
        mark = f"{checkpoint.rstrip('/')}/serving-id"
        own = _note(spark, mark)
        if not own:
            own = [uuid.uuid4().hex]
            _write_note(spark, mark, own[0])
        there = self._head(spark)
        if there and there[0] == own[0]:
            return
        if there and not reset:
            raise TableClaimed(f"{self.path} was written with another checkpoint than {checkpoint}; "
                               "go on with that one, or start with reset=True")
        if not there and not reset and self._has_rows(spark):
            raise TableClaimed(f"{self.path} has rows, but nothing says which of its folders counts; "
                               "put its head back, or start with reset=True")
        self._set_head(spark, own[0], uuid.uuid4().hex[:12], commits.path if commits else "")

    def _heads(self, spark: SparkSession) -> list[list[str]]:
        return sorted((line.split(",", 3) for line in _note(spark, f"{self.path}-head")), key=lambda h: int(h[0]))

    def _head(self, spark: SparkSession) -> list[str]:
        """[owner, data folder, commit log] of the table, empty if nobody has claimed it; the newest note counts."""
        if self._pinned:
            return self._pinned
        heads = self._heads(spark)
        return heads[-1][1:] if heads else []

    def _set_head(self, spark: SparkSession, owner: str, folder: str, commits: str) -> None:
        heads = self._heads(spark)
        nth = int(heads[-1][0]) + 1 if heads else 0
        _write_note(spark, f"{self.path}-head/note={nth}-{uuid.uuid4().hex[:8]}", f"{nth},{owner},{folder},{commits}")

    def _has_rows(self, spark: SparkSession) -> bool:
        try:
            return bool(spark.read.parquet(self.path).columns)
        except AnalysisException as e:
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return False
            raise

    def data_path(self, spark: SparkSession) -> str:
        head = self._head(spark)
        if not head:
            raise TableClaimed(f"{self.path} has not been claimed by a query")
        return f"{self.path}/data={head[1]}"

    # ------------------------------------------------------------ reading
    def _rows(self, spark: SparkSession, below: int | None, only: DataFrame | list[str] | None,
              last_days: int | None = None) -> DataFrame | None:
        head = self._head(spark)
        if not head:
            return None
        try:
            reader = spark.read.schema(self._columns) if self._columns else spark.read
            rows = reader.parquet(f"{self.path}/data={head[1]}")
        except AnalysisException as e:  # no batch has written yet
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise
        if self._pinned:
            self._columns = rows.schema
        rows = rows.withColumn("batch", F.col("batch").cast("bigint"))
        if below is None and head[2]:
            below = CommitLog(head[2]).last(spark) + 1
        complete = F.lit(True) if below is None else F.col("batch") < below
        if self.partition_by:
            day = F.col("_part").cast("string")
            if only is not None:
                rows = rows.where(day.isin(only if isinstance(only, list) else distinct_values(only, self.partition_by)))
            if last_days is not None:  # reads no column but the folders' names
                newest = rows.where(complete).agg(F.max(day)).first()[0]
                rows = rows.where(day >= F.date_sub(F.lit(newest).cast("date"), last_days - 1).cast("string"))
            return rows.where(complete).drop("_part")
        return rows.where(complete)

    def read(self, spark: SparkSession, below: int | None = None, only: DataFrame | list[str] | None = None,
             last_days: int | None = None) -> DataFrame | None:
        """For each key the rows of its newest batch.

        Of the batches ``below`` (default: the recorded ones); of the partitions
        in ``only`` (a list of them, or a micro-batch that has the column), or the ``last_days`` calendar days up to the newest one.
        """
        rows = self._rows(spark, below, only, last_days)
        if rows is None:
            return None
        if self.unique:  # one pass over the rows
            rest = [c for c in rows.columns if c not in (*self.keys, "batch")]
            if not rest:
                return rows.select(*self.keys).distinct()
            return rows.groupBy(*self.keys).agg(*[F.max_by(c, "batch").alias(c) for c in rest])
        newest = rows.groupBy(*self.keys).agg(F.max("batch").alias("batch"))
        return rows.join(newest, [*self.keys, "batch"], "left_semi").drop("batch")

    def log(self, spark: SparkSession) -> DataFrame | None:
        """All rows of all batches (for a table without keys)."""
        rows = self._rows(spark, None, None)
        return None if rows is None else rows.drop("batch")

    # ------------------------------------------------------------ writing
    def upsert(self, batch: DataFrame, batch_id: int) -> None:
        """Rows that replace all rows of their keys; the same batch id again replaces this write."""
        self._write(batch, f"{self.data_path(batch.sparkSession)}/batch={batch_id}")

    def _write(self, rows: DataFrame, path: str) -> None:
        if self.partition_by:
            rows.withColumn("_part", F.col(self.partition_by)).write.mode("overwrite").partitionBy("_part").parquet(path)
        else:
            rows.write.mode("overwrite").parquet(path)

    def compact(self, spark: SparkSession, keep: Column | None = None) -> str | None:
        """Write the newest rows (those that ``keep`` holds for) to a new data folder and read from there on.

        Only while no query writes the table.  Returns the folder of before,
        which no new read uses: remove it when running reads have ended.
        """
        rows = self._rows(spark, None, None)
        if rows is None:
            return None
        last = rows.agg(F.max("batch")).first()[0]
        if last is None:
            return None
        now = self.read(spark)
        owner, folder, commits = self._head(spark)
        fresh = uuid.uuid4().hex[:12]
        self._write(now if keep is None else now.where(keep), f"{self.path}/data={fresh}/batch={last}")
        self._set_head(spark, owner, fresh, commits)
        return f"{self.path}/data={folder}"
