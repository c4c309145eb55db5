"""K1-K4: result sinks.

Rows are written by the executors (JDBC writer per partition, or files);
nothing is collected to the driver.  A target is either a ``JdbcTarget`` or
a string: a path (contains "/") or a catalog table name.

Over JDBC the executors fill a staging table beside the target, and when all
its rows are there one transaction of the database moves them over.  A task or
job that fails leaves the target as it was, and readers never see it in part.
The database must allow new tables in the target's schema.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class JdbcTarget:
    url: str
    table: str
    user: str | None = None
    password: str | None = None
    driver: str | None = None
    batchsize: int = 1000
    extra: dict = field(default_factory=dict)

    def properties(self, **more: str) -> dict[str, str]:
        p = {"batchsize": str(self.batchsize), **{k: str(v) for k, v in self.extra.items()}}
        if self.user is not None:
            p["user"] = self.user
        if self.password is not None:
            p["password"] = self.password
        if self.driver is not None:
            p["driver"] = self.driver
        p.update(more)
        return p


def _transaction(df: DataFrame, target: JdbcTarget, *statements: str) -> None:
    """Run the statements on one connection of the driver: all of them or none."""
    jvm = df.sparkSession._jvm
    given = jvm.java.util.Properties()
    for k, v in target.properties().items():
        given.setProperty(k, v)
    connection = jvm.java.sql.DriverManager.getConnection(target.url, given)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        try:
            for s in statements:
                statement.executeUpdate(s)
            connection.commit()
        except Exception:
            connection.rollback()
            raise
        finally:
            statement.close()
    finally:
        connection.close()


def _create_empty(df: DataFrame, target: JdbcTarget, mode: str) -> None:
    """Spark's own CREATE TABLE: a write without rows."""
    none = df.sparkSession.createDataFrame([], df.schema)
    none.write.jdbc(target.url, target.table, mode=mode, properties=target.properties(truncate="false"))


def _replace_over_jdbc(df: DataFrame, target: JdbcTarget, delete: str | None, recreate: bool = False,
                       id_column: str | None = None) -> None:
    """Fill a staging table, then move its rows to the target in one transaction.

    ``delete`` is the statement that makes room for them, with ``{staging}`` for
    the staging table's name and ``{id}`` for ``id_column`` as a short text (what
    Spark stores texts as can't be compared in every database).  With
    ``recreate`` the target is dropped and made anew from the rows' columns once
    staging is full; should that or the move fail, the rows stay in staging.
    """
    staging = JdbcTarget(target.url, f"{target.table}_staging_{uuid.uuid4().hex[:8]}", target.user, target.password,
                         target.driver, target.batchsize, target.extra)
    jvm = df.sparkSession._jvm
    quote = jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(target.url).quoteIdentifier
    if not recreate:
        _create_empty(df, target, "append")  # if it is not there
        there = df.sparkSession.read.jdbc(target.url, target.table, properties=target.properties()).columns
        name = {c.lower(): c for c in there}
        if wrong := [c for c in df.columns if c.lower() not in name]:
            raise ValueError(f"{target.table} has no columns {wrong}")
        df = df.select(*[F.col(f"`{c}`").alias(name[c.lower()]) for c in df.columns])  # as the target spells them
    _create_empty(df, staging, "error")
    full = False
    try:
        df.write.jdbc(staging.url, staging.table, mode="append", properties=staging.properties())
        full = True
        if recreate:
            _create_empty(df, target, "overwrite")
        into = ", ".join(quote(c) for c in df.columns)
        text = "CHAR(254)" if target.url.startswith(("jdbc:mysql:", "jdbc:mariadb:")) else "VARCHAR(254)"
        short = f"CAST({quote(next(c for c in df.columns if c.lower() == id_column.lower()))} AS {text})" if id_column else ""
        _transaction(df, target, *([delete.format(staging=staging.table, id=short)] if delete else []),
                     f"INSERT INTO {target.table} ({into}) SELECT {into} FROM {staging.table}")
    except Exception:
        if not (full and recreate):
            _transaction(df, target, f"DROP TABLE {staging.table}")
        raise
    _transaction(df, target, f"DROP TABLE {staging.table}")


def _write_files_or_table(df: DataFrame, target: str, mode: str, fmt: str) -> None:
    w = df.write.mode(mode).format(fmt)
    if "/" in target or ":" in target:
        w.save(target)
    elif mode == "append" and df.sparkSession.catalog.tableExists(target):
        there = df.sparkSession.table(target).columns
        if sorted(c.lower() for c in there) != sorted(c.lower() for c in df.columns):
            raise ValueError(f"{target} has the columns {there}, the rows have {df.columns}")
        df.select(*there).write.insertInto(target)  # this goes by position, so the columns are put in order
    else:
        w.saveAsTable(target)


def overwrite_table(df: DataFrame, target: JdbcTarget | str, fmt: str = "parquet") -> None:
    """K1: replace the rows of the target, keeping a JDBC table's definition
    (batched inserts beside it, then delete and move in one transaction)."""
    if isinstance(target, JdbcTarget):
        _replace_over_jdbc(df, target, f"DELETE FROM {target.table}")
    else:
        _write_files_or_table(df, target, "overwrite", fmt)


def append_table(df: DataFrame, target: JdbcTarget | str, fmt: str = "parquet", once_per: str | None = None) -> None:
    """K2: add rows; a task id column tells runs apart.

    Columns go by name, whatever their order; a table that lacks one of them,
    or has one more, refuses the rows.  Over JDBC, ``once_per`` names that task
    id column (texts of up to 254 characters): rows of the same tasks are replaced in
    the same transaction, so a run that is repeated counts once.
    """
    if isinstance(target, JdbcTarget):
        delete = None
        if once_per is not None:
            delete = f"DELETE FROM {target.table} WHERE {{id}} IN (SELECT {{id}} FROM {{staging}})"
        _replace_over_jdbc(df, target, delete, id_column=once_per)
    elif once_per is not None:
        raise ValueError("once_per needs a JDBC target")
    else:
        _write_files_or_table(df, target, "append", fmt)


def jdbc_overwrite(df: DataFrame, target: JdbcTarget) -> None:
    """K3: drop and re-create a JDBC table from the DataFrame's schema, once all its rows are staged."""
    _replace_over_jdbc(df, target, None, recreate=True)


def save_table(df: DataFrame, name: str, fmt: str = "parquet",
               partition_by: list[str] | None = None, bucket_by: tuple[int, list[str]] | None = None) -> None:
    """K4: drop the managed table if it exists and save the DataFrame as it.

    Store the action log with ``partition_by=["date"]`` so that date
    predicates prune partitions.  ``bucket_by`` (number, columns) deals the
    rows by a hash of the columns, sorted by them: the action log and the users
    in equally many buckets of ``user_id`` are joined without a shuffle of either.
    Rows are dealt to the buckets before writing, so each bucket (of each
    partition) is one file; a bucket's size is the log's divided by their number.
    """
    if bucket_by:
        df = df.repartition(bucket_by[0], *bucket_by[1])
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        w = w.bucketBy(bucket_by[0], *bucket_by[1]).sortBy(*bucket_by[1])
    w.saveAsTable(name)
