"""Stream batches in append-only tables, each exactly once.

A table that can only be appended to, such as one in a database, cannot take back the rows of a batch that failed half-way. So
every attempt writes its rows under a name of its own, and only then one row to a second table of commits: run, batch and
attempt. Readers join rows to commits, so rows of attempts that never came to an end are not seen. A batch that is
repeated after its commit is not written again; should two attempts have been committed all the same, by a driver that was
taken for dead, the one with the smaller name counts, for every reader alike.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.sources.tables import JdbcTable, ParquetTable, Table, read_all, write_table

COMMIT = "run string, batch_id bigint, attempt string"
KEYS = ["run", "batch_id"]


def is_stored(spark: SparkSession, table: Table) -> bool:
    """Whether a Parquet table has been written to; a database's tables are there from the start."""
    if isinstance(table, JdbcTable):
        return True
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table.path)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def read_commits(spark: SparkSession, commits: Table) -> DataFrame:
    """One attempt for every batch that has come to an end."""
    if not is_stored(spark, commits):
        return spark.createDataFrame([], COMMIT)
    stored = spark.read.schema(COMMIT).parquet(commits.path) if isinstance(commits, ParquetTable) else read_all(spark, commits)
    return stored.groupBy(*KEYS).agg(F.min("attempt").alias("attempt"))


def stage(rows: DataFrame, target: Table, run: str, batch_id: int) -> str:
    """Appends the rows of an attempt and returns its name. Nobody sees them yet."""
    attempt = uuid.uuid4().hex
    named = rows.withColumns({"run": F.lit(run), "batch_id": F.lit(batch_id).cast("bigint"), "attempt": F.lit(attempt)})
    write_table(named, target, "append")
    return attempt


def commit(spark: SparkSession, commits: Table, run: str, batch_id: int, attempt: str) -> None:
    """One row, in one file or one transaction: it is there or it is not."""
    row = spark.createDataFrame([(run, batch_id, attempt)], COMMIT).coalesce(1)
    write_table(row, commits, "append")


def committed(spark: SparkSession, commits: Table, run: str, batch_id: int) -> bool:
    return not read_commits(spark, commits).filter((F.col("run") == run) & (F.col("batch_id") == batch_id)).isEmpty()


def committed_sink(
    target: Table, commits: Table, shape: Callable[[DataFrame], DataFrame] = lambda rows: rows
) -> Callable[[DataFrame, str, int], None]:
    """A sink for ``streaming.suggestions.run_suggestions``; ``shape`` makes the rows that the table takes, such as
    ``operators.sampling.explode_picks`` for tables without arrays."""

    def write(answers: DataFrame, run: str, batch_id: int) -> None:
        spark = answers.sparkSession
        if not committed(spark, commits, run, batch_id):
            commit(spark, commits, run, batch_id, stage(shape(answers), target, run, batch_id))

    return write


def read_committed(spark: SparkSession, target: Table, commits: Table) -> DataFrame:
    """The rows of every batch exactly once."""
    stored = read_all(spark, target)
    return stored.join(read_commits(spark, commits), [*KEYS, "attempt"], "left_semi").drop(*KEYS, "attempt")
