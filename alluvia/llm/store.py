"""Intermediates that outlive the executors that made them."""

from __future__ import annotations

from pyspark.sql import DataFrame

from alluvia.session import shared_folder

#: Rows for which a task of its own pays, and the tasks that any table may have.
PER_TASK, LEAST_TASKS = 5_000, 8


def stored(df: DataFrame, purpose: str, rows: int | None = None) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: its lineage ends here and its work is done once.

    ``rows`` is about how many there are, where that is known: small tables are then written by few tasks, as a task costs its files (and
    a local file system may fork the executor for each of them). All rows are written, and large tables by as many tasks as they have.
    """
    path = shared_folder(df.sparkSession, purpose)
    written = df if rows is None else df.coalesce(max(LEAST_TASKS, -(-rows // PER_TASK)))
    written.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
