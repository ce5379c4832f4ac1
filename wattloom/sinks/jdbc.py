"""JDBC tables.  URL, driver and credentials come from the caller."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.sinks.archive import BATCH_ID

_IS_NAME = re.compile(r"[A-Za-z_][\w.]*")


def write_jdbc(
    df: DataFrame, url: str, table: str, properties: Mapping[str, str], mode: str = "overwrite"
) -> None:
    """Write the table from the executors; its columns follow the DataFrame's schema."""
    df.write.mode(mode).jdbc(url=url, table=table, properties=dict(properties))


def jdbc_batch_sink(
    url: str,
    table: str,
    properties: Mapping[str, str],
    delete_batch: Callable[[int], None] | None = None,
    batch_column: str | None = "BATCH_ID",
    at_least_once: bool = False,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` callback that appends each micro-batch to a JDBC table.

    Where deleting and writing are not one transaction, readers can meet half a batch:
    :func:`staged_batch_sink` has no such moment.

    Spark repeats a micro-batch after a failure, so rows carry their batch id and
    ``delete_batch`` must remove what an earlier attempt left behind.  A caller who can
    live with rows that come twice says ``at_least_once=True`` instead.  A failed write
    raises, which stops the query before the batch is committed; nothing is lost.
    """
    if delete_batch is None and not at_least_once:
        raise ValueError("give delete_batch, or accept repeated rows with at_least_once=True")

    def write(batch: DataFrame, batch_id: int) -> None:
        if delete_batch is not None:
            delete_batch(batch_id)
        if batch_column:
            batch = batch.withColumn(batch_column, F.lit(batch_id).cast("bigint"))
        write_jdbc(batch, url, table, properties, mode="append")

    return write


def staged_batch_sink(
    url: str,
    table: str,
    properties: Mapping[str, str],
    execute: Callable[[str], object],
    staging: str | None = None,
    ledger: str | None = None,
    batch_column: str = BATCH_ID,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` callback by which each micro-batch enters a JDBC table whole and once.

    The executors fill a ``staging`` table of the batch's own, which no reader looks at.
    One statement then copies it into ``table`` unless that already has rows of the
    batch, and another one notes the batch and its rows in the ``ledger``.  Every statement
    can be repeated, so it does not matter after which of them an attempt fails, nor whether
    several statements can be one transaction; a single one must be.  ``execute`` runs a
    statement on the database.  The target needs ``batch_column`` (best with an index)
    and the ledger two numbers, ``BATCH_ID`` and ``ROWS_WRITTEN``; both must exist.
    A batch without rows is noted only.
    """
    staging, ledger = staging or f"{table}_staging", ledger or f"{table}_batches"
    if not all(_IS_NAME.fullmatch(n) for n in (table, staging, ledger, batch_column)):
        raise ValueError("tables and the batch column need plain names")

    def write(batch: DataFrame, batch_id: int) -> None:
        number = int(batch_id)
        if any(not _IS_NAME.fullmatch(c) for c in batch.columns):
            raise ValueError("columns need plain names")
        numbered = batch.withColumn(batch_column, F.lit(number).cast("bigint"))
        columns = ", ".join(numbered.columns)
        write_jdbc(numbered, url, staging, properties, mode="overwrite")
        execute(
            f"INSERT INTO {table} ({columns}) SELECT {columns} FROM {staging} WHERE NOT EXISTS "
            f"(SELECT 1 FROM {table} WHERE {batch_column} = {number})"
        )
        execute(
            f"INSERT INTO {ledger} (BATCH_ID, ROWS_WRITTEN) SELECT {number}, "
            f"(SELECT COUNT(*) FROM {table} WHERE {batch_column} = {number}) WHERE NOT EXISTS "
            f"(SELECT 1 FROM {ledger} WHERE BATCH_ID = {number})"
        )

    return write
