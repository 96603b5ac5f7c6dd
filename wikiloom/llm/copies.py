"""Rows that agree in every column: told apart by a number, without gathering them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wikiloom.shared import unused

#: Copies that one row stands for while copies are dealt to tasks, and such blocks of a task about.
BLOCK, BLOCKS = 4096, 64
#: Tasks that copies are dealt to at most.
MAX_TASKS = 100_000


def named(column: str) -> Column:
    """The column of that name, dots and all."""
    return F.col("`" + column.replace("`", "``") + "`")


def row_hash(df: DataFrame, seed: int = 0) -> Column:
    """A 64-bit hash of a whole row: all columns, whatever their types, nulls told apart."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    columns = [F.to_json(named(f.name), {"ignoreNullFields": "false"}) if isinstance(f.dataType, nested) else named(f.name)
               for f in df.schema]
    return F.xxhash64(F.lit(seed), *columns, *(named(c).isNull() for c in df.columns))


def collapsed(df: DataFrame, count: str) -> DataFrame:
    """The distinct rows of ``df`` and how often each occurs; combined inside tasks before they move."""
    return df.groupBy(*map(named, df.columns)).agg(F.count("*").alias(count))


def numbered(distinct: DataFrame, count: str, number: str) -> DataFrame:
    """Each row ``count`` times, with ``number`` from 0, instead of the column ``count``.

    Rows with very many copies are first cut into blocks of ``BLOCK`` that are
    dealt to tasks, so no task writes a third of a table from one row.
    ``distinct`` is read twice; store it.
    """
    first, last = unused(distinct, "_first"), F.col(count) - 1
    large = distinct.where(F.col(count) > BLOCK)
    total = large.agg(F.coalesce(F.sum(count), F.lit(0))).first()[0]

    def copies(rows: DataFrame, start: Column, end: Column) -> DataFrame:
        return rows.withColumn(number, F.explode(F.sequence(start, end))).drop(count, first)

    few = copies(distinct.where(F.col(count).between(1, BLOCK)), F.lit(0).cast("long"), last)
    if not total:
        return few
    blocks = large.withColumn(first, F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(BLOCK).cast("long"))))
    dealt = blocks.repartition(min(MAX_TASKS, -(-total // (BLOCK * BLOCKS))))
    return few.unionByName(copies(dealt, F.col(first), F.least(last, F.col(first) + BLOCK - 1)))
