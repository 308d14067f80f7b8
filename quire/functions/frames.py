"""Frame helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST = 20_000  # partitions


def dealt(df: DataFrame) -> DataFrame:
    """A table of fewer splits than cores, dealt out to all of them (small files are
    one split); others as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def keyed(df: DataFrame, *keys: str, mb: int = 8) -> DataFrame:
    """Rows of a key in one partition, and as many partitions as the files below ask at
    ``mb`` each, so that a task's share does not grow with the table (the session's fixed
    number, merged further at run time, does).  Beyond ``MOST`` partitions, which a driver can
    hardly keep account of, shares grow and are spilled.  Tables of unknown size stay as
    they are."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    if size >= 1 << 60:  # what Spark says of a table it knows nothing about
        return df
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, min(-(-size // (mb << 20)), MOST)), *keys)


def with_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that are worked out once for each row.

    The optimizer merges projections, and with them repeats an expression for every
    place that names it; a generator is where it stops.
    """
    return df.select(*df.columns, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def spread(df: DataFrame, keep: list[str], struct: Column) -> DataFrame:
    """``keep`` and the fields of a struct that is worked out once; rows where it is
    null go."""
    return df.select(*keep, F.inline(F.array_compact(F.array(struct))))
