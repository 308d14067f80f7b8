"""Tables written once in the shared folder, and small bounded filters of keys."""

from __future__ import annotations

import atexit
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_PER_FILE = 200_000
_WRITTEN: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where it is unset, on a local master, a folder of our own is made and set; on a
    cluster executors would not see it, so there it raises.
    """
    conf = spark.sparkContext.getConf()
    found = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = spark.sparkContext.getCheckpointDir()
    if not found and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not found:
        found = f"file://{tempfile.mkdtemp(prefix='quire-')}"
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def materialize(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: its lineage
    ends there, so a lost executor costs no recomputation of what lies before.

    ``rows`` bounds the rows of a narrow table behind a shuffle: it is written to a file
    for each ``ROWS_PER_FILE`` of them, not to one for every partition.
    """
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // ROWS_PER_FILE)))
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quire/{uuid.uuid4().hex}-{name}"
    schema = df.schema
    df.write.parquet(path)
    _WRITTEN.append((spark, path))
    out = spark.read.schema(schema).parquet(path)
    out.written_to = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def written() -> int:
    """How many tables stand in the shared folder: a mark for :func:`release`."""
    return len(_WRITTEN)


def release(since: int, keep: DataFrame) -> None:
    """Delete the tables written since a mark, but for ``keep``, which
    :func:`materialize` gave: nothing before it is read again."""
    for spark, path in _WRITTEN[since:]:
        if path != keep.written_to:
            _delete(spark, path)
            _WRITTEN.remove((spark, path))


@atexit.register
def _drop_written() -> None:
    for spark, path in _WRITTEN:
        try:
            _delete(spark, path)
        except Exception:  # the session may be gone at exit
            return


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def text_key() -> "F.Column":
    """64-bit hash of the text: with doc_id it names a row (equal rows share it)."""
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Texts are long: lower the session's rows in an Arrow batch to ``rows`` where it
    is higher, for the memory of executors and Python workers."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= rows:
        spark.conf.set(key, str(rows))


def dealt(df: DataFrame) -> DataFrame:
    """A table of fewer splits than cores, dealt out to all of them."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def packed(docs: DataFrame, *names: str) -> DataFrame:
    """``docs`` as one struct ``doc``, with the named columns beside it: columns that
    an operator adds cannot clash with those that rows bring along."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), *names)


def unpacked(df: DataFrame) -> DataFrame:
    return df.select("doc.*")


class KeyBits:
    """A one-hash Bloom filter of at most ``bits`` bits, gathered by bitwise or.

    What reaches the driver is at most bits/64 longs, however many keys there
    are; a full filter only lets more rows through to the exact join behind it.
    """

    def __init__(self, words: np.ndarray, bits: int):
        self.words, self.bits = words, bits

    @staticmethod
    def table(df: DataFrame, key: str, bits: int = 1 << 22) -> DataFrame:
        """(w, b): the filter's words that have bits, bits/64 rows at most."""
        slot = df.select(F.pmod(F.col(key), F.lit(bits)).alias("s"))
        return slot.groupBy((F.col("s") / 64).cast("int").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(s % 64 as int))")).alias("b"))

    @classmethod
    def of(cls, df: DataFrame, key: str, bits: int = 1 << 22) -> "KeyBits":
        rows = cls.table(df, key, bits).toArrow()
        words = np.zeros(bits // 64, np.int64)
        words[rows["w"].to_numpy()] = rows["b"].to_numpy()
        return cls(words.view(np.uint64), bits)

    def has(self, keys: np.ndarray) -> np.ndarray:
        s = np.mod(keys.astype(np.int64), self.bits)
        return (self.words[s >> 6] >> (s & 63).astype(np.uint64)) & np.uint64(1) > 0


def with_maybe(df: DataFrame, key: str, kept: DataFrame, of: str, bits: int = 1 << 22) -> DataFrame:
    """Add ``maybe``: may the row's ``key`` be among column ``of`` of ``kept``?  The
    filter's words are broadcast as a table of fixed size and met in the JVM."""
    words = KeyBits.table(kept, of, bits).select(F.col("w").alias("maybe_w"), F.col("b").alias("maybe_b"))
    slot = F.pmod(F.col(key), F.lit(bits))
    met = df.withColumn("maybe_s", slot).join(F.broadcast(words), F.col("maybe_w") == (F.col("maybe_s") / 64).cast("int"), "left")
    bit = F.expr("coalesce(shiftrightunsigned(maybe_b, cast(maybe_s % 64 as int)) & 1L, 0L) = 1L")
    return met.withColumn("maybe", bit).drop("maybe_s", "maybe_w", "maybe_b")
