"""Pages that arrive one by one.

Row-wise operators (classification, noise, captions) run on a stream as they are.
What needs a whole document runs when it is complete: each micro-batch's documents
are taken from the table of pages written so far.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import text as T
from ..functions.frames import spread
from ..operators import blocks, cleanup


def line_blocks(pages: DataFrame) -> DataFrame:
    """doc_id, page, type, level, content, is_noise for a stream of pages; no state."""
    raw = pages.where("text is not null").select("doc_id", "page", F.explode(blocks.scan_lines(T.split_lines(F.col("text")))).alias("raw"))
    return spread(raw, ["doc_id", "page"], blocks.classify(F.col("raw.text"))).withColumn("is_noise", cleanup.is_noise(F.col("content")))


def on_documents(pages: DataFrame, store: str, process: Callable[[DataFrame, int], None], checkpoint: str, buckets: int = 256) -> StreamingQuery:
    """Append each micro-batch of pages to ``store`` and call ``process`` with all pages
    of the documents it touched.

    The store lies in ``buckets`` folders by a hash of ``doc_id``, and only those of the
    touched documents are read.  A batch that is run again is written to its own folder
    again, so pages are stored once.
    """
    bucket = F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("int")

    def step(batch: DataFrame, number: int) -> None:
        spark: SparkSession = batch.sparkSession
        batch.withColumn("bucket", bucket).write.mode("overwrite").partitionBy("bucket").parquet(f"{store}/batch={number}")
        mine = spark.read.schema(batch.schema).option("basePath", store).parquet(f"{store}/batch={number}")
        touched = mine.select("doc_id").distinct()
        read = [r[0] for r in touched.select(bucket).distinct().collect()]  # as many as buckets at most
        every = spark.read.option("basePath", store).parquet(store).where((F.col("batch") <= number) & F.col("bucket").isin(read))
        process(every.select(batch.columns).join(touched, "doc_id", "left_semi"), number)

    return pages.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).start()
