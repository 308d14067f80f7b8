"""Items of a page in reading order, as a layout model gives them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def with_counters(items: DataFrame) -> DataFrame:
    """``items`` (doc_id, page, ord, kind, text) with ``counter``, the number of an item
    among those of its kind on the page, and ``prev_text``, the text of the item before
    it if that is a text."""
    page = Window.partitionBy("doc_id", "page").orderBy("ord")
    kind = Window.partitionBy("doc_id", "page", "kind").orderBy("ord")
    prev = F.lag(F.struct("kind", "text")).over(page)
    return items.withColumns({"counter": F.row_number().over(kind), "prev_text": F.when(prev["kind"] == "text", prev["text"])})
