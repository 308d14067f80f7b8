"""Token-budgeted chunks with their heading context.

Blocks of a section: doc_id, section, pos, type, level, content, tok (and id).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

IGNORED = ("html", "figure", "table")
LISTS = ("list", "list_item")
LIST_STYLE = "List Paragraph"
KEY = ["doc_id", "section"]


def block_tokens(tokens: Column, meta_tokens: Column, model: str) -> Column:
    """Tokens of a block for a model; a block with a token map but without the model
    has 0, whatever its metadata say."""
    return F.when(tokens.isNotNull(), F.coalesce(F.try_element_at(tokens, F.lit(model)), F.lit(0))).otherwise(F.coalesce(F.try_element_at(meta_tokens, F.lit(model)), F.lit(0)))


def is_list(kind: Column, style: Column | None = None) -> Column:
    return kind.isin(*LISTS) if style is None else (kind.isin(*LISTS) | F.coalesce(style == LIST_STYLE, F.lit(False)))


def hard_limit(limit: int, margin: float) -> int:
    return int(limit * (1 + margin))


def lookahead(blocks: DataFrame) -> DataFrame:
    """Add ``look``: for a heading, tokens from it through the first block after it
    that is no heading (or the last block); prefix sums, no loop."""
    w = Window.partitionBy(*KEY).orderBy("pos")
    after = w.rowsBetween(1, Window.unboundedFollowing)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    df = blocks.withColumn("__sum", F.sum("tok").over(upto))
    df = df.withColumn("__body", F.when(F.col("type") != "heading", F.col("__sum")))
    end = F.coalesce(F.first("__body", ignorenulls=True).over(after), F.last("__sum").over(Window.partitionBy(*KEY).orderBy("pos").rowsBetween(0, Window.unboundedFollowing)))
    return df.withColumn("look", end - F.col("__sum") + F.col("tok")).withColumn("last_block", F.lead("pos").over(w).isNull()).drop("__sum", "__body")


def assign_chunks(blocks: DataFrame, limit: int = 350, margin: float = 0.1) -> DataFrame:
    """doc_id, section, pos, chunk_no of the blocks that chunks hold (figures, tables
    and markup are in none).

    A chunk ends where the next block would exceed the limit, or before a heading
    whose lookahead would reach it.  The running sum starts anew with each chunk, so
    this is a fold over a section; its state is two numbers beside the result.
    """
    most = hard_limit(limit, margin)
    df = lookahead(blocks).where(~F.col("type").isin(*IGNORED))
    item = F.struct("pos", F.col("tok").cast("long").alias("tok"), F.col("look").cast("long").alias("look"), ((F.col("type") == "heading") & ~F.col("last_block")).alias("head"))
    rows = df.groupBy(*KEY).agg(F.array_sort(F.collect_list(item)).alias("s"))
    kind = "struct<cur:bigint,chunk:int,out:array<struct<pos:int,chunk:int>>>"

    def step(a: Column, x: Column) -> Column:
        full = (F.size(a["out"]) > 0) & F.when(x["head"], a["cur"] + x["look"] >= most).otherwise(a["cur"] + x["tok"] > most)
        chunk = a["chunk"] + F.when(full, 1).otherwise(0)
        cur = F.when(full, F.lit(0).cast("long")).otherwise(a["cur"]) + x["tok"]
        return F.struct(cur.alias("cur"), chunk.alias("chunk"), F.concat(a["out"], F.array(F.struct(x["pos"].cast("int").alias("pos"), chunk.alias("chunk")))).alias("out")).cast(kind)

    start = F.struct(F.lit(0).cast("long").alias("cur"), F.lit(0).alias("chunk"), F.array().alias("out")).cast(kind)
    out = F.aggregate("s", start, step, lambda a: a["out"])
    return rows.select(*KEY, F.explode(out).alias("x")).select(*KEY, "x.pos", F.col("x.chunk").alias("chunk_no"))


def chunk_prefixes(blocks: DataFrame, chunks: DataFrame, level: str = "level") -> DataFrame:
    """doc_id, section, chunk_no, pos of the headings that stand over a chunk.

    A heading is over a chunk if its level is below that of every later heading up to
    the chunk's first block (itself included if it is a heading).
    """
    df = blocks.join(chunks, [*KEY, "pos"])
    w = Window.partitionBy(*KEY).orderBy("pos")
    lv = F.when(F.col("type") == "heading", F.col(level).try_cast("int"))
    first = df.groupBy(*KEY, "chunk_no").agg(F.min("pos").alias("first"), F.min_by(lv, "pos").alias("first_level"))
    # Stacks by suffix minima: fold the headings, keep those under the coming level.
    heads = df.where(lv.isNotNull()).select(*KEY, "pos", lv.alias("lv")).groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("pos", "lv"))).alias("h"))
    met = first.join(heads, KEY)
    before = F.filter("h", lambda x: x["pos"] < F.col("first"))
    kind = "struct<low:int,out:array<struct<pos:int,lv:int>>>"
    start = F.struct(F.coalesce("first_level", F.lit(1 << 30)).alias("low"), F.array().alias("out")).cast(kind)
    keep = lambda a, x: F.when(x["lv"] < a["low"], F.struct(x["lv"].alias("low"), F.concat(a["out"], F.array(F.struct(x["pos"].cast("int").alias("pos"), x["lv"].alias("lv")))).alias("out")).cast(kind)).otherwise(a)
    found = F.aggregate(F.reverse(before), start, keep, lambda a: a["out"])
    del w
    return met.select(*KEY, "chunk_no", F.explode(found).alias("x")).select(*KEY, "chunk_no", "x.pos")


def build_chunks(blocks: DataFrame, limit: int = 350, margin: float = 0.1, level: str = "level") -> DataFrame:
    """doc_id, section, chunk_no, ord, role, pos: prefix headings, a carried block
    before a list, and the body, in order.

    A prefix heading is left out if the body holds a block of equal type and content
    at its place; a chunk that opens with a list takes the latest other block.
    """
    body = assign_chunks(blocks, limit, margin).join(blocks, [*KEY, "pos"])
    w = Window.partitionBy(*KEY, "chunk_no").orderBy("pos")
    body = body.withColumn("__i", F.row_number().over(w) - 1)
    over = chunk_prefixes(blocks, body.select(*KEY, "pos", "chunk_no"), level).join(blocks.select(*KEY, "pos", "type", "content"), [*KEY, "pos"])
    over = over.withColumn("__i", F.row_number().over(w) - 1)
    twin = body.select(*KEY, "chunk_no", "__i", F.col("type").alias("__t"), F.col("content").alias("__c"))
    over = over.join(twin, [*KEY, "chunk_no", "__i"], "left").where(~(F.coalesce(F.col("type") == F.col("__t"), F.lit(False)) & F.col("content").eqNullSafe(F.col("__c"))))
    prefix = over.select(*KEY, "chunk_no", F.lit("prefix").alias("role"), "pos", F.lit(0).alias("__r"))

    # The latest block that is no list, up to the chunk's last block.
    lists = is_list(F.col("type"))
    run = Window.partitionBy(*KEY).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    seen = body.withColumn("__other", F.last(F.when(~lists, F.struct("pos", "content")), ignorenulls=True).over(run))
    ends = seen.groupBy(*KEY, "chunk_no").agg(F.max_by("__other", "pos").alias("other"), F.min_by(F.struct("type", "content"), "pos").alias("head"))
    bare = ends.join(prefix.select(*KEY, "chunk_no").distinct(), [*KEY, "chunk_no"], "left_anti")
    carry = bare.where(is_list(F.col("head.type")) & F.col("other").isNotNull()).where(~F.col("other.content").eqNullSafe(F.col("head.content")))
    carry = carry.select(*KEY, "chunk_no", F.lit("carry").alias("role"), F.col("other.pos").alias("pos"), F.lit(1).alias("__r"))
    rows = prefix.unionByName(carry).unionByName(body.select(*KEY, "chunk_no", F.lit("body").alias("role"), "pos", F.lit(2).alias("__r")))
    place = Window.partitionBy(*KEY, "chunk_no").orderBy("__r", "pos")
    return rows.withColumn("ord", (F.row_number().over(place) - 1).cast("int")).drop("__r")
