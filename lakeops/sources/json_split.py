"""One large JSON document read by many tasks.

A document ``{..., "field": [{...}, {...}], ...}`` has no lines to split at, and
whether a byte is inside a text or how deep it lies depends on all bytes before
it. Here Spark splits the file by bytes and each split is cut after every ``}``.
What a piece does to the state is known from the piece alone: it flips inside
and outside of texts by its number of quotes, and changes the depth by its
brackets. So the state at each piece is a running value inside its split plus a
carry from the splits before it, of which there is one row each. Then every
element of the array is put together from its pieces and parsed by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.session import materialise

SPLIT = ("_file", "_block")
#: The depth inside the array: in the document's object, in the array.
INSIDE = 2


def _carried(df: DataFrame, value: Column, name: str) -> DataFrame:
    """``name``: the sum of ``value`` over all earlier pieces of the file."""
    own = Window.partitionBy(*SPLIT).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(*SPLIT).agg(F.sum(value).alias("_total")).select(*SPLIT, F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_carry"))
    running = df.withColumn("_own", F.coalesce(F.sum(value).over(own), F.lit(0)))
    return running.join(totals, list(SPLIT)).withColumn(name, (F.col("_own") + F.col("_carry")).cast("long")).drop("_own", "_carry")


def _last(df: DataFrame, value: str, name: str) -> DataFrame:
    """``name``: the last non-null ``value`` up to and with this piece of the file."""
    own = Window.partitionBy(*SPLIT).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    newest = df.where(F.col(value).isNotNull()).groupBy(*SPLIT).agg(F.max(F.struct("_at", value))[value].alias("_newest"))
    splits = df.select(*SPLIT).distinct().join(newest, list(SPLIT), "left")
    carry = splits.select(*SPLIT, F.last("_newest", ignorenulls=True).over(before).alias("_carry"))
    running = df.withColumn("_own", F.last(value, ignorenulls=True).over(own))
    return running.join(carry, list(SPLIT)).withColumn(name, F.coalesce("_own", "_carry")).drop("_own", "_carry")


def _structure() -> Column:
    """A piece without escapes, without the end of a text begun before it and the start of one that ends after it, and without brackets in texts."""
    bare = F.regexp_replace("value", r"\\.", "")
    parts = F.split(bare, '"')
    plain = F.array_join(F.transform(parts, lambda x, i: F.when((i + F.col("_quotes")) % 2 == 1, F.translate(x, "[]{}", "")).otherwise(x)), '"')
    whole = F.when(F.col("_quotes") % 2 == 1, F.when(F.instr(plain, '"') == 0, F.lit("")).otherwise(F.regexp_replace(plain, r'(?s)^[^"]*"', ""))).otherwise(plain)
    return F.when(F.col("_closes"), whole).otherwise(F.regexp_replace(whole, r'(?s)"[^"]*$', ""))


def _opened(structure: Column, depth: Column) -> Column:
    """The key of the last array that a piece opens directly in the document's object; an empty text for another container there."""
    tokens = F.regexp_extract_all(structure, F.lit(r'"[^"]*"\s*:\s*\[|[\[\]{]'), F.lit(0))
    start = F.struct(depth.cast("long").alias("depth"), F.lit(None).cast("string").alias("key"))

    def step(acc: Column, t: Column) -> Column:
        down = t == "]"
        here = ~down & (acc["depth"] == INSIDE - 1)
        key = F.when(here, F.regexp_extract(t, r'^"([^"]*)"', 1)).otherwise(acc["key"])
        return F.struct((acc["depth"] + F.when(down, -1).otherwise(1)).cast("long").alias("depth"), key.alias("key"))

    return F.aggregate(tokens, start, step)["key"]


def scan_json_elements(spark: SparkSession, path, *, field: str, schema) -> DataFrame:
    """The objects of the array ``field`` of each document, one row each, with the columns of ``schema``.

    ``path`` holds JSON documents, one object a file, of any size and any line
    breaks; several tasks read one file. An element that does not fit the schema
    has nulls, as ``from_json`` gives them. Order is not kept. Arrays that are not
    directly in the document's object, and elements that are no objects, are not
    read. A file without the field, or with an empty array, gives no row.
    """
    kind = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    read = spark.read.option("lineSep", "}").text(path)
    pieces = read.select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"))
    # Stored once: the numbers of the pieces must not change between the passes.
    pieces = materialise(pieces, name="json-pieces")
    bare = F.regexp_replace("value", r"\\.", "")
    quotes = F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit("")))
    states = _carried(pieces, quotes, "_quotes").withColumn("_closes", (F.col("_quotes") + quotes) % 2 == 0)
    states = states.withColumn("_structure", _structure())
    ups = F.length(F.regexp_replace("_structure", r"[^\[{]", ""))
    downs = F.length(F.regexp_replace("_structure", r"[^\]]", ""))
    change = ups - downs - F.when(F.col("_closes"), 1).otherwise(0)
    deep = _carried(states, change, "_depth").withColumns({"_after": F.col("_depth") + change, "_opens": _opened(F.col("_structure"), F.col("_depth"))})
    deep = materialise(deep.drop("_structure", "_quotes"), name="json-depths")
    inside = _last(deep, "_opens", "_array").where(F.col("_array") == field)
    inside = inside.withColumn("_ends", F.col("_closes") & (F.col("_after") == INSIDE))
    numbered = _carried(inside, F.col("_ends").cast("int"), "_element")
    # The first element's text begins after the bracket of the array.
    text = F.when(F.col("_opens") == field, F.regexp_replace("value", rf'(?s)^.*?"{field}"\s*:\s*\[', "")).otherwise(F.col("value"))
    joined = numbered.groupBy("_file", "_element").agg(F.array_sort(F.collect_list(F.struct("_block", "_at", text.alias("text")))).alias("_pieces"), F.max("_ends").alias("_whole"))
    element = F.concat(F.array_join(F.transform("_pieces", lambda p: p["text"]), "}"), F.lit("}"))
    rows = joined.where("_whole").select(F.from_json(F.regexp_replace(element, r"^[\s,]+", ""), kind).alias("_e"))
    return rows.select("_e.*")
