"""Records of CSV files whose values may hold line breaks, read by many tasks.

Where a record starts depends on the quotes of all lines before it, so a file seems to need one
task. Yet a line only leads from one of two states, outside or inside a quoted value, to one of
the two: what a line, or a whole block of lines, does is known without what stands before it.
The first pass works out each block's effect and its number of records under either state; a
running composition over the few blocks of a file gives the state each block starts in; the second
pass numbers the records and puts together the lines of each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioforge.session import cut_lineage
from folioforge.sources.listing import decoded

# A value that ends within its line, once doubled quotes are gone: it is quoted, with whatever
# follows the closing quote, or does not begin with a quote.
_FIELD = r'\G(?:"[^"]*"[^,]*|[^",][^,]*)?(?:,|\z)'
_LINE = ["file", "block"]


def _open_at_end(line: Column) -> Column:
    """1 if a line that starts a record ends inside a quoted value, else 0."""
    rest = F.regexp_replace(F.replace(line, F.lit('""'), F.lit("")), _FIELD, "")
    return F.when(F.contains(line, F.lit('"')), F.startswith(rest, F.lit('"')).cast("int")).otherwise(0)


def _with_states(rows: DataFrame, within: list[str], order: str) -> DataFrame:
    """Adds the state before and after each row if its group starts outside (0) or inside (1) a value.

    A row maps state 0 to `from_0` and 1 to `from_1`. Rows that map both to one state forget what
    was before; the others keep or flip it, so the last forgetting one and the flips since decide.
    """
    upto = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    forgets = F.col("from_0") == F.col("from_1")
    rows = rows.withColumn("flips", (~forgets & (F.col("from_0") == 1)).cast("int"))
    rows = rows.withColumn("flipped", (F.sum("flips").over(upto) % 2).cast("int"))
    rows = rows.withColumn("fixed", F.when(forgets, F.col("from_0").bitwiseXOR(F.col("flipped"))))
    for when, frame in (("before", earlier), ("after", upto)):
        rows = rows.withColumn(f"fixed_{when}", F.last("fixed", ignorenulls=True).over(frame))
    flipped = {"before": F.col("flipped").bitwiseXOR(F.col("flips")), "after": F.col("flipped")}
    states = {
        f"{when}_{start}": F.coalesce(f"fixed_{when}", F.lit(start)).bitwiseXOR(flipped[when])
        for when in flipped
        for start in (0, 1)
    }
    return rows.withColumns(states).drop("flips", "flipped", "fixed", "fixed_before", "fixed_after")


def csv_records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file, record, value): the text of every record of the files, numbered from 0 with the header.

    Lines end with a line feed, with or without a carriage return before it; inside values it
    becomes a line feed alone. Quotes in values are doubled. Empty lines between records are none, those inside a value belong to it. A quote that
    is never closed makes the rest of its file one record. Lines are written once as an intermediate table.
    """
    lines = spark.read.option("lineSep", "\n").text(list(paths)).select(
        decoded("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        # lines of a block follow one another in one task
        F.monotonically_increasing_id().alias("place"),
        "value",
    )
    lines = lines.withColumns(
        {"from_0": _open_at_end(F.col("value")), "from_1": F.when(
            F.contains("value", F.lit('"')), _open_at_end(F.concat(F.lit('"'), "value"))).otherwise(1)}
    )
    blank = F.col("value").isin("", "\r")
    lines = _with_states(lines, _LINE, "place")
    upto = Window.partitionBy(*_LINE).orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    starts = {s: ((F.col(f"before_{s}") == 0) & ~blank).cast("int") for s in (0, 1)}
    lines = lines.withColumns({f"records_{s}": F.sum(starts[s]).over(upto) for s in (0, 1)})
    lines = cut_lineage(lines.select(*_LINE, "place", "value", "before_0", "before_1", "after_0", "after_1",
                                     "records_0", "records_1"))

    last = lambda name: F.max_by(name, "place").alias(name)
    blocks = lines.groupBy(*_LINE).agg(*map(last, ("after_0", "after_1", "records_0", "records_1")))
    blocks = blocks.withColumnsRenamed({"after_0": "from_0", "after_1": "from_1"})
    blocks = _with_states(blocks, ["file"], "block").withColumn("open", F.col("before_0"))
    in_file = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    own = F.when(F.col("open") == 0, F.col("records_0")).otherwise(F.col("records_1"))
    blocks = blocks.withColumn("own", own).select(
        *_LINE, "open", F.coalesce(F.sum("own").over(in_file), F.lit(0)).alias("earlier")
    )

    placed = lines.join(blocks, _LINE).select(
        *_LINE, "place", "value",
        F.when(F.col("open") == 0, F.col("before_0")).otherwise(F.col("before_1")).alias("inside"),
        (F.col("earlier") + F.when(F.col("open") == 0, F.col("records_0")).otherwise(F.col("records_1")) - 1).alias("record"),
    )
    parts = placed.where((F.col("inside") == 1) | ~blank).groupBy("file", "record").agg(
        F.array_sort(F.collect_list(F.struct("block", "place", "value"))).alias("parts")
    )
    text = F.array_join(F.transform("parts", lambda p: F.regexp_replace(p["value"], r"\r\z", "")), "\n")
    return parts.select("file", "record", text.alias("value"))
