"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document gets an exponential key, -ln(u) divided by its quality weight, where u is a
fixed hash of its id. Sorted by key, a source's documents are a weighted random order. A
source first gives as many complete epochs as its target holds; the rest of the budget is
filled with its documents in key order, by the running sum of their sizes.

No source is sorted whole. Keys fall into 256 ranges, these into 256 again; the sums of the
ranges tell in which one the budget ends, and only the documents of that range are ordered.
Ranges are even under a mean of exponential distributions whose rates double from 0.05 to 0.8, so
of the documents of any weight from 0.05 to 1 at most 10 in 65,536 fall in one.
Only built-in functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.llm.common import fresh, words
from folioforge.session import cut_lineage

WEIGHTS = (5.0, 2.0, 1.0)
MOST_COPIES = 3
_RANGES = 256
LEAST_WEIGHT = 0.05
_RATES = tuple(LEAST_WEIGHT * 2**i for i in range(5))


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def text_quality(text: Column) -> Column:
    """A quality weight from 0.05 to 1: the share of characters that are no digits or markup symbols."""
    kept = F.length(F.regexp_replace(F.coalesce(text, F.lit("")), "[#*$%&|<>0-9]+", ""))
    return F.coalesce(F.greatest(F.lit(LEAST_WEIGHT), kept / F.nullif(F.length(text), F.lit(0))), F.lit(1.0))


def uniform(id_column: Column) -> Column:
    """A number above 0 and below 1, fixed for each id."""
    head = F.substring(F.md5(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")), 1, 13)
    return (F.conv(head, 16, 10).cast("long") + 0.5) / float(1 << 52)


def source_targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """`sources` has source and source_size. Adds weight and target.

    Sources in code-point order, null last, weigh `weights` in turn and share the sum of all
    sizes; no target passes `most` times its source's size, and what is above goes to the others
    by weight. With sources in the order of size by weight, those above their limit are the first
    ones, so one running sum finds the level of the others.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    turn = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    ranked = sources.withColumn("weight", turn.cast("double"))
    ranked = ranked.withColumn("bound", most * F.col("source_size") / F.col("weight"))
    upward = Window.orderBy("bound", F.col("source").asc_nulls_last())
    before = upward.rowsBetween(Window.unboundedPreceding, -1)
    onward = upward.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.orderBy("bound", F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    left = F.sum("source_size").over(whole) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    levelled = ranked.withColumn("level", left / F.sum("weight").over(onward))
    first = F.first(F.when(F.col("level") < F.col("bound"), F.col("level")), ignorenulls=True).over(whole)
    limit = (most * F.col("source_size")).cast("double")
    target = F.coalesce(F.least(limit, F.col("weight") * first), limit)
    return levelled.select("source", "source_size", "weight", target.alias("target"))


def _end_of_budget(rows: DataFrame, ranges: str) -> DataFrame:
    """In which range the budget `rest` of each source ends, and what is left of it there."""
    sums = rows.groupBy("source", "rest", ranges).agg(F.sum("size").alias("size"))
    order = Window.partitionBy("source").orderBy(ranges)
    running = sums.withColumn("upto", F.sum("size").over(order))
    ends = running.where("upto >= rest and upto - size < rest")
    return ends.select("source", ranges, (F.col("rest") - F.col("upto") + F.col("size")).alias("rest"))


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    most: int = MOST_COPIES,
    quality: Column | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """One row per row of `docs`: doc_id, source, size (words), source_size, target, copies, taken.

    copies is how often the mix takes the document, at most `most` times; taken is copies times
    size. A source takes whole documents, so it may end up to half a document from its target. The
    document at which the budget ends is taken if the budget reaches its middle. Rows with the same
    id, key and source are taken together. A null text has size 0, a null source is a source,
    and no rows give no rows. Reruns agree: keys depend on ids alone.
    """
    text = F.col(text_column)
    weight = text_quality(text) if quality is None else quality
    key = -F.log(uniform(F.col(id_column))) / weight
    narrow = docs.select(
        F.col(id_column).alias("doc_id"),
        F.col(source_column).alias("source"),
        word_count(text).alias("size"),
        key.alias("key"),
    )
    share = sum((1 - F.exp(-rate * F.col("key")) for rate in _RATES), F.lit(0.0)) / len(_RATES)
    place = F.least(share, F.lit(1 - 1e-12)) * (_RANGES * _RANGES)
    narrow = narrow.withColumn("place", F.floor(place).cast("int")).select(
        "doc_id", "source", "size", "key", F.floor(F.col("place") / _RANGES).cast("int").alias("coarse"),
        (F.col("place") % _RANGES).alias("fine"),
    )
    narrow = cut_lineage(narrow)
    sums = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    sized = F.col("source_size")
    epochs = F.coalesce(F.floor(F.col("target") / F.nullif(sized, F.lit(0)) + 1e-9), F.lit(0))
    plan = source_targets(sums, weights, most).withColumn("epochs", F.least(epochs, F.lit(most)).cast("int"))
    plan = cut_lineage(plan.withColumn("rest", F.greatest(F.col("target") - F.col("epochs") * sized, F.lit(0.0))))

    on_plan = narrow.source.eqNullSafe(plan.source)
    budgeted = narrow.join(plan.where("rest > 0"), on_plan).drop(plan.source)
    # one row per source; written, so that its size is known when it is joined
    coarse = cut_lineage(_end_of_budget(budgeted.drop("fine"), "coarse"))
    inside = _within(narrow, coarse, ["coarse"])
    fine = _end_of_budget(inside, "fine").withColumnRenamed("source", "s")
    ends = coarse.select("source", "coarse").join(fine, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    ends = cut_lineage(ends)
    tail = _within(narrow, ends, ["coarse", "fine"])
    running = F.sum("size").over(Window.partitionBy("source").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    taken = tail.withColumn("middle", running - F.col("size") / 2).where("middle < rest")
    last = taken.groupBy("source").agg(F.max(F.struct("key", F.coalesce("doc_id", F.lit(-(1 << 62))).alias("id"))).alias("last"))
    last = last.withColumnRenamed("source", "s")
    cuts = ends.join(last, F.col("source").eqNullSafe(F.col("s")), "left").select(
        F.col("source").alias("s"), F.col("coarse").alias("c"), F.col("fine").alias("f"), "last"
    )
    plan = plan.join(cuts, F.col("source").eqNullSafe(F.col("s")), "left").drop("s").withColumnRenamed("source", "s")
    plan = cut_lineage(plan)
    mixed = narrow.join(plan, narrow.source.eqNullSafe(plan.s))
    own = F.struct("key", F.coalesce("doc_id", F.lit(-(1 << 62))).alias("id"))
    earlier = (F.col("coarse") < F.col("c")) | ((F.col("coarse") == F.col("c")) & (F.col("fine") < F.col("f")))
    at_end = (F.col("coarse") == F.col("c")) & (F.col("fine") == F.col("f")) & (own <= F.col("last"))
    extra = F.coalesce(F.when(earlier, 1), F.when(at_end, 1), F.lit(0))
    copies = F.col("epochs") + extra
    return mixed.select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
        (copies * F.col("size")).cast("long").alias("taken"),
    )


def _within(narrow: DataFrame, ends: DataFrame, ranges: list[str]) -> DataFrame:
    """The rows in the range where their source's budget ends, with what is left of it."""
    named = ends.select(F.col("source").alias("s"), *(F.col(r).alias(f"end_{r}") for r in ranges), "rest")
    same = narrow.source.eqNullSafe(named.s)
    for r in ranges:
        same &= narrow[r] == named[f"end_{r}"]
    return narrow.join(named, same).select(*narrow.columns, "rest")


def mixed_documents(docs: DataFrame, id_column: str = "doc_id", **options) -> DataFrame:
    """The rows of `docs` that the mix takes, each as often as it is taken, with the columns of `docs`.

    Documents of size 0 are taken with their source's epochs like others.
    """
    times, id_, wanted = fresh(docs, "times", "mixed_id", "copies_of_id")
    counted = mix(docs, id_column=id_column, **options)
    chosen = counted.groupBy(F.col("doc_id").alias(id_)).agg(F.max("copies").alias(wanted)).where(F.col(wanted) > 0)
    joined = docs.join(chosen, docs[id_column].eqNullSafe(chosen[id_]))
    repeated = joined.withColumn(times, F.explode(F.array_repeat(F.lit(1), F.col(wanted))))
    return repeated.select(*docs.columns)
