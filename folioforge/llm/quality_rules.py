"""Quality rules on whole texts and a log-likelihood ratio of hashed n-grams.

Words and word pairs are hashed into buckets. Two multinomials over the buckets are counted:
one over a trusted target, one over the whole raw corpus. A text's score is the mean, over
its n-grams, of the log of target probability by raw probability. Texts written like the
target score about zero or above; texts full of n-grams that the target lacks, far below.
Only built-in functions are used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from folioforge.functions.binding import bound
from folioforge.llm.common import fresh, words

BUCKETS = 1 << 16
PRIOR = 20
#: Trusted ids that every task gets at a time.
IDS_AT_ONCE = 1_000_000
#: Nats per n-gram below which a text is rejected.
THRESHOLD = -0.06
#: More than the words of any text.
_PLACES = 1 << 31
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50


def ngrams(word_list: str, hashes: str, buckets: int) -> Column:
    """Buckets of the words in a column of arrays and of the pairs of neighbouring words, repeats included.

    `hashes` names a column with the hashes of the words. A word's hash is XXH64 with seed 42, a pair's the
    second word's XXH64 with the first's hash as seed.
    """
    array = F.col(word_list)
    single = F.transform(hashes, lambda h: _bucket(h, buckets))
    heads = F.slice(array, 1, F.greatest(F.size(array) - 1, F.lit(0)))
    pairs = F.transform(heads, lambda w, i: _bucket(F.xxhash64(w, F.get(array, i + 1)), buckets))
    return F.concat(single, pairs)


def _bucket(ngram: Column, buckets: int) -> Column:
    if buckets & (buckets - 1) == 0:  # never null, so arrays of buckets are sorted as plain numbers
        return ngram.bitwiseAND(F.lit(buckets - 1)).cast("int")
    return F.pmod(ngram, F.lit(buckets)).cast("int")


def told_apart(docs: DataFrame, trusted: DataFrame, name: str, ids_at_once: int = IDS_AT_ONCE) -> DataFrame:
    """`docs` and a column `name`: 1 for rows with a trusted doc_id, else null.

    Ids are broadcast, so no text is shuffled. More than about `ids_at_once` are split by a hash into
    slices, each of which meets the documents of the same hash in a pass of its own.
    """
    ids = trusted.select("doc_id").where("doc_id is not null").distinct()
    slices = max(1, -(-ids.count() // ids_at_once))
    slice_of = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(slices))
    parts = []
    for k in range(slices):
        some, marks = (docs, ids) if slices == 1 else (docs.where(slice_of == k), ids.where(slice_of == k))
        marks = F.broadcast(marks.withColumn(name, F.lit(1)))
        parts.append(some.join(marks, "doc_id", "left").select(*docs.columns, name))
    return reduce(DataFrame.unionAll, parts)


def ratio_table(
    docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, ids_at_once: int = IDS_AT_ONCE
) -> DataFrame:
    """One row, one array: the log ratio of each bucket.

    `PRIOR` counts are added to each bucket of the corpus, and the target's share of them to each of
    the target, so a bucket that is hardly ever seen says little.

    `docs` has doc_id and text, `trusted` the doc_id of target documents. All documents are
    counted for the corpus, and all trusted ones for the target. Counts are summed before the
    shuffle and there are `buckets` of them at any size.
    Without trusted documents every bucket falls the lower the more the corpus has of it.
    """
    counts = count_table(docs, trusted, buckets, ids_at_once)
    share = F.coalesce(F.nullif(F.col("all_t"), F.lit(0)) / F.col("all_r"), F.lit(1.0))
    ratio = lambda x: F.log((x["t"] + PRIOR * share) / (x["r"] + PRIOR)) - F.log(share)
    return counts.select(F.transform("each", ratio).alias("ratios"))


def count_table(
    docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, ids_at_once: int = IDS_AT_ONCE
) -> DataFrame:
    """One row: each, an array with the counts r of the corpus and t of the target in every bucket, and
    their sums all_r and all_t."""
    told = told_apart(docs.select("doc_id", "text"), trusted, "target", ids_at_once)
    listed = told.select("target", words(F.col("text")).alias("words"))
    # hashed behind the explode, where Spark compiles expressions; those inside array functions it interprets
    placed = listed.select("target", "words", F.posexplode("words").alias("place", "word"))
    after = F.get("words", F.col("place") + 1)
    pair = F.when(after.isNotNull(), _bucket(F.xxhash64("word", after), buckets))
    both = F.array(_bucket(F.xxhash64("word"), buckets), pair)
    counts = (
        placed.select("target", F.explode(both).alias("bucket"))
        .where("bucket is not null")
        .groupBy("bucket")
        .agg(F.count("*").alias("r"), F.count("target").alias("t"))
    )
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    full = every.join(counts, "bucket", "left").fillna(0, ["r", "t"])
    each = F.array_sort(F.collect_list(F.struct("bucket", "r", "t"))).alias("each")
    return full.agg(F.sum("r").alias("all_r"), F.sum("t").alias("all_t"), each)


def _listed(numbers: list) -> Column:
    return F.split(F.lit(",".join(map(repr, numbers))), ",")


def _others_score(rows: DataFrame, counts: Row, target: str) -> DataFrame:
    """Adds score, the mean log ratio of a row's n-grams by the counts of all other rows.

    The row's own n-grams are taken out of the corpus and, where `target` is set, out of the target.
    Its buckets are sorted, and a run of equal ones is looked up once. Most runs are a single bucket: those are
    told by their neighbours and summed at once, with all that is the same for a row worked out before. Only
    the rest, in which buckets stand more than once, is cut into runs.
    """
    # as doubles, which hold whole numbers as well and need no casts per n-gram; r without one n-gram of the row
    t = _listed([x["t"] for x in counts["each"]]).cast("array<double>")
    r = _listed([x["r"] - 1 + PRIOR for x in counts["each"]]).cast("array<double>")
    rows = rows.withColumns({"own": F.size("ngrams"), "inside": F.coalesce(F.col(target), F.lit(0)).cast("int")})
    all_t, all_r = F.lit(counts["all_t"]) - F.col("inside") * F.col("own"), F.lit(counts["all_r"]) - F.col("own")
    share = F.coalesce(F.nullif(all_t, F.lit(0)) / F.nullif(all_r, F.lit(0)), F.lit(1.0))
    rows = rows.withColumn("share", share)
    # before the first bucket and behind the last stand ones that are none
    between = F.concat(F.array(F.lit(-1)), F.sort_array("ngrams"), F.array(F.lit(-2)))
    rows = rows.withColumns({"added": PRIOR * F.col("share"), "buckets": between})
    once, often = (bound(F.col("buckets"), f) for f in (
        lambda all_: F.filter(all_, lambda b, i: (b != F.get(all_, i + 1)) & (b != F.get(all_, i - 1))),
        lambda all_: F.filter(all_, lambda b, i: (b == F.get(all_, i + 1)) | (b == F.get(all_, i - 1))),
    ))
    rows = rows.withColumns({"once": once, "often": F.concat(often, F.array(F.lit(-1)))})
    # where a run ends
    ends = F.filter(
        F.sequence(F.lit(0), F.size("often") - 1), lambda i: F.get("often", i) != F.get("often", i + 1)
    )
    rows = rows.withColumn("ends", ends)
    values = F.transform("ends", lambda i: F.get("often", i))
    counted = F.transform("ends", lambda i, k: (i - F.coalesce(F.get("ends", k - 1), F.lit(-1))).cast("double"))

    def of_singles(added: Column) -> Column:
        return F.aggregate("once", F.lit(0.0), lambda acc, b: acc + F.log((F.get(t, b) + added) / F.get(r, b)))

    def of_runs(inside: Column, added: Column) -> Column:
        def of_run(b: Column, c: Column) -> Column:
            return c * F.log((F.get(t, b) - inside * c + added) / (F.get(r, b) + 1.0 - c))

        return F.aggregate(F.zip_with(values, counted, of_run), F.lit(0.0), lambda acc, x: acc + x)

    inside = F.col("inside").cast("double")
    total = bound(F.col("added") - inside, of_singles) + bound(
        inside, lambda inside: bound(F.col("added"), lambda added: of_runs(inside, added))
    )
    score = total / F.greatest(F.col("own"), F.lit(1)) - F.when(F.col("own") > 0, F.log("share")).otherwise(0.0)
    return rows.withColumn("score", score)


def _windows(hashes: Column) -> Column:
    """Hashes of the 3-word windows, in order, from those of the words."""
    heads = F.slice(hashes, 1, F.greatest(F.size(hashes) - 2, F.lit(0)))
    return F.transform(heads, lambda h, i: F.xxhash64(h, F.get(hashes, i + 1), F.get(hashes, i + 2)))


def measures(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """Adds to each row, packed as `row`: words, their hashes, and the figures of the base rules.

    A null text counts as one without words. Windows are compared by 64-bit hashes.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    listed = docs.select(F.struct(*docs.columns).alias("row"), words(text).alias("words"), text.alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    hashed = listed.select(
        "row",
        "words",
        lines.alias("lines"),
        F.array_join("words", "").alias("joined"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    hashed = hashed.withColumn("windows", _windows(F.col("hashes")))
    distinct = F.size(F.array_distinct("windows")) == F.size("windows")
    # plain numbers, the first 33 bits of a window's hash and its place, are sorted faster than pairs; only
    # windows with a neighbour of the same 33 bits may be repeated, and only those are sorted by whole hashes
    short = F.transform("windows", lambda h, i: h.bitwiseAND(F.lit(-_PLACES)).bitwiseOR(i.cast("long")))
    empty = F.array().cast("array<bigint>")
    hashed = hashed.withColumn("short", F.when(distinct, empty).otherwise(F.sort_array(short)))
    same = lambda x, y: F.shiftright(x, 31) == F.shiftright(y, 31)
    maybe = bound(
        F.col("short"),
        lambda all_: F.filter(all_, lambda x, i: same(x, F.get(all_, i + 1)) | same(x, F.get(all_, i - 1))),
    )
    at = lambda x: x.bitwiseAND(F.lit(_PLACES - 1)).cast("int")
    placed = F.transform(maybe, lambda x: F.struct(F.get("windows", at(x)).alias("h"), at(x).alias("i")))
    ordered = hashed.select("row", "words", "hashes", "lines", "joined", F.sort_array(placed).alias("placed"))
    near = lambda i, step: F.get(F.col("placed"), i + step)["h"]
    repeated = F.filter(
        "placed",
        lambda x, i: F.coalesce(near(i, -1) == x["h"], F.lit(False)) | F.coalesce(near(i, 1) == x["h"], F.lit(False)),
    )
    covered = F.flatten(F.transform(repeated, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
    n_chars = F.length("joined")
    return ordered.select(
        "row",
        "words",
        "hashes",
        F.size("words").cast("long").alias("n_words"),
        n_chars.cast("long").alias("word_chars"),
        (n_chars - F.length(F.regexp_replace("joined", "[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct(covered)).cast("long").alias("n_repeat_words"),
    )


def judged(
    docs: DataFrame,
    trusted: DataFrame,
    threshold: float = THRESHOLD,
    buckets: int = BUCKETS,
    text_column: str = "text",
    leave_out: bool = False,
) -> DataFrame:
    """`docs` packed as `row`, with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, score and kept.

    base_failed: under 50 words, or over half of the words in repeated windows. Such rows are not
    kept; the others are if their score, the mean log ratio per n-gram, reaches the threshold. The
    score of a text without words is 0. The two counts and the verdicts cover every row alike;
    no rows give no rows.

    With `leave_out` a row is scored by the counts of the other rows, so that a clean text is not
    rejected for n-grams that only it has, whether it is in the target or not and at any size.
    """
    # a few numbers per bucket, so the driver gets the same amount at any size
    if leave_out:
        (target,) = fresh(docs, "target")
        told = measures(told_apart(docs, trusted, target), text_column)
        told = told.withColumn("ngrams", ngrams("words", "hashes", buckets))
        scored = _others_score(told, count_table(docs, trusted, buckets).first(), f"row.{target}")
        figures = scored.withColumn("row", F.struct(*(F.col("row")[c].alias(c) for c in docs.columns)))
    else:
        ratios = _listed(ratio_table(docs, trusted, buckets).first()["ratios"]).cast("array<double>")
        figures = measures(docs, text_column).withColumn("ngrams", ngrams("words", "hashes", buckets))
        total = F.aggregate("ngrams", F.lit(0.0), lambda acc, x: acc + F.get(ratios, x))
        figures = figures.withColumn("score", total / F.greatest(F.size("ngrams"), F.lit(1)))
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )
    scored = figures.select(
        "row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        "score",
    )
    kept = scored.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
    # counted, and so computed before any filter on `kept`: pushed below the arrays of words, such a
    # filter would split the text anew for every element
    return kept.observe("quality rules", F.count("*").alias("judged"), F.count_if("kept").alias("kept"))


def trusted_by_labels(labels: DataFrame) -> DataFrame:
    """The trusted target: documents labelled as good."""
    return labels.where("quality = 1").select("doc_id")
