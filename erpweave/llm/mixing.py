"""Mixing sources to target weights by capped water-filling (DataFrame functions only).

Sources sorted by code point (null last) get the weights of ``weights`` in turn and share
``share`` times all words. A source's target stops at ``max_epochs`` times its words; the
excess is shared out again by weight until no source is above its cap. That fixed point has
a closed form: with sources sorted by cap / weight, the saturated ones are a prefix, and the
rest get weight times one common level.

Every document of a source is taken ``floor(target / size)`` times; the fractional rest is
filled with documents in the order of a seeded hash, up to the document that brings the
source nearest to its target. The place where that order is cut is found by radix descent
over hash prefixes with pre-aggregated counts (256 buckets a level), so that no window ever
holds more than 256 rows of one source plus the few hashes that share an 8-digit prefix. The
hash is of doc_id and text, so rows of a null or repeated id are decided one by one. Rows equal
in both have one hash and count as one entry; if the cut falls among them, as many of them as
bring the source nearest to its target are taken, told apart by their place in a stored table.

Defined cases: a null or empty text has size 0; a source of no words has target 0 and none
of its documents is taken; repeated rows are decided row by row, and rows equal in doc_id and
text stand for each other; a null source is a source of its own, sorted last; an empty table
gives an empty result. Input columns
beyond the three used ones pass through ``mix_documents`` whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from erpweave.llm.stored import stored as _stored

WORD = r"[^\x20\x09-\x0D]+"
LEVELS = 4  # of two hex digits each


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; null counts 0."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def seeded_hash(key: Column, text: Column, seed: int) -> Column:
    """32 hex digits of id and text that order the documents of a source; nulls count as ``null`` and empty."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")), F.lit(":"), F.coalesce(text, F.lit(""))))


def _source_key(source: Column) -> Column:
    """A non-null join key: null and every string differ."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n"))


def document_sizes(docs: DataFrame, seed: int = 0) -> DataFrame:
    """doc_id, source, key, size, h and line (a number of its own, once stored) per row of ``docs``."""
    return docs.select(
        F.col("doc_id"),
        F.col("source"),
        _source_key(F.col("source")).alias("key"),
        word_count(F.col("text")).alias("size"),
        seeded_hash(F.col("doc_id"), F.col("text"), seed).alias("h"),
        F.monotonically_increasing_id().alias("line"),
    )


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, max_epochs: int = 2
) -> DataFrame:
    """key, source_size, target, whole and goal per source (one row per source).

    ``whole`` is the number of full repetitions and ``goal`` the words that the fractional
    repetition should take. The windows run over the per-source rows, not over documents.
    """
    per = sizes.groupBy("key", "source").agg(F.sum("size").cast("long").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    per = per.withColumn("w", weight.cast("long")).withColumn("cap", F.col("source_size") * max_epochs)
    everything = Window.partitionBy()
    filled = Window.orderBy((F.col("cap") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    per = (
        per.withColumn("total", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("all_w", F.sum("w").over(everything))
        .withColumn("full_cap", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("full_w", F.coalesce(F.sum("w").over(before), F.lit(0)))
        # The level if all sources before this one are full and this one is not.
        .withColumn("own_level", (F.col("total") - F.col("full_cap")) / (F.col("all_w") - F.col("full_w")))
        .withColumn("open", F.col("own_level") * F.col("w") <= F.col("cap"))
        # The first source that is not full sets the level of all that follow.
        .withColumn("level", F.first(F.when(F.col("open"), F.col("own_level")), ignorenulls=True).over(
            filled.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    )
    target = F.when(F.col("level").isNull(), F.col("cap").cast("double")).otherwise(
        F.least(F.col("w") * F.col("level"), F.col("cap").cast("double"))
    )
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    return (
        per.withColumn("target", target)
        .withColumn("whole", whole.cast("long"))
        .withColumn("goal", F.col("target") - F.col("whole") * F.col("source_size"))
        .select("key", "source_size", "target", "whole", "goal")
    )


def _cuts(spark: SparkSession, sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Adds cut_h, cut_rows and split per source: documents of smaller hashes, and ``cut_rows`` of
    hash ``cut_h``, are taken once more; ``split`` if that hash has more rows.

    A document belongs to the extra repetition while the words before it and up to it stay
    within twice the goal together, which ends the sample at the document nearest to the goal.
    """
    state = _stored(
        spark,
        targets.withColumn("prefix", F.when(F.col("goal") > 0, F.lit(""))).withColumn("base", F.lit(0).cast("long")),
        "mix-level",
    )
    for level in range(LEVELS):
        digits = 2 * level
        inside = state.filter("prefix is not null").select("key", "prefix", "base", "goal")
        ordered = Window.partitionBy("key").orderBy("bucket")
        found = (
            sizes.select("key", "h", "size")
            .join(inside, "key")
            .filter(F.substring("h", 1, digits) == F.col("prefix") if digits else F.lit(True))
            .groupBy("key", F.substring("h", 1, digits + 2).alias("bucket"))
            .agg(F.sum("size").alias("n"), F.first("base").alias("base"), F.first("goal").alias("goal"))
            .withColumn("upto", F.col("base") + F.sum("n").over(ordered))
            .filter(F.col("upto") > F.col("goal"))
            .groupBy("key")
            .agg(F.min_by(F.struct("bucket", (F.col("upto") - F.col("n")).alias("before")), "bucket").alias("hit"))
        )
        # Without a crossing bucket all documents of the source belong to the sample: "g" sorts
        # after every hex digit, matches no prefix, and stays.
        nxt = (
            state.withColumnRenamed("prefix", "was")
            .join(found, "key", "left")
            .withColumn(
                "prefix",
                F.when(F.col("was").isNull(), F.lit(None).cast("string"))
                .when(F.col("was") == "g", F.lit("g"))
                .otherwise(F.coalesce(F.col("hit.bucket"), F.lit("g"))),
            )
            .withColumn("base", F.coalesce(F.col("hit.before"), F.col("base")))
            .drop("was", "hit")
        )
        state = _stored(spark, nxt, "mix-level")
    inside = state.filter("prefix is not null and prefix <> 'g'").select("key", "prefix", "base", "goal")
    ordered = Window.partitionBy("key").orderBy("h")
    doubled = 2 * F.col("goal") - 2 * F.col("before")
    last = (
        sizes.select("key", "h", "size")
        .join(inside, "key")
        .filter(F.substring("h", 1, 2 * LEVELS) == F.col("prefix"))
        .groupBy("key", "h")
        .agg(F.count("*").alias("rows"), F.max("size").alias("size"), F.first("base").alias("base"), F.first("goal").alias("goal"))
        .withColumn("before", F.col("base") + F.sum(F.col("rows") * F.col("size")).over(ordered) - F.col("rows") * F.col("size"))
        # The i-th row of a hash belongs to the sample while 2 * (before + i * size) - size <= 2 * goal.
        .withColumn(
            "fit",
            F.when(F.col("size") == 0, F.when(doubled >= 0, F.col("rows")).otherwise(0))
            .otherwise(F.least(F.col("rows"), F.floor((doubled + F.col("size")) / (2 * F.greatest("size", F.lit(1))))))
            .cast("long"),
        )
        .filter("fit > 0")
        .groupBy("key")
        .agg(F.max(F.struct("h", "fit", (F.col("fit") < F.col("rows")).alias("split"))).alias("last"))
    )
    out = state.join(last, "key", "left").select(
        "key", "source_size", "target", "whole",
        F.coalesce(F.col("last.h"), F.col("prefix")).alias("cut_h"),
        F.coalesce(F.col("last.fit"), F.lit(0)).alias("cut_rows"),
        F.coalesce(F.col("last.split"), F.lit(False)).alias("split"),
    )
    return _stored(spark, out, "mix-cuts")


def _with_copies(rows: DataFrame, cuts: DataFrame, again: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``rows`` (key, h and more) with ``copies``; ``again`` gives split rows their line in a stored table.

    Only where a cut falls among equal rows are those numbered: within the files they were
    stored in, shifted by the counts of the files before.
    """
    joined = rows.join(cuts, "key")
    at_cut = F.coalesce(F.col("split") & (F.col("h") == F.col("cut_h")), F.lit(False))
    more = F.coalesce(F.col("h") <= F.col("cut_h"), F.lit(False))
    plain = joined.withColumn("copies", F.col("whole") + more.cast("long"))
    if cuts.filter("split").isEmpty():
        return plain
    equal = again(joined.filter(at_cut)).withColumn("part", F.shiftright("line", 33))
    files = equal.groupBy("key", "part").agg(F.count("*").alias("here"))
    along = Window.partitionBy("key").orderBy("part")
    files = files.withColumn("shift", F.sum("here").over(along) - F.col("here")).drop("here")
    place = F.row_number().over(Window.partitionBy("key", "part").orderBy("line")) + F.col("shift")
    numbered = equal.join(files, ["key", "part"]).withColumn("copies", F.col("whole") + (place <= F.col("cut_rows")).cast("long"))
    return plain.filter(~at_cut).unionByName(numbered.select(*plain.columns))


def mix_plan(
    docs: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    max_epochs: int = 2,
    seed: int = 0,
) -> DataFrame:
    """doc_id, size, source_size, target, copies and taken per row of ``docs``.

    The texts are read once; all further steps read the stored (doc_id, source, size, h).
    """
    spark = docs.sparkSession
    sizes = _stored(spark, document_sizes(docs, seed), "mix-sizes")
    cuts = _cuts(spark, sizes, source_targets(sizes, weights, share, max_epochs))
    return _with_copies(sizes.drop("source"), cuts, lambda equal: equal).select(
        "doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mix_documents(
    docs: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    max_epochs: int = 2,
    seed: int = 0,
) -> DataFrame:
    """The mix itself: every row of ``docs``, with all its columns, as often as it is taken.

    The decision needs only the hash of the row and the cut of the source, so the texts are
    not shuffled when the per-source table is small enough for Spark to broadcast it. Rows equal
    in doc_id and text are written and read once more, if a cut falls among them.
    """
    spark = docs.sparkSession
    sizes = _stored(spark, document_sizes(docs, seed), "mix-sizes")
    cuts = _cuts(spark, sizes, source_targets(sizes, weights, share, max_epochs))
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        _source_key(docs["source"]).alias("key"),
        seeded_hash(docs["doc_id"], docs["text"], seed).alias("h"),
    )
    mixed = _with_copies(rows, cuts, lambda equal: _stored(spark, equal.withColumn("line", F.monotonically_increasing_id()), "mix-equal"))
    return (
        mixed.filter("copies > 0")
        .select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("copy"))
        .select("row.*")
    )
