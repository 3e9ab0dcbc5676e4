"""Quality rules and cross-document line frequency (DataFrame functions only).

A line that stands in too many documents of its host is boilerplate. Lines are normalised
(trimmed, A-Z lower-cased, white space runs as one space) and hashed; per host the distinct
documents that hold a line are counted, where copies of one text are one document. Lines in
more documents than ``max(min_docs, share x documents of the host)`` are removed, and a
document that keeps less than ``keep_share`` of its words is rejected.

The text is read once: ``measured`` stores the rule counts and one (hash, words) pair per
line, and everything after works on these. Counts are summed in the map tasks before the
shuffle, the lines above the limit are joined back by size (AQE splits a hot line), and
removed words are summed by a row number, so no key gathers the rows of a host or a line.

Defined cases: a null text counts as empty, has no words and fails the base rules; a null
host is a host of its own; repeated rows and repeated or null ids are judged row by row; an
empty table gives an empty result; columns beyond those used pass through
``remove_frequent_lines`` and do not matter to ``quality_rules``. Line hashes have 64 bits.
A text of n words needs a few arrays of n numbers in its task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from erpweave.llm.stored import stored

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with ``value`` computed once however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """The ``[^\\x20\\x09-\\x0D]+`` runs of a text."""
    return F.filter(F.split(text, SPACE + "+"), lambda w: w != "")


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _covered(places: Column) -> Column:
    """Words inside windows that start at the ascending ``places``."""
    return F.aggregate(
        F.transform(places, lambda p, k: F.least(F.coalesce(F.get(places, k + 1) - p, F.lit(WINDOW)), F.lit(WINDOW))),
        F.lit(0).cast("long"),
        lambda total, x: total + x,
    )


def _repeated_places(grams: Column) -> Column:
    """Ascending starts of the windows that are found twice or more."""
    ordered = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def starts(s: Column) -> Column:
        def again(x: Column, k: Column) -> Column:
            h = x.getField("h")
            before = F.when(k > 0, F.get(s, k - 1).getField("h"))
            same = (F.coalesce(before == h, F.lit(False))) | F.coalesce(F.get(s, k + 1).getField("h") == h, F.lit(False))
            return F.when(same, x.getField("i"))

        return F.sort_array(F.filter(F.transform(s, again), lambda i: i.isNotNull()))

    return _let(ordered, starts)


def repeated_words(words: Column) -> Column:
    """Words in windows of 8 words that are found twice or more in the text, first ones included."""
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    grams = _let(
        hashed,
        lambda h: F.when(
            F.size(h) > WINDOW,
            F.transform(
                F.sequence(F.lit(0), F.size(h) - WINDOW),
                lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]),
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    return _let(
        grams,
        lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0).cast("long")).otherwise(
            _let(_repeated_places(g), _covered)
        ),
    )


def normal_line(line: Column) -> Column:
    """Trimmed, lower-case (A-Z) and with single spaces."""
    return F.translate(F.trim(F.regexp_replace(line, SPACE + "+", " ")), UPPER, LOWER)


def measured(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, host, text_key, the rule counts and ``lines`` (h, w) per row of ``docs``."""
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD))
    found = docs.select(
        F.col("doc_id"), F.col(host).alias("host"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    ).select("doc_id", "host", "text", words_of(F.col("text")).alias("words"))
    return found.select(
        "doc_id",
        "host",
        F.md5("text").alias("text_key"),
        F.size("words").cast("long").alias("n_words"),
        F.char_length(_without(F.col("text"), SPACES)).cast("long").alias("word_chars"),
        (F.char_length("text") - F.char_length(_without(F.col("text"), SYMBOLS))).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
        F.transform(
            lines,
            lambda x: F.struct(F.xxhash64(normal_line(x)).alias("h"), F.regexp_count(x, F.lit(WORD)).alias("w")),
        ).alias("lines"),
    )


def base_failed() -> Column:
    """The rules of one document: too few words, or too many in repeated windows."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def frequent_lines(rows: DataFrame, min_docs: int = 10, share: float = 0.05) -> DataFrame:
    """host_key, h and n_docs of the lines in more distinct documents of a host than its limit."""
    texts = rows.groupBy("host_key", "text_key").agg(F.first("lines").alias("lines"))
    hosts = rows.select("host_key", "text_key").distinct().groupBy("host_key").agg(F.count("*").alias("host_docs"))
    counts = (
        texts.select("host_key", F.explode(F.array_distinct(F.transform("lines", lambda x: x["h"]))).alias("h"))
        .groupBy("host_key", "h")
        .agg(F.count("*").alias("n_docs"))
        .filter(F.col("n_docs") > min_docs)
    )
    return (
        counts.join(hosts, "host_key")
        .filter(F.col("n_docs") > F.greatest(F.lit(float(min_docs)), F.lit(share) * F.col("host_docs")))
        .select("host_key", "h", "n_docs")
    )


def _host_key(host: Column) -> Column:
    """A non-null join key: null and every string differ."""
    return F.coalesce(F.concat(F.lit("s"), host.cast("string")), F.lit("n"))


def quality_rules(
    docs: DataFrame, host: str = "source", min_docs: int = 10, share: float = 0.05, keep_share: float = 0.3
) -> DataFrame:
    """The rule counts per row, n_removed_words of lines above the host's limit, and the verdict."""
    spark = docs.sparkSession
    rows = measured(docs, host).withColumn("host_key", _host_key(F.col("host")))
    rows = stored(spark, rows.withColumn("row", F.monotonically_increasing_id()), "line-rows")
    frequent = stored(spark, frequent_lines(rows, min_docs, share), "line-frequent")
    removed = (
        rows.select("row", "host_key", F.explode("lines").alias("line"))
        .select("row", "host_key", F.col("line.h").alias("h"), F.col("line.w").alias("w"))
        .join(frequent.select("host_key", "h"), ["host_key", "h"])
        .groupBy("row")
        .agg(F.sum("w").cast("long").alias("n_removed_words"))
    )
    left = F.col("n_words") - F.col("n_removed_words")
    depleted = left < keep_share * F.col("n_words")
    return (
        rows.drop("lines", "host_key", "text_key")
        .join(removed, "row", "left")
        .withColumn("n_removed_words", F.coalesce("n_removed_words", F.lit(0).cast("long")))
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & ~depleted)
        .select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_removed_words", "base_failed", "kept",
        )
    )


def remove_frequent_lines(
    docs: DataFrame, host: str = "source", min_docs: int = 10, share: float = 0.05, keep_share: float = 0.3
) -> DataFrame:
    """``docs`` that pass the rules, with the lines above their host's limit cut from ``text``.

    All columns of ``docs`` stay. A host's frequent lines travel to its documents as one array:
    a host has at most (mean lines of its documents) / ``share`` of them.
    """
    spark = docs.sparkSession
    plain = measured(docs, host).withColumn("host_key", _host_key(F.col("host")))
    lines = stored(spark, plain.select("host_key", "text_key", "lines"), "line-rows")
    frequent = frequent_lines(lines, min_docs, share)
    per_host = stored(
        spark,
        frequent.groupBy("host_key").agg(F.collect_set("h").alias("cut")).withColumnRenamed("host_key", "__host_key"),
        "line-frequent",
    )
    names = [F.col(f"`{c}`") for c in docs.columns]
    text = F.coalesce(F.col("text"), F.lit(""))
    rest = F.filter(
        F.split(text, "\n"),
        lambda x: ~F.array_contains(F.col("__cut"), F.xxhash64(normal_line(x))) | ~x.rlike(WORD),
    )
    judged = (
        docs.withColumn("__host_key", _host_key(F.col(host)))
        .join(per_host.withColumnRenamed("cut", "__cut"), "__host_key", "left")
        .withColumn("__words", words_of(text))
        .withColumn("__repeat", repeated_words(F.col("__words")))
        .withColumn("__text", F.when(F.col("__cut").isNull(), F.col("text")).otherwise(F.array_join(rest, "\n")))
    )
    n = F.size("__words")
    fails = (n < MIN_WORDS) | (100 * F.col("__repeat") > MAX_REPEAT_PERCENT * n)
    left = F.regexp_count(F.coalesce("__text", F.lit("")), F.lit(WORD))
    return judged.filter(~fails & (left >= keep_share * n)).withColumn("text", F.col("__text")).select(*names)
