"""Quality rules with cross-document line frequency, in DataFrame functions only.

A line (stripped, lower-cased, hashed) that many documents of one host share is
boilerplate. Documents with the same text count once, so that exact copies do
not make a document's own lines look like boilerplate. Lines above the limits
are removed, and a document of which too little is left is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import let, names_apart

SPACES = " \t\n\x0b\x0c\r"
MIN_WORDS = 50
REPEAT_PERCENT = 50


def _repeat_words(words: Column) -> Column:
    """Words in three-word windows that the text holds twice or more."""

    def covered(ranked: Column) -> Column:
        twins = F.filter(
            ranked,
            lambda x, k: F.coalesce(F.get(ranked, k - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(ranked, k + 1)["h"] == x["h"], F.lit(False)),
        )
        return let(F.sort_array(F.transform(twins, lambda x: x["i"])), _spread)

    def _spread(places: Column) -> Column:
        new = F.transform(places, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(places, k + 1) - p, F.lit(3))))
        return F.aggregate(new, F.lit(0).cast("long"), lambda a, x: a + x)

    def counted(hashes: Column) -> Column:
        ranked = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(
            let(ranked, covered)
        )

    def windows(own: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(own) - 3)
        return F.transform(places, lambda i: F.xxhash64(own[i], own[i + 1], own[i + 2]))

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(let(let(hashed, windows), counted))


def text_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed.

    A null text counts as an empty one: no words, and it fails.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    parts = F.split(value, r"[\x20\x09-\x0D]", -1)
    symbols = F.size(F.split(value, r"[#*$%&|<>]", -1)) - 1
    lines = F.filter(F.split(value, "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "")

    def measures(all_parts: Column) -> Column:
        words = F.filter(all_parts, lambda x: x != "")
        return let(
            words,
            lambda w: F.struct(
                F.size(w).cast("long").alias("n_words"),
                (F.char_length(value) - F.size(all_parts) + 1).cast("long").alias("word_chars"),
                _repeat_words(w).alias("n_repeat_words"),
            ),
        )

    duplicates = let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))
    with_counts = df.withColumns(
        {"_m": let(parts, measures), "n_symbols": symbols.cast("long"), "n_dup_lines": duplicates}
    )
    named = with_counts.withColumns({c: F.col(f"_m.{c}") for c in ("n_words", "word_chars", "n_repeat_words")})
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return named.drop("_m").withColumn("base_failed", failed)


def line_rows(df: DataFrame, host: str, text: str) -> DataFrame:
    """Distinct rows of ``_host, _line, __key, _chars, _total``: the different lines of the different texts.

    ``_line`` is the hash of host and normalised line, ``__key`` that of host and
    text, ``_total`` the characters of all different lines of the text.
    """
    lines = F.transform(F.split(F.col(text), "\n", -1), lambda x: F.lower(F.btrim(x, F.lit(SPACES))))
    own = df.select(
        F.xxhash64(host).alias("_host"),
        F.xxhash64(host, text).alias("__key"),
        F.array_distinct(F.filter(lines, lambda x: x != "")).alias("_lines"),
    ).withColumn("_total", F.aggregate("_lines", F.lit(0), lambda a, y: a + F.char_length(y)))
    each = own.select("_host", "__key", "_total", F.explode("_lines").alias("_text"))
    return each.select(
        "_host",
        F.xxhash64("_host", "_text").alias("_line"),
        "__key",
        F.char_length("_text").alias("_chars"),
        "_total",
    ).distinct()


def boilerplate(
    df: DataFrame, lines: DataFrame, host: str, text: str, min_docs: int, max_share: float, max_docs: int | None = None
) -> DataFrame:
    """The lines that more than ``min_docs`` texts of a host hold, and more than ``max_share`` of all it has.

    A line of more than ``max_docs`` texts needs no share, however large the host is.
    """
    counts = lines.groupBy("_host", "_line").agg(F.count("*").alias("_docs")).filter(F.col("_docs") > min_docs)
    texts = df.select(F.xxhash64(host).alias("_host"), F.xxhash64(host, text).alias("__key")).distinct()
    most = F.count("*") * max_share
    known = texts.groupBy("_host").agg((most if max_docs is None else F.least(most, F.lit(float(max_docs)))).alias("_most"))
    return counts.join(known, "_host").filter(F.col("_docs") > F.col("_most")).select("_line")


def losses(
    df: DataFrame, host: str, text: str, min_docs: int = 10, max_share: float = 0.1, max_docs: int | None = None
) -> DataFrame:
    """``__key, _common, _lost, _total`` of the texts with boilerplate: its lines, their characters, and those of all lines."""
    lines = line_rows(df, host, text)
    common = boilerplate(df, lines, host, text, min_docs, max_share, max_docs)
    return lines.join(common, "_line", "left_semi").groupBy("__key").agg(
        F.collect_set("_line").alias("_common"), F.sum("_chars").alias("_lost"), F.max("_total").alias("_total")
    )


def _bare(least_left: float) -> Column:
    """Whether less than ``least_left`` of a text with boilerplate (by characters of different lines) is none."""
    return F.col("_total") - F.col("_lost") < least_left * F.col("_total")


def _without(host: str, text: str) -> Column:
    """The text without the lines in ``_common``."""
    known = F.xxhash64(host)
    lines = F.filter(
        F.split(F.col(text), "\n", -1),
        lambda x: ~F.array_contains("_common", F.xxhash64(known, F.lower(F.btrim(x, F.lit(SPACES))))),
    )
    return F.when(F.col("_common").isNull(), F.col(text)).otherwise(F.array_join(lines, "\n"))


@names_apart
def without_boilerplate(df: DataFrame, host: str = "source", text: str = "text", **limits) -> DataFrame:
    """All rows, their texts without the lines above the limits; the lines left are as they were, in order."""
    keyed = df.withColumn("__key", F.xxhash64(host, text))
    joined = keyed.join(losses(df, host, text, **limits).select("__key", "_common"), "__key", "left")
    return joined.withColumn(text, _without(host, text)).select(*df.columns)


@names_apart
def judge(
    df: DataFrame,
    host: str = "source",
    text: str = "text",
    keep: list[str] | None = None,
    least_left: float = 0.3,
    remove: bool = False,
    **limits,
) -> DataFrame:
    """Add the text counts, base_failed and kept to the columns ``keep`` (all, unless given); no row is lost.

    Null and empty texts have no lines to lose and fail the base rules, which
    judge the text as it was. Documents without a host form one host of their
    own. Rows that agree in host and text count once and are judged alike, so
    repeated rows and ids are harmless. Columns named like those added are
    replaced. With ``remove`` the texts are without the lines above the limits.
    """
    made = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    own = df.drop(*made)
    lost = losses(own, host, text, **limits)
    counted = text_counts(own.withColumn("__key", F.xxhash64(host, text)), text)
    names = [c for c in (keep or own.columns) if c not in made]
    if remove:
        judged = counted.join(lost.withColumn("_bare", _bare(least_left)).drop("_lost", "_total"), "__key", "left")
        judged = judged.withColumn(text, _without(host, text))
    else:
        bare = lost.filter(_bare(least_left)).select("__key", F.lit(True).alias("_bare"))
        judged = counted.select(*names, "__key", *made[:-1]).join(bare, "__key", "left")
    kept = ~F.col("base_failed") & ~F.coalesce("_bare", F.lit(False))
    return judged.withColumn("kept", kept).select(*names, *made)


@names_apart
def accepted(df: DataFrame, **options) -> DataFrame:
    """The documents that are kept, with their own columns, without the lines above the limits."""
    return judge(df, remove=True, **options).filter("kept").select(*df.columns)
