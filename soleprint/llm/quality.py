"""Quality rules, line first: judge every line, take out those that fail, then judge the document
by how much of it is left.

Everything is a DataFrame expression on one row, so nothing is shuffled, however rows repeat.
"""

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from soleprint.llm.words import WORD, word_array

# The symbols counted by the base figures.
SYMBOLS = "[#*$%&|<>]"
# Marks that may end a sentence, with closing quotes and brackets behind them.
SENTENCE_END = r"""[.!?…。:;]["')\]»”’]*[\x20\x09-\x0D]*$"""
# Symbols, and two or more sentence marks in a row other than dots.
MARKS = r"[#*$%&<>]|[!?]{2,}"
# Marks between the entries of a menu or a bread-crumb trail.
SEPARATORS = r"[|»›·•]"
# Texts that sites put around their content, in lower case.
BOILERPLATE = (
    "all rights reserved", "cookie policy", "privacy policy", "terms of use", "terms of service",
    "accept all cookies", "accept cookies", "enable javascript", "javascript is disabled",
    "lorem ipsum", "subscribe to our newsletter", "sign in to continue", "sign up to continue",
)


@dataclass(frozen=True)
class LineRules:
    """Limits of the rules, in characters, and in percent of a line's or a document's characters.

    A line fails the punctuation rule if it is shorter than ``short_line`` and has no sentence
    end, or if symbols and repeated sentence marks come to more than ``mark_share``; the
    navigation rule with ``separators`` marks between entries that come to ``separator_share``;
    the boilerplate rule with one of the known phrases if it is shorter than ``phrase_line``.
    A document must keep ``kept_share`` of the characters in its words. ``min_words`` and
    ``repeat_share`` (percent of the words) belong to the base rule.
    """

    short_line: int = 60
    mark_share: int = 5
    separators: int = 2
    separator_share: int = 3
    phrase_line: int = 300
    kept_share: int = 50
    min_words: int = 50
    repeat_share: int = 50


def _without(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, ""))


def line_passes(line: Column, rules: LineRules = LineRules()) -> Column:
    """True for a line that no rule objects to; lines without a word pass."""
    size = F.length(line)
    punctuation = (
        ((size < rules.short_line) & ~line.rlike(SENTENCE_END))
        | ((size - _without(line, MARKS)) * 100 > size * rules.mark_share)
    )
    # Each mark becomes two characters: the growth is the number of marks.
    marks = F.length(F.regexp_replace(line, SEPARATORS, "||")) - size
    navigation = (marks >= rules.separators) & (marks * 100 >= size * rules.separator_share)
    phrases = [F.lower(line).contains(phrase) for phrase in BOILERPLATE]
    boilerplate = (size < rules.phrase_line) & reduce(or_, phrases)
    return ~line.rlike(WORD) | ~(punctuation | navigation | boilerplate)


def _repeat_words(rows: DataFrame) -> tuple[DataFrame, Column]:
    """``rows`` with further columns, and the number of words in windows of three that repeat.

    Windows whose hashes are all different are different; only windows with equal hashes are built
    as texts and compared. The arrays are columns of their own, each used more than once by the
    next step, so that the plan does not build them anew for each element.
    """
    def window(i: Column, how) -> Column:
        return how(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2))
    rows = rows.withColumn("hashes", F.when(F.size("words") > 2, F.transform(
        F.sequence(F.lit(0), F.size("words") - 3), lambda i: window(i, F.xxhash64))))
    repeats = F.size(F.array_distinct("hashes")) < F.size("hashes")
    rows = rows.withColumn("by_hash", F.when(repeats, F.sort_array(
        F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))

    def again(column: str, key: str) -> Column:
        return F.filter(column, lambda x, j: (
            (x[key] == F.get(column, j - 1)[key]) | (x[key] == F.get(column, j + 1)[key])))
    rows = rows.withColumn("by_text", F.sort_array(F.transform(again("by_hash", "h"), lambda x: (
        F.struct(window(x["i"], lambda *w: F.concat_ws(" ", *w)).alias("w"), x["i"].alias("i"))))))
    covered = F.size(F.array_distinct(F.flatten(F.transform(
        again("by_text", "w"), lambda x: F.sequence(x["i"], x["i"] + 2)))))
    return rows, F.when(F.col("by_text").isNull(), 0).otherwise(covered).cast("long")


def line_quality(
    docs: DataFrame, text: str = "text", rules: LineRules = LineRules(), prefix: str = "",
) -> DataFrame:
    """All columns of ``docs`` and the figures and verdict of each row.

    Added columns, after ``prefix``: ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``base_failed``, ``cleaned`` (the text without failed lines), ``kept``.
    Columns of ``docs`` with the same names are replaced; choose another prefix to keep them.

    A null text counts as one without words, and ``cleaned`` is then empty; a document without
    words fails. Repeated rows are judged one by one and all stay; very long texts are judged
    whole; an empty table stays empty.
    """
    own = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
           "cleaned", "kept"]
    names = {prefix + name for name in own}
    others = [docs[f"`{c}`"] for c in docs.columns if c not in names]
    rows = docs.select(F.struct(*others, F.lit(0).alias("quality.")).alias("row"),
                       F.coalesce(docs[f"`{text}`"], F.lit("")).alias("text"))
    rows = rows.withColumns({"words": word_array(F.col("text")), "lines": F.split("text", "\n")})
    rows = rows.withColumns({
        "passed": F.filter("lines", lambda line: line_passes(line, rules)),
        "with_word": F.filter("lines", lambda line: line.rlike(WORD)),
    })
    rows, repeat_words = _repeat_words(rows)
    word_chars = F.length(F.array_join("words", ""))
    cleaned = F.array_join("passed", "\n")
    values = rows.select(
        "row", cleaned.alias("cleaned"),
        F.size("words").cast("long").alias("n_words"),
        word_chars.cast("long").alias("word_chars"),
        (F.length("text") - _without(F.col("text"), SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("with_word") - F.size(F.array_distinct("with_word"))).cast("long")
        .alias("n_dup_lines"),
        repeat_words.alias("n_repeat_words"),
        F.when(F.size("passed") == F.size("lines"), word_chars)
        .otherwise(_without(cleaned, r"[\x20\x09-\x0D]+")).cast("long").alias("left"),
        # A filter on ``kept`` would be moved below the arrays, and each element would build them
        # anew. No filter moves below a column that differs by partition.
        F.monotonically_increasing_id().alias("here"),
    )
    failed = (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.repeat_share * F.col("n_words"))
    values = values.withColumn("base_failed", failed)
    enough = 100 * F.col("left") >= rules.kept_share * F.col("word_chars")
    values = values.withColumn("kept", ~F.col("base_failed") & enough & (F.col("here") >= 0))
    return values.select("row.*", *[F.col(name).alias(prefix + name) for name in own]).drop(
        "`quality.`")


def keep_quality(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """The documents that pass, without their failed lines, in the columns of ``docs``.

    ``n_chars``, if there is such a column, follows the new text.
    """
    judged = line_quality(docs, rules=rules, prefix="quality.")
    def column(name: str) -> Column:
        if name == "text":
            return F.col("`quality.cleaned`").alias(name)
        if name == "n_chars":
            return F.length("`quality.cleaned`").cast(docs.schema[name].dataType).alias(name)
        return F.col(f"`{name}`")
    return judged.where("`quality.kept`").select(*[column(c) for c in docs.columns])
