"""Quality rules: a threshold table compiled into one projection of column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space between words, and the characters counted as symbols.
SPACES = " \t\n\x0b\x0c\r"
WORD_BREAK = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"

#: Frequent function words of the languages handled.
STOP_WORDS = (
    "the", "be", "to", "of", "and", "that", "have", "with", "a", "in", "is", "it", "for", "on", "was", "as",
    "der", "die", "und", "das", "den", "von", "zu", "mit", "ist", "ein", "des", "auf", "sich", "im",
    "le", "la", "les", "de", "et", "des", "un", "une", "est", "que", "du", "au", "dans", "pour",
    "el", "los", "las", "y", "en", "del", "se", "por", "con", "su", "una", "no", "es",
)

#: Languages those words are of.
LISTED_LANGUAGES = ("en", "de", "fr", "es")


@dataclass(frozen=True)
class Threshold:
    """A text is rejected if 100 * part / whole of two measures leaves the range
    (percent, both ends allowed). ``whole`` None compares the measure itself.
    A zero whole never rejects. ``languages`` are those the rule holds for (empty: all,
    unknown ones too)."""

    name: str
    part: str
    whole: str | None = None
    least: int | None = None
    most: int | None = None
    languages: tuple[str, ...] = ()


#: Base rule of the contract, kept apart so that its outcome shows alone.
BASE = (
    Threshold("words", "n_words", least=50),
    Threshold("repeats", "n_repeat_words", "n_words", most=50),
)

#: The method's own rules.
RULES = (
    Threshold("word_length", "word_chars", "n_words", least=200, most=1800),
    Threshold("symbols", "n_symbols", "n_words", most=10),
    Threshold("duplicate_lines", "n_dup_lines", "n_lines", most=50),
    Threshold("stop_words", "n_stop_words", "n_words", least=2, languages=LISTED_LANGUAGES),
    Threshold("shouted_words", "n_shouted", "n_words", most=40),
    Threshold("exclamations", "n_exclamations", "n_words", most=30),
)


def with_measures(df: DataFrame, text: str = "text") -> DataFrame:
    """Add one struct column ``_m`` of all measures; null texts count as empty.

    Words and lines are made once per row and dropped again; every measure is an
    expression over them.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    split = df.withColumns({
        "_words": F.filter(F.split(whole, WORD_BREAK), lambda w: w != ""),
        "_lines": F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
    })
    words, lines = F.col("_words"), F.col("_lines")
    found = {
        "n_words": F.size(words),
        "word_chars": F.length(F.array_join(words, "")),
        "n_symbols": F.regexp_count(whole, F.lit("[" + SYMBOLS + "]")),
        "n_lines": F.size(lines),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": repeated_words(words),
        "n_stop_words": F.size(F.filter(words, lambda w: F.lower(w).isin(*dict.fromkeys(STOP_WORDS)))),
        "n_shouted": F.regexp_count(whole, F.lit(r"\b\p{Lu}{2,}\b")),
        "n_exclamations": F.regexp_count(whole, F.lit("!")),
    }
    return split.withColumn(
        "_m", F.struct(*[c.cast("long").alias(n) for n, c in found.items()])
    ).drop("_words", "_lines")


def repeated_words(words: Column) -> Column:
    """Words inside a three-word window that comes at least twice in the text.

    The hashes of all windows are sorted with their positions, those equal to a
    neighbour are marked, and the words under marked windows are counted in
    order of position: n log n, whatever the length of the text.
    """
    windows = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(words) - 3, F.lit(0))),
        lambda i: F.struct(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")),
    )
    # one-element arrays bind a value that the lambda uses several times
    marked = F.transform(F.array(F.sort_array(windows)), lambda s: F.transform(s, lambda x, k: F.when(
        (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]), x["i"],
    )))[0]
    covered = F.aggregate(
        F.sort_array(F.array_compact(marked)),
        F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
        lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n")),
        lambda acc: acc["n"],
    )
    return F.when(F.size(words) < 4, F.lit(0)).otherwise(covered)


def violated(rule: Threshold, of: str = "_m", lang: str | None = "lang") -> Column:
    """Whether a row breaks the rule; whole numbers only, so engines agree."""
    part = F.col(f"{of}.{rule.part}")
    if rule.whole is None:
        low, high = part, part
        least, most = rule.least, rule.most
    else:
        whole = F.col(f"{of}.{rule.whole}")
        low = high = F.when(whole > 0, 100 * part)
        least = None if rule.least is None else rule.least * whole
        most = None if rule.most is None else rule.most * whole
    tests = []
    if rule.least is not None:
        tests.append(low < least)
    if rule.most is not None:
        tests.append(high > most)
    broken = tests[0] if len(tests) == 1 else tests[0] | tests[1]
    if rule.languages:
        broken = broken & (F.col(lang).isin(*rule.languages) if lang else F.lit(False))
    return F.coalesce(broken, F.lit(False))


def judge(df: DataFrame, text: str = "text", base: Sequence[Threshold] = BASE, rules: Sequence[Threshold] = RULES) -> DataFrame:
    """Add ``_m`` (the measures), ``_base_failed``, ``_broken`` (names of the broken
    rules) and ``_kept`` (no rule broken). Every column of ``df`` is passed on;
    a null or empty text fails the base rule on the number of words. Rules of some languages only
    read the column ``lang``; rows without one, or with another language, cannot break them."""
    lang = "lang" if "lang" in df.columns else None
    names = F.array_compact(F.array(*[F.when(violated(r, lang=lang), F.lit(r.name)) for r in (*base, *rules)]))
    failed = violated(base[0], lang=lang)
    for rule in base[1:]:
        failed = failed | violated(rule, lang=lang)
    return with_measures(df, text).withColumns({"_base_failed": failed, "_broken": names}).withColumn(
        "_kept", F.size("_broken") == 0
    )


def _language(docs: DataFrame) -> list[Column]:
    return [F.col("lang").cast("string").alias("lang")] if "lang" in docs.columns else []


def quality_table(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the key, the base measures, ``base_failed``, ``kept`` and the names of the broken rules.

    Repeated rows stay, null keys too; besides these, only ``lang`` is read, if it is there. Store the table
    before filtering it: Spark moves a filter below the measures, where each use of a
    word list builds it anew. :func:`keep_good` filters without that.
    """
    m = judge(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), *_language(docs)))
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return m.select(
        "doc_id", *[F.col(f"_m.{c}").alias(c) for c in base], F.col("_base_failed").alias("base_failed"),
        F.col("_kept").alias("kept"), F.array_join("_broken", ",").alias("broken_rules"),
    )


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows that break no rule, with the columns they came with, whatever their names."""
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text).alias("text"), *_language(docs))
    # a filter is moved below projections, where every use of a word list would build it
    # anew; the random column keeps it above, and is never below zero
    return judge(held).withColumn("_above", F.rand(0)).filter(F.col("_kept") & (F.col("_above") >= 0)).select("row.*")
