"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

A text's measures are columns; a rule bounds one measure, and a row is kept if no rule fails. Nulls count as
empty texts. Everything is computed within the row: no shuffle, no user function.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 5
#: White space between words, and the counted symbols. Fixed values.
WORD_GAP = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Common words of English, French, German and Spanish. Fixed values.
STOP_WORDS = (
    "the", "be", "to", "of", "and", "that", "have", "with", "a", "in", "is", "it", "for", "on", "was", "as", "are", "by", "this",
    "le", "la", "les", "de", "des", "du", "un", "une", "et", "en", "que", "qui", "dans", "pour", "par", "sur", "au", "elle",
    "der", "die", "das", "und", "von", "den", "dem", "ist", "mit", "sich", "eine", "ein", "zu", "als", "er",
    "el", "los", "las", "y", "se", "con", "su", "para", "al", "no", "es", "del",
)


#: The languages of the list, as the language column names them. Fixed values.
STOP_LANGUAGES = ("en", "fr", "de", "es")


class Rule(NamedTuple):
    """``measure`` must lie in ``least`` .. ``most`` for texts of at least ``from_words`` words, of ``langs`` if there are any."""

    name: str
    measure: str
    least: float | None = None
    most: float | None = None
    from_words: int = 0
    langs: tuple[str, ...] = ()


#: The threshold table. ``base`` rules are the fixed floor, the others are this library's verdict.
BASE_RULES = (
    Rule("words", "n_words", least=10),
    Rule("repeated_words", "repeat_share", most=0.2),
)
RULES = (
    Rule("mean_word_length", "mean_word", least=2.0, most=14.0),
    Rule("symbols_per_word", "symbols_per_word", most=0.3),
    Rule("stop_words", "stop_share", least=0.02, from_words=50, langs=STOP_LANGUAGES),
    Rule("repeated_lines", "dup_line_share", most=0.5),
    Rule("shouted_words", "shout_share", most=0.3),
)


def _let(value: Column, use) -> Column:
    """Bind ``value`` to a name, so that it is computed once per row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the measures of ``text`` added in a struct ``_m``.

    ``n_words``, ``word_chars``, ``n_symbols``, ``n_lines`` (lines with a word), ``n_dup_lines``, ``n_repeat_words``
    (long), and the shares derived from them. Windows of words are compared by 64-bit hashes of their words.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    bare = F.btrim(whole, F.lit(BLANKS))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, WORD_GAP))
    lines = F.filter(F.split(whole, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")

    def window(h: Column, i: Column) -> Column:
        return F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)])

    def windows(h: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(h) - WINDOW)
        return F.when(F.size(h) >= WINDOW, F.transform(at, lambda i: window(h, i)))

    def by_hash(h: Column) -> Column:
        # Only texts with a repeated window need their windows in order.
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        return F.when(F.size(F.array_distinct(h)) < F.size(h), ordered)

    def repeated_starts(s: Column) -> Column:
        twin = lambda i, j: F.get(s, i)["h"] == F.get(s, j)["h"]
        same = F.filter(s, lambda x, i: F.coalesce(twin(i, i - 1), F.lit(False)) | F.coalesce(twin(i, i + 1), F.lit(False)))
        return F.sort_array(F.transform(same, lambda x: x["p"]))

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW))))
        return F.coalesce(F.aggregate(steps, F.lit(0).cast("bigint"), lambda a, x: a + x), F.lit(0).cast("bigint"))

    split = docs.withColumn("_words", words).withColumn("_lines", lines)
    hashed = split.withColumn("_windows", _let(F.transform("_words", lambda w: F.xxhash64(w)), windows))
    ordered = hashed.withColumn("_sorted", _let(F.col("_windows"), by_hash))
    starts = ordered.withColumn("_starts", _let(F.col("_sorted"), repeated_starts))
    n = F.size("_words").cast("bigint")
    letters = F.length(F.array_join("_words", "")).cast("bigint")
    common = F.size(F.filter("_words", lambda w: w.isin(*STOP_WORDS, *[x.capitalize() for x in STOP_WORDS]))).cast("bigint")
    loud = F.size(F.filter("_words", lambda w: (w == F.upper(w)) & (w != F.lower(w)) & (F.length(w) > 1))).cast("bigint")
    counted = starts.withColumn("_c", F.struct(
        n.alias("n_words"), letters.alias("word_chars"),
        (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        _let(F.col("_starts"), covered).alias("n_repeat_words"),
        common.alias("n_stop"), loud.alias("n_loud")))
    c = {f: F.col(f"_c.{f}") for f in ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_stop", "n_loud")}

    def share(top: str, bottom: str) -> Column:
        return F.when(c[bottom] > 0, c[top] / c[bottom]).otherwise(F.lit(0.0))

    return counted.withColumn("_m", F.struct(
        *[c[f].alias(f) for f in ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")],
        share("word_chars", "n_words").alias("mean_word"), share("n_symbols", "n_words").alias("symbols_per_word"),
        share("n_repeat_words", "n_words").alias("repeat_share"), share("n_dup_lines", "n_lines").alias("dup_line_share"),
        share("n_stop", "n_words").alias("stop_share"), share("n_loud", "n_words").alias("shout_share"),
    )).drop("_words", "_lines", "_windows", "_sorted", "_starts", "_c")


def compiled(rules: Sequence[Rule], lang: Column | None = None) -> Column:
    """The names of the rules that a row of measures breaks, as an array. Rules of some languages hold where ``lang`` says so."""
    broken = []
    lang = F.lit(None).cast("string") if lang is None else lang
    for rule in rules:
        value = F.col(f"_m.{rule.measure}")
        bad = F.lit(False)
        if rule.least is not None:
            bad = bad | (value < rule.least)
        if rule.most is not None:
            bad = bad | (value > rule.most)
        if rule.langs:
            bad = bad & F.coalesce(lang.isin(*rule.langs), F.lit(False))
        broken.append(F.when(bad & (F.col("_m.n_words") >= rule.from_words), F.lit(rule.name)))
    return F.array_compact(F.array(*broken))


VERDICT = ("_m", "_base", "_broken")


def judged(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, lang: str = "lang") -> DataFrame:
    """``docs`` with ``_m`` (measures), ``_base`` and ``_broken`` (names of base rules and other rules that failed).

    A null text counts as empty and fails the base rules. Repeated rows are judged each on its own. Without a column ``lang``, and for
    rows whose language is null or not one of a rule's, that rule does not hold. Columns of ``docs`` with one of the three names give way.
    """
    known = F.col(f"`{lang}`").cast("string") if lang in docs.columns else F.lit(None).cast("string")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    held = docs.select(row.alias("_row"), F.col(f"`{text}`").alias("_text"), known.alias("_lang"))
    found = measures(held, "_text").withColumn("_base", compiled(BASE_RULES)).withColumn("_broken", compiled(rules, F.col("_lang")))
    return found.select(*[F.col(f"_row.`{c}`") for c in docs.columns if c not in VERDICT], *VERDICT)


def kept(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` that break no rule, with the columns of ``docs``, whatever their names."""
    known = F.col(f"`{lang}`").cast("string") if lang in docs.columns else F.lit(None).cast("string")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    held = docs.select(row.alias("_kept"), F.col(f"`{text}`").alias("_text"), known.alias("_lang"))
    passed = F.when((F.size("_base") == 0) & (F.size("_broken") == 0), F.array("_kept"))
    # A plain filter would be pushed below the projections and compute every measure again for each of its uses.
    return judged(held, "_text", rules, "_lang").select(F.explode_outer(passed).alias("_kept")).where("_kept IS NOT NULL").select("_kept.*")
