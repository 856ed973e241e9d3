"""Quality rules as a ledger of bits: every rule is evaluated once, policies only read the bits.

A row of the ledger holds the measurements of a text and a number whose bit ``r`` is set if rule
``r`` failed. A policy is a named, versioned set of rules; a document is kept if none of its bits is
in the policy. What a policy would keep without one of its rules follows from the counts of the
distinct bit patterns, without the texts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

#: Rules in the order of their bits: the name and the condition under which a text fails.
RULES = {
    "few_words": "n_words < 10",
    "repeated_words": "100 * n_repeat_words > 20 * n_words",
    "symbols": "100 * n_symbols > 30 * n_words",
    "repeated_lines": "100 * n_dup_lines > 50 * n_lines",
    "shouting": "100 * n_upper > 60 * n_letters",
    "word_length": "word_chars < 2 * n_words OR word_chars > 20 * n_words",
    "stuttering": "100 * n_stutter > 30 * n_words",
}
#: The two rules that are part of every version.
BASE = ("few_words", "repeated_words")
POLICIES = {
    "1": BASE,
    "2": (*BASE, "symbols", "repeated_lines"),
    "3": tuple(RULES),
}
LATEST = "3"


def bits(rules) -> int:
    names = list(RULES)
    return sum(1 << names.index(r) for r in rules)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _covered(places: Column) -> Column:
    """Words under windows that start at the sorted ``places``."""
    ends = F.zip_with(
        F.slice(places, 2, F.greatest(F.size(places) - 1, F.lit(0))),
        places,
        lambda later, place: F.least(F.lit(WINDOW), F.coalesce(later - place, F.lit(WINDOW))),
    )
    return F.aggregate(ends, F.lit(0), lambda total, step: total + step)


def _repeated(words: Column) -> Column:
    """Words in windows that a text holds at least twice; windows are compared by a 64-bit hash."""

    def places(hashes: Column) -> Column:
        marked = F.array_sort(
            F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.cast("int").alias("i")))
        )

        def starts(pairs: Column) -> Column:
            last = F.size(pairs) - 1
            same = F.transform(
                pairs,
                lambda p, k: F.when(
                    ((k > 0) & (F.get(pairs, k - 1)["h"] == p["h"]))
                    | ((k < last) & (F.get(pairs, k + 1)["h"] == p["h"])),
                    p["i"],
                ),
            )
            return F.sort_array(F.filter(same, lambda i: i.isNotNull()))

        return _let(_let(marked, starts), _covered)

    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]),
    )
    found = _let(
        windows,
        lambda hashes: F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), places(hashes)).otherwise(0),
    )
    return F.when(F.size(words) >= WINDOW, found).otherwise(0)


def _measured(text: Column) -> Column:
    words = F.filter(
        F.split(F.translate(text, BLANKS, " " * len(BLANKS)), " ", -1), lambda w: w != ""
    )
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(BLANKS)) != "")

    def word_measures(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            _repeated(w).cast("long").alias("n_repeat_words"),
            F.size(
                F.filter(
                    F.zip_with(w, F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))), lambda a, b: a == b),
                    lambda same: same,
                )
            )
            .cast("long")
            .alias("n_stutter"),
        )

    def line_measures(x: Column) -> Column:
        return F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        )

    return F.struct(
        _let(words, word_measures).alias("w"),
        _let(lines, line_measures).alias("l"),
        F.char_length(_without(text, BLANKS)).cast("long").alias("word_chars"),
        (F.char_length(text) - F.char_length(_without(text, SYMBOLS))).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.regexp_count(text, F.lit(r"\p{L}")).cast("long").alias("n_letters"),
    )


MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_upper",
    "n_letters",
    "n_stutter",
)


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id``, the measurements and ``failed`` for every row.

    Words are what lies between ASCII white space. A null or empty text has no words and fails
    ``few_words`` only. Repeated rows repeat, a row without an id is measured like any other, and
    other columns are not read.
    """
    measured = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        _measured(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("m"),
    ).select("doc_id", "m.w.*", "m.l.*", "m.word_chars", "m.n_symbols", "m.n_upper", "m.n_letters")
    failed = [
        F.when(F.expr(condition), F.lit(1 << r)).otherwise(0) for r, condition in enumerate(RULES.values())
    ]
    return measured.select(
        "doc_id", *MEASURES, reduce(lambda a, b: a.bitwiseOR(b), failed).cast("long").alias("failed")
    )


def judged(book: DataFrame, policy: str = LATEST) -> DataFrame:
    """The ledger with ``base_failed`` and ``kept`` by a policy."""
    return book.withColumns(
        {
            "base_failed": F.col("failed").bitwiseAND(bits(BASE)) != 0,
            "kept": F.col("failed").bitwiseAND(bits(POLICIES[policy])) == 0,
        }
    )


def ablation(book: DataFrame, policy: str = LATEST) -> DataFrame:
    """``(policy, rule, failing, only, kept, kept_without)`` for every rule of a policy.

    ``only`` counts the documents that fail no other rule of the policy: leaving the rule out would
    keep them too. One grouping by bit pattern serves all rules; there are at most as many patterns
    as sets of rules.
    """
    rules = POLICIES[policy]
    patterns = book.groupBy(F.col("failed").bitwiseAND(bits(rules)).alias("pattern")).agg(
        F.count("*").alias("documents")
    )
    named = F.explode(
        F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(bits([r])).cast("long").alias("bit")) for r in rules])
    )
    weight = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("documents"))), F.lit(0))
    zero = patterns.select("pattern", "documents", named.alias("r")).select("pattern", "documents", "r.*")
    return zero.groupBy("rule").agg(
        F.lit(policy).alias("policy"),
        weight(F.col("pattern").bitwiseAND(F.col("bit")) != 0).alias("failing"),
        weight(F.col("pattern") == F.col("bit")).alias("only"),
        weight(F.col("pattern") == 0).alias("kept"),
        weight(F.col("pattern").bitwiseAND(F.bitwise_not("bit")) == 0).alias("kept_without"),
    )
