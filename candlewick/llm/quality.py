"""Quality rules: a bitmask ledger, in DataFrame functions only.

``ledger`` evaluates every rule once per document and stores the measurements
and one bit per failed rule. A policy is a versioned set of rules, so deciding
under it, or under a new version of it, is one bitwise test on the ledger, and
``ablations`` tells from the bits alone what each rule drops by itself.

No step shuffles documents: all measurements are expressions over the row, and
repeated windows are found by sorting a document's own window hashes.

Defined results: null text has no words and no lines with a word; a document
without words fails ``few_words``; null ``doc_id`` stays null; repeated rows are
judged each; an empty table gives no rows; ``kept_documents`` returns the input's
columns as they are, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the measurements: white space, and the symbols counted.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals")

#: Rule -> SQL condition under which a document fails it. A rule's place is its bit: append, never reorder.
RULES = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbols": "100 * n_symbols > 10 * n_words",
    "duplicate_lines": "100 * n_dup_lines > 50 * n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 14 * n_words",
    "capitals": "100 * n_capitals > 30 * word_chars",
}
#: Policy version -> rules that a kept document must pass.
POLICIES = {
    1: ("few_words", "repeated_windows"),
    2: tuple(RULES),
}
BASE, CURRENT = 1, 2


def bits(rules) -> int:
    """Bitmask of the named rules."""
    names = list(RULES)
    return sum(1 << names.index(r) for r in rules)


def _measured(rows: DataFrame) -> DataFrame:
    """``rows`` (columns row, doc_id, text) with the measurements."""
    words = (rows.withColumn("trimmed", F.trim(F.col("text"), F.lit(SPACES)))
             .withColumn("words", F.expr(rf"if(trimmed = '', array(), split(trimmed, r'{SPACE_RUN}'))"))
             .withColumn("lines", F.expr(rf"filter(split(text, '\n'), l -> l rlike r'{NOT_SPACE}')"))
             .withColumn("n", F.size("words")))
    windows = words.withColumn("windows", F.expr(
        "if(n < 3, array(), transform(sequence(0, n - 3), i -> xxhash64(words[i], words[i + 1], words[i + 2])))"))
    # positions of windows found twice or more: equal neighbours once hashes are sorted with their positions
    ranked = windows.withColumn("ranked", F.expr(
        "if(size(array_distinct(windows)) = size(windows), array(),"
        " sort_array(transform(windows, (h, i) -> struct(h, i))))"))
    again = ranked.withColumn("again", F.expr(
        "filter(ranked, (x, j) -> x.h = get(ranked, j - 1).h or x.h = get(ranked, j + 1).h)"))
    return again.select(
        "row", "doc_id",
        F.col("n").cast("long").alias("n_words"),
        F.char_length(F.regexp_replace("trimmed", F.lit(SPACE_RUN), F.lit(""))).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr("size(array_distinct(flatten(transform(again, x -> array(x.i, x.i + 1, x.i + 2)))))")
        .cast("long").alias("n_repeat_words"),
        F.regexp_count("text", F.lit("[A-Z]")).cast("long").alias("n_capitals"))


def _ledger(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    failed = [F.when(F.expr(test), F.lit(1 << i)).otherwise(F.lit(0)) for i, test in enumerate(RULES.values())]
    return _measured(rows).withColumn("fail_bits", reduce(Column.__add__, failed).cast("long"))


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the measurements (long) and ``fail_bits`` (bit i set: rule i failed) of every document."""
    return _ledger(docs, id_col, text_col).drop("row")


def fails(version: int) -> Column:
    """True if a ledger row fails a rule of the policy version."""
    return F.col("fail_bits").bitwiseAND(F.lit(bits(POLICIES[version]))) != 0


def ablations(rows: DataFrame, version: int = CURRENT) -> DataFrame:
    """One row per rule of the policy: rule, failed, failed_alone (documents the policy would
    keep without this rule), kept (by the whole policy), documents."""
    mask = bits(POLICIES[version])
    combos = rows.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask)).alias("b")).agg(F.count("*").alias("c"))
    names = list(RULES)
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << names.index(r)).cast("long").alias("bit"))
                                for r in POLICIES[version]])).alias("r")
    c = F.col("c")

    def total(test):
        return F.sum(F.when(test, c).otherwise(0))

    return (combos.select("b", "c", rules).groupBy("r.rule")
            .agg(total(F.col("b").bitwiseAND(F.col("r.bit")) != 0).alias("failed"),
                 total(F.col("b") == F.col("r.bit")).alias("failed_alone"),
                 total(F.col("b") == 0).alias("kept"), F.sum("c").alias("documents")))


def kept_documents(docs: DataFrame, version: int = CURRENT, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """The documents that pass the policy, with the input's columns.

    Not a ``where``: the optimizer would move its condition below the ledger and repeat every
    measurement inside it. A generator of no or one row stays above the ledger.
    """
    kept = F.when(fails(version), F.array().cast(T.ArrayType(docs.schema))).otherwise(F.array("row"))
    return _ledger(docs, id_col, text_col).select(F.explode(kept).alias("row")).select("row.*")
