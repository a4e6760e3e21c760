"""Operator 7, quality rules [native]: a ledger of measurements and failure bits, policies, ablations."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE_CLASS = "[ \\t-\\r]"
NO_SPACE_CLASS = "[^ \\t-\\r]"


def let(value: Column, body) -> Column:
    """`body` of a value that is worked out once per row (an expression named twice may be worked out twice)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+` in order."""
    return F.array_remove(F.split(text, SPACE_CLASS + "+"), "")


def repeated_words(words: Column, size: int = 5) -> Column:
    """How many words lie in windows of `size` words that the text holds twice or more.

    Windows are compared by 64-bit hashes: sorted with their places, a window repeats if it equals a neighbour; each
    repeated place then covers the words up to the next one, at most `size`.
    """

    def covered(places: Column) -> Column:
        gaps = F.transform(places, lambda p, i: F.least(F.coalesce(F.get(places, i + 1) - p, F.lit(size)), F.lit(size)))
        return F.aggregate(gaps, F.lit(0).cast("bigint"), lambda total, gap: total + gap)

    def repeats(windows: Column) -> Column:
        def among(ordered: Column) -> Column:
            near = lambda w, i: F.coalesce(w["h"] == F.get(ordered, i)["h"], F.lit(False))
            same = F.filter(ordered, lambda w, i: near(w, i - 1) | near(w, i + 1))
            return let(F.sort_array(F.transform(same, lambda w: w["i"])), covered)

        placed = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("bigint")).otherwise(let(F.sort_array(placed), among))

    starts = F.sequence(F.lit(0), F.size(words) - size)
    hashed = F.transform(starts, lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(size))))
    return F.when(F.size(words) < size, F.lit(0).cast("bigint")).otherwise(let(hashed, repeats))


def measure(text: Column) -> Column:
    """All measurements of a text as one struct; null counts as empty.

    n_words; word_chars, code points in words; n_symbols; n_lines, lines with a word; n_dup_lines, those equal to an
    earlier one; n_repeat_words.
    """
    text = F.coalesce(text, F.lit(""))
    bigint = lambda c: c.cast("bigint")

    def of_words(words: Column) -> Column:
        return F.struct(
            bigint(F.size(words)).alias("n_words"),
            bigint(F.length(F.array_join(words, ""))).alias("word_chars"),
            repeated_words(words).alias("n_repeat_words"),
        )

    def of_lines(lines: Column) -> Column:
        return F.struct(bigint(F.size(lines)).alias("n_lines"), bigint(F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines"))

    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(NO_SPACE_CLASS))
    symbols = bigint(F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")))
    return F.struct(let(words_of(text), of_words).alias("w"), let(lines, of_lines).alias("l"), symbols.alias("n_symbols"))


class Rule(NamedTuple):
    """A named rule over the measurements; `fails` is SQL in integers, so that every engine agrees."""

    name: str
    fails: str


#: Measurements, and where `measure` puts them.
MEASURES = {
    "n_words": "w.n_words", "word_chars": "w.word_chars", "n_symbols": "n_symbols", "n_lines": "l.n_lines", "n_dup_lines": "l.n_dup_lines",
    "n_repeat_words": "w.n_repeat_words",
}

#: The ledger's rules; a rule's bit is its place here. Rules are only ever added at the end.
RULES = (
    Rule("few_words", "n_words < 10"),
    Rule("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    Rule("many_symbols", "10 * n_symbols > n_words"),
    Rule("duplicate_lines", "n_dup_lines >= 2 and 10 * n_dup_lines > 3 * n_lines"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 30 * n_words"),
    Rule("some_symbols", "20 * n_symbols > n_words"),
)
BASE = ("few_words", "repeated_words")

#: Versioned policies: a document is rejected if it fails any of these rules.
POLICIES = {
    "base": BASE,
    "v1": (*BASE, "many_symbols", "duplicate_lines", "short_words", "long_words"),
    "strict": (*BASE, "some_symbols", "duplicate_lines", "short_words", "long_words"),
}
PRODUCTION = "v1"


def bits(names: tuple[str, ...]) -> int:
    places = {rule.name: i for i, rule in enumerate(RULES)}
    return sum(1 << places[name] for name in names)


def rule_ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, measurements and `failed`, the bits of the rules a text fails: each rule is evaluated once, for all policies.

    Native: one projection, no shuffle, no Python. Null and empty texts have no words and fail `few_words`. Null ids
    stay null; repeated rows have a row each; other columns are ignored. A text's words are held in memory once.
    """
    rows = docs.select(docs[id_col].alias("__id"), docs[text_col].alias("__text"))
    return _with_ledger(rows, "__text").select(F.col("__id").alias(id_col), *MEASURES, "failed")


def _with_ledger(rows: DataFrame, text_col: str) -> DataFrame:
    """The rows with their measurements and `failed`; their own columns must have other names."""
    flat = rows.withColumn("__m", measure(F.col(text_col))).select(*rows.columns, *(F.col(f"__m.{place}").alias(name) for name, place in MEASURES.items()))
    failed = F.lit(0).cast("bigint")
    for i, rule in enumerate(RULES):
        failed = failed.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint"))
    return flat.withColumn("failed", failed)


def apply_policy(ledger: DataFrame, policy: str = PRODUCTION) -> DataFrame:
    """The ledger with base_failed and kept under a policy: two masks, no text is read again."""
    return ledger.withColumn("base_failed", F.col("failed").bitwiseAND(F.lit(bits(BASE))) != 0).withColumn(
        "kept", F.col("failed").bitwiseAND(F.lit(bits(POLICIES[policy]) | bits(BASE))) == 0
    )


def ablations(ledger: DataFrame, policy: str = PRODUCTION) -> DataFrame:
    """Per rule of the policy: documents that fail it, fail nothing else, and are kept without it. One pass over bits."""
    mask = bits(POLICIES[policy])
    failed = F.col("failed").bitwiseAND(F.lit(mask))
    counted = ledger.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(failed == 0).alias("kept"),
        *(F.count_if(failed.bitwiseAND(F.lit(bits((name,)))) != 0).alias(f"fail_{name}") for name in POLICIES[policy]),
        *(F.count_if(failed == F.lit(bits((name,)))).alias(f"only_{name}") for name in POLICIES[policy]),
    )
    rows = [
        F.struct(F.lit(name).alias("rule"), F.col("n").alias("n_docs"), F.col(f"fail_{name}").alias("n_failed"), F.col(f"only_{name}").alias("n_only"), (F.col("kept") + F.col(f"only_{name}")).alias("n_kept_without"))
        for name in POLICIES[policy]
    ]
    return counted.select(F.inline(F.array(*rows)))


def keep_passing(docs: DataFrame, policy: str = PRODUCTION, text_col: str = "text") -> DataFrame:
    """The documents that a policy keeps, with their columns, whatever the names of those."""
    names = [f"__{i}" for i in range(len(docs.columns))]
    judged = apply_policy(_with_ledger(docs.toDF(*names), names[docs.columns.index(text_col)]), policy)
    return judged.filter("kept").select(*(F.col(n).alias(c) for n, c in zip(names, docs.columns)))
