r"""Quality rules as a bitmask ledger, in DataFrame functions only.

Every rule is evaluated once per text: the ledger keeps the measurements and one bit per
failed rule.  A policy is a version and the set of rules it enforces, so its verdict is one
AND on the stored bits, and a policy changes without reading texts again.  Ablations (what each
rule rejects, and rejects alone) come from counting distinct bit patterns, of which there are
at most 2**rules.

Words are `[^\x20\x09-\x0D]+`.  All work on a text is linear or a sort; texts whose
five-word windows are all different skip the sort.

Defined cases: null text has no words; empty texts and texts under five words have no windows;
repeated rows are judged alike, each on its own; empty tables give empty results; other
columns are ignored.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 5
SPACE = "[\\x20\\x09-\\x0D]"

# Rule (its position is its bit): fails where the condition on the measurements holds.
RULES: dict[str, Callable[[], Column]] = {
    "few_words": lambda: F.col("n_words") < 10,
    "repeated_windows": lambda: 100 * F.col("n_repeat_words") > 20 * F.col("n_words"),
    "symbols": lambda: 100 * F.col("n_symbols") > 4 * F.col("word_chars"),
    "repeated_lines": lambda: 2 * F.col("n_dup_lines") > F.col("n_lines"),
    "shouting": lambda: 100 * F.col("n_upper") > 30 * F.col("word_chars"),
    "exclamations": lambda: 100 * F.col("n_exclaims") > 20 * F.col("n_words"),
    "long_words": lambda: F.col("word_chars") > 30 * F.col("n_words"),
    "short_words": lambda: F.col("word_chars") < 2 * F.col("n_words"),
}

# Versioned policies: the rules they enforce.
POLICIES: dict[str, tuple[str, ...]] = {
    "base-1": ("few_words", "repeated_windows"),
    "strict-1": tuple(RULES),
}
POLICY = "strict-1"


def mask(policy: str) -> int:
    names = list(RULES)
    return sum(1 << names.index(rule) for rule in POLICIES[policy])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def _windows(words: Column) -> Column:
    """One 64-bit hash per run of WINDOW words, from one hash per word."""

    def of(h: Column) -> Column:
        slots = F.sequence(F.lit(1), F.size(h) - (WINDOW - 1))
        return F.when(
            F.size(h) >= WINDOW,
            F.transform(slots, lambda i: F.xxhash64(*[F.get(h, i - 1 + k) for k in range(WINDOW)])),
        ).otherwise(F.array().cast("array<bigint>"))

    return let(F.transform(words, lambda w: F.xxhash64(w)), of)


def _repeat_words(windows: Column) -> Column:
    """Words covered by windows that occur twice or more."""

    def covered(starts: Column) -> Column:
        # Ascending window starts: each adds the words that the one before did not reach.
        gaps = F.transform(
            starts,
            lambda p, i: F.when(i == 0, WINDOW).otherwise(F.least(F.lit(WINDOW), p - F.get(starts, i - 1))),
        )
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda total, gap: total + gap)

    def repeated(pairs: Column) -> Column:
        twice = F.filter(
            pairs,
            lambda e, i: ((i > 0) & (F.get(pairs, i - 1)["h"] == e["h"]))
            | F.coalesce(F.get(pairs, i + 1)["h"] == e["h"], F.lit(False)),
        )
        return let(F.array_sort(F.transform(twice, lambda e: e["p"])), covered)

    pairs = F.sort_array(
        F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("p")))
    )
    return F.when(
        F.size(F.array_distinct(windows)) < F.size(windows), let(pairs, repeated)
    ).otherwise(F.lit(0).cast("long"))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of `docs`, all measurements that the rules use."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    words = F.filter(F.split("text", f"{SPACE}+"), lambda w: w != "")
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))

    def count(pattern: str) -> Column:
        return F.length(F.regexp_replace("text", pattern, "")).cast("long")

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n"), let(_windows(w), _repeat_words).alias("repeated")
        )

    def of_lines(found: Column) -> Column:
        return F.struct(
            F.size(found).cast("long").alias("n"),
            (F.size(found) - F.size(F.array_distinct(found))).cast("long").alias("dup"),
        )

    return (
        docs.select(docs[id_col].cast("long").alias("doc_id"), text.alias("text"))
        .select(
            "doc_id",
            let(words, of_words).alias("w"),
            let(lines, of_lines).alias("l"),
            count(f"{SPACE}+").alias("word_chars"),
            count("[^#*$%&|<>]+").alias("n_symbols"),
            count("[^A-Z\\u00C0-\\u00D6\\u00D8-\\u00DE]+").alias("n_upper"),
            count("[^!]+").alias("n_exclaims"),
        )
        .select(
            "doc_id",
            F.col("w.n").alias("n_words"),
            "word_chars",
            "n_symbols",
            F.col("l.n").alias("n_lines"),
            F.col("l.dup").alias("n_dup_lines"),
            F.col("w.repeated").alias("n_repeat_words"),
            "n_upper",
            "n_exclaims",
        )
    )


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The measurements and `failures`, a bit per failed rule in the order of RULES."""
    bits = F.lit(0).cast("long")
    for position, failed in enumerate(RULES.values()):
        bits = bits.bitwiseOR(F.when(failed(), F.lit(1 << position)).otherwise(0).cast("long"))
    return measure(docs, id_col, text_col).withColumn("failures", bits)


def apply_policy(rows: DataFrame, policy: str = POLICY) -> DataFrame:
    """Adds `policy` and `kept`: no rule of the policy failed."""
    return rows.withColumns(
        {"policy": F.lit(policy), "kept": F.col("failures").bitwiseAND(F.lit(mask(policy)).cast("long")) == 0}
    )


def ablation(rows: DataFrame, policy: str = POLICY) -> DataFrame:
    """Per rule of a policy: texts that fail it, fail it alone, and are kept without it."""
    enforced = F.lit(mask(policy)).cast("long")
    patterns = rows.groupBy(F.col("failures").bitwiseAND(enforced).alias("bits")).agg(F.count("*").alias("n"))
    names = list(RULES)
    rules = F.array(
        *[F.struct(F.lit(r).alias("rule"), F.lit(1 << names.index(r)).cast("long").alias("bit")) for r in POLICIES[policy]]
    )
    each = patterns.select("bits", "n", F.inline(rules))
    hit = F.col("bits").bitwiseAND(F.col("bit")) != 0
    alone = F.col("bits") == F.col("bit")
    return each.groupBy("rule").agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("failed"),
        F.sum(F.when(alone, F.col("n")).otherwise(0)).alias("failed_alone"),
        F.sum(F.when(alone | (F.col("bits") == 0), F.col("n")).otherwise(0)).alias("kept_without"),
    )
