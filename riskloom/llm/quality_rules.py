"""Quality rules as a ledger: measure once, keep failure bits, apply policies later.

``ledger`` evaluates every rule on every text in one pass without a shuffle: it stores
the measurements and one long whose bit ``k`` is set where rule ``k`` fails. A policy is
a named, versioned set of rules; applying one is a bitwise AND, so old ledgers can be
judged anew without reading a text. Ablations fold the ledger to its distinct bit masks
(at most 2^rules) and compare those with the policies bit by bit.

A NULL or empty text has no words: it fails ``few_words`` and nothing else. Columns of
the input named like a result column are replaced, all others stay (``passing`` gives all
columns back as they were). Repeated rows are judged alike. A very long text is measured as
a whole, in the memory of a few copies of it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import fresh, keep_where, let, words

MEASURES = [
    "n_words",
    "word_chars",
    "n_symbols",
    "n_lines",
    "n_dup_lines",
    "n_repeat_words",
    "n_upper",
]
SYMBOLS = r"[#*$%&|<>]+"
NOT_BLANK = r"[^\x20\x09-\x0D]"


@dataclass(frozen=True)
class Rule:
    name: str
    fails: str  # SQL over the measurements


# the place of a rule is its bit: only ever append
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "10 * n_symbols > word_chars"),
    Rule("repeated_lines", "2 * n_dup_lines > n_lines"),
    Rule("shouting", "10 * n_upper > 3 * word_chars"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 20 * n_words"),
)
POLICIES = {
    "base-1": ("few_words", "repeated_words"),
    "base-2": ("few_words", "repeated_words", "repeated_lines"),
    "text-1": tuple(r.name for r in RULES),
}
BASE, CURRENT = "base-1", "text-1"


def _repeated(hashes: Column) -> Column:
    """Words in 3-word windows that occur twice or more, from the windows' hashes."""

    def starts(ordered: Column) -> Column:
        twin = lambda w, k: (w["h"] == F.get(ordered, k - 1)["h"]) | (
            w["h"] == F.get(ordered, k + 1)["h"]
        )
        return F.transform(F.filter(ordered, twin), lambda w: w["at"])

    def covered(at: Column) -> Column:
        second, third = F.transform(at, lambda i: i + 1), F.transform(at, lambda i: i + 2)
        return F.size(F.array_union(F.array_union(at, second), third))

    placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at")))
    found = let(let(F.sort_array(placed), starts), covered)
    # most texts repeat no window: a hash set tells without sorting
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(found)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the measurements (long) of every text."""
    w, chars, lines, grams = fresh(docs, "_words", "_chars", "_lines", "_windows")
    split = docs.drop(*MEASURES).withColumn(w, words(F.col(text)))
    starts = F.slice(w, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0)))
    joined = split.withColumns(
        {
            chars: F.array_join(w, ""),
            lines: F.filter(
                F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda x: x.rlike(NOT_BLANK)
            ),
            grams: F.transform(
                starts, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))
            ),
        }
    )

    def lost(pattern: str) -> Column:
        return F.char_length(chars) - F.char_length(F.regexp_replace(chars, pattern, ""))

    found = {
        "n_words": F.size(w),
        "word_chars": F.char_length(chars),
        "n_symbols": lost(SYMBOLS),
        "n_lines": F.size(lines),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": _repeated(F.col(grams)),
        "n_upper": lost(r"\p{Lu}+"),
    }
    return joined.withColumns({k: v.cast("long") for k, v in found.items()}).drop(
        w, chars, lines, grams
    )


def mask(names: tuple[str, ...], rules: tuple[Rule, ...] = RULES) -> int:
    bits = {r.name: 1 << k for k, r in enumerate(rules)}
    return sum(bits[n] for n in names)


def ledger(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with its measurements and ``fail_bits``; every rule is evaluated once."""
    measured = measure(docs, text)
    bits = F.lit(0).cast("long")
    for k, rule in enumerate(rules):
        bits = bits + F.when(F.expr(rule.fails), 1 << k).otherwise(0).cast("long")
    return measured.withColumn("fail_bits", bits)


def failed(policy: str) -> Column:
    """Whether a ledger row fails any rule of a policy."""
    return F.col("fail_bits").bitwiseAND(F.lit(mask(POLICIES[policy])).cast("long")) != 0


def judge(rows: DataFrame) -> DataFrame:
    """Add ``base_failed`` and ``kept`` (by the current policy) to a ledger."""
    return rows.withColumns({"base_failed": failed(BASE), "kept": ~failed(CURRENT)})


def passing(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the current policy keeps, with all their own columns."""
    # the measures must not take the place of columns with their names
    packed = docs.select(F.struct("*").alias("_doc"), F.col(text).alias("text"))
    return keep_where(judge(ledger(packed)), F.col("kept")).select("_doc.*")


def ablation(
    rows: DataFrame, policies: dict[str, tuple[str, ...]] = POLICIES, rules=RULES
) -> DataFrame:
    """What each rule of each policy does: policy, rule, n_failed, n_only (rows that only
    this rule of the policy rejects, so that dropping the rule would keep them), n_kept
    (rows the whole policy keeps)."""
    # at most 2^rules rows, folded before the shuffle
    masks = rows.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("_n"))
    pairs = [
        F.struct(
            F.lit(p).alias("policy"),
            F.lit(n).alias("rule"),
            F.lit(mask(names, rules)).cast("long").alias("all"),
            F.lit(mask((n,), rules)).cast("long").alias("bit"),
        )
        for p, names in policies.items()
        for n in names
    ]
    each = masks.withColumn("_p", F.explode(F.array(*pairs)))
    seen = F.col("fail_bits").bitwiseAND(F.col("_p.all"))

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("_n")).otherwise(0))

    return each.groupBy("_p.policy", "_p.rule").agg(
        total(seen.bitwiseAND(F.col("_p.bit")) != 0).alias("n_failed"),
        total(seen == F.col("_p.bit")).alias("n_only"),
        total(seen == 0).alias("n_kept"),
    )


def failures(rows: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add ``failed_rules``, the names of the rules that a ledger row fails, in bit order."""
    names = [
        F.when(F.col("fail_bits").bitwiseAND(F.lit(1 << k).cast("long")) != 0, F.lit(r.name))
        for k, r in enumerate(rules)
    ]
    return rows.withColumn("failed_rules", F.array_compact(F.array(*names)))


