"""URL verdicts from fixed host rules and mined token rules.

Labelled pages become transactions: the tokens of a URL and, for bad pages, a label
token. Spark's FP-growth mines frequent combinations of all their tokens; those that lead
to the label with enough support and confidence, and that no shorter rule already implies,
are kept. Confidence is judged against the share of bad pages among all labelled ones: a
rule has to exceed it by the factor ``MIN_LIFT`` and by ``MIN_SIGMA`` standard deviations of
a draw of as many pages; an absolute bound may be given instead. Two reductions change no kept rule: tokens on too few bad pages for any rule are
left out, and tokens that always stand together are mined as one, as a rule with two of
them is implied by the one with either; afterwards each takes the other's place. A
page is matched through an inverted index: each rule hangs under its rarest token, and
only the rules under a page's own tokens are looked at. Fixed rules on host and path go
first; the longest that fits decides.

The number of mined rules is bounded by the supports, not by the pages; ``match_rules``
checks it before it broadcasts the index, and joins by token beyond ``BROADCAST_RULES``.

A label belongs to the page whose ``page_id`` is its ``doc_id``; pages without a label teach
nothing. The deviation bound holds for one rule: where many combinations are tried and
labels have nothing to do with URLs, about one in forty passes it by chance (raise
``min_sigma`` to be stricter).

NULL urls and urls without ``://`` have empty host and path and no tokens: they are
allowed. Very long urls are tokens like any other. Repeated pages are judged alike;
conflicting labels of an id count as bad. Without labels, or with bad ones only, no rule
exceeds the share of all pages and none is mined. Columns other than ``page_id`` and ``url``
are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import product

import pandas as pd
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import LOWER, UPPER, land, session

MIN_SUPPORT = 0.002  # of the labelled pages
MIN_ROWS = 20  # a rule rests on so many bad pages at least
MIN_LIFT = 1.25  # confidence over the share of bad pages
MIN_SIGMA = 2.0  # and by so many standard deviations of chance
BROADCAST_RULES = 20_000
BAD = "label:bad"


@dataclass(frozen=True)
class HostRule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


HOST_RULES = (
    HostRule("net", "/", "block"),
    HostRule("example.net", "/en/", "allow"),
    HostRule("example.com", "/de/", "block"),
    HostRule("org", "/fr/", "allow"),
)


def with_host_and_path(pages: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host`` (A-Z lower-cased) and ``path``; both empty without ``://``."""
    text = F.coalesce(F.col(url), F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.expr(f"substring(coalesce({url}, ''), instr({url}, '://') + 3)"))
    host = F.regexp_extract(F.coalesce(rest, F.lit("")), r"^([^/?#]*)", 1)
    path = F.regexp_extract(F.coalesce(rest, F.lit("")), r"^[^/?#]*([^?#]*)", 1)
    return pages.withColumns({"host": F.translate(host, UPPER, LOWER), "path": path})


def fixed_rule(rules: Sequence[HostRule] = HOST_RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits ``host`` and ``path``, or NULL."""
    text = verdict = F.lit(None).cast("string")
    host, path = F.col("host"), F.col("path")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        text = F.when(fits, rule.text).otherwise(text)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def url_tokens(url: str = "url") -> Column:
    """Distinct tokens: host labels, suffix, path words, file type, query keys, scheme.

    Runs of digits in a path are one token, so that page numbers do not matter. Host
    tokens come first.
    """
    u = F.coalesce(F.col(url), F.lit(""))
    labels = F.filter(F.split(F.col("host"), r"\."), lambda x: x != "")
    steps = F.filter(F.split(F.col("path"), "/"), lambda x: x != "")
    plain = F.transform(steps, lambda x: F.regexp_replace(F.lower(x), r"\d+", "#"))
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    keys = F.filter(F.split(query, "&"), lambda x: x != "")
    prefixed = lambda tag, a: F.transform(a, lambda x: F.concat(F.lit(tag), x))
    scheme = F.concat(F.lit("s:"), F.lower(F.substring_index(u, "://", 1)))
    schemes = F.when(F.instr(u, "://") > 0, F.array(scheme))
    return F.array_distinct(
        F.concat(
            prefixed("h:", labels),
            prefixed("p:", plain),
            prefixed("q:", F.transform(keys, lambda x: F.substring_index(x, "=", 1))),
            F.coalesce(schemes, F.array().cast("array<string>")),
        )
    )


def labelled(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``tokens`` and ``bad`` of the pages that have a label of quality 0 or toxic 1."""
    bad = (F.coalesce(F.col("quality"), F.lit(1)) == 0) | (F.coalesce(F.col("toxic"), F.lit(0)) == 1)
    each = (
        labels.filter("doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").alias("_id"))
        .agg(F.max(bad).alias("bad"))
    )
    tokens = with_host_and_path(pages.select("page_id", "url")).select(
        "page_id", url_tokens().alias("tokens")
    )
    return tokens.join(each, F.col("page_id") == F.col("_id")).select("tokens", "bad")


def token_classes(rows: DataFrame, least: int) -> dict[str, tuple[int, list[str]]]:
    """Tokens on at least ``least`` bad pages, with the number of all their pages, by the
    least of those on the same pages.

    Their number is bounded by ``least``, so that they may come to the driver.
    """
    sets = rows.groupBy("tokens").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("bad").alias("bad")
    )
    each = sets.select(
        F.explode("tokens").alias("token"),
        "n",
        "bad",
        F.xxhash64("tokens").alias("h1"),
        F.xxhash64("tokens", F.lit(1)).alias("h2"),
    )
    # 128 bits over the sets that hold a token tell which pages have it
    found = each.groupBy("token").agg(
        F.sum("n").alias("n"),
        F.sum("bad").alias("bad"),
        F.bit_xor("h1").alias("h1"),
        F.bit_xor("h2").alias("h2"),
    )
    classes: dict[tuple, list[str]] = {}
    for r in sorted(found.filter(F.col("bad") >= least).collect()):
        classes.setdefault((r["n"], r["bad"], r["h1"], r["h2"]), []).append(r["token"])
    return {members[0]: (pages[0], members) for pages, members in classes.items()}


def mine_rules(
    rows: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_confidence: float | None = None,
    min_rows: int = MIN_ROWS,
    min_lift: float = MIN_LIFT,
    min_sigma: float = MIN_SIGMA,
) -> DataFrame:
    """Rules ``tokens -> bad``: tokens (sorted), key (the rarest of them), confidence, support.

    ``rows`` has ``tokens`` and ``bad``. Runs FP-growth over all rows, in Spark. With
    ``min_confidence`` that is the bound; without, ``min_lift`` and ``min_sigma`` bound the
    confidence from below, against the share of bad rows.
    """
    spark = rows.sparkSession
    none = "tokens array<string>, key string, confidence double, support double"
    rows = land(rows.select("tokens", "bad"), "url-tokens")
    n, n_bad = rows.agg(F.count(F.lit(1)), F.count_if("bad")).first()
    share = n_bad / max(n, 1)
    least = min(share * min_lift, 1.0) if min_confidence is None else min_confidence
    support = max(min_support, min_rows / max(n, 1))
    if support > 1 or (min_confidence is None and share == 1.0):
        return spark.createDataFrame([], none)
    classes = token_classes(rows, math.ceil(support * n))
    first = {t: name for name, (_, members) in classes.items() for t in members}
    shared = spark.sparkContext.broadcast((first, classes))

    @F.pandas_udf("array<string>")
    def mined(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        first, _ = shared.value
        for tokens in batches:
            yield tokens.map(lambda a: list({first[t]: 0 for t in a if t in first}))

    @F.udf("array<struct<tokens: array<string>, key: string>>")
    def spelled(tokens):
        """The rules of a mined one, with any token of each class, and their rarest tokens."""
        first, classes = shared.value
        found = product(*[classes[t][1] for t in tokens])
        return [(sorted(c), min(c, key=lambda t: (classes[first[t]][0], t))) for c in found]

    items = mined("tokens")
    tagged = land(
        rows.select(items.alias("items"), "bad").select(
            F.when(F.col("bad"), F.concat("items", F.array(F.lit(BAD))))
            .otherwise(F.col("items"))
            .alias("items")
        ),
        "url-items",
    )
    model = FPGrowth(minSupport=support, minConfidence=least, itemsCol="items").fit(
        tagged
    )
    rules = model.associationRules.filter(
        (F.size("consequent") == 1) & (F.col("consequent")[0] == BAD)
    ).select(F.sort_array("antecedent").alias("tokens"), "confidence", "support")
    if min_confidence is None:
        # a rule's support counts its bad pages, so support / confidence all its pages
        pages = F.col("support") * n / F.col("confidence")
        chance = F.sqrt(F.lit(share * (1 - share)) / pages)
        rules = rules.filter(F.col("confidence") - share >= min_sigma * chance)
    landed = land(rules, "url-rules")
    # a rule is implied by a shorter one that is at least as sure
    long, short = landed.alias("l"), landed.alias("s")
    implied = (
        long.select("l.tokens", "l.confidence", F.explode("l.tokens").alias("key"))
        .join(short.select(F.col("tokens").alias("st"), F.col("confidence").alias("sc")),
              F.col("key") == F.get("st", F.lit(0)))
        .filter(
            (F.size("st") < F.size("tokens"))
            & (F.col("sc") >= F.col("confidence"))
            & (F.size(F.array_except("st", "tokens")) == 0)
        )
        .select("tokens")
        .distinct()
    )
    kept = landed.join(implied, "tokens", "left_anti")
    whole = kept.select(F.explode(spelled("tokens")).alias("_r"), "confidence", "support")
    return land(whole.select("_r.tokens", "_r.key", "confidence", "support"), "url-kept")


Index = dict[str, list[tuple[frozenset, str, float]]]


def _index(rules: list) -> Index:
    found: Index = {}
    for r in sorted(rules, key=lambda r: (-r["confidence"], -r["support"], r["tokens"])):
        entry = (frozenset(r["tokens"]), " ".join(r["tokens"]), r["confidence"])
        found.setdefault(r["key"], []).append(entry)
    return found


def best_match(tokens: Sequence[str], index: Index) -> tuple[str | None, float | None]:
    """The surest rule whose tokens all occur."""
    mine, best = set(tokens), (None, None)
    for token in tokens:
        for need, text, sure in index.get(token, ()):
            if (best[1] is None or (-sure, text) < (-best[1], best[0])) and need <= mine:
                best = (text, sure)
    return best


def match_rules(pages: DataFrame, rules: DataFrame, limit: int = BROADCAST_RULES) -> DataFrame:
    """Add ``mined_rule`` and ``mined_confidence`` (NULL without a match) by ``tokens``."""
    spark = pages.sparkSession
    if rules.count() <= limit:
        shared = spark.sparkContext.broadcast(_index(rules.collect()))

        @F.pandas_udf("mined_rule string, mined_confidence double")
        def matched(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            index = shared.value
            for tokens in batches:
                rows = [best_match(t, index) for t in tokens]
                yield pd.DataFrame(rows, columns=["mined_rule", "mined_confidence"])

        return (
            pages.withColumn("_m", matched("tokens"))
            .withColumns({c: F.col(f"_m.{c}") for c in ("mined_rule", "mined_confidence")})
            .drop("_m")
        )
    # many rules: the same index as a table, joined by token for distinct token sets
    sets = pages.select("tokens").distinct().withColumn("_key", F.explode("tokens"))
    needs = rules.select(F.col("tokens").alias("_need"), F.col("key").alias("_key"), "confidence")
    best = (
        sets.join(needs, "_key")
        .filter(F.size(F.array_except("_need", "tokens")) == 0)
        .groupBy("tokens")
        .agg(
            F.min(
                F.struct((-F.col("confidence")).alias("c"), F.array_join("_need", " ").alias("t"))
            ).alias("_b")
        )
        .select(
            "tokens",
            F.col("_b.t").alias("mined_rule"),
            (-F.col("_b.c")).alias("mined_confidence"),
        )
    )
    return pages.join(best, "tokens", "left")


def judge_urls(
    pages: DataFrame,
    labels: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_confidence: float | None = None,
    host_rules: Sequence[HostRule] = HOST_RULES,
) -> DataFrame:
    """page_id, host, path, rule, verdict, mined_rule, mined_confidence of every page."""
    session(pages.sparkSession)
    rules = mine_rules(labelled(pages, labels), min_support, min_confidence)
    rows = with_host_and_path(pages.select("page_id", "url"))
    matched = match_rules(rows.withColumn("tokens", url_tokens()), rules)
    text, verdict = fixed_rule(host_rules)
    mined = F.when(F.col("mined_rule").isNotNull(), "block").otherwise("allow")
    return matched.select(
        "page_id",
        "host",
        "path",
        text.alias("rule"),
        F.coalesce(verdict, mined).alias("verdict"),
        "mined_rule",
        "mined_confidence",
    )
