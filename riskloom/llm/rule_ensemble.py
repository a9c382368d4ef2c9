"""A quality classifier made of rules: tree paths, lasso weights, column expressions.

Text statistics are column expressions. A small random forest over them is fitted to
labelled documents; every path from a root to a node becomes a rule, a conjunction of
bounds on statistics. A logistic regression with an L1 penalty over the rules' truth
values keeps few of them; these are compiled into one column expression that scores any
table in a single pass, without a model object or Python.

The fit uses a hash sample of at most about ``MAX_TRAIN`` labelled rows that are not held
out; its ids are broadcast, so that statistics are computed for these rows only. The
statistics see the text alone: no id, language or source.

NULL and empty texts have all statistics zero and get the score of that. Rows without
id are not held out. An id with several labels counts as good where most of them say so.
Without labels, or with labels of one kind, the score is the smoothed share of good ones.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from math import log

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import land, let, session, words

MAX_TRAIN = 20_000
TREES, DEPTH, SEED = 20, 3, 7
PENALTY = 0.002
THRESHOLD = 0.3
FOLDS = 5
HASH_CELLS = 1 << 20

STATS = [
    "n_words",
    "word_length",
    "distinct_share",
    "upper_share",
    "symbol_share",
    "mark_share",
    "bar_share",
    "digit_share",
    "letter_share",
    "dup_line_share",
]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def statistics(text: Column) -> Column:
    """A struct of the statistics (doubles) of a text."""

    def over_words(w: Column) -> Column:
        return let(F.array_join(w, ""), lambda c: over_chars(w, c))

    def over_chars(w: Column, c: Column) -> Column:
        n, size = F.size(w), F.char_length(c)

        def share(part: Column, whole: Column) -> Column:
            return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))

        def lost(pattern: str) -> Column:
            return size - F.char_length(F.regexp_replace(c, pattern, ""))

        lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.trim(x) != "")
        values = {
            "n_words": n.cast("double"),
            "word_length": share(size, n),
            "distinct_share": share(F.size(F.array_distinct(w)), n),
            "upper_share": share(lost(r"\p{Lu}+"), size),
            "symbol_share": share(lost(r"[#*$%&<>]+"), size),
            "mark_share": share(lost("[!?]+"), n),
            "bar_share": share(lost(r"\|+"), n),
            "digit_share": share(lost("[0-9]+"), size),
            "letter_share": share(lost(r"\p{L}+"), size),
            "dup_line_share": let(
                lines, lambda x: share(F.size(x) - F.size(F.array_distinct(x)), F.size(x))
            ),
        }
        return F.struct(*[values[s].alias(s) for s in STATS])

    return let(words(text), over_words)


@dataclass(frozen=True)
class Rule:
    """Bounds on statistics, all of which must hold: low < value <= high."""

    bounds: tuple[tuple[str, float, float], ...]

    def condition(self, stats: Column) -> Column:
        holds = F.lit(True)
        for name, low, high in self.bounds:
            value = stats[name]
            if low > float("-inf"):
                holds = holds & (value > low)
            if high < float("inf"):
                holds = holds & (value <= high)
        return holds

    def __str__(self) -> str:
        return " and ".join(f"{low:g} < {name} <= {high:g}" for name, low, high in self.bounds)


@dataclass
class RuleModel:
    """Score = logistic(intercept + sum of the weights of the rules that hold)."""

    intercept: float
    weights: dict[Rule, float] = field(default_factory=dict)

    def score(self, text: Column) -> Column:
        """One expression of the text; statistics are computed once for a row."""

        def logistic(stats: Column) -> Column:
            margin = F.lit(self.intercept)
            for rule, weight in self.weights.items():
                margin = margin + F.when(rule.condition(stats), weight).otherwise(0.0)
            return 1.0 / (1.0 + F.exp(-margin))

        return let(statistics(text), logistic)


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN) -> DataFrame:
    """label (double) and ``s`` (statistics) of a bounded sample of labelled documents."""
    each = (
        labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
        .filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg((F.avg("quality") > 0.5).cast("double").alias("label"))
    )
    n = each.count()
    cells = HASH_CELLS if n <= max_rows else int(HASH_CELLS * max_rows / n)
    sample = each.filter(F.pmod(F.xxhash64("doc_id"), F.lit(HASH_CELLS)) < cells)
    # about max_rows rows of two numbers
    wanted = F.broadcast(sample.withColumnRenamed("doc_id", "_id"))
    return docs.select("doc_id", "text").join(wanted, F.col("doc_id") == F.col("_id")).select(
        "label", statistics(F.col("text")).alias("s")
    )


def tree_rules(forest) -> list[Rule]:
    """Every path from a root to a node, bounds merged by statistic, each rule once."""
    found: dict[Rule, None] = {}

    def walk(node, bounds: dict[str, tuple[float, float]]) -> None:
        if bounds:
            found[Rule(tuple((k, *v) for k, v in sorted(bounds.items())))] = None
        if node.subtreeDepth() == 0:
            return
        split = node.split()
        name, cut = STATS[split.featureIndex()], split.threshold()
        low, high = bounds.get(name, (float("-inf"), float("inf")))
        walk(node.leftChild(), bounds | {name: (low, min(high, cut))})
        walk(node.rightChild(), bounds | {name: (max(low, cut), high)})

    for tree in forest.trees:
        walk(tree._call_java("rootNode"), {})
    return list(found)


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN) -> RuleModel:
    """Fit the ensemble to the labelled documents that are not held out. Runs jobs."""
    session(docs.sparkSession)
    rows = land(training_rows(docs, labels, max_rows), "rule-training")
    good, n = rows.agg(F.sum("label"), F.count(F.lit(1))).first()
    good = good or 0.0
    if not 0 < good < n:
        share = (good + 1) / (n + 2)
        return RuleModel(_logit(share))
    assembled = VectorAssembler(inputCols=STATS, outputCol="x").transform(
        rows.select("label", "s.*")
    )
    forest = RandomForestClassifier(
        featuresCol="x",
        numTrees=TREES,
        maxDepth=DEPTH,
        featureSubsetStrategy="onethird",
        seed=SEED,
        minInstancesPerNode=max(1, min(20, n // 100)),
    ).fit(assembled)
    rules = tree_rules(forest)
    if not rules:
        return RuleModel(_logit(good / n))
    truth = F.array(*[r.condition(F.col("s")).cast("double") for r in rules])
    vectors = land(rows.select("label", truth.alias("t")), "rule-truth")
    names = [f"r{k}" for k in range(len(rules))]
    wide = vectors.select("label", *[F.get("t", F.lit(k)).alias(c) for k, c in enumerate(names)])
    lasso = LogisticRegression(
        featuresCol="r", elasticNetParam=1.0, regParam=PENALTY, maxIter=60
    ).fit(VectorAssembler(inputCols=names, outputCol="r").transform(wide))
    kept = {r: w for r, w in zip(rules, lasso.coefficients.toArray().tolist()) if w}
    return RuleModel(lasso.intercept, kept)


def _logit(share: float) -> float:
    return log(share / (1 - share))


def with_score(docs: DataFrame, model: RuleModel) -> DataFrame:
    """Add ``score`` (double) and ``predicted`` (int)."""
    scored = docs.withColumn("score", model.score(F.col("text")))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
