"""A quality classifier made of rules.

Statistics of whole texts feed a small forest; every path from a root to a node
of it is a conjunctive rule over statistics. A logistic model with an L1 penalty
weighs the rules, and most weights come out as zero. What is left is a sum of
rules, compiled into one Spark column expression over the statistics: scoring is
a projection.

The forest and the weights are fitted by Spark on at most ``MAX_ROWS`` labelled
rows, chosen by a hash of their id; below that number all of them are used.

Defined results: null and empty texts have statistics of zero and are scored
like any other; rows without a label, with a null id, or whose label is neither
0 nor 1 are not learned from; where labels of one kind only are there, every
text scores that label, and without labels 0.5; repeated rows count as often as
they occur; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeseek.llm.quality_rules import repeated_words
from treeseek.llm.rows import column
from treeseek.session import materialise, spread

MAX_ROWS = 50_000
TREES = 24
DEPTH = 3
PENALTY = 0.001
SEED = 17

STATISTICS = (
    "n_words", "mean_word", "distinct_share", "top_share", "repeated_share", "upper_share", "digit_share",
    "symbol_share", "mark_share", "pipe_words", "words_per_line", "duplicate_lines", "ends_share", "short_share",
)

# One condition of a rule: statistic, threshold, and whether the value lies above it.
Condition = tuple[str, float, bool]
Rule = tuple[Condition, ...]


def statistics(text: str | None) -> tuple[float, ...]:
    """The statistics of a whole text, in the order of ``STATISTICS``."""
    text = text or ""
    words = text.split()
    if not words:
        return (0.0,) * len(STATISTICS)
    n, size = len(words), len(text)
    counts = Counter(w.lower() for w in words)
    lines = [line.strip() for line in text.split("\n") if line.strip()]
    letters = sum(map(len, words))
    upper = sum(1 for c in text if c.isupper()) if not text.islower() else 0
    symbols = sum(text.count(c) for c in "#*$%&<>@^~{}[]\\=+_/")
    return (
        float(n),
        letters / n,
        len(counts) / n,
        counts.most_common(1)[0][1] / n,
        repeated_words([w.encode() for w in words]) / n,
        upper / letters,
        sum(text.count(c) for c in "0123456789") / size,
        symbols / size,
        sum(text.count(c) for c in "!?;:") / size,
        counts["|"] / n,
        n / len(lines),
        1 - len(set(lines)) / len(lines),
        sum(1 for line in lines if line[-1] in ".!?") / len(lines),
        sum(1 for w in words if len(w) <= 2) / n,
    )


def with_statistics(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with its text replaced by one double per statistic."""
    rest = [c for c in docs.columns if c != text_column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [statistics(t.as_py()) for t in batch.column(text_column)]
            arrays = [pa.array([v[i] for v in values], pa.float64()) for i in range(len(STATISTICS))]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in rest] + arrays, names=[*rest, *STATISTICS])

    schema = docs.select(*rest, *[F.lit(0.0).alias(s) for s in STATISTICS]).schema
    return spread(docs).mapInArrow(run, schema)


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    weights: tuple[tuple[Rule, float], ...]
    constant: float | None = None

    def score(self) -> Column:
        """The model as a column expression over the statistics."""
        if self.constant is not None:
            return F.lit(self.constant)
        total = F.lit(self.intercept)
        for rule, weight in self.weights:
            total = total + F.when(condition(rule), weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def condition(rule: Rule) -> Column:
    out = F.lit(True)
    for name, threshold, above in rule:
        out = out & (F.col(name) > threshold if above else F.col(name) <= threshold)
    return out


def rules_of(forest) -> list[Rule]:
    """The path to each node below the roots of a fitted forest, each rule once."""
    found: dict[Rule, None] = {}

    def walk(node, path: Rule) -> None:
        if path:
            found.setdefault(tuple(sorted(path)))
        if node.numDescendants() == 0:
            return
        split = node.split()
        name, threshold = STATISTICS[split.featureIndex()], float(split.threshold())
        walk(node.leftChild(), (*path, (name, threshold, False)))
        walk(node.rightChild(), (*path, (name, threshold, True)))

    for tree in forest.trees:
        walk(tree._java_obj.rootNode(), ())
    return list(found)


def fit(labelled: DataFrame, max_rows: int = MAX_ROWS) -> RuleModel:
    """From the statistics and ``label`` (0 or 1), with ``id`` for the choice of at most ``max_rows`` rows."""
    usable = labelled.where("label IN (0, 1) AND id IS NOT NULL")
    chosen = materialise(usable.select("id", F.col("label").cast("double").alias("label"), *STATISTICS), "labelled")
    counts = {r["label"]: r["n"] for r in chosen.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return RuleModel(0.0, (), next(iter(counts), 0.5))
    share = -(-sum(counts.values()) // max_rows)
    chosen = chosen.where(F.pmod(F.xxhash64("id"), F.lit(share)) == 0) if share > 1 else chosen
    vectors = chosen.select("label", array_to_vector(F.array(*STATISTICS)).alias("features"))
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, minInstancesPerNode=5, featureSubsetStrategy="onethird", seed=SEED
    ).fit(vectors)
    rules = rules_of(forest)
    if not rules:
        return RuleModel(0.0, (), counts[1.0] / sum(counts.values()))
    held = F.array(*[condition(rule).cast("double") for rule in rules])
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=PENALTY, maxIter=100)
    fitted = lasso.fit(chosen.select("label", array_to_vector(held).alias("features")))
    weights = [(rule, float(w)) for rule, w in zip(rules, fitted.coefficients.toArray()) if w]
    return RuleModel(float(fitted.intercept), tuple(weights))


def classify(
    docs: DataFrame,
    labels: DataFrame,
    learns,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """id, score and the statistics of each row of ``docs``.

    Learned from the rows whose ``id`` has a label and for which the condition
    ``learns`` on ``id`` holds.
    """
    texts = docs.select(column(id_column).alias("id"), column(text_column).alias("text"))
    stats = materialise(with_statistics(texts), "statistics")
    known = labels.select(column(id_column).alias("id"), column(label_column).alias("label")).where(learns)
    model = fit(stats.join(known, "id"), max_rows)
    return stats.withColumn("score", model.score())
