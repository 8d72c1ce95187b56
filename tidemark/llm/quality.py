"""Quality classifier: a sparse ensemble of rules over statistics of a text.

Small boosted trees are grown on the statistics of labelled texts.  Every path from a
root to a node is a conjunction of comparisons, a rule that is true or false for a text.
A logistic model with a lasso penalty picks few of the rules, and those are compiled
into one Spark column, so scoring runs inside Spark's generated code.

The model is fitted on the driver in numpy, on the statistics of at most `SAMPLE_ROWS`
labelled rows (those with the smallest hashes); scores cover every row.

Defined results: a null text counts as an empty one and gets the score of its statistics,
which are all 0.  Repeated rows are scored alike; repeated labels of a document all
count.  Rows whose label is null teach nothing.  With no labels, or one kind only, the
score is the smoothed share of label 1.  An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import WORD

SAMPLE_ROWS = 8192
TREES, DEPTH, RATE, LEAST_LEAF = 40, 3, 0.3, 8
PENALTY, STEPS = 2e-3, 400
BINS = 32


def _counted(text: str) -> Column:
    """What is counted in a whole text, each thing once, as one struct."""
    t = F.coalesce(F.col(text), F.lit(""))

    def count(pattern: str) -> Column:
        return F.regexp_count(t, F.lit(pattern)).cast("double")

    def parts(pattern: str) -> Column:
        # One element, so that the text is split once for both sizes.
        sizes = F.transform(
            F.array(F.split(t, pattern)),
            lambda x: F.struct(F.size(x).alias("all"), F.size(F.array_distinct(x)).alias("distinct")),
        )
        return F.element_at(sizes, 1)

    counts = {
        "words": count(WORD),
        "chars": F.length(t).cast("double"),
        "capital_runs": count(r"\p{Lu}{2,}"),
        "symbol_runs": count(r"[^\p{L}\p{N}\s]{2,}"),
        "lone_symbols": count(r"(?<=\s)[^\p{L}\p{N}\s](?=\s)"),
        "stops": count(r"[.!?]"),
        "commas": count(","),
        "digits": count(r"\d"),
        "long_words": count(r"[^\x20\x09-\x0D]{16,}"),
        "word_parts": parts(r"[\x20\x09-\x0D]+"),
        "lines": parts("\n"),
    }
    return F.struct(*[c.alias(name) for name, c in counts.items()])


def statistics(counts: str = "counts") -> dict[str, Column]:
    """Statistics of whole texts from their counts; shares are per word, per line or per character."""

    def c(name: str) -> Column:
        return F.col(f"{counts}.{name}")

    n = F.greatest(c("words"), F.lit(1.0))
    shares = ["capital_runs", "symbol_runs", "lone_symbols", "stops", "commas", "digits", "long_words"]
    return {
        "words": c("words"),
        "word_length": c("chars") / n,
        "line_words": n / c("lines.all"),
        **{name: c(name) / n for name in shares},
        "distinct_words": c("word_parts.distinct") / c("word_parts.all"),
        "distinct_lines": c("lines.distinct") / c("lines.all"),
    }


def measured(docs: DataFrame, *columns: Column | str) -> DataFrame:
    """`columns` of `docs` (with a text) beside `counts`.

    The counts come out of a generator: a filter on what is made of them, such as the
    score, is not pushed below it, where each use would count the whole text again.
    """
    return docs.select(*columns, F.explode(F.array(_counted("text"))).alias("counts"))


@dataclass(frozen=True)
class Rule:
    """`statistic > bound` (above) or `statistic <= bound`, all of them."""

    terms: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        out = F.lit(True)
        for name, above, bound in self.terms:
            out &= F.col(name) > bound if above else F.col(name) <= bound
        return out


@dataclass(frozen=True)
class RuleModel:
    rules: tuple[Rule, ...]
    weights: tuple[float, ...]
    intercept: float

    def score(self) -> Column:
        """Probability of label 1 from the columns of `statistics`."""
        total = F.lit(self.intercept)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            total = total + F.when(rule.column(), weight).otherwise(0.0)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _grow(x, codes, edges, grad, hess, rows, depth, terms, rules):
    """Adds the node's rule and returns (rows, value) of the leaves below it."""
    if terms:
        rules.append(tuple(terms))
    g, h = grad[rows].sum(), hess[rows].sum()
    best = (1e-6, None)
    if depth and len(rows) >= 2 * LEAST_LEAF:
        for j in range(x.shape[1]):
            c = codes[rows, j]
            left_g = np.cumsum(np.bincount(c, grad[rows], BINS))[:-1]
            left_h = np.cumsum(np.bincount(c, hess[rows], BINS))[:-1]
            left_n = np.cumsum(np.bincount(c, minlength=BINS))[:-1]
            gain = left_g**2 / (left_h + 1) + (g - left_g) ** 2 / (h - left_h + 1) - g**2 / (h + 1)
            gain[(left_n < LEAST_LEAF) | (len(rows) - left_n < LEAST_LEAF)] = 0
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (gain[k], (j, k))
    if best[1] is None:
        return [(rows, -g / (h + 1))]
    j, k = best[1]
    above = codes[rows, j] > k
    out = []
    for side, part in ((False, rows[~above]), (True, rows[above])):
        out += _grow(x, codes, edges, grad, hess, part, depth - 1, [*terms, (j, side, edges[j][k])], rules)
    return out


def _paths(x: np.ndarray, y: np.ndarray) -> list[tuple]:
    """Distinct paths of boosted trees, as tuples of (column, above, bound)."""
    shares = np.linspace(0, 1, BINS + 1)[1:-1]
    edges = [np.quantile(x[:, j], shares) for j in range(x.shape[1])]
    codes = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1)
    z = np.full(len(y), np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    rules: list[tuple] = []
    for _ in range(TREES):
        p = _sigmoid(z)
        grown: list[tuple] = []
        for rows, value in _grow(x, codes, edges, p - y, p * (1 - p), np.arange(len(y)), DEPTH, [], grown):
            z[rows] += RATE * value
        rules += grown
    return list(dict.fromkeys(rules))


def _holds(x: np.ndarray, terms: tuple) -> np.ndarray:
    out = np.ones(len(x), bool)
    for j, above, bound in terms:
        out &= x[:, j] > bound if above else x[:, j] <= bound
    return out


def _lasso(r: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic weights with an L1 penalty, by accelerated proximal gradient steps."""
    n, k = r.shape
    w, b = np.zeros(k), np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))
    v, c, t = w, b, 1.0
    step = 4 * n / max(np.linalg.norm(np.hstack([r, np.ones((n, 1))]), 2) ** 2, 1e-9)
    for _ in range(STEPS):
        d = (_sigmoid(r @ v + c) - y) / n
        moved = v - step * (r.T @ d)
        new = np.sign(moved) * np.maximum(np.abs(moved) - step * PENALTY, 0)
        new_b, new_t = c - step * d.sum(), (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = new + (t - 1) / new_t * (new - w), new_b + (t - 1) / new_t * (new_b - b)
        w, b, t = new, new_b, new_t
    return w, float(b)


def fit(names: list[str], x: np.ndarray, y: np.ndarray) -> RuleModel:
    """Rules and weights from statistics `x` (a row per text) and labels `y` (0 or 1)."""
    if len(y) == 0 or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return RuleModel((), (), float(np.log(share / (1 - share))))
    paths = _paths(x, y)
    truth = np.stack([_holds(x, p) for p in paths], axis=1) if paths else np.zeros((len(y), 0), bool)
    _, first = np.unique(truth, axis=1, return_index=True)  # rules that agree on all rows are one
    paths, truth = [paths[i] for i in sorted(first)], truth[:, sorted(first)]
    weights, intercept = _lasso(truth.astype(np.float64), y)
    kept = [i for i in range(len(paths)) if weights[i]]
    rules = tuple(Rule(tuple((names[j], bool(up), float(at)) for j, up, at in paths[i])) for i in kept)
    return RuleModel(rules, tuple(float(weights[i]) for i in kept), intercept)


def train(docs: DataFrame, labels: DataFrame, label: str, learns: Column) -> RuleModel:
    """A model of `label` from the documents for which `learns` (over doc_id) holds."""
    known = labels.select("doc_id", F.col(label).alias("label")).filter(learns & F.col("label").isNotNull())
    # A bounded number of rows: they may be broadcast and collected.
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(SAMPLE_ROWS)
    texts = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    stats = statistics()
    rows = measured(texts, "doc_id", "label").select("doc_id", "label", *[c.alias(n) for n, c in stats.items()])
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "label", *stats).limit(SAMPLE_ROWS).toPandas()
    return fit(list(stats), rows[list(stats)].to_numpy(np.float64), (rows["label"] == 1).to_numpy(np.float64))


def scored(docs: DataFrame, model: RuleModel, score: str = "score") -> DataFrame:
    """`docs` with a score; columns of `docs` keep their values, whatever their names."""
    known = measured(docs, F.struct(*docs.columns).alias("row"))
    known = known.select("row", *[c.alias(n) for n, c in statistics().items()])
    return known.select("row.*", model.score().alias(score))
