"""Quality classifier: a sparse ensemble of rules over statistics of a text.

The statistics are Spark columns over the whole text. Small trees grow on a bounded sample of
labelled rows; each path from a root is a rule, a conjunction of bounds on statistics. A
logistic model with an L1 penalty picks few of the rules and weighs them. The model is then
compiled into one column expression, so scoring is a projection beside the scan.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.functions.once import with_computed

#: Labelled rows that a model is fitted on at most; rows of smallest id hash are taken.
SAMPLE_ROWS = 12_000
#: Documents scoring at least this are predicted to be of quality 1.
THRESHOLD = 0.7

TREES, DEPTH, LEAF_ROWS, CANDIDATES = 24, 3, 25, 24
PENALTY, ROUNDS, SEED = 0.001, 400, 7


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def statistics(docs: DataFrame, text: str) -> tuple[DataFrame, list[str]]:
    """The rows with one double per statistic, and the statistics' names.

    NULL text counts as empty; a ratio over nothing is 0.
    """
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    found = {
        "__words": F.split(value, r"\s+"),
        "__lines": F.split(value, "\n"),
    }
    counts = {
        "__chars": F.length(value),
        "__word_count": F.size("__words"),
        "__distinct_words": F.size(F.array_distinct("__words")),
        "__line_count": F.size("__lines"),
        "__distinct_lines": F.size(F.array_distinct("__lines")),
        # Fewer matches than letters are: each match costs more than passing a letter.
        "__others": F.regexp_count(value, F.lit(r"\P{L}")),
        "__uppers": F.regexp_count(value, F.lit(r"\p{Lu}")),
        "__marks": F.regexp_count(value, F.lit(r"[^\p{L}\p{N}\s.,]")),
        "__digits": F.regexp_count(value, F.lit(r"\p{N}")),
        "__stops": F.regexp_count(value, F.lit("[.,]")),
    }
    # Generator outputs: each array and each count is made once, however often it is used.
    counted = with_computed(with_computed(docs, found), counts)
    chars, words, lines = F.col("__chars"), F.col("__word_count"), F.col("__line_count")
    letters = chars - F.col("__others")
    columns = {
        "stat_chars": F.log1p(chars.cast("double")),
        "stat_word_length": _ratio(chars - words + 1, words),
        "stat_distinct_words": _ratio(F.col("__distinct_words"), words),
        "stat_line_length": F.log1p(_ratio(chars, lines)),
        "stat_distinct_lines": _ratio(F.col("__distinct_lines"), lines),
        "stat_letters": _ratio(letters, chars),
        "stat_upper": _ratio(F.col("__uppers"), letters),
        "stat_marks": _ratio(F.col("__marks"), chars),
        "stat_digits": _ratio(F.col("__digits"), chars),
        "stat_stops": _ratio(F.col("__stops"), words),
    }
    measured = counted.select(
        *(c for c in docs.columns if c not in columns),
        *(column.cast("double").alias(name) for name, column in columns.items()),
    )
    return measured, list(columns)


@dataclass(frozen=True)
class Bound:
    """A statistic above a value, or not above it."""

    statistic: int
    above: bool
    value: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        return (x[:, self.statistic] > self.value) == self.above


@dataclass(frozen=True)
class RuleModel:
    names: tuple[str, ...]
    rules: tuple[tuple[tuple[Bound, ...], float], ...]
    base: float

    def score(self) -> Column:
        """The model as one column expression over the statistics."""
        total = F.lit(self.base)
        for bounds, weight in self.rules:
            holds = F.lit(True)
            for bound in bounds:
                column, value = F.col(self.names[bound.statistic]), F.lit(bound.value)
                holds = holds & (column > value if bound.above else column <= value)
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-total))


def _best_split(x: np.ndarray, y: np.ndarray, statistics: np.ndarray) -> Bound | None:
    """The bound that lowers the squared error of the mean the most."""
    best, found = 1e-9, None
    whole = y.sum() ** 2 / len(y)
    for at in statistics:
        values = np.unique(np.quantile(x[:, at], np.linspace(0, 1, CANDIDATES + 2)[1:-1], method="lower"))
        order = np.argsort(x[:, at], kind="stable")
        sums = np.concatenate([[0.0], np.cumsum(y[order])])
        left = np.searchsorted(x[order, at], values, "right")
        keep = (left >= LEAF_ROWS) & (len(y) - left >= LEAF_ROWS)
        if keep.any():
            left, values = left[keep], values[keep]
            gain = sums[left] ** 2 / left + (sums[-1] - sums[left]) ** 2 / (len(y) - left) - whole
            top = int(np.argmax(gain))
            if gain[top] > best:
                best, found = gain[top], Bound(int(at), True, float(values[top]))
    return found


def _paths(x: np.ndarray, y: np.ndarray, random: np.random.Generator, depth: int) -> list[tuple[Bound, ...]]:
    """Rules of one tree: the path to each of its nodes below the root."""
    if not depth or len(y) < 2 * LEAF_ROWS or y.min() == y.max():
        return []
    tried = random.choice(x.shape[1], max(2, x.shape[1] // 2), replace=False)
    bound = _best_split(x, y, tried)
    if bound is None:
        return []
    rules = []
    for side in (bound, Bound(bound.statistic, False, bound.value)):
        inside = side.holds(x)
        rules.append((side,))
        rules += [(side, *path) for path in _paths(x[inside], y[inside], random, depth - 1)]
    return rules


def _lasso(z: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic weights with an L1 penalty by accelerated proximal gradient steps."""
    scale = np.maximum(z.std(axis=0), 1e-3)
    centre = z.mean(axis=0)
    z = (z - centre) / scale
    n = len(y)
    step = 4.0 / max(np.linalg.norm(z, 2) ** 2 / n, 1e-9)
    rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    w, base = np.zeros(z.shape[1]), float(np.log(rate / (1 - rate)))
    ahead, momentum = w.copy(), 1.0
    for _ in range(ROUNDS):
        error = 1 / (1 + np.exp(-(z @ ahead + base))) - y
        new = ahead - step * (z.T @ error) / n
        new = np.sign(new) * np.maximum(np.abs(new) - step * PENALTY, 0)
        base -= 2.0 * error.mean()
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead = new + (momentum - 1) / following * (new - w)
        w, momentum = new, following
    weights = w / scale
    return weights, base - float(centre @ weights)


def fit(x: np.ndarray, y: np.ndarray, names: list[str]) -> RuleModel:
    """A model of 0/1 labels. Without rows it scores 0.5; with one label only, near that one."""
    if not len(y):
        return RuleModel(tuple(names), (), 0.0)
    random = np.random.default_rng(SEED)
    rules: dict[tuple[Bound, ...], None] = {}
    for _ in range(TREES):
        rows = random.integers(0, len(y), len(y) // 2 + 1)
        rules |= dict.fromkeys(_paths(x[rows], y[rows], random, DEPTH))
    if not rules:
        rate = np.clip(y.mean(), 0.02, 0.98)
        return RuleModel(tuple(names), (), float(np.log(rate / (1 - rate))))
    z = np.stack([np.logical_and.reduce([b.holds(x) for b in rule]) for rule in rules], axis=1)
    z, first = np.unique(z, axis=1, return_index=True)
    weights, base = _lasso(z.astype(np.float64), y.astype(np.float64))
    listed = list(rules)
    kept = [(listed[i], float(w)) for i, w in zip(first, weights) if abs(w) > 1e-6]
    return RuleModel(tuple(names), tuple(kept), float(base))


def train(
    docs: DataFrame,
    labels: DataFrame,
    learn_from: Column,
    id_column: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> RuleModel:
    """Fit on at most ``sample_rows`` labelled rows, those of smallest id hash.

    ``learn_from`` is a condition on the id. Rows with a NULL id, or a label other than 0 and
    1, teach nothing.
    """
    chosen = (
        labels.where(learn_from)
        .select(F.col(id_column).alias("row_id"), F.col(label).cast("int").alias("row_label"))
        .where("row_id is not null and row_label in (0, 1)")
    )
    sample = chosen.orderBy(F.xxhash64("row_id"), "row_id").limit(sample_rows)
    texts = docs.select(F.col(id_column).alias("row_id"), F.col(text).alias("row_text"))
    # The sample's bound is the broadcast's bound: texts are not shuffled for the labels.
    measured, names = statistics(texts.join(F.broadcast(sample), "row_id"), "row_text")
    rows = measured.select("row_id", "row_label", *names).orderBy("row_id").limit(sample_rows).toPandas()
    return fit(rows[names].to_numpy(np.float64), rows["row_label"].to_numpy(np.float64), names)


def score(
    docs: DataFrame, model: RuleModel, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Every row as ``id_column, score``. NULL text counts as empty and is scored too; rows may
    repeat, ids may be NULL; other columns are not read."""
    rows = docs.select(F.col(id_column).alias("row_id"), F.col(text).alias("row_text"))
    measured, _ = statistics(rows, "row_text")
    return measured.select(F.col("row_id").alias(id_column), model.score().alias("score"))


def keep_good(
    docs: DataFrame, model: RuleModel, text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """The rows that score at least the threshold, with all their columns."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(text).alias("row_text"))
    measured, _ = statistics(rows, "row_text")
    return measured.where(model.score() >= threshold).select("row.*")
