"""Quality classifier: a sparse ensemble of rules.

Statistics of the whole text are Spark columns.  On a bounded sample of labelled texts,
boosted trees are grown; the path to each of their nodes is a conjunctive rule over
statistics ("symbols > 0.02 and words <= 400").  Lasso logistic regression gives most rules
weight 0.  The rest are compiled into one Spark column, so scoring is a plain projection.
"""

from __future__ import annotations

from functools import reduce
from operator import add, and_

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakekit.llm.common import fold

SAMPLE = 6000           # labelled texts learnt from (the sample's bound), chosen by a hash
TREES, DEPTH, SHRINK, CUTS = 30, 3, 0.3, 24
LASSO = 0.002
CLIP = 8.0
PREDICT_AT = 0.3
HELD_OUT, FOLDS = 0, 5
_BLANK = r"[\x20\x09-\x0D]+"


def with_statistics(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, list[str]]:
    """``docs`` with statistics columns ``_q_*`` of the whole text (NULL counts as empty)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = docs.withColumn("_q_text", text).withColumn("_q_split", F.split(F.btrim("_q_text", F.lit(" \t\n\x0b\f\r")), _BLANK))
    chars = F.greatest(F.char_length("_q_text"), F.lit(1)).cast("double")
    words = F.size("_q_split").cast("double")
    without = lambda pattern: F.char_length(F.regexp_replace("_q_text", pattern, "")).cast("double")
    size = F.char_length("_q_text")
    stats = {
        "_q_words": words,
        "_q_word_length": size / words,
        "_q_distinct": F.size(F.array_distinct("_q_split")) / words,
        "_q_symbols": (size - without(r"[#*$%&<>]++")) / chars,
        "_q_bars": (size - without(r"\|++")) / words,
        "_q_shouts": (size - without("!++")) / words,
        "_q_upper": (size - without(r"\p{Lu}++")) / chars,
        "_q_digits": (size - without("[0-9]++")) / chars,
        "_q_lines": F.size(F.split("_q_text", "\n")) / words,
    }
    return df.select(*docs.columns, *(c.alias(n) for n, c in stats.items())), list(stats)


# ---------------------------------------------------------------- fitting

Rule = tuple[tuple[int, bool, float], ...]      # (statistic, above, cut), all of which must hold


def _grow(x, residual, weight, cuts, rows, depth, path: Rule, rules: dict[Rule, None], leaf):
    """One regression tree by Newton gain; notes every node's path, gives leaves by ``leaf``."""
    def value(r):
        return residual[r].sum() / (weight[r].sum() + 1.0)

    best = None
    if depth and len(rows) >= 20:
        total = value(rows) * residual[rows].sum()
        for f, thresholds in enumerate(cuts):
            column = x[rows, f]
            for t in thresholds:
                up = column > t
                n = up.sum()
                if n < 5 or n > len(rows) - 5:
                    continue
                gain = sum(value(r) * residual[r].sum() for r in (rows[up], rows[~up])) - total
                if best is None or gain > best[0] + 1e-12:
                    best = (gain, f, t, up)
    if best is None or best[0] <= 1e-9:
        leaf(rows, value(rows))
        return
    _, f, t, up = best
    for above, part in ((True, rows[up]), (False, rows[~up])):
        longer = (*path, (f, above, float(t)))
        rules[_simplify(longer)] = None
        _grow(x, residual, weight, cuts, part, depth - 1, longer, rules, leaf)


def _simplify(rule: Rule) -> Rule:
    tightest: dict[tuple[int, bool], float] = {}
    for f, above, t in rule:
        old = tightest.get((f, above))
        tightest[f, above] = t if old is None else (max if above else min)(old, t)
    return tuple((f, above, t) for (f, above), t in sorted(tightest.items()))


def _holds(x: np.ndarray, rule: Rule) -> np.ndarray:
    return reduce(and_, [(x[:, f] > t) if above else (x[:, f] <= t) for f, above, t in rule])


def _sigmoid(m: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-m))


def fit_rules(x: np.ndarray, y: np.ndarray, seed: int = 7) -> tuple[float, list[tuple[float, Rule]]]:
    """(intercept, [(weight, rule)]) with the log odds of label 1.  One class alone, or no
    rows, gives no rules: the intercept is the smoothed log odds."""
    prior = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    if len(y) == 0 or y.min() == y.max():
        return prior, []
    rng = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, CUTS + 2)[1:-1])) for f in range(x.shape[1])]
    margin, rules = np.full(len(y), prior), {}
    for _ in range(TREES):
        p = _sigmoid(margin)
        rows = np.sort(rng.permutation(len(y))[: max(20, len(y) // 2)])
        step = np.zeros(len(y))
        leaves: list[tuple[np.ndarray, float]] = []
        _grow(x, y - p, p * (1 - p), cuts, rows, DEPTH, (), rules, lambda r, v: leaves.append((r, v)))
        for r, v in leaves:
            step[r] = v
        margin += SHRINK * np.clip(step, -4, 4)
    names = list(rules)
    if not names:       # too few rows for a split
        return prior, []
    design = np.column_stack([_holds(x, r) for r in names]).astype(float)
    design, first = np.unique(design, axis=1, return_index=True)    # rules that hold for the same rows
    names = [names[i] for i in first]
    weights, intercept = _lasso(design, y)
    return intercept, [(float(w), r) for w, r in zip(weights, names) if abs(w) > 1e-6]


def _lasso(design: np.ndarray, y: np.ndarray, rounds: int = 600) -> tuple[np.ndarray, float]:
    """Accelerated proximal gradient for logistic loss with an L1 penalty (not on the intercept)."""
    n, k = design.shape
    a = np.column_stack([design, np.ones(n)])
    w = np.zeros(k + 1)
    w[-1] = np.log(y.mean() / (1 - y.mean()))
    step = 4 * n / (np.linalg.norm(a, 2) ** 2 + 1e-9)
    z, t = w.copy(), 1.0
    for _ in range(rounds):
        moved = z - step * (a.T @ (_sigmoid(a @ z) - y)) / n
        moved[:-1] = np.sign(moved[:-1]) * np.maximum(np.abs(moved[:-1]) - step * LASSO, 0)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, w, t = moved + (t - 1) / t2 * (moved - w), moved, t2
    return w[:-1], float(w[-1])


# ---------------------------------------------------------------- Spark

def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id",
                  text_col: str = "text", label_col: str = "quality") -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Statistics and labels of up to ``sample`` labelled texts outside the held-out fold.

    A document labelled twice has its smallest label; NULL labels and ids are left out.  Of
    rows that share an id one is learnt from, the one whose text has the least hash.
    """
    chosen = (labels.where(F.col(label_col).isNotNull() & (fold(F.col(id_col), FOLDS) != HELD_OUT))
              .groupBy(F.col(id_col).alias("_id")).agg(F.min(label_col).cast("double").alias("_y"))
              .orderBy(F.xxhash64("_id"), "_id").limit(sample))   # the documented bound on what is learnt from
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(chosen), "_id")
    stats, names = with_statistics(texts, "_text")
    one = stats.groupBy("_id").agg(F.min(F.struct(F.xxhash64("_text").alias("_print"), "_y", *names)).alias("_one"))
    rows = one.select("_id", "_one._y", *(F.col(f"_one.{n}").alias(n) for n in names)).toArrow()
    table = np.column_stack([rows[c].to_numpy() for c in ("_id", "_y", *names)]) if rows.num_rows else np.zeros((0, 2 + len(names)))
    table = table[np.lexsort(table.T[::-1])]
    return table[:, 2:], table[:, 1], names


def rule_score(intercept: float, rules: list[tuple[float, Rule]], names: list[str]) -> Column:
    """The compiled ensemble: probability of label 1."""
    def holds(rule: Rule) -> Column:
        return reduce(and_, [(F.col(names[f]) > t) if above else (F.col(names[f]) <= t) for f, above, t in rule])

    margin = reduce(add, [F.when(holds(r), F.lit(w)).otherwise(F.lit(0.0)) for w, r in rules], F.lit(intercept))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.least(F.greatest(margin, F.lit(-CLIP)), F.lit(CLIP))))


def score_quality(docs: DataFrame, model, text_col: str = "text", score_out: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1.  One row per input row, any other columns kept."""
    intercept, rules, names = model
    stats, _ = with_statistics(docs, text_col)
    return stats.select(*docs.columns, rule_score(intercept, rules, names).alias(score_out))


def train_quality(docs: DataFrame, labels: DataFrame, **columns):
    x, y, names = training_rows(docs, labels, **columns)
    return (*fit_rules(x, y), names)


def classify_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """id, held_out, score, predicted of every document; a NULL or empty text is scored as an
    empty one; a NULL id counts as held out.  Without labels every score is 0.5."""
    model = train_quality(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col)
    rows = docs.select(F.col(id_col), F.col(text_col).alias("_text"), F.coalesce(fold(F.col(id_col), FOLDS) == HELD_OUT, F.lit(True)).alias("held_out"))
    return score_quality(rows, model, "_text").drop("_text").withColumn("predicted", (F.col("score") >= PREDICT_AT).cast("int"))
