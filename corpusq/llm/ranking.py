"""Document quality by Bradley-Terry pairwise ranking.

Each document has a few measures of its whole text. From all labelled rows preference pairs (a good
document before a bad one) are made, and a linear score is learned by the logistic loss on the
difference of their measures. The decision is a quantile of the scores: the share of bad rows among
the labelled ones. Measures and scores are DataFrame expressions; scoring is one pass, no shuffle. In training every
text is measured where it is read and only its measures meet the labels; it
keeps the measures of the labelled rows in a table; only sums over its pairs reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusq.llm.common import map_arrow, written

#: Labelled rows that meet in one block, and the pairs that a row of the commoner label is in.
BLOCK_ROWS = 2048
PARTNERS = 20
#: Rows of the scarcer label that a block gets, if need be by repeating them in several blocks.
LEAST_SCARCE = 64
#: The quantile is exact up to this many labelled rows, then its rank is off by at most one row in as many.
RANK_ACCURACY = 100_000
RUN_BYTES = 8 << 20
#: The probability that the chosen quantile of the scores is given.
CUT = 0.3


def measures(text: Column) -> dict[str, Column]:
    """Measures of a text in DataFrame functions; NULL counts as the empty text."""
    t = F.coalesce(text, F.lit(""))
    size = F.greatest(F.length(t), F.lit(1))
    count = lambda kept: F.length(F.regexp_replace(t, f"[^{kept}]+", ""))
    words = F.filter(F.split(F.lower(t), r"[ \t-\r]+"), lambda w: w != "")
    lines = F.filter(F.split(t, "\n"), lambda x: F.trim(x) != "")
    return {
        "log_chars": F.log1p(F.length(t).cast("double")),
        "symbols": F.sqrt(count("#*$%&|<>") / size),
        "marks": F.sqrt(count("!?") / size),
        "upper": F.sqrt(count("A-Z") / size),
        "digits": F.sqrt(count("0-9") / size),
        "stops": F.sqrt(count(".,;:") / size),
        "_words": F.transform(F.array(words), lambda w: F.struct(
            F.size(w).alias("n"),
            F.size(F.array_distinct(w)).alias("distinct"),
            F.length(F.array_join(w, "")).alias("chars"),
        )).getItem(0),
        "_lines": F.transform(F.array(lines), lambda x: F.struct(
            F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("distinct")
        )).getItem(0),
    }


NAMES = (
    "log_chars", "symbols", "marks", "upper", "digits", "stops", "log_words", "word_size", "variety", "log_lines",
    "line_copies", "line_words",
)


def measured(docs: DataFrame, text: Column, keep: list[Column]) -> DataFrame:
    """``keep`` and one double per name in ``NAMES``."""
    first = docs.select(*keep, *[c.alias(f"_m_{n}") for n, c in measures(text).items()])
    n, lines = F.col("_m__words.n"), F.col("_m__lines.n")
    some = lambda c: F.greatest(c, F.lit(1))
    derived = {
        "log_words": F.log1p(n.cast("double")),
        "word_size": F.log1p(F.col("_m__words.chars") / some(n)),
        "variety": F.col("_m__words.distinct") / some(n),
        "log_lines": F.log1p(lines.cast("double")),
        "line_copies": F.sqrt((lines - F.col("_m__lines.distinct")) / some(lines)),
        "line_words": F.log1p(n / some(lines)),
    }
    kept = [c for c in first.columns if not c.startswith("_m_")]
    return first.select(*kept, *[(derived[n] if n in derived else F.col(f"_m_{n}")).cast("double").alias(n) for n in NAMES])


@dataclass
class RankModel:
    """Weights of standardised measures (and their squares); ``cut`` is the quantile of the scores."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    cut: float
    scale: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return expanded((x - self.mean) / self.spread) @ self.weights


def expanded(z: np.ndarray) -> np.ndarray:
    z = np.clip(z, -4, 4)
    return np.concatenate([z, z * z], axis=1)


def differences(z: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Good minus bad over the pairs of a block: each row of the commoner label meets ``PARTNERS`` of the other, dealt in turn."""
    good, bad = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    n, few = max(len(good), len(bad)), min(len(good), len(bad))
    if few == 0:
        return z[:0]
    rounds = min(PARTNERS, few)
    own = np.tile(np.arange(n), rounds)
    other = (own + np.repeat(np.arange(rounds) * few // rounds, n)) % few
    return z[good[own]] - z[bad[other]] if len(good) == n else z[good[other]] - z[bad[own]]


def sums(d: np.ndarray, w: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of pairs, and the sums of gradient and curvature of their logistic loss."""
    p = 1 / (1 + np.exp(np.clip(d @ w, -40, 40)))
    return len(d), -(d.T @ p), (d * (p * (1 - p))[:, None]).T @ d


def newton(total: Callable[[np.ndarray], tuple[int, np.ndarray, np.ndarray]], size: int, ridge: float = 1e-3) -> np.ndarray:
    """Weights of the least loss; ``total`` gives ``sums`` over all pairs."""
    w = np.zeros(size)
    for _ in range(30):
        n, gradient, curve = total(w)
        step = np.linalg.solve(curve / n + ridge * np.eye(size), gradient / n + ridge * w)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return w


def _equal_scores(mean: np.ndarray, spread: np.ndarray, good: int, bad: int) -> RankModel:
    """Without both labels there is nothing to learn: all rows are kept, or none if all labelled ones are bad."""
    return RankModel(mean, spread, np.zeros(2 * len(NAMES)), 1.0 if not good and bad else -1.0, 1.0)


def fit(x: np.ndarray, labels: np.ndarray, seed: int = 7) -> RankModel:
    """``train`` over measures in memory, as one block."""
    labels = np.asarray(labels)
    mean, spread = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    good, bad = int((labels == 1).sum()), int((labels == 0).sum())
    if not good or not bad:
        return _equal_scores(mean, spread, good, bad)
    z = expanded((x - mean) / spread)
    order = np.random.default_rng(seed).permutation(len(z))
    d = differences(z[order], labels[order])
    w = newton(lambda w: sums(d, w), z.shape[1])
    return RankModel(mean, spread, w, float(np.quantile(z @ w, bad / len(labels))), 1.0)


def train(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    seed: int = 7,
) -> RankModel:
    """Fit on all labelled rows, whole texts.

    Rows with a NULL label or id are not used; if an id has several labels the least counts. Texts are never shuffled. Each Newton step is one pass over
    the pairs in the tasks.
    """
    chosen = (
        labels.filter(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
        .groupBy(F.col(doc_id).alias("_id"))
        .agg(F.min(label).cast("double").alias("_label"))
    )
    rows = measured(docs.filter(F.col(doc_id).isNotNull()), F.col(text), [F.col(doc_id).alias("_id")])
    table = written(rows.join(chosen, "_id").select("_id", "_label", *NAMES), "measures")
    is_good, is_bad = F.col("_label") == 1, F.col("_label") == 0
    seen = table.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(is_good).alias("good"), F.count_if(is_bad).alias("bad"),
        F.array(*[F.avg(c) for c in NAMES]).alias("mean"), F.array(*[F.stddev_pop(c) for c in NAMES]).alias("spread"),
    ).first()
    if not seen["n"]:
        return _equal_scores(np.zeros(len(NAMES)), np.ones(len(NAMES)), 0, 0)
    mean, spread = np.array(seen["mean"]), np.maximum(seen["spread"], 1e-6)
    if not seen["good"] or not seen["bad"]:
        return _equal_scores(mean, spread, seen["good"], seen["bad"])
    blocks = written(_blocks(table, seen["good"], seen["bad"], seed), "blocks")
    k = 2 * len(NAMES)

    def total(w: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
        def run(some: pa.Table) -> pa.Table:
            n, gradient, curve = 0, np.zeros(k), np.zeros((k, k))
            for x, y in zip(some["x"].combine_chunks(), some["y"].combine_chunks(), strict=True):
                own = np.asarray(x.values).reshape(-1, len(NAMES))
                more = sums(differences(expanded((own - mean) / spread), np.asarray(y.values)), w)
                n, gradient, curve = n + more[0], gradient + more[1], curve + more[2]
            values = np.concatenate([gradient, curve.ravel()])
            return pa.table({"n": [n], "sums": pa.array([values], pa.list_(pa.float64()))})

        found = map_arrow(blocks, run, "n long, sums array<double>", RUN_BYTES).toArrow().combine_chunks()
        both = np.sum([np.asarray(x.values) for x in found["sums"].combine_chunks()], axis=0)
        return sum(found["n"].to_pylist()), both[:k], both[k:].reshape(k, k)

    model = RankModel(mean, spread, newton(total, k), 0.0, 1.0)
    model.cut = _quantile(table.select(_raw(model).alias("raw")), seen["bad"], seen["n"])
    return model


def _blocks(table: DataFrame, good: int, bad: int, seed: int) -> DataFrame:
    """``(x, y)``: measures and labels of a block, row after row, in the order of a hash.

    A row of the commoner label is in one block, one of the scarcer label in as many as it takes for every block to have some.
    """
    n = -(-(good + bad) // BLOCK_ROWS)
    copies = min(n, max(1, -(-LEAST_SCARCE * n // min(good, bad))))
    scarce = F.col("_label") == (1 if good < bad else 0)
    hashed = table.filter(F.col("_label").isin(0, 1)).withColumn("_hash", F.xxhash64(F.lit(seed), "_id", *NAMES))
    turn = F.explode(F.sequence(F.lit(0), F.when(scarce, F.lit(copies - 1)).otherwise(F.lit(0))))
    dealt = hashed.withColumn("_turn", turn).withColumn("_block", F.pmod(F.col("_hash") + F.col("_turn"), F.lit(n)))
    row = F.struct(F.xxhash64("_hash").alias("at"), F.col("_label").alias("y"), F.array(*NAMES).alias("x"))
    held = dealt.groupBy("_block").agg(F.sort_array(F.collect_list(row)).alias("_rows"))
    return held.select(F.flatten("_rows.x").alias("x"), F.col("_rows.y").alias("y"))


def _quantile(scores: DataFrame, bad: int, n: int) -> float:
    """The score that the share ``bad / n`` of the labelled rows lies below, between the two nearest ones."""
    share = bad / n
    low = scores.agg(F.percentile_approx("raw", share, RANK_ACCURACY)).first()[0]
    upto, above = scores.agg(F.count_if(F.col("raw") <= low), F.min(F.when(F.col("raw") > low, F.col("raw")))).first()
    return low if above is None or upto > bad else low + (1 - share) * (above - low)


def _raw(model: RankModel) -> Column:
    """The raw score from the columns in ``NAMES``."""
    k = len(NAMES)
    raw = F.lit(0.0)
    for i, name in enumerate(NAMES):
        z = (F.col(name) - F.lit(float(model.mean[i]))) / F.lit(float(model.spread[i]))
        z = F.greatest(F.least(z, F.lit(4.0)), F.lit(-4.0))
        raw = raw + z * F.lit(float(model.weights[i])) + z * z * F.lit(float(model.weights[k + i]))
    return raw


def score(docs: DataFrame, model: RankModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, raw, score, kept)`` per row, whole texts; ``kept`` if the score reaches the model's quantile.

    ``score`` is the logistic of the raw score, moved so that the quantile gets ``CUT``. A NULL text is scored as the
    empty text. NULL ids and rows that repeat keep their rows; extra columns are not read.
    """
    rows = measured(docs, F.col(text), [F.col(doc_id).alias("id")])
    scored = rows.select("id", _raw(model).alias("raw"))
    moved = (F.col("raw") - model.cut) * model.scale + float(np.log(CUT / (1 - CUT)))
    bounded = F.greatest(F.least(moved, F.lit(40.0)), F.lit(-40.0))
    return scored.select("id", "raw", (1 / (1 + F.exp(-bounded))).alias("score"), (F.col("raw") >= model.cut).alias("kept"))
