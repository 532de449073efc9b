"""Quality classifier: a generalised additive model with pairwise interactions.

Features of the whole text are cut into quantile bins. Boosting goes round the
features in turn, each time fitting a shallow tree (two splits deep) on one
feature's bins to the log-loss gradient; the trees of a feature add up to one
lookup table. Then the pairs of features that explain most of what is left get
tables of their own, built from two-cut trees. A score is the logistic of a sum
of table entries: one bin lookup and one addition per table, vectorised over a
batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.llm.common import table

#: At most so many labelled rows, those of the smallest hashes, are learnt from.
TRAIN_ROWS = 20_000
THRESHOLD = 0.3
BINS, PAIR_BINS, PAIRS = 48, 8, 6
ROUNDS, PAIR_ROUNDS, RATE = 120, 60, 0.15
SMOOTH, LEAST_ROWS = 1.0, 4

NAMES = (
    "log_chars upper digit exclamation currency_signs bar period comma other_sign space line_break beyond_ascii "
    "word_length word_spread short_words distinct_words longest_word distinct_lines line_length"
).split()


def _byte_classes() -> np.ndarray:
    """256 x 11: which class each byte counts for."""
    groups = [range(65, 91), range(48, 58), b"!", b"$%&#*", b"|", b".", b",", b"/:;@<>=+_~^()[]{}\"'?-\\`", b" \t", b"\n\r", range(128, 256)]
    classes = np.zeros((256, len(groups)))
    for column, group in enumerate(groups):
        classes[list(group), column] = 1
    return classes


_CLASSES = _byte_classes()


def features(texts: list[str]) -> np.ndarray:
    """One row of ``NAMES`` per text."""
    out = np.zeros((len(texts), len(NAMES)))
    for row, text in zip(out, texts, strict=True):
        if not text:
            continue
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        row[0] = np.log1p(len(text))
        row[1:12] = np.bincount(raw, minlength=256) @ _CLASSES / len(raw)
        words, lines = text.split(), text.split("\n")
        if words:
            lengths = np.fromiter(map(len, words), np.int64, len(words))
            row[12:17] = lengths.mean(), lengths.std(), (lengths <= 3).mean(), len(set(words)) / len(words), lengths.max()
        row[17:] = len(set(lines)) / len(lines), len(text) / len(lines)
    return out


@dataclass
class Model:
    base: float = 0.0
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_cuts: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def raw(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for j, (cuts, values) in enumerate(zip(self.cuts, self.tables, strict=True)):
            total += values[np.searchsorted(cuts, x[:, j], "right")]
        for (a, b), values in zip(self.pairs, self.pair_tables, strict=True):
            total += values[np.searchsorted(self.pair_cuts[a], x[:, a], "right"), np.searchsorted(self.pair_cuts[b], x[:, b], "right")]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def _quantile_cuts(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _gain(g, h):
    return g * g / (h + SMOOTH)


def _tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, depth: int = 2) -> np.ndarray:
    """Leaf values per bin of a tree on one feature's bins."""
    value = np.full(len(g), -g.sum() / (h.sum() + SMOOTH))
    if depth == 0 or len(g) < 2:
        return value
    lg, lh, ln = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(n)[:-1]
    gains = _gain(lg, lh) + _gain(g.sum() - lg, h.sum() - lh) - _gain(g.sum(), h.sum())
    gains[(ln < LEAST_ROWS) | (n.sum() - ln < LEAST_ROWS)] = -1
    at = int(gains.argmax()) + 1
    if gains[at - 1] <= 1e-9:
        return value
    return np.concatenate([_tree(g[:at], h[:at], n[:at], depth - 1), _tree(g[at:], h[at:], n[at:], depth - 1)])


def _quadrants(a: np.ndarray) -> list[np.ndarray]:
    """Sums of the four quadrants at each cut (i, j)."""
    c = a.cumsum(0).cumsum(1)
    low, row, col = c[:-1, :-1], c[:-1, -1:], c[-1:, :-1]
    return [low, row - low, col - low, c[-1, -1] - row - col + low]


def _pair_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and leaf values of the best pair of cuts."""
    gs, hs, ns = _quadrants(g), _quadrants(h), _quadrants(n)
    if not gs[0].size:
        return 0.0, np.zeros_like(g)
    gain = sum(_gain(a, b) for a, b in zip(gs, hs, strict=True))
    leaves = [np.where(c >= LEAST_ROWS, -a / (b + SMOOTH), 0.0) for a, b, c in zip(gs, hs, ns, strict=True)]
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    out = np.empty_like(g)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = (v[i, j] for v in leaves)
    return float(gain[i, j]), out


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """The model for features ``x`` and labels ``y`` (0 or 1). With one class only, or no rows, a constant."""
    share = (y.sum() + 1) / (len(y) + 2)
    model = Model(base=float(np.log(share / (1 - share))))
    if len(np.unique(y)) < 2:
        return model
    wide = range(x.shape[1])
    model.cuts = [_quantile_cuts(x[:, j], BINS) for j in wide]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    bins = [np.searchsorted(c, x[:, j], "right") for j, c in enumerate(model.cuts)]
    counts = [np.bincount(b, minlength=len(t)) for b, t in zip(bins, model.tables, strict=True)]
    total = np.full(len(y), model.base)

    def slope() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return p - y, p * (1 - p)

    for _ in range(ROUNDS):
        for j in wide:
            g, h = slope()
            size = len(model.tables[j])
            step = RATE * _tree(np.bincount(bins[j], g, size), np.bincount(bins[j], h, size), counts[j])
            model.tables[j] += step
            total += step[bins[j]]
    model.pair_cuts = [_quantile_cuts(x[:, j], PAIR_BINS) for j in wide]
    rough = [np.searchsorted(c, x[:, j], "right") for j, c in enumerate(model.pair_cuts)]
    high = [len(c) + 1 for c in model.pair_cuts]

    def sums(a: int, b: int, weights: np.ndarray) -> np.ndarray:
        return np.bincount(rough[a] * high[b] + rough[b], weights, high[a] * high[b]).reshape(high[a], high[b])

    g, h = slope()
    one = np.ones(len(y))
    gains = sorted(((_pair_tree(sums(a, b, g), sums(a, b, h), sums(a, b, one))[0], a, b) for a in wide for b in wide if a < b), reverse=True)
    model.pairs = [(a, b) for gain, a, b in gains[:PAIRS] if gain > 0]
    model.pair_tables = [np.zeros((high[a], high[b])) for a, b in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for k, (a, b) in enumerate(model.pairs):
            g, h = slope()
            step = RATE * _pair_tree(sums(a, b, g), sums(a, b, h), sums(a, b, one))[1]
            model.pair_tables[k] += step
            total += step[rough[a], rough[b]]
    return model


def held_out(id_col: str) -> Column:
    """Every fifth row by the CRC-32 of its id as text (a null id as '')."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", rows: int = TRAIN_ROWS) -> Model:
    """Learns from at most ``rows`` labelled documents that are not held out.

    Labels other than 0 and 1, null labels and labels without a document are
    passed over; of repeated labels of one id the lowest holds, of repeated
    documents of one id the lowest text. Features are computed in tasks; the driver receives ``rows`` x 19 numbers at most.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).where("label in (0, 1)")
    picked = known.where(~held_out("id")).groupBy("id").agg(F.min("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(rows)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    joined = texts.join(F.broadcast(picked), F.col("doc_id") == F.col("id")).select("id", "label", "text")
    # of repeated ids the lowest text is learnt from, so the bound holds whatever repeats
    slim = joined.groupBy("id", "label").agg(F.min("text").alias("text")).select(F.col("id").cast("string").alias("id"), "text", F.col("label").cast("int").alias("label"))
    names = [f"f{i}" for i in range(len(NAMES))]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = pd.DataFrame(features([t or "" for t in batch["text"]]), columns=names)
            out["label"], out["id"] = batch["label"].to_numpy(), batch["id"].to_numpy()
            yield out

    found = slim.mapInPandas(run, ", ".join(f"{c} double" for c in names) + ", label int, id string").toPandas()
    found = found.sort_values(["id", *names]).reset_index(drop=True)
    return fit(found[names].to_numpy(), found["label"].to_numpy(float))


def quality_score(model: Model):
    """A column function: text -> score from 0 to 1. Null counts as empty; every text has a score."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(features([t or "" for t in texts])))

    return score


def classify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted. Only the
    text is scored; equal texts have equal scores; other columns are not read."""
    scored = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), quality_score(model)(F.col(text_col)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, all columns as they were."""
    return docs.where(quality_score(model)(F.col(text_col)) >= threshold)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return classify(docs, train(docs, table(spark, sf_dir, "labels", "doc_id", "quality")))
