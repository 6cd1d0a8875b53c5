"""Toxicity by a classifier chain of linear models.

Categories are predicted one after another; each model is a logistic regression on the words of the text and on the
earlier categories' probabilities (as log odds). For training these earlier probabilities come out of fold: a row's
come from models that didn't see it, so later models meet in training what they meet in use.

The models are fitted on a bounded sample of labelled rows (about ``SAMPLE`` rows, drawn by a hash of the id over all
labelled rows); every document is predicted, whole. The verdict's threshold is the one with the best F1 over
the out-of-fold probabilities of the last category.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import as_bytes

SAMPLE = 6000
FOLDS = 3
MIN_TIE = 15.0  # chi-square that a word and a category need
MIN_DOCS = 3  # sampled documents that a word must be in
ROUNDS = 60
PENALTY = 0.1
LOWEST = 0.2  # of the verdict's threshold: few labels give no better one
BUCKETS = 1_000_000_007
#: Categories in the order of the chain: SQL over the labels' columns. The last one is the verdict.
CATEGORIES: Mapping[str, str] = {"low_quality": "quality = 0", "toxic": "toxic = 1"}

# ASCII letters to lower case; other ASCII bytes set words apart; bytes of other characters stay
_FOLD = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: bytes) -> set[bytes]:
    return set(text.translate(_FOLD).split())


class _Rows:
    """A sparse 0/1 matrix: for each row its columns."""

    def __init__(self, rows: list[np.ndarray], width: int) -> None:
        self.n, self.width = len(rows), width
        self.row = np.repeat(np.arange(self.n), [len(r) for r in rows])
        self.col = np.concatenate(rows) if rows else np.zeros(0, np.int64)

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.col], self.n)

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, r[self.row], self.width)

    def ties(self, y: np.ndarray) -> np.ndarray:
        """Chi-square of each column and the category, with the correction for small counts."""
        a, has, n, yes = self.back(y), self.back(np.ones(self.n)), self.n, y.sum()
        off = np.maximum(np.abs(a * (n - has - yes + a) - (has - a) * (yes - a)) - n / 2, 0)
        return n * off * off / np.maximum(has * (n - has) * yes * (n - yes), 1e-9)

    def columns(self, which: np.ndarray) -> _Rows:
        out = object.__new__(_Rows)
        place = np.full(self.width, -1)
        place[which] = np.arange(len(which))
        at = place[self.col] >= 0
        out.n, out.width, out.row, out.col = self.n, len(which), self.row[at], place[self.col[at]]
        return out

    def only(self, keep: np.ndarray) -> _Rows:
        out = object.__new__(_Rows)
        place = np.cumsum(keep) - 1
        at = keep[self.row]
        out.n, out.width, out.row, out.col = int(keep.sum()), self.width, place[self.row[at]], self.col[at]
        return out


def _odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def fit(x: _Rows, extra: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, penalty: float = PENALTY
        ) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights of words and of extra columns, and the intercept: logistic loss with an L2 penalty, by
    limited-memory quasi-Newton steps. Words that these rows don't tie to the category have no weight."""
    tied = np.flatnonzero(x.ties(y) >= MIN_TIE)
    weights = np.zeros(x.width)
    x = x.columns(tied)
    n_words, n_extra = x.width, extra.shape[1]
    cost = np.full(n_words + n_extra + 1, penalty)
    cost[-1] = 1e-6

    def loss(v: np.ndarray) -> tuple[float, np.ndarray]:
        z = x.times(v[:n_words]) + extra @ v[n_words:-1] + v[-1]
        r = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        value = float(np.sum(np.logaddexp(0, z) - y * z) + 0.5 * np.sum(cost * v * v))
        return value, np.concatenate([x.back(r), extra.T @ r, [r.sum()]]) + cost * v

    v = np.zeros(len(cost))
    v[-1] = float(_odds(np.array([y.mean()]))[0]) if len(y) else 0.0
    value, g = loss(v)
    past: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(rounds):
        if np.abs(g).max() < 1e-3:
            break
        d, used = g.copy(), []
        for s, t, rho in reversed(past):
            a = rho * (s @ d)
            used.append(a)
            d -= a * t
        d *= (past[-1][0] @ past[-1][1]) / (past[-1][1] @ past[-1][1]) if past else 1 / max(1.0, np.abs(g).sum())
        for (s, t, rho), a in zip(past, reversed(used)):
            d += (a - rho * (t @ d)) * s
        step, slope = 1.0, g @ d
        while step > 1e-8:
            new = v - step * d
            new_value, new_g = loss(new)
            if new_value <= value - 1e-4 * step * slope:
                break
            step /= 2
        else:
            break
        s, t = new - v, new_g - g
        if s @ t > 1e-12:
            past = [*past[-9:], (s, t, 1 / (s @ t))]
        v, value, g = new, new_value, new_g
    weights[tied] = v[:n_words]
    return weights, v[n_words:-1], float(v[-1])


def _predict(x: _Rows, extra: np.ndarray, model: tuple[np.ndarray, np.ndarray, float]) -> np.ndarray:
    w, e, b = model
    return 1 / (1 + np.exp(-np.clip(x.times(w) + extra @ e + b, -30, 30)))


class Chain:
    """Fitted models, in order."""

    def __init__(self, texts: list[bytes], labels: np.ndarray, folds: np.ndarray, rounds: int = ROUNDS) -> None:
        number: dict[bytes, int] = {}
        bags = [np.array([number.setdefault(w, len(number)) for w in sorted(words(t))], np.int32) for t in texts]
        seen = np.bincount(np.concatenate(bags), minlength=len(number)) if bags else np.zeros(0, np.int64)
        column = np.where(seen >= MIN_DOCS, np.cumsum(seen >= MIN_DOCS) - 1, -1)
        place = {w: int(column[k]) for w, k in number.items() if column[k] >= 0}
        x = _Rows([c[c >= 0] for c in (column[bag] for bag in bags)], len(place))
        n, n_categories = labels.shape
        extra = np.zeros((n, 0))
        self.models, self.out_of_fold = [], np.zeros((n, n_categories))
        for k in range(n_categories):
            y, oof = labels[:, k].astype(float), np.zeros(n)
            for f in range(FOLDS):
                seen_rows = folds != f
                if seen_rows.all():
                    continue
                if seen_rows.any():
                    m = fit(x.only(seen_rows), extra[seen_rows], y[seen_rows], rounds)
                    oof[~seen_rows] = _predict(x.only(~seen_rows), extra[~seen_rows], m)
                else:
                    oof[~seen_rows] = y.mean()
            self.models.append(fit(x, extra, y, rounds))
            self.out_of_fold[:, k] = oof
            extra = np.column_stack([extra, _odds(oof)])
        self.threshold = self._best(self.out_of_fold[:, -1], labels[:, -1]) if n else 0.5
        self.weights = {w: c for w, k in place.items() if any(c := tuple(float(m[0][k]) for m in self.models))}
        self.extra = [tuple(map(float, m[1])) for m in self.models]
        self.base = [float(m[2]) for m in self.models]
        del self.models

    @staticmethod
    def _best(p: np.ndarray, y: np.ndarray) -> float:
        """Between the two scores around the cut with the best F1, from LOWEST to 0.5; 0.5 without both classes."""
        if not y.any() or y.all():
            return 0.5
        order = np.argsort(-p, kind="stable")
        hits = np.cumsum(y[order])
        f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
        k = int(np.argmax(f1))
        low = p[order[k + 1]] if k + 1 < len(y) else 0.0
        return min(0.5, max(LOWEST, float((p[order[k]] + low) / 2)))

    def predict(self, text: bytes) -> list[float]:
        known = self.weights
        got = [known[w] for w in words(text) if w in known]
        sums = [math.fsum(c) for c in zip(*got)] if got else [0.0] * len(self.base)
        out: list[float] = []
        for k, s in enumerate(sums):
            z = s + self.base[k] + sum(e * float(_odds(np.float64(p))) for e, p in zip(self.extra[k], out))
            out.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
        return out


def learn(docs: DataFrame, labels: DataFrame, categories: Mapping[str, str] = CATEGORIES, sample: int = SAMPLE) -> Chain:
    wanted = [F.expr(c).cast("int").alias(f"c{k}") for k, c in enumerate(categories.values())]
    y = labels.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), *wanted).dropna()
    y = y.groupBy("doc_id").agg(*[F.max(f"c{k}").alias(f"c{k}") for k in range(len(categories))])
    n = y.count()
    place = F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS))
    chosen = y.withColumn("place", place).where(F.col("place") < F.lit(min(1.0, sample / max(n, 1)) * BUCKETS))
    # the sample is bounded by its parameter, so it goes to every task; of rows that share a doc_id one is learned from
    one = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), as_bytes("text").alias("text"))
           .join(F.broadcast(chosen.select("doc_id")), "doc_id")
           .groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t")).select("doc_id", "t.text"))

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [b" ".join(sorted(words(t))) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.binary())], ["doc_id", "words"])

    # the driver gets each sampled document's distinct words, not its text
    rows = one.mapInArrow(bags, "doc_id long, words binary").join(F.broadcast(chosen), "doc_id").collect()
    rows = sorted(rows, key=lambda r: (r["place"], r["doc_id"]))
    y = np.array([[r[f"c{k}"] for k in range(len(categories))] for r in rows], np.int64).reshape(-1, len(categories))
    folds = np.array([r["place"] % FOLDS for r in rows], np.int64)
    return Chain([bytes(r["words"]) for r in rows], y, folds)


def toxicity(docs: DataFrame, labels: DataFrame, categories: Mapping[str, str] = CATEGORIES, sample: int = SAMPLE
             ) -> DataFrame:
    """doc_id, p_<category> for each category (0 to 1), and the last category's name: boolean, per row of docs.

    docs: doc_id, text; labels: doc_id and the columns that ``categories`` read; other columns are ignored. A
    null text counts as empty. Labels that are null or without doc_id are not learned from; a doc_id labelled twice
    counts as its strictest labels; of rows that share a labelled doc_id one is learned from. Very long texts are read
    whole; of a sampled one the driver gets its distinct words. Without labels every probability is 0.5 at most and nothing is flagged. Repeated
    rows give a row each; a null doc_id stays null; an empty table gives no rows.
    """
    names = list(categories)
    chain = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, categories, sample))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = chain.value
        for b in batches:
            p = np.array([c.predict(t) for t in b.column(1).to_pylist()]).reshape(-1, len(names))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(p[:, k]) for k in range(len(names))], pa.array(p[:, -1] > c.threshold)],
                ["doc_id", *[f"p_{x}" for x in names], names[-1]])

    kinds = ["doc_id long", *[f"p_{x} double" for x in names], f"{names[-1]} boolean"]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), as_bytes("text").alias("text")).mapInArrow(
        rows, ", ".join(kinds))
