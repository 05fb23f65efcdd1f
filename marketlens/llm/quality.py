"""Quality classifier: a factorisation machine over words, structure and metadata.

Inputs of a score are the text's hashed lower-case words (log counts, length one),
statistics of its structure and its ``n_chars``, where the table has it. Every pair
of inputs interacts through low-rank factors. The pairwise sum is taken in linear
time by the identity of sums of squares: the sum over pairs of <v_i, v_j> x_i x_j is half
of (the sum of v_i x_i) squared minus the sum of (v_i x_i) squared.

It is fitted by gradient steps on a bounded sample of labelled rows
(``fit_rows``, those of the smallest hash). Scoring is one pass without a shuffle.

Defined results: null and empty texts have no words and score by their other
inputs; null or missing ``n_chars`` counts as the text's length; labels other than
0 and 1 teach nothing; of several labels of one document the smallest counts; without labels every
score is 0.5; an empty table gives no rows. Other columns stay; a column ``score`` gives
its place to the result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm.common import small_batches, table
from marketlens.llm.language import held_out

WORD_DIMENSIONS = 1 << 12
_CACHED_WORDS = 200_000
_BYTES = np.arange(256)
_CLASSES = {
    "upper": (_BYTES >= 65) & (_BYTES <= 90),
    "lower": (_BYTES >= 97) & (_BYTES <= 122),
    "digit": (_BYTES >= 48) & (_BYTES <= 57),
    "space": (_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13)),
    "stops": np.isin(_BYTES, [33, 44, 46, 63]),
    "other": (_BYTES >= 128),
    "symbol": np.isin(_BYTES, [c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in "!,.?"]),
}
_CLASS_MATRIX = np.array(list(_CLASSES.values()), dtype=np.float64).T


class Features:
    """Turns texts into inputs. Keeps the buckets of words it has seen."""

    def __init__(self) -> None:
        self._buckets: dict[bytes, bytes] = {}

    def words(self, text: str) -> np.ndarray:
        words = text.lower().encode().split()
        if len(self._buckets) > _CACHED_WORDS:
            self._buckets.clear()
        known = self._buckets
        for word in set(words):
            if word not in known:
                known[word] = (zlib.crc32(word) % WORD_DIMENSIONS).to_bytes(2, "little")
        at = np.frombuffer(b"".join([known[word] for word in words]), dtype=np.uint16)
        return np.bincount(at, minlength=WORD_DIMENSIONS)

    @staticmethod
    def structure(text: str, n_chars: float) -> list[float]:
        raw = text.encode()
        words, lines = raw.split(), raw.split(b"\n")
        shares = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256) @ _CLASS_MATRIX / max(len(raw), 1)
        distinct = len(set(words))
        ends = sum(word[-1:] in b".!?" for word in words) if words else 0
        return [
            *shares.tolist(),
            np.log1p(len(words)),
            np.log1p(n_chars),
            abs(n_chars - len(text)) / (len(text) + 1),
            sum(map(len, words)) / max(len(words), 1),
            distinct / max(len(words), 1),
            np.log1p(len(words) / max(distinct, 1)),
            np.log1p(len(lines)),
            len(set(lines)) / len(lines),
            ends / max(len(words), 1),
            float(not words),
        ]

    def inputs(self, texts: list[str], n_chars: list[float]) -> tuple[np.ndarray, np.ndarray]:
        counts = np.array([self.words(text) for text in texts])
        vectors = np.log1p(counts).astype(np.float32)
        vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
        stats = [self.structure(t, n) for t, n in zip(texts, n_chars, strict=True)]
        return vectors, np.array(stats, dtype=np.float32)


@dataclass
class FactorisationMachine:
    bias: float
    linear: np.ndarray  # (inputs,)
    factors: np.ndarray  # (inputs, rank)
    mean: np.ndarray  # of the statistics
    spread: np.ndarray

    def joined(self, words: np.ndarray, stats: np.ndarray) -> np.ndarray:
        scaled = np.clip((stats - self.mean) / self.spread, -4, 4) / 4
        return np.concatenate([words, scaled.astype(np.float32)], axis=1)

    def margins(self, inputs: np.ndarray) -> np.ndarray:
        sums = inputs @ self.factors
        squares = (inputs * inputs) @ (self.factors * self.factors)
        return self.bias + inputs @ self.linear + 0.5 * (sums * sums - squares).sum(axis=1)


def _train(words, stats, labels, *, rank: int, epochs: int, rate: float, decay: float) -> FactorisationMachine:
    """Adam on the logistic loss in small batches; the order is fixed by a seed."""
    rng = np.random.default_rng(7)
    size = WORD_DIMENSIONS + stats.shape[1]
    spread = np.where(stats.std(axis=0) > 1e-6, stats.std(axis=0), 1)
    model = FactorisationMachine(
        0.0,
        np.zeros(size, dtype=np.float32),
        rng.normal(scale=0.05, size=(size, rank)).astype(np.float32),
        stats.mean(axis=0),
        spread,
    )
    state = [np.zeros(s, dtype=np.float32) for s in ((), (), size, size, (size, rank), (size, rank))]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for start in range(0, len(order), 128):
            rows = order[start : start + 128]
            inputs = model.joined(words(rows), stats[rows])
            wrong = (1 / (1 + np.exp(-model.margins(inputs))) - labels[rows]) / len(rows)
            sums = inputs @ model.factors
            pull = (inputs * inputs).T @ wrong
            slopes = (
                wrong.sum(),
                inputs.T @ wrong + decay * model.linear,
                inputs.T @ (wrong[:, None] * sums) - pull[:, None] * model.factors + decay * model.factors,
            )
            step += 1
            values = [model.bias, model.linear, model.factors]
            for k, slope in enumerate(slopes):
                state[2 * k] = 0.9 * state[2 * k] + 0.1 * slope
                state[2 * k + 1] = 0.999 * state[2 * k + 1] + 0.001 * slope * slope
                first, second = state[2 * k] / (1 - 0.9**step), state[2 * k + 1] / (1 - 0.999**step)
                values[k] = values[k] - rate * first / (np.sqrt(second) + 1e-8)
            model.bias, model.linear, model.factors = values
    return model


def _lengths(table: pd.DataFrame) -> list[float]:
    own = table["text"].str.len()
    return pd.to_numeric(table["n_chars"]).clip(lower=0).fillna(own).astype(float).tolist()


def _texts(documents: DataFrame, text: str) -> list:
    known = "n_chars" in documents.columns
    n_chars = F.col("n_chars").cast("double") if known else F.lit(None).cast("double")
    return [F.coalesce(F.col(text), F.lit("")).alias("text"), n_chars.alias("n_chars")]


def fit(labelled: DataFrame, *, fit_rows: int = 6000, rank: int = 8) -> FactorisationMachine | None:
    """Learns from at most ``fit_rows`` rows (text, n_chars, label), the first of the
    sample given; their inputs, not their texts, reach the driver."""

    def inputs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features = Features()
        for batch in batches:
            words, stats = features.inputs(batch["text"].tolist(), _lengths(batch))
            at = [np.flatnonzero(row) for row in words]
            yield pd.DataFrame(
                {"at": at, "x": [row[k] for row, k in zip(words, at, strict=True)], "stats": list(stats), "label": batch["label"]}
            )

    schema = "at array<int>, x array<float>, stats array<float>, label int"
    rows = small_batches(labelled).limit(fit_rows).mapInPandas(inputs, schema).toPandas()
    if rows["label"].nunique() < 2:
        return None
    rows["order"] = [zlib.crc32(np.asarray(s).tobytes()) for s in rows["stats"]]
    rows = rows.sort_values(["order", "label"], ignore_index=True)
    at, x = rows["at"].tolist(), rows["x"].tolist()

    def words(chosen: np.ndarray) -> np.ndarray:
        dense = np.zeros((len(chosen), WORD_DIMENSIONS), dtype=np.float32)
        for k, row in enumerate(chosen):
            dense[k, at[row]] = x[row]
        return dense

    stats, labels = np.array(rows["stats"].tolist(), dtype=np.float32), rows["label"].to_numpy(dtype=np.float32)
    return _train(words, stats, labels, rank=rank, epochs=10, rate=0.02, decay=1e-5)


def sample_labelled(documents: DataFrame, labels: DataFrame, *, fit_rows: int = 6000) -> DataFrame:
    """Rows (text, n_chars, label) of the ``fit_rows`` labelled documents of smallest
    hash that are not held out. The labels taken are few and bounded, so they are
    broadcast to the documents."""
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.filter(~held_out(F.col("doc_id"), 3, 1)).groupBy("doc_id").agg(F.min("quality").alias("label"))
    taken = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    chosen = documents.join(F.broadcast(taken), "doc_id")
    return chosen.select(*_texts(chosen, "text"), F.col("label").cast("int"))


def scored(documents: DataFrame, model: FactorisationMachine | None, *, text: str = "text") -> DataFrame:
    """``documents`` with ``score``, the probability of label 1."""

    def probabilities(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        features = Features()
        for texts, n_chars in batches:
            scores = np.full(len(texts), 0.5)
            for start in range(0, len(texts) if model else 0, 256):
                rows = slice(start, start + 256)
                part = pd.DataFrame({"text": texts.iloc[rows], "n_chars": n_chars.iloc[rows]})
                joined = model.joined(*features.inputs(part["text"].tolist(), _lengths(part)))
                scores[rows] = 1 / (1 + np.exp(-np.clip(model.margins(joined), -30, 30).astype(np.float64)))
            yield pd.Series(scores)

    probabilities.__annotations__ = {
        "batches": Iterator[tuple[pd.Series, pd.Series]],
        "return": Iterator[pd.Series],
    }
    return small_batches(documents).withColumn("score", F.pandas_udf(probabilities, "double")(*_texts(documents, text)))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from labelled ones that are not held out."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    model = fit(sample_labelled(documents, table(spark, sf_dir, "labels")))
    found = scored(documents, model)
    kept_back = held_out(F.col("doc_id"), 3, 1).alias("held_out")
    return found.select("doc_id", kept_back, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
