"""Language identification by nearest centroid.

A text becomes a TF-IDF vector of hashed letter n-grams (one to three letters of
the lower-cased text, everything else one space), scaled to length one. Each
language has several centroids, clustered from a bounded sample of labelled texts
(``rows_per_language`` of each, those of the smallest hash). A text takes the
language of the centroid with the largest cosine. It is rejected if it has no
letter or if that cosine is below the language's floor for texts of its size. The
size is the number of different n-grams, on which the cosine depends far more than
on the length: a text that says one word a hundred times is a short one.

Floors are learned from texts kept back: half of a language's sample is judged by
centroids of the other half, whole and cut to 4, 8, 16 ... letters, and at each size
the floor is a share of a low quantile of those cosines. A language of fewer than
``LEAST_TEXTS`` sampled texts, of which none can be kept back, has one floor for all
sizes, a share of the smallest cosine of its sample.

Defined results: null texts and texts without a letter are ``und`` with score 0
and rejected; languages come from non-null labels of texts with letters; ties go
to the first language by name; whole texts are read, long ones in blocks; if
nothing can be learned all texts are ``und`` and rejected; an empty table gives no
rows. Other columns stay, but for those of a result's name, whose place the result
takes. ``keep_identified`` learns from its own table and needs its ``lang``; for a table
without it, use ``identify`` with a model.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlens.llm.common import give_back_memory, others, small_batches, table

DIMENSIONS = 1 << 13
CENTROIDS = 3
#: Letters of the cut texts that floors are learned from, texts of a language and
#: texts of a size below which there is no floor of their own.
CUTS = [1 << k for k in range(2, 12)]
LEAST_TEXTS, LEAST_OF_SIZE = 10, 10
_BLOCK = 1 << 20
#: Parts of a language that are ranked apart before they are ranked together.
_PARTS = 16
_NOT_LETTERS = re.compile(r"[\W\d_]+")
_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)


@dataclass
class LanguageModel:
    languages: list[str]
    weights: np.ndarray  # inverse document frequency by dimension
    centroids: np.ndarray  # (centroids, dimensions), length one
    owner: np.ndarray  # language of each centroid
    floors: list[tuple[np.ndarray, np.ndarray]]  # by language: sizes, smallest cosines accepted

    def floor(self, language: int, counts: np.ndarray) -> float:
        """The smallest cosine at which a text of these counts is of the language."""
        return float(np.interp(_size(counts), *self.floors[language]))


def _size(counts: np.ndarray) -> np.ndarray:
    """Binary logarithm of the number of different n-grams."""
    return np.log2(np.maximum((counts > 0).sum(axis=-1), 1))


def _cut(text: str) -> list[str]:
    """The beginnings of a text that are shorter than it."""
    letters = _NOT_LETTERS.sub(" ", text.lower()).strip()
    return [letters[:n] for n in CUTS if n < len(letters)]


def ngram_counts(text: str | None) -> np.ndarray | None:
    """Counts of hashed n-grams, or None where there is no letter."""
    letters = _NOT_LETTERS.sub(" ", (text or "").lower())
    if not letters.strip():
        return None
    codes = np.frombuffer(f" {letters.strip()} ".encode("utf-32-le"), dtype=np.uint32)
    counts = np.zeros(DIMENSIONS, dtype=np.int64)
    for start in range(0, len(codes), _BLOCK):
        block = codes[start : start + _BLOCK + 2]
        hashed = np.zeros(len(block), dtype=np.uint32)
        for n in range(3):
            part = block[n:] * _MULTIPLIERS[n]
            hashed = (hashed[: len(part)] ^ part) * np.uint32(0x01000193)
            own = hashed[: min(_BLOCK, len(hashed))] >> np.uint32(19)
            counts += np.bincount(own, minlength=DIMENSIONS)
    return counts


def _vectors(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    vectors = np.log1p(counts).astype(np.float32) * weights
    lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(lengths > 0, lengths, 1)


def _cluster(vectors: np.ndarray, rounds: int = 8) -> np.ndarray:
    """Spherical k-means, begun with the vectors farthest from those chosen."""
    chosen = [vectors.mean(axis=0)]
    for _ in range(min(CENTROIDS, len(vectors)) - 1):
        nearest = (vectors @ np.array(chosen).T).max(axis=1)
        chosen.append(vectors[int(nearest.argmin())])
    centres = np.array(chosen)
    for _ in range(rounds):
        own = (vectors @ centres.T).argmax(axis=1)
        sums = np.array([vectors[own == k].sum(axis=0) if (own == k).any() else centres[k] for k in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centres


def _floors(sizes: np.ndarray, cosines: np.ndarray, quantile: float, share: float) -> tuple[np.ndarray, np.ndarray]:
    """Floors at the mean sizes of texts kept back, by doublings of the size."""
    bins = np.floor(sizes)
    bins = [bins == b for b in np.unique(bins) if (bins == b).sum() >= LEAST_OF_SIZE] or [bins == bins]
    at = np.array([sizes[b].mean() for b in bins])
    return at, share * np.array([np.quantile(cosines[b], quantile) for b in bins])


def fit(
    labelled: DataFrame,
    *,
    rows_per_language: int = 400,
    floor_share: float = 0.3,
    quantile: float = 0.02,
    quantile_share: float = 0.65,
) -> LanguageModel:
    """Learns from rows (key, text, lang). ``key`` only decides which are taken; at
    most ``rows_per_language`` rows of a language reach the driver, as counts of the
    text and of its beginnings. Floors are ``quantile_share`` of the ``quantile`` of
    cosines kept back, or ``floor_share`` of the smallest of a small sample."""
    rows = small_batches(labelled).filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rows = rows.withColumn("hash", F.xxhash64("key", "text"))
    # Languages and hashes alone are shuffled; the few taken are broadcast to the texts. A
    # language may hold most rows: the smallest hashes of each of its parts come first.
    taken = rows.select("lang", "hash", F.pmod("hash", F.lit(_PARTS)).alias("part"))
    for keys in (["lang", "part"], ["lang"]):
        order = Window.partitionBy(*keys).orderBy("hash")
        taken = taken.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= rows_per_language).drop("nth")
    taken = taken.select("lang", "hash").distinct()
    rows = rows.join(F.broadcast(taken), ["lang", "hash"]).dropDuplicates(["lang", "hash"])

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                whole = ngram_counts(text)
                if whole is not None:
                    of = zlib.crc32(whole.tobytes())
                    pieces = [whole, *(c for c in map(ngram_counts, _cut(text)) if c is not None)]
                    found += [(lang, of, k == 0, *packed(c)) for k, c in enumerate(pieces)]
            yield pd.DataFrame(found, columns=["lang", "of", "whole", "at", "n"])
        give_back_memory()

    def packed(c: np.ndarray) -> tuple[bytes, bytes]:
        return np.flatnonzero(c).astype("<u2").tobytes(), c[c > 0].astype("<u4").tobytes()

    def unpacked(rows: list) -> np.ndarray:
        counts = np.zeros((len(rows), DIMENSIONS), dtype=np.float32)
        for k, row in enumerate(rows):
            counts[k, np.frombuffer(row["at"], "<u2")] = np.frombuffer(row["n"], "<u4")
        return counts

    schema = "lang string, of long, whole boolean, at binary, n binary"
    sample = rows.select("lang", "text").mapInPandas(counted, schema).collect()
    sample.sort(key=lambda row: (row["lang"], row["of"], bytes(row["at"]), bytes(row["n"])))
    beginnings = [row for row in sample if not row["whole"]]
    sample = [row for row in sample if row["whole"]]
    counts = unpacked(sample)
    weights = np.log((1 + len(sample)) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + 1
    vectors = _vectors(counts, weights)
    langs = np.array([row["lang"] for row in sample])
    languages = sorted(set(langs.tolist()))
    centroids, owner, floors = [], [], []
    for k, language in enumerate(languages):
        own = vectors[langs == language]
        centres = _cluster(own)
        centroids.append(centres)
        owner += [k] * len(centres)
        # Copies of a text are on one side.
        side = np.array([row["of"] % 2 for row in sample if row["lang"] == language])
        if len(own) < LEAST_TEXTS or side.min() == side.max():
            floors.append((np.zeros(1), np.array([floor_share * float((own @ centres.T).max(axis=1).min())])))
            continue
        sizes, cosines = [_size(counts[langs == language])], np.zeros(len(own))
        judged = [cosines]
        for part in (0, 1):
            others = _cluster(own[side != part]).T
            cosines[side == part] = (own[side == part] @ others).max(axis=1)
            cut = [row for row in beginnings if row["lang"] == language and row["of"] % 2 == part]
            for start in range(0, len(cut), 512):
                block = unpacked(cut[start : start + 512])
                sizes.append(_size(block))
                judged.append((_vectors(block, weights) @ others).max(axis=1))
        floors.append(_floors(np.concatenate(sizes), np.concatenate(judged), quantile, quantile_share))
    stacked = np.concatenate(centroids) if centroids else np.zeros((0, DIMENSIONS))
    return LanguageModel(languages, weights, stacked.astype(np.float32), np.array(owner), floors)


def identify(documents: DataFrame, model: LanguageModel, *, text: str = "text") -> DataFrame:
    """``documents`` with ``lang_pred``, ``score`` (the cosine, 0 to 1) and ``rejected``."""

    def nearest(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for start in range(0, len(texts), 64):
            counts = [ngram_counts(t) for t in texts.iloc[start : start + 64]]
            known = [k for k, c in enumerate(counts) if c is not None and model.languages]
            block = [("und", 0.0, True)] * len(counts)
            if known:
                cosines = _vectors(np.array([counts[k] for k in known]), model.weights) @ model.centroids.T
                best = cosines.argmax(axis=1)
                for k, centre, row in zip(known, best.tolist(), cosines, strict=True):
                    own, score = int(model.owner[centre]), float(np.clip(row[centre], 0, 1))
                    block[k] = (model.languages[own], score, score < model.floor(own, counts[k]))
            rows += block
        return pd.DataFrame(rows, columns=["lang_pred", "score", "rejected"])

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def identified(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield nearest(texts)
        give_back_memory()

    results = ("lang_pred", "score", "rejected")
    found = small_batches(documents).withColumn("_llm_language", identified(F.col(text)))
    return found.select(*others(documents, *results), *(f"_llm_language.{name}" for name in results))


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether a row is kept back: by the CRC-32 of its id as text (null: empty)."""
    key = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(key.cast("binary")) % parts == part


def fitted(documents: DataFrame) -> LanguageModel:
    """The model learned from the documents that are not held out."""
    learned = documents.filter(~held_out(F.col("doc_id"), 4, 2))
    return fit(learned.select(F.col("doc_id").alias("key"), "text", "lang"))


def keep_identified(documents: DataFrame) -> DataFrame:
    """The documents whose language is recognised, all columns kept."""
    plain = documents.select("text", F.struct(*(F.col(n) for n in documents.columns)).alias("_llm_row"))
    kept = identify(plain, fitted(documents)).filter(~F.col("rejected"))
    return kept.select("_llm_row.*")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those not held out."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = identify(documents.select("doc_id", "text"), fitted(documents))
    kept_back = held_out(F.col("doc_id"), 4, 2).alias("held_out")
    return found.select("doc_id", kept_back, "lang_pred", "score", "rejected")
