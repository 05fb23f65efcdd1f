"""Codes of vectors by product quantisation, assigned by Orchard search.

Components become integers, vectors are cut into parts, and each part position has a
codebook that starts as the parts of the smallest ids and is moved to the means of
what it takes. The nearest entry is found by Orchard search: every entry lists the
others by distance; a search walks the list of the entry it stands on, jumps to a
better one's list as soon as it meets it, marks what it has measured, and ends where
an entry of the list lies beyond twice the current distance, since no entry from there
on can be nearer. All arithmetic is in whole numbers, so the result is exact.

A task gives sums and counts of its own rows, at most one row per component of the
codebooks; only those and the first vectors reach the driver. Both are bounded by the
size of the codebooks.

Defined results: vectors that are null, empty, hold null or non-finite components or
one beyond +-65536 (whose distances a long cannot hold) take no part; neither do
vectors whose length is not that of the first vector taken (by id, then components), nor
lengths the parts do not divide; fewer vectors than entries give a smaller codebook;
rows of equal or null id are rows like others (null ids come last); rows of a null
label share one sum; an empty table gives no rows. Other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm.common import give_back_memory, staged, table

_SCALE = 256
#: Components up to here: squared distances of 4096 of them stay below 2**62.
_LARGEST = 65536
#: Points searched together; each needs a mark per entry.
_AT_ONCE = 1 << 13


class OrchardSearch:
    """Nearest entry, exactly: by squared distance, then by lower index."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries.astype(np.int64)
        gaps = ((self.entries[:, None, :] - self.entries[None, :, :]) ** 2).sum(axis=2)
        self.lists = np.argsort(gaps, axis=1, kind="stable")
        self.gaps = np.take_along_axis(gaps, self.lists, axis=1)
        self.measured = 0  # distances computed so far

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of each point's nearest entry, and the squared distance to it."""
        found = [self._search(points[first : first + _AT_ONCE]) for first in range(0, len(points), _AT_ONCE)]
        if not found:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        return np.concatenate([index for index, _ in found]), np.concatenate([far for _, far in found])

    def _search(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, size = len(points), len(self.entries)
        current = np.zeros(n, dtype=np.int64)
        distance = ((points - self.entries[0]) ** 2).sum(axis=1)
        marked = np.zeros((n, size), dtype=bool)
        marked[:, 0] = True
        place = np.zeros(n, dtype=np.int64)  # in the list of the current entry
        active = np.arange(n)
        self.measured += n
        while True:
            active = active[place[active] < size]
            active = active[self.gaps[current[active], place[active]] <= 4 * distance[active]]
            if not len(active):
                return current, distance
            other = self.lists[current[active], place[active]]
            place[active] += 1
            fresh = ~marked[active, other]
            rows, other = active[fresh], other[fresh]
            marked[rows, other] = True
            far = ((points[rows] - self.entries[other]) ** 2).sum(axis=1)
            self.measured += len(rows)
            better = (far < distance[rows]) | ((far == distance[rows]) & (other < current[rows]))
            rows = rows[better]
            current[rows], distance[rows], place[rows] = other[better], far[better], 0


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def whole_vectors(rows: DataFrame, *, vec_id: str, vector: str, label: str, parts: int) -> DataFrame:
    """Rows (vec_id, label, vector) that take part, components as integers."""
    column = F.col(vector)
    usable = F.forall(column, lambda x: F.coalesce(F.abs(x) <= _LARGEST, F.lit(False)) & ~F.isnan(x))
    scaled = F.transform(column, lambda x: F.floor(x.cast("double") * _SCALE).cast("int"))
    kept = rows.filter(column.isNotNull() & (F.size(column) > 0) & (F.size(column) % parts == 0) & usable)
    kept = staged(
        kept.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), scaled.alias("vector")), "vectors"
    )
    first = kept.orderBy(F.asc_nulls_last("vec_id"), "vector").select(F.size("vector")).first()
    return kept if first is None else kept.filter(F.size("vector") == first[0])


def first_codebooks(kept: DataFrame, *, parts: int, entries: int) -> np.ndarray:
    """The parts of the smallest ids: an array by part, entry and component."""
    rows = kept.orderBy(F.asc_nulls_last("vec_id"), "vector").select("vector").limit(entries).collect()
    if not rows:
        return np.zeros((parts, 0, 0), dtype=np.int64)
    vectors = np.array([row["vector"] for row in rows], dtype=np.int64).reshape(len(rows), parts, -1)
    return vectors.transpose(1, 0, 2)


def moved(kept: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """The codebooks after one round: entries at the floored means of their parts."""
    parts, entries, width = codebooks.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = [OrchardSearch(book) for book in codebooks]
        totals = np.zeros((parts, entries, width), dtype=np.int64)
        counts = np.zeros((parts, entries), dtype=np.int64)
        for batch in batches:
            points = _matrix(batch.column("vector")).reshape(-1, parts, width)
            for part, search in enumerate(searches):
                index, _ = search.nearest(points[:, part])
                counts[part] += np.bincount(index, minlength=entries)
                np.add.at(totals[part], index, points[:, part])
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(part, width).astype(np.int32)),
                pa.array(np.repeat(entry, width).astype(np.int32)),
                pa.array(np.tile(np.arange(width), len(part)).astype(np.int32)),
                pa.array(totals[part, entry].ravel()),
                pa.array(np.repeat(counts[part, entry], width)),
            ],
            names=["part", "entry", "place", "total", "n"],
        )

    found = kept.select("vector").mapInArrow(sums, "part int, entry int, place int, total long, n long")
    found = found.groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    after = codebooks.copy()
    for row in found.toLocalIterator():
        after[row["part"], row["entry"], row["place"]] = row["total"] // row["n"]
    return after


def encoded(kept: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """Rows (vec_id, label, code, error): the nearest entries' indexes in hex."""
    parts, _, width = codebooks.shape

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = [OrchardSearch(book) for book in codebooks]
        for batch in batches:
            if not len(batch):
                continue
            points = _matrix(batch.column("vector")).reshape(-1, parts, width)
            codes = np.empty((len(points), parts), dtype=np.uint8)
            errors = np.zeros(len(points), dtype=np.int64)
            for part, search in enumerate(searches):
                index, far = search.nearest(points[:, part])
                codes[:, part] = index
                errors += far
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    batch.column("label"),
                    pa.array([row.tobytes().hex() for row in codes], type=pa.string()),
                    pa.array(errors),
                ],
                names=["vec_id", "label", "code", "error"],
            )
        give_back_memory()

    kinds = {field.name: field.dataType.simpleString() for field in kept.schema.fields}
    return kept.mapInArrow(assign, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")


def digest(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def compressed(
    rows: DataFrame,
    *,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = 16,
    entries: int = 64,
    rounds: int = 2,
) -> tuple[DataFrame, np.ndarray]:
    """Rows (vec_id, label, code, error) and the final codebooks. ``entries`` is 256 at
    most, two hex digits."""
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    kept = whole_vectors(rows, vec_id=vec_id, vector=vector, label=label, parts=parts)
    codebooks = first_codebooks(kept, parts=parts, entries=entries)
    for _ in range(rounds if codebooks.size else 0):
        codebooks = moved(kept, codebooks)
    return encoded(kept, codebooks), codebooks


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every vector, and the errors of its label together."""
    found, codebooks = compressed(table(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2)
    found = staged(found.select(F.struct("label").alias("key"), "vec_id", "code", "error"), "codes")
    sums = staged(found.groupBy("key").agg(F.sum("error").alias("label_error")), "label-errors")
    return found.join(sums, "key").select(
        "vec_id", "code", "error", "label_error", F.lit(digest(codebooks)).alias("codebooks_sha256")
    )
