"""Document fingerprints from prefix polynomial hashes.

The prefix array of a text holds, for every position p, the sum of its first p code
points times powers of a base, modulo the prime 2**61 - 1. The difference of two of
its values is the hash of the span between them times a power, so any two spans are
compared in one step, and since a span's equality implies that of its beginnings, the
longest common extension of two places is found by binary search (``PrefixHashes``).

A fingerprint is the thinned prefix array: the length, and the values at multiples of a
step from the beginning and from the end. The step is the smallest power of two that
gives at most 32 of each, so two fingerprints share the places of the larger step.
``likeness`` walks them from both ends by longest common extensions: equal spans in a
row are one binary search. It is the part of the longer text that such spans cover, to
within a sixteenth of its length for each edit.

For the next document of each, rows are sorted by id over range partitions (one
shuffle), so that neighbours meet in their task; the first and last row of each
partition are joined afterwards, two rows a partition.

Defined results: a null text is empty; two empty texts are alike (1.0), an empty and
another one are not (0.0); the next document of the last, and of an only one, is the
first; rows of a repeated id are ordered by a hash of their text, equal rows follow
one another; null ids come last; texts of any length are read in blocks; an empty table
gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlens.llm.common import give_back_memory, small_batches, staged, table

MODULUS = (1 << 61) - 1
BASE = 1_000_003_217_093_431
CHECKPOINTS = 32
_BLOCK = 1 << 15
_M = np.uint64(MODULUS)
_U = np.uint64


def _folded(value: np.ndarray) -> np.ndarray:
    """Modulo 2**61 - 1, of values below 2**64."""
    value = (value & _M) + (value >> _U(61))
    return np.where(value >= _M, value - _M, value)


def _times(a: np.ndarray, b: int) -> np.ndarray:
    """a * b modulo 2**61 - 1."""
    a1, a0 = a >> _U(31), a & _U(0x7FFFFFFF)
    b1, b0 = _U(b >> 31), _U(b & 0x7FFFFFFF)
    middle = _folded(a1 * b0 + a0 * b1)
    middle = (middle >> _U(30)) + ((middle & _U(0x3FFFFFFF)) << _U(31))
    return _folded(_folded(a1 * b1 << _U(1)) + _folded(middle) + _folded(a0 * b0))


def powers(size: int) -> np.ndarray:
    """BASE**0, BASE**1, ... by doubling."""
    found = np.ones(1, dtype=np.uint64)
    while len(found) < size:
        found = np.concatenate([found, _times(found, pow(BASE, len(found), MODULUS))])
    return found[:size]


class Hashing:
    """Terms of the sums, block by block."""

    def __init__(self) -> None:
        power = powers(_BLOCK)
        self._high, self._low = power >> _U(31), power & _U(0x7FFFFFFF)

    def terms(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The terms of a block, as their bits from 31 on and below: sums of either
        stay whole numbers below 2**64."""
        n = len(codes)
        values = codes.astype(np.uint64) + _U(1)
        high = values * self._high[:n]
        term = values * self._low[:n] + (high >> _U(30)) + ((high & _U(0x3FFFFFFF)) << _U(31))
        term = (term & _M) + (term >> _U(61))
        return term >> _U(31), term & _U(0x7FFFFFFF)

    def prefixes(self, codes: np.ndarray, places: list[int]) -> list[int]:
        """Values of the prefix array at ascending ``places``."""
        found, total = [], 0
        place = iter(places)
        wanted = next(place, None)
        for first in range(0, max(len(codes), 1), _BLOCK):
            block = codes[first : first + _BLOCK]
            cuts = []
            while wanted is not None and wanted <= first + len(block):
                cuts.append(wanted - first)
                wanted = next(place, None)
            scale = pow(BASE, first, MODULUS)
            edges = [0, *cuts, len(block)]
            sums = [np.add.reduceat(np.append(term, _U(0)), edges[:-1]).tolist() for term in self.terms(block)]
            for a, b, high, low in zip(edges, edges[1:], *sums, strict=False):
                if b > a:  # reduceat gives a lone value for an empty span
                    total = (total + ((high << 31) + low) * scale) % MODULUS
                found.append(total)
            found.pop()  # the end of the block is a place only if it is wanted
        return found


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


class PrefixHashes:
    """The whole prefix array of a text: spans and extensions in any two texts."""

    def __init__(self, text: str, hashing: Hashing | None = None) -> None:
        codes = code_points(text)
        self.length = len(codes)
        self.values = (hashing or Hashing()).prefixes(codes, list(range(self.length + 1)))

    def equal(self, start: int, other: PrefixHashes, other_start: int, length: int) -> bool:
        """Are the spans of ``length`` that begin at the two places the same?"""
        if start + length > self.length or other_start + length > other.length:
            return False
        own = self.values[start + length] - self.values[start]
        others = other.values[other_start + length] - other.values[other_start]
        return (own * pow(BASE, other_start, MODULUS) - others * pow(BASE, start, MODULUS)) % MODULUS == 0

    def common_extension(self, start: int, other: PrefixHashes, other_start: int) -> int:
        """The longest equal spans that begin at the two places, by binary search."""
        least, most = 0, min(self.length - start, other.length - other_start)
        while least < most:
            middle = (least + most + 1) // 2
            if self.equal(start, other, other_start, middle):
                least = middle
            else:
                most = middle - 1
        return least


def step_of(length: int, checkpoints: int = CHECKPOINTS) -> int:
    step = 1
    while length // step > checkpoints:
        step *= 2
    return step


def checkpoints_of(length: int) -> list[int]:
    """Multiples of the step from the beginning and from the end, ascending."""
    step = step_of(length)
    return sorted({*range(step, length + 1, step), *range(length, 0, -step)})


def fingerprint(text: str, hashing: Hashing) -> str:
    """Length in hex, a dash, the values at the checkpoints (8 bytes each, base 64)."""
    codes = code_points(text)
    values = hashing.prefixes(codes, checkpoints_of(len(codes)))
    packed = np.array(values, dtype=">u8").tobytes()
    return f"{len(codes):x}-" + base64.urlsafe_b64encode(packed).decode().rstrip("=")


def parsed(shown: str) -> tuple[int, dict[int, int]]:
    """Length, and the prefix array at 0 and the checkpoints."""
    length, _, packed = shown.partition("-")
    n = int(length, 16)
    values = np.frombuffer(base64.urlsafe_b64decode(packed + "=" * (-len(packed) % 4)), dtype=">u8").tolist()
    return n, {0: 0, **dict(zip(checkpoints_of(n), values, strict=True))}


def equal_runs(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Longest runs (from, to) of equal neighbouring spans of two arrays of prefix values
    at the same places: longest common extensions by binary search, one place on after
    each that ends."""
    runs, start, last = [], 0, min(len(a), len(b)) - 1
    while start < last:
        least, most = start, last
        while least < most:
            middle = (least + most + 1) // 2
            if (a[middle] - a[start] - b[middle] + b[start]) % MODULUS == 0:
                least = middle
            else:
                most = middle - 1
        if least > start:
            runs.append((start, least))
        start = least + 1
    return runs


def _covered(spans: list[tuple[int, int]]) -> int:
    total = reached = 0
    for begin, end in sorted(spans):
        total += max(0, end - max(begin, reached))
        reached = max(reached, end)
    return total


def likeness(a: tuple[int, dict[int, int]], b: tuple[int, dict[int, int]]) -> float:
    """The part of the longer text covered by spans that both fingerprints (``parsed``)
    hold at the same distance from the beginning or from the end."""
    (n, own), (m, other) = a, b
    if n == m and own == other:
        return 1.0
    if not n or not m:
        return 0.0
    step, shorter = max(step_of(n), step_of(m)), min(n, m)
    heads = range(0, shorter + 1, step)
    runs = equal_runs([own[p] for p in heads], [other[p] for p in heads])
    of_a = [(i * step, j * step) for i, j in runs]
    of_b = list(of_a)
    # From the end: values are brought to the same power of the base.
    longer = max(n, m)
    tails = range(0, shorter + 1, step)
    to_a, to_b = pow(BASE, longer - n, MODULUS), pow(BASE, longer - m, MODULUS)
    runs = equal_runs([own[n - d] * to_a for d in tails], [other[m - d] * to_b for d in tails])
    of_a += [(n - j * step, n - i * step) for i, j in runs]
    of_b += [(m - j * step, m - i * step) for i, j in runs]
    return min(_covered(of_a), _covered(of_b)) / longer


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by as much of the beginning of the other."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


_MEASURES = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _measured(text: str, own: str, following: str, following_print: str, hashing: Hashing) -> tuple:
    changed = edited(text, following)
    changed_print = fingerprint(changed, hashing)
    known = parsed(own)
    return (
        len(text),
        hashlib.sha256(changed.encode()).hexdigest(),
        own,
        changed_print,
        likeness(known, parsed(changed_print)),
        likeness(known, parsed(following_print)),
    )


def _measures(rows: list[tuple]) -> list[pa.Array]:
    columns = list(zip(*rows, strict=True)) if rows else [()] * 6
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    return [pa.array(column, type=kind) for column, kind in zip(columns, kinds, strict=True)]


def fingerprinted(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document, in descending order of ids compared with the next: doc_id,
    n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    kind = documents.schema[doc_id].dataType.simpleString()
    docs = small_batches(documents).select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    # Equal rows are dealt out by the running number, so no id makes a range too large.
    docs = docs.withColumns({"tie": F.xxhash64("text"), "nth": F.monotonically_increasing_id()})
    order = [F.desc_nulls_last("doc_id"), F.asc("tie"), F.asc("nth")]

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = [packer.compress(text.encode()) for text in batch.column("text").to_pylist()]
            keys = [batch.column(name) for name in ("doc_id", "tie", "nth")]
            yield pa.RecordBatch.from_arrays([*keys, pa.array(texts, type=pa.binary())], names=["doc_id", "tie", "nth", "text"])
        give_back_memory()

    # Texts cross the network compressed, two thirds of what the shuffle's own codec makes of them.
    docs = docs.select("doc_id", "tie", "nth", "text").mapInArrow(packed, f"doc_id {kind}, tie long, nth long, text binary")
    ranges = docs.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashing, part, unpacker = Hashing(), TaskContext.get().partitionId(), zstandard.ZstdDecompressor()
        held = None  # the row that waits for the next: id, text, fingerprint
        names = ["doc_id", *(f"m{k}" for k in range(6)), "part", "edge", "text"]

        def batch_of(ids: pa.Array, rows: list[tuple], edges: list[int], texts: list) -> pa.RecordBatch:
            parts = pa.array([part] * len(edges), type=pa.int32())
            arrays = [ids, *_measures(rows), parts, pa.array(edges, type=pa.int32()), pa.array(texts, type=pa.string())]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        empty = (None,) * 6
        for batch in batches:
            ids = batch.column("doc_id")
            texts = (unpacker.decompress(text).decode() for text in batch.column("text").to_pylist())
            rows = []
            before = held[0] if held else ids[:0]
            for n, this in enumerate(texts):
                own = fingerprint(this, hashing)
                if held:
                    rows.append(_measured(held[1], held[2], this, own, hashing))
                else:
                    yield batch_of(ids[:1], [empty], [1], [this])
                held = (ids[n : n + 1], this, own)
            done = pa.concat_arrays([before, ids])[: len(rows)]
            yield batch_of(done, rows, [0] * len(rows), [None] * len(rows))
        if held:
            yield batch_of(held[0], [empty], [2], [held[1]])
        give_back_memory()

    names = [field.split()[0] for field in _MEASURES.split(", ")]
    shape = ", ".join(f"m{k} {field.split()[1]}" for k, field in enumerate(_MEASURES.split(", ")))
    found = staged(
        ranges.mapInArrow(walk, f"doc_id {kind}, {shape}, part int, edge int, text string"), "fingerprints"
    )
    inside = found.filter("edge = 0").select("doc_id", *(F.col(f"m{k}").alias(name) for k, name in enumerate(names)))

    # Across partitions: the last row of one and the first of the next, in a ring. The
    # window holds a number per partition.
    parts = found.filter("edge = 1").select("part")
    ring = Window.orderBy("part")
    after = F.coalesce(F.lead("part").over(ring), F.first("part").over(ring))
    following = staged(parts.select("part", after.alias("after")), "ring")
    firsts = found.filter("edge = 1").select(F.col("part").alias("after"), F.col("text").alias("following"))
    lasts = found.filter("edge = 2").select("doc_id", "part", "text")
    pairs = lasts.join(following, "part").join(firsts, "after").select("doc_id", "text", "following")

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashing = Hashing()
        for batch in batches:
            rows = [
                _measured(a, fingerprint(a, hashing), b, fingerprint(b, hashing), hashing)
                for a, b in zip(batch.column("text").to_pylist(), batch.column("following").to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *_measures(rows)], names=["doc_id", *names])
        give_back_memory()

    return inside.unionByName(pairs.mapInArrow(across, f"doc_id {kind}, {_MEASURES}"))


def op12_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    return fingerprinted(table(spark, sf_dir, "documents"))
