"""Removal of passages that repeat, by level-wise doubling.

A passage repeats if a window of ``length`` words starts at two places of the
corpus. Short windows are looked at first; those that repeat alone are extended to
twice their length, and so on up to ``length`` (9, 18 and 35 words), until no
candidates survive. Levels beyond could not remove more: a longer repeat is the union of
its windows.

Of the shortest windows only those are counted that have the smallest hash among the
places of some full window from which the next levels still fit into it. Equal full
windows choose the same place, so a full window can repeat only if the windows at its
chosen place do, at every level; about one word in ten is a chosen place. The last level
hashes the words of full windows to 128 bits.

Equal texts are counted as one text with copies. What repeats inside one text is
found in its task; between texts, each text gives a window once. Removal is judged
on the input. Nothing is collected but the positions of one text. Of whole texts, only
those that may hold a candidate are shuffled, told apart by a bitmap of fixed size.

Defined results: null and empty texts have no words; texts shorter than the
window lose nothing; repeated rows are copies and lose every word that a window
covers; an empty table gives no rows. Other columns stay, but for those of a result's
name, whose place the result takes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm.common import divided, give_back_memory, others, small_batches, staged, table

_BASE = 0x9E3779B97F4A7C15
#: A level of windows below this many words is not halved further.
SHORTEST = 8
#: So many windows are searched for their smallest hash at a time: the search copies the
#: hashes of each, some 18 times the words of a text.
_WINDOWS_AT_ONCE = 1 << 14
#: Hashes of that many distinct words are kept in a task at a time.
_CACHED_WORDS = 100_000


class WindowHashes:
    """64-bit hashes of all windows of a word sequence, by prefix sums of powers."""

    def __init__(self) -> None:
        self._words: dict[bytes, bytes] = {}
        self._powers = self._inverses = np.ones(1, dtype=np.uint64)

    def word_hashes(self, words: list[bytes]) -> np.ndarray:
        if len(self._words) > _CACHED_WORDS:
            self._words.clear()
        known = self._words
        for word in set(words):
            if word not in known:
                known[word] = xxhash.xxh64_digest(word)
        return np.frombuffer(b"".join([known[word] for word in words]), dtype=np.uint64)

    def windows(self, hashes: np.ndarray, length: int) -> np.ndarray:
        n = len(hashes)
        if len(self._powers) <= n:
            size = 2 * n + 1
            self._powers = _powers(_BASE, size)
            self._inverses = _powers(pow(_BASE, -1, 1 << 64), size)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * self._powers[:n], dtype=np.uint64)])
        mixed = (sums[length:] - sums[:-length]) * self._inverses[: n - length + 1]
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0xD6E8FEB86659FD93)
        return mixed ^ (mixed >> np.uint64(32))


def _powers(base: int, size: int) -> np.ndarray:
    powers = np.full(size, base, dtype=np.uint64)
    powers[0] = 1
    return np.cumprod(powers, dtype=np.uint64)


def levels_of(length: int) -> list[int]:
    """Lengths of the windows, each about twice the one before: 9, 18, 35."""
    found = [length]
    while len(found) == 1 or found[-1] >= 2 * SHORTEST - 1:
        found.append((found[-1] + 1) // 2)
    return found[::-1]


def chosen_places(hashing: WindowHashes, words: list[bytes], length: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Window hashes of all levels but the last, by place, and for each full window its
    chosen place, from which the windows of all these levels lie inside it."""
    *shorter, _ = levels_of(length)
    hashes = hashing.word_hashes(words)
    levels = [hashing.windows(hashes, size) for size in shorter]
    usable = levels[0][: len(levels[-1])]
    per_window = np.lib.stride_tricks.sliding_window_view(usable, length - shorter[-1] + 1)
    chosen = np.arange(len(per_window))
    for first in range(0, len(per_window), _WINDOWS_AT_ONCE):
        part = slice(first, first + _WINDOWS_AT_ONCE)
        chosen[part] += per_window[part].argmin(axis=1)
    return levels, chosen


def _identity(text: Column) -> list[Column]:
    digest = F.md5(F.coalesce(text, F.lit("")).cast("binary"))
    return [
        F.conv(F.substring(digest, start, 15), 16, 10).cast("long").alias(name)
        for name, start in (("_llm_k1", 1), ("_llm_k2", 16))
    ]


_KEYS = ["_llm_k1", "_llm_k2"]


def _names(length: int) -> list[str]:
    """Columns of the levels but the last."""
    return [f"l{k}" for k in range(len(levels_of(length)) - 1)]


def _chosen_of(batches: Iterator[pd.DataFrame], length: int) -> Iterator[pd.DataFrame]:
    hashing = WindowHashes()
    none = np.empty(0, dtype=np.int64)
    names = _names(length)
    for batch in batches:
        found: dict[str, list] = {name: [] for name in [*names, "own"]}
        for text in batch["text"]:
            words = (text or "").encode().split()
            if len(words) < length:
                for rows in found.values():
                    rows.append(none)
                continue
            levels, chosen = chosen_places(hashing, words, length)
            places = np.unique(chosen)
            distinct, first, times = np.unique(levels[-1][places], return_index=True, return_counts=True)
            for name, level in zip(names, levels, strict=True):
                found[name].append(level[places[first]].view(np.int64))
            found["own"].append(distinct[times > 1].view(np.int64))
        yield batch[_KEYS].assign(**found)
    del hashing
    give_back_memory()


def _windows_of(batches: Iterator[pd.DataFrame], length: int) -> Iterator[pd.DataFrame]:
    hashing = WindowHashes()
    for batch in batches:
        rows = []
        for tid, text, halves_left in zip(batch["tid"], batch["text"], batch["halves"], strict=True):
            words = text.encode().split()
            levels, chosen = chosen_places(hashing, words, length)
            left = np.asarray(halves_left, dtype=np.int64).view(np.uint64)
            starts = np.flatnonzero(np.isin(levels[-1][chosen], left))
            joined = b" ".join(words)
            ends = np.cumsum([len(word) + 1 for word in words])
            begins = ends - [len(word) + 1 for word in words]
            digests = b"".join(
                [
                    xxhash.xxh3_128_digest(joined[a:b])
                    for a, b in zip(begins[starts].tolist(), (ends[starts + length - 1] - 1).tolist(), strict=True)
                ]
            )
            pairs = np.frombuffer(digests, dtype=np.int64).reshape(-1, 2)
            order = np.lexsort((pairs[:, 1], pairs[:, 0]))
            ranked = pairs[order]
            new = np.ones(len(ranked), dtype=bool)
            new[1:] = (ranked[1:] != ranked[:-1]).any(axis=1)
            group = np.cumsum(new) - 1
            once = np.bincount(group, minlength=0)[group] == 1
            own = np.sort(starts[order[~once]]).astype(np.int32)
            first = order[new]
            alone = once[new]
            rows.append((tid, pairs[first, 0], pairs[first, 1], np.where(alone, starts[first], -1).astype(np.int32), own))
        yield pd.DataFrame(rows, columns=["tid", "h1", "h2", "starts", "own"])
    del hashing
    give_back_memory()


def _survivors(rows: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Keys that more than one row holds."""
    repeated = rows.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    return staged(repeated, label)


def repeated_windows(documents: DataFrame, *, text: str = "text", length: int = 35) -> DataFrame:
    """One row per distinct text that loses words: its two key columns, ``copies``,
    and ``starts``, where windows begin that also start elsewhere in other texts or
    again in this one (no entry is needed for a text with copies)."""
    texts = small_batches(documents).select(*_identity(F.col(text)), F.coalesce(F.col(text), F.lit("")).alias("text"))
    names = _names(length)
    schema = ", ".join(["_llm_k1 long, _llm_k2 long", *(f"{name} array<long>" for name in names), "own array<long>"])
    chosen = texts.mapInPandas(lambda batches: _chosen_of(batches, length), schema)
    classes = chosen.groupBy(*_KEYS).agg(
        F.count("*").alias("copies"), *(F.first(name).alias(name) for name in [*names, "own"])
    )
    classes = staged(classes.withColumn("tid", F.monotonically_increasing_id()), "texts")

    # Windows of each length that repeat; those alone go on to the next.
    level = classes.select("tid", F.explode(F.arrays_zip(*names)).alias("w")).select("tid", "w.*")
    for name in names:
        repeated = _survivors(level.select(name), [name], f"repeated-{name}")
        level = level.join(repeated, name)
        if name != names[-1]:
            level = staged(level, f"candidates-{name}")
    left = level.select("tid", F.col(names[-1]).alias("half"))
    left = left.unionByName(classes.select("tid", F.explode("own").alias("half")))
    left = left.groupBy("tid").agg(F.collect_set("half").alias("halves"))
    left = staged(left.join(classes.select("tid", *_KEYS), "tid"), "candidate-texts")

    # The last level: whole windows, of texts with candidates.
    bodies, _ = divided(texts, "_llm_k1", left.select("_llm_k1"))
    bodies = bodies.groupBy(*_KEYS).agg(F.first("text").alias("text"))
    candidates = bodies.join(left, _KEYS).select("tid", "text", "halves")
    schema = "tid long, h1 array<long>, h2 array<long>, starts array<int>, own array<int>"
    windows = staged(candidates.mapInPandas(lambda batches: _windows_of(batches, length), schema), "windows")
    level = windows.select("tid", F.explode(F.arrays_zip("h1", "h2", "starts")).alias("w")).select("tid", "w.*")
    repeated = _survivors(level.select("h1", "h2"), ["h1", "h2"], "repeated-windows")
    starts = level.filter("starts >= 0").join(repeated, ["h1", "h2"]).select("tid", F.col("starts").alias("start"))
    starts = starts.unionByName(windows.select("tid", F.explode("own").alias("start")))
    starts = starts.groupBy("tid").agg(F.collect_list("start").alias("starts"))
    found = classes.select("tid", *_KEYS, "copies", F.size(names[-1]).alias("n")).join(starts, "tid", "left")
    found = found.filter(F.col("starts").isNotNull() | ((F.col("copies") > 1) & (F.col("n") > 0)))
    return staged(found.select(*_KEYS, "copies", "starts"), "repeated-passages")


def _kept_words(text: str | None, starts: np.ndarray | None, all_covered: bool, length: int) -> tuple[str, int, int]:
    words = (text or "").encode().split()
    if all_covered:
        return "", len(words), len(words)
    if starts is None or len(starts) == 0:
        return b" ".join(words).decode(), len(words), 0
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edges, starts, 1)
    np.subtract.at(edges, np.asarray(starts) + length, 1)
    covered = np.cumsum(edges[:-1]) > 0
    kept = [word for word, gone in zip(words, covered.tolist(), strict=True) if not gone]
    return b" ".join(kept).decode(), len(words), int(covered.sum())


def _marked(documents: DataFrame, text: str, length: int) -> tuple[DataFrame, DataFrame]:
    """``documents`` in two parts: those that may lose words, with ``_llm_starts`` and
    ``_llm_copied``, and the others, which are not shuffled."""
    found = repeated_windows(documents, text=text, length=length)
    names = documents.columns
    keyed = small_batches(documents).select("*", *_identity(F.col(text)))
    suspects, clean = divided(keyed, "_llm_k1", found.select("_llm_k1"))
    marks = found.select(
        F.struct(*_KEYS).alias("_llm_key"), F.col("starts").alias("_llm_starts"), (F.col("copies") > 1).alias("_llm_copied")
    )
    suspects = suspects.withColumn("_llm_key", F.struct(*_KEYS)).join(marks.hint("merge"), "_llm_key", "left")
    copied = F.coalesce("_llm_copied", F.lit(False)).alias("_llm_copied")
    return suspects.select(*names, "_llm_starts", copied), clean.select(*names)


def _kept(length: int):
    @F.pandas_udf("kept string, n_words long, n_removed long")
    def keep(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, starts, copied in batches:
            rows = [_kept_words(t, s, c, length) for t, s, c in zip(texts, starts, copied, strict=True)]
            yield pd.DataFrame(rows, columns=["kept", "n_words", "n_removed"])
        give_back_memory()

    # Else a filter on the result would evaluate it a second time, in workers of its own.
    return keep.asNondeterministic()


def without_repeats(documents: DataFrame, *, text: str = "text", length: int = 35) -> DataFrame:
    """``documents`` with ``kept`` (the words that stay, joined by one space),
    ``n_words`` and ``n_removed``."""
    results = ("kept", "n_words", "n_removed")
    suspects, clean = _marked(documents, text, length)
    unmarked = clean.select("*", F.lit(None).cast("array<int>").alias("_llm_starts"), F.lit(False).alias("_llm_copied"))
    rows = suspects.unionByName(unmarked)
    rows = rows.withColumn("_llm_kept", _kept(length)(F.col(text), F.col("_llm_starts"), F.col("_llm_copied")))
    return rows.select(*others(documents, *results), *(F.col(f"_llm_kept.{name}") for name in results))


def drop_repeats(documents: DataFrame, *, length: int = 35) -> DataFrame:
    """``documents`` with repeated passages cut out of ``text`` and ``n_chars`` to
    match; texts that lose nothing stay as they are, texts that lose all go."""
    suspects, clean = _marked(documents, "text", length)
    rows = suspects.withColumn(
        "_llm_kept", _kept(length)(F.col("text"), F.col("_llm_starts"), F.col("_llm_copied"))
    )
    removed = F.col("_llm_kept.n_removed")
    rows = rows.filter((removed == 0) | (removed < F.col("_llm_kept.n_words")))
    columns = []
    for field in documents.schema.fields:
        column = F.col(f"`{field.name}`")
        if field.name == "text":
            column = F.when(removed > 0, F.col("_llm_kept.kept")).otherwise(column)
        elif field.name == "n_chars":
            column = F.when(removed > 0, F.char_length("_llm_kept.kept").cast(field.dataType)).otherwise(column)
        columns.append(column.alias(field.name))
    return clean.unionByName(rows.select(*columns))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of repeated 35-word windows."""
    rows = without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), length=35)
    return rows.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
