"""Packing of token pieces by a configuration linear program.

A document is its ids and an end mark; only what is longer than a sequence is cut.
A configuration says how many pieces of which lengths share a sequence. The linear
program wants the fewest configurations that cover the histogram of lengths. It is
solved by multiplicative weights: a price per length, a knapsack dynamic program that finds the dearest
filling for every remaining room at once, a cover of the histogram with those
fillings, and lower prices for the lengths it covered too often. The average of all
rounds is rounded down to whole configurations; what is left over is placed best fit,
longest first.

Only the histogram (at most one row per length) and the configurations, whose number
depends on the lengths and not on the pieces, are held in one place. Pieces get a
running number within their length, counted per part of the table and summed up, so
that no length is gathered in one task; number and length tell sequence and offset.

Defined results: null and empty texts are the end mark alone; repeated rows are
packed each; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import bisect
import os
import string
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlens.llm.common import give_back_memory, small_batches, staged, table

END_ID = 1
_CACHED_CHUNKS = 900_000
_TEXTS_AT_ONCE = 64

Configuration = tuple[tuple[int, int], ...]  # (length, how many), longest first


class IdEncoder:
    """Ids of texts as little-endian unsigned 32-bit numbers.

    The vocabulary drops white space and never joins across it, so a text's ids are
    those of its chunks, and each chunk is encoded once. It does not join letters with
    punctuation either, so a word of letters alone shares its ids with the same word
    before a full stop or in capitals. Such words are encoded many at a time: each ends
    with the first id that closes a word.
    """

    _ASCII = np.arange(256)
    _SPACE = np.isin(_ASCII, list(b" \t\n\r\x0b\x0c"))
    _LETTER_OR_DIGIT = np.isin(_ASCII, list(b"abcdefghijklmnopqrstuvwxyz0123456789"))

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(path)
        # Its special tokens are ids of their own. Looking for them costs a quarter of the
        # time, so chunks that hold none go to a tokenizer that does not. All share a model.
        self._marks = [token.content.lower() for token in self._tokenizer.get_added_tokens_decoder().values()]
        self._raw_marks = [mark.encode() for mark in self._marks]
        self._unmarked = Tokenizer(self._tokenizer.model)
        self._unmarked.normalizer = self._tokenizer.normalizer
        self._unmarked.pre_tokenizer = self._tokenizer.pre_tokenizer
        # The same for words that need no more than to be told apart.
        self._of_words = Tokenizer(self._tokenizer.model)
        self._of_words.normalizer = normalizers.Sequence([])
        self._of_words.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        # The characters that a byte-level vocabulary writes for bytes, but for the space.
        printed = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        unprinted = [byte for byte in range(256) if byte not in printed]
        self._written = {byte: byte for byte in printed} | {byte: 256 + n for n, byte in enumerate(unprinted)}
        self._written[0x20] = 0x20
        vocabulary = self._tokenizer.get_vocab()
        self._closes = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self._closes[[at for token, at in vocabulary.items() if token.endswith("</w>")]] = True
        self._known: dict[bytes, bytes] = {}

    def _ids(self, texts: list[str], tokenizer) -> list[np.ndarray]:
        encoded = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(one.ids, dtype="<u4") for one in encoded]

    def _chunks(self, text: str | None) -> list[bytes]:
        """The chunks of a text, so written that few are different: a full stop or comma
        that ends a word is a chunk of its own, and capitals are small, but for those before
        a letter beyond ASCII, which may compose with them, and in texts with a special token."""
        raw = (text or "").encode()
        small = raw.lower()
        if len(raw) < 2 or any(mark in small for mark in self._raw_marks):
            return raw.split()
        written = bytearray(small + b" ")
        at = np.frombuffer(written, dtype=np.uint8)
        if not raw.isascii():
            own = np.frombuffer(raw, dtype=np.uint8)
            at[np.flatnonzero((own[:-1] - np.uint8(65) < 26) & (own[1:] > 127))] -= 32
        # "." and "," are 0x2e and 0x2c. Where they end a word they become 0xfe and 0xfc, which
        # no UTF-8 holds, and then two bytes.
        marks = np.flatnonzero((at[1:-1] & 0xFD) == 0x2C) + 1
        at[marks[self._SPACE[at[marks + 1]] & self._LETTER_OR_DIGIT[at[marks - 1]]]] |= 0xD0
        return bytes(written).replace(b"\xfe", b" .").replace(b"\xfc", b" ,").split()

    def _learn(self, chunks: set[bytes]) -> None:
        known = self._known
        simple = {chunk for chunk in chunks if chunk.isalpha() and chunk.islower()}
        chunks = chunks - simple
        words: list[bytes] = []  # chunks that are a word and perhaps a run of marks
        cores: list[bytes] = []
        tails: list[bytes] = []
        others: set[bytes] = set()
        listed = list(chunks)
        joined = b"\n".join(listed).decode()
        # Two letters whose small form depends on their place or is no single letter.
        odd = "\u03a3" in joined or "\u0130" in joined
        small = joined.lower()
        marks = [mark for mark in self._marks if mark in small]
        for chunk, text in zip(listed, (joined if odd else small).split("\n") if listed else [], strict=True):
            core = text.rstrip(string.punctuation)
            marked = marks and any(mark in text.lower() for mark in marks)
            if core.isalpha() and not marked and not (odd and ("\u03a3" in core or "\u0130" in core)):
                words.append(chunk)
                cores.append(core.encode())
                tails.append(text[len(core) :].encode())
            else:
                others.add(chunk)
        others.update(set(tails).difference(known, [b""]))
        special = [chunk for chunk in others if any(mark in chunk.decode().lower() for mark in marks)] if marks else []
        plain = list(others.difference(special))
        for chosen, tokenizer in ((plain, self._unmarked), (special, self._tokenizer)):
            for chunk, ids in zip(chosen, self._ids([chunk.decode() for chunk in chosen], tokenizer), strict=True):
                known[chunk] = ids.tobytes()
        new = list(simple.union(set(cores).difference(known)))
        text = b" ".join(new).decode()
        clean = not odd and unicodedata.is_normalized("NFC", text)
        if clean:
            ids = self._ids([text.encode().decode("latin-1").translate(self._written)], self._of_words)[0]
        else:
            ids = self._ids([text], self._unmarked)[0]
        ends = np.flatnonzero(self._closes[ids]) + 1
        if len(ends) != len(new):  # a letter that the vocabulary takes for something else
            found = [own.tobytes() for own in self._ids([core.decode() for core in new], self._unmarked)]
        else:
            raw, cuts = ids.tobytes(), [0, *(4 * ends).tolist()]
            found = [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        known.update(zip(new, found, strict=True))
        for chunk, core, tail in zip(words, cores, tails, strict=True):
            known[chunk] = known[core] + known[tail] if tail else known[core]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        split = [self._chunks(text) for text in texts]
        if len(self._known) > _CACHED_CHUNKS:
            self._known.clear()
        known = self._known
        found = [list(map(known.get, chunks)) for chunks in split]
        missing = [[at for at, ids in enumerate(own) if ids is None] for own in found]
        new = {chunks[at] for chunks, places in zip(split, missing, strict=True) for at in places}
        if new:
            self._learn(new)
        for chunks, own, places in zip(split, found, missing, strict=True):
            for at in places:
                own[at] = known[chunks[at]]
        end = np.array([END_ID], dtype="<u4").tobytes()
        return [b"".join(own) + end for own in found]


def pieces(documents: DataFrame, *, tokenizer: str, capacity: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32)."""
    kind = documents.schema[doc_id].dataType.simpleString()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Made anew by each task, in a tenth of a second: kept, it would hold memory in
        # every worker of the executor, of which only some are at work.
        encoder = IdEncoder(tokenizer)
        for batch in batches:
            rows, at = [], []
            texts = batch["text"].tolist()
            for first in range(0, len(texts), _TEXTS_AT_ONCE):
                for n, ids in enumerate(encoder.encode(texts[first : first + _TEXTS_AT_ONCE]), first):
                    for piece, start in enumerate(range(0, len(ids) // 4, capacity)):
                        part = ids[4 * start : 4 * (start + capacity)]
                        rows.append((piece, start, len(part) // 4, zlib.crc32(part)))
                        at.append(n)
            found = pd.DataFrame(rows, columns=["piece", "start", "length", "ids_crc32"])
            found.insert(0, "doc_id", batch["doc_id"].iloc[at].to_numpy())
            yield found
        del encoder
        give_back_memory()

    chosen = small_batches(documents).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return chosen.mapInPandas(cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def price(prices: np.ndarray, capacity: int) -> np.ndarray:
    """For every room, the length to put next in its dearest filling (0: none).
    ``prices`` by length, minus infinity where there is no such length."""
    worth = np.zeros(capacity + 1)
    following = np.zeros(capacity + 1, dtype=np.int64)
    for room in range(1, capacity + 1):
        offers = worth[room - 1 :: -1] + prices[1 : room + 1]
        best = int(offers.argmax())
        if offers[best] > worth[room - 1] + 1e-15:
            worth[room], following[room] = offers[best], best + 1
        else:  # the room is as good as the next smaller one
            worth[room], following[room] = worth[room - 1], following[room - 1]
    return following


def _filling(first: int, following: np.ndarray, capacity: int) -> Configuration:
    counts = {first: 1}
    room = capacity - first
    while room > 0 and (length := int(following[room])):
        counts[length] = counts.get(length, 0) + 1
        room -= length
    return tuple(sorted(counts.items(), reverse=True))


def solve(histogram: dict[int, int], capacity: int, rounds: int = 24, rate: float = 0.5) -> dict[Configuration, float]:
    """Fractional numbers of configurations that cover the histogram."""
    lengths = sorted(histogram, reverse=True)
    prices = np.full(capacity + 1, -np.inf)
    prices[lengths] = np.array(lengths) / capacity
    used: dict[Configuration, float] = {}
    for _ in range(rounds):
        following = price(prices, capacity)
        missing = {length: float(n) for length, n in histogram.items()}
        for length in lengths:
            if missing[length] > 1e-9:
                configuration = _filling(length, following, capacity)
                times = missing[length] / dict(configuration)[length]
                used[configuration] = used.get(configuration, 0.0) + times / rounds
                for other, count in configuration:
                    missing[other] -= times * count
        for length in lengths:
            excess = -missing[length] / histogram[length]
            prices[length] *= np.exp(-rate * min(max(excess, 0.0), 2.0))
    return used


def _best_fit(left: dict[int, int], capacity: int) -> dict[Configuration, int]:
    """Longest first, each into the fullest sequence that has room; equal sequences
    are filled together."""
    groups: dict[int, list[tuple[Configuration, int]]] = {}
    rooms: list[int] = []

    def add(room: int, configuration: Configuration, count: int) -> None:
        if room not in groups:
            groups[room] = []
            bisect.insort(rooms, room)
        groups[room].append((configuration, count))

    for length in sorted(left, reverse=True):
        n = left[length]
        while n > 0:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                room, configuration, count = capacity, (), n
            else:
                room = rooms[at]
                configuration, count = groups[room].pop()
                if not groups[room]:
                    del groups[room]
                    rooms.pop(at)
            each = room // length
            filled = min(count, n // each)
            if filled:
                add(room - each * length, (*configuration, (length, each)), filled)
                n -= filled * each
                count -= filled
            if count and 0 < n < each:
                add(room - n * length, (*configuration, (length, n)), 1)
                n, count = 0, count - 1
            if count and configuration:
                add(room, configuration, count)
    packed: dict[Configuration, int] = {}
    for found in groups.values():
        for configuration, count in found:
            packed[configuration] = packed.get(configuration, 0) + count
    return packed


def pack(histogram: dict[int, int], capacity: int) -> dict[Configuration, int]:
    """Whole numbers of configurations that hold exactly the pieces of the histogram."""
    left = {length: n for length, n in histogram.items() if n > 0}
    packed: dict[Configuration, int] = {}
    used = solve(left, capacity) if left else {}
    room = {c: capacity - sum(length * n for length, n in c) for c in used}
    fullest = sorted(used, key=lambda c: (room[c], -used[c], c))

    def take(configuration: Configuration, times: int) -> None:
        times = min(times, *(left[length] // n for length, n in configuration))
        if times > 0:
            packed[configuration] = packed.get(configuration, 0) + times
            for length, n in configuration:
                left[length] -= times * n

    for configuration in fullest:
        take(configuration, int(used[configuration]))
    for configuration in fullest:  # rounding left pieces over that still fill whole sequences
        if room[configuration] == 0:
            take(configuration, max(left.values()))
    for configuration, times in _best_fit({k: n for k, n in left.items() if n}, capacity).items():
        packed[configuration] = packed.get(configuration, 0) + times
    return packed


class Places:
    """Where the n-th piece of a length goes."""

    def __init__(self, packed: dict[Configuration, int]) -> None:
        found: dict[int, list[tuple[int, int, int, int]]] = {}
        taken: dict[int, int] = {}
        sequences = 0
        for configuration, times in sorted(packed.items()):
            offset = 0
            for length, each in configuration:
                number = taken.get(length, 0)
                found.setdefault(length, []).append((number, each, sequences, offset))
                taken[length] = number + each * times
                offset += each * length
            sequences += times
        self._found = {length: np.array(rows) for length, rows in found.items()}

    def of(self, lengths: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
        for length in np.unique(lengths):
            rows = np.flatnonzero(lengths == length)
            places = self._found[int(length)]
            at = np.searchsorted(places[:, 0], numbers[rows], side="right") - 1
            first, each, begin, base = places[at].T
            nth = numbers[rows] - first
            sequence[rows] = begin + nth // each
            offset[rows] = base + nth % each * length
        return sequence, offset


def packed_sequences(
    documents: DataFrame, *, tokenizer: str, capacity: int = 4096, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Every piece of every document with its sequence and its offset there."""
    cut = pieces(documents, tokenizer=tokenizer, capacity=capacity, doc_id=doc_id, text=text)
    cut = staged(cut.withColumn("part", F.spark_partition_id()), "pieces")
    counts = staged(cut.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    histogram = {row["length"]: row["n"] for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = Places(pack(histogram, capacity))

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("part", "length").orderBy("doc_id", "piece")
    numbered = cut.withColumn("nth", F.row_number().over(within) - 1).join(
        starts.hint("merge"), ["part", "length"]
    )

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        sequence, offset = places.of(length.to_numpy(), number.to_numpy())
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    found = numbered.withColumn("place", place("length", F.col("before") + F.col("nth")))
    return found.select("doc_id", "piece", "start", "length", "ids_crc32", "place.sequence_id", "place.offset")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return packed_sequences(table(spark, sf_dir, "documents"), tokenizer=path, capacity=4096)
