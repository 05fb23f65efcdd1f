"""Alignment of two tokenizers over the same bytes.

Tokenizer A encodes a space and the text, B the text (and adds the space). Byte offsets
at which tokens of both end are boundaries; they cut the tokens into groups. A link is
a pair of an A and a B token whose byte ranges overlap.

A stretch of bytes is a ``Fragment``: the tokens that end in it before its first
boundary (open: their group began earlier), the groups between its boundaries (closed),
and the tokens after its last one (open). Fragments form a monoid: joining two closes
at most one group, of the left one's open end and the right one's open beginning. Since
that is associative, very long texts are cut into byte ranges, anywhere, also within
words; every range is encoded and aligned by a task, and ranges are joined eight at a
time, level by level, in tasks.

What makes ranges exact: both tokenizers start anew at a space between two other
characters that are no white space, whatever stands around (A splits there first; in B's
vocabulary no piece holds a space after another character, which is checked). A range
that begins or ends within a word encodes the whole word and keeps the tokens that end
in its own bytes. For the same reason a word's fragment is kept and used again.

How many documents link a pair is counted over all documents. The most frequent pairs,
at most ``held`` of them, travel to the tasks; the links of all others are joined.

Defined results: null and empty texts, and texts whose tokens do not give back a space
and the text, have no tokens: zeros and an empty digest; repeated rows count each, also
as documents that hold a pair; an empty table gives no rows; a null id is an id like
others. Strings of special tokens are plain text. Other columns are ignored, whatever
their names.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlens.llm.common import give_back_memory, kept_in_process, small_batches, staged, table

#: Texts of more code points are cut into ranges of so many.
RANGE = 1 << 16
#: Fragments joined by one task at a time.
_FAN = 8
#: A task forgets its words when it knows more, or more of their links.
_CACHED_WORDS = 300_000
_CACHED_LINKS = 4_000_000
_SPLIT = re.compile(r"(?<=\S) (?=\S)")

_NONE = np.empty(0, dtype=np.int64)

Tokens = list[tuple[int, int]]  # (id, byte offset of its end)


def code_of(a: int, b: int) -> int:
    return a << 32 | b


@dataclass
class Fragment:
    """The tokens that end in a stretch of bytes."""

    bounded: bool = False  # does it hold a boundary?
    head: tuple[Tokens, Tokens] = field(default_factory=lambda: ([], []))  # up to the first boundary, else all
    groups: list[str] = field(default_factory=list)  # closed
    n_groups: int = 0
    links: dict[int, int] = field(default_factory=dict)  # of the closed groups: pair, times
    tail: tuple[Tokens, Tokens] = field(default_factory=lambda: ([], []))  # after the last boundary
    n_a: int = 0
    n_b: int = 0
    broken: bool = False  # tokens that do not give back the bytes

    @staticmethod
    def of(a: Tokens, b: Tokens) -> Fragment:
        found = Fragment(n_a=len(a), n_b=len(b))
        common = {end for _, end in a} & {end for _, end in b}
        if not common:
            found.head = (a, b)
            return found
        found.bounded = True
        (first_a, first_b), (last_a, last_b) = _cut_after(a, b, min(common)), _cut_after(a, b, max(common))
        found.head = (a[:first_a], b[:first_b])
        found.tail = (a[last_a:], b[last_b:])
        found._close(a[first_a:last_a], b[first_b:last_b])
        return found

    def _close(self, a: Tokens, b: Tokens) -> None:
        """Adds whole groups: both lists begin and end at a boundary."""
        i = j = since_a = since_b = 0
        groups, links = [], self.links
        while i < len(a):
            (own, end), (other, other_end) = a[i], b[j]
            pair = code_of(own, other)
            links[pair] = links.get(pair, 0) + 1
            if end <= other_end:
                i += 1
            if other_end <= end:
                j += 1
            if end == other_end:
                ids = ",".join([str(token) for token, _ in a[since_a:i]])
                groups.append(ids + "|" + ",".join([str(token) for token, _ in b[since_b:j]]))
                since_a, since_b = i, j
        if groups:
            self.groups.append(";".join(groups))
            self.n_groups += len(groups)

    def __add__(self, right: Fragment) -> Fragment:
        joined = Fragment(
            bounded=self.bounded or right.bounded,
            groups=list(self.groups),
            n_groups=self.n_groups + right.n_groups,
            links=dict(self.links),
            n_a=self.n_a + right.n_a,
            n_b=self.n_b + right.n_b,
            broken=self.broken or right.broken,
        )
        if not self.bounded:
            joined.head = (self.head[0] + right.head[0], self.head[1] + right.head[1])
        else:
            joined.head = self.head
            middle = (self.tail[0] + right.head[0], self.tail[1] + right.head[1])
            if right.bounded:
                joined._close(*middle)
            else:
                joined.tail = middle
        if right.bounded:
            joined.tail = right.tail
        joined.groups += right.groups
        for pair, times in right.links.items():
            joined.links[pair] = joined.links.get(pair, 0) + times
        return joined


#: A text's begin: a boundary with nothing before it.
BEGIN = Fragment(bounded=True)


def _cut_after(a: Tokens, b: Tokens, end: int) -> tuple[int, int]:
    return sum(e <= end for _, e in a), sum(e <= end for _, e in b)


class WordTable:
    """What is known of words, by number: groups as text, counts of A tokens, B tokens
    and groups, whether they give the bytes back, and the links of each in a row."""

    def __init__(self) -> None:
        self.index: dict[str, int] = {}
        self.texts: list[str] = []
        self.counts = np.zeros((1 << 12, 4), dtype=np.int64)
        self.ends = np.zeros((1 << 12) + 1, dtype=np.int64)
        self.links = np.zeros(1 << 14, dtype=np.int64)

    def add(self, words: list[str], texts: list[str], counts: np.ndarray, links: np.ndarray, sizes: np.ndarray) -> None:
        first, used = len(self.texts), self.ends[len(self.texts)]
        last, needed = first + len(words), int(used) + len(links)
        if last > len(self.counts):
            room = max(last, 2 * len(self.counts)) - len(self.counts)
            self.counts = np.concatenate([self.counts, np.zeros((room, 4), dtype=np.int64)])
            self.ends = np.concatenate([self.ends, np.zeros(room, dtype=np.int64)])
        if needed > len(self.links):
            self.links = np.concatenate([self.links, np.zeros(max(needed, len(self.links)), dtype=np.int64)])
        self.counts[first:last] = counts
        self.ends[first + 1 : last + 1] = used + np.cumsum(sizes)
        self.links[used:needed] = links
        self.index.update(zip(words, range(first, last), strict=True))
        self.texts += texts

    def links_of(self, numbers: np.ndarray) -> np.ndarray:
        starts, sizes = self.ends[numbers], self.ends[numbers + 1] - self.ends[numbers]
        before = np.cumsum(sizes) - sizes
        return self.links[np.arange(sizes.sum()) + np.repeat(starts - before, sizes)]


class Pair:
    """The two tokenizers, and what is known of words."""

    def __init__(self, path_a: str, path_b: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_file(path_a)
        self._a.encode_special_tokens = True
        self._b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self._b.id_to_piece(n) for n in range(len(self._b))]
        if any(re.search("[^▁]▁", piece) for piece in pieces):
            raise ValueError("a piece of tokenizer B holds a space after another character")
        self._bytes_b = [
            bytes([int(piece[3:5], 16)]) if self._b.is_byte(n) else piece.replace("▁", " ").encode()
            for n, piece in enumerate(pieces)
        ]
        byte_of = {character: byte for byte, character in _byte_characters().items()}
        vocabulary = self._a.get_vocab()
        self._bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, n in vocabulary.items():
            if all(character in byte_of for character in token):
                self._bytes_a[n] = bytes([byte_of[character] for character in token])
        self._size_a, self._size_b = (
            np.array([len(one) for one in table], dtype=np.int64) for table in (self._bytes_a, self._bytes_b)
        )
        # Ids as text, with the mark that follows: within a group, at the end of its side.
        self._shown_a, self._shown_b = (
            np.array([f"{n}{mark}" for mark in marks for n in range(size)], dtype=object)
            for size, marks in ((len(self._bytes_a), ",|"), (len(self._bytes_b), ",;"))
        )
        self._known = WordTable()

    def forget(self) -> None:
        self._known = WordTable()

    def tokens(self, words: list[str]) -> list[tuple[Tokens, Tokens, bool]]:
        """Of each word after a space: tokens with the ends of their bytes, and whether
        they give the bytes back."""
        encoded = self._a.encode_batch_fast([" " + word for word in words], add_special_tokens=False)
        found = []
        for word, one, ids_b in zip(words, encoded, self._b.encode(words, num_threads=1), strict=True):
            bytes_a, bytes_b = [self._bytes_a[n] for n in one.ids], [self._bytes_b[n] for n in ids_b]
            whole = (" " + word).encode()
            same = b"".join(bytes_a) == whole == b"".join(bytes_b)
            found.append((_with_ends(one.ids, bytes_a), _with_ends(ids_b, bytes_b), same))
        return found

    def _learn(self, words: list[str], table: WordTable) -> None:
        """Aligns many words at once, all as one text."""
        whole = (" " + " ".join(words)).encode()
        by_word = self._b.encode(words, num_threads=1)
        ids_b = np.fromiter(chain.from_iterable(by_word), dtype=np.int64)
        if b"".join([self._bytes_b[n] for n in ids_b.tolist()]) != whole:
            good = [
                word
                for word, ids in zip(words, by_word, strict=True)
                if b"".join([self._bytes_b[n] for n in ids]) == (" " + word).encode()
            ]
            if len(good) < len(words):
                bad = sorted(set(words).difference(good))
                table.add(bad, [""] * len(bad), np.array([(0, 0, 0, 1)] * len(bad)), _NONE, np.zeros(len(bad), np.int64))
                if good:
                    self._learn(good, table)
                return
        ids_a = np.array(self._a.encode_batch_fast([whole.decode()], add_special_tokens=False)[0].ids, dtype=np.int64)
        ends_a, ends_b = np.cumsum(self._size_a[ids_a]), np.cumsum(self._size_b[ids_b])
        word_ends = np.cumsum([len(word) + 1 for word in (one.encode() for one in words)])
        # Between neighbouring ends of either tokenizer lies one link.
        ends = np.union1d(ends_a, ends_b)
        links = ids_a[np.searchsorted(ends_a, ends)] << 32 | ids_b[np.searchsorted(ends_b, ends)]
        common = ends_a[np.isin(ends_a, ends_b, assume_unique=True)]
        # Ids as text: of each group the A tokens, then the B tokens.
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        many_a, many_b = np.bincount(group_a, minlength=len(common)), np.bincount(group_b, minlength=len(common))
        before_b, until_a = np.cumsum(many_b) - many_b, np.cumsum(many_a)
        shown = np.empty(len(ids_a) + len(ids_b), dtype=object)
        last_a, last_b = common[group_a] == ends_a, common[group_b] == ends_b
        shown[np.arange(len(ids_a)) + before_b[group_a]] = self._shown_a[ids_a + last_a * len(self._bytes_a)]
        shown[np.arange(len(ids_b)) + until_a[group_b]] = self._shown_b[ids_b + last_b * len(self._bytes_b)]
        cuts = [np.searchsorted(found, word_ends, side="right") for found in (ends_a, ends_b, common, ends)]
        counts = [np.diff(cut, prepend=0) for cut in cuts]
        parts = shown.tolist()
        at = [0, *(cuts[0] + cuts[1]).tolist()]
        texts = ["".join(parts[i:j]) for i, j in zip(at, at[1:], strict=False)]
        good = np.column_stack([*counts[:3], np.zeros(len(words), dtype=np.int64)])
        table.add(words, texts, good, links, counts[3])

    def whole_texts(self, texts: list[str]) -> list[tuple]:
        """Of each text, from its begin to its end: n_a, n_b, n_groups, groups, its
        pairs and how often they are linked; None for texts that are not given back."""
        split = [_SPLIT.split(text) for text in texts]
        table = self._known
        if len(table.texts) > _CACHED_WORDS or len(table.links) > _CACHED_LINKS:
            self.forget()
            table = self._known
        new = {word for words in split for word in words if word not in table.index}
        if new:
            self._learn(list(new), table)
        found: list = []
        for words in split:
            numbers = np.array([table.index[word] for word in words])
            n_a, n_b, n_groups, bad = table.counts[numbers].sum(axis=0).tolist()
            if bad:
                found.append(None)
                continue
            groups = "".join([table.texts[n] for n in numbers.tolist()])[:-1]
            pairs, times = np.unique(table.links_of(numbers), return_counts=True)
            found.append((n_a, n_b, n_groups, groups, pairs, times))
        return found

    def stretch(self, text: str, begin: int, low: int, high: int) -> Fragment:
        """The fragment of bytes ``low`` to ``high`` of a space and a text, of which
        ``text`` is the part of whole words around, from byte ``begin`` on."""
        words = _SPLIT.split(text)
        end = begin + 1 + len(text.encode())
        cut_first = low > begin
        cut_last = high < end and not (cut_first and len(words) == 1)
        total = self._within(words[0], begin, low, high) if cut_first else Fragment()
        inner = words[int(cut_first) : len(words) - int(cut_last)]
        if inner:
            (found,) = self.whole_texts([" ".join(inner)])
            if found is None:
                return Fragment(broken=True)
            links = dict(zip(found[4].tolist(), found[5].tolist(), strict=True))
            total = total + Fragment(True, n_a=found[0], n_b=found[1], n_groups=found[2], groups=[found[3]], links=links)
        if cut_last:
            total = total + self._within(words[-1], end - 1 - len(words[-1].encode()), low, high)
        return total

    def _within(self, word: str, at: int, low: int, high: int) -> Fragment:
        ((a, b, same),) = self.tokens([word])
        if not same:
            return Fragment(broken=True)
        a, b = ([(n, at + end) for n, end in own if low < at + end <= high] for own in (a, b))
        return Fragment.of(a, b)


def _with_ends(ids: list[int], parts: list[bytes]) -> Tokens:
    at, found = 0, []
    for n, part in zip(ids, parts, strict=True):
        at += len(part)
        found.append((n, at))
    return found


def _byte_characters() -> dict[int, str]:
    """The characters that stand for bytes in a byte-level vocabulary: those that can
    be printed for themselves, the others from U+0100 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in shown]
    return {byte: chr(byte) for byte in shown} | {byte: chr(0x100 + n) for n, byte in enumerate(others)}


def _word_around(text: str, place: int) -> tuple[int, int]:
    """Begin and end of the word (with the space before it) that holds ``place``."""

    def starts_word(at: int) -> bool:
        return text[at] == " " and not text[at - 1].isspace() and not text[at + 1].isspace()

    begin = place
    while begin > 0 and not (0 < begin < len(text) - 1 and starts_word(begin)):
        begin = text.rfind(" ", 0, begin)
        begin = max(begin, 0)
    end = text.find(" ", place + 1)
    while end >= 0 and not (end < len(text) - 1 and starts_word(end)):
        end = text.find(" ", end + 1)
    return begin, len(text) if end < 0 else end


def ranges_of(text: str, size: int) -> Iterator[tuple[int, int, int, str]]:
    """Byte ranges of a space and the text: (begin of the words, low, high, words). Cut
    every ``size`` code points; a cut within a word longer than that moves to its end."""
    cuts = [0]
    around = [(0, 0)]
    place = size
    while place < len(text):
        begin, end = _word_around(text, place)
        if end - begin > size:
            place = begin = end
        if place < len(text):
            cuts.append(place)
            around.append((begin, end))
        place += size
    cuts.append(len(text))
    around.append((len(text), len(text)))
    offset = [0] * len(cuts)
    for n in range(1, len(cuts)):
        offset[n] = max(offset[n - 1], 1) + len(text[cuts[n - 1] : cuts[n]].encode())
    for n in range(len(cuts) - 1):
        begin, end = around[n][0], around[n + 1][1]
        first = offset[n] - len(text[begin : cuts[n]].encode())
        words = text[begin:end]
        yield first, offset[n], offset[n + 1], words[1:] if begin else words


_FRAGMENT = (
    "bounded boolean, broken boolean, n_a long, n_b long, n_groups long, groups string, "
    "head_a array<long>, head_a_ends array<long>, head_b array<long>, head_b_ends array<long>, "
    "tail_a array<long>, tail_a_ends array<long>, tail_b array<long>, tail_b_ends array<long>, "
    "pairs array<long>, times array<long>"
)
_COLUMNS = [column.split()[0] for column in _FRAGMENT.split(", ")]


def _sorted_links(links: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.fromiter(links.keys(), dtype=np.int64, count=len(links))
    times = np.fromiter(links.values(), dtype=np.int64, count=len(links))
    order = np.argsort(pairs)
    return pairs[order], times[order]


def _row(fragment: Fragment) -> tuple:
    sides = [
        [part[at] for part in side]
        for tokens in (fragment.head, fragment.tail)
        for side in tokens
        for at in (0, 1)
    ]
    head = (fragment.bounded, fragment.broken, fragment.n_a, fragment.n_b, fragment.n_groups)
    return (*head, ";".join(fragment.groups), *sides, *_sorted_links(fragment.links))


def _fragment(row: tuple) -> Fragment:
    sides = [list(zip(row[n].tolist(), row[n + 1].tolist(), strict=True)) for n in (6, 8, 10, 12)]
    return Fragment(
        bounded=row[0], broken=row[1], n_a=row[2], n_b=row[3], n_groups=row[4], groups=[row[5]] if row[5] else [],
        head=(sides[0], sides[1]), tail=(sides[2], sides[3]),
        links=dict(zip(row[14].tolist(), row[15].tolist(), strict=True)),
    )


def _joined(rows: pd.DataFrame) -> Fragment:
    total = Fragment()
    for row in rows.sort_values("no")[_COLUMNS].itertuples(index=False, name=None):
        total = total + _fragment(row)
    return total


_ALIGNED = "n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<long>, times array<long>"


def _finished(fragment: Fragment) -> tuple:
    """Of a text whose begin the fragment holds."""
    if fragment.broken or fragment.tail[0] or fragment.tail[1]:
        return _result(None)
    return _result(
        (fragment.n_a, fragment.n_b, fragment.n_groups, ";".join(fragment.groups), *_sorted_links(fragment.links))
    )


def _result(found: tuple | None) -> tuple:
    if found is None or not found[0]:
        return 0, 0, 0, "", _NONE, _NONE
    n_a, n_b, n_groups, groups, pairs, times = found
    return n_a, n_b, n_groups, hashlib.sha256(groups.encode()).hexdigest(), pairs, times


def aligned(
    documents: DataFrame, *, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text", size: int = RANGE
) -> DataFrame:
    """One row per document: ``row`` (its number), doc_id, n_a, n_b, n_groups,
    groups_sha256, and its linked pairs (A id * 2**32 + B id) with how often. Staged."""
    kind = documents.schema[doc_id].dataType.simpleString()
    name = f"pair:{path_a}:{path_b}"
    docs = small_batches(documents).select(
        F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text")
    )
    long = F.coalesce(F.char_length("text") > size, F.lit(False))

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = kept_in_process(name, lambda: Pair(path_a, path_b))
        for batch in batches:
            texts = batch.column("text").to_pylist()
            found = iter(tokenizers.whole_texts([one for one in texts if one]))
            rows = [_result(next(found)) if one else _result(None) for one in texts]
            columns = list(zip(*rows, strict=True))
            kinds = [pa.int64()] * 3 + [pa.string()] + [pa.list_(pa.int64())] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), *map(pa.array, columns, kinds)],
                names=["row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times"],
            ) if rows else batch.slice(0, 0)
        tokenizers.forget()
        give_back_memory(keep=name)

    short = docs.filter(~long).mapInArrow(align, f"row long, doc_id {kind}, {_ALIGNED}")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row, one in zip(batch["row"], batch["text"], strict=True):
                for no, part in enumerate(ranges_of(one, size)):
                    yield pd.DataFrame([(row, no, *part)], columns=["row", "no", "first", "low", "high", "words"])

    def align_range(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizers = kept_in_process(name, lambda: Pair(path_a, path_b))
        for batch in batches:
            rows = [
                (row, no, *_row(tokenizers.stretch(words, first, low, high)))
                for row, no, first, low, high, words in batch.itertuples(index=False, name=None)
            ]
            yield pd.DataFrame(rows, columns=["row", "no", *_COLUMNS])
        give_back_memory(keep=name)

    texts = staged(docs.filter(long), "long-texts")  # also tells whether there are any
    parts = texts.select("row", "text").mapInPandas(cut, "row long, no long, first long, low long, high long, words string")
    parts = parts.repartition("row", "no").mapInPandas(align_range, f"row long, no long, {_FRAGMENT}")
    parts = staged(parts, "fragments")
    last = parts.agg(F.max("no")).first()[0] or 0

    def join(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(*key, *_row(_joined(rows)))], columns=["row", "no", *_COLUMNS])

    while last > 0:
        up = parts.withColumn("up", F.floor(F.col("no") / _FAN))
        parts = staged(up.groupBy("row", "up").applyInPandas(join, f"row long, no long, {_FRAGMENT}"), "fragments")
        last //= _FAN

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [_finished(BEGIN + _fragment(row)) for row in batch[_COLUMNS].itertuples(index=False, name=None)]
            found = pd.DataFrame(rows, columns=["n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times"])
            yield pd.concat([batch[["row"]].reset_index(drop=True), found], axis=1)

    ends = parts.select("row", *_COLUMNS).mapInPandas(finish, f"row long, {_ALIGNED}")
    ends = texts.select("row", "doc_id").join(ends, "row")
    # Both branches number the rows of one scan; the last bit keeps them apart for certain.
    numbered = [rows.withColumn("row", F.col("row") * 2 + n) for n, rows in enumerate((short, ends))]
    return staged(numbered[0].unionByName(numbered[1]), "aligned")


def pair_counts(found: DataFrame) -> DataFrame:
    """How many documents hold each pair, and whether that is the most of its A id."""
    counts = found.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    own = Window.partitionBy(F.shiftright("pair", 32))  # at most one row per B id
    return staged(counts.withColumn("best", F.col("n") == F.max("n").over(own)), "pair-counts")


def most_frequent(counts: DataFrame, held: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The pairs of at least so many documents, at most ``held`` of them, by pair."""
    sizes = counts.groupBy(F.floor(F.log2("n")).alias("k")).count().collect()  # one row per power of two
    least, total = 0, sum(row["count"] for row in sizes)
    for row in sorted(sizes, key=lambda row: row["k"]):
        if total > held:
            total -= row["count"]
            least = 1 << (row["k"] + 1)
    kept = counts.filter(F.col("n") >= least).toPandas().sort_values("pair")
    return kept["pair"].to_numpy(np.int64), kept["n"].to_numpy(np.int64), kept["best"].to_numpy(bool), least


def scored(found: DataFrame, *, held: int = 200_000) -> DataFrame:
    """What ``aligned`` gave, with n_links, n_best and count_sum in place of the pairs."""
    counts = pair_counts(found)
    pairs, documents, best, least = most_frequent(counts, held)
    known = found.sparkSession.sparkContext.broadcast((pairs, documents, best))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, documents, best = known.value
        for batch in batches:
            own, times = batch.column("pairs").flatten().to_numpy(), batch.column("times").flatten().to_numpy()
            lengths = np.diff(batch.column("pairs").offsets.to_numpy())
            row = np.repeat(np.arange(len(batch)), lengths)
            at = np.minimum(np.searchsorted(pairs, own), max(len(pairs) - 1, 0))
            hit = pairs[at] == own if len(pairs) else np.zeros(len(own), dtype=bool)
            at = at[hit]

            def summed(values: np.ndarray, rows: np.ndarray, n: int = len(batch)) -> pa.Array:
                total = np.zeros(n, dtype=np.int64)
                np.add.at(total, rows, values)
                return pa.array(total)

            rest = np.concatenate([[0], np.cumsum(np.bincount(row[~hit], minlength=len(batch)))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(name) for name in ("row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256")),
                    summed(times, row),
                    summed(times[hit] * best[at], row[hit]),
                    summed(times[hit] * documents[at], row[hit]),
                    pa.ListArray.from_arrays(pa.array(rest), pa.array(own[~hit])),
                    pa.ListArray.from_arrays(pa.array(rest), pa.array(times[~hit])),
                ],
                names=[*plain, "n_links", "n_best", "count_sum", "pairs", "times"],
            )
        give_back_memory()

    plain = ["row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256"]
    kind = found.schema["doc_id"].dataType.simpleString()
    shape = f"row long, doc_id {kind}, n_a long, n_b long, n_groups long, groups_sha256 string, n_links long, "
    shape += "n_best long, count_sum long, pairs array<long>, times array<long>"
    summed = staged(found.mapInArrow(score, shape), "links")
    rare = summed.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select("row", "link.*")
    rare = rare.withColumnsRenamed({"pairs": "pair"}).join(counts.filter(F.col("n") < least), "pair")
    rare = rare.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("times") * F.col("n")).alias("more_sum"),
    )
    more = [F.coalesce(name, F.lit(0)) for name in ("more_best", "more_sum")]
    return summed.drop("pairs", "times").join(rare, "row", "left").select(
        *plain, "n_links", (F.col("n_best") + more[0]).alias("n_best"), (F.col("count_sum") + more[1]).alias("count_sum")
    )


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of the two tokenizers over every document."""
    found = aligned(
        table(spark, sf_dir, "documents"),
        path_a=public_tokenizers.path("byte_bpe_50k.json"),
        path_b=public_tokenizers.path("piece_bpe_32k.model"),
    )
    return scored(found).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
