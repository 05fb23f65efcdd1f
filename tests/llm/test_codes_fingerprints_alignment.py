"""Vector codes, document fingerprints and tokenizer alignment against brute force."""

import hashlib
import random
from collections import Counter
from functools import reduce

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as driver
from marketlens.llm import alignment, codes, fingerprints, queries

DOC = "doc_id long, text string, lang string"


def clashing(rows):
    """Columns with the names that the operators use inside or give out."""
    names = ["row", "no", "part", "edge", "tie", "nth", "pairs", "code", "error", "vector", "fingerprint", "key", "m0"]
    return rows.withColumns({name: F.lit("x") for name in names})


# ------------------------------------------------------------------ vector codes


def nearest(points, entries):
    far = ((points[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
    return far.argmin(axis=1), far.min(axis=1)


@pytest.mark.parametrize(("entries", "width", "spread"), [(64, 4, 40), (64, 4, 2), (5, 1, 2), (1, 2, 5), (100, 3, 9)])
def test_orchard_search_is_exact(entries, width, spread):
    rng = np.random.default_rng(entries)
    points = rng.integers(-spread, spread, (3000, width))
    book = rng.integers(-spread, spread, (entries, width))  # repeated entries and ties among them
    search = codes.OrchardSearch(book)
    index, far = search.nearest(points)
    expected, distance = nearest(points, book)
    assert (index == expected).all() and (far == distance).all()
    assert search.measured <= points.shape[0] * entries
    assert entries < 64 or search.measured < 0.6 * points.shape[0] * entries


def brute_codes(rows, parts, entries, rounds):
    """rows: (id, vector) in order of ids."""
    vectors = np.array([np.floor(np.array(v, dtype=np.float64) * 256) for _, v in rows], dtype=np.int64)
    cells = vectors.reshape(len(rows), parts, -1)
    books = [cells[:entries, p].copy() for p in range(parts)]
    for _ in range(rounds):
        for p in range(parts):
            index, _ = nearest(cells[:, p], books[p])
            for entry in set(index.tolist()):
                own = cells[index == entry, p]
                books[p][entry] = own.sum(axis=0) // len(own)
    ends = [nearest(cells[:, p], books[p]) for p in range(parts)]
    shown = ["".join(f"{ends[p][0][k]:02x}" for p in range(parts)) for k in range(len(rows))]
    return shown, sum(far for _, far in ends).tolist(), np.array(books)


def test_codes_of_odd_tables(spark):
    rng = random.Random(4)
    rows = [(k, [rng.uniform(-1, 1) for _ in range(8)], k % 3 or None) for k in range(120)]
    rows += [(7, rows[7][1], 1), (None, rows[9][1], None)]  # an id again, no id
    bad = [
        (200, None, 1), (201, [], 1), (202, [0.5] * 7 + [None], 1), (203, [float("nan")] * 8, 1),
        (204, [float("inf")] * 8, 1), (205, [0.5] * 12, 1), (206, [1e9] * 8, 1), (-1, [0.5] * 7, 2),
    ]
    table = clashing(spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, label int"))
    found, books = codes.compressed(table, parts=4, entries=16, rounds=2)
    kept = sorted([r for r in rows if r[0] is not None], key=lambda r: (r[0], r[1])) + [rows[-1]]
    kept = [(k, np.array(v, dtype=np.float32)) for k, v, _ in kept]
    shown, errors, expected = brute_codes(kept, 4, 16, 2)
    got = sorted(((r.vec_id is None, r.vec_id or 0), r.code, r.error) for r in found.collect())
    assert got == sorted(((k is None, k or 0), c, e) for (k, _), c, e in zip(kept, shown, errors, strict=True))
    assert (books == expected).all()


def test_codes_of_empty_and_small_tables(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<double>, label string")
    assert codes.compressed(empty)[0].collect() == []
    few = spark.createDataFrame([(1, [0.25] * 16, "a"), (2, [-0.3] * 16, None)], empty.schema)
    found, books = codes.compressed(few)
    assert sorted((r.vec_id, r.code, r.error) for r in found.collect()) == [(1, "00" * 16, 0), (2, "01" * 16, 0)]
    assert books.shape == (16, 2, 1)


def test_codes_against_sql(spark, sf_dir):
    connection = duckdb.connect()
    connection.execute(f"create view embeddings as select * from '{sf_dir}/embeddings.parquet'")
    expected = connection.execute(queries.oracle_sql()["op11_vector_codes"])
    names = [column[0] for column in expected.description]
    found = driver.queries()["op11_vector_codes"](spark, sf_dir).select(*names)
    assert sorted(map(tuple, found.collect())) == sorted(expected.fetchall())


# ------------------------------------------------------------------ fingerprints


def prefixes(text):
    values = [0]
    for k, character in enumerate(text):
        term = (ord(character) + 1) * pow(fingerprints.BASE, k, fingerprints.MODULUS)
        values.append((values[-1] + term) % fingerprints.MODULUS)
    return values


@pytest.mark.parametrize("length", [0, 1, 31, 32, 33, 65, 999, 32_767, 32_768, 32_769, 70_001])
def test_prefix_values(length):
    rng = random.Random(length)
    text = "".join(rng.choice("abé漢😀\x00 ") for _ in range(length))
    hashing, expected = fingerprints.Hashing(), prefixes(text)
    assert fingerprints.PrefixHashes(text, hashing).values == expected
    n, values = fingerprints.parsed(fingerprints.fingerprint(text, hashing))
    assert n == length and values == {p: expected[p] for p in [0, *fingerprints.checkpoints_of(length)]}
    assert len(values) <= 1 + 2 * fingerprints.CHECKPOINTS + 1


@settings(max_examples=60, deadline=None)
@given(st.text("ab", max_size=40), st.text("ab", max_size=40), st.integers(0, 40), st.integers(0, 40))
def test_spans_and_extensions(a, b, i, j):
    i, j = min(i, len(a)), min(j, len(b))
    own, other = fingerprints.PrefixHashes(a), fingerprints.PrefixHashes(b)
    longest = 0
    while i + longest < len(a) and j + longest < len(b) and a[i + longest] == b[j + longest]:
        longest += 1
    assert own.common_extension(i, other, j) == longest
    for length in range(0, max(len(a), len(b)) + 2):
        same = i + length <= len(a) and j + length <= len(b) and a[i : i + length] == b[j : j + length]
        assert own.equal(i, other, j, length) == same


def brute_likeness(a, b):
    """Spans between common checkpoints, compared as text from both ends."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    step = max(fingerprints.step_of(len(a)), fingerprints.step_of(len(b)))
    in_a, in_b = set(), set()
    for k in range(0, min(len(a), len(b)) - step + 1, step):
        if a[k : k + step] == b[k : k + step]:
            in_a.update(range(k, k + step))
            in_b.update(range(k, k + step))
        i, j = len(a) - k, len(b) - k
        if a[i - step : i] == b[j - step : j]:
            in_a.update(range(i - step, i))
            in_b.update(range(j - step, j))
    return min(len(in_a), len(in_b)) / max(len(a), len(b))


def test_likeness_of_edits():
    rng = random.Random(8)
    hashing = fingerprints.Hashing()

    def likeness(a, b):
        return fingerprints.likeness(*(fingerprints.parsed(fingerprints.fingerprint(t, hashing)) for t in (a, b)))

    for n in (1, 5, 30, 33, 100, 1000, 3333):
        text = "".join(rng.choice("abcdefgh ") for _ in range(n))
        other = "".join(rng.choice("abcdefgh ") for _ in range(n // 2 + 3))
        at = rng.randrange(n)
        for changed in (text, other, text[:at] + "XY" + text[at:], text[:at] + "X" + text[at + 1 :], text[at:], "",
                        fingerprints.edited(text, other), other + text):
            assert likeness(text, changed) == likeness(changed, text) == pytest.approx(brute_likeness(text, changed))
        if n >= 100:
            assert likeness(text, fingerprints.edited(text, "Z" * n)) > 2 / 3 - 1 / 16
            assert likeness(text, text[:at] + "XYZ" + text[at:]) > 1 - 2 / 16
            assert likeness(text, other) < 0.2


def brute_fingerprints(rows):
    """rows: (id, text) in order; the measures of each with the next, in a ring."""
    hashing = fingerprints.Hashing()
    found = []
    for k, (own, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1] or ""
        text = text or ""
        third = len(text) // 3
        changed = text[: len(text) - third] + following[:third]
        prints = [fingerprints.fingerprint(t, hashing) for t in (text, changed)]
        likeness = [round(brute_likeness(text, t), 9) for t in (changed, following)]
        found.append((own, len(text), hashlib.sha256(changed.encode()).hexdigest(), *prints, *likeness))
    return found


def shown(found):
    rows = found.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    return sorted((*r[:5], round(r[5], 9), round(r[6], 9)) for r in rows.collect())


def test_fingerprints_over_many_ranges(spark):
    rng = random.Random(2)
    rows = [(k, " ".join(rng.choice(["red", "é漢", "blue", "😀"]) for _ in range(rng.randrange(90)))) for k in range(300)]
    rows += [(300, None), (301, ""), (302, "x" * 100_000), (303, rows[5][1]), (-4, "\x00\n")]
    rng.shuffle(rows)
    table = clashing(spark.createDataFrame([(*r, "en") for r in rows], DOC)).repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions in ("1", "23"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            assert shown(fingerprints.fingerprinted(table)) == sorted(brute_fingerprints(sorted(rows, reverse=True)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_fingerprints_of_odd_tables(spark):
    empty = spark.createDataFrame([], DOC)
    assert fingerprints.fingerprinted(empty).collect() == []
    one = spark.createDataFrame([(1, "abcdef", "en")], DOC)
    assert shown(fingerprints.fingerprinted(one)) == brute_fingerprints([(1, "abcdef")])
    # One row a thousand times: each follows itself, but for the last.
    hot = [(5, "the same words again", "en")] * 1000 + [(6, "other", "en"), (None, "no id", "en")]
    found = fingerprints.fingerprinted(spark.createDataFrame(hot, DOC)).collect()
    assert len(found) == 1002 and sum(r.near_next == 1.0 for r in found) == 999
    expected = brute_fingerprints([(6, "other"), (5, "the same words again"), (None, "no id")])
    assert {r.edited_sha256 for r in found if r.doc_id is None} == {expected[2][2]}


def test_fingerprint_query(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").toPandas()
    rows = sorted(zip(documents.doc_id.tolist(), documents.text.tolist(), strict=True), reverse=True, key=lambda r: r[0])
    found = driver.queries()["op12_document_fingerprints"](spark, sf_dir)
    assert shown(found) == sorted(brute_fingerprints(rows))


# ------------------------------------------------------------------ alignment

PATHS = {name: public_tokenizers.path(file) for name, file in (("a", "byte_bpe_50k.json"), ("b", "piece_bpe_32k.model"))}


@pytest.fixture(scope="module")
def tokenizers():
    first = Tokenizer.from_file(PATHS["a"])
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=PATHS["b"])


@pytest.fixture(scope="module")
def pair():
    return alignment.Pair(PATHS["a"], PATHS["b"])


def spans(parts):
    at, found = 0, []
    for part in parts:
        found.append((at, at + len(part)))
        at += len(part)
    return found


def brute_alignment(tokenizers, text):
    """Whole text encoded at once; every pair of ranges compared."""
    if not text:
        return 0, 0, 0, "", {}
    first, second = tokenizers
    byte_of = {character: byte for byte, character in alignment._byte_characters().items()}
    a = first.encode(" " + text, add_special_tokens=False)
    parts_a = [bytes(byte_of[c] for c in token) for token in a.tokens]
    b = second.encode(text)
    pieces = [second.id_to_piece(n) for n in b]
    parts_b = [
        bytes([int(piece[3:5], 16)]) if second.is_byte(n) else piece.replace("▁", " ").encode()
        for n, piece in zip(b, pieces, strict=True)
    ]
    if not b"".join(parts_a) == b"".join(parts_b) == (" " + text).encode():
        return 0, 0, 0, "", {}
    in_a, in_b = spans(parts_a), spans(parts_b)
    links = Counter(
        alignment.code_of(i, j)
        for i, (s, e) in zip(a.ids, in_a, strict=True)
        for j, (t, f) in zip(b, in_b, strict=True)
        if s < f and t < e
    )
    groups, since = [], 0
    for end in sorted({e for _, e in in_a} & {e for _, e in in_b}):
        sides = ([str(n) for n, (_, e) in zip(ids, found, strict=True) if since < e <= end] for ids, found in ((a.ids, in_a), (b, in_b)))
        groups.append("|".join(",".join(side) for side in sides))
        since = end
    return len(a.ids), len(b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest(), dict(links)


def plain(result):
    return (*result[:4], dict(zip(result[4].tolist(), result[5].tolist(), strict=True)))


PARTS = [*"abc de  it's\n\t.,!1 2é漢字😀ﬁ１", "</s>", "<0x41>", " <|endoftext|> ", " ", " ", "ing", "tion ", "\x1c", "\x85", "\x00"]


def test_texts_and_ranges_against_brute_force(tokenizers, pair):
    rng = random.Random(3)
    for n in range(150):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randrange(1, 60))) + "▁" * (n % 25 == 0)
        expected = brute_alignment(tokenizers, text)
        assert plain(alignment._result(pair.whole_texts([text])[0])) == expected, text
        for size in (1, 3, 7, 40):
            parts = [pair.stretch(words, *at) for *at, words in alignment.ranges_of(text, size)]
            total = reduce(lambda x, y: x + y, parts, alignment.BEGIN)
            assert plain(alignment._finished(total)) == expected, (text, size)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=12), st.lists(st.integers(1, 4), max_size=12), st.lists(st.integers(0, 50), max_size=6))
def test_fragments_are_a_monoid(sizes_a, sizes_b, cuts):
    sizes_b = [*sizes_b, max(1, sum(sizes_a) - sum(sizes_b))]
    sizes_a = [*sizes_a, max(1, sum(sizes_b) - sum(sizes_a))]
    a, b = ([(k, sum(sizes[: k + 1])) for k in range(len(sizes))] for sizes in (sizes_a, sizes_b))
    edges = [0, *sorted(cuts), 1000]
    parts = [
        alignment.Fragment.of([t for t in a if low < t[1] <= high], [t for t in b if low < t[1] <= high])
        for low, high in zip(edges, edges[1:], strict=False)
    ]

    def view(fragment):
        return {**vars(fragment), "groups": ";".join(fragment.groups)}

    left = reduce(lambda x, y: x + y, parts)
    right = reduce(lambda x, y: y + x, reversed(parts))
    assert view(left) == view(right) == view(alignment.Fragment.of(a, b))
    assert view(alignment.Fragment() + left) == view(left) == view(left + alignment.Fragment())


def brute_scores(found):
    """found: (id, result of brute_alignment) of every document."""
    counts = Counter(pair for _, (*_, links) in found for pair in links)
    best = {}
    for pair, n in counts.items():
        best[pair >> 32] = max(best.get(pair >> 32, 0), n)
    return sorted(
        (own or 0, n_a, n_b, n_groups, sum(links.values()),
         sum(t for p, t in links.items() if counts[p] == best[p >> 32]), sum(t * counts[p] for p, t in links.items()), digest)
        for own, (n_a, n_b, n_groups, digest, links) in found
    )


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def scores(found):
    return sorted((r[0] or 0, *r[1:]) for r in found.select(*COLUMNS).collect())


@pytest.mark.parametrize("held", [0, 40, 100_000])
def test_alignment_of_odd_tables(spark, tokenizers, held):
    rng = random.Random(6)
    texts = [None, "", " ", "one", "a ▁ b", "\x00é ok", "x" * 300, "漢字" * 100]
    texts += ["".join(rng.choice(PARTS) for _ in range(rng.randrange(1, 400))) for _ in range(30)]
    texts += [texts[-1]] * 3
    rows = [*enumerate(texts, 1), (None, "no id")]
    table = clashing(spark.createDataFrame([(*r, "en") for r in rows], DOC))
    found = alignment.aligned(table, path_a=PATHS["a"], path_b=PATHS["b"], size=25)  # ranges of 25: five levels of joins
    expected = brute_scores([(own, brute_alignment(tokenizers, text)) for own, text in rows])
    assert scores(alignment.scored(found, held=held)) == expected


def test_alignment_of_an_empty_table(spark):
    found = alignment.aligned(spark.createDataFrame([], DOC), path_a=PATHS["a"], path_b=PATHS["b"])
    assert alignment.scored(found).collect() == []


def test_alignment_query(spark, sf_dir, tokenizers):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").toPandas()
    documents = documents[documents.text.fillna("").str.len() < 3000]
    found = driver.queries()["op13_tokenizer_alignment"](spark, sf_dir).toPandas().set_index("doc_id")
    for own, text in zip(documents.doc_id, documents.text, strict=True):
        n_a, n_b, n_groups, digest, links = brute_alignment(tokenizers, text)
        row = found.loc[own]
        assert (row.n_a, row.n_b, row.n_groups, row.n_links, row.groups_sha256) == (n_a, n_b, n_groups, sum(links.values()), digest)
    assert (found.n_best <= found.n_links).all() and (found.count_sum >= found.n_links).all()
