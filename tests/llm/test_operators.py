"""Each operator against a brute-force version, and its edge cases."""

import collections
import hashlib
import html as markup
import random
import re

import numpy as np
import pytest
import regex
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.llm import (
    chat,
    decontamination,
    language,
    licenses,
    neighbours,
    packing,
    pages,
    quality,
    simhash,
    substrings,
)

DOC = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "red blue green stone river cloud paper lamp chair wolf honey winter table glass".split()


def prose(rng, n, words=WORDS):
    return " ".join(rng.choice(words) + str(rng.randrange(40)) for _ in range(n))


def docs(spark, rows):
    return spark.createDataFrame(
        [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOC
    )


def edge_docs(spark):
    """Null, empty, blank, one word, very long, repeated whole, null id."""
    rng = random.Random(5)
    long = prose(rng, 30_000)
    return docs(
        spark,
        [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, long), (5, long), (None, "two words"), (6, "\x00é ok")],
    )


def clashing(rows):
    """Columns with the names that operators use inside or give out."""
    names = ["kept", "fp", "score", "n_words", "row", "key", "h1", "part", "_marked", "hash", "words", "raw", "root", "l0"]
    return rows.withColumns({name: F.lit("x") for name in names})


# ------------------------------------------------------------------ simhash


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    runs = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    counts = [0] * 64
    for run in runs:
        digest = xxhash.xxh64_intdigest(run.encode(), 42)
        for bit in range(64):
            counts[bit] += digest >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * counts[bit] > len(runs))


def brute_components(prints, ids, radius):
    root = list(range(len(prints)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    least = {}
    for i, key in enumerate(ids):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return [least.get(find(i)) for i in range(len(prints))]


def test_components_match_brute_force(spark):
    rng = random.Random(1)
    texts = [prose(rng, 200) for _ in range(20)]
    for k in range(40):
        words = texts[k % 7].split()
        words[rng.randrange(len(words))] = "changed"
        texts.append(" ".join(words))
    texts += [texts[0].upper(), None, "", "a b", "A  b"]
    rows = [(1000 - n, text) for n, text in enumerate(texts)]
    found = {r.doc_id: r for r in simhash.components(docs(spark, rows)).collect()}
    prints = [brute_fingerprint(text) for _, text in rows]
    assert [found[i].fp % (1 << 64) for i, _ in rows] == prints
    assert [found[i].component_id for i, _ in rows] == brute_components(prints, [i for i, _ in rows], 2)


def test_chains_and_stars_of_links(spark):
    chain = [(k, k + 1) for k in range(40)]
    star = [(100, k) for k in range(101, 160)]
    edges = spark.createDataFrame(chain + star + [(-5, 40)], "a long, b long")
    roots = {r.node: r.root for r in simhash.connected(edges).collect()}
    assert {roots[k] for k in range(41)} == {-5}
    assert {roots[k] for k in range(101, 160)} == {100}


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_links_connect_all_pairs_within_the_radius(spark, radius):
    rng = random.Random(radius)
    prints = {2, 3, 8, 10, 0, (1 << 63) | 1}
    for _ in range(40):
        start = rng.getrandbits(64)
        for _ in range(4):
            prints.add(start)
            for _ in range(rng.randrange(1, radius + 2)):
                start ^= 1 << rng.randrange(64)
    prints = sorted(prints)
    table = spark.createDataFrame([(simhash._signed(p),) for p in prints], "fp long")
    found = {(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.links(table, radius).collect()}
    assert all((a ^ b).bit_count() <= radius for a, b in found)
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in found:
        root[find(a)] = find(b)
    for i, a in enumerate(prints):
        for b in prints[:i]:
            assert (a ^ b).bit_count() > radius or find(a) == find(b)


def test_ids_repeated_with_unrelated_texts_stay(spark):
    rng = random.Random(9)
    texts = [prose(rng, 50) for _ in range(5)]
    rows = docs(spark, [(1, texts[0]), (1, texts[1]), (2, texts[2]), (None, texts[3]), (None, texts[4]), (3, texts[2])])
    kept = simhash.drop_near_duplicates(rows).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept) == sorted(
        [("1", texts[0]), ("1", texts[1]), ("2", texts[2]), ("None", texts[3]), ("None", texts[4])]
    )


def test_one_document_of_each_group_stays(spark):
    rows = docs(spark, [(3, "a b c d"), (1, "a b c d"), (1, "a b c d"), (2, "other words here now"), (None, "third text")])
    kept = simhash.drop_near_duplicates(clashing(rows))
    assert kept.columns == clashing(rows).columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == ["1", "2", "None"]


# --------------------------------------------------------------- substrings


def brute_removed(texts, length):
    split = [(t or "").encode().split() for t in texts]
    counts = collections.Counter(
        tuple(w[i : i + length]) for w in split for i in range(len(w) - length + 1)
    )
    answers = []
    for words in split:
        gone = set()
        for i in range(len(words) - length + 1):
            if counts[tuple(words[i : i + length])] > 1:
                gone.update(range(i, i + length))
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone).decode()
        answers.append((kept, len(words), len(gone)))
    return answers


@pytest.mark.parametrize("length", [35, 7, 2])
def test_removed_words_match_brute_force(spark, length):
    rng = random.Random(length)
    passage = prose(rng, 60)
    texts = [prose(rng, rng.randrange(1, 120)) for _ in range(30)]
    texts += [f"{prose(rng, 9)} {passage} {prose(rng, 9)}" for _ in range(5)]
    texts += [" ".join(passage.split()[k : k + 36 + k]) for k in range(6)]
    texts += ["same " * 90, texts[3], texts[3], passage + " " + passage, None, "", "a b c"]
    found = substrings.without_repeats(docs(spark, list(enumerate(texts))), length=length)
    found = {r.doc_id: (r.kept, r.n_words, r.n_removed) for r in found.collect()}
    assert [found[k] for k in range(len(texts))] == brute_removed(texts, length)


def test_cut_documents_keep_their_columns(spark):
    rng = random.Random(2)
    passage = prose(rng, 50)
    rows = clashing(docs(spark, [(1, "  first\n" + passage), (2, passage + " last"), (3, "left  as it is"), (4, passage)]))
    kept = substrings.drop_repeats(rows)
    assert kept.schema == rows.schema
    assert {r.doc_id: (r.text, r.n_chars) for r in kept.collect()} == {
        1: ("first", 5),
        2: ("last", 4),
        3: ("left  as it is", 14),
    }


def test_passages_are_cut_out_once(spark):
    passage = " ".join(f"w{k}" for k in range(35))
    rows = docs(spark, [(1, "first " + passage), (2, passage + " last")]).withColumn("n_chars", F.char_length("text"))
    plan = substrings.drop_repeats(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


# --------------------------------------------------------------- decontamination


ITEMS = [
    (1, "A farmer named Olga sells 12 apples and Peter buys 7 kg of them on a cold Monday in the village market square."),
    (2, "Which of the following rivers flows through the largest number of countries before it reaches the open sea today"),
    (3, "too short"),
    (4, None),
]


def found_items(spark, texts):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = decontamination.contaminated(docs(spark, list(enumerate(texts))), bench).collect()
    return {(r.doc_id, r.item_id): r.changed for r in rows}


def test_items_are_found_wherever_they_stand(spark):
    rng = random.Random(3)
    texts = [f"{prose(rng, k)} {ITEMS[1][1].upper()} {prose(rng, 11)}" for k in range(12)]
    texts += [prose(rng, 300), None, "", "too short"]
    # An item of two words is found where it is the whole text.
    assert found_items(spark, texts) == {(k, 2): False for k in range(12)} | {(15, 3): False}


def test_items_without_evidence_are_found_word_for_word(spark):
    items = [(1, "Yes."), (2, "17 23 42 99"), (3, "Anna Berta Carla Dora"), (4, "?!"), (5, "")]
    texts = ["yes", "Yes or no", "Count 17, 23, 42 and 99.", "Count 17, 23, 42, 99 now.", "Count 17, 23, 42, 98 now.",
             "So said Anna, Berta, Carla, Dora.", "So said Anna, Berta, Carla, Emma.", "", None, "?!"]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.contaminated(docs(spark, list(enumerate(texts))), bench).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(0, 1), (3, 2), (5, 3)}


def test_other_numbers_and_names_are_found_if_consistent(spark):
    other = ITEMS[0][1].replace("Olga", "Maria").replace("12", "3.5").replace("7 kg", "1,200 km")
    partly = " ".join(ITEMS[1][1].split()[:14])
    twice = "The train with 5 cars left and 5 of its 5 doors were open when it came to the old bridge"
    bench = spark.createDataFrame([(9, twice)], "item_id long, text string")
    assert found_items(spark, [f"Before. {other} After.", partly]) == {(0, 1): True, (1, 2): False}
    texts = [twice.replace("5", "8"), twice.replace("5 of its 5", "6 of its 4")]
    rows = decontamination.contaminated(docs(spark, list(enumerate(texts))), bench).collect()
    assert {(r.doc_id, r.changed) for r in rows} == {(0, True)}


def test_windows_beyond_the_broadcast_bound_give_the_same(spark, monkeypatch):
    texts = [f"some words first {ITEMS[1][1]}", prose(random.Random(4), 80)]
    small = found_items(spark, texts)
    monkeypatch.setattr(decontamination, "BROADCAST_WINDOWS", 0)
    assert found_items(spark, texts) == small == {(0, 2): False}


def test_a_fifth_of_the_words_may_differ_anywhere(spark):
    rng = random.Random(6)
    item = ITEMS[1][1].split()
    texts = []
    for k in range(12):
        words = list(item)
        for at in rng.sample(range(len(words)), len(words) // 5):
            words[at] = f"other{chr(97 + at)}"
        texts.append(f"{prose(rng, k)} {' '.join(words)} {prose(rng, 7)}")
    short = "the old man went home with his three small brown dogs after the long dark rain".split()
    bench = spark.createDataFrame([(2, " ".join(item)), (5, " ".join(short[:15]))], "item_id long, text string")
    every_fourth = [f"w{chr(97 + k)}" if k % 4 == 3 else w for k, w in enumerate(short[:15])]
    texts.append(f"{prose(rng, 3)} {' '.join(every_fourth)} {prose(rng, 3)}")
    rows = decontamination.contaminated(docs(spark, list(enumerate(texts))), bench).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(k, 2) for k in range(12)} | {(12, 5)}


def test_words_put_in_or_left_out_are_judged_together(spark):
    words = ITEMS[1][1].split()
    texts = [" ".join([*words[:10], "really", *words[10:]]), " ".join([*words[:9], *words[10:]])]
    texts.append(" ".join([*words[:6], "very", "very", *words[6:12], *words[13:]]))
    texts.append(" ".join(reversed(words)))
    rng = random.Random(7)
    rows = [(k, f"{prose(rng, 4)} {t} {prose(rng, 4)}") for k, t in enumerate(texts)]
    bench = spark.createDataFrame(ITEMS[1:2], "item_id long, text string")
    found = decontamination.contaminated(docs(spark, rows), bench).collect()
    assert sorted(r.doc_id for r in found) == [0, 1, 2]
    # Slots are checked along the drift too.
    item = "The train with 5 cars left and 5 of its 5 doors were open when it came to the bridge"
    other = item.replace("left", "left really")
    texts = [other.replace("5", "8"), other.replace("5 of its 5", "6 of its 4")]
    bench = spark.createDataFrame([(9, item)], "item_id long, text string")
    found = decontamination.contaminated(docs(spark, list(enumerate(texts))), bench).collect()
    assert [(r.doc_id, r.changed) for r in found] == [(0, True)]


def test_short_items_and_unspaced_scripts_are_found_whole(spark):
    items = [(1, "What is the capital of France?"), (2, "中国的首都是哪座城市"), (3, "ประเทศไทยมีกี่จังหวัด"), (4, "Name 3 of 7 seas")]
    texts = [
        "Question: What is the capital of France? Paris.",
        "They asked what is the capital of a big country and left.",
        "他问我中国的首都是哪座城市，我说北京。",
        "他问我中国的城市。",
        "ถาม ประเทศไทยมีกี่จังหวัด ตอบ",
        "Please name 3 of 7 seas",
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.contaminated(docs(spark, list(enumerate(texts))), bench).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(0, 1), (2, 2), (4, 3), (5, 4)}


def _template(word):
    return "<num>" if word.isdigit() else "<name>" if word[0].isupper() else word


def _consistent(pairs):
    return len(set(pairs)) == len({(kind, asked) for kind, asked, _ in pairs})


def _slots(pairs):
    return [(_template(a), a, b) for a, b in pairs if _template(a).startswith("<")]


def _counts(pairs):
    return 2 * len(_slots(pairs)) <= len(pairs) and _consistent(_slots(pairs))


def _alone(doc, item):
    """Whether the item matches at some single alignment, by trying all."""
    for shift in range(-len(item), len(doc)):
        met = [(a, doc[j + shift] if 0 <= j + shift < len(doc) else "-") for j, a in enumerate(item)]
        best, run = [], []
        for a, b in met:
            run = [*run, (a, b)] if _template(a) == _template(b) else []
            best = run if len(run) > len(best) else best
        agree = sum(_template(a) == _template(b) for a, b in met)
        enough = len(best) >= min(13, len(item)) or (len(item) >= 9 and agree >= 0.8 * len(item))
        if enough and _counts(best):
            return True
    return False


def _in_order(doc, item):
    """Whether four fifths of the item's words stand in the document in order."""
    row = [0] * (len(doc) + 1)
    for a in item:
        before = 0
        for k, b in enumerate(doc, 1):
            before, row[k] = row[k], max(row[k], row[k - 1], before + (_template(a) == _template(b)))
    return row[-1] >= 0.8 * len(item)


@pytest.mark.parametrize("limit", [decontamination.BROADCAST_WINDOWS, 0])
def test_items_found_are_those_of_all_alignments(spark, monkeypatch, limit):
    monkeypatch.setattr(decontamination, "BROADCAST_WINDOWS", limit)
    rng = random.Random(12)
    words = "red fox sees old barn near wide lake while snow falls over tall pines".split()
    names = ["Olga", "Peter", "Maria", "Ivan"]

    def text(n):
        drawn = [rng.choice([*words, *words[:3], rng.choice(names), str(rng.randint(2, 9))]) for _ in range(n)]
        return [rng.choice(words), *drawn]  # the first word of a text is no name

    items = [text(rng.randint(8, 18)) for _ in range(12)]
    texts = []
    for k in range(60):
        asked = list(items[k % 12])
        for at in rng.sample(range(1, len(asked)), rng.randint(0, len(asked) // 3)):
            asked[at] = rng.choice(words)
        if k % 3 == 0:  # other names and numbers, each for its own or as they come
            new = {w: rng.choice(names) if w[0].isupper() else str(rng.randint(2, 9)) for w in asked}
            asked = [new[w] if _template(w).startswith("<") else w for w in asked]
        texts.append([*text(rng.randint(1, 9)), *asked, *text(rng.randint(0, 9))])
    bench = spark.createDataFrame([(k, " ".join(i)) for k, i in enumerate(items)], "item_id long, text string")
    table = docs(spark, [(k, " ".join(t)) for k, t in enumerate(texts)])
    found = {(r.doc_id, r.item_id) for r in decontamination.contaminated(table, bench).collect()}
    alone = {(d, i) for d, t in enumerate(texts) for i, item in enumerate(items) if _alone(t, item)}
    drifting = {(d, i) for d, t in enumerate(texts) for i, item in enumerate(items) if _in_order(t, item)}
    assert len(alone) > 25 and alone <= found <= alone | drifting


def test_common_openings_are_not_aligned(spark, monkeypatch):
    rng = random.Random(13)
    words = [f"w{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(500)]
    items = [(k, "what is the " + " ".join(rng.choices(words, k=12))) for k in range(40)]
    texts = [" ".join(f"what is the {rng.choice(words)}" for _ in range(60)) for _ in range(20)] + [items[5][1]]
    bench = spark.createDataFrame(items, "item_id long, text string")
    aligned, write = [], decontamination.staged

    def counted(rows, label):
        rows = write(rows, label)
        if label == "benchmark-alignments":
            aligned.append(rows.count())
        return rows

    monkeypatch.setattr(decontamination, "staged", counted)
    for limit in (decontamination.BROADCAST_WINDOWS, 0):
        monkeypatch.setattr(decontamination, "BROADCAST_WINDOWS", limit)
        found = decontamination.contaminated(docs(spark, list(enumerate(texts))), bench).collect()
        assert [(r.doc_id, r.item_id) for r in found] == [(20, 5)]
    assert len(aligned) == 2 and max(aligned) < 100  # 48 000 hits


def test_contaminated_documents_go(spark):
    rows = clashing(docs(spark, [(1, ITEMS[1][1]), (2, "clean"), (None, None), (2, "clean")]))
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = decontamination.drop_contaminated(rows, bench)
    assert kept.schema == rows.schema
    assert sorted(str(r.text) for r in kept.collect()) == ["None", "clean", "clean"]
    assert decontamination.drop_contaminated(rows, bench.limit(0)).count() == 4


# --------------------------------------------------------------------- chat


LOG = "conv_id long, message long, seq long, kind string, role string, text string"


def test_deltas_edits_and_regenerations_fold(spark):
    rows = [
        (1, 0, 1, "message", "user", "hi"),
        (1, 1, 3, "delta", None, " there"),
        (1, 1, 2, "message", "assistant", "hello"),
        (1, 1, 3, "delta", None, " there"),  # repeated whole
        (1, 0, 4, "edit", "user", "hi again"),
        (1, 1, 5, "regenerate", None, None),
        (1, 1, 6, "delta", None, "good "),
        (1, 1, 7, "delta", None, "day"),
        (None, None, None, None, None, None),
        (2, 0, 1, "delta", "assistant", "streamed"),
    ]
    events = spark.createDataFrame(rows, LOG)
    found = sorted((str(r.conv_id), r.position, r.role, r.text) for r in chat.fold_events(events).collect())
    assert found == [
        ("1", 1, "user", "hi again"),
        ("1", 2, "assistant", "good day"),
        ("2", 1, "assistant", "streamed"),
        ("None", 1, "", ""),
    ]
    assert chat.render(chat.fold_events(events.limit(0))).count() == 0


def test_formatting_reads_back(spark):
    rng = random.Random(6)
    parts = ["</s>\n", "<|", "|>\n", "[INST]", "\\", "\\l", "\\n", "<", "é\U0001f600", "text ", "\n", "'"]
    turns = [
        (c, k, rng.choice(["user", "assistant", "we|>\nird", None]), "".join(rng.choices(parts, k=rng.randrange(9))))
        for c in range(12)
        for k in range(rng.randrange(1, 6))
    ]
    rows = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    read = chat.read_back(chat.render(chat.fold_events(chat.conversation_events(rows)))).collect()
    for row in read:
        own = [(r or "", t) for c, _, r, t in turns if c == row.conv_id]
        assert [tuple(t) for t in row.turns] == own
        assert row.learned == [t for r, t in own if r == "assistant" and t]
        for span in row.loss_spans:
            assert row.formatted[span.turn_start :].startswith("<|")


# ----------------------------------------------------------------- language


def language_rows(spark, n=60):
    rng = random.Random(8)
    words = {"aa": "the and with from this that".split(), "bb": "der und mit von das nicht".split(), "cc": "и на не что".split()}
    rows = [(k, " ".join(rng.choices(words[lang], k=30)), lang) for k, lang in enumerate(list(words) * n)]
    return spark.createDataFrame(rows, "key long, text string, lang string")


def test_languages_are_told_apart(spark):
    rows = language_rows(spark)
    model = language.fit(rows, rows_per_language=20)
    found = language.identify(clashing(rows.withColumnRenamed("lang", "truth")).drop("score"), model).collect()
    assert all(r.lang_pred == r.truth and 0 < r.score <= 1 and not r.rejected for r in found)
    assert model.languages == ["aa", "bb", "cc"]


def test_texts_without_letters_and_far_texts_are_rejected(spark):
    model = language.fit(language_rows(spark))
    found = {r.text: r for r in language.identify(docs(spark, [(1, None), (2, ""), (3, "12 !?"), (4, "漢字資料")]), model).collect()}
    assert {found[t].lang_pred for t in (None, "", "12 !?")} == {"und"}
    assert all(r.rejected for r in found.values())
    empty = language.fit(language_rows(spark).limit(0))
    assert {r.lang_pred for r in language.identify(edge_docs(spark), empty).collect()} == {"und"}
    assert language.identify(edge_docs(spark).limit(0), model).count() == 0


FAR = {
    "Polish": "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem "
    "i sumieniem i powinni postępować wobec innych w duchu braterstwa.",
    "Finnish": "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja "
    "omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä.",
    "Turkish": "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler ve "
    "birbirlerine karşı kardeşlik zihniyeti ile hareket etmelidirler.",
}


def test_other_languages_and_letter_junk_are_rejected_and_short_texts_stay(spark, sf_dir):
    rng = random.Random(11)
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language.fitted(documents)
    junk = ["".join(rng.choice(letters) for _ in range(n)) for n in (60, 400, 4000) for letters in (
        "abcdefghijklmnopqrstuvwxyz    ", "bcdfghjklmnpqrstvwxz   ", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/",
    )]
    far = [*FAR.values(), *(text[:70] for text in FAR.values()), *junk]
    found = language.identify(docs(spark, list(enumerate(far))), model).collect()
    assert [r.text for r in found if not r.rejected] == []
    whole = documents.select("doc_id", "text")
    starts = whole.selectExpr("doc_id", "array_join(slice(split(text, ' '), 1, 3), ' ') as text")
    for clean in (whole, starts):
        judged = language.identify(clean, model).filter("text rlike '[a-z]'").collect()
        assert np.mean([r.rejected for r in judged]) <= (0.0 if clean is whole else 0.02)


def test_floors_of_small_samples_and_sizes(spark):
    few = language.fit(language_rows(spark, n=4))
    assert all(len(at) == 1 for at, _ in few.floors)
    model = language.fit(language_rows(spark))
    assert all((floors > 0).all() and (np.diff(at) > 0).all() for at, floors in model.floors)


def test_long_texts_are_counted_in_blocks(monkeypatch):
    text = prose(random.Random(1), 500)
    whole = language.ngram_counts(text)
    monkeypatch.setattr(language, "_BLOCK", 64)
    assert (language.ngram_counts(text) == whole).all()


# ------------------------------------------------------------------ quality


def test_sum_of_squares_identity():
    rng = np.random.default_rng(0)
    model = quality.FactorisationMachine(0.3, rng.normal(size=9), rng.normal(size=(9, 4)), None, None)
    x = rng.normal(size=(5, 9))
    pairs = [
        0.3 + row @ model.linear + sum(model.factors[i] @ model.factors[j] * row[i] * row[j] for i in range(9) for j in range(i))
        for row in x
    ]
    assert np.allclose(model.margins(x), pairs)


def test_quality_is_learned_without_labels_of_held_out_rows(spark):
    rng = random.Random(9)
    rows = [(k, prose(rng, 60) if k % 3 else prose(rng, 60).upper().replace(" ", "!! ")) for k in range(400)]
    labels = spark.createDataFrame([(k, int(k % 3 > 0), 0) for k in range(400)] + [(7, None, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    table = docs(spark, rows)
    sample = quality.sample_labelled(table, labels, fit_rows=120)
    assert sample.count() == 120
    model = quality.fit(sample, fit_rows=120)
    scored = quality.scored(clashing(table).drop("score"), model).collect()
    assert np.mean([(r.score >= 0.5) == (r.doc_id % 3 > 0) for r in scored]) > 0.98
    assert all(0 <= r.score <= 1 for r in quality.scored(edge_docs(spark), model).collect())
    assert {r.score for r in quality.scored(edge_docs(spark), quality.fit(sample.limit(0))).collect()} == {0.5}


# ----------------------------------------------------------------- licenses


def test_fuzzy_search_finds_what_a_whole_search_finds(spark):
    rng = random.Random(10)
    search = licenses.NoticeSearch(licenses.NOTICES)
    for _ in range(150):
        notice, label, exact = rng.choice(licenses.NOTICES)
        letters = list(notice)
        for _ in range(rng.randrange(licenses.allowed_edits(notice) + 2)):
            letters[rng.randrange(len(letters))] = rng.choice(["", "x", "ab", letters[0]])
        text = f"{prose(rng, 4)} {''.join(letters)} {prose(rng, 4)}"
        pattern = regex.compile(rf"(?b)(?:{notice}){{e<={licenses.allowed_edits(notice)}}}")
        match = pattern.search(text)
        whole = match is not None and set(exact.split()) <= set(text[match.start() : match.end()].split())
        assert whole == any(k[0] == label and k[3] <= licenses.allowed_edits(notice) for k in search.find(text) if k[0] == label), text


def test_notices_side_by_side_are_all_found():
    search = licenses.NoticeSearch(licenses.NOTICES)
    mit = search.find("releesed under the mit licence and released under the mit license")
    spans = sorted(f[1:4] for f in mit if f[0] == "mit" and f[4] > 0.9)
    assert [edits for _, _, edits in spans] == [2, 0]
    three = search.find("licensd undr the gnu genral public license version 3 " * 1
        + "licensed under the gnu general public license version 2 licensed under the gnu general public license version 3")
    assert {f[0] for f in three} >= {"gpl-2", "gpl-3"}
    gpl = search.find("licensd undr the gnu general publc licens version 3 licensed under the gnu general public license version 2")
    assert {f[0] for f in gpl} >= {"gpl-2", "gpl-3"}


def test_short_forms_with_a_typo_are_found(spark):
    texts = {
        1: ("distributed under the MIT Licence", ["mit"]),
        2: ("licensed under the MIT licence", ["mit"]),
        3: ("Apache Licence, Version 2.0", ["apache-2"]),
        4: ("CC-B-NC", ["cc-by-nc"]),
        5: ("GNU General Public Licence, version 3", ["gpl-3"]),
        6: ("BSD licence", ["bsd"]),
        7: ("apache licence version 20", []),
        8: ("GNU Lesser General Public Licence, version 3", ["lgpl"]),
        9: ("released under the mit licence", ["mit"]),
        10: ("under the summit license of CC BY-SA", []),
    }
    rows = docs(spark, [(k, text) for k, (text, _) in texts.items()])
    found = {r.doc_id: [n.label for n in r.notices] for r in licenses.scan(rows).collect()}
    assert found == {k: labels for k, (_, labels) in texts.items()}


def test_phrases_and_notices(spark):
    texts = {
        1: "Released UNDER the MIT, License. Under the mit license!",
        2: "Licensed under teh Apache Licence, Version 2.0.",
        3: "Licensed under the GNU General Public License, version 2.",
        4: "Licensed under CC BY-SA 4.0.",
        5: "apache license version 20",
        6: None,
    }
    found = {r.doc_id: r for r in licenses.scan(clashing(docs(spark, list(texts.items())))).collect()}
    assert [tuple(p) for p in found[1].phrases] == [(1, "mit"), (5, "mit")]
    assert [p.label for p in found[2].notices] == ["apache-2"] and found[2].notices[0].edits > 0
    assert [p.label for p in found[3].notices] == ["gpl-2"]
    assert all(not found[k].phrases and not found[k].notices for k in (4, 5, 6))
    assert found[6].n_words == 0
    assert licenses.scan(edge_docs(spark)).count() == 8


# --------------------------------------------------------------- neighbours


VECTORS = T.StructType(
    [T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))]
)


def test_recall_against_brute_force(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 24))
    vectors = np.concatenate([rng.normal(size=(1500, 24)), centres[rng.integers(0, 6, 1500)] + 0.1 * rng.normal(size=(1500, 24))])
    vectors = (vectors * rng.uniform(0.5, 2, size=(3000, 1))).astype(np.float32).astype(float)
    rows = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], VECTORS)
    found = collections.defaultdict(dict)
    for r in neighbours.nearest_neighbours(rows, F.col("vec_id") % 20 == 0, block_rows=700, block_queries=60).collect():
        found[r.query_id][r.rank] = (r.vec_id, r.score)
    hits = 0
    for query in range(0, 3000, 20):
        scores = vectors @ vectors[query]
        scores[query] = -np.inf
        best = set(np.argsort(-scores)[:20].tolist())
        assert sorted(found[query]) == list(range(1, 21))
        assert [s for _, s in sorted(found[query].values(), key=lambda x: -x[1])] == [found[query][k][1] for k in range(1, 21)]
        assert all(abs(scores[v] - s) < 1e-9 for v, s in found[query].values())
        hits += len(best & {v for v, _ in found[query].values()})
    assert hits / (150 * 20) >= 0.95


def test_vectors_that_take_no_part_and_ties(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (5, [1.0, 0.0]), (3, [1.0, 0.0]), (9, [0.0, 0.0]), (20, None), (40, [1.0, None])]
    rows += [(60, [nan, 1.0]), (80, [1.0, inf]), (100, [1.0, 2.0, 3.0]), (None, [0.5, 0.0]), (0, [1.0, 0.0])]
    found = neighbours.nearest_neighbours(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 20 == 0)
    found = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect())
    assert found == [
        *[(0, 1, 0, 1.0)] * 2,
        *[(0, 2, 3, 1.0)] * 2,
        *[(0, 3, 5, 1.0)] * 2,
        *[(0, 4, None, 0.5)] * 2,
    ]
    assert neighbours.nearest_neighbours(spark.createDataFrame([], VECTORS), F.lit(True)).count() == 0


# -------------------------------------------------------------------- pages


def page(words, n, extra="", template=True):
    same = "<div><span>Read us every day</span></div>" if template else ""
    body = "".join(f"<p>{w}" for w in words)
    return (
        f"<!DOCTYPE html><html><head><title>t{n}</title><script>var a='<p>';</script></head><body>"
        f"<nav><ul><li><a href=x>menu {n}</a><li>home</ul></nav><div class='ad box'>buy {n}</div>"
        f"{same}<div id=main-text><h1>Title {n} &amp; more</h1>{body}{extra}</div>"
        f"<section id='comments'><p>reader {n}</p></section><footer>foot {n}</footer></body></html>"
    )


def extract(spark, rows):
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    table = clashing(table).withColumn("text", F.lit("x")).withColumn("N_Template", F.lit("x"))
    return {r.page_id: r for r in pages.extracted(table).collect()}


def test_constant_nodes_are_template_and_varying_slots_content(spark):
    rng = random.Random(12)
    rows = [(n, f"https://a.example/{n}", page([prose(rng, 5) for _ in range(n % 5 + 1)], n)) for n in range(20)]
    found = extract(spark, rows)
    for n, _, source in rows:
        words = " ".join(re.findall(r"<p>([^<]*)", source.split("id=main-text")[1].split("<section")[0]))
        assert found[n].text == f"Title {n} & more {words}"
        assert found[n].n_template >= 1
    alone = extract(spark, rows[:1])[0]
    assert alone.text.startswith("Read us every day Title 0")


def test_pages_beyond_the_broadcast_bound_give_the_same(spark, monkeypatch):
    rng = random.Random(13)
    rows = [(n, "http://b.example/", page([prose(rng, 5)], n)) for n in range(12)]
    before = {k: r.text for k, r in extract(spark, rows).items()}
    monkeypatch.setattr(pages, "BROADCAST_CHARACTERS", 0)
    assert {k: r.text for k, r in extract(spark, rows).items()} == before


@pytest.mark.parametrize("wrapper", ["div class='site right-sidebar'", "div class='has-sidebar'", "div class='no-ads'", "form"])
@pytest.mark.parametrize("inner", ["main", "article", "div"])
def test_wrappers_of_the_whole_page_are_no_furniture(wrapper, inner):
    text = "The long story of the page is told here in many words."
    aside = "<div class='sidebar'>See too</div><nav>Home</nav>"
    page = f"<html><body><{wrapper}>{aside}<{inner}>{text}</{inner}></{wrapper.split()[0]}></body></html>"
    assert pages.content(pages.parse(page), set()) == text
    beside = f"<html><body><div>{text}</div><div class='related'><article>Teaser</article></div></body></html>"
    assert pages.content(pages.parse(beside), set()) == text


def test_broken_and_empty_pages(spark):
    rows = [
        (1, None, None),
        (2, "not an address", ""),
        (3, "http://c.example", "<article><p>a<b>b</b>c &am &lt;x&gt; &nbsp;<br>d<p>e<!-- no"),
        (4, "http://c.example", "plain text only"),
        (5, "http://c.example", "<article>one</article><aside>no</aside><article>two<script>no"),
        (6, "http://c.example", "<p " * 3000),
        (7, "http://c.example", "<div>" * 5000 + "deep"),
        *((8 + n, "http://d.example", "<div>" * (900 + n) + "<p>x" * n + "deep</html>") for n in range(9)),
    ]
    found = {k: r.text for k, r in extract(spark, rows).items()}
    assert found[1] == found[2] == ""
    assert found[3] == "abc &am <x> d e"
    assert found[4] == "plain text only" and found[5] == "one two" and found[7] == "deep"
    assert len(found) == 16 and extract(spark, rows[:0] or [(0, None, None)])[0].text == ""


@pytest.mark.parametrize("depth", [3, 190, 198, 199, 250, 3000])
def test_text_behind_a_deep_nest_stays(depth):
    deep = "<div>" * depth + "in<ul><li>a<li>b</ul>" + "</div>" * depth
    page = f"<div><article><p>start</p>{deep}<p>tail</p></article><div>no</div></div><p>end"
    assert pages.content(pages.parse(page), set()) == "start in a b tail"


def test_marks_that_name_a_content_are_no_furniture():
    page = (
        "<div class='share-price'><p>Share price of the day</p></div><section class='search-results'>Found</section>"
        "<div class='site-footer'>x</div><div id='c-ad__box2'>x</div><div class='left sidebar'>x</div><p class='social-history'>Old"
        "<div class='cookie-banner'>x</div><div class='post-content'>Text</div>" + "<p>more of it</p>" * 9
    )
    assert pages.content(pages.parse(page), set()) == "Share price of the day Found Old Text" + " more of it" * 9


def test_large_tables_are_matched_as_small_ones(monkeypatch):
    rng = random.Random(21)

    def tree(n):
        root = pages.Node("div")
        for _ in range(n):
            child = pages.Node(rng.choice("pqr"))
            child.children = [pages.Node("#text", text=rng.choice("abc"))] * rng.randrange(2)
            root.children.append(child)
        return root

    def size(pairs):
        return sum(1 + 0.01 * (a.key == b.key) for a, b in pairs)

    for _ in range(60):
        a, b = tree(rng.randrange(1, 15)), tree(rng.randrange(1, 15))
        found = []
        for largest in (40_000, 6):
            monkeypatch.setattr(pages, "_LARGE_TABLE", largest)
            matcher = pages.TreeMatcher()
            left, right = matcher.prepare(a), matcher.prepare(b)
            pairs = list(matcher._matched(left.children, right.children))
            order = {id(node): k for k, node in enumerate(left.children)}, {id(node): k for k, node in enumerate(right.children)}
            at = sorted((order[0][id(x)], order[1][id(y)]) for x, y in pairs)
            assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(at, at[1:], strict=False))
            total = 1 + sum(matcher.score(x, y) for x, y in pairs)
            assert total == matcher.score(left, right)
            found.append(total + size(pairs))
        assert found[0] == pytest.approx(found[1])


def test_tree_matching_is_maximal():
    """Against the plain recursive definition on small random trees."""
    rng = random.Random(14)

    def tree(depth):
        node = pages.Node(rng.choice("abc"))
        node.children = [tree(depth - 1) for _ in range(rng.randrange(3) if depth else 0)]
        return node

    def brute(a, b):
        if a.tag != b.tag:
            return 0

        def best(i, j):
            if i == len(a.children) or j == len(b.children):
                return 0
            return max(best(i + 1, j), best(i, j + 1), brute(a.children[i], b.children[j]) + best(i + 1, j + 1))

        return 1 + best(0, 0)

    matcher = pages.TreeMatcher()
    for _ in range(200):
        a, b = tree(3), tree(3)
        assert matcher.score(matcher.prepare(a), matcher.prepare(b)) == brute(a, b)
    assert markup.unescape("&amp;") == "&"


# ------------------------------------------------------------------ packing


def test_packing_is_whole_and_tight():
    rng = random.Random(15)
    for capacity in (50, 400):
        histogram = collections.Counter(rng.randrange(1, capacity + 1) // rng.choice([1, 2, 5]) + 1 for _ in range(3000))
        histogram = {k: n for k, n in histogram.items() if k <= capacity}
        packed = packing.pack(histogram, capacity)
        placed = collections.Counter()
        for configuration, times in packed.items():
            assert sum(length * n for length, n in configuration) <= capacity and times > 0
            for length, n in configuration:
                placed[length] += n * times
        assert dict(placed) == histogram
        bound = -(-sum(k * n for k, n in histogram.items()) // capacity)
        assert sum(packed.values()) <= bound * 1.02 + 1
    assert packing.pack({}, 10) == {}
    assert sum(packing.pack({6: 10, 4: 10}, 10).values()) == 10


def test_prices_fill_each_room_best():
    rng = np.random.default_rng(16)
    prices = np.full(31, -np.inf)
    prices[[3, 7, 8, 11, 30]] = rng.uniform(size=5)
    following = packing.price(prices, 30)

    def best(room):
        return max([0, *(prices[k] + best(room - k) for k in (3, 7, 8, 11, 30) if k <= room)])

    for room in range(31):
        left, worth = room, 0.0
        while left and following[left]:
            worth, left = worth + prices[following[left]], left - following[left]
        assert abs(worth - best(room)) < 1e-9


def test_sequences_hold_every_piece_without_gaps(spark):
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    encoder = packing.IdEncoder(path)
    rng = random.Random(17)
    rows = [(k, prose(rng, rng.randrange(1, 60))) for k in range(150)] + [(k, "same words, twice.") for k in (1, 1, None)]
    table = docs(spark, rows).unionByName(edge_docs(spark))
    found = packing.packed_sequences(clashing(table), tokenizer=path, capacity=256).toPandas()
    whole = sum(len(ids) // 4 for ids in encoder.encode([r.text for r in table.collect()]))
    assert found["length"].sum() == whole
    by = found.sort_values(["sequence_id", "offset"]).groupby("sequence_id")
    for _, group in by:
        ends = (group["offset"] + group["length"]).tolist()
        assert group["offset"].tolist() == [0, *ends[:-1]] and ends[-1] <= 256
    assert by.ngroups <= -(-whole // 256) + 2
    assert packing.packed_sequences(table.limit(0), tokenizer=path).count() == 0


def test_ids_are_those_of_the_whole_text():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    own, theirs = packing.IdEncoder(path), Tokenizer.from_file(path)
    rng = random.Random(18)
    letters = "aAbÉéßΣσςİı한가.,' \x1c \x85 \n\t!?%$ñ中'sK Å1²"
    texts = ["".join(rng.choices(letters, k=rng.randrange(40))) for _ in range(2000)] + [None, "<|endoftext|> I'll."]
    texts += ["<|endoftext|>", "a<|endoftext|>b", "<|ENDOFTEXT|> c", "<|startoftext|><|endoftext|>", "<|endoftext |>", "A<|EndOfText|>."]
    assert [len(ids) // 4 for ids in packing.IdEncoder(path).encode(["the", "the", "."])] == [2, 2, 2]
    for start in range(0, len(texts), 50):
        part = texts[start : start + 50]
        for text, ids in zip(part, own.encode(part), strict=True):
            expected = [*theirs.encode(text or "", add_special_tokens=False).ids, 1]
            assert np.frombuffer(ids, dtype="<u4").tolist() == expected, text


def test_words_before_runs_of_marks_are_encoded_together():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, alone = packing.IdEncoder(path), []
    ids = encoder._ids
    encoder._ids = lambda texts, tokenizer: alone.extend(texts if len(texts) > 1 else []) or ids(texts, tokenizer)
    rng = random.Random(19)
    words = ["".join(rng.choices("abcdeßéñ", k=6)) for _ in range(200)]
    text = " ".join(word + mark for word in words for mark in ("%%%", "!?", "...", "'s", "-", ",")).capitalize()
    assert encoder.encode([text])[0] == np.array(
        [*Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids, 1], dtype="<u4"
    ).tobytes()
    assert not [one for one in alone if one.endswith(("%%%", "!?", "...", "-", ",")) and one[0].isalpha()]


# --------------------------------------------------------------- edge cases


def test_edge_documents_pass_all_document_operators(spark):
    rows = edge_docs(spark)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    for table, n in ((clashing(rows), 8), (rows.limit(0), 0)):
        assert simhash.components(table).count() == n
        found = substrings.without_repeats(table)
        assert found.count() == n and found.columns.count("kept") == 1
        assert licenses.scan(table).count() == n
        assert decontamination.contaminated(table, bench).count() == 0
        found = quality.scored(table, None)
        assert found.count() == n and found.columns.count("score") == 1
        found = language.identify(table, language.fit(language_rows(spark, 4)))
        assert found.count() == n and found.columns.count("score") == 1
    kept = substrings.without_repeats(rows).filter("doc_id = 5").collect()
    assert [(r.kept, r.n_removed) for r in kept] == [("", 30_000)] * 2
    assert hashlib.sha256(b"").hexdigest()
