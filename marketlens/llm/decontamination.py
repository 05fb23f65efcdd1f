"""Benchmark decontamination by template canonicalisation.

Texts become templates: numbers, names (capitalised words inside a sentence) and
units after a number are replaced with typed placeholders, the rest is
lower-cased, punctuation goes. Windows of ``WINDOW`` template words are
hash-joined with those of the benchmark; each hit fixes an item and an alignment.
Along the alignment the words are compared one by one (a word that only
one side takes for a name, at the start of a sentence, counts as itself), and the slots of the
matching run are checked for consistency: equal values in the item must stand for
equal values in the document. A question with other numbers or names is caught
that way, while unrelated texts of a like shape are not. Everything is a
DataFrame function.

A document is contaminated by an item if, at some alignment, the longest run of
equal template words has at least ``RUN`` words or the whole item, or if at least
``SHARE`` of the item's words agree; in either case half of the run or more must
be literal words and the slots consistent. Neighbouring alignments are judged
together too: ``SHARE`` of the words may agree in order while the alignment drifts by
up to ``DRIFT`` words to either side, as it does where words were put in or left
out; then the slots of all agreeing words are checked.

Both sides give windows at every word. Of an item of ``SHORT`` words or more, of
which a fifth may differ, ``WINDOW`` words in a row are always left equal, and so are
they in every run. Windows may be as common as "what is the", so a hit is first held against
the item's words: where more of its literal words are missing around the alignment than may
differ, no text is split, written or shuffled for it.

Defined results: null texts are empty, and items without a word match nothing; items
of fewer than ``SHORT`` words match as a whole only; windows of fewer than two literal
words, except the beginning of a literal word, two slots and a literal word, are no
evidence, since no run that counts consists of them. Items that have no window of
evidence match as a whole, word for word, numbers, names and units as they are:
from ``WINDOW`` words on anywhere in a text, shorter ones where they are all of the text,
since any text may happen to say one or two words. In scripts without spaces each character is a word; repeated rows
count once; items of equal id and text count once; an empty table gives no rows. Only
the named id and text columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlens.llm.common import divided, staged, table, text_key

WINDOW, RUN, SHARE, SHORT, DRIFT = 3, 13, 0.8, 9, 3
#: Windows of the benchmark up to this many are broadcast (40 bytes each).
BROADCAST_WINDOWS = 400_000
# Words that count as units after a number.
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms "
    "ton tons tonne tonnes ounce ounces pound pounds ml l liter liters litre litres gallon gallons "
    "second seconds minute minutes hour hours day days week weeks month months year years "
    "dollar dollars cent cents euro euros percent degree degrees mph kph volt volts watt watts"
)
_MARK = "\u0001"
# Scripts that put no space between words.
_UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
_MAY_BE_UNSPACED = r"[\u0E00-\u109F\u1780-\u17FF\u2E80-\u9FFF\uA9E0-\uAA7F\uF900-\uFAFF\uFF66-\uFF9D\x{1B000}-\x{3FFFF}]"


def with_words(texts: DataFrame, text: str) -> DataFrame:
    """Replaces column ``text`` by ``raw``, its words one space apart, names with a
    mark, and ``words``, its template, word for word. Each step is a column of its
    own, so that Spark evaluates it once."""
    source = F.replace(F.coalesce(F.col(text), F.lit("")), F.lit(_MARK), F.lit(" "))
    spaced = F.regexp_replace("_source", rf"([{_UNSPACED}]\p{{M}}*)", " $1 ")
    # Scripts are looked up one by one, which is slow: a plain range comes first.
    spaced = F.when(F.col("_source").rlike(_MAY_BE_UNSPACED), spaced).otherwise(F.col("_source"))
    marked = F.regexp_replace("_spaced", r" (?<=[\p{L}\p{Nd},;:] )(?=\p{Lu}\p{Ll})", f" {_MARK}")
    plain = F.regexp_replace("_marked", rf"[^\p{{L}}\p{{M}}{_MARK}]+", " ")
    digits = F.regexp_replace("_marked", r"(?<=\p{Nd})%", " percent ")
    digits = F.regexp_replace(digits, r"(?<=\p{Nd})(?=\p{L})", " ")
    digits = F.regexp_replace(
        digits, rf"(?:[^\p{{L}}\p{{M}}\p{{Nd}}{_MARK}.,]|[.,](?!\p{{Nd}})|(?<!\p{{Nd}})[.,])+", " "
    )
    raw = F.trim(F.when(F.col("_marked").rlike(r"\p{Nd}"), digits).otherwise(plain))
    slots = F.regexp_replace(F.lower("raw"), f"{_MARK}[^ ]+", "<name>")
    numbers = F.regexp_replace("_slots", r"\p{Nd}[^ ]*", "<num>")
    units = F.regexp_replace(numbers, rf"<num> (?:{'|'.join(UNITS.split())})(?= |$)", "<num> <unit>")
    words = F.when(F.col("_slots").rlike(r"\p{Nd}"), units).otherwise(F.col("_slots"))
    steps = {"_source": source, "_spaced": spaced, "_marked": marked, "raw": raw, "_slots": slots, "words": words}
    for name, column in steps.items():
        texts = texts.withColumn(name, column)
    return texts.drop(text, "_source", "_spaced", "_marked", "_slots")


def _evidence(words: Column, start: Column) -> Column:
    """Whether the window of ``words`` at ``start`` can be part of a run that counts."""
    literal = [~F.get(words, start + k).startswith("<") for k in range(WINDOW + 1)]
    several = sum(F.when(word, 1).otherwise(0) for word in literal[:WINDOW]) >= 2
    return several | F.coalesce(literal[0] & literal[WINDOW], F.lit(False))


def _items(benchmark: DataFrame, item_id: str, text: str) -> DataFrame:
    items = benchmark.select(F.col(item_id).alias("item_id"), F.col(text).alias("item")).distinct()
    items = with_words(items, "item").select(
        "item_id", F.split("raw", " ").alias("item_raw"), F.split("words", " ").alias("item_words")
    )
    return items.filter(F.get("item_words", F.lit(0)) != "").withColumn(
        "item_key", F.unhex(F.md5(F.to_json(F.struct("item_id", "item_raw")).cast("binary")))
    )


def _item_windows(items: DataFrame) -> DataFrame:
    def window(start: Column) -> Column:
        return F.array_join(F.slice("item_words", start + 1, WINDOW), " ")

    starts = F.sequence(F.lit(0), F.size("item_words") - WINDOW)
    windows = items.filter(F.size("item_words") >= WINDOW).select(
        "item_key", "item_raw", "item_words", F.posexplode(F.transform(starts, window)).alias("start", "window")
    )
    windows = windows.withColumn("evidence", _evidence(F.col("item_words"), F.col("start")))
    some = Window.partitionBy("item_key")
    windows = windows.withColumn("exact", ~F.bool_or("evidence").over(some))
    # Of an item without evidence the first window stands for the whole, also as it is
    # inside a sentence, where its first word is a name.
    windows = windows.filter(F.col("evidence") | (F.col("exact") & (F.col("start") == 0)))
    inside = F.array(F.col("window"), F.regexp_replace("window", "^[^ ]+", "<name>"))
    named = F.col("exact") & F.get("item_raw", F.lit(0)).rlike(r"^\p{Lu}\p{Ll}")
    windows = windows.withColumn("window", F.explode(F.when(named, F.array_distinct(inside)).otherwise(F.array("window"))))
    words = F.split("window", " ")
    return windows.select(
        F.xxhash64(*(F.get(words, F.lit(k)) for k in range(WINDOW))).alias("hash"), "item_key", "start", "exact"
    )


def _plain(raw: str) -> Column:
    """Words in small letters, without the marks of names."""
    return F.lower(F.replace(raw, F.lit(_MARK), F.lit("")))


def _needed(size: Column) -> Column:
    """The least number of an item's words that must agree."""
    return F.least(F.least(F.lit(RUN), size), F.ceil(SHARE * size))


def _around(words: str) -> Column:
    """``words`` of the document where an alignment and its neighbours lie."""
    first = F.greatest(F.col("shift") - DRIFT, F.lit(0))
    return F.slice(words, first + 1, F.col("shift") + F.size("item_words") + DRIFT - first)


def _sizes(items: DataFrame) -> DataFrame:
    """Adds what hits are held against: the different literal words, how many may be
    missing, and the words as text."""
    size = F.size("item_words")
    said = F.array_join(F.transform("item_raw", lambda word: F.lower(F.ltrim(word, F.lit(_MARK)))), " ")
    return items.withColumns(
        {
            "literals": F.array_distinct(F.filter("item_words", lambda word: ~word.startswith("<"))),
            "may_miss": size - _needed(size).cast("int"),
            "said": F.concat(F.lit(" "), said, F.lit(" ")),
        }
    )


def _hopeful(hits: DataFrame) -> DataFrame:
    """Hits (raw, words of the document; the item) that may be matches, by functions that
    need no copy of the document. A literal word of the item may also be met by a name."""
    around = _around("words")
    names = F.size(around) - F.size(F.array_remove(around, "<name>"))
    missing = F.size(F.array_except("literals", around)) - names
    holds = F.concat(F.lit(" "), _plain("raw"), F.lit(" ")).contains(F.col("said"))
    return hits.filter((missing <= F.col("may_miss")) & (~F.col("exact") | holds))


def _met(hits: DataFrame) -> DataFrame:
    """Words of the item, and of the document where the alignment and its neighbours
    make them meet; word j of the item meets word j + ``off`` of these."""
    first = F.greatest(F.col("shift") - DRIFT, F.lit(0))
    sides = hits.withColumns({"doc_raw": F.split("raw", " "), "doc_words": F.col("words")})
    met = [_around(side).alias(side) for side in ("doc_raw", "doc_words")]
    size, off = F.size("item_words").alias("size"), (F.col("shift") - first).alias("off")
    return sides.select(
        "doc_id", "text_key", "item_key", "item_id", "exact", "shift", off, size, *met, "item_raw", "item_words"
    )


def _same(j: Column, at: Column) -> Column:
    """Whether word j of the item equals word ``at`` of the document: as templates, or
    as words where one side alone takes it for a name."""
    template = F.get("item_words", j) == F.get("doc_words", at)
    return F.coalesce(template | (F.get("item_plain", j) == F.get("doc_plain", at)), F.lit(False))


def _drifting() -> Column:
    """The most words that agree in order within the drift, with their slots."""
    slot = "struct<kind: string, asked: string, found: string>"
    zero = F.array_repeat(F.struct(F.lit(0).alias("n"), F.array().cast(f"array<{slot}>").alias("slots")), 2 * DRIFT + 1)

    def step(state: Column, j: Column) -> Column:
        paths = []
        for k in range(2 * DRIFT + 1):
            at = j + F.col("off") + (k - DRIFT)
            # Words of the document may be passed over, a word of the item is then left out.
            before = F.greatest(*(F.get(state, F.lit(i)) for i in range(k + 1))) if k else F.get(state, F.lit(0))
            kind = F.get("item_words", j)
            pair = F.struct(
                kind.alias("kind"), F.get("item_raw", j).alias("asked"), F.get("doc_raw", at).alias("found")
            )
            slots = F.when(kind.startswith("<"), F.concat(before["slots"], F.array(pair))).otherwise(before["slots"])
            path = F.when(
                _same(j, at), F.struct((before["n"] + 1).alias("n"), slots.cast(f"array<{slot}>").alias("slots"))
            ).otherwise(before)
            paths.append(F.greatest(path, F.get(state, F.lit(k + 1))) if k < 2 * DRIFT else path)
        return F.array(*paths)

    return F.array_max(F.aggregate(F.sequence(F.lit(0), F.col("size") - 1), zero, step))


def _consistent(slots: Column) -> Column:
    """Whether equal values of the item stand for equal values of the document."""
    asked = F.transform(slots, lambda s: F.struct(s["kind"], s["asked"]))
    return F.size(F.array_distinct(slots)) == F.size(F.array_distinct(asked))


def _longest_run(same: Column) -> Column:
    """Length and end of the longest run of true values; the first of equals."""
    zero = F.struct(*(F.lit(0).alias(n) for n in ("at", "now", "best", "end")))

    def step(state: Column, value: Column) -> Column:
        now = F.when(value, state["now"] + 1).otherwise(0)
        longer = now > state["best"]
        return F.struct(
            (state["at"] + 1).alias("at"),
            now.alias("now"),
            F.when(longer, now).otherwise(state["best"]).alias("best"),
            F.when(longer, state["at"] + 1).otherwise(state["end"]).alias("end"),
        )

    return F.aggregate(same, zero, step)


def contaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row per document and item found in it at some alignment, neighbouring
    alignments judged together giving one: doc_id, text_key, item_id, first_word (of
    the longest matching run, from 0), n_words (of the run), n_slots, changed (slots of
    other values than the item's)."""
    asked = staged(_items(benchmark, item_id, item_text), "benchmark-items")
    windows = staged(_item_windows(asked), "benchmark-windows")
    exact = windows.groupBy("item_key").agg(F.bool_or("exact").alias("exact"))
    items = staged(_sizes(asked.join(exact, "item_key")), "benchmark-windowed")  # at most one per window
    windows = windows.drop("exact")
    docs = documents.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), text_key(F.col(text)).alias("text_key")
    )
    # Each word beside the next ones: windows are hashed from their words and never written out.
    found = with_words(docs, "text").withColumn("words", F.split("words", " "))
    many = F.greatest(F.size("words") - (WINDOW - 1), F.lit(0))
    beside = F.arrays_zip(*(F.slice("words", k + 1, many).alias(f"w{k}") for k in range(WINDOW)))
    found = found.select("doc_id", "text_key", "raw", "words", F.posexplode(beside).alias("nth", "window"))
    found = found.withColumn("hash", F.xxhash64(*(F.col(f"window.w{k}") for k in range(WINDOW)))).drop("window")
    shift = (F.col("nth") - F.col("start")).alias("shift")
    if windows.count() <= BROADCAST_WINDOWS:
        # The words ride along: no text is shuffled, and few rows leave the join.
        hits = found.join(F.broadcast(windows), "hash").select(
            "doc_id", "text_key", "raw", "words", "item_key", shift
        )
        hits = _hopeful(hits.join(F.broadcast(items), "item_key"))
    else:
        hits = found.select("text_key", "nth", "hash").join(windows, "hash")
        hits = staged(hits.select("text_key", "item_key", shift).distinct(), "benchmark-hits")
        # Texts that may have hits come to them, each once; the others are not shuffled.
        keyed = docs.withColumn("_llm_hash", F.xxhash64("text_key"))
        texts, _ = divided(keyed, "_llm_hash", hits.select(F.xxhash64("text_key")).distinct())
        texts = with_words(texts.drop("_llm_hash"), "text").withColumn("words", F.split("words", " "))
        hits = _hopeful(texts.join(hits.join(items, "item_key").hint("merge"), "text_key"))
    met = _met(hits).dropDuplicates(["doc_id", "text_key", "item_key", "shift"])
    plain = {
        f"{side}_plain": F.transform(f"{side}_raw", lambda word: F.lower(F.ltrim(word, F.lit(_MARK))))
        for side in ("doc", "item")
    }
    # Written in between: a filter pushed below would evaluate the arrays anew for each use.
    words = F.sequence(F.lit(0), F.col("size") - 1)
    runs = staged(met.withColumns(plain), "benchmark-alignments")
    runs = runs.withColumn(
        "known",
        F.size(
            F.filter(
                words,
                lambda j: F.array_contains("doc_words", F.get("item_words", j))
                | F.array_contains("doc_plain", F.get("item_plain", j)),
            )
        ),
    )
    # No more words agree than are known at all.
    runs = staged(runs, "benchmark-words").filter(F.col("known") >= _needed(F.col("size")))
    same = F.transform(words, lambda j: _same(j, j + F.col("off")))
    runs = staged(runs.withColumn("same", same), "benchmark-same")
    runs = runs.withColumn("run", _longest_run(F.col("same"))).withColumn(
        "agree", F.size(F.filter("same", lambda equal: equal))
    )
    shares = (F.col("size") >= SHORT) & (F.col("known") >= SHARE * F.col("size"))
    runs = staged(runs.withColumn("path", F.when(shares, _drifting())).drop("same"), "benchmark-runs")
    start = F.col("run.end") - F.col("run.best") + 1
    whole = F.arrays_zip(
        *(
            F.slice(side, at, F.col("run.best")).alias(name)
            for name, side, at in (
                ("kind", "item_words", start),
                ("asked", "item_raw", start),
                ("found", "doc_raw", F.greatest(start + F.col("off"), F.lit(1))),
            )
        )
    )
    slots = F.filter(whole, lambda word: word["kind"].startswith("<"))
    share = SHARE * F.col("size")
    alone = (
        ((F.col("run.best") >= F.least(F.lit(RUN), "size")) | ((F.col("size") >= SHORT) & (F.col("agree") >= share)))
        & (2 * F.size("slots") <= F.col("run.best"))
        & _consistent(F.col("slots"))
    )
    drifting = (
        (F.col("path.n") >= share)
        & (2 * F.size("path.slots") <= F.col("path.n"))
        & _consistent(F.col("path.slots"))
    )
    checked = staged(runs.withColumn("slots", slots), "benchmark-slots")
    verbatim = F.slice("doc_plain", F.greatest(F.col("off") + 1, F.lit(1)), F.col("size")) == F.col("item_plain")
    checked = checked.withColumns(
        {
            "alone": F.when(F.col("exact"), verbatim & (F.col("off") >= 0)).otherwise(alone),
            "drifting": ~F.col("exact") & F.coalesce(drifting, F.lit(False)),
        }
    )
    checked = checked.filter(F.col("alone") | F.col("drifting"))
    # Of neighbours that only match together, the one of the longest run stays.
    near = Window.partitionBy("doc_id", "text_key", "item_key").orderBy("shift").rangeBetween(-DRIFT, DRIFT)
    rank = F.struct("alone", F.col("run.best"), -F.col("shift"))
    checked = checked.withColumn("rank", rank).withColumn("first", F.max("rank").over(near))
    checked = checked.filter(F.col("alone") | (F.col("rank") == F.col("first")))
    checked = checked.withColumn("slots", F.when(F.col("alone"), F.col("slots")).otherwise(F.col("path.slots")))
    changed = F.exists("slots", lambda s: s["asked"] != s["found"])
    found = checked.select(
        "doc_id",
        "text_key",
        "item_id",
        (F.col("shift") + start - 1).cast("long").alias("first_word"),
        F.col("run.best").cast("long").alias("n_words"),
        F.size("slots").cast("long").alias("n_slots"),
        changed.alias("changed"),
    )
    tiny = asked.filter(F.size("item_words") < WINDOW)
    return found if tiny.isEmpty() else found.unionByName(_whole_texts(docs, tiny))


def _whole_texts(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Documents whose words are those of an item and no others."""
    words = F.array_join(F.transform("item_raw", lambda word: F.lower(F.ltrim(word, F.lit(_MARK)))), " ")
    asked = items.select("item_id", "item_words", words.alias("plain"))
    texts = with_words(docs, "text").select("doc_id", "text_key", _plain("raw").alias("plain")).distinct()
    return texts.join(asked, "plain").select(
        "doc_id",
        "text_key",
        "item_id",
        F.lit(0).cast("long").alias("first_word"),
        F.size("item_words").cast("long").alias("n_words"),
        F.size(F.filter("item_words", lambda word: word.startswith("<"))).cast("long").alias("n_slots"),
        F.lit(False).alias("changed"),
    )


def drop_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no item of the benchmark, all columns kept. Only those
    that may have to go are shuffled."""
    leaked = staged(contaminated(documents, benchmark).select("text_key").distinct(), "leaked-texts")
    names = documents.columns
    keyed = documents.withColumn("_llm_text_key", text_key(documents["text"]))
    keyed = keyed.withColumn("_llm_hash", F.xxhash64("_llm_text_key"))
    suspects, clean = divided(keyed, "_llm_hash", leaked.select(F.xxhash64("text_key")))
    leaked = leaked.withColumnRenamed("text_key", "_llm_text_key")
    kept = suspects.join(leaked.hint("merge"), "_llm_text_key", "left_anti")
    return clean.select(*names).unionByName(kept.select(*names))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items found in them: one row per pair."""
    pairs = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return pairs.groupBy("doc_id", "item_id").agg(
        F.count("*").alias("n_places"),
        F.min("first_word").alias("first_word"),
        F.max("n_words").alias("n_words"),
        F.bool_or("changed").alias("changed"),
    )
