"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A text's fingerprint is the bitwise majority of the XXH64 hashes of its shingles.
Every distinct fingerprint emits all variants within half the radius; two
fingerprints within the radius share a variant, so a shuffle on variants brings
together all that may link, and colliding neighbours are verified by their
bits. Variants of one bucket that lie within half the radius, rounded down, are within the
radius of each other, so linking each to the next one of its bucket loses no connection;
of an odd radius, those a bit farther are linked to one of them. Components of the
links are found by alternating star contraction on written tables; documents of
equal fingerprint never meet as pairs.

Defined results: a null text is empty; a text without words has fingerprint 0
and links like any other; a text of fewer words than a shingle has one shingle,
the whole; equal texts share all results; rows with a null id have a fingerprint
and take the smallest id of their component (null if it has none); an empty table
gives no rows. Other columns are ignored by ``components``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from marketlens.llm.common import divided, give_back_memory, small_batches, staged, table, text_key

SEED = 42


def fingerprint(text: str | None, shingle: int) -> int:
    """The unsigned 64-bit fingerprint; A-Z count as a-z, words end at white space."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = [words[k:] for k in range(min(shingle, len(words)))]
    digests = b"".join([xxhash.xxh64_digest(b" ".join(run), SEED) for run in zip(*runs, strict=False)])
    hashes = np.frombuffer(digests, dtype=np.uint8).reshape(-1, 8)
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[start : start + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def with_fingerprints(documents: DataFrame, text: str, name: str, shingle: int) -> DataFrame:
    """``documents`` with the fingerprint as a signed long in column ``name``."""

    @F.pandas_udf(LongType())
    def fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([_signed(fingerprint(t, shingle)) for t in texts], dtype="int64")
        give_back_memory()

    return small_batches(documents).withColumn(name, fingerprints(F.col(text)))


def links(fingerprints: DataFrame, radius: int) -> DataFrame:
    """Links (a, b), a < b, between distinct fingerprints ``fp`` of one table; their
    connected components are those of all pairs within ``radius`` bits."""
    half = (radius + 1) // 2
    masks = [0] + [sum(1 << bit for bit in bits) for n in range(1, half + 1) for bits in combinations(range(64), n)]
    masks = F.array(*(F.lit(_signed(mask)).cast("long") for mask in masks))
    variants = fingerprints.select("fp", F.explode(masks).alias("mask")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"), (F.bit_count("mask") > radius // 2).alias("far")
    )
    # For an odd radius two that are far from the variant may be a bit too far from each
    # other: each is linked to one that is near, which all the near ones are to the next.
    bucket = Window.partitionBy("variant").orderBy("far", "fp")
    first = F.first(F.struct("far", "fp")).over(bucket)
    near = F.when(~first["far"], first["fp"])
    met = F.when(F.col("far"), near).otherwise(F.lag("fp").over(bucket))
    pairs = variants.select(met.alias("a"), F.col("fp").alias("b")).filter("a <> b")
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return pairs.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """The smallest node ``root`` that each ``node`` of the links (a, b) reaches.

    Alternates large and small stars: every round links the neighbours of a node
    to the smallest of them, larger ones first, then the others, until all edges
    point at their root. Rounds grow with the logarithm of the longest path.
    """
    edges = staged(edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")), "links")
    while True:
        both = edges.unionByName(edges.select(F.col("root").alias("node"), F.col("node").alias("root")))
        least = staged(both.groupBy("node").agg(F.least(F.min("root"), F.col("node")).alias("least")), "least")
        large = _lookup(both, least).filter(F.col("root") > F.col("node"))
        large = large.select(F.col("root").alias("node"), F.col("least").alias("root")).distinct()
        large = staged(large, "large-star")
        least = staged(large.groupBy("node").agg(F.min("root").alias("least")), "least")
        stars = _lookup(large, least)
        small = stars.select(F.explode(F.array("node", "root")).alias("node"), F.col("least").alias("root"))
        small = staged(small.filter(F.col("node") != F.col("root")).distinct(), "small-star")
        if small.exceptAll(edges).isEmpty() and edges.exceptAll(small).isEmpty():
            return small
        edges = small


def _lookup(rows: DataFrame, least: DataFrame) -> DataFrame:
    """Adds ``least`` by node. Both sides are read from tables, so that a node with
    many neighbours can be split over tasks."""
    return rows.join(least, "node")


def components(
    documents: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = 3,
    radius: int = 2,
) -> DataFrame:
    """One row per document row: doc_id, text_key, fp (signed), root (the smallest
    fingerprint of the component), component_id (the smallest id that links reach, its
    own included)."""
    docs = with_fingerprints(
        documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", "fp", shingle
    )
    docs = staged(docs.select("doc_id", text_key(F.col("text")).alias("text_key"), "fp"), "fingerprints")
    classes = staged(docs.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprint-classes")
    roots = connected(links(classes, radius))
    rooted = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    rooted = staged(rooted, "rooted-classes")
    firsts = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = staged(rooted.join(staged(firsts, "components"), "root").select("fp", "root", "component_id"), "named-classes")
    return docs.join(named, "fp").select("doc_id", "text_key", "fp", "root", "component_id")


def drop_near_duplicates(documents: DataFrame, *, shingle: int = 3, radius: int = 2) -> DataFrame:
    """One document of each component, all columns kept: the one of the smallest id,
    null last. Of several rows of that id the smallest text key stays, once; an id that
    is repeated with unrelated texts stays once for each component. Only documents that
    may have to go are shuffled."""
    named = staged(components(documents, shingle=shingle, radius=radius).drop("component_id"), "named-documents")
    rank = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("id"), "text_key")
    kept = staged(named.groupBy("root").agg(F.min(rank).alias("kept")).select("kept.id", "kept.text_key"), "kept-documents")
    own = F.xxhash64("id", "text_key").alias("hash")
    rows = named.select(F.col("doc_id").alias("id"), "text_key")
    # What may go: rows that are not kept, and rows of one id and text more than once.
    counted = rows.groupBy("id", "text_key").agg(F.count("*").alias("n"))
    counted = counted.select(F.struct("id", "text_key").alias("_llm_row"), "n")
    stays = kept.select(F.struct("id", "text_key").alias("_llm_row"), F.lit(True).alias("stays"))
    judged = staged(counted.join(stays, "_llm_row", "left").filter("stays is null or n > 1"), "judged-documents")
    named_row = F.struct(documents["doc_id"].alias("id"), text_key(documents["text"]).alias("text_key"))
    found = documents.withColumn("_llm_row", named_row)
    found = found.withColumn("_llm_hash", F.xxhash64("_llm_row.id", "_llm_row.text_key"))
    suspects, clean = divided(found, "_llm_hash", judged.select("_llm_row.*").select(own))
    suspects = suspects.join(judged.hint("merge"), "_llm_row", "left")
    names = documents.columns
    once = suspects.filter("n is null").select(*names)
    several = suspects.filter("stays").dropDuplicates(["_llm_row"]).select(*names)
    return clean.select(*names).unionByName(once).unionByName(several)


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: 3-word shingles, 2 bits."""
    found = components(table(spark, sf_dir, "documents"), shingle=3, radius=2)
    shown = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", shown.alias("fingerprint"), "component_id")
