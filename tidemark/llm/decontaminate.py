"""Benchmark decontamination with DataFrame expressions only.

Windows of benchmark words are held in broadcast sets. A window of n words holds
a whole block of (n + 1) // 2 words that starts at a multiple of that length, so
only these blocks of a document are looked up. A block that is known is checked
word for word against the windows around it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import lower_ascii, written

WINDOW = 13
# Benchmark words up to which the windows are broadcast (some 100 bytes each, at most 200 MB); more are shuffled.
BROADCAST_WORDS = 2_000_000
_GAPS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def words(text: Column) -> Column:
    """Runs of digits, ASCII letters in lower case and characters beyond ASCII; null has none."""
    parts = F.split(lower_ascii(F.coalesce(text, F.lit(""))), _GAPS)
    return F.filter(parts, lambda w: w != "")


def _windows(items: DataFrame, item_id: str, item_text: str) -> DataFrame:
    """Every window of the items: item, its length ``len`` and its ``words``."""
    tokens = items.select(F.col(item_id).cast("string").alias("item"), words(F.col(item_text)).alias("w"))
    n = F.size("w")
    length = F.least(n, F.lit(WINDOW))
    starts = F.sequence(F.lit(1), n - length + 1)
    return (
        tokens.where(n > 0)
        .select("item", length.alias("len"), F.explode(F.transform(starts, lambda i: F.slice("w", i, length))).alias("words"))
        .distinct()
    )


def contamination(
    docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """Per document row: key, ``n_words``, ``n_hit`` words and the ``items`` (sorted) found in it.

    A null or empty text has no words and no hit; an item without words is never
    found. Items are compared as strings and repeated items count once; a null
    item id is ignored in ``items`` but its windows hit. Other columns of either
    input are left out. Equal document ids are one document only if their texts
    are equal; such rows are repeated in the result.
    """
    windows = written(_windows(items, item_id, item_text), "windows")
    sized = windows.groupBy("len").agg(F.count(F.lit(1)).alias("n")).collect()  # at most WINDOW rows
    small = sum(r["n"] for r in sized) <= BROADCAST_WORDS
    bounded = F.broadcast if small else (lambda df: df)
    tokens = docs.select(
        F.col(doc_id).alias("doc"), F.xxhash64(F.col(text)).alias("copy"), words(F.col(text)).alias("w")
    )
    # Without items the one length below finds nothing.
    found = [_hits(tokens, windows, r["len"], bounded) for r in sized] or [_hits(tokens, windows, WINDOW, bounded)]
    hits = found[0]
    for more in found[1:]:
        hits = hits.unionByName(more)
    per_doc = (
        hits.groupBy("doc", "copy")
        .agg(
            F.array_sort(F.collect_set(F.struct("at", "len"))).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("found")))).alias("items"),
        )
        .select("doc", "copy", _covered("spans").alias("n_hit"), "items")
    )
    counted = tokens.select("doc", "copy", F.size("w").cast("long").alias("n_words"))
    return counted.join(
        per_doc, counted["doc"].eqNullSafe(per_doc["doc"]) & (counted["copy"] == per_doc["copy"]), "left"
    ).select(
        counted["doc"].alias(doc_id),
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def _hits(tokens: DataFrame, windows: DataFrame, length: int, bounded) -> DataFrame:
    """Windows of one length in the documents: doc, copy, first word ``at``, ``len`` and the items ``found``."""
    block = (length + 1) // 2
    reach = length - block  # words of a window that can stand before its block
    own = windows.where(F.col("len") == length)
    known_blocks = own.select(
        F.explode(
            F.transform(F.sequence(F.lit(1), F.lit(length - block + 1)), lambda i: F.xxhash64(F.slice("words", i, block)))
        ).alias("key")
    ).distinct()
    known = own.groupBy("words").agg(F.sort_array(F.collect_set("item")).alias("found"))
    last = F.size("w") - block
    blocks = F.transform(
        F.when(last >= 0, F.sequence(F.lit(0), last, F.lit(block))).otherwise(F.array().cast("array<int>")),
        lambda j: F.struct(
            F.xxhash64(F.slice("w", j + 1, block)).alias("key"),
            F.greatest(j - reach, F.lit(0)).alias("from"),
            F.slice("w", F.greatest(j - reach, F.lit(0)) + 1, F.least(j, F.lit(reach)) + length).alias("near"),
        ),
    )
    looked_up = (
        tokens.select("doc", "copy", F.explode(blocks).alias("b"))
        .select("doc", "copy", "b.*")
        .join(bounded(known_blocks), "key", "left_semi")
    )
    spots = F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(reach)), lambda i: i + length <= F.size("near")),
        lambda i: F.struct((F.col("from") + i).alias("at"), F.slice("near", i + 1, length).alias("words")),
    )
    return (
        looked_up.select("doc", "copy", F.explode(spots).alias("s"))
        .select("doc", "copy", "s.*")
        .join(bounded(known), "words")
        .select("doc", "copy", "at", F.lit(length).alias("len"), "found")
    )


def _covered(spans: str) -> Column:
    """Words inside at least one of the spans, which are sorted by their start."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))

    def add(acc: Column, span: Column) -> Column:
        end = span["at"] + span["len"]
        new = F.greatest(F.lit(0), end - F.greatest(acc["end"], span["at"]))
        return F.struct(F.greatest(acc["end"], end).alias("end"), (acc["n"] + new).alias("n"))

    return F.aggregate(spans, start, add, lambda acc: acc["n"])


def is_contaminated(n_hit: Column, n_words: Column) -> Column:
    """At least one word in twenty is hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def remove_documents(
    docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """The documents that are not contaminated, all columns as they were.

    A document goes if any row of its id is contaminated; null ids stay apart
    from all others. Documents without words stay.
    """
    found = contamination(docs, items, doc_id=doc_id, text=text, item_id=item_id, item_text=item_text)
    bad = found.where(is_contaminated(F.col("n_hit"), F.col("n_words"))).select(F.col(doc_id).alias("_bad")).distinct()
    return docs.join(bad, docs[doc_id].eqNullSafe(bad["_bad"]), "left_anti")
