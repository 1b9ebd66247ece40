"""Removal of repeated lines by overlapping windows of three lines.

Lines are hashed, three consecutive hashes make a window, and all windows of the
corpus are grouped. The first occurrence of a window (smallest document, then
position) stays; the lines that any later occurrence covers go.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.words import slices
from tidemark.operators.joins import aggregate_for_join

LINES = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def repeated_lines(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Line numbers (from 0) that go: key ``doc``, ``copy`` (a hash of the text) and ``gone``, a sorted array.

    Lines are split at \\n and compared byte for byte. Texts of fewer than three
    lines have no window, nor has null. A window of three empty lines is no
    window. Rows with a null key are never removed from and never the first.
    Two rows of one key count as one document: the earlier position wins, and
    of equal positions the one whose text hash is smaller.
    """
    lines = docs.where(F.col(doc_id).isNotNull()).select(
        F.col(doc_id).alias("doc"), F.xxhash64(text).alias("copy"), _lines(F.col(text)).alias("l")
    )
    spots = F.transform(
        F.filter(F.sequence(F.lit(0), F.size("l") - LINES), lambda i: F.array_max(F.transform(F.slice("l", i + 1, LINES), F.length)) > 0),
        lambda i: F.struct(i.alias("at"), F.xxhash64(F.slice("l", i + 1, LINES)).alias("h1"), F.hash(F.slice("l", i + 1, LINES)).alias("h2")),
    )
    windows = (
        lines.where(F.size("l") >= LINES)
        .select("doc", "copy", F.explode(spots).alias("s"))
        .select("doc", "copy", "s.*")
    )
    # Counts combine in each task; windows seen once end here. A hot window is one row on this side of the join
    # and all its occurrences on the other, which AQE can split.
    least, n = F.min(F.struct("doc", "at", "copy")).alias("first"), F.count(F.lit(1)).alias("n")
    first = aggregate_for_join(windows, ["h1", "h2"], least, n).where(F.col("n") > 1).drop("n")
    later = windows.join(first, ["h1", "h2"]).where(F.struct("doc", "at", "copy") != F.col("first"))
    covered = F.sequence("at", F.col("at") + LINES - 1)
    return later.groupBy("doc", "copy").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(covered)))).alias("gone")
    )


def dedup_lines(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with ``text`` less its repeated lines, plus ``n_lines`` and ``n_lines_removed``.

    Kept lines are joined by \\n. A null text stays null with no lines; an empty
    text is one line. A text all of whose lines go becomes empty. Columns of the
    input stay as they were but for ``text``; those of the names added are replaced.
    """
    docs = docs.drop("n_lines", "n_lines_removed")
    gone = repeated_lines(docs, doc_id=doc_id, text=text)
    gone = gone.select(F.col("doc").alias("_doc"), F.col("copy").alias("_copy"), F.col("gone").alias("_gone"))
    joined = docs.join(gone, (docs[doc_id] == gone["_doc"]) & (F.xxhash64(docs[text]) == gone["_copy"]), "left")
    counted = joined.select(
        *docs.columns,
        F.when(F.col(text).isNull(), 0).otherwise(F.size(_lines(F.col(text)))).cast("long").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_lines_removed"),
        "_gone",
    )
    schema = counted.drop("_gone").select("*").schema
    return counted.mapInArrow(_without(docs.columns.index(text)), schema)


def _without(at: int):
    """Rows whose text column, at a position, loses the lines of the last column, which goes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for b in batches for part in slices(b, at)):
            columns, gone = batch.columns[:-1], batch.columns[-1]
            texts = columns[at].to_pylist()
            for i in np.flatnonzero(gone.is_valid().to_numpy(zero_copy_only=False)):
                lost = set(gone[int(i)].as_py())
                texts[i] = "\n".join(line for k, line in enumerate(texts[i].split("\n")) if k not in lost)
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-1])

    return run
