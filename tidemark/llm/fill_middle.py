"""Fill-in-the-middle texts: a document is cut twice and its middle moves to the end.

Everything that grows with a text runs in ``pyarrow.compute`` kernels over a
batch: units are split into lists, flattened beside the index of their row,
numbered inside it, filtered by the role their number gives them, gathered into
lists again and joined.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import fields_and
from tidemark.llm.words import slices

# Marks of the prefix, the suffix and the middle.
MARKS = ("<P>", "<S>", "<M>")
# A unit: a word with the white space before it, or white space at the end.
UNIT = rb"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
# A byte that no UTF-8 text holds.
_CUT = b"\xff"


def transform(
    docs: DataFrame, *, seed: int = 42, percent: int = 50, spm_percent: int = 80, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: key, ``n`` units, ``form``, ``output`` and the code points of prefix and middle.

    The cuts and the form follow from the seed, the key and the number of units
    alone, so a run that is repeated gives the same rows. Of the texts,
    ``percent`` in a hundred are changed, ``spm_percent`` in a hundred of these
    with the suffix first. A text that is empty, or holds a mark, stays plain,
    and its ``prefix_chars`` and ``middle_chars`` are null. A null text counts
    as empty, a null key as an empty one. Texts are taken whole, whatever their
    length; equal rows give equal rows; other columns are not read, so their
    names do not matter. An empty table gives no rows.
    """
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), key).cast("binary"), 256)
    h1, h2, h3, h4 = (F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4))
    whole = F.coalesce(F.col(text), F.lit(""))
    plain = (whole == "") | (h3 % 100 >= percent)
    for mark in MARKS:
        plain |= whole.contains(mark)
    form = F.when(plain, "plain").when(h4 % 100 < spm_percent, "spm").otherwise("psm")
    source = docs.select(F.col(doc_id).alias("key"), whole.alias("text"), form.alias("form"), h1.alias("h1"), h2.alias("h2"))
    schema = fields_and(docs.select(doc_id), "n long, form string, output string, prefix_chars long, middle_chars long")
    return source.mapInArrow(_transformed(doc_id), schema)


def restored(output: Column, form: Column) -> Column:
    """The text an output was made from: its pieces between the marks, in their first order."""
    pieces = F.split(output, "|".join(map(re.escape, MARKS)))
    psm = F.concat(pieces[1], pieces[3], pieces[2])
    spm = F.concat(pieces[2], pieces[3], pieces[1])
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def _transformed(doc_id: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for b in batches for part in slices(b, 1)):
            n, *made = _pieces(*batch.columns[1:])
            columns = [batch.column(0), n, batch.column(2), *made]
            yield pa.RecordBatch.from_arrays(columns, [doc_id, "n", "form", "output", "prefix_chars", "middle_chars"])

    return run


def _pieces(texts: pa.Array, forms: pa.Array, h1: pa.Array, h2: pa.Array) -> tuple[pa.Array, ...]:
    """Units per text, the outputs, and the code points of prefixes and middles."""
    whole = texts.cast(pa.large_string()).cast(pa.large_binary())
    # Every unit gets the cut byte behind it, so each list ends with one empty string.
    lists = pc.split_pattern(pc.replace_substring_regex(whole, pattern=UNIT, replacement=b"\\0" + _CUT), _CUT)
    n = pc.subtract(pc.list_value_length(lists).cast(pa.int64()), 1)
    units, parents = pc.list_flatten(lists), pc.list_parent_indices(lists)
    starts = pc.subtract(lists.offsets.cast(pa.int64()), lists.offsets[0].cast(pa.int64()))
    ordinals = pc.subtract(pa.array(np.arange(len(units))), pc.take(starts, parents))
    cut1, cut2 = _remainder(h1, pc.add(n, 1)), _remainder(h2, pc.add(n, 1))
    first, last = pc.min_element_wise(cut1, cut2), pc.max_element_wise(cut1, cut2)
    before = pc.less(ordinals, pc.take(first, parents))
    after = pc.greater_equal(ordinals, pc.take(last, parents))
    prefix = _joined(units, before, first)
    middle = _joined(units, pc.invert(pc.or_(before, after)), pc.subtract(last, first))
    suffix = _joined(units, after, pc.add(pc.subtract(n, last), 1))
    spm, plain = pc.equal(forms, "spm"), pc.equal(forms, "plain")
    p, s, m = (pa.scalar(mark.encode(), pa.large_binary()) for mark in MARKS)
    moved = pc.binary_join_element_wise(
        pc.if_else(spm, s, p), pc.if_else(spm, suffix, prefix), pc.if_else(spm, p, s), pc.if_else(spm, prefix, suffix), m, middle, pa.scalar(b"", pa.large_binary())
    )
    output = pc.if_else(plain, whole, moved).cast(pa.string())
    none = pa.scalar(None, pa.int64())
    chars = [pc.if_else(plain, none, pc.utf8_length(x.cast(pa.large_string())).cast(pa.int64())) for x in (prefix, middle)]
    return n, output, *chars


def _remainder(x: pa.Array, by: pa.Array) -> pa.Array:
    return pc.subtract(x, pc.multiply(pc.divide(x, by), by))


def _joined(units: pa.Array, chosen: pa.Array, sizes: pa.Array) -> pa.Array:
    """The chosen units, in lists of these sizes, each joined to one string."""
    offsets = pa.concat_arrays([pa.array([0], pa.int64()), pc.cumulative_sum(sizes)])
    lists = pa.LargeListArray.from_arrays(offsets, pc.filter(units, chosen))
    return pc.binary_join(lists, pa.scalar(b"", pa.large_binary()))
