"""Removal of byte strings that an earlier document holds, by suffix sorting.

Every window of ``SPAN`` bytes has an anchor: its gram of ``GRAM`` bytes with the
least hash. Neighbouring windows of one anchor form a segment, so equal windows
lie in segments of equal anchors. Segments equal as a whole are settled by their
hash and smallest document; unequal segments of a shared anchor are brought
together, their suffixes sorted in two stages, and windows that are neighbours
with a common prefix of SPAN bytes settled by their smallest document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import written
from tidemark.llm.words import chunks, mixed, slices

SPAN = 50
GRAM = 24
_WINDOW = SPAN - GRAM + 1  # grams of a window
# Bytes of text behind one group of segment hashes, and bytes of segments in one suffix array.
BUCKET_BYTES = 24_000_000
SORTED_BYTES = 1_000_000
# An anchor with this many different segments in a task and in all is cut into single windows.
HOT_IN_TASK, HOT = 64, 500_000
# Different segments of an anchor up to which their suffixes are sorted in one task; windows of more are settled by hash.
SORTED_SEGMENTS = 20_000

_BYTE = mixed(np.arange(1, 257, dtype=np.uint64))
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_WHOLE = -1  # mask of a segment all of whose windows go


def _windowed(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the 32 bytes from each place, and of its gram; places near the end are of no use."""
    level, factor, n = _BYTE[data], _FACTOR, len(data)
    eight = level
    size = 1
    with np.errstate(over="ignore"):
        while size < 32:
            twice = level * factor
            twice[: n - size] += level[size:]
            if size == 8:
                eight = level
            if size == 16:
                gram = level * np.uint64(0xD1B54A32D192ED03)
                gram[: n - 16] += eight[16:]
                gram *= np.uint64(0xAEF17502108EF2D9)
            level, size, factor = twice, 2 * size, factor * factor
    return level, gram


def _least(gram: np.ndarray) -> np.ndarray:
    """The least gram of the window at each place: 40 bits of its hash and 24 of its place, so that the first of equals wins."""
    n = len(gram)
    gram &= ~np.uint64((1 << 24) - 1)
    gram |= np.arange(n, dtype=np.uint64)
    reach = 1
    while reach < _WINDOW:
        step = min(reach, _WINDOW - reach)
        gram = np.minimum(gram[:-step], gram[step:])
        reach += step
    return gram


def segments(data: np.ndarray, offsets: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, start, windows, anchor hash and segment hash of every segment of the rows."""
    none = np.zeros(0, np.int32)
    lengths = np.diff(offsets)
    if lengths.max(initial=0) < SPAN:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    h32, gram = _windowed(data)
    least = _least(gram)[: len(data) - SPAN + 1]
    # A window opens a segment where its anchor is another than the one before's, or its row starts.
    opens = np.ones(len(least), bool)
    np.not_equal(least[1:], least[:-1], out=opens[1:])
    if len(hot):
        single = np.isin(least >> np.uint64(24), hot)
        opens |= single
        opens[1:] |= single[:-1]
    opens[offsets[:-1][offsets[:-1] < len(opens)]] = True
    last = offsets[1:] - SPAN + 1  # windows from here on leave the row
    tails = (last[:, None] + np.arange(SPAN - 1)).ravel()
    opens[tails[(tails >= 0) & (tails < len(opens)) & (tails >= np.repeat(offsets[:-1], SPAN - 1))]] = False
    for row in np.flatnonzero((lengths < SPAN) & (lengths > 0)):
        opens[offsets[row] : offsets[row + 1]] = False
    start = np.flatnonzero(opens)
    row = np.searchsorted(offsets, start, "right") - 1
    following = np.append(start[1:], len(data))
    windows = np.minimum(following, last[row]) - start
    length = windows + SPAN - 1
    with np.errstate(over="ignore"):
        whole = h32[start] * np.uint64(0xA0761D6478BD642F) + h32[start + (length - 32) // 2] * np.uint64(0xE7037ED1A0B428DB)
        whole = mixed(whole + h32[start + length - 32] * np.uint64(0x8EBC6AF09C88C6E3) + windows.astype(np.uint64))
    anchor = least[start] >> np.uint64(24)
    if len(hot):
        anchor = np.where(single[start], whole >> np.uint64(24), anchor)
    return row.astype(np.int32), (start - offsets[:-1][row]).astype(np.int32), windows.astype(np.int32), anchor, whole


def _all_segments(texts: pa.Array, hot: np.ndarray) -> tuple[np.ndarray, ...]:
    """Segments of all texts of an array; row counts from its first text."""
    found = []
    for first, data, offsets in chunks(texts):
        # Longer than an anchor's place can count: pieces that overlap by a window less one byte.
        if len(offsets) == 2 and len(data) > 8_000_000:
            for a in range(0, len(data), 4_000_000):
                part = data[a : a + 4_000_000 + SPAN - 1]
                row, start, *more = segments(part, np.array([0, len(part)]), hot)
                found.append((row + first, start + a, *more))
        else:
            row, *more = segments(data, offsets, hot)
            found.append((row + first, *more))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else segments(np.zeros(0, np.uint8), np.zeros(1, int), hot)


def _table(schema: str, *columns) -> pa.RecordBatch:
    names = [c.split()[0] for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)


_HOT = "anchor long, segments long"


def _crowded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors with many different segments in a batch."""
    for batch in (part for b in batches for part in slices(b, 0)):
        _, _, _, anchor, whole = _all_segments(batch.column(0), np.zeros(0, np.uint64))
        keys, counts = np.unique(anchor[np.unique(whole, return_index=True)[1]], return_counts=True)
        many = counts >= HOT_IN_TASK
        yield _table(_HOT, keys[many].astype(np.int64), counts[many].astype(np.int64))


_ENTRIES = "bucket int, settled boolean, docs binary, anchors binary, hashes binary"


def _hashed(buckets: int, hot: np.ndarray):
    """Per batch and bucket the segments of the smallest document; later documents of the batch are settled at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for b in batches for part in slices(b, 1)):
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            row, _, _, anchor, whole = _all_segments(batch.column(1), hot)
            doc = ids[row]
            order = np.lexsort((doc, whole))
            doc, anchor, whole = doc[order], anchor[order], whole[order]
            opens = np.ones(len(doc), bool)
            opens[1:] = whole[1:] != whole[:-1]
            least = doc[opens][np.cumsum(opens) - 1] if len(doc) else doc
            later = doc > least
            later[1:] &= ~(later[:-1] & (whole[1:] == whole[:-1]) & (doc[1:] == doc[:-1]))
            rows = [[], [], [], [], []]
            for settled, chosen in ((True, np.flatnonzero(later)), (False, np.flatnonzero(opens))):
                bucket = (mixed(anchor[chosen]) % np.uint64(buckets)).astype(np.int64)
                by = chosen[np.argsort(bucket, kind="stable")]
                numbers, starts = np.unique(np.sort(bucket), return_index=True)
                for number, part in zip(numbers, np.split(by, starts[1:]) if len(by) else [], strict=True):
                    rows[0].append(int(number))
                    rows[1].append(settled)
                    rows[2].append(doc[part].tobytes() if settled else _packed(doc[part]))
                    rows[3].append(b"" if settled else (anchor[part] & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes())
                    rows[4].append(whole[part].tobytes())
            yield _table(_ENTRIES, pa.array(rows[0], pa.int32()), pa.array(rows[1], pa.bool_()), *(pa.array(r, pa.binary()) for r in rows[2:]))

    return run


def _packed(docs: np.ndarray) -> bytes:
    """Document ids as a list of the different ones and a short number for each."""
    ids, place = np.unique(docs, return_inverse=True)
    kind = np.uint16 if len(ids) < 1 << 16 else np.uint32
    return np.int64(len(ids)).tobytes() + ids.tobytes() + place.astype(kind).tobytes()


def _unpacked(packed: bytes) -> np.ndarray:
    n = int(np.frombuffer(packed, np.int64, 1)[0])
    ids = np.frombuffer(packed, np.int64, n, 8)
    return ids[np.frombuffer(packed, np.uint16 if n < 1 << 16 else np.uint32, -1, 8 + 8 * n)]


_ANSWERS = "doc long, segment long, mask long, anchor long"


def _settled(table: pa.Table) -> pa.Table:
    """Segments of later documents, with mask _WHOLE, and with mask 0 the segments to compare by suffixes."""
    docs, anchors, hashes, done_docs, done_hashes = [], [], [], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for settled, doc, anchor, whole in zip(*(table.column(c) for c in ("settled", "docs", "anchors", "hashes")), strict=True):
        if settled.as_py():
            done_docs.append(np.frombuffer(doc.as_buffer(), np.int64))
            done_hashes.append(np.frombuffer(whole.as_buffer(), np.uint64))
        else:
            docs.append(_unpacked(doc.as_py()))
            anchors.append(np.frombuffer(anchor.as_buffer(), np.uint32))
            hashes.append(np.frombuffer(whole.as_buffer(), np.uint64))
    out_docs, out_hashes = np.concatenate(done_docs), np.concatenate(done_hashes)
    masks, groups = np.full(len(out_docs), _WHOLE, np.int64), np.zeros(len(out_docs), np.int64)
    if docs:
        doc, anchor, whole = (np.concatenate(x) for x in (docs, anchors, hashes))
        order = np.lexsort((doc, whole, anchor))
        doc, anchor, whole = doc[order], anchor[order], whole[order]
        new_anchor = np.ones(len(doc), bool)
        new_anchor[1:] = anchor[1:] != anchor[:-1]
        opens = new_anchor.copy()
        opens[1:] |= whole[1:] != whole[:-1]
        least = doc[opens][np.cumsum(opens) - 1]
        later = np.flatnonzero(doc > least)
        first = np.flatnonzero(new_anchor)
        shared = np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first)
        several = np.add.reduceat(opens.astype(np.int64), first) > 1
        unsure = np.flatnonzero(opens & (shared & several)[np.cumsum(new_anchor) - 1])
        bucket = table.column("bucket")[0].as_py()
        out_docs = np.concatenate([out_docs, doc[later], doc[unsure]])
        out_hashes = np.concatenate([out_hashes, whole[later], whole[unsure]])
        masks = np.concatenate([masks, np.full(len(later), _WHOLE), np.zeros(len(unsure), np.int64)])
        groups = np.concatenate([groups, np.zeros(len(later), np.int64), (anchor[unsure].astype(np.int64) << 24) ^ bucket])
    return pa.table({"doc": out_docs, "segment": out_hashes.view(np.int64), "mask": masks, "anchor": groups})


_STRINGS = "anchor long, segment long, doc long, bytes binary"


def _fetched(hot: np.ndarray):
    """Bytes of the segments asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for b in batches for part in slices(b, 1)):
            row, start, windows, _, whole = _all_segments(batch.column(1), hot)
            edges = np.searchsorted(row, np.arange(batch.num_rows + 1))
            out = [[], [], [], []]
            for i in range(batch.num_rows):
                a, b = edges[i], edges[i + 1]
                asked = batch.column(2)[i].values
                text = (batch.column(1)[i].as_py() or "").encode()
                known, first = np.unique(whole[a:b], return_index=True)
                wanted = asked.field("segment").to_numpy().view(np.uint64)
                spot = np.searchsorted(known, wanted)
                spot[spot == len(known)] = 0
                for k in np.flatnonzero(known[spot] == wanted) if len(known) else ():
                    s = a + first[spot[k]]
                    out[3].append(text[start[s] : start[s] + windows[s] + SPAN - 1])
                    out[1].append(int(wanted[k].view(np.int64)))
                    out[2].append(batch.column(0)[i].as_py())
                    out[0].append(asked.field("anchor")[int(k)].as_py())
            yield _table(_STRINGS, *(pa.array(o, pa.int64()) for o in out[:3]), pa.array(out[3], pa.binary()))

    return run


def suffix_array(text: np.ndarray, ends: np.ndarray, longest: int) -> np.ndarray:
    """Order of all suffixes of the strings of a text, each suffix ending with its string.

    Two stages: suffixes that begin with a byte not above its successor, and the
    last of each string, are sorted directly. The others begin with a byte above
    the next one, so their successors lie in earlier buckets: a scan of the
    buckets in order puts each of them behind those already there.
    """
    n = len(text)
    value = text.astype(np.int64) + 1
    follows = np.zeros(n, np.int64)
    follows[:-1] = value[1:]
    follows[ends - 1] = 0
    last = np.zeros(n, bool)
    last[ends - 1] = True
    direct = (value <= follows) | last
    chosen = np.flatnonzero(direct)
    # Bytes up to the string's end, filled with zeros.
    padded = np.concatenate([text, np.zeros(longest, np.uint8)])
    rows = np.lib.stride_tricks.sliding_window_view(padded, longest)[chosen]
    left = (ends[np.searchsorted(ends, chosen, "right")] - chosen).astype(np.int64)
    rows = np.where(np.arange(longest) < left[:, None], rows, np.uint8(0))
    chosen = chosen[np.lexsort((left, rows.view(f"S{longest}").ravel()))]
    by_value = np.split(chosen[np.argsort(value[chosen], kind="stable")], np.cumsum(np.bincount(value[chosen], minlength=257))[:-1])
    induced: list[list[np.ndarray]] = [[] for _ in range(257)]
    order = []
    for byte in range(1, 257):
        # Induced suffixes begin with (byte, smaller byte): before the direct ones, but after a lone last byte.
        own = by_value[byte]
        lone = own[last[own]]
        bucket = np.concatenate([lone, *induced[byte], own[~last[own]]])
        order.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[~direct[before]]
        if len(before):
            heads = value[before]
            ranked = before[np.argsort(heads, kind="stable")]
            numbers, starts = np.unique(np.sort(heads), return_index=True)
            for head, part in zip(numbers, np.split(ranked, starts[1:]), strict=True):
                induced[head].append(part)
    return np.concatenate(order)


def _compared(table: pa.Table) -> pa.Table:
    """Windows of the segments of a group that a smaller document holds too, as a mask per segment."""
    strings = table.column("bytes").to_pylist()
    sizes = np.array([len(s) for s in strings], np.int64)
    text = np.frombuffer(b"".join(strings), np.uint8)
    ends = np.cumsum(sizes)
    doc = table.column("doc").to_numpy()
    order = suffix_array(text, ends, int(sizes.max()))
    owner = np.searchsorted(ends, order, "right")
    full = ends[owner] - order >= SPAN
    order, owner = order[full], owner[full]
    window = np.lib.stride_tricks.sliding_window_view(text, SPAN)[order]
    opens = np.ones(len(order), bool)
    opens[1:] = (window[1:] != window[:-1]).any(1)  # the common prefix with the one before is shorter
    first = np.flatnonzero(opens)
    least = np.minimum.reduceat(doc[owner], first)[np.cumsum(opens) - 1]
    gone = np.flatnonzero(least < doc[owner])
    masks = np.zeros(len(strings), np.int64)
    place = order[gone] - (ends - sizes)[owner[gone]]
    np.bitwise_or.at(masks, owner[gone], np.int64(1) << place)
    some = np.flatnonzero(masks)
    return pa.table({"doc": doc[some], "segment": table.column("segment").to_numpy()[some], "mask": masks[some], "anchor": np.zeros(len(some), np.int64)})


_WINDOWS = "window long, doc long, segment long, place int"


def _single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash of each window of the segments."""
    for batch in (part for b in batches for part in slices(b, 3)):
        sizes = np.array([len(s) for s in batch.column(3).to_pylist()], np.int64)
        if not len(sizes):
            continue
        text = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8)
        windows = sizes - SPAN + 1
        owner = np.repeat(np.arange(len(sizes)), windows)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
        start = (np.cumsum(sizes) - sizes)[owner] + place
        h32, _ = _windowed(text)
        with np.errstate(over="ignore"):
            window = mixed(h32[start] * np.uint64(0xA0761D6478BD642F) + h32[start + SPAN - 32] * np.uint64(0xE7037ED1A0B428DB))
        doc, segment = (batch.column(c).to_numpy()[owner] for c in (2, 1))
        yield _table(_WINDOWS, window.view(np.int64), doc, segment, place.astype(np.int32))


def _by_window(strings: DataFrame) -> DataFrame:
    """What _compared gives, for segments of any number: each window by its hash and smallest document."""
    windows = written(strings.mapInArrow(_single, _WINDOWS), "windows")
    least = windows.groupBy("window").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most")
    gone = windows.join(least, "window").where("doc > least")
    mask = F.expr("bit_or(shiftleft(1L, place))")
    return gone.groupBy("doc", "segment").agg(mask.alias("mask")).select("doc", "segment", "mask", F.lit(0).cast("long").alias("anchor"))


def _kept(hot: np.ndarray, doc_id: str, schema_names: list[str]):
    """What is left of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for b in batches for part in slices(b, 1)):
            texts, found = batch.column(1), batch.column(2)
            row, start, windows, _, whole = _all_segments(pa.array([t if f.is_valid else None for t, f in zip(texts.to_pylist(), found, strict=True)], pa.large_string()), hot)
            edges = np.searchsorted(row, np.arange(batch.num_rows + 1))
            out = [[], [], [], []]
            for i, text in enumerate(texts.to_pylist()):
                data = (text or "").encode()
                kept, removed, spans = data, 0, 0
                if found[i].is_valid:
                    a, b = edges[i], edges[i + 1]
                    gone = _gone(len(data), start[a:b], windows[a:b], whole[a:b], found[i].values)
                    removed = int(gone.sum())
                    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(gone) else 0
                    kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                out[0].append(len(data))
                out[1].append(removed)
                out[2].append(spans)
                out[3].append(kept)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(o, pa.int64()) for o in out[:3]), pa.array(out[3], pa.binary())], schema_names
            )

    return run


def _gone(size: int, start, windows, whole, answers) -> np.ndarray:
    """Bytes covered by windows that go."""
    segment = answers.field("segment").to_numpy().view(np.uint64)
    mask = answers.field("mask").to_numpy()
    order = np.argsort(segment, kind="stable")
    segment, mask = segment[order], mask[order]
    first = np.flatnonzero(np.diff(segment, prepend=~segment[:1]))
    segment, mask = segment[first], np.bitwise_or.reduceat(mask, first)
    spot = np.minimum(np.searchsorted(segment, whole), len(segment) - 1)
    own = np.where(segment[spot] == whole, mask[spot], 0)
    change = np.zeros(size + 1, np.int32)
    for k in range(int(windows.max(initial=0))):
        at = start[(k < windows) & ((own >> k) & 1 == 1)] + k
        np.add.at(change, at, 1)
        np.add.at(change, at + SPAN, -1)
    return np.cumsum(change[:-1]) > 0


def remove_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, ``n_bytes``, ``n_removed``, ``n_spans`` and the ``kept`` bytes.

    A byte goes if a string of 50 bytes around it also starts in a row of a
    smaller key. Null and short texts lose nothing; rows with a null key neither
    lose nor take. Rows of one key never take from each other, so repeated rows
    give equal results. Keys are integers.
    """
    source = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"))
    known = source.where("doc IS NOT NULL")
    total = known.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_BYTES))
    crowded = source.where("doc IS NOT NULL").select("text").mapInArrow(_crowded, _HOT).groupBy("anchor").agg(F.sum("segments").alias("n"))
    # Each hot anchor has HOT segments or more, so they are few beside the text.
    hot = np.array(sorted(r["anchor"] for r in crowded.where(F.col("n") >= HOT).collect()), np.uint64)
    entries = known.mapInArrow(_hashed(buckets, hot), _ENTRIES)
    settled = written(entries.groupBy("bucket").applyInArrow(_settled, _ANSWERS), "segments")
    unsettled = settled.where("mask = 0")

    def fetched(wanted: DataFrame) -> DataFrame:
        asked = wanted.groupBy("doc").agg(F.collect_list(F.struct("segment", "anchor")).alias("asked"))
        return known.join(asked, "doc").select("doc", "text", "asked").mapInArrow(_fetched(hot), _STRINGS)

    # Each large anchor has more than SORTED_SEGMENTS segments, so they are few.
    large = [r["anchor"] for r in unsettled.groupBy("anchor").count().where(F.col("count") > SORTED_SEGMENTS).collect()]
    sorted_, single = unsettled, None
    if large:
        many = F.broadcast(docs.sparkSession.createDataFrame([(a,) for a in large], "anchor long"))
        sorted_, single = unsettled.join(many, "anchor", "left_anti"), unsettled.join(many, "anchor", "left_semi")
    strings = fetched(sorted_)
    unsure = sorted_.count()
    arrays = max(1, -(-unsure * 64 // SORTED_BYTES))
    compared = strings.groupBy(F.pmod(F.xxhash64("anchor"), F.lit(arrays)).alias("array")).applyInArrow(_compared, _ANSWERS)
    if single is not None:
        compared = compared.unionByName(_by_window(fetched(single)))
    answers = (
        settled.where("mask <> 0")
        .unionByName(compared)
        .groupBy("doc")
        .agg(F.collect_list(F.struct("segment", "mask")).alias("found"))
    )
    names = [doc_id, "n_bytes", "n_removed", "n_spans", "kept"]
    out = f"`{doc_id}` long, n_bytes long, n_removed long, n_spans long, kept binary"
    # Both joins deal the texts out alike, so Spark reuses the exchange.
    kept = known.join(answers, "doc", "left").select("doc", "text", "found").mapInArrow(_kept(hot, doc_id, names), out)
    lone = source.where("doc IS NULL").select("doc", "text", F.lit(None).cast("array<struct<segment:long,mask:long>>").alias("found"))
    return kept.unionByName(lone.mapInArrow(_kept(hot, doc_id, names), out))
