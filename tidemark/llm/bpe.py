"""Byte-level BPE encoding and decoding with recursive DuckDB queries in each task.

A task splits its texts by the tokenizer's pattern and hands the distinct pieces
it has not seen to DuckDB. There the piece is a list of byte tokens. A recursive
query joins the (position, left, right) rows with the merge table, contracts each
piece's leftmost pair of least rank and repeats this until no pair is known. Ids
are turned back to bytes by an ordered aggregation over (piece, position, id).
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.words import slices

# Characters split at once and pieces kept in a task: bounds of memory, not of the result.
BATCH_CHARS = 4_000_000
PIECES_KEPT = 600_000
PIECES_ASKED = 100_000
# Longer pieces keep only their last state, shorter ones all states up to the fixpoint.
SHORT = 64
# Pieces of more bytes are encoded in windows of WINDOW bytes and OVERLAP more that are shared with the next one.
LONG = 1024
WINDOW, OVERLAP, WINDOWS_ASKED = 240, 120, 2_000

_PAIRS = """
    SELECT piece, min(rank::BIGINT << 32 | i) AS best
    FROM (SELECT piece, unnest(range(1, len(toks))) AS i, unnest(toks[:-2]) AS l, unnest(toks[2:]) AS r
          FROM s WHERE len(toks) > 1) p
    JOIN merges m ON m.pair = (p.l::BIGINT << 32 | p.r) GROUP BY piece
"""
_CONTRACT = "s.toks[:(best & 4294967295) - 1] || [(best >> 32)::INT] || s.toks[(best & 4294967295) + 2:]"
_ENCODE_SHORT = f"""
WITH RECURSIVE s(piece, step, toks) AS (
    SELECT piece, 0, toks FROM pieces
    UNION ALL
    SELECT s.piece, s.step + 1, {_CONTRACT} FROM s JOIN ({_PAIRS}) b ON b.piece = s.piece)
SELECT piece, arg_max(toks, step) AS toks FROM s GROUP BY piece ORDER BY piece
"""
_ENCODE_LONG = f"""
WITH RECURSIVE s(piece, toks) USING KEY (piece) AS (
    SELECT piece, toks FROM pieces
    UNION
    SELECT s.piece, {_CONTRACT} FROM s JOIN ({_PAIRS}) b ON b.piece = s.piece)
SELECT piece, toks FROM s ORDER BY piece
"""
_DECODE = """
WITH t AS (SELECT piece, unnest(range(1, len(toks) + 1)) AS i, unnest(toks) AS id FROM pieces)
SELECT piece, unhex(string_agg(v.hex, '' ORDER BY i)) AS bytes FROM t JOIN vocabulary v USING (id) GROUP BY piece ORDER BY piece
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """A vocabulary file: one base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class _Tokenizer:
    """The DuckDB tables of a Python worker and the pieces it has met."""

    @classmethod
    def of_worker(cls, ranks: dict[bytes, int], pattern: str) -> _Tokenizer:
        """The one of this worker, which its later tasks use again."""
        own = getattr(cls, "own", None)
        if own is None or own.ranks != ranks or own.pattern.pattern != pattern:
            own = cls.own = cls(ranks, pattern)
        return own

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import duckdb
        import regex

        self.pattern = regex.compile(pattern)
        self.ranks = ranks
        self.ids: dict[str, bytes] = {}
        self.texts: dict[str, bytes] = {}
        self.kept = PIECES_KEPT
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        self.sizes[list(ranks.values())] = list(map(len, ranks))
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
        merges = [
            (ranks[token[:i]] << 32 | ranks[token[i:]], rank)
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        ]
        self.db.register("merges_", pa.table({"pair": [m[0] for m in merges], "rank": pa.array([m[1] for m in merges], pa.int32())}))
        self.db.register("vocabulary_", pa.table({"id": pa.array(ranks.values(), pa.int32()), "hex": [t.hex() for t in ranks]}))
        self.db.execute("CREATE TABLE merges AS FROM merges_")
        self.db.execute("CREATE TABLE vocabulary AS FROM vocabulary_")

    def learn(self, pieces: Iterable[str]) -> None:
        """Encode and decode pieces that are not known yet."""
        new = [p for p in pieces if p not in self.ids]
        for start in range(0, len(new), PIECES_ASKED):
            self._learn(new[start : start + PIECES_ASKED])

    def _learn(self, new: list[str]) -> None:
        encoded = [p.encode() for p in new]
        size = np.fromiter(map(len, encoded), np.int64, len(new))
        # A whole piece that is a token stands for itself, whatever its merges.
        whole = np.fromiter((self.ranks.get(p, -1) for p in encoded), np.int32, len(new))
        known = np.flatnonzero(whole >= 0)
        order, values, lengths = [known], [whole[known]], [np.ones(len(known), np.int64)]
        for i in np.flatnonzero((whole < 0) & (size > LONG)).tolist():
            toks = self._encode_windows(encoded[i])
            order.append(np.array([i]))
            values.append(toks)
            lengths.append(np.array([len(toks)]))
        for fits, query in ((size <= SHORT, _ENCODE_SHORT), ((size > SHORT) & (size <= LONG), _ENCODE_LONG)):
            some = np.flatnonzero((whole < 0) & fits)
            if len(some):
                data = np.frombuffer(b"".join([encoded[i] for i in some.tolist()]), np.uint8)
                states = self._ask(query, self.bytes[data], size[some])
                order.append(some)
                values.append(states.flatten().to_numpy())
                lengths.append(states.value_lengths().to_numpy())
        ids, sizes = np.concatenate(values), np.concatenate(lengths)
        decoded = self._ask(_DECODE, ids, sizes).to_pylist()
        raw, ends = ids.astype("<u4").tobytes(), (4 * np.cumsum(sizes)).tolist()
        start = 0
        for i, end, text in zip(np.concatenate(order).tolist(), ends, decoded, strict=True):
            self.ids[new[i]] = raw[start:end]
            self.texts[new[i]] = text
            start = end

    def _encode_windows(self, piece: bytes) -> np.ndarray:
        """Ids of a long piece, from windows that overlap, in time linear in its length.

        Where two windows have the same token before and the same token after a
        place, the one's tokens go on with the other's: neither merges across the
        place, and the merges inside these two tokens come in the same order in
        any text that has both, so the whole piece has no merge across it either.
        Two windows without such a place are encoded again as one, up to the whole piece.
        """
        data = self.bytes[np.frombuffer(piece, np.uint8)]
        bounds = [(a, min(a + WINDOW + OVERLAP, len(piece))) for a in range(0, max(1, len(piece) - OVERLAP), WINDOW)]
        done: list[tuple[int, int, np.ndarray, np.ndarray]] = []  # first and end byte, ids, byte after each id
        while bounds:
            for some in (bounds[i : i + WINDOWS_ASKED] for i in range(0, len(bounds), WINDOWS_ASKED)):
                sizes = np.array([b - a for a, b in some])
                states = self._ask(_ENCODE_LONG, np.concatenate([data[a:b] for a, b in some]), sizes)
                ids, cuts = states.flatten().to_numpy(), np.append(0, np.cumsum(states.value_lengths().to_numpy()))
                for (a, b), i, j in zip(some, cuts[:-1], cuts[1:], strict=True):
                    done.append((a, b, ids[i:j], a + np.cumsum(self.sizes[ids[i:j]])))
            done.sort(key=lambda w: w[0])
            bounds, kept, joins = [], [], []
            for window in done:
                if not kept or window[0] >= kept[-1][1]:  # the first, or the one before is encoded again
                    place = window[0]
                else:
                    place = _common_place(kept[-1], window, joins[-1])
                if place is None:
                    bounds.append((kept.pop()[0], window[1]))
                    joins.pop()
                else:
                    kept.append(window)
                    joins.append(place)
            done = kept
        out, start = [], 0
        for (_, _, ids, ends), end in zip(done, [*joins[1:], len(piece)], strict=True):
            out.append(ids[np.searchsorted(ends, start, "right") : np.searchsorted(ends, end, "right")])
            start = end
        return np.concatenate(out)

    def _ask(self, query: str, values: np.ndarray, sizes: np.ndarray) -> pa.Array:
        """One row per list, in order; the lists are the values cut into these sizes."""
        ends = np.zeros(len(sizes) + 1, np.int32)
        np.cumsum(sizes, out=ends[1:])
        toks = pa.ListArray.from_arrays(pa.array(ends), pa.array(values))
        self.db.register("pieces", pa.table({"piece": pa.array(np.arange(len(sizes), dtype=np.int32)), "toks": toks}))
        return self.db.sql(query).to_arrow_table().column(1).combine_chunks()

    def parts(self, text: str) -> Iterator[list[str]]:
        """The pieces of a text, some at a time."""
        if len(text) <= BATCH_CHARS:
            yield self.pattern.findall(text)
            return
        found = (m.group() for m in self.pattern.finditer(text))
        while some := list(islice(found, PIECES_KEPT)):
            yield some

    def round_trips(self, texts: list[str]) -> tuple[list[bytes], list[bytes]]:
        """Ids and decoded bytes of short texts, learnt together, or of one long text."""
        if len(self.ids) > self.kept:
            self.ids.clear()
            self.texts.clear()
        ids, back = [], []
        if len(texts) > 1:
            split = [self.pattern.findall(text) for text in texts]
            self.learn(set().union(*split))
            for pieces in split:
                ids.append(b"".join(map(self.ids.__getitem__, pieces)))
                back.append(b"".join(map(self.texts.__getitem__, pieces)))
            return ids, back
        for text in texts:
            own, own_back = bytearray(), bytearray()
            for pieces in self.parts(text):
                self.learn(set(pieces))
                own += b"".join(map(self.ids.__getitem__, pieces))
                own_back += b"".join(map(self.texts.__getitem__, pieces))
            ids.append(bytes(own))
            back.append(bytes(own_back))
        return ids, back


def _common_place(left: tuple, right: tuple, after: int) -> int | None:
    """The first place beyond ``after`` with equal tokens of two windows on both sides, if any."""
    (_, _, ids, ends), (_, _, ids2, ends2) = left, right
    shared, i, j = np.intersect1d(ends[:-1], ends2[:-1], assume_unique=True, return_indices=True)
    equal = (ids[i] == ids2[j]) & (ids[i + 1] == ids2[j + 1]) & (shared > after)
    return int(shared[equal][0]) if equal.any() else None


def _groups(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of a bounded number of characters; a longer text stands alone."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > BATCH_CHARS:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def round_trip(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, *, doc_id: str = "doc_id", text: str = "text", pieces_kept: int = PIECES_KEPT
) -> DataFrame:
    """Per row: key, ``ids`` (little-endian unsigned 32-bit integers) and ``decoded``, the bytes these ids stand for.

    Each match of the pattern is encoded on its own, without special tokens. A
    null or empty text has no ids. Texts are encoded whole; repeated rows are
    repeated in the result, other columns are left out. ``pieces_kept`` bounds
    the memory of a worker, not the result.
    """
    schema = docs.select(doc_id).schema.add("ids", "binary").add("decoded", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _Tokenizer.of_worker(ranks, pattern)
        tokenizer.kept = pieces_kept
        for batch in (part for b in batches for part in slices(b, 1)):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for start, end in _groups(texts):
                ids, back = tokenizer.round_trips(texts[start:end])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, end - start), pa.array(ids, pa.binary()), pa.array(back, pa.binary())],
                    [doc_id, "ids", "decoded"],
                )

    return docs.select(F.col(doc_id), F.col(text)).mapInArrow(run, schema)


def decode(rows: DataFrame, ranks: dict[bytes, int], *, ids: str = "ids") -> DataFrame:
    """The rows plus ``decoded``: the bytes of the id array in ``ids``; null for null, empty for no ids.

    A column of that name is replaced. An id outside the vocabulary raises an error.
    """
    names = {rank: token for token, rank in ranks.items()}
    source = rows.drop("decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _Tokenizer.of_worker(ranks, "")
        for batch in batches:
            at = batch.schema.get_field_index(ids)
            lists = batch.column(at).to_pylist()
            filled = [i for i, x in enumerate(lists) if x]
            if any(x not in names for i in filled for x in lists[i]):
                raise ValueError("an id is not in the vocabulary")
            out: list[bytes | None] = [None if x is None else b"" for x in lists]
            if filled:
                values = np.concatenate([np.array(lists[i], np.int32) for i in filled])
                back = tokenizer._ask(_DECODE, values, np.array([len(lists[i]) for i in filled]))
                for i, text in zip(filled, back.to_pylist(), strict=True):
                    out[i] = text
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], [*batch.schema.names, "decoded"])

    return source.mapInArrow(run, source.select("*").schema.add("decoded", "binary"))
