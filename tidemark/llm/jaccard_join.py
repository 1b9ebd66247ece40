"""Near-duplicate documents by an exact Jaccard join of word n-grams over prefix trees.

Document frequencies order all n-grams. Only documents that share one of their
rarest n-grams (the prefix) can link, so such documents are brought together in
blocks. A block stores its sets in a trie; each set walks it once, sharing the
overlap counted along common paths, and leaves a subtree when the n-grams that
remain cannot reach the similarity or all of it is linked already. The links of a
block are a spanning forest: enough for the components, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import components, written
from tidemark.llm.words import chunks, mixed, slices, word_bounds, word_hashes
from tidemark.operators.joins import aggregate_for_join

WORDS = 5
PERCENT = 80
# Frequencies from here on are one class, ordered by hash.
FREQUENT = 64
# An n-gram is a hash of so many bits; with its frequency above them a long orders n-grams, rarest first.
GRAM_BITS = 56
# A set element that this share of a batch's documents hold is known to be frequent at once.
BATCH_SHARE = 8
# Bytes of text behind one group of the frequency count, and n-grams of a block and of a task's blocks.
BUCKET_BYTES = 12_000_000
BLOCK_GRAMS = 1_000_000
TASK_GRAMS = 1_500_000
# Prefix keys of a document that find most links before the exact round over all keys.
FIRST_KEYS = 3


def gram_sets(texts: pa.Array, words: int = WORDS) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, row of each element and element, sorted by both: the distinct n-grams of the texts as hashes.

    A text of fewer words has its whole sequence as one element, a text without words none.
    """
    salts = mixed(np.arange(1, words + 2, dtype=np.uint64)) | np.uint64(1)
    for first, data, offsets in chunks(texts):
        starts, ends, owner = word_bounds(data, offsets)
        h = word_hashes(data, starts, ends)
        rows = len(offsets) - 1
        counts = np.bincount(owner, minlength=rows)
        opens = np.cumsum(counts) - counts
        place = np.arange(len(h)) - opens[owner]
        full = np.flatnonzero(place + words <= counts[owner])
        total = np.zeros(len(full), np.uint64)
        for k in range(words):
            total += h[full + k] * salts[k]
        grams = [mixed(total) >> np.uint64(64 - GRAM_BITS)]
        of = [owner[full]]
        short = np.flatnonzero((counts > 0) & (counts < words))
        if len(short):
            own = np.flatnonzero(counts[owner] < words)
            value = np.zeros(rows, np.uint64)
            np.add.at(value, owner[own], h[own] * salts[place[own]])
            total = value[short] + counts[short].astype(np.uint64) * salts[words]
            grams.append(mixed(total) >> np.uint64(64 - GRAM_BITS))
            of.append(short)
        gram, row = np.concatenate(grams), np.concatenate(of)
        order = np.lexsort((gram, row))
        gram, row = gram[order], row[order]
        new = np.ones(len(gram), bool)
        new[1:] = (gram[1:] != gram[:-1]) | (row[1:] != row[:-1])
        yield first, row[new], gram[new]


_SETS = "bucket int, slice long, base boolean, docs binary, grams binary, more binary"
_SHARED = "slice long, base boolean, docs binary, grams binary, more binary"
_KNOWN = "slice long, uid long, doc_id long, n long, s1 long, s2 long, grams array<long>, keys array<long>"


def _deltas(values: np.ndarray) -> bytes:
    """Ascending numbers as their differences, in five bytes each if these do."""
    steps = np.diff(values, prepend=np.uint64(0))
    width = 5 if int(steps.max(initial=0)) < 1 << 40 else 8
    return bytes([width]) + steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _values(deltas: bytes) -> np.ndarray:
    width = deltas[0]
    steps = np.zeros(((len(deltas) - 1) // width, 8), np.uint8)
    if len(steps):
        steps[:, :width] = np.frombuffer(deltas, np.uint8, -1, 1).reshape(-1, width)
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64)


def _bucket(grams: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each hash; ascending hashes have ascending buckets."""
    return np.minimum((grams.astype(np.float64) * (buckets / 2.0**GRAM_BITS)).astype(np.int64), buckets - 1)


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    fields = [c.split() for c in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays(
        [pa.array(x, kinds[kind]) for x, (_, kind) in zip(columns, fields, strict=True)], [name for name, _ in fields]
    )


def _sets(buckets: int):
    """Per slice of rows: one base row for all its documents, and the n-grams of its first copies by bucket.

    A document goes by its place in the slice, and the slice by a hash of its documents.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for b in batches for part in slices(b, 2)):
            uid = batch.column(0).to_numpy()
            parts = list(gram_sets(batch.column(2)))
            row = np.concatenate([r + first for first, r, _ in parts])
            gram = np.concatenate([g for _, _, g in parts])
            n = np.bincount(row, minlength=len(uid))
            has = np.flatnonzero(n)
            s1, s2 = np.zeros(len(uid), np.uint64), np.zeros(len(uid), np.uint64)
            if len(has):
                opens = (np.cumsum(n) - n)[has]
                s1[has] = np.add.reduceat(mixed(gram), opens)
                s2[has] = np.add.reduceat(mixed(gram ^ np.uint64(0x5851F42D4C957F2D)), opens)
            # Of equal sets the smallest uid speaks for all.
            order = np.lexsort((uid, s2, s1, n))
            copy = np.zeros(len(uid), bool)
            a, b = order[1:], order[:-1]
            copy[a] = (n[a] == n[b]) & (s1[a] == s1[b]) & (s2[a] == s2[b])
            keep = ~copy[row]
            row, gram = row[keep], gram[keep]
            # Very common n-grams of the slice go with their documents at once and are only announced to the count.
            value, place, count = np.unique(gram, return_inverse=True, return_counts=True)
            common = (count >= FREQUENT) & (count * BATCH_SHARE >= len(uid))
            often = common[place]
            base = np.column_stack([uid, n, s1.view(np.int64), s2.view(np.int64)]).astype(np.int64)
            ids = batch.column(1).fill_null(0).to_numpy().astype(np.int64)
            known = batch.column(1).is_valid().to_numpy(zero_copy_only=False)
            places = np.arange(len(uid), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            whole = mixed(np.atleast_1d(mixed(uid.view(np.uint64) + places).sum(dtype=np.uint64)))
            here, at = int(whole.view(np.int64)[0]), int(whole[0] % np.uint64(buckets))
            kind = np.uint16 if len(uid) < 1 << 16 else np.uint32
            rows = [
                (at, here, True, base.tobytes(), ids.tobytes(), known.tobytes()),
                (at, here, False, row[often].astype(kind).tobytes(), b"", gram[often].tobytes()),
            ]
            announced = value[common]
            row, gram = row[~often], gram[~often]
            order = np.argsort(gram, kind="stable")
            row, gram = row[order], gram[order]
            # Equal ranges of all hashes are the buckets; only those that are met are written.
            own, heard = _bucket(gram, buckets), _bucket(announced, buckets)
            met = np.union1d(own, heard)
            a, b, c, d = (np.searchsorted(x, met, side) for x in (own, heard) for side in ("left", "right"))
            for k, bucket in enumerate(met.tolist()):
                inside = slice(a[k], b[k])
                rows.append(
                    (bucket, here, False, row[inside].astype(kind).tobytes(), _deltas(gram[inside]), announced[c[k] : d[k]].tobytes())
                )
            yield _batch(_SETS, rows)

    return run


def _places(packed: bytes, n: int) -> np.ndarray:
    """Numbers of ``n`` documents of a slice."""
    return np.frombuffer(packed, np.uint16 if len(packed) == 2 * n else np.uint32)


def _shared(table: pa.Table) -> pa.Table:
    """Base rows as they are; per slice the n-grams that more than one document holds, below their capped frequency."""
    passed, slices_, places, grams, announced, sizes = [], [], [], [], [], []
    columns = (table.column(c).to_pylist() for c in ("slice", "base", "docs", "grams", "more"))
    for here, is_base, docs, gram, more in zip(*columns, strict=True):
        if is_base:
            passed.append((here, True, docs, gram, more))
        elif not gram:
            if more:
                loud = np.frombuffer(more, np.uint64).view(np.int64) | np.int64(FREQUENT) << GRAM_BITS
                passed.append((here, False, docs, loud.tobytes(), b""))
        else:
            own = _values(gram)
            slices_.append(here)
            sizes.append(len(own))
            grams.append(own)
            places.append(_places(docs, len(own)).astype(np.uint32))
            announced.append(np.frombuffer(more, np.uint64))
    if slices_:
        gram = np.concatenate(grams)
        value, place, count = np.unique(gram, return_inverse=True, return_counts=True)
        df = np.minimum(count, FREQUENT)
        df[np.isin(value, np.concatenate(announced))] = FREQUENT
        each = df[place]
        ordered = gram.view(np.int64) | each.astype(np.int64) << GRAM_BITS
        end = 0
        for here, size, own in zip(slices_, sizes, places, strict=True):
            inside = np.flatnonzero(each[end : end + size] > 1)
            if len(inside):
                kind = np.uint16 if int(own.max()) < 1 << 16 else np.uint32
                passed.append((here, False, own[inside].astype(kind).tobytes(), ordered[end + inside].tobytes(), b""))
            end += size
    return pa.Table.from_batches([_batch(_SHARED, passed)])


def _lists(values: np.ndarray, opens: np.ndarray) -> pa.Array:
    """Values as lists that begin at the given places."""
    return pa.ListArray.from_arrays(pa.array(np.append(opens, len(values)).astype(np.int32)), pa.array(values))


def _prefixes(table: pa.Table) -> pa.Table:
    """Base rows, and the sets of a slice that can link: their shared n-grams, and of these the keys of the prefix.

    Rarest first come the n-grams of one document, then the shared ones. A set
    without a shared n-gram among its first n - ceil(0.8 n) + 1 has no link.
    """
    row, gram, base = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)], []
    columns = (table.column(c).to_pylist() for c in ("base", "docs", "grams", "more"))
    for is_base, docs, grams, more in zip(*columns, strict=True):
        if is_base:
            ids = pa.array(np.frombuffer(grams, np.int64), mask=~np.frombuffer(more, bool))
            base.append((np.frombuffer(docs, np.int64).reshape(-1, 4), ids))
        else:
            gram.append(np.frombuffer(grams, np.int64))
            row.append(_places(docs, len(gram[-1])).astype(np.uint32))
    uid, n = base[0][0][:, 0], base[0][0][:, 1]  # equal slices have equal documents
    here = table.column("slice")[0].as_py()
    row, gram = np.concatenate(row), np.concatenate(gram)
    order = np.lexsort((gram, row))
    row, gram = row[order], gram[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (gram[1:] != gram[:-1])
    row, gram = row[new], gram[new]
    opens = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else np.zeros(0, np.int64)
    counts = np.diff(np.append(opens, len(row)))
    of = row[opens]
    reach = n[of] - -(-n[of] * PERCENT // 100) + 1 - (n[of] - counts)
    can = np.flatnonzero(reach > 0)
    place = np.arange(len(row)) - np.repeat(opens, counts)
    kept = np.repeat(reach > 0, counts)
    key = place < np.repeat(reach, counts)
    keys = np.minimum(reach[can], counts[can])
    longs, none = pa.int64(), pa.list_(pa.int64())
    out = [
        pa.table({"slice": np.full(len(b), here), "uid": b[:, 0], "doc_id": ids, "n": b[:, 1], "s1": b[:, 2], "s2": b[:, 3], "grams": pa.nulls(len(b), none), "keys": pa.nulls(len(b), none)})
        for b, ids in base
    ]
    out.append(
        pa.table({
            "slice": np.full(len(can), here), "uid": uid[of[can]], "doc_id": pa.nulls(len(can), longs), "n": n[of[can]], "s1": pa.nulls(len(can), longs), "s2": pa.nulls(len(can), longs),
            "grams": _lists(gram[kept], np.cumsum(counts[can]) - counts[can]), "keys": _lists(gram[kept & key], np.cumsum(keys) - keys),
        })
    )
    return pa.concat_tables(out)


class Forest:
    """Which sets are linked already."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        parent = self.parent
        root = x
        while (up := parent.setdefault(root, root)) != root:
            root = up
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    def join(self, x: int, y: int) -> None:
        self.parent[self.find(x)] = self.find(y)


class _Node:
    """A run of elements that all sets below share, and what bounds these sets."""

    __slots__ = ("run", "children", "ended", "group", "least", "most", "rest")

    def __init__(self, run: np.ndarray, group: int | None, n: int, rest: int):
        self.run, self.children, self.ended = run, {}, []
        self.group = group  # a set whose component all sets below belong to, None if they differ
        self.least = self.most = n
        self.rest = rest  # elements of the longest set below this run


class Trie:
    """Sets as ascending arrays of element ranks; ``insert`` returns the links a new set makes."""

    def __init__(self, elements: int, forest: Forest, percent: int = PERCENT):
        self.root = _Node(np.zeros(0, np.int64), None, 0, 0)
        self.root.least, self.empty = 1 << 60, True
        self.member = np.zeros(elements, bool)
        self.forest, self.percent = forest, percent

    def insert(self, uid: int, ranks: np.ndarray, n: int) -> list[int]:
        links = [] if self.empty else self._search(uid, ranks, n)
        self._add(uid, ranks, n)
        return links

    def _search(self, uid: int, ranks: np.ndarray, n: int) -> list[int]:
        percent, find, links = self.percent, self.forest.find, []
        own = find(uid)
        self.member[ranks] = True
        stack = [(self.root, 0)]
        while stack:
            node, shared = stack.pop()
            if node.most * 100 < percent * n or node.least * percent > 100 * n:
                continue
            if node.group is not None and find(node.group) == own:
                continue
            run = node.run
            left = len(ranks)
            if len(run):
                shared += int(np.count_nonzero(self.member[run]))
                left -= int(np.searchsorted(ranks, run[-1], "right"))
            if (100 + percent) * (shared + min(left, node.rest)) < percent * (n + node.least):
                continue
            for other, size in node.ended:
                if (100 + percent) * shared >= percent * (n + size) and find(other) != own:
                    links.append(other)
                    self.forest.join(other, uid)
                    own = find(uid)
            for head, child in node.children.items():
                if not self.member[head]:
                    stack.append((child, shared))
            for head, child in node.children.items():  # what the set shares comes first
                if self.member[head]:
                    stack.append((child, shared))
        self.member[ranks] = False
        return links

    def _note(self, node: _Node, uid: int, n: int, rest: int) -> None:
        if node.group is not None and self.forest.find(node.group) != self.forest.find(uid):
            node.group = None
        node.least, node.most, node.rest = min(node.least, n), max(node.most, n), max(node.rest, rest)

    def _add(self, uid: int, ranks: np.ndarray, n: int) -> None:
        node, at = self.root, 0
        if self.empty:
            node.group, self.empty = uid, False
        self._note(node, uid, n, len(ranks))
        while at < len(ranks):
            child = node.children.get(int(ranks[at]))
            if child is None:
                child = node.children[int(ranks[at])] = _Node(ranks[at:], uid, n, 0)
                node, at = child, len(ranks)
                break
            run = child.run
            length = min(len(run), len(ranks) - at)
            differ = np.flatnonzero(run[:length] != ranks[at : at + length])
            same = int(differ[0]) if len(differ) else length
            if same < len(run):  # the run splits where the new set leaves it
                upper = _Node(run[:same], child.group, child.least, child.rest + len(run) - same)
                upper.most = child.most
                child.run = run[same:]
                upper.children[int(child.run[0])] = child
                node.children[int(ranks[at])] = upper
                child = upper
            at += same
            self._note(child, uid, n, len(ranks) - at)
            node = child
        node.ended.append((uid, n))


def block_links(uids: list[int], sizes: list[int], sets: list[np.ndarray], forest: Forest) -> list[tuple[int, int]]:
    """Links between the sets of a block that connect all its linked sets not yet connected in ``forest``."""
    every, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # Frequent elements first, so that sets share long paths; an element of one set only counts by the set's size.
    rank = np.empty(len(every), np.int64)
    rank[np.lexsort((every, -count))] = np.arange(len(every))
    trie = Trie(len(every), forest)
    ends = np.cumsum([len(s) for s in sets])
    out = []
    for uid, n, own in zip(uids, sizes, np.split(place, ends[:-1]), strict=True):
        ranks = np.sort(rank[own[count[own] > 1]])
        out.extend((uid, other) for other in trie.insert(uid, ranks, n))
    return out


def _links(table: pa.Table) -> pa.Table:
    """Links of all blocks of a task."""
    key = np.column_stack([table.column(c).to_numpy() for c in ("key", "part")])
    uid, size, label = (table.column(c).to_numpy() for c in ("uid", "n", "label"))
    lists = table.column("grams").combine_chunks()
    values, offsets = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
    order = np.lexsort((uid, key[:, 1], key[:, 0]))
    opens = np.flatnonzero(np.append(True, (key[order][1:] != key[order][:-1]).any(1)))
    forest, found = Forest(), []
    for u, l in zip(uid.tolist(), label.tolist(), strict=True):
        forest.join(u, l)
    for block in np.split(order, opens[1:]):
        uids = uid[block].tolist()
        if len({forest.find(u) for u in uids}) > 1:
            found += block_links(uids, size[block].tolist(), [values[offsets[i] : offsets[i + 1]] for i in block], forest)
    pairs = np.array(found, np.int64).reshape(-1, 2)
    return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})


def _linked(blocks: DataFrame, sets: DataFrame) -> DataFrame:
    """Links of the blocks (key, part): rows of uid, its component so far (``label``) and ``n``, many blocks to a task."""
    total = blocks.agg(F.sum("n")).first()[0] or 0
    bins = max(1, -(-total // TASK_GRAMS))
    rows = blocks.drop("n").join(sets.select("uid", "n", "grams"), "uid")
    placed = rows.withColumn("bin", F.pmod(F.xxhash64("key", "part"), F.lit(bins)))
    return placed.groupBy("bin").applyInArrow(_links, "a long, b long")


def _key_blocks(members: DataFrame, whole: bool) -> DataFrame:
    """Blocks of the sets of one key each, from ``members`` (key, uid, n, label).

    Keys of the same members count once, keys of one component not at all. A
    block above BLOCK_GRAMS is dealt out to parts; if ``whole``, to each pair of
    parts, so that every two members meet.
    """
    one, two = F.bit_xor(F.xxhash64("uid")).alias("x"), F.bit_xor(F.xxhash64("uid", F.lit(1))).alias("y")
    keys = members.groupBy("key").agg(
        F.count(F.lit(1)).alias("size"), F.sum("n").alias("grams"), one, two, F.min("label").alias("lo"), F.max("label").alias("hi")
    )
    chosen = keys.where("size > 1 AND lo <> hi").groupBy("size", "grams", "x", "y").agg(F.min("key").alias("key")).select("key", "grams")
    dealt = (
        members.join(chosen, "key")
        .withColumn("parts", F.ceil(F.col("grams") / BLOCK_GRAMS).cast("int"))
        .withColumn("own", F.pmod(F.xxhash64("uid", "key"), F.col("parts")).cast("int"))
    )
    part = F.col("own").cast("long")
    if whole:
        pair = F.transform(
            F.sequence(F.lit(0), F.col("parts") - 1),
            lambda j: (F.least("own", j) * F.col("parts") + F.greatest("own", j)).cast("long"),
        )
        part = F.explode(pair)
    return written(dealt.select("key", part.alias("part"), "uid", "label", "n"), "blocks")


def _large_family_links(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links of families above a block: most by a few keys of each set, then all keys whose sets are not connected yet."""
    nth = F.row_number().over(Window.partitionBy("uid").orderBy("key"))
    first = members.withColumn("nth", nth).where(F.col("nth") <= FIRST_KEYS).drop("nth")
    links = written(_linked(_key_blocks(first.withColumn("label", F.col("uid")), whole=False), sets), "links")
    labels = components(links).withColumnRenamed("v", "uid")
    every = members.join(labels, "uid", "left").withColumn("label", F.coalesce("label", "uid"))
    return links.unionByName(_linked(_key_blocks(every, whole=True), sets))


def link_components(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, ``n_shingles``, ``component_id`` and ``stays`` (true for one row content of each component).

    Two documents link when 100 times their common n-grams are at least 80 times
    all their n-grams. ``component_id`` is the smallest key that links reach, the
    own one included. Null, empty and blank texts have no n-grams and no links. A
    null key is never the smallest unless alone. Equal rows count as one
    document, rows of one key and different texts as several; keys are integers.
    """
    source = docs.select(
        F.xxhash64(F.col(doc_id).cast("long"), F.col(text)).alias("uid"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")
    )
    total = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_BYTES))
    shared = source.mapInArrow(_sets(buckets), _SETS).groupBy("bucket").applyInArrow(_shared, _SHARED)
    known = written(shared.groupBy("slice").applyInArrow(_prefixes, _KNOWN), "sets")
    base = known.where("keys IS NULL").select("uid", "doc_id", "n", "s1", "s2")
    # A row that several slices hold has its set from each of them; that of one slice counts.
    least = F.min(F.struct("uid", "slice"))
    # A group of copies or a component may hold a third of all rows: joins with it are ones that AQE can split.
    speakers = aggregate_for_join(known.where("keys IS NULL AND n > 0"), ["n", "s1", "s2"], least.alias("least")).select(
        "n", "s1", "s2", F.col("least.uid").alias("speaker"), F.col("least.slice").alias("slice")
    )
    copies = base.where("n > 0").join(speakers.drop("slice"), ["n", "s1", "s2"]).where("uid <> speaker").select(F.col("uid").alias("a"), F.col("speaker").alias("b"))
    sets = known.where("keys IS NOT NULL").select("slice", "uid", "n", "grams", "keys")
    sets = sets.join(speakers.select(F.col("speaker").alias("uid"), "slice"), ["uid", "slice"], "left_semi").drop("slice")
    members = written(sets.select(F.explode("keys").alias("key"), "uid", "n"), "prefix-keys")
    # Sets that share keys, directly or through others, are a family. One that fits is a single block.
    hubs = members.groupBy("key").agg(F.min("uid").alias("b"), F.count(F.lit(1)).alias("size")).where("size > 1")
    families = components(members.join(hubs, "key").select(F.col("uid").alias("a"), "b"))
    grouped = sets.select("uid", "n").join(families.withColumnRenamed("v", "uid"), "uid")
    sizes = aggregate_for_join(grouped, ["label"], F.sum("n").alias("grams"))
    fits = written(grouped.join(sizes, "label").withColumn("fits", F.col("grams") <= BLOCK_GRAMS), "families")
    small = fits.where("fits").select(F.col("label").alias("key"), F.lit(0).cast("long").alias("part"), "uid", F.col("uid").alias("label"), "n")
    links = written(_linked(small, sets), "links")
    large = members.join(fits.where("NOT fits").select("uid"), "uid", "left_semi")
    if large.limit(1).count():
        links = links.unionByName(_large_family_links(large, sets))
    final = components(links.unionByName(copies))
    labelled = base.join(final.withColumnRenamed("v", "uid"), "uid", "left").withColumn("label", F.coalesce("label", "uid"))
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("uid")))["uid"].alias("first")
    smallest = aggregate_for_join(labelled, ["label"], F.min("doc_id").alias("component_id"), first)
    lone = F.col("n") == 0
    return labelled.join(smallest, "label").select(
        F.col("doc_id").alias(doc_id),
        F.col("n").alias("n_shingles"),
        F.when(lone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        (lone | (F.col("uid") == F.col("first"))).alias("stays"),
        "uid",
    )


def one_of_each(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component, all columns as they were.

    It is the one of the smallest key; of equal rows one stays, and every text without n-grams.
    """
    found = link_components(docs, doc_id=doc_id, text=text)
    stays = found.where("stays").groupBy("uid").agg(F.count(F.lit(1)).alias("_rows"), F.max("n_shingles").alias("_n"))
    stays = written(stays.select(F.col("uid").alias("_uid"), (F.when(F.col("_n") > 0, F.col("_rows")).otherwise(1)).alias("_rows")), "stays")
    uid = F.xxhash64(F.col(doc_id).cast("long"), F.col(text))
    once = docs.join(stays.where("_rows = 1"), uid == F.col("_uid"), "left_semi")
    again = docs.join(stays.where("_rows > 1"), uid == F.col("_uid"), "left_semi")
    return once.unionByName(again.dropDuplicates([doc_id, text]))
