"""The Jaccard join and the suffix dedup beside brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.fixtures import documents, empty
from tidemark.llm import jaccard_join, suffix_dedup


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i : i + 5]) for i in range(len(w) - 4)])


def brute_components(rows):
    """Component of each distinct (id, text), all pairs compared."""
    keys = list(dict.fromkeys(rows))
    sets = [shingles(t) for _, t in keys]
    parent = list(range(len(keys)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            common = len(a & b)
            if common and 100 * common >= 80 * (len(a) + len(b) - common):
                parent[find(i)] = find(j)
    out = {}
    for i, key in enumerate(keys):
        ids = [keys[j][0] for j in range(len(keys)) if find(j) == find(i) and keys[j][0] is not None]
        out[key] = (len(sets[i]), min(ids, default=None))
    return out


def test_join_equals_brute_force(spark):
    docs = documents(spark)
    want = brute_components([(r.doc_id, r.text) for r in docs.collect()])
    found = jaccard_join.link_components(docs)
    by_uid = {r.uid: (r.n_shingles, r.component_id) for r in found.collect()}
    own = docs.select(F.xxhash64("doc_id", "text").alias("uid"), "doc_id", "text").collect()
    assert {(r.doc_id, r.text): by_uid[r.uid] for r in own} == want
    assert found.count() == docs.count()


def test_join_with_small_blocks_keeps_every_link(spark, monkeypatch):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(60):
        text = list(base)
        for place in rng.sample(range(200), rng.randrange(0, 12)):
            text[place] = f"e{i}x{place}"
        rows.append((i, " ".join(text)))
    for name, value in (("BLOCK_GRAMS", 2000), ("TASK_GRAMS", 3000), ("BUCKET_BYTES", 5000), ("FREQUENT", 8)):
        monkeypatch.setattr(jaccard_join, name, value)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = {key[0]: value for key, value in brute_components(rows).items()}
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.link_components(docs).collect()} == want


def test_join_of_a_table_delivered_twice_keeps_every_link(spark, monkeypatch):
    rng = random.Random(13)
    rows = []
    for family in range(6):  # families of different texts that share a few passages, each with its near copies
        base = [f"f{family}w{i}" for i in range(120)]
        for i in range(20):
            text = list(base)
            for place in rng.sample(range(120), rng.randrange(0, 12)):
                text[place] = f"e{family}x{i}x{place}"
            rows.append((family * 100 + i, " ".join([f"p{family % 2}q{k}" for k in range(10)] + text)))
    for name, value in (("BLOCK_GRAMS", 1500), ("TASK_GRAMS", 3000), ("BUCKET_BYTES", 5000), ("FREQUENT", 8)):
        monkeypatch.setattr(jaccard_join, name, value)
    want = {key[0]: value for key, value in brute_components(rows).items()}
    again = list(rows)
    rng.shuffle(again)
    once, twice = (spark.createDataFrame(r, "doc_id long, text string").repartition(n) for r, n in ((rows, 3), (again, 4)))
    found = jaccard_join.link_components(once.unionByName(twice)).collect()
    assert len(found) == 2 * len(rows)
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in found} == {(i, *value) for i, value in want.items()}


def test_one_document_of_each_component_stays(spark):
    docs = documents(spark)
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    comps = brute_components([(r.doc_id, r.text) for r in docs.collect()])
    with_grams = [comps[k][1] for k in rows if comps[k][0]]
    assert len(with_grams) == len(set(with_grams)) == len({c for n, c in comps.values() if n})
    assert sum(1 for k in rows if not comps[k][0]) == sum(1 for n, _ in comps.values() if not n)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, ""), (2, "")]])
def test_join_without_grams(spark, rows):
    found = jaccard_join.link_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == [(i, 0, i) for i, _ in rows]


def test_trie_links_each_component_once():
    forest = jaccard_join.Forest()
    sets = [np.arange(100), np.arange(5, 105), np.arange(10, 110), np.arange(500, 520)]
    links = jaccard_join.block_links([1, 2, 3, 4], [len(s) for s in sets], sets, forest)
    assert len(links) == 2
    assert forest.find(1) == forest.find(2) == forest.find(3) != forest.find(4)


def brute_removed(rows):
    """Bytes covered by 50-byte strings that start in a row of a smaller key, by comparing everything."""
    first = {}
    for i, t in rows:
        if i is not None:
            b = (t or "").encode()
            for s in range(len(b) - 49):
                first[b[s : s + 50]] = min(i, first.get(b[s : s + 50], i))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for s in range(len(b) - 49):
            if i is not None and first[b[s : s + 50]] < i:
                gone[s : s + 50] = [True] * 50
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [500_000, 2])
def test_removed_bytes_equal_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "HOT_IN_TASK", min(hot, 256))
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 20_000)
    docs = documents(spark).repartition(4)
    found = suffix_dedup.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute_removed([(r.doc_id, r.text) for r in docs.collect()])


def test_random_overlaps_equal_brute_force(spark):
    rng = random.Random(9)
    pool = ["".join(rng.choice("ab é") for _ in range(90)) for _ in range(12)]
    rows = []
    for i in range(60):
        parts = [rng.choice(pool)[rng.randrange(30) : rng.randrange(45, 90)] for _ in range(rng.randrange(1, 6))]
        rows.append((i, "".join(parts)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    found = suffix_dedup.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute_removed(rows)


def test_anchors_spread_over_many_tasks_are_not_sorted_at_once(spark, monkeypatch):
    rng = random.Random(21)
    phrase = "a phrase of two dozen let"
    pool = ["".join(rng.choice("abcdé ") for _ in range(40)) for _ in range(8)]
    rows = [(i, rng.choice(pool) + f"{i % 9}" + phrase + rng.choice(pool) + rng.choice(pool)) for i in range(80)]
    by_window, used = suffix_dedup._by_window, []
    monkeypatch.setattr(suffix_dedup, "SORTED_SEGMENTS", 3)
    monkeypatch.setattr(suffix_dedup, "_by_window", lambda strings: used.append(1) or by_window(strings))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(20)
    found = suffix_dedup.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute_removed(rows)
    assert used


def test_suffix_dedup_of_nothing(spark):
    assert suffix_dedup.remove_repeats(empty(spark)).collect() == []


def test_two_stage_order_is_the_order_of_suffixes():
    rng = random.Random(4)
    strings = [bytes(rng.choice(b"ab\x00z") for _ in range(rng.randrange(1, 30))) for _ in range(40)]
    text = np.frombuffer(b"".join(strings), np.uint8)
    ends = np.cumsum([len(s) for s in strings])
    order = suffix_dedup.suffix_array(text, ends, 30)
    tails = [text[i : ends[np.searchsorted(ends, i, "right")]].tobytes() for i in order]
    assert sorted(order.tolist()) == list(range(len(text)))
    assert tails == sorted(tails)


def test_long_words_of_permuted_blocks_differ():
    """Words of equal bytes per place in a block, in another order of the blocks."""
    from tidemark.llm.words import word_hashes

    rng = random.Random(12)
    blocks = [bytes([rng.choice(b"abcdef")]) * 64 for _ in range(6)]
    words = {b"".join(rng.sample(blocks, k)) + tail for k in range(1, 7) for _ in range(60) for tail in (b"", b"x", b"ab" * 20)}
    words |= {b"a" * 64 + b"b" * 128 + b"a" * 64, b"b" * 64 + b"a" * 128 + b"b" * 64}
    words = sorted(words)
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    hashes = word_hashes(data, ends - [len(w) for w in words], ends)
    assert len(set(hashes.tolist())) == len(words)


def test_documents_of_long_words_link_by_their_words_only(spark):
    a, b = "a" * 64, "b" * 64
    rows = [(1, f"{a}{b}{b}{a}"), (2, f"{b}{a}{a}{b}"), (3, f"{a}{b}{b}{a}"), (4, f"{b}{a}{a}{b} {a}{b}{b}{a}"), (5, f"{a}{b}{b}{a} {b}{a}{a}{b}")]
    rows += [(10 + k, " ".join([f"{a}{b}{b}{a}"] * k + [f"{b}{a}{a}{b}"] * (30 - k))) for k in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.link_components(docs).collect()}
    assert found == {key[0]: value for key, value in brute_components(rows).items()}


def test_a_hot_window_is_joined_so_that_it_can_be_split(spark, conf):
    """A third of all windows is one window: AQE cuts its partition, and the result is whole."""
    from tidemark.llm import line_dedup

    small = {"spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "4k", "spark__sql__adaptive__advisoryPartitionSizeInBytes": "4k"}
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5", **small)
    rows = [(i, "hot a\nhot b\nhot c\n" + "\n".join(f"line {i} {k}" for k in range(6))) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(12)
    gone = line_dedup.repeated_lines(docs)
    found = gone.collect()
    assert len(found) == 2999 and all(r.gone == [0, 1, 2] for r in found)
    assert "SortMergeJoin(skew=true)" in gone._jdf.queryExecution().executedPlan().toString()
