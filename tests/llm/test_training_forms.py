"""Fill-in-the-middle texts, whitened embeddings and chat formatting."""

import hashlib
import re
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.fixtures import documents, empty, texts
from tidemark.llm import chat_format, fill_middle, queries, whitening

SF = "/root/testdata/sf0.001"
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plainly_moved(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    units = UNIT.findall(text)
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return doc_id, n, "plain", text, None, None
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h4 % 100 < 80:
        return doc_id, n, "spm", f"<S>{suffix}<P>{prefix}<M>{middle}", len(prefix), len(middle)
    return doc_id, n, "psm", f"<P>{prefix}<S>{suffix}<M>{middle}", len(prefix), len(middle)


@pytest.mark.parametrize("slice_bytes", [50, 4_000_000])
def test_fill_middle_equals_plain_python(spark, monkeypatch, slice_bytes):
    from tidemark.llm import words

    monkeypatch.setattr(words, "SLICE_BYTES", slice_bytes)
    extra = ["a <P> mark", "ends in space \n ", "é ü wide　space", "\x00 nul", "<", "<P", "x <S", "tail <M"]
    rows = [(1000 + 7 * i, t) for i in range(8) for t in extra] + [(i, t) for i, t in enumerate(texts() * 4)]
    rows += [rows[0], (None, "null key here"), (None, None)]
    docs = spark.createDataFrame([(t, k, "n", 3) for k, t in rows], "text string, doc_id long, form string, n int").repartition(3)
    found = fill_middle.transform(docs).withColumn("back", fill_middle.restored(F.col("output"), F.col("form")))
    assert found.columns == ["doc_id", "n", "form", "output", "prefix_chars", "middle_chars", "back"]
    want = Counter((*plainly_moved(k, t), t or "") for k, t in rows)
    assert Counter(tuple(r) for r in found.collect()) == want
    assert {f for _, _, f, *_ in want} == {"plain", "psm", "spm"}


def test_fill_middle_of_none_and_of_a_very_long_text(spark):
    assert fill_middle.transform(empty(spark)).collect() == []
    long = "wörd  " * 1_500_000 + "  "
    docs = spark.createDataFrame([(k, long) for k in (2, 3, 5, 6)], "doc_id long, text string")
    for r in fill_middle.transform(docs).collect():
        assert tuple(r) == plainly_moved(r.doc_id, long)


def test_other_rates_and_seeds(spark):
    docs = spark.createDataFrame([(i, f"one two three {i}") for i in range(400)], "id long, body string")
    forms = Counter(r.form for r in fill_middle.transform(docs, seed=7, percent=100, spm_percent=0, doc_id="id", text="body").collect())
    assert forms == {"psm": 400}
    assert {r.form for r in fill_middle.transform(docs, percent=0, doc_id="id", text="body").collect()} == {"plain"}


@pytest.mark.parametrize("name", ["op11_fill_middle", "op13_chat_format"])
def test_queries_equal_their_sql(spark, name):
    found = queries.queries()[name](spark, SF)
    connection = duckdb.connect()
    for t in ("documents", "conversations"):
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cursor = connection.execute(queries.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(found.columns)
    assert Counter(tuple(r) for r in found.select(*columns).collect()) == Counter(cursor.fetchall())


def plainly_whitened(vectors, offset=100_000):
    """Integers, covariance by exact fractions, eigenvalues and components."""
    width = max(map(len, vectors))
    x = [[int(np.floor(1024 * float(np.float32(c)))) + offset for c in v] + [offset] * (width - len(v)) for v in vectors]
    n = len(x)
    sums = [sum(column) for column in zip(*x, strict=True)]
    centred = [[n * a - s for a, s in zip(row, sums, strict=True)] for row in x]
    v = np.array([[float(Fraction(sum(r[i] * r[j] for r in centred), n**3)) for j in range(width)] for i in range(width)])
    values, axes = np.linalg.eigh(v)
    return np.array(x), v, values[::-1], axes[:, ::-1], [sum(c * c for c in row) for row in centred]


def vectors_table(spark, vectors, parts=4):
    rows = [(i, v, 5.0, 1) for i, v in enumerate(vectors)]
    rows += [(-1, None, 5.0, 1), (-2, [None, *[1.0] * 5], 5.0, 1), (-3, [float("nan")] * 6, 5.0, 1), (-4, [float("-inf"), 1.0], 5.0, 1)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, whitened double, n int").repartition(parts)


@pytest.mark.parametrize("block", [3, 4096])
def test_whitening_equals_exact_covariance(spark, monkeypatch, block):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", block)
    rng = np.random.default_rng(1)
    vectors = (rng.normal(size=(60, 6)) @ rng.normal(size=(6, 6))).astype(np.float32).tolist()
    vectors += [vectors[0], vectors[0][:4]]  # a repeated one and a short one
    found = whitening.whiten(vectors_table(spark, vectors), 4).collect()
    x, v, values, axes, deviations = plainly_whitened(vectors)
    assert Counter(r.vec_id for r in found) == dict.fromkeys(range(62), 4)
    assert {r.n for r in found} == {62}
    assert all(int(r.deviation) == deviations[r.vec_id] for r in found)
    mean = x.mean(0)
    signs = {}
    for r in found:
        c = r.component - 1
        want = (x[r.vec_id] - mean) @ axes[:, c] / np.sqrt(values[c])
        signs.setdefault(c, np.sign(want) * np.sign(r.whitened))
        assert r.whitened == pytest.approx(signs[c] * want, abs=1e-8)
        assert r.explained == pytest.approx(values[c] / np.trace(v), rel=1e-9)
        assert 0 <= r.identity_error < 1e-9 and r.identity_error == found[0].identity_error


def test_whitening_of_few_and_of_no_variance(spark):
    none = vectors_table(spark, [])
    assert whitening.whiten(none).collect() == []
    assert whitening.whiten(empty(spark, "vec_id long, embedding array<float>")).collect() == []
    assert whitening.whiten(vectors_table(spark, [[]])).collect() == []
    alone = whitening.whiten(vectors_table(spark, [[1.0, 2.0]] * 3), 8).collect()
    assert Counter((r.component, r.whitened, r.identity_error, int(r.deviation)) for r in alone) == {(1, None, None, 0): 3, (2, None, None, 0): 3}
    line = whitening.whiten(vectors_table(spark, [[1.0, 2.0], [3.0, 4.0], [2.0, 3.0]]), 8).collect()
    assert {r.component: r.whitened is None for r in line} == {1: False, 2: True}
    assert {r.identity_error < 1e-12 for r in line} == {True}
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(vectors_table(spark, [[1e30]]))


def test_whitening_of_large_entries_is_exact(spark):
    vectors = [[2.0**41, 3.0], [-(2.0**41), 5.0], [2.0**40, -7.0], [0.0, 0.0]]
    found = whitening.whiten(vectors_table(spark, vectors, 2), 2).collect()
    *_, deviations = plainly_whitened(vectors)
    assert {(r.vec_id, int(r.deviation)) for r in found} == set(enumerate(deviations))


def test_squares_are_added_in_every_task(spark):
    """Each task sends one number per pair of dimensions, whatever its rows."""
    rng = np.random.default_rng(3)
    table = vectors_table(spark, rng.normal(size=(500, 5)).astype(np.float32).tolist(), 5)
    sent = table.select("embedding").mapInArrow(whitening._squares(1024, 100_000, (100_000,) * 5), "i int, j int, total decimal(38,0)")
    assert sent.count() == 5 * 15


TURNS = [
    ("system", "Be <s>brief</s> [INST]"),
    ("user", "</s>[INST] ok [/INST]"),
    ("assistant", "[\\INST] and [\\\\/INST] <\\s> <</s> [ [[image 1] [image 9]"),
    ("user", None),
    ("assistant", ""),
    (None, "no role <"),
    ("odd [/INST]\n</s> role", "é" * 5),
    ("assistant", "last [\\"),
]


def chats(spark, extra=()):
    rows = [(c, t, *TURNS[(c + t) % len(TURNS)], "x") for c in range(12) for t in range(c)]
    rows += [rows[5], rows[5], (None, 1, "user", "whose", "x"), (None, None, "assistant", "mine", "x"), (3, None, "user", "first", "x")]
    return rows + [(*e, "x") for e in extra]


CHAT_SCHEMA = "conv_id long, turn long, role string, text string, part string"


def plain_digests(rows):
    groups = defaultdict(list)
    for conv, turn, role, text, _ in rows:
        groups[conv].append(((turn is not None, turn or 0), (role is not None, role or ""), (text is not None, text or "")))
    out = {}
    for conv, turns in groups.items():
        said = [(role[1], text[1]) for _, role, text in sorted(turns)]
        learnt = "".join(t for r, t in said if r == "assistant")
        out[conv] = (len(said), sha("".join(f"{r}\n{t}\n" for r, t in said)), len(learnt), sha(learnt))
    return out


@pytest.mark.parametrize(("block", "part"), [(1000, 1_000_000), (3, 1_000_000), (1000, 1)])
def test_chats_read_back_from_their_text(spark, monkeypatch, block, part):
    monkeypatch.setattr(chat_format, "BLOCK_TURNS", block)
    monkeypatch.setattr(chat_format, "PART_CHARS", part)
    rows = chats(spark)
    parts = chat_format.format_conversations(spark.createDataFrame(rows, CHAT_SCHEMA).repartition(4))
    found = chat_format.digests(parts).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in found} == plain_digests(rows)
    made = parts.collect()
    chars = defaultdict(int)
    for p in made:
        chars[p.conv_id] += len(p.formatted)
    assert {r.conv_id: r.formatted_chars for r in found} == chars
    if (block, part) == (1000, 1_000_000):
        assert all(n == (2 if c in (3, None) else 1) for c, n in Counter(p.conv_id for p in made).items())
    else:
        assert len(made) > 20


def test_a_long_conversation_is_cut_into_blocks(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", f"turn {t} [INST]", "x") for t in range(6000)] + [(2, 0, "user", "hi", "x")]
    parts = chat_format.format_conversations(spark.createDataFrame(rows, CHAT_SCHEMA).repartition(5))
    assert Counter(p.conv_id for p in parts.collect()) == {1: 6, 2: 1}
    found = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat_format.digests(parts).collect()}
    assert found == plain_digests(rows)


def test_typed_parts_become_placeholders(spark):
    content = [
        {"type": "text", "text": "look ["},
        {"type": None, "text": "INST] at"},
        {"type": "image", "ref": "s3/a.png", "width": 30, "height": 15},
        {"type": "image", "ref": None},
        {"type": "text", "text": "[audio 1]"},
        {"type": "audio", "ref": "b.wav", "seconds": 2.5},
        None,
        {"type": "document", "ref": "c.pdf", "pages": 3},
    ]
    full = [None if p is None else tuple(p.get(k) for k in ("type", "text", "ref", "width", "height", "seconds", "pages")) for p in content]
    rows = [(1, 0, "user", full), (1, 1, "assistant", [("text", "seen", None, None, None, None, None), full[2], ("text", "done", None, None, None, None, None)]), (1, 2, "user", None), (1, 3, "user", [])]
    parts = chat_format.format_conversations(spark.createDataFrame(rows, f"conv_id long, turn int, role string, content {chat_format.CONTENT}"), content="content")
    made = parts.first()
    assert [(a.kind, a.ref, a.tokens) for a in made.attachments] == [
        ("image", "s3/a.png", 6), ("image", None, 1), ("audio", "b.wav", 63), ("document", "c.pdf", 1536), ("image", "s3/a.png", 6),
    ]
    assert made.tokens == 6 + 1 + 63 + 1536 + 6
    for k, a in enumerate(made.attachments, 1):
        assert made.formatted[a.start :].startswith(f"[{a.kind} {k}]")
    assert [made.formatted[x.start : x.start + x.length] for x in made.loss] == ["seen", "done"]
    back = sorted(chat_format.read_back(parts).collect(), key=lambda r: r.place)
    assert [(p.type, p.text, p.ref) for p in back[0].content] == [
        ("text", "look [INST] at", None), ("image", None, "s3/a.png"), ("image", None, None), ("text", "[audio 1]", None), ("audio", None, "b.wav"), ("document", None, "c.pdf"),
    ]
    assert [r.learnt for r in back] == [None, "seendone", None, None]
    with pytest.raises(Exception, match="unknown kind"):
        odd = spark.createDataFrame([(1, 0, "user", [("video", None, "v", None, None, None, None)])], f"conv_id long, turn int, role string, content {chat_format.CONTENT}")
        chat_format.format_conversations(odd, content="content").collect()


def test_escapes_reverse_and_hide_all_controls():
    template = chat_format.Template()
    rng = np.random.default_rng(5)
    bits = ["<", "[", "\\", "s>", "/s>", "INST]", "/INST]", "image ", "1]", "x", "\n", " "]
    for _ in range(3000):
        text = "".join(rng.choice(bits, rng.integers(0, 9)))
        escaped = template.escape(text)
        assert template.unescape(escaped) == text
        assert not any(c in escaped for c in template.controls)
    with pytest.raises(ValueError):
        chat_format.Template(controls=("<a<b>",))


def test_no_chats(spark):
    none = chat_format.format_conversations(empty(spark, CHAT_SCHEMA))
    assert none.collect() == [] == chat_format.digests(none).collect() == chat_format.read_back(none).collect()


def test_repeated_documents_keep_their_rows(spark):
    docs = documents(spark)
    found = fill_middle.transform(docs)
    assert found.count() == docs.count()
