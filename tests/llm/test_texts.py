"""Operators on single texts: decontamination, pages, BPE, lines and the two models."""

import hashlib
from collections import Counter

import duckdb
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.fixtures import documents, empty, texts, words
from tidemark.llm import bpe, decontaminate, html_text, line_dedup, quality, queries, toxicity


def in_duckdb(sql, **tables):
    con = duckdb.connect()
    for name, rows in tables.items():
        con.register(name, rows.toPandas())
    return sorted((tuple(r) for r in con.sql(sql).fetchall()), key=str)


def benchmark(spark):
    rows = [(1, " ".join(words(2, 60))), (2, "One two three"), (2, "ONE two, three!"), (3, None), (4, ""), (5, "xx"), (None, "e f g h")]
    rows.append((10, " ".join(words(1, 20))))
    return spark.createDataFrame(rows, "item_id long, text string")


def test_contamination_equals_sql(spark):
    docs = documents(spark).where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    items = benchmark(spark).where("item_id IS NOT NULL")
    found = decontaminate.contamination(docs, items).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long"), F.sha2(F.array_join("items", ",").cast("binary"), 256),
        decontaminate.is_contaminated(F.col("n_hit"), F.col("n_words")),
    )
    want = in_duckdb(queries.oracle_sql()["op3_decontaminate"], documents=docs.select("doc_id", "text"), benchmark=items)
    assert sorted((tuple(r) for r in found.collect()), key=str) == want


def test_contamination_keeps_clean_and_awkward_rows(spark, monkeypatch):
    docs = documents(spark)
    kept = decontaminate.remove_documents(docs, benchmark(spark))
    monkeypatch.setattr(decontaminate, "BROADCAST_WORDS", 0)
    again = decontaminate.remove_documents(docs, benchmark(spark))
    assert kept.columns == docs.columns
    left = sorted((tuple(r) for r in kept.select("doc_id", "text").collect()), key=str)
    assert left == sorted((tuple(r) for r in again.select("doc_id", "text").collect()), key=str)
    assert {None, ""} <= {t for _, t in left} and "one two three" not in {t for _, t in left}
    assert decontaminate.remove_documents(docs, empty(spark, "item_id long, text string")).count() == docs.count()
    assert decontaminate.contamination(empty(spark), benchmark(spark)).collect() == []


def test_lines_equal_sql(spark):
    docs = documents(spark).where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    found = line_dedup.dedup_lines(docs).select(
        "doc_id", "n_lines", "n_lines_removed", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    )
    assert sorted((tuple(r) for r in found.collect()), key=str) == in_duckdb(
        queries.oracle_sql()["op8_line_dedup"], documents=docs.select("doc_id", "text")
    )


def test_lines_of_later_windows_go(spark):
    rows = [(1, "a\nb\nc\nd"), (2, "x\na\nb\nc\nd\ny"), (3, "a\nb"), (4, "r\nr\nr\nr\nr"), (None, "a\nb\nc"), (5, None), (6, ""), (1, "a\nb\nc\nd")]
    found = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    by = {(r.doc_id, r.text) for r in found}
    assert {(2, "x\ny"), (3, "a\nb"), (4, ""), (None, "a\nb\nc"), (5, None), (6, "")} <= by | {(4, "")}
    assert line_dedup.dedup_lines(empty(spark)).collect() == []


@pytest.fixture(scope="module")
def tokenizer():
    public = pytest.importorskip("public_tokenizers")
    return bpe.read_ranks(public.path("byte_bpe_multi_50k.tiktoken")), public.PATTERN


def test_bpe_equals_the_library(spark, tokenizer, monkeypatch):
    import tiktoken

    monkeypatch.setattr(bpe, "BATCH_CHARS", 5_000)
    ranks, pattern = tokenizer
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    found = bpe.round_trip(documents(spark), ranks, pattern).collect()
    assert len(found) == documents(spark).count()
    source = sorted(((r.doc_id, r.text or "") for r in documents(spark).collect()), key=str)
    want = sorted(((i, np.array(own.encode_ordinary(t), "<u4").tobytes(), t.encode()) for i, t in source), key=str)
    assert sorted(((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in found), key=str) == want
    assert bpe.round_trip(empty(spark), ranks, pattern).collect() == []


def test_decode_gives_the_bytes_of_ids(spark, tokenizer):
    ranks, _ = tokenizer
    rows = spark.createDataFrame([(1, [5, 300, 5]), (2, []), (3, None)], "id int, ids array<int>")
    names = {r: t for t, r in ranks.items()}
    found = {r.id: r.decoded for r in bpe.decode(rows, ranks).collect()}
    assert found[1] == names[5] + names[300] + names[5] and found[2] == b"" and found[3] is None


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Home</a></li></ul></nav><div class="ad">Buy our very fine goods now or never</div>
{body}<section class="comments"><p>First!</p></section><form><p>Mail</p></form><footer>&copy; all rights of this site are kept here</footer></body></html>"""


def test_article_text():
    page = PAGE.format(body='<article><h1>A &amp; B</h1><p><b>One\n two<br>x<p>Three &lt;p&gt;&nbsp;four</p><aside>no</aside><div class="share">no</div><p>5 < 6 <i>a</i>b</article>')
    assert html_text._kept(html_text.blocks(page), frozenset()) == ["A & B", "One two x", "Three <p> four", "5 < 6 ab"]


@pytest.mark.parametrize("page, want", [
    ("", []), ("plain words", ["plain words"]), ("<p>a<p>b", ["a", "b"]), ("<article>x <b", ["x"]), ("<script>never closed", []),
    ("<div class='sidebar'><article>kept</article></div>", ["kept"]), ("<main><p>m</p><nav>n</nav></main><p>o</p>", ["m"]),
    ("<p title=it's>a</p><p>b</p>", ["a", "b"]), ("<p " + "x='" * 3000 + "<p>a", ["a"]),
    ("<p hidden>no</p><p style='display: none'>no</p><p>yes</p>", ["yes"]), ("<p>a</p><!-- <p>no</p> --><p>b", ["a", "b"]),
])
def test_pages_with_odd_markup(page, want):
    assert html_text._kept(html_text.blocks(page), frozenset()) == want


def test_host_boilerplate_goes_from_pages_without_article(spark):
    plain = "<body><div>Buy our very fine goods now or never</div><p>Unique number {0} of all the pages here {0}</p><div>short bar</div></body>"
    rows = [(i, "https://h.example/p", plain.format(i)) for i in range(6)] + [(7, None, None), (8, "x", ""), (8, "x", "")]
    found = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(found) == len(rows)
    assert {r.page_id: r.text for r in found if r.page_id < 7} == {i: f"Unique number {i} of all the pages here {i}" for i in range(6)}
    assert {r.text for r in found if r.page_id >= 7} == {""}
    assert html_text.extract(empty(spark, "page_id long, url string, html string")).collect() == []


LONG = "a long text of the page that is more than any of the others are"


@pytest.mark.parametrize("page, want", [
    (f"<article><p>{LONG}</p></article><section class='comments'><article>First!</article><article>{LONG} {LONG}</article></section>", [LONG]),
    (f"<article>{LONG}</article><ul><li class='comment'><article class='comment-body'>{LONG} {LONG}</article></ul>", [LONG]),
    (f"<article>{LONG}<div class='comments'><article>First!</article></div><p>end</p></article>", [LONG, "end"]),
    (f"<article>{LONG}</article><article class='comment'>First!</article>", [LONG]),
    (f"<div><p>{LONG}</p></div><section class='related'><article>One teaser</article><article>Two</article></section>", [LONG]),
    (f"<div><p>{LONG}</p></div><div><article>One teaser</article><article>Two</article></div>", [LONG]),
    (f"<div class='related'><article>Teaser</article></div><article>{LONG}</article>", [LONG]),
    (f"<div class='sidebar'><article>{LONG}<p class='share'>no</p></article></div><p>o</p>", [LONG]),
    (f"<div class='sidebar'><main><h1>T</h1><article>{LONG}</article></main></div><div class='comments'><article>{LONG} {LONG}</article></div>", ["T", LONG]),
    (f"<article class='post category-social'>{LONG}</article><div class='comments'><article>{LONG} {LONG}</article></div>", [LONG]),
    (f"<article class='post category-social'>{LONG}</article><p>o</p>", [LONG]),
    (f"<p>intro</p><article>{LONG}</article><article>{LONG} two</article>", [LONG, f"{LONG} two"]),
    (f"<main><article>{LONG}</article><section id='comments'><article>No</article></section></main>", [LONG]),
    (f"<main><p>{LONG}</p><section id='comments'><article>{LONG} {LONG}</article></section></main>", [LONG]),
])
def test_comments_and_teasers_are_no_article(page, want):
    assert html_text._kept(html_text.blocks(page), frozenset()) == want


def test_host_boilerplate_goes_from_inside_articles(spark):
    notice = "Sign up today for all of our daily letters"
    page = "<body><article><p>{0}</p><p>" + notice + "</p><p>{1} " + notice + "</p></article></body>"
    rows = [(i, "https://h.example/p", page.format(f"Story {i} " + " ".join(words(i, 30)), f"Second part with end{i}")) for i in range(8)]
    few = "a sentence that only four of the articles have in common"
    rows += [(20 + i, "https://k.example/p", f"<article><p>Other story {i} {i} {i}</p><p>{few if i < 4 else i}</p></article>") for i in range(7)]
    rows += [(40 + i, "https://c.example/p", "<article><p>one and the same copy of an article</p></article>") for i in range(9)]
    found = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()
    text = {r.page_id: r.text for r in found}
    assert all(text[i] == f"Story {i} {' '.join(words(i, 30))}\nSecond part with end{i}" for i in range(8))
    assert all(text[20 + i] == f"Other story {i} {i} {i}\n{few if i < 4 else i}" for i in range(7))
    assert {text[40 + i] for i in range(9)} == {"one and the same copy of an article"}


def host_pages():
    """Hosts with near copies, an inner notice, copies of rows, long pages, and awkward rows."""
    base = words(77, 120)
    near = [" ".join([*base[:60], f"edit{k}", *base[61:]]) for k in range(8)]
    rows = [(i, "https://n.example/p", f"<h1>no</h1><article><h1>Title</h1><p>{t}</p></article>") for i, t in enumerate(near)]
    notice = "Sign up today for all of our daily letters"
    story = "<article><p>Story {0} {1}</p><p>{2} part{0} of the end{0} {2}</p></article>"
    rows += [(100 + i, "https://h.example/p", story.format(i, " ".join(words(i, 30)), notice)) for i in range(6)]
    plain = "<body><div>Buy our very fine goods now or never</div><p>Unique number {0} of all the pages here {0}</p></body>"
    rows += [(200 + i, "https://d.example/p", plain.format(i)) for i in range(6)]
    rows += [(300 + i, "https://l.example/p", f"<article><p>{' '.join(words(300 + i, 30_000))}</p></article>") for i in range(2)]
    return rows + [(None, "https://n.example/p", None), (None, None, "<p>lone"), (400, "", ""), (401, "no address", "<article>x</article>")]


def brute_runs(rows):
    """Boilerplate runs of each host by counting pages one by one."""
    hosts = {}
    for _, url, page in rows:
        name = url.split("/")[2] if url and "://" in url else ""
        found = html_text.blocks(page or "")
        if found:
            hosts.setdefault(name, set()).add(tuple((b, p == 2) for b, p, _ in found))
    out = set()
    for name, pages in hosts.items():
        anywhere, outside = Counter(), Counter()
        for page in pages:
            runs = [(run, inside) for block, inside in page for run in set(html_text._runs(block.split()))]
            anywhere.update({run for run, _ in runs})
            outside.update({run for run, inside in runs if not inside})
        half = len(pages) / 2
        out |= {(name, r) for r, n in anywhere.items() if n >= 5 and n >= half}
        out |= {(name, r) for r, n in outside.items() if n >= 3 and n >= half}
    return out


@pytest.mark.parametrize("sorted_pages, copies", [(1000, 1), (1000, 3), (2, 1), (2, 3)])
def test_boilerplate_does_not_depend_on_parts_or_copies(spark, monkeypatch, sorted_pages, copies):
    monkeypatch.setattr(html_text, "PAGES_SORTED", sorted_pages)
    rows = host_pages()
    clashing = "page_id long, url string, html string, host string, runs int, text string, blocks int, part int, _html int"
    pages = spark.createDataFrame([(*r, "h", 1, "t", 2, 3, 4) for r in rows * copies], clashing).repartition(4)
    assert {tuple(r) for r in html_text.host_boilerplate(pages).collect()} == brute_runs(rows)
    found = html_text.extract(pages).collect()
    assert len(found) == len(rows) * copies
    text = {r.page_id: r.text for r in found if r.page_id is not None}
    base = words(77, 120)
    for k in range(8):  # near copies of an article are whole
        assert text[k] == "Title\n" + " ".join([*base[:60], f"edit{k}", *base[61:]])
    for i in range(6):
        assert text[100 + i] == f"Story {i} {' '.join(words(i, 30))}\npart{i} of the end{i}"
        assert text[200 + i] == f"Unique number {i} of all the pages here {i}"
    assert text[300] == " ".join(words(300, 30_000)) and text[400] == "" and text[401] == "x"
    assert {r.text for r in found if r.page_id is None} == {"", "lone"}


def test_suffix_order_by_depth():
    order, common = html_text.suffix_order(np.array([1, 2, 3, -1, 1, 2, 3, -2]), 3)
    at = [i for i in range(1, 8) if common[i]]
    assert [sorted((order[i - 1], order[i])) for i in at] == [[0, 4]]


def brute_segments(scores):
    """Maximal segments by definition: the best segment, then those to its left and right."""
    if not scores:
        return []
    best = None
    for a in range(len(scores)):
        total = 0.0
        for b in range(a, len(scores)):
            total += scores[b] if scores[b] is not None else -toxicity.GAP
            if total > 0 and (best is None or total > best[2] + 1e-12):
                best = (a, b + 1, total)
    if best is None:
        return []
    a, b, s = best
    right = [(x + b, y + b, z) for x, y, z in brute_segments(scores[b:])]
    return [*brute_segments(scores[:a]), best, *right]


def test_bpe_of_long_words_equals_the_library(tokenizer):
    import tiktoken

    ranks, pattern = tokenizer
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    tables = bpe._Tokenizer(ranks, pattern)
    rng = np.random.default_rng(11)
    drawn = lambda letters, n: "".join(np.array(list(letters))[rng.integers(0, len(letters), n)])
    long = [drawn("abcdefghijklmnopqrstuvwxyz", 9000), drawn("的一是不了人我在有他", 3000), "国" * 1500, "a" * 4001, "abcdefg" * 700, "-" * 3333]
    long += ["".join(["the", "ing", "tion", "er"][i] for i in rng.integers(0, 4, 1500)), drawn("ab", 1025), drawn("é ü", 1200).replace(" ", "x")]
    ids, back = tables.round_trips(long)
    for text, found, decoded in zip(long, ids, back, strict=True):
        assert np.frombuffer(found, "<u4").tolist() == own.encode_ordinary(text)
        assert decoded.decode() == text


def test_bpe_windows_without_a_common_place_are_joined(tokenizer, monkeypatch):
    import tiktoken

    ranks, pattern = tokenizer
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    monkeypatch.setattr(bpe, "WINDOW", 7)
    monkeypatch.setattr(bpe, "OVERLAP", 3)
    tables = bpe._Tokenizer(ranks, pattern)
    for text in ("a" * 1100, "internationalisation" * 60, "国" * 400):
        assert tables._encode_windows(text.encode()).tolist() == own.encode_ordinary(text)


def test_segments_equal_the_definition():
    rng = np.random.default_rng(5)
    for _ in range(40):
        scores = [float(rng.integers(1, 4)) + rng.random() if rng.random() < 0.15 else None for _ in range(80)]
        scores = [s if s is None or rng.random() < 0.8 else -s for s in scores]
        found = toxicity.segments(scores)
        want = brute_segments(scores)
        assert [(a, b) for a, b, s in found if s > 0] == [(a, b) for a, b, _ in want]


def labelled(spark):
    rows = []
    for i in range(300):
        toxic = i % 5 == 0
        text = words(i, 80)
        if toxic:
            text[20:22] = ["foulword", f"vilestem{i % 7}x"]
        good = i % 3 > 0
        rows.append((i, " ".join(text if good else [w.upper() + "!!" for w in text]), int(toxic), int(good)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int, quality int")


def test_segments_take_linear_time():
    # Sums before the hits fall, rise, and fall again: each search must skip what an earlier one passed over.
    n = 200_000
    scores = [1.0 if i % 2 else -1.001 if i < n // 2 else -0.5 for i in range(n)] + [1.0 if i % 30 == 0 else None for i in range(n)]
    started = time.perf_counter()
    found = toxicity.segments(scores)
    assert time.perf_counter() - started < 10 and sum(s for _, _, s in found) > n / 8


def test_extreme_value_law_is_recovered():
    # Best scores of clean texts drawn from the law itself; a score below the least one is not seen.
    rng = np.random.default_rng(2)
    words_of = rng.integers(50, 2000, 6000)
    best = np.log(0.02 * words_of / rng.exponential(size=6000)) / 0.7
    scale, k = toxicity.chance_law(np.where(best < 1.5, 0, best), words_of, 1.5)
    assert abs(scale - 0.7) < 0.03 and abs(k - 0.02) < 0.003
    scale, k = toxicity.chance_law(np.zeros(0), np.zeros(0), 1.5)  # nothing known: the prior
    assert scale == pytest.approx(1.0, abs=1e-6) and k > 0


def test_toxicity_weighs_copies_and_keeps_clean_words_apart(spark):
    rows = labelled(spark)
    copies = rows.where("doc_id = 5").withColumn("doc_id", F.explode(F.sequence(F.lit(1000).cast("long"), F.lit(1039).cast("long"))))
    edited = copies.withColumn("text", F.concat("text", F.lit(" edit"), F.col("doc_id").cast("string")))
    both = rows.unionByName(edited)
    model = toxicity.fit(both, both.select("doc_id", F.col("toxic").alias("label")))
    ordinary = set(rows.where("doc_id = 5").first().text.lower().split()) - {"foulword"}
    assert not any(model.scores.get(w, 0) > 0 for w in ordinary if not w.startswith("vilestem"))
    assert model.scores["foulword"] > 0


def test_sample_bounds_rows_of_a_hot_key(spark):
    docs = spark.range(5000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    labels = spark.createDataFrame([(7, 1), (7, 0), (8, 1), (None, 1)], "doc_id long, label int")
    assert {(r.label, r["count"]) for r in toxicity.sample(docs, labels).groupBy("label").count().collect()} == {(0, 1), (1, 1)}


def test_toxicity_on_held_out_rows(spark):
    rows = labelled(spark)
    train = rows.where("doc_id % 4 <> 0").select("doc_id", F.col("toxic").alias("label"))
    model = toxicity.fit(rows, train)
    held = toxicity.score(rows.where("doc_id % 4 = 0"), model).collect()
    assert np.mean([(r.score >= 0.5) == bool(r.toxic) for r in held]) > 0.97
    assert all(0 <= p.first < p.end <= 80 for r in held for p in r.passages)


def test_toxicity_of_awkward_rows(spark):
    docs = documents(spark)
    model = toxicity.fit(docs, docs.select("doc_id", F.lit(None).cast("int").alias("label")))
    found = toxicity.score(docs, model)
    assert set(docs.columns) <= set(found.columns) and found.count() == docs.count()
    assert {r.score for r in found.collect()} == {0.5}
    assert toxicity.score(empty(spark), model).collect() == []


def test_quality_on_held_out_rows(spark):
    rows = labelled(spark)
    net = quality.fit(rows.where("doc_id % 4 <> 0").select(F.col("quality").alias("label"), "text"))
    held = quality.score(rows.where("doc_id % 4 = 0"), net).collect()
    assert np.mean([(r.score >= 0.7) == bool(r.quality) for r in held]) > 0.97
    assert all(abs(sum(r.attention) - 1) < 1e-4 for r in held)


def test_quality_gradients_equal_differences():
    rng = np.random.default_rng(1)
    x, bags, y = rng.normal(size=(9, quality.FEATURES)), np.array([0, 2, 5]), np.array([1.0, 0.0, 1.0])
    net = {k: rng.normal(0, 0.5, np.shape(v)) for k, v in quality._trained(x.astype(np.float32), bags, y).items()}

    def loss():
        p = quality._forward(net, x, bags)[-1]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    grads = quality._gradients(net, x, bags, y)
    for k in ("w", "v", "u", "a", "c"):
        place = (0,) * net[k].ndim
        net[k][place] += 1e-5
        up = loss()
        net[k][place] -= 2e-5
        down = loss()
        net[k][place] += 1e-5
        assert abs((up - down) / 2e-5 - grads[k][place]) < 1e-5


def test_quality_of_awkward_rows(spark):
    docs = documents(spark)
    for labels in ([], [1, 1], [0, 1]):
        net = quality.fit(spark.createDataFrame([(v, None) for v in labels], "label int, text string"))
        found = quality.score(docs, net)
        assert found.count() == docs.count()
        assert all(0 <= r.score <= 1 and len(r.attention) >= 1 for r in found.collect())
    assert quality.score(empty(spark), net).collect() == []
    longest = max(len((t or "").split()) for t in texts())
    assert max(len(r.attention) for r in found.collect()) == -(-longest // quality.PASSAGE_WORDS)
