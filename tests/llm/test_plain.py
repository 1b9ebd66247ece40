"""The pipeline and the shards beside plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

from tests.llm.fixtures import documents
from tests.llm.test_pairs import brute_components
from tidemark.llm import bpe, queries, sharding, toxicity


def plain_lines_kept(texts):
    """Texts by key without the lines of three-line windows that an earlier place holds as well; three empty lines are none."""
    seen, out = set(), {}
    for key in sorted(texts):
        lines = texts[key].split("\n")
        gone = set()
        for at in range(len(lines) - 2):
            window = tuple(lines[at : at + 3])
            if not any(window):
                continue
            if window in seen:
                gone.update(range(at, at + 3))
            seen.add(window)
        out[key] = "\n".join(line for k, line in enumerate(lines) if k not in gone)
    return out


def plain_contaminated(text, items):
    """Whether a twentieth of the words or more are in an occurrence of 13 words of an item, or of all of a shorter one."""
    word = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words = word.findall(text.encode().lower())
    hit = set()
    for item in items:
        own = word.findall((item or "").encode().lower())
        n = min(13, len(own))
        windows = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else set()
        for at in range(len(words) - n + 1):
            if tuple(words[at : at + n]) in windows:
                hit.update(range(at, at + n))
    return bool(hit) and 20 * len(hit) >= len(words)


def test_pipeline_equals_plain_python(spark, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    public = pytest.importorskip("public_tokenizers")
    given = "/root/testdata/sf0.001"
    source = spark.read.parquet(f"{given}/documents.parquet")
    benchmark = spark.read.parquet(f"{given}/benchmark.parquet")
    # The given rows, and some that each stage has to decide on.
    rng, fresh = random.Random(8), [f"word{i}" for i in range(4000)]
    prose = lambda n: " ".join(rng.choices(fresh, k=n))
    item = max((r.text or "" for r in benchmark.select("text").collect()), key=len)
    base = prose(200).split(" ")
    shared = "\n".join(prose(6) for _ in range(5))
    planted = [
        " ".join(base),
        " ".join([*base[:90], "edit", *base[91:]]),
        " ".join([*base[:120], *fresh[:80]]),
        f"{prose(30)}\n{shared}\n{prose(30)}",
        f"{shared}\n{prose(40)}",
        f"{prose(20)} {item} {prose(20)}",
        f"{prose(len(item.split(' ')) * 30)} {item}",
        "",
        "",
        "a b",
        "A  b",
        "\n\n\n\n\n\n",
    ]
    rows = [(90_000 + i, t) for i, t in enumerate(planted)]
    added = spark.createDataFrame(rows, "doc_id long, text string")
    others = [F.lit(None).cast(f.dataType).alias(f.name) for f in source.schema if f.name not in ("doc_id", "text")]
    both = source.unionByName(added.select("*", *others).select(*source.columns))
    both.write.parquet(str(tmp_path / "documents.parquet"))
    for name in ("benchmark", "labels"):
        spark.read.parquet(f"{given}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))

    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    model = toxicity.fit(docs, queries.toxicity_labels(spark, str(tmp_path)))
    scored = toxicity.score(docs, model).select("doc_id", "text", "score").collect()
    texts = {r.doc_id: r.text or "" for r in scored if r.score < 0.5}
    after_lines = plain_lines_kept(texts)
    component = {key[0]: c for key, (_, c) in brute_components(list(after_lines.items())).items()}
    empties = [k for k in sorted(after_lines) if not after_lines[k].split()]
    single = {k: t for k, t in after_lines.items() if component[k] == k or k in empties}
    items = [r.text for r in benchmark.select("text").collect()]
    clean = {k: t for k, t in single.items() if not plain_contaminated(t, items)}
    # Every stage has had something to decide.
    assert after_lines != texts and len(clean) < len(single) < len(after_lines)
    assert {90_000, 90_002, 90_006, 90_007, 90_008, 90_009} <= clean.keys()
    assert not {90_001, 90_005, 90_010} & clean.keys()

    ranks = bpe.read_ranks(public.path("byte_bpe_multi_50k.tiktoken"))
    own = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = set()
    for key, text in clean.items():
        ids = np.array(own.encode_ordinary(text), "<u4")
        want.add((key, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    found = pipeline.run(spark, str(tmp_path)).collect()
    assert len(found) == len(want)
    assert {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found} == want


def test_shard_columns_equal_plain_python(spark):
    docs = documents(spark)
    found = sharding.shard(docs, 4).collect()
    plain = lambda t: (16, 0) if t is None else (len(t.encode()) + 16, zlib.crc32(t.encode()))
    want = Counter((r.doc_id, *plain(r.text)) for r in docs.collect())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in found) == want
    assert all(0 <= r["shard"] < 4 for r in found)
