"""The registered queries of the operators and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import bpe, chat_format, decontaminate, fill_middle, html_text, jaccard_join, line_dedup, quality, sharding, suffix_dedup, topk, toxicity, whitening
from tidemark.llm.common import table


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.link_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        decontaminate.is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars")
    )


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = (
        table(spark, sf_dir, "embeddings")
        .where(topk.usable(F.col("embedding")))
        .select(F.col("vec_id").cast("long").alias("id"), topk.quantised(F.col("embedding")).alias("vector"))
    )
    found = topk.top_k(vectors, vectors.where(F.col("id") % 50 == 0), 5)
    return found.select("query_id", "rank", F.col("candidate_id").alias("vec_id"), "score")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), 40).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"))


def token_digests(docs: DataFrame, pieces_kept: int = bpe.PIECES_KEPT) -> DataFrame:
    """Token count and digests of the ids and of the decoded bytes of each document."""
    import public_tokenizers

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.round_trip(docs, ranks, public_tokenizers.PATTERN, pieces_kept=pieces_kept).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id",
        "n_lines",
        "n_lines_removed",
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


def _held_out(folds: int, fold: int):
    """Whether a document is kept from training: the crc32 of its id as text."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == fold


def toxicity_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels of four folds of five."""
    return table(spark, sf_dir, "labels").where(~_held_out(5, 0)).select("doc_id", F.col("toxic").alias("label"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, toxicity_labels(spark, sf_dir))
    return toxicity.score(docs, model).select(
        "doc_id", _held_out(5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~_held_out(4, 2)).select("doc_id", F.col("quality").alias("label"))
    net = quality.fit(toxicity.sample(docs, labels, quality.SAMPLE_ROWS))
    return quality.score(docs, net).select(
        "doc_id", _held_out(4, 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.transform(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An exact deviation beyond a long fails the query; the operator itself gives a decimal."""
    found = whitening.whiten(table(spark, sf_dir, "embeddings"), 8)
    return found.withColumn("deviation", F.col("deviation").cast("long"))


# The conversation that the query adds to the table: its texts are made of the template's own marks.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(-7, k, role, CONTROL_TEXT) for k, role in enumerate(("user", "assistant"))], rows.schema)
    return chat_format.digests(chat_format.format_conversations(rows.unionByName(added)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f for f in (op1_jaccard_join, op2_suffix_dedup, op3_decontaminate, op4_html_text, op5_topk, op6_sharding, op7_bpe, op8_line_dedup, op9_toxicity, op10_quality, op11_fill_middle, op12_whitening, op13_chat_format)
    }


_OP3 = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS g
       FROM (SELECT item, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, dw.n, item FROM dw JOIN bw ON dw.g = bw.g AND dw.n = bw.n),
spots AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY 1),
items AS (SELECT doc_id, list_sort(list(DISTINCT item)) AS items FROM hits GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN spots USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_OP5 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""

_OP8 = """
WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
w AS (SELECT doc_id, i, l[i:i + 2] AS g FROM (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS i FROM l)),
nw AS (SELECT * FROM w WHERE length(array_to_string(g, '')) > 0),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS n FROM nw) WHERE n > 1),
gone AS (SELECT doc_id, list(DISTINCT p) AS gone FROM (SELECT doc_id, unnest(range(i, i + 3)) AS p FROM later) GROUP BY 1)
SELECT l.doc_id, CAST(coalesce(len(l), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_lines_removed,
       sha256(coalesce(CASE WHEN gone IS NULL THEN text ELSE
         array_to_string(list_transform(list_filter(range(1, len(l) + 1), lambda i: NOT list_contains(gone, i)), lambda i: l[i]), chr(10)) END, '')) AS kept_sha256
FROM l LEFT JOIN gone USING (doc_id)
"""


_OP11 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
                  sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
k AS (SELECT *, len(u) AS n, list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(h, i, 8) AS BIGINT)) AS r FROM d),
c AS (SELECT *, least(r[1] % (n + 1), r[2] % (n + 1)) AS a, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS b,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r[3] % 100 >= 50 THEN 'plain'
                  WHEN r[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM k),
p AS (SELECT doc_id, n, t, form, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid, array_to_string(u[b + 1:n], '') AS suf FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""

_OP13 = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, length('<s>[INST] ' || ' [/INST]' || chr(10) || '</s>' || chr(10))
                + length(regexp_replace(role, '(<\\*)(/?s>)|(\[\\*)(/?INST\]|image |audio |document )', '\1\3\\\2\4', 'g'))
                + length(regexp_replace(text, '(<\\*)(/?s>)|(\[\\*)(/?INST\]|image |audio |document )', '\1\3\\\2\4', 'g')) AS chars FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_decontaminate": _OP3, "op5_topk": _OP5, "op8_line_dedup": _OP8, "op11_fill_middle": _OP11, "op13_chat_format": _OP13}
