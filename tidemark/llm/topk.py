"""Exact top-k inner products, term at a time.

Candidates are packed into blocks; a block holds a posting list per dimension
(rows with a value there, and the values); a list of at least half the block is
kept whole, zeros included. Each sparse query row scatters its weighted postings
into a dense array of scores over the block. The best of each block are selected
by partition and merged per query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

# Vectors of one block; a Python worker holds one query block and one candidate block.
QUERY_ROWS = 256
CANDIDATE_ROWS = 8192
# Query blocks that a task takes, and keeps in memory, beside its candidate blocks.
QUERY_BLOCKS = 64


def usable(vector: Column) -> Column:
    """Not null, and every component is a finite number."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def quantised(vector: Column, scale: int = 256) -> Column:
    """``floor(scale * x)`` of every component as a long."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def top_k(candidates: DataFrame, queries: DataFrame, k: int, *, key: str = "id", vector: str = "vector") -> DataFrame:
    """For each query its ``k`` highest inner products with candidates of another key.

    Vectors are arrays of longs; ties go to the smaller key, and shorter vectors
    count as padded with zeros. Returns ``query_id``, ``rank`` from 1,
    ``candidate_id``, ``score``. Rows with a null key or vector take no part;
    repeated candidates are ranked each; a query key given twice is one query,
    with its smallest vector. A query with no candidate has no row.
    """
    have = candidates.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).select(
        F.col(key).cast("long").alias("id"), F.col(vector).alias("v")
    )
    asked = (
        queries.where(F.col(key).isNotNull() & F.col(vector).isNotNull())
        .groupBy(F.col(key).cast("long").alias("id"))
        .agg(F.min(vector).alias("v"))
    )
    n_blocks = max(1, -(-have.count() // CANDIDATE_ROWS))
    n_query_blocks = max(1, -(-asked.count() // QUERY_ROWS))
    packed = _packed(have, n_blocks).select("block", F.col("rows").alias("candidates")).coalesce(n_blocks)
    asked_blocks = _packed(asked, n_query_blocks).select(F.col("rows").alias("queries"))
    # Every query block meets every candidate block: exhaustive search in pieces of fixed size.
    # Tasks read both sides' shuffles: no block is copied, and none goes through the driver, as it
    # would by a join on block numbers, where Spark takes copies for as small as one original.
    pairs = packed.join(asked_blocks.coalesce(-(-n_query_blocks // QUERY_BLOCKS)).hint("shuffle_replicate_nl"))
    best = pairs.mapInArrow(_search(k), "query_id long, candidate_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "candidate_id")
    return (
        best.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "candidate_id", "score")
    )


def _packed(rows: DataFrame, blocks: int) -> DataFrame:
    spread = F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(blocks)).alias("block")
    return rows.select(spread, F.struct("id", "v").alias("row")).groupBy("block").agg(F.collect_list("row").alias("rows"))


def _dense(rows: pa.StructScalar) -> tuple[np.ndarray, np.ndarray]:
    """Ids and a matrix of values; vectors end in zeros where they are shorter."""
    ids = rows.values.field("id").to_numpy()
    lists = rows.values.field("v")
    sizes = lists.value_lengths().to_numpy()
    values = lists.flatten().to_numpy()
    width = int(sizes.max(initial=0))
    matrix = np.zeros((len(ids), width), np.int64)
    matrix[np.arange(width) < sizes[:, None]] = values
    return ids, matrix


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # a candidate block comes with one query block after another
        for batch in batches:
            for block, candidates, queries in zip(*map(batch.column, ("block", "candidates", "queries")), strict=True):
                if held != block.as_py():
                    held, postings = block.as_py(), _postings(*_dense(candidates))
                yield from _best(*_dense(queries), *postings, k)

    return run


def _postings(ids: np.ndarray, matrix: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray | slice, np.ndarray]], int]:
    """Ids in order; for each dimension the positions with a value and the values; the largest absolute value."""
    order = np.argsort(ids, kind="stable")  # position follows the id, so ties resolve by position
    postings = []
    for column in np.ascontiguousarray(matrix[order].T):
        rows = np.flatnonzero(column)
        postings.append((rows, column[rows]) if 2 * len(rows) < len(column) else (slice(None), column))
    return ids[order], postings, _largest(matrix)


def _largest(values: np.ndarray) -> int:
    return max(int(values.max(initial=0)), -int(values.min(initial=0)))


def _best(q_ids, q_matrix, c_ids, postings, largest: int, k: int) -> Iterator[pa.RecordBatch]:
    # The scatter is bound by memory, so numbers are halved where no sum can leave 32 bits.
    kind = np.int32 if _largest(q_matrix) * largest * len(postings) < 2**31 else np.int64
    q_matrix, postings = q_matrix.astype(kind), [(rows, weights.astype(kind)) for rows, weights in postings]
    out_q, out_c, out_s = [], [], []
    for query, row in zip(q_ids, q_matrix, strict=True):
        scores = np.zeros(len(c_ids), kind)
        for term in np.flatnonzero(row[: len(postings)]):
            rows, weights = postings[term]
            scores[rows] += row[term] * weights
        others = np.flatnonzero(c_ids != query)
        own = scores[others]
        if len(own) > k:
            least = np.partition(own, len(own) - k)[len(own) - k]
            chosen = np.flatnonzero(own >= least)  # all ties at the edge
            chosen = chosen[np.lexsort((chosen, -own[chosen]))[:k]]
        else:
            chosen = np.arange(len(own))
        out_q.append(np.full(len(chosen), query))
        out_c.append(c_ids[others[chosen]])
        out_s.append(own[chosen].astype(np.int64))
    columns = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (out_q, out_c, out_s)]
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "candidate_id", "score"])
