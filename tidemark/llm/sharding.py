"""Even shards by balanced label propagation.

Documents are linked when their texts are equal. Each round joins the documents
with the counts of their group per shard; a document that sits outside its
group's leading shards asks to move there. Requests are granted within the
receiving shard's quota, and documents without links are moved out to make room,
so that sizes stay even while fewer links are cut.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import numbered, written
from tidemark.operators.joins import aggregate_for_join

ROUNDS = 6
# Share of its quota that a shard may hold above it between rounds; the last step is exact.
SLACK = 0.3
# Linked rows that are moved as one unit; larger groups are several units.
UNIT_ROWS = 2000


def shard(docs: DataFrame, shards: int, *, doc_id: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """Every row with its ``shard``, its ``slot`` there (gapless from 0) and ``size``.

    Law ``rows``: the shards' row counts differ by one at most. A null text has
    size 16 and crc 0 and is linked with nothing; empty texts are equal texts.
    Repeated rows are kept and count each. Null keys are allowed. Returns the
    key, ``size``, ``text_crc32``, ``shard`` and ``slot``.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc"),
        F.md5(F.col(text).cast("binary")).alias("text_key"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col(text).cast("binary")), F.lit(0)).alias("text_crc32"),
    )
    # Equal rows get different numbers; their hashes spread a hot row like any other.
    base = written(rows.withColumn("row_key", F.monotonically_increasing_id()), "shard-rows")
    total = base.count()
    # A hot text's rows meet its one row in joins that AQE can split.
    sizes = aggregate_for_join(base.where("text_key IS NOT NULL"), ["text_key"], F.count(F.lit(1)).alias("members"))
    linked = sizes.where("members > 1")
    unit_rows = max(1, min(UNIT_ROWS, total // shards))
    part = F.pmod(F.xxhash64("row_key", F.lit(1)), F.ceil(F.col("members") / unit_rows)).cast("int")
    state = written(
        base.select("row_key", "text_key", F.pmod(F.xxhash64("row_key"), F.lit(shards)).cast("int").alias("shard"))
        .join(linked, "text_key", "left")
        .withColumn("part", part)
        .withColumn("unit", F.when(F.col("members").isNull(), F.col("row_key")).otherwise(F.xxhash64("text_key", "part"))),
        "shard-state",
    )
    quota = {s: total // shards + (s < total % shards) for s in range(shards)}
    free = state.where("members IS NULL")
    loose = _counts(free)
    state, before = written(state.where("members > 1").drop("members"), "shard-linked"), None
    n_linked = state.count()
    for _ in range(rounds if n_linked else 0):
        asking = written(_requests(state, n_linked, total, shards), "shard-asks")
        wishes = {(r["shard"], r["wish"]): r["n"] for r in
                  asking.groupBy("shard", "wish").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most shards ** 2
        here = _counts(state)
        granted = _grant(wishes, here, quota, shards)
        moves = sum(n for (a, b), n in granted.items() if a != b)
        if moves == 0 or moves == before:
            break
        before = moves
        allowed = base.sparkSession.createDataFrame(
            [(a, b, n) for (a, b), n in granted.items()] or [(-1, -1, 0)], "shard int, wish int, allowed long"
        )
        ranked = numbered(asking, ["shard", "wish"], ["unit", "row_key"], n_linked, "turn", ["unit"])
        state = written(
            ranked.join(F.broadcast(allowed), ["shard", "wish"], "left").select(  # at most shards ** 2 rows
                "row_key", "text_key", "part", "unit",
                F.when(F.col("turn") < F.coalesce("allowed", F.lit(0)), F.col("wish")).otherwise(F.col("shard")).alias("shard"),
            ),
            "shard-linked",
        )
    # Documents without links fill each shard up to its quota; a shard over quota gives linked ones away last.
    everyone = written(
        state.select("row_key", "unit", "shard", F.lit(0).alias("loose")).unionByName(
            free.select("row_key", "unit", "shard", F.lit(1).alias("loose"))
        ),
        "shard-all",
    )
    placed = _even(everyone, loose, _counts(state), quota, total)
    final = base.join(placed, "row_key")
    return numbered(final, ["shard"], ["row_key"], total, "slot").select(
        F.col("doc").alias(doc_id), "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot")
    )


def _counts(state: DataFrame) -> dict[int, int]:
    """Rows of each shard: one row per shard reaches the driver."""
    return {r["shard"]: r["count"] for r in state.groupBy("shard").count().collect()}


def _requests(state: DataFrame, n: int, total: int, shards: int) -> DataFrame:
    """Each linked row with the shard it wants: its group's leading shard, or one of as many as the group fills."""
    per = state.groupBy("text_key", "shard").agg(F.count(F.lit(1)).alias("n"))
    lead = Window.partitionBy("text_key").orderBy(F.desc("n"), F.pmod(F.xxhash64("text_key", "shard"), F.lit(1 << 30)), "shard")
    room = max(1, total // shards)
    need = F.greatest(F.lit(1), F.ceil(F.sum("n").over(Window.partitionBy("text_key")) / room))
    leaders = (
        per.withColumn("place", F.row_number().over(lead))
        .withColumn("need", need)
        .where("place <= need")
        .groupBy("text_key")
        .agg(F.collect_list("shard").alias("leading"))  # at most one entry per shard
    )
    choice = F.element_at("leading", F.pmod("part", F.size("leading")) + 1)
    wish = F.when(F.array_contains("leading", F.col("shard")), F.col("shard")).otherwise(choice)
    return state.join(written(leaders, "shard-leaders"), "text_key").select("row_key", "text_key", "part", "unit", "shard", wish.alias("wish"))


def _grant(wishes: dict, here: dict[int, int], quota: dict[int, int], shards: int) -> dict:
    """Moves allowed from each shard to each other, so that no shard holds many more linked rows than its quota."""
    leaving = {s: sum(n for (a, b), n in wishes.items() if a == s != b) for s in range(shards)}
    room = {s: int(quota[s] * (1 + SLACK)) + 1 - here.get(s, 0) + leaving[s] for s in range(shards)}
    granted = {}
    for (a, b), n in sorted(wishes.items()):
        if a != b:
            granted[a, b] = max(0, min(n, room[b]))
            room[b] -= granted[a, b]
    return granted


def _even(everyone: DataFrame, loose: dict, linked: dict, quota: dict[int, int], total: int) -> DataFrame:
    """Move what a shard has over its quota, rows without links first, into the gaps of the others."""
    have = {s: loose.get(s, 0) + linked.get(s, 0) for s in quota}
    ranked = numbered(everyone, ["shard", "loose"], ["unit", "row_key"], total, "turn", ["unit"])
    # In a shard over quota the last rows go: turn counts the linked rows first.
    spark = everyone.sparkSession
    limits = spark.createDataFrame(
        [(s, linked.get(s, 0), quota[s], max(0, have[s] - quota[s])) for s in quota],
        "shard int, linked long, quota long, surplus long",
    )
    gaps, start = [], 0
    for s in quota:
        if quota[s] > have[s]:
            gaps.append((s, start, start + quota[s] - have[s]))
            start += quota[s] - have[s]
    before, run = [], 0
    for s in quota:
        before.append((s, run))
        run += max(0, have[s] - quota[s])
    shifts = spark.createDataFrame(before, "shard int, before long")
    position = F.col("turn") + F.col("loose") * F.col("linked")
    marked = (
        ranked.join(F.broadcast(limits), "shard")  # one row per shard
        .join(F.broadcast(shifts), "shard")
        .withColumn("over", position - F.col("quota"))
        .withColumn("seat", F.when(F.col("over") >= 0, F.col("over") + F.col("before")))
    )
    if not gaps:
        return marked.select("row_key", "shard")
    target = F.element_at(
        F.filter(
            F.array(*[F.struct(F.lit(a).alias("s"), F.lit(b).alias("f"), F.lit(c).alias("t")) for a, b, c in gaps]),
            lambda g: (g["f"] <= F.col("seat")) & (F.col("seat") < g["t"]),
        ),
        1,
    )["s"]
    return marked.select("row_key", F.when(F.col("seat").isNotNull(), target).otherwise(F.col("shard")).alias("shard"))
