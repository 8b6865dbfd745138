"""Minimum-cost-flow resharding: fewest bytes moved from old shards to new ones.

Old shard sizes and new capacities make a flow network: bytes may stay in the
shard of the same number at no cost, or go through a hub to any other at cost 1
a byte. Its cheapest flow (successive shortest paths; shards, not documents, are
its nodes) says how many bytes each old shard keeps and where the rest goes.
Spark then lays the documents of an old shard end to end, large ones first, and
cuts that line where the flow says: a document goes where its middle lies, so
new sizes are off by little more than half of a small document at each cut.

Running sums have two levels (blocks of a few thousand documents, and documents
in a block), so no task takes a whole shard. The plan shuffles only ids, sizes
and checksums. ``rewrite`` then replaces the files of those shards that change:
nearly all blocks go whole to one new shard, so their rows are dealt by a
broadcast row per block and are not shuffled; only the rows of blocks that a cut
goes through (at most one block a cut) are joined with their documents' shards.

The registered query writes the old shards' files under spark.checkpoint.dir
(``reshard-shards-*``), has them rewritten there, and reads ids, sizes, checksums
and shards back from the files; the plan adds the slot (null if the files hold a
row that it does not know). Files are not sorted by slot.

Law of the registered query: ``bytes``. Defined results: a null text has no
bytes and size 16; an empty table gives no row; a null doc_id is an id; repeated
rows are separate documents; extra columns play no part and are kept in the
files, but for one named ``shard``, which the folders' number replaces.
"""

from __future__ import annotations

import heapq
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType
from pyspark.sql.window import Window

from ..session import delete_path, new_scratch_path
from .common import only, staged, whole_text

OVERHEAD = 16
NEW_SHARDS, OLD_SHARDS = 40, 32
BLOCK_ROWS = 4000
#: Blocks that are broadcast; more are joined by shuffle.
MANY = 1_000_000


def cheapest_flow(sizes: Mapping[int, int], capacities: Sequence[int]) -> dict[tuple[int, int], int]:
    """Bytes from old shard to new shard, moving as few as possible.

    The capacities sum to the sizes. Nodes: source, old shards, hub, new shards, sink."""
    if sum(sizes.values()) != sum(capacities):
        raise ValueError("capacities must sum to the old shards' sizes")
    olds = sorted(sizes)
    old = {s: 1 + i for i, s in enumerate(olds)}
    hub = 1 + len(olds)
    new = [hub + 1 + j for j in range(len(capacities))]
    sink = hub + 1 + len(capacities)
    ends: list[list[int]] = []  # [to, residual, cost]; edge e and its reverse e ^ 1
    out: list[list[int]] = [[] for _ in range(sink + 1)]

    def edge(a: int, b: int, room: int, cost: int) -> int:
        out[a].append(len(ends))
        ends.append([b, room, cost])
        out[b].append(len(ends))
        ends.append([a, 0, -cost])
        return len(ends) - 2

    total = sum(capacities)
    stay, away, into = {}, {}, {}
    for s in olds:
        edge(0, old[s], sizes[s], 0)
        if 0 <= s < len(capacities):
            stay[s] = edge(old[s], new[s], sizes[s], 0)
        away[s] = edge(old[s], hub, sizes[s], 1)
    for j, room in enumerate(capacities):
        into[j] = edge(hub, new[j], total, 0)
        edge(new[j], sink, room, 0)
    potential, left = [0] * (sink + 1), total
    while left:
        far, via = [None] * (sink + 1), [-1] * (sink + 1)
        far[0], heap = 0, [(0, 0)]
        while heap:
            d, a = heapq.heappop(heap)
            if d > far[a]:
                continue
            for e in out[a]:
                b, room, cost = ends[e]
                if room and (far[b] is None or d + cost + potential[a] - potential[b] < far[b]):
                    far[b], via[b] = d + cost + potential[a] - potential[b], e
                    heapq.heappush(heap, (far[b], b))
        potential = [p + (d if d is not None else 0) for p, d in zip(potential, far)]
        path, node = [], sink
        while node:
            path.append(via[node])
            node = ends[via[node] ^ 1][0]
        push = min(left, *(ends[e][1] for e in path))
        for e in path:
            ends[e][1] -= push
            ends[e ^ 1][1] += push
        left -= push
    flow = {(s, s): ends[e ^ 1][1] for s, e in stay.items() if ends[e ^ 1][1]}
    # what passes the hub is dealt out in order: cost does not depend on the pairing
    wants = [[j, ends[e ^ 1][1]] for j, e in into.items() if ends[e ^ 1][1]]
    for s in olds:
        give = ends[away[s] ^ 1][1]
        while give:
            j, room = wants[0]
            part = min(give, room)
            flow[s, j] = flow.get((s, j), 0) + part
            give -= part
            wants[0][1] -= part
            if not wants[0][1]:
                wants.pop(0)
    return flow


def equal_capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (j < total % shards) for j in range(shards)]


def blocks_of(rows: int) -> int:
    """Blocks of each band, if the largest old shard has so many rows."""
    return max(1, -(-rows // BLOCK_ROWS))


def blocked(df: DataFrame, n_blocks: int) -> DataFrame:
    """``df`` (doc_id, size, text_crc32, ...) with each document's band and block."""
    # large documents first, so that the cuts fall among the small ones
    band = (-F.floor(F.log2(F.col("size").cast("double")))).cast("int")
    block = F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(n_blocks)).cast("int")
    return df.withColumns({"band": band, "block": block})


def assign(docs: DataFrame, old_shard: Column, shards: int = NEW_SHARDS, *, doc_id="doc_id", text="text") -> DataFrame:
    """One row per document: (doc_id, size, text_crc32, old_shard, shard, slot).

    ``old_shard`` is an expression over the columns ``doc_id`` and ``text``."""
    t = whole_text("text")
    own = staged(
        only(docs, doc_id=doc_id, text=text).select(
            "doc_id", (F.octet_length(t) + OVERHEAD).cast("long").alias("size"), F.crc32(t.cast("binary")).alias("text_crc32"),
            old_shard.cast("int").alias("old_shard"),
        ),
        "reshard-sizes",
    )
    per_old = own.groupBy("old_shard").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).collect()  # a row per shard
    sizes = {r["old_shard"]: r["bytes"] for r in per_old}
    flow = cheapest_flow(sizes, equal_capacities(sum(sizes.values()), shards))
    lines = []
    for s in sorted(sizes):
        at, cuts, to = 0, [], []
        for (a, j), part in sorted(flow.items(), key=lambda x: (x[0][0] != x[0][1], x[0][1])):
            if a == s:
                at += part
                cuts.append(at)
                to.append(j)
        lines.append((s, cuts, to))
    spark = docs.sparkSession
    lines = spark.createDataFrame(lines, "line int, cuts array<bigint>, targets array<int>")

    own = blocked(own, blocks_of(max([r["n"] for r in per_old], default=0)))
    group = ["old_shard", "band", "block"]
    before = Window.partitionBy("old_shard").orderBy("band", "block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = own.groupBy(*group).agg(F.sum("size").alias("bytes")).select(
        *[F.col(c).alias(f"o_{c}") for c in group], F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("offset")
    )
    inside = Window.partitionBy(*group).orderBy("doc_id", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = own.withColumn("upto", F.sum("size").over(inside)).join(
        offsets, [F.col(c) == F.col(f"o_{c}") for c in group]
    ).join(F.broadcast(lines), F.col("old_shard") == F.col("line"))
    middle = F.col("offset") + F.col("upto") - F.floor(F.col("size") / 2)
    place = F.size(F.filter("cuts", lambda c: c <= middle))
    target = F.get("targets", F.least(place, F.size("targets") - 1))
    placed = staged(placed.select("doc_id", "size", "text_crc32", *group, target.alias("shard")), "reshard-placed")

    within = ["shard", *group]
    ahead = Window.partitionBy("shard").orderBy(*group).rowsBetween(Window.unboundedPreceding, -1)
    bases = placed.groupBy(*within).agg(F.count(F.lit(1)).alias("n")).select(
        *[F.col(c).alias(f"b_{c}") for c in within], F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base")
    )
    turn = F.row_number().over(Window.partitionBy(*within).orderBy("doc_id", "text_crc32", "size"))
    return placed.withColumn("turn", turn).join(bases, [F.col(c) == F.col(f"b_{c}") for c in within]).select(
        "doc_id", "size", "text_crc32", "old_shard", "shard", (F.col("base") + F.col("turn") - 1).alias("slot")
    )


def shards(docs: DataFrame, path: str) -> DataFrame:
    """The rows under ``path`` (shard=N folders): the columns of ``docs``, and the shard."""
    fields = [f for f in docs.schema.fields if f.name.lower() != "shard"]
    return docs.sparkSession.read.schema(StructType([*fields, StructField("shard", IntegerType())])).parquet(path)


def measured(text: Column) -> tuple[Column, Column]:
    """Size and checksum of a text."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    return (F.octet_length(t) + OVERHEAD).cast("long"), F.crc32(t.cast("binary"))


def _twins(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Rows alike in ``by`` are numbered."""
    return df.withColumn("twin", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))


def _matched(rows: DataFrame, plan: DataFrame, key: list[str], take: list[str], how: str) -> DataFrame:
    """``rows`` joined with the columns ``take`` of ``plan`` by ``key``; those alike in it are dealt by their number."""
    key = [*key, "twin"]
    plan = _twins(plan, key[:-1], ["shard", "slot"]).select(*[F.col(c).alias(f"m_{c}") for c in key], *[F.col(c).alias(f"to_{c}") for c in take])
    same = [F.col(c).eqNullSafe(F.col(f"m_{c}")) if c == "doc_id" else F.col(c) == F.col(f"m_{c}") for c in key]
    return _twins(rows, key[:-1], ["size"]).join(plan, same, how)


def rewrite(docs: DataFrame, moves: DataFrame, path: str, *, doc_id="doc_id", text="text") -> list[int]:
    """Deal the rows that lie under ``path`` (shard=N folders, the columns of
    ``docs``) to their new shards: only the files of shards that gain or lose
    documents are replaced, once all the new ones are written. Returns those shards."""
    spark = docs.sparkSession
    changed = moves.where("old_shard <> shard").select(F.explode(F.array("old_shard", "shard")).alias("s")).distinct()
    affected = sorted(r["s"] for r in changed.collect())  # shards, not documents
    if not affected:
        return affected
    per_old = moves.groupBy("old_shard").count().agg(F.max("count")).first()[0]
    plan = blocked(moves.where(F.col("old_shard").isin(affected)), blocks_of(per_old))
    group = ["old_shard", "band", "block"]
    goals = staged(plan.groupBy(*group).agg(F.min("shard").alias("least"), F.max("shard").alias("most")), "reshard-blocks")
    few = goals.count() <= MANY
    goals = goals.select(*[F.col(c).alias(f"g_{c}") for c in group], "least", "most")

    stored = shards(docs, path).where(F.col("shard").isin(affected))
    row = F.struct(*[F.col(f"`{c}`") for c in stored.columns if c != "shard"])
    size, crc = measured(F.col(f"row.`{text}`"))
    rows = blocked(stored.select(row.alias("row"), F.col("shard").alias("old_shard")).select(
        "row", "old_shard", F.col(f"row.`{doc_id}`").alias("doc_id"), size.alias("size"), crc.alias("text_crc32")
    ), blocks_of(per_old))
    dealt = rows.join(F.broadcast(goals) if few else goals, [F.col(c) == F.col(f"g_{c}") for c in group])
    cut = goals.where("least <> most").drop("least", "most")
    of_cut = plan.join(F.broadcast(cut) if few else cut, [F.col(c) == F.col(f"g_{c}") for c in group], "left_semi")
    key = ["old_shard", "doc_id", "text_crc32", "size"]
    apart = _matched(dealt.where("least <> most").select("row", *key), of_cut, key, ["shard"], "inner")
    out = dealt.where("least = most").select("row.*", F.col("least").alias("shard")).unionByName(
        apart.select("row.*", F.col("to_shard").alias("shard")))
    fresh = f"{path.rstrip('/')}-new-{uuid.uuid4().hex[:12]}"
    out.write.partitionBy("shard").parquet(fresh)
    there, planned, written = stored.count(), plan.count(), shards(docs, fresh).count()
    if not there == planned == written:
        raise ValueError(f"{there} rows in the shards to rewrite, {planned} planned, {written} written: nothing replaced")
    to = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = to(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for s in affected:
        delete_path(spark, f"{path}/shard={s}")
        new = to(f"{fresh}/shard={s}")
        if fs.exists(new) and not fs.rename(new, to(f"{path}/shard={s}")):
            raise OSError(f"{new} cannot be moved to {path}")
    delete_path(spark, fresh)
    return affected


def reshard(docs: DataFrame, old_shard: Column, path: str, number: int = NEW_SHARDS, *, doc_id="doc_id", text="text") -> DataFrame:
    """Write ``docs`` under ``path`` by their old shards, rewrite them by the new
    ones, and give what the files then hold: (doc_id, size, text_crc32, shard),
    with the plan's (old_shard, slot)."""
    own = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != "shard"])
    own.withColumn("shard", old_shard.cast("int")).write.partitionBy("shard").parquet(path)
    moves = staged(assign(shards(docs, path), old_shard, number, doc_id=doc_id, text=text), "reshard-moves")
    rewrite(docs, moves, path, doc_id=doc_id, text=text)
    size, crc = measured(F.col(f"`{text}`"))
    held = staged(shards(docs, path).select(F.col(f"`{doc_id}`").alias("doc_id"), size.alias("size"), crc.alias("text_crc32"), "shard"), "reshard-written")
    return _matched(held, moves, ["shard", "doc_id", "text_crc32", "size"], ["old_shard", "slot"], "left").select(
        "doc_id", "size", "text_crc32", "shard", F.col("to_old_shard").alias("old_shard"), F.col("to_slot").alias("slot"))


def query(docs: DataFrame) -> DataFrame:
    """Documents lie in 32 shards by the checksum of their id; they go to 40."""
    old = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(OLD_SHARDS))
    return reshard(docs, old, new_scratch_path(docs.sparkSession, "reshard-shards")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "old_shard",
    )
