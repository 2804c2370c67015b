"""Resharding that moves the fewest bytes.

Rows of an old shard fall into blocks by a hash of their id and text. Block sizes (a bounded table) and the new
capacities make a minimum-cost flow: keeping a byte where it is costs nothing, moving it costs one. The flow is
solved between shards, filled with whole blocks, and only shards that gain or lose a block are rewritten.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.llm.common import measured

#: Blocks per old shard. Bounds what the driver sees: old shards times this many rows, whatever the input.
BLOCKS = 2048


def row_bytes(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def even_capacities(total: int, shards: int) -> list[int]:
    return [total * (k + 1) // shards - total * k // shards for k in range(shards)]


def min_cost_flow(
    supply: Sequence[int], capacity: Sequence[int], cost: Mapping[tuple[int, int], int] | None = None
) -> dict[tuple[int, int], int]:
    """Bytes from each old to each new shard: all of ``supply`` placed, within ``capacity``, at least cost.

    Staying costs 0 and moving 1 per byte, unless ``cost`` says otherwise. Successive shortest paths
    (Bellman-Ford on the residual graph); each path fills an arc, so the work depends on the number of
    shards alone. Raises ValueError if the capacities don't hold the supply.
    """
    if sum(capacity) < sum(supply):
        raise ValueError(f"capacities of {sum(capacity)} bytes don't hold {sum(supply)}")
    price = lambda i, j: (cost or {}).get((i, j), int(i != j))
    olds, news = range(len(supply)), range(len(capacity))
    flow: dict[tuple[int, int], int] = defaultdict(int)
    left, room = list(supply), list(capacity)
    while any(left):
        far = {("old", i): 0 for i in olds if left[i]}
        via: dict[tuple[str, int], tuple[str, int]] = {}
        changed = True
        while changed:
            changed = False
            for i in olds:
                for j in news:
                    a, b, c = ("old", i), ("new", j), price(i, j)
                    if a in far and far[a] + c < far.get(b, float("inf")):
                        far[b], via[b], changed = far[a] + c, a, True
                    if flow[i, j] and b in far and far[b] - c < far.get(a, float("inf")):
                        far[a], via[a], changed = far[b] - c, b, True
        end = min((("new", j) for j in news if room[j] and ("new", j) in far), key=lambda n: (far[n], n))
        path = [end]
        while path[-1] in via:
            path.append(via[path[-1]])
        path.reverse()
        steps = list(zip(path, path[1:], strict=False))
        amount = min([left[path[0][1]], room[end[1]], *(flow[b[1], a[1]] for a, b in steps if a[0] == "new")])
        for a, b in steps:
            if a[0] == "old":
                flow[a[1], b[1]] += amount
            else:
                flow[b[1], a[1]] -= amount
        left[path[0][1]] -= amount
        room[end[1]] -= amount
    return {arc: amount for arc, amount in flow.items() if amount}


def fill(blocks: Sequence[tuple[int, int, int]], flow: Mapping[tuple[int, int], int]) -> dict[tuple[int, int], int]:
    """``(old, block) -> new`` for ``(old, block, size)``, close to ``flow``.

    Largest blocks first, each into the move that still has most room for it; what fits none stays. What a
    move then lacks is less than the smallest block left in its shard.
    """
    room = defaultdict(dict)
    for (i, j), amount in flow.items():
        if i != j:
            room[i][j] = amount
    placed = {}
    for old, block, size in sorted(blocks, key=lambda b: (-b[2], b[0], b[1])):
        best = max(room[old], key=lambda j: (room[old][j], -j), default=None)
        fits = best is not None and size <= room[old][best]
        placed[old, block] = best if fits else old
        if fits:
            room[old][best] -= size
    return placed


@dataclass(frozen=True)
class Plan:
    """Where each block of each old shard goes, and its first slot there."""

    shards: int
    blocks: int
    placed: Mapping[tuple[int, int], int]
    first_slot: Mapping[tuple[int, int], int]
    moved_bytes: int
    least_bytes: int
    affected: frozenset[int] = field(default=frozenset())

    def frame(self, spark: SparkSession) -> DataFrame:
        """At most old shards times ``blocks`` rows, so it may be broadcast."""
        rows = [(i, b, j, self.first_slot[i, b]) for (i, b), j in self.placed.items()]
        return spark.createDataFrame(rows, "_old int, _block int, shard int, _first long")


def block_of(doc_id: Column, text: Column, blocks: int = BLOCKS) -> Column:
    """By id and text, so that neither one id nor none makes a large block; only repeated rows share one for sure."""
    return F.pmod(F.xxhash64(F.lit("block"), doc_id, text), F.lit(blocks)).cast("int")


def blocked(docs: DataFrame, old_shard: Column, blocks: int = BLOCKS) -> DataFrame:
    """``docs`` with _size, _old and _block. Rows without an old shard count as of shard 0."""
    return docs.withColumns(
        {
            "_size": row_bytes(F.col("text")),
            "_old": F.coalesce(old_shard.cast("int"), F.lit(0)),
            "_block": block_of(F.col("doc_id"), F.col("text"), blocks),
        }
    )


def plan(rows: DataFrame, shards: int, blocks: int = BLOCKS, capacities: Sequence[int] | None = None) -> Plan:
    """The moves for ``rows`` of :func:`blocked`, from one aggregate of their block sizes."""
    sums = rows.groupBy("_old", "_block").agg(F.sum("_size").alias("size"), F.count("*").alias("n")).collect()
    counts = {(r["_old"], r["_block"]): r["n"] for r in sums}
    sized = [(r["_old"], r["_block"], r["size"]) for r in sums]
    supply = [0] * max([shards, *(o + 1 for o, _, _ in sized)])
    for old, _, size in sized:
        supply[old] += size
    goals = even_capacities(sum(supply), shards) if capacities is None else list(capacities)
    flow = min_cost_flow(supply, goals)
    placed = fill(sized, flow)
    # An old shard that the new layout lacks must be emptied, to the last block.
    load = defaultdict(int)
    for old, block, size in sized:
        load[placed[old, block]] += size
    for old, block, size in sorted(sized):
        if placed[old, block] >= shards:
            load[placed[old, block]] -= size
            placed[old, block] = min(range(shards), key=lambda j: (load[j] - goals[j], j))
            load[placed[old, block]] += size
    first, ends = {}, defaultdict(int)
    for key in sorted(placed):
        first[key] = ends[placed[key]]
        ends[placed[key]] += counts[key]
    moved = [(old, placed[old, block], size) for old, block, size in sized if placed[old, block] != old]
    return Plan(
        shards, blocks, placed, first, sum(size for *_, size in moved),
        sum(amount for (i, j), amount in flow.items() if i != j), frozenset(x for i, j, _ in moved for x in (i, j)),
    )


def source_shard(shards: int) -> Column:
    """The layout in which rows arrive: one shard per source, by hash; null is a source."""
    return F.pmod(F.xxhash64(F.lit("source"), F.col("source")), F.lit(shards))


def resharded(docs: DataFrame, shards: int, old_shard: Column | None = None, **options) -> tuple[DataFrame, Plan]:
    """``docs`` with ``shard`` in 0 to ``shards`` - 1 and sizes near equal, and the plan. Nothing is shuffled
    but the block sizes. Columns ``shard``, ``_size``, ``_old``, ``_block`` and ``_first`` of ``docs`` are replaced. Repeated rows (one
    id, or none, and one text) share a shard; rows of one id or equal texts need not, as a large group of them
    would break the law. A null text has size 1. Empty input gives no rows."""
    rows = blocked(docs.drop("shard"), source_shard(shards) if old_shard is None else old_shard)
    found = plan(rows, shards, **options)
    return rows.join(F.broadcast(found.frame(docs.sparkSession)), ["_old", "_block"]), found


def numbered(layout: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """``layout(doc_id, text, shard, ...)`` with ``slot``, gapless from 0 in each shard: blocks one after the other, ids in order
    within a block, null ids first.

    What is counted is one row for each shard and block, so rows are numbered a block at a time. A column ``slot`` is
    replaced, as are ``_block`` and ``_first``.
    """
    rows = layout.withColumn("_block", block_of(F.col("doc_id"), F.col("text"), blocks))
    counts = rows.groupBy("shard", "_block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("shard", "_block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_first"))
    within = Window.partitionBy("shard", "_block").orderBy("doc_id", F.xxhash64("text"))
    placed = rows.drop("_first").join(measured(first, "first-slots"), ["shard", "_block"])
    return placed.withColumn("slot", F.col("_first") + F.row_number().over(within) - 1).drop("_block", "_first")


def _written_shards(rows: DataFrame, path: str, version: int, fresh: set[int], known: Mapping[int, int]) -> None:
    """The rows of the shards ``fresh`` as files of ``version``, and then its manifest; ``known`` says where the others are."""
    rows.filter(F.col("shard").isin(sorted(fresh))).write.mode("overwrite").partitionBy("shard").parquet(f"{path}/version={version}")
    entries = [(k, version if k in fresh else known[k]) for k in sorted(fresh | known.keys())]
    schema = T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("version", T.IntegerType())])
    spark = rows.sparkSession
    spark.createDataFrame(entries, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest={version}")


def store(docs_by_shard: DataFrame, path: str, shards: int, version: int = 0) -> None:
    """Write a layout as it is: ``docs_by_shard`` with their ``shard``, from 0 to ``shards`` - 1 (null is 0)."""
    rows = docs_by_shard.withColumn("shard", F.coalesce(F.col("shard").cast("int"), F.lit(0)))
    _written_shards(rows, path, version, set(range(shards)), {})


def rewrite(docs_by_shard: DataFrame, path: str, shards: int, version: int, previous: int | None = None, **options) -> Plan:
    """Write the new layout below ``path`` and return the plan.

    ``docs_by_shard`` has the old layout's rows with their ``shard`` (null is 0); all other columns are written as they are, whatever
    their names. Only affected shards get files, as ``version=v/shard=k``; the manifest of the version, written last,
    says for each shard which version holds it. A run that is lost before that leaves the old manifest, and so the
    old layout, in force. With no ``previous`` version every shard is written. No rows give shards without files.
    """
    columns = [c for c in docs_by_shard.columns if c != "shard"]
    whole = docs_by_shard.select("doc_id", "text", F.col("shard").alias("_was"), F.struct(*(F.col(f"`{c}`") for c in columns)).alias("_row"))
    rows = blocked(whole, F.col("_was"))
    found = plan(rows, shards, **options)
    moved = rows.join(F.broadcast(found.frame(docs_by_shard.sparkSession)), ["_old", "_block"])
    fresh = set(range(shards)) if previous is None else found.affected & set(range(shards))
    known = {r.shard: r.version for r in manifest(docs_by_shard.sparkSession, path, previous).collect()} if previous is not None else {}
    _written_shards(moved.select("_row.*", "shard"), path, version, fresh, {k: v for k, v in known.items() if k < shards})
    return found


def manifest(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{path}/manifest={version}")


def read_layout(spark: SparkSession, path: str, version: int, schema: T.StructType | None = None) -> DataFrame:
    """All rows of a layout version, with their shard. A layout without rows has no files to tell its columns: it needs a
    ``schema``, of the columns other than shard."""
    by_version = defaultdict(list)
    for row in manifest(spark, path, version).collect():
        by_version[row.version].append(row.shard)
    reader = spark.read if schema is None else spark.read.schema(T.StructType([*schema.fields, T.StructField("shard", T.IntegerType())]))
    parts = [reader.parquet(f"{path}/version={v}").filter(F.col("shard").isin(shards)) for v, shards in sorted(by_version.items())]
    return reduce(DataFrame.unionByName, parts)
