"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints that differ in at most ``d`` of 64 bits agree in some choice of whole segments, if the bits are cut
into more than ``d`` of them. Each choice with its bits is a masked pattern, the top node of an index; below it
fingerprints are put in Gray order and 16 neighbours at a time share a node with the bits common to all of
them. Two nodes whose common bits differ in more than ``d`` places are pruned with all they hold.

Equal fingerprints count once, however many documents have them. Nothing is lost: every pair within ``d`` is
in one group at least, and large groups are dealt in pairs of chunks.

:func:`groups` links what is within 4 bits. :func:`one_of_each` removes near copies from a corpus: it looks
further and at several independent fingerprints, as two texts of similarity 0.8 usually differ in more bits, and only
proposes by them; each link that counts is confirmed on the shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.llm.common import arrow_map, measured
from postlens.llm.components import components
from postlens.llm.repeats import stirred
from postlens.session import written

SEED, SHINGLE, DISTANCE, BITS = 42, 4, 4, 64
#: Fingerprints of one group that a task compares; larger groups are dealt in chunks of this size.
CHUNK = 4096
#: With more fingerprints than this in the usual group, more segments make smaller groups.
USUAL_GROUP = 8192
FAN = 16
#: The near-copy stage: sets of five-word shingles that share 4/5 of their union. Of two such texts 9.7 bits differ in
#: the mean, so one fingerprint within 10 bits misses four in ten at exactly 0.8; five independent ones miss one in 100.
COPY_SHINGLE, COPY_DISTANCE, COPY_PRINTS, COPY_SHARE = 5, 10, 5, (4, 5)
#: Texts whose shingle sets a task holds at a time.
SETS = 256
PRINT_COLUMNS = [f"fp{k}" for k in range(COPY_PRINTS)]
#: Longs of the bit map of a shingle set that is compared before the set itself is sent, and of one for lists.
SKETCH, BRIEF = 32, 8
#: Nodes of a list of a rare shingle that the others are compared with at first, and how many times as many each next time.
HUBS, MORE_HUBS = 2, 32
#: Links that a task gathers before it drops repeated ones.
LINKS = 1 << 18
#: Pairs of index nodes that are expanded at a time; bounds the memory of a task.
PAIRS = 1 << 12
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def shingle_hashes(raw: bytes, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """XXH64 of the word shingles of a lower-cased text; fewer words are one shingle, none are none."""
    words = raw.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(joined, seed)], np.uint64)
    ends = np.cumsum(np.fromiter((len(w) + 1 for w in words), np.int64, len(words)))
    starts = np.concatenate(([0], ends[:-shingle])).tolist()
    digest = xxhash.xxh64_intdigest
    spans = zip(starts, (ends[shingle - 1 :] - 1).tolist(), strict=True)
    return np.array([digest(joined[a:b], seed) for a, b in spans], np.uint64)


def majority(hashes: np.ndarray) -> int:
    """Bit by bit 1 where more than half of the hashes have it."""
    if not len(hashes):
        return 0
    columns = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    counts = np.concatenate([np.bincount(columns[:, k], minlength=256) @ _BYTE_BITS for k in range(8)])
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``(doc_id, fp)``, fp as a signed long. Null, empty and wordless texts have fingerprint 0."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = [majority(shingle_hashes(raw or b"", shingle, seed)) for raw in part.column(1).to_pylist()]
            prints = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([part.column(0), prints], names=["doc_id", "fp"])

    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, fp long"
    return arrow_map(docs.select("doc_id", F.col("text").cast("binary")), batches, schema)


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the order in which neighbours differ in one bit."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Nodes over fingerprints in Gray order. A node knows the bits set in all and in any of its members; the
    bits on which both agree are its masked pattern."""

    def __init__(self, codes: np.ndarray):
        self.order = np.argsort(gray_rank(codes), kind="stable")
        level = codes[self.order]
        self.all, self.any = [level], [level]
        while len(self.all[-1]) > FAN:
            cuts = np.arange(0, len(self.all[-1]), FAN)
            self.all.append(np.bitwise_and.reduceat(self.all[-1], cuts))
            self.any.append(np.bitwise_or.reduceat(self.any[-1], cuts))

    def pairs(self, other: GrayIndex, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Positions in both inputs of fingerprints within ``distance``, in batches; for ``other is self``
        each pair once. Descends from pairs of top nodes; a pair of nodes is pruned if the bits that all
        of one have and none of the other differ in more than ``distance`` places already."""
        top = min(len(self.all), len(other.all)) - 1
        a, b = np.divmod(np.arange(len(self.all[top]) * len(other.all[top])), len(other.all[top]))
        todo = [(top, a, b)]
        while todo:
            level, a, b = todo.pop()
            if len(a) > PAIRS:
                todo += [(level, a[k : k + PAIRS], b[k : k + PAIRS]) for k in range(0, len(a), PAIRS)]
                continue
            if other is self:
                a, b = a[keep := a <= b], b[keep]
            left = self.all[level][a] & ~other.any[level][b]
            right = other.all[level][b] & ~self.any[level][a]
            near = np.bitwise_count(left | right) <= distance
            a, b = a[near], b[near]
            if not len(a):
                continue
            if level == 0:
                if other is self:
                    a, b = a[keep := a < b], b[keep]
                yield self.order[a], other.order[b]
                continue
            step = np.arange(FAN)
            a = np.repeat((a[:, None] * FAN + step), FAN, axis=1).ravel()
            b = np.tile((b[:, None] * FAN + step), (1, FAN)).ravel()
            inside = (a < len(self.all[level - 1])) & (b < len(other.all[level - 1]))
            todo.append((level - 1, a[inside], b[inside]))


def _join(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the label sets of ``a`` and ``b``; a label is the least position of its set."""
    while True:
        x, y = labels[a], labels[b]
        open_ = x != y
        if not open_.any():
            return
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while True:
            jumped = labels[labels]
            if (jumped == labels).all():
                break
            labels[:] = jumped


def links_within(first: np.ndarray, second: np.ndarray | None, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of links that connect what pairs within ``distance`` connect: among ``first``, or, if ``second``
    is given, between the two, one counted after the other. Fewer links than fingerprints, however many pairs
    there are: each leads to the set's least position."""
    labels = np.arange(len(first) + (0 if second is None else len(second)))
    index = GrayIndex(first)
    other, offset = (index, 0) if second is None else (GrayIndex(second), len(first))
    for a, b in index.pairs(other, distance):
        _join(labels, a, b + offset)
    moved = np.flatnonzero(labels != np.arange(len(labels)))
    return moved, labels[moved]


def starred(node: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Links ``x`` to ``y``, the positions of sets and their labels, as pairs of the other nodes of a set with its least
    one: whatever the cell, a set has the same hub as long as that is in it, so cells repeat links, not add to them."""
    labels = np.unique(y)
    least = node.copy()
    np.minimum.at(least, y, node[x])
    member, hub = np.concatenate((node[x], node[labels])), np.concatenate((least[y], least[labels]))
    return np.stack((member, hub), axis=1)[member != hub]


def _masks(distance: int, chosen: int) -> list[int]:
    """Masks that keep ``chosen`` of ``distance + chosen`` segments: of each pair within ``distance`` at least
    one mask sees no difference."""
    cuts = [BITS * k // (distance + chosen) for k in range(distance + chosen + 1)]
    segments = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:], strict=False)]
    return [sum(part) for part in combinations(segments, chosen)]


def masks_for(n: int, distance: int, usual: int = USUAL_GROUP) -> list[int]:
    """As few masks as keep the usual group of ``n`` even fingerprints within ``usual``; exact in any case."""
    chosen = 1
    while n / 2 ** (BITS * chosen / (distance + chosen)) > usual and comb(distance + chosen, chosen) < 2000:
        chosen += 1
    return _masks(distance, chosen)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def links(nodes: DataFrame, distance: int = DISTANCE, chunk: int = CHUNK) -> DataFrame:
    """``(a, b)`` node ids of links that connect all of ``nodes(node, fp)`` within ``distance`` bits.

    Groups are counted first; of those with a single member nothing is
    dealt, and one of more than ``chunk`` is cut into chunks, of which each pair is a cell of its own.
    """
    masks = masks_for(nodes.count(), distance)
    rows = F.array(*(F.struct(F.lit(k).alias("m"), F.col("fp").bitwiseAND(_signed(m)).alias("bits")) for k, m in enumerate(masks)))
    keyed = nodes.select("*", F.explode(rows).alias("_k")).select("node", "fp", "_k.*")
    sizes = keyed.groupBy("m", "bits").count().filter("count > 1")
    cells = sizes.select("m", "bits", F.ceil(F.col("count") / chunk).cast("int").alias("c"))
    placed = keyed.join(cells, ["m", "bits"]).withColumn("own", F.pmod(F.xxhash64("node"), F.col("c")).cast("int"))
    dealt = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("c") - 1))).select(
        F.xxhash64("m", "bits", F.least("own", "with"), F.greatest("own", "with")).alias("cell"),
        (F.col("own") > F.col("with")).cast("int").alias("second"),
        (F.col("own") == F.col("with")).cast("int").alias("alone"), "node", "fp",
    )

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(parts)) if (parts := [p for p in parts if p.num_rows]) else None
        if table is None:
            return
        cell, second, alone, node, fp = (table.column(k).to_numpy() for k in range(5))
        order = np.argsort(cell, kind="stable")
        cell, second, alone, node, fp = (x[order] for x in (cell, second, alone, node, fp.view(np.uint64)))
        cuts = [*np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1]))), len(cell)]
        found, size = [], 0
        for a, b in zip(cuts, cuts[1:], strict=False):
            one = np.arange(a, b) if alone[a] else np.concatenate((a + np.flatnonzero(second[a:b] == 0), a + np.flatnonzero(second[a:b])))
            left = b - a if alone[a] else b - a - int(second[a:b].sum())
            codes = fp[one]
            x, y = links_within(codes[:left], None if alone[a] else codes[left:], distance)
            if len(x):
                found.append(starred(node[one], x, y))
                size += len(found[-1])
            if size > LINKS:
                yield batch(found)
                found, size = [], 0
        if found:
            yield batch(found)

    def batch(found: list[np.ndarray]) -> pa.RecordBatch:
        pairs = np.unique(np.concatenate(found), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, k])) for k in (0, 1)], names=["a", "b"])

    return arrow_map(dealt.repartition("cell"), batches, "a long, b long")


def clustered(rows: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``rows(doc_id, fp)`` with component_id: the smallest doc_id that a chain of links reaches.

    Rows with the same doc_id are rows of their own; a null doc_id is never the smallest. No rows give no rows.
    """
    noded = rows.withColumn("node", F.col("fp"))
    nodes = written(noded.groupBy("node").agg(F.first("fp").alias("fp"), F.min("doc_id").alias("first")), "fingerprints")
    roots = components(links(nodes.select("node", "fp"), distance))
    rooted = nodes.select("node", "first").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of = rooted.join(least, "root").select("node", "component_id")
    return noded.join(of, "node").drop("node")


def hex_digits(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def groups(docs: DataFrame, distance: int = DISTANCE, **options) -> DataFrame:
    """One row per document: doc_id, fingerprint, component_id. Fingerprints are written, as they are needed twice."""
    prints = written(fingerprints(docs, **options), "simhash")
    found = clustered(prints, distance)
    return found.select("doc_id", hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def _copy_prints(rows: DataFrame) -> DataFrame:
    """Of ``rows(doc_id, rev, raw)`` per row: ``node``, a hash of its set of shingles, their number ``size``, and
    independent fingerprints of the set."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = []
            for raw in part.column(2).to_pylist():
                hashes = np.unique(shingle_hashes(raw, COPY_SHINGLE))
                prints = [majority(stirred(hashes + np.uint64(k << 32)) if k else hashes) for k in range(COPY_PRINTS)]
                found.append((xxhash.xxh64_intdigest(hashes.tobytes()), len(hashes), *prints))
            values = np.array(found, np.uint64).reshape(-1, 2 + COPY_PRINTS).view(np.int64).T
            columns = [part.column(0), part.column(1), *(pa.array(np.ascontiguousarray(v)) for v in values)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "rev", "node", "size", *PRINT_COLUMNS]
    kept = f"doc_id {dict(rows.dtypes)['doc_id']}, rev long, node long, size long, "
    return arrow_map(rows, batches, kept + ", ".join(f"{c} long" for c in PRINT_COLUMNS))


def _sets(nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """``(node, size, sketch, brief, shingles)``: the distinct shingle hashes of one text of each of ``nodes(node, first)``,
    their number, and two bit maps of them."""
    texts = picked(rows, nodes.select("first.doc_id", "first.rev", "first.copies", "node")).select("node", "raw")

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for at in range(0, part.num_rows, SETS):
                one = part.slice(at, SETS)
                found = [np.unique(shingle_hashes(raw, COPY_SHINGLE)).view(np.int64) for raw in one.column(1).to_pylist()]
                lists = [sketched(f, SKETCH) for f in found], [sketched(f, BRIEF) for f in found], found
                columns = [pa.array([len(f) for f in found], pa.int32()), *(pa.array(c, pa.list_(pa.int64())) for c in lists)]
                yield pa.RecordBatch.from_arrays([one.column(0), *columns], names)

    names = ["node", "size", "sketch", "brief", "shingles"]
    return arrow_map(texts, batches, "node long, size int, sketch array<long>, brief array<long>, shingles array<long>")


def sketched(hashes: np.ndarray, longs: int) -> np.ndarray:
    """The bit map of a set: the bit of each of its hashes is 1."""
    bits = np.zeros(64 * longs, bool)
    bits[hashes.view(np.uint64) % np.uint64(64 * longs)] = True
    return np.packbits(bits, bitorder="little").view(np.int64)


def _may_share(size: str, sketch: str, other: str) -> Column:
    """How many elements of a set can be in another at most: a bit that the other lacks is an element that it lacks."""
    lacked = F.zip_with(sketch, other, lambda x, y: F.bit_count(x.bitwiseAND(F.bitwise_not(y))))
    return F.col(size) - F.aggregate(lacked, F.lit(0), lambda total, n: total + n)


def _alike(shared: Column, a: str, b: str) -> Column:
    part, whole = COPY_SHARE
    return whole * shared >= part * (F.col(a) + F.col(b) - shared)


def _may_be_alike(a: str, b: str, a_map: str, b_map: str) -> Column:
    """Whether sets of sizes ``a`` and ``b`` may be alike by their bit maps. No pair that is alike fails."""
    return _alike(F.least(_may_share(a, a_map, b_map), _may_share(b, b_map, a_map)), a, b)


def alike(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of ``pairs(a, b)`` whose sets have similarity 0.8 or more. Exact on the shingle hashes.

    Bit maps of the sets are compared first, and the sets themselves are sent only for pairs that these leave open. ``a`` is
    the one that many pairs may share: its set is joined first, to rows that hold no set yet.
    """
    of = lambda name, *columns: sets.select(F.col("node").alias(name), *(F.col(c).alias(f"{name}_{c}") for c in columns))
    asked = measured(pairs, "pairs")
    maps = asked.join(of("a", "size", "sketch"), "a").join(of("b", "size", "sketch"), "b")
    likely = measured(maps.filter(_may_be_alike("a_size", "b_size", "a_sketch", "b_sketch")).select("a", "b"), "likely")
    held = likely.join(of("a", "size", "shingles"), "a")
    wanted = of("b", "size", "shingles").join(likely.select("b").distinct(), "b", "left_semi")
    shared = F.size(F.array_intersect("a_shingles", "b_shingles"))
    return held.join(wanted, "b").filter(_alike(shared, "a_size", "b_size")).select("a", "b")


def _settled(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """``nodes(node)`` with the root of the confirmed component of each."""
    return written(nodes.join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node")), "confirmed-groups")


def _prefixes(members: DataFrame, sets: DataFrame) -> DataFrame:
    """``(group, shingle, node, size, reach, central)``: the shingles that decide who can be alike within a group of ``members(node, group)``.

    With the group's rarest shingles first, two sets that share 4/5 of their union share one of the first fifth (and
    one more) of either. Shingles that only one member has fill that fifth and are dropped then. reach is the largest set
    that can be alike if the shingle is the first in common: those before it are lacked then. central is how much of its
    set a member shares with another of the group in the mean, times the members.
    """
    part, whole = COPY_SHARE
    each = measured(members, "apart").join(sets, "node").select("group", "node", "size", F.explode("shingles").alias("shingle"))
    each = written(each, "shingles")
    common = written(each.groupBy("group", "shingle").agg(F.count("*").alias("n")).filter("n > 1"), "common-shingles")
    counted = each.join(common, ["group", "shingle"], "left").select("group", "node", "size", F.struct(F.coalesce("n", F.lit(1)).alias("n"), "shingle").alias("s"))
    first = F.col("size") - F.ceil(part * F.col("size") / whole) + 1
    rare = counted.groupBy("group", "node", "size").agg(F.array_sort(F.collect_list("s")).alias("s"), F.sum("s.n").alias("n"))
    prefix = F.posexplode(F.slice("s", F.lit(1), first.cast("int"))).alias("before", "s")
    kept = rare.select("group", "node", "size", (F.col("n") / F.col("size")).alias("central"), prefix)
    reach = (F.floor((part + whole) * (F.col("size") - F.col("before")) / part) - F.col("size")).cast("int").alias("reach")
    return kept.filter("s.n > 1").select("group", "s.shingle", "node", "size", reach, "central")


def _within_reach(lists: DataFrame) -> DataFrame:
    """``lists`` without the members that no set of the list can be alike with by its first common shingle. The lesser of two
    such sets reaches its own size at least, and the other reaches that."""
    least = F.min(F.when(F.col("reach") >= F.col("size"), F.col("size"))).over(Window.partitionBy("group", "shingle"))
    return lists.withColumn("least", least).filter("least <= reach").drop("least")


def confirmed(proposed: DataFrame, nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """``(node, root)`` of every node of the links ``proposed(a, b)``: root is the least node that pairs of similarity 0.8
    or more connect it with, within the groups that the links make.

    Each node is compared with the least node proposed to it, which settles a group of copies with one link for each. Where
    proposals still lead from one settled group to another, all pairs between them count, those too that
    no fingerprint proposed: their rare shingles say which can be alike. Those are compared with the few most central nodes
    of each list of a rare shingle (near copies of one text are least unlike that text, so it comes first), and as long as a
    list holds several settled groups, with the next ones, 32 times as many each time. By then most of what is
    alike is settled; what is left is mostly apart, and bit maps in the lists keep it from becoming pairs. A list only has to
    find the pairs whose first common shingle is its own, so members are compared within their reach.
    """
    among = proposed.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    members = written(nodes.select("node", "first").join(among, "node"), "proposed")
    sets = written(_sets(members, rows), "shingle-sets")
    # Of a proposal the lesser node is the hub.
    hubs = proposed.groupBy(F.greatest("a", "b").alias("b")).agg(F.min(F.least("a", "b")).alias("a"))
    found = written(alike(hubs.select("a", "b"), sets), "alike")
    settled = _settled(found, members.select("node"))
    root = lambda name: settled.select(F.col("node").alias(name), F.col("root").alias(f"{name}_root"))
    open_ = proposed.join(root("a"), "a").join(root("b"), "b").filter("a_root <> b_root")
    groups_ = components(written(open_.select(F.col("a_root").alias("a"), F.col("b_root").alias("b")).distinct(), "open"))
    apart = settled.join(groups_.select(F.col("node").alias("root"), F.col("root").alias("group")), "root").select("node", "group")
    lists = written(_prefixes(apart, sets), "rare-shingles")
    place = F.row_number().over(Window.partitionBy("group", "shingle").orderBy(F.desc("central"), "node"))
    lists = written(_within_reach(lists).withColumn("place", place).drop("central"), "rare-shingles")
    start, step = 1, HUBS
    while True:
        # Lists that hold several settled groups, and members that weren't compared with all others.
        rooted = lists.join(settled.select("node", "root"), "node")
        mixed = rooted.groupBy("group", "shingle").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.max("place").alias("n"))
        mixed = written(mixed.filter((F.col("low") != F.col("high")) & (F.col("n") > start)).select("group", "shingle"), "mixed")
        if not mixed.limit(1).count():
            return settled
        live = rooted.join(mixed, ["group", "shingle"])
        may_be = (F.col("size") <= F.col("a_reach")) & (F.col("a_size") <= F.col("reach"))
        if start > 1:
            live, may_be = live.join(sets.select("node", "brief"), "node"), may_be & _may_be_alike("size", "a_size", "brief", "a_brief")
        live = written(live, "live")
        of_hub = {c: f"a_{c}" for c in live.columns if c not in ("group", "shingle")}
        hub = live.filter(F.col("place").between(start, start + step - 1)).withColumnsRenamed(of_hub).withColumnRenamed("a_node", "a")
        other = (F.col("place") > F.col("a_place")) & (F.col("root") != F.col("a_root"))
        pairs = hub.join(live, ["group", "shingle"]).filter(other & may_be)
        more = written(alike(pairs.select("a", F.col("node").alias("b")).distinct(), sets), "alike")
        if more.limit(1).count():
            found = written(found.unionByName(more), "alike")
            settled = _settled(found, members.select("node"))
        start, step = start + step, MORE_HUBS * step


def picked(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """One of ``rows`` with each key (doc_id, rev) of ``chosen(doc_id, rev, copies, ...)``, with the columns of both.

    Where a key has several rows they are dealt out evenly before they are brought down to one.
    """
    chosen = measured(chosen.withColumnsRenamed({"doc_id": "_id", "rev": "_rev"}), "chosen")
    joined = rows.join(chosen, _same_key())
    several = joined.filter("copies > 1").repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    one = several.groupBy("_id", "_rev").agg(F.first(F.struct(*joined.columns)).alias("_row")).select("_row.*")
    return joined.filter("copies = 1").unionByName(one).drop("_id", "_rev", "copies")


def _same_key() -> Column:
    return F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("rev") == F.col("_rev"))


def near_copies(rows: DataFrame) -> DataFrame:
    """Each key of ``rows(doc_id, rev, raw)`` once: (doc_id, rev, copies, chosen). copies is how many rows have it,
    chosen the key that stays of its group: the least doc_id and rev, a null doc_id last."""
    prints = [F.first(c).alias(c) for c in PRINT_COLUMNS]
    keys = _copy_prints(rows).groupBy("node", "doc_id", "rev").agg(F.count("*").alias("copies"), F.first("size").alias("size"), *prints)
    keys = written(keys, "simhash")
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rev", "copies")
    nodes = written(keys.groupBy("node").agg(F.min(key).alias("first"), F.first("size").alias("size"), *prints), "fingerprints")
    found = [links(nodes.select("node", F.col(c).alias("fp")), COPY_DISTANCE) for c in PRINT_COLUMNS]
    proposed = written(reduce(DataFrame.unionByName, found).distinct(), "proposals")
    roots = confirmed(proposed, nodes, rows)
    rooted = nodes.select("node", "first").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("first").alias("chosen"))
    return keys.select("node", "doc_id", "rev", "copies").join(rooted.join(least, "root").select("node", "chosen"), "node")


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of near copies, the one of the smallest doc_id; same columns.

    Near copies are texts that a chain of pairs of similarity 0.8 or more connects. Texts are equal for this if their
    shingles are; wordless texts are one group. Rows without doc_id, and different texts under one doc_id, are
    rows of their own: they go only as near copies of what stays. A row without doc_id stays if no row of
    its group has one.
    """
    columns = {f"_in_{i}": name for i, name in enumerate(docs.columns)}
    plain = docs.toDF(*columns)
    of = {name: c for c, name in columns.items()}
    keyed = plain.select("*", F.col(of["doc_id"]).alias("doc_id"), F.xxhash64(of["text"]).alias("rev"))
    raw = F.coalesce(F.col(of["text"]), F.lit("")).cast("binary").alias("raw")
    found = written(near_copies(keyed.select("doc_id", "rev", raw)), "near-copies")
    stays = F.col("doc_id").eqNullSafe(F.col("chosen.doc_id")) & (F.col("rev") == F.col("chosen.rev"))
    apart = measured(found.filter(~stays | (F.col("copies") > 1)).select(F.col("doc_id").alias("_id"), F.col("rev").alias("_rev")), "gone")
    single = keyed.join(apart, _same_key(), "left_anti")
    several = picked(keyed, found.filter(stays & (F.col("copies") > 1)).select("doc_id", "rev", "copies"))
    return single.unionByName(several).select(*(F.col(c).alias(n) for c, n in columns.items()))
