"""Operator 13: the trie of conversations' common beginnings, with subtree totals.

A node is a distinct sequence of first turns; its key is its depth and the XOR of
hashes of each turn with its place, so a parent's key follows from a child's. Totals
over subtrees come from a centroid decomposition of the parent-edge forest: a
component's centroid splits it into parts of at most half its size, the total of what
hangs below the centroid inside the component is added to each node on the path from
the centroid to the component's top, and the parts are split in turn. Components of
more than ``most`` nodes are split by Spark jobs, all at once in each round; smaller
ones each inside a task. So a deep chain takes as few rounds as a bushy tree.

Texts leave the first pass as digests and lengths. Long conversations are ranked and
hashed in pieces, and hot nodes are summed before they are shuffled.

Turns are in order of turn (null first), then role, then the digest of role and text;
null role or text is ''; repeated rows are turns each. Rows of a null conv_id are one
conversation: it counts as a member and is rebuilt from itself alone, but has no id to
show. An empty table gives no node. Other columns aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

#: Turns of a conversation whose hashes are summed in one task.
PIECE = 1024
#: Nodes of a component that one task splits by itself.
MOST = 2048
#: The most turns that a rebuilt conversation takes from its hundred's first.
HEAD = 5


def place(turns: DataFrame) -> DataFrame:
    """(conv, pos, digest, chars): each turn's place from 1 in its conversation.

    Ranges of (conv, turn) are ranked by themselves and then moved by what earlier
    ranges hold of the conversation.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    narrow = turns.select(F.col("conv_id").cast("long").alias("conv"), "turn", role.alias("role"), digest.alias("digest"), F.length(text).cast("long").alias("chars"))
    narrow = materialise(narrow, "turns")
    dealt = materialise(narrow.repartitionByRange("conv", "turn").withColumn("part", F.spark_partition_id()), "turn-ranges")
    before = F.sum("n").over(Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    held = dealt.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n")).select(F.col("conv").alias("c"), F.col("part").alias("q"), F.coalesce(before, F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy("part", "conv").orderBy("turn", "role", "digest"))
    ranked = dealt.withColumn("rank", rank)
    placed = ranked.join(held, (ranked["part"] == held["q"]) & ranked["conv"].eqNullSafe(held["c"]))
    return placed.select("conv", (F.col("rank") + F.col("before")).alias("pos"), "digest", "chars")


def rebuild(placed: DataFrame) -> DataFrame:
    """(conv, pos, digest, chars, last) of rebuilt conversations.

    With h = crc32(id) % 6, conversation c takes the first h turns of conversation
    c - c % 100 and then its own beyond its first h. ``pos`` 0 is a row of its own in
    each conversation, so a turnless one has one, too; ``last`` marks its last row.
    """
    sizes = placed.groupBy("conv").agg(F.max("pos").alias("n"))
    # a null id has no hash and no hundred
    plan = sizes.select("conv", "n", F.coalesce(F.crc32(F.col("conv").cast("string")) % 6, F.lit(0)).alias("h"), (F.col("conv") - F.col("conv") % 100).alias("base"))
    plan = plan.join(sizes.select(F.col("conv").alias("base"), F.col("n").alias("n_base")), "base", "left")
    head = F.least("h", F.coalesce("n_base", F.lit(0)))
    plan = materialise(plan.select("conv", "base", "h", head.alias("head"), (head + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len")), "plan")
    first = placed.where(F.col("pos") <= HEAD).withColumnRenamed("conv", "base")
    heads = plan.where("head > 0").join(first, "base").where("pos <= h").select("conv", "pos", "digest", "chars", (F.col("pos") == F.col("len")).alias("last"))
    own = plan.select(F.col("conv").alias("c"), "h", "head", "len")
    tails = placed.join(own, placed["conv"].eqNullSafe(own["c"])).where("pos > h").withColumn("pos", F.col("pos") - F.col("h") + F.col("head"))
    tails = tails.select("conv", "pos", "digest", "chars", (F.col("pos") == F.col("len")).alias("last"))
    roots = plan.select("conv", F.lit(0).cast("long").alias("pos"), F.lit(None).cast("string").alias("digest"), F.lit(0).cast("long").alias("chars"), (F.col("len") == 0).alias("last"))
    return roots.unionByName(heads).unionByName(tails)


def _node(depth: str, a: str, b: str) -> F.Column:
    return F.struct(F.col(depth).alias("d"), F.col(a).alias("a"), F.col(b).alias("b"))


def paths(placed: DataFrame) -> DataFrame:
    """(conv, d, v, p, chars, last): the nodes of each conversation from the root
    down, ``p`` the parent (null at the root)."""
    mark = [F.when(F.col("pos") > 0, F.xxhash64(F.lit(i), "pos", "digest")).otherwise(F.lit(0)) for i in (1, 2)]
    rows = placed.withColumns({"x": mark[0], "y": mark[1], "piece": F.expr(f"pos DIV {PIECE}")})
    so_far = Window.partitionBy("conv", "piece").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("c").orderBy("q").rowsBetween(Window.unboundedPreceding, -1)
    total = rows.groupBy(F.col("conv").alias("c"), F.col("piece").alias("q")).agg(F.bit_xor("x").alias("tx"), F.bit_xor("y").alias("ty"))
    total = total.select("c", "q", F.bit_xor("tx").over(earlier).alias("bx"), F.bit_xor("ty").over(earlier).alias("by")).where("q > 0")
    rows = rows.withColumns({"sx": F.bit_xor("x").over(so_far), "sy": F.bit_xor("y").over(so_far)})
    rows = rows.join(total, rows["conv"].eqNullSafe(total["c"]) & (rows["piece"] == total["q"]), "left")
    key = {k: F.col(f"s{k}").bitwiseXOR(F.coalesce(f"b{k}", F.lit(0))) for k in "xy"}
    rows = rows.withColumns({"d": F.col("pos"), "up": F.col("pos") - 1} | {f"k{k}": c for k, c in key.items()} | {f"p{k}": c.bitwiseXOR(F.col(k)) for k, c in key.items()})
    return rows.select("conv", "d", _node("d", "kx", "ky").alias("v"), F.when(F.col("d") > 0, _node("up", "px", "py")).alias("p"), "chars", "last")


def trie(path: DataFrame) -> DataFrame:
    """(v, p, conv_id, n_convs, n_children, leaf, saved) of every node, with its own
    part of the totals."""
    nodes = path.groupBy("v").agg(F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.first("p").alias("p"), F.first("chars").alias("chars"))
    nodes = materialise(nodes, "nodes")
    children = nodes.where("p IS NOT NULL").groupBy(F.col("p").alias("v")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, "v", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
    return nodes.select("v", "p", "conv_id", "n_convs", "n_children", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))


def centroid_sums(parent: list[int], values: list[list[int]]) -> list[list[int]]:
    """Sums over the subtrees of one tree (``parent`` -1 at the top; parents come
    before their children), by centroid decomposition."""
    n = len(parent)
    out = [[0] * n for _ in values]
    part = [0] * n
    size, under = [0] * n, [-1] * n
    stack, names = [list(range(n))], 0
    while stack:
        nodes = stack.pop()
        names += 1
        for v in nodes:
            part[v], size[v] = names, 1
        inside = [parent[v] if parent[v] >= 0 and part[parent[v]] == names else -1 for v in nodes]
        for v, up in zip(reversed(nodes), reversed(inside), strict=True):
            if up >= 0:
                size[up] += size[v]
        # the deepest node that holds half of the part
        c = next(v for v in reversed(nodes) if 2 * size[v] >= len(nodes))
        split: dict[int, list[int]] = {}
        for v, up in zip(nodes, inside, strict=True):
            # -1: not below the centroid; else the child of it that v is below
            under[v] = n if v == c else v if up == c else under[up] if up >= 0 else -1
            if v != c:
                split.setdefault(under[v], []).append(v)
        path = [c]
        while (up := parent[path[-1]]) >= 0 and part[up] == names:
            path.append(up)
        for held, value in zip(out, values, strict=True):
            total = sum(value[v] for v in nodes if under[v] >= 0)
            for v in path:
                held[v] += total
        stack += split.values()
    return out


_KEYS = ["cd", "ca", "cb", "d", "a", "b", "pa", "pb", "leaf", "saved"]


def _small_components(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Subtree sums of whole components, whose rows follow each other by depth."""

    def sums(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        a = 0
        for b in range(1, len(rows) + 1):
            if b == len(rows) or rows[b][:3] != rows[a][:3]:
                mine = rows[a:b]
                at = {r[3:6]: i for i, r in enumerate(mine)}
                found = centroid_sums([at.get((r[3] - 1, r[6], r[7]), -1) for r in mine], [[r[8] for r in mine], [r[9] for r in mine]])
                out += [(*r[3:6], x, y) for r, x, y in zip(mine, *found, strict=True)]
                a = b
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["d", "a", "b", "leaf", "saved"])

    rest: list[tuple] = []
    for batch in batches:
        rows = rest + list(zip(*(batch.column(c).to_pylist() for c in _KEYS), strict=True))
        cut = len(rows)
        while cut and rows[cut - 1][:3] == rows[-1][:3]:
            cut -= 1
        yield from sums(rows[:cut])
        rest = rows[cut:]
    yield from sums(rest)


def _split(rows: DataFrame, big: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One round: splits components at their centroids. Gives the rows with new
    components, and what is added to nodes (v, leaf, saved)."""
    rows = rows.join(big, "c")
    # how far down a conversation's own nodes are in a component; each own node counts
    # for the nodes above it on the conversation's path
    own = F.when(F.col("own"), F.col("d"))
    reach = rows.groupBy(F.col("conv").alias("_conv"), F.col("c").alias("_c")).agg(F.min(own).alias("low"), F.max(own).alias("high")).where("low IS NOT NULL")
    rows = materialise(rows.join(reach, rows["conv"].eqNullSafe(reach["_conv"]) & (rows["c"] == reach["_c"])).drop("_conv", "_c"), "component-rows")
    size = rows.groupBy("c", "v").agg(F.sum(F.expr("high - greatest(d, low) + 1")).alias("size"), F.first("total").alias("total"))
    centre = size.where("2 * size >= total").groupBy("c").agg(F.max("v").alias("z"))
    rows = rows.drop("low", "high", "total").join(materialise(centre, "centroids"), "c")
    # which conversations pass the centroid, and by which child they go on
    way = rows.groupBy(F.col("conv").alias("_conv"), F.col("c").alias("_c")).agg(
        F.max(F.expr("v = z")).alias("through"), F.max(F.expr("v = z AND own")).alias("names"), F.max(F.expr("IF(d = z.d + 1, v, NULL)")).alias("child")
    )
    rows = materialise(rows.join(way, rows["conv"].eqNullSafe(way["_conv"]) & (rows["c"] == way["_c"])).drop("_conv", "_c"), "component-ways")
    hanging = rows.where("own AND through AND d >= z.d").groupBy("z").agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"))
    added = rows.where("names AND d <= z.d").select("v", "z").join(hanging, "z").select("v", "leaf", "saved")
    left = rows.where("NOT through OR d <> z.d").withColumn("c", F.expr("IF(through AND d > z.d, child, c)"))
    return left.select("conv", "d", "v", "p", "c", "own", "leaf", "saved"), materialise(added, "component-totals")


def subtree_sums(path: DataFrame, nodes: DataFrame, most: int = MOST) -> DataFrame:
    """(v, leaf, saved): sums over subtrees of the nodes, by centroid decomposition."""
    root = F.struct(*(F.lit(0).cast("long").alias(k) for k in ("d", "a", "b")))
    sums: list[DataFrame] = []
    ready: list[DataFrame] = []
    if nodes.count() > most:
        held = nodes.select(F.col("v").alias("_v"), "conv_id", "leaf", "saved")
        rows = path.select("conv", "d", "v", "p").join(held, F.col("v") == F.col("_v")).withColumn("own", F.col("conv").eqNullSafe(F.col("conv_id")))
        rows = materialise(rows.withColumn("c", root).select("conv", "d", "v", "p", "c", "own", "leaf", "saved"), "component-paths")
        while True:
            sizes = materialise(rows.where("own").groupBy("c").agg(F.count(F.lit(1)).alias("total")).where(F.col("total") > most), "component-sizes")
            ready.append(rows.where("own").join(sizes.select("c"), "c", "left_anti").select("c", "v", "p", "leaf", "saved"))
            if sizes.isEmpty():
                break
            rows, added = _split(rows, sizes)
            rows = materialise(rows, "component-paths")
            sums.append(added)
    else:
        ready.append(nodes.withColumn("c", root).select("c", "v", "p", "leaf", "saved"))
    small = reduce(DataFrame.unionByName, ready).select("c", *(F.col(f"c.{k}").alias(f"c{k}") for k in "dab"), F.col("v.d"), F.col("v.a"), F.col("v.b"), F.col("p.a").alias("pa"), F.col("p.b").alias("pb"), "leaf", "saved")
    small = small.repartition("c").sortWithinPartitions("cd", "ca", "cb", "d").select(_KEYS)
    found = small.mapInArrow(_small_components, "d long, a long, b long, leaf long, saved long").select(_node("d", "a", "b").alias("v"), "leaf", "saved")
    every = reduce(DataFrame.unionByName, [found, *sums])
    return every.groupBy("v").agg(F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))


def end_hashes(path: DataFrame) -> DataFrame:
    """(v, ends_sha256) of nodes at which conversations end: the ids in order, joined
    by commas. Ids are joined in ranges first, so a node's task hashes long texts
    that go by one after another."""
    keys = ["d", "a", "b"]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in (*keys, "conv")), strict=True))
            out, a = [], 0
            for b in range(1, len(rows) + 1):
                if b == len(rows) or rows[b][:3] != rows[a][:3]:
                    out.append((*rows[a], ",".join(str(r[3]) for r in rows[a:b])))
                    a = b
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], [*keys, "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, None
        for batch in batches:
            out = []
            for *key, ids in zip(*(batch.column(c).to_pylist() for c in (*keys, "ids")), strict=True):
                if key != at:
                    if at is not None:
                        out.append((*at, held.hexdigest()))
                    at, held = key, hashlib.sha256()
                else:
                    held.update(b",")
                held.update(ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], [*keys, "ends_sha256"])
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (*at, held.hexdigest())], [*keys, "ends_sha256"])

    ends = path.where("last AND conv IS NOT NULL").select("v.d", "v.a", "v.b", "conv")
    ends = ends.repartitionByRange(*keys, "conv").sortWithinPartitions(*keys, "conv")
    pieces = ends.mapInArrow(join, "d long, a long, b long, first long, ids string")
    hashed = pieces.repartition(*keys).sortWithinPartitions(*keys, "first").mapInArrow(digest, "d long, a long, b long, ends_sha256 string")
    return hashed.select(_node(*keys).alias("v"), "ends_sha256")


def prefix_trie(placed: DataFrame, most: int = MOST) -> DataFrame:
    """One row a node: conv_id (its least member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256. ``placed``: what ``rebuild``
    gives."""
    path = materialise(paths(placed), "paths")
    nodes = materialise(trie(path), "trie")
    up = nodes.select(F.col("v").alias("_v"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(up, nodes["p"] == up["_v"], "left").join(subtree_sums(path, nodes, most), "v", "left").join(end_hashes(path), "v", "left")
    return out.select(
        "conv_id", F.col("v.d").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def conversation_trie(turns: DataFrame, most: int = MOST) -> DataFrame:
    """The trie of rebuilt conversations."""
    return prefix_trie(rebuild(materialise(place(turns), "placed")), most)
