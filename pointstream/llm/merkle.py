"""A Merkle manifest of a dataset: a persistent tree with a version for each changed row.

A row is a leaf: the digest H (lowercase hexadecimal SHA-256 of its inputs, one after the
other) of its values. Leaves are ordered within their group (``lang``) by id; as long as
there is more than one node, every ``FAN`` consecutive ones become their digest. What is
left is the group's subroot; subroots, ordered by group, give the root alike.

The tree is persistent. A changed leaf makes a new version that shares every node with
the base but its own ancestors, which are copied (path copying). Nodes are cut into
aligned blocks: a block holds the nodes above ``FAN ** LEVELS`` consecutive ones up to
their common ancestor. A task makes one block of leaves at a time, base nodes and copies;
the blocks' ancestors are the bottom of the next blocks, tier by tier, then the tree over
the groups. What a version needs from upper tiers is the same for its whole block: the
siblings on the block's way up. That path is made once per block and joined to the block,
so that each version goes on through the upper tiers where it began, and a root is never
a meeting point. No block holds more than ``FAN ** LEVELS`` rows, whatever the size of a
group; a hot group is only more blocks.

Tables that ``write_manifest`` writes: ``leaves`` (one row per leaf, with its place),
``nodes`` (base nodes of all levels: tier of the tree, level, place, digest). Copies of a
version are a row (level, place, digest per copied node). ``version_nodes`` reads a
version: its copies over the shared base nodes.

Null values have a digest of their own kind, empty texts too; very long texts are only
hashed, never moved. A null group is one, and comes first; null ids come first in their
group. Rows that share an id are ordered by their leaf; equal rows are separate leaves
with equal digests. An empty table has no leaf and no root. Other columns are ignored.
"""

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from pointstream.llm.frames import kept

FAN = 8
# Levels of nodes that a block has above its lowest ones.
LEVELS = 3

A_Z, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf_digest(values: list[Column]) -> Column:
    """H of values: ``-`` for a null, else its UTF-8 byte count, a colon and itself."""
    parts = []
    for value in values:
        text = value.cast("string")
        sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
        parts.append(F.coalesce(sized, F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _h(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode("ascii")).hexdigest()


def levels_of(digests: list[str], count: int, most: int) -> list[list[str]]:
    """Up to ``most`` levels above a block's lowest nodes, in a tree of ``count`` such nodes.

    A block goes on to its own top, also with a single node, as long as the whole tree
    has more than one node on the level.
    """
    levels = [digests]
    while count > 1 and len(levels) <= most:
        low = levels[-1]
        levels.append([_h(low[i : i + FAN]) for i in range(0, len(low), FAN)])
        count = -(-count // FAN)
    return levels


def path_in(levels: list[list[str]], place: int) -> list[tuple[str, str]]:
    """Siblings left and right of a node and of its ancestors, below a block's top."""
    path = []
    for low in levels[:-1]:
        first = place // FAN * FAN
        path.append(("".join(low[first:place]), "".join(low[place + 1 : first + FAN])))
        place //= FAN
    return path


def copied(digest: str, path: list[tuple[str, str]]) -> list[str]:
    """Copies of a changed node's ancestors, lowest first."""
    out = []
    for left, right in path:
        digest = _h([left, digest, right])
        out.append(digest)
    return out


def ranked(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """Adds ``place``, the row's number in its tree, and ``size``, the tree's rows.

    Rows are sorted in ranges, so that a hot tree is many tasks; what is added up across
    tasks is one count for each pair of task and tree.
    """
    sorted_rows = rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
    numbered = kept(
        rows.sparkSession, sorted_rows.withColumn("_row", F.monotonically_increasing_id()), "ranked"
    ).withColumn("_shard", F.shiftright("_row", 33))
    counts = numbered.groupBy(tree, "_shard").agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    before = Window.partitionBy(tree).orderBy("_shard")
    starts = counts.select(
        F.col(tree).alias("_tree"),
        F.col("_shard").alias("_of"),
        (F.sum("_n").over(before) - F.col("_n") - F.col("_first")).alias("_shift"),
        F.sum("_n").over(Window.partitionBy(tree)).alias("size"),
    )
    starts = kept(rows.sparkSession, starts, "starts")
    found = numbered.join(starts, numbered[tree].eqNullSafe(starts["_tree"]) & (F.col("_shard") == F.col("_of")))
    return found.withColumn("place", F.col("_row") + F.col("_shift")).drop("_row", "_shard", "_tree", "_of", "_shift")


_NODES = "tree bigint, level int, place bigint, digest string, size bigint"


def _nodes(lowest: DataFrame, level: int, most: int) -> DataFrame:
    """Base nodes of all blocks above nodes (tree, place, digest, size) of a level."""

    def make(table: pa.Table) -> pa.Table:
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("place", "digest"))))
        tree, size = table.column("tree")[0].as_py(), table.column("size")[0].as_py()
        levels = levels_of([d for _, d in rows], size, most)
        out, first, count = [], rows[0][0], size
        for up, digests in enumerate(levels):
            out += [(tree, level + up, first + i, d, count) for i, d in enumerate(digests)]
            first, count = first // FAN, -(-count // FAN)
        return _table(out, _NODES)

    by_block = lowest.select("tree", "place", "digest", "size", _block(most)).groupBy("tree", "block")
    return by_block.applyInArrow(make, _NODES)


def _block(most: int) -> Column:
    return F.expr(f"place div {FAN**most}").alias("block")


_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}


def _table(rows: list[tuple], schema: str) -> pa.Table:
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [[] for _ in fields]
    return pa.Table.from_arrays(
        [pa.array(c, _ARROW[kind]) for c, (_, kind) in zip(columns, fields)], names=[n for n, _ in fields]
    )


_UP = "tree bigint, place bigint, lefts string, rights string, root string, height int"


def _ways(nodes: DataFrame, level: int, upper: DataFrame | None, most: int) -> DataFrame:
    """Per node of a level: the siblings on its whole way up, and the root.

    ``upper`` has the same for the tops of this level's blocks. The siblings of all levels
    are one text each, lowest first, levels parted by commas.
    """

    def make(key: tuple, low: pa.Table, up: pa.Table) -> pa.Table:
        if not low.num_rows:
            return _table([], _UP)
        rows = sorted(zip(*(low.column(c).to_pylist() for c in ("place", "digest"))))
        levels = levels_of([d for _, d in rows], low.column("size")[0].as_py(), most)
        root, above, height = levels[-1][0], [], level + len(levels) - 1
        if up.num_rows:
            lefts, rights, root, height = (up.column(c)[0].as_py() for c in ("lefts", "rights", "root", "height"))
            above = list(zip(lefts.split(","), rights.split(","))) if height > level + len(levels) - 1 else []
        tree, first, out = low.column("tree")[0].as_py(), rows[0][0], []
        for i in range(len(rows)):
            path = path_in(levels, i) + above
            lefts, rights = (",".join(side) for side in zip(*path)) if path else ("", "")
            out.append((tree, first + i, lefts, rights, root, height))
        return _table(out, _UP)

    low = nodes.filter(F.col("level") == level).select("tree", "place", "digest", "size", _block(most))
    up = low.sparkSession.createDataFrame([], _UP) if upper is None else upper
    return (
        low.groupBy("tree", "block")
        .cogroup(up.groupBy("tree", "place"))
        .applyInArrow(make, _UP)
    )


@dataclass(frozen=True)
class Tree:
    """Written nodes of one tree per number, and the ways up from blocks of leaves."""

    nodes: DataFrame
    ways: DataFrame


def build(leaves: DataFrame, most: int) -> Tree:
    """Trees over leaves (tree, place, digest, size): base nodes, and ways from block tops."""
    spark = leaves.sparkSession
    nodes = kept(spark, _nodes(leaves, 0, most), "nodes")
    parts, level = [nodes], most
    # Each pass makes the blocks above the tops of the last; a tree has few tiers.
    while (largest := nodes.filter(F.col("level") == level).agg(F.max("size")).first()[0]) and largest > 1:
        tops = nodes.filter(F.col("level") == level).select("tree", "place", "digest", "size")
        nodes = kept(spark, _nodes(tops, level, most).filter(F.col("level") > level), "nodes")
        parts.append(nodes)
        level += most
    every = parts[0]
    for part in parts[1:]:
        every = every.unionAll(part)
    ways = None
    for low in range(level - most, 0, -most):
        ways = kept(spark, _ways(every, low, ways, most), "ways")
    if ways is None:
        ways = spark.createDataFrame([], _UP)
    return Tree(every, ways)


@dataclass(frozen=True)
class Manifest:
    """A dataset's written tree.

    ``leaves``: id, group, ``tree`` (the group's number), ``place``, ``size``, ``digest``,
    ``changed`` (digest of the changed row, null where unchanged). ``groups``: tree, group,
    ``subroot``, and the siblings on the way to the root. ``nodes`` and ``ways`` of the
    groups' trees; ``top`` is the tree over the subroots, ``root`` its digest.
    """

    leaves: DataFrame
    groups: DataFrame
    tree: Tree
    top: Tree
    root: str | None
    levels: int


def write_manifest(
    docs: DataFrame,
    values: list[str],
    id_column: str = "doc_id",
    group: str = "lang",
    changed: Callable[[DataFrame], Column] | None = None,
    levels: int = LEVELS,
) -> Manifest:
    """Writes the tree of a dataset; ``changed`` gives the digest of a changed row, or null.

    Both digests are made in one pass over the rows. Only ids, groups and digests go on.
    A block has ``levels`` levels above its leaves.
    """
    spark = docs.sparkSession
    digests = docs.select(
        F.col(f"`{id_column}`").cast("bigint").alias("id"),
        F.col(f"`{group}`").cast("string").alias("group"),
        leaf_digest([F.col(f"`{v}`") for v in values]).alias("digest"),
        (F.lit(None).cast("string") if changed is None else changed(docs)).alias("changed"),
    )
    places = kept(spark, ranked(digests, "group", ["id", "digest"]), "leaves")
    named = places.filter("place = 0").select("group", "size")
    # Groups in order, null first: the tree over them has their subroots as leaves.
    numbers = ranked(named.select(F.lit(0).alias("all"), "group"), "all", ["group"])
    groups = kept(spark, numbers.select(F.col("group").alias("name"), F.col("place").alias("tree")), "groups")
    leaves = places.join(groups, places["group"].eqNullSafe(groups["name"])).drop("name")
    leaves = kept(spark, leaves, "leaves")
    tree = build(leaves.select("tree", "place", "digest", "size"), levels)
    roots = tree.nodes.filter("size = 1").groupBy("tree").agg(F.max_by("digest", "level").alias("digest"))
    count = groups.agg(F.count("*")).first()[0]
    subroots = roots.select(
        F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("place"), "digest", F.lit(count).cast("bigint").alias("size")
    )
    top = build(subroots, levels)
    ways = kept(spark, _ways(top.nodes, 0, top.ways, levels), "ways")
    found = groups.join(roots, "tree").join(
        ways.select(F.col("place").alias("tree"), "lefts", "rights", "root", "height"), "tree"
    )
    found = kept(spark, found.withColumnRenamed("digest", "subroot").withColumnRenamed("name", "group"), "groups")
    root = found.select("root").first()
    return Manifest(leaves, found, tree, top, root and root[0], levels)


_VERSIONS = "id bigint, leaf string, subroot string, root string, proof_sha256 string, copies array<string>"


def versions(manifest: Manifest) -> DataFrame:
    """Per leaf: its proof, and the copies that its version made.

    Columns: id, leaf, subroot, root, ``proof_sha256`` (H of the siblings, level by level
    up to the root), ``changed``, ``tree``, ``place`` and ``copies``: the digests of the
    copied ancestors of a changed leaf, lowest first; the last is the version's root. A
    leaf that was not changed makes no version: its copies are the ancestors of the leaf
    as it is, recomputed from it and its siblings.
    """
    most = manifest.levels
    ways = manifest.tree.ways.select("tree", F.col("place").alias("block"), "lefts", "rights", "height")
    # What the blocks of a group share on the way from its subroot to the root.
    tops = manifest.groups.select(
        "tree", "subroot", "root", F.col("lefts").alias("top_lefts"), F.col("rights").alias("top_rights"),
        F.col("height").alias("top_height"),
    )
    blocks = manifest.leaves.groupBy("tree", _block(most)).agg(F.count("*").alias("n"))
    shared = blocks.join(ways, ["tree", "block"], "left").join(tops, "tree")
    # Columns of their own, as the other side comes from the same leaves.
    shared = shared.select("*", F.col("tree").alias("of_tree"), F.col("block").alias("of_block")).drop("tree", "block")

    def make(key: tuple, low: pa.Table, up: pa.Table) -> pa.Table:
        columns = [low.column(c).to_pylist() for c in ("place", "id", "digest", "changed")]
        rows = sorted(zip(*columns), key=lambda r: r[0])
        levels = levels_of([r[2] for r in rows], low.column("size")[0].as_py(), most)
        given = {c: up.column(c)[0].as_py() for c in up.column_names}
        above = []
        # A way is empty where the block's top, or the subroot, is a root already.
        if (given["height"] or 0) > most:
            above += zip(given["lefts"].split(","), given["rights"].split(","))
        if given["top_height"]:
            above += zip(given["top_lefts"].split(","), given["top_rights"].split(","))
        rest = "".join(left + right for left, right in above)
        out = []
        for i, (place, name, digest, new) in enumerate(rows):
            path = path_in(levels, i)
            proof = "".join(left + right for left, right in path) + rest
            copies = copied(new or digest, path + above)
            out.append((name, digest, given["subroot"], given["root"], _h([proof]), copies, place, new, given["of_tree"]))
        columns = list(zip(*out))
        kinds = [pa.int64(), *[pa.string()] * 4, pa.list_(pa.string()), pa.int64(), pa.string(), pa.int64()]
        names = ["id", "leaf", "subroot", "root", "proof_sha256", "copies", "place", "changed", "tree"]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    low = manifest.leaves.select("tree", "place", "size", "id", "digest", "changed", _block(most))
    return (
        low.groupBy("tree", "block")
        .cogroup(shared.groupBy("of_tree", "of_block"))
        .applyInArrow(make, f"{_VERSIONS}, place bigint, changed string, tree bigint")
    )


def folded_root() -> Column:
    """Column: the root of a row of ``versions``; a lone leaf is the root itself."""
    return F.coalesce(F.try_element_at("copies", F.lit(-1)), F.col("changed"), F.col("leaf"))


def version_nodes(manifest: Manifest, made: DataFrame) -> DataFrame:
    """All nodes of the versions in ``made`` (rows of ``versions``) within the group's tree.

    Columns: id, place of the leaf, level, node's place, digest, ``shared`` (whether the
    node is the base's). For inspection of some versions: a version is as large as its
    group's tree.
    """
    height = manifest.tree.nodes.groupBy("tree").agg(F.max("level").alias("height"))
    copies = made.filter("changed IS NOT NULL").join(height, "tree").select(
        "id", "tree", F.col("place").alias("leaf_place"),
        F.posexplode(F.expr("slice(array_prepend(copies, changed), 1, height + 1)")).alias("level", "copy"),
    )
    own = copies.withColumn("place", F.expr(f"CAST(floor(leaf_place / pow({FAN}, level)) AS bigint)"))
    of = made.filter("changed IS NOT NULL").select("id", "tree", F.col("place").alias("leaf_place"))
    every = of.join(manifest.tree.nodes, "tree")
    return every.join(own, ["id", "tree", "leaf_place", "level", "place"], "left").select(
        "id", "leaf_place", "level", "place", F.coalesce("copy", "digest").alias("digest"), F.isnull("copy").alias("shared")
    )


def lower_cased(values: list[str], text: str = "text") -> Callable[[DataFrame], Column]:
    """A change that only lower-cases A-Z of the text, for ``write_manifest``."""

    def changed(docs: DataFrame) -> Column:
        lowered = F.translate(F.col(f"`{text}`"), A_Z, LOWER)
        return leaf_digest([lowered if v == text else F.col(f"`{v}`") for v in values])

    return changed
