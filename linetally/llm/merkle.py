"""Merkle manifest of a dataset, with proofs by octopus multiproofs.

A leaf is the digest of a row. The leaves of a tree (for documents: of a language)
ascend by id; every 8 consecutive nodes of a level become one of the next, the
digest of their digests joined (the last may have fewer children, even one), until one is left,
the tree's subroot. The subroots, ordered by tree, are the leaves of the top tree, whose last node is the
root of the dataset. Digests are lower-case hexadecimal SHA-256, joined as such.

How it is built. One pass over the rows writes the leaves (texts are never shuffled); a
range sort by (tree, id, leaf) and counts per range give every leaf its position, so a language
with a third of the rows is spread over many tasks, rows of one id, or that are all alike, too. Blocks of
``8^BLOCK_LEVELS`` consecutive leaves are reduced at a time, then blocks of what they left, until each tree has one node.
All nodes are written: they are the manifest.

How rows are proven. The wanted leaves are grouped by block. Each block computes the
coordinates (level, index) of the nodes that its leaves' paths need and that do not follow
from the leaves themselves: the minimal union for all of them, as in Octopus. It fetches these once, by one join on the
coordinates; a node that many blocks ask for is split into copies, whose number both sides know from its
level. Then the block derives the shared interior nodes bottom-up, once, and expands the proof of
each leaf from them. The path from a subroot to the root is worked out in the same way on the top tree, once for each tree.

Results for odd input: null fields are ``-`` in the leaf; a null tree is a tree of its own, the first; null ids come first;
rows that share an id are ordered by their leaves, and equal rows have equal leaves, so which is
which makes no difference to the set of results; a tree of one leaf has that leaf as its subroot, and a dataset of one tree its
subroot as root; an empty table has no leaf, and its root is None. Input columns that start with an underscore are left out.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize
from .common import lower_ascii

ARITY = 8
#: Levels of a block: its 8^4 = 4,096 leaves, and what they need, bound a task's memory.
BLOCK_LEVELS = 4
#: Blocks that may ask for one copy of a node.
ASKERS = 1024
#: Key of the top tree; those of other trees start with "n" (null) or "v" (a value).
TOP = "t"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value as it enters a leaf: ``-`` if null, else its UTF-8 byte count, a colon and itself."""
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def tree_key(tree: Column) -> Column:
    """A key that is never null and sorts like the trees: null first, then bytewise."""
    return F.coalesce(F.concat(F.lit("v"), tree.cast("string")), F.lit("n"))


def _hash(digests: Sequence[str]) -> str:
    return sha256("".join(digests).encode()).hexdigest()


# ---------------------------------------------------------------------------
# The tree by coordinates
# ---------------------------------------------------------------------------


def widths(n: int) -> list[int]:
    """Number of nodes of each level of a tree of ``n`` leaves; the last is 1."""
    out = [n]
    while out[-1] > 1:
        out.append(-(-out[-1] // ARITY))
    return out


def siblings(width: int, index: int) -> range:
    """The run of consecutive nodes of a level that ``index`` is in, itself included."""
    first = index - index % ARITY
    return range(first, min(first + ARITY, width))


def missing(wanted: Sequence[int], n: int) -> list[tuple[int, int]]:
    """Minimal union of the coordinates (level, index) that the paths of the ``wanted`` leaves need and that cannot be derived from them."""
    out, have = [], set(wanted)
    for level, width in enumerate(widths(n)[:-1]):
        parents = {i // ARITY for i in have}
        for p in sorted(parents):
            out += [(level, i) for i in siblings(width, p * ARITY) if i not in have]
        have = parents
    return out


def derived(leaves: dict[int, str], fetched: dict[tuple[int, int], str], n: int) -> dict[tuple[int, int], str]:
    """All nodes on and beside the paths of ``leaves``: the fetched ones, and each shared interior node once."""
    nodes = dict(fetched)
    nodes.update(((0, i), h) for i, h in leaves.items())
    have = set(leaves)
    for level, width in enumerate(widths(n)[:-1]):
        have = {i // ARITY for i in have}
        for p in have:
            nodes[level + 1, p] = _hash([nodes[level, i] for i in siblings(width, p * ARITY)])
    return nodes


def path(nodes: dict[tuple[int, int], str], index: int, n: int) -> list[tuple[int, list[str]]]:
    """Of each level below the top: own place in the run, and the run's other digests, left to right."""
    out = []
    for level, width in enumerate(widths(n)[:-1]):
        run = siblings(width, index)
        out.append((index - run[0], [nodes[level, i] for i in run if i != index]))
        index //= ARITY
    return out


def fold(leaf: str, steps: list[tuple[int, list[str]]]) -> str:
    """The root that follows from a leaf and the digests of its path."""
    for place, others in steps:
        leaf = _hash([*others[:place], leaf, *others[place:]])
    return leaf


# ---------------------------------------------------------------------------
# Building
# ---------------------------------------------------------------------------


@dataclass
class Manifest:
    """``leaves``: a row each, with its columns, ``_tree``, ``_pos`` (in the tree), ``_n`` (leaves of the tree) and ``leaf``.
    ``nodes``: ``_tree``, ``_level``, ``_index``, ``_hash`` of every node above the leaves, the top tree's too, whose leaves are the subroots.
    ``tops``: ``_tree``, ``_n``, ``_top`` (the tree's place among ``trees``), ``subroot``. All are written tables."""

    leaves: DataFrame
    nodes: DataFrame | None
    tops: DataFrame | None
    trees: int
    root: str | None


def _positions(rows: DataFrame, order: Sequence[Column], label: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` (with ``_tree``), sorted by tree and ``order`` and written, with ``_part`` and ``_at``; and for each (part, tree)
    ``_shift``, to be added to ``_at`` for the position in the tree, and ``_n``, the leaves of the tree."""
    by = [F.col("_tree"), *order]
    ranged = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
    ranged = materialize(ranged, label).withColumn("_part", F.shiftright("_at", 33))
    counts = materialize(ranged.groupBy("_part", "_tree").agg(F.count(F.lit(1)).alias("_c"), F.min("_at").alias("_first")), f"{label}-counts")
    tree = W.partitionBy("_tree")
    before = F.coalesce(F.sum("_c").over(tree.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return ranged, counts.select("_part", "_tree", (before - F.col("_first")).alias("_shift"), F.sum("_c").over(tree).alias("_n"))


def _reduce(level_nodes: DataFrame, level: int, levels: int) -> DataFrame:
    """All nodes of the next ``levels`` levels from those of ``level`` (``_tree``, ``_index``, ``_hash``, ``_width``: nodes of the tree at
    this level), one block of 8^levels nodes at a time; a tree that has come down to one node is done."""
    size = ARITY**levels

    def run(t: pa.Table) -> pa.Table:
        tree, width = t.column("_tree")[0].as_py(), t.column("_width")[0].as_py()
        nodes = dict(zip(t.column("_index").to_pylist(), t.column("_hash").to_pylist()))
        rows, at = [], level
        while at < level + levels and width > 1:
            grouped = defaultdict(list)
            for i in sorted(nodes):
                grouped[i // ARITY].append(nodes[i])
            nodes, width, at = {p: _hash(g) for p, g in grouped.items()}, -(-width // ARITY), at + 1
            rows += [(at, p, h, width) for p, h in nodes.items()]
        columns = list(zip(*rows)) or [()] * 4
        return pa.table({"_tree": pa.array([tree] * len(rows), pa.string()), "_level": pa.array(columns[0], pa.int32()),
                         "_index": pa.array(columns[1], pa.int64()), "_hash": pa.array(columns[2], pa.string()),
                         "_width": pa.array(columns[3], pa.int64())})

    block = F.floor(F.col("_index") / size).alias("_block")
    many = level_nodes.where(F.col("_width") > 1).select("_tree", "_index", "_hash", "_width", block)
    return many.groupBy("_tree", "_block").applyInArrow(run, "_tree string, _level int, _index long, _hash string, _width long")


def _forest(leaves: DataFrame, label: str) -> DataFrame:
    """Every node above the leaves (``_tree``, ``_pos``, ``_n``, ``leaf``) of all trees. Actions: writes the nodes of each BLOCK_LEVELS levels."""
    now = leaves.select("_tree", F.col("_pos").alias("_index"), F.col("leaf").alias("_hash"), F.col("_n").alias("_width"))
    level, parts = 0, None
    while True:
        made = materialize(_reduce(now, level, BLOCK_LEVELS), label)
        parts = made if parts is None else parts.unionByName(made)
        level += BLOCK_LEVELS
        now = made.where(F.col("_level") == level)
        if now.where(F.col("_width") > 1).isEmpty():
            return parts


def build(rows: DataFrame, leaf: Column, tree: str, order: str, columns: Sequence[str]) -> Manifest:
    """The manifest of ``rows``: ``leaf`` is the digest of a row, ``tree`` the column that names its tree, ``order`` the integer
    column by which leaves ascend; ``columns`` stay with the leaves. Actions: writes leaves, their order, nodes."""
    keep = [c for c in columns if c[:1] != "_"]
    each = rows.select(*[F.col(f"`{c}`") for c in keep], tree_key(F.col(f"`{tree}`")).alias("_tree"),
                       F.col(f"`{order}`").cast("long").alias("_order"), leaf.alias("leaf"))
    # the number of a written row tells equal rows apart, so that the sort can spread them
    each = materialize(each, "merkle-leaves").withColumn("_row", F.monotonically_increasing_id())
    ranged, shifts = _positions(each, [F.col("_order").asc_nulls_first(), F.col("leaf"), F.col("_row")], "merkle-order")
    # one row for each range and tree in it: a range has no more of them than rows
    leaves = materialize(ranged.join(shifts, ["_part", "_tree"]).select(
        *[F.col(f"`{c}`") for c in keep], "_tree", (F.col("_at") + F.col("_shift")).alias("_pos"), "_n", "leaf"), "merkle-placed")
    sizes = shifts.groupBy("_tree").agg(F.max("_n").alias("_n")).select(F.lit(TOP).alias("_tree"), F.col("_tree").alias("_own"), F.col("_n").alias("_own_n"))
    ordered, top_shifts = _positions(sizes, [F.col("_own")], "merkle-trees")
    trees = ordered.count()
    if not trees:
        return Manifest(leaves, None, None, 0, None)
    names = ordered.join(top_shifts, ["_part", "_tree"]).select(
        F.col("_own").alias("_tree"), F.col("_own_n").alias("_n"), (F.col("_at") + F.col("_shift")).alias("_top"))
    nodes = _forest(leaves, "merkle-nodes")
    single = leaves.where(F.col("_n") == 1).select("_tree", F.col("leaf").alias("subroot"))
    whole = nodes.where(F.col("_width") == 1).select("_tree", F.col("_hash").alias("subroot"))
    tops = materialize(names.join(whole.unionByName(single), "_tree"), "merkle-subroots")
    top_nodes = _forest(_top_leaves(tops, trees), "merkle-top")
    root = (top_nodes.where(F.col("_width") == 1).select("_hash") if trees > 1 else tops.select("subroot")).first()[0]
    return Manifest(leaves, nodes.unionByName(top_nodes).drop("_width"), tops, trees, root)


def _top_leaves(tops: DataFrame, trees: int) -> DataFrame:
    """The subroots as leaves of the top tree."""
    return tops.select(F.lit(TOP).alias("_tree"), F.col("_top").alias("_pos"), F.lit(trees).cast("long").alias("_n"),
                       F.col("subroot").alias("leaf"), F.col("_tree").alias("_own"))


# ---------------------------------------------------------------------------
# Proving
# ---------------------------------------------------------------------------

def _copies(level: Column, blocks: Column) -> Column:
    """Copies of a node: blocks that may ask for it are those below its up to 7 siblings, at most all of the tree."""
    below = (ARITY - 1) * F.pow(F.lit(float(ARITY)), F.greatest(level - BLOCK_LEVELS, F.lit(0)))
    return (F.floor(F.least(below, blocks.cast("double")) / ASKERS) + 1).cast("int")


def _blocked(leaves: DataFrame) -> DataFrame:
    return leaves.withColumn("_block", F.floor(F.col("_pos") / ARITY**BLOCK_LEVELS))


def _fetched(wanted: DataFrame, store: DataFrame, sizes: DataFrame) -> DataFrame:
    """What each block of ``wanted`` leaves (``_tree``, ``_block``, ``_pos``, ``_n``) lacks, from ``store``: ``_tree``, ``_block``,
    ``_level``, ``_index``, ``_hash``. ``sizes``: ``_tree``, ``_n``."""

    def run(t: pa.Table) -> pa.Table:
        tree, block, n = (t.column(c)[0].as_py() for c in ("_tree", "_block", "_n"))
        need = missing(t.column("_pos").to_pylist(), n)
        return pa.table({"_tree": pa.array([tree] * len(need), pa.string()), "_block": pa.array([block] * len(need), pa.int64()),
                         "_level": pa.array([c[0] for c in need], pa.int32()), "_index": pa.array([c[1] for c in need], pa.int64()),
                         "_n": pa.array([n] * len(need), pa.int64())})

    asked = wanted.select("_tree", "_block", "_pos", "_n").groupBy("_tree", "_block").applyInArrow(
        run, "_tree string, _block long, _level int, _index long, _n long")
    blocks = F.ceil(F.col("_n") / ARITY**BLOCK_LEVELS)
    asked = asked.withColumn("_copy", F.pmod(F.col("_block"), _copies(F.col("_level"), blocks)).cast("int")).drop("_n")
    # only nodes that more than ASKERS blocks can ask for have more than one copy, and there are few of these
    above = next(k for k in range(64) if (ARITY - 1) * ARITY**k >= ASKERS)
    high = F.col("_level") >= (BLOCK_LEVELS + above if above else 0)
    tall = store.where(high).join(sizes.select("_tree", "_n"), "_tree").withColumn(
        "_copy", F.explode(F.sequence(F.lit(0), _copies(F.col("_level"), blocks) - 1))).drop("_n")
    low = store.where(~high).withColumn("_copy", F.lit(0))
    return asked.join(low.unionByName(tall), ["_tree", "_level", "_index", "_copy"]).drop("_copy")


def _top_paths(manifest: Manifest) -> DataFrame:
    """For each tree (``_tree``) the coordinates and digests beside its path in the top tree (``_level``, ``_index``, ``_hash``), and ``_top``."""
    own = _blocked(_top_leaves(manifest.tops, manifest.trees))
    above = manifest.nodes.where((F.col("_tree") == TOP) & (F.col("_level") >= BLOCK_LEVELS))
    fetched = _fetched(own, above, own.select("_tree", "_n").distinct())

    def run(mine: pa.Table, got: pa.Table) -> pa.Table:
        rows = []
        if mine.num_rows:
            n, pos = mine.column("_n")[0].as_py(), mine.column("_pos").to_pylist()
            inner = {(a, b): h for a, b, h in zip(*(got.column(c).to_pylist() for c in ("_level", "_index", "_hash")))}
            nodes = derived(dict(zip(pos, mine.column("leaf").to_pylist())), inner, n)
            for tree, i in zip(mine.column("_own").to_pylist(), pos):
                at = i
                for level, width in enumerate(widths(n)[:-1]):
                    rows += [(tree, i, level, k, nodes[level, k]) for k in siblings(width, at) if k != at]
                    at //= ARITY
        columns = list(zip(*rows)) or [()] * 5
        return pa.table({"_tree": pa.array(columns[0], pa.string()), "_top": pa.array(columns[1], pa.int64()),
                         "_level": pa.array(columns[2], pa.int32()), "_index": pa.array(columns[3], pa.int64()),
                         "_hash": pa.array(columns[4], pa.string())})

    return own.groupBy("_tree", "_block").cogroup(fetched.groupBy("_tree", "_block")).applyInArrow(
        run, "_tree string, _top long, _level int, _index long, _hash string")


def prove(manifest: Manifest, wanted: DataFrame | None = None, claimed: str | None = None, digests: bool = False) -> DataFrame:
    """Proofs of the ``wanted`` leaves, rows of ``manifest.leaves`` (default all); column ``claimed``: the leaf that
    someone claims (null: the true one). Their columns with ``subroot``, ``leaf``, ``proof`` (the digests beside the path, level by
    level from the leaf via the subroot to the root, left to right; with ``digests`` instead ``proof_sha256``, the digest of them
    joined), ``folded_root`` (the root that follows from the claimed leaf and the proof), and ``verified`` (it is the manifest's).
    Actions: writes the paths of the top tree."""
    leaves = manifest.leaves if wanted is None else wanted
    made = ["_tree", "_pos", "_n", "leaf"]
    keep = [c for c in leaves.columns if c not in made and c != claimed]
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in leaves.schema.fields if f.name in keep]
    proof = "proof_sha256 string" if digests else "proof array<string>"
    schema = ", ".join([*kinds, "subroot string", "leaf string", proof, "folded_root string", "verified boolean"])
    if not manifest.trees:
        return leaves.sparkSession.createDataFrame([], schema)
    own = _blocked(leaves.select(*[F.col(f"`{c}`") for c in keep], *made, (F.col(f"`{claimed}`") if claimed else F.lit(None)).cast("string").alias("_claimed")))
    store = manifest.nodes.where(F.col("_tree") != TOP)
    if wanted is None:  # whole blocks lack nothing below their own height
        store = store.where(F.col("_level") >= BLOCK_LEVELS)
    else:
        store = store.unionByName(manifest.leaves.select("_tree", F.lit(0).alias("_level"), F.col("_pos").alias("_index"), F.col("leaf").alias("_hash")))
    fetched = _fetched(own, store, manifest.tops).withColumn("_top", F.lit(None).cast("long"))
    # paths of the top tree go to each block of their tree, ASKERS blocks to a copy
    asking = own.groupBy("_tree", "_block").agg(F.floor(F.first("_block") / ASKERS).alias("_copy"))
    paths = materialize(_top_paths(manifest), "merkle-paths").join(asking.select("_tree", "_copy").distinct(), "_tree")
    above = asking.join(paths, ["_tree", "_copy"]).drop("_copy")
    root, trees = manifest.root, manifest.trees
    text = pa.string()

    def run(mine: pa.Table, got: pa.Table) -> pa.Table:
        out, subroot = {"proof": [], "folded": []}, None
        if mine.num_rows:
            n, top, pos = mine.column("_n")[0].as_py(), 0, mine.column("_pos").to_pylist()
            inner, outer = {}, {}
            for a, b, h, place in zip(*(got.column(c).to_pylist() for c in ("_level", "_index", "_hash", "_top"))):
                if place is None:
                    inner[a, b] = h
                else:
                    outer[a, b], top = h, place
            hashes = mine.column("leaf").to_pylist()
            nodes = derived(dict(zip(pos, hashes)), inner, n)
            upper = path(outer, top, trees)
            subroot = nodes[len(widths(n)) - 1, 0]
            same = fold(subroot, upper)  # what every untouched leaf of the block folds to
            for i, h, c in zip(pos, hashes, mine.column("_claimed").to_pylist()):
                steps = path(nodes, i, n) + upper
                beside = [d for _, others in steps for d in others]
                out["proof"].append(_hash(beside) if digests else beside)
                out["folded"].append(same if c is None or c == h else fold(c, steps))
        arrays = [*(mine.column(c) for c in keep), pa.array([subroot] * mine.num_rows, text), mine.column("leaf")]
        return pa.table([*arrays, pa.array(out["proof"], text if digests else pa.list_(text)), pa.array(out["folded"], text),
                         pa.array([f == root for f in out["folded"]], pa.bool_())],
                        names=[*keep, "subroot", "leaf", proof.split()[0], "folded_root", "verified"])

    return own.groupBy("_tree", "_block").cogroup(fetched.unionByName(above).groupBy("_tree", "_block")).applyInArrow(run, schema)


# ---------------------------------------------------------------------------
# Documents
# ---------------------------------------------------------------------------

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def document_leaf(text: Column | None = None) -> Column:
    """The leaf of a document (columns :data:`FIELDS`), with another ``text`` if given."""
    return digest(*[field(text if c == "text" and text is not None else F.col(f"`{c}`")) for c in FIELDS])


def document_manifest(docs: DataFrame, columns: Sequence[str] = ("doc_id",), claimed: Column | None = None) -> Manifest:
    """Manifest of documents, a tree for each language; ``claimed``: a text whose leaf is kept as ``claimed`` where it differs."""
    leaf = document_leaf()
    rows = docs
    if claimed is not None:
        other = document_leaf(claimed)
        rows = docs.withColumn("claimed", F.when(~claimed.eqNullSafe(F.col("text")), other))
        columns = [*[c for c in columns if c != "claimed"], "claimed"]
    return build(rows, leaf, "lang", "doc_id", columns)


def tampered_text(doc_id: Column, text: Column) -> Column:
    """The text with A-Z lower-cased where 3 divides crc32(doc_id as text), else the text."""
    hit = F.crc32(doc_id.cast("string").cast("binary")) % 3 == 0
    return F.when(F.coalesce(hit, F.lit(False)), lower_ascii(text)).otherwise(text)
