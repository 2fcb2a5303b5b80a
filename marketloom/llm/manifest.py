"""A Merkle manifest of a dataset: content-addressed records, proofs by descent from the root.

Every row is a leaf, the leaves of a group form a tree in the order of their ids, and the trees'
roots form one more tree. A node of ``fan`` children is kept as a record from its digest to
its children's digests. The records of ``LEVELS`` levels below one node are stored as one page
under that node's digest, so a task never holds more than a page and a tree over ten thousand
million rows has four heights of pages.

A request for a leaf descends from the root: the digits of its rank choose a child in the record of
the digest reached so far, the others are kept as a segment of the path, and the segments in
reverse are the proof. Requests that go through the same page share the path down to it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.llm.order import in_order, sums_before
from marketloom.llm.work import stored

FAN = 3
#: Levels of a page: up to FAN ** LEVELS nodes below one digest.
LEVELS = 6
SPAN = FAN**LEVELS
SIZE = 32  # bytes of a digest
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_PATH = "array<struct<left:binary,right:binary>>"
_SEGMENTS = pa.list_(pa.struct([("left", pa.binary()), ("right", pa.binary())]))


def leaf_of(fields: Sequence[Column]) -> Column:
    """Digest of a row as 32 bytes: each field's UTF-8 length, a colon and its text, or ``-`` for null."""

    def part(field: Column) -> Column:
        text = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*map(part, fields)), 256))


def parent_of(children: bytes) -> bytes:
    """Digest of a node: of its children's digests as lower-case hex, one after another."""
    return sha256(children.hex().encode()).digest()


def depth_of(size: int) -> int:
    """Levels above ``size`` nodes of one tree in one page."""
    depth = 0
    while size > 1:
        size, depth = -(-size // FAN), depth + 1
    return min(depth, LEVELS)


def page_of(nodes: list[bytes], size: int) -> tuple[bytes, dict[bytes, bytes]]:
    """The digest above some neighbouring nodes and the records below it.

    ``size`` is the number of nodes of the whole tree at this height: a page of several has all
    its levels, even where the last ones have a single child.
    """
    records: dict[bytes, bytes] = {}
    for _ in range(depth_of(size)):
        runs = [b"".join(nodes[i : i + FAN]) for i in range(0, len(nodes), FAN)]
        nodes = [parent_of(run) for run in runs]
        records.update(zip(nodes, runs, strict=True))
    return nodes[0], records


def descend(top: bytes, rank: int, depth: int, records: dict[bytes, bytes]) -> tuple[bytes, list[tuple[bytes, bytes]]]:
    """The digest ``depth`` levels below ``top`` on the way to ``rank``, and what was not chosen."""
    node, path = top, []
    for level in reversed(range(depth)):
        children, at = records[node], rank // FAN**level % FAN * SIZE
        node = children[at : at + SIZE]
        path.append((children[:at], children[at + SIZE :]))
    return node, path


def fold(leaf: bytes, path: list[tuple[bytes, bytes]]) -> bytes:
    """The root that a leaf and the reversed path segments give."""
    for left, right in reversed(path):
        leaf = parent_of(left + leaf + right)
    return leaf


def proof_digest(path: list[tuple[bytes, bytes]]) -> str:
    """Digest of a proof: the siblings' hex digests from the leaf's level to the root's."""
    return sha256("".join([(left + right).hex() for left, right in reversed(path)]).encode()).hexdigest()


def _page_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    record = pa.list_(pa.struct([("node", pa.binary()), ("children", pa.binary())]))
    for batch in batches:
        tops, pages = [], []
        for nodes, size in zip(batch.column("nodes"), batch.column("size").to_pylist(), strict=True):
            ranked = sorted((n["rank"], n["digest"]) for n in nodes.as_py())
            top, records = page_of([digest for _, digest in ranked], size)
            tops.append(top)
            pages.append([{"node": a, "children": b} for a, b in records.items()])
        yield pa.RecordBatch.from_arrays(
            [batch.column("tree"), batch.column("block"), batch.column("size"), pa.array(tops, pa.binary()),
             pa.array(pages, record)],
            ["tree", "block", "size", "digest", "records"],
        )


_PAGE = "tree long, block long, size long, digest binary, records array<struct<node:binary,children:binary>>"


def _heights(nodes: DataFrame) -> list[DataFrame]:
    """Stored pages of all trees, the lowest first; ``nodes`` has ``tree, rank, digest, size``."""
    heights = []
    while True:
        grouped = nodes.groupBy("tree", F.floor(F.col("rank") / SPAN).alias("block")).agg(
            F.collect_list(F.struct("rank", "digest")).alias("nodes"), F.max("size").alias("size")
        )
        pages = stored(grouped.mapInArrow(_page_batches, _PAGE), "manifest-pages")
        heights.append(pages)
        open_ = pages.where(F.col("size") > SPAN)
        if open_.isEmpty():
            return heights
        nodes = open_.select("tree", F.col("block").alias("rank"), "digest", F.ceil(F.col("size") / SPAN).alias("size"))


def _tops(heights: list[DataFrame], height: int) -> DataFrame:
    """``tree, digest`` of the trees whose highest page is at this height."""
    return heights[height].where(F.col("size") <= SPAN).select("tree", "digest")


@dataclass(frozen=True)
class Manifest:
    """The stored tables of a manifest.

    ``leaves``: ``tree, rank, size, leaf`` and the kept columns; ``groups``: ``tree, group, size``;
    ``pages`` and ``top_pages``: records by height, of the groups' trees and the tree above them;
    ``root``: the dataset's digest, None for an empty one.
    """

    leaves: DataFrame
    groups: DataFrame
    pages: list[DataFrame]
    top_pages: list[DataFrame]
    root: bytes | None


def build(
    docs: DataFrame, group_col: str = "source", id_col: str = "doc_id", fields: Sequence[str] = FIELDS,
    keep: dict[str, Column] | None = None,
) -> Manifest:
    """The manifest of ``docs``: leaves of a group ascend by id, groups by their UTF-8 bytes, nulls first.

    Rows of one group and id are ordered by digest. ``keep`` are more columns of the leaves.
    """
    keep = keep or {}
    marked = docs.select(
        docs[f"`{group_col}`"].cast("string").alias("_group"), docs[f"`{id_col}`"].alias("_id"),
        leaf_of([docs[f"`{field}`"] for field in fields]).alias("leaf"),
        *[column.alias(name) for name, column in keep.items()],
    )
    # Equal rows are told apart by their place in the stored table.
    marked = stored(marked, "manifest-leaves").withColumn("_tie", F.monotonically_increasing_id())
    placed = in_order(marked, [F.col(c) for c in ("_group", "_id", "leaf", "_tie")], "manifest-order").drop("_tie")
    runs = placed.groupBy("_part", "_group").agg(F.count("*").alias("rows"), F.min("_place").alias("first"))
    runs = stored(runs, "manifest-runs")
    groups = in_order(runs.groupBy("_group").agg(F.sum("rows").alias("size")), [F.col("_group")], "manifest-groups")
    offsets = sums_before(groups.groupBy("_part").agg(F.count("*").alias("rows")), "_part", "rows", "_before")
    groups = groups.join(offsets.select("_part", "_before"), "_part").select(
        (F.col("_before") + F.col("_place")).alias("tree"), F.col("_group").alias("group"), "size"
    )
    groups = stored(groups, "manifest-trees")
    earlier = Window.partitionBy("tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.join(groups, F.col("_group").eqNullSafe(F.col("group"))).select(
        "_part", "_group", "tree", "size",
        (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")).alias("_shift"),
    )
    runs = stored(runs.withColumnsRenamed({"_part": "_run_part", "_group": "_run_group"}), "manifest-ranks")
    same = (F.col("_part") == F.col("_run_part")) & F.col("_group").eqNullSafe(F.col("_run_group"))
    leaves = placed.join(runs, same).select(
        "tree", (F.col("_place") + F.col("_shift")).alias("rank"), "size", "leaf", *keep
    )
    leaves = stored(leaves, "manifest-ranked")
    if groups.isEmpty():
        return Manifest(leaves, groups, [], [], None)
    pages = _heights(leaves.select("tree", "rank", F.col("leaf").alias("digest"), "size"))
    subroots = _tops(pages, 0)
    for height in range(1, len(pages)):
        subroots = subroots.unionByName(_tops(pages, height))
    # The trees are the leaves of the one above, with as many nodes as there are groups.
    top_nodes = subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("rank"), "digest")
    top_pages = _heights(top_nodes.withColumn("size", F.lit(groups.count()).cast("long")))
    root = _tops(top_pages, len(top_pages) - 1).first()["digest"]
    return Manifest(leaves, groups, pages, top_pages, bytes(root))


def _requests(wanted: DataFrame, heights: int) -> list[DataFrame]:
    """``tree, block, size, wanted`` by height: the places of a page that requests go through.

    ``wanted`` has ``tree, rank, size`` and ``item``, a struct that travels with a leaf's request.
    """
    found = []
    for _ in range(heights):
        grouped = wanted.groupBy("tree", F.floor(F.col("rank") / SPAN).alias("block")).agg(
            F.collect_list(F.struct(F.pmod("rank", F.lit(SPAN)).cast("int").alias("at"), "item")).alias("wanted"),
            F.max("size").alias("size"),
        )
        found.append(grouped)
        wanted = grouped.where(F.col("size") > SPAN).select(
            "tree", F.col("block").alias("rank"), F.ceil(F.col("size") / SPAN).alias("size"),
            F.lit(None).cast("int").alias("item"),
        )
    return found


def _opened(frontier: DataFrame, requests: DataFrame, pages: DataFrame) -> DataFrame:
    """The frontier with the records of its pages, found by digest, and the requests through them."""
    # Equal subtrees are one page: its address is its content.
    unique = pages.groupBy("digest").agg(F.first("records").alias("records"))
    return frontier.join(requests, ["tree", "block"]).join(unique, "digest")


def _step_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One page further down: a row per requested place."""
    for batch in batches:
        for row in range(batch.num_rows):
            tree, block, subroot, top, path, size, wanted, records = (
                batch.column(c)[row].as_py()
                for c in ("tree", "block", "subroot", "digest", "path", "size", "wanted", "records")
            )
            known, depth = {r["node"]: r["children"] for r in records}, depth_of(size)
            ranks, digests, paths = [], [], []
            for at in [w["at"] for w in wanted]:
                node, more = descend(top, at, depth, known)
                ranks.append(block * SPAN + at)
                digests.append(node)
                paths.append(path + [{"left": a, "right": b} for a, b in more])
            count = len(ranks)
            yield pa.RecordBatch.from_arrays(
                [pa.array([tree] * count, pa.int64()), pa.array(ranks, pa.int64()),
                 pa.array([subroot] * count, pa.binary()), pa.array(digests, pa.binary()), pa.array(paths, _SEGMENTS)],
                ["tree", "block", "subroot", "digest", "path"],
            )


_FRONTIER = f"tree long, block long, subroot binary, digest binary, path {_PATH}"


def _descended(frontier: DataFrame, requests: DataFrame, pages: DataFrame) -> DataFrame:
    return _opened(frontier, requests, pages).mapInArrow(_step_batches, _FRONTIER)


def _frontier(manifest: Manifest, requests: list[DataFrame]) -> DataFrame:
    """``tree, block, subroot, digest, path``: the lowest pages that requests need, reached from the root."""
    spark = manifest.leaves.sparkSession
    heights = len(manifest.top_pages)
    wanted = requests[0].select(F.col("tree").alias("rank")).distinct()
    wanted = wanted.select(
        F.lit(0).cast("long").alias("tree"), "rank", F.lit(manifest.groups.count()).cast("long").alias("size"),
        F.lit(None).cast("int").alias("item"),
    )
    start = [(0, 0, manifest.root, manifest.root, [])]
    frontier = spark.createDataFrame(start, _FRONTIER)
    above = _requests(wanted, heights)
    for height in reversed(range(heights)):
        frontier = _descended(frontier, above[height], manifest.top_pages[height])
    # What was reached are the groups' roots, each the top of its own tree.
    roots = frontier.select(
        F.col("block").alias("tree"), F.lit(0).cast("long").alias("block"), F.col("digest").alias("subroot"), "digest", "path"
    )
    roots = stored(roots, "manifest-frontier")
    frontier = None
    for height in reversed(range(len(manifest.pages))):
        here = roots.join(_tops(manifest.pages, height).select("tree"), "tree", "left_semi")
        frontier = here if frontier is None else frontier.unionByName(here)
        if height:
            frontier = stored(_descended(frontier, requests[height], manifest.pages[height]), "manifest-frontier")
    return frontier


def _proof_batches(root: bytes):
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for row in range(batch.num_rows):
                top, path, subroot, size, records = (
                    batch.column(c)[row].as_py() for c in ("digest", "path", "subroot", "size", "records")
                )
                known, depth = {r["node"]: r["children"] for r in records}, depth_of(size)
                upper = [(p["left"], p["right"]) for p in path]
                wanted = batch.column("wanted")[row].values
                item = wanted.field("item")
                leaves, proofs, folded = [], [], []
                for at, given in zip(wanted.field("at").to_pylist(), item.field("given").to_pylist(), strict=True):
                    leaf, lower = descend(top, at, depth, known)
                    whole = upper + lower
                    leaves.append(leaf.hex())
                    proofs.append(proof_digest(whole))
                    folded.append(fold(leaf if given is None else given, whole).hex())
                same = root.hex()
                columns = [
                    item.field("id"), pa.array(leaves, pa.string()), pa.array([subroot.hex()] * len(leaves)),
                    pa.array([same] * len(leaves)), pa.array(proofs, pa.string()), pa.array(folded, pa.string()),
                    pa.array([x == same for x in folded], pa.bool_()),
                ]
                yield pa.RecordBatch.from_arrays(columns, _NAMES)

    return batches


_NAMES = ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def prove(manifest: Manifest, requests: DataFrame, id_type: str = "long") -> DataFrame:
    """A row per request: its ``id``, ``leaf, subroot, root``, the proof's digest, and whether it folds to the root.

    ``requests`` are rows of ``manifest.leaves`` with ``tree, rank, size``, ``id`` and ``given``,
    the leaf digest that is put to the proof; null stands for the manifest's own.
    """
    schema = f"id {id_type}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    if manifest.root is None:
        return manifest.leaves.sparkSession.createDataFrame([], schema)
    wanted = requests.select("tree", "rank", "size", F.struct("id", "given").alias("item"))
    lists = _requests(wanted, len(manifest.pages))
    opened = _opened(_frontier(manifest, lists), lists[0], manifest.pages[0])
    return opened.mapInArrow(_proof_batches(manifest.root), schema)


def tamper_check(
    docs: DataFrame, tampered: Column, group_col: str = "source", id_col: str = "doc_id", text_col: str = "text",
    fields: Sequence[str] = FIELDS,
) -> DataFrame:
    """Proofs of every row, checked against the row as it is where ``tampered`` holds: without line feeds.

    Columns ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``. Nulls in any
    field, the group included, are values of their own; a row whose ``tampered`` is null is not
    tampered with. Rows of one id and repeated rows are leaves of their own; empty input gives
    no rows; columns that are no field are not read.
    """
    text = docs[f"`{text_col}`"].cast("string")
    altered = F.when(F.contains(text, F.lit("\n")), F.replace(text, F.lit("\n"), F.lit("")))
    changed = [altered if field == text_col else docs[f"`{field}`"] for field in fields]
    given = F.when(F.coalesce(tampered, F.lit(False)) & altered.isNotNull(), leaf_of(changed))
    manifest = build(docs, group_col, id_col, fields, {"id": docs[f"`{id_col}`"].cast("long"), "given": given})
    return prove(manifest, manifest.leaves).withColumnRenamed("id", "doc_id")
