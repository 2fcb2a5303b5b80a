"""SimHash near-duplicates with pigeonring candidate filtering.

Two 64-bit fingerprints are linked at ``DISTANCE`` differing bits or fewer. A fingerprint is a
ring of four segments. If at most three bits differ in all, then from some segment on every
chain of consecutive segments stays within its share of the bits: the first segment differs in
at most floor(3/4) = 0 bits, the first two in at most floor(6/4) = 1, the first three in at most
2. So that segment is equal and the next differs in at most one bit, which makes an equi-join:
every fingerprint is stored under each pair of neighbouring segments and looked up under each
pair with no bit or one bit of the second segment turned. The longer chains and the full
distance are then checked on what the join finds.

Copies are collapsed to distinct fingerprints first. A join key that many fingerprints share is
cut into blocks; a pair of blocks is one task row that returns a spanning forest of its links
instead of all of them, which leaves the components the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.components import components
from marketloom.llm.identity import keyed
from marketloom.llm.work import stored

SHINGLE, SEED, DISTANCE = 3, 42, 3
SEGMENTS, SEGMENT_BITS = 4, 16
#: Rows of a key above which it is cut into blocks, and fingerprints in a block.
HOT, BLOCK = 24, 512
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
CHUNK = 1 << 16


def fingerprint_of(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The SimHash of a whole text; zero without words."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    count = max(1, len(words) - shingle + 1)
    ends = ends[-count:]
    digest, set_bits = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for low in range(0, count, CHUNK):
        spans = zip(starts[low : low + CHUNK].tolist(), ends[low : low + CHUNK].tolist(), strict=False)
        hashes = np.array([digest(joined[s:e], seed) for s, e in spans], ">u8")
        set_bits += np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    bits = (2 * set_bits > count).astype(np.uint8)
    return int.from_bytes(np.packbits(bits).tobytes(), "big")


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        marks = np.array([fingerprint_of(t.as_py()) for t in batch.column("text")], np.uint64)
        found = pa.array(marks.view(np.int64))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), found], ["doc_id", "mark"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, mark`` (the fingerprint's 64 bits as a long) of every row."""
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")
    )
    return rows.mapInArrow(_fingerprint_batches, "doc_id long, mark long")


def _segment(mark: Column, number: int) -> Column:
    shift = SEGMENT_BITS * (SEGMENTS - 1 - number % SEGMENTS)
    return F.shiftrightunsigned(mark, shift).bitwiseAND(F.lit((1 << SEGMENT_BITS) - 1))


def _key(start: int, first: Column, second: Column) -> Column:
    return F.lit(start << 2 * SEGMENT_BITS).bitwiseOR(F.shiftleft(first, SEGMENT_BITS)).bitwiseOR(second)


def _chains_fit(a: Column, b: Column, start: Column) -> Column:
    """Every chain from ``start`` stays within its share, up to the full distance."""
    difference = a.bitwiseXOR(b)
    fits = F.bit_count(difference) <= DISTANCE
    for s in range(SEGMENTS):
        here, sum_ = F.lit(True), F.lit(0)
        for length in range(1, SEGMENTS):
            sum_ = sum_ + F.bit_count(_segment(difference, s + length - 1))
            here = here & (sum_ <= length * DISTANCE // SEGMENTS)
        fits = fits & ((start != s) | here)
    return fits


def links(marks: DataFrame) -> DataFrame:
    """Links ``a, b`` among distinct fingerprints (column ``mark``), spanning in hot keys."""
    mark = F.col("mark")
    stored_keys = [_key(s, _segment(mark, s), _segment(mark, s + 1)) for s in range(SEGMENTS)]
    looked_up = [
        _key(s, _segment(mark, s), _segment(mark, s + 1).bitwiseXOR(F.lit(turned)))
        for s in range(SEGMENTS)
        for turned in [0, *(1 << bit for bit in range(SEGMENT_BITS))]
    ]
    index = marks.select(F.explode(F.array(*stored_keys)).alias("key"), mark.alias("b"))
    probe = marks.select(F.explode(F.array(*looked_up)).alias("key"), mark.alias("a"))
    sizes = index.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
    hot = stored(sizes.where(F.col("size") > HOT), "hot-keys")
    start = F.shiftright(F.col("key"), 2 * SEGMENT_BITS)
    cold = (
        probe.join(index.join(hot, "key", "left_anti"), "key")
        .where((F.col("a") < F.col("b")) & _chains_fit(F.col("a"), F.col("b"), start))
        .select("a", "b")
    )
    return cold.unionByName(_hot_links(index, probe, hot)).distinct()


def _hot_links(index: DataFrame, probe: DataFrame, hot: DataFrame) -> DataFrame:
    """Spanning links of the keys in ``hot``, a pair of blocks at a time."""
    blocks = (F.floor(F.col("size") / BLOCK) + 1).cast("long")

    def blocked(rows: DataFrame, name: str, salt: int) -> DataFrame:
        block = F.pmod(F.xxhash64(name, F.lit(salt)), blocks)
        chosen = rows.join(hot, "key").withColumn("block", block)
        packed = chosen.groupBy("key", "size", "block").agg(F.collect_list(name).alias(name))
        return packed

    right = blocked(index, "b", 1)
    left = blocked(probe, "a", 2).withColumnRenamed("block", "a_block")
    # Each block of looked-up fingerprints meets each block of stored ones of its key.
    left = left.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    pairs = left.join(right, ["key", "block"]).select("a", "b")
    return pairs.mapInArrow(_forest_batches, "a long, b long")


def _forest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in zip(batch.column("a"), batch.column("b"), strict=True):
            found = spanning_links(a.values.to_numpy(), b.values.to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1])], ["a", "b"])


def spanning_links(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between two blocks, thinned to a spanning forest: at most len(a) + len(b)."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent.setdefault(up, up)
        return x

    from_, to = [], []
    for low in range(0, len(a), BLOCK):
        part = a[low : low + BLOCK]
        near = np.bitwise_count(part[:, None].view(np.uint64) ^ b[None, :].view(np.uint64)) <= DISTANCE
        for i, x in enumerate(part.tolist()):
            for y in b[near[i]].tolist():
                if (r := root(x)) != (s := root(y)):
                    parent[r] = s
                    from_.append(x)
                    to.append(y)
    return np.array(from_, np.int64), np.array(to, np.int64)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row of ``docs``.

    Null and empty texts have fingerprint zero and are linked like any other. The component id
    is the smallest id that is reachable over links; null ids do not count, so a component of
    null ids only has a null one. Repeated rows give repeated rows; empty input gives none;
    other columns are not read.
    """
    marks = stored(fingerprints(docs, id_col, text_col), "fingerprints")
    classes = marks.groupBy("mark").agg(F.min("doc_id").alias("least"))
    classes = stored(classes, "fingerprint-classes")
    roots = components(links(classes.select("mark")))
    rooted = classes.join(roots, F.col("mark") == F.col("node"), "left")
    rooted = rooted.select("mark", "least", F.coalesce("root", "mark").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("mark", "component_id")
    return marks.join(named, "mark").select(
        "doc_id", F.lower(F.lpad(F.hex("mark"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are the first document of their component.

    A document is an id with a text: rows that agree in both stay or go together, and rows of one
    id with different texts are judged apart (see ``identity.keyed`` for which comes first).
    Rows without an id all stay.
    """
    rows, _ = keyed(docs, id_col, text_col)
    found = near_duplicates(rows, "_key", "_text")
    dropped = found.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("_key"))
    return rows.join(dropped.distinct(), "_key", "left_anti").select("_row.*")
