"""SimHash near-duplicates by BK-trees.

A fingerprint has a bit for each of 64 positions, set if over half the hashes
of the text's word shingles have it. Two fingerprints link at ``max_bits`` or
fewer differing bits; linked ones form groups.

Search works on distinct fingerprints, so copies cost one row. With 64 bits in
``blocks`` blocks, two that differ in ``max_bits`` bits agree on at least
``blocks - max_bits`` whole blocks, so each fingerprint goes to one shard for
every choice of that many blocks, and both meet in one of them. Each shard is a
BK-tree: a node's children are keyed by their Hamming distance to it, and a
search with radius r at distance d follows only keys d - r to d + r.

A shard of more than ``tree_size`` fingerprints is split into trees of about
that size; each tree is sent to with all fingerprints of the shard that are in
it or in a later tree, so every pair meets once and no task holds a tree that
grows with the data. From a tree come not all its pairs but a spanning forest
of the links found, at most one row for each fingerprint that was looked up.

Texts without words, NULL and empty ones have fingerprint zero, linked like
any other. Repeated rows get a row each. A NULL id never names a group; a group
of rows without ids has a NULL ``component_id``, and ``group`` still tells it.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.common import connected_groups, ship, stored

SHINGLE_WORDS = 4
MAX_BITS = 4
BLOCKS = 6
TREE_SIZE = 4096
# Shingles hashed at once, so that memory does not grow with a text.
_SLICE = 65_536
# Fixed value: the white space between words.
_SPACES = bytes([0x20, *range(0x09, 0x0E)])
_TO_BLANK = bytes.maketrans(_SPACES, b" " * len(_SPACES))
_SEED = 42


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint of a text."""
    import xxhash

    # bytes.lower changes A-Z only, and white space has one byte each.
    joined = b" ".join(w for w in (text or "").encode().lower().translate(_TO_BLANK).split(b" ") if w)
    if not joined:
        return 0
    blanks = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = np.concatenate(([0], blanks + 1))
    ends = np.concatenate((blanks, [len(joined)]))
    if len(starts) <= words:
        starts, ends = starts[:1], ends[-1:]
    else:
        starts, ends = starts[: len(starts) - words + 1], ends[words - 1 :]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), _SLICE):
        pairs = zip(starts[at : at + _SLICE].tolist(), ends[at : at + _SLICE].tolist(), strict=True)
        hashes = np.array([digest(joined[i:j], _SEED) for i, j in pairs], ">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(starts)).tobytes(), "big")


def fingerprint_udf(words: int = SHINGLE_WORDS):
    """text -> fingerprint as a signed integer."""

    @F.arrow_udf(T.LongType())
    def fingerprints(texts: pa.Array) -> pa.Array:
        found = np.array([fingerprint(text.as_py(), words) for text in texts], np.uint64)
        return pa.array(found.view(np.int64))

    return fingerprints


class BKTree:
    """Integers by Hamming distance; equal ones share a node."""

    def __init__(self):
        self.root: tuple[int, dict] | None = None

    def add(self, value: int) -> None:
        if self.root is None:
            self.root = (value, {})
            return
        node = self.root
        while True:
            apart = (node[0] ^ value).bit_count()
            if not apart:
                return
            child = node[1].get(apart)
            if child is None:
                node[1][apart] = (value, {})
                return
            node = child

    def near(self, value: int, radius: int):
        """Stored values within the radius."""
        todo = [self.root] if self.root else []
        while todo:
            stored_value, children = todo.pop()
            apart = (stored_value ^ value).bit_count()
            if apart <= radius:
                yield stored_value
            if children:
                if len(children) <= 2 * radius + 1:
                    todo += [c for key, c in children.items() if apart - radius <= key <= apart + radius]
                else:
                    keys = range(apart - radius, apart + radius + 1)
                    todo += [children[key] for key in keys if key in children]


class _Shard:
    """One tree and which of its values are connected so far."""

    def __init__(self, radius: int):
        self.radius, self.tree, self.parent = radius, BKTree(), {}

    def _find(self, x: int) -> int:
        while (up := self.parent.setdefault(x, x)) != x:
            self.parent[x] = x = self.parent.setdefault(up, up)
        return x

    def look_up(self, value: int, guest: bool) -> list[tuple[int, int]]:
        """Links of a value to the tree, without those between values that are
        already connected. A guest is not added to the tree, so any number of
        them can pass."""
        links, first = [], None if guest else value
        for other in self.tree.near(value, self.radius):
            if first is None:
                first = other
                links.append((value, other))
                continue
            a, b = self._find(first), self._find(other)
            if a != b:
                self.parent[max(a, b)] = min(a, b)
                links.append((value, other))
        if not guest:
            self.tree.add(value)
        return links


def spanning_links(inside, outside, radius: int) -> list[tuple[int, int]]:
    """Links within the radius among ``inside``, and from ``outside`` to it,
    reduced to those that connect. Each link is a real one."""
    shard = _Shard(radius)
    links = [link for value in inside for link in shard.look_up(value, False)]
    return links + [link for value in outside for link in shard.look_up(value, True)]


def _search(radius: int):
    """Rows (shard, tree, guest, f), sorted so that a tree's own values come
    before its guests, to links (a, b). One tree is held at a time."""

    def run(batches):
        key, shard = None, None
        for batch in batches:
            links = []
            for at, tree, guest, f in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if (at, tree) != key:
                    key, shard = (at, tree), _Shard(radius)
                links += shard.look_up(f & 0xFFFFFFFFFFFFFFFF, guest)
            yield _links_batch(links)

    return run


def _links_batch(links: list[tuple[int, int]]) -> pa.RecordBatch:
    both = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], names=["a", "b"])


def shards(prints: DataFrame, max_bits: int, blocks: int) -> DataFrame:
    """``(shard, f)``: each fingerprint once for every choice of blocks. The
    shard is a hash of the choice and its bits; a collision only adds
    candidates."""
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in itertools.pairwise(edges)]
    keys = []
    for n, choice in enumerate(itertools.combinations(masks, blocks - max_bits)):
        mask = sum(choice)
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.xxhash64(F.lit(n), F.col("f").bitwiseAND(F.lit(signed))))
    return prints.select(F.explode(F.array(*keys)).alias("shard"), "f")


def near_links(
    prints: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS, tree_size: int = TREE_SIZE
) -> DataFrame:
    """``(a, b)``: links between distinct fingerprints (column ``f``), enough
    to connect all that are linked."""
    if not 0 <= max_bits < blocks <= 32:
        raise ValueError("there must be more blocks than bits that may differ")
    rows = shards(prints, max_bits, blocks)
    sizes = rows.groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    trees = F.ceil(F.col("n") / tree_size).cast("int")
    placed = rows.join(sizes, "shard").select(
        "shard", "f", trees.alias("trees"), F.pmod(F.xxhash64(F.lit("tree"), "f"), trees).cast("int").alias("own")
    )
    sent = placed.select(
        "shard", F.explode(F.sequence(F.lit(0), F.col("own"))).alias("tree"), "own", "f"
    ).select("shard", "tree", (F.col("own") != F.col("tree")).alias("guest"), "f")
    return (
        sent.repartition("shard", "tree")
        .sortWithinPartitions("shard", "tree", "guest", "f")
        .mapInArrow(_search(max_bits), "a long, b long")
    )


def near_duplicates(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    blocks: int = BLOCKS,
    tree_size: int = TREE_SIZE,
) -> DataFrame:
    """``(id, text_hash, fingerprint, component_id, group, stays)`` of every
    row: the least id that can be reached over links, the least fingerprint
    there, and whether the row is the one that stands for its group: the least
    by id, NULL last, then by the text's hash."""
    ship(docs.sparkSession)
    rows = stored(
        docs.select(
            F.col(id).alias("id"), F.xxhash64(text).alias("h"), fingerprint_udf(words)(F.col(text)).alias("f")
        )
    )
    first = F.struct(F.col("id").isNull().alias("nameless"), "id", "h")
    prints = stored(rows.groupBy("f").agg(F.min(first).alias("first")))
    roots = connected_groups(near_links(prints.select("f"), max_bits, blocks, tree_size))
    placed = prints.join(roots, prints["f"] == roots["node"], "left").select(
        "f", "first", F.coalesce("root", "f").alias("root")
    )
    firsts = placed.groupBy("root").agg(F.min("first").alias("first"))
    named = placed.drop("first").join(firsts, "root")
    return rows.join(named, "f").select(
        F.col("id").alias(id),
        F.col("h").alias("text_hash"),
        _hexed("f").alias("fingerprint"),
        F.col("first.id").alias("component_id"),
        _hexed("root").alias("group"),
        (F.col("id").eqNullSafe(F.col("first.id")) & (F.col("h") == F.col("first.h"))).alias("stays"),
    )


def _hexed(f: str):
    return F.lower(F.lpad(F.hex(f), 16, "0"))


def keep_one(docs: DataFrame, decided: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stand for their group in ``decided``; of rows
    that repeat id and text, one.

    Rows that go grow with the table, so the texts are shuffled for them at any
    size; only those of repeated rows, mostly none, are left to Spark's choice.
    """
    key = [F.col(id).alias("i"), F.col("text_hash").alias("h")]
    gone = decided.where(~F.col("stays")).select(*key).distinct()
    kept = decided.where("stays").groupBy(*key).agg(F.count("*").alias("n"))
    repeated = stored(kept.where(F.col("n") > 1).drop("n"))
    keyed = docs.select(F.struct(*docs.columns).alias("row"), F.col(id).alias("i"), F.xxhash64(text).alias("h"))

    def same(other: DataFrame):
        return keyed["i"].eqNullSafe(other["i"]) & (keyed["h"] == other["h"])

    out = gone.union(repeated).hint("merge")
    once = keyed.join(out, same(out), "left_anti")
    more = keyed.join(repeated, same(repeated), "left_semi").dropDuplicates(["i", "h"])
    return once.unionByName(more).select(*(F.col("row")[c].alias(c) for c in docs.columns))
