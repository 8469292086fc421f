"""Benchmark decontamination by a prefix-filtered set join.

A window is ``window`` consecutive words of an item, or the whole item if it
has fewer. A document is joined with the windows that occur in it word for
word, and its words inside an occurrence are hit.

As a window must be contained whole, one of its shingles is a sufficient
prefix. So:

1. the item shingles are counted over all documents, which orders them by
   rarity (ties by hash);
2. a window's prefix is its rarest shingle, kept with its offset;
3. documents look up their shingles among the prefixes, and only those found
   become rows, each with the words around it;
4. the join on the prefix aligns window and document by the offset, applies
   the bounds (the window must begin and end within the document) and compares
   the words themselves.

Both look-ups in the documents go through a bitmap of ``BITS_PER_HASH`` bits
for each of the hashes, up to a bound; it lets a few others pass, which the
join removes. Only narrow rows are shuffled, no text: windows go by a key, and
the ids of items are looked up for a document's distinct windows at the end. A passage in very many documents is many rows of one
prefix on the documents' side, which adaptive execution can split; windows of
one prefix sit in one row.

Texts: NULL and empty ones have no words; items without words have no windows.
Repeated rows each get the result. Items that repeat an id count once, items
with a NULL id hit words but are in no list.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.common import shared_value, ship, stored

WINDOW = 13
SHINGLE = 3
# A bitmap has some of 64 bits set; it holds 2 ** 20 to 2 ** 31 bits, 256 MB.
BITS_PER_HASH = 64
_LEAST_BITS, _MOST_BITS = 20, 31
# Texts scanned together, in bytes; memory is some 40 times that.
_SCAN_BYTES = 1 << 20
# Which bytes of UTF-8 belong to a word, and A-Z in lower case.
_IN_WORD = np.ones(256, bool)
_IN_WORD[[*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
# An odd base, its inverse modulo 2 ** 64, and a final mix.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _mixed(codes: np.ndarray) -> np.ndarray:
    codes = (codes ^ (codes >> np.uint64(31))) * _MIX
    return codes ^ (codes >> np.uint64(29))


class Words:
    """The words of some texts: where they are, whose they are, a 64-bit hash.

    A word's hash comes from a running sum of bytes times powers of a base, so
    all words of all texts are hashed in a few passes over the bytes.
    """

    _up = _powers(_BASE, 1)
    _down = _powers(_INVERSE, 1)

    def __init__(self, texts: list[bytes]):
        self.data = _LOWER[np.frombuffer(b"".join(texts), np.uint8)]
        n = len(self.data)
        # Each text's first byte and one past the last text's end.
        edges = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
        inside = _IN_WORD[self.data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        stops = inside.copy()
        stops[:-1] &= ~inside[1:]
        # Texts lie side by side, so a text's edge always ends a word.
        cuts = edges[(edges > 0) & (edges < n)]
        begins[cuts] |= inside[cuts]
        stops[cuts - 1] |= inside[cuts - 1]
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        if len(Words._up) <= n:
            Words._up, Words._down = _powers(_BASE, n + 1), _powers(_INVERSE, n + 1)
        sums = np.zeros(n + 1, np.uint64)
        # One more than the byte, so that no byte counts as nothing.
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * Words._up[:n], out=sums[1:])
        codes = (sums[self.ends] - sums[self.starts]) * Words._down[self.starts]
        self.codes = _mixed(codes + (self.ends - self.starts).astype(np.uint64))
        # Word numbers at which texts begin, and one past the last word.
        self.first = np.searchsorted(self.starts, edges)

    def words(self, start: int, stop: int) -> list[str]:
        return [
            self.data[i:j].tobytes().decode()
            for i, j in zip(self.starts[start:stop].tolist(), self.ends[start:stop].tolist(), strict=True)
        ]

    def text_of(self, word: np.ndarray) -> np.ndarray:
        """Which text a word belongs to; texts without words are passed over."""
        return np.searchsorted(self.first, word, side="right") - 1

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The first word and the hash of each run of ``size`` words that lies
        in one text."""
        n = len(self.codes) - size + 1
        if n <= 0:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        out = np.full(n, size, np.uint64)
        for i in range(size):
            out = out * np.uint64(_BASE) + self.codes[i : i + n]
        whole = np.ones(n, bool)
        for back in range(1, size):
            cut = self.first - back
            whole[cut[(cut >= 0) & (cut < n)]] = False
        at = np.flatnonzero(whole)
        return at, _mixed(out[at])


def _scans(texts: pa.Array):
    """The texts of a batch as ``Words`` of bounded size, with the number of
    the first; a longer text comes alone."""
    held, size, first = [], 0, 0
    for i, text in enumerate(texts):
        data = (text.as_py() or "").encode()
        if held and size + len(data) > _SCAN_BYTES:
            yield first, Words(held)
            held, size, first = [], 0, i
        held.append(data)
        size += len(data)
    if held:
        yield first, Words(held)


def _windows(window: int, shingle: int):
    """(item, text) rows to windows with the hashes of their shingles."""

    def run(batches):
        for batch in batches:
            out = {"item": [], "words": [], "n": [], "shingles": []}
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                scan = Words([(text.as_py() or "").encode()])
                words = scan.words(0, len(scan.codes))
                if not words:
                    continue
                n = min(window, len(words))
                size = min(shingle, n)
                hashes = scan.shingles(size)[1].view(np.int64)
                for start in range(len(words) - n + 1):
                    out["item"].append(item)
                    out["words"].append(" ".join(words[start : start + n]))
                    out["n"].append(n)
                    out["shingles"].append(hashes[start : start + n - size + 1].tolist())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(out["item"], pa.string()),
                    pa.array(out["words"], pa.string()),
                    pa.array(out["n"], pa.int32()),
                    pa.array(out["shingles"], pa.list_(pa.int64())),
                ],
                names=list(out),
            )

    return run


class Filter:
    """A bitmap over the leading bits of hashes, and the shingle sizes."""

    def __init__(self, bits: int, sizes: list[int], parts: list[tuple[int, bytes]]):
        self.bits, self.sizes = bits, sizes
        self.bitmap = np.zeros(max(1, (1 << bits) // 8), np.uint8)
        for bucket, part in parts:
            at = (bucket - 1) * len(part)
            piece = np.frombuffer(part, np.uint8)[: len(self.bitmap) - at]
            self.bitmap[at : at + len(piece)] = piece

    def passes(self, hashes: np.ndarray) -> np.ndarray:
        slot = hashes >> np.uint64(64 - self.bits)
        return (self.bitmap[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1


def build_filter(hashes: DataFrame, sizes: list[int]):
    """A filter of the ``h`` column, made in the executors in pieces of fixed
    size and sent back to them: as large as the number of hashes asks for, up
    to 2 ** ``_MOST_BITS`` bits."""
    n = hashes.agg(F.approx_count_distinct("h")).first()[0]
    bits = min(_MOST_BITS, max(_LEAST_BITS, math.ceil(math.log2(BITS_PER_HASH * max(n, 1)))))
    slot = F.shiftrightunsigned("h", 64 - bits) + 1
    parts = (
        hashes.groupBy(F.bitmap_bucket_number(slot).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("part"))
        .collect()
    )
    rows = [(row["bucket"], bytes(row["part"])) for row in parts]
    return shared_value(hashes.sparkSession, Filter(bits, sizes, rows))


def _frequencies(filter_value):
    """Texts to (h, n): in how many of the task's documents a shingle is."""

    def run(batches):
        known = filter_value.value
        seen: list[np.ndarray] = []
        held = 0

        def counted():
            grams, counts = np.unique(np.concatenate(seen), return_counts=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(grams.view(np.int64)), pa.array(counts.astype(np.int64))], names=["h", "n"]
            )

        for batch in batches:
            for _, scan in _scans(batch.column(0)):
                for size in known.sizes:
                    at, hashes = scan.shingles(size)
                    found = known.passes(hashes)
                    once = np.unique(np.stack((scan.text_of(at[found]).astype(np.uint64), hashes[found])), axis=1)[1]
                    seen.append(once)
                    held += len(once)
            if held > 2_000_000:
                yield counted()
                seen, held = [], 0
        if held:
            yield counted()

    return run


def _candidates(filter_value, window: int):
    """Rows (id, k1, k2, text) to (id, k1, k2, n_words, found): each shingle
    that passes, with the words a window around it may have."""

    def run(batches):
        known = filter_value.value
        found_type = pa.struct(
            [("h", pa.int64()), ("pos", pa.int32()), ("first", pa.int32()), ("words", pa.list_(pa.string()))]
        )
        for batch in batches:
            n_words = np.zeros(batch.num_rows, np.int64)
            found = [[] for _ in range(batch.num_rows)]
            for row, scan in _scans(batch.column(3)):
                sizes = np.diff(scan.first)
                n_words[row : row + len(sizes)] = sizes
                for size in known.sizes:
                    at, hashes = scan.shingles(size)
                    passed = known.passes(hashes)
                    at, hashes = at[passed], hashes[passed]
                    for pos, text, h in zip(at.tolist(), scan.text_of(at).tolist(), hashes.view(np.int64).tolist(), strict=True):
                        begin, end = int(scan.first[text]), int(scan.first[text + 1])
                        first = max(begin, pos - window + size)
                        around = scan.words(first, min(end, pos + window))
                        found[row + text].append({"h": h, "pos": pos - begin, "first": first - begin, "words": around})
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(n_words), pa.array(found, pa.list_(found_type))],
                names=["id", "k1", "k2", "n_words", "found"],
            )

    return run


def row_keys(id: str, text: str) -> tuple[Column, Column]:
    """Two hashes that stand for a row's id and text, 96 bits together. Rows
    equal in both get equal results, so they need not be told apart."""
    return F.xxhash64(id, text).alias("k1"), F.hash(id, text).alias("k2")


_SCANNED = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField(
            "found",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("h", T.LongType()),
                        T.StructField("pos", T.IntegerType()),
                        T.StructField("first", T.IntegerType()),
                        T.StructField("words", T.ArrayType(T.StringType())),
                    ]
                )
            ),
        ),
    ]
)

# The windows of a prefix that occur around a candidate.
_VERIFIED = """
  transform(
    filter(windows, w -> c.pos >= w.offset AND c.pos - w.offset + w.n <= n_words
      AND array_join(slice(c.words, c.pos - w.offset - c.first + 1, w.n), ' ') = w.words),
    w -> struct(c.pos - w.offset AS start, c.pos - w.offset + w.n AS end, w.w AS w))
"""

# How many words sorted intervals cover together.
_COVERED = """
  aggregate(hits, struct(0L AS covered, 0L AS upto),
    (a, x) -> struct(
      a.covered + greatest(0L, x.end - greatest(CAST(x.start AS BIGINT), a.upto)) AS covered,
      greatest(a.upto, CAST(x.end AS BIGINT)) AS upto),
    a -> a.covered)
"""


def _prefixes(items: DataFrame, texts: DataFrame, window: int, shingle: int, item_id: str, item_text: str):
    """``(h, windows)``, for each prefix shingle the windows it stands for;
    ``(w, item)``, the items that have a window; and the sizes of shingles."""
    # A window is known by 96 bits of its words.
    key = F.struct(F.xxhash64("words").alias("a"), F.hash("words").alias("b")).alias("w")
    cut = stored(
        items.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).alias("text"))
        .mapInArrow(_windows(window, shingle), "item string, words string, n int, shingles array<long>")
        .select("*", key)
    )
    owners = stored(cut.where(F.col("item").isNotNull()).select("w", "item").distinct())
    windows = stored(cut.groupBy("w").agg(*(F.first(c).alias(c) for c in ("words", "n", "shingles"))))
    # At most ``shingle`` different sizes.
    sizes = sorted(r[0] for r in windows.select(F.least("n", F.lit(shingle))).distinct().collect())
    shingles = windows.select("w", F.posexplode("shingles").alias("offset", "h"))
    counts = (
        texts.mapInArrow(_frequencies(build_filter(shingles.select("h"), sizes)), "h long, n long")
        .groupBy("h")
        .agg(F.sum("n").alias("seen"))
    )
    rarest = (
        shingles.join(counts, "h", "left")
        .groupBy("w")
        .agg(F.min(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "h", "offset")).alias("least"))
        .select("w", "least.h", "least.offset")
    )
    prefixes = stored(
        windows.drop("shingles")
        .join(rarest, "w")
        .groupBy("h")
        .agg(F.collect_list(F.struct("words", "n", "offset", "w")).alias("windows"))
    )
    return prefixes, owners, sizes


def find(
    docs: DataFrame,
    items: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
) -> DataFrame:
    """``(id, k1, k2, n_words, n_hit, items)`` of every row: how many words
    are hit, and the sorted ids of items with windows that occur."""
    ship()
    prefixes, owners, sizes = _prefixes(items, docs.select(text), window, shingle, item_id, item_text)
    look_up = build_filter(prefixes.select("h"), sizes)
    keyed = docs.select(F.col(id).alias("id"), *row_keys(id, text), F.col(text).alias("text"))
    schema = T.StructType([*keyed.drop("text").schema.fields, *_SCANNED.fields])
    scanned = stored(keyed.mapInArrow(_candidates(look_up, window), schema))
    hits = stored(
        scanned.where(F.size("found") > 0)
        .dropDuplicates(["k1", "k2"])
        .select("k1", "k2", "n_words", F.explode("found").alias("c"))
        .join(prefixes, F.col("c.h") == prefixes["h"])
        .select("k1", "k2", F.expr(_VERIFIED).alias("hits"))
        .where(F.size("hits") > 0)
        .groupBy("k1", "k2")
        .agg(F.array_sort(F.flatten(F.collect_list("hits"))).alias("hits"))
        .select("k1", "k2", F.expr(_COVERED).alias("n_hit"), F.array_distinct(F.col("hits.w")).alias("windows"))
    )
    listed = (
        hits.select("k1", "k2", F.explode("windows").alias("w"))
        .join(owners, "w")
        .groupBy("k1", "k2")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    hits = hits.drop("windows").join(listed, ["k1", "k2"], "left")
    return (
        scanned.drop("found")
        .join(hits, ["k1", "k2"], "left")
        .select(
            F.col("id").alias(id),
            "k1",
            "k2",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )


def is_contaminated(share: int = 20):
    """Whether a row of ``find`` has hit words, at least one in ``share``."""
    return (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))


def without_contaminated(docs: DataFrame, found: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``found`` does not call contaminated. Their
    keys are stored first, so that Spark knows how many there are and shuffles
    the texts only if they are not few."""
    bad = stored(found.where(is_contaminated()).select("k1", "k2").distinct())
    keyed = docs.select(F.struct(*docs.columns).alias("row"), *row_keys(id, text))
    return keyed.join(bad, ["k1", "k2"], "left_anti").select(*(F.col("row")[c].alias(c) for c in docs.columns))
