"""Log-probabilities of texts under n-grams with deleted interpolation.

The probability of a token after its context mixes the maximum-likelihood
estimates of all orders and an even share for each known word and one unknown
one. The weights depend on the longest context that was seen and on how often
(in powers of two); expectation-maximisation learns them on the counts of
documents held out of training. The counts that are mixed in the end are those
of all training documents.

Tokens are the words of a text, A-Z lower-cased, and one end. A mark before the
first word is context only. Grams are known by 64-bit hashes.

How it is computed: documents go into blocks of some megabytes, stored once: the
hashes of a block's distinct words, and its tokens as numbers of them. A block
asks for each of its distinct grams once, with its own count of it, in
packed pieces by ranges of the hash. A range adds up its pieces and answers
every block in the same packed form, and a block and its answers then meet to
score its documents. So a gram costs a few bytes for each block that has it,
however often the block repeats it; no task holds more than a block or a
range. All counts are of all documents.

A text longer than ``SEGMENT`` bytes is split between words over several
blocks, each starting with the words before it, and its parts are added up. A
word is never cut.

NULL texts are empty: an end alone. NULL ids are kept; repeated rows count, and
are returned, as often as they are there. Without training documents every
token has probability 1 / (V + 1) = 1. Without held-out ones the weights stay
even. An empty table has no rows. Other columns of the table play no part.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from martloom.llm.common import ship, shared_value, stored
from martloom.sources.literals import literal_rows

ORDER = 2
# Bytes of text in a block, in a document's part, and for each range of hashes.
BLOCK = 8 << 20
SEGMENT = 4 << 20
PER_RANGE = 16 << 20
# One in so many training documents is held out to learn the weights.
HELD_OUT = 20
ROUNDS = 30
# The weights are learnt once a round gains less than this a token (base e).
GAIN = 1e-4
# Marks that are no words, an odd factor, and the lowest bits of
# a gram's hash, which hold its order.
_BEGIN, _END = b" ", b"\n"
_FACTOR = np.uint64(0x9FB21C651E98DF25)
_ORDER_BITS = np.uint64(7)
_SPACE = re.compile(rb"[\x20\x09-\x0d]")
_ANSWERS = "block long, range int, n int, counts binary, held binary, words long, tokens long, held_tokens long"


class _Numbers(dict):
    """Words in order of appearance: each new one gets the next number."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


def squeeze(values: np.ndarray) -> bytes:
    """64-bit numbers, all first bytes first: high bytes that are alike, as of
    sorted numbers' differences, take no room."""
    return pa.compress(np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes(), "zstd", asbytes=True)


def unsqueeze(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 8 * n, "zstd", asbytes=True), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(n)


def _block_type(kind: T.DataType) -> T.StructType:
    """A row for each block: for each part of a document its row, id, whether
    it is learnt from, its tokens with the words before it, how many of these
    are before it, and whether it begins the document; the sorted hashes of the
    block's words; and the tokens as numbers of those."""
    lists = (("rows", T.LongType()), ("ids", kind), ("learnt", T.BooleanType()), ("tokens", T.IntegerType()), ("before", T.IntegerType()), ("begins", T.BooleanType()))
    fields = [T.StructField("block", T.LongType()), T.StructField("held", T.BooleanType()), T.StructField("bytes", T.LongType())]
    fields += [T.StructField(name, T.ArrayType(t)) for name, t in lists]
    return T.StructType([*fields, T.StructField("n_words", T.IntegerType()), T.StructField("words", T.BinaryType()), T.StructField("numbers", T.BinaryType())])


def parts_of(text: bytes, context: int, segment: int):
    """``(words before, words, whether it is the last)`` for each part."""
    before, at = [_BEGIN], 0
    while True:
        cut = _SPACE.search(text, at + segment) if len(text) - at > segment else None
        end = cut.start() if cut else len(text)
        words = text[at:end].split()
        yield before, words, cut is None
        if cut is None:
            return
        # The mark before the first word is a word's context like any other.
        before = (before + words[-context:])[-context:]
        at = end


class _Open:
    """A block that is being filled."""

    def __init__(self):
        self.parts, self.numbers, self.known, self.bytes = [], [], _Numbers(), 0

    def add(self, row: int, id, learnt: bool, before: list[bytes], words: list[bytes], begins: bool, last: bool) -> None:
        tokens = [*before, *words, _END] if last else [*before, *words]
        self.numbers.append(np.fromiter(map(self.known.__getitem__, tokens), np.int32, len(tokens)))
        self.parts.append((row, id, learnt, len(tokens), len(before), begins))
        self.bytes += sum(map(len, words)) + len(words) + 64

    def closed(self, block: int, held: bool, schema: pa.Schema) -> pa.RecordBatch:
        hashes = np.fromiter(map(word_hash, self.known), np.uint64, len(self.known))
        words, place = np.unique(hashes, return_inverse=True)
        numbers = place[np.concatenate(self.numbers)]
        packed = (len(words), squeeze(np.diff(words, prepend=np.uint64(0))), squeeze(numbers))
        values = [block, held, self.bytes, *zip(*self.parts, strict=True), *packed]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, schema.types, strict=True)], schema=schema)


def _blocks(context: int, block: int, segment: int, schema: pa.Schema):
    """Rows (id, text, learnt, held) to blocks of documents of one kind."""

    def run(batches):
        first = TaskContext.get().partitionId() << 33
        made, row, filling = 0, 0, {False: _Open(), True: _Open()}
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for i, text, learnt, held in zip(batch.column(0).to_pylist(), texts, batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                begins = True
                for before, words, last in parts_of((text.as_py() or b"").lower(), context, segment):
                    own = filling[held]
                    own.add(first + row, i, learnt, before, words, begins, last)
                    begins = False
                    if own.bytes >= block:
                        yield own.closed(first + made, held, schema)
                        made, filling[held] = made + 1, _Open()
                row += 1
        for held, own in filling.items():
            if own.parts:
                yield own.closed(first + made, held, schema)
                made += 1

    return run


def _joined(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hashes of grams that are one word longer."""
    out = hashes * _FACTOR + words
    out = (out ^ (out >> np.uint64(29))) * _FACTOR
    return out ^ (out >> np.uint64(32))


class Grams:
    """A block's distinct grams of all orders: ``keys`` are sorted, ``counts``
    are those in training documents."""

    def __init__(self, block: dict, order: int):
        lengths = np.array(block["tokens"])
        self.before = np.array(block["before"])
        starts, size = np.cumsum(lengths) - lengths, int(lengths.sum())
        words = np.cumsum(unsqueeze(block["words"], block["n_words"]), dtype=np.uint64)
        numbers = unsqueeze(block["numbers"], size).astype(np.int64)
        place = np.arange(size) - np.repeat(starts, lengths)
        self.lengths = lengths
        self.is_token = place >= np.repeat(self.before, lengths)
        learnt = np.repeat(np.array(block["learnt"]), lengths)
        counted = learnt & self.is_token
        # The mark before a document's first word is counted as context.
        marked = counted.copy()
        begins = starts[np.array(block["begins"])]
        marked[begins] = learnt[begins]
        keys, counts, found, offset = [], [], [], 0
        hashes, gram = words, numbers
        for n in range(1, order + 1):
            if n > 1:
                # Grams are numbered by the shorter one and the word after it.
                there = place >= n - 1
                ids, known = pd.factorize(gram[:-1][there[1:]] * len(words) + numbers[1:][there[1:]])
                shorter, last = np.divmod(known, len(words))
                hashes = _joined(hashes[shorter], words[last])
                gram = np.full(size, -1)
                gram[there] = ids
            own = marked if n == 1 else counted & (gram >= 0)
            keys.append((hashes & ~_ORDER_BITS) | np.uint64(n))
            counts.append(np.bincount(gram[own], minlength=len(hashes)))
            # Where a position's gram is among all grams; below 0: it has none.
            found.append(np.where(gram >= 0, gram + offset, -1))
            offset += len(hashes)
        every = np.concatenate(keys)
        self.order = np.argsort(every, kind="stable")
        self.keys = every[self.order]
        self.counts = np.concatenate(counts)[self.order].astype(np.uint64)
        self.at = [np.empty(0, np.int64), *found]

    def placed(self, counts: np.ndarray) -> np.ndarray:
        """Counts in the order of ``keys``, put in the order of ``at``."""
        out = np.empty(len(counts), np.int64)
        out[self.order] = counts
        return out

    def estimates(self, counts: np.ndarray, tokens: int, words: int, order: int) -> tuple[np.ndarray, np.ndarray]:
        """``(bucket, probabilities)`` of each token: row n of the latter is the
        estimate of order n, row 0 the even share."""
        at = np.flatnonzero(self.is_token)
        out = np.zeros((order + 1, len(at)))
        out[0] = 1 / (words + 1)
        # Without any count the even share stands alone.
        bucket = np.full(len(at), 64 if tokens else 0)
        for n in range(1, order + 1):
            own = self.at[n][at]
            if n == 1:
                out[1] = counts[own] / max(tokens, 1)
                continue
            there = own >= 0
            seen = np.where(there, counts[self.at[n - 1][at - 1]], 0)
            usable = seen > 0
            out[n] = np.where(usable, counts[own], 0) / np.maximum(seen, 1)
            # The power of two below a count of this size is its exponent.
            bucket = np.where(usable, 64 * n - 1 + np.frexp(seen.astype(np.float64))[1], bucket)
        return bucket, out


_KEYS = pa.schema([("range", pa.int32()), ("block", pa.int64()), ("held", pa.bool_()), ("n", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])


def _asked(order: int, bits: int):
    """Blocks to their distinct grams, a packed row for each range of hashes."""

    def run(batches):
        for batch in batches:
            for block in batch.to_pylist():
                grams = Grams(block, order)
                cuts = np.searchsorted(grams.keys, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
                ends = [0, *cuts.tolist(), len(grams.keys)]
                rows = []
                for r, (a, b) in enumerate(zip(ends, ends[1:], strict=False)):
                    if a < b:
                        steps = np.diff(grams.keys[a:b], prepend=np.uint64(0))
                        rows.append((r, block["block"], block["held"], b - a, squeeze(steps), squeeze(grams.counts[a:b])))
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows, strict=True), _KEYS.types, strict=True)], schema=_KEYS)

    return run


def _summed(begin: int):
    """A range's pieces to the sums of their counts, in all and held out."""

    def run(pieces: pa.Table) -> pa.Table:
        rows = pieces.to_pylist()
        keys = [np.cumsum(unsqueeze(r["keys"], r["n"]), dtype=np.uint64) for r in rows]
        counts = [unsqueeze(r["counts"], r["n"]) for r in rows]
        known, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        del keys
        total = np.bincount(inverse, np.concatenate(counts), len(known)).astype(np.uint64)
        held = np.bincount(inverse, np.concatenate([c * np.uint64(r["held"]) for r, c in zip(rows, counts, strict=True)]), len(known)).astype(np.uint64)
        del counts
        word = ((known & _ORDER_BITS) == 1) & (known != begin)
        out: dict = {name: [] for name in ("block", "range", "n", "counts", "held", "words", "tokens", "held_tokens")}
        at = 0
        for i, r in enumerate(rows):
            own = inverse[at : at + r["n"]]
            at += r["n"]
            facts = [int((total[word] > 0).sum()), int(total[word].sum()), int(held[word].sum())] if i == 0 else [0, 0, 0]
            values = [r["block"], r["range"], r["n"], squeeze(total[own]), squeeze(held[own]) if r["held"] else None, *facts]
            for name, value in zip(out, values, strict=True):
                out[name].append(value)
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        return pa.table({name: pa.array(v, t) for (name, v), t in zip(out.items(), kinds, strict=True)})

    return run


def _answered(answers: pa.Table, held: bool) -> np.ndarray:
    """A block's counts in the order of its keys; without the held-out ones if
    ``held``."""
    rows = sorted(answers.select(["range", "n", "counts", *(["held"] if held else [])]).to_pylist(), key=lambda r: r["range"])
    parts = [unsqueeze(r["counts"], r["n"]) - (unsqueeze(r["held"], r["n"]) if held else np.uint64(0)) for r in rows]
    return np.concatenate(parts).astype(np.int64)


def _events(order: int, tokens: int, words: int):
    """A held-out block to (bucket, estimates) of its tokens."""

    def run(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        grams = Grams(blocks.to_pylist()[0], order)
        bucket, p = grams.estimates(grams.placed(_answered(answers, True)), tokens, words, order)
        return pa.table({"bucket": pa.array(bucket, pa.int32()), **{f"p{n}": pa.array(row, pa.float32()) for n, row in enumerate(p)}})

    return run


def _scored(order: int, tokens: int, words: int, weights, id_type: pa.DataType):
    """A block to the sums over its documents' tokens, a row for each part."""

    def run(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        block = blocks.to_pylist()[0]
        grams = Grams(block, order)
        counts = grams.placed(_answered(answers, False))
        bucket, p = grams.estimates(counts, tokens, words, order)
        known, inside = weights.value, np.zeros(len(bucket))
        for n, row in enumerate(p):
            inside += known[:, n][bucket] * row
        mixed = np.log10(inside)
        seen = counts[grams.at[1][grams.is_token]]
        base = np.log10((seen + 0.5) / (tokens + 0.5 * (words + 1)))
        n = grams.lengths - grams.before
        ends = np.concatenate([[0], np.cumsum(n)])

        def total(values):
            # Differences of running sums would round; a part may be empty.
            full = np.flatnonzero(n)
            out = np.zeros(len(n), values.dtype)
            if len(full):
                out[full] = np.add.reduceat(values, ends[full])
            return out

        return pa.table(
            {
                "row": pa.array(block["rows"], pa.int64()),
                "id": pa.array(block["ids"], id_type),
                "n_tokens": pa.array(n, pa.int64()),
                "n_known": pa.array(total((seen > 0).astype(np.int64)), pa.int64()),
                "base_score": pa.array(total(base)),
                "score": pa.array(total(mixed)),
            }
        )

    return run


def learnt_weights(events: DataFrame, order: int, rounds: int = ROUNDS, gain: float = GAIN) -> np.ndarray:
    """Row b: the weights of bucket b. Expectation-maximisation: a weight
    becomes its estimate's share in the probability of the held-out tokens.
    Buckets without such tokens take the weights of the nearest one that has
    the same longest context."""
    spark = events.sparkSession
    names = [f"p{n}" for n in range(order + 1)]
    start = np.zeros((64 * (order + 1), order + 1))
    for b in (0, *range(64, len(start))):
        start[b, : b // 64 + 1] = 1 / (b // 64 + 1)
    schema = T.StructType([T.StructField("b", T.IntegerType()), *(T.StructField(f"w{n}", T.DoubleType()) for n in range(order + 1))])
    weights, before, seen = start.copy(), -math.inf, []
    for _ in range(rounds):
        now = literal_rows(spark, [(b, *map(float, row)) for b, row in enumerate(weights) if b == 0 or b >= 64], schema)
        parts = [F.col(f"w{n}") * F.col(p) for n, p in enumerate(names)]
        whole = sum(parts[1:], parts[0])
        joined = events.join(F.broadcast(now), events["bucket"] == now["b"]).select("b", *(p.alias(n) for p, n in zip(parts, names, strict=True)), whole.alias("whole"))
        sums = joined.groupBy("b").agg(
            F.count("*").alias("n"), F.sum(F.log("whole")).alias("gain"), *(F.sum(F.col(n) / F.col("whole")).alias(n) for n in names)
        )
        rows = sums.collect()
        seen = [r["b"] for r in rows]
        if not rows:
            break
        for r in rows:
            # Half a token for every estimate, so that none has weight 0.
            share = np.array([r[n] for n in names]) + 0.5 * (start[r["b"]] > 0)
            weights[r["b"]] = share / share.sum()
        mean = sum(r["gain"] for r in rows) / sum(r["n"] for r in rows)
        if mean - before < gain:
            break
        before = mean
    for b in range(64, len(weights)):
        alike = [s for s in seen if s // 64 == b // 64]
        if alike and b not in alike:
            weights[b] = weights[min(alike, key=lambda s: (abs(s - b), s))]
    return weights


def score(
    docs: DataFrame,
    learnt: Column,
    id: str = "doc_id",
    text: str = "text",
    order: int = ORDER,
    block: int = BLOCK,
    segment: int = SEGMENT,
    per_range: int = PER_RANGE,
) -> DataFrame:
    """``(id, n_tokens, n_known, train_tokens, base_score, score)`` of every
    row. ``learnt`` says which rows train the model. ``score`` is the text's
    log10 probability; ``base_score`` that of single words, each count with one
    half added, and ``n_known`` how many tokens training has."""
    spark = docs.sparkSession
    ship(spark)
    kind = docs.schema[id].dataType
    aside = F.coalesce(learnt, F.lit(False)) & (F.pmod(F.xxhash64(F.col(id).cast("string")), F.lit(HELD_OUT)) == 0)
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"), F.coalesce(learnt, F.lit(False)).alias("learnt"), aside.alias("held"))
    schema = _block_type(kind)
    arrow = to_arrow_schema(schema)
    blocks = stored(rows.mapInArrow(_blocks(max(order - 1, 1), block, segment, arrow), schema))
    size = blocks.agg(F.sum("bytes")).first()[0] or 0
    bits = max(1, math.ceil(math.log2(max(1, size * order / per_range))))
    begin = int((np.uint64(word_hash(_BEGIN)) & ~_ORDER_BITS) | np.uint64(1))
    asked = blocks.drop("rows", "ids").mapInArrow(_asked(order, bits), "range int, block long, held boolean, n int, keys binary, counts binary")
    answers = stored(asked.groupBy("range").applyInArrow(_summed(begin), _ANSWERS))
    facts = answers.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("words", "tokens", "held_tokens"))).first()
    words, tokens, kept = facts["words"], facts["tokens"], facts["tokens"] - facts["held_tokens"]
    fields = ", ".join(["bucket int", *(f"p{n} float" for n in range(order + 1))])
    held = blocks.where("held").groupBy("block").cogroup(answers.where("held is not null").groupBy("block"))
    events = stored(held.applyInArrow(_events(order, kept, words), fields))
    weights = shared_value(spark, learnt_weights(events, order))
    out = T.StructType(
        [
            T.StructField("row", T.LongType()),
            T.StructField("id", kind),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("n_known", T.LongType()),
            T.StructField("base_score", T.DoubleType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
    met = blocks.groupBy("block").cogroup(answers.select("block", "range", "n", "counts").groupBy("block"))
    parts = met.applyInArrow(_scored(order, tokens, words, weights, arrow.field("ids").type.value_type), out)
    whole = parts.groupBy("row").agg(F.first("id").alias("id"), *(F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")))
    return whole.select(F.col("id").alias(id), "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")
