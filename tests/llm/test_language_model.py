"""The language model against a plain version with dictionaries."""

import functools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from martloom.llm import language_model
from martloom.llm.queries import QUERIES

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return ["<begin>", *re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER)), "<end>"]


def counted(texts, order):
    out = Counter()
    for text in texts:
        t = tokens(text)
        for i in range(len(t)):
            for n in range(1, min(order, i + 1) + 1):
                # The begin mark counts as context alone.
                out[tuple(t[i - n + 1 : i + 1])] += 1
    return out


def estimates(counts, t, i, order, n_tokens, v):
    p, bucket = [1 / (v + 1)], 64
    for n in range(1, order + 1):
        gram = tuple(t[i - n + 1 : i + 1]) if i >= n - 1 else None
        seen = n_tokens if n == 1 else counts[gram[:-1]] if gram else 0
        p.append(counts[gram] / seen if gram and seen else 0.0)
        if n > 1 and gram and seen:
            bucket = 64 * n + int(math.log2(seen))
    return bucket, p


def plain_model(train, held, order):
    """Counts, number of tokens and words, and weights by bucket."""
    full, kept = counted(train + held, order), counted(train, order)

    def facts(c):
        words = {g: n for g, n in c.items() if len(g) == 1 and g != ("<begin>",)}
        return sum(words.values()), len(words)

    v = facts(full)[1]
    n_kept = facts(kept)[0]
    # Equal events are counted, so that a round costs a step for each distinct one.
    events = Counter((b, tuple(p)) for t in map(tokens, held) for i in range(1, len(t)) for b, p in [estimates(kept, t, i, order, n_kept, v)])
    n_events = sum(events.values())
    weights, before = {}, -math.inf
    for b, _ in events:
        weights[b] = np.array([1 / (b // 64 + 1) if n <= b // 64 else 0.0 for n in range(order + 1)])
    start = {b: w > 0 for b, w in weights.items()}
    for _ in range(language_model.ROUNDS if events else 0):
        share, gain = {b: 0.5 * start[b] for b in weights}, 0.0
        for (b, p), times in events.items():
            parts = weights[b] * np.array(p, np.float32)
            gain += times * math.log(parts.sum())
            share[b] = share[b] + times * parts / parts.sum()
        weights = {b: s / s.sum() for b, s in share.items()}
        if gain / n_events - before < language_model.GAIN:
            break
        before = gain / n_events

    @functools.cache
    def weight(b):
        alike = [s for s in weights if s // 64 == b // 64]
        if not alike:
            return np.array([1 / (b // 64 + 1) if n <= b // 64 else 0.0 for n in range(order + 1)])
        return weights[min(alike, key=lambda s: (abs(s - b), s))]

    return full, *facts(full), weight


def held_aside(spark, ids):
    rows = spark.createDataFrame([(i,) for i in ids], "i long").select("i", F.pmod(F.xxhash64(F.col("i").cast("string")), F.lit(language_model.HELD_OUT)) == 0)
    return {r[0] for r in rows.collect() if r[1]}


def check(spark, found, docs, learnt, order):
    """``docs``: (id, text); ``learnt``: ids of training."""
    aside = held_aside(spark, [i for i, _ in docs]) & learnt
    counts, n, v, weight = plain_model([t for i, t in docs if i in learnt - aside], [t for i, t in docs if i in aside], order)
    want = []
    for i, text in docs:
        t = tokens(text)
        total = base = 0.0
        for k in range(1, len(t)):
            b, p = estimates(counts, t, k, order, n, v)
            total += math.log10(float(weight(b) @ np.array(p)))
            base += math.log10((counts[(t[k],)] + 0.5) / (n + 0.5 * (v + 1)))
        known = sum(counts[(w,)] > 0 for w in t[1:])
        want.append((i, len(t) - 1, known, n, base, total))
    got = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in found), key=repr)
    assert len(got) == len(want)
    for a, b in zip(got, sorted(want, key=repr), strict=True):
        assert a[:4] == b[:4]
        assert a[4:] == pytest.approx(b[4:], rel=1e-6, abs=1e-9)


def test_query_against_plain_version(spark, sf, documents):
    found = QUERIES["op13_language_model"](spark, sf).collect()
    learnt = {i for i in documents if zlib.crc32(str(i).encode()) % 5 != 1}
    assert all(r["held_out"] == (r["doc_id"] not in learnt) for r in found)
    check(spark, found, list(documents.items()), learnt, language_model.ORDER)
    held = [r for r in found if r["held_out"]]
    assert sum(r["score"] for r in held) > 1.02 * sum(r["base_score"] for r in held)


@pytest.mark.parametrize("order", [1, 3])
def test_other_orders_in_small_blocks_and_parts(spark, documents, order):
    docs = [(i, t) for i, t in sorted(documents.items()) if i < 120]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    found = language_model.score(table, F.col("doc_id") % 3 != 0, order=order, block=30_000, segment=7_000, per_range=100_000).collect()
    check(spark, found, docs, {i for i, _ in docs if i % 3}, order)


def test_odd_documents(spark, odd_documents, no_documents):
    found = language_model.score(odd_documents, F.lit(True), block=5_000, segment=999).collect()
    assert len(found) == odd_documents.count()
    short = {r["doc_id"]: r for r in found if r["doc_id"] in (0, 1, 2)}
    assert {(r["n_tokens"], r["n_known"]) for r in short.values()} == {(1, 1)} and len({r["score"] for r in short.values()}) == 1
    assert next(r for r in found if r["doc_id"] == 8)["n_tokens"] == 20_001
    assert sum(r["doc_id"] is None for r in found) == 3
    untrained = language_model.score(odd_documents, F.lit(None).cast("boolean")).collect()
    assert {(r["train_tokens"], r["n_known"], r["score"], r["base_score"]) for r in untrained} == {(0, 0, 0.0, 0.0)}
    assert language_model.score(no_documents, F.lit(True)).collect() == []


def test_probabilities_add_up(spark):
    """Of all words after a context, and one unknown word."""
    texts = ["a b a c", "a b", "c c b a", "b a b c a"] * 5
    base = [(i, t) for i, t in enumerate(texts)]
    context = "a b"
    asked = [(100, context), *((101 + k, f"{context} {w}") for k, w in enumerate(["a", "b", "c", "zzz"]))]
    table = spark.createDataFrame(base + asked, "doc_id long, text string")
    found = {r["doc_id"]: r for r in language_model.score(table, F.col("doc_id") < 100, order=3).collect()}
    learnt = set(range(len(texts)))
    counts, n, v, weight = plain_model(
        [t for i, t in base if i in learnt - held_aside(spark, learnt)], [t for i, t in base if i in held_aside(spark, learnt)], 3
    )

    def p(words, i):
        b, parts = estimates(counts, words, i, 3, n, v)
        return float(weight(b) @ np.array(parts))

    start = ["<begin>", "a", "b"]
    shares = [p([*start, w], 3) for w in ("a", "b", "c", "<end>", "zzz")]
    assert sum(shares) == pytest.approx(1.0)
    both = p(start, 1) * p(start, 2)
    assert 10 ** found[100]["score"] == pytest.approx(both * shares[3])
    assert 10 ** found[104]["score"] == pytest.approx(both * shares[4] * p([*start, "zzz", "<end>"], 4))


def test_packed_numbers_come_back():
    draw = np.random.default_rng(1)
    for values in (np.empty(0, np.uint64), np.array([2**64 - 1], np.uint64), draw.integers(0, 2**63, 1000).astype(np.uint64)):
        assert (language_model.unsqueeze(language_model.squeeze(values), len(values)) == values).all()
