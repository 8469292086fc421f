import random
import re

import pytest
import xxhash

from martloom.llm import simhash
from martloom.llm.common import connected_groups
from martloom.llm.queries import QUERIES


def plain_fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(values, radius):
    """The least member of each value's group."""
    values = sorted(set(values))
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if (a ^ b).bit_count() <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


def expected(rows):
    """(id, fingerprint) rows to their component ids."""
    groups = plain_groups([f for _, f in rows], simhash.MAX_BITS)
    least: dict = {}
    for i, f in rows:
        if i is not None:
            least[groups[f]] = min(i, least.get(groups[f], i))
    return [(i, f"{f:016x}", least.get(groups[f])) for i, f in rows]


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else x for x in r))


def test_query_against_brute_force(spark, sf, documents):
    rows = [(i, plain_fingerprint(t)) for i, t in documents.items()]
    got = [tuple(r) for r in QUERIES["op8_simhash"](spark, sf).collect()]
    assert ordered(got) == ordered(expected(rows))


def test_odd_rows(odd_documents, no_documents):
    rows = [(r["doc_id"], plain_fingerprint(r["text"])) for r in odd_documents.collect()]
    found = simhash.near_duplicates(odd_documents)
    got = [(r["doc_id"], r["fingerprint"], r["component_id"]) for r in found.collect()]
    assert ordered(got) == ordered(expected(rows))
    assert simhash.near_duplicates(no_documents).collect() == []
    kept = simhash.keep_one(odd_documents, found)
    assert kept.count() == found.where("stays").select("doc_id", "text_hash").distinct().count()
    assert kept.columns == odd_documents.columns
    groups = {r["group"] for r in found.collect()}
    own = [f"{plain_fingerprint(r['text']):016x}" for r in kept.collect()]
    by_print = {r["fingerprint"]: r["group"] for r in found.collect()}
    assert sorted(by_print[f] for f in own) == sorted(groups)


@pytest.mark.parametrize("tree_size", [4, 4096])
def test_dense_groups_lose_no_link(spark, tree_size):
    rng = random.Random(3)
    values = {rng.getrandbits(64) for _ in range(150)}
    centre = rng.getrandbits(64)
    for _ in range(250):  # many around one, in chains of few bits
        centre ^= 1 << rng.randrange(64)
        values.add(centre)
        values.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 7))))
    values = sorted(values)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    prints = spark.createDataFrame(signed, "f long").repartition(5)
    links = simhash.near_links(prints, tree_size=tree_size)
    found = [tuple(x & 0xFFFFFFFFFFFFFFFF for x in r) for r in links.collect()]
    assert all((a ^ b).bit_count() <= simhash.MAX_BITS for a, b in found)
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in found:
        root[max(find(a), find(b))] = min(find(a), find(b))
    assert {v: find(v) for v in values} == plain_groups(values, simhash.MAX_BITS)


def test_tree_search_is_exact():
    rng = random.Random(1)
    values = [rng.getrandbits(12) for _ in range(300)]
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
    for v in range(0, 4096, 37):
        assert sorted(tree.near(v, 2)) == sorted({x for x in values if (x ^ v).bit_count() <= 2})


def test_groups_of_a_chain_a_hub_and_nothing(spark):
    chain = [(i, i + 1) for i in range(60)]
    hub = [(1000, 1000 + i) for i in range(1, 40)]
    links = spark.createDataFrame(chain + hub + [(5, 5)], "a long, b long")
    got = dict(map(tuple, connected_groups(links).collect()))
    assert got == {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(40)}
    assert connected_groups(links.where("false")).collect() == []
