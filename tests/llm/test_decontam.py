import hashlib
import re

from martloom.llm import decontam
from martloom.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, window=13):
    """(n_words, n_hit, items) of each document."""
    windows: dict = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(None if item is None else str(item))
    sizes = {len(k) for k in windows}
    out = []
    for text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                key = tuple(w[i : i + n])
                if key in windows:
                    hit.update(range(i, i + n))
                    found |= windows[key]
        out.append((len(w), len(hit), sorted(found - {None})))
    return out


def test_query_against_brute_force(spark, sf, documents):
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    got = {r["doc_id"]: r for r in QUERIES["op9_decontamination"](spark, sf).collect()}
    contaminated = 0
    for (doc_id, _), (n, hit, found) in zip(documents.items(), plain(documents.values(), items), strict=True):
        r = got[doc_id]
        assert (r["n_words"], r["n_hit"], r["n_items"]) == (n, hit, len(found))
        assert r["items_sha256"] == hashlib.sha256(",".join(found).encode()).hexdigest()
        assert r["contaminated"] == (hit > 0 and 20 * hit >= n)
        contaminated += r["contaminated"]
    assert contaminated > 0 and len(got) == len(documents)


def small_case(spark):
    long = " ".join(f"w{i}" for i in range(30))
    items = [
        (1, long), (2, "Short one"), (3, "x"), (4, None), (5, ""), (None, "no name here"), (6, long), (2, "Short one"),
        (7, "a a a a a a a a a a a a a a a"), (8, "é ü-ß 12"),
    ]
    docs = [
        (1, long.upper()), (2, f"begin {long[4:]} end"), (3, "a " * 40), (4, "SHORT-one, short one"), (5, None), (6, ""),
        (7, "x"), (8, "no  name\nhere x"), (9, "É ü ß 12"), (9, "é ü ß 12"), (9, "é ü ß 12"), (10, " ".join(f"w{i}" for i in range(12))),
        (None, long), (None, None), (11, f"{long} {long} x"), (12, "y " * 3000 + long),
    ]
    docs = spark.createDataFrame([(*d, 1, "z") for d in docs], "doc_id long, text string, k1 int, items string")
    return docs, spark.createDataFrame(items, "item_id long, text string")


def test_small_cases(spark, monkeypatch):
    docs, items = small_case(spark)
    source = docs.collect()
    want = plain([r["text"] for r in source], [tuple(r) for r in items.collect()])
    found = decontam.find(docs, items)
    got = [(r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in found.collect()]
    assert sorted(got, key=repr) == sorted([(s["doc_id"], *w) for s, w in zip(source, want, strict=True)], key=repr)
    kept = decontam.without_contaminated(docs, found)
    clean = [s for s, (n, hit, _) in zip(source, want, strict=True) if not (hit and 20 * hit >= n)]
    assert sorted(kept.collect(), key=repr) == sorted(clean, key=repr)
    for bits in (3, 10):  # a filter that lets nearly everything pass
        monkeypatch.setattr(decontam, "_LEAST_BITS", bits)
        monkeypatch.setattr(decontam, "_MOST_BITS", bits)
        again = decontam.find(docs, items)
        assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in again.collect()), key=repr) == sorted(got, key=repr)


def test_empty_tables(spark):
    docs, items = small_case(spark)
    assert decontam.find(docs.where("false"), items).collect() == []
    none = decontam.find(docs, items.where("false")).collect()
    assert len(none) == docs.count() and {r["n_hit"] for r in none} == {0}


def test_words_lie_in_one_text():
    scan = decontam.Words([b"ab cd", b"", b"ef", b" gh ij "])
    assert scan.words(0, 5) == ["ab", "cd", "ef", "gh", "ij"]
    assert [scan.text_of(i) for i in range(5)] == [0, 0, 2, 3, 3]
    assert scan.shingles(2)[0].tolist() == [0, 3]
    alone = decontam.Words([b"gh ij"])
    assert scan.shingles(2)[1][1] == alone.shingles(2)[1][0]
