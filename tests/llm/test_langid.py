import zlib
from collections import Counter

import numpy as np
import pytest

from martloom.llm import langid
from martloom.llm.queries import QUERIES


def plain_counts(text):
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    found = Counter()
    for w in words:
        padded = f" {w} "
        found.update(c for c in w)
        for n in (2, 3):
            found.update(padded[i : i + n] for i in range(len(padded) - n + 1))
    # Words share the blank between them: "a b" has "a " and " b" once each.
    return found


def unpacked(gram):
    out = ""
    while gram:
        out, gram = chr(gram & 0x1FFFFF) + out, gram >> 21
    return out


@pytest.mark.parametrize("text", ["a b", "Ünï cödé, ÄB-ab 12 x!", "one  two\nthree", "x" * 50, "日本 語"])
def test_counts_against_plain_ones(text):
    grams, counts = langid.gram_counts(text)
    assert {unpacked(int(g)): int(c) for g, c in zip(grams, counts, strict=True)} == dict(plain_counts(text))


def test_slices_count_as_the_whole(monkeypatch):
    text = "the quick brown fox, jumps over — the lazy dog " * 40
    whole = langid.gram_counts(text)
    for size in (3, 7, 64):
        monkeypatch.setattr(langid, "SLICE_CHARS", size)
        cut = langid.gram_counts(text)
        assert np.array_equal(whole[0], cut[0]) and np.array_equal(whole[1], cut[1])


def plain_predictions(rows):
    """(lang, score) by id, learnt from the rows (doc_id, text, lang)."""
    counts: dict = {}
    for r in rows:
        if r["lang"] and r["text"] and zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1:
            counts.setdefault(r["lang"], Counter()).update(plain_counts(r["text"]))

    def packed(gram):
        value = 0
        for c in gram:
            value = value << 21 | ord(c)
        return value

    def order(found):
        return sorted(found, key=lambda g: (-found[g], packed(g)))[: langid.PROFILE_SIZE]

    profiles = {lang: {g: i for i, g in enumerate(order(c))} for lang, c in counts.items()}
    far = langid.PROFILE_SIZE
    out = {}
    for r in rows:
        own = order(plain_counts(r["text"] or ""))
        distance = {
            lang: sum(abs(p[g] - i) if g in p else far for i, g in enumerate(own)) for lang, p in profiles.items()
        }
        best = min(sorted(distance), key=distance.get)
        out[r["doc_id"]] = (best, 1 - distance[best] / (far * len(own))) if own else ("und", 0.0)
    return out


def test_profiles_and_predictions_against_plain_ones(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = {r["doc_id"]: r for r in QUERIES["op6_language_id"](spark, sf).collect()}
    assert len(got) == len(rows)
    for doc_id, (lang, score) in plain_predictions(rows).items():
        assert got[doc_id]["held_out"] == (zlib.crc32(str(doc_id).encode()) % 3 == 1)
        assert got[doc_id]["lang_pred"] == lang
        assert got[doc_id]["score"] == pytest.approx(score)
    held = [r for r in rows if got[r["doc_id"]]["held_out"] and r["lang"]]
    right = sum(got[r["doc_id"]]["lang_pred"] == r["lang"] for r in held)
    assert right / len(held) > 0.98


def test_odd_rows(spark, odd_documents, no_documents):
    labelled = odd_documents.selectExpr("text", "CASE WHEN doc_id % 2 = 0 THEN 'l1' WHEN doc_id % 3 = 0 THEN 'l2' END AS lang")
    profiles = langid.fit(labelled)
    rows = langid.identify(odd_documents, profiles).collect()
    assert len(rows) == odd_documents.count()
    undetermined = {None, "", "   \n\t ", "12345 !!! ???"}
    by_id = {r["doc_id"]: r for r in rows}
    for r in odd_documents.where("doc_id IS NOT NULL").collect():
        assert (by_id[r["doc_id"]]["lang_pred"] == "und") == (r["text"] in undetermined)
        assert 0 <= by_id[r["doc_id"]]["score"] <= 1
    nothing = langid.fit(labelled.where("false"))
    assert {r["lang_pred"] for r in langid.identify(odd_documents, nothing).collect()} == {"und"}
    assert langid.identify(no_documents, profiles).collect() == []


def test_too_many_labels_are_refused(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 1)
    rows = spark.createDataFrame([("a", "abc def"), ("b", "xyz uvw")], "lang string, text string")
    with pytest.raises(ValueError, match="values"):
        langid.fit(rows, size=3)
