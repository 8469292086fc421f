import hashlib
import re
import statistics
import zlib

import public_tokenizers as P
from pyspark.sql import functions as F
from test_bpe import PLAIN
from test_decontam import plain as contamination
from test_langid import plain_predictions
from test_simhash import expected, plain_fingerprint

import corpus_pipeline
from martloom.llm import stages


def plain_run(spark, sf):
    """The documents that stay, and how many each stage was given."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    given = [len(docs)]
    languages = plain_predictions(docs)
    learnt = [r for r in docs if zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1 and r["lang"] is not None]
    scores = [languages[r["doc_id"]][1] for r in learnt if languages[r["doc_id"]][0] != "und"]
    least = statistics.fmean(scores) - stages.DEVIATIONS * statistics.pstdev(scores)
    docs = [r for r in docs if languages[r["doc_id"]][0] != "und" and languages[r["doc_id"]][1] >= least]
    given.append(len(docs))
    groups = {i: c for i, _, c in expected([(r["doc_id"], plain_fingerprint(r["text"])) for r in docs])}
    docs = [r for r in docs if groups[r["doc_id"]] == r["doc_id"]]
    given.append(len(docs))
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    hits = contamination([r["text"] for r in docs], items)
    docs = [r for r, (n, hit, _) in zip(docs, hits, strict=True) if not (hit and 20 * hit >= n)]
    return docs, [*given, len(docs)]


def test_run_against_plain_version(spark, sf):
    docs, given = plain_run(spark, sf)
    assert given[1] >= 0.99 * given[0] and given[2] < given[1] and given[3] < given[2]
    source = spark.createDataFrame(docs, spark.read.parquet(f"{sf}/documents.parquet").schema)
    clean = stages.pii_pseudonyms(spark, source, sf)
    assert clean.columns == source.columns
    want = set()
    for r in clean.collect():
        ids = PLAIN.encode_ordinary(r["text"])
        assert r["n_chars"] == len(r["text"]) or r["text"] == next(d["text"] for d in docs if d["doc_id"] == r["doc_id"])
        data = b"".join(i.to_bytes(4, "little") for i in ids)
        want.add((r["doc_id"], len(ids), hashlib.sha256(data).hexdigest(), hashlib.sha256(r["text"].encode()).hexdigest()))
    got = [tuple(r) for r in corpus_pipeline.run(spark, sf).collect()]
    assert len(got) == len(want) and set(got) == want


def test_stages_take_odd_rows(spark, sf, odd_documents, no_documents):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "simhash_near_dedup", "decontamination", "pii_pseudonyms", "byte_bpe"]
    assert re.match("'s", P.PATTERN)
    for table in (odd_documents, no_documents):
        table = table.selectExpr("*", "CASE WHEN text LIKE '%e%' THEN 'en' END AS lang", "CAST(length(text) AS BIGINT) AS n_chars")
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, table, sf)
            if name != "byte_bpe":
                assert out.columns == table.columns
            rows = out.collect()
            assert len(rows) <= table.count()
        assert table.count() > 0 or rows == []


def test_texts_of_other_languages_go(spark, sf, documents):
    source = spark.read.parquet(f"{sf}/documents.parquet")
    other = {
        -1: "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
        -2: "Minden emberi lény szabadon születik és egyenlő méltósága és joga van.",
        -3: "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw.",
        -4: "xqzj wvkq zzpx qqjf bvxw zkjq pqxv wjzz",
        -5: "12345 --- 67",
    }
    strange = spark.createDataFrame([(i, t, None, "x", len(t)) for i, t in other.items()], source.schema)
    kept = {r["doc_id"] for r in stages.language_id(spark, source.unionByName(strange), sf).collect()}
    lettered = {i for i, t in documents.items() if any(c.isalpha() for c in t or "")}
    assert not kept & set(other) and len(kept) >= 0.999 * len(lettered)


def test_a_long_dotted_name_passes_the_stages(spark, sf):
    table = spark.read.parquet(f"{sf}/documents.parquet").limit(200)
    long = [(-1, "the and of a@" + "x." * 50_000 + "com and the of", "en", "x", 5), (-2, "the of and " + "1." * 50_000, "en", "x", 5)]
    out = spark.createDataFrame(long, table.schema)
    assert stages.pii_pseudonyms(spark, table.unionByName(out), sf).count() == 202


def test_least_score_comes_from_all_rows_learnt_from(spark, sf):
    """One English text in twenty is of another kind; all of those hash to the
    upper tenth, which a sample below a hash would leave out."""
    usual = "the cat and the dog sat on the mat and the cat saw the dog"
    other = "quick jumps vex fjord waltz nymphs; sphinx of black quartz"
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    ids = spark.range(20_000).where("crc32(CAST(id AS STRING)) % 3 != 1")
    upper = F.pmod(F.xxhash64("id", F.lit(other)), F.lit(1 << 20)) >= int(0.9 * (1 << 20))
    rest = [r["id"] for r in ids.where(upper).limit(300).collect()]
    rows = [(r["id"], usual) for r in ids.where(~upper).limit(5_700).collect()] + [(i, other) for i in rest]
    table = spark.createDataFrame([(i, t, "en", "x", len(t)) for i, t in rows], schema)
    kept = {r["doc_id"] for r in stages.language_id(spark, table, sf).collect()}
    assert len(rest) == 300 and kept == {i for i, _ in rows}
