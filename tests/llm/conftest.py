import pytest


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from martloom.llm.common import ship

    ship(spark)


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def documents(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] for r in rows}


# Columns whose names the operators use themselves.
CLASHING = "score double, n_words long, component_id string, f long, id string, h long, items string, group string, r int"


@pytest.fixture(scope="session")
def odd_documents(spark):
    """NULLs, empty, repeated, tied and long rows, with clashing columns."""
    texts = [
        None, "", "   \n\t ", "one", "One two three four.", "one two three four.", "é ü 日本", "x" * 50_000,
        "word " * 20_000, "12345 !!! ???", " lone separators ", "same text here and there again", "same text here and there again",
    ]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "one"), (3, "one"), (None, "no id"), (None, None), (None, "no id")]
    extra = (1.5, 7, "c", 3, "i", 4, "t", "g", 5)
    return spark.createDataFrame([(*r, *extra) for r in rows], f"doc_id long, text string, {CLASHING}")


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.where("false")
