"""Language identification by rank-order profiles (Cavnar and Trenkle, 1994).

A profile is a list of the most frequent character n-grams in order. A
document's own profile is compared with that of each language by out-of-place
distance: for each of its n-grams, how far the two ranks are apart, or the
profile's length if the language has no such n-gram.

N-grams have one to three characters. Words are runs of letters, lower-cased,
with a blank on each side; no n-gram spans a blank between two words. An
n-gram is packed into one integer, 21 bits a character, so a text is counted
by sorting integers. Equal counts are ordered by the packed value, equal
distances by language name.

Learning counts every row of the learning fold in the tasks that read it, and
only counts per (language, n-gram) are shuffled; what reaches the driver is
``profile_size`` n-grams a language.

Texts: NULL, empty and letterless ones are ``und`` with score 0. With nothing
learnt every text is. The score is the share of the greatest possible distance
that is not reached.
"""

from __future__ import annotations

import functools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.common import shared_value, ship

PROFILE_SIZE = 400
# Profiles are collected: a table with more label values than this does not
# hold languages.
MAX_LANGUAGES = 2_000
SLICE_CHARS = 262_144
# N-grams counted apart in a task, for each language, before they are merged.
HELD_GRAMS = 250_000
UNDETERMINED = "und"
_BLANK = 32
_SPACE = re.compile(r"\s")


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.array([chr(c).isalpha() for c in range(0x110000)], bool)


def normalized(text: str) -> np.ndarray:
    """Code points of the words, lower-cased, one blank between and around;
    empty if there is no letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _letters()[codes]
    if not letter.any():
        return np.empty(0, np.uint64)
    out = np.where(letter, codes, _BLANK).astype(np.uint64)
    out = np.concatenate(([_BLANK], out, [_BLANK])).astype(np.uint64)
    blank = out == _BLANK
    keep = np.ones(len(out), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    return out[keep]


def _grams(codes: np.ndarray) -> np.ndarray:
    """All packed n-grams of a stretch of normalized text."""
    a = codes[codes != _BLANK]
    two = (codes[:-1] << np.uint64(21)) | codes[1:]
    inner = codes[1:-1] != _BLANK
    three = (((codes[:-2] << np.uint64(21)) | codes[1:-1]) << np.uint64(21)) | codes[2:]
    return np.concatenate((a, two, three[inner]))


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct packed n-grams and their counts. A long text is cut at white
    space, which no n-gram spans, so that memory follows the slice and not the
    text; a stretch without white space is held whole."""
    if len(text) <= SLICE_CHARS:
        return _counts(text)
    parts, start = [], 0
    while start < len(text):
        cut = _SPACE.search(text, start + SLICE_CHARS)
        end = cut.start() if cut else len(text)
        parts.append(_counts(text[start:end]))
        start = end
        if len(parts) > 16:
            parts = [_merged(parts)]
    return _merged(parts)


def _counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """A stretch's n-grams; a long one is counted in slices that share two
    characters, and the overlap's own n-grams are taken off again."""
    codes = normalized(text)
    if len(codes) <= SLICE_CHARS:
        return np.unique(_grams(codes), return_counts=True)
    parts, signs = [], []
    for start in range(0, len(codes) - 2, SLICE_CHARS):
        parts.append(np.unique(_grams(codes[start : start + SLICE_CHARS + 2]), return_counts=True))
        signs.append(1)
        if start:
            parts.append(np.unique(_grams(codes[start : start + 2]), return_counts=True))
            signs.append(-1)
    return _merged([(g, c * s) for (g, c), s in zip(parts, signs, strict=True)])


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    grams, where = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
    counts = np.bincount(where, np.concatenate([c for _, c in parts]), len(grams)).astype(np.int64)
    return grams[counts > 0], counts[counts > 0]


def _count_batches(batches):
    """(lang, text) batches to (lang, gram, n) rows, merged as they grow."""
    held: dict[str, list] = {}
    size: dict[str, int] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1), strict=True):
            lang, text = lang.as_py(), text.as_py()
            if not text:
                continue
            part = gram_counts(text)
            held.setdefault(lang, []).append(part)
            size[lang] = size.get(lang, 0) + len(part[0])
            if size[lang] > HELD_GRAMS:
                held[lang] = [_merged(held[lang])]
                size[lang] = 0
    for lang, parts in held.items():
        grams, counts = _merged(parts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(grams), pa.string()), pa.array(grams.astype(np.int64)), pa.array(counts)],
            names=["lang", "gram", "n"],
        )


def learn_profiles(labelled: DataFrame, lang: str = "lang", text: str = "text", size: int = PROFILE_SIZE) -> DataFrame:
    """``(lang, gram, rank)``: the ``size`` most frequent n-grams of each
    language; ranks start at 0. Rows without a language or text teach nothing."""
    ship()
    rows = labelled.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    counts = (
        rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
        .mapInArrow(_count_batches, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("n"), F.asc("gram"))
    return counts.withColumn("rank", F.row_number().over(order) - 1).where(F.col("rank") < size).drop("n")


class Profiles:
    """Profiles as a matrix: a row per n-gram, a column per language."""

    def __init__(self, rows: list[tuple[str, int, int]], size: int):
        self.size = size
        self.languages = sorted({lang for lang, _, _ in rows})
        column = {lang: i for i, lang in enumerate(self.languages)}
        self.grams = np.unique(np.array([g for _, g, _ in rows], np.uint64))
        # Absent n-grams and the extra last row stand at -1.
        self.ranks = np.full((len(self.grams) + 1, len(self.languages)), -1, np.int32)
        for lang, gram, rank in rows:
            self.ranks[np.searchsorted(self.grams, np.uint64(gram)), column[lang]] = rank

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages:
            return UNDETERMINED, 0.0
        grams, counts = gram_counts(text)
        if not len(grams):
            return UNDETERMINED, 0.0
        own = grams[np.lexsort((grams, -counts))[: self.size]]
        at = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        at = np.where(self.grams[at] == own, at, len(self.grams))
        ranks = self.ranks[at]
        apart = np.abs(ranks - np.arange(len(own), dtype=np.int32)[:, None])
        distance = np.where(ranks < 0, self.size, apart).sum(axis=0)
        best = int(np.argmin(distance))
        return self.languages[best], 1.0 - float(distance[best]) / (self.size * len(own))


PREDICTION = T.StructType(
    [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
)


def fit(labelled: DataFrame, lang: str = "lang", text: str = "text", size: int = PROFILE_SIZE):
    """Learnt profiles, sent to every executor: ``size`` rows a language."""
    rows = learn_profiles(labelled, lang, text, size).limit(size * MAX_LANGUAGES + 1).collect()
    if len(rows) > size * MAX_LANGUAGES:
        raise ValueError(f"{lang} has more than {MAX_LANGUAGES} values")
    return shared_value(labelled.sparkSession, Profiles([tuple(r) for r in rows], size))


def predict_udf(profiles):
    """text -> (lang_pred, score)."""
    ship()

    @F.arrow_udf(PREDICTION)
    def predict(texts: pa.Array) -> pa.Array:
        model = profiles.value
        found = [model.predict(text.as_py()) for text in texts]
        return pa.StructArray.from_arrays(
            [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
            names=PREDICTION.names,
        )

    return predict


def identify(docs: DataFrame, profiles, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, lang_pred, score)`` of every row."""
    found = docs.select(F.col(id), predict_udf(profiles)(F.col(text)).alias("r"))
    return found.select(id, F.col("r.lang_pred"), F.col("r.score"))
