"""Toxicity by multiple-instance learning.

Only documents carry labels. A sentence's score is logistic in the
words it has and their beginnings and endings; a
document is toxic if some sentence is, so its score combines those of its
sentences by noisy-or, 1 - (1 - leak) * product of (1 - sentence score). The
leak stands for labels that no sentence explains. Weights, bias and leak are
trained on the documents' likelihood, and the sentence scores then say where
the offence is.

Training takes a sample of at most ``SAMPLE`` labelled documents, chosen by a
hash of the id, and whole texts of them. Features count that occur in
at least ``MIN_DOCS`` of these. Texts are split and features screened in the
executors; the driver gets the features that are left and where they stand, no
texts. All rows are scored by whole text.

Texts: NULL and empty ones have no sentences and score the leak. Without
labelled rows of both kinds nothing can be learnt and every score is the share
of toxic labels, or 0 without any. Repeated rows get a row each.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.common import shared_value, ship, stored

SAMPLE = 4_000
MIN_DOCS = 3
ROUNDS = 120
AFFIX_CHARS = range(3, 8)
REMEMBERED = 500_000
RATE = 0.5
PENALTY = 0.3
# Standard errors that a feature's log odds must be above 0. It starts with
# them: from zero weights, sentence scores near 0 would pass no gradient on.
SIGNIFICANT = 3.0
_SENTENCE_END = re.compile(r"[.!?]+\s+|\n+")
_WORD = re.compile(r"\w+")


def sentences(text: str | None) -> list[str]:
    return [s for s in _SENTENCE_END.split(text or "") if s.strip()]


def features(word: str) -> list[str]:
    """The word, its beginnings and its endings: inflected or compounded forms
    of an offensive stem share those."""
    parts = [f"={word}"]
    for n in AFFIX_CHARS:
        if n < len(word):
            parts += [f"<{word[:n]}", f">{word[-n:]}"]
    return parts


def words(sentence: str) -> set[str]:
    return set(_WORD.findall(sentence.lower()))


class Model:
    """Feature weights, bias and leak."""

    def __init__(self, weights: dict[str, float], bias: float, leak: float):
        self.weights, self.bias, self.leak = weights, bias, leak
        self._known: dict[str, tuple[str, ...]] = {}

    def __reduce__(self):
        return Model, (self.weights, self.bias, self.leak)

    def _weighted(self, word: str) -> tuple[str, ...]:
        """The word's features that have a weight; mostly none. Remembered for
        a bounded number of words."""
        found = self._known.get(word)
        if found is None:
            if len(self._known) >= REMEMBERED:
                self._known.clear()
            found = self._known[word] = tuple(f for f in features(word) if f in self.weights)
        return found

    def sentence_scores(self, text: str | None) -> list[float]:
        sums = []
        for sentence in sentences(text):
            found = {f for w in words(sentence) for f in self._weighted(w)}
            # In a fixed order, so that equal sentences have equal sums.
            sums.append(self.bias + sum(self.weights[f] for f in sorted(found)))
        return (1 / (1 + np.exp(-np.clip(sums, -40, 40)))).tolist()

    def document_score(self, scores: list[float]) -> float:
        return 1 - (1 - self.leak) * float(np.prod([1 - s for s in scores]))


def document_features(text: str | None) -> set[str]:
    return {f for w in set().union(*map(words, sentences(text))) for f in features(w)}


def screened(counts: list[tuple[str, int, int]], clean: int, toxic: int) -> dict[str, float]:
    """Features that stand in toxic documents significantly more often, with
    their log odds, from ``(feature, clean, toxic documents with it)``. Others
    could only fit the sample's noise."""
    with_it = np.array([[n0, n1] for _, n0, n1 in counts], float).reshape(-1, 2).T + 0.5
    without = np.array([[clean + 1], [toxic + 1]]) - with_it
    odds = np.log(with_it[1] / without[1]) - np.log(with_it[0] / without[0])
    error = np.sqrt((1 / with_it + 1 / without).sum(axis=0))
    return {counts[i][0]: float(odds[i]) for i in np.flatnonzero(odds > SIGNIFICANT * error)}


def placed(text: str | None, place: dict[str, int]) -> tuple[int, list[list[int]]]:
    """The number of sentences, and the screened features of those that have
    any."""
    own = sentences(text)
    found = ({place[f] for w in words(s) for f in features(w) if f in place} for s in own)
    return len(own), [sorted(ids) for ids in found if ids]


def log_likelihood(params: np.ndarray, feature, of_sentence, of_doc, bare, y) -> tuple[float, np.ndarray]:
    """Of the documents' labels ``y``, and its gradient. ``params``: features'
    weights, bias and the leak's logit. ``feature`` and ``of_sentence`` list
    the features of sentences, ``of_doc`` the sentences of documents; ``bare``
    counts a document's other sentences."""
    size, docs = len(params) - 2, len(y)
    z = params[size] + np.bincount(of_sentence, params[feature], len(of_doc))
    p, rest = (1 / (1 + np.exp(-np.clip(x, -40, 40))) for x in (z, params[size]))
    leak = 1 / (1 + np.exp(-params[-1]))
    # log of the chance that nothing is toxic; its derivative's factor is 1 for
    # clean documents, -none / (1 - none) for others.
    none = np.bincount(of_doc, np.log1p(-np.minimum(p, 1 - 1e-12)), docs) + bare * np.log1p(-rest) + np.log1p(-leak)
    toxic = -np.expm1(np.minimum(none, -1e-9))
    push = np.where(y == 1, np.exp(none) / toxic, -1.0)
    by_sentence = push[of_doc] * p
    gradient = np.empty(size + 2)
    gradient[:size] = np.bincount(feature, by_sentence[of_sentence], size)
    gradient[size] = by_sentence.sum() + (push * bare).sum() * rest
    gradient[-1] = push.sum() * leak
    return float(np.where(y == 1, np.log(toxic), none).sum()), gradient


def trained(start: dict[str, float], split: list[tuple[int, list[list[int]]]], labels: list[int], rounds: int = ROUNDS) -> Model:
    """Fit by proximal AdaGrad steps on the full likelihood; deterministic.
    ``split`` has ``placed`` of each document, by the place of a feature in
    ``sorted(start)``."""
    y = np.array(labels, float)
    if not len(y) or y.min() == y.max():
        return Model({}, -40.0, float(y.mean()) if len(y) else 0.0)
    names = sorted(start)
    size = len(names)
    found = [(d, ids) for d, (_, own) in enumerate(split) for ids in own]
    of_doc = np.array([d for d, _ in found], np.int64)
    of_sentence = np.array([i for i, (_, ids) in enumerate(found) for _ in ids], np.int64)
    feature = np.array([f for _, ids in found for f in ids], np.int64)
    bare = np.array([n - len(own) for n, own in split], float)
    params = np.concatenate(([start[f] for f in names], [-6.0, np.log(y.mean() / (1 - y.mean()))]))
    squares = np.full(size + 2, 1e-6)
    for _ in range(rounds):
        _, gradient = log_likelihood(params, feature, of_sentence, of_doc, bare, y)
        squares += gradient**2
        step = RATE / np.sqrt(squares)
        params += step * gradient
        w = params[:size]
        params[:size] = np.sign(w) * np.maximum(np.abs(w) - PENALTY * step[:size], 0)
    kept = {f: float(params[i]) for i, f in enumerate(names) if abs(params[i]) > 1e-3}
    return Model(kept, float(params[size]), float(1 / (1 + np.exp(-params[-1]))))


def _counted(batches):
    """(text, label) to (feature, clean, toxic): in how many of the task's
    documents a feature is."""
    for batch in batches:
        seen: list[Counter] = [Counter(), Counter()]
        for text, label in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            seen[int(label == 1)].update(document_features(text.as_py()))
        names = sorted(seen[0].keys() | seen[1].keys())
        arrays = [pa.array(names, pa.string()), *(pa.array([c[f] for f in names], pa.int64()) for c in seen)]
        yield pa.RecordBatch.from_arrays(arrays, names=["feature", "clean", "toxic"])


def _placed(names):
    def run(batches):
        place = {f: i for i, f in enumerate(names.value)}
        for batch in batches:
            found = [placed(text.as_py(), place) for text in batch.column(2)]
            arrays = [pa.array([n for n, _ in found], pa.int64()), pa.array([ids for _, ids in found], pa.list_(pa.list_(pa.int32())))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *arrays], names=["id", "label", "n", "ids"])

    return run


SCORED = T.StructType(
    [
        T.StructField("score", T.DoubleType()),
        T.StructField("n_sentences", T.LongType()),
        T.StructField(
            "offending",
            T.ArrayType(
                T.StructType([T.StructField("sentence", T.StringType()), T.StructField("score", T.DoubleType())])
            ),
        ),
    ]
)


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE, min_docs: int = MIN_DOCS):
    """A model of at most ``sample`` labelled documents, sent to every
    executor. Rows of ``labels`` without id or label teach nothing; of repeated
    labels the higher counts, of repeated documents the first text."""
    ship(docs.sparkSession)
    chosen = (
        labels.where(F.col(id).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(id).alias("id"))
        .agg(F.max(label).alias("label"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(sample)
    )
    texts = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    label_of = (F.col("label") == 1).cast("int").alias("label")
    rows = stored(texts.join(chosen, "id").groupBy("id", label_of).agg(F.min("text").alias("text")))
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    clean, toxic = sizes.get(0, 0), sizes.get(1, 0)
    counts = (
        rows.select("text", "label")
        .mapInArrow(_counted, "feature string, clean long, toxic long")
        .groupBy("feature")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where((F.col("toxic") >= 2) & (F.col("clean") + F.col("toxic") >= min_docs))
    )
    # Only what the screen lets pass leaves the executors.
    n0, n1 = (F.col(c) + 0.5 for c in ("clean", "toxic"))
    m0, m1 = clean + 1 - n0, toxic + 1 - n1
    passes = F.log(n1 / m1) - F.log(n0 / m0) > SIGNIFICANT * F.sqrt(1 / n0 + 1 / n1 + 1 / m0 + 1 / m1) - 1e-9
    found = [tuple(r) for r in counts.where(passes).collect()] if clean and toxic else []
    start = screened(found, clean, toxic)
    names = shared_value(docs.sparkSession, sorted(start))
    fields = f"id {rows.schema['id'].dataType.simpleString()}, label int, n long, ids array<array<int>>"
    split = rows.select("id", "label", "text").mapInArrow(_placed(names), fields).orderBy("id").collect()
    model = trained(start, [(r["n"], r["ids"]) for r in split], [r["label"] for r in split])
    return shared_value(docs.sparkSession, model)


def score_udf(model):
    """text -> (score, number of sentences, sentences more likely toxic than
    not)."""
    ship()

    @F.arrow_udf(SCORED)
    def scored(texts: pa.Array) -> pa.Array:
        judge = model.value
        out = []
        for text in texts:
            own = sentences(text.as_py())
            scores = judge.sentence_scores(text.as_py())
            bad = [{"sentence": s, "score": p} for s, p in zip(own, scores, strict=True) if p >= 0.5]
            out.append({"score": judge.document_score(scores), "n_sentences": len(own), "offending": bad})
        return pa.array(out, _ARROW)

    return scored


_ARROW = pa.struct(
    [
        ("score", pa.float64()),
        ("n_sentences", pa.int64()),
        ("offending", pa.list_(pa.struct([("sentence", pa.string()), ("score", pa.float64())]))),
    ]
)


def score(docs: DataFrame, model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, score, n_sentences, offending)`` of every row."""
    found = docs.select(F.col(id).alias("__id"), score_udf(model)(F.col(text)).alias("r"))
    return found.select(F.col("__id").alias(id), *(F.col("r")[name].alias(name) for name in SCORED.names))
