"""URL filter: rules, and a character language-model ratio for the rest.

A rule blocks or allows a host with all its subdomains, below a path; of the
rules that fit a URL the longest decides. URLs that rules block and allow are
also the examples from which two variable-order Markov models of characters
are learnt, one of accepted and one of rejected URLs. The probability of a
character mixes the estimates after ever longer contexts (Witten and Bell's
weights): a context counts by how often it was seen against how many different
characters followed it, and an unseen one leaves the shorter one's estimate.

A URL's score is the difference of its log-likelihoods under the two models,
divided by its length. One in ``FOLDS`` examples is kept from learning and
sets the threshold where the two kinds' scores, taken as normal, are equally
often misjudged.

All of it is joins and aggregates: contexts are counted with partial sums, the
score of a character in its context is computed once for each distinct one in
the table, and a URL is scored once however many rows have it. URLs are known
by two hashes of 96 bits; the work grows with their length, of any length.

Rules look at host and path; the models learn from and score the whole URL as
it is written, with its scheme, query and fragment. NULL or without ``://``,
host and path are empty. A NULL or empty URL scores 0. Without examples of both
kinds every score and the threshold are 0, which allows. Repeated rows each get
the verdict; columns of any other name are kept; an empty table has no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import stored

ORDER = 4
FOLDS = 5
# Characters of a URL that are looked at together; more than an order.
CHUNK = 256
# Characters are first held to be equally likely among this many.
ALPHABET = 128
# Marks before and after a URL's characters.
_BEGIN, _END = "\x02", "\x03"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
# Rules of the query's contract: (what it does, host and path).
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    host = F.translate(F.regexp_extract(url, _PARTS, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def fitting_rule(host: Column, path: Column, rules) -> Column:
    """The longest rule that fits as struct (rule, action), or NULL."""
    out = F.lit(None).cast("struct<rule: string, action: string>")
    # From short to long, so that the longest is asked first.
    for action, rule in sorted(rules, key=lambda r: len(r[1])):
        domain, slash, rest = rule.partition("/")
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(slash + rest)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(action).alias("action"))).otherwise(out)
    return out


def grams_of(texts: DataFrame, order: int, *keep: str) -> DataFrame:
    """A row for each character of ``text`` but the first mark: ``gram``, the
    character after the longest context of at most ``order`` characters before
    it, with the columns ``keep``.

    A text is first cut to chunks, in one pass, and a character looked up in
    its chunk: the work grows with the length, not with its square.
    """
    marked = F.concat(F.lit(_BEGIN), F.col("text"), F.lit(_END))
    cut = texts.select(*keep, F.regexp_extract_all(marked, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0)).alias("chunks"))
    # What a chunk's first characters follow; the last one has no successor.
    before = F.concat(F.array(F.lit("")), F.transform("chunks", lambda c: F.right(c, F.lit(order))))
    pairs = F.zip_with(before, "chunks", lambda old, own: F.struct(F.length(old).alias("n"), F.concat(old, own).alias("c")))
    chunks = cut.select(*keep, F.explode(F.filter(pairs, lambda p: p["c"].isNotNull())).alias("chunk"))
    text, begin = F.col("chunk.c"), F.greatest(F.col("chunk.n"), F.lit(1)) + 1

    def gram(i: Column) -> Column:
        first = F.greatest(i - order, F.lit(1))
        return F.substr(text, first, i - first + 1)

    return chunks.select(*keep, F.explode(F.transform(F.sequence(begin, F.length(text)), gram)).alias("gram"))


def context_counts(urls: DataFrame, order: int = ORDER) -> DataFrame:
    """``(gram, accepted, rejected)``: how often each context with its next
    character is in the examples ``(text, action, n)``, for all lengths of
    context from one."""
    longest = (
        grams_of(urls, order, "action", "n")
        .groupBy("gram")
        .agg(
            F.sum(F.when(F.col("action") == "allow", F.col("n")).otherwise(0)).alias("accepted"),
            F.sum(F.when(F.col("action") == "block", F.col("n")).otherwise(0)).alias("rejected"),
        )
    )
    shorter = F.transform(F.sequence(F.lit(2), F.length("gram")), lambda k: F.right("gram", k))
    return (
        longest.select(F.explode(shorter).alias("gram"), "accepted", "rejected")
        .groupBy("gram")
        .agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))
    )


def _mixed(steps: Column, kind: str) -> Column:
    """The probability after all contexts, from the shortest on."""

    def longer(p: Column, s: Column) -> Column:
        seen, followers = s[f"{kind}_total"], s[f"{kind}_kinds"]
        return F.when(seen > 0, (s[kind] + followers * p) / (seen + followers)).otherwise(p)

    return F.aggregate(steps, F.lit(1.0 / ALPHABET), longer)


def gram_scores(grams: DataFrame, counts: DataFrame) -> DataFrame:
    """``(gram, ratio)``: log of accepted over rejected probability of the last
    character after the others, for each of the distinct ``grams``."""
    context = F.expr("left(gram, length(gram) - 1)")
    totals = counts.groupBy(context.alias("context")).agg(
        F.sum("accepted").alias("accepted_total"),
        F.sum("rejected").alias("rejected_total"),
        F.count_if(F.col("accepted") > 0).alias("accepted_kinds"),
        F.count_if(F.col("rejected") > 0).alias("rejected_kinds"),
    )
    part = F.transform(F.sequence(F.lit(2), F.length("whole")), lambda k: F.right("whole", k))
    steps = (
        grams.select(F.col("gram").alias("whole"))
        .select("whole", F.explode(part).alias("gram"))
        .withColumn("context", context)
        .join(totals, "context", "left")
        .join(counts, "gram", "left")
    )
    numbers = ["accepted_total", "accepted_kinds", "rejected_total", "rejected_kinds", "accepted", "rejected"]
    step = F.struct(F.length("gram").alias("length"), *(F.coalesce(n, F.lit(0)).cast("double").alias(n) for n in numbers))
    together = steps.groupBy("whole").agg(F.array_sort(F.collect_list(step)).alias("steps"))
    ratio = F.log(_mixed(F.col("steps"), "accepted")) - F.log(_mixed(F.col("steps"), "rejected"))
    return together.select(F.col("whole").alias("gram"), ratio.alias("ratio"))


def scores(texts: DataFrame, counts: DataFrame, order: int = ORDER) -> DataFrame:
    """``(k1, k2, score)`` of each of the distinct texts ``(k1, k2, text)``.

    Only the keys travel with a text's grams. The scores of grams are a table
    of their own, so that adaptive execution can split a common gram's rows.
    """
    pieces = grams_of(texts, order, "k1", "k2")
    ratios = stored(gram_scores(pieces.select("gram").distinct(), counts))
    return pieces.join(ratios, "gram").groupBy("k1", "k2").agg((F.sum("ratio") / F.count("*")).alias("score"))


def calibrated(examples: DataFrame) -> float:
    """The threshold from ``(action, score, n)`` of examples not learnt from."""
    row = examples.groupBy().agg(
        *(
            f.alias(f"{kind}_{name}")
            for kind in ("allow", "block")
            for name, f in (
                ("n", F.sum(F.when(F.col("action") == kind, F.col("n")))),
                ("sum", F.sum(F.when(F.col("action") == kind, F.col("n") * F.col("score")))),
                ("squares", F.sum(F.when(F.col("action") == kind, F.col("n") * F.col("score") ** 2))),
            )
        )
    ).first()
    if not row["allow_n"] or not row["block_n"]:
        return 0.0
    mean, spread = {}, {}
    for kind in ("allow", "block"):
        mean[kind] = row[f"{kind}_sum"] / row[f"{kind}_n"]
        spread[kind] = max(row[f"{kind}_squares"] / row[f"{kind}_n"] - mean[kind] ** 2, 1e-12) ** 0.5
    return (mean["allow"] * spread["block"] + mean["block"] * spread["allow"]) / (spread["allow"] + spread["block"])


def judge(pages: DataFrame, rules=RULES, url: str = "url", order: int = ORDER, folds: int = FOLDS) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``score`` and ``verdict``;
    columns of these names are replaced."""
    host, path = host_and_path(F.col(url))
    found = fitting_rule(host, path, rules)
    own = pages.select(F.struct(*(F.col(c) for c in pages.columns)).alias("row"), host.alias("host"), path.alias("path"), found.alias("found"))
    own = own.withColumn("text", F.coalesce(F.col("row")[url], F.lit("")))
    # Each URL once, with its number of rows; whether a rule fits depends on it.
    keys = [F.xxhash64("text").alias("k1"), F.hash("text").alias("k2")]
    once = own.groupBy("text").agg(F.first("found.action").alias("action"), F.count("*").alias("n"))
    texts = stored(once.select("*", *keys))
    held = F.crc32("text") % folds == 0
    examples = texts.where(F.col("action").isNotNull())
    counts = stored(context_counts(examples.where(~held), order))
    kinds = counts.agg(F.sum("accepted").alias("a"), F.sum("rejected").alias("r")).first()
    if kinds["a"] and kinds["r"]:
        scored = stored(scores(texts.where(F.col("text") != ""), counts, order))
        threshold = calibrated(examples.where(held).join(scored, ["k1", "k2"]))
    else:
        scored, threshold = texts.select("k1", "k2", F.lit(0.0).alias("score")).limit(0), 0.0
    keyed = own.select("row", "host", "path", "found", *keys)
    judged = keyed.join(scored, ["k1", "k2"], "left").withColumn("score", F.coalesce("score", F.lit(0.0)))
    by_score = F.when(F.col("score") >= threshold, "allow").otherwise("block")
    added = {"host": F.col("host"), "path": F.col("path"), "rule": F.col("found.rule"), "score": F.col("score"), "verdict": F.coalesce("found.action", by_score)}
    kept = [F.col("row")[c].alias(c) for c in pages.columns if c not in added]
    return judged.select(*kept, *(c.alias(name) for name, c in added.items()))
