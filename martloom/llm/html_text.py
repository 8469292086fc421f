"""Main text of web pages, with a host's repeated runs found by suffix array.

A page with an ``article`` or ``main`` element is settled by it, also by an
empty one: what stands in it is text, but for navigation, forms, adverts,
notices and reader comments inside it. Everything else is the open part: the
chrome of a page with an article, or all of a page without one.

For each host the token streams of whole pages are concatenated, and Spark
sorts the suffixes by (host, run, page), the run being their first
``min_tokens`` tokens: longer repeats are overlapping runs of that length. In
this order each suffix is compared with its neighbour. Where neighbours of
distinct pages share their run, it is repeated. The sort is by ranges, so a hot
host spreads over its runs and a hot run over its pages; pieces of a run that a
range or a batch cuts off are put together afterwards.

Of a page without an article, the tokens that repeated runs cover go and the
unique runs stay; blocks that the markup names as chrome go as well. Hosts
whose pages all have articles need no such comparison.

In articles, repeats are quotations or common lines too, which the text keeps.
So tokens go that are covered by runs which half of a host's distinct articles
have, and ``NOTICE_PAGES`` of them at least: a notice of the site, be it a block
or a part of one. Blocks too short for a run are compared whole. A copied
article counts once; one that is made of notices alone stays whole, and one
that is nine tenths covered is taken for an edited copy, of which only whole
blocks go. Most suffixes of articles are on so few pages that they need not be
sorted: a run on half of the articles is on a third of those in some chunks
(as in the algorithm of Savasere, Omiecinski and Navathe, 1995), and what it
can have in the others is bounded. ``likely_runs`` keeps every run that can get
there, ``common_runs`` counts them by their text.

Pages: NULL and empty ones have empty texts. A NULL address has host ``''``.
Repeated rows count as one page and each get the text. Columns of any name are
left aside; an empty table has no rows. A page is parsed once, in one pass
whose work does not depend on how deep its elements lie.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.common import ship, stored

MIN_TOKENS = 6
NOTICE_PAGES = 4
# Runs of articles that a task counts at a time, and the share of an article
# above which it is an edited copy.
HELD_RUNS = 4_000_000
COPIED = 0.9

# Elements without an end tag.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose content is no markup.
_RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
# Elements that begin and end a block of text.
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "section select summary table tbody td tfoot th thead tr ul".split()
)
# Elements that are never text of the page.
_DROPPED = frozenset(
    "head script style title noscript iframe template svg math canvas object audio video nav footer aside form "
    "button select textarea input datalist menu dialog noembed noframes xmp".split()
)
# Elements that a new one of the group ends, if it is open in the same parent.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
# Parts of class and id names, and roles, that stand for chrome.
_CHROME = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notice|nav\w*|menu|breadcrumbs?|"
    r"side-?bar|related|recommend\w*|share|sharing|social|comments?|commentlist|respond|reply|replies|disqus|footer|"
    r"masthead|newsletter|subscribe|subscription|popup|modal|widget|pagination|pager|toolbar|skip|search)(?:$|[\s_-])",
    re.IGNORECASE,
)
_ROLES = frozenset("navigation banner complementary contentinfo search form dialog alert menu menubar toolbar".split())
_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
_ATTRIBUTE = re.compile(r"(?<![^\s\"'/])(class|id|role|hidden)(?=[\s=>/]|$)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?", re.IGNORECASE)


def _is_chrome(name: str, attributes: str, in_article: bool) -> bool:
    if name in _DROPPED or (name == "header" and not in_article):
        return True
    if not attributes or name in ("html", "body", "article", "main"):
        return False
    for key, *values in _ATTRIBUTE.findall(attributes):
        value = "".join(values)
        key = key.lower()
        if key == "hidden" or (key == "role" and value.lower() in _ROLES) or (key in ("class", "id") and _CHROME.search(value)):
            return True
    return False


def blocks(page: str) -> list[tuple[str, str]]:
    """``(kind, text)`` of the blocks in page order; kind is ``main`` for text
    of an article, ``chrome`` for what the markup names as such, else
    ``open``. References are decoded, white space is one blank."""
    return parsed(page)[0]


def parsed(page: str) -> tuple[list[tuple[str, str]], bool]:
    """The blocks, and whether there is an article, be it empty."""
    found: list[tuple[str, str]] = []
    pieces: list[str] = []
    # Open elements: name, and what kind of text stands in them; where those
    # of a name are, and the block elements other than paragraphs.
    stack: list[tuple[str, str]] = [("", "open")]
    places: dict[str, list[int]] = {}
    outer: list[int] = [0]
    has_article = False

    def innermost(name: str) -> int:
        at = places.get(name)
        return at[-1] if at else 0

    def close_block() -> None:
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                found.append((stack[-1][1], text))
            pieces.clear()

    def close_to(depth: int) -> None:
        while len(stack) > depth:
            if stack[-1][0] in _BLOCK or stack[-1][1] != stack[-2][1]:
                close_block()
            name = stack.pop()[0]
            places[name].pop()
            if outer[-1] == len(stack):
                outer.pop()

    at, end = 0, len(page)
    while at < end:
        if page[at] != "<":
            stop = page.find("<", at)
            stop = end if stop < 0 else stop
            if stack[-1][0] not in _RAW:
                pieces.append(page[at:stop])
            at = stop
            continue
        if page.startswith("<!--", at):
            stop = page.find("-->", at + 4)
            at = end if stop < 0 else stop + 3
            continue
        tag = _TAG.match(page, at)
        if not tag:
            if page[at + 1 : at + 2] in ("!", "?", "/"):
                stop = page.find(">", at)
                at = end if stop < 0 else stop + 1
            elif page[at + 1 : at + 2].isalpha() and page.find(">", at) < 0:
                at = end  # A tag that the page's end cuts off.
            else:
                pieces.append("<")
                at += 1
            continue
        at = tag.end()
        name, attributes = tag[2].lower(), tag[3]
        if tag[1]:
            depth = innermost(name)
            if depth:
                close_to(depth)
            elif name in _BLOCK:
                close_block()
            continue
        if name == "br":
            pieces.append("\n")
            continue
        if name in _BLOCK:
            depth = innermost("p")
            if depth > outer[-1]:
                close_to(depth)
        if name in _ENDS:
            depth = max(innermost("p"), outer[-1])
            if stack[depth][0] == "p":
                depth -= 1
            if depth and stack[depth][0] in _ENDS[name]:
                close_to(depth)
        kind = stack[-1][1]
        if kind != "chrome":
            in_article = kind == "main"
            if _is_chrome(name, attributes, in_article):
                kind = "chrome"
            elif name in ("article", "main") or re.search(r"role\s*=\s*[\"']?main\b", attributes):
                kind, has_article = "main", True
        if name in _BLOCK or kind != stack[-1][1]:
            close_block()
        if name in _VOID or attributes.endswith("/") and name not in _BLOCK | _RAW:
            continue
        if name in _RAW:
            stop = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.IGNORECASE).search(page, at)
            at = stop.start() if stop else end
            if not stop:
                continue
        places.setdefault(name, []).append(len(stack))
        if name in _BLOCK and name != "p":
            outer.append(len(stack))
        stack.append((name, kind))
    close_to(1)
    close_block()
    return found, has_article


def main_text(page: str | None) -> str | None:
    """The article's blocks, joined by an empty line; NULL if there is none."""
    found, has_article = parsed(page or "")
    return "\n\n".join(text for kind, text in found if kind == "main") if has_article else None


_PART = T.StructType(
    [
        T.StructField("settled", T.BooleanType()),
        T.StructField("blocks", T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("text", T.StringType())]))),
    ]
)
_ARROW_BLOCK = pa.struct([("kind", pa.string()), ("text", pa.string())])
_ARROW_PART = pa.struct([("settled", pa.bool_()), ("blocks", pa.list_(_ARROW_BLOCK))])


@F.arrow_udf(_PART)
def _parts_udf(pages: pa.Array) -> pa.Array:
    """Whether a page has an article, and its blocks."""
    out = []
    for page in pages:
        found, has_article = parsed(page.as_py() or "")
        out.append({"settled": has_article, "blocks": [{"kind": k, "text": t} for k, t in found]})
    return pa.array(out, _ARROW_PART)


def host_of(url: str):
    """The host after ``://``, A-Z lower-cased."""
    host = F.regexp_extract(F.col(url), r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def page_parts(pages: DataFrame, id: str, url: str, page: str) -> DataFrame:
    """``(row, id, url, host, k1, k2, settled, blocks)``: whether a page has an
    article, and all of its blocks. To be stored, for the row numbers."""
    keyed = pages.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id).alias("id"),
        F.col(url).alias("url"),
        host_of(url).alias("host"),
        F.xxhash64(id, url, page).alias("k1"),
        F.hash(id, url, page).alias("k2"),
        _parts_udf(F.col(page)).alias("part"),
    )
    return keyed.select("row", "id", "url", "host", "k1", "k2", "part.settled", "part.blocks")


def article():
    """The texts of an article's blocks."""
    return F.transform(F.filter("blocks", lambda b: b["kind"] == "main"), lambda b: b["text"])


def tokens_of(texts):
    return F.filter(F.split(F.array_join(texts, " "), " "), lambda t: t != "")


def notices(singles: DataFrame, n_articles: DataFrame, min_tokens: int, least: int = NOTICE_PAGES) -> DataFrame:
    """``(host, notices)``: hashes of blocks too short for a run that at least
    half of a host's distinct articles have. A host has at most twice as many
    as an article has blocks on average. No text is shuffled."""
    short = F.filter("article", lambda b: F.size(F.split(b, " ")) < min_tokens)
    blocks = singles.select("host", F.explode(F.array_distinct(F.transform(short, lambda b: F.xxhash64(b)))).alias("block"))
    with_block = blocks.groupBy("host", "block").agg(F.count("*").alias("n"))
    common = with_block.where(F.col("n") >= least).join(n_articles, "host").where(2 * F.col("n") >= F.col("n_articles"))
    return common.groupBy("host").agg(F.collect_list("block").alias("notices"))


def suffixes(parts: DataFrame, min_tokens: int) -> DataFrame:
    """``(host, run, k1, k2, pos)``: each page's suffixes, kept to their first
    ``min_tokens`` tokens; shorter ones cannot hold a long run."""
    streams = parts.select("host", "k1", "k2", tokens_of(F.transform("blocks", lambda b: b["text"])).alias("tokens"))
    starts = F.sequence(F.lit(0), F.size("tokens") - min_tokens)
    return (
        streams.where(F.size("tokens") >= min_tokens)
        .select("host", "k1", "k2", "tokens", F.explode(starts).alias("pos"))
        .select("host", F.array_join(F.slice("tokens", F.col("pos") + 1, min_tokens), " ").alias("run"), "k1", "k2", "pos")
    )


_PIECE = "host string, run string, n long, k1 long, k2 int, l1 long, l2 int"


def _compared(batches):
    """Sorted (host, run, k1, k2) to pieces of neighbours that share their run:
    how many pages, the first and the last. One page alone is no piece, but at
    the ends of a batch, where others may follow."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue

        def differs(i: int, batch=batch, n=n) -> np.ndarray:
            return pc.not_equal(batch.column(i).slice(1), batch.column(i).slice(0, n - 1)).to_numpy(zero_copy_only=False).astype(bool)

        other_run = differs(0) | differs(1)
        other_page = other_run | differs(2) | differs(3)
        begin = np.concatenate(([0], np.flatnonzero(other_run) + 1))
        end = np.concatenate((begin[1:], [n])) - 1
        pages = np.add.reduceat(np.concatenate(([True], other_page)).astype(np.int64), begin)
        told = pages > 1
        told[[0, -1]] = True
        first, last = batch.take(pa.array(begin[told])), batch.take(pa.array(end[told]))
        yield pa.RecordBatch.from_arrays(
            [first.column(0), first.column(1), pa.array(pages[told]), first.column(2), first.column(3), last.column(2), last.column(3)],
            names=["host", "run", "n", "k1", "k2", "l1", "l2"],
        )


def neighbours(suffix_rows: DataFrame) -> DataFrame:
    """``(host, run, n, least, greatest)`` of runs that neighbours share in the
    order of suffixes, and of some others: the number of pages, where each has
    the run in one row, and the least and greatest page."""
    order = suffix_rows.select("host", "run", "k1", "k2").orderBy("host", "run", "k1", "k2")
    return (
        order.mapInArrow(_compared, _PIECE)
        .groupBy("host", "run")
        .agg(F.sum("n").alias("n"), F.min(F.struct("k1", "k2")).alias("least"), F.max(F.struct(F.col("l1").alias("k1"), F.col("l2").alias("k2"))).alias("greatest"))
    )


def repeated_runs(suffix_rows: DataFrame) -> DataFrame:
    """``(host, run)``: runs on distinct pages of a host."""
    return neighbours(suffix_rows).where(F.col("least") != F.col("greatest")).select("host", "run")


def _unique_udf(min_tokens: int):
    """(blocks, covered run starts) to the unique runs of open blocks."""

    @F.arrow_udf(T.StringType())
    def texts(all_blocks: pa.Array, starts: pa.Array) -> pa.Array:
        out = []
        for page, covered in zip(all_blocks.to_pylist(), starts.to_pylist(), strict=True):
            gone = {p + i for p in covered or () for i in range(min_tokens)}
            kept, pos = [], 0
            for block in page or ():
                tokens = block["text"].split(" ")
                own = [t for i, t in enumerate(tokens, pos) if i not in gone]
                pos += len(tokens)
                if own and block["kind"] == "open":
                    kept.append(" ".join(own))
            out.append("\n\n".join(kept))
        return pa.array(out, pa.string())

    return texts


def copies(settled: DataFrame) -> DataFrame:
    """``(row)`` of articles that an earlier row of their host has as well."""
    keys = settled.select("row", "host", F.xxhash64("article").alias("a"))
    first = keys.groupBy("host", "a").agg(F.min("row").alias("first"))
    return keys.join(first, ["host", "a"]).where(F.col("row") != F.col("first")).select("row")


def _run_hashes(tokens: np.ndarray, min_tokens: int) -> np.ndarray:
    """64 bits of each run, from those of its tokens; they wrap around."""
    n = max(len(tokens) - min_tokens + 1, 0)
    out = np.zeros(n, np.uint64)
    for i in range(min_tokens):
        out = out * np.uint64(0x9E3779B97F4A7C15) + tokens[i : i + n]
    return out


def _tokens_at(column, i: int) -> np.ndarray:
    offsets = column.offsets
    return column.values[offsets[i].as_py() : offsets[i + 1].as_py()].to_numpy(zero_copy_only=False).view(np.uint64)


def _count_runs(min_tokens: int, held_runs: int):
    """(host, tokens) batches to (host, run, n, missed) rows. For each chunk and
    host: how many articles, and how many a run that is not named can be on at
    most; then each run on more, and how many more."""

    def counted(held: dict[str, list[np.ndarray]]) -> pa.RecordBatch:
        hosts, runs, ns, misses = [], [], [], []
        for host, found in held.items():
            missed = (len(found) - 1) // 3
            run, n = np.unique(np.concatenate(found), return_counts=True)
            run, n = run[n > missed], n[n > missed]
            hosts += [host] * (len(run) + 1)
            runs += [None, *run.view(np.int64).tolist()]
            ns += [len(found), *(n - missed).tolist()]
            misses += [missed] + [None] * len(run)
        columns = [pa.array(hosts, pa.string()), pa.array(runs, pa.int64()), pa.array(ns, pa.int64()), pa.array(misses, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["host", "run", "n", "missed"])

    def count(batches):
        held: dict[str, list[np.ndarray]] = {}
        size = 0
        for batch in batches:
            hosts, tokens = batch.column(0).to_pylist(), batch.column(1)
            for i, host in enumerate(hosts):
                found = np.unique(_run_hashes(_tokens_at(tokens, i), min_tokens))
                held.setdefault(host, []).append(found)
                size += len(found)
                if size > held_runs:
                    yield counted(held)
                    held, size = {}, 0
        yield counted(held)

    return count


def likely_runs(singles: DataFrame, min_tokens: int, held_runs: int = HELD_RUNS, least: int = NOTICE_PAGES) -> tuple[DataFrame, DataFrame]:
    """``(host, likely)``: hashes of runs that can be on half of a host's
    distinct articles; none that is gets lost. As those chunks that do not name
    a run have it on less than a third, a host has at most some six times as
    many as an article has runs on average. And ``(host, n_articles)``."""
    hashes = F.transform(tokens_of(F.col("article")), lambda t: F.xxhash64(t))
    found = singles.select("host", hashes.alias("tokens"))
    rows = stored(found.mapInArrow(_count_runs(min_tokens, held_runs), "host string, run long, n long, missed long"))
    hosts = rows.where("run IS NULL").groupBy("host").agg(F.sum("n").alias("n_articles"), F.sum("missed").alias("missed"))
    most = F.col("n") + F.col("missed")
    likely = (
        rows.where("run IS NOT NULL")
        .groupBy("host", "run")
        .agg(F.sum("n").alias("n"))
        .join(hosts, "host")
        .where((most >= least) & (2 * most >= F.col("n_articles")))
    )
    return likely.groupBy("host").agg(F.collect_list("run").alias("likely")), hosts.select("host", "n_articles")


def _starts_udf(min_tokens: int):
    """(hashes of tokens, hashes of runs) to where those runs start."""

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def starts(tokens: pa.Array, likely: pa.Array) -> pa.Array:
        out = []
        for i in range(len(tokens)):
            runs = _run_hashes(_tokens_at(tokens, i), min_tokens)
            out.append(np.flatnonzero(np.isin(runs, _tokens_at(likely, i))).astype(np.int32))
        return pa.array(out, pa.list_(pa.int32()))

    return starts


def common_runs(singles: DataFrame, likely: DataFrame, n_articles: DataFrame, min_tokens: int, least: int = NOTICE_PAGES) -> DataFrame:
    """``(host, runs)``: the runs that half of a host's distinct articles have.
    Those suffixes are sorted that start with a likely run, an article's equal
    ones once."""
    streams = singles.join(likely, "host").select("row", "host", "likely", tokens_of(F.col("article")).alias("tokens"))
    starts = _starts_udf(min_tokens)(F.transform("tokens", lambda t: F.xxhash64(t)), F.col("likely"))
    at = streams.select("row", "host", "tokens", starts.alias("starts"))
    run = F.transform("starts", lambda p: F.array_join(F.slice(F.col("tokens"), p + 1, min_tokens), " "))
    rows = at.select("host", F.explode(F.array_distinct(run)).alias("run"), F.col("row").alias("k1"), F.lit(0).alias("k2"))
    common = neighbours(rows).where(F.col("n") >= least).join(n_articles, "host").where(2 * F.col("n") >= F.col("n_articles"))
    return common.groupBy("host").agg(F.collect_list("run").alias("runs"))


def without_runs(blocks: list[str], runs: set[str], short: set[int], min_tokens: int) -> list[str]:
    """An article's blocks less the tokens that ``runs`` cover and the blocks
    numbered in ``short``; all of them if nothing is left."""
    split = [b.split(" ") for b in blocks]
    tokens = [t for b in split for t in b]
    gone = np.zeros(len(tokens), bool)
    for i in range(len(tokens) - min_tokens + 1):
        if " ".join(tokens[i : i + min_tokens]) in runs:
            gone[i : i + min_tokens] = True
    copied = gone.sum() > COPIED * len(tokens)
    kept, pos = [], 0
    for i, own in enumerate(split):
        cover = gone[pos : pos + len(own)]
        pos += len(own)
        if i in short or cover.all():
            continue
        kept.append(" ".join(own if copied else [t for t, g in zip(own, cover, strict=True) if not g]))
    return kept or blocks


def _without_runs_udf(min_tokens: int):
    """(blocks, runs, hashes of blocks, hashes of notices) to the text; NULL
    for NULL blocks."""

    @F.arrow_udf(T.StringType())
    def texts(all_blocks: pa.Array, runs: pa.Array, hashes: pa.Array, known: pa.Array) -> pa.Array:
        out = []
        for i, blocks in enumerate(all_blocks.to_pylist()):
            if blocks is None:
                out.append(None)
                continue
            gone = set(known[i].as_py() or ())
            short = {k for k, h in enumerate(hashes[i].as_py()) if h in gone}
            out.append("\n\n".join(without_runs(blocks, set(runs[i].as_py() or ()), short, min_tokens)))
        return pa.array(out, pa.string())

    return texts


def extract(
    pages: DataFrame, id: str = "page_id", url: str = "url", page: str = "html", min_tokens: int = MIN_TOKENS
) -> DataFrame:
    """``(id, url, text)`` of every row."""
    ship()
    parts = stored(page_parts(pages, id, url, page))
    settled = parts.where("settled").select("row", "id", "url", "host", article().alias("article"))
    # Small tables are stored, so that Spark knows how few rows there are
    # before it joins.
    singles = settled.join(stored(copies(settled)), "row", "left_anti")
    likely, n_articles = likely_runs(singles, min_tokens)
    runs = common_runs(singles, stored(likely), n_articles, min_tokens)
    known = stored(runs.join(notices(singles, n_articles, min_tokens), "host", "full"))
    told = F.when(F.col("runs").isNotNull() | F.col("notices").isNotNull(), F.col("article"))
    left = _without_runs_udf(min_tokens)(told, F.col("runs"), F.transform(told, lambda b: F.xxhash64(b)), F.col("notices"))
    articles = settled.join(known, "host", "left").select(
        "id", "url", F.coalesce(left, F.array_join("article", "\n\n")).alias("text")
    )
    unsettled = parts.where(~F.col("settled"))
    # Whole pages, with articles, of the hosts that have others.
    rows = suffixes(parts.join(stored(unsettled.select("host").distinct()), "host", "left_semi"), min_tokens)
    covered = (
        suffixes(unsettled, min_tokens)
        .join(repeated_runs(rows), ["host", "run"], "left_semi")
        .groupBy("k1", "k2")
        .agg(F.collect_set("pos").alias("starts"))
    )
    rest = unsettled.join(covered, ["k1", "k2"], "left").select(
        "id", "url", _unique_udf(min_tokens)(F.col("blocks"), F.col("starts")).alias("text")
    )
    return articles.unionByName(rest).select(F.col("id").alias(id), F.col("url").alias(url), "text")
