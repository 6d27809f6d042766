"""Main text of web pages: structure first, and repeated runs of words per host where structure is silent.

Parsing cuts a page into blocks and drops what its tags, classes and roles declare not to be the article. Then repetition decides
on every page: runs of ``RUN_WORDS`` words of a host are brought together by their identifiers. Inside an article or main element a
run is boilerplate if more than half of the host's different articles hold it; on other pages, if another page of the host does.
What such runs cover goes. That is what the longest repeats of that spread cover too; no suffix array is sorted to find them.

A bucket of runs is reduced to its number of different pages on the map side, so a host with a third of all pages, or
a menu on all of them, sends one row per task and bucket.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskframe.llm.common import stored
from riskframe.llm.repeats import merged, mixed

#: Words of a repeated run at least.
RUN_WORDS = 8
#: Different articles of a host that hold a run before it may be boilerplate inside articles.
MIN_ARTICLES = 3
#: Bins by which the runs of a host's articles are counted first.
RUN_BINS = 4096

# HTML's element names by what they mean for the text.
RAW = ["script", "style", "noscript", "template", "textarea", "iframe", "svg", "math", "object", "canvas", "title"]
CHROME = {
    "head", "nav", "footer", "aside", "form", "button", "select", "option", "dialog", "menu", "input", "label", "fieldset",
    "audio", "video",
}
BLOCKS = {
    "address", "article", "blockquote", "body", "caption", "center", "dd", "details", "div", "dl", "dt", "figcaption", "figure",
    "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "li", "main", "ol", "p", "pre", "section", "summary",
    "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
} | CHROME
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
MAIN = {"article", "main"}
CHROME_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar"}
CHROME_WORDS = (
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs "
    "sidebar side footer foot header masthead banner cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe "
    "signup login share sharing social related recommended recommendations comment comments reply replies disqus widget toolbar pager pagination skip"
).split()

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(?P<raw>" + "|".join(RAW) + r")\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^<>\"']|\"[^\"]*\"|'[^']*'|[\"'])*)(?:>|(?=<)|\Z)",
    re.S | re.I,
)
#: Inside an article or main element a class or id speaks against a block if each of its words is one of these, or of these and
#: ``NEUTRAL``: comments, reader-comments, cookie-notice, related-posts; but not side-effects, related-work or menu.
ARTICLE_CHROME = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored comment comments reply replies disqus newsletter subscribe signup "
    "login cookie cookies consent gdpr notice notices popup modal related recommended recommendations share sharing nav navbar navigation "
    "sidebar breadcrumb breadcrumbs pagination pager toolbar".split()
)
#: Words that say nothing by themselves beside one of those.
NEUTRAL = set(
    "article articles area bar block body bottom box button buttons card container content element entry feed form group header holder "
    "inner inline item items left link links list main message page panel placeholder post posts reader readers right row section slot social "
    "stories story text thread title top unit user users wrap wrapper zone footer banner side widget".split()
)
_MARK = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WORDS = re.compile(r"[a-z]+")
_CHROME = set(CHROME_WORDS)


def article_chrome(name: str) -> bool:
    """Whether a class or id inside an article declares what isn't the article."""
    words = _WORDS.findall(name)
    if len(words) > 1 and _CHROME.issuperset(words):
        return True
    return any(w in ARTICLE_CHROME for w in words) and all(w in ARTICLE_CHROME or w in NEUTRAL for w in words)


def declared_chrome(tag: str, rest: str, in_main: bool) -> bool:
    if tag in CHROME or (tag == "header" and not in_main):
        return True
    if not rest or tag in ("html", "body") or tag in MAIN:
        return False
    for name, *values in _MARK.findall(rest):
        value, name = next((v for v in values if v), "").lower(), name.lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "role" and value in CHROME_ROLES):
            return True
        if in_main:
            if name in ("class", "id") and any(map(article_chrome, value.split())):
                return True
        elif name in ("class", "id") and not _CHROME.isdisjoint(_WORDS.findall(value)):
            return True
    return False


def blocks(page: str | None) -> tuple[list[str], bool]:
    """The page's blocks in order, chrome left out, and whether they come from an article or main element."""
    kept: list[tuple[bool, str]] = []
    text: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # element, whether it is in chrome, whether it is in the article
    chrome = main = False
    at = 0
    page = page or ""

    def flush():
        block = " ".join(html.unescape("".join(text)).split())
        text.clear()
        if block:
            kept.append((main, block))

    for found in _TOKEN.finditer(page):
        if not chrome and found.start() > at:
            text.append(page[at : found.start()])
        at = found.end()
        tag = found["tag"]
        if not tag:
            continue
        tag = tag.lower()
        if tag in BLOCKS:
            flush()
        elif tag == "br":
            text.append(" ")
        if found["end"]:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    del stack[depth:]
                    break
                if tag not in BLOCKS and stack[depth][0] in BLOCKS:
                    break  # an inline end tag closes no block
        elif tag not in VOID and not found["rest"].endswith("/"):
            if tag in ("p", "li") and stack and stack[-1][0] == tag:
                stack.pop()
            _, chrome_, main_ = stack[-1] if stack else ("", False, False)
            if tag not in BLOCKS and not found["rest"]:
                stack.append((tag, chrome_, main_))
            else:
                stack.append((tag, chrome_ or declared_chrome(tag, found["rest"], main_), main_ or (tag in MAIN and not chrome_)))
        _, chrome, main = stack[-1] if stack else ("", False, False)
    if not chrome:
        text.append(page[at:])
    flush()
    if any(m for m, _ in kept):
        return [b for m, b in kept if m], True
    return [b for _, b in kept], False


def word_ids(words: list[str]) -> np.ndarray:
    """64-bit identifiers of words, the same in every task."""
    from xxhash import xxh64_intdigest

    return np.fromiter((xxh64_intdigest(w.encode("utf-8", "replace")) for w in words), np.uint64, len(words))


def suffix_ids(words: list[str], run: int = RUN_WORDS) -> np.ndarray:
    """Identifiers of the first ``run`` words of every suffix that has as many."""
    ids = word_ids(words)
    if len(ids) < run:
        return ids[:0]
    h = ids[: len(ids) - run + 1].copy()
    for k in range(1, run):
        h = mixed(h, ids[k : len(ids) - run + 1 + k])
    return h


def without_boilerplate(found: list[str], covered: np.ndarray, run: int = RUN_WORDS) -> list[str]:
    """Blocks less the words that lie in a repeated run; ``covered`` are the runs' starts in the page's stream."""
    words = [b.split(" ") for b in found]
    gone = np.zeros(sum(map(len, words)) + 1, bool)
    _, a, b = merged(np.zeros(len(covered), np.int64), covered, covered + run)
    for x, y in zip(a.tolist(), b.tolist()):
        gone[x:y] = True
    out, at = [], 0
    for block in words:
        rest = [w for w, g in zip(block, gone[at : at + len(block)]) if not g]
        at += len(block)
        if rest:
            out.append(" ".join(rest))
    return out


def article_runs(found: list[str], run: int) -> np.ndarray:
    return suffix_ids([w for b in found for w in b.split(" ")], run)


def common_runs(declared: DataFrame, run: int) -> DataFrame:
    """(host, common): the runs that more than half of a host's different articles hold, ``MIN_ARTICLES`` at least.

    Each article first marks its runs' bins, and only runs in a bin that enough articles mark are brought together: a bin is
    marked at least as often as each run in it, so the filter loses none. Then the different articles of a run are counted. A host
    has at most twice as many common runs as its articles have on average, so the lists stay short.
    """
    needed = declared.groupBy("host").agg(F.count_distinct("article").alias("n"))
    needed = needed.select("host", F.greatest(F.floor(F.col("n") / 2) + 1, F.lit(MIN_ARTICLES)).alias("needed"), "n").filter("n >= needed")
    needed = stored(needed.drop("n"), "page_hosts")
    articles = declared.join(needed, "host").select("host", "article", "blocks", "needed")

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()  # copies within a task mark once
        for batch in batches:
            for host, article, needed, found in zip(*(batch.column(c).to_pylist() for c in ("host", "article", "needed", "blocks"))):
                if (host, article) in seen:
                    continue
                seen.add((host, article))
                marked = np.unique(article_runs(found, run) % np.uint64(RUN_BINS)).astype(np.int32)
                n = len(marked)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, host, np.int64)), pa.array(np.full(n, needed, np.int64)), pa.array(marked)],
                    names=["host", "needed", "bin"],
                )

    full = articles.mapInArrow(bins, "host long, needed long, bin int").groupBy("host", "bin")
    full = full.agg(F.count("*").alias("n"), F.max("needed").alias("needed")).filter("n >= needed")
    full = stored(full.groupBy("host").agg(F.collect_list("bin").alias("bins")), "page_bins")

    def in_full_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        names = ["host", "article", "needed", "blocks", "bins"]
        for batch in batches:
            for host, article, needed, found, wanted in zip(*(batch.column(c).to_pylist() for c in names)):
                if (host, article) in seen:
                    continue
                seen.add((host, article))
                ids = np.unique(article_runs(found, run))
                ids = ids[np.isin(ids % np.uint64(RUN_BINS), np.array(wanted, np.uint64))]
                columns = [pa.array(np.full(len(ids), k, np.int64)) for k in (host, article, needed)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(ids.view(np.int64))], names=[*names[:3], "suffix"])

    left = articles.join(full, "host").mapInArrow(in_full_bins, "host long, article long, needed long, suffix long")
    common = left.groupBy("host", "suffix").agg(F.count_distinct("article").alias("n"), F.max("needed").alias("needed"))
    common = common.filter("n >= needed").groupBy("host").agg(F.collect_list("suffix").alias("common"))
    return stored(common, "page_runs")


def without_common(found: list[str], common: np.ndarray, run: int = RUN_WORDS) -> list[str]:
    """An article less its host's common runs; one that they cover by more than half is a near copy of others and stays whole."""
    at = np.flatnonzero(np.isin(article_runs(found, run).view(np.int64), common))
    rest = without_boilerplate(found, at, run)
    n, left = (sum(b.count(" ") + 1 for b in x) for x in (found, rest))
    return rest if left * 2 >= n else found


def main_text(pages: DataFrame, run: int = RUN_WORDS) -> DataFrame:
    """(page_id, url, text, n_chars, from_structure), one row per row of ``pages`` (page_id, url, html).

    Null and empty pages have an empty text. Pages with a null url share the host of no address. Rows that repeat page_id, url and
    html are one page, so they are no evidence of boilerplate against each other and each keep their text. Broken markup is
    read to its end; long pages are read whole; an empty table gives no row.
    """
    schema = "page_id long, url string, host long, page long, article long, from_structure boolean, blocks array<string>"
    host = F.xxhash64(F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit("")))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        for batch in batches:
            parsed = [blocks(x.as_py()) for x in batch.column("html")]
            texts = [" ".join(b) for b, _ in parsed]
            article = np.array([xxh64_intdigest(t.encode("utf-8", "replace")) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("page_id", "url", "host", "page")),
                    pa.array(article.view(np.int64)),
                    pa.array([m for _, m in parsed], pa.bool_()),
                    pa.array([b for b, _ in parsed], pa.list_(pa.string())),
                ],
                names=["page_id", "url", "host", "page", "article", "from_structure", "blocks"],
            )

    plain = pages.select("page_id", "url", host.alias("host"), F.xxhash64("page_id", "url", "html").alias("page"), "html")
    parsed = stored(plain.mapInArrow(parse, schema), "page_blocks")
    silent, declared = parsed.filter("not from_structure"), parsed.filter("from_structure")

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids = suffix_ids([w for b in batch.column("blocks")[row].as_py() for w in b.split(" ")], run)
                n = len(ids)
                columns = [pa.array([batch.column(c)[row].as_py()] * n, pa.int64()) for c in ("host", "page")]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(ids.view(np.int64)), pa.array(np.arange(n))], names=["host", "page", "suffix", "at"]
                )

    streams = silent.mapInArrow(suffixes, "host long, page long, suffix long, at long")
    shared = (
        streams.groupBy("host", "suffix").agg(F.min("page").alias("a"), F.max("page").alias("b")).filter("a != b").select("host", "suffix")
    )
    covered = (
        streams.join(shared, ["host", "suffix"], "left_semi").groupBy("host", "page").agg(F.collect_set("at").alias("covered"))
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, starts = batch.column("blocks").to_pylist(), batch.column("covered")
            kept = [
                without_boilerplate(b, s.values.to_numpy(), run) if s.is_valid else b for b, s in zip(lists, starts)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(kept, pa.list_(pa.string()))], names=["page_id", "url", "blocks"]
            )

    def cut_articles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, common = batch.column("blocks").to_pylist(), batch.column("common")
            kept = [without_common(b, c.values.to_numpy(), run) if c.is_valid else b for b, c in zip(lists, common)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(kept, pa.list_(pa.string()))], names=["page_id", "url", "blocks"]
            )

    out = "page_id long, url string, blocks array<string>"
    judged = silent.join(covered, ["host", "page"], "left").select("page_id", "url", "blocks", "covered").mapInArrow(cut, out)
    articles = declared.join(common_runs(declared, run), "host", "left").select("page_id", "url", "blocks", "common")
    both = (
        articles.mapInArrow(cut_articles, out).withColumn("from_structure", F.lit(True))
        .unionByName(judged.withColumn("from_structure", F.lit(False)))
    )
    text = F.array_join("blocks", "\n\n")
    return both.select("page_id", "url", text.alias("text"), F.length(text).cast("long").alias("n_chars"), "from_structure")
