"""Main text of web pages, with boilerplate found by a host suffix array.

A page is read as blocks with their places in the markup. Scripts, styles, forms
and the like are no text. Blocks in menus, headers, footers, sidebars, notices,
adverts and comments (by element, or a role, class or id that is such a name as a
whole or a fixed compound of it) are boilerplate; blocks in an article or main element
are content, also below a wrapper whose name is such a compound (``right-sidebar``),
but not below menus, comments and the like. Ids of headings and paragraphs, anchors
made of their text, say nothing. Where a page says neither, its host decides, also on blocks
beside an article (a headline, a second part, an unmarked menu). Only where a host has no
other page to compare, what stands beside an article is boilerplate.

The undecided and boilerplate blocks of each page are joined into one stream of
tokens, with a mark of its block at every token. Every token with ``run`` tokens from it
on starts a suffix, cut at that length. The suffixes of hosts with undecided blocks are
dealt in ranges of (host, suffix, page) and sorted there; a suffix whose neighbour has
all ``run`` tokens in common belongs to its group, and a group with two pages is a
repeated run. A group of very many pages spans several ranges, whose ends are
compared at last. Equal pages are one page.

Repeated runs are mapped back to blocks by the marks. Of an undecided block, the
covered tokens are boilerplate if they are the whole block or ``run`` of it at least;
fewer are the edge of a run in the block beside it, and stay. What lies between is kept.
A repeat of fewer than ``run`` tokens with nothing repeated beside it stays, too.

A null or empty html gives the empty text. Repeated rows give repeated results;
rows with one id and different html count as different pages. Other columns are
not read. Hosts with one page have no repeats, so all undecided text is kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from . import ragged

#: Elements whose content is no text, or no part of the article.
SILENT = {"script", "style", "noscript", "template", "head", "title", "svg", "math", "iframe", "object", "canvas", "audio", "video", "select", "textarea", "button", "form", "dialog"}
ASIDE = {"nav", "footer", "aside", "menu"}
CORE = {"article", "main"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
#: Names (a class, id or role as a whole) that mark boilerplate, also as parts of the fixed compounds that NAME allows.
HARD = r"ads?|advert\w*|breadcrumbs?|comments?|complementary|contentinfo|cookies?|consent|disqus|footer|gdpr|menu|nav|navbar|navigation|newsletter|promo\w*|related|replies|respond|sidebar|sidenav|sponsor\w*|subscribe"
SOFT = r"banner|masthead|modal|notices?|popup|share|sharing|skip|social|toolbar|widget"
LEADS = r"article|bottom|desktop|global|google|left|main|mobile|page|post|primary|right|secondary|site|sticky|sub|top|user"
TAILS = r"area|articles?|bar|block|body|bottom|box|btn|buttons?|container|content|form|header|heading|icons?|inner|items?|left|links?|list|main|nav|overlay|panel|policy|posts?|right|section|signup|slot|stories|thread|title|top|unit|wrap|wrapper|\d+"
NAME = re.compile(rf"(?:(?:{LEADS})[_-]+)*(?:{HARD}|{SOFT})(?:[_-]+(?:{HARD}|{SOFT}|{TAILS}))*", re.I)
#: Of these, the ones that hold no article of the page: a whole name, or lists of comments and related articles.
CLOSED = re.compile(rf"{HARD}|(?:(?:{LEADS})[_-]+)*(?:comments?|related|replies)(?:[_-]+(?:{TAILS}))*", re.I)
TOP = re.compile(r"(?:(?:site|page|top|global|main)[_-]+)?header", re.I)
#: Elements whose ids are anchors that follow their own text.
ANCHORED = {"p", "h1", "h2", "h3", "h4", "h5", "h6"}
#: A tag or comment that the page breaks off.
UNENDED = re.compile(r"<(?:!--(?:(?!-->).)*|[A-Za-z/!?][^<>]*)\Z", re.S)
BOILER, OPEN, CONTENT = 0, 1, 2
#: Within a page only: a wrapper whose name marks boilerplate, in which an article may still lie.
WRAPPER = 3
#: Undecided, on a page with an article.
BESIDE = 4
UNDECIDED = (OPEN, BESIDE)


class Blocks(HTMLParser):
    """Blocks of a page in order, as (kind, text); white space is one space, ends are trimmed."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, int, bool]] = []  # element, kind, silent
        self.kind, self.silent = OPEN, False
        self.parts: list[str] = []
        self.found: list[tuple[int, str]] = []

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        self.parts.clear()
        if text:
            self.found.append((BOILER if self.kind == WRAPPER else self.kind, text))

    def handle_starttag(self, tag, attrs):
        if tag in ("p", "li", "dt", "dd", "tr", "td", "th", "option"):
            self.close_open(tag)
        if tag not in INLINE:
            self.flush()
        elif tag in ("br", "img"):
            self.parts.append(" ")
        if tag in VOID:
            return
        names = [x for k, v in attrs if k in ("class", "role") or (k == "id" and tag not in ANCHORED) for x in (v or "").split()]
        kind, marked = self.kind, [x for x in names if NAME.fullmatch(x)]
        hidden = any(k == "hidden" or (k == "aria-hidden" and v == "true") for k, v in attrs)
        core, top = tag in CORE or "main" in names, any(map(TOP.fullmatch, names))
        if tag in ASIDE or (tag == "header" and kind != CONTENT):
            kind = BOILER
        elif kind == OPEN and core and (tag in CORE or not (marked or top)):
            kind = CONTENT
        elif kind == WRAPPER and core and not marked:
            kind = CONTENT
        elif tag in ("html", "body", "main"):
            pass
        elif marked and kind != BOILER:
            kind = BOILER if kind == CONTENT or any(map(CLOSED.fullmatch, marked)) else WRAPPER
        elif kind == OPEN and top:
            kind = WRAPPER
        if kind != self.kind:
            self.flush()
        self.stack.append((tag, self.kind, self.silent))
        self.kind, self.silent = kind, self.silent or tag in SILENT or hidden

    def close_open(self, tag: str) -> None:
        """End an element that the next one of its sort closes."""
        ends = {tag} if tag not in ("td", "th", "dt", "dd") else {"td", "th", "dt", "dd"}
        for name, _, _ in reversed(self.stack):
            if name in ends:
                self.handle_endtag(name)
                return
            if name not in INLINE:
                return

    def handle_endtag(self, tag):
        if tag == "p" and all(name != "p" for name, _, _ in self.stack):
            self.flush()
            return
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                if tag not in INLINE or self.stack[i][1] != self.kind:
                    self.flush()
                self.kind, self.silent = self.stack[i][1:]
                del self.stack[i:]
                return
            if tag in INLINE and self.stack[i][0] not in INLINE:
                return

    def handle_data(self, data):
        if not self.silent:
            self.parts.append(data)


def blocks(html: str) -> list[tuple[int, str]]:
    """Blocks of a page; those at its top level are undecided, also beside an article."""
    if not html:
        return []
    reader = Blocks()
    reader.feed(UNENDED.sub("", html))
    reader.close()
    reader.flush()
    found = reader.found
    if any(kind == CONTENT for kind, _ in found):
        found = [(BESIDE if kind == OPEN else kind, text) for kind, text in found]
    return found


def host(url: Column) -> Column:
    """Lower-case host of an address; empty where there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1), F.lit("")))


def pages_of(df: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    url = F.col(url_col).cast("string")
    return df.select(F.col(id_col).alias("id"), url.alias("url"), F.xxhash64(html_col).alias("page"), host(url).alias("host"), F.col(html_col).alias("html"))


def judged_blocks(pages: DataFrame) -> DataFrame:
    """id, url, page, host, open, blocks: all blocks of pages with undecided ones, of others those that are boilerplate."""

    def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [blocks(x.as_py() or "") for x in batch.column(4)]
        open_ = [any(kind in UNDECIDED for kind, _ in f) for f in found]
        kept = [f if o else [b for b in f if b[0] != CONTENT] for f, o in zip(found, open_, strict=True)]
        kind = pa.list_(pa.struct([pa.field("kind", pa.int32()), pa.field("text", pa.string())]))
        rows = pa.array([[{"kind": k, "text": t} for k, t in f] for f in kept], kind)
        return pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(open_), rows], ["id", "url", "page", "host", "open", "blocks"])

    kind = pages.schema["id"].dataType.simpleString()
    return ragged.map_batches(pages, lambda: handle, f"id {kind}, url string, page long, host string, open boolean, blocks array<struct<kind:int,text:string>>")


def _texts(batch: pa.RecordBatch, keep: list[bool], texts: list[str]) -> pa.RecordBatch:
    rows = pa.array(keep)
    return pa.RecordBatch.from_arrays(
        [batch.column(0).filter(rows), batch.column(1).filter(rows), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["id", "url", "text", "n_chars"]
    )


def decided_texts(pages: DataFrame) -> DataFrame:
    """id, url, text, n_chars of the pages that have no undecided blocks; their texts are not shuffled."""

    def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [blocks(x.as_py() or "") for x in batch.column(4)]
        keep = [all(kind not in UNDECIDED for kind, _ in f) for f in found]
        return _texts(batch, keep, ["\n\n".join(t for kind, t in f if kind == CONTENT) for f, k in zip(found, keep, strict=True) if k])

    kind = pages.schema["id"].dataType.simpleString()
    return ragged.map_batches(pages, lambda: handle, f"id {kind}, url string, text string, n_chars long")


def suffixes(streams: DataFrame, run: int) -> DataFrame:
    """host, suffix, page, at: every suffix of ``run`` tokens of the pages' streams (host, page, texts)."""
    tokens = streams.select("host", "page", F.split(F.array_join("texts", " "), " ").alias("tokens")).where(F.size("tokens") >= run)
    at = F.explode(F.sequence(F.lit(0), F.size("tokens") - run)).alias("at")
    return tokens.select("host", "page", "tokens", at).select("host", F.array_join(F.slice("tokens", F.col("at") + 1, run), " ").alias("suffix"), "page", "at")


def _neighbours():
    """Of sorted suffixes, those in groups with several pages, and the first and last group of a range.

    Rows have host, page, at (null for what a whole end group says), low, high and
    suffix; the last three are null where the group is known to be repeated.
    """
    schema = pa.schema([("host", pa.string()), ("page", pa.int64()), ("at", pa.int32()), ("low", pa.int64()), ("high", pa.int64()), ("suffix", pa.string())])

    def rows(hosts: pa.Array, pages: pa.Array, ats: pa.Array, suffix: str | None = None) -> pa.RecordBatch:
        n = len(pages)
        return pa.RecordBatch.from_arrays([hosts.cast(pa.string()), pages, ats, pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array([suffix] * n, pa.string())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, first = None, [], True  # a group that may go on in the next batch

        def closed(end: bool) -> Iterator[pa.RecordBatch]:
            group = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            low, high = group["page"][0].as_py(), group["page"][-1].as_py()
            if end:  # its other pages may lie in the range beside
                yield pa.RecordBatch.from_pylist([{"host": key[0], "suffix": key[1], "low": low, "high": high}], schema)
            if end or low != high:
                yield rows(pa.array([key[0]] * group.num_rows, pa.string()), group["page"], group["at"], key[1] if end else None)

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            hosts, suffix, pages, ats = batch.columns
            differ = pa.compute.or_(*[pa.compute.not_equal(x[1:], x[: n - 1]) for x in (hosts, suffix)]).to_numpy(zero_copy_only=False)
            cuts = np.concatenate(([0], np.flatnonzero(differ) + 1, [n]))
            now, at = (hosts[0].as_py(), suffix[0].as_py()), 0
            key = now if key is None else key
            if now == key:
                held.append(batch.slice(0, cuts[1]).select(["page", "at"]))
                at = 1
                if cuts[1] == n:
                    continue
            yield from closed(first)
            first = False
            low, high, p = cuts[at:-2], cuts[at + 1 : -1], pages.to_numpy()
            several = pa.array(np.repeat(p[low] != p[high - 1], high - low), pa.bool_())
            own = slice(int(cuts[at]), int(cuts[-2]))
            if pa.compute.any(several).as_py():
                yield rows(*[x[own].filter(several) for x in (hosts, pages, ats)])
            last = int(cuts[-2])
            key, held = (hosts[last].as_py(), suffix[last].as_py()), [batch.slice(last).select(["page", "at"])]
        if key is not None:
            yield from closed(True)

    return run, "host string, page long, at int, low long, high long, suffix string"


def repeated_runs(streams: DataFrame, run: int) -> DataFrame:
    """host, page, covered: the places in the pages' streams (host, page, texts) where runs start that another page of the host has."""
    dealt = suffixes(streams, run).repartitionByRange("host", "suffix", "page").sortWithinPartitions("host", "suffix", "page").select("host", "suffix", "page", "at")
    find, schema = _neighbours()
    found = written(dealt.mapInArrow(ragged.per_task(find), schema), "neighbours")
    ends = found.where("at IS NULL").groupBy("host", "suffix").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low != high").select("host", "suffix")
    open_ = found.where("at IS NOT NULL AND suffix IS NOT NULL").join(F.broadcast(ends), ["host", "suffix"])  # two groups of each range at most
    hits = found.where("at IS NOT NULL AND suffix IS NULL").select("host", "page", "at").union(open_.select("host", "page", "at"))
    return hits.groupBy("host", "page").agg(F.collect_set("at").alias("covered"))  # places of one page


def unique_runs(blocks: list[dict], covered: list[int] | None, run: int, compared: bool) -> list[str]:
    """Texts of a page's content, and what is left of its undecided blocks between the repeated runs.

    Blocks beside an article are left out where the host has no other page (not ``compared``).
    """
    places = np.asarray(covered or [], np.int64)
    size = sum(b["text"].count(" ") + 1 for b in blocks if b["kind"] != CONTENT)
    edges = np.bincount(places, minlength=size + run + 1) - np.bincount(places + run, minlength=size + run + 1)
    hit, at, out = np.cumsum(edges) > 0, 0, []
    for b in blocks:
        if b["kind"] == CONTENT:
            out.append(b["text"])
            continue
        tokens = b["text"].split(" ")
        own = hit[at : at + len(tokens)]
        at += len(tokens)
        if b["kind"] != OPEN and not (b["kind"] == BESIDE and compared):
            continue
        bounds = [0, *(np.flatnonzero(np.diff(own)) + 1).tolist(), len(tokens)]
        kept = np.ones(len(tokens), bool)
        for low, high in zip(bounds[:-1], bounds[1:], strict=True):
            if own[low] and (high - low >= run or high - low == len(tokens)):
                kept[low:high] = False
        bounds = [0, *(np.flatnonzero(np.diff(kept)) + 1).tolist(), len(tokens)]
        out += [" ".join(tokens[low:high]) for low, high in zip(bounds[:-1], bounds[1:], strict=True) if kept[low]]
    return out


def main_text(df: DataFrame, run: int = 8, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id column, url, text (blocks joined by an empty line), n_chars.

    Pages are read twice: for the blocks to judge, which are written, and for the
    texts that need no judgement. Only pages with undecided blocks are shuffled.
    """
    pages = pages_of(df, id_col, url_col, html_col)
    judged = written(judged_blocks(pages), "judged")
    open_ = judged.where("open")
    hosts = judged.groupBy("host").agg(F.max("open").alias("_open"), (F.min("page") != F.max("page")).alias("compared"))
    hosts = hosts.where("_open").drop("_open")  # elsewhere no repeat decides
    streams = judged.select("host", "page", F.transform(F.filter("blocks", lambda b: b["kind"] != CONTENT), lambda b: b["text"]).alias("texts"))
    streams = streams.where(F.size("texts") > 0).join(hosts.where("compared"), "host", "left_semi").dropDuplicates(["host", "page"])
    repeats = repeated_runs(written(streams, "streams"), run)
    joined = open_.join(repeats, ["host", "page"], "left").join(hosts, "host").select("id", "url", "blocks", "covered", "compared")

    def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = zip(*[batch.column(i) for i in (2, 3, 4)], strict=True)
        texts = ["\n\n".join(unique_runs(found.as_py(), covered.as_py(), run, compared.as_py())) for found, covered, compared in rows]
        return _texts(batch, [True] * len(texts), texts)

    kind = df.schema[id_col].dataType.simpleString()
    judged_texts = ragged.map_batches(joined, lambda: handle, f"id {kind}, url string, text string, n_chars long")
    return decided_texts(pages).union(judged_texts).withColumnRenamed("id", id_col)
