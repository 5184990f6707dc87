"""Main text of web pages by consensus paths of their host.

Every page is read into containers (elements that hold blocks of text).  A
container's score is the prose it holds less twice the other text it holds;
text of menus, footers, adverts, comments and the like counts for nothing.
Pages vote with these scores for generalised paths of tags and classes, the
votes are summed per host in Spark, and each page is read again with the
winning paths of its host.
"""

from __future__ import annotations

import hashlib
import html as references
import re
from collections.abc import Iterator

import pyarrow as pa
import pyspark.sql.types as T
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Paths that a host keeps.  A page on which none of them holds enough of its prose is read with its own best path, so a host of more kinds of pages loses consensus on the rarest, but no text.
WINNERS = 8
#: Characters of a step of a path; a longer step ends in a hash of the whole.
STEP_CHARS = 80
#: Elements below this depth are part of the container above them.
DEPTH = 24
#: A host's path is used on a page where it scores at least this share of the page's own best.
SHARE = 0.5
#: Bytes of winning paths that are broadcast at most; more of them are joined by a salted shuffle.
BROADCAST_BYTES = 32 << 20
#: Pages of one host per salt of that join.
SALT_PAGES = 20_000

#: Tags without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Tags whose content is no markup.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: Tags that never hold an article's text.
DROPPED = frozenset(
    "head script style textarea title xmp iframe noembed noframes noscript template svg math canvas audio video object applet map"
    " nav footer aside dialog menu button select datalist option fieldset legend label".split()
)
#: Tags that begin a block of text of their own.
BLOCK = frozenset(
    "html body address article blockquote center dd details div dl dt figcaption figure h1 h2 h3 h4 h5 h6 header hgroup hr li main ol p pre search section summary"
    " table caption tbody td tfoot th thead tr ul nav footer aside form dialog menu fieldset legend".split()
)
#: Blocks that can be containers.
CONTAINERS = frozenset("html body article main section div td blockquote center header hgroup details".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Tags that an opening tag of the same group closes, and what stops the search.
CLOSED_BY = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select", "datalist"})}
#: Words that, first or last in a class, id or role, mark what is no article text.
ASIDE = frozenset(
    "nav navbar navigation menu menubar header masthead topbar footer foot colophon sidebar aside complementary contentinfo notice notices cookie cookies consent gdpr banner alert warning"
    " ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion comment comments commentlist discussion reply replies respond disqus share sharing social related recommended recommendations"
    " breadcrumb breadcrumbs newsletter subscribe subscription signup login search searchbox form widget pagination pager popup modal overlay toolbar toc copyright skip hidden".split()
)
#: Names of article containers, and beginnings of names that only describe a layout.
ARTICLE = frozenset("content article main post entry story maincontent articlebody postbody entrycontent hentry".split())
LAYOUT = frozenset("no has with without is js".split())

_TAG = re.compile(r"""<(?:!--.*?(?:--!?>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*+>|[^>]*+(?:>|\Z))|[!?/][^>]*(?:>|\Z))""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
_NAME = re.compile(r"[a-z]+|\d+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_DIGITS = re.compile(r"\d+")
_raw_end = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)", re.I) for t in RAW}
_classed: dict[tuple[str, str], tuple[str, bool, bool]] = {}


def _judged(tag: str, source: str) -> tuple[str, bool, bool]:
    """Of a tag and its attributes: its step in a path, whether it is put aside, and whether it is named an article."""
    key = (tag, source)
    if (known := _classed.get(key)) is not None:
        return known
    attributes = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(source)}
    names = f"{attributes.get('class', '')} {attributes.get('id', '')}".split()
    role = attributes.get("role", "").lower()
    named = role in ("main", "article") or attributes.get("itemprop", "").lower() == "articlebody"
    away = role in ("navigation", "banner", "contentinfo", "complementary", "search", "menu", "menubar", "dialog", "alert", "form")
    for name in names:
        words = _NAME.findall(_CAMEL.sub("-", name).lower())
        if not words or words[0] in LAYOUT:
            continue
        named |= words == ["content"] or "".join(words) in ARTICLE or (words[0] in ARTICLE and words[-1] in ("content", "body", "text", "wrapper", "inner"))
        away |= words[0] in ASIDE or words[-1] in ASIDE or (words[-1].isdigit() and len(words) > 1 and words[-2] in ASIDE)
    hidden = "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attributes.get("style", ""), re.I) is not None
    step = ".".join([tag, *sorted({_DIGITS.sub("N", c.lower()) for c in attributes.get("class", "").split()})])
    if len(step) > STEP_CHARS:
        step = f"{step[:STEP_CHARS]}~{hashlib.md5(step.encode()).hexdigest()}"
    found = step, hidden or (away and not named and tag not in ("html", "body", "main", "article", "form")), named or tag in ("article", "main")
    if len(_classed) > 50_000:
        _classed.clear()
    _classed[key] = found
    return found


class Page:
    """Blocks and containers of a page, in page order.

    ``containers`` are (parent, path, named); ``blocks`` are (container, text,
    share of linked characters, tag if a heading).  A form is put aside unless it
    is wrapped around the page, holding half of its prose or more.
    """

    def __init__(self, html: str) -> None:
        self.containers: list[tuple[int, str, bool]] = [(-1, "", False)]
        self.blocks: list[tuple[int, str, float, str]] = []
        self._read(html)
        self.scores = self._scores()

    def _read(self, html: str) -> None:
        stack: list[tuple[str, int, int, int]] = []  # tag, container, and what it adds to aside and to link
        aside = links = linked = 0
        here, heading = 0, ""
        parts: list[str] = []
        forms: list[int] = []  # of each block the form that holds it, 0 for none
        form = opened = 0

        def end_block() -> None:
            nonlocal linked
            if parts:
                text = " ".join("".join(parts).split())
                if text:
                    self.blocks.append((here, text, min(1.0, linked / len(text)), heading))
                    forms.append(form)
                parts.clear()
            linked = 0

        def pop(n: int) -> None:
            nonlocal aside, links, here, form
            while len(stack) > n:
                t, _, a, b = stack.pop()
                if t == "form":
                    form = 0
                aside -= a
                links -= b
            here = stack[-1][1] if stack else 0

        at, end = 0, len(html)
        while at < end:
            m = _TAG.search(html, at)
            stop = m.start() if m else end
            if stop > at and not aside:
                text = html[at:stop]
                if "&" in text:
                    text = references.unescape(text)
                parts.append(text)
                if links:
                    linked += len(text)
            if m is None:
                break
            at = m.end()
            tag = m[2]
            if tag is None:
                continue
            tag = tag.lower()
            if m[1]:
                if tag in BLOCK:
                    end_block()
                    heading = ""
                elif tag == "br":
                    parts.append(" ")
                    continue
                for n in range(len(stack) - 1, -1, -1):
                    if stack[n][0] == tag:
                        pop(n)
                        break
                continue
            if at == end and not m[0].endswith(">"):  # the page was cut inside this tag
                break
            if tag in VOID:
                if tag == "hr":
                    end_block()
                elif tag == "br" and not aside:
                    parts.append(" ")
                continue
            if tag in RAW:
                close = _raw_end[tag].search(html, at)
                at = close.start() if close else end
                if close is None:
                    break
                close = _TAG.match(html, at)
                at = close.end() if close else end
                continue
            block = tag in BLOCK
            if block:
                end_block()
                heading = tag if tag in HEADINGS else ""
                # a block ends an open paragraph
                n = len(stack) - 1
                while n >= 0 and stack[n][0] not in BLOCK:
                    n -= 1
                if n >= 0 and stack[n][0] == "p":
                    pop(n)
                if tag in CLOSED_BY:
                    closes, stops = CLOSED_BY[tag]
                    for n in range(len(stack) - 1, -1, -1):
                        if stack[n][0] in stops:
                            break
                        if stack[n][0] in closes:
                            pop(n)
                            if tag != "tr":
                                break
            step, away, named = _judged(tag, m[3])
            if tag == "header" and not away:
                # a page's header is put aside; an article's own header keeps its text
                away = not any(t in ("article", "main") for t, _, _, _ in stack)
            away = away or tag in DROPPED
            container = here
            if block and not away and not aside and tag in CONTAINERS and len(stack) < DEPTH:
                self.containers.append((here, f"{self.containers[here][1]}/{step}", named))
                container = len(self.containers) - 1
            if block or away or tag == "a":
                if tag == "form" and not form:
                    opened += 1
                    form = opened
                stack.append((tag, container, int(away), int(tag == "a")))
                aside += away
                links += tag == "a"
                here = container
        end_block()
        if opened:
            prose = [0] * (opened + 1)
            for (_, text, linked, h), f in zip(self.blocks, forms, strict=True):
                prose[f] += len(text) if h or self._prose(text, linked) else 0
            wrapped = {0, *(f for f in range(1, opened + 1) if prose[f] and 2 * prose[f] >= sum(prose))}
            self.blocks = [b for b, f in zip(self.blocks, forms, strict=True) if f in wrapped]

    @staticmethod
    def _prose(text: str, linked: float) -> bool:
        return linked < 0.5 and (len(text) >= 80 or text[-1] in ".!?…:;\"'»”’)" or text.count(" ") >= 12)

    def _scores(self) -> dict[str, float]:
        """Score per path."""
        total = [0.0] * len(self.containers)
        for c, text, linked, heading in self.blocks:
            n = len(text)
            prose = heading or self._prose(text, linked)
            total[c] += n * (1.0 - linked) if prose else -2.0 * n * linked - 0.5 * n * (1.0 - linked)
        for c in range(len(total) - 1, 0, -1):
            total[self.containers[c][0]] += total[c]
        found: dict[str, float] = {}
        inside = [False] * len(total)
        for c in range(len(total)):
            parent, path, named = self.containers[c]
            inside[c] = named or (parent >= 0 and inside[parent])
            found[path] = found.get(path, 0.0) + total[c] * (1.25 if inside[c] else 1.0)
        return found

    def votes(self) -> list[tuple[str, float]]:
        """The paths of some prose, best first; of equal scores the outermost comes first."""
        return sorted(((p, s) for p, s in self.scores.items() if s > 0), key=lambda x: (-x[1], x[0].count("/"), x[0]))

    def text(self, path: str | None) -> str:
        """Blocks of the outermost containers at ``path``, one to a line, led by a title that stands just before them."""
        if path is None:
            return ""
        kept = [False] * len(self.containers)
        for c, (parent, p, _) in enumerate(self.containers):
            kept[c] = p == path or (parent >= 0 and kept[parent])
        own = [i for i, b in enumerate(self.blocks) if kept[b[0]]]
        if own and own[0] and self.blocks[own[0] - 1][3] == "h1" and not any(self.blocks[i][3] == "h1" for i in own):
            own.insert(0, own[0] - 1)
        return "\n".join(self.blocks[i][1] for i in own)

    def best(self, host_paths: list[str] | None) -> str | None:
        """The host's first path that holds enough of this page, else the page's own best.

        A page without prose, such as a table or a few short lines, is read at
        the host's first path that holds more text than links, else at the
        article or main part that holds most.
        """
        own = self.votes()
        if not own:
            held = self._unlinked()
            for path in host_paths or ():
                if held.get(path, (0.0, False))[0] > 0:
                    return path
            named = sorted(((-n, path.count("/"), path) for path, (n, name) in held.items() if name and n > 0))
            return named[0][2] if named else None
        for path in host_paths or ():
            if self.scores.get(path, 0.0) >= SHARE * own[0][1]:
                return path
        return own[0][0]

    def _unlinked(self) -> dict[str, tuple[float, bool]]:
        """Per path how much more text than link text it holds, and whether it is named as an article's."""
        total = [0.0] * len(self.containers)
        for c, text, linked, _ in self.blocks:
            total[c] += len(text) * (1.0 - 2.0 * linked)
        for c in range(len(total) - 1, 0, -1):
            total[self.containers[c][0]] += total[c]
        found: dict[str, tuple[float, bool]] = {}
        for (_, path, named), n in zip(self.containers, total, strict=True):
            before = found.get(path, (0.0, False))
            found[path] = before[0] + n, before[1] or named
        return found


def host_of(url: str):
    """The host of a URL column in lower case, without user and port; null where there is none."""
    host = F.regexp_extract(F.lower(F.col(url)), r"^(?:[a-z][a-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(host != "", host)


def _voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[tuple[str, str], list] = {}
    for batch in common.text_groups(batches, text="html"):
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            for path, score in Page(html or "").votes():
                held = sums.setdefault((host, path), [0.0, 0])
                held[0] += score
                held[1] += 1
        if len(sums) > 100_000:
            yield _vote_rows(sums)
            sums = {}
    if sums:
        yield _vote_rows(sums)


def _vote_rows(sums: dict[tuple[str, str], list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([k[0] for k in sums], pa.string()), pa.array([k[1] for k in sums], pa.string()), pa.array([v[0] for v in sums.values()], pa.float64()), pa.array([v[1] for v in sums.values()], pa.int64())], names=["host", "path", "score", "pages"])


def consensus_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, paths): per host its best generalised paths, best first.

    Tasks sum the votes of their own pages before the shuffle, so a host with
    any number of pages reaches a task as a few rows.
    """
    rows = pages.select(host_of(url_col).alias("host"), F.col(html_col).alias("html")).where("host IS NOT NULL AND html IS NOT NULL")
    votes = rows.mapInArrow(_voted, "host string, path string, score double, pages bigint").groupBy("host", "path").agg(F.sum("score").alias("score"))
    order = Window.partitionBy("host").orderBy(F.desc("score"), F.length("path"), "path")
    best = votes.withColumn("place", F.row_number().over(order)).where(F.col("place") <= WINNERS)
    return best.groupBy("host").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "path"))), lambda x: x["path"]).alias("paths"))


def _with_paths(pages: DataFrame, winners: DataFrame) -> DataFrame:
    """Joins each page with its host's paths, by broadcast if these are few, else by a join salted for large hosts."""
    size = winners.agg(F.sum(F.length("host") + F.length(F.array_join("paths", ""))).alias("n")).first().n or 0
    if size <= BROADCAST_BYTES:
        return pages.join(F.broadcast(winners), "host", "left")
    salts = pages.groupBy("host").agg(F.ceil(F.count("*") / SALT_PAGES).cast("int").alias("salts"))
    dealt = winners.join(salts, "host").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    small = salts.where("salts > 1")
    salted = pages.join(small, "host", "left").withColumn("salt", F.coalesce(F.pmod(F.xxhash64("html"), F.col("salts")).cast("int"), F.lit(0))).drop("salts")
    return salted.join(dealt.drop("salts"), ["host", "salt"], "left").drop("salt")


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page its id, url, ``text``, ``n_chars`` (code points) and the ``path`` that was used.

    A null, empty or text-less page has an empty text and a null path; a page
    without a host is read with its own best path.  A page that is cut off in a
    tag loses that tag alone.  Repeated rows are kept, each read for itself, and
    a path's score ties go to the outer, then to the alphabetically first path.
    Pages of any length are read whole; other columns are never read, and an
    empty table gives an empty result.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host_of(url_col).alias("host"))
    winners = common.written(consensus_paths(pages, url_col, html_col), "host-paths")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in common.text_groups(batches, text="html"):
            texts, used = [], []
            for html, paths in zip(group.column("html").to_pylist(), group.column("paths").to_pylist(), strict=True):
                page = Page(html or "")
                used.append(page.best(paths))
                texts.append(page.text(used[-1]))
            yield pa.RecordBatch.from_arrays([group.column("id"), group.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64()), pa.array(used, pa.string())], names=[id_col, url_col, "text", "n_chars", "path"])

    fields = [T.StructField(id_col, pages.schema[id_col].dataType), T.StructField(url_col, pages.schema[url_col].dataType), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("path", T.StringType())]
    return _with_paths(rows, winners).select("id", "url", "html", "paths").mapInArrow(read, T.StructType(fields))
