"""Operator 3: main text of web pages by consensus container paths of their hosts.

Each page's containers are scored by the text of their blocks outside links and boilerplate; the page votes for the path of its
best container or of the article around it, written as tags with generalised classes. Spark sums the votes of each host; pages are then read
again and cut by the paths that won on their host.

A page is read in time near its length, however broken: every step of the scan moves on past what it has looked at.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from narrative_spark.llm.common import join_dealt, materialize, text_or_empty, tidy, unused

#: A path wins with this share of its host's votes. Bytes of hosts and winners that are sent to all tasks at most; beyond it, they are joined by a shuffle.
SHARE, SENT_BYTES = 0.1, 16 << 20
#: Kinds of elements.
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br".split())
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre td th caption figcaption summary address hr tr thead tbody tfoot".split())
HIDDEN = frozenset("script style noscript template svg math textarea select option iframe object canvas head title audio video map datalist".split())
RAW = frozenset("script style textarea title noscript template iframe svg".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILERPLATE = frozenset("nav header footer aside button dialog menu".split())
FORMS = frozenset("form fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
#: Parts of class names and ids that speak of boilerplate, those of reader comments, those that turn a name's sense, and those after which "header" means an article's own.
NAMES = frozenset("nav navbar navigation menu submenu header masthead topbar footer sidebar side aside ad ads adv advert advertisement advertising banner promo promotion sponsor sponsored cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription signup login register paywall share sharing social breadcrumb breadcrumbs related recommended recommendations widget toolbar pagination pager search skip hidden".split())
COMMENTS = frozenset("comment comments commentlist discussion discussions disqus reply replies respond".split())
TURNED = frozenset("has have is no not non with without free less".split())
KINDS_OF = frozenset("category tag type format status".split())
OWN = frozenset("article entry post story content".split())
#: Elements without an end tag that another one ends.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"td", "th", "tr"}} | {t: {"td", "th", "tr", "thead", "tbody", "tfoot"} for t in ("thead", "tbody", "tfoot")}
#: What makes attributes worth reading.
_TELLING = re.compile(r"class|id|hidden|style|role", re.I)
_NAME = re.compile(r"</?+([a-zA-Z][^\s/>]*+)")
_QUOTED = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+""")
_ATTRIBUTE = re.compile(r"""(?<![a-zA-Z-])([a-zA-Z-]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?+""")
_PLAIN, _SOFT, _TALK, _FORM, _HARD = range(5)


class Block(NamedTuple):
    path: int  # of the page's paths
    text: str
    links: int  # code points inside links
    good: bool  # outside boilerplate
    leaf: str = ""  # the element that it stands in, where that is a leaf
    title: bool = False  # a headline in a header that names itself an article's own


class Page:
    """Blocks of text in page order, and the distinct paths of containers: parent, step and depth of each, parents first. Path 0 is the page."""

    def __init__(self):
        self.parent, self.step, self.depth, self.article = [0], [""], [0], [0]
        self.number: dict[tuple[int, str], int] = {}
        self.blocks: list[Block] = []

    def child(self, parent: int, step: str) -> int:
        found = self.number.get((parent, step))
        if found is None:
            found = self.number[parent, step] = len(self.step)
            self.parent.append(parent)
            self.step.append(step)
            self.depth.append(self.depth[parent] + 1)
            self.article.append(self.depth[-1] if step.split(".", 1)[0] == "article" else self.article[parent])
        return found

    def chain(self, path: int) -> list[int]:
        """The paths from the page down to path, without the page itself."""
        out = []
        while path:
            out.append(path)
            path = self.parent[path]
        return out[::-1]

    def name(self, path: int) -> str:
        return " ".join(self.step[p] for p in self.chain(path))

    def find(self, name: str) -> int | None:
        path: int | None = 0
        for step in name.split(" ") if name else []:
            path = self.number.get((path, step))
            if path is None:
                return None
        return path


class _Element:
    """An element while a page is read. mark: what it says of itself; size, h1, main and article: what is inside it."""

    __slots__ = ("parent", "tag", "path", "mark", "head", "own", "leaf", "size", "h1", "main", "article", "bad", "cause", "inner", "direct")

    def __init__(self, parent, tag, path, mark, head, own=False, leaf=False):
        self.parent, self.tag, self.path, self.mark, self.head, self.own, self.leaf = parent, tag, path, mark, head, own, leaf
        self.size, self.h1, self.main, self.article = 0, False, tag == "main", tag == "article"


def _words(names: str) -> list[list[str]]:
    """The parts of each class name or id, digits taken out."""
    return [[p for p in re.split(r"[-_\d]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", w).lower()) if p] for w in names.split()]


def _step(tag: str, names: dict[str, str]) -> str:
    """An element as a path step: tag and classes, digits taken out."""
    words = [re.sub(r"\d+", "", w).strip("-_") for w in names.get("class", "").lower().split()]
    return ".".join([tag, *sorted({w for w in words if w})])


def _hints(names: dict[str, str]) -> tuple[int, bool, bool]:
    """(what class names and id say, whether only of a header, whether of an article's own header). They are hints, which content may outweigh."""
    soft, heads, own = False, True, False
    for parts in _words(names.get("class", "") + " " + names.get("id", "")):
        if not parts or parts[0] in KINDS_OF or not TURNED.isdisjoint(parts):
            continue
        if not COMMENTS.isdisjoint(parts):
            return _TALK, False, False
        hints = NAMES.intersection(parts)
        if hints <= {"header"} and not OWN.isdisjoint(parts):
            own |= bool(hints)
            continue
        if hints:
            soft, heads = True, heads and hints <= {"header", "masthead"}
    return (_SOFT, heads, False) if soft else (_PLAIN, False, own)


def _unseen(names: dict[str, str]) -> bool:
    """Whether an element says that it isn't shown, or that it is no text of the page."""
    return names.get("role", "").lower() in ROLES or "hidden" in names or names.get("aria-hidden") == "true" or re.search(r"display\s*+:\s*+none", names.get("style", "")) is not None


def _mark(tag: str, names: dict[str, str]) -> tuple[int, bool, bool]:
    """(what an element says of itself, whether it is a header, whether it names itself an article's own)."""
    if tag in ("html", "body"):
        return _PLAIN, False, False
    if tag in HIDDEN or tag in BOILERPLATE or _unseen(names):
        return _HARD, tag == "header", tag == "header" and _hints(names)[2]
    if tag in ("main", "article"):
        return _PLAIN, False, False
    if tag in FORMS:
        return _FORM, False, False
    mark, heads, _ = _hints(names)
    return mark, heads, False


def _small_mark(names: dict[str, str]) -> int:
    """What a leaf or an inline element says of itself; names of headers don't count."""
    if _unseen(names):
        return _HARD
    mark, heads, _ = _hints(names)
    return _PLAIN if heads else mark


def _attributes(rest: str) -> dict[str, str]:
    names: dict[str, str] = {}
    if _TELLING.search(rest):
        for n, a, b, c in _ATTRIBUTE.findall(rest):
            names.setdefault(n.lower(), unescape(a or b or c))
    return names


def _spared(e: _Element, total: int) -> bool:
    """Whether an element that names or tags speak against holds the page's own text: the main element, or most of the text with what articles have."""
    if e.mark == _HARD or e.main:
        return e.mark != _HARD
    if 2 * e.size <= total:
        return False
    return e.h1 or e.mark == _FORM or (e.mark == _SOFT and (e.article or 5 * e.size >= 4 * total))


def read(html: str) -> Page:
    """A page's blocks, white space as single spaces and references decoded. Bad mark-up is read as it comes: unclosed elements end with their
    parents, a tag, comment or script without an end takes the rest of the page with it."""
    page, root = Page(), _Element(None, "", 0, _PLAIN, False)
    elements, stack, open_ = [root], [root], Counter()
    raw: list[tuple[_Element, str, str, str, int]] = []  # element, leaf, text, text without what inline elements' names speak against, links
    leaf, words, sure, links, in_link, at = "", [], [], 0, 0, 0
    muted, depth, mute = "", 0, _PLAIN  # the inline element whose text doesn't count, and how many of its kind are open
    last, trusted = html.rfind(">"), 0  # quotes in tags before trusted don't close

    def flush() -> None:
        nonlocal links
        if words:
            text = " ".join("".join(words).split())
            if text:
                raw.append((stack[-1], leaf, text, text if len(sure) == len(words) else " ".join("".join(sure).split()), links))
            words.clear()
            sure.clear()
        links = 0

    def say(piece: str) -> None:
        nonlocal links
        if piece and mute != _HARD:
            words.append(text := unescape(piece))
            if not depth:
                sure.append(text)
                if in_link:
                    links += len(text)

    def end_leaves(tags: set[str]) -> None:
        """Close the marked leaves on top of the stack, down to the lowest of tags among them. No two of one kind stand on each other, so that there are few."""
        k = len(stack)
        while k > 1 and stack[k - 1].leaf:
            k -= 1
        while k < len(stack) and stack[k].tag not in tags:
            k += 1
        for gone in stack[k:]:
            open_[gone.tag] -= 1
        del stack[k:]

    while (sign := html.find("<", at)) >= 0:
        m = _NAME.match(html, sign)
        if m is None:
            if html.startswith(("<!", "<?"), sign):
                say(html[at:sign])
                end = html.find("-->", sign + 4) + 3 if html.startswith("<!--", sign) else html.find(">", sign) + 1
                at = end if end > sign + 1 else len(html)
            else:
                say(html[at : sign + 1])
                at = sign + 1
            continue
        say(html[at:sign])
        if m.end() > last:
            at = len(html)
            break
        end = m.end()
        if sign >= trusted:
            end = _QUOTED.match(html, m.end()).end()
            if html[end : end + 1] != ">":
                trusted, end = end, m.end()
        end = html.find(">", end)
        close, tag, rest, at = html[sign + 1] == "/", m[1].lower(), html[m.end() : end], end + 1
        if tag in INLINE:
            if depth and tag == muted:
                depth += -1 if close else 1 if tag not in VOID else 0
                mute = mute if depth else _PLAIN
            elif not depth and not close and tag not in VOID and _TELLING.search(rest):
                said = _small_mark(_attributes(rest))
                if said == _HARD or (said != _PLAIN and leaf != "pre"):
                    muted, depth, mute = tag, 1, said
            if tag == "br":
                words.append(" ")
                sure.append(" ")
            elif tag == "a":
                in_link = max(0, in_link + (-1 if close else 1))
            continue
        flush()
        in_link, depth, mute = 0, 0, _PLAIN
        if close:
            leaf = ""
            if tag in LEAVES:
                end_leaves({tag})
            elif open_[tag]:
                while True:
                    gone = stack.pop()
                    open_[gone.tag] -= 1
                    if gone.tag == tag:
                        break
            continue
        if stack[-1].leaf:
            end_leaves(ENDS.get(tag, {"p", tag}))
        if tag in RAW and not (tag == "svg" and rest.endswith("/")):
            found = re.compile(rf"</{tag}\s*+>", re.I).search(html, at)
            at = found.end() if found else len(html)
        elif tag in LEAVES:
            leaf = tag
            said = _small_mark(_attributes(rest)) if tag not in VOID else _PLAIN
            if said != _PLAIN:
                stack.append(_Element(stack[-1], tag, stack[-1].path, said, False, leaf=True))
                elements.append(stack[-1])
                open_[tag] += 1
            stack[-1].h1 |= tag == "h1"
        elif tag not in VOID and not rest.endswith("/"):
            names = _attributes(rest)
            leaf = ""
            mark, head, own = _mark(tag, names)
            stack.append(_Element(stack[-1], tag, page.child(stack[-1].path, _step(tag, names)), mark, head, own))
            elements.append(stack[-1])
            open_[tag] += 1
    say(html[at:])
    flush()
    _judge(elements, raw, page)
    return page


def _judge(elements: list[_Element], raw: list[tuple[_Element, str, str, str, int]], page: Page) -> None:
    """Decide which blocks are boilerplate, from what elements say and from how much text they hold."""
    for e in elements:
        e.bad = e.mark == _HARD or (e.parent is not None and e.parent.bad)
    for e, _, text, _, _ in raw:
        if not e.bad:
            e.size += len(text)
    for e in reversed(elements[1:]):
        up = e.parent
        if not e.bad:
            up.size += e.size
        up.h1, up.main, up.article = up.h1 or e.h1, up.main or e.main, up.article or e.article
    total = elements[0].size
    for hints in (True, False):  # names count for nothing where nothing would be left
        for e in elements:
            up = e.parent
            own = e.mark == _HARD or (hints and e.mark != _PLAIN and not _spared(e, total))
            e.bad = own or (up is not None and up.bad)
            # The outermost element that makes it boilerplate, and whether an article or main is around it.
            e.cause = up.cause if up is not None and up.bad else e if own else None
            e.inner = (up is not None and up.inner) or e.tag in ("article", "main")
            e.direct = e.cause is e or (up is not None and up.direct and e.mark == _PLAIN)
        # A headline keeps its place when the page wraps it in its article's own header.
        headline = lambda e, leaf: leaf in ("h1", "h2") and e.direct and e.cause.head and (e.cause.inner or e.cause.own)
        page.blocks = []
        for e, leaf, text, sure, links in raw:
            head = e.bad and headline(e, leaf)
            if shown := sure if hints else text:
                page.blocks.append(Block(e.path, shown, links, not e.bad or head, leaf, head and not e.cause.inner))
        if any(b.good for b in page.blocks):
            break


def widened(page: Page, path: int) -> int:
    """path up to its nearest article or main; without one, up to the widest container below body as long as what stands beside isn't mostly links.

    An article inside main goes up to main, if what stands beside it is neither mostly links nor another article."""
    chain = page.chain(path)
    tags = ["", *(page.step[p].split(".", 1)[0] for p in chain)]
    on = {p: d for d, p in enumerate(chain, 1)}
    # For each path of the page, how far it goes along with this one.
    shared = [0] * len(page.step)
    for p in range(1, len(page.step)):
        shared[p] = on.get(p) or shared[page.parent[p]]
    text, links, deepest = [0] * len(tags), [0] * len(tags), [0] * len(tags)
    for b in page.blocks:
        if b.good:
            d = shared[b.path]
            text[d] += len(b.text)
            links[d] += b.links
            deepest[d] = max(deepest[d], page.article[b.path])
    if "article" in tags or "main" in tags:
        k = max(d for d, tag in enumerate(tags) if tag in ("article", "main"))
        main = tags.index("main") if "main" in tags[:k] else k
        other = any(d > main for d in deepest[main:k])
        k = k if other or 2 * sum(links[main:k]) >= sum(text[main:k]) else main
        return chain[k - 1]
    wide, beside, linked = len(chain), 0, 0
    for d in range(len(chain) - 1, 0, -1):
        if tags[d] in ("html", "body"):
            break
        beside, linked = beside + text[d], linked + links[d]
        if beside:
            if 2 * linked >= beside:
                break
            wide, beside, linked = d, 0, 0
    return chain[wide - 1]


def best_path(page: Page) -> tuple[int, float] | None:
    """(path, score) of the container with most text, a parent counting half of what its children hold; widened to the article around it."""
    scores: dict[int, float] = {}
    for b in page.blocks:
        size = len(b.text) - b.links
        if b.good and size > 0:
            path, share = b.path, 1.0
            for _ in range(4):
                if not path:
                    break
                scores[path] = scores.get(path, 0.0) + size * share
                path, share = page.parent[path], share / 2
    if not scores:
        return None
    most = max(scores.values())
    path = max((p for p in scores if scores[p] == most), key=lambda p: (page.depth[p], page.step[p], -p))
    return widened(page, path), most


def cut(page: Page, winners: list[str]) -> tuple[str, str]:
    """(text, path): the page's own best container if it won on the host, else the first winner that the page has, else its own."""
    found = best_path(page)
    own = found[0] if found else 0
    if winners and page.name(own) not in winners:
        holds = [False] * len(page.step)
        for b in page.blocks:
            holds[b.path] |= b.good
        for p in range(len(holds) - 1, 0, -1):
            holds[page.parent[p]] |= holds[p]
        own = next((p for p in map(page.find, winners) if p is not None and holds[p]), own)
    inside = [p == own for p in range(len(page.step))]
    for p in range(1, len(inside)):
        inside[p] |= inside[page.parent[p]]
    kept = [b.good and inside[b.path] for b in page.blocks]
    if not any(k and b.leaf == "h1" for k, b in zip(kept, page.blocks, strict=True)):
        # A headline whose header stands beside the container, or beside what it stands in.
        around = {0, *page.chain(own)[:-1]}
        kept = [k or (b.title and b.good and page.parent[b.path] in around) for k, b in zip(kept, page.blocks, strict=True)]
    return "\n\n".join(b.text for k, b in zip(kept, page.blocks, strict=True) if k), page.name(own)


def host_of(url: Column) -> Column:
    """Host name of an address; empty where there is none."""
    return F.regexp_extract(F.lower(text_or_empty(url)), r"^[a-z][a-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1)


def winning_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html", share: float = SHARE) -> DataFrame:
    """host, pages, paths: the paths that have at least share of the host's votes, most votes first. Votes are summed in each task before they meet."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            votes: dict[tuple[str, str], list[float]] = {}
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                page = read(html)
                best = best_path(page)
                sums = votes.setdefault((host, page.name(best[0]) if best else ""), [0, 0.0])
                sums[0] += 1
                sums[1] += best[1] if best else 0.0
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in votes], pa.string()), pa.array([k[1] for k in votes], pa.string()), pa.array([v[0] for v in votes.values()], pa.int64()), pa.array([v[1] for v in votes.values()], pa.float64())], names=["host", "path", "votes", "score"])

    each = pages.select(host_of(F.col(url_col)).alias("host"), text_or_empty(html_col).alias("html")).mapInArrow(tidy(vote), "host string, path string, votes long, score double")
    # Written, as the sums by host read it too: pages are read once. Pages without a container count as rows of their host, not as votes.
    summed = materialize(each.groupBy("host", "path").agg(F.sum("votes").alias("votes"), F.sum("score").alias("score")), "votes")
    total = summed.groupBy("host").agg(F.sum(F.when(F.col("path") != "", F.col("votes"))).alias("all"), F.sum("votes").alias("pages"))
    # At most 1 / share paths of a host are left here.
    kept = summed.join(total, "host").where((F.col("path") != "") & (F.col("votes") >= share * F.col("all")))
    return kept.groupBy("host", "pages").agg(F.transform(F.sort_array(F.collect_list(F.struct((-F.col("votes")).alias("v"), F.round(-F.col("score")).alias("s"), "path"))), lambda x: x["path"]).alias("paths"))


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html", text: str = "main_text", path: str = "main_path") -> DataFrame:
    """pages without html_col, with the main text and the path it was cut by; both new names.

    Null and empty pages give empty text; very long and broken pages are read whole, in time near their length; a page without
    containers gives its text outside boilerplate; ties of votes go to the path with more text, then to the first by name; addresses
    without a host vote together; repeated rows vote each; an empty table gives an empty result; extra columns pass through
    whatever their names.
    """
    winners = materialize(winning_paths(pages, url_col, html_col), "paths")
    taken = [*pages.columns, text, path]
    host, won, many = (unused(taken, f"{path}_{x}") for x in ("host", "won", "pages"))
    named = winners.select(F.col("host").alias(host), F.col("pages").alias(many), F.col("paths").alias(won))
    rows = pages.withColumn(host, host_of(F.col(url_col)))
    sent = named.agg(F.sum(F.octet_length(host) + F.octet_length(F.array_join(won, "")) + 16)).first()[0] or 0
    if sent <= SENT_BYTES:
        joined = rows.join(F.broadcast(named.drop(many)), host, "left")
    else:
        joined = join_dealt(rows, named, host, many, F.monotonically_increasing_id())
    kept = [c for c in pages.columns if c != html_col]
    rows = joined.select(*kept, text_or_empty(html_col).alias(text), F.coalesce(won, F.array().cast("array<string>")).alias(path))
    schema = rows.select(*kept, text, F.lit("").alias(path)).schema

    def read_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = len(kept)
            got = [cut(read(h), w) for h, w in zip(batch.column(n).to_pylist(), batch.column(n + 1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.string())], names=schema.names)

    return rows.mapInArrow(tidy(read_all), schema)
