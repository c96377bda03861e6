"""Main text of web pages by wrappers: union-free regular expressions over the token streams of a host's pages.

A page's tokens are its containers (tag and class) and text slots. Neighbours that repeat are folded into a repeated group; the
streams of a host are then aligned one after the other: what matches is merged, what does not becomes optional or
repeated. The wrapper names every text slot of the host by its path; slots in menus, adverts, forms, comments and
the like are not main, and of the rest those in the article are, or else in the main container, or else in the body.
Of these, slots outside articles and main containers that repeat their texts over the host's pages are template: they count only on a page
that fills no other.

Only the distinct streams of a host travel. They are merged in levels: no task sees more than a bounded group of a host's
streams at once, however many it has. Of the texts in its slots only 64-bit hashes travel.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.scratch import stored

#: Tags that hold other blocks, tags that start a block, and tags whose text is never shown. Fixed values.
CONTAINERS = frozenset((
    "html body div section article main aside nav header footer form ul ol li dl dd dt table tbody thead tfoot tr td th "
    "blockquote figure figcaption details fieldset dialog menu address").split())
BLOCKS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 pre hr head title center summary caption".split())
HIDDEN = frozenset("script style noscript template title textarea select datalist option button iframe object svg math canvas audio video".split())
#: Hidden tags whose content holds no tags: what looks like one does not end them.
RAW = frozenset("script style title textarea".split())
VOID = frozenset("br hr img meta link input area base col embed source track wbr".split())
#: Tags and names of a class, an id or a role that mark what is not the article. A name counts as a whole: all parts between
#: its hyphens must be such words or tell only place or form, so neither has-sidebar nor entry-header is one. Fixed values.
ASIDE_TAGS = frozenset("nav header footer aside form menu dialog fieldset".split())
ASIDE_WORDS = frozenset((
    "nav navbar navigation menu menubar header masthead footer sidebar aside rail ad ads advert advertisement advertising adbox sponsor sponsored promo "
    "banner cookie cookies consent gdpr notice notices alert popup modal overlay comment comments reply replies disqus respond share sharing social "
    "related recommended breadcrumb breadcrumbs pagination pager newsletter subscribe signup login search widget toolbar form contentinfo complementary hidden").split())
PLACE_WORDS = frozenset((
    "site main page left right top bottom upper lower primary secondary tertiary first second global sticky fixed box area list wrap wrapper container "
    "section block bar panel inner outer link links item items post posts story stories article articles text button buttons icon icons").split())
#: A header's name may tell its place only by these: entry-header or page-header hold headlines.
SITE_WORDS = frozenset("site global top sticky fixed wrap wrapper container section block bar inner outer".split())
#: Of the tags and words, those that hold no page: their containers are aside even if they hold most of a page's text.
NEVER_TAGS = frozenset("nav header footer aside menu".split())
NEVER_WORDS = frozenset((
    "nav navbar navigation menu menubar header masthead footer ad ads advert advertisement advertising adbox sponsor sponsored banner cookie cookies "
    "consent gdpr comment comments reply replies disqus respond share sharing related recommended breadcrumb breadcrumbs pagination pager contentinfo").split())
MAIN_WORDS = frozenset("article main content post entry story body".split())
#: Streams or wrappers of a host that are aligned in one group, on the average of the first level and at most in the others.
GROUP = 64
#: A slot is template if so many different pages fill it per distinct text, or more. Fixed value.
TEMPLATE = 5
ARTICLE_TAGS = frozenset("article main".split())
#: Containers nested deeper belong to the one at this depth, as browsers limit the depth of a page, too; their text stays.
MOST_DEPTH = 256
#: Tokens of a sequence that are aligned at once, where two sequences are longer than their product allows.
ALIGNED, ALIGNED_PAIRS = 1_000, 4_000_000
#: Ends the name of a container that is marked as aside and yet holds the page's text.
HOLDS = "."
_WORD = re.compile(r"[a-z]+")


class _Events(HTMLParser):
    """A page as a list of (kind, tag or text, attributes)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.found: list[tuple[str, str, list]] = []

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """Marked sections of any name are comments, up to the next ``>``."""
        return self.parse_bogus_comment(i)

    def parse_html_declaration(self, i: int) -> int:
        return self.parse_bogus_comment(i) if self.rawdata.startswith("<![", i) else super().parse_html_declaration(i)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.found.append(("start", tag, attrs))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.found.append(("empty", tag, attrs))

    def handle_endtag(self, tag: str) -> None:
        self.found.append(("end", tag, []))

    def handle_data(self, data: str) -> None:
        self.found.append(("data", data, []))


def _hidden(events: list[tuple[str, str, list]]) -> dict[int, int]:
    """Where what a hidden element holds ends, by the place of its start tag.

    Its own end tag ends it. An option also ends at the next option or block and with its parent; a script or style, whose
    content is no markup, with the page. Another one that is still open when a container around it ends has no end and hides nothing.
    """
    ends: dict[int, int] = {}
    raw: dict[str, int] = {}
    for at, (kind, tag, _) in enumerate(events):
        if tag in RAW and kind == "start":
            raw[tag] = at
        elif kind == "end" and tag in raw:
            ends[raw.pop(tag)] = at + 1
    open_: list[tuple[str, int]] = []
    count: dict[str, int] = {}

    def close(at: int) -> str:
        tag, start = open_.pop()
        count[tag] -= 1
        if tag == "option":
            ends[start] = at
        return tag

    at = 0
    while at < len(events):
        kind, tag, _ = events[at]
        if kind == "start":
            if at in ends:
                at = ends[at]
                continue
            if open_ and open_[-1][0] == "option" and (tag in BLOCKS or tag in ("option", "optgroup")):
                close(at)
            if tag in HIDDEN or tag in CONTAINERS:
                open_.append((tag, at))
                count[tag] = count.get(tag, 0) + 1
        elif kind == "end" and count.get(tag):
            start = next(i for t, i in reversed(open_) if t == tag)
            while close(at) != tag:
                pass
            if tag in HIDDEN:
                ends[start] = at + 1
        at += 1
    return ends | {start: len(events) for tag, start in open_ if tag in ("option", "script", "style")}


class _Page:
    """Containers and blocks of a page: ``tree`` for the wrapper, ``blocks`` as (path of the slot, text)."""

    def __init__(self) -> None:
        self.tree: list = ["", []]
        self.stack: list[tuple[str, list, int]] = [("", self.tree, 0)]
        self.text: list[str] = []
        #: Every container as (its node in the tree, the place of the one around it, characters right in it).
        self.nodes: list[list] = [[self.tree, 0, 0]]
        self.found: list[tuple[int, str]] = []
        self.blocks: list[tuple[str, str]] = []

    def read(self, events: list[tuple[str, str, list]]) -> None:
        ends = _hidden(events)
        at = 0
        while at < len(events):
            kind, tag, attrs = events[at]
            if kind == "data":
                self.text.append(tag)
            elif kind == "end":
                self.end(tag)
            elif kind == "start":
                self.start(tag, attrs)
            elif tag == "br" or tag in BLOCKS:
                self.start("br" if tag == "br" else "p", [])
            at = ends.get(at, at + 1)
        self.cut()
        for node in _holders(self.nodes):
            self.nodes[node][0][0] += HOLDS
        self.blocks = [(self.path(node), text) for node, text in self.found]

    def path(self, at: int) -> str:
        names = []
        while at:
            names.append(self.nodes[at][0][0])
            at = self.nodes[at][1]
        return "/".join(reversed(names))

    def cut(self) -> None:
        words = " ".join("".join(self.text).split())
        self.text = []
        if words:
            _, node, at = self.stack[-1]
            self.found.append((at, words))
            self.nodes[at][2] += len(words)
            node[1].append(["T", []])

    def start(self, tag: str, attrs: list) -> None:
        if tag == "br":
            self.text.append(" ")
        if tag in BLOCKS:
            self.cut()
            if tag in ("li", "tr", "td", "th", "dt", "dd") and self.stack[-1][0] == tag:
                self.stack.pop()
        if tag in CONTAINERS:
            named = [w for k, v in attrs if k in ("class", "id", "role", "itemprop") and v for w in v.lower().split()]
            marks = sorted({"-".join(_WORD.findall(w)) for w in named} - {""})
            node: list = [".".join([tag, *marks]), []]
            _, around, at = self.stack[-1]
            if len(self.stack) > MOST_DEPTH:
                self.stack.append((tag, around, at))
                return
            around[1].append(node)
            self.nodes.append([node, at, 0])
            self.stack.append((tag, node, len(self.nodes) - 1))

    def end(self, tag: str) -> None:
        if tag in BLOCKS:
            self.cut()
        if tag in CONTAINERS:
            for at in range(len(self.stack) - 1, 0, -1):
                if self.stack[at][0] == tag:
                    del self.stack[at:]
                    break


def parsed(html: str | None) -> _Page:
    events = _Events()
    events.feed(html or "")
    events.close()
    page = _Page()
    page.read(events.found)
    return page


def _occurs(a: str, b: str) -> str:
    return "*" if {a, b} & {"*"} or {"+", "?"} <= {a, b} else "+" if "+" in (a, b) else "?" if "?" in (a, b) else ""


def folded(tree: list) -> list:
    """A page's tree as a wrapper ``[name, occurs, children]`` with repeated neighbours, single or in groups, folded."""
    items = [folded(c) for c in tree[1]]
    return [tree[0], "", _fold(items)]


def _fold(items: list) -> list:
    for size in (1, 2, 3, 4):
        out: list = []
        at = 0
        while at < len(items):
            group = items[at : at + size]
            names = [x[0] for x in group]
            end = at + size
            while len(group) == size and [x[0] for x in items[end : end + size]] == names:
                group = [merged(x, y) for x, y in zip(group, items[end : end + size], strict=True)]
                end += size
            if end > at + size:
                out.append([group[0][0], "+", group[0][2]] if size == 1 else ["()", "+", group])
                at = end
            else:
                out.append(items[at])
                at += 1
        items = out
    return items


def merged(a: list, b: list) -> list:
    """The wrapper of everything that ``a`` or ``b`` stands for; both have one name."""
    return [a[0], _occurs(a[1], b[1]), aligned(a[2], b[2])]


def aligned(a: list, b: list) -> list:
    """Align two sequences by their longest common run of names; mismatches become optional.

    Equal beginnings and ends need no search. Sequences that are long even so are aligned part by part, which still gives an expression for
    both, if not the shortest one.
    """
    if a == b:
        return a
    head, tail = 0, 0
    while head < min(len(a), len(b)) and a[head][0] == b[head][0]:
        head += 1
    while tail < min(len(a), len(b)) - head and a[-1 - tail][0] == b[-1 - tail][0]:
        tail += 1
    out = [merged(x, y) for x, y in zip(a[:head], b[:head], strict=True)]
    x, y = a[head : len(a) - tail], b[head : len(b) - tail]
    step = ALIGNED if len(x) * len(y) > ALIGNED_PAIRS else max(len(x), len(y), 1)
    for at in range(0, max(len(x), len(y)), step):
        out += _common(x[at : at + step], y[at : at + step])
    out += [merged(u, v) for u, v in zip(a[len(a) - tail :], b[len(b) - tail :], strict=True)]
    return _fold(out)


def _common(a: list, b: list) -> list:
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i][0] == b[j][0] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and a[i][0] == b[j][0]:
            out.append(merged(a[i], b[j]))
            i, j = i + 1, j + 1
        elif j == len(b) or (i < len(a) and best[i + 1][j] >= best[i][j + 1]):
            out.append([a[i][0], _occurs(a[i][1], "?"), a[i][2]])
            i += 1
        else:
            out.append([b[j][0], _occurs(b[j][1], "?"), b[j][2]])
            j += 1
    return out


def expression(wrapper: list) -> str:
    """The wrapper as a regular expression over tokens, for people."""
    inner = " ".join(expression(c) for c in wrapper[2])
    body = inner if wrapper[0] in ("", "()") else wrapper[0] if wrapper[0] == "T" else f"<{wrapper[0]}> {inner} </{wrapper[0].split('.')[0]}>"
    return f"({body}){wrapper[1]}" if wrapper[1] else body


def _words(name: str) -> set[str]:
    return {w for mark in name.split(".")[1:] for w in mark.split("-")}


@lru_cache(maxsize=10_000)
def _names_aside(mark: str, in_article: bool) -> bool:
    parts = set(mark.split("-"))
    if "header" in parts:
        return not in_article and parts <= ASIDE_WORDS | SITE_WORDS
    return bool(ASIDE_WORDS & parts) and parts <= ASIDE_WORDS | PLACE_WORDS


def _is_aside(name: str, in_article: bool = False) -> bool:
    """Whether a container is not the article: neither the page, nor a holder of its text, nor the article's own header."""
    tag, *marks = name.split(".")
    if name.endswith(HOLDS) or tag in ("html", "body") or (tag == "header" and in_article):
        return False
    return tag in ASIDE_TAGS or any(_names_aside(m, in_article) for m in marks)


def _holds_no_page(name: str, in_article: bool) -> bool:
    tag, *marks = name.split(".")
    return tag in NEVER_TAGS or any(NEVER_WORDS & set(m.split("-")) for m in marks if _names_aside(m, in_article))


def _holders(nodes: list[list]) -> list[int]:
    """The places of containers that are marked as aside, but hold a page's article or most of its text.

    A page with text in an article or main container outside all marked ones has none. Menus, comments, adverts and the
    like hold a page only if they hold an article and no text is outside.
    """
    names = [node[0] for node, _, _ in nodes]
    articles = [name.split(".")[0] in ARTICLE_TAGS for name in names]
    inside, marked, under = [False], [False], [False]
    for at, (_, around, _) in enumerate(nodes[1:], 1):
        inside.append(inside[around] or articles[around])
        marked.append(_is_aside(names[at], inside[at]))
        under.append(marked[at] or under[around])
    outside = [at for at in range(len(nodes)) if nodes[at][2] and not under[at]]
    if not any(marked) or any(inside[at] or articles[at] for at in outside):
        return []
    total, most = sum(n for _, _, n in nodes), sum(nodes[at][2] for at in outside)
    held, article = [n for _, _, n in nodes], [False] * len(nodes)
    found = []
    for at in range(len(nodes) - 1, 0, -1):
        never = marked[at] and _holds_no_page(names[at], inside[at])
        article[at] = article[at] or (articles[at] and held[at] > 0 and not never)
        if marked[at]:
            if never and (most or not article[at]):
                continue
            if not never and 2 * held[at] <= total and not (article[at] and held[at] > most):
                continue
            found.append(at)
        around = nodes[at][1]
        held[around] += held[at]
        article[around] = article[around] or article[at]
    return found


def slots(wrapper: list, path: tuple[str, ...] = ()) -> Iterator[tuple[str, ...]]:
    """Paths of the wrapper's text slots."""
    for name, _, children in wrapper[2]:
        if name == "T":
            yield path
        else:
            yield from slots(["", "", children], path if name == "()" else (*path, name))


def _is_open(path: tuple[str, ...]) -> bool:
    in_article = False
    for name in path:
        if _is_aside(name, in_article):
            return False
        in_article = in_article or name.split(".")[0] in ARTICLE_TAGS
    return True


def main_slots(wrapper: list, template: Iterable[str] = ()) -> list[set[str]]:
    """The slots that may hold the main text, best kind first: in an article, in a main container, in one named like it, any other.

    What is in an article or main container stays. The other kinds come without their ``template`` slots first; with them they
    follow, for pages that fill no others.
    """
    open_ = [p for p in dict.fromkeys(slots(wrapper)) if _is_open(p)]
    tests = (
        lambda n: n.split(".")[0] == "article",
        lambda n: n.split(".")[0] == "main" or "main" in _words(n),
        lambda n: bool(MAIN_WORDS & _words(n)),
    )
    kinds = [{"/".join(p) for p in open_ if any(holds(n) for n in p)} for holds in tests] + [{"/".join(p) for p in open_}]
    return kinds[:2] + [kind.difference(template) for kind in kinds[2:]] + kinds[2:]


def main_text(page: _Page, kinds: list[set[str]]) -> str:
    """Blocks in the slots of the best kind that the page fills."""
    for kind in kinds:
        chosen = [text for path, text in page.blocks if path in kind]
        if chosen:
            return "\n\n".join(chosen)
    return ""


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def filled(page: _Page) -> tuple[int, list[dict]]:
    """A page's name, the hash of its longest open block, and the hash of the text of each open slot it fills."""
    texts: dict[str, list[str]] = {}
    for path, text in page.blocks:
        texts.setdefault(path, []).append(text)
    texts = {path: t for path, t in texts.items() if _is_open(tuple(path.split("/")))}
    longest = max((t for each in texts.values() for t in each), key=lambda t: (len(t), t), default="")
    return _hash(longest), [{"path": path, "text": _hash("\n".join(t))} for path, t in texts.items()]


def wrappers(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Per host (empty: no host): its ``wrapper`` as JSON and the paths of its ``template`` slots.

    A host's distinct streams are aligned, the most frequent ones first. Per slot it is counted how many different pages
    fill it and with how many distinct texts; pages with the same longest block count once, so copies of a page make no template.
    """
    kinds = pa.list_(pa.struct([("path", pa.string()), ("text", pa.int64())]))

    def streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                found, names, texts = [], [], []
                for h in batch.column(1):
                    page = parsed(h.as_py())
                    found.append(json.dumps(folded(page.tree)))
                    name, slot = filled(page)
                    names.append(name)
                    texts.append(slot)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(found, pa.string()), pa.array(names, pa.int64()), pa.array(texts, kinds)],
                    ["host", "wrapper", "page", "slots"])

    def align(part: pd.DataFrame) -> str:
        best = part.sort_values(["pages", "wrapper"], ascending=[False, True])["wrapper"]
        whole = json.loads(best.iloc[0])
        for other in best.iloc[1:]:
            whole = merged(whole, json.loads(other))
        return json.dumps(whole)

    def by_salt(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"host": [key[0]], "salt": [key[1]], "wrapper": [align(part)], "pages": [int(part["pages"].sum())]})

    host = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)).alias("host")
    each = stored(pages.select(host, F.col(html).alias("html")).mapInArrow(
        streams, "host string, wrapper string, page bigint, slots array<struct<path:string,text:bigint>>"), "streams")
    texts = each.select("host", "page", F.explode("slots").alias("s")).groupBy("host", "s.path").agg(
        F.count_distinct("page").alias("filled"), F.count_distinct("s.text").alias("texts"))
    template = texts.where(F.col("filled") >= TEMPLATE * F.col("texts")).groupBy("host").agg(F.sort_array(F.collect_list("path")).alias("template"))
    counted = each.groupBy("host", "wrapper").agg(F.count(F.lit(1)).alias("pages"))
    most = counted.groupBy("host").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1
    salts = -(-most // GROUP)
    level = counted.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(salts)))
    while True:
        level = level.groupBy("host", "salt").applyInPandas(by_salt, "host string, salt bigint, wrapper string, pages bigint")
        if salts == 1:
            break
        salts = -(-salts // GROUP)
        level = level.withColumn("salt", F.floor(F.col("salt") / GROUP))
    whole = level.drop("salt", "pages")
    return whole.join(template, "host", "left")


def extracted(pages: DataFrame, url: str = "url", html: str = "html", keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """``keep``, ``url`` and ``text``: blocks of the main slots that are not template, in page order, joined by an empty line.

    Null and empty pages have an empty text, and pages without a host share a wrapper. Repeated rows are kept.
    """
    found = stored(wrappers(pages, url, html), "wrappers")
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    rows = pages.select(host.alias("_host"), *[F.col(f"`{c}`") for c in keep], F.col(url).alias("_url"), F.col(html).alias("_html"))
    joined = rows.join(found.withColumnRenamed("host", "_host"), "_host").select(*[F.col(f"`{c}`") for c in keep], "_url", "_html", "wrapper", "template")
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[str, tuple[str, ...]], list[set[str]]] = {}
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                texts = []
                for page, *marks in zip(*[batch.column(n + i).to_pylist() for i in (1, 2, 3)], strict=True):
                    key = (marks[0], tuple(marks[1] or ()))
                    if key not in known:
                        if len(known) > 1000:
                            known.clear()
                        known[key] = main_slots(json.loads(key[0]), key[1])
                    texts.append(main_text(parsed(page), known[key]))
                yield pa.RecordBatch.from_arrays([*batch.columns[: n + 1], pa.array(texts, pa.string())], [*keep, url, "text"])

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in pages.select(*keep).schema.fields)
    return joined.mapInArrow(run, f"{kinds}`{url}` string, text string")
