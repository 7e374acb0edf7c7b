"""Main text by wrappers: union-free regular expressions inferred for each host.

A page's tokens form a pattern: tags in order, a slot for text. Equal
neighbours, or neighbouring runs of up to four tags, fold into repeated groups.
The patterns of a host are aligned one after the other; what only some of them
have becomes optional, what follows itself becomes repeated. The result is the
host's wrapper: a tree of tags, optional and repeated groups and text slots,
without alternatives. Each slot knows how much text and link text the host's
pages have in it. The wrapper names the slots that carry the main text, and
every page is read through the wrapper of its host.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import map_batches, stored

#: Patterns of one host that one task aligns before their wrappers are aligned.
PATTERNS_A_TASK = 256
LONGEST_RUN = 4
#: Levels of elements that patterns tell apart; deeper text counts to the last of them.
DEEPEST = 200
TEXT = "#"

# Fixed values of the markup.
RAW_TAGS = {"script", "style", "textarea", "title", "xmp", "noframes", "noembed"}
VOID_TAGS = set(
    "area base br col embed hr img input link meta param source track wbr frame".split()
)
INLINE_TAGS = set(
    """a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark
    q ruby rb rp rt s samp small span strike strong sub sup time tt u var wbr""".split()
)
ENDS_PARAGRAPH = set(
    """address article aside blockquote center details dialog dir div dl fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section
    table ul""".split()
)
#: A start tag closes these open tags, up to the nearest of the borders.
CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select", "datalist"}),
}

# What is no main text, by tag and by the words of class, id and role.
OTHER_TAGS = set(
    """nav header footer aside form script style noscript template iframe object svg math canvas
    audio video button select textarea input dialog menu head title search map datalist
    noframes noembed xmp""".split()
)
OTHER_WORDS = set(
    """nav navbar navigation menu header masthead footer sidebar aside ad ads advert adverts
    advertisement advertising banner promo promotion sponsor sponsored cookie cookies consent gdpr
    notice notices notification alert popup modal overlay newsletter subscribe subscription
    subscribeform signup social share sharing related recommended recommendations breadcrumb
    breadcrumbs crumbs pagination pager widget login register search toolbar copyright legal skip
    hidden contentinfo complementary dialog taboola outbrain paywall tagcloud""".split()
)
COMMENT_WORDS = set(
    """comment comments commentlist reply replies respond responses disqus discussion
    reactions""".split()
)
MAIN_TAGS, MAIN_WORDS = {"article", "main"}, {"main", "article", "articlebody"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*)>", re.S
)
_ATTRIBUTE = re.compile(
    r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|\b(hidden)\b", re.I
)
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def label_of(tag: str, attributes: str) -> str:
    """The tag and the words of its class, id and role, without numbers."""
    if not attributes:
        return tag
    words = set()
    for m in _ATTRIBUTE.finditer(attributes):
        value = m[2] or m[3] or m[4] or m[5] or ""
        words |= set(_WORD.findall(_CAMEL.sub(" ", value).lower()))
    return ".".join([tag, *sorted(words)])


class Page:
    """A page as text runs with their place: (path of labels, text, inside a link)."""

    def __init__(self, html: str):
        self.root: list = ["", []]
        self.stack, self.nodes = [""], [self.root]
        self.link = 0
        self.blocks: list[tuple[tuple[str, ...], str, int]] = []
        self.held: list[str] = []
        self.held_link = 0
        self._read(html)
        self._flush()

    def _flush(self) -> None:
        if self.held:
            text = " ".join(unescape("".join(self.held)).split())
            if text:
                self.blocks.append((tuple(self.stack[:DEEPEST]), text, min(self.held_link, len(text))))
                items = self.nodes[-1][1]
                if not items or items[-1][0] != TEXT:
                    items.append([TEXT, []])
            self.held, self.held_link = [], 0

    def _text(self, text: str) -> None:
        if text:
            self.held.append(text)
            if self.link:
                self.held_link += len(text.strip())

    def _open(self, label: str) -> None:
        self._flush()
        if len(self.stack) < DEEPEST:
            self.nodes[-1][1].append([label, []])
            self.nodes.append(self.nodes[-1][1][-1])
        else:
            self.nodes.append(self.nodes[-1])
        self.stack.append(label)

    def _close(self, tags: set[str], borders: set[str]) -> None:
        """Closes all up to the nearest open tag of these, unless a border is nearer."""
        for depth in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[depth].partition(".")[0]
            if tag in tags:
                self._flush()
                del self.stack[depth:], self.nodes[depth:]
                return
            if tag in borders:
                return

    def _read(self, html: str) -> None:
        at = 0
        while m := _TOKEN.search(html, at):
            self._text(html[at : m.start()])
            at = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            if m[1]:
                self._end(tag)
            else:
                at = self._start(tag, m[3], html, at)
        self._text(html[at:])

    def _start(self, tag: str, attributes: str, html: str, at: int) -> int:
        if tag in RAW_TAGS:
            end = re.compile(rf"</{tag}[^>]*>", re.I).search(html, at)
            if tag not in ("script", "style"):
                self._flush()
            return end.end() if end else len(html)
        if tag == "br":
            self.held.append("\n")
        elif tag == "a":
            self.link += 1
        if tag in INLINE_TAGS:
            return at
        if tag in ENDS_PARAGRAPH:
            self._close({"p"}, {"button", "td", "th", "caption", "object"})
        if tag in CLOSED_BY:
            self._close(*CLOSED_BY[tag])
        if tag in VOID_TAGS:
            self._flush()
        else:
            self._open(label_of(tag, attributes))
        return at

    def _end(self, tag: str) -> None:
        if tag == "a":
            self.link = max(0, self.link - 1)
        if tag not in INLINE_TAGS and tag not in VOID_TAGS:
            self._close({tag}, {"table"} if tag in ("p", "li", "div") else set())


# Patterns. A node is [label, items]; an item is [node or group, optional, repeated];
# a group is [None, items].


def pattern(node: list) -> list:
    """The page's own pattern, with repeated neighbours folded."""
    return [node[0], folded([[pattern(child), False, False] for child in node[1]])]


def _key(item: list):
    node = item[0]
    return node[0] if node[0] is not None else tuple(_key(i) for i in node[1])


def _keys(items: list) -> list:
    return [_key(item) for item in items]


def folded(items: list) -> list:
    """Neighbouring runs of one to four equal tags become one repeated item."""
    for length in range(1, LONGEST_RUN + 1):
        out: list = []
        for item in items:
            out.append(item)
            last = out[-length:]
            if length == 1 and item[0][0] == TEXT:
                continue
            if _keys(out[-2 * length : -length]) == _keys(last):
                both = _zip(out[-2 * length : -length], last)
                whole = both[0][0] if length == 1 else [None, both]
                out[-2 * length :] = [[whole, length == 1 and both[0][1], True]]
            elif length > 1 and len(out) > length:
                group, optional, _ = out[-length - 1]
                if group[0] is None and _keys(group[1]) == _keys(last):
                    out[-length - 1 :] = [[[None, _zip(group[1], last)], optional, True]]
        items = out
    return items


def _zip(one: list, two: list) -> list:
    return [[aligned(a[0], b[0]), a[1] or b[1], a[2] or b[2]] for a, b in zip(one, two, strict=True)]


def aligned(one: list, two: list) -> list:
    """One pattern for what either pattern matches: mismatches become optional."""
    return [one[0], folded(_align(one[1], two[1]))]


def _align(one: list, two: list) -> list:
    a, b = _keys(one), _keys(two)
    if a == b:
        return _zip(one, two)
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            same = best[i + 1][j + 1] + 1 if a[i] == b[j] else 0
            best[i][j] = max(same, best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and a[i] == b[j]:
            out += _zip([one[i]], [two[j]])
            i, j = i + 1, j + 1
        elif j == len(b) or (i < len(a) and best[i + 1][j] >= best[i][j + 1]):
            out.append([one[i][0], True, one[i][2]])
            i += 1
        else:
            out.append([two[j][0], True, two[j][2]])
            j += 1
    return out


def expression(node: list) -> str:
    """The wrapper as a regular expression, to be read by people."""
    parts = []
    for inner, optional, repeated in node[1]:
        text = "TEXT" if inner[0] == TEXT else expression(inner)
        mark = "*" if optional and repeated else "?" if optional else "+" if repeated else ""
        parts.append(f"({text}){mark}" if mark and inner[0] is not None else text + mark)
    body = " ".join(parts)
    if node[0] is None:
        return f"({body})"
    return f"<{node[0]}>{body}</{node[0].partition('.')[0]}>" if node[0] else body


def slots(node: list, path: tuple[str, ...] = ()) -> Iterator[tuple[str, ...]]:
    """The paths of labels to the text slots."""
    here = path if node[0] is None else (*path, node[0])
    for inner, _, _ in node[1]:
        if inner[0] == TEXT:
            yield here
        else:
            yield from slots(inner, here)


def _words(label: str) -> tuple[str, set[str]]:
    tag, *words = label.split(".")
    return tag, set(words)


def _is_main(label: str) -> bool:
    tag, words = _words(label)
    named = bool(words & MAIN_WORDS) and not words & OTHER_WORDS
    return (tag in MAIN_TAGS or named) and not words & COMMENT_WORDS


def _is_other(label: str, holds_main: bool) -> bool:
    tag, words = _words(label)
    if words & COMMENT_WORDS and tag not in ("html", "body"):
        return True
    if tag in OTHER_TAGS:
        return True
    return bool(words & OTHER_WORDS) and not holds_main and tag not in ("html", "body")


Paths = set[tuple[str, ...]]


def main_slots(wrapper: list, sizes: dict[tuple[str, ...], tuple[int, int]]) -> tuple[Paths, Paths]:
    """The slots of the main text: those in an article or main element, outside menus,
    notices, forms, comments and the like. Second, for pages without such text: all
    slots outside these that hold mostly no link text on the host's pages."""
    paths = set(slots(wrapper))
    above = {p[: i + 1] for p in paths for i in range(len(p)) if _is_main(p[i])}
    holds = {p[:i] for p in above for i in range(1, len(p) + 1)}
    own = {
        p for p in paths
        if not any(_is_other(p[i], p[: i + 1] in holds) for i in range(len(p)))
    }
    inside = {p for p in own if any(map(_is_main, p))}
    plain = {p for p in own if 2 * sizes.get(p, (0, 0))[1] <= sizes.get(p, (0, 0))[0]}
    return inside, plain


# On Spark


def host(url):
    """The lower-case host of a url; empty for none."""
    authority = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    return F.lower(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":\d*$", ""))


def _dump(node: list) -> str:
    return json.dumps(node, separators=(",", ":"), ensure_ascii=False)


def _observed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each page its pattern, and for each of its slots the text and link text."""
    for batch in batches:
        rows = []
        for name, html in zip(batch["host"].to_pylist(), batch["html"].to_pylist(), strict=True):
            page = Page(html or "")
            rows.append((name, "pattern", _dump(pattern(page.root)), 0, 0))
            sizes: dict[tuple[str, ...], list[int]] = {}
            for path, text, link in page.blocks:
                size = sizes.setdefault(path, [0, 0])
                size[0] += len(text)
                size[1] += link
            rows += [(name, "slot", json.dumps(p), *size) for p, size in sizes.items()]
        columns = list(zip(*rows, strict=True)) or [()] * 5
        kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())
        names = ["host", "kind", "value", "chars", "links"]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
        )


def _wrapper(values) -> list:
    wrapper = None
    for value in sorted(values):
        one = json.loads(value)
        wrapper = one if wrapper is None else aligned(wrapper, one)
    return wrapper


def infer(pages: DataFrame, patterns_a_task: int = PATTERNS_A_TASK) -> DataFrame:
    """One row per host: host, pages, wrapper, expression, main (paths of the main
    text's slots, and of those to read where a page has no text in them).

    Equal patterns of a host are counted before they meet, so a host with a third
    of all pages sends its distinct patterns only. A host with many of those is
    aligned in parts first.
    """
    seen = map_batches(
        pages.select(host(F.col("url")).alias("host"), "html"),
        _observed,
        "host string, kind string, value string, chars long, links long",
    )
    facts = stored(
        seen.groupBy("host", "kind", "value").agg(
            F.count("*").alias("pages"), F.sum("chars").alias("chars"), F.sum("links").alias("links")
        ),
        "patterns",
    )
    part = F.pmod(F.xxhash64("value"), F.greatest(F.lit(1), F.ceil(F.col("n") / patterns_a_task)))
    counts = facts.filter("kind = 'pattern'").groupBy("host").agg(F.count("*").alias("n"))
    dealt = facts.filter("kind = 'pattern'").join(counts, "host").withColumn("part", part)

    def partly(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(
            {
                "host": group["host"].iloc[:1],
                "kind": "pattern",
                "value": _dump(_wrapper(group["value"])),
                "pages": group["pages"].sum(),
                "chars": 0,
                "links": 0,
            }
        )

    schema = "host string, kind string, value string, pages long, chars long, links long"
    parts = dealt.groupBy("host", "part").applyInPandas(partly, schema)

    def whole(group: pd.DataFrame) -> pd.DataFrame:
        own = group[group["kind"] == "pattern"]
        wrapper = _wrapper(own["value"])
        sizes = {
            tuple(json.loads(r.value)): (r.chars, r.links)
            for r in group[group["kind"] == "slot"].itertuples()
        }
        main = [sorted(some) for some in main_slots(wrapper, sizes)]
        return pd.DataFrame(
            {
                "host": group["host"].iloc[:1].to_list(),
                "pages": [own["pages"].sum()],
                "wrapper": [_dump(wrapper)],
                "expression": [expression(wrapper)],
                "main": [json.dumps(main)],
            }
        )

    both = parts.unionByName(facts.filter("kind = 'slot'").select(*parts.columns))
    return both.groupBy("host").applyInPandas(
        whole, "host string, pages long, wrapper string, expression string, main string"
    )


def main_text(html: str, main: Paths, plain: Paths) -> str:
    blocks = Page(html).blocks
    chosen = [text for path, text, _ in blocks if path in main]
    return "\n".join(chosen or [text for path, text, _ in blocks if path in plain])


def extract(pages: DataFrame, wrappers: DataFrame | None = None) -> DataFrame:
    """page_id, url, text and n_chars of every page, read through its host's wrapper.

    Null and empty html, and pages without main text, give an empty text. Pages
    without a host (a null url too) share one wrapper. Repeated rows repeat,
    extra columns are left behind.
    """
    wrappers = stored(infer(pages) if wrappers is None else wrappers, "wrappers")
    rows = pages.select("page_id", "url", "html", host(F.col("url")).alias("host")).join(
        wrappers.select("host", "main"), "host", "left"
    )
    kind = pages.schema["page_id"].dataType.simpleString()

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[Paths]] = {}
        for batch in batches:
            texts = []
            for html, main in zip(batch["html"].to_pylist(), batch["main"].to_pylist(), strict=True):
                if main not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[main] = [set(map(tuple, some)) for some in json.loads(main)]
                texts.append(main_text(html or "", *known[main]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["page_id"],
                    batch["url"],
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    return map_batches(
        rows.select("page_id", "url", "html", "main"),
        extracted,
        f"page_id {kind}, url string, text string, n_chars long",
    )
