"""HTML extraction by union-free wrappers, inferred per host from the alignment of its pages' token streams.

A page is a stream of container tags and texts. Neighbouring equal runs fold into repeated groups, which gives the
page's form. Spark gathers each host's distinct forms with the sums of what stood at each of their places, and aligns
them into the host's wrapper, in a tree: some forms a task, then some of the wrappers so made, until each host has one.
A mismatch of tags becomes an optional part, one between a single run and a repeated group the group, and one between
texts a slot; a text, or a repeated group as a whole, that is the same on all pages is template.

A page is read through its host's wrapper: places that are template are no candidates for the main text. Of those left,
the ones in the best region that tags and names tell are the main text; where they tell none, what the smallest
container of the long slots holds. Template between main slots (a heading that all articles have) belongs to the text.
"""

from __future__ import annotations

import html as html_entities
import json
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catamill.llm.arrow_text import slices
from catamill.llm.common import join_lookup, result, scratch, written
from catamill.llm.url_filter import host_of

INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 br hr dt dd pre caption figcaption address summary meta link base input col embed source track area param".split())
RAW = "script style title textarea noscript template iframe svg math object select option button"
DROPPED_TAGS = frozenset("head nav footer aside menu dialog canvas audio video".split())
#: Words in class, id or role that name page furniture. Those before the article on its path don't count.
FURNITURE = frozenset(
    "ad ads advert adverts advertisement advertising banner promo sponsor sponsored nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer masthead notice notices cookie"
    " cookies consent gdpr alert popup modal comment comments reply replies respond discussion disqus share sharing social related recommended recommendations newsletter subscribe"
    " subscription signup login search pagination pager toolbar widget contentinfo complementary".split()
)
MAIN_WORDS = frozenset("article main post entry story articlebody content".split())
TITLE_WORDS = frozenset("title headline heading subtitle".split())
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW.replace(' ', '|')})\b[^>]*(?<!/)>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|[^>]*>?)|<[!?/][^>]*>?|([^<]+|<)", re.S | re.I
)
_NAMED = re.compile(r"""(class|id|role|itemprop|hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/>]|$)""", re.I)
_WORD = re.compile(r"[^a-z]+")


@dataclass
class Slot:
    """A block of text: the key of its token, and its text as it stands."""

    key: str
    text: str


#: Containers that a path names in any case; below, only those that may change the region.
DEPTH = 64


def deeper(path: str, depth: int, tag: str, key: str) -> str:
    """The path of a container in the one of `path`. Very deep nesting adds what tells regions alone, so that paths stay short."""
    telling = tag in ("article", "main", "header", "form") or tag in DROPPED_TAGS or not (FURNITURE | MAIN_WORDS | {"hidden"}).isdisjoint(key.split(".")[1:])
    if depth >= DEPTH and (not telling or path.endswith(key) or path.count(">") > 4 * DEPTH):
        return path
    return f"{path}>{key}" if path else key


def parse(page: str) -> list[str | Slot]:
    """Container tags and text slots in page order. Key of a slot: block tag, `@` if linked, and the path of containers."""
    out: list[str | Slot] = []
    stack: list[tuple[str, str, str]] = []  # tag, key, path with it
    open_tags: dict[str, int] = {}
    path, block, linked, buffer, anchors = "", "", False, [], 0

    def pop() -> str:
        t, key, _ = stack.pop()
        open_tags[t] -= 1
        out.append(f"</{key}>")
        return t

    def flush() -> None:
        nonlocal anchors
        text = " ".join(html_entities.unescape("".join(buffer)).split())
        if text:
            out.append(Slot(f"{block}{'@' if anchors * 2 > len(text) else ''}#{path}", text))
        buffer.clear()
        anchors = 0

    for m in _TOKEN.finditer(page):
        if (text := m[6]) is not None:
            buffer.append(text)
            anchors += len(text) if linked else 0
            continue
        if m[3] is None:  # comments, declarations and raw elements are no text; raw ones end a block
            if m[1]:
                flush()
            continue
        closing, tag = m[2] == "/", m[3].lower()
        if tag in INLINE:
            if tag == "a":
                linked = not closing
            continue
        flush()
        if tag in LEAVES:
            block = "" if closing or tag in ("br", "hr") else tag
            continue
        block = ""
        if not closing:
            if tag in ("li", "tr", "td", "th", "option"):
                while stack and stack[-1][0] in {"li": ("li",), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}.get(tag, ()):
                    pop()
                path = stack[-1][2] if stack else ""
            names = sorted({w for a in _NAMED.finditer(m[4]) for w in _WORD.split(((a[2] or a[3] or a[4] or "") if a[1].lower() != "hidden" else "hidden").lower()) if w}) if m[4] else []
            key = ".".join([tag, *names])
            if not m[4].endswith("/"):
                stack.append((tag, key, deeper(path, len(stack), tag, key)))
                open_tags[tag] = open_tags.get(tag, 0) + 1
            out.append(f"<{key}>")
        elif open_tags.get(tag):
            while pop() != tag:
                pass
        linked = False
        path = stack[-1][2] if stack else ""
    flush()
    return out


# A form is a tuple of tokens and repeated groups; a group is a tuple of its body.
def fold(tokens: tuple, longest: int = 64) -> tuple[tuple, list[int]]:
    """Neighbouring equal runs become one repeated group, shorter runs first; and how many tokens each node takes."""
    widths = [1] * len(tokens)
    for n in range(1, longest + 1):
        if 2 * n > len(tokens):
            break
        names: dict = {}
        ids = np.fromiter((names.setdefault(t, len(names)) for t in tokens), np.int64, len(tokens))
        same = np.concatenate([[0], np.cumsum(ids[n:] == ids[:-n])])
        repeats = np.flatnonzero(same[n:] - same[:-n] == n)  # places whose run of n stands there again
        if not len(repeats):
            continue
        out, taken, k = [], [], 0
        for begin in [*repeats.tolist(), len(tokens)]:
            if begin < k:
                continue
            out += tokens[k:begin]
            taken += widths[k:begin]
            if begin == len(tokens):
                break
            end = begin + n
            while end + n <= len(tokens) and same[end] - same[end - n] == n:
                end += n
            body = tokens[begin : begin + n]
            out.append(body[0] if n == 1 and isinstance(body[0], tuple) else body)
            taken.append(sum(widths[begin:end]))
            k = end
        tokens, widths = tuple(out), taken
    return tokens, widths


def form_of(items: list[str | Slot]) -> tuple[tuple, list[int]]:
    return fold(tuple(x.key if isinstance(x, Slot) else x for x in items))


PRIME, BASE = (1 << 61) - 1, 0x3C6EF372FE94F82
#: The sum of a place whose texts differ between pages.
VARIES = -1


@dataclass
class Node:
    """A place of a wrapper. token: tag, text key or repeated group. optional: pages may lack it. same: rolling hash of
    its texts where all pages have the same, else VARIES; leaves: texts under that hash. n: pages that have it, chars: of
    all their texts there."""

    token: str | tuple
    optional: bool
    same: int
    leaves: int
    n: int
    chars: int

    def plain(self) -> list:
        return [self.token, self.optional, self.same, self.leaves, self.n, self.chars]


def joined(nodes: list[Node], token: tuple) -> Node:
    """Nodes that stand one after another, read as one repeated group."""
    same, leaves_of = 0, 0
    for x in nodes:
        same = VARIES if VARIES in (same, x.same) else (same * pow(BASE, x.leaves, PRIME) + x.same) % PRIME
        leaves_of += x.leaves
    return Node(token, all(x.optional for x in nodes), same, leaves_of, max(x.n for x in nodes), sum(x.chars for x in nodes))


def regroup(nodes: list[Node], bodies: set[tuple]) -> list[Node]:
    """Single occurrences of a repeated group's body, and groups of it beside them, become that group."""
    for body in sorted(bodies, key=lambda b: (-len(b), repr(b))):
        n, out, k = len(body), [], 0
        tokens = [x.token for x in nodes]
        if body[0] not in tokens:
            continue
        while k < len(nodes):
            run = []
            while k < len(nodes):
                if tokens[k] == body:
                    run.append(nodes[k])
                    k += 1
                elif tuple(tokens[k : k + n]) == body:
                    run += nodes[k : k + n]
                    k += n
                else:
                    break
            if run:
                out.append(run[0] if len(run) == 1 and run[0].token == body else joined(run, body))
            else:
                out.append(nodes[k])
                k += 1
        nodes = out
    return nodes


def matches(a: list, b: list) -> list[tuple[int, int]]:
    """Pairs of places with equal tokens, in order. Long middles are aligned at the tokens that both have once."""
    low = 0
    while low < min(len(a), len(b)) and a[low] == b[low]:
        low += 1
    tail = 0
    while tail < min(len(a), len(b)) - low and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    out = [(k, k) for k in range(low)]
    x, y = a[low : len(a) - tail], b[low : len(b) - tail]
    if x and y:
        if len(x) * len(y) <= 1 << 18:
            for i, j, n in SequenceMatcher(None, x, y, autojunk=False).get_matching_blocks():
                out += [(low + i + k, low + j + k) for k in range(n)]
        else:
            p, q = _once(x), _once(y)
            out += [(low + i, low + j) for i, j in _rising([(p[t], q[t]) for t in p if t in q])]
    return out + [(len(a) - k, len(b) - k) for k in range(tail, 0, -1)]


def _once(tokens: list) -> dict:
    """Places of the tokens that stand there once."""
    n = Counter(tokens)
    return {t: k for k, t in enumerate(tokens) if n[t] == 1}


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, in order of the first, whose second rises."""
    ends: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for k, (_, j) in enumerate(pairs):
        place = bisect_left(ends, j)
        back.append(at[place - 1] if place else -1)
        ends[place : place + 1], at[place : place + 1] = [j], [k]
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def align(one: list[Node], two: list[Node]) -> list[Node]:
    """The wrapper that takes in both."""
    bodies = {x.token for x in [*one, *two] if isinstance(x.token, tuple)}
    one, two = regroup(one, bodies), regroup(two, bodies)
    out: list[Node] = []
    i = j = 0
    loose = lambda xs: [Node(x.token, True, x.same, x.leaves, x.n, x.chars) for x in xs]
    for a, b in [*matches([x.token for x in one], [x.token for x in two]), (len(one), len(two))]:
        out += loose(one[i:a]) + loose(two[j:b])
        if a < len(one):
            x, y = one[a], two[b]
            out.append(Node(x.token, x.optional or y.optional, x.same if x.same == y.same else VARIES, min(x.leaves, y.leaves), x.n + y.n, x.chars + y.chars))
        i, j = a + 1, b + 1
    return out


def infer(wrappers: list[list[Node]]) -> list[Node]:
    """One wrapper of all, neighbours first."""
    while len(wrappers) > 1:
        wrappers = [align(*wrappers[k : k + 2]) if k + 1 < len(wrappers) else wrappers[k] for k in range(0, len(wrappers), 2)]
    return wrappers[0]


def leaves(node) -> Iterator[str]:
    """The tokens of a token or group."""
    if isinstance(node, tuple):
        for x in node:
            yield from leaves(x)
    else:
        yield node


def region(key: str) -> int:
    """Rank of a slot's place by its path: 0 furniture, 1 none, 2 a container named as main text, 3 main, 4 article."""
    block, _, path = key.partition("#")
    rank = 1
    for part in path.split(">") if path else ():
        tag, *names = part.split(".")
        if tag in DROPPED_TAGS or "hidden" in names:
            return 0
        own = 4 if tag == "article" else 3 if tag == "main" else 2 if MAIN_WORDS.intersection(names) else 0
        if FURNITURE.intersection(names) or tag == "form" or (tag == "header" and not (rank == 4 and block.rstrip("@") in HEADINGS)):
            own = -1
        if own > 0:
            rank = max(rank, own) if rank >= 0 else own
        elif own < 0:
            rank = -1 if rank < 2 else 0
            if rank == 0:
                return 0
    return max(rank, 0)


def inside(path: str, root: str) -> bool:
    return not root or path == root or path.startswith(root + ">")


def above(paths: set[str]) -> str:
    """The smallest container that holds all of these."""
    first, *rest = (p.split(">") for p in sorted(paths))
    n = len(first)
    for p in rest:
        n = next((k for k in range(min(n, len(p))) if p[k] != first[k]), min(n, len(p)))
    return ">".join(first[:n])


#: Pages of a host on which a text must be the same to be template, and the mean characters of a long slot.
SEEN, LONG = 3, 40


def template_of(form: tuple, wrapper: list[Node]) -> list[tuple[bool, float]]:
    """Of each node of a form: whether the wrapper says that it is template, and the mean characters of its texts there (-1: not in the wrapper)."""
    varies = any(x.same == VARIES for x in wrapper)  # else all pages are alike, and tell nothing
    bodies = {x.token for x in wrapper if isinstance(x.token, tuple)}
    # A form's single runs meet the wrapper's groups.
    own = regroup([Node(t, False, k, 1, 1, 0) for k, t in enumerate(form)], bodies)
    place: list[int] = []
    for k, x in enumerate(own):
        place += [k] * x.leaves
    out: list[tuple[bool, float]] = [(False, -1.0)] * len(own)
    for a, b in matches([x.token for x in own], [x.token for x in wrapper]):
        w = wrapper[b]
        out[a] = varies and w.same not in (VARIES, 0) and w.n >= SEEN, w.chars / max(1, w.n * w.leaves)
    return [out[k] for k in place]


def inside(path: str, root: str) -> bool:
    return not root or path == root or path.startswith(root + ">")


def above(paths: set[str]) -> str:
    """The smallest container that holds all of these."""
    first, *rest = (p.split(">") for p in sorted(paths))
    n = len(first)
    for p in rest:
        n = next((k for k in range(min(n, len(p))) if p[k] != first[k]), min(n, len(p)))
    return ">".join(first[:n])


def main_nodes(form: tuple, wrapper: list[Node]) -> list[frozenset[str]]:
    """Of each node of a form, the text keys in it that are main text.

    Candidates are texts that the wrapper doesn't call template and that don't stand in furniture; without any, long ones
    in what only names call furniture, as names may mislead, and then template. The best region among them is the main text: all that an article or
    main element holds, else from the first candidate there to the last. Without a region, it is what the smallest
    container of the long candidates holds, from the first to the last, and headings beside or around that container."""
    facts = template_of(form, wrapper)
    slots = [(k, key) for k, node in enumerate(form) for key in dict.fromkeys(leaves(node)) if "#" in key and key[0] != "<"]
    rank = {key: region(key) for _, key in slots}
    fixed = {k for k, (t, _) in enumerate(facts) if t}
    alive = [(k, key) for k, key in slots if rank[key] > 0 and (k not in fixed or rank[key] >= 3)]
    if not alive and fixed:
        named = {key for _, key in slots if not DROPPED_TAGS.union(("form", "header")).intersection(part.partition(".")[0] for part in key.partition("#")[2].split(">"))}
        alive = [(k, key) for k, key in slots if k not in fixed and facts[k][1] >= LONG and key in named]
        if alive:
            rank |= {key: 1 for _, key in alive}
        else:
            alive = [(k, key) for k, key in slots if rank[key] > 0]
    keep: list[set[str]] = [set() for _ in form]
    if not alive:
        return [frozenset()] * len(form)
    best = max(rank[key] for _, key in alive)
    if best >= 2:
        places = [k for k, key in alive if rank[key] == best]
        for k, key in slots:
            if rank[key] == best and (best >= 3 or places[0] <= k <= places[-1]):
                keep[k].add(key)
        return [frozenset(x) for x in keep]
    block = lambda key: key.partition("#")[0]
    path = lambda key: key.partition("#")[2]
    plain = [(k, key) for k, key in alive if "@" not in block(key)] or alive
    long = [(k, key) for k, key in plain if facts[k][1] >= LONG] or [max(plain, key=lambda x: (facts[x[0]][1], -x[0]))]
    root = above({path(key) for _, key in long})
    places = [k for k, key in alive if inside(path(key), root)]

    def title(key: str) -> bool:
        up, _, own = path(key).rpartition(">")
        named = block(key).rstrip("@") in HEADINGS or not TITLE_WORDS.isdisjoint(own.split(".")[1:])
        return named and inside(root, up)

    for k, key in slots:
        if rank[key] == best and ((inside(path(key), root) and places[0] <= k <= places[-1]) or (title(key) and k not in fixed)):
            keep[k].add(key)
    return [frozenset(x) for x in keep]


def extract(items: list[str | Slot], wrapper: list[Node], memo: dict) -> str:
    """The main text of a page that is read through its host's wrapper."""
    form, widths = form_of(items)
    if form not in memo:
        memo[form] = main_nodes(form, wrapper)
    out, at = [], 0
    for keys, n in zip(memo[form], widths, strict=True):
        if keys:
            out += [x.text for x in items[at : at + n] if isinstance(x, Slot) and x.key in keys]
        at += n
    return " ".join(out)


STEP = 2 << 20


def text_hash(texts: list[str]) -> int:
    """Rolling hash of texts one after another."""
    h = 0
    for t in texts:
        h = (h * BASE + (xxhash.xxh3_64_intdigest(t) % (PRIME - 1)) + 1) % PRIME
    return h


def host_forms(pages: DataFrame) -> DataFrame:
    """host, form (JSON), at, n, chars, leaves, low, high: the distinct forms of each host, and for each of their places the pages and
    characters, the fewest texts, and the smallest and largest hash of what stood there (-1: texts there differ already)."""
    names = ["host", "form", "at", "n", "chars", "leaves", "low", "high"]
    types = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 5]

    def gather(batches) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, tuple], list] = {}

        def rows() -> pa.RecordBatch:
            flat = [(h, json.dumps(f), k, *v) for (h, f), places in found.items() for k, v in enumerate(places)]
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in flat], t) for k, t in enumerate(types)], names)

        size = 0
        for batch in slices(batches, 1, STEP):
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                items = parse(page or "")
                form, widths = form_of(items)
                if (places := found.get((host, form))) is None:
                    places = found[host, form] = [[0, 0, 1 << 60, 1 << 62, 0] for _ in form]
                    size += len(form)
                at = 0
                for place, width in zip(places, widths, strict=True):
                    own = [x.text for x in items[at : at + width] if isinstance(x, Slot)]
                    at += width
                    h = text_hash(own)
                    place[:] = place[0] + 1, place[1] + sum(map(len, own)), min(place[2], len(own)), min(place[3], h), max(place[4], h)
            if size > 200_000:
                yield rows()
                size = 0
        yield rows()

    out = pages.mapInArrow(gather, "host string, form string, at int, n long, chars long, leaves long, low long, high long")
    return out.groupBy("host", "form", "at").agg(F.sum("n").alias("n"), F.sum("chars").alias("chars"), F.min("leaves").alias("leaves"), F.min("low").alias("low"), F.max("high").alias("high"))


def _tuples(x):
    return tuple(_tuples(y) for y in x) if isinstance(x, list) else x


def packed(wrapper: list[Node]) -> str:
    return json.dumps([x.plain() for x in wrapper])


def unpacked(text: str) -> list[Node]:
    return [Node(_tuples(t), *rest) for t, *rest in json.loads(text)]


#: Wrappers that one task aligns at once.
FAN = 64


def wrappers(pages: DataFrame) -> DataFrame:
    """host, wrapper (JSON) of each host. pages: host, html. A host's forms are aligned in a tree, FAN at a time, all of them."""
    place = F.struct("at", "n", "chars", "leaves", "low", "high")
    forms = written(host_forms(pages).groupBy("host", "form").agg(F.array_sort(F.collect_list(place)).alias("places")), "forms")  # as many places as the form has

    def of_form(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for form, places in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                nodes = zip(_tuples(json.loads(form)), places, strict=True)
                out.append(packed([Node(t, False, p["low"] if p["low"] == p["high"] else VARIES, p["leaves"], p["n"], p["chars"]) for t, p in nodes]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["host", "wrapper"])

    def group(pdf: pd.DataFrame) -> pd.DataFrame:
        found = [unpacked(x) for x in sorted(pdf["wrapper"])]
        return pd.DataFrame({"host": [pdf["host"].iloc[0]], "wrapper": [packed(infer(found))]})

    df = written(forms.where(F.size("places") > 0).select("host", "form", "places").mapInArrow(of_form, "host string, wrapper string"), "wrappers")
    while True:
        counts = df.groupBy("host").count()
        most = counts.agg(F.max("count")).first()[0] or 0
        if most <= 1:
            return df
        part = F.pmod(F.xxhash64("wrapper"), F.ceil(F.col("count") / FAN)).cast("int")
        dealt = df.join(counts, "host").select("host", "wrapper", part.alias("part"))
        df = written(dealt.groupBy("host", "part").applyInPandas(group, "host string, wrapper string"), "wrappers")


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of pages (page_id, url, html; others are not read).

    Null html is empty and has no text; null urls are of the host ''. Unclosed and cut-off tags end with the page. Very
    long and deeply nested pages are read like others; paths name the outer containers and those that tell regions.
    Repeated pages give repeated rows, and pages of one form have main text at the same places. Where all pages of a host
    are alike, as with a single one, nothing is template. An empty table gives no rows.
    """
    spark = pages.sparkSession
    pages = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), "html")
    with scratch(spark):
        table = result(wrappers(pages.select("host", "html")), "wrappers")

    def run(batches) -> Iterator[pa.RecordBatch]:
        loaded: dict[str, tuple] = {}
        for batch in slices(batches, 2, STEP):
            texts = []
            for page, text in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if text not in loaded:
                    if len(loaded) > 500:
                        loaded.clear()
                    loaded[text] = unpacked(text or "[]"), {}
                wrapper, memo = loaded[text]
                if len(memo) > 5000:
                    memo.clear()
                texts.append(extract(parse(page or ""), wrapper, memo))
            n = pa.array(np.fromiter(map(len, texts), np.int64, len(texts)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), n], ["page_id", "url", "text", "n_chars"])

    both = join_lookup(pages, table, ["host"], rows=5000).select("page_id", "url", "html", "wrapper")
    return both.mapInArrow(run, f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long")
