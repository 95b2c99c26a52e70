"""Main text of web pages by wrappers that are inferred per host.

A wrapper is a union-free regular expression over a page's tokens: elements, texts, optional parts and repeated groups.
It starts as one page. Each further page of the host is aligned with it. Where they differ, what only one of them has
becomes optional, and kinds that stand at several places become one repeated group. Each text particle keeps the texts
that all pages have there; when none is left it is a slot. Nothing inside an optional part is shared by all pages.

Every page is aligned with the wrapper of its host in the same way, inside the article too: a text that meets a particle
which has that text on all pages of the host, at least two different ones, belongs to the template; what meets a slot, an
optional part or nothing is content. Only then names are asked: elements that are menus, headers, footers, adverts, forms
and the like by their kind or by a whole class name are left out, and where an article or main element holds content, what
is outside of it. A page of which the wrapper leaves nothing is a copy of what all pages have; it is read by names alone,
so that no text is lost whole. Drawings (svg) and the fallback of players count as markup.

Wrappers merge like pages do, so each task aligns its own pages of a host and what is shuffled is one wrapper per
host and task; a host with very many of them is merged in two steps. Pages are not shuffled for the inference, and meet
the wrappers in a join that Spark broadcasts while they are few. As the alignment goes page by page, which of two equally
good expressions comes out may depend on how pages are dealt to tasks.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from hashlib import blake2b
from html import unescape
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import fields, stored, with_row

# Names from the HTML standard, and words that name an element's part in a page.
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
             "strike strong sub sup time tt u var wbr math mfrac mi mn mo mover mrow msqrt mstyle msub msubsup msup mtable mtd mtext mtr "
             "munder semantics".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = set("address article aside blockquote details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
               "header hgroup hr main menu nav ol p pre section table ul".split())
CLOSES_ITSELF = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
                 "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"}}
SCOPES = set("table ul ol dl article section main body html td th div nav aside form".split())
LEFT_OUT = set("head title nav header footer aside form button menu dialog fieldset legend canvas audio video object map address".split())
MAIN = {"article", "main"}
MAIN_NAMES = set("article article-body post post-body post-content entry entry-content story story-body main main-content content".split())
LEFT_OUT_NAMES = set("ad ads adv advert advertisement banner breadcrumb breadcrumbs comment comments comment-list cookie cookies consent "
                     "disclaimer disqus footer header menu modal nav navbar navigation newsletter notice pagination popup promo "
                     "related replies respond share sharing sidebar social sponsor sponsored subscribe toolbar widget".split())
#: Left out outside of main content only: inside it, these hold a headline, a place, a remark or a replaced picture's text.
KEPT_IN_MAIN = set("header address dialog object".split())
# Words that say nothing of an element's part; a compound name leaves out only if it has no others ("share-buttons").
_PLAIN_PARTS = set("area articles bar block bottom box button buttons container form icons inline inner item items left link links list "
                   "main outer page panel posts right section signup site slot sticky top unit wrap wrapper".split())
_NAME_PARTS = LEFT_OUT_NAMES - {"header", "notice"}

#: Elements of one kind side by side, in any order with others, before they become one repeated group.
REPEATS = 6
#: Hosts that a task holds before it passes its wrappers on, and parts that the wrappers of a host are merged in.
HELD_HOSTS, PARTS = 2_000, 64
#: Elements nested deeper are taken for siblings.
MAX_DEPTH = 150
#: Cells of one alignment; longer sequences are aligned as repeated groups of all their kinds.
CELLS = 40_000

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|svg|annotation|annotation-xml|iframe|textarea|select|title|xmp|noframes)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[a-zA-Z][^>]*>|<[!?/][^>]*>|(?P<text>[^<]+|<)", re.S | re.I)
_CLASS = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_DIGITS = re.compile(r"\d.*")


class Element:
    __slots__ = ("name", "key", "skip", "main", "children")

    def __init__(self, name: str, key: str, skip: bool, main: bool):
        self.name, self.key, self.skip, self.main = name, key, skip, main
        self.children: list = []  # elements, and texts as strings


def _left_out(name: str) -> bool:
    """Whether a class or id as a whole says that an element is no content."""
    if name in LEFT_OUT_NAMES:
        return True
    parts = [part for part in re.split(r"[-_]+", name) if part and not part[0].isdigit()]
    return all(part in LEFT_OUT_NAMES or part in _PLAIN_PARTS for part in parts) and not _NAME_PARTS.isdisjoint(parts)


def _kind(name: str, attrs: str) -> tuple[str, bool, bool]:
    """(key, left out, main) of an element. The key is its name and class or id up to digits."""
    key, skip, main = name, name in LEFT_OUT, name in MAIN
    if "=" in attrs:
        for what, *values in _CLASS.findall(attrs):
            names = "".join(values).lower().split()
            if what.lower() == "role":
                main = main or "main" in names
                skip = skip or any(n in ("navigation", "banner", "contentinfo", "complementary", "search", "form") for n in names)
                continue
            key += "." + ".".join(_DIGITS.sub("0", n) for n in names[:2])
            for n in names:
                if _left_out(n):
                    skip = True
                elif n in MAIN_NAMES:
                    main = True
    return key, skip, main and not skip


def parse(html: str) -> Element:
    """The page as a tree of block elements; text within one block is one string with its white space turned to blanks.

    Inline elements only pass their text on, unless their name says they are left out. Missing end tags are implied.
    """
    root = Element("html", "html", False, False)
    stack, text, kinds = [root], [], {}

    def close_text():
        if text:
            words = "".join(text)
            text.clear()
            words = " ".join((unescape(words) if "&" in words else words).split())
            if words:
                stack[-1].children.append(words)

    for token in _TOKEN.finditer(html):
        kind = token.lastgroup
        if kind == "text":
            text.append(token["text"])
            continue
        name = token["name"]
        if name is None:
            continue
        name = name.lower()
        if token["end"]:
            if name in INLINE and stack[-1].name != name:
                # An inline element may stand open below the blocks in it.
                if not any(e.name == name for e in stack[-3:]):
                    continue
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].name == name:
                    close_text()
                    del stack[depth:]
                    break
            continue
        if name == "br":
            text.append(" ")
            continue
        attrs = token["attrs"]
        known = kinds.get((name, attrs))
        if known is None:
            known = kinds[name, attrs] = _kind(name, attrs)
        key, skip, main = known
        if name in INLINE and not skip:
            continue
        close_text()
        if name in ("html", "body"):
            continue
        if name in CLOSES_P:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].name == "p":
                    del stack[depth:]
                    break
                if stack[depth].name in SCOPES:
                    break
        elif name in CLOSES_ITSELF:
            cut = None
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].name in CLOSES_ITSELF[name]:
                    cut = depth
                elif stack[depth].name in SCOPES and stack[depth].name not in ("td", "th"):
                    break
            if cut:
                del stack[cut:]
        if name in VOID:
            continue
        if skip and name in KEPT_IN_MAIN and key == name and any(e.main for e in stack):
            skip = False
        element = Element(name, key, skip, main)
        stack[-1].children.append(element)
        stack.append(element)
        if len(stack) > MAX_DEPTH:
            del stack[MAX_DEPTH:]  # deeper elements are siblings
    close_text()
    return root


# A particle of a wrapper is a list [kind, key, content, may be absent, may repeat]. Kinds: "e" an element with the
# particles in it, "t" a text (by number, the texts all pages have there, each with its places on the page that is read;
# None for a slot), "g" a group of particles; in the group "*" they stand in any order.

def _head(particle: list) -> str:
    return particle[1] if particle[0] == "e" else particle[0] + particle[1]


def _number(text: str) -> str:
    return blake2b(text.encode("utf-8", "replace"), digest_size=8).hexdigest()


def describe(element: Element, places: list[str] | None = None) -> list:
    """The wrapper of one page: elements side by side of one kind, and repeating sequences, are repeated groups.

    With ``places``, a list that takes the page's texts, each text knows its place in it.
    """
    particles = []
    for child in element.children:
        if isinstance(child, str):
            at = []
            if places is not None:
                at.append(len(places))
                places.append(child)
            particles.append(["t", "", {_number(child): at}, 0, 0])
        elif child.skip:
            particles.append(["e", child.key, [], 0, 0])  # what is left out needs no inside
        else:
            particles.append(describe(child, places))
    return ["e", element.key, fold(particles), 0, 0]


def fold(particles: list) -> list:
    """Neighbours of one kind, sequences that follow themselves, and kinds met often become repeated groups."""
    out = []
    for _, run in groupby(particles, _head):
        run = list(run)
        out.append([*join(run)[:4], 1] if len(run) > 1 else run[0])
    if len(out) > 3:
        out = _tandem(out)
    counts = Counter(map(_head, out))
    often = {h for h, n in counts.items() if n > REPEATS}
    return gather(out, often) if often else out


def _tandem(particles: list) -> list:
    """Sequences of two to four kinds that follow themselves become one repeated group."""
    out, i = [], 0
    heads = [_head(p) for p in particles]
    while i < len(particles):
        for size in (2, 3, 4):
            one = heads[i:i + size]
            if len(one) == size and one == heads[i + size:i + 2 * size]:
                j = i + size
                while heads[j:j + size] == one:
                    j += size
                out.append(["g", "|".join(one), [join(particles[i + k:j:size]) for k in range(size)], 0, 1])
                i = j
                break
        else:
            out.append(particles[i])
            i += 1
    return out


def _parts(particle: list) -> list:
    return particle[2] if particle[0] == "g" else [particle]


def gather(particles: list, kinds: set[str]) -> list:
    """From the first to the last particle that has one of the kinds, one repeated group of all that stands there."""
    at = [i for i, p in enumerate(particles) if not kinds.isdisjoint(map(_head, _parts(p))) or _head(p) in kinds]
    if not at:
        return particles
    inside: dict[str, list] = {}
    for particle in particles[at[0]:at[-1] + 1]:
        for part in _parts(particle):
            inside.setdefault(_head(part), []).append(part)
    group = [[*join(parts)[:3], 1, int(len(parts) > 1 or parts[0][4])] for parts in inside.values()]
    return [*particles[:at[0]], ["g", "*", group, 0, 1], *particles[at[-1] + 1:]]


def join(particles: list) -> list:
    """One particle for several of one page (or wrapper) with the same head: it has the texts of all of them."""
    if len(particles) == 1:
        return particles[0]
    kind, key = particles[0][:2]
    optional, repeated = max(p[3] for p in particles), max(p[4] for p in particles)
    if kind == "t":
        texts: dict[str, list] = {}
        for particle in particles:
            for number, at in (particle[2] or {}).items():
                texts.setdefault(number, []).extend(at)
        return [kind, key, texts or None, optional, repeated]
    alike: dict[tuple, list] = {}
    for particle in particles:
        alike.setdefault(tuple(map(_head, particle[2])), []).append(particle[2])
    made = [[join(list(column)) for column in zip(*contents)] for contents in alike.values()]
    content = made[0]
    for other in made[1:]:
        one, two, pairs = matched(content, other, key == "*")
        content = [join([one[i], two[j]]) if i is not None and j is not None else _optional(one[i] if j is None else two[j]) for i, j in pairs]
    return [kind, key, content, optional, repeated]


def _optional(particle: list) -> list:
    return [*particle[:3], 1, particle[4]]


def _forgotten(particle: list) -> list:
    """A particle that some pages lack: optional, and no text in it stands on all pages."""
    kind, key, content, _, repeated = particle
    return [kind, key, None if kind == "t" else [_forgotten(p) for p in content], 1, repeated]


def merge(one: list, two: list) -> list:
    """One particle for those of two pages (or wrappers) with the same head: it has the texts that both have."""
    kind, key, content = one[0], one[1], one[2]
    if kind == "t":
        content = {n: [] for n in content if n in two[2]} or None if content and two[2] else None
    else:
        content = align(content, two[2], key == "*")
    return [kind, key, content, one[3] | two[3], one[4] | two[4]]


def align(one: list, two: list, any_order: bool = False) -> list:
    """The particles of two pages as one sequence: what both have is merged, the rest becomes optional."""
    one, two, pairs = matched(one, two, any_order)
    return [merge(one[i], two[j]) if i is not None and j is not None else _forgotten(one[i] if j is None else two[j]) for i, j in pairs]


def matched(one: list, two: list, any_order: bool = False) -> tuple[list, list, list[tuple]]:
    """Both sequences, with the groups that their comparison needs, and the pairs of places that belong together.

    A place that has no partner stands beside None. Kinds at several places of a sequence, and what stands between them,
    become one repeated group in both, so that each head is there once and the longest common order is unambiguous.
    """
    a, b = [_head(p) for p in one], [_head(p) for p in two]
    if a == b:
        return one, two, [(i, i) for i in range(len(a))]
    if any_order:
        at = {h: j for j, h in enumerate(b)}
        own = set(a)
        return one, two, [(i, at.get(h)) for i, h in enumerate(a)] + [(None, j) for j, h in enumerate(b) if h not in own]
    kinds = {h for side in (a, b) for h, n in Counter(side).items() if n > 1}
    kinds.update(_head(part) for particle in (*one, *two) if particle[0] == "g" for part in particle[2])
    if len(a) * len(b) > CELLS:
        kinds.update(_head(part) for particle in (*one, *two) for part in _parts(particle))
    before = -1
    while len(kinds) > before:
        before = len(kinds)
        one, two = gather(one, kinds), gather(two, kinds)
        kinds.update(_head(part) for particle in (*one, *two) if particle[0] == "g" for part in particle[2])
    a, b = [_head(p) for p in one], [_head(p) for p in two]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    pairs, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            pairs.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            pairs.append((i, None))
            i += 1
        else:
            pairs.append((None, j))
            j += 1
    return one, two, pairs + [(k, None) for k in range(i, len(a))] + [(None, k) for k in range(j, len(b))]


# A host's wrapper is [particle, number of a page's texts (None: no page has text yet), whether pages differ].

def host_wrapper(page: Element) -> list:
    """The wrapper of a host with one page."""
    places: list[str] = []
    particle = describe(page, places)
    return [_without_places(particle), _number("\n".join(places)) if places else None, 0]


def _without_places(particle: list) -> list:
    kind, key, content, optional, repeated = particle
    if kind == "t":
        return [kind, key, dict.fromkeys(sorted(content), []) if content else None, optional, repeated]
    return [kind, key, [_without_places(p) for p in content], optional, repeated]


def merge_hosts(one: list, two: list) -> list:
    """One wrapper for two of the same host."""
    for a, b in ((one, two), (two, one)):
        if a[1] is None:
            return b
    return [merge(one[0], two[0]), min(one[1], two[1]), one[2] | two[2] | (one[1] != two[1])]


def template_places(own: list, wrapper: list, found: set[int]) -> set[int]:
    """Places of the page's texts that its wrapper has, in the particle they meet, as a text of all pages."""
    if own[0] == "t":
        for number, at in (own[2] or {}).items():
            if wrapper[2] and number in wrapper[2]:
                found.update(at)
        return found
    one, two, pairs = matched(own[2], wrapper[2], own[1] == "*")
    for i, j in pairs:
        if i is not None and j is not None:
            template_places(one[i], two[j], found)
    return found


def blocks(page: Element, wrapper: list | None) -> list[str]:
    """The article's blocks in page order; the wrapper is a particle as ``describe`` makes it of a page."""
    dropped: set[int] = set()
    if wrapper:
        dropped = template_places(describe(page, []), wrapper, dropped)
    out: list[str] = []
    _collect(page, not _has_main(page), dropped, out, 0)
    return out if out or not dropped else blocks(page, None)


def _has_main(element: Element) -> bool:
    return any(not isinstance(c, str) and not c.skip and (c.main and _has_text(c) or _has_main(c)) for c in element.children)


def _has_text(element: Element) -> bool:
    return any(isinstance(c, str) or not c.skip and _has_text(c) for c in element.children)


def _collect(element: Element, take: bool, dropped: set[int], out: list[str], place: int) -> int:
    """Appends the texts to take; ``place`` counts texts as ``describe`` does."""
    for child in element.children:
        if isinstance(child, str):
            if take and place not in dropped:
                out.append(child)
            place += 1
        elif not child.skip:
            place = _collect(child, take or child.main, dropped, out, place)
    return place


def _partial(source: DataFrame) -> DataFrame:
    """(host, wrapper): the wrappers of each task's pages."""
    def run(batches):
        held: dict[str, list] = {}

        def flush():
            made = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array([json.dumps(w) for w in held.values()], pa.string())],
                                              ["host", "wrapper"])
            held.clear()
            return made

        for batch in batches:
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = host_wrapper(parse((html or b"").decode("utf-8", "replace")))
                held[host] = merge_hosts(held[host], own) if host in held else own
            if len(held) > HELD_HOSTS:
                yield flush()
        yield flush()

    return source.select("host", "html").mapInArrow(run, "host string, wrapper string")


def _merged(wrappers: DataFrame, *keys: str) -> DataFrame:
    """One wrapper for all rows of the same keys; a task holds one at a time."""
    def run(batches):
        now, held = None, None
        for batch in batches:
            hosts, texts = [], []
            for row in batch.to_pylist():
                key = tuple(row[k] for k in keys)
                one = json.loads(row["wrapper"])
                if key == now:
                    held = merge_hosts(held, one)
                else:
                    if now is not None:
                        hosts.append(now[0])
                        texts.append(json.dumps(held))
                    now, held = key, one
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(texts, pa.string())], ["host", "wrapper"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now[0]], pa.string()), pa.array([json.dumps(held)], pa.string())], ["host", "wrapper"])

    return wrappers.repartition(*keys).sortWithinPartitions(*keys, "wrapper").mapInArrow(run, "host string, wrapper string")


def infer_wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, wrapper as JSON): one per host, from all its pages. Urls without a host share the empty one."""
    partial = _partial(_pages(pages, [url_col, html_col])).distinct()
    parts = partial.withColumn("part", F.pmod(F.xxhash64("wrapper"), F.lit(PARTS)))
    return stored(_merged(_merged(parts, "host", "part"), "host"), "wrappers")


def _pages(pages: DataFrame, columns: list[str]) -> DataFrame:
    """The columns, url and html first, as c0, c1, ...; the host; the html as bytes."""
    source = with_row(pages, columns)
    host = F.lower(F.regexp_extract(F.coalesce("c0", F.lit("")), "://([^/?#]*)", 1))
    return source.withColumns({"host": host, "html": F.col("c1").cast("binary")})


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of every page.

    Null pages and pages without content have an empty text. If a host's pages with text are all alike, nothing is taken
    for template. Repeated pages and ids are pages of their own, urls without a host share one wrapper, an empty table gives
    an empty table, and further columns are ignored, whatever their names.
    """
    wrappers = infer_wrappers(pages, url_col, html_col)
    source = _pages(pages, [url_col, html_col, id_col]).drop("c1")
    met = source.join(wrappers, "host", "left").select("c2", "c0", "html", "wrapper")
    schema = T.StructType([T.StructField(id_col, source.schema["c2"].dataType), T.StructField(url_col, T.StringType()), *fields("text string, n_chars bigint")])

    def run(batches):
        known: dict[str, list | None] = {}
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = []
                for html, text in zip(part.column(2).to_pylist(), part.column(3).to_pylist()):
                    if text not in known:
                        if len(known) > 1_000:
                            known.clear()
                        particle, _, differ = json.loads(text) if text else (None, None, 0)
                        known[text] = particle if differ else None
                    texts.append("\n\n".join(blocks(parse((html or b"").decode("utf-8", "replace")), known[text])))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], schema.names)

    return met.mapInArrow(run, schema)
