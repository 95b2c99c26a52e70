"""Allow and block lists for URLs: a trie over reversed host labels, then path segments; the longest rule wins.

A rule is a host and a path, like ``example.org/es/``. It fits its host and all subdomains, if the path of the url
starts with the rule's. Of all fitting rules the one with the most host labels wins, among those the one with the
longest path; if a host and path is both allowed and blocked, the block holds.

The lists come from the caller as Python values, so they fit on the driver; their size is checked before the trie is
sent to the executors. Urls are judged where they are read: one pass, two columns, no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from .common import fields, map_texts

#: Most rules and characters of a trie that is sent to every executor.
MAX_RULES, MAX_RULE_CHARS = 2_000_000, 200_000_000

_UPPER = bytes(range(65, 91))
_LOWER = bytes.maketrans(_UPPER, _UPPER.lower())


def split_url(url: bytes | None) -> tuple[bytes, bytes]:
    """(host, path): after the first "://" up to "/", "?" or "#", A-Z lower-cased, then up to "?" or "#"."""
    if url is None:
        return b"", b""
    _, found, rest = url.partition(b"://")
    if not found:
        return b"", b""
    rest = rest.partition(b"#")[0].partition(b"?")[0]
    host, slash, path = rest.partition(b"/")
    return host.translate(_LOWER), slash + path


class UrlTrie:
    """Nodes are dicts: host labels from the last to the first, then below ``paths`` whole path segments.

    The last segment of a rule need not be whole (``/en/1`` fits ``/en/123``), so a node of the path trie keeps the
    open ends of its rules by length.
    """

    def __init__(self, rules: Iterable[tuple[str, str, str]]):
        self.root: dict = {}
        count = chars = 0
        for verdict, host, path in rules:
            if verdict not in ("allow", "block"):
                raise ValueError(f"a rule is allow or block, not {verdict!r}")
            count, chars = count + 1, chars + len(host) + len(path)
            node = self.root
            for label in reversed(host.encode().translate(_LOWER).split(b".")):
                node = node.setdefault("labels", {}).setdefault(label, {})
            node = node.setdefault("paths", {})
            *whole, end = path.encode().split(b"/")
            for segment in whole:
                node = node.setdefault("segments", {}).setdefault(segment, {})
            ends = node.setdefault("ends", {}).setdefault(len(end), {})
            if ends.get(end, ("", "allow"))[1] == "allow":
                ends[end] = (host + path, verdict)
        if count > MAX_RULES or chars > MAX_RULE_CHARS:
            raise ValueError(f"{count} rules of {chars} characters are too many to be sent to the executors")

    def match(self, host: bytes, path: bytes) -> tuple[str, str] | None:
        node, best = self.root, None
        for label in reversed(host.split(b".")):
            node = node.get("labels", {}).get(label)
            if node is None:
                break
            if "paths" in node:
                best = self._longest(node["paths"], path.split(b"/")) or best
        return best

    @staticmethod
    def _longest(node: dict, segments: list[bytes]) -> tuple[str, str] | None:
        best = None
        for segment in segments:
            # An open end lies within this segment: a segment that a rule has whole is a level of its own.
            for size, ends in sorted(node.get("ends", {}).items()):
                if size <= len(segment) and segment[:size] in ends:
                    best = ends[segment[:size]]
            node = node.get("segments", {}).get(segment)
            if node is None:
                break
        return best


def judge_urls(pages: DataFrame, rules: Iterable[tuple[str, str, str]], default: str = "allow", id_col: str = "page_id",
               url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict) of every row. ``default`` holds where no rule fits (rule null).

    Null urls and urls without "://" have an empty host and path. The id may repeat or be null.
    """
    trie = pages.sparkSession.sparkContext.broadcast(UrlTrie(rules))

    def setup():
        known = trie.value

        def work(urls):
            parts = [split_url(u) for u in urls]
            found = [known.match(h, p) for h, p in parts]
            return ([h.decode("utf-8", "replace") for h, _ in parts], [p.decode("utf-8", "replace") for _, p in parts],
                    [f and f[0] for f in found], [f[1] if f else default for f in found])

        return work

    return map_texts(pages, id_col, url_col, setup, fields("host string, path string, rule string, verdict string"))
