"""URL allow and block lists: a trie over reversed host labels and path segments.

A rule holds for its host and all subdomains where the path starts with the
rule's path.  The trie is first walked by host labels from the right; each node
may hold a second trie over path segments.  Among the rules on the way, the one
with most host labels wins, then the one with the longest path.  The trie grows
with the rule list only, and is sent to the workers once.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class Rule(NamedTuple):
    """A list entry: ``verdict`` is ``allow`` or ``block``; ``path`` starts with ``/``."""

    verdict: str
    host: str
    path: str


class UrlTrie:
    """Longest-match lookup of rules by host and path."""

    def __init__(self, rules: Iterable[Rule]):
        self._root: dict = {}
        for rule in rules:
            node = self._root
            for label in reversed(rule.host.split(".")):
                node = node.setdefault(("host", label), {})
            *segments, rest = rule.path.split("/")
            for segment in segments:
                node = node.setdefault(("path", segment), {})
            # What follows the last slash may end inside a segment.
            node.setdefault("ends", {})[rest] = (rule.host + rule.path, rule.verdict)

    @staticmethod
    def _by_path(node: dict, segments: list[str]) -> tuple[str, str] | None:
        found = None
        for segment in segments:
            # Segments of a rule are closed by a slash, its rest is the start of a segment.
            if "ends" in node:
                fits = [rest for rest in node["ends"] if segment.startswith(rest)]
                if fits:
                    found = node["ends"][max(fits, key=len)]
            node = node.get(("path", segment))
            if node is None:
                break
        return found

    def match(self, host: str, path: str) -> tuple[str | None, str | None]:
        """The winning rule, written as host and path, and its verdict; None if there is none."""
        best, node, segments = None, self._root, path.split("/")
        for label in reversed(host.split(".")):
            node = node.get(("host", label))
            if node is None:
                break
            best = self._by_path(node, segments) or best
        return best or (None, None)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host, path = (F.coalesce(F.regexp_extract(url, pattern, i), F.lit("")) for i in (1, 2))
    return F.translate(host, _UPPER, _UPPER.lower()), path


def judge_urls(
    pages: DataFrame,
    rules: Iterable[Rule],
    default: str = "allow",
    page_id: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for each row of ``pages``.

    ``rule`` is the winning rule as host and path, or null, in which case ``verdict``
    is ``default``.  Of two equal rules the later one counts.  A null URL, and one
    without ``://``, has an empty host and path.  Repeated rows give repeated
    results; other columns are ignored, whatever their names.
    """
    trie = pages.sparkSession.sparkContext.broadcast(UrlTrie(rules))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = trie.value.match
        for batch in batches:
            found = [match(h.as_py(), p.as_py()) for h, p in zip(batch["host"], batch["path"])]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch[name] for name in ("page_id", "host", "path")),
                    pa.array([rule for rule, _ in found], pa.string()),
                    pa.array([verdict or default for _, verdict in found], pa.string()),
                ],
                ["page_id", "host", "path", "rule", "verdict"],
            )

    host, path = url_parts(F.col(url).cast("string"))
    kind = pages.schema[page_id].dataType.simpleString()
    return pages.select(
        F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path")
    ).mapInArrow(
        judge, f"page_id {kind}, host string, path string, rule string, verdict string"
    )
