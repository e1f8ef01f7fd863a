"""Allow and block rules for URLs in a trie over reversed host labels and path segments."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
# Value fixed by the contract of the query.
QUERY_RULES = (
    (ALLOW, "com", "/"),
    (BLOCK, "example.com", "/en/"),
    (ALLOW, "www.example.com", "/en/"),
    (BLOCK, "net", "/es/"),
    (BLOCK, "net", "/fr/"),
)
_ASCII_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})


def split_url(url: str | None) -> tuple[str, str]:
    """Host in lower case and path; both empty for null and for text without ``://``."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    stop = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    tail = rest[stop:]
    cut = min((i for i in map(tail.find, "?#") if i >= 0), default=len(tail))
    return rest[:stop].translate(_ASCII_LOWER), tail[:cut]


def _segments(path: str) -> tuple[list[str], str]:
    """Whole segments, each with the slash that ends it, and the open rest."""
    parts = path.split("/")
    return [p + "/" for p in parts[:-1]], parts[-1]


class RuleTrie:
    """Longest match: the most host labels first, then the longest path; of equal rules the block wins.

    A rule fits its host and all subdomains when the path starts with the
    rule's. An empty rule host fits every host.
    """

    def __init__(self, rules: Iterable[tuple[str, str, str]]) -> None:
        self._root: dict = {"hosts": {}, "paths": None}
        for verdict, host, path in rules:
            host, node = host.translate(_ASCII_LOWER), self._root
            for label in reversed(host.split(".")) if host else []:
                node = node["hosts"].setdefault(label, {"hosts": {}, "paths": None})
            node["paths"] = place = node["paths"] or {"next": {}, "rests": {}}
            whole, rest = _segments(path)
            for segment in whole:
                place = place["next"].setdefault(segment, {"next": {}, "rests": {}})
            if place["rests"].get(rest, ("", ""))[1] != BLOCK:
                place["rests"][rest] = (host + path, verdict)

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        """``(rule, verdict)`` or nothing."""
        node, best = self._root, None
        for label in [None, *reversed(host.split("."))]:
            if label is not None:
                node = node["hosts"].get(label)
                if node is None:
                    break
            best = self._in_paths(node["paths"], path) or best
        return best

    @staticmethod
    def _in_paths(place: dict | None, path: str) -> tuple[str, str] | None:
        best, at = None, 0
        while place is not None:
            fits = [rest for rest in place["rests"] if path.startswith(rest, at)]
            if fits:
                best = place["rests"][max(fits, key=len)]
            stop = path.find("/", at)
            if stop < 0:
                break
            place, at = place["next"].get(path[at : stop + 1]), stop + 1
        return best


def judge(
    pages: DataFrame, rules: Iterable[tuple[str, str, str]] = QUERY_RULES, default: str = ALLOW, key: str = "page_id", url: str = "url"
) -> DataFrame:
    """Per row of ``pages``: key, ``host``, ``path``, the ``rule`` that decides (else null) and the ``verdict``.

    A null or odd URL has an empty host and path; no rule with a host fits it,
    so it gets ``default``. Rows may repeat, other columns are left out, and
    an empty table gives an empty table. The trie grows with the rule list,
    not with the pages; it is built on the driver and broadcast.
    """
    trie = pages.sparkSession.sparkContext.broadcast(RuleTrie(rules))

    @F.arrow_udf("struct<host:string,path:string,rule:string,verdict:string>")
    def judged(urls: pa.Array) -> pa.Array:
        rows = []
        for value in urls.to_pylist():
            host, path = split_url(value)
            rows.append((host, path, *(trie.value.match(host, path) or (None, default))))
        return pa.StructArray.from_arrays(
            [pa.array(c, pa.string()) for c in (zip(*rows, strict=True) if rows else [[]] * 4)],
            ["host", "path", "rule", "verdict"],
        )

    return pages.select(key, judged(F.col(url)).alias("__llm_judged")).select(key, "__llm_judged.*")


# The same by prefixes of text, for the five rules above.
ORACLE_SQL = r"""
WITH u AS (
  SELECT page_id, CASE WHEN url IS NOT NULL AND strpos(url, '://') > 0
                       THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
h AS (SELECT page_id, rest, coalesce(regexp_extract(rest, '^[^/?#]*'), '') AS raw FROM u),
p AS (
  SELECT page_id,
         translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*'), '') AS path FROM h),
rules(verdict, host, path, rule) AS (VALUES
  ('allow', 'com', '/', 'com/'), ('block', 'example.com', '/en/', 'example.com/en/'),
  ('allow', 'www.example.com', '/en/', 'www.example.com/en/'),
  ('block', 'net', '/es/', 'net/es/'), ('block', 'net', '/fr/', 'net/fr/')),
m AS (
  SELECT p.page_id, p.host, p.path, r.rule, r.verdict,
         row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.rule) DESC NULLS LAST) AS n
  FROM p LEFT JOIN rules r
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE n = 1
"""
