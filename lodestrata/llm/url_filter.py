"""Pages judged by their address: host and path rules first, then a weighted vocabulary."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lodestrata.llm.arrow import map_batches
from lodestrata.llm.url_terms import TERMS

# Fixed values. One strict term rejects an address; soft terms need several distinct ones.
SOFT_LIMIT = 2
STRICT_TERMS, SOFT_TERMS = (
    tuple(sorted(t for terms in TERMS.values() for t, weight in terms.items() if (weight >= SOFT_LIMIT) == strict))
    for strict in (True, False)
)
RULES = {
    "org/": "allow",
    "example.org/es/": "block",
    "example.org/en/1": "block",
    "com/fr/": "allow",
    "com/de/": "block",
}
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def parted(url: str | None) -> tuple[str, str]:
    """(host, path) of an address; both empty without ``://``."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    rest = rest[: min(i for i in (rest.find("?"), rest.find("#"), len(rest)) if i >= 0)]
    host, slash, path = rest.partition("/")
    return host.translate(_LOWER), slash + path


class Rules:
    """Rules by host; the longest rule that fits an address counts, of equals the one that blocks."""

    def __init__(self, rules: Mapping[str, str]) -> None:
        self.by_host: dict[str, list[tuple[str, str, str]]] = {}
        for rule, verdict in rules.items():
            host, slash, path = rule.partition("/")
            self.by_host.setdefault(host.translate(_LOWER), []).append((slash + path, rule, verdict))

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        best, suffix = None, host
        while True:
            for start, rule, verdict in self.by_host.get(suffix, ()):
                if path.startswith(start):
                    key = (len(rule), verdict == "block", rule)
                    if best is None or key > best[0]:
                        best = (key, rule, verdict)
            _, dot, suffix = suffix.partition(".")
            if not dot:
                return best and best[1:]


class Vocabulary:
    """Counts whole terms with one pass of an Aho-Corasick automaton.

    A term is whole if the characters beside it are not ASCII letters, digits or
    any character beyond ASCII.
    """

    def __init__(self, strict, soft) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for term in {*strict, *soft}:
            self.automaton.add_word(term, (term, term in set(strict)))
        self.automaton.make_automaton()

    def count(self, url: str) -> tuple[int, int]:
        """Distinct strict and distinct soft terms."""
        text = url.translate(_LOWER)
        strict, soft = set(), set()
        for end, (term, is_strict) in self.automaton.iter(text):
            start = end - len(term)
            if (start < 0 or _edge(text[start])) and (end + 1 == len(text) or _edge(text[end + 1])):
                (strict if is_strict else soft).add(term)
        return len(strict), len(soft)


def _edge(char: str) -> bool:
    return char < "\x80" and not char.isalnum()


def judge_urls(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: Mapping[str, str] = RULES,
    strict=STRICT_TERMS,
    soft=SOFT_TERMS,
    soft_limit: int = SOFT_LIMIT,
) -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule, verdict, ``n_strict``, ``n_soft``.

    The rule that fits decides; without one, a strict term or ``soft_limit``
    distinct soft terms block. A null address has an empty host and path, no terms,
    and is allowed; one without ``://`` has an empty host and path but its terms
    count. Nothing is shuffled; rules and terms are arguments and travel with the
    task. Repeated rows and null ids stay; other columns are not read.
    """
    id_field = T.StructField(id_col, pages.schema[id_col].dataType)
    schema = T.StructType([
        id_field,
        *[T.StructField(c, T.StringType()) for c in ("host", "path", "rule", "verdict")],
        *[T.StructField(c, T.LongType()) for c in ("n_strict", "n_soft")],
    ])
    rules, strict, soft = dict(rules), tuple(strict), tuple(soft)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, terms = Rules(rules), Vocabulary(strict, soft)
        for batch in batches:
            rows = []
            for url in batch.column(1).to_pylist():
                host, path = parted(url)
                found = table.find(host, path)
                n_strict, n_soft = terms.count(url or "")
                rejected = n_strict > 0 or n_soft >= soft_limit
                rule, verdict = found or (None, "block" if rejected else "allow")
                rows.append((host, path, rule, verdict, n_strict, n_soft))
            columns = list(zip(*rows)) if rows else [[]] * 6
            arrays = [pa.array(c, pa.string()) for c in columns[:4]] + [pa.array(c, pa.int64()) for c in columns[4:]]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=schema.names)

    return map_batches(pages.select(id_col, url_col), judged, schema)


def oracle_sql() -> str:
    """The same over ``pages`` for DuckDB, with one pattern for each term."""
    edge = "[\\x00-\\x2f\\x3a-\\x60\\x7b-\\x7f]"

    def hits(terms) -> str:
        return " + ".join(f"regexp_matches(low, '(^|{edge}){t}($|{edge})')::INT" for t in terms)

    rules = ", ".join(f"('{r}', '{r.split('/', 1)[0]}', '/{r.split('/', 1)[1]}', '{v}')" for r, v in RULES.items())
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
        WITH parts AS (
            SELECT page_id, translate(coalesce(url, ''), '{upper}', '{lower}') AS low,
                   CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN
                       regexp_extract(substr(url, strpos(url, '://') + 3), '^[^?#]*', 0, 's') ELSE '' END AS rest
            FROM pages),
        places AS (
            SELECT page_id, low, translate(regexp_extract(rest, '^[^/]*', 0, 's'), '{upper}', '{lower}') AS host,
                   regexp_replace(rest, '^[^/]*', '') AS path FROM parts),
        counted AS (SELECT *, ({hits(STRICT_TERMS)})::BIGINT AS n_strict, ({hits(SOFT_TERMS)})::BIGINT AS n_soft
                    FROM places),
        fits AS (
            SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(v, length(rule)) AS v
            FROM places JOIN (VALUES {rules}) r(rule, rhost, rpath, v)
                 ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
            GROUP BY 1)
        SELECT c.page_id, host, path, rule, n_strict, n_soft,
               coalesce(v, CASE WHEN n_strict > 0 OR n_soft >= {SOFT_LIMIT} THEN 'block' ELSE 'allow' END) AS verdict
        FROM counted c LEFT JOIN fits f ON c.page_id = f.page_id"""
