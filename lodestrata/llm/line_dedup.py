"""Lines that a large share of a site's pages have in common are dropped from its pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.tables import stored

RATIO, MIN_PAGES = 0.1, 10


def _trimmed(line: Column) -> Column:
    return F.trim(line, F.lit(" \t\r"))


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def boilerplate(
    docs: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """(host, lines): for each host the digests of its boilerplate lines.

    Pages of one host with equal texts are one page here, so copies of a page don't
    make its lines boilerplate. A host's array has at most (lines per page) /
    ``ratio`` entries, whatever the number of its pages. Lines are made distinct by
    host, line and page before they are counted, and counts are combined before the
    shuffle, so neither a host with a third of all rows nor a line on all of its
    pages meets in one task.
    """
    body = F.coalesce(F.col(text_col), F.lit(""))
    pages = docs.select(F.col(host_col).alias("host"), body.alias("body"), _digest(body).alias("page"))
    totals = pages.select("host", "page").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("total"))
    lines = pages.select(
        "host", "page", F.explode(F.array_distinct(F.transform(F.split("body", "\n"), _trimmed))).alias("line")
    ).filter("line <> ''")
    found = lines.select("host", _digest(F.col("line")).alias("line"), "page").distinct()
    counts = found.groupBy("host", "line").agg(F.count(F.lit(1)).alias("pages"))
    # Any line above the ratio has more than ratio * min_pages pages.
    frequent = counts.filter(F.col("pages") > ratio * min_pages)
    return (
        frequent.join(totals, frequent.host.eqNullSafe(totals.host))
        .filter((F.col("total") >= min_pages) & (F.col("pages") > ratio * F.col("total")))
        .groupBy(frequent.host)
        .agg(F.collect_list("line").alias("lines"))
    )


def drop_boilerplate(
    docs: DataFrame,
    host_col: str = "source",
    text_col: str = "text",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """``docs`` with the boilerplate lines gone from the text, plus ``n_lines`` and ``n_dropped``.

    Lines are parted by line feeds and compared without blanks at their ends. A
    line goes if more than ``ratio`` of its host's pages have it and the host has
    ``min_pages`` pages at least; blank lines stay. Rows of a host with equal texts
    count as one page. A page of such lines only is left with an empty text or with
    its blank lines.

    A null text stays null and has no lines; it counts as an empty page. Null hosts
    are one host. Existing columns called ``n_lines`` or ``n_dropped`` are replaced;
    all others are passed on.

    The hosts' lines are written first, so Spark knows their size when it plans the
    join: small ones are broadcast and no text is shuffled.
    """
    sites = stored(boilerplate(docs, host_col, text_col, ratio, min_pages), "site-lines").select(
        F.col("host").alias("__host"), F.col("lines").alias("__site_lines"))
    joined = docs.join(sites, docs[host_col].eqNullSafe(sites["__host"]), "left")
    text = docs[text_col]
    lines = F.split(text, "\n")
    known = sites["__site_lines"]
    stay = F.filter(lines, lambda x: (_trimmed(x) == "") | ~F.array_contains(known, _digest(_trimmed(x))))
    kept = F.when(known.isNotNull() & text.isNotNull(), stay)
    own = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    # Columns of the documents travel as one struct, so that their names can't clash.
    parted = joined.select(F.struct(*[docs[c] for c in own]).alias("doc"), kept.alias("kept"))
    text = F.col("doc").getField(text_col)
    size = F.size(F.split(text, "\n"))
    cleaned = F.coalesce(F.array_join("kept", "\n"), text).alias(text_col)
    return parted.select(
        *[cleaned if c == text_col else F.col("doc").getField(c).alias(c) for c in own],
        F.when(text.isNull(), 0).otherwise(size).cast("long").alias("n_lines"),
        F.when(F.col("kept").isNull(), 0).otherwise(size - F.size("kept")).cast("long").alias("n_dropped"),
    )


ORACLE = f"""
    WITH pages AS (SELECT doc_id, source, text, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
    found AS (SELECT DISTINCT source, coalesce(text, '') AS page, trim(unnest(ls), ' ' || chr(9) || chr(13)) AS line
              FROM pages),
    often AS (
        SELECT source, line FROM
            (SELECT source, line, count(*) AS n FROM found WHERE line <> '' GROUP BY ALL)
            JOIN (SELECT source AS s, count(DISTINCT coalesce(text, '')) AS total FROM pages GROUP BY 1) ON source IS NOT DISTINCT FROM s
        WHERE total >= {MIN_PAGES} AND n > CAST({RATIO} AS DOUBLE) * total),
    numbered AS (
        SELECT doc_id, source, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM pages WHERE text IS NOT NULL),
    marked AS (
        SELECT doc_id, pos, numbered.line AS line, often.line IS NOT NULL AS drops
        FROM numbered LEFT JOIN often ON numbered.source IS NOT DISTINCT FROM often.source
             AND trim(numbered.line, ' ' || chr(9) || chr(13)) = often.line),
    judged AS (
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE drops) AS n_dropped,
               string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT drops) AS kept
        FROM marked GROUP BY 1)
    SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped,
           sha256(coalesce(kept, '')) AS kept_sha256
    FROM documents d LEFT JOIN judged j ON d.doc_id = j.doc_id"""
