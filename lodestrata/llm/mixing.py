"""Sources mixed to target weights by weighted fair queueing.

Every copy of a document has a virtual finish time: the words its source has
given up to and including it, in shuffled order, over the source's target. The
mix is the order of finish times, cut where the budget is spent, so at any
point of it each source has given about the same share of its target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.llm.tables import stored, with_rows

WEIGHTS = (3, 1, 2)
SHARE, MOST_COPIES = 1.5, 2
# Rows of a slice of the shuffled order; the number of slices follows the input.
SLICE_ROWS = 20_000
NOT_BLANK = "[^\\x20\\x09-\\x0D]+"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(NOT_BLANK)), F.lit(0)).cast("long")


def place(id_col: Column, text: Column) -> Column:
    """Place in the shuffled order, from 0 to 1: the first 52 bits of a digest of the id, or of the text where that is null."""
    known = F.coalesce(id_col.cast("string"), F.md5(text), F.lit(""))
    digest = F.md5(F.concat(F.lit("mix:"), known))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(1 << 52)


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST_COPIES) -> DataFrame:
    """(sid, source_key, source_size, target): one row per source, by code point, null last.

    Targets are ``level * weight``, at most ``most`` times the size; the level is
    the one at which they add up to ``share`` of all words. The windows here see
    one row per source.
    """
    total = Window.partitionBy()
    ordered = Window.partitionBy().orderBy(F.col("source_key").asc_nulls_last())
    sources = (
        sizes.groupBy("source_key").agg(F.sum("size").alias("source_size"))
        .withColumn("sid", F.row_number().over(ordered) - 1)
        .withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("sid") % len(weights) + 1))
        .withColumn("cap", (F.col("source_size") * most).cast("double"))
        .withColumn("budget", F.sum("source_size").over(total) * F.lit(share))
    )
    # Sources that reach their cap at a lower level come first.
    by_level = Window.partitionBy().orderBy(F.col("cap") / F.col("weight"), "sid")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(0, Window.unboundedFollowing)
    levels = sources.withColumn(
        "level",
        (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after),
    )
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "sid", "level"))
    return levels.withColumn("chosen", F.min(fits).over(total)["level"]).select(
        "sid", "source_key", "source_size", "budget",
        F.coalesce(F.least(F.col("chosen") * F.col("weight"), F.col("cap")), F.col("cap")).alias("target"),
    )


def _running(rows: DataFrame, keys: list[str], cell: str, order: list, value: str, name: str) -> DataFrame:
    """Adds the running sum of ``value`` in ``order``, by way of sums over cells that the order visits in turn."""
    cells = rows.groupBy(*keys, cell).agg(F.sum(value).alias("__cell"))
    earlier = Window.partitionBy(*keys).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.select(*keys, cell, F.coalesce(F.sum("__cell").over(earlier), F.lit(0)).alias("__offset"))
    within = Window.partitionBy(*keys, cell).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.join(offsets, [*keys, cell])
        .withColumn(name, F.col("__offset") + F.sum(value).over(within))
        .drop("__offset")
    )


def fair_queue(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    share: float = SHARE,
    most: int = MOST_COPIES,
    row_col: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(rows, taken copies) of the mix.

    rows: ``row`` (``row_col``, or else a number given to the input row here), ``id``, ``size``, ``source_size``,
    ``target``. copies: ``row``, ``copy`` (0 for the first pass over the source),
    ``finish``, for each copy of a row that the mix takes.

    A null text has size zero; null sources are one source. Texts without words
    give nothing and are never taken. Repeated rows are documents of their own.
    Columns other than the three are not read. With no words at all every target
    is zero.
    """
    sizes = stored(
        docs.select(
            (F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("row"),
            F.col(id_col).alias("id"),
            F.col(source_col).alias("source_key"),
            words(F.col(text_col)).alias("size"),
            place(F.col(id_col), F.col(text_col)).alias("place"),
        ),
        "mix-sizes",
    )
    sources = stored(targets(sizes, weights, share, most), "mix-targets")
    rows = sizes.join(sources, sizes.source_key.eqNullSafe(sources.source_key)).select(
        "row", "id", "sid", "size", "place", "source_size", "target", "budget")
    slices = F.lit(max(1, sizes.count() // SLICE_ROWS))
    served = rows.filter("size > 0 AND target > 0").withColumn("cell", F.floor(F.col("place") * slices))
    served = _running(served, ["sid"], "cell", ["place", "id", "size", "row"], "size", "given")
    copies = served.select(
        "row", "id", "sid", "size", "place", "target", "budget",
        F.posexplode(F.transform(
            F.sequence(F.lit(0), F.lit(most - 1)),
            lambda copy: (copy.cast("long") * F.col("source_size") + F.col("given")) / F.col("target"),
        )).alias("copy", "finish"),
    ).withColumn("cell", F.floor(F.col("finish") * slices))
    queue = _running(copies, [], "cell", ["finish", "sid", "copy", "place", "id", "size", "row"], "size", "spent")
    return rows, queue.filter(F.col("spent") <= F.col("budget")).select("row", "copy", "finish")


def mix(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per row of ``docs``: the id, size, source_size, target and taken (words, copies counted)."""
    rows, copies = fair_queue(docs, id_col, **options)
    counts = copies.groupBy("row").agg(F.count(F.lit(1)).alias("copies"))
    return rows.join(counts, "row", "left").select(
        F.col("id").alias(id_col), "size", "source_size", "target",
        (F.col("size") * F.coalesce("copies", F.lit(0))).alias("taken"),
    )


def mixed(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options
) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken, range-sorted by finish time.

    Rows are known by their ids, or by numbers written with them where ids don't tell
    them apart: files may be split otherwise when they are read again. Other columns may
    have any names and come back as they are.
    """
    whole, _ = with_rows(docs, id_col)
    doc = F.col("doc")
    read = whole.select("row", doc.getField(id_col).alias("id"), doc.getField(text_col).alias("text"),
                        doc.getField(source_col).alias("source"))
    _, copies = fair_queue(read, "id", "text", "source", row_col="row", **options)
    ordered = whole.join(copies, "row").repartitionByRange("finish", "row", "copy").sortWithinPartitions(
        "finish", "row", "copy")
    return ordered.select("doc.*")


ORACLE = f"""
    WITH sizes AS (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{NOT_BLANK}'))::BIGINT AS size,
               ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, md5(text), '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE
               AS place
        FROM documents),
    sources AS (
        SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid
        FROM sizes GROUP BY 1),
    weighed AS (
        SELECT *, [3, 1, 2][sid % 3 + 1] AS weight, (2 * source_size)::DOUBLE AS cap,
               (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS budget FROM sources),
    levels AS (
        SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY cap / weight, sid
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                  / (sum(weight) OVER (ORDER BY cap / weight, sid
                                       ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
        FROM weighed),
    chosen AS (SELECT level FROM levels WHERE level * weight <= cap ORDER BY cap / weight, sid LIMIT 1),
    goals AS (
        SELECT sid, source, source_size, budget,
               coalesce(least((SELECT level FROM chosen) * weight, cap), cap) AS target FROM levels),
    given AS (
        SELECT doc_id, sid, size, place, source_size, target, budget,
               (sum(size) OVER (PARTITION BY sid ORDER BY place, doc_id))::BIGINT AS given
        FROM sizes JOIN goals ON sizes.source IS NOT DISTINCT FROM goals.source WHERE size > 0 AND target > 0),
    queue AS (
        SELECT doc_id, size, budget,
               sum(size) OVER (ORDER BY (copy * source_size + given) / target, sid, copy, place, doc_id
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS spent
        FROM given, (VALUES (0), (1)) c(copy)),
    taken AS (SELECT doc_id, count(*) AS copies FROM queue WHERE spent <= budget GROUP BY 1)
    SELECT d.doc_id, d.size, source_size, target, (d.size * coalesce(copies, 0))::BIGINT AS taken
    FROM sizes d JOIN goals ON d.source IS NOT DISTINCT FROM goals.source LEFT JOIN taken t ON d.doc_id = t.doc_id"""
