"""Whole texts that are known licences, found by a digest of their canonical form.

The canonical form is made by SQL functions alone, and the digests of the known
texts are made by the same expression, so both sides always agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.license_texts import KNOWN_LICENSES, TITLES

# Spellings that count as the same, applied to single words.
SPELLINGS = (
    ("acknowledgement", "acknowledgment"),
    ("analyse", "analyze"),
    ("artefact", "artifact"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("calibre", "caliber"),
    ("cancelled", "canceled"),
    ("favour", "favor"),
    ("fulfil", "fulfill"),
    ("initialise", "initialize"),
    ("judgement", "judgment"),
    ("labelled", "labeled"),
    ("licence", "license"),
    ("licenced", "licensed"),
    ("licencee", "licensee"),
    ("licences", "licenses"),
    ("merchantibility", "merchantability"),
    ("noninfringement", "non infringement"),
    ("optimise", "optimize"),
    ("organisation", "organization"),
    ("organisations", "organizations"),
    ("programme", "program"),
    ("recognised", "recognized"),
    ("sublicence", "sublicense"),
    ("sub license", "sublicense"),
    ("whilst", "while"),
    ("wilful", "willful"),
    ("copyright holder", "copyright owner"),
    ("copyright holders", "copyright owners"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A line that begins with a copyright mark, with or without a sign or a year, or that only reserves all rights.
COPYRIGHT_LINE = "(^|[\\n\\r])[ \\t#*/;-]*((portions[ \\t]+)?copyright\\b|[(]c[)]|©|all rights reserved)[^\\n\\r]*"
# Lines of a wrapped sentence that happen to begin with the word: they get a mark, which goes as punctuation does.
WRAPPED_LINE = "(^|[\\n\\r])[ \\t#*/;-]*copyright([ \\t]+(notices?|holders?|owners?|laws?|interests?)\\b)"
NOT_WORD = "[^a-z0-9]+"


def canonical(text: Column) -> Column:
    """Lower case, no copyright lines, words parted by one blank, one spelling each."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    kept = F.regexp_replace(F.regexp_replace(lowered, WRAPPED_LINE, "\n.copyright$2"), COPYRIGHT_LINE, "\n")
    words = F.regexp_replace(kept, NOT_WORD, " ")
    words = F.concat(F.lit(" "), F.trim(words), F.lit(" "))
    for variant, chosen in SPELLINGS:
        words = F.replace(words, F.lit(f" {variant} "), F.lit(f" {chosen} "))
    return F.trim(words)


def with_titles(texts: dict[str, str]) -> list[tuple[str, str]]:
    """(name, text) of each text as it is and under each of its usual titles."""
    return [(name, f"{title}\n\n{text}") for name, text in texts.items() for title in ("", *TITLES.get(name, ()))]


def known_digests(spark, texts: dict[str, str] = KNOWN_LICENSES) -> DataFrame:
    """(known_digest, license_id) of the known texts; of equal texts the first name counts."""
    rows = F.array(*[F.struct(F.lit(name).alias("license_id"), F.lit(text).alias("known_text"))
                     for name, text in with_titles(texts)])
    return (
        spark.range(1).select(F.inline(rows))
        .groupBy(F.sha2(canonical(F.col("known_text")), 256).alias("known_digest"))
        .agg(F.min("license_id").alias("license_id"))
    )


def license_scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    texts: dict[str, str] = KNOWN_LICENSES,
) -> DataFrame:
    """One row per row of ``docs``: the id, ``canonical_digest``, ``n_words`` and ``license_id``.

    ``license_id`` is null unless the whole canonical text equals that of a known
    licence, with one of its usual titles or without. A null or empty text, or one of punctuation or copyright lines only,
    has zero words and no licence. Repeated rows give repeated rows; null ids stay;
    other columns are not read. The known texts are an argument, so the side that
    Spark may broadcast is as small as that argument.
    """
    form = docs.select(F.col(id_col), canonical(F.col(text_col)).alias("form"))
    keyed = form.select(
        id_col,
        F.sha2("form", 256).alias("canonical_digest"),
        F.when(F.col("form") == "", 0).otherwise(
            F.length("form") - F.length(F.replace("form", F.lit(" "), F.lit(""))) + 1
        ).cast("long").alias("n_words"),
    )
    known = known_digests(docs.sparkSession, texts)
    return keyed.join(known, keyed.canonical_digest == known.known_digest, "left").drop("known_digest")


def oracle_sql(texts: dict[str, str] = KNOWN_LICENSES) -> str:
    """The same over ``documents`` for DuckDB."""

    def quoted(value: str) -> str:
        return "'" + value.replace("'", "''") + "'"

    def form(text: str) -> str:
        lowered = f"translate(coalesce({text}, ''), '{UPPER}', '{LOWER}')"
        marked = f"regexp_replace({lowered}, {quoted(WRAPPED_LINE)}, chr(10) || '.copyright' || chr(92) || '2', 'g')"
        kept = f"regexp_replace({marked}, {quoted(COPYRIGHT_LINE)}, chr(10), 'g')"
        words = f"' ' || trim(regexp_replace({kept}, {quoted(NOT_WORD)}, ' ', 'g')) || ' '"
        for variant, chosen in SPELLINGS:
            words = f"replace({words}, ' {variant} ', ' {chosen} ')"
        return f"trim({words})"

    values = ", ".join(f"({quoted(n)}, {quoted(t)})" for n, t in with_titles(texts))
    return f"""
        WITH known AS (SELECT sha256({form('known_text')}) AS known_digest, min(name) AS license_id
                       FROM (VALUES {values}) v(name, known_text) GROUP BY 1),
        forms AS (SELECT doc_id, {form('text')} AS form FROM documents)
        SELECT doc_id, sha256(form) AS canonical_digest,
               CASE WHEN form = '' THEN 0 ELSE length(form) - length(replace(form, ' ', '')) + 1 END AS n_words,
               license_id
        FROM forms LEFT JOIN known ON sha256(form) = known_digest"""
