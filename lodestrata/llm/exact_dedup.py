"""Exact duplicates by a stateful stream whose state is kept on disk and never expires.

The state holds, for each digest, which document stays, where that document is,
and how many have come. Spark combines the rows of a digest in each task before
they reach the state, so a text with a third of all rows costs one row a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm.tables import stored
from lodestrata.session import work_dir

BLANKS = " \t\n\x0b\x0c\r"
_STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    # An open store keeps files of some megabytes that it has set aside; close it when its task ends.
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}


def normalised(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    for blank in BLANKS:
        text = F.replace(text, F.lit(blank), F.lit(""))
    return text


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def streamed_state(arrivals: DataFrame) -> DataFrame:
    """The state as a stream of changes: digest, keep (chars, id, locator) and group_size.

    ``arrivals`` is a stream with digest, chars, id and locator. Of equal texts the
    one with most characters stays, then the smallest id; null ids come last.
    """
    rank = F.struct(
        (-F.col("chars")).alias("fewer"), F.col("id").isNull().alias("unnamed"), F.col("id"), F.col("locator"))
    return arrivals.groupBy("digest").agg(F.min(rank).alias("keep"), F.count(F.lit(1)).alias("group_size"))


@contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    saved = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in saved.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def run_state(
    arrivals: DataFrame, folder: str, before_each: Callable[[int], None] | None = None
) -> DataFrame:
    """Runs the stream to the end of its source and returns the state: digest, keep_id, locator, group_size.

    The checkpoint in ``folder`` holds the state: a later run over more files goes
    on from it. Each micro-batch overwrites its own part of the log of changes, so
    a repeated one changes nothing.
    """
    spark = arrivals.sparkSession
    log = f"{folder}/changes"

    def keep_changes(changes: DataFrame, number: int) -> None:
        if before_each:
            before_each(number)
        changes.select(
            "digest", F.col("keep.id").alias("keep_id"), F.col("keep.locator").alias("locator"), "group_size"
        ).write.mode("overwrite").parquet(f"{log}/batch={number}")

    with _settings(spark, _STATE_SETTINGS):
        query = (
            streamed_state(arrivals).writeStream.outputMode("update").foreachBatch(keep_changes)
            .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
        )
        query.awaitTermination()
    changes = spark.read.parquet(log)
    latest = F.max_by(F.struct("keep_id", "locator", "group_size"), F.col("batch"))
    return changes.groupBy("digest").agg(latest.alias("last")).select("digest", "last.*")


def exact_dedup(
    spark: SparkSession,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    batch_bytes: int = 64 << 30,
    digest: Callable[[Column], Column] = sha256,
    folder: str | None = None,
) -> DataFrame:
    """One row per row of the Parquet table at ``path``: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are the same after all blanks are deleted; null counts
    as empty, and the empty texts are one group. The digests of the state are checked
    against the full bytes of every text that is not alone: the texts of a digest are
    grouped by their bytes, and a digest with more than one text is split into its
    texts. Repeated rows count one each; rows that share the kept id are all kept, so
    ids should be unique. An empty table gives no rows. Other columns are not read.
    ``batch_bytes`` bounds a micro-batch.
    """
    folder = folder or work_dir(spark, "exact-dedup")
    docs = spark.read.parquet(path)
    # A stream reads a single file only by a pattern; this one matches the path itself.
    pattern = f"{path.rstrip('/')[:-1]}[{path.rstrip('/')[-1]}]"
    source = spark.readStream.schema(docs.schema).option("maxBytesPerTrigger", batch_bytes).parquet(pattern)

    def read(df: DataFrame, locator: bool = False) -> DataFrame:
        place = [F.col("_metadata.file_path").alias("locator")] if locator else []
        return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *place).select(
            "id", F.length(F.coalesce("text", F.lit(""))).alias("chars"), normalised(F.col("text")).alias("bytes"),
            *["locator" for _ in place],
        )

    arrivals = read(source, True).select("id", "chars", "locator", digest(F.col("bytes")).alias("digest"))
    if docs.isEmpty():
        state = spark.createDataFrame([], f"digest string, keep_id {docs.schema[id_col].dataType.simpleString()}, "
                                          "locator string, group_size long")
    else:
        state = stored(run_state(arrivals, folder), "exact-dedup-state")
    rows = read(docs).select(
        "id", "chars", "bytes", digest(F.col("bytes")).alias("digest"), sha256(F.col("bytes")).alias("text_sha256"))
    labelled = stored(
        rows.select("id", "digest", "text_sha256").join(state.drop("locator"), "digest"), "exact-dedup-rows")
    collided = _collisions(rows, state)
    settled = labelled
    if not collided.isEmpty():
        settled = labelled.join(collided, "digest", "left_anti").unionByName(_by_bytes(rows, collided))
    return settled.select(
        F.col("id").alias(id_col), "keep_id", "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256",
    )


def _collisions(rows: DataFrame, state: DataFrame) -> DataFrame:
    """Digests of the state whose rows have different bytes. Only texts of groups travel, once a task."""
    shared = state.filter("group_size > 1").select("digest")
    texts = rows.select("digest", "bytes").join(shared, "digest", "left_semi").groupBy("digest", "bytes").agg(
        F.count(F.lit(1)).alias("n"))
    return stored(
        texts.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1").select("digest"),
        "exact-dedup-collisions",
    )


def _by_bytes(rows: DataFrame, collided: DataFrame) -> DataFrame:
    """The rows of these digests, grouped by their full bytes."""
    affected = rows.join(collided, "digest", "left_semi")
    rank = F.struct((-F.col("chars")).alias("fewer"), F.col("id").isNull().alias("unnamed"), F.col("id"))
    groups = stored(
        affected.groupBy("digest", "bytes").agg(
            F.min(rank)["id"].alias("keep_id"), F.count(F.lit(1)).alias("group_size")),
        "exact-dedup-split",
    )
    return affected.join(groups, ["digest", "bytes"]).select("digest", "id", "text_sha256", "keep_id", "group_size")


ORACLE = """
    WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS chars,
                      sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
               FROM documents)
    SELECT doc_id, first_value(doc_id) OVER w AS keep_id,
           count(*) OVER (PARTITION BY text_sha256) AS group_size,
           doc_id = first_value(doc_id) OVER w AS kept, text_sha256
    FROM n WINDOW w AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id)"""
