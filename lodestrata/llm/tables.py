"""Written tables between the steps of an operator."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.session import work_dir

# Bits of a filter of rows: 8 MB.
FILTER_BITS = 1 << 26


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str, **options) -> DataFrame:
    """``df`` as a table in the shared folder: it cuts lineage and survives lost executors."""
    path = work_dir(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Buckets:
    """Written tables in buckets of one key, so that joins of them on the key shuffle nothing.

    Their names leave the catalog at the end, their files lie in the shared folder.
    """

    def __init__(self, spark: SparkSession, key: str) -> None:
        self.spark, self.key = spark, key
        self.count = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.names: list[str] = []

    def stored(self, df: DataFrame, label: str) -> DataFrame:
        name = f"lodestrata_{label}_{uuid.uuid4().hex}"
        self.names.append(name)
        df.write.bucketBy(self.count, self.key).sortBy(self.key).option(
            "path", work_dir(self.spark, label)).format("parquet").saveAsTable(name)
        return self.spark.table(name)

    def __enter__(self) -> Buckets:
        return self

    def __exit__(self, *_) -> None:
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def numbers_rows(df: DataFrame, id_col: str) -> bool:
    """Whether the ids are whole numbers without nulls or repetitions."""
    if not isinstance(df.schema[id_col].dataType, (T.LongType, T.IntegerType, T.ShortType)):
        return False
    counts = df.agg(F.count(F.lit(1)), F.count_distinct(id_col)).first()
    return counts[0] == counts[1]


def numbered(df: DataFrame, id_col: str, value_col: str, value: str = "text") -> tuple[DataFrame, bool]:
    """(rows with a unique long ``row``, the ``id`` and the value; whether ``row`` is the id itself).

    Whole-number ids without nulls or repetitions number the rows. Otherwise the rows
    get numbers of their own, and are written so that they keep them.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(value_col).alias(value))
    if numbers_rows(df, id_col):
        return rows.select(F.col("id").cast("long").alias("row"), "id", value), True
    return stored(rows.select(F.monotonically_increasing_id().alias("row"), "id", value), "numbered"), False


def with_rows(df: DataFrame, id_col: str) -> tuple[DataFrame, bool]:
    """((row, doc): a unique long ``row``, as ``numbered`` gives it, and all columns as one struct, whatever their names;
    whether ``row`` is the id itself)."""
    doc = F.struct("*").alias("doc")
    if numbers_rows(df, id_col):
        return df.select(F.col(id_col).cast("long").alias("row"), doc), True
    return stored(df.select(F.monotonically_increasing_id().alias("row"), doc), "numbered"), False


def likely_rows(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """``rows`` (with a long ``row``) without most of those whose ``row`` isn't in ``keys``; none that is goes.

    ``FILTER_BITS`` bits say which rows may be meant: they are put together by Spark and broadcast as
    at most ``FILTER_BITS / 64`` numbers, whatever the input. It spares a join the shuffle of texts
    that it would drop; where most bits are set it spares nothing, and the join is right as before.
    """
    def slot(column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(FILTER_BITS))

    marks = keys.select(slot("row").alias("slot")).groupBy(F.shiftright("slot", 6).alias("__word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(slot % 64 as int))")).alias("__bits"))
    hashed = rows.select("*", slot("row").alias("__slot"))
    met = hashed.join(F.broadcast(marks), F.shiftright("__slot", 6) == F.col("__word"))
    return met.filter(F.expr("shiftright(__bits, cast(__slot % 64 as int)) & 1 = 1")).select(*rows.columns)
