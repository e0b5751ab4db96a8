"""Helpers the operators of this package share."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import checkpoint_dir, tune

#: Fixed value: what separates words; a word is a run of ASCII digits, small letters and non-ASCII characters.
NON_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The columns that name a row, see ``keyed``.
ROW_KEY = ["__row_id", "__row_text"]


#: Rows of an Arrow batch: Spark's default, and where a row holds a whole text and a task little memory.
BATCH_ROWS, TEXT_BATCH_ROWS = 10_000, 1000


def prepare(spark: SparkSession, batch_rows: int = BATCH_ROWS) -> None:
    """Session settings of these operators: the library's, shuffle files that go with the job that wrote them, rows of an Arrow batch."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch_rows))
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def lower_ascii(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), CAPITALS, SMALL)


def words(text: Column) -> Column:
    """The words of a text, A-Z lower-cased; a NULL text has none."""
    return F.array_remove(F.split(lower_ascii(text), NON_WORD), "")


def keyed(df: DataFrame, id: str, text: str) -> DataFrame:
    """Adds the row key: the id and a hash of the text.

    An operator's answer for a row depends on its id and text only, so rows that agree in both
    share one answer and no row number is needed. NULL ids have a key like any other id.
    """
    kind = df.schema[id].dataType
    return df.withColumn(ROW_KEY[0], F.coalesce(F.col(id), F.lit("0").cast(kind))).withColumn(
        ROW_KEY[1], F.xxhash64(F.coalesce(F.col(text), F.lit("")), F.col(id).isNull()))


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet in the shared checkpoint folder, and read from there.

    Later steps read only the columns they use, and a lost executor costs no recomputation.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def maybe_broadcast(df: DataFrame, rows: int, most: int) -> DataFrame:
    """A broadcast hint where the counted ``rows`` are within ``most``; else Spark shuffles the join."""
    return F.broadcast(df) if rows <= most else df


def unit_hash(*parts: Column) -> Column:
    """A repeatable number in [0, 1) from 32 bits of an MD5."""
    digest = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
