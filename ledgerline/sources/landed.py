"""Reading landed documents.

A landed document is one response of a vendor, kept as one JSON line.  Folders
``landed_date=YYYY-MM-DD`` hold the documents of a run day, so a day range
prunes folders.  Schemas are explicit: nothing is inferred, and a document that
is not JSON stops the job instead of turning into an empty page.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from ledgerline.functions.calc import in_range
from ledgerline.operators.partitions import range_folders

LANDED_DATE = "landed_date"
# Where pages are loaded in one pass: what a page says of its place among the others, on
# its first row only, and whether a row is a record at all (an empty page has none).
PAGE, IS_RECORD = "page_link", "is_record"
STRICT = {"mode": "FAILFAST"}


def read_documents(
    spark: SparkSession,
    path: str,
    schema: StructType,
    start: date | None = None,
    end: date | None = None,
) -> DataFrame:
    """Documents under ``path``; ``landed_date`` comes from the folder names.

    With a day range only its folders are listed, which matters once years of
    days have been landed.
    """
    dated = StructType([*schema.fields, StructField(LANDED_DATE, DateType())])
    reader = spark.read.options(**STRICT).schema(dated)
    if start is None or end is None:
        return reader.json(path)
    folders = range_folders(spark, path, LANDED_DATE, start, end)
    if not folders:
        return spark.createDataFrame([], dated)
    return reader.option("basePath", path).json(folders)


def documents_from_text(texts: DataFrame, schema: StructType) -> DataFrame:
    """Same, for documents held in a text column ``document``; others are kept.

    The one-element ``inline`` keeps the parsed document in a step of its own:
    as a plain projection it would be merged into later ones and the text
    parsed again for every field used.
    """
    document = F.from_json("document", schema, STRICT)
    others = [name for name in texts.columns if name != "document"]
    return texts.select(*others, F.inline(F.array(document)))


def landed_between(documents: DataFrame, start: date, end: date) -> DataFrame:
    return documents.where(in_range(F.col(LANDED_DATE), start, end))


def kept_columns(documents: DataFrame) -> list[str]:
    """What is carried along while unpacking and parsing, where it is there."""
    return [name for name in (LANDED_DATE, PAGE, IS_RECORD) if name in documents.columns]


def unpacked(pages: DataFrame, items: Column) -> DataFrame:
    """One row per item of a page; with a page link, one at least."""
    if PAGE not in pages.columns:
        return pages.select(*kept_columns(pages), F.inline(items))
    others = [name for name in kept_columns(pages) if name != PAGE]
    placed = pages.select(*others, PAGE, F.posexplode_outer(items).alias("place", "item"))
    return placed.select(
        *others,
        F.when(F.coalesce("place", F.lit(0)) == 0, F.col(PAGE)).alias(PAGE),
        F.col("item").isNotNull().alias(IS_RECORD),
        "item.*",
    )


def within(rows: DataFrame, in_window: Column) -> DataFrame:
    """Rows of a window; others stay as no records where they carry a page link."""
    if PAGE not in rows.columns:
        return rows.where(in_window)
    return rows.withColumn(IS_RECORD, F.col(IS_RECORD) & in_window).where(
        F.col(IS_RECORD) | F.col(PAGE).isNotNull()
    )


def empty_if_null(items: Column) -> Column:
    return F.coalesce(items, F.array())
