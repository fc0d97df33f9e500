"""Reject channel (A1, B2): nothing that was read is lost without a reason.

``vote_formats`` counts in one pass which date format fits each part, so a
part written day-first is not read month-first because some of its dates fit
both ways.  ``split_dates`` then parses each part by its own format and returns
the readable rows and the others, unchanged and with a reason; every row is in
exactly one of the two.  ``read_parts`` does the same for files.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import COL_INVOICE_DATE, COL_SOURCE_TAG, DATE_FORMATS
from ..sources.io import materialise, read_transactions

log = logging.getLogger(__name__)

ISO = "iso"
MISSING, UNREADABLE = "missing date", "unreadable date"
#: day-first forms beside the month-first ones
FORMATS = (ISO, *DATE_FORMATS, "d/M/yyyy H:mm", "d/M/yyyy H:mm:ss", "d/M/yyyy", "d.M.yyyy H:mm", "d.M.yyyy")


def read_as(text: Column, how: str) -> Column:
    """Text as a zone-less timestamp by one format, NULL where it does not fit."""
    if how == ISO:
        return text.try_cast("timestamp_ntz")
    return F.try_to_timestamp(text, F.lit(how)).cast("timestamp_ntz")


def vote_formats(df: DataFrame, col: str = COL_INVOICE_DATE, part: str = COL_SOURCE_TAG,
                 formats: tuple[str, ...] = FORMATS) -> DataFrame:
    """(part, format, fits, texts): of every part the format that reads most
    of its texts, the earlier of equal ones; NULL where none reads any.  Each
    different text of a part is read once, with its count: a date that does not
    fit costs an exception, and lines share their invoices' dates."""
    text = F.trim(F.col(col).cast("string"))
    each_text = df.groupBy(part, text.alias("__text")).agg(F.count(F.lit(1)).alias("__n"))
    text, n = F.col("__text"), F.col("__n")
    each = each_text.groupBy(part).agg(
        F.coalesce(F.sum(F.when(text.isNotNull(), n)), F.lit(0)).alias("texts"),
        *[F.coalesce(F.sum(F.when(read_as(text, f).isNotNull(), n)), F.lit(0)).alias(f"f{i}") for i, f in enumerate(formats)])
    best = F.array_max(F.array(*[F.struct(F.col(f"f{i}").alias("fits"), F.lit(-i).alias("i"), F.lit(f).alias("format"))
                                 for i, f in enumerate(formats)]))
    return each.withColumn("__b", best).select(
        part, F.when(F.col("__b.fits") > 0, F.col("__b.format")).alias("format"), F.col("__b.fits").alias("fits"), "texts")


def split_dates(df: DataFrame, col: str = COL_INVOICE_DATE, part: str = COL_SOURCE_TAG, formats: tuple[str, ...] = FORMATS,
                votes: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected): rows whose date the part's format reads, with the
    date as timestamp, and all other rows as they came, with ``reason``.  The
    rows are staged with their date, so each is read once for both."""
    votes = votes if votes is not None else vote_formats(df, col, part, formats)
    chosen = {r[part]: r["format"] for r in votes.collect()}  # a row a part
    text = F.trim(F.col(f"`{col}`").cast("string"))
    date = F.lit(None).cast("timestamp_ntz")
    for name, how in chosen.items():
        if how is not None:
            date = F.when(F.col(f"`{part}`").eqNullSafe(F.lit(name)), read_as(text, how)).otherwise(date)
    read = materialise(df.select(*[F.col(f"`{c}`") for c in df.columns], date.alias("__date")), "dated")
    columns = [F.col(f"`{c}`") for c in df.columns]
    kept = read.filter(F.col("__date").isNotNull()).select(
        *[F.col("__date").alias(c) if c == col else F.col(f"`{c}`") for c in df.columns])
    reason = F.when(F.col(f"`{col}`").isNull(), F.lit(MISSING)).otherwise(F.lit(UNREADABLE))
    return kept, read.filter(F.col("__date").isNull()).select(*columns, reason.alias("reason"))


def read_parts(spark: SparkSession, parts: dict[str, str], fmt: str = "parquet",
               options: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """(lines, rejected parts): every readable part unioned and tagged, and
    (part, path, reason) of the others.  Raises where no part can be read."""
    good, bad = {}, []
    for name, path in parts.items():
        try:
            read_transactions(spark, {name: path}, fmt, options)
            good[name] = path
        except Exception as exc:  # noqa: BLE001 - the reason is kept
            bad.append((name, path, str(exc).splitlines()[0][:500]))
    if not good:
        raise RuntimeError(f"no part could be read: {bad}")
    if bad:
        log.warning("%d of %d parts were not read: %s", len(bad), len(parts), [b[0] for b in bad])
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("part", "path", "reason")])
    return read_transactions(spark, good, fmt, options), spark.createDataFrame(bad, schema)
