"""Sources and sinks.

Tables are written with the DataFrame writer (parallel file writers, one
file set per task) either as catalog tables or as plain parquet paths.
Order lines are partitioned on disk by invoice month so date-bounded reads
prune files.  Row-count verification uses an ``Observation`` attached to the
write itself — the count is collected by the write job, not a second scan.
"""

from __future__ import annotations

import logging
import os
import re
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import COL_INVOICE_DATE, COL_REVENUE, COL_SOURCE_TAG, ETLConfig, RAW_COLUMNS

log = logging.getLogger(__name__)

# Raw schema: id/text columns are strings, quantity integer, money exact.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("InvoiceNo", T.StringType()),
        T.StructField("StockCode", T.StringType()),
        T.StructField("Description", T.StringType()),
        T.StructField("Quantity", T.IntegerType()),
        T.StructField("InvoiceDate", T.StringType()),
        T.StructField("UnitPrice", T.DecimalType(18, 2)),
        T.StructField("CustomerID", T.StringType()),
        T.StructField("Country", T.StringType()),
    ]
)


# A1 / A2 ----------------------------------------------------------------------
def union_parts(parts: dict[str, DataFrame]) -> DataFrame:
    """Union named parts by column name (missing columns become NULL) and
    tag every row with its part name in ``_source_sheet``."""
    if not parts:
        raise ValueError("no parts to read")
    out = None
    for name, df in parts.items():
        tagged = df.withColumn(COL_SOURCE_TAG, F.lit(name))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out


def read_transactions(spark: SparkSession, parts: dict[str, str], fmt: str = "parquet",
                      options: dict | None = None) -> DataFrame:
    """Read raw order lines from several parts (``name -> path``).

    Id/text columns are read as strings; for text formats the explicit
    ``RAW_SCHEMA`` is applied.  A part that cannot be resolved is skipped
    with a warning; if every part fails the error is raised.  Resolution
    (schema/listing) is the only driver-side work — rows are never
    collected."""
    frames: dict[str, DataFrame] = {}
    errors = []
    for name, path in parts.items():
        try:
            reader = spark.read.options(**(options or {}))
            if fmt in ("csv", "json"):
                reader = reader.schema(RAW_SCHEMA)
                if fmt == "csv":
                    reader = reader.option("header", "true")
            df = reader.format(fmt).load(path)
            for c in ("InvoiceNo", "StockCode", "Description", "CustomerID", "Country"):
                if c in df.columns:
                    df = df.withColumn(c, F.col(c).cast("string"))
            frames[name] = df
        except Exception as exc:  # noqa: BLE001 - a failing part is skipped
            log.warning("skipping part %s (%s): %s", name, path, exc)
            errors.append((name, exc))
    if not frames:
        raise RuntimeError(f"no part could be read: {errors}")
    return union_parts(frames)


# A4 / A9 / A10 / A11 --------------------------------------------------------------
def save_table(df: DataFrame, name: str, mode: str = "overwrite", path: str | None = None,
               partition_by: list[str] | None = None, fmt: str = "parquet") -> int:
    """Write ``df`` as catalog table ``name`` (or to ``path``) and return the
    number of rows written (observed during the write)."""
    if mode not in ("overwrite", "append"):
        raise ValueError("mode must be 'overwrite' or 'append'")
    obs = Observation(f"rows_{uuid.uuid4().hex[:8]}")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    writer = observed.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path is not None:
        writer.save(path)
    else:
        writer.saveAsTable(name)
    return int(obs.get["rows"])


def save_named(df: DataFrame, name: str, location: str | None = None, statistics: bool = True) -> int:
    """Write ``df`` as catalog table ``name``, at ``location`` instead of the
    session's warehouse if given, and record its size and column statistics,
    which the optimiser plans joins by.  Returns the rows written."""
    spark = df.sparkSession
    obs = Observation(f"rows_{uuid.uuid4().hex[:8]}")
    writer = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").format("parquet")
    (writer.option("path", location) if location else writer).saveAsTable(name)
    if statistics:
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")
    return int(obs.get["rows"])


def recorded_rows(spark: SparkSession, name: str) -> int | None:
    """The row count in the catalog's statistics of a table, if any."""
    found = spark.sql(f"DESCRIBE EXTENDED {name}").filter("col_name = 'Statistics'").select("data_type").collect()
    rows = re.search(r"(\d+) rows", found[0][0]) if found else None
    return int(rows[1]) if rows else None


def with_month_partition(df: DataFrame, date_col: str = COL_INVOICE_DATE) -> DataFrame:
    """Add ``invoice_month`` (yyyy-MM) as the on-disk partition column."""
    return df.withColumn("invoice_month", F.date_format(date_col, "yyyy-MM"))


# A5 -------------------------------------------------------------------------
def verify_count(spark: SparkSession, name: str | None, expected: int, path: str | None = None,
                 before: int = 0) -> int:
    """Count the stored table (a metadata-light parquet count) and raise if
    it differs from the number of rows written, plus the ``before`` rows that
    an append found there."""
    stored = read_table(spark, name, path).count()
    if stored != before + expected:
        raise RuntimeError(
            f"row count mismatch for {name or path}: wrote {expected} to {before} rows, stored {stored}")
    return stored


# A6 -------------------------------------------------------------------------
def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the namespace if missing (optionally at an explicit shared
    location instead of the session's default warehouse)."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{loc}")


# A7 -------------------------------------------------------------------------
def prepare_clean(df: DataFrame, cfg: ETLConfig = ETLConfig()) -> DataFrame:
    """Re-assert the date type and recompute Revenue when it is missing."""
    from ..operators.clean import add_revenue

    dtype = df.schema[cfg.date_column].dataType
    if not isinstance(dtype, T.TimestampNTZType):
        df = df.withColumn(cfg.date_column, F.col(cfg.date_column).try_cast("timestamp_ntz"))
    if COL_REVENUE not in df.columns:
        df = add_revenue(df, cfg.quantity_column, cfg.price_column)
    return df


def load_clean(spark: SparkSession, name: str | None = None, path: str | None = None,
               cfg: ETLConfig = ETLConfig()) -> DataFrame:
    df = spark.read.parquet(path) if path else spark.table(name or cfg.clean_table)
    return prepare_clean(df, cfg)


# A8 -------------------------------------------------------------------------
def read_table(spark: SparkSession, name: str | None = None, path: str | None = None) -> DataFrame:
    return spark.read.parquet(path) if path else spark.table(name)


# lineage cut ------------------------------------------------------------------
def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir``; a scratch folder is set only when the session
    has none (local tests)."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: configuration only
        sc = None
    if not d and sc is not None:
        d = sc.getCheckpointDir()
    if not d:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (no machine-local fallback on a cluster)")
        import tempfile

        d = tempfile.mkdtemp(prefix="basketry-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc is not None:
        sc.setCheckpointDir(d)
    return d


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage by writing ``df`` as parquet under the checkpoint folder
    and reading it back (survives executor loss, unlike local checkpoints)."""
    spark = df.sparkSession
    base = checkpoint_dir(spark)
    path = os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


__all__ = [
    "RAW_COLUMNS",
    "RAW_SCHEMA",
    "union_parts",
    "read_transactions",
    "save_table",
    "with_month_partition",
    "verify_count",
    "ensure_database",
    "prepare_clean",
    "load_clean",
    "read_table",
    "checkpoint_dir",
    "materialise",
]
