"""Customer-lifetime input summary (K1-K5): per-customer repeat-purchase
statistics on DAILY periods, computed with algebraic aggregates only
(no per-customer window)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import COL_CUSTOMER_ID, COL_INVOICE_DATE, COL_REVENUE
from ..functions.numeric import rnd

CUST = COL_CUSTOMER_ID


# K1 -------------------------------------------------------------------------
def positive_revenue(df: DataFrame) -> DataFrame:
    return df.filter(F.col(COL_REVENUE) > 0)


def positive_revenue_report(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("rows_before"), F.count_if(F.col(COL_REVENUE) > 0).alias("rows_after")
    ).select(
        "rows_before",
        "rows_after",
        (F.col("rows_before") - F.col("rows_after")).alias("removed"),
        rnd((F.col("rows_before") - F.col("rows_after")) * 100.0 / F.col("rows_before"), 1).alias("removed_pct"),
    )


# K2 -------------------------------------------------------------------------
def observation_end(df: DataFrame) -> DataFrame:
    return df.agg(F.max(COL_INVOICE_DATE).alias("observation_end"))


# K3 -------------------------------------------------------------------------
def rfm_t_summary(df: DataFrame, end: DataFrame | None = None, digits: int = 6) -> DataFrame:
    """Per customer on daily periods: frequency = purchase days - 1,
    recency = last day - first day, T = end day - first day (days),
    monetary_value = mean daily total over the days after the first (0 when
    there is none).  Daily totals come from one (customer, day) aggregate;
    the first day's total is ``min_by(total, day)``."""
    end = end if end is not None else observation_end(df)
    daily = df.groupBy(CUST, F.to_date(COL_INVOICE_DATE).alias("day")).agg(F.sum(COL_REVENUE).alias("total"))
    per = daily.groupBy(CUST).agg(
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
        F.count(F.lit(1)).alias("days"),
        F.sum("total").alias("sum_total"),
        F.min_by("total", "day").alias("first_total"),
    )
    e = end.select(F.to_date(F.col(end.columns[0])).alias("end_day"))
    return per.crossJoin(F.broadcast(e)).select(
        CUST,
        (F.col("days") - 1).cast("double").alias("frequency"),
        F.datediff("last_day", "first_day").cast("double").alias("recency"),
        F.datediff("end_day", "first_day").cast("double").alias("T"),
        F.when(
            F.col("days") > 1,
            rnd((F.col("sum_total") - F.col("first_total")).cast("double") / (F.col("days") - 1).cast("double"), digits),
        )
        .otherwise(F.lit(0.0))
        .alias("monetary_value"),
    )


# K4 -------------------------------------------------------------------------
def repeat_customers(summary: DataFrame) -> DataFrame:
    return summary.filter(F.col("frequency") > 0)


def repeat_share(summary: DataFrame) -> DataFrame:
    return summary.agg(
        F.count_if(F.col("frequency") > 0).alias("repeat_customers"), F.count(F.lit(1)).alias("customers")
    ).withColumn("repeat_pct", rnd(F.col("repeat_customers") * 100.0 / F.col("customers"), 1))


# K5 -------------------------------------------------------------------------
def frequency_monetary_corr(summary: DataFrame, digits: int = 6) -> DataFrame:
    rep = repeat_customers(summary)
    return rep.agg(rnd(F.corr("frequency", "monetary_value"), digits).alias("corr_frequency_monetary"))
