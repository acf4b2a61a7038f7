"""Reference dimensions and seed-if-absent."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinstar.functions.columns import date_key, day_of_week_sunday0
from kinstar.operators.keys import next_key_base, with_surrogate_key
from kinstar.schemas import DIM_DATE, DIM_ROLE

CALENDAR_START = dt.date(1900, 1, 1)
CALENDAR_END = dt.date(2100, 12, 31)

# The seven relationship roles, in seeding order:
# (code, relationship type, person role, symmetric, inverse code).
ROLES = [
    ("SPOUSE_HUSBAND", "SPOUSE", "HUSBAND", False, "SPOUSE_WIFE"),
    ("SPOUSE_WIFE", "SPOUSE", "WIFE", False, "SPOUSE_HUSBAND"),
    ("SPOUSE_PARTNER", "SPOUSE", "PARTNER", True, "SPOUSE_PARTNER"),
    ("PARENT", "PARENT_CHILD", "PARENT", False, "CHILD"),
    ("CHILD", "PARENT_CHILD", "CHILD", False, "PARENT"),
    ("SIBLING", "SIBLING", "SIBLING", True, "SIBLING"),
    ("HALF_SIBLING", "SIBLING", "HALF_SIBLING", True, "HALF_SIBLING"),
]


def calendar_days(start: dt.date = CALENDAR_START, end: dt.date = CALENDAR_END) -> int:
    return (end - start).days + 1


def calendar_rows(dates: Column) -> list[Column]:
    """Calendar attributes of a date column, in DIM_DATE order.

    Weekend = Friday and Saturday (day_of_week 5 and 6, Sunday = 0).
    """
    dow = day_of_week_sunday0(dates)
    return [
        date_key(dates).alias("date_sk"),
        dates.alias("full_date"),
        F.dayofmonth(dates).cast("tinyint").alias("day_of_month"),
        F.month(dates).cast("tinyint").alias("month_of_year"),
        F.date_format(dates, "MMMM").alias("month_name"),
        F.quarter(dates).cast("tinyint").alias("quarter_of_year"),
        F.year(dates).cast("smallint").alias("year_num"),
        dow.cast("tinyint").alias("day_of_week"),
        F.date_format(dates, "EEEE").alias("day_name"),
        dow.isin(5, 6).alias("is_weekend"),
    ]


def date_dimension(spark: SparkSession, start: dt.date = CALENDAR_START,
                   end: dt.date = CALENDAR_END, num_partitions: int | None = None) -> DataFrame:
    """Every day of [start, end] inclusive (IO12 + D1), generated in parallel."""
    n = calendar_days(start, end)
    days = spark.range(0, n, numPartitions=num_partitions or spark.sparkContext.defaultParallelism)
    d = F.date_add(F.lit(start), F.col("id").cast("int"))
    return days.select(*calendar_rows(d))


def dates_dimension_of(dates: DataFrame, column: str) -> DataFrame:
    """Calendar rows for the distinct dates found in a column of a table."""
    d = dates.select(F.col(column).cast("date").alias("_d")).where(F.col("_d").isNotNull()).distinct()
    return d.select(*calendar_rows(F.col("_d")))


def role_rows(spark: SparkSession) -> DataFrame:
    """The seven roles with their seeding ordinal (IO11)."""
    rows = [(i + 1, *r) for i, r in enumerate(ROLES)]
    schema = ("_ord int, relationship_role_code string, relationship_type string, "
              "person_role string, is_symmetric boolean, inverse_role_code string")
    return spark.createDataFrame(rows, schema)


def seed_if_absent(existing: DataFrame | None, rows: DataFrame, key: Sequence[str],
                   sk_col: str | None = None, order_by: Sequence[str] | None = None,
                   bounded: bool = False) -> DataFrame:
    """Insert rows whose unique ``key`` is not present yet; never update (M6).

    With ``sk_col`` the inserted rows get surrogate keys after the current
    maximum, in ``order_by`` order (default: the key). ``bounded`` declares
    ``rows`` a small literal of known size (the seven roles): keys then come
    from one ``row_number`` window instead of the distributed K1 plan.
    """
    key = list(key)
    if existing is None:
        new = rows
    else:
        new = rows.join(existing.select(*key), key, "left_anti")
    if sk_col is not None:
        base = next_key_base(existing, sk_col) if existing is not None else 0
        order = list(order_by or key)
        if bounded:
            rank = F.row_number().over(Window.orderBy(*order))
            new = new.withColumn(sk_col, (F.lit(base) + rank).cast("long"))
        else:
            new = with_surrogate_key(new, order, sk_col, start=base)
    if existing is None:
        return new
    return existing.unionByName(new.select(*existing.columns))


def role_dimension(spark: SparkSession, existing: DataFrame | None = None) -> DataFrame:
    """Seed the seven roles (keys 1..7 on an empty table)."""
    cols = [f.name for f in DIM_ROLE.fields]
    seeded = seed_if_absent(existing, role_rows(spark), ["relationship_role_code"],
                            sk_col="relationship_role_sk", order_by=["_ord"], bounded=True)
    return seeded.select(*cols)


def seed_calendar(spark: SparkSession, existing: DataFrame | None = None,
                  start: dt.date = CALENDAR_START, end: dt.date = CALENDAR_END) -> DataFrame:
    """Seed every day of the calendar not present yet (by full_date)."""
    cols = [f.name for f in DIM_DATE.fields]
    return seed_if_absent(existing, date_dimension(spark, start, end), ["full_date"]).select(*cols)
