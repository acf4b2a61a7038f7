"""Kinship snapshots derived from the TPC-H-ish ``customer`` table.

The supplied test data has no person/family graph, so one is derived from
``customer`` by fixed arithmetic rules (documented in FIXTURES.md §3). Every
customer becomes a person; even customers form a 4-ary blood-line tree and
odd customers marry in. Snapshot ``seq`` 1 and 2 differ by deletions,
attribute changes, divorces and moved children, which exercises every branch
of the incremental merge.

Work grows linearly with ``customer``: each output is a narrow projection of
one scan (plus one semi-join for relations), no shuffle except that join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinstar.functions.columns import lit_date


# Blood-line children per hot family times 20: each hot family of r2 gains 32
# children, so the families' number, not their size, grows with the data.
HOT_SPAN = 640


def read_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (spark.read.parquet(f"{sf_dir}/customer.parquet")
            .select("c_custkey", "c_nationkey", "c_mktsegment"))


def _ids(df: DataFrame) -> DataFrame:
    c = F.col("c_custkey")
    i = F.floor(c / 2).cast("long")
    return df.select(
        "*",
        i.alias("_i"),
        (c % 2).alias("_odd"),
        F.floor((i - 1) / 4).cast("long").alias("_pf"),
    )


def _days(base: str, n: Column) -> Column:
    return F.date_add(lit_date(base), n.cast("int"))


def person_snapshot(customer: DataFrame, seq: int) -> DataFrame:
    """One person per customer present in snapshot ``seq``."""
    c = F.col("c_custkey")
    nation = F.col("c_nationkey").cast("string")
    dropped = (c % 50 == 7) if seq == 2 else (c % 40 == 9)
    died = (c % 4 == 1) | ((c % 16 == 6) if seq == 2 else F.lit(False))
    works = F.when(c % 31 == 12, F.lit(None).cast("string"))
    if seq == 2:
        works = works.when(c % 10 == 3, F.lit("W-new"))
    works = works.otherwise(F.concat(F.lit("W"), nation))
    return customer.where(~dropped).select(
        F.concat(F.lit("p"), c.cast("string")).alias("person_id"),
        F.concat(F.lit("F"), (c % 97).cast("string")).alias("first_name"),
        F.concat(F.lit("L"), nation).alias("last_name"),
        F.when(c % 2 == 0, F.lit("Male")).otherwise(F.lit("Female")).alias("sex"),
        F.when(c % 29 == 10, F.lit(None).cast("date"))
         .otherwise(_days("1890-01-01", (c * 37) % 40000)).alias("birth_date"),
        F.when(died, _days("1990-01-01", (c * 11) % 9000))
         .otherwise(F.lit(None).cast("date")).alias("death_date"),
        F.col("c_mktsegment").alias("education"),
        works.alias("works"),
    )


def family_snapshot(customer: DataFrame, seq: int) -> DataFrame:
    """A first family ``f<i>`` per even customer and a second family ``g<i>``
    for ``i % 7 = 3``."""
    base = _ids(customer).where(F.col("_odd") == 0)
    i = F.col("_i")
    divorced = (i % 9 == 2) | ((i % 6 == 1) if seq == 2 else F.lit(False))
    first = base.select(
        F.concat(F.lit("f"), i.cast("string")).alias("family_id"),
        F.when(i % 23 == 8, F.lit(None).cast("date"))
         .otherwise(_days("1910-01-01", (i * 53) % 36000)).alias("marriage_date"),
        F.when(divorced, _days("2015-01-01", (i * 7) % 3000))
         .otherwise(F.lit(None).cast("date")).alias("divorce_date"),
        F.when(i % 9 == 2, F.lit("DIVORCED"))
         .when(i % 9 == 5, F.lit("ended"))
         .when(i % 21 == 4, F.lit(None).cast("string"))
         .otherwise(F.lit("ACTIVE")).alias("status"),
    )
    second = base.where(i % 7 == 3).select(
        F.concat(F.lit("g"), i.cast("string")).alias("family_id"),
        _days("1960-01-01", (i * 53) % 20000).alias("marriage_date"),
        F.lit(None).cast("date").alias("divorce_date"),
        F.lit("ACTIVE").alias("status"),
    )
    return first.unionByName(second)


def relation_snapshot(customer: DataFrame, seq: int,
                      persons: DataFrame | None = None) -> DataFrame:
    """SPOUSE_OF and CHILD_OF edges, kept only for persons of the same run."""
    base = _ids(customer)
    c, i, odd, pf = F.col("c_custkey"), F.col("_i"), F.col("_odd"), F.col("_pf")
    pid = F.concat(F.lit("p"), c.cast("string"))
    spouse_first = base.where(~((odd == 1) & (i % 19 == 6))).select(
        pid.alias("person_id"),
        F.concat(F.lit("f"), i.cast("string")).alias("family_id"),
        F.lit("SPOUSE_OF").alias("relationship_type"),
        F.when(i % 17 == 4, F.lit(None).cast("string"))
         .when(i % 13 == 5, F.lit("PARTNER"))
         .when((odd == 0) & (i % 5 == 1), F.lit("husband"))
         .when(odd == 0, F.lit("HUSBAND"))
         .otherwise(F.lit("WIFE")).alias("role"),
    )
    spouse_second = base.where((i - odd) % 7 == 3).select(
        pid.alias("person_id"),
        F.concat(F.lit("g"), (i - odd).cast("string")).alias("family_id"),
        F.lit("SPOUSE_OF").alias("relationship_type"),
        F.when(odd == 0, F.lit("HUSBAND")).otherwise(F.lit("WIFE")).alias("role"),
    )
    # in r2 every 20th child of a stretch of HOT_SPAN moves into one family
    hot = F.floor(i / HOT_SPAN).cast("long")
    number = pf if seq == 1 else F.when(i % 20 == 7, hot).otherwise(pf)
    prefix = F.when((pf % 7 == 3) & (i % 4 == 2), F.lit("g")).otherwise(F.lit("f"))
    child = base.where((odd == 0) & (i >= 1)).select(
        pid.alias("person_id"),
        F.concat(prefix, number.cast("string")).alias("family_id"),
        F.lit("CHILD_OF").alias("relationship_type"),
        F.lit(None).cast("string").alias("role"),
    )
    rel = spouse_first.unionByName(spouse_second).unionByName(child)
    if persons is None:
        persons = person_snapshot(customer, seq)
    # a merge join whatever the file's size: it tells little of the rows, and the persons grow with it
    return rel.join(persons.select("person_id").hint("merge"), "person_id", "left_semi")


def snapshot(spark: SparkSession, sf_dir: str, seq: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(person, family, relation) of derived snapshot ``seq`` (1 or 2)."""
    cust = read_customer(spark, sf_dir)
    person = person_snapshot(cust, seq)
    return person, family_snapshot(cust, seq), relation_snapshot(cust, seq, person)
