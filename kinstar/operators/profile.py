"""Property profile and label catalogue of a property graph.

Elements are rows ``(label, props map<string,string>, types map<string,string>)``
where ``types`` gives each present property's type name. The profile has one
row per (label, property) with the observed types and whether the property
is present on every element of the label; a label whose elements carry no
property at all keeps one row with a NULL property. Everything is one
explode + partial aggregation + a join with per-label totals; the only
collected sets are of distinct type names (a handful per property).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinstar.sources.graph import bag_column

# Spark type -> graph property type name.
GRAPH_TYPE = {
    T.StringType: "String", T.DateType: "Date", T.LongType: "Long",
    T.IntegerType: "Long", T.BooleanType: "Boolean", T.DoubleType: "Double",
}


def graph_elements(rows: DataFrame, label: str | F.Column, props: dict[str, str]) -> DataFrame:
    """Fold a staging-shaped table into (label, props, types) elements."""
    def type_of(c: str):
        return F.lit(GRAPH_TYPE.get(type(rows.schema[c].dataType), "String"))
    lab = F.lit(label) if isinstance(label, str) else label
    return rows.select(lab.alias("label"), bag_column(props).alias("props"),
                       bag_column(props, type_of).alias("types"))


def property_profile(elements: DataFrame) -> DataFrame:
    """(label, property_name, property_types, mandatory)."""
    totals = elements.groupBy("label").agg(F.count(F.lit(1)).alias("_total"))
    kv = elements.select("label", F.explode("types").alias("property_name", "_type"))
    per = kv.groupBy("label", "property_name").agg(
        F.count(F.lit(1)).alias("_present"),
        F.array_sort(F.collect_set("_type")).alias("property_types"))
    # Labels without any property keep one row with a NULL property.
    out = totals.join(per, "label", "left")
    return out.select(
        "label", "property_name", "property_types",
        F.coalesce(F.col("_present") == F.col("_total"), F.lit(False)).alias("mandatory"))


# Uniqueness constraints of the source graph (label -> property).
UNIQUE_PROPERTIES = {"Person": "id", "Family": "id"}


def label_catalog(nodes: DataFrame, edges: DataFrame, edge_type_col: str = "relationship_type",
                  unique: dict[str, str] | None = None) -> DataFrame:
    """Distinct node labels and edge types, with element counts and the
    configured uniqueness constraint of each label (NULL when none)."""
    unique = UNIQUE_PROPERTIES if unique is None else unique
    constraint = F.lit(None).cast("string")
    for label, prop in unique.items():
        constraint = F.when(F.col("name") == label, F.lit(prop)).otherwise(constraint)
    n = nodes.groupBy("label").agg(F.count(F.lit(1)).alias("n_elements")).select(
        F.lit("node").alias("kind"), F.col("label").alias("name"), "n_elements")
    e = edges.groupBy(edge_type_col).agg(F.count(F.lit(1)).alias("n_elements")).select(
        F.lit("relationship").alias("kind"), F.col(edge_type_col).alias("name"), "n_elements")
    out = n.unionByName(e)
    return out.select("kind", "name", "n_elements",
                      F.when(F.col("kind") == "node", constraint).alias("unique_property"))
