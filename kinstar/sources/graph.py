"""Property-graph boundary: node and edge tables with property bags.

A source graph arrives as node tables ``(id, props map<string,string>)`` and
an edge table ``(person_id, family_id, relationship_type, props)``. The
extraction projects bags onto the fixed staging schema (IO4): a missing
property becomes NULL, unknown properties are dropped, dates are parsed
strictly (IO5: a malformed date fails the run, it is never silently NULL).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinstar.schemas import FAMILY, PERSON, RELATION

# Staging column <- source property name.
PERSON_PROPS = {
    "person_id": "id", "first_name": "first_name", "last_name": "last_name",
    "sex": "sex", "birth_date": "birth_date", "death_date": "death_date",
    "education": "education", "works": "works",
}
FAMILY_PROPS = {
    "family_id": "id", "marriage_date": "marriage_date",
    "divorce_date": "divorce_date", "status": "status",
}


class ShapeError(ValueError):
    """A source record lacks a required field or has the wrong type (IO6)."""


def check_shape(df: DataFrame, required: dict[str, type[T.DataType]]) -> None:
    """Fail before any job runs when a required column is missing or mistyped."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    for name, typ in required.items():
        if name not in fields:
            raise ShapeError(f"missing column {name!r}; have {sorted(fields)}")
        if not isinstance(fields[name], typ):
            raise ShapeError(f"column {name!r} is {fields[name].simpleString()}, "
                             f"expected {typ.__name__}")


def bag_column(props: dict[str, str], value=None):
    """map<property, value> of the non-NULL columns named in ``props``;
    ``value(column_name)`` gives the stored value (default: the text)."""
    value = value or (lambda c: F.col(c).cast("string"))
    entries = [F.when(F.col(c).isNotNull(), F.struct(F.lit(p).alias("k"), value(c).alias("v")))
               for c, p in props.items()]
    return F.map_from_entries(F.filter(F.array(*entries), lambda e: e.isNotNull()))


def to_property_bag(rows: DataFrame, props: dict[str, str], bag: str = "props") -> DataFrame:
    """Fold fixed columns into a property bag; NULL properties are absent,
    as in a property graph, and values are rendered as text."""
    return rows.select(bag_column(props).alias(bag))


def strict_date(value: Column, name: str) -> Column:
    """The text as a date; anything else but NULL fails the query, whatever the
    session's ANSI setting."""
    date = value.try_cast("date")
    message = F.concat(F.lit(f"{name} is not a date: "), value)
    return F.when(value.isNull() | date.isNotNull(), date).otherwise(F.raise_error(message).cast("date"))


def project_properties(nodes: DataFrame, schema: T.StructType, props: dict[str, str],
                       bag: str = "props", keep: tuple[str, ...] = ()) -> DataFrame:
    """Project a bag onto ``schema`` (IO4/IO5)."""
    check_shape(nodes, {bag: T.MapType})
    cols = []
    for field in schema.fields:
        v = F.col(bag).getItem(props[field.name])
        if isinstance(field.dataType, T.DateType):
            v = strict_date(v, field.name)
        cols.append(v.alias(field.name))
    return nodes.select(*keep, *cols)


def person_nodes(nodes: DataFrame, bag: str = "props", keep: tuple[str, ...] = ()) -> DataFrame:
    """IO1: every Person node projected onto the staging schema."""
    return project_properties(nodes, PERSON, PERSON_PROPS, bag, keep)


def family_nodes(nodes: DataFrame, bag: str = "props", keep: tuple[str, ...] = ()) -> DataFrame:
    """IO2: every Family node projected onto the staging schema."""
    return project_properties(nodes, FAMILY, FAMILY_PROPS, bag, keep)


def relations(edges: DataFrame, persons: DataFrame, families: DataFrame,
              bag: str = "props", keep: tuple[str, ...] = ()) -> DataFrame:
    """IO3: every Person->Family edge of any type whose two ends exist.

    Only the ``role`` property is read; dangling edges are dropped by
    semi-joins on both ends (the graph match requires both nodes).
    """
    check_shape(edges, {"person_id": T.StringType, "family_id": T.StringType,
                        "relationship_type": T.StringType, bag: T.MapType})
    out = edges.select(*keep, "person_id", "family_id", "relationship_type",
                       F.col(bag).getItem("role").alias("role"))
    out = out.join(persons.select("person_id"), "person_id", "left_semi")
    out = out.join(families.select("family_id"), "family_id", "left_semi")
    return out.select(*keep, *[f.name for f in RELATION.fields])


NODE_FILE = T.StructType([T.StructField("props", T.MapType(T.StringType(), T.StringType()))])
EDGE_FILE = T.StructType([T.StructField(c, T.StringType()) for c in ("person_id", "family_id", "relationship_type")]
                         + NODE_FILE.fields)


def read_graph(spark: SparkSession, path: str, fmt: str = "parquet") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(person, family, relation) staging frames of a graph kept as files below
    ``path``: node files ``person`` and ``family`` with a property bag each, and
    edge files ``relation``, in Parquet or JSON lines."""
    if fmt not in ("parquet", "json"):
        raise ValueError(f"unsupported graph format {fmt!r}")
    root = path.rstrip("/")

    def read(name: str, schema: T.StructType) -> DataFrame:
        return spark.read.schema(schema).format(fmt).load(f"{root}/{name}")

    persons, families = person_nodes(read("person", NODE_FILE)), family_nodes(read("family", NODE_FILE))
    return persons, families, relations(read("relation", EDGE_FILE), persons, families)
