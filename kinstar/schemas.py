"""Fixed schemas of the staging, dimension and fact tables.

The source graph has a fixed schema: a property bag is projected onto these
columns (missing property -> NULL, unknown properties dropped).

Fixed values: all table and column names, types and orders of columns here are
part of the data model.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, B, L, I = T.StringType(), T.DateType(), T.BooleanType(), T.LongType(), T.IntegerType()


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# --- source / staging -------------------------------------------------------

PERSON = _struct(
    ("person_id", S, True), ("first_name", S, True), ("last_name", S, True),
    ("sex", S, True), ("birth_date", D, True), ("death_date", D, True),
    ("education", S, True), ("works", S, True),
)
FAMILY = _struct(
    ("family_id", S, True), ("marriage_date", D, True),
    ("divorce_date", D, True), ("status", S, True),
)
RELATION = _struct(
    ("person_id", S, True), ("family_id", S, True),
    ("relationship_type", S, True), ("role", S, True),
)
# Timestamps are UTC wall-clock values without a zone (TIMESTAMP_NTZ), so they
# read the same in every session time zone.
RUN_LOG = _struct(("run_id", S, False), ("started_at", T.TimestampNTZType(), True))

RAW = {
    "raw_person_snapshot": PERSON,
    "raw_family_snapshot": FAMILY,
    "raw_relation_snapshot": RELATION,
}

# Tracked attributes of a person, in hash order.
PERSON_TRACKED = ["first_name", "last_name", "sex", "birth_date", "death_date",
                  "education", "works"]

# --- warehouse ----------------------------------------------------------------

DIM_PERSON = _struct(
    ("person_sk", L, False), ("person_id", S, False),
    *[(c, PERSON[c].dataType, True) for c in PERSON_TRACKED],
    ("attr_hash", S, True), ("valid_from_run_id", S, False),
    ("valid_to_run_id", S, True), ("is_current", B, False),
    ("is_deleted", B, False), ("created_at", T.TimestampNTZType(), False),
)

DIM_ROLE = _struct(
    ("relationship_role_sk", L, False), ("relationship_role_code", S, False),
    ("relationship_type", S, False), ("person_role", S, False),
    ("is_symmetric", B, False), ("inverse_role_code", S, True),
)

DIM_DATE = _struct(
    ("date_sk", I, False), ("full_date", D, False), ("day_of_month", T.ByteType(), False),
    ("month_of_year", T.ByteType(), False), ("month_name", S, False),
    ("quarter_of_year", T.ByteType(), False), ("year_num", T.ShortType(), False),
    ("day_of_week", T.ByteType(), False), ("day_name", S, False),
    ("is_weekend", B, False),
)

FACT = _struct(
    ("relationship_sk", L, False), ("source_person_sk", L, False),
    ("target_person_sk", L, False), ("relationship_role_sk", L, False),
    ("start_date_sk", I, True), ("end_date_sk", I, True),
    ("source_person_id", S, False), ("target_person_id", S, False),
    ("source_relationship_role_code", S, False), ("start_date", D, True),
    ("end_date", D, True), ("end_reason", S, True),
    ("first_seen_run_id", S, False), ("last_seen_run_id", S, False),
    ("is_deleted", B, False), ("deleted_at_run_id", S, True),
    ("relation_count", I, False), ("created_at", T.TimestampNTZType(), False),
    ("updated_at", T.TimestampNTZType(), False),
)

# Edge (derived relationship) before enrichment; the fact's natural key.
EDGE = _struct(
    ("source_person_id", S, True), ("target_person_id", S, True),
    ("relationship_role_code", S, True), ("start_date", D, True),
    ("end_date", D, True), ("end_reason", S, True),
)
EDGE_KEY = [f.name for f in EDGE.fields]
# The last three parts of the key may be NULL and compare null-safely.
EDGE_NULLABLE_KEY = ["start_date", "end_date", "end_reason"]

TABLES = {
    "dim_person": DIM_PERSON,
    "dim_relationship_role": DIM_ROLE,
    "dim_date": DIM_DATE,
    "fact_person_relationship": FACT,
}
