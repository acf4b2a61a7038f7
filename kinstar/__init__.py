"""kinstar: snapshot-to-star-schema kinship analytics on Spark.

Turns periodic full snapshots of a person/family graph into a versioned star
schema (SCD-2 person dimension, role and calendar dimensions, a factless
relationship fact with soft deletes) and answers relationship reports over
it. Every operator is a DataFrame -> DataFrame function built from Spark
SQL primitives.
"""

__version__ = "0.1.0"
