"""Derivation of directed kinship edges from family membership.

Input is one snapshot slice: ``person`` (person_id, birth_date, ...),
``family`` (family_id, marriage_date, divorce_date, status) and ``relation``
(person_id, family_id, relationship_type, role). Output is the set of
directed edges keyed by (source, target, role code, start, end, reason).

Plan shape (per snapshot):

* spouse relation = SPOUSE_OF memberships joined to their family (shuffle
  by family_id); parent x child is computed once per family and projected
  three ways (PARENT edges, CHILD edges, parent-child map). Both are
  checkpointed once, because several branches read them.
* spouse pairs (per family) and sibling pairs (per class) are self-joins
  whose output is quadratic in the group. ``pairs_within_groups`` keeps the
  plain self-join for ordinary groups and cuts a group above
  ``block_size`` rows into blocks, every pair of blocks being its own join
  key: no task produces more than ~block_size^2 pairs, however large one
  family is.
* siblings are paired by classes of children with the same parents, so that no
  aggregate over the (quadratic) pairs is needed to count their shared parents.
* the child's birth date travels with the parent-child map, so sibling start
  dates need no further join against the (large) person table.
* sibling edges are unique by construction, so only spouse and parent/child
  edges go through the final DISTINCT.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinstar.functions.columns import (
    later_of,
    marriage_end_reason,
    sibling_role_code,
    spouse_role_code,
    upper_code,
)
from kinstar.schemas import EDGE_KEY
from kinstar.session import materialize, small


def _null_date():
    return F.lit(None).cast("date")


def _null_text():
    return F.lit(None).cast("string")


# Rows per group (children of a parent, spouses of a family) above which a
# pair self-join is split into blocks.
DEFAULT_BLOCK_SIZE = 2048


def normalize_relations(relation: DataFrame) -> DataFrame:
    """Upper-case the edge type and the role; a missing role becomes NONE."""
    return relation.select(
        "person_id", "family_id",
        F.upper(F.col("relationship_type")).alias("relationship_type"),
        upper_code("role", "NONE").alias("role"),
    )


def spouse_relation(relation: DataFrame, family: DataFrame) -> DataFrame:
    """SPOUSE_OF memberships with the family's dates and status.

    Membership types other than SPOUSE_OF / CHILD_OF are ignored.
    """
    rel = normalize_relations(relation).where(F.col("relationship_type") == "SPOUSE_OF")
    fam = family.select("family_id", "marriage_date", "divorce_date", "status")
    # a merge join whatever the estimate, which may be of small files: families grow with the snapshot
    return rel.join(fam.hint("merge"), "family_id").select(
        "person_id", "family_id", "role", "marriage_date", "divorce_date", "status")


def spouse_edges(spouse_rel: DataFrame, distinct: bool = True,
                 block_size: int = DEFAULT_BLOCK_SIZE) -> DataFrame:
    """Ordered pairs of different spouses of one family.

    The role code follows the *source*'s role; start = marriage date,
    end = divorce date, reason per ``marriage_end_reason`` (the family's
    dates and status are the same on every membership row). Pairs come from
    ``pairs_within_groups`` on family_id, so a family with very many
    memberships is spread over many tasks; both directions are emitted from
    each unordered pair.
    """
    pairs = pairs_within_groups(spouse_rel, "family_id", "person_id",
                                ["role", "marriage_date", "divorce_date", "status"], block_size)
    both = F.explode(F.array(
        F.struct(F.col("member_a").alias("s"), F.col("member_b").alias("t"),
                 F.col("role_a").alias("role"), F.col("marriage_date_a").alias("m"),
                 F.col("divorce_date_a").alias("d"), F.col("status_a").alias("st")),
        F.struct(F.col("member_b").alias("s"), F.col("member_a").alias("t"),
                 F.col("role_b").alias("role"), F.col("marriage_date_b").alias("m"),
                 F.col("divorce_date_b").alias("d"), F.col("status_b").alias("st"))))
    edges = pairs.select(both.alias("_e")).select(
        F.col("_e.s").alias("source_person_id"),
        F.col("_e.t").alias("target_person_id"),
        spouse_role_code(F.col("_e.role")).alias("relationship_role_code"),
        F.col("_e.m").alias("start_date"),
        F.col("_e.d").alias("end_date"),
        marriage_end_reason(F.col("_e.d"), F.col("_e.st")).alias("end_reason"),
    )
    return edges.distinct() if distinct else edges


def child_relation(relation: DataFrame, person: DataFrame) -> DataFrame:
    """CHILD_OF memberships with the child's birth date (J3, left join)."""
    rel = normalize_relations(relation).where(F.col("relationship_type") == "CHILD_OF")
    births = person.select("person_id", "birth_date")
    return rel.join(births.hint("merge"), "person_id", "left").select(
        F.col("person_id").alias("child_id"), "family_id",
        F.col("birth_date").alias("child_birth_date"))


def parent_child(spouse_rel: DataFrame, child_rel: DataFrame) -> DataFrame:
    """Every spouse of a family x every child of that family (J4), once."""
    parents = spouse_rel.select(F.col("person_id").alias("parent_id"), "family_id",
                                "marriage_date")
    return parents.join(child_rel.hint("merge"), "family_id").select(
        "parent_id", "child_id", "family_id", "marriage_date", "child_birth_date")


def parent_edges(pc: DataFrame, distinct: bool = True) -> DataFrame:
    """Parent -> child; start = marriage date, else the child's birth."""
    e = pc.select(
        F.col("parent_id").alias("source_person_id"),
        F.col("child_id").alias("target_person_id"),
        F.lit("PARENT").alias("relationship_role_code"),
        F.coalesce("marriage_date", "child_birth_date").alias("start_date"),
        _null_date().alias("end_date"), _null_text().alias("end_reason"))
    return e.distinct() if distinct else e


def child_edges(pc: DataFrame, distinct: bool = True) -> DataFrame:
    """Child -> parent; start = the child's birth date."""
    e = pc.select(
        F.col("child_id").alias("source_person_id"),
        F.col("parent_id").alias("target_person_id"),
        F.lit("CHILD").alias("relationship_role_code"),
        F.col("child_birth_date").alias("start_date"),
        _null_date().alias("end_date"), _null_text().alias("end_reason"))
    return e.distinct() if distinct else e


def parent_child_map(pc: DataFrame) -> DataFrame:
    """Distinct (parent, child) over all families.

    The child's birth date is functionally dependent on the child (one row
    per person in a snapshot), so carrying it does not change the set.
    """
    return pc.select("parent_id", "child_id", "child_birth_date").distinct()


def pairs_within_groups(df: DataFrame, group_col: str, member_col: str,
                        payload: list[str], block_size: int = DEFAULT_BLOCK_SIZE) -> DataFrame:
    """Every unordered pair of rows of one group with different members,
    oriented so that ``member_a < member_b``.

    Output: ``group_col, member_a, member_b`` and ``<p>_a`` / ``<p>_b`` for
    each payload column. The result is quadratic in the size of a group, so
    groups are split by size, measured with a partial (map-side combined)
    count per group:

    * ordinary groups (at most ``block_size`` rows) use the plain self-join
      on the group key, which reuses the input's partitioning;
    * a hot group is cut into blocks (hash of the member, so one member's
      rows share a block) and every pair of blocks (x <= y) is its own join
      key: no task produces more than about block_size^2 pairs, however
      large one group is. Only hot groups' rows take this path.
    """
    hot = (df.groupBy(group_col).agg(F.count(F.lit(1)).alias("_n"))
           .where(F.col("_n") > block_size)
           .select(group_col, F.ceil(F.col("_n") / F.lit(block_size)).cast("int").alias("_nb")))
    m = df.join(hot, group_col, "left")
    cols = [member_col, *payload]

    def side(first: str, second: str, name: str, a_first):
        return F.when(a_first, F.col(first)).otherwise(F.col(second)).alias(name)

    def oriented(pairs: DataFrame) -> DataFrame:
        a_first = F.col("_a") < F.col("_b")
        return pairs.select(
            group_col, side("_a", "_b", "member_a", a_first), side("_b", "_a", "member_b", a_first),
            *[side(f"_la_{p}", f"_rb_{p}", f"{p}_a", a_first) for p in payload],
            *[side(f"_rb_{p}", f"_la_{p}", f"{p}_b", a_first) for p in payload])

    def left_side(d: DataFrame, *extra) -> DataFrame:
        return d.select(group_col, F.col(member_col).alias("_a"),
                        *[F.col(p).alias(f"_la_{p}") for p in payload], *extra)

    def right_side(d: DataFrame, *extra) -> DataFrame:
        return d.select(group_col, F.col(member_col).alias("_b"),
                        *[F.col(p).alias(f"_rb_{p}") for p in payload], *extra)

    normal = m.where(F.col("_nb").isNull()).select(group_col, *cols)
    plain = left_side(normal).join(right_side(normal), group_col).where(F.col("_a") < F.col("_b"))

    hot_rows = m.where(F.col("_nb").isNotNull()).withColumn(
        "_blk", F.pmod(F.xxhash64(member_col), F.col("_nb")).cast("int"))
    # A row of block b is the left member of block pairs (b, y >= b) and the
    # right member of block pairs (x <= b, b).
    hl = left_side(hot_rows, F.col("_blk").alias("_x"),
                   F.explode(F.sequence(F.col("_blk"), F.col("_nb") - 1)).alias("_y"))
    hr = right_side(hot_rows, F.explode(F.sequence(F.lit(0), F.col("_blk"))).alias("_x"),
                    F.col("_blk").alias("_y"))
    blocked = hl.join(hr, [group_col, "_x", "_y"]).where(
        ((F.col("_x") < F.col("_y")) & (F.col("_a") != F.col("_b"))) | (F.col("_a") < F.col("_b")))
    return oriented(plain).unionByName(oriented(blocked.drop("_x", "_y")))


def sibling_classes(pcm: DataFrame) -> DataFrame:
    """(child_id, parents, child_birth_date): each child with the sorted set of its parents.
    Children with one set of parents are a class."""
    return pcm.groupBy("child_id").agg(F.array_sort(F.collect_set("parent_id")).alias("parents"),
                                       F.max("child_birth_date").alias("child_birth_date"))


def sibling_pairs(pcm: DataFrame, block_size: int = DEFAULT_BLOCK_SIZE) -> DataFrame:
    """Unordered child pairs (person_a < person_b) sharing at least one
    parent, with the number of shared parents (E5) and both birth dates.

    Children are taken by classes (see ``sibling_classes``), and nothing is grouped per pair:

    * two children of one class share all its parents;
    * classes that share a parent meet through it, and a pair of classes counts where it
      meets through the least of the shared parents, so once; its children are paired last.
    """
    kin = materialize(sibling_classes(pcm), "siblings")
    within = pairs_within_groups(kin, "parents", "child_id", ["child_birth_date"], block_size).select(
        F.col("member_a").alias("person_a"), F.col("member_b").alias("person_b"),
        F.size("parents").cast("long").alias("shared_parent_count"),
        F.col("child_birth_date_a").alias("birth_a"), F.col("child_birth_date_b").alias("birth_b"))

    classes = kin.select("parents").distinct().select("parents", F.explode("parents").alias("parent_id"))
    shared = F.array_intersect("member_a", "member_b")
    met = pairs_within_groups(classes, "parent_id", "parents", [], block_size).where(
        F.col("parent_id") == F.array_min(shared)).select("member_a", "member_b", F.size(shared).cast("long").alias("shared_parent_count"))

    def side(s: str) -> DataFrame:
        return kin.select(F.col("parents").alias(f"member_{s}"), F.col("child_id").alias(f"_{s}"), F.col("child_birth_date").alias(f"_born_{s}"))

    first = F.col("_a") < F.col("_b")
    across = met.join(side("a").hint("merge"), "member_a").join(side("b").hint("merge"), "member_b").select(
        F.least("_a", "_b").alias("person_a"), F.greatest("_a", "_b").alias("person_b"), "shared_parent_count",
        F.when(first, F.col("_born_a")).otherwise(F.col("_born_b")).alias("birth_a"),
        F.when(first, F.col("_born_b")).otherwise(F.col("_born_a")).alias("birth_b"))
    return within.unionByName(across)


def sibling_edges(pairs: DataFrame) -> DataFrame:
    """Both directions of every sibling pair.

    SIBLING with two or more shared parents, else HALF_SIBLING; start = the
    later birth date, or the known one. One pass emits both directions.
    """
    code = sibling_role_code("shared_parent_count")
    start = later_of("birth_a", "birth_b")
    both = F.explode(F.array(
        F.struct(F.col("person_a").alias("s"), F.col("person_b").alias("t")),
        F.struct(F.col("person_b").alias("s"), F.col("person_a").alias("t"))))
    return pairs.select(both.alias("_d"), code.alias("relationship_role_code"),
                        start.alias("start_date")).select(
        F.col("_d.s").alias("source_person_id"), F.col("_d.t").alias("target_person_id"),
        "relationship_role_code", "start_date",
        _null_date().alias("end_date"), _null_text().alias("end_reason"))


def derive_edges(person: DataFrame, family: DataFrame, relation: DataFrame,
                 block_size: int = DEFAULT_BLOCK_SIZE, share: bool = True) -> DataFrame:
    """All distinct directed edges of one snapshot.

    With ``share`` the two intermediates read by several branches - the
    spouse memberships (pairs, hot-group counts, parent x child) and
    parent x child (PARENT, CHILD, parent-child map) - are written
    once, instead of each branch re-reading, re-sorting and re-joining
    their shuffle output.
    """
    sp = spouse_relation(relation, family)
    if share:
        sp = materialize(sp)
    pc = parent_child(sp, child_relation(relation, person))
    if share:
        pc = materialize(pc)
    non_sibling = (spouse_edges(sp, distinct=False)
                   .unionByName(parent_edges(pc, distinct=False))
                   .unionByName(child_edges(pc, distinct=False))
                   .distinct())
    siblings = sibling_edges(sibling_pairs(parent_child_map(pc), block_size))
    return non_sibling.unionByName(siblings).select(*EDGE_KEY)


def enrich_edges(edges: DataFrame, dim_person: DataFrame, dim_role: DataFrame,
                 dim_date: DataFrame, keep_unmatched: bool = False) -> DataFrame:
    """Attach dimension keys to edges.

    Inner joins on the *current* person versions (source and target) and on
    the role; left joins on the calendar, so a NULL or out-of-range date gets
    a NULL date key. With ``keep_unmatched`` every edge is kept and
    ``_enriched`` tells whether the inner joins would have kept it.
    """
    cur = dim_person.where(F.col("is_current")).select("person_id", "person_sk")
    src = cur.select(F.col("person_id").alias("source_person_id"),
                     F.col("person_sk").alias("source_person_sk"))
    tgt = cur.select(F.col("person_id").alias("target_person_id"),
                     F.col("person_sk").alias("target_person_sk"))
    # Seven roles and a calendar of 73,414 days as a rule; both are counted, and
    # shuffled if a caller passes more than a broadcast may hold.
    role = small(dim_role.select(F.col("relationship_role_code"), "relationship_role_sk"))
    dates = small(dim_date.select("full_date", "date_sk"))
    how = "left" if keep_unmatched else "inner"
    # Persons are as many as the snapshot has: never sent to the driver, however small their files are.
    out = (edges.join(src.hint("merge"), "source_person_id", how)
           .join(tgt.hint("merge"), "target_person_id", how)
           .join(role, "relationship_role_code", how)
           .join(dates.select(F.col("full_date").alias("start_date"),
                              F.col("date_sk").alias("start_date_sk")), "start_date", "left")
           .join(dates.select(F.col("full_date").alias("end_date"),
                              F.col("date_sk").alias("end_date_sk")), "end_date", "left"))
    cols = ["source_person_sk", "target_person_sk", "relationship_role_sk",
            "start_date_sk", "end_date_sk", *EDGE_KEY]
    if keep_unmatched:
        flag = (F.col("source_person_sk").isNotNull() & F.col("target_person_sk").isNotNull()
                & F.col("relationship_role_sk").isNotNull())
        return out.select(*cols, flag.alias("_enriched"))
    return out.select(*cols)
