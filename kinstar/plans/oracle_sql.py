"""Independent SQL formulations (DuckDB dialect) of the registered queries.

Each query is assembled from named CTE blocks over the pre-registered
``customer`` / ``orders`` / ``lineitem`` views. The blocks take another view of
the semantics than the Spark operators, so agreement is meaningful: a family is
one row with lists of its members, siblings are pairs of children whose parent
sets intersect, the person dimension is cut from the sequence of each person's
states over all runs, and a fact row is a fold over the runs in which its key
was seen. Nothing is merged run by run.
"""

from __future__ import annotations

AS_OF_DATE = "2026-06-30"  # fixed "today" of the marriage timeline
RUN_STARTS = {1: "2026-01-01 02:00:00", 2: "2026-01-02 02:00:00", 3: "2026-01-03 02:00:00"}


def run_name(seq: int) -> str:
    return f"r{seq}"


# --- fixture ------------------------------------------------------------------------

def fixture(seq: int, content: int | None = None) -> list[str]:
    """CTEs person_<seq>, family_<seq>, relation_<seq>.

    ``content`` picks the derivation rules (1 or 2); run 3 replays run 1.
    """
    k = content or seq
    s = seq
    return [
        f"""cust_{s} AS (
  SELECT c_custkey AS c, c_nationkey AS nk, c_mktsegment AS seg,
         CAST(floor(c_custkey / 2) AS BIGINT) AS i, c_custkey % 2 AS odd,
         CAST(floor((CAST(floor(c_custkey / 2) AS BIGINT) - 1) / 4) AS BIGINT) AS pf
  FROM customer)""",
        f"""person_{s} AS (
  SELECT 'p' || CAST(c AS VARCHAR) AS person_id,
         'F' || CAST(c % 97 AS VARCHAR) AS first_name,
         'L' || CAST(nk AS VARCHAR) AS last_name,
         CASE WHEN odd = 0 THEN 'Male' ELSE 'Female' END AS sex,
         CASE WHEN c % 29 = 10 THEN CAST(NULL AS DATE)
              ELSE DATE '1890-01-01' + CAST((c * 37) % 40000 AS INTEGER) END AS birth_date,
         CASE WHEN c % 4 = 1 OR ({k} = 2 AND c % 16 = 6)
              THEN DATE '1990-01-01' + CAST((c * 11) % 9000 AS INTEGER) END AS death_date,
         seg AS education,
         CASE WHEN c % 31 = 12 THEN NULL
              WHEN {k} = 2 AND c % 10 = 3 THEN 'W-new'
              ELSE 'W' || CAST(nk AS VARCHAR) END AS works
  FROM cust_{s}
  WHERE NOT (({k} = 2 AND c % 50 = 7) OR ({k} = 1 AND c % 40 = 9)))""",
        f"""family_{s} AS (
  SELECT 'f' || CAST(i AS VARCHAR) AS family_id,
         CASE WHEN i % 23 = 8 THEN CAST(NULL AS DATE)
              ELSE DATE '1910-01-01' + CAST((i * 53) % 36000 AS INTEGER) END AS marriage_date,
         CASE WHEN i % 9 = 2 OR ({k} = 2 AND i % 6 = 1)
              THEN DATE '2015-01-01' + CAST((i * 7) % 3000 AS INTEGER) END AS divorce_date,
         CASE WHEN i % 9 = 2 THEN 'DIVORCED' WHEN i % 9 = 5 THEN 'ended'
              WHEN i % 21 = 4 THEN NULL ELSE 'ACTIVE' END AS status
  FROM cust_{s} WHERE odd = 0
  UNION ALL
  SELECT 'g' || CAST(i AS VARCHAR), DATE '1960-01-01' + CAST((i * 53) % 20000 AS INTEGER),
         CAST(NULL AS DATE), 'ACTIVE'
  FROM cust_{s} WHERE odd = 0 AND i % 7 = 3)""",
        f"""relation_{s} AS (
  SELECT * FROM (
    SELECT 'p' || CAST(c AS VARCHAR) AS person_id, 'f' || CAST(i AS VARCHAR) AS family_id,
           'SPOUSE_OF' AS relationship_type,
           CASE WHEN i % 17 = 4 THEN NULL WHEN i % 13 = 5 THEN 'PARTNER'
                WHEN odd = 0 AND i % 5 = 1 THEN 'husband'
                WHEN odd = 0 THEN 'HUSBAND' ELSE 'WIFE' END AS role
    FROM cust_{s} WHERE NOT (odd = 1 AND i % 19 = 6)
    UNION ALL
    SELECT 'p' || CAST(c AS VARCHAR), 'g' || CAST(i - odd AS VARCHAR), 'SPOUSE_OF',
           CASE WHEN odd = 0 THEN 'HUSBAND' ELSE 'WIFE' END
    FROM cust_{s} WHERE (i - odd) % 7 = 3
    UNION ALL
    SELECT 'p' || CAST(c AS VARCHAR),
           CASE WHEN pf % 7 = 3 AND i % 4 = 2 THEN 'g' ELSE 'f' END
             || CAST(CASE WHEN {k} = 2 AND i % 20 = 7 THEN CAST(floor(i / 640) AS BIGINT) ELSE pf END AS VARCHAR),
           'CHILD_OF', CAST(NULL AS VARCHAR)
    FROM cust_{s} WHERE odd = 0 AND i >= 1
  ) r
  WHERE r.person_id IN (SELECT person_id FROM person_{s}))""",
    ]


# --- kinship edges -------------------------------------------------------------------

NO_END = "CAST(NULL AS DATE) AS end_date, CAST(NULL AS VARCHAR) AS end_reason"


def kinship(s: int) -> list[str]:
    """CTEs of the edges of snapshot s. A household is a family with the lists of
    its spouses and children; parents_s holds each child's set of parents."""
    return [
        f"""household_{s} AS (
  SELECT f.*, h.spouses, h.children FROM family_{s} f JOIN (
    SELECT family_id,
           list({{'id': person_id, 'role': upper(coalesce(role, 'NONE'))}})
             FILTER (WHERE upper(relationship_type) = 'SPOUSE_OF') AS spouses,
           list(person_id) FILTER (WHERE upper(relationship_type) = 'CHILD_OF') AS children
    FROM relation_{s} GROUP BY family_id) h USING (family_id))""",
        f"""spouse_rel_{s} AS (
  SELECT m.id AS person_id, family_id, m.role AS role, marriage_date, divorce_date, status
  FROM (SELECT * EXCLUDE (spouses, children), unnest(spouses) AS m FROM household_{s}))""",
        f"""spouse_edge_{s} AS (
  SELECT DISTINCT m.id AS source_person_id, o.id AS target_person_id,
         coalesce(MAP {{'HUSBAND': 'SPOUSE_HUSBAND', 'WIFE': 'SPOUSE_WIFE'}}[m.role], 'SPOUSE_PARTNER')
           AS relationship_role_code,
         marriage_date AS start_date, divorce_date AS end_date,
         CASE WHEN divorce_date IS NOT NULL THEN 'DIVORCE'
              WHEN list_contains(['DIVORCED', 'ENDED'], upper(status)) THEN 'STATUS_ENDED' END AS end_reason
  FROM (SELECT *, unnest(spouses) AS o FROM (SELECT *, unnest(spouses) AS m FROM household_{s}))
  WHERE m.id <> o.id)""",
        f"""pair_{s} AS (
  SELECT m.id AS parent_id, x.child_id, marriage_date, p.birth_date AS born
  FROM (SELECT marriage_date, m, unnest(children) AS child_id
        FROM (SELECT *, unnest(spouses) AS m FROM household_{s})) x
  LEFT JOIN person_{s} p ON p.person_id = x.child_id)""",
        f"""parent_edge_{s} AS (
  SELECT parent_id AS source_person_id, child_id AS target_person_id, 'PARENT' AS relationship_role_code,
         coalesce(marriage_date, born) AS start_date, {NO_END} FROM pair_{s} GROUP BY ALL)""",
        f"""child_edge_{s} AS (
  SELECT child_id AS source_person_id, parent_id AS target_person_id, 'CHILD' AS relationship_role_code,
         born AS start_date, {NO_END} FROM pair_{s} GROUP BY ALL)""",
        f"""pcm_{s} AS (SELECT parent_id, child_id FROM pair_{s} GROUP BY ALL)""",
        f"""parents_{s} AS (
  SELECT child_id, any_value(born) AS born, list(DISTINCT parent_id) AS parents FROM pair_{s} GROUP BY child_id)""",
        f"""brood_{s} AS (SELECT list(child_id) AS brood FROM pcm_{s} GROUP BY parent_id)""",
        f"""sib_pair_{s} AS (
  SELECT person_a, person_b, len(list_intersect(a.parents, b.parents)) AS shared_parent_count,
         greatest(a.born, b.born) AS later
  FROM (SELECT DISTINCT person_a, person_b
        FROM (SELECT person_a, unnest(brood) AS person_b FROM (SELECT brood, unnest(brood) AS person_a FROM brood_{s}))
        WHERE person_a < person_b)
  JOIN parents_{s} a ON a.child_id = person_a JOIN parents_{s} b ON b.child_id = person_b)""",
        f"""sib_edge_{s} AS (
  SELECT e[1] AS source_person_id, e[2] AS target_person_id,
         ['HALF_SIBLING', 'SIBLING'][least(shared_parent_count, 2)] AS relationship_role_code,
         later AS start_date, {NO_END}
  FROM (SELECT *, unnest([[person_a, person_b], [person_b, person_a]]) AS e FROM sib_pair_{s}))""",
        f"""edge_{s} AS (
  SELECT * FROM spouse_edge_{s} UNION SELECT * FROM parent_edge_{s}
  UNION SELECT * FROM child_edge_{s} UNION SELECT * FROM sib_edge_{s})""",
    ]


def with_ctes(ctes: list[str], select: str, recursive: bool = False) -> str:
    seen: list[str] = []
    for c in ctes:
        if c not in seen:
            seen.append(c)
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(seen) + "\n" + select


# --- dimensions ------------------------------------------------------------------------

def dim_role() -> str:
    return """dim_role AS (
  SELECT CAST(sk AS BIGINT) AS relationship_role_sk, code AS relationship_role_code,
         rtype AS relationship_type, prole AS person_role, sym AS is_symmetric,
         inv AS inverse_role_code
  FROM (VALUES (1, 'SPOUSE_HUSBAND', 'SPOUSE', 'HUSBAND', FALSE, 'SPOUSE_WIFE'),
               (2, 'SPOUSE_WIFE', 'SPOUSE', 'WIFE', FALSE, 'SPOUSE_HUSBAND'),
               (3, 'SPOUSE_PARTNER', 'SPOUSE', 'PARTNER', TRUE, 'SPOUSE_PARTNER'),
               (4, 'PARENT', 'PARENT_CHILD', 'PARENT', FALSE, 'CHILD'),
               (5, 'CHILD', 'PARENT_CHILD', 'CHILD', FALSE, 'PARENT'),
               (6, 'SIBLING', 'SIBLING', 'SIBLING', TRUE, 'SIBLING'),
               (7, 'HALF_SIBLING', 'SIBLING', 'HALF_SIBLING', TRUE, 'HALF_SIBLING'))
       AS v(sk, code, rtype, prole, sym, inv))"""


def calendar_select(date_expr: str, source: str) -> str:
    d = date_expr
    return f"""SELECT CAST(strftime({d}, '%Y%m%d') AS INTEGER) AS date_sk, {d} AS full_date,
         CAST(extract(day FROM {d}) AS TINYINT) AS day_of_month,
         CAST(extract(month FROM {d}) AS TINYINT) AS month_of_year,
         strftime({d}, '%B') AS month_name,
         CAST(extract(quarter FROM {d}) AS TINYINT) AS quarter_of_year,
         CAST(extract(year FROM {d}) AS SMALLINT) AS year_num,
         CAST(extract(dow FROM {d}) AS TINYINT) AS day_of_week,
         strftime({d}, '%A') AS day_name,
         extract(dow FROM {d}) IN (5, 6) AS is_weekend
  FROM {source}"""


def dim_date() -> str:
    src = ("(SELECT CAST(g AS DATE) AS d FROM generate_series(DATE '1900-01-01', "
           "DATE '2100-12-31', INTERVAL 1 DAY) AS t(g)) cal")
    return f"dim_date AS (\n  {calendar_select('d', src)})"


PERSON_COLS = ["first_name", "last_name", "sex", "birth_date", "death_date", "education", "works"]


def md5_sql(alias: str = "") -> str:
    a = f"{alias}." if alias else ""
    parts = []
    for c in PERSON_COLS:
        v = f"CAST({a}{c} AS VARCHAR)" if c.endswith("_date") else f"{a}{c}"
        parts.append(f"coalesce({v}, '')")
    return "md5(" + " || '|' || ".join(parts) + ")"


def dimension(seqs: list[int]) -> list[str]:
    """CTEs dim_<s>: the person dimension after run s of the runs ``seqs``.

    A person's states over the runs (a hash, or NULL where absent) tell all:
    a version begins in a run whose hash is not that of the run before, and
    ends in the next run with another state, which deletes it if absent.
    """
    cols = ", ".join(PERSON_COLS)
    seen = "\n    UNION ALL ".join(f"SELECT {n} AS n, *, {md5_sql()} AS attr_hash FROM person_{s}" for n, s in enumerate(seqs, 1))
    ctes = [
        f"""seen AS (
    {seen})""",
        f"""states AS (
  SELECT p.person_id, r.n, s.attr_hash,
         lag(s.attr_hash) OVER (PARTITION BY p.person_id ORDER BY r.n) AS before
  FROM (SELECT DISTINCT person_id FROM seen) p
  CROSS JOIN (SELECT unnest(range(1, {len(seqs) + 1})) AS n) r
  LEFT JOIN seen s ON s.person_id = p.person_id AND s.n = r.n)""",
        f"""versions AS (
  SELECT row_number() OVER (ORDER BY b.n, b.person_id) AS person_sk, b.person_id, b.n AS begins,
         e.n AS ends, e.attr_hash IS NULL AS ends_absent
  FROM states b
  LEFT JOIN states e ON e.person_id = b.person_id AND e.n > b.n AND e.attr_hash IS DISTINCT FROM e.before
    AND NOT EXISTS (SELECT 1 FROM states x WHERE x.person_id = b.person_id AND x.n > b.n AND x.n < e.n
                    AND x.attr_hash IS DISTINCT FROM x.before)
  WHERE b.attr_hash IS NOT NULL AND b.attr_hash IS DISTINCT FROM b.before)""",
    ]
    name = "[" + ", ".join(f"'r{s}'" for s in seqs) + "]"
    for n, s in enumerate(seqs, 1):
        ctes.append(f"""dim_{s} AS (
  SELECT v.person_sk, v.person_id, {cols}, attr_hash, {name}[v.begins] AS valid_from_run_id,
         CASE WHEN v.ends <= {n} THEN {name}[v.ends] END AS valid_to_run_id,
         coalesce(v.ends > {n}, TRUE) AS is_current, coalesce(v.ends <= {n} AND v.ends_absent, FALSE) AS is_deleted
  FROM versions v JOIN seen s ON s.person_id = v.person_id AND s.n = v.begins WHERE v.begins <= {n})""")
    return ctes


EDGE_COLS = ["source_person_id", "target_person_id", "relationship_role_code", "start_date",
             "end_date", "end_reason"]


def keyed(s: int) -> str:
    """All edges of run s with their dimension keys; ``hit`` if all three are found."""
    return f"""keyed_{s} AS (
  WITH who AS (SELECT person_id, person_sk FROM dim_{s} WHERE valid_to_run_id IS NULL),
  code AS (SELECT relationship_role_code, relationship_role_sk FROM dim_role),
  day AS (SELECT full_date, date_sk FROM dim_date)
  SELECT edge_{s}.*, x.person_sk AS source_person_sk, y.person_sk AS target_person_sk, relationship_role_sk,
         b.date_sk AS start_date_sk, z.date_sk AS end_date_sk,
         x.person_sk + y.person_sk + relationship_role_sk IS NOT NULL AS hit
  FROM edge_{s} LEFT JOIN code USING (relationship_role_code)
  LEFT JOIN who x ON x.person_id = source_person_id LEFT JOIN who y ON y.person_id = target_person_id
  LEFT JOIN day b ON b.full_date = start_date LEFT JOIN day z ON z.full_date = end_date)"""


KEYS = ["source_person_sk", "target_person_sk", "relationship_role_sk", "start_date_sk", "end_date_sk"]
FACT_OUT = ["relationship_sk", "source_person_sk", "target_person_sk", "relationship_role_sk",
            "start_date_sk", "end_date_sk", "source_person_id", "target_person_id",
            "source_relationship_role_code", "start_date", "end_date", "end_reason",
            "first_seen_run_id", "last_seen_run_id", "is_deleted", "deleted_at_run_id",
            "relation_count"]


def facts(seqs: list[int]) -> list[str]:
    """CTEs fact_<s>: the fact after run s (audit timestamps left out), folded per
    key over the runs: ``first`` and ``last`` are the runs in which the edge could
    be keyed, ``runs`` all in which it was derived. It is deleted by the first run
    after ``last`` that did not derive it."""
    name = "[" + ", ".join(f"'r{s}'" for s in seqs) + "]"
    key = ", ".join(EDGE_COLS)
    ctes = [dim_role(), dim_date(), *[keyed(s) for s in seqs]]
    rows = []
    for n, s in enumerate(seqs, 1):
        rows.append(f"SELECT {n} AS n, * FROM keyed_{s}")
        ctes.append(f"""fact_{s} AS (
  SELECT row_number() OVER (ORDER BY first, {", ".join(f"{c} NULLS FIRST" for c in EDGE_COLS)}) AS relationship_sk,
         {", ".join(f"held.{c}" for c in KEYS)}, source_person_id, target_person_id,
         relationship_role_code AS source_relationship_role_code, start_date, end_date, end_reason,
         {name}[first] AS first_seen_run_id, {name}[last] AS last_seen_run_id,
         gone IS NOT NULL AS is_deleted, {name}[gone] AS deleted_at_run_id, CAST(1 AS INTEGER) AS relation_count
  FROM (
    SELECT *, list_min(list_filter(range(last + 1, {n + 1}), lambda k: NOT list_contains(runs, k))) AS gone
    FROM (
      SELECT {key}, min(n) FILTER (WHERE hit) AS first, max(n) FILTER (WHERE hit) AS last, list(n) AS runs,
             arg_max({{{", ".join(f"'{c}': {c}" for c in KEYS)}}}, n) FILTER (WHERE hit) AS held
      FROM ({" UNION ALL ".join(rows)}) GROUP BY {key})
    WHERE first IS NOT NULL))""")
    return ctes


def dims_only(seqs: list[int]) -> list[str]:
    """Fixture, kinship and dimension CTEs for runs ``seqs`` (run 3 replays run 1)."""
    ctes: list[str] = []
    for s in seqs:
        ctes += fixture(s, 1 if s == 3 else s)
    for s in seqs:
        ctes += kinship(s)
    return ctes + dimension(seqs)


def state(seqs: list[int]) -> list[str]:
    """Fixture, kinship, dimension and fact CTEs for runs ``seqs``."""
    return dims_only(seqs) + facts(seqs)
