"""Cohorts, matching, outcomes and the two studies."""

from __future__ import annotations

from pyspark.sql import functions as F

from kohortflow.checks.registry import check, rounded
from kohortflow.checks.tables import cases, child, diagnosis, exposed, ranges
from kohortflow.operators import cohort as co
from kohortflow.operators.propensity import caliper_match, propensity_logit
from kohortflow.plans import studies


@check("severe_chronic_cases", "SELECT * FROM {o_cases}")
def _(t):
    return co.severe_chronic_cases(diagnosis(t), ranges(t))


@check("exposed_group", "SELECT * FROM {o_exposed}")
def _(t):
    return exposed(t)


check(
    "exposed_group_first_index",
    """SELECT child_id, family_id, birth_date, min(index_date) AS index_date
       FROM {o_exposed} WHERE index_date >= birth_date GROUP BY ALL""",
)(lambda t: exposed(t, non_negative=True, first_index=True))
check(
    "exposed_group_no_child_table",
    """SELECT DISTINCT person_id AS child_id, CAST(NULL AS VARCHAR) AS family_id, diagnosis_date AS index_date
       FROM {o_cases}""",
)(lambda t: co.exposed_group(cases(t), None))


def kids(t):
    return child(t).select("child_id", "family_id", "birth_date")


check("unexposed_pool", "SELECT * FROM {o_pool}")(lambda t: co.unexposed_pool(kids(t)))
check(
    "unexposed_pool_excluding",
    "SELECT * FROM {o_pool} WHERE child_id NOT IN (SELECT child_id FROM {o_exposed})",
)(lambda t: co.unexposed_pool(kids(t), exclude=exposed(t)))


@check(
    "record_split",
    """SELECT RECNUM, l_linenumber, C_DIAG,
              CASE WHEN EXISTS (SELECT 1 FROM {icd_range} r WHERE C_DIAG >= r.lo
                                AND substr(C_DIAG, 1, length(r.hi)) <= r.hi) THEN 'exposed' ELSE 'unexposed' END AS grp
       FROM {r_diag} WHERE C_DIAG IS NOT NULL""",
)
def _(t):
    inside, outside = co.record_split(t["r_diag"].select("RECNUM", "l_linenumber", "C_DIAG"), ranges(t))
    return inside.withColumn("grp", F.lit("exposed")).unionByName(outside.withColumn("grp", F.lit("unexposed")))


MATCH_SQL = """
    SELECT p.birth_date, p.family_id, p.child_id, e.index_date, count(*) AS n_exposed
    FROM {o_exposed} e JOIN {o_pool} p ON e.birth_date = p.birth_date
    WHERE p.family_id IS NOT NULL GROUP BY ALL"""


@check("match_cohorts", MATCH_SQL)
def _(t):
    return co.exact_match(exposed(t), co.unexposed_pool(kids(t)))


DRAW_SQL = "((CAST(child_id AS BIGINT) * 7919) % 100003)"


@check(
    "match_one_to_k",
    f"""SELECT e.birth_date, e.child_id AS exposed_id, e.index_date, c.child_id
        FROM (SELECT *, row_number() OVER (PARTITION BY birth_date ORDER BY {DRAW_SQL}, child_id) AS slot
              FROM {{o_first}}) e
        JOIN (SELECT *, row_number() OVER (PARTITION BY birth_date ORDER BY {DRAW_SQL}, child_id) AS n
              FROM {{o_pool}} WHERE child_id NOT IN (SELECT child_id FROM {{o_exposed}})) c
          ON e.birth_date = c.birth_date AND e.slot = CAST(ceil(c.n / 2.0) AS BIGINT)""",
)
def _(t):
    group = exposed(t, first_index=True)
    draw = (F.col("child_id").cast("bigint") * 7919 % 100003) / 100003
    return co.match_one_to_k(group, co.unexposed_pool(kids(t), exclude=group), k=2, draw=draw)


@check("caliper_match")
def _(t):
    """Orders by status: treated = F, scored on price and customer."""
    df = t["orders"].select(
        F.col("o_orderkey").alias("id"),
        (F.col("o_orderstatus") == "F").cast("int").alias("treated"),
        F.col("o_totalprice").alias("price"),
        F.year("o_orderdate").cast("double").alias("year"),
    )
    return caliper_match(propensity_logit(df, "treated", ["price", "year"]), "treated", "id")


@check(
    "create_cohorts",
    f"""SELECT 'exposed' AS cohort, birth_date, child_id, index_date, CAST(1 AS BIGINT) AS n_exposed FROM {{o_exposed}}
        UNION ALL SELECT 'unexposed', birth_date, child_id, index_date, n_exposed FROM ({MATCH_SQL})""",
)
def _(t):
    group, matched = studies.create_cohorts({"Diagnosis": diagnosis(t), "Child": child(t)}, ranges(t))
    columns = ["cohort", "birth_date", "child_id", "index_date", "n_exposed"]
    group = group.select(F.lit("exposed").alias("cohort"), *columns[1:4], F.lit(1).cast("bigint").alias("n_exposed"))
    return group.unionByName(matched.select(F.lit("unexposed").alias("cohort"), *columns[1:]))


@check(
    "treatment_period",
    """SELECT c.family_id, d.diagnosis_date AS treatment_start_date, d.diagnosis_date - 365 AS pre_treatment_start,
              d.diagnosis_date AS pre_treatment_end, d.diagnosis_date + 1825 AS post_treatment_end
       FROM {o_diagnosis} d JOIN {o_child} c ON d.person_id = c.child_id""",
)
def _(t):
    return co.treatment_period(diagnosis(t), child(t))


@check(
    "pre_post_label",
    """WITH p AS (SELECT DISTINCT c.family_id, d.diagnosis_date + 700 AS s
                  FROM {o_cases} d JOIN {o_child} c ON d.person_id = c.child_id),
            a AS (SELECT a.RECNUM, c.family_id, a.D_INDDTO FROM {r_adm} a JOIN {o_child} c ON CAST(a.PNR AS VARCHAR) = c.child_id)
       SELECT a.*, 'post' AS period FROM a
       WHERE EXISTS (SELECT 1 FROM p WHERE p.family_id = a.family_id AND a.D_INDDTO BETWEEN p.s AND p.s + 1825)
       UNION ALL
       SELECT a.*, 'pre' FROM a
       WHERE EXISTS (SELECT 1 FROM p WHERE p.family_id = a.family_id AND a.D_INDDTO BETWEEN p.s - 365 AND p.s)
         AND NOT EXISTS (SELECT 1 FROM p WHERE p.family_id = a.family_id AND a.D_INDDTO BETWEEN p.s AND p.s + 1825)""",
)
def _(t):
    shifted = cases(t).withColumn("diagnosis_date", F.date_add("diagnosis_date", 700))
    family = child(t).select(F.col("child_id").alias("PNR"), "family_id")
    dated = t["r_adm"].select("RECNUM", F.col("PNR").cast("string").alias("PNR"), "D_INDDTO").join(family, "PNR")
    return co.pre_post_label(dated, "D_INDDTO", co.treatment_period(shifted, child(t))).select(
        "RECNUM", "family_id", "D_INDDTO", "period"
    )


PERIODS = {"short": 1, "medium": 5, "long": 10}


@check(
    "outcome_by_period",
    "SELECT e.child_id, e.index_date, "
    + ", ".join(
        f"""count(*) FILTER (a.day - e.index_date BETWEEN 0 AND {n * 365}) AS n_{p},
            CAST(coalesce(sum(CASE WHEN a.day - e.index_date BETWEEN 0 AND {n * 365} THEN a.v END), 0) AS DOUBLE) AS sum_{p}"""
        for p, n in PERIODS.items()
    )
    + """ FROM {o_first} e LEFT JOIN (SELECT CAST(o_custkey AS VARCHAR) AS child_id, CAST(o_orderdate AS DATE) AS day,
                                      CAST(o_totalprice AS DECIMAL(18,2)) AS v FROM orders) a
           ON e.child_id = a.child_id GROUP BY ALL""",
)
def _(t):
    events = t["orders"].select(
        F.col("o_custkey").cast("string").alias("child_id"),
        F.to_date("o_orderdate").alias("day"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("v"),
    )
    out = co.outcome_by_period(exposed(t, first_index=True), events, "child_id", "day", "v", PERIODS)
    return out.select(*[F.col(c).cast("double").alias(c) if c.startswith("sum") else F.col(c) for c in out.columns])


@check(
    "income_comparison",
    """SELECT x.year, round(x.avg_x, 3) AS avg_income_exposed, round(u.avg_u, 3) AS avg_income_unexposed
       FROM (SELECT year, CAST(sum(income) AS DOUBLE) / count(*) AS avg_x
             FROM {o_pincome} i JOIN {o_exposed} e ON i.child_id = e.child_id GROUP BY year) x
       JOIN (SELECT year, CAST(sum(income) AS DOUBLE) / count(*) AS avg_u
             FROM {o_pincome} i JOIN (SELECT p.child_id FROM {o_exposed} e JOIN {o_pool} p
                                      ON e.birth_date = p.birth_date WHERE p.family_id IS NOT NULL) m
               ON i.child_id = m.child_id GROUP BY year) u
         ON x.year = u.year""",
)
def income_comparison(t):
    registers = {
        "LPR_DIAG": t["r_diag"], "LPR_ADM": t["r_adm"], "MFR": t["r_mfr"], "BEF": t["r_snapshot"], "IND": t["r_ind"],
    }
    out = studies.income_study(registers, ranges(t))
    return out.select("year", rounded("avg_income_exposed"), rounded("avg_income_unexposed"))


@check(
    "education_cohort",
    """WITH linked AS (SELECT e.PNR, d.C_DIAG, EXISTS (SELECT 1 FROM {icd_range} r WHERE d.C_DIAG >= r.lo
                              AND substr(d.C_DIAG, 1, length(r.hi)) <= r.hi) AS hit
                       FROM (SELECT DISTINCT PNR FROM {o_eligible}) e JOIN {r_adm} a ON e.PNR = a.PNR
                       JOIN {r_diag} d ON a.RECNUM = d.RECNUM)
       SELECT 'eligible' AS cohort, count(DISTINCT PNR) AS n_persons FROM {o_eligible}
       UNION ALL SELECT 'exposed', count(DISTINCT PNR) FROM linked WHERE hit
       UNION ALL SELECT 'unexposed', count(DISTINCT PNR) FROM linked WHERE NOT hit""",
)
def _(t):
    return studies.education_cohort(
        t["r_snapshot"], t["r_mfr"], t["r_diag"], t["r_adm"], ranges(t), 2000, 2018, 5
    )


@check(
    "education_rows",
    """WITH linked AS (SELECT a.PNR, EXISTS (SELECT 1 FROM {icd_range} r WHERE d.C_DIAG >= r.lo
                              AND substr(d.C_DIAG, 1, length(r.hi)) <= r.hi) AS hit
                       FROM {r_adm} a JOIN {r_diag} d ON a.RECNUM = d.RECNUM),
            cohort AS (SELECT DISTINCT PNR, CASE WHEN hit THEN 'exposed' ELSE 'unexposed' END AS cohort FROM linked)
       SELECT e.PNR, x.cohort,
              CASE WHEN m.HFAUDD IS NOT NULL AND m.HF_VFRA <= e.FOED_DAG THEN m.HFAUDD ELSE 'Unknown' END AS MOR_UDDANNELSE,
              CASE WHEN f.HFAUDD IS NOT NULL AND f.HF_VFRA <= e.FOED_DAG THEN f.HFAUDD ELSE 'Unknown' END AS FAR_UDDANNELSE
       FROM {o_eligible} e JOIN cohort x ON e.PNR = x.PNR
       LEFT JOIN {o_latest} m ON e.MOR_ID = m.PNR LEFT JOIN {o_latest} f ON e.FAR_ID = f.PNR""",
)
def _(t):
    out = studies.education_rows(
        t["r_snapshot"], t["r_mfr"], t["r_diag"], t["r_adm"], t["r_uddf"], ranges(t), 2000, 2018, 5
    )
    return out.select("PNR", "cohort", "MOR_UDDANNELSE", "FAR_UDDANNELSE")
