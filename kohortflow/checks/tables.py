"""Projections, analysis tables and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kohortflow.checks.registry import check, rounded
from kohortflow.checks.roles import Tables
from kohortflow.functions.codes import (
    endpoint_codes,
    icd_range_join,
    in_code_ranges,
    parse_code_list,
    severe_chronic_list,
)
from kohortflow.functions.exprs import cap_start, first_known_at, known_at
from kohortflow.operators.aggregates import latest_per_key
from kohortflow.operators.cohort import exact_match, exposed_group, severe_chronic_cases, unexposed_pool
from kohortflow.operators.joins import (
    asof_join,
    full_outer_merge,
    link_children_to_parents,
    parental_income,
    person_child,
    person_family,
)
from kohortflow.operators.projection import (
    between_dates,
    eligible_children,
    has_code,
    lacks_code,
    limit_rows,
    typed_projection,
)
from kohortflow.plans import tables as at
from kohortflow.plans.studies import child_health_records, parent_education


def ranges(t: Tables) -> DataFrame:
    return parse_code_list(severe_chronic_list(t.spark))


def diagnosis(t: Tables) -> DataFrame:
    return at.diagnosis_table([(t["r_diag"], t["r_adm"])])


def child(t: Tables) -> DataFrame:
    return at.child_table(t["r_mfr"])


def cases(t: Tables) -> DataFrame:
    coded = at.diagnosis_table([(t["r_diag"], t["r_adm"])], lambda d: in_code_ranges(d, "C_DIAG", ranges(t)))
    return severe_chronic_cases(coded, ranges(t), mode="any")


def exposed(t: Tables, **options) -> DataFrame:
    return exposed_group(cases(t), child(t), **options)


def doubles(df: DataFrame) -> DataFrame:
    """Single-precision columns widened, so both engines print the same digits."""
    return df.select(*[F.col(c).cast("double") if k == "float" else F.col(c) for c, k in df.dtypes])


# projections and filters


@check(
    "typed_projection",
    """SELECT CAST(c_custkey AS VARCHAR) AS person_id, c_mktsegment AS segment,
              CAST(CAST(c_acctbal AS FLOAT) AS DOUBLE) AS balance, CAST(c_nationkey AS BIGINT) AS nation
       FROM customer""",
)
def _(t):
    columns = [
        ("c_custkey", "person_id", "string"),
        ("c_mktsegment", "segment", "string"),
        ("c_acctbal", "balance", "float"),
        ("c_nationkey", "nation", "bigint"),
        ("c_missing", "absent", "string"),
    ]
    return doubles(typed_projection(t["customer"], columns, "customer"))


@check(
    "date_window_filter",
    """SELECT RECNUM, D_INDDTO FROM {r_adm} WHERE D_INDDTO BETWEEN DATE '1997-03-01' AND DATE '1999-08-31'""",
)
def _(t):
    return between_dates(t["r_adm"], "D_INDDTO", "1997-03-01", "1999-08-31").select("RECNUM", "D_INDDTO")


MEMBER_CODES = ["C01", "G40", "E10", "Q05", "K51", "D80.1", "I31.2", "N04.5"]


@check(
    "code_membership",
    f"""SELECT RECNUM, l_linenumber, code, CASE WHEN code IN {tuple(MEMBER_CODES)} THEN 'in' ELSE 'out' END AS member
        FROM (SELECT *, CASE WHEN l_linenumber = 3 THEN NULL ELSE C_DIAG END AS code FROM {{r_diag}})
        WHERE code IS NOT NULL""",
)
def _(t):
    df = t["r_diag"].select(
        "RECNUM", "l_linenumber", F.when(F.col("l_linenumber") != 3, F.col("C_DIAG")).alias("code")
    )
    inside = has_code(df, "code", MEMBER_CODES).withColumn("member", F.lit("in"))
    return inside.unionByName(lacks_code(df, "code", MEMBER_CODES).withColumn("member", F.lit("out")))


@check("eligible_children", "SELECT * FROM {o_eligible}")
def _(t):
    return eligible_children(t["r_snapshot"], t["r_mfr"], 2000, 2018, 5)


@check(
    "conditional_value",
    """SELECT INSTNR,
              CASE WHEN HF_VTIL IS NOT NULL AND HF_VTIL <= HF_VFRA + 200 THEN HFAUDD ELSE 'Unknown' END AS single,
              CASE WHEN HF_VTIL <= HF_VFRA + 200 THEN HFAUDD
                   WHEN HF_VFRA <= DATE '1999-01-01' THEN concat('s', HFAUDD) ELSE 'Unknown' END AS listed
       FROM {r_uddf}""",
)
def _(t):
    ref = F.date_add("HF_VFRA", 200)
    records = F.array(
        F.struct(F.when(F.col("HF_VTIL") <= ref, F.lit("1900-01-01").cast("date")).alias("date"),
                 F.col("HFAUDD").alias("value")),
        F.struct(F.col("HF_VFRA").alias("date"), F.concat(F.lit("s"), "HFAUDD").alias("value")),
    )
    return t["r_uddf"].select(
        "INSTNR",
        known_at(F.col("HFAUDD"), F.col("HF_VTIL"), ref).alias("single"),
        first_known_at(records, F.lit("1999-01-01").cast("date")).alias("listed"),
    )


@check(
    "capped_start",
    """SELECT INSTNR, CASE WHEN HF_VFRA + 300 > HF_VTIL THEN HF_VTIL ELSE HF_VFRA + 300 END AS HF_VFRA FROM {r_uddf}""",
)
def _(t):
    return t["r_uddf"].select(
        "INSTNR", cap_start(F.date_add("HF_VFRA", 300), F.col("HF_VTIL")).alias("HF_VFRA")
    )


@check("limit_rows", "SELECT RECNUM, PNR, D_INDDTO FROM {r_adm} ORDER BY D_INDDTO, RECNUM LIMIT 5")
def _(t):
    return limit_rows(t["r_adm"], 5, "D_INDDTO", "RECNUM").select("RECNUM", "PNR", "D_INDDTO")


# analysis tables

PERSON_SQL = """
    SELECT CAST(p.PNR AS VARCHAR) AS person_id, p.FOED_DAG AS birth_date, p.KOEN AS gender,
           p.CIVST AS civil_status, p.ALDER AS age, CAST(p.FAMILIE_ID AS VARCHAR) AS family_id,
           p.PLADS AS family_role, CAST(p.MOR_ID AS VARCHAR) AS mother_id,
           CAST(p.FAR_ID AS VARCHAR) AS father_id, p.ANTPERSF AS family_size, p.year AS snapshot_year,
           d.DODDATO AS death_date, d.C_DODSMAADE AS death_manner, d.C_DOD1 AS primary_cause,
           d.C_DODTILGRUNDL_ACME AS underlying_cause
    FROM {o_person} p
    LEFT JOIN (SELECT * FROM {r_dod} FULL JOIN {r_dodsaars} USING (PNR) FULL JOIN {r_dodsaasg} USING (PNR)) d
      ON p.PNR = d.PNR"""


def person(t: Tables, **options) -> DataFrame:
    return at.person_table(t["r_snapshot"], t["r_dod"], t["r_dodsaars"], t["r_dodsaasg"], **options)


check("person_table", PERSON_SQL)(person)
check(
    "birth_table",
    """SELECT CAST(PNR AS VARCHAR) AS child_id, FOED_DAG AS birth_date, KOEN AS gender,
              CAST(CAST(VAEGT_BARN AS FLOAT) AS DOUBLE) AS birth_weight, CAST(MOR1 AS VARCHAR) AS mother_id,
              CAST(FAR1 AS VARCHAR) AS father_id, MOR_ALDER AS mother_age
       FROM {r_ftbarn}""",
)(lambda t: doubles(at.birth_table(t["r_ftbarn"])))
check(
    "disability_table",
    """SELECT CAST(PNR AS VARCHAR) AS person_id, FUNK_VURD AS functional_assessment,
              CAST(MAAL_KEY AS VARCHAR) AS target_group_key, MODT_YDELSE_KODE AS service_code,
              YDELSE_START AS service_start_date, YDELSE_SLUT AS service_end_date
       FROM {r_handic}""",
)(lambda t: at.disability_table(t["r_handic"]))
check("child_table", "SELECT * FROM {o_child}")(lambda t: doubles(child(t)))


@check("diagnosis_table", "SELECT * FROM {o_diagnosis}")
def _(t):
    diag, adm = t["r_diag"], t["r_adm"]
    return at.diagnosis_table([(diag, adm.where(F.col("sector") == s)) for s in ("F", "O", "P")])


@check(
    "employment_table",
    """SELECT CAST(PNR AS VARCHAR) AS person_id, CAST(ARBGNR AS VARCHAR) AS employer_id,
              SOCIO13 AS socioeconomic_status, CAST(year AS INT) AS year, JOBLON AS job_salary,
              PERINDKIALT_13 AS total_income
       FROM {r_ind} FULL JOIN {r_idan} USING (PNR, year) FULL JOIN {r_akm} USING (PNR, year)""",
)
def _(t):
    return at.employment_table(t["r_ind"], t["r_idan"], t["r_akm"])


@check(
    "education_table",
    """SELECT CAST(PNR AS VARCHAR) AS person_id, HFAUDD AS education_code, HF_VFRA AS education_start_date,
              HF_VTIL AS education_end_date, CAST(INSTNR AS VARCHAR) AS institution_code
       FROM (SELECT *, row_number() OVER (PARTITION BY PNR ORDER BY HF_VTIL DESC NULLS FIRST, HF_VFRA DESC,
                                          CAST(INSTNR AS VARCHAR) DESC) AS rn FROM {r_uddf})
       WHERE rn = 1""",
)
def _(t):
    return at.education_table(t["r_uddf"])


check(
    "education_details_table",
    """SELECT CAST(PNR AS VARCHAR) AS person_id, FAGKODE AS subject_code, KLASSETYPE AS class_type,
              CAST(KLTRIN AS VARCHAR) AS grade_level, CAST(SKOLEAAR AS VARCHAR) AS school_year,
              CAST(CAST(GRUNDSKOLEKARAKTER AS FLOAT) AS DOUBLE) AS grade
       FROM {r_udfk}""",
)(lambda t: doubles(at.education_details_table(t["r_udfk"])))
check(
    "migration_table",
    """SELECT CAST(PNR AS VARCHAR) AS person_id, HAEND_DATO AS event_date, INDUD_KODE AS migration_code
       FROM {r_vnds}""",
)(lambda t: at.migration_table(t["r_vnds"]))
check(
    "medication_table",
    """SELECT CAST(PNR12 AS VARCHAR) AS person_id, ATC AS atc_code, EKSD AS prescription_date,
              CAST(CAST(VOLUMEN AS FLOAT) AS DOUBLE) AS volume, CAST(CAST(STYRKE AS FLOAT) AS DOUBLE) AS strength,
              CAST(PAKSTR AS INT) AS package_size
       FROM {r_lmdb}""",
)(lambda t: doubles(at.medication_table(t["r_lmdb"])))


@check(
    "healthcare_table",
    """SELECT CAST(a.RECNUM AS VARCHAR) AS event_id, CAST(a.PNR AS VARCHAR) AS person_id,
              a.D_INDDTO AS admission_date, a.D_UDDTO AS discharge_date, a.C_SPEC AS speciality,
              o.C_OPR AS procedure_code, o.D_ODTO AS procedure_date
       FROM {r_adm} a LEFT JOIN {r_opr} o ON a.RECNUM = o.RECNUM""",
)
def _(t):
    adm, opr = t["r_adm"], t["r_opr"]
    return at.healthcare_table(
        [adm.where(F.col("sector") == s) for s in ("F", "O", "P")],
        [opr.where("sector = 'F'"), opr.where("sector <> 'F'")],
    )


@check(
    "time_dimension",
    """SELECT d.date, CAST(year(d.date) AS INT) AS year, CAST(month(d.date) AS INT) AS month,
              CAST(quarter(d.date) AS INT) AS quarter, true AS is_pre_treatment,
              coalesce(n.n_admissions, 0) AS n_admissions
       FROM (SELECT CAST(unnest(range(lo, hi + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS date
             FROM (SELECT CAST(date_trunc('year', min(D_INDDTO)) AS TIMESTAMP) AS lo,
                          CAST(max(D_INDDTO) AS TIMESTAMP) AS hi FROM {r_adm})) d
       LEFT JOIN (SELECT D_INDDTO, count(*) AS n_admissions FROM {r_adm} GROUP BY D_INDDTO) n
         ON n.D_INDDTO = d.date""",
)
def _(t):
    adm = t["r_adm"]
    span = adm.agg(F.trunc(F.min("D_INDDTO"), "year").alias("first"), F.max("D_INDDTO").alias("last"))
    per_day = adm.groupBy(F.col("D_INDDTO").alias("date")).agg(F.count(F.lit(1)).alias("n_admissions"))
    return (
        at.calendar(span, "first", "last")
        .join(per_day, "date", "left")
        .fillna(0, ["n_admissions"])
    )


check(
    "socioeconomic_table",
    """SELECT CAST(FAMILIE_ID AS VARCHAR) AS family_id, CAST(year AS INT) AS year,
              SOCIO13 AS socioeconomic_status, PERINDKIALT_13 AS total_income FROM {r_indfam}""",
)(lambda t: at.socioeconomic_table(t["r_indfam"]))
check(
    "person_year_income",
    """SELECT CAST(PNR AS VARCHAR) AS person_id, CAST(year AS INT) AS year, PERINDKIALT_13 AS total_income
       FROM {r_ind}""",
)(lambda t: at.person_year_income(t["r_ind"]))


@check(
    "build_all_tables",
    """SELECT * FROM (
         SELECT 'Diagnosis' AS table_name, count(*) AS n_rows FROM {o_diagnosis}
         UNION ALL SELECT 'Healthcare', count(*) FROM {r_adm} a LEFT JOIN {r_opr} o ON a.RECNUM = o.RECNUM
         UNION ALL SELECT 'Child', count(*) FROM {o_child}
         UNION ALL SELECT 'Medication', count(*) FROM {r_lmdb}
         UNION ALL SELECT 'Employment', count(*)
           FROM {r_ind} FULL JOIN {r_idan} USING (PNR, year) FULL JOIN {r_akm} USING (PNR, year)
         UNION ALL SELECT 'Income', count(*) FROM {r_ind}
         UNION ALL SELECT 'Person', count(DISTINCT PNR) FROM {r_snapshot}
         UNION ALL SELECT 'Education', count(DISTINCT PNR) FROM {r_uddf}
         UNION ALL SELECT 'Birth', count(*) FROM {r_ftbarn}
         UNION ALL SELECT 'Disability', count(*) FROM {r_handic}
         UNION ALL SELECT 'EducationDetails', count(*) FROM {r_udfk}
         UNION ALL SELECT 'Migration', count(*) FROM {r_vnds}
         UNION ALL SELECT 'SocioEconomic', count(*) FROM {r_ind}
         UNION ALL SELECT 'TreatmentPeriod', count(*)
           FROM {o_diagnosis} d JOIN {o_child} c ON d.person_id = c.child_id
         UNION ALL SELECT 'PersonChild', count(*) FROM {r_snapshot} s JOIN {r_child} c ON s.PNR = c.child_id
         UNION ALL SELECT 'PersonFamily', count(*) FROM {r_snapshot} WHERE FAMILIE_ID IS NOT NULL)""",
)
def _(t):
    registers = {
        "LPR_DIAG": t["r_diag"], "LPR_ADM": t["r_adm"], "LPR_SKSOPR": t["r_opr"], "MFR": t["r_mfr"],
        "LMDB": t["r_lmdb"], "IND": t["r_ind"], "IDAN": t["r_idan"], "AKM": t["r_akm"],
        "BEF": t["r_snapshot"], "DOD": t["r_dod"], "DODSAARS": t["r_dodsaars"], "DODSAASG": t["r_dodsaasg"],
        "UDDF": t["r_uddf"], "FTBARN": t["r_ftbarn"], "HANDIC": t["r_handic"], "UDFK": t["r_udfk"],
        "VNDS": t["r_vnds"],
    }
    return at.row_counts(at.build_all_tables(registers))


# joins

check(
    "inner_join_recnum",
    """SELECT d.RECNUM, d.C_DIAG, a.PNR, a.D_INDDTO FROM {r_diag} d JOIN {r_adm} a ON d.RECNUM = a.RECNUM""",
)(lambda t: t["r_diag"].join(t["r_adm"], "RECNUM").select("RECNUM", "C_DIAG", "PNR", "D_INDDTO"))
check(
    "left_join_death",
    """SELECT s.PNR, s.year, d.DODDATO FROM {r_snapshot} s LEFT JOIN {r_dod} d ON s.PNR = d.PNR""",
)(lambda t: t["r_snapshot"].join(t["r_dod"], "PNR", "left").select("PNR", "year", "DODDATO"))
check(
    "full_outer_merge",
    """SELECT PNR, year, PERINDKIALT_13, ARBGNR, SOCIO
       FROM {r_ind} FULL JOIN {r_idan} USING (PNR, year) FULL JOIN {r_akm} USING (PNR, year)""",
)(
    lambda t: full_outer_merge([t["r_ind"], t["r_idan"], t["r_akm"]], ["PNR", "year"]).select(
        "PNR", "year", "PERINDKIALT_13", "ARBGNR", "SOCIO"
    )
)


@check(
    "left_join_then_filter",
    """SELECT c.child_id, d.diagnosis_code, d.diagnosis_date, CAST(d.diagnosis_date - c.birth_date AS INT) AS age_days
       FROM {o_diagnosis} d JOIN {o_child} c ON d.person_id = c.child_id
       WHERE d.diagnosis_date - c.birth_date <= 1825""",
)
def _(t):
    age = F.datediff("diagnosis_date", "birth_date")
    return (
        diagnosis(t).join(child(t), F.col("person_id") == F.col("child_id")).where(age <= 1825)
        .select("child_id", "diagnosis_code", "diagnosis_date", age.alias("age_days"))
    )


check("link_children_to_parents", "SELECT * FROM {o_links}")(
    lambda t: link_children_to_parents(child(t), at.person_table(t["r_snapshot"])).select(
        "child_id", "mother_id", "father_id"
    )
)


@check(
    "parental_income",
    "SELECT child_id, year, CAST(income AS DOUBLE) AS parental_total_income FROM {o_pincome}",
)
def _(t):
    links = link_children_to_parents(child(t), at.person_table(t["r_snapshot"]))
    return parental_income(at.person_year_income(t["r_ind"]), links).select(
        "child_id", "year", F.col("parental_total_income").cast("double").alias("parental_total_income")
    )


@check(
    "parent_education",
    """SELECT e.*,
              CASE WHEN m.HFAUDD IS NOT NULL AND m.HF_VFRA <= e.FOED_DAG THEN m.HFAUDD ELSE 'Unknown' END AS MOR_UDDANNELSE,
              CASE WHEN f.HFAUDD IS NOT NULL AND f.HF_VFRA <= e.FOED_DAG THEN f.HFAUDD ELSE 'Unknown' END AS FAR_UDDANNELSE
       FROM {o_eligible} e LEFT JOIN {o_latest} m ON e.MOR_ID = m.PNR LEFT JOIN {o_latest} f ON e.FAR_ID = f.PNR""",
)
def _(t):
    children = eligible_children(t["r_snapshot"], t["r_mfr"], 2000, 2018, 5)
    return parent_education(children, t["r_uddf"])


@check(
    "child_health_records",
    """SELECT m.CPR_BARN AS PNR, m.FOEDSELSDATO, a.RECNUM, d.C_DIAG, a.D_INDDTO
       FROM {r_mfr} m JOIN {r_adm} a ON m.CPR_BARN = a.PNR JOIN {r_diag} d ON a.RECNUM = d.RECNUM""",
)
def _(t):
    children = t["r_mfr"].select(F.col("CPR_BARN").alias("PNR"), "FOEDSELSDATO")
    return child_health_records(children, t["r_diag"], t["r_adm"]).select(
        "PNR", "FOEDSELSDATO", "RECNUM", "C_DIAG", "D_INDDTO"
    )


check(
    "icd_range_join",
    """SELECT d.RECNUM, d.l_linenumber, d.C_DIAG, r.grp FROM {r_diag} d JOIN {icd_range} r
       ON d.C_DIAG >= r.lo AND substr(d.C_DIAG, 1, length(r.hi)) <= r.hi""",
)(
    lambda t: icd_range_join(t["r_diag"], "C_DIAG", ranges(t)).select(
        "RECNUM", "l_linenumber", "C_DIAG", "grp"
    )
)
check(
    "icd_endpoint_match",
    """SELECT RECNUM, l_linenumber, C_DIAG FROM {r_diag} WHERE C_DIAG IN (SELECT code FROM {icd_point})""",
)(
    lambda t: has_code(
        t["r_diag"], "C_DIAG", endpoint_codes(severe_chronic_list(t.spark)).select("code")
    ).select("RECNUM", "l_linenumber", "C_DIAG")
)
check(
    "parse_icd_list",
    """SELECT RECNUM, trim(string_split(replace(i, '–', '-'), '-')[1]) AS lo,
              trim(string_split(replace(i, '–', '-'), '-')[-1]) AS hi
       FROM (SELECT RECNUM, unnest([C_DIAG, concat(C_DIAG, '-', substr(C_DIAG, 1, 1), '99.9'),
                                    concat(substr(C_DIAG, 1, 1), '00.0–', C_DIAG)]) AS i FROM {r_diag})""",
)(
    lambda t: parse_code_list(
        t["r_diag"].select(
            F.concat(
                "C_DIAG", F.lit("; "), "C_DIAG", F.lit("-"), F.substring("C_DIAG", 1, 1), F.lit("99.9 ;"),
                F.substring("C_DIAG", 1, 1), F.lit("00.0–"), "C_DIAG",
            ).alias("codes"),
            "RECNUM",
        ),
        grp="RECNUM",
    ).select(F.col("grp").alias("RECNUM"), "lo", "hi")
)
check(
    "person_child",
    """SELECT CAST(s.PNR AS VARCHAR) AS person_id, CAST(c.child_id AS VARCHAR) AS child_id,
              s.FM_MARK AS relationship_type
       FROM {r_snapshot} s JOIN {r_child} c ON s.PNR = c.child_id""",
)(lambda t: person_child(t["r_snapshot"], child(t)))
check(
    "person_family",
    """SELECT CAST(PNR AS VARCHAR) AS person_id, CAST(FAMILIE_ID AS VARCHAR) AS family_id, PLADS AS role
       FROM {r_bef} WHERE FAMILIE_ID IS NOT NULL""",
)(lambda t: person_family(t["r_bef"]))


@check(
    "exact_match",
    """SELECT p.birth_date, p.gender, p.family_id, p.child_id, e.index_date, count(*) AS n_exposed
       FROM (SELECT x.*, c.gender FROM {o_exposed} x JOIN {o_child} c ON x.child_id = c.child_id) e
       JOIN {o_child} p ON e.birth_date = p.birth_date AND e.gender = p.gender
       WHERE p.birth_date BETWEEN DATE '1995-01-01' AND DATE '2018-12-31' AND p.family_id IS NOT NULL
       GROUP BY ALL""",
)
def _(t):
    kids = child(t).select("child_id", "family_id", "birth_date", "gender")
    group = exposed(t).join(kids.select("child_id", "gender"), "child_id")
    return exact_match(group, unexposed_pool(kids), ["birth_date", "gender"])


@check(
    "family_asof",
    """SELECT q.event_id, q.PNR, q.day, h.FAMILIE_ID
       FROM (SELECT event_id, PNR, CAST(valid_from AS DATE) - 1 AS day FROM {r_history}) q
       ASOF LEFT JOIN (SELECT * FROM (
             SELECT PNR, CAST(valid_from AS DATE) AS day, FAMILIE_ID,
                    row_number() OVER (PARTITION BY PNR, CAST(valid_from AS DATE)
                                       ORDER BY valid_from DESC, event_id DESC) AS rn
             FROM {r_history}) WHERE rn = 1) h
         ON q.PNR = h.PNR AND q.day >= h.day""",
)
def _(t):
    history = t["r_history"].withColumn("changed", F.to_date("valid_from"))
    asked = history.select("event_id", "PNR", F.date_sub("changed", 1).alias("day"))
    return asof_join(asked, history, "PNR", "day", "changed", ["valid_from", "event_id"], ["FAMILIE_ID"])
