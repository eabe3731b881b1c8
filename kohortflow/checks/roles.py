"""Register roles for the given test tables.

The test tables hold no registers; each role below is a projection of them in the shape of a register. The
text is valid in Spark SQL and in DuckDB, so the checks and their reference SQL start from the same rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from kohortflow.functions.codes import SEVERE_CHRONIC
from kohortflow.session import tuned

ROLES = {
    "r_child": """
        SELECT c_custkey AS child_id,
               CAST(floor(c_custkey / 3) AS BIGINT) AS family_id,
               DATE '1990-01-01' + CAST((c_custkey * 37) % 300 * 36 AS INT) AS birth_date,
               CASE WHEN c_custkey % 2 = 0 THEN 'K' ELSE 'M' END AS gender,
               c_nationkey AS municipality_code,
               c_acctbal AS birth_weight,
               c_custkey - c_custkey % 10 AS mother_id,
               c_custkey - c_custkey % 10 + 1 AS father_id
        FROM {customer}""",
    "r_bef": """
        SELECT o_custkey AS PNR, CAST(year(o_orderdate) AS INT) AS year,
               max(o_orderstatus) AS CIVST, max(o_orderpriority) AS PLADS,
               CAST(floor(o_custkey / 3) AS BIGINT) AS FAMILIE_ID,
               CAST(count(*) AS INT) AS ANTPERSF,
               o_custkey - o_custkey % 10 AS MOR_ID,
               o_custkey - o_custkey % 10 + 1 AS FAR_ID
        FROM {orders} GROUP BY o_custkey, year(o_orderdate)""",
    "r_adm": """
        SELECT o_orderkey AS RECNUM, o_custkey AS PNR,
               CAST(o_orderdate AS DATE) AS D_INDDTO,
               CAST(o_orderdate AS DATE) + CAST(o_orderkey % 12 AS INT) AS D_UDDTO,
               o_orderstatus AS sector,
               o_orderpriority AS C_SPEC
        FROM {orders}""",
    "r_diag": """
        SELECT l_orderkey AS RECNUM,
               concat(substr('CDEGIJKMNPQ', CAST(l_partkey % 11 AS INT) + 1, 1),
                      lpad(CAST((l_suppkey * 7 + l_linenumber) % 100 AS STRING), 2, '0'),
                      CASE WHEN l_linenumber = 1 THEN ''
                           ELSE concat('.', CAST(l_partkey % 10 AS STRING)) END) AS C_DIAG,
               l_returnflag AS C_DIAGTYPE, l_linenumber
        FROM {lineitem}""",
    "r_opr": """
        SELECT l_orderkey AS RECNUM, concat('O', CAST(l_partkey AS STRING)) AS C_OPR,
               CAST(l_shipdate AS DATE) AS D_ODTO, l_linestatus AS sector
        FROM {lineitem}""",
    "r_ind": """
        SELECT o_custkey AS PNR, CAST(year(o_orderdate) AS INT) AS year,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS PERINDKIALT_13,
               max(o_orderpriority) AS SOCIO13
        FROM {orders} GROUP BY o_custkey, year(o_orderdate)""",
    "r_idan": """
        SELECT o_custkey AS PNR, CAST(year(o_orderdate) AS INT) AS year, o_orderkey AS ARBGNR,
               o_totalprice AS JOBLON
        FROM {orders} WHERE o_orderstatus = 'F'""",
    "r_akm": """
        SELECT DISTINCT o_custkey AS PNR, CAST(year(o_orderdate) + 1 AS INT) AS year, o_orderpriority AS SOCIO
        FROM {orders} WHERE o_orderstatus = 'P'""",
    "r_uddf": """
        SELECT o_custkey AS PNR, substr(o_orderpriority, 1, 1) AS HFAUDD,
               CAST(o_orderdate AS DATE) AS HF_VFRA,
               CASE WHEN o_orderstatus = 'O' THEN NULL
                    ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 1000 AS INT) END AS HF_VTIL,
               o_orderkey AS INSTNR
        FROM {orders}""",
    "r_history": """
        SELECT user_id AS PNR, ts AS valid_from, event_type AS FAMILIE_ID, event_id
        FROM {events}""",
    "r_snapshot": """
        SELECT b.PNR, b.year, c.birth_date AS FOED_DAG, c.gender AS KOEN,
               CAST(b.year - year(c.birth_date) AS INT) AS ALDER,
               b.FAMILIE_ID, b.PLADS, b.CIVST, b.ANTPERSF, b.MOR_ID, b.FAR_ID, b.PLADS AS FM_MARK
        FROM {r_bef} b JOIN {r_child} c ON b.PNR = c.child_id""",
    "r_mfr": """
        SELECT child_id AS CPR_BARN, family_id AS FAMILIE_ID, birth_date AS FOEDSELSDATO,
               gender AS KOEN_BARN, birth_weight AS VAEGT_BARN,
               CAST(20 + child_id % 25 AS INT) AS GESTATIONSALDER_BARN
        FROM {r_child}""",
    "r_dod": """
        SELECT o_custkey AS PNR, CAST(max(o_orderdate) AS DATE) AS DODDATO
        FROM {orders} WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' GROUP BY o_custkey""",
    "r_dodsaars": """
        SELECT o_custkey AS PNR, max(concat('A', CAST(o_orderkey AS STRING))) AS C_DOD1,
               CAST(count(*) AS STRING) AS C_DODSMAADE
        FROM {orders} WHERE o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' GROUP BY o_custkey""",
    "r_dodsaasg": """
        SELECT o_custkey AS PNR, max(concat('E', CAST(o_orderkey AS STRING))) AS C_DODTILGRUNDL_ACME
        FROM {orders} WHERE o_orderstatus = 'O' AND o_orderpriority = '3-MEDIUM' GROUP BY o_custkey""",
    "r_lmdb": """
        SELECT l_suppkey AS PNR12, concat('A', CAST(l_partkey AS STRING)) AS ATC,
               CAST(l_shipdate AS DATE) AS EKSD, l_quantity AS VOLUMEN, l_tax AS STYRKE,
               l_linenumber AS PAKSTR
        FROM {lineitem}""",
    "r_vnds": """
        SELECT user_id AS PNR, CAST(ts AS DATE) AS HAEND_DATO, event_type AS INDUD_KODE
        FROM {events}""",
    "r_udfk": """
        SELECT l_orderkey AS PNR, concat('FAG', CAST(l_partkey AS STRING)) AS FAGKODE,
               l_returnflag AS KLASSETYPE, l_linenumber AS KLTRIN,
               CAST(year(l_shipdate) AS INT) AS SKOLEAAR, l_quantity AS GRUNDSKOLEKARAKTER
        FROM {lineitem}""",
    "r_handic": """
        SELECT PNR, sector AS FUNK_VURD, RECNUM AS MAAL_KEY, C_SPEC AS MODT_YDELSE_KODE,
               D_INDDTO AS YDELSE_START, D_UDDTO AS YDELSE_SLUT
        FROM {r_adm}""",
    "r_ftbarn": """
        SELECT child_id AS PNR, birth_date AS FOED_DAG, gender AS KOEN, birth_weight AS VAEGT_BARN,
               mother_id AS MOR1, father_id AS FAR1, CAST(15 + child_id % 30 AS INT) AS MOR_ALDER
        FROM {r_child}""",
    "r_indfam": """
        SELECT i.*, CAST(floor(i.PNR / 3) AS BIGINT) AS FAMILIE_ID
        FROM {r_ind} i""",
    "r_number": """
        SELECT child_id, birth_date, gender,
               concat(lpad(CAST(CASE WHEN child_id % 11 = 0 THEN 31 - day(birth_date)
                                     ELSE day(birth_date) END AS STRING), 2, '0'),
                      lpad(CAST(month(birth_date) AS STRING), 2, '0'),
                      lpad(CAST(year(birth_date) % 100 AS STRING), 2, '0'),
                      '-', CAST(child_id % 10 AS STRING),
                      lpad(CAST(child_id % 997 AS STRING), 3, '0')) AS number
        FROM {r_child}""",
}

# Steps shared by several reference queries, in DuckDB SQL only.
STEPS = {
    "icd_list": "SELECT * FROM (VALUES "
    + ", ".join(f"('{codes}', '{grp}')" for codes, grp in SEVERE_CHRONIC)
    + ") AS t(codes, grp)",
    "icd_item": "SELECT trim(i) AS item, grp FROM (SELECT unnest(string_split(codes, ';')) AS i, grp FROM {icd_list})",
    "icd_range": """
        SELECT trim(string_split(x, '-')[1]) AS lo, trim(string_split(x, '-')[-1]) AS hi, grp
        FROM (SELECT replace(item, '–', '-') AS x, grp FROM {icd_item})""",
    "icd_point": "SELECT DISTINCT unnest(string_split(item, '-')) AS code FROM {icd_item}",
    "o_child": """
        SELECT CAST(child_id AS VARCHAR) AS child_id, CAST(family_id AS VARCHAR) AS family_id, birth_date,
               gender, CAST(CAST(birth_weight AS FLOAT) AS DOUBLE) AS birth_weight,
               CAST(20 + child_id % 25 AS INT) AS gestational_age
        FROM {r_child}""",
    "o_diagnosis": """
        SELECT CAST(d.RECNUM AS VARCHAR) AS diagnosis_id, CAST(a.PNR AS VARCHAR) AS person_id,
               d.C_DIAG AS diagnosis_code, d.C_DIAGTYPE AS diagnosis_type, a.D_INDDTO AS diagnosis_date,
               a.C_SPEC AS speciality
        FROM {r_diag} d JOIN {r_adm} a ON d.RECNUM = a.RECNUM""",
    "o_cases": """
        SELECT * FROM {o_diagnosis} x
        WHERE diagnosis_date BETWEEN DATE '2000-01-01' AND DATE '2018-12-31'
          AND EXISTS (SELECT 1 FROM {icd_range} r WHERE x.diagnosis_code >= r.lo
                      AND substr(x.diagnosis_code, 1, length(r.hi)) <= r.hi)""",
    "o_exposed": """
        SELECT DISTINCT c.child_id, c.family_id, c.birth_date, x.diagnosis_date AS index_date
        FROM {o_cases} x JOIN {o_child} c ON x.person_id = c.child_id
        WHERE x.diagnosis_date - c.birth_date <= 1825""",
    "o_first": """
        SELECT child_id, family_id, birth_date, min(index_date) AS index_date
        FROM {o_exposed} GROUP BY ALL""",
    "o_pool": """
        SELECT DISTINCT family_id, child_id, birth_date FROM {o_child}
        WHERE birth_date BETWEEN DATE '1995-01-01' AND DATE '2018-12-31'""",
    "o_person": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY PNR ORDER BY year DESC) AS rn FROM {r_snapshot})
        WHERE rn = 1""",
    "o_links": """
        SELECT c.child_id, CAST(p.MOR_ID AS VARCHAR) AS mother_id, CAST(p.FAR_ID AS VARCHAR) AS father_id
        FROM {o_child} c JOIN {o_person} p ON c.child_id = CAST(p.PNR AS VARCHAR)""",
    "o_pincome": """
        SELECT l.child_id, i.year, sum(CAST(i.PERINDKIALT_13 AS DECIMAL(18,2))) AS income
        FROM (SELECT child_id, mother_id AS parent_id FROM {o_links}
              UNION SELECT child_id, father_id FROM {o_links}) l
        JOIN {r_ind} i ON l.parent_id = CAST(i.PNR AS VARCHAR)
        GROUP BY l.child_id, i.year""",
    "o_latest": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY PNR ORDER BY HF_VFRA DESC NULLS FIRST, HFAUDD DESC) AS rn
            FROM {r_uddf}) WHERE rn = 1""",
    "o_eligible": """
        SELECT s.PNR, s.FOED_DAG, s.KOEN, s.MOR_ID, s.FAR_ID
        FROM {r_snapshot} s JOIN {r_mfr} m ON s.PNR = m.CPR_BARN
        WHERE year(s.FOED_DAG) BETWEEN 1995 AND 2018
          AND year(s.FOED_DAG) + s.ALDER BETWEEN 2000 AND 2018""",
}


NAME = re.compile(r"\{(\w+)\}")


class Tables:
    """The test tables of one folder and the roles over them, all lazy."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = tuned(spark), folder
        self._known: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._known:
            self._known[name] = (
                self.sql(ROLES[name])
                if name in ROLES
                else self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            )
        return self._known[name]

    def sql(self, text: str) -> DataFrame:
        """Run SQL whose ``{name}`` are tables or roles."""
        return self.spark.sql(text, **{name: self[name] for name in set(NAME.findall(text))})


def with_steps(sql: str) -> str:
    """DuckDB text: the roles and steps ``sql`` names in braces become CTEs in front of it."""
    texts = {**ROLES, **STEPS}
    order: list[str] = []

    def visit(text: str) -> None:
        for name in NAME.findall(text):
            if name in texts and name not in order:
                visit(texts[name])
                order.append(name)

    visit(sql)
    plain = {name: NAME.sub(r"\1", texts[name]).strip() for name in order}
    body = NAME.sub(r"\1", sql).strip()
    if not plain:
        return body
    ctes = ", ".join(f"{name} AS ({text})" for name, text in plain.items())
    if body.upper().startswith("WITH "):
        return f"WITH {ctes}, {body[5:]}"
    return f"WITH {ctes} {body}"
