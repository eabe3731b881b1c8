"""Analysis tables over registers. An absent register is ``None``; missing columns are left out."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kohortflow.operators.aggregates import latest_per_key, null_first_desc
from kohortflow.operators.cohort import treatment_period
from kohortflow.operators.joins import full_outer_merge, merge_left, person_child, person_family
from kohortflow.operators.projection import require_columns, typed_projection
from kohortflow.sources.registers import union_registers

logger = logging.getLogger(__name__)

# Source column, target column, type.
PERSON = [
    ("PNR", "person_id", "string"),
    ("FOED_DAG", "birth_date", "date"),
    ("KOEN", "gender", "string"),
    ("KOM", "municipality_code", "string"),
    ("IE_TYPE", "origin_type", "string"),
    ("STATSB", "citizenship", "string"),
    ("OPR_LAND", "country_of_origin", "string"),
    ("BOP_VFRA", "residence_start_date", "date"),
    ("CIV_VFRA", "civil_status_date", "date"),
    ("CIVST", "civil_status", "string"),
    ("ALDER", "age", "int"),
    ("FAMILIE_ID", "family_id", "string"),
    ("PLADS", "family_role", "string"),
    ("MOR_ID", "mother_id", "string"),
    ("FAR_ID", "father_id", "string"),
    ("AEGTE_ID", "spouse_id", "string"),
    ("FAMILIE_TYPE", "family_type", "string"),
    ("ANTPERSF", "family_size", "int"),
    ("ANTBOERNF", "number_of_children", "int"),
    ("HUSTYPE", "household_type", "string"),
]
DEATH = [
    ("PNR", "person_id", "string"),
    ("DODDATO", "death_date", "date"),
    ("C_DODSMAADE", "death_manner", "string"),
    ("C_DOD1", "primary_cause", "string"),
    ("C_DOD2", "secondary_cause1", "string"),
    ("C_DOD3", "secondary_cause2", "string"),
    ("C_DOD4", "secondary_cause3", "string"),
    ("C_DODTILGRUNDL_ACME", "underlying_cause", "string"),
]
BIRTH = [
    ("PNR", "child_id", "string"),
    ("FOED_DAG", "birth_date", "date"),
    ("KOEN", "gender", "string"),
    ("VAEGT_BARN", "birth_weight", "float"),
    ("LAENGDE_BARN", "birth_length", "float"),
    ("MOR1", "mother_id", "string"),
    ("FAR1", "father_id", "string"),
    ("MOR_ALDER", "mother_age", "int"),
    ("FAR_ALDER", "father_age", "int"),
    ("FLERFOLD", "multiple_birth", "string"),
]
DISABILITY = [
    ("PNR", "person_id", "string"),
    ("FUNK_VURD", "functional_assessment", "string"),
    ("MAAL_KEY", "target_group_key", "string"),
    ("MODT_YDELSE_KODE", "service_code", "string"),
    ("YDELSE_START", "service_start_date", "date"),
    ("YDELSE_SLUT", "service_end_date", "date"),
]
CHILD = [
    ("CPR_BARN", "child_id", "string"),
    ("FAMILIE_ID", "family_id", "string"),
    ("FOEDSELSDATO", "birth_date", "date"),
    ("KOEN_BARN", "gender", "string"),
    ("VAEGT_BARN", "birth_weight", "float"),
    ("LAENGDE_BARN", "birth_length", "float"),
    ("GESTATIONSALDER_BARN", "gestational_age", "int"),
]
DIAGNOSIS = [
    ("RECNUM", "diagnosis_id", "string"),
    ("PNR", "person_id", "string"),
    ("C_DIAG", "diagnosis_code", "string"),
    ("C_DIAGTYPE", "diagnosis_type", "string"),
    ("D_INDDTO", "diagnosis_date", "date"),
    ("C_AFD", "hospital_department", "string"),
    ("C_SGH", "hospital_code", "string"),
    ("C_SPEC", "speciality", "string"),
    ("C_PATTYPE", "patient_type", "string"),
]
EMPLOYMENT = [
    ("PNR", "person_id", "string"),
    ("ARBGNR", "employer_id", "string"),
    ("ARBNR", "workplace_id", "string"),
    ("STILL", "job_type", "string"),
    ("SOCIO13", "socioeconomic_status", "string"),
    ("year", "year", "int"),
    ("JOBKAT", "job_category", "string"),
    ("JOBLON", "job_salary", "double"),
    ("CVRNR", "company_cvr", "string"),
    ("LOENMV_13", "wage_income", "double"),
    ("PERINDKIALT_13", "total_income", "double"),
]
EDUCATION = [
    ("PNR", "person_id", "string"),
    ("HFAUDD", "education_code", "string"),
    ("HF_VFRA", "education_start_date", "date"),
    ("HF_VTIL", "education_end_date", "date"),
    ("INSTNR", "institution_code", "string"),
    ("year", "data_year", "int"),
]
EDUCATION_DETAILS = [
    ("PNR", "person_id", "string"),
    ("FAGKODE", "subject_code", "string"),
    ("KLASSETYPE", "class_type", "string"),
    ("KLTRIN", "grade_level", "string"),
    ("SKOLEAAR", "school_year", "string"),
    ("GRUNDSKOLEKARAKTER", "grade", "float"),
]
MIGRATION = [
    ("PNR", "person_id", "string"),
    ("HAEND_DATO", "event_date", "date"),
    ("INDUD_KODE", "migration_code", "string"),
]
MEDICATION = [
    ("PNR12", "person_id", "string"),
    ("ATC", "atc_code", "string"),
    ("EKSD", "prescription_date", "date"),
    ("VOLUMEN", "volume", "float"),
    ("STYRKE", "strength", "float"),
    ("PAKSTR", "package_size", "int"),
]
HEALTHCARE = [
    ("RECNUM", "event_id", "string"),
    ("PNR", "person_id", "string"),
    ("D_INDDTO", "admission_date", "date"),
    ("D_UDDTO", "discharge_date", "date"),
    ("C_PATTYPE", "patient_type", "string"),
    ("C_KONTAARS", "contact_reason", "string"),
    ("C_SPEC", "speciality", "string"),
    ("V_SENGDAGE", "bed_days", "int"),
    ("C_SGH", "hospital_code", "string"),
    ("C_AFD", "department_code", "string"),
    ("C_OPR", "procedure_code", "string"),
    ("D_ODTO", "procedure_date", "date"),
]
SOCIOECONOMIC = [
    ("FAMILIE_ID", "family_id", "string"),
    ("year", "year", "int"),
    ("SOCIO13", "socioeconomic_status", "string"),
    ("PERINDKIALT_13", "total_income", "double"),
]
PERSON_YEAR_INCOME = [
    ("PNR", "person_id", "string"),
    ("year", "year", "int"),
    ("PERINDKIALT_13", "total_income", "double"),
    ("LOENMV_13", "wage_income", "double"),
    ("ERHVERVSINDK_13", "business_income", "double"),
]


def death_table(dod: DataFrame, dodsaars: DataFrame, dodsaasg: DataFrame) -> DataFrame | None:
    """The three death registers merged on the person, later registers filling what earlier ones lack."""
    columns = {source for source, _, _ in DEATH}
    registers = [d.select(*[c for c in d.columns if c in columns]) for d in (dod, dodsaars, dodsaasg)]
    return typed_projection(full_outer_merge(registers, ["PNR"]), DEATH, "Death")


def person_table(
    bef: DataFrame | None,
    dod: DataFrame | None = None,
    dodsaars: DataFrame | None = None,
    dodsaasg: DataFrame | None = None,
    all_snapshots: bool = False,
) -> DataFrame | None:
    """Persons with death data, if all three death registers are there.

    The register is a yearly or monthly snapshot: the last one of each person is kept, or every one on request,
    with its year as ``snapshot_year``.
    """
    if bef is None:
        return None
    columns = list(PERSON)
    if "year" in bef.columns:
        columns.append(("year", "snapshot_year", "int"))
        wanted = [s for s, _, _ in columns if s in bef.columns]
        period = [c for c in ("year", "month") if c in bef.columns]
        bef = bef.select(*wanted, *period[1:])
        if not all_snapshots:
            rest = [c for c in wanted if c not in ("PNR", "year")]
            bef = latest_per_key(bef, ["PNR"], [F.col(c) for c in (*period, *rest)], wanted)
    persons = typed_projection(bef, columns, "BEF")
    if persons is None or dod is None or dodsaars is None or dodsaasg is None:
        return persons
    # Left joins one by one give the rows of a left join with the fully merged registers: what only a death
    # register has drops out anyway. All sides are partitioned by person.
    for register in (dod, dodsaars, dodsaasg):
        persons = merge_left(persons, typed_projection(register, DEATH, "Death"), ["person_id"])
    return persons


def birth_table(ftbarn: DataFrame | None) -> DataFrame | None:
    return typed_projection(ftbarn, BIRTH, "FTBARN")


def disability_table(handic: DataFrame | None) -> DataFrame | None:
    return typed_projection(handic, DISABILITY, "HANDIC")


def child_table(mfr: DataFrame | None) -> DataFrame | None:
    if mfr is None:
        logger.error("MFR is missing, no child table")
    return typed_projection(mfr, CHILD, "MFR")


def diagnosis_table(
    sectors: list[tuple[DataFrame | None, DataFrame | None]],
    only: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame | None:
    """Diagnoses with their admission, for each (diagnosis, admission) pair of registers that both exist.

    Only the needed columns enter the joins. ``only`` filters the diagnosis registers before them, which keeps
    the rows outside a code list out of the shuffle on the contact number.
    """
    wanted = [source for source, _, _ in DIAGNOSIS]
    joined = []
    for diag, adm in sectors:
        if diag is None or adm is None:
            continue
        left = diag.select(*[c for c in wanted if c in diag.columns])
        left = left if only is None else only(left)
        right = adm.select(
            "RECNUM", *[c for c in wanted if c in adm.columns and c not in left.columns]
        )
        joined.append(left.join(right, "RECNUM"))
    if not joined:
        logger.warning("no diagnosis register with its admissions")
        return None
    return typed_projection(union_registers(joined), DIAGNOSIS, "Diagnosis")


def healthcare_table(
    admissions: list[DataFrame | None], procedures: list[DataFrame | None]
) -> DataFrame | None:
    """Admissions of all sectors, with the procedures of all sectors joined once."""
    present = [a for a in admissions if a is not None]
    if not present:
        logger.warning("no admission register")
        return None
    wanted = [source for source, _, _ in HEALTHCARE]
    events = union_registers([a.select(*[c for c in wanted if c in a.columns]) for a in present])
    done = [p for p in procedures if p is not None]
    if done:
        extra = ["RECNUM", "C_OPR", "D_ODTO"]
        done_all = union_registers([p.select(*[c for c in extra if c in p.columns]) for p in done])
        events = events.drop("C_OPR", "D_ODTO").join(done_all, "RECNUM", "left")
    return typed_projection(events, HEALTHCARE, "Healthcare")


def employment_table(
    ind: DataFrame | None, idan: DataFrame | None, akm: DataFrame | None
) -> DataFrame | None:
    """Income, employment and status registers merged per person and year."""
    if ind is None or idan is None or akm is None:
        logger.warning("employment needs IND, IDAN and AKM")
        return None
    wanted = [source for source, _, _ in EMPLOYMENT]
    registers = [r.select(*[c for c in wanted if c in r.columns]) for r in (ind, idan, akm)]
    return typed_projection(full_outer_merge(registers, ["PNR", "year"]), EMPLOYMENT, "Employment")


def education_table(uddf: DataFrame | None) -> DataFrame | None:
    """Latest education per person: an open end date first, then end, start and institution descending."""
    table = typed_projection(uddf, EDUCATION, "UDDF")
    if table is None or "education_end_date" not in table.columns:
        return table
    order = null_first_desc("education_end_date")
    order += [F.col(c) for c in ("education_start_date", "institution_code") if c in table.columns]
    return latest_per_key(table, ["person_id"], order)


def education_details_table(udfk: DataFrame | None) -> DataFrame | None:
    return typed_projection(udfk, EDUCATION_DETAILS, "UDFK")


def migration_table(vnds: DataFrame | None) -> DataFrame | None:
    return typed_projection(vnds, MIGRATION, "VNDS")


def medication_table(lmdb: DataFrame | None) -> DataFrame | None:
    return typed_projection(lmdb, MEDICATION, "LMDB")


def socioeconomic_table(ind: DataFrame | None) -> DataFrame | None:
    return typed_projection(ind, SOCIOECONOMIC, "IND")


def person_year_income(ind: DataFrame | None) -> DataFrame | None:
    return typed_projection(ind, PERSON_YEAR_INCOME, "IND")


def calendar(span: DataFrame, start: str, end: str) -> DataFrame:
    """One row per day between two date columns of a one-row table: date, year, month, quarter."""
    days = span.select(F.explode(F.sequence(F.col(start), F.col(end))).alias("date"))
    return days.select(
        "date",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.quarter("date").alias("quarter"),
        F.lit(True).alias("is_pre_treatment"),
    )


def time_dimension(spark: SparkSession, start_year: int, end_year: int) -> DataFrame:
    """Calendar of whole years."""
    span = spark.range(1).select(
        F.make_date(F.lit(start_year), F.lit(1), F.lit(1)).alias("first"),
        F.make_date(F.lit(end_year), F.lit(12), F.lit(31)).alias("last"),
    )
    return calendar(span, "first", "last")


def build_all_tables(registers: Mapping[str, DataFrame | None]) -> dict[str, DataFrame]:
    """All analysis tables whose registers are there, as lazy DataFrames."""
    get = registers.get
    bef = get("BEF")
    child = child_table(get("MFR")) if get("MFR") is not None else None
    diagnosis = diagnosis_table(
        [
            (get("LPR_DIAG"), get("LPR_ADM")),
            (get("PRIV_DIAG"), get("PRIV_ADM")),
            (get("PSYK_DIAG"), get("PSYK_ADM")),
        ]
    )
    tables = {
        "Diagnosis": diagnosis,
        "Healthcare": healthcare_table(
            [get("LPR_ADM"), get("PRIV_ADM"), get("PSYK_ADM")], [get("LPR_SKSOPR"), get("PRIV_SKSOPR")]
        ),
        "Child": child,
        "Medication": medication_table(get("LMDB")),
        "Employment": employment_table(get("IND"), get("IDAN"), get("AKM")),
        "Income": person_year_income(get("IND")),
        "Person": person_table(bef, get("DOD"), get("DODSAARS"), get("DODSAASG")),
        "Education": education_table(get("UDDF")),
        "Birth": birth_table(get("FTBARN")),
        "Disability": disability_table(get("HANDIC")),
        "EducationDetails": education_details_table(get("UDFK")),
        "Migration": migration_table(get("VNDS")),
        "SocioEconomic": socioeconomic_table(get("IND")),
    }
    if diagnosis is not None and child is not None:
        require_columns(diagnosis, ["person_id", "diagnosis_date"], "Diagnosis")
        if "family_id" in child.columns:
            tables["TreatmentPeriod"] = treatment_period(diagnosis, child)
    if bef is not None and child is not None and "FM_MARK" in bef.columns:
        tables["PersonChild"] = person_child(bef, child)
    if bef is not None and {"FAMILIE_ID", "PLADS"} <= set(bef.columns):
        tables["PersonFamily"] = person_family(bef)
    return {name: df for name, df in tables.items() if df is not None}


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, n_rows)`` per table."""
    rows = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)
