"""The two studies: parental income and parental education of exposed and unexposed children."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kohortflow.functions.codes import in_code_ranges, mark_code_ranges
from kohortflow.functions.exprs import known_at
from kohortflow.operators.aggregates import mean_by_year
from kohortflow.operators.cohort import (
    exact_match,
    exposed_group,
    exposure_weights,
    severe_chronic_cases,
    unexposed_pool,
)
from kohortflow.operators.joins import link_children_to_parents, link_parent_education, parental_income
from kohortflow.operators.projection import eligible_children, require_columns
from kohortflow.plans.tables import child_table, diagnosis_table, person_table, person_year_income


def create_cohorts(
    tables: Mapping[str, DataFrame], codes: DataFrame, mode: str = "range"
) -> tuple[DataFrame, DataFrame]:
    """Exposed children and their matched unexposed children (with the number of exposed rows each stands for)."""
    cases = severe_chronic_cases(tables["Diagnosis"], codes, mode)
    exposed = exposed_group(cases, tables["Child"])
    return exposed, exact_match(exposed, unexposed_pool(tables["Child"].select("family_id", "child_id", "birth_date")))


def income_comparison(tables: Mapping[str, DataFrame], codes: DataFrame, mode: str = "range") -> DataFrame:
    """Mean parental income by year, exposed against matched unexposed children.

    The cohorts enter as two counts per child instead of matched pairs, and ride along on the parent links, so
    income is joined once and only for children in a cohort, and both means come from one aggregation.
    """
    cases = severe_chronic_cases(tables["Diagnosis"], codes, mode)
    child = tables["Child"].select("child_id", "family_id", "birth_date")
    weights = exposure_weights(exposed_group(cases, child), unexposed_pool(child))
    links = link_children_to_parents(weights, tables["Person"])
    income = parental_income(tables["Income"], links, "w_exposed", "w_unexposed")
    means = mean_by_year(
        income,
        "parental_total_income",
        {"avg_income_exposed": "w_exposed", "avg_income_unexposed": "w_unexposed"},
    )
    return means.where(F.col("avg_income_exposed").isNotNull() & F.col("avg_income_unexposed").isNotNull())


def income_study(registers: Mapping[str, DataFrame | None], codes: DataFrame) -> DataFrame:
    """:func:`income_comparison` from the registers, cut to what it needs before any join.

    Diagnoses are filtered by code before they meet their admissions, and the population snapshots carry only
    the parents into the reduction to one row per person.
    """
    get = registers.get
    sectors = [(get(f"{s}_DIAG"), get(f"{s}_ADM")) for s in ("LPR", "PRIV", "PSYK")]
    bef = require_columns(get("BEF"), ["PNR", "MOR_ID", "FAR_ID"], "BEF")
    tables = {
        "Diagnosis": diagnosis_table(sectors, lambda d: in_code_ranges(d, "C_DIAG", codes)),
        "Child": child_table(get("MFR")),
        "Person": person_table(bef.select("PNR", "MOR_ID", "FAR_ID", *[c for c in ("year", "month") if c in bef.columns])),
        "Income": person_year_income(get("IND")),
    }
    missing = [name for name, df in tables.items() if df is None]
    if missing:
        raise ValueError(f"no registers for {', '.join(missing)}")
    return income_comparison(tables, codes, mode="any")


def latest_education(uddf: DataFrame) -> DataFrame:
    """Education with the latest start date per person, an unknown start first, then the highest code."""
    order = F.struct(F.col("HF_VFRA").isNull().cast("int"), F.col("HF_VFRA"), F.col("HFAUDD"))
    best = F.max_by(F.struct("HFAUDD", "HF_VFRA"), order).alias("b")
    return uddf.groupBy("PNR").agg(best).select("PNR", "b.HFAUDD", "b.HF_VFRA")


def parent_education(children: DataFrame, uddf: DataFrame) -> DataFrame:
    """Children with the education their mother and father had at the child's birth."""
    education = latest_education(uddf)
    with_mother = link_parent_education(children, education, "MOR_ID", "MOR_UDDANNELSE", known_at)
    return link_parent_education(with_mother, education, "FAR_ID", "FAR_UDDANNELSE", known_at)


def child_health_records(children: DataFrame, diag: DataFrame, adm: DataFrame) -> DataFrame:
    """Children with the diagnoses of their admissions.

    Admissions meet the children first, so the diagnoses, the largest table, are shuffled once only.
    """
    return children.join(adm, "PNR").join(diag, "RECNUM")


def _record_groups(diag: DataFrame, adm: DataFrame, codes: DataFrame) -> DataFrame:
    """Per person with records: are some ``inside`` the code list, some ``outside``? One scan of the records.

    Only which codes a contact has matters, so those are reduced before the admissions.
    """
    marked = mark_code_ranges(diag.select("RECNUM", "C_DIAG").where(F.col("C_DIAG").isNotNull()), "C_DIAG", codes, "hit")
    contacts = marked.groupBy("RECNUM").agg(F.bool_or("hit").alias("inside"), F.bool_or(~F.col("hit")).alias("outside"))
    persons = contacts.join(adm.select("RECNUM", "PNR"), "RECNUM")
    return persons.groupBy("PNR").agg(F.bool_or("inside").alias("inside"), F.bool_or("outside").alias("outside"))


def education_rows(
    bef: DataFrame,
    mfr: DataFrame,
    diag: DataFrame,
    adm: DataFrame,
    uddf: DataFrame,
    codes: DataFrame,
    start_year: int,
    end_year: int,
    max_age: int,
) -> DataFrame:
    """Eligible children with records, with both parents' education, by ``cohort``: exposed or unexposed records.

    A child with records of both kinds is in both cohorts.
    """
    children = parent_education(eligible_children(bef, mfr, start_year, end_year, max_age), uddf)
    kinds = F.array_compact(F.array(F.when(F.col("inside"), "exposed"), F.when(F.col("outside"), "unexposed")))
    return children.join(_record_groups(diag, adm, codes), "PNR").withColumn("cohort", F.explode(kinds)).drop("inside", "outside")


def education_cohort(
    bef: DataFrame,
    mfr: DataFrame,
    diag: DataFrame,
    adm: DataFrame,
    codes: DataFrame,
    start_year: int,
    end_year: int,
    max_age: int,
) -> DataFrame:
    """Distinct persons among eligible children and in the exposed and unexposed record groups.

    The rows themselves, with the parents' education, are ``education_rows``.
    """
    children = eligible_children(bef, mfr, start_year, end_year, max_age).select("PNR").distinct()
    persons = _record_groups(diag, adm, codes)
    counts = children.join(persons, "PNR", "left").agg(
        F.count(F.lit(1)).alias("eligible"),
        F.count_if("inside").alias("exposed"),
        F.count_if("outside").alias("unexposed"),
    )
    cells = [F.struct(F.lit(c).alias("cohort"), F.col(c).alias("n_persons")) for c in counts.columns]
    return counts.select(F.inline(F.array(*cells)))
