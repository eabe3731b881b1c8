"""ICD-10 code lists: parsing, range matching and end-point matching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The severe chronic disease list (codes or ranges, diagnosis group). Some ranges are written
# with an en dash.
SEVERE_CHRONIC = [
    ("C00.0-C99.1", "Malignant neoplasms"),
    ("D61.0; D61.3; D61.8-D61.9", "Aplastic anaemias"),
    ("D76.2", "Haemophagocytic syndrome, infection-associated"),
    ("D80.0-D82.9", "Immunodeficiencies"),
    ("E10", "Insulin-dependent diabetes mellitus"),
    ("E25", "Adrenogenital disorders"),
    ("E70.0-E73.0", "Disorders of amino-acid metabolism"),
    ("E74.0-E84.9", "Disorders of metabolism and cystic fibrosis"),
    ("G12", "Spinal muscular atrophy and related syndromes"),
    ("G31.0; G31.8–G31.9; G37.0–G37.9", "Degenerative and demyelinating diseases of nervous system"),
    ("G40", "Epilepsy"),
    ("G60", "Hereditary and idiopathic neuropathy"),
    ("G70.2", "Congenital and developmental myasthenia"),
    ("G71.0-G71.3", "Mitochondrial myopathy"),
    ("G73.6", "Myopathy in metabolic diseases"),
    ("G80", "Cerebral palsy"),
    ("G81.1; G82.1; G82.4", "Spastic conditions"),
    ("G91", "Hydrocephalus"),
    ("G94.1", "Hydrocephalus in neoplastic disease"),
    ("I12", "Hypertensive renal disease without renal failure"),
    ("I27.0-I27.9", "Pulmonary heart disease"),
    ("I30.0-I52.8", "Other forms of heart disease"),
    ("J44.8", "Other specified chronic obstructive pulmonary disease"),
    ("J84", "Other interstitial pulmonary diseases"),
    ("K21", "Gastro-oesophageal reflux disease"),
    ("K50.0–K51.9", "Crohn disease [regional enteritis] and ulcerative colitis"),
    ("K70.0-K77.8", "Diseases of liver"),
    ("K90", "Intestinal malabsorption"),
    ("M30.0-M35.9", "Systemic involvement of connective tissue"),
    ("N03-N05", "Nephritic syndrome"),
    ("N07", "Hereditary nephropathy, not elsewhere classified"),
    ("N13", "Obstructive and reflux uropathy"),
    ("N18.0-N19.9; N25.0-N27.9", "Chronic kidney disease"),
    ("P27", "Chronic respiratory disease originating in the perinatal period"),
    ("P57.0-P57.9", "Kernicterus"),
    ("P91.0-P91.2", "Disturbances of cerebral status of newborn"),
    ("P94.1-P94.9", "Disorders of muscle tone of newborn"),
    ("Q01-Q07", "Congenital malformations of the nervous system"),
    ("Q20.0-Q26.9", "Congenital malformations of the circulatory system"),
    ("Q30.0-Q32.4", "Congenital malformations of nose, larynx, trachea and bronchus"),
    ("Q33.0-Q33.9", "Congenital malformations of lung"),
    ("Q34.0-Q37.9", "Other congenital malformations of respiratory system, cleft lip and cleft palate"),
    ("Q39.0-Q45.3", "Congenital malformations of upper alimentary tract, intestine and pancreas"),
    ("Q60.0-Q64.9", "Congenital malformations of the urinary system"),
    ("Q79.0", "Congenital diaphragmatic hernia"),
    ("Q79.2-Q79.3", "Exomphalos and gastroschisis"),
    ("Q86.0", "Fetal alcohol syndrome (dysmorphic)"),
    ("Q87", "Other specified congenital malformation syndromes affecting multiple systems"),
    ("Q90.0-Q99.9", "Chromosomal abnormalities, not elsewhere classified"),
]

EN_DASH = "–"


def severe_chronic_list(spark: SparkSession) -> DataFrame:
    """The built-in list ``(codes, grp)``, as literal rows so that its size is known to the planner."""
    rows = ", ".join(f"('{codes}', '{grp}')" for codes, grp in SEVERE_CHRONIC)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(codes, grp)")


def _items(lists: DataFrame, codes: str, grp: str) -> DataFrame:
    item = F.explode(F.split(codes, ";")).alias("item")
    return lists.select(F.col(grp).alias("grp"), item).select("grp", F.upper(F.trim("item")).alias("item"))


def parse_code_list(lists: DataFrame, codes: str = "codes", grp: str = "grp") -> DataFrame:
    """``"D61.0; D61.8-D61.9"`` -> rows ``(lo, hi, grp)``; a single code has ``lo = hi``."""
    ends = F.split(F.replace("item", F.lit(EN_DASH), F.lit("-")), "-")
    return _items(lists, codes, grp).select(
        F.trim(F.element_at(ends, 1)).alias("lo"), F.trim(F.element_at(ends, -1)).alias("hi"), "grp"
    )


def endpoint_codes(lists: DataFrame, codes: str = "codes", grp: str = "grp") -> DataFrame:
    """Literal end-point keys: ranges count by their two ends only and an en dash is no separator."""
    return _items(lists, codes, grp).select(F.explode(F.split("item", "-")).alias("code"), "grp")


def _prefix_number(code: Column, digit: int) -> Column:
    """Order of a code's two-character prefix, letter and digit: A0 -> 0, A1 -> 1, B0 -> 10, ...

    A letter alone takes ``digit``; anything else has no number.
    """
    letter = F.ascii(F.substring(code, 1, 1)) - F.lit(ord("A"))
    second = F.when(F.length(code) == 1, F.lit(digit)).otherwise(F.substring(code, 2, 1).try_cast("int"))
    return F.when(code.rlike("^[A-Z]"), letter * 10 + second)


def bad_codes(ranges: DataFrame) -> DataFrame:
    """Ranges that match nothing because an end is no letter, or letter and digit, or the ends are in no order."""
    lo, hi = _prefix_number(F.col("lo"), 0), _prefix_number(F.col("hi"), 9)
    return ranges.where(lo.isNull() | hi.isNull() | (lo > hi))


def range_index(ranges: DataFrame) -> DataFrame:
    """``(lo, hi, grp)`` with one row per two-character prefix the range touches, as an equi-join key.

    A range in ``bad_codes`` has none.
    """
    lo, hi = _prefix_number(F.col("lo"), 0), _prefix_number(F.col("hi"), 9)
    number = F.explode(F.when(lo <= hi, F.sequence(lo, F.greatest(lo, hi))))
    prefix = F.concat(
        F.char((F.col("number") / 10).cast("int") + F.lit(ord("A"))),
        (F.col("number") % 10).cast("string"),
    )
    return ranges.select("lo", "hi", "grp", number.alias("number")).select(
        "lo", "hi", "grp", prefix.alias("prefix")
    )


def _in_range(code: Column, ranges: DataFrame) -> Column:
    """Prefix-aware range test, so that Q01-Q07 covers Q07.9; the prefix makes it a hash join."""
    return (
        (F.substring(code, 1, 2) == ranges["prefix"])
        & (code >= ranges["lo"])
        & (F.substr(code, F.lit(1), F.length(ranges["hi"])) <= ranges["hi"])
    )


def icd_range_join(df: DataFrame, code: str, ranges: DataFrame) -> DataFrame:
    """``df`` with the ``grp`` of every range its code lies in (inner join).

    No broadcast hint: a code list is a few dozen rows and goes below Spark's size-checked broadcast
    threshold, while a list too large for it falls back to a shuffle join that AQE can split.
    """
    index = range_index(ranges)
    return df.join(index, _in_range(df[code], index)).select(*[df[c] for c in df.columns], index["grp"])


def in_code_ranges(df: DataFrame, code: str, ranges: DataFrame) -> DataFrame:
    """Rows of ``df`` whose code lies in some range, each once (semi join)."""
    index = range_index(ranges)
    return df.join(index, _in_range(df[code], index), "left_semi")


def not_in_code_ranges(df: DataFrame, code: str, ranges: DataFrame) -> DataFrame:
    """Rows of ``df`` with a code outside all ranges; a NULL code is in neither set."""
    index = range_index(ranges)
    return df.where(F.col(code).isNotNull()).join(index, _in_range(df[code], index), "left_anti")


def mark_code_ranges(df: DataFrame, code: str, ranges: DataFrame, flag: str) -> DataFrame:
    """``df`` with a boolean ``flag``: does the code lie in some range?

    A left join, so a code in several overlapping ranges repeats its row; use it below an aggregation that does
    not count rows.
    """
    index = range_index(ranges)
    marked = df.join(index, _in_range(df[code], index), "left")
    return marked.select(*[df[c] for c in df.columns], index["lo"].isNotNull().alias(flag))
