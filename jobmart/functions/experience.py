"""Experience text to years. Two rule sets, as for salaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobmart import vocab
from jobmart.functions.matching import contains_any
from jobmart.functions.salary import NUMBER
from jobmart.functions.text import SPACE, ascii_digits, extract, strip

# --- fixed values: experience patterns -------------------------------------------------------
CLEAN_YEARS = rf"([0-9]+(?:[.,][0-9]+)?){SPACE}*năm"
CLEAN_UNDER_ONE = rf"[Dd]ưới{SPACE}*1"
CLEAN_NO_NEED = ["Không yêu cầu", "Không yêu cầu kinh nghiệm"]
JOINER = rf"{SPACE}*[-–đếnto]+{SPACE}*"
YEAR_RANGE = rf"({NUMBER}){JOINER}({NUMBER}){SPACE}*(?:năm|years?|yr)(?![a-zA-Z])"
YEAR_SINGLE = rf"({NUMBER}){SPACE}*\+?{SPACE}*(?:năm|years?|yr|y)(?![a-zA-Z])"
MONTH_RANGE = rf"({NUMBER}){JOINER}({NUMBER}){SPACE}*(?:tháng|months?)(?![a-zA-Z])"
MONTH_SINGLE = rf"({NUMBER}){SPACE}*(?:tháng|months?)(?![a-zA-Z])"


def with_clean_experience(df: DataFrame, source: str = "experience") -> DataFrame:
    """Add ``exp_min`` (float, -1.0 when unknown) and ``exp_type``.

    Reads the first number directly before "năm", so a range yields its upper end.
    """
    t, years, kind = F.col("_t"), F.col("_years"), F.col("exp_type")
    return (
        df.withColumn("_t", strip(F.nullif(F.col(source), F.lit(""))))
        .withColumn("_years", extract(ascii_digits(t), CLEAN_YEARS))
        .withColumn(
            "exp_type",
            F.when(t.isin(CLEAN_NO_NEED), "no_requirement")
            .when(t.rlike(CLEAN_UNDER_ONE), "less_than_1")
            .when(years.isNotNull(), "exact").otherwise("unknown"))
        .withColumn(
            "exp_min",
            F.when(kind == "exact", F.replace(years, F.lit(","), F.lit(".")).cast("double"))
            .when(kind == "unknown", F.lit(-1.0)).otherwise(F.lit(0.0)).cast("float"))
        .drop("_t", "_years"))


def with_rules_experience(df: DataFrame, source: str = "experience") -> DataFrame:
    """Add ``years_of_experience`` (float, NULL when unknown).

    Months count as fractions of a year, ranges as their middle.
    """
    t = F.col("_t")

    def num(pattern: str, group: int = 1) -> Column:
        return extract(t, pattern, group).cast("double")

    def middle(pattern: str) -> Column:
        return (num(pattern, 1) + num(pattern, 2)) / F.lit(2.0)

    bare = num(f"({NUMBER})")
    years = (
        F.when(contains_any(t, vocab.NO_EXPERIENCE), F.lit(0.0))
        .when(contains_any(t, ["dưới 1 năm", "dưới 1 year"]), F.lit(0.5))
        .when(t.contains("dưới") & contains_any(t, ["tháng", "month"]), F.lit(0.25))
        .otherwise(F.coalesce(
            F.bround(middle(MONTH_RANGE) / F.lit(12.0), 2),
            F.bround(num(MONTH_SINGLE) / F.lit(12.0), 2),
            middle(YEAR_RANGE),
            num(YEAR_SINGLE),
            F.when(bare < 20, bare),
        ))
    )
    prepared = F.replace(strip(F.lower(F.nullif(F.col(source), F.lit("")))), F.lit(","), F.lit("."))
    return (df.withColumn("_t", ascii_digits(prepared))
            .withColumn("years_of_experience", years.cast("float")).drop("_t"))
