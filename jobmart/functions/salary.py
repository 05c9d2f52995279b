"""Salary text to typed columns. Two rule sets exist and disagree on purpose; keep both."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from jobmart import vocab
from jobmart.functions.matching import contains_any
from jobmart.functions.text import SPACE, ascii_digits, extract, strip

# --- fixed values: number and salary patterns ------------------------------------------------
NUMBER = r"[0-9]+(?:\.[0-9]+)?"
RANGE = rf"({NUMBER})[-–]({NUMBER})"
UPPER = rf"(?:Tới|tới|Upto|upto|Up{SPACE}*to){SPACE}*({NUMBER})"
NOISE = rf"[A-Za-z$¥,]|{SPACE}"
NEGOTIABLE = ["Thoả thuận", "Thỏa thuận", ""]


CURRENCY_RATES = {"USD": vocab.CLEAN_USD_RATE, "JPY": vocab.CLEAN_JPY_RATE}


def with_clean_salary(df: DataFrame, source: str = "salary") -> DataFrame:
    """Add ``min_salary, max_salary`` (whole million VND, rounded up; -1 when unknown),
    ``salary_currency`` and ``salary_type``.

    The type is ``negotiable``, ``range``, ``upper_bound`` or ``unknown``. A range is taken as
    written (it is not reordered) and VND amounts are never scaled.

    Written as successive projections: each intermediate column is used several times by the
    next one, so Catalyst computes it once instead of inlining it everywhere.
    """
    t, digits, bare, currency = (F.col(f"_{n}") for n in ("t", "digits", "bare", "currency"))
    found = (
        df.withColumn("_t", strip(F.col(source)))
        .withColumns({
            "_digits": ascii_digits(t),
            "_currency": F.when(contains_any(t, ["USD", "$"]), "USD")
            .when(contains_any(t, ["JPY", "¥", "Yen", "yen"]), "JPY").otherwise("VND")})
        .withColumn("_bare", F.regexp_replace(digits, NOISE, ""))
        .withColumns({"_low": extract(bare, RANGE, 1), "_high": extract(bare, RANGE, 2),
                      "_upper": extract(digits, UPPER)}))

    rate = F.lit(1.0)
    for code, value in CURRENCY_RATES.items():
        rate = F.when(currency == code, F.lit(value)).otherwise(rate)

    def million(name: str) -> Column:
        return F.ceil(F.col(name).cast("double") * rate)

    kind = F.col("salary_type")

    def whole(of_range: Column, of_bound: Column) -> Column:
        return (F.when(kind == "range", of_range.try_cast("int"))
                .when(kind == "upper_bound", of_bound.try_cast("int")).otherwise(F.lit(-1)))

    return (
        found.withColumn(
            "salary_type",
            F.when(t.isNull() | t.isin(NEGOTIABLE), "negotiable")
            .when(F.col("_low").isNotNull(), "range")
            .when(F.col("_upper").isNotNull(), "upper_bound").otherwise("unknown"))
        .withColumns({
            "min_salary": whole(million("_low"), F.ceil(million("_upper") / F.lit(2.0))),
            "max_salary": whole(million("_high"), million("_upper")),
            "salary_currency": F.when(kind == "negotiable", "VND").otherwise(currency)})
        .drop("_t", "_digits", "_bare", "_currency", "_low", "_high", "_upper"))


def with_rules_salary(df: DataFrame, source: str = "salary",
                      units: Mapping[str, Sequence[str]] = vocab.SALARY_UNITS) -> DataFrame:
    """Add ``min_salary, max_salary`` (million VND, float; NULL when unknown or implausible) and
    ``currency``.

    The first currency having any keyword as a substring wins, so the VND unit letter "m" also
    claims "month". Numbers are read in successive projections, as in ``with_clean_salary``.
    """
    t, digits, currency = F.col("_t"), F.col("_digits"), F.col("currency")
    code = F.when(t.isNull(), F.lit(None).cast("string"))
    for name, words in units.items():
        code = code.when(contains_any(t, words), F.lit(name))
    # Dots group thousands only if every one of them is followed by exactly three digits.
    plain = F.when(digits.rlike(r"\.(?![0-9]{3}(?![0-9]))"), digits).otherwise(
        F.replace(digits, F.lit("."), F.lit("")))
    thousands = contains_any(t, ["k", "nghìn", "thousand"])

    def foreign(x: Column, rate: float) -> Column:
        amount = F.when((x < 100) & thousands, x * 1000).otherwise(x)
        return F.when(amount <= 50_000, amount * F.lit(rate))

    def million(x: Column) -> Column:
        yen = (F.when(contains_any(t, ["man", "lá", "la", "万"]), x * F.lit(vocab.RULES_MAN_RATE))
               .when(contains_any(t, ["sen", "sên"]), (x * 1000) * F.lit(vocab.RULES_YEN_RATE))
               .when(x >= 1000, x * F.lit(vocab.RULES_YEN_RATE))
               .otherwise(x * F.lit(vocab.RULES_MAN_RATE)))
        return (F.when(currency == "VND", F.when(x >= 100_000, x / F.lit(1e6)).otherwise(x))
                .when(currency == "USD", foreign(x, vocab.RULES_USD_RATE))
                .when(currency == "EUR", foreign(x, vocab.RULES_EUR_RATE))
                .when(currency == "JPY", yen).otherwise(x))

    def number(i: int) -> Column:
        return F.get("_numbers", F.lit(i)).cast("double")

    def plausible(name: str) -> Column:
        return F.when(F.col(name) <= vocab.RULES_SALARY_CEILING, F.col(name))

    # least/greatest skip NULL: a single usable number serves as both ends.
    return (
        df.withColumn("_t", strip(F.lower(F.nullif(F.col(source), F.lit("")))))
        .withColumns({"currency": code.otherwise(F.lit("VND")),
                      "_digits": ascii_digits(F.replace(t, F.lit(","), F.lit("")))})
        .withColumn("_numbers", F.regexp_extract_all(plain, F.lit(NUMBER), F.lit(0)))
        .withColumns({"_a": number(0), "_b": number(1)})
        .withColumns({"_a": million(F.col("_a")), "_b": million(F.col("_b"))})
        .withColumns({"_a": plausible("_a"), "_b": plausible("_b")})
        .withColumns({"min_salary": F.least("_a", "_b").cast("float"),
                      "max_salary": F.greatest("_a", "_b").cast("float")})
        .drop("_t", "_digits", "_numbers", "_a", "_b"))
