"""Free-text salary parsing as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom.functions.text import first_group, not_blank

# The wording rules of the canonical parser.
K_SHORTHAND = r"\d\s*k"
RANGE_MARK = r"(\s+to\s+|–|—|~|-)"
PESO_WORDS = r"(?i)(php|₱)"
DOLLAR_WORDS = r"(?i)(usd|\$|us\s*dollar|dollar)"
PERIOD_WORDS = (
    (r"(?i)(per\s*hour|/hr|hourly|/hour)", "hourly"),
    (r"(?i)(per\s*day|daily|/day)", "daily"),
    (r"(?i)(per\s*year|yearly|annual|/yr|/year|p\.a\.)", "yearly"),
)
DEFAULT_PERIOD = "monthly"
DEFAULT_CURRENCY = "PHP"
MONEY_SIGNALS = (
    r"(?i)(php|usd|peso|dollar|\$|₱|£|€)",
    r"(?i)(/hr|/hour|per\s*hour|hourly|/mo|/month|per\s*month|monthly|/yr|/year|per\s*year|yearly|annual|p\.a\.)",
)
BARE_AMOUNT_FLOOR = 1000
# Bracket upper bounds and labels.
BRACKETS = (
    (15000, "Below ₱15K"),
    (25000, "₱15K-25K"),
    (40000, "₱25K-40K"),
    (60000, "₱40K-60K"),
    (80000, "₱60K-80K"),
    (100000, "₱80K-100K"),
    (150000, "₱100K-150K"),
)
TOP_BRACKET = "₱150K+"
NO_BRACKET = "Not disclosed"
# Factors to one month and to pesos.
MONTHS_FACTOR = {"hourly": 176.0, "daily": 22.0, "yearly": 1.0 / 12}
PESOS_PER_USD = 56.0

PARSED_AMOUNT = "decimal(18,2)"
_WORK_AMOUNT = "decimal(28,6)"


def before_perks(raw: Column) -> Column:
    """Lower-cased text before the first '+', which always introduces perks."""
    return F.split_part(F.lower(raw), F.lit("+"), F.lit(1))


def uses_k(raw: Column) -> Column:
    return before_perks(raw).rlike(K_SHORTHAND)


def amount_text(raw: Column) -> Column:
    """Numbers and range marks only; every other run becomes one space."""
    plain = F.replace(before_perks(raw), F.lit(","), F.lit(""))
    marked = F.regexp_replace(plain, RANGE_MARK, "~")
    spaced = F.regexp_replace(marked, r"[^0-9k.~]+", " ")
    return F.replace(spaced, F.lit("k"), F.lit(""))


def first_amount(digits: Column) -> Column:
    return first_group(digits, r"(\d+(?:\.\d+)?)")


def range_end(digits: Column) -> Column:
    return first_group(digits, r"~\s*(\d+(?:\.\d+)?)")


def currency(raw: Column, explicit: Column) -> Column:
    sniffed = F.when(raw.rlike(PESO_WORDS), "PHP").when(raw.rlike(DOLLAR_WORDS), "USD")
    return F.coalesce(F.nullif(explicit, F.lit("")), sniffed, F.lit(DEFAULT_CURRENCY))


def period(raw: Column) -> Column:
    (regex, name), *rest = PERIOD_WORDS
    chain = F.when(raw.rlike(regex), name)
    for regex, name in rest:
        chain = chain.when(raw.rlike(regex), name)
    return chain.otherwise(DEFAULT_PERIOD)


def scaled(text: Column, is_k: Column) -> Column:
    return text.try_cast(_WORK_AMOUNT) * F.when(is_k, 1000).otherwise(1)


def has_money_signal(raw: Column, is_k: Column) -> Column:
    symbol, per_period = MONEY_SIGNALS
    return is_k | raw.rlike(symbol) | raw.rlike(per_period)


def believable(amount: Column, signal: Column) -> Column:
    """Keep a positive amount that carries a money signal or is large enough to be pay."""
    return F.when((amount > 0) & (signal | (amount >= BARE_AMOUNT_FLOOR)), amount).try_cast(PARSED_AMOUNT)


def with_salary(df: DataFrame, raw: str = "salary_raw", explicit: str = "salary_currency") -> DataFrame:
    """Add parsed_currency, parsed_period, parsed_min and parsed_max to every row.

    Rows without salary text get NULLs, which is what a left join on the parsed rows would give,
    but without a join. The steps are staged so that each text is normalised once.
    """
    text, flag = F.col(raw), F.col(explicit)
    staged = df.withColumns({"_is_k": uses_k(text), "_digits": amount_text(text), "_has_text": not_blank(text)})
    staged = staged.withColumns(
        {
            "_signal": has_money_signal(text, F.col("_is_k")),
            "_low": scaled(first_amount(F.col("_digits")), F.col("_is_k")),
            "_high": scaled(range_end(F.col("_digits")), F.col("_is_k")),
        }
    )
    parsed = staged.withColumns(
        {
            "parsed_currency": F.when(F.col("_has_text"), currency(text, flag)),
            "parsed_period": F.when(F.col("_has_text"), period(text)),
            "parsed_min": F.when(F.col("_has_text"), believable(F.col("_low"), F.col("_signal"))),
            "parsed_max": F.when(F.col("_has_text"), believable(F.col("_high"), F.col("_signal"))),
        }
    )
    return parsed.drop("_is_k", "_digits", "_has_text", "_signal", "_low", "_high")


def parse_salary(postings: DataFrame) -> DataFrame:
    """One row per posting that has salary text."""
    return with_salary(postings.where(not_blank(F.col("salary_raw")))).select(
        "raw_id",
        "source",
        "source_id",
        "salary_raw",
        F.col("parsed_currency").alias("salary_currency"),
        F.col("parsed_period").alias("salary_period"),
        F.col("parsed_min").alias("salary_min"),
        F.col("parsed_max").alias("salary_max"),
    )


def parse_salary_simple(raw: Column) -> Column:
    """The second dialect: up to two numbers, one value fills both ends, ends are put in order.

    Returns struct<min bigint, max bigint, currency string, period string>, all NULL without a number.
    """
    text = F.lower(F.trim(raw))
    cleaned = F.regexp_replace(F.regexp_replace(text, r"[₱$]", ""), r"\b(php|usd)\b", "")
    tokens = F.regexp_extract_all(cleaned, F.lit(r"\d+(?:,\d{3})*(?:\.\d+)?(?:k\b)?"), F.lit(0))

    def value(token: Column) -> Column:
        number = F.regexp_replace(token, "[,k]", "").try_cast(_WORK_AMOUNT)
        return F.bround(F.when(token.endswith("k"), number * 1000).otherwise(number), 0).try_cast("bigint")

    values = F.transform(tokens, value)
    one, two = F.get(values, F.lit(0)), F.coalesce(F.get(values, F.lit(1)), F.get(values, F.lit(0)))
    found = F.size(tokens) > 0
    money = F.when(text.contains("₱") | text.contains("php"), "PHP").when(
        text.contains("$") | text.contains("usd") | text.contains("dollar"), "USD"
    )
    span = F.when(text.rlike(r"annual|yearly|per year|/year|yr"), "annual").otherwise("monthly")
    return F.struct(
        F.when(found, F.least(one, two)).alias("min"),
        F.when(found, F.greatest(one, two)).alias("max"),
        F.when(found, F.coalesce(money, F.lit("PHP"))).alias("currency"),
        F.when(found, span).alias("period"),
    )


def salary_bucket(amount: Column) -> Column:
    chain = F.when(amount.isNull(), NO_BRACKET)
    for bound, label in BRACKETS:
        chain = chain.when(amount < bound, label)
    return chain.otherwise(TOP_BRACKET)


def to_monthly_php(low: Column, high: Column, money: Column, span: Column) -> Column:
    """struct<min double, max double> in pesos per month; zero counts as missing."""
    factor = F.lit(1.0)
    for name, months in MONTHS_FACTOR.items():
        factor = F.when(span == name, F.lit(months)).otherwise(factor)
    rate = F.when(money == "USD", F.lit(PESOS_PER_USD)).otherwise(F.lit(1.0))

    def convert(amount: Column) -> Column:
        return F.when(amount != 0, amount.cast("double") * factor * rate)

    return F.struct(convert(low).alias("min"), convert(high).alias("max"))
