"""Labels shown next to the numbers, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Display names of the sources.
SOURCE_LABELS = {
    "philjobnet": "PhilJobNet",
    "kalibrr": "Kalibrr",
    "jobstreet": "JobStreet",
    "onlinejobs": "OnlineJobs",
    "indeed": "Indeed",
    "facebook": "Facebook",
}
# Ordered substrings of an employment type, the first hit wins.
EMPLOYMENT_BUCKETS = (
    (("full",), "fulltime"),
    (("part",), "parttime"),
    (("permanent",), "permanent"),
    (("contract",), "contract"),
    (("freelance", "gig"), "freelance"),
    (("intern", "ojt"), "internship"),
    (("project",), "project"),
)
OTHER_BUCKET = "other"


def source_label(source: Column) -> Column:
    chain = F.lit(None).cast("string")
    for name, label in SOURCE_LABELS.items():
        chain = F.when(source == name, label).otherwise(chain)
    return F.coalesce(chain, source)


def grouped_number(amount: Column, decimals: int = 3) -> Column:
    """Thousands separators and at most `decimals` decimals, none when they are zero."""
    fixed = F.format_number(amount, decimals)
    return F.regexp_replace(F.regexp_replace(fixed, r"(\.\d*?)0+$", "$1"), r"\.$", "")


def salary_label(low: Column, high: Column, currency: Column) -> Column:
    symbol = F.when(currency == "USD", "$").otherwise("₱")
    has_low, has_high = F.coalesce(low != 0, F.lit(False)), F.coalesce(high != 0, F.lit(False))

    def money(amount: Column) -> Column:
        return F.concat(symbol, grouped_number(amount))

    return (
        F.when(has_low & has_high, F.concat(money(low), F.lit(" – "), money(high)))
        .when(has_low, money(low))
        .when(has_high, money(high))
        .otherwise("Negotiable")
    )


def date_key_label(key: Column) -> Column:
    """20260530 -> May 30, 2026."""
    day = F.try_to_date(key.cast("string"), "yyyyMMdd")
    return F.coalesce(F.date_format(day, "MMMM d, yyyy"), F.lit("Date not available"))


def employment_bucket(kind: Column) -> Column:
    lowered = F.lower(kind)
    chain = F.when(kind.isNull() | (kind == ""), F.lit(None).cast("string"))
    for words, name in EMPLOYMENT_BUCKETS:
        hit = lowered.contains(words[0])
        for word in words[1:]:
            hit = hit | lowered.contains(word)
        chain = chain.when(hit, name)
    return chain.otherwise(OTHER_BUCKET)


def employment_label(kind: Column) -> Column:
    words = F.filter(F.split(F.regexp_replace(kind, r"\+\d+$", ""), r"[\s/-]+"), lambda w: w != "")
    return F.array_join(
        F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2)))), " "
    )


def peso_label(amount: Column) -> Column:
    """Whole pesos; a missing amount shows as zero."""
    return F.concat(F.lit("₱"), F.format_number(F.round(F.coalesce(amount, F.lit(0)), 0), 0))
