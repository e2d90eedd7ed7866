"""Free-text place names to canonical cities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobloom.functions.text import whole_word

# Ordered rules, the first hit wins.
CITY_RULES: tuple[tuple[str, str], ...] = (
    (r"(?i)makati", "Makati"),
    (r"(?i)bgc|bonifacio|taguig", "Taguig"),
    (r"(?i)quezon\s*city|" + whole_word("qc"), "Quezon City"),
    (r"(?i)manila", "Manila"),
    (r"(?i)ortigas|pasig", "Pasig"),
    (r"(?i)mandaluyong", "Mandaluyong"),
    (r"(?i)alabang|muntinlupa", "Muntinlupa"),
    (r"(?i)cebu", "Cebu City"),
    (r"(?i)davao", "Davao City"),
    (r"(?i)clark|pampanga|angeles", "Clark"),
    (r"(?i)iloilo", "Iloilo City"),
)
REMOTE_WORDS = r"(?i)(remote|wfh|work from home|anywhere)"


def map_city(raw: Column, rules: Sequence[tuple[str, str]] = CITY_RULES) -> Column:
    (regex, city), *rest = rules
    chain = F.when(raw.rlike(regex), city)
    for regex, city in rest:
        chain = chain.when(raw.rlike(regex), city)
    return chain.otherwise(F.trim(raw))


def looks_remote(raw: Column) -> Column:
    return raw.rlike(REMOTE_WORDS)
