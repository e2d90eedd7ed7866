"""Whole-word dictionary matching.

The dictionary is compiled into the plan: plain words become one hashed intersection with the row's own tokens,
phrases are checked by regex only when their rarest-looking word is among those tokens, and real regexes are checked
directly. Everything happens inside the row: no cross join, no shuffle, and the pairs come out distinct per row.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom.functions.text import WORD, whole_word
from jobloom.session import cut

_LITERAL = re.compile(r"(?:[\w\s/#&,:;@'-]|\\[^\w\s])+", re.ASCII)
_PLAIN = re.compile(r"\w+", re.ASCII)
# Entries of one compiled plan: by default larger dictionaries are joined, and free regexes are checked in groups of this many.
COMPILED_TERMS = 2000

PAIR = "struct<name:string,category:string>"


@dataclass(frozen=True)
class Term:
    pattern: str
    name: str
    category: str | None

    @property
    def literal(self) -> str | None:
        """The text the pattern stands for, when it is plain text with escaped signs; else None."""
        return re.sub(r"\\(.)", r"\1", self.pattern) if _LITERAL.fullmatch(self.pattern) else None

    @property
    def is_plain_word(self) -> bool:
        return bool(_PLAIN.fullmatch(self.pattern))

    @property
    def anchor(self) -> str | None:
        """A word that every match contains as a whole token (signs split tokens, so each word of it does)."""
        words = _PLAIN.findall(self.literal or "")
        return max(words, key=len).lower() if words else None

    def can_match(self, boundary: str) -> bool:
        """Under strict boundaries a literal that starts or ends in a sign never matches."""
        text = self.literal
        if boundary == "loose" or text is None:
            return True
        return bool(_PLAIN.match(text[:1]) and _PLAIN.match(text[-1:]))


def load_terms(dictionary: DataFrame, limit: int | None = None) -> list[Term]:
    rows = dictionary.select("pattern", "canonical_name", "category")
    rows = rows.limit(limit).collect() if limit else rows.collect()
    return [Term(*row) for row in rows]


def tokens_of(texts: Sequence[Column]) -> Column:
    """Distinct tokens of all texts, with A-Z in lower case and every other letter as it stands, like the regexes. Texts of
    plain letters take the quicker functions, with the same tokens."""
    body = F.concat_ws("\n", *texts)
    quick = F.regexp_extract_all(F.lower(body), F.lit(r"\w+"), F.lit(0))
    every = F.regexp_extract_all(F.translate(body, ascii_uppercase, ascii_lowercase), F.lit(f"{WORD}+"), F.lit(0))
    return F.array_distinct(F.when(F.octet_length(body) == F.length(body), quick).otherwise(every))


#: Most words of 64 bits of a token filter; it has 16 bits for each entry, up to this size.
FILTER_WORDS = 1 << 14


def _place(token: Column, words: int) -> tuple[Column, Column]:
    """Word and bit of a token in a filter of `words` words, a power of two."""
    h = F.xxhash64(token)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), h.bitwiseAND(F.lit(63)).cast("int"))
    return F.shiftrightunsigned(h, 6).bitwiseAND(F.lit(words - 1)).cast("int"), bit


def token_filter(tokens: DataFrame, column: str) -> Callable[[Column], Column]:
    """A condition that holds for every token of `tokens`, and for few others. The bits are gathered by Spark; at most
    FILTER_WORDS numbers reach the driver and the plan, however many tokens there are."""
    n = tokens.select(column).distinct().count()
    words = min(FILTER_WORDS, 1 << max(0, (n // 4).bit_length()))
    word, bit = _place(F.col(column), words)
    set_bits = dict(tokens.select(word.alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit")).collect())
    table = F.split(F.lit(",".join(str(set_bits.get(i, 0)) for i in range(words))), ",").cast("array<bigint>")

    def may_be_one(token: Column) -> Column:
        word, bit = _place(token, words)
        return F.get(table, word).bitwiseAND(bit) != 0

    return may_be_one


def _pair(term: Term) -> Column:
    return F.struct(F.lit(term.name).alias("name"), F.lit(term.category).cast("string").alias("category"))


def _lookup(terms: Sequence[Term]) -> dict[str, list[Term]]:
    table: dict[str, list[Term]] = {}
    for term in terms:
        table.setdefault(term.pattern.lower(), []).append(term)
    return table


def matched_pairs(df: DataFrame, texts: Sequence[Column], elements: Sequence[Column], terms, boundary) -> DataFrame:
    """Add _pairs, the distinct (name, category) structs found in the row.

    texts: string columns. elements: array<string> columns, each element is matched on its own.
    """
    usable = [t for t in terms if t.can_match(boundary)]
    plain = [t for t in usable if t.is_plain_word]
    other = [t for t in usable if not t.is_plain_word]
    table = _lookup(plain)
    anchors = {t.anchor for t in other if t.anchor}
    watched = sorted(set(table) | anchors)

    joined = [F.array_join(e, "\n") for e in elements]
    # Each token is looked up in one set that is kept for all rows; an intersection would build the set anew for each row.
    hits = df.withColumn(
        "_hits",
        F.filter(tokens_of([*texts, *joined]), lambda t: t.isin(*watched)) if watched else F.array().cast("array<string>"),
    )

    def regex_hit(term: Term) -> Column:
        regex = whole_word(term.pattern, boundary)

        def matches(text: Column) -> Column:
            # Plain ASCII text is sought first: that takes a fraction of the time of a regex that looks behind at every place.
            literal = term.literal if term.pattern.isascii() else None
            return F.lower(text).contains(literal.lower()) & text.rlike(regex) if literal else text.rlike(regex)

        found = F.lit(False)
        for text in texts:
            found = found | F.coalesce(matches(text), F.lit(False))
        for array in elements:
            found = found | F.coalesce(F.exists(array, matches), F.lit(False))
        return F.array_contains("_hits", term.anchor) & found if term.anchor else found

    parts: list[Column] = []
    if plain:
        names = F.create_map(
            *[c for word, owners in table.items() for c in (F.lit(word), F.array(*[_pair(t) for t in owners]))]
        )
        known = F.filter(F.col("_hits"), lambda h: h.isin(*table))
        parts.append(F.flatten(F.transform(known, lambda h: F.element_at(names, h))))
    if other:
        checked = F.filter(F.array(*[F.when(regex_hit(t), _pair(t)) for t in other]), lambda p: p.isNotNull())
        if all(t.anchor for t in other):  # rows without any anchor skip the checks
            checked = F.when(F.exists("_hits", lambda h: h.isin(*anchors)), checked).otherwise(F.array().cast(f"array<{PAIR}>"))
        parts.append(checked)
    found = F.array_distinct(F.concat(*[p.cast(f"array<{PAIR}>") for p in parts])) if parts else F.array().cast(f"array<{PAIR}>")
    # Rows without any watched token skip the lookups; regexes without an anchor must always run.
    always = any(t.anchor is None for t in other)
    if not always:
        found = F.when(F.size("_hits") > 0, found)
    return hits.withColumn("_pairs", found).drop("_hits")


def match_terms(
    df: DataFrame,
    id_cols: Sequence[str],
    text_cols: Sequence[str],
    array_cols: Sequence[str],
    dictionary: DataFrame,
    boundary: str = "strict",
    unique_ids: bool = True,
    carry: Sequence[str] = (),
    method: str = "auto",
) -> DataFrame:
    """One row per (id, skill_name, skill_category) whose term occurs in any text or array element.

    unique_ids: `df` has one row per id, so the per-row distinct is the final distinct. `carry` columns go along.
    method: "compiled", "joined", or "auto" = compiled up to COMPILED_TERMS entries; both give the same rows. Rows that share
    an id, null ones too, are one row of the result.
    """
    if method == "auto":
        terms = load_terms(dictionary, COMPILED_TERMS + 1)
        method = "compiled" if len(terms) <= COMPILED_TERMS else "joined"
    if method == "joined":
        return _joined(df, id_cols, text_cols, array_cols, dictionary, boundary, carry)
    terms = load_terms(dictionary)
    paired = matched_pairs(
        df.select(*id_cols, *carry, *[c for c in [*text_cols, *array_cols] if c not in {*id_cols, *carry}]),
        [F.col(c) for c in text_cols],
        [F.col(c) for c in array_cols],
        terms,
        boundary,
    )
    # The outer form keeps Spark from inferring a size filter that would run the whole matching a second time.
    exploded = paired.select(*id_cols, *carry, F.explode_outer("_pairs").alias("_pair")).where("_pair is not null")
    pairs = exploded.select(
        *id_cols, *carry, F.col("_pair.name").alias("skill_name"), F.col("_pair.category").alias("skill_category")
    )
    return pairs if unique_ids else pairs.dropDuplicates([*id_cols, "skill_name", "skill_category"])


def _joined(df, id_cols, text_cols, array_cols, dictionary, boundary, carry) -> DataFrame:
    """Large dictionaries: equi-join the row's distinct tokens with the terms' anchors.

    A filter of bits in the plan drops the tokens that are no anchor inside the row, so few are exploded and shuffled. Only
    terms whose anchor occurs in the row become candidates; phrases are then verified by regex. AQE picks the join side and
    splits hot tokens. Terms without an anchor are compiled as regexes.
    """
    # Escaped signs are unescaped, then the longest word is the anchor; the rule is Term.anchor's, JVM-side.
    literal = F.col("pattern").rlike(r"^(?:[\w\s/#&,:;@'-]|\\[^\w\s])+$")
    plain_text = F.regexp_replace("pattern", r"\\(.)", "$1")
    words = F.regexp_extract_all(plain_text, F.lit(r"\w+"), F.lit(0))
    longest = F.aggregate(words, F.lit(""), lambda best, w: F.when(F.length(w) > F.length(best), w).otherwise(best))
    usable = F.lit(True) if boundary == "loose" else plain_text.rlike(r"^\w") & plain_text.rlike(r"\w$")
    terms = dictionary.select(
        "pattern",
        F.col("canonical_name").alias("skill_name"),
        F.col("category").alias("skill_category"),
        F.lower(longest).alias("anchor"),
        literal.alias("is_literal"),
        usable.alias("usable"),
    )
    anchored = terms.where("is_literal and usable and anchor <> ''").drop("is_literal", "usable")
    rest = [Term(*r) for r in terms.where("not is_literal or anchor = ''").select("pattern", "skill_name", "skill_category").collect()]
    rows = df.select(*id_cols, *carry, *[c for c in [*text_cols, *array_cols] if c not in {*id_cols, *carry}])
    body = [F.col(c) for c in text_cols] + [F.array_join(c, "\n") for c in array_cols]
    # Only ids travel with the tokens; the texts would be copied once per token.
    known = F.filter(tokens_of(body), token_filter(anchored, "anchor"))
    tokens = rows.select(*id_cols, *carry, F.explode_outer(known).alias("anchor"))
    out = [*id_cols, *carry, "skill_name", "skill_category"]
    is_word = F.col("pattern").rlike(r"^\w+$").alias("is_word")
    # Written once: texts are taken apart a single time for words and phrases.
    met = cut(tokens.join(anchored.select("*", is_word), "anchor").select(*out, "pattern", "is_word"), "anchors")
    pairs = met.where("is_word").select(*out)

    # Phrases: the candidates of a row meet its text again, by id, and are checked there.
    front, back = whole_word("\u0000", boundary).split("\u0000")
    regex = F.concat(F.lit(front), F.col("pattern"), F.lit(back))
    found = F.lit(False)
    for c in text_cols:
        found = found | F.coalesce(F.rlike(F.col(c), regex), F.lit(False))
    for c in array_cols:
        found = found | F.coalesce(F.exists(c, lambda e: F.rlike(e, regex)), F.lit(False))
    candidates = met.where("not is_word").drop(*carry, "is_word")
    renamed = candidates.withColumnsRenamed({c: f"_{c}_of_candidate" for c in id_cols}).distinct()
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}_of_candidate")) for c in id_cols])
    pairs = pairs.unionByName(rows.join(renamed, same).where(found).select(*out))
    for i in range(0, len(rest), COMPILED_TERMS):
        group = rest[i : i + COMPILED_TERMS]
        extra = matched_pairs(rows, [F.col(c) for c in text_cols], [F.col(c) for c in array_cols], group, boundary)
        extra = extra.select(*id_cols, *carry, F.inline_outer("_pairs").alias("skill_name", "skill_category"))
        pairs = pairs.unionByName(extra.where("skill_name is not null"))
    return pairs.dropDuplicates([*id_cols, "skill_name", "skill_category"])


def posting_skills(postings: DataFrame, dictionary: DataFrame, boundary: str = "strict", carry=()) -> DataFrame:
    """Skills of deduplicated postings, from title, description and the skills array."""
    ready = postings.withColumn("_skills", F.from_json("skills_json", "array<string>"))
    return match_terms(
        ready, ["raw_id", "source", "source_id"], ["title", "description"], ["_skills"], dictionary, boundary, carry=carry
    )
