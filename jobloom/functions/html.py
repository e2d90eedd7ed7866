"""Cutting repeated cards and their fields out of HTML with the JVM's text functions.

Regexes find where an element starts; where it ends is found by counting the tags of its name, so elements may nest their
own tag and a card never reaches into what follows it. Comments, scripts and styles are no elements.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: name -> text of every character reference of HTML, as Python's own table has them, packed for str_to_map.
_NAMES = "\x01".join(f"{name[:-1]}\x02{text}" for name, text in html5.items() if name.endswith(";"))
_BLANKS = " \t\n\r\f\u000b\u00a0"
_BLANK_NAMES = "|".join(sorted(name[:-1] for name, text in html5.items() if name.endswith(";") and text in _BLANKS))
_BLANK_NUMBERS = "|".join(f"#0*{ord(b)}(?![0-9])|#[xX]0*(?i:{ord(b):x})(?![0-9A-Fa-f])" for b in _BLANKS)
#: HTML that shows no text: tags, blanks and references to blanks.
_NO_TEXT = rf"^(?:<[^>]*>|[{_BLANKS}]|&(?:(?:{_BLANK_NAMES});|(?:{_BLANK_NUMBERS});?))*+$"
_UNSEEN = r"(?is)<(?:!--.*?-->|(script|style)\b.*?</\1\s*>)"
#: The name of any tag; possessive, since no part of a name ends at a word's end.
ANY_TAG = r"\w++"
#: Numbers 128 to 159 mean the signs of Windows-1252.
_WINDOWS = "".join(bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(128, 160))


@dataclass(frozen=True)
class Opening:
    """An opening tag: its name, the regex of the rest, and plain text that every match contains."""

    tag: str
    rest: str
    hint: str

    @property
    def regex(self) -> str:
        return f"<{self.tag}{self.rest}"


@dataclass(frozen=True)
class Rule:
    """Where a value is; cards without the hint are not searched at all.

    The regex of an element ends with its opening tag, whose name (`element`, maybe a regex) is the first group; the value
    is what the element holds. Otherwise the value is the second group.
    """

    regex: str
    hint: str
    element: str | None = None


def tag_with_class(name: str, tag: str = ANY_TAG, part: bool = False) -> Opening:
    """An opening tag that has class `name` (part=True: a class attribute that contains it)."""
    # Plain letters come before the look behind them, which would else be made at every character.
    word = name if part else rf"{name}(?<![\w-]{name})(?![\w-])"
    return Opening(tag, rf"\b[^>]*?class(?<=\bclass)=[\"'][^\"']*?{word}[^\"']*[\"'][^>]*>", name)


def tag_with_attribute(attribute: str, value: str | None = None, tag: str = ANY_TAG) -> Opening:
    wanted = rf"=[\"']{value}[\"']" if value is not None else r"=[\"'][^\"']*[\"']"
    return Opening(tag, rf"\b[^>]*?\s{attribute}{wanted}[^>]*>", value or attribute)


def text_of(opening: Opening) -> Rule:
    """The inner HTML of the element that `opening` starts."""
    return Rule(rf"(?s)<({opening.tag}){opening.rest}", opening.hint, element=opening.tag)


def attribute_of(opening: Opening, attribute: str) -> Rule:
    """An attribute's value in the tag that `opening` matches."""
    return Rule(rf"(?s)(?={opening.regex})<(\w+)\b[^>]*?\s{attribute}=[\"']([^\"']*)[\"']", opening.hint)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with `value` evaluated one time, however often `use` mentions it."""
    return F.transform(F.array(value), use)[0]


def _sign(number: Column) -> Column:
    """The character of a code point; the replacement character where there is none."""
    known = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    none = (number <= 0) | (number > 0x10FFFF) | number.between(0xD800, 0xDFFF)
    windows = F.substring(F.lit(_WINDOWS), number.cast("int") - 127, F.lit(1))
    return F.when(none, "\ufffd").when(number.between(128, 159), windows).otherwise(known)


def _resolved(piece: Column) -> Column:
    """Text that followed an ampersand, with the reference it starts with replaced; other text gets its ampersand back."""
    number = F.regexp_extract(piece, r"^#(?:0*[0-9]{1,8}(?![0-9])|[xX]0*[0-9A-Fa-f]{1,8}(?![0-9A-Fa-f]))", 0)
    digits = F.regexp_replace(number, "^#[xX]?", "")
    value = F.when(number.rlike("^#[xX]"), F.conv(digits, 16, 10)).otherwise(F.conv(digits, 10, 10)).cast("long")
    name = F.regexp_extract(piece, "^([A-Za-z][A-Za-z0-9]*);", 1)
    text = F.try_element_at(F.str_to_map(F.lit(_NAMES), F.lit("\x01"), F.lit("\x02")), name)
    numbered = F.concat(_sign(value), F.regexp_replace(piece, "^#([0-9]+|[xX][0-9A-Fa-f]+);?", ""))
    named = F.concat(text, F.substring(piece, F.length(name) + 2, F.length(piece)))
    as_is = F.concat(F.lit("&"), piece)
    return F.when(number != "", numbered).when(name != "", F.coalesce(named, as_is)).otherwise(as_is)


def _unescaped(text: Column) -> Column:
    parts = F.split(text, "&")
    rest = F.transform(F.slice(parts, F.lit(2), F.size(parts)), _resolved)
    return F.when(text.contains("&"), F.concat(parts[0], F.array_join(rest, ""))).otherwise(text)


def unescape_all(texts: Sequence[Column]) -> Column:
    """An array of the texts with character references resolved once each: by number, decimal or hexadecimal, or by name
    with its semicolon. The table of names is in the plan once, and rows without an ampersand do not come near it."""
    values = F.array(*texts)
    return F.when(F.concat_ws("", *texts).contains("&"), F.transform(values, _unescaped)).otherwise(values)


def unescape(col: Column) -> Column:
    return unescape_all([col])[0]


def _without_tags(html: Column) -> Column:
    return F.when(html.contains("<"), F.regexp_replace(html, r"<[^>]*>", "")).otherwise(html)


def plain_text(html: Column) -> Column:
    """Tags dropped, references resolved, outer blanks stripped."""
    return F.btrim(unescape(_without_tags(html)), F.lit(_BLANKS))


# --- where an element ends ------------------------------------------------------------------------------------------


def _cut_at_tags(html: Column, tag: Column) -> Column:
    """Pieces of which each, but the first, is what follows the "<" of an opening or closing tag of the name. A tag at the
    very start is part of the first. The "<" is matched and not only looked at: it is tried at every character."""
    return F.split(html, F.concat(F.lit(r"(?i)<(?<!\A<)(?=/?"), tag, F.lit(r"[\s/>])")))


def _name(tag: str, html: Column, opening: str) -> Column:
    return F.regexp_extract(html, opening, 1) if tag == ANY_TAG else F.lit(tag)


def _length_until_closed(pieces: Column, of_closing: Callable[[Column], Column]) -> Column:
    """Characters from inside an element, one level deep at the start of `pieces`, to where it closes: all if it does not.

    `of_closing` says how much of the closing tag and what follows it still counts, given its piece. A state of three numbers runs over the
    pieces; no piece is kept.
    """
    start = F.struct(F.lit(1).alias("depth"), F.length(pieces[0]).alias("length"))

    def step(state: Column, piece: Column) -> Column:
        closing = piece.startswith("/")
        turn = F.when(closing, -1).when(piece.rlike(r"^[^>]*/>"), 0).otherwise(1)
        depth = F.when(state["depth"] == 0, 0).otherwise(state["depth"] + turn)
        more = F.when(state["depth"] == 0, 0).when(depth == 0, of_closing(piece)).otherwise(F.length(piece) + 1)
        return F.struct(depth.cast("int").alias("depth"), (state["length"] + more).cast("int").alias("length"))

    return F.aggregate(F.slice(pieces, F.lit(2), F.size(pieces)), start, step)["length"]


def _with_bracket(closing: Column) -> Column:
    """Characters of a closing tag up to its ">"; none if it has none."""
    end = F.locate(">", closing)
    return F.when(end > 0, end + 1).otherwise(0)


def whole_element(html: Column, tag: str = ANY_TAG) -> Column:
    """The element that `html` starts with, closing tag included; all of it if it is never closed."""
    pieces = _cut_at_tags(html, _name(tag, html, r"^<(\w+)"))
    return _once(pieces, lambda p: F.substring(html, F.lit(1), _length_until_closed(p, _with_bracket)))


def _inside(html: Column, rule: Rule) -> Column:
    """What the first element of the rule holds."""
    tag = _name(rule.element, html, rule.regex)

    def until_closed(rest: Column) -> Column:
        length = lambda p: _length_until_closed(p, lambda _: F.lit(0))
        return _once(_cut_at_tags(rest, tag), lambda p: F.substring(rest, F.lit(2), length(p) - 1))

    # A character in front keeps a tag that comes at once from being taken for the element's own.
    return _once(F.concat(F.lit("."), F.regexp_extract(html, rf"{rule.regex}(.*)$", 2)), until_closed)


def without_element(html: Column, opening: Opening) -> Column:
    """`html` without the first element that `opening` starts."""
    def rest(before: Column) -> Column:
        tail = F.substring(html, F.length(before) + 1, F.length(html))
        after = lambda element: F.substring(tail, F.length(element) + 1, F.length(tail))
        return F.concat(before, _once(whole_element(tail, opening.tag), after))

    return F.when(html.rlike(opening.regex), _once(F.regexp_extract(html, rf"(?s)^(.*?){opening.regex}", 1), rest)).otherwise(html)


# --- cards and fields -----------------------------------------------------------------------------------------------


def _quick(card: Column, rule: Rule) -> Column:
    """What one rule finds, an element up to the first closing tag of its name; '' when it finds nothing."""
    regex = rf"{rule.regex}(.*?)</\1\s*>" if rule.element else rule.regex
    return F.when(card.contains(rule.hint), F.regexp_extract(card, regex, 2)).otherwise("")


def _exact(card: Column, rule: Rule, quick: Column) -> Column:
    """What was found quickly, or the element's whole content if it holds elements of its own name."""
    if not rule.element:
        return quick
    same = F.concat(F.lit("(?i)<"), _name(rule.element, card, rule.regex), F.lit(r"[\s/>]"))
    return F.when(quick.contains("<") & F.rlike(quick, same), _inside(card, rule)).otherwise(quick)


def _is_there(card: Column, rule: Rule) -> Column:
    """'' when the element is there (but empty), else NULL."""
    return F.when(card.contains(rule.hint) & card.rlike(rule.regex), F.lit(""))


@dataclass(frozen=True)
class CardLayout:
    """Where cards start (fallbacks in order) and the rules of their fields, in order of trust.

    A start is a card's opening tag, or (container, opening tag) for cards after a container's tag. A card ends with its
    element.
    """

    starts: Sequence[Opening | tuple[Opening, Opening]]
    texts: Mapping[str, Sequence[Rule]]
    attributes: Mapping[str, Sequence[Rule]] = field(default_factory=dict)

    @property
    def rules(self) -> dict[str, Sequence[Rule]]:
        return {**self.texts, **self.attributes}

    def has_value(self, name: str, found: Column) -> Column:
        """Whether a rule's find counts, or the next rule is asked."""
        return (found != "") & ~found.rlike(_NO_TEXT) if name in self.texts else found != ""


def cards(html: Column, layout: CardLayout) -> Column:
    """array<string> of card HTML, by the first start rule that finds any."""
    unseen = html.contains("<!--") | html.rlike("(?i)<(?:script|style)")
    seen = F.when(unseen, F.regexp_replace(html, _UNSEEN, "")).otherwise(html)

    def pieces(page: Column, start: Opening | tuple[Opening, Opening]) -> Column:
        if isinstance(start, tuple):
            container, start = start
            page = F.regexp_extract(page, rf"(?s){container.regex}(.*)$", 1)
        parts = F.split(page, rf"(?s)<(?={start.regex[1:]})")
        chunks = F.transform(F.slice(parts, F.lit(2), F.size(parts)), lambda p: F.concat(F.lit("<"), p))
        return F.transform(F.filter(chunks, lambda c: c.rlike(rf"(?s)^{start.regex}")), lambda c: whole_element(c, start.tag))

    def first_found(page: Column) -> Column:
        found = [_once(pieces(page, start), lambda f: F.when(F.size(f) > 0, f)) for start in layout.starts]
        return F.coalesce(*found, F.array().cast("array<string>"))

    return _once(seen, first_found)


def _cleaned(found: Mapping[str, Column], layout: CardLayout) -> Column:
    """Array of the fields' values: texts without tags, references resolved."""
    return unescape_all([_without_tags(v) if n in layout.texts else v for n, v in found.items()])


def _shown(values: Column, layout: CardLayout) -> list[Column]:
    trimmed = lambda n, v: F.btrim(v, F.lit(_BLANKS)) if n in layout.texts else v
    return [trimmed(n, values[i]).alias(n) for i, n in enumerate(layout.rules)]


def card_fields(card: Column, layout: CardLayout) -> Column:
    """struct with one string per field of the layout, for use inside array functions."""

    def chosen(name: str, rules: Sequence[Rule]) -> Column:
        exact = [_once(_quick(card, r), lambda q: _exact(card, r, q)) for r in rules]  # noqa: B023
        filled = [_once(value, lambda v: F.when(layout.has_value(name, v), v)) for value in exact]
        return F.coalesce(*filled, _is_there(card, rules[-1]))

    values = _cleaned({n: chosen(n, rules) for n, rules in layout.rules.items()}, layout)
    return _once(values, lambda v: F.struct(*_shown(v, layout)))


def with_fields(cards: DataFrame, card: str, layout: CardLayout, keep: Sequence[str]) -> DataFrame:
    """`keep` and one column per field, for a table of cards.

    Rules are tried in turn, and finding, bounding and choosing are separate steps, so that a regex runs at most once per
    card and a fallback only where the rules before it found nothing. References are resolved at the end, once per card.
    """
    html, names = F.col(card), list(layout.rules)
    step = cards.select(*keep, card, *[F.lit("").alias(n) for n in names])
    for turn in range(max(len(rules) for rules in layout.rules.values())):
        active = {n: rules[turn] for n, rules in layout.rules.items() if turn < len(rules)}
        open_ = lambda n: F.col(n) == "" if turn else F.lit(True)  # noqa: E731, B023
        found = [F.when(open_(n), _quick(html, r)).otherwise("").alias(f"_{n}") for n, r in active.items()]
        step = step.select(*keep, card, *names, *found)
        exact = [_exact(html, r, F.col(f"_{n}")).alias(f"_{n}") for n, r in active.items()]
        step = step.select(*keep, card, *names, *exact)
        chosen = {n: F.when(layout.has_value(n, F.col(f"_{n}")), F.col(f"_{n}")).otherwise(F.col(n)) for n in active}
        step = step.select(*keep, card, *[chosen.get(n, F.col(n)).alias(n) for n in names])
    last = {n: F.when(F.col(n) != "", F.col(n)).otherwise(_is_there(html, rules[-1])) for n, rules in layout.rules.items()}
    step = step.select(*keep, *[v.alias(n) for n, v in last.items()])
    step = step.select(*keep, _cleaned({n: F.col(n) for n in names}, layout).alias("_values"))
    return step.select(*keep, *_shown(F.col("_values"), layout))
