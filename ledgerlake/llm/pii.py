"""Personal data in texts: patterns propose spans, checksums confirm them, context adjusts the score.

Everything is column expressions: no Python runs on the executors and nothing is shuffled.

Base kinds, leftmost and non-overlapping for each kind, as the fixed patterns have them:

* ``email`` and ``phone`` (9 to 15 digits), ``ip`` (four parts of at most 255), ``card`` (12 to
  19 digits that pass Luhn). A match that fails its check is dropped and not tried again.

Added kinds:

* ``iban``: country letters, check digits and as many letters or digits as the country has,
  in groups or not, that pass mod 97. Of a country not listed, 11 to 30, as many of the groups
  as pass.
* ``card_part``: a group of 13 to 19 digits in a longer run of digit groups (such as a number
  given twice) that passes Luhn; the run as a whole is no card.
* ``ssn``: three, two and four digits with hyphens, other than the ranges never issued.
* ``secret``: a quoted value of at least 16 characters assigned to a name such as token or key.

Each span has a score: what its kind is worth by itself, plus ``NEARBY`` if a word for that
kind stands in the ``WINDOW`` characters before it. Base spans always stay; added ones
stay if their score is at least ``LEAST``.

The patterns for Spark find what the fixed ones find, but start at the first character of a
run only and try only candidates of a fitting length, so that long runs cost linear time.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import whole_text

WINDOW = 40
NEARBY = 0.3
LEAST = 0.6

Check = Callable[[Column], Column]

#: Lengths of account numbers by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban_pattern() -> str:
    listed = []
    for length, countries in IBAN_LENGTHS.items():
        groups, rest = divmod(length - 4, 4)
        tail = rf"[ ]?[A-Z0-9]{{{rest}}}" if rest else ""
        listed.append(rf"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?:[ ]?[A-Z0-9]{{4}}){{{groups}}}{tail}")
    others = rf"(?!{'|'.join(IBAN_LENGTHS.values()).replace(' ', '|')})[A-Z]{{2}}[0-9]{{2}}(?:[ ]?[A-Z0-9]{{4}}){{2,7}}(?:[ ]?[A-Z0-9]{{1,3}})?"
    return rf"\b(?:{'|'.join(listed)}|{others})\b"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(match: Column) -> Column:
    """Whether the digits of ``match`` pass Luhn's check."""
    digits = F.reverse(_digits(match))
    each = F.transform(
        F.split(digits, "(?<=.)(?=.)"),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)
        ),
    )
    return F.aggregate(each, F.lit(0), lambda total, d: total + d) % 10 == 0


def mod_97(match: Column) -> Column:
    """Whether an account number passes the mod-97 check."""
    plain = F.upper(F.regexp_replace(match, "[^0-9A-Za-z]", ""))
    turned = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))
    values = F.transform(
        F.split(turned, "(?<=.)(?=.)"),
        lambda c: F.when(c.rlike("[0-9]"), c.cast("string")).otherwise((F.ascii(c) - 55).cast("string")),
    )
    rest = F.aggregate(
        values,
        F.lit(0),
        lambda total, v: (total * F.when(F.length(v) == 2, 100).otherwise(10) + v.cast("int")) % 97,
    )
    return rest == 1


def _account_in(match: Column) -> Column:
    """The longest beginning of ``match``, up to the end of a group, that passes mod 97; null if none."""
    groups = F.split(match, " ")
    beginnings = F.transform(F.sequence(F.size(groups), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(groups, 1, n), " "))
    long_enough = F.filter(beginnings, lambda part: F.length(F.replace(part, F.lit(" "), F.lit(""))) >= min(IBAN_LENGTHS))
    return F.get(F.filter(long_enough, mod_97), F.lit(0))


def _parts_at_most_255(match: Column) -> Column:
    numbers = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
    return F.forall(numbers, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= F.lit("255"))))


def _digit_count(low: int, high: int) -> Check:
    return lambda match: F.length(_digits(match)).between(low, high)


@dataclass(frozen=True)
class Kind:
    """A kind of personal data.

    ``gate``: a pattern that every text with a match of this kind has, cheap to look for.
    ``part``: what of a match the span is, a beginning of it; null if it is none.
    """

    name: str
    gate: str
    pattern: str
    check: Check | None
    worth: float
    words: str
    base: bool = False
    part: Callable[[Column], Column] | None = None


_LOCAL = "[A-Za-z0-9._%+-]"

KINDS = [
    Kind("email", "@", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", None, 0.9,
         "mail|contact|write", base=True),
    Kind("ip", r"[0-9]\.[0-9]", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", _parts_at_most_255, 0.7,
         r"\bip\b|address|host|server", base=True),
    Kind("card", "[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9]",
         r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}+(?![ -]?[0-9])", luhn, 0.7,
         "card|visa|credit|pay", base=True),
    Kind("phone", r"\+[0-9]", r"\+[0-9][ ().0-9-]+[0-9]", _digit_count(9, 15), 0.8,
         "phone|call|tel|mobile|fax", base=True),
    Kind("iban", r"[A-Z]{2}[0-9]{2}",
         _iban_pattern(), None, 0.8, "iban|account|konto|bank", part=_account_in),
    Kind("card_part", "[0-9]{13}[ -][0-9]|[0-9][ -][0-9]{13}",
         r"(?<![0-9])[0-9]{13,19}(?=[ -][0-9])|(?<=[0-9][ -])[0-9]{13,19}(?![0-9])", luhn, 0.6, "card|visa|credit|pay"),
    Kind("ssn", "[0-9]{3}-[0-9]{2}-[0-9]{4}",
         r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])", None, 0.5, "ssn|social|security"),
    Kind("secret", "[=:]", r"(?i)(?<![a-z])(?:token|secret|password|passwd|api[_-]?key|access[_-]?key)[ ]{0,4}[=:][ ]{0,4}\"[^\"\s]{16,}\"",
         None, 0.8, "secret|key"),
]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)``, with the value computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


#: Items that are gathered by appending, and characters in a piece of a text.
STRETCH, PIECE = 256, 256


def _running(items: Column, kind: str, step: Callable[[Column, Column], Column]) -> Column:
    """What ``step(at, item)`` gives for each item, in order: its ``out``, of type ``kind``.

    Its ``at`` is what the next item is given, 0 for the first. Appending copies an array, so
    items are gathered by stretches, and these are laid end to end.
    """

    def gathered(array: Column, of: str, at: Column, one: Callable[[Column, Column], Column]) -> Column:
        start = F.struct(F.array().cast(f"array<{of}>").alias("out"), at.alias("at"))

        def add(seen: Column, item: Column) -> Column:
            appended = lambda new: F.struct(F.concat(seen["out"], F.array(new["out"])).alias("out"), new["at"].alias("at"))
            return _let(one(seen["at"], item), appended)

        return F.aggregate(array, start, add)

    def all_of(whole: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(whole) / STRETCH).cast("int") - 1, F.lit(0)))
        stretch = lambda at, k: gathered(F.slice(whole, k * STRETCH + 1, STRETCH), kind, at, step)
        return F.flatten(gathered(numbers, f"array<{kind}>", F.lit(0).cast("bigint"), stretch)["out"])

    return _let(items, all_of)


def _pieces(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def _between(pieces: Column, begin: Column, end: Column) -> Column:
    """The characters from ``begin`` to before ``end`` of a text in pieces, whatever lies before them."""
    first, last = F.floor(begin / PIECE), F.floor((end - 1) / PIECE)
    held = F.slice(pieces, (first + 1).cast("int"), F.greatest(last - first + 1, F.lit(0)).cast("int"))
    return F.substring(F.array_join(held, ""), (begin - first * PIECE + 1).cast("int"), (end - begin).cast("int"))


def _candidates(text: Column, kind: Kind) -> Column:
    """Array of (start, end, match) of all matches of the kind's pattern, in order.

    Start and end are code points, the end exclusive: the pieces between the matches and the
    matches themselves, laid end to end, give the places.
    """
    between = F.split(text, kind.pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    lengths = F.zip_with(between, matches, lambda gap, match: F.struct(F.length(gap).alias("gap"), match.alias("match")))
    span = "struct<start:bigint,end:bigint,match:string>"

    def place(at: Column, one: Column) -> Column:
        begin = at + one["gap"]
        end = begin + F.length(one["match"])
        found = F.struct(begin.alias("start"), end.alias("end"), one["match"].alias("match"))
        return F.struct(found.alias("out"), end.alias("at"))

    with_match = F.filter(lengths, lambda one: one["match"].isNotNull())
    found = _running(with_match, span, place)
    return F.when(text.rlike(kind.gate), found).otherwise(F.array().cast(f"array<{span}>"))


def _confirmed(found: Column, pieces: Column, kind: Kind) -> Column:
    """(start, rank, kind, end, score) of the kind's spans that pass its check."""
    if kind.check is not None:
        found = F.filter(found, lambda span: kind.check(span["match"]))
    if kind.part is not None:
        parts = F.transform(found, lambda span: F.struct(span["start"].alias("start"), kind.part(span["match"]).alias("match")))
        parts = F.filter(parts, lambda span: span["match"].isNotNull())
        found = F.transform(
            parts,
            lambda span: F.struct(
                span["start"].alias("start"), (span["start"] + F.length(span["match"])).alias("end"), span["match"].alias("match")
            ),
        )
    rank = next(k for k, other in enumerate(KINDS) if other.name == kind.name)

    def scored(span: Column) -> Column:
        before = _between(pieces, F.greatest(span["start"] - WINDOW, F.lit(0)), span["start"])
        near = before.rlike(f"(?i){kind.words}")
        score = F.least(F.lit(1.0), F.lit(kind.worth) + F.when(near, F.lit(NEARBY)).otherwise(F.lit(0.0)))
        return F.struct(
            span["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind.name).alias("kind"),
            span["end"].alias("end"), score.alias("score"),
        )

    spans = F.transform(found, scored)
    return spans if kind.base else F.filter(spans, lambda span: span["score"] >= LEAST)


def joined(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _spanned(docs: DataFrame, text: str, into: str) -> DataFrame:
    """``docs`` with the spans, and the text in pieces as ``__pii_pieces``, null where it has no candidate."""
    columns = {kind.name: f"__pii_{kind.name}" for kind in KINDS}
    held = docs.withColumn("__pii_whole", whole_text(text))
    held = held.withColumns({columns[kind.name]: _candidates(F.col("__pii_whole"), kind) for kind in KINDS})
    some = F.greatest(*[F.size(c) for c in columns.values()]) > 0
    held = held.withColumn("__pii_pieces", F.when(some, _pieces(F.col("__pii_whole"))))
    held = held.withColumns({columns[kind.name]: _confirmed(F.col(columns[kind.name]), F.col("__pii_pieces"), kind) for kind in KINDS})
    return held.withColumn(into, F.sort_array(F.concat(*columns.values()))).drop("__pii_whole", *columns.values())


def with_spans(docs: DataFrame, text: str = "text", into: str = "pii_spans") -> DataFrame:
    """``docs`` with a column of spans: start, rank, kind, end, score, sorted by start, then kind.

    Null texts count as empty and have no span. The cost of a span doesn't grow with the spans or
    the text before it. ``docs`` must not have columns that start with ``__pii``.
    """
    return _spanned(docs, text, into).drop("__pii_pieces")


def _number_of(kind: str) -> Column:
    return F.size(F.filter("found", lambda span: span["kind"] == kind)).cast("long")


def detected(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, scored_spans.

    ``docs`` needs doc_id and text; other columns, clashing names included, are ignored.
    Without spans the strings are empty, and base_sha256 is that of the empty string.
    """
    spanned = with_spans(docs.select("doc_id", "text"), "text", "found")
    base = F.filter("found", lambda span: span["rank"] < sum(kind.base for kind in KINDS))
    counts = [_number_of(kind.name).alias(f"n_{kind.name}") for kind in KINDS if kind.base]
    return spanned.select(
        "doc_id",
        *counts,
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
        F.array_join(
            F.transform("found", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"], F.format_number(s["score"], 2))),
            ",",
        ).alias("scored_spans"),
    )


def masked(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind, as in ``[EMAIL]``.

    Where spans overlap, one mark stands for them all, the first one's. Texts without spans,
    null ones too, stay as they are. ``docs`` must not have columns that start with ``__pii``.
    """
    spanned = _spanned(docs, text, "__pii")
    pieces = F.col("__pii_pieces")

    def put(at: Column, span: Column) -> Column:
        mark = F.concat(_between(pieces, at, span["start"]), F.lit("["), F.upper(span["kind"]), F.lit("]"))
        part = F.when(span["start"] >= at, mark).otherwise(F.lit(""))
        return F.struct(part.alias("out"), F.greatest(at, span["end"]).alias("at"))

    last = F.array_max(F.transform("__pii", lambda span: span["end"]))
    tail = _between(pieces, last, F.length(whole_text(text)).cast("bigint"))
    cleaned = F.array_join(F.concat(_running(F.col("__pii"), "string", put), F.array(tail)), "")
    return spanned.withColumn(text, F.when(F.size("__pii") > 0, cleaned).otherwise(F.col(text))).drop("__pii", "__pii_pieces")
