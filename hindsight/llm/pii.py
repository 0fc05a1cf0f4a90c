"""Personal data: patterns propose, checksums confirm, nearby words adjust the score.

Each kind has a pattern, a test of the match (digits, Luhn, mod 97, ranges), a
score to begin with and words that raise it when they stand near. Kinds marked
``always`` are reported whenever the test holds; the others only from
``LEAST_SCORE`` on. Everything is a DataFrame function.

Patterns take the longest run there is and never look back into it (possessive
quantifiers), so that texts of one endless word cost one pass.

Edge cases: null texts count as empty and have no spans; texts are matched from
end to end; repeated rows are reported each.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hindsight.llm.spans import with_spans

LEAST_SCORE = 0.7
#: Characters before and after a match in which words count as near, and what they add.
NEAR, BONUS = 40, 0.3


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def characters(value: Column) -> Column:
    return F.regexp_extract_all(value, F.lit("."), F.lit(0))


def luhn(number: Column) -> Column:
    """Whether the digits' checksum, every second from the right doubled, ends in 0."""

    def cell(d: Column, i: Column) -> Column:
        v = d.cast("int") * (1 + i % 2)
        return v - F.when(v > 9, 9).otherwise(0)

    cells = F.transform(characters(F.reverse(number)), cell)
    return F.aggregate(cells, F.lit(0), lambda total, v: total + v) % 10 == 0


def mod97(value: Column) -> Column:
    """Whether an account number, its first four characters moved to the end and letters counted from 10, leaves 1."""
    plain = F.replace(value, F.lit(" "), F.lit(""))
    moved = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))
    codes = F.transform(characters(moved), lambda c: F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), c) - 1)
    return F.aggregate(codes, F.lit(0), lambda r, v: (r * F.when(v > 9, 100).otherwise(10) + v) % 97) == 1


def between(least: int, most: int) -> Callable[[Column], Column]:
    return lambda value: F.length(digits(value)).between(least, most)


def octets(value: Column) -> Column:
    """Whether all parts, without leading zeros, are at most 255."""

    def small(part: Column) -> Column:
        plain = F.ltrim(part, F.lit("0"))
        return (F.length(plain) <= 3) & (F.lpad(plain, 3, "0") <= "255")

    return F.forall(F.split(value, "[.]"), small)


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    holds: Callable[[Column], Column]
    score: float
    words: tuple[str, ...]
    always: bool = False


LOCAL = "A-Za-z0-9._%+-"
KINDS = [
    Kind("email", rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", lambda v: F.lit(True), 0.7, ("mail", "contact"), True),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}", octets, 0.6, ("ip", "address", "host", "server"), True),
    Kind("card", r"[0-9](?:[ -]?[0-9]){15,}+", lambda v: between(16, 19)(v) & luhn(digits(v)), 0.7, ("card", "visa", "credit", "payment"), True),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", between(8, 15), 0.6, ("phone", "call", "tel", "mobile", "fax"), True),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])", mod97, 0.8, ("iban", "account", "bank")),
    Kind("short_card", r"(?<![0-9+-])[0-9](?:[ -]?[0-9]){12,14}(?![0-9-])", lambda v: luhn(digits(v)), 0.5, ("card", "amex", "credit", "payment")),
    Kind(
        "national_id", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        lambda v: ~v.rlike("^(?:000|666|9)") & ~v.rlike("-00-|-0000$"), 0.4, ("ssn", "social security", "tax id"),
    ),
]


def find(docs: DataFrame, kinds: list[Kind] = KINDS) -> DataFrame:
    """(doc_id, spans) of every row: kind, start, end, value, score, by kind as listed and then by start."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_spans(rows, "text", {f"k{i}": k.pattern for i, k in enumerate(kinds)})

    def scored(kind: Kind, s: Column) -> Column:
        before = F.substring(F.col("text"), F.greatest(F.lit(1), s["start"] + 1 - NEAR).cast("int"), F.least(F.lit(NEAR), s["start"]).cast("int"))
        after = F.substring(F.col("text"), (s["end"] + 1).cast("int"), F.lit(NEAR))
        near = F.lower(F.concat_ws(" ", before, after))
        helps = near.rlike(r"\b(?:" + "|".join(kind.words) + ")")
        return F.struct(
            F.lit(kind.name).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"),
            F.least(F.lit(1.0), F.lit(kind.score) + F.when(helps, BONUS).otherwise(0.0)).alias("score"),
        )

    def of(i: int, kind: Kind) -> Column:
        true = F.filter(F.col(f"k{i}"), lambda s: kind.holds(s["value"]))
        spans = F.transform(true, lambda s: scored(kind, s))
        return spans if kind.always else F.filter(spans, lambda s: s["score"] >= LEAST_SCORE)

    return rows.select("doc_id", F.concat(*[of(i, k) for i, k in enumerate(kinds)]).alias("spans"))
