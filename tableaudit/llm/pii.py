"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Everything is a column expression.  A pattern's places come from the pieces
between its matches: ``split`` and ``regexp_extract_all`` cut the text at the
same matches, so a match starts where the pieces and matches before it end.

The patterns are those of the contract, written so that the regex engine neither
backtracks nor recurses on long runs: repeats whose end is certain are
possessive, and an attempt starts only where a run starts or the last match
ended (``\\G``), since an attempt inside a run fails as the one before did.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What the base kinds match.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Kinds added by this method.
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"

SPAN = "array<struct<kind:string,start:long,end:long,score:double>>"
NEAR = 40


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the digits pass Luhn's check: every second one from the right is doubled."""
    at = F.sequence(F.lit(1), F.length(digits))
    place = lambda i: F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
    total = F.aggregate(
        at,
        F.lit(0),
        lambda s, i: s + F.when(i % 2 == 1, place(i)).otherwise(2 * place(i) - F.when(place(i) > 4, 9).otherwise(0)),
    )
    return total % 10 == 0


def _card(match: Column) -> Column:
    return F.length(_digits(match)).between(12, 19) & _luhn(_digits(match))


def _ip(match: Column) -> Column:
    short = lambda part: F.ltrim(part, F.lit("0"))
    return F.forall(
        F.split(match, r"\."),
        lambda part: (F.length(short(part)) <= 3)
        & (F.coalesce(F.when(F.length(short(part)) <= 3, short(part)).try_cast("int"), F.lit(0)) <= 255),
    )


def _phone(match: Column) -> Column:
    return F.length(_digits(match)).between(9, 15)


def _iban(match: Column) -> Column:
    """ISO 7064 mod 97: the first four characters go last, letters count from A = 10, the rest must be 1."""
    plain = F.replace(match, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))
    value = lambda i: F.conv(F.substring(turned, i, F.lit(1)), 36, 10).cast("int")
    rest = F.aggregate(
        F.sequence(F.lit(1), F.length(turned)),
        F.lit(0),
        lambda s, i: F.when(value(i) > 9, s * 100 + value(i)).otherwise(s * 10 + value(i)) % 97,
    )
    return F.length(plain).between(15, 34) & (rest == 1)


def _ssn(match: Column) -> Column:
    """Areas 000, 666 and 9xx, group 00 and serial 0000 are never issued."""
    return ~match.rlike(r"^(?:000|666|9)|-00-|-0000$")


@dataclass(frozen=True)
class Kind:
    """A kind of personal data.  ``needs`` is text without which there is no match; ``words`` raise the score."""

    name: str
    pattern: str
    valid: Callable[[Column], Column] | None
    needs: str | None
    score: float
    words: str


BASE = (
    Kind("email", EMAIL, None, "@", 0.9, r"(?i)e-?mail|contact|courriel|correo|write"),
    Kind("ip", IP, _ip, ".", 0.6, r"(?i)\bip\b|address|server|host|adresse"),
    Kind("card", CARD, _card, None, 0.7, r"(?i)card|visa|credit|carte|karte|tarjeta|payment"),
    Kind("phone", PHONE, _phone, "+", 0.7, r"(?i)phone|call|tel|mobile|fax|anruf"),
)
ADDED = (
    Kind("iban", IBAN, _iban, None, 0.8, r"(?i)iban|account|bank|konto|compte|cuenta"),
    Kind("ssn", SSN, _ssn, "-", 0.5, r"(?i)ssn|social security"),
)


def _proposed(text: Column, kind: Kind) -> Column:
    """Every match with its start, in code points: (start, end, match)."""
    pieces, found = F.split(text, kind.pattern, -1), F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    step = F.aggregate(
        F.arrays_zip(pieces.alias("piece"), found.alias("match")),
        F.struct(
            F.lit(0).cast("long").alias("at"),
            F.array().cast("array<struct<start:long,end:long,match:string>>").alias("out"),
        ),
        lambda s, x: F.when(
            x["match"].isNotNull(),
            F.struct(
                (s["at"] + F.length(x["piece"]) + F.length(x["match"])).alias("at"),
                F.concat(
                    s["out"],
                    F.array(
                        F.struct(
                            (s["at"] + F.length(x["piece"])).alias("start"),
                            (s["at"] + F.length(x["piece"]) + F.length(x["match"])).alias("end"),
                            x["match"].alias("match"),
                        )
                    ),
                ).alias("out"),
            ),
        ).otherwise(s),
    )["out"]
    none = F.array().cast("array<struct<start:long,end:long,match:string>>")
    here = text.rlike(kind.pattern)
    if kind.needs:
        here = (F.instr(text, kind.needs) > 0) & here
    return F.when(here, step).otherwise(none)


def _confirmed(text: Column, kind: Kind, proposed: Column) -> Column:
    """The matches that pass the kind's check, scored by the words before and after."""

    def score(m: Column) -> Column:
        left = F.greatest(m["start"] - NEAR, F.lit(0))
        before = F.substring(text, (left + 1).cast("int"), (m["start"] - left).cast("int"))
        after = F.substring(text, (m["end"] + 1).cast("int"), F.lit(NEAR))
        near = F.concat(before, F.lit(" "), after).rlike(kind.words)
        return F.round(F.lit(kind.score) + F.when(near, F.lit(1 - kind.score) / 2).otherwise(F.lit(0.0)), 4)

    good = F.filter(proposed, lambda m: kind.valid(m["match"])) if kind.valid else proposed
    return F.transform(
        good,
        lambda m: F.struct(
            F.lit(kind.name).alias("kind"), m["start"].alias("start"), m["end"].alias("end"), score(m).alias("score")
        ),
    )


def _ranked(spans: Column, place: int) -> Column:
    return F.transform(
        spans, lambda m: F.struct(m["start"].alias("start"), F.lit(place).alias("k"), m.alias("m"))
    )


def personal_data(docs: DataFrame, kinds: tuple[Kind, ...] = BASE + ADDED) -> DataFrame:
    """For each document (doc_id, text) its spans: array of (kind, start, end, score).

    Starts and ends count code points, ends are exclusive; spans are ordered by
    start, then by the order of ``kinds``.  Matches of one kind do not overlap,
    those of different kinds may.  Null and empty texts have no spans; repeated
    rows give repeated results; an empty table gives none.  Other columns are not
    read.
    """
    work = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    work = work.select("*", *[_proposed(F.col("text"), k).alias(f"p{i}") for i, k in enumerate(kinds)])
    work = work.select(
        "doc_id", *[_confirmed(F.col("text"), k, F.col(f"p{i}")).alias(f"c{i}") for i, k in enumerate(kinds)]
    )
    ordered = F.array_sort(
        F.concat(
            *[_ranked(F.col(f"c{i}"), i) for i in range(len(kinds))]
        )
    )
    return work.select("doc_id", F.transform(ordered, lambda x: x["m"]).cast(SPAN).alias("spans"))


def span_digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, a hash of their spans, and all spans as text."""
    base = [k.name for k in BASE]
    listed = lambda spans: F.array_join(
        F.transform(
            spans,
            lambda m: F.concat_ws(":", m["kind"], m["start"].cast("string"), m["end"].cast("string")),
        ),
        ",",
    )
    count = lambda kind: F.size(F.filter("spans", lambda m: m["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[count(k) for k in base],
        F.sha2(listed(F.filter("spans", lambda m: m["kind"].isin(base))), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        F.coalesce(F.array_max(F.transform("spans", lambda m: m["score"])), F.lit(0.0)).alias("top_score"),
    )
