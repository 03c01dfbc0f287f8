"""Personal data in texts, in built-in expressions only.

Regular expressions propose spans, validators (Luhn for cards, the remainder
modulo 97 for account numbers, ranges and digit counts) confirm them, and words
near a span move its score. A text is one row throughout: nothing is shuffled.

Patterns are written so that a scan is linear in the text: repeats that can't
give characters back to what follows are possessive, and a run of characters is
only entered at its start or where the match before it ended. Positions come
from the pieces between matches, whose lengths are summed up in chunks.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomfeed.llm.common import only, unused, without

# The four base kinds in their order, and their patterns.
BASE_KINDS = ("email", "ip", "card", "phone")
_LOCAL = "A-Za-z0-9._%+-"
EMAIL = rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}"
#: Thirteen digits and more; fewer are no card of any kind.
CARD = r"[0-9](?:[\x20-]?[0-9]){12,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

ACCOUNT = (
    r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)(?![A-Za-z0-9])"
)
NATIONAL = r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])"
LOCAL_PHONE = r"(?<![0-9)+-])(?<!\+[0-9]{1,3}\x20)(?:\([0-9]{2,5}\)\x20?|0[0-9]{2,4}[\x20-])[0-9]{3,4}[\x20-]?[0-9]{3,4}(?![0-9])"

PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
#: Characters looked at before and after a span.
BEFORE, AFTER = 48, 24
#: Score from which a span that is not a base one is reported.
LEAST = 0.6
#: Spans whose places are summed up together.
CHUNK = 128


@dataclass(frozen=True)
class Kind:
    """One kind of personal data: proposals, their check, and how sure a span is.

    ``check`` gives true where a match is confirmed; ``base`` tells base spans
    among the confirmed ones, which are kept at any score.
    """

    name: str
    pattern: str
    check: Callable[[Column], Column]
    score: float
    words: str
    base: Callable[[Column], Column] | None = None
    must_hold: str | None = None


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(match: Column) -> Column:
    return F.call_function("luhn_check", digits(match))


def mod_97(match: Column) -> Column:
    """Remainder of an account number: four characters go to the end, letters count 10 to 35."""
    text = F.replace(match, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(text, 5, 60), F.substring(text, 1, 4))
    code = lambda c: F.ascii(c) - F.when(c >= "A", 55).otherwise(48)
    return F.aggregate(
        F.split(turned, ""),
        F.lit(0),
        lambda done, c: ((done * F.when(c >= "A", 100).otherwise(10) + code(c)) % 97).cast("int"),
    )


def _count(least: int, most: int) -> Callable[[Column], Column]:
    return lambda match: F.length(digits(match)).between(least, most)


def _address(match: Column) -> Column:
    return match.rlike(rf"^(?:{PART}\.){{3}}{PART}$")


KINDS = (
    Kind("email", EMAIL, lambda m: F.lit(True), 0.9, "mail|contact|write|address", lambda m: F.lit(True), "@"),
    Kind("ip", IP, _address, 0.6, r"\bip\b|host|server|address|login", lambda m: F.lit(True), "."),
    Kind(
        "card",
        CARD,
        # thirteen digits are a card only of one issuer, and only beside a word that says so
        lambda m: luhn(m) & (_count(14, 19)(m) | (_count(13, 13)(m) & digits(m).startswith("4"))),
        0.5,
        "card|visa|credit|debit|amex|payment",
        _count(14, 19),
    ),
    Kind("phone", PHONE, _count(10, 15), 0.7, "phone|tel|call|mobile|fax", lambda m: F.lit(True), "+"),
    Kind("account", ACCOUNT, lambda m: mod_97(m) == 1, 0.8, "iban|account|konto|bank"),
    Kind("national_id", NATIONAL, lambda m: F.lit(True), 0.4, r"\bssn\b|social security|tax|passport", None, "-"),
    Kind("local_phone", LOCAL_PHONE, _count(9, 13), 0.4, "phone|tel|call|mobile|fax"),
)
#: Words that make a number something else.
COUNTER = r"order|invoice|version|isbn|tracking|serial|\bref\b"


def running(values: Column) -> Column:
    """0 and the sums of the values up to each."""
    start = F.array(F.lit(0).cast("long"))
    return F.aggregate(values, start, lambda done, x: F.concat(done, F.array(F.element_at(done, -1) + x)))


def _sums(df: DataFrame, values: str, out: str) -> DataFrame:
    """``df`` with the sum of the values before each, added up in chunks so that long
    lists cost no more each; ``values`` is a column, referred to more than once, so it
    is computed once."""
    n = F.size(values)
    chunks = F.transform(
        F.sequence(F.lit(0), F.expr(f"cast(greatest(size(`{values}`) - 1, 0) div {CHUNK} as int)")),
        lambda k: running(F.slice(values, (k * CHUNK + 1).cast("int"), CHUNK)),
    )
    within = df.withColumn(out, F.when(n > 0, chunks))
    heads = running(F.transform(out, lambda c: F.element_at(c, -1)))
    paired = F.arrays_zip(F.col(out).alias("chunk"), heads.alias("head"))
    added = F.transform(
        paired, lambda z: F.transform(F.slice(z["chunk"], 1, F.size(z["chunk"]) - 1), lambda v: v + z["head"])
    )
    # the last entry of heads is the total and has no chunk
    sums = F.flatten(F.filter(added, lambda a: a.isNotNull()))
    return within.withColumn(out, F.coalesce(sums, F.array().cast("array<long>")))


def _spans(df: DataFrame, text: str, order: int, kind: Kind, out: str) -> DataFrame:
    """``df`` with the confirmed spans of one kind."""
    names = df.columns
    found, gaps, steps, starts = (unused(df, f"{out}_{n}") for n in ("found", "gaps", "steps", "starts"))
    pattern = F.lit(kind.pattern)
    matches = F.regexp_extract_all(F.col(text), pattern, F.lit(0))
    if kind.must_hold:
        matches = F.when(F.col(text).contains(kind.must_hold), matches)
    df = df.withColumn(found, F.coalesce(matches, F.array().cast("array<string>")))
    pieces = F.transform(
        F.split(F.col(text), kind.pattern, -1),
        lambda g: F.struct(
            F.length(g).alias("size"),
            F.substring(g, -BEFORE, BEFORE).alias("tail"),
            F.substring(g, 1, AFTER).alias("head"),
        ),
    )
    df = df.withColumn(gaps, F.when(F.size(found) > 0, pieces))
    df = df.withColumn(
        steps, F.transform(found, lambda m, i: (F.get(F.col(gaps), i)["size"] + F.length(m)).cast("long"))
    )
    df = _sums(df, steps, starts)

    def span(pair: Column, i: Column) -> Column:
        match, before, after = pair["match"], F.get(F.col(gaps), i), F.get(F.col(gaps), i + 1)
        start = pair["start"] + before["size"]
        near = F.lower(F.concat_ws(" ", before["tail"], after["head"]))
        score = (
            F.lit(kind.score)
            + F.when(near.rlike(kind.words), 0.3).otherwise(0.0)
            - F.when(near.rlike(COUNTER), 0.3).otherwise(0.0)
        )
        base = kind.base(match) if kind.base else F.lit(False)
        return F.struct(
            start.alias("start"),
            F.lit(order).alias("order"),
            (start + F.length(match)).alias("stop"),
            F.lit(kind.name).alias("kind"),
            base.alias("base"),
            F.least(F.lit(1.0), score).alias("score"),
            kind.check(match).alias("sure"),
        )

    pairs = F.arrays_zip(F.col(found).alias("match"), F.col(starts).alias("start"))
    kept = F.filter(F.transform(pairs, span), lambda s: s["sure"] & (s["base"] | (s["score"] >= LEAST)))
    return only(df.withColumn(out, kept), *names, out)


def find_personal(docs: DataFrame, text: str = "text", out: str = "personal") -> DataFrame:
    """``docs`` with ``out``: the spans found in ``text``, by start and then kind.

    A span has ``start`` and ``stop`` (code points, end exclusive), ``order`` and
    ``kind``, ``base`` and ``score``. Base spans are all matches of the four base
    patterns that their validator confirms, whatever their score; further ones
    (cards of 13 digits, account numbers, national ids, phone numbers without a
    country code) need a score of ``LEAST``.

    Null and empty texts have no spans, repeated rows are searched each, an empty
    table gives an empty result. A column named ``out`` is replaced, all others
    are kept.
    """
    docs = without(docs, out)
    names = docs.columns
    whole = unused(docs, "whole")
    df = docs.withColumn(whole, F.coalesce(F.col(f"`{text}`"), F.lit("")))
    lists = []
    for order, kind in enumerate(KINDS):
        lists.append(unused(df, f"kind_{order}"))
        df = _spans(df, whole, order, kind, lists[-1])
    spans = F.transform(F.array_sort(F.concat(*lists)), lambda s: s.dropFields("sure"))
    return only(df.withColumn(out, spans), *names, out)


def listed(spans: Column) -> Column:
    """``kind:start:stop`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def digests(found: DataFrame, spans: str = "personal") -> list[Column]:
    """The columns of the query: counts of base kinds, digest of base spans, all spans."""
    base = F.filter(spans, lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in BASE_KINDS]
    return [*counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col(spans)).alias("spans")]
