"""Personal data: patterns propose, checksums confirm, context words score.

Everything is a Spark expression.  A pattern's matches and the pieces between
them (split by the same pattern) give each match its place in code points:
one sum of lengths, linear in the number of matches.

Base kinds keep every match that passes its own test.  Further kinds add
spans: card numbers standing in a longer run of digits (Luhn), IBANs (mod 97),
and nine-digit social security numbers, which have no checksum and need a
context word nearby.

An IBAN ends where its country's length says, whatever words or numbers follow.
One of a country without a known length ends at the last word end at which the
check holds.  Every place that may start an IBAN is tried, also those inside a
candidate that fails, so IBANs that stand in a row are found each.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amihan.llm.arrays import last_not_above, let, running_ends, running_most, with_cutter

#: How far from a span, in code points, a context word counts.
CONTEXT_CHARS = 40
#: Spans with a lower score are not reported; base kinds start at it.
THRESHOLD = 0.5
SPAN = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"


@dataclass(frozen=True)
class Kind:
    """A pattern (Java syntax), the score of a bare match, a test, and words that raise the score.

    ``needs`` is a cheap pattern without which a text is not searched.  With
    ``head`` the pattern takes only so many code points and looks ahead for the
    whole text, its group 1; the next match may then start inside it.
    """

    name: str
    pattern: str
    needs: str
    prior: float
    words: str
    base: bool = True
    test: str = field(default="none")
    head: int | None = None


#: Characters of an IBAN, by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}
COUNTRIES = " ".join(IBAN_LENGTHS.values()).split()
_IBAN = "|".join(
    [rf"(?:{codes.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, codes in IBAN_LENGTHS.items()]
    + [rf"(?!{'|'.join(COUNTRIES)})[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]){{11,30}}"]
)

# Starting a run of its own characters only (or where the last match ended) finds the same
# leftmost matches, without trying each place of a long run.  The labels of a mail address cannot
# lend each other characters, so they are taken for good: a repeated group that can go back recurses.
BASE = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.8, "mail|contact|write|reach"),
    Kind("ip", r"(?:(?<![0-9])|\G)[0-9]+(?:\.[0-9]+){3}", r"[0-9]\.[0-9]", 0.6, r"\bip\b|host|server|address|login", test="ip"),
    # A whole run of digits with single separators, 13 to 19 of them.
    Kind("card", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])", "[0-9]{3}", 0.5, "card|visa|master|credit|debit|payment", test="luhn"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", 0.7, r"phone|\btel\b|call|mobile|fax", test="phone"),
)
EXTRA = (
    Kind("card_part", r"(?<![0-9])(?:[0-9]{4}(?:[\x20-][0-9]{4}){3}|[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{5}|[0-9]{13,19})(?![0-9])", "[0-9]{3}", 0.5, "card|visa|master|credit|debit|payment", base=False, test="luhn"),
    Kind("iban", rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?=((?:{_IBAN})(?![A-Za-z0-9])))[A-Z]{{2}}[0-9]{{2}}", "[A-Z]{2}[0-9]{2}", 0.7, "iban|bank|account|transfer", base=False, test="mod97", head=4),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "[0-9]-[0-9]", 0.3, r"\bssn\b|social security|tax id", base=False),
)


def luhn(text: Column) -> Column:
    digits = F.regexp_replace(text, "[^0-9]", "")
    n = F.length(digits)
    values = F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(digits, i, F.lit(1)).cast("int") * F.when(F.pmod(n - i, F.lit(2)) == 1, 2).otherwise(1))
    total = F.aggregate(values, F.lit(0), lambda a, v: a + F.when(v > 9, v - 9).otherwise(v))
    return F.pmod(total, F.lit(10)) == 0


def mod97(text: Column) -> Column:
    """An IBAN's check: moved to the end, letters as 10 to 35, the number is 1 modulo 97."""
    plain = F.replace(text, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))
    codes = F.transform(F.split(turned, "(?!^)(?!$)"), lambda c: F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55))
    return F.aggregate(codes, F.lit(0), lambda a, v: F.pmod(a * F.when(v > 9, 100).otherwise(10) + v, F.lit(97))) == 1


def iban(text: Column) -> Column:
    """The candidate, or its longest part up to a word end, that passes the check; null if none does.

    A candidate of a country with a known length has no other end.
    """
    words = F.split(text, " ")
    ends = F.when(F.substring(text, 1, 2).isin(COUNTRIES), F.array(text)).otherwise(
        F.transform(F.sequence(F.size(words), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(words, F.lit(1), n), " "))
    )
    return F.get(F.filter(ends, lambda t: (F.length(F.replace(t, F.lit(" "), F.lit(""))) >= 15) & mod97(t)), F.lit(0))


def passes(test: str, text: Column) -> Column:
    digits = F.length(F.regexp_replace(text, "[^0-9]", ""))
    return {
        "none": F.lit(True),
        "ip": text.rlike(r"^0*(25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])(\.0*(25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])){3}$"),
        "luhn": digits.between(13, 19) & luhn(text),
        "mod97": text.isNotNull(),
        "phone": digits.between(9, 15),
    }[test]


def _proposed(text: Column, kind: Kind) -> Column:
    """array<struct<text, before, after>>: matches with the pieces around them."""
    none = F.array().cast("array<struct<text:string,before:string,after:string>>")
    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(1 if kind.head else 0))
    found = let(
        F.split(text, kind.pattern, -1),
        lambda pieces: F.transform(
            matches, lambda m, i: F.struct(m.alias("text"), F.get(pieces, i).alias("before"), F.get(pieces, i + 1).alias("after"))
        ),
    )
    return F.when(text.rlike(kind.needs) & text.rlike(kind.pattern), found).otherwise(none)


def find_spans(docs: DataFrame, text_col: str = "text", spans_col: str = "spans") -> DataFrame:
    """The input with array<struct<kind, start, end, score>>, by kind as listed, then start; end exclusive.

    A null or empty text has no spans.  Repeated rows stay apart; an empty
    table gives no rows.  A column of the result's name is replaced, names
    starting with ``__pii_`` are the operator's own.
    """
    kinds = (*BASE, *EXTRA)
    text = F.coalesce(F.col(text_col), F.lit(""))
    taken = lambda k, x: F.lit(k.head) if k.head else F.length(x["text"])
    proposed = docs.withColumns({f"__pii_{k.name}": _proposed(text, k) for k in kinds})
    ends = {}
    for k in kinds:
        lengths = F.transform(f"__pii_{k.name}", lambda x: (F.length(x["before"]) + taken(k, x)).cast("long"))
        ends[f"__pii_{k.name}_end"] = F.when(F.size(f"__pii_{k.name}") > 0, running_ends(lengths)).otherwise(F.array().cast("array<bigint>"))
    placed = proposed.withColumns(ends)

    def spans(k: Kind) -> Column:
        # After a head comes the rest of the span itself.
        rest = lambda x: F.length(x["text"]) - taken(k, x)
        after = lambda x: F.substring(F.coalesce(x["after"], F.lit("")), rest(x) + 1, F.lit(CONTEXT_CHARS))
        near = lambda x: F.lower(F.concat(F.right(x["before"], F.lit(CONTEXT_CHARS)), F.lit(" "), after(x)))
        score = lambda x: F.lit(k.prior) + F.when(near(x).rlike(k.words), 0.2).otherwise(0.0) + F.lit(0.1 if k.test in ("luhn", "mod97") else 0.0)
        found = F.col(f"__pii_{k.name}")
        rated = F.zip_with(
            F.transform(found, lambda x: x.withField("text", iban(x["text"]))) if k.test == "mod97" else found,
            f"__pii_{k.name}_end",
            lambda x, e: F.when(
                passes(k.test, x["text"]),
                F.struct(F.lit(k.name).alias("kind"), (e - taken(k, x)).alias("start"), (e + rest(x)).alias("end"), score(x).alias("score")),
            ),
        )
        return F.filter(rated, lambda s: s.isNotNull() & (s["score"] >= THRESHOLD - 1e-9)).cast(SPAN)

    each = {f"__pii_{k.name}_span": spans(k) for k in kinds}
    found = placed.withColumns(each)
    # Whole card numbers do not overlap: only the last that starts before a part can hold it.
    starts = F.transform("__pii_card_span", lambda b: b["start"])
    holder = lambda bound, s: F.get(F.col("__pii_card_span"), last_not_above(bound, s["start"]))
    outside = lambda bound, s: F.coalesce(holder(bound, s)["end"] < s["end"], F.lit(True))
    card_parts = let(starts, lambda bound: F.filter("__pii_card_part_span", lambda s: outside(bound, s)))
    parts = [card_parts if k.name == "card_part" else F.col(f"__pii_{k.name}_span") for k in kinds]
    return found.withColumn(spans_col, F.concat(*parts)).drop(*(f"__pii_{k.name}{x}" for k in kinds for x in ("", "_end", "_span")))


def span_list(spans: Column) -> Column:
    """kind:start:end, comma-joined, in the order of the array."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, text_col: str = "text", spans_col: str = "spans") -> DataFrame:
    """Texts with every span replaced by its kind in angle brackets; overlapping spans become one, named by the first.

    A null text stays null; a text without spans stays as it is.
    """
    # Sorted by start, a span that begins before some earlier one has ended adds nothing of its own but its end.
    order = F.array_sort(F.transform(spans_col, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("far"), s["kind"].alias("kind"))))
    text = F.col(text_col)
    nothing = F.lit(0).cast("long")

    def written(spans: Column, ends: Column, cut) -> Column:
        until = lambda i: F.when(i > 0, F.get(ends, i - 1)).otherwise(nothing)
        named = lambda s, i: F.concat(cut(until(i), s["start"] - until(i)), F.lit("<"), F.upper(s["kind"]), F.lit(">"))
        body = F.transform(spans, lambda s, i: F.when(s["start"] >= until(i), named(s, i)).otherwise(""))
        last = F.get(ends, F.size(ends) - 1)
        return F.concat(F.array_join(body, ""), cut(last, F.length(text) - last))

    bound = let(
        order,
        lambda spans: let(
            running_most(F.transform(spans, lambda s: -s["far"])), lambda ends: with_cutter(text, lambda cut: written(spans, ends, cut))
        ),
    )
    return docs.withColumn(text_col, F.when(F.size(spans_col) > 0, bound).otherwise(text))
