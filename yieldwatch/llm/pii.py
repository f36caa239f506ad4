"""Personal data in texts: patterns propose spans, checksums confirm them, context scores them.

Everything is a column expression. A text is cut at the matches of a pattern; the lengths
of the pieces and matches give the positions in code points, and the pieces and matches on
either side, put together again, are the context. The patterns never try a start again that is known to fail, and their loops
keep no way back, so the time stays in proportion to the text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yieldwatch.llm.columns import free_name, without

CONTEXT = 40  # code points looked at on either side
ACCOUNT = 38  # most code points of an account number after its first four, with spaces
KEEP = 0.5  # spans of the kinds that are not always kept need this score

_LOCAL = "[A-Za-z0-9._%+-]"
_DIGITS = "[0-9]"
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"


@dataclass(frozen=True)
class Kind:
    """pattern: proposes spans. always: valid spans are kept whatever the score.
    prior: score of a valid span, raised when a word of `near` stands close by."""

    name: str
    pattern: str
    always: bool
    prior: float
    near: str
    needs: str = ""  # a text without this string has no match


KINDS = [
    Kind("email", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", True, 0.9, "e-?mail|contact|write to|kontakt|correo", "@"),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", True, 0.6, r"\bip\b|server|host|address|adresse|login", "."),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", True, 0.8, "card|visa|master|credit|karte|carte|tarjeta"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", True, 0.6, r"phone|\btel\b|call|mobile|fax|telefon|appel|tel[eé]fono", "+"),
    # The beginning alone; _account finds the end, as the words after it may look like groups.
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=\x20?[A-Z0-9]{4})", False, 0.7, "iban|bank|account|konto|compte|cuenta"),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", False, 0.3, "ssn|social security|tax id|taxpayer", "-"),
]
BASE_KINDS = [kind.name for kind in KINDS if kind.always]


def luhn(digits: Column) -> Column:
    """Whether a string of decimal digits passes the Luhn checksum."""
    backwards = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        value = F.substr(backwards, i, F.lit(1)).cast("int") * (F.lit(1) + (i - 1) % 2)
        return total + value - F.when(value > 9, 9).otherwise(0)

    places = F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1)))
    return F.coalesce(F.aggregate(places, F.lit(0), add) % 10 == 0, F.lit(False))


def mod97(code: Column) -> Column:
    """Whether an account number without spaces passes the mod-97 check."""
    turned = F.concat(F.substr(code, F.lit(5)), F.substr(code, F.lit(1), F.lit(4)))

    def add(rest: Column, i: Column) -> Column:
        sign = F.ascii(F.substr(turned, i, F.lit(1)))
        return F.when(sign >= 65, (rest * 100 + sign - 55) % 97).otherwise((rest * 10 + sign - 48) % 97)

    places = F.sequence(F.lit(1), F.greatest(F.length(code), F.lit(1)))
    return F.coalesce(F.aggregate(places, F.lit(0), add) == 1, F.lit(False))


def _valid(kind: str, found: Column) -> Column:
    digits = F.regexp_replace(found, "[^0-9]", "")
    if kind == "ip":
        return found.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    if kind == "iban":
        return found.isNotNull()
    if kind == "ssn":
        return ~found.rlike("^(?:000|666|9)|-00-|-0000$")
    return F.lit(True)


def _bound(value: Column, use) -> Column:
    """use(value), with the value computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


# Letters and digits of an account number, by its country.
ACCOUNT_LENGTHS = (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18 FO18 "
    "FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 "
    "LY25 MC27 MD24 ME22 MK19 MR27 MT31 MU30 NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SE24 SI19 SK24 SM27 "
    "ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20"
)


def _account(begin: Column, rest: Column) -> Column:
    """The valid account number that starts with `begin` and goes on in `rest`, or null: the
    one with the length of its country, else the longest."""

    def code(rest: Column, size: Column) -> Column:
        return F.replace(F.concat(begin, F.substr(rest, F.lit(1), size)), F.lit(" "), F.lit(""))

    def ends(rest: Column, size: Column) -> Column:
        groups = F.substr(rest, F.lit(1), size)
        shaped = groups.rlike(r"^(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\z") & ~F.substr(rest, size + 1, F.lit(1)).rlike("[A-Za-z0-9]")
        fits = (F.length(groups) == size) & shaped & F.length(code(rest, size)).between(15, 34)
        return F.when(fits, mod97(code(rest, size))).otherwise(False)

    def best(rest: Column, valid: Column) -> Column:
        place = F.position(F.substr(begin, F.lit(1), F.lit(2)), F.lit(ACCOUNT_LENGTHS))
        known = F.when(place > 0, F.substr(F.lit(ACCOUNT_LENGTHS), place + 2, F.lit(2)))
        usual = F.filter(valid, lambda n: F.length(code(rest, n)).cast("string") == known)
        return F.coalesce(F.get(usual, F.lit(0)), F.get(valid, F.lit(0)))

    sizes = F.sequence(F.lit(ACCOUNT), F.lit(8), F.lit(-1))
    size = _bound(rest, lambda r: _bound(F.filter(sizes, lambda n: ends(r, n)), lambda valid: best(r, valid)))
    return F.when(size.isNotNull(), F.concat(begin, F.substr(rest, F.lit(1), size)))


def _before(cuts: Column, i: Column, size: int) -> Column:
    """The last `size` code points before match i, whatever matches lie in them."""
    own = F.substring(F.get(cuts["pieces"], i), -size, size)

    def one(j: Column) -> Column:
        return F.substring(F.concat(F.coalesce(F.get(cuts["found"], j - 1), F.lit("")), F.get(cuts["pieces"], j)), -size, size)

    # A match has two code points at least.
    some = F.transform(F.sequence(F.greatest(i - size // 2, F.lit(0)), i), one)
    return F.when(F.length(own) >= size, own).otherwise(F.substring(F.array_join(some, ""), -size, size))


def _after(cuts: Column, i: Column, size: int) -> Column:
    """The first `size` code points after match i, whatever matches lie in them."""
    own = F.substring(F.get(cuts["pieces"], i + 1), 1, size)

    def one(j: Column) -> Column:
        return F.substring(F.concat(F.get(cuts["pieces"], j + 1), F.coalesce(F.get(cuts["found"], j + 1), F.lit(""))), 1, size)

    some = F.transform(F.sequence(i, F.least(i + size // 2, F.size(cuts["found"]) - 1)), one)
    return F.when(F.length(own) >= size, own).otherwise(F.substring(F.array_join(some, ""), 1, size))


def _running(values: Column) -> Column:
    """Running sums of an array, block by block, so that long arrays are not copied for every element."""
    block = 128
    begins = F.sequence(F.lit(0), F.greatest(F.size(values) - 1, F.lit(0)), F.lit(block))

    def sums(array: Column, start: Column) -> Column:
        empty = F.struct(F.array().cast("array<int>").alias("out"), start.cast("int").alias("total"))

        def add(state: Column, x: Column) -> Column:
            total = (state["total"] + x).cast("int")
            return F.struct(F.concat(state["out"], F.array(total)).alias("out"), total.alias("total"))

        return F.aggregate(array, empty, add, lambda state: state["out"])

    def block_sum(begin: Column) -> Column:
        return F.aggregate(F.slice(values, begin + 1, F.lit(block)), F.lit(0), lambda a, x: (a + x).cast("int"))

    whole = F.zip_with(begins, sums(F.transform(begins, block_sum), F.lit(0)), lambda b, s: F.struct(b.alias("begin"), s.alias("upto")))
    return F.flatten(
        F.transform(whole, lambda w: sums(F.slice(values, w["begin"] + 1, F.lit(block)), w["upto"] - block_sum(w["begin"])))
    )


def find(df: DataFrame, text: str = "text", out: str = "pii") -> DataFrame:
    """`df` with `out`: array of struct(kind, start, end, score, checked), by kind and start.

    Positions are code points, the end is exclusive. checked: a checksum has confirmed the
    span. Spans of one kind never overlap; those of different kinds may. A null or empty
    text has none; a column named `out` is replaced. No shuffle, no Python.
    """
    work = free_name(df, "_work")
    columns = without(df, [out])
    content = F.coalesce(F.col(text), F.lit(""))

    def cut(kind: Kind) -> Column:
        found = F.regexp_extract_all(content, F.lit(kind.pattern), F.lit(0))
        pieces = F.split(content, kind.pattern, -1)
        both = F.struct(found.alias("found"), pieces.alias("pieces"))
        if kind.needs:
            none = F.struct(F.array().cast("array<string>").alias("found"), F.array(F.lit("")).alias("pieces"))
            both = F.when(F.contains(content, F.lit(kind.needs)), both).otherwise(none)
        return both

    staged = df.select(*columns, F.struct(*[cut(kind).alias(kind.name) for kind in KINDS]).alias(work))

    def gaps(cuts: Column) -> Column:
        # Before match i: piece i, and match i - 1.
        pieces = F.transform(cuts["pieces"], F.length)
        lengths = F.concat(F.array(F.lit(0)), F.transform(cuts["found"], F.length))
        return F.zip_with(pieces, lengths, lambda a, b: a + b)

    wide = [F.struct(F.col(work)[k.name]["found"].alias("found"), F.col(work)[k.name]["pieces"].alias("pieces"), gaps(F.col(work)[k.name]).alias("gaps")).alias(k.name) for k in KINDS]
    staged = staged.select(*columns, F.struct(*wide).alias(work))

    def spans(kind: Kind) -> Column:
        cuts = F.col(work)[kind.name]
        count = F.size(cuts["found"])
        starts = F.slice(_running(cuts["gaps"]), F.lit(1), count)
        numbers = F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0)))
        rows = F.arrays_zip(cuts["found"].alias("found"), starts.alias("start"), numbers.alias("i"))
        begin = 0
        if kind.name == "iban":
            begin = 4

            def completed(row: Column) -> Column:
                whole = _account(row["found"], _after(cuts, row["i"], ACCOUNT + 1))
                return F.struct(whole.alias("found"), row["start"].alias("start"), row["i"].alias("i"))

            rows = F.transform(rows, completed)

        def scored(row: Column) -> Column:
            after = _after(cuts, row["i"], CONTEXT)
            if begin:
                after = F.substr(_after(cuts, row["i"], ACCOUNT + CONTEXT), F.length(row["found"]) - begin + 1, F.lit(CONTEXT))
            near = F.concat_ws(" ", _before(cuts, row["i"], CONTEXT), after)
            score = F.lit(kind.prior) + F.when(F.lower(near).rlike(kind.near), F.lit(0.3)).otherwise(F.lit(0.0))
            return F.struct(
                F.lit(kind.name).alias("kind"),
                row["start"].alias("start"),
                (row["start"] + F.length(row["found"])).alias("end"),
                F.least(score, F.lit(1.0)).alias("score"),
                F.lit(kind.name in ("card", "iban")).alias("checked"),
            )

        valid = F.transform(F.filter(rows, lambda row: _valid(kind.name, row["found"])), scored)
        kept = valid if kind.always else F.filter(valid, lambda span: span["score"] >= KEEP)
        none = F.array().cast("array<struct<kind:string,start:int,end:int,score:double,checked:boolean>>")
        if kind.name == "iban":

            def apart(spans: Column, span: Column) -> Column:
                inside = F.coalesce(span["start"] < F.get(spans, F.size(spans) - 1)["end"], F.lit(False))
                return F.when(inside, spans).otherwise(F.concat(spans, F.array(span)))

            kept = F.aggregate(kept, none, apart)
        return F.when(count > 0, kept).otherwise(none)

    return staged.select(*columns, F.concat(*[spans(kind) for kind in KINDS]).alias(out))


def span_list(spans: Column) -> Column:
    """kind:start:end of all spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def mask(df: DataFrame, text: str = "text", spans: str = "pii") -> DataFrame:
    """`df` with every span of `text` replaced by its kind in angle brackets.

    Overlapping spans are replaced together, under the kind of the first. Null stays null.
    """
    ordered = F.array_sort(F.transform(F.col(spans), lambda s: F.struct(s["start"], s["end"], s["kind"])))

    def join(merged: Column, span: Column) -> Column:
        last = F.element_at(merged, -1)
        wider = F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"), last["kind"].alias("kind"))
        overlaps = (F.size(merged) > 0) & (span["start"] < F.get(merged, F.size(merged) - 1)["end"])
        return F.when(overlaps, F.concat(F.slice(merged, F.lit(1), F.size(merged) - 1), F.array(wider))).otherwise(F.concat(merged, F.array(span)))

    none = F.array().cast("array<struct<start:int,end:int,kind:string>>")
    merged = free_name(df, "_merged")
    staged = df.withColumn(merged, F.when(F.size(spans) > 0, F.aggregate(ordered, none, join)).otherwise(none))
    ends = F.concat(F.array(F.lit(0)), F.transform(F.col(merged), lambda s: s["end"]))
    kept = F.zip_with(
        F.col(merged),
        F.slice(ends, F.lit(1), F.size(merged)),
        lambda s, end: F.concat(F.substr(F.col(text), end + 1, s["start"] - end), F.lit("<"), F.upper(s["kind"]), F.lit(">")),
    )
    rest = F.substr(F.col(text), F.element_at(ends, -1) + 1)
    masked = F.concat(F.array_join(kept, ""), rest)
    return staged.withColumn(text, F.when(F.size(merged) > 0, masked).otherwise(F.col(text))).drop(merged)
