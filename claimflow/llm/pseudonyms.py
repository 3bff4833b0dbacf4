"""Format-preserving pseudonyms by keyed Feistel networks, in DataFrame functions only.

Numbers, dates and addresses that pass their format's check are replaced by others of the same format.
Each replacement is a keyed permutation of the format's values, so equal values get equal pseudonyms in
every document and different values stay different. Round functions are SHA-256 of key, kind, round and
the other half; the network has ``ROUNDS`` rounds.

=======  ==========================================  =================================================
kind     found and checked                           permuted
=======  ==========================================  =================================================
email    local part @ domain                         letters and digits of the local part, by class
card     13-19 digits in groups, Luhn, first 2-6     digits between the first and the last; the last
                                                     is made to pass Luhn again
date     yyyy-mm-dd, d Mon yyyy, m/d/yyyy or, where  the day among all days of these years, printed in
         that is none, d/m/yyyy; a day of the        the same shape
         calendar from 1900-01-01 to 2100-04-30
ssn      ddd-dd-dddd with a valid area, group and    the valid numbers
         serial
phone    area code in brackets or not, groups        the last ten digits
         joined by hyphens or dots, +1 or 1 before
ip       four numbers up to 255                      all addresses
=======  ==========================================  =================================================

Separators, letter case and length stay (a day or month of a date may change its number of digits).
Matches that fail their check are left as they are; a run of more digit groups than a card's is judged
from its first group.

Defined results: a null text stays null, an empty one empty; texts of any length are read whole, with
any number of matches; repeated rows get equal results; an empty table gives no rows; other columns
pass through, whatever their names (those named n_<kind> are replaced).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimflow.llm.common import free_prefix

ROUNDS = 8
KINDS = ["email", "card", "date", "ssn", "phone", "ip"]
# whole tokens only: no match begins or ends inside a longer run of digits or of numbers joined by hyphens
_BEFORE, _AFTER = r"(?<![0-9])(?<![0-9][-])", r"(?![0-9])(?!-[0-9])"
_MONTH = "(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)"
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "card": (_BEFORE + r"[2-6][0-9]{3}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,7}" + _AFTER + "|"
             + _BEFORE + r"3[0-9]{3}[ -]?[0-9]{6}[ -]?[0-9]{5}" + _AFTER),
    "date": (_BEFORE + r"[0-9]{4}-[0-9]{2}-[0-9]{2}" + _AFTER + r"|(?<![0-9/])[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}(?![0-9/])|"
             + _BEFORE + r"[0-9]{1,2} " + _MONTH + r" [0-9]{4}" + _AFTER),
    "ssn": _BEFORE + r"[0-9]{3}-[0-9]{2}-[0-9]{4}" + _AFTER,
    "phone": (r"(?<![0-9.])(?<![0-9]-)(?:\+?1[ .-])?(?:\([0-9]{3}\)[ -]?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}" + _AFTER),
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9])",
}
ANY = "|".join(PATTERNS[k] for k in KINDS)
FIRST_DAY = "1900-01-01"
DAY_RADIX = (270, 271)  # 73,170 days: to 2100-04-30
SSN_AREAS, SSN_REST = 898, 99 * 9999  # areas 001-899 but 666; groups 01-99, serials 0001-9999


def _digest(key: Column, kind: str, r: Column, half: Column) -> Column:
    return F.sha2(F.concat_ws("|", key, F.lit(kind), r.cast("string"), half.cast("string")), 256)


def _number(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("long")


def permute_number(value: Column, radix: tuple[int, int], key: Column, kind: str) -> Column:
    """A keyed permutation of 0 .. radix[0] * radix[1] - 1: an unbalanced Feistel network whose rounds add
    a digest of one half to the other, modulo that half's radix."""
    a, b = (F.lit(x).cast("long") for x in radix)

    def two_rounds(s, r):
        left = (s["l"] + _number(_digest(key, kind, r, s["r"]))) % a
        return F.struct(left.alias("l"), s["r"].alias("r"), r.alias("n"))

    def other(s):
        return F.struct(s["l"].alias("l"), ((s["r"] + _number(_digest(key, kind, -s["n"], s["l"]))) % b).alias("r"),
                        s["n"].alias("n"))

    value = value.cast("long")
    begin = F.struct(F.floor(value / b).alias("l"), (value % b).alias("r"), F.lit(0).alias("n"))
    steps = F.sequence(F.lit(2), F.lit(ROUNDS + 1))
    return F.aggregate(steps, begin, lambda s, r: F.when(r % 2 == 0, two_rounds(s, r)).otherwise(other(s)),
                       lambda s: s["l"] * b + s["r"])


def _shifted(c: Column, n: Column) -> Column:
    code = F.ascii(c)

    def turn(low: int, size: int) -> Column:
        return F.chr(F.lit(low) + (code - low + n) % size)

    return (F.when(code.between(48, 57), turn(48, 10)).when(code.between(97, 122), turn(97, 26))
            .when(code.between(65, 90), turn(65, 26)).otherwise(c))


def permute_text(value: Column, key: Column, kind: str) -> Column:
    """A keyed permutation of the strings of one shape: digits, lower- and upper-case letters change
    within their class, other characters stay. The halves of the string take turns."""
    cut = F.floor(F.length(value) / 2).cast("int")

    def one_round(s, r):
        digest = _digest(key, kind, r, s["b"])
        whole = F.concat(digest, F.sha2(digest, 256))  # 64 shifts, used again beyond 64 characters
        return F.struct(s["b"].alias("a"), F.array_join(F.transform(F.split(s["a"], ""), lambda c, i: _shifted(
            c, F.conv(F.substring(whole, 2 * (i % 64) + 1, F.lit(2)), 16, 10).cast("int"))), "").alias("b"))

    begin = F.struct(F.substring(value, F.lit(1), cut).alias("a"),
                     F.substring(value, cut + 1, F.length(value)).alias("b"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), begin, one_round, lambda s: F.concat(s["a"], s["b"]))


def luhn_sum(digits: Column, from_right: int) -> Column:
    """Luhn's sum of a string of digits whose last stands ``from_right`` places from the check digit."""
    n = F.length(digits)
    each = F.transform(F.split(digits, ""), lambda c, i: F.when(
        (n - 1 - i + from_right) % 2 == 1, F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]),
                                                        c.cast("int") + 1)).otherwise(c.cast("int")))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x)


def _in_place(value: Column, digits: Column) -> Column:
    """``value`` with its digits replaced in order by the string ``digits``."""
    parts = F.transform(F.split(value, ""), lambda c, i: F.when(
        c.rlike("[0-9]"), F.substring(digits, F.length(F.regexp_replace(F.substring(value, F.lit(1), i + 1), "[^0-9]", "")),
                                      F.lit(1))).otherwise(c))
    return F.array_join(parts, "")


def card(value: Column, key: Column) -> tuple[Column, Column]:
    digits = F.regexp_replace(value, "[^0-9]", "")
    n = F.length(digits)
    inner = permute_text(F.substring(digits, F.lit(2), n - 2), key, "card")
    body = F.concat(F.substring(digits, 1, 1), inner)
    check = (10 - luhn_sum(body, 1) % 10) % 10
    return n.between(13, 19) & (luhn_sum(digits, 0) % 10 == 0), _in_place(value, F.concat(body, check.cast("string")))


def date(value: Column, key: Column) -> tuple[Column, Column]:
    first, last = F.lit(FIRST_DAY).cast("date"), DAY_RADIX[0] * DAY_RADIX[1] - 1
    shapes = [(r"^[0-9]{4}-", ["yyyy-MM-dd"]), (r"^[0-9]{1,2} ", ["d MMM yyyy"]), (r"^[0-9]{2}/[0-9]{2}/", ["MM/dd/yyyy", "dd/MM/yyyy"]),
              (r"/", ["M/d/yyyy", "d/M/yyyy"])]
    ok, to = F.lit(False), value
    for shape, formats in reversed(shapes):
        for form in reversed(formats):
            day = F.try_to_date(F.when(value.rlike(shape), value), form)
            number = F.date_diff(day, first)
            good = day.isNotNull() & number.between(0, last)
            moved = permute_number(F.when(good, number), DAY_RADIX, key, "date").cast("int")
            ok, to = ok | good, F.when(good, F.date_format(F.date_add(first, moved), form)).otherwise(to)
    return ok, to


def ssn(value: Column, key: Column) -> tuple[Column, Column]:
    area, group, serial = (F.substring(value, s, n).cast("int") for s, n in ((1, 3), (5, 2), (8, 4)))
    ok = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    place = F.when(area > 666, area - 2).otherwise(area - 1)
    moved = permute_number(F.when(ok, place * F.lit(SSN_REST).cast("long") + (group - 1) * 9999 + serial - 1),
                           (SSN_AREAS, SSN_REST), key, "ssn")
    low = F.floor(moved / SSN_REST)
    rest = moved % SSN_REST
    return ok, F.format_string("%03d-%02d-%04d", F.when(low >= 665, low + 2).otherwise(low + 1),
                               F.floor(rest / 9999) + 1, rest % 9999 + 1)


def ip(value: Column, key: Column) -> tuple[Column, Column]:
    parts = F.transform(F.split(value, r"\."), lambda x: x.cast("int"))
    ok = F.forall(parts, lambda x: x <= 255)
    number = F.aggregate(parts, F.lit(0).cast("long"), lambda a, x: a * 256 + x)
    moved = permute_number(F.when(ok, number), (65536, 65536), key, "ip")
    return ok, F.concat_ws(".", *[F.shiftright(moved, s).bitwiseAND(F.lit(255).cast("long")).cast("string") for s in (24, 16, 8, 0)])


def email(value: Column, key: Column) -> tuple[Column, Column]:
    at = F.instr(value, "@")
    local = F.substring(value, F.lit(1), at - 1)
    return F.lit(True), F.concat(permute_text(local, key, "email"), F.substring(value, at, F.length(value)))


def phone(value: Column, key: Column) -> tuple[Column, Column]:
    digits = F.regexp_replace(value, "[^0-9]", "")
    # equal numbers are linked however they are written, with or without the country's 1
    country = F.substring(digits, F.lit(1), F.length(digits) - 10)
    return F.lit(True), _in_place(value, F.concat(country, permute_text(F.substring(digits, -10, 10), key, "phone")))


_FORMATS = {"email": email, "card": card, "date": date, "ssn": ssn, "phone": phone, "ip": ip}


def _renamed(value: Column, key: Column) -> Column:
    """(kind or null, replacement) of a match: the first format whose whole pattern and check it passes."""
    out = F.struct(F.lit(None).cast("string").alias("kind"), value.alias("to"))
    for kind in reversed(KINDS):
        whole = value.rlike(f"^(?:{PATTERNS[kind]})$")
        ok, to = _FORMATS[kind](value, key)
        out = F.when(whole & ok, F.struct(F.lit(kind).alias("kind"), to.alias("to"))).otherwise(out)
    return out


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", out_col: str | None = None) -> DataFrame:
    """``docs`` with the text's private values replaced (in ``out_col``, else in place) and n_<kind> of each kind."""
    names = [f"n_{k}" for k in KINDS]
    docs = docs.drop(*names)
    match, gap, to = (f"{free_prefix(docs)}{x}" for x in ("match", "gap", "to"))
    none = F.array().cast("array<string>")
    may = F.col(text_col).rlike("[0-9]") | F.contains(F.col(text_col), F.lit("@"))
    df = docs.withColumn(match, F.coalesce(F.when(may, F.regexp_extract_all(F.col(text_col), F.lit(ANY), F.lit(0))), none))
    df = df.withColumns({
        gap: F.when(F.size(match) > 0, F.split(F.col(text_col), ANY, -1)).otherwise(none),
        to: F.transform(match, lambda v: _renamed(v, F.lit(key)))})
    joined = F.concat(F.array_join(F.zip_with(F.slice(gap, 1, F.size(match)), F.col(to),
                                              lambda g, t: F.concat(g, t["to"])), ""),
                      F.element_at(gap, -1))
    replaced = F.when(F.size(match) > 0, joined).otherwise(F.col(text_col))

    def count(kind):
        return F.size(F.filter(to, lambda t: t["kind"] == kind)).cast("long")

    return (df.withColumns({out_col or text_col: replaced} | {n: count(k) for n, k in zip(names, KINDS, strict=True)})
            .drop(match, gap, to))
