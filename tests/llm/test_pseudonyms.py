"""Op 8 against a plain Python version of the same networks; permutations are checked by counting."""

import datetime as dt
import hashlib
import re

import pandas as pd
from pyspark.sql import functions as F

from claimflow.llm import pseudonyms as ps, queries
from tables import MEDIUM


def digest(key, kind, r, half):
    return hashlib.sha256(f"{key}|{kind}|{r}|{half}".encode()).hexdigest()


def number(value, radix, key, kind):
    a, b = radix
    left, right = divmod(value, b)
    for r in range(2, ps.ROUNDS + 2):
        if r % 2 == 0:
            left = (left + int(digest(key, kind, r, right)[:12], 16)) % a
        else:
            right = (right + int(digest(key, kind, -(r - 1), left)[:12], 16)) % b
    return left * b + right


def shift(c, n):
    for low, size in (("0", 10), ("a", 26), ("A", 26)):
        if 0 <= ord(c) - ord(low) < size:
            return chr(ord(low) + (ord(c) - ord(low) + n) % size)
    return c


def text(value, key, kind):
    a, b = value[: len(value) // 2], value[len(value) // 2 :]
    for r in range(1, ps.ROUNDS + 1):
        d = digest(key, kind, r, b)
        d += hashlib.sha256(d.encode()).hexdigest()
        a, b = b, "".join(shift(c, int(d[2 * (i % 64) : 2 * (i % 64) + 2], 16)) for i, c in enumerate(a))
    return a + b


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def in_place(value, digits):
    it = iter(digits)
    return "".join(next(it) if c in "0123456789" else c for c in value)


def replaced(value, key):
    digits = re.sub("[^0-9]", "", value)
    kind = next((k for k in ps.KINDS if re.fullmatch(ps.PATTERNS[k], value, re.A)), None)
    if kind == "email":
        local, _, domain = value.partition("@")
        return kind, f"{text(local, key, kind)}@{domain}"
    if kind == "card" and 13 <= len(digits) <= 19 and luhn(digits):
        body = digits[0] + text(digits[1:-1], key, kind)
        return kind, in_place(value, body + next(c for c in "0123456789" if luhn(body + c)))
    if kind == "date":
        wide = bool(re.match("[0-9]{2}/[0-9]{2}/", value))
        forms = ["%Y-%m-%d"] if value[4] == "-" and value[2] != "/" else ["%d %b %Y"] if " " in value else ["%m/%d/%Y", "%d/%m/%Y"]
        for form in forms:
            try:
                n = (dt.datetime.strptime(value, form).date() - dt.date(1900, 1, 1)).days
            except ValueError:
                continue
            if 0 <= n < 270 * 271:
                day = dt.date(1900, 1, 1) + dt.timedelta(number(n, (270, 271), key, kind))
                narrow = {"%d %b %Y": f"{day.day} {day:%b %Y}", "%m/%d/%Y": f"{day.month}/{day.day}/{day.year}",
                          "%d/%m/%Y": f"{day.day}/{day.month}/{day.year}"}
                return kind, str(day) if form[1] == "Y" else day.strftime(form) if wide else narrow[form]
    if kind == "ssn":
        a, g, s = map(int, value.split("-"))
        if 1 <= a <= 899 and a != 666 and g and s:
            n = number((a - (2 if a > 666 else 1)) * ps.SSN_REST + (g - 1) * 9999 + s - 1, (898, ps.SSN_REST), key, kind)
            low, rest = divmod(n, ps.SSN_REST)
            return kind, f"{low + (2 if low >= 665 else 1):03d}-{rest // 9999 + 1:02d}-{rest % 9999 + 1:04d}"
    if kind == "phone":
        return kind, in_place(value, digits[:-10] + text(digits[-10:], key, kind))
    if kind == "ip" and all(int(x) <= 255 for x in value.split(".")):
        n = 0
        for x in value.split("."):
            n = n * 256 + int(x)
        n = number(n, (65536, 65536), key, kind)
        return kind, ".".join(str(n >> s & 255) for s in (24, 16, 8, 0))
    return None, value


def brute(value, key):
    if value is None:
        return None, [0] * len(ps.KINDS)
    seen = []

    def put(m):
        kind, to = replaced(m[0], key)
        seen.append(kind)
        return to

    out = re.sub(ps.ANY, put, value, flags=re.A)
    return out, [seen.count(k) for k in ps.KINDS]


def test_query_equals_plain_version(spark):
    docs = pd.read_parquet(f"{MEDIUM}/documents.parquet")
    got = {r.doc_id: r for r in queries.QUERIES["op8_feistel_pseudonyms"](spark, MEDIUM).collect()}
    assert len(got) == len(docs)
    for d, t in zip(docs.doc_id, docs.text, strict=True):
        out, counts = brute(t, queries.PSEUDONYM_KEY)
        assert got[d].text == out
        assert [got[d][f"n_{k}"] for k in ps.KINDS] == counts
    assert all(sum(r[f"n_{k}"] for r in got.values()) for k in ("email", "card", "phone", "ip"))


VALUES = [
    "Mail Ann.Lee+x@a-b.example.com, twice ann.lee@x.org ann.lee@x.org.", "4111 1111 1111 1111 4111-1111-1111-1111 4111111111111111",
    "4111111111111112 not Luhn; 378282246310005 amex; 123456789012345678901", "1999-02-29 2000-02-29 1899-12-31 2100-04-30 2100-05-01 1900-01-01",
    "000-12-3456 666-12-3456 899-99-9999 001-01-0001 900-01-0001", "(578) 555-2084 578-555-2084 (578)555-2084 1578-555-20841",
    "1-800-555-0123 +1-415-555-0100 415.555.0100 (415)-555-0100 415-555-0100", "2223000048400011 card-4111111111111111 4111111111111111-x",
    "01/15/2024 15/01/2024 1/5/2024 31/31/2024 15 Jan 2024 5 Feb 2024 32 Jan 2024 2024-01-15-notes 01/15/20245", "0.0.0.0 255.255.255.255 256.1.1.1 1.2.3.4.5 10.0.0.1.", "", None, "nothing", "@", "12", "é 🙂 61.140.123.109 🙂 a@b.co é",
]


def test_odd_values(spark):
    df = spark.createDataFrame(list(enumerate(VALUES)), "doc_id long, text string").selectExpr("*", "1 as _to", "2 as n_ip", "3 as _gap", "4 as _match")
    assert ps.pseudonymise(df, "k").select("_to", "_gap", "_match").distinct().collect() == [(1, 3, 4)]
    got = {r.doc_id: r for r in ps.pseudonymise(df, "k").collect()}
    for i, v in enumerate(VALUES):
        out, counts = brute(v, "k")
        assert (got[i].text, [got[i][f"n_{k}"] for k in ps.KINDS]) == (out, counts), v
    cards = re.findall(r"4[0-9]{3}(?:[ -]?[0-9]{4}){3}", got[1].text)
    assert len(cards) == 3 and len({re.sub("[^0-9]", "", c) for c in cards}) == 1 and luhn(re.sub("[^0-9]", "", cards[0]))
    other = ps.pseudonymise(df, "another key").where("doc_id = 1").first().text
    assert other != got[1].text


def test_common_forms_are_replaced_and_linked(spark):
    forms = ["1-800-555-0123", "+1-415-555-0100", "415.555.0100", "(415)-555-0100", "2223000048400011", "card-4111111111111111",
             "01/15/2024", "15 Jan 2024", "2024-01-15-notes"]
    df = spark.createDataFrame([(i, f"see {f} there") for i, f in enumerate(forms)], "doc_id long, text string")
    got = [r.text[4:-6] for r in ps.pseudonymise(df, "k").orderBy("doc_id").collect()]
    assert all(a != b for a, b in zip(got, forms, strict=True))
    digits = [re.sub("[^0-9]", "", x)[-10:] for x in got[1:4]]
    assert len(set(digits)) == 1  # one number however it is written
    days = {dt.datetime.strptime(got[6], "%m/%d/%Y"), dt.datetime.strptime(got[7], "%d %b %Y"), dt.datetime.strptime(got[8][:10], "%Y-%m-%d")}
    assert len(days) == 1


def test_they_are_permutations(spark):
    days = spark.range(270 * 271).select(ps.permute_number(F.col("id"), (270, 271), F.lit("k"), "date").alias("x"))
    assert days.agg(F.countDistinct("x"), F.min("x"), F.max("x")).first() == (73170, 0, 73169)
    codes = spark.range(10**5).select(ps.permute_text(F.format_string("%05d", "id"), F.lit("k"), "t").alias("x"))
    assert codes.agg(F.countDistinct("x"), F.min(F.length("x")), F.max(F.length("x"))).first() == (10**5, 5, 5)


def test_tables_of_odd_rows(spark, odd_docs, no_docs):
    assert ps.pseudonymise(no_docs, "k").count() == 0
    rows = ps.pseudonymise(odd_docs, "k").collect()
    assert sorted(str(r.text) for r in rows) == sorted(str(r.text) for r in odd_docs.collect())
