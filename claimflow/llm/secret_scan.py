"""Secret scan: fixed patterns, and sliding-window Shannon entropy, in DataFrame functions only.

Fixed kinds are found by pattern; their places come from the lengths of the pieces between matches.
The entropy method looks at candidate strings (maximal runs of ``CANDIDATE`` with a digit and a letter).
What matches a pattern of ``ALLOWED`` is blanked first, so an allowed word ends a candidate and removes
itself only. A candidate's character class is hex or base64; a window of ``WINDOW`` characters slides over
it: one character leaves, one enters, and the sum of n * log2(n) over the window's counts changes by
what those two characters' counts say. A count is that of one character among the window's ``WINDOW``, so
a step costs the same wherever it is, and a candidate's time grows with its length. The sums are whole
numbers (n * log2(n) in units of 2**-40), so they carry no error along. The entropy is log2(window) - sum / window.
From the first to the last window at or above the class's bound is a span, unless a fixed span overlaps it.

Positions count code points; ends are exclusive. Defined results: null and empty texts have no spans;
rows are scanned one by one (repeated rows alike); whole texts are read, and a candidate of any length
is gone through once; an empty table gives no rows. Other columns pass through, whatever their names
(one named ``secrets`` is replaced).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimflow.llm.common import free_prefix

# fixed values of the contract: kind, pattern, group that must be long enough, its least length
BASE_KINDS = [
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
]
# a text can only match if it holds one of these
MARKS = {"assign": [":", "="], "access": ["AKIA"]}
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
WINDOW = 20
HEX_BITS = 3.0
BASE64_BITS = 3.9
# what is no secret, each with the number of characters it matches
ALLOWED = (
    (r"(?i)placeholder", 11), (r"(?i)changeme", 8), (r"(?i)example", 7), (r"(?i)sample", 6), (r"(?i)dummy", 5), (r"(?i)test", 4),
    (r"(?i)\b[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\b", 36),
    (r"0123456789", 10), (r"(?i)abcdefghij", 10),
    (r"([A-Za-z0-9+/_-])\1{5}", 6),
)
UNIT = 1 << 40
BLOCK = 256


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def add_matches(df: DataFrame, text: str, name: str, pattern: str, group: int = 0, marks=()) -> DataFrame:
    """``df`` with ``name``: an array of (start, end, part) of the pattern's matches, leftmost and not
    overlapping; part is the given group. Starts are running sums of piece and match lengths, by blocks,
    so a text with many matches takes little more than linear time."""
    none = F.array().cast("array<string>")
    may = F.lit(True)
    if marks:
        may = F.lit(False)
        for m in marks:
            may = may | F.contains(F.col(text), F.lit(m))
    found = lambda g: F.when(may, F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(g))).otherwise(none)
    m, part, gap, step, block = (f"{name}_{x}" for x in ("match", "part", "gap", "step", "block"))
    df = df.withColumns({m: F.coalesce(found(0), none)} | ({part: F.coalesce(found(group), none)} if group else {}))
    df = df.withColumn(gap, F.when(F.size(m) > 0, F.split(F.col(text), pattern, -1)).otherwise(none))
    df = df.withColumn(step, F.zip_with(F.slice(gap, 1, F.size(m)), F.col(m), lambda a, b: F.length(a) + F.length(b)))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(m) - 1) / BLOCK).cast("int")),
                         lambda b: _sum(F.slice(F.col(step), b * BLOCK + 1, F.lit(BLOCK))))
    df = df.withColumn(block, F.when(F.size(m) > 0, blocks).otherwise(F.array().cast("array<int>")))

    def place(x, i):
        whole = F.floor(i / BLOCK).cast("int")
        before = (_sum(F.slice(F.col(block), F.lit(1), whole))
                  + _sum(F.slice(F.col(step), whole * BLOCK + 1, i - whole * BLOCK)))
        start = before + F.length(F.get(F.col(gap), i))
        return F.struct(start.alias("start"), (start + F.length(x)).alias("end"),
                        (F.get(F.col(part), i) if group else x).alias("part"))

    return df.withColumn(name, F.transform(F.col(m), place)).drop(m, part, gap, step, block)


def _longer(least: int):
    return lambda x: F.length(x["part"]) >= least


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _equal(chars: Column, at: list[Column], to: Column) -> Column:
    """How many of the places hold the character ``to``."""
    n = F.lit(0)
    for i in at:
        n = n + (F.get(chars, i) == to).cast("int")
    return n


def entropy_span(part: Column, window: int = WINDOW, hex_bits: float = HEX_BITS,
                 base64_bits: float = BASE64_BITS) -> Column:
    """(first, last) window start at or above the class's bound in string ``part`` (first -1: none)."""
    bound = F.when(part.rlike("^[0-9a-fA-F]+$"), hex_bits).otherwise(base64_bits)
    terms = F.array(*[F.lit(round(n * math.log2(n) * UNIT) if n else 0) for n in range(window + 2)])
    # a tie at the bound counts as reached
    most = ((F.lit(math.log2(window)) - bound + 1e-9) * (window * UNIT)).cast("long")

    def spans(chars: Column, terms: Column, most: Column) -> Column:
        def change(i):
            """From window i to the next: character i leaves, character i + window enters."""
            out, into = F.get(chars, i), F.get(chars, i + window)
            left = _equal(chars, [i + k for k in range(window)], out)
            had = _equal(chars, [i + k for k in range(1, window)], into)
            return (F.get(terms, left - 1) - F.get(terms, left) + F.get(terms, had + 1) - F.get(terms, had))

        begin = F.slice(chars, 1, window)
        # a character that occurs n times gives its n-th part n times
        first = F.aggregate(F.array_distinct(begin), F.lit(0).cast("long"),
                            lambda a, c: a + F.get(terms, F.size(F.filter(begin, lambda x: x == c))))
        steps = F.size(chars) - window
        changes = F.when(steps > 0, F.transform(F.sequence(F.lit(0), F.greatest(steps - 1, F.lit(0))), change)).otherwise(
            F.array().cast("array<bigint>"))
        none = F.lit(-1)
        start = F.struct(F.lit(0).alias("i"), first.alias("s"), F.when(first <= most, 0).otherwise(none).alias("first"),
                         F.when(first <= most, 0).otherwise(none).alias("last"))

        def slide(acc, d):
            i, s = acc["i"] + 1, acc["s"] + d
            return F.struct(i.alias("i"), s.alias("s"), F.when((acc["first"] < 0) & (s <= most), i).otherwise(acc["first"]).alias("first"),
                            F.when(s <= most, i).otherwise(acc["last"]).alias("last"))

        return F.aggregate(changes, start, slide, lambda a: F.struct(a["first"].alias("first"), a["last"].alias("last")))

    return _let(F.split(part, "(?!$)"), lambda chars: _let(terms, lambda t: _let(most, lambda m: spans(chars, t, m))))


def blanked(text: Column, allowed=ALLOWED) -> Column:
    """The text with as many blanks in place of what is allowed; only texts with a candidate are gone through."""
    out = text
    for pattern, n in allowed:
        out = F.regexp_replace(out, pattern, " " * n)
    return F.when(text.rlike(CANDIDATE), out).otherwise("")


def find_secrets(docs: DataFrame, text_col: str = "text", allowed=ALLOWED) -> DataFrame:
    """``docs`` with secrets: an array of (start, kind_no, kind, end), by start, then kind as listed."""
    own = free_prefix(docs)
    text, masked, long, base = (f"{own}{x}" for x in ("text", "masked", "long", "base"))
    df = docs.withColumn(text, F.coalesce(F.col(text_col), F.lit("")))
    for kind, pattern, group, least in BASE_KINDS:
        df = add_matches(df, text, f"{own}{kind}", pattern, group, MARKS.get(kind, ()))
        df = df.withColumn(f"{own}{kind}", F.filter(f"{own}{kind}", _longer(least)))
    df = add_matches(df.withColumn(masked, blanked(F.col(text), allowed)), masked, long, CANDIDATE)
    df = df.withColumn(long, F.filter(long, lambda x: x["part"].rlike("[0-9]") & x["part"].rlike("[A-Za-z]")))
    df = df.withColumn(long, F.transform(long, lambda x: F.struct(
        x["start"].alias("start"), x["part"].alias("part"), entropy_span(x["part"]).alias("w"))))
    span = lambda no, kind, start, end: F.struct(
        start.cast("int").alias("start"), F.lit(no).alias("kind_no"), kind.alias("kind"), end.cast("int").alias("end"))

    def as_spans(no, kind):
        return F.transform(f"{own}{kind}", lambda x: span(no, F.lit(kind), x["start"], x["end"]))

    df = df.withColumn(base, F.concat(*[as_spans(no, kind) for no, (kind, *_) in enumerate(BASE_KINDS)]))
    added = F.transform(F.filter(long, lambda x: x["w"]["first"] >= 0), lambda x: span(
        len(BASE_KINDS), F.when(x["part"].rlike("^[0-9a-fA-F]+$"), "entropy_hex").otherwise("entropy_base64"),
        x["start"] + x["w"]["first"], x["start"] + x["w"]["last"] + WINDOW))
    added = F.filter(added, lambda a: ~F.exists(base, lambda b: (b["start"] < a["end"]) & (a["start"] < b["end"])))
    return (df.withColumn("secrets", F.array_sort(F.concat(F.col(base), added)))
            .drop(text, masked, base, long, *[f"{own}{kind}" for kind, *_ in BASE_KINDS]))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
