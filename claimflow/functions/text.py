"""Deterministic text defaults for the model-backed functions.

The source calls a hosted model; here each function is a native Spark
expression (JVM-side, codegen'd) that a caller may replace with an injected
scorer. The word lists below are this engine's own defaults, not the model's.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# FIXED VALUES — default lexicons and keyword rules of this engine.
POSITIVE_WORDS = ["good", "great", "excellent", "happy", "satisfied", "thank", "thanks", "helpful", "resolved",
                  "quick", "fast", "easy", "pleased", "love", "best", "fine", "nice", "glad", "appreciate", "well"]
NEGATIVE_WORDS = ["bad", "poor", "terrible", "angry", "unhappy", "frustrated", "slow", "delay", "delayed", "denied",
                  "cancel", "complaint", "worst", "hate", "problem", "issue", "error", "wrong", "refund", "never"]
SEVERITY_RULES = [  # first match wins; a rule matches when the text contains any of its keywords
    ("critical severity", ["fatal", "death", "total loss", "collapse", "explosion"]),
    ("high severity", ["injur", "hospital", "severe", "major", "fire", "flood", "theft", "stolen"]),
    ("low severity", ["minor", "scratch", "dent", "small", "cosmetic"]),
]
LOB_KEYWORDS = [  # vote order breaks ties
    ("AUTO", ["car", "vehicle", "collision", "accident", "driver", "road", "traffic"]),
    ("PROPERTY", ["house", "home", "roof", "fire", "flood", "water", "building", "property"]),
    ("WORKERS_COMP", ["injury", "workplace", "employee", "worker", "factory", "shift", "employer"]),
]


def tokens(text: Column) -> Column:
    """Lower-cased ASCII word tokens (non-letters split)."""
    return F.split(F.lower(text), "[^a-z]+")


def _hits(toks: Column, words: list[str]) -> Column:
    return F.size(F.filter(toks, lambda x: x.isin(*words)))


def sentiment(text: Column, toks: Column | None = None) -> Column:
    """G07 default: (positive - negative) / (positive + negative) in [-1, 1]; 0 when
    no lexicon word occurs; NULL text -> NULL. ``toks``: the text's ``tokens``, where a caller has them."""
    toks = tokens(text) if toks is None else toks
    p, n = _hits(toks, POSITIVE_WORDS), _hits(toks, NEGATIVE_WORDS)
    return F.when(text.isNull(), F.lit(None).cast("double")).when(p + n == 0, F.lit(0.0)) \
            .otherwise((p - n).cast("double") / (p + n))


def classify_severity(text: Column) -> Column:
    """G08 default: keyword rules (plain substring tests, code-generated); NULL text
    -> 'medium' (the source's fallback)."""
    low = F.lower(text)
    out = None
    for label, keywords in SEVERITY_RULES:
        cond = None
        for k in keywords:
            cond = low.contains(k) if cond is None else (cond | low.contains(k))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return F.when(text.isNull(), F.lit("medium")).otherwise(out.otherwise(F.lit("medium severity")))


def cut(text: Column, n_chars: int | None) -> Column:
    """The first ``n_chars`` characters, or the whole text (None)."""
    return text if n_chars is None else F.substring(text, 1, n_chars)


def classify_lob(text: Column, n_chars: int | None = None) -> Column:
    """G09 default: keyword vote over the text; NULL when no vote."""
    toks = tokens(cut(text, n_chars))
    votes = [(lob, _hits(toks, words)) for lob, words in LOB_KEYWORDS]
    best = F.greatest(*[v for _, v in votes])
    out = None
    for lob, v in votes:
        cond = (v == best) & (best > 0)
        out = F.when(cond, F.lit(lob)) if out is None else out.when(cond, F.lit(lob))
    return out


def summarize(text: Column, n: int = 2) -> Column:
    """G10 default: extractive summary — the ``n`` sentences with most long words
    (>= 5 letters), kept in their original order."""
    sents = F.split(F.trim(text), r"(?<=[.!?])\s+")
    scored = F.transform(sents, lambda s, i: F.struct(
        F.size(F.filter(tokens(s), lambda w: F.length(w) >= 5)).alias("score"), (-i).alias("neg_idx"), s.alias("s")))
    top = F.slice(F.sort_array(scored, asc=False), 1, n)
    ordered = F.sort_array(F.transform(top, lambda x: F.struct((-x["neg_idx"]).alias("i"), x["s"].alias("s"))))
    return F.array_join(F.transform(ordered, lambda x: x["s"]), " ")


def _parse_or_null(text: Column, schema: T.StructType | str) -> Column:
    """Parse JSON into ``schema``; NULL (not a struct of NULLs) when the text is not JSON."""
    return F.when(F.try_parse_json(text).isNotNull(), F.from_json(text, schema, {"mode": "PERMISSIVE"}))


def extract_json(reply: Column, schema: T.StructType | str) -> Column:
    """First flat ``{...}`` object in a reply, parsed; NULL when none parses."""
    obj = F.regexp_extract(reply, r"\{[^{}]*\}", 0)
    return F.when(F.length(obj) > 0, _parse_or_null(obj, schema))


def parse_model_reply(reply: Column, schema: T.StructType | str) -> Column:
    """Strip markdown code fences, then parse; NULL marks a parse error."""
    stripped = F.trim(F.regexp_replace(F.trim(reply), r"^```(json)?|```$", ""))
    return _parse_or_null(stripped, schema)
