"""Extraction grammar over a claim's own words: dates, amounts, places, urgency, line of business.

Native expressions in place of a hosted model's entity extraction (H11) and narrative analysis (H16);
patterns and word lists are this engine's own. A text that states nothing gives NULLs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimflow.functions.text import LOB_KEYWORDS, SEVERITY_RULES, classify_lob, classify_severity, sentiment, tokens

# FIXED VALUES — this engine's own grammar
MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]
DATE_PATTERN = r"\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2} (?:" + "|".join(MONTHS) + r") \d{4}"
DATE_FORMATS = ["yyyy-MM-dd", "d/M/yyyy", "d MMMM yyyy"]
AMOUNT_PATTERN = r"(?:INR|Rs|USD|EUR)\.? ?(\d[\d,]*(?:\.\d+)?)"
PLACE_PATTERN = r"\b(?:in|at|near) ([A-Z][a-z]+(?: [A-Z][a-z]+)?)"
URGENT_WORDS = ["urgent", "urgently", "immediately", "emergency", "asap"]
CALM_PATTERN = r"\bno (?:hurry|rush)\b"
SEARCH_WORDS = sorted({w for _, words in LOB_KEYWORDS for w in words}
                      | {w for _, words in SEVERITY_RULES for w in words if " " not in w})


def stated_date(text: Column) -> Column:
    """The first date in the text, in any of three shapes. Its separator tells the shape, so no other format is tried
    (a format that does not fit costs an exception)."""
    found = F.regexp_extract(text, DATE_PATTERN, 0)
    dashes, slashes, words = [F.try_to_timestamp(found, F.lit(f)).cast("date") for f in DATE_FORMATS]
    return F.when(found.contains("-"), dashes).when(found.contains("/"), slashes).when(found != "", words)


def stated_amount(text: Column) -> Column:
    """The first amount with a currency, thousands separators allowed."""
    return F.regexp_replace(F.nullif(F.regexp_extract(text, AMOUNT_PATTERN, 1), F.lit("")), ",", "").try_cast("double")


def stated_place(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, PLACE_PATTERN, 1), F.lit(""))


def urgency(text: Column, toks: Column | None = None) -> Column:
    """HIGH for a word of pressure, LOW for words of patience, else MEDIUM. ``toks``, here and below: the text's ``tokens``
    as a column of their own, so that they are split once for all that read them."""
    pressed = F.exists(tokens(text) if toks is None else toks, lambda w: w.isin(*URGENT_WORDS))
    return F.when(pressed, "HIGH").when(F.lower(text).rlike(CALM_PATTERN), "LOW").otherwise("MEDIUM")


def lob_votes(text: Column, toks: Column | None = None) -> list[Column]:
    def count(words: list[str]) -> Column:
        return F.size(F.filter(tokens(text) if toks is None else toks, lambda w: w.isin(*words)))

    return [count(words) for _, words in LOB_KEYWORDS]


def claim_facts(text: Column) -> Column:
    """H11's entity struct (NULL for a NULL text); the fields are those of ``INTAKE_V1_SCHEMA``."""
    votes = lob_votes(text)
    every = reduce(lambda a, b: a + b, votes)
    no_name = F.lit(None).cast("string")
    return F.when(text.isNotNull(), F.struct(
        no_name.alias("claimant_name"), no_name.alias("policy_number"), stated_date(text).cast("string").alias("incident_date"),
        stated_place(text).alias("incident_location"), classify_lob(text).alias("lob_classification"),
        F.when(every > 0, F.greatest(*votes) / every).alias("lob_confidence"), stated_amount(text).alias("claimed_amount"),
        no_name.alias("damage_description"), urgency(text).alias("urgency_level"),
        (reduce(lambda a, b: a + b, [F.when(v > 0, 1).otherwise(0) for v in votes]) > 1).alias("multi_lob_indicator"),
        classify_severity(text).alias("estimated_severity")))


def search_words(text: Column, toks: Column | None = None) -> Column:
    """What a lexical search of incident patterns can match on: the text's distinct key words, in order. Claims
    with the same words ask the same query; there are far fewer of these than claims."""
    return F.array_join(F.array_sort(F.array_distinct(F.filter(tokens(text) if toks is None else toks, lambda w: w.isin(*SEARCH_WORDS)))), " ")


def narrative_risk(text: Column, incident_date: Column, claimed_amount: Column, toks: Column | None = None,
                   date: Column | None = None, amount: Column | None = None) -> Column:
    """H16's narrative sub-score: a quarter each for a vague text (no date, no amount or no line of business in it),
    one at odds with the claim (another date, or an amount more than 1 away), an angry one (sentiment
    below -0.3), and pressure. NULL for a NULL text. ``date`` and ``amount``: what the text states, as columns."""
    date = stated_date(text) if date is None else date
    amount = stated_amount(text) if amount is None else amount
    vague = date.isNull() | amount.isNull() | (reduce(lambda a, b: a + b, lob_votes(text, toks)) == 0)
    odd = (F.coalesce(date != incident_date, F.lit(False))
           | F.coalesce(F.abs(amount - claimed_amount) > 1, F.lit(False)))
    flags = [vague, odd, sentiment(text, toks) < -0.3, urgency(text, toks) == "HIGH"]
    return F.when(text.isNotNull(), reduce(lambda a, b: a + b, [F.when(f, 0.25).otherwise(0.0) for f in flags]))
