"""Op 13 against every block and every template."""

import pytest

from claimflow.checks.compare import compare
from claimflow.llm import license_scan, queries
from claimflow.llm.license_scan import BLOCK, PHRASES, TEMPLATES, needed, template_words
from tables import MEDIUM

SCHEMA = "doc_id long, text string, id string, t int, hits string, r int"


def brute(docs, templates=TEMPLATES, phrases=PHRASES, threshold=0.9):
    out = []
    for doc, text in docs:
        w = template_words(text or "")
        found = [(i, label) for p, label in phrases for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        labels, score = {x for _, x in found}, 0.0
        base = ",".join(sorted(labels))
        for at in range(0, max(len(w), 1), BLOCK // 2):
            block = set(w[at : at + BLOCK])
            for label, t in templates:
                want = set(template_words(t))
                if len(want & block) >= needed(len(want), threshold):
                    labels, score = labels | {label}, max(score, len(want & block) / len(want))
        places = [i for i, _ in found]
        out.append((doc, len(w), len(found), min(places, default=None), max(places, default=None), base, ",".join(sorted(labels)),
                    1.0 if found else score))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_equals_sql(spark):
    ok, said = compare(queries.QUERIES["op13_license_scan"](spark, MEDIUM), queries.ORACLE["op13_license_scan"], MEDIUM)
    assert ok, said


def notice(n, drop=0, pad="word"):
    words = template_words(TEMPLATES[n][1])
    return " ".join([pad] * 70 + words[drop:] + [pad] * 90)


DOCS = [(1, None), (2, ""), (3, " --- "), (4, "The MIT License; mit\nlicense, mit x license"), (5, "GNU General Public License general public license"),
        *[(10 + n, notice(n)) for n in range(len(TEMPLATES))], *[(30 + n, notice(n, 3)) for n in range(len(TEMPLATES))],
        *[(50 + n, notice(n, 9)) for n in range(len(TEMPLATES))], (70, notice(0) * 40), (71, "the software " * 30_000 + notice(3)),
        (72, TEMPLATES[0][1].upper()), (72, TEMPLATES[1][1]), (72, TEMPLATES[1][1]), (None, notice(5)),
        (73, " ".join(w + " filler" * 6 for w in template_words(TEMPLATES[0][1]))), (74, "É license mit Élicense")]


@pytest.mark.parametrize("threshold", [0.9, 0.6])
def test_notices_odd_rows_and_clashing_names(spark, threshold):
    df = spark.createDataFrame([(*d, "a", 1, "b", 2) for d in DOCS], SCHEMA)
    want = brute(DOCS, threshold=threshold)
    assert rows_of(license_scan.scan(df, threshold=threshold)) == want
    assert {x for r in want for x in r[6].split(",")} >= {label for label, _ in TEMPLATES}
    assert len({r[7] for r in want}) > 2


def test_own_templates_and_empty_table(spark, no_docs, odd_docs):
    own = [("greek", "alpha beta gamma delta epsilon zeta"), ("short", "one")]
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert rows_of(license_scan.scan(odd_docs, own, [("same words", "same")])) == brute(docs, own, [("same words", "same")])
    assert license_scan.scan(no_docs).count() == 0
    with pytest.raises(ValueError):
        license_scan.scan(odd_docs, [("long", "w " * 65)])
