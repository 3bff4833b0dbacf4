"""BM25 ranking in DuckDB SQL."""

from __future__ import annotations

_TOK = "list_filter(regexp_split_to_array(lower({c}), '[^a-z0-9]+'), lambda t: length(t) > 0)"


def bm25_sql(queries: str, k: int, corpus: str = "SELECT doc_id, text FROM documents", where: str = "") -> str:
    """BM25 top-k; ``queries`` is a relation (query_id, query), ``corpus`` one of (doc_id, text); ``where``
    filters the scored pairs of query and document."""
    return f"""
WITH docs AS (SELECT doc_id, {_TOK.format(c='text')} AS toks FROM ({corpus}) corpus),
dl AS (SELECT doc_id, len(toks) AS dl FROM docs),
stats AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM dl),
qt AS (SELECT query_id, term, count(*) AS qtf FROM (
         SELECT query_id, unnest({_TOK.format(c='query')}) AS term FROM ({queries}) qq) GROUP BY ALL),
post AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(toks) AS term FROM docs)
         WHERE term IN (SELECT term FROM qt) GROUP BY ALL),
idf AS (SELECT term, ln(1.0::DOUBLE + (CAST((SELECT n FROM stats) AS DOUBLE) - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE))
          AS idf FROM (SELECT term, count(*) AS df FROM post GROUP BY term)),
w AS (SELECT p.doc_id, p.term, idf.idf * p.tf * 2.2::DOUBLE
             / (p.tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl.dl / (SELECT avgdl FROM stats))) AS w
      FROM post p JOIN dl ON p.doc_id = dl.doc_id JOIN idf ON p.term = idf.term),
sc AS (SELECT qt.query_id, w.doc_id, sum(w.w * qt.qtf) AS score FROM qt JOIN w ON qt.term = w.term {where} GROUP BY ALL)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank, doc_id, score
FROM sc QUALIFY rank <= {k}"""
