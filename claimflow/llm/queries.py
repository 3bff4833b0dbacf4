"""Registered queries of the training-data operators, over the whole tables they are meant for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimflow.llm import (
    jaccard_join,
    license_scan,
    mixing,
    orc_tokens,
    ordinal_quality,
    prefix_trie,
    pseudonyms,
    quality_outliers,
    reversed_search,
    secret_scan,
    suffix_dedup,
    url_filter,
    winnowing,
)
from claimflow.llm.common import output_folder, read_table, small_batches

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(fn):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = query
    return fn


@register
def op1_jaccard_join(spark, sf_dir):
    classes = jaccard_join.jaccard_classes(read_table(spark, sf_dir, "documents"))
    return classes.select("doc_id", "class_id", "copy_of", "n_links")


@register
def op2_quality_rules(spark, sf_dir):
    return quality_outliers.quality_rules(read_table(spark, sf_dir, "documents"))


@register
def op3_suffix_dedup(spark, sf_dir):
    left = suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_bytes", "n_removed", F.size("runs").cast("long").alias("n_spans"), "kept_sha256",
                       F.make_valid_utf8(F.col("kept").cast("string")).alias("text"))


@register
def op4_pareto_mix(spark, sf_dir):
    mixed = mixing.mix(read_table(spark, sf_dir, "documents"), weight=mixing.damped)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


@register
def op5_ordinal_quality(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    grade = F.col("quality") + 1 - F.col("toxic")
    return (ordinal_quality.quality_classifier(docs, read_table(spark, sf_dir, "labels"), grade)
            .select("doc_id", "expected_grade", "p_top", "kept"))


@register
def op6_secret_scan(spark, sf_dir):
    found = secret_scan.find_secrets(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    of = lambda kind: F.filter("secrets", lambda x: x["kind"] == kind)
    base = F.filter("secrets", lambda x: x["kind_no"] < len(secret_scan.BASE_KINDS))
    return found.select("doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k, *_ in secret_scan.BASE_KINDS],
                        F.sha2(secret_scan.listed(base), 256).alias("base_sha256"),
                        secret_scan.listed(F.col("secrets")).alias("spans"))


def tokenizer_path() -> str:
    """The tokenizer that the registered queries use; operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@register
def op7_orc_tokens(spark, sf_dir):
    path = output_folder(spark, "orc_tokens")
    orc_tokens.write_tokens(read_table(spark, sf_dir, "documents"), path, tokenizer_path())
    return orc_tokens.token_digest(spark, path)


PSEUDONYM_KEY = "registered-query"  # a job passes its own secret


@register
def op8_feistel_pseudonyms(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonyms.pseudonymise(docs, PSEUDONYM_KEY)


@register
def op9_winnowing(spark, sf_dir):
    judged = winnowing.decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return judged.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                         F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
                         winnowing.contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"))


ORACLE["op9_winnowing"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bi AS (SELECT item, w, least(len(w), 13) AS n, unnest(range(len(w) - least(len(w), 13) + 1)) AS i FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item, n, array_to_string(w[i + 1 : i + n], ' ') AS s FROM bi),
sizes AS (SELECT DISTINCT n FROM bw),
di AS (SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n),
dw AS (SELECT doc_id, i, n, array_to_string(w[i + 1 : i + n], ' ') AS s FROM di),
hit AS (SELECT dw.doc_id, dw.i, dw.n, bw.item FROM dw JOIN bw ON dw.n = bw.n AND dw.s = bw.s),
spots AS (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM hit),
cover AS (SELECT doc_id, count(*) AS n_hit FROM spots GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS l FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(l, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN cover ON d.doc_id = cover.doc_id LEFT JOIN named ON d.doc_id = named.doc_id
"""


# fixed values of the contract
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
             ("block", "com/de/")]


def labelled_urls(spark) -> DataFrame:
    """A small labelled table: hosts of each kind under several domains and paths (label 1: block)."""
    blocked = ["spam-farm", "adult-x", "casino-win", "free-pills", "xxx-videos", "warez-crack", "phish-login", "bet-slots",
               "cheap-meds", "clickbait-ads", "spamlinks", "adult-cams"]
    allowed = ["news", "blog.garden", "docs.library", "wiki", "school", "museum", "weather", "m.reader", "www.journal",
               "health", "blog.travel", "science", "archive", "recipes", "city-council", "open-data"]
    rows = []
    for label, hosts in ((1, blocked), (0, allowed)):
        for n, host in enumerate(hosts):
            end = ("com", "net", "org", "example.com", "example.net")[n % 5]
            lang = ("en", "de", "fr", "es")[n % 4]
            rows += [(f"https://{host}.{end}/{lang}/{100 + 37 * n}", label), (f"http://www.{host}.{end}/{lang}/", label),
                     (f"https://{host}.{('net', 'com')[n % 2]}/index.html", label)]
    return spark.createDataFrame(rows, "url string, label int")


@register
def op10_url_filter(spark, sf_dir):
    judged = url_filter.filter_urls(read_table(spark, sf_dir, "pages").select("page_id", "url"), labelled_urls(spark), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "p_block")


@register
def op11_prefix_trie(spark, sf_dir):
    keys = prefix_trie.turn_keys(read_table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(prefix_trie.respliced(keys))


@register
def op12_reversed_search(spark, sf_dir):
    return reversed_search.search(read_table(spark, sf_dir, "benchmark"), read_table(spark, sf_dir, "documents"))


ORACLE["op12_reversed_search"] = r"""
WITH d AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM documents),
tf AS (SELECT doc_id, t, count(*) AS tf FROM d GROUP BY doc_id, t),
size AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
every AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM size),
df AS (SELECT t, count(*) AS df FROM tf GROUP BY t),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
scored AS (SELECT item_id, doc_id, CAST(sum(CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT)
    * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM q JOIN tf USING (t) JOIN df USING (t) JOIN size USING (doc_id), every GROUP BY item_id, doc_id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


@register
def op13_license_scan(spark, sf_dir):
    return license_scan.scan(read_table(spark, sf_dir, "documents"))


ORACLE["op13_license_scan"] = license_scan.oracle_sql()


ORACLE["op11_prefix_trie"] = """
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS pos, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT DISTINCT conv_id, flatten([[ascii(ch), -1, -1, -1, -1, -1, -1, -1, -1] for ch in string_split(CAST(conv_id AS VARCHAR), '')]) AS steps FROM t),
c AS (SELECT conv_id, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], [CAST(x AS BIGINT) for x in steps]),
  lambda v, s: CASE WHEN s >= 0 THEN xor(v, s) ELSE xor(v >> 1, (v & 1) * CAST(3988292384 AS BIGINT)) END), CAST(4294967295 AS BIGINT)) % 9 AS h FROM ids),
r AS (SELECT c.conv_id, pos, role, text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 5 AND pos < h
  UNION ALL SELECT conv_id, pos, role, text FROM c JOIN t USING (conv_id) WHERE pos >= h),
s AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY pos) AS depth, role, text FROM r),
q AS (SELECT conv_id, depth, strlen(text) AS nb, string_agg(sha256(role) || sha256(text), '') OVER (PARTITION BY conv_id ORDER BY depth) AS prefix FROM s
  UNION ALL SELECT conv_id, 0, 0, '' FROM c),
l AS (SELECT conv_id, max(depth) AS len FROM q GROUP BY conv_id),
node AS (SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n, any_value(nb) AS nb,
  string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (depth = len) AS ends FROM q JOIN l USING (conv_id) GROUP BY prefix, depth),
pair AS (SELECT DISTINCT a.prefix AS ap, a.depth AS ad, b.prefix AS bp, b.depth AS bd FROM q a JOIN q b ON a.conv_id = b.conv_id AND b.depth >= a.depth),
kids AS (SELECT ap, ad, count(*) AS n_children FROM pair WHERE bd = ad + 1 GROUP BY ap, ad),
below AS (SELECT p.ap, p.ad, count(*) FILTER (k.n_children IS NULL) AS n_leaves, sum((n.n - 1) * n.nb) AS saved
  FROM pair p JOIN node n ON n.prefix = p.bp AND n.depth = p.bd LEFT JOIN kids k ON k.ap = p.bp AND k.ad = p.bd GROUP BY p.ap, p.ad),
up AS (SELECT p.bp, p.bd, n.conv_id AS parent FROM pair p JOIN node n ON n.prefix = p.ap AND n.depth = p.ad WHERE p.bd = p.ad + 1)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, parent AS parent_conv_id, CAST(n.n AS BIGINT) AS n_convs,
  CAST(coalesce(n_children, 0) AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
  sha256(coalesce(ends, '')) AS ends_sha256
FROM node n JOIN below b ON b.ap = n.prefix AND b.ad = n.depth LEFT JOIN kids k ON k.ap = n.prefix AND k.ad = n.depth
LEFT JOIN up ON up.bp = n.prefix AND up.bd = n.depth
"""
