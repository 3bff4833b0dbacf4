"""Domain views over the driver tables (TPC-H-ish star + events + text corpora).

Each function is a projection / join of the raw Parquet tables; filters and
column pruning from downstream operators reach the scans through Catalyst.
The same expressions are written as DuckDB CTEs in ``claimflow.checks.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimflow.constants import (ACTUARIAL_ROWS, APPLICATION_LOB_BY_MOD3, LOB_BY_MOD3,
                                 PATTERN_LOB_BY_MOD4, PATTERN_SEVERITY_BY_MOD4, STATEMENT_EVENTS, STATEMENT_PLACES,
                                 STATEMENT_TONES)

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations"]

PATTERN_EVERY = 25  # one embedding in so many is a fraud pattern, the others are claims: both sides grow

# A01 typed scan: the driver tables' schemas (fixed values, as the files declare them).
# Declaring them skips footer-based schema inference on every read.
DRIVER_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def pick(col: Column, values: list[str], modulus: int) -> Column:
    """Map ``col % modulus`` onto a fixed list of labels."""
    m = col % modulus
    out = F.when(m == 0, F.lit(values[0]))
    for i, v in enumerate(values[1:], start=1):
        out = out.when(m == i, F.lit(v))
    return out


class Tables:
    """Lazy loader of the driver's Parquet tables under one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._cache: dict[str, DataFrame] = {}
        self._scalars: dict[str, int] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._cache:
            # not spread here: the float aggregates (averages of FLOAT amounts) then sum in
            # file order, as the source does; a repartition would make them order-dependent
            reader = self.spark.read
            if name in DRIVER_SCHEMAS:
                reader = reader.schema(DRIVER_SCHEMAS[name])
            self._cache[name] = reader.parquet(f"{self.root}/{name}.parquet")
        return self._cache[name]

    # ---------------------------------------------------------------- customers
    def _doc_count(self) -> int:
        """Number of stored narratives (one scalar job per loader, not per use)."""
        if "_doc_count" not in self._scalars:
            self._scalars["_doc_count"] = max(self.raw("documents").count(), 1)
        return self._scalars["_doc_count"]

    def _nations(self) -> DataFrame:
        """The nation dimension, broadcast only after its size check (checked once)."""
        if "_nations" not in self._cache:
            from claimflow.session import bounded_broadcast
            self._cache["_nations"] = bounded_broadcast(self.raw("nation").select("n_nationkey", "n_name"))
        return self._cache["_nations"]

    def customers(self) -> DataFrame:
        c = self.raw("customer")
        n = self._nations()
        return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
                .select(
                    F.col("c_custkey").alias("customer_id"),
                    F.lit("Customer").alias("first_name"),
                    F.col("c_name").alias("last_name"),
                    F.when(F.col("c_custkey") % 50 == 0, F.lit(None).cast("string"))
                     .otherwise(F.concat(F.col("c_name"), F.lit("@x"))).alias("email"),
                    F.lit(None).cast("string").alias("phone"),
                    F.col("n_name").alias("city"),
                    F.col("c_mktsegment").alias("customer_segment"),
                    (F.col("c_acctbal") / 100.0).alias("lifetime_value_score"),
                    F.date_add(F.lit("1995-01-01").cast("date"),
                               (F.col("c_custkey") % 2000).cast("int")).alias("onboarding_date"),
                    F.col("c_nationkey").alias("nation_key"),
                ))

    # ---------------------------------------------------------------- policies
    def policies(self) -> DataFrame:
        o = self.raw("orders")
        start = F.to_date("o_orderdate")
        status = (F.when(F.col("o_orderstatus") == "O", "ACTIVE")
                  .when(F.col("o_orderstatus") == "F", "LAPSED")
                  .when((F.col("o_orderstatus") == "P") & (F.col("o_orderkey") % 2 == 0), "RENEWAL_PENDING")
                  .when(F.col("o_orderstatus") == "P", "PENDING"))
        return o.select(
            F.col("o_orderkey").alias("policy_id"),
            F.col("o_custkey").alias("customer_id"),
            pick(F.col("o_orderkey"), LOB_BY_MOD3, 3).alias("lob_type"),
            status.alias("policy_status"),
            start.alias("start_date"),
            F.date_add(start, 365).alias("end_date"),
            F.date_add(start, 335).alias("renewal_date"),
            (F.col("o_totalprice") * 0.02).alias("premium_annual"),
            (F.col("o_totalprice") / 2.0).alias("coverage_limit"),
            F.lit(500.0).alias("deductible"),
        )

    # ---------------------------------------------------------------- claims
    def _lineitem_orders(self) -> DataFrame:
        li = self.raw("lineitem")
        o = self.raw("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        return li.join(o, li.l_orderkey == o.o_orderkey, "left")

    @staticmethod
    def _claim_id() -> Column:
        return F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
                           F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"))

    @staticmethod
    def _statement() -> Column:
        """What the claimant says, from the claim's own columns: some state no date, or another date or amount
        than the claim has, some press, some are angry, some say nothing (NULL)."""
        day = F.date_add(F.to_date("l_shipdate"), F.when(F.col("l_partkey") % 7 == 0, 40).otherwise(0))
        shape = F.col("l_linenumber") % 3
        date = (F.when(shape == 0, F.date_format(day, "yyyy-MM-dd")).when(shape == 1, F.date_format(day, "dd/MM/yyyy"))
                .otherwise(F.date_format(day, "d MMMM yyyy")))
        when = F.when(F.col("l_partkey") % 4 == 0, F.lit("Some weeks ago")).otherwise(F.concat(F.lit("On "), date))
        amount = F.floor(F.col("l_extendedprice") * F.when(F.col("l_suppkey") % 6 == 0, 2.0).otherwise(1.0)).cast("string")
        urgent = F.when((F.col("l_linenumber") <= 4) & (F.col("l_partkey") % 2 == 0), " This is urgent, please pay immediately.") \
                  .when(F.col("l_linenumber") == 7, " There is no hurry.").otherwise("")
        said = F.concat(when, F.lit(" in "), pick(F.col("l_suppkey"), STATEMENT_PLACES, 7), F.lit(" there was "),
                        pick(F.col("l_partkey"), STATEMENT_EVENTS, 5), F.lit(". I claim INR "), amount, F.lit("."),
                        pick(F.col("l_suppkey"), STATEMENT_TONES, 3), urgent)
        return F.when(F.col("l_partkey") % 103 != 0, said)

    def claims(self, with_text: bool = False, with_text_key: bool = False, with_statement: bool = False) -> DataFrame:
        """Claims over lineitem x orders. ``with_text`` attaches the narrative text;
        ``with_text_key`` adds ``claim_text_id``, the key of the narrative in
        ``claim_texts()`` (text features can then be computed once per text); ``with_statement``
        adds the claimant's own statement as ``claim_text`` and the key of its vector in ``text_vectors()``."""
        lo = self._lineitem_orders()
        policy_id = (F.when(F.col("l_suppkey") % 31 == 0, F.lit(None).cast("long"))
                     .when(F.col("l_suppkey") % 29 == 0, F.lit(-1).cast("long"))
                     .otherwise(F.col("l_orderkey")))
        lob = F.when(F.col("l_partkey") % 10 == 0, F.lit("AUTO")).otherwise(pick(F.col("l_orderkey"), LOB_BY_MOD3, 3))
        ship = F.to_date("l_shipdate")
        status = (F.when(F.col("l_returnflag") == "N", "SUBMITTED")
                  .when(F.col("l_returnflag") == "A", "APPROVED")
                  .when(F.col("l_returnflag") == "R", "DENIED"))
        df = lo.select(
            self._claim_id().alias("claim_id"),
            policy_id.alias("policy_id"),
            F.when(F.col("l_partkey") % 97 == 0, F.lit(None).cast("long")).otherwise(F.col("o_custkey")).alias("customer_id"),
            lob.alias("lob_type"),
            F.when(F.col("l_partkey") % 101 == 0, F.lit(0.0)).otherwise(F.col("l_extendedprice")).alias("claimed_amount"),
            ship.alias("incident_date"),
            F.date_add(ship, F.col("l_linenumber")).cast("timestamp_ntz").alias("submission_date"),
            status.alias("claim_status"),
            F.col("l_orderkey").alias("text_key"),
            *([self._statement().alias("claim_text"),
               # a copycat's story has the vector of a known pattern, others that of their narrative
               F.when(F.col("l_suppkey") % 6 == 0, F.col("l_partkey") % 20 * PATTERN_EVERY)
                .otherwise(F.col("l_orderkey") % F.lit(self._doc_count())).alias("statement_vector_id")] if with_statement else []),
        )
        if with_text:
            df = self._attach_text(df, "text_key", "claim_text")
        if with_text_key:
            df = df.withColumn("claim_text_id", F.col("text_key") % F.lit(self._doc_count()))
        return df.drop("text_key")

    def claim_texts(self) -> DataFrame:
        """(text_id, text): the narratives claims point to through ``claim_text_id``."""
        return self.raw("documents").select(F.col("doc_id").alias("text_id"), "text")

    def text_vectors(self) -> DataFrame:
        """(claim_text_id, embedding): the vectors of the narratives that have one."""
        return self.raw("embeddings").select(F.col("vec_id").alias("claim_text_id"), "embedding")

    def claim_text_flags(self) -> DataFrame:
        """(claim_text_id, has_text, text_is_null): per stored narrative, whether it is
        present / non-empty — computed where the text is stored, so checks that only
        need these flags never move the text itself."""
        t = F.col("text")
        return self.raw("documents").select(F.col("doc_id").alias("claim_text_id"),
                                            (t.isNotNull() & (F.length(t) > 0)).alias("has_text"),
                                            t.isNull().alias("text_is_null"))

    def _attach_text(self, df: DataFrame, key: str, out: str, n_chars: int | None = None) -> DataFrame:
        """Attach documents.text at doc_id = key % count(documents); with ``n_chars`` only
        the first ``n_chars`` characters are projected, so the cut runs in the
        documents scan and only the prefix crosses the join exchange."""
        text = F.col("text") if n_chars is None else F.substring("text", 1, n_chars).alias("text")
        docs = self.raw("documents").select("doc_id", text)
        keyed = df.withColumn("_doc", F.col(key) % F.lit(self._doc_count()))  # one scalar; texts stay distributed
        return (keyed.join(docs, keyed["_doc"] == docs["doc_id"], "left")
                .withColumnRenamed("text", out).drop("_doc", "doc_id"))

    # ---------------------------------------------------------------- payments
    def payments(self) -> DataFrame:
        lo = self._lineitem_orders()
        ship = F.to_date("l_shipdate")
        order = F.to_date("o_orderdate")
        delay = (F.abs(F.datediff(ship, order)) % 20).cast("long")
        return lo.select(
            self._claim_id().alias("payment_id"),
            F.col("l_orderkey").alias("policy_id"),
            F.col("o_custkey").alias("customer_id"),
            order.alias("due_date"),
            F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1), F.lit(None).cast("date"))
             .otherwise(ship).alias("payment_date"),
            F.col("l_extendedprice").alias("amount"),
            F.when(delay > 15, "MISSED").when(delay > 5, "LATE").otherwise("PAID").alias("payment_status"),
            F.when(F.col("l_linestatus") == "O", "AUTO_DEBIT").otherwise("CARD").alias("payment_method"),
            delay.alias("days_delayed"),
        )

    # ---------------------------------------------------------------- interactions
    def interactions(self, with_text: bool = False, text_chars: int | None = None, with_text_key: bool = False) -> DataFrame:
        """Interactions over ``events``; ``with_text`` attaches ``transcript_text``, cut to
        ``text_chars`` characters on the documents side (before the join) when given;
        ``with_text_key`` adds ``transcript_id``, its key in ``transcript_texts()``."""
        e = self.raw("events")
        k = F.get_json_object("props", "$.k").cast("long")
        df = e.select(
            F.col("event_id").alias("interaction_id"),
            F.col("user_id").alias("customer_id"),
            F.col("event_type").alias("channel"),
            F.col("ts").alias("interaction_date"),
            F.when((F.col("event_type") == "error") & (k < 20), "ESCALATED").otherwise("RESOLVED").alias("resolution_status"),
            F.when((F.col("event_type") == "view") & (F.col("event_id") % 5 == 0),
                   F.floor("value").cast("long") % 11).alias("nps_score"),
            (((F.col("user_id") % 5) - 2) * F.lit(0.3) + (k - 50) / F.lit(250.0)).alias("sentiment"),
        )
        if with_text:
            df = self._attach_text(df, "interaction_id", "transcript_text", text_chars)
        if with_text_key:
            df = df.withColumn("transcript_id", F.col("interaction_id") % F.lit(self._doc_count()))
        return df

    def transcript_texts(self) -> DataFrame:
        """(text_id, text): the transcripts interactions point to through ``transcript_id``."""
        return self.claim_texts()

    # ---------------------------------------------------------------- providers
    def providers(self) -> DataFrame:
        s = self.raw("supplier")
        return s.select(
            F.col("s_suppkey").alias("provider_id"),
            F.col("s_name").alias("provider_name"),
            pick(F.col("s_suppkey"), LOB_BY_MOD3, 3).alias("lob_type"),
            (F.col("s_acctbal") < 0).alias("risk_flag"),
        )

    # ---------------------------------------------------------------- vectors
    def fraud_patterns(self) -> DataFrame:
        e = self.raw("embeddings").filter(F.col("vec_id") % PATTERN_EVERY == 0)
        return e.select(
            F.col("vec_id").alias("pattern_id"),
            F.concat(F.lit("PATTERN_"), F.col("label").cast("string")).alias("pattern_type"),
            F.concat(F.lit("fraud pattern "), F.col("vec_id").cast("string")).alias("pattern_description"),
            F.col("embedding").alias("pattern_embedding"),
            pick(F.col("label"), PATTERN_SEVERITY_BY_MOD4, 4).alias("severity"),
            pick(F.col("label"), PATTERN_LOB_BY_MOD4, 4).alias("lob_type"),
        )

    def fraud_narratives(self) -> DataFrame:
        """(pattern_id, pattern_type, severity, example_narrative): the fraud patterns' example texts."""
        e = self.raw("embeddings").filter(F.col("vec_id") % PATTERN_EVERY == 0)
        turn = F.floor(F.col("vec_id") / PATTERN_EVERY).cast("long")
        return e.select(
            F.col("vec_id").alias("pattern_id"), F.concat(F.lit("PATTERN_"), F.col("label").cast("string")).alias("pattern_type"),
            pick(F.col("label"), PATTERN_SEVERITY_BY_MOD4, 4).alias("severity"),
            F.concat(F.lit("Staged report of "), pick(turn, STATEMENT_EVENTS, 5), F.lit(" near "),
                     pick(turn, STATEMENT_PLACES, 7)).alias("example_narrative"))

    def claim_embeddings(self) -> DataFrame:
        e = self.raw("embeddings").filter(F.col("vec_id") % PATTERN_EVERY != 0)
        return e.select(
            F.col("vec_id").alias("claim_id"),
            F.floor(F.col("vec_id") / 3).cast("long").alias("customer_id"),
            pick(F.col("label"), LOB_BY_MOD3, 3).alias("lob_type"),
            F.col("embedding").alias("claim_embedding"),
        )

    # ---------------------------------------------------------------- underwriting
    def applications(self) -> DataFrame:
        c = self.raw("customer")
        return c.select(
            F.col("c_custkey").alias("application_id"),
            F.col("c_name").alias("applicant_name"),
            F.when(F.col("c_custkey") % 2 == 0, F.col("c_custkey").cast("string")).alias("existing_customer_id"),
            pick(F.col("c_custkey"), APPLICATION_LOB_BY_MOD3, 3).alias("lob_type"),
            (F.lit(100000.0) + F.col("c_custkey") * 10.0).alias("coverage_requested"),
            F.when(F.col("c_custkey") % 41 == 0, F.lit(None).cast("long"))
             .otherwise(F.lit(550) + F.col("c_custkey") % 300).cast("long").alias("credit_score"),
            F.when(F.col("c_nationkey") % 7 == 0, F.lit(None).cast("string"))
             .when(F.col("c_nationkey") % 2 == 0, "CHENNAI_GENERAL")
             .otherwise("BANGALORE_METRO").alias("geographic_zone"),
            F.date_add(F.lit("2001-01-01").cast("date"), (F.col("c_custkey") % 365).cast("int"))
             .cast("timestamp_ntz").alias("submission_date"),
            F.lit("PENDING").alias("status"),
        )

    def actuarial(self) -> DataFrame:
        schema = ("table_id string, lob_type string, risk_tier string, geographic_zone string, "
                  "base_rate double, risk_multiplier double, geographic_factor double, "
                  "claims_history_factor double, effective_date string, expiry_date string")
        df = self.spark.createDataFrame(ACTUARIAL_ROWS, schema)
        return (df.withColumn("effective_date", F.col("effective_date").cast("date"))
                  .withColumn("expiry_date", F.col("expiry_date").cast("date")))

    # ---------------------------------------------------------------- claim states
    def claim_states(self, as_of: str) -> DataFrame:
        """Pipeline states of claims at every stage, some of them started long before the check or failed."""
        state = pick(F.col("l_linenumber"), ["VALIDATION", "FRAUD_CHECK", "ASSESSMENT", "RESOLUTION", "COMPLETED", "FAILED"], 6)
        now = F.lit(f"{as_of} 00:00:00").cast("timestamp_ntz")
        started = now - F.make_dt_interval(mins=(F.col("l_partkey") % 11).cast("int"))
        return self.raw("lineitem").select(
            self._claim_id().alias("claim_id"), state.alias("current_state"), started.alias("started_at"),
            F.when(state == "COMPLETED", now + F.make_dt_interval(days=(F.col("l_suppkey") % 2 - 1).cast("int"))).alias("completed_at"),
            F.lit(None).cast("string").alias("error_message"), (F.col("l_partkey") % 101 == 0).alias("failed"))

    # ---------------------------------------------------------------- alerts
    def alerts(self, as_of: str) -> DataFrame:
        """Earlier churn alerts of some customers: open and recent, in progress, open but old, and worked ones."""
        from claimflow.operators.churn import empty_alerts
        key = F.col("c_custkey") % 10
        day = F.date_sub(F.lit(as_of).cast("date"), F.when(key == 0, 3).when(key == 1, 6).when(key == 2, 30).otherwise(2))
        rows = self.raw("customer").where(key < 4).select(
            F.concat(F.lit("EARLIER-"), F.col("c_custkey").cast("string")).alias("alert_id"), F.col("c_custkey").alias("customer_id"),
            day.alias("alert_date"), F.when(key == 1, "IN_PROGRESS").when(key == 3, "ACTIONED").otherwise("NEW").alias("status"))
        return empty_alerts(self.spark).unionByName(rows, allowMissingColumns=True)

    # ---------------------------------------------------------------- forms
    def claim_forms(self) -> DataFrame:
        """What an intake form sends for each SUBMITTED claim: its JSON columns as text, some of it broken
        (a file name with quotes), some missing."""
        c = self.claims().where("claim_status = 'SUBMITTED'")
        n = F.crc32(F.col("claim_id").cast("binary"))
        name = F.when(n % 50 == 0, F.lit('roof "east".jpg')).otherwise(F.concat(F.lit("photo-"), (n % 1000).cast("string"), F.lit(".jpg")))
        return c.select(
            "claim_id", "policy_id", "customer_id", "incident_date", "claimed_amount", "lob_type",
            F.concat(F.lit('{"source": "WEB_INTAKE", "submitted_by": "IDP", "lob": "'), "lob_type",
                     F.lit('", "dq_validated": true}')).alias("metadata"),
            F.when(n % 3 != 0, F.concat(F.lit('[{"doc_id": "DOC-'), n.cast("string"), F.lit('", "type": "PHOTO", "file": "'), name,
                                        F.lit('"}]'))).alias("supporting_docs"))

    def application_forms(self, lob: str) -> DataFrame:
        """Forms of one line of business: each third customer, as text; some without the name."""
        c = self.raw("customer").where(F.col("c_custkey") % 3 == LOB_BY_MOD3.index(lob))
        key = F.col("c_custkey")
        name = F.when(key % 50 != 0, F.col("c_name"))
        own = {"AUTO": {"applicant_name": name, "vehicle_make_model_year": F.concat(F.lit("Model "), (key % 7).cast("string")),
                        "coverage_limit": (key * 10).cast("string"), "deductible_amount": F.lit("500")},
               "PROPERTY": {"applicant_name": name, "property_address": F.concat(F.lit("Street "), key.cast("string")),
                            "property_type": F.when(key % 2 == 0, "HOUSE").otherwise("FLAT"),
                            "coverage_limit": F.when(key % 20 == 0, F.lit("a lot")).otherwise((key * 100).cast("string")),
                            "deductible_amount": F.lit("1000")},
               "WORKERS_COMP": {"employer_name": name, "employee_count": (key % 90).cast("string"),
                                "payroll_amount": (key * 1000).cast("string")}}[lob]
        return c.select(F.concat(F.lit("APP-"), key.cast("string")).alias("application_id"), F.lit("2001-09-01").alias("policy_start_date"),
                        *[v.alias(k) for k, v in own.items()])

    # ---------------------------------------------------------------- text corpora
    def documents(self) -> DataFrame:
        return self.raw("documents")

    def guidelines(self) -> DataFrame:
        """Underwriting guideline passages: the document corpus, each passage headed by the LOB and tier it is for."""
        d = self.raw("documents")
        lob = pick(F.col("doc_id"), APPLICATION_LOB_BY_MOD3, 3)
        tier = pick(F.floor(F.col("doc_id") / 3), ["LOW", "MEDIUM", "HIGH"], 3)
        return d.select(F.col("doc_id").alias("guideline_id"), lob.alias("lob_type"), tier.alias("risk_tier"),
                        F.concat(lob, F.lit(" "), tier, F.lit(" underwriting guideline. "), F.coalesce("text", F.lit("")))
                        .alias("content"))

    def benchmark(self) -> DataFrame:
        return self.raw("benchmark")
