"""Ingest of form rows (A08 claims with JSON columns, A09 applications of three lines of business).

A form row that the source's statement would refuse is not loaded: it comes back with the reasons, so that
one bad form never fails a batch and nothing is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimflow.functions.dates import as_ts

JSON_COLUMNS = ("metadata", "supporting_docs")

# fixed values: the columns that a form of each line of business fills, with their types, and the one it must fill
APPLICATION_FORMS = {
    "AUTO": (["applicant_name string", "vehicle_make_model_year string", "policy_start_date date", "coverage_limit double",
              "deductible_amount double"], "applicant_name"),
    "PROPERTY": (["applicant_name string", "property_address string", "property_type string", "policy_start_date date",
                  "coverage_limit double", "deductible_amount double"], "applicant_name"),
    "WORKERS_COMP": (["employer_name string", "employee_count int", "payroll_amount double", "policy_start_date date"],
                     "employer_name"),
}
# fixed values: column defaults of the three application tables
APPLICATION_DEFAULTS = {
    "AUTO": {"driving_history_violations": 0, "number_of_drivers": 1},
    "PROPERTY": {"security_system_flag": False, "prior_claims_declared": 0},
    "WORKERS_COMP": {"prior_claims_3yr": 0, "safety_program_flag": False, "osha_violations_count": 0},
}


def _key(prefix: str, cols: list[str]) -> Column:
    """An id from the row's own values, so that a replay gives the same one."""
    return F.concat(F.lit(prefix), F.upper(F.substring(F.sha2(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}), 256), 1, 24)))


def ingest_claims(forms: DataFrame, as_of, id_col: str = "claim_id") -> tuple[DataFrame, DataFrame]:
    """(claims, rejected). The texts of ``JSON_COLUMNS`` become VARIANT columns (NULL text: the JSON
    null); a text that is not JSON rejects the row. Status SUBMITTED, submission and creation at ``as_of``,
    an id from the row's values where the form has none."""
    given = [c for c in forms.columns if c != id_col]
    own = F.col(id_col) if id_col in forms.columns else F.lit(None).cast("string")
    parsed = forms.select(
        F.coalesce(own, _key("CLM-", given)).alias(id_col), *[c for c in given if c not in JSON_COLUMNS],
        *[F.try_parse_json(F.coalesce(F.col(c), F.lit("null"))).alias(c) for c in JSON_COLUMNS])
    reasons = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(f"{c.upper()}_NOT_JSON")) for c in JSON_COLUMNS]))
    judged = parsed.withColumn("_reasons", reasons)
    claims = judged.where(F.size("_reasons") == 0).drop("_reasons").withColumns({
        "claim_status": F.lit("SUBMITTED"), "submission_date": as_ts(as_of), "created_at": as_ts(as_of)})
    rejected = judged.where(F.size("_reasons") > 0).select(id_col, F.array_join("_reasons", ",").alias("reason"))
    return claims, rejected


def ingest_applications(forms: DataFrame, lob: str, as_of) -> tuple[DataFrame, DataFrame]:
    """(applications, rejected) of one line of business: its own columns, its table's defaults, status
    PENDING. A form without the name it must have is rejected."""
    fields, must = APPLICATION_FORMS[lob]
    cols = []
    for f in fields:
        name, kind = f.split()
        cols.append((F.col(name).try_cast(kind) if name in forms.columns else F.lit(None).cast(kind)).alias(name))
    names = [f.split()[0] for f in fields]
    own = F.col("application_id") if "application_id" in forms.columns else F.lit(None).cast("string")
    rows = forms.select(own.alias("application_id"), *cols)
    named = F.coalesce(F.trim(F.col(must)) != "", F.lit(False))
    rows = rows.withColumn("application_id", F.coalesce("application_id", _key("APP-", names)))
    loaded = rows.where(named).withColumns({**{c: F.lit(v) for c, v in APPLICATION_DEFAULTS[lob].items()},
                                            "submission_date": as_ts(as_of), "status": F.lit("PENDING")})
    rejected = rows.where(~named).select("application_id", F.lit(f"{must.upper()}_REQUIRED").alias("reason"))
    return loaded, rejected


def write_applications(rows: DataFrame, path: str, lob: str, day: str) -> None:
    """One day's applications of one line of business. Spark's dynamic partition overwrite replaces that
    (lob_type, ingest_day) partition only, so a replayed load changes nothing else."""
    (rows.withColumns({"lob_type": F.lit(lob), "ingest_day": F.lit(day)}).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("lob_type", "ingest_day").parquet(path))


def read_applications(spark: SparkSession, path: str) -> DataFrame:
    """The three kinds in one frame: columns that a kind does not have are NULL."""
    return spark.read.option("mergeSchema", "true").parquet(path)
