"""Write operators as pure DataFrame transforms.

Parquet has no row-level MERGE/UPDATE, so each DML statement becomes a join that produces the next
version of the table; the caller writes it with Spark's own writer to a place of its choice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimflow.functions.dates import as_ts


# ------------------------------------------------------------------ A07 / A16 / A17
def append_with_defaults(df: DataFrame, spec: dict[str, object], as_of, key_cols: list[str] | None = None) -> DataFrame:
    """Fill column defaults. ``spec`` maps column -> literal, ``"now"`` (as_of) or
    ``"uuid"`` (a sha2 of the natural key, so replays produce the same id)."""
    out = df
    for col, default in spec.items():
        if default == "now":
            val: Column = as_ts(as_of)
        elif default == "uuid":
            keys = key_cols or [c for c in df.columns if c != col]
            val = F.sha2(F.concat_ws("\u0001", *[F.col(k).cast("string") for k in keys]), 256)
        else:
            val = F.lit(default)
        out = out.withColumn(col, F.coalesce(F.col(col), val) if col in df.columns else val)
    return out


def append(target: DataFrame, rows: DataFrame) -> DataFrame:
    """INSERT ... SELECT by column name (missing columns NULL)."""
    return target.unionByName(rows, allowMissingColumns=True)


def audit_rows(df: DataFrame, flow: str, agent: str | Column, step: int | Column, as_of, status: str = "SUCCESS",
               module: str | Column | None = None, model: str | None = None, ref_col: str = "reference_id") -> DataFrame:
    """One audit row per input row (flow, ref, agent, step, module, model, status, payload).
    Agent, step and module may be columns, so rows of several steps come from one frame."""
    payload = F.col("output_payload") if "output_payload" in df.columns else F.lit(None).cast("string")
    ref = F.col(ref_col).cast("string")
    agent, step, module = (x if isinstance(x, Column) else F.lit(x) for x in (agent, step, module))
    return df.select(
        F.sha2(F.concat_ws("|", F.lit(flow), ref, agent, step.cast("string"), as_ts(as_of).cast("string")), 256)
         .alias("audit_id"),
        F.lit(flow).alias("flow_type"), ref.alias("reference_id"), agent.alias("agent_name"),
        step.cast("long").alias("step_number"),
        F.lit(None).cast("string").alias("input_payload"),
        payload.cast("string").alias("output_payload"),
        module.cast("string").alias("module_used"), F.lit(model).cast("string").alias("model_used"),
        F.lit(None).cast("long").alias("latency_ms"),
        F.lit(status).alias("status"), F.lit(None).cast("string").alias("error_message"),
        as_ts(as_of).alias("created_at"),
    )


# ------------------------------------------------------------------ A11
def diff_snapshots(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Full change feed between two snapshots: INSERT / DELETE / UPDATE rows
    (unchanged rows dropped). Values compare NULL-safely (``<=>``)."""
    cols = [c for c in new.columns if c not in keys]
    o = old.select(*keys, *[F.col(c).alias(f"_o_{c}") for c in cols]).withColumn("_in_old", F.lit(True))
    n = new.select(*keys, *cols).withColumn("_in_new", F.lit(True))
    j = o.join(n, keys, "full_outer")
    changed = None
    for c in cols:
        diff = ~F.col(c).eqNullSafe(F.col(f"_o_{c}"))
        changed = diff if changed is None else (changed | diff)
    action = (F.when(F.col("_in_old").isNull(), "INSERT").when(F.col("_in_new").isNull(), "DELETE")
              .when(changed if changed is not None else F.lit(False), "UPDATE"))
    out = j.withColumn("_change", action).filter(F.col("_change").isNotNull())
    vals = [F.when(F.col("_change") == "DELETE", F.col(f"_o_{c}")).otherwise(F.col(c)).alias(c) for c in cols]
    return out.select(*keys, *vals, "_change")


# ------------------------------------------------------------------ A12 / A13
def merge_upsert(target: DataFrame, source: DataFrame, keys: list[str], update_cols: list[str] | None = None,
                 insert_cols: list[str] | None = None, set_on_update: dict[str, Column] | None = None,
                 set_on_insert: dict[str, Column] | None = None) -> DataFrame:
    """``MERGE ... WHEN MATCHED UPDATE SET update_cols WHEN NOT MATCHED INSERT``.

    Returns the next version of ``target``. Source keys must be unique (as the
    warehouse requires for a deterministic MERGE). Columns not in
    ``update_cols`` keep the target value; inserted rows get NULL for columns
    not in ``insert_cols``. ``set_on_update``/``set_on_insert`` add expressions
    such as ``last_refreshed_at = as_of`` or ``started_at`` (insert only).
    """
    tcols = target.columns
    update_cols = update_cols if update_cols is not None else [c for c in source.columns if c not in keys]
    insert_cols = insert_cols if insert_cols is not None else [c for c in source.columns]
    s = source.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in source.columns if c not in keys]) \
              .withColumn("_src", F.lit(True))
    t = target.withColumn("_tgt", F.lit(True))
    j = t.join(s, keys, "full_outer")
    matched = F.col("_tgt").isNotNull() & F.col("_src").isNotNull()
    inserted = F.col("_tgt").isNull()
    out = []
    for c in tcols:
        if c in keys:
            out.append(F.col(c))
            continue
        on_upd = (set_on_update or {}).get(c)
        on_ins = (set_on_insert or {}).get(c)
        upd = on_upd if on_upd is not None else (F.col(f"_s_{c}") if c in update_cols else F.col(c))
        ins = on_ins if on_ins is not None else (F.col(f"_s_{c}") if c in insert_cols and c in source.columns
                                                 else F.lit(None))
        out.append(F.when(inserted, ins).when(matched, upd).otherwise(F.col(c)).cast(target.schema[c].dataType)
                   .alias(c))
    return j.select(*out)


def merge_insert_only(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """``MERGE ... WHEN NOT MATCHED THEN INSERT`` = target + (source anti target)."""
    new = source.join(target.select(*keys), keys, "left_anti")
    return target.unionByName(new, allowMissingColumns=True)


# ------------------------------------------------------------------ A14 / A15
def update_where(df: DataFrame, cond: Column, sets: dict[str, Column]) -> DataFrame:
    """``UPDATE t SET c = v WHERE cond`` (a NULL condition updates nothing)."""
    hit = F.coalesce(cond, F.lit(False))
    return df.select(*[F.when(hit, sets[c]).otherwise(F.col(c)).cast(df.schema[c].dataType).alias(c)
                       if c in sets else F.col(c) for c in df.columns])


def update_from(target: DataFrame, source: DataFrame, keys: list[str], cols: dict[str, str]) -> DataFrame:
    """``UPDATE t SET t.c = s.e FROM s WHERE t.key = s.key`` (``cols`` maps
    target column -> source column). Source keys must be unique."""
    s = source.select(*keys, *[F.col(sc).alias(f"_u_{tc}") for tc, sc in cols.items()]).withColumn("_hit", F.lit(True))
    j = target.join(s, keys, "left")
    return j.select(*[F.when(F.col("_hit") == True, F.col(f"_u_{c}")).otherwise(F.col(c))  # noqa: E712
                      .cast(target.schema[c].dataType).alias(c) if c in cols else F.col(c)
                      for c in target.columns])
