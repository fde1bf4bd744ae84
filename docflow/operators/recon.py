"""Source / target reconciliation: grouped counts, field-level differences,
missing and extra ids, per-batch decisions, retrieval validation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docflow.functions.exprs import differing_fields
from docflow.operators.joins import full_outer_diff

MATCHED, MISMATCHED, NOT_MATCHED = "MATCHED", "MISMATCHED", "NOT MATCHED"


def count_recon(source: DataFrame, target: DataFrame, group: str) -> DataFrame:
    """Per-group AND total source / target counts with a status on each level
    (equal totals can hide group differences).

    One ROLLUP aggregate per side (partial aggregation; the total row comes
    from the same pass), then a null-safe full outer join on (group, level).
    """

    def side(df, name):
        return df.select(F.col(group).alias("grp")).rollup("grp").agg(
            F.count(F.lit(1)).alias(name), F.grouping("grp").alias("lvl")
        )

    s, t = side(source, "source_count"), side(target, "target_count")
    j = s.join(t, (s["grp"].eqNullSafe(t["grp"])) & (s["lvl"] == t["lvl"]), "full_outer")
    sc, tc = F.coalesce(s["source_count"], F.lit(0)), F.coalesce(t["target_count"], F.lit(0))
    return j.select(
        F.when(F.coalesce(s["lvl"], t["lvl"]) == 1, "total").otherwise("group").alias("level"),
        F.coalesce(s["grp"], t["grp"]).alias(group),
        sc.alias("source_count"),
        tc.alias("target_count"),
        F.when(sc == tc, "matched").otherwise("not matched").alias("status"),
    )


def field_mismatches(
    source: DataFrame,
    target: DataFrame,
    key: str,
    fields: Mapping[str, tuple[str, str]],
    null_safe: bool = True,
) -> DataFrame:
    """Join on ``key``; ``mismatch_columns`` lists fields whose values differ.

    ``fields``: name -> (source column, target column). NULL vs value differs
    (``null_safe``); NULL vs NULL is equal.
    """
    s = source.select(F.col(key).alias("__k"), *[F.col(a).alias(f"s__{n}") for n, (a, _) in fields.items()])
    t = target.select(F.col(key).alias("__k"), *[F.col(b).alias(f"t__{n}") for n, (_, b) in fields.items()])
    j = s.join(t, "__k", "inner")
    diffs = differing_fields({n: (F.col(f"s__{n}"), F.col(f"t__{n}")) for n in fields}, null_safe)
    return j.select(F.col("__k").alias(key), diffs.alias("mismatch_columns"), *[c for c in j.columns if c != "__k"])


def two_sided_counts(source: DataFrame, target: DataFrame, cols: list[str] | Mapping[str, tuple[str, str]]) -> DataFrame:
    """Multiset difference on key columns as counts: rows (value combinations)
    whose multiplicity differs between the sides, with both multiplicities.
    ``cols``: column names of both sides, or name -> (source path, target path),
    where a path may lead into a struct.

    Each side is pre-aggregated (partial aggregation), then a null-safe full
    outer join compares the counts — a duplicated row on one side shows up.
    """
    paths = cols if isinstance(cols, Mapping) else {c: (c, c) for c in cols}
    cols = list(paths)
    s = source.select(*[F.col(a).alias(c) for c, (a, _) in paths.items()])
    t = target.select(*[F.col(b).alias(c) for c, (_, b) in paths.items()])
    s = s.groupBy(*cols).agg(F.count(F.lit(1)).alias("source_count"))
    t = t.groupBy(*cols).agg(F.count(F.lit(1)).alias("target_count"))
    s = s.select(*[F.col(c).alias(f"s__{c}") for c in cols], "source_count")
    t = t.select(*[F.col(c).alias(f"t__{c}") for c in cols], "target_count")
    cond = None
    for c in cols:
        e = F.col(f"s__{c}").eqNullSafe(F.col(f"t__{c}"))
        cond = e if cond is None else cond & e
    j = s.join(t, cond, "full_outer")
    sc, tc = F.coalesce("source_count", F.lit(0)), F.coalesce("target_count", F.lit(0))
    return j.select(
        *[F.coalesce(F.col(f"s__{c}"), F.col(f"t__{c}")).alias(c) for c in cols],
        sc.alias("source_count"),
        tc.alias("target_count"),
    ).filter(F.col("source_count") != F.col("target_count"))


def mismatch_by_field(mismatches: DataFrame) -> DataFrame:
    return mismatches.select(F.explode("mismatch_columns").alias("field")).groupBy("field").agg(
        F.count(F.lit(1)).alias("mismatch_count")
    )


def missing_extra(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Distinct ids missing in the target and extra in the target: one full outer join."""
    side = F.when(F.col("side") == "left_only", "missing").otherwise("extra")
    return full_outer_diff(source, target, key).select(key, side.alias("side"))


def decide(src_cnt: Column, tgt_cnt: Column, mismatched: Column) -> tuple[Column, Column]:
    """(reconcile_check, retrieval_validation_default) per batch: either side
    empty -> NOT MATCHED / FAILURE; no field mismatch -> MATCHED; else MISMATCHED."""
    empty = (F.coalesce(src_cnt, F.lit(0)) == 0) | (F.coalesce(tgt_cnt, F.lit(0)) == 0)
    check = F.when(empty, F.lit(NOT_MATCHED)).when(F.coalesce(mismatched, F.lit(0)) == 0, MATCHED).otherwise(MISMATCHED)
    validation = F.when(empty, F.lit("FAILURE"))
    return check, validation


def row_fingerprint(cols: list[Column]) -> Column:
    """64-bit fingerprint of a row's values, NULL-aware (a NULL and a value
    never hash alike: each field contributes its null flag and its value)."""
    parts = []
    for c in cols:
        parts += [c.isNull(), c]
    return F.xxhash64(*parts)


def reconcile_by_batch(
    source: DataFrame,
    target: DataFrame,
    key: str,
    batch: str,
    fields: Mapping[str, tuple[str, str]],
) -> DataFrame:
    """Per-batch reconciliation of two frames that both carry ``batch``.

    One plan for all batches. Each side is first collapsed to one row per
    (batch, key): multiplicity plus the min / max fingerprint of the compared
    fields — fixed-width buffers, so a hash aggregate with map-side partial
    aggregation (a duplicated row is a count, never a fan-out). A full outer
    join on (batch, key), co-partitioned with the collapse, then classifies
    each id as matched / mismatched (values or multiplicity differ) / missing
    / extra, and the reference decision rule is applied per batch.
    ``field_mismatches`` names the differing fields where that is needed.
    """

    def side(df, pick, tag):
        fp = row_fingerprint([F.col(pick(ab)) for ab in fields.values()])
        return df.groupBy(F.col(batch).alias("batch_id"), F.col(key).alias("__k")).agg(
            F.count(F.lit(1)).alias(f"n_{tag}"), F.min(fp).alias(f"lo_{tag}"), F.max(fp).alias(f"hi_{tag}")
        )

    s = side(source, lambda ab: ab[0], "s")
    t = side(target, lambda ab: ab[1], "t")
    j = s.join(t, ["batch_id", "__k"], "full_outer")
    both = F.col("n_s").isNotNull() & F.col("n_t").isNotNull()
    differs = (F.col("n_s") != F.col("n_t")) | (F.col("lo_s") != F.col("lo_t")) | (F.col("hi_s") != F.col("hi_t"))
    per = j.groupBy("batch_id").agg(
        F.coalesce(F.sum("n_s"), F.lit(0)).alias("source_count"),
        F.coalesce(F.sum("n_t"), F.lit(0)).alias("target_count"),
        F.sum(F.when(both & differs, 1).otherwise(0)).alias("mismatched"),
        F.sum(F.when(F.col("n_t").isNull(), 1).otherwise(0)).alias("missing"),
        F.sum(F.when(F.col("n_s").isNull(), 1).otherwise(0)).alias("extra"),
    )
    check, _ = decide(F.col("source_count"), F.col("target_count"), F.col("mismatched"))
    return per.withColumn("reconcile_check", check).withColumn(
        "count_status", F.when(F.col("source_count") == F.col("target_count"), MATCHED).otherwise(NOT_MATCHED)
    )


def sample_per_group(df: DataFrame, group: str, order: Column, n: int) -> DataFrame:
    """At most ``n`` rows per group by a deterministic order (e.g. a hash).

    ``row_number() <= n`` lets Spark insert a map-side group limit, so a hot
    group ships at most n rows per task through the shuffle.
    """
    w = Window.partitionBy(group).orderBy(order)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n).drop("__rn")


def retrieval_validation(ids: DataFrame, listing: DataFrame, id_col: str, path_col: str = "guid") -> DataFrame:
    """For each id, check the stored object exists on some server with length > 0.

    ``listing``: (guid, server, length) — an object listing / manifest table.
    Status per id: SUCCESS or FAILURE; ``servers_found`` counts replicas.
    """
    per = listing.groupBy(F.col(path_col).alias("__g")).agg(
        F.max(F.col("length") > 0).alias("__ok"),
        F.sum(F.when(F.col("length") > 0, 1).otherwise(0)).alias("servers_found"),
        F.count(F.lit(1)).alias("servers_listed"),
    )
    j = ids.join(per, ids[id_col] == per["__g"], "left")
    return j.select(
        *[ids[c] for c in ids.columns],
        F.when(F.coalesce(F.col("__ok"), F.lit(False)), "SUCCESS").otherwise("FAILURE").alias("status"),
        F.coalesce(F.col("servers_found"), F.lit(0)).cast("bigint").alias("servers_found"),
        F.coalesce(F.col("servers_listed"), F.lit(0)).cast("bigint").alias("servers_listed"),
    )


def batch_results(pending: DataFrame, per: DataFrame, checked: DataFrame, finished: Column) -> DataFrame:
    """Ledger rows of the pending batches, ready for one upsert by batch_id.

    ``per``: ``reconcile_by_batch``; ``checked``: (batch_id, id, status) of the
    retrieval sample, bounded per batch; ``finished``: completion time of a batch.
    A batch with an empty side is NOT MATCHED and its validation FAILURE.
    """
    ok = F.sum(F.when(F.col("status") == "SUCCESS", 1).otherwise(0))
    sampled = checked.groupBy("batch_id").agg(F.count(F.lit(1)).alias("sampled"), ok.alias("retrieved"))
    results = status_string(checked, "batch_id", "id", "status")
    j = pending.join(per, "batch_id", "left").join(sampled, "batch_id", "left").join(results, "batch_id", "left")
    check, failed = decide(F.col("source_count"), F.col("target_count"), F.col("mismatched"))
    counts = ("source_count", "target_count", "mismatched", "missing", "sampled", "retrieved")
    return j.select(
        "batch_id",
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts],
        check.alias("reconcile_check"),
        F.coalesce(failed, F.col("validation_results")).alias("retrieval_validation"),
        finished.alias("reconcile_dttm"),
    )


def reconciliation_report(ledger: DataFrame, started: Column) -> DataFrame:
    """The key figures of the reconciled batches of a ledger, as one row: records
    processed, match and mismatch rate, share of sampled objects that could be
    retrieved, mean seconds from ``started`` to completion. Rates over nothing are NULL."""
    done = ledger.where(F.col("reconcile_check").isNotNull())
    seconds = (F.col("reconcile_dttm") - started).cast("interval second").cast("decimal(20,6)")

    def rate(value: str) -> Column:
        return F.round(F.avg(F.when(F.col("reconcile_check") == value, 1.0).otherwise(0.0)), 6)

    return done.agg(
        F.count(F.lit(1)).alias("batches"),
        F.sum(F.greatest("source_count", "target_count")).alias("total_processed"),
        rate(MATCHED).alias("match_rate"),
        rate(MISMATCHED).alias("mismatch_rate"),
        F.round(F.try_divide(F.sum("retrieved"), F.sum("sampled")), 6).alias("validation_success_rate"),
        F.round(F.avg(seconds), 3).cast("double").alias("avg_reconcile_seconds"),
    )


def status_string(df: DataFrame, group: str, id_col: str, status_col: str, sep: str = ":") -> DataFrame:
    """Comma-joined ``id<sep>STATUS`` per group, sorted (use on bounded groups,
    e.g. a retrieval sample of at most 100 ids per batch)."""
    item = F.concat(F.col(id_col).cast("string"), F.lit(sep), F.col(status_col))
    return df.groupBy(group).agg(F.concat_ws(",", F.sort_array(F.collect_list(item))).alias("validation_results"))
