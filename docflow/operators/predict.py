"""Predictive analytics on metadata: linear growth trend / forecast,
conditional-frequency and random-forest code recommendation, autopopulation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docflow.functions.exprs import col_


def daily_totals(df: DataFrame, ts: str, amount: str | Column) -> DataFrame:
    """(day, total) — sum of ``amount`` per calendar day."""
    return df.groupBy(F.to_date(ts).alias("day")).agg(F.sum(col_(amount)).alias("total"))


def linear_trend(daily: DataFrame, day: str = "day", y: str = "total") -> DataFrame:
    """One-row model: slope and intercept of y over x = days since the first day
    (native regression aggregates; no data leaves the executors)."""
    first = daily.agg(F.min(day)).scalar()  # scalar subquery, planned by Catalyst
    x = F.datediff(F.col(day), first)
    pts = daily.select(F.col(day), x.alias("x"), F.col(y).alias("y"))
    return pts.agg(
        F.regr_slope("y", "x").alias("slope"),
        F.regr_intercept("y", "x").alias("intercept"),
        F.min(day).alias("first_day"),
        F.max(day).alias("last_day"),
        F.count(F.lit(1)).alias("n_days"),
    )


def forecast(model: DataFrame, days: int = 30) -> DataFrame:
    """Predicted y for the ``days`` days after the last observed day."""
    return model.select(
        F.explode(F.sequence(F.date_add("last_day", 1), F.date_add("last_day", days))).alias("day"), "slope", "intercept", "first_day"
    ).select("day", (F.col("intercept") + F.col("slope") * F.datediff("day", "first_day")).alias("predicted"))


def code_frequencies(df: DataFrame, features: list[str], code: str) -> DataFrame:
    """P(code | features) by counting; top-N per feature combination via ``rank``."""
    counts = df.where(F.col(code).isNotNull()).groupBy(*features, code).agg(F.count(F.lit(1)).alias("n"))
    w_tot = Window.partitionBy(*features)
    w_rank = Window.partitionBy(*features).orderBy(F.desc("n"), F.asc(code))
    return counts.select(
        *features, code, "n", (F.col("n") / F.sum("n").over(w_tot)).alias("probability"), F.row_number().over(w_rank).alias("rank")
    )


def autopopulate(df: DataFrame, features: list[str], code: str, freq: DataFrame) -> DataFrame:
    """Fill NULL codes with the most frequent code of the same features;
    existing codes are never touched."""
    best = freq.where(F.col("rank") == 1).select(*features, F.col(code).alias("__pred"))
    j = df.join(best, features, "left")
    return j.withColumn("filled", F.col(code).isNull() & F.col("__pred").isNotNull()).withColumn(
        code, F.coalesce(F.col(code), F.col("__pred"))
    ).drop("__pred")


def autopopulate_from_model(df: DataFrame, code: str, model) -> DataFrame:
    """Fill NULL codes with the likeliest code of a fitted ``forest_pipeline`` and mark
    them ``filled``; existing codes are never touched. Scored inside the rows: no shuffle."""
    labels = model.stages[-2].labels
    scored = model.transform(df.withColumn("__given", F.col(code)).withColumn(code, F.coalesce(F.col(code), F.lit(labels[0]))))
    best = F.element_at(F.array(*[F.lit(c) for c in labels]), F.col("prediction").cast("int") + 1)
    return scored.select(
        *[c for c in df.columns if c != code], F.coalesce("__given", best).alias(code), F.col("__given").isNull().alias("filled")
    )


def forest_pipeline(features: list[str], label: str, seed: int = 42, num_trees: int = 20):
    """StringIndexer(keep unseen) -> OneHot (no drop) -> assemble -> random forest."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler

    idx = [StringIndexer(inputCol=f, outputCol=f"{f}__idx", handleInvalid="keep") for f in features]
    ohe = OneHotEncoder(
        inputCols=[f"{f}__idx" for f in features], outputCols=[f"{f}__vec" for f in features], dropLast=False, handleInvalid="keep"
    )
    asm = VectorAssembler(inputCols=[f"{f}__vec" for f in features], outputCol="features")
    lab = StringIndexer(inputCol=label, outputCol="label", handleInvalid="skip")
    rf = RandomForestClassifier(featuresCol="features", labelCol="label", seed=seed, numTrees=num_trees)
    return Pipeline(stages=[*idx, ohe, asm, lab, rf])


def top_n_classes(pred: DataFrame, id_col: str, codes: list[str], n: int = 3) -> DataFrame:
    """(id, rank, code, probability): the n likeliest codes per row; ``codes`` names the
    entries of the model's probability vector. Equal probabilities: by code."""
    from pyspark.ml.functions import vector_to_array

    named = F.zip_with(
        vector_to_array("probability"), F.array(*[F.lit(c) for c in codes]), lambda p, c: F.struct((-p).alias("p"), c.alias("code"))
    )
    best = F.slice(F.sort_array(named), 1, n)  # sorted inside the row: no shuffle
    ranked = pred.select(id_col, F.posexplode(best).alias("i", "b"))
    return ranked.select(id_col, (F.col("i") + 1).alias("rank"), F.col("b.code").alias("code"), (-F.col("b.p")).alias("probability"))
