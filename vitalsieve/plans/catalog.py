"""Registered queries: every operator over whole tables of a scale-factor folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from vitalsieve import contracts
from vitalsieve.functions import columns as fc
from vitalsieve.operators import (
    associations as assoc, cleaning, dedup, distributions as dist, features, levels, metrics, models, profile, routing, scoring, splits,
    summaries, validation,
)
from vitalsieve.plans import requests, train
from vitalsieve.session import checkpoint_dir, small_side, spread
from vitalsieve.sources import documents, tables
from vitalsieve.streaming import registry as model_registry_, scoring as stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column, so that sums formed in another order compare equal."""
    return df.select(
        *[F.round(fc.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else fc.col(f.name) for f in df.schema.fields]
    )


# Profiles and audits


@query
def column_profile(spark, sf_dir):
    return rounded(profile.column_profile(table(spark, sf_dir, "lineitem"), target="l_returnflag"), 4)


@query
def column_profile_customer(spark, sf_dir):
    return rounded(profile.column_profile(table(spark, sf_dir, "customer")), 4)


@query
def summary_statistics(spark, sf_dir):
    return rounded(profile.summary_statistics(table(spark, sf_dir, "orders"), ["o_totalprice", "o_custkey"]))


@query
def missing_values(spark, sf_dir):
    zeros = fc.zeros_to_null(table(spark, sf_dir, "lineitem"), ["l_discount", "l_tax"])
    return rounded(profile.missing_values(zeros.select("l_quantity", "l_discount", "l_tax"), only_present=True))


@query
def distinct_values(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    return profile.distinct_values(parts, parts.columns, null_is_value=True)


@query
def constant_columns(spark, sf_dir):
    conversations = table(spark, sf_dir, "conversations").withColumn("kind", F.lit("chat"))
    return profile.constant_columns(conversations, conversations.columns)


@query
def identifier_columns(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    return profile.identifier_columns(customers, customers.columns)


@query
def merged_summaries(spark, sf_dir):
    """Whole-table summaries from sketches kept per month of shipping; the estimated distinct count only as within 5 % or not."""
    lines = table(spark, sf_dir, "lineitem").withColumn("month", F.date_format("l_shipdate", "yyyy-MM"))
    found = summaries.summarised(summaries.merged_sketches(summaries.column_sketches(lines, by=["month"])))
    exact = summaries.exact_distincts(lines.drop("month"), lines.drop("month").columns).withColumnRenamed("n_distinct", "exact")
    close = F.abs(F.col("n_distinct") - F.col("exact")) <= F.greatest(0.05 * F.col("exact"), F.lit(1.0))
    return rounded(found.join(F.broadcast(exact), "feature").select("feature", "n", "missing", "missing_pct", "zeros", "min", "max", "mean", "std", close.alias("n_distinct_close")), 4)


@query
def corr_many_columns(spark, sf_dir):
    """Correlations of sixteen columns with gaps of their own."""
    gaps = [F.when(F.col("l_orderkey") % d != 0, F.col(m)).alias(f"{m}_{d}") for m in MEASURES for d in (2, 3, 5, 7)]
    lines = table(spark, sf_dir, "lineitem").select(*gaps)
    return rounded(assoc.correlation_matrix(lines, lines.columns, lower_only=True), 5)


@query
def table_shape(spark, sf_dir):
    return profile.shape(table(spark, sf_dir, "events"))


@query
def zero_audit(spark, sf_dir):
    return rounded(profile.zero_audit(table(spark, sf_dir, "lineitem"), MEASURES, valid_zero=["l_discount"]))


@query
def mean_and_median(spark, sf_dir):
    return rounded(dist.mean_and_median(table(spark, sf_dir, "events"), ["user_id"]))


@query
def verification_summary(spark, sf_dir):
    return rounded(profile.verification_summary(table(spark, sf_dir, "labels"), "quality"))


@query
def table_overview(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    marks = table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return rounded(
        profile.table_summary("lineitem", lines, "l_returnflag", "R")
        .unionByName(profile.table_summary("orders", orders, "o_orderstatus", "F", "o_orderkey"))
        .unionByName(profile.table_summary("labels", marks, "quality", 1, "doc_id"))
    )


@query
def value_counts(spark, sf_dir):
    return profile.value_counts(table(spark, sf_dir, "orders"), "o_orderpriority")


@query
def value_share(spark, sf_dir):
    marks = table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return rounded(profile.value_share(marks, "quality"))


@query
def imbalance(spark, sf_dir):
    return rounded(profile.imbalance(table(spark, sf_dir, "labels"), "toxic"))


@query
def id_extract(spark, sf_dir):
    names = table(spark, sf_dir, "customer").select("c_custkey", F.regexp_replace("c_name", "#", "_").alias("name"))
    return fc.subject_id(names, "name")


@query
def id_extract_coded(spark, sf_dir):
    names = table(spark, sf_dir, "supplier").select("s_suppkey", F.concat(F.lit("rec_S"), F.col("s_nationkey"), F.lit("_"), F.col("s_suppkey")).alias("name"))
    return fc.subject_id(names, "name")


@query
def records_per_subject(spark, sf_dir):
    return profile.records_per_subject(table(spark, sf_dir, "events"), "user_id")


@query
def subject_coverage(spark, sf_dir):
    return profile.subject_coverage(table(spark, sf_dir, "conversations"), "conv_id")


# Distributions


@query
def iqr_outliers(spark, sf_dir):
    return rounded(dist.iqr_outliers(table(spark, sf_dir, "lineitem"), MEASURES))


@query
def iqr_outliers_with_gaps(spark, sf_dir):
    zeros = fc.zeros_to_null(table(spark, sf_dir, "lineitem"), ["l_discount", "l_tax"])
    return rounded(dist.iqr_outliers(zeros, ["l_discount", "l_tax"], base="all"))


@query
def outlier_rows(spark, sf_dir):
    return dist.outlier_rows(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "n_chars")


@query
def box_by_class(spark, sf_dir):
    return rounded(dist.box_by_class(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice"], "l_returnflag"))


@query
def histogram(spark, sf_dir):
    return rounded(dist.histogram(table(spark, sf_dir, "events"), "value", bins=15))


@query
def histogram_sturges(spark, sf_dir):
    return rounded(dist.histogram(table(spark, sf_dir, "orders"), "o_totalprice"))


@query
def histogram_by_class(spark, sf_dir):
    return rounded(dist.histogram(table(spark, sf_dir, "events"), "value", bins=15, by="event_type"))


@query
def kde_grid(spark, sf_dir):
    return rounded(dist.kernel_density(table(spark, sf_dir, "events"), "value", points=50))


# Associations


def _returned(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").withColumn("returned", fc.positive_flag(F.col("l_returnflag"), "R"))


@query
def corr_matrix(spark, sf_dir):
    return rounded(assoc.correlation_matrix(table(spark, sf_dir, "lineitem"), MEASURES))


@query
def corr_lower_triangle(spark, sf_dir):
    zeros = fc.zeros_to_null(table(spark, sf_dir, "lineitem"), ["l_discount", "l_tax"])
    return rounded(assoc.correlation_matrix(zeros, MEASURES, lower_only=True))


@query
def corr_with_target(spark, sf_dir):
    return rounded(assoc.correlation_with_target(_returned(spark, sf_dir), MEASURES, "returned"))


@query
def missing_rate_by_class(spark, sf_dir):
    joined = table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return rounded(assoc.missing_rate_by_class(joined, "quality", "lang"))


@query
def prevalence_by_category(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return rounded(assoc.prevalence(docs.join(table(spark, sf_dir, "labels"), "doc_id"), ["lang", "source"], "quality"))


@query
def crosstab(spark, sf_dir):
    return assoc.crosstab(table(spark, sf_dir, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


def _flags(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_quantity") > 25).cast("int").alias("large"),
        (F.col("l_discount") == 0).cast("int").alias("full_price"),
        (F.col("l_linestatus") == "F").cast("int").alias("finished"),
        "l_returnflag",
    )


@query
def flag_prevalence(spark, sf_dir):
    return rounded(assoc.flag_prevalence(_flags(spark, sf_dir), ["large", "full_price", "finished"]))


@query
def flag_rate_gap(spark, sf_dir):
    return rounded(assoc.flag_rate_gap(_flags(spark, sf_dir), ["large", "full_price", "finished"], "l_returnflag", "R"))


# Cleaning


@query
def zero_to_null(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_tax")
    return fc.zeros_to_null(lines, ["l_discount", "l_tax"])


@query
def zero_conversions(spark, sf_dir):
    return cleaning.zero_conversions(table(spark, sf_dir, "lineitem"), ["l_discount", "l_tax", "l_quantity"])


@query
def header_normalise(spark, sf_dir):
    raw = table(spark, sf_dir, "customer").toDF(" C CustKey", "C Name ", "Nation Key", "AcctBal", "Mkt Segment")
    return fc.normalise_headers(raw)


@query
def label_map(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    code = fc.recode(F.concat(F.lit(" "), F.lower("o_orderstatus")), {"F": 1, "O": 0}, strict=False)
    return orders.select("o_orderkey", code.alias("code"), fc.decode(code, {0: "open", 1: "finished"}, "unknown").alias("label"))


@query
def dictionary_lookup(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    joined = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey").join(small_side(nation), "c_nationkey", "left")
    return joined.withColumn("n_name", F.coalesce("n_name", F.lit("unknown")))


@query
def lenient_numbers(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    return parts.select("p_partkey", fc.lenient_number(F.substring_index("p_brand", "#", -1)).alias("brand_no"), fc.lenient_number(F.col("p_type")).alias("type_no"))


@query
def unreadable_numbers(spark, sf_dir):
    return cleaning.unreadable_numbers(table(spark, sf_dir, "part"), ["p_name", "p_size", "p_type"])


@query
def trimmed_text(spark, sf_dir):
    lines = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("  "), "lang", F.lit(" ")).alias("lang"), F.concat(F.lit(" "), "source").alias("source"))
    return fc.tokens_to_null(fc.trim_strings(lines), ["src0", "fr"])


@query
def domain_violations(spark, sf_dir):
    return cleaning.domain_violations(
        table(spark, sf_dir, "orders"), {"o_orderstatus": ["F", "O"], "o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM"]}
    )


@query
def range_violations(spark, sf_dir):
    return cleaning.range_violations(table(spark, sf_dir, "customer"), {"c_acctbal": (0.0, 9000.0), "c_nationkey": (0, 24)})


@query
def value_defects(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        F.nullif("l_tax", F.lit(0.0)).alias("l_tax"),
        F.when(F.col("l_discount") == 0.01, float("nan")).when(F.col("l_discount") == 0.02, float("inf")).otherwise(F.col("l_discount")).alias("l_discount"),
        F.when(F.col("l_linestatus") == "F", "  ").otherwise(F.col("l_linestatus")).alias("l_linestatus"),
    )
    return cleaning.value_defects(lines)


@query
def known_targets_only(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").filter(F.col("label").isin(0, 1)).select("vec_id", "label")


@query
def feature_slices(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").withColumn("v", F.col("embedding").cast("array<double>"))
    mean = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x) / F.size(a)
    return rounded(vectors.select(
        "vec_id", *[mean(fc.feature_slice(F.col("v"), start, 16)).alias(name) for name, start in (("first", 1), ("second", 17), ("third", 33), ("last", 49))]
    ))


# Duplicates


@query
def duplicate_rows(spark, sf_dir):
    return dedup.duplicate_count(table(spark, sf_dir, "documents"), ["text"])


@query
def drop_duplicate_rows(spark, sf_dir):
    return dedup.drop_duplicate_rows(table(spark, sf_dir, "documents"), ["text"], "doc_id").select("doc_id", "lang", "source", "n_chars")


@query
def dedup_null_ids(spark, sf_dir):
    """First rows where ids are missing or repeated, texts in arrays look alike when joined, and zeros have signs."""
    k = F.col("user_id") % 5
    tags = F.when(k == 0, F.array(F.lit("a, b"))).when(k == 1, F.array(F.lit("a"), F.lit("b"))).when(k == 2, F.array().cast("array<string>")).when(k == 3, F.array(F.lit(None).cast("string")))
    rows = table(spark, sf_dir, "events").select(
        F.when(F.col("event_id") % 3 != 0, F.col("event_id") % 50).alias("row_id"), "event_type", tags.alias("tags"),
        F.when(F.col("event_id") % 2 == 0, F.lit(-0.0)).otherwise(F.col("event_id") % 7 * 0.5).alias("amount"))
    kept = dedup.drop_duplicate_rows(rows, ["event_type", "tags", "amount"], "row_id")
    return kept.select("row_id", "event_type", F.coalesce(F.size("tags"), F.lit(-1)).alias("n_tags"), F.array_join("tags", "|", "?").alias("tags"), (F.col("amount") + 0.0).alias("amount"))


@query
def dup_groups(spark, sf_dir):
    groups = dedup.duplicate_groups(table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left"), ["text"], "doc_id", "quality")
    return groups.select("first_row", "n_rows", "n_labels")


@query
def conflicts(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return dedup.conflicting_groups(events, ["user_id", "props"], "event_id", "event_type").select("first_row", "n_rows", "n_labels")


@query
def duplicate_summary(spark, sf_dir):
    return dedup.duplicate_summary(table(spark, sf_dir, "lineitem"), ["l_partkey", "l_quantity"], "l_orderkey", "l_returnflag")


# Splits


@query
def stratified_split(spark, sf_dir):
    return splits.stratified_holdout(table(spark, sf_dir, "labels"), ["doc_id"], "quality").select("doc_id", "quality", "split")


@query
def stratified_split_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return splits.stratified_holdout(orders, ["o_orderkey"], "o_orderstatus", seed=7)


@query
def stratified_folds(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return splits.stratified_folds(orders, ["o_orderkey"], "o_orderstatus")


@query
def class_distribution(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag").withColumn(
        "split", F.when(F.substring(F.md5(F.col("l_orderkey").cast("string")), 1, 1) < "4", "test").otherwise("train")
    )
    return rounded(assoc.class_distribution(lines, "split", "l_returnflag"))


def _errors(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "user_id", (F.col("event_type") == "error").cast("int").alias("label"))


@query
def group_folds(spark, sf_dir):
    return splits.group_folds(_errors(spark, sf_dir), "user_id", "label")


@query
def group_split(spark, sf_dir):
    return splits.group_holdout(_errors(spark, sf_dir), "user_id", "label")


@query
def groups_per_split(spark, sf_dir):
    rows = splits.stratified_holdout(_errors(spark, sf_dir), ["event_id"], "label")
    return dedup.groups_per_split(rows, "user_id")


@query
def leakage_check(spark, sf_dir):
    rows = splits.stratified_holdout(_errors(spark, sf_dir), ["event_id"], "label")
    return dedup.shared_groups(rows, "user_id")


@query
def split_report(spark, sf_dir):
    rows = splits.group_holdout(_errors(spark, sf_dir), "user_id", "label")
    return rounded(splits.split_report(rows, "split", "label", "user_id"))


@query
def conflict_allocation(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "props", (F.col("event_type") == "error").cast("int").alias("label"))
    whole = splits.group_holdout(events, "user_id", "label")
    cut = splits.stratified_holdout(events, ["event_id"], "label")
    return splits.conflict_allocation(whole, ["user_id", "props"], "label", "split").withColumn("kind", F.lit("whole")).unionByName(
        splits.conflict_allocation(cut, ["user_id", "props"], "label", "split").withColumn("kind", F.lit("cut"))
    )


@query
def row_identity(spark, sf_dir):
    """Rows and distinct ids of a table that repeats its rows."""
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber")
    return tables.with_row_id(lines, chunk=1000).agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("row_id").alias("n_ids"))


@query
def replayed_split(spark, sf_dir):
    manifest = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("toxic") == 1, "test").otherwise("train").alias("split"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    test = splits.replay_split(docs, manifest, "doc_id", "test").withColumn("part", F.lit("test"))
    return test.unionByName(splits.outside_split(docs, manifest, "doc_id", "train").withColumn("part", F.lit("not_train")))


# Feature preparation


def _gaps(spark, sf_dir):
    return fc.zeros_to_null(table(spark, sf_dir, "lineitem"), ["l_discount", "l_tax"])


@query
def numeric_statistics(spark, sf_dir):
    return rounded(features.numeric_statistics(_gaps(spark, sf_dir), MEASURES))


@query
def impute_scale_onehot(spark, sf_dir):
    lines = _gaps(spark, sf_dir)
    plan = [("l_quantity", "scale"), ("l_discount", "scale"), ("l_tax", "fill"), ("l_returnflag", "levels"), ("l_linenumber", "levels")]
    model = features.TablePrep(plan).fit(lines)
    return rounded(lines.select("l_orderkey", "l_partkey", "l_suppkey", *model.columns()))


@query
def category_levels(spark, sf_dir):
    levels = features.category_levels(table(spark, sf_dir, "part"), ["p_brand", "p_type", "p_size"])
    return levels.withColumn("n", F.col("n").cast("long"))


@query
def class_weights(spark, sf_dir):
    return rounded(features.with_class_weights(table(spark, sf_dir, "labels"), "quality").select("doc_id", "quality", "weight"))


# Metrics


def _scored_lines(spark, sf_dir):
    """Three scores over the line items: two with many values and ties, one with eleven values."""
    lines = table(spark, sf_dir, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        (F.col("l_extendedprice") / 105000.0).alias("price"),
        (F.col("l_quantity") / 50.0).alias("quantity"),
        (1.0 - F.col("l_discount") * 10.0).alias("discount"),
    )
    long = lines.unpivot(["label"], ["price", "quantity", "discount"], "model", "score")
    return long.withColumn("prediction", (F.col("score") >= 0.5).cast("int"))


@query
def confusion(spark, sf_dir):
    return metrics.confusion(_scored_lines(spark, sf_dir), "label", "prediction", ["model"])


@query
def threshold_metrics(spark, sf_dir):
    return rounded(metrics.threshold_metrics(_scored_lines(spark, sf_dir), "label", "prediction", ["model"]))


@query
def ranking_metrics(spark, sf_dir):
    return rounded(metrics.ranking_metrics(_scored_lines(spark, sf_dir), "label", "score", ["model"]))


def _scored_docs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return docs.join(table(spark, sf_dir, "labels"), "doc_id").select(
        "lang", F.col("quality").alias("label"), (F.col("n_chars") / 10000.0).alias("score"), (F.col("n_chars") >= 1500).cast("int").alias("prediction")
    )


@query
def roc_points(spark, sf_dir):
    return rounded(metrics.roc_points(_scored_docs(spark, sf_dir), "label", "score"))


@query
def pr_points(spark, sf_dir):
    return rounded(metrics.pr_points(_scored_docs(spark, sf_dir), "label", "score"))


@query
def all_metrics(spark, sf_dir):
    return rounded(metrics.all_metrics(_scored_docs(spark, sf_dir), "label", "prediction", "score"))


@query
def class_report(spark, sf_dir):
    return rounded(metrics.class_report(_scored_docs(spark, sf_dir), "label", "prediction"))


def _fold_metrics(spark, sf_dir):
    scored = _scored_lines_by_fold(spark, sf_dir)
    return metrics.all_metrics(scored, "label", "prediction", "score", ["model", "fold"])


def _scored_lines_by_fold(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_linenumber").alias("fold"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        (F.col("l_extendedprice") / 105000.0).alias("price"),
        (F.col("l_quantity") / 50.0).alias("quantity"),
        (1.0 - F.col("l_discount") * 10.0).alias("discount"),
    )
    long = lines.unpivot(["fold", "label"], ["price", "quantity", "discount"], "model", "score")
    return long.withColumn("prediction", (F.col("score") >= 0.5).cast("int"))


@query
def fold_summary(spark, sf_dir):
    return rounded(metrics.fold_summary(_fold_metrics(spark, sf_dir)))


@query
def champion(spark, sf_dir):
    return metrics.champion(metrics.fold_summary(_fold_metrics(spark, sf_dir))).select("model")


@query
def metric_defects(spark, sf_dir):
    return metrics.metric_defects(_fold_metrics(spark, sf_dir))


# Scoring


@query
def linear_score(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    p = scoring.linear_probability({"c_acctbal": 0.0002, "c_nationkey": -0.05}, -0.25)
    return customers.select("c_custkey", *[c.alias(n) for n, c in scoring.screening_columns(p, contracts.HEART).items() if n in ("prediction", "prediction_label", "probability", "risk_percentage")])


@query
def risk_tiers(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("v", F.nullif("value", F.lit(1.0)))
    p = F.when(F.col("event_type") != "error", scoring.linear_probability({"v": 0.1}, -1.0))
    return events.groupBy(scoring.risk_tier(p).alias("tier"), scoring.screening_signal(p).alias("signal")).agg(F.count(F.lit(1)).alias("n"))


@query
def vector_score(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    weights = F.transform(F.sequence(F.lit(1), F.lit(64)), lambda i: (i % 5).cast("double") - 2.0)
    return vectors.select("vec_id", F.round(scoring.dot_probability(F.col("embedding").cast("array<double>"), weights, 0.25), 6).alias("probability"))


def _requests(spark, sf_dir):
    k = "CAST(get_json_object(props, '$.k') AS INT)"
    return table(spark, sf_dir, "events").select("event_id", F.expr(requests.BODY.format(k=k, text="STRING")).alias("body"))


def _scorers():
    return {"lung_cancer": scoring.Scorer(contracts.LUNG, weights=requests.WEIGHTS, intercept=requests.INTERCEPT)}


@query
def validate_requests(spark, sf_dir):
    checked = validation.validate_requests(_requests(spark, sf_dir), "body", {"lung_cancer": contracts.LUNG})
    return checked.select("event_id", "status", "error_type", "message", F.coalesce(F.size("errors"), F.lit(0)).alias("n_errors"))


@query
def answer_requests(spark, sf_dir):
    answers = scoring.respond(_requests(spark, sf_dir), "body", _scorers(), ["event_id"])
    return answers.select("event_id", "status", "disease", "mode", "prediction", "prediction_label", "probability", "risk_percentage", "status_class")


@query
def request_outcomes(spark, sf_dir):
    return scoring.outcome_counts(scoring.respond(_requests(spark, sf_dir), "body", _scorers()))


_ANSWER = ("event_id", "status", "disease", "mode", "error_type", "message", "prediction", "prediction_label", "probability", "risk_category", "status_class")


def _mixed(spark, sf_dir, body=requests.mixed_body):
    k = "CAST(get_json_object(props, '$.k') AS INT)"
    return spread(table(spark, sf_dir, "events")).select("event_id", F.expr(body().format(k=k, text="STRING")).alias("body"))


@query
def answer_mixed_requests(spark, sf_dir):
    """Requests of seven diseases in one pass; one has no model, one no probability."""
    return routing.answer(_mixed(spark, sf_dir), "body", requests.mixed_served(), ["event_id"]).select(*_ANSWER)


@query
def grouped_requests(spark, sf_dir):
    """Grouped breast payloads, flattened so that the later value of a field wins."""
    return routing.answer(_mixed(spark, sf_dir, requests.grouped_body), "body", requests.mixed_served(), ["event_id"]).select(*_ANSWER)


@query
def missing_model_requests(spark, sf_dir):
    """Outcomes by disease where three of seven models are missing."""
    answers = routing.answer(_mixed(spark, sf_dir), "body", requests.mixed_served(("heart", "diabetes", "lung_cancer")))
    return answers.groupBy("disease", "status_class", "error_type").agg(F.count(F.lit(1)).alias("n"))


def _served_contracts():
    return {name: contracts.CONTRACTS[name] for name in requests.MIXED}


@query
def stream_model_swap(spark, sf_dir):
    """The mixed requests as a stream of several batches, whose models are turned round when half of them are answered."""
    home = f"{checkpoint_dir(spark).rstrip('/')}/swap-{uuid.uuid4().hex}"
    bodies = _mixed(spark, sf_dir)
    for version, served in ((1, requests.mixed_served()), (2, requests.turned(requests.mixed_served()))):
        model_registry_.publish(spark, f"{home}/registry", version, served)
        bodies.filter(F.col("event_id") % 2 == version - 1).repartition(4, "event_id").write.mode("append").parquet(f"{home}/in")
        rows = stream.read_table_stream(spark, f"{home}/in", bodies.schema, 2)
        run = model_registry_.answer_stream(rows, "body", f"{home}/registry", _served_contracts(), f"{home}/out", f"{home}/state", ["event_id"])
        run.awaitTermination()
    answers = spark.read.parquet(f"{home}/out")
    return answers.select("event_id", "model_version", "disease", "status", "prediction", F.round("probability", 3).alias("probability"))


@query
def model_registry(spark, sf_dir):
    """What is registered, in which version and state, and how many requests ask for it."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/registry-{uuid.uuid4().hex}"
    model_registry_.publish(spark, path, 1, requests.mixed_served())
    model_registry_.publish(spark, path, 2, {"stroke": requests.mixed_served(("stroke",))["stroke"], "diabetes": requests.mixed_served(())["diabetes"]})
    info = model_registry_.model_info(spark, path, _served_contracts())
    asked = validation.envelope(_mixed(spark, sf_dir), "body", list(requests.MIXED)).groupBy("disease").agg(F.count(F.lit(1)).alias("n_requests"))
    return info.drop("class_mapping").join(asked, "disease", "left")


@query
def nested_duplicates(spark, sf_dir):
    """What repeated keys are told as, at whatever depth they repeat."""
    k = "CAST(get_json_object(props, '$.k') AS INT)"
    body = requests.nested_body().replace("\\", "\\\\").format(k=k)
    rows = table(spark, sf_dir, "events").select("event_id", F.expr(body).alias("body"))
    checked = validation.envelope(rows, "body", ["heart"])
    return checked.select("event_id", "error_type", "message")


@query
def strict_requests(spark, sf_dir):
    """The scored requests alone, passed through the strict check, which fails the job on any rejected row."""
    answers = routing.answer(_mixed(spark, sf_dir), "body", requests.mixed_served(), ["event_id"])
    return validation.strict(validation.quarantine(answers)[0]).select("event_id", "disease", "prediction", "risk_category")


@query
def quarantine(spark, sf_dir):
    checked = validation.validate_requests(_requests(spark, sf_dir), "body", {"lung_cancer": contracts.LUNG})
    return validation.quarantine(checked)[1].select("event_id", "message")


@query
def redacted_paths(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", validation.redacted(F.concat(F.lit("failed at "), F.col("url"))).alias("message"))


@query
def stream_score(spark, sf_dir):
    """The requests again, as a stream of files drained into an accepted and a rejected table."""
    schema = table(spark, sf_dir, "events").schema
    rows = stream.read_table_stream(spark, f"{sf_dir}/events.parq*", schema)
    k = "CAST(get_json_object(props, '$.k') AS INT)"
    bodies = rows.select("event_id", F.expr(requests.BODY.format(k=k, text="STRING")).alias("body"))
    home = f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    run = stream.score_stream(bodies, "body", _scorers(), f"{home}/accepted", f"{home}/rejected", f"{home}/state", ["event_id"])
    run.awaitTermination()
    answers = spark.read.parquet(f"{home}/accepted").unionByName(spark.read.parquet(f"{home}/rejected"))
    return answers.select("event_id", "status", "disease", "mode", "prediction", "prediction_label", "probability", "risk_percentage", "status_class")


# Sources


@query
def fingerprint(spark, sf_dir):
    return tables.fingerprint(table(spark, sf_dir, "documents"))


@query
def input_schema(spark, sf_dir):
    return profile.input_schema(table(spark, sf_dir, "orders"))


@query
def cleaning_audit(spark, sf_dir):
    before = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", F.md5("text").alias("text"), F.nullif("n_chars", F.lit(5)).alias("n_chars"))
    after = dedup.drop_duplicate_rows(fc.tokens_to_null(before, ["fr"]), ["text"], "doc_id")
    return rounded(cleaning.cleaning_audit(before, after, contracts.TableContract("docs", "lang", {}, row_id="doc_id")))


@query
def comparison_rows(spark, sf_dir):
    return documents.comparison_rows(metrics.fold_summary(_fold_metrics(spark, sf_dir)), ["roc_auc", "f1"])


@query
def feature_dictionary(spark, sf_dir):
    entries = [
        {"feature": "l_quantity", "logical_type": "number", "role": "predictor", "action": "none", "reason": "units"},
        {"feature": "l_discount", "logical_type": "number", "role": "predictor", "action": "zero to missing", "reason": "rate"},
        {"feature": "l_orderkey", "logical_type": "id", "role": "identifier", "action": "drop", "reason": "key"},
    ]
    measured = profile.missing_values(_gaps(spark, sf_dir), ["l_quantity", "l_discount", "l_orderkey"])
    return rounded(profile.feature_dictionary(measured, entries))


@query
def encode_many_levels(spark, sf_dir):
    """Level numbers of a column with as many levels as rows nearly, one of them a fourth of the rows; gaps take that one."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 4 == 0, "common").when(F.col("o_orderkey") % 50 != 1, F.col("o_orderkey").cast("string")).alias("level"))
    path = f"{checkpoint_dir(spark).rstrip('/')}/levels-{uuid.uuid4().hex}"
    dictionary = levels.level_dictionary(features.category_levels(orders.filter("o_orderkey % 11 <> 0"), ["level"]), [], path)
    size = dictionary.count()
    return levels.with_level_index(orders, "level", dictionary, size, "common", "slot").select("o_orderkey", F.col("slot").cast("long").alias("slot"), F.lit(size).cast("long").alias("n_slots"))


# Models


def _documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    words = F.size(F.split("text", r"\s+"))
    return docs.select(
        "doc_id", F.col("n_chars").cast("double").alias("n_chars"), words.cast("double").alias("n_words"),
        (F.size(F.split("text", "\n"))).cast("double").alias("n_lines"),
        (F.col("n_chars") / words).alias("mean_word"), "lang", F.col("quality").cast("int").alias("label"),
    )


_DOC_PLAN = [("n_chars", "scale"), ("n_words", "scale"), ("n_lines", "scale"), ("mean_word", "scale"), ("lang", "levels")]


@query
def train_compare(spark, sf_dir):
    """Four families cross-validated on document features: mean metrics per family."""
    families = {
        "logistic": models.Family("logistic", models.logistic, fixed={"balanced": True}),
        "linear_svm": models.Family("linear_svm", models.support_vector, fixed={"kernel": "linear", "calibrated": False, "balanced": True, "iterations": 20}),
        "forest": models.Family("forest", models.forest, fixed={"trees": 20, "depth": 5, "balanced": True}),
        "boosted": models.Family("boosted", models.boosted, fixed={"trees": 10}),
    }
    rows = train.with_folds(_documents(spark, sf_dir), "doc_id", 3)
    return rounded(train.compare_models(rows, families, lambda: features.TablePrep(_DOC_PLAN), 3, parallelism=4))


@query
def model_coefficients(spark, sf_dir):
    rows = _documents(spark, sf_dir)
    model = models.pipeline(features.TablePrep(_DOC_PLAN), models.logistic(C=1.0)).fit(rows)
    return models.coefficients(model, model.stages[0].feature_names(), spark)


def _priority_rows(spark, sf_dir):
    """Orders with a label, one column of levels and one of 0 and 1."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").cast("int").alias("label"), "o_orderstatus",
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM").cast("double").alias("upper"),
    )


#: Models whose scores have a closed form: one free weight per level gives the level's rate, one cut of a 0/1 column the rates of its sides.
_CLOSED = {
    "levels": models.Family("levels", models.logistic, fixed={"C": 1e9}),
    "stump": models.Family("stump", models.forest, fixed={"trees": 1, "depth": 1, "features": "all", "bootstrap": False}),
}


def _closed_scores(spark, sf_dir):
    rows = train.with_folds(_priority_rows(spark, sf_dir), "o_orderkey", 3)
    preps = {"levels": [("o_orderstatus", "levels")], "stump": [("upper", "pass")]}
    parts = []
    for name, plan in preps.items():
        store = train.score_store(rows)
        parts.append(train.score_folds(rows, lambda plan=plan: features.TablePrep(plan), {name: _CLOSED[name].stages}, store, 3, keep=("o_orderkey", "label")))
    return parts[0].unionByName(parts[1])


@query
def cv_scores(spark, sf_dir):
    """Held-out scores of every row, by model and fold, from the score table."""
    return rounded(_closed_scores(spark, sf_dir), 3).select("model", "fold", "o_orderkey", "label", "prediction", "score")


@query
def cv_metrics(spark, sf_dir):
    """What the stored scores come to per model and fold."""
    measured = metrics.all_metrics(_closed_scores(spark, sf_dir), "label", "prediction", "score", ["model", "fold"])
    return rounded(measured, 4).select("model", "fold", "tp", "fp", "tn", "fn", "accuracy", "recall")


@query
def level_coefficients(spark, sf_dir):
    """Log-odds of each level: the intercept and the level's coefficient."""
    model = models.pipeline(features.TablePrep([("o_orderstatus", "levels")]), models.logistic(C=1e9)).fit(_priority_rows(spark, sf_dir))
    found = models.coefficients(model, model.stages[0].feature_names(), spark)
    base = found.filter("feature = '(intercept)'").select(F.col("coefficient").alias("base"))
    logits = found.filter("feature <> '(intercept)'").select("feature", (F.col("coefficient") + base.scalar()).alias("log_odds"))
    return rounded(logits, 3)
