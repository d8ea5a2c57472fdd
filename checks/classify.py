"""Classifier, quality, image and monitoring queries with their oracles."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.functions import business as Bz
from marketloom.functions import classes as C
from marketloom.functions.numbers import round6
from marketloom.functions.reasons import joined
from marketloom.operators import image_features as I
from marketloom.operators import monitoring as Mo
from marketloom.operators import predictions as P
from marketloom.operators import quality as Ql
from marketloom.plans import reports as Rp
from marketloom.session import cut, fresh_path
from marketloom.sources import retail_star as star

from . import sql as Q
from .sql import K, VIEWS, codes, condition, distinct_join, produce, produce_of, query, r, status, view

QUERIES, ORACLE = {}, {}


def register(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLE[name] = oracle
        return fn

    return add


# --- views ---------------------------------------------------------------------------------------

view(
    "preds",
    f"""SELECT event_id, event_id::VARCHAR AS prediction_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS created_at, event_type AS model,
        {produce('user_id')} || CASE WHEN event_id % 2 = 0 THEN '__Healthy' ELSE '__Rotten' END AS class_name,
        CASE WHEN event_id % 11 = 0 THEN {produce('user_id + 1')} ELSE {produce('user_id')} END ||
        CASE WHEN (event_id % 2 = 0) <> (event_id % 7 = 0) THEN '__Healthy' ELSE '__Rotten' END AS predicted_class,
        ({K}::DOUBLE + 0.5) / 100.0::DOUBLE AS confidence,
        CASE WHEN event_id % 5 <> 0 THEN ((event_id * 37) % 100)::DOUBLE / 100.0::DOUBLE END AS top1_top2_margin,
        CASE WHEN event_id % 4 = 0 THEN 'D:\\images\\' ELSE '/mnt/d/images/' END || 'img' || event_id || '.jpg' AS image_path
        FROM events WHERE event_type IN ('view', 'click', 'signup')""",
)
view(
    "topk",
    """SELECT *, CASE WHEN predicted_class LIKE '%Healthy' THEN replace(predicted_class, '__Healthy', '__Rotten') ELSE replace(predicted_class, '__Rotten', '__Healthy') END AS second_class,
        greatest(0.0::DOUBLE, confidence - coalesce(top1_top2_margin, 0.3::DOUBLE))::DECIMAL(6,3)::DOUBLE AS second_p,
        confidence::DECIMAL(6,3)::DOUBLE AS first_p FROM preds""",
    "preds",
)


def business_sql(source: str) -> str:
    low = "coalesce(top1_top2_margin < 0.15, false)"
    reasons = codes(
        ("ROTTEN_PREDICTION", "st = 'rotten'"), ("HEALTHY_PREDICTION", "st = 'healthy'"), ("UNKNOWN_FRESHNESS_STATUS", "st NOT IN ('healthy', 'rotten')"),
        ("LOW_CONFIDENCE", "confidence < 0.6"), ("MEDIUM_CONFIDENCE", "confidence >= 0.6 AND confidence < 0.9"), ("HIGH_CONFIDENCE", "confidence >= 0.9"),
        ("MANUAL_REVIEW_REQUIRED", "confidence < 0.6"), ("HIGH_CONFIDENCE_PREDICTION", "confidence >= 0.95"), ("AMBIGUOUS_PREDICTION", low),
        ("MANUAL_REVIEW_REQUIRED", low), ("HIGH_CONFIDENCE_REJECTION", "st = 'rotten' AND confidence >= 0.9"),
    )
    inspect = "Manual inspection recommended before taking action."
    return f"""SELECT * EXCLUDE (st), {produce_of('predicted_class')} AS produce_type, st AS freshness_status,
        CASE st WHEN 'healthy' THEN confidence WHEN 'rotten' THEN 1.0::DOUBLE - confidence ELSE 0.0::DOUBLE END AS freshness_score,
        CASE WHEN confidence < 0.6 OR st NOT IN ('healthy', 'rotten') THEN 'Review' WHEN st = 'healthy' THEN CASE WHEN confidence >= 0.9 THEN 'A' ELSE 'B' END
             WHEN confidence >= 0.9 THEN 'Reject' ELSE 'Likely reject' END AS quality_grade,
        CASE WHEN confidence < 0.6 OR {low} THEN '{inspect}' WHEN st = 'healthy' THEN 'Accept for marketplace listing or normal handling.'
             WHEN st = 'rotten' THEN 'Reject from sale and route for disposal or supplier review.' ELSE '{inspect}' END AS recommended_action,
        {reasons} AS reason_codes, confidence < 0.6 OR st NOT IN ('healthy', 'rotten') OR {low} AS manual_review_required
        FROM (SELECT *, {status('predicted_class')} AS st FROM {source})"""


view("business", business_sql("preds"), "preds")
view("matrix", "SELECT model, class_name, predicted_class, count(*) AS n FROM preds GROUP BY ALL", "preds")
view(
    "by_class",
    """SELECT model, c AS class_name, coalesce(hit / nullif(pr, 0), 0.0::DOUBLE) AS precision, coalesce(hit / nullif(su, 0), 0.0::DOUBLE) AS recall, su AS support, hit FROM (
        SELECT model, c, sum(hit)::BIGINT AS hit, sum(su)::BIGINT AS su, sum(pr)::BIGINT AS pr FROM (
        SELECT model, class_name AS c, n AS su, 0 AS pr, CASE WHEN class_name = predicted_class THEN n ELSE 0 END AS hit FROM matrix
        UNION ALL SELECT model, predicted_class, 0, n, 0 FROM matrix) GROUP BY ALL)""",
    "matrix",
)
view("rated", "SELECT *, coalesce(2.0::DOUBLE * precision * recall / nullif(precision + recall, 0), 0.0::DOUBLE) AS f1 FROM by_class", "by_class")
view(
    "totals",
    """SELECT model, sum(support)::BIGINT AS support, sum(hit) / sum(support) AS accuracy, avg(precision) AS mp, avg(recall) AS mr, avg(f1) AS mf,
        sum(precision * support) / sum(support) AS wp, sum(recall * support) / sum(support) AS wr, sum(f1 * support) / sum(support) AS wf FROM rated GROUP BY model""",
    "rated",
)
view(
    "report",
    f"""SELECT model, class_name, {r('precision')} AS precision, {r('recall')} AS recall, {r('f1')} AS f1_score, support FROM rated
        UNION ALL SELECT model, 'accuracy', {r('accuracy')}, {r('accuracy')}, {r('accuracy')}, support FROM totals
        UNION ALL SELECT model, 'macro avg', {r('mp')}, {r('mr')}, {r('mf')}, support FROM totals
        UNION ALL SELECT model, 'weighted avg', {r('wp')}, {r('wr')}, {r('wf')}, support FROM totals""",
    "rated", "totals",
)
view(
    "manifest",
    f"""SELECT 'data/raw/external/img' || event_id || '.jpg' AS image_path,
        CASE WHEN event_id % 4 <> 3 THEN {produce('user_id')} || CASE WHEN event_id % 2 = 0 THEN '__Healthy' ELSE '__Rotten' END END AS expected_class,
        'note ' || event_id AS notes FROM events""",
)
FILE = "regexp_extract(replace({p}, '\\', '/'), '[^/]*$')"
STEM = "regexp_replace(" + FILE + ", '(.)\\.[^.]+$', '\\1')"
view(
    "validation",
    f"""SELECT {STEM.format(p='b.image_path')} AS image_id, b.image_path, m.expected_class,
        CASE WHEN coalesce(m.expected_class, '') = '' THEN '' ELSE {produce_of('m.expected_class')} END AS expected_produce_type,
        CASE WHEN coalesce(m.expected_class, '') = '' THEN '' ELSE {status('m.expected_class')} END AS expected_freshness_status,
        b.model, b.predicted_class, b.produce_type AS predicted_produce_type, b.freshness_status AS predicted_freshness_status, b.confidence, b.top1_top2_margin,
        CASE WHEN coalesce(m.expected_class, '') <> '' THEN b.produce_type = {produce_of('m.expected_class')} END AS produce_correct,
        CASE WHEN coalesce(m.expected_class, '') <> '' THEN b.freshness_status = {status('m.expected_class')} END AS freshness_correct,
        CASE WHEN coalesce(m.expected_class, '') <> '' THEN b.predicted_class = m.expected_class END AS full_class_correct,
        b.manual_review_required, b.reason_codes, m.notes
        FROM business b LEFT JOIN manifest m ON {FILE.format(p='b.image_path')} = {FILE.format(p='m.image_path')}""",
    "business", "manifest",
)


def preds(spark: SparkSession, sf: str) -> DataFrame:
    return star.predictions(spark, sf).drop("created_ts")


def business(spark, sf) -> DataFrame:
    return P.business_prediction(preds(spark, sf))


def flat_codes(df: DataFrame, *names: str) -> DataFrame:
    for n in names or ("reason_codes",):
        df = df.withColumn(n, joined(F.col(n)))
    return df


# --- expressions ---------------------------------------------------------------------------------

CLASS_NAMES = "SELECT DISTINCT c FROM (SELECT class_name AS c FROM preds UNION ALL SELECT predicted_class FROM preds UNION ALL SELECT 'X__' || class_name FROM preds UNION ALL SELECT lang FROM documents)"


def class_names(spark, sf) -> DataFrame:
    p = preds(spark, sf)
    names = p.select(F.col("class_name").alias("c")).unionByName(p.select(F.col("predicted_class").alias("c")))
    names = names.unionByName(p.select(F.concat(F.lit("X__"), "class_name").alias("c")))
    return names.unionByName(star.read(spark, sf, "documents").select(F.col("lang").alias("c"))).distinct()


@register("split_class", query(f"SELECT c, {produce_of('c')} AS produce, {status('c')} AS status FROM ({CLASS_NAMES})", "preds"))
def split_class(spark, sf):
    return class_names(spark, sf).select("c", C.produce_of(F.col("c")).alias("produce"), C.status_of(F.col("c")).alias("status"))


@register("condition_of", query(f"SELECT c, {condition('c')} AS condition FROM ({CLASS_NAMES})", "preds"))
def condition_of(spark, sf):
    return class_names(spark, sf).select("c", C.condition_of(F.col("c")).alias("condition"))


def _readable(c: str) -> str:
    return f"(CASE WHEN {status(c)} IN ('healthy', 'rotten') THEN {status(c)} || ' ' || lower(trim(replace({produce_of(c)}, '_', ' '))) ELSE lower(trim(replace(replace({c}, '__', ' '), '_', ' '))) END)"


@register("class_caption", query(f"""SELECT event_id, 'Actual label: ' || {_readable('class_name')} || chr(10) || 'Model prediction: ' || {_readable('predicted_class')} || chr(10) ||
    'Confidence: ' || printf('%.1f', {r('confidence * 100.0::DOUBLE', 1)}) || '%' || chr(10) ||
    CASE WHEN class_name <> predicted_class AND confidence >= 0.95 THEN 'Risk: high-confidence error, manual review needed.'
         WHEN class_name <> predicted_class THEN 'Risk: incorrect prediction, inspect the attention map.'
         ELSE 'Interpretation: highlighted regions influenced the decision most.' END AS caption FROM preds""", "preds"))
def class_caption(spark, sf):
    c = F.col
    caption = C.class_caption(c("predicted_class"), c("confidence"), c("class_name"), c("class_name") == c("predicted_class"))
    return preds(spark, sf).select("event_id", caption.alias("caption"))


@register("file_keys", query(f"SELECT image_path, {FILE.format(p='image_path')} AS file_name, {STEM.format(p='image_path')} AS stem FROM preds", "preds"))
def file_keys(spark, sf):
    p = F.col("image_path")
    return preds(spark, sf).select("image_path", C.file_name(p).alias("file_name"), C.file_stem(p).alias("stem"))


@register("path_translate", query("""SELECT image_path, CASE WHEN regexp_matches(image_path, '^[A-Za-z]:[\\\\/]') THEN '/mnt/' || lower(substr(image_path, 1, 1)) || '/' || replace(substr(image_path, 4), '\\', '/') ELSE image_path END AS mounted,
    CASE WHEN regexp_matches(image_path, '^/mnt/[^/]/') THEN substr(image_path, 6, 1) || ':' || substr(image_path, 7) ELSE image_path END AS drive FROM preds""", "preds"))
def path_translate(spark, sf):
    p = F.col("image_path")
    return preds(spark, sf).select("image_path", C.drive_to_mount(p).alias("mounted"), C.mount_to_drive(p).alias("drive"))


view(
    "feedback",
    f"""SELECT event_id AS seq, CASE WHEN event_id % 10 <> 0 THEN (event_id - 1)::VARCHAR ELSE '' END AS prediction_id,
        CASE WHEN event_id % 6 = 0 THEN {produce('user_id')} || '__Healthy' END AS predicted_class, CASE WHEN event_id % 8 = 0 THEN 'B' END AS predicted_grade,
        CASE WHEN event_id % 9 = 0 THEN {produce('user_id')} || '__Rotten' WHEN event_id % 9 = 1 THEN '' END AS corrected_class,
        CASE WHEN event_id % 4 = 0 THEN {produce('user_id')} || '__Healthy' END AS producer_override_class,
        CASE WHEN event_id % 4 = 1 THEN 'A' END AS producer_override_grade,
        CASE WHEN {K} % 3 = 0 THEN true WHEN {K} % 3 = 1 THEN false END AS accepted,
        CASE WHEN event_id % 12 = 0 THEN 'manual' END AS model_name,
        CASE WHEN event_id % 7 = 0 THEN '' WHEN event_id % 7 = 1 THEN 'someday soon' WHEN event_id % 7 = 2 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+09:00' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS created_at, ts
        FROM events WHERE event_type IN ('purchase', 'error')""",
)
EMPTY = "nullif({}, '')"


@register("first_non_empty", query("SELECT seq, coalesce(nullif(corrected_class, ''), nullif(producer_override_class, '')) AS value FROM feedback", "feedback"))
def first_non_empty(spark, sf):
    f = star.feedback(spark, sf)
    return f.select("seq", C.first_non_empty(F.col("corrected_class"), F.col("producer_override_class")).alias("value"))


DAY = "coalesce(substr(nullif({c}, ''), 1, 10), 'unknown')"


@register("event_day", query(f"SELECT seq, {DAY.format(c='created_at')} AS day FROM feedback", "feedback"))
def event_day(spark, sf):
    return star.feedback(spark, sf).select("seq", C.event_day(F.col("created_at")).alias("day"))


@register("parse_top_k", query("SELECT event_id, 2 AS entries, predicted_class || ':' || first_p || '|' || second_class || ':' || second_p AS top_k FROM topk", "topk"))
def parse_top_k(spark, sf):
    k = star.top_predictions_json(preds(spark, sf)).select("event_id", Bz.parse_top_k(F.col("top_predictions")).alias("k"))
    text = F.array_join(F.transform("k", lambda e: F.concat(e["class_name"], F.lit(":"), e["probability"].cast("string"))), "|")
    return k.select("event_id", F.size("k").alias("entries"), text.alias("top_k"))


VECTORS = """SELECT vec_id, label, i - 1 AS i, e / sum(e) OVER (PARTITION BY vec_id) AS p FROM
    (SELECT vec_id, label, i, exp(embedding[i]::DOUBLE * 20.0::DOUBLE) AS e FROM embeddings, generate_series(1, 64) g(i))"""


@register("top_k_from_vector", query(f"""SELECT vec_id, 'C' || max(label) AS class_name, max(CASE WHEN rn = 1 THEN 'C' || i END) AS predicted_class, {r('max(CASE WHEN rn = 1 THEN p END)')} AS confidence,
    {r('max(CASE WHEN rn = 1 THEN p END) - max(CASE WHEN rn = 2 THEN p END)')} AS margin, string_agg('C' || i, '|' ORDER BY rn) AS top_classes FROM
    (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, i) AS rn FROM ({VECTORS})) WHERE rn <= 3 GROUP BY vec_id"""))
def top_k_from_vector(spark, sf):
    v = star.probability_vectors(spark, sf)
    k = v.select("vec_id", "class_name", Bz.top_k_from_vector(F.col("probabilities"), [f"C{i}" for i in range(64)], 3).alias("k"))
    first = F.get("k", F.lit(0))
    return k.select(
        "vec_id", "class_name", first["class_name"].alias("predicted_class"), round6(first["probability"]).alias("confidence"),
        round6(Bz.list_margin(F.col("k"))).alias("margin"), F.array_join(F.transform("k", lambda e: e["class_name"]), "|").alias("top_classes"),
    )


# --- mapping -------------------------------------------------------------------------------------


def _business_column(name: str, column: str, flat: bool = False):
    ORACLE[name] = query(f"SELECT event_id, {column if column != 'freshness_score' else r(column)} AS {column} FROM business", "business")

    def run(spark, sf):
        df = business(spark, sf).select("event_id", column)
        if flat:
            return flat_codes(df, column)
        return df.withColumn(column, round6(F.col(column))) if column == "freshness_score" else df

    QUERIES[name] = run


for _name, _column, _flat in [
    ("legacy_grade", "quality_grade", False), ("legacy_action", "recommended_action", False), ("legacy_reasons", "reason_codes", True),
    ("freshness_score", "freshness_score", False), ("legacy_review", "manual_review_required", False),
]:
    _business_column(_name, _column, _flat)


@register("business_prediction", query(f"SELECT * REPLACE ({r('freshness_score')} AS freshness_score) FROM business", "business"))
def business_prediction(spark, sf):
    return flat_codes(business(spark, sf)).withColumn("freshness_score", round6(F.col("freshness_score")))


@register("suitability_label", query("""SELECT model, decision, CASE WHEN decision = 'Selected final deployment candidate' THEN 'Selected: strong grouped metrics, fewer high-confidence errors, and lower serving risk.'
    WHEN lower(decision) LIKE '%challenger%' THEN 'Main challenger: stronger macro F1, but higher high-confidence error count increases deployment risk.'
    ELSE 'Comparison/ablation evidence; not selected for final demo.' END AS deployment_suitability FROM
    (SELECT model, CASE place WHEN 1 THEN 'Selected final deployment candidate' WHEN 2 THEN 'Strong Challenger' ELSE 'Ablation' END AS decision FROM
     (SELECT model, row_number() OVER (ORDER BY accuracy DESC, model) AS place FROM totals))""".replace("ORDER BY accuracy", f"ORDER BY {r('accuracy')}"), "totals"))
def suitability_label(spark, sf):
    from pyspark.sql import Window

    # One row per model: the comparison is a result table.
    placed = P.model_comparison(preds(spark, sf)).withColumn("place", F.row_number().over(Window.orderBy(F.desc("accuracy"), "model")))
    decision = F.when(F.col("place") == 1, F.lit(P.SELECTED_DECISION)).when(F.col("place") == 2, F.lit("Strong Challenger")).otherwise(F.lit("Ablation"))
    labelled = placed.withColumn("decision", decision)
    return labelled.select("model", "decision", P.suitability_label(F.col("decision")).alias("deployment_suitability"))


@register("experiment_filter", query("SELECT event_id, model FROM preds WHERE model = 'click'", "preds"))
def experiment_filter(spark, sf):
    return P.experiment_filter(preds(spark, sf), "click", "model").select("event_id", "model")


@register("final_metrics_pick", """SELECT event_id, event_type AS model_name, json_extract_string(props, '$.k') AS metrics, NULL::VARCHAR AS selection_reason FROM events""")
def final_metrics_pick(spark, sf):
    e = star.events(spark, sf)
    text = F.concat(F.lit('{"model_name": "'), "event_type", F.lit('", "metrics": '), F.get_json_object("props", "$.k"), F.lit("}"))
    picked = P.final_metrics_pick(e.select("event_id", text.alias("text")), ["event_id"])
    return picked.select("event_id", "model_name", "metrics", "selection_reason")


# --- audits --------------------------------------------------------------------------------------


@register("confusion_matrix", query("SELECT * FROM matrix", "matrix"))
def confusion_matrix(spark, sf):
    return P.confusion_matrix(preds(spark, sf), ["model"])


@register("classification_report", query("SELECT * FROM report", "report"))
def classification_report(spark, sf):
    return P.classification_report(preds(spark, sf), ["model"])


@register("confidence_audit", query(f"""SELECT model, e.rows, {r('accuracy')} AS accuracy, {r('mf')} AS macro_f1, {r('wf')} AS weighted_f1, e.errors, e.high_confidence_errors, {r('e.mean')} AS mean_error_confidence
    FROM totals JOIN (SELECT model, count(*) AS rows, count(*) FILTER (class_name <> predicted_class) AS errors,
    count(*) FILTER (class_name <> predicted_class AND confidence >= 0.95) AS high_confidence_errors, coalesce(avg(confidence) FILTER (class_name <> predicted_class), 0) AS mean FROM preds GROUP BY model) e USING (model)""", "totals", "preds"))
def confidence_audit(spark, sf):
    return P.confidence_audit(preds(spark, sf))


@register("high_confidence_errors", query("SELECT event_id, model, class_name, predicted_class, confidence FROM preds WHERE class_name <> predicted_class AND confidence >= 0.95", "preds"))
def high_confidence_errors(spark, sf):
    return P.high_confidence_errors(preds(spark, sf)).select("event_id", "model", "class_name", "predicted_class", "confidence")


@register("model_comparison", query(f"SELECT model, {r('accuracy')} AS accuracy, {r('mf')} AS macro_f1, {r('wf')} AS weighted_f1 FROM totals", "totals"))
def model_comparison(spark, sf):
    return P.model_comparison(preds(spark, sf))


@register("weakest_classes", query("SELECT *, (row_number() OVER (PARTITION BY model ORDER BY f1_score, class_name))::INTEGER AS rank FROM report WHERE class_name LIKE '%\\_\\_%' ESCAPE '\\' QUALIFY rank <= 5", "report"))
def weakest_classes(spark, sf):
    return P.weakest_classes(P.classification_report(preds(spark, sf), ["model"]), ["model"])


WATCHED = ["Mango__Rotten", "Apple__Healthy", "Nothing__Rotten", "Dragonfruit__Rotten"]


@register("weak_class_watchlist", query(f"SELECT *, list_position({WATCHED}, class_name)::INTEGER AS position FROM report WHERE class_name IN {tuple(WATCHED)}", "report"))
def weak_class_watchlist(spark, sf):
    return P.weak_class_watchlist(P.classification_report(preds(spark, sf), ["model"]), WATCHED)


# --- costs ---------------------------------------------------------------------------------------

OUTCOME = f"""CASE WHEN class_name = predicted_class THEN 'correct_auto_decision' WHEN {condition('class_name')} = 'rotten' AND {condition('predicted_class')} = 'healthy' THEN 'rotten_predicted_healthy'
    WHEN {condition('class_name')} = 'healthy' AND {condition('predicted_class')} = 'rotten' THEN 'healthy_predicted_rotten' ELSE 'wrong_produce_same_condition' END"""
COST = "CASE {o} WHEN 'correct_auto_decision' THEN 0 WHEN 'manual_review' THEN 1 WHEN 'wrong_produce_same_condition' THEN 2 WHEN 'healthy_predicted_rotten' THEN 3 ELSE 10 END"
REVIEW = "(confidence < t1 OR coalesce(top1_top2_margin < t2, false) OR (rotten AND confidence < t3))"


@register("prediction_cost", query(f"SELECT event_id, o AS cost_reason, {COST.format(o='o')} AS cost FROM (SELECT event_id, {OUTCOME} AS o FROM preds)", "preds"))
def prediction_cost(spark, sf):
    return P.prediction_cost(preds(spark, sf)).select("event_id", "cost_reason", "cost")


@register("manual_review_rule", query(f"SELECT event_id, {REVIEW} AS review FROM (SELECT *, {condition('predicted_class')} = 'rotten' AS rotten, 0.6::DOUBLE AS t1, 0.15::DOUBLE AS t2, 0.8::DOUBLE AS t3 FROM preds)", "preds"))
def manual_review_rule(spark, sf):
    c = F.col
    rule = P.manual_review_rule(c("confidence"), c("top1_top2_margin"), C.condition_of(c("predicted_class")) == "rotten", F.lit(0.6), F.lit(0.15), F.lit(0.8))
    return preds(spark, sf).select("event_id", rule.alias("review"))


def grid_sql(by: str) -> str:
    return f"""SELECT {by}confidence_review_threshold, margin_review_threshold, rotten_auto_block_threshold, sum(cost)::BIGINT AS total_operational_cost,
        count(*) FILTER (o = 'rotten_predicted_healthy') AS false_fresh_count, count(*) FILTER (o = 'healthy_predicted_rotten') AS false_rotten_count,
        count(*) FILTER (o = 'wrong_produce_same_condition') AS wrong_produce_count, count(*) FILTER (o = 'correct_auto_decision') AS correct_auto_count,
        count(*) FILTER (o = 'manual_review') AS manual_review_count, count(*) AS evaluated_rows, {r('sum(cost) / count(*)')} AS expected_operational_cost,
        {r("count(*) FILTER (o = 'manual_review') / count(*)")} AS manual_review_rate, {r("count(*) FILTER (o <> 'manual_review') / count(*)")} AS auto_decision_rate
        FROM (SELECT *, {COST.format(o='o')} AS cost FROM (SELECT *, t1 AS confidence_review_threshold, t2 AS margin_review_threshold, t3 AS rotten_auto_block_threshold,
          CASE WHEN {REVIEW} THEN 'manual_review' ELSE o0 END AS o FROM
          (SELECT *, {condition('predicted_class')} = 'rotten' AS rotten, {OUTCOME} AS o0 FROM preds),
          (SELECT unnest([0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8]::DOUBLE[]) AS t1), (SELECT unnest([0.0, 0.05, 0.1, 0.15, 0.2, 0.25]::DOUBLE[]) AS t2),
          (SELECT unnest([0.7, 0.75, 0.8, 0.85, 0.9]::DOUBLE[]) AS t3))) GROUP BY ALL"""


@register("threshold_grid", query(grid_sql(""), "preds"))
def threshold_grid(spark, sf):
    return P.threshold_grid(preds(spark, sf))


@register("threshold_cross", query(grid_sql("model, "), "preds"))
def threshold_cross(spark, sf):
    return P.threshold_grid(preds(spark, sf), by=["model"])


@register("select_operating_point", query(f"SELECT * FROM ({grid_sql('')}) ORDER BY expected_operational_cost, false_fresh_count, manual_review_rate, confidence_review_threshold, margin_review_threshold, rotten_auto_block_threshold LIMIT 1", "preds"))
def select_operating_point(spark, sf):
    return P.select_operating_point(P.threshold_grid(preds(spark, sf)))


# --- validation ----------------------------------------------------------------------------------


def validation(spark, sf) -> DataFrame:
    return P.validation_table(preds(spark, sf), star.manifest(spark, sf))


@register("manifest_join", query(f"SELECT b.event_id, m.expected_class, m.notes FROM preds b LEFT JOIN manifest m ON {FILE.format(p='b.image_path')} = {FILE.format(p='m.image_path')}", "preds", "manifest"))
def manifest_join(spark, sf):
    return P.manifest_join(preds(spark, sf), star.manifest(spark, sf)).select("event_id", "expected_class", "notes")


@register("validation_table", query("SELECT * FROM validation", "validation"))
def validation_table(spark, sf):
    return validation(spark, sf)


@register("validation_summary", query(f"""SELECT model, count(image_id) AS labeled_predictions, {r('avg(full_class_correct::INT)')} AS full_class_accuracy, {r('avg(produce_correct::INT)')} AS produce_accuracy,
    {r('avg(freshness_correct::INT)')} AS freshness_accuracy, {r('avg(manual_review_required::INT)')} AS manual_review_rate, {r('avg(confidence)')} AS mean_confidence
    FROM validation WHERE expected_class IS NOT NULL GROUP BY model""", "validation"))
def validation_summary(spark, sf):
    return P.validation_summary(validation(spark, sf))


@register("risky_cases", query("""SELECT image_id, image_path, expected_class, model, predicted_class, confidence, top1_top2_margin, full_class_correct, manual_review_required, reason_codes FROM validation
    WHERE coalesce(NOT full_class_correct, false) OR confidence < 0.6 OR coalesce(top1_top2_margin < 0.15, false) OR manual_review_required""", "validation"))
def risky_cases(spark, sf):
    return P.risky_cases(validation(spark, sf))


# --- images and quality --------------------------------------------------------------------------

PROFILE_ROWS = ", ".join(
    f"('{n}', [{', '.join(f'[{a}, {b}]' for a, b in p['hues'])}]::DOUBLE[][], {p['dark_warn']}::DOUBLE, {p['dark_fail']}::DOUBLE, {p['min_saturation']}::DOUBLE, {p['min_value']}::DOUBLE, {p['max_value']}::DOUBLE)"
    for n, p in I.PROFILES.items()
)
view("profiles", f"SELECT * FROM (VALUES {PROFILE_ROWS}) t(profile, hues, dark_warn, dark_fail, min_s, min_v, max_v)")
view("images", f"SELECT e.vec_id AS image_id, p.product_type FROM embeddings e CROSS JOIN (SELECT DISTINCT {produce_of('predicted_class')} AS product_type FROM preds) p WHERE e.vec_id % 41 <> 0", "preds")
view("images_whole", f"SELECT e.vec_id AS image_id, p.product_type FROM embeddings e CROSS JOIN (SELECT DISTINCT {produce_of('predicted_class')} AS product_type FROM preds) p", "preds")
VAL = "greatest(0.0::DOUBLE, least(1.0::DOUBLE, (embedding[({i}) % 64 + 1]::DOUBLE + 0.6::DOUBLE) / 1.2::DOUBLE))"
view("px", f"SELECT vec_id AS image_id, i, i // 8 AS y, i % 8 AS x, {VAL.format(i='i')} AS rd, {VAL.format(i='i + 21')} AS gr, {VAL.format(i='i + 42')} AS bl FROM embeddings, generate_series(0, 63) g(i) WHERE vec_id % 41 <> 0")
view("px_whole", f"SELECT vec_id AS image_id, i, i // 8 AS y, i % 8 AS x, {VAL.format(i='i')} AS rd, {VAL.format(i='i + 21')} AS gr, {VAL.format(i='i + 42')} AS bl FROM embeddings, generate_series(0, 63) g(i)")
view(
    "hsv_px",
    """SELECT image_id, i, y, x, rd, gr, bl, hi AS v, CASE WHEN hi > 1e-8 THEN d / hi ELSE 0.0::DOUBLE END AS s,
        CASE WHEN d <= 1e-8 THEN 0.0::DOUBLE WHEN bl = hi THEN (rd - gr) / d * 60.0::DOUBLE + 240.0::DOUBLE WHEN gr = hi THEN (bl - rd) / d * 60.0::DOUBLE + 120.0::DOUBLE
             ELSE ((gr - bl) / d * 60.0::DOUBLE + 360.0::DOUBLE) % 360.0::DOUBLE END AS h
        FROM (SELECT *, greatest(rd, gr, bl) AS hi, greatest(rd, gr, bl) - least(rd, gr, bl) AS d FROM px)""",
    "px",
)
HUE_OK = "len(list_filter(f.hues, lambda q: CASE WHEN q[1] <= q[2] THEN h >= q[1] AND h <= q[2] ELSE h >= q[1] OR h <= q[2] END)) > 0"
view(
    "measured",
    f"""SELECT image_id, product_type, known, dark_warn, dark_fail, avg(fg::INT) AS area, CASE WHEN sum(fg::INT) > 0 THEN sum((fg AND ok)::INT) / sum(fg::INT) ELSE 0.0::DOUBLE END AS accepted,
        CASE WHEN sum(fg::INT) > 0 THEN sum((fg AND v < dark_warn)::INT) / sum(fg::INT) ELSE 1.0::DOUBLE END AS dark, avg(v) AS mean_v FROM
        (SELECT k.image_id, k.product_type, k.known, f.dark_warn, f.dark_fail, v, s >= f.min_s AND v >= f.min_v AND v <= f.max_v AS fg, {HUE_OK} AS ok
         FROM (SELECT i.image_id, i.product_type, p.profile IS NOT NULL AS known, coalesce(p.profile, 'default') AS pk FROM images i
               LEFT JOIN profiles p ON p.profile = replace(replace(lower(i.product_type), '__', '_'), ' ', '_')) k
         JOIN profiles f ON f.profile = k.pk JOIN hsv_px h USING (image_id)) GROUP BY ALL""",
    "images", "profiles", "hsv_px",
)
view(
    "blur",
    """SELECT c.image_id, least(100.0::DOUBLE, greatest(0.0::DOUBLE, var_pop(u.g + d.g + l.g + w.g - 4.0::DOUBLE * c.g) * 1000.0::DOUBLE)) AS blur
        FROM g c JOIN g u ON u.image_id = c.image_id AND u.y = c.y - 1 AND u.x = c.x JOIN g d ON d.image_id = c.image_id AND d.y = c.y + 1 AND d.x = c.x
        JOIN g l ON l.image_id = c.image_id AND l.y = c.y AND l.x = c.x - 1 JOIN g w ON w.image_id = c.image_id AND w.y = c.y AND w.x = c.x + 1 GROUP BY 1""",
    "g",
)
view("g", "SELECT image_id, y, x, 0.299::DOUBLE * rd + 0.587::DOUBLE * gr + 0.114::DOUBLE * bl AS g FROM px", "px")
CLAMP = "least(100.0::DOUBLE, greatest(0.0::DOUBLE, {}))"
view(
    "features",
    f"""SELECT m.image_id, m.product_type, known AS profile_known, {CLAMP.format('0.6::DOUBLE * blur + 0.4::DOUBLE * bright')} AS image_quality_score,
        {CLAMP.format("accepted * 100.0::DOUBLE - CASE WHEN dark >= dark_fail THEN 40 WHEN dark >= dark_warn THEN 20 ELSE 0 END - CASE WHEN known THEN 0 ELSE 10 END")} AS color_score,
        {CLAMP.format('100.0::DOUBLE - dark * 100.0::DOUBLE')} AS defect_absence_score,
        CASE WHEN area BETWEEN 0.25 AND 0.75 THEN 90.0::DOUBLE WHEN area BETWEEN 0.15 AND 0.85 THEN 75.0::DOUBLE ELSE 60.0::DOUBLE END AS size_proxy_score,
        dark AS dark_ratio, accepted AS accepted_color_ratio, blur AS blur_score, bright AS brightness_score, area AS foreground_area_ratio,
        {codes(('unknown_produce_profile_used', 'NOT known'), ('foreground_mask_low_confidence', 'area = 0'), ('dark_ratio_fail_threshold_reached', 'dark >= dark_fail'),
               ('dark_ratio_warn_threshold_reached', 'dark >= dark_warn AND dark < dark_fail'), ('size_proxy_is_relative_to_image_area_not_physical_size', None),
               ('colour_score_is_lighting_sensitive_proxy', None), ('low_foreground_coverage', 'area < 0.15'), ('high_foreground_coverage_or_background_mask_noise', 'area > 0.85'))} AS feature_warnings
        FROM (SELECT *, {CLAMP.format('100.0::DOUBLE - abs(mean_v - 0.55::DOUBLE) * 180.0::DOUBLE')} AS bright FROM measured) m JOIN blur b ON b.image_id = m.image_id""",
    "measured", "blur",
)
WHOLE = ["images", "px", "hsv_px", "measured", "g", "blur", "features", "components"]


def view_whole(name: str) -> None:
    """The view over all images, none of them without pixels, under the name with ``_whole``."""
    needs, text = VIEWS[name]
    over = re.sub(rf"\b(FROM|JOIN) ({'|'.join(WHOLE)})\b", r"\1 \2_whole", text)
    view(f"{name}_whole", over, *[f"{n}_whole" if n in WHOLE else n for n in needs])


for _name in WHOLE[2:-1]:
    view_whole(_name)
SCORES = ["image_quality_score", "color_score", "defect_absence_score", "size_proxy_score", "dark_ratio", "accepted_color_ratio", "blur_score", "brightness_score", "foreground_area_ratio"]
ROUND_SCORES = ", ".join(f"{r(c)} AS {c}" for c in SCORES)


def produce_types(spark, sf) -> DataFrame:
    return preds(spark, sf).select(C.produce_of(F.col("predicted_class")).alias("product_type")).distinct()


def images(spark, sf) -> DataFrame:
    """Every image for each of the (at most 14) product types."""
    types = F.array(*[F.lit(p) for p in star.PRODUCE])
    return star.some_unreadable(star.pixel_images(spark, sf)).withColumn("product_types", types)


def features(spark, sf) -> DataFrame:
    return I.image_features(images(spark, sf), I.quality_profiles(spark))


@register("image_features", query(f"SELECT image_id, product_type, profile_known, {ROUND_SCORES}, feature_warnings FROM features", "features"))
def image_features(spark, sf):
    f = flat_codes(features(spark, sf), "feature_warnings")
    return f.select("image_id", "product_type", "profile_known", *[round6(F.col(c)).alias(c) for c in SCORES], "feature_warnings")


@register("hsv", query(f"SELECT image_id, i::INTEGER AS i, {r('h')} AS hue, {r('s')} AS saturation, {r('v')} AS value FROM hsv_px_whole", "hsv_px_whole"))
def hsv(spark, sf):
    px = star.pixel_images(spark, sf).select("image_id", F.posexplode(F.arrays_zip("red", "green", "blue")).alias("i", "p"))
    values = px.select("image_id", "i", I.hsv(F.col("p.red"), F.col("p.green"), F.col("p.blue")).alias("c"))
    return values.select("image_id", "i", *[round6(F.col(f"c.{n}")).alias(n) for n in ("hue", "saturation", "value")])


@register("hue_range_join", query(f"""SELECT image_id, product_type, sum(ok::INT)::BIGINT AS accepted_pixels FROM
    (SELECT image_id, product_type, {HUE_OK} AS ok FROM (SELECT i.image_id, i.product_type, coalesce(p.profile, 'default') AS pk FROM images_whole i LEFT JOIN profiles p ON p.profile = lower(i.product_type)) k
     JOIN profiles f ON f.profile = k.pk JOIN hsv_px_whole h USING (image_id)) GROUP BY ALL""", "images_whole", "profiles", "hsv_px_whole"))
def hue_range_join(spark, sf):
    """Pixels are neither exploded nor shuffled: the hues of an image are sorted once, and each type searches them."""
    wanted = I.quality_profile_join(spark.createDataFrame([(p,) for p in star.PRODUCE], "product_type string"), I.quality_profiles(spark))
    types = wanted.select(F.struct("product_type", I.merged_ranges(F.col("hue_ranges")).alias("ranges")).alias("t")).agg(F.collect_list("t")).scalar()
    hues = F.transform(F.arrays_zip("red", "green", "blue"), lambda p: I.hsv(p["red"], p["green"], p["blue"])["hue"])
    sorted_once = star.pixel_images(spark, sf).select("image_id", F.array_sort(hues).alias("hues"), types.alias("types"))
    counts = F.transform("types", lambda t: F.struct(t["product_type"].alias("product_type"), I.hues_accepted(F.col("hues"), t["ranges"]).alias("accepted_pixels")))
    return sorted_once.select("image_id", F.inline(counts))


@register("quality_profile_join", query("""SELECT product_type, known AS profile_known, f.dark_warn AS dark_ratio_warn, f.dark_fail AS dark_ratio_fail, f.min_s AS min_saturation, f.min_v AS min_value, f.max_v AS max_value FROM
    (SELECT DISTINCT product_type, p.profile IS NOT NULL AS known, coalesce(p.profile, 'default') AS pk FROM images LEFT JOIN profiles p ON p.profile = lower(product_type)) k JOIN profiles f ON f.profile = k.pk""", "images", "profiles"))
def quality_profile_join(spark, sf):
    return I.quality_profile_join(produce_types(spark, sf), I.quality_profiles(spark)).drop("hue_ranges")


Q_ROWS_SQL = """SELECT t.*, f.* EXCLUDE (image_id), split_part(t.predicted_class, '__', 1) AS pt0 FROM topk t JOIN features f
    ON f.image_id = t.event_id % (SELECT count(*) FROM embeddings) AND f.product_type = split_part(t.predicted_class, '__', 1)"""
view(
    "components",
    f"""SELECT *, {r('cs', 4)} AS c_model_condition, {r('color_score', 4)} AS c_color, {r('ds', 4)} AS c_defect_absence, {r('image_quality_score', 4)} AS c_image_quality,
        {r('size_proxy_score', 4)} AS c_size_proxy, {r('0.5::DOUBLE * cs + 0.35::DOUBLE * color_score + 0.15::DOUBLE * ds', 4)} AS c_ripeness FROM
        (SELECT *, CASE WHEN condition = 'rotten' THEN least(defect_absence_score, cs) ELSE defect_absence_score END AS ds FROM
         (SELECT *, CASE condition WHEN 'healthy' THEN confidence * 100.0::DOUBLE WHEN 'rotten' THEN (1.0::DOUBLE - confidence) * 100.0::DOUBLE ELSE 0.0::DOUBLE END AS cs FROM
          (SELECT *, {status('predicted_class')} AS condition FROM ({Q_ROWS_SQL}))))""",
    "topk", "features",
)


view_whole("components")


def decision_sql(source: str) -> str:
    """Quality decision over component rows with weights w1..w5."""
    small = "coalesce(top1_top2_margin < 0.15, false)"
    conflict = "(confidence - second_p < 0.15)"
    overall = r("0.0::DOUBLE + c_model_condition * w1 + c_color * w2 + c_defect_absence * w3 + c_image_quality * w4 + c_size_proxy * w5", 4)
    poor_h = "(condition = 'healthy' AND image_quality_score < 35 AND br <> 'poor')"
    rp = "(br = 'rot' AND image_quality_score < 35)"
    reasons = codes(
        ("classified_as_healthy", "condition = 'healthy'"), ("classified_as_rotten", "condition = 'rotten'"), ("unknown_condition", "condition NOT IN ('healthy', 'rotten')"),
        ("low_model_confidence", "br = 'low'"), ("high_confidence_rotten_prediction", "br = 'rot'"), ("possible_rotten_prediction_manual_review", "br = 'maybe'"),
        ("very_poor_image_quality", "br = 'poor'"), ("one_or_more_grade_c_thresholds_triggered", "br = 'c'"), ("all_grade_a_thresholds_met", "br = 'a'"),
        ("acceptable_quality_but_not_grade_a", "br = 'b'"), ("image_quality_warning", rp), ("manual_review_required", f"br IN ('low', 'maybe', 'poor') OR {rp}"),
        ("image_quality_warning", f"(br = 'maybe' AND image_quality_score < 35) OR {poor_h}"), ("manual_review_recommended", poor_h),
        ("low_top1_top2_margin", small), ("manual_review_required", small), ("opposite_condition_conflict", conflict), ("manual_review_required", conflict),
        ("default_quality_profile_used", "NOT profile_known"),
    )
    return f"""SELECT *, CASE WHEN grade = 'C' AND manual_review THEN 'manual_review_before_listing' WHEN grade = 'A' THEN 'normal_sale' WHEN grade = 'B' THEN 'discount_or_quick_sale'
          WHEN grade = 'C' THEN 'manual_review_or_discard' ELSE 'manual_review_required' END AS action,
        CASE grade WHEN 'A' THEN 'available' WHEN 'B' THEN 'surplus_or_lower_grade' WHEN 'C' THEN 'blocked_pending_review' ELSE 'pending_review' END AS inventory_status,
        CASE grade WHEN 'A' THEN 0 WHEN 'B' THEN 20 END AS discount_percentage FROM
        (SELECT *, CASE WHEN br IN ('low', 'poor') THEN 'Review' WHEN br IN ('rot', 'maybe', 'c') THEN 'C' WHEN br = 'a' THEN 'A' ELSE 'B' END AS grade,
          condition NOT IN ('healthy', 'rotten') OR br IN ('low', 'maybe', 'poor') OR {rp} OR {poor_h} OR {small} OR {conflict} AS manual_review, {reasons} AS quality_reason_codes FROM
         (SELECT *, CASE WHEN confidence < 0.6 THEN 'low' WHEN condition = 'rotten' AND confidence >= 0.8 THEN 'rot' WHEN condition = 'rotten' THEN 'maybe' WHEN image_quality_score < 15 THEN 'poor'
            WHEN dark_ratio >= 0.32 OR c_ripeness < 60 OR color_score < 65 OR overall_quality_score < 65 THEN 'c'
            WHEN c_model_condition >= 85 AND color_score >= 85 AND size_proxy_score >= 80 AND c_ripeness >= 80 AND overall_quality_score >= 85 THEN 'a' ELSE 'b' END AS br
          FROM (SELECT *, {overall} AS overall_quality_score FROM ({source}))))"""


DEFAULT_W = "0.45::DOUBLE AS w1, 0.25::DOUBLE AS w2, 0.15::DOUBLE AS w3, 0.1::DOUBLE AS w4, 0.05::DOUBLE AS w5"
view("decisions", decision_sql(f"SELECT *, {DEFAULT_W} FROM components"), "components")


def _used_images(spark, sf, rows: DataFrame, whole: bool = False) -> DataFrame:
    types = rows.groupBy("image_id").agg(F.collect_set("product_type").alias("product_types"))
    images = star.pixel_images(spark, sf)
    return (images if whole else star.some_unreadable(images)).join(types, "image_id")


def quality_rows(spark, sf, whole: bool = False) -> DataFrame:
    """Predictions joined with the features of their image: an image is read once and measured for the product types that occur
    with it. Unless the images are ``whole``, predictions whose image gives no features are those of ``missing_images``."""
    p = star.top_predictions_json(preds(spark, sf))
    count = star.read(spark, sf, "embeddings").select(F.count("*")).scalar()
    rows = p.select(
        "*", (F.col("event_id") % count).alias("image_id"), C.produce_of(F.col("predicted_class")).alias("product_type"),
        C.status_of(F.col("predicted_class")).alias("condition"), Bz.parse_top_k(F.col("top_predictions")).alias("top_k"),
    )
    return rows.join(I.image_features(_used_images(spark, sf, rows, whole), I.quality_profiles(spark)), ["image_id", "product_type"])


COMPONENT_COLUMNS = ["c_model_condition", "c_color", "c_defect_absence", "c_image_quality", "c_size_proxy", "c_ripeness"]


@register("quality_components", query(f"SELECT event_id, {', '.join(COMPONENT_COLUMNS)} FROM components_whole", "components_whole"))
def quality_components(spark, sf):
    return Ql.quality_components(quality_rows(spark, sf, whole=True)).select("event_id", *COMPONENT_COLUMNS)


@register("quality_overall", query("SELECT event_id, overall_quality_score FROM decisions", "decisions"))
def quality_overall(spark, sf):
    scored = Ql.quality_components(quality_rows(spark, sf))
    return scored.select("event_id", Ql.overall_score(F.array(*[F.lit(w) for w in Ql.DEFAULT_WEIGHTS])).alias("overall_quality_score"))


@register("condition_conflict", query("SELECT event_id, confidence - second_p < 0.15 AS conflict FROM topk", "topk"))
def condition_conflict(spark, sf):
    p = star.top_predictions_json(preds(spark, sf))
    rows = p.select(
        "event_id", "confidence", C.produce_of(F.col("predicted_class")).alias("product_type"), C.status_of(F.col("predicted_class")).alias("condition"),
        Bz.parse_top_k(F.col("top_predictions")).alias("top_k"),
    )
    return rows.select("event_id", Ql.condition_conflict(rows).alias("conflict"))


DECISION = ["event_id", "grade", "overall_quality_score", "action", "inventory_status", "discount_percentage", "manual_review", "quality_reason_codes", "warnings"]
WARN_SQL = distinct_join("list_concat([CASE WHEN NOT profile_known THEN 'unknown_produce_profile_used' END], string_split(feature_warnings, '|'), ['quality_grade_is_rule_based_not_supervised_model_output'])")


@register("quality_decision", query(f"SELECT {', '.join(DECISION[:-1])}, {WARN_SQL} AS warnings FROM decisions", "decisions"))
def quality_decision(spark, sf):
    return flat_codes(Ql.quality_decision(quality_rows(spark, sf)), "quality_reason_codes", "warnings").select(*DECISION)


@register("prediction_enrich", query(f"""SELECT b.event_id, b.produce_type, b.freshness_status, coalesce(d.grade, b.quality_grade) AS quality_grade, coalesce(d.action, b.recommended_action) AS recommended_action,
    b.manual_review_required OR coalesce(d.manual_review, false) AS manual_review_required, d.grade IS NULL AS quality_missing, d.inventory_status, d.discount_percentage,
    {distinct_join("list_concat(string_split(b.reason_codes, '|'), string_split(d.quality_reason_codes, '|'))")} AS reason_codes, d.overall_quality_score, b.model AS model_name, 'v' || (b.event_id % 3) AS model_version
    FROM business b LEFT JOIN decisions d USING (event_id)""", "business", "decisions"))
def prediction_enrich(spark, sf):
    version = F.concat(F.lit("v"), (F.col("event_id") % 3).cast("string"))
    decided = Ql.quality_decision(quality_rows(spark, sf))  # some images give no features
    rich = Ql.prediction_enrich(business(spark, sf), decided, "event_id", F.col("model"), F.lit(None).cast("string"), version)
    return flat_codes(rich).select(
        "event_id", "produce_type", "freshness_status", "quality_grade", "recommended_action", "manual_review_required", "reason_codes", "overall_quality_score", "model_name", "model_version",
        "quality_missing", "inventory_status", "discount_percentage",
    )


@register("missing_images", query("""SELECT event_id, image_id, product_type FROM
    (SELECT event_id, event_id % (SELECT count(*) FROM embeddings) AS image_id, split_part(predicted_class, '__', 1) AS product_type FROM topk) WHERE image_id % 41 = 0""", "topk"))
def missing_images(spark, sf):
    count = star.read(spark, sf, "embeddings").select(F.count("*")).scalar()
    p = preds(spark, sf)
    rows = p.select("event_id", (F.col("event_id") % count).alias("image_id"), C.produce_of(F.col("predicted_class")).alias("product_type"))
    return Ql.missing_images(rows, I.image_features(_used_images(spark, sf, rows), I.quality_profiles(spark)), ["image_id", "product_type"])


def weight_sql(sets: dict) -> str:
    rows = ", ".join(f"('{n}', {', '.join(f'{w}::DOUBLE' for w in ws)})" for n, ws in sets.items())
    src = f"SELECT * FROM components, (VALUES {rows}) t(weight_set, w1, w2, w3, w4, w5)"
    unsure = "(confidence < 0.6 OR coalesce(top1_top2_margin < 0.15, false))"
    return f"""WITH d AS ({decision_sql(src)})
        SELECT weight_set, count(*) FILTER (grade = 'A') AS grade_a_count, count(*) FILTER (grade = 'B') AS grade_b_count, count(*) FILTER (grade = 'C') AS grade_c_count,
        count(*) FILTER (grade = 'Review') AS review_count, {r('avg(manual_review::INT)')} AS manual_review_rate,
        {r("coalesce(count(*) FILTER (condition = 'rotten' AND grade IN ('C', 'Review')) / nullif(count(*) FILTER (condition = 'rotten'), 0), 0)")} AS rotten_to_c_or_review_rate,
        count(*) FILTER (grade IN ('A', 'B') AND (condition = 'rotten' OR {unsure})) AS risky_a_b_decisions, {r('avg(overall_quality_score)')} AS mean_overall_quality_score,
        (SELECT string_agg(action || ':' || n, '|' ORDER BY action) FROM (SELECT action, count(*) AS n FROM d x WHERE x.weight_set = d.weight_set GROUP BY action)) AS action_distribution
        FROM d GROUP BY weight_set"""


@register("weight_sensitivity", query(weight_sql(Ql.WEIGHT_SETS), "components"))
def weight_sensitivity(spark, sf):
    return Ql.evaluate_weight_sets(quality_rows(spark, sf))


@register("quality_ablation", query(weight_sql(Ql.ABLATION_SETS), "components"))
def quality_ablation(spark, sf):
    return Ql.evaluate_weight_sets(quality_rows(spark, sf), Ql.ABLATION_SETS)


@register("weight_set_cross", query(f"""SELECT event_id, weight_set, overall_quality_score, grade FROM ({decision_sql("SELECT * FROM components, (VALUES " + ", ".join(f"('{n}', {', '.join(f'{w}::DOUBLE' for w in ws)})" for n, ws in Ql.WEIGHT_SETS.items()) + ") t(weight_set, w1, w2, w3, w4, w5)")})""", "components"))
def weight_set_cross(spark, sf):
    sets = F.array(*[F.struct(F.lit(n).alias("n"), F.array(*[F.lit(w) for w in ws]).alias("w")) for n, ws in Ql.WEIGHT_SETS.items()])
    rows = quality_rows(spark, sf).withColumn("_s", F.explode(sets))
    return Ql.quality_decision(rows, F.col("_s.w")).select("event_id", F.col("_s.n").alias("weight_set"), "overall_quality_score", "grade")


# --- distributions -------------------------------------------------------------------------------


@register("grade_distribution", query('SELECT model, quality_grade, count(*) AS "count" FROM business GROUP BY ALL', "business"))
def grade_distribution(spark, sf):
    return Ql.grade_distribution(business(spark, sf))


@register("action_distribution", query('SELECT model, recommended_action, count(*) AS "count" FROM business GROUP BY ALL', "business"))
def action_distribution(spark, sf):
    return Ql.action_distribution(business(spark, sf))


@register("manual_review_rate", query(f"SELECT model, {r('avg(manual_review_required::INT)')} AS manual_review_rate FROM business GROUP BY model", "business"))
def manual_review_rate(spark, sf):
    return Ql.manual_review_rate(business(spark, sf))


@register("quality_rule_summary", query(f"""SELECT m.model, (SELECT string_agg(k || ':' || n, '; ' ORDER BY k) FROM (SELECT quality_grade AS k, count(*) AS n FROM business b WHERE b.model = m.model GROUP BY 1)) AS grade_distribution,
    (SELECT string_agg(k || ':' || n, '; ' ORDER BY k) FROM (SELECT recommended_action AS k, count(*) AS n FROM business b WHERE b.model = m.model GROUP BY 1)) AS action_distribution,
    (SELECT {r('avg(manual_review_required::INT)')} FROM business b WHERE b.model = m.model) AS manual_review_rate FROM (SELECT DISTINCT model FROM business) m""", "business"))
def quality_rule_summary(spark, sf):
    b = business(spark, sf)
    return Ql.quality_rule_summary(Ql.grade_distribution(b), Ql.action_distribution(b), Ql.manual_review_rate(b))


@register("entity_union_distinct", query("SELECT model FROM preds UNION SELECT coalesce(model_name, 'none') FROM feedback UNION SELECT event_type FROM events", "preds", "feedback"))
def entity_union_distinct(spark, sf):
    named = star.feedback(spark, sf).select(F.coalesce("model_name", F.lit("none")).alias("model"))
    return Ql.entity_union_distinct("model", preds(spark, sf), named, star.events(spark, sf).select(F.col("event_type").alias("model")))


# --- monitoring ----------------------------------------------------------------------------------

view(
    "verdicts",
    f"""SELECT {DAY.format(c='t')} AS day, coalesce(pc, 'unknown') AS predicted_class, coalesce(mn, 'unknown') AS model_name, coalesce(accepted, false) AS accepted,
        NOT coalesce(accepted, false) AND (coalesce(NOT accepted, false) OR co IS NOT NULL OR og IS NOT NULL) AS overridden,
        CASE WHEN accepted THEN true WHEN co IS NOT NULL AND pc IS NOT NULL THEN co = pc WHEN NOT accepted AND pc IS NOT NULL THEN false END AS class_ok,
        CASE WHEN accepted THEN true WHEN og IS NOT NULL AND pg IS NOT NULL THEN og = pg WHEN NOT accepted AND pg IS NOT NULL THEN false END AS grade_ok,
        confidence, coalesce(manual_review_required, false) AS manual_review FROM
        (SELECT f.accepted, coalesce(nullif(f.created_at, ''), nullif(b.created_at, '')) AS t, coalesce(nullif(f.predicted_class, ''), b.predicted_class) AS pc,
          coalesce(nullif(f.predicted_grade, ''), b.quality_grade) AS pg, coalesce(nullif(f.model_name, ''), b.model) AS mn,
          coalesce(nullif(f.corrected_class, ''), nullif(f.producer_override_class, '')) AS co, nullif(f.producer_override_grade, '') AS og, b.confidence, b.manual_review_required
         FROM feedback f LEFT JOIN business b ON b.prediction_id = f.prediction_id)""",
    "feedback", "business",
)


def counters_sql(level: str, key: str, keep: str) -> str:
    ratio = lambda a, b: f"CASE WHEN {b} <> 0 THEN {r(f'{a} / {b}', 4)} END"
    return f"""SELECT '{level}' AS level, key, n AS feedback_count, a AS accepted_count, o AS override_count, cl AS class_labelled_count, cc AS class_correct_count, cw AS class_override_count,
        gl AS grade_labelled_count, gc AS grade_correct_count, hc AS high_confidence_override_count, mr AS manual_review_feedback_count,
        {ratio('cc', 'cl')} AS class_accuracy_proxy, {ratio('gc', 'gl')} AS grade_accuracy_proxy, {ratio('a', 'n')} AS acceptance_rate, {ratio('o', 'n')} AS override_rate
        FROM (SELECT {key} AS key, count(*) AS n, count(*) FILTER (accepted) AS a, count(*) FILTER (overridden) AS o, count(class_ok) AS cl, count(*) FILTER (class_ok) AS cc,
          count(*) FILTER (NOT class_ok) AS cw, count(grade_ok) AS gl, count(*) FILTER (grade_ok) AS gc, count(*) FILTER (NOT class_ok AND confidence >= 0.9) AS hc, count(*) FILTER (manual_review) AS mr
          FROM verdicts GROUP BY 1) WHERE {keep}"""


MONITORING = " UNION ALL ".join([
    counters_sql("total", "'all'", "true"), counters_sql("day", "day", "true"),
    counters_sql("predicted_class", "predicted_class", "cl > 0"), counters_sql("model", "model_name", "cl > 0"),
])


def prediction_log(spark, sf) -> DataFrame:
    return business(spark, sf).withColumn("model_name", F.col("model")).withColumn("seq", F.col("event_id"))


@register("feedback_monitoring", query(MONITORING, "verdicts"))
def feedback_monitoring(spark, sf):
    return Mo.feedback_metrics(star.feedback(spark, sf), prediction_log(spark, sf))


@register("prediction_feedback", query("SELECT f.seq, f.prediction_id, b.predicted_class AS logged_class, b.quality_grade AS logged_grade, b.confidence FROM feedback f LEFT JOIN business b ON b.prediction_id = f.prediction_id", "feedback", "business"))
def prediction_feedback(spark, sf):
    j = Mo.prediction_feedback(star.feedback(spark, sf), prediction_log(spark, sf))
    return j.select("seq", "prediction_id", F.col("logged.predicted_class").alias("logged_class"), F.col("logged.quality_grade").alias("logged_grade"), F.col("logged.confidence").alias("confidence"))


# --- sinks ---------------------------------------------------------------------------------------


@register("report_sinks", query("SELECT format, report.* FROM report, (VALUES ('csv'), ('json'), ('parquet')) f(format)", "report"))
def report_sinks(spark, sf):
    """Writes the report as CSV, JSON and Parquet and reads all three back whole."""
    path = fresh_path(spark, "report")
    report = cut(P.classification_report(preds(spark, sf), ["model"]))
    back = []
    for fmt in ("csv", "json", "parquet"):
        Rp.write_report(report, f"{path}/{fmt}", fmt, ["model", "class_name"])
        options = Rp.CSV if fmt == "csv" else {}
        back.append(spark.read.schema(report.schema).options(**options).format(fmt).load(f"{path}/{fmt}").withColumn("format", F.lit(fmt)))
    return back[0].unionByName(back[1]).unionByName(back[2])


@register("experiment_summary_pack", query("""SELECT 'model_comparison_summary' AS file, count(*) AS rows FROM totals UNION ALL
    SELECT 'weak_class_summary', count(*) FROM (SELECT 1 FROM report WHERE class_name LIKE '%\\_\\_%' ESCAPE '\\' QUALIFY row_number() OVER (PARTITION BY model ORDER BY f1_score, class_name) <= 5)
    UNION ALL SELECT 'grade_distribution', count(*) FROM (SELECT DISTINCT model, quality_grade FROM business) UNION ALL SELECT 'action_distribution', count(*) FROM (SELECT DISTINCT model, recommended_action FROM business)
    UNION ALL SELECT 'manual_review_rate', count(DISTINCT model) FROM business UNION ALL SELECT 'quality_rule_summary', count(DISTINCT model) FROM business
    UNION ALL SELECT 'external_image_validation', count(*) FROM validation
    UNION ALL SELECT 'risky_case_examples', count(*) FROM validation WHERE coalesce(NOT full_class_correct, false) OR confidence < 0.6 OR coalesce(top1_top2_margin < 0.15, false) OR manual_review_required""", "totals", "report", "business", "validation"))
def experiment_summary_pack(spark, sf):
    return Rp.evaluation_pack(spark, business(spark, sf), validation(spark, sf), fresh_path(spark, "pack"))
