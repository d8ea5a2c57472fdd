"""Recommender, fairness, demand and evaluation queries with their oracles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.functions.numbers import clamp01, ratio, recency_decay, round6
from marketloom.functions.reasons import REORDER_DEFAULT, REORDER_WORDING, joined, reason_text
from marketloom.functions.seasons import seasonal_flag
from marketloom.operators import baskets as B
from marketloom.operators import demand as M
from marketloom.operators import discovery as D
from marketloom.operators import fairness as X
from marketloom.operators import lines as L
from marketloom.operators import reorder as R
from marketloom.operators.ranking import share_in_group, top_k
from marketloom.plans import evaluation as E
from marketloom.plans import serving as S
from marketloom.sources import retail_star as star
from marketloom.sources import tables as T

from . import sql as Q
from .sql import query, r

QUERIES, ORACLE = {}, {}


def register(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLE[name] = oracle
        return fn

    return add


def tables(spark: SparkSession, sf: str) -> T.Tables:
    return star.market_tables(spark, sf)


def lines(spark: SparkSession, sf: str) -> DataFrame:
    return L.order_lines(tables(spark, sf))


def targets(spark: SparkSession, sf: str) -> DataFrame:
    """All customers and as many ids without any order."""
    strangers = star.events(spark, sf).select((F.col("user_id") + 1000000).alias("customer_id")).distinct()
    return tables(spark, sf).customers.select("customer_id").unionByName(strangers)


# --- tables --------------------------------------------------------------------------------------


@register("load_tables", query("""
    SELECT 'customers' AS table_name, count(*) AS n FROM m_customers UNION ALL SELECT 'producers', count(*) FROM m_producers
    UNION ALL SELECT 'products', count(*) FROM m_products UNION ALL SELECT 'orders', count(*) FROM m_orders
    UNION ALL SELECT 'order_items', count(*) FROM m_items""", "m_customers", "m_producers", "m_products", "m_orders", "m_items"))
def load_tables(spark, sf):
    """Writes the tables as CSV to the shared folder and loads them back with checks and casts."""
    from marketloom.session import fresh_path

    path = fresh_path(spark, "tables")
    source = tables(spark, sf)
    for name in T.REQUIRED_COLUMNS:
        getattr(source, name).write.option("header", True).csv(f"{path}/{name}.csv")
    loaded, _ = T.load_tables(spark, path)
    counted = [getattr(loaded, n).agg(F.count("*").alias("n")).select(F.lit(n).alias("table_name"), "n") for n in T.REQUIRED_COLUMNS]
    return E._union(counted)


@register("privacy_guard", query("SELECT customer_type, count(*) AS n FROM m_customers GROUP BY customer_type", "m_customers"))
def privacy_guard(spark, sf):
    return T.privacy_guard(tables(spark, sf).customers).groupBy("customer_type").agg(F.count("*").alias("n"))


def _raw_orders(spark, sf):
    o = tables(spark, sf).orders
    bad = F.col("order_id") % 13 == 0
    return o.select(
        "order_id", "customer_id", F.when(bad, F.lit("not a date")).otherwise(F.col("order_date").cast("string")).alias("order_date"),
        F.when(F.col("order_id") % 7 == 0, F.lit("n/a")).otherwise(F.col("total_amount").cast("string")).alias("total_amount"),
    )


@register("coerce_and_quarantine", query("""
    SELECT CASE WHEN order_id % 13 = 0 THEN 'invalid order_date' ELSE 'valid' END AS outcome, count(*) AS n,
    count(CASE WHEN order_id % 13 <> 0 AND order_id % 7 <> 0 THEN 1 END) AS amounts FROM m_orders GROUP BY 1""", "m_orders"))
def coerce_and_quarantine(spark, sf):
    valid, rejected = T.coerce_and_quarantine("orders", _raw_orders(spark, sf))
    good = valid.select(F.lit("valid").alias("outcome"), F.col("total_amount").cast("double").alias("a"))
    bad = rejected.select(F.col("reject_reason").alias("outcome"), F.lit(None).cast("double").alias("a"))
    return good.unionByName(bad).groupBy("outcome").agg(F.count("*").alias("n"), F.count("a").alias("amounts"))


@register("dataset_summary", query("""
    SELECT (SELECT count(DISTINCT customer_id) FROM m_customers) AS customers, (SELECT count(DISTINCT producer_id) FROM m_producers) AS producers,
    (SELECT count(DISTINCT product_id) FROM m_products) AS products, count(DISTINCT order_id) AS orders,
    (SELECT count(*) FROM lines) AS order_lines, min(order_date) AS start_date, max(order_date) AS end_date FROM m_orders""",
    "m_customers", "m_producers", "m_products", "m_orders", "lines"))
def dataset_summary(spark, sf):
    return L.dataset_summary(tables(spark, sf))


@register("order_lines", query(f"""SELECT order_id, customer_id, order_date, customer_type, product_id, quantity, {r('unit_price')} AS unit_price,
    product_name, category, producer_id, producer_name FROM lines""", "lines"))
def order_lines(spark, sf):
    return lines(spark, sf).select(
        "order_id", "customer_id", "order_date", "customer_type", "product_id", "quantity", round6(F.col("unit_price")).alias("unit_price"),
        "product_name", "category", "producer_id", "producer_name",
    )


@register("available_products", query("SELECT product_id, availability_status FROM m_products WHERE availability_status <> 'unavailable'", "m_products"))
def available_products(spark, sf):
    return L.available_products(tables(spark, sf).products).select("product_id", "availability_status")


@register("seasonal_flag", query(
    f"SELECT product_id, m::INTEGER AS month, {Q.season('m', 'seasonal_start_month', 'seasonal_end_month')} AS seasonal FROM m_products, generate_series(1, 12) g(m)", "m_products"))
def seasonal(spark, sf):
    months = F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month")
    p = tables(spark, sf).products.select("product_id", "seasonal_start_month", "seasonal_end_month", months)
    return p.select("product_id", "month", seasonal_flag(F.col("month"), F.col("seasonal_start_month"), F.col("seasonal_end_month")).alias("seasonal"))


# --- aggregates ----------------------------------------------------------------------------------


@register("customer_product_stats", query("SELECT * FROM stats", "stats"))
def customer_product_stats(spark, sf):
    return L.customer_product_stats(lines(spark, sf))


@register("product_popularity", query(f"SELECT product_id, quantity, {r('popularity')} AS popularity FROM popularity", "popularity"))
def product_popularity(spark, sf):
    return L.product_popularity(lines(spark, sf)).withColumn("popularity", round6(F.col("popularity")))


@register("segment_popularity", query(f"SELECT customer_type, product_id, quantity, {r('popularity')} AS popularity FROM segments", "segments"))
def segment_popularity(spark, sf):
    return L.segment_popularity(lines(spark, sf)).withColumn("popularity", round6(F.col("popularity")))


@register("category_affinity", query(f"SELECT customer_type, category, quantity, {r('affinity')} AS affinity FROM affinity", "affinity"))
def category_affinity(spark, sf):
    return L.category_affinity(lines(spark, sf)).withColumn("affinity", round6(F.col("affinity")))


@register("normalise_to_max", query(f"SELECT customer_id, product_id, {r('quantity / max(quantity) OVER (PARTITION BY customer_id)')} AS share FROM stats", "stats"))
def normalise_to_max(spark, sf):
    from pyspark.sql import Window

    stats = L.customer_product_stats(lines(spark, sf))
    top = F.max("quantity").over(Window.partitionBy("customer_id"))
    return stats.select("customer_id", "product_id", round6(ratio(F.col("quantity"), top)).alias("share"))


@register("recency_decay", query("SELECT order_id, round_even(exp(-(greatest(0, date_diff('day', order_date, (SELECT d FROM as_of)))::DOUBLE) / 30.0::DOUBLE) * 1e6, 0) / 1e6 AS recency FROM m_orders", "m_orders", "as_of"))
def recency(spark, sf):
    as_of = L.next_day(lines(spark, sf))
    return tables(spark, sf).orders.select("order_id", round6(recency_decay(as_of, F.col("order_date"))).alias("recency"))


@register("clamp01", "SELECT vec_id, list_aggregate(list_transform(embedding, lambda v: least(1.0::DOUBLE, greatest(0.0::DOUBLE, v::DOUBLE * 5))), 'max') AS top FROM embeddings")
def clamp(spark, sf):
    e = star.read(spark, sf, "embeddings")
    return e.select("vec_id", F.array_max(F.transform("embedding", lambda v: clamp01(v.cast("double") * 5))).alias("top"))


@register("round6", f"SELECT l_orderkey, {r('sum(l_extendedprice * (1 - l_discount) / 7.0::DOUBLE)')} AS value FROM lineitem GROUP BY l_orderkey")
def rounding(spark, sf):
    rows = star.read(spark, sf, "lineitem")
    return rows.groupBy("l_orderkey").agg(round6(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")) / 7.0)).alias("value"))


# --- reorder -------------------------------------------------------------------------------------

REC = "customer_id, customer_type, method, rank, product_id, product_name, producer_id, score, reason_codes"


def _reorder_oracle(method: str) -> str:
    text = Q.reason_text("reason_codes", Q.REORDER_TEXT, "Recommended by the quick-reorder scoring method.")
    body = Q.reorder_sql(method, "lines", "targets", "scored_fr", 3)
    return query(f"SELECT {REC}, {text} AS reason_text FROM ({body})", "lines", "targets", "m_products", "scored_fr")


def _reorder(method):
    return lambda spark, sf: R.flat_export(R.reorder(lines(spark, sf), tables(spark, sf).products, method, 3, targets(spark, sf)))


for _m in R.REORDER_METHODS:
    QUERIES[f"reorder_{_m}"] = _reorder(_m)
    ORACLE[f"reorder_{_m}"] = _reorder_oracle(_m)


@register("recommend_dispatch", " UNION ALL BY NAME ".join(f"SELECT * FROM ({_reorder_oracle(m)})" for m in R.REORDER_METHODS))
def recommend_dispatch(spark, sf):
    """Every method by its name."""
    lists = [_reorder(m)(spark, sf) for m in R.REORDER_METHODS]
    return reduce(lambda a, b: a.unionByName(b), lists)


@register("top_k_popular", query(Q.popular_list("lines", 10), "lines", "m_products"))
def top_k_popular(spark, sf):
    return R.top_k_popular(lines(spark, sf), tables(spark, sf).products, 10)


@register("top_k_per_customer", query("""SELECT customer_id, product_id, quantity,
    (row_number() OVER (PARTITION BY customer_id ORDER BY quantity DESC, product_id))::INTEGER AS rank FROM stats QUALIFY rank <= 3""", "stats"))
def top_k_per_customer(spark, sf):
    stats = L.customer_product_stats(lines(spark, sf)).drop("last_order_date")
    return top_k(stats, ["customer_id"], [F.desc("quantity"), F.asc("product_id")], 3)


@register("rank_top_k", query("""SELECT category, product_id, base_price,
    (row_number() OVER (PARTITION BY category ORDER BY base_price DESC, product_id))::INTEGER AS rank FROM m_products QUALIFY rank <= 5""", "m_products"))
def rank_top_k(spark, sf):
    p = tables(spark, sf).products.select("category", "product_id", "base_price")
    return top_k(p, ["category"], [F.desc("base_price"), F.asc("product_id")], 5)


@register("cold_start_cross", query(f"SELECT {REC} FROM ({Q.reorder_sql('user_frequency', 'lines', 'targets', 'scored_fr', 3)}) WHERE reason_codes LIKE '%cold_start%'", "lines", "targets", "m_products"))
def cold_start(spark, sf):
    li = lines(spark, sf)
    cold = R.customers_without_history(targets(spark, sf), li)
    recs = R.popular_for(cold, li, tables(spark, sf).products, 3, R.USER_FREQUENCY, cold=True)
    return recs.withColumn("reason_codes", joined(F.col("reason_codes")))


@register("reason_codes", query("SELECT customer_id, product_id, reason_codes FROM scored_fr", "scored_fr"))
def reason_codes_query(spark, sf):
    li = lines(spark, sf)
    scored = R.score_frequency_recency(li, li, tables(spark, sf).products, L.next_day(li))
    return scored.select("customer_id", "product_id", joined(F.col("reason_codes")).alias("reason_codes"))


@register("reason_text", query(f"SELECT customer_id, product_id, {Q.reason_text('reason_codes', Q.REORDER_TEXT, 'Recommended by the quick-reorder scoring method.')} AS reason_text FROM scored_fr", "scored_fr"))
def reason_text_query(spark, sf):
    li = lines(spark, sf)
    scored = R.score_frequency_recency(li, li, tables(spark, sf).products, L.next_day(li))
    return scored.select("customer_id", "product_id", reason_text(F.col("reason_codes"), REORDER_WORDING, REORDER_DEFAULT).alias("reason_text"))


# --- baskets and discovery -----------------------------------------------------------------------


@register("basket_pairs", query("SELECT * FROM edges", "edges"))
def basket_pairs(spark, sf):
    return B.basket_pairs(lines(spark, sf))


@register("history_x_cooccurrence", query("""SELECT h.customer_id, e.product_b AS product_id, sum(e.n)::BIGINT AS raw
    FROM history h JOIN edges e ON e.product_a = h.product_id GROUP BY ALL""", "history", "edges"))
def history_x_cooccurrence(spark, sf):
    li = lines(spark, sf)
    return B.history_x_cooccurrence(D.purchase_pairs(li), B.basket_pairs(li))


DISC = "customer_id, customer_type, method, rank, product_id, product_name, producer_id"
DISC_NUMBERS = ", ".join(f"{r(c)} AS {c}" for c in ("score", "cooccurrence", "seasonality", "segment_popularity", "diversity_adjustment"))


def _discovery_oracle(method: str) -> str:
    text = Q.reason_text("reason_codes", Q.DISCOVERY_TEXT, "Recommended by the discovery scoring method.")
    based = Q.based_on("full") if method.startswith("co_") else "''"
    based = f"CASE WHEN method = 'co_occurrence_discovery' THEN {based} ELSE '' END" if method.startswith("co_") else based
    chosen = Q.greedy("full", Q.candidates_sql("full", method, 3), 3)
    return query(f"WITH {chosen} SELECT {DISC}, {DISC_NUMBERS}, {based} AS based_on, reason_codes, {text} AS reason_text FROM chosen", *Q.needs("full"), recursive=True)


def _discovery(method):
    return lambda spark, sf: D.flat_export(D.discover(lines(spark, sf), tables(spark, sf).products, method, 3, targets(spark, sf)))


for _n, _m in {
    "discovery_cooccurrence": D.COOCCURRENCE,
    "discovery_segment_popularity": D.SEGMENT_POPULARITY,
    "discovery_global_popularity": D.GLOBAL_POPULARITY,
}.items():
    QUERIES[_n] = _discovery(_m)
    ORACLE[_n] = _discovery_oracle(_m)


CHAIN_SIZE = 60


def _chain_oracle() -> str:
    """Customers short of a large k go through both fallbacks."""
    chosen = Q.greedy("full", Q.candidates_sql("full", D.COOCCURRENCE, CHAIN_SIZE), 3)
    return query(f"WITH {chosen} SELECT {DISC}, {r('score')} AS score, reason_codes FROM chosen", *Q.needs("full"), recursive=True)


@register("discovery_fallback_chain", _chain_oracle())
def fallback_chain(spark, sf):
    basis = D.Basis(lines(spark, sf), tables(spark, sf).products)
    typed = D._typed_targets(targets(spark, sf), basis)
    scored = D._as_cooccurrence_rows(D.cooccurrence_shortlist(typed, basis, CHAIN_SIZE), basis.products)
    filled = D.discovery_fallback_chain(scored, typed, basis, CHAIN_SIZE)
    chosen = D.diversity_rerank(filled, 3)
    return chosen.select(*DISC.split(", "), round6(F.col("score")).alias("score"), joined(F.col("reason_codes")).alias("reason_codes"))


@register("diversity_rerank", query(f"""WITH {Q.greedy('x', '''SELECT customer_id, customer_type, 'frequency_recency' AS method, product_id, product_name, producer_id, score,
    0.0::DOUBLE AS cooccurrence, 0.0::DOUBLE AS seasonality, 0.0::DOUBLE AS segment_popularity, reason_codes FROM scored_fr''', 5)}
    SELECT {DISC}, {r('score')} AS score, reason_codes FROM chosen""", "scored_fr", recursive=True))
def diversity_rerank(spark, sf):
    li = lines(spark, sf)
    scored = R.score_frequency_recency(li, li, tables(spark, sf).products, L.next_day(li))
    rows = scored.withColumn("method", F.lit(R.FREQUENCY_RECENCY)).withColumn("diversity_adjustment", F.lit(0.0))
    chosen = D.diversity_rerank(rows, 5)
    return chosen.select(*DISC.split(", "), round6(F.col("score")).alias("score"), joined(F.col("reason_codes")).alias("reason_codes"))


def _hybrid_oracle() -> str:
    first = Q.reorder_sql("frequency_recency", "lines", "targets", "scored_live", 3).replace("m_products", "available")
    chosen = Q.greedy("live", Q.candidates_sql("live", D.COOCCURRENCE, 3), 3)
    return query(f"""WITH scored_live AS (SELECT * FROM scored_fr WHERE product_id IN (SELECT product_id FROM available)), {chosen},
        both_lists AS (SELECT customer_id, customer_type, 'quick_reorder' AS section, method, rank, product_id, product_name, producer_id, score, reason_codes FROM ({first})
        UNION ALL SELECT customer_id, customer_type, 'you_may_also_like', method, rank, product_id, product_name, producer_id, {r('score')}, reason_codes FROM chosen)
        SELECT b.customer_id, coalesce(b.customer_type, c.customer_type) AS customer_type, section, method, rank, product_id, product_name, producer_id, score,
        reason_codes, (SELECT d FROM as_of) AS recommendation_date FROM both_lists b LEFT JOIN m_customers c USING (customer_id)""",
        "scored_fr", "available", "m_customers", "as_of", "lines", "targets", *Q.needs("live"), recursive=True)


@register("hybrid_recommendations", _hybrid_oracle())
def hybrid(spark, sf):
    recs = S.hybrid_recommendations(tables(spark, sf), targets(spark, sf), 3)
    return recs.withColumn("score", round6(F.col("score"))).withColumn("reason_codes", joined(F.col("reason_codes")))


# --- fairness ------------------------------------------------------------------------------------

FAIR_LISTS = "SELECT customer_id, product_id, producer_id, score, rank, reason_codes FROM (SELECT *, (row_number() OVER (PARTITION BY customer_id ORDER BY score DESC, product_id))::INTEGER AS rank FROM scored_fr) WHERE rank <= 12"


def fair_sql(lists: str, k: int, group: str = "") -> str:
    g = f"{group}, " if group else ""
    return f"""SELECT {g}customer_id, alpha, CASE WHEN alpha = 0 THEN rank ELSE place END AS rank, product_id, producer_id,
        CASE WHEN alpha = 0 THEN score ELSE {r('least(1.0, greatest(0.0, adjusted))')} END AS score,
        CASE WHEN alpha = 0 THEN reason_codes ELSE reason_codes || '|producer_fair_reranking_applied' END AS reason_codes
        FROM (SELECT *, (row_number() OVER (PARTITION BY {g}customer_id, alpha ORDER BY CASE WHEN alpha = 0 THEN rank END,
              CASE WHEN alpha <> 0 THEN {r('adjusted')} END DESC, CASE WHEN alpha <> 0 THEN score END DESC, product_id))::INTEGER AS place
              FROM (SELECT *, score - alpha * share AS adjusted FROM
                (SELECT *, count(*) OVER (PARTITION BY {g}customer_id, producer_id) / count(*) OVER (PARTITION BY {g}customer_id) AS share FROM ({lists})),
                (SELECT unnest([0.0, 0.05, 0.1, 0.15, 0.2, 0.3]::DOUBLE[]) AS alpha))) WHERE place <= {k}"""


@register("fair_rerank", query(fair_sql(FAIR_LISTS, 3), "scored_fr"))
def fair_rerank(spark, sf):
    recs = R.reorder(lines(spark, sf), tables(spark, sf).products, R.FREQUENCY_RECENCY, 12)
    fair = X.fair_rerank(recs.select("customer_id", "rank", "product_id", "producer_id", "score", "reason_codes"), X.ALPHAS, 3)
    return fair.withColumn("reason_codes", joined(F.col("reason_codes")))


EXPOSURE = f"""SELECT customer_type, producer_id, n AS recommendation_count, {r('n / sum(n) OVER (PARTITION BY customer_type)')} AS recommendation_share
    FROM (SELECT customer_type, producer_id, count(*) AS n FROM ({FAIR_LISTS.replace('customer_id, product_id', 'customer_type, customer_id, product_id', 1)}) GROUP BY ALL)"""


@register("exposure_share", query(EXPOSURE, "scored_fr"))
def exposure_share(spark, sf):
    recs = R.reorder(lines(spark, sf), tables(spark, sf).products, R.FREQUENCY_RECENCY, 12)
    return X.exposure_share(recs, ["customer_type"]).withColumn("recommendation_share", round6(F.col("recommendation_share")))


@register("share_in_group", query(f"""SELECT customer_type, category, n, {r('n / sum(n) OVER (PARTITION BY customer_type)')} AS share
    FROM (SELECT customer_type, category, count(*) AS n FROM lines GROUP BY ALL)""", "lines"))
def share_query(spark, sf):
    counts = lines(spark, sf).groupBy("customer_type", "category").agg(F.count("*").alias("n"))
    return share_in_group(counts, ["customer_type"], "n", "share").withColumn("share", round6(F.col("share")))


# --- demand --------------------------------------------------------------------------------------

Q.view("weekly", "SELECT producer_id, product_id, product_name, date_trunc('week', order_date)::DATE AS week_start, sum(quantity) AS quantity_ordered FROM lines WHERE producer_id IS NOT NULL GROUP BY ALL", "lines")
Q.view("averages", f"SELECT *, {r('avg(quantity_ordered) OVER w', 4)} AS moving_average_3w FROM weekly WINDOW w AS (PARTITION BY producer_id, product_id ORDER BY week_start, product_name ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)", "weekly")
Q.view("trend", """SELECT * EXCLUDE (before), CASE WHEN moving_average_3w > before THEN 'up' WHEN moving_average_3w < before THEN 'down' ELSE 'stable' END AS trend_direction
    FROM (SELECT *, lag(moving_average_3w) OVER (PARTITION BY producer_id, product_id ORDER BY week_start, product_name) AS before FROM averages)""", "averages")
Q.view("forecast", f"""SELECT producer_id, product_id, product_name, week_start + 7 AS forecast_week_start, {r('moving_average_3w', 2)} AS predicted_quantity_next_week,
    'latest_3_week_moving_average' AS basis, trend_direction FROM trend QUALIFY row_number() OVER (PARTITION BY producer_id, product_id ORDER BY week_start DESC, product_name) = 1""", "trend")


@register("demand_trend", query("SELECT * FROM trend", "trend"))
def demand_trend(spark, sf):
    return M.demand_trend(lines(spark, sf))


@register("demand_forecast", query("SELECT * FROM forecast", "forecast"))
def demand_forecast(spark, sf):
    return M.demand_forecast(M.demand_trend(lines(spark, sf)))


@register("producer_forecast_lookup", query("""SELECT *, CASE trend_direction WHEN 'up' THEN 'High demand expected' WHEN 'down' THEN 'Lower demand expected' ELSE 'Stable demand expected' END
    || ' for ' || product_name || ' next week based on recent order trends.' AS alert_text, 'known' AS outcome FROM
    (SELECT *, (row_number() OVER (PARTITION BY producer_id ORDER BY predicted_quantity_next_week DESC, product_id))::INTEGER AS rank FROM forecast
     WHERE producer_id IN (SELECT user_id FROM events) AND producer_id IN (SELECT producer_id FROM m_producers)) WHERE rank <= 5
    UNION ALL SELECT user_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'unknown producer' FROM (SELECT DISTINCT user_id FROM events WHERE user_id NOT IN (SELECT producer_id FROM m_producers))""", "forecast", "m_producers"))
def producer_forecast_lookup(spark, sf):
    requested = star.events(spark, sf).select(F.col("user_id").alias("producer_id"))
    found, unknown = M.producer_forecast_lookup(M.demand_forecast(M.demand_trend(lines(spark, sf))), requested, tables(spark, sf).producers, 5)
    return found.withColumn("outcome", F.lit("known")).unionByName(unknown.withColumn("outcome", F.lit("unknown producer")), allowMissingColumns=True)


# --- evaluation ----------------------------------------------------------------------------------


@register("temporal_split", query("""SELECT part, count(DISTINCT order_id) AS orders, count(*) AS n, min(order_date) AS first_date, max(order_date) AS last_date, min(order_id) AS low, max(order_id) AS high
    FROM (SELECT 'train' AS part, * FROM train UNION ALL SELECT 'test', * FROM test) GROUP BY part""", "train", "test"))
def temporal_split(spark, sf):
    train, test = E.temporal_split(lines(spark, sf))
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.groupBy("part").agg(
        F.countDistinct("order_id").alias("orders"), F.count("*").alias("n"), F.min("order_date").alias("first_date"),
        F.max("order_date").alias("last_date"), F.min("order_id").alias("low"), F.max("order_id").alias("high"),
    )


@register("future_unseen", query("SELECT customer_id, product_id FROM unseen", "unseen"))
def future_unseen(spark, sf):
    train, test = E.temporal_split(lines(spark, sf))
    return E.future_unseen(test, D.purchase_pairs(train))


REORDER_RUNS = " UNION ALL ".join(
    f"SELECT {REC} FROM ({Q.reorder_sql(m, 'train', 'actual_targets', 'scored_fr_train', 3)})" for m in R.REORDER_METHODS
)
Q.view("reorder_runs", REORDER_RUNS, "train", "actual_targets", "m_products", "scored_fr_train")


def metrics_sql(recs: str, actual: str, group: str, k: int = 3) -> str:
    g = group
    customers = f"(SELECT count(DISTINCT customer_id) FROM {actual})"
    return f"""SELECT {g}, {r(f'coalesce(h.p, 0.0) / {customers}')} AS precision_at_k, {r(f'coalesce(h.rc, 0.0) / {customers}')} AS recall_at_k,
        {r(f'coalesce(h.n, 0) / {customers}')} AS hit_rate_at_k, u.up AS unique_products, u.us AS unique_producers,
        (SELECT count(DISTINCT product_id) FROM m_products) AS total_products, (SELECT count(DISTINCT producer_id) FROM m_producers) AS total_producers,
        {r('u.up / (SELECT count(DISTINCT product_id) FROM m_products)')} AS product_coverage,
        {r('u.us / (SELECT count(DISTINCT producer_id) FROM m_producers)')} AS producer_diversity,
        {r('s.largest')} AS largest_producer_recommendation_share, {r('s.mean')} AS mean_producer_exposure_share, {customers} AS evaluated_customers
        FROM (SELECT {g}, count(DISTINCT product_id) AS up, count(DISTINCT producer_id) AS us FROM {recs} GROUP BY ALL) u
        LEFT JOIN (SELECT {g}, max(sh) AS largest, avg(sh) AS mean FROM (SELECT {g}, n / sum(n) OVER (PARTITION BY {g}) AS sh
                   FROM (SELECT {g}, producer_id, count(*) AS n FROM {recs} GROUP BY ALL)) GROUP BY ALL) s USING ({g})
        LEFT JOIN (SELECT {g}, sum(hits / {k}::DOUBLE) AS p, sum(hits / a) AS rc, count(*) AS n FROM
                   (SELECT {g}, x.customer_id, count(*) AS hits FROM (SELECT DISTINCT {g}, customer_id, product_id FROM {recs}) x
                    JOIN {actual} t ON t.customer_id = x.customer_id AND t.product_id = x.product_id GROUP BY ALL)
                   JOIN (SELECT customer_id, count(*) AS a FROM {actual} GROUP BY ALL) USING (customer_id) GROUP BY ALL) h USING ({g})"""


EVAL_REORDER = f"""SELECT m.*, coalesce(c.n, 0) AS cold_start_fallback_count FROM ({metrics_sql('reorder_runs', 'actual', 'method')}) m
    LEFT JOIN (SELECT method, count(DISTINCT customer_id) AS n FROM reorder_runs WHERE reason_codes LIKE '%cold_start_fallback%' GROUP BY ALL) c USING (method)"""


@register("evaluate_reorder", query(EVAL_REORDER, "reorder_runs", "actual", "m_products", "m_producers"))
def evaluate_reorder(spark, sf):
    return E.evaluate_reorder(tables(spark, sf)).metrics


@register("recommendation_examples", query(f"SELECT {REC} FROM reorder_runs", "reorder_runs"))
def recommendation_examples(spark, sf):
    return E.evaluate_reorder(tables(spark, sf)).recommendations.withColumn("reason_codes", joined(F.col("reason_codes")))


@register("coverage_diversity", query(f"""SELECT method, unique_products AS unique_recommended_products, total_products, product_coverage,
    unique_producers AS unique_recommended_producers, total_producers, producer_diversity FROM ({metrics_sql('reorder_runs', 'actual', 'method')})""", "reorder_runs", "actual", "m_products", "m_producers"))
def coverage_diversity(spark, sf):
    coverage, diversity = E.coverage_tables(E.evaluate_reorder(tables(spark, sf)))
    return coverage.join(diversity, "method")


@register("hits_join", query("""SELECT customer_id, count(*) AS hits, count(*) / 3.0::DOUBLE AS precision, count(*) / any_value(a) AS recall FROM
    (SELECT customer_id, product_id FROM reorder_runs WHERE method = 'user_frequency') JOIN actual USING (customer_id, product_id)
    JOIN (SELECT customer_id, count(*) AS a FROM actual GROUP BY ALL) USING (customer_id) GROUP BY customer_id""".replace("count(*) / 3.0::DOUBLE", r("count(*) / 3.0::DOUBLE")).replace("count(*) / any_value(a)", r("count(*) / any_value(a)")), "reorder_runs", "actual"))
def hits_join(spark, sf):
    s = E.prepare(tables(spark, sf))
    recs = R.reorder(s.train, s.tables.products, R.USER_FREQUENCY, 3, s.customers, s.as_of)
    hits = E.score_lists(recs, s.test_products, ["method"], 3).drop("method")
    return hits.withColumn("precision", round6(F.col("precision"))).withColumn("recall", round6(F.col("recall")))


@register("novelty", query(f"""SELECT method, customer_id, {r('avg(CASE WHEN h.product_id IS NULL THEN 1.0 ELSE 0.0 END)')} AS novelty FROM
    (SELECT DISTINCT method, customer_id, product_id FROM reorder_runs) x LEFT JOIN train_history h USING (customer_id, product_id) GROUP BY ALL""", "reorder_runs", "train_history"))
def novelty(spark, sf):
    s = E.prepare(tables(spark, sf))
    recs = E._union([R.reorder(s.train, s.tables.products, m, 3, s.customers, s.as_of) for m in R.REORDER_METHODS])
    return E.novelty(recs, s.basis.history, ["method"]).withColumn("novelty", round6(F.col("novelty")))


def _eval_discovery_oracle() -> str:
    runs = []
    for i, m in enumerate(D.DISCOVERY_METHODS):
        part = Q.greedy("tr", Q.candidates_sql("tr", m, 3), 3)
        for name in ("cand", "walk", "chosen"):
            import re

            part = re.sub(rf"\b{name}\b", f"{name}{i}", part)
        runs.append((part, f"SELECT '{m}' AS method_run, * FROM chosen{i}"))
    recs = " UNION ALL ".join(x for _, x in runs)
    return query(f"""WITH {', '.join(x for x, _ in runs)}, runs AS MATERIALIZED ({recs}),
        m AS ({metrics_sql('runs', 'unseen', 'method_run')})
        SELECT m.* EXCLUDE (method_run, evaluated_customers), m.method_run AS method, m.evaluated_customers AS eligible_customer_count,
        {r('n.nov / m.evaluated_customers')} AS novelty_rate, coalesce(f.n, 0) AS fallback_count FROM m
        LEFT JOIN (SELECT method_run, sum(v) AS nov FROM (SELECT method_run, customer_id, avg(CASE WHEN h.product_id IS NULL THEN 1.0 ELSE 0.0 END) AS v FROM
             (SELECT DISTINCT method_run, customer_id, product_id FROM runs) x LEFT JOIN train_history h USING (customer_id, product_id) GROUP BY ALL) GROUP BY ALL) n USING (method_run)
        LEFT JOIN (SELECT method_run, count(DISTINCT customer_id) AS n FROM runs WHERE reason_codes LIKE '%cold_start_discovery_fallback%' OR reason_codes LIKE '%insufficient_new%' GROUP BY ALL) f USING (method_run)""",
        "unseen", "train_history", "m_products", "m_producers", *Q.needs("tr"), recursive=True)


@register("evaluate_discovery", _eval_discovery_oracle())
def evaluate_discovery(spark, sf):
    return E.evaluate_discovery(tables(spark, sf)).metrics


def _alpha_views() -> str:
    chosen = Q.greedy("tr", Q.candidates_sql("tr", D.COOCCURRENCE, 12), 12)
    first = Q.reorder_sql("frequency_recency", "train", "actual_targets", "scored_fr_train", 12)
    lists = f"""SELECT 'quick_reorder' AS branch, customer_id, rank, product_id, producer_id, score, reason_codes FROM ({first})
        UNION ALL SELECT 'discovery', customer_id, rank, product_id, producer_id, {r('score')}, reason_codes FROM chosen"""
    return f"""WITH {chosen}, fair AS MATERIALIZED ({fair_sql(lists, 3, 'branch')}),
        fair_r AS (SELECT * FROM fair WHERE branch = 'quick_reorder'), fair_d AS (SELECT * FROM fair WHERE branch = 'discovery'),
        study0 AS (SELECT 'quick_reorder' AS branch, * FROM ({metrics_sql('fair_r', 'actual', 'alpha')})
                   UNION ALL SELECT 'discovery', * FROM ({metrics_sql('fair_d', 'unseen', 'alpha')})),
        study AS (SELECT s.*, {r('s.hit_rate_at_k - b.hit_rate_at_k')} AS recommendation_quality_delta FROM study0 s JOIN (SELECT * FROM study0 WHERE alpha = 0) b ON b.branch = s.branch)"""


ALPHA_NEEDS = ["unseen", "actual", "actual_targets", "train", "scored_fr_train", "m_products", "m_producers", *Q.needs("tr")]


@register("fairness_alpha_study", query(f"{_alpha_views()} SELECT * FROM study", *ALPHA_NEEDS, recursive=True))
def fairness_alpha_study(spark, sf):
    return E.alpha_study(tables(spark, sf))[0]


@register("select_alpha", query(f"""{_alpha_views()} SELECT * FROM (SELECT s.* FROM study s JOIN (SELECT branch, largest_producer_recommendation_share AS base FROM study WHERE alpha = 0) b USING (branch)
    WHERE alpha = 0 OR (s.largest_producer_recommendation_share < base AND recommendation_quality_delta >= -0.03)) QUALIFY row_number() OVER (PARTITION BY branch ORDER BY alpha = 0, alpha) = 1""", *ALPHA_NEEDS, recursive=True))
def select_alpha(spark, sf):
    return X.select_alpha(E.alpha_study(tables(spark, sf))[0])
