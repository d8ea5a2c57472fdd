"""Event-log, catalogue, order and streaming queries with their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.functions.numbers import round6
from marketloom.operators import catalog as Ca
from marketloom.operators import monitoring as Mo
from marketloom.operators import orders as O
from marketloom.operators.ranking import ranked
from marketloom.session import fresh_path
from marketloom.sources import logs
from marketloom.sources import retail_star as star
from marketloom.streaming import jobs as J

from .classify import DAY, counters_sql, prediction_log
from .sql import K, query, r, view

QUERIES, ORACLE = {}, {}


def register(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLE[name] = oracle
        return fn

    return add


def tables(spark: SparkSession, sf: str):
    return star.market_tables(spark, sf)


# --- catalogue views -----------------------------------------------------------------------------

HOUR = "strftime(ts, '%Y-%m-%dT%H:00:00') || CASE WHEN event_id % 3 = 0 THEN '' ELSE '.' || (event_id % 9 + 1) || '00000' END"
view(
    "pe",
    f"""SELECT event_id AS seq, CASE WHEN event_id % 13 = 0 AND event_id % 4 = 0 THEN 'producer_removed' ELSE 'producer_upserted' END AS event_type, user_id AS producer_id,
        CASE WHEN event_id % 13 = 0 AND event_id % 4 = 1 THEN '  ' ELSE ' Farm ' || event_id || ' ' END AS producer_name,
        CASE WHEN event_id % 13 = 0 AND event_id % 4 = 2 THEN '' ELSE 'AREA' || (user_id % 9) END AS postcode_area,
        event_id % 2 = 0 AS organic_certified, event_id % 3 AS third,
        CASE WHEN event_id % 13 = 0 AND event_id % 4 = 3 THEN 'not a time' ELSE {HOUR} END AS created_at, 'feed' AS source FROM events WHERE event_type = 'view'""",
)
view(
    "pe_checked",
    """SELECT *, CASE WHEN event_type <> 'producer_upserted' THEN 'wrong event_type' WHEN try_cast(created_at AS TIMESTAMP) IS NULL THEN 'invalid created_at'
        WHEN trim(producer_name) = '' OR trim(postcode_area) = '' OR trim(source) = '' OR producer_id IS NULL THEN 'empty required field' END AS reject_reason FROM pe""",
    "pe",
)
view("pe_valid", "SELECT * REPLACE (trim(producer_name) AS producer_name) FROM pe_checked WHERE reject_reason IS NULL", "pe_checked")
view("pe_latest", "SELECT * FROM pe_valid QUALIFY row_number() OVER (PARTITION BY producer_id ORDER BY created_at DESC, seq DESC) = 1", "pe_valid")
view(
    "producers_now",
    """SELECT producer_id, producer_name, postcode_area, NULL::VARCHAR AS catalog_event_source, NULL::VARCHAR AS catalog_event_created_at FROM m_producers
        WHERE producer_id NOT IN (SELECT producer_id FROM pe_latest) UNION ALL SELECT producer_id, producer_name, postcode_area, source, created_at FROM pe_latest""",
    "m_producers", "pe_latest",
)
view(
    "qe",
    f"""SELECT event_id AS seq, CASE WHEN event_id % 13 = 0 AND event_id % 5 = 0 THEN 'product_removed' ELSE 'product_upserted' END AS event_type, user_id * 20 AS product_id, user_id % 120 AS producer_id,
        ' item ' || (user_id % 50) AS product_name, 'Brand#' || (user_id % 25 + 1) AS category, 'kg' AS unit,
        CASE WHEN event_id % 13 = 0 AND event_id % 5 = 1 THEN -1.0::DOUBLE ELSE value END AS price, event_id % 3 = 0 AS seasonal,
        CASE WHEN event_id % 13 = 0 AND event_id % 5 = 2 THEN 13 WHEN event_id % 3 = 0 THEN {K} % 12 + 1 END AS s, CASE WHEN event_id % 3 = 0 THEN ({K} * 5) % 12 + 1 END AS e,
        event_id % 6 <> 0 AS available, CASE WHEN event_id % 13 = 0 AND event_id % 5 = 3 THEN 'not a time' ELSE {HOUR} END AS created_at, 'feed' AS source FROM events WHERE event_type = 'click'""",
)
view(
    "qe_checked",
    """SELECT *, CASE WHEN event_type <> 'product_upserted' THEN 'wrong event_type' WHEN seasonal AND (s NOT BETWEEN 1 AND 12 OR e NOT BETWEEN 1 AND 12) THEN 'months outside 1..12'
        WHEN try_cast(created_at AS TIMESTAMP) IS NULL THEN 'invalid created_at' WHEN price < 0 THEN 'invalid price'
        WHEN producer_id NOT IN (SELECT producer_id FROM producers_now) THEN 'unknown producer_id' END AS reject_reason FROM qe""",
    "qe", "producers_now",
)
view(
    "qe_valid",
    """SELECT seq, event_type, product_id, producer_id, trim(product_name) AS product_name, category, unit, price, seasonal, CASE WHEN seasonal THEN s ELSE 1 END::INTEGER AS seasonal_start_month,
        CASE WHEN seasonal THEN e ELSE 12 END::INTEGER AS seasonal_end_month, available, created_at, source FROM qe_checked WHERE reject_reason IS NULL""",
    "qe_checked",
)
view("qe_latest", "SELECT * FROM qe_valid QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY created_at DESC, seq DESC) = 1", "qe_valid")
view(
    "products_now",
    """SELECT product_id, product_name, category, producer_id, seasonal_start_month, seasonal_end_month, base_price, availability_status, NULL::VARCHAR AS description, NULL::VARCHAR AS unit,
        NULL::VARCHAR AS allergen_info, NULL::DOUBLE AS stock_quantity, NULL::VARCHAR AS catalog_event_source, NULL::VARCHAR AS catalog_event_created_at FROM m_products WHERE product_id NOT IN (SELECT product_id FROM qe_latest)
        UNION ALL SELECT product_id, product_name, category, producer_id, seasonal_start_month, seasonal_end_month, price, CASE WHEN available THEN 'available' ELSE 'unavailable' END, '', unit, '', NULL, source, created_at FROM qe_latest""",
    "m_products", "qe_latest",
)


@register("producer_event_normalise", query("""SELECT seq, producer_id, producer_name, postcode_area, 'fruit|c' || third AS categories, organic_certified, created_at, reject_reason FROM pe_valid
    UNION ALL SELECT seq, producer_id, NULL, NULL, NULL, NULL, NULL, reject_reason FROM pe_checked WHERE reject_reason IS NOT NULL""", "pe_valid", "pe_checked"))
def producer_event_normalise(spark, sf):
    valid, rejected = Ca.normalise_producer_events(star.producer_events(spark, sf))
    kept = valid.select("seq", "producer_id", "producer_name", "postcode_area", F.array_join("categories", "|").alias("categories"), "organic_certified", "created_at")
    return kept.unionByName(rejected.select("seq", "producer_id", "reject_reason"), allowMissingColumns=True)


@register("product_event_normalise", query("""SELECT seq, product_id, product_name, seasonal_start_month, seasonal_end_month, price, NULL::VARCHAR AS reject_reason FROM qe_valid
    UNION ALL SELECT seq, product_id, NULL, NULL, NULL, NULL, reject_reason FROM qe_checked WHERE reject_reason IS NOT NULL""", "qe_valid", "qe_checked"))
def product_event_normalise(spark, sf):
    now = Ca.apply_producer_events(tables(spark, sf), Ca.normalise_producer_events(star.producer_events(spark, sf))[0])
    valid, rejected = Ca.normalise_product_events(star.product_events(spark, sf), now.producers)
    kept = valid.select("seq", "product_id", "product_name", "seasonal_start_month", "seasonal_end_month", "price")
    return kept.unionByName(rejected.select("seq", "product_id", "reject_reason"), allowMissingColumns=True)


@register("event_latest_upsert", query("SELECT producer_id, seq, producer_name, created_at FROM pe_latest", "pe_latest"))
def event_latest_upsert(spark, sf):
    valid, _ = Ca.normalise_producer_events(star.producer_events(spark, sf))
    return Ca.latest_by_key(valid, "producer_id").select("producer_id", "seq", "producer_name", "created_at")


@register("apply_producer_events", query("SELECT * FROM producers_now", "producers_now"))
def apply_producer_events(spark, sf):
    return Ca.apply_producer_events(tables(spark, sf), Ca.normalise_producer_events(star.producer_events(spark, sf))[0]).producers


def _catalog(spark, sf):
    return Ca.apply_catalog_events(tables(spark, sf), star.producer_events(spark, sf), star.product_events(spark, sf))


PRODUCT_COLUMNS = (
    "product_id, product_name, category, producer_id, seasonal_start_month, seasonal_end_month, base_price, availability_status, description, unit, allergen_info, stock_quantity, catalog_event_source, catalog_event_created_at"
)


@register("apply_product_events", query(f"SELECT {PRODUCT_COLUMNS} FROM products_now", "products_now"))
def apply_product_events(spark, sf):
    base = Ca.apply_producer_events(tables(spark, sf), Ca.normalise_producer_events(star.producer_events(spark, sf))[0])
    valid, _ = Ca.normalise_product_events(star.product_events(spark, sf), base.producers)
    return Ca.apply_product_events(base, valid).products.select(*PRODUCT_COLUMNS.split(", "))


@register("apply_catalog_events", query("SELECT p.product_id, p.product_name, p.producer_id, s.producer_name, s.postcode_area, p.availability_status FROM products_now p LEFT JOIN producers_now s USING (producer_id)", "products_now", "producers_now"))
def apply_catalog_events(spark, sf):
    now = _catalog(spark, sf)
    joined = now.products.select("product_id", "product_name", "producer_id", "availability_status").join(
        now.producers.select("producer_id", "producer_name", "postcode_area"), "producer_id", "left"
    )
    return joined.select("product_id", "product_name", "producer_id", "producer_name", "postcode_area", "availability_status")


@register("catalog_anti_union", query("SELECT availability_status, count(*) AS n, count(catalog_event_source) AS from_events FROM products_now GROUP BY 1", "products_now"))
def catalog_anti_union(spark, sf):
    return _catalog(spark, sf).products.groupBy("availability_status").agg(F.count("*").alias("n"), F.count("catalog_event_source").alias("from_events"))


@register("union_by_name", query("SELECT postcode_area, count(*) AS n, count(catalog_event_source) AS from_events FROM producers_now GROUP BY 1", "producers_now"))
def union_by_name(spark, sf):
    return _catalog(spark, sf).producers.groupBy("postcode_area").agg(F.count("*").alias("n"), F.count("catalog_event_source").alias("from_events"))


# --- orders --------------------------------------------------------------------------------------

view(
    "oe",
    f"""SELECT *, {K} AS k, CASE WHEN event_id % 13 = 0 THEN event_id % 7 END AS f FROM events WHERE event_type = 'purchase'""",
)
view(
    "oe_rows",
    """SELECT event_id AS seq, CASE WHEN f = 1 THEN NULL WHEN event_id % 17 = 0 THEN event_id % 1000 ELSE 10000000 + event_id // 3 END::BIGINT AS order_id,
        CASE WHEN f = 2 THEN NULL WHEN event_id % 5 = 0 THEN 1000000 + user_id ELSE user_id END::BIGINT AS customer_id, CASE WHEN event_id % 10 = 0 THEN 'NEWCOMER' END AS customer_type,
        CASE WHEN event_id % 20 = 0 THEN 'AREA0' END AS postcode_area, CASE WHEN f = 3 THEN 'not a date' ELSE strftime(ts, '%Y-%m-%d') END AS order_date,
        CASE WHEN event_id % 4 = 0 THEN value * 3 END AS given, f, k, value, CASE WHEN f = 4 THEN 0 WHEN event_id % 2 = 0 THEN 2 ELSE 3 END AS n_items,
        CASE WHEN event_id % 3 = 0 THEN 'app' ELSE 'order_event' END AS source, ts FROM oe""",
    "oe",
)
view(
    "oe_items",
    """SELECT seq, order_id, i AS pos, CASE WHEN f = 0 AND i = 0 THEN -5 ELSE (seq * 31 + i * 17) % 200 END::BIGINT AS product_id,
        CASE WHEN f = 6 AND i = 0 THEN 0.0 ELSE k % 5 + 1 + i END::DOUBLE AS quantity, value + i AS unit_price FROM oe_rows, generate_series(0, 2) g(i) WHERE i < n_items""",
    "oe_rows",
)


def order_reason(known_orders: str) -> str:
    return f"""CASE WHEN order_id IS NULL THEN 'missing order_id' WHEN order_id IN ({known_orders}) THEN 'duplicate order_id' WHEN customer_id IS NULL THEN 'missing customer_id'
        WHEN n_items = 0 THEN 'no items' WHEN customer_id NOT IN (SELECT customer_id FROM m_customers) AND customer_type IS NULL THEN 'unknown customer without type'
        WHEN seq IN (SELECT seq FROM oe_items WHERE product_id NOT IN (SELECT product_id FROM m_products)) THEN 'unknown product_id'
        WHEN try_cast(order_date AS TIMESTAMP) IS NULL THEN 'invalid order_date'
        WHEN seq IN (SELECT seq FROM oe_items WHERE NOT (quantity > 0 AND unit_price >= 0)) THEN 'invalid item' END"""


view("oe_first", f"SELECT *, {order_reason('SELECT order_id FROM m_orders')} AS reason FROM oe_rows", "oe_rows", "oe_items", "m_orders", "m_customers", "m_products")
view(
    "oe_checked",
    """SELECT * EXCLUDE (reason), CASE WHEN reason = 'missing order_id' THEN reason WHEN seq > (SELECT min(seq) FROM oe_first x WHERE x.reason IS NULL AND x.order_id = oe_first.order_id) THEN 'duplicate order_id' ELSE reason END AS reject_reason FROM oe_first""",
    "oe_first",
)
view(
    "oe_valid",
    f"""SELECT o.seq, o.order_id, o.customer_id, o.customer_type, o.postcode_area, o.order_date::DATE AS order_date,
        coalesce(o.given, {r('(SELECT sum(quantity * unit_price) FROM oe_items i WHERE i.seq = o.seq)', 2)}) AS total_amount, o.n_items, o.source, o.ts FROM oe_checked o WHERE reject_reason IS NULL""",
    "oe_checked", "oe_items",
)


def _orders(spark, sf):
    return O.validate_order_events(tables(spark, sf), star.order_events(spark, sf))


@register("order_event_validate", query("SELECT seq, order_id, coalesce(reject_reason, 'accepted') AS outcome FROM oe_checked", "oe_checked"))
def order_event_validate(spark, sf):
    valid, rejected = _orders(spark, sf)
    return valid.select("seq", "order_id", F.lit("accepted").alias("outcome")).unionByName(rejected.select("seq", "order_id", F.col("reject_reason").alias("outcome")))


@register("known_id_checks", query("SELECT coalesce(reject_reason, 'accepted') AS outcome, count(*) AS n FROM oe_checked GROUP BY 1", "oe_checked"))
def known_id_checks(spark, sf):
    return order_event_validate(spark, sf).groupBy("outcome").agg(F.count("*").alias("n"))


@register("order_event_normalise", query(f"SELECT seq, order_id, customer_id, customer_type, order_date, {r('total_amount')} AS total_amount, n_items::INTEGER AS n_items, source FROM oe_valid", "oe_valid"))
def order_event_normalise(spark, sf):
    valid, _ = _orders(spark, sf)
    return valid.select("seq", "order_id", "customer_id", "customer_type", "order_date", round6(F.col("total_amount")).alias("total_amount"), F.size("items").alias("n_items"), "source")


@register("order_total", query(f"SELECT o.seq, coalesce(any_value(o.given), {r('sum(coalesce(i.quantity * i.unit_price, 0.0::DOUBLE))', 2)}) AS total FROM oe_rows o LEFT JOIN oe_items i USING (seq) GROUP BY o.seq", "oe_rows", "oe_items"))
def order_total(spark, sf):
    return star.order_events(spark, sf).select("seq", O.order_total(F.col("total_amount"), F.col("items")).alias("total"))


view("oe_new", """SELECT customer_id, coalesce(arg_min(coalesce(customer_type, ''), seq), '') AS ct, arg_min(coalesce(postcode_area, ''), seq) AS pa FROM oe_valid
    WHERE customer_id NOT IN (SELECT customer_id FROM m_customers) GROUP BY customer_id""", "oe_valid", "m_customers")


@register("apply_order_events", query(f"""SELECT 'customers' AS table_name, (SELECT count(*) FROM m_customers) + (SELECT count(*) FROM oe_new) AS n,
    (SELECT count(*) FROM oe_new WHERE coalesce(nullif(pa, ''), 'unknown') = 'unknown')::DOUBLE AS total
    UNION ALL SELECT 'orders', (SELECT count(*) FROM m_orders) + count(*), {r('(SELECT sum(total_amount) FROM m_orders) + sum(total_amount)', 2)} FROM oe_valid
    UNION ALL SELECT 'order_items', (SELECT count(*) FROM m_items) + count(*), (SELECT sum(quantity) FROM m_items) + sum(quantity) FROM oe_items WHERE seq IN (SELECT seq FROM oe_valid)""",
    "m_customers", "m_orders", "m_items", "oe_valid", "oe_items", "oe_new"))
def apply_order_events(spark, sf):
    valid, _ = _orders(spark, sf)
    now = O.apply_order_events(tables(spark, sf), valid)
    from marketloom.functions.numbers import flag, round_to

    counts = now.customers.agg(F.count("*").alias("n"), F.sum(flag(F.col("postcode_area") == "unknown")).cast("double").alias("total")).withColumn("table_name", F.lit("customers"))
    orders = now.orders.agg(F.count("*").alias("n"), round_to(F.sum("total_amount"), 2).alias("total")).withColumn("table_name", F.lit("orders"))
    items = now.order_items.agg(F.count("*").alias("n"), F.sum("quantity").alias("total")).withColumn("table_name", F.lit("order_items"))
    return counts.unionByName(orders).unionByName(items)


@register("ingest_receipt", query("""SELECT count(DISTINCT order_id) AS total_orders, (SELECT count(*) FROM (SELECT order_id FROM m_items UNION ALL SELECT order_id FROM oe_items WHERE seq IN (SELECT seq FROM oe_valid)) i
    JOIN (SELECT order_id FROM m_orders UNION ALL SELECT order_id FROM oe_valid) o USING (order_id)) AS total_order_lines FROM (SELECT order_id FROM m_orders UNION ALL SELECT order_id FROM oe_valid)""", "m_orders", "m_items", "oe_valid", "oe_items"))
def ingest_receipt(spark, sf):
    valid, _ = _orders(spark, sf)
    return O.ingest_receipt(O.apply_order_events(tables(spark, sf), valid))


@register("order_receipts", query("""SELECT seq, 'ingested' AS status, order_id, customer_id, n_items::BIGINT AS ingested_order_lines, row_number() OVER (ORDER BY seq) AS orders_so_far,
    sum(n_items) OVER (ORDER BY seq)::BIGINT AS lines_so_far FROM oe_valid""", "oe_valid"))
def order_receipts(spark, sf):
    return O.order_receipts(_orders(spark, sf)[0])


@register("catalog_receipts", query("""SELECT seq, 'ingested' AS status, producer_id, (SELECT count(DISTINCT producer_id) FROM m_producers) + sum(fresh) OVER (ORDER BY seq)::BIGINT AS catalog_so_far
    FROM (SELECT seq, producer_id, (row_number() OVER (PARTITION BY producer_id ORDER BY seq) = 1 AND producer_id NOT IN (SELECT producer_id FROM m_producers))::BIGINT AS fresh FROM pe_valid)""", "pe_valid", "m_producers"))
def catalog_receipts(spark, sf):
    valid = Ca.normalise_producer_events(star.producer_events(spark, sf))[0]
    return Ca.catalog_receipts(tables(spark, sf).producers, valid, "producer_id")


# --- history -------------------------------------------------------------------------------------

view(
    "hb",
    """SELECT event_id AS seq, CASE WHEN event_id % 9 = 0 THEN 2000000 + user_id ELSE user_id END AS customer_id, CASE WHEN event_id % 18 = 0 THEN 'BACKFILL' END AS customer_type FROM events WHERE event_type = 'signup'""",
)
view(
    "ho",
    f"""SELECT event_id AS seq, i AS pos, CASE WHEN event_id % 19 = 0 AND i = 1 THEN event_id % 1000 WHEN event_id % 4 = 0 THEN 30000000 + event_id % 50 + i ELSE 20000000 + event_id * 2 + i * (event_id % 23 <> 0)::INT END::BIGINT AS order_id,
        CASE WHEN event_id % 29 = 0 AND i = 0 THEN 'soon' ELSE strftime(ts, '%Y-%m-%d') END AS order_date, CASE WHEN event_id % 2 = 0 THEN value END AS given,
        CASE WHEN event_id % 31 = 0 AND i = 1 THEN -7 ELSE (event_id * 13 + i) % 200 END::BIGINT AS product_id, ({K} % 4 + 1)::DOUBLE AS quantity FROM events, generate_series(0, 1) g(i) WHERE event_type = 'signup'""",
)
view(
    "ho_checked",
    """SELECT o.*, b.customer_id, b.customer_type, CASE WHEN o.order_id IN (SELECT order_id FROM m_orders) THEN 'duplicate order_id'
        WHEN b.customer_id NOT IN (SELECT customer_id FROM m_customers) AND b.customer_type IS NULL THEN 'unknown customer without type'
        WHEN o.product_id NOT IN (SELECT product_id FROM m_products) THEN 'unknown product_id' WHEN try_cast(o.order_date AS TIMESTAMP) IS NULL THEN 'invalid order_date' END AS reason
        FROM ho o JOIN hb b USING (seq)""",
    "ho", "hb", "m_orders", "m_customers", "m_products",
)
view(
    "hb_own",
    """SELECT seq, coalesce(arg_min(reason, pos) FILTER (reason IS NOT NULL), CASE WHEN count(DISTINCT order_id) < count(*) THEN 'duplicate order_id' END) AS reject_reason FROM ho_checked GROUP BY seq""",
    "ho_checked",
)
# One batch after another: a batch is accepted if none of its orders came with an accepted one before.
view(
    "hb_checked",
    """WITH RECURSIVE cand AS (SELECT seq, row_number() OVER (ORDER BY seq) AS rn, list(order_id) AS ids FROM ho_checked WHERE seq IN (SELECT seq FROM hb_own WHERE reject_reason IS NULL) GROUP BY seq),
        walk AS (SELECT 0::BIGINT AS rn, NULL::BIGINT AS seq, true AS ok, []::BIGINT[] AS taken UNION ALL
            SELECT c.rn, c.seq, NOT list_has_any(w.taken, c.ids), CASE WHEN list_has_any(w.taken, c.ids) THEN w.taken ELSE list_concat(w.taken, c.ids) END FROM walk w JOIN cand c ON c.rn = w.rn + 1)
        SELECT o.seq, coalesce(o.reject_reason, CASE WHEN NOT w.ok THEN 'duplicate order_id' END) AS reject_reason FROM hb_own o LEFT JOIN walk w ON w.seq = o.seq""",
    "ho_checked", "hb_own",
)
view("ho_valid", "SELECT * FROM ho_checked WHERE seq IN (SELECT seq FROM hb_checked WHERE reject_reason IS NULL)", "ho_checked", "hb_checked")


def _history(spark, sf):
    return O.validate_history(tables(spark, sf), star.history_batches(spark, sf))


@register("history_event_validate", query("SELECT seq, coalesce(reject_reason, 'accepted') AS outcome FROM hb_checked", "hb_checked"))
def history_event_validate(spark, sf):
    valid, rejected = _history(spark, sf)
    return valid.select("seq", F.lit("accepted").alias("outcome")).unionByName(rejected.select("seq", F.col("reject_reason").alias("outcome")))


@register("history_flatten", query("SELECT seq AS batch, pos::INTEGER AS pos, order_id, customer_id, order_date, product_id, 'history_backfill' AS source FROM ho JOIN hb USING (seq)", "ho", "hb"))
def history_flatten(spark, sf):
    flat = O.flatten_history(star.history_batches(spark, sf))
    return flat.select(F.col("seq.batch").alias("batch"), F.col("seq.at").alias("pos"), "order_id", "customer_id", "order_date", F.get("items", F.lit(0))["product_id"].alias("product_id"), "source")


@register("apply_history_events", query(f"""SELECT order_date::DATE AS order_date, count(*) AS orders, {r('sum(coalesce(given, quantity * 2.5::DOUBLE))', 2)} AS total, sum(quantity) AS quantity, count(*) FILTER (customer_type = 'BACKFILL') AS newcomers
    FROM ho_valid GROUP BY 1""", "ho_valid"))
def apply_history_events(spark, sf):
    from marketloom.functions.numbers import flag, round_to

    base = tables(spark, sf)
    valid, _ = _history(spark, sf)
    now = O.apply_history_events(base, valid)
    # The new rows are the ones whose order the base does not hold.
    orders = now.orders.join(base.orders.select("order_id"), "order_id", "left_anti").join(now.customers.select("customer_id", "customer_type"), "customer_id")
    items = now.order_items.groupBy("order_id").agg(F.sum("quantity").alias("quantity"))
    return orders.join(items, "order_id").groupBy("order_date").agg(
        F.count("*").alias("orders"), round_to(F.sum("total_amount"), 2).alias("total"), F.sum("quantity").alias("quantity"),
        F.sum(flag(F.col("customer_type") == "BACKFILL")).alias("newcomers"),
    )


@register("history_receipts", query("""SELECT seq, 'ingested' AS status, customer_id, 2 AS ingested_orders, 2::BIGINT AS ingested_order_lines, row_number() OVER (ORDER BY seq) AS batches_so_far,
    2 * row_number() OVER (ORDER BY seq) AS lines_so_far FROM hb JOIN (SELECT seq FROM hb_checked WHERE reject_reason IS NULL) v USING (seq)""", "hb", "hb_checked"))
def history_receipts(spark, sf):
    return O.history_receipts(_history(spark, sf)[0]).drop("history_batch_id")


# --- logs and streams ----------------------------------------------------------------------------


def _write_log(spark, df: DataFrame, label: str, files: int = 4) -> str:
    """Derived events as a JSON-lines log of a few files."""
    path = fresh_path(spark, f"log-{label}")
    df.repartition(files).write.json(path)
    return path


APPENDS = 3


def _append(spark, valid: DataFrame, path: str, which: int) -> None:
    """One of APPENDS appends of the events, which are cut by position."""
    last = valid.agg(F.max("seq")).first()[0] or 0
    at = F.col("seq") * APPENDS
    logs.append_log(valid.filter((at > last * which if which else F.lit(True)) & (at <= last * (which + 1))), None, path)


LOG_COLUMNS = "event_type, producer_id, producer_name, created_at, source"


@register("event_log_source", query(f"SELECT row_number() OVER (ORDER BY seq) AS place, {LOG_COLUMNS} FROM pe", "pe"))
def event_log_source(spark, sf):
    """A log of three appends, read back: every event, placed by its position in the log."""
    path, events = fresh_path(spark, "log-producers"), star.producer_events(spark, sf)
    for which in range(APPENDS):
        _append(spark, events, path, which)
    log = logs.read_log(spark, path, "producer", ids="bigint")
    return ranked(log, [], [F.col("seq")]).select(F.col("rank").alias("place"), *LOG_COLUMNS.split(", "))


@register("event_log_sink", query(f"""SELECT coalesce(reject_reason, 'accepted') AS outcome, {LOG_COLUMNS.replace('producer_name', "CASE WHEN reject_reason IS NULL THEN trim(producer_name) ELSE producer_name END AS producer_name")}
    FROM pe_checked""", "pe_checked"))
def event_log_sink(spark, sf):
    """Appends valid events to a log and the others to a quarantine, and reads both back with their types."""
    path, held = fresh_path(spark, "sink"), fresh_path(spark, "quarantine")
    valid, rejected = Ca.normalise_producer_events(star.producer_events(spark, sf))
    logs.append_log(valid, rejected, path, held)
    columns = LOG_COLUMNS.split(", ")
    good = logs.read_log(spark, path, "producer", ids="bigint").select(F.lit("accepted").alias("outcome"), *columns)
    bad = spark.read.schema(logs.log_schema("producer", "bigint") + ", reject_reason string").json(held)
    return good.unionByName(bad.select(F.col("reject_reason").alias("outcome"), *columns))


@register("event_latest_upsert_stream", query("SELECT producer_id, producer_name, created_at FROM pe_latest", "pe_latest"))
def event_latest_upsert_stream(spark, sf):
    """The latest event per producer as a stream's keyed state: two appends in many micro-batches, a stop, a restart after the third."""
    path, checkpoint = fresh_path(spark, "log-latest"), J.checkpoint_for(spark, "latest")
    valid = Ca.normalise_producer_events(star.producer_events(spark, sf))[0]
    for which in range(APPENDS):
        _append(spark, valid, path, which)
        if which:
            J.keep_latest(logs.stream_log(spark, path, "producer", files_per_batch=5, ids="bigint"), "producer_id", checkpoint)
    return J.latest_state(spark, checkpoint).select("producer_id", "producer_name", "created_at")


ORDER_STREAM = "order_id bigint, customer_id bigint, order_date string, items array<struct<product_id:bigint,quantity:double,unit_price:double>>, event_ts timestamp"


def _order_stream(spark, sf) -> DataFrame:
    """Accepted orders as a stream in which every fourth event is delivered twice."""
    accepted = _orders(spark, sf)[0].select("seq", "order_id", "customer_id", F.col("order_date").cast("string").alias("order_date"), "items")
    timed = accepted.join(star.events(spark, sf).select(F.col("event_id").alias("seq"), F.col("ts").alias("event_ts")), "seq")
    twice = timed.unionByName(timed.filter("seq % 4 = 0")).drop("seq")
    path = _write_log(spark, twice, "orders")
    return spark.readStream.schema(ORDER_STREAM).option("maxFilesPerTrigger", 2).json(path)


LINES = "product_id bigint, order_id bigint, customer_id bigint, order_date date, event_ts timestamp, quantity double, unit_price double, product_name string, category string, producer_id bigint, week_start date"


def _order_lines_taken(spark, sf) -> str:
    """The folder of the order lines of a stream of many micro-batches, whose log is far longer than the delay."""
    path = fresh_path(spark, "lines")
    J.take_order_lines(_order_stream(spark, sf), tables(spark, sf).products, path, delay="5 days")
    return path


@register("stream_order_lines", query("""SELECT i.order_id, i.product_id, i.quantity, p.product_name, p.producer_id FROM oe_items i JOIN oe_valid o USING (seq) LEFT JOIN m_products p ON p.product_id = i.product_id""", "oe_items", "oe_valid", "m_products"))
def stream_order_lines(spark, sf):
    lines = J.order_lines(spark, _order_lines_taken(spark, sf), LINES)
    return lines.select("order_id", "product_id", "quantity", "product_name", "producer_id")


@register("stream_weekly_demand", query("""SELECT date_trunc('week', o.ts)::DATE AS week_start, p.producer_id, i.product_id, p.product_name, sum(i.quantity) AS quantity_ordered
    FROM oe_items i JOIN oe_valid o USING (seq) JOIN m_products p ON p.product_id = i.product_id GROUP BY ALL""", "oe_items", "oe_valid", "m_products"))
def stream_weekly_demand(spark, sf):
    return J.take_weekly_demand(spark, _order_lines_taken(spark, sf), LINES)


DAILY = counters_sql("day", "strftime(ts, '%Y-%m-%d')", "true").replace("FROM verdicts", "FROM daily_verdicts")
view(
    "daily_verdicts",
    """SELECT f.ts, coalesce(f.accepted, false) AS accepted, NOT coalesce(f.accepted, false) AND (coalesce(NOT f.accepted, false) OR co IS NOT NULL OR og IS NOT NULL) AS overridden,
        CASE WHEN f.accepted THEN true WHEN co IS NOT NULL AND pc IS NOT NULL THEN co = pc WHEN NOT f.accepted AND pc IS NOT NULL THEN false END AS class_ok,
        CASE WHEN f.accepted THEN true WHEN og IS NOT NULL AND pg IS NOT NULL THEN og = pg WHEN NOT f.accepted AND pg IS NOT NULL THEN false END AS grade_ok,
        confidence, coalesce(manual_review_required, false) AS manual_review FROM
        (SELECT f.accepted, f.ts, coalesce(nullif(f.predicted_class, ''), b.predicted_class) AS pc, coalesce(nullif(f.predicted_grade, ''), b.quality_grade) AS pg,
         coalesce(nullif(f.corrected_class, ''), nullif(f.producer_override_class, '')) AS co, nullif(f.producer_override_grade, '') AS og, b.confidence, b.manual_review_required
         FROM feedback f LEFT JOIN business b ON b.prediction_id = f.prediction_id) f""",
    "feedback", "business",
)


@register("stream_feedback_daily", query(f"SELECT * EXCLUDE (level, key), key AS day FROM ({DAILY})", "daily_verdicts"))
def stream_feedback_daily(spark, sf):
    """Both logs as streams of several files and micro-batches, in two runs: the first takes all feedback and half of the predictions."""
    said, told = star.feedback(spark, sf).drop("seq", "created_at", "model_name"), prediction_log(spark, sf).select("seq", "prediction_id", *Mo.LOGGED)
    path, half = fresh_path(spark, "daily"), F.col("seq") % 2 == 0
    logs_at = _write_log(spark, said, "said"), _write_log(spark, told.filter(half), "told")
    source = lambda at, df: spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2).json(at)
    streams = source(logs_at[0], said), source(logs_at[1], told)
    J.take_feedback(*streams, path, ["seq"])
    told.filter(~half).write.mode("append").json(logs_at[1])
    return J.take_feedback(*streams, path, ["seq"])
