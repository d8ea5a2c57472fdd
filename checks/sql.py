"""Shared SQL views for the oracle queries (DuckDB), written independently of the Spark jobs."""

from __future__ import annotations


def r(expr: str, places: int = 6) -> str:
    """Half-even rounding in binary arithmetic."""
    scale = f"1e{places}"
    return f"(round_even(CAST({expr} AS DOUBLE) * {scale}, 0) / {scale})"


def season(month: str, start: str, end: str) -> str:
    return (
        f"(CASE WHEN CASE WHEN {start} <= {end} THEN {month} BETWEEN {start} AND {end}"
        f" ELSE {month} >= {start} OR {month} <= {end} END THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)"
    )


PRODUCE = (
    "['Apple','Banana','Tomato','Potato','Bellpepper','Carrot','Cucumber',"
    "'Grape','Guava','Jujube','Mango','Orange','Strawberry','Dragonfruit']"
)


def produce(index: str) -> str:
    return f"{PRODUCE}[({index}) % 14 + 1]"


K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"


def status(c: str) -> str:
    return f"(CASE WHEN instr({c}, '__') > 0 THEN lower(substr({c}, instr({c}, '__') + 2)) ELSE 'unknown' END)"


def produce_of(c: str) -> str:
    return f"(CASE WHEN instr({c}, '__') > 0 THEN substr({c}, 1, instr({c}, '__') - 1) ELSE {c} END)"


def condition(c: str) -> str:
    return (
        f"(CASE WHEN lower({c}) LIKE '%\\_\\_healthy' ESCAPE '\\' THEN 'healthy'"
        f" WHEN lower({c}) LIKE '%\\_\\_rotten' ESCAPE '\\' THEN 'rotten' ELSE 'unknown' END)"
    )


def codes(*pairs: tuple[str, str | None]) -> str:
    """Bar-joined codes whose condition holds, in order, first occurrence only."""
    items = ", ".join(f"CASE WHEN {c} THEN '{n}' END" if c else f"'{n}'" for n, c in pairs)
    return distinct_join(f"[{items}]")


def distinct_join(items: str) -> str:
    return (
        f"coalesce(array_to_string(list_transform(list_filter(list_transform({items}, lambda x, i: "
        f"CASE WHEN x IS NOT NULL AND list_position({items}, x) = i THEN x END), lambda x: x IS NOT NULL), lambda x: x), '|'), '')"
    )


VIEWS: dict[str, tuple[list[str], str]] = {}


def view(name: str, sql: str, *needs: str) -> None:
    VIEWS[name] = (list(needs), sql)


def query(body: str, *needs: str, recursive: bool = False) -> str:
    """``body`` with the views it needs in front, each once and after what it needs."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for need in VIEWS[name][0]:
                visit(need)
            order.append(name)

    for need in needs:
        visit(need)
    if not order:
        return body
    body = body.strip()
    head = "WITH RECURSIVE " if recursive else "WITH "
    front = ", ".join(f"{n} AS ({VIEWS[n][1].strip()})" for n in order)
    if body.startswith("WITH ") or body.startswith("WITH\n"):
        return head + front + ", " + body[4:].lstrip()
    return head + front + " " + body


# --- marketplace tables --------------------------------------------------------------------------

view("m_customers", "SELECT c_custkey AS customer_id, c_mktsegment AS customer_type, n_name AS postcode_area FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
view("m_producers", "SELECT s_suppkey AS producer_id, s_name AS producer_name, n_name AS postcode_area FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey")
view(
    "m_products",
    """SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS category,
       p_partkey % (SELECT count(*) FROM supplier) AS producer_id,
       (p_size % 12 + 1)::INTEGER AS seasonal_start_month, ((p_size * 7) % 12 + 1)::INTEGER AS seasonal_end_month,
       p_retailprice AS base_price,
       CASE WHEN p_size % 10 = 0 THEN 'unavailable' ELSE 'available' END AS availability_status FROM part""",
)
view("m_orders", "SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate::DATE AS order_date, o_totalprice AS total_amount FROM orders")
view("m_items", "SELECT l_orderkey AS order_id, l_partkey AS product_id, l_quantity AS quantity, l_extendedprice / l_quantity AS unit_price FROM lineitem")
view(
    "lines",
    """SELECT i.order_id, o.customer_id, o.order_date, o.total_amount, c.customer_type, i.product_id, i.quantity, i.unit_price,
       p.product_name, p.category, p.producer_id, p.seasonal_start_month, p.seasonal_end_month, p.base_price,
       p.availability_status, s.producer_name
       FROM m_items i JOIN m_orders o USING (order_id) LEFT JOIN m_products p USING (product_id)
       LEFT JOIN m_customers c ON c.customer_id = o.customer_id LEFT JOIN m_producers s ON s.producer_id = p.producer_id""",
    "m_items", "m_orders", "m_products", "m_customers", "m_producers",
)
view("targets", "SELECT customer_id FROM m_customers UNION SELECT DISTINCT 1000000 + user_id FROM events", "m_customers")
view("as_of", "SELECT max(order_date) + 1 AS d, month(max(order_date) + 1) AS m FROM lines", "lines")
view("types", "SELECT customer_id, min(customer_type) AS customer_type FROM lines GROUP BY customer_id", "lines")
view("stats", "SELECT customer_id, product_id, sum(quantity) AS quantity, max(order_date) AS last_order_date FROM lines GROUP BY ALL", "lines")
view("popularity", "SELECT product_id, q AS quantity, q / max(q) OVER () AS popularity FROM (SELECT product_id, sum(quantity) AS q FROM lines GROUP BY product_id)", "lines")
view(
    "segments",
    """SELECT customer_type, product_id, q AS quantity, q / max(q) OVER (PARTITION BY customer_type) AS popularity
       FROM (SELECT customer_type, product_id, sum(quantity) AS q FROM lines WHERE customer_type IS NOT NULL GROUP BY ALL)""",
    "lines",
)
view(
    "affinity",
    """SELECT customer_type, category, q AS quantity, q / max(q) OVER (PARTITION BY customer_type) AS affinity
       FROM (SELECT customer_type, category, sum(quantity) AS q FROM lines WHERE customer_type IS NOT NULL AND category IS NOT NULL GROUP BY ALL)""",
    "lines",
)
view("history", "SELECT DISTINCT customer_id, product_id FROM lines", "lines")
view(
    "edges",
    """SELECT a.product_id AS product_a, b.product_id AS product_b, count(*) AS n
       FROM (SELECT DISTINCT order_id, product_id FROM lines) a JOIN (SELECT DISTINCT order_id, product_id FROM lines) b
       ON a.order_id = b.order_id AND a.product_id <> b.product_id GROUP BY ALL""",
    "lines",
)


def scored_fr(lines: str) -> str:
    """Frequency-recency scores over a lines view; the date comes from the view ``as_of``."""
    codes_sql = codes(
        ("frequently_ordered_by_customer", None), ("ordered_recently", "rec >= 0.35"),
        ("common_for_customer_type", "aff >= 0.5"), ("seasonally_available", "sea >= 1.0"),
    )
    score = r("least(1.0, greatest(0.0, f * 0.55::DOUBLE + rec * 0.3::DOUBLE + aff * 0.1::DOUBLE + sea * 0.05::DOUBLE))")
    return f"""SELECT customer_id, customer_type, product_id, product_name, producer_id, f AS frequency, rec AS recency, aff AS affinity, sea AS season,
        {score} AS score, {codes_sql} AS reason_codes
        FROM (SELECT s.customer_id, t.customer_type, p.product_id, p.product_name, p.producer_id, s.f, s.rec, p.sea, coalesce(a.a, 0.0::DOUBLE) AS aff
        FROM (SELECT customer_id, product_id, quantity / max(quantity) OVER (PARTITION BY customer_id) AS f,
              exp(-(greatest(0, date_diff('day', last_order_date, (SELECT d FROM as_of)))::DOUBLE) / 30.0::DOUBLE) AS rec
              FROM (SELECT customer_id, product_id, sum(quantity) AS quantity, max(order_date) AS last_order_date FROM {lines} GROUP BY ALL)) s
        JOIN (SELECT *, {season('(SELECT m FROM as_of)', 'seasonal_start_month', 'seasonal_end_month')} AS sea FROM m_products) p USING (product_id)
        JOIN (SELECT customer_id, min(customer_type) AS customer_type FROM {lines} GROUP BY customer_id) t ON t.customer_id = s.customer_id
        LEFT JOIN (SELECT customer_type, category, q / max(q) OVER (PARTITION BY customer_type) AS a FROM (SELECT customer_type, category, sum(quantity) AS q
              FROM {lines} WHERE customer_type IS NOT NULL AND category IS NOT NULL GROUP BY ALL)) a
        ON a.customer_type = t.customer_type AND a.category = p.category)"""


view("scored_fr", scored_fr("lines"), "lines", "as_of", "m_products")
view("scored_fr_train", scored_fr("train"), "train", "as_of", "m_products")


def popular_list(lines: str, k: int) -> str:
    return f"""SELECT t.rank::INTEGER AS rank, p.product_id, p.product_name, p.producer_id, {r('least(1.0, greatest(0.0, t.q / t.top))')} AS score
        FROM (SELECT product_id, q, max(q) OVER () AS top, row_number() OVER (ORDER BY q DESC, product_id) AS rank
              FROM (SELECT product_id, sum(quantity) AS q FROM {lines} GROUP BY product_id) QUALIFY rank <= {k}) t
        JOIN m_products p USING (product_id)"""


def reorder_sql(method: str, lines: str, targets: str, scored: str, k: int) -> str:
    """Ranked reorder rows (bar-joined codes) of a target view."""
    types = f"(SELECT customer_id, min(customer_type) AS customer_type FROM {lines} GROUP BY customer_id)"
    popular = popular_list(lines, k)
    cold = f"""SELECT g.customer_id, NULL::VARCHAR AS customer_type, '{method}' AS method, e.rank, e.product_id, e.product_name, e.producer_id, e.score,
        'globally_popular_product|cold_start_fallback' AS reason_codes
        FROM {targets} g CROSS JOIN ({popular}) e WHERE g.customer_id NOT IN (SELECT customer_id FROM {lines})"""
    if method == "global_popularity":
        return f"""SELECT g.customer_id, t.customer_type, 'global_popularity' AS method, e.rank, e.product_id, e.product_name, e.producer_id, e.score,
            'globally_popular_product' AS reason_codes FROM {targets} g LEFT JOIN {types} t USING (customer_id) CROSS JOIN ({popular}) e"""
    if method == "user_frequency":
        own = f"""SELECT s.customer_id, t.customer_type, 'user_frequency' AS method, s.rank::INTEGER AS rank, p.product_id, p.product_name, p.producer_id,
            {r('least(1.0, greatest(0.0, s.q / s.top))')} AS score, 'frequently_ordered_by_customer' AS reason_codes
            FROM (SELECT customer_id, product_id, q, max(q) OVER (PARTITION BY customer_id) AS top,
                  row_number() OVER (PARTITION BY customer_id ORDER BY q DESC, product_id) AS rank
                  FROM (SELECT customer_id, product_id, sum(quantity) AS q FROM {lines} GROUP BY ALL) QUALIFY rank <= {k}) s
            JOIN m_products p USING (product_id) JOIN {types} t ON t.customer_id = s.customer_id
            WHERE s.customer_id IN (SELECT customer_id FROM {targets})"""
    else:
        own = f"""SELECT customer_id, customer_type, 'frequency_recency' AS method,
            (row_number() OVER (PARTITION BY customer_id ORDER BY score DESC, product_id))::INTEGER AS rank,
            product_id, product_name, producer_id, score, reason_codes
            FROM {scored} WHERE customer_id IN (SELECT customer_id FROM {targets}) QUALIFY rank <= {k}"""
    return f"{own} UNION ALL {cold}"


REORDER_TEXT = (
    "map {'globally_popular_product': 'popular across the marketplace', 'cold_start_fallback': 'used as a fallback where customer history is sparse',"
    " 'frequently_ordered_by_customer': 'ordered repeatedly by this customer', 'ordered_recently': 'ordered recently by this customer',"
    " 'common_for_customer_type': 'common for this customer segment', 'seasonally_available': 'currently in season'}"
)


def reason_text(codes_column: str, table: str, default: str) -> str:
    words = f"list_filter(list_transform(string_split({codes_column}, '|'), lambda c: {table}[c]), lambda w: w IS NOT NULL)"
    return f"(CASE WHEN len({words}) > 0 THEN 'Recommended because it is ' || array_to_string({words}, ', ') || '.' ELSE '{default}' END)"


DISCOVERY_TEXT = (
    "map {'commonly_bought_together': 'commonly bought with products this customer purchased', 'similar_basket_pattern': 'found in similar baskets',"
    " 'new_to_customer': 'not previously purchased by this customer', 'seasonally_available': 'currently in season',"
    " 'popular_with_similar_customers': 'popular with similar customers', 'globally_popular_product': 'popular across the marketplace',"
    " 'cold_start_discovery_fallback': 'used as a discovery fallback where history is sparse',"
    " 'producer_diversity_applied': 'selected to improve producer diversity',"
    " 'limited_diversity_candidates': 'included because diverse alternatives were limited',"
    " 'insufficient_new_discovery_candidates': 'included because there were not enough new discovery candidates'}"
)

# --- temporal split ------------------------------------------------------------------------------

view(
    "train_orders",
    """SELECT order_id FROM (SELECT order_id, row_number() OVER (ORDER BY order_date, order_id) AS rn, count(*) OVER () AS n
       FROM (SELECT DISTINCT order_id, order_date FROM lines)) WHERE rn <= least(greatest(floor(n * 0.8::DOUBLE), 1), n - 1)""",
    "lines",
)
view("train", "SELECT * FROM lines WHERE order_id IN (SELECT order_id FROM train_orders)", "lines", "train_orders")
view("test", "SELECT * FROM lines WHERE order_id NOT IN (SELECT order_id FROM train_orders)", "lines", "train_orders")
view("actual", "SELECT DISTINCT customer_id, product_id FROM test", "test")
view("train_history", "SELECT DISTINCT customer_id, product_id FROM train", "train")
view("unseen", "SELECT * FROM actual EXCEPT SELECT * FROM train_history", "actual", "train_history")


# --- discovery -----------------------------------------------------------------------------------


def discovery_views(prefix: str, lines: str, products: str, targets: str) -> None:
    """Candidate views over all products, without any of the trimming the Spark job does."""
    p = prefix
    sea = season("(SELECT m FROM as_of)", "seasonal_start_month", "seasonal_end_month")
    view(f"{p}_history", f"SELECT DISTINCT customer_id, product_id FROM {lines}", lines)
    view(f"{p}_targets", f"SELECT g.customer_id, t.customer_type FROM {targets} g LEFT JOIN (SELECT customer_id, min(customer_type) AS customer_type FROM {lines} GROUP BY customer_id) t USING (customer_id)", targets, lines)
    view(
        f"{p}_edges",
        f"""SELECT a.product_id AS product_a, b.product_id AS product_b, count(*) AS n
            FROM (SELECT DISTINCT order_id, product_id FROM {lines}) a JOIN (SELECT DISTINCT order_id, product_id FROM {lines}) b
            ON a.order_id = b.order_id AND a.product_id <> b.product_id GROUP BY ALL""",
        lines,
    )
    view(
        f"{p}_lists",
        f"""SELECT l.list, l.product_id, x.product_name, x.producer_id, l.popularity, x.sea AS season,
            {r('least(1.0, greatest(0.0, l.popularity * 0.85::DOUBLE + x.sea * 0.15::DOUBLE))')} AS score
            FROM (SELECT '*' AS list, product_id, q / max(q) OVER () AS popularity FROM (SELECT product_id, sum(quantity) AS q FROM {lines} GROUP BY ALL)
                  UNION ALL
                  SELECT customer_type, product_id, q / max(q) OVER (PARTITION BY customer_type) FROM
                  (SELECT customer_type, product_id, sum(quantity) AS q FROM {lines} WHERE customer_type IS NOT NULL GROUP BY ALL)) l
            JOIN (SELECT *, {sea} AS sea FROM {products}) x USING (product_id)""",
        lines, products, "as_of",
    )
    view(
        f"{p}_raw",
        f"""SELECT h.customer_id, e.product_b AS product_id, sum(e.n) AS raw FROM {p}_history h JOIN {p}_targets USING (customer_id)
            JOIN {p}_edges e ON e.product_a = h.product_id GROUP BY ALL""",
        f"{p}_history", f"{p}_targets", f"{p}_edges",
    )
    parts = f"""SELECT w.customer_id, t.customer_type, w.product_id, x.product_name, x.producer_id, w.raw / w.top AS co, x.sea, coalesce(l.popularity, 0.0::DOUBLE) AS seg
        FROM (SELECT *, max(raw) OVER (PARTITION BY customer_id) AS top FROM {p}_raw) w
        JOIN {p}_targets t USING (customer_id) JOIN (SELECT *, {sea} AS sea FROM {products}) x USING (product_id)
        LEFT JOIN {p}_lists l ON l.list = t.customer_type AND l.product_id = w.product_id
        WHERE NOT EXISTS (SELECT 1 FROM {p}_history h WHERE h.customer_id = w.customer_id AND h.product_id = w.product_id)"""
    view(
        f"{p}_co",
        f"""SELECT customer_id, customer_type, 'co_occurrence_discovery' AS method, product_id, product_name, producer_id,
            {r('least(1.0, greatest(0.0, co * 0.82::DOUBLE + seg * 0.1::DOUBLE + sea * 0.08::DOUBLE))')} AS score,
            co * 0.82::DOUBLE AS cooccurrence, sea * 0.08::DOUBLE AS seasonality, seg * 0.1::DOUBLE AS segment_popularity,
            {codes(('commonly_bought_together', None), ('similar_basket_pattern', None), ('new_to_customer', None),
                   ('seasonally_available', 'sea >= 1.0'), ('popular_with_similar_customers', 'seg > 0'))} AS reason_codes, 0 AS source
            FROM ({parts})""",
        f"{p}_raw", f"{p}_targets", products, f"{p}_lists", f"{p}_history", "as_of",
    )


def fallback_rows(p: str, customers: str, method: str, bought_too: str, source: int) -> str:
    """All popularity rows of ``customers`` (customer_id, customer_type, list, refilled)."""
    code_list = codes(
        ("popular_with_similar_customers", "l.list <> '*'"), ("globally_popular_product", "l.list = '*'"),
        ("cold_start_discovery_fallback", None), ("new_to_customer", "h.product_id IS NULL"),
        ("seasonally_available", "l.season >= 1.0"),
        ("insufficient_new_discovery_candidates", "h.product_id IS NOT NULL AND g.refilled"),
    )
    return f"""SELECT g.customer_id, g.customer_type, {method} AS method, l.product_id, l.product_name, l.producer_id, l.score,
        0.0::DOUBLE AS cooccurrence, l.season * 0.15::DOUBLE AS seasonality,
        CASE WHEN l.list <> '*' THEN l.popularity ELSE 0.0::DOUBLE END AS segment_popularity, {code_list} AS reason_codes, {source} AS source
        FROM ({customers}) g JOIN {p}_lists l ON l.list = g.list
        LEFT JOIN {p}_history h ON h.customer_id = g.customer_id AND h.product_id = l.product_id
        WHERE h.product_id IS NULL OR {bought_too}"""


def unbought(p: str, list_sql: str) -> str:
    return f"""SELECT t.customer_id, t.customer_type, {list_sql} AS list,
        (SELECT count(*) FROM {p}_lists l WHERE l.list = {list_sql}) -
        (SELECT count(*) FROM {p}_lists l JOIN {p}_history h USING (product_id) WHERE l.list = {list_sql} AND h.customer_id = t.customer_id) AS free
        FROM {p}_targets t"""


def candidates_sql(p: str, method: str, k: int) -> str:
    """All candidates of a discovery method, one row per customer and product."""
    if method != "co_occurrence_discovery":
        list_sql = "coalesce(t.customer_type, '*')" if method.startswith("segment") else "'*'"
        return fallback_rows(p, f"SELECT *, free < {k} AS refilled FROM ({unbought(p, list_sql)})", f"'{method}'", "g.refilled", 1)
    short = f"""SELECT u.*, coalesce(c.n, 0) AS n, coalesce(c.n, 0) + u.free < {k} AS refilled FROM ({unbought(p, "coalesce(t.customer_type, '*')")}) u
        LEFT JOIN (SELECT customer_id, count(*) AS n FROM {p}_co GROUP BY ALL) c USING (customer_id) WHERE coalesce(c.n, 0) < {k}"""
    name = "CASE WHEN l.list = '*' THEN 'global_popularity_discovery' ELSE 'segment_popularity_discovery' END"
    first = fallback_rows(p, short, name, "false", 1)
    second = fallback_rows(
        p, f"SELECT customer_id, customer_type, '*' AS list, refilled FROM ({short}) WHERE refilled", "'global_popularity_discovery'", "true", 2
    )
    return f"""SELECT * FROM (SELECT * FROM {p}_co UNION ALL {first} UNION ALL {second})
        QUALIFY row_number() OVER (PARTITION BY customer_id, product_id ORDER BY score DESC, source) = 1"""


def greedy(p: str, candidates: str, k: int) -> str:
    """Greedy producer-diverse choice by recursion over whole candidate lists."""
    return f"""cand AS MATERIALIZED ({candidates}),
        walk AS (
          SELECT customer_id, 0 AS i, list({{'product_id': product_id, 'producer_id': producer_id, 'score': score}} ORDER BY score DESC, product_id) AS todo,
                 NULL::BIGINT AS product_id, []::BIGINT[] AS used, 0 AS jumped, 0 AS repeated FROM cand GROUP BY customer_id
          UNION ALL
          SELECT customer_id, i + 1, list_filter(todo, lambda c: c.product_id <> pick.product_id), pick.product_id, list_append(used, pick.producer_id),
                 CASE WHEN fresh IS NOT NULL AND fresh.product_id <> todo[1].product_id THEN 1 ELSE 0 END,
                 CASE WHEN fresh IS NULL AND list_contains(used, todo[1].producer_id) THEN 1 ELSE 0 END
          FROM (SELECT *, coalesce(fresh, todo[1]) AS pick FROM
                (SELECT *, list_filter(todo, lambda c: NOT list_contains(used, c.producer_id) AND c.score >= todo[1].score * 0.7::DOUBLE)[1] AS fresh
                 FROM walk WHERE i < {k} AND len(todo) > 0))
        ),
        chosen AS (
          SELECT c.customer_id, c.customer_type, c.method, w.i::INTEGER AS rank, c.product_id, c.product_name, c.producer_id,
                 CASE WHEN w.jumped = 1 THEN least(1.0::DOUBLE, c.score + 0.03::DOUBLE) ELSE c.score END AS score,
                 c.cooccurrence, c.seasonality, c.segment_popularity, CASE WHEN w.jumped = 1 THEN 0.03::DOUBLE ELSE 0.0::DOUBLE END AS diversity_adjustment,
                 c.reason_codes || CASE WHEN w.repeated = 1 THEN '|limited_diversity_candidates' ELSE '' END
                                || CASE WHEN w.jumped = 1 THEN '|producer_diversity_applied' ELSE '' END AS reason_codes
          FROM walk w JOIN cand c ON c.customer_id = w.customer_id AND c.product_id = w.product_id WHERE w.i > 0
        )"""


DISCOVERY_NEEDS = ("co", "lists", "history", "targets", "edges")


def needs(p: str) -> list[str]:
    return [f"{p}_{n}" for n in DISCOVERY_NEEDS]


def based_on(p: str) -> str:
    return f"""(SELECT coalesce(array_to_string(list(x.product_a::VARCHAR ORDER BY x.n DESC, x.product_a), '|'), '') FROM
        (SELECT e.product_a, e.n FROM {p}_edges e JOIN {p}_history h ON h.product_id = e.product_a AND h.customer_id = chosen.customer_id
         WHERE e.product_b = chosen.product_id ORDER BY e.n DESC, e.product_a LIMIT 3) x)"""


view("available", "SELECT * FROM m_products WHERE lower(availability_status) <> 'unavailable'", "m_products")
view("unseen_targets", "SELECT DISTINCT customer_id FROM unseen", "unseen")
view("actual_targets", "SELECT DISTINCT customer_id FROM actual", "actual")
discovery_views("full", "lines", "m_products", "targets")
discovery_views("live", "lines", "available", "targets")
discovery_views("tr", "train", "m_products", "unseen_targets")
