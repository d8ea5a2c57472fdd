"""Small hand-made tables used by several tests."""

from datetime import date

from pyspark.sql import functions as F

from marketloom.sources.tables import Tables, table_schema


def tables(spark) -> Tables:
    d = date.fromisoformat
    frame = lambda name, rows: spark.createDataFrame(rows, table_schema(name))
    return Tables(
        customers=frame("customers", [("C000001", "family", "BS1"), ("C000002", "restaurant", "BS2"), ("C000003", "community_group", "BS3")]),
        producers=frame("producers", [("PR000001", "North Farm", "BS1"), ("PR000002", "Valley Growers", "BS2")]),
        products=frame("products", [
            ("P000001", "Tomatoes", "vegetables", "PR000001", 1, 12, 2.5),
            ("P000002", "Apples", "fruit", "PR000001", 8, 11, 1.8),
            ("P000003", "Potatoes", "vegetables", "PR000002", 1, 12, 1.2),
        ]),
        orders=frame("orders", [
            ("O000001", "C000001", d("2026-01-01"), 6.8), ("O000002", "C000001", d("2026-01-08"), 5.0),
            ("O000003", "C000002", d("2026-01-09"), 10.0), ("O000004", "C000003", d("2026-01-15"), 7.4),
            ("O000005", "C000001", d("2026-02-01"), 4.3), ("O000006", "C000002", d("2026-02-08"), 8.7),
        ]),
        order_items=frame("order_items", [
            ("O000001", "P000001", 2.0, 2.5), ("O000001", "P000002", 1.0, 1.8), ("O000002", "P000001", 2.0, 2.5),
            ("O000003", "P000003", 6.0, 1.2), ("O000004", "P000002", 3.0, 1.8), ("O000005", "P000001", 1.0, 2.5), ("O000006", "P000003", 4.0, 1.2),
        ]),
    )


def ids(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "customer_id string")


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())
