import os
import random

import pytest
from pyspark.sql import functions as F

from marketloom.functions.classes import event_day
from marketloom.operators import catalog as Ca
from marketloom.operators import components
from marketloom.operators import lines as L
from marketloom.operators import orders as O
from marketloom.operators import splits as Sp
from marketloom.plans import serving as S
from marketloom.session import cut
from marketloom.sources import images as Im
from marketloom.sources import logs
from marketloom.sources import tables as T
from marketloom.streaming import jobs as J
from tests.market import ids, rows, tables


def _write(t, path, **options):
    for name in T.REQUIRED_COLUMNS:
        getattr(t, name).write.option("header", True).csv(f"{path}/{name}.csv")


def test_load_checks_and_quarantine(spark, tmp_path):
    t = tables(spark)
    bad = t.orders.withColumn("order_date", F.when(F.col("order_id") == "O000002", F.lit("soon")).otherwise(F.col("order_date").cast("string")))
    _write(t.with_(orders=bad), tmp_path / "a")
    loaded, rejects = T.load_tables(spark, str(tmp_path / "a"))
    assert loaded.orders.count() == 5 and rows(rejects, "order_id", "reject_reason") == [("O000002", "invalid order_date")]
    with pytest.raises(T.TableError):
        T.load_tables(spark, str(tmp_path / "a"), strict=True)
    _write(t.with_(customers=t.customers.withColumn("Email", F.lit("x"))), tmp_path / "b")
    with pytest.raises(T.TableError, match="email"):
        T.load_tables(spark, str(tmp_path / "b"))
    with pytest.raises(T.TableError, match="unit_price"):
        T.check_columns("order_items", t.order_items.drop("unit_price"))


def _product(pid="P9", producer="PR000001", available=True, seasonal=False, start=None, end=None, at="2026-05-01T10:00:00", price=1.0, kind="product_upserted"):
    return (kind, pid, producer, " Kale ", "veg", "kg", price, seasonal, start, end, available, at, "feed")


def _log(spark, kind, data):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(data)], logs.LOG_SCHEMAS[kind] + ", seq long")


def test_product_events(spark):
    t = tables(spark)
    events = _log(spark, "product", [
        _product(kind="other"), _product(seasonal=True, start=0, end=5), _product(at="never"), _product(price=-1.0), _product(producer="PX"),
        _product(price=1.0, at="2026-05-01T12:00:00+02:00"), _product(price=2.0, at="2026-05-01T11:00:00"), _product("P000001", available=False),
    ])
    valid, rejected = Ca.normalise_product_events(events, t.producers)
    assert [r[1] for r in rows(rejected, "seq", "reject_reason")] == ["wrong event_type", "months outside 1..12", "invalid created_at", "invalid price", "unknown producer_id"]
    now = Ca.apply_product_events(t, valid)
    kale = now.products.filter("product_id = 'P9'").first()
    # 12:00+02:00 is 10:00 UTC, so the 11:00 event is the later one.
    assert (kale.base_price, kale.product_name, kale.seasonal_start_month, kale.seasonal_end_month) == (2.0, "Kale", 1, 12)
    assert "P000001" not in {r.product_id for r in L.available_products(now.products).collect()}
    assert now.products.count() == 4


def _order(oid, customer="C000001", kind=None, date="2026-05-05", total=None, items=(("P000001", 2.0, 1.5),)):
    return (oid, customer, kind, None, date, total, list(items), None, None)


def test_order_events(spark):
    t = tables(spark)
    events = _log(spark, "order", [
        _order(""), _order("O000001"), _order("N1", customer=""), _order("N2", items=()), _order("N3", customer="CX"), _order("N4", items=[("PX", 1.0, 1.0)]),
        _order("N5", date="soon"), _order("N6", items=[("P000001", 0.0, 1.0)]), _order("N7", date="soon"), _order("N7"), _order("N7"), _order("N8", customer="CX", kind="family"),
    ])
    valid, rejected = O.validate_order_events(t, events)
    assert [r[1] for r in rows(rejected, "seq", "reject_reason")] == [
        "missing order_id", "duplicate order_id", "missing customer_id", "no items", "unknown customer without type", "unknown product_id",
        "invalid order_date", "invalid item", "invalid order_date", "duplicate order_id",
    ]
    assert rows(valid, "order_id", "total_amount", "source") == [("N7", 3.0, "order_event"), ("N8", 3.0, "order_event")]
    now = O.apply_order_events(t, valid)
    assert rows(now.customers.filter("customer_id = 'CX'"), "customer_type", "postcode_area") == [("family", "unknown")]
    assert tuple(O.ingest_receipt(now).first()) == (8, 9)


def test_history_batches(spark):
    t = tables(spark)
    order = lambda oid, p="P000001": (oid, "2026-05-05", None, [(p, 1.0, 1.0)])
    batch = lambda bid, *orders: (bid, "C000001", None, None, None, list(orders), None)
    events = _log(spark, "history", [batch("B0", order("H1"), order("H2")), batch("B1", order("H3"), order("H4", "PX")), batch("B2", order("H2")), batch("B3", order("H5"), order("H5")), batch("B4")])
    valid, rejected = O.validate_history(t, events)
    assert rows(valid, "history_batch_id") == [("B0",)]
    assert rows(rejected, "history_batch_id", "reject_reason") == [("B1", "unknown product_id"), ("B2", "duplicate order_id"), ("B3", "duplicate order_id"), ("B4", "no orders")]
    assert L.order_lines(O.apply_history_events(t, valid)).count() == 9


def test_history_batches_in_turn(spark):
    order = lambda oid: (oid, "2026-05-05", None, [("P000001", 1.0, 1.0)])
    batch = lambda bid, *ids_: (bid, "C000001", None, None, None, [order(i) for i in ids_], None)
    events = _log(spark, "history", [batch("B0", "H1", "H2"), batch("B1", "H2", "H3"), batch("B2", "H3"), batch("B3", "H3", "H4"), batch("B4", " H4 "), batch("B5", "H4")])
    valid, rejected = O.validate_history(tables(spark), events)
    assert rows(valid, "history_batch_id") == [("B0",), ("B2",), ("B4",)]
    assert {r for r, in rows(rejected, "history_batch_id")} == {"B1", "B3", "B5"}


def test_event_times_keep_fractions_and_ids_are_trimmed(spark):
    times = ["2026-05-01T10:00:00.900", "2026-05-01T10:00:00.100", "2026-05-01T09:00:00"]
    valid, _ = Ca.normalise_product_events(_log(spark, "product", [_product(" P9 ", producer=" PR000001", at=t) for t in times]), tables(spark).producers)
    assert rows(Ca.latest_by_key(valid, "product_id"), "product_id", "producer_id", "created_at") == [("P9", "PR000001", "2026-05-01T10:00:00.900000")]
    assert {r.created_at for r in valid.collect()} >= {"2026-05-01T09:00:00"}
    _, rejected = O.validate_order_events(tables(spark), _log(spark, "order", [_order(" O000001 ")]))
    assert rows(rejected, "reject_reason") == [("duplicate order_id",)]


def test_day_is_the_written_one(spark):
    times = [("2026-05-01T00:30:00+02:00",), ("12:30",), ("2026-05",), ("",), (None,)]
    days = spark.createDataFrame(times, "t string").select(event_day(F.col("t"))).collect()
    assert [d[0] for d in days] == ["2026-05-01", "12:30", "2026-05", "unknown", "unknown"]


def test_live_tables_feed_recommendations(spark):
    t = tables(spark)
    producers = spark.createDataFrame([], logs.LOG_SCHEMAS["producer"] + ", seq long")
    products = _log(spark, "product", [_product("P000003", producer="PR000002", available=False)])
    history = spark.createDataFrame([], logs.LOG_SCHEMAS["history"] + ", seq long")
    orders = _log(spark, "order", [_order("N1", customer="C000002")])
    recs = S.hybrid_recommendations(S.live_tables(t, producers, products, history, orders), ids(spark, "C000002", "C000003"), 2).collect()
    assert recs and "P000003" not in {r.product_id for r in recs}
    assert {str(r.recommendation_date) for r in recs} == {"2026-05-06"}
    assert {r.section for r in recs} == {"quick_reorder", "you_may_also_like"}


def test_log_positions_and_missing_log(spark, tmp_path):
    assert logs.read_log(spark, str(tmp_path / "none"), "producer").count() == 0
    line = '{"event_type":"producer_upserted","producer_id":"A","producer_name":"%s","postcode_area":"x","created_at":"2026-01-01T00:00:00","source":"s"}\n'
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "a.jsonl").write_text(line % "first" + "\n" + line % "second")
    valid, _ = Ca.normalise_producer_events(logs.read_log(spark, str(tmp_path / "log"), "producer"))
    assert valid.count() == 2
    assert Ca.latest_by_key(valid, "producer_id").first().producer_name == "second"
    logs.append_log(valid.drop("seq"), None, str(tmp_path / "log"))
    assert logs.read_log(spark, str(tmp_path / "log"), "producer").count() == 4


def test_image_listing_from_files(spark, tmp_path):
    for name in ("Apple/a.jpg", "Apple/b.PNG", "Apple/notes.txt", "Pear/c.jpeg", "Pear/deep/d.jpg"):
        os.makedirs(tmp_path / os.path.dirname(name), exist_ok=True)
        (tmp_path / name).write_bytes(b"x")
    paths = Im.list_paths(spark, str(tmp_path))
    got = rows(Im.image_listing(paths, str(tmp_path)), "relative_path", "class_name")
    assert got == [("Apple/a.jpg", "Apple"), ("Apple/b.PNG", "Apple"), ("Pear/c.jpeg", "Pear")]
    assert Im.dataset_root_pick(paths).first().root == str(tmp_path)
    assert Im.dataset_root_pick(paths, 1).first().root == str(tmp_path / "Pear")
    with pytest.raises(ValueError):
        Im.require_images(Im.image_listing(paths, str(tmp_path / "nowhere")))


def _images(spark, n=400):
    prefix = ["", "rotated_by_30_", "vertical_flip_", "noise_"]
    data = [(f"{'big' if i % 4 else 'small'}/{prefix[(i // 4) % 4]}i{i // 16}_{i % 4}.jpg", "big" if i % 4 else "small") for i in range(n)]
    return spark.createDataFrame(data, "relative_path string, class_name string")


def test_splits_are_complete_and_groups_stay_together(spark):
    df = _images(spark)
    flat = Sp.stratified_split(df, "relative_path")
    assert rows(Sp.split_counts(flat), "class_name", "train", "val", "test", "total") == [("big", 210, 45, 45, 300), ("small", 70, 15, 15, 100)]
    assert Sp.split_overlap_audit(flat).count() > 0
    grouped = Sp.grouped_stratified_split(df)
    assert grouped.count() == 400 and grouped.select("relative_path").distinct().count() == 400
    assert Sp.split_overlap_audit(grouped).count() == 0
    assert all(Sp.dataset_checks(grouped, 2).first())
    with pytest.raises(ValueError):
        Sp.stratified_split(df, "relative_path", (0.5, 0.1, 0.1))


def test_oversampling(spark):
    df = _images(spark)
    more = Sp.targeted_oversample(df, 130, "relative_path")
    assert rows(Sp.oversample_summary(df, more), "class_name", "after_count", "added_rows") == [("big", 300, 0), ("small", 130, 30)]
    with pytest.raises(ValueError):
        Sp.targeted_oversample(df, 0, "relative_path")


def test_latest_state_survives_a_restart_and_equals_batch(spark, tmp_path):
    """Several appends with ties on time, one file per micro-batch, and a new query on the same checkpoint."""
    log, checkpoint = str(tmp_path / "log"), str(tmp_path / "cp")
    data = [("producer_upserted", f"A{i % 5}", f"n{i}", "x", ["a"], True, f"2026-01-{1 + i % 3:02d}T00:00:00", "s") for i in range(60)]
    for part in range(3):
        events = _log(spark, "producer", data[part * 20: part * 20 + 20]).withColumn("seq", F.substring("producer_name", 2, 9).cast("int"))
        logs.append_log(events.repartition(3), None, log)
        if part:
            J.keep_latest(logs.stream_log(spark, log, "producer", files_per_batch=1), "producer_id", checkpoint)
    read = logs.read_log(spark, log, "producer")
    assert [r.producer_name for r in read.orderBy("seq").collect()] == [f"n{i}" for i in range(60)]
    got = rows(J.latest_state(spark, checkpoint), "producer_id", "producer_name", "seq")
    assert got == rows(Ca.latest_by_key(read, "producer_id"), "producer_id", "producer_name", "seq") and len(got) == 5


@pytest.mark.parametrize("fold_rows", [0, 40, 10**6])
def test_late_history_batches_are_those_of_a_replay(spark, fold_rows):
    """Components of all sizes, settled in one pass, in rounds, or some in each way."""
    rng = random.Random(fold_rows)
    claims = [(b, f"o{b // 10}-{rng.randrange(rng.choice([4, 30]))}") for b in range(120) for _ in range(rng.randint(1, 3))] + [(200, "alone"), (201, None), (202, None)]
    taken, late = set(), set()
    for b in sorted({b for b, _ in claims}):
        own = {o for x, o in claims if x == b and o}
        late |= {b} if own & taken else set()
        taken |= own if b not in late else set()
    got = O._late_batches(spark.createDataFrame(claims, "seq long, order_id string"), fold_rows)
    assert {r.seq for r in got.collect()} == late and 5 < len(late) < 115


def test_a_chain_of_history_batches_takes_few_writes(spark, monkeypatch):
    """Each of 10,000 batches shares an order with the one before and the one after: every second one is late."""
    writes = []
    for module in (O, components):
        monkeypatch.setattr(module, "cut", lambda df: writes.append(1) or cut(df))
    claims = spark.range(10_000).selectExpr("id AS seq", "explode(array(concat('o', id), concat('o', id + 1))) AS order_id")
    got = O._late_batches(claims)
    assert {r.seq for r in got.collect()} == set(range(1, 10_000, 2)) and len(writes) < 25
