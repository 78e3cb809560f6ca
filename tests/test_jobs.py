"""The three jobs end to end on hand-written dirty files."""

import datetime as dt
import os
import time
from decimal import Decimal

import pytest

from orderloom.__main__ import main
from orderloom.plans import jobs, reports
from orderloom.schemas import CUSTOMERS, ORDER_ITEMS, STATUS_HISTORY, TABLES
from orderloom.sources import store
from orderloom.sources.store import StaleStore, TableStore

CUSTOMERS_CSV = """customer_id,first_name,last_name,email,join_date,city
c1,Ann,Lee,,Mar 05, 2023, oslo
c2, Bo ,Ray,bo@x.org,02/20/2023,nan
"""
LISTINGS_CSV = """listing_id,product_name,category,seller_id,price,stock_quantity,listing_date
L1,Monitor 27",tech,S1," $25.00 ",5,Mar 01, 2023
L2,Lamp, Home ,S2,"$9.99",7,2023-01-15
"""
ORDERS_CSV = """order_id,customer_id,listing_id,quantity,price_at_purchase,event_timestamp,order_status
1,c1,L1,2,25.00,2024-01-01 10:00:00,Placed
1,c1,L1,3,24.00,"1:30 PM Jan 01, 2024",shiped
1,c1,L1,3,24.00,01/03/2024 10:00:00,deliverd
1,c1,L2,1,9.99,2024-01-01 10:00:00,placed
1,c1,L2,1,9.99,2024-01-01 10:00:00,canceld
2,c2,L2,1,9.99,2024-01-05 00:00:00,placed
2,c2,L2,1,9.99,2024-01-05 00:00:00,placed,extra
"""


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "customers.csv").write_text(CUSTOMERS_CSV)
    (folder / "listings.csv").write_text(LISTINGS_CSV)
    (folder / "orders.csv").write_text(ORDERS_CSV)
    return folder


def contents(spark, root):
    store = TableStore(spark, root)
    return {n: sorted(tuple(r) for r in store.read(t).collect()) for n, t in TABLES.items()}


def test_pipeline_is_repeatable(spark, raw, tmp_path):
    clean, root = str(tmp_path / "clean"), str(tmp_path / "store")
    assert jobs.clean_files(spark, str(raw), clean) == ["customers", "orders", "listings"]
    report = jobs.load_tables(spark, clean, root)
    assert report.upserted == {
        "customers": 2, "listings": 2, "orders": 2, "order_items": 3,
        "order_item_status_history": 5,
    }
    tables = contents(spark, root)
    assert tables["customers"] == [
        ("c1", "Ann", "Lee", "", dt.date(2023, 3, 5), "OSLO"),
        ("c2", "Bo", "Ray", "bo@x.org", dt.date(2023, 2, 20), ""),
    ]
    assert tables["listings"][0][1:5] == ("Monitor 27", "TECH", "S1", Decimal("25.00"))
    assert tables["order_items"] == [
        (1, "L1", 3, Decimal("24.00")), (1, "L2", 1, Decimal("9.99")), (2, "L2", 1, Decimal("9.99")),
    ]
    # Two statuses at one time: the later row of the file stays.
    assert (1, "L2", dt.datetime(2024, 1, 1, 10), "CANCELLED") in tables[STATUS_HISTORY.name]

    assert jobs.snapshot_orders(spark, root) == {"upserted": 2, "modified": 0, "matched": 0}
    jobs.load_tables(spark, clean, root)
    assert contents(spark, root) == tables
    assert jobs.snapshot_orders(spark, root) == {"upserted": 0, "modified": 0, "matched": 2}
    docs = {r._id: r for r in TableStore(spark, root).read_documents().collect()}
    assert docs["1"].payment.total == 81.99 and docs["1"].metrics.hours_to_ship == 3.5
    assert [s.status for s in docs["1"].status_timeline] == ["PLACED", "SHIPPED", "DELIVERED"]


def test_absent_feeds_leave_their_tables_alone(spark, raw, tmp_path):
    clean, root = str(tmp_path / "clean"), str(tmp_path / "store")
    (raw / "orders.csv").unlink()
    (raw / "listings.csv").unlink()
    assert jobs.clean_files(spark, str(raw), clean) == ["customers"]
    assert jobs.load_tables(spark, clean, root).upserted == {"customers": 2}
    assert jobs.load_tables(spark, str(tmp_path / "nowhere"), root).version == 1
    assert TableStore(spark, root).read(CUSTOMERS).count() == 2


def test_bad_rows_stop_the_load_or_are_set_aside(spark, raw, tmp_path):
    clean, root = str(tmp_path / "clean"), str(tmp_path / "store")
    orders = raw / "orders.csv"
    orders.write_text(
        orders.read_text()
        + "x,c1,L1,1,1,2024-01-01 00:00:00,placed\n"
        + "3,c9,L1,1,1,2024-01-01 00:00:00,placed\n"
        + "4,c1,L1,1,oops,2024-01-01 00:00:00,placed\n"
        + "5,c1,L1,1,1,never,placed\n"
    )
    jobs.clean_files(spark, str(raw), clean)
    with pytest.raises(jobs.LoadRejected):
        jobs.load_tables(spark, clean, root)
    assert TableStore(spark, root).version == 0

    report = jobs.load_tables(spark, clean, root, on_reject="quarantine")
    assert report.rejected == {
        "orders column rules": 1,
        "orders without customers": 1,
        "order_items column rules": 2,
        "order_items without orders": 1,
        "order_item_status_history column rules": 2,
        "order_item_status_history without order_items": 2,
    }
    items = TableStore(spark, root).read(ORDER_ITEMS).collect()
    assert sorted((r.order_id, r.listing_id) for r in items) == [
        (1, "L1"), (1, "L2"), (2, "L2"), (5, "L1"),
    ]


def test_reports_over_published_data(spark, raw, tmp_path, capsys):
    clean, root = str(tmp_path / "clean"), str(tmp_path / "store")
    main(["clean", str(raw), clean])
    main(["load", clean, root])
    main(["snapshot", root])
    main(["report", root, "counts"])
    assert "order_documents" in capsys.readouterr().out
    store = TableStore(spark, root)

    def run(name, *arguments):
        return [tuple(r) for r in reports.REPORTS[name](store, *arguments).collect()]

    assert run("top-sellers", "3") == [("TECH", "S1", Decimal("72.00"))]
    assert run("placed-to-shipped") == [(Decimal("3.0000"), Decimal("210.0000"), 1)]
    assert run("mom-growth") == [("2024-01-01", Decimal("72.00"), None, None)]
    assert [r[0] for r in run("order", "2")] == ["2"]
    assert [r[0] for r in run("customer", "c1")] == ["1"]
    assert [r[0] for r in run("status", "PLACED")] == ["2"]
    by_hand = """
        SELECT category, seller_id, sum(quantity * price_at_purchase) AS revenue
        FROM order_items JOIN listings USING (listing_id)
        WHERE (order_id, listing_id) IN (SELECT order_id, listing_id
            FROM order_item_status_history WHERE order_status = 'DELIVERED')
        GROUP BY category, seller_id"""
    assert run("sql", by_hand) == run("top-sellers")
    main(["report", root, "status", "PLACED", "--out", str(tmp_path / "json")])
    assert [r.order_id for r in spark.read.json(str(tmp_path / "json")).collect()] == ["2"]


def test_lookups_prune_folders_and_push_filters(spark, raw, tmp_path):
    clean, root = str(tmp_path / "clean"), str(tmp_path / "store")
    jobs.clean_files(spark, str(raw), clean)
    jobs.load_tables(spark, clean, root)
    jobs.snapshot_orders(spark, root)
    store = TableStore(spark, root)

    def plan(name, *arguments):
        df = reports.REPORTS[name](store, *arguments)
        return df._jdf.queryExecution().executedPlan().toString()

    assert "EqualTo(order_id,2)" in plan("order", "2")
    assert "EqualTo(customer.customer_id,c1)" in plan("customer", "c1")
    assert "current_status" in plan("status", "PLACED").split("PartitionFilters: [")[1].split("]")[0]
    shipped = plan("placed-to-shipped").split("PartitionFilters: [")[1].split("]")[0]
    assert "order_status" in shipped and "PLACED" in shipped


@pytest.fixture
def loaded(spark, raw, tmp_path):
    clean, root = str(tmp_path / "clean"), str(tmp_path / "store")
    jobs.clean_files(spark, str(raw), clean)
    jobs.load_tables(spark, clean, root)
    return root


def test_deleting_an_order_takes_what_it_owns(spark, loaded):
    before = contents(spark, loaded)
    keys = spark.createDataFrame([(1,), (77,)], "order_id int")
    deleted = jobs.delete_rows(spark, loaded, "orders", keys)
    assert deleted == {"orders": 1, "order_items": 2, "order_item_status_history": 4}
    after = contents(spark, loaded)
    for name in deleted:
        assert after[name] == [r for r in before[name] if r[0] != 1]
    assert after["customers"] == before["customers"]
    assert after["listings"] == before["listings"]


@pytest.mark.parametrize(
    ("table", "key", "problem"),
    [
        ("customers", ("customer_id", "c1"), {"customers used by orders": 1}),
        ("listings", ("listing_id", "L2"), {"listings used by order_items": 1}),
    ],
)
def test_deletes_of_used_rows_are_refused(spark, loaded, table, key, problem):
    before, version = contents(spark, loaded), TableStore(spark, loaded).version
    keys = spark.createDataFrame([(key[1],)], f"{key[0]} string")
    with pytest.raises(jobs.DeleteRefused) as refusal:
        jobs.delete_rows(spark, loaded, table, keys)
    assert refusal.value.problems == problem
    assert contents(spark, loaded) == before
    assert TableStore(spark, loaded).version == version


def test_an_unused_customer_may_go(spark, loaded):
    keys = spark.createDataFrame([(2,)], "order_id int")
    jobs.delete_rows(spark, loaded, "orders", keys)
    keys = spark.createDataFrame([("c2",)], "customer_id string")
    assert jobs.delete_rows(spark, loaded, "customers", keys) == {"customers": 1}
    assert [r[0] for r in contents(spark, loaded)["customers"]] == ["c1"]


def test_of_two_writers_the_second_is_refused(spark, loaded):
    first, second = TableStore(spark, loaded), TableStore(spark, loaded)
    empty, held = first.read(CUSTOMERS).limit(0), first.current.parts[CUSTOMERS.name]
    one = first.stage_table(CUSTOMERS, empty, held)
    two = second.stage_table(CUSTOMERS, first.read(CUSTOMERS))
    assert one != two
    first.publish({CUSTOMERS.name: one})
    with pytest.raises(StaleStore):
        second.publish({CUSTOMERS.name: two})
    assert TableStore(spark, loaded).read(CUSTOMERS).count() == 0


def test_line_breaks_inside_quotes(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "orders.csv").write_text(
        ORDERS_CSV.splitlines()[0] + '\n1,c1,L1,2,25.00,2024-01-01 10:00:00,"Plac\ned"\n'
    )
    for multiline, rows in ((True, 1), (False, 2)):
        target = str(tmp_path / f"clean-{multiline}")
        jobs.clean_files(spark, str(folder), target, multiline=multiline)
        found = spark.read.csv(f"{target}/clean_orders.csv", header=True)
        assert found.count() == rows


def test_unreadable_cells_are_set_aside_with_reasons(spark, raw, tmp_path):
    clean = str(tmp_path / "clean")
    (raw / "customers.csv").write_text(
        CUSTOMERS_CSV + "c3,Cy,Poe,cy@x.org,soon,paris\nc4,Di\nc5,Ed,Fox,,,rome\n"
    )
    (raw / "listings.csv").write_text(LISTINGS_CSV + 'L3,Pen,home,S3,"$1,234.00",5,2023-01-15\n')
    (raw / "orders.csv").write_text(ORDERS_CSV + "3,c1,L1,x,1,1/2/2024 9:00:00,lost\n")
    report = jobs.clean_feeds(spark, str(raw), clean)
    assert {k: n for k, n in report["customers"].items() if n} == {
        "rows": 5, "quarantined": 1, "merged": 1, "padded": 1, "join_date:not_a_date": 1,
    }
    # The comma in a price shifts the cells behind it: 234.00 reads as the stock, and the date is lost.
    assert {k: n for k, n in report["listings"].items() if n} == {
        "rows": 3, "quarantined": 1, "merged": 2, "listing_date:not_a_date": 1,
    }
    assert report["orders"]["quarantined"] == 1 and report["orders"]["rows"] == 7

    def written(name):
        return [r.asDict() for r in spark.read.csv(f"{clean}/{name}", header=True).collect()]

    (customer,) = written("quarantine_customers.csv")
    assert customer["customer_id"] == "c3" and customer["join_date"] == "soon"
    assert customer["problems"] == "join_date:not_a_date"
    (order,) = written("quarantine_orders.csv")
    assert order["quantity"] == "x" and order["order_status"] == "lost"
    assert set(order["problems"].split(",")) == {
        "quantity:not_a_whole_number", "order_status:not_a_status",
    }
    # The clean side keeps the row, without the cell.
    kept = {r["customer_id"]: r for r in written("clean_customers.csv")}
    assert len(kept) == 5 and kept["c3"]["join_date"] is None and kept["c3"]["city"] == "PARIS"


def test_only_changed_orders_are_built_again(spark, loaded, tmp_path):
    assert jobs.snapshot_orders(spark, loaded)["upserted"] == 2
    assert jobs.snapshot_orders(spark, loaded) == {"upserted": 0, "modified": 0, "matched": 2}

    def load(name, **feeds):
        raw, clean = tmp_path / name, str(tmp_path / f"clean-{name}")
        raw.mkdir()
        for feed, text in feeds.items():
            (raw / f"{feed}.csv").write_text(text)
        jobs.clean_files(spark, str(raw), clean)
        jobs.load_tables(spark, clean, loaded)

    def documents():
        rows = TableStore(spark, loaded).read_documents().collect()
        return {r._id: r.asDict(recursive=True) for r in rows}

    before = documents()
    head = ORDERS_CSV.splitlines()[0]
    load("one", orders=f"{head}\n2,c2,L2,1,9.99,2024-01-06 00:00:00,shipped\n3,c1,L1,1,5,2024-02-01 00:00:00,placed\n")
    store = TableStore(spark, loaded)
    touched = jobs.changed_orders(store, store.current.built_from)
    assert sorted(r.order_id for r in touched.collect()) == [2, 3]
    assert jobs.snapshot_orders(spark, loaded) == {"upserted": 1, "modified": 1, "matched": 2}
    after = documents()
    assert after["1"] == before["1"]  # not built again: even its time is the same
    assert after["2"]["current_status"] == "SHIPPED" and after["3"]["payment"]["total"] == 5.0

    # A listing leads to the orders that hold it; a price alone is in no document.
    load("two", listings=LISTINGS_CSV.replace("Lamp", "Lantern").replace("25.00", "26.00"))
    store = TableStore(spark, loaded)
    assert sorted(r.order_id for r in jobs.changed_orders(store, store.current.built_from).collect()) == [1, 2]
    assert jobs.snapshot_orders(spark, loaded) == {"upserted": 0, "modified": 2, "matched": 3}
    partial = documents()
    assert jobs.snapshot_orders(spark, loaded, full=True) == {"upserted": 0, "modified": 0, "matched": 3}
    for doc in (*partial.values(), *(full := documents()).values()):
        doc["audit"].pop("snapshot_ts")
    assert partial == full


def test_a_broken_load_is_taken_up_by_its_name(spark, raw, tmp_path, monkeypatch):
    clean, root, plain = (str(tmp_path / n) for n in ("clean", "store", "plain"))
    jobs.clean_files(spark, str(raw), clean)
    whole = jobs.load_tables(spark, clean, plain)
    merge, staged = jobs._Load.merge, []

    def breaking(self, batch, table, order):
        staged.append(table.name)
        if table is ORDER_ITEMS:
            raise RuntimeError("executor lost")
        merge(self, batch, table, order)

    monkeypatch.setattr(jobs._Load, "merge", breaking)
    with pytest.raises(RuntimeError):
        jobs.load_tables(spark, clean, root, run="night")
    assert TableStore(spark, root).version == 0
    assert staged == ["customers", "listings", "orders", "order_items"]
    monkeypatch.undo()

    def counting(self, batch, table, order):
        staged.append(table.name)
        merge(self, batch, table, order)

    monkeypatch.setattr(jobs._Load, "merge", counting)
    staged.clear()
    report = jobs.load_tables(spark, clean, root, run="night")
    assert staged == ["order_items", "order_item_status_history"]
    assert report.resumed == ["customers", "listings", "orders"]
    assert report.upserted == whole.upserted and report.version == 1
    assert contents(spark, root) == contents(spark, plain)
    # The next load of that name starts anew, since it goes onto another version.
    staged.clear()
    assert jobs.load_tables(spark, clean, root, run="night").resumed == [] and len(staged) == 5


def test_counts_come_with_the_writing(spark, raw, tmp_path):
    """A load runs one write for each staged result, and no job that only counts."""
    clean, root = str(tmp_path / "clean"), str(tmp_path / "store")
    jobs.clean_files(spark, str(raw), clean)
    frame, counted = type(spark.range(1)), []
    count = frame.count
    try:
        frame.count = lambda self: counted.append(1) or count(self)
        jobs.load_tables(spark, clean, root)
    finally:
        frame.count = count
    assert counted == []


def test_reports_over_a_span_read_their_months_only(spark, loaded):
    store = TableStore(spark, loaded)

    def run(name, *arguments):
        return [tuple(r) for r in reports.REPORTS[name](store, *arguments).collect()]

    asked = [
        ("mom-growth", "2024-01-01", "2024-02-01"), ("mom-growth", "2024-01-03"), ("mom-growth", "2024-02-01"),
        ("category", "TECH"), ("category", "HOME", "S2"), ("category", "HOME", "S1"),
    ]
    before = [run(*a) for a in asked]
    assert before[0] == [("2024-01-01", Decimal("72.00"), None, None)] and before[2] == []
    assert [len(r) for r in before[3:]] == [1, 1, 0]
    main(["layout", loaded])
    assert [run(*a) for a in asked] == before
    plan = reports.mom_growth(store, "2024-01-03", "2024-03-01")._jdf.queryExecution().executedPlan().toString()
    folders = next(p.split("]")[0] for p in plan.split("PartitionFilters: [") if "status_month" in p.split("]")[0])
    assert ">= 2024-01" in folders  # the rest is cut off in the plan's text
    # A newer version is not answered from the older one's layouts.
    jobs.delete_rows(spark, loaded, "orders", spark.createDataFrame([(1,)], "order_id int"))
    store.refresh()
    assert run(*asked[0]) == []


def test_layouts_skip_folders_and_row_groups(spark, tmp_path):
    from orderloom.sources import layouts

    days = spark.range(0, 4000, 1, 4).selectExpr(
        "id AS order_id", "concat('L', id) AS listing_id",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(id % 300 AS int)) AS status_timestamp",
        "if(id % 3 = 0, 'SHIPPED', 'DELIVERED') AS order_status",
    )
    layouts.write_log_by_month(days, str(tmp_path / "log"))
    march = layouts.read_log(spark, str(tmp_path / "log"), "2024-03-01", "2024-04-01")
    assert march.count() == days.filter("month(status_timestamp) = 3").count() > 0
    plan = march._jdf.queryExecution().executedPlan().toString()
    assert "status_month" in plan.split("PartitionFilters: [")[1].split("]")[0]

    catalogue = spark.range(0, 100_000, 1, 4).selectExpr(
        "concat('L', id) AS listing_id", "'n' AS product_name", "concat('c', lpad(id % 50, 2, '0')) AS category",
        "concat('s', id % 7) AS seller_id", "cast(1 AS decimal(10,2)) AS price", "1 AS stock_quantity",
        "date'2024-01-01' AS listing_date",
    )
    layouts.write_catalogue(catalogue, str(tmp_path / "cat"))
    found = layouts.read_catalogue(spark, str(tmp_path / "cat"), "c07", "s3")
    want = catalogue.filter("category = 'c07' AND seller_id = 's3'").count()
    assert len(found.collect()) == want > 0
    scan = found._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert 0 < scan.metrics().apply("numOutputRows").value() < 60_000




def test_first_documents_go_straight_to_their_buckets(spark, loaded):
    assert jobs.snapshot_orders(spark, loaded) == {"upserted": 2, "modified": 0, "matched": 0}
    assert not os.path.exists(f"{loaded}/_load/documents")
    assert TableStore(spark, loaded).read_documents().count() == 2


@pytest.mark.parametrize("few", [0, 1_000_000])
def test_documents_are_matched_alike_by_broadcast_and_by_shuffle(spark, loaded, monkeypatch, few):
    monkeypatch.setattr(jobs, "FEW_DOCUMENTS", few)
    jobs.snapshot_orders(spark, loaded)
    assert jobs.snapshot_orders(spark, loaded, full=True) == {"upserted": 0, "modified": 0, "matched": 2}
    assert TableStore(spark, loaded).read_documents().count() == 2


def shuffle_files(spark):
    held = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for f in held.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}


def test_shuffles_go_with_the_step_that_made_them(spark, loaded):
    before = shuffle_files(spark)
    jobs.snapshot_orders(spark, loaded)
    for _ in range(50):  # they are deleted in the background
        if not shuffle_files(spark) - before:
            return
        time.sleep(0.2)
    raise AssertionError(shuffle_files(spark) - before)


@pytest.mark.parametrize("few", [0, 1_000_000])
def test_documents_built_by_turns_are_the_same(spark, raw, tmp_path, monkeypatch, few):
    loaded = str(tmp_path / "store")
    TableStore(spark, loaded, buckets=3).publish({})

    def documents():
        rows = TableStore(spark, loaded).read_documents().collect()
        docs = {r._id: r.asDict(recursive=True) for r in rows}
        for doc in docs.values():
            doc["audit"].pop("snapshot_ts")
        return docs

    monkeypatch.setattr(jobs, "FEW_DOCUMENTS", few)
    (raw / "orders.csv").write_text(
        ORDERS_CSV + "".join(f"{i},c{i % 2 + 1},L{i % 2 + 1},1,2.00,2024-03-01 00:00:00,placed\n" for i in range(3, 30))
    )
    jobs.clean_files(spark, str(raw), str(tmp_path / "more"))
    jobs.load_tables(spark, str(tmp_path / "more"), loaded)
    tables = TableStore(spark, loaded)
    turns = tables.turns((TABLES["orders"], ORDER_ITEMS))
    assert turns == [[0, 1, 2]]
    monkeypatch.setattr(store, "TURN_BYTES", 1)
    assert tables.turns((TABLES["orders"], ORDER_ITEMS)) == [[0], [1], [2]]
    assert jobs.snapshot_orders(spark, loaded) == {"upserted": 29, "modified": 0, "matched": 0}
    first = documents()
    monkeypatch.setattr(store, "TURN_BYTES", 1 << 40)
    assert jobs.snapshot_orders(spark, loaded, full=True) == {"upserted": 0, "modified": 0, "matched": 29}
    assert len(first) == 29 and documents() == first

    # A new name of a listing, and a new event: by turns and at once.
    head = ORDERS_CSV.splitlines()[0]
    (raw / "orders.csv").write_text(f"{head}\n2,c2,L2,1,9.99,2024-01-06 00:00:00,shipped\n")
    (raw / "listings.csv").write_text(LISTINGS_CSV.replace("Lamp", "Lantern"))
    jobs.clean_files(spark, str(raw), str(tmp_path / "changes"))
    jobs.load_tables(spark, str(tmp_path / "changes"), loaded)
    monkeypatch.setattr(store, "TURN_BYTES", 1)
    holding = sum("L2" in [i["listing_id"] for i in d["items"]] for d in first.values())
    assert jobs.snapshot_orders(spark, loaded) == {"upserted": 0, "modified": holding, "matched": 29}
    partial = documents()
    assert partial["2"]["current_status"] == "SHIPPED" and partial["1"]["items"][1]["product"]["name"] == "Lantern"
    monkeypatch.setattr(store, "TURN_BYTES", 1 << 40)
    jobs.snapshot_orders(spark, loaded, full=True)
    assert documents() == partial
    left = [f for f in os.listdir(f"{loaded}/_load") if f.startswith(("documents", "changed"))]
    assert [f for d in left for f in os.listdir(f"{loaded}/_load/{d}")] == []


def test_a_load_by_turns_is_the_same_and_leaves_only_rejected_rows(spark, raw, tmp_path, monkeypatch):
    clean, root, plain = (str(tmp_path / n) for n in ("clean", "store", "plain"))
    orders = raw / "orders.csv"
    orders.write_text(
        orders.read_text()
        + "".join(f"{i},c{i % 2 + 1},L{i % 2 + 1},1,2.00,2024-03-01 00:00:00,placed\n" for i in range(3, 30))
    )
    jobs.clean_files(spark, str(raw), clean, compression="gzip")
    assert os.listdir(f"{clean}/_judged") == []
    parts = [f for f in os.listdir(f"{clean}/clean_orders.csv") if f.startswith("part-")]
    assert parts and all(f.endswith(".csv.gz") for f in parts)

    def held(root):
        found = os.walk(f"{root}/_load")
        return {d.split("/_load/")[1].split("/")[0] for d, _, files in found for f in files if f.startswith("part-")}

    whole = jobs.load_tables(spark, clean, plain)
    assert held(plain) == set()
    monkeypatch.setattr(store, "TURN_BYTES", 1)
    TableStore(spark, root, buckets=3).publish({})  # three turns of one bucket
    report = jobs.load_tables(spark, clean, root)
    assert report.upserted == whole.upserted and report.touched["orders"] == [0, 1, 2]
    assert contents(spark, root) == contents(spark, plain)
    assert held(root) == set()

    # Later rows of the file win, in every turn; rejected rows stay with their reasons.
    head = ORDERS_CSV.splitlines()[0]
    orders.write_text(
        f"{head}\n" + "".join(f"{i},c1,L1,{i},3.00,2024-04-01 00:00:00,shipped\n" for i in range(3, 30))
        + "x,c1,L1,1,1,2024-01-01 00:00:00,placed\n" + "40,c9,L1,1,1,2024-01-01 00:00:00,placed\n"
    )
    jobs.clean_files(spark, str(raw), str(tmp_path / "more"))
    reports = [jobs.load_tables(spark, str(tmp_path / "more"), root, on_reject="quarantine")]
    monkeypatch.setattr(store, "TURN_BYTES", 1 << 40)
    reports.append(jobs.load_tables(spark, str(tmp_path / "more"), plain, on_reject="quarantine"))
    assert reports[0].rejected == reports[1].rejected and reports[0].rejected["orders column rules"] == 1
    assert reports[0].upserted == reports[1].upserted
    assert contents(spark, root) == contents(spark, plain)
    assert held(root) == held(plain) >= {"orders_judged", "orders_without_customers"}


def test_good_rows_do_not_keep_their_text(spark):
    from orderloom.operators import cleaning

    raw = spark.createDataFrame([("L1", "5"), ("L2", "x")], "listing_id string, stock_quantity string")
    judged = cleaning.judge(raw, cleaning.LISTING_RULES)
    cells = {r.listing_id: r[cleaning.CELLS] for r in judged.collect()}
    assert cells["L1"] is None and tuple(cells["L2"]) == ("L2", "x")
    assert [r.stock_quantity for r in cleaning.quarantined(judged).collect()] == ["x"]
