"""Readers, sinks and the full refresh, on files of edge-case documents."""

import json
from pathlib import Path
from types import SimpleNamespace

import pytest

from checks.registry import TestTables
from tests.conftest import SMALL
from tests.documents import DELIVERIES, ORDERS
from zonewright.operators.spatial import with_cells
from zonewright.plans import comparison, marts, metrics, refresh, staging
from zonewright.session import materialize, scratch_path, scratch_run, shared_folder
from zonewright.sources import readers, schemas, sinks


@pytest.fixture(scope="module")
def lake(tmp_path_factory):
    """CSV dimensions and indented JSON arrays."""
    folder = tmp_path_factory.mktemp("lake")
    (folder / "customers.csv").write_text(
        "customer_id,customer_name,phone,segment,district\n"
        'c1,"Nguyễn, Lan",0901,Consumer,Quận 1\nc2,,,,\n',
        encoding="utf-8",
    )
    (folder / "products.csv").write_text(
        "product_id,product_name,category,price_usd,weight_g\np1,Chair,Home Goods,12.5,900\n"
    )
    (folder / "sellers.csv").write_text(
        "seller_id,seller_name,district,warehouse_lat,warehouse_lon\ns1,Shop,Quận 5,10.7,106.6\n",
        encoding="utf-8",
    )
    for name, documents in (("orders", ORDERS), ("delivery_telemetry", DELIVERIES)):
        text = json.dumps(documents, indent=2, ensure_ascii=False)
        (folder / f"{name}.json").write_text(text, encoding="utf-8")
    return folder


def test_csv_is_typed_by_its_schema(spark, lake):
    rows = readers.read_csv(spark, str(lake / "customers.csv"), schemas.CUSTOMERS).collect()
    assert rows[0]["customer_name"] == "Nguyễn, Lan" and rows[0]["phone"] == "0901"
    assert rows[1]["segment"] is None
    products = readers.read_csv(spark, str(lake / "products.csv"), schemas.PRODUCTS)
    assert products.first()["weight_g"] == 900


def test_csv_columns_go_by_their_names(spark, tmp_path):
    path = tmp_path / "customers.csv"
    path.write_text("customer_id,phone,district,customer_name,segment\nc1,0123,Quận 1,Ann,Home\n", encoding="utf-8")
    row = readers.read_csv(spark, str(path), schemas.CUSTOMERS).first()
    assert (row["customer_name"], row["phone"], row["district"]) == ("Ann", "0123", "Quận 1")
    path.write_text("customer_id,telephone,district,customer_name,segment\nc1,0123,Quận 1,Ann,Home\n", encoding="utf-8")
    with pytest.raises(ValueError, match="telephone"):
        readers.read_csv(spark, str(path), schemas.CUSTOMERS)


def test_weights_may_have_fractions(spark, tmp_path):
    path = tmp_path / "products.csv"
    path.write_text("product_id,product_name,category,price_usd,weight_g\np1,x,y,1,350.5\n")
    assert readers.read_csv(spark, str(path), schemas.PRODUCTS).first()["weight_g"] == 350.5


def test_a_run_leaves_nothing_behind(spark):
    df = spark.range(3)
    with pytest.raises(RuntimeError), scratch_run(spark) as folder:
        path = materialize(df, "t").inputFiles()[0]
        assert folder.removeprefix("file:") in path
        raise RuntimeError
    assert not Path(folder.removeprefix("file://").removeprefix("file:")).exists()
    assert not scratch_path(spark, "t").startswith(folder)


def test_bad_csv_fails_loudly(spark, tmp_path):
    path = tmp_path / "products.csv"
    path.write_text("product_id,product_name,category,price_usd,weight_g\np1,x,y,cheap,1\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        readers.read_csv(spark, str(path), schemas.PRODUCTS).collect()


@pytest.mark.parametrize(
    "name, schema", [("orders", schemas.ORDERS), ("delivery_telemetry", schemas.DELIVERY_TELEMETRY)]
)
def test_json_array_and_ndjson_hold_the_same_rows(spark, lake, tmp_path, name, schema):
    source, target = str(lake / f"{name}.json"), str(tmp_path / "ndjson")
    readers.json_array_to_ndjson(spark, source, target, schema)
    array = readers.read_json_array(spark, source, schema)
    lines = readers.read_ndjson(spark, target, schema)
    assert array.schema == lines.schema
    assert sorted(map(repr, array.collect())) == sorted(map(repr, lines.collect()))


def test_documents_are_enriched_while_rewritten(spark, lake, tmp_path):
    target = str(tmp_path / "ndjson")
    readers.json_array_to_ndjson(
        spark,
        str(lake / "delivery_telemetry.json"),
        target,
        schemas.DELIVERY_TELEMETRY,
        transform=with_cells,
    )
    rows = readers.read_ndjson(spark, target, schemas.DELIVERIES).collect()
    by_id = {r["order_id"]: r for r in rows}
    assert by_id["o1"]["grid_cell_id"] == "1077_10670"
    assert by_id["o1"]["h3_cell_9"] is not None and by_id[None]["h3_cell_9"] is None


def test_materialize_keeps_rows_and_schema(spark):
    df = spark.createDataFrame([(1, "a"), (None, None)], "x bigint, y string")
    stored = materialize(df, "t")
    assert stored.schema == df.schema
    assert sorted(map(repr, stored.collect())) == sorted(map(repr, df.collect()))
    assert stored.inputFiles()[0].startswith("file://" + shared_folder(spark))


def session_with(**options):
    """Only the options of a session."""
    options = {key.replace("__", "."): value for key, value in options.items()}
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: options.get(key, default)))


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session_with(spark__master="yarn"))
    named = session_with(spark__master="yarn", spark__checkpoint__dir="hdfs:///shared/")
    assert scratch_path(named, "t").startswith("hdfs:///shared/t-")
    assert shared_folder(session_with(spark__master="local[2]"))


# -- full refresh -------------------------------------------------------------


@pytest.fixture(scope="module")
def raw(spark, lake):
    return {
        "raw_customers": readers.read_csv(spark, str(lake / "customers.csv"), schemas.CUSTOMERS),
        "raw_products": readers.read_csv(spark, str(lake / "products.csv"), schemas.PRODUCTS),
        "raw_sellers": readers.read_csv(spark, str(lake / "sellers.csv"), schemas.SELLERS),
        "raw_orders": readers.read_json_array(spark, str(lake / "orders.json"), schemas.ORDERS),
        "raw_deliveries": readers.read_json_array(
            spark, str(lake / "delivery_telemetry.json"), schemas.DELIVERY_TELEMETRY
        ),
    }


def test_full_refresh(spark, raw):
    database = "delivery"
    refresh.load(spark, raw | {"raw_orders": raw["raw_orders"].limit(1)}, database)
    counts = refresh.load(spark, raw, database)  # replaces, does not append
    assert dict(counts.collect()) == {
        "raw_customers": 2,
        "raw_products": 1,
        "raw_sellers": 1,
        "raw_orders": 3,
        "raw_deliveries": 5,
    }
    assert schemas.missing_tables(spark, database) == []
    refresh.build(spark, database)

    kpis = readers.read_mart(spark, database, "mart_kpis").first()
    assert kpis["total_deliveries"] == 5 and kpis["unique_grid_cells"] == 1
    assert readers.read_mart(spark, database, "mart_deliveries").count() == 5
    [zone] = readers.read_mart(
        spark, database, "mart_h3", "total_deliveries", "dominant_district"
    ).collect()
    assert tuple(zone) == (4, "Quận 3")
    both = readers.read_mart(spark, database, "mart_spatial_comparison").collect()
    assert len(both) == 2 and all(r["cl_us_per_row"] > 0 for r in both)
    assert spark.table("stg_order_items").count() == 2


def test_build_names_missing_tables(spark):
    sinks.ensure_database(spark, "empty_db")
    with pytest.raises(ValueError, match="raw_orders"):
        refresh.build(spark, "empty_db")


def test_refresh_of_the_test_tables_equals_the_lazy_models(spark):
    """The stored route and the registered queries give the same marts."""
    t = TestTables(spark, SMALL)
    base = materialize(
        metrics.delivery_metrics(
            staging.deliveries(t.raw_deliveries()),
            staging.orders(t.order_documents()),
        ),
        "metrics",
    )
    lazy = metrics.delivery_metrics(
        staging.deliveries(t.raw_deliveries()),
        staging.orders_with_totals(t.order_headers(staging.flat_totals(t.order_items()))),
    )
    for mart in (marts.kpis, marts.district, marts.h3, marts.grid):
        assert sorted(map(repr, mart(base).collect())) == sorted(map(repr, mart(lazy).collect()))
    assert comparison.fleet_totals(base).count() == 1
