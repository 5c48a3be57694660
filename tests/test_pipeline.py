import pytest

from basketry.operators.quality import DataQualityError
from basketry.plans import staging, warehouse
from basketry.sources.sample_tables import raw_table
from basketry.sources.schemas import CSV_FILES, RAW
from basketry.sources.tables import read_csv, read_parquet, read_raw, write_csv, write_parquet
from basketry.streaming.events import read_event_stream, write_event_stream

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def raw_folder(spark, tmp_path_factory):
    """The sample tables as the five CSV files. Line ids, not unique in the sample, are numbered here."""
    folder = tmp_path_factory.mktemp("raw")
    for name, file in CSV_FILES.items():
        df = raw_table(spark, FOLDER, name)
        if name == "raw_order_items":
            df = df.selectExpr("monotonically_increasing_id() as item_id", *df.columns[1:])
        write_csv(df, str(folder / file))
    return str(folder)


def test_run_writes_the_star_schema_and_models(spark, raw_folder, tmp_path):
    run = warehouse.run_pipeline(spark, raw_folder, str(tmp_path), "shop", min_customers=100)
    raw = {name: raw_table(spark, FOLDER, name).count() for name in CSV_FILES}
    assert run.ingested == raw
    for name, rows in run.written.items():
        assert read_parquet(spark, str(tmp_path / name)).count() == rows
    assert run.written["fct_orders"] == raw["raw_orders"] and run.written["fct_events"] == raw["raw_events"]
    assert run.written["dim_customers"] == run.written["fct_customer_metrics"]
    assert spark.table("shop.mart_orders").count() == raw["raw_orders"]
    assert spark.table("stg_customers").count() == run.written["dim_customers"]
    completed = spark.table("shop.raw_orders").where("status = 'completed'")
    assert run.statistics.total_orders == completed.count()
    assert (tmp_path / "fct_orders").glob("order_year=*")


def test_a_second_run_replaces_the_first(spark, raw_folder, tmp_path):
    for _ in range(2):
        run = warehouse.run_pipeline(spark, raw_folder, str(tmp_path), "shop", min_customers=100)
    assert read_parquet(spark, str(tmp_path / "dim_products")).count() == run.written["dim_products"]


def test_gate_stops_the_run(spark, raw_folder, tmp_path):
    with pytest.raises(DataQualityError, match="Customer count sanity"):
        warehouse.run_pipeline(spark, raw_folder, str(tmp_path / "w"), "shop", min_customers=10**6)
    assert not (tmp_path / "w").exists()


def test_csv_types(spark, tmp_path):
    (tmp_path / "customers.csv").write_text(
        "customer_id,first_name,last_name,email,city,state,country,segment,signup_date,age\n"
        "c1,Ann,Lee,,Rome,S1,US,VIP,2024-01-02,34.0\n"
        "c2,Bob,Ray,b@x,Rome,S1,US,New,2024-01-02 00:00:00,\n"
        "c3,Cy,Fox,c@x,Rome,S1,US,New,someday,old\n"
    )
    (tmp_path / "products.csv").write_text(
        "product_id,product_name,category,price,cost,stock_qty,is_active\n"
        "p1,Pen,Books,1.50,0.5,3,True\np2,Pad,Books,2.5,1,4,False\np3,Ink,Books,x,1,4,\n"
    )
    a, b, c = read_csv(spark, str(tmp_path / "customers.csv"), RAW["raw_customers"]).orderBy("customer_id").collect()
    assert (a.age, a.email, str(a.signup_date)) == (34, None, "2024-01-02")
    assert (b.age, str(b.signup_date)) == (None, "2024-01-02")
    assert (c.age, c.signup_date) == (None, None)
    p, q, r = read_csv(spark, str(tmp_path / "products.csv"), RAW["raw_products"]).orderBy("product_id").collect()
    assert (str(p.price), p.is_active, q.is_active, r.price, r.is_active) == ("1.50", True, False, None, True)
    assert dict(read_csv(spark, str(tmp_path / "customers.csv")).dtypes)["age"] == "string"


def test_csv_quotes_and_line_breaks_survive(spark, tmp_path):
    rows = [("e1", 'say "hi", you', "s", "view", "a\nb", None, "d", "o")]
    events = spark.createDataFrame(rows, RAW["raw_events"])
    write_csv(events, str(tmp_path / "events"))
    back = read_csv(spark, str(tmp_path / "events"), RAW["raw_events"], multiline=True)
    assert back.collect() == events.collect()


def test_csv_header_must_fit_the_schema(spark, tmp_path):
    (tmp_path / "x.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="CSV header"):
        read_csv(spark, str(tmp_path / "x.csv"), spark.createDataFrame([], "a string, b string").schema).collect()


def test_raw_schemas(spark, raw_folder):
    for name, df in read_raw(spark, raw_folder).items():
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in RAW[name]]


def test_written_rows_are_counted_in_the_write(spark, tmp_path):
    assert write_parquet(spark.range(1000).selectExpr("id", "id % 3 as part"), str(tmp_path / "t"), ["part"]) == 1000
    assert read_parquet(spark, str(tmp_path / "t")).where("part = 1").count() == 333


def test_event_stream_equals_the_batch(spark, raw_folder, tmp_path):
    events = read_event_stream(spark, f"{raw_folder}/events.csv")
    write_event_stream(events, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    batch = staging.fct_events(raw_table(spark, FOLDER, "raw_events"))
    batch = batch.withColumn("event_id", batch.event_id.cast("string"))
    streamed = read_parquet(spark, str(tmp_path / "out")).select(*batch.columns)
    assert streamed.exceptAll(batch).isEmpty()
    assert streamed.count() == batch.count()
