"""A whole day of the pipeline over a lake, on the smallest driver tables."""

import os

from pyspark.sql import functions as F

from lakeshore.catalog import Lake
from lakeshore.operators.upsert import read_changes, read_table, upsert
from lakeshore.operators.quality import read_results
from lakeshore.plans import jobs, registry
from lakeshore.schemas import KEYS
from lakeshore.sinks.landing import land_log_lines, land_order_documents
from lakeshore.sources import driver as d

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_day_of_pipeline(spark, tmp_dir):
    lake = Lake(os.path.join(tmp_dir, "lake"))
    land_order_documents(d.order_documents(spark, SF), lake.landing("orders"), d.LOAD_DATE)
    land_log_lines(d.log_lines(spark, SF), lake.landing("combined_log"), d.LOAD_DATE)

    jobs.orders_job(spark, lake, load_date=d.LOAD_DATE, load_ts=d.LOAD_TS)
    jobs.weblogs_job(spark, lake, d.geo_ranges(spark, SF), as_of=d.LOAD_DATE)
    jobs.dimension_job(spark, lake, "companies", d.companies(spark, SF), "2022-11-13")
    jobs.dimension_job(spark, lake, "companies", d.company_changes(spark, SF), "2022-11-14")
    jobs.dimension_job(spark, lake, "products", d.products(spark, SF), "2022-11-13")
    jobs.weblogs_job(spark, lake, d.geo_ranges(spark, SF), as_of=d.LOAD_DATE)   # nothing new: no-op

    silver = registry.silver_orders(spark, SF)
    want_items = upsert(silver.limit(0), silver, ["order_id", "product_id"], order_by=["record_timestamp"])
    assert rows(read_table(spark, lake.table("orders"), KEYS["orders"])) == rows(want_items)
    assert rows(read_table(spark, lake.table("companies"), KEYS["companies"])) == rows(registry.q_upsert_companies(spark, SF))
    feed = read_changes(spark, lake.changes("companies")).where("version = '2022-11-14'")
    assert rows(feed.drop("version")) == rows(registry.q_table_changes(spark, SF).select(*feed.drop("version").columns))
    assert read_results(spark, lake.quality()).count() > 0

    out = jobs.reports_job(spark, lake, as_of=d.SALES_AS_OF)
    assert rows(out["top_login_countries"]) == rows(registry.q_top_login_countries(spark, SF))
    assert rows(out["main_devices"]) == rows(registry.q_main_devices(spark, SF))
    assert rows(out["top_products_in_top_country"]) == rows(registry.q_top_products_in_top_country(spark, SF))
    monthly = out["monthly_sales_last_year"]
    assert monthly.count() > 0 and set(monthly.columns) == {"month", "total_orders", "total_price"}

    top = out["top_login_countries"].orderBy(F.desc("number_of_users"), "country").first().country
    p = jobs.logs_by_country(spark, lake, top)
    assert "PartitionFilters: [isnotnull(country" in p._jdf.queryExecution().executedPlan().toString()
    assert p.count() > 0


def test_command_line_dimension_and_reports(spark, tmp_dir):
    import json
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    rec = os.path.join(tmp_dir, "records")
    os.makedirs(rec)
    with open(os.path.join(rec, "a.json"), "w") as f:
        f.write(json.dumps({"cuit": 1, "name": "Acme", "updated_dt": "2022-11-14T00:00:00Z"}) + "\n")
    lake_root = os.path.join(tmp_dir, "lake")
    run = [sys.executable, "-m", "lakeshore", "dimension", "--lake", lake_root, "--table", "companies",
           "--records", rec, "--date", "2022-11-14"]
    subprocess.run(run, cwd=repo, check=True, capture_output=True, timeout=600)
    assert [r.name for r in read_table(spark, Lake(lake_root).table("companies"), KEYS["companies"]).collect()] == ["Acme"]
    out = subprocess.run([sys.executable, "-m", "lakeshore", "reports", "--lake", lake_root],
                         cwd=repo, check=True, capture_output=True, text=True, timeout=600)
    assert "== top_login_countries: skipped" in out.stdout
