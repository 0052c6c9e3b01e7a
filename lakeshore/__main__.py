"""Command line for the scheduled jobs: ``python -m lakeshore <job> --lake ROOT ...``.

Jobs: ``orders`` (landed documents -> orders_raw -> quality -> orders),
``weblogs`` (landed lines -> logs_raw -> logs; needs ``--geo-blocks`` and
``--geo-locations`` CSV paths), ``dimension`` (``--table`` and ``--records``
JSON path of the day's records), ``reports`` (prints the four reports).
Works the same under ``spark-submit -m``-style launchers; the session comes
from the environment (master, checkpoint folder) with the library defaults.
"""

from __future__ import annotations

import argparse
import datetime

from lakeshore.catalog import Lake
from lakeshore.plans import jobs
from lakeshore.session import get_session


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="lakeshore")
    ap.add_argument("job", choices=["orders", "weblogs", "dimension", "reports"])
    ap.add_argument("--lake", required=True, help="lake root folder (any Hadoop file system)")
    ap.add_argument("--date", default=datetime.date.today().isoformat(), help="load / run date")
    ap.add_argument("--table", help="dimension table (companies, customers, products)")
    ap.add_argument("--records", help="JSON records of the day for --table")
    ap.add_argument("--geo-blocks", help="CSV with network, geoname_id")
    ap.add_argument("--geo-locations", help="CSV with geoname_id, country_name")
    ap.add_argument("--fail-on-error", action="store_true", help="stop orders when the raw suite fails")
    a = ap.parse_args(argv)

    spark = get_session()
    lake = Lake(a.lake)
    if a.job == "orders":
        jobs.orders_job(spark, lake, load_date=a.date, fail_on_error=a.fail_on_error)
    elif a.job == "weblogs":
        from lakeshore.operators.geo import ranges_from_cidr_blocks

        if not (a.geo_blocks and a.geo_locations):
            ap.error("weblogs needs --geo-blocks and --geo-locations")
        blocks = spark.read.option("header", "true").csv(a.geo_blocks)
        locs = spark.read.option("header", "true").csv(a.geo_locations)
        jobs.weblogs_job(spark, lake, ranges_from_cidr_blocks(blocks, locs), as_of=a.date)
    elif a.job == "dimension":
        from lakeshore.sources.files import read_records

        if not (a.table and a.records):
            ap.error("dimension needs --table and --records")
        jobs.dimension_job(spark, lake, a.table, read_records(spark, a.records, a.table), a.date)
    else:
        out = jobs.reports_job(spark, lake, as_of=a.date)
        for name in jobs.REPORT_TABLES:
            if name not in out:
                print(f"== {name}: skipped, needs {sorted(jobs.REPORT_TABLES[name])}")
                continue
            print(f"== {name}")
            out[name].show(truncate=False)
    spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
