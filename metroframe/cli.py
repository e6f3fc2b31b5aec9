"""Run one job per call, e.g. under spark-submit:

    spark-submit metroframe/cli.py bus-stops --raw s3a://raw/bus-stop-loc --out s3a://curated/bus-stop-loc

The session comes from the deployment (``getOrCreate``); nothing here
overrides its configuration.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

JOBS = {
    "best-loans": (["raw", "out", "checkpoint"], "best_loan_job"),
    "bus-stops": (["raw", "out"], "bus_stop_job"),
    "subway-stations": (["raw", "district_info", "out"], "subway_station_job"),
    "parks": (["raw", "out"], "city_park_job"),
    "event-keywords": (["raw", "pages", "out"], "event_keyword_job"),
    "events": (["raw", "out"], "event_info_job"),
    "libraries": (["raw", "out"], "library_job"),
    "entity-union": (["libraries", "events", "loans", "out"], "entity_union_job"),
    "facility-locations": (["bus", "subway", "parks", "out"], "facility_locations_job"),
    "accessibility": (["entities", "facilities", "out"], "accessibility_job"),
    # the ingest chain (plans.ingest): landed responses in, raw CSV and the ledger out
    "loan-requests": (["ledger", "start", "end"], "open_loan_requests"),
    "land-loans": (["responses", "raw", "ledger", "start", "end"], "land_loans"),
    "land-events": (["responses", "raw", "ledger"], "land_events"),
}
MARTS = ("entity-union", "facility-locations", "accessibility")


def main(argv=None) -> int:
    parser = argparse.ArgumentParser(prog="metroframe", description="run one data job")
    sub = parser.add_subparsers(dest="job", required=True)
    for name, (args, _fn) in JOBS.items():
        p = sub.add_parser(name)
        for a in args:
            p.add_argument(f"--{a.replace('_', '-')}", dest=a, required=True)
        if name == "accessibility":
            p.add_argument("--radius-m", dest="radius_m", type=float, default=1000.0)
            p.add_argument("--parts", type=int, help="cut grid cells of dense data into parts x parts")
        if name in MARTS:
            p.add_argument("--table", help="catalog table to point at the new version")
        if name == "libraries":
            p.add_argument("--results", help="folder that quality results are appended to")
        if name in ("loan-requests", "land-loans", "land-events"):
            p.add_argument("--districts", nargs="+", default=None, required=name == "land-events")
    ns = parser.parse_args(argv)

    from pyspark.sql import SparkSession

    from metroframe.plans import ingest, jobs

    spark = SparkSession.builder.appName(f"metroframe-{ns.job}").getOrCreate()
    args, fn_name = JOBS[ns.job]
    values = [getattr(ns, a) for a in args]
    if ns.job == "event-keywords":  # the pages table is a Parquet folder of (url, html)
        values[1] = spark.read.parquet(values[1])
    kwargs = {k: v for k, v in (("radius_m", getattr(ns, "radius_m", None)), ("parts", getattr(ns, "parts", None)),
                                ("table", getattr(ns, "table", None)), ("results_path", getattr(ns, "results", None)),
                                ("districts", getattr(ns, "districts", None))) if v is not None}
    if ns.job == "loan-requests":  # one request per line, for the client that fetches
        for r in ingest.open_loan_requests(spark, ns.start, ns.end, ns.ledger, ns.districts).orderBy("year", "month", "district").collect():
            print(json.dumps(r.asDict(), ensure_ascii=False))
        return 0
    result = getattr(ingest if fn_name.startswith("land_") else jobs, fn_name)(spark, *values, **kwargs)
    if ns.job in ("land-loans", "land-events"):
        print(json.dumps({"requests": result.requests, "rows": result.rows}))
        for r in result.rejects.collect():  # a line per page or feed that keeps a request open
            print(json.dumps(r.asDict(), ensure_ascii=False))
        return 1 if result.rejects.count() else 0
    if ns.job == "best-loans":
        print(json.dumps({"rows_ingested": result}))
    elif ns.job == "libraries":
        for r in result.collect():  # one row per quality rule
            print(json.dumps(r.asDict()))
    return 0


if __name__ == "__main__":
    sys.exit(main())
