"""Command line: the layered run and the report datasets.

    python -m casekit run --raw /shared/raw --location /shared/layers --as-of "2024-03-01 12:30:00"
    python -m casekit report exec_headline --location /shared/layers
    python -m casekit case 4711 --location /shared/layers
    # on a cluster:
    spark-submit --py-files casekit.zip casekit/__main__.py run --raw ... --location ...

``run`` reads the six raw tables (CSV extracts or Parquet), builds every
layer and publishes all models as one new version (``plans.versions``): a
failed run leaves the old one and is resumed by the next.  ``--buckets N``
replaces tables in place instead, the case-keyed staging tables bucketed by
case id.  ``report`` reads the stored fact and
marts by location, in any later process, and gives every row of a report
dataset: as CSV on standard output, or as files under ``--output``.  ``case``
gives the fact's rows of a few cases and opens only the files that may hold them.
"""

from __future__ import annotations

import argparse
import csv
import sys

from pyspark.sql import SparkSession

from casekit.operators import marts, reports
from casekit.plans import versions
from casekit.plans.pipeline import StoredLayers, build_all, persist_layers
from casekit.session import apply_conf, get_session
from casekit.sources import files

REPORTS = {
    "exec_headline": lambda s, m: reports.exec_headline(m["fct_case_lifecycle"]),
    "metric_text": lambda s, m: reports.metric_text(reports.exec_headline(m["fct_case_lifecycle"])),
    "backlog_by_case_type": lambda s, m: reports.backlog_by_case_type(m["mart_ops_kpis"]),
    "kpi_table": lambda s, m: m["mart_ops_kpis"],
    "bottleneck_table": lambda s, m: m["mart_bottlenecks"],
    "caseload_table": lambda s, m: m["mart_advocate_caseload"],
    "open_by_urgency": lambda s, m: reports.open_by_urgency(s, m["fct_case_lifecycle"]),
    "stale_cases": lambda s, m: reports.stale_cases(m["fct_case_lifecycle"]),
    "over_capacity": lambda s, m: reports.over_capacity(m["mart_advocate_caseload"]),
    "escalation_distribution": lambda s, m: reports.escalation_distribution(m["fct_case_lifecycle"]),
    "interaction_load": lambda s, m: reports.interaction_load(m["fct_case_lifecycle"]),
    "missing_docs_vs_resolution": lambda s, m: reports.missing_docs_vs_resolution(m["fct_case_lifecycle"]),
    "handoffs_vs_csat": lambda s, m: reports.handoffs_vs_csat(m["fct_case_lifecycle"]),
    "escalation_vs_sla": lambda s, m: reports.escalation_vs_sla(m["fct_case_lifecycle"]),
    "case_type_delay": lambda s, m: reports.case_type_delay(m["fct_case_lifecycle"]),
    "advocate_comparison": lambda s, m: reports.advocate_comparison(m["fct_case_lifecycle"], m["stg_advocates"]),
    "reopen_rate": lambda s, m: marts.reopen_rate(m["fct_case_lifecycle"]),
}


def run(spark: SparkSession, raw_dir: str, location: str, fmt: str = "csv", as_of: str | None = None,
        prefix: str = "casekit", buckets: int | None = None, multi_line: bool = False) -> dict[str, int]:
    """Full refresh: raw files -> every layer stored under ``location``; rows per model."""
    raw = files.read_raw_tables(spark, raw_dir, fmt, multi_line=multi_line)
    if buckets:  # bucketed tables belong to a catalog and are replaced in place
        return persist_layers(spark, build_all(spark, raw, as_of=as_of), prefix, location, buckets)
    done = versions.refresh(spark, raw, location, as_of)
    return {name: m["rows"] for name, m in done["models"].items()}


def report(spark: SparkSession, name: str, location: str, prefix: str = "casekit"):
    """A report dataset from the layers a ``run`` (of any process) stored."""
    try:
        stored = versions.Version(spark, location)
    except FileNotFoundError:
        stored = StoredLayers(spark, location, prefix)  # a bucketed run
    if "fct_case_lifecycle" not in stored:
        raise SystemExit(f"no stored fact under {location}: run the pipeline first")
    return REPORTS[name](spark, stored)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    ap = argparse.ArgumentParser(prog="casekit")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run", help="ingest raw tables and store every layer")
    r.add_argument("--raw", required=True, help="folder with the six raw CSV/Parquet tables")
    r.add_argument("--location", required=True, help="shared folder the layers are stored in")
    r.add_argument("--format", default="csv", choices=["csv", "parquet"])
    r.add_argument("--multi-line", action="store_true", help="CSV cells may hold line breaks")
    r.add_argument("--as-of", default=None, help="pinned clock (zone-less), default: now")
    r.add_argument("--prefix", default="casekit")
    r.add_argument("--buckets", type=int, default=None)
    p = sub.add_parser("report", help="print or write a report dataset, every row of it")
    p.add_argument("name", choices=sorted(REPORTS))
    p.add_argument("--location", required=True, help="folder given to run")
    p.add_argument("--prefix", default="casekit")
    p.add_argument("--output", default=None, help="write CSV files there instead of printing")
    c = sub.add_parser("case", help="print the stored fact's rows of a few cases")
    c.add_argument("ids", nargs="+", type=int)
    c.add_argument("--location", required=True, help="folder given to run")
    args = ap.parse_args(argv)

    spark = apply_conf(spark) if spark is not None else get_session()
    if args.cmd == "run":
        rows = run(spark, args.raw, args.location, args.format, args.as_of, args.prefix, args.buckets,
                   args.multi_line)
        for name, n in rows.items():
            print(f"{name}\t{n}")
    else:
        if args.cmd == "case":
            df = versions.Version(spark, args.location).clustered("fct_case_lifecycle").equal("case_id", *args.ids)
        else:
            df = report(spark, args.name, args.location, args.prefix)
        if getattr(args, "output", None):
            files.write_csv(df, args.output)
        else:
            out = csv.writer(sys.stdout)
            out.writerow(df.columns)
            out.writerows(df.toLocalIterator())  # a partition at a time
    return 0


if __name__ == "__main__":
    sys.exit(main())
