"""Command line: ``run`` the whole job, or ``score`` with its models.

    spark-submit --py-files spokewise.zip submit.py run --input DIR --out DIR
    python -m spokewise score --out DIR sales 2023-10-09
"""

from __future__ import annotations

import argparse

from spokewise.operators import recommend
from spokewise.plans import retail, scoring
from spokewise.schemas import TABLES
from spokewise.session import build_session, scale_settings


def _pairs(items: list[str]) -> dict[str, str]:
    return dict(item.split("=", 1) for item in items)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="spokewise", description=__doc__.splitlines()[0])
    commands = top.add_subparsers(dest="command", required=True)

    job = commands.add_parser("run", help="clean, audit, analyse, save models, publish")
    job.add_argument("--input", help="folder with <table>.<format> for the four tables")
    job.add_argument("--table", action="append", default=[], metavar="NAME=PATH")
    job.add_argument("--format", default="csv", choices=("csv", "parquet"))
    job.add_argument("--out", required=True, help="shared folder for tables, reports and models")
    job.add_argument(
        "--input-bytes", type=int, required=True, help="input size, to set shuffle partitions"
    )
    job.add_argument("--cores", type=int, required=True, help="task slots of the cluster")
    job.add_argument("--from-step", default=retail.STEPS[0], choices=retail.STEPS)
    job.add_argument("--recommender", default="blocks", choices=("blocks", "sums"))
    job.add_argument("--recommender-blocks", type=int, default=recommend.BLOCKS)
    job.add_argument("--jdbc-url")
    job.add_argument("--jdbc-property", action="append", default=[], metavar="KEY=VALUE")
    job.add_argument("--jdbc-connections", type=int, default=16)

    score = commands.add_parser("score", help="apply the saved models")
    score.add_argument("--out", required=True, help="output folder of a run")
    kinds = score.add_subparsers(dest="kind", required=True)
    kinds.add_parser("sales").add_argument("days", nargs="+", metavar="YYYY-MM-DD")
    kinds.add_parser("supply").add_argument("months", nargs="+", metavar="YYYY-MM")
    kinds.add_parser("segments")
    customer = kinds.add_parser("recommend")
    customer.add_argument("customer", type=int)
    customer.add_argument("--k", type=int, default=5)
    return top


def run(args: argparse.Namespace) -> None:
    spark = build_session("spokewise", scale_settings(args.input_bytes, args.cores))
    inputs = {name: f"{args.input}/{name}.{args.format}" for name in TABLES} if args.input else {}
    inputs |= _pairs(args.table)
    database = None
    if args.jdbc_url:
        database = retail.Database(
            args.jdbc_url, _pairs(args.jdbc_property), args.jdbc_connections
        )
    report = retail.run(
        spark,
        inputs,
        args.out,
        args.format,
        database,
        args.recommender,
        args.recommender_blocks,
        args.from_step,
    )
    report.show(100, truncate=False)


def score(args: argparse.Namespace) -> None:
    spark = build_session("spokewise-score")
    job = retail.RetailJob(spark, args.out)
    if args.kind == "sales":
        days = [tuple(int(part) for part in day.split("-")) for day in args.days]
        result = scoring.score_days(spark, job.path("models", "sales_forecast"), days)
    elif args.kind == "supply":
        months = [tuple(int(part) for part in month.split("-")) for month in args.months]
        result = scoring.score_months(spark, job.path("models", "supply_forecast"), months)
    elif args.kind == "segments":
        result = scoring.score_segments(
            job.path("models", "segmentation"), job.cleaned("customers"), job.cleaned("orders")
        )
    else:
        result = scoring.score_customer(
            job.path("models", "recommender"), job.cleaned("customers"), args.customer, args.k
        )
    result.show(truncate=False)


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    {"run": run, "score": score}[args.command](args)


if __name__ == "__main__":
    main()
