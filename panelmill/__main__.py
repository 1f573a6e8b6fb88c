"""Command line: python -m panelmill list | run QUERY --data DIR [--out DIR] | sql QUERY | steps | build ...

build runs the steps from figures to output rows: --models names a function (package.module:name) that returns plans.run.Models."""

from __future__ import annotations

import argparse
import importlib
from collections.abc import Sequence

from pyspark.sql import SparkSession

from panelmill.plans import QUERIES, SQL
from panelmill.plans.run import STEPS, Run


def main(argv: Sequence[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="panelmill")
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("list", help="names of the queries")
    run = commands.add_parser("run", help="run a query over a folder of tables")
    run.add_argument("query", choices=sorted(QUERIES))
    run.add_argument("--data", required=True, help="folder that holds a Parquet file for each table")
    run.add_argument("--out", help="folder for the result as Parquet; without it the first rows are shown")
    sql = commands.add_parser("sql", help="the SQL that gives a query's rows")
    sql.add_argument("query", choices=sorted(SQL))
    commands.add_parser("steps", help="steps of a build, in order")
    build = commands.add_parser("build", help="figures to output rows; steps whose tables are there are not done again")
    for name, text in (("figures", "table of figures"), ("articles", "table of articles"), ("path", "folder for the steps' tables"), ("models", "package.module:function that gives the models")):
        build.add_argument(f"--{name}", required=True, help=text)
    build.add_argument("--step", choices=STEPS, default=STEPS[-1], help="the last step to do")
    given = parser.parse_args(argv)
    if given.command == "list":
        print(*sorted(QUERIES), sep="\n")
    elif given.command == "sql":
        print(SQL[given.query])
    elif given.command == "steps":
        print(*STEPS, sep="\n")
    elif given.command == "build":
        spark = SparkSession.builder.appName("panelmill").getOrCreate()
        module, _, name = given.models.partition(":")
        models = getattr(importlib.import_module(module), name)()
        done = Run(spark, spark.read.parquet(given.figures), spark.read.parquet(given.articles), models, given.path).step(given.step)
        print(f"{given.step}: {done.count()} rows in {given.path}/{given.step}")
    else:
        df = QUERIES[given.query](SparkSession.builder.appName("panelmill").getOrCreate(), given.data)
        df.write.parquet(given.out) if given.out else df.show(truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
