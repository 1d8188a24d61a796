"""Command line: list and run queries, and the modes of the pipeline."""

from __future__ import annotations

import argparse
import importlib

from pyspark.sql import SparkSession


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="newsquarry", description=__doc__)
    sub = top.add_subparsers(dest="command", required=True)
    names = sub.add_parser("list", help="names of all queries")
    one = sub.add_parser("query", help="run a query over a folder of tables")
    one.add_argument("name")
    one.add_argument("tables")
    for p in (names, one):
        p.add_argument("--queries", default="newsquarry.queries", help="module that registers the queries")
    mode = sub.add_parser("run", help="run a mode of the pipeline over a folder of tables")
    mode.add_argument("mode")
    mode.add_argument("tables")
    mode.add_argument("--since", help="only articles published from this day on")
    mode.add_argument("--limit", type=int, help="only the newest so many articles")
    mode.add_argument("--rematch", action="store_true", help="forget what was matched before")
    for p in (one, mode):
        p.add_argument("--out", help="folder to write parquet to; rows are shown without it")
    return top


def main(arguments: list[str] | None = None) -> int:
    args = parser().parse_args(arguments)
    from newsquarry.plans import pipeline
    from newsquarry.session import table

    if args.command == "list":
        print("\n".join(sorted(importlib.import_module(args.queries).QUERIES)))
        return 0
    spark = SparkSession.builder.appName("newsquarry").getOrCreate()
    if args.command == "query":
        made = {args.name: importlib.import_module(args.queries).QUERIES[args.name](spark, args.tables)}
    else:
        tables = {n: table(spark, args.tables, n) for n in ("articles", "company_aliases")}
        if args.rematch:
            from newsquarry.operators import ingest

            tables["articles"] = ingest.reset_matches(tables["articles"])
        out = pipeline.run(args.mode, tables, args.since, args.limit)
        made = {n: out[n] for n in pipeline.MODES[args.mode] if n in out}
    for name, df in made.items():
        if args.out:
            df.write.mode("overwrite").parquet(f"{args.out}/{name}")
        else:
            df.show()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
