"""Command line: ``python -m corpusloom.cli build|search|crawl``. Exit codes: 0 done, 1 nothing
there or nothing new, 2 failure or bad arguments."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from corpusloom.errors import CorpusError
from corpusloom.functions.text import parse_csv
from corpusloom.operators import search as ops
from corpusloom.plans import pack
from corpusloom.plans.build import ingest_folder
from corpusloom.plans.pipeline import Pipeline, exit_code
from corpusloom.sources.jsonl import Store
from corpusloom.sources.registry import BUILT_IN, load_registry
from corpusloom.storage import exists, shared_dir


def _positive(text: str) -> int:
    if (n := int(text)) <= 0:
        raise argparse.ArgumentTypeError("a number above 0")
    return n


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="corpusloom")
    sub = top.add_subparsers(dest="command", required=True)
    build = sub.add_parser("build")
    build.add_argument("--packs-root", required=True)
    build.add_argument("--output", required=True)
    build.add_argument("--notes", default="")
    find = sub.add_parser("search")
    find.add_argument("--pack", required=True)
    find.add_argument("--query", default="")
    for family in ops.FAMILIES:
        find.add_argument("--" + family.replace("_", "-"), default="", type=parse_csv)
    find.add_argument("--limit", type=_positive, default=10)
    find.add_argument("--json", action="store_true")
    crawl = sub.add_parser("crawl")
    crawl.add_argument("--config", default=str(BUILT_IN))
    crawl.add_argument("--packs-root", required=True)
    crawl.add_argument("--pages", required=True, help="a Parquet table of landed pages")
    crawl.add_argument("--incremental", action="store_true")
    crawl.add_argument("publishers", nargs="*")
    return top


def main(argv: list[str] | None = None) -> int:
    try:
        args = parser().parse_args(argv)
    except SystemExit as e:
        return int(e.code or 0)
    spark = SparkSession.builder.getOrCreate()
    try:
        if args.command == "build":
            if not any(exists(spark, f"{args.packs_root}/metadata/{p}") for p in ("*.jsonl", "by=*/*.json")):
                return 1
            store = Store(spark, shared_dir(spark))
            ingest_folder(store, args.packs_root).show(truncate=False)
            pack.build(store, args.output, notes=args.notes)
        elif args.command == "search":
            tags = {f: getattr(args, f) or [] for f in ops.FAMILIES}
            if not args.query.strip() and not any(tags.values()):
                return 2
            store = pack.Pack.open(spark, args.pack).store(spark)
            query = ops.SearchQuery(args.query, ops.TagFilter(**{f: tuple(v) for f, v in tags.items()}), limit=args.limit)
            hits = ops.search_store(store, query)
            for row in (ops.emit_json(hits) if args.json else ops.emit_text(hits)).collect():
                print(row[0])
        else:
            pipeline = Pipeline(spark, load_registry(args.config), args.packs_root, args.incremental)
            stats = pipeline.run(spark.read.parquet(args.pages), args.publishers)
            totals = stats.agg({c: "sum" for c in stats.columns if c != "publisher_id"}).first().asDict()
            return exit_code({k[4:-1]: v or 0 for k, v in totals.items()})
    except CorpusError as e:
        print(e.envelope(), file=sys.stderr)
        return 2
    return 0


if __name__ == "__main__":
    sys.exit(main())
