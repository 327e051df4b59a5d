"""Command line: init-db, sequential, parallel, parallel-optimized, unified."""

from __future__ import annotations

import argparse
import importlib
import logging
import os
import sys

from pyspark.sql import SparkSession

from .plans import registry as reg
from .plans.unified import RunConfig, run_matching, run_unified
from .operators.bm25 import english_stop_words
from .operators.matching import arbitrate
from .sources.clients import arbiter, cleaner
from .sources.readers import load_suppliers


def _client(spec: str | None, variable: str | None = None):
    """module:attribute of a client, called without arguments; an environment variable can name it, too."""
    spec = spec or (os.environ.get(variable) if variable else None)
    if not spec:
        return None
    module, _, name = spec.partition(":")
    return getattr(importlib.import_module(module), name)()


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tallyweld", description=__doc__)
    top.add_argument("--log-level", default="INFO", choices=["DEBUG", "INFO", "WARNING", "ERROR"])
    sub = top.add_subparsers(dest="command", required=True)
    init = sub.add_parser("init-db", help="build the registry")
    init.add_argument("--ul-parquet", required=True)
    init.add_argument("--etab-parquet", required=True)
    init.add_argument("--registry", default="registry")
    init.add_argument("--sample-one-in", type=int)
    init.add_argument("--stemmer", choices=["porter"])
    init.add_argument("--stop-words", choices=["english"])
    init.add_argument("--force", action="store_true")
    for name in ("sequential", "parallel", "parallel-optimized"):  # Spark runs them alike; the last cleans by batched model calls
        run = sub.add_parser(name, help="match suppliers")
        run.add_argument("--suppliers", required=True)
        run.add_argument("--registry", default="registry")
        run.add_argument("--checkpoint", default="state")
        run.add_argument("--output-csv", default="results_enriched")
        run.add_argument("--batch-size", type=int)
        run.add_argument("--limit-rows", type=int)
        run.add_argument("--retry-errors", action="store_true")
        run.add_argument("--direction", choices=["asc", "desc"], default="desc")
        run.add_argument("--cleaner", help="module:attribute of a model client")
        run.add_argument("--api-batch-size", type=int, default=10)
    uni = sub.add_parser("unified", help="preprocess, match, search, union")
    uni.add_argument("--input", required=True)
    uni.add_argument("--registry", default="registry")
    uni.add_argument("--output-dir", default="results")
    uni.add_argument("--search-client", help="module:attribute of a search client")
    uni.add_argument("--cleaner", help="module:attribute of a model client")
    uni.add_argument("--search-threads", type=int, default=10)
    uni.add_argument("--search-delay", type=float, default=0.0)
    uni.add_argument("--limit-rows", type=int)
    for flag in ("--skip-preprocess", "--skip-search", "--skip-match", "--no-filter-inactive", "--clean-output"):
        uni.add_argument(flag, action="store_true")
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    logging.basicConfig(level=args.log_level)
    spark = SparkSession.builder.appName("tallyweld").config("spark.sql.adaptive.enabled", "true").getOrCreate()
    if args.command == "init-db":
        reg.build(spark, args.ul_parquet, args.etab_parquet, args.registry, sample_one_in=args.sample_one_in, force=args.force, stemmer=args.stemmer, stop_words=english_stop_words() if args.stop_words else ())
        return 0
    registry = reg.load(spark, args.registry)
    model = _client(args.cleaner, "TALLYWELD_CLEANER")
    if args.command == "unified":
        run_unified(spark, args.input, registry, args.output_dir, client=_client(args.search_client, "TALLYWELD_SEARCH"), cleaner=cleaner(model) if model else None, limit=args.limit_rows, filter_inactive=not args.no_filter_inactive, skip_preprocess=args.skip_preprocess, skip_match=args.skip_match, skip_search=args.skip_search, clean_output=args.clean_output, threads=args.search_threads, delay=args.search_delay)
        return 0
    per_call = args.api_batch_size if args.command == "parallel-optimized" else 1
    cfg = RunConfig(args.checkpoint, args.output_csv, args.batch_size, args.limit_rows, args.retry_errors, args.direction)
    run_matching(load_suppliers(spark, args.suppliers), registry, cfg, cleaner=cleaner(model, per_call) if model else None, arbiter=arbiter(model) if model else arbitrate)
    return 0


if __name__ == "__main__":
    sys.exit(main())
