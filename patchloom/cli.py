"""Command line: one subcommand for each plan.

Inputs are JSON lines or objects as the plans' docstrings tell; outputs are
folders. A typed error ends with status 2.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patchloom.functions.tokens import approx_offsets
from patchloom.operators import joins, summaries
from patchloom.plans import chunking, curation, dataset, extraction, recovery, splitting
from patchloom.sinks import files
from patchloom.sources import advisories, jsonl

FUNCTION = (
    "commit string, commit_url string, commit_hash string, repository string, cwe string, cwes string, cwe_id string, function_name string, method_name string, "
    "code_before string, code_after string, programming_language string, file_change_id string, file_path string, filename string, old_path string, new_path string, "
    "commit_message string, report_link string, description string, token_count_before long, token_count_after long"
)
METADATA = "file_change_id string, file_path string, filename string, old_path string, new_path string"
ADVISORY = "ghsa_id string, cve_id string, summary string, html_url string, references array<string>, cwes array<struct<cwe_id:string>>"


def _records(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines with Spark's own schema inference, each with its place."""
    return spark.read.json(path).withColumn("source_line", F.monotonically_increasing_id() + 1)


def _filter(spark: SparkSession, a: argparse.Namespace) -> None:
    metadata = jsonl.read_enrichment(spark, a.file_metadata, METADATA) if a.file_metadata else spark.createDataFrame([], METADATA)
    counts = (F.col("token_count_before"), F.col("token_count_after"))
    cwe_map, index = jsonl.read_map(spark, a.cwe_map), jsonl.read_lines(spark, a.commit_dataset)
    records = curation.filter_file(spark, a.function_dataset, FUNCTION, cwe_map, index, metadata, counts, a.max_tokens)
    files.write_filtered(records, curation.filter_summary(records), a.output_dir)


def _filter_external(spark: SparkSession, a: argparse.Namespace) -> None:
    pairs = _records(spark, a.input)
    known = pairs.columns
    counts = tuple(F.col(c) if c in known else F.lit(None) for c in ("token_count_before", "token_count_after"))
    records = curation.filter_external(pairs, a.max_tokens, counts)
    summary = records.groupBy("status").agg(F.count(F.lit(1)).alias("records"))
    files.write_filtered(records, summary, a.output_dir)


def _recover(spark: SparkSession, a: argparse.Namespace) -> None:
    rows = jsonl.read_strict(spark, a.function_dataset, FUNCTION)
    cwe_map = jsonl.read_map(spark, a.cwe_map).withColumn("ordinal", F.xxhash64("key"))
    found = recovery.recover(rows, cwe_map, spark.read.parquet(a.diffs), not a.all_cwes, not a.all_languages)
    files.write_jsonl(found.resolved, f"{a.output_dir}/resolved")
    files.write_csv(found.unresolved, f"{a.output_dir}/unresolved")
    files.write_report(found.counters, f"{a.output_dir}/recovery_summary.csv")


def _discover(spark: SparkSession, a: argparse.Namespace) -> None:
    payloads = jsonl.read_strict(spark, a.input, ADVISORY).withColumn("place", F.struct("file", "source_line"))
    found = advisories.candidates(advisories.latest(payloads, "place"), f"CWE-{a.cwe}")
    files.write_jsonl(found.drop("place"), f"{a.output_dir}/candidates")
    files.write_report(summaries.discovery_summary(found), f"{a.output_dir}/discovery_summary.csv")


def _extract(spark: SparkSession, a: argparse.Namespace) -> None:
    candidates = spark.read.json(a.input).withColumn("ordinal", F.monotonically_increasing_id())
    cached = [spark.read.parquet(f"{a.cache_dir}/{name}") for name in ("commits", "diffs", "sources")]
    found = extraction.extract(candidates, *cached)
    files.write_jsonl(found.pairs, f"{a.output_dir}/pairs")
    files.write_jsonl(found.review, f"{a.output_dir}/review")
    files.write_report(extraction.extraction_summary(found), f"{a.output_dir}/extraction_summary.csv")


def _chunk(spark: SparkSession, a: argparse.Namespace) -> None:
    made = chunking.chunk_records(joins.spread(_records(spark, a.input)), approx_offsets, "words-and-signs", a.max_tokens, a.stride)
    for name, rows in (("chunks", made.chunks), ("training", made.training()), ("manual_review", made.remaining)):
        files.write_jsonl(rows, f"{a.output_dir}/{name}")
    files.write_report(chunking.chunk_summary(made.outcomes), f"{a.output_dir}/chunking_summary.csv")


def _build(spark: SparkSession, a: argparse.Namespace) -> None:
    chunks = [(_records(spark, p), dataset.ADVISORIES if "supplement" in p.split("/") else a.primary_source) for p in a.chunks]
    built = dataset.build([_records(spark, p) for p in a.accepted], chunks, a.max_tokens)
    for name, rows in built._asdict().items():
        files.write_jsonl(rows, f"{a.output_dir}/{name}")
    files.write_report(dataset.build_summary(built), f"{a.output_dir}/build_summary.csv")


def _split(spark: SparkSession, a: argparse.Namespace) -> None:
    excluded = (*splitting.EXCLUDED, *a.exclude_cwe)
    made = splitting.split_samples(spark.read.json(a.input), excluded, a.validation_ratio, a.test_ratio, a.seed, max_tokens=a.max_tokens)
    splitting.check_split(made.rows)
    files.write_split(made.rows, splitting.label_map(), splitting.split_table(made.rows), a.output_dir)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="patchloom", description=__doc__)
    commands = top.add_subparsers(required=True, metavar="command")

    def command(name: str, run, *required: str) -> argparse.ArgumentParser:
        p = commands.add_parser(name)
        p.set_defaults(run=run)
        for flag in (*required, "output-dir"):
            p.add_argument(f"--{flag}", required=True)
        return p

    p = command("filter", _filter, "function-dataset", "cwe-map", "commit-dataset")
    p.add_argument("--file-metadata")
    p.add_argument("--max-tokens", type=int, default=512)
    command("filter-external", _filter_external, "input").add_argument("--max-tokens", type=int, default=512)
    p = command("recover", _recover, "function-dataset", "cwe-map", "diffs")
    p.add_argument("--all-cwes", action="store_true")
    p.add_argument("--all-languages", action="store_true")
    command("discover", _discover, "input", "cwe")
    command("extract", _extract, "input", "cache-dir")
    p = command("chunk", _chunk, "input")
    p.add_argument("--max-tokens", type=int, default=512)
    p.add_argument("--stride", type=int, default=128)
    p = command("build", _build)
    p.add_argument("--accepted", action="append", default=[])
    p.add_argument("--chunks", action="append", default=[])
    p.add_argument("--primary-source", default="primary")
    p.add_argument("--max-tokens", type=int, default=512)
    p = command("split", _split, "input")
    p.add_argument("--exclude-cwe", action="append", default=[])
    p.add_argument("--validation-ratio", type=float, default=0.15)
    p.add_argument("--test-ratio", type=float, default=0.15)
    p.add_argument("--seed", type=int, default=42)
    p.add_argument("--max-tokens", type=int, default=512)
    return top


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    if getattr(args, "max_tokens", 1) < 1:
        print("max-tokens has to be positive", file=sys.stderr)
        return 2
    try:
        args.run(spark or SparkSession.builder.appName("patchloom").getOrCreate(), args)
    except (ValueError, OSError, PySparkException) as error:
        print(f"{type(error).__name__}: {error}"[:2000], file=sys.stderr)
        return 2
    return 0


if __name__ == "__main__":
    sys.exit(main())
