"""Command line: models, seed, teacher, critic, manifest, evaluate, compare.

Tables are folders of Parquet; --model names a callable (module:function) that takes
messages and a seed and returns a text.
"""

from __future__ import annotations

import argparse
import sys
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from prefmill.operators import corpus, evaluate, flows
from prefmill.sources import jsonl, registry, seeds

GATES = {"research": corpus.RESEARCH, "production": corpus.PRODUCTION}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="prefmill", description=__doc__)
    commands = p.add_subparsers(dest="command", required=True)
    commands.add_parser("models", help="print the registry of pinned models")
    model = {"default": "prefmill.operators.generate:echo", "help": "module:function that answers messages"}
    for name, tables in {
        "seed": ["output"], "teacher": ["tasks", "output", "split"], "critic": ["rows", "output"], "corpus": ["rows", "evidence", "output"],
        "manifest": ["pairs"], "evaluate": ["tasks", "output", "split"], "compare": ["base", "candidate"],
    }.items():
        c = commands.add_parser(name)
        for t in tables:
            c.add_argument(f"--{t}", required=True)
        if name in ("teacher", "critic", "evaluate"):
            c.add_argument("--model", **model)
        if name in ("teacher", "critic"):
            c.add_argument("--prior", help="rows of an earlier run")
        if name == "teacher":
            c.add_argument("--limit", type=int)
        if name == "manifest":
            c.add_argument("--gate", choices=sorted(GATES), default="research")
    return p


def show(parts: dict[str, DataFrame]) -> None:
    """Print small aggregates as one sorted JSON report."""
    sys.stdout.write(jsonl.receipt({k: [r.asDict(True) for r in d.collect()] for k, d in parts.items()}))


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"prefmill-{a.command}").getOrCreate()
    read = spark.read.parquet
    if a.command == "models":
        show({"models": registry.registry(spark)})
    elif a.command == "seed":
        seeds.seed_rows(spark).write.mode("overwrite").partitionBy("split").parquet(a.output)
    elif a.command == "compare":
        show({"comparison": evaluate.promotion(read(a.base), read(a.candidate)), "categories": evaluate.compare_categories(read(a.base), read(a.candidate))})
    elif a.command == "manifest":
        show(flows.manifest(read(a.pairs), GATES[a.gate]))
    elif a.command == "corpus":
        flows.preference_corpus(read(a.rows), read(a.evidence)).write.mode("overwrite").parquet(a.output)
    else:
        module, _, name = a.model.partition(":")
        complete = getattr(import_module(module), name)
        prior = read(a.prior) if getattr(a, "prior", None) else None
        if a.command == "teacher":
            out = flows.teacher(read(a.tasks), a.split, complete, prior, a.limit)
        elif a.command == "critic":
            out = flows.critic(read(a.rows), complete, prior)
        else:
            out = flows.evaluation(read(a.tasks), a.split, complete)
        out.write.mode("overwrite").parquet(a.output)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
