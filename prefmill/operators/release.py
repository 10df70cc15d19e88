"""Plans, packages and releases as tables: what a run is to be trained with, what a package holds, and what may be released.

Training itself is outside; these are the records that bind its inputs and outputs. Each function gives every row its ``issues``, codes in
a fixed order, so that a refused release tells all its reasons at once; ``corpus.demand_none`` turns them into an error.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefmill.functions import json as J
from prefmill.operators.receipts import comparison_label
from prefmill.sources.files import BROWSER_MOST, PACKAGE_MOST, verify

#: What the update of each tier is trained with, and its largest package.
TIERS: dict[str, dict[str, float | int]] = {
    "lite": {"learningRate": 0.00002, "loraRank": 8, "loraAlpha": 16, "loraDropout": 0},
    "pro": {"learningRate": 0.00001, "loraRank": 4, "loraAlpha": 4, "loraDropout": 0.05},
}
CAPS = {"lite": BROWSER_MOST, "pro": PACKAGE_MOST}
#: What every run is trained with.
COMMON: dict[str, object] = {
    "trainingMode": "orpo", "split": "train", "validationSplit": "validation", "batchSize": 1, "validationBatches": 4, "maxSequenceLength": 2048, "gradientCheckpointing": True,
    "gradientAccumulationSteps": 2, "beta": 0.1, "epsilon": 1e-8,
}
#: The status of a dataset that may be trained on, and the fields of a report that a release shows.
READY = "research-ready"
SHOWN = ("protocol", "passCount", "passRate", "issueCount", "meanTokensPerSecond", "peakMemoryGb")
#: Endings of the files that hold an adapter's weights.
WEIGHTS = ("adapters.safetensors", ".gguf")


def codes(*rules: tuple[str, Column]) -> Column:
    """The names of the rules that hold; null counts as holding, as what is unknown is not fulfilled."""
    return F.filter(F.array(*[F.when(F.coalesce(c, F.lit(True)), F.lit(n)) for n, c in rules]), lambda x: x.isNotNull())


def _settings(tier: str) -> Column:
    """All hyperparameters of a tier as JSON with sorted keys; those that follow from the column iterations are filled in."""
    few = F.col("iterations") <= 10
    text = lambda c: c.cast("string")
    derived = {
        "iterations": text(F.col("iterations")), "stepsPerReport": text(F.when(few, 1).otherwise(20)), "stepsPerEval": text(F.when(few, 5).otherwise(100)),
        "stepsPerSave": text(F.greatest(F.lit(5), F.least(F.lit(100), F.col("iterations")))),
    }
    fixed = {**COMMON, **TIERS[tier]}
    parts = []
    for name in sorted({*fixed, *derived}):
        parts += [F.lit(("{" if not parts else ",") + json.dumps(name) + ":"), derived[name] if name in derived else F.lit(json.dumps(fixed[name]))]
    return F.concat(*parts, F.lit("}"))


def training_plans(runs: DataFrame) -> DataFrame:
    """runs (run, tier, iterations, seed, revision, pinned, dataset_status, dataset_sha256) with ``hyperparameters``, ``cap``, ``identity`` and ``issues``.

    identity: a hash over what decides the outcome: base, dataset, seed and hyperparameters; not over times or paths. Null where there are issues.
    """
    tier = F.col("tier")
    settings, cap = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    for name in TIERS:
        settings, cap = F.when(tier == name, _settings(name)).otherwise(settings), F.when(tier == name, CAPS[name]).otherwise(cap)
    found = codes(
        ("tier", ~tier.isin(*TIERS)), ("iterations", F.col("iterations") <= 0), ("base-revision", F.col("revision") != F.col("pinned")), ("dataset-status", F.col("dataset_status") != READY),
    )
    body = F.concat_ws("\n", "tier", "revision", "dataset_sha256", F.col("seed").cast("string"), "hyperparameters")
    out = runs.withColumns({"hyperparameters": settings, "cap": cap, "issues": found})
    return out.withColumn("identity", F.when(F.size("issues") == 0, F.sha2(body, 256)))


def packages(listed: DataFrame, actual: DataFrame, cap: int = PACKAGE_MOST, weights: tuple[str, ...] = WEIGHTS) -> DataFrame:
    """(package, files, bytes, weights, issues) of each package of listed (package, path, bytes, sha256), against the files that are there.

    Issues: file-status:path for each listed file that is missing, of another size or hash, listed twice or outside; no-weights; weights-cap
    where a file of weights is not below the cap. Unlisted files do not count.
    """
    below = lambda rows: rows.withColumn("path", F.concat_ws("/", "package", "path")).select("path", "bytes", "sha256")
    # a path that leaves its package would leave it under the package's name as well
    safe = ~(F.col("path").startswith("/") | F.array_contains(F.split("path", "/"), ".."))
    named = listed.select(F.concat_ws("/", "package", "path").alias("full"), "package", "path", safe.alias("safe")).distinct()
    status = verify(below(listed), below(actual)).withColumnRenamed("path", "full")
    wrong = status.join(named, "full").withColumn("status", F.when(F.col("safe"), F.col("status")).otherwise("unsafe")).where("status <> 'ok'")
    wrong = wrong.groupBy("package").agg(F.array_sort(F.collect_list(F.concat(F.lit("file-"), "status", F.lit(":"), "path"))).alias("wrong"))
    held = F.lit(False)
    for end in weights:
        held = held | F.col("path").endswith(end)
    sums = listed.groupBy("package").agg(
        F.count(F.lit(1)).alias("files"), F.sum("bytes").cast("bigint").alias("bytes"), F.count_if(held).alias("weights"), F.max(F.when(held, F.col("bytes"))).alias("largest"),
    )
    none = F.array().cast("array<string>")
    own = F.filter(F.array(F.when(F.col("weights") == 0, "no-weights"), F.when(F.col("largest") >= cap, "weights-cap")), lambda x: x.isNotNull())
    return sums.join(wrong, "package", "left").select("package", "files", "bytes", "weights", F.concat(F.coalesce("wrong", none), own).alias("issues"))


def comparisons(reports: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """(id, tier, base, adapter, source_sha256, issues) of comparison reports (JSON texts in ``report``).

    id: tier and label of the protocol; base and adapter: the shown fields of either evaluation, without those that are null. Issues: failed;
    twice, where another report has the id.
    """
    parsed = reports.select("report", F.try_parse_json("report").alias("_v"))
    v = F.col("_v")
    text = lambda path: F.try_variant_get(v, path, "string")
    part = lambda name: J.subset_of(J.get(v, f"$.{name}"), SHOWN)
    tier = text("$.adapter.tier")
    rows = parsed.select(
        comparison_label(tier, text("$.adapter.protocol"), names).alias("id"), tier.alias("tier"), part("base").alias("base"), part("adapter").alias("adapter"),
        F.sha2("report", 256).alias("source_sha256"), text("$.status").alias("status"),
    )
    often = rows.groupBy("id").agg(F.count(F.lit(1)).alias("times"))
    found = codes(("failed", F.col("status") != "pass"), ("twice", F.col("times") > 1))
    return rows.join(often, "id").select("id", "tier", "base", "adapter", "source_sha256", found.alias("issues"))


def release(package_rows: DataFrame, comparison_rows: DataFrame, dataset_status: str) -> DataFrame:
    """(kind, id, issue): what keeps a release from being made, no rows if nothing does."""
    told = lambda rows, kind, name: rows.select(F.lit(kind).alias("kind"), F.col(name).alias("id"), F.explode("issues").alias("issue"))
    spark = package_rows.sparkSession
    dataset = spark.createDataFrame([("dataset", "dataset", "dataset-status")] if dataset_status != READY else [], "kind string, id string, issue string")
    return told(package_rows, "package", "package").unionByName(told(comparison_rows, "comparison", "id")).unionByName(dataset)
