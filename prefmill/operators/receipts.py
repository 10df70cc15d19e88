"""Checks across receipts: a training run's plan, result and audit against the files they speak of."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefmill.functions import json as J

SPLITS = ("train", "validation", "test")
PARTS = ("adapter_config.json", "adapters.safetensors")


def chain_issues(receipts: DataFrame, protocols: Mapping[str, str]) -> DataFrame:
    """(run, issues): what breaks the chain of a training run.

    receipts: run; plan, result, audit, dataset (JSON texts); plan_sha, audit_sha,
    manifest_sha (hashes of those files); model_id, revision (the pinned base);
    split_sha (map of split to hash) and files (map of name to (bytes, sha256)) as found.
    """
    doc = {n: F.try_parse_json(n) for n in ("plan", "result", "audit", "dataset")}
    text = lambda n, p: F.try_variant_get(doc[n], p, "string")
    differ = lambda a, b: ~a.eqNullSafe(b)
    clean = F.coalesce((J.kind(J.get(doc["plan"], "$.repository.dirty")) == "boolean") & ~F.try_variant_get(doc["plan"], "$.repository.dirty", "boolean"), F.lit(False))
    rules = [
        ("training-plan-protocol", differ(text("plan", "$.protocol"), F.lit(protocols["plan"])) | differ(text("plan", "$.lane"), F.lit("research"))),
        ("training-repository-dirty", ~clean),
        ("training-base", differ(text("plan", "$.base.modelId"), F.col("model_id")) | differ(text("plan", "$.base.revision"), F.col("revision"))),
        ("training-dataset-manifest", differ(text("plan", "$.dataset.manifestSha256"), F.col("manifest_sha"))),
        ("training-dataset-identity", differ(text("plan", "$.dataset.identitySha256"), text("dataset", "$.identity.sha256"))),
        ("training-result-protocol", differ(text("result", "$.protocol"), F.lit(protocols["result"])) | differ(text("result", "$.status"), F.lit("completed"))),
        ("training-adapter-id", differ(text("result", "$.adapterId"), text("plan", "$.adapter.id"))),
        ("training-plan-sha256", differ(text("result", "$.planSha256"), F.col("plan_sha"))),
        ("training-plan-identity", differ(text("result", "$.planIdentitySha256"), text("plan", "$.identity.sha256"))),
        ("token-audit-status", differ(text("audit", "$.status"), F.lit("pass"))),
        ("token-audit-sha256", differ(text("plan", "$.trainer.tokenAudit.sha256"), F.col("audit_sha"))),
    ]
    rules += [(f"token-audit-dataset:{s}", differ(text("audit", f"$.files.{s}.sha256"), F.try_element_at("split_sha", F.lit(s)))) for s in SPLITS]
    listed = F.from_json("result", "files array<struct<path string, bytes bigint, sha256 string>>")["files"]
    last = lambda name: F.try_element_at(F.filter(listed, lambda f: f["path"] == name), F.lit(-1))
    for name in PARTS:
        want = last(name)
        have = F.try_element_at("files", F.lit(name))
        gone = want.isNull() | have.isNull()
        rules.append((f"training-file:{name}", gone))
        rules.append((f"training-file-integrity:{name}", ~gone & (differ(want["bytes"], have["bytes"]) | differ(want["sha256"], have["sha256"]))))
    issues = F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in rules]), lambda x: x.isNotNull())
    return receipts.select("run", issues.alias("issues"))


#: What has to hold before an evaluation starts, as column conditions.
PRECONDITIONS = {
    "variant": "variant IN ('base', 'adapter')",
    "adapter-manifest": "variant = 'base' OR adapter_format IS NOT NULL",
    "base-pin": "base_name = pin_name AND base_bytes = pin_bytes AND base_sha256 = pin_sha256",
    "scale": "variant = 'base' OR scale = locked_scale OR tuning",
    "empty-split": "n_tasks > 0",
}


def unmet(runs: DataFrame, conditions: Mapping[str, str] = PRECONDITIONS) -> DataFrame:
    """runs with ``unmet``: the names of conditions that do not hold (null counts as not)."""
    rules = [F.when(~F.coalesce(F.expr(c), F.lit(False)), F.lit(n)) for n, c in conditions.items()]
    return runs.withColumn("unmet", F.filter(F.array(*rules), lambda x: x.isNotNull()))


def relative_paths(text: str, root: str) -> "F.Column":
    """A JSON text with absolute paths below root made relative, wherever they stand as strings."""
    return F.replace(F.replace(F.col(text), F.lit(f'"{root}/'), F.lit('"')), F.lit(f'"{root}"'), F.lit('"."'))


def comparison_label(tier: "F.Column", protocol: "F.Column", names: Mapping[str, str]) -> "F.Column":
    """tier-label, the label being the protocol's or 'evaluation'."""
    known = F.element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), protocol)
    return F.concat_ws("-", tier, F.coalesce(known, F.lit("evaluation")))
