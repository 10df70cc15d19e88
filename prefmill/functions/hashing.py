"""Canonical forms and their hashes."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from decimal import Decimal

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def row_hash(row: Column) -> Column:
    """Hash of a struct's compact JSON; name its fields in ascending order. Non-ASCII stays, nulls are written."""
    return sha256(F.to_json(row, {"ignoreNullFields": "false"}))


def blind_label(identity: Column) -> Column:
    """A if the identity's hash is even, else B."""
    return F.when(F.conv(F.right(sha256(identity), F.lit(1)), 16, 10).cast("int") % 2 == 0, "A").otherwise("B")


def list_hash(items: Column) -> Column:
    """Hash of an array's JSON."""
    return sha256(F.to_json(items))


def number(x: float) -> str:
    """A finite number as ECMAScript spells it: shortest digits, exponent only outside 1e-6 .. 1e21."""
    if not math.isfinite(x):
        raise ValueError("a canonical form has finite numbers only")
    if x == 0:
        return "0"
    sign, digits, exponent = Decimal(repr(x)).normalize().as_tuple()
    text = "".join(map(str, digits))
    point = len(text) + exponent  # digits before the point
    if 0 < point <= 21:
        out = text[:point].ljust(point, "0") + ("." + text[point:] if len(text) > point else "")
    elif -6 < point <= 0:
        out = "0." + "0" * -point + text
    else:
        out = text[0] + ("." + text[1:] if len(text) > 1 else "") + f"e{point - 1:+d}"
    return "-" + out if sign else out


def canonical(value: object, ascii_only: bool = False, plain_numbers: bool = False) -> str:
    """Compact JSON with sorted keys. ascii_only: \\u escapes; plain_numbers: numbers by number()."""
    if not plain_numbers:
        return json.dumps(value, ensure_ascii=ascii_only, separators=(",", ":"), sort_keys=True)
    if isinstance(value, dict):
        if any(not isinstance(k, str) for k in value):
            raise ValueError("a canonical form has string keys only")
        body = ",".join(f"{json.dumps(k, ensure_ascii=ascii_only)}:{canonical(value[k], ascii_only, True)}" for k in sorted(value))
        return "{" + body + "}"
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(canonical(x, ascii_only, True) for x in value) + "]"
    if isinstance(value, float):
        return number(value)
    return json.dumps(value, ensure_ascii=ascii_only)


def _canonical_udf(ascii_only: bool, plain_numbers: bool):
    @F.pandas_udf(T.StringType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield b.map(lambda s: None if s is None else canonical(json.loads(s), ascii_only, plain_numbers))

    return run


#: JSON text to canonical text; Python does it where escapes and number spelling must be exact.
canonical_json = _canonical_udf(False, False)
canonical_ascii = _canonical_udf(True, False)
canonical_numbers = _canonical_udf(False, True)


#: The parts of a dataset manifest that make up its identity; times and paths do not.
IDENTITY_PARTS = (
    "schemaVersion", "status", "promotable", "primaryPreferenceEvidence", "holdoutBoundary", "counts", "domains", "evidenceCounts", "instructorDomainCounts",
    "modelJudgeDomainCounts", "domainGroupCounts", "groupIdentity", "splitIdentity", "trainingFormat", "gate", "leakage", "files",
)


def dataset_identity(manifest: dict, protocol: str = "dataset-identity-v2") -> str:
    """A hash of what a manifest says about its data; receipts count by status, size and hash alone."""
    import hashlib

    def receipt(r: dict) -> dict:
        keys = ("status", "bytes", "sha256") if r.get("status") == "verified" else ("status",)
        return {k: r.get(k) for k in keys}

    body = {k: manifest.get(k) for k in IDENTITY_PARTS}
    body["protocol"] = protocol
    body["sourceReceipts"] = [receipt(r) for r in manifest.get("sourceReceipts", [])]
    body["domainMap"] = {k: manifest.get("domainMap", {}).get(k) for k in ("entries", "sha256")}
    return hashlib.sha256(canonical(body).encode()).hexdigest()


@F.pandas_udf(T.StringType())
def dataset_identities(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """``dataset_identity`` of manifests as JSON texts."""
    for b in batches:
        yield b.map(lambda s: None if s is None else dataset_identity(json.loads(s)))
