"""The registry of pinned models: a small fixed table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = (
    "name string, role string, model_id string, revision string, format string, license string, "
    "filename string, bytes bigint, sha256 string, required boolean"
)
#: Names, revisions, sizes and hashes of the models that runs are pinned to.
PINS = [
    ("teacher", "primary-teacher", "mlx-community/Qwen3.6-27B-8bit", "c5a593c1475a746e43a543b0a02bd2b357e5745f",
     "mlx-8bit-safetensors", "Apache-2.0", None, None, None, True),
    ("critic", "independent-critic", "mlx-community/gemma-4-31b-it-4bit", "696d436c404745a59f30e4939a658162b0a9e57f",
     "mlx-affine-4bit-safetensors", "Apache-2.0", None, 18444421751, None, True),
    ("optional-teacher", "optional-escalation-teacher", "mlx-community/Qwen3.5-122B-A10B-OptiQ-2bit", "1081c89e171447884d329abd7232566ebd38737c",
     "mlx-optiq-2bit-safetensors", "Apache-2.0", None, None, None, False),
    ("lite-train", "student-lite-training-base", "google/gemma-4-E2B-it-qat-q4_0-unquantized", "1ca4dd94b623b6e0dd9da00c2239ab84b4f3e5ce",
     "gemma4-qat-unquantized-safetensors", "Apache-2.0", "model.safetensors", None,
     "33fe0cece08fb527ffefbd1a3a9ce73bd71073727993a283506293e5c6bf0137", True),
    ("lite-runtime", "student-lite-runtime-base", "google/gemma-4-E2B-it-qat-q4_0-gguf", "69536a21d70340464240401ba38223d805f6a709",
     "gguf-q4_0", "Apache-2.0", "gemma-4-E2B_q4_0-it.gguf", 3349514112,
     "3646b4c147cd235a44d91df1546d3b7d8e29b547dbe4e1f80856419aa455e6fd", True),
    ("pro-train", "student-pro-training-base", "google/gemma-4-12B-it-qat-q4_0-unquantized", "b8dea52d5ea56a20e8872f0ee5d25ada7501327e",
     "gemma4-qat-unquantized-safetensors", "Apache-2.0", "model.safetensors", None,
     "26f2cee4292298a3f9f92209643c37c80e34e011381e22434088870d9439a0a0", True),
    ("pro-runtime", "student-pro-runtime-base", "google/gemma-4-12B-it-qat-q4_0-gguf", "52fc21bb53de9eee244769c432935eeee38488eb",
     "gguf-q4_0", "Apache-2.0", "gemma-4-12b-it-qat-q4_0.gguf", 6975878912,
     "1e76e46623deaa4db97d4ef272ceab0dfb767c0f34c2c76524837edf2b57a510", True),
]


def registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PINS, SCHEMA)


def student(spark: SparkSession, tier: str, runtime: bool = False) -> DataFrame:
    """The pin of the model that a student tier is trained from, or that it runs on; the tier's case does not matter."""
    pins = registry(spark).where(F.col("role").startswith("student-"))
    asked = pins.where((F.split_part("name", F.lit("-"), F.lit(1)) == F.lower(F.lit(tier))) & (F.col("name").endswith("runtime") == F.lit(runtime)))
    if asked.isEmpty():
        raise ValueError(f"no student model has the tier {tier!r}")
    return asked


def students(asked: DataFrame, tier: str = "tier", runtime: str = "runtime") -> DataFrame:
    """asked with the pin (name, role, model, revision, bytes, sha256 ... as ``pin``) of each row's tier, the model it is trained from or runs on; null for an unknown tier."""
    pins = registry(asked.sparkSession).where(F.col("role").startswith("student-"))
    pins = pins.select(F.split_part("name", F.lit("-"), F.lit(1)).alias("_tier"), F.col("name").endswith("runtime").alias("_runs"), F.struct("*").alias("pin"))
    return asked.join(F.broadcast(pins), (F.lower(F.col(tier)) == F.col("_tier")) & (F.col(runtime) == F.col("_runs")), "left").drop("_tier", "_runs")
