"""The corpus workflow end to end, composed of the operators: teacher, critic, manifest, evaluation.

Each function takes and returns DataFrames; models are injected callables at the
generator boundary. Resumed work is told by id and content hash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefmill.functions import json as J
from prefmill.operators import admission, contracts, corpus, evaluate
from prefmill.operators.generate import Complete, greedy, rounds


def task_hash(tasks: DataFrame) -> DataFrame:
    """tasks with ``hash``: their content's identity."""
    body = F.to_json(F.struct("category", "contract", "id", "messages", "oracle", "split"))
    return tasks.withColumn("hash", F.sha2(body, 256))


def numbered(work: DataFrame, order: str | list[str] = "id") -> DataFrame:
    """work with ``pos``, its 0-based place in its own order; seeds follow from it, so it is told before done rows are left out."""
    return work if "pos" in work.columns else admission.positions(work, order)


def answers(tasks: DataFrame, complete: Complete, seed_of=admission.generation_seed, most: int = 3, order: str = "id") -> DataFrame:
    """Every attempt at each task (task columns, attempt, text, issues, settings, metrics, receipt), until its contract finds nothing.

    A column ``pos`` of tasks is their place; without one it is told by ``order``.
    """
    seeded = numbered(tasks, order).withColumn("seed", seed_of(F.col("pos"), F.lit(0)).cast("bigint")).drop("pos")
    tokens = lambda attempt: admission.token_budget(F.col("contract"), F.lit(attempt))
    only = _contracts(tasks)
    return rounds(seeded, complete, lambda rows: contracts.validate(rows, answer="text", only=only), most, tokens=tokens)


def _contracts(tasks: DataFrame) -> tuple[str, ...]:
    """The contracts that occur, a handful: validators of others stay out of the plan."""
    return tuple(sorted(r[0] or "" for r in tasks.select("contract").distinct().collect()))


def answer(tasks: DataFrame, complete: Complete, seed_of=admission.generation_seed, most: int = 3, order: str = "id") -> DataFrame:
    """The last attempt at each task."""
    return admission.latest(answers(tasks, complete, seed_of, most, order), "id", "attempt").drop("seed")


def teacher(
    tasks: DataFrame, split: str, complete: Complete, prior: DataFrame | None = None, limit: int | None = None, most: int = 3, order: str = "id"
) -> DataFrame:
    """Teacher rows of a split: id, status (admitted, excluded), chosen, rejected, issues, attempts, settings, metrics, receipt, hash.

    A task's seeds follow from its place among all tasks of the run, in ``order`` (with a limit: in the order of its rounds), done ones
    included, so a resumed run asks as a fresh one would. A task is tried ``most`` times at most, each retry being told the issues of the answer before;
    issues are those of the last. Prior rows with a current hash are kept, excluded ones too: they are not tried again.
    """
    work = task_hash(tasks.where(F.col("split") == split))
    if limit is not None:
        work = numbered(admission.stratified_limit(work, limit, "category", order), ["round", "category"]).drop("round")
    work = numbered(work, order)
    kept = None if prior is None else admission.retained(prior, work)
    todo = work if kept is None else admission.pending(work, kept)
    answered = contracts.construct_rejected(answer(todo, complete, most=most), answer="text", only=_contracts(work))
    turns = lambda text: F.array_append("messages", F.struct(F.lit("assistant").alias("role"), text.alias("content")))
    good = F.size("issues") == 0
    fresh = answered.select(
        "id", F.when(good, "admitted").otherwise("excluded").alias("status"), "split", "category", "contract", turns(F.col("text")).alias("chosen"),
        turns(F.col("rejected")).alias("rejected"), "issues", (F.col("attempt") + 1).alias("attempts"), "settings", "metrics", "receipt", "hash",
    )
    return fresh if kept is None else kept.unionByName(fresh)


#: What the critic is told of a judgment that is malformed.
MALFORMED = "That was not the JSON object asked for ({issues}). Send all five fields and no other text; preferred is A, B or tie."


def critic(rows: DataFrame, complete: Complete, prior: DataFrame | None = None, most: int = 2, order: str = "id") -> DataFrame:
    """Evidence on admitted teacher rows: id, status, chosen_label, judgment, valid_shapes, settings, metrics, receipt, hash, seq.

    A malformed judgment is asked for again, ``most`` times at most; valid_shapes tells of each
    attempt. Valid judgments with a current hash are kept, rejections too; malformed ones are asked
    for again in the next run, with the seeds that their places among all admitted rows give. seq counts the runs: a
    later one's evidence counts.
    """
    body = F.to_json(F.struct("category", "chosen", "contract", "id", "rejected"))
    work = numbered(rows.where("status = 'admitted'").withColumn("hash", F.sha2(body, 256)), order)
    kept = None if prior is None else admission.retained(prior, work, usable=admission.judgment_shape(F.col("judgment")))
    todo = work if kept is None else admission.pending(work, kept)
    run = 0 if kept is None else (kept.agg(F.max("seq")).first()[0] or 0)
    turn = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    asked = admission.judge_pairs(todo).select("id", "chosen_label", F.array(turn("system", F.col("system")), turn("user", F.col("message"))).alias("messages"))
    asked = asked.join(todo.select("id", admission.critic_seed(F.col("pos"), F.lit(0)).cast("bigint").alias("seed")), "id")

    def shaped(got: DataFrame) -> DataFrame:
        got = got.withColumn("judgment", J.extract_object(F.col("text")))
        none = F.array().cast("array<string>")
        return got.withColumn("issues", F.when(admission.judgment_shape(F.col("judgment")), none).otherwise(F.array(F.lit("judgment-shape"))))

    log = rounds(asked, complete, shaped, most, settings=greedy, tokens=lambda attempt: F.lit(256), retry=MALFORMED)
    shapes = log.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("attempt", (F.size("issues") == 0).alias("ok")))), lambda x: x["ok"]).alias("valid_shapes"))
    last = admission.latest(log, "id", "attempt").join(shapes, "id").join(todo.select("id", "hash"), "id")
    status = F.when(admission.admitted(F.col("judgment"), F.col("chosen_label")), "critic-admitted").otherwise("critic-rejected")
    fresh = last.select(
        "id", status.alias("status"), "chosen_label", "judgment", "valid_shapes", "settings", "metrics", "receipt", "hash", F.lit(run + 1).cast("bigint").alias("seq")
    )
    return fresh if kept is None else kept.unionByName(fresh)


def preference_corpus(rows: DataFrame, evidence: DataFrame, prefix: str = "pref") -> DataFrame:
    """Training pairs: teacher rows whose latest evidence admits them, with provenance."""
    last = admission.latest(evidence, "id", "seq")
    good = rows.join(last.where("status = 'critic-admitted'").select("id"), "id", "left_semi")
    return corpus.provenance(good, prefix).select("id", "category", F.col("corpus_split").alias("split"), "domain", "group_id", "chosen", "rejected")


def manifest(pairs: DataFrame, gate: corpus.Gate = corpus.RESEARCH) -> dict[str, DataFrame]:
    """The parts of a dataset manifest; each is a small aggregate."""
    return {
        "splits": corpus.split_counts(pairs),
        "domains": corpus.domain_counts(pairs),
        "groups": corpus.group_identity(pairs),
        "leakage": corpus.leakage(pairs),
        "duplicates": corpus.duplicates(pairs),
        "gate": corpus.gate_issues(pairs, gate),
    }


def evaluation(tasks: DataFrame, split: str, complete: Complete, order: str = "id") -> DataFrame:
    """Result rows (id, category, contract, issues, text, metrics, receipt, status) of a locked split, one attempt each."""
    seeds = lambda position, attempt: admission.evaluation_seed(position)
    got = answer(tasks.where(F.col("split") == split), complete, seeds, 1, order)
    return got.select("id", "category", "contract", "issues", "text", "metrics", "receipt", F.when(F.size("issues") == 0, "pass").otherwise("fail").alias("status"))


def report(results: DataFrame) -> dict[str, DataFrame]:
    """The parts of an evaluation report."""
    return {
        "overall": evaluate.summarize_overall(results), "categories": evaluate.summarize_by_category(results), "issues": evaluate.issue_histogram(results),
        "metrics": evaluate.run_metrics(results, "metrics.generation_tokens", "metrics.tokens_per_second", "metrics.peak_memory_gb"),
    }
