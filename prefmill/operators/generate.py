"""The boundary to a model: an injected callable, with retries that feed issues back.

A callable takes (messages, settings) and returns either the text or a mapping with
``text`` and, where the backend knows them, ``metrics`` and ``receipt``. Settings are
max_tokens, temperature, top_p and seed; each attempt has its own.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator, Mapping
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefmill.functions.workers import importable
from prefmill.sources.shared import kept

Settings = Mapping[str, Any]
Complete = Callable[[list[dict[str, str]], Settings], "str | Mapping[str, Any]"]
Check = Callable[[str], list[str]]

METRICS = {
    "prompt_tokens": "bigint", "generation_tokens": "bigint", "tokens_per_second": "double", "peak_memory_gb": "double", "elapsed_seconds": "double", "finish_reason": "string",
}
GENERATED = f"settings string, metrics struct<{', '.join(f'{k}:{v}' for k, v in METRICS.items())}>, receipt string"
#: What a retry is told of the answer before it; {issues} is a JSON list.
RETRY = "That answer was not admitted: {issues}. Send the whole JSON object again with these points corrected, and nothing else."


def echo(messages: list[dict[str, str]], settings: Settings) -> str:
    """A stand-in model: the last message and the seed as JSON."""
    return json.dumps({"seed": settings["seed"], "text": messages[-1]["content"]}, sort_keys=True)


def fixed(attempt: int, seed: int, most_tokens: int) -> dict[str, Any]:
    """Greedy at first, a little freer on retries; seeds step by one."""
    return {"max_tokens": most_tokens, "temperature": 0.15 if attempt else 0.0, "top_p": 0.9 if attempt else 1.0, "seed": seed + attempt}


def greedy(attempt: int, seed: int, most_tokens: int) -> dict[str, Any]:
    """A judge's settings: always greedy, seeds far apart."""
    return {"max_tokens": most_tokens, "temperature": 0.0, "top_p": 1.0, "seed": seed + 100_000 * attempt}


def http_source(url: str, model: str, timeout: float = 600.0, tries: int = 3, wait: float = 1.0) -> Complete:
    """A completion source that posts to a chat endpoint of the common JSON form (choices, usage)."""

    def complete(messages: list[dict[str, str]], settings: Settings) -> Mapping[str, Any]:
        began = time.perf_counter()
        got = _posted(url, {"model": model, "messages": messages, **settings}, timeout, tries, wait)
        took = time.perf_counter() - began
        try:
            first, usage = got["choices"][0], got.get("usage") or {}
            text = first["message"]["content"]
        except (LookupError, TypeError, AttributeError) as e:
            raise Malformed(f"{url} answered without a choice") from e
        if not isinstance(text, str):
            raise Malformed(f"{url} answered with no text in content")
        made = usage.get("completion_tokens")
        metrics = {
            "prompt_tokens": usage.get("prompt_tokens"), "generation_tokens": made, "elapsed_seconds": took, "finish_reason": first.get("finish_reason"),
            "tokens_per_second": made / took if made and took else None, "peak_memory_gb": None,
        }
        return {"text": text, "metrics": metrics, "receipt": {"model": got.get("model", model)}}

    return complete


class Malformed(ValueError):
    """A completion that is no completion: asking again would not mend it."""


def _posted(url: str, body: Mapping[str, Any], timeout: float, tries: int, wait: float) -> Any:
    """The JSON answer to a JSON request; timeouts, refused connections and errors of the server's side are tried again, ever later."""
    import urllib.error
    import urllib.request

    data = json.dumps(body, separators=(",", ":")).encode()
    for n in range(tries):
        request = urllib.request.Request(url, data, {"Content-Type": "application/json"})
        try:
            with urllib.request.urlopen(request, timeout=timeout) as answer:
                raw = answer.read()
            break
        except urllib.error.HTTPError as e:
            if e.code < 500 and e.code != 429 or n + 1 == tries:
                raise
        except (TimeoutError, OSError):  # URLError is an OSError
            if n + 1 == tries:
                raise
        time.sleep(wait * 2**n)
    try:
        return json.loads(raw)
    except ValueError as e:
        raise Malformed(f"{url} answered with no JSON: {raw[:80]!r}") from e


def completion_source(url: str, prompt: Callable[[list[dict[str, str]]], str], timeout: float = 600.0, tries: int = 3, wait: float = 1.0) -> Complete:
    """A source that posts prompts to ``/completion`` below url and takes the text in ``content``.

    prompt: messages to the one text that the model continues. An answer that is no object, or whose content is no
    text, is an error.
    """

    def complete(messages: list[dict[str, str]], settings: Settings) -> Mapping[str, Any]:
        asked_ = {"prompt": prompt(messages), "n_predict": settings["max_tokens"], **{k: settings[k] for k in ("temperature", "top_p", "seed") if k in settings}, "cache_prompt": False}
        began = time.perf_counter()
        got = _posted(url.rstrip("/") + "/completion", asked_, timeout, tries, wait)
        took = time.perf_counter() - began
        if not isinstance(got, dict) or not isinstance(got.get("content"), str):
            raise Malformed(f"{url} answered with no text in content")
        times = got.get("timings") if isinstance(got.get("timings"), dict) else {}
        metrics = {
            "prompt_tokens": got.get("tokens_evaluated"), "generation_tokens": got.get("tokens_predicted"), "elapsed_seconds": took,
            "tokens_per_second": times.get("predicted_per_second"), "peak_memory_gb": None, "finish_reason": "length" if got.get("stopped_limit") else "stop",
        }
        return {"text": got["content"], "metrics": metrics, "receipt": {"model": got.get("model")}}

    return complete


def prompt_text(messages: list[dict[str, str]]) -> str:
    """What ``functions.text.chat_prompt`` makes of messages, for one at a time at the boundary."""
    import re

    from prefmill.functions.text import MARKERS

    names = "|".join(sorted(MARKERS, key=len, reverse=True))

    def turn(m: Mapping[str, str]) -> str:
        body = re.sub(rf"<\|({names})>", r"< |\1>", m["content"].strip())
        body = re.sub(rf"<({names})\|>", r"<\1| >", body)
        return f"<|turn>{'model' if m['role'] == 'assistant' else m['role']}\n{body}<turn|>\n"

    return "".join(map(turn, messages)) + "<|turn>model\n"


def asked(base: list[dict[str, str]], text: str | None, issues: list[str], retry: str = RETRY) -> list[dict[str, str]]:
    """The messages of an attempt: the task's own, and after a first one its last answer with what was wrong with it."""
    if text is None:
        return base
    return [*base, {"role": "assistant", "content": text}, {"role": "user", "content": retry.replace("{issues}", json.dumps(issues))}]


def generated(got: str | Mapping[str, Any], use: Settings) -> tuple[str, str, dict[str, Any], str | None]:
    """(text, settings, metrics, receipt) as rows hold them."""
    got = {"text": got} if isinstance(got, str) else got
    metrics = got.get("metrics") or {}
    receipt = json.dumps(got["receipt"], sort_keys=True) if got.get("receipt") is not None else None
    return got["text"], json.dumps(use, sort_keys=True), {m: metrics.get(m) for m in METRICS}, receipt


def attempts(
    rows: DataFrame, complete: Complete, check: Check | Callable[[str, Mapping[str, Any]], list[str]], most: int = 3, seed: str = "seed", key: str = "id",
    settings: Callable[[int, int, int], Settings] = fixed, tokens: tuple[str, str] | int = 700, retry: str = RETRY, context: tuple[str, ...] = (),
) -> DataFrame:
    """(key, attempt, text, issues, settings, metrics, receipt) of every attempt until one has no issue, ``most`` at the most.

    rows: key, messages, seed. Each retry starts from the row's own messages and shows the model its last
    answer and what was wrong with it, no earlier ones. tokens: a number, or the columns with the
    bounds of the first and of later attempts. context: columns that ``check`` gets as a
    second argument. Missing metrics are null.
    """
    importable(rows.sparkSession)
    kind = dict(rows.dtypes)[key]
    bounds = () if isinstance(tokens, int) else tokens

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for r in f.to_dict("records"):
                base = [dict(role=m["role"], content=m["content"]) for m in r["messages"]]
                text, issues = None, []
                for n in range(most):
                    use = settings(n, int(r[seed]), int(r[bounds[min(n, 1)]]) if bounds else int(tokens))
                    text, *told = generated(complete(asked(base, text, issues, retry), use), use)
                    issues = check(text, {c: r[c] for c in context}) if context else check(text)
                    out.append((r[key], n, text, issues, *told))
                    if not issues:
                        break
            yield pd.DataFrame(out, columns=[key, "attempt", "text", "issues", "settings", "metrics", "receipt"])

    need = [key, "messages", seed, *bounds, *context]
    return rows.select(*dict.fromkeys(need)).mapInPandas(run, f"{key} {kind}, attempt int, text string, issues array<string>, {GENERATED}")


def rounds(
    rows: DataFrame, complete: Complete, judge: Callable[[DataFrame], DataFrame], most: int = 3, key: str = "id", settings: Callable[[int, int, int], Settings] = fixed,
    tokens: Callable[[int], Column] = lambda attempt: F.lit(700), retry: str = RETRY,
) -> DataFrame:
    """Like ``attempts`` where the check is a query: judge adds ``issues`` to rows with ``text``.

    rows: key, messages, seed and what judge needs. Each round asks for the rows that still have
    issues, is written, and so never runs twice. The result has every attempt's row.
    """
    log, waiting = None, rows
    for n in range(most):
        asked = waiting
        if log is not None:
            said = F.replace(F.lit(retry), F.lit("{issues}"), F.to_json("issues"))
            turn = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
            turns = F.concat("messages", F.array(turn("assistant", F.col("text")), turn("user", said)))
            asked = waiting.withColumn("messages", turns)
        asked = asked.select(key, "messages", "seed", tokens(n).cast("int").alias("max_tokens"))
        begin = lambda attempt, seed, bound, n=n: settings(n, seed, bound)
        got = attempts(asked, complete, lambda text: [], 1, key=key, settings=begin, tokens=("max_tokens", "max_tokens")).drop("issues", "attempt")
        got = kept(got, "generated")
        base = waiting.select(*rows.columns)
        done = kept(judge(base.join(got, key).withColumn("attempt", F.lit(n))), "attempts")
        log = done if log is None else log.unionByName(done)
        waiting = done.where(F.size("issues") > 0)
        if waiting.isEmpty():
            break
    return log
