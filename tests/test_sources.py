"""Headers of binary model files, and endpoints that answer well, slowly, badly or not at all."""

from __future__ import annotations

import json
import threading
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from prefmill.functions.text import chat_prompt
from prefmill.operators import generate
from prefmill.sources import gguf

KEYS = [("general.architecture", gguf.TEXT, "student"), ("general.type", gguf.TEXT, "adapter"), ("adapter.type", gguf.TEXT, "lora"), ("adapter.lora.alpha", 6, 16.0)]
TENSORS = [(f"{s}.lora_{x}", [4, 8], 1) for s in ("blk.0.q", "blk.1.v") for x in "ab"]


def swapped(name, kind, value):
    return [(n, kind, value) if n == name else (n, k, v) for n, k, v in KEYS]


CASES = {
    "good": (gguf.encoded(3, KEYS, TENSORS), []),
    "version": (gguf.encoded(2, KEYS, TENSORS), ["version"]),
    "count": (gguf.encoded(3, KEYS, TENSORS[:2]), ["tensor-count"]),
    "architecture": (gguf.encoded(3, swapped("general.architecture", gguf.TEXT, "other"), TENSORS), ["architecture"]),
    "type": (gguf.encoded(3, KEYS[:1] + KEYS[2:], TENSORS), ["type"]),
    "adapter-type": (gguf.encoded(3, swapped("adapter.type", 4, 1), TENSORS), ["adapter-type"]),
    "alpha": (gguf.encoded(3, swapped("adapter.lora.alpha", 6, 16.5), TENSORS), ["alpha"]),
    "pairs": (gguf.encoded(3, KEYS, [*TENSORS[:3], ("blk.2.v.lora_b", [1], 1)]), ["complete-pairs"]),
    "foreign": (gguf.encoded(3, KEYS, [*TENSORS[:2], ("x.weight", [1], 1), ("y.weight", [1], 1)]), ["foreign-tensor:x.weight", "foreign-tensor:y.weight"]),
    "f32": (gguf.encoded(3, KEYS, [*TENSORS[:3], ("blk.1.v.lora_b", [4, 8], 0)]), ["tensor-type:blk.1.v.lora_b"]),
    "cut": (gguf.encoded(3, KEYS, TENSORS)[:-5], ["broken:no GGUF header: it ends too early"]),
    "magic": (b"GGML" + bytes(50), ["broken:no GGUF header: another magic"]),
    "old": (gguf.encoded(1, KEYS, TENSORS), ["broken:no GGUF header: version 1"]),
    "huge": (b"GGUF" + (3).to_bytes(4, "little") + bytes(8) + (1).to_bytes(8, "little") + b"\xff" * 8, ["broken:no GGUF header: an entry is too large"]),
    "empty": (b"", ["broken:empty"]),
}


def test_each_check_can_fail(spark, tmp_path):
    for name, (data, _) in CASES.items():
        (tmp_path / name).write_bytes(data and data + b"\x01" * 64 if name not in ("cut", "empty") else data)
    parts = gguf.headers(spark, str(tmp_path), [*CASES, "gone"]).cache()
    got = {r["path"]: r["issues"] for r in gguf.adapter_issues(parts, 4, 16.0, "student").collect()}
    assert got == {n: i for n, (_, i) in CASES.items()} | {"gone": ["broken:missing"]}
    listed = parts.where("path = 'good' AND section = 'tensor'").orderBy("nth").collect()
    assert [(r["name"], r["type"], json.loads(r["value"])) for r in listed] == [(n, "F16", d) for n, d, _ in TENSORS] and listed[1]["offset"] == 32 * 13
    parts.unpersist()


def test_values_of_all_types(tmp_path):
    keys = [(f"k{k}", k, True if k == 7 else 2.5 if k in (6, 12) else 3) for k in gguf.SCALARS]
    keys += [("short", gguf.LIST, (gguf.TEXT, ["a", "é"])), ("long", gguf.LIST, (5, list(range(100)))), ("texts", gguf.LIST, (gguf.TEXT, ["t"] * 70)), ("nested", gguf.LIST, (gguf.LIST, [(0, [1]), (0, [])]))]
    path = tmp_path / "all"
    path.write_bytes(gguf.encoded(3, keys, []))
    with open(path, "rb") as file:
        got = {name: json.loads(value) for section, _, name, _, value, _ in gguf.header(file) if section == "key"}
    want = {n: v for n, k, v in keys if k != gguf.LIST}
    assert got == want | {"short": ["a", "é"], "long": {"count": 100}, "texts": {"count": 70}, "nested": [[1], []]}


# -- endpoints -------------------------------------------------------------------


@pytest.fixture
def server():
    """Answers by what the prompt asks for; counts what it is asked."""
    seen: list[dict] = []

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            seen.append({"path": self.path, **body})
            text = body.get("prompt") or body["messages"][-1]["content"]
            tries = sum(text == (s.get("prompt") or s["messages"][-1]["content"]) for s in seen)
            if "slow" in text and tries < 2:
                time.sleep(1.5)
            answer = {"content": f"to {text[-40:]}", "tokens_predicted": 7, "tokens_evaluated": 3, "timings": {"predicted_per_second": 2.5}, "model": "m"}
            if "messages" in body:
                answer = {"choices": [{"message": {"content": "hi"}, "finish_reason": "stop"}], "usage": {"completion_tokens": 4}}
            if "number" in text:
                answer = {"content": 5} if "prompt" in body else {"choices": [{"message": {"content": None}}]}
            if "list" in text:
                answer = []
            raw = b"{" if "broken" in text else json.dumps(answer).encode()
            code = 503 if "busy" in text and tries < 3 else 400 if "refused" in text else 200
            try:
                self.send_response(code)
                self.end_headers()
                self.wfile.write(raw)
            except OSError:
                pass

        def log_message(self, *args):
            pass

    httpd = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=httpd.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{httpd.server_port}", seen
    httpd.shutdown()


USE = {"max_tokens": 9, "temperature": 0.0, "top_p": 1.0, "seed": 4}
ask = lambda text: [{"role": "user", "content": text}]


def test_completions_are_texts(server):
    url, seen = server
    source = generate.completion_source(url, lambda m: m[-1]["content"], timeout=0.5, tries=3, wait=0.01)
    got = source(ask("good"), USE)
    assert got["text"] == "to good" and got["metrics"]["generation_tokens"] == 7 and got["metrics"]["tokens_per_second"] == 2.5 and got["receipt"] == {"model": "m"}
    assert seen[0] == {"path": "/completion", "prompt": "good", "n_predict": 9, "temperature": 0.0, "top_p": 1.0, "seed": 4, "cache_prompt": False}
    # what may pass is asked again: a timeout, a busy server
    assert source(ask("slow"), USE)["text"] == "to slow" and source(ask("busy"), USE)["text"] == "to busy"
    assert [s["prompt"] for s in seen] == ["good", "slow", "slow", "busy", "busy", "busy"]
    # what would not pass is an error at once
    for text in ("number", "list", "broken"):
        with pytest.raises(generate.Malformed):
            source(ask(text), USE)
    with pytest.raises(OSError):
        source(ask("refused"), USE)
    assert [s["prompt"] for s in seen[6:]] == ["number", "list", "broken", "refused"]
    with pytest.raises(OSError):
        generate.completion_source("http://127.0.0.1:9", lambda m: "", timeout=0.2, tries=2, wait=0.01)(ask("x"), USE)


def test_chat_answers_are_texts(server):
    url, _ = server
    source = generate.http_source(f"{url}/v1/chat", "m", timeout=2, tries=2, wait=0.01)
    assert source(ask("good"), USE)["text"] == "hi"
    for text in ("number", "list", "broken"):
        with pytest.raises(generate.Malformed):
            source(ask(text), USE)


def test_attempts_over_an_endpoint(spark, server):
    url, seen = server
    source = generate.completion_source(url, generate.prompt_text, timeout=5)
    rows = spark.createDataFrame([(i, ask(f"task {i}"), i) for i in range(4)], "id int, messages array<struct<role:string,content:string>>, seed int")
    got = generate.attempts(rows, source, lambda text: [] if "needs" in text else ["again"], most=2).collect()
    assert len(got) == 8 and len(seen) == 8 and all(r["text"].startswith("to ") for r in got)
    assert sum("That answer was not admitted" in s["prompt"] for s in seen) == 4


def test_prompts_of_the_boundary_are_those_of_queries(spark):
    turns = [[{"role": "system", "content": " be <|turn> brief "}, {"role": "user", "content": "a <tool_call|> b <|tool_response>\n"}], [{"role": "assistant", "content": "x"}]]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(turns)], "i int, m array<struct<role:string,content:string>>")
    assert [r["p"] for r in d.orderBy("i").select(chat_prompt(F.col("m")).alias("p")).collect()] == [generate.prompt_text(t) for t in turns]
