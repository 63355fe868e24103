"""Model endpoints as a source of columns: a generator protocol, an HTTP client, a deterministic stub."""

from __future__ import annotations

import hashlib
import json
import random
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame

# The most requests in flight, and the statuses after which a request is sent again.
MAX_IN_FLIGHT = 32
RETRY_STATUS = frozenset({408, 409, 429, 500, 502, 503, 504})


@dataclass
class Reply:
    """A reply's text, or an error; and what it took."""

    text: str | None = None
    error: str | None = None
    prompt_tokens: int = 0
    completion_tokens: int = 0
    retries: int = 0


class Generator(Protocol):
    def generate(self, prompts: list[str], system: str, max_tokens: int, temperature: float) -> list[Reply]: ...


class StubGenerator:
    """Replies that depend on the prompt only: one JSON object that names the prompt's digest."""

    def __init__(self, envelope: str = "pairs"):
        self.envelope = envelope

    def generate(self, prompts: list[str], system: str, max_tokens: int, temperature: float) -> list[Reply]:
        out = []
        for p in prompts:
            digest = hashlib.md5(p.encode()).hexdigest()
            item = {"n": 1, "supported": int(digest, 16) % 2 == 0} if self.envelope == "verdicts" else {"type": "stub", "question": digest, "answer": digest}
            out.append(Reply(json.dumps({self.envelope: [item]}), None, len(p.split()), 8))
        return out


def clamp(requested: int, most: int = MAX_IN_FLIGHT) -> int:
    return max(1, min(requested, most))


def backoff(attempt: int) -> float:
    """Seconds before the next try: doubling up to a minute, from half of that to all of it."""
    return min(60.0, 2.0**attempt) * (0.5 + random.random() / 2)


class HttpGenerator:
    """Chat completions over HTTP, in two dialects; tries again on transient failures; errors are values."""

    def __init__(
        self, base_url: str, model: str, concurrency: int = MAX_IN_FLIGHT, timeout: float = 300.0, retries: int = 5,
        dialect: str = "openai", thinking: bool = False, json_mode: bool = False, sleep: Callable[[float], None] = time.sleep,
    ):
        if dialect not in ("openai", "ollama"):
            raise ValueError(f"unknown dialect {dialect}")
        self.base_url, self.model, self.timeout, self.retries = base_url.rstrip("/"), model, timeout, retries
        self.concurrency, self.dialect, self.thinking, self.json_mode, self.sleep = clamp(concurrency), dialect, thinking, json_mode, sleep

    def _body(self, prompt: str, system: str, max_tokens: int, temperature: float) -> tuple[str, dict]:
        messages = ([{"role": "system", "content": system}] if system else []) + [{"role": "user", "content": prompt}]
        if self.dialect == "ollama":
            body = {"model": self.model, "messages": messages, "stream": False, "think": self.thinking}
            body["options"] = {"temperature": temperature, "num_predict": max_tokens}
            return self.base_url.removesuffix("/v1") + "/api/chat", body | ({"format": "json"} if self.json_mode else {})
        body = {"model": self.model, "messages": messages, "max_tokens": max_tokens, "temperature": temperature}
        body["chat_template_kwargs"] = {"enable_thinking": self.thinking}
        return self.base_url + "/chat/completions", body | ({"response_format": {"type": "json_object"}} if self.json_mode else {})

    def _read(self, raw: dict, retries: int) -> Reply:
        if self.dialect == "ollama":
            return Reply(raw["message"]["content"], None, raw.get("prompt_eval_count", 0), raw.get("eval_count", 0), retries)
        usage = raw.get("usage") or {}
        return Reply(raw["choices"][0]["message"]["content"], None, usage.get("prompt_tokens", 0), usage.get("completion_tokens", 0), retries)

    def one(self, prompt: str, system: str, max_tokens: int, temperature: float) -> Reply:
        url, body = self._body(prompt, system, max_tokens, temperature)
        said = ""
        for attempt in range(self.retries + 1):
            request = urllib.request.Request(url, json.dumps(body).encode(), {"Content-Type": "application/json"})
            try:
                with urllib.request.urlopen(request, timeout=self.timeout) as r:
                    return self._read(json.loads(r.read()), attempt)
            except urllib.error.HTTPError as e:
                said = f"HTTP {e.code}"
                if e.code not in RETRY_STATUS:
                    return Reply(error=said, retries=attempt)
            except (OSError, ValueError, KeyError, IndexError, TypeError) as e:
                said = f"{type(e).__name__}: {e}"
            if attempt < self.retries:
                self.sleep(backoff(attempt))
        return Reply(error=said, retries=self.retries)

    def generate(
        self, prompts: list[str], system: str, max_tokens: int, temperature: float, done: Callable[[int, Reply], None] | None = None
    ) -> list[Reply]:
        """Replies in order of prompts; ``done`` hears of each, with its prompt's place, as it comes in."""

        def ask_one(i: int, prompt: str) -> Reply:
            reply = self.one(prompt, system, max_tokens, temperature)
            if done:
                done(i, reply)
            return reply

        with ThreadPoolExecutor(self.concurrency) as pool:
            return list(pool.map(ask_one, range(len(prompts)), prompts))

    def healthy(self) -> bool:
        """Whether the endpoint lists this very model."""
        try:
            with urllib.request.urlopen(self.base_url + "/models", timeout=10) as r:
                return any(m.get("id") == self.model for m in json.loads(r.read()).get("data", []))
        except (OSError, ValueError):
            return False


REPLY = "reply string, error string, prompt_tokens long, completion_tokens long, retries long"


def ask(
    prompts: DataFrame, make: Callable[[], Generator], key: str = "pmcid", system: str = "", max_tokens: int = 1024,
    temperature: float = 0.0, tasks: int | None = None,
) -> DataFrame:
    """key and reply columns for (key, prompt) rows. tasks times the generator's threads bounds what is in flight.

    Write the result before using it twice: a model may answer otherwise when asked again.
    """
    kind = dict(prompts.dtypes)[key]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        generator = make()
        for p in parts:
            replies = generator.generate(p["prompt"].tolist(), system, max_tokens, temperature)
            yield pd.DataFrame(
                {
                    key: p[key],
                    "reply": [r.text for r in replies],
                    "error": [r.error for r in replies],
                    "prompt_tokens": [r.prompt_tokens for r in replies],
                    "completion_tokens": [r.completion_tokens for r in replies],
                    "retries": [r.retries for r in replies],
                }
            )

    rows = prompts.select(key, "prompt")
    return (rows.repartition(tasks) if tasks else rows).mapInPandas(run, f"{key} {kind}, {REPLY}")
