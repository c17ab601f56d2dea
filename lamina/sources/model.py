"""The model as a pluggable source of answers. Offline it is a replay of kept answers or a rule."""

from __future__ import annotations

import json
import os
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What a client is: prompt -> text.
Client = Callable[[str], str]


#: Where known services answer, their usual model, and the variable that holds the key. Fixed values.
PRESETS = {
    "anthropic": ("https://api.anthropic.com", "claude-3-5-sonnet-20241022", "ANTHROPIC_API_KEY"),
    "openai": ("https://api.openai.com/v1", "gpt-4o", "OPENAI_API_KEY"),
    "deepseek": ("https://api.deepseek.com/anthropic", "deepseek-v4-flash", "DEEPSEEK_API_KEY"),
    "minimax": ("https://api.minimaxi.com/anthropic", "MiniMax-M3", "ANTHROPIC_AUTH_TOKEN"),
}


def dotenv(folder: str | None = None) -> dict[str, str]:
    """KEY=value lines of the nearest ``.env`` at or above ``folder``; comments, ``export`` and quotes are understood."""
    at = os.path.abspath(folder or os.getcwd())
    while not os.path.isfile(os.path.join(at, ".env")):
        if os.path.dirname(at) == at:
            return {}
        at = os.path.dirname(at)
    out = {}
    with open(os.path.join(at, ".env"), encoding="utf-8") as f:
        for line in f:
            name, sep, value = line.strip().removeprefix("export ").partition("=")
            if sep and name.strip() and not name.startswith("#"):
                out[name.strip()] = value.strip().strip("\"'")
    return out


@dataclass(frozen=True)
class Endpoint:
    """Where and how to ask. Arguments override environment variables, these a ``.env`` file, and that the preset of the provider."""

    url: str = ""
    model: str = ""
    api_key: str = ""
    max_tokens: int = 8192
    options: dict = field(default_factory=dict)

    @classmethod
    def resolve(cls, provider: str | None = None, folder: str | None = None, **given: object) -> Endpoint:
        env = dotenv(folder) | dict(os.environ)
        provider = provider or env.get("LAMINA_PROVIDER")
        if provider and provider not in PRESETS:
            raise ValueError(f"unknown provider {provider}")
        url, name, key = PRESETS.get(provider or "", (None, None, ""))
        low = {"url": url, "model": name, "api_key": env.get(key)}
        own = {"url": env.get("LAMINA_URL"), "model": env.get("LAMINA_MODEL"), "api_key": env.get("LAMINA_API_KEY")}
        some = lambda d: {k: v for k, v in d.items() if v is not None}
        return cls(**(some(low) | some(own) | some(given)))

    def masked(self) -> dict:
        key = self.api_key
        return {"url": self.url, "model": self.model, "api_key": key[:3] + "…" + key[-2:] if len(key) > 8 else "…" if key else "", "options": self.options}


def _post(endpoint: Endpoint, body: dict, timeout: float) -> object:
    head = {"content-type": "application/json", "x-api-key": endpoint.api_key, "authorization": f"Bearer {endpoint.api_key}", "anthropic-version": "2023-06-01"}
    return urllib.request.urlopen(urllib.request.Request(endpoint.url.rstrip("/") + "/v1/messages", json.dumps(body).encode(), head), timeout=timeout)


def _streamed(response: object) -> str:
    """The text of a stream of events: the deltas of each block, blocks in order."""
    blocks: dict[int, list[str]] = {}
    for raw in response:
        line = raw.decode("utf-8", "replace").strip()
        if not line.startswith("data:"):
            continue
        try:
            event = json.loads(line[5:])
        except ValueError:
            continue
        if event.get("type") == "content_block_delta" and event.get("delta", {}).get("type") == "text_delta":
            blocks.setdefault(event.get("index", 0), []).append(event["delta"].get("text", ""))
        if event.get("type") == "error":
            raise RuntimeError(str(event.get("error")))
    return "".join("".join(blocks[i]) for i in sorted(blocks))


def http_client(endpoint: Endpoint, timeout: float = 600.0) -> Client:
    """A client for an HTTP service of messages. A request the service refuses as it stands (400) is sent again as a stream; other failures raise."""

    def call(prompt: str) -> str:
        body = {"model": endpoint.model, "max_tokens": endpoint.max_tokens, "messages": [{"role": "user", "content": prompt}]} | endpoint.options
        try:
            with _post(endpoint, body, timeout) as r:
                answer = json.loads(r.read())
        except urllib.error.HTTPError as e:
            if e.code != 400:
                raise
            with _post(endpoint, body | {"stream": True}, timeout) as r:
                return _streamed(r)
        return next((b["text"] for b in answer.get("content", []) if b.get("type") == "text" and b.get("text") is not None), "")

    return call


def ask(prompts: DataFrame, client: Client, tries: int = 3, pause: float = 2.0) -> DataFrame:
    """doc_id, batch_index, raw_text, error, seconds. ``prompts``: doc_id, batch_index, prompt.

    Runs on the executors, one call at a time per task. A call that keeps failing gives a row with
    an error, so one bad batch does not stop the others.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for doc, b, prompt in zip(pdf["doc_id"], pdf["batch_index"], pdf["prompt"]):
                began, text, error = time.monotonic(), None, None
                for k in range(tries):
                    try:
                        text, error = client(prompt), None
                        break
                    except Exception as e:  # whatever the client raises is that batch's error
                        error = f"{type(e).__name__}: {e}"
                        if k + 1 < tries:
                            time.sleep(pause * 2**k)
                rows.append((doc, b, text, error, time.monotonic() - began))
            yield pd.DataFrame(rows, columns=["doc_id", "batch_index", "raw_text", "error", "seconds"])

    return prompts.select("doc_id", "batch_index", "prompt").mapInPandas(run, "doc_id string, batch_index int, raw_text string, error string, seconds double")


def batch_prompts(segments: DataFrame, batches: DataFrame, instruction: str) -> DataFrame:
    """doc_id, batch_index, prompt: the instruction and the lines of one batch."""
    from ..operators.candidates import is_noise

    line = F.concat(F.lit("["), "id", F.lit("|"), F.coalesce("segment_type", F.lit("")), F.lit("] "), "text_slice")
    rows = segments.where(~is_noise(F.col("text_slice"))).join(batches, ["doc_id", "id"])
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block_index", "start_offset", line.alias("line")))), lambda x: x["line"]), "\n")
    return rows.groupBy("doc_id", "batch_index").agg(F.concat(F.lit(instruction + "\n\n"), body).alias("prompt"))


INSTRUCTION = 'Answer with a JSON array of objects: {"t":"E","lid","n","k","a","sid","q"} for entities, {"t":"EV","n","k","p","sid","q"} for events, {"t":"C","s","p","o","m","pol","sid","q"} for claims. Quote the text exactly in "q" and name its segments in "sid".'
