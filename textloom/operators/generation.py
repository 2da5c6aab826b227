"""Machine text through pluggable providers, applied by Arrow batches with mapInPandas.

A provider is a picklable object with complete(requests) -> list of (text, settings, error). Requests are dicts of provider,
model, prompt, system, raw and the sampling parameters. Failed requests become rows with an error and no text, so a task never
fails for one of them; a provider that is not configured ends the job. Transports are injected, so that no test needs a network."""

from __future__ import annotations

import json
import os
import time
import urllib.error
import urllib.request
import zlib
from collections.abc import Callable, Iterator
from email.utils import parsedate_to_datetime
from typing import Any, NamedTuple, Protocol
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import split_sentences, strip_leading_boilerplate, trim_to_sentence_boundary
from textloom.operators.pools import Entry, remote_config

PARAMS = "struct<provider:string,temperature:double,top_p:double,repeat_penalty:double,max_tokens:int,host:string,backend:string,deployment:string,rewrite_stage:string,rewrite_style:string>"


class NotConfigured(RuntimeError):
    """A remote provider has no key or address."""


class Unreachable(RuntimeError):
    """A local model server does not answer."""


class Reply(NamedTuple):
    status: int
    body: str
    headers: dict[str, str]


Transport = Callable[[str, dict[str, Any] | None, dict[str, str], float], Reply]


def http(url: str, body: dict[str, Any] | None, headers: dict[str, str], timeout: float) -> Reply:
    """POST of JSON, or GET where there is no body; HTTP errors are replies, others raise OSError."""
    data = None if body is None else json.dumps(body).encode()
    try:
        with urllib.request.urlopen(urllib.request.Request(url, data, {"Content-Type": "application/json"} | headers), timeout=timeout) as r:
            return Reply(r.status, r.read().decode(errors="replace"), dict(r.headers))
    except urllib.error.HTTPError as e:
        return Reply(e.code, e.read().decode(errors="replace"), dict(e.headers or {}))


class Provider(Protocol):
    def complete(self, request: dict[str, Any]) -> tuple[str, dict[str, Any]]: ...


class LocalServer:
    """Completion servers that take POST /api/generate; hosts are dealt by the request's host number."""

    def __init__(self, hosts: list[str], timeout: float = 240.0, attempts: int = 5, transport: Transport = http, sleep: Callable[[float], None] = time.sleep):
        self.hosts, self.timeout, self.attempts, self.transport, self.sleep = hosts, timeout, attempts, transport, sleep

    def complete(self, request: dict[str, Any]) -> tuple[str, dict[str, Any]]:
        host = self.hosts[int(request.get("host_number") or 0) % len(self.hosts)]
        options = {"temperature": request["temperature"], "top_p": request["top_p"], "repeat_penalty": request["repeat_penalty"], "num_predict": int(request["max_tokens"])}
        body = {"model": request["model"], "prompt": request["prompt"], "stream": False, "options": options}
        if request.get("system") and not request.get("raw"):
            body["system"] = request["system"]
        why = ""
        for i in range(self.attempts):
            try:
                reply = self.transport(f"{host}/api/generate", body, {}, self.timeout)
                if reply.status < 400:
                    return (json.loads(reply.body).get("response") or "").strip(), {k: request[k] for k in ("temperature", "top_p", "repeat_penalty", "max_tokens")} | {"provider": "ollama", "host": host}
                why = f"{reply.status} {reply.body[:500]}"
            except (OSError, ValueError) as e:
                why = str(e)
            self.sleep(1.5 * (i + 1))
        raise RuntimeError(f"no completion from {host}: {why}")


def assert_reachable(hosts: list[str], timeout: float = 5.0, transport: Transport = http) -> None:
    for host in hosts:
        try:
            reply = transport(f"{host}/api/tags", None, {}, timeout)
        except OSError as e:
            raise Unreachable(f"{host}: {e}") from e
        if reply.status >= 400:
            raise Unreachable(f"{host}: {reply.status} {reply.body[:500]}")


def setting(cfg: dict[str, Any], key: str, env: str, default: str = "") -> str:
    """A setting of the configuration, else of the environment, else the default."""
    return str(cfg.get(key) or os.environ.get(env) or default).strip()


AZURE = ("AZURE_OPENAI_ENDPOINT", "AZURE_OPENAI_DEPLOYMENT_NAME", "AZURE_OPENAI_API_VERSION")


def azure_url(cfg: dict[str, Any]) -> str:
    """Address of a chat deployment; "" where a part is missing."""
    end, name = setting(cfg, "azure_endpoint", "AZURE_OPENAI_ENDPOINT").rstrip("/"), setting(cfg, "azure_deployment", "AZURE_OPENAI_DEPLOYMENT_NAME")
    version = setting(cfg, "azure_api_version", "AZURE_OPENAI_API_VERSION", "2024-02-15-preview")
    return f"{end}/openai/deployments/{quote(name, safe='')}/chat/completions?api-version={quote(version, safe='')}" if end and name else ""


def is_ready(cfg: dict[str, Any]) -> bool:
    key = os.environ.get(str(cfg.get("api_key_env") or "OPENAI_API_KEY"), "").strip()
    return bool(key) and (not cfg.get("use_azure") or bool(azure_url(cfg)))


def retry_after(headers: dict[str, str], now: Callable[[], float] = time.time) -> float | None:
    """Seconds that a Retry-After header asks for, given as a number or a date; None without a usable one."""
    value = next((v for k, v in headers.items() if k.lower() == "retry-after"), "").strip()
    if not value:
        return None
    try:
        return float(value)
    except ValueError:
        try:
            return max(0.0, parsedate_to_datetime(value).timestamp() - now())
        except (TypeError, ValueError):
            return None


class ChatServer:
    """Chat-completion servers, plain or Azure, with retries for rate limits and rejected parameters."""

    def __init__(self, cfg: dict[str, Any], transport: Transport = http, sleep: Callable[[float], None] = time.sleep):
        self.cfg, self.transport, self.sleep = cfg, transport, sleep

    def complete(self, request: dict[str, Any]) -> tuple[str, dict[str, Any]]:
        cfg = self.cfg
        name = str(cfg.get("api_key_env") or "OPENAI_API_KEY")
        if not (key := os.environ.get(name, "").strip()):
            raise NotConfigured(f"{name} is not set")
        azure = bool(cfg.get("use_azure"))
        url = azure_url(cfg) if azure else str(cfg.get("base_url") or "https://api.openai.com/v1").rstrip("/") + "/chat/completions"
        if not url:
            raise NotConfigured("Azure needs an endpoint and a deployment")
        headers = {"api-key": key} if azure else {"Authorization": f"Bearer {key}"} | ({"OpenAI-Organization": str(cfg["organization"])} if cfg.get("organization") else {})
        plain = bool(cfg.get("force_default_sampling"))
        used = {"temperature": 1.0 if plain else float(request["temperature"]), "top_p": 1.0 if plain else float(request["top_p"])}
        most, limit_name, swapped, reset = int(request["max_tokens"]), "max_tokens", False, False
        messages = [{"role": r, "content": c} for r, c in (("system", request.get("system")), ("user", request["prompt"])) if c]
        cap, base, why = float(cfg.get("retry_after_max_sec", 180)), float(cfg.get("retry_backoff_base_sec", 2.0)), ""
        for i in range(int(cfg.get("max_retries", 12))):
            body = {"messages": messages, **used, limit_name: most, **({} if azure else {"model": request["model"]}), **(cfg.get("extra_request_json") or {})}
            try:
                reply = self.transport(url, body, headers, float(cfg.get("request_timeout_sec", 240)))
                if reply.status < 400:
                    if not (choices := json.loads(reply.body).get("choices")):
                        raise ValueError("no choices")
                    meta = {"provider": "openai", **used, "max_tokens": most}
                    if azure:
                        meta |= {"backend": "azure_openai", "deployment": setting(cfg, "azure_deployment", "AZURE_OPENAI_DEPLOYMENT_NAME")}
                    return str((choices[0].get("message") or {}).get("content") or "").strip(), meta
                why = f"{reply.status} {reply.body[:400]}"
                low = reply.body.lower()
                if reply.status == 429:
                    asked = retry_after(reply.headers)
                    self.sleep(min(cap, base * 2 ** min(i, 10)) if asked is None else min(cap, max(1.0, asked)))
                    continue
                if reply.status == 400 and not swapped and "max_tokens" in low and "max_completion_tokens" in low:
                    limit_name, swapped = "max_completion_tokens", True
                    continue
                if reply.status == 400 and not reset and "temperature" in low and ("unsupported" in low or "default" in low):
                    used, reset = {"temperature": 1.0, "top_p": 1.0}, True
                    continue
            except (OSError, ValueError) as e:
                why = str(e)
            self.sleep(base * (i + 1))
        raise RuntimeError(f"no completion from {url}: {why}")


class Router:
    """Sends each request to its provider; clients are made once for each worker and settings."""

    def __init__(self, pool: list[Entry], model_cfg: dict[str, Any] | None = None, hosts: list[str] | None = None, transport: Transport = http):
        self.pool, self.cfg, self.hosts, self.transport = pool, model_cfg or {}, hosts or [], transport
        shared = self.cfg.get("openai") or {}
        names = {*AZURE, *(str(remote_config(shared, e).get("api_key_env") or "OPENAI_API_KEY") for e in pool if e.provider == "openai")}
        self.settings = {n: os.environ[n] for n in names if n in os.environ}  # executors don't have the driver's environment
        self.clients: dict[Any, Provider] = {}

    def client(self, provider: str, model: str) -> Provider:
        entry = next((e for e in self.pool if (e.provider, e.model) == (provider, model)), Entry(provider, model))
        cfg = remote_config(self.cfg.get("openai"), entry)
        key = ("local",) if provider == "ollama" else (cfg.get("base_url"), cfg.get("api_key_env"), cfg.get("use_azure"))
        if key not in self.clients:
            for name, value in self.settings.items():
                os.environ.setdefault(name, value)
            self.clients[key] = LocalServer(self.hosts, transport=self.transport) if provider == "ollama" else ChatServer(cfg, self.transport)
        return self.clients[key]

    def complete(self, request: dict[str, Any]) -> tuple[str, dict[str, Any]]:
        return self.client(request["provider"], request["model"]).complete(request)


def generate(df: DataFrame, provider: Provider, text: str = "completion", params: str = "generation_params", error: str = "error") -> DataFrame:
    """Adds text, params and error to df, whose request columns are provider, model, prompt, system, raw, temperature, top_p, repeat_penalty, max_tokens.

    Rows of each task are sorted by model, so that a server loads each model as rarely as possible; hosts are dealt by a hash of
    the request, so they don't depend on the partitioning."""
    names = df.columns

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            texts, metas, errors = [], [], []
            for request in part.to_dict("records"):
                try:
                    got, meta = provider.complete(request | {"host_number": zlib.crc32(f"{request['model']}|{request['prompt']}".encode())})
                    texts.append(got)
                    metas.append({k: meta.get(k) for k in ("provider", "temperature", "top_p", "repeat_penalty", "max_tokens", "host", "backend", "deployment", "rewrite_stage", "rewrite_style")})
                    errors.append(None)
                except NotConfigured:  # no row can succeed
                    raise
                except Exception as e:  # one failed request is one dropped row
                    texts.append(None)
                    metas.append(None)
                    errors.append(f"{type(e).__name__}: {e}"[:500])
            yield part.assign(**{text: texts, params: metas, error: errors})

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.sortWithinPartitions("model").mapInPandas(run, f"{fields}, {text} string, {params} {PARAMS}, {error} string").select(*names, text, params, error)


def offline_completion(sentences: F.Column, after: F.Column, size: int = 3) -> F.Column:
    """Deterministic stand-in for a model: the next sentences after the prefix, backwards."""
    return F.array_join(F.reverse(F.slice(sentences, after + 1, F.lit(size))), " ")


def offline_rewrite(text: F.Column) -> F.Column:
    """Deterministic stand-in for a rewrite: the first sentence goes to the end."""
    s = split_sentences(text)
    return F.array_join(F.concat(F.slice(s, F.lit(2), F.greatest(F.size(s), F.lit(1))), F.slice(s, F.lit(1), F.lit(1))), " ")


def post_process(completion: F.Column) -> F.Column:
    """Cut at the last sentence end, then without chat-like first lines."""
    return strip_leading_boilerplate(trim_to_sentence_boundary(F.coalesce(completion, F.lit(""))))
