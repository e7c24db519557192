"""Adapters for models and checkers: batches in, rows out, failures as rows."""

from __future__ import annotations

import hashlib
import json
import subprocess
import time
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..plans.tables import bounded_batches


class TextModel(Protocol):
    name: str

    def generate(self, prompts: list[str]) -> list[str]: ...


@dataclass
class StubModel:
    """Deterministic offline model: the reply is a function of the prompt."""

    name: str = "stub"
    reply: Callable[[str], str] = lambda p: hashlib.sha256(p.encode()).hexdigest()

    def generate(self, prompts: list[str]) -> list[str]:
        return [self.reply(p) for p in prompts]


@dataclass
class CommandModel:
    """A model behind a command: the prompt goes to its standard input, its standard output is the reply."""

    name: str
    command: list[str]
    timeout: float = 180.0

    def generate(self, prompts: list[str]) -> list[str]:
        return [subprocess.run(self.command, input=p, capture_output=True, text=True, timeout=self.timeout, check=True).stdout.strip() for p in prompts]


def _post(url: str, body: dict, timeout: float) -> dict:
    with urllib.request.urlopen(urllib.request.Request(url, json.dumps(body).encode(), {"Content-Type": "application/json"}), timeout=timeout) as r:
        return json.load(r)


@dataclass
class ChatModel:
    """A model behind a chat-completions endpoint, asked again after failures; the seed makes replies repeatable where the server honours it."""

    name: str
    url: str
    temperature: float = 0.7
    max_tokens: int = 4096
    seed: int | None = None
    json_reply: bool = False
    timeout: float = 900.0
    tries: int = 4
    wait: float = 2.0
    post: Callable[[str, dict, float], dict] = _post
    sleep: Callable[[float], None] = time.sleep

    def generate(self, prompts: list[str]) -> list[str]:
        return [retry(lambda: self._ask(p), self.tries, self.wait, self.sleep) for p in prompts]

    def _ask(self, prompt: str) -> str:
        body: dict = {"model": self.name, "messages": [{"role": "user", "content": prompt}], "temperature": self.temperature, "max_tokens": self.max_tokens}
        if self.seed is not None:
            body["seed"] = self.seed
        if self.json_reply:
            body["response_format"] = {"type": "json_object"}
        reply = self.post(self.url, body, self.timeout)["choices"][0]["message"]["content"]
        if not reply:
            raise ValueError("an empty reply")
        return reply


def retry(call: Callable[[], object], tries: int = 4, first: float = 1.0, sleep: Callable[[float], None] = time.sleep):
    """Calls again after 1, 2, 4... times ``first`` seconds; the last error goes up."""
    for k in range(tries):
        try:
            return call()
        except Exception:
            if k == tries - 1:
                raise
            sleep(first * 2**k)


@dataclass
class Failover:
    """Takes models in turn; one that fails cools down, one whose output can't be used does not."""

    models: list[TextModel]
    fallback: TextModel | None = None
    cooldown: float = 600.0
    rounds: int = 40
    wait: float = 30.0
    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep
    until: dict[str, float] = field(default_factory=dict)

    def ask(self, prompt: str, accept: Callable[[str], bool] = lambda s: True, start: int = 0, without: str | None = None) -> tuple[str, str] | None:
        """(model, reply) of the first model whose reply is accepted, or None."""
        for _ in range(self.rounds):
            turn = [m for m in self.models[start % max(1, len(self.models)) :] + self.models[: start % max(1, len(self.models))] if m.name != without]
            ready = [m for m in turn if self.until.get(m.name, 0.0) <= self.clock()]
            for m in ready:
                try:
                    out = m.generate([prompt])[0]
                except Exception:
                    self.until[m.name] = self.clock() + self.cooldown
                    continue
                if accept(out):
                    return m.name, out
            if self.fallback is not None and self.fallback.name != without:
                out = self.fallback.generate([prompt])[0]
                return (self.fallback.name, out) if accept(out) else None
            if ready and all(self.until.get(m.name, 0.0) <= self.clock() for m in ready):
                return None  # all answered, none usably
            if not turn:
                return None
            self.sleep(max(self.wait, self.next_ready(without) - self.clock()))
        return None


    def next_ready(self, without: str | None = None) -> float | None:
        """The earliest time at which a model is ready again."""
        return min((self.until.get(m.name, 0.0) for m in self.models if m.name != without), default=None)


@dataclass
class EmbeddingModel:
    """Vectors of an embeddings endpoint, asked again after failures."""

    name: str
    url: str
    timeout: float = 900.0
    tries: int = 4
    wait: float = 2.0
    prefix: str = ""
    post: Callable[[str, dict, float], dict] = _post
    sleep: Callable[[float], None] = time.sleep

    def __call__(self, texts: list[str]) -> list[list[float]]:
        body = {"model": self.name, "input": [self.prefix + t for t in texts]}
        reply = retry(lambda: self.post(self.url, body, self.timeout), self.tries, self.wait, self.sleep)
        return [d["embedding"] for d in reply["data"]]


def generate(df: DataFrame, model: TextModel | Failover, prompt: str = "prompt", batch: int = 64, accept: Callable[[str], bool] = lambda s: True, writer: str | None = None) -> DataFrame:
    """Adds reply, model, error and ms (of the call); a prompt that fails gives a row with its error and stops no other.

    A plain model gets ``batch`` prompts a call. A ``Failover`` is asked prompt by prompt, starting a model further each time, and keeps its
    cooldowns for as long as the task runs; the model named in the column ``writer`` is passed over, so none judges what it wrote. A reply that
    ``accept`` refuses is an error. A null prompt is one too.
    """

    def several(prompts: list[str]) -> Iterator[tuple[str | None, str, str | None, float]]:
        began = time.monotonic()
        try:
            replies = model.generate(prompts)
        except Exception:
            replies = None
        if replies is not None:
            spent = (time.monotonic() - began) * 1000 / max(1, len(prompts))
            yield from ((r, model.name, None, spent) if accept(r) else (None, model.name, "the reply was refused", spent) for r in replies)
            return
        for p in prompts:
            began = time.monotonic()
            try:
                r, e = model.generate([p])[0], None
                r, e = (r, None) if accept(r) else (None, "the reply was refused")
            except Exception as x:
                r, e = None, f"{type(x).__name__}: {x}"[:300]
            yield r, model.name, e, (time.monotonic() - began) * 1000

    def one(p: str, start: int, without: str | None) -> tuple[str | None, str | None, str | None, float]:
        began = time.monotonic()
        try:
            found = model.ask(p, accept, start, without)
        except Exception as x:
            return None, None, f"{type(x).__name__}: {x}"[:300], (time.monotonic() - began) * 1000
        spent = (time.monotonic() - began) * 1000
        return (found[1], found[0], None, spent) if found else (None, None, "no model gave a usable reply", spent)

    # prompts and replies of so many rows at a time are in memory, whatever a batch holds
    step = batch * max(1, 256 // batch)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asked = 0
        for pdf in (whole.iloc[at : at + step] for whole in parts for at in range(0, len(whole), step)):
            rows: list[tuple] = []
            if isinstance(model, Failover):
                for p, w in zip(pdf[prompt], pdf[writer] if writer else [None] * len(pdf)):
                    rows.append((None, None, "no prompt", 0.0) if p is None else one(p, asked % max(1, len(model.models)), w))
                    asked += 1
            else:
                for at in range(0, len(pdf), batch):
                    part = pdf[prompt].iloc[at : at + batch].tolist()
                    said = several([p for p in part if p is not None])
                    rows += [(None, model.name, "no prompt", 0.0) if p is None else next(said) for p in part]
            reply, name, error, ms = zip(*rows) if rows else ((),) * 4
            yield pdf.assign(reply=pd.Series(reply, pdf.index, object), model=pd.Series(name, pdf.index, object), error=pd.Series(error, pdf.index, object), ms=pd.Series(ms, pdf.index, float))

    bounded_batches(df.sparkSession)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name not in ("reply", "model", "error", "ms"))
    return df.drop("reply", "model", "error", "ms").mapInPandas(run, f"{kinds}, reply string, model string, error string, ms double")


def embed(df: DataFrame, encode: Callable[[list[str]], list[list[float]]], text: str, out: str = "vector", batch: int = 64) -> DataFrame:
    """Adds a vector per text, ``batch`` texts a call; see ``EmbeddingModel``."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            vectors: list[list[float]] = []
            for at in range(0, len(pdf), batch):
                vectors += encode(pdf[text].iloc[at : at + batch].tolist())
            yield pdf.assign(**{out: vectors})

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInPandas(run, f"{kinds}, `{out}` array<double>")


#: (file, content) of a batch -> diagnostics by file, or the checker's printed output.
Checker = Callable[[list[tuple[str, str]]], dict[str, list[dict]]]


def check_snippets(df: DataFrame, checker: Checker, body: str = "content", batch: int = 150) -> DataFrame:
    """(id, file, content) -> (id, file, diagnostics): ``batch`` snippets go to the checker at once; a batch that fails gives no rows, so its
    answers are still to be checked on the next run."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for at in range(0, len(pdf), batch):
                part = pdf.iloc[at : at + batch]
                try:
                    found = checker(list(zip(part["file"], part[body])))
                except Exception:
                    continue
                yield pd.DataFrame({"id": part["id"], "file": part["file"], "diagnostics": [found.get(f, []) for f in part["file"]]})

    return df.mapInPandas(run, "id string, file string, diagnostics array<struct<code:int,line:int,msg:string>>")


def python_syntax(code: str) -> list[dict]:
    """Diagnostics by a checker at hand everywhere: Python's own parser."""
    import ast

    try:
        ast.parse(code)
        return []
    except SyntaxError as e:
        return [{"code": 1, "line": e.lineno or 0, "msg": str(e.msg)}]


def each_file(check: Callable[[str], list[dict]]) -> Checker:
    """A batch checker from one of a single text."""
    return lambda files: {f: check(c) for f, c in files}


def call_statistics(calls: DataFrame, reply: str = "reply", tokens_a_word: float = 1.4) -> DataFrame:
    """Per model: calls, failed ones, words and tokens of the replies, and milliseconds."""
    words = T.word_count(F.coalesce(F.col(reply), F.lit("")))
    out = calls.groupBy("model").agg(F.count(F.lit(1)).alias("calls"), F.count_if(F.col("error").isNotNull()).alias("failed"), F.sum(words).cast("long").alias("words"), F.sum("ms").alias("ms"))
    return out.withColumn("tokens", T.js_round(F.col("words") * F.lit(tokens_a_word)))
