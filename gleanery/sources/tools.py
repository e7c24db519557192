"""Documentation tools behind JSON-RPC: calls with a cache, and the tables that their replies hold."""

from __future__ import annotations

import json
import time
import urllib.request
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..plans.tables import materialize
from .models import retry

#: (tool, arguments as JSON) -> body of the response.
Transport = Callable[[str, str], str]


def http_transport(url: str, timeout: float = 60.0) -> Transport:
    def post(tool: str, arguments: str) -> str:
        call = {"jsonrpc": "2.0", "id": 1, "method": "tools/call", "params": {"name": tool, "arguments": json.loads(arguments)}}
        head = {"Content-Type": "application/json", "Accept": "application/json, text/event-stream"}
        with urllib.request.urlopen(urllib.request.Request(url, json.dumps(call).encode(), head), timeout=timeout) as r:
            return r.read().decode("utf-8")

    return post


def reply_text(body: str) -> str:
    """Text of a JSON-RPC reply, plain or as a server-sent event; an error in it is raised."""
    for line in body.splitlines():
        if (data := line.removeprefix("data:").strip()).startswith("{"):
            reply = json.loads(data)
            if "error" in reply:
                raise RuntimeError(reply["error"].get("message", "error without a message"))
            return "\n".join(part.get("text") or "" for part in reply["result"]["content"])
    raise ValueError("the reply holds no JSON")


def call_key() -> Column:
    return T.content_hash(F.concat_ws("\n", "tool", "arguments"), 16)


def call_tools(calls: DataFrame, transport: Transport, cache: str | None = None, tries: int = 4, first: float = 1.0, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """(tool, arguments) -> distinct calls as (key, tool, arguments, text, error).

    Calls in the table ``cache`` are not made again; the others are made once each, up to ``tries`` times, and those that went
    well are appended to it. A call that fails gives its error and stops no other.
    """
    spark = calls.sparkSession
    wanted = calls.select("tool", "arguments").distinct().withColumn("key", call_key())
    known = spark.createDataFrame([], "key string, text string")
    if cache is not None:
        try:
            known = spark.read.schema("key string, text string").parquet(cache)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            out: list[tuple[str | None, str | None]] = []
            for tool, arguments in zip(pdf["tool"], pdf["arguments"]):
                try:
                    out.append((retry(lambda: reply_text(transport(tool, arguments)), tries, first, sleep), None))
                except Exception as e:
                    out.append((None, f"{type(e).__name__}: {e}"[:300]))
            yield pd.DataFrame({"key": pdf["key"], "text": [t for t, _ in out], "error": [e for _, e in out]}, dtype=object)

    made = materialize(wanted.join(known, "key", "left_anti").mapInPandas(run, "key string, text string, error string"), "tool-calls")
    # a retried task may have written a call twice; any of equal ones will do
    old = materialize(known.groupBy("key").agg(F.min("text").alias("text")).withColumn("error", F.lit(None).cast("string")), "tool-cache")
    if cache is not None:
        made.where("error is null").select("key", "text").write.mode("append").parquet(cache)
    return wanted.join(old.unionByName(made), "key").select("key", "tool", "arguments", "text", "error")


def search_hits(replies: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, text) -> (keys, rank, url, anchor, title, content) of a search's JSON replies, best first; other replies have no hits."""
    found = F.from_json("text", "struct<search_results:array<struct<source_url:string,title:string,content:string>>>")["search_results"]
    x = replies.select(*keys, F.posexplode(found).alias("rank", "r"))
    return x.select(*keys, "rank", T.normalize_url(F.col("r.source_url")).alias("url"), F.col("r.source_url").alias("anchor"), "r.title", "r.content")


def topics(listing: DataFrame, text: str = "text") -> DataFrame:
    """(slug, category, status, url) of the topics that a listing links as ``[title](.../category/slug/)** — status``."""
    rx = F.lit(r"\]\((https?://[^)\s]*/([a-z0-9-]+)/([a-z0-9-]+)/)\)\*\*\s*—\s*([a-z]+)")
    parts = {name: F.regexp_extract_all(text, rx, F.lit(i)) for i, name in ((1, "url"), (2, "category"), (3, "slug"), (4, "status"))}
    x = listing.select(F.explode(F.arrays_zip(*[c.alias(n) for n, c in parts.items()])).alias("t"))
    return x.select("t.slug", "t.category", "t.status", "t.url")


def topic_rows(listed: DataFrame, documents: DataFrame) -> DataFrame:
    """Topics with their documents (slug, content); the title is that of the front matter, else the slug."""
    title = T.front_matter_title(F.col("content"))
    return listed.join(documents.select("slug", "content"), "slug").select("slug", F.when(title != "", title).otherwise(F.col("slug")).alias("title"), "category", "status", "url", "content")


def registry_versions(packages: DataFrame, lookup: Callable[[str], str], name: str = "package") -> DataFrame:
    """(package, latest, error) of distinct packages from a registry: ``lookup`` gives the JSON document of a package's latest release."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            out: list[tuple[str | None, str | None]] = []
            for p in pdf["package"]:
                try:
                    out.append((json.loads(lookup(p))["version"], None))
                except Exception as e:
                    out.append((None, f"{type(e).__name__}: {e}"[:300]))
            yield pd.DataFrame({"package": pdf["package"], "latest": [v for v, _ in out], "error": [e for _, e in out]}, dtype=object)

    return packages.select(F.col(name).alias("package")).distinct().mapInPandas(run, "package string, latest string, error string")


def version_guard(found: DataFrame, wanted: DataFrame) -> DataFrame:
    """(package, latest, wanted, same, same_major) of the packages wanted (package, wanted) against the registry's; an unknown one is neither."""
    major = lambda c: F.split_part(c, F.lit("."), F.lit(1))
    x = wanted.join(found.select("package", "latest"), "package", "left")
    return x.select("package", "latest", "wanted", F.coalesce(F.col("latest") == F.col("wanted"), F.lit(False)).alias("same"), F.coalesce(major(F.col("latest")) == major(F.col("wanted")), F.lit(False)).alias("same_major"))


def require_major(found: str, wanted: int) -> str:
    """The version found, if its major number is the one wanted."""
    if not found.split(".")[0].isdigit() or int(found.split(".")[0]) != wanted:
        raise ValueError(f"version {wanted} is wanted, {found} was found")
    return found
