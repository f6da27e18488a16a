"""The engine over HTTP, with the standard library: test questions, banks and periods, answers as server-sent events, traces.

Meant for a person who looks into runs, not for load: a question runs as Spark jobs, one at a time."""

from __future__ import annotations

import datetime as dt
import json
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow import engine
from folioflow.session import table
from folioflow.sources import exchange

#: Units of evidence that an answer lists.
SHOWN = 50


def banks_periods(versions: DataFrame, most: int = 10_000) -> list[dict]:
    """The banks of current versions with their periods (the newest first) and sources."""
    current = versions.where("is_current").where("filter_2 <> ''")
    rows = current.groupBy("filter_2").agg(F.sort_array(F.collect_set("filter_1"), asc=False).alias("periods"), F.sort_array(F.collect_set("data_source")).alias("sources"))
    return [{"bank": r["filter_2"], "periods": r["periods"], "sources": r["sources"]} for r in rows.orderBy("filter_2").take(most)]


def answer(spark: SparkSession, folder: str, traces: str, body: dict) -> dict:
    """The evidence for a question over the versions that are asked for; the run's trace is written."""
    text = str(body.get("query", "")).strip()
    if not text:
        raise ValueError("a query is needed")
    versions = table(spark, folder, "document_versions").where("is_current")
    combos = [(c["bank"], c["period"]) for c in body.get("combos", [])]
    if combos:
        wanted = spark.createDataFrame(combos, "filter_2 string, filter_1 string").distinct()
        versions = versions.join(F.broadcast(wanted), ["filter_2", "filter_1"], "left_semi")  # the question's own few combinations
    if body.get("sources"):
        versions = versions.where(F.col("data_source").isin(*body["sources"]))
    pages = table(spark, folder, "page_results").join(versions.select(F.col("id").alias("document_version_id")), "document_version_id", "left_semi")
    found = engine.retrieve(pages, spark.createDataFrame([(1, text)], "query_id int, text string"))
    units = [r.asDict() for r in found.orderBy(F.col("score").desc(), "document_version_id", "content_unit_id").take(SHOWN)]
    trace = exchange.trace_id(dt.datetime.now(dt.UTC).strftime("%Y%m%dT%H%M%SZ"), text)
    exchange.write_traces(spark.createDataFrame([(text, json.dumps(units))], "query string, units string"), traces, trace)
    return {"query": text, "units": units, "trace_id": trace}


def server(spark: SparkSession, folder: str, traces: str, suite: str | None = None, port: int = 0, host: str = "127.0.0.1") -> ThreadingHTTPServer:
    """A server on ``host`` and ``port`` (0: any free one) that is not started yet."""
    one_at_a_time = threading.Lock()

    class Handler(BaseHTTPRequestHandler):
        def log_message(self, *_) -> None:
            pass

        def _json(self, body, status: int = 200) -> None:
            data = json.dumps(body, default=str, ensure_ascii=False).encode()
            self.send_response(status)
            self.send_header("Content-Type", "application/json; charset=utf-8")
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        def do_GET(self) -> None:
            try:
                if self.path == "/api/test-queries":
                    cases = exchange.query_suite(spark, suite).select("name", "query").take(exchange.SUITE) if suite else []
                    self._json([r.asDict() for r in cases])
                elif self.path == "/api/banks-periods":
                    self._json(banks_periods(table(spark, folder, "document_versions")))
                elif self.path.startswith("/api/trace/"):
                    rows = exchange.read_trace(spark, traces, self.path.removeprefix("/api/trace/")).take(SHOWN)
                    self._json([r.asDict() for r in rows])
                else:
                    self._json({"error": "not found"}, 404)
            except FileNotFoundError:
                self._json({"error": "no such trace"}, 404)
            except Exception as error:
                missing = "PATH_NOT_FOUND" in str(error)
                self._json({"error": "no such trace" if missing else type(error).__name__}, 404 if missing else 500)

        def do_POST(self) -> None:
            if self.path != "/api/query":
                self._json({"error": "not found"}, 404)
                return
            try:
                body = json.loads(self.rfile.read(int(self.headers.get("Content-Length", 0))) or b"{}")
                if not isinstance(body, dict):
                    raise ValueError("an object is needed")
            except ValueError as error:
                self._json({"error": str(error)}, 400)
                return
            self.send_response(200)
            self.send_header("Content-Type", "text/event-stream")
            self.end_headers()
            try:
                with one_at_a_time:
                    result = answer(spark, folder, traces, body)
                for unit in result["units"]:
                    self._event("chunk", unit)
                self._event("result", {k: result[k] for k in ("query", "trace_id")} | {"units": len(result["units"])})
            except Exception as error:
                self._event("error", {"message": f"{type(error).__name__}: {error}"[:300]})

        def _event(self, kind: str, body: dict) -> None:
            self.wfile.write(f"event: {kind}\ndata: {json.dumps(body, default=str, ensure_ascii=False)}\n\n".encode())

    return ThreadingHTTPServer((host, port), Handler)
