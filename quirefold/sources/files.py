"""Discovery of files, as a batch and as a stream, and the stores' edges: CSV, Markdown, HTTP with retries."""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from pathlib import Path
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The file kinds that are read, in either case (the glob is case-sensitive).
GLOB = "*.{pdf,PDF,docx,DOCX,pptx,PPTX}"
#: Attempts and waits of a retried call. Fixed values.
ATTEMPTS, WAITS = 3, (60, 120)


def _local(folder: str) -> Path | None:
    """The path of a folder on a mounted file system, None for other addresses."""
    where = re.sub(r"^file:/+", "/", folder)
    return None if re.match(r"[a-z][a-z0-9+.-]*:", where) else Path(where)


def scan_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length, hash, content) of the files of a folder and below; empty where the folder is missing."""
    schema = "path string, length long, hash string, content binary"
    where = _local(folder)
    if where is not None and not where.exists():
        return spark.createDataFrame([], schema)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", GLOB).load(folder)
    return files.select("path", "length", F.md5("content").alias("hash"), "content")


def write_files(df: DataFrame, folder: str) -> None:
    """The ``content`` of each row of (name, content) as a file of a folder that all executors see as a path; a repeated task writes the same files again."""
    root = _local(folder)
    if root is None:
        raise ValueError("a folder that is mounted on the executors is wanted")

    def write(rows: Iterable) -> None:
        root.mkdir(parents=True, exist_ok=True)
        for r in rows:
            (root / r["name"]).write_bytes(bytes(r["content"]))

    df.select("name", "content").foreachPartition(write)


def stream_files(spark: SparkSession, folder: str) -> DataFrame:
    """New files of a folder as a stream of (path, length, hash). Rewritten files are not new to a stream: the batch scan finds those."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", GLOB).load(folder)
    return files.select("path", "length", F.md5("content").alias("hash"))


def sink_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)


def sink_markdown(report: DataFrame, limit: int = 1000) -> str:
    """A small report as a Markdown table; a report of more than ``limit`` rows is refused."""
    rows = report.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"a report has at most {limit} rows")
    cells = lambda values: "| " + " | ".join("" if v is None else str(v).replace("|", "\\|") for v in values) + " |"
    return "\n".join([cells(report.columns), cells(["---"] * len(report.columns)), *(cells(r) for r in rows)])


class ServiceError(Exception):
    """A call that failed, with the step and the status code if there was one."""

    def __init__(self, step: str, message: str, code: int | None = None):
        super().__init__(f"{step}: {message}")
        self.step, self.code = step, code


@dataclass
class Uploaded:
    doc_id: str
    location: str
    title: str
    words: int


def check_upload(code: int, body: dict) -> Uploaded:
    """The document of an upload's answer; forbidden, failed and empty answers raise."""
    if code == 403:
        raise ServiceError("UPLOAD", "forbidden", code)
    if not 200 <= code < 300:
        raise ServiceError("UPLOAD", f"status {code}", code)
    if not body.get("success") or not body.get("documents"):
        raise ServiceError("UPLOAD", str(body.get("error") or "no document in the answer"), code)
    first = body["documents"][0]
    return Uploaded(first.get("id", ""), first.get("location", ""), first.get("title", ""), int(first.get("wordCount") or 0))


def check_embed(code: int, body: dict, location: str) -> None:
    """Raises unless the answer's workspace holds ``location``; the workspace may be an object or a list of them."""
    if not 200 <= code < 300:
        raise ServiceError("EMBED", f"status {code}", code)
    spaces = body.get("workspace") or []
    held = {d.get("docpath") for w in ([spaces] if isinstance(spaces, dict) else spaces) for d in w.get("documents") or []}
    if location not in held:
        raise ServiceError("EMBED", "location not reflected", code)


def holds_id(tree: Any, wanted: str) -> bool:
    """Whether an id occurs anywhere in a nested listing."""
    todo = [tree]
    while todo:
        node = todo.pop()
        if isinstance(node, dict):
            if node.get("id") == wanted:
                return True
            todo += node.values()
        elif isinstance(node, list):
            todo += node
    return False


def retry(call: Callable[[], Any], step: str, sleep: Callable[[float], None] = time.sleep, failed: Callable[[], None] = lambda: None) -> Any:
    """``call`` with up to ATTEMPTS attempts; ``failed`` is told of each failure but the last."""
    for n in range(ATTEMPTS):
        try:
            return call()
        except Exception as e:
            if n == ATTEMPTS - 1:
                raise ServiceError(step, f"gave up after {ATTEMPTS} attempts: {e}") from e
            failed()
            sleep(WAITS[min(n, len(WAITS) - 1)])
    return None


def upload_all(df: DataFrame, make_client: Callable[[], Callable[[str, str], tuple[int, dict]]], sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """(doc_id, location, error) of uploading every ``text``: one client per partition, results as rows, so that a retried task only repeats calls."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make_client()
        for b in batches:
            rows = []
            for doc_id, text in zip(b.doc_id, b.text):
                try:
                    done = retry(lambda: check_upload(*client(str(doc_id), text)), "UPLOAD", sleep)  # noqa: B023
                    rows.append((doc_id, done.location, None))
                except ServiceError as e:
                    rows.append((doc_id, None, str(e)))
            yield pd.DataFrame(rows, columns=["doc_id", "location", "error"])

    return df.select("doc_id", "text").mapInPandas(run, "doc_id long, location string, error string")


def correct_texts(df: DataFrame, make_corrector: Callable[[], Callable[[str], str]] = lambda: lambda t: t, least: int = 80) -> DataFrame:
    """(doc_id, text) with an injected corrector over texts of ``least`` characters or more; a failing call leaves its text."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        correct = make_corrector()
        for b in batches:
            out = []
            for t in b.text:
                try:
                    out.append(correct(t) if t is not None and len(t.strip()) >= least else t)
                except Exception:  # the service is optional
                    out.append(t)
            yield pd.DataFrame({"doc_id": b.doc_id, "text": out})

    return df.select("doc_id", "text").mapInPandas(run, "doc_id long, text string")


def headers(key: str) -> dict[str, str]:
    """What every call of the service carries."""
    return {"Authorization": f"Bearer {key}", "Content-Type": "application/json"}


def ping(call: Callable[[], int]) -> bool:
    """Whether the service answers a call with a status below 400; a failing call is no answer."""
    try:
        return 200 <= call() < 400
    except Exception:
        return False


def find_in_listing(listing: str, wanted: str) -> bool:
    try:
        return holds_id(json.loads(listing).get("localFiles"), wanted)
    except (ValueError, AttributeError):
        return False
