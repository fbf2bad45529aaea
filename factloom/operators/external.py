"""Effects outside the engine, each behind one narrow interface: fetching, OCR, page text, language models.

A client is any picklable callable; the operators run it by partition with mapInPandas and turn failures into columns,
so a bad row never ends a job. The stand-ins here answer without a network.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: url -> (status code, content type, body)
Fetcher = Callable[[str], tuple[int, str, bytes]]
#: body -> (return code, body): 0 done, 3 has text already
Recogniser = Callable[[bytes], tuple[int, bytes]]
#: prompt -> answer
Model = Callable[[str], str]


def fetch_once(url: str, fetcher: Fetcher, tries: int = 3, delay: float = 1.0, wait: Callable[[float], None] = time.sleep) -> tuple[bool, str, bytes | None]:
    """(ok, reason, body). Waits double between tries; an empty body is tried again; another content type is a warning."""
    if not url or not url.strip():
        return False, "empty_url", None
    reason = "unknown_error"
    for k in range(tries):
        try:
            code, kind, body = fetcher(url.strip())
            if code >= 400:
                reason = f"http_{code}"
            elif not body:
                reason = "empty_file"
            else:
                plain = "pdf" in kind.lower() or url.lower().split("?")[0].split("#")[0].endswith(".pdf")
                return True, "ok" if plain else f"non_pdf_content_type:{kind.lower()}", body
        except Exception as e:  # a client may raise anything; the row says what
            reason = f"exception:{type(e).__name__}"
        if k + 1 < tries:
            wait(delay * 2**k)
    return False, reason, None


class HttpFetcher:
    """A Fetcher by the standard library; timeouts in seconds. An error status is an answer, not an exception."""

    def __init__(self, timeout: float = 40, agent: str = "Mozilla/5.0 (compatible; factloom)", accept: str = "*/*"):
        self.timeout, self.headers = timeout, {"User-Agent": agent, "Accept": accept}

    def __call__(self, url: str) -> tuple[int, str, bytes]:
        from urllib.error import HTTPError
        from urllib.request import Request, urlopen

        try:
            with urlopen(Request(url, headers=self.headers), timeout=self.timeout) as r:
                return r.status, r.headers.get("Content-Type") or "", r.read()
        except HTTPError as e:
            return e.code, e.headers.get("Content-Type") or "", b""


def page_once(url: str, fetcher: Fetcher) -> str | None:
    """A page's html if its status is under 400 and its text passes for html, else nothing; one try."""
    try:
        code, kind, body = fetcher(url)
    except Exception:  # whatever a client raises, the page isn't there
        return None
    charset = re.search(r"charset=[\"']?([\w-]+)", kind or "", re.I)
    try:
        text = body.decode(charset.group(1) if charset else "utf-8", "replace")
    except LookupError:
        text = body.decode("utf-8", "replace")
    return text if code < 400 and "<html" in text.lower() and len(text) >= 800 else None


def fetch_pages(urls: DataFrame, fetcher: Fetcher, attempts: int = 1) -> DataFrame:
    """url, html (null where no attempt gave a valid page). A browser is a fetcher like any other, with more attempts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"url": pdf["url"], "html": [next((h for h in (page_once(u, fetcher) for _ in range(attempts)) if h), None) if u else None for u in pdf["url"]]})

    return urls.select("url").mapInPandas(run, "url string, html string")


def fetch_all(urls: DataFrame, fetcher: Fetcher, tries: int = 3, wait: Callable[[float], None] = time.sleep) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [fetch_once(u, fetcher, tries, wait=wait) for u in pdf["url"]]
            yield pd.DataFrame({"url": pdf["url"], "ok": [g[0] for g in got], "reason": [g[1] for g in got], "content": [g[2] for g in got]})

    return urls.mapInPandas(run, "url string, ok boolean, reason string, content binary")


def first_valid(pages: DataFrame, layers: list[str], deep_only: str | None = None) -> DataFrame:
    """html: the first valid one of the layers' columns, in order; the layer deep_only counts at depth 0 or for investor domains only."""
    from ..functions import text as T
    from ..functions import urls as U

    ok = lambda c: F.when(T.is_valid_html(F.col(c)), F.col(c))
    picked = [F.when((F.col("depth") == 0) | U.is_ir_domain(F.col("url")), ok(c)) if c == deep_only else ok(c) for c in layers]
    return pages.withColumn("html", F.coalesce(*picked))


def recognised(files: DataFrame, recogniser: Recogniser) -> DataFrame:
    """path, ocr_status (success, copied, fail), content. files: path, content."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            status, out = [], []
            for raw in pdf["content"]:
                try:
                    code, body = recogniser(bytes(raw))
                except Exception:
                    code, body = -1, None
                status.append({0: "success", 3: "copied"}.get(code, "fail"))
                out.append({0: body, 3: bytes(raw)}.get(code))
            yield pd.DataFrame({"path": pdf["path"], "ocr_status": status, "content": out})

    return files.select("path", "content").mapInPandas(run, "path string, ocr_status string, content binary")


def read_pdf_pages(content: bytes) -> list[str]:
    """The text of each page of a PDF, by pypdf where it is installed."""
    import io

    from pypdf import PdfReader

    return [p.extract_text() or "" for p in PdfReader(io.BytesIO(content)).pages]


def paged(files: DataFrame, reader: Callable[[bytes], list[str]] = read_pdf_pages) -> DataFrame:
    """path, page, text, error: a row for each page of each file (path, content); a file that can't be read is one row with page -1."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    rows = [(path, i, t, None) for i, t in enumerate(reader(bytes(content)))]
                except Exception as e:
                    rows = [(path, -1, None, f"{type(e).__name__}: {e}")]
                yield pd.DataFrame(rows, columns=["path", "page", "text", "error"])

    return files.select("path", "content").mapInPandas(run, "path string, page int, text string, error string")


def joined_pages(pages: DataFrame) -> DataFrame:
    """path, text: a document's page texts (path, page, text) in order, a line break between them."""
    ordered = F.array_sort(F.collect_list(F.struct("page", "text")))
    return pages.groupBy("path").agg(F.array_join(F.transform(ordered, lambda p: F.coalesce(p["text"], F.lit(""))), "\n").alias("text"))


def answer_in(reply: dict) -> str:
    """A model server's answer: the response, without one the thinking, without that the message's content."""
    message = reply.get("message")
    for text in (reply.get("response"), reply.get("thinking"), message.get("content") if isinstance(message, dict) else None):
        if text and text.strip():
            return text.strip()
    return ""


class ModelServer:
    """A Model behind a local HTTP server that takes JSON prompts; an answer in JSON form is asked for, without chance. Other states than 200 raise."""

    def __init__(self, url: str, model: str, timeout: float = 180, stop: list[str] | None = None):
        self.url, self.model, self.timeout, self.stop = url, model, timeout, stop or []

    def __call__(self, prompt: str) -> str:
        from urllib.error import HTTPError
        from urllib.request import Request, urlopen

        body = {"model": self.model, "prompt": prompt, "stream": False, "format": "json", "options": {"temperature": 0, "stop": self.stop}}
        try:
            with urlopen(Request(self.url, json.dumps(body).encode(), {"Content-Type": "application/json"}), timeout=self.timeout) as r:
                code, raw = r.status, r.read()
        except HTTPError as e:
            code, raw = e.code, e.read()
        if code != 200:
            raise RuntimeError(f"model server: {code} {raw[:500].decode('utf-8', 'replace')}")
        return answer_in(json.loads(raw))


def answered(prompts: DataFrame, model: Model) -> DataFrame:
    """prompts with answer and error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            answers, errors = [], []
            for p in pdf["prompt"]:
                try:
                    answers.append(model(p))
                    errors.append(None)
                except Exception as e:
                    answers.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            yield pdf.assign(answer=answers, error=errors)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in prompts.schema.fields)
    return prompts.mapInPandas(run, f"{fields}, answer string, error string")


def silent_model(prompt: str) -> str:
    """A stand-in that finds nothing."""
    return '{"results": []}'
