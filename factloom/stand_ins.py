"""Clients that answer by rule, without a network: what the registered queries run the interfaces with."""

from __future__ import annotations

import json
import re


def no_wait(seconds: float) -> None:
    """For tries that need no pause."""


def number_in(text: str) -> int:
    return int(re.findall(r"\d+", text)[-1])


def fetch(url: str) -> tuple[int, str, bytes]:
    """By the url's last number: an error, nothing, an exception, a PDF, or another type."""
    k = number_in(url) % 5
    if k == 2:
        raise ValueError(url)
    return {0: (404, "text/html", b"gone"), 1: (200, "application/pdf", b""), 3: (200, "application/pdf", b"%PDF " + url.encode()), 4: (200, "text/html", b"page " + url.encode())}[k]


def fetch_html(url: str) -> tuple[int, str, bytes]:
    """By the url's last number: a page, a short one, one in another charset, an error."""
    k = number_in(url) % 4
    body = "<html>" + ("é" * 900 if k != 1 else "") + "</html>"
    return (500 if k == 3 else 200), "text/html; charset=" + ("latin-1" if k == 2 else "utf-8"), body.encode("latin-1" if k == 2 else "utf-8")


def recognise(content: bytes) -> tuple[int, bytes]:
    k = number_in(content.decode())
    if k % 4 == 3:
        raise RuntimeError("no engine")
    return {0: 0, 1: 3, 2: 9}[k % 4], b"recognised " + content


def pages_of(content: bytes) -> list[str]:
    text = content.decode()
    if not text:
        raise ValueError("empty file")
    return text.split("\f")


def answer(prompt: str) -> str:
    """Answers in the forms that models give, by the context's number; repairs say `repaired`."""
    asked = re.match(r"Find (.+) for fiscal year (\d+)", prompt)
    if not asked:
        metric = re.match(r"Turn this answer about (.+) \((\d+)\)", prompt).group(1)
        return json.dumps({"results": [{"metric_name": metric, "value": "repaired", "unit": "", "source_chunk_id": None}]})
    metric, k = asked.group(1), number_in(prompt)
    row = {"metric_name": metric, "value": f"{k}.5", "unit": "%", "fiscal_year": 2024, "source_chunk_id": f"[k=b|stem=s|chunk={k}]"}
    forms = [
        json.dumps({"results": [row, {"metric_name": "other", "value": "1"}]}),
        json.dumps({k: row[k] for k in ("value", "unit", "source_chunk_id")}),
        "Sure {here} it is: " + json.dumps({"results": [row]}) + " as asked",
        f"The value is $ {k},000 and the unit: thousand; see [k=b|stem=s|chunk={k}].",
        "[1, 2]",
    ]
    if k % 6 == 5:
        raise TimeoutError("model")
    return forms[k % 6]
