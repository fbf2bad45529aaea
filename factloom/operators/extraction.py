"""Values from context texts: regular expressions with positions, tables, computed ratios, model answers.

Positions of overlapping windows can't be had from Spark's expressions, so the matchers run over Arrow batches; what
surrounds them (priority, templates, sentinels) is columns.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions import text as T
from ..sources import scratch

MISSING = T.MISSING
_FLAGS = re.I | re.S
_HEADER = re.compile("^" + V.HEADER, re.M)
_NII, _PERCENT, _NIM = re.compile(V.NII_VALUE, _FLAGS), re.compile(V.PERCENT), re.compile(V.NIM_WORDS, re.I)
_RATIO_WORDS = {"ROA": (re.compile(V.ROA_WORDS, re.I), 220, 10, 5), "ROE": (re.compile(V.ROE_WORDS, re.I), 240, 40, 25)}
_JOINT = re.compile(V.JOINT_RATIOS, _FLAGS)
_PHRASED = [(re.compile(rf"in {s}s|\(\s*(\$|dollars)?\s*in\s+{s}s\s*\)"), s) for s in ("thousand", "million", "billion")]
_PLURAL = [(re.compile(rf"\b{s}s\b"), s) for s in ("thousand", "million", "billion")]


def split_blocks(context: str) -> list[str]:
    return context.split(V.BLOCK_BREAK)


def header_line(block: str) -> str:
    found = _HEADER.search(block)
    return found.group(0) if found else MISSING


def unit_of(text: str) -> str:
    low = text.lower()
    for pattern, scale in _PHRASED:
        if pattern.search(low):
            return scale
    if any(w in low for w in ("dollar", "$", "usd")):
        for pattern, scale in _PLURAL:
            if pattern.search(low):
                return scale
    return "dollars" if "$" in text else MISSING


def scale_near(text: str) -> str:
    low = text.lower()
    for pattern, scale in ((V.SCALE_THOUSAND, "thousand"), (V.SCALE_MILLION, "million"), ("thousand", "thousand"), ("million", "million"), ("billion", "billion")):
        if re.search(pattern, low):
            return scale
    return MISSING


def amount(text: str) -> float | None:
    """A number with signs and separators; parentheses negate."""
    bare = text.strip()
    negative = bare.startswith("(") and bare.endswith(")")
    try:
        value = float(bare.strip("()" if negative else "").replace("$", "").replace(",", "").strip())
    except ValueError:
        return None
    return -value if negative else value


def is_year_like(value: float) -> bool:
    return 1900 <= value <= 2100 and value == int(value)


def _widening(block: str, near: str, around: str, head: str) -> Iterator[str]:
    """Units by places from near to far; a scale word next to the number comes before all."""
    yield scale_near(near)
    yield unit_of(block)
    for place in (around, head):
        yield unit_of(place)
        yield scale_near(place)


def find_nii(context: str | None, around: int = 3, head: int = 2200) -> tuple[str, str, str] | None:
    """Net interest income: (value as printed, unit, chunk number), the candidate of most points, of equals the first.

    The first number after the words is taken; if that is a year, the candidate is lost. What is printed with a dollar sign is no year.
    """
    best, blocks = None, split_blocks(context or "")
    for i, block in enumerate(blocks):
        cite = _HEADER.search(block)
        for m in _NII.finditer(block) if cite else ():
            printed = m.group(1).strip()
            value = amount(printed)
            if value is None or ("$" not in printed and is_year_like(value)):
                continue
            near = block[max(0, m.start() - 180) : m.end() + 220]
            neighbours = "\n\n".join(blocks[max(0, i - around) : i + around + 1])
            said = _widening(block, near, neighbours, (context or "")[:head])
            scales = ("thousand", "million", "billion")
            unit = next(said)
            if unit == MISSING:
                unit = next(said)
                for own, scale in zip(said, said, strict=False):  # two for each place, asked for as far as needed
                    if unit in scales:
                        break
                    unit = own if own != MISSING else scale if scale != MISSING else unit
            points = (100 if unit in scales else 30 if unit == "dollars" else 0) + 20 * ("," in printed) + 10 * (abs(value) >= 1000)
            points -= 50 * (unit == "dollars" and "," not in printed and abs(value) < 1000)
            if best is None or points > best[0]:
                best = (points, printed, unit, cite.group(1))
    return best and best[1:]


def find_nim(context: str | None, head: int = 2400) -> tuple[str, str, str] | None:
    """Net interest margin: a percentage with the words close by, from the longest window, of equals the first."""
    best = None
    for block in split_blocks(context or ""):
        for m in _PERCENT.finditer(block) if _NIM.search(block) else ():
            near = block[max(0, m.start() - 180) : m.end() + 180]
            if _NIM.search(near) and 0 < float(m.group(1)) <= 50 and (best is None or len(near) > best[0]):
                first = block.splitlines()[0].strip()
                best = (len(near), m.group(1), first if _HEADER.search(block) and first.startswith("[k=") else MISSING)
    front = (context or "")[:head]
    if best is None and _NIM.search(front):
        for m in _PERCENT.finditer(front):
            near = front[max(0, m.start() - 200) : m.end() + 200]
            if _NIM.search(near) and (best is None or len(near) > best[0]):
                best = (len(near), m.group(1), MISSING)
    return best and (best[1], "%", best[2])


def _ratio_points(metric: str, value: str, text: str) -> int:
    words, _, wide, narrow = _RATIO_WORDS[metric]
    v = float(value)
    return 30 * ("2024" in text) + 30 * (0 < v <= wide) + 10 * (0 < v <= narrow) + 10 * bool(words.search(text))


def find_ratios(context: str | None) -> dict[str, tuple[str, str, str]]:
    """ROA and ROE: percentages that follow their words, or both in one sentence; the most points win, of equals the first."""
    best: dict[str, tuple[int, str, str]] = {}

    def offer(metric: str, points: int, value: str, cite: str) -> None:
        if metric not in best or points > best[metric][0]:
            best[metric] = (points, value, cite)

    for block in split_blocks(context or ""):
        cite = header_line(block)
        both = _JOINT.search(block)
        if both:
            for metric, value in zip(("ROA", "ROE"), both.groups(), strict=True):
                offer(metric, _ratio_points(metric, value, block) + 50, value, cite)
        for metric, (words, reach, _, _) in _RATIO_WORDS.items():
            for m in _PERCENT.finditer(block) if words.search(block) else ():
                left = max(0, m.start() - reach)
                near, at = block[left : m.end() + reach], m.start() - left
                ends = [w.end() for w in words.finditer(near) if w.end() <= at]
                if ends and at - ends[-1] <= reach:
                    offer(metric, _ratio_points(metric, m.group(1), near), m.group(1), cite)
    return {k: (value, "%", cite) for k, (_, value, cite) in best.items()}


def strict_amount(text: str | None) -> float | None:
    bare = (text or "").strip().replace("$", "").replace(",", "")
    negative = bare.startswith("(") and bare.endswith(")")
    bare = bare[1:-1].strip() if negative else bare
    return (-1 if negative else 1) * float(bare) if re.fullmatch(r"-?\d+(\.\d+)?", bare) else None


def vertical_table(text: str | None, title: str, year: int, stops: list[str]) -> dict[str, float | None]:
    """Labels between a title and the year's line, with the lines after it as values, by place, up to a stop title."""
    lines = [x.strip() for x in (text or "").splitlines() if x.strip()]
    at = next((i for i, x in enumerate(lines) if title.lower() in x.lower()), None)
    if at is None:
        return {}
    stopped = lambda x: any(s.lower() in x.lower() for s in stops)
    labels = []
    for i in range(at, len(lines)):
        if lines[i] == str(year):
            break
        if stopped(lines[i]):
            return {}
        labels.append(lines[i])
    else:
        return {}
    values = []
    for x in lines[i + 1 :]:
        if stopped(x):
            break
        values.append(x)
    labels = [x for x in labels[1:] if not x.endswith(":") and "dollars" not in x.lower()]
    return {label: strict_amount(v) for label, v in zip(labels, values, strict=False)}


def money_after(text: str | None, labels: list[str], lines_on: int = 5) -> float | None:
    """The first amount on or just after a line with a label: with separators, else of 1000 or more; never a year."""
    lines = [x.strip() for x in (text or "").splitlines() if x.strip()]
    wanted = [x.lower() for x in labels]
    for i, line in enumerate(lines):
        if any(w in line.lower() for w in wanted):
            near = " ".join(lines[i : i + lines_on + 1])
            for pattern, least in ((V.MONEY_COMMAS, 0), (V.MONEY_PLAIN, 1000)):
                for m in re.finditer(pattern, near):
                    v = amount(m.group(1))
                    if v is not None and not is_year_like(v) and abs(v) >= least:
                        return v
    return None


def first_money(texts: DataFrame, key: str, labels: list[str], lines_on: int = 5) -> DataFrame:
    """key, amount: `money_after` as columns, for texts (key, text): lines are exploded, and each label's line is read with those after it."""
    lines = texts.select(key, F.posexplode(F.filter(F.transform(F.split("text", r"\r\n|\n|\r"), lambda x: F.trim(x)), lambda x: x != "")).alias("line", "words"))
    near = F.array_join(F.collect_list("words").over(Window.partitionBy(key).orderBy("line").rowsBetween(0, lines_on)), " ")
    named = F.exists(F.array(*[F.lit(x.lower()) for x in labels]), lambda w: F.contains(F.lower("words"), w))
    read = lines.withColumn("near", near).where(named)

    def amounts(pattern: str, least: int) -> Column:
        values = F.transform(F.regexp_extract_all("near", F.lit(pattern), 1), T.money)
        return F.filter(values, lambda v: v.isNotNull() & ~(v.between(1900, 2100) & (v == F.floor(v))) & (F.abs(v) >= least))

    first = F.coalesce(F.get(amounts(V.MONEY_COMMAS, 0), F.lit(0)), F.get(amounts(V.MONEY_PLAIN, 1000), F.lit(0)))
    found = read.withColumn("amount", first).where("amount is not null").groupBy(key).agg(F.min_by("amount", "line").alias("amount"))
    return texts.select(key).join(found, key, "left")


def _labelled(table: dict[str, float | None], *words: str) -> float | None:
    return next((v for k, v in table.items() if v is not None and all(w in k.lower() for w in words)), None)


def compute_ratios(context: str | None, year: int) -> dict[str, tuple[str, str, str]]:
    """ROA and ROE from net income and both averages, if all three are found and plausible (averages of 1e6 or more, assets above income)."""
    summary, average = vertical_table(context, V.SUMMARY_TITLE, year, V.SUMMARY_STOPS), vertical_table(context, V.AVERAGE_TITLE, year, V.AVERAGE_STOPS)
    income = summary.get("Net Income") or _labelled(summary, "net", "income")
    if income is None:
        return {}
    if average:
        assets, equity = ((_labelled(average, "average", w) or _labelled(average, "avg", w) or _labelled(average, w)) for w in ("assets", "equity"))
    else:
        assets, equity = money_after(context, V.ASSET_LABELS), money_after(context, V.EQUITY_LABELS)
    if assets is None or equity is None or min(assets, equity) < 1e6 or assets <= max(1.0, income):
        return {}
    cite = re.search(V.HEADER, context or "")
    source = f"COMPUTED_FROM {cite.group(0) if cite else MISSING} (Net Income / Avg "
    return {"ROA": (f"{100 * income / assets:.2f}", "%", source + "Assets)"), "ROE": (f"{100 * income / equity:.2f}", "%", source + "Equity)")}


def spread(rows: DataFrame) -> DataFrame:
    """The rows dealt evenly over some tasks a core. A narrow table is one file split, so one task's work, however long each of its rows takes."""
    spark = rows.sparkSession
    return rows.repartition(max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


FOUND = "metric_name string, value string, unit string, source_chunk_id string, origin string"


def extracted(contexts: DataFrame, key: str, year: int) -> DataFrame:
    """key and FOUND for each value that a pattern finds or a computation gives in a context; origin is regex or computed."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for k, c in zip(pdf[key], pdf["context"], strict=True):
                found = {"NII": find_nii(c), "NIM": find_nim(c), **find_ratios(c)}
                rows += [(k, m, *v, "regex") for m, v in found.items() if v]
                rows += [(k, m, *v, "computed") for m, v in compute_ratios(c, year).items()]
            yield pd.DataFrame(rows, columns=[key, "metric_name", "value", "unit", "source_chunk_id", "origin"])

    return spread(contexts.select(key, "context")).mapInPandas(run, f"{contexts.select(key).schema[0].simpleString().replace(':', ' ', 1)}, {FOUND}")


def loose_json(text: str | None):
    """The text as JSON, else the first JSON value that starts at a brace or bracket in it; ValueError without one."""
    text = (text or "").strip()
    try:
        return json.loads(text)
    except ValueError:
        pass
    decoder = json.JSONDecoder()
    for m in re.finditer(r"[{\[]", text):
        try:
            return decoder.raw_decode(text, m.start())[0]
        except ValueError:
            continue
    raise ValueError("no JSON in the text")


def parsed_answer(text: str | None, year: int):
    """A model's answer: its JSON, or what stands from the first to the last brace, or value, unit and citation by pattern."""
    text = (text or "").strip()
    for part in (text, text[text.find("{") : text.rfind("}") + 1] if "{" in text else ""):
        try:
            return loose_json(part)
        except ValueError:
            continue
    pick = lambda p: (m := re.search(p, text)) and m.group(1).strip()
    value = pick(r"(?i)\bvalue\b[^0-9$]*\$?\s*`?\s*([0-9][0-9,\.]*)")
    return {
        "value": value.replace(",", "") if value else MISSING,
        "unit": pick(r"(?i)\bunit\b[^A-Za-z]*`?\s*([A-Za-z][A-Za-z \-\(\)%]+)") or MISSING,
        "source_chunk_id": pick(r"(\[k=[^\]]*?\|chunk=\d+\])") or pick(r"(?i)\bchunk\b[^0-9]{0,10}(\d+)") or MISSING,
        "fiscal_year": int(year),
    }


def is_results(obj) -> bool:
    rows = obj.get("results") if isinstance(obj, dict) else None
    return isinstance(rows, list) and any(isinstance(r, dict) and {"metric_name", "value"} <= set(r) for r in rows)


def normalised(obj, asked: str) -> dict[str, tuple[str, str, str]]:
    """metric -> (value, unit, citation) of a parsed answer: a results list, a flat record (which is the asked metric), or names with values."""
    out: dict[str, tuple[str, str, str]] = {}
    row = lambda d: tuple(str(d.get(k) if d.get(k) not in (None, "") else MISSING) for k in ("value", "unit", "source_chunk_id"))
    if not isinstance(obj, dict):
        return out
    if isinstance(obj.get("results"), list):
        return {r["metric_name"]: row(r) for r in obj["results"] if isinstance(r, dict) and r.get("metric_name") in V.METRICS}
    if "value" in obj and "source_chunk_id" in obj:
        return {asked: row(obj)}
    return {V.METRIC_SYNONYMS[k]: (str(v), MISSING, MISSING) for k, v in obj.items() if k in V.METRIC_SYNONYMS}


def one_metric_prompt(metric: str, context: str, year: int) -> str:
    row = json.dumps({"results": [{"metric_name": metric, "value": MISSING, "unit": MISSING, "fiscal_year": year, "source_chunk_id": MISSING}]})
    return (
        f"Find {metric} for fiscal year {year} in the context and answer with one JSON object, nothing else.\n"
        "Take a number only if the context states it; do not compute or infer. Copy source_chunk_id from the header above the number.\n"
        f"If it is not there, answer exactly:\n{row}\n\nContext:\n{context}"
    )


def many_metrics_prompt(question: str, context: str, year: int) -> str:
    rows = json.dumps({"results": [{"metric_name": m, "value": MISSING, "unit": MISSING, "fiscal_year": year, "source_chunk_id": MISSING} for m in V.METRICS]})
    return f"Answer with one JSON object of this form, nothing else:\n{rows}\nTake numbers only from the context and copy their headers as source_chunk_id.\n\nQuestion:\n{question}\n\nContext:\n{context}"


def _template(metrics: list[str], year: int) -> str:
    return json.dumps({"results": [{"metric_name": m, "value": MISSING, "unit": MISSING, "fiscal_year": year, "source_chunk_id": MISSING} for m in metrics]})


def strict_prompt(question: str, context: str, year: int) -> str:
    """All metrics, with hard rules, for a question."""
    return (
        f"Extract figures of fiscal year {year} from the context, and only what it states as numbers: nothing inferred, summed up or generalised.\n"
        "Each figure has as source_chunk_id the [k=...] header above it, copied exactly. ROAA counts as ROA, ROAE as ROE. What is not stated stays as it is below.\n"
        f"Answer with this JSON object and nothing else:\n{_template(V.METRICS, year)}\n\nQuestion:\n{question}\n\nContext:\n{context}\n\nJSON:"
    )


def loose_nii_prompt(context: str, year: int) -> str:
    """Net interest income alone, for models that fail the strict prompt."""
    return (
        f"Find Net Interest Income (NII) of fiscal year {year} in the context; only a number that is printed there, nothing worked out.\n"
        "Copy source_chunk_id from the nearest [k=...|stem=...|chunk=...] header, brackets included.\n"
        f"Answer with this JSON object, all keys and no others:\n{_template(['NII'], year)}\n\nContext:\n{context}"
    )


def repair_prompt(answer: str, metric: str, year: int) -> str:
    return f"Turn this answer about {metric} ({year}) into JSON of the form {{\"results\": [{{metric_name, value, unit, fiscal_year, source_chunk_id}}]}}. Add nothing; use {MISSING} for what is missing.\n\n{answer}"


def called(prompts: DataFrame, model) -> DataFrame:
    """target, metric, prompt with raw and error: one call of the model for each prompt; a call that fails is a row with its error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, errors = [], []
            for prompt in b.column("prompt").to_pylist():
                try:
                    raw.append(model(prompt))
                    errors.append(None)
                except Exception as e:  # one failing call must not end the job
                    raw.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(raw, pa.string()), pa.array(errors, pa.string())], [*b.schema.names, "raw", "error"])

    return prompts.mapInArrow(run, "target string, metric string, prompt string, raw string, error string")


def _plain(field: str) -> Column:
    """Whether a field of the chosen row is a string, null, or not there."""
    kind = F.expr(f"schema_of_variant(try_variant_get(chosen, '$.{field}', 'variant'))")
    return F.coalesce(kind.isin("STRING", "VOID"), F.lit(True))


def read_answers(answers: DataFrame) -> DataFrame:
    """answers (target, metric, raw) with value, unit, source_chunk_id and is_read, by built-in functions alone.

    Read are answers that are JSON as a whole and of a known form (a list of results, or one flat record) whose fields are
    strings; of several results for the metric the last one counts. All others are left to `parsed_answer`.
    """
    v = answers.withColumn("v", F.expr("try_parse_json(raw)")).withColumn("rows", F.expr("try_variant_get(v, '$.results', 'array<variant>')"))
    has = lambda x, k: f"try_variant_get({x}, '$.{k}', 'variant') IS NOT NULL"
    listed = F.expr(f"rows IS NOT NULL AND exists(rows, r -> {has('r', 'metric_name')} AND {has('r', 'value')})")
    flat = F.expr(f"rows IS NULL AND {has('v', 'value')} AND {has('v', 'source_chunk_id')} AND NOT {has('v', 'results')}")
    own = F.expr("element_at(filter(rows, r -> try_variant_get(r, '$.metric_name', 'string') = metric AND schema_of_variant(try_variant_get(r, '$.metric_name', 'variant')) = 'STRING'), -1)")
    own = F.when(F.expr("size(filter(rows, r -> try_variant_get(r, '$.metric_name', 'string') = metric)) > 0"), own)
    found = v.withColumn("is_listed", F.coalesce(listed, F.lit(False))).withColumn("is_flat", F.coalesce(flat, F.lit(False)))
    found = found.withColumn("chosen", F.when(F.col("is_listed"), own).when(F.col("is_flat"), F.col("v")))
    fields = ("value", "unit", "source_chunk_id")
    known = F.col("metric").isin(V.METRICS)
    read = F.coalesce((F.col("is_listed") & known | F.col("is_flat")) & _plain("value") & _plain("unit") & _plain("source_chunk_id"), F.lit(False))
    text = lambda c: F.coalesce(F.nullif(F.expr(f"try_variant_get(chosen, '$.{c}', 'string')"), F.lit("")), F.lit(MISSING)).alias(c)
    return found.select(*answers.columns, *(text(c) for c in fields), read.alias("is_read"))


def _scanned(answers: DataFrame, year: int) -> DataFrame:
    """answers (target, metric, raw) with value, unit, source_chunk_id and is_formed, row by row: for answers that `read_answers` leaves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for metric, raw in zip(b.column("metric").to_pylist(), b.column("raw").to_pylist(), strict=True):
                obj = parsed_answer(raw, year)
                formed = is_results(obj) or (isinstance(obj, dict) and "value" in obj)
                rows.append((*normalised(obj, metric).get(metric, (MISSING, MISSING, MISSING)), formed))
            kinds = (pa.string(), pa.string(), pa.string(), pa.bool_())
            made = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*b.columns, *made], [*b.schema.names, "value", "unit", "source_chunk_id", "is_formed"])

    answers = answers.select("target", "metric", "raw")
    return answers.mapInArrow(run, "target string, metric string, raw string, value string, unit string, source_chunk_id string, is_formed boolean")


def asked_of_model(evidence: DataFrame, model, year: int) -> DataFrame:
    """target and FOUND (origin model) from one prompt for each (target, metric, context); an answer out of form is repaired once; a failure is a row of errors.

    Answers are written before they are read, so that no call is made twice. Those of a known form are read by built-in
    functions; Python reads the others, and asks for the repair of what has no form.
    """
    prompt = F.udf(lambda m, c: one_metric_prompt(m, c, year), "string", useArrow=True)
    asked = evidence.select(F.col("target").cast("string").alias("target"), "metric", prompt("metric", "context").alias("prompt"))
    first = scratch.written(called(asked, model).drop("prompt"), "answers")
    done = read_answers(first.where("error IS NULL"))
    hard = scratch.written(_scanned(done.where("NOT is_read"), year), "answers-hard")
    mend = F.udf(lambda raw, m: repair_prompt(raw, m, year), "string", useArrow=True)
    open_ = hard.where("NOT is_formed").select("target", "metric", mend("raw", "metric").alias("prompt"))
    second = scratch.written(called(open_, model).drop("prompt"), "answers-repaired")
    again = read_answers(second.where("error IS NULL"))
    result = lambda df: df.select("target", F.col("metric").alias("metric_name"), "value", "unit", "source_chunk_id", F.lit("model").alias("origin"), F.lit(None).cast("string").alias("error"))
    failed = first.where("error IS NOT NULL").unionByName(second.where("error IS NOT NULL"))
    missing = [F.lit(MISSING).alias(c) for c in ("value", "unit", "source_chunk_id")]
    failed = failed.select("target", F.col("metric").alias("metric_name"), *missing, F.lit("model").alias("origin"), "error")
    out = result(done.where("is_read")).unionByName(result(hard.where("is_formed"))).unionByName(result(again.where("is_read")))
    return out.unionByName(result(_scanned(again.where("NOT is_read"), year))).unionByName(failed)


def merged(targets: DataFrame, found: DataFrame, key: str, year: int) -> DataFrame:
    """A row for each target and metric: the value of the first origin of regex, model, computed that has one."""
    spark: SparkSession = targets.sparkSession
    template = targets.select(key).distinct().crossJoin(F.broadcast(spark.createDataFrame([(i, m) for i, m in enumerate(V.METRICS)], "metric_place int, metric_name string")))
    order = F.when(F.col("origin") == "regex", 0).when(F.col("origin") == "model", 1).otherwise(2)
    usable = found.where(~T.is_missing(F.col("value")) & F.col("metric_name").isin(V.METRICS))
    best = usable.groupBy(key, "metric_name").agg(F.min_by(F.struct("value", "unit", "source_chunk_id", "origin"), F.struct(order, "value", "source_chunk_id")).alias("b"))
    out = template.join(best, [key, "metric_name"], "left")
    return out.select(key, F.lit(year).alias("year"), "metric_name", "metric_place", F.col("b.value").alias("value"), F.col("b.unit").alias("unit"), F.col("b.source_chunk_id").alias("source_chunk_id"), F.col("b.origin").alias("origin"))
