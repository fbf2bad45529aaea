"""Text, number and citation functions as Spark columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as V

MISSING = "NOT FOUND"


def contains_any(text: Column, words: list[str]) -> Column:
    """Whether any of the literals is in the text, as one alternation."""
    return text.rlike("|".join(re.escape(w) for w in words))


def clean_text(text: Column) -> Column:
    """Line ends to LF, runs of blanks to one, three or more line ends to two, outer white space off."""
    text = F.regexp_replace(F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n")), r"[ \t]+", " ")
    return F.regexp_replace(F.regexp_replace(text, r"\n{3,}", "\n\n"), r"^\s+|\s+$", "")


def slug(text: Column, most: int = 60) -> Column:
    """A name that is safe as a file name."""
    kept = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, r"^\s+|\s+$", ""), r"[ \t\n\r]+", "_"), r"[^0-9A-Za-z_\-]+", "")
    return F.left(F.when(kept == "", "unknown").otherwise(kept), F.lit(most))


def years(text: Column) -> Column:
    """Distinct years 1900 to 2099 that stand as words, ascending."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(V.YEAR_WORD), 1)))


def latest_year(text: Column, current_year: int) -> Column:
    """The latest year from 2000 to the next one, wherever four such digits are; null without one."""
    found = F.transform(F.regexp_extract_all(text, F.lit(r"(20\d{2})"), 1), lambda y: y.cast("int"))
    return F.array_max(F.filter(found, lambda y: y.between(2000, current_year + 1)))


def last_year(text: Column) -> Column:
    """The last of the years 2000 to 2025 in the text."""
    found = F.regexp_extract_all(text, F.lit(V.YEAR_RECENT), 1)
    return F.when(F.size(found) > 0, F.element_at(found, -1).cast("int"))


def first_year(name: Column, default: int) -> Column:
    found = F.regexp_extract(name, r"(20\d{2})", 1)
    return F.when(found != "", found.cast("int")).otherwise(default)


def is_valid_html(html: Column, least: int = 800) -> Column:
    return F.coalesce(F.contains(F.lower(html), F.lit("<html")) & (F.length(html) >= least), F.lit(False))


def preview(text: Column, most: int = 300) -> Column:
    return F.replace(F.left(text, F.lit(most)), F.lit("\n"), F.lit(" "))


def human_size(size: Column) -> Column:
    """A size with the unit that keeps it under 1024."""
    out, scaled = F.lit(None).cast("string"), size.cast("double")
    units = ["B", "KB", "MB", "GB", "TB", "PB"]
    for k in range(len(units) - 1, -1, -1):
        shown = F.format_string("%.1f" + units[k], F.bround(scaled / (1024.0**k), 1))
        out = shown if k == len(units) - 1 else F.when(scaled < 1024.0 ** (k + 1), shown).otherwise(out)
    return out


def is_ratio_table(text: Column) -> Column:
    return contains_any(F.lower(text), V.RATIO_PHRASES)


def middle_cut(text: Column, most: int, head: int, tail: int) -> Column:
    return F.when(F.length(text) > most, F.concat(F.left(text, F.lit(head)), F.lit("\n...[middle truncated]...\n"), F.right(text, F.lit(tail)))).otherwise(text)


def evidence_text(text: Column) -> Column:
    """A block's text: long ones lose their middle, ratio tables only when much longer."""
    return F.when(is_ratio_table(text), middle_cut(text, 4200, 1600, 2600)).otherwise(middle_cut(text, 1400, 700, 700))


def citation(bank: Column, stem: Column, chunk: Column) -> Column:
    return F.format_string("[k=%s|stem=%s|chunk=%s]", bank.cast("string"), stem.cast("string"), chunk.cast("string"))


def stem_of(cite: Column) -> Column:
    return F.regexp_extract(F.coalesce(bare_citation(cite), F.lit("")), r"stem=([^|]+)", 1)


def bare_citation(cite: Column) -> Column:
    return F.regexp_replace(F.trim(cite), r"^\[+|\]+$", "")


def is_valid_citation(cite: Column) -> Column:
    bare = bare_citation(cite)
    return F.coalesce(F.contains(bare, F.lit("chunk=")) | bare.rlike(r"^[0-9]+$"), F.lit(False))


def is_missing(value: Column) -> Column:
    return value.isNull() | F.upper(F.trim(value)).isin(MISSING, "NOT_FOUND", "")


def shown(value: Column) -> Column:
    """The sentinel in place of null or blank: for sinks only."""
    return F.when(value.isNull() | (F.trim(value) == ""), MISSING).otherwise(value)


def money(text: Column) -> Column:
    """A strict amount: dollar signs and commas off, parentheses negate, else only a plain number; null otherwise."""
    bare = F.replace(F.replace(F.trim(text), F.lit("$"), F.lit("")), F.lit(","), F.lit(""))
    inside = F.regexp_extract(bare, r"^\((.*)\)$", 1)
    negated = bare.rlike(r"^\(.*\)$")
    number = F.when(negated, F.trim(inside)).otherwise(bare)
    value = F.when(number.rlike(r"^-?\d+(\.\d+)?$"), number.try_cast("double"))
    return F.when(negated, -value).otherwise(value)


def guessed_unit(text: Column) -> Column:
    """thousand, million or billion by the phrases of table heads, else dollars with a dollar sign, else NOT FOUND."""
    low = F.lower(F.coalesce(text, F.lit("")))
    dollar = F.contains(low, F.lit("$"))
    money_word = F.contains(low, F.lit("dollar")) | dollar | F.contains(low, F.lit("usd"))
    out = None
    for scale in ("thousand", "million", "billion"):
        stated = low.rlike(rf"in {scale}s|\(\s*(\$|dollars)?\s*in\s+{scale}s\s*\)")
        out = F.when(stated, scale) if out is None else out.when(stated, scale)
    for scale in ("thousand", "million", "billion"):
        out = out.when(low.rlike(rf"\b{scale}s\b") & money_word, scale)
    return out.when(dollar, "dollars").otherwise(MISSING)


def nearby_scale(text: Column) -> Column:
    """A scale word close to a number."""
    low = F.lower(F.coalesce(text, F.lit("")))
    out = F.when(low.rlike(V.SCALE_THOUSAND), "thousand").when(low.rlike(V.SCALE_MILLION), "million")
    for scale in ("thousand", "million", "billion"):
        out = out.when(F.contains(low, F.lit(scale)), scale)
    return out.otherwise(MISSING)


def value_and_unit(value: Column, unit: Column) -> tuple[Column, Column]:
    """A percent sign moves from the value to the unit; blanks become the sentinel."""
    bare = F.trim(value)
    percent = F.coalesce(F.endswith(bare, F.lit("%")), F.lit(False))
    number = F.when(percent, F.trim(F.regexp_replace(bare, "%$", ""))).otherwise(bare)
    return shown(number), F.when(percent, "%").otherwise(shown(F.trim(F.coalesce(unit, F.lit("")))))
