"""URL and link functions as Spark columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as V
from .text import contains_any, slug, years

_NETLOC = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)"


def with_scheme(url: Column) -> Column:
    return F.when(F.startswith(url, F.lit("http")), url).otherwise(F.concat(F.lit("https://"), F.regexp_replace(url, "^/+", "")))


def netloc(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _NETLOC, 1))


def last_two_labels(host: Column) -> Column:
    return F.regexp_extract(host, r"([^.]*\.)?[^.]*$", 0)


def root_host(url: Column) -> Column:
    """The last two labels of the host (also where a public suffix has two); null for a blank url or one without a host."""
    host = netloc(with_scheme(url))
    return F.when(F.coalesce(url != "", F.lit(False)) & (host != ""), last_two_labels(host))


def is_allowed(url: Column, base_root: Column, entry_root: Column) -> Column:
    """Relative, or of the two roots, or of a listed root."""
    host = netloc(url)
    root = last_two_labels(host)
    return (host == "") | root.isin(V.ALLOWED_ROOTS) | F.coalesce(root == base_root, F.lit(False)) | F.coalesce(root == entry_root, F.lit(False))


def is_same_site(base: Column, url: Column) -> Column:
    """Equal last two labels, with case; a relative url is of the same site."""
    raw = lambda u: F.regexp_extract(u, _NETLOC, 1)
    return (raw(url) == "") | (last_two_labels(raw(base)) == last_two_labels(raw(url)))


def is_ir_domain(url: Column) -> Column:
    return F.lower(url).rlike("|".join(f"(?:{p})" for p in V.IR_PATTERNS))


def is_static_asset(url: Column) -> Column:
    return F.lower(url).rlike(r"\.(" + "|".join(V.ASSET_SUFFIXES) + ")$")


def is_pdf_url(url: Column) -> Column:
    return F.coalesce(F.endswith(F.lower(F.regexp_replace(url, r"[?#].*$", "")), F.lit(".pdf")), F.lit(False))


def expands(url: Column, text: Column, depth: Column) -> Column:
    """Whether a link is followed: broad words on the entry page, narrow ones below."""
    u, t = F.lower(url), F.lower(F.coalesce(text, F.lit("")))
    return F.when(depth == 0, contains_any(u, V.EXPAND_URL_FIRST) | contains_any(t, V.EXPAND_TEXT_FIRST)).otherwise(contains_any(u, V.EXPAND_URL_DEEPER) | contains_any(t, V.EXPAND_TEXT_DEEPER))


#: Schemes whose references may be relative, and those whose last path segment may have parameters after a semicolon.
RELATIVE = ["", "ftp", "http", "gopher", "nntp", "imap", "wais", "file", "https", "shttp", "mms", "prospero", "rtsp", "rtsps", "rtspu", "sftp", "svn", "svn+ssh", "ws", "wss"]
_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"


def url_parts(url: Column) -> Column:
    """scheme (lower case), netloc, path, params (from the `;` of the last segment), query, fragment of a reference; missing ones are empty. Leading blanks and control characters, tabs and line ends are no part of it."""
    clean = F.regexp_replace(F.regexp_replace(url, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")
    bare = lambda u: F.regexp_replace(u, _SCHEME, "")
    part = lambda u, pattern: F.regexp_extract(u, pattern, 1)
    whole = lambda u: F.struct(
        F.lower(part(u, _SCHEME)).alias("scheme"), part(bare(u), r"^//([^/?#]*)").alias("netloc"), part(bare(u), r"^(?://[^/?#]*+)?+((?:[^/?#]*+/)*+[^/?#;]*+)").alias("path"),
        part(bare(u), r"^(?://[^/?#]*+)?+(?:[^/?#]*+/)*+[^/?#;]*+;([^?#]*)").alias("params"), part(bare(u), r"(?s)^[^?#]*\?([^#]*)").alias("query"), part(bare(u), r"(?s)^[^#]*#(.*)").alias("fragment"),
    )
    return F.transform(F.array(clean), whole)[0]


def without_dots(segments: Column) -> Column:
    """Path segments with `.` taken out and `..` taken out with the segment before it."""
    step = lambda kept, s: F.when(s == "..", F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0)))).when(s == ".", kept).otherwise(F.concat(kept, F.array(s)))
    kept = F.aggregate(segments, F.array().cast("array<string>"), step)
    ends_open = F.element_at(segments, -1).isin(".", "..")
    return F.when(ends_open, F.concat(kept, F.array(F.lit("")))).otherwise(kept)


def joined(base: Column, href: Column) -> Column:
    """href as seen from base by RFC 3986: merged with base's path, dot segments resolved. A url with its own host or of another scheme keeps its path as it is; an empty href is base, and without base href stays."""
    optional = lambda mark, value: F.when(value != "", F.concat(F.lit(mark), value)).otherwise("")

    def made(x: Column) -> Column:
        b, h = x["b"], x["h"]
        scheme = F.when(h["scheme"] == "", b["scheme"]).otherwise(h["scheme"])
        same_page = (h["path"] == "") & (h["params"] == "")
        own, folder = F.split(h["path"], "/", -1), F.split(F.regexp_extract(b["path"], r"^(.*/)?", 1), "/", -1)
        # what stands before the last slash of base's path, then the reference's segments; empty ones between go
        folder = F.when(F.contains(b["path"], F.lit("/")), F.when(F.endswith(b["path"], F.lit("/")), folder).otherwise(F.slice(folder, F.lit(1), F.size(folder) - 1))).otherwise(F.when(b["path"] == "", F.array(F.lit(""))).otherwise(F.array().cast("array<string>")))
        both = F.concat(folder, own)
        inner = F.filter(both, lambda s, i: (s != "") | (i == 0) | (i == F.size(both) - 1))
        path = F.array_join(without_dots(F.when(F.startswith(h["path"], F.lit("/")), own).otherwise(inner)), "/")
        path = F.when(path == "", "/").otherwise(path)
        host = F.when(h["netloc"] != "", h["netloc"]).otherwise(b["netloc"])
        path = F.when(h["netloc"] != "", h["path"]).when(same_page, b["path"]).otherwise(path)
        params = F.when((h["netloc"] == "") & same_page, b["params"]).otherwise(h["params"])
        query = F.when((h["netloc"] == "") & same_page & (h["query"] == ""), b["query"]).otherwise(h["query"])
        rooted = F.when((path != "") & ~F.startswith(path, F.lit("/")), F.concat(F.lit("/"), path)).otherwise(path)
        place = F.when(host != "", F.concat(F.lit("//"), host, rooted)).when((scheme != "") & ((path == "") | F.startswith(path, F.lit("/"))) | F.startswith(path, F.lit("//")), F.concat(F.lit("//"), path)).otherwise(path)
        whole = F.concat(F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(""), place, optional(";", params), optional("?", query), optional("#", h["fragment"]))
        return F.when(F.coalesce(x["base"], F.lit("")) == "", x["href"]).when(x["href"] == "", x["base"]).when((scheme != b["scheme"]) | ~scheme.isin(RELATIVE), x["href"]).otherwise(whole)

    bound = F.struct(url_parts(base).alias("b"), url_parts(href).alias("h"), base.alias("base"), href.alias("href"))
    return F.transform(F.array(bound), made)[0]


def is_report_pdf(url: Column, text: Column) -> Column:
    """A link to a PDF that no word marks as a form, policy or the like."""
    u, t = F.lower(url), F.lower(F.coalesce(text, F.lit("")))
    return F.endswith(u, F.lit(".pdf")) & ~contains_any(u, V.NOT_REPORTS) & ~contains_any(t, V.NOT_REPORTS)


def link_years(url: Column, text: Column) -> Column:
    return F.array_sort(F.array_union(years(F.lower(text)), years(F.lower(url))))


def is_10k(url: Column, text: Column) -> Column:
    t = F.lower(F.coalesce(text, F.lit("")))
    return t.rlike("10-k|10k") | F.contains(F.lower(url), F.lit("10-k"))


def pdf_score(url: Column, text: Column) -> Column:
    """Points of a PDF link: 10, and for annual reports, 10-K filings and years."""
    u, t = F.lower(url), F.lower(F.coalesce(text, F.lit("")))
    has = lambda w: F.contains(t, F.lit(w)) | F.contains(u, F.lit(w))
    annual = F.when(has("annual report"), 20).when(has("annual"), 10).otherwise(0)
    by_year = F.aggregate(link_years(url, text), F.lit(0), lambda a, y: a + F.when(y.cast("int") >= 2019, 4).otherwise(2))
    return F.lit(10) + annual + F.when(is_10k(url, text), 15).otherwise(0) + by_year


def simple_link_score(url: Column, text: Column) -> Column:
    u, t = F.lower(F.coalesce(url, F.lit(""))), F.lower(F.coalesce(text, F.lit("")))
    out = F.when(F.contains(u, F.lit(".pdf")), 3).otherwise(0) + F.when(t.rlike(V.YEAR_RECENT) | u.rlike(V.YEAR_RECENT), 3).otherwise(0)
    for word, points in V.SIMPLE_LINK_WEIGHTS:
        out = out + F.when(F.contains(t, F.lit(word)) | F.contains(u, F.lit(word)), points).otherwise(0)
    return out


def simple_report_type(url: Column, text: Column) -> Column:
    u, t = F.lower(F.coalesce(url, F.lit(""))), F.lower(F.coalesce(text, F.lit("")))
    both = F.concat_ws("\n", t, u)
    return F.when(both.rlike("10-k|10k"), "10-K").when(F.contains(both, F.lit("annual")), "annual_report").when(F.contains(both, F.lit("proxy")), "proxy").when(F.contains(both, F.lit("sec")), "sec_filing").otherwise("other")


def pdf_type(url: Column, name: Column, given: Column | None = None) -> Column:
    """A coarse type from the words of url and name; a type that is given stands."""
    text = F.concat_ws(" ", F.lower(F.coalesce(url, F.lit(""))), F.lower(F.coalesce(name, F.lit(""))))
    dense = F.replace(text, F.lit(" "), F.lit(""))
    has = lambda c, w: F.contains(c, F.lit(w))
    out = (
        F.when(has(text, "10-k") | has(dense, "form10k"), "10k")
        .when(has(text, "annual-report") | has(dense, "annualreport") | has(text, "annual review"), "annual_report")
        .when(has(text, "proxy") & has(text, "statement"), "proxy")
        .when(text.rlike("presentation|slides|deck"), "presentation")
        .when(has(text, "quarterly") | text.rlike(r"q[1-4]\s*20\d{2}"), "quarterly")
        .when(text.rlike("8-k|6-k"), "sec_other")
        .otherwise("other")
    )
    return out if given is None else F.when(F.trim(given) != "", F.trim(given)).otherwise(out)


def file_name(url: Column) -> Column:
    """A safe file name from the last part of the path. Dots go with the other marks, so `a.pdf` becomes `apdf.pdf`."""
    last = F.regexp_extract(F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), "/+$", ""), r"[^/]*$", 0)
    base = slug(last, 80)
    return F.when(F.endswith(F.lower(base), F.lit(".pdf")), base).otherwise(F.concat(base, F.lit(".pdf")))
