"""One registered query per operator over the driver's tables, each beside its SQL.

Banks are stood in for by document sources or embedding labels, documents by doc_id, hits by vectors: the tables hold no
financial reports, so patterns that need them are also tested on literal cases in tests/.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import fixed_values as V
from .functions import markup as M
from .functions import text as T
from .functions import urls as U
from .operators import checks, chunks, crawl, downloads, extraction, metrics, pages, retrieval, vector_index, vectors
from .sources import scratch

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def any_in(column: str, words) -> str:
    return "(" + " OR ".join(f"contains({column}, '{w}')" for w in words) + ")"


# --- text and chunks ----------------------------------------------------------------------------------------------
CLEAN = r"regexp_replace(regexp_replace(regexp_replace(replace(replace({0}, chr(13) || chr(10), chr(10)), chr(13), chr(10)), '[ \t]+', ' ', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g')"


@query(f"SELECT doc_id, length(c) AS n_clean, md5(c) AS clean_md5 FROM (SELECT doc_id, {CLEAN.format('text')} AS c FROM documents)")
def clean_text(spark, sf_dir):
    c = table(spark, sf_dir, "documents").select("doc_id", T.clean_text(F.col("text")).alias("c"))
    return c.select("doc_id", F.length("c").alias("n_clean"), F.md5("c").alias("clean_md5"))


CHUNKS = f"""WITH c AS (SELECT doc_id, {CLEAN.format('text')} AS t FROM documents), l AS (SELECT * FROM c WHERE length(t) >= 50),
s AS (SELECT doc_id, t, unnest(range(0, length(t), 1200)) AS char_start FROM l)
SELECT doc_id, (char_start // 1200)::INT AS chunk_id, char_start::INT AS char_start, least(char_start + 1400, length(t))::INT AS char_end, substring(t, char_start + 1, 1400) AS text FROM s"""


@query(f"SELECT doc_id, chunk_id, char_start, char_end, md5(text) AS text_md5 FROM ({CHUNKS})")
def chunk_documents(spark, sf_dir):
    return chunks.chunked(table(spark, sf_dir, "documents"), ["doc_id"]).select("doc_id", "chunk_id", "char_start", "char_end", F.md5("text").alias("text_md5"))


@query(f"""SELECT doc_id, n::INT AS num_chars, CASE WHEN n < 50 THEN 0 ELSE least(ceil(n / 1200.0), 50000) END::INT AS num_chunks,
CASE WHEN n < 50 THEN 'fail' ELSE 'success' END AS status, CASE WHEN n < 50 THEN 'text_too_short' ELSE '' END AS error
FROM (SELECT doc_id, length({CLEAN.format('text')}) AS n FROM documents)""")
def chunk_log(spark, sf_dir):
    return chunks.log(table(spark, sf_dir, "documents"), ["doc_id"])


@query("""WITH b AS (SELECT source AS bank_folder, doc_id FROM documents)
SELECT bank_folder, doc_id, row_number() OVER (ORDER BY bank_folder, doc_id) - 1 AS global_id FROM b""")
def global_row_ids(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(F.col("source").alias("bank_folder"), "doc_id")
    return chunks.numbered(rows, ["bank_folder", "doc_id"]).select("bank_folder", "doc_id", "global_id")


@query(r"""WITH d AS (SELECT doc_id, length(text) AS n, greatest(ceil(length(text) / 3000.0)::BIGINT - 1, 1) AS steps FROM documents), w AS (
SELECT doc_id, n, CASE WHEN n <= 3000 THEN [0] ELSE list_sort(list_distinct(list_concat([0, (n - 3000) // 2, n - 3000], list_transform(range(0, steps + 1), lambda i: ((n - 3000) * i) // steps)))) END AS ws FROM d WHERE n > 0),
s AS (SELECT DISTINCT doc_id, n, w0 + st AS char_start FROM (SELECT doc_id, n, w0, unnest(range(0, least(3000, n - w0), 1200)) AS st FROM (SELECT doc_id, n, unnest(ws) AS w0 FROM w)))
SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY char_start) - 1)::INT AS chunk_id, char_start::INT AS char_start, least(char_start + 1400, n)::INT AS char_end FROM s""")
def full_coverage_windows(spark, sf_dir):
    """Every character of every text is in a chunk: as many windows as leave no gap, and no limit on chunks."""
    return chunks.covered(table(spark, sf_dir, "documents"), ["doc_id"], window=3000, windows=None, most=None).drop("text")


@query(r"""WITH d AS (SELECT doc_id, length(text) AS n FROM documents), w AS (
SELECT doc_id, n, CASE WHEN n <= 300000 THEN [0] ELSE list_sort(list_distinct(list_concat([0, (n - 300000) // 2, n - 300000], list_transform(range(0, 6), lambda i: ((n - 300000) * i) // 5)))) END AS ws FROM d WHERE n > 0),
s AS (SELECT DISTINCT doc_id, n, w0 + st AS char_start FROM (SELECT doc_id, n, w0, unnest(range(0, least(300000, n - w0), 1200)) AS st FROM (SELECT doc_id, n, unnest(ws) AS w0 FROM w))),
c AS (SELECT doc_id, n, char_start, row_number() OVER (PARTITION BY doc_id ORDER BY char_start) - 1 AS chunk_id FROM s)
SELECT doc_id, chunk_id::INT AS chunk_id, char_start::INT AS char_start, least(char_start + 1400, n)::INT AS char_end FROM c WHERE chunk_id < 3000""")
def full_coverage_production(spark, sf_dir):
    """full_coverage_windows with the mode's own limits, which leave no gap in texts of up to 1.8 million characters and 3000 chunks."""
    return chunks.covered(table(spark, sf_dir, "documents"), ["doc_id"]).drop("text")


@query(f"""SELECT doc_id, CASE WHEN r AND length(text) > 4200 THEN left(text, 1600) || chr(10) || '...[middle truncated]...' || chr(10) || right(text, 2600)
WHEN NOT r AND length(text) > 1400 THEN left(text, 700) || chr(10) || '...[middle truncated]...' || chr(10) || right(text, 700) ELSE text END AS cut, r AS is_ratio, replace(left(text, 300), chr(10), ' ') AS preview
FROM (SELECT doc_id, text, {any_in('lower(text)', V.RATIO_PHRASES)} AS r FROM documents)""")
def truncation_and_preview(spark, sf_dir):
    text = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", T.evidence_text(text).alias("cut"), T.is_ratio_table(text).alias("is_ratio"), T.preview(text).alias("preview"))


@query(r"""SELECT p_partkey, CASE WHEN s = '' THEN 'unknown' ELSE left(s, 60) END AS slug FROM (SELECT p_partkey, regexp_replace(regexp_replace(trim(p_name), '[ \t\n\r]+', '_', 'g'), '[^0-9A-Za-z_\-]+', '', 'g') AS s FROM part)""")
def slugs(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", T.slug(F.col("p_name")).alias("slug"))


@query(r"""SELECT event_id, array_to_string(list_sort(list_distinct(regexp_extract_all(t, '\b(19[0-9]{2}|20[0-9]{2})\b', 1))), ',') AS years,
list_max(list_filter(list_transform(regexp_extract_all(t, '(20\d{2})', 1), lambda y: y::INT), lambda y: y BETWEEN 2000 AND 2027)) AS latest,
coalesce(try_cast(nullif(regexp_extract(t, '(20\d{2})', 1), '') AS INT), 2024) AS first_in_name,
try_cast(list_last(regexp_extract_all(t, '(20[01][0-9]|202[0-5])', 1)) AS INT) AS last_match
FROM (SELECT event_id, strftime(ts, '%Y-%m-%d') || ' report_' || (1990 + event_id % 60) || '.pdf' AS t FROM events)""")
def year_functions(spark, sf_dir):
    t = F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit(" report_"), (F.lit(1990) + F.col("event_id") % 60).cast("string"), F.lit(".pdf"))
    rows = table(spark, sf_dir, "events").select("event_id", t.alias("t"))
    c = F.col("t")
    return rows.select("event_id", F.array_join(T.years(c), ",").alias("years"), T.latest_year(c, 2026).alias("latest"), T.first_year(c, 2024).alias("first_in_name"), T.last_year(c).alias("last_match"))


# --- pages and links ----------------------------------------------------------------------------------------------
ROOT = r"regexp_extract(lower(regexp_extract({0}, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1)), '([^.]*\.)?[^.]*$', 0)"


@query(f"""SELECT page_id, {ROOT.format('url')} AS root_host, {ROOT.format('url')} IN ({quoted(V.ALLOWED_ROOTS)}) OR {ROOT.format('url')} = 'example.com' AS allowed,
regexp_matches(lower(url), '{"|".join(f"(?:{p})" for p in V.IR_PATTERNS)}') AS ir_domain, contains(lower(html), '<html') AND length(html) >= 800 AS valid_html,
ends_with(lower(regexp_replace(url, '[?#].*$', '')), '.pdf') AS is_pdf FROM pages""")
def url_predicates(spark, sf_dir):
    url = F.col("url")
    none = F.lit(None).cast("string")
    return table(spark, sf_dir, "pages").select("page_id", U.root_host(url).alias("root_host"), U.is_allowed(url, F.lit("example.com"), none).alias("allowed"), U.is_ir_domain(url).alias("ir_domain"), T.is_valid_html(F.col("html")).alias("valid_html"), U.is_pdf_url(url).alias("is_pdf"))


# the page without comments, scripts and styles; stretches of text between tags, each stripped; references resolved by RFC 3986, dot segments one by one
_BARE = r"regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '<!>', 'g'), '(?is)<(script|style)\b.*?</(script|style)\s*>', '<!>', 'g')"
_REFERENCES = """replace(replace(replace(replace(replace(replace({0}, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', chr(160)), '&amp;', '&')"""
_STRETCHES = r"array_to_string(list_filter(list_transform(string_split_regex({0}, '<[^>]*>'), lambda t: regexp_replace(" + _REFERENCES.format("t") + r", '^[\s\x{{A0}}]+|[\s\x{{A0}}]+$', '', 'g')), lambda t: t <> ''), ' ')"


def resolved(refs: str, *keys: str) -> str:
    """CTEs from `refs` (keys, base, h) to `urls` (keys, url). One walk over the segments of all paths."""
    scheme = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
    part = lambda c, pattern: f"regexp_extract({c}, '{pattern}', 1)"
    ids = ", ".join(keys)
    split = ", ".join(f"{part(c, scheme)} AS {k}s, {part(f'{c}_', '^//([^/?#]*)')} AS {k}n, {part(f'{c}_', '^(?://[^/?#]*)?([^?#]*)')} AS {k}p, {part(f'{c}_', '^[^?#]*[?]([^#]*)')} AS {k}q, {part(f'{c}_', '^[^#]*#(.*)')} AS {k}f" for c, k in (("base", "b"), ("h", "h")))
    return rf"""seen AS (SELECT {ids}, base, h, regexp_replace(base, '{scheme}', '') AS base_, regexp_replace(h, '{scheme}', '') AS h_ FROM {refs}), cut AS (SELECT {ids}, base, h, {split} FROM seen),
walk AS (SELECT {ids}, CASE WHEN starts_with(hp, '/') THEN string_split(hp, '/') ELSE list_concat([''], list_filter(string_split(regexp_replace(bp, '[^/]*$', ''), '/'), lambda x: x <> ''), list_filter(string_split(regexp_replace(hp, '[^/]*$', ''), '/'), lambda x: x <> ''), [regexp_extract(hp, '[^/]*$')]) END AS todo, 1 AS i, []::VARCHAR[] AS kept FROM cut
UNION ALL SELECT {ids}, todo, i + 1, CASE todo[i] WHEN '..' THEN kept[:-2] WHEN '.' THEN kept ELSE list_append(kept, todo[i]) END FROM walk WHERE i <= len(todo)),
flat AS (SELECT {ids}, array_to_string(CASE WHEN list_last(todo) IN ('.', '..') THEN list_append(kept, '') ELSE kept END, '/') AS path FROM walk WHERE i > len(todo)),
urls AS (SELECT {", ".join("c." + k for k in keys)}, CASE WHEN h = '' THEN base WHEN hs <> '' AND lower(hs) <> lower(bs) THEN h ELSE lower(bs) || '://' || CASE WHEN hn <> '' THEN hn || hp ELSE bn || CASE WHEN hp = '' THEN bp WHEN starts_with(path, '/') THEN path ELSE '/' || path END END
|| CASE WHEN hq <> '' THEN '?' || hq WHEN hn = '' AND hp = '' AND bq <> '' THEN '?' || bq ELSE '' END || CASE WHEN hf <> '' THEN '#' || hf ELSE '' END END AS url FROM cut c JOIN flat f ON {" AND ".join(f"f.{k} = c.{k}" for k in keys)})"""


def page_refs(pages: str) -> str:
    """CTEs from a table of pages to `links` (page_id, page_url, position, url, text)."""
    return rf"""bare AS (SELECT page_id, url, {_BARE} AS html FROM {pages}), tags AS (SELECT page_id, url AS base, regexp_extract_all(html, '(?is)<a\s[^>]*href.*?</a\s*>') AS tags FROM bare),
one AS (SELECT page_id, base, unnest(tags) AS tag, generate_subscripts(tags, 1) - 1 AS position FROM tags),
h AS (SELECT *, regexp_extract(tag, '(?is)^<a[^>]*?href *= *("[^"]*"|''[^'']*''|[^\s"''>]+)', 1) AS quoted FROM one),
refs AS (SELECT page_id, base, position, {_REFERENCES.format("CASE WHEN left(quoted, 1) IN ('\"', '''') THEN quoted[2:-2] ELSE quoted END")} AS h, {_STRETCHES.format("regexp_replace(tag, '(?is)^<a[^>]*>|</a[^>]*>$', '', 'g')")} AS text FROM h),
{resolved("refs", "page_id", "position")}, links AS (SELECT r.page_id, r.base AS page_url, r.position::INT AS position, u.url, r.text FROM refs r JOIN urls u ON u.page_id = r.page_id AND u.position = r.position)"""


LINKS = "WITH RECURSIVE " + page_refs("pages")


@query(LINKS + " SELECT page_id, position, url, text FROM links")
def page_links(spark, sf_dir):
    return pages.links(table(spark, sf_dir, "pages")).select("page_id", "position", "url", "text")


@query(LINKS + f""", e AS (SELECT *, regexp_matches(lower(url), '\\.({"|".join(V.ASSET_SUFFIXES)})$') AS is_asset, {any_in('lower(url)', V.EXPAND_URL_FIRST)} OR {any_in('lower(text)', V.EXPAND_TEXT_FIRST)} AS first,
{any_in('lower(url)', V.EXPAND_URL_DEEPER)} OR {any_in('lower(text)', V.EXPAND_TEXT_DEEPER)} AS deeper FROM links)
SELECT page_id, count(*) AS n_links, count(DISTINCT url) AS n_distinct, count(*) FILTER (WHERE is_asset) AS n_assets, count(*) FILTER (WHERE first) AS n_first, count(*) FILTER (WHERE deeper) AS n_deeper FROM e GROUP BY page_id""")
def link_expansion(spark, sf_dir):
    found = pages.links(table(spark, sf_dir, "pages"))
    url, text = F.col("url"), F.col("text")
    return found.groupBy("page_id").agg(F.count("*").alias("n_links"), F.countDistinct("url").alias("n_distinct"), F.count_if(U.is_static_asset(url)).alias("n_assets"), F.count_if(U.expands(url, text, F.lit(0))).alias("n_first"), F.count_if(U.expands(url, text, F.lit(1))).alias("n_deeper"))


# references that a page's links might have: with dot segments, without path, with a host of their own
REFERENCES = ["../{}", "./{}", "/abs/../{}", "d/../{}/", "..", "../..", ".", "?k=1", "#f", "//other.example.org/p/../{}", "https://h.example.com/a/../{}", "mailto:a@b.example", "", "{}//x/./y", "{}/?q#g"]


@query(rf"""WITH RECURSIVE refs AS (SELECT page_id, k, rtrim(url, '/') AS base, replace(h, '{{}}', 'n' || page_id) AS h FROM pages, (VALUES {", ".join(f"({i}, '{h}')" for i, h in enumerate(REFERENCES))}) v(k, h)),
{resolved("refs", "page_id", "k")} SELECT page_id, k, url FROM urls""")
def resolved_references(spark, sf_dir):
    """Every page's url with each kind of reference."""
    kinds = F.array(*(F.struct(F.lit(i).alias("k"), F.lit(h).alias("h")) for i, h in enumerate(REFERENCES)))
    rows = table(spark, sf_dir, "pages").select("page_id", F.rtrim("url", F.lit("/")).alias("base"), F.explode(kinds).alias("r"))
    href = F.replace("r.h", F.lit("{}"), F.concat(F.lit("n"), F.col("page_id").cast("string")))
    return rows.select("page_id", "r.k", U.joined(F.col("base"), href).alias("url"))


# the pages' own links as report links, with comments, entities and each kind of quotes
_REPORT_LINK = """<A class=x HREF = '../annual report/$1-2023.pdf'><!-- <a href="/hidden.pdf">10-k</a> --> <b>10-K</b> &amp;&lt;b&gt; """
_REPORT_LIST = "<ul><li><a href=/forms/f.pdf>Form</a><li><a href=plain-2018.PDF>Plain<br>2020</a>"


@query(rf"""WITH RECURSIVE p AS (SELECT page_id, url, replace(regexp_replace(html, '<a href="/([^"]*)">', '{_REPORT_LINK.replace("'", "''").replace("$1", chr(92) + "1")}', 'g'), '<ul>', '{_REPORT_LIST}') AS html FROM pages), {page_refs("p")},
l AS (SELECT *, lower(url) AS lu, lower(text) AS lt FROM links),
y AS (SELECT *, list_sort(list_distinct(list_concat(regexp_extract_all(lt, '\b(19[0-9]{{2}}|20[0-9]{{2}})\b', 1), regexp_extract_all(lu, '\b(19[0-9]{{2}}|20[0-9]{{2}})\b', 1)))) AS y, contains(lt, '10-k') OR contains(lt, '10k') OR contains(lu, '10-k') AS k FROM l WHERE ends_with(lu, '.pdf') AND NOT {any_in('lu', V.NOT_REPORTS)} AND NOT {any_in('lt', V.NOT_REPORTS)}),
s AS (SELECT *, (10 + CASE WHEN contains(lt, 'annual report') OR contains(lu, 'annual report') THEN 20 WHEN contains(lt, 'annual') OR contains(lu, 'annual') THEN 10 ELSE 0 END + CASE WHEN k THEN 15 ELSE 0 END + coalesce(list_sum(list_transform(y, lambda v: CASE WHEN v::INT >= 2019 THEN 4 ELSE 2 END)), 0))::INT AS score FROM y),
r AS (SELECT *, count(*) OVER (PARTITION BY page_id) AS n, row_number() OVER (PARTITION BY page_id ORDER BY score DESC, position) AS place FROM s)
SELECT page_id, n AS pdf_count_on_page, url AS best_pdf_url, score AS best_pdf_score, array_to_string(y, ', ') AS best_pdf_years, CASE WHEN k THEN 'YES' ELSE 'NO' END AS best_pdf_is_10k, text AS best_pdf_anchor FROM r WHERE place = 1""")
def page_pdf_analysis(spark, sf_dir):
    """From the markup of whole pages to the best report of each: links, filters, years, scores, the first of the best."""
    html = F.replace(F.regexp_replace("html", r'<a href="/([^"]*)">', _REPORT_LINK), F.lit("<ul>"), F.lit(_REPORT_LIST))
    return pages.best_pdfs(pages.links(table(spark, sf_dir, "pages").withColumn("html", html)))


TITLE = _STRETCHES.format(f"regexp_extract({_BARE}, '(?is)<title[^>]*>(.*?)</title>', 1)")
# the driver's pages name no reports, so the rule words here are frequent words of theirs, with the same weights
DEMO_RULES = [("annual_report", 25, ["the of", "en/", "onth"]), ("10-K", 18, ["tion", "/de/"]), ("sec_filings", 8, ["html", "page="])]
DEMO_NEGATIVES = ["ref=", "blog.", "ing"]
_RULE_ROWS = [(t, k, w) for t, w, ks in DEMO_RULES for k in ks] + [("NEG", k, -8) for k in DEMO_NEGATIVES]
RULES_SQL = "(VALUES " + ", ".join(f"({i}, '{t}', '{k}', {w})" for i, (t, k, w) in enumerate(_RULE_ROWS)) + ") AS r(place, tag, keyword, points)"


@query(f"""WITH p AS (SELECT page_id, url, {TITLE} AS page_title FROM pages), h AS (SELECT p.*, r.* FROM p LEFT JOIN {RULES_SQL} ON contains(lower(url), keyword) OR contains(lower(' ' || page_title), keyword)),
s AS (SELECT page_id, page_title, coalesce(sum(points), 0)::INT AS score, coalesce(array_to_string(list_sort(list_distinct(list(tag) FILTER (WHERE tag <> 'NEG'))), ';'), '') AS tags, coalesce(string_agg(tag || '::' || keyword, ';' ORDER BY place), '') AS reasons FROM h GROUP BY ALL)
SELECT *, CASE WHEN score >= 30 THEN 'HIGH' WHEN score >= 15 THEN 'MEDIUM' WHEN score >= 5 THEN 'LOW' END AS level FROM s""")
def page_scores(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select("page_id", "url", M.page_title(F.col("html")).alias("page_title"))
    words = F.concat(F.lit(" "), F.col("page_title"))
    hit = rows.withColumn("h", pages.matched_rules(F.col("url"), words, DEMO_RULES, DEMO_NEGATIVES))
    positive = F.filter("h", lambda r: r["tag"] != "NEG")
    score = F.aggregate("h", F.lit(0), lambda a, r: a + r["points"])
    return hit.select(
        "page_id", "page_title", score.alias("score"), F.array_join(F.array_sort(F.array_distinct(F.transform(positive, lambda r: r["tag"]))), ";").alias("tags"),
        F.array_join(F.transform("h", lambda r: F.concat_ws("::", r["tag"], r["keyword"])), ";").alias("reasons"), pages.level(score).alias("level"),
    )


@query(f"""WITH p AS (SELECT page_id, url, {TITLE} AS t FROM pages) SELECT page_id, sum(points)::BIGINT AS score, count(*) AS n_hits FROM p JOIN {RULES_SQL} ON contains(lower(url), keyword) OR contains(lower(t), keyword) GROUP BY page_id""")
def rule_keyword_join(spark, sf_dir):
    return pages.score_by_rules(table(spark, sf_dir, "pages"), pages.keyword_points(spark, DEMO_RULES, DEMO_NEGATIVES)).select("page_id", "score", "n_hits")


@query(f"""WITH w AS (SELECT DISTINCT unnest(string_split(lower(text), ' ')) AS keyword FROM benchmark), r AS (SELECT keyword, row_number() OVER (ORDER BY keyword)::INT AS place FROM w WHERE length(keyword) > 3),
p AS (SELECT page_id, url, {TITLE} AS t FROM pages), h AS (SELECT page_id, place, keyword, place % 7 - 2 AS points, CASE WHEN place % 7 < 2 THEN 'NEG' ELSE 'kind' || place % 7 END AS tag FROM p JOIN r ON contains(lower(url), keyword) OR contains(lower(t), keyword))
SELECT page_id, sum(points)::BIGINT AS score, count(*) AS n_hits, coalesce(array_to_string(list_sort(list_distinct(list(tag) FILTER (WHERE tag <> 'NEG'))), ';'), '') AS tags, string_agg(tag || '::' || keyword, ';' ORDER BY place) AS reasons FROM h GROUP BY page_id""")
def rules_from_a_table(spark, sf_dir):
    """Thousands of rules that come as data: every longer word of the benchmark is one."""
    words = table(spark, sf_dir, "benchmark").select(F.explode(F.split(F.lower("text"), " ")).alias("keyword")).distinct().where("length(keyword) > 3")
    words = chunks.numbered(words, ["keyword"]).withColumn("place", (F.col("global_id") + 1).cast("int"))
    kind = F.col("place") % 7
    rules = words.select("place", F.when(kind < 2, "NEG").otherwise(F.concat(F.lit("kind"), kind.cast("string"))).alias("tag"), "keyword", (kind - 2).alias("points"))
    return pages.score_by_rules(table(spark, sf_dir, "pages"), rules)


# report links made of the part table: a name as text, a year and a kind in the url
PARTS = """WITH l AS (SELECT p_partkey % 100 AS page_id, p_partkey AS position, 'https://x' || p_partkey % 7 || '.example.com/' || CASE p_partkey % 5 WHEN 0 THEN 'annual report' WHEN 1 THEN 'annual' WHEN 2 THEN '10-k' WHEN 3 THEN 'policy' ELSE 'doc' END || '-' || (1995 + p_size) || '/f.pdf' AS url, p_name || ' ' || (2000 + p_size % 30) || CASE WHEN p_size % 9 = 0 THEN ' 10k' ELSE '' END AS text FROM part)"""
_ANNUAL = "CASE WHEN contains(lower(text), 'annual report') OR contains(url, 'annual report') THEN 20 WHEN contains(lower(text), 'annual') OR contains(url, 'annual') THEN 10 ELSE 0 END"
_YEARS = r"list_sort(list_distinct(list_concat(regexp_extract_all(lower(text), '\b(19[0-9]{2}|20[0-9]{2})\b', 1), regexp_extract_all(url, '\b(19[0-9]{2}|20[0-9]{2})\b', 1))))"
_KIND = "contains(lower(text), '10-k') OR contains(lower(text), '10k') OR contains(url, '10-k')"
SCORED = PARTS + f""", s AS (SELECT *, {_YEARS} AS y, {_KIND} AS k FROM l WHERE NOT {any_in('url', V.NOT_REPORTS)} AND NOT {any_in('lower(text)', V.NOT_REPORTS)}),
pdf AS (SELECT page_id, position, url, text, array_to_string(y, ', ') AS years, k AS is_10k, (10 + {_ANNUAL} + CASE WHEN k THEN 15 ELSE 0 END + list_sum(list_transform(y, lambda v: CASE WHEN v::INT >= 2019 THEN 4 ELSE 2 END)))::INT AS score FROM s)"""


def _part_links(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    kind = F.when(F.col("p_partkey") % 5 == 0, "annual report").when(F.col("p_partkey") % 5 == 1, "annual").when(F.col("p_partkey") % 5 == 2, "10-k").when(F.col("p_partkey") % 5 == 3, "policy").otherwise("doc")
    url = F.concat(F.lit("https://x"), (F.col("p_partkey") % 7).cast("string"), F.lit(".example.com/"), kind, F.lit("-"), (F.col("p_size") + 1995).cast("string"), F.lit("/f.pdf"))
    text = F.concat("p_name", F.lit(" "), (F.col("p_size") % 30 + 2000).cast("string"), F.when(F.col("p_size") % 9 == 0, " 10k").otherwise(""))
    return p.select((F.col("p_partkey") % 100).alias("page_id"), F.col("p_partkey").alias("position"), url.alias("url"), text.alias("text"))


@query(SCORED + " SELECT page_id, position, years, is_10k, score FROM pdf")
def pdf_link_scores(spark, sf_dir):
    return pages.pdf_links(_part_links(spark, sf_dir)).select("page_id", "position", "years", "is_10k", "score")


@query(SCORED + """ SELECT page_id, count(*) AS pdf_count_on_page, arg_max(url, score * 10000000 - position) AS best_pdf_url, max(score) AS best_pdf_score FROM pdf GROUP BY page_id""")
def best_pdf_per_page(spark, sf_dir):
    return pages.best_pdfs(_part_links(spark, sf_dir)).select("page_id", "pdf_count_on_page", "best_pdf_url", "best_pdf_score")


@query(SCORED + " SELECT url, max(score) AS score, arg_max(position, score * 10000000 - position) AS position FROM pdf GROUP BY url")
def keep_best_duplicate(spark, sf_dir):
    return pages.best_of_duplicates(pages.pdf_links(_part_links(spark, sf_dir))).select("url", "score", "position")


@query(PARTS + r""" SELECT position, CASE WHEN regexp_matches(b, '10-k|10k') THEN '10-K' WHEN contains(b, 'annual') THEN 'annual_report' WHEN contains(b, 'proxy') THEN 'proxy' WHEN contains(b, 'sec') THEN 'sec_filing' ELSE 'other' END AS report_type,
(3 + CASE WHEN regexp_matches(b, '(20[01][0-9]|202[0-5])') THEN 3 ELSE 0 END + CASE WHEN contains(b, 'annual') THEN 4 ELSE 0 END + CASE WHEN contains(b, '10-k') THEN 4 ELSE 0 END + CASE WHEN contains(b, '10k') THEN 4 ELSE 0 END + CASE WHEN contains(b, 'report') THEN 2 ELSE 0 END + CASE WHEN contains(b, 'financial') THEN 2 ELSE 0 END + CASE WHEN contains(b, 'sec') THEN 1 ELSE 0 END + CASE WHEN contains(b, 'statement') THEN 1 ELSE 0 END)::INT AS score
FROM (SELECT position, lower(text) || chr(10) || url AS b FROM l)""")
def simple_link_scores(spark, sf_dir):
    url, text = F.col("url"), F.col("text")
    return _part_links(spark, sf_dir).select("position", U.simple_report_type(url, text).alias("report_type"), U.simple_link_score(url, text).alias("score"))


DOWNLOADS = PARTS + r""", d AS (SELECT position, url, text AS username, (position % 40) - 20 AS score FROM l), k AS (SELECT *, lower(url) || ' ' || lower(username) AS t FROM d),
c AS (SELECT *, CASE WHEN contains(t, '10-k') OR contains(replace(t, ' ', ''), 'form10k') THEN '10k' WHEN contains(t, 'annual-report') OR contains(replace(t, ' ', ''), 'annualreport') OR contains(t, 'annual review') THEN 'annual_report' WHEN contains(t, 'proxy') AND contains(t, 'statement') THEN 'proxy'
WHEN regexp_matches(t, 'presentation|slides|deck') THEN 'presentation' WHEN contains(t, 'quarterly') OR regexp_matches(t, 'q[1-4]\s*20\d{2}') THEN 'quarterly' WHEN regexp_matches(t, '8-k|6-k') THEN 'sec_other' ELSE 'other' END AS pdf_type,
coalesce(list_max(list_filter(list_transform(regexp_extract_all(url, '(20\d{2})', 1), lambda y: y::INT), lambda y: y BETWEEN 2000 AND 2027))::VARCHAR, 'unknown') AS year,
CASE WHEN score < 0 AND NOT regexp_matches(lower(url), 'annual|10-k') THEN 'skip_low_score' ELSE 'pending' END AS status FROM k)"""


def _download_plan(spark, sf_dir) -> DataFrame:
    rows = _part_links(spark, sf_dir).select("position", "url", F.col("text").alias("username"), F.col("position").alias("idrssd"), ((F.col("position") % 40) - 20).alias("score"))
    return downloads.plan(rows, 2026)


@query(DOWNLOADS + r""" SELECT position, pdf_type, year, status, CASE WHEN status = 'pending' THEN 'reports/' || pdf_type || '/' || year || '/' || left(regexp_replace(regexp_replace(trim(username), '[ \t\n\r]+', '_', 'g'), '[^0-9A-Za-z_\-]+', '', 'g'), 60) || '_' || position || '/fpdf.pdf' ELSE '' END AS local_path FROM c""")
def download_plan(spark, sf_dir):
    return _download_plan(spark, sf_dir).select("position", "pdf_type", "year", "status", "local_path")


@query(DOWNLOADS + " SELECT CASE WHEN status = 'pending' AND position % 3 = 0 THEN 'success' ELSE status END AS status, count(*) AS n FROM c GROUP BY 1")
def resumed_status_counts(spark, sf_dir):
    planned = _download_plan(spark, sf_dir)
    done = planned.where((F.col("position") % 3 == 0) & (F.col("status") == "pending")).select("local_path", F.lit(1).alias("size"))
    return downloads.status_counts(downloads.resume(planned, done))


# --- crawl ----------------------------------------------------------------------------------------------------------
GRAPH = """WITH RECURSIVE n AS (SELECT page_id, row_number() OVER (ORDER BY page_id) - 1 AS i, count(*) OVER () AS c FROM pages),
e AS (SELECT a.page_id AS src, b.page_id AS dst FROM n a JOIN n b ON b.i IN ((a.i * 3 + 1) % a.c, (a.i * 3 + 2) % a.c, (a.i + 7) % a.c)),
walk AS (SELECT page_id AS bank, page_id AS node, 0 AS depth FROM n UNION SELECT w.bank, e.dst, w.depth + 1 FROM walk w JOIN e ON e.src = w.node WHERE w.depth < 2)"""


def graph_pages(spark, sf_dir) -> DataFrame:
    """The pages as a graph whose links are made of their places, as html that the crawl parses."""
    rows = table(spark, sf_dir, "pages").select("page_id")
    n = rows.count()
    counts = chunks.numbered(rows, ["page_id"]).withColumnRenamed("global_id", "i")
    to = lambda j: F.concat(F.lit('<a href="/annual/'), (j % n).cast("string"), F.lit('">annual</a>'))
    i = F.col("i")
    return counts.select("page_id", i, F.concat(F.lit("https://b.example.com/annual/"), i.cast("string")).alias("url"), F.concat(to(i * 3 + 1), to(i * 3 + 2), to(i + 7)).alias("html"))


@query(GRAPH + " SELECT bank, node, min(depth)::INT AS depth FROM walk GROUP BY bank, node")
def bounded_crawl(spark, sf_dir):
    made = graph_pages(spark, sf_dir)
    starts = made.select(F.col("page_id").alias("bank"), F.col("url").alias("start_url"), F.lit("example.com").alias("base_root"), F.lit("example.com").alias("entry_root"))
    out = crawl.crawl(starts, made)
    return out.join(made.select("url", F.col("page_id").alias("node")), "url").select("bank", "node", "depth")


# the pages as a site: each is named by two letters of its first link, the first of one name counts, and their own links lead to such names
_SITE = """WITH RECURSIVE named AS (SELECT page_id, regexp_extract(html, '<a href="/([A-Za-z]{2})[^"]*">', 1) AS name, regexp_replace(html, 'href="/([A-Za-z]{2})[^"]*"', 'href="/annual/x/../\\1"', 'g') AS html FROM pages),
site AS (SELECT min(page_id) AS page_id, 'https://b.example.com/annual/' || name AS url, arg_min(html, page_id) AS html FROM named WHERE name <> '' GROUP BY name)"""


@query(_SITE + ", " + page_refs("site") + """, e AS (SELECT DISTINCT l.page_url AS src, l.url AS dst, l.position AS p FROM links l JOIN site s ON s.url = l.url),
w0 AS (SELECT page_id AS bank, url AS node, 0 AS depth, []::INT[] AS path, NULL AS parent_url FROM site),
w1 AS (SELECT bank, dst AS node, 1 AS depth, min(list_append(path, p)) AS path, arg_min(src, list_append(path, p)) AS parent_url FROM w0 JOIN e ON src = node WHERE dst <> node GROUP BY 1, 2),
k1 AS (SELECT *, row_number() OVER (PARTITION BY bank ORDER BY path, node) + 1 AS place FROM w1), c1 AS (SELECT * FROM k1 WHERE place <= 8),
w2 AS (SELECT c1.bank, dst AS node, 2 AS depth, min(list_append(path, p)) AS path, arg_min(src, list_append(path, p)) AS parent_url FROM c1 JOIN e ON src = node WHERE NOT EXISTS (SELECT 1 FROM c1 x WHERE x.bank = c1.bank AND x.node = dst) AND NOT EXISTS (SELECT 1 FROM w0 x WHERE x.bank = c1.bank AND x.node = dst) GROUP BY 1, 2),
k2 AS (SELECT w2.*, row_number() OVER (PARTITION BY bank ORDER BY path, node) + 1 + (SELECT count(*) FROM c1 x WHERE x.bank = w2.bank) AS place FROM w2)
SELECT bank, node AS url, depth, parent_url, place::INT AS place FROM (SELECT bank, node, depth, parent_url, 1 AS place FROM w0 UNION ALL SELECT bank, node, depth, parent_url, place FROM c1 UNION ALL SELECT bank, node, depth, parent_url, place FROM k2 WHERE place <= 8)""")
def page_crawl(spark, sf_dir):
    """A crawl through the markup of whole pages from each of them, cut to eight pages."""
    name, html = F.regexp_extract("html", r'<a href="/([A-Za-z]{2})[^"]*">', 1), F.regexp_replace("html", r'href="/([A-Za-z]{2})[^"]*"', 'href="/annual/x/../$1"')
    named = table(spark, sf_dir, "pages").select("page_id", name.alias("name"), html.alias("html")).where("name <> ''")
    site = named.groupBy("name").agg(F.min("page_id").alias("page_id"), F.min_by("html", "page_id").alias("html")).select("page_id", F.concat(F.lit("https://b.example.com/annual/"), "name").alias("url"), "html")
    starts = site.select(F.col("page_id").alias("bank"), F.col("url").alias("start_url"), F.lit("example.com").alias("base_root"), F.lit("example.com").alias("entry_root"))
    return crawl.crawl(starts, site, max_pages=8).select("bank", "url", "depth", "parent_url", "place")


# --- vectors and retrieval ----------------------------------------------------------------------------------------
DOT = "list_sum(list_transform(range(1, 65), lambda i: v.embedding[i]::DOUBLE * q.embedding[i]::DOUBLE))"
RANKED = f"""WITH s AS (SELECT q.vec_id AS query_id, v.vec_id, v.label, round({DOT}, 9) AS score FROM embeddings v, (SELECT * FROM embeddings WHERE vec_id % 20 = 0) q),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)"""


def _ranked(spark, sf_dir, k: int = 1 << 30) -> DataFrame:
    v = table(spark, sf_dir, "embeddings")
    return vectors.top_k(v.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query")), v, k, "vec_id", 9)


@query(RANKED + " SELECT query_id, vec_id, rank::INT AS rank, round(score, 6) AS score FROM r WHERE rank <= 50")
def vector_top_k(spark, sf_dir):
    return _ranked(spark, sf_dir, 50).select("query_id", "vec_id", "rank", F.round("score", 6).alias("score"))


@query(RANKED + """, b AS (SELECT *, first_value(label) OVER (PARTITION BY query_id ORDER BY rank) AS best FROM r WHERE rank <= 50)
SELECT query_id, vec_id, label, place::INT AS place FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rank) AS place FROM b WHERE label = best) WHERE place <= 20""")
def single_entity_top_k(spark, sf_dir):
    hits = _ranked(spark, sf_dir, 50).withColumn("bank", F.col("label"))
    return retrieval.bank_of_best(hits).select("query_id", "vec_id", "label", "place")


@query(RANKED + """, m AS (SELECT *, min(rank) OVER (PARTITION BY query_id) AS r1 FROM r WHERE label = 3), k AS (SELECT *, 20 * 2 ** greatest(0, ceil(log2(r1 / 20.0))) AS k FROM m)
SELECT query_id, vec_id, rank::INT AS rank, k::INT AS k_used FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rank) AS n FROM k WHERE rank <= k) WHERE n <= 10""")
def adaptive_k_entity(spark, sf_dir):
    v = table(spark, sf_dir, "embeddings")
    asked = v.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    return vectors.adaptive_top_k(asked, v, asked.select("query_id", F.lit(3).alias("label")), 10, 20, 20_000, "vec_id", 9).select("query_id", "vec_id", "rank", "k_used")


@query(RANKED + """, m AS (SELECT *, min(rank) OVER (PARTITION BY query_id) AS r1 FROM r WHERE label = (query_id // 20) % 10), k AS (SELECT *, 20 * 2 ** greatest(0, ceil(log2(r1 / 20.0))) AS k FROM m)
SELECT query_id, vec_id, label, rank::INT AS rank, k::INT AS k_used FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rank) AS n FROM k WHERE rank <= k) WHERE n <= 10 + query_id % 3""")
def adaptive_k_entities(spark, sf_dir):
    """Each query asks for an entity of its own, and for a number of its own."""
    v = table(spark, sf_dir, "embeddings")
    asked = v.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"), F.expr("(vec_id div 20) % 10").alias("asked"), (F.col("vec_id") % 3 + 10).alias("want"))
    return vectors.adaptive_top_k(asked, v, asked.select("query_id", F.col("asked").alias("label")), F.col("want"), 20, 20_000, "vec_id", 9).select("query_id", "vec_id", "label", "rank", "k_used")


@query(RANKED + " SELECT query_id, vec_id, label, rank::INT AS rank, round(score, 6) AS score FROM r WHERE rank <= 10")
def indexed_top_k(spark, sf_dir):
    """An index of the vectors, built in two batches, searched for every query; cells that can't hold a hit are not read."""
    v = table(spark, sf_dir, "embeddings")
    at = f"{scratch.shared_dir(spark)}/index-{uuid.uuid4().hex}"
    vector_index.build(v.where("vec_id % 3 <> 0"), at, 24)
    vector_index.append(v.where("vec_id % 3 = 0"), at)
    asked = v.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    return vector_index.search(asked, at, 10, "vec_id", 9).select("query_id", "vec_id", "label", "rank", F.round("score", 6).alias("score"))


HITS = RANKED + """, h AS (SELECT query_id AS target, vec_id // 10 AS stem, vec_id % 10 AS chunk_id, label AS bank, vec_id, score, rank FROM r WHERE rank <= 60)"""


def _hits(spark, sf_dir) -> DataFrame:
    r = _ranked(spark, sf_dir, 60)
    return r.select(F.col("query_id").alias("target"), F.floor(F.col("vec_id") / 10).alias("stem"), (F.col("vec_id") % 10).alias("chunk_id"), F.col("label").alias("bank"), "vec_id", "score", "rank")


@query(HITS + """, y AS (SELECT *, contains(stem::VARCHAR, '24') AS good FROM h), a AS (SELECT *, max(good) OVER (PARTITION BY target) AS any_good FROM y) SELECT target, vec_id FROM a WHERE good OR NOT any_good""")
def year_preference(spark, sf_dir):
    hits = _hits(spark, sf_dir).withColumn("stem", F.concat(F.lit("FY"), F.col("stem").cast("string")))
    hits = hits.withColumn("stem", F.when(F.contains("stem", F.lit("24")), F.lit("AR FY24")).otherwise("AR"))
    return retrieval.prefer_year(hits, 2024, ["target"]).select("target", "vec_id")


@query(HITS + """, f AS (SELECT *, count(*) FILTER (WHERE score >= 0.5) OVER (PARTITION BY target) AS strong FROM h)
SELECT target, vec_id, place::INT AS place FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY score DESC, rank) AS place FROM f WHERE strong < 3 OR score >= 0.5) WHERE place <= 20""")
def pooled_floor(spark, sf_dir):
    hits = retrieval.floored(_hits(spark, sf_dir), 0.5, 3, ["target"])
    return retrieval.top_n(hits, 20, ["target"], [F.desc("score"), "rank"]).select("target", "vec_id", "place")


@query(HITS + """, b AS (SELECT *, max(score) OVER (PARTITION BY target) AS best FROM h WHERE vec_id <> target), t AS (SELECT *, CASE WHEN best >= 0.9 THEN 0.9 WHEN best >= 0.85 THEN 0.85 ELSE -1e9 END AS tier FROM b)
SELECT target, vec_id FROM t WHERE score >= tier""")
def threshold_ladder(spark, sf_dir):
    return retrieval.laddered(_hits(spark, sf_dir).where("vec_id <> target"), F.lit(0.9), ["target"]).select("target", "vec_id")


NEIGHBOURS = """, o AS (SELECT vec_id, 0 AS bank, vec_id // 10 AS stem, vec_id % 10 AS chunk_id FROM embeddings), p AS (SELECT target, vec_id, 0 AS bank, stem, chunk_id, score, rank AS place FROM h WHERE rank <= 5),
n AS (SELECT target, bank, stem, chunk_id, score, 0 AS kind, place, 0 AS far FROM p UNION ALL SELECT p.target, o.bank, o.stem, o.chunk_id, p.score - 1e-6, 1, p.place, d.far FROM p, (VALUES (-2), (-1), (1), (2)) d(far), o WHERE o.stem = p.stem AND o.chunk_id = p.chunk_id + d.far),
u AS (SELECT *, row_number() OVER (PARTITION BY target, stem, chunk_id ORDER BY kind, place, far) AS k FROM n)"""


@query(HITS + NEIGHBOURS + " SELECT target, stem, chunk_id, round(score, 6) AS score, (row_number() OVER (PARTITION BY target ORDER BY kind, place, far))::INT AS place FROM u WHERE k = 1")
def neighbour_expansion(spark, sf_dir):
    every = table(spark, sf_dir, "embeddings").select(F.lit(0).alias("bank"), F.floor(F.col("vec_id") / 10).alias("stem"), (F.col("vec_id") % 10).alias("chunk_id"), F.lit("").alias("text"))
    hits = _hits(spark, sf_dir).where("rank <= 5").withColumn("bank", F.lit(0)).withColumn("text", F.lit("")).withColumn("place", F.col("rank"))
    out = retrieval.with_neighbours(hits.select("target", "bank", "stem", "chunk_id", "text", "score", "place"), every, 2, ["target"])
    return out.select("target", "stem", "chunk_id", F.round("score", 6).alias("score"), "place")


@query("""WITH c AS (SELECT doc_id, source AS bank, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS place, 1.0 / row_number() OVER (PARTITION BY source ORDER BY doc_id) AS score, CASE WHEN length(text) > 4200 AND r THEN left(text, 1600) || chr(10) || '...[middle truncated]...' || chr(10) || right(text, 2600) WHEN length(text) > 1400 AND NOT r THEN left(text, 700) || chr(10) || '...[middle truncated]...' || chr(10) || right(text, 700) ELSE text END AS t FROM (SELECT *, """ + any_in('lower(text)', V.RATIO_PHRASES) + """ AS r FROM documents))
SELECT bank, md5(string_agg('[k=' || bank || '|stem=' || doc_id || '|chunk=0]' || chr(10) || '(rank=' || place || ' score=' || printf('%.4f', score::DOUBLE) || ')' || chr(10) || t, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY place)) AS context_md5, count(*) AS n_blocks FROM c WHERE place <= 8 GROUP BY bank""")
def context_assembly(spark, sf_dir):
    place = F.row_number().over(Window.partitionBy("source").orderBy("doc_id"))
    c = table(spark, sf_dir, "documents").select(F.col("source").alias("bank"), F.col("doc_id").alias("stem"), F.lit(0).alias("chunk_id"), "text", place.alias("place"))
    hits = c.where("place <= 8").withColumn("score", 1 / F.col("place"))
    return retrieval.context(hits, ["bank"]).select("bank", F.md5("context").alias("context_md5"), "n_blocks")


@query("""WITH a AS (SELECT DISTINCT lower(trim(c_mktsegment)) AS a FROM customer), b AS (SELECT DISTINCT lower(trim(p_type)) AS b FROM part UNION SELECT DISTINCT lower(c_mktsegment) || ' holdings' FROM customer)
SELECT a, b FROM a, b WHERE starts_with(a, b) OR starts_with(b, a) OR (contains(a, b) AND length(b) >= 8) OR (contains(b, a) AND length(a) >= 8)""")
def fuzzy_entity_join(spark, sf_dir):
    c, p = table(spark, sf_dir, "customer"), table(spark, sf_dir, "part")
    a = c.select(F.lower(F.trim("c_mktsegment")).alias("a")).distinct()
    b = p.select(F.lower(F.trim("p_type")).alias("b")).union(c.select(F.concat(F.lower("c_mktsegment"), F.lit(" holdings")))).distinct()
    return retrieval.entity_pairs(a, b, "a", "b")


@query("SELECT n_name AS name, coalesce((SELECT arg_min(r_name, r_regionkey) FROM region WHERE lower(trim(r_name)) = lower(trim(n.n_name))), n_name) AS canonical FROM (SELECT n_name FROM nation UNION SELECT lower(r_name) FROM region) n")
def canonical_entities(spark, sf_dir):
    r = table(spark, sf_dir, "region")
    asked = table(spark, sf_dir, "nation").select(F.col("n_name").alias("name")).union(r.select(F.lower("r_name"))).distinct()
    return retrieval.canonical(asked, r.select(F.col("r_name").alias("name"), F.col("r_regionkey").alias("place")))


# --- shards, joins, resume ------------------------------------------------------------------------------------------
@query("""WITH v AS (SELECT o_custkey % 50 AS s, count(*) AS nv FROM orders GROUP BY 1), m AS (SELECT c_custkey % 60 AS s, count(*) AS nm FROM customer GROUP BY 1)
SELECT coalesce(v.s, m.s) AS stem, coalesce(nv, 0) AS num_vec, coalesce(nm, 0) AS num_meta, CASE WHEN coalesce(nv, 0) = coalesce(nm, 0) THEN 'ok' ELSE 'mismatch' END AS status FROM v FULL JOIN m ON v.s = m.s""")
def shard_consistency(spark, sf_dir):
    v = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 50).alias("stem"))
    m = table(spark, sf_dir, "customer").select((F.col("c_custkey") % 60).alias("stem"))
    return checks.shard_counts(v, m, ["stem"])


@query("SELECT DISTINCT o_custkey AS stem FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey < 20)")
def complete_shards(spark, sf_dir):
    c = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "stem")
    return checks.complete_shards(table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "stem"), c.where("c_acctbal > 0"), c.where("c_nationkey < 20"), ["stem"])


@query("SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'skip' ELSE 'todo' END AS status FROM documents")
def resume_markers(spark, sf_dir):
    return checks.with_status(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), ["doc_id"])


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def pending_items(spark, sf_dir):
    return checks.pending(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels").select("doc_id"), ["doc_id"])


# --- metrics ----------------------------------------------------------------------------------------------------------
# records made of orders: a bank for each five orders of a customer, a result for each order, some missing, some with bad or other years' citations
RECORDS = """WITH o AS (SELECT o_custkey AS bank, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS i, o_orderkey AS k, o_totalprice AS p FROM orders),
m AS (SELECT bank * 100 + (i - 1) // 5 AS bank, (['ROA','ROE','NIM','NII','Provision for Credit Losses'])[(i - 1) % 5 + 1] AS metric_name, CASE k % 4 WHEN 0 THEN 'NOT FOUND' WHEN 1 THEN round(p / 100000, 2)::DECIMAL(10,2)::VARCHAR || '%' ELSE floor(p)::BIGINT::VARCHAR END AS value,
CASE k % 3 WHEN 0 THEN '' ELSE 'thousand' END AS unit, CASE k % 6 WHEN 0 THEN 'NOT FOUND' WHEN 1 THEN '[k=a|stem=AR 2023|chunk=' || k || ']' WHEN 2 THEN 'abc' WHEN 3 THEN k::VARCHAR ELSE '[k=a|stem=AR 2024|chunk=1]' END AS cid FROM o)"""


def _records(spark, sf_dir) -> DataFrame:
    i = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("bank"), i.alias("i"), F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("p"))
    o = o.select((F.col("bank") * 100 + F.expr("(i - 1) div 5")).alias("bank"), ((F.col("i") - 1) % 5 + 1).alias("i"), "k", "p")
    k = F.col("k")
    value = F.when(k % 4 == 0, "NOT FOUND").when(k % 4 == 1, F.concat(F.round(F.col("p") / 100000, 2).cast("decimal(10,2)").cast("string"), F.lit("%"))).otherwise(F.floor("p").cast("string"))
    cid = F.when(k % 6 == 0, "NOT FOUND").when(k % 6 == 1, F.concat(F.lit("[k=a|stem=AR 2023|chunk="), k.cast("string"), F.lit("]"))).when(k % 6 == 2, "abc").when(k % 6 == 3, k.cast("string")).otherwise("[k=a|stem=AR 2024|chunk=1]")
    name = F.element_at(F.array(*[F.lit(m) for m in V.METRICS]), F.col("i"))
    row = F.struct("i", name.alias("metric_name"), value.alias("value"), F.when(k % 3 == 0, "").otherwise("thousand").alias("unit"), cid.alias("source_chunk_id"))
    out = o.groupBy("bank").agg(F.transform(F.array_sort(F.collect_list(row)), lambda r: r.dropFields("i")).alias("results"))
    return out.withColumn("year", F.lit(2024)).withColumn("topk", F.lit(20)).withColumn("error", F.when(F.col("bank") % 7 == 0, "TIMEOUT").otherwise(""))


FLAT = """SELECT bank, 2024 AS year, metric_name, CASE WHEN value LIKE '%\\%' ESCAPE '\\' THEN rtrim(value, '%') ELSE value END AS val, CASE WHEN value LIKE '%\\%' ESCAPE '\\' THEN '%' WHEN unit = '' THEN 'NOT FOUND' ELSE unit END AS unit, cid AS source_chunk_id FROM m"""


@query(f"{RECORDS} {FLAT}")
def flatten_metrics(spark, sf_dir):
    return metrics.flat(_records(spark, sf_dir))


@query(f"{RECORDS} SELECT bank, year, metric_name AS metric, val, unit, source_chunk_id AS chunk FROM ({FLAT}) WHERE val <> 'NOT FOUND'")
def audit_rows(spark, sf_dir):
    return metrics.audit(metrics.flat(_records(spark, sf_dir)))


DIAGNOSED = RECORDS + r""", d AS (SELECT bank, 2024 AS year, 20 AS topk, CASE WHEN bank % 7 = 0 THEN 'OK_WITH_ERROR' ELSE 'OK' END AS status, CASE WHEN bank % 7 = 0 THEN 'TIMEOUT' ELSE '' END AS error,
count(DISTINCT metric_name) FILTER (WHERE value <> 'NOT FOUND')::INT AS n_found, coalesce(array_to_string(list_sort(list(DISTINCT metric_name) FILTER (WHERE value <> 'NOT FOUND')), ','), '') AS found_metrics, count(*) FILTER (WHERE cid = 'abc')::INT AS n_bad_cite,
coalesce(array_to_string(list_sort(list(DISTINCT metric_name) FILTER (WHERE contains(cid, 'AR 2023'))), ','), '') AS year_mismatch_metrics, count(*)::INT AS n_results FROM m GROUP BY bank)"""


@query(DIAGNOSED + " SELECT * FROM d")
def record_diagnostics(spark, sf_dir):
    return metrics.diagnosed(_records(spark, sf_dir), 2024)


@query(DIAGNOSED + """ SELECT * FROM (SELECT 'HAS_ERROR' AS category, count(*) FILTER (WHERE error <> '') AS n FROM d UNION ALL SELECT 'FOUND_0', count(*) FILTER (WHERE n_found = 0) FROM d UNION ALL SELECT 'FOUND_GT0', count(*) FILTER (WHERE n_found > 0) FROM d
UNION ALL SELECT 'BAD_CITE', count(*) FILTER (WHERE n_bad_cite > 0) FROM d UNION ALL SELECT 'YEAR_MISMATCH', count(*) FILTER (WHERE year_mismatch_metrics <> '') FROM d) WHERE n > 0""")
def category_counters(spark, sf_dir):
    return metrics.counters(metrics.diagnosed(_records(spark, sf_dir), 2024))


@query(RECORDS + " SELECT length, count(*) AS n FROM (SELECT count(*)::VARCHAR AS length FROM m GROUP BY bank) GROUP BY length")
def result_lengths(spark, sf_dir):
    return metrics.result_lengths(_records(spark, sf_dir))


@query(f"{RECORDS}, f AS ({FLAT}) SELECT metric_name, count(*) AS n, min(v) AS min_value, median(v) AS median_value, max(v) AS max_value FROM (SELECT metric_name, try_cast(val AS DOUBLE) AS v FROM f) WHERE v IS NOT NULL GROUP BY metric_name")
def metric_spread(spark, sf_dir):
    return metrics.spread(metrics.flat(_records(spark, sf_dir)), "metric_name", "val")


@query("""WITH e AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders) SELECT least(9, floor((o_totalprice - lo) / ((hi - lo) / 10)))::INT AS bin, count(*) AS n, min(o_totalprice) AS least, max(o_totalprice) AS largest FROM orders, e GROUP BY 1""")
def value_histogram(spark, sf_dir):
    return metrics.histogram(table(spark, sf_dir, "orders"), "o_totalprice")


@query("SELECT event_type, count(*) AS n, (row_number() OVER (ORDER BY count(*) DESC, event_type))::INT AS place FROM events GROUP BY event_type")
def value_counts(spark, sf_dir):
    return metrics.numbered_categories(table(spark, sf_dir, "events"), "event_type")


@query("""SELECT event_id, CASE WHEN m % 5 = 0 THEN -v WHEN m % 5 = 4 THEN NULL ELSE v END AS amount FROM (SELECT event_id, event_id AS m, floor(abs(value) * 1000) / 100 AS v FROM events)""")
def money_parse(spark, sf_dir):
    e, m = table(spark, sf_dir, "events"), F.col("event_id")
    cents = F.format_number(F.floor(F.abs("value") * 1000) / 100, 2)
    shape = F.when(m % 5 == 0, F.concat(F.lit("("), cents, F.lit(")"))).when(m % 5 == 1, F.concat(F.lit("$"), cents)).when(m % 5 == 4, F.concat(cents, F.lit("/75"))).otherwise(cents)
    return e.select("event_id", T.money(shape).alias("amount"))


@query(r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents) SELECT doc_id, i::INT AS i, CASE WHEN contains(line, '$') THEN 'dollars' ELSE 'NOT FOUND' END AS unit FROM l""")
def unit_guess(spark, sf_dir):
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("i", "line"))
    return lines.select("doc_id", (F.col("i") + 1).alias("i"), T.guessed_unit(F.col("line")).alias("unit"))


UNIT_PHRASES = ["(in thousands)", "(dollars in  millions)", "in billions", "( $ in", "thousands of dollars", "USD millions", "billions", "amounts (in millions)", "in Thousands and $ in millions", "$ 5", "(in ", ""]


@query(rf"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
p AS (SELECT doc_id, i, lower(line || ' ' || ([{quoted(UNIT_PHRASES)}])[(doc_id + i) % {len(UNIT_PHRASES)} + 1] || CASE WHEN i % 5 = 0 THEN '  billions )' ELSE '' END) AS t FROM l),
m AS (SELECT *, contains(t, 'dollar') OR contains(t, '$') OR contains(t, 'usd') AS money FROM p)
SELECT doc_id, i::INT AS i, CASE WHEN contains(t, 'in thousands') OR regexp_matches(t, '[(]\s*([$]|dollars)?\s*in\s+thousands\s*[)]') THEN 'thousand' WHEN contains(t, 'in millions') OR regexp_matches(t, '[(]\s*([$]|dollars)?\s*in\s+millions\s*[)]') THEN 'million' WHEN contains(t, 'in billions') OR regexp_matches(t, '[(]\s*([$]|dollars)?\s*in\s+billions\s*[)]') THEN 'billion'
WHEN money AND regexp_matches(t, '\bthousands\b') THEN 'thousand' WHEN money AND regexp_matches(t, '\bmillions\b') THEN 'million' WHEN money AND regexp_matches(t, '\bbillions\b') THEN 'billion' WHEN contains(t, '$') THEN 'dollars' ELSE 'NOT FOUND' END AS unit FROM m""")
def unit_phrases(spark, sf_dir):
    """The documents' lines as table heads, with each kind of phrase."""
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("i", "line")).withColumn("i", F.col("i") + 1)
    phrase = F.element_at(F.array(*(F.lit(x) for x in UNIT_PHRASES)), ((F.col("doc_id") + F.col("i")) % len(UNIT_PHRASES) + 1).cast("int"))
    return lines.select("doc_id", "i", T.guessed_unit(F.concat("line", F.lit(" "), phrase, F.when(F.col("i") % 5 == 0, "  billions )").otherwise(""))).alias("unit"))


# contexts made of customers: the sentence patterns with numbers of the row
STATEMENTS = """WITH c AS (SELECT c_custkey AS k, c_custkey * 37 % 900000 + 100000 AS nii, c_custkey % 900 + 100 AS nim, c_custkey % 300 + 100 AS roa, c_custkey % 1500 + 100 AS roe FROM customer)"""


def _contexts(spark, sf_dir) -> DataFrame:
    k = F.col("c_custkey")
    dec = lambda x: F.format_string("%.2f", x / 100)
    text = F.concat(
        F.lit("[k=b|stem=AR_2024|chunk="), k.cast("string"), F.lit("]\n(rank=1 score=0.9)\nNet interest income (in thousands) was "), F.format_number(k * 37 % 900000 + 100000, 0),
        F.lit(" in the year.\n\n---\n\n[k=b|stem=AR_2024|chunk=7]\nThe net interest margin was "), dec(k % 900 + 100), F.lit("%.\n\n---\n\n[k=b|stem=AR_2024|chunk=8]\nReturn on average assets and equity were "), dec(k % 300 + 100), F.lit("% and "), dec(k % 1500 + 100), F.lit("%, respectively, for 2024."),
    )
    return table(spark, sf_dir, "customer").select(k.alias("k"), text.alias("context"))


@query(STATEMENTS + """ SELECT k, 'NII' AS metric_name, format('{:,}', nii) AS value, 'thousand' AS unit, k::VARCHAR AS source_chunk_id FROM c UNION ALL SELECT k, 'NIM', printf('%.2f', nim / 100.0), '%', '[k=b|stem=AR_2024|chunk=7]' FROM c
UNION ALL SELECT k, 'ROA', printf('%.2f', roa / 100.0), '%', '[k=b|stem=AR_2024|chunk=8]' FROM c UNION ALL SELECT k, 'ROE', printf('%.2f', roe / 100.0), '%', '[k=b|stem=AR_2024|chunk=8]' FROM c""")
def pattern_extraction(spark, sf_dir):
    return extraction.extracted(_contexts(spark, sf_dir), "k", 2024).drop("origin")


@query("""SELECT c_custkey AS k, m.metric_name, printf('%.2f', 100.0 * (c_custkey + 1000) / CASE m.metric_name WHEN 'ROA' THEN 5000000 + c_custkey ELSE 1000000 + c_custkey END) AS value FROM customer, (VALUES ('ROA'), ('ROE')) m(metric_name)""")
def computed_ratios(spark, sf_dir):
    k = F.col("c_custkey")
    text = F.concat(F.lit("[k=b|stem=s|chunk=1]\nSummary of Operations:\nInterest Income\nNet Income\n2024\n9\n"), F.format_number(k + 1000, 0), F.lit("\nAverage Balances:\nTotal Assets\nShareholders' Equity\n2024\n"), F.format_number(k + 5000000, 0), F.lit("\n"), F.format_number(k + 1000000, 0), F.lit("\nPer Share Data:\n"))
    rows = table(spark, sf_dir, "customer").select(k.alias("k"), text.alias("context"))
    return extraction.extracted(rows, "k", 2024).where("origin = 'computed'").select("k", "metric_name", "value")


@query("""WITH t AS (SELECT c.c_custkey AS bank, m.* FROM customer c, (VALUES (0,'ROA'),(1,'ROE'),(2,'NIM'),(3,'NII'),(4,'Provision for Credit Losses')) m(place, metric_name)),
f AS (SELECT o_custkey AS bank, (['ROA','ROE','NIM','NII','Provision for Credit Losses'])[o_orderkey % 5 + 1] AS metric_name, arg_min(o_orderkey, (o_orderkey % 3) * 1e12 + o_orderkey + 1e9)::VARCHAR AS value FROM orders GROUP BY 1, 2)
SELECT t.bank, t.metric_name, f.value FROM t LEFT JOIN f ON f.bank = t.bank AND f.metric_name = t.metric_name""")
def template_merge(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    name = F.element_at(F.array(*[F.lit(m) for m in V.METRICS]), (k % 5 + 1).cast("int"))
    origin = F.when(k % 3 == 0, "regex").when(k % 3 == 1, "model").otherwise("computed")
    # citations that sort as numbers do break ties between values of one origin
    first = o.groupBy(F.col("o_custkey").alias("bank"), name.alias("metric_name"), origin.alias("origin")).agg(F.min(k).cast("string").alias("value"))
    found = first.withColumn("unit", F.lit("")).withColumn("source_chunk_id", F.lit(""))
    return extraction.merged(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("bank")), found, "bank", 2024).select("bank", "metric_name", "value")


@query("SELECT doc_id, CASE n WHEN 0 THEN '0.0B' ELSE printf('%.1f', n / 1024.0 ** g) || (['B','KB','MB','GB'])[g + 1] END AS size FROM (SELECT doc_id, n_chars AS n, CASE WHEN n_chars < 1024 THEN 0 WHEN n_chars < 1048576 THEN 1 ELSE 2 END AS g FROM documents)")
def human_sizes(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.human_size(F.col("n_chars")).alias("size"))


@query("""SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def windowed_event_counts(spark, sf_dir):
    from .streaming.ingest import counts_by_window

    return counts_by_window(table(spark, sf_dir, "events"))


def _plan_chunks(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("source").alias("bank"), F.col("doc_id").cast("string").alias("stem"), "text")
    return chunks.chunked(docs, ["bank", "stem"]).select("bank", "stem", "chunk_id", "text").withColumn("embedding", vectors.hashed_embedding(F.col("text")))


@query(None)
def extraction_plan(spark, sf_dir):
    """The whole plan over the documents: chunks, stand-in embeddings, retrieval, patterns, template."""
    from .plans.extract import extract

    return extract(["src1", "src2", "nobody"], _plan_chunks(spark, sf_dir), 2024)[1]


@query(None)
def extraction_plan_all(spark, sf_dir):
    """extraction_plan for every source of the documents."""
    from .plans.extract import extract

    targets = table(spark, sf_dir, "documents").where("source IS NOT NULL").select(F.col("source").alias("target")).distinct()
    return extract(targets, _plan_chunks(spark, sf_dir), 2024)[1]


from . import queries_more  # noqa: E402, F401  registers its queries in QUERIES and SQL
