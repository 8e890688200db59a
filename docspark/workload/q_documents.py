"""The document core (DOC) and its windows over the driver tables."""

from pyspark.sql import functions as F

from docspark.operators import chunks, classify, extract, fragments, pages, tables
from docspark.workload import doc_sql as D
from docspark.workload import tables as t
from docspark.workload.registry import query


def nested(spark, sf_dir):
    """Documents as rows with ``pages`` and ``fragments``."""
    return fragments.with_fragments(pages.with_pages(t.load(spark, sf_dir, "documents")))


@query("flagship_chunk_stats", f"""WITH first AS (SELECT min(doc_id) AS doc_id FROM documents GROUP BY sha256(text)),
{D.MARKED},
ch AS (SELECT doc_id, lang, section_id, string_agg(md, chr(10) || chr(10) ORDER BY pos) AS content
       FROM md WHERE doc_id IN (SELECT doc_id FROM first) GROUP BY doc_id, lang, section_id)
SELECT lang, count(*) AS chunks, CAST(sum(length(content)) AS BIGINT) AS chars, max(length(content)) AS longest FROM ch GROUP BY lang""")
def flagship(spark, sf_dir):
    """Pages, fragments, section chunks, content hash, dedup, statistics per language.

    Each document is reduced to a few numbers in its own row first; copies are
    then dropped among those small rows.  No text is ever shuffled, and copies,
    however many, collapse before the shuffle by hash.
    """
    docs = t.load(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    n = fragments.with_fragments(pages.with_pages(docs))
    sizes = F.transform(chunks.section_slices("fragments"), lambda s: F.length(chunks.markdown(s["frags"])))
    rows = n.select("doc_id", "lang", F.sha2("text", 256).alias("sha"), sizes.alias("sizes")).select(
        "sha",
        "doc_id",
        F.struct(
            "lang",
            F.size("sizes").alias("chunks"),
            F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("chars"),
            F.array_max("sizes").cast("bigint").alias("longest"),
        ).alias("stats"),
    )
    unique = rows.groupBy("sha").agg(F.min_by("stats", "doc_id").alias("s")).select("s.*")
    return unique.groupBy("lang").agg(
        F.sum("chunks").alias("chunks"), F.sum("chars").alias("chars"), F.max("longest").alias("longest")
    )


@query("doc_1_split_pages", f"""WITH {D.PAGES}
SELECT doc_id, page_number, "start", "end", total_pages, text FROM pg""")
def split_pages(spark, sf_dir):
    return pages.split_pages(t.load(spark, sf_dir, "documents")).select(
        "doc_id", "page_number", "start", "end", "total_pages", "text"
    )


# Every line break becomes a form feed: the lines are the pages.
@query("doc_1_form_feed_pages", """WITH parts AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) AS n,
         len(string_split(text, chr(10))) AS total FROM documents),
ends AS (SELECT *, sum(length(text) + 1) OVER (PARTITION BY doc_id ORDER BY n) - 1 AS e FROM parts)
SELECT doc_id, CAST(n AS INTEGER) AS page_number, CAST(e - length(text) AS INTEGER) AS "start", CAST(e AS INTEGER) AS "end",
       CAST(total AS INTEGER) AS total_pages, text FROM ends
WHERE total > 1""")
def form_feed_pages(spark, sf_dir):
    docs = t.load(spark, sf_dir, "documents").where(F.col("text").contains("\n"))
    return pages.split_pages(docs.withColumn("text", F.translate("text", "\n", "\f"))).select(
        "doc_id", "page_number", "start", "end", "total_pages", "text"
    )


@query("doc_2_fragment_text", f"""WITH {D.CORE}
SELECT doc_id, page_number, reading_order, fragment_type, level, text FROM fr""")
def fragment_text(spark, sf_dir):
    return fragments.fragment_text(pages.split_pages(t.load(spark, sf_dir, "documents")))


# HTML in SQL: the same cleaning and cutting, with positions from unnest.
_TYPE = """CASE WHEN regexp_matches(s, '(?i)^<nav\\b') THEN 'page_header' WHEN regexp_matches(s, '(?i)^<footer\\b') THEN 'page_footer'
  WHEN regexp_matches(s, '(?i)^<table\\b') THEN 'table' WHEN regexp_matches(s, '(?i)^<(figure|img)\\b') THEN 'figure'
  WHEN regexp_matches(s, '(?i)^<h1\\b') THEN 'title' WHEN regexp_matches(s, '(?i)^<h[2-6]\\b') THEN 'section_header'
  WHEN regexp_matches(s, '(?i)^<li\\b') THEN 'list_item' WHEN regexp_matches(s, '(?i)^<(p|div)\\b') THEN 'text' END"""


def _entities(expr: str) -> str:
    for name, char in fragments.ENTITIES:
        char = char.replace("'", "''")
        expr = f"replace({expr}, '{name}', '{char}')"
    return expr


def _html_text(expr: str) -> str:
    stripped = f"regexp_replace({expr}, '<[^>]*>', ' ', 'g')"
    return f"trim(regexp_replace({_entities(stripped)}, '[ \\t\\r\\n]+', ' ', 'g'))"


HTML = f"""c AS (SELECT page_id, regexp_replace(html, '{fragments.HIDDEN}', '', 'g') AS h FROM pages),
parts AS (SELECT page_id, unnest(ps) AS part, unnest(range(len(ps))) AS i FROM (
  SELECT page_id, string_split(regexp_replace(h, '{fragments.CONTAINERS}', chr(2) || '\\1' || chr(2), 'g'), chr(2)) AS ps FROM c)),
segs AS (SELECT page_id, i, unnest(ss) AS s, unnest(range(len(ss))) AS j FROM (
  SELECT page_id, i, CASE WHEN regexp_matches(part, '{fragments.IS_CONTAINER}') THEN [part]
     ELSE string_split(regexp_replace(part, '{fragments.BLOCK_OPEN}', chr(1) || '\\1', 'g'), chr(1)) END AS ss FROM parts)),
typed AS (SELECT *, {_TYPE} AS fragment_type FROM segs),
texts AS (SELECT *, CASE WHEN regexp_matches(s, '{fragments.IS_CONTAINER}') THEN {_html_text("s")}
     ELSE {_html_text(f"regexp_replace(s, '{fragments.BLOCK_CLOSE}', '')")} END AS text FROM typed WHERE fragment_type IS NOT NULL),
hf AS (SELECT page_id, 1 AS page_number, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i, j) - 1 AS INTEGER) AS reading_order,
     fragment_type, CASE WHEN fragment_type = 'title' THEN 0 WHEN fragment_type = 'section_header'
       THEN CAST(regexp_extract(s, '(?i)^<h([2-6])', 1) AS INTEGER) - 1 END AS level, text FROM texts WHERE text <> '')"""


@query("doc_3_fragment_html", f"""WITH {HTML} SELECT * FROM hf""")
def fragment_html(spark, sf_dir):
    return fragments.fragment_html(t.load(spark, sf_dir, "pages"))


@query("doc_4_content_union", f"""WITH {D.CORE}
SELECT doc_id, page_number, reading_order, CASE WHEN fragment_type IN ('title', 'section_header') THEN 'header'
  WHEN fragment_type IN ('table', 'signature') THEN fragment_type ELSE 'text' END AS member, text AS content FROM fr""")
def content_union(spark, sf_dir):
    """Exactly one member of the union is set on every fragment."""
    frags = fragments.fragment_text(pages.split_pages(t.load(spark, sf_dir, "documents")))
    u = frags.withColumn("u", fragments.content_struct("fragment_type", "text", "level"))
    members = ("text", "header", "table", "figure", "signature")
    names = F.concat_ws("+", *[F.when(F.col(f"u.{m}").isNotNull(), F.lit(m)) for m in members])
    content = F.coalesce(*[F.col(f"u.{m}.content") for m in members])
    return u.select("doc_id", "page_number", "reading_order", names.alias("member"), content.alias("content"))


@query("doc_5_markdown", f"""WITH {D.MARKED}
SELECT d.doc_id, coalesce(m.markdown, '') AS markdown FROM documents d
LEFT JOIN (SELECT doc_id, string_agg(md, chr(10) || chr(10) ORDER BY pos) AS markdown FROM md GROUP BY doc_id) m USING (doc_id)""")
def to_markdown(spark, sf_dir):
    return chunks.to_markdown(nested(spark, sf_dir))


def _chunk_sql(key: str) -> str:
    return f"""WITH {D.MARKED}
SELECT doc_id, CAST({key} AS INTEGER) AS chunk_no, min(page_number) AS page_number,
       string_agg(md, chr(10) || chr(10) ORDER BY pos) AS content
FROM md GROUP BY doc_id, {key}"""


@query("doc_6_chunk_none", _chunk_sql("0 * section_id").replace("GROUP BY doc_id, 0 * section_id", "GROUP BY doc_id")
       .replace("CAST(0 * section_id AS INTEGER)", "0"))
def chunk_none(spark, sf_dir):
    return chunks.chunk(nested(spark, sf_dir), "none")


@query("doc_6_chunk_page", f"""WITH {D.MARKED}
SELECT doc_id, CAST(dense_rank() OVER (PARTITION BY doc_id ORDER BY page_number) - 1 AS INTEGER) AS chunk_no, page_number, content
FROM (SELECT doc_id, page_number, string_agg(md, chr(10) || chr(10) ORDER BY pos) AS content FROM md GROUP BY doc_id, page_number)""")
def chunk_page(spark, sf_dir):
    return chunks.chunk(nested(spark, sf_dir), "page")


@query("doc_6_chunk_section", _chunk_sql("section_id"))
def chunk_section(spark, sf_dir):
    return chunks.chunk(nested(spark, sf_dir), "section")


@query("doc_6_chunk_fragment", f"""WITH {D.MARKED}
SELECT doc_id, CAST(pos - 1 AS INTEGER) AS chunk_no, page_number, md AS content FROM md""")
def chunk_fragment(spark, sf_dir):
    return chunks.chunk(nested(spark, sf_dir), "fragment")


@query("doc_6_chunk_by_config", f"""WITH {D.MARKED},
k AS (SELECT *, CAST(CASE lang WHEN 'en' THEN section_id WHEN 'fr' THEN dense_rank() OVER (PARTITION BY doc_id ORDER BY page_number) - 1
              WHEN 'de' THEN pos - 1 ELSE 0 END AS INTEGER) AS chunk_no FROM md)
SELECT doc_id, chunk_no, min(page_number) AS page_number, string_agg(md, chr(10) || chr(10) ORDER BY pos) AS content
FROM k GROUP BY doc_id, chunk_no""")
def chunk_by_config(spark, sf_dir):
    d = nested(spark, sf_dir).withColumn(
        "strategy", t._case("lang", {"en": "section", "fr": "page", "de": "fragment"})
    )
    return chunks.chunk_by_column(d, "strategy")


@query("win_1_reading_order", f"""WITH {D.CORE}
SELECT doc_id, page_number, reading_order, row_number() OVER (PARTITION BY doc_id ORDER BY page_number, reading_order) AS position FROM fr""")
def reading_order(spark, sf_dir):
    d = nested(spark, sf_dir).select("doc_id", F.posexplode("fragments").alias("i", "f"))
    return d.select("doc_id", "f.page_number", "f.reading_order", (F.col("i") + 1).cast("bigint").alias("position"))


@query("win_2_section_id", f"""WITH {D.MARKED}
SELECT doc_id, page_number, reading_order, section_id FROM md""")
def section_id(spark, sf_dir):
    return chunks.section_id(nested(spark, sf_dir)).select("doc_id", "page_number", "reading_order", "section_id")


def _path_sql(partition: str) -> str:
    levels = range(chunks.MAX_LEVEL + 1)
    last = ",\n  ".join(
        f"max(CASE WHEN is_header AND level = {k} THEN lpad(CAST(pos AS VARCHAR), 12, '0') || text END) OVER w AS h{k}" for k in levels
    )
    parts = []
    for k in levels:
        above = " AND ".join(f"(h{j} IS NULL OR substr(h{j}, 1, 12) < substr(h{k}, 1, 12))" for j in range(k)) or "TRUE"
        parts.append(f"CASE WHEN h{k} IS NOT NULL AND {above} THEN substr(h{k}, 13) END")
    return f"""WITH {D.MARKED},
p AS (SELECT *, {last} FROM md WINDOW w AS (PARTITION BY {partition} ORDER BY pos ROWS UNBOUNDED PRECEDING))
SELECT doc_id, page_number, reading_order, concat_ws(' > ', {", ".join(parts)}) AS header_path FROM p"""


@query("win_3_header_path", _path_sql("doc_id"))
def header_path(spark, sf_dir):
    return chunks.header_path(nested(spark, sf_dir)).select("doc_id", "page_number", "reading_order", "header_path")


@query("doc_16_cross_page_headers_off", _path_sql("doc_id, page_number"))
def header_path_page(spark, sf_dir):
    return chunks.header_path(nested(spark, sf_dir), False).select("doc_id", "page_number", "reading_order", "header_path")


START, END = "^[A-E]", "[.!]$"


@query("doc_7_partition_patterns", f"""WITH {D.MARKED},
r AS (SELECT *, sum(CASE WHEN regexp_matches(text, '{START}') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) AS region,
             regexp_matches(text, '{END}') AS is_end FROM md),
e AS (SELECT *, coalesce(sum(CASE WHEN is_end THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, region ORDER BY pos
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ended FROM r WHERE region > 0)
SELECT doc_id, CAST(region AS INTEGER) AS partition_no, string_agg(DISTINCT CAST(page_number AS VARCHAR), ',' ORDER BY CAST(page_number AS VARCHAR)) AS page_numbers,
       string_agg(text, chr(10) ORDER BY pos) AS text
FROM e WHERE ended = 0 GROUP BY doc_id, region""")
def partition_patterns(spark, sf_dir):
    p = chunks.partition(nested(spark, sf_dir), "patterns", START, END)
    names = F.array_sort(F.col("page_numbers").cast("array<string>"))
    return p.select("doc_id", "partition_no", F.array_join(names, ",").alias("page_numbers"), "text")


@query("win_8_pattern_regions", f"""WITH {D.MARKED},
r AS (SELECT *, sum(CASE WHEN regexp_matches(text, '{START}') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) AS region FROM md)
SELECT doc_id, CAST(region AS INTEGER) AS partition_no, count(*) AS fragments FROM r WHERE region > 0 GROUP BY doc_id, region""")
def pattern_regions(spark, sf_dir):
    p = chunks.partition(nested(spark, sf_dir), "patterns", START)
    return p.select("doc_id", "partition_no", F.size("fragments").cast("bigint").alias("fragments"))


def _partition_sql(key: str) -> str:
    return f"""WITH {D.MARKED},
k AS (SELECT *, CAST({key} AS INTEGER) AS partition_no FROM md)
SELECT doc_id, partition_no, min(page_number) AS first_page, max(page_number) AS last_page, string_agg(text, chr(10) ORDER BY pos) AS text
FROM k GROUP BY doc_id, partition_no"""


def _partition(spark, sf_dir, strategy):
    return chunks.partition(nested(spark, sf_dir), strategy).select(
        "doc_id", "partition_no", F.array_min("page_numbers").alias("first_page"),
        F.array_max("page_numbers").alias("last_page"), "text",
    )


@query("doc_7_partition_none", _partition_sql("0"))
def partition_none(spark, sf_dir):
    return _partition(spark, sf_dir, "none")


@query("doc_7_partition_page", _partition_sql("dense_rank() OVER (PARTITION BY doc_id ORDER BY page_number) - 1"))
def partition_page(spark, sf_dir):
    return _partition(spark, sf_dir, "page")


@query("doc_7_partition_section", _partition_sql("section_id"))
def partition_section(spark, sf_dir):
    return _partition(spark, sf_dir, "section")


@query("doc_7_partition_fragment", _partition_sql("pos - 1"))
def partition_fragment(spark, sf_dir):
    return _partition(spark, sf_dir, "fragment")


# ---- classification ------------------------------------------------------

_TERMS = f"list_distinct(list_filter(regexp_split_to_array(lower(text), '{classify.TERM_BREAK}'), lambda w: w <> ''))"
CLASSIFY = f"""{D.PAGES},
cls AS (SELECT item_id AS class_no, 'item ' || item_id AS page_class, {_TERMS} AS terms FROM benchmark),
voc AS (SELECT class_no, len(terms) AS n, unnest(terms) AS term FROM cls),
pt AS (SELECT doc_id, page_number, unnest({_TERMS}) AS term FROM pg),
sc AS (SELECT doc_id, page_number, class_no, count(*) / max(n) AS score, string_agg(term, ', ' ORDER BY term) AS reason
       FROM pt JOIN voc USING (term) GROUP BY doc_id, page_number, class_no),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page_number ORDER BY score DESC, class_no) AS rn FROM sc),
lab AS (SELECT doc_id, page_number, 'item ' || class_no AS page_class, score, reason FROM best WHERE rn = 1 AND score >= 0.25)"""


def _classes(spark, sf_dir):
    return t.load(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("class_no"),
        F.concat(F.lit("item "), F.col("item_id").cast("string")).alias("name"),
        F.col("text").alias("description"),
    )


def _labels(spark, sf_dir, how=classify.classify_pages):
    return how(pages.split_pages(t.load(spark, sf_dir, "documents")), _classes(spark, sf_dir), 0.25)


_LABEL_SQL = f"WITH {CLASSIFY} SELECT doc_id, page_number, page_class, round(score, 9) AS score, reason FROM lab"


@query("doc_8_classify_pages", _LABEL_SQL)
def classify_pages(spark, sf_dir):
    return _labels(spark, sf_dir).withColumn("score", F.round("score", 9))


@query("doc_8_classify_pages_join", _LABEL_SQL)
def classify_join(spark, sf_dir):
    """The form that counts every match."""
    return _labels(spark, sf_dir, classify.classify_pages_join).withColumn("score", F.round("score", 9))


@query("doc_9_page_classes", f"""WITH {CLASSIFY}
SELECT doc_id, page_class, string_agg(CAST(page_number AS VARCHAR), ',' ORDER BY page_number) AS page_numbers,
       string_agg(page_number || '=' || reason, ';' ORDER BY page_number) AS reasons FROM lab GROUP BY doc_id, page_class""")
def page_classes(spark, sf_dir):
    entries = F.transform(
        F.array_sort(F.map_entries("classification_reasons")),
        lambda e: F.concat(e["key"].cast("string"), F.lit("="), e["value"]),
    )
    return classify.collect_page_classes(_labels(spark, sf_dir)).select(
        "doc_id", "page_class",
        F.array_join(F.col("page_numbers").cast("array<string>"), ",").alias("page_numbers"),
        F.array_join(entries, ";").alias("reasons"),
    )


@query("flt_9_pages_in_classes", f"""WITH {CLASSIFY}
SELECT doc_id, page_number, length(text) AS chars FROM pg
WHERE (doc_id, page_number) IN (SELECT doc_id, page_number FROM lab WHERE page_class IN ('item 1', 'item 3', 'item 7'))""")
def pages_in_classes(spark, sf_dir):
    p = pages.split_pages(t.load(spark, sf_dir, "documents"))
    return classify.pages_in_classes(p, _labels(spark, sf_dir), ["item 1", "item 3", "item 7"]).select(
        "doc_id", "page_number", F.length("text").cast("bigint").alias("chars")
    )


# ---- extraction ----------------------------------------------------------

ACCOUNT_SCHEMA = {
    "type": "object",
    "properties": {
        "account_number": {"type": "integer"},
        "client_name": {"type": "string"},
        "segment": {"type": "string"},
        "ending_balance": {"type": "number"},
        "address": {"type": "object", "properties": {"nation": {"type": "integer"}}},
    },
    "required": ["account_number", "segment"],
}
PLACE_SCHEMA = {"type": "object", "properties": {"address_nation": {"type": "integer"}, "client_name": {"type": "string"}}}


def account_text(spark, sf_dir):
    """Customers as statements: ``name: value`` lines, some without a segment."""
    c = t.spread(t.load(spark, sf_dir, "customer"))
    k = F.col("c_custkey")
    text = F.concat_ws(
        "\n",
        F.concat(F.lit("Account Number: "), F.when(k % 13 == 0, "unknown").otherwise(k.cast("string"))),
        F.concat(F.lit("client_name:  "), F.col("c_name")),
        F.when(k % 7 != 0, F.concat(F.lit("Segment: "), F.col("c_mktsegment"))),
        F.concat(F.lit("Ending balance: "), F.col("c_acctbal").cast("string")),
        F.concat(F.lit("address nation: "), F.col("c_nationkey").cast("string")),
        F.lit("no pair on this line"),
    )
    return c.select(k.alias("doc_id"), text.alias("text"), "c_acctbal")


@query("doc_10_extract", """
SELECT c_custkey AS doc_id, 'account' AS schema_name, '{"account_number":' || c_custkey || ',"client_name":"' || c_name || '","segment":"'
   || c_mktsegment || '","ending_balance":' || CAST(c_acctbal AS VARCHAR) || ',"address":{"nation":' || c_nationkey || '}}' AS data, '' AS code
FROM customer WHERE c_custkey % 13 <> 0 AND c_custkey % 7 <> 0
UNION ALL SELECT c_custkey, 'place', '{"address_nation":' || c_nationkey || ',"client_name":"' || c_name || '"}', '' FROM customer
UNION ALL SELECT c_custkey, 'account', concat_ws(', ', CASE WHEN c_custkey % 13 = 0 THEN 'account_number' END, CASE WHEN c_custkey % 7 = 0 THEN 'segment' END),
   'INVALID_JSON_SCHEMA' FROM customer WHERE c_custkey % 13 = 0 OR c_custkey % 7 = 0""")
def extract_fields(spark, sf_dir):
    parts = account_text(spark, sf_dir).select(
        "doc_id", "text", F.lit(0).alias("partition_no"), F.array(F.lit(1)).alias("page_numbers")
    )
    out, rejects = extract.extract_all(parts, {"account": ACCOUNT_SCHEMA, "place": PLACE_SCHEMA})
    return out.select("doc_id", "schema_name", "data", F.lit("").alias("code")).unionByName(
        rejects.select("doc_id", "schema_name", F.replace("message", F.lit("missing required: "), F.lit("")).alias("data"), "code")
    )


@query("doc_10_extract_json", """
SELECT event_id AS doc_id, '{"k":' || json_extract_string(props, '$.k') || '}' AS data FROM events""")
def extract_json(spark, sf_dir):
    parts = t.load(spark, sf_dir, "events").select(
        F.col("event_id").alias("doc_id"), F.col("props").alias("text"), F.lit(0).alias("partition_no"),
        F.array(F.lit(1)).alias("page_numbers"),
    )
    schema = {"type": "object", "properties": {"k": {"type": "integer"}}, "required": ["k"]}
    return extract.extract(parts, "props", schema)[0].select("doc_id", "data")


@query("doc_12_key_values", """
SELECT doc_id, CAST(i AS INTEGER) AS pair_no, key_name, value FROM (
 SELECT c_custkey AS doc_id, unnest(range(len(ks))) AS i, unnest(ks) AS key_name, unnest(vs) AS value FROM (
  SELECT c_custkey, list_filter(['Account Number', 'client_name', CASE WHEN c_custkey % 7 <> 0 THEN 'Segment' END, 'Ending balance', 'address nation'], lambda x: x IS NOT NULL) AS ks,
   list_filter([CASE WHEN c_custkey % 13 = 0 THEN 'unknown' ELSE CAST(c_custkey AS VARCHAR) END, c_name, CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END,
     CAST(c_acctbal AS VARCHAR), CAST(c_nationkey AS VARCHAR)], lambda x: x IS NOT NULL) AS vs FROM customer))""")
def key_values(spark, sf_dir):
    return extract.key_values(account_text(spark, sf_dir))


CITE_VALUES = """val AS (
  SELECT doc_id, field, value, CAST(instr(text, value) - 1 AS INTEGER) AS "offset" FROM (
    SELECT doc_id, text, unnest(['mid', 'last']) AS field,
           unnest([substr(text, length(text) // 2 + 1, 24), substr(text, greatest(length(text) - 11, 1), 12)]) AS value FROM documents)
  WHERE instr(text, value) > 0)"""


def _cited(spark, sf_dir):
    """A passage of the middle and of the end of each text, looked up again."""
    d = t.load(spark, sf_dir, "documents").select("doc_id", "text")
    n = F.length("text")
    mid = F.expr("substring(text, length(text) div 2 + 1, 24)")
    last = F.substring("text", F.greatest(n - 11, F.lit(1)), F.lit(12))
    return extract.value_offsets(d.withColumn("mid", mid).withColumn("last", last), ["mid", "last"])


@query("jon_7_cite_pages", f"""WITH {D.PAGES}, {CITE_VALUES}
SELECT v.doc_id, v.field, v."offset", p.page_number, v."offset" - p."start" AS page_offset
FROM val v JOIN pg p ON p.doc_id = v.doc_id AND p."start" <= v."offset" AND v."offset" < p."end" """)
def cite(spark, sf_dir):
    p = pages.split_pages(t.load(spark, sf_dir, "documents"))
    return extract.cite(_cited(spark, sf_dir), p).select("doc_id", "field", "offset", "page_number", "page_offset")


@query("doc_11_citations", f"""WITH {D.PAGES}, {CITE_VALUES}
SELECT v.doc_id, v.field, v.value, p.page_number
FROM val v JOIN pg p ON p.doc_id = v.doc_id AND p."start" <= v."offset" AND v."offset" < p."end" """)
def citations(spark, sf_dir):
    """Row-local: the document still has its pages, so nothing is joined."""
    d = pages.with_pages(t.load(spark, sf_dir, "documents").select("doc_id", "text"))
    mid = F.expr("substring(text, length(text) div 2 + 1, 24)")
    last = F.substring("text", F.greatest(F.length("text") - 11, F.lit(1)), F.lit(12))
    rows = d.withColumn("v", F.explode(F.array(
        F.struct(F.lit("mid").alias("field"), mid.alias("value")), F.struct(F.lit("last").alias("field"), last.alias("value"))
    )))
    at = F.expr("instr(text, v.value) - 1")
    return rows.where(at >= 0).select(
        "doc_id", "v.field", "v.value", extract.cite_in_row("pages", at).alias("page_number")
    )


# ---- tables --------------------------------------------------------------


def _cell_sql(expr: str) -> str:
    return f"replace(replace(replace({expr}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


_ROW = f"'<tr>' || array_to_string(list_transform(cells, lambda c: '<td>' || {_cell_sql('c')} || '</td>'), '') || '</tr>'"


@query("doc_13_tables_html", f"""WITH {t.TABLE_ROWS}
SELECT doc_id, page_number, count(*) AS n_rows, max(len(cells)) AS n_cols,
       '<table>' || string_agg({_ROW}, '' ORDER BY row_no) || '</table>' AS content
FROM table_rows GROUP BY doc_id, page_number""")
def tables_html(spark, sf_dir):
    return tables.render_tables(t.table_rows(spark, sf_dir))


@query("doc_13_tables_markdown", f"""WITH {t.TABLE_ROWS},
l AS (SELECT *, '| ' || array_to_string(cells, ' | ') || ' |' AS line, row_number() OVER (PARTITION BY doc_id, page_number ORDER BY row_no) AS i,
             max(len(cells)) OVER (PARTITION BY doc_id, page_number) AS nc FROM table_rows)
SELECT doc_id, page_number, count(*) AS n_rows, max(nc) AS n_cols,
  string_agg(CASE WHEN i = 1 THEN line || chr(10) || '|' || repeat(' --- |', nc) ELSE line END, chr(10) ORDER BY row_no) AS content
FROM l GROUP BY doc_id, page_number""")
def tables_markdown(spark, sf_dir):
    return tables.render_tables(t.table_rows(spark, sf_dir), "markdown")


@query("doc_13_table_cells", f"""WITH {t.TABLE_ROWS}
SELECT doc_id, page_number, row_no, CAST(unnest(range(len(cells))) AS INTEGER) AS col_no, unnest(cells) AS cell FROM table_rows""")
def table_cells(spark, sf_dir):
    return tables.table_cells(t.table_rows(spark, sf_dir))


@query("doc_13_text_tables", f"""WITH {D.CORE},
c AS (SELECT doc_id, page_number, reading_order AS row_no,
  list_transform(string_split(regexp_replace(text, '^\\||\\|$', '', 'g'), '|'), lambda x: trim(x, {D.BLANKS})) AS cells FROM fr WHERE fragment_type = 'table')
SELECT doc_id, page_number, count(*) AS n_rows, max(len(cells)) AS n_cols,
       '<table>' || string_agg({_ROW}, '' ORDER BY row_no) || '</table>' AS content FROM c GROUP BY doc_id, page_number""")
def text_tables(spark, sf_dir):
    """Lines with vertical bars in the documents, rendered."""
    from docspark.plans.jobs import document_tables

    return tables.render_tables(document_tables(nested(spark, sf_dir)))


MERGED = f"""{t.TABLE_ROWS},
tab AS (SELECT doc_id, page_number, count(*) AS n_rows, max(len(cells)) AS n_cols, string_agg({_ROW}, '' ORDER BY row_no) AS body
        FROM table_rows GROUP BY doc_id, page_number),
b AS (SELECT *, CASE WHEN lag(page_number) OVER w = page_number - 1 AND lag(n_cols) OVER w = n_cols THEN 0 ELSE 1 END AS brk
      FROM tab WINDOW w AS (PARTITION BY doc_id ORDER BY page_number)),
isl AS (SELECT *, sum(brk) OVER (PARTITION BY doc_id ORDER BY page_number) AS island FROM b),
mt AS (SELECT doc_id, island, min(page_number) AS start_page, max(page_number) AS end_page, count(*) AS pages_merged,
              CAST(sum(n_rows) AS BIGINT) AS n_rows, max(n_cols) AS target_columns, string_agg(body, '' ORDER BY page_number) AS body
       FROM isl GROUP BY doc_id, island HAVING count(*) > 1)"""


def _page_tables(spark, sf_dir):
    return tables.render_tables(t.table_rows(spark, sf_dir))


@query("doc_14_merge_tables", f"""WITH {MERGED}
SELECT doc_id, 'merged_' || doc_id || '_' || start_page AS merged_table_id, start_page, end_page, pages_merged, n_rows, target_columns FROM mt""")
def merge_tables(spark, sf_dir):
    return tables.merge_tables(_page_tables(spark, sf_dir).drop("content"))


@query("win_4_table_runs_html", f"""WITH {MERGED}
SELECT doc_id, 'merged_' || doc_id || '_' || start_page AS merged_table_id, CAST(0 AS BIGINT) AS part_no,
       '<table>' || body || '</table>' AS merged_table_html FROM mt""")
def merged_html(spark, sf_dir):
    return tables.merged_table_html(_page_tables(spark, sf_dir))


@query("doc_15_table_summaries", f"""WITH {t.TABLE_ROWS}
SELECT doc_id, page_number, count(*) || ' rows, ' || max(len(cells)) || ' columns; first row: ' || array_to_string(arg_min(cells, row_no), ', ') AS summary
FROM table_rows GROUP BY doc_id, page_number""")
def table_summaries(spark, sf_dir):
    return tables.summarize_tables(t.table_rows(spark, sf_dir), enabled=True)


@query("doc_15_figure_summaries", """
SELECT page_id, trim(regexp_extract(alt, '^([^.!?]*[.!?]?)', 1)) AS summary FROM (
  SELECT page_id, trim(regexp_replace(regexp_replace(substr(html, strpos(html, '<title>') + 7, strpos(html, '</title>') - strpos(html, '<title>') - 7), '&amp;', '&', 'g'), '[ \\t\\r\\n]+', ' ', 'g')) AS alt FROM pages)
WHERE alt <> ''""")
def figure_summaries(spark, sf_dir):
    """Each page's title as the caption of a figure."""
    web = t.load(spark, sf_dir, "pages")
    title = F.regexp_extract("html", r"(?is)<title>(.*?)</title>", 1)
    html = F.concat(F.lit("<figure><figcaption>"), title, F.lit("</figcaption></figure>"))
    frags = fragments.fragment_html(web.select("page_id", html.alias("html")))
    return tables.summarize_figures(frags, enabled=True).select("page_id", "summary")


@query("doc_18_signatures", f"""WITH signed AS (
  SELECT doc_id, lang, source, 1 AS page_number, CASE WHEN doc_id % 3 = 0 THEN 'Signed by: ' || source || chr(10) ELSE '' END || text
    || CASE WHEN doc_id % 4 = 0 THEN chr(10) || '____________' ELSE '' END AS text FROM documents),
{D.fragments("signed")}
SELECT doc_id, page_number, count(*) FILTER (WHERE fragment_type = 'signature') AS signatures,
       count(*) FILTER (WHERE fragment_type = 'signature') > 0 AS signed FROM fr GROUP BY doc_id, page_number""")
def signatures(spark, sf_dir):
    d = t.load(spark, sf_dir, "documents")
    k = F.col("doc_id")
    text = F.concat(
        F.when(k % 3 == 0, F.concat(F.lit("Signed by: "), "source", F.lit("\n"))).otherwise(""),
        "text",
        F.when(k % 4 == 0, "\n____________").otherwise(""),
    )
    p = d.select("doc_id", F.lit(1).alias("page_number"), text.alias("text"))
    return fragments.page_signatures(fragments.fragment_text(p))
