"""Whole jobs (DOC-17, DOC-19..21, STR-5) over the driver tables."""

import json

from pyspark.sql import functions as F

from docspark.functions import hooks
from docspark.functions import scalars as S
from docspark.operators import chunks as C
from docspark.operators import fragments as G
from docspark.operators import tables
from docspark.plans import jobs
from docspark.plans import requests as R
from docspark.plans.config import Configuration, EnrichmentOptions, ExtractionOptions, PageClass, ParsingOptions
from docspark.session import shared_dir
from docspark.streaming import feeds, ingest
from docspark.workload import doc_sql as D
from docspark.workload import tables as t
from docspark.workload.q_documents import ACCOUNT_SCHEMA, HTML, account_text
from docspark.workload.registry import query

PLAIN = Configuration(
    ParsingOptions(chunking_strategy="section", ignore_sections=("table",), signature_detection=True)
)
PAGED = Configuration(ParsingOptions(chunking_strategy="page"))

# The filtered fragments renumber nothing: ignoring comes before the chunks.
KEPT = f"""{D.PAGES},
sel AS (SELECT * FROM pg WHERE doc_id % 3 <> 0 OR page_number <= 2),
{D.fragments("sel", "all_fr")},
fr AS (SELECT * FROM all_fr WHERE fragment_type <> 'table'),
{D.marked()}"""


def ranged_docs(spark, sf_dir):
    d = t.load(spark, sf_dir, "documents").select("doc_id", "text")
    return d.withColumn("page_range", F.when(F.col("doc_id") % 3 == 0, "1-2"))


@query("doc_17_filters_before_work", f"""WITH {KEPT} SELECT doc_id, page_number, reading_order, fragment_type FROM fr""")
def filters_first(spark, sf_dir):
    """Page range and ignored types are applied before fragments are shaped."""
    out = G.explode_fragments(jobs.parse(ranged_docs(spark, sf_dir), PLAIN))
    return out.select("doc_id", "page_number", "reading_order", "fragment_type")


@query("doc_20_run_dataset", f"""WITH {KEPT}
SELECT doc_id, CAST(section_id AS INTEGER) AS chunk_no, min(page_number) AS page_number, string_agg(md, chr(10) || chr(10) ORDER BY pos) AS content
FROM md GROUP BY doc_id, section_id""")
def run_dataset(spark, sf_dir):
    out = jobs.run_dataset(ranged_docs(spark, sf_dir), PLAIN, "read")
    c = S.unnest(out.select("doc_id", "fragments", "chunks"), ["doc_id", "fragments"], F.arrays_zip(
        F.col("chunks").alias("c"), F.transform("chunks", lambda x, i: i).alias("i")
    ), "z").where(F.col("z.c.page_number") > 0)
    lead = F.when(C.is_header(F.get("fragments", F.lit(0))), 1).otherwise(0)
    return c.select("doc_id", (F.col("z.i") + lead).cast("int").alias("chunk_no"), "z.c.page_number", "z.c.content")


PRESETS = {
    "en": ("d0", PLAIN),
    "fr": ("d1", PAGED),
    "de": ("d2", Configuration(ParsingOptions(chunking_strategy="fragment"))),
    "es": ("d3", Configuration()),
}
_DATASET = " ".join(f"WHEN '{lang}' THEN '{name}'" for lang, (name, _) in PRESETS.items())


@query("doc_19_run_jobs", f"""WITH {D.PAGES}, {D.fragments("pg", "all_fr")},
fr AS (SELECT * FROM all_fr WHERE NOT (lang = 'en' AND fragment_type = 'table')), {D.marked()},
ch AS (SELECT DISTINCT doc_id, CASE lang WHEN 'en' THEN section_id WHEN 'fr' THEN page_number WHEN 'de' THEN pos ELSE 0 END AS k FROM md),
n AS (SELECT doc_id, count(*) AS chunks FROM ch GROUP BY doc_id),
m AS (SELECT doc_id, count(*) FILTER (WHERE NOT follows) AS fragments FROM (
   SELECT doc_id, fragment_type = 'table' AND coalesce(lag(fragment_type) OVER (PARTITION BY doc_id, page_number ORDER BY reading_order), '') = 'table' AS follows
   FROM fr) GROUP BY doc_id),
r AS (SELECT DISTINCT doc_id, CASE WHEN doc_id % 17 = 3 THEN NULL WHEN doc_id % 17 = 4 THEN 'gone' ELSE CASE lang {_DATASET} END END AS dataset_id, total_pages,
        CASE WHEN doc_id % 17 = 5 THEN 'extract' WHEN doc_id % 17 = 6 THEN 'classify'
             ELSE CASE doc_id % 3 WHEN 0 THEN 'read' WHEN 1 THEN 'parse' ELSE 'dataset' END END AS job_type FROM pg),
bad AS (SELECT doc_id, dataset_id, job_type, CASE WHEN doc_id % 17 IN (3, 4) THEN 'ENTITY_NOT_FOUND' WHEN doc_id % 17 = 5 THEN 'INVALID_CONFIGURATION'
          ELSE 'INVALID_PAGE_CLASSIFICATION' END AS status FROM r WHERE doc_id % 17 BETWEEN 3 AND 6)
SELECT doc_id AS parse_id, dataset_id, job_type, 'successful' AS status, total_pages, coalesce(chunks, 1) AS chunks, coalesce(fragments, 0) AS fragments,
       CAST(total_pages AS BIGINT) AS pages_parsed
FROM r LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id) WHERE doc_id NOT IN (SELECT doc_id FROM bad)
UNION ALL SELECT doc_id, dataset_id, job_type, status, NULL, NULL, NULL, NULL FROM bad""")
def run_jobs(spark, sf_dir):
    """Requests of four datasets and several job types, as nested results of one scan; bad requests are rejects."""
    d = t.load(spark, sf_dir, "documents")
    i, odd = F.col("doc_id"), F.col("doc_id") % 17
    kind = (
        F.when(odd == 5, "extract").when(odd == 6, "classify")
        .when(i % 3 == 0, "read").when(i % 3 == 1, "parse").otherwise("dataset")
    )
    dataset = F.when(odd == 4, "gone").when(odd != 3, t._case("lang", {lang: name for lang, (name, _) in PRESETS.items()}))
    requests = d.select(F.col("doc_id").alias("parse_id"), "text", dataset.alias("dataset_id"), kind.alias("job_type"))
    out, rejects = jobs.run_jobs(requests, dict(PRESETS.values()))
    frag_count = F.aggregate("pages", F.lit(0), lambda a, p: a + F.size(p["page_fragments"]))
    return out.select(
        "parse_id", "dataset_id", "job_type", "status", "total_pages",
        F.size("chunks").cast("bigint").alias("chunks"), frag_count.cast("bigint").alias("fragments"),
        F.col("usage.pages_parsed").alias("pages_parsed"),
    ).unionByName(rejects.select("parse_id", "dataset_id", "job_type", F.col("code").alias("status")), allowMissingColumns=True)


# A dataset's own schema, and what a third of the requests have without one of their own.
ACCOUNT_DATASETS = {
    "d0": Configuration(ParsingOptions(chunking_strategy="fragment"), extraction=(ExtractionOptions("account", json.dumps({
        "type": "object", "properties": {"account_number": {"type": "integer"}, "segment": {"type": "string"}},
        "required": ["account_number", "segment"]})),)),
    "d1": Configuration(),
}


@query("doc_19_request_configurations", """
WITH c AS (SELECT c_custkey AS k, c_name, c_mktsegment, c_custkey % 3 = 0 AS shared, c_custkey % 13 <> 0 AS numbered, c_custkey % 7 <> 0 AS segmented,
                  CASE WHEN c_custkey % 17 = 3 THEN 'ENTITY_NOT_FOUND' WHEN c_custkey % 17 = 4 THEN 'INVALID_CONFIGURATION' END AS bad FROM customer),
r AS (SELECT *, numbered AND (segmented OR NOT shared) AS good FROM c)
SELECT k AS parse_id, CASE WHEN k % 17 = 3 THEN 'gone' WHEN k % 3 < 2 THEN 'd' || k % 3 END AS dataset_id,
       coalesce(bad, CASE WHEN good THEN 'successful' ELSE 'failure' END) AS status,
       CASE WHEN bad IS NULL AND good THEN CASE WHEN shared THEN 'account' ELSE 's' || k % 1000 END END AS schema_name,
       CASE WHEN bad IS NULL AND good THEN '{"account_number":' || k || CASE WHEN NOT shared AND k % 2 = 0 THEN ',"client_name":"' || c_name || '"'
            WHEN segmented THEN ',"segment":"' || c_mktsegment || '"' ELSE '' END || '}' END AS data,
       CAST(CASE WHEN bad IS NULL THEN CASE WHEN k % 5 <> 0 AND NOT shared THEN 1 WHEN segmented THEN 6 ELSE 5 END END AS BIGINT) AS chunks
FROM r""")
def request_configurations(spark, sf_dir):
    """Requests with configurations of their own, over that of their dataset or without one: up to 1,000 different schemas in one plan."""
    k = F.col("doc_id")
    chunking = F.when(k % 17 == 4, '"odd"').when(k % 5 == 0, '"fragment"').otherwise("null")
    second = F.when(k % 2 == 0, "client_name").otherwise("segment")
    schema = F.concat(F.lit('{"type":"object","required":["account_number"],"properties":{"account_number":{"type":"integer"},"'),
                      second, F.lit('":{"type":"string"}}}'))
    extraction = F.to_json(F.struct(F.array(F.struct(
        F.concat(F.lit("s"), (k % 1000).cast("string")).alias("schema_name"), schema.alias("json_schema"))).alias("structured_extraction_options")))
    options = F.concat(F.lit('{"parsing_options":{"chunking_strategy":'), chunking, F.lit("}"))
    own = F.concat(options, F.when(k % 3 == 0, F.lit("}")).otherwise(F.concat(F.lit(","), F.substr(extraction, F.lit(2)))))
    dataset = F.when(k % 17 == 3, "gone").when(k % 3 < 2, F.concat(F.lit("d"), (k % 3).cast("string")))
    asked = account_text(spark, sf_dir).select(
        k.alias("parse_id"), "text", F.lit("parse").alias("job_type"), dataset.alias("dataset_id"), own.alias("configuration"))
    datasets = spark.createDataFrame([(n, c.to_json()) for n, c in ACCOUNT_DATASETS.items()], "dataset_id string, configuration string")
    out, rejects = R.run_requests(asked, datasets)
    first = F.get("structured_data", F.lit(0))
    return out.select(
        "parse_id", "dataset_id", "status", first["schema_name"].alias("schema_name"), first["data"].alias("data"),
        F.size("chunks").cast("bigint").alias("chunks"),
    ).unionByName(rejects.select("parse_id", "dataset_id", F.col("code").alias("status")), allowMissingColumns=True)


@query("doc_19_web_pages", f"""WITH {HTML},
h AS (SELECT page_id, count(*) AS fragments, count(*) FILTER (WHERE fragment_type IN ('title', 'section_header')) AS headers,
   max(CASE WHEN fragment_type = 'title' THEN text END) AS title, min(CASE WHEN fragment_type IN ('title', 'section_header') THEN reading_order END) AS first_header
 FROM hf WHERE fragment_type NOT IN ('page_header', 'page_footer') GROUP BY page_id)
SELECT page_id, fragments, headers + CASE WHEN first_header IS NULL OR first_header > 1 THEN 1 ELSE 0 END AS chunks, title FROM h""")
def web_pages(spark, sf_dir):
    """Fetched pages as a job: navigation and footers ignored, chunks by section."""
    config = Configuration(ParsingOptions(chunking_strategy="section", ignore_sections=("page_header", "page_footer")))
    web = t.load(spark, sf_dir, "pages").select("page_id", F.col("html").alias("text"), F.lit("text/html").alias("mime_type"))
    out = jobs.assemble(jobs.run_dataset(web, config, "read", "page_id"), "page_id")
    frags = F.get("pages", F.lit(0))["page_fragments"]
    title = F.get(F.filter(frags, lambda f: f["fragment_type"] == "title"), F.lit(0))["content"]["header"]["content"]
    return out.select(
        "page_id", F.size(frags).cast("bigint").alias("fragments"), F.size("chunks").cast("bigint").alias("chunks"),
        title.alias("title"),
    )


# A web page with a table at its end: header cells, an entity, a bar in a cell, unclosed rows and cells.
@query("doc_13_web_tables", """
SELECT page_id, '<table><tr><td>A &amp; B</td><td>é</td></tr><tr><td>' || page_id || '</td><td>1|2</td></tr></table>' AS html, 4 AS cells,
       '2 rows, 2 columns; first row: A & B, é' AS summary FROM pages""")
def web_tables(spark, sf_dir):
    page = F.col("page_id").cast("string")
    markup = F.concat(F.lit("<table class=x><tr><th>A &amp; B<th>é<tr><td>"), page, F.lit("</td><td>1|2</table>"))
    web = t.load(spark, sf_dir, "pages").select(
        "page_id", F.concat(F.coalesce("html", F.lit("")), markup).alias("text"), F.lit("text/html").alias("mime_type"))
    config = Configuration(ParsingOptions(), EnrichmentOptions(table_summarization=True))
    out = jobs.assemble(jobs.run_dataset(web, config, "parse", "page_id"), "page_id")
    frags = F.filter(F.get("pages", F.lit(0))["page_fragments"], lambda f: f["fragment_type"] == "table")
    last = F.element_at(frags, -1)["content"]["table"]
    return out.select("page_id", last["html"].alias("html"), F.size(last["cells"]).alias("cells"), last["summary"].alias("summary"))


@query("doc_13_bar_tables", """
SELECT doc_id, '| k | v |' || chr(10) || '| --- | --- |' || chr(10) || '| ' || doc_id || ' | x |' AS markdown, 1 AS tables
FROM documents WHERE NOT contains(text, '|') AND length(text) < 2500""")
def bar_tables(spark, sf_dir):
    """A table of three lines at the end of each short document is one fragment of the job's output."""
    docs = t.load(spark, sf_dir, "documents").where(~F.col("text").contains("|") & (F.length("text") < 2500))
    lines = F.concat(F.lit("\n\n| k | v |\n|---|:-:|\n| "), F.col("doc_id").cast("string"), F.lit(" | x |\n"))
    docs = docs.select("doc_id", F.concat("text", lines).alias("text"))
    config = Configuration(ParsingOptions(table_output_mode="markdown"))
    out = jobs.assemble(jobs.run_dataset(docs, config, "parse"), "doc_id")
    tables_ = F.filter(F.flatten(F.transform("pages", lambda p: p["page_fragments"])), lambda f: f["fragment_type"] == "table")
    return out.select("doc_id", F.get(tables_, F.lit(0))["content"]["table"]["markdown"].alias("markdown"), F.size(tables_).alias("tables"))


ACCOUNTS = Configuration(
    ParsingOptions(chunking_strategy="fragment"),
    extraction=(
        ExtractionOptions("account", json.dumps(ACCOUNT_SCHEMA), partition_strategy="page"),
    ),
    page_classes=(PageClass("balance", "account ending balance"), PageClass("letter", "dear sir regards")),
)


@query("doc_21_assemble", """
SELECT c_custkey AS doc_id, CASE WHEN c_custkey % 13 <> 0 AND c_custkey % 7 <> 0 THEN 'successful' ELSE 'failure' END AS status,
   CASE WHEN c_custkey % 13 = 0 OR c_custkey % 7 = 0 THEN 'missing required: ' || concat_ws(', ',
        CASE WHEN c_custkey % 13 = 0 THEN 'account_number' END, CASE WHEN c_custkey % 7 = 0 THEN 'segment' END) END AS error, 1 AS parsed_pages_count, CASE WHEN c_custkey % 7 = 0 THEN 5 ELSE 6 END AS fragments,
   'balance' AS page_class, 'account, balance, ending' AS reason,
   CASE WHEN c_custkey % 13 <> 0 AND c_custkey % 7 <> 0 THEN c_custkey END AS account_number,
   CASE WHEN c_custkey % 13 <> 0 AND c_custkey % 7 <> 0 THEN 1 END AS pages_parsed
FROM customer""")
def assemble(spark, sf_dir):
    """Statements through a full job: fragments, page classes and extracted data in one nested row."""
    out = jobs.assemble(jobs.run_dataset(account_text(spark, sf_dir), ACCOUNTS, "parse"), "doc_id")
    first = F.get("page_classes", F.lit(0))
    return out.select(
        "doc_id", "status", "error", "parsed_pages_count",
        F.size(F.get("pages", F.lit(0))["page_fragments"]).alias("fragments"),
        first["page_class"].alias("page_class"),
        F.try_element_at(first["classification_reasons"], F.lit(1)).alias("reason"),
        F.get_json_object(F.get("structured_data", F.lit(0))["data"], "$.account_number").cast("bigint").alias("account_number"),
        F.col("usage.pages_parsed").cast("int").alias("pages_parsed"),
    )


@query("str_5_stream_dataset", f"""WITH {D.MARKED}
SELECT doc_id, count(DISTINCT page_number) AS chunks FROM md GROUP BY doc_id""")
def stream_dataset(spark, sf_dir):
    """Documents arrive as files and flow through a dataset's configuration."""
    docs = t.load(spark, sf_dir, "documents").select("doc_id", "text")
    path = feeds.stage(docs, "documents")
    work = shared_dir(spark)
    feed = feeds.read_feed(spark, path, "doc_id BIGINT, text STRING")
    ingest.stream_dataset(feed, PAGED, f"{work}/out", f"{work}/checkpoint").awaitTermination()
    out = spark.read.parquet(f"{work}/out")
    return out.select("doc_id", F.size("chunks").cast("bigint").alias("chunks"))


@query("udf_2_custom_extractor", """
SELECT c_custkey AS doc_id, '{"account_number":' || c_custkey || ',"client_name":"' || upper(c_name) || '"}' AS data FROM customer""")
def custom_extractor(spark, sf_dir):
    """A user's extractor as an Arrow-batched pandas UDF under the same schema."""
    from docspark.functions import json_schema as J
    from docspark.operators import extract

    schema = {
        "type": "object",
        "properties": {"account_number": {"type": "integer"}, "client_name": {"type": "string"}},
        "required": ["account_number"],
    }

    def fn(texts, prompt):
        parts = texts.str.split("\t", expand=True)
        return parts.assign(account_number=parts[0].astype("int64"), client_name=parts[1].str.upper())[
            ["account_number", "client_name"]
        ]

    c = t.load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("doc_id"),
        F.concat_ws("\t", F.col("c_custkey").cast("string"), "c_name").alias("text"),
        F.lit(0).alias("partition_no"),
        F.array(F.lit(1)).alias("page_numbers"),
    )
    hook = hooks.extractor(fn, J.json_schema_to_struct(schema))
    return extract.extract(c, "account", schema, custom=hook)[0].select("doc_id", "data")


@query("udf_3_summary_hook", f"""WITH {t.TABLE_ROWS}
SELECT doc_id, page_number, 'rows: ' || count(*) AS summary FROM table_rows GROUP BY doc_id, page_number""")
def summary_hook(spark, sf_dir):
    """A prompted summary hook over rendered tables."""
    hook = hooks.text_hook(
        lambda texts, prompt: prompt + (texts.str.count("\n")).astype("string"), "rows: "
    )
    return tables.summarize_tables(t.table_rows(spark, sf_dir), enabled=True, hook=hook)


# Every line is followed by its length, so that equal values stand many times on every page.
@query("doc_11_job_citations", r"""
WITH src AS (SELECT doc_id, string_agg(line || chr(10) || 'length: ' || length(line), chr(10) ORDER BY pos) AS text
             FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents)
             GROUP BY doc_id),
pg AS (SELECT doc_id, i + 1 AS page_number, i * 3000 AS start, substr(text, i * 3000 + 1, 3000) AS page
       FROM (SELECT doc_id, text, unnest(range((length(text) + 2999) // 3000)) AS i FROM src)),
ln AS (SELECT doc_id, page_number, start, unnest(string_split(page, chr(10))) AS line, generate_subscripts(string_split(page, chr(10)), 1) AS pos FROM pg),
placed AS (SELECT *, start + sum(length(line) + 1) OVER (PARTITION BY doc_id, page_number ORDER BY pos) - length(line) - 1 AS line_at FROM ln)
SELECT doc_id, CAST(page_number AS INTEGER) AS page_number, CAST(line_at + 8 AS BIGINT) AS "offset", CAST(line[9:] AS BIGINT) AS length
FROM placed WHERE regexp_matches(line, '^length: [0-9]+$')""")
def job_citations(spark, sf_dir):
    """Citations of an extraction per fragment, from the places that fragments carry."""
    docs = t.load(spark, sf_dir, "documents").select("doc_id", F.array_join(F.transform(
        F.split("text", "\n"), lambda x: F.concat(x, F.lit("\nlength: "), F.length(x))), "\n").alias("text"))
    schema = {"type": "object", "properties": {"length": {"type": "integer"}}, "required": ["length"]}
    config = Configuration(extraction=(ExtractionOptions("lengths", json.dumps(schema), partition_strategy="fragment", provide_citations=True),))
    out = jobs.run_dataset(docs, config, "extract")
    hit = S.unnest(out, ["doc_id"], F.filter("structured", lambda s: F.size(s["citations"]) > 0), "s")
    cited = F.get("s.citations", F.lit(0))
    return hit.select(
        "doc_id", cited["page_number"].alias("page_number"), cited["offset"].cast("bigint").alias("offset"),
        F.get_json_object("s.data", "$.length").cast("bigint").alias("length"))
