"""Filters (FLT), joins (JON), paging (SRT) and listings over the driver tables."""

import base64

from pyspark.sql import functions as F

from docspark.functions import scalars as S
from docspark.operators import catalog, fragments, latency, pages, status
from docspark.operators import hotkeys
from docspark.plans import jobs as plans
from docspark.workload import doc_sql as D
from docspark.workload import tables as t
from docspark.workload.registry import query


@query("flt_1_source_provided", """
SELECT o_orderkey, (CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END) + (CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END)
       + (CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END) = 1 AS provided FROM orders""")
def source_provided(spark, sf_dir):
    k = F.col("o_orderkey")
    r = t.load(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(k % 2 == 0, "file_1").otherwise("").alias("file_id"),
        F.when(k % 3 == 0, "https://example.com").alias("file_url"),
        F.when(k % 5 == 0, "text").otherwise("").alias("raw_text"),
    )
    return r.select("o_orderkey", S.source_provided("file_id", "file_url", "raw_text").alias("provided"))


@query("flt_2_list_files", f"""WITH {t.FILES}
SELECT doc_id, file_name FROM files WHERE contains(file_name, '.HTML')
AND created_at > TIMESTAMP '2024-01-01 01:00:00' AND created_at < TIMESTAMP '2024-03-01 00:00:00'""")
def list_files(spark, sf_dir):
    f = t.files(spark, sf_dir)
    return catalog.list_files(f, ".HTML", "2024-01-01 01:00:00", "2024-03-01 00:00:00").select("doc_id", "file_name")


@query("flt_3_list_jobs", f"""WITH {t.JOBS}, {t.DATASETS}
SELECT parse_id, status FROM jobs WHERE status = 'successful' AND dataset_id IN (SELECT dataset_id FROM datasets WHERE name = 'NATION_7')
AND created_at > TIMESTAMP '1996-01-01' AND finished_at < TIMESTAMP '2001-01-01'""")
def list_jobs(spark, sf_dir):
    out = catalog.list_jobs(
        t.jobs(spark, sf_dir), t.datasets(spark, sf_dir), dataset_name="NATION_7", status="successful",
        created_after="1996-01-01", finished_before="2001-01-01",
    )
    return out.select("parse_id", "status")


@query("flt_4_list_dataset_data", f"""WITH {t.JOBS}
SELECT parse_id, status, file_name FROM jobs WHERE dataset_id = 3 AND status = 'failure'""")
def list_dataset_data(spark, sf_dir):
    return catalog.list_dataset_data(t.jobs(spark, sf_dir), 3, status="failure").select("parse_id", "status", "file_name")


@query("flt_5_list_datasets", f"""WITH {t.DATASETS}
SELECT dataset_id, name, status FROM datasets WHERE status = 'idle' AND contains(name, 'N_1')""")
def list_datasets(spark, sf_dir):
    return catalog.list_datasets(t.datasets(spark, sf_dir), "idle", "N_1").select("dataset_id", "name", "status")


@query("flt_6_label_filter", f"""WITH {t.FILES}
SELECT f.doc_id, f.file_name FROM files f JOIN labels l USING (doc_id) WHERE l.quality = 1""")
def label_filter(spark, sf_dir):
    labels = t.load(spark, sf_dir, "labels").select("doc_id", S.label_map(quality="quality", toxic="toxic").alias("labels"))
    f = t.files(spark, sf_dir).select("doc_id", "file_name").join(labels, "doc_id")
    return catalog.has_label(f, "quality", "1").select("doc_id", "file_name")


@query("flt_7_page_range", f"""WITH {D.PAGES}
SELECT doc_id, page_number, length(text) AS chars FROM pg WHERE page_number BETWEEN 1 AND 2 OR page_number = 5
UNION ALL SELECT -1 - doc_id, page_number, length(text) FROM pg
WHERE doc_id % 3 = 0 OR (doc_id % 3 = 1 AND page_number >= 2 AND page_number <= 4)""")
def page_range(spark, sf_dir):
    """A constant range, and a range per document (none keeps all, a bad one none)."""
    d = t.load(spark, sf_dir, "documents")
    flat = pages.split_pages(d)
    i = F.col("doc_id")
    own = F.when(i % 3 == 1, "2-4").when(i % 3 == 2, "x")
    const = pages.select_pages(flat, "1-2,5").select("doc_id", "page_number", F.length("text").cast("bigint").alias("chars"))
    per_doc = pages.select_pages(flat, own).select((-1 - i).alias("doc_id"), "page_number", F.length("text").cast("bigint").alias("chars"))
    return const.unionByName(per_doc)


@query("flt_8_ignore_sections", f"""WITH {D.CORE}
SELECT doc_id, page_number, reading_order, fragment_type FROM fr WHERE fragment_type NOT IN ('table', 'section_header')""")
def ignore_sections(spark, sf_dir):
    frags = fragments.fragment_text(pages.split_pages(t.load(spark, sf_dir, "documents")))
    return fragments.ignore_sections(frags, ["table", "section_header"]).select(
        "doc_id", "page_number", "reading_order", "fragment_type"
    )


@query("flt_10_optional_projection", f"""WITH {t.DATASETS}, {t.JOBS}
SELECT d.dataset_id, d.name, j.total_jobs FROM datasets d
LEFT JOIN (SELECT dataset_id, count(*) AS total_jobs FROM jobs GROUP BY dataset_id) j USING (dataset_id)""")
def optional_projection(spark, sf_dir):
    from docspark.operators.analytics import dataset_analytics

    stats = dataset_analytics(t.jobs(spark, sf_dir)).select("dataset_id", "total_jobs")
    return catalog.project_analytics(t.datasets(spark, sf_dir).select("dataset_id", "name"), stats)


@query("flt_11_file_name", """
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS file_name,
       CASE WHEN o_orderkey % 2 = 0 THEN 'file_' || o_orderkey END AS file_id FROM orders""")
def file_name(spark, sf_dir):
    k = F.col("o_orderkey")
    r = t.load(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_orderpriority").alias("file_name"),
        F.when(k % 2 == 0, F.concat(F.lit("file_"), k.cast("string"))).otherwise("").alias("file_id"),
        F.when(k % 2 == 1, "https://example.com").alias("file_url"),
        F.lit(None).cast("string").alias("raw_text"),
    )
    return catalog.normalize_requests(r).select("o_orderkey", "file_name", "file_id")


STRUCK = """struck AS (
  SELECT doc_id, lang, source, 1 AS page_number,
         CASE WHEN doc_id % 2 = 0 THEN 'keep ~~' || source || '~~ this <s>not</s> line with some more words in it' || chr(10) ELSE '' END
         || '~~' || lang || ' gone~~' || chr(10) || substr(text, 1) AS text
  FROM documents)"""


@query("flt_12_strikethrough", f"""WITH {STRUCK}, {D.fragments("struck")}
SELECT doc_id, reading_order, trim(regexp_replace(text, '{fragments.STRUCK_TEXT}', '', 'g')) AS text
FROM fr WHERE fragment_type <> 'strikethrough'""")
def strikethrough(spark, sf_dir):
    d = t.load(spark, sf_dir, "documents")
    head = F.when(
        F.col("doc_id") % 2 == 0,
        F.concat(F.lit("keep ~~"), "source", F.lit("~~ this <s>not</s> line with some more words in it\n")),
    ).otherwise("")
    text = F.concat(head, F.lit("~~"), "lang", F.lit(" gone~~\n"), "text")
    p = d.select("doc_id", F.lit(1).alias("page_number"), text.alias("text"))
    return fragments.remove_strikethrough(fragments.fragment_text(p)).select("doc_id", "reading_order", "text")


@query("flt_13_split_outcome", f"""WITH {t.LATENCY}
SELECT 'failed' AS outcome, level, count(*) AS n FROM runs WHERE error IS NOT NULL GROUP BY level
UNION ALL SELECT 'succeeded', level, count(*) FROM runs WHERE error IS NULL GROUP BY level""")
def split_outcome(spark, sf_dir):
    ok, bad = latency.split_outcome(t.latency_runs(spark, sf_dir))
    count = F.count(F.lit(1)).alias("n")
    return ok.groupBy("level").agg(count).withColumn("outcome", F.lit("succeeded")).unionByName(
        bad.groupBy("level").agg(count).withColumn("outcome", F.lit("failed"))
    )


@query("flt_14_list_entities", f"""WITH {t.STATUS_LOG}
SELECT entity_id, status, owner FROM (SELECT entity_id, owner, arg_max(status, ts_us) AS status FROM status_log GROUP BY entity_id, owner)
WHERE owner = 3 AND status IN ('running', 'pending', 'terminated')""")
def list_entities(spark, sf_dir):
    log = t.status_log(spark, sf_dir)
    out = status.list_entities(log, owner=3)
    return out.where(F.col("status").isin("running", "pending", "terminated")).select("entity_id", "status", "owner")


# ---- joins ---------------------------------------------------------------


@query("jon_1_apply_dataset", f"""WITH {t.JOBS}, {t.DATASETS}
SELECT j.parse_id, d.configuration, d.mime_type,
       CASE WHEN j.parse_id % 5 = 0 THEN '3' ELSE d.page_range END AS page_range
FROM jobs j LEFT JOIN datasets d USING (dataset_id)""")
def apply_dataset(spark, sf_dir):
    r = t.jobs(spark, sf_dir).select(
        "parse_id", "dataset_id", F.when(F.col("parse_id") % 5 == 0, "3").alias("page_range"),
        F.lit(None).cast("string").alias("mime_type"),
    )
    return plans.apply_dataset(r, t.datasets(spark, sf_dir)).select("parse_id", "configuration", "mime_type", "page_range")


@query("jon_2_attach_file", f"""WITH {t.FILES}
SELECT e.event_id, f.file_name, f.lang AS mime_type, l.quality
FROM events e LEFT JOIN files f ON f.doc_id = e.event_id % 1500 LEFT JOIN labels l ON l.doc_id = f.doc_id""")
def attach_file(spark, sf_dir):
    f = t.files(spark, sf_dir).select(F.col("doc_id").alias("file_id"), "file_name", F.col("lang").alias("mime_type"))
    lab = t.load(spark, sf_dir, "labels").select(F.col("doc_id").alias("file_id"), S.label_map(quality="quality").alias("labels"))
    jobs = t.load(spark, sf_dir, "events").select("event_id", (F.col("event_id") % 1500).alias("file_id"))
    return plans.attach_file(jobs, f.join(lab, "file_id", "left")).select(
        "event_id", "file_name", "mime_type",
        F.try_element_at("file_labels", F.lit("quality")).cast("int").alias("quality"),
    )


@query("jon_3_route", """
SELECT c.c_custkey, n.n_nationkey AS dataset_id FROM customer c
LEFT JOIN nation n ON c.c_mktsegment || '_' || c.c_nationkey = 'BUILDING_' || n.n_nationkey""")
def route(spark, sf_dir):
    docs = t.load(spark, sf_dir, "customer").select(
        "c_custkey", F.concat_ws("_", "c_mktsegment", F.col("c_nationkey").cast("string")).alias("doc_type")
    )
    routes = t.load(spark, sf_dir, "nation").select(
        F.concat(F.lit("BUILDING_"), F.col("n_nationkey").cast("string")).alias("doc_type"),
        F.col("n_nationkey").alias("dataset_id"),
    )
    return plans.route(docs, routes).select("c_custkey", "dataset_id")


@query("jon_4_jobs_by_dataset_name", f"""WITH {t.JOBS}, {t.DATASETS}
SELECT parse_id, dataset_id FROM jobs WHERE dataset_id IN (SELECT dataset_id FROM datasets WHERE name = 'NATION_11')""")
def jobs_by_name(spark, sf_dir):
    out = catalog.list_jobs(t.jobs(spark, sf_dir), t.datasets(spark, sf_dir), dataset_name="NATION_11")
    return out.select("parse_id", "dataset_id")


@query("jon_5_present", """
SELECT event_id FROM events WHERE event_id IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""")
def present(spark, sf_dir):
    ids = t.load(spark, sf_dir, "events").select("event_id")
    listed = t.load(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("event_id"))
    return catalog.present(ids, listed, "event_id")


@query("jon_6_absent", """
SELECT event_id FROM events WHERE event_id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""")
def absent(spark, sf_dir):
    ids = t.load(spark, sf_dir, "events").select("event_id")
    gone = t.load(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("event_id"))
    return catalog.apply_deletes(ids, gone, "event_id")


# ---- paging and order ----------------------------------------------------

CURSOR = base64.b64encode(b"1998-06-15T00:00:00.000000Z|7000").decode()
CUR = "to_base64(encode(strftime({ts}, '%Y-%m-%dT%H:%M:%S.%f') || 'Z|' || {id}))"


@query("srt_1_keyset_next", f"""WITH {t.JOBS},
w AS (SELECT * FROM jobs WHERE created_at < TIMESTAMP '1998-06-15' OR (created_at = TIMESTAMP '1998-06-15' AND parse_id < 7000)),
p AS (SELECT * FROM w ORDER BY created_at DESC, parse_id DESC LIMIT 50)
SELECT parse_id, epoch_us(created_at) AS created_us, (SELECT count(*) FROM w) > 50 AS has_more,
  (SELECT {CUR.format(ts="created_at", id="parse_id")} FROM p ORDER BY created_at, parse_id LIMIT 1) AS next_cursor,
  (SELECT {CUR.format(ts="created_at", id="parse_id")} FROM p ORDER BY created_at DESC, parse_id DESC LIMIT 1) AS prev_cursor
FROM p""")
def keyset_next(spark, sf_dir):
    p = catalog.keyset_page(t.jobs(spark, sf_dir), CURSOR, "next", 50, key="parse_id")
    return p.select("parse_id", t.micros("created_at").alias("created_us"), "has_more", "next_cursor", "prev_cursor")


@query("srt_1_keyset_prev", f"""WITH {t.JOBS},
w AS (SELECT * FROM jobs WHERE created_at > TIMESTAMP '1998-06-15' OR (created_at = TIMESTAMP '1998-06-15' AND parse_id > 7000)),
p AS (SELECT * FROM w ORDER BY created_at, parse_id LIMIT 50)
SELECT parse_id, epoch_us(created_at) AS created_us, (SELECT count(*) FROM w) > 50 AS has_more FROM p""")
def keyset_prev(spark, sf_dir):
    p = catalog.keyset_page(t.jobs(spark, sf_dir), CURSOR, "prev", 50, key="parse_id")
    return p.select("parse_id", t.micros("created_at").alias("created_us"), "has_more")


@query("srt_2_iterate_all", f"""WITH {t.JOBS},
n AS (SELECT *, row_number() OVER (ORDER BY created_at DESC, parse_id DESC) AS r, count(*) OVER () AS total FROM jobs),
p AS (SELECT *, CAST(ceil(r / 100.0) AS BIGINT) AS page_no FROM n),
e AS (SELECT page_no, {CUR.format(ts="created_at", id="parse_id")} AS next_cursor FROM p WHERE r % 100 = 0 AND r < total)
SELECT parse_id, status, p.page_no, next_cursor FROM p LEFT JOIN e ON e.page_no = p.page_no""")
def iterate_all(spark, sf_dir):
    """All pages of the listing, as a consumer that follows the cursors would get them."""
    jobs = t.jobs(spark, sf_dir).select("parse_id", "status", "created_at")
    return catalog.all_pages(jobs, 100, key="parse_id").select("parse_id", "status", "page_no", "next_cursor")


@query("srt_3_directory_listing", """
SELECT directory, name, is_dir, size, CAST(row_number() OVER (PARTITION BY directory ORDER BY is_dir DESC, name) AS INTEGER) AS position FROM (
  SELECT p_brand AS directory, p_name || ' ' || p_partkey AS name, p_size % 5 = 0 AS is_dir,
         CASE WHEN p_size % 5 <> 0 THEN CAST(p_size AS BIGINT) END AS size FROM part)""")
def directory_listing(spark, sf_dir):
    p = t.load(spark, sf_dir, "part")
    is_dir = F.col("p_size") % 5 == 0
    entries = p.select(
        F.col("p_brand").alias("directory"),
        F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("name"),
        is_dir.alias("is_dir"),
        F.when(~is_dir, F.col("p_size").cast("bigint")).alias("size"),
    )
    return catalog.directory_listing(catalog.listing_positions(entries, "directory"), "directory")


@query("win_9_page_index", f"""WITH {t.JOBS}
SELECT parse_id, row_no, CAST(ceil(row_no / 100.0) AS BIGINT) AS page_no
FROM (SELECT parse_id, row_number() OVER (ORDER BY created_at DESC, parse_id DESC) AS row_no FROM jobs)""")
def page_index(spark, sf_dir):
    j = t.jobs(spark, sf_dir).select("parse_id", "created_at")
    day = F.unix_date(F.col("created_at").cast("date"))
    ordered = hotkeys.paired_order(j, day, F.col("parse_id"), "listing_order")
    return catalog.page_index(ordered, 100, "listing_order", [F.col("parse_id").desc()]).select("parse_id", "row_no", "page_no")
