"""Whole jobs: documents with a configuration to nested results.

A document stays one row from its text to its result, so a job has no shuffle
of its own: pages, fragments, chunks, classes and extracted objects are array
columns of that row, and flat tables are unnested from it.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docspark.functions import json_schema as J
from docspark.functions import scalars as S
from docspark.operators import chunks as C
from docspark.operators import classify as K
from docspark.operators import extract as X
from docspark.operators import fragments as G
from docspark.operators import pages as P
from docspark.operators import tables as T
from docspark.operators import validate as V
from docspark.plans.config import Configuration, ExtractionOptions
from docspark.schemas import USAGE_COUNTERS

# ---- joins of the data model ---------------------------------------------


def apply_dataset(requests: DataFrame, datasets: DataFrame) -> DataFrame:
    """Requests with their dataset's configuration; values of the request win.

    No broadcast hint: Spark broadcasts the datasets when they are measured to
    be small; otherwise adaptive execution splits a dataset with very many requests.
    """
    shared = [c for c in ("page_range", "mime_type", "file_name", "labels") if c in datasets.columns]
    d = datasets.select("dataset_id", "configuration", *[F.col(c).alias(f"_d_{c}") for c in shared])
    joined = requests.join(d, "dataset_id", "left")
    for c in shared:
        joined = joined.withColumn(c, F.coalesce(F.col(c), F.col(f"_d_{c}"))).drop(f"_d_{c}")
    return joined


def attach_file(jobs: DataFrame, files: DataFrame) -> DataFrame:
    """Jobs with name, labels and type of their file."""
    f = files.select(
        "file_id", "file_name", F.col("labels").alias("file_labels"), "mime_type"
    )
    return jobs.join(f, "file_id", "left")


def route(docs: DataFrame, routes: DataFrame) -> DataFrame:
    """Dataset of each document by its type; an unmapped type has none."""
    return docs.join(routes.select("doc_type", "dataset_id"), "doc_type", "left")


# ---- steps over the nested document row ----------------------------------
#
# A step is a Column made from a configuration.  Several configurations in one
# table become one CASE over them, so a table is scanned once.

# A condition on the row, and the configuration that applies under it.
Cases = Sequence[tuple[Column, Configuration]]

FRAGMENTS = "array<array<struct<page_number:int,reading_order:int,fragment_type:string,level:int,text:string>>>"
# The same with places in the document, where citations are wanted.
PLACED_FRAGMENTS = FRAGMENTS.replace("text:string", "text:string,start:int,source:string")
CHUNKS = "array<struct<content:string,page_number:int>>"
BEST = "array<struct<page_class:string,score:double,reason:string>>"
CITATIONS = "array<struct<field:string,page_number:int,offset:int>>"
STRUCTURED = (
    "array<struct<data:string,page_numbers:array<int>,schema_name:string,missing:array<string>,"
    f"citations:{CITATIONS}>>"
)
MERGED = (
    "array<struct<merged_table_id:string,merged_table_html:string,start_page:int,end_page:int,pages_merged:int,"
    "summary:string,merge_actions:struct<pages:array<int>,target_columns:int>>>"
)


def _case(cases: Cases, make: Callable[[Configuration], Column | None], kind: str) -> Column:
    out = F.lit(None).cast(kind)
    for when, config in reversed(cases):
        made = make(config)
        if made is not None:
            out = F.when(when, made).otherwise(out)
    return out


def _cited(cases: Cases) -> bool:
    return any(o.provide_citations for _, c in cases for o in c.extraction)


def _typed_fragments(config: Configuration, offsets: bool) -> Column:
    """Fragments per page with the detections the configuration asks for."""
    if config.parsing.disable_layout_detection:
        return G.whole_pages("pages", offsets)
    return G.page_fragments(
        "pages",
        offsets,
        signatures=config.parsing.signature_detection,
        struck=config.parsing.remove_strikethrough_lines,
        key_values=config.enrichment.key_value_extraction,
    )


def without_struck(f: Column, offsets: bool) -> Column:
    """A fragment without its struck parts; its place is that of the text as it was."""
    left = f.withField("text", G.unstruck(f["text"]))
    return left.withField("source", F.coalesce(f["source"], f["text"])) if offsets else left


def _kept_fragments(config: Configuration, offsets: bool) -> Column:
    """Fragments per page after ignored types and strikethrough are taken out."""
    drop = set(config.parsing.ignore_sections)
    if config.parsing.remove_strikethrough_lines:
        drop.add("strikethrough")

    def kept(frags: Column) -> Column:
        frags = F.filter(frags, lambda f: ~f["fragment_type"].isin(*sorted(drop)))
        if config.parsing.remove_strikethrough_lines:
            frags = F.transform(frags, unstruck)
        return frags

    def unstruck(f: Column) -> Column:
        return without_struck(f, offsets)

    if not drop:
        return F.col("page_fragments")
    return F.transform("page_fragments", kept)


def _parse(docs: DataFrame, cases: Cases, text: str) -> DataFrame:
    offsets = _cited(cases)
    kind = PLACED_FRAGMENTS if offsets else FRAGMENTS
    typed = _case(cases, lambda c: _typed_fragments(c, offsets), kind)
    return parsed(docs, typed, _case(cases, lambda c: _kept_fragments(c, offsets), kind), offsets, text)


def parsed(docs: DataFrame, typed: Column, kept: Column, offsets: bool, text: str) -> DataFrame:
    """Pages, fragments per page, all fragments, and the metered usage.

    ``typed`` is made from ``pages`` and ``kept`` from ``page_fragments``.
    Usage counts what was detected, so it is taken before anything is removed.
    """
    kind = PLACED_FRAGMENTS if offsets else FRAGMENTS
    if "mime_type" in docs.columns:
        # A web page is one page; its text is what a reader sees.
        web = F.coalesce(F.col("mime_type") == "text/html", F.lit(False))
        out = docs.withColumn("page_text", F.when(web, G.html_visible(text)).otherwise(F.col(text)))
        one = F.array(F.struct(
            F.lit(1).alias("page_number"), F.lit(0).alias("start"), F.length("page_text").alias("end"),
            F.col("page_text").alias("text"),
        )).cast(P.PAGE_STRUCT)
        out = out.withColumn("pages", F.when(web, one).otherwise(P.page_array("page_text")))
        out = out.withColumn("total_pages", F.size("pages"))
        of_web = F.transform("pages", lambda p: G.html_fragments(text, offsets)).cast(kind)
        typed = F.when(web, of_web).otherwise(typed)
    else:
        out = P.with_pages(docs.withColumn("page_text", F.col(text)), text)
    if "page_range" in docs.columns:
        out = P.keep_pages(out, "page_range")
    out = with_usage(out.withColumn("page_fragments", typed))
    out = out.withColumn("page_fragments", kept)
    return out.withColumn("fragments", F.flatten("page_fragments"))


def parse(docs: DataFrame, config: Configuration, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pages and fragments, after page range and ignored types are applied."""
    return _parse(docs, [(F.lit(True), config)], text)


def with_usage(docs: DataFrame) -> DataFrame:
    """Add the nine usage counters; token counters are zero without a model."""

    def pages_with(kind: str) -> Column:
        hit = F.filter("page_fragments", lambda p: F.exists(p, lambda f: f["fragment_type"] == kind))
        return F.size(hit).cast("bigint")

    known = {
        "pages_parsed": F.size("pages").cast("bigint"),
        "signature_detected_pages": pages_with("signature"),
        "strikethrough_detected_pages": pages_with("strikethrough"),
    }
    fields = [known.get(c, F.lit(0).cast("bigint")).alias(c) for c in USAGE_COUNTERS]
    return docs.withColumn("usage", F.struct(*fields))


def _chunks(config: Configuration) -> Column:
    return chunks_of(C.slices("fragments", config.parsing.chunking_strategy or "none"))


def chunks_of(cut: Column) -> Column:
    """``[{content, page_number}]`` of slices."""
    return F.transform(
        cut,
        lambda s: F.struct(
            C.markdown(s["frags"]).alias("content"),
            F.coalesce(F.get(s["frags"], F.lit(0))["page_number"], F.lit(0)).alias("page_number"),
        ),
    )


def _best(config: Configuration) -> Column | None:
    """Best class of every page, aligned with ``pages``; NULL without a match."""
    if not config.page_classes:
        return None
    rows = [
        {"class_no": i, "page_class": c.name, "text": c.description or c.name}
        for i, c in enumerate(config.page_classes)
    ]
    raw = F.from_json(
        F.lit(json.dumps(rows, ensure_ascii=False)), "array<struct<class_no:int,page_class:string,text:string>>"
    )
    classes = F.transform(
        raw,
        lambda c: F.struct(
            c["class_no"].alias("class_no"), c["page_class"].alias("page_class"), K.terms(c["text"]).alias("terms")
        ),
    )
    return F.transform("pages", lambda p: S.let(K.terms(p["text"]), lambda t: K.best_class(t, classes)))


def with_page_classes(docs: DataFrame) -> DataFrame:
    """Add ``page_classes`` from ``page_best``: pages and reasons per class."""
    zipped = F.arrays_zip(F.col("pages").alias("p"), F.col("page_best").alias("b"))
    labels = F.transform(
        F.filter(zipped, lambda z: z["b"].isNotNull()),
        lambda z: F.struct(
            z["p"]["page_number"].alias("page_number"),
            z["b"]["page_class"].alias("page_class"),
            z["b"]["reason"].alias("reason"),
        ),
    )

    def of(rows: Column, name: Column) -> Column:
        mine = F.filter(rows, lambda x: x["page_class"] == name)
        return F.struct(
            name.alias("page_class"),
            F.transform(mine, lambda x: x["page_number"]).alias("page_numbers"),
            F.map_from_entries(F.transform(mine, lambda x: F.struct(x["page_number"], x["reason"]))).alias(
                "classification_reasons"
            ),
        )

    def grouped(rows: Column) -> Column:
        names = F.array_sort(F.array_distinct(F.transform(rows, lambda x: x["page_class"])))
        return F.transform(names, lambda n: of(rows, n))

    return docs.withColumn("page_classes", S.let(labels, grouped))


def _citations(part_text: Column, frags: Column, struct) -> Column:
    """Where the scalar fields of a partition stand in the document: page and offset.

    A value is looked up in the partition's own fragments, which carry their
    places, so all partitions together read the document once per field.
    """
    fields = [f.name for f in struct.fields if X.by_line(f.dataType)]
    if not fields:
        return F.lit(None).cast(CITATIONS)

    def source(f: Column) -> Column:
        return F.coalesce(f["source"], f["text"])

    def entry(name: str) -> Column:
        raw = S.blank_to_null(F.coalesce(X.field_text(part_text, name), F.get_json_object(part_text, f"$.{name}")))

        def cited(value: Column) -> Column:
            holding = F.filter(frags, lambda f: source(f).contains(value))

            def chosen(near: Column) -> Column:
                labelled = F.filter(near, lambda f: X.field_text(f["text"], name) == value)
                return F.coalesce(F.get(labelled, F.lit(0)), F.get(near, F.lit(0)))

            return S.let(S.let(holding, chosen), lambda f: F.struct(
                F.lit(name).alias("field"),
                f["page_number"].alias("page_number"),
                (f["start"] + X.value_at(source(f), name, value)).alias("offset"),
            ))

        return S.let(raw, cited)

    return F.filter(F.array(*[entry(n) for n in fields]), lambda e: e["offset"] >= 0).cast(CITATIONS)


def _objects(options: ExtractionOptions) -> Column:
    """Objects of one schema: ``[{data, page_numbers, schema_name, missing, citations}]``."""
    struct = J.json_schema_to_struct(options.json_schema)
    needed = J.required(options.json_schema)
    frags = F.col("fragments")
    if options.page_classes:
        zipped = F.arrays_zip(F.col("page_fragments").alias("f"), F.col("page_best").alias("b"))
        chosen = F.filter(zipped, lambda z: F.coalesce(z["b"]["page_class"].isin(*options.page_classes), F.lit(False)))
        frags = F.flatten(F.transform(chosen, lambda z: z["f"]))
    cut = S.let(
        frags,
        lambda f: C.slices(f, options.partition_strategy, options.start_pattern or None, options.end_pattern or None),
    )

    def one(s: Column) -> Column:
        part = F.array_join(F.transform(s["frags"], lambda f: f["text"]), "\n")
        cited = (
            S.let(part, lambda t: _citations(t, s["frags"], struct))
            if options.provide_citations else F.lit(None).cast(CITATIONS)
        )
        pages = F.array_sort(F.array_distinct(F.transform(s["frags"], lambda f: f["page_number"])))
        return S.let(
            X.extract_struct(part, struct),
            lambda d: F.struct(
                F.to_json(d).alias("data"),
                pages.alias("page_numbers"),
                F.lit(options.schema_name).alias("schema_name"),
                X.missing_required(d, needed).alias("missing"),
                cited.alias("citations"),
            ),
        )

    return F.transform(cut, one)


def _structured(config: Configuration) -> Column | None:
    """Objects of every schema, with missing required fields noted."""
    parts = [_objects(o) for o in config.extraction]
    if not parts:
        return None
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def _merged_tables(config: Configuration, key: str) -> Column | None:
    return merged_tables(key, F.lit(config.enrichment.table_summarization)) if config.parsing.merge_tables else None


def merged_tables(key: str, summaries: Column) -> Column:
    """Tables on consecutive pages with equal column counts, as one table each."""
    def of_page(z: Column) -> Column:
        lines = F.filter(z["f"], lambda f: f["fragment_type"] == "table")
        rows = F.flatten(F.transform(lines, lambda f: T.table_rows_of(f["text"])))
        return F.struct(z["p"]["page_number"].alias("page_number"), rows.alias("rows"))

    def shaped(x: Column) -> Column:
        widest = F.array_max(F.transform(x["rows"], lambda r: F.size(r)))
        return F.struct(x["page_number"].alias("page_number"), x["rows"].alias("rows"), widest.alias("n_cols"))

    def begins(tabs: Column, x: Column, i: Column) -> Column:
        before = F.get(tabs, i - 1)
        follows = (before["n_cols"] == x["n_cols"]) & (before["page_number"] == x["page_number"] - 1)
        return x["n_cols"].isNotNull() & ~F.coalesce((i > 0) & follows, F.lit(False))

    def merged(run: Column) -> Column:
        rows = F.flatten(F.transform(run, lambda x: x["rows"]))
        numbers = F.transform(run, lambda x: x["page_number"])
        first, columns = F.get(run, F.lit(0)), F.get(run, F.lit(0))["n_cols"]
        note = T.table_summary(F.get(rows, F.lit(0)), F.size(rows), columns)
        return F.struct(
            T.merged_id(key, first["page_number"]).alias("merged_table_id"),
            T.html_table(rows).alias("merged_table_html"),
            first["page_number"].alias("start_page"),
            F.element_at(numbers, -1).alias("end_page"),
            F.size(run).alias("pages_merged"),
            F.when(summaries, note).alias("summary"),
            F.struct(numbers.alias("pages"), columns.alias("target_columns")).alias("merge_actions"),
        )

    def runs(tabs: Column) -> Column:
        cut = C.cut_at(tabs, C.positions(tabs, lambda x, i: begins(tabs, x, i)), F.lit(0))
        # A run ends where the next starts; pages without tables in between are not part of it.
        pages = F.transform(cut, lambda s: F.filter(s["frags"], lambda x: x["n_cols"].isNotNull()))
        return F.transform(F.filter(pages, lambda r: F.size(r) > 1), merged)

    zipped = F.arrays_zip(F.col("pages").alias("p"), F.col("page_fragments").alias("f"))
    return S.let(F.transform(F.transform(zipped, of_page), shaped), runs)


def structured_rows(docs: DataFrame, key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Flat structured data and rejects of a nested ``structured`` column."""
    flat = S.unnest(docs, [key], "structured", "s")
    ok = flat.where(F.size("s.missing") == 0).select(key, "s.data", "s.page_numbers", "s.schema_name")
    bad = flat.where(F.size("s.missing") > 0).select(
        key,
        "s.schema_name",
        F.lit("INVALID_JSON_SCHEMA").alias("code"),
        F.concat(F.lit("missing required: "), F.array_join("s.missing", ", ")).alias("message"),
    )
    return ok, bad


# ---- jobs ----------------------------------------------------------------


def _run(docs: DataFrame, cases: Cases, text: str, key: str) -> DataFrame:
    """All steps over rows that have a ``job_type``; each row gets what its job
    type asks for: ``read`` chunks, ``extract`` structured data, ``classify``
    page classes, ``parse`` and ``dataset`` all of them as configured."""
    kind = F.col("job_type")
    everything = kind.isin("parse", "dataset")
    out = _parse(docs, cases, text)
    chunked = [((kind == "read") | everything) & when for when, _ in cases]
    out = out.withColumn("chunks", _case([(w, c) for w, (_, c) in zip(chunked, cases)], _chunks, CHUNKS))
    configs = [c for _, c in cases]
    if any(c.page_classes for c in configs):
        filtered = [any(o.page_classes for o in c.extraction) for c in configs]
        wanted = [
            (when & ((kind == "classify") | everything | ((kind == "extract") & F.lit(f))), c)
            for (when, c), f in zip(cases, filtered)
        ]
        out = out.withColumn("page_best", _case(wanted, _best, BEST))
        out = with_page_classes(out).withColumn(
            "page_classes", F.when((kind == "classify") | everything, F.col("page_classes"))
        )
    if any(c.extraction for c in configs):
        wanted = [(when & ((kind == "extract") | everything), c) for when, c in cases]
        out = out.withColumn("structured", _case(wanted, _structured, STRUCTURED))
    if any(c.parsing.merge_tables for c in configs):
        wanted = [(when & ((kind == "read") | everything), c) for when, c in cases]
        out = out.withColumn("merged_tables", _case(wanted, lambda c: _merged_tables(c, key), MERGED))
    output = F.struct(
        _case(cases, lambda c: F.lit(c.parsing.table_output_mode or "html"), "string").alias("tables"),
        _case(cases, lambda c: F.lit(c.enrichment.table_summarization), "boolean").alias("table_summaries"),
        _case(cases, lambda c: F.lit(c.enrichment.figure_summarization), "boolean").alias("figure_summaries"),
    )
    return out.withColumn("output", output)


def run_dataset(
    docs: DataFrame, config: Configuration, job_type: str = "parse", key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One configuration over a whole table of documents."""
    if job_type == "extract" and not config.extraction:
        raise ValueError("at least one structured_extraction_options must be provided")
    if job_type == "classify" and not config.page_classes:
        raise ValueError("at least one page_classifications must be provided")
    return _run(docs.withColumn("job_type", F.lit(job_type)), [(F.lit(True), config)], text, key)


def run_jobs(
    requests: DataFrame, configs: Mapping[str, Configuration], key: str = "parse_id", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Requests of several datasets and job types to a table of results and one of rejects.

    One scan: the configurations are the arms of one CASE per step.  A request
    is a reject if its dataset is unknown or not given, or if the dataset lacks
    what the job type needs; every request is in one of the two tables.
    """
    dataset, kind = F.col("dataset_id"), F.col("job_type")
    no_schema = [n for n, c in configs.items() if not c.extraction]
    no_classes = [n for n, c in configs.items() if not c.page_classes]
    known = F.coalesce(dataset.isin(*configs), F.lit(False))
    code = (
        F.when(~known, F.struct(F.lit("ENTITY_NOT_FOUND").alias("code"), F.lit("dataset not found").alias("message")))
        .when((kind == "extract") & dataset.isin(*no_schema), F.struct(
            F.lit("INVALID_CONFIGURATION").alias("code"), F.lit(V.NO_SCHEMA).alias("message")))
        .when((kind == "classify") & dataset.isin(*no_classes), F.struct(
            F.lit("INVALID_PAGE_CLASSIFICATION").alias("code"), F.lit(V.NO_CLASSES).alias("message")))
    )
    cases = [(dataset == name, config) for name, config in configs.items()]
    results = assemble(_run(requests.where(code.isNull()), cases, text, key), key)
    rejects = requests.where(code.isNotNull()).select(key, "dataset_id", "job_type", code["code"].alias("code"), code["message"].alias("message"))
    return results, rejects


def assemble(docs: DataFrame, key: str = "parse_id") -> DataFrame:
    """Nested result row.  Usage only for successful jobs, an error only for failed ones.

    A job has failed if a schema got no object with all its required fields
    from any partition.  The children already sit in the document's row, so
    nothing is joined.
    """
    have = set(docs.columns)
    status = F.col("status") if "status" in have else F.lit("successful")
    error = F.col("error") if "error" in have else F.lit("")
    if "structured" in have:
        # Bound once: few different schemas, compared with every object.
        whole = F.array_distinct(F.transform(F.filter("structured", lambda s: F.size(s["missing"]) == 0), lambda s: s["schema_name"]))
        lacking = S.let(whole, lambda names: F.array_distinct(F.flatten(F.transform(
            F.filter("structured", lambda s: ~F.array_contains(names, s["schema_name"])), lambda s: s["missing"]))))
        lacks = F.coalesce(F.size(lacking) > 0, F.lit(False)) & (status == "successful")
        error = F.when(lacks, F.concat(F.lit("missing required: "), F.array_join(lacking, ", "))).otherwise(error)
        status = F.when(lacks, "failure").otherwise(status)
    good = status == "successful"

    how = F.col("output")

    def content(f: Column) -> Column:
        kind, table = f["fragment_type"], f["fragment_type"] == "table"
        rows = F.when(table, T.table_rows_of(f["text"]))
        boxed = F.transform(
            F.flatten(rows), lambda c: F.struct(c.alias("text"), F.lit(None).cast("map<string,double>").alias("bounding_box"))
        )
        first = F.coalesce(F.get(rows, F.lit(0)), F.array().cast("array<string>"))
        summary = F.when(table & how["table_summaries"], T.table_summary(first, F.size(rows), F.size(first))).when(
            kind.isin("figure", "chart") & how["figure_summaries"], T.figure_summary(f["text"])
        )
        return G.content_struct(
            kind,
            f["text"],
            f["level"],
            summary,
            boxed,
            F.when(how["tables"] == "html", T.html_table(rows)),
            F.when(how["tables"] == "markdown", T.markdown_table(rows)),
        )

    def whole_tables(frags: Column) -> Column:
        """Lines of bars that follow each other are one table; a table of a web page has its lines already."""
        def bars(f: Column) -> Column:
            return (f["fragment_type"] == "table") & ~f["text"].contains("\n")

        begins = C.positions(frags, lambda f, i: (i == 0) | ~bars(f) | ~F.coalesce(bars(F.get(frags, i - 1)), F.lit(False)))
        return F.transform(C.cut_at(frags, begins, F.lit(0)), lambda s: F.get(s["frags"], F.lit(0)).withField(
            "text", F.array_join(F.transform(s["frags"], lambda f: f["text"]), "\n")))

    def frag(f: Column) -> Column:
        return F.struct(
            f["fragment_type"].alias("fragment_type"),
            content(f).alias("content"),
            f["reading_order"].cast("bigint").alias("reading_order"),
        )

    reasons = F.col("page_best")["reason"] if "page_best" in have else F.lit(None).cast("array<string>")
    reasons = F.coalesce(reasons, F.transform("pages", lambda p: F.lit(None).cast("string")))
    zipped = F.arrays_zip(F.col("pages").alias("p"), F.col("page_fragments").alias("f"), reasons.alias("r"))
    pages = F.transform(
        zipped,
        lambda z: F.struct(
            z["p"]["page_number"].alias("page_number"),
            F.transform(S.let(z["f"], whole_tables), frag).alias("page_fragments"),
            z["r"].alias("classification_reason"),
        ),
    )
    empty = {
        "chunks": CHUNKS,
        "merged_tables": MERGED,
        "page_classes": "array<struct<page_class:string,page_numbers:array<int>,classification_reasons:map<int,string>>>",
    }
    sd = f"array<struct<data:string,page_numbers:array<int>,schema_name:string,citations:{CITATIONS}>>"
    structured = (
        F.transform(
            F.filter("structured", lambda s: F.size(s["missing"]) == 0),
            lambda s: F.struct(s["data"], s["page_numbers"], s["schema_name"], s["citations"]),
        ).cast(sd)
        if "structured" in have else F.lit(None).cast(sd)
    )
    return docs.select(
        key,
        "job_type",
        *[F.col("dataset_id") if "dataset_id" in have else F.lit(None).cast("string").alias("dataset_id")],
        status.alias("status"),
        F.when(~good, error).alias("error"),
        F.size("pages").alias("parsed_pages_count"),
        F.col("total_pages"),
        pages.alias("pages"),
        *[(F.col(c).cast(t) if c in have else F.lit(None).cast(t)).alias(c) for c, t in empty.items()],
        structured.alias("structured_data"),
        F.when(good, F.col("usage")).alias("usage"),
    )


def document_tables(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of the text tables in ``fragments``: ``(key, page_number, row_no, cells)``."""
    frags = G.explode_fragments(docs, key).where(F.col("fragment_type") == "table")
    return frags.select(key, "page_number", F.col("reading_order").alias("row_no"), T.table_cells_of("text").alias("cells"))
