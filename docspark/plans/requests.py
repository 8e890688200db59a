"""Jobs whose configuration is data: a value of each request, over that of its dataset.

A request names a dataset, brings a configuration of its own (in the stored
form, ``Configuration.to_json``), or both; its own options win one by one, its
own lists of schemas and classes win whole.  Configurations are checked and laid
out as one struct per row (``CONFIG``), and every step reads that struct.  So the
plan is the same for one configuration and for a million, there is one scan, and
the only shuffle is the join with the datasets, if Spark does not broadcast them.

Python sees the two configuration texts of a row, never its document, and
works once per different pair.  A JSON schema becomes a list of parts in the
order of its properties: an object opens, its fields follow, it closes.  The
values are found and typed by built-in functions.
"""

from __future__ import annotations

import json
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docspark.functions import json_schema as J
from docspark.functions import scalars as S
from docspark.operators import chunks as C
from docspark.operators import classify as K
from docspark.operators import extract as X
from docspark.operators import fragments as G
from docspark.operators import validate as V
from docspark.plans import jobs
from docspark.plans.config import Configuration

# ``op`` is open, field or close.  ``kind`` of a field: string, integer, number, boolean, or raw for what only JSON text can hold.
PART = ("struct<op:string,path:string,parent:string,name:string,text:string,label:string,kind:string,many:boolean,"
        "depth:int,need:int>")
SCHEMA = (f"struct<schema_name:string,strategy:string,start:string,end:string,page_classes:array<string>,citations:boolean,"
          f"parts:array<{PART}>>")
CONFIG = (
    "struct<code:string,message:string,plain:boolean,signatures:boolean,struck:boolean,key_values:boolean,drop:array<string>,"
    "strategy:string,merge_tables:boolean,tables:string,table_summaries:boolean,figure_summaries:boolean,"
    f"classes:array<struct<class_no:int,page_class:string,text:string>>,schemas:array<{SCHEMA}>>"
)
# Stands between the members of an object until it is closed; JSON texts hold no such character unescaped.
BREAK = "\u0001"


# ---- configurations to structs -------------------------------------------


def merged(dataset: dict, own: dict) -> dict:
    """Configuration of a request: its own options over those of its dataset."""
    out = dict(dataset)
    for section, value in own.items():
        if isinstance(value, dict):
            given = {k: v for k, v in value.items() if v is not None}
            out[section] = {**(out.get(section) or {}), **given}
        elif value is not None:
            out[section] = value
    return out


def _parts(struct: T.StructType, needs: dict[tuple, int], above: tuple[str, ...] = ()) -> list[dict]:
    def path(names: tuple[str, ...]) -> str:
        return "$" + "".join(f"['{n}']" for n in names)

    out = []
    for f in struct.fields:
        names, kind = (*above, f.name), f.dataType
        part = {
            "path": path(names), "parent": path(above), "name": ".".join(names), "depth": len(above), "need": needs.get(names),
            "text": json.dumps(f.name, ensure_ascii=False) + ":",
        }
        if isinstance(kind, T.StructType):
            out.append({**part, "op": "open", "text": part["text"] + "{"})
            out += _parts(kind, needs, names)
            out.append({**part, "op": "close", "text": "}" + BREAK, "need": None})
            continue
        many = isinstance(kind, T.ArrayType)
        item = kind.elementType if many else kind
        name = next((n for n, k in J.SCALARS.items() if k == item), "raw")
        out.append({**part, "op": "field", "kind": name, "many": many and name != "raw", "label": X.label_pattern("_".join(names))})
    return out


def laid_out(config: Configuration) -> dict:
    """The values of ``CONFIG`` for one configuration."""
    parsing, enrichment = config.parsing, config.enrichment
    struck = ["strikethrough"] if parsing.remove_strikethrough_lines else []
    schemas = []
    for o in config.extraction:
        needs = {p: i for i, p in enumerate(J.required(o.json_schema))}
        schemas.append({
            "schema_name": o.schema_name, "strategy": o.partition_strategy, "start": o.start_pattern or None, "end": o.end_pattern or None,
            "page_classes": list(o.page_classes), "citations": o.provide_citations,
            "parts": _parts(J.json_schema_to_struct(o.json_schema), needs),
        })
    return {
        "plain": parsing.disable_layout_detection, "signatures": parsing.signature_detection,
        "struck": parsing.remove_strikethrough_lines, "key_values": enrichment.key_value_extraction,
        "drop": sorted({*parsing.ignore_sections, *struck}), "strategy": parsing.chunking_strategy or "none",
        "merge_tables": parsing.merge_tables, "tables": parsing.table_output_mode or "html",
        "table_summaries": enrichment.table_summarization, "figure_summaries": enrichment.figure_summarization,
        "classes": [{"class_no": i, "page_class": c.name, "text": c.description or c.name} for i, c in enumerate(config.page_classes)],
        "schemas": schemas,
    }


@lru_cache(4096)
def compiled(dataset: str | None, own: str | None) -> str:
    """``CONFIG`` of a request as JSON; a configuration that cannot run has a code and a message."""
    try:
        both = [json.loads(x) if x else {} for x in (dataset, own)]
        if not all(isinstance(x, dict) for x in both):
            raise ValueError("a configuration is a JSON object")
        return json.dumps(laid_out(Configuration.from_json(json.dumps(merged(*both)))), ensure_ascii=False)
    except J.InvalidJsonSchema as e:
        return json.dumps({"code": "INVALID_JSON_SCHEMA", "message": str(e)})
    except (AttributeError, KeyError, TypeError, ValueError) as e:
        return json.dumps({"code": "INVALID_CONFIGURATION", "message": str(e)})


@F.pandas_udf(T.StringType())
def _compiled(dataset: pd.Series, own: pd.Series) -> pd.Series:
    return pd.Series([compiled(d or None, o or None) for d, o in zip(dataset, own)], dtype="object")


# ---- steps that read the struct ------------------------------------------


def _typed(raw: Column, kind: Column, make) -> Column:
    """JSON text of values; ``make`` applies a cast (or none) and gives an array."""
    def as_(name: str | None) -> Column:
        return F.to_json(make(raw, name))

    return F.when(kind == "integer", as_("bigint")).when(kind == "number", as_("double")).when(kind == "boolean", as_("boolean")).otherwise(as_(None))


def _json_at(text: Column, path: Column) -> Column:
    return F.call_function("get_json_object", text, path)


def _cast(x: Column, name: str | None) -> Column:
    return x.try_cast(name) if name else x


def _value(text: Column, is_json: Column, p: Column) -> Column:
    """JSON text of one field's value in a text, NULL without one of its kind.

    A scalar of JSON text counts if it reads as the kind, quoted or not.
    """
    def scalar(raw: Column) -> Column:
        json_of = _typed(raw, p["kind"], lambda x, name: F.array(_cast(x, name)))
        return F.nullif(F.substring(json_of, F.lit(2), F.length(json_of) - 2), F.lit("null"))

    def listed(raw: Column) -> Column:
        items = F.when(is_json, F.from_json(raw, "array<string>")).otherwise(F.transform(F.split(raw, ","), S.trimmed))
        return F.when(items.isNotNull(), _typed(items, p["kind"], lambda xs, name: F.transform(xs, lambda x: _cast(x, name))))

    # A string "null" is quoted, so that only what has no value is NULL.
    raw = F.when(is_json, _json_at(text, p["path"])).when(p["kind"] != "raw", X.labelled_text(text, p["label"]))
    return S.let(raw, lambda r: F.when(r.isNull(), F.lit(None).cast("string")).when(p["kind"] == "raw", r).when(p["many"], listed(r)).otherwise(scalar(r)))


def _filled(text: Column, parts: Column) -> Column:
    """The parts with their value in a text; in prose every object is there."""
    def fill(t: Column) -> Column:
        is_json = t.startswith("{")

        def there(path: Column) -> Column:
            return ~is_json | _json_at(t, path).isNotNull()

        return F.transform(parts, lambda p: F.struct(
            p["op"].alias("op"), p["text"].alias("text"), p["name"].alias("name"), p["need"].alias("need"),
            ((p["depth"] == 0) | there(p["parent"])).alias("inside"),
            F.when(p["op"] == "field", _value(t, is_json, p)).otherwise(F.when(there(p["path"]), F.lit(""))).alias("value")))

    return S.let(S.trimmed(text), fill)


def _data(filled: Column) -> Column:
    members = F.filter(filled, lambda x: x["value"].isNotNull())
    joined = F.array_join(F.transform(members, lambda x: F.concat(
        x["text"], x["value"], F.when(x["op"] == "field", F.lit(BREAK)).otherwise(F.lit("")))), "")
    closed = F.replace(F.concat(F.lit("{"), joined, F.lit("}")), F.lit(BREAK + "}"), F.lit("}"))
    return F.replace(closed, F.lit(BREAK), F.lit(","))


def _missing(filled: Column) -> Column:
    absent = F.filter(filled, lambda x: x["need"].isNotNull() & x["inside"] & x["value"].isNull())
    ordered = F.array_sort(F.transform(absent, lambda x: F.struct(x["need"].alias("need"), x["name"].alias("name"))))
    return F.transform(ordered, lambda x: x["name"])


def _citations(text: Column, frags: Column, parts: Column) -> Column:
    """Page and offset of the fields on the top level, looked up in the partition's own fragments."""
    def source(f: Column) -> Column:
        return F.coalesce(f["source"], f["text"])

    def entry(p: Column) -> Column:
        raw = S.blank_to_null(F.coalesce(X.labelled_text(text, p["label"]), _json_at(text, p["path"])))

        def cited(value: Column) -> Column:
            def chosen(near: Column) -> Column:
                labelled = F.filter(near, lambda f: X.labelled_text(f["text"], p["label"]) == value)
                return F.coalesce(F.get(labelled, F.lit(0)), F.get(near, F.lit(0)))

            holding = F.filter(frags, lambda f: source(f).contains(value))
            return S.let(S.let(holding, chosen), lambda f: F.struct(
                p["name"].alias("field"), f["page_number"].alias("page_number"),
                (f["start"] + X.labelled_at(source(f), p["label"], value)).alias("offset")))

        return S.let(raw, cited)

    fields = F.filter(parts, lambda p: (p["op"] == "field") & (p["depth"] == 0) & (p["kind"] != "raw"))
    return F.filter(F.transform(fields, entry), lambda e: e["offset"] >= 0).cast(jobs.CITATIONS)


def _objects(o: Column) -> Column:
    """Objects of one schema of the row."""
    zipped = F.arrays_zip(F.col("page_fragments").alias("f"), F.col("page_best")["page_class"].alias("c"))
    chosen = F.filter(zipped, lambda z: F.coalesce(F.array_contains(o["page_classes"], z["c"]), F.lit(False)))
    frags = F.when(F.size(o["page_classes"]) == 0, F.col("fragments")).otherwise(F.flatten(F.transform(chosen, lambda z: z["f"])))

    def one(s: Column) -> Column:
        def shaped(part: Column) -> Column:
            return S.let(_filled(part, o["parts"]), lambda x: F.struct(
                _data(x).alias("data"),
                F.array_sort(F.array_distinct(F.transform(s["frags"], lambda f: f["page_number"]))).alias("page_numbers"),
                o["schema_name"].alias("schema_name"),
                _missing(x).alias("missing"),
                F.when(o["citations"], _citations(part, s["frags"], o["parts"])).alias("citations")))

        return S.let(F.array_join(F.transform(s["frags"], lambda f: f["text"]), "\n"), shaped)

    return F.transform(S.let(frags, lambda f: C.slices_by(f, o["strategy"], o["start"], o["end"])), one)


def _run(requests: DataFrame, key: str, text: str) -> DataFrame:
    """All steps over rows that have a ``job_type`` and their configuration as ``_cfg``."""
    cfg, kind = F.col("_cfg"), F.col("job_type")
    everything = kind.isin("parse", "dataset")
    typed = F.when(cfg["plain"], G.whole_pages("pages", True)).otherwise(
        G.page_fragments("pages", True, signatures=cfg["signatures"], struck=cfg["struck"], key_values=cfg["key_values"]))

    def kept(frags: Column) -> Column:
        left = F.filter(frags, lambda f: ~F.array_contains(cfg["drop"], f["fragment_type"]))
        return F.when(cfg["struck"], F.transform(left, lambda f: jobs.without_struck(f, True))).otherwise(left)

    typed, of_page = typed.cast(jobs.PLACED_FRAGMENTS), F.transform("page_fragments", kept).cast(jobs.PLACED_FRAGMENTS)
    out = jobs.parsed(requests, typed, of_page, True, text)
    out = out.withColumn("chunks", F.when((kind == "read") | everything, jobs.chunks_of(C.slices_by("fragments", cfg["strategy"]))))
    by_class = F.exists(cfg["schemas"], lambda o: F.size(o["page_classes"]) > 0)
    classes = F.transform(cfg["classes"], lambda c: F.struct(
        c["class_no"].alias("class_no"), c["page_class"].alias("page_class"), K.terms(c["text"]).alias("terms")))
    wanted = (F.size(cfg["classes"]) > 0) & ((kind == "classify") | everything | ((kind == "extract") & by_class))
    best = S.let(classes, lambda known: F.transform("pages", lambda p: S.let(K.terms(p["text"]), lambda t: K.best_class(t, known))))
    out = jobs.with_page_classes(out.withColumn("page_best", F.when(wanted, best).cast(jobs.BEST)))
    out = out.withColumn("page_classes", F.when((kind == "classify") | everything, F.col("page_classes")))
    extracted = F.flatten(F.transform(cfg["schemas"], _objects)).cast(jobs.STRUCTURED)
    out = out.withColumn("structured", F.when(((kind == "extract") | everything) & (F.size(cfg["schemas"]) > 0), extracted))
    tables = F.when(((kind == "read") | everything) & cfg["merge_tables"], jobs.merged_tables(key, cfg["table_summaries"]))
    return out.withColumn("merged_tables", tables.cast(jobs.MERGED)).withColumn("output", F.struct(
        cfg["tables"].alias("tables"), cfg["table_summaries"].alias("table_summaries"), cfg["figure_summaries"].alias("figure_summaries")))


def run_requests(requests: DataFrame, datasets: DataFrame | None = None, key: str = "parse_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Requests ``(key, text, job_type[, dataset_id][, configuration])`` to results and rejects.

    ``datasets`` has ``(dataset_id, configuration)``.  A request without a
    dataset has only its own options, or the default ones; a ``dataset`` job
    needs a dataset.  Rejects have the code of the first reason: an unknown or
    lacking dataset, a configuration or schema that is not valid, or no schema
    or class for a job that needs one.  Every request is in one of the tables;
    a null or empty text is a document without fragments.
    """
    own = F.col("configuration") if "configuration" in requests.columns else F.lit(None).cast("string")
    asked = requests.withColumn("_own", own).drop("configuration")
    if "dataset_id" not in asked.columns:
        asked = asked.withColumn("dataset_id", F.lit(None).cast("string"))
    if datasets is not None:
        asked = jobs.apply_dataset(asked, datasets.withColumn("configuration", F.coalesce("configuration", F.lit("{}"))))
    else:
        asked = asked.withColumn("configuration", F.lit(None).cast("string"))
    asked = asked.withColumn("_json", _compiled("configuration", "_own")).withColumn(text, F.coalesce(F.col(text), F.lit("")))
    asked = S.with_once(asked, "_cfg", F.from_json("_json", CONFIG)).drop("_json", "_own")
    cfg, kind = F.col("_cfg"), F.col("job_type")
    unknown = F.when(F.col("dataset_id").isNotNull(), F.col("configuration").isNull()).otherwise(kind == "dataset")

    def reason(code: str, message: str) -> Column:
        return F.struct(F.lit(code).alias("code"), F.lit(message).alias("message"))

    why = (
        F.when(unknown, reason("ENTITY_NOT_FOUND", "dataset not found"))
        .when(cfg["code"].isNotNull(), F.struct(cfg["code"].alias("code"), cfg["message"].alias("message")))
        .when((kind == "extract") & (F.size(cfg["schemas"]) == 0), reason("INVALID_CONFIGURATION", V.NO_SCHEMA))
        .when((kind == "classify") & (F.size(cfg["classes"]) == 0), reason("INVALID_PAGE_CLASSIFICATION", V.NO_CLASSES))
    )
    results = jobs.assemble(_run(asked.where(why.isNull()), key, text), key)
    rejects = asked.where(why.isNotNull()).select(key, "dataset_id", "job_type", why["code"].alias("code"), why["message"].alias("message"))
    return results, rejects
