"""Structured extraction, key-value pairs and citations."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docspark.functions import json_schema as J
from docspark.functions import scalars as S

# Fixed value: a key-value line.
KEY_VALUE = r"(?m)^([A-Za-z0-9_ ]+):[ \t]*([^\n]+)$"
CITE_BUCKET = 3000


def label_pattern(name: str) -> str:
    """Regular expression of a field's name up to its colon."""
    # The name is text; only its underscores may stand for spaces.
    return rf"(?im)^[ \t]*{re.escape(name).replace('_', '[ _]')}[ \t]*:"


def labelled_text(text, label: Column) -> Column:
    """Value of the first line that begins with a label; the label's pattern may be a value of the row."""
    found = F.call_function("regexp_extract", S._c(text), F.concat(label, F.lit(r"[ \t]*([^\n]+)$")), F.lit(1))
    return S.blank_to_null(S.trimmed(found))


def field_text(text, name: str) -> Column:
    """Value of the first ``name: value`` line; spaces may stand for underscores."""
    return labelled_text(text, F.lit(label_pattern(name)))


def labelled_at(text, label: Column, value) -> Column:
    """0-based place of a value in a text: behind its label if the label stands there, else where it first occurs."""
    t, v = S._c(text), S._c(value)
    colon = F.call_function("locate", F.lit(":"), t, F.greatest(F.regexp_instr(t, label), F.lit(1)))
    behind = F.when(F.rlike(t, label), F.call_function("locate", v, t, F.greatest(colon, F.lit(1)))).otherwise(0)
    return F.when(behind > 0, behind - 1).otherwise(F.instr(t, v) - 1)


def value_at(text, name: str, value) -> Column:
    """The same for a field by its name."""
    return labelled_at(text, F.lit(label_pattern(name)), value)


def _typed(raw: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.ArrayType):
        return F.when(
            raw.isNotNull(),
            F.transform(F.split(raw, ","), lambda p: _typed(S.trimmed(p), kind.elementType)),
        )
    return raw if isinstance(kind, T.StringType) else raw.try_cast(kind)


def by_line(kind: T.DataType) -> bool:
    """Scalars and lists of scalars have a form on one line; the rest has none."""
    if isinstance(kind, T.ArrayType):
        kind = kind.elementType
    return not isinstance(kind, (T.StructType, T.ArrayType, T.VariantType))


def prose_struct(text, schema: T.StructType, prefix: str = "") -> Column:
    """Fields found as ``name: value`` lines, typed; a nested field is ``parent_child``.

    Lists of objects and open objects are only read from JSON text.
    """
    cols = []
    for f in schema.fields:
        if isinstance(f.dataType, T.StructType):
            cols.append(prose_struct(text, f.dataType, f"{prefix}{f.name}_").alias(f.name))
        elif not by_line(f.dataType):
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            cols.append(_typed(field_text(text, prefix + f.name), f.dataType).alias(f.name))
    return F.struct(*cols)


def extract_struct(text, schema: T.StructType) -> Column:
    """JSON text is parsed by the schema, other text is read line by line."""
    t = S.trimmed(text)
    return F.when(t.startswith("{"), F.from_json(t, schema)).otherwise(prose_struct(t, schema))


def missing_required(data: Column, paths: Sequence[tuple[str, ...]]) -> Column:
    """Required fields without a value, as dotted paths.

    What an absent object requires is not missing, unless the object is.
    """

    def absent(path: tuple[str, ...]) -> Column:
        value, there = data, F.lit(True)
        for i, name in enumerate(path):
            if i:
                there = there & value.isNotNull()
            value = value.getField(name)
        return F.when(there & value.isNull(), F.lit(".".join(path)))

    return F.filter(
        F.array(*[absent(p) for p in paths]) if paths else F.array().cast("array<string>"), lambda n: n.isNotNull()
    )


def extract(
    parts: DataFrame,
    schema_name: str,
    json_schema: str | dict,
    key: str = "doc_id",
    custom: Callable[[Column], Column] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """One JSON object per partition; partitions without a required field are rejects."""
    return extract_all(parts, {schema_name: json_schema}, key, custom)


def extract_all(
    parts: DataFrame, schemas: dict[str, str | dict], key: str = "doc_id", custom: Callable[[Column], Column] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Several schemas over the same partitions, in one pass: each partition's text is read once for all of them."""

    def one(name: str, schema: str | dict) -> Column:
        struct = J.json_schema_to_struct(schema)
        data = custom(F.col("text")) if custom else extract_struct("text", struct)
        return S.let(data, lambda d: F.struct(
            F.lit(name).alias("schema_name"), F.to_json(d).alias("data"), missing_required(d, J.required(schema)).alias("missing")))

    done = S.unnest(parts, [key, "partition_no", "page_numbers"], F.array(*[one(n, s) for n, s in schemas.items()]), "_d")
    out = done.where(F.size("_d.missing") == 0).select(
        key, F.col("_d.schema_name").alias("schema_name"), "partition_no", "page_numbers", F.col("_d.data").alias("data")
    )
    rejects = done.where(F.size("_d.missing") > 0).select(
        key,
        F.col("_d.schema_name").alias("schema_name"),
        "partition_no",
        F.lit("INVALID_JSON_SCHEMA").alias("code"),
        F.concat(F.lit("missing required: "), F.array_join("_d.missing", ", ")).alias("message"),
    )
    return out, rejects


def key_value_map(text) -> Column:
    """All key-value lines of a text as ``[{key, value}]`` in text order."""
    t = S._c(text)
    keys = F.regexp_extract_all(t, F.lit(KEY_VALUE), F.lit(1))
    values = F.regexp_extract_all(t, F.lit(KEY_VALUE), F.lit(2))
    return F.transform(
        F.arrays_zip(keys.alias("k"), values.alias("v")),
        lambda z: F.struct(S.trimmed(z["k"]).alias("key"), S.trimmed(z["v"]).alias("value")),
    )


def key_values(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Flat ``(key, pair_no, key_name, value)`` rows."""
    return df.select(key, F.posexplode(key_value_map(text)).alias("pair_no", "kv")).select(
        key, "pair_no", F.col("kv.key").alias("key_name"), F.col("kv.value").alias("value")
    )


def cite(values: DataFrame, pages: DataFrame, key: str = "doc_id", bucket: int = CITE_BUCKET) -> DataFrame:
    """Page that covers each value's character offset (a range join).

    Both sides carry the offset bucket in the join key, so a value only meets
    the page or two of its bucket, and one huge document spreads over many tasks.
    """
    spans = pages.where(F.col("end") > F.col("start")).select(
        key,
        F.col("page_number"),
        F.col("start").alias("_s"),
        F.col("end").alias("_e"),
        F.explode(F.expr(f"sequence(start div {bucket}, (end - 1) div {bucket})")).alias("_bucket"),
    )
    v = values.withColumn("_bucket", F.expr(f"offset div {bucket}"))
    joined = v.join(spans, [key, "_bucket"]).where((F.col("offset") >= F.col("_s")) & (F.col("offset") < F.col("_e")))
    return joined.withColumn("page_offset", F.col("offset") - F.col("_s")).drop("_bucket", "_s", "_e")


def cite_in_row(pages, offset) -> Column:
    """The same where the document row still has its ``pages`` array."""
    off = S._c(offset)
    hit = F.filter(S._c(pages), lambda p: (p["start"] <= off) & (off < p["end"]))
    return F.get(hit, F.lit(0))["page_number"]


def value_offsets(docs: DataFrame, fields: Sequence[str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Where each extracted value first occurs in its document (0-based); absent values are left out."""
    entries = F.array(*[
        F.struct(
            F.lit(f).alias("field"),
            F.col(f).cast("string").alias("value"),
            (F.instr(F.col(text), S.blank_to_null(F.col(f).cast("string"))) - 1).alias("offset"),
        )
        for f in fields
    ])
    found = F.filter(entries, lambda e: e["offset"] >= 0)
    return docs.select(key, F.explode(found).alias("e")).select(key, "e.*")
