"""Checks of JSON rows against a table of fields: types, values, bounds, keys that must not be there."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom import constants as C


@dataclass(frozen=True)
class Field:
    """One field of a row: ``kind`` is string, int, bool, time, object or strings; without ``required`` it may be missing."""

    name: str
    kind: str = "string"
    nullable: bool = False
    required: bool = True
    allowed: tuple[str, ...] = ()
    least: int | None = None


def _optional(*names: str) -> tuple[Field, ...]:
    return tuple(Field(n, nullable=True, required=False) for n in names)


_MODE = Field("mode_code", allowed=C.PACKAGE_MODES)
PACKAGE_ROWS = {
    "tasks": (Field("task_id"), Field("question_id"), Field("question"), _MODE, Field("task_status", allowed=C.TASK_STATUSES),
    *_optional("error_code", "error_message")),
    "answers": (
        Field("answer_id"), Field("task_id"), Field("question_id"), _MODE, Field("question_text"), Field("answer_text_raw", nullable=True),
        Field("answer_text_clean", nullable=True),
        Field("acquisition_status", allowed=C.ACQUISITION_STATUSES), Field("validation_status", allowed=C.VALIDATION_STATUSES),
        Field("is_complete", "bool"),
        Field("source_collection_status", allowed=C.COLLECTION_STATUSES), Field("source_count_raw", "int", least=0),
        *_optional("screenshot_path"), Field("collected_at", "time"),
        Field("platform_meta_json", "object", required=False),
    ),
    "sources": (
        Field("occurrence_id"), Field("answer_id"), Field("source_order", "int", least=1),
        *_optional("source_title_raw", "source_site_name_raw"), Field("source_url_raw"), *_optional("source_snippet"),
        Field("is_duplicate_in_answer", "bool", required=False),
    ),
}
MANIFEST = (
    Field("schema_version", required=False, allowed=(C.PACKAGE_VERSION,)),
    Field("geo_batch_version", required=False, allowed=(C.BATCH_VERSION,)), Field("platform_code", required=False),
    Field("platform_name", required=False),
    *[Field(n) for n in ("product_id", "product_name", "batch_id", "collector_version")], *_optional("status"),
    Field("started_at", "time", True, False), Field("finished_at", "time", True, False),
    Field("capabilities", "object", required=False),
    *[Field(f"{n}_count", "int", required=False, least=0) for n in ("task", "answer", "source")], Field("files", "strings", required=False),
)
LEGACY_ROWS = {
    "tasks": (Field("question_id"), Field("question"), Field("mode", allowed=C.MODES), Field("status", allowed=tuple(C.PACKAGE_STATUS)),
    *_optional("error_type", "error_message")),
    "answers": (
        Field("question_id"), Field("question"), Field("mode", allowed=C.MODES), Field("mode_label"), Field("answer"), Field("turn_id"),
        Field("chat_url"), Field("search_queries", "strings", required=False),
        Field("citation_mapping_available", "bool", required=False), Field("acquired_at", "time"),
    ),
    "sources": (Field("occurrence_id"), Field("question_id"), Field("mode", allowed=C.MODES), Field("rank", "int"), Field("title"),
    Field("url")),
}
LEGACY_MANIFEST = (
    Field("schema_version", required=False, allowed=(C.BATCH_VERSION,)), Field("platform", required=False), Field("package_id"),
    Field("created_at", "time"),
    *[Field(f"{n}_count", "int", least=0) for n in ("task", "answer", "source")], Field("files", "strings", required=False),
)


def _fault(row: Column, field: Field) -> Column:
    """What is wrong with a field of a VARIANT row, or null: missing, null, type or value."""
    at = f"$['{field.name}']"
    kind = F.schema_of_variant(F.try_variant_get(row, at, "variant"))
    text, whole = F.try_variant_get(row, at, "string"), F.try_variant_get(row, at, "bigint")
    number = kind.rlike("^(BIGINT|DECIMAL)") & (F.try_variant_get(row, at, "double") == whole)
    fits = {
        "string": kind == "STRING",
        "int": F.coalesce(number | ((kind == "STRING") & whole.isNotNull()), F.lit(False)),
        "bool": kind == "BOOLEAN",
        "time": (kind == "STRING") & text.try_cast("timestamp").isNotNull(),
        "object": kind.startswith("OBJECT"),
        "strings": kind.isin("ARRAY<STRING>", "ARRAY<VOID>"),
    }[field.kind]
    out = F.when(kind.isNull(), "missing" if field.required else None).when(kind == "VOID", None if field.nullable else "null").when(~fits,
        "type")
    if field.allowed:
        out = out.when(~text.isin(*field.allowed), "value")
    if field.least is not None:
        out = out.when(whole < field.least, "value")
    return out


def row_faults(rows: DataFrame, line: str, fields: Sequence[Field], keys: Sequence[str], forbidden: Sequence[str] = ()) -> DataFrame:
    """(keys, field, fault) of JSON lines that break a table of fields.

    Faults are 'no JSON' and 'no object' (of field ''), missing, null, type, value and, for keys
    that must not be there, forbidden. Other keys are let through. Null lines are left out.
    """
    # In brackets, so that anything after the value is told.
    whole = F.try_parse_json(F.concat(F.lit("["), F.col(line), F.lit("]")))
    row = F.when(F.try_variant_get(whole, "$[1]", "variant").isNull(), F.try_variant_get(whole, "$[0]", "variant"))
    inside = F.array(*[F.struct(F.lit(f.name).alias("field"), _fault(F.col("_v"), f).alias("fault")) for f in fields])
    banned = F.transform(F.array_intersect(F.json_object_keys(line), F.array(*[F.lit(f) for f in forbidden]).cast("array<string>")),
        lambda k: F.struct(k.alias("field"), F.lit("forbidden").alias("fault")))
    one = lambda fault: F.array(F.struct(F.lit("").alias("field"), F.lit(fault).alias("fault")))
    shape = F.schema_of_variant("_v")
    found = F.when(F.col("_v").isNull(), one("no JSON")).when(~shape.startswith("OBJECT"),
        one("no object")).otherwise(F.concat(inside, F.coalesce(banned, F.array().cast("array<struct<field:string,fault:string>>"))))
    told = rows.where(F.col(line).isNotNull()).withColumn("_v", row).select(*keys,
        F.inline(F.filter(found, lambda x: x["fault"].isNotNull())))
    return told
