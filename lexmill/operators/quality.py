"""Checks over written documents and run reports."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill import constants as K
from lexmill import schemas as S
from lexmill.functions.text import compute_once, date_violation

# --- fixed values: rules of the document contract ------------------------------------
DOCUMENT_KEYS = ["legal_act", "legal_act_relations"]
ACT_KEYS = [f.name for f in S.LEGAL_ACT]
ACT_REQUIRED = ["document_id", "jurisdiction"]
ACT_NOT_NULL = ["document_id", "jurisdiction", "is_in_force"]
RELATION_REQUIRED = ["source_document_id", "target_document_id", "relation_type"]
RELATION_KEYS = RELATION_REQUIRED + ["concerned_sections"]
SECTION_REQUIRED = ["subdivision_concerned"]
SECTION_KEYS = SECTION_REQUIRED + ["comment"]

OBJECT = "map<string,variant>"
LIST = "array<variant>"


def _codes(*columns: Column) -> Column:
    """Codes that are set, as one array."""
    return F.array_compact(F.array(*columns))


def _missing(fields: Column, required: list[str], path: Column) -> Column:
    """A code per required key that ``fields`` lacks."""
    absent = F.array_except(F.array(*[F.lit(k) for k in required]), F.map_keys(fields))
    return F.transform(absent, lambda key: F.concat(path, F.lit("."), key, F.lit(": required")))


def _per_entry(fields: Column, path: Column, rule) -> Column:
    """Codes of the entries of an object that break ``rule(key, value, type)``."""

    def code(entry: Column) -> Column:
        found = rule(entry["key"], entry["value"], F.schema_of_variant(entry["value"]))
        return F.concat(path, F.lit("."), entry["key"], F.lit(": "), found)

    return F.array_compact(F.transform(F.map_entries(fields), code))


def _text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def _act_rule(key: Column, value: Column, kind: Column) -> Column:
    return (
        F.when(~key.isin(ACT_KEYS), "unknown")
        .when((kind == "VOID") & ~key.isin(ACT_NOT_NULL), None)
        .when(key == "is_in_force", F.when(kind != "BOOLEAN", "type"))
        .when(kind != "STRING", "type")
        .when((key == "document_id") & (_text(value) == ""), "minLength")
        .when((key == "type") & ~_text(value).isin(K.ACT_TYPES), "enum")
        .when((key == "jurisdiction") & ~_text(value).isin(K.JURISDICTIONS), "enum")
        .when((key == "entity_type") & ~_text(value).isin(K.ENTITY_TYPES), "enum")
    )


def _relation_rule(key: Column, value: Column, kind: Column) -> Column:
    is_list = kind.startswith("ARRAY")
    return (
        F.when(~key.isin(RELATION_KEYS), "unknown")
        .when(key == "concerned_sections", F.when((kind != "VOID") & ~is_list, "type"))
        .when(kind != "STRING", "type")
        .when(_text(value) == "", "minLength")
    )


def _section_rule(key: Column, value: Column, kind: Column) -> Column:
    return (
        F.when(~key.isin(SECTION_KEYS), "unknown")
        .when((key == "comment") & (kind == "VOID"), None)
        .when(kind != "STRING", "type")
        .when((key == "subdivision_concerned") & (_text(value) == ""), "minLength")
    )


def _object_codes(value: Column, path: Column, required: list[str], rule) -> Column:
    fields = F.try_variant_get(value, "$", OBJECT)
    return F.when(fields.isNull(), F.array(F.concat(path, F.lit(": type")))).otherwise(
        F.concat(_missing(fields, required, path), _per_entry(fields, path, rule))
    )


def _list_codes(items: Column, path: Column, item_codes) -> Column:
    """Codes of all items of an array of variants; none for null."""
    codes = F.transform(
        items,
        lambda item, i: item_codes(
            item, F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))
        ),
    )
    return F.coalesce(F.flatten(codes), F.array().cast("array<string>"))


def _section_codes(section: Column, path: Column) -> Column:
    return _object_codes(section, path, SECTION_REQUIRED, _section_rule)


def _relation_codes(relation: Column, path: Column) -> Column:
    sections = F.try_variant_get(relation, "$.concerned_sections", LIST)
    return F.concat(
        _object_codes(relation, path, RELATION_REQUIRED, _relation_rule),
        _list_codes(sections, F.concat(path, F.lit(".concerned_sections")), _section_codes),
    )


def document_violations(doc: Column) -> Column:
    """All violations of the document contract, as an array of ``path: rule``.

    ``doc`` is a VARIANT, since a typed read would hide unknown keys and turn numbers into
    strings. Null (no JSON, or a repeated key) and non-objects break the contract too.
    """
    root = F.try_variant_get(doc, "$", OBJECT)
    act = F.try_variant_get(doc, "$.legal_act", "variant")
    relations = F.try_variant_get(doc, "$.legal_act_relations", "variant")
    relations_kind = F.schema_of_variant(relations)
    unknown = F.transform(
        F.array_except(F.map_keys(root), F.array(*[F.lit(k) for k in DOCUMENT_KEYS])),
        lambda key: F.concat(key, F.lit(": unknown")),
    )
    return F.when(root.isNull(), F.array(F.lit("document: type"))).otherwise(
        F.concat(
            unknown,
            F.when(act.isNull(), F.array(F.lit("legal_act: required"))).otherwise(
                _object_codes(act, F.lit("legal_act"), ACT_REQUIRED, _act_rule)
            ),
            _codes(
                F.when(
                    (relations_kind != "VOID") & ~relations_kind.startswith("ARRAY"),
                    "legal_act_relations: type",
                )
            ),
            _list_codes(
                F.try_variant_get(doc, "$.legal_act_relations", LIST),
                F.lit("legal_act_relations"),
                _relation_codes,
            ),
        )
    )


def check_documents(docs: DataFrame) -> DataFrame:
    """Raw documents ``file, root_ok, pos, raw`` with id, title, dates and violations.

    A file whose root is no array keeps one row with ``root: type``; the row of an empty
    array has no violations.
    """
    doc = F.col("_doc")
    parsed = compute_once(docs, _doc=F.try_parse_json("raw"))

    def field(name: str) -> Column:
        return F.try_variant_get(doc, f"$.legal_act.{name}", "string").alias(name)

    violations = (
        F.when(~F.col("root_ok"), F.array(F.lit("root: type")))
        .when(F.col("pos").isNull(), F.array().cast("array<string>"))
        .otherwise(document_violations(doc))
    )
    return parsed.select(
        "file", "pos",
        F.coalesce(field("document_id"), F.lit("?")).alias("document_id"),
        field("title"),
        *[field(name) for name in K.DATE_FIELDS],
        violations.alias("violations"),
    )


def schema_violations(checked: DataFrame) -> DataFrame:
    """One row per violation: ``file, pos, document_id, violation``."""
    # the outer form keeps the optimizer from testing the array before it explodes it
    return checked.select(
        "file", "pos", "document_id", F.explode_outer("violations").alias("violation")
    ).where(F.col("violation").isNotNull())


def _date_faults() -> Column:
    """Wrong dates of a row as ``array<struct<field, value, reason>>``."""
    tested = F.array(
        *[
            F.struct(
                F.lit(name).alias("field"), F.col(name).alias("value"),
                date_violation(name).alias("reason"),
            )
            for name in K.DATE_FIELDS
        ]
    )
    return F.filter(tested, lambda t: t["reason"].isNotNull())


def date_violations(acts: DataFrame, *keep: str) -> DataFrame:
    """One row per wrong date: ``document_id, field, value, reason`` and the kept columns.

    Right dates are filtered inside the row, so good documents add no rows.
    """
    return acts.select(*keep, "document_id", F.inline(_date_faults()))


def passing_files(checked: DataFrame) -> DataFrame:
    """Documents of files without a schema violation.

    Dates, titles and duplicates are judged in such files only. The verdict per file is an
    aggregate of one row a file.
    """
    failed = checked.where(F.size("violations") > 0).select("file").distinct()
    return checked.join(failed, "file", "left_anti")


def title_warnings(acts: DataFrame) -> DataFrame:
    """Documents without a title, the sign of an empty page. An empty file has no document."""
    return acts.where(F.col("pos").isNotNull() & F.col("title").isNull())


def duplicate_keys(docs: DataFrame, group: str = "file", key: str = "document_id") -> DataFrame:
    """Ids that occur more than once in a file: ``file, document_id, copies``."""
    return (
        docs.where(F.col("pos").isNotNull()).groupBy(group, F.coalesce(F.col(key), F.lit("?")).alias(key))
        .agg(F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
    )


def file_verdicts(checked: DataFrame) -> DataFrame:
    """Verdict per file: schema, then duplicates, then dates fail it; missing titles warn.

    Two aggregations with map-side combine, by file and id and then by file; no join. A
    file with a large share of all documents is spread over its ids first.
    """
    present = F.col("pos").isNotNull()
    per_id = checked.groupBy("file", "document_id").agg(
        F.count_if(present).alias("copies"),
        F.count_if(F.size("violations") > 0).alias("schema"),
        F.sum(F.size(_date_faults())).alias("dates"),
        F.count_if(present & F.col("title").isNull()).alias("titles"),
    )
    counts = per_id.groupBy("file").agg(
        F.sum("copies").alias("documents"),
        F.sum("schema").alias("schema_errors"),
        F.count_if(F.col("copies") > 1).alias("duplicates"),
        F.sum("dates").alias("date_errors"),
        F.sum("titles").alias("title_warnings"),
    )
    verdict = (
        F.when(F.col("schema_errors") > 0, "FAIL schema")
        .when(F.col("duplicates") > 0, "FAIL duplicates")
        .when(F.col("date_errors") > 0, "FAIL quality")
        .when(F.col("title_warnings") > 0, "WARN")
        .otherwise("OK")
    )
    return counts.select("*", verdict.alias("verdict"))


def missing_keys(raw: Column, required: list[str]) -> Column:
    """Required keys a JSON object lacks; all of them if the text is no object."""
    keys = F.coalesce(F.json_object_keys(raw), F.array().cast("array<string>"))
    return F.array_except(F.array(*[F.lit(k) for k in required]), keys)


def report_verdicts(reports: DataFrame) -> DataFrame:
    """Verdict per run report ``file, raw``: missing keys, then a non-integer error count."""
    errors_kind = F.schema_of_variant(
        F.try_variant_get(F.try_parse_json("raw"), "$.errors", "variant")
    )
    missing = missing_keys(F.col("raw"), K.REPORT_KEYS)
    return reports.select("file", missing.alias("missing"), errors_kind.alias("_kind")).select(
        "file",
        "missing",
        F.when(F.size("missing") > 0, "FAIL missing keys")
        .when(F.coalesce(F.col("_kind"), F.lit("")) != "BIGINT", "FAIL errors type")
        .otherwise("OK")
        .alias("verdict"),
    )


def all_passed(*verdicts: DataFrame) -> DataFrame:
    """One row ``passed``: true if no verdict is a failure."""
    first, *rest = [v.select("verdict") for v in verdicts]
    for other in rest:
        first = first.unionByName(other)
    return first.agg(
        F.coalesce(F.bool_and(~F.col("verdict").startswith("FAIL")), F.lit(True)).alias("passed")
    )
