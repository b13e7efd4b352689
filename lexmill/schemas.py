"""Explicit schemas. Nothing is inferred on a read or write path.

Fixed values: the field names and their order are those of the exchange format.
"""

from pyspark.sql import types as T

_S, _L = T.StringType(), T.LongType()


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, _S) for name in names]


LEGAL_ACT = T.StructType(
    _strings("document_id", "jurisdiction", "entity_type")
    + [T.StructField("is_in_force", T.BooleanType())]
    + _strings(
        "language", "url", "canonical_source_url", "fallback_text_url", "title", "title_short",
        "abbreviation", "type", "summary", "entry_into_force_date", "enactment_date",
        "last_amendment_date", "validity_date", "publication_date",
    )
)
SECTION = T.StructType(_strings("subdivision_concerned", "comment"))
RELATION = T.StructType(
    _strings("source_document_id", "target_document_id", "relation_type")
    + [T.StructField("concerned_sections", T.ArrayType(SECTION))]
)
RELATIONS = T.ArrayType(RELATION)
DOCUMENT = T.StructType(
    [T.StructField("legal_act", LEGAL_ACT), T.StructField("legal_act_relations", RELATIONS)]
)

ERROR_REASON = T.StructType([T.StructField("reason", _S), T.StructField("count", _L)])
RUN_REPORT = T.StructType(
    _strings("runId", "mode")
    + [
        T.StructField(name, _L)
        for name in (
            "fetched", "extracted", "enriched", "newDocuments", "updatedDocuments", "errors",
        )
    ]
    + [T.StructField("topErrorReasons", T.ArrayType(ERROR_REASON))]
)

LAW_PAGES = T.StructType(_strings("document_id", "doc_type", "url", "entry_date", "html"))
OUTCOMES = T.StructType(
    _strings("kind", "document_id", "reason", "message")
    + [
        T.StructField("legal_act", LEGAL_ACT),
        T.StructField("legal_act_relations", RELATIONS),
    ]
)
CHECKPOINT = T.StructType(
    _strings("lastRun", "runId")
    + [T.StructField("committedAt", T.TimestampType())]
    + _strings("follows")
    + [T.StructField("guarded", T.BooleanType())]
)
PROGRESS = T.StructType(
    _strings("start")
    + [T.StructField("lot", T.IntegerType())]
    + _strings("attempt")
    + [T.StructField("finishedAt", T.TimestampType())]
)
RUN_COUNTS = T.StructType(
    _strings("runId") + [T.StructField(name, _L) for name in ("entries", "laws", "remaining", "skipped")]
)
