"""SQL of each query over the given tables, for the check in another engine.

The statements compute from typed columns. They share no text with the Spark side except
the extraction checks over the real pages, which have no typed columns to compare with.
"""

from lexmill import constants as K
from lexmill.queries import raw

WS = r"[\t-\r \x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]"
TODAY, LAST_RUN = raw.TODAY, raw.LAST_RUN
ISO = "'%Y-%m-%d'"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" for v in row) + ")" for row in rows)


def _literal(value) -> str:
    return "NULL" if value is None else f"'{value}'"


O = """o AS (
  SELECT o_orderkey AS k, o_custkey AS cust, CAST(o_orderdate AS DATE) AS d,
         o_orderstatus AS st, o_orderpriority AS pr,
         CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'gesetz' WHEN '2' THEN 'rechtsverordnung'
              WHEN '3' THEN 'bekanntmachung' ELSE 'satzung' END AS t
  FROM orders)"""


def _url(day: str, doc_type: str, slash: str) -> str:
    return (
        f"'{raw.HOST}/' || k || '/lrgv/' || {doc_type} || '/' || strftime({day}, '%d%m%Y')"
        f" || '-law-' || cust || {slash}"
    )


SLASH = "CASE WHEN k % 2 = 0 THEN '/' ELSE '' END"
FUTURE = "DATE '2999-12-31'"
STAMP = f"strftime(d + 30, {ISO}) || 'T06:30:00+02:00'"


def _entry(pos: int, day: str, doc_type: str, slash: str, lastmod: str, where: str) -> str:
    return f"""SELECT k AS page, {pos} AS pos, 'law-' || cust AS document_id,
      {_url(day, doc_type, slash)} AS url, {lastmod} AS lastmod, {doc_type} AS doc_type,
      strftime({day}, '%d%m%Y') AS date_str, strftime({day}, {ISO}) AS entry_date
    FROM o WHERE {where}"""


ENTRIES = f"""{O}, e AS (
  {_entry(0, 'd', 't', SLASH, STAMP, 'true')}
  UNION ALL {_entry(3, FUTURE, 't', "''", STAMP, 'true')}
  UNION ALL {_entry(4, '(d - 365)', 't', "''", 'NULL', 'k % 4 = 0')}
  UNION ALL {_entry(5, 'd', "'bekanntmachung'", "''", STAMP, 'k % 3 = 0')}),
past AS (SELECT * FROM e WHERE entry_date <= '{TODAY}')"""


def _latest(source: str, columns: str = "*") -> str:
    return f"""SELECT {columns} FROM (
      SELECT *, row_number() OVER (PARTITION BY document_id
               ORDER BY entry_date DESC, page, pos) AS rn FROM {source}) WHERE rn = 1"""


VERSION = "document_id, url, lastmod, doc_type, date_str, entry_date"
CUTOFF = f"strftime(DATE '{LAST_RUN}' - 2, {ISO})"
CHANGED = f"""changed AS (
  SELECT * REPLACE (substr(lastmod, 1, 10) AS lastmod) FROM past
  WHERE substr(lastmod, 1, 10) >= {CUTOFF})"""

# fields of the page of each order, from its columns
ONLY_FIELDS = f"""f AS (
  SELECT k, cust, d, st, 'order-' || k AS document_id, t AS doc_type,
    {_url('d', 't', SLASH)} AS url, strftime(d, {ISO}) AS entry_date,
    pr <> '5-LOW' AS has_page,
    CASE WHEN k % 11 <> 0 AND k % 13 <> 0 THEN 'Gesetz&nbsp;' || k || ' zu Nr. ' || cust END AS title,
    CASE WHEN k % 5 IN (0, 1, 3) THEN 'G' || k END AS abbreviation,
    CASE WHEN k % 5 IN (0, 1, 3) THEN strftime(d, {ISO}) END AS enactment_date,
    CASE WHEN k % 5 IN (0, 1, 3) THEN strftime(d + 100, {ISO}) END AS last_amendment_date,
    CASE WHEN k % 5 IN (0, 3) THEN strftime(d + 10, {ISO}) END AS publication_date,
    CASE WHEN k % 5 = 1 THEN year(d) END AS issue_year,
    CASE WHEN k % 5 = 1 THEN month(d) END AS issue_number,
    CASE t WHEN 'rechtsverordnung' THEN 'regulation' WHEN 'bekanntmachung' THEN 'announcement'
           ELSE 'law' END AS legal_type,
    trim(
      CASE WHEN k % 15 = 2 AND k % 11 <> 0 AND k % 13 <> 0
           THEN 'Gesetz&nbsp;' || k || ' zu Nr. ' || cust ELSE '' END
      || 'Absatz ' || k || '. ' || CASE WHEN st = 'P' THEN 'aufgehoben ' ELSE '' END
      || repeat('Wort ', CAST((k % 7) * 100 AS INT))) AS text_content
  FROM o)"""
FIELDS = f"{O}, {ONLY_FIELDS}"
PAGE_FIELDS = [
    "title", "abbreviation", "enactment_date", "last_amendment_date", "publication_date",
    "text_content",
]
MASKED = ", ".join(f"CASE WHEN has_page THEN {c} END AS {c}" for c in PAGE_FIELDS)

# first deciding attempt of each order
ATTEMPTS = """a AS (
  SELECT 'order-' || l_orderkey AS document_id, l_linenumber AS attempt, l_returnflag AS flag
  FROM lineitem),
decided AS (
  SELECT document_id, min(attempt) AS attempt,
         min(CASE flag WHEN 'N' THEN 0 ELSE 1 END) AS miss
  FROM (SELECT *, min(attempt) OVER (PARTITION BY document_id) AS first
        FROM a WHERE flag <> 'A') WHERE attempt = first GROUP BY document_id),
fetched AS (
  SELECT document_id, CASE WHEN decided.attempt IS NULL THEN 'transient'
           WHEN miss = 0 THEN 'ok' ELSE 'permanent' END AS fetch_outcome,
         coalesce(decided.attempt, last) AS attempts,
         CASE WHEN decided.attempt IS NULL THEN 'HTTP 503'
              WHEN miss = 1 THEN 'HTTP 404' END AS message
  FROM (SELECT document_id, max(attempt) AS last FROM a GROUP BY document_id)
  LEFT JOIN decided USING (document_id))"""


def _summaries(prefix: str) -> str:
    return f"""s AS (
  SELECT '{prefix}' || doc_id AS document_id,
    regexp_replace(text, '^{WS}+|{WS}+\\z', '', 'g') AS summary
  FROM documents WHERE doc_id % 7 <> 0 AND doc_id % 11 <> 0 AND doc_id % 13 <> 0
    AND regexp_replace(text, '^{WS}+|{WS}+\\z', '', 'g') <> '')"""


EXTRACTED = f"""{FIELDS}, {ATTEMPTS}, x AS (
  SELECT f.*, message,
    CASE WHEN fetch_outcome <> 'ok' THEN fetch_outcome
         WHEN NOT has_page THEN 'transient' END AS error_type
  FROM f LEFT JOIN fetched USING (document_id))"""


def _outcomes(source: str, failed_message: str) -> str:
    """Flat outcomes of rows with the fields of a page, an error type and a summary."""
    doc = "error_type IS NULL AND st <> 'F'"

    def act(value: str) -> str:
        return f"CASE WHEN {doc} THEN {value} END"

    return f"""SELECT CASE WHEN {doc} THEN 'document' ELSE 'error' END AS kind, document_id,
      CASE WHEN error_type = 'permanent' THEN 'http_error_permanent'
           WHEN error_type IS NOT NULL THEN 'http_error_transient'
           WHEN st = 'F' THEN 'abrogated' END AS reason,
      CASE WHEN error_type IS NOT NULL THEN {failed_message}
           WHEN st = 'F' THEN 'abrogated' END AS message,
      {act('document_id')} AS act_document_id, {act("'de_nw'")} AS act_jurisdiction,
      {act("'legal_act'")} AS act_entity_type, {act('true')} AS act_is_in_force,
      {act("'de'")} AS act_language, {act('url')} AS act_url,
      {act('url')} AS act_canonical_source_url,
      CAST(NULL AS VARCHAR) AS act_fallback_text_url, {act('title')} AS act_title,
      {act('abbreviation')} AS act_title_short, {act('abbreviation')} AS act_abbreviation,
      {act('legal_type')} AS act_type, {act('summary')} AS act_summary,
      {act('entry_date')} AS act_entry_into_force_date,
      {act('enactment_date')} AS act_enactment_date,
      {act('last_amendment_date')} AS act_last_amendment_date,
      CAST(NULL AS VARCHAR) AS act_validity_date,
      {act('publication_date')} AS act_publication_date,
      {act('0')} AS relations
    FROM {source}"""


LAW_ATTEMPTS = ATTEMPTS.replace("'order-'", "'law-'")


def _versions_joined(versions: str, with_summary: bool = True, attempts: bool = False) -> str:
    """Chosen versions with the fields of the order page at the same address."""
    summary = "summary" if with_summary else "CAST(NULL AS VARCHAR)"
    join = "LEFT JOIN s USING (document_id)" if with_summary else ""
    error = "CASE WHEN f.url IS NULL THEN 'transient' END"
    logged = ""
    if attempts:
        error = f"CASE WHEN fetch_outcome <> 'ok' THEN fetch_outcome ELSE {error} END"
        logged = "LEFT JOIN fetched USING (document_id)"
    fields = ", ".join(
        f"f.{c}" for c in PAGE_FIELDS if c != "text_content"
    )
    return f"""w AS (
  SELECT v.document_id, v.url, v.entry_date, f.st, {fields}, {summary} AS summary,
    CASE v.doc_type WHEN 'rechtsverordnung' THEN 'regulation'
      WHEN 'bekanntmachung' THEN 'announcement' ELSE 'law' END AS legal_type,
    {error} AS error_type
  FROM ({versions}) v LEFT JOIN (SELECT * EXCLUDE (document_id) FROM f WHERE has_page) f
    ON v.url = f.url {join} {logged})"""


NO_PAGE = "'no stored page'"
BACKFILL = f"""{ENTRIES}, {ONLY_FIELDS}, {_summaries('law-')},
  {_versions_joined(_latest('past'))}, r AS ({_outcomes('w', NO_PAGE)})"""
BACKFILL_LOGGED = f"""{ENTRIES}, {ONLY_FIELDS}, {LAW_ATTEMPTS}, {_summaries('law-')},
  {_versions_joined(_latest('past'), attempts=True)}, r AS ({_outcomes('w', NO_PAGE)}),
  z AS (SELECT kind, reason, act_summary AS summary FROM r)"""
DAILY = f"""{ENTRIES}, {CHANGED}, {ONLY_FIELDS}, {LAW_ATTEMPTS}, {_summaries('law-')},
  {_versions_joined(_latest('changed'), attempts=True)}, r AS ({_outcomes('w', NO_PAGE)})"""
SAMPLE_LAWS = f"""SELECT latest.* FROM ({_latest('past')}) latest JOIN (
    SELECT document_id FROM (
      SELECT document_id, min(page * 10 + pos) AS first FROM past GROUP BY 1)
    ORDER BY first LIMIT 40) chosen USING (document_id)"""
SAMPLE = f"""{ENTRIES}, {ONLY_FIELDS},
  {_versions_joined(SAMPLE_LAWS, with_summary=False)}, r AS ({_outcomes('w', NO_PAGE)})"""


def _report(mode: str, run_id: str, source: str, new: str, document: str) -> str:
    """Counts of a run; ``source`` has kind, reason, summary and date as given."""
    return f"""SELECT '{run_id}' AS runId, '{mode}' AS mode, count(*) AS fetched,
      count(*) FILTER (WHERE {document}) AS extracted,
      count(*) FILTER (WHERE {document} AND summary <> '') AS enriched,
      count(*) FILTER (WHERE {document} AND {new}) AS newDocuments,
      count(*) FILTER (WHERE {document} AND NOT {new}) AS updatedDocuments,
      count(*) FILTER (WHERE NOT {document}) AS errors"""


def _reason_list(source: str) -> str:
    return f"""(SELECT coalesce(string_agg(reason || ':' || n, ',' ORDER BY n DESC, reason), '')
      FROM (SELECT reason, count(*) AS n FROM {source} WHERE kind <> 'document' GROUP BY reason))
      AS topErrorReasons"""


ONLY_LINES = f"""c AS (
  SELECT CASE WHEN k % 10 IN (3, 4, 6) THEN 'parse_error' WHEN k % 10 IN (0, 1) THEN 'error'
              WHEN k % 10 = 2 AND st = 'F' THEN 'error' ELSE 'document' END AS kind,
    CASE WHEN k % 10 NOT IN (3, 4, 6) THEN 'order-' || k END AS document_id,
    CASE WHEN k % 10 = 0 THEN 'http_error_permanent' WHEN k % 10 = 1 THEN 'http_error_transient'
         WHEN k % 10 = 2 AND st = 'F' THEN 'abrogated'
         WHEN k % 10 IN (3, 4, 6) THEN 'parse_error' END AS reason,
    CASE WHEN k % 10 IN (0, 1) OR (k % 10 = 2 AND st = 'F') THEN 'm' END AS message,
    CASE WHEN k % 10 = 2 AND st <> 'F' THEN 's' WHEN k % 10 = 7 THEN ''
         WHEN k % 10 = 9 THEN 'Satz ' || k || '.' END AS summary,
    CASE WHEN k % 10 IN (7, 8, 9) OR (k % 10 = 2 AND st <> 'F')
         THEN strftime(d, {ISO}) END AS entry_into_force_date
  FROM o WHERE k % 10 <> 5)"""
LINES = f"{O}, {ONLY_LINES}"

FAULT_CASES = " ".join(f"WHEN {form} THEN '{code}'" for form, code in raw.FAULTS.items())
BAD = "[" + ", ".join(f"'{d}'" for d in raw.BAD_DATES) + "]"
BROKEN = "(n = 4 AND form IN (11, 12, 16))"
DOCS = f"""{O}, b AS (
  SELECT *, CAST((k // 2) % 6 AS INT) AS n, (k // 12) % 24 AS form FROM o), q AS (
  SELECT 'file-' || n AS file, k AS pos,
    CASE WHEN {BROKEN} THEN '?' WHEN n = 4 AND form = 3 THEN ''
         WHEN n = 3 THEN 'doc-' || (k // 2) ELSE 'doc-' || k END AS document_id,
    CASE WHEN n = 4 THEN CASE form {FAULT_CASES} END END AS violation,
    {BROKEN} OR (n IN (1, 5) AND k % 3 = 2) AS no_title,
    CASE WHEN n IN (2, 5) AND k % 3 = 1 THEN CAST((k // 16) % 4 AS INT) END AS bad
  FROM b)"""

LAW_TITLE = r"(?i)<h1[^>]*>([\s\S]*?)</h1>"


def _stripped(text: str) -> str:
    bare = f"regexp_replace({text}, '<[^>]+>', '', 'g')"
    return f"trim(regexp_replace({bare}, '{WS}+', ' ', 'g'))"


TITLE_CAPTURE = f"regexp_extract(html, '{LAW_TITLE}', 1)"
TITLE_TEXT = f"nullif({_stripped(TITLE_CAPTURE)}, '')"
ARTICLE_TEXT = _stripped(r"regexp_extract(html, '(?i)<article[^>]*>([\s\S]*?)</article>', 1)")

PICK_ELI = "[" + ", ".join(_literal(v) for v in raw.ELI_KEYS) + "]"
PICK_JURISDICTION = "[" + ", ".join(_literal(v) for v in raw.JURISDICTION_KEYS) + "]"
POLICY = f"p(key, src, gen, target) AS (VALUES {_values(K.pairs(K.LANGUAGE_POLICY))})"
POLICY_COLUMNS = """coalesce(src, 'en') AS source_text_language,
  coalesce(gen, 'en') AS generation_language, coalesce(target, 'de') AS translation_target,
  coalesce(gen, 'en') AS content_language, coalesce(gen, 'en') AS pair_source,
  coalesce(target, 'de') AS pair_target"""
KEYS = f"""j AS (SELECT c_custkey,
  {PICK_JURISDICTION}[CAST(c_custkey % {len(raw.JURISDICTION_KEYS)} AS INT) + 1] AS jurisdiction
  FROM customer)"""

RELATIONS = """rel AS (
  SELECT 'order-' || l_orderkey AS source_document_id,
    'part-' || l_partkey AS target_document_id,
    CASE l_returnflag WHEN 'A' THEN 'amends' WHEN 'N' THEN 'repeals' ELSE 'replaces' END
      AS relation_type,
    CASE WHEN l_linestatus = 'O' THEN 'Art. ' || l_linenumber END AS subdivision_concerned,
    CASE WHEN l_linestatus = 'O' AND l_suppkey % 2 = 0 THEN 'Ersetzung' END AS comment,
    l_linestatus <> 'O' AS whole_document
  FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders))"""

INSTRUCTION = K.SYSTEM_INSTRUCTION.replace("'", "''")

BACKFILL_REPORT = f"""WITH {BACKFILL_LOGGED}
        {_report('backfill', 'backfill_1', 'z', 'true', "kind = 'document'")},
          {_reason_list('z')}"""
RUN_COUNTS = """(SELECT count(*) FROM past) AS entries, count(*) AS remaining, CAST(0 AS BIGINT) AS skipped"""
PASSING = "file NOT IN (SELECT file FROM q WHERE violation IS NOT NULL)"

CHECKS: dict[str, str] = {
    "sitemap_count": f"""
        SELECT c_custkey AS site, CASE WHEN c_custkey % 9 = 0 OR c_custkey % 60 = 0
          THEN {K.DEFAULT_SITEMAPS} ELSE CAST(c_custkey % 60 AS INT) END AS sitemaps FROM customer""",
    "sitemap_locations": f"""WITH {ENTRIES}, others AS (
          SELECT k AS page, unnest([2, CASE WHEN k % 4 <> 0 THEN 4 END,
                 CASE WHEN k % 3 <> 0 THEN 5 END]) AS pos, k, d FROM o)
        SELECT page, pos, url AS loc, lastmod FROM e
        UNION ALL SELECT page, pos, '{raw.HOST}/' || k || '/aktuelles/' AS loc,
          CASE WHEN pos <> 4 THEN {STAMP} END AS lastmod FROM others WHERE pos IS NOT NULL""",
    "sitemap_entries": f"WITH {ENTRIES} SELECT page, pos, {VERSION} FROM e",
    "current_versions": f"WITH {ENTRIES} {_latest('past', f'page, pos, {VERSION}')}",
    "ranked_versions": f"""WITH {ENTRIES} SELECT document_id, CAST(rn AS INT) AS version_rank,
          url, entry_date FROM (SELECT *, row_number() OVER (PARTITION BY document_id
            ORDER BY entry_date DESC, page, pos) AS rn FROM past) WHERE rn <= 3""",
    "resume_remaining": f"""WITH {ENTRIES}, l AS ({_latest('past', VERSION)})
        SELECT {VERSION} FROM l WHERE NOT EXISTS (SELECT 1 FROM customer
          WHERE c_mktsegment = 'BUILDING' AND 'law-' || c_custkey = l.document_id)""",
    "changed_since": f"WITH {ENTRIES}, {CHANGED} {_latest('changed', VERSION)}",
    "changed_since_latest_first": f"""WITH {ENTRIES}, l AS ({_latest('past', VERSION)})
        SELECT document_id, url, substr(lastmod, 1, 10) AS lastmod, doc_type, date_str, entry_date
        FROM l WHERE substr(lastmod, 1, 10) >= {CUTOFF}""",
    "first_seen_order": f"""WITH {ENTRIES}, l AS ({_latest('past')})
        SELECT document_id, url, first // 10 AS first_page, CAST(first % 10 AS INT) AS first_pos
        FROM l JOIN (SELECT document_id, min(page * 10 + pos) AS first FROM past GROUP BY 1)
          USING (document_id)""",
    "first_n_laws": f"""WITH {ENTRIES}, l AS ({_latest('past')})
        SELECT document_id, url, entry_date FROM l
        JOIN (SELECT document_id, min(page * 10 + pos) AS first FROM past GROUP BY 1)
          USING (document_id) ORDER BY first LIMIT 25""",
    "version_history": f"""WITH {ENTRIES}, single AS (
          SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY document_id, entry_date
            ORDER BY page, pos) AS rn FROM past) WHERE rn = 1)
        SELECT document_id, entry_date AS valid_from, lead(entry_date) OVER (
            PARTITION BY document_id ORDER BY entry_date) AS valid_to, url,
          'consolidated_act' AS entity_type FROM single""",
    "observed_counts": f"""WITH {ENTRIES} SELECT 'entries' AS stage, count(*) AS n FROM past
        UNION ALL SELECT 'laws' AS stage, count(DISTINCT document_id) AS n FROM past""",
    "page_titles": f"""SELECT page_id, {TITLE_TEXT} AS title FROM pages""",
    "page_texts": f"""SELECT page_id, body_text, substr(body_text, 1, 2500) AS text_content
        FROM (SELECT page_id, {ARTICLE_TEXT} AS body_text FROM pages)""",
    "page_fields": f"""SELECT page_id, url, html LIKE '%class="%aufgehoben%"%' AS abrogated,
          {TITLE_TEXT} AS title,
          CAST(NULL AS VARCHAR) AS abbreviation, CAST(NULL AS VARCHAR) AS enactment_date,
          CAST(NULL AS VARCHAR) AS last_amendment_date, CAST(NULL AS VARCHAR) AS publication_date,
          {ARTICLE_TEXT} AS text_content FROM pages""",
    "law_fields": f"""WITH {FIELDS} SELECT document_id, doc_type, url, entry_date,
          CASE WHEN has_page THEN st = 'F' END AS abrogated, {MASKED}, legal_type FROM f""",
    "abrogated_split": f"""WITH {O} SELECT 'order-' || k AS document_id,
          st = 'F' AND pr <> '5-LOW' AS abrogated FROM o""",
    "legal_types": """SELECT o_orderkey AS k, CASE WHEN o_orderpriority LIKE '2%' THEN 'regulation'
          WHEN o_orderpriority LIKE '3%' THEN 'announcement' ELSE 'law' END AS legal_type
        FROM orders""",
    "fetch_outcomes": f"WITH {ATTEMPTS} SELECT * FROM fetched",
    "enrichable_laws": f"""WITH {EXTRACTED} SELECT document_id, title, text_content FROM x
        WHERE error_type IS NULL AND st <> 'F' AND text_content <> ''""",
    "summary_requests": f"""WITH {EXTRACTED}, r AS (
          SELECT document_id, 'Titel: ' || coalesce(title, 'Kein Titel') || chr(10) || chr(10)
            || 'Text:' || chr(10) || substr(text_content, 1, {K.TEXT_CHARS}) AS prompt
          FROM x WHERE error_type IS NULL AND st <> 'F' AND text_content <> '')
        SELECT document_id, prompt,
          '{{"system_instruction":{{"parts":[{{"text":"{INSTRUCTION}"}}]}},"contents":[{{"parts":'
          || '[{{"text":' || CAST(to_json(prompt) AS VARCHAR)
          || '}}]}}],"generationConfig":{{"maxOutputTokens":2500,"temperature":0.1}}}}' AS request
        FROM r""",
    "summary_texts": f"WITH {_summaries('order-')} SELECT document_id, summary FROM s",
    "enriched_documents": f"""WITH {EXTRACTED}, {_summaries('order-')},
        y AS (SELECT x.*, summary FROM x LEFT JOIN s USING (document_id))
        {_outcomes('y', 'message')}""",
    "merged_outcomes": f"""WITH {EXTRACTED}, {ONLY_LINES},
        m AS (
          SELECT CASE WHEN error_type IS NULL AND st <> 'F' THEN 'document' ELSE 'error' END AS kind,
            document_id, CASE WHEN error_type = 'permanent' THEN 'http_error_permanent'
              WHEN error_type IS NOT NULL THEN 'http_error_transient'
              WHEN st = 'F' THEN 'abrogated' END AS reason, CAST(NULL AS VARCHAR) AS summary, 0 AS src
          FROM x UNION ALL SELECT kind, document_id, reason, summary, 1 AS src FROM c)
        SELECT kind, document_id, reason, summary FROM (
          SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY kind, summary IS NULL,
            CASE WHEN kind = 'error' THEN reason END DESC) AS rn
          FROM m WHERE document_id IS NOT NULL) WHERE rn = 1
        UNION ALL SELECT kind, document_id, reason, summary FROM m WHERE document_id IS NULL""",
    "backfill_outcomes": f"WITH {BACKFILL} SELECT * FROM r",
    "backfill_requests": f"""WITH {ENTRIES}, {ONLY_FIELDS}, v AS ({_latest('past')})
        SELECT v.document_id, 'Titel: ' || coalesce(title, 'Kein Titel') || chr(10) || chr(10)
          || 'Text:' || chr(10) || substr(text_content, 1, {K.TEXT_CHARS}) AS prompt
        FROM v JOIN f ON v.url = f.url WHERE has_page AND st <> 'F' AND text_content <> ''""",
    "ingested_pages": f"""WITH {FIELDS} SELECT url, CASE WHEN has_page THEN st = 'F' END AS abrogated,
          {MASKED} FROM f""",
    "backfill_run": f"{BACKFILL_REPORT}, {RUN_COUNTS} FROM z",
    "resumed_run": f"{BACKFILL_REPORT}, count(*) AS stored_rows FROM z",
    "empty_daily_run": f"""SELECT 'daily_1' AS runId, 'daily' AS mode, 0::BIGINT AS fetched,
          0::BIGINT AS extracted, 0::BIGINT AS enriched, 0::BIGINT AS newDocuments,
          0::BIGINT AS updatedDocuments, 0::BIGINT AS errors,
          '' AS topErrorReasons, '{TODAY}' AS checkpoint, 0 AS documents""",
    "run_quorum": f"""WITH q AS (SELECT count(*) AS total, count(*) FILTER (
            WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')) AS failed FROM orders)
        SELECT *, failed * 2 <= total AS reached, failed * 2 > total AS stopped,
          '{LAST_RUN}' AS checkpoint FROM q""",
    "checkpoint_latest": "SELECT strftime(max(o_orderdate), '%Y-%m') AS last_run FROM orders",
    "daily_run": f"""WITH {DAILY}, z AS (SELECT kind, reason, act_summary AS summary,
          act_entry_into_force_date >= '{LAST_RUN}' AS is_new FROM r)
        {_report('daily', 'daily_1', 'z', 'is_new', "kind = 'document'")},
          {_reason_list('z')},
          CASE WHEN count(*) FILTER (WHERE kind <> 'document') * 2 < count(*) OR count(*) = 0
            THEN '{TODAY}' ELSE '{LAST_RUN}' END AS checkpoint,
          CAST(count(*) FILTER (WHERE kind <> 'document') * 10 > count(*) AS INT) AS alerts,
          {RUN_COUNTS} FROM z""",
    "sample_outcomes": f"WITH {SAMPLE} SELECT * FROM r",
    "accumulator_outcomes": f"WITH {LINES} SELECT * FROM c",
    "run_report": f"""WITH {LINES}
        {_report('daily', 'daily_1', 'c', f"entry_into_force_date >= '{LAST_RUN}'",
                 "kind = 'document'")},
          count(*) FILTER (WHERE reason = 'abrogated') AS abrogated FROM c""",
    "nested_run_report": f"""WITH {LINES}
        {_report('backfill', 'backfill_1', 'c', 'true', "kind = 'document'")},
          {_reason_list('c')} FROM c""",
    "error_reasons": f"""WITH {LINES} SELECT reason, count(*) AS count FROM c
        WHERE kind <> 'document' GROUP BY reason""",
    "new_vs_updated": f"""WITH {LINES} SELECT
          count(*) FILTER (WHERE entry_into_force_date >= '{LAST_RUN}') AS newDocuments,
          count(*) FILTER (WHERE entry_into_force_date < '{LAST_RUN}') AS updatedDocuments FROM c""",
    "alerts": f"""WITH {O}, m AS (
          SELECT 'run_' || strftime(d, '%Y-%m') AS runId, count(*) AS fetched,
            count(*) FILTER (WHERE st = 'F' AND pr IN ('1-URGENT', '2-HIGH')) AS errors
          FROM o GROUP BY 1)
        SELECT 'high_error_rate' AS alert, runId, errors, fetched,
          tenths // 10 || '.' || tenths % 10 || '%' AS error_rate
        FROM (SELECT *, (2000 * errors + fetched) // (2 * fetched) AS tenths FROM m)
        WHERE errors * 10 > fetched""",
    "guarded_commit": f"""WITH {O}, m AS (
          SELECT 'run_' || strftime(d, '%Y-%m') AS runId, count(*) AS fetched,
            count(*) FILTER (WHERE st = 'F' OR pr = '1-URGENT') AS errors FROM o GROUP BY 1)
        SELECT runId, '{TODAY}' AS lastRun FROM m WHERE errors * 2 < fetched""",
    "source_quorum": """SELECT count(*) AS total, count(*) FILTER (WHERE o_orderstatus = 'F')
          AS failed, count(*) FILTER (WHERE o_orderstatus = 'F') * 2 <= count(*) AS reached
        FROM orders""",
    "processed_ids": f"""WITH {LINES} SELECT DISTINCT document_id FROM c
        WHERE document_id IS NOT NULL AND coalesce(reason, '') <> 'http_error_transient'""",
    "schema_violations": f"""WITH {DOCS} SELECT file, pos, violation FROM q
        WHERE violation IS NOT NULL""",
    "date_violations": f"""WITH {DOCS} SELECT file, pos, document_id,
          'enactment_date' AS field, {BAD}[bad + 1] AS value,
          ['calendar', 'year_range', 'format', 'year_range'][bad + 1] AS reason
        FROM q WHERE bad IS NOT NULL AND {PASSING}""",
    "title_warnings": f"WITH {DOCS} SELECT file, pos, document_id FROM q WHERE no_title AND {PASSING}",
    "duplicate_ids": f"""WITH {DOCS} SELECT file, document_id, count(*) AS copies FROM q
        WHERE {PASSING} GROUP BY 1, 2 HAVING count(*) > 1""",
    "file_verdicts": f"""WITH {DOCS}, c AS (
          SELECT file, count(*) AS documents, count(violation) AS schema_errors,
            count(bad) AS date_errors, count(*) FILTER (WHERE no_title) AS title_warnings
          FROM q GROUP BY file),
        u AS (SELECT file, count(*) AS duplicates FROM (SELECT file, document_id FROM q
          GROUP BY 1, 2 HAVING count(*) > 1) GROUP BY file)
        SELECT file, documents, schema_errors, coalesce(duplicates, 0) AS duplicates,
          date_errors, title_warnings,
          CASE WHEN schema_errors > 0 THEN 'FAIL schema'
               WHEN duplicates > 0 THEN 'FAIL duplicates'
               WHEN date_errors > 0 THEN 'FAIL quality'
               WHEN title_warnings > 0 THEN 'WARN' ELSE 'OK' END AS verdict
        FROM c LEFT JOIN u USING (file)""",
    "report_verdicts": """SELECT 'run_report_' || c_custkey || '.json' AS file,
          CASE c_custkey % 6 WHEN 1 THEN 'mode,topErrorReasons' WHEN 2 THEN 'errors,topErrorReasons'
            WHEN 5 THEN 'enriched,errors,extracted,fetched,mode,newDocuments,runId,topErrorReasons,updatedDocuments'
            ELSE '' END AS missing,
          CASE WHEN c_custkey % 6 IN (1, 2, 5) THEN 'FAIL missing keys'
               WHEN c_custkey % 6 IN (3, 4) THEN 'FAIL errors type' ELSE 'OK' END AS verdict
        FROM customer""",
    "overall_verdict": f"""WITH {DOCS} SELECT count(violation) = 0 AND count(bad) = 0
          AND count(*) = count(DISTINCT file || document_id)
          AND (SELECT count(*) FROM customer WHERE c_custkey % 6 <> 0) = 0 AS passed FROM q""",
    "act_type_from_eli": f"""WITH m(key, act) AS (VALUES {_values(K.pairs(K.ELI_TYPES))}),
        i AS (SELECT p_partkey, {PICK_ELI}[CAST(p_partkey % {len(raw.ELI_KEYS)} AS INT) + 1]
          AS eli_type FROM part)
        SELECT p_partkey, eli_type, CASE WHEN eli_type <> '' THEN coalesce(act, 'other') END
          AS act_type FROM i LEFT JOIN m ON lower(trim(eli_type)) = key""",
    "jurisdiction_languages": f"""WITH {POLICY}, {KEYS} SELECT c_custkey, jurisdiction,
          {POLICY_COLUMNS} FROM j LEFT JOIN p ON lower(trim(jurisdiction)) = key""",
    "jurisdiction_list_languages": f"""WITH {POLICY}, {KEYS} SELECT c_custkey, {POLICY_COLUMNS}
        FROM j LEFT JOIN p ON c_custkey % 10 <> 0 AND lower(trim(jurisdiction)) = key""",
    "jurisdiction_membership": f"""WITH {KEYS}, v(slug) AS (VALUES {_values([(s,) for s in K.JURISDICTIONS])})
        SELECT c_custkey, slug IS NOT NULL AS allowed FROM j LEFT JOIN v ON jurisdiction = slug""",
    "translation_pairs": """SELECT doc_id, CASE WHEN lang = 'de' THEN 'de' ELSE 'en' END AS pair_source,
          CASE WHEN lang = 'de' THEN 'en' ELSE 'de' END AS pair_target FROM documents""",
    "publication_lookup": f"""WITH {FIELDS}, g AS (
          SELECT DISTINCT year(d) AS year, month(d) AS number,
            strftime(date_trunc('month', d)::DATE + 40, {ISO}) AS issue_date
          FROM o WHERE month(d) <> 12)
        SELECT document_id, CASE WHEN has_page THEN coalesce(publication_date, issue_date) END
          AS publication_date FROM f LEFT JOIN g ON issue_year = year AND issue_number = number""",
    "upsert_snapshot": """SELECT 'law-' || c_custkey AS document_id,
          CASE WHEN c_acctbal < 0 THEN upper(c_name) ELSE c_name END AS title,
          CASE WHEN c_acctbal < 0 THEN 2 ELSE 1 END AS version FROM customer
        UNION ALL SELECT 'new-' || s_suppkey, s_name, 2 FROM supplier""",
    "relations_flat": f"WITH {RELATIONS} SELECT * FROM rel",
    "nested_documents": f"""WITH {RELATIONS}, n AS (
          SELECT source_document_id, count(*) AS c FROM rel GROUP BY 1)
        SELECT 'order-' || o_orderkey AS document_id, coalesce(c, 0) AS relation_rows
        FROM orders LEFT JOIN n ON 'order-' || o_orderkey = source_document_id""",
    "act_table": f"""WITH {O} SELECT 'order-' || k AS document_id, 'de_nw' AS jurisdiction,
          'legal_act' AS entity_type, true AS is_in_force, {_url('d', 't', SLASH)} AS canonical_source_url,
          CAST(NULL AS VARCHAR) AS fallback_text_url, 'law' AS type,
          strftime(d, {ISO}) AS entry_into_force_date, CAST(NULL AS VARCHAR) AS enactment_date,
          CAST(NULL AS VARCHAR) AS last_amendment_date, CAST(NULL AS VARCHAR) AS validity_date,
          CAST(NULL AS VARCHAR) AS publication_date FROM o""",
    "act_text_table": f"""WITH {O} SELECT 'order-' || k AS document_id, 'de' AS language,
          {_url('d', 't', SLASH)} AS url, 'Gesetz ' || k AS title,
          CASE WHEN k % 2 = 0 THEN 'G' || k END AS title_short, CAST(NULL AS VARCHAR) AS summary,
          CASE WHEN k % 2 = 0 THEN 'G' || k END AS abbreviation FROM o""",
    "stream_ingest_pages": f"""SELECT page_id,
          {TITLE_TEXT} AS title,
          {ARTICLE_TEXT} AS text_content, false AS abrogated FROM pages""",
    "stream_outcomes": f"""WITH {FIELDS}, y AS (
          SELECT *, CASE WHEN NOT has_page THEN 'transient' END AS error_type,
            CAST(NULL AS VARCHAR) AS summary FROM f)
        {_outcomes('y', NO_PAGE)}""",
    "stream_rejected": """SELECT 0::BIGINT AS published, count(*) FILTER (WHERE o_orderpriority <= '3-MEDIUM') * 2
          >= count(*) AS stopped FROM orders""",
    "stored_pages": f"WITH {FIELDS} SELECT document_id, url, has_page FROM f",
    "stored_documents": f"WITH {FIELDS} SELECT document_id, url FROM f",
    "stored_reports": f"""WITH {LINES}, n AS (SELECT count(*) FILTER (WHERE kind = 'document') AS docs,
          count(*) FILTER (WHERE entry_into_force_date >= '{LAST_RUN}') AS recent,
          count(*) FILTER (WHERE kind <> 'document') AS errors FROM c)
        SELECT 'run_report_a' AS file, 'a' AS runId, 'backfill' AS mode, docs AS newDocuments, errors,
          'OK' AS verdict FROM n
        UNION ALL SELECT 'run_report_b', 'b', 'daily', recent, errors, 'OK' FROM n""",
    "stored_processed": "SELECT DISTINCT 'law-' || (c_custkey // 2) AS document_id FROM customer",
    "stream_dedup_events": "SELECT event_id, user_id, event_type FROM events",
    "stream_daily_error_rate": f"""SELECT strftime(ts, {ISO}) AS day, count(*) AS fetched,
          count(*) FILTER (WHERE event_type = 'error') AS errors,
          count(*) FILTER (WHERE event_type = 'error') * 5 > count(*) AS alert
        FROM events GROUP BY 1""",
    "stream_latest": f"""SELECT document_id, entry_date, page FROM (
          SELECT 'law-' || o_custkey AS document_id, strftime(o_orderdate, {ISO}) AS entry_date,
            o_orderkey AS page, row_number() OVER (PARTITION BY o_custkey
              ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1""",
}
