"""Fixed values of the exchange format. Every value here is part of the data contract."""

# --- fixed values: document types in the page address, and their act type -------------
DOC_TYPES = """
gesetz            law
rechtsverordnung  regulation
bekanntmachung    announcement
"""
DEFAULT_LEGAL_TYPE = "law"

# --- fixed values: act types allowed in a document -----------------------------------
ACT_TYPES = """
regulation directive decision law declaration recommendation treaty commission_proposal
announcement statute administrative_regulation other
""".split()

# --- fixed values: entity types allowed in a document --------------------------------
ENTITY_TYPES = ["legal_act", "consolidated_act"]

# --- fixed values: ELI type to act type ----------------------------------------------
ELI_TYPES = """
reg        regulation
reg_impl   regulation
reg_del    regulation
dir        directive
dir_impl   directive
dir_del    directive
dec        decision
dec_impl   decision
dec_del    decision
joint_dec  decision
reco       recommendation
opin       recommendation
treaty     treaty
res        other
bdg        other
other      other
"""
DEFAULT_ACT_TYPE = "other"

# --- fixed values: jurisdictions allowed in a document -------------------------------
JURISDICTIONS = """
de fr it es nl be at pl cz hu ro se dk ie gb ch no tr us ca mx br cn in jp kr vn eu
de_norms de_bw de_by de_be de_bb de_hb de_hh de_he de_mv de_ni de_nw de_rp de_sl de_sn
de_st de_sh de_th other
""".split()

# --- fixed values: jurisdiction, source text, generation and translation language ----
LANGUAGE_POLICY = """
de        de  de  en
at        de  de  en
ch        de  de  en
be        fr  de  en
ie        en  en  de
nl        nl  de  en
norms     de  de  en
de_norms  de  de  en
other     de  de  en
de_bw     de  de  en
de_by     de  de  en
de_be     de  de  en
de_bb     de  de  en
de_hb     de  de  en
de_hh     de  de  en
de_he     de  de  en
de_mv     de  de  en
de_ni     de  de  en
de_nw     de  de  en
de_rp     de  de  en
de_sl     de  de  en
de_sn     de  de  en
de_st     de  de  en
de_sh     de  de  en
de_th     de  de  en
eu        en  en  de
it        it  en  de
es        es  en  de
gb        en  en  de
us        en  en  de
"""
DEFAULT_LANGUAGES = ("en", "en", "de")

# --- fixed values: constants of a built document -------------------------------------
JURISDICTION = "de_nw"
ENTITY_TYPE = "legal_act"
LANGUAGE = "de"

# --- fixed values: sitemaps and fetching ---------------------------------------------
DEFAULT_SITEMAPS = 47
LATE_BUFFER_DAYS = 2
MAX_ATTEMPTS = 3
QUORUM_MAX_FAILED = 0.5
ALERT_ERROR_RATE = 0.1
COMMIT_ERROR_RATE = 0.5

# --- fixed values: error reasons -----------------------------------------------------
ABROGATED = "abrogated"
PERMANENT = "http_error_permanent"
TRANSIENT = "http_error_transient"
PARSE_ERROR = "parse_error"

# --- fixed values: date checks -------------------------------------------------------
DATE_FIELDS = [
    "enactment_date",
    "entry_into_force_date",
    "last_amendment_date",
    "publication_date",
    "validity_date",
]
YEAR_RANGE = (1800, 2100)

# --- fixed values: keys of a run report ----------------------------------------------
REPORT_KEYS = """
runId mode fetched extracted enriched newDocuments updatedDocuments errors topErrorReasons
""".split()

# --- fixed values: summary request ---------------------------------------------------
TEXT_CHARS = 2500
PROMPT_TEXT_CHARS = 3000
NO_TITLE = "Kein Titel"
NO_TEXT = "Kein Text vorhanden"
MAX_OUTPUT_TOKENS = 2500
TEMPERATURE = 0.1
SYSTEM_INSTRUCTION = (
    "Du bist ein juristischer Assistent zur Datenextraktion."
    " Fasse den Text in GENAU 3 vollständigen, inhaltlich dichten Sätzen zusammen."
    " Satz 1: Was wird geregelt (Gegenstand und Zweck)?"
    " Satz 2: Für wen gilt es (Beteiligte, Adressaten, Geltungsbereich)?"
    " Satz 3: Welche konkreten Rechtsfolgen oder Maßnahmen werden festgelegt?"
    " Jeder Satz muss mindestens 20 Wörter lang sein."
    " Antworte AUSSCHLIESSLICH mit dem unformatierten, reinen Text der Zusammenfassung."
    " Verwende KEIN JSON, KEIN Markdown und KEINE Einleitungsfloskeln."
)

# --- fixed values: text patterns -----------------------------------------------------
# White space is the class of the source's text rules: it has NBSP and the byte order mark,
# which a plain \s in Java leaves out. The far characters stand behind one range test, so
# that ordinary text is tested quickly. Letters outside ASCII are listed in both cases,
# since (?i) folds ASCII only. (?s) with a dot is many times faster in Java than [\s\S].
WS_CODES = (
    [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0xA0, 0x1680]
    + list(range(0x2000, 0x200B))
    + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF]
)
WS_CHARS = "".join(map(chr, WS_CODES))
_FAR = (
    r"[\x{1680}-\x{feff}&&"
    r"[\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]]"
)
WS = rf"[\t\n\x0b\f\r \xa0{_FAR}]"
# every run of white space except a single blank; one class test per ordinary character
WS_RUN = rf"{WS}(?:(?<! ){WS}*|{WS}+)"
DATE = r"([0-9]{2}\.[0-9]{2}\.[0-9]{4})"
# up to the first end tag, bracket by bracket
URL_BLOCK = r"<url>([^<]*(?:<(?!/url>)[^<]*)*+)</url>"
LOC = r"<loc>([^<]+)</loc>"
LASTMOD = r"<lastmod>([^<]+)</lastmod>"
LAW_PATH = "/lrgv/"
LAW_URL = r"/lrgv/[^/]+/[0-9]{8}-[^/]+/?\z"
TAG = r"<[^>]++>"
TITLE = r"(?is)<h1[^>]*>(.*?)</h1>"
ABBREVIATION_LIST = (
    rf"(?i)<dt[^>]*>{WS}*Abk.rzung{WS}*</dt>{WS}*<dd[^>]*>([^<]{{1,60}})</dd>"
)
ABBREVIATION_TEXT = r"(?i)Abk.rzung[^<]*<[^>]+>([A-ZÄÖÜäöü][^<]{1,50})<"
ENACTMENT_LIST = rf"(?i)<dt[^>]*>{WS}*Ausfertigungsdatum{WS}*</dt>{WS}*<dd[^>]*>{WS}*{DATE}"
ENACTMENT_TEXT = rf"(?is)Ausfertigungsdatum.{{0,200}}?{DATE}"
AMENDMENT_PHRASE = rf"(?is)zuletzt{WS}+ge[äÄa]ndert.{{0,300}}?{DATE}"
AMENDMENT_HEADING = rf"(?is)letzte{WS}+[Ää]nderung.{{0,200}}?{DATE}"
PUBLICATION = rf"(?is)Fundstelle.{{0,300}}?{DATE}"
ABROGATED_MARKER = "aufgehoben"
# up to the first end tag; possessive, so that text without a bracket is passed in one go
MAIN = r"(?i)<main[^>]*>([^<]*+(?:<(?!/main>)[^<]*+)*+)</main>"
ARTICLE = r"(?i)<article[^>]*>([^<]*+(?:<(?!/article>)[^<]*+)*+)</article>"
ISSUE = r"GV\. NRW\. ([0-9]{4}) (Nr\.|S\.) ([0-9]+)"
MARKED_CLASS = r'(?i)<[^>]+class="[^"]*{}[^"]*"[^>]*>'
ISO_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
SUMMARY_PATH = "$.candidates[0].content.parts[0].text"


def pairs(table: str) -> list[tuple[str, ...]]:
    """Rows of a text table."""
    return [tuple(line.split()) for line in table.strip().splitlines()]
