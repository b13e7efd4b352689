"""Raw inputs derived from the given tables: one row in, one raw text out, no shuffle.

Each builder writes typed columns into XML, HTML or JSON text. The operators then read the
text, while the SQL checks compute from the typed columns and never see it.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill import constants as K
from lexmill.functions.documents import build_legal_act

TODAY = "2000-06-30"
LAST_RUN = "2000-04-01"
HOST = "https://portal.example"
ROWS_PER_TASK = 250_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_columns(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Narrow typed columns of a given table, dealt to all cores, a bounded number of rows a task.

    The builders below make large texts of a few bytes, and a given table may be one small file.
    """
    narrow = table(spark, sf_dir, name).select(*columns)
    cores = spark.sparkContext.defaultParallelism
    rounds = -(-narrow.count() // (ROWS_PER_TASK * cores))  # counted in the footers
    return narrow.repartition(max(rounds, 1) * cores)


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given web pages, as the scan splits them."""
    return table(spark, sf_dir, "pages").select("page_id", "url", "html")


def text(*parts) -> Column:
    """Concatenation of columns and plain strings."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def german(date: Column) -> Column:
    return F.date_format(date, "dd.MM.yyyy")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with short names: ``k, cust, day, status, priority, doc_type``."""
    return short_orders(spread_columns(
        spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus",
        "o_orderpriority",
    ))


def short_orders(frame: DataFrame) -> DataFrame:
    first = F.substring("o_orderpriority", 1, 1)
    return frame.select(
        F.col("o_orderkey").alias("k"),
        F.col("o_custkey").alias("cust"),
        F.col("o_orderdate").cast("date").alias("day"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.when(first == "1", "gesetz")
        .when(first == "2", "rechtsverordnung")
        .when(first == "3", "bekanntmachung")
        .otherwise("satzung")
        .alias("doc_type"),
    )


def law_url(day: Column, doc_type: Column, slash: Column) -> Column:
    return text(
        f"{HOST}/", F.col("k"), "/lrgv/", doc_type, "/", F.date_format(day, "ddMMyyyy"),
        "-law-", F.col("cust"), slash,
    )


def order_url() -> Column:
    """Address of an order's law version; every second one ends with a slash."""
    slash = F.when(F.col("k") % 2 == 0, "/").otherwise("")
    return law_url(F.col("day"), F.col("doc_type"), slash)


def sitemap_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sitemap page of six blocks per order: ``page, xml``.

    0 the version; 1 no location; 2 no law; 3 a version far in the future; 4 an older one
    without lastmod (every fourth order); 5 the same slug and date again under another type
    (every third order). Blocks an order does not have are addresses outside the law path.
    """
    day, none = F.col("day"), F.lit("")
    other = text(f"{HOST}/", F.col("k"), "/aktuelles/")

    def block(loc: Column, lastmod: Column | None = None) -> Column:
        parts = ["<url>\n  <loc> ", loc, " </loc>"]
        if lastmod is not None:
            parts += ["<lastmod>", lastmod, "T06:30:00+02:00</lastmod>"]
        return text(*parts, "</url>\n")

    touched = F.date_format(F.date_add(day, 30), "yyyy-MM-dd")
    xml = text(
        '<?xml version="1.0"?><urlset>',
        block(order_url(), touched),
        text("<url><lastmod>", touched, "</lastmod></url>"),
        block(other, touched),
        block(law_url(F.lit("2999-12-31").cast("date"), F.col("doc_type"), none), touched),
        block(
            F.when(
                F.col("k") % 4 == 0, law_url(F.date_sub(day, 365), F.col("doc_type"), none)
            ).otherwise(other)
        ),
        block(
            F.when(F.col("k") % 3 == 0, law_url(day, F.lit("bekanntmachung"), none))
            .otherwise(other),
            touched,
        ),
        "</urlset>",
    )
    return orders(spark, sf_dir).select(F.col("k").alias("page"), xml.alias("xml"))


def failing_sitemap_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sitemap pages, those of most orders without content: they could not be loaded."""
    failed = orders(spark, sf_dir).where(F.col("priority").isin("1-URGENT", "2-HIGH", "3-MEDIUM"))
    pages_ = sitemap_pages(spark, sf_dir).join(failed.select(F.col("k").alias("page"), F.lit(True).alias("_gone")), "page", "left")
    return pages_.select("page", F.when(F.col("_gone").isNull(), F.col("xml")).alias("xml"))


def sitemap_indexes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index per customer that lists ``c_custkey % 60`` sitemaps; each ninth is missing."""
    index = text(
        "<sitemapindex>",
        F.expr("repeat('<sitemap><loc>x</loc></sitemap>', int(c_custkey % 60))"),
        "</sitemapindex>",
    )
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("site"),
        F.when(F.col("c_custkey") % 9 != 0, index).alias("index_xml"),
    )


def law_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A law page per order."""
    return law_pages_of(orders(spark, sf_dir))


def law_pages_of(short: DataFrame) -> DataFrame:
    """Law pages of short orders: ``document_id, doc_type, url, entry_date, html``.

    ``k % 5`` picks how the fields stand in the page: 0 list form, 1 text form, 2 not at
    all, 3 list form in capitals, 4 present but out of the patterns' reach.
    """
    k, day = F.col("k"), F.col("day")
    form = k % 5
    later, printed = german(F.date_add(day, 100)), german(F.date_add(day, 10))

    def listed(abbr: str, enacted: str, amended: str, source: str) -> Column:
        return text(
            f"<dl><dt> {abbr} </dt>\n<dd> G", k, f" </dd><dt>{enacted}</dt><dd> ", german(day),
            f"</dd></dl><p>{amended}\u00a0durch Gesetz vom ", later,
            f"</p><p>{source}: Blatt vom ", printed, "</p>",
        )

    fields = (
        F.when(
            form == 0, listed("Abkürzung", "Ausfertigungsdatum", "zuletzt geändert", "Fundstelle")
        )
        .when(
            form == 1,
            text(
                "<p>Abkürzung: <b>G", k, "</b></p><p>Ausfertigungsdatum ist der ", german(day),
                "</p><p>Letzte Änderung: ", later, "</p><p>Blatt: GV. NRW. ", F.year(day),
                F.when(k % 2 == 0, text(" Nr. ", F.month(day)))
                .otherwise(text(" S. ", F.month(day) * 10 + k % 10)), "</p>",
            ),
        )
        .when(
            form == 3, listed("ABKÜRZUNG", "AUSFERTIGUNGSDATUM", "ZULETZT GEÄNDERT", "FUNDSTELLE")
        )
        .when(
            form == 4,
            text(
                "<dl><dt>Abkürzung</dt><dd>", F.lit("X" * 61),
                "</dd><dt>Ausfertigungsdatum</dt><dd></dd></dl><p>zuletzt geändert ",
                F.lit("y" * 310), " ", later, "</p>",
            ),
        )
        .otherwise("")
    )
    title = (
        F.when(k % 11 == 0, "")
        .when(k % 13 == 0, "<h1> \n</h1>")
        .otherwise(
            text('<H1 class="t">\n Gesetz&nbsp;', k, " \n <b>zu\u00a0Nr. ", F.col("cust"), "</b></H1>")
        )
    )
    words = F.expr("repeat('Wort ', int(k % 7) * 100)")
    note = F.when(F.col("status") == "P", "aufgehoben ").otherwise("")
    body = text("<p>Absatz ", k, ".</p>\n<p>", note, words, "</p>")
    mark = F.when(F.col("status") == "F", "law Aufgehoben-x").otherwise("law")
    wrapped = (
        F.when(k % 15 == 2, body)
        .when(k % 2 == 0, text("<main>", body, "</main><article>nicht dies</article>"))
        .otherwise(text('<Article id="a">', body, "</Article>"))
    )
    html = text('<html><body class="', mark, '">', title, fields, wrapped, "</body></html>")
    return short.select(
        text("order-", k).alias("document_id"),
        "doc_type",
        order_url().alias("url"),
        F.date_format(day, "yyyy-MM-dd").alias("entry_date"),
        F.when(F.col("priority") != "5-LOW", html).alias("html"),
    )


def fetch_attempts(spark: SparkSession, sf_dir: str, prefix: str = "order-") -> DataFrame:
    """Attempts from lineitem: ``document_id, attempt, status, error``."""
    status = (
        F.when(F.col("l_returnflag") == "A", 503)
        .when(F.col("l_returnflag") == "N", 200)
        .otherwise(404)
    )
    lines = spread_columns(
        spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"
    )
    return lines.select(
        text(prefix, F.col("l_orderkey")).alias("document_id"),
        F.col("l_linenumber").alias("attempt"),
        F.when(F.col("l_linestatus") == "O", status)
        .otherwise(F.when(status != 503, status))
        .alias("status"),
        F.when(status != 200, text("HTTP ", status)).alias("error"),
    )


def responses(spark: SparkSession, sf_dir: str, prefix: str) -> DataFrame:
    """Model responses from documents: ``document_id, response``.

    Every 7th is blank, every 11th is cut off, every 13th has no candidate, and every 5th
    document has two equal responses.
    """
    doc = F.col("doc_id")
    content = F.when(doc % 7 == 0, F.lit(" \n ")).otherwise(F.col("text"))
    good = F.to_json(
        F.struct(
            F.array(
                F.struct(
                    F.struct(F.array(F.struct(content.alias("text"))).alias("parts")).alias(
                        "content"
                    )
                )
            ).alias("candidates")
        )
    )
    response = (
        F.when(doc % 11 == 0, F.expr("substring(_good, 1, length(_good) - 3)"))
        .when(doc % 13 == 0, '{"candidates":[]}')
        .otherwise(F.col("_good"))
    )
    copies = F.when(doc % 5 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (
        table(spark, sf_dir, "documents")
        .select("doc_id", good.alias("_good"))
        .select(text(prefix, doc).alias("document_id"), response.alias("response"),
                F.explode(copies).alias("copy"))
        .drop("copy")
    )


def accumulator_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accumulator lines from orders: documents, errors, broken, odd and blank lines."""
    k = F.col("k")
    form = k % 10

    def error(reason: str) -> Column:
        return text('{"_error":true,"documentId":"order-', k, f'","reason":"{reason}","message":"m"}}')

    def document(summary: Column) -> Column:
        return text(
            ' {"legal_act":{"document_id":"order-', k, '","summary":', summary,
            ',"is_in_force":true,"entry_into_force_date":"', F.date_format("day", "yyyy-MM-dd"),
            '"},"legal_act_relations":[]}',
        )

    line = (
        F.when(form == 0, error(K.PERMANENT))
        .when(form == 1, error(K.TRANSIENT))
        .when(form == 2, F.when(F.col("status") == "F", error(K.ABROGATED))
              .otherwise(document(F.lit('"s"'))))
        .when(form == 3, text('{"legal_act":{"document_id":"order-', k))
        .when(form == 4, "null")
        .when(form == 5, " \u00a0\t")
        .when(form == 6, "123")
        .when(form == 7, document(F.lit('""')))
        .when(form == 8, document(F.lit("null")))
        .otherwise(document(text('"Satz ', k, '."')))
    )
    return orders(spark, sf_dir).select(line.alias("value"))


def monthly_reports(spark: SparkSession, sf_dir: str, failed: Column) -> DataFrame:
    """A small report per month of orders: ``runId, fetched, errors``."""
    return (
        orders(spark, sf_dir)
        .groupBy(text("run_", F.date_format("day", "yyyy-MM")).alias("runId"))
        .agg(F.count(F.lit(1)).alias("fetched"), F.count_if(failed).alias("errors"))
    )


# --- documents with faults -----------------------------------------------------------

# form ((k div 12) % 24) of a document in file 4, and the one violation it carries
FAULTS = {
    0: "legal_act.title: type",
    1: "legal_act.colour: unknown",
    2: "legal_act.type: enum",
    3: "legal_act.document_id: minLength",
    4: "legal_act.jurisdiction: required",
    5: "legal_act_relations: type",
    6: "legal_act.is_in_force: type",
    7: "legal_act_relations[0].target_document_id: required",
    8: "legal_act_relations[0].concerned_sections[1].page: unknown",
    9: "extra: unknown",
    10: "legal_act.jurisdiction: enum",
    11: "legal_act: required",
    12: "document: type",
    13: "legal_act_relations[0].relation_type: minLength",
    14: "legal_act_relations[0].concerned_sections: type",
    15: "legal_act.entity_type: enum",
    16: "legal_act: type",
    17: "legal_act_relations[0].concerned_sections[0].subdivision_concerned: required",
}
BAD_DATES = ["2020-02-31", "1799-12-31", "2020-2-3", "0000-00-00"]


def raw_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON documents with faults, from orders: ``file, root_ok, pos, raw``.

    File ``(k div 2) % 6``: 0 clean, 1 missing titles, 2 wrong dates, 3 repeated ids, 4
    contract faults, 5 wrong dates and missing titles.
    """
    k = F.col("k")
    number = F.expr("int((k div 2) % 6)")
    form = F.expr("(k div 12) % 24")

    def on(*forms: int) -> Column:
        return (number == 4) & form.isin(*forms)

    identity = F.when(number == 3, F.expr("k div 2")).otherwise(k)
    bad = F.element_at(
        F.array(*[F.lit(d) for d in BAD_DATES]), (F.expr("k div 16") % 4 + 1).cast("int")
    )
    dated = number.isin(2, 5) & (k % 3 == 1)
    title = (
        F.when(on(0), "17")
        .when(number.isin(1, 5) & (k % 3 == 2), "null")
        .otherwise(text('"Gesetz ', k, '"'))
    )
    act = text(
        '{"document_id":"', F.when(on(3), "").otherwise(text("doc-", identity)), '"',
        F.when(on(4), "").when(on(10), ',"jurisdiction":"xx"').otherwise(',"jurisdiction":"de_nw"'),
        ',"title":', title,
        ',"is_in_force":', F.when(on(6), "null").otherwise("true"),
        ',"type":', F.when(on(2), '"poem"').otherwise('"law"'),
        F.when(on(1), ',"colour":"red"').otherwise(""),
        F.when(on(15), ',"entity_type":"x"').otherwise(""),
        ',"summary":null,"enactment_date":"',
        F.when(dated, bad).otherwise(F.date_format("day", "yyyy-MM-dd")), '"}',
    )
    good = '{"source_document_id":"a","target_document_id":"b","relation_type":"amends"}'
    relations = (
        F.when(on(5), '"none"')
        .when(on(7), '[{"source_document_id":"a","relation_type":"amends"}]')
        .when(
            on(8),
            '[{"source_document_id":"a","target_document_id":"b","relation_type":"amends",'
            '"concerned_sections":[{"subdivision_concerned":"1"},'
            '{"subdivision_concerned":"2","page":3}]}]',
        )
        .when(on(13), '[{"source_document_id":"a","target_document_id":"b","relation_type":""}]')
        .when(
            on(14),
            '[{"source_document_id":"a","target_document_id":"b","relation_type":"r",'
            '"concerned_sections":"all"}]',
        )
        .when(
            on(17),
            '[{"source_document_id":"a","target_document_id":"b","relation_type":"r",'
            '"concerned_sections":[{"comment":null}]}]',
        )
        .when(k % 5 == 0, "null")
        .when(k % 5 == 1, f"[{good}]")
        .otherwise("[]")
    )
    raw = F.when(on(12), "[1]").otherwise(
        text(
            "{",
            F.when(on(11), "").when(on(16), '"legal_act":"x",')
            .otherwise(text('"legal_act":', act, ",")),
            F.when(on(9), '"extra":1,').otherwise(""),
            '"legal_act_relations":', relations, "}",
        )
    )
    return orders(spark, sf_dir).select(
        text("file-", number).alias("file"),
        F.lit(True).alias("root_ok"),
        k.alias("pos"),
        raw.alias("raw"),
    )


def raw_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run reports as JSON, from customers: ``file, raw``; some lack keys or miscount."""
    k = F.col("c_custkey")
    form = k % 6
    raw = text(
        '{"runId":"r', k, '"', F.when(form == 1, "").otherwise(',"mode":"daily"'),
        ',"fetched":1,"extracted":1,"enriched":0,"newDocuments":1,"updatedDocuments":0',
        F.when(form == 2, "").when(form == 3, ',"errors":true').when(form == 4, ',"errors":"1"')
        .otherwise(',"errors":0'),
        F.when(form.isin(1, 2), "").otherwise(',"topErrorReasons":[]'), "}",
    )
    return table(spark, sf_dir, "customer").select(
        text("run_report_", k, ".json").alias("file"),
        F.when(form == 5, "broken").otherwise(raw).alias("raw"),
    )


# --- lookup keys ---------------------------------------------------------------------


def _pick(values: list[str | None], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


ELI_KEYS = [key for key, _ in K.pairs(K.ELI_TYPES)] + [" REG ", "DIR_IMPL", "unknown", "", None, " "]
JURISDICTION_KEYS = K.JURISDICTIONS + ["norms", " DE ", "Be", "xx", "", None]


def eli_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey", _pick(ELI_KEYS, F.col("p_partkey") % len(ELI_KEYS)).alias("eli_type")
    )


def jurisdiction_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = _pick(JURISDICTION_KEYS, F.col("c_custkey") % len(JURISDICTION_KEYS))
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        key.alias("jurisdiction"),
        F.when(F.col("c_custkey") % 10 == 0, F.array().cast("array<string>"))
        .otherwise(F.array(key, F.lit("us")))
        .alias("jurisdiction_list"),
    )


# --- relations -----------------------------------------------------------------------


def order_acts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Acts from orders, with ``legal_act``."""
    none = F.lit(None).cast("string")
    columns = orders(spark, sf_dir).select(
        text("order-", F.col("k")).alias("document_id"),
        order_url().alias("url"),
        text("Gesetz ", F.col("k")).alias("title"),
        F.when(F.col("k") % 2 == 0, text("G", F.col("k"))).otherwise("").alias("abbreviation"),
        F.lit("law").alias("legal_type"),
        F.date_format("day", "yyyy-MM-dd").alias("entry_date"),
        none.alias("summary"),
        none.alias("enactment_date"),
        none.alias("last_amendment_date"),
        none.alias("publication_date"),
    )
    return columns.select(build_legal_act().alias("legal_act"))


def relation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat relations from lineitem, in the form of ``flatten_relations``."""
    has_section = F.col("l_linestatus") == "O"
    lines = spread_columns(
        spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        "l_returnflag", "l_linestatus",
    )
    return lines.select(
        text("order-", F.col("l_orderkey")).alias("source_document_id"),
        text("part-", F.col("l_partkey")).alias("target_document_id"),
        F.when(F.col("l_returnflag") == "A", "amends")
        .when(F.col("l_returnflag") == "N", "repeals")
        .otherwise("replaces")
        .alias("relation_type"),
        F.when(has_section, text("Art. ", F.col("l_linenumber"))).alias("subdivision_concerned"),
        F.when(has_section & (F.col("l_suppkey") % 2 == 0), "Ersetzung").alias("comment"),
        (~has_section).alias("whole_document"),
    )


def gazette_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issues of the months in which anything was ordered; an issue has ten pages."""
    month = F.trunc("day", "month")
    return (
        orders(spark, sf_dir)
        .where(F.month("day") != 12)
        .select(F.year("day").alias("year"), F.month("day").alias("number"),
                (F.month("day") * 10).alias("first_page"), (F.month("day") * 10 + 9).alias("last_page"),
                F.date_format(F.date_add(month, 40), "yyyy-MM-dd").alias("issue_date"))
        .distinct()
    )
