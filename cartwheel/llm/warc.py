"""Operator 6, derivative records of a web archive: every response becomes a
metadata record and a plain-text conversion record that refer to it and to each
other, with the source's headers and digests kept.

Records are rows; ``write_records`` stores them as archive files and
``read_records`` reads such files (UTF-8 content) back.  All of it is column
expressions.

Defined cases: a null payload counts as empty; a payload that isn't HTML or
text has a metadata record only; a null url gives an empty target; repeated
rows give records with the same identifiers; an empty table gives no records;
other columns are ignored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.common import table
from cartwheel.llm.registry import query

CRLF = "\r\n"
VERSION = "WARC/1.1"
CRAWL_DATE = "2024-01-01T00:00:00Z"

# fixed values: elements that end a line of text, elements without text, named references
LINE_TAGS = ("address article aside blockquote br dd div dl dt figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav "
             "ol p pre section table td th tr ul title")
DROPPED = ("script", "style", "noscript", "template")
REFERENCES = (("&nbsp;", " "), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"), ("&copy;", "©"), ("&middot;", "·"),
              ("&mdash;", "—"), ("&ndash;", "–"), ("&hellip;", "…"), ("&euro;", "€"), ("&lt;", "<"), ("&gt;", ">"),
              ("&amp;", "&"))


def record_id(*parts: Column) -> Column:
    """A stable identifier in the form of a uuid."""
    h = F.md5(F.concat_ws("|", *parts))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text, 256))


def responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              date: str = CRAWL_DATE) -> DataFrame:
    """Response rows of fetched pages: source_id, record_id, target_uri, date, http, payload, payload_digest."""
    payload, url = F.coalesce(F.col(html_col), F.lit("")), F.coalesce(F.col(url_col), F.lit(""))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.octet_length(payload))
    return pages.select(F.col(id_col).alias("source_id"), record_id(F.lit("response"), F.coalesce(F.col(id_col).cast("string"), F.lit("")), url).alias("record_id"),
                        url.alias("target_uri"), F.lit(date).alias("date"), http.alias("http"), payload.alias("payload"),
                        digest(payload).alias("payload_digest"))


def _references(t: Column) -> Column:
    """Named references decoded in one pass over the pieces between ampersands."""
    def piece(x):
        known = F.when(F.lit(False), x)
        for name, char in REFERENCES:
            known = known.when(x.startswith(name[1:]), F.concat(F.lit(char), F.substring(x, len(name), 1 << 30)))
        return known.otherwise(F.concat(F.lit("&"), x))

    pieces = F.split(t, "&")
    return F.array_join(F.transform(pieces, lambda x, i: F.when(i == 0, x).otherwise(piece(x))), "")


def plain_text(page: Column) -> Column:
    """The page's text, a line per block-level element; references are left as they are."""
    # one pass from left to right: a comment or a tag inside a dropped element opens nothing
    t = F.regexp_replace(page, rf"(?is)<!--.*?(?:-->|\z)|<({'|'.join(DROPPED)})\b.*?(?:</\1\s*>|\z)", " ")
    t = F.regexp_replace(t, r"[\x20\t\r\n\f]{2,}|[\t\r\n\f]", " ")  # lone blanks stay as they are
    t = F.regexp_replace(t, rf"(?i)</?(?:{LINE_TAGS.replace(' ', '|')})\b[^>]*>", "\n")
    return F.regexp_replace(t, r"<[A-Za-z/!][^>]*>", "")


def tidy_text(t: Column) -> Column:
    """Blanks joined and lines trimmed, once references are decoded."""
    return F.btrim(F.regexp_replace(F.regexp_replace(t, r"\x20{2,}", " "), r"\x20?\n[\x20\n]*", "\n"), F.lit(" \n"))


def _lines(*fields: tuple[str, Column]) -> Column:
    return F.concat_ws(CRLF, *[F.concat(F.lit(name + ": "), value) for name, value in fields])


def derive(source: DataFrame) -> DataFrame:
    """Metadata and conversion records of response rows: source_id, record_type,
    record_id, refers_to, related_id, target_uri, content_type, content_length,
    block_digest, source_digest, header, block."""
    kind = F.regexp_extract("http", r"(?im)^content-type:[\x20\t]*([^\r\n;]*)", 1)
    textual = (F.lower(kind).startswith("text/")) | F.lower(kind).contains("html")
    of = {k: record_id(F.lit(k), F.col("record_id")) for k in ("metadata", "conversion")}
    title = F.trim(F.regexp_replace(F.regexp_extract("payload", r"(?is)<title[^>]*>(.*?)</title", 1), r"[\x20\t\r\n\f]+", " "))
    links = F.regexp_extract_all("payload", F.lit(r'(?i)<a\b[^>]*\bhref="([^"\r\n]*)"'), 1)
    # what several expressions below read is made once
    t = F.col("_text")
    source = (source.withColumns({"_links": links, "_text": plain_text(F.col("payload"))})
              .withColumn("_text", F.when(t.contains("&"), _references(t)).otherwise(t)).withColumn("_text", tidy_text(t)))
    links = F.col("_links")
    # the source's own headers follow, one field each
    heads = F.regexp_replace(F.regexp_replace("http", r"^[^\r\n]*(?:\r\n)?", ""), r"(?m)^", "http-")
    fields = F.concat(_lines(("status", F.regexp_extract("http", r"^HTTP/[0-9.]+ ([0-9]{3})", 1)), ("title", title),
                             ("outlinks", F.size(links).cast("string"))), F.lit(CRLF),
                      F.concat_ws("", F.transform(links, lambda x: F.concat(F.lit("outlink: "), x, F.lit(CRLF)))), heads)
    made = F.array(
        F.struct(F.lit("metadata").alias("record_type"), of["metadata"].alias("id"), of["conversion"].alias("related"),
                 F.lit("application/warc-fields").alias("content_type"), fields.alias("block"), F.lit(True).alias("there")),
        F.struct(F.lit("conversion").alias("record_type"), of["conversion"].alias("id"), of["metadata"].alias("related"),
                 F.lit("text/plain; charset=utf-8").alias("content_type"), F.col("_text").alias("block"), textual.alias("there")))
    rows = source.select("source_id", F.col("record_id").alias("refers_to"), "target_uri", "date", "payload_digest", textual.alias("both"),
                         F.explode(made).alias("r")).where("r.there")
    rows = rows.select("source_id", "r.record_type", F.col("r.id").alias("record_id"), "refers_to",
                       F.when(F.col("both"), F.col("r.related")).alias("related_id"), "target_uri", "date", "r.content_type",
                       F.octet_length("r.block").cast("long").alias("content_length"), digest(F.col("r.block")).alias("block_digest"),
                       F.col("payload_digest").alias("source_digest"), F.col("r.block").alias("block"))
    header = F.concat_ws(CRLF, F.lit(VERSION), _lines(
        ("WARC-Type", F.col("record_type")), ("WARC-Record-ID", F.col("record_id")), ("WARC-Refers-To", F.col("refers_to")),
        ("WARC-Target-URI", F.col("target_uri")), ("WARC-Date", F.col("date")), ("WARC-Block-Digest", F.col("block_digest")),
        ("WARC-Source-Payload-Digest", F.col("source_digest")), ("Content-Type", F.col("content_type")),
        ("Content-Length", F.col("content_length").cast("string"))))
    return rows.withColumn("header", header).drop("date")


def write_records(records: DataFrame, path: str, **options) -> None:
    """Rows with header and block as archive files, one per partition."""
    records.select(F.concat("header", F.lit(CRLF + CRLF), "block").alias("value")).write.text(path, lineSep=CRLF + CRLF, **options)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Archive files as rows: record_type, record_id, refers_to, target_uri,
    content_type, content_length, block_digest, header, block, intact (length and digest agree)."""
    raw = spark.read.text(path, lineSep=CRLF + CRLF + VERSION + CRLF).select(
        F.regexp_replace("value", rf"^{VERSION}\r\n", "").alias("v"))
    at = F.instr("v", CRLF + CRLF)
    rows = raw.select(F.substring("v", F.lit(1), at - 1).alias("header"), F.encode(F.substring("v", at + 4, F.length("v")), "utf-8").alias("rest"))
    field = lambda name: F.regexp_extract("header", rf"(?im)^{name}: ([^\r\n]*)", 1)
    rows = rows.withColumn("content_length", field("Content-Length").cast("long"))
    rows = rows.withColumn("block", F.decode(F.substring("rest", F.lit(1), F.col("content_length").cast("int")), "utf-8"))
    return rows.select(field("WARC-Type").alias("record_type"), field("WARC-Record-ID").alias("record_id"), field("WARC-Refers-To").alias("refers_to"),
                       field("WARC-Target-URI").alias("target_uri"), field("Content-Type").alias("content_type"), "content_length",
                       field("WARC-Block-Digest").alias("block_digest"), F.concat(F.lit(VERSION + CRLF), "header").alias("header"), "block",
                       ((F.octet_length("block") == F.col("content_length")) & (digest(F.col("block")) == field("WARC-Block-Digest"))).alias("intact"))


_UUID = ("'<urn:uuid:' || substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12) || '>'")


def _sql() -> str:
    dropped = "|".join(["<!--.*?(?:-->|\\z)", *(f"<{tag}\\b.*?(?:</{tag}\\s*>|\\z)" for tag in ("script", "style", "noscript", "template"))])
    t = f"regexp_replace(payload, '(?is){dropped}', ' ', 'g')"
    t = f"regexp_replace({t}, '[\\x20\\t\\r\\n\\f]+', ' ', 'g')"
    t = f"regexp_replace({t}, '(?i)</?(?:{LINE_TAGS.replace(' ', '|')})\\b[^>]*>', chr(10), 'g')"
    t = f"regexp_replace({t}, '<[A-Za-z/!][^>]*>', '', 'g')"
    for name, char in REFERENCES:
        t = f"replace({t}, '{name}', '{char.replace(chr(39), chr(39) * 2)}')"
    t = f"regexp_replace({t}, '\\x20+', ' ', 'g')"
    t = f"regexp_replace(regexp_replace({t}, '\\x20?\\n[\\x20\\n]*', chr(10), 'g'), '^[\\x20\\n]+|[\\x20\\n]+\\z', '', 'g')"
    nl = "chr(13) || chr(10)"
    return f"""
WITH s AS (SELECT page_id, coalesce(url, '') AS target_uri, coalesce(html, '') AS payload,
                  md5('response|' || coalesce(page_id::VARCHAR, '') || '|' || coalesce(url, '')) AS h FROM pages),
r AS (SELECT page_id, target_uri, payload, {_UUID} AS refers_to, 'sha256:' || sha256(payload) AS source_digest,
             regexp_extract_all(payload, '(?i)<a\\b[^>]*\\bhref="([^"\\r\\n]*)"', 1) AS links FROM s),
m AS (SELECT *, 'metadata' AS record_type, 'application/warc-fields' AS content_type,
   'status: 200' || {nl} || 'title: ' || trim(regexp_replace(regexp_extract(payload, '(?is)<title[^>]*>(.*?)</title', 1), '[\\x20\\t\\r\\n\\f]+', ' ', 'g')) || {nl}
   || 'outlinks: ' || len(links) || {nl} || array_to_string(['outlink: ' || x || {nl} for x in links], '')
   || 'http-Content-Type: text/html; charset=utf-8' || {nl} || 'http-Content-Length: ' || strlen(payload) AS block FROM r
  UNION ALL SELECT *, 'conversion', 'text/plain; charset=utf-8', {t} FROM r),
i AS (SELECT *, md5(record_type || '|' || refers_to) AS h, 'sha256:' || sha256(block) AS block_digest, strlen(block) AS content_length FROM m),
j AS (SELECT * EXCLUDE (h), {_UUID} AS record_id, md5(CASE record_type WHEN 'metadata' THEN 'conversion' ELSE 'metadata' END || '|' || refers_to) AS h FROM i)
SELECT page_id, record_type, record_id, refers_to, {_UUID} AS related_id, target_uri, content_type, content_length, block_digest, source_digest,
  'WARC/1.1' || {nl} || 'WARC-Type: ' || record_type || {nl} || 'WARC-Record-ID: ' || record_id || {nl} || 'WARC-Refers-To: ' || refers_to || {nl}
  || 'WARC-Target-URI: ' || target_uri || {nl} || 'WARC-Date: {CRAWL_DATE}' || {nl} || 'WARC-Block-Digest: ' || block_digest || {nl}
  || 'WARC-Source-Payload-Digest: ' || source_digest || {nl} || 'Content-Type: ' || content_type || {nl} || 'Content-Length: ' || content_length AS header,
  block FROM j"""


@query("op6_warc", _sql())
def op6(spark, sf_dir):
    """Metadata and conversion records of all pages."""
    return derive(responses(table(spark, sf_dir, "pages"))).withColumnRenamed("source_id", "page_id")
