"""WARC derivatives: a metadata and a plain-text conversion record for each response.

Both carry WARC-Refers-To with the response's identifier; the metadata record also names the
conversion, and keeps the source's own headers and digests. Identifiers are name-based
(from the source's identifier), so a run that is repeated writes the same records. Digests are
labelled SHA-256 in hex. All of it is DataFrame expressions, without a shuffle; only
WARC files are read by Arrow.

Plain text: scripts, styles and comments go, block tags are line ends, other tags go, the
entities of ENTITIES are resolved, and white space is folded. A null url or page is empty.
Rows that repeat a page (identifier, address and text) are one record, and give the same identifiers. A script, style or
comment that is never closed goes up to the text's end. ``read_responses`` takes responses from WARC files, with the headers,
dates and digests that they have there; pages that come without any (``responses``) get a stated date and header.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DATE = "2024-01-01T00:00:00Z"
KIND = "text/html; charset=utf-8"

#: Tags that end a line, and entities with what they stand for, in the order in which they are resolved
#: (before the last come numbered ones).
BLOCKS = "address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figure|footer|form|h1|h2|h3|h4|h5|h6|head|header|hr|html|li|main|nav|ol|option|p|pre|section|table|td|th|title|tr|ul"
ENTITIES = [
    *[("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&copy;", "\u00a9"), ("&reg;", "\u00ae"), ("&middot;", "\u00b7"), ("&deg;", "\u00b0")],
    *[("&laquo;", "\u00ab"), ("&raquo;", "\u00bb"), ("&ndash;", "\u2013"), ("&mdash;", "\u2014"), ("&lsquo;", "\u2018"), ("&rsquo;", "\u2019"), ("&ldquo;", "\u201c"), ("&rdquo;", "\u201d")],
    *[("&bull;", "\u2022"), ("&hellip;", "\u2026"), ("&euro;", "\u20ac"), ("&pound;", "\u00a3"), ("&sect;", "\u00a7"), ("&times;", "\u00d7"), ("&trade;", "\u2122"), ("&#38;", "&amp;")],
    ("&amp;", "&"),
]
#: Numbered entities, without the halves of pairs that are no characters.
NUMBERED = "&#(0*(?:[1-9]|[1-9][0-9]{1,3}|[1-4][0-9]{4}|5[0-4][0-9]{3}|57[4-9][0-9]{2}|5[89][0-9]{3}|[6-9][0-9]{4}|[1-9][0-9]{5}));"

#: Patterns and what replaces them, in order; both Java and RE2 read them alike.
STEPS = [
    ("(?is)<(?:script\\b.*?(?:</script[ \\t\\r\\n]*>|\\z)|style\\b.*?(?:</style[ \\t\\r\\n]*>|\\z)|!--.*?(?:-->|\\z))", ""),
    (f"(?is)</?(?:{BLOCKS})\\b[^>]*>", "\n"),
    ("</?[A-Za-z!][^>]*>", ""),
]
FOLDS = [("[ \\t\\r\\f]{2,}|[\\t\\r\\f]", " "), (" ?\\n[ \\n]+| \\n", "\n")]


def plain_text(html: Column) -> Column:
    for pattern, to in STEPS:
        html = F.regexp_replace(html, F.lit(pattern), F.lit(to))
    return _folded(_resolved(html))


#: Bound to a name by a lambda, as it is looked at and worked on: else it would be made for each.
_bound = lambda c, f: F.transform(F.array(c), f)[0]


def _resolved(text: Column) -> Column:
    """Entities as characters; a text without any isn't looked at again."""
    known = F.create_map(*[F.lit(x) for entity, to in ENTITIES[:-1] for x in (entity[1:], to)])

    def named(part: Column, at: Column) -> Column:
        """What begins with an &, which no entity has but as its first character: so all of them are resolved in one pass."""
        end = F.instr(part, ";")
        found = F.concat(F.try_element_at(known, F.substring(part, F.lit(1), end)), F.substring(part, end + 1, F.octet_length(part)))
        return F.when(at == 0, part).otherwise(F.coalesce(found, F.concat(F.lit("&"), part)))

    def put(upto: Column, number: Column) -> Column:
        return F.replace(upto, F.concat(F.lit("&#"), number, F.lit(";")), F.decode(F.unhex(F.lpad(F.hex(number.cast("long")), 8, "0")), "UTF-32"))

    def resolved(x: Column) -> Column:
        first = F.array_join(F.transform(F.split(x, "&"), named), "")
        numbers = _bound(first, lambda x: F.when(x.contains("&#"), F.aggregate(F.array_distinct(F.regexp_extract_all(x, F.lit(NUMBERED), 1)), x, put)).otherwise(x))
        return F.replace(numbers, F.lit(ENTITIES[-1][0]), F.lit(ENTITIES[-1][1]))

    return _bound(text, lambda x: F.when(x.contains("&"), resolved(x)).otherwise(x))


def _folded(text: Column) -> Column:
    """What FOLDS make of a text without white space at its ends: by lines, and only a text that has any inside a line is searched for it."""
    lines = F.filter(F.transform(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(" \t\r\f"))), lambda x: x != "")
    inside = lambda x: x.contains("  ") | x.contains("\t") | x.contains("\r") | x.contains("\f")
    return _bound(F.array_join(lines, "\n"), lambda x: F.when(inside(x), F.regexp_replace(x, F.lit(FOLDS[0][0]), F.lit(FOLDS[0][1]))).otherwise(x))


def urn(name: Column) -> Column:
    """A name-based record identifier."""
    h = F.md5(name)
    return F.concat(F.lit("<urn:uuid:"), *[x for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)) for x in (F.substring(h, a, n), F.lit("-" if a < 21 else ">"))])


def labelled(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text, 256))


def responses(pages: DataFrame, date: str = DATE) -> DataFrame:
    """Response records of rows (page_id, url, html): record_id, target_uri, date, http_header, payload."""
    html, url = F.coalesce(F.col("html").cast("string"), F.lit("")), F.coalesce(F.col("url").cast("string"), F.lit(""))
    header = F.concat(F.lit(f"HTTP/1.1 200 OK\r\nContent-Type: {KIND}\r\nContent-Length: "), F.octet_length(html).cast("string"), F.lit("\r\n\r\n"))
    name = F.concat(F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit("\n"), url, F.lit("\n"), html)
    return pages.select("page_id", urn(name).alias("record_id"), url.alias("target_uri"), F.lit(date).alias("date"), header.alias("http_header"), html.alias("payload"))


#: What a record's header says by name, as columns.
FIELDS = {"record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI", "date": "WARC-Date", "stated_digest": "WARC-Payload-Digest"}
_BREAK, _NEXT = b"\r\n\r\n", b"\r\n\r\nWARC/1."
RECORD = pa.schema([*((c, pa.string()) for c in (*FIELDS, "http_header", "payload", "source_block_digest", "source_payload_digest")), ("source_length", pa.int64()), ("is_whole", pa.bool_())])
#: Bytes of blocks that go on to Spark at once, and that are unpacked at once.
ROWS_BYTES, UNPACKED = 8 << 20, 1 << 20


class _Bytes:
    """A file's bytes from front to back, unpacked as they are needed if it is compressed, member after member."""

    def __init__(self, content: pa.Buffer) -> None:
        self.left, self.held, self.packed = memoryview(content), bytearray(), content[:2].to_pybytes() == b"\x1f\x8b"
        self.member = None

    def more(self) -> bool:
        if not len(self.left):
            return False
        if not self.packed:
            self.held += self.left[:UNPACKED]
            self.left = self.left[UNPACKED:]
            return True
        self.member = self.member or zlib.decompressobj(31)
        taken = self.left[:UNPACKED]
        try:
            self.held += self.member.decompress(taken, UNPACKED)
        except zlib.error:  # a damaged member ends what can be read
            self.left = self.left[:0]
            return False
        rest = self.member.unused_data if self.member.eof else self.member.unconsumed_tail
        self.left = self.left[len(taken) - len(rest) :]
        if self.member.eof:
            self.member = None
        return True

    def upto(self, n: int) -> bool:
        """Whether there are so many bytes."""
        while len(self.held) < n and self.more():
            pass
        return len(self.held) >= n

    def find(self, mark: bytes, start: int = 0) -> int:
        """Where a mark is, or -1."""
        at = max(0, start)
        while (i := self.held.find(mark, at)) < 0:
            at = max(at, len(self.held) - len(mark) + 1)
            if not self.more():
                return -1
        return i

    def drop(self, n: int) -> None:
        del self.held[:n]


def _records(content: pa.Buffer) -> Iterator[tuple[bytes, bytes, bool]]:
    """(header, block, is_whole) of a file's records. A block has the length that its header states, whatever stands in it. Where no record's
    end follows that, or no length is stated, the block goes up to the next record's beginning, or the file's end, and isn't whole."""
    data = _Bytes(content)
    while True:
        start = data.find(b"WARC/1.")
        if start < 0:
            return
        data.drop(start)
        end = data.find(_BREAK)
        if end < 0:
            return
        header, first = bytes(data.held[:end]), end + 4
        stated = re.search(rb"(?im)^content-length:[ \t]*(\d+)[ \t]*\r?$", header)
        last = first + int(stated[1]) if stated else -1
        whole = last >= 0 and data.upto(last)
        # After a block come two line ends, then the next record or the file's end.
        if whole and data.upto(last + len(_NEXT)):
            whole = data.held[last : last + len(_NEXT)] == _NEXT
        elif whole:
            whole = data.held[last:].strip(b"\r\n") == b""
        if not whole:
            following = data.find(_NEXT, first - 4)
            while data.upto(len(data.held) + 1) and following < 0:
                pass
            last = following if following >= first else len(data.held) if following < 0 else first
        block = bytes(data.held[first:last])
        yield header, block if whole or data.held[last:] else block.removesuffix(_BREAK), whole
        data.drop(last)


def _decoded(payload: bytes, http: bytes) -> str:
    """By the character set that the HTTP header names, else UTF-8; bytes that it doesn't have are replaced."""
    named = re.search(rb"(?im)^content-type:[^\r\n]*charset=[\"']?([A-Za-z0-9_.:-]+)", http)
    try:
        return payload.decode(named[1].decode() if named else "utf-8", "replace")
    except LookupError:
        return payload.decode("utf-8", "replace")


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """Response records of WARC files: record_id, target_uri, date, stated_digest, http_header, payload, is_whole, and of the bytes as
    they are source_block_digest, source_payload_digest and source_length.

    A file is a task's row (so of 2 GB at most), read record by record from its bytes, compressed or not. A block ends where its header's
    Content-Length says, so what stands in a page begins no record; is_whole is false where that can't be. ``payload`` is text, by the character
    set of its HTTP header; digests are of the bytes.
    """
    files = spark.read.format("binaryFile").load(path).select("content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                for header, block, whole in _records(batch["content"][i].as_buffer()):
                    field = lambda name, header=header: (m[1].strip().decode("utf-8", "replace") if (m := re.search(rb"(?im)^" + name.encode() + rb":[ \t]*([^\r\n]*)", header)) else "")
                    if field("WARC-Type").lower() != "response":
                        continue
                    cut = block.find(_BREAK)
                    http, payload = (block[: cut + 4], block[cut + 4 :]) if cut >= 0 else (b"", block)
                    digests = [f"sha256:{hashlib.sha256(x).hexdigest()}" for x in (block, payload)]
                    rows.append((*map(field, FIELDS.values()), http.decode("utf-8", "replace"), _decoded(payload, http), *digests, len(block), whole))
                    held += len(block)
                    if held >= ROWS_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), RECORD.types, strict=True)], schema=RECORD)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), RECORD.types, strict=True)], schema=RECORD)

    kinds = {pa.string(): "string", pa.int64(): "long", pa.bool_(): "boolean"}
    return files.mapInArrow(run, ", ".join(f"{f.name} {kinds[f.type]}" for f in RECORD))


def derivatives(source: DataFrame) -> DataFrame:
    """Two rows for each response record; its other columns stay.

    warc_type, record_id, refers_to, header (of the WARC record), block, block_digest, content_length.
    The whole record is header, block and two line ends. Digests and length of the source are those of its bytes where it has them
    (read_responses()), else of its text; a digest that the source states itself is kept beside them.
    """
    whole = F.concat("http_header", "payload")
    of_source = lambda name, made: F.col(name) if name in source.columns and "is_whole" in source.columns else made
    source = source.withColumn("text", plain_text(F.col("payload"))).withColumn("conversion_id", urn(F.concat("record_id", F.lit("#conversion"))))
    title = F.regexp_replace(F.regexp_extract("payload", "(?is)<title[^>]*>([^<]*)</title", 1), F.lit("[ \\t\\r\\n]+"), F.lit(" "))
    fields = F.concat(
        *[F.lit("conversion: "), F.col("conversion_id")],
        *[F.lit("\r\nsource-block-digest: "), of_source("source_block_digest", labelled(whole))],
        *[F.lit("\r\nsource-payload-digest: "), of_source("source_payload_digest", labelled(F.col("payload")))],
        *[F.lit("\r\nsource-length: "), of_source("source_length", F.octet_length(whole)).cast("string")],
        *([F.when(F.col("stated_digest") != "", F.concat(F.lit("\r\nsource-warc-payload-digest: "), F.col("stated_digest"))).otherwise("")] if "stated_digest" in source.columns else []),
        *[F.lit("\r\nlanguage: "), F.regexp_extract("payload", '(?is)<html[^>]* lang="([A-Za-z-]*)"', 1)],
        *[F.lit("\r\ntitle: "), title],
        # The source's headers, one field a line, each under a name of its own.
        *[F.lit("\r\nsource-http: "), F.replace(F.regexp_replace("http_header", F.lit("\\r\\n\\r\\n$"), F.lit("")), F.lit("\r\n"), F.lit("\r\nsource-http: "))],
        F.lit("\r\n"),
    )
    made = source.withColumn(
        "made",
        F.array(
            F.struct(F.lit("metadata").alias("warc_type"), urn(F.concat("record_id", F.lit("#metadata"))).alias("record_id"), F.lit("application/warc-fields").alias("kind"), fields.alias("block")),
            F.struct(F.lit("conversion").alias("warc_type"), F.col("conversion_id").alias("record_id"), F.lit("text/plain; charset=utf-8").alias("kind"), F.col("text").alias("block")),
        ),
    )
    # Outer, though no array is empty: else the optimizer filters by the array's size and makes it twice.
    rest = [c for c in source.columns if c not in {"record_id", "http_header", "payload", "text", "conversion_id"}]
    rows = made.select(*rest, F.col("record_id").alias("refers_to"), F.explode_outer("made").alias("m")).select(*rest, "refers_to", "m.*")
    rows = rows.withColumns({"block_digest": labelled(F.col("block")), "content_length": F.octet_length("block").cast("long")})
    header = F.concat(
        *[F.lit("WARC/1.1\r\nWARC-Type: "), F.col("warc_type")],
        *[F.lit("\r\nWARC-Record-ID: "), F.col("record_id")],
        *[F.lit("\r\nWARC-Refers-To: "), F.col("refers_to")],
        *[F.lit("\r\nWARC-Target-URI: "), F.col("target_uri")],
        *[F.lit("\r\nWARC-Date: "), F.col("date")],
        *[F.lit("\r\nWARC-Block-Digest: "), F.col("block_digest")],
        *[F.lit("\r\nContent-Type: "), F.col("kind")],
        *[F.lit("\r\nContent-Length: "), F.col("content_length").cast("string")],
        F.lit("\r\n\r\n"),
    )
    return rows.withColumn("header", header).drop("kind")


def warc_text(records: DataFrame) -> DataFrame:
    """Each record as it stands in a WARC file (column ``value``), to be written with an empty line separator."""
    return records.select(F.concat("header", "block", F.lit("\r\n\r\n")).alias("value"))


def op4_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = derivatives(responses(spark.read.parquet(f"{sf_dir}/pages.parquet")))
    return made.select("page_id", "warc_type", "record_id", "refers_to", "target_uri", "header", "block", "block_digest", "content_length")


def _sql() -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    raw = lambda x: quoted(x).replace("\n", "' || chr(10) || '").replace("\r", "' || chr(13) || '")
    text = "html"
    for pattern, to in STEPS:
        text = f"regexp_replace({text}, {quoted(pattern)}, {raw(to)}, 'g')"
    for entity, to in ENTITIES[:-1]:
        text = f"replace({text}, {quoted(entity)}, {quoted(to)})"
    text = f"list_reduce(list_prepend({text}, list_distinct(regexp_extract_all({text}, {quoted(NUMBERED)}, 1))), lambda a, x: replace(a, '&#' || x || ';', chr(x::INTEGER)))"
    text = f"replace({text}, {quoted(ENTITIES[-1][0])}, {quoted(ENTITIES[-1][1])})"
    for pattern, to in FOLDS:
        text = f"regexp_replace({text}, {quoted(pattern)}, {raw(to)}, 'g')"
    text = f"trim({text}, ' ' || chr(10))"
    urn_ = lambda x: f"'<urn:uuid:' || regexp_replace(md5({x}), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})', '\\1-\\2-\\3-\\4-') || '>'"
    end = "chr(13) || chr(10)"
    return f"""
WITH p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages),
r AS (
  SELECT *, {urn_("coalesce(page_id::VARCHAR, '') || chr(10) || url || chr(10) || html")} AS id,
         'HTTP/1.1 200 OK' || {end} || 'Content-Type: {KIND}' || {end} || 'Content-Length: ' || strlen(html) AS http,
         {text} AS txt
  FROM p),
s AS (SELECT *, {urn_("id || '#conversion'")} AS conv, http || {end} || {end} || html AS whole FROM r),
b AS (
  SELECT page_id, id, url, 'conversion' AS warc_type, conv AS record_id, 'text/plain; charset=utf-8' AS kind, txt AS block FROM s
  UNION ALL
  SELECT page_id, id, url, 'metadata', {urn_("id || '#metadata'")}, 'application/warc-fields',
         'conversion: ' || conv || {end} || 'source-block-digest: sha256:' || sha256(whole) || {end}
         || 'source-payload-digest: sha256:' || sha256(html) || {end} || 'source-length: ' || strlen(whole) || {end}
         || 'language: ' || regexp_extract(html, '(?is)<html[^>]* lang="([A-Za-z-]*)"', 1) || {end}
         || 'title: ' || regexp_replace(regexp_extract(html, '(?is)<title[^>]*>([^<]*)</title', 1), '[ \\t\\r\\n]+', ' ', 'g') || {end}
         || 'source-http: ' || replace(http, {end}, {end} || 'source-http: ') || {end}
  FROM s),
d AS (SELECT *, 'sha256:' || sha256(block) AS block_digest, CAST(strlen(block) AS BIGINT) AS content_length FROM b)
SELECT page_id, warc_type, record_id, id AS refers_to, url AS target_uri,
       'WARC/1.1' || {end} || 'WARC-Type: ' || warc_type || {end} || 'WARC-Record-ID: ' || record_id || {end}
       || 'WARC-Refers-To: ' || id || {end} || 'WARC-Target-URI: ' || url || {end} || 'WARC-Date: {DATE}' || {end}
       || 'WARC-Block-Digest: ' || block_digest || {end} || 'Content-Type: ' || kind || {end}
       || 'Content-Length: ' || content_length || {end} || {end} AS header,
       block, block_digest, content_length
FROM d
"""


OP4_SQL = _sql()
