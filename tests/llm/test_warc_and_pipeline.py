import gzip
import importlib
import random
import re
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from tests.llm.test_dedup import groups
from tests.test_queries import plain
from tidemill.llm import pivot_simhash as P
from tidemill.llm import warc_derivatives as W
from tidemill.llm.queries import ORACLE_SQL, QUERIES
from tidemill.llm.subsequence_svm import THRESHOLD


@pytest.fixture(scope="module")
def duck(data):
    c = duckdb.connect()
    for p in Path(data).glob("*.parquet"):
        c.sql(f"CREATE VIEW {p.stem} AS FROM '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_against_sql(spark, data, duck, name):
    assert plain(QUERIES[name](spark, data).toArrow()) == plain(duck.sql(ORACLE_SQL[name]).to_arrow_table())


def test_there_is_one_query_for_each():
    names = list(__spark_entry__.queries())
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13
    assert "pipeline" in names and [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "packing"]


def test_records_read_back(spark, data):
    """Each record's header says where it belongs and how long it is."""
    pages = spark.read.parquet(f"{data}/pages.parquet")
    source = {r["page_id"]: r for r in W.responses(pages).collect()}
    out = W.derivatives(W.responses(pages))
    whole = {r["record_id"]: r["value"] for r in out.select("record_id", F.concat("header", "block", F.lit("\r\n\r\n")).alias("value")).collect()}
    assert sorted(whole.values()) == sorted(r["value"] for r in W.warc_text(out).collect())
    for r in out.collect():
        head, _, rest = whole[r["record_id"]].partition("\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.split("\r\n")[1:])
        assert fields["WARC-Refers-To"] == source[r["page_id"]]["record_id"]
        assert rest.encode()[: int(fields["Content-Length"])].decode() == r["block"] and rest[len(r["block"]) :] == "\r\n\r\n"
        if r["warc_type"] == "metadata":
            named = r["block"].split("\r\n")[0].removeprefix("conversion: ")
            assert f"WARC-Record-ID: {named}\r\n" in whole[named] and "source-http: Content-Type: text/html" in r["block"]
    assert len(whole) == 2 * len(source)


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<title>T &amp; U</title><script>var t='</p>';</script><p>a<b>b</b>c<br>d<!-- x\n<p> -->e</p>", "T & U\nabc\nde"),
        ("<P>one</P ><p\nclass='x'>two &lt;b&gt; &amp;lt;", "one\ntwo <b> &lt;"),
        ("a < b and c", "a < b and c"),
        ("", ""),
        ("a<script>never closed", "a"),
        ("a<!-- never closed <p>b", "a"),
        ("&#8212;&#38;#39; &mdash; &copy;&#128512;&#55296;&#0;", "\u2014&#39; \u2014 \u00a9\U0001f600&#55296;&#0;"),
    ],
)
def test_plain_text(spark, html, text):
    assert spark.createDataFrame([(html,)], "h string").select(W.plain_text(F.col("h"))).first()[0] == text


def test_plain_text_in_few_passes(spark):
    """Entities and white space as they are defined, step by step, and not by a pass over the text for each entity."""
    rng = random.Random(3)
    bits = [*(x for x, _ in W.ENTITIES), *"& ; # \t \r \f \n a".split(" "), " ", "  ", "\n ", "lt;", "&#", "&#0038;", "&#65;", "&#128512;", "&hellip", "\u00e9", "\U0001f600", "x y"]
    made = spark.createDataFrame([("".join(rng.choices(bits, k=rng.randrange(30))),) for _ in range(3000)], "h string")
    for row in (out := made.select("h", W.plain_text(F.col("h")).alias("t"))).collect():
        x = row["h"]
        for entity, to in W.ENTITIES[:-1]:
            x = x.replace(entity, to)
        for number in dict.fromkeys(re.findall(W.NUMBERED, x)):
            x = x.replace(f"&#{number};", chr(int(number)))
        x = x.replace(*W.ENTITIES[-1])
        for pattern, to in W.FOLDS:
            x = re.sub(pattern, to, x)
        assert row["t"] == x.strip(" \n")
    plan = out._jdf.queryExecution().analyzed().toString()
    assert len(re.findall(r"(?<!_)replace\(", plan)) <= 3


def test_responses_of_a_warc_file(spark, tmp_path):
    """What is written as response records is read back, headers and all; other records and cut ones are told apart."""

    def record(kind, n, block, length=None):
        return f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:uuid:{n}>\r\nWARC-Target-URI: http://a/{n}\r\nWARC-Date: 2020-01-0{n}T00:00:00Z\r\nWARC-Payload-Digest: sha1:X{n}\r\nContent-Length: {len(block.encode()) if length is None else length}\r\n\r\n{block}\r\n\r\n"

    http = "HTTP/1.1 404 Not Found\r\nServer: x\r\nContent-Type: text/html\r\n\r\n"
    whole = record("warcinfo", 1, "software: y\r\n") + record("response", 2, http + "<p>on\r\n\r\ne é</p>") + record("request", 3, "GET /") + record("response", 4, http + "cut", 9999) + record("response", 5, "")
    (tmp_path / "a.warc").write_bytes(whole.encode())
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(record("response", 6, http + "zipped").encode()))
    source = W.read_responses(spark, f"{tmp_path}/*.warc*")
    rows = {r["record_id"]: r for r in source.collect()}
    assert {k: r["is_whole"] for k, r in rows.items()} == {"<urn:uuid:2>": True, "<urn:uuid:4>": False, "<urn:uuid:5>": True, "<urn:uuid:6>": True}
    two = rows["<urn:uuid:2>"]
    assert (two["http_header"], two["payload"], two["date"], two["stated_digest"], two["target_uri"]) == (http, "<p>on\r\n\r\ne é</p>", "2020-01-02T00:00:00Z", "sha1:X2", "http://a/2")
    out = W.derivatives(source.where("is_whole")).collect()
    assert len(out) == 6 and {r["refers_to"] for r in out} == {"<urn:uuid:2>", "<urn:uuid:5>", "<urn:uuid:6>"}
    meta = next(r for r in out if r["warc_type"] == "metadata" and r["refers_to"] == "<urn:uuid:2>")
    assert "source-http: HTTP/1.1 404 Not Found\r\nsource-http: Server: x" in meta["block"] and "WARC-Date: 2020-01-02" in meta["header"]


def test_a_block_is_as_long_as_its_header_says(spark, tmp_path):
    """Pages that speak of records, quote one, or are in another encoding; bytes and digests are the page's own."""
    import hashlib

    def record(n, payload, http=b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n", length=None):
        block = http + payload
        size = len(block) if length is None else length
        return f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:{n}>\r\nWARC-Target-URI: http://a/{n}\r\nWARC-Payload-Digest: sha1:X{n}\r\nContent-Length: {size}\r\n\r\n".encode() + block + b"\r\n\r\n"

    evil = record("evil", b"a page that isn't there")
    latin = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=ISO-8859-1\r\n\r\n"
    pages = {1: b"The header line is WARC/1.1 and then more", 2: b"quoted:\r\n\r\n" + evil + b"end", 3: "café".encode("latin-1"), 4: b"", 5: b"x" * 3_000_000, 6: b"short"}
    whole = b"".join(record(n, p, latin) if n == 3 else record(n, p, length=7 if n == 6 else None) for n, p in pages.items()) + record(7, b"last")
    (tmp_path / "a.warc").write_bytes(whole)
    (tmp_path / "b.warc.gz").write_bytes(b"".join(gzip.compress(record(f"z{n}", p)) for n, p in pages.items()))
    (tmp_path / "c.warc").write_bytes(record("cut", b"y" * 500)[:-300])
    (tmp_path / "empty.warc").write_bytes(b"")
    source = W.read_responses(spark, f"{tmp_path}/*.warc*")
    rows = {r["record_id"][10:-1]: r for r in source.collect()}
    assert sorted(rows) == sorted([*map(str, range(1, 8)), *(f"z{n}" for n in pages), "cut"])
    assert {n for n, r in rows.items() if not r["is_whole"]} == {"6", "cut"}
    for n, p in pages.items():
        for name in (str(n), f"z{n}"):
            assert rows[name]["source_payload_digest"] == f"sha256:{hashlib.sha256(p).hexdigest()}", name
    assert rows["3"]["payload"] == "café" and rows["2"]["payload"].endswith("end") and rows["7"]["payload"] == "last"
    meta = {r["refers_to"][10:-1]: r["block"] for r in W.derivatives(source).where("warc_type = 'metadata'").collect()}
    assert "\r\nsource-warc-payload-digest: sha1:X3\r\n" in meta["3"] and rows["3"]["source_payload_digest"] in meta["3"]
    assert f"source-length: {len(latin) + 4}\r\n" in meta["3"]


def test_odd_pages(spark):
    pages = spark.createDataFrame([(1, None, None), (2, "u", "<p>" * 50_000), (2, "u", "<p>" * 50_000), (None, "u", "x")], "page_id long, url string, html string")
    out = W.derivatives(W.responses(pages).withColumn("block_digest", F.lit("other")))
    assert out.count() == 8 and out.select("record_id").distinct().count() == 6
    assert W.derivatives(W.responses(pages.where("page_id = 9"))).count() == 0


def shingles(text):
    """Five words each, lower-cased; of fewer, all of them."""
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).encode().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_pipeline_by_stages(spark, data, documents):
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.count()
        docs = stage(spark, docs, data)
        assert docs.columns == documents.columns, name
        docs.write.mode("overwrite").parquet(path := f"{spark.conf.get('spark.checkpoint.dir')}/test-{name}")
        docs = spark.read.parquet(path)
        assert 0 < docs.count() <= before, name
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{data}/labels.parquet").collect()}
    scores = {r["doc_id"]: r["score"] for r in QUERIES["op1_subsequence_svm"](spark, data).collect()}
    clean = {i: t for i, t in documents.select("doc_id", "text").collect() if scores[i] < THRESHOLD}
    single = {}
    for i, t in sorted(clean.items()):
        single[t or ""] = i
    kept = {i: (P.fingerprint(t.encode()), shingles(t)) for t, i in single.items()}
    alike = [(a, b) for a, (x, s) in kept.items() for b, (y, z) in kept.items() if a < b and ((x ^ y).bit_count() <= 2 or len(s & z) >= 0.8 * len(s | z) > 0)]
    want = {*groups(kept, alike).values()}
    assert {r["doc_id"] for r in docs.collect()} == want
    assert not any(labels.get(i) == 1 and scores[i] >= THRESHOLD for i in want)
    packed = corpus_pipeline.run(spark, data)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == want


def test_pipeline_odd_rows(spark, odd, none, data):
    for docs in (odd, none):
        left = docs
        for _, stage in corpus_pipeline.STAGES:
            left = stage(spark, left, data)
        assert (left.count() > 0) == (docs is odd)


def test_entry_without_llm(monkeypatch):
    real = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda name, *a: None if "llm" in name or name == "corpus_pipeline" else real(name, *a))
    assert not any(n.startswith("op") for n in __spark_entry__.queries())
