import gzip
import json

import pytest

from tether.functions.markup import CONTENT_TYPE
from tether.plans.documents import archive_documents, document_mentions
from tether.sources import archive, links, responses
from tether.streaming.mentions import mention_stream, write_mentions


def record(name, body, type_line=CONTENT_TYPE):
    id_line = f"WARC-TREC-ID: {name}\r\n" if name else ""
    return f"WARC/1.0\r\nWARC-Type: response\r\n{id_line}\r\nHTTP/1.1 200 OK\r\n{type_line}\r\n\r\n{body}\r\n\r\n"


RECORDS = [
    record("a", "<p>Foo Bar sees WARC/1.0\r\n in mid-line WARC/1.0\r\n</p>"),
    record(None, "no id"),
    record("b", "x", "Content-Type: text/html; charset=utf-8"),
    record("c", f"again {CONTENT_TYPE}"),
    record("d", "Last One\n<!-- gone Gone Gone -->"),
]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("archives")
    with gzip.open(path / "one.warc.gz", "wt", newline="") as f:
        f.write("".join(RECORDS))
    with open(path / "two.warc", "w", newline="") as f:
        f.write(record("e", "Only Record here"))
    return path


def test_records(spark, folder):
    rows = archive.warc_records(spark, str(folder / "*")).collect()
    assert sorted(r.record for r in rows) == sorted(x.removeprefix("WARC/1.0\r\n").rstrip("\r\n") for x in [*RECORDS, record("e", "Only Record here")])
    assert {r.path.rsplit("/", 1)[1] for r in rows} == {"one.warc.gz", "two.warc"}


def test_last_record_of_each_file_can_be_dropped(spark, folder):
    rows = archive.warc_records(spark, [str(folder / "one.warc.gz"), str(folder / "two.warc")], drop_trailing=True, partitions=2).collect()
    assert len(rows) == 4 and not any("Last One" in r.record or "Only" in r.record for r in rows)


def test_line_feed_archives(spark, tmp_path):
    with open(tmp_path / "lf.warc", "w", newline="") as f:
        f.write("".join(RECORDS).replace("\r\n", "\n"))
    # A marker that fills a line splits; in the first record the second one now ends its line only after other text.
    docs = archive_documents(spark, str(tmp_path / "lf.warc"), line_end="\n")
    assert {r.warc_id for r in docs.collect()} == {"a", "d"}


def test_outcomes(spark, folder, table):
    read = archive.read_records(archive.warc_records(spark, str(folder / "*")))
    assert {r.reason: r.n for r in archive.corpus_counts(read).collect()} == {
        "ok": 3,
        "no id": 1,
        "no content type": 1,
        "many content types": 1,
    }
    assert archive.rejects(read).count() == 3
    assert {r.warc_id for r in archive.documents(read).collect()} == {"a", "d", "e"}
    blank = archive.read_records(table([(" \r\n",)], "record string")).first()
    assert blank.reason == "empty"


def test_document_mentions(spark, folder):
    found = {r.warc_id: r.mentions for r in document_mentions(archive_documents(spark, str(folder / "*"))).collect()}
    assert found == {
        "a": ["Foo", "Bar", "WARC", "WARC", "Foo Bar"],
        "d": ["Last", "One", "Last One"],
        "e": ["Only", "Record", "Only Record"],
    }


def test_stream_equals_batch(spark, folder, tmp_path):
    write_mentions(mention_stream(spark, str(folder), max_files=1), str(tmp_path / "out"), str(tmp_path / "ck"), available_now=True).awaitTermination(60)
    got = {(r.warc_id, tuple(r.mentions)) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {(r.warc_id, tuple(r.mentions)) for r in document_mentions(archive_documents(spark, str(folder / "*"))).collect()}
    assert got == want and len(got) == 3


def test_responses(table):
    hits = {"hits": {"hits": [{"_score": 2.5, "_source": {"label": "Foo", "resource": "/m/1"}}, {"_score": 1.0, "_source": {}}]}}
    rows = table([("a", json.dumps(hits)), ("b", "{}"), ("c", '{"hits": {}}'), ("d", "broken")], "mention string, json string")
    got = responses.flatten_hits(rows).orderBy("pos").collect()
    assert [tuple(r) for r in got] == [("a", 0, "/m/1", "Foo", 2.5), ("a", 1, None, None, 1.0)]
    bindings = {"results": {"bindings": [{"abstract": {"value": '"x"@en'}}, {"abstract": {"value": '"y"@de'}}]}}
    got = responses.flatten_bindings(table([("/m/1", json.dumps(bindings)), ("/m/2", "{}")], "kb_id string, json string")).collect()
    assert sorted(map(tuple, got)) == [("/m/1", '"x"@en'), ("/m/1", '"y"@de')]


def test_links_file(spark, table, tmp_path):
    rows = [("1", "A B", "/m/1"), ("1", "A B", "/m/1"), ('q"', "C", "/m/2")]
    links.write_links(table(rows, "warc_id string, mention string, kb_id string").coalesce(1), str(tmp_path / "out"))
    lines = [line for f in (tmp_path / "out").glob("part-*") for line in f.read_text().splitlines()]
    assert sorted(lines) == sorted("\t".join(r) for r in rows)
    assert sorted(map(tuple, links.read_links(spark, str(tmp_path / "out")).collect())) == sorted(rows)


def test_marker_lines_of_any_form(spark, tmp_path):
    one = "WARC-TREC-ID: {}\r\n\r\nContent-Type: text/html; charset=UTF-8\r\n\r\n<p>body {}</p>\r\n\r\n"
    text = "WARC/1.0\r\n" + one.format("a", 1) + "WARC/1.0\n" + one.format("b", 2) + " WARC/1.0 \t\r\n" + one.format("c", "sees WARC/1.0")
    (tmp_path / "mixed.warc").write_bytes(text.encode())
    read = archive.read_records(archive.warc_records(spark, str(tmp_path)))
    assert sorted((r.warc_id, r.reason) for r in read.collect()) == [("a", None), ("b", None), ("c", None)]
    last = archive.warc_records(spark, str(tmp_path), drop_trailing=True)
    assert sorted(r.record[14:15] for r in last.collect()) == ["a", "b"]


def test_markup_is_taken_out_once(spark):
    records = spark.createDataFrame([("x",)], "record string")
    plan = archive.documents(archive.read_records(records))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("<script") == 1
