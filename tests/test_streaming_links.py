import gzip

import pytest
from test_linking import collected

from tether.functions import keys
from tether.functions.markup import CONTENT_TYPE, RECORD_KEY
from tether.plans.linking import link_entities
from tether.streaming import linking as streamed
from tether.streaming import mentions as sm

RECORDS = [("a", "Foo Bars went. Foo saw Alpha"), ("b", "Foo Bar met Zeta"), ("a", "Foo Bar and Alpha"), ("c", "nothing"), ("d", "Alpha and Foo Bar")]


@pytest.fixture
def base(table):
    labels = [("/m/01", "Foo Bar"), ("/m/02", "Zeta"), ("/m/03", "Alpha")]
    triples = []
    for kb, text in [("1", "Foo Bar and Alpha"), ("2", "Zeta Foo"), ("3", "Alpha Bar")]:
        triples += [(f"s{kb}", keys.SAME_AS, f"{keys.KB_NAMESPACE}m.0{kb}"), (f"s{kb}", keys.SAME_AS, f"p{kb}"), (f"p{kb}", keys.ABSTRACT, f'"{text}"@en')]
    known = table([("Bar",)], "word string")
    return table(labels, "kb_id string, label string"), table(triples, "s string, p string, o string"), {"lemma_lexicon": known}


def put(folder, number, records):
    text = "".join(f"WARC/1.0\r\n{RECORD_KEY}: {i}\r\n{CONTENT_TYPE}\r\n{body}\r\n\r\n" for i, body in records)
    with gzip.open(folder / f"{number}.warc.gz", "wb") as out:
        out.write(text.encode())


def test_batches_link_as_one_and_search_what_is_new(spark, table, base, tmp_path):
    labels, triples, options = base
    folder, path, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    folder.mkdir()
    want = collected(link_entities(table(RECORDS, "warc_id string, body string"), labels, triples, **options))
    assert want

    def run():
        streamed.link_stream(spark, str(folder), labels, triples, path, checkpoint, available_now=True, **options).awaitTermination()
        return collected(streamed.read_links(spark, path))

    put(folder, 1, RECORDS[:2])
    first = run()
    assert {r[0] for r in first} == {"a", "b"}
    put(folder, 2, RECORDS[2:])
    assert run() == want
    # Nothing is taken twice after a restart.
    assert run() == want
    searched = spark.read.parquet(f"{path}/searched")
    assert searched.count() == searched.select("mention").distinct().count()
    assert "Foo" not in {r.mention for r in searched.where("batch = 1").collect()}
    # A batch that was cut short comes again and writes the same.
    docs = table(RECORDS[2:], "warc_id string, body string")
    streamed.link_batch(docs, 1, labels, triples, path, **options)
    assert collected(streamed.read_links(spark, path)) == want


def test_mention_batches_take_word_tables(spark, base, table, tmp_path):
    folder, path = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    put(folder, 1, RECORDS)
    names = table([("Foo Bar", "X"), ("Alpha", "Y")], "name string, type string")
    records = sm.record_stream(spark, str(folder))
    sm.write_mention_batches(records, path, str(tmp_path / "check"), available_now=True, gazetteer=names, **base[2]).awaitTermination()
    got = sorted((r.warc_id, r.mentions) for r in spark.read.parquet(path).collect())
    assert got == [("a", ["Alpha", "Foo Bar"]), ("a", ["Alpha", "Foo Bar"]), ("b", ["Foo Bar"]), ("c", []), ("d", ["Alpha", "Foo Bar"])]
