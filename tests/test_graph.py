from pyspark.sql import functions as F

from tether.functions import keys
from tether.operators import graph

NS = keys.KB_NAMESPACE
TRIPLES = [
    ("s1", keys.SAME_AS, NS + "m.0a"),
    ("s1", keys.SAME_AS, "p1"),
    ("s2", keys.SAME_AS, NS + "m.0a"),
    ("s2", keys.SAME_AS, "p1"),
    ("s2", keys.SAME_AS, "p2"),
    ("p1", keys.ABSTRACT, '"B text"@en'),
    ("p2", keys.ABSTRACT, '"A text"@en'),
    ("p2", keys.ABSTRACT, '"Text"@de'),
    ("s3", keys.SAME_AS, NS + "m.0b"),
    ("s3", keys.SAME_AS, "p3"),
    ("p3", keys.ABSTRACT, '"nur"@de'),
    ("s4", "other", NS + "m.0c"),
    *[(NS + "m.0a", f"p{i:02d}", f"o{i}") for i in range(12)],
]


def inputs(table):
    return table(TRIPLES, "s string, p string, o string"), table([("/m/0a",), ("/m/0b",), ("/m/0c",), ("/m/0a",)], "kb_id string")


def test_keys(table):
    row = table([("/m/0abc",)], "k string").select(keys.kb_key(F.col("k")), keys.kb_iri(F.col("k"))).first()
    assert tuple(row) == ("m.0abc", NS + "m.0abc")


def test_abstracts(table):
    triples, ids = inputs(table)
    rows = graph.kb_abstracts(triples, ids)
    assert sorted(map(tuple, rows.collect())) == [
        ("/m/0a", '"A text"@en'),
        ("/m/0a", '"B text"@en'),
        ("/m/0a", '"Text"@de'),
        ("/m/0b", '"nur"@de'),
    ]
    english = graph.english_abstracts(rows)
    assert sorted(map(tuple, english.collect())) == sorted(map(tuple, graph.kb_abstracts(triples, ids, graph.ENGLISH).collect()))
    assert graph.concat_abstracts(english).first().body == '"A text"@en "B text"@en'
    assert [r.kb_id for r in graph.candidates_with_abstract(ids, english).distinct().collect()] == ["/m/0a"]


def test_quoted_language_suffix(table):
    rows = table([("/m/1", '"a"@en'), ("/m/2", '"a"@en"')], "kb_id string, abstract string")
    assert [r.kb_id for r in graph.english_abstracts(rows, graph.QUOTED_ENGLISH).collect()] == ["/m/2"]


def test_properties(table):
    triples, ids = inputs(table)
    rows = graph.kb_properties(triples, ids).orderBy("p").collect()
    assert [(r.kb_id, r.p) for r in rows] == [("/m/0a", f"p{i:02d}") for i in range(10)]


def test_language_filter_reaches_the_scan(spark, table, tmp_path):
    table(TRIPLES, "s string, p string, o string").write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    plan = graph.kb_abstracts(stored, inputs(table)[1], graph.ENGLISH)._jdf.queryExecution().executedPlan().toString()
    assert "StringEndsWith" in plan and f"EqualTo(p,{keys.ABSTRACT})" in plan
