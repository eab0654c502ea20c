from collections import Counter

import corpus_pipeline
import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tether.llm import language, oracles, packing, quality_net
from tether.session import stored

from .conftest import SF
from .test_near_copies import brute_components, brute_lines
from .test_tokens import by_tokenizers, checked


@pytest.fixture(scope="module")
def stages(spark, documents):
    """What each stage got and returned, over a table with an exact copy, a near copy and odd rows added."""
    some = documents.where("doc_id in (1, 3)")
    extra = some.withColumn("doc_id", F.col("doc_id") + 10_000).unionByName(
        some.select((F.col("doc_id") + 20_000).alias("doc_id"), F.concat("text", F.lit(" more")).alias("text"), "lang", "source", "n_chars")
    )
    odd = spark.createDataFrame([(30_000, None, None, None, None), (30_001, "", "en", "s", 0), (None, None, "en", "s", 1)], documents.schema)
    docs = documents.unionByName(extra).unionByName(odd)
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, docs, SF), name)
        out[name] = (docs, after)
        docs = after
    return out


def rows(df, *columns):
    return Counter(map(tuple, df.select(*columns).collect()))


def test_stages_return_documents(stages, documents):
    for name in list(stages)[:-1]:
        assert stages[name][1].columns == documents.columns
        assert 0 < stages[name][1].count() <= stages[name][0].count()


def test_language_and_quality_take_effect(spark, stages):
    before, after = stages["language_id"]
    kept = language.detect(before, language.learn(before)).where("not rejected")
    assert rows(kept, "doc_id") == rows(after, "doc_id") and rows(after, "doc_id", "text") <= rows(before, "doc_id", "text")
    before, after = stages["quality_classifier"]
    scores = quality_net.score(before, quality_net.learn(before, spark.read.parquet(f"{SF}/labels.parquet")))
    assert rows(scores.where(F.col("score") >= corpus_pipeline.MIN_QUALITY), "doc_id") == rows(after, "doc_id")


def test_lines_go_as_brute_force_says(stages):
    before, after = stages["line_dedup"]
    texts = [(r.doc_id, r.text) for r in before.collect()]
    # Equal lines, and all pairs of lines within as many edits as the shorter one's length allows.
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": [k for k, _ in texts], "text": [t for _, t in texts]}))
    gone = set(con.execute(f"{oracles.LINE_REASONS} SELECT doc_id, pos FROM judged WHERE reason IS NOT NULL").fetchall())
    assert gone > {k[:2] for k in brute_lines(texts, edit_chars=1 << 30)}
    want = {}
    for key, text in texts:
        kept = [line for pos, line in enumerate(text.split("\n")) if (key, pos) not in gone]
        if len(kept) == len(text.split("\n")) or any(line.split() for line in kept):
            want[key] = "\n".join(kept)
    assert {r.doc_id: r.text for r in after.collect()} == want
    assert all(r.n_chars == len(r.text) for r in after.collect())


def test_one_of_each_group_stays(stages):
    before, after = stages["simhash_near_dedup"]
    want = {c for _, _, c in brute_components([(r.doc_id, r.text) for r in before.collect()])}
    assert {r.doc_id for r in after.collect()} == want


def test_all_tokens_are_packed(stages):
    before, after = stages["best_fit_packing"]
    want = {r.doc_id: len(by_tokenizers(r.text)) + 1 for r in before.collect()}
    placed = after.collect()
    got = Counter()
    for r in placed:
        got[r.doc_id] += r.length
    assert got == want
    checked([(r.sequence_id, r.offset, r.length) for r in placed], packing.Capacities())


def test_run_equals_its_stages(spark, documents):
    docs = documents
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), "stage")
    assert rows(corpus_pipeline.run(spark, SF), "doc_id", "piece", "ids_crc32") == rows(docs, "doc_id", "piece", "ids_crc32")
    assert corpus_pipeline.ORACLE_SQL is None
