import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tether.llm import language, quality_net, quality_rules
from tether.llm.texts import held_out

from .conftest import rows_of

SF01 = "/root/testdata/sf0.1"


# Rules ---------------------------------------------------------------------------------------------------------------------------


def brute_rules(text, grams=(3, 5, 6, 7, 8, 9, 10)):
    def words_of(t):
        return re.findall(r"[^\x20\x09-\x0D]+", t)

    words = words_of(text)
    out = {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_dup_lines": 0, "dup_line_chars": 0}
    seen = set()
    for line in text.split("\n"):
        if words_of(line):
            if line in seen:
                out["n_dup_lines"] += 1
                out["dup_line_chars"] += sum(map(len, words_of(line)))
            seen.add(line)
    for n in grams:
        windows = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
        counts = Counter(windows)
        inside = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(n)}
        if n == 3:
            out["n_repeat_words"] = len(inside)
        else:
            out[f"dup_chars_{n}"] = sum(len(words[i]) for i in inside)
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab é中\n\t#|"), max_size=80), min_size=1, max_size=6))
def test_counts_equal_brute_force(texts):
    got = quality_rules.measure([t.encode() for t in texts])
    for i, text in enumerate(texts):
        assert {k: int(v[i]) for k, v in got.items()} == brute_rules(text)


def test_rules_of_tables(odd, documents):
    for docs in (odd, documents):
        got = quality_rules.quality_rules(docs)
        want = Counter()
        for row in docs.collect():
            b = brute_rules(row.text or "")
            failed = b["n_words"] < 50 or 100 * b["n_repeat_words"] > 50 * b["n_words"]
            kept = not failed and 100 * b["dup_line_chars"] <= 20 * b["word_chars"] and all(100 * b[f"dup_chars_{n}"] <= p * b["word_chars"] for n, p in quality_rules.GRAM_PERCENT.items())
            want[(row.doc_id, b["n_words"], b["word_chars"], b["n_symbols"], b["n_dup_lines"], b["n_repeat_words"], failed, kept)] += 1
        assert Counter(tuple(r)[:8] for r in got.collect()) == want
    assert quality_rules.quality_rules(odd.limit(0)).collect() == []


def test_held_out_is_a_checksum(spark):
    ids = spark.range(200).withColumn("h", held_out("id"))
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in ids.collect())


# Network -------------------------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def scored(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    weights = quality_net.learn(docs, labels)
    return weights, quality_net.score(docs, weights).join(labels, "doc_id").where("held_out").toPandas(), docs.count()


def test_held_out_accuracy(scored):
    _, rows, _ = scored
    good, bad = rows.score[rows.quality == 1].to_numpy(), rows.score[rows.quality == 0].to_numpy()
    auc = (good[:, None] > bad[None]).mean() + (good[:, None] == bad[None]).mean() / 2
    assert auc > 0.98 and (rows.predicted == rows.quality).mean() > 0.95
    assert (rows.predicted == (rows.score >= 0.7)).all() and rows.score.between(0, 1).all()


def test_scores_of_odd_texts(scored, odd):
    weights, _, _ = scored
    rows = quality_net.score(odd, weights).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    kept = quality_net.filter_quality(odd, weights, 0.5)
    assert kept.columns == odd.columns
    assert rows_of(kept, "doc_id") == sorted([(r.doc_id,) for r in rows if r.score >= 0.5], key=repr)
    assert quality_net.score(odd.limit(0), weights).collect() == []


def test_chunks_cover_whole_texts():
    texts = [b"", b"a", bytes(range(1, 200)) * 9, b"x" * quality_net.CHUNK, b"y" * (quality_net.CHUNK + 1)]
    rows, first = quality_net.chunks(texts)
    for text, a, b in zip(texts, first, [*first[1:], len(rows)]):
        back = rows[a].tobytes() + b"".join(r.tobytes()[quality_net.CHUNK - quality_net.STEP :] for r in rows[a + 1 : b])
        assert back.rstrip(b"\0") == text


def test_gradients_by_differences():
    draw = np.random.default_rng(1)
    weights = {k: v.astype(np.float64) for k, v in quality_net.initial(3).items()}
    rows, first = quality_net.chunks([bytes(draw.integers(97, 123, n, dtype=np.uint8)) for n in (40, 900, 1500)])
    owner = np.repeat(np.arange(3), np.diff(np.append(first, len(rows))))
    target = np.array([0.0, 1.0, 1.0])

    def loss():
        logits = np.bincount(owner, quality_net.chunk_scores(rows, weights)) / np.bincount(owner)
        return np.mean(np.log1p(np.exp(-logits * (2 * target - 1))))

    gradients = quality_net._gradients(rows, owner, target, weights)
    for name, at in [("filters", (5, 7)), ("filter_bias", (3,)), ("hidden", (2, 4)), ("hidden_bias", (1,)), ("out", (5,)), ("out_bias", (0,)), ("embed", (101, 2))]:
        kept, step = weights[name][at], 1e-5
        weights[name][at] = kept + step
        up = loss()
        weights[name][at] = kept - step
        down = loss()
        weights[name][at] = kept
        assert gradients[name][at] == pytest.approx((up - down) / 2 / step, rel=0.02, abs=1e-6)


def test_without_labels_or_with_one(spark, odd):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality_net.score(odd, quality_net.learn(odd, none)).collect()} == {0.5}
    ones = spark.range(8).selectExpr("id AS doc_id", "1 AS quality")
    assert {r.predicted for r in quality_net.score(odd, quality_net.learn(odd, ones)).collect()} == {1}


def test_held_out_labels_are_not_learned(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    flipped = labels.withColumn("quality", F.when(held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality_net.learn(documents, x) for x in (labels, flipped))
    assert all((a[k] == b[k]).all() for k in a)


# Language ------------------------------------------------------------------------------------------------------------------------


def test_language_accuracy(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    rows = language.detect(docs, language.learn(docs)).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    right, rejected = rows.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.avg(F.col("rejected").cast("int"))).first()
    assert right > 0.98 and rejected < 0.02


def test_language_of_odd_texts(documents, odd):
    known = language.learn(documents)
    rows = language.detect(odd, known).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    no_letter = {r.doc_id for r in odd.collect() if not re.search(r"[^\W\d_]", r.text or "")}
    assert {r.doc_id for r in rows if r.lang_pred == "und"} == no_letter
    kept = language.filter_language(odd, known)
    assert kept.columns == odd.columns and rows_of(kept, "doc_id") == sorted([(r.doc_id,) for r in rows if not r.rejected], key=repr)


def test_language_without_samples(spark, odd):
    nothing = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert language.learn(nothing) == {}
    assert {(r.lang_pred, r.score, r.rejected) for r in language.detect(odd, {}).collect()} == {("und", 0.0, True)}
    assert language.detect(odd.limit(0), {}).collect() == []


def test_language_sample_is_bounded_and_leaves_out_held_out_rows(documents):
    known = language.learn(documents)
    assert all(len(s) <= language.SHARES * (2 * language.SAMPLE_CHARS + 1) for s in known.values())
    assert known == language.learn(documents.withColumn("lang", F.when(held_out("doc_id"), F.lit("xx")).otherwise(F.col("lang"))))


def test_long_texts_count_whole():
    known = {"a": b"alpha beta gamma delta " * 20, "b": b"einen anderen garten voller worte " * 20}
    sorter = language.Classifier(tuple(known.items()))
    text = "zzz " * 300 + "einen anderen garten voller worte " * 400
    assert sorter.classify(text)[0] == "b" and sorter.classify("beta gamma delta alpha")[0] == "a"


def test_narrow_margins_are_rejected(spark):
    """Equal but for one or two bytes, or for less than the share asked for: not only exact ties go."""
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    known = language.learn(docs)
    sorter = language.Classifier(tuple(sorted(known.items())))
    draw = np.random.default_rng(1)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    texts = [" ".join("".join(draw.choice(letters, draw.integers(2, 11))) for _ in range(100)) for _ in range(60)]
    texts += [r.text for r in docs.where("doc_id % 40 = 0").select("text").collect()]
    found = [sorter.classify(t) for t in texts]
    assert any(0.002 <= margin < language.MIN_MARGIN for _, margin, _ in found)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rejected = {r.doc_id: r.rejected for r in language.detect(rows, known).collect()}
    assert rejected == {i: margin < language.MIN_MARGIN or lead < language.MIN_LEAD for i, (_, margin, lead) in enumerate(found)}
    assert sum(rejected[i] for i in range(60)) >= 57
    kept = {r.doc_id for r in language.filter_language(rows, known).collect()}
    assert kept == {i for i, gone in rejected.items() if not gone}


def test_short_texts_need_a_lead_in_bytes(spark, monkeypatch):
    monkeypatch.setattr(language.Classifier, "classify", lambda self, text: ("en", 0.5, int(text)))
    work = language._work({"en": b""})([str(lead) for lead in range(6)])
    rows = spark.createDataFrame([(s, n) for s, n in zip(work["score"].to_pylist(), work["lead"].to_pylist())], "score double, lead int")
    kept = rows.where(language._clear(F.col("score"), F.col("lead"), language.MIN_MARGIN, language.MIN_LEAD)).collect()
    assert sorted(r.lead for r in kept) == list(range(language.MIN_LEAD, 6))
