"""Inputs of the queries, all derived by Spark from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tether.functions.keys import ABSTRACT, KB_NAMESPACE, SAME_AS, kb_iri
from tether.functions.markup import CONTENT_TYPE, RECORD_KEY
from tether.operators import mentions as m
from tether.session import fresh_path, spread

# Names of the graph the triples stand for.
THING = "http://graph.example/thing/"
WIKI = "http://graph.example/wiki/"
PAGE = "http://graph.example/page/"
LABEL = "http://www.w3.org/2000/01/rdf-schema#label"

# Letters that tell the language of a benchmark passage; without any it counts as English.
LANGUAGE_LETTERS = (("es", "[ñóí]"), ("de", "[äöüß]"), ("fr", "[éèêç]"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as ``(warc_id, body)``."""
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("warc_id"), F.col("text").alias("body"))
    return spread(rows, "warc_id")


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages as entities ``(item_id, kb_id, lang, text)``."""
    lang = F.lit("en")
    for name, letters in reversed(LANGUAGE_LETTERS):
        lang = F.when(F.col("text").rlike(letters), F.lit(name)).otherwise(lang)
    return table(spark, sf_dir, "benchmark").select(
        "item_id", F.concat(F.lit("/m/0"), F.col("item_id").cast("string")).alias("kb_id"), lang.alias("lang"), "text"
    )


def known_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``word``: the distinct words of all pages, in either case, as a word list would come."""
    words = F.regexp_extract_all("html", F.lit("[A-Za-z]+"), F.lit(0))
    return table(spark, sf_dir, "pages").select(F.explode(F.array_distinct(words)).alias("word")).distinct()


def kb_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(kb_id, label)``: the mentions of each passage, and its opening three words as a title."""
    words = m.word_arrays(items(spark, sf_dir).select(F.col("kb_id").alias("warc_id"), F.col("text").alias("body")))
    named = m.mention_rows(m.mention_arrays(m.tag_tokens(words))).select(F.col("warc_id").alias("kb_id"), F.col("mention").alias("label"))
    titles = words.where(F.size("words") >= 3).select(
        F.col("warc_id").alias("kb_id"), F.array_join(F.slice("words", 1, 3), " ").alias("label")
    )
    return named.unionByName(titles).distinct()


def kb_triples(spark: SparkSession, sf_dir: str, labels: DataFrame | None = None) -> DataFrame:
    """``(s, p, o)``: one abstract per line of a passage; passages of several lines hang on two subjects, so paths to them repeat."""
    entity = items(spark, sf_dir).withColumn("iri", kb_iri(F.col("kb_id"))).withColumn("x", F.col("item_id").cast("string"))

    def link(rows: DataFrame, subject: str, target) -> DataFrame:
        return rows.select(F.concat(F.lit(subject), "x").alias("s"), F.lit(SAME_AS).alias("p"), target.alias("o"))

    page = F.concat(F.lit(PAGE), "x")
    several = entity.where(F.contains("text", F.lit("\n")))
    tagged = F.concat(F.lit('"'), F.col("value"), F.lit('"@'), F.col("lang"))
    lines = entity.select("x", "lang", F.explode(F.split("text", "\n", -1)).alias("value")).where("value <> ''")
    if labels is None:
        labels = kb_labels(spark, sf_dir)
    names = labels.join(entity.select("kb_id", "iri", "lang"), "kb_id").withColumnRenamed("label", "value")
    return (
        link(entity, THING, F.col("iri"))
        .unionByName(link(entity, THING, page))
        .unionByName(link(several, WIKI, F.col("iri")))
        .unionByName(link(several, WIKI, page))
        .unionByName(lines.select(page.alias("s"), F.lit(ABSTRACT).alias("p"), tagged.alias("o")))
        .unionByName(names.select(F.col("iri").alias("s"), F.lit(LABEL).alias("p"), tagged.alias("o")))
    )


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(name, type)``: labels typed by the language of their entity."""
    kind = F.when(F.col("lang") == "en", "PERSON").when(F.col("lang") == "es", "GPE").otherwise("ORGANIZATION")
    return (
        kb_labels(spark, sf_dir)
        .join(items(spark, sf_dir).select("kb_id", "lang"), "kb_id")
        .select(F.col("label").alias("name"), kind.alias("type"))
        .distinct()
    )


def page_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(page_id, record)``: pages as archive records, some of them faulty depending on language and address."""
    is_german = F.contains("html", F.lit('<html lang="de">'))
    is_spanish = F.contains("html", F.lit('<html lang="es">'))
    plain = F.col("url").startswith("http:")
    queried = F.contains("url", F.lit("?"))
    id_line = F.when(plain & queried, F.lit("")).otherwise(F.concat(F.lit(f"{RECORD_KEY}: page-"), F.col("page_id").cast("string"), F.lit("\r\n")))
    type_line = (
        F.when(is_german, F.lit(CONTENT_TYPE.replace("UTF-8", "utf-8") + "\r\n"))
        .when(is_spanish & plain, F.lit(f"{CONTENT_TYPE}\r\n{CONTENT_TYPE}\r\n"))
        .otherwise(F.lit(f"{CONTENT_TYPE}\r\n"))
    )
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.concat(
            F.lit("WARC-Type: response\r\n"), id_line, F.lit("\r\nHTTP/1.1 200 OK\r\n"), type_line, F.lit("\r\n"), F.col("html")
        ).alias("record"),
    )


def page_archive(spark: SparkSession, sf_dir: str) -> str:
    """Write the page records as gzip archives, several files of them, and return their folder."""
    path = fresh_path(spark, "archive")
    # Marker lines differ from page to page, as they do in archives put together from several sources.
    marker = (
        F.when(F.contains("record", F.lit('<html lang="fr">')), F.lit("WARC/1.0 \n"))
        .when(F.contains("record", F.lit("&quot;")), F.lit(" WARC/1.0\t\r\n"))
        .otherwise(F.lit("WARC/1.0\r\n"))
    )
    (
        spread(page_records(spark, sf_dir), "page_id")
        .select(F.concat(marker, "record").alias("value"))
        .write.option("lineSep", "\r\n\r\n")
        .option("compression", "gzip")
        .text(path)
    )
    return path


__all__ = ["KB_NAMESPACE", "docs", "gazetteer", "items", "kb_labels", "kb_triples", "page_archive", "page_records", "table"]
