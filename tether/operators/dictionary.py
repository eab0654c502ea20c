"""Dictionary labels contained in record text, without comparing every record with every label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tether.operators.joins import balanced_join
from tether.operators.rows import exploded
from tether.session import stored

_SPACE = r"[ \t\n\x0B\f\r]+"
_GRAM = 3


def _pieces(text: Column) -> Column:
    """Text between blanks. A text that starts or ends with a blank has an empty first or last piece."""
    return F.split(text, _SPACE, -1)


def _grams(words: DataFrame, name: str) -> DataFrame:
    """``(name, at, gram)``: the substrings of ``_GRAM`` characters of each word and where they start; a shorter word is one itself."""
    width = F.least(F.length(name), F.lit(_GRAM))
    starts = F.sequence(F.lit(1), F.length(name) - width + 1)
    return words.select(name, F.explode(starts).alias("at")).select(name, "at", F.substr(name, F.col("at"), width).alias("gram"))


def _short_grams(words: DataFrame) -> DataFrame:
    """``(word, at, gram)``: substrings of fewer than ``_GRAM`` characters, for labels as short as that."""
    widths = F.array(*[F.lit(w) for w in range(1, _GRAM)])
    at = words.select("word", F.explode(F.sequence(F.lit(1), F.length("word"))).alias("at")).select("word", "at", F.explode(widths).alias("width"))
    return at.where(F.col("at") + F.col("width") - 1 <= F.length("word")).select("word", "at", F.substr("word", F.col("at"), F.col("width")).alias("gram"))


def _labels_in_words(single: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``(word, label)``: labels without blanks and the distinct words of the text that hold them.

    A label is looked for at the rarest of its grams, in place: a word is a candidate only where it has that gram, and is compared there. So
    a beginning that many labels and words share makes no pairs as long as anything else in the label is rare.
    """
    short = F.length("label") < _GRAM
    of_label = _grams(single, "label")
    wanted = stored(of_label.select("gram").distinct(), "grams")
    # Only grams that some label has; short labels are whole grams, so the short substrings of words are made for them alone.
    places = _grams(vocabulary.select("word").where(F.length("word") >= _GRAM), "word")
    if not single.where(short).isEmpty():
        places = places.unionByName(_short_grams(vocabulary))
    places = stored(places.join(wanted, "gram", "left_semi"), "gram-places")
    counts = places.groupBy("gram").agg(F.count("*").alias("n"))
    rarest = W.partitionBy("label").orderBy("n", "offset")
    keyed = (
        of_label.withColumnRenamed("at", "offset")
        .withColumn("grams", F.count("*").over(W.partitionBy("label")))
        .join(counts, "gram")
        .withColumn("found", F.count("*").over(W.partitionBy("label")))
        .withColumn("place", F.row_number().over(rarest))
        .where((F.col("place") == 1) & (F.col("found") == F.col("grams")))
        .select("label", "offset", "gram")
    )
    start = F.col("at") - F.col("offset") + 1
    met = balanced_join(places, stored(keyed, "label-grams"), "gram")
    return met.where((start >= 1) & (F.substr("word", start, F.length("label")) == F.col("label"))).select("word", "label").distinct()


def _piece_words(pieces: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``(kind, piece, word, df)``: the text words each distinct piece can stand in.

    An inner piece is a whole word of the text, the first one ends a word and the last one begins one. Words are cut at the lengths that
    pieces have, so each cut meets one piece at most and nothing is compared in vain.
    """
    wanted = pieces.select("kind", "piece").distinct()
    found = wanted.where("kind = 'inner'").join(vocabulary.withColumn("piece", F.col("word")), "piece").select("kind", "piece", "word", "df")
    for kind, at_end in (("first", True), ("last", False)):
        own = wanted.where(F.col("kind") == kind)
        lengths = own.select(F.length("piece").alias("n")).distinct()
        cuts = vocabulary.select("word", "df", F.explode(F.sequence(F.lit(1), F.length("word"))).alias("n")).join(lengths, "n")
        edges = cuts.select("word", "df", (F.right("word", F.col("n")) if at_end else F.left("word", F.col("n"))).alias("piece"))
        found = found.unionByName(edges.join(own, "piece").select("kind", "piece", "word", "df"))
    return found


def _blank_labels(texts: DataFrame, named: DataFrame) -> DataFrame:
    """``(id, label)`` of labels of blanks only, looked up in the distinct runs of blanks of the corpus."""
    runs = exploded(texts, ["id"], F.array_distinct(F.regexp_extract_all("text", F.lit(_SPACE), F.lit(0))), "run")
    blank = named.where(F.col("label").rlike(rf"^{_SPACE}$")).select("label", F.left("label", F.lit(1)).alias("char")).distinct()
    letters = exploded(runs.select("run").distinct(), ["run"], F.array_distinct(F.split("run", "")), "char")
    held = letters.join(blank, "char").where(F.contains("run", "label")).select("run", "label").distinct()
    return runs.join(held, "run").select("id", "label").distinct()


def dictionary_labels(docs: DataFrame, labels: DataFrame, id_column: str = "warc_id", text_column: str = "body") -> DataFrame:
    """``(id, label, kb_id)`` for every label that is a substring of a record's text; records without id are skipped.

    Every label gets an anchor: a piece of it that a matching text must hold.

    * Two or more pieces: an inner piece must be a word of the text, the first must end a word and the last begin one. The piece whose
      words are in the fewest records is the anchor, so common words like "of" never are unless all of a label is common; if any piece
      is in no record, the label is nowhere.
    * One piece: it must lie inside some word of the text. Which distinct text words hold it is settled at the rarest of its character triples.
    * Blanks only: looked up in the corpus's distinct runs of blanks.

    Records holding an anchor are then checked for the whole label, unless the anchor is all of it.
    """
    texts = docs.where(F.col(id_column).isNotNull()).select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    words = exploded(texts, ["id"], F.array_distinct(_pieces(F.col("text"))), "word").where("word <> ''")
    vocabulary = stored(words.groupBy("word").agg(F.count("*").alias("df")), "vocabulary")

    named = labels.select("label", "kb_id").where("label <> ''").distinct()
    cut = named.select("label").distinct().withColumn("pieces", _pieces(F.col("label")))

    n = F.size("pieces")
    kind = lambda i: F.when(i == 0, "first").when(i == n - 1, "last").otherwise("inner")
    kinds = F.array_distinct(F.transform("pieces", lambda piece, i: F.struct(kind(i).alias("kind"), piece.alias("piece"))))
    wanted = F.filter(kinds, lambda p: p["piece"] != "")
    pieces = exploded(cut.where(n >= 2), ["label", F.size(wanted).alias("wanted")], wanted, "p").select("label", "wanted", "p.kind", "p.piece")
    pieces = stored(pieces, "pieces")
    sizes = _piece_words(pieces, vocabulary).groupBy("kind", "piece").agg(F.sum("df").alias("df"))
    rarest = W.partitionBy("label").orderBy("df", "kind", "piece")
    chosen = (
        pieces.join(sizes, ["kind", "piece"])
        .withColumn("place", F.row_number().over(rarest))
        .withColumn("found", F.count("*").over(W.partitionBy("label")))
        .where((F.col("place") == 1) & (F.col("found") == F.col("wanted")))
        .select("label", "kind", "piece")
    )
    # Words are listed for anchors only, once all pieces have been counted.
    chosen = stored(chosen, "label-anchors")
    long_anchors = chosen.join(_piece_words(chosen, vocabulary), ["kind", "piece"]).select("label", "word")

    # A label of one piece is all in one word, so it is in a text once that word is.
    single = cut.where(n == 1).select("label")
    held = _labels_in_words(single, vocabulary)
    anchors = long_anchors.select("label", "word", F.lit(False).alias("settled")).unionByName(held.select("label", "word", F.lit(True).alias("settled")))

    near = balanced_join(words, stored(anchors, "anchors"), "word").groupBy("id", "label").agg(F.first("settled").alias("settled"))
    checked = near.where(~F.col("settled")).join(texts, "id").where(F.contains("text", "label"))
    found = near.where("settled").select("id", "label").unionByName(checked.select("id", "label")).unionByName(_blank_labels(texts, named))
    return found.join(named, "label").select(F.col("id").alias(id_column), "label", "kb_id")
