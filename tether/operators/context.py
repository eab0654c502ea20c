"""Tags from context: the best sequence of tags for a document, by uses of words and by which tags follow each other.

A word that always has one tag keeps it. A word used under several is open, and its tag is decided by how often it has each and by its
neighbours. Between two words whose tags are fixed nothing outside plays a part, so a document falls into stretches of open words,
each decoded alone by dynamic programming in the document's row; only the costs of its open words are joined to it.

Costs are whole thousandths of natural logarithms, so sums are exact. Of equally good sequences the one whose tags, from the last open word
back, come first in their order is taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tether.functions import words as fw
from tether.operators.joins import with_few
from tether.operators.rows import exploded, looked_up, word_maps
from tether.session import stored

# More tags than this are no tag set; their moves are held by every task.
MOST_TAGS = 64
# Where a document begins and ends.
EDGE = ""
_UNIT = 1000
_FAR = 1 << 40
# Before and after a stretch of fixed words, and between the tags in it; no cleaned word holds any of them.
_BEGIN, _END, _NEXT = "\x01", "\x02", "\x03"


def tag_uses(words: DataFrame) -> DataFrame:
    """``(word, tag, n)``: how often each lower-cased word is used under each tag of the capitalisation rule."""
    spelled = exploded(words, [], "words", "word").groupBy("word").agg(F.count("*").alias("n"))
    return spelled.groupBy(F.lower("word").alias("word"), fw.rule_tag(F.col("word")).alias("tag")).agg(F.sum("n").alias("n"))


def tag_moves(tagged: DataFrame) -> DataFrame:
    """``(before, tag, n)``: how often a tag follows another in ``tagged (warc_id, tagged)``, with the edges of documents as one more."""
    tags = F.transform("tagged", lambda t: t["tag"])
    edge = F.array(F.lit(EDGE))
    pairs = F.arrays_zip(F.concat(edge, tags).alias("before"), F.concat(tags, edge).alias("tag"))
    return exploded(tagged, [], pairs, "move").groupBy("move.before", "move.tag").agg(F.count("*").alias("n"))


def _cost(part: Column, whole: Column) -> Column:
    return F.round(-F.lit(_UNIT) * F.log(part / whole)).cast("long")


def use_costs(uses: DataFrame) -> DataFrame:
    """``(word, tag, cost)`` of words that are used under several tags: how unlikely the word is under the tag, up to what all tags share."""
    of_word = uses.groupBy("word").agg(F.sum("n").alias("n_word")).join(uses.groupBy("word").agg(F.count("*").alias("n_tags")).where("n_tags > 1"), "word")
    of_tag = uses.groupBy("tag").agg(F.sum("n").alias("n_tag"))
    total = uses.agg(F.sum("n").alias("n_all"))
    joined = uses.join(of_word, "word").join(F.broadcast(of_tag), "tag").join(F.broadcast(total))
    return joined.select("word", "tag", (_cost(F.col("n"), F.col("n_word")) - _cost(F.col("n_tag"), F.col("n_all"))).alias("cost"))


def move_costs(moves: DataFrame) -> dict[tuple[str, str], int]:
    """Cost of each tag after each other, counts raised by one so that none is impossible. Collects the moves, ``MOST_TAGS`` squared at most."""
    tags = moves.select(F.col("tag").alias("t")).unionByName(moves.select(F.col("before").alias("t"))).where(F.col("t") != EDGE).distinct()
    names = sorted(r.t for r in tags.limit(MOST_TAGS + 1).collect())
    if len(names) > MOST_TAGS:
        raise ValueError(f"more than {MOST_TAGS} tags")
    names = [EDGE, *names]
    every = F.array(*[F.struct(F.lit(a).alias("before"), F.lit(b).alias("tag")) for a in names for b in names])
    spark = moves.sparkSession
    grid = spark.range(1).select(F.explode(every).alias("m")).select("m.*")
    seen = moves.groupBy("before", "tag").agg(F.sum("n").alias("n"))
    counted = grid.join(seen, ["before", "tag"], "left").select("before", "tag", (F.coalesce("n", F.lit(0)) + 1).alias("n"))
    sums = counted.groupBy("before").agg(F.sum("n").alias("n_before"))
    return {(r.before, r.tag): r.cost for r in counted.join(sums, "before").select("before", "tag", _cost(F.col("n"), F.col("n_before")).alias("cost")).collect()}


def _decoded(words: Column, left: Column, right: Column, tags: list[str], moves: dict[tuple[str, str], int]) -> Column:
    """Tags of a stretch of open ``words`` between two fixed tags or edges."""
    around = [EDGE, *tags]
    leaving = {a: F.array(*[F.lit(moves[a, b]).cast("long") for b in tags]) for a in around}
    entering = {b: F.array(*[F.lit(moves[a, b]).cast("long") for a in tags]) for b in around}
    row_of = lambda rows, name: F.element_at(F.create_map(*[x for a in around for x in (F.lit(a), rows[a])]), name)
    from_left, to_right = row_of(leaving, left), row_of(entering, right)
    into = F.array(*[entering[b] for b in tags])
    empty = F.array(*[F.array().cast("array<int>") for _ in tags])

    def best(costs: Column, more: Column) -> Column:
        """The smallest sum, and the place of the tag that has it."""
        return F.array_min(F.transform(F.zip_with(costs, more, lambda a, b: a + b), lambda c, i: F.struct(c.alias("cost"), i.alias("before"))))

    def step(state: Column, word: Column) -> Column:
        own = looked_up("costs", word)
        reached = F.transform(into, lambda row: best(state["costs"], row))
        first = F.size(state["paths"][0]) == 0
        costs = F.when(first, F.zip_with(from_left, own, lambda a, b: a + b)).otherwise(F.zip_with(F.transform(reached, lambda r: r["cost"]), own, lambda a, b: a + b))
        extend = lambda t: F.when(first, F.array(t.cast("int"))).otherwise(F.array_append(F.get(state["paths"], F.get(reached, t)["before"]), t.cast("int")))
        return F.struct(costs.alias("costs"), F.transform(F.sequence(F.lit(0), F.lit(len(tags) - 1)), extend).alias("paths"))

    start = F.struct(F.array(*[F.lit(0).cast("long") for _ in tags]).alias("costs"), empty.alias("paths"))
    path = F.aggregate(words, start, step, lambda state: F.get(state["paths"], best(state["costs"], to_right)["before"]))
    names = F.array(*map(F.lit, tags))
    return F.transform(path, lambda i: F.get(names, i))


def tag_in_context(words: DataFrame, uses: DataFrame, moves: DataFrame) -> DataFrame:
    """``(warc_id, tagged)`` of ``words (warc_id, words)``: each word with its tag in the best sequence.

    ``uses (word, tag, n)`` has lower-cased words, ``moves (before, tag, n)`` has ``""`` for the edges; both may come from any tagged corpus.
    Capitalised words that ``uses`` lists under several tags are open; all others have the tag of the capitalisation rule.
    """
    moves = move_costs(moves)
    tags = sorted({b for _, b in moves} - {EDGE})
    costs = stored(use_costs(uses).where(F.col("tag").isin(tags)), "use-costs")
    by_word = costs.groupBy("word").agg(F.map_from_entries(F.collect_list(F.struct("tag", "cost"))).alias("of"))
    far = F.lit(_FAR).cast("long")
    by_word = by_word.select("word", F.array(*[F.coalesce(F.try_element_at("of", F.lit(t)), far) for t in tags]).alias("costs"))
    capital = F.array_distinct(F.filter("words", lambda w: fw.rule_tag(w) == fw.NOUN))
    asked = exploded(words, ["warc_id"], capital, "spelled").join(with_few(stored(by_word, "word-costs")), F.lower("spelled") == F.col("word"))
    by_doc = word_maps(asked, "spelled", "costs", "costs")
    joined = words.join(by_doc, "warc_id", "left")
    # Fixed words as their tags and open ones as they are, in one text. Cut at the marks, every second part is a stretch of fixed words.
    is_open = lambda w: (fw.rule_tag(w) == fw.NOUN) & looked_up("costs", w).isNotNull()
    marked = F.transform("words", lambda w: F.when(is_open(w), w).otherwise(F.concat(F.lit(_BEGIN), fw.rule_tag(w), F.lit(_END))))
    text = F.replace(F.array_join(marked, " "), F.lit(f"{_END} {_BEGIN}"), F.lit(_NEXT))
    cut = joined.select("warc_id", "words", "costs", F.split(text, f"[{_BEGIN}{_END}]", -1).alias("parts"))

    def tag_beside(i: Column, step: int) -> Column:
        """The tag next to part ``i`` on one side, or the edge of the document."""
        return F.coalesce(F.substring_index(F.get("parts", i + step), _NEXT, step), F.lit(EDGE))

    def decode(part: Column, i: Column) -> Column:
        words_of = F.split(F.trim(part), " ", -1)
        # Nothing is before the first part, which place -1 would be.
        found = _decoded(words_of, F.when(i == 0, F.lit(EDGE)).otherwise(tag_beside(i, -1)), tag_beside(i, 1), tags, moves)
        none = F.array().cast("array<string>")
        return F.when(i % 2 == 1, F.split(part, _NEXT, -1)).when(F.trim(part) == "", none).otherwise(found)

    decided = cut.select("warc_id", "words", F.flatten(F.transform("parts", decode)).alias("tags"))
    pairs = F.zip_with("words", "tags", lambda w, t: F.struct(w.alias("word"), t.alias("tag")))
    return decided.select("warc_id", pairs.alias("tagged"))
