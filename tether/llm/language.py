"""Language by compression: a text belongs to the language whose sample helps zstandard most to compress it.

Each language has a raw-content dictionary made of a bounded sample of labelled documents. A text is lower-cased, what is no letter becomes
a space, and blocks that cover it are compressed with every dictionary; the sizes are added up, so long texts are judged like short ones.

Null texts and texts without a letter are ``und`` with score 0 and are rejected. So is every text if no labelled row exists. Equal sizes go
to the first language in order. One row per input row; other columns are left out (``detect``) or kept as they are (``filter_language``).
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tether.llm.texts import held_out, judged, map_texts

UNKNOWN = "und"
# Sample of each language: one document for each of so many shares of the ids, and so many of its first characters.
SHARES, SAMPLE_CHARS = 96, 1200
# Text compressed at once. With smaller blocks the dictionary says more, with larger ones the text itself does.
BLOCK = 2048
# A text is rejected if the best language makes it smaller than the second by less than this share, or by fewer bytes than this.
MIN_MARGIN, MIN_LEAD = 0.02, 3

# Lead of a language without a second one.
ALONE = (1 << 31) - 1
FOUND = "lang_pred string, score double, lead int"

LETTERS = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256))


def letters(text: str) -> bytes:
    """Lower-case words of ``text``; only ASCII characters are told apart into letters and others."""
    return b" ".join(text.lower().encode().translate(LETTERS).split())


def compressor(sample: bytes) -> Callable[[bytes], bytes]:
    """Compresses with ``sample`` as what came before: matches of four bytes and more, searched for in many places."""
    setting = zstandard.ZstdCompressionParameters(
        window_log=max(17, len(sample).bit_length()),
        chain_log=16,
        hash_log=16,
        search_log=3,
        min_match=4,
        target_length=16,
        strategy=zstandard.STRATEGY_GREEDY,
        write_content_size=False,
        write_dict_id=False,
    )
    known = zstandard.ZstdCompressionDict(sample, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    known.precompute_compress(compression_params=setting)
    return zstandard.ZstdCompressor(dict_data=known, compression_params=setting).compress


def learn(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> dict[str, bytes]:
    """Dictionary of each language, from labelled documents that are not held out. Runs a job.

    The sample has at most ``SHARES * SAMPLE_CHARS`` characters a language, whatever the corpus holds.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    usable = rows.where(~held_out("key") & F.col("lang").isNotNull() & (F.length("text") > 0))
    turn = F.xxhash64("key", F.length("text"))
    drawn = usable.select("lang", F.pmod(turn, F.lit(SHARES)).alias("share"), F.struct(turn.alias("turn"), F.substring("text", 1, SAMPLE_CHARS).alias("text")).alias("drawn"))
    sample = drawn.groupBy("lang", "share").agg(F.min("drawn")["text"].alias("text")).collect()
    found: dict[str, list[str]] = {}
    for row in sorted(sample, key=lambda r: (r.lang, r.share)):
        found.setdefault(row.lang, []).append(letters(row.text))
    return {name: b" ".join(texts) for name, texts in found.items()}


class Classifier:
    def __init__(self, dictionaries: tuple[tuple[str, bytes], ...]):
        self.names = [name for name, _ in dictionaries]
        self.compressors = [compressor(sample) for _, sample in dictionaries]

    def classify(self, text: str) -> tuple[str, float, int]:
        """Language, margin and lead: by what share and by how many bytes the best language's size is below the second's."""
        if not self.names or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, 0
        data = letters(text)
        blocks = [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]
        sizes = [sum(map(len, map(compress, blocks))) for compress in self.compressors]
        best = min(range(len(sizes)), key=sizes.__getitem__)
        others = sizes[:best] + sizes[best + 1 :]
        if not others:
            return self.names[best], 1.0, ALONE
        return self.names[best], 1 - sizes[best] / min(others), min(others) - sizes[best]


@functools.lru_cache(maxsize=2)
def _classifier(dictionaries: tuple[tuple[str, bytes], ...]) -> Classifier:
    return Classifier(dictionaries)


def _work(dictionaries: dict[str, bytes]):
    fixed = tuple(sorted(dictionaries.items()))

    def work(texts: list[str]) -> dict:
        found = [_classifier(fixed).classify(t) for t in texts]
        names, margins, leads = zip(*found) if found else ((), (), ())
        return {"lang_pred": pa.array(names, pa.string()), "score": pa.array(margins, pa.float64()), "lead": pa.array(leads, pa.int32())}

    return work


def _clear(score: Column, lead: Column, min_margin: float, min_lead: int) -> Column:
    return (score >= min_margin) & (lead >= min_lead)


def detect(
    docs: DataFrame, dictionaries: dict[str, bytes], key: str = "doc_id", text: str = "text", min_margin: float = MIN_MARGIN, min_lead: int = MIN_LEAD
) -> DataFrame:
    """``(key, held_out, lang_pred, score, rejected)``."""
    found = map_texts(docs, key, text, _work(dictionaries), FOUND)
    rejected = ~_clear(F.col("score"), F.col("lead"), min_margin, min_lead)
    return found.select(key, held_out(key).alias("held_out"), "lang_pred", "score", rejected.alias("rejected"))


def filter_language(docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text", min_margin: float = MIN_MARGIN, min_lead: int = MIN_LEAD) -> DataFrame:
    """``docs`` without the rows whose language is rejected; all columns as they were."""
    return judged(docs, text, _work(dictionaries), FOUND, lambda found: _clear(found["score"], found["lead"], min_margin, min_lead))
