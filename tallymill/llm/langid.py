"""Language identification by compression with per-language zstandard dictionaries.

A text is compressed once with each language's raw-content dictionary; the smallest output wins.
Texts are cut into pieces that start from the dictionary alone, so that the language and not the
text's own earlier parts decides, whatever its length. Case is ignored.
"""

from __future__ import annotations

import math

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F

#: The fit's bounds: texts per language, characters of each, and bytes of a dictionary.
SAMPLE_TEXTS = 256
SAMPLE_CHARS = 2_000
DICTIONARY_BYTES = 110 << 10
#: Bytes compressed at once, and the zstandard levels for texts and for those of few bytes.
PIECE = 2048
LEVEL = 5
SHORT = 512
SHORT_LEVEL = 19
#: A prediction is rejected if the second language needs less than this share more bytes.
MARGIN = 0.002
#: Extra bytes that divide a language's likelihood by e.
SHARPNESS = 8.0
NONE = "und"

_LETTER = regex.compile(r"\p{L}")


def fit(docs: DataFrame, text_column: str = "text", lang_column: str = "lang") -> dict[str, bytes]:
    """A dictionary per language from a bounded sample of the labelled rows of ``docs``.

    The sample takes the ``SAMPLE_TEXTS`` different texts of a language that come first by hash
    and their first ``SAMPLE_CHARS`` characters; a dictionary has a share of each of them. Labels are a closed set of language names.
    """
    rows = docs.where(F.col(lang_column).isNotNull() & F.col(text_column).rlike(r"\p{L}"))
    rows = rows.select(F.col(lang_column).alias("lang"), F.col(text_column).alias("text"), F.xxhash64(text_column).alias("h"))
    hashes = rows.select("lang", "h").distinct()
    first = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    chosen = hashes.withColumn("n", first).where(F.col("n") <= SAMPLE_TEXTS).select("lang", "h")
    found = rows.join(F.broadcast(chosen), ["lang", "h"]).groupBy("lang", "h").agg(F.min(F.substring("text", 1, SAMPLE_CHARS)).alias("text"))
    texts: dict[str, list[bytes]] = {}
    for row in found.orderBy("lang", "h").collect():
        texts.setdefault(row.lang, []).append(row.text.lower().encode())
    return {lang: _shared_out(parts, DICTIONARY_BYTES) for lang, parts in texts.items()}


def _shared_out(parts: list[bytes], most: int) -> bytes:
    """The beginnings of all parts, a line each: equal shares of ``most`` bytes, with what short parts leave going to the others."""
    left, ends = most - len(parts) + 1, [0] * len(parts)
    for n, i in enumerate(sorted(range(len(parts)), key=lambda i: len(parts[i]))):
        ends[i] = min(len(parts[i]), left // (len(parts) - n))
        left -= ends[i]
    return b"\n".join(part[:end] for part, end in zip(parts, ends))


def _compressors(content: bytes, level: int):
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(level=level)
    return zstandard.ZstdCompressor(dict_data=dictionary, write_checksum=False, write_content_size=False, write_dict_id=False).compress


class _Languages:
    def __init__(self, dictionaries: dict[str, bytes]):
        self.names = sorted(dictionaries)
        self.by_level = [[_compressors(dictionaries[name], level) for name in self.names] for level in (LEVEL, SHORT_LEVEL)]

    def decide(self, text: str | None) -> tuple[str, float, float]:
        """Language, score and margin of one text."""
        if not self.names or text is None or not _LETTER.search(text):
            return NONE, 0.0, 0.0
        data = text.lower().encode()
        pieces = [data[at : at + PIECE] for at in range(0, len(data), PIECE)]
        sizes = [sum(len(c(p)) for p in pieces) for c in self.by_level[len(data) <= SHORT]]
        order = sorted(range(len(sizes)), key=lambda i: (sizes[i], i))
        best = sizes[order[0]]
        score = 1 / sum(math.exp(max(-700.0, (best - s) / SHARPNESS)) for s in sizes)
        margin = (sizes[order[1]] - best) / best if len(order) > 1 else 1.0
        return self.names[order[0]], score, margin


def identify(text: Column, dictionaries: dict[str, bytes], margin: float = MARGIN) -> Column:
    """struct(lang_pred, score, rejected) of a text column.

    ``lang_pred`` is the language whose dictionary compresses the whole text best (ties: the
    first name) and ``score`` its share of the likelihood, 0 to 1. A text that is null or has no
    letter, or any text if nothing was learned, is ``und`` with score 0. ``rejected`` marks
    ``und`` and texts for which the second language is less than ``margin`` behind.
    """
    made = []

    @F.arrow_udf("lang_pred string, score double, rejected boolean")
    def predict(texts: pa.Array) -> pa.Array:
        if not made:
            made.append(_Languages(dictionaries))
        found = [made[0].decide(t.as_py()) for t in texts]
        names, scores, margins = zip(*found) if found else ((), (), ())
        rejected = [n == NONE or m < margin for n, m in zip(names, margins)]
        fields = [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())]
        return pa.StructArray.from_arrays(fields, ["lang_pred", "score", "rejected"])

    return predict(text)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text leaves 1 modulo 3. Null ids are not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))
