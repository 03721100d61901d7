"""Language identification by compression.

Each language has a zstandard raw-content dictionary made of pieces of its
training texts. A text is encoded with every dictionary; the language whose
dictionary gives the fewest bytes is the prediction, and the prediction counts
as rejected when its lead over the next language is narrow.

What is encoded is the lower-cased text with everything but letters and marks
taken as one space, and a word that repeats at once written once. It is encoded
whole, in blocks of ``BLOCK`` bytes that each start from the dictionary alone,
so a long text stays a test of the dictionaries instead of its own history and
needs no more memory than a short one.

The dictionaries are fitted on at most ``SAMPLE`` texts of each language, those
with the smallest id hashes, ``PIECE`` code points from the middle of each and
at most ``DICTIONARY`` bytes in all. They travel with the tasks: languages are
few, and more than ``LANGUAGES`` of them is an error. How common a language is
(over all training rows) decides equal sizes and enters the score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratebook.llm.common import prepare

SAMPLE = 256
PIECE = 400
DICTIONARY = 32_768
LANGUAGES = 1_000
BLOCK = 4_096
LEVEL = 7
MARGIN = 0.01
UNKNOWN = "und"


@dataclass
class Model:
    languages: list[str]
    dictionaries: list[bytes]
    shares: np.ndarray


def letters(text: Column) -> Column:
    """Lower-cased words of letters and marks, each followed by a space, a run
    of one word written once; empty for null."""
    words = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}]+", " ")
    return F.regexp_replace(F.ltrim(F.concat(F.trim(words), F.lit(" "))), r"(?<![^ ])([^ ]++ )\1++", "$1").alias("letters")


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        sample: int = SAMPLE) -> Model:
    """Dictionaries from the labelled rows of ``docs``. Rows with a null text or
    language teach nothing; a language without a letter in its sample is still
    learned, with an empty dictionary. No usable row gives a model without
    languages."""
    prepare(docs.sparkSession)
    text = docs[text_col]
    middle = F.substr(text, F.greatest(F.lit(1), (F.length(text) - 2 * PIECE) / 2).cast("int"), F.lit(2 * PIECE))
    rows = docs.where(text.isNotNull() & docs[lang_col].isNotNull()).select(
        docs[lang_col].cast("string").alias("lang"), F.xxhash64(docs[id_col]).alias("o"), middle.alias("piece"))
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(LANGUAGES + 1).collect()
    if len(counts) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages: is {lang_col} a language column?")
    # Four times the share of hashes that holds ``sample`` rows, so few rows
    # of a common language travel; the rank limit, taken in every input
    # partition first, makes it at most ``sample``.
    spark = docs.sparkSession
    below = [(r.lang, 2 ** 64 * min(4 * sample, r.n) // r.n - 2 ** 63 - 1) for r in counts]
    bound = spark.createDataFrame(below, "lang string, below long")
    first = Window.partitionBy("lang").orderBy("o", "piece")
    chosen = (rows.join(F.broadcast(bound), "lang").where(F.col("o") <= F.col("below"))
              .withColumn("at", F.row_number().over(first)).where(F.col("at") <= sample))
    # At most LANGUAGES * sample pieces of bounded length.
    pieces = chosen.select("lang", "at", F.substr(letters(F.col("piece")), F.lit(1), F.lit(PIECE)).alias("piece")).collect()
    said: dict[str, list[tuple[int, str]]] = {r.lang: [] for r in counts}
    for r in pieces:
        said[r.lang].append((r.at, r.piece))
    languages = sorted(said)
    texts = ["".join(dict.fromkeys(p for _, p in sorted(said[x]))) for x in languages]
    n = {r.lang: r.n for r in counts}
    shares = np.array([n[x] for x in languages], float)
    return Model(languages, [t.encode("utf-8", "replace")[:DICTIONARY] for t in texts], shares / max(shares.sum(), 1.0))


class Sizes:
    """Encoded sizes of texts under every dictionary of a model."""

    def __init__(self, model: Model):
        self.encoders = []
        for content in model.dictionaries:
            given = {}
            if len(content) >= 8:  # shorter raw contents are no dictionary to zstandard
                own = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                own.precompute_compress(level=LEVEL)
                given["dict_data"] = own
            self.encoders.append(zstandard.ZstdCompressor(
                level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False, **given))

    def __call__(self, texts: list[bytes]) -> np.ndarray:
        """(texts, dictionaries) bytes; an empty text has size 0."""
        blocks = [t[i:i + BLOCK] for t in texts for i in range(0, len(t), BLOCK)]
        owner = np.repeat(np.arange(len(texts)), [-(-len(t) // BLOCK) for t in texts])
        out = np.zeros((len(texts), len(self.encoders)), np.int64)
        if blocks:
            for j, encoder in enumerate(self.encoders):
                got = encoder.multi_compress_to_buffer(blocks)
                np.add.at(out[:, j], owner, [len(x) for x in got])
        return out


def choose(sizes: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row: index of the smallest size (equal sizes: the more common
    language, then the first name), score, and the lead over the next size as a
    share of it. The score is the language's share among all, each weighed
    down by a factor of two for every byte it needs more."""
    order = np.lexsort((np.arange(len(model.shares)), -model.shares))
    best = order[np.argmin(sizes[:, order], axis=1)]
    least = sizes[np.arange(len(sizes)), best]
    weight = model.shares * np.exp2(-np.minimum(sizes - least[:, None], 500))
    score = weight[np.arange(len(sizes)), best] / weight.sum(axis=1)
    if sizes.shape[1] == 1:
        return best, score, np.ones(len(sizes))
    second = np.partition(sizes, 1, axis=1)[:, 1]
    return best, score, (second - least) / np.maximum(second, 1)


def identify(docs: DataFrame, model: Model, text_col: str = "text", margin: float = MARGIN) -> DataFrame:
    """``docs`` with one column ``language``: a struct of lang, score (0 to 1),
    margin and rejected (margin below ``margin``). lang keeps the smallest
    dictionary's language also where it is rejected, for the caller to decide.

    A null text, a text without a letter, and every text of a model without
    languages get ``und``, score 0, margin 0, rejected. Rows and other columns
    stay; equal texts get equal results."""
    prepare(docs.sparkSession)
    known = F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"), F.lit(0.0).alias("margin"),
                     F.lit(True).alias("rejected"))
    if not model.languages:
        return docs.withColumn("language", known)

    @F.pandas_udf("lang string, score double, margin double")
    def smallest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        measure, names = Sizes(model), np.array(model.languages, object)
        for texts in batches:
            best, score, lead = choose(measure([t.encode("utf-8", "replace") for t in texts]), model)
            yield pd.DataFrame({"lang": names[best], "score": score, "margin": lead})

    text = docs[text_col]
    out = docs.withColumn("language", smallest(letters(text)))
    got = F.struct(F.col("language.lang").alias("lang"), F.col("language.score").alias("score"),
                   F.col("language.margin").alias("margin"), (F.col("language.margin") < margin).alias("rejected"))
    has_letter = F.coalesce(out[text_col].rlike(r"\p{L}"), F.lit(False))
    return out.withColumn("language", F.when(has_letter, got).otherwise(known))
