"""Byte-level BPE encoding by tree concatenation, and decoding.

A text of at most ``leaf_chars`` code points is one leaf. A longer one is
halved, wherever the middle falls, until its pieces are leaves; leaves are
encoded in parallel, and pairs of neighbours are joined level by level.

A join is exact. Everything left of the last word boundary that the left
half alone decides stays; from there the text is split into words again, over
the join, until a boundary falls on one of the right half's own; from there
the right half's ids stay, as splitting only looks ahead. In a word that runs
over the join without a boundary (long unsplit text), windows of 4, 8, 16...
ids on either side are encoded anew until the window's first and last id are
those already there. Then each neighbouring pair of ids stands in some exact
encoding, and a BPE sequence whose neighbouring pairs are all exact is the
encoding of its whole text.

The tokenizer is a file in the tokenizers library's JSON format, given by
path; it is read on the driver and travels with the tasks (a vocabulary file
is a few MB). Ids are those the library gives without added special tokens;
the strings of special tokens in a text become their ids, as there.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratebook.llm.common import prepare

LEAF_CHARS = 1 << 15
# Fixed value: the published word pattern of byte-level BPE.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# A boundary is decided by at most this many code points behind it.
LOOK = 3


def _byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the file."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Tokenizer:
    """Encoder and decoder of one tokenizer file (its JSON text)."""

    def __init__(self, file_text: str):
        spec = json.loads(file_text)
        model, split = spec["model"], spec["pre_tokenizer"] or {}
        if model["type"] != "BPE" or split.get("type") != "ByteLevel" or split.get("add_prefix_space") \
                or not split.get("use_regex", True) or spec.get("normalizer") or spec.get("post_processor"):
            raise ValueError("a byte-level BPE without normaliser, prefix space and post-processor is needed")
        merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if any(a >= b for a, b in zip(merged, merged[1:])):
            raise ValueError("ids that follow the order of merges are needed")
        alphabet = _byte_alphabet()
        special = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        ranks = {bytes(alphabet[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
        self.words = regex.compile(WORDS)
        self.ranks = ranks
        self.special = special
        self.bytes_of = {i: t for t, i in ranks.items()} | {i: t.encode() for t, i in special.items()}
        self.length = np.zeros(max(self.bytes_of) + 1, np.int64)
        for i, t in self.bytes_of.items():
            self.length[i] = len(t)
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") \
            if special else None

    @cached_property
    def by_words(self) -> tiktoken.Encoding:
        return tiktoken.Encoding("words", pat_str=WORDS, mergeable_ranks=self.ranks, special_tokens={})

    @cached_property
    def unsplit(self) -> tiktoken.Encoding:
        return tiktoken.Encoding("unsplit", pat_str=r"[\s\S]+", mergeable_ranks=self.ranks, special_tokens={})

    def parts(self, text: str) -> list[str]:
        """The text cut at special tokens: plain, special, plain, ..."""
        return self.at_special.split(text) if self.at_special and any(s in text for s in self.special) else [text]

    def encode(self, text: str) -> list[int]:
        ids = []
        for i, part in enumerate(self.parts(text)):
            if i % 2:
                ids.append(self.special[part])
            else:
                ids += self.by_words.encode_ordinary(part)
        return ids

    def decode(self, ids: np.ndarray) -> str:
        table = self.bytes_of
        return b"".join([table[i] for i in ids.tolist()]).decode("utf-8", "replace")

    # -------------------------------------------------- tree concatenation

    def decided(self, text: str, start: int = 0) -> int:
        """The last boundary, from ``start`` on, that text added behind can't move."""
        last = start
        for m in self.words.finditer(text, start):
            if m.end() > len(text) - LOOK:
                break
            last = m.end()
        return last

    def join_unsplit(self, left: list[int], right: list[int]) -> list[int]:
        """Ids of one word from the ids of its halves."""
        k = 4
        while True:
            a, b = left[-k:], right[:k]
            window = b"".join(self.bytes_of[i] for i in a + b)
            all_left, all_right = len(a) == len(left), len(b) == len(right)
            try:
                ids = self.unsplit.encode_ordinary(window.decode())
            except UnicodeDecodeError:  # the window cuts a code point
                ids = None
            if ids is not None and (all_left or ids[0] == a[0]) and (all_right or ids[-1] == b[-1]):
                return left[:len(left) - len(a)] + ids + right[len(b):]
            if all_left and all_right:
                raise ValueError("ids that do not encode a text")
            k *= 2

    def _ids_before(self, ids: np.ndarray, n_bytes: int) -> int:
        """How many ids the first ``n_bytes`` bytes take."""
        return int(np.searchsorted(np.cumsum(self.length[ids]), n_bytes, side="left")) + 1 if n_bytes else 0

    def join(self, lt: str, li: np.ndarray, last: int, rt: str, ri: np.ndarray, r_last: int):
        """(text, ids, last decided boundary) of two neighbours."""
        tail = lt[last:]
        joint, cut = tail + rt, len(tail)
        own = (m.end() for m in self.words.finditer(rt))
        mine, middle, ends = 0, [], []
        for m in self.words.finditer(joint):
            middle.append(m.span())
            ends.append(last + m.end())
            at = m.end() - cut
            while mine < at:
                mine = next(own, len(rt))
            if at >= 0 and mine == at:
                break
        stop = middle[-1][1] - cut if middle else 0
        l_keep = self._ids_before(li, len(lt[:last].encode()))
        r_skip = self._ids_before(ri, len(rt[:stop].encode()))
        ids = []
        for a, b in middle:
            if a < cut < b and b - a > 64:
                halves = []
                for part, known in ((joint[a:cut], li[self._ids_before(li, len(lt[:last + a].encode())):]),
                                    (joint[cut:b], ri[:r_skip])):
                    whole = self.words.match(part)
                    halves.append(known.tolist() if whole and whole.end() == len(part)
                                  and int(self.length[known].sum()) == len(part.encode())
                                  else self.unsplit.encode_ordinary(part))
                ids += self.join_unsplit(*halves)
            else:
                ids += self.unsplit.encode_ordinary(joint[a:b])
        text = lt + rt
        if r_last >= stop:
            new_last = len(lt) + r_last
        else:
            new_last = max([last, *(e for e in ends if e <= len(text) - LOOK)])
        return text, np.concatenate([li[:l_keep], np.array(ids, "<u4"), ri[r_skip:]]).astype("<u4"), new_last


def _leaves(text: str, leaf_chars: int) -> list[str]:
    """Halves of halves, until each has at most ``leaf_chars`` code points."""
    n = 1 << max(0, math.ceil(math.log2(len(text) / leaf_chars))) if len(text) > leaf_chars else 1
    cuts = [len(text) * i // n for i in range(n + 1)]
    return [text[a:b] for a, b in zip(cuts, cuts[1:])]


def _long_ids(rows: DataFrame, file_text: str, leaf_chars: int, longest: int) -> DataFrame:
    """(doc_id, th, ids) of the texts over a leaf, by tree concatenation."""
    key = "doc_id long, th long, part int, special int, leaf int, text string, ids binary, last int"

    def cut(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tok = Tokenizer(file_text)
        for pdf in it:
            for d, th, text in zip(pdf["doc_id"], pdf["th"], pdf["text"]):
                out = []
                for p, part in enumerate(tok.parts(text)):
                    if p % 2:
                        out.append((p, tok.special[part], 0, ""))
                    else:
                        out += [(p, -1, i, t) for i, t in enumerate(_leaves(part, leaf_chars))]
                got = pd.DataFrame(out, columns=["part", "special", "leaf", "text"])
                got.insert(0, "th", th)
                got.insert(0, "doc_id", pd.Series([d] * len(got), dtype="Int64"))
                yield got

    def encode(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tok = Tokenizer(file_text)
        for pdf in it:
            ids = [np.array([s] if s >= 0 else tok.by_words.encode_ordinary(t), "<u4").tobytes()
                   for s, t in zip(pdf["special"], pdf["text"])]
            yield pdf.assign(ids=ids, last=[tok.decided(t) for t in pdf["text"]])

    made: list[Tokenizer] = []  # one per task, filled there

    def joined(pdf: pd.DataFrame) -> pd.DataFrame:
        if len(pdf) == 1:
            return pdf.assign(leaf=pdf["leaf"] // 2)
        if not made:
            made.append(Tokenizer(file_text))
        tok = made[0]
        a, b = pdf.sort_values("leaf").itertuples(index=False)
        text, ids, last = tok.join(a.text, np.frombuffer(a.ids, "<u4"), a.last,
                                   b.text, np.frombuffer(b.ids, "<u4"), b.last)
        out = pdf.iloc[:1].copy()
        out["leaf"], out["text"], out["ids"], out["last"] = a.leaf // 2, text, [ids.tobytes()], last
        return out

    now = rows.dropDuplicates(["doc_id", "th"]).mapInPandas(
        cut, "doc_id long, th long, part int, special int, leaf int, text string")
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    now = now.repartition(n, "doc_id", "th", "part", "leaf").mapInPandas(encode, key)
    for _ in range(max(0, math.ceil(math.log2(longest / leaf_chars)))):
        now = now.groupBy("doc_id", "th", "part", F.floor(F.col("leaf") / 2).alias("up")).applyInPandas(joined, key)
    return now.groupBy("doc_id", "th").agg(F.array_sort(F.collect_list(F.struct("part", "ids"))).alias("p")).select(
        "doc_id", "th", F.aggregate("p", F.lit(b""), lambda s, x: F.concat(s, x["ids"])).alias("ids"))


def encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
           leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """(doc_id, ids): one row per document, ids as little-endian unsigned
    32-bit integers in a binary column. Null and empty texts have no ids;
    repeated rows and null ids stay as rows; other columns are ignored."""
    prepare(docs.sparkSession)
    with open(tokenizer_path, encoding="utf-8") as f:
        file_text = f.read()
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))

    def batches(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tok = None
        for pdf in it:
            tok = tok or Tokenizer(file_text)
            yield pd.DataFrame({"doc_id": pdf["doc_id"],
                                "ids": [np.array(tok.encode(t), "<u4").tobytes() for t in pdf["text"]]})

    short = rows.where(F.length("text") <= leaf_chars).mapInPandas(batches, "doc_id long, ids binary")
    longest = rows.agg(F.max(F.length("text"))).first()[0] or 0
    if longest <= leaf_chars:
        return short
    long = rows.where(F.length("text") > leaf_chars).withColumn("th", F.xxhash64("text"))
    found = _long_ids(long, file_text, leaf_chars, longest).select(F.col("doc_id").alias("d"), F.col("th").alias("t"), "ids")
    each = long.select("doc_id", "th").join(found, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t")))
    return short.union(each.select("doc_id", "ids"))


def decode(encoded: DataFrame, tokenizer_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ids (special tokens included) added."""
    prepare(encoded.sparkSession)
    with open(tokenizer_path, encoding="utf-8") as f:
        file_text = f.read()

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tok = None
        for ids in batches:
            tok = tok or Tokenizer(file_text)
            yield pd.Series([tok.decode(np.frombuffer(x, "<u4")) for x in ids], dtype=object)

    return encoded.withColumn(out_col, text(F.col(ids_col)))
