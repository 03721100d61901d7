"""Fill-in-the-middle transformation with code point cuts found by SWAR.

Each text is cut at two points drawn from a hash of its id, and its prefix,
middle and suffix are written behind sentinels as prefix-suffix-middle (psm)
or suffix-prefix-middle (spm); a share of the texts stays plain.

Cuts count code points, but no text is decoded to find them. A whole Arrow
batch is one UTF-8 buffer, viewed as uint64 words: the bytes that end a code
point (the next byte is not 10xxxxxx) are marked arithmetically, eight at a
time, ``bitwise_count`` gives the marks of each word and one cumulative sum
the rank of every word. A cut is a search of the word in that sum, then a
select of the mark inside the word. Arrow batches are bounded in bytes
(``common.ARROW_BYTES``), so what a task holds does not grow with its input; a
text longer than that is a batch of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratebook.llm.common import ids_and_texts, prepare

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
HIGH = np.uint64(0x8080808080808080)
FIELDS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


class UnitIndex:
    """Rank and select of code points in a UTF-8 buffer, by uint64 words."""

    def __init__(self, data: bytes | memoryview):
        words = np.zeros(len(data) // 8 + 2, "<u8")
        words.view(np.uint8)[:len(data)] = np.frombuffer(data, np.uint8)
        # Bit 7 of a byte: set where a code point starts (not 10xxxxxx).
        starts = ~(words & ~(words << np.uint64(1))) & HIGH
        # A byte ends a code point where the next byte, of this word or the
        # following one, starts one; the zero bytes behind the end do too.
        self.ends = starts[:-1] >> np.uint64(8) | starts[1:] << np.uint64(56)
        self.before = np.zeros(len(self.ends) + 1, np.int64)
        np.cumsum(np.bitwise_count(self.ends), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Code points that end before byte ``at``."""
        word, byte = at >> 3, (at & 7).astype(np.uint64)
        below = (np.uint64(1) << (byte * np.uint64(8))) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.ends[word] & below)

    def select(self, count: np.ndarray) -> np.ndarray:
        """Byte offset behind the ``count``-th code point (0: offset 0)."""
        word = np.searchsorted(self.before, count, side="left") - 1
        word = np.maximum(word, 0)
        left = count - self.before[word]
        marks = (self.ends[word][:, None] >> np.arange(7, 64, 8, dtype=np.uint64)) & np.uint64(1)
        byte = np.argmax(np.cumsum(marks, axis=1) >= left[:, None], axis=1)
        return np.where(count == 0, 0, word * 8 + byte + 1)


def hashes(seed: int, doc_id: int | None) -> list[int]:
    """The first four 8-digit groups of sha256("seed:id"); a null id is empty text."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i:i + 4], "big") for i in (0, 4, 8, 12)]


def _checked(sentinels: tuple[str, str, str]) -> None:
    """Sentinels can be told from text on both sides if the first character of
    each stands nowhere else in any of them."""
    first = {s[:1] for s in sentinels}
    if "" in first or len(set(sentinels)) < 3 or any(c in s[1:] for c in first for s in sentinels):
        raise ValueError("sentinels must differ, and their first characters must stand only at their beginning")


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1,
                   fim_percent: int = 90, spm_percent: int = 20,
                   sentinels: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output), one row per row
    of ``docs``; n counts code points.

    A null text is the empty one; an empty text, or one that holds a sentinel,
    stays plain, with null prefix_chars and middle_chars. Null ids draw from
    the hash of the empty id. Repeated rows each give their row. Other columns
    stay behind. An empty table gives no rows."""
    prepare(docs.sparkSession)
    _checked(sentinels)
    p, s, m = (x.encode() for x in sentinels)

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.large_string())
        size = len(texts)
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + size + 1]
        data = memoryview(texts.buffers()[2] or b"")[offsets[0]:offsets[-1]]
        start, stop = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]
        index = UnitIndex(data)
        before = index.rank(start)
        n = index.rank(stop) - before
        draw = np.array([hashes(seed, i) for i in ids], np.int64).reshape(size, 4)
        at = np.sort(draw[:, :2] % (n + 1)[:, None], axis=1)
        low, high = index.select(before + at[:, 0]), index.select(before + at[:, 1])
        forms, out = [], []
        for i in range(size):
            text = bytes(data[start[i]:stop[i]])
            if not text or draw[i, 2] % 100 >= fim_percent or p in text or s in text or m in text:
                forms.append("plain")
                out.append(text)
                continue
            a, b = low[i] - start[i], high[i] - start[i]
            if draw[i, 3] % 100 < spm_percent:
                forms.append("spm")
                out.append(b"".join((s, text[b:], p, text[:a], m, text[a:b])))
            else:
                forms.append("psm")
                out.append(b"".join((p, text[:a], s, text[b:], m, text[a:b])))
        plain = np.array([f == "plain" for f in forms], bool)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n), pa.array(forms, pa.string()), pa.array(at[:, 0], mask=plain),
             pa.array(at[:, 1] - at[:, 0], mask=plain), pa.array(out, pa.binary()).cast(pa.string())],
            names=[f.split()[0] for f in FIELDS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield cut(batch)

    return ids_and_texts(docs, id_col, text_col).mapInArrow(run, FIELDS)


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> Column:
    """The exact text that ``output`` of that ``form`` was made from; null for
    a null output or an unknown form."""
    _checked(sentinels)
    parts = F.split(output, "|".join(f"\\Q{s}\\E" for s in sentinels), -1)
    first, second, middle = parts[1], parts[2], parts[3]
    return (F.when(form == "plain", output)
            .when(form == "psm", F.concat(first, middle, second))
            .when(form == "spm", F.concat(second, middle, first)))
