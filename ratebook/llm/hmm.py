"""Hidden Markov language model trained with Baum-Welch, scored exactly.

Tokens are the text's words with A-Z lower-cased and one end per text. A
latent state emits a word class, a class emits a word:

    P(text) = sum over state paths of pi, A and P(class | state), times
              P(word | class) = (c + 1) / (C + V + 1)

with c, C, V the word's count, its class's count and distinct words in the
training texts; the remaining 1 / (C + V + 1) is the class's unknown word.
The ``OWN`` most frequent words are classes of their own (P = 1), all others
share a class by their last three bytes, the end is a class.

Training. Every training text counts: word counts are summed over all of
them, and in each of the ``PASSES`` passes Baum-Welch's expected counts are
made over all of them, per partition, and summed by Spark. A pass takes the
texts in ``BLOCKS`` blocks (by hash of the id) and improves the model after
each: the counts of a block replace those that it gave in the pass before, and
the model follows the sum over all blocks (incremental EM), so two passes
improve the model as often as ten rounds over all texts would.
Counting and scoring use the scaled recursions over the whole text, many texts
abreast, token by token. A text longer than ``DIRECT`` tokens in a batch of
fewer than ``ABREAST`` times its tokens multiplies the transfer matrices of its
pieces of ``PIECE`` tokens, which is the same recursion with more work: counting
carries the forward and backward vectors over the piece edges.

Scale. Broadcast are the model (states x classes) and the ``HOT`` most
frequent words of at most ``HOT_BYTES`` bytes (fewer where counts tie), both
bounded by parameters; counts of all rarer words stay
distributed and meet their texts in a join from which the hot words are gone.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratebook.llm.common import crc_class, prepare, staged

STATES = 8
OWN = 4_096
SUFFIXES = 1_024
HOT, HOT_BYTES = 131_072, 64
PASSES, BLOCKS = 2, 5
PIECE, DIRECT, ABREAST = 512, 4_096, 8
CHUNK_TOKENS, SPAN = 1_000_000, 16_384
EVERY = 8
FLUSH = 300_000
PRIOR = 50.0
END = ""


def split_words(text: str) -> list[bytes]:
    """A text's words as UTF-8 bytes, A-Z lower-cased, and the end."""
    words = text.encode().lower().split()
    words.append(b"")
    return words


def tokens(text: str) -> list[str]:
    return [w.decode() for w in split_words(text)]


def suffix_class(word: str | bytes) -> int:
    raw = word.encode() if isinstance(word, str) else word
    return OWN + xxhash.xxh64_intdigest(raw[-3:], 0) % SUFFIXES


N_CLASSES = OWN + SUFFIXES + 1


@dataclass
class Vocabulary:
    """Bounded part of the vocabulary and the class totals."""
    hot: dict[str, int]       # word -> rank
    hot_class: np.ndarray     # by rank
    hot_count: np.ndarray
    class_count: np.ndarray   # by class
    class_words: np.ndarray
    total: int
    distinct: int

    def denominator(self, cls):
        """C + V + 1 of shared classes; classes of one word have c + 1."""
        shared = (np.asarray(cls) >= OWN) & (np.asarray(cls) < OWN + SUFFIXES)
        return np.where(shared, self.class_count[cls] + self.class_words[cls] + 1.0, self.class_count[cls] + 1.0)


def count_words(texts: DataFrame) -> DataFrame:
    """(token, c) over all rows of (text)."""
    def count(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for pdf in it:
            for t in pdf["text"]:
                seen.update(t.encode().lower().split())
            seen[b""] += len(pdf)
            if len(seen) > FLUSH:
                yield pd.DataFrame({"token": [w.decode() for w in seen], "c": list(seen.values())})
                seen = Counter()
        yield pd.DataFrame({"token": pd.Series([w.decode() for w in seen], dtype=object),
                            "c": pd.Series(list(seen.values()), dtype="int64")})

    return texts.select("text").mapInPandas(count, "token string, c long").groupBy("token").agg(F.sum("c").alias("c"))


def vocabulary(words: DataFrame) -> Vocabulary:
    total, distinct = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    # All words with at least the smallest count that at most HOT words reach.
    least, reached = None, 0
    brief = words.where(F.octet_length("token") <= HOT_BYTES)
    for c, n in brief.groupBy("c").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("c")).limit(HOT).collect():
        reached += n
        if reached > HOT:
            break
        least = c
    top = brief.where(F.col("c") >= F.lit(least)).toPandas().sort_values(["c", "token"], ascending=[False, True])
    ranked = top["token"].tolist()
    own = {w: i for i, w in enumerate([w for w in ranked if w != END][:OWN])}

    def classed(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            yield pd.DataFrame({"cls": [OWN + SUFFIXES if w == END else own[w] if w in own else suffix_class(w)
                                        for w in pdf["token"]], "c": pdf["c"]})

    by_class = (words.mapInPandas(classed, "cls int, c long").groupBy("cls")
                .agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).toPandas())
    count, distinct_words = np.zeros(N_CLASSES), np.zeros(N_CLASSES)
    count[by_class["cls"]], distinct_words[by_class["cls"]] = by_class["c"], by_class["v"]
    cls = np.array([OWN + SUFFIXES if w == END else own[w] if w in own else suffix_class(w) for w in ranked], np.int64)
    return Vocabulary({w: i for i, w in enumerate(ranked)}, cls, top["c"].to_numpy(np.int64), count,
                      distinct_words, int(total), int(distinct))


# ------------------------------------------------------------ the model

@dataclass
class Model:
    start: np.ndarray   # (K,)
    move: np.ndarray    # (K, K)
    emit: np.ndarray    # (classes, K)


def _prior(vocab: Vocabulary) -> np.ndarray:
    q = vocab.class_count + 1.0
    return q / q.sum()


def initial(vocab: Vocabulary, states: int, seed: int = 7) -> Model:
    noise = np.random.default_rng(seed).normal(size=(N_CLASSES, states))
    emit = _prior(vocab)[:, None] * np.exp(0.5 * noise)
    return Model(np.full(states, 1 / states), np.eye(states) * 0.9 + 0.1 / states, emit / emit.sum(0))


def maximise(counts: dict, vocab: Vocabulary) -> Model:
    start, move, emit = counts["start"] + 0.1, counts["move"] + 0.1, counts["emit"] + PRIOR * _prior(vocab)[:, None]
    return Model(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def _padded(seqs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Class ids by time (T, n) and lengths; sequences sorted, longest first."""
    length = np.array([len(s) for s in seqs])
    obs = np.zeros((length[0], len(seqs)), np.int64)
    for i, s in enumerate(seqs):
        obs[:len(s), i] = s
    return obs, length


def _by_time(seqs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Class ids of all first tokens, then of all second ones and so on (no
    padding), lengths, sequences per time and where each time begins.
    Sequences sorted, longest first."""
    length = np.array([len(s) for s in seqs])
    live = len(seqs) - np.searchsorted(length[::-1], np.arange(length[0]), side="right")
    off = np.concatenate([[0], np.cumsum(live)])
    time = np.arange(off[-1]) - np.repeat(np.cumsum(length) - length, length)
    obs = np.empty(off[-1], np.int64)
    obs[off[time] + np.repeat(np.arange(len(seqs)), length)] = np.concatenate(seqs)
    return obs, length, live, off


def _spans(off: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of times of about SPAN tokens."""
    edges = [0]
    for t, end in enumerate(off[1:].tolist()):
        if t > edges[-1] and end - off[edges[-1]] > SPAN:
            edges.append(t)
    return list(zip(edges, [*edges[1:], len(off) - 1]))


def expected_counts(seqs: list[np.ndarray], model: Model, ahead_of: np.ndarray | None = None,
                    behind: np.ndarray | None = None) -> dict:
    """Baum-Welch counts of a batch of class sequences. For pieces inside a
    text, ``ahead_of`` has the forward vector of the token before and
    ``behind`` the backward vector at the last token, up to a factor.

    A class's emissions count up to a factor, so each has one as its largest;
    vectors are scaled every ``EVERY`` tokens."""
    order = sorted(range(len(seqs)), key=lambda i: -len(seqs[i]))
    obs, length, live_at, off_at = _by_time([seqs[i] for i in order])
    live, off, spans = live_at.tolist(), off_at.tolist(), _spans(off_at)
    n, k = len(seqs), len(model.start)
    emit = model.emit / model.emit.max(1, keepdims=True)
    before = None if ahead_of is None else ahead_of[order]
    alpha, ones, scale = np.empty((len(obs), k)), np.ones(k), {}
    for lo, hi in spans:
        base = off[lo]
        e = np.take(emit, obs[base:off[hi]], axis=0, mode="clip")
        for t in range(lo, hi):
            m, at = live[t], off[t]
            a = alpha[at:at + m]
            if t:
                np.matmul(alpha[off[t - 1]:off[t - 1] + m], model.move, out=a)
                a *= e[at - base:at - base + m]
            else:
                np.multiply(model.start if before is None else before @ model.move, e[:m], out=a)
            if t % EVERY == 0:
                scale[t] = s = (a @ ones)[:, None]
                a /= s

    ends = off_at[length - 1] + np.arange(n)
    last = np.ones((n, k)) if behind is None else behind[order]
    last = last / (alpha[ends] * last).sum(1, keepdims=True)
    ranked = np.argsort(ends)
    ends, last = ends[ranked], last[ranked]
    start, moves, emits = np.zeros(k), np.zeros((k, k)), np.zeros(N_CLASSES * k)
    back, states, carried = np.ascontiguousarray(model.move.T), np.arange(k), None
    for lo, hi in reversed(spans):
        base, stop = off[lo], off[hi]
        seen = obs[base:stop]
        ahead = np.take(emit, seen, axis=0, mode="clip")
        beta = np.empty((stop - base, k))
        x, y = np.searchsorted(ends, [base, stop])
        beta[ends[x:y] - base] = last[x:y]
        if carried is not None:
            beta[off[hi - 1] - base:off[hi - 1] - base + len(carried)] = carried
        for t in range(hi - 1, lo - 1, -1):
            at = off[t] - base
            h = ahead[at:at + live[t]]
            h *= beta[at:at + live[t]]
            if t % EVERY == 0:
                h /= scale[t]
            if t > lo:
                np.matmul(h, back, out=beta[off[t - 1] - base:off[t - 1] - base + live[t]])
            else:
                carried = h @ back
        inner = max(lo, 1)
        prev = np.arange(off[inner], stop) - np.repeat(live_at[inner - 1:hi - 1], live_at[inner:hi])
        moves += np.take(alpha, prev, axis=0, mode="clip").T @ ahead[off[inner] - base:]
        gamma = np.multiply(alpha[base:stop], beta, out=beta)
        emits += np.bincount(((seen * k)[:, None] + states).ravel(), weights=gamma.ravel(), minlength=len(emits))
        if lo == 0 and before is None:
            start += gamma[:n].sum(0)
        elif lo == 0:
            moves += before.T @ ahead[:n]
    return {"start": start, "move": moves * model.move, "emit": emits.reshape(-1, k)}


def all_counts(seqs: list[np.ndarray], model: Model) -> dict:
    """Baum-Welch counts of class sequences of any length."""
    sums = {"start": np.zeros(len(model.start)), "move": np.zeros(model.move.shape), "emit": np.zeros(model.emit.shape)}

    def add(*batch) -> None:
        for key, x in expected_counts(*batch).items():
            sums[key] += x

    order, alone = _by_length([len(s) for s in seqs])
    for lo, hi in _chunks([len(seqs[i]) for i in order]):
        add([seqs[i] for i in order[lo:hi]], model)
    for i in alone:
        pieces, first, ahead_of, behind, at_first = _edges(seqs[i], model)
        add([first], model, None, at_first)
        for lo, hi in _chunks([len(p) for p in pieces]):
            add(pieces[lo:hi], model, ahead_of[lo:hi], behind[lo:hi])
    return sums


def _by_length(lengths: list[int]) -> tuple[list[int], list[int]]:
    """Places of the sequences to run abreast, longest first, and of the long
    ones with too few tokens beside them for that."""
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    left, alone = sum(lengths), 0
    while alone < len(order) and lengths[order[alone]] > max(DIRECT, left // ABREAST):
        left -= lengths[order[alone]]
        alone += 1
    return order[alone:], order[:alone]


def _edges(seq: np.ndarray, model: Model) -> tuple:
    """A long text as its first token and pieces of the rest, with the forward
    vector before and the backward vector at the end of each piece."""
    k = len(model.start)
    pieces = [seq[i:i + PIECE] for i in range(1, len(seq), PIECE)]
    ahead_of, behind = np.empty((len(pieces), k)), np.ones((len(pieces), k))
    through, logs = [np.concatenate(x) for x in zip(*[
        _transfer(pieces[lo:lo + 256], model) for lo in range(0, len(pieces), 256)])]
    factor = 10 ** (logs - logs.max(1, keepdims=True))
    a = model.start * model.emit[seq[0]]
    for p in range(len(pieces)):
        ahead_of[p] = a = a / a.sum()
        a = (a * factor[p]) @ through[p]
    b = np.ones(k)
    for p in range(len(pieces) - 1, -1, -1):
        behind[p] = b
        b = factor[p] * (through[p] @ b)
        b = b / b.max()
    return pieces, seq[:1], ahead_of, behind, b[None, :]


def _transfer(pieces: list[np.ndarray], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Transfer matrix of each piece (all full but the last), its rows scaled
    to one, and the log10 of each row's scale."""
    k = len(model.start)
    obs, length = _padded(pieces)
    n = obs.shape[1]
    through = np.broadcast_to(np.eye(k), (n, k, k)).copy()
    logs = np.zeros((n, k))
    for t in range(len(obs)):
        m = int((length > t).sum())
        x = (through[:m].reshape(-1, k) @ model.move).reshape(m, k, k) * model.emit[obs[t, :m]][:, None, :]
        s = x.sum(2)
        logs[:m] += np.log10(s)
        through[:m] = x / s[:, :, None]
    return through, logs


def log_likelihoods(seqs: list[np.ndarray], model: Model) -> np.ndarray:
    """log10 P(class sequence), by the scaled forward recursion."""
    out = np.zeros(len(seqs))
    order, alone = _by_length([len(s) for s in seqs])
    for lo, hi in _chunks([len(seqs[i]) for i in order]):
        out[order[lo:hi]] = _abreast([seqs[i] for i in order[lo:hi]], model)
    for i in alone:
        out[i] = _by_transfer(seqs[i], model)
    return out


def _abreast(seqs: list[np.ndarray], model: Model) -> np.ndarray:
    """The same for sequences sorted by length, longest first. Vectors are
    scaled every ``EVERY`` tokens, for which doubles have room."""
    obs, length, live, off = _by_time(seqs)
    spans, live, off = _spans(off), [*live.tolist(), 0], off.tolist()
    n, k = len(length), len(model.start)
    total, ones, a, b = np.zeros(n), np.ones(k), np.empty((n, k)), np.empty((n, k))
    for lo, hi in spans:
        base = off[lo]
        e = np.take(model.emit, obs[base:off[hi]], axis=0, mode="clip")
        for t in range(lo, hi):
            m, end = live[t], live[t + 1]
            x = b[:m]
            if t:
                np.matmul(a[:m], model.move, out=x)
                x *= e[off[t] - base:off[t] - base + m]
            else:
                np.multiply(model.start, e[:m], out=x)
            if t % EVERY == 0:
                s = x @ ones
                total[:m] += np.log10(s)
                x /= s[:, None]
            if end < m:
                total[end:m] += np.log10(x[end:] @ ones)
            a, b = b, a
    return total


def _by_transfer(seq: np.ndarray, model: Model) -> float:
    """The same for one long sequence: pieces advance all start states at
    once, then the row vector runs through their transfer matrices."""
    k = len(model.start)
    body = seq[1:]
    pieces = [body[i:i + PIECE] for i in range(0, len(body), PIECE)]
    a = model.start * model.emit[seq[0]]
    total = np.log10(a.sum())
    a = a / a.sum()
    for lo in range(0, len(pieces), 256):
        through, logs = _transfer(pieces[lo:lo + 256], model)
        for j in range(len(through)):
            top = logs[j].max()
            a = (a * 10 ** (logs[j] - top)) @ through[j]
            total += top + np.log10(a.sum())
            a = a / a.sum()
    return float(total)


def _chunks(lengths: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of about CHUNK_TOKENS tokens."""
    lo, size = 0, 0
    for i, n in enumerate(lengths):
        if i > lo and size + n > CHUNK_TOKENS:
            yield lo, i
            lo, size = i, 0
        size += n
    if lo < len(lengths):
        yield lo, len(lengths)


# ------------------------------------------------------------ Spark

def _encoded(texts: DataFrame, vocab: Vocabulary) -> DataFrame:
    """(rid, doc_id, held_out, n_tokens, known, base, words, seq, rare, tf,
    cls): per text what its hot words contribute, its class sequence, its rare
    words (null: none) with their counts and classes."""
    def encode(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rank = {w.encode(): i for w, i in vocab.hot.items()}
        base_hot = np.log10((vocab.hot_count + 1.0) / (vocab.total + vocab.distinct + 1))
        word_hot = np.log10((vocab.hot_count + 1.0) / vocab.denominator(vocab.hot_class)) if len(rank) else np.zeros(0)
        hot_class = vocab.hot_class.astype("<u2")
        for pdf in it:
            out = []
            for text in pdf["text"]:
                words = split_words(text)
                at = np.fromiter(map(rank.get, words, repeat(-1)), np.int64, len(words))
                hot = at >= 0
                missing = np.flatnonzero(~hot).tolist()
                at = at[hot]
                seq = np.empty(len(words), "<u2")
                seq[hot] = hot_class[at]
                rare = Counter([words[i] for i in missing])
                cls = {w: OWN + SUFFIXES if not w else suffix_class(w) for w in rare}
                if missing:
                    seq[missing] = [cls[words[i]] for i in missing]
                # Words hold no blank, so one text carries them all.
                out.append((len(words), len(at), float(base_hot[at].sum()), float(word_hot[at].sum()), seq.tobytes(),
                            b" ".join(rare).decode() if rare else None, np.fromiter(rare.values(), np.int32, len(rare)),
                            np.fromiter(cls.values(), np.int32, len(rare))))
            got = pd.DataFrame(out, columns=["n_tokens", "known", "base", "words", "seq", "rare", "tf", "cls"])
            got.insert(0, "held_out", pdf["held_out"])
            got.insert(0, "doc_id", pdf["doc_id"].astype("Int64").to_numpy())
            yield got

    return texts.mapInPandas(encode, "doc_id long, held_out boolean, n_tokens long, known long, base double, "
                                     "words double, seq binary, rare string, tf array<int>, cls array<int>"
                             ).withColumn("rid", F.monotonically_increasing_id())


def _block_counts(train: DataFrame, model: Model) -> dict:
    """Baum-Welch counts of the texts of a block: per partition, summed by Spark."""
    def expect(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums, held, size = None, [], 0

        def add():
            nonlocal sums, held, size
            got = all_counts(held, model)
            sums = got if sums is None else {key: sums[key] + got[key] for key in got}
            held, size = [], 0

        for pdf in it:
            for raw in pdf["seq"]:
                seq = np.frombuffer(raw, "<u2").astype(np.int64)
                held.append(seq)
                size += len(seq)
                if size > 2 * CHUNK_TOKENS:
                    add()
        add()
        if sums is not None:
            for kind, x in sums.items():
                x = x.reshape(-1)
                full = np.flatnonzero(x)
                yield pd.DataFrame({"kind": kind, "i": full, "x": x[full]})

    counts = {"start": np.zeros(len(model.start)), "move": np.zeros(model.move.size), "emit": np.zeros(model.emit.size)}
    # At most (1 + states + classes) x states rows.
    rows = train.select("seq").mapInPandas(expect, "kind string, i long, x double").groupBy("kind", "i").agg(F.sum("x").alias("x"))
    for kind, part in rows.toPandas().groupby("kind"):
        counts[kind][part["i"]] = part["x"]
    return {"start": counts["start"], "move": counts["move"].reshape(model.move.shape),
            "emit": counts["emit"].reshape(model.emit.shape)}


def trained(train: DataFrame, vocab: Vocabulary, states: int) -> Model:
    """The model after ``PASSES`` passes over the blocks of ``train`` (seq, block)."""
    model, held = initial(vocab, states), {}
    for _ in range(PASSES):
        for block in range(BLOCKS):
            held[block] = _block_counts(train.where(F.col("block") == block), model)
            model = maximise({key: sum(c[key] for c in held.values()) for key in held[block]}, vocab)
    return model


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", states: int = STATES,
              modulus: int = 7, held_class: int = 2) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score (add-one unigram) and score, both log10 probabilities.

    Null and empty texts have the end token only. Rows with a null id are
    held out. Repeated rows count as often as they stand. Without any training
    text all words are unknown and scores come from the priors. Other columns
    are ignored."""
    prepare(docs.sparkSession)
    held = F.coalesce(crc_class(docs[id_col], modulus) == held_class, F.lit(True))
    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"),
                        held.alias("held_out"))
    words = staged(count_words(texts.where("not held_out")), "words")
    vocab = vocabulary(words)
    block = F.coalesce(F.pmod(F.xxhash64("doc_id"), F.lit(BLOCKS)), F.lit(0)).cast("int")
    rows = staged(_encoded(texts, vocab).withColumn("block", block), "sequences", by=["held_out", "block"])
    model = trained(rows.where("not held_out"), vocab, states)

    floor = vocab.total + vocab.distinct + 1
    below = F.array(*[F.lit(float(x)) for x in vocab.denominator(np.arange(OWN, N_CLASSES))])
    listed = F.arrays_zip(F.split("rare", " ", -1).alias("token"), "tf", "cls")
    rare = rows.where("rare is not null").select("rid", F.inline(listed))
    met = rare.join(words, "token", "left").withColumn("c1", F.coalesce("c", F.lit(0)) + 1)
    sums = met.groupBy("rid").agg(
        F.sum(F.when(F.col("c").isNotNull(), F.col("tf")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("tf") * F.log10(F.col("c1") / F.lit(float(floor)))).alias("rare_base"),
        F.sum(F.col("tf") * F.log10(F.col("c1") / F.element_at(below, F.col("cls") - OWN + 1))).alias("rare_words"))

    def forward(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0

        def add() -> Iterator[pd.DataFrame]:
            nonlocal held, size
            path = log_likelihoods([np.frombuffer(s, "<u2").astype(np.int64) for pdf in held for s in pdf["seq"]], model)
            for pdf in held:
                yield pdf.drop(columns="seq").assign(path=path[:len(pdf)])
                path = path[len(pdf):]
            held, size = [], 0

        for pdf in it:
            held.append(pdf)
            size += int(pdf["n_tokens"].sum())
            if size > 2 * CHUNK_TOKENS:
                yield from add()
        yield from add()

    scored = rows.drop("rare", "tf", "cls", "block").mapInPandas(forward, "doc_id long, held_out boolean, n_tokens long, known long, "
                                                    "base double, words double, rid long, path double")
    zero = F.lit(0.0)
    return scored.join(sums, "rid", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(vocab.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", zero)).alias("base_score"),
        (F.col("path") + F.col("words") + F.coalesce("rare_words", zero)).alias("score"))
