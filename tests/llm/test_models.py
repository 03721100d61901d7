"""Language model, toxicity, search, URL filter, BPE, PII, decontamination."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import regex

from ratebook.llm import bpe, decontaminate, hmm, sanitise, topk_search, toxicity, url_filter
from ratebook.llm.queries import RULES, default_tokenizer


# ------------------------------------------------------------ language model

def some_docs(n=120):
    rnd = random.Random(4)
    tongues = [["the", "of", "and", "house", "walk"], ["le", "et", "maison", "la", "que"]]
    return [(i, " ".join(rnd.choice(tongues[i % 2]) if rnd.random() < .9 else f"r{rnd.randint(0, 99)}"
                         for _ in range(rnd.randint(0, 80)))) for i in range(n)]


def test_lm_base_and_score(docs):
    rows = some_docs() + [(500, None), (501, "THE le")]
    got = {r.doc_id: r for r in hmm.lm_scores(docs(rows)).collect()}
    words = {d: hmm.tokens(t or "") for d, t in rows}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in words}
    count = collections.Counter(w for d, ws in words.items() if not held[d] for w in ws)
    total, distinct = sum(count.values()), len(count)
    for d, ws in words.items():
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[d], len(ws), sum(w in count for w in ws), total)
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 1) / (total + distinct + 1)) for w in ws))
        assert -1e9 < r.score < 0
    out = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_forward_recursion_is_exact():
    rnd = np.random.default_rng(2)
    k = 3
    emit = rnd.random((hmm.N_CLASSES, k))
    model = hmm.Model(np.full(k, 1 / k), rnd.dirichlet(np.ones(k), k), emit / emit.sum(0))
    seqs = [rnd.integers(0, hmm.N_CLASSES, n) for n in (1, 5, 700, hmm.DIRECT + 900)]

    def plain(seq):
        a, total = model.start * model.emit[seq[0]], 0.0
        for c in seq[1:]:
            total += math.log10(a.sum())
            a = (a / a.sum()) @ model.move * model.emit[c]
        return total + math.log10(a.sum())
    assert hmm.log_likelihoods(seqs, model) == pytest.approx([plain(s) for s in seqs])


def test_baum_welch_raises_the_likelihood(monkeypatch):
    rnd = np.random.default_rng(3)
    vocab = hmm.Vocabulary({}, np.zeros(0, int), np.zeros(0, int), np.zeros(hmm.N_CLASSES), np.zeros(hmm.N_CLASSES), 0, 0)
    monkeypatch.setattr(hmm, "PRIOR", 1.0)
    seqs = [np.where(rnd.random(60) < .9, rnd.integers(0, 10, 60), rnd.integers(0, 200, 60)) + 100 * (i % 2) for i in range(40)]
    model, last = hmm.initial(vocab, 2), -np.inf
    for _ in range(6):
        now = hmm.log_likelihoods(seqs, model).sum()
        assert now > last - 1
        last, model = now, hmm.maximise(hmm.expected_counts(seqs, model), vocab)


def test_counts_carry_over_piece_edges():
    rnd = np.random.default_rng(5)
    k = 3
    emit = rnd.random((hmm.N_CLASSES, k))
    model = hmm.Model(rnd.dirichlet(np.ones(k)), rnd.dirichlet(np.ones(k), k), emit / emit.sum(0))
    seqs = [rnd.integers(0, 50, n) for n in (1, 900, hmm.DIRECT + 1, hmm.DIRECT + 777)]
    got, want = hmm.all_counts(seqs, model), [hmm.expected_counts([s], model) for s in seqs]
    for key in got:
        assert got[key] == pytest.approx(sum(w[key] for w in want), rel=2e-3, abs=2e-3)
    assert got["start"].sum() == pytest.approx(4, abs=1e-3)
    assert got["move"].sum() == pytest.approx(sum(len(s) - 1 for s in seqs), rel=1e-4)


def some_model(k, seed):
    rnd = np.random.default_rng(seed)
    emit = rnd.random((hmm.N_CLASSES, k)) ** 6  # some words all but rule a state out
    return rnd, hmm.Model(rnd.dirichlet(np.ones(k)), rnd.dirichlet(np.ones(k), k), emit / emit.sum(0))


def plain_counts(seqs, model):
    """Baum-Welch, one text and one token at a time."""
    k = len(model.start)
    out = {"start": np.zeros(k), "move": np.zeros((k, k)), "emit": np.zeros((hmm.N_CLASSES, k))}
    for seq in seqs:
        alpha = []
        for t, c in enumerate(seq):
            a = (alpha[-1] @ model.move if t else model.start) * model.emit[c]
            alpha.append(a / a.sum())
        beta = np.ones(k)
        for t in range(len(seq) - 1, -1, -1):
            gamma = alpha[t] * beta
            out["emit"][seq[t]] += gamma / gamma.sum()
            if t:
                both = alpha[t - 1][:, None] * model.move * model.emit[seq[t]] * beta
                out["move"] += both / both.sum()
                beta = model.move @ (model.emit[seq[t]] * beta)
                beta /= beta.sum()
            else:
                out["start"] += gamma / gamma.sum()
    return out


def test_counts_equal_plain_baum_welch(monkeypatch):
    """Ragged texts, chunks and spans of few tokens, long texts alone and not."""
    rnd, model = some_model(3, 7)
    monkeypatch.setattr(hmm, "SPAN", 64)
    seqs = [rnd.integers(0, 40, n) for n in (1, 2, 2, 9, 31, 32, 33, 33, 250, 700)]
    want = plain_counts(seqs, model)
    for chunk, direct in ((10**6, 10**6), (300, 10**6), (300, 100)):
        monkeypatch.setattr(hmm, "CHUNK_TOKENS", chunk)
        monkeypatch.setattr(hmm, "DIRECT", direct)
        got = hmm.all_counts(seqs, model)
        for key in want:
            assert got[key] == pytest.approx(want[key], rel=1e-9, abs=1e-9)


def test_long_texts_run_abreast(monkeypatch):
    """Transfer matrices, states times the work, are for a long text alone."""
    rnd, model = some_model(3, 8)
    monkeypatch.setattr(hmm, "DIRECT", 40)
    monkeypatch.setattr(hmm, "PIECE", 16)
    plain, seen = hmm._transfer, []
    monkeypatch.setattr(hmm, "_transfer", lambda pieces, m: seen.append(sum(map(len, pieces))) or plain(pieces, m))
    seqs = [rnd.integers(0, 40, 41 + i) for i in range(12)]
    apart = np.array([hmm.log_likelihoods([s], model)[0] for s in seqs])
    assert len(seen) == len(seqs)
    seen.clear()
    assert hmm.log_likelihoods(seqs, model) == pytest.approx(apart)
    got, want = hmm.all_counts(seqs, model), plain_counts(seqs, model)
    assert not seen and all(got[key] == pytest.approx(want[key], rel=1e-9, abs=1e-9) for key in want)
    hmm.log_likelihoods([*seqs, rnd.integers(0, 40, 5000)], model)
    assert seen == [4999 - 256 * 16, 256 * 16][::-1]


def test_scores_keep_their_rows_over_batches(docs, monkeypatch):
    monkeypatch.setattr(hmm, "CHUNK_TOKENS", 2000)
    rows = [(i, " ".join(f"w{i % 7}" for _ in range(i % 7))) for i in range(2600)]
    got = hmm.lm_scores(docs(rows).coalesce(1)).collect()
    assert sorted(r.doc_id for r in got) == list(range(2600))
    scores = collections.defaultdict(set)
    for r in got:
        assert r.n_tokens == r.doc_id % 7 + 1
        scores[r.doc_id % 7].add(round(r.score, 6))
    assert all(len(x) == 1 for x in scores.values()) and len(set.union(*scores.values())) == 7


def test_every_pass_learns_from_all_training_texts(docs, monkeypatch):
    seen, plain = [], hmm._block_counts
    monkeypatch.setattr(hmm, "_block_counts", lambda train, *rest: seen.append(train.count()) or plain(train, *rest))
    rows = some_docs(40)
    hmm.lm_scores(docs(rows)).collect()
    learns = sum(zlib.crc32(str(d).encode()) % 7 != 2 for d, _ in rows)
    passes = [seen[i:i + hmm.BLOCKS] for i in range(0, len(seen), hmm.BLOCKS)]
    assert len(passes) == hmm.PASSES and all(sum(p) == learns and p == passes[0] for p in passes)


def test_incremental_training_in_plain_steps(spark):
    """Blocks replace their own counts; with one block it is Baum-Welch."""
    rnd = np.random.default_rng(6)
    vocab = hmm.Vocabulary({}, np.zeros(0, int), np.zeros(0, int), np.zeros(hmm.N_CLASSES), np.zeros(hmm.N_CLASSES), 0, 0)
    seqs = [rnd.integers(0, 30, 40) + 40 * (i % 2) for i in range(30)]
    frame = spark.createDataFrame([(bytearray(s.astype("<u2").tobytes()), i % hmm.BLOCKS) for i, s in enumerate(seqs)],
                                  "seq binary, block int")
    model, held = hmm.initial(vocab, 2), {}
    for step in range(hmm.PASSES * hmm.BLOCKS):
        b = step % hmm.BLOCKS
        held[b] = hmm.all_counts([s for i, s in enumerate(seqs) if i % hmm.BLOCKS == b], model)
        model = hmm.maximise({k: sum(c[k] for c in held.values()) for k in held[b]}, vocab)
    got = hmm.trained(frame, vocab, 2)
    assert got.move == pytest.approx(model.move, rel=1e-3, abs=1e-4) and got.emit == pytest.approx(model.emit, rel=1e-2, abs=1e-5)


def test_lm_messy_and_empty(messy, docs):
    got = hmm.lm_scores(messy).collect()
    assert len(got) == messy.count() and all(math.isfinite(r.score) for r in got)
    assert all(r.held_out for r in got if r.doc_id is None)
    assert hmm.lm_scores(docs([])).count() == 0


# ------------------------------------------------------------ toxicity

def test_toxicity_learns_and_generalises(docs):
    rnd = random.Random(1)
    neutral = [f"word{i}" for i in range(300)]
    rows, y = [], {}
    for i in range(900):
        w = [rnd.choice(neutral) for _ in range(rnd.randint(5, 60))]
        y[i] = int(i % 6 == 0)
        if y[i]:
            w[rnd.randrange(len(w))] = "vile" + rnd.choice(["o", "a", "ness", "ly!"])
        rows.append((i, " ".join(w)))
    frame = docs(rows)
    labels = frame.sparkSession.createDataFrame([(i, v) for i, v in y.items() if i % 4] + [(3, None), (99999, 1)],
                                                "doc_id long, toxic int")
    got = {r.doc_id: r.__getattr__("p") for r in toxicity.score(frame, toxicity.fit(frame, labels), out_col="p").collect()}
    out = [i for i in y if i % 4 == 0]
    assert np.mean([(got[i] >= .3) == y[i] for i in out]) > .97
    assert all(0 <= p <= 1 for p in got.values())


def test_toxicity_messy_and_unlabelled(messy, docs):
    none = messy.sparkSession.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.score(messy, toxicity.fit(messy, none), out_col="p").collect()
    assert len(got) == messy.count() and all(r.p == pytest.approx(.1) and r.score == "clash" for r in got)
    assert toxicity.score(docs([]), toxicity.fit(docs([]), none), out_col="p").count() == 0


# ------------------------------------------------------------ search

def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "BLOCK", 70)
    monkeypatch.setattr(topk_search, "QUERY_BLOCK", 2)
    rnd = np.random.default_rng(0)
    dims = 40
    v = rnd.normal(size=(300, dims))
    v[50:150] = v[50] * rnd.random((100, 1))  # one code, a third of all rows
    rows = [(i, [float(x) for x in v[i]]) for i in range(300)]
    frame = spark.createDataFrame(rows + [rows[7], (301, None), (302, [1.0]), (None, rows[0][1])], "vec_id long, embedding array<float>")
    got = sorted((r.query_id, r.rank, r.id, r.distance) for r in topk_search.top_k(frame, "vec_id", "embedding", dims, 5, 50).collect())
    bits = v > 0
    want = []
    for q in range(0, 300, 50):
        d = (bits != bits[q]).sum(1)
        want += [(q, n + 1, int(i), int(d[i])) for n, i in enumerate(np.lexsort((np.arange(300), d))[:5])]
    assert got == want
    assert topk_search.top_k(frame.limit(0), "vec_id", "embedding", dims, 5).count() == 0


# ------------------------------------------------------------ URL filter

def test_url_rules_and_classifier(spark):
    urls = [f"http://{h}.example.{t}/{p}/{i}?q#f" for i, (h, t, p) in enumerate(
        (h, t, p) for h in ("a", "WWW.b") for t in ("com", "net", "org") for p in ("en", "de", "fr", "es"))]
    urls += [None, "", "no scheme", "x://", "HTTP://Net", "http://net/x", "http://anet/x", "ftp://e.net#/a/?b"]
    pages = spark.createDataFrame(list(enumerate(urls)) + [(0, urls[0])], "page_id long, url string").withColumn("host", pages_lit())
    got = url_filter.judge(pages, RULES).collect()
    assert len(got) == len(urls) + 1
    rules = [(r.action, *r.text.partition("/")) for r in RULES]
    for r in got:
        url = urls[r.page_id] or ""
        rest = url.split("://", 1)[1] if "://" in url else ""
        host = re.match("[^/?#]*", rest)[0]
        path = re.match("[^?#]*", rest[len(host):])[0]
        host = host.lower()
        fits = [(len(h + s + p), h + s + p, a) for a, h, s, p in rules
                if (host == h or host.endswith("." + h)) and path.startswith(s + p)]
        assert (r.host, r.path) == (host, path)
        if fits:
            assert (r.rule, r.verdict) == max(fits)[1:]
        else:
            assert r.rule is None and r.verdict == ("block" if r.score > .5 else "allow")
        if r.rule:
            assert (r.score > .5) == (r.verdict == "block")
    assert url_filter.judge(pages.limit(0), RULES).count() == 0


def pages_lit():
    from pyspark.sql import functions as F
    return F.lit("clash")


# ------------------------------------------------------------ BPE

@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(default_tokenizer())


def test_tree_concatenation_is_exact(library):
    with open(default_tokenizer(), encoding="utf-8") as f:
        tok = bpe.Tokenizer(f.read())
    rnd = random.Random(2)
    pieces = ["a", "ab", "the", "  ", " ", "\n", "'", "'s", "'re", "é", "中", "😀", "1", "!!", "aaaa", "tion", "\r\n", "--"]
    texts = ["".join(rnd.choice(rnd.sample(pieces, rnd.randint(1, 18))) for _ in range(rnd.randint(0, 200))) for _ in range(300)]
    texts += ["a" * 3000, "ab" * 2000, "中文字" * 900, " " * 2000 + "x", "!" * 2000 + "s"]
    for text in texts:
        for leaf in (7, 50):
            now = [(t, np.array(tok.by_words.encode_ordinary(t), "<u4"), tok.decided(t)) for t in bpe._leaves(text, leaf)]
            while len(now) > 1:
                now = [tok.join(*now[i], *now[i + 1]) for i in range(0, len(now), 2)]
            assert now[0][1].tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("leaf", [64, 1 << 15])
def test_bpe_messy(messy, docs, library, leaf):
    out = bpe.decode(bpe.encode(messy, default_tokenizer(), leaf_chars=leaf), default_tokenizer()).collect()
    assert len(out) == messy.count()
    want = collections.Counter()
    for r in messy.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        want[(r.doc_id, hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), r.text or "")] += 1
    assert want == collections.Counter((r.doc_id, hashlib.sha256(r.ids).hexdigest(), r.decoded) for r in out)
    assert bpe.encode(docs([]), default_tokenizer()).count() == 0


# ------------------------------------------------------------ personal data

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_spans(text):
    def luhn(d):
        return sum((x * 2 - 9 if x > 4 else x * 2) if i % 2 else x for i, x in enumerate(map(int, reversed(d)))) % 10 == 0
    out = []
    for n, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")) \
                    or kind == "card" and 12 <= len(d) <= 19 and luhn(d) or kind == "phone" and 9 <= len(d) <= 15:
                out.append((m.start(), n, m.end()))
    return sorted(out)


def test_base_spans(docs):
    rnd = random.Random(5)
    parts = ["a@b.c", "x.y%+@d-e.com_z@q.r", "@", ".", "1.2.3.4", "300.1.1.1", "000001.2.3.0255", "4111111111111111", "4111-1111 1111 1111",
             " ", "é😀", "+1 (234) 555-6789", "+", "12", "-", "word", "+12", "\n", "5", "a.b@c", "99999999999.1.1.1"]
    rows = [(i, "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14)))) for i in range(400)]
    rows += [(900, "1 " * 30_000), (901, "a" * 100_000), (902, "1.2.3.4 " * 200), (903, None)]
    got = {r.doc_id: r for r in sanitise.personal_data(docs(rows)).collect()}
    for i, t in rows:
        assert [(s.start, s.kind, s.end) for s in got[i].base] == brute_spans(t or ""), t
        assert {tuple(s) for s in got[i].base} <= {tuple(s) for s in got[i].spans}


def test_revealing_terms(docs):
    rows = [(i, f"common zorblatt filler{i} boss@corp.com other{i} common words{i}") for i in range(6)]
    rows += [(10 + i, f"common text{i} person{i}@mail.com words common") for i in range(30)]
    rows += [(100 + i, "common words and more text") for i in range(60)]
    got = {r.doc_id: r for r in sanitise.personal_data(docs(rows)).collect()}
    for i in range(6):
        terms = [s for s in got[i].spans if s.kind == 4]
        assert [rows[i][1][s.start:s.end] for s in terms] == ["zorblatt"]
    assert all(s.kind < 4 for i in range(10, 40) for s in got[i].spans)
    frame = docs(rows[:1]).selectExpr("text", "array(named_struct('start', 7, 'kind', 4, 'end', 15)) as s")
    assert frame.select(sanitise.sanitised(frame.text, frame.s)).first()[0].startswith("common <term> filler0")


def test_revealing_term_is_marked_wherever_it_stands(docs):
    rows = [(i, f"common zorblatt filler{i} boss@corp.com other{i} common words{i}") for i in range(6)]
    rows += [(100 + i, "common words and more text") for i in range(60)]
    rows += [(200, "Nobody else is here but 😀 Zorblatt, and zorblatts; zorblatt@other.org"),
             (201, "boss@corp.com stands far away from the one word that gives it away, zorblatt"),
             (202, "zorblatt " * 3000)]
    got = {r.doc_id: r for r in sanitise.personal_data(docs(rows)).collect()}
    for i, text in rows:
        spans = [(m.start(), m.end()) for m in re.finditer(r"\bzorblatt\b(?!@)", text, re.I)]
        assert [(s.start, s.end) for s in got[i].spans if s.kind == 4] == spans


def test_terms_far_from_the_entity_and_entities_of_two_documents(docs):
    far = " ".join(f"common{k}" for k in range(40))
    rows = [(i, f"Zorblatt opens {far} note{i} boss@corp.com") for i in range(4)]
    rows += [(10 + i, f"Quixel opens {far} item{i} pair@corp.com") for i in range(2)]
    rows += [(20 + i, f"copied opens {far} same@corp.com") for i in range(3)]     # one text three times
    rows += [(100 + i, f"opens {far} more corp com text") for i in range(60)]
    got = {r.doc_id: r for r in sanitise.personal_data(docs(rows)).collect()}
    marked = {i: [t[s.start:s.end] for s in got[i].spans if s.kind == 4] for i, t in rows}
    assert {i: m for i, m in marked.items() if m} == {**{i: ["Zorblatt"] for i in range(4)}, 10: ["Quixel"], 11: ["Quixel"]}


def brute_terms(rows, support=3, threshold=0.8):
    """Revealing terms by counting every pair of entity and term."""
    docs = []
    for _, t in rows:
        t = t or ""
        mine = set()
        for start, kind, end in brute_spans(t):
            v, d = t[start:end].lower(), re.sub("[^0-9]", "", t[start:end])
            mine |= {(kind, v), (kind, "/", {0: v[v.rfind("@"):], 1: v.rsplit(".", 1)[0], 2: d[:6], 3: d[:7]}[kind])}
        words = [w.lower() for w in regex.findall(r"\p{L}[\p{L}\p{N}]+", t)]
        outside = {w.lower() for w in regex.findall(r"\p{L}[\p{L}\p{N}]+", re.sub(BASE["email"], " ", t))}
        docs.append((mine, set(words), outside, tuple(words)))
    held, out = collections.Counter(w for _, ws, _, _ in docs for w in ws), set()
    for e in {e for mine, *_ in docs for e in mine}:
        inside = [x for x in docs if e in x[0]]
        if len(inside) < 2 or len(inside) == len(docs):
            continue
        information = math.log2(len(docs) / len(inside))
        for t in {t for x in inside for t in x[2]}:
            both = [x for x in inside if t in x[2]]
            if len({x[3] for x in both}) < max(2, min(support, len(inside))):
                continue
            if math.log2(len(both) * len(docs) / (len(inside) * held[t])) >= threshold * information - 1e-9:
                out.add(t)
    return out


def test_terms_equal_counting_every_pair(docs):
    rnd = random.Random(8)
    vocab = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    rows = []
    for d in range(260):
        words = [rnd.choice(vocab) for _ in range(rnd.randint(3, 25))]
        if d % 5 == 0:
            words += [f"p{d}@firm{d % 4}.org"] + (["Firmword" + "abcd"[d % 4]] if rnd.random() < .8 else [])
        if d % 13 == 1:
            words += [f"10.0.{d % 2}.{d}", "Rackname" if d % 2 else "Other"]
        if d % 11 == 2:
            words.insert(0, f"+1 (555) 123{d % 3}-{1000 + d} Callsign{d % 3}x")
        if d % 40 == 3:
            words += [rnd.choice(["Firmworda", "rackname"])]
        rows.append((d, " ".join(words)))
    want = brute_terms(rows)
    got = set()
    for r in sanitise.personal_data(docs(rows)).collect():
        text = rows[r.doc_id][1]
        assert [(s.start, s.kind, s.end) for s in r.base] == brute_spans(text)
        got |= {text[s.start:s.end].lower() for s in r.spans if s.kind == 4}
    assert got == want and {"firmwordb", "firmwordc", "callsign1x"} <= want


def test_many_matches_of_one_text(docs):
    n = 4 * sanitise.RUN + 3
    text = " ".join(f"a{i}@b.c" for i in range(n))
    got = sanitise.personal_data(docs([(1, text)])).first()
    assert [(s.start, s.kind, s.end) for s in got.base] == brute_spans(text) and len(got.base) == n


def test_personal_data_messy(messy, docs):
    assert sanitise.personal_data(messy).count() == messy.count()
    assert sanitise.personal_data(docs([])).count() == 0


# ------------------------------------------------------------ decontamination

QUESTION = "a train leaves with Anna Smith aboard and travels 120 km in 3 hours, so how fast does Anna ride the train today"


def test_reparameterised_questions(docs, spark):
    items = spark.createDataFrame([(1, QUESTION), (2, "short item"), (3, None), (1, QUESTION)], "item_id long, text string")
    rows = [
        (1, "noise before it " + QUESTION + " noise after"),
        (2, QUESTION.replace("Anna Smith", "Carl Weber").replace("Anna", "Carl").replace("120 km", "75 miles").replace("3", "9")),
        (3, QUESTION.replace("does Anna", "does Berta")),      # one name met by two in the windows that hold both
        (4, "a bus stops with nobody aboard and nothing else happens in this text about travels"),
        (5, " ".join(QUESTION.split()[:9])),                   # two windows: below the minimum
        (6, "short item"),
        # every number doubled inside each window of its own: no window is consistent
        (7, QUESTION.replace("Anna Smith", "Smith Smith").replace("does Anna", "does Smith").replace("120 km in 3", "3 km in 3")[:80]),
    ]
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(docs(rows), items).collect()}
    assert got.keys() == {(1, 1), (2, 1), (3, 1)}
    windows = len(QUESTION.split()) - 7
    assert got[1, 1].n_windows == windows and got[2, 1].n_slots == 6 and 3 <= got[3, 1].n_windows <= windows


def test_short_items_match_whole(docs, spark):
    items = spark.createDataFrame([(1, "Who wrote War and Peace?"), (2, "a b c"), (3, "one two three four"), (4, "5 km in 2 h"),
                                   (1, "Who wrote War and Peace?")], "item_id long, text string")
    rows = [(1, "he asked: who wrote war and peace, and when"), (2, "a b c d"), (3, "one two three"), (4, "zero one two three four five"),
            (5, "run 5 km in 2 h daily"), (6, "run 6 km in 2 h daily"), (7, "who wrote war and (Peace)!"), (8, None), (9, "")]
    got = {(r.doc_id, r.item_id): (r.n_windows, r.n_slots) for r in decontaminate.contaminated(docs(rows), items).collect()}
    assert got == {(1, 1): (1, 2), (7, 1): (1, 2), (4, 3): (1, 0), (5, 4): (1, 4)}


def test_items_dense_in_slots(docs, spark):
    sums, title = "12 45 7 is 64 and 9 3 4 is 16 then 8 8", "How The North Wind And The Bright Sun Once Quarrelled"
    few = "11 22 33 44 55 66 add these up now"
    items = spark.createDataFrame([(1, sums), (2, title), (3, few)], "item_id long, text string")
    rows = [(1, "as in " + sums + " of the book"), (2, sums.replace("64", "65").replace("16", "17")),
            (3, "we read: " + title + ", they said"), (4, "before it " + few.replace("66", "67")),
            (5, "nothing of this stands in the list 12 45 7")]
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs(rows), items).collect()}
    assert got == {(1, 1), (3, 2), (4, 3)}


def test_decontamination_messy(messy, docs, spark):
    items = spark.createDataFrame([(1, "two three four five six seven eight nine ten eleven")], "item_id long, text string")
    got = decontaminate.contaminated(messy, items)
    assert {r.doc_id for r in got.collect()} == {4, 5} and got.count() == 2
    assert decontaminate.contaminated(docs([]), items).count() == 0
    assert decontaminate.contaminated(messy, items.limit(0)).count() == 0
