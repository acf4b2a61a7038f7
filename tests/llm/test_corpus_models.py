"""Importance resampling, recurrent language model scores and ranked lexical search, against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kinstar.llm import gru, lm_score, ranked, resample
from kinstar.llm.crc import REACH, crc32_of_spans
from kinstar.llm.queries import QUERIES
from kinstar.llm.words import BARE, blocks
from tests.llm.cases import CLASHING, SCHEMA, documents, lower, nothing, prose, rows

SF = "/root/testdata/sf0.001"
BARE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=700), st.data())
def test_crc_of_spans(data, draw):
    places = st.integers(0, len(data))
    spans = draw.draw(st.lists(st.tuples(places, places).map(sorted), max_size=8))
    got = crc32_of_spans(np.frombuffer(data, dtype=np.uint8), [a for a, _ in spans], [b for _, b in spans])
    assert got.tolist() == [zlib.crc32(data[a:b]) for a, b in spans]


def test_crc_of_long_spans():
    data = np.random.default_rng(0).integers(0, 256, 300_000).astype(np.uint8)
    ends = [REACH - 1, REACH, REACH + 1, 2 * REACH, 2 * REACH + 1, 299_999]
    assert crc32_of_spans(data, [0] * len(ends), ends).tolist() == [zlib.crc32(data[:e].tobytes()) for e in ends]


def brute_resample(docs, target, share=(5, 100)):
    """Result rows by the stated formulas, ranks of equal (score, id) in any order."""
    def features(text):
        w = BARE_WORD.findall(lower(text or ""))
        return len(w), [zlib.crc32(" ".join(w[i:i + n]).encode()) % 10_000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]

    made = [(i, *features(t)) for i, t in docs]
    s, t = Counter(b for _, _, f in made for b in f), Counter(b for x in target for b in features(x)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000)))) for b in s}
    out, may = [], []
    for i, n, f in made:
        weight = sum(gain[b] for b in f)
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
            if n >= 20:
                may.append((-score, i))
        out.append((i, len(f), weight, score, n >= 20 and i is not None))
    best = sorted(may)[:share[0] * len(may) // share[1]]
    return out, [(i, -s) for s, i in best]


def assert_resampled(got, want):
    out, best = want
    assert sorted(((r[0], r[1], r[2], r[3]) for r in got), key=str) == sorted(((a, b, c, d) for a, b, c, d, _ in out), key=str)
    drawn = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in drawn] == list(range(1, len(best) + 1))
    assert [(r[0], r[3]) for r in drawn] == best


def test_resampling_edge_cases(spark):
    target = spark.createDataFrame([(1, rows()[0][1][:200]), (2, None), (3, "Ünï çödé"), (4, "one")], "item_id long, text string")
    got = resample.resample(documents(spark), target, share=(40, 100)).collect()
    assert_resampled(got, brute_resample([(r[0], r[1]) for r in rows()], [r.text for r in target.collect()], (40, 100)))
    assert resample.resample(nothing(spark), target).collect() == []
    assert len(resample.resample(documents(spark), target.limit(0)).collect()) == len(rows())


def test_resampling_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert_resampled(QUERIES["op11_importance_resampling"](spark, SF).collect(), brute_resample(docs, target))


def brute_ranked(docs, items, k=10):
    terms = {n: [re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(t or "")) for _, t in part]
             for n, part in (("docs", docs), ("items", items))}
    counts = [Counter(t) for t in terms["docs"]]
    n, length = sum(bool(c) for c in counts), sum(len(t) for t in terms["docs"])
    df = Counter(t for c in counts for t in c)
    out = []
    for (item, _), asked in zip(items, terms["items"]):
        found = []
        for (doc, _), c, own in zip(docs, counts, terms["docs"]):
            m = 100 - 90 + (90 * len(own) * n) // max(1, length)
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(asked) if c[t])
            if score > 0 and doc is not None:
                found.append((-score, doc))
        out += [(item, r, doc, -s) for r, (s, doc) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("limits", [(4096, 1 << 20, 1 << 19), (2, 40, 64)], ids=["whole", "small"])
def test_ranked_search_against_brute_force(spark, monkeypatch, limits):
    for name, value in zip(("QUERIES", "TERMS", "MATRIX"), limits):
        monkeypatch.setattr(ranked, name, value)
    rng = random.Random(6)
    docs = [(r[0], r[1]) for r in rows()] + [(100 + i, prose(rng, rng.randrange(1, 60), 30)) for i in range(120)]
    items = [(i, prose(rng, 12, 30)) for i in range(6)] + [(7, None), (8, ""), (9, "Ünï w1 W1"), (10, docs[0][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(tuple(r) for r in ranked.ranked_search(df, asked).collect())
    assert got == brute_ranked(docs, items)
    assert ranked.ranked_search(nothing(spark), asked).collect() == [] and ranked.ranked_search(df, asked.limit(0)).collect() == []
    clashing = documents(spark).selectExpr("*", "doc_id AS item_id", "doc_id AS score")
    assert ranked.ranked_search(clashing, asked).columns == ["item_id", "rank", "doc_id", "score"]


def test_bounds_hold_and_spare_documents():
    """Sketches bound every score from above, and most documents are never scored."""
    rng = random.Random(2)
    texts = [prose(rng, rng.randrange(5, 80), 300) for _ in range(2000)]
    terms = [ranked.text_terms(" ".join(t.split()[:9])) for t in texts[:20]]
    vocabulary = np.unique(np.concatenate(terms))
    asked = ranked.Asked(np.arange(20), terms, vocabulary, np.full(len(vocabulary), 5000, dtype=np.int64))
    best, scored = [ranked.Best(10) for _ in terms], 0
    for a, b, words in blocks(pa.array(texts), lower=True, space=BARE):
        block = ranked.Block(words, asked, len(texts), sum(len(t.split()) for t in texts))
        for places in asked.places:
            weight = np.zeros(len(asked.vocabulary), dtype=np.int64)
            weight[places] = asked.weight[places]
            found, bounds = block.bounds(asked.vocabulary[places], asked.weight[places].astype(float))
            assert (bounds >= block.exact(found, weight)).all()
        scored += ranked.search_block(block, np.arange(a, b), asked, best)
    assert all(len(x.ids) == 10 for x in best) and scored < 0.2 * 20 * len(texts)


def small_model(seed=1):
    rng = np.random.default_rng(seed)
    model = gru.Gru(np.array([0, 2, 5, 9]), 3, np.arange(12, 0, -1).astype(float), hidden=5, seed=seed)
    for w in model.weights.values():
        w += rng.normal(0, 0.5, w.shape).astype(np.float32)
    return model


def plain_log_likelihood(model, symbols, begin):
    """One document, one step after another."""
    w, d = {k: v.astype(float) for k, v in model.weights.items()}, model.hidden
    h, before, out = np.zeros(d), begin, []
    for s in symbols:
        x, u = w["x"][before], h @ w["u"]
        z, r = (1 / (1 + np.exp(-(x[a:a + d] + u[a:a + d]))) for a in (0, d))
        h = (1 - z) * np.tanh(x[2 * d:] + r * u[2 * d:]) + z * h
        logits = h @ w["c"] + w["cb"]
        c = model.class_of[s]
        p = logits[c] - np.log(np.exp(logits).sum())
        if s < model.words:
            a, b = model.edges[c], model.edges[c + 1]
            inner = w["w"][a:b] @ h + w["wb"][a:b]
            p += inner[s - a] - np.log(np.exp(inner).sum())
        out.append(p)
        before = s
    return out


def test_state_is_carried_over_whole_documents(monkeypatch):
    monkeypatch.setattr(gru, "LANES", 3)
    monkeypatch.setattr(gru, "WINDOW", 4)
    model, rng = small_model(), np.random.default_rng(3)
    lengths = np.array([1, 37, 2, 9, 9, 20])
    symbols = rng.integers(0, 12, lengths.sum())
    want, at = [], 0
    for n in lengths:
        want += plain_log_likelihood(model, symbols[at:at + n], 0)
        at += n
    assert np.allclose(model.log_likelihood(symbols, lengths, 0), want, atol=1e-4)


def test_probabilities_add_up_to_one():
    model = small_model()
    total = sum(np.exp(model.log_likelihood(np.array([3, 7, s]), np.array([3]), 0)[2]) for s in range(12))
    assert abs(total - 1) < 1e-5


def test_gradients_against_differences():
    model, rng = small_model(), np.random.default_rng(5)
    lengths = np.array([7, 5, 3])
    symbols = rng.integers(0, 12, 15)
    before, fresh = gru._inputs(symbols, lengths, 0)
    window = next(gru.Lanes(lengths, 2).windows(100))  # one window: nothing is truncated
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    _, grads = model._gradients(np.zeros((0, 5)), window, symbols, before, fresh)

    def loss():
        return -model.log_likelihood(symbols, lengths, 0).mean()

    for k, g in grads.items():
        w = model.weights[k]
        for at in rng.choice(w.size, min(w.size, 12), replace=False):
            place, step = np.unravel_index(at, w.shape), 1e-3
            w[place] += step
            up = loss()
            w[place] -= 2 * step
            down = loss()
            w[place] += step
            assert abs((up - down) / (2 * step) - g[place]) < 2e-4


def brute_base(docs):
    tokens = [re.findall(r"[^\x20\x09-\x0D]+", lower(t or "")) + ["\0end"] for _, t in docs]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in docs]
    c = Counter(w for words, out in zip(tokens, held) if not out for w in words)
    n, v = sum(c.values()), len(c)
    return [(i, out, len(words), sum(c[w] > 0 for w in words), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words))
            for (i, _), words, out in zip(docs, tokens, held)]


def assert_scored(got, docs):
    want = sorted(brute_base(docs), key=str)
    got = sorted(got, key=lambda r: str((r[0], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"])))
    assert [tuple(r)[:5] for r in got] == [w[:5] for w in want]
    assert all(abs(r["base_score"] - w[5]) <= 1e-9 * abs(w[5]) and math.isfinite(r["score"]) and r["score"] < 0 for r, w in zip(got, want))


@pytest.mark.parametrize("frequent", [lm_score.FREQUENT, 50], ids=["all", "few"])
def test_language_model_edge_cases(spark, monkeypatch, frequent):
    monkeypatch.setattr(lm_score, "FREQUENT", frequent)
    monkeypatch.setattr(lm_score, "_TOKENS", 2000)
    assert_scored(lm_score.score_documents(documents(spark)).collect(), [(r[0], r[1]) for r in rows()])
    assert lm_score.score_documents(nothing(spark)).collect() == []
    out = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2][:3]
    held = spark.createDataFrame([(i, "some words", *[None] * 12) for i in out], f"{SCHEMA}, {CLASHING}")
    got = lm_score.score_documents(held).collect()
    assert [(r.n_known, r.train_tokens, r.base_score, r.score) for r in got] == [(0, 0, 0.0, 0.0)] * 3


def test_language_model_query_predicts_held_out_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    got = QUERIES["op12_recurrent_lm_score"](spark, "/root/testdata/sf0.01").collect()
    assert_scored(got, docs)
    held = [r for r in got if r.held_out]
    gain = sum(r.score - r.base_score for r in held) / sum(r.n_tokens for r in held)
    assert gain > 0.2 and sum(r.score > r.base_score for r in held) > 0.95 * len(held)


def test_tail_words_share_their_class():
    """The words of a tail class and one unknown word have probabilities that add up to 1."""
    words = [(h, h % lm_score.TAILS, 5000 - h) for h in range(1, 3000)]
    of = {k: (sum(n for _, t, n in words if t == k), sum(t == k for _, t, _ in words)) for k in range(lm_score.TAILS)}
    lexicon = lm_score.Lexicon(words, of)
    symbols, counts = lexicon.look_up(np.arange(0, 3001), np.arange(0, 3001) % lm_score.TAILS)
    assert (symbols[1:lexicon.words + 1] < lexicon.words).all() and (counts[[0, 3000]] == -1).all()
    for k in range(lm_score.TAILS):
        held = counts[(symbols == lexicon.words + k) & (counts > 0)]
        assert abs(((held + 1).sum() + 1) / (lexicon.n_tail[k] + lexicon.v_tail[k] + 1) - 1) < 1e-9


def test_language_model_learns_from_every_training_token(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "PIECE", 20)
    monkeypatch.setattr(lm_score, "SHARD", 200)
    monkeypatch.setattr(lm_score, "MERGED", 2)
    docs = spark.createDataFrame([(i, " ".join(f"w{(i * 7 + k * k) % 50}" for k in range(60))) for i in range(100)], "doc_id long, text string")
    training = docs.where(~lm_score.held_out("doc_id"))
    tokens, learned = 61 * training.count(), []
    averaged = lm_score._averaged

    def counting(models, first, n):
        rows = models.collect()
        learned.extend((r["shard"], r["tokens"]) for r in rows)
        got = np.frombuffer(averaged(models, first, n), "<f4")
        want = sum(r["tokens"] * np.frombuffer(r["weights"], "<f4").astype(float) for r in rows) / sum(r["tokens"] for r in rows)
        assert np.allclose(got, want, atol=1e-5)
        return averaged(models, first, n)

    monkeypatch.setattr(lm_score, "_averaged", counting)
    got = lm_score.score_documents(docs).collect()
    assert sum(n for _, n in learned) == tokens and len({s for s, _ in learned}) == len(learned) > 20
    again = lm_score.score_documents(docs.repartition(7)).collect()
    scores = [{r.doc_id: r.score for r in rows} for rows in (got, again)]
    assert all(abs(scores[0][i] - scores[1][i]) < 1e-3 * abs(scores[0][i]) for i in range(100))


def test_words_are_found_by_the_upper_bits_of_their_hashes():
    rng = np.random.default_rng(3)
    known = np.unique(np.concatenate([rng.integers(-2**63, 2**63 - 1, 4000), np.arange(40), [-2**63, 2**63 - 1]]))
    lexicon = lm_score.Lexicon([(int(h), 0, 9000 - i) for i, h in enumerate(rng.permutation(known))], {0: (1 << 30, 1 << 20)})
    assert 40 <= lexicon.most < 50  # hashes that lie close are all looked at, and no more
    asked = np.concatenate([known, known[1:] - 1, known[:-1] + 1, rng.integers(-2**63, 2**63 - 1, 4000)])
    symbols, counts = lexicon.look_up(asked, np.zeros(len(asked), dtype=np.int8))
    assert (counts > 0).tolist() == np.isin(asked, known).tolist()
    assert (counts[:len(known)] == lexicon.counts).all() and len(lexicon.look_up(asked[:0], np.zeros(0, dtype=np.int8))[0]) == 0


def test_scaled_weights_give_the_plain_step():
    model = gru.Gru(np.array([0, 5, 9]), 2, np.arange(1, 12))
    rng, d, w = np.random.default_rng(4), model.hidden, model.weights
    h, at = rng.uniform(-1, 1, (7, d)).astype(np.float32), rng.integers(0, 11, 7)
    scaled = model._scaled()
    following, _ = model._step(h, scaled[0][at], scaled[1])
    x, u = w["x"][at].astype(float), h.astype(float) @ w["u"]
    z, r = (1 / (1 + np.exp(-(x + u)[:, k * d:(k + 1) * d])) for k in (0, 1))
    n = np.tanh(x[:, 2 * d:] + r * u[:, 2 * d:])
    assert np.abs(following - (n + z * (h - n))).max() < 1e-6


def test_training_steps_are_those_of_plain_adam_and_gates_lie_together(monkeypatch):
    monkeypatch.setattr(gru, "_PART", 7)
    model, plain = small_model(), small_model()
    assert all(gate.flags.c_contiguous for x in (model._scaled()[0].swapaxes(0, 1), model._scaled()[1]) for gate in x)
    rng, lengths = np.random.default_rng(6), np.array([40, 25, 3])
    symbols = rng.integers(0, 12, 68)
    model.fit(symbols, lengths, 0, epochs=2, rate=0.05, lanes=2)
    before, fresh = gru._inputs(symbols, lengths, 0)
    windows = list(gru.Lanes(lengths, 2).windows(gru.TRAIN_WINDOW))
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in plain.weights.items()}
    for t in range(2 * len(windows)):
        if t % len(windows) == 0:
            h = np.zeros((0, 5), dtype=np.float32)
        h, grads = plain._gradients(h, windows[t % len(windows)], symbols, before, fresh)
        for k, g in grads.items():
            m, v = moments[k]
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            rate = 0.05 * (1 - 0.9 * (t + 1) / (2 * len(windows))) * np.sqrt(1 - 0.999 ** (t + 1)) / (1 - 0.9 ** (t + 1))
            plain.weights[k] -= rate * m / (np.sqrt(v) + 1e-8)
    assert all((model.weights[k] == v).all() for k, v in plain.weights.items())


def test_merged_counts_against_brute_force():
    rng = np.random.default_rng(8)
    parts = [(h := rng.integers(-20, 20, n), (h % 5).astype(np.int8), rng.integers(1, 9, n)) for n in (300, 1, 50)]
    want = Counter()
    for h, _, n in parts:
        for x, k in zip(h.tolist(), n.tolist()):
            want[x, x % 5] += k
    assert dict(zip(zip(*(c.tolist() for c in lm_score._merged(parts)[:2])), lm_score._merged(parts)[2].tolist())) == want
