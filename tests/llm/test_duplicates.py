"""Near duplicates and repeated windows against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from kinstar.llm import cells, near_dup, substring
from kinstar.llm.graph import connected_components
from tests.llm.cases import SCHEMA, documents, lower, nothing, prose, rows


def words_of(text, low=True):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text or "") if low else text or "")


def shingles(text, k):
    w = words_of(text)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute_components(docs, k, num, den):
    """(id, n_shingles, component, kept) per row, by comparing all pairs."""
    sets = [shingles(t, k) for _, t in docs]
    parent = {i: i for i, _ in docs if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(docs)):
        for b in range(a):
            if docs[a][0] is not None and docs[b][0] is not None and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if den * common >= num * (len(sets[a]) + len(sets[b]) - common):
                    x, y = find(docs[a][0]), find(docs[b][0])
                    parent[max(x, y)] = min(x, y)
    # a row without shingles is linked with nothing
    return sorted(((i, len(s), None if i is None else find(i) if s else i, i is None or (find(i) if s else i) == i)
                   for (i, _), s in zip(docs, sets)), key=str)


def found(df, k=3, num=85, den=100):
    return sorted((tuple(r) for r in near_dup.near_duplicates(df, k=k, num=num, den=den).collect()), key=str)


@pytest.mark.parametrize(("k", "num", "den"), [(3, 85, 100), (5, 80, 100)])
def test_edge_cases_against_all_pairs(spark, k, num, den):
    assert found(documents(spark), k, num, den) == brute_components([(r[0], r[1]) for r in rows()], k, num, den)


def test_nothing(spark):
    assert found(nothing(spark)) == []
    assert substring.remove_repeats(nothing(spark)).collect() == []


def test_large_group_of_chained_copies(spark, monkeypatch):
    """More members than a block, linked in chains and near the threshold."""
    monkeypatch.setattr(near_dup, "BLOCK", 16)
    rng = random.Random(5)
    base, docs = prose(rng, 150, 5000).split(), []
    for i in range(120):
        text = base[:]
        for _ in range(rng.choice([0, 1, 2, 4, 6, 9, 14])):
            text[rng.randrange(len(text))] = f"v{rng.randrange(10 ** 6)}"
        docs.append((i, " ".join(text)))
    docs += [(200 + i, prose(rng, 100, 5000)) for i in range(30)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute_components(docs, 3, 85, 100)
    assert found(df) == want
    assert 20 < sum(r[2] != r[0] for r in want) < 119


def test_estimates_and_signatures():
    rng = np.random.default_rng(1)
    n = 144
    for share in (0.3, 0.85, 1.0):
        errors = []
        for _ in range(40):
            both = rng.integers(0, 2 ** 63, int(400 * share), dtype=np.uint64)
            a, b = (np.concatenate([both, rng.integers(0, 2 ** 63, (400 - len(both)) // 2, dtype=np.uint64)]) for _ in "ab")
            true = len(both) / (len(a) + len(b) - len(both))
            sig = [np.frombuffer(near_dup.pack(near_dup.minima(x, n)), np.uint8)[None, :] for x in (a, b)]
            errors.append(float(near_dup.agreement(*sig, n)[0, 0]) - true)
        assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06
    assert near_dup.bands_for(0.85) == 23 and (1 - 0.8 ** 6) ** near_dup.bands_for(0.8) < 2e-5


def test_groups_are_kept_together_across_batches():
    rows_ = [(1, 0), (1, 0), (2, 0), (2, 1), (2, 1), (3, 0)]
    batches = [pa.RecordBatch.from_pydict({"a": [x for x, _ in part], "b": [y for _, y in part]})
               for part in (rows_[:1], rows_[1:4], [], rows_[4:])if part]
    got = [t.to_pylist() for t in cells.groups_in(iter(batches), ["a", "b"])]
    assert [len(g) for g in got] == [2, 1, 2, 1]


def test_components_of_a_long_chain_and_a_star(spark):
    rng = random.Random(2)
    chain = list(range(300))
    rng.shuffle(chain)
    links = list(zip(chain, chain[1:])) + [(1000, 1000 + i) for i in range(50)] + [(5000, 5000), (7, None), (7000, 6000)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(links, "src long, dst long")).collect()))
    assert got == {i: 0 for i in range(300)} | {1000 + i: 1000 for i in range(50)} | {6000: 6000, 7000: 6000}


def brute_repeats(docs, window):
    seen, out = {}, []
    texts = [(i, words_of(t, False)) for i, t in docs]
    for i, w in texts:
        if i is not None:
            for s in range(len(w) - window + 1):
                key = tuple(w[s:s + window])
                seen[key] = min(seen.get(key, (i, s)), (i, s))
    for (i, w) in texts:
        gone = set()
        if i is not None:
            for s in range(len(w) - window + 1):
                if seen[tuple(w[s:s + window])] < (i, s):
                    gone.update(range(s, s + window))
        kept = " ".join(x for n, x in enumerate(w) if n not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("window, hot", [(2, 3), (6, 1000), (20, 1), (20, 1000), (48, 2)])
def test_repeats_against_brute_force(spark, monkeypatch, window, hot):
    monkeypatch.setattr(substring, "HOT", hot)
    got = sorted((tuple(r) for r in substring.remove_repeats(documents(spark), window=window).collect()), key=str)
    assert got == brute_repeats([(r[0], r[1]) for r in rows()], window)


def test_repeats_in_few_words(spark):
    """A small vocabulary repeats windows within and across documents everywhere."""
    rng = random.Random(9)
    docs = [(i, " ".join(rng.choice("ab") for _ in range(rng.randrange(0, 60)))) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = sorted((tuple(r) for r in substring.remove_repeats(df, window=8).collect()), key=str)
    assert got == brute_repeats(docs, 8)


def test_levels_double_and_only_repeated_windows_go_on(spark, monkeypatch):
    """The chains that survive each level, against counts of the word sequences themselves."""
    assert [substring.level_lengths(w) for w in (2, 6, 20, 160)] == [[1, 2], [3, 6], [5, 10, 20], [5, 10, 20, 40, 80, 160]]
    rng = random.Random(11)
    common, base = prose(rng, 30), prose(rng, 200)
    docs = [(i, f"{prose(rng, 50, 30)} {common} {prose(rng, 9)} {base[17 * i:17 * i + 240]}") for i in range(40)]
    lengths, column = [5, 10, 20, 40], pa.array([t for _, t in docs])
    (_, _, words), = substring.blocks(column)
    _, _, levels = substring._chains(words, lengths)
    text = [w for _, t in docs for w in t.split()]
    alive, expected = list(range(len(levels[0]))), []
    for size, at in zip(lengths, levels):
        assert all(a <= b for a, b in zip(at, at[1:]))
        places = {}
        for c in alive:
            places.setdefault(tuple(text[at[c]:at[c] + size]), set()).add(int(at[c]))
        alive = [c for c in alive if len(places[tuple(text[at[c]:at[c] + size])]) > 1]
        expected.append(len(alive))
    assert expected[0] >= expected[1] > expected[2] > 0  # each level loses some
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    kept, real = [], substring.stored

    def counted(rows, name):
        out = real(rows, name)
        if name == "level":
            kept.append(out.count())
        return out

    monkeypatch.setattr(substring, "stored", counted)
    got = sorted((tuple(r) for r in substring.remove_repeats(df, window=40).collect()), key=str)
    assert kept == expected[:2] and got == brute_repeats(docs, 40)


def test_levels_end_when_nothing_survives(spark, monkeypatch):
    docs = [(i, " ".join(f"{i}-{n}" for n in range(100))) for i in range(5)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    names, real = [], substring.stored
    monkeypatch.setattr(substring, "stored", lambda rows, name: names.append(name) or real(rows, name))
    assert {r.n_removed for r in substring.remove_repeats(df, window=160).collect()} == {0}
    assert names.count("level") <= 1


def test_one_id_with_two_texts_is_not_mixed_up(spark):
    rng = random.Random(4)
    shared = prose(rng, 40)
    docs = [(1, shared + " a b"), (2, prose(rng, 30) + " " + shared), (2, "x y " + shared + " " + prose(rng, 25))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted(map(tuple, substring.remove_repeats(df, with_text=True).collect()))
    assert [g[2] for g in got] == [0, 40, 40]
    assert sorted(g[4] for g in got[1:]) == sorted(t.replace(shared, "").replace("  ", " ").strip() for _, t in docs[1:])
    with pytest.raises(ValueError):
        substring.remove_repeats(df, window=7)
    assert SCHEMA
