"""The Jaccard join against brute force: pairs just at and below the threshold, chains, copies, groups in parts, odd rows."""

import random

import numpy as np
import pytest

from evidentia.llm import jaccard

SCHEMA = "doc_id long, text string, row string, node long, n long, bits string, tiles string, label long"


def shingles(text, size=4):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in lower.translate({k: " " for k in range(9, 14)}).split(" ") if w]
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def brute(docs):
    sets = [shingles(t) for _, t in docs]
    label = list(range(len(docs)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 85 * len(a | sets[j]):
                label[root(i)] = root(j)
    ids = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            ids[root(i)] = min(ids.get(root(i), doc_id), doc_id)
    return sorted(((d, len(s), ids.get(root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(docs, sets))), key=repr)


@pytest.fixture(scope="module")
def texts():
    r = random.Random(12)
    words = [f"w{i}" for i in range(5_000)] + ["Ärger", "ÄRGER", "Abc", "aBC"]
    text = lambda n: [r.choice(words) for _ in range(n)]
    out = [None, "", " \t\n", "one", "ONE", "one two three", "one two  three", "a b c d", "a b c d e", "A b\x0bc d"]
    for n in (20, 43, 44, 45, 100, 103, 104, 127, 128, 300, 2_000):
        base = text(n)
        out += [" ".join(base), " ".join(base).upper(), "\n".join(base + base[:2])]
        for _ in range(6):  # each changed word costs up to four shingles
            copy = list(base)
            for _ in range(r.choice([1, 1, 2, 3, max(1, n // 60)])):
                copy[r.randrange(n)] = r.choice(words)
            out.append(" ".join(copy))
        chain = base
        for _ in range(6):  # neighbours link, ends don't
            chain = [*chain[max(1, n // 16) :], *text(max(1, n // 16))]
            out.append(" ".join(chain))
        out += [" ".join(base[: n - k]) for k in range(1, n // 4, max(1, n // 40))]  # subsets about the threshold
    hub = text(60)
    out += [" ".join(hub[:i] + [f"x{i}"] + hub[i + 1 :]) for i in range(60)]  # each near the hub, some not near each other
    out += ["z" * 50_000, " ".join(text(30_000))]
    docs = list(enumerate(out, 100))
    return docs + [(None, out[10]), (None, None), (None, "only null ids"), docs[12], (5, docs[40][1])]


@pytest.fixture(scope="module")
def frame(spark, texts):
    return spark.createDataFrame([(*row, "r", 1, 2, "b", "t", 3) for row in texts], SCHEMA).repartition(3).cache()


@pytest.mark.parametrize("tile,block", [(jaccard.TILE, jaccard.TILE_SHINGLES), (7, 900)])
def test_components(spark, frame, texts, tile, block, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE_SHINGLES", block)
    got = sorted(map(tuple, jaccard.join(frame, tile=tile).collect()), key=repr)
    assert got == brute(texts)


def test_bound_never_loses_a_link():
    r = np.random.default_rng(1)
    for n in (3, 40, 400, 6_000):
        base = r.integers(0, 1 << 63, n, dtype=np.uint64)
        sets = [np.unique(np.r_[base[: n - k], r.integers(0, 1 << 63, d, dtype=np.uint64)]) for k in range(0, n // 4 + 1, n // 20 + 1) for d in (0, n // 15, n // 6)]
        size, bits = np.array([len(s) for s in sets]), jaccard.matrix([jaccard.bitmap(s) for s in sets])
        every = np.arange(len(sets))
        left = jaccard.room(size, bits, every, every, 85) >= 0
        exact = np.array([[jaccard.linked(a, b, 85) for b in sets] for a in sets])
        assert exact.any() and not (exact & ~left).any()
        assert exact.tolist() == [[100 * len(set(a) & set(b)) >= 85 * len(set(a) | set(b)) for b in sets] for a in sets]


def test_tiles_meet():
    """Pairs at the threshold share tiles as often as the formula says, and never less than once here."""
    r, shared = np.random.default_rng(7), []
    for n in (37, 60, 127, 128, 500):
        for _ in range(60):
            both = r.integers(0, 1 << 63, n, dtype=np.uint64)
            only = n * 15 // 85 // 2
            a, b = (np.unique(np.r_[both, r.integers(0, 1 << 63, only, dtype=np.uint64)]) for _ in range(2))
            assert jaccard.linked(a, b, 85)
            one, other = (set(jaccard.tiles_of(x, 85)) for x in (a, b))
            shared.append(len(one & other) / len(one))
            assert len(one) in (jaccard.BANDS, 2 * jaccard.BANDS)
    assert min(shared) > 0
    assert np.mean(shared) == pytest.approx(0.853**jaccard.ROWS, rel=0.1)


def test_empty(spark, frame):
    assert jaccard.join(frame.limit(0)).collect() == []
    assert sorted(map(tuple, jaccard.join(spark.createDataFrame([(1, None), (2, ""), (None, "")], "doc_id long, text string")).collect()), key=repr) == [(1, 0, 1), (2, 0, 2), (None, 0, None)]
