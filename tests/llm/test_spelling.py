"""Spelling variants against brute force: words by the contract's letters, distances by dynamic programming, forms and roots."""

import random
import re
import zlib
from collections import Counter

import pytest

from evidentia.llm import spelling

SCHEMA = "doc_id long, text string, word string, n long, name string, key string, form string"


def near(a, b):
    """Whether a and b differ by exactly one inserted, deleted or replaced code point, by the edit table."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1] == 1


def brute(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc_id}:{run}".encode()) if doc_id is not None else 1
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    form, n_near = {}, {}
    for w, n in counts.items():
        others = [x for x in counts if near(w, x)]
        n_near[w] = len(others)
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None
    out = {}
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, n_near[w], counts.get(form[w]))
    return out


@pytest.fixture(scope="module")
def texts():
    r = random.Random(11)
    base = ["letters", "aabbaab", "zzzzz", "größe", "ÀÉÎõü", "straße", "naïve", "abcdef", "x×y÷zz"]
    words = []
    for w in base:
        variants = {w}
        for _ in range(12):
            v = r.choice(sorted(variants))
            at = r.randrange(len(v) + 1)
            variants.add(r.choice([v[:at] + r.choice("abzé") + v[at:], v[:at] + v[at + 1 :], v[:at] + r.choice("abzé") + v[at + 1 :]]))
        words += [x for v in sorted(variants) for x in [v] * r.choice([1, 3, 3, 4, 8, 20])]
    long = "".join(r.choice("ab") for _ in range(63))
    for n in (63, 64, 65, 66, 300):  # about the length from which keys are hashes, and beyond
        w = (long * 80)[:n]
        for v, times in ((w, 9), (w[1:], 4), (w[: n // 2] + "q" + w[n // 2 :], 3), (w[:-1] + "q", 4), ("q" + w[1:-1] + "q", 3)):
            words += [v] * times
    words += [w for w, n in (("chained", 30), ("chainet", 14), ("cheinet", 6), ("cheinot", 3)) for _ in range(n)]
    r.shuffle(words)
    out = [(i, "1 ".join(words[k : k + 9]) + "\n") for i, k in enumerate(range(0, len(words), 9))]
    many = [(1_000 + i, "reading writing " + "Counted, " * (i % 4)) for i in range(400)]  # enough for deleted letters
    return [(None, None), (5_000, ""), (5_001, None), (5_002, "12 ~ ,"), (None, "reading READING"), *out, *out[3:5], *many]


def test_variants(spark, texts):
    docs = spark.createDataFrame([(*row, "w", 1, "n", "k", "f") for row in texts], SCHEMA).repartition(5)
    got = spelling.variants(docs).collect()
    want = brute(texts)
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == want
    assert len(got) == len(want)
    assert any(form != root for form, root, *_ in want.values() if form)  # forms of forms occur
    assert any(len(w) > 66 and v[3] > 1 for w, v in want.items())


def test_without_long_words(spark):
    texts = [(i, "colour color kolor") for i in range(3)] + [(i, "colour") for i in range(3, 9)]
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got == brute(texts)


def test_keys_of_long_words():
    """A hashed deletion has the name of the word that it leaves."""
    r = random.Random(2)
    for n in (1, 5, 64, 65, 66, 67, 200):
        word = "".join(r.choice("aab") for _ in range(n))
        for key, low, high in spelling.deletions(word):
            assert {key} == {spelling.named(word[:k] + word[k + 1 :]) for k in range(low, high + 1)}
        assert len({k for k, _, _ in spelling.deletions(word)}) == len({word[:k] + word[k + 1 :] for k in range(n)})


def test_small_tables(spark, monkeypatch, texts):
    """The same counts if a task emits its table often."""
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(2)
    whole = {tuple(r) for r in spelling.words(docs).collect()}
    monkeypatch.setattr(spelling, "TABLE_WORDS", 3)
    assert {tuple(r) for r in spelling.words(docs).collect()} == whole


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(docs).collect() == []
    assert spelling.variants(spark.createDataFrame([(1, None), (2, "a bb ccc")], "doc_id long, text string")).collect() == []
