"""The operators against brute force on small fixtures with nulls, empty and long texts, ties, repeats and odd columns."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from evidentia.llm import bpe, decontaminate, language, near_copies, pii, quality, shards, simhash, substrings, toxicity, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, term string, fp string, kind string, label string"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.fixture(scope="module")
def texts():
    r = random.Random(5)
    vocabulary = ["the", "of", "and", "Ärger", "ion", "quick", "ﬁne", "año", "x-y", "12", "brown", "fox", "jumps"] + [f"w{i}" for i in range(40)]
    passage = [r.choice(vocabulary) for _ in range(60)]
    out = [None, "", "   \n\t ", "one", "One two", "a\x0bb c d  e", "same text here again", "same text here again"]
    for i in range(30):
        w = [r.choice(vocabulary) for _ in range(r.choice([3, 20, 60, 150]))]
        if i % 4 == 0:
            at = r.randrange(len(w))
            w[at:at] = passage
        if i % 5 == 0:
            w = w * 3
        out.append(" ".join(w) if i % 3 else "\n".join(" ".join(w[k : k + 9]) for k in range(0, len(w), 9)))
    out += [out[10], out[11] + " end", "ab " * 8000, "z" * 70_000]
    return out, passage


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, ["en", "de", None][i % 3], [f"s{i % 2}", None][i % 7 == 0], None if t is None else len(t), "r", "t", "f", "k", "l") for i, t in enumerate(texts[0])]
    rows.append(rows[12])  # a repeated row
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_decontaminate(spark, docs, empty, texts):
    passage = texts[1]
    items = [(1, " ".join(passage[:25])), (2, " ".join(passage[10:22])), (3, "one"), (10, "One, TWO!"), (4, None), (5, "?!"), (6, " ".join(passage[:25])), (7, "neverseen word")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = {}
    for i, t in items:
        w = word.findall(lower(t))
        for k in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[k : k + 10]), set()).add(str(i))
    got = decontaminate.decontaminate(docs, benchmark).collect()
    assert len(got) == docs.count()
    by_id = dict(enumerate(texts[0]))
    for r in got:
        w, hit, ids = word.findall(lower(by_id[r.doc_id])), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if (k := tuple(w[i : i + n])) in windows:
                    hit.update(range(i, i + n))
                    ids |= windows[k]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (len(w), len(hit), len(ids), bool(hit))
        assert r.items_sha256 == hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
    assert sum(r.contaminated for r in got) > 5
    assert decontaminate.decontaminate(empty, benchmark).count() == 0
    assert not any(r.contaminated for r in decontaminate.decontaminate(docs, benchmark.limit(0)).collect())
    near = decontaminate.proximity_matches(docs, benchmark.where("item_id = 1"), terms=3, span=30).collect()
    assert {r.doc_id for r in near} >= {r.doc_id for r in got if r.n_hit >= 25}


def test_bpe(spark, docs, empty, texts):
    import public_tokenizers as P
    import tiktoken

    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = bpe.read_ranks(open(path, "rb").read())
    reference = tiktoken.Encoding("x", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    by_id = dict(enumerate(texts[0]))
    for r in bpe.encode_and_decode(docs, path, P.PATTERN, chunk=7).collect():
        ids = reference.encode_ordinary(by_id[r.doc_id] or "")
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256((by_id[r.doc_id] or "").encode()).hexdigest()
    assert bpe.encode_and_decode(empty, path, P.PATTERN).count() == 0
    small = bpe.Transducer(ranks, max_states=50, max_pieces=5)
    r = random.Random(1)
    for _ in range(3000):
        piece = "".join(r.choice("aeinrst hcdßéü漢😀.,01") for _ in range(r.randrange(1, 14)))
        assert small.run(piece.encode()) == [ranks[x] for x in small.merged(piece.encode())]
    tokens = r.choices(list(ranks.values()), k=4000)
    for a, b in zip(tokens, tokens[1:]):
        assert small._stable(a, b) == (small.merged(small.token[a] + small.token[b]) == [small.token[a], small.token[b]])


@pytest.mark.parametrize("data", ["aß漢😀b".encode(), b"\xf0\x9f", b"a\xff\xfeb", b"\xe2\x82", b"\xed\xa0\x80x", b"\xf4\x90\x80\x80", b"\xc0\xafz", b""])
def test_utf8_stream(data):
    for n in (1, 2, 3, 5):
        s = bpe.Utf8Stream()
        assert "".join(s.feed(data[i : i + n]) for i in range(0, len(data), n)) + s.close() == data.decode("utf-8", "replace")


def slow_fingerprint(text):
    from xxhash import xxh64_intdigest

    w = words_of(lower(text))
    if not w:
        return 0
    hashes = [xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def components(values, radius=3):
    label = list(range(len(values)))
    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius and label[i] != label[j]:
                label = [label[j] if x == label[i] else x for x in label]
    return label


def test_simhash(docs, empty, texts):
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    prints = [slow_fingerprint(t) for t in texts[0]]
    label = components(prints)
    for i in range(len(prints)):
        assert got[i].fingerprint == f"{prints[i]:016x}"
        assert got[i].component_id == min(j for j in range(len(prints)) if label[j] == label[i])
    assert simhash.near_duplicates(docs).count() == docs.count()
    assert simhash.near_duplicates(empty).count() == 0


def test_simhash_chains(spark):
    """Chains, hot words of 16 bits, and tiles cut into parts."""
    r = random.Random(3)
    values = [r.getrandbits(64) for _ in range(200)]
    for _ in range(600):
        v = r.choice(values[-300:])
        for _ in range(r.randrange(1, 6)):
            v ^= 1 << r.randrange(48)
        values.append(v)
    rows = spark.createDataFrame([(v - 2**64 if v >= 2**63 else v,) for v in values], "fp long")
    from evidentia.llm.components import connected_components

    for tile in (16_384, 40):
        found = {x.node % 2**64: x.label for x in connected_components(simhash.near_links(rows, tile=tile)).collect()}
        distinct = sorted(set(values))
        label = components(distinct)
        groups, other = {}, {}
        for v, x in zip(distinct, label):
            groups.setdefault(x, set()).add(v)
        for v in distinct:
            other.setdefault(found.get(v, ("alone", v)), set()).add(v)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, other.values()))


@pytest.mark.parametrize("tile", [4096, 8])
def test_near_copies(spark, texts, tile):
    """Components by brute force: copies with 1 to 3 changed words, chains, a common passage, null and short texts."""
    r = random.Random(8)
    word = lambda: f"w{r.randrange(10**6)}"
    out, common = list(texts[0]), [word() for _ in range(60)]
    for n in (40, 112, 248):
        for changed in (1, 2, 3):
            w = [word() for _ in range(n)]
            out.append(" ".join(w))
            for at in r.sample(range(n), changed):
                w[at] = word()
            out.append(" ".join(w).upper())
    for _ in range(40):
        out.append(" ".join(common + [word() for _ in range(r.choice([5, 15, 40]))]))
    w = [word() for _ in range(100)]
    for _ in range(30):  # a chain: each copy differs from the one before in one word
        w[r.randrange(100)] = word()
        out.append("  ".join(w))
    sets = []
    for t in out:
        x = (t or "").encode().lower().split()
        sets.append({tuple(x[i : i + 5]) for i in range(max(1, len(x) - 4))})
    want = list(range(len(out)))
    for i, x in enumerate(sets):
        for j in range(i):
            if len(x & sets[j]) >= 0.8 * len(x | sets[j]) and want[i] != want[j]:
                low, high = sorted((want[i], want[j]))
                want = [low if k == high else k for k in want]
    rows = near_copies.near_copies(spark.createDataFrame(list(enumerate(out)), "row long, text string").repartition(3), tile=tile).collect()
    got, first = {x.row: x.component for x in rows}, {}
    assert len(rows) == len(out) and [first.setdefault(got[i], i) for i in range(len(out))] == want


def test_quality(docs, empty, texts):
    by_id = dict(enumerate(texts[0]))
    rows = quality.judge(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        text = by_id[r.doc_id] or ""
        w = words_of(text)
        grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        again = {k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in (i, i + 1, i + 2)}
        lines = [x for x in text.split("\n") if words_of(x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again))
        assert r.base_failed == (len(w) < 50 or 100 * len(again) > 50 * len(w))
        assert not (r.base_failed and r.kept)
    assert quality.judge(empty).count() == 0


def test_quality_fences(spark):
    """In a group of clean rows one that is full of symbols goes and the clean ones stay."""
    r = random.Random(2)
    clean = [" ".join(f"w{r.randrange(10**6)}" for _ in range(80)) for _ in range(150)]
    rows = [(i, t, "en", "a") for i, t in enumerate(clean)] + [(999, " ".join(x + "***" for x in clean[0].split()), "en", "a")]
    got = {x.doc_id: x.kept for x in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert got.pop(999) is False and all(got.values())


def test_quality_fences_adapt(spark):
    """The same row goes where its group has no such symbols, and stays where all rows have them; small groups lean on their language."""
    r = random.Random(2)
    word = lambda: f"w{r.randrange(10**6)}"
    plain = [" ".join(word() for _ in range(r.randrange(60, 140))) for _ in range(400)]
    table = [" ".join(word() + " |" * (r.random() < 0.3) for _ in range(r.randrange(60, 140))) for _ in range(400)]
    odd = " ".join(word() + " |" * (k % 3 == 0) for k in range(90))
    rows = [(i, t, "en", "prose") for i, t in enumerate(plain)] + [(1000 + i, t, "de", "tables") for i, t in enumerate(table)] + [(2000, odd, "en", "prose"), (2001, odd, "de", "tables"), (2002, odd, "en", "one row"), (2003, odd, "de", None)]
    got = {x.doc_id: x for x in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert [(got[k].kept, got[k].failed) for k in range(2000, 2004)] == [(False, "symbol_share"), (True, ""), (False, "symbol_share"), (True, "")]
    assert sum(not got[k].kept for k in got if k < 2000) <= 4


def test_quality_limits_are_no_fixed_counts(spark):
    """Limits by plain sums over the rows of a group; one count goes in a short row and stays in a long one, and by group."""
    r = random.Random(8)
    word = lambda: f"w{r.randrange(10**6)}"
    rows = []
    for g, often in enumerate((0.0, 0.01, 0.05)):
        for k in range(300):
            rows.append((1000 * g + k, " ".join(word() + (" &" if r.random() < often else "") for _ in range(r.randrange(60, 900)))))
    for g in range(3):
        for k, (n, marks) in enumerate(((60, 8), (600, 8), (6_000, 8), (60, 30), (600, 30), (6_000, 30))):
            rows.append((1000 * g + 900 + k, " ".join(word() for _ in range(n)) + " &" * marks))
    docs = spark.createDataFrame([(i, t, "en", f"s{i // 1000}") for i, t in rows], "doc_id long, text string, lang string, source string")
    got = {x.doc_id: "symbol_share" in x.failed for x in quality.judge(docs).collect()}

    count = {i: (t.count("&"), len(t.replace(" ", ""))) for i, t in rows}
    group = {g: sorted((n / d, n, d) for i, (n, d) in count.items() if i // 1000 == g) for g in range(3)}
    upto = lambda g, q: group[g][: -(-len(group[g]) * q // 100)]  # noqa: E731  quantiles of the values themselves, not of buckets
    sums = {g: (len(upto(g, 95)), sum(n for _, n, _ in upto(g, 95)), sum(d for *_, d in upto(g, 95))) for g in range(3)}
    spoken = (sum(s[1] for s in sums.values()) + 0.5) / sum(s[2] for s in sums.values())
    spread = []
    for g in range(3):
        calm = upto(g, 90)
        rate = (sum(n for _, n, _ in calm) + 0.5) / sum(d for *_, d in calm)
        spread.append(sum((n - rate * d) ** 2 / (rate * d) for _, n, d in calm) / len(calm))
    want, unsure = {}, set()
    for i, (n, d) in count.items():
        k, sn, sd = sums[i // 1000]
        m = d * (sn + 100 * sd / k * spoken) / (sd + 100 * sd / k)
        surprise = (n * np.log(n / m) - n + m if n > m else 0) / max(1, sorted(spread)[1]) / np.log(1e9)
        want[i] = surprise > 1
        unsure |= {i} if 0.8 < surprise < 1.25 else set()
    assert len(unsure) < 5 and {k: v for k, v in got.items() if k not in unsure} == {k: v for k, v in want.items() if k not in unsure}
    by_group = [tuple(got[1000 * g + 900 + k] for k in range(6)) for g in range(3)]
    assert len(set(by_group)) > 1 and by_group[0][3] and not by_group[0][5]


def placed_by_sorting(rows, shards, cell_rows, seed=7):
    """Shard and slot of rows (doc_id, text, source) by one sort of all."""
    from struct import pack

    from xxhash import xxh64_intdigest

    signed = lambda h: h - 2**64 if h >= 2**63 else h
    start, cells = xxh64_intdigest(pack("<i", seed), 42), max(64, -(-len(rows) // cell_rows))

    def shuffle(doc_id, text):
        data = (text or "").encode()
        h = start
        for v in (doc_id, zlib.crc32(data), len(data) + 16):
            h = h if v is None else xxh64_intdigest(pack("<q", v), h)
        return signed(h)

    sources = {}
    for doc_id, text, source in rows:
        h = shuffle(doc_id, text)
        sources.setdefault(source, []).append(((h >> 20) % cells, h, doc_id))
    ranked = []
    for source, own in sources.items():
        offset = signed(xxh64_intdigest(pack("<i", source is None), xxh64_intdigest((source or "").encode(), start))) % 2**30 / 2**30
        ranked += [((k + offset) / len(own), source or "", source is None, *x) for k, x in enumerate(sorted(own))]
    place = {x[-1]: k for k, x in enumerate(sorted(ranked))}
    shard = {i: k * shards // len(rows) for i, k in place.items()}
    first = {s: min(k for i, k in place.items() if shard[i] == s) for s in shard.values()}
    return {i: (shard[i], k - first[shard[i]]) for i, k in place.items()}


def test_shards_by_sorting(spark, monkeypatch):
    """Every place by brute force; sources of one row are spread over all shards."""
    monkeypatch.setattr(shards, "CELL_ROWS", 5)
    monkeypatch.setattr(shards, "BLOCK", 7)
    rows = [(i, f"t{i % 50}" if i % 9 else None, ["hot", "hot", "b", None, f"only{i}"][i % 5]) for i in range(1200)]
    got = shards.shard(spark.createDataFrame(rows, "doc_id long, text string, source string"), shards=8).collect()
    assert {r.doc_id: (r.shard, r.slot) for r in got} == placed_by_sorting(rows, 8, 5)
    alone = Counter(r.shard for r in got if rows[r.doc_id][2] not in ("hot", "b", None))
    assert len(alone) == 8 and max(alone.values()) < 2 * min(alone.values())


def test_shards(docs, empty, texts):
    rows = shards.shard(docs, shards=7).collect()
    by_id = dict(enumerate(texts[0]))
    counts = Counter(r.shard for r in rows)
    assert len(rows) == docs.count() and max(counts.values()) - min(counts.values()) <= 1 and set(counts) == set(range(7))
    for s, n in counts.items():
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(n))
    for r in rows:
        data = (by_id[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 16, zlib.crc32(data), "rows", None)
    assert shards.shard(empty).count() == 0


def test_shards_match_the_mixture(spark):
    rows = spark.range(4000).selectExpr("id as doc_id", "cast(id as string) as text", "case when id % 3 = 0 then 'hot' else concat('s', id % 5) end as source")
    share = {r.source: r["count"] for r in rows.groupBy("source").count().collect()}
    got = shards.shard(rows, shards=10).join(rows.select("doc_id", "source"), "doc_id").groupBy("shard", "source").count().collect()
    assert all(abs(r["count"] - share[r.source] / 10) <= 2 for r in got)


def test_substrings(docs, empty, texts):
    for length, run in ((35, 16), (5, 3)):
        w = {i: (t or "").encode().split() for i, t in enumerate(texts[0])}
        rows = [w[r.doc_id] for r in docs.select("doc_id").collect()]
        counts = Counter(tuple(x[i : i + length]) for x in rows for i in range(len(x) - length + 1))
        for r in substrings.digest(substrings.deduplicate(docs, length=length, run=run)).collect():
            x = w[r.doc_id]
            gone = {k for i in range(len(x) - length + 1) if counts[tuple(x[i : i + length])] > 1 for k in range(i, i + length)}
            assert (r.n_words, r.n_removed) == (len(x), len(gone))
            assert r.kept_sha256 == hashlib.sha256(b" ".join(v for k, v in enumerate(x) if k not in gone)).hexdigest()
    assert substrings.deduplicate(empty).count() == 0


def test_substrings_have_one_plan_at_every_size(spark):
    """No side that grows with the corpus is broadcast while small; copies of a text don't repeat its runs."""
    texts = [" ".join(f"a{i}" for i in range(60))] * 5 + [" ".join(f"b{i}" for i in range(60))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert substrings.repeated_runs(docs, 35, 16).count() == 0
    out = substrings.deduplicate(docs)
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
    assert {r.doc_id: r.n_removed for r in out.collect()} == {i: 60 if i < 5 else 0 for i in range(6)}


PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    values = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 * (v > 9) for v in values) % 10 == 0


def plain_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if not (kind == "ip" and any(int(p) > 255 for p in m[0].split(".")) or kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)) or kind == "phone" and not 9 <= len(digits) <= 15):
                out.append((m.start(), k, kind, m.end()))
    return sorted(out)


def test_pii(spark, empty):
    r = random.Random(4)
    parts = ["a.b@c.de", "é x@y.z", "a@b@c.d", "a@b.c.d_e@x.yy", "1.2.3.4.5.6.7.8", "256.1.1.1", "01.002.0255.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 123-4567", "+49 1", "+1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", " ", "\n", "漢😀", "0", "12 34", ".", "@", "+", "word", "4012888888881881"]
    texts = ["".join(r.choice(parts) + r.choice(["", " ", "x"]) for _ in range(r.randrange(1, 12))) for _ in range(400)] + [None, "", "9" * 30_000, "a" * 30_000 + "@", "1 " * 20_000]
    docs = spark.createDataFrame([(i, t, "r", "k") for i, t in enumerate(texts)] + [(3, texts[3], "r", "k")], "doc_id long, text string, row string, kind string")
    rows = pii.detect(docs).collect()
    assert len(rows) == len(texts) + 1
    for x in rows:
        want = plain_spans(texts[x.doc_id])
        assert [x.n_email, x.n_ip, x.n_card, x.n_phone] == [sum(s[2] == k for s in want) for k in PLAIN], texts[x.doc_id]
        listed = ",".join(f"{s[2]}:{s[0]}:{s[3]}" for s in want)
        assert x.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert set(filter(None, listed.split(","))) <= set(x.spans.split(","))
    assert pii.detect(empty).count() == 0


def test_revealing_terms(spark):
    """A rare name that always stands beside one address is a span; common words are not, and other texts stay."""
    r = random.Random(6)
    filler = lambda: " ".join(r.choice(["the", "of", "and", "new", "old"]) for _ in range(12))
    texts = [f"{filler()} Quentin <q@mail.org> the {filler()} {i}" for i in range(6)] + [f"{filler()} {i}" for i in range(200)] + [f"{filler()} once{i}@mail.org {filler()}" for i in range(5)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {x.doc_id: x for x in pii.detect(docs).collect()}
    for i, t in enumerate(texts):
        at = t.find("Quentin")
        assert rows[i].n_term == (at >= 0) and (at < 0 or f"term:{at}:{at + 7}" in rows[i].spans)
    clean = {x.doc_id: x.text for x in pii.sanitise(docs).collect()}
    assert all((clean[i] == t) == (i >= 6 and i < 206) for i, t in enumerate(texts))
    assert not any("Quentin" in t or "@" in t for t in clean.values()) and all("[EMAIL]" in clean[i] for i in range(6))


def test_terms_by_hand(spark):
    """Shares of kinds and entities by counting: a word of texts with addresses is a span wherever it stands."""
    r = random.Random(12)
    common = ["the", "of", "and", "new", "old", "small"]
    filler = lambda k: " ".join(r.choice(common) for _ in range(k))
    texts = []
    for i in range(600):
        t = f"{filler(30)} w{i}x"
        if i % 10 == 0:
            t = f"{t} inbox {filler(70)} someone{i}@mail{i}.org {filler(3)}"
        if i % 20 == 5:
            t += f" Kontakt {filler(2)} +49 30 12345{i:03d}"
        if i == 7:
            t += " (inbox) alone"
        texts.append(t)
    texts += [texts[0]] * 50 + [None, ""]
    docs = spark.createDataFrame([(i, t, "x", 1.0) for i, t in enumerate(texts)], "doc_id long, text string, row string, share double")
    got = {x.doc_id: x for x in pii.detect(docs).collect()}
    distinct = list(dict.fromkeys(texts))
    words = {t: {w for x in (t or "").split() if len(w := x.strip("()+")) > 2 and w.isalpha()} for t in distinct}
    share = {}
    for sign in (r"@", r"\+49", r"@|\+49"):
        holds = [t for t in distinct if re.search(sign, t or "")]
        for w in set().union(*words.values()):
            n_t, n_te = sum(w in words[t] for t in distinct), sum(w in words[t] for t in holds)
            low = n_te - 2 * n_te**0.5
            if n_te >= 3 and low > 0:
                share[w] = max(share.get(w, 0), np.log2(len(distinct) * low / (n_t * len(holds))) / np.log2(len(distinct) / len(holds)))
    assert {w for w, v in share.items() if v >= 0.8} == {"inbox", "Kontakt"}
    for i, t in enumerate(texts):
        want = sorted(m.start() for m in re.finditer(r"\b(?:inbox|Kontakt)\b", t or ""))
        assert sorted(int(x.split(":")[1]) for x in got[i].spans.split(",") if x.startswith("term")) == want
    clean = pii.sanitise(docs)
    assert clean.columns == docs.columns and not any("inbox" in (x.text or "") for x in clean.collect())


def corpus(n, seed):
    r = random.Random(seed)
    syllables = {"en": ["th", "er", "on", "an", "re", "ing"], "de": ["sch", "ein", "ung", "ü", "ver", "keit"], "fr": ["eau", "é", "tion", "ou", "qui", "le"]}
    out = []
    for i in range(n):
        lang = list(syllables)[i % 3]
        w = ["".join(r.choices(syllables[lang], k=r.randrange(1, 4))) for _ in range(40)]
        toxic = i % 5 == 0
        if toxic:
            w[r.randrange(40)] = r.choice(["idiot", "moron", "Scum!"])
        out.append((i, " ".join(w), lang, int(toxic)))
    return out


def test_toxicity(spark, empty):
    rows = corpus(600, 1)
    odd = [(1000, "you 1d10t and m0r0n", "en", None), (1001, "an i d i o t here", "en", None), (1002, None, None, None), (1003, "", None, None), (1004, "idiooooot", None, None), (1005, "s.c.u.m", None, None), (1006, "x" * 50_000, None, None)]
    docs = spark.createDataFrame([r[:2] for r in rows + odd], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows] + [(None, 1), (5, None)], "doc_id long, toxic int")
    got = {x.doc_id: x for x in toxicity.report(docs, labels).collect()}
    assert len(got) == len(rows) + len(odd)
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert all(got[r[0]].held_out for r in held) and sum(x.held_out for x in got.values() if x.doc_id < 1000) == len(held)
    assert np.mean([got[r[0]].predicted == r[3] for r in held]) > 0.97
    assert all(0 <= x.score <= 1 and x.predicted == (x.score >= 0.5) for x in got.values())
    assert [got[i].predicted for i in (1000, 1001, 1002, 1003, 1004, 1005, 1006)] == [1, 1, 0, 0, 1, 1, 0]
    assert toxicity.report(empty, labels).count() == 0
    assert all(x.score == 0 for x in toxicity.report(docs, labels.limit(0)).collect())


LEET = {"a": "4", "e": "3", "i": "1", "o": "0", "s": "$", "t": "7"}
DISGUISES = {
    "look-alikes": lambda w: "".join(LEET.get(c, c) for c in w),
    "spaces": " ".join,
    "marks": ".".join,
    "repeats": lambda w: "".join(c * (4 if k % 2 else 1) for k, c in enumerate(w)),
    "spaced look-alikes": lambda w: " ".join(LEET.get(c, c) for c in w),
}


@pytest.mark.parametrize("disguise", sorted(DISGUISES))
def test_disguised_words(spark, monkeypatch, disguise):
    """Held-out rows whose only toxic word is disguised are caught, by the decoder alone."""
    r = random.Random(9)
    bad = ["idiot", "moron", "loser", "stupid", "trash"]
    prose = lambda k: " ".join(r.choice(["the", "others", "said", "that", "it", "is", "a", "lost", "stone", "road", "and", "rest", "idol", "more", "on", "so"]) for _ in range(k))
    hidden = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 5 == 0][:60]
    rows = []
    for i in range(900):
        word = bad[i % 5]
        if i in hidden:
            rows.append((i, f"{prose(20)} {DISGUISES[disguise](word)} {prose(20)}"))
        else:
            rows.append((i, f"{prose(20)} {word if i % 3 == 0 else ''} {prose(20)}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(900) if i not in hidden], "doc_id long, toxic int")
    got = {x.doc_id: x.predicted for x in toxicity.report(docs, labels).collect()}
    known = [i for i in hidden if i < 900]
    assert np.mean([got[i] for i in known]) >= 0.9
    assert np.mean([got[i] == (i % 3 == 0) for i in got if i not in hidden]) > 0.99


def test_viterbi_by_all_paths(spark):
    """The decoder's path is the best of all paths through the lattice."""
    from itertools import product

    r = random.Random(3)
    model = toxicity.log_model({int(k): r.randrange(1, 200) for k in r.sample(range(toxicity.CLASSES**3), 4000)})
    restorer = toxicity.Restorer(model)

    def value(choice):
        a = b = 0
        total = 0.0
        for c, ch, cost in choice:
            total -= cost
            if ch and not (c == b == 0):
                total += model[a, b, c] + np.log(toxicity.CLASSES - 1)
                a, b = b, c
        return total + model[a, b, 0]

    for _ in range(150):
        stretch = "".join(r.choice("aabst01$!. éо") for _ in range(r.randrange(1, 7)))
        paths = list(product(*[restorer.options(stretch, i) for i in range(len(stretch))]))
        best = max(map(value, paths))
        texts = set()
        for p in paths:
            if value(p) > best - 1e-9:
                last, out = 0, ""
                for c, ch, _ in p:
                    if ch and not (c == last == 0):
                        out, last = out + ch, c
                texts.add(out)
        assert restorer.restore(stretch) in texts


def test_language(spark, empty):
    rows = corpus(600, 2)
    odd = [(1000, None, "en"), (1001, "123 !? ½ ² Ⅷ ①", "en"), (1002, "", None), (1003, "eau qui le", None), (1004, "漢", None), (1005, "keit " * 60_000, None)]
    got = {x.doc_id: x for x in language.identify(spark.createDataFrame([r[:3] for r in rows] + odd, "doc_id long, text string, lang string")).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert np.mean([got[r[0]].lang_pred == r[2] for r in held]) > 0.99
    assert [got[i].lang_pred for i in range(1000, 1004)] == ["und", "und", "und", "fr"] and got[1004].lang_pred != "und" and got[1005].lang_pred == "de"
    assert all(0 <= x.score <= 1 for x in got.values())
    assert language.identify(empty).count() == 0


def test_language_by_hand(spark):
    """Posteriors by a plain dictionary of grams, and a rare language that a sample of all rows would lose."""
    rows = [r[:3] for r in corpus(300, 2)] + [(1000 + i, "zzyx qqy", "xx") for i in range(4)]
    docs = spark.createDataFrame([(*r, "s", "n") for r in rows], "doc_id long, text string, lang string, score string, bucket string")
    got = {x.doc_id: x for x in language.identify(docs, max_train=1000).collect()}

    def grams(text):
        c = [ord(x) if ord(x) >= 65 else 32 for x in f" {text.lower()} "]
        for i in range(len(c)):
            key = 0
            for n in range(min(3, len(c) - i)):
                key = (key * 0x01000193 + c[i + n]) % 2**32
                yield ((key + n) * 2654435761 % 2**32) >> 17

    learned = [(t, x) for i, t, x in rows if zlib.crc32(str(i).encode()) % 5]
    langs = sorted({x for _, x in learned})
    counts = {x: Counter(g for t, y in learned if y == x for g in grams(t)) for x in langs}
    for i, t, _ in rows[::17] + rows[-1:]:
        log = {x: float(np.float32(np.log(sum(y == x for _, y in learned) / len(learned)))) for x in langs}
        for g in grams(t):
            for x in langs:
                log[x] += float(np.float32(np.log((counts[x][g] + 0.5) / (sum(counts[x].values()) + 0.5 * 2**15))))
        best = max(log, key=log.get)
        assert got[i].lang_pred == best and got[i].score == pytest.approx(1 / sum(np.exp(v - log[best]) for v in log.values()), abs=1e-9)
    assert all(got[1000 + i].lang_pred == "xx" for i in range(4))
    few = {x.lang_pred for x in language.identify(docs, max_train=20).collect()}
    assert "xx" in few


def test_neighbours_do_not_matter(spark):
    """Scores and counted trigrams are the same in any order and partitioning of the rows, for very short texts too."""
    rows = [(i, t[: 3 + i % 9] if i % 2 else t, x) for i, t, x in (r[:3] for r in corpus(240, 4))] + [(900, "", "en"), (901, None, "en"), (902, "ab", None)]
    orders = [spark.createDataFrame(o, "doc_id long, text string, lang string").coalesce(1) for o in (rows, rows[::-1])]
    orders.append(orders[0].repartition(7))
    scores = [{x.doc_id: (x.lang_pred, x.score) for x in language.identify(o).collect()} for o in orders]
    trigrams = [sorted(map(tuple, toxicity.trigram_counts(o).collect())) for o in orders]
    for other, counts in zip(scores[1:], trigrams[1:]):
        assert {k: v[0] for k, v in other.items()} == {k: v[0] for k, v in scores[0].items()}
        assert all(other[k][1] == pytest.approx(scores[0][k][1], abs=1e-9) for k in other)
        assert counts == trigrams[0]
    # "ab" counts as boundary-a-b and a-b-boundary, and nothing else
    assert sorted(map(tuple, toxicity.trigram_counts(spark.createDataFrame([(1, "ab"), (2, "")], "doc_id long, text string")).collect())) == [(1 * 28 + 2, 1), ((1 * 28 + 2) * 28, 1)]


def page_rows():
    big = "<p>" + "y" * 1200 + "é</p>"
    return [(1, "http://a/1", big), (2, "http://a/2 x\r\nY: z", big), (9, None, big), (3, "u", "small"), (4, "u", "small"), (5, "u", None), (6, "u", ""), (7, "u", big + "!"), (7, "u", big + "!"), (None, "u", big)]


def test_warc(spark):
    pages = spark.createDataFrame(page_rows(), "page_id long, url string, html string").repartition(3)
    got = warc.report(pages).collect()
    assert len(got) == 10
    for r in got:
        assert r.payload_bytes == max(len((h or "").encode()) for p, _, h in page_rows() if p == r.page_id)
        assert r.payload_digest == next(hashlib.sha1((h or "").encode()).hexdigest() for p, _, h in page_rows() if p == r.page_id)
        assert (r.record_type, r.refers_to) == (("revisit", 9) if r.page_id in (1, 2, None) else ("response", None))
    assert warc.report(pages.limit(0)).count() == 0


@pytest.mark.parametrize("packed", [True, False])
def test_salvage(packed):
    """Records after damage are recovered and the gap's bytes are reported."""
    import gzip

    r = random.Random(7)
    payloads = [bytes(r.randrange(256) for _ in range(400)) for _ in range(12)]
    records = [warc.record(i, f"u{i}", p, hashlib.sha1(p).hexdigest()) for i, p in enumerate(payloads)]
    members = [gzip.compress(x) for x in records] if packed else records
    data = bytearray(b"".join(members))
    starts = np.cumsum([0] + [len(x) for x in members])
    for k in (2, 3, 7):
        at = starts[k] + len(members[k]) // 2
        data[at : at + 8] = bytes(8)
    data = bytes(data[: starts[11] + len(members[11]) - 5])
    found = list(warc.salvage(lambda at, n: data[at : at + n], len(data)))
    assert [x[3]["page_id"] for x in found if x[3]] == [0, 1, 4, 5, 6, 8, 9, 10]
    assert all(x[3]["payload"] == payloads[x[3]["page_id"]] for x in found if x[3])
    assert [(a, b) for a, b, problem, x in found if problem] == [(starts[2], starts[4]), (starts[7], starts[8]), (starts[11], len(data))]
    assert found[0][0] == 0 and all(a[1] == b[0] for a, b in zip(found, found[1:])) and found[-1][1] == len(data)


def test_long_headers():
    """A sound record with a header of megabytes is read; one whose header doesn't end gives way to the next record."""
    sha = lambda p: hashlib.sha1(p).hexdigest()
    long, plain = warc.record(1, "u" * 3_000_000, b"one", sha(b"one")), warc.record(2, "u2", b"two", sha(b"two"))
    data = long + plain
    found = list(warc.salvage(lambda at, n: data[at : at + n], len(data)))
    assert [(x[2], x[3]["payload"]) for x in found] == [(None, b"one"), (None, b"two")]
    endless = long[: 2_500_000] + b"\r\n" + plain
    found = list(warc.salvage(lambda at, n: endless[at : at + n], len(endless)))
    assert [bool(x[2]) for x in found] == [True, False] and found[1][3]["page_id"] == 2 and found[0][1] == 2_500_002


def test_lost_records_are_errors(spark, monkeypatch):
    """A record that can't be read again fails the report, which would else look complete."""
    from pyspark.sql import functions as F

    pages = spark.createDataFrame([(i, "u", t) for i, t in enumerate(("<p>one</p>", "<p>two</p>", "<p>three</p>"))], "page_id long, url string, html string")
    assert warc.report(pages).count() == 3
    gaps = warc.round_trip(pages).withColumn("problem", F.lit("broken"))
    monkeypatch.setattr(warc, "round_trip", lambda *_, **__: gaps)
    with pytest.raises(Exception, match="a record was lost"):
        warc.report(pages).collect()
