"""The pipeline's stages against brute force, and the checked queries against their SQL."""

import duckdb
import pytest

import corpus_pipeline
from evidentia.llm.common import table
from evidentia.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels", "clicks", "sales", "sale_lines"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    rel = con.sql(ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert sorted(map(repr, (tuple(r[c] for c in rel.columns) for r in df.collect()))) == sorted(map(repr, rel.fetchall()))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_near_copies_go(spark):
    """Of a text and its copies with 1 to 3 of 248 words changed the first stays."""
    words = [f"w{i}" for i in range(248)]
    copies = [" ".join("other" if i in changed else w for i, w in enumerate(words)) for changed in ((), (50,), (20, 80), (10, 60, 200))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(copies)], "doc_id long, text string, lang string, source string, n_chars long")
    assert [r.doc_id for r in dict(corpus_pipeline.STAGES)["near duplicates"](spark, docs, SF).collect()] == [0]


def test_rows_without_own_id_stay(spark):
    """Null ids and repeated ids with different texts are rows of their own; of each group one row stays."""
    words = lambda k: " ".join(f"{k}w{i}" for i in range(60))
    rows = [(None, words("a")), (None, words("b")), (1, words("b")), (None, words("c")), (2, words("d")), (3, words("d")), (3, words("e")), (3, words("f")), (3, words("f")), (None, None), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    stage = dict(corpus_pipeline.STAGES)["near duplicates"]
    kept = [(r.doc_id, r.text) for r in stage(spark, docs, SF).collect()]
    want = [(None, words("a")), (1, words("b")), (None, words("c")), (2, words("d")), (3, words("e")), (3, words("f")), (None, None)]
    assert sorted(kept, key=repr) == sorted(want, key=repr)


def test_stages_take_effect(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    toxic = {r.doc_id for r in QUERIES["op5_toxicity"](spark, SF).where("predicted = 1").collect()}
    kept = corpus_pipeline.drop_toxic(spark, docs, SF)
    assert kept.columns == columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - toxic
    dirty = {r.doc_id for r in QUERIES["op1_decontaminate"](spark, SF).where("contaminated").collect()}
    clean = corpus_pipeline.drop_contaminated(spark, docs, SF)
    assert dirty and clean.columns == columns and {r.doc_id for r in clean.collect()} == {r.doc_id for r in docs.collect()} - dirty
    spans = {r.doc_id for r in QUERIES["op9_pii"](spark, SF).where("spans <> ''").collect()}
    before = {r.doc_id: r.text for r in docs.collect()}
    after = corpus_pipeline.sanitise(spark, docs, SF)
    assert after.columns == columns and {r.doc_id for r in after.collect() if r.text != before[r.doc_id]} == spans
    assert all(r.n_chars == len(r.text) for r in after.collect())


def test_odd_rows(spark):
    """Null ids and texts, empty and very long ones, repeats and clashing names: stages keep rows and columns, and tokens are tiktoken's."""
    import hashlib

    import public_tokenizers as P
    import tiktoken

    from evidentia.llm import bpe

    clean = " ".join(f"plain{i}" for i in range(40))
    rows = [(None, None), (None, clean + " null"), (10**6, ""), (10**6 + 1, "word " * 30_000), (10**6 + 2, "z" * 40_000), (10**6 + 3, clean), (10**6 + 4, " \n\t"), (10**6 + 5, "é漢😀 a\u00a0b")]
    docs = spark.createDataFrame([(*r, "en", "s", None if r[1] is None else len(r[1]), 1, "t", "f", 2, "r", "k") for r in rows + rows[3:4]], "doc_id long, text string, lang string, source string, n_chars long, row long, term string, fp string, label long, doc string, kind string")
    at = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, at, SF)
        assert kept.columns == docs.columns
        before, after = (sorted(map(repr, f.collect())) for f in (at, kept))
        # nothing here is toxic, personal or of the benchmark; the null, the empty and the blank text are copies, and so are the
        # repeated rows and the two texts that one word tells apart
        assert len(before) - len(after) == 4 if name == "near duplicates" else before == after, name
        at = kept
    reference = tiktoken.Encoding("x", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(open(P.path(corpus_pipeline.VOCABULARY), "rb").read()), special_tokens={})
    texts = sorted(((r.doc_id, r.text or "") for r in at.collect()), key=repr)
    want = sorted(((i, len(ids := reference.encode_ordinary(t)), hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) for i, t in texts), key=repr)
    got = corpus_pipeline.STAGES[-1][1](spark, at, SF).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == want


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_empty(spark, stage):
    docs = table(spark, SF, "documents").limit(0)
    assert stage[1](spark, docs, SF).count() == 0
