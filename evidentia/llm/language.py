"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts of hashed 1- to 3-grams by language are learned from rows with text and lang that are not held out, of which
about `max_train` of each language are taken by the hash of their id: all rows of a language that has fewer. The matrix of
log probabilities (buckets x languages) goes to all workers; a batch's n-grams look up their rows there and sum up by
text, as a sparse matrix times that matrix. No gram reaches beyond its text.

A text that is null or has no letter (Unicode category L) is `und` with score 0. Without training rows every text is
`und`. Rows of one id are judged apart. lang, source and doc_id never enter a prediction. Further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, saved, small_batches, text_batches

BUCKET_BITS = 15
NO_GRAM = (1 << BUCKET_BITS) + 1  # the row after those of buckets and priors, which is zero
LETTER = r"\p{L}"


def _grams(texts: list[str]):
    """Buckets of the 1- to 3-grams of the texts, in runs by text, and where each text's run starts.

    A gram that would go on into the next text is NO_GRAM, so a text's grams don't depend on its neighbours.
    """
    import numpy as np

    parts = [f" {t.lower()} ".encode("utf-32-le") for t in texts]
    bounds = np.r_[0, np.cumsum([len(p) // 4 for p in parts])]
    c = np.frombuffer(b"".join(parts), "<u4")
    c = np.where(c < 65, np.uint32(32), c)  # digits, marks and spaces alike
    hashed = []
    key = np.zeros(len(c), np.uint32)
    for n in range(3):
        shifted = np.r_[c[n:], np.zeros(n, np.uint32)]
        key = key * np.uint32(0x01000193) + shifted
        bucket = (key + np.uint32(n)) * np.uint32(2654435761) >> np.uint32(32 - BUCKET_BITS)
        for k in range(1, n + 1):
            bucket[bounds[1:] - k] = NO_GRAM
        hashed.append(bucket)
    return hashed, bounds


def train(docs: DataFrame, *, max_train: int = 5_000) -> tuple[list[str], object]:
    """The languages, sorted, and the matrix of log probabilities, then a row of log priors and one of zeros."""
    import numpy as np

    rows = docs.select("text", "lang", "doc_id").where(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out())
    # One row a language, as has the matrix that goes to all workers.
    share = saved(rows.groupBy("lang").agg((max_train / F.count("*")).alias("share")), "languages")
    rows = rows.join(F.broadcast(share), "lang").where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < F.col("share") * (1 << 40)).select("text", "lang")

    def count(batches):
        import pyarrow as pa

        totals: dict[str, np.ndarray] = {}
        for batch in text_batches(batches, "text", limit=1 << 20):
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang in set(langs):
                own = [t for t, x in zip(texts, langs) if x == lang]
                total = totals.setdefault(lang, np.zeros((1 << BUCKET_BITS) + 1, np.int64))
                for part in _grams(own)[0]:
                    total[:-1] += np.bincount(part, minlength=NO_GRAM + 1)[: 1 << BUCKET_BITS]
                total[-1] += len(own)
        for lang, total in totals.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(total[at])], names=["lang", "bucket", "n"])

    counts = rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect()  # languages x 2^15 rows at most
    langs = sorted({r.lang for r in counts})
    n = np.zeros(((1 << BUCKET_BITS) + 1, len(langs)))
    for r in counts:
        n[r.bucket, langs.index(r.lang)] = r.n
    grams = n[:-1] + 0.5
    prior = n[-1] / max(1, n[-1].sum())
    return langs, np.vstack([np.log(grams / grams.sum(axis=0)), np.log(np.maximum(prior, 1e-9)), np.zeros(len(langs))]).astype(np.float32)


def identify(docs: DataFrame, **settings) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred and score, the posterior probability of lang_pred."""
    langs, matrix = train(small_batches(docs), **settings)
    shared = docs.sparkSession.sparkContext.broadcast(matrix)  # languages x 2^15 floats

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import regex

        log, letter = shared.value, regex.compile(LETTER)
        for batch in text_batches(batches, "text", limit=1 << 20):
            texts = [t if t and letter.search(t) else None for t in batch.column(1).to_pylist()]
            hashed, bounds = _grams([t or "" for t in texts])
            sums = np.zeros((len(texts), len(langs)))
            for part in hashed:
                sums += np.add.reduceat(log[part], bounds[:-1], axis=0, dtype=np.float64)
            sums += log[-2]
            best = sums.argmax(axis=1) if langs else np.zeros(len(texts), int)
            score = 1 / np.exp(np.clip(sums - sums.max(axis=1, keepdims=True), -700, 0)).sum(axis=1) if langs else np.zeros(len(texts))
            names = [langs[b] if t is not None and langs else "und" for t, b in zip(texts, best)]
            score = np.where([x == "und" and t is None or not langs for x, t in zip(names, texts)], 0.0, score)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(names, pa.string()), pa.array(score)], names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out().alias("held_out"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
