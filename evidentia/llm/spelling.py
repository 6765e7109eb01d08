"""Spelling variant grouping by a symmetric-delete join.

Words are counted within each task first, so that only (word, count) rows are shuffled. Every word then emits itself and
its distinct single deletions as keys. Two words are one edit apart exactly if they share a key under which the places of
their edits meet: a deletion carries the run of equal letters from which the letter went (any letter of a run gives the
same key), a word's own key has no place and meets deletions only. So an equi-join on the key with a check of the places
verifies a distance of exactly one, and gives each pair once: a pair of equal length shares the key without the replaced
letter, a pair of unequal length the shorter word. The number of words under a key is bounded by its length times the
letters of the alphabet, whatever the corpus.

Long words would emit the square of their length. Keys of over `PLAIN` letters are therefore given as their length and a
polynomial hash modulo 2^127 - 1, and words of that length by the same hash; their letters come back by a join.

A word's form is its near word of largest count, at least twice its own (ties: the smallest in code-point order). Forms
have growing counts, so following them ends; roots are found by doubling the step in each round.

Null texts have no words. A null doc_id deletes nothing. Rows count by themselves, repeated ones too. Very long texts are
read whole. Other columns are not read. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, small_batches, text_batches

LETTERS = "[A-Za-zÀ-ÿ]+"
SPARED, LEAST_LETTERS, LEAST_COUNT, RATIO = 97, 5, 3, 2
PLAIN, MODULUS, BASE = 64, (1 << 127) - 1, 0x1F3D5B79A2C4E6081
TABLE_WORDS = 200_000  # distinct words that a task holds before it emits their counts


def counted(batches):
    """(word, n) of record batches (doc_id, text); a word may come several times."""
    import re
    from collections import Counter
    from zlib import crc32

    import pyarrow as pa

    letters, table = re.compile(LETTERS), Counter()

    def emitted():
        out = pa.RecordBatch.from_arrays([pa.array(table.keys(), pa.string()), pa.array(table.values(), pa.int64())], names=["word", "n"])
        table.clear()
        return out

    for batch in text_batches(batches, "text"):
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            # Bytes lower A-Z alone. A run's fate depends on it and the document, so it is decided once for all its places.
            runs = Counter(letters.findall((text or "").encode().lower().decode()))
            start = None if doc_id is None else crc32(b"%d:" % doc_id)
            for run, n in runs.items():
                if start is not None and (h := crc32(run.encode(), start)) % SPARED == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1 :]
                if len(run) >= LEAST_LETTERS:
                    table[run] += n
            if len(table) >= TABLE_WORDS:
                yield emitted()
    if table:
        yield emitted()


def words(docs: DataFrame, *, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words of docs (doc_id, text) that occur often enough."""
    rows = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def named(letters: str) -> str:
    """A key or word as rows carry it: itself, or its length and hash if it is long."""
    if len(letters) <= PLAIN:
        return letters
    h = 0
    for c in letters:
        h = (h * BASE + ord(c)) % MODULUS
    return f"#{len(letters)}:{h:x}"


def deletions(word: str):
    """(key, low, high) of each distinct deletion: any letter from low to high, a run of equal ones, gives the key."""
    n, low = len(word), 0
    before, after, power = [0], [0], [1]
    if n > PLAIN + 1:
        for c in word:
            before.append((before[-1] * BASE + ord(c)) % MODULUS)
            power.append(power[-1] * BASE % MODULUS)
        for k, c in enumerate(reversed(word)):
            after.append((after[-1] + ord(c) * power[k]) % MODULUS)
    while low < n:
        high = low
        while high + 1 < n and word[high + 1] == word[low]:
            high += 1
        if n > PLAIN + 1:
            key = f"#{n - 1}:{(before[low] * power[n - 1 - low] + after[n - 1 - low]) % MODULUS:x}"
        else:
            key = word[:low] + word[low + 1 :]
        yield key, low, high
        low = high + 1


def keyed(batches):
    """(key, low, high, name, n) of record batches (word, n): a word's own key has the places -1."""
    import pyarrow as pa

    names = ["key", "low", "high", "name", "n"]
    types = [pa.string(), pa.int32(), pa.int32(), pa.string(), pa.int64()]

    def emitted(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    rows = []
    for batch in batches:
        for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            name = named(word)
            rows.append((name, -1, -1, name, n))
            for key, low, high in deletions(word):
                rows.append((key, low, high, name, n))
                if len(rows) >= 1 << 15:
                    yield emitted(rows)
                    rows = []
    if rows:
        yield emitted(rows)


def named_words(vocabulary: DataFrame) -> DataFrame:
    """(name, word) of the words that rows carry by a hash."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(map(named, batch.column(0).to_pylist()), pa.string()), batch.column(0)], names=["name", "word"])

    return vocabulary.where(F.length("word") > PLAIN).select("word").mapInArrow(run, "name string, word string")


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """(name, other, other_n) of all ordered pairs of words (word, n) that are exactly one edit apart."""
    keys = saved(vocabulary.select("word", "n").mapInArrow(keyed, "key string, low int, high int, name string, n long"), "keys")
    other = keys.select("key", F.col("low").alias("other_low"), F.col("high").alias("other_high"), F.col("name").alias("other"), F.col("n").alias("other_n"))
    own, other_own = F.col("low") < 0, F.col("other_low") < 0
    meet = (own != other_own) | (~own & ~other_own & (F.col("low") <= F.col("other_high")) & (F.col("other_low") <= F.col("high")))
    return keys.join(other, "key").where((F.col("name") != F.col("other")) & meet).select("name", "other", "other_n")


def forms(vocabulary: DataFrame, *, ratio: int = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n) of every word of vocabulary (word, n)."""
    pairs, every = near_pairs(vocabulary).withColumnRenamed("other", "word"), vocabulary.withColumn("name", F.col("word"))
    names = saved(named_words(vocabulary), "long-words")
    if not names.isEmpty():
        pairs, hashed = saved(pairs, "pairs"), F.col("word").startswith("#")
        spelled = pairs.where(hashed).select("name", F.col("word").alias("of"), "other_n").join(names.select(F.col("name").alias("of"), "word"), "of")
        pairs = pairs.where(~hashed).unionByName(spelled.select("name", "word", "other_n"))
        every = every.where(F.length("word") <= PLAIN).unionByName(vocabulary.join(names, "word"), allowMissingColumns=True)
    best = pairs.groupBy("name").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "word")).alias("best"))
    joined = every.join(best, "name", "left").withColumn("most", -F.col("best.less"))
    chosen = F.col("most") >= ratio * F.col("n")
    return joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(chosen, F.col("best.word")).alias("form"), F.when(chosen, F.col("most")).alias("form_n"))


def roots(formed: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form: each round doubles the number of forms followed."""
    at = saved(formed.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        step = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        after = saved(at.join(step, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if after.where("moved").isEmpty():
            return after.select("word", "root")
        at = after.select("word", "root")


def variants(docs: DataFrame) -> DataFrame:
    """Per word of docs (doc_id, text): word, form, root, n, n_near, form_n."""
    vocabulary = saved(words(docs), "vocabulary")
    formed = saved(forms(vocabulary), "forms")
    out = formed.join(roots(formed), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
