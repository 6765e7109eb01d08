"""Substring dedup: words inside a window of words that occurs more than once are removed.

Every window of `length` words has a Rabin-Karp hash. Two equal windows hold the same least hash among their runs of
`run` words, at the same place; so only windows whose least run occurs more than once in the corpus can repeat. Those
runs are counted first and the windows that hold one are then counted in Spark; no window that repeats is passed over,
and most others never enter a shuffle. Overlapping and adjoining repeated windows of a text merge to maximal intervals.
Texts that occur more than once repeat all their windows. Runs are told apart by text and place, and only one text of
equal ones goes on to windows, for the sake of what it shares with others, so a large group of copies adds none.
Joins with sides that grow with the corpus are shuffle joins at every size, so that a larger corpus has the same plan.

Null and empty texts, and texts shorter than a window, lose nothing. Rows of equal texts have equal results, whatever
their ids; ids may be null or repeat. Further columns are not read. Texts, runs and windows are known by 64-bit hashes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, small_batches, text_batches
from .tokens import mixed


def _least(values, width: int):
    """Where the first least value of each `width` neighbours is."""
    import numpy as np

    def lower(left, right):
        return np.where(values[right] < values[left], right, left)

    at, reach = np.arange(len(values)), 1
    while reach * 2 <= width:
        at = lower(at[:-reach], at[reach:])
        reach *= 2
    return at if reach == width else lower(at[: len(at) - (width - reach)], at[width - reach :])


def _windows(column, length: int, run: int):
    """Of a text column, for each window: hash, least run, where that run is, word position in its row, row."""
    import numpy as np

    from .tokens import Rolling, text_bytes, word_hashes, word_spans

    data, bounds = text_bytes(column)
    starts, ends, before = word_spans(data, bounds)
    words = word_hashes(data, starts, ends)
    n = len(words)
    if n < length:
        empty = np.empty(0, np.int64)
        return empty.astype(np.uint64), empty.astype(np.uint64), empty, empty, empty
    rolling = Rolling(words)
    at = np.arange(n - run + 1)
    runs = mixed(rolling.spans(at, at + run))
    found = _least(runs, length - run + 1)
    at = np.arange(n - length + 1)
    row = np.searchsorted(before, at, side="right") - 1
    inside = at + length <= before[row + 1]
    at, row, found = at[inside], row[inside], found[inside]
    return mixed(rolling.spans(at, at + length)), runs[found], found, at - before[row], row


def copied_texts(docs: DataFrame) -> DataFrame:
    """(row, first): texts that occur more than once, by hash, and the least id that has them; a written table."""
    groups = docs.select(F.xxhash64("text").alias("row"), "doc_id").groupBy("row").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"))
    return saved(groups.where("n > 1").select("row", "first"), "copies")


def repeated_runs(docs: DataFrame, length: int, run: int) -> DataFrame:
    """(row, runs): for each text the runs, least of some window, that are so at more than one place of all texts.

    Copies of a text have the places of one, so they make no run a repeated one.
    """

    def emit(batches):
        import numpy as np
        import pyarrow as pa

        for batch in text_batches(batches, "text", limit=1 << 20):
            key = batch.column(1).to_numpy()
            _, least, found, at, row = _windows(batch.column(0), length, run)
            new = np.flatnonzero(np.diff(found, prepend=-1))  # each place once
            place = mixed(key[row[new]].view(np.uint64) + mixed(at[new].astype(np.uint64)))
            yield pa.RecordBatch.from_arrays([pa.array(key[row[new]]), pa.array(least[new].view(np.int64)), pa.array(place.view(np.int64))], names=["row", "run", "place"])

    each = saved(docs.select("text", F.xxhash64("text").alias("row")).mapInArrow(emit, "row long, run long, place long"), "runs")
    ends = each.groupBy("run").agg(F.min("place").alias("low"), F.max("place").alias("high"))
    often = saved(ends.where("low <> high").select("run"), "repeated-runs")
    # A run that is often repeated meets the side of distinct runs, so only a join of one row with many.
    return each.select("row", "run").join(often.hint("merge"), "run").groupBy("row").agg(F.collect_set("run").alias("runs"))


def removal_intervals(docs: DataFrame, copies: DataFrame, *, length: int = 35, run: int = 16) -> DataFrame:
    """(row, cuts): maximal intervals array<struct<start, end>> of word positions to remove, by start, of the distinct texts."""
    runs = saved(repeated_runs(docs, length, run).join(copies.withColumn("copied", F.lit(True)).hint("merge"), "row", "left"), "runs-by-row")

    def emit(batches):
        import numpy as np
        import pyarrow as pa

        for batch in text_batches(batches, "text", limit=1 << 20):
            key, wanted = batch.column(1).to_numpy(), batch.column(2)
            value, least, _, at, row = _windows(batch.column(0), length, run)
            sets = [np.sort(np.array(x, np.int64).view(np.uint64)) for x in wanted.to_pylist()]
            cuts = np.searchsorted(row, np.arange(len(sets) + 1))
            keep = np.concatenate([np.isin(least[a:b], s) for a, b, s in zip(cuts[:-1], cuts[1:], sets)] or [np.empty(0, bool)])
            value, at, row = value[keep], at[keep], row[keep]
            yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(key[row]), pa.array(at.astype(np.int32))], names=["window", "row", "at"])

    rows = docs.select("text", F.xxhash64("text").alias("row"), "doc_id")
    texts = rows.join(runs.hint("merge"), "row").where(F.col("copied").isNull() | F.col("doc_id").eqNullSafe(F.col("first"))).select("text", "row", "runs")
    each = saved(texts.mapInArrow(emit, "window long, row long, at int"), "windows")
    # As a table of its own, the distinct side meets the others in a join whose large partitions Spark can split.
    often = saved(each.groupBy("window").agg(F.count("*").alias("n")).where("n > 1").select("window"), "repeated-windows")
    places = each.join(often.hint("merge"), "window").groupBy("row").agg(F.array_sort(F.collect_set("at")).alias("at"))

    def merge(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            offsets, at = batch.column(1).offsets.to_numpy(), batch.column(1).values.to_numpy()
            first = np.zeros(len(at), bool)
            first[offsets[:-1]] = True
            first[1:] |= at[1:] > at[:-1] + length
            starts = np.flatnonzero(first)
            lasts = np.r_[starts[1:], len(at)] - 1
            bounds = pa.array(np.searchsorted(starts, offsets).astype(np.int32))
            pairs = pa.StructArray.from_arrays([pa.array(at[starts]), pa.array(at[lasts] + np.int32(length))], names=["start", "end"])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(bounds, pairs)], names=["row", "cuts"])

    return saved(places.mapInArrow(merge, "row long, cuts array<struct<start:int,end:int>>"), "cuts")


def deduplicate(docs: DataFrame, *, length: int = 35, run: int = 16) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, and kept, the kept words joined by one space, in UTF-8."""
    copies = copied_texts(small_batches(docs))
    cuts = removal_intervals(docs, copies, length=length, run=run)
    whole = copies.select("row", F.lit(True).alias("copied"))
    cuts = saved(cuts.join(whole.hint("merge"), "row", "left_anti").withColumn("copied", F.lit(False)).unionByName(whole, allowMissingColumns=True), "cuts-and-copies")

    def apply(batches):
        import pyarrow as pa

        for batch in text_batches(batches, "text"):
            n_words, n_removed, kept = [], [], []
            for text, spans, copied in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                words = (text or "").encode().split()
                n_words.append(len(words))
                if copied and len(words) >= length:
                    words = []
                    spans = None
                for span in reversed(spans or []):
                    del words[span["start"] : span["end"]]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary())], names=["doc_id", "n_words", "n_removed", "kept"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("row")).join(cuts.hint("merge"), "row", "left")
    return texts.select("text", "doc_id", "cuts", "copied").mapInArrow(apply, "doc_id long, n_words long, n_removed long, kept binary")


def digest(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
