"""SimHash near-duplicates: fingerprints of word shingles, and tiled exact comparison of all distinct fingerprints.

Two fingerprints at 3 or fewer differing bits agree in at least one of their four 16-bit words. A tile holds the
distinct fingerprints that agree in one such word; every link lies in some tile. Inside a tile, blocks of fingerprints
sorted by population count are compared by exclusive-or and bit counts; blocks whose population counts differ by more
than the radius are skipped, as the difference of the counts never exceeds the number of differing bits. A tile of more
than `tile` fingerprints is cut into parts, and each pair of parts is a comparison of its own. A comparison yields links
that span its components, not all pairs; components of all links are found in Spark.

Null and empty texts have fingerprint zero and are linked like any other. Equal rows and equal texts share a component.
A null id counts for no component_id; a component of null ids only has a null component_id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, small_batches, small_or_shuffled, text_batches
from .components import connected_components

BITS, WORD_BITS, SEED = 64, 16, 42


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Bit k is 1 if it is set in over half of the XXH64 values of the text's word shingles, repeats included."""
    import numpy as np
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    elif shingle == 3:
        grams = [b"%b %b %b" % g for g in zip(words, words[1:], words[2:])]
    else:
        grams = [b" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)]
    counts = np.zeros(BITS, np.int64)
    for i in range(0, len(grams), 1 << 15):
        values = np.array([xxh64_intdigest(g, SEED) for g in grams[i : i + (1 << 15)]], "<u8")
        counts += np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(grams), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of every row; fp is the fingerprint as a signed 64-bit integer."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in text_batches(batches, "text"):
            values = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], names=["doc_id", "fp"])

    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def spanning_links(values, radius: int, block: int = 256):
    """Links (value, first value found of its component) that span the components of `values` (uint64) within the radius."""
    import numpy as np

    values = np.unique(values)
    order = np.argsort(np.bitwise_count(values), kind="stable")
    values = values[order]
    weights = np.bitwise_count(values).astype(np.int16)
    left = np.arange(len(values))  # not yet reached, by population count
    links: list[tuple] = []
    while len(left) > 1:
        root, wave, left = left[0], left[:1], left[1:]
        while len(wave) and len(left):
            now, wave = wave[:block], wave[block:]
            low, high = weights[now].min() - radius, weights[now].max() + radius
            start, stop = np.searchsorted(weights[left], (low, high + 1))
            if start == stop:
                continue
            reached = []
            for i in range(start, stop, 8192):
                part = left[i : min(i + 8192, stop)]
                hit = (np.bitwise_count(values[now][:, None] ^ values[part][None, :]) <= radius).any(axis=0)
                if hit.any():
                    reached.append(i + np.flatnonzero(hit))
            if reached:
                at = np.concatenate(reached)
                links.append((values[left[at]], np.full(len(at), values[root])))
                wave = np.concatenate([wave, left[at]])
                wave = wave[np.argsort(weights[wave], kind="stable")]
                left = np.delete(left, at)
    if not links:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return tuple(np.concatenate(side) for side in zip(*links))


def near_links(prints: DataFrame, *, radius: int = 3, tile: int = 16_384) -> DataFrame:
    """Links (a, b) between distinct fingerprints that span all components within the radius (at most 3)."""
    if not 0 <= radius < BITS // WORD_BITS:
        raise ValueError("radius must be 0 to 3")
    distinct = saved(prints.select("fp").distinct(), "fingerprints")
    word = lambda k: F.shiftrightunsigned("fp", WORD_BITS * k).bitwiseAND((1 << WORD_BITS) - 1) + (k << WORD_BITS)
    members = distinct.select("fp", F.explode(F.array(*[word(k) for k in range(BITS // WORD_BITS)])).alias("tile"))
    # At most 4 * 65,536 tiles, whatever the input, so their sizes may be broadcast.
    sizes = saved(members.groupBy("tile").agg(F.count("*").alias("n")).where("n > 1"), "tiles")
    parts = F.ceil(F.col("n") / tile).cast("int")
    members = members.join(F.broadcast(sizes), "tile").withColumn("part", F.pmod(F.xxhash64("fp"), parts).cast("int")).withColumn("parts", parts)
    pairs = F.when(F.col("parts") == 1, F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda k: F.struct(F.least(F.col("part"), k).alias("i"), F.greatest(F.col("part"), k).alias("j")))
    )
    tasks = members.select("tile", F.explode(pairs).alias("p"), "fp").select("tile", "p.i", "p.j", "fp")
    tasks = tasks.repartition("tile", "i", "j").sortWithinPartitions("tile", "i", "j")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def compared(groups):
            found = [spanning_links(np.array(g, np.int64).view(np.uint64), radius) for g in groups if len(g) > 1]
            a, b = (np.concatenate([x[k] for x in found] or [np.empty(0, np.uint64)]).view(np.int64) for k in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        key, waiting = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            t, i, j, fp = (c.to_numpy() for c in batch.columns)
            starts = np.flatnonzero(np.r_[True, (t[1:] != t[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])])
            done = []
            for start, stop in zip(starts, [*starts[1:], len(t)]):
                if (now := (t[start], i[start], j[start])) != key:
                    if waiting:
                        done.append(np.concatenate(waiting))
                    key, waiting = now, []
                waiting.append(fp[start:stop])
            yield compared(done)
        if waiting:
            yield compared([np.concatenate(waiting)])

    return tasks.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, *, radius: int = 3, tile: int = 16_384) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id that links reach."""
    prints = saved(fingerprints(docs), "prints")
    labels = saved(connected_components(saved(near_links(prints, radius=radius, tile=tile), "links")), "components")
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("first")).join(labels.withColumnRenamed("node", "fp"), "fp", "left")
    least = saved(least.select("fp", "first", F.coalesce("label", "fp").alias("label")), "least")
    merged = least.join(labels.select("label").distinct(), "label", "left_semi").groupBy("label").agg(F.min("first").alias("component_id"))
    changed = saved(least.join(merged, "label").where("first is null or component_id < first").select("fp", "component_id"), "merged")
    by_print = least.select("fp", "first").join(small_or_shuffled(changed), "fp", "left").select("fp", F.coalesce("component_id", "first").alias("component_id"))
    out = prints.join(by_print, "fp", "left")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
