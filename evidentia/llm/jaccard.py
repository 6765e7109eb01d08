"""N-gram Jaccard join: documents whose sets of word shingles overlap to a threshold, as components of their links.

Equal sets are one node. A node lies in tiles of its size band (sizes of one bit length; also the next band below, if
partners may lie there) and of one of `BANDS` keys, each of `ROWS` least values of the set under own multipliers: bands
alone would compare each set with all of like size, a work that grows with the square of the corpus. Two sets of
similarity s share no tile with probability (1 - s^4)^32, which is 6 * 10^-11 at 0.85 and less beyond.

In a tile hashed bitmaps bound the overlap from above: each bit in which two differ stands for a shingle of one set only,
so that |A and B| <= (|A| + |B| - differing bits) / 2. Three passes follow, of which only the last takes sets to tiles:
1. Bitmaps alone give, for each tile, pairs that span what the bound leaves; nodes of least number lead, so that tiles
   name the same pairs. These pairs are checked exactly, by sorted-array intersection, and give components.
2. Bitmaps alone name the members of a tile that the bound joins with one of another component.
3. These, and no others, are compared exactly within their tiles.
A tile of more than `TILE` members is cut into parts, and each pair of parts is a comparison of its own. Tiles of equal
members are compared once. Pairs span components, so their number follows the members', never the square of a group's.

Null and empty texts have no set and are linked with nothing; a text of fewer words than a shingle is one shingle. Equal
rows share a component. A null id counts for no component_id; a component of null ids only has a null one. Long texts are
read whole. Other columns than doc_id and text are not read. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_hash, saved, small_batches, small_or_shuffled, text_batches
from .components import connected_components
from .near_copies import shingle_sets
from .simhash import SEED

BANDS, ROWS = 32, 4
LEAST_BITS, MOST_BITS = 256, 1 << 14  # a bitmap has four to eight bits for each shingle, within these bounds
TILE, TILE_SHINGLES = 4096, 4 << 20  # members of a part of a tile, and shingles of a part in the last pass


def bitmap(shingles):
    """The bytes of a set's bitmap: a power of two of bits, of which the low bits of a shingle choose one."""
    import numpy as np

    m = min(max(LEAST_BITS, 1 << (4 * len(shingles)).bit_length()), MOST_BITS)
    bits = np.zeros(m, np.uint8)
    bits[(shingles & np.uint64(m - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def tiles_of(shingles, percent: int):
    """The tiles of a set, as 64-bit integers."""
    import numpy as np

    from .tokens import mixed

    factors = mixed(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)) | np.uint64(1)
    least = np.full(BANDS * ROWS, ~np.uint64(0))
    for i in range(0, len(shingles), 4096):
        np.minimum(least, (shingles[i : i + 4096, None] * factors).min(axis=0), out=least)
    weights = mixed(np.arange(1, ROWS + 1, dtype=np.uint64) << np.uint64(40)) | np.uint64(1)
    keys = mixed((mixed(least).reshape(BANDS, ROWS) * weights).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))
    n = len(shingles)
    sizes = sorted({n.bit_length(), ((percent * n + 99) // 100).bit_length()})
    return np.concatenate([mixed(keys + np.uint64(b << 8)) for b in sizes]).view(np.int64)


def nodes_of(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(doc_id, row, node, n, bits, tiles) of docs (doc_id, row, text): one row each; a node is null if there is no set."""

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from xxhash import xxh64_intdigest

        for batch in text_batches(batches, "text", limit=1 << 20):
            node, n, bits, tiles = [], [], [], []
            for s in shingle_sets(batch.column(2), shingle):
                node.append(int(np.uint64(xxh64_intdigest(s.tobytes(), SEED)).view(np.int64)) if len(s) else None)
                n.append(len(s))
                bits.append(bitmap(s) if len(s) else None)
                tiles.append(tiles_of(s, percent) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(node, pa.int64()), pa.array(n, pa.int64()), pa.array(bits, pa.binary()), pa.array(tiles, pa.list_(pa.int64()))],
                names=["doc_id", "row", "node", "n", "bits", "tiles"],
            )

    return small_batches(docs).select("doc_id", "row", "text").mapInArrow(run, "doc_id long, row long, node long, n long, bits binary, tiles array<long>")


def sets_of(texts: DataFrame, shingle: int) -> DataFrame:
    """(node, shingles) of texts (node, text): the ascending 64-bit hashes as bytes."""

    def run(batches):
        import pyarrow as pa

        for batch in text_batches(batches, "text", limit=1 << 20):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.tobytes() for s in shingle_sets(batch.column(1), shingle)], pa.binary())], names=["node", "shingles"])

    return small_batches(texts).select("node", "text").mapInArrow(run, "node long, shingles binary").dropDuplicates(["node"])


def linked(a, b, percent: int) -> bool:
    """Whether two ascending arrays overlap to the threshold."""
    import numpy as np

    if len(b) < len(a):
        a, b = b, a
    if 100 * len(a) < percent * len(b):
        return False
    at = np.searchsorted(b, a)
    shared = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def matrix(bitmaps):
    """Bitmaps as rows of 64-bit words, all folded to the shortest one's length."""
    import numpy as np

    m = min(len(x) for x in bitmaps)
    out = np.empty((len(bitmaps), m // 8), np.uint64)
    for k, x in enumerate(bitmaps):
        out[k] = np.bitwise_or.reduce(np.frombuffer(x, np.uint64).reshape(-1, m // 8), axis=0)
    return out


def room(n, bits, one, many, percent: int):
    """For the pairs of places one x many: by how much the bound on the overlap exceeds what the threshold asks (below 0: no link)."""
    import numpy as np

    apart = np.zeros((len(one), len(many)), np.int64)
    for w in range(bits.shape[1]):
        apart += np.bitwise_count(bits[one, w][:, None] ^ bits[many, w][None, :])
    whole = n[one][:, None] + n[many][None, :]
    # A link asks (100 + percent) * overlap >= percent * whole, and twice the overlap is at most whole - apart, and at most twice a size.
    least = 2 * np.minimum(n[one][:, None], n[many][None, :])
    return (100 + percent) * np.minimum(whole - apart, least) - 2 * percent * whole


def spanning(n, bits, percent: int, sets=None, block: int = 32):
    """Places (a, b) of pairs that span the components of the pairs that the bound leaves or, given the sets, of the links."""
    import numpy as np

    left, pairs = np.arange(len(n)), []
    while len(left) > 1:
        wave, left = left[:1], left[1:]
        while len(wave) and len(left):
            now, wave = wave[:block], wave[block:]
            reached = np.zeros(len(left), bool)
            for i in range(0, len(left), 4096):
                part = left[i : i + 4096]
                r = room(n, bits, now, part, percent)
                for j in np.flatnonzero((r >= 0).any(axis=0)):
                    for k in np.argsort(-r[:, j], kind="stable"):
                        if r[k, j] < 0:
                            break
                        if sets is None or linked(sets[now[k]], sets[part[j]], percent):
                            pairs.append((now[k], part[j]))
                            reached[i + j] = True
                            break
            wave, left = np.concatenate([wave, left[reached]]), left[~reached]
    return pairs


def crossing(n, bits, label, percent: int, block: int = 64):
    """Places that the bound joins with one of another label."""
    import numpy as np

    out = np.zeros(len(n), bool)
    if (label == label[0]).all():
        return out
    every = np.arange(len(n))
    for i in range(0, len(n), block):
        for k in range(i, len(n), 4096):
            one, many = every[i : i + block], every[k : k + 4096]
            hit = (room(n, bits, one, many, percent) >= 0) & (label[one][:, None] != label[many])
            out[one] |= hit.any(axis=1)
            out[many] |= hit.any(axis=0)
    return out


def tile_groups(batches, n_keys: int = 3):
    """Columns, as lists or arrays, of each run of equal leading columns in sorted record batches."""
    import numpy as np
    import pyarrow as pa

    def columns(batch):
        return [c.to_pylist() if pa.types.is_binary(c.type) else c.to_numpy() for c in batch.columns]

    def starts(batch):
        change = np.zeros(batch.num_rows, bool)
        for c in batch.columns[:n_keys]:
            change[1:] |= np.diff(c.to_numpy()) != 0
        return np.flatnonzero(change)

    waiting = []
    for batch in batches:
        if not batch.num_rows:
            continue
        if waiting and any(waiting[0].column(k)[0] != batch.column(k)[0] for k in range(n_keys)):
            yield columns(pa.Table.from_batches(waiting).combine_chunks().to_batches()[0])
            waiting = []
        at = 0
        for stop in [*starts(batch), batch.num_rows]:
            if stop < batch.num_rows:
                whole = [*waiting, batch.slice(at, stop - at)]
                yield columns(whole[0] if len(whole) == 1 else pa.Table.from_batches(whole).combine_chunks().to_batches()[0])
                waiting, at = [], stop
        waiting.append(batch.slice(at))
    if waiting:
        yield columns(pa.Table.from_batches(waiting).combine_chunks().to_batches()[0])


def by_tile(members: DataFrame, compare, names: list[str], weight: str, most: int) -> DataFrame:
    """What compare finds in each tile of members (tile, node, n, bits, ...), cut into parts of at most about `most` of weight."""
    large = members.groupBy("tile").agg(F.ceil(F.sum(F.expr(weight)) / most).cast("int").alias("parts")).where("parts > 1")
    columns = [c for c in members.columns if c != "tile"]
    cut = members.join(small_or_shuffled(saved(large, "large-tiles")), "tile", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    cut = cut.withColumn("part", F.pmod(F.xxhash64("node"), "parts").cast("int"))
    pairs = F.when(F.col("parts") == 1, F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda k: F.struct(F.least(F.col("part"), k).alias("i"), F.greatest(F.col("part"), k).alias("j")))
    )
    dealt = cut.select("tile", F.explode(pairs).alias("pair"), *columns).select("tile", "pair.i", "pair.j", *columns)
    dealt = dealt.repartition("tile", "i", "j").sortWithinPartitions("tile", "i", "j", "node")

    def run(batches):
        import pyarrow as pa

        rows = []
        for group in tile_groups(batches):
            if len(group[0]) > 1:
                rows += compare(*group)
            if len(rows) >= 1 << 15:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)

    return small_batches(dealt).mapInArrow(run, ", ".join(f"{x} long" for x in names))


def checked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets overlap to the threshold."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            keep = [linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a").join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
    return small_batches(both).select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def links(docs: DataFrame, distinct: DataFrame, *, shingle: int, percent: int, tile: int = TILE) -> DataFrame:
    """Links (a, b) of nodes that span all components; distinct (row, node, n, bits, tiles) has each node once."""
    members = distinct.select(F.explode("tiles").alias("tile"), "node")
    alike = members.groupBy("tile").agg(F.count("*").alias("k"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("s"), F.min("node").alias("low"), F.max("node").alias("high"))
    kept = alike.where("k > 1").groupBy("k", "s", "low", "high").agg(F.min("tile").alias("tile")).select("tile")
    members = saved(members.join(kept, "tile", "left_semi"), "members")
    marked = members.join(distinct.select("node", "n", "bits"), "node").select("tile", "node", "n", "bits")

    def bounded(tiles, i, j, node, n, bits):
        return [(node[a], node[b]) for a, b in spanning(n, matrix(bits), percent)]

    def unsettled(tiles, i, j, node, n, bits, label):
        return [(tiles[0], x) for x in node[crossing(n, matrix(bits), label, percent)]]

    def exact(tiles, i, j, node, n, bits, shingles):
        import numpy as np

        return [(node[a], node[b]) for a, b in spanning(n, matrix(bits), percent, [np.frombuffer(x, np.uint64) for x in shingles])]

    pairs = saved(by_tile(marked, bounded, ["a", "b"], "1", tile).distinct(), "pairs")
    wanted = saved(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "wanted")
    texts = docs.join(small_or_shuffled(saved(distinct.join(wanted, "node", "left_semi").select("row", "node"), "wanted-rows")), "row")
    sets = saved(sets_of(texts, shingle), "sets")
    found = saved(checked(pairs, sets, percent), "links")
    labels = saved(connected_components(found), "components")
    labelled = marked.join(labels, "node", "left").select("tile", "node", "n", "bits", F.coalesce("label", "node").alias("label"))
    rest = saved(by_tile(labelled, unsettled, ["tile", "node"], "1", tile).distinct(), "unsettled")
    again = rest.join(distinct.select("node", "n", "bits"), "node").join(sets, "node").select("tile", "node", "n", "bits", "shingles")
    return found.unionByName(by_tile(again, exact, ["a", "b"], "n", TILE_SHINGLES).distinct())


def join(docs: DataFrame, *, shingle: int = 4, percent: int = 85, tile: int = TILE) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_shingles, component_id, by links of 100 * overlap >= percent * union."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("row", row_hash("doc_id", "text"))
    nodes = saved(nodes_of(rows, shingle, percent), "nodes")
    distinct = saved(nodes.where("node is not null").select("row", "node", "n", "bits", "tiles").dropDuplicates(["node"]), "distinct-nodes")
    labels = saved(connected_components(saved(links(rows, distinct, shingle=shingle, percent=percent, tile=tile), "all-links")), "components")
    least = nodes.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("first"), F.count("*").alias("k"))
    least = saved(least.join(labels, "node", "left").select("node", "first", "k", F.coalesce("label", "node").alias("label")), "least")
    merged = least.groupBy("label").agg(F.min("first").alias("component_id"), F.sum("k").alias("k")).where("k > 1")
    shared = saved(least.join(merged.select("label", "component_id"), "label").select("node", "component_id", F.lit(True).alias("many")), "shared")
    out = nodes.select("doc_id", "node", "n").join(small_or_shuffled(shared), "node", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("many"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
