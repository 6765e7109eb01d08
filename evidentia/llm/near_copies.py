"""SimHash near copies: texts whose sets of word shingles have a Jaccard similarity of at least a threshold.

A node is a set of shingles, so texts with equal sets are one node. A node has a fingerprint of 256 bits: bit k is 1 if
over half of its shingles have it. At a similarity of 0.8 two fingerprints differ in 39 bits on average; they differ in
more than `radius` bits with a probability of about 10^-5, and 10^-6 for small sets, which have a wider radius.

Tiles: shingles are dealt to 16 bins by hash, and a node belongs to the tiles of its least shingle in each bin. Two
nodes of similarity s have the same least shingle in a bin with probability s, so a pair of 0.8 shares no tile with a
probability of 0.2^16. A tile is compared exactly, by exclusive-or and bit counts in numpy, and blocks whose population
counts differ by more than the radius are skipped. A tile of more than `tile` nodes is cut into parts, and each pair of
parts is a comparison of its own.

A first pass over the tiles finds which nodes have another one within the radius there. Only these go into a second one,
with their whole shingle sets (as 32-bit hashes): a tile's pairs are checked there, nearest ones first, and only pairs
that no earlier link has joined; a pair that shares several tiles is checked in the first of them. Pairs never leave a
task: it gives links that span its components. The first pass gives nodes, so no result grows with the square of a group.

Null and empty texts are one node. A text of fewer words than a shingle is one shingle. Repeated rows share a component.
Empty tables give no rows. Rows are told apart by `row` alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, small_batches, small_or_shuffled, text_batches
from .components import connected_components
from .simhash import SEED

WORDS, BIN_BITS = 4, 4  # fingerprints of 4 * 64 bits, and 2^4 tiles a node
PRINTS = [f"p{k}" for k in range(WORDS)]
SMALL, MORE = 64, 16  # bits of sets of less than SMALL shingles spread wider: MORE are added to the radius


def shingle_sets(column, size: int):
    """For each text of a column its distinct shingles as ascending 64-bit hashes; letters A-Z in lower case."""
    import numpy as np

    from .tokens import Rolling, mixed, text_bytes, word_hashes, word_spans

    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    data, bounds = text_bytes(column)
    data = lower[data]
    starts, ends, before = word_spans(data, bounds)
    rolling = Rolling(word_hashes(data, starts, ends))
    at = np.arange(max(0, len(starts) - size + 1))
    values = mixed(rolling.spans(at, at + size))
    for first, stop in zip(before[:-1], before[1:]):
        if stop - first >= size:
            yield np.unique(values[first : stop - size + 1])
        else:
            edge = np.array([first, stop])
            yield mixed(rolling.spans(edge[:1], edge[1:]) + np.uint64(stop - first)) if stop > first else values[:0]


def wide_print(shingles):
    """The fingerprint of a set as WORDS 64-bit integers."""
    import numpy as np

    from .tokens import mixed

    salts = mixed(np.arange(1, WORDS + 1, dtype=np.uint64) << np.uint64(32))
    counts = np.zeros(64 * WORDS, np.int64)
    for i in range(0, len(shingles), 255):
        bits = mixed(shingles[i : i + 255, None] ^ salts)  # 255 rows, as sums are of single bytes
        counts += np.unpackbits(bits.view(np.uint8).reshape(len(bits), -1), axis=1, bitorder="little").sum(axis=0, dtype=np.uint8)
    return np.packbits(2 * counts > len(shingles), bitorder="little").view("<u8")


def prints(rows: DataFrame, size: int) -> DataFrame:
    """(row, node, size, tiles, p0 ... p3) of rows (row, text)."""
    schema = "row long, node long, size int, tiles array<long>, " + ", ".join(f"{p} long" for p in PRINTS)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from xxhash import xxh64_intdigest

        edges = np.arange(1 << BIN_BITS, dtype=np.uint64) << np.uint64(64 - BIN_BITS)
        for batch in text_batches(batches, "text", limit=1 << 20):
            ids, sizes, tiles, found = [], [], [], []
            for s in shingle_sets(batch.column(1), size):
                first = np.searchsorted(s, edges)
                some = np.diff(first, append=len(s)) > 0
                ids.append(xxh64_intdigest(s.tobytes(), SEED))
                sizes.append(len(s))
                tiles.append(s[first[some]].view(np.int64))
                found.append(wide_print(s))
            columns = np.array(found).view(np.int64).T
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(ids, np.uint64).view(np.int64)), pa.array(sizes, pa.int32()), pa.array(tiles, pa.list_(pa.int64())), *(pa.array(np.ascontiguousarray(c)) for c in columns)],
                names=["row", "node", "size", "tiles", *PRINTS],
            )

    return small_batches(rows).select("row", "text").mapInArrow(run, schema)


def _distances(one, many):
    import numpy as np

    return np.bitwise_count(one[:, None, :] ^ many[None, :, :]).sum(axis=2, dtype=np.int16)


def _close(size, values, label, threshold: float, radius: int, block: int = 64):
    """Places (a, b, distance) of all pairs within the radius whose labels differ and whose sizes allow the threshold, by blocks of a.

    values are in the order of their population counts.
    """
    import numpy as np

    weights = np.bitwise_count(values).sum(axis=1, dtype=np.int16)
    for at in range(0, len(size), block):
        rows = slice(at, at + block)
        stop = np.searchsorted(weights, weights[rows].max() + radius + MORE + 1)
        for i in range(at, stop, 4096):
            part = slice(i, min(i + 4096, stop))
            far = _distances(values[rows], values[part])
            small, large = np.minimum(size[rows][:, None], size[part]), np.maximum(size[rows][:, None], size[part])
            a, b = np.nonzero((far <= np.where(small < SMALL, radius + MORE, radius)) & (label[rows][:, None] != label[part]) & (small >= threshold * large - 1e-9))
            yield at + a, i + b, far[a, b]


def _ordered(values):
    import numpy as np

    return np.argsort(np.bitwise_count(values).sum(axis=1, dtype=np.int16), kind="stable")


def having_near(columns: dict, threshold: float, radius: int):
    """The nodes that have another one within the radius."""
    import numpy as np

    order = _ordered(columns["print"])
    node, size, values = columns["node"][order], columns["size"][order], columns["print"][order]
    some = np.zeros(len(node), bool)
    for a, b, _ in _close(size, values, node, threshold, radius):
        some[a] = some[b] = True
    return [node[some]]


def checked_links(columns: dict, threshold: float, radius: int):
    """(a, b): pairs that reach the threshold and span the components of all pairs whose first common tile this is."""
    import numpy as np

    order = _ordered(columns["print"])
    node, size, values = (columns[k][order] for k in ("node", "size", "print"))
    sets = [columns["shingles"][k].view(np.uint32) for k in order]
    low = [x.astype(np.uint16) for x in sets]
    least, known = np.zeros((len(node), 1 << BIN_BITS), np.int64), np.zeros((len(node), 1 << BIN_BITS), bool)
    bin_of = lambda x: (x.view(np.uint64) >> np.uint64(64 - BIN_BITS)).astype(np.int64)
    for row, k in enumerate(order):
        bins = bin_of(columns["tiles"][k])
        least[row, bins], known[row, bins] = columns["tiles"][k], True
    this = bin_of(columns["tile"][:1])[0]
    label, mark, links = np.arange(len(node)), np.zeros(1 << 16, np.uint8), ([], [])
    for a, b, far in _close(size, values, label, threshold, radius):
        rows, starts = np.unique(a, return_index=True)
        for i, start, stop in zip(rows, starts, np.r_[starts[1:], len(a)]):
            others = b[start:stop][np.argsort(far[start:stop], kind="stable")]
            others = others[label[others] != label[i]]
            others = others[((least[others] == least[i]) & known[others] & known[i]).argmax(axis=1) == this]
            if not len(others):
                continue
            # Equal low bits bound the shared shingles from above; only pairs that may reach the threshold are compared.
            mark[low[i]] = 1
            lengths = np.array([len(low[j]) for j in others])
            upto = np.add.reduceat(mark[np.concatenate([low[j] for j in others])], np.r_[0, np.cumsum(lengths)[:-1]], dtype=np.int64)
            mark[low[i]] = 0
            need = threshold * (size[i] + size[others]) / (1 + threshold) - 1e-9
            for j, least_shared in zip(others[upto >= need], need[upto >= need]):
                if label[j] != label[i] and len(np.intersect1d(sets[i], sets[j], assume_unique=True)) >= least_shared:
                    links[0].append(node[i])
                    links[1].append(node[j])
                    label[label == label[j]] = label[i]
    return [np.array(x, np.int64) for x in links]


def by_tile(members: DataFrame, compare, names: list[str], threshold: float, radius: int, tile: int) -> DataFrame:
    """What `compare` finds in each tile of members (tile, node, size, p0 ... p3, and maybe tiles and shingles)."""
    large = saved(members.groupBy("tile").agg(F.count("*").alias("n")).where(F.col("n") > tile), "large-tiles")
    columns = [c for c in members.columns if c != "tile"]
    members = members.join(small_or_shuffled(large), "tile", "left").withColumn("parts", F.coalesce(F.ceil(F.col("n") / tile), F.lit(1)).cast("int"))
    members = members.withColumn("part", F.pmod(F.xxhash64("node"), "parts").cast("int"))
    pairs = F.when(F.col("parts") == 1, F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda k: F.struct(F.least(F.col("part"), k).alias("i"), F.greatest(F.col("part"), k).alias("j")))
    )
    dealt = members.select("tile", F.explode(pairs).alias("pair"), *columns).select("tile", "pair.i", "pair.j", *columns)
    dealt = dealt.repartition("tile", "i", "j").sortWithinPartitions("tile", "i", "j")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def arrays(batch):
            out = {}
            for name, column in zip(batch.schema.names, batch.columns):
                if pa.types.is_list(column.type):
                    flat, offsets = column.values.to_numpy(), column.offsets.to_numpy()
                    lists = np.empty(len(column), object)
                    for k in range(len(column)):
                        lists[k] = flat[offsets[k] : offsets[k + 1]].copy()
                    out[name] = lists
                else:
                    out[name] = column.to_numpy()
            out["print"] = np.stack([out.pop(p) for p in PRINTS], axis=1).view(np.uint64)
            return out

        def results(c):
            change = np.zeros(len(c["tile"]), bool)
            change[:1] = True
            for key in ("tile", "i", "j"):
                change[1:] |= c[key][1:] != c[key][:-1]
            starts = np.flatnonzero(change)
            stops = np.r_[starts[1:], len(change)]
            found = [compare({k: x[a:b] for k, x in c.items()}, threshold, radius) for a, b in zip(starts, stops) if b - a > 1]
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.empty(0, np.int64), *(x[k] for x in found)])) for k in range(len(names))], names=names)

        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = arrays(batch)
            if rest is not None:
                now = {k: np.concatenate([rest[k], x]) for k, x in now.items()}
            last = np.flatnonzero((now["tile"] != now["tile"][-1]) | (now["i"] != now["i"][-1]) | (now["j"] != now["j"][-1]))
            cut = int(last[-1]) + 1 if len(last) else 0  # the last comparison may go on in the next batch
            rest = {k: x[cut:].copy() for k, x in now.items()}
            if cut:
                yield results({k: x[:cut] for k, x in now.items()})
        if rest is not None:
            yield results(rest)

    return dealt.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def near_copies(docs: DataFrame, *, size: int = 5, threshold: float = 0.8, radius: int = 64, tile: int = 4096) -> DataFrame:
    """Per row of docs (row, text): row and component, equal for texts that links of at least the threshold join."""
    nodes = saved(prints(docs, size), "nodes")
    copies = saved(nodes.groupBy("node").agg(F.count("*").alias("n"), F.min("row").alias("first")).where("n > 1").select("node", "first"), "copies")
    once = nodes.join(small_or_shuffled(copies), "node", "left").where("first is null or row = first").dropDuplicates(["node"])
    once = saved(once.select("row", "node", "size", "tiles", *PRINTS), "distinct-nodes")
    members = once.select(F.explode("tiles").alias("tile"), "node", "size", *PRINTS)
    wanted = saved(by_tile(members, having_near, ["node"], threshold, radius, tile).distinct(), "wanted")
    wanted = saved(once.join(small_or_shuffled(wanted), "node").dropDuplicates(["node"]), "wanted-nodes")
    texts = docs.join(small_or_shuffled(wanted.select("row", "node")), "row").select("node", "text")

    def sets(batches):
        import numpy as np
        import pyarrow as pa

        for batch in text_batches(batches, "text", limit=1 << 20):
            found = [np.unique(s.astype(np.uint32)).view(np.int32) for s in shingle_sets(batch.column(1), size)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int32()))], names=["node", "shingles"])

    shingles = saved(texts.mapInArrow(sets, "node long, shingles array<int>").dropDuplicates(["node"]), "sets")
    again = wanted.drop("row").join(shingles, "node")
    again = again.select(F.explode("tiles").alias("tile"), "node", "size", "tiles", "shingles", *PRINTS)
    links = saved(by_tile(again, checked_links, ["a", "b"], threshold, radius, tile).distinct(), "links")
    labels = saved(connected_components(links), "components")
    return nodes.select("row", "node").join(small_or_shuffled(labels), "node", "left").select("row", F.coalesce("label", "node").alias("component"))
