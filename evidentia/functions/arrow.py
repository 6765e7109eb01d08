"""Rows with lists in Arrow batches, read one row at a time; imported by workers, so without pandas."""

from __future__ import annotations

#: Rows that are kept as Python objects before they are given back as a batch.
OUT_ROWS = 10_000


def list_rows(batches, key: str, **lists: tuple[str, ...]):
    """Each row of Arrow batches: its key, and for each column of lists of structs a list for each of the fields named.

    Only one row's entries are Python objects at a time; the others stay in the batch. A null list is empty.
    """
    for batch in batches:
        keys, columns = batch.column(key), []
        for name, fields in lists.items():
            column = batch.column(name)
            columns.append((column.value_lengths().fill_null(0).to_pylist(), column.offsets.to_pylist(), [column.values.field(f) for f in fields]))
        for i in range(batch.num_rows):
            yield keys[i].as_py(), *[[f.slice(starts[i], sizes[i]).to_pylist() for f in fields] for sizes, starts, fields in columns]


def packed(rows, names: list[str], types: list):
    """Record batches of some OUT_ROWS of the given tuples."""
    import pyarrow as pa

    kept = []
    flush = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*kept), types)], names)
    for row in rows:
        kept.append(row)
        if len(kept) >= OUT_ROWS:
            yield flush()
            kept = []
    if kept:
        yield flush()
