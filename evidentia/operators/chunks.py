"""Greedy, ordered packing: sequential within a document, parallel over documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def greedy_chunks(leaves: DataFrame, *, max_chars: int = 12_000, max_leaves: int = 64) -> DataFrame:
    """(doc_id, chunk, first, last, chars): leaves (doc_id, pos, chars) in order, a new chunk when the next would not fit."""
    lists = leaves.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("pos", "chars"))).alias("leaves"))

    def pack(batches):
        import pandas as pd

        for frame in batches:
            out = []
            for doc, parts in zip(frame["doc_id"], frame["leaves"]):
                chunk, used, n, first = 0, 0, 0, None
                for p in parts:
                    if n and (used + p["chars"] > max_chars or n >= max_leaves):
                        out.append((doc, chunk, first, last, used))  # noqa: F821
                        chunk, used, n, first = chunk + 1, 0, 0, None
                    first = p["pos"] if first is None else first
                    used, n, last = used + p["chars"], n + 1, p["pos"]
                if n:
                    out.append((doc, chunk, first, last, used))
            yield pd.DataFrame(out, columns=["doc_id", "chunk", "first", "last", "chars"])

    return lists.mapInPandas(pack, "doc_id long, chunk int, first long, last long, chars long")


def split_block(text: str, limit: int = 4500, least: int = 1000) -> list[str]:
    """A block in parts of at most `limit` characters, cut at the last space after `least`, else at the limit."""
    parts = []
    text = text.strip()
    while len(text) > limit:
        cut = text.rfind(" ", least, limit)
        cut = limit if cut < 0 else cut
        parts.append(text[:cut])
        text = text[cut:].strip()
    return [*parts, text] if text else parts


def page_leaves(pages: DataFrame, prefix: str) -> DataFrame:
    """(doc_id, page, ordinal, leaf_id, text, line_start, line_end) of pages (doc_id, page, text).

    Blocks are set apart by blank lines and cut at 4,500 characters; lines count from 1 within the page; a leaf's id
    rests on its page, its text and how often that text came before on the page.
    """
    from ..functions.python_text import stable_id

    def run(batches):
        import pandas as pd

        for frame in batches:
            out = []
            for doc, page, text in zip(frame["doc_id"], frame["page"], frame["text"]):
                lines, seen, ordinal, at = (text or "").strip().splitlines(), {}, 0, 0
                while at < len(lines):
                    start = at
                    while at < len(lines) and lines[at].strip():
                        at += 1
                    for part in split_block("\n".join(lines[start:at])):
                        key = " ".join(part.split()).casefold()
                        seen[key] = seen.get(key, 0) + 1
                        out.append((doc, page, ordinal, stable_id(f"{prefix}-p", f"{page}:{seen[key]}:{part}"), part, start + 1, at))
                        ordinal += 1
                    at += 1
            yield pd.DataFrame(out, columns=["doc_id", "page", "ordinal", "leaf_id", "text", "line_start", "line_end"])

    return pages.select("doc_id", "page", "text").mapInPandas(run, "doc_id long, page int, ordinal int, leaf_id string, text string, line_start int, line_end int")
