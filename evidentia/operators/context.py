"""Passages for a judge within a budget, quotable islands of blocks, and anchors where sections begin and go on."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.arrow import list_rows, packed

#: How a provision on commencement or on where a law applies is worded.
COMMENCEMENT = r"(?i)Inkrafttreten|In-Kraft-Treten|tritt.*Kraft|Geltungsbereich"


def interleaved(ranked: DataFrame, *, reach: int = 2) -> DataFrame:
    """(law_id, ordinal, round, criterion_id): when each passage is offered first, if rankings take turns.

    ranked (law_id, criterion_id, position, ordinal): in round p every criterion, by id, offers its passage at position p
    with the `reach` passages on either side. What an offer can't hold, a later one can't either, as space only shrinks;
    so a passage's first offer decides, and it is a minimum over all offers.
    """
    near = F.explode(F.sequence(F.col("ordinal") - reach, F.col("ordinal") + reach))
    offers = ranked.select("law_id", F.col("position").alias("round"), "criterion_id", near.alias("ordinal"))
    first = offers.groupBy("law_id", "ordinal").agg(F.min(F.struct("round", "criterion_id")).alias("first"))
    return first.select("law_id", "ordinal", "first.round", "first.criterion_id")


def shown(batches, budget: int, slack: int):
    """(law_id, ordinal, offered, partial) of what is shown of each law in Arrow batches (law_id, entries), see `legal_context`."""
    for law, (rounds, ordinals, sizes, clauses) in list_rows(batches, "law_id", entries=("round", "ordinal", "size", "clause")):
        used, last, taken = 0, None, {}
        for round_, ordinal, size in zip(rounds, ordinals, sizes):
            if round_ is None:
                continue
            if last not in (None, round_) and used >= budget - slack:
                break
            last = round_
            if used + size <= budget:
                taken[ordinal] = True
                used += size
        for ordinal, size in sorted((o, s) for o, s, clause in zip(ordinals, sizes, clauses) if clause and o not in taken):
            if used + size <= budget:
                taken[ordinal] = False
                used += size
        for ordinal in sorted(taken):
            yield law, ordinal, taken[ordinal], len(taken) < len(ordinals)


def legal_context(passages: DataFrame, ranked: DataFrame, *, clause: str = COMMENCEMENT, budget: int = 24_000, slack: int = 500, reach: int = 2) -> DataFrame:
    """(law_id, ordinal, offered, partial): the passages of each law that a judge sees within a budget of characters.

    passages (law_id, ordinal, text); ranked as for `interleaved`. Passages are taken in the order of their offers if they
    fit; no further round begins once less than `slack` is left. Then passages with a commencement clause are taken in
    order if they fit (offered is false). partial: the law has passages that aren't shown. A null text takes no space. Only
    lengths travel; a law's choice is a fold over its passages, one row a law. Laws without passages have no rows.
    """
    size = passages.select("law_id", "ordinal", F.coalesce(F.length("text"), F.lit(0)).alias("size"), F.coalesce(F.col("text").rlike(clause), F.lit(False)).alias("clause"))
    both = size.join(interleaved(ranked, reach=reach), ["law_id", "ordinal"], "left")
    entries = F.array_sort(F.collect_list(F.struct("round", "criterion_id", "ordinal", "size", "clause")))
    lists = both.groupBy("law_id").agg(entries.alias("entries"))
    key = dict(passages.dtypes)["law_id"]

    kind = to_arrow_type(passages.schema["law_id"].dataType)

    def choose(batches):
        import pyarrow as pa

        return packed(shown(batches, budget, slack), ["law_id", "ordinal", "offered", "partial"], [kind, pa.int64(), pa.bool_(), pa.bool_()])

    return lists.mapInArrow(choose, f"law_id {key}, ordinal long, offered boolean, partial boolean")


def islands(blocks: DataFrame, *, limit: int = 4500) -> DataFrame:
    """blocks with `island`, from 0 in each (doc_id, group): what one quotation may span.

    blocks (doc_id, group, pos, page, line_start, line_end, from_char, to_char). An island ends where the page changes,
    where a block begins on a line that the one before covers (pieces of one long block are never joined again), and where
    the text from its first block's from_char through to_char would be longer than `limit`. The first two are found by
    their neighbours; only the last is a fold, over the blocks of one page.
    """
    order = Window.partitionBy("doc_id", "group").orderBy("pos")
    new = (F.col("page") != F.lag("page").over(order)) | (F.col("line_start") <= F.lag("line_end").over(order))
    run = blocks.withColumn("run", F.sum(F.coalesce(new, F.lit(False)).cast("int")).over(order))
    entry = F.struct("pos", "from_char", "to_char")
    runs = run.groupBy("doc_id", "group", "run").agg(F.array_sort(F.collect_list(entry)).alias("e"))

    def step(acc, x):
        full = x["to_char"] - acc["start"] > limit
        at = acc["at"] + full.cast("int")
        return F.struct(F.when(full, x["from_char"]).otherwise(acc["start"]).alias("start"), at.alias("at"), F.concat(acc["of"], F.array(F.struct(x["pos"].alias("pos"), at.alias("part")))).alias("of"))

    kinds = dict(blocks.dtypes)
    start = F.struct(F.col("e")[0]["from_char"].alias("start"), F.lit(0).alias("at"), F.array().cast(f"array<struct<pos:{kinds['pos']},part:int>>").alias("of"))
    parts = runs.select("doc_id", "group", "run", F.inline(F.aggregate("e", start, step, lambda acc: acc["of"])))
    rank = F.dense_rank().over(Window.partitionBy("doc_id", "group").orderBy("run", "part")) - 1
    return blocks.join(parts.withColumn("island", rank).drop("run", "part"), ["doc_id", "group", "pos"])


def page_anchors(leaves: DataFrame) -> DataFrame:
    """(doc_id, page, anchor, pos) of leaves (doc_id, pos, page, leaf_id, path array): where old bookmarks point.

    A leaf's path names its sections from the root. Each leaf is an anchor; so is every section of its path beyond what it
    shares with the leaf before, the first time by its id, later by a continuation number; and the root, at the first
    leaf. A path of the root alone is a section itself. Null paths count as empty: an open section is then left.
    """
    order = Window.partitionBy("doc_id").orderBy("pos")
    path = F.coalesce("path", F.array().cast(dict(leaves.dtypes)["path"]))
    below = F.when(F.size(path) > 1, F.slice(path, 2, F.greatest(F.size(path) - 1, F.lit(1)))).otherwise(path)
    with_path = leaves.withColumn("own", below).withColumn("before", F.coalesce(F.lag("own").over(order), F.array().cast(dict(leaves.dtypes)["path"])))
    differ = F.zip_with("own", "before", lambda a, b: ~F.coalesce(a == b, F.lit(False)))
    shared = F.coalesce(F.nullif(F.array_position(differ, True), F.lit(0)) - 1, F.size("own"))  # places before the first difference
    entered = with_path.withColumn("shared", shared.cast("int")).select("doc_id", "pos", "page", F.posexplode("own").alias("depth", "section"), "shared").where("depth >= shared")
    nth = F.row_number().over(Window.partitionBy("doc_id", "section").orderBy("pos", "depth"))
    named = F.when(nth == 1, F.col("section")).otherwise(F.concat("section", F.lit("-continuation-"), nth))
    sections = entered.select("doc_id", "page", named.alias("anchor"), "pos")
    first = leaves.where(F.size(path) > 1).groupBy("doc_id").agg(F.min(F.struct("pos", "page", F.element_at("path", 1).alias("root"))).alias("f"))
    roots = first.select("doc_id", "f.page", F.col("f.root").alias("anchor"), "f.pos")
    return leaves.select("doc_id", "page", F.col("leaf_id").alias("anchor"), "pos").unionByName(sections).unionByName(roots)


def recovered_outline(blocks: DataFrame, cached: DataFrame, *, limit: int = 4500) -> DataFrame:
    """(doc_id, start, stop, section, recovered): ranges of block places that tile each document, without any model call.

    blocks as for `islands`, without group; cached (doc_id, page, start, stop, section) holds ranges of an earlier outline.
    A page's cached ranges count if they tile exactly that page's blocks, in order; any other page, null sections
    included, gets islands of its own blocks instead, under its page number.
    """
    pages = blocks.groupBy("doc_id", "page").agg(F.min("pos").alias("low"), F.max("pos").alias("high"))
    due = F.coalesce(F.lag("stop").over(Window.partitionBy("doc_id", "page").orderBy("start", "stop")) + 1, F.col("low"))
    checked = cached.join(pages, ["doc_id", "page"]).withColumn("even", (F.col("start") == due) & (F.col("stop") >= F.col("start")) & F.col("section").isNotNull())
    sound = checked.groupBy("doc_id", "page").agg((F.bool_and(F.coalesce("even", F.lit(False))) & (F.max("stop") == F.max("high"))).alias("sound")).where("sound").select("doc_id", "page")
    kept = cached.join(sound, ["doc_id", "page"], "left_semi").select("doc_id", "start", "stop", "section", F.lit(False).alias("recovered"))
    rest = islands(blocks.withColumn("group", F.col("page")).join(sound, ["doc_id", "page"], "left_anti"), limit=limit)
    ranges = rest.groupBy("doc_id", "page", "island").agg(F.min("pos").alias("start"), F.max("pos").alias("stop"))
    return kept.unionByName(ranges.select("doc_id", "start", "stop", F.concat(F.lit("page "), F.col("page").cast("string")).alias("section"), F.lit(True).alias("recovered")))
