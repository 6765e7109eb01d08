"""A cascade of judges: screening, judgment with a challenger, and a final decision on what the stages before supported."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from ..streaming.bisect import bisected
from ..streaming.state import Judge

SCREENED = "key string, disposition string, supported boolean"
JUDGED = "key string, outcome string, score int, law_quote string, criterion_quote string"
SCREEN, PAIRS, FINAL = 16, 6, 12  # tasks of a call


def checked(judge: Judge, sound) -> Judge:
    """A judge whose answers fail as a batch, and are asked for again in halves, unless `sound` (a mask) holds for all."""

    def run(frame):
        answers = judge(frame)
        if not sound(answers).all():
            raise ValueError("an answer's fields don't go together")
        return answers

    return run


def screening_sound(answers):
    return _mask((d == "candidate") == bool(s) for d, s in zip(answers["disposition"].array, answers["supported"].array))


def judgment_sound(answers):
    """A link has a score and two quotes of ten characters, and nothing else has any of them."""

    def sound(outcome, score, *quotes):
        given = [x is not None and x == x and x is not NA for x in (score, *quotes)]
        return all(given) and min(map(len, quotes)) >= 10 if outcome == "linked" else not any(given)

    from pandas import NA

    return _mask(sound(*x) for x in zip(*(answers[c].astype(object).array for c in ("outcome", "score", "law_quote", "criterion_quote"))))


def _mask(values):
    """An array of truth values; calls are small and many, so they are checked without pandas' expressions."""
    import numpy as np

    return np.array([*values], bool)


def _frame(columns: dict):
    """A frame of plain objects, without a look for narrower types, which costs more than a small call itself."""
    import numpy as np
    import pandas as pd

    n = len(next(iter(columns.values())))
    cells = np.empty((n, len(columns)), object)
    for i, values in enumerate(columns.values()):
        cells[:, i] = values
    return pd.DataFrame(cells, columns=[*columns], dtype=object, copy=False)


def cascade(pairs: DataFrame, *, screen: Judge, judge: Judge, challenger: Judge, final: Judge, version: str = "1", seen: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Per pair: key, law_id, what each stage said, and the ids of the calls that it was in.

    pairs (key text, law_id, ...) with distinct keys; the further columns, and those that `seen` adds to batches
    (`bisect.bisected`), are what judges see. All stages shuffle and write pairs, so what can be added is best added there. Screening sees every pair,
    the judge what screening supported, the challenger what the judge linked, and the final judge what the judge linked
    too, with `disputed`: whether the challenger saw no link there or a score of another sign. All stages ask in batches of
    one law that are halved when they fail. A pair that a stage leaves unanswered goes no further: status says where.
    status: screened_out, not_linked, accepted, rejected, or unanswered in a stage. Empty tables give no rows.
    """
    pairs = stored(pairs, "pairs")
    shown = [c for c in pairs.columns]

    def ask(stage, tasks, asked, sound, schema, size):
        return bisected(tasks, checked(asked, sound), schema, size=size, by=("law_id",), name=(stage, version), seen=seen)

    first = ask("screening", pairs, screen, screening_sound, SCREENED, SCREEN)
    second = pairs.join(first.answers.where("supported").select("key"), "key", "left_semi").select(*shown)
    second = stored(second, "second")
    judgment = ask("judgment", second, judge, judgment_sound, JUDGED, PAIRS)
    third = stored(second.join(judgment.answers.where("outcome = 'linked'").select("key", "score"), "key").select(*shown, "score"), "third")
    challenge = ask("challenge", third.drop("score"), challenger, judgment_sound, JUDGED, PAIRS)
    view = challenge.answers.select("key", F.col("outcome").alias("other"), F.col("score").alias("other_score"))
    disputed = ~F.coalesce((F.col("other") == "linked") & (F.signum("score") == F.signum("other_score")), F.lit(False))
    last = stored(third.join(view, "key", "left").select(*shown, disputed.alias("disputed")), "last")
    settled = ask("final", last, final, judgment_sound, JUDGED, FINAL)

    out = pairs.select("key", "law_id").join(first.answers.select("key", "supported"), "key", "left")
    out = out.join(judgment.answers.select("key", F.col("outcome").alias("judged")), "key", "left").join(last.select("key", "disputed"), "key", "left")
    out = out.join(settled.answers.select("key", F.col("outcome").alias("decided"), "score"), "key", "left")
    for stage, asked in (("screening", first), ("judgment", judgment), ("challenge", challenge), ("final", settled)):
        out = out.join(asked.members.withColumnRenamed("call_id", f"{stage}_id"), "key", "left")
    status = (
        F.when(F.col("supported").isNull(), "unanswered in screening").when(~F.col("supported"), "screened_out")
        .when(F.col("judged").isNull(), "unanswered in judgment").when(F.col("judged") != "linked", "not_linked")
        .when(F.col("decided").isNull(), "unanswered in final").when(F.col("decided") == "linked", "accepted").otherwise("rejected")
    )
    return out.select("key", "law_id", status.alias("status"), "disputed", "score", "screening_id", "judgment_id", "challenge_id", "final_id")


def stage_counts(rows: DataFrame) -> DataFrame:
    """(stage, tasks, calls) of a cascade's rows: how many pairs each stage saw, and in how many calls."""
    ids = F.array(*[F.struct(F.lit(s).alias("stage"), F.col(f"{s}_id").alias("id")) for s in ("screening", "judgment", "challenge", "final")])
    seen = rows.select("key", F.explode(ids).alias("s")).where("s.id is not null")
    return seen.groupBy(F.col("s.stage").alias("stage")).agg(F.count("*").alias("tasks"), F.count_distinct("s.id").alias("calls"))


def term_judge(*, links: int, of: int, weak: int = 0, least_length: int = 3) -> Judge:
    """A deterministic judge of pairs (law_terms, criterion_terms, law_text, criterion_text): linked if links/of of the criterion's terms are in the law.

    Terms shorter than least_length don't count. The score is 2, or 1 if the law has less than `weak` such terms.
    """

    def run(frame):
        out = {c: [] for c in ("key", "outcome", "score", "law_quote", "criterion_quote")}
        for key, law, criterion, a, b in zip(*(frame[c].array for c in ("key", "law_terms", "criterion_terms", "law_text", "criterion_text"))):
            asked = {t for t in criterion if len(t) >= least_length}
            shared = len(asked.intersection(law))
            linked = shared > 0 and of * shared >= links * len(asked)
            said = ("linked", 2 if shared >= weak else 1, a[:200].ljust(10), b[:200].ljust(10)) if linked else ("none", None, None, None)
            for values, x in zip(out.values(), (key, *said)):
                values.append(x)
        return _frame(out)

    return run


def screening(judge: Judge) -> Judge:
    """A judge as a screening one."""

    def run(frame):
        answers = judge(frame)
        outcomes = answers["outcome"].array
        return _frame({"key": answers["key"].array, "disposition": ["candidate" if o == "linked" else "unrelated" for o in outcomes], "supported": [o == "linked" for o in outcomes]})

    return run


def settling(judge: Judge, strict: Judge) -> Judge:
    """A final judge: `judge` where a pair isn't disputed, `strict` where it is."""

    def run(frame):
        import pandas as pd

        parts = [j(part.reset_index(drop=True)) for j, part in ((judge, frame[~frame["disputed"]]), (strict, frame[frame["disputed"]])) if len(part)]
        return pd.concat(parts, ignore_index=True)

    return run
