"""Toxicity by noisy-channel restoration: disguised words are decoded first, then the restored text is scored.

Channel: a letter may be written as a look-alike, repeated, or set apart by spaces or marks. Each suspicious stretch is
a lattice of what its characters may stand for: a letter, the end of a word, or nothing. Viterbi decoding takes the
path with the greatest log odds of a character trigram model, counted over all documents, against letters drawn evenly,
less the channel's costs; by odds, a path of more letters is not worse for being longer. Stretches of any length are
decoded whole. Stretches without such signs are read as they stand, and a word that is cut into parts of two and more
letters is not put together.

Score: words and word beginnings (4 to 6 bytes) that labelled toxic rows hold much more often than others form a
lexicon; a logistic model weighs a row's lexicon hits. Lexicon and model are fitted on at most `max_labelled` labelled
rows, those with the least hash of their id, none of them held out. Character counts need no labels and cover all rows.

Null and empty texts have no hits and the model's base score. Rows of one id are scored apart; labels count by id, and
rows with a null label or id are not learned from. Without toxic labels every score is 0. An empty table gives no rows.
Further columns are not read; `score` keeps them beside its own, whatever their names.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, saved, small_batches, text_batches

#: What characters may stand for, beside themselves.
LOOKALIKES = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l"}
LOOKALIKES |= dict(zip("аеіорсухѕ", "aeiopcyxs"))  # Cyrillic letters
SUBSTITUTE, MARK, DROP = 1.0, 0.4, 7.0  # costs in nats: a look-alike, a mark or space as nothing, a look-alike as nothing
BREAK = {" ": 2.5}  # a space as a word's end; any other mark costs 3 there
REPEAT, TWICE = 0.4, 3.0  # a letter said again in a run of three or more, or of two
CLASSES = 28  # boundary, a to z, other letters
EDGE = 200  # a text's beginning and end, while trigrams are counted

_SIGN = "0-9@$!|+€£аеіорсухѕ"
_UNIT, _APART, _INSIDE = f"[A-Za-z{_SIGN}]", r"[ ._*\-/~:]{1,2}", r"_*.\-/~:"
#: Single letters or look-alikes set apart, or a run of letters, look-alikes and marks that shows a sign of disguise.
STRETCH = re.compile(
    rf"(?<![\w@$€£])(?:{_UNIT}(?:{_APART}{_UNIT}(?![A-Za-z{_SIGN}]))" + r"{2,}"
    rf"|[A-Za-z{_SIGN}{_INSIDE}]*(?:[{_SIGN}{_INSIDE}][A-Za-z]|[A-Za-z][{_SIGN}]|([A-Za-z])\1\1)[A-Za-z{_SIGN}{_INSIDE}]*)"
)


def _classes():
    """Class of each byte; 255 for bytes that continue a character."""
    import numpy as np

    of = np.zeros(256, np.uint8)
    for k in range(26):
        of[[ord("a") + k, ord("A") + k]] = k + 1
    of[0x80:0xC0] = 255
    of[0xC0:] = 27
    return of


def trigram_counts(docs: DataFrame) -> DataFrame:
    """(code, n): counts of class trigrams over all texts, runs of three and more cut to one; at most 28^3 rows."""

    def count(batches):
        import numpy as np
        import pyarrow as pa

        from .tokens import text_bytes

        total, of = np.zeros(CLASSES**3, np.int64), _classes()
        for batch in text_batches(batches, "text", limit=1 << 20):
            data, bounds = text_bytes(batch.column(0))
            marked = np.insert(of[data], bounds, EDGE)
            c = marked[marked != 255].astype(np.int32)
            gap = (c == 0) | (c == EDGE)
            first = np.flatnonzero(~gap | np.r_[True, ~gap[:-1]])  # one boundary between words
            edge = np.logical_or.reduceat(c == EDGE, first)
            c = np.where(edge, 0, c[first])
            same = np.r_[False, c[1:] == c[:-1], False]
            kept = ~(same[:-1] & (np.r_[False, same[:-2]] | same[1:]))  # a letter said three times and more is a disguise, not a language's
            c, edge = c[kept], edge[kept]
            code = (c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:]
            total += np.bincount(code[~edge[1:-1]], minlength=CLASSES**3)  # none reaches from one text into the next
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["code", "n"])

    return small_batches(docs).select("text").mapInArrow(count, "code int, n long").groupBy("code").agg(F.sum("n").alias("n"))


def log_model(counts: dict[int, int]):
    """log P(c | a, b) from trigram counts, smoothed towards P(c | b)."""
    import numpy as np

    n = np.zeros((CLASSES, CLASSES, CLASSES))
    for code, k in counts.items():
        n.flat[code] = k
    pair = n.sum(axis=0) + 0.5
    pair = pair / pair.sum(axis=1, keepdims=True)
    return np.log((n + 5 * pair[None]) / (n.sum(axis=2, keepdims=True) + 5))


class Restorer:
    """Decodes suspicious stretches under the character model; keeps what it has decoded, up to a bound."""

    def __init__(self, model, limit: int = 50_000):
        self.log = model.tolist()
        self.known: dict[str, str] = {}
        self.limit = limit

    def restore(self, stretch: str) -> str:
        if (found := self.known.get(stretch)) is None:
            if len(self.known) >= self.limit:
                self.known.clear()
            found = self._viterbi(stretch.lower())
            if len(stretch) <= 64:
                self.known[stretch] = found
        return found

    @staticmethod
    def options(stretch: str, at: int) -> list[tuple[int, str, float]]:
        """(class, character, cost) of what a character may stand for; without a character it is nothing."""
        ch = stretch[at]
        if "a" <= ch <= "z":
            found = [(ord(ch) - 96, ch, 0.0)]
            if at and ch == stretch[at - 1]:
                found.append((0, "", REPEAT if ch * 3 in stretch[max(0, at - 2) : at + 3] else TWICE))
        elif ch in LOOKALIKES:
            found = [(ord(x) - 96, x, SUBSTITUTE) for x in LOOKALIKES[ch]] + [(0, "", DROP)]
        elif ch.isalpha():
            found = [(CLASSES - 1, ch, 0.0)]
        else:
            found = [(0, "", MARK), (0, " ", BREAK.get(ch, 3.0))]
        return found

    def _viterbi(self, stretch: str) -> str:
        even = math.log(CLASSES - 1)
        paths = {(0, 0): (0.0, None)}  # by the last two classes: log odds less costs, and what was emitted
        for at in range(len(stretch)):
            choices = self.options(stretch, at)
            ahead: dict = {}
            for (a, b), (score, out) in paths.items():
                row = self.log[a][b]
                for c, ch, cost in choices:
                    if ch and not (c == b == 0):
                        key, value, more = (b, c), score + row[c] + even - cost, (out, ch)
                    else:
                        key, value, more = (a, b), score - cost, out
                    if key not in ahead or ahead[key][0] < value:
                        ahead[key] = value, more
            paths = ahead
        (_, out) = max(((score + self.log[a][b][0], out) for (a, b), (score, out) in paths.items()), key=lambda x: x[0])
        letters = []
        while out:
            out, c = out
            letters.append(c)
        return "".join(reversed(letters))

    def restored(self, text: str) -> list[str]:
        """The restored words of a text's suspicious stretches."""
        return [self.restore(word) for m in STRETCH.finditer(text) if (word := m[0].strip("._*-/~:"))]


def _suspicious(data, bounds):
    """Which texts may hold a disguised stretch; a text without a sign here has no match of STRETCH."""
    import numpy as np

    if len(data) < 3:
        return np.zeros(len(bounds) - 1, bool)
    kind = np.zeros(256, np.uint8)  # 1 letter, 2 digit, 3 mark that may stand for a letter or between letters
    kind[[*range(65, 91), *range(97, 123)]] = 1
    kind[48:58] = 2
    kind[[ord(c) for c in "@$!|+"]] = 2
    kind[[ord(c) for c in "_*.-/~: "]] = 3
    sign_bytes = np.zeros(256, bool)
    sign_bytes[sorted({b for c in LOOKALIKES if not c.isascii() for b in (c.encode()[0], c.encode()[-1])})] = True
    k = np.where(sign_bytes[data], 2, kind[data])
    inside = (k == 3) & (data != 32)
    sign = np.zeros(len(data), bool)
    sign[1:] |= ((k[:-1] == 2) | inside[:-1]) & (k[1:] == 1) | (k[:-1] == 1) & (k[1:] == 2)
    sign[2:] |= (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2]) & (k[2:] == 1)
    unit = (k == 1) | (k == 2)  # between two units that are apart lie one or two separators
    sign[2:] |= unit[2:] & unit[:-2] & (k[1:-1] == 3)
    sign[3:] |= unit[3:] & unit[:-3] & (k[1:-2] == 3) & (k[2:-1] == 3)
    return np.add.reduceat(np.r_[sign, False], bounds[:-1]) * (np.diff(bounds) > 0) > 0


def _features(texts: list[bytes]):
    """Row and hash of each word and word beginning of the texts, letters in lower case."""
    import numpy as np

    from .tokens import Rolling, mixed, word_spans

    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    gap = np.ones(256, bool)
    gap[97:123] = gap[0x80:] = False
    data = lower[np.frombuffer(b"".join(texts), np.uint8)]
    bounds = np.r_[0, np.cumsum([len(t) for t in texts])]
    starts, ends, before = word_spans(data, bounds, gap)
    rolling = Rolling(data.astype(np.uint64) + np.uint64(1))
    row = np.searchsorted(before, np.arange(len(starts)), side="right") - 1
    rows, values = [row], [mixed(rolling.spans(starts, ends) + (ends - starts).astype(np.uint64))]
    for n in (4, 5, 6):
        longer = ends - starts > n
        rows.append(row[longer])
        values.append(mixed(rolling.spans(starts[longer], starts[longer] + n) + np.uint64(1000 + n)))
    return np.concatenate(rows), np.concatenate(values)


def _restored_texts(column, restorer):
    from .tokens import text_bytes

    data, bounds = text_bytes(column)
    raw = data.tobytes()
    texts = [raw[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
    for i in _suspicious(data, bounds).nonzero()[0]:
        words = restorer.restored(texts[i].decode("utf-8", "replace"))
        if words:
            texts[i] += (" " + " ".join(words)).encode()
    return texts


class Lexicon:
    def __init__(self, weights: dict[int, float]):
        import numpy as np

        self.hashes = np.array(sorted(weights), np.uint64)
        self.weights = np.array([weights[int(h)] for h in self.hashes])
        self.may = np.zeros(1 << 20, bool)
        self.may[(self.hashes & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def hits(self, rows, values):
        """Distinct (row, entry) pairs among features."""
        import numpy as np

        if not len(self.hashes):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        some = self.may[(values & np.uint64((1 << 20) - 1)).astype(np.int64)]
        rows, values = rows[some], values[some]
        at = np.minimum(np.searchsorted(self.hashes, values), len(self.hashes) - 1)
        real = self.hashes[at] == values
        pair = np.unique(rows[real] * len(self.hashes) + at[real])
        return pair // len(self.hashes), pair % len(self.hashes)

    def summary(self, texts: list[bytes]):
        """Per text: 1, the highest weight, and the logarithms of the sum of weights and of the number of hits."""
        import numpy as np

        out = np.zeros((len(texts), 4))
        out[:, 0] = 1
        row, entry = self.hits(*_features(texts))
        np.maximum.at(out[:, 1], row, self.weights[entry])
        out[:, 2] = np.log1p(np.bincount(row, self.weights[entry], len(texts)))
        out[:, 3] = np.log1p(np.bincount(row, minlength=len(texts)))
        return out / (1, 10, 4, 3)


def _logistic(x, y, ridge: float = 0.1, rounds: int = 50):
    """Newton's method for a ridge logistic model."""
    import numpy as np

    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w += step
        if abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, *, max_labelled: int = 20_000, support: int = 3, least_weight: float = 2.0):
    """The character model, the lexicon's weights and the logistic weights (None without toxic labels)."""
    import numpy as np

    counts = {r.code: r.n for r in trigram_counts(docs).collect()}  # at most 28^3 rows
    model = log_model(counts)
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("label"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    train = saved(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "label"), "labelled")

    def count(wanted):
        def run(batches):
            import pyarrow as pa

            restorer, lexicon = Restorer(model), Lexicon(dict.fromkeys(wanted, 0.0)) if wanted is not None else None
            for batch in text_batches(batches, "text", limit=1 << 20):
                rows, values = _features(_restored_texts(batch.column(0), restorer))
                if lexicon is not None:
                    _, entry = lexicon.hits(rows, values)
                    values = lexicon.hashes[entry]
                else:
                    order = np.lexsort((values, rows))
                    rows, values = rows[order], values[order]
                    values = values[np.r_[True, (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])]] if len(rows) else values
                h, n = np.unique(values, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["h", "n"])

        return run

    n_toxic, n_clean = train.where("label = 1").count(), train.where("label = 0").count()
    if not n_toxic:
        return model, {}, None
    toxic = train.where("label = 1").select("text").mapInArrow(count(None), "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= support)
    toxic = {r.h % 2**64: r.n for r in toxic.collect()}  # features of at least `support` of at most max_labelled texts
    clean = train.where("label = 0").select("text").mapInArrow(count(toxic), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    clean = {r.h % 2**64: r.n for r in clean.collect()}
    weights = {h: float(np.log((n + 0.5) / (n_toxic + 1)) - np.log((clean.get(h, 0) + 0.5) / (n_clean + 1))) for h, n in toxic.items()}
    weights = {h: w for h, w in weights.items() if w >= least_weight}

    def summarise(batches):
        import pyarrow as pa

        restorer, lexicon = Restorer(model), Lexicon(weights)
        for batch in text_batches(batches, "text", limit=1 << 20):
            x = lexicon.summary(_restored_texts(batch.column(0), restorer))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in x.T] + [batch.column(1)], names=["a", "b", "c", "d", "label"])

    rows = np.array(train.mapInArrow(summarise, "a double, b double, c double, d double, label int").collect(), float)  # at most max_labelled rows of ids
    return model, weights, _logistic(rows[:, :4], rows[:, 4])


def score(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """(doc, score, predicted): each row as a struct of its columns, its score (0 to 1), and 1 if that is 0.5 or more."""
    model, weights, logistic = fit(docs, labels, **settings)
    rows = small_batches(docs).select(F.col("text"), F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]).alias("doc"))
    schema = rows.select("doc", F.lit(0.0).alias("score"), F.lit(0).alias("predicted")).schema

    def run(batches):
        import numpy as np
        import pyarrow as pa

        restorer, lexicon = Restorer(model), Lexicon(weights)
        for batch in text_batches(batches, "text", limit=1 << 20):
            if logistic is None:
                p = np.zeros(batch.num_rows)
            else:
                p = 1 / (1 + np.exp(-np.clip(lexicon.summary(_restored_texts(batch.column(0), restorer)) @ logistic, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], names=["doc", "score", "predicted"])

    return rows.mapInArrow(run, schema)


def report(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    scored = score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), labels, **settings)
    return scored.select("doc.doc_id", held_out("doc.doc_id").alias("held_out"), "score", "predicted")
