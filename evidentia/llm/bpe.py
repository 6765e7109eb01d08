"""Byte-level BPE by a lazily determinised transducer, and streaming decoding.

Encoding of a piece, left to right: the encoding of each prefix ends in one token, the only one that ends there and
forms a stable pair with the last token of the prefix before it (a pair is stable if the merges leave it as it is). The
transducer keeps, for each boundary that a longer token may still start at, the tokens not yet emitted up to it. What
all these alternatives share is final and is emitted; the rest is the bounded lookahead. States are made when first
reached and kept in a table of bounded size, as are whole pieces; a full table is emptied, which changes no result.

A null text is empty and has no tokens. Rows are independent; ids and further columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import marshal
from struct import pack

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CACHES, small_batches, text_batches

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, ids binary"


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks by token, from lines of base64 and rank."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}


class Transducer:
    """Encodes pieces of bytes; states are compiled from the ranks as they are met."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = 250_000, max_pieces: int = 300_000):
        self.ranks = ranks
        self.prefixes = {t[:n] for t in ranks for n in range(1, len(t))}
        self.token = {i: t for t, i in ranks.items()}
        self.max_states, self.max_pieces = max_states, max_pieces
        self.pairs: dict[int, bool] = {}
        self.edges: dict[tuple[int, bool], list[tuple[bytes, int]] | None] = {}
        self.pieces: dict[str, bytes] = {}
        self._reset()

    def _reset(self) -> None:
        self.number: dict[bytes, int] = {}
        self.states: list[bytes] = []
        self.moves: dict[int, int | tuple[int, tuple[int, ...]]] = {}
        self.ends: list[tuple[int, ...]] = []
        self.same: dict[tuple[int, ...], tuple[int, ...]] = {}
        self._state(b"", ((0, -1, ()),))

    def _state(self, tail: bytes, boundaries: tuple) -> int:
        """The number of a state: the bytes that a token may still span, and (bytes since, last token, pending tokens) by boundary.

        States are kept packed, and equal token tuples once, as a table holds some 10^5 of them.
        """
        packed = marshal.dumps((tail, boundaries), 2)  # without references, so that equal states have equal bytes
        if (n := self.number.get(packed)) is None:
            n = self.number[packed] = len(self.states)
            self.states.append(packed)
            pending = boundaries[-1][2]
            self.ends.append(self.same.setdefault(pending, pending))
        return n

    def stable(self, left: int, right: int) -> bool:
        """Whether the merges turn the two tokens' bytes into just these two tokens."""
        if (known := self.pairs.get(left << 32 | right)) is None:
            if len(self.pairs) > self.max_states:
                self.pairs.clear()
            known = self.pairs[left << 32 | right] = self._stable(left, right)
        return known

    def _edge(self, token: int, last: bool) -> list[tuple[bytes, int]] | None:
        """The parts at a token's last (or first) edge as its bytes merge, each with the rank of the merge that ends it.

        None if the merges don't make the token, or not in the order of their ranks.
        """
        if (token, last) not in self.edges:
            data, edge = self.token[token], []
            steps = list(self.merging(data))
            in_order = steps[-1] == [data] and all(a[0] < b[0] for a, b in zip(self.taken, self.taken[1:]) if a[0] != b[0])
            for parts, (rank, _) in zip(steps, [*self.taken, (1 << 60, 0)]):
                part = parts[-1 if last else 0]
                if edge and edge[-1][0] == part:
                    edge[-1] = part, rank
                else:
                    edge.append((part, rank))
            self.edges[token, last] = edge if in_order else None
        return self.edges[token, last]

    def _stable(self, left: int, right: int) -> bool:
        a, b = self._edge(left, True), self._edge(right, False)
        if a is None or b is None:
            return self.merged(self.token[left] + self.token[right]) == [self.token[left], self.token[right]]
        i = j = 0
        while True:
            (x, x_ends), (y, y_ends) = a[i], b[j]
            across = self.ranks.get(x + y, 1 << 60)
            if across < x_ends and across <= y_ends and across < 1 << 60:
                return False
            if x_ends == y_ends == 1 << 60:
                return True
            if x_ends <= y_ends:
                i += 1
            else:
                j += 1

    def merging(self, data: bytes):
        """The parts before and after each merge, lowest rank first and leftmost among equals; `taken` lists rank and place."""
        self.taken: list[tuple[int, int]] = []
        parts = [data[i : i + 1] for i in range(len(data))]
        yield list(parts)
        while len(parts) > 1:
            rank, at = min((self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 60:
                return
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            self.taken.append((rank, at))
            yield list(parts)

    def merged(self, data: bytes) -> list[bytes]:
        """The parts after all merges."""
        *_, parts = self.merging(data)
        return parts

    def _move(self, n: int, byte: int) -> int | tuple[int, tuple[int, ...]]:
        """Where a byte leads, and the tokens that it makes final, if any."""
        tail, boundaries = marshal.loads(self.states[n])
        tail += bytes((byte,))
        size, here, still = len(tail), None, []
        for since, last, pending in boundaries:
            word = tail[size - since - 1 :]
            if here is None and (t := self.ranks.get(word)) is not None and (last < 0 or self.stable(last, t)):
                here = (0, t, (*pending, t))
            if word in self.prefixes:
                still.append((since + 1, last, pending))
        if here is None:
            raise ValueError("the vocabulary lacks single bytes")
        still.append(here)
        first, shared = still[0][2], len(still[0][2])
        for _, _, pending in still[1:]:
            k = 0
            while k < shared and k < len(pending) and pending[k] == first[k]:
                k += 1
            shared = k
        out = here[2][:shared]
        to = self._state(tail[size - still[0][0] :] if still[0][0] else b"", tuple((s, last, p[shared:]) for s, last, p in still))
        move = self.moves[n << 8 | byte] = (to, self.same.setdefault(out, out)) if out else to
        return move

    def run(self, piece: bytes) -> list[int]:
        """Ids of a piece by the transducer alone."""
        if len(self.states) > self.max_states:
            self._reset()
        n, out, moves = 0, [], self.moves
        for byte in piece:
            move = moves.get(n << 8 | byte)
            if move is None:
                move = self._move(n, byte)
            if type(move) is int:
                n = move
            else:
                n, emitted = move
                out += emitted
        out += self.ends[n]
        return out

    def encode(self, piece: str) -> bytes:
        """Ids of a piece as little-endian 32-bit integers; a piece that is a token is that token."""
        if (known := self.pieces.get(piece)) is None:
            data = piece.encode()
            ids = [self.ranks[data]] if data in self.ranks else self.run(data)
            known = pack(f"<{len(ids)}I", *ids)
            if len(piece) <= 64:
                if len(self.pieces) >= self.max_pieces:
                    self.pieces.clear()
                self.pieces[piece] = known
        return known


#: Of each class of UTF-8 lead bytes: how many bytes follow, and the least and greatest first of them.
FOLLOW = [((0xC2, 0xDF), 1, 0x80, 0xBF), ((0xE0, 0xE0), 2, 0xA0, 0xBF), ((0xE1, 0xEC), 2, 0x80, 0xBF), ((0xED, 0xED), 2, 0x80, 0x9F), ((0xEE, 0xEF), 2, 0x80, 0xBF), ((0xF0, 0xF0), 3, 0x90, 0xBF), ((0xF1, 0xF3), 3, 0x80, 0xBF), ((0xF4, 0xF4), 3, 0x80, 0x8F)]
WHOLE, BROKEN = (0, 0, 0), None


def _steps() -> dict:
    """The machine: what each byte makes of each state (bytes still to come, and the range of the next one)."""
    states = {WHOLE} | {(n, low, high) for _, n, low, high in FOLLOW} | {(n, 0x80, 0xBF) for n in (1, 2)}
    step = {}
    for n, low, high in states:
        for byte in range(256):
            if n:
                step[(n, low, high), byte] = ((n - 1, 0x80, 0xBF) if n > 1 else WHOLE) if low <= byte <= high else BROKEN
            else:
                lead = [(k, a, b) for (first, last), k, a, b in FOLLOW if first <= byte <= last]
                step[WHOLE, byte] = WHOLE if byte < 0x80 else lead[0] if lead else BROKEN
    return step


STEPS = _steps()


class Utf8Stream:
    """An incremental UTF-8 machine: text of the bytes so far, while an unfinished character waits for its rest.

    The machine's state after a chunk tells how many bytes are still to come. As every state but WHOLE is reached from a
    lead byte at most three bytes back, it is found by stepping over the last bytes from the last lead byte on; what lies
    before the unfinished character is decoded at once. Bytes that can't be part of a character become U+FFFD.
    """

    def __init__(self):
        self.waiting = b""

    def feed(self, chunk: bytes) -> str:
        data = self.waiting + chunk
        cut = len(data)
        for lead in range(len(data) - 1, max(-1, len(data) - 4), -1):
            if not 0x80 <= data[lead] <= 0xBF:
                state = WHOLE
                for byte in data[lead:]:
                    state = STEPS[state, byte]
                    if state is BROKEN:
                        break
                if state not in (WHOLE, BROKEN):
                    cut = lead
                break
        self.waiting = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self.waiting = self.waiting, b""
        return rest.decode("utf-8", "replace")


class Decoder:
    """Streaming decoding: ids in chunks of any size to text; an unfinished character waits for the next chunk."""

    def __init__(self, token: dict[int, bytes]):
        self.token, self.stream = token, Utf8Stream()

    def feed(self, ids) -> str:
        return self.stream.feed(b"".join(map(self.token.__getitem__, ids)))

    def close(self) -> str:
        return self.stream.close()


_COMPILED: dict[bytes, Transducer] = CACHES.setdefault("bpe", {})


def _compiled(vocabulary: bytes, max_states: int, max_pieces: int) -> Transducer:
    """One transducer for each vocabulary and Python worker."""
    key = hashlib.sha256(vocabulary).digest()
    if key not in _COMPILED:
        _COMPILED[key] = Transducer(read_ranks(vocabulary), max_states, max_pieces)
    machine = _COMPILED[key]
    machine.max_states, machine.max_pieces = max_states, max_pieces
    return machine


def encode_and_decode(docs: DataFrame, vocabulary_path: str, pattern: str, *, chunk: int = 8192, max_states: int = 250_000, max_pieces: int = 300_000) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256 and ids, the ids as little-endian 32-bit integers.

    The ids are decoded again in chunks by the streaming decoder; decoded_sha256 is of the text that comes back, in UTF-8.
    max_states and max_pieces bound a Python worker's tables (about 600 and 200 bytes an entry) and change no result.
    """
    with open(vocabulary_path, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import regex

        machine, find = _compiled(shared.value, max_states, max_pieces), regex.compile(pattern).findall
        encode, known = machine.encode, machine.pieces.get
        for batch in text_batches(batches, "text", keep="bpe"):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = b"".join([known(p) or encode(p) for p in find(text or "")])
                numbers, decoder, back = np.frombuffer(ids, "<u4").tolist(), Decoder(machine.token), hashlib.sha256()
                for i in range(0, len(numbers), chunk):
                    back.update(decoder.feed(numbers[i : i + chunk]).encode())
                back.update(decoder.close().encode())
                rows.append((doc_id, len(numbers), hashlib.sha256(ids).hexdigest(), back.hexdigest(), ids))
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary()))], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"])

    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)
