"""Token counts by a deterministic transducer compiled from a BPE vocabulary.

Reading one character takes the transducer to the next state and emits a (possibly negative) change
of the number of tokens, so that the sum is always the number of tokens of what was read.  This
rests on two properties of BPE with ranked merges, for any text:

* a list of pieces is the encoding of its text if and only if every two neighbours are the encoding
  of their joint text: the merges inside two neighbours never depend on what stands around them;
* so without its last piece, the encoding of a text is the encoding of what that piece leaves.

The last piece after a character is therefore the one suffix of the text that fits the last piece of
the prefix before it.  A state holds the longest suffix that begins some piece and, for each place in
it where a later piece may begin, the last piece before that place and the tokens up to there.  The
states that texts reach are compiled when first met and kept in flat transition tables of a bounded
size; full tables are emptied and filled anew, which changes no result.

Texts are cut into chunks of a fixed length.  What a chunk does is a map from the state before it to
the state after it and a count.  From the first place on where two neighbouring characters stand in no
piece, that map is constant, so chunks are run side by side from there, one character of all chunks at
a time.  The maps are then composed by a prefix scan: the state before a chunk is the one left by the
last constant map before it; only the heads of the chunks are run again from there.

Defined results: a null or empty text has 0 bytes and 0 tokens; rows are independent.  All columns of
the input stay; `n_bytes` and `n_tokens` replace columns of these names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from chatterscope.llm import arrays, piece_bpe

CHUNK = 256
MOST_CELLS = 40_000_000
_PLAIN = ((), ())  # no open piece: what follows is encoded on its own


class Transducer:
    def __init__(self, model: piece_bpe.PieceModel, most_cells: int = MOST_CELLS):
        self.model, self.most_cells = model, most_cells
        self.prefixes = {p[:k] for p in model.ids for k in range(1, len(p) + 1)}
        self.made = {(a, b): i for a, b, i in model.pairs}
        self.rank = model.rank.tolist()
        self.piece = {i: p for p, i in model.ids.items()}
        self.fit: dict[tuple[int | None, int], bool] = {}
        self.longer = {p[:k] for p in model.ids for k in range(1, len(p))}
        self.heads: dict[int, set[str]] = {}
        for a, b, _ in model.pairs:
            self.heads.setdefault(a, set()).add(self.piece[b][0])
        self.known_class: dict = {}
        self.flushes = -1
        self._flush()

    def _flush(self) -> None:
        self.flushes += 1
        self.state_of: dict = {}
        self.states: list = []
        self.column = np.full(0x110000, -1, np.int32)
        self.chars: list[str] = []
        self.next = np.full((1024, 128), -1, np.int32)
        self.emit = np.zeros((1024, 128), np.int8)
        self.start = self._state("", *_PLAIN)

    def _state(self, suffix: str, last: tuple, before: tuple) -> int:
        key = (suffix, last, before)
        if key not in self.state_of:
            self.state_of[key] = len(self.states)
            self.states.append(key)
            if len(self.states) > len(self.next):
                self.next = np.concatenate((self.next, np.full_like(self.next, -1)))
                self.emit = np.concatenate((self.emit, np.zeros_like(self.emit)))
        return self.state_of[key]

    def _columns(self, points: np.ndarray) -> np.ndarray:
        """A table column for every character; characters in no longer piece share one by size."""
        out = self.column[points]
        if (out < 0).any():
            for point in np.unique(points[out < 0]).tolist():
                char = piece_bpe.SPACE if point == 32 else chr(point)
                if not self.model.char_class[point]:
                    known = self.model.of_char[point] < self.model.size
                    char = f"alone {1 if known else len(char.encode())}"
                if char not in self.chars:
                    self.chars.append(char)
                    if len(self.chars) > self.next.shape[1]:
                        self.next = np.concatenate((self.next, np.full_like(self.next, -1)), axis=1)
                        self.emit = np.concatenate((self.emit, np.zeros_like(self.emit)), axis=1)
                self.column[point] = self.chars.index(char)
            out = self.column[points]
        return out

    def _encoded(self, symbols: list[int]) -> list[int]:
        """Merges one by one, for a few characters."""
        while True:
            found = [
                (self.rank[m], k, m)
                for k in range(len(symbols) - 1)
                if (m := self.made.get((symbols[k], symbols[k + 1]))) is not None
            ]
            if not found:
                return symbols
            _, k, m = min(found)
            symbols = [*symbols[:k], m, *symbols[k + 2 :]]

    def _fits(self, left: int | None, right: int) -> bool:
        """Whether the two are the encoding of their joint text."""
        if (left, right) not in self.fit:
            text = (self.piece[left] if left is not None else "") + self.piece[right]
            want = [right] if left is None else [left, right]
            self.fit[left, right] = self._encoded([self.model.ids[c] for c in text]) == want
        return self.fit[left, right]

    def _class(self, left: int | None, prefix: str) -> tuple[int | None] | None:
        """What matters of the piece before a place where longer pieces with this prefix may begin:
        nothing if none of its ends can be merged with such a beginning; None if there is no longer
        piece."""
        if prefix not in self.longer:
            return None
        key = (left, prefix[0])
        if key not in self.known_class:
            text = self.piece[left] if left is not None else ""
            ends = (self.model.ids.get(text[k:], -1) for k in range(len(text)))
            self.known_class[key] = (left,) if any(prefix[0] in self.heads.get(e, ()) for e in ends) else (None,)
        return self.known_class[key]

    def _compile(self, state: int, column: int) -> None:
        """Fill one cell of the tables."""
        suffix, last, before = self.states[state]
        char = self.chars[column]
        if char.startswith("alone "):
            self.next[state, column], self.emit[state, column] = self.start, int(char[6:])
            return
        text, cut = suffix + char, 0
        while text[cut:] not in self.prefixes:
            cut += 1
        text = text[cut:]
        # places 0 to len(suffix) of the state; the last place counts 0 tokens by definition
        last, before = last[cut:], before[cut:]
        if not last:  # nothing before matters
            last, before = (None,), (0,)
        for k in range(len(text)):
            piece = self.model.ids.get(text[k:])
            if piece is not None and before[k] is not None and self._fits(last[k], piece):
                count = before[k] + 1
                break
        else:
            raise AssertionError(f"no piece ends {text!r}")
        last, before = [*last, piece], [*before, count]
        for k in range(len(text) + 1):  # forget what no later piece can reach
            if before[k] is None:
                continue
            group = self._class(last[k], text[k:]) if k < len(text) else (last[k],)
            last[k], before[k] = (None, None) if group is None else (group[0], before[k] - count)
        target = self._state(text, tuple(last), tuple(before))
        self.next[state, column], self.emit[state, column] = target, count

    def run(self, columns: np.ndarray, starts: np.ndarray, ends: np.ndarray, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """States and token counts after columns[start:end], all spans in step."""
        order = np.argsort(starts - ends, kind="stable")
        at, size, now = starts[order], (ends - starts)[order], states[order].astype(np.int64)
        count = np.zeros(len(order), np.int64)
        live = np.searchsorted(-size, -np.arange(size[0] if len(size) else 0), "left")
        for step, n in enumerate(live.tolist()):
            c = columns[at[:n] + step]
            target = self.next[now[:n], c]
            if (target < 0).any():
                new = np.unique(now[:n][target < 0] << 32 | c[target < 0])
                for cell in new.tolist():
                    self._compile(cell >> 32, cell & 0xFFFFFFFF)
                target = self.next[now[:n], c]
            count[:n] += self.emit[now[:n], c]
            now[:n] = target
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        return now[back], count[back]

    def counts(self, data: np.ndarray, offsets: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
        """The number of tokens of every text."""
        if self.next.size > self.most_cells:
            self._flush()
        points, at = self.model.points(data, offsets)
        columns = self._columns(points)
        sizes = np.diff(at)
        chunks = -(-sizes // chunk)
        begin = np.concatenate(([0], np.cumsum(chunks)))
        starts = (np.arange(begin[-1]) - np.repeat(begin[:-1], chunks)) * chunk + np.repeat(at[:-1], chunks)
        ends = np.minimum(starts + chunk, np.repeat(at[1:], chunks))
        # where each chunk's map becomes constant; at its end: nowhere
        cuts = self.model.cuts(points, at)
        k = np.searchsorted(cuts, starts)
        fixed = np.minimum(np.append(cuts, len(points))[k], ends)
        left, total = self.run(columns, fixed, ends, np.full(len(starts), self.start))
        # the prefix scan: the state before a chunk is known once that of the chunk before it is
        fresh = np.zeros(len(starts), bool)
        fresh[begin[:-1][chunks > 0]] = True
        constant = fixed < ends
        open_ = np.flatnonzero(fixed > starts)
        done = ~(fixed > starts)
        known = constant.copy()
        while len(open_):
            ready = open_[fresh[open_] | known[open_ - 1]]
            entry = np.where(fresh[ready], self.start, left[ready - 1])
            after, count = self.run(columns, starts[ready], fixed[ready], entry)
            total[ready] += count
            whole = ~constant[ready]
            left[ready[whole]] = after[whole]
            known[ready] = True
            done[ready] = True
            open_ = open_[~done[open_]]
        sums = np.concatenate(([0], np.cumsum(total)))
        return sums[begin[1:]] - sums[begin[:-1]]


@cache
def load(path: str) -> Transducer:
    return Transducer(piece_bpe.load(path))


def count_tokens(docs: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """The rows with `n_bytes` and `n_tokens` (both long) of their texts."""
    kept = [f for f in docs.schema.fields if f.name not in ("n_bytes", "n_tokens")]
    schema = T.StructType([*kept, T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = load(model_path)
        for batch in batches:
            rest = batch.select([f.name for f in kept])
            for row, data, offsets in arrays.blocks(arrays.column(batch, text)):
                part = rest.slice(row, len(offsets) - 1)
                made = [pa.array(np.diff(offsets), pa.int64()), pa.array(transducer.counts(data, offsets), pa.int64())]
                yield pa.RecordBatch.from_arrays([*part.columns, *made], names=[*part.schema.names, "n_bytes", "n_tokens"])

    return docs.mapInArrow(run, schema)
