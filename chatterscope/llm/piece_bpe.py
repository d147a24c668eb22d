"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

All distinct segments of a block of texts are merged at once: flat arrays of symbols, the smallest
pair rank of every segment by a segmented minimum, all its leftmost non-overlapping occurrences
merged in one round, then compaction, until no pair remains.  A segment is a stretch of text no merge
can leave: texts are cut wherever two neighbouring characters stand next to each other in no piece,
which also cuts before every run of spaces.

Defined results: a null or empty text has no ids and decodes to an empty text; characters without a
piece become one byte piece per UTF-8 byte; bytes that are no UTF-8 decode to U+FFFD each.  Rows are
independent, so repeated rows and ties need no rule; all columns of the input stay, and `ids` and
`decoded` replace columns of these names.
"""

from __future__ import annotations

import codecs
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from chatterscope.llm import arrays

NO_PAIR = np.int32(2**31 - 1)
SPACE = "▁"
codecs.register_error(
    "piece_bytes", lambda e: ("�" * (e.end - e.start), e.end)
)  # each byte that is no UTF-8


class PairTable:
    """Pairs of small integers to a value, by open addressing in two flat arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, value: np.ndarray):
        self.bits = max(4, int(len(left) * 8).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.zeros(1 << self.bits, np.int32)
        for key, v in zip((left.astype(np.int64) << 32 | right).tolist(), value.tolist()):
            at = int(self._home(np.array([key], np.int64))[0])
            while self.keys[at] >= 0:
                at = (at + 1) & ((1 << self.bits) - 1)
            self.keys[at], self.values[at] = key, v

    def _home(self, key: np.ndarray) -> np.ndarray:
        h = key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The values, -1 where there is none."""
        key = left.astype(np.int64) << 32 | right.astype(np.int64)
        at = self._home(key)
        found = self.keys[at]
        out = np.where(found == key, self.values[at], -1)
        open_ = np.flatnonzero((found != key) & (found >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            found = self.keys[at[open_]]
            hit = found == key[open_]
            out[open_[hit]] = self.values[at[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return out


class PieceModel:
    """What a BPE model file says, as arrays.

    Symbols below `size` are piece ids; other characters are `size` + code point.
    """

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        spec, kinds = proto.normalizer_spec, sentencepiece_model_pb2.ModelProto.SentencePiece
        if proto.trainer_spec.model_type != 2 or spec.precompiled_charsmap or spec.remove_extra_whitespaces:
            raise ValueError("a BPE model without text normalization is needed")
        if any(p.type == kinds.USER_DEFINED for p in proto.pieces) or not proto.trainer_spec.byte_fallback:
            raise ValueError("a model with byte pieces and without user-defined pieces is needed")
        self.size = len(proto.pieces)
        self.prefix = spec.add_dummy_prefix
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == kinds.NORMAL}
        order = {s: k for k, s in enumerate(sorted({p.score for p in proto.pieces}, reverse=True))}
        self.rank = np.array([order[p.score] for p in proto.pieces], np.int32)
        self.byte_ids = np.zeros(256, np.int32)
        text: list[bytes] = []
        for i, p in enumerate(proto.pieces):
            if p.type == kinds.BYTE:
                self.byte_ids[int(p.piece[3:5], 16)] = i
                text.append(bytes([int(p.piece[3:5], 16)]))
            elif p.type == kinds.NORMAL:
                text.append(p.piece.replace(SPACE, " ").encode())
            else:  # an unknown piece decodes to a mark, control pieces to nothing
                text.append(" ⁇ ".encode() if p.type == kinds.UNKNOWN else b"")
        self.text = np.array(text, object)
        self.of_char = np.arange(0x110000, dtype=np.int32) + self.size
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.of_char[ord(piece)] = i
        self.of_char[ord(" ")] = self.of_char[ord(SPACE)]
        self.pairs = [
            (self.ids[p[:k]], self.ids[p[k:]], i)
            for p, i in self.ids.items()
            for k in range(1, len(p))
            if p[:k] in self.ids and p[k:] in self.ids
        ]
        left, right, whole = np.array(self.pairs, np.int32).reshape(-1, 3).T
        self.merges = PairTable(left, right, whole)
        #: Pieces after whose making a better pair than the one merged can appear beside them.
        self.alone = np.zeros(self.size, bool)
        for part in (left, right):
            self.alone[part[self.rank[whole] <= self.rank[part]]] = True
        chars = sorted({c for p in self.ids if len(p) > 1 for c in p if c in self.ids})
        #: Characters of longer pieces by class; class 0 can be merged with nothing.
        self.char_class = np.zeros(0x110000, np.int32)
        self.char_class[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.char_class[ord(" ")] = self.char_class[ord(SPACE)]
        self.classes = len(chars) + 1
        self.beside = np.zeros((self.classes, self.classes), bool)
        for p in self.ids:
            c = self.char_class[[ord(x) for x in p]]
            self.beside[c[:-1], c[1:]] = True
        self.beside[0] = self.beside[:, 0] = False

    def points(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Code points with the space that the model sets before every text that is not empty."""
        points, at = arrays.code_points(data, offsets)
        if self.prefix:
            full = np.diff(at) > 0
            points = np.insert(points, at[:-1][full], ord(" "))
            at = at + np.concatenate(([0], np.cumsum(full)))
        return points, at

    def cuts(self, points: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Places of the first character of every segment."""
        if not len(points):
            return np.zeros(0, np.int64)
        c = self.char_class[points]
        cut = np.ones(len(points), bool)
        cut[1:] = ~self.beside[c[:-1], c[1:]]
        cut[at[:-1][at[:-1] < len(points)]] = True
        return np.flatnonzero(cut)


@cache
def load(path: str) -> PieceModel:
    return PieceModel(path)


def merge_rounds(model: PieceModel, symbols: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The merged symbols of all segments (none is empty) and the segments' offsets in them."""
    n = len(offsets) - 1
    word = np.repeat(np.arange(n), np.diff(offsets))
    done_symbols, done_words = [], []

    def ranked(at: np.ndarray) -> np.ndarray:
        """The rank of the pair that begins at each place, and the piece that it makes."""
        made = np.full(len(at), -1, np.int32)
        ok = at + 1 < len(symbols)
        ok[ok] = word[at[ok]] == word[at[ok] + 1]
        made[ok] = model.merges.get(symbols[at[ok]], symbols[at[ok] + 1])
        return made

    piece = ranked(np.arange(len(symbols)))
    while len(symbols):
        rank = np.where(piece >= 0, model.rank[piece], NO_PAIR)
        starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
        least = np.minimum.reduceat(rank, starts)
        sizes = np.diff(np.append(starts, len(symbols)))
        open_ = np.repeat(least < NO_PAIR, sizes)
        if not open_.all():  # finished segments leave
            done_symbols.append(symbols[~open_])
            done_words.append(word[~open_])
            symbols, word, piece, rank = symbols[open_], word[open_], piece[open_], rank[open_]
            keep = least < NO_PAIR
            least, sizes = least[keep], sizes[keep]
            if not len(symbols):
                break
        at = np.flatnonzero(rank == np.repeat(least, sizes))
        # of overlapping occurrences every second one, from the left
        fresh = np.concatenate(([True], np.diff(at) != 1))
        run = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
        take = (np.arange(len(at)) - run) % 2 == 0
        lone = model.alone[piece[at]]
        if lone.any():  # only the first of the segment, then look again
            leader = np.concatenate(([True], word[at[1:]] != word[at[:-1]]))
            first = np.maximum.accumulate(np.where(leader, np.arange(len(at)), 0))
            some = np.zeros(len(at), bool)
            np.logical_or.at(some, first[lone], True)
            take &= ~some[first] | leader
        at = at[take]
        symbols[at] = piece[at]
        stay = np.ones(len(symbols), bool)
        stay[at + 1] = False
        place = np.cumsum(stay) - 1
        symbols, word, piece = symbols[stay], word[stay], piece[stay]
        touched = np.zeros(len(symbols) + 1, bool)
        touched[place[at]] = True
        touched[:-1] |= touched[1:]
        changed = np.flatnonzero(touched[:-1])
        piece[changed] = ranked(changed)
    if not done_words:
        return symbols, np.zeros(n + 1, np.int64)
    words = np.concatenate(done_words)
    order = np.argsort(words, kind="stable")
    return np.concatenate(done_symbols)[order], np.concatenate(([0], np.cumsum(np.bincount(words, minlength=n))))


def gather(values: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """values[offsets[r]:offsets[r + 1]] for all r of rows, and the offsets of these."""
    sizes = np.diff(offsets)[rows]
    at = np.concatenate(([0], np.cumsum(sizes)))
    return values[np.arange(at[-1]) + np.repeat(offsets[:-1][rows] - at[:-1], sizes)], at


def _ids(model: PieceModel, symbols: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte pieces in place of characters without a piece."""
    out_of = symbols >= model.size
    if not out_of.any():
        return symbols, offsets
    sizes = np.ones(len(symbols), np.int64)
    parts = [chr(c).encode() for c in (symbols[out_of] - model.size).tolist()]
    sizes[out_of] = [len(p) for p in parts]
    at = np.concatenate(([0], np.cumsum(sizes)))
    ids = np.empty(at[-1], np.int32)
    ids[at[:-1][~out_of]] = symbols[~out_of]
    ids[np.repeat(out_of, sizes)] = model.byte_ids[np.frombuffer(b"".join(parts), np.uint8)]
    return ids, at[offsets]


def encode(model: PieceModel, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts, and the offsets of the texts in them."""
    points, at = model.points(data, offsets)
    cuts = model.cuts(points, at)
    ends = np.append(cuts[1:], len(points))
    _, first, which = arrays.distinct_spans(points, cuts, ends)
    chars, segments = gather(points, np.append(cuts, len(points)), first) if len(cuts) else (points, np.zeros(1, np.int64))
    ids, segments = _ids(model, *merge_rounds(model, model.of_char[chars], segments))
    ids, ends = gather(ids, segments, which)
    return ids, ends[np.searchsorted(cuts, at)]


def decode(model: PieceModel, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
    """The text of every list of ids; the space before the first piece goes."""
    pieces, out = model.text[ids], []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        text = b"".join(pieces[a:b].tolist())
        if model.prefix and text[:1] == b" " and ids[a] != model.byte_ids[0x20]:
            text = text[1:]
        out.append(text.decode("utf-8", "piece_bytes"))
    return out


def encode_decode(docs: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """The rows with `ids` (array of int) of their texts and `decoded`, the text of these ids."""
    kept = [f for f in docs.schema.fields if f.name not in ("ids", "decoded")]
    schema = T.StructType([*kept, T.StructField("ids", T.ArrayType(T.IntegerType(), False)), T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(model_path)
        for batch in batches:
            rest = batch.select([f.name for f in kept])
            for row, data, offsets in arrays.blocks(arrays.column(batch, text)):
                ids, at = encode(model, data, offsets)
                made = [arrays.list_array(ids, at, pa.int32()), pa.array(decode(model, ids, at), pa.string())]
                part = rest.slice(row, len(offsets) - 1)
                yield pa.RecordBatch.from_arrays([*part.columns, *made], names=[*part.schema.names, "ids", "decoded"])

    return docs.mapInArrow(run, schema)
