"""Exact merge-type encoding of texts with the pieces of a model file, by backtracking, and decoding."""

from __future__ import annotations

import sys
import types

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import PIECE, mix, row_runs, text_view, window_sums
from .runs import Column, HashIndex

SPACE = "▁"
#: Distinct segments, and ids of them all, that a worker process remembers; a longer segment is searched each time.
_CACHE_SEGMENTS, _CACHE_IDS, _LONG = 1_000_000, 8_000_000, 4096
#: Token pairs whose check a worker process remembers.
_CACHE_PAIRS = 400_000
#: Characters whose longest matches are searched at once.
_BLOCK = 1 << 16
# Kinds of pieces in a model file, and what a decoder writes for the unknown id.
NORMAL, UNKNOWN, CONTROL, BYTE, BPE = 1, 2, 3, 6, 2
UNKNOWN_TEXT = " ⁇ "


def _model(path: str) -> PieceModel:
    """One model for each worker process: its tables serve all tasks that run there."""
    held = sys.modules.setdefault("_piece_models", types.ModuleType("_piece_models")).__dict__
    if path not in held:
        held[path] = PieceModel(path)
    return held[path]


class _Matches:
    """The longest piece that starts at each position of a long string, searched block by block."""

    def __init__(self, search, text: str, reach: int):
        self.search, self.text, self.reach, self.blocks = search, text, reach, {}

    def __getitem__(self, at: int) -> str:
        k, i = divmod(at, _BLOCK)
        if k not in self.blocks:
            if len(self.blocks) > 2:
                self.blocks.pop(max(self.blocks, key=lambda b: abs(b - k)))
            self.blocks[k] = self.search(self.text[k * _BLOCK : (k + 1) * _BLOCK + self.reach])
        return self.blocks[k][i]


class PieceModel:
    """Pieces with their scores. A text's encoding is what merging gives: starting from single characters,
    the neighbours whose joined text is the best-scored piece are merged, the first of equals, until none are left.

    Three facts make that a search. Merging one piece's own text gives the piece back (others are never
    the outcome and are left out); tokens side by side are what merging their joined text gives; and a sequence in which all
    neighbours pass that check is the encoding of the whole, the only one.
    """

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        norm, kinds = proto.normalizer_spec, {p.type for p in proto.pieces}
        if proto.trainer_spec.model_type != BPE or not kinds <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("only merge models of plain pieces are supported")
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("the model changes texts before it encodes them")
        self.prefix = SPACE if norm.add_dummy_prefix else ""
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.score = {p.piece: p.score for p in proto.pieces if p.type == NORMAL}
        self.byte_ids = {int(p.piece[1:-1], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self.unknown = next(i for i, p in enumerate(proto.pieces) if p.type == UNKNOWN)
        self.fallback = proto.trainer_spec.byte_fallback

        usable = {p for p in self.ids if len(self.merge(p)) == 1}
        self.reach = max(map(len, usable))
        # the next shorter piece that starts a piece; down to its first character, which is always a token
        self.shorter = {p: next((p[:k] for k in range(len(p) - 1, 1, -1) if p[:k] in usable), p[0]) for p in usable if len(p) > 1}
        self.automaton = ahocorasick.Automaton()
        for p in self.shorter:
            self.automaton.add_word(p, (len(p) - 1, p))
        self.automaton.make_automaton()
        self.pairs: dict[tuple[str, str], bool] = {}
        self._adjacent()
        self._clear()
        self._decode_table(proto)

    def merge(self, text: str, border: int = 0) -> list[str]:
        """The tokens of a short text by merging; none if a merge goes over the ``border`` (a character position)."""
        parts, score = list(text), self.score
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = score.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if best is None:
                return parts
            if border and sum(map(len, parts[: at + 1])) == border:
                return []
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _fit(self, left: str, right: str) -> bool:
        """Whether merging the joined text keeps the two tokens apart."""
        if len(self.pairs) >= _CACHE_PAIRS:
            self.pairs.clear()
        fits = self.pairs[left, right] = bool(self.merge(left + right, len(left)))
        return fits

    def _search(self, text: str) -> list[str]:
        """The longest piece that starts at each position, or the character there."""
        longest = list(text)
        for end, (back, piece) in self.automaton.iter(text):  # ends ascend, so of one start the longest comes last
            longest[end - back] = piece
        return longest

    def tokens(self, text: str) -> list[str]:
        """The tokens of a text."""
        n = len(text)
        return self._walk(self._search(text) if n <= _BLOCK else _Matches(self._search, text, self.reach), 0, n)

    def _walk(self, longest: list[str] | _Matches, first: int, n: int) -> list[str]:
        """The tokens of the ``n`` characters from ``first`` on: the longest match first, a shorter one where neighbours do
        not fit, back by one where none does. A position from which nothing goes on is marked and never tried again, so the
        search is linear."""
        alive = bytearray(b"\1") * (n + 1)
        out: list[str] = []
        at, token = 0, longest[first] if n else None
        shorter, pairs, fit = self.shorter, self.pairs, self._fit
        last = None
        while at < n:
            end = at + len(token)
            if alive[end] and (last is None or (pairs[last, token] if (last, token) in pairs else fit(last, token))):
                out.append(token)
                at, last = end, token
                if at < n:
                    token = longest[first + at]
            elif len(token) > 1:
                token = shorter[token]
            else:
                alive[at] = 0
                token = out.pop()
                last = out[-1] if out else None
                at -= len(token)
        return out

    def token_ids(self, tokens: list[str]) -> list[int]:
        try:
            return [self.ids[t] for t in tokens]
        except KeyError:
            pass
        out: list[int] = []
        for t in tokens:
            known = self.ids.get(t)
            if known is not None:
                out.append(known)
            elif self.fallback:
                out += [self.byte_ids[b] for b in t.encode()]
            elif not out or out[-1] != self.unknown:  # neighbours that are unknown make one id
                out.append(self.unknown)
        return out

    def _adjacent(self) -> None:
        """Which characters stand side by side in any piece. Where two do not, no piece crosses and a text can be cut."""
        chars = sorted({c for p in self.shorter for c in p})
        number = {c: k + 1 for k, c in enumerate(chars)}
        self.char_class = np.zeros(0x110000, np.int16)
        self.char_class[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.joined = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        for p in self.shorter:
            for a, b in zip(p, p[1:]):
                self.joined[number[a], number[b]] = True
        self.between = next(chr(k) for k in range(0x10000) if chr(k) not in number)  # joins segments for one search

    def _clear(self) -> None:
        self.known = HashIndex()
        self.flat, self.sizes, self.first = Column(np.int32), Column(np.int64), Column(np.int64)

    def _learn(self, hashes: np.ndarray, segments: list[str]) -> None:
        longest = self._search(self.between.join(segments))
        ids, at = [], 0
        for s in segments:
            ids.append(self.token_ids(self._walk(longest, at, len(s))))
            at += len(s) + 1
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        self.known.add(hashes)
        self.first.extend(len(self.flat) + np.cumsum(sizes) - sizes)
        self.sizes.extend(sizes)
        self.flat.extend(np.fromiter((i for own in ids for i in own), np.int32))

    def _chunk(self, text: str, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the segments text[starts:ends], which follow each other, and the number of ids of each."""
        lo, hi = int(starts[0]), int(ends[-1])
        if len(starts) == 1 and hi - lo > _LONG:
            ids = np.array(self.token_ids(self.tokens(text[lo:hi])), np.int32)
            return ids, np.array([len(ids)])
        sums, down = window_sums(mix(points[lo:hi].astype(np.uint64) + np.uint64(1)), hi - lo)
        a, b = starts - lo, ends - lo
        hashes, where, own = np.unique(mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64)), return_index=True, return_inverse=True)
        number = self.known.find(hashes)
        new = np.flatnonzero(number < 0)
        if len(new):
            if len(self.known) + len(new) > _CACHE_SEGMENTS or len(self.flat) > _CACHE_IDS:
                self._clear()
                new = np.arange(len(hashes))
            self._learn(hashes[new], [text[x:y] for x, y in zip(starts[where[new]].tolist(), ends[where[new]].tolist())])
            number[new] = np.arange(len(self.known) - len(new), len(self.known))
        code = number[own]
        sizes = self.sizes.values[code]
        upto = np.cumsum(sizes)
        return self.flat.values[np.repeat(self.first.values[code] - (upto - sizes), sizes) + np.arange(int(upto[-1]))], sizes

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each has.

        Texts are cut wherever no piece crosses. Equal segments (by a 64-bit hash) are searched once and looked up afterwards.
        """
        ready = [self.prefix + t.replace(" ", SPACE) if t else "" for t in texts]
        text = "".join(ready)
        if not text:
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        opens = np.zeros(len(points) + 1, bool)
        if self.fallback:  # else unknown neighbours make one id, over any cut
            kind = self.char_class[points]
            opens[1:-1] = ~self.joined[kind[:-1], kind[1:]]
        rows = np.concatenate([[0], np.cumsum([len(r) for r in ready])])
        opens[rows] = True
        bounds = np.flatnonzero(opens)
        starts, ends = bounds[:-1], bounds[1:]
        # a long segment is a chunk of its own; the others go by about PIECE characters
        long = ends - starts > _LONG
        breaks = np.flatnonzero(long[1:] | long[:-1] | (starts[1:] // PIECE != starts[:-1] // PIECE)) + 1
        ids, sizes = [], []
        for a, b in zip([0, *breaks.tolist()], [*breaks.tolist(), len(starts)]):
            own, size = self._chunk(text, points, starts[a:b], ends[a:b])
            ids.append(own)
            sizes.append(size)
        upto = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
        return np.concatenate(ids), np.diff(upto[np.searchsorted(bounds, rows)])

    def _decode_table(self, proto) -> None:
        raw = [{NORMAL: p.piece.replace(SPACE, " "), UNKNOWN: UNKNOWN_TEXT}.get(p.type, "").encode() for p in proto.pieces]
        for b, i in self.byte_ids.items():
            raw[i] = bytes([b])
        self.raw = raw
        self.raw_size = np.fromiter(map(len, raw), np.int64, len(raw))
        self.raw_first = np.cumsum(self.raw_size) - self.raw_size
        self.raw_flat = np.frombuffer(b"".join(raw), np.uint8)
        self.opens = np.array([bool(self.prefix) and p.type == NORMAL and p.piece.startswith(SPACE) for p in proto.pieces])
        self.is_byte = np.array([p.type == BYTE for p in proto.pieces])
        self.is_control = np.array([p.type == CONTROL for p in proto.pieces])

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """The texts of the id lists ids[offsets[k]:offsets[k+1]]. The space that encoding puts before a text goes."""
        size = self.raw_size[ids]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        data = self.raw_flat[np.repeat(self.raw_first[ids] - (ends - size), size) + np.arange(total)]
        bounds = np.concatenate([[0], ends])[offsets]
        head = offsets[:-1].copy()  # the first id with a text
        while len(some := np.flatnonzero((head < offsets[1:]) & self.is_control[ids[np.minimum(head, len(ids) - 1)]] if len(ids) else [])):
            head[some] += 1
        some = np.flatnonzero(head < offsets[1:])
        led = some[self.opens[ids[head[some]]]]
        keep = np.ones(total, bool)
        keep[bounds[led]] = False
        data, shift = data[keep], np.zeros(len(offsets), np.int64)
        np.add.at(shift, led + 1, 1)
        bounds = bounds - np.cumsum(shift)
        out = pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
        try:
            out.validate(full=True)
        except pa.ArrowInvalid:  # byte ids that are no characters
            out = pa.array([self._decode_bytes(ids[a:b].tolist()) for a, b in zip(offsets[:-1], offsets[1:])], pa.large_string())
        return out

    def _decode_bytes(self, ids: list[int]) -> str:
        """As ``decode`` for one list; a byte that belongs to no character becomes U+FFFD."""
        out, run, head = [], b"", True
        for i in [*ids, -1]:
            if i >= 0 and self.is_byte[i]:
                run += self.raw[i]
                head = False
                continue
            while run:
                for n in (1, 2, 3, 4):
                    try:
                        out.append(run[:n].decode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    n = 1
                run = run[n:]
            if i >= 0:
                text = self.raw[i].decode()
                out.append(text[1:] if head and self.opens[i] else text)
                head = head and bool(self.is_control[i])
        return "".join(out)


def _id_lists(ids: np.ndarray, counts: np.ndarray) -> pa.LargeListArray:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    return pa.LargeListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))


def encode(df: DataFrame, model_path: str, *, text_col: str = "text", out: str = "ids") -> DataFrame:
    """``df`` with the ids (array of int) of each text as a further column ``out``, in place of one of that name.

    The ids are those of the model's own library without begin and end ids and without sampling. A null or empty text has
    no ids. Rows are encoded where they lie, whole, without a shuffle; repeated rows are encoded each.
    """

    def ids_of(texts: pa.Array) -> pa.Array:
        model = _model(model_path)
        _, offsets = text_view(texts)
        parts = []
        for i, j in row_runs(offsets):
            ids, counts = model.encode(texts.slice(i, j - i).to_pylist())
            parts.append(_id_lists(ids, counts))
        whole = pa.concat_arrays(parts) if parts else _id_lists(np.zeros(0, np.int32), np.zeros(0, np.int64))
        return whole.cast(pa.list_(pa.int32()))

    return df.withColumn(out, F.arrow_udf(ids_of, "array<int>")(F.col(text_col)))


def decode(df: DataFrame, model_path: str, *, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the text of each id list as a further column ``out``.

    Control ids have no text, the unknown id has its mark, byte ids that make no character become U+FFFD each; a null or
    empty list is an empty text; ids must be those of the model, none null.
    """

    def texts_of(lists: pa.Array) -> pa.Array:
        model = _model(model_path)
        lists = lists.fill_null([]) if lists.null_count else lists
        offsets = lists.offsets.to_numpy().astype(np.int64)
        flat = lists.values.to_numpy()
        parts = [pa.array([], pa.large_string())]
        for i, j in row_runs(offsets, 1 << 18):
            a, b = int(offsets[i]), int(offsets[j])
            parts.append(model.decode(flat[a:b], offsets[i : j + 1] - a))
        return pa.concat_arrays(parts).cast(pa.string())

    return df.withColumn(out, F.arrow_udf(texts_of, "string")(F.col(ids_col)))


def digests(docs: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256 (of the decimal ids, joined by commas) and decoded_sha256, both in hex."""
    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    done = decode(encode(slim, model_path).drop("text"), model_path)
    return done.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
