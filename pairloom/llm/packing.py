"""Order-preserving packing of token sequences by dynamic programming."""

from __future__ import annotations

import os
import re
import sys
import types
import unicodedata
import zlib
from collections import deque
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import BYTE_VALUE, CLOSING, WHITE, row_runs, text_view
from .runs import Column, HashIndex, run_spans, span_hashes

LENGTH = 2048
END_ID = 1
#: Cost of a cut in padding tokens: between documents, between sentences, inside a sentence.
DOCUMENT, SENTENCE, INSIDE = 0, 2, 48
#: Tokens packed at once; a longer document is packed whole.
SEGMENT = 1 << 20
#: Distinct words that a worker process remembers.
_CACHE_WORDS = 1_000_000


def _encoder(path: str, end_id: int) -> WordEncoder:
    """One encoder for each worker process: its table serves all tasks that run there."""
    held = sys.modules.setdefault("_word_encoders", types.ModuleType("_word_encoders")).__dict__
    if (path, end_id) not in held:
        held[path, end_id] = WordEncoder(path, end_id)
    return held[path, end_id]


class WordEncoder:
    """Token ids of texts by a tokenizer that never joins words over white space.

    A word's closing marks are a part of their own to the tokenizer if what is before them is plain letters. Every distinct part is
    encoded once and looked up afterwards by a 64-bit hash of its bytes; the table is emptied
    when it is full. Number 0 stands for the end of a document.
    """

    def __init__(self, path: str, end_id: int = END_ID):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.end_id = Tokenizer.from_file(path), end_id
        self._clear()

    def _clear(self) -> None:
        self.known = HashIndex()
        self.flat, self.plain, self.lengths, self.first = (Column(t) for t in (np.uint32, bool, np.int64, np.int64))
        self._add(np.zeros(1, np.uint64), [[self.end_id]], np.zeros(1, bool))

    def _add(self, hashes: np.ndarray, ids: list[list[int]], plain: np.ndarray) -> None:
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        self.known.add(hashes)
        self.plain.extend(plain)
        self.first.extend(len(self.flat) + np.cumsum(lengths) - lengths)
        self.lengths.extend(lengths)
        self.flat.extend(np.fromiter(chain.from_iterable(ids), np.uint32))

    def _encode_letters(self, words: list[str]) -> list[list[int]]:
        """Each word is plain letters, so one part to the tokenizer: many are encoded as one line."""
        out: list[list[int]] = []
        for k in range(0, len(words), 2000):
            chunk = words[k : k + 2000]
            got = self.tokenizer.encode(" ".join(chunk), add_special_tokens=False)
            ends = np.searchsorted(np.array(got.word_ids, np.int64), np.arange(len(chunk) + 1)).tolist()
            ids = got.ids
            out += [ids[a:b] for a, b in zip(ends, ends[1:])]
        return out

    def _learn(self, hashes: np.ndarray, parts: list[bytes]) -> None:
        texts = [p.decode("utf-8") for p in parts]
        plain = np.fromiter((PLAIN_WORD.fullmatch(t) is not None for t in texts), bool, len(texts))
        ids: list[list[int]] = [[]] * len(texts)
        letters, rest = np.flatnonzero(plain).tolist(), np.flatnonzero(~plain).tolist()
        for k, own in zip(letters, self._encode_letters([texts[k] for k in letters])):
            ids[k] = own
        for k, own in zip(rest, self.tokenizer.encode_batch_fast([texts[k] for k in rest], add_special_tokens=False)):
            ids[k] = own.ids
        self._add(hashes, ids, plain)

    def _numbers(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Numbers of the parts data[starts:ends], ascending spans; parts that are new are learned."""
        if not len(starts):
            return np.zeros(0, np.int64)
        distinct, where, own = np.unique(span_hashes(data, starts, ends, BYTE_VALUE), return_index=True, return_inverse=True)
        number = self.known.find(distinct)
        new = np.flatnonzero(number < 0)
        if len(new):
            lo = int(starts[0])
            raw = data[lo : int(ends[-1])].tobytes()
            self._learn(distinct[new], [raw[x:y] for x, y in zip((starts[where[new]] - lo).tolist(), (ends[where[new]] - lo).tolist())])
            number[new] = np.arange(len(self.known) - len(new), len(self.known))
        return number[own]

    def _words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each word the numbers of its first part and of the closing marks behind it (-1 if they belong to the first part)."""
        lo, hi = int(starts[0]), int(ends[-1])
        other = np.flatnonzero(~CLOSING[data[lo:hi]])
        last = np.searchsorted(other, ends - lo) - 1  # the last byte of each word that is no closing mark
        core = np.where((last >= 0) & (other[np.maximum(last, 0)] >= starts - lo), other[np.maximum(last, 0)] + lo + 1, ends) if len(other) else ends
        first = self._numbers(data, starts, core)
        whole = (core < ends) & ~self.plain.values[first]
        first[whole] = self._numbers(data, starts[whole], ends[whole])
        marks = np.flatnonzero((core < ends) & ~whole)
        second = np.full(len(starts), -1)
        second[marks] = self._numbers(data, core[marks], ends[marks])
        return first, second

    def encode_rows(self, data: np.ndarray, offsets: np.ndarray, i: int, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of rows i..j-1, each followed by the end id; the position after each word; the kind of a cut there."""
        if len(self.known) > _CACHE_WORDS:
            self._clear()
        pieces = [(*self._words(data, starts, ends), data[ends - 1], row) for starts, ends, row in run_spans(data, offsets, i, j, ~WHITE) if len(starts)]
        none = np.zeros(0, np.int64)
        first, second, closing, row = (np.concatenate(c) for c in zip(*pieces)) if pieces else (none, none, none.astype(np.uint8), none)
        # two places for each word and one for the end of each document, in order
        place = 2 * np.arange(len(first)) + row
        code = np.full(2 * len(first) + j - i, 0, np.int64)
        code[place], code[place + 1] = first, second
        lengths = np.where(code >= 0, self.lengths.values[code], 0)
        after = np.cumsum(lengths)
        index = np.repeat(self.first.values[code] - (after - lengths), lengths) + np.arange(int(after[-1]) if len(after) else 0)
        kind = np.full(len(code), DOCUMENT)
        kind[place + 1] = np.where(SENTENCE_END[closing], SENTENCE, INSIDE)
        ends = np.ones(len(code), bool)
        ends[place] = False
        return self.flat.values[index], after[ends], kind[ends]

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``encode_rows`` of texts given one by one."""
        data = np.frombuffer(b"".join(texts), np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        return self.encode_rows(data, offsets, 0, len(texts))


def _plain_letters() -> str:
    """Letters that stay one letter, and start no combination, under the normal form and lower case: those of
    Latin, Greek and Cyrillic in one piece. No mark that combines is among them, so a run of them stays letters."""
    return "".join(
        c for c in map(chr, range(0x41, 0x530)) if c.isalpha() and len(c.lower()) == 1 and c.lower().isalpha() and unicodedata.normalize("NFC", c) == c and unicodedata.category(c) in ("Lu", "Ll")
    )


PLAIN_WORD = re.compile(f"[{_plain_letters()}]+")
SENTENCE_END = np.zeros(256, bool)
SENTENCE_END[list(b".!?")] = True


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


def cut_points(total: int, at: np.ndarray, cost: np.ndarray, length: int = LENGTH, inside: int = INSIDE) -> np.ndarray:
    """Ends of the windows of at most ``length`` tokens that cover ``total`` tokens at the least cost.

    ``at`` (ascending) holds the positions after words with their cut ``cost``; cuts are weighed at those below
    ``inside``, at every quarter window where these are far apart, and anywhere in the last window. A window costs its
    padding to ``length``, none if its size is a power of two, and the cost of the cut at its end.
    best(j) = cost(j) + length - c(j) + min over i of best(i) + c(i): a minimum over a sliding range
    of positions, kept in a monotone queue; powers of two are tried besides.
    """
    if total == 0:
        return np.zeros(0, np.int64)
    good = cost < inside
    marks = _distinct(np.concatenate([[0], at[good], [total]]))
    wide = np.flatnonzero(np.diff(marks) > length // 4)
    extra = [np.arange(marks[k], marks[k + 1], length // 4) for k in wide]
    tail = np.arange(max(0, total - length), total)
    places = _distinct(np.concatenate([marks, *extra, tail]))
    price = np.full(len(places), inside, np.int64)
    price[np.searchsorted(places, at[good])] = cost[good]
    price[-1] = 0
    # where a window of a power of two could begin, for each place: small powers only in the last window
    powers = [1 << k for k in range(length.bit_length()) if 1 << k <= length]
    late = int(np.searchsorted(places, total - length, "right"))
    ends_of, begins = [], []
    for p in powers:
        j = np.arange(0 if p >= length // 8 else late, len(places))
        k = np.minimum(np.searchsorted(places, places[j] - p), len(places) - 1)
        hit = places[k] == places[j] - p
        ends_of.append(j[hit])
        begins.append(k[hit])
    ends_of, begins = np.concatenate(ends_of), np.concatenate(begins)
    order = np.argsort(ends_of, kind="stable")
    ends_of, begins = [*ends_of[order].tolist(), -1], begins[order].tolist()
    place, price = places.tolist(), price.tolist()
    best, back = [0] * len(place), [0] * len(place)
    queue: deque[tuple[int, int]] = deque()
    h = 0
    while ends_of[h] == 0:
        h += 1
    for j in range(1, len(place)):
        c = place[j]
        value = best[j - 1] + place[j - 1]
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, j - 1))
        while place[queue[0][1]] < c - length:
            queue.popleft()
        cheapest, i = queue[0]
        cheapest += length - c
        while ends_of[h] == j:
            k = begins[h]
            if best[k] < cheapest:
                cheapest, i = best[k], k
            h += 1
        best[j], back[j] = cheapest + price[j], i
    ends, j = [], len(place) - 1
    while j > 0:
        ends.append(place[j])
        j = back[j]
    return np.array(ends[::-1], np.int64)


_COLUMNS = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_tokens")


def pack(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """Pieces of documents in training sequences of at most ``length`` tokens.

    Per piece: doc_id, start (tokens of its document before it), length, ids_crc32 (of its ids as
    little-endian unsigned 32-bit), doc_tokens (with the end id), sequence_id, offset (in the sequence,
    without gaps from 0) and sequence_tokens (tokens of the sequence). A sequence is padded to ``length``
    unless its size is a power of two.

    Documents are packed in the order in which the input partitions give them: no shuffle; each task packs its documents in
    segments of about SEGMENT tokens, cutting between documents or sentences where that costs little padding.
    A null, empty or blank text is its end id alone; repeated rows are packed each; doc_id may be null.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path, end_id)
        held: list = []
        tokens, sequence = 0, TaskContext.get().partitionId() << 33
        for batch in batches:
            data, offsets = text_view(batch.column(1))
            for i, j in row_runs(offsets):
                held.append((batch.column(0).slice(i, j - i), *encoder.encode_rows(data, offsets, i, j)))
                tokens += len(held[-1][1])
                if tokens >= SEGMENT:
                    out, sequence = _pieces(held, sequence, length)
                    yield out
                    held, tokens = [], 0
        if held:
            yield _pieces(held, sequence, length)[0]

    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(scan, "doc_id bigint, " + ", ".join(f"{c} bigint" for c in _COLUMNS))


def _pieces(held: list, sequence: int, length: int) -> tuple[pa.RecordBatch, int]:
    doc_ids = pa.concat_arrays([h[0] for h in held])
    ids = np.concatenate([h[1] for h in held])
    shift = np.cumsum([0] + [len(h[1]) for h in held])
    at = np.concatenate([h[2] + s for h, s in zip(held, shift)])
    kind = np.concatenate([h[3] for h in held])
    doc_end = at[kind == DOCUMENT]
    ends = cut_points(len(ids), at, kind, length)
    cuts = _distinct(np.concatenate([doc_end, ends]))
    begin = np.concatenate([[0], cuts[:-1]])
    doc, seq = np.searchsorted(doc_end, begin, "right"), np.searchsorted(ends, begin, "right")
    doc_start, seq_start = np.concatenate([[0], doc_end]), np.concatenate([[0], ends])
    raw = memoryview(ids.astype("<u4").tobytes())
    crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begin.tolist(), cuts.tolist())]
    columns = [begin - doc_start[doc], cuts - begin, np.array(crc, np.int64), np.diff(doc_start)[doc], sequence + seq, begin - seq_start[seq], np.diff(seq_start)[seq]]
    batch = pa.RecordBatch.from_arrays([doc_ids.take(pa.array(doc)), *(pa.array(c, pa.int64()) for c in columns)], ["doc_id", *_COLUMNS])
    return batch, sequence + len(ends)
