"""Token ids of whole texts with the tokenizers library, encoding each distinct piece of text once.

A text is cut before every single space that is followed by a character which is surely no white space and begins no
special token (``<|``). Both public vocabularies split there anyway, so the ids (and offsets) of a text are those of its
pieces in turn; the tests compare them with the library on whole texts. The string of a special token gives its id, as in
the library. Pieces repeat so much that the library sees a few hundredths of the text.
Pieces are recognised by 64-bit hashes, kept per worker process up to ``KEEP`` pieces and then forgotten. What is kept
grows in place and in few indexes, so that a chunk costs what its own new pieces cost, however many are known.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pandas as pd

from tidemark.llm.wordhash import _BASE, _BYTE_CODE, _INVERSE, _IS_SPACE, _powers, buffer_of, chunks, mix

KEEP = 1_500_000
CHUNK = 1 << 20  # a worker over 41 MB of text peaks at 340 MB with this and at 632 with four times as much
_JOIN_BYTES = 1 << 9
_SURE = ~_IS_SPACE.copy()
_SURE[[0xC2, 0xE1, 0xE2, 0xE3]] = False  # first bytes of white space beyond ASCII
_ENCODERS: dict[tuple[str, bool], "Encoder"] = {}


def encoder_for(path: str, offsets: bool = False) -> "Encoder":
    """One encoder per process, vocabulary file and kind."""
    if (path, offsets) not in _ENCODERS:
        _ENCODERS[path, offsets] = Encoder(path, offsets)
    return _ENCODERS[path, offsets]


def drop_encoder(path: str, offsets: bool = False) -> None:
    """Keep neither the vocabulary nor the pieces in this process: it may go on to other work."""
    _ENCODERS.pop((path, offsets), None)


class _Grown:
    """An array that is appended to, in room that doubles."""

    def __init__(self, empty: np.ndarray):
        self.room, self.used = empty, 0

    def add(self, *more: np.ndarray) -> None:
        need = self.used + sum(map(len, more))
        if need > len(self.room):
            room = np.empty((max(need, 2 * len(self.room)), *self.room.shape[1:]), self.room.dtype)
            room[: self.used] = self.all
            self.room = room
        for own in more:
            self.room[self.used: self.used + len(own)] = own
            self.used += len(own)

    @property
    def all(self) -> np.ndarray:
        return self.room[: self.used]


class Encoder:
    def __init__(self, path: str, offsets: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.plain = Tokenizer.from_file(path)
        special = self.plain.get_added_tokens_decoder()
        self.mark_id, self.mark = next((i, t.content) for i, t in sorted(special.items()))
        self.offsets = offsets
        self.forget()

    def forget(self) -> None:
        self.known: list[pd.Index] = []  # hashes in the order they came, each index less than half as long as the one before
        self.at, self.count = _Grown(np.zeros(0, np.int64)), _Grown(np.zeros(0, np.int32))
        self.ids = _Grown(np.zeros(0, np.int32))
        self.spans = _Grown(np.zeros((0, 2), np.int32))

    def _places(self, hashes: np.ndarray) -> np.ndarray:
        """Where distinct pieces stand among the known ones, -1 if they are new."""
        places, open_, begin = np.full(len(hashes), -1, np.int64), np.arange(len(hashes)), 0
        for index in self.known:
            own = index.get_indexer(hashes[open_])
            found = own >= 0
            places[open_[found]] = own[found] + begin
            open_, begin = open_[~found], begin + len(index)
        return places

    def _know(self, hashes: np.ndarray) -> None:
        while self.known and 2 * len(hashes) >= len(self.known[-1]):
            hashes = np.concatenate([self.known.pop().to_numpy(), hashes])
        self.known.append(pd.Index(hashes))

    def _learn(self, hashes: np.ndarray, pieces: list[bytes]) -> None:
        """Encode new pieces, many joined by a special token at a time; those that may hold one themselves go alone."""
        counts, ids, spans = np.zeros(len(pieces), np.int64), [], []
        odd = [i for i, p in enumerate(pieces) if b"<|" in p]
        plain = [i for i, p in enumerate(pieces) if b"<|" not in p] if odd else range(len(pieces))
        order = np.array([*plain, *odd], np.int64)
        joined = [pieces[i] for i in plain] if odd else pieces
        group = np.cumsum(np.fromiter(map(len, joined), np.int64, len(joined))) // _JOIN_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(joined)]
        mark = self.mark.encode()
        texts = [mark.join(joined[a:b]).decode() for a, b in zip(cuts, cuts[1:]) if a < b]
        batch = self.plain.encode_batch if self.offsets else self.plain.encode_batch_fast
        done = 0
        for k, got in enumerate(batch(texts, add_special_tokens=False)):
            own = np.array(got.ids, np.int32)
            stops = np.flatnonzero(own == self.mark_id)
            edges = np.concatenate([[-1], stops, [len(own)]])
            counts[order[done: done + len(edges) - 1]] = np.diff(edges) - 1
            keep = np.ones(len(own), bool)
            keep[stops] = False
            ids.append(own[keep])
            if self.offsets:
                place = np.array(got.offsets, np.int32).reshape(-1, 2)
                begin = np.concatenate([[0], place[stops, 1]]).astype(np.int32)
                spans.append(place[keep] - np.repeat(begin, np.diff(edges) - 1)[:, None])
            done += len(edges) - 1
        for i in odd:
            got = self.plain.encode(pieces[i].decode(), add_special_tokens=False)
            counts[i] = len(got.ids)
            ids.append(np.array(got.ids, np.int32))
            if self.offsets:
                spans.append(np.array(got.offsets, np.int32).reshape(-1, 2))
        at = np.zeros(len(pieces), np.int64)
        at[order] = np.cumsum(counts[order]) - counts[order] + self.ids.used
        self._know(hashes)
        self.at.add(at)
        self.count.add(counts)
        self.ids.add(*ids)
        if self.offsets:
            self.spans.add(*spans)

    def encode(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        """Ids of all texts of a buffer in turn, where each text's begin (total at the end), and the begin and end of
        each token in characters of its text if the encoder has offsets."""
        n = len(data)
        if not n:
            return np.zeros(0, np.int32), np.zeros(len(starts), np.int64), np.zeros((0, 2), np.int64)
        cut = np.zeros(n + 1, bool)
        cut[: n - 1] = (data[:-1] == 0x20) & _SURE[data[1:]]
        # white space before a special token, or at a text's end, belongs together: the library splits behind all of it
        cut[: max(n - 2, 0)] &= ~((data[1:-1] == 0x3C) & (data[2:] == 0x7C))
        cut[starts[1:] - 1] = False
        cut[starts] = True
        edges = np.flatnonzero(cut[:n])
        ends = np.append(edges[1:], n)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE_CODE[data] * _powers(_BASE, n)[:n], out=total[1:])
        hashes = mix((total[ends] - total[edges]) * _powers(_INVERSE, n)[edges] + (ends - edges).astype(np.uint64))
        codes, distinct = pd.factorize(hashes)
        if self.at.used > KEEP:
            self.forget()
        place = self._places(distinct)
        new = np.flatnonzero(place < 0)
        if len(new):
            first = np.full(len(distinct), -1, np.int64)
            first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
            raw = data.tobytes()
            place[new] = self.at.used + np.arange(len(new))
            self._learn(distinct[new], [raw[a:b] for a, b in zip(edges[first[new]].tolist(), ends[first[new]].tolist())])
        own = place[codes]
        count = self.count.all[own].astype(np.int64)
        upto = np.zeros(len(own) + 1, np.int64)
        np.cumsum(count, out=upto[1:])
        index = np.arange(upto[-1]) + np.repeat(self.at.all[own] - upto[:-1], count)
        where = upto[np.searchsorted(edges, starts)]
        spans = None
        if self.offsets:
            chars = np.zeros(n + 1, np.int64)
            np.cumsum((data & 0xC0) != 0x80, out=chars[1:])
            text = np.searchsorted(starts, edges, side="right") - 1
            spans = self.spans.all[index] + np.repeat(chars[edges] - chars[starts[text]], count)[:, None]
        return self.ids.all[index], where, spans

    def each(self, texts: pd.Series, limit: int = CHUNK) -> Iterator[tuple]:
        """(first text, end text, ids, where, spans) of a batch of texts, a bounded number of bytes at a time."""
        data, starts = buffer_of(texts)
        for begin, end in chunks(data, starts, limit):
            own = starts[begin: end + 1] - starts[begin]
            yield begin, end, *self.encode(data[starts[begin]: starts[end]], own)
