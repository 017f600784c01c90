"""Whole texts to ids by a public byte-level BPE tokenizer, each distinct piece once.

Byte-level BPE splits a text before it merges, and never merges over a single space between two characters that
are not white space, nor from an ASCII letter to ASCII punctuation (but an apostrophe, which may begin a contraction) or to a line
feed, nor from a single line feed after no white space to a letter. So a text is cut there, distinct pieces go to the tokenizers library, and
their ids are put together; a text with a space that is not safe to cut at goes to the library whole. Pieces are found
again by a 64-bit hash, their first eight bytes and their length. When the memo holds `most` pieces, only those used
again stay, which bounds a worker's memory.
"""

from __future__ import annotations

import os
import sys
import threading
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import chain
from types import ModuleType

import numpy as np


LETTER, SPACE, SIGN = (np.zeros(256, bool) for _ in range(3))
LETTER[[*range(65, 91), *range(97, 123)]] = SPACE[[*range(9, 14), 32]] = True
SIGN[[10, *(x for x in range(33, 127) if not chr(x).isalnum() and chr(x) != "'")]] = True  # a letter before these can be cut from them
STATE = "pitchside_worker_state"  # a module of the worker's, as functions travel by value and bring their own globals


@contextmanager
def tokenizer(path: str, idle: float = 4.0) -> Iterator[MemoTokenizer]:
    """The one that this process already has, with what it has learnt, or a new one. It is let go when no task has
    used it for so many seconds, as the process may serve other stages for long."""
    kept = sys.modules.setdefault(STATE, ModuleType(STATE)).__dict__.setdefault("memos", {})
    memo, timer = kept.pop(path, (None, None))
    if timer is not None:
        timer.cancel()
    memo = memo or MemoTokenizer(path)
    yield memo
    timer = threading.Timer(idle, kept.pop, (path, None))
    timer.daemon = True
    kept[path] = memo, timer
    timer.start()


def hashes(data: np.ndarray, starts: np.ndarray, long: np.ndarray, salt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each slice of the bytes with its salt, and its first eight bytes. data: with eight bytes more than the slices reach."""
    words = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    out = (long.astype(np.uint64) << np.uint64(2) | salt.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    first = np.zeros(len(starts), np.uint64)
    live, at = np.flatnonzero(long > 0), 0
    while len(live):
        left = np.minimum(long[live] - at, 8).astype(np.uint64)
        word = words[starts[live] + at] & (~np.uint64(0) >> (np.uint64(64) - np.uint64(8) * left))
        if at == 0:
            first[live] = word
        h = (out[live] ^ word) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ h >> np.uint64(29)) * np.uint64(0x94D049BB133111EB)
        out[live] = h ^ h >> np.uint64(32)
        at += 8
        live = live[long[live] > at]
    return out, first


class Grown:
    """An array that grows in place; `all` is what it holds."""

    def __init__(self, kind: type):
        self.room, self.n = np.zeros(1024, kind), 0

    @property
    def all(self) -> np.ndarray:
        return self.room[: self.n]

    def add(self, more: np.ndarray) -> None:
        if self.n + len(more) > len(self.room):
            self.room = np.concatenate([self.all, np.zeros(len(more) + self.n // 4, self.room.dtype)])
        self.room[self.n : self.n + len(more)] = more
        self.n += len(more)

    def set(self, to: np.ndarray) -> None:
        self.room, self.n = to.astype(self.room.dtype), len(to)


class MemoTokenizer:
    def __init__(self, path: str, most: int = 2_500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True  # such strings in a text are ordinary text
        if hasattr(self.model.model, "_resize_cache"):
            self.model.model._resize_cache(0)  # the memo stands before it
        self.feed = self.model.token_to_id("Ċ")  # a line feed, as byte-level vocabularies write it
        self.most = most
        self.keys, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int32)  # hashes in order, and whose they are
        # of each piece: its first bytes, its shape (length and how it is cut), its uses, if it is unsafe, where its ids end
        self.first, self.shape, self.uses, self.unsafe = Grown(np.uint64), Grown(np.uint32), Grown(np.int32), Grown(bool)
        self.starts, self.ids = Grown(np.int64), Grown(np.uint16)
        self.starts.add(np.zeros(1, np.int64))

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for i in range(0, len(texts), 4096) for e in self.model.encode_batch_fast(texts[i : i + 4096], add_special_tokens=False)]

    def learn(self, pieces: list[str], cuts: list[int]) -> None:
        """Ids of new pieces, which come without the space before them. cuts: 1 where a piece has no space before it, 2 where none follows."""
        odd = [not x or not cut & 2 and x[-1].isspace() or not cut & 1 and x[0].isspace() for x, cut in zip(pieces, cuts, strict=True)]
        pieces = [x if cut & 1 else " " + x for x, cut in zip(pieces, cuts, strict=True)]
        # many pieces at a time, parted by a line feed, which is an id of its own between them
        alone = [k for k, x in enumerate(pieces) if odd[k] or "\n" in x or not x]
        parted = np.ones(len(pieces), bool)
        parted[alone] = False
        rest = [pieces[k] for k in np.flatnonzero(parted)]
        joined = self.whole(["\n".join(rest[i : i + 256]) for i in range(0, len(rest), 256)])
        ids = np.fromiter(chain.from_iterable(x + [self.feed] for x in joined), np.uint16)
        stops = np.flatnonzero(ids == self.feed)
        long = np.zeros(len(pieces), np.int64)
        long[parted] = np.diff(stops, prepend=-1) - 1
        ids = np.delete(ids, stops)
        own = self.whole([pieces[k] for k in alone])
        long[alone] = list(map(len, own))
        if alone:
            at = np.cumsum(long) - long
            out = np.empty(int(long.sum()), np.uint16)
            free = np.ones(len(out), bool)
            for k, x in zip(alone, own, strict=True):
                out[at[k] : at[k] + len(x)] = x
                free[at[k] : at[k] + len(x)] = False
            out[free] = ids
            ids = out
        self.ids.add(ids)
        self.starts.add(self.starts.all[-1] + np.cumsum(long))
        self.uses.add(np.zeros(len(pieces), np.int32))
        self.unsafe.add(np.array(odd, bool))

    def forget(self, least: int) -> None:
        """Keeps the pieces used at least so often, and halves their counts."""
        keep = self.uses.all >= least
        long = np.diff(self.starts.all)
        self.ids.set(self.ids.all[np.repeat(keep, long)])
        self.starts.set(np.concatenate([[0], np.cumsum(long[keep])]))
        stay = keep[self.numbers]
        self.keys, self.numbers = self.keys[stay], (np.cumsum(keep, dtype=np.int32) - 1)[self.numbers[stay]]
        for x in (self.first, self.shape, self.unsafe):
            x.set(x.all[keep])
        self.uses.set(self.uses.all[keep] // 2)

    def encode(self, texts: list[str | None], end: int) -> tuple[np.ndarray, np.ndarray]:
        """ids (uint16, each text's followed by `end`) and each text's number of ids."""
        least = 2
        while len(self.keys) > self.most:
            self.forget(least)
            least *= 2
        full = [k for k, x in enumerate(texts) if x]
        raw = [texts[k].encode() for k in full]
        buffer = b" ".join(raw) + b" " * 8
        data = np.frombuffer(buffer, np.uint8)
        size = max(0, len(buffer) - 8)
        begin = np.cumsum([0, *(len(x) + 1 for x in raw)])[:-1] if raw else np.zeros(0, np.int64)
        starts = stops = counts = np.zeros(0, np.int64)
        cuts = np.zeros(0, np.uint8)
        if raw:
            letter, sign, feed = LETTER.take(data[:size]), SIGN.take(data[:size]), data[:size] == 10
            cut = np.zeros(size + 1, bool)
            cut[1:size] = letter[:-1] & sign[1:]
            cut[2:size] |= feed[1:-1] & letter[2:] & ~SPACE.take(data[: max(0, size - 2)])
            cut[begin] = False
            space = data[:size] == 32
            stops = np.append(np.flatnonzero(space | cut[:size]), size)
            inner = cut[stops]
            starts = np.concatenate([[0], stops[:-1] + ~inner[:-1]])
            cuts = inner.astype(np.uint8) << 1
            cuts[1:] |= inner[:-1]
        heads = np.searchsorted(starts, begin)
        cuts[heads] |= 1
        counts = np.zeros(len(texts), np.int64)
        counts[full] = np.diff(np.append(heads, len(starts)))
        size = stops - starts
        keys, first = hashes(data, starts, size, cuts)
        shape = (size << 2 | cuts).astype(np.uint32)
        # each distinct key once, in order
        order = np.argsort(keys)
        ranked = keys[order]
        new = np.ones(len(ranked), bool)
        new[1:] = ranked[1:] != ranked[:-1]
        group = np.empty(len(keys), np.int64)
        group[order] = np.cumsum(new) - 1
        ranked, some = ranked[new], order[new]
        place = np.searchsorted(self.keys, ranked)
        known = np.zeros(len(ranked), bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == ranked[inside]
        number = np.zeros(len(ranked), np.int32)
        number[known] = self.numbers[place[known]]
        if not known.all():
            fresh = some[~known]
            number[~known] = np.arange(len(self.first.all), len(self.first.all) + len(fresh))
            pieces = [buffer[a:b].decode() for a, b in zip(starts[fresh].tolist(), stops[fresh].tolist(), strict=True)]
            self.learn(pieces, cuts[fresh].tolist())
            self.first.add(first[fresh])
            self.shape.add(shape[fresh])
            self.keys = np.insert(self.keys, place[~known], ranked[~known])
            self.numbers = np.insert(self.numbers, place[~known], number[~known])
        at = number[group]
        self.uses.all[number] += np.bincount(group, minlength=len(number)).astype(np.int32)
        ends = np.cumsum(counts)
        begins = self.starts.all.take(at)
        long = self.starts.all[1:].take(at) - begins
        other = (self.first.all.take(at) != first) | (self.shape.all.take(at) != shape)  # another piece of the same hash
        bad = np.concatenate([[0], np.cumsum(self.unsafe.all.take(at))])
        wrong = np.concatenate([[0], np.cumsum(other)])
        direct = np.flatnonzero(((bad[ends] > bad[ends - counts]) & (counts > 1)) | (wrong[ends] > wrong[ends - counts])).tolist()
        for k in direct:
            long[ends[k] - counts[k] : ends[k]] = 0
        total = np.concatenate([[0], np.cumsum(long)])
        n_ids = total[ends] - total[ends - counts] + 1
        given = [np.array(x, np.uint16) for x in self.whole([texts[k] for k in direct])]
        for k, x in zip(direct, given, strict=True):
            n_ids[k] = len(x) + 1
        out = np.empty(int(n_ids.sum()), np.uint16)
        tails = np.cumsum(n_ids) - 1
        body = np.ones(len(out), bool)
        body[tails] = False
        out[tails] = end
        for k, x in zip(direct, given, strict=True):
            out[tails[k] - len(x) : tails[k]] = x
            body[tails[k] - len(x) : tails[k]] = False
        out[body] = self.ids.all.take(np.repeat(begins - total[:-1], long) + np.arange(total[-1]))
        return out, n_ids
