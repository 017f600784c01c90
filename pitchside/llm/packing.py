"""Packing of documents into training sequences with minimum bin slack.

A document longer than the capacity gives full sequences first; what is left of each document is an item. For each
sequence the longest item is the seed, and a subset-sum bitset over the multiset of the other lengths finds the sum
closest to the room left; going back through the bitsets gives how often each length is used. A set of lengths is
used as often as its counts allow. Where no subset fills the room, the longest item left is cut. Each input
partition packs its own items, so nothing is shuffled and memory holds a bounded pool of items; only the last
tokens of a partition can leave room, and they are dealt to sequences whose lengths are powers of two.

Defined cases: a null or empty text is a document of the end id alone; repeated rows are packed each for itself; a
null doc_id stays null; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .shared import small
from .tokens import MemoTokenizer
from .tokens import tokenizer as shared_tokenizer

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def closest(counts: list[tuple[int, int]], room: int) -> dict[int, int]:
    """How often to use each length, so that the sum is the largest up to `room`. counts: (length, how many), longest first."""
    reach, mask, steps = 1, (1 << room + 1) - 1, []
    for length, many in counts:
        if length > room:
            continue
        many, times = min(many, room // length), 1
        while many:
            times = min(times, many)
            steps.append((length, times, reach))
            reach |= (reach << length * times) & mask
            many -= times
            times *= 2
        if reach >> room:
            break
    left, used = reach.bit_length() - 1, {}
    for length, times, before in reversed(steps):
        if not before >> left & 1:
            used[length] = used.get(length, 0) + times
            left -= length * times
    return used


class Packer:
    """Items are (payload, start, length); `take` gives sequences as lists of them."""

    def __init__(self, capacity: int):
        self.capacity, self.pool, self.lengths, self.held = capacity, {}, [], 0

    def add(self, payload: object, start: int, length: int) -> None:
        if length not in self.pool:
            self.pool[length] = []
            insort(self.lengths, length)
        self.pool[length].append((payload, start, length))
        self.held += 1

    def pop(self, length: int) -> tuple:
        items = self.pool[length]
        item = items.pop()
        self.held -= 1
        if not items:
            del self.pool[length]
            self.lengths.pop(bisect_right(self.lengths, length) - 1)
        return item

    def take(self, least: int) -> Iterator[list[tuple]]:
        """Full sequences, as long as more than `least` items are held; at last what is left, in powers of two."""
        while self.held > least:
            seed = self.lengths[-1]
            room = self.capacity - seed
            counts = [(x, len(self.pool[x]) - (x == seed)) for x in self.lengths[bisect_right(self.lengths, room) - 1 :: -1]] if self.lengths[0] <= room else []
            use = closest(counts, room)
            fill = seed + sum(x * n for x, n in use.items())
            use[seed] = use.get(seed, 0) + 1
            if fill == self.capacity:
                for _ in range(max(1, min(len(self.pool[x]) // n for x, n in use.items()))):
                    yield [self.pop(x) for x, n in use.items() for _ in range(n)]
                continue
            out = [self.pop(x) for x, n in use.items() for _ in range(n)]
            if self.lengths:  # longer than the room, or it would have been used
                payload, start, length = self.pop(self.lengths[-1])
                need = self.capacity - fill
                out.append((payload, start, need))
                self.add(payload, start + need, length - need)
                yield out
                continue
            while out:  # the partition's last tokens
                size, now = 1 << sum(x[2] for x in out).bit_length() - 1, []
                while size:
                    payload, start, length = out.pop()
                    now.append((payload, start, min(length, size)))
                    if length > size:
                        out.append((payload, start + size, length - size))
                    size -= now[-1][2]
                yield now


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 1024, end: int = 0, wave: int = 4096, with_ids: bool = False) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset; and with `with_ids` the
    piece's ids as binary (little-endian unsigned 32-bit). `wave` items are gathered before sequences are filled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with shared_tokenizer(tokenizer) as model:
            yield from packed(batches, model)

    def packed(batches: Iterator[pa.RecordBatch], model: MemoTokenizer) -> Iterator[pa.RecordBatch]:
        packer = Packer(capacity)
        sequence = TaskContext.get().partitionId() << 32
        rows: list[tuple] = []

        def put(items: list[tuple]) -> None:
            nonlocal sequence
            offset = 0
            for (doc_id, base, buffer, total), start, length in items:
                part = buffer[4 * (start - base) : 4 * (start - base + length)]
                rows.append((doc_id, start, length, zlib.crc32(part), total, sequence, offset, bytes(part) if with_ids else None))
                offset += length
            sequence += 1

        def out() -> pa.RecordBatch:
            columns = [pa.array(x, pa.binary() if k == 7 else pa.int64()) for k, x in enumerate(list(zip(*rows, strict=True))[: 7 + with_ids])]
            rows.clear()
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"][: 7 + with_ids])

        for batch in small(batches, 4 << 20):
            ids, counts = model.encode(batch.column(1).to_pylist(), end)
            buffer, at = memoryview(ids.astype("<u4").tobytes()), 0
            for doc_id, total in zip(batch.column(0).to_pylist(), counts.tolist(), strict=True):
                full = total - total % capacity
                own = buffer[4 * at : 4 * (at + full)]
                for start in range(0, full, capacity):
                    put([((doc_id, 0, own, total), start, capacity)])
                if full < total:
                    packer.add((doc_id, full, bytes(buffer[4 * (at + full) : 4 * (at + total)]), total), full, total - full)
                at += total
                if packer.held > 2 * wave:
                    for items in packer.take(wave):
                        put(items)
                if len(rows) > 20_000:
                    yield out()
        for items in packer.take(0):
            put(items)
        if rows:
            yield out()

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA + ", ids binary" * with_ids)
