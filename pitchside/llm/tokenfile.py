"""Token-id files, coded by an adaptive context-mixing range coder.

The ids of all documents, in order of doc_id, are cut into blocks that are coded for themselves: each starts with empty
prediction tables and weights and has checksums of its ids and of its bytes. For each id, those that last followed its two
and its one predecessors in the block (orders 2 and 1) are predicted, and the surer of them is the candidate. Three
estimates of whether it comes true, by how sure order 2 is, by how sure order 1 is, and by how common the candidate is (order 0), are
mixed in the logistic domain; what they weigh is learnt as it goes. The mixed probability drives the range coder. Another id is coded by its order-0
class, a group of ids about as common as each other, given the class of the id before, and by its place in the class. Classes and their frequencies are
counted over the file and stand in its head.

Coder and model run side by side over the blocks of a file, one id of every block at a time, in integer arithmetic. What the
model learns from `CHUNK` ids it takes over at their end, so that an encoder, which knows the ids, predicts them together.

Defined cases: a null or empty text is the end id alone; a null doc_id comes first and stays null; repeated rows are
documents of their own; rows that share an id come in the order of their texts' hashes; an empty table gives no files and no
rows. Ids are below 65,536. Rows that are equal throughout are told apart by their place in the input, which should be a table.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import filesystem, materialise, partitions, shared_dir, small, write_file
from .tokens import tokenizer as shared_tokenizer

MAGIC = b"PSIDS2\0\0"
BLOCK = 4096  # ids
LANES = 2048  # blocks that are coded side by side
CHUNK = 16  # ids of a block after which the model learns
SLOTS = 10  # bits of a block's prediction tables
SURE = 7  # the most that a prediction is trusted
RATE = 7  # how slowly the mixing learns
TOTAL = 12  # bits of the classes' frequencies
CLASSES = 128  # at most
TOP, LEAST, DIGIT = 1 << 56, 1 << 40, 16  # the range coder's interval, at most and at least, and the bits that it moves on by
SQUASH = np.array([min(4064, max(32, round(4096 / (1 + 2.718281828459045 ** (-x / 256))))) for x in range(-2048, 2048)], np.int64)


@dataclass
class Order0:
    """Ids in order of how common they are, in classes of 2**bits ids, and each class's frequency after each."""

    order: np.ndarray  # uint16
    bits: np.ndarray  # uint8
    freq: np.ndarray  # uint16, classes x classes; rows add up to 1 << TOTAL

    def __post_init__(self) -> None:
        self.n = len(self.bits)
        self.size = self.bits.astype(np.int64)
        many = 1 << self.size
        self.first = np.cumsum(many) - many
        self.of, self.place = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.of[self.order] = np.repeat(np.arange(self.n), many)
        self.place[self.order] = np.arange(len(self.order)) - self.first[self.of[self.order]]
        freq = self.freq.astype(np.int64)
        self.spans = (np.cumsum(freq, axis=1) - freq << 20 | freq).ravel()  # where each begins, and how long it is
        self.find = np.concatenate([np.repeat(np.arange(self.n, dtype=np.uint8), row) for row in freq])
        self.ids = self.order.astype(np.int64)

    def pack(self) -> bytes:
        return struct.pack("<2I", len(self.order), self.n) + self.order.astype("<u2").tobytes() + self.bits.tobytes() + self.freq.astype("<u2").tobytes()


def unpack_order0(data: bytes) -> Order0:
    ids, n = struct.unpack("<2I", data[:8])
    at = 8 + 2 * ids
    return Order0(np.frombuffer(data, "<u2", ids, 8).astype(np.uint16), np.frombuffer(data, np.uint8, n, at), np.frombuffer(data, "<u2", n * n, at + n).reshape(n, n))


def count_order0(ids: np.ndarray, slack: float = 1.35) -> Order0:
    """slack: how much commoner a class's first id may be than its last."""
    count = np.bincount(ids, minlength=1)
    order = np.argsort(-count, kind="stable")[: np.count_nonzero(count)]
    own = count[order]
    bits: list[int] = []
    while not bits or len(bits) > CLASSES:
        bits, at, slack = [], 0, slack * 1.2 if bits else slack
        while at < len(own):
            k = 0
            while at + (2 << k) <= len(own) and own[at] <= slack * own[at + (2 << k) - 1]:
                k += 1
            bits.append(k)
            at += 1 << k
    n = len(bits)
    of = np.zeros(1 << 16, np.uint8)
    of[order] = np.repeat(np.arange(n), 1 << np.array(bits))
    seen, all_ = np.zeros(n * n), np.zeros(n)
    for a in range(0, len(ids), 1 << 18):
        x = of.take(ids[a : a + 1 + (1 << 18)]).astype(np.int64)
        seen += np.bincount(x[:-1] * n + x[1:], minlength=n * n)
        all_ += np.bincount(x[: 1 << 18], minlength=n)
    seen = seen.reshape(n, n) + 16 * all_ / len(ids)
    freq = (seen / seen.sum(axis=1, keepdims=True) * ((1 << TOTAL) - n)).astype(np.int64) + 1
    freq[np.arange(n), freq.argmax(axis=1)] += (1 << TOTAL) - freq.sum(axis=1)
    return Order0(order.astype(np.uint16), np.array(bits, np.uint8), freq.astype(np.uint16))


class Mixer:
    """The model of every lane: prediction tables (an id with how sure it is, for each context) and what the mixing has learnt. What `predict`
    says of a chunk's steps stays in arrays for `learn`, in which orders 1 and 2 come first, then steps, then lanes."""

    def __init__(self, lanes: int, base: Order0):
        self.table = np.zeros(2 * lanes << SLOTS, np.uint32)
        self.slots = (np.arange(2 * lanes) << SLOTS).reshape(2, 1, lanes)
        self.rows = ((SURE + 1) * np.arange(2 * lanes)).reshape(2, 1, lanes)
        self.common_row = 16 * np.arange(lanes)
        start = 200 * np.arange(SURE + 1) - SURE * 100  # a surer prediction is likelier
        self.by_sure, self.by_common = np.tile(start, 2 * lanes).astype(np.int32), np.full(16 * lanes, 2048, np.int32)
        self.common = np.minimum(base.of >> 2, 15)
        self.at, self.sure = (np.zeros((2, CHUNK, lanes), np.int64) for _ in range(2))
        self.known = np.zeros((2, CHUNK, lanes), np.uint32)
        self.size, self.guess, self.p = (np.zeros((CHUNK, lanes), np.int64) for _ in range(3))

    def predict(self, last: np.ndarray, before: np.ndarray, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Candidates for the steps a to b of a chunk, and the probabilities (of 4096) that they come true."""
        at, known, sure, size, guess, p = self.at[:, a:b], self.known[:, a:b], self.sure[:, a:b], self.size[a:b], self.guess[a:b], self.p[a:b]
        np.multiply(last, 40503, out=at[0])
        np.multiply(before, 30103, out=at[1])
        at[1] += at[0]
        at *= 0x9E3779B1
        at >>= 20
        at &= (1 << SLOTS) - 1
        at += self.slots
        self.table.take(at, out=known, mode="clip")
        np.right_shift(known, 16, out=sure)
        np.bitwise_and(np.where(sure[1] >= sure[0], known[1], known[0]), 0xFFFF, out=guess)
        sure += self.rows
        said = self.by_sure.take(sure)
        self.common.take(guess, out=size, mode="clip")
        size += self.common_row
        SQUASH.take(said[0] + said[1] + self.by_common.take(size), out=p, mode="clip")
        return guess, p

    def learn(self, ids: np.ndarray) -> None:
        """From the ids of a chunk's steps. Where a context comes more than once, the last counts."""
        n = len(ids)
        known, ids = self.known[:, :n], ids.astype(np.uint32)
        # right: surer; wrong: the new id, sure of nothing
        self.table[self.at[:, :n].ravel()] = np.where(known & 0xFFFF == ids, np.minimum(known + (1 << 16), ids | SURE << 16), ids).ravel()
        miss = ((self.guess[:n] == ids) * 4096.0 - self.p[:n]).ravel()
        for c, m, learnt in ((self.sure[:, :n], np.concatenate([miss, miss]), self.by_sure), (self.size[:n], miss, self.by_common)):
            learnt += np.bincount(c.ravel(), m, len(learnt)).astype(np.int32) >> RATE


def encode_lanes(ids: np.ndarray, base: Order0) -> tuple[np.ndarray, np.ndarray]:
    """ids: steps x lanes. The digits of every lane (a row each) and how many there are."""
    steps, lanes = ids.shape
    mixer = Mixer(lanes, base)
    x = np.full((steps + 2, lanes), base.ids[0], np.uint16)
    x[2:] = ids
    out = np.zeros((lanes, steps // 2 + 8 * CHUNK), np.int32)
    span, low, place = np.full(lanes, TOP), np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
    for t in range(0, steps, CHUNK):
        rows = x[t : t + 2 + CHUNK].astype(np.int64)
        now, last = rows[2:], rows[1:-1]
        guess, p = mixer.predict(last, rows[:-2], 0, len(now))
        hit, of = guess == now, base.of.take(now)
        own = base.spans.take(base.of.take(last) * base.n + of)
        begin, long, size, inner = own >> 20, own & 0xFFFFF, base.size.take(of), base.place.take(now)
        if int(place.max()) + 4 * CHUNK > out.shape[1]:
            out = np.pad(out, ((0, 0), (0, steps // 4 + 8 * CHUNK)))
        flat, row = out.ravel(), out.shape[1] * np.arange(lanes)
        for k in range(len(now)):
            bound = (span >> 12) * p[k]
            rest = span - bound >> TOTAL
            part = rest * long[k] >> size[k]
            low += np.where(hit[k], 0, bound + rest * begin[k] + part * inner[k])
            span = np.where(hit[k], bound, part)
            while True:  # moves on where the interval has become short
                short = span < LEAST
                shift = short * DIGIT
                flat[row + place] = low >> 40  # stands if the place moves on
                low &= np.where(short, LEAST - 1, -1)
                low <<= shift
                span <<= shift
                place += short
                if span.min() >= LEAST:
                    break
        mixer.learn(now)
    out[np.arange(lanes), place] = low + LEAST - 1 >> 40  # any number in the interval will do
    place += 1
    for k in range(int(place.max()) - 1, 0, -1):  # carries
        out[:, k - 1] += out[:, k] >> DIGIT
    return (out & 0xFFFF).astype(">u2"), place


def decode_lanes(parts: list[bytes], steps: int, base: Order0) -> np.ndarray:
    """The ids, steps x lanes."""
    lanes, width = len(parts), max(map(len, parts)) + 32 & ~7
    data = np.frombuffer(b"".join(b"\0" + x.ljust(width - 1, b"\0") for x in parts), np.uint8).reshape(lanes, width)
    words = data.view(">u2").astype(np.uint16).ravel()
    low = data[:, :8].copy().view(">u8").ravel().astype(np.int64)  # seven bytes after a zero
    mixer = Mixer(lanes, base)
    out, x = np.empty((steps, lanes), np.uint16), np.full((CHUNK + 2, lanes), base.ids[0])
    span, place = np.full(lanes, TOP), np.arange(lanes) * (width // 2) + 4
    of = base.of.take(x[1])
    for t in range(0, steps, CHUNK):
        many = min(CHUNK, steps - t)
        for k in range(many):
            guess, p = mixer.predict(x[k + 1 : k + 2], x[k : k + 1], k, k + 1)
            bound = span >> 12
            bound *= p[0]
            hit = low < bound
            left = np.maximum(low - bound, 0)
            rest = span - bound >> TOTAL
            own = base.find.take((of << TOTAL) + left // rest)
            of *= base.n
            of += own
            known = base.spans.take(of)
            left -= rest * (known >> 20)
            part = rest * (known & 0xFFFFF) >> base.size.take(own)
            inner = left // part
            left -= part * inner
            inner += base.first.take(own)
            now = x[k + 2]
            now[:] = np.where(hit, guess[0], base.ids.take(inner, mode="clip"))
            of = base.of.take(now)
            span, low = np.where(hit, bound, part), np.where(hit, low, left)
            while True:  # moves on where the interval has become short
                short = span < LEAST
                shift = short * DIGIT
                low <<= shift
                low |= words.take(place, mode="clip") * short
                span <<= shift
                place += short
                if span.min() >= LEAST:
                    break
        out[t : t + many] = x[2 : 2 + many]
        mixer.learn(x[2 : 2 + many])
        x[:2] = x[CHUNK:]
    return out


def groups(blocks: int) -> Iterator[tuple[int, int]]:
    """The blocks in runs of at most LANES, of about the same number each."""
    n = -(-blocks // LANES)
    edges = [blocks * k // n for k in range(n + 1)]
    yield from zip(edges[:-1], edges[1:], strict=True)


def encode_file(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray) -> bytes:
    """A file: head, the blocks, the block table, the documents' table, the order-0 model, and a tail that says where these are."""
    blocks = -(-len(ids) // BLOCK)
    steps = min(BLOCK, len(ids))
    base = count_order0(ids)
    parts, table, at = [MAGIC], [], len(MAGIC)
    for a, b in groups(blocks):
        flat = ids[a * BLOCK : b * BLOCK]
        grid = np.full((b - a) * steps, ids[-1], np.uint16)  # the last block is filled up
        grid[: len(flat)] = flat
        digits, numbers = encode_lanes(np.ascontiguousarray(grid.reshape(-1, steps).T), base)
        for k, n in enumerate(numbers.tolist()):
            data, plain = digits[k, :n].tobytes(), flat[k * BLOCK : (k + 1) * BLOCK]
            table.append((at, len(data), len(plain), zlib.crc32(plain.astype("<u2")), zlib.crc32(data)))
            parts.append(data)
            at += len(data)
    known = np.array([x is not None for x in doc_ids], np.uint8).tobytes()
    documents = np.array([x or 0 for x in doc_ids], "<i8").tobytes() + np.asarray(counts, "<i8").tobytes() + known
    tables = [np.array(table, "<u8").tobytes(), zlib.compress(documents, 6), zlib.compress(base.pack(), 6)]
    tail = struct.pack("<9Q", at, len(table), len(doc_ids), *map(len, tables), *map(zlib.crc32, tables))
    return b"".join([*parts, *tables, tail, struct.pack("<Q", zlib.crc32(tail)), MAGIC])


def decode_file(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """doc_ids, their numbers of ids, and all ids; a ValueError where a checksum does not hold."""
    if len(data) < 96 or data[:8] != MAGIC or data[-8:] != MAGIC:
        raise ValueError("not a file of ids")
    if zlib.crc32(data[-88:-16]) != struct.unpack("<Q", data[-16:-8])[0]:
        raise ValueError("the tail's checksum does not hold")
    at, n_blocks, n_docs, *said = struct.unpack("<9Q", data[-88:-16])
    tables = []
    for size, crc in zip(said[:3], said[3:], strict=True):
        tables.append(data[at : at + size])
        at += size
        if zlib.crc32(tables[-1]) != crc:
            raise ValueError("a table's checksum does not hold")
    table = np.frombuffer(tables[0], "<u8").reshape(-1, 5).astype(np.int64)
    plain, base = zlib.decompress(tables[1]), unpack_order0(zlib.decompress(tables[2]))
    doc_ids, counts, known = np.frombuffer(plain, "<i8", n_docs), np.frombuffer(plain, "<i8", n_docs, 8 * n_docs), plain[16 * n_docs :]
    steps, out = int(table[:, 2].max()), []
    for a, b in groups(n_blocks):
        parts = [data[start : start + long] for start, long in table[a:b, :2].tolist()]
        for k, (part, crc) in enumerate(zip(parts, table[a:b, 4].tolist(), strict=True)):
            if zlib.crc32(part) != crc:
                raise ValueError(f"block {a + k}: the bytes' checksum does not hold")
        ids = np.ascontiguousarray(decode_lanes(parts, steps, base).T)
        for k, (n, crc) in enumerate(table[a:b, 2:4].tolist()):
            if zlib.crc32(ids[k, :n].astype("<u2")) != crc:
                raise ValueError(f"block {a + k}: the ids' checksum does not hold")
            out.append(ids[k, :n])
    return [x if y else None for x, y in zip(doc_ids.tolist(), known, strict=True)], counts, np.concatenate(out)


MANIFEST = "part int, file string, n_docs long, n_ids long, n_bytes long"


def write_ids(docs: DataFrame, tokenizer: str, root: str, end: int = 2, most: int = LANES * BLOCK) -> DataFrame:
    """Files of all documents' ids, in order of doc_id: a task's files, of about `most` ids each, are a range of ids. Gives their manifest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        held: list[tuple] = []
        rows = []

        def put() -> None:
            doc_ids = [x for part, _, _ in held for x in part]
            counts, ids = (np.concatenate([x[k] for x in held]) for k in (1, 2))
            held.clear()
            data = encode_file(doc_ids, counts, ids)
            name = f"{task.partitionId():06d}-{len(rows):04d}-{task.taskAttemptId()}.ids"
            write_file(f"{root}/{name}", data)
            rows.append((task.partitionId(), name, len(doc_ids), len(ids), len(data)))

        with shared_tokenizer(tokenizer) as model:
            for b in small(batches, 4 << 20):
                ids, counts = model.encode(b.column(1).to_pylist(), end)
                held.append((b.column(0).to_pylist(), counts, ids))
                if sum(len(x[2]) for x in held) >= most:
                    put()
        if held:
            put()
        if rows:
            kinds = (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], [x.split()[0] for x in MANIFEST.split(", ")])

    key = F.xxhash64(F.col("text").cast("string"))
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), key.alias("key"), F.monotonically_increasing_id().alias("row"))
    ordered = rows.repartitionByRange(partitions(docs.sparkSession), "doc_id", "key", "row").sortWithinPartitions("doc_id", "key", "text")
    return materialise(ordered.select("doc_id", "text").mapInArrow(run, MANIFEST), "ids-manifest")


def read_ids(manifest: DataFrame, root: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32; and with `with_ids` the ids (little-endian unsigned 32-bit).
    The one window without partitions is over a row for each task that wrote, of which there are as many as shuffle partitions."""
    before = lambda of: of.rowsBetween(Window.unboundedPreceding, -1)
    # a row per task that wrote, then the files of each task
    parts = manifest.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select(F.col("part").alias("of"), F.sum("n").over(before(Window.orderBy("part"))).alias("base"))
    inside = F.sum("n_ids").over(before(Window.partitionBy("part").orderBy("file")))
    files = manifest.withColumn("inside", inside).join(parts, F.col("part") == F.col("of"))
    files = files.select("file", (F.coalesce("base", F.lit(0)) + F.coalesce("inside", F.lit(0))).alias("first"))
    names = ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: 4 + with_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, folder = filesystem(root)
        for b in batches:
            for file, first in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                with at.open_input_file(f"{folder}/{file}") as f:
                    doc_ids, counts, ids = decode_file(f.read())
                starts = np.cumsum(counts) - counts
                plain = memoryview(ids.astype("<u4").tobytes())
                parts = [plain[4 * a : 4 * (a + n)] for a, n in zip(starts.tolist(), counts.tolist(), strict=True)]
                columns = [pa.array(doc_ids, pa.int64()), pa.array(starts + first), pa.array(counts), pa.array(list(map(zlib.crc32, parts)), pa.int64())]
                columns += [pa.array(list(map(bytes, parts)), pa.binary())] if with_ids else []
                yield pa.RecordBatch.from_arrays(columns, names)

    listed = files.repartitionByRange(max(1, manifest.count()), "first")  # about a file a task
    return listed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)


def write_and_read(docs: DataFrame, tokenizer: str) -> DataFrame:
    root = shared_dir(docs.sparkSession, "ids")
    return read_ids(write_ids(docs, tokenizer, root), root)
