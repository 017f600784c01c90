"""MPEG transport streams as a media column: bytes go in as one elementary stream and are read back from its packets.

A stream holds a program association table, a program map table, and packetised elementary packets (PES) of a
private stream, each cut into transport packets of 188 bytes with continuity counters. Every PES starts a unit with a
presentation timestamp; every `rap` units one has a clock reference and the random-access flag, and the tables before it, so
that a reader can start there. Reading parses the tables (also sections over several packets), checks their CRC and the counters (a packet may be repeated once, and a
jump may be announced), reassembles the units, and gives timestamps with random-access points: the byte in the stream from which `decode` can go on.

Streams are a binary column that is written to a table in the shared folder and read again.

Defined cases: a null or empty text is `pad` spaces; equal texts give equal streams; repeated rows are kept; an
empty table gives no rows; a stream that is cut or damaged gives what its whole units hold, and counts its errors.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialise, raw, small

PACKET, SYNC, PMT_PID, MEDIA_PID, STREAM_TYPE, STREAM_ID, CLOCK = 188, 0x47, 0x1000, 0x0100, 0x06, 0xBD, 90_000  # fixed values
UNIT = 4096  # payload bytes of a unit
RATE = 8000  # samples (bytes) a second


def crc_step(x: int) -> int:
    crc = x << 24
    for _ in range(8):
        crc = crc << 1 ^ (0x04C11DB7 if crc & 0x80000000 else 0)
    return crc & 0xFFFFFFFF


CRC_STEPS = [crc_step(x) for x in range(256)]


def crc32_mpeg(data: bytes) -> int:
    """CRC-32 of MPEG-2 sections: not reflected, no final xor."""
    crc = 0xFFFFFFFF
    for x in data:
        crc = crc << 8 & 0xFFFFFFFF ^ CRC_STEPS[crc >> 24 ^ x]
    return crc


def section(table: int, key: int, body: bytes) -> bytes:
    head = bytes([table]) + (0xB000 | len(body) + 9).to_bytes(2, "big") + key.to_bytes(2, "big") + bytes([0xC1, 0, 0]) + body
    return head + crc32_mpeg(head).to_bytes(4, "big")


def table_packet(pid: int, own: bytes, counter: int) -> bytes:
    head = bytes([SYNC]) + (0x4000 | pid).to_bytes(2, "big") + bytes([0x10 | counter, 0])
    return (head + own).ljust(PACKET, b"\xff")


PROGRAMS = section(0, 1, (1).to_bytes(2, "big") + (0xE000 | PMT_PID).to_bytes(2, "big"))
STREAMS = section(2, 1, (0xE000 | MEDIA_PID).to_bytes(2, "big") + b"\xf0\x00" + bytes([STREAM_TYPE]) + (0xE000 | MEDIA_PID).to_bytes(2, "big") + b"\xf0\x00")
TABLES = [table_packet(0, PROGRAMS, k) + table_packet(PMT_PID, STREAMS, k) for k in range(16)]  # by their counter


def stamp(pts: int) -> bytes:
    return bytes([0x21 | pts >> 29 & 0x0E, pts >> 22 & 0xFF, 1 | pts >> 14 & 0xFE, pts >> 7 & 0xFF, 1 | pts << 1 & 0xFE])


def unstamp(x: bytes) -> int:
    return (x[0] >> 1 & 7) << 30 | x[1] << 22 | x[2] >> 1 << 15 | x[3] << 7 | x[4] >> 1


def encode(payload: bytes, rap: int = 8) -> bytes:
    """The transport stream of a payload."""
    out, counter = [], 0
    for k, start in enumerate(range(0, len(payload), UNIT)):
        if k % rap == 0:
            out.append(TABLES[k // rap & 15])
        pts = (start * CLOCK // RATE) & (1 << 33) - 1
        body = payload[start : start + UNIT]
        pes = b"\x00\x00\x01" + bytes([STREAM_ID]) + (len(body) + 8).to_bytes(2, "big") + bytes([0x84, 0x80, 5]) + stamp(pts) + body
        # the first packet's adaptation field: flags, and the clock reference at a random-access point
        field_ = bytes([0x50]) + (pts << 15 | 0x7E00).to_bytes(6, "big") if k % rap == 0 else b""
        room = PACKET - 4 - (len(field_) + 1 if field_ else 0)
        cuts = [pes[:room]] + [pes[i : i + PACKET - 4] for i in range(room, len(pes), PACKET - 4)]
        for n, cut in enumerate(cuts):
            own = field_ if n == 0 else b""
            space = PACKET - 4 - len(cut) - (len(own) + 1 if own else 0)
            if space and not own:  # stuffing
                own, space = (b"", 0) if space == 1 else (b"\x00", space - 2)
                adapt = bytes([len(own) + space]) + own + b"\xff" * space
            else:
                adapt = bytes([len(own) + space]) + own + b"\xff" * space if own else b""
            head = bytes([SYNC, (0x40 if n == 0 else 0) | MEDIA_PID >> 8, MEDIA_PID & 0xFF, (0x30 if adapt else 0x10) | counter])
            out.append(head + adapt + cut)
            counter = counter + 1 & 15
    return b"".join(out or TABLES[:1])


@dataclass
class Parsed:
    payload: bytes = b""
    programs: dict[int, int] = field(default_factory=dict)  # program: PID of its map
    streams: dict[int, int] = field(default_factory=dict)  # PID: stream type
    stamps: list[tuple[int, int, bool, int]] = field(default_factory=list)  # (byte in the payload, timestamp, random access, byte in the stream: of a random-access point where its tables begin)
    packets: int = 0
    units: int = 0
    errors: int = 0  # lost sync, counters that jump, tables or units that don't hold
    clock: int | None = None  # the first reference


def decode(stream: bytes) -> Parsed:
    found, whole = Parsed(packets=len(stream) // PACKET), len(stream) // PACKET * PACKET
    found.errors += whole < len(stream)
    if not whole:
        return found
    grid = np.frombuffer(stream, np.uint8, whole).reshape(-1, PACKET)
    good = (grid[:, 0] == SYNC) & (grid[:, 1] & 0x80 == 0)
    found.errors += int((~good).sum())
    pids = (grid[:, 1].astype(np.int32) & 0x1F) << 8 | grid[:, 2]
    control = grid[:, 3] >> 4 & 3
    begin = np.where(control & 2, 5 + grid[:, 4].astype(np.int32), 4)
    body = good & (control & 1 == 1) & (begin <= PACKET)
    starts = (grid[:, 1] & 0x40) != 0

    def tables(pid: int, kind: int) -> Iterator[bytes]:
        """The bodies of a table's sections, each from one packet or several."""
        held: bytes | None = None
        for k in np.flatnonzero(body & (pids == pid)).tolist():
            own = stream[k * PACKET + begin[k] : (k + 1) * PACKET]
            if starts[k]:
                parts = [*([held + own[1 : 1 + own[0]]] if held else []), own[1 + own[0] :]] if own else []
            else:
                parts = [held + own] if held is not None else []
            held = None
            for n, part in enumerate(parts):
                while len(part) >= 3 and part[0] != 0xFF:
                    size = 3 + (int.from_bytes(part[1:3], "big") & 0xFFF)
                    if len(part) < size:
                        break
                    if size < 12 or crc32_mpeg(part[:size]) != 0:
                        found.errors += 1
                    elif part[0] == kind:
                        yield part[8 : size - 4]
                    part = part[size:]
                if part and part[0] != 0xFF:
                    if n + 1 < len(parts):
                        found.errors += 1  # the next section begins before this one ends
                    else:
                        held = part
        found.errors += held is not None

    for own in tables(0, 0):
        found.programs |= {int.from_bytes(own[i : i + 2], "big"): int.from_bytes(own[i + 2 : i + 4], "big") & 0x1FFF for i in range(0, len(own) - 3, 4)}
    for pid in set(found.programs.values()):
        for own in tables(pid, 2):
            at = 4 + (int.from_bytes(own[2:4], "big") & 0xFFF)
            while at + 5 <= len(own):
                found.streams[int.from_bytes(own[at + 1 : at + 3], "big") & 0x1FFF] = own[at]
                at += 5 + (int.from_bytes(own[at + 3 : at + 5], "big") & 0xFFF)
    parts, size = [], 0
    programs = np.flatnonzero(good & (pids == 0))
    for pid in sorted(found.streams):
        at = np.flatnonzero(body & (pids == pid))
        same = np.zeros(len(at), bool)  # the packet before once more
        same[1:] = (grid[at[1:], 3] & 15 == grid[at[:-1], 3] & 15) & (grid[at[1:], 4:] == grid[at[:-1], 4:]).all(axis=1)
        same[1:] &= ~same[:-1]
        at = at[~same]
        counters = grid[at, 3] & 15
        told = (control[at] & 2 != 0) & (grid[at, 4] > 0) & (grid[at, 5] & 0x80 != 0)
        jump = (counters[1:] != (counters[:-1] + 1 & 15)) & ~told[1:] if len(at) else np.zeros(0, bool)
        found.errors += int(jump.sum())
        broken = set(at[1:][jump].tolist())
        heads = np.flatnonzero(starts[at])
        found.errors += bool(len(at)) and (not len(heads) or heads[0] > 0)
        for a, b in zip(heads, np.append(heads[1:], len(at)), strict=True):
            own = at[a:b].tolist()
            unit = b"".join(stream[k * PACKET + begin[k] : (k + 1) * PACKET] for k in own)
            flags = grid[own[0], 5] if control[own[0]] & 2 and grid[own[0], 4] else 0
            if flags & 0x10 and found.clock is None:
                found.clock = int.from_bytes(stream[own[0] * PACKET + 6 : own[0] * PACKET + 12], "big") >> 15
            long = int.from_bytes(unit[4:6], "big")
            if unit[:3] != b"\x00\x00\x01" or len(unit) < 9 or len(unit) != long + 6 or any(k in broken for k in own[1:]):
                found.errors += 1
                continue
            if unit[7] & 0x80:
                before = np.searchsorted(programs, own[0]) - 1  # the tables' packets lie just before a random-access point
                first = int(programs[before]) if flags & 0x40 and before >= 0 else own[0]
                found.stamps.append((size, unstamp(unit[9:14]), bool(flags & 0x40), first * PACKET))
            parts.append(unit[9 + unit[8] :])
            size += len(parts[-1])
            found.units += 1
    found.payload = b"".join(parts)
    return found


def seek(stream: bytes, pts: int) -> tuple[int, Parsed]:
    """The last random-access point at or before a timestamp: its byte in the stream, and what is read from there."""
    points = [x[3] for x in decode(stream).stamps if x[2] and x[1] <= pts]
    return (points[-1], decode(stream[points[-1] :])) if points else (0, decode(stream))


def padded(text: bytes, multiple: int = 192) -> bytes:
    size = max(1, -(-len(text) // multiple)) * multiple
    return text.ljust(size, b" ")


def with_streams(docs: DataFrame, multiple: int = 192) -> DataFrame:
    """doc_id, n_bytes and media: the transport stream of each whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, 4 << 20):
            texts = raw(b.column(1))
            media = pa.array([encode(padded(x, multiple)) for x in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(list(map(len, texts)), pa.int64()), media], ["doc_id", "n_bytes", "media"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_bytes long, media binary")


READ = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, errors long, first_pts long, last_pts long, raps array<struct<pts:long,offset:long>>"


def read_streams(rows: DataFrame) -> DataFrame:
    """What each stream holds, with its timestamps and its random-access points (timestamp, and the byte in the stream to read from)."""
    names = [x.split()[0] for x in READ.split(", ")]

    def one(media: bytes | None) -> tuple:
        p = decode(media or b"")
        pts, raps = [x[1] for x in p.stamps], [{"pts": x[1], "offset": x[3]} for x in p.stamps if x[2]]
        gaps = sorted({b - a for a, b in zip(pts, pts[1:], strict=False)})
        feature = f"pids={','.join(f'{k}:{v}' for k, v in sorted(p.streams.items()))};packets={p.packets};units={p.units};raps={len(raps)};pts={pts[0] if pts else ''}..{pts[-1] if pts else ''};step={','.join(map(str, gaps))};pcr={'' if p.clock is None else p.clock};errors={p.errors}"
        return len(p.payload), hashlib.sha256(p.payload).hexdigest(), zlib.crc32(p.payload[-16:]), len(media or b""), hashlib.sha256(media or b"").hexdigest(), feature, p.errors, pts[0] if pts else None, pts[-1] if pts else None, raps

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("pts", pa.int64()), ("offset", pa.int64())]))]
        for b in small(batches, 4 << 20):
            columns = zip(*map(one, b.column(2).to_pylist()), strict=True)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(x, k) for x, k in zip(columns, kinds, strict=True))], names)

    return rows.select("doc_id", "n_bytes", "media").mapInArrow(run, READ)


def stored(docs: DataFrame, multiple: int = 192) -> DataFrame:
    """The streams of all documents, written to a table and read again."""
    return materialise(with_streams(docs, multiple), "streams")
