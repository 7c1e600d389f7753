"""Packet captures: trade messages out of pcap and pcapng files, plain or gzipped, read as streams.

A file is one task, as a gzipped stream can't be split; a task holds a packet
and a batch of rows. Prices stay whole ten-thousandths and times nanoseconds, so
that nothing is rounded; what a day's close is, is left to DataFrame operators.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame

BATCH_ROWS = 16384
#: Fixed values of the formats: magic numbers and byte orders of pcap, block types of pcapng, header sizes.
PCAP = {b"\xd4\xc3\xb2\xa1": "<", b"\x4d\x3c\xb2\xa1": "<", b"\xa1\xb2\xc3\xd4": ">", b"\xa1\xb2\x3c\x4d": ">"}
SECTION, ENHANCED, SIMPLE, LITTLE = b"\x0a\x0d\x0d\x0a", 6, 3, b"\x4d\x3c\x2b\x1a"
IPV4, VLAN, UDP, SEGMENT_HEADER = 0x0800, 0x8100, 17, 40

SCHEMA = "path string, seq long, type string, event string, flags int, at_nanos long, symbol string, size long, price_e4 long, trade_id long, complete boolean"
_TYPES = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
_NAMES = [x.split()[0] for x in SCHEMA.split(", ")]


class Truncated(Exception):
    """The stream ends inside a packet."""


def _read(stream, n: int, may_end: bool = False) -> bytes:
    """``n`` bytes; none if the stream may end here and does."""
    try:
        data = stream.read(n)
    except OSError as e:
        if "truncated" in str(e).lower():
            raise Truncated from e
        raise
    if len(data) < n and (data or not may_end):
        raise Truncated
    return data


def frames(stream) -> Iterator[bytes]:
    """The captured frames of a pcap or pcapng stream, in order."""
    magic = _read(stream, 4, may_end=True)
    if not magic:
        return
    if magic in PCAP:
        order = PCAP[magic]
        _read(stream, 20)
        while head := _read(stream, 16, may_end=True):
            yield _read(stream, struct.unpack(f"{order}8xI4x", head)[0])
        return
    if magic != SECTION:
        raise ValueError("neither pcap nor pcapng")
    kind, order = magic, "<"
    while kind:
        if kind == SECTION:
            size, mark = _read(stream, 4), _read(stream, 4)
            order = "<" if mark == LITTLE else ">"
            _read(stream, struct.unpack(f"{order}I", size)[0] - 12)
        else:
            body = _read(stream, struct.unpack(f"{order}I", _read(stream, 4))[0] - 8)
            block = struct.unpack(f"{order}I", kind)[0]
            if block == ENHANCED:
                yield body[20 : 20 + struct.unpack_from(f"{order}I", body, 12)[0]]
            elif block == SIMPLE:
                yield body[4:-4]
        kind = _read(stream, 4, may_end=True)


def payload(frame: bytes) -> bytes:
    """The UDP payload of an Ethernet frame over IPv4; empty for others."""
    at = 14
    kind = struct.unpack_from(">H", frame, 12)[0] if len(frame) >= 14 else 0
    while kind == VLAN and len(frame) >= at + 4:
        kind = struct.unpack_from(">H", frame, at + 2)[0]
        at += 4
    if kind != IPV4 or len(frame) < at + 20 or frame[at + 9] != UDP:
        return b""
    at += (frame[at] & 15) * 4
    return frame[at + 8 : at + struct.unpack_from(">H", frame, at + 4)[0]] if len(frame) >= at + 8 else b""


def messages(segment: bytes) -> Iterator[bytes]:
    """The messages of one transport segment."""
    if len(segment) < SEGMENT_HEADER:
        return
    count, at = struct.unpack_from("<H", segment, 14)[0], SEGMENT_HEADER
    for _ in range(count):
        if at + 2 > len(segment):
            return
        n = struct.unpack_from("<H", segment, at)[0]
        yield segment[at + 2 : at + 2 + n]
        at += 2 + n


def decoded(message: bytes) -> tuple | None:
    """(type, event, flags, time, symbol, size, price, trade id) of a system event, a trade or a trade break."""
    kind = message[:1]
    if kind == b"S" and len(message) >= 10:
        event, at = struct.unpack_from("<xcq", message)
        return "S", event.decode("latin-1"), None, at, None, None, None, None
    if kind in (b"T", b"B") and len(message) >= 38:
        flags, at, symbol, size, price, trade = struct.unpack_from("<xBq8sIqq", message)
        return kind.decode(), None, flags, at, symbol.decode("latin-1").rstrip(), size, price, trade
    return None


def _rows(path: str) -> Iterator[tuple]:
    """The messages of one file, and last a row of type end that says whether the stream was whole."""
    store, inside = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    seq, complete = 0, True
    with store.open_input_stream(inside, compression="detect", buffer_size=1 << 20) as stream:
        try:
            for frame in frames(stream):
                for message in messages(payload(frame)):
                    if found := decoded(message):
                        yield (path, seq, *found, None)
                        seq += 1
        except Truncated:
            complete = False
    yield (path, seq, "end", None, None, None, None, None, None, None, complete)


def read_captures(paths: DataFrame) -> DataFrame:
    """Trade messages of the files that column path names, one task a file; see ``SCHEMA``.

    Null paths give no rows. A file that ends inside a packet gives what came
    before it and an end row with complete false; an empty file has the end row
    alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                held: list[tuple] = []
                for row in _rows(path):
                    held.append(row)
                    if len(held) == BATCH_ROWS:
                        yield _batch(held)
                        held = []
                if held:
                    yield _batch(held)

    dealt = paths.select("path").filter("path is not null").distinct().repartition("path")
    return dealt.mapInArrow(run, SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], _NAMES)
