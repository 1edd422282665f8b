"""MPEG audio media columns.

``encode`` stores a byte payload losslessly in a constant-bitrate MPEG-2 Layer III stream: one frame per 576
bytes (a frame of this kind spans 576 samples), each frame with a silent main part, the bytes in its ancillary
area and their CRC-32 behind them. An ID3v2.3 tag with a CRC-checked extended header and an Info frame with a
seek table stand before the frames, an ID3v1 tag behind them.

``parse`` reads any MPEG audio stream (versions 1, 2 and 2.5, layers I to III): it skips tags, finds frame
headers again after damage, reads Xing, Info and VBRI tables, verifies the CRC-16 words of frames of all three layers,
and gives exact durations and the offset of every frame.

Null and empty texts are one unit of padding; texts may have any length, and so may streams. Equal texts give equal
columns; a repeated row, and one without a key, gives a result of its own; an empty table gives an empty one; columns
other than the two that are named are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from dataclasses import dataclass, field
from fractions import Fraction
from functools import lru_cache

from pyspark.sql import DataFrame

from .common import by_batch, texts

UNIT = 576
#: Fixed values of the MPEG audio standard: kbit/s by (version 1?, layer) and samples/s by version bits.
BITRATES = {
    (True, 1): (0, 32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (True, 2): (0, 32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (True, 3): (0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (False, 1): (0, 32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (False, 2): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    (False, 3): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
#: Layer II: the number of subbands whose allocation has 4, 3 and 2 bits, by table.
ALLOCATED = {"a": (11, 12, 4), "b": (11, 12, 7), "c": (2, 6, 0), "d": (2, 10, 0), "low": (4, 7, 19)}
RATES = {3: (44100, 48000, 32000), 2: (22050, 24000, 16000), 0: (11025, 12000, 8000)}


@dataclass(frozen=True)
class Header:
    version: int
    layer: int
    protected: bool
    rate: int
    samples: int
    length: int
    side: int
    channels: int
    #: Subbands from which on both channels share their allocation.
    bound: int
    kbits: int


@lru_cache(4096)
def header(word: bytes) -> Header | None:
    """What four bytes say as a frame header; None if they are none."""
    if len(word) < 4 or word[0] != 0xFF or word[1] < 0xE0:
        return None
    version, layer = word[1] >> 3 & 3, 4 - (word[1] >> 1 & 3)
    kbits, hertz = word[2] >> 4, word[2] >> 2 & 3
    if version == 1 or layer == 4 or kbits in (0, 15) or hertz == 3 or word[3] & 3 == 2:
        return None
    first, rate = version == 3, RATES[version][hertz]
    bits, padding = BITRATES[first, layer][kbits] * 1000, word[2] >> 1 & 1
    samples = 384 if layer == 1 else 1152 if layer == 2 or first else 576
    length = (12 * bits // rate + padding) * 4 if layer == 1 else samples // 8 * bits // rate + padding
    mono, joint = word[3] >> 6 == 3, word[3] >> 6 == 1
    side = 0 if layer < 3 else (17 if mono else 32) if first else (9 if mono else 17)
    return Header(version, layer, not word[1] & 1, rate, samples, length, side, 1 if mono else 2, 4 * (word[3] >> 4 & 3) + 4 if joint else 32, bits // 1000)


@lru_cache(4096)
def crc16(data: bytes, bits: int | None = None) -> int:
    """The standard's frame check over the first bits, or all: polynomial 0x8005, all ones at first."""
    crc, left = 0xFFFF, 8 * len(data) if bits is None else bits
    for byte in data:
        crc ^= byte << 8 & (0xFFFF << max(0, 16 - left))
        for _ in range(min(8, max(0, left))):
            crc = (crc << 1 ^ 0x8005 if crc & 0x8000 else crc << 1) & 0xFFFF
        left -= 8
    return crc


def _allocations(head: Header) -> list[int]:
    """Layer II: the width of each subband's allocation."""
    each = head.kbits // head.channels
    if head.version != 3:
        table = "low"
    elif each <= 48:
        table = "d" if head.rate == 32000 else "c"
    else:
        table = "a" if head.rate == 48000 or each <= 80 else "b"
    return [width for width, n in zip((4, 3, 2), ALLOCATED[table], strict=True) for _ in range(n)]


def protected_bits(head: Header, body: bytes) -> int:
    """How many bits behind the checksum it covers: allocations, in layer II also the selection of scale factors, in layer III the side part."""
    if head.layer == 3:
        return 8 * head.side
    widths = [4] * 32 if head.layer == 1 else _allocations(head)
    value, size, at, used = int.from_bytes(body, "big"), 8 * len(body), 0, 0
    for band, width in enumerate(widths):
        for _ in range(head.channels if band < head.bound else 1):
            at += width
            if at <= size and value >> (size - at) & ((1 << width) - 1):
                used += 1 if band < head.bound else head.channels
    return at + 2 * used if head.layer == 2 else at


def holds(data: bytes, at: int, head: Header) -> bool:
    """Whether the checksum of the frame at an offset is right."""
    body = data[at + 6 : at + 6 + max(head.side, 64)]
    bits = 16 + protected_bits(head, body)
    return data[at + 4 : at + 6] == struct.pack(">H", crc16(data[at + 2 : at + 4] + body[: -(-bits // 8) - 2], bits))


#: MPEG-2 Layer III at 16 kHz, mono: 144 kbit/s with a checksum, and 32 kbit/s without one for the table.
DATA, TABLE = bytes((0xFF, 0xF2, 0xD8, 0xC0)), bytes((0xFF, 0xF3, 0x48, 0xC0))
SIDE = bytes(9)
HEAD = DATA + struct.pack(">H", crc16(DATA[2:] + SIDE)) + SIDE
FILL = bytes(header(DATA).length - len(HEAD) - UNIT - 4)


def padded(data: bytes) -> bytes:
    """data with bytes 255 behind it, up to a positive multiple of the unit."""
    return data + b"\xff" * (-len(data) % UNIT if data else UNIT)


def _synchsafe(n: int) -> bytes:
    return bytes(n >> s & 127 for s in (21, 14, 7, 0))


def _id3v2(values: dict[str, str]) -> bytes:
    frames = b"".join(b"TXXX" + struct.pack(">IH", len(x), 0) + x for x in (b"\0" + k.encode() + b"\0" + v.encode() for k, v in values.items()))
    body = struct.pack(">IHII", 10, 0x8000, 0, zlib.crc32(frames)) + frames
    return b"ID3\x03\x00\x40" + _synchsafe(len(body)) + body


def encode(data: bytes) -> bytes:
    """The stream that holds data, padded to whole units."""
    payload = padded(data)
    frames = [HEAD + x + struct.pack(">I", zlib.crc32(x)) + FILL for x in (payload[i : i + UNIT] for i in range(0, len(payload), UNIT))]
    size = header(TABLE).length + len(frames) * header(DATA).length
    table = TABLE + SIDE + b"Info" + struct.pack(">III", 7, len(frames), size) + bytes(i * 256 // 100 for i in range(100))
    tag = _id3v2({"bytes": str(len(data)), "payload": str(len(payload))})
    return tag + table.ljust(header(TABLE).length, b"\0") + b"".join(frames) + b"TAG" + bytes(125)


@dataclass
class Stream:
    tags: dict[str, str] = field(default_factory=dict)
    table: dict[str, object] = field(default_factory=dict)
    offsets: list[int] = field(default_factory=list)
    duration: Fraction = Fraction(0)
    samples: int = 0
    rate: int = 0
    resyncs: int = 0
    skipped: int = 0
    checked: int = 0
    failed: int = 0


def _read_id3v2(data: bytes, at: int, out: Stream) -> int:
    size = 10 + sum((data[at + 6 + i] & 127) << s for i, s in enumerate((21, 14, 7, 0)))
    body, version, flags = data[at + 10 : at + size], data[at + 3], data[at + 5]
    if version == 3 and flags & 0x40 and len(body) >= 10:
        extra, crc_flag = struct.unpack(">IH", body[:6])
        rest = body[4 + extra :]
        if crc_flag & 0x8000 and len(body) >= 14:
            out.checked += 1
            out.failed += struct.unpack(">I", body[10:14])[0] != zlib.crc32(rest)
        body = rest
    while len(body) >= 10 and body[0]:
        n = struct.unpack(">I", body[4:8])[0] if version < 4 else sum((body[4 + i] & 127) << s for i, s in enumerate((21, 14, 7, 0)))
        value = body[10 : 10 + n]
        if value[:1] in (b"\0", b"\3"):
            text = value[1:].decode("latin-1" if value[0] == 0 else "utf-8", "replace")
            key, _, rest = text.partition("\0") if body[:4] == b"TXXX" else (body[:4].decode("latin-1"), "", text)
            out.tags[key] = rest.rstrip("\0")
        body = body[10 + n :]
    return at + size + 10 * bool(version == 4 and flags & 0x10)


def _read_table(data: bytes, at: int, head: Header) -> dict[str, object]:
    """The variable-bitrate table in the frame at an offset; empty if it holds none."""
    x = at + 4 + 2 * head.protected + head.side
    if data[x : x + 4] in (b"Xing", b"Info"):
        flags, y, out = struct.unpack(">I", data[x + 4 : x + 8])[0], x + 8, {"kind": data[x : x + 4].decode()}
        for bit, name in ((1, "frames"), (2, "bytes")):
            if flags & bit:
                out[name], y = struct.unpack(">I", data[y : y + 4])[0], y + 4
        return out | ({"seek": tuple(data[y : y + 100])} if flags & 4 else {})
    x = at + 36
    if data[x : x + 4] == b"VBRI" and len(data) >= x + 26:
        size, frames, n, scale, width = struct.unpack(">IIHHH", data[x + 10 : x + 24])
        y = x + 26
        seek = tuple(int.from_bytes(data[y + i * width : y + (i + 1) * width], "big") * scale for i in range(n))
        return {"kind": "VBRI", "frames": frames, "bytes": size, "seek": seek}
    return {}


def parse(data: bytes) -> Stream:
    """Frames, tags, tables and checks of a stream; damaged parts are skipped and counted."""
    out, at, end, lost, before = Stream(), 0, len(data), False, None
    if data[-128:-125] == b"TAG" and end >= 128:
        end -= 128
        out.tags.setdefault("ID3v1", data[end + 3 : end + 33].rstrip(b"\0 ").decode("latin-1"))
    times: dict[int, int] = {}
    while at < end:
        if data[at : at + 3] == b"ID3" and end - at >= 10:
            at = _read_id3v2(data, at, out)
            continue
        head = header(data[at : at + 4])
        after = at + head.length if head else 0
        kind = (head.version, head.layer, head.rate) if head else None
        # a frame is one if it ends the stream, if another of its kind follows, or if one of its kind has just ended
        follows = head and after <= end and (after == end or (not lost and kind == before) or ((x := header(data[after : after + 4])) and (x.version, x.layer, x.rate) == kind))
        if follows:
            if head.protected:
                out.checked += 1
                out.failed += not holds(data, at, head)
            if not out.offsets and not out.table and (table := _read_table(data, at, head)):
                out.table = table
            else:
                out.offsets.append(at)
                times[head.rate] = times.get(head.rate, 0) + head.samples
            at, lost, before = after, False, kind
            continue
        if not lost:
            out.resyncs, lost = out.resyncs + 1, True
        found = data.find(b"\xff", at + 1, end)
        out.skipped += (found if found >= 0 else end) - at
        at = found if found >= 0 else end
    out.samples, out.rate = sum(times.values()), next(iter(times), 0)
    out.duration = sum((Fraction(n, r) for r, n in times.items()), Fraction(0))
    return out


def payload(data: bytes, stream: Stream) -> bytes:
    """The padded payload of a stream that ``encode`` made; a unit that fails its CRC-32 raises."""
    at = len(HEAD)
    units = [data[x + at : x + at + UNIT] for x in stream.offsets]
    for x, unit in zip(stream.offsets, units, strict=True):
        if data[x + at + UNIT : x + at + UNIT + 4] != struct.pack(">I", zlib.crc32(unit)):
            raise ValueError(f"the unit at byte {x} fails its checksum")
    return b"".join(units)


def media_column(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, media): each text as a stream."""

    def rows(batch):
        data = [x.encode() for x in texts(batch, text)]
        for i in range(0, len(data), 100):
            yield {key: batch.column(key).slice(i, 100), "n_bytes": [len(x) for x in data[i : i + 100]], "media": [encode(x) for x in data[i : i + 100]]}

    return by_batch(docs.select(key, text), rows, f"{key} long, n_bytes long, media binary")


def media_features(media: DataFrame, key: str = "doc_id") -> DataFrame:
    """What the stored streams say: payload and its digests, duration, frame offsets, checks.

    duration is samples / sample_rate seconds, exactly. seek_offsets: the byte at which each frame begins.
    """

    def rows(batch):
        out = {x: [] for x in ("payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "samples", "sample_rate", "seek_offsets")}
        for data in (x.as_py() for x in batch.column("media")):
            s = parse(data)
            body = payload(data, s)
            values = (len(body), hashlib.sha256(body).hexdigest(), zlib.crc32(body[-32:]), len(data), hashlib.sha256(data).hexdigest())
            said = f"mpeg2-layer3;frames={len(s.offsets)};seconds={s.duration};first={s.offsets[0]};table={s.table.get('kind', '-')}:{s.table.get('frames', 0)};checks={s.checked - s.failed}/{s.checked};resyncs={s.resyncs}"
            for k, v in zip(out, (*values, said, s.samples, s.rate, s.offsets), strict=True):
                out[k].append(v)
        return {key: batch.column(key), "n_bytes": batch.column("n_bytes")} | out

    return by_batch(media, rows, f"{key} long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, samples long, sample_rate int, seek_offsets array<long>")
