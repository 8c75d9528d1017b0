"""MPEG audio columns: write payloads as frames, find frames again, read tags and tables, verify checksums.

A payload travels as the ancillary bytes of silent MPEG-1 Layer III frames (48 kHz, mono, 80 kbit/s: 240 bytes each,
of which 192 carry payload), behind an ID3v2 tag with the unpadded size and a frame with a variable-bitrate table
(frame count, byte count, 100 seek entries). Reading trusts nothing of this: it skips tags, resynchronises on frame
headers (a header counts when a frame of the same version, layer and rate, or the end, follows where it says), checks
each frame's CRC-16, and gives the exact duration in samples, without an encoder's delay and padding where its table tells
them, and each frame's byte offset. Tags read: ID3v2.2 to 2.4 with extended headers, unsynchronisation and footers, ID3v1,
APEv2; tables: Xing, Info and VBRI.

Defined results: a null text is stored as an empty one (192 spaces); null bytes and bytes without frames give zero
frames; an empty table gives an empty result; damaged frames are counted in ``crc_failed`` or skipped by the
resynchronisation; checksums of Layer II, which cover a part of variable length, are not tested; repeated rows give equal
rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import map_rows

UNIT = 192
# Fixed values of ISO 11172-3: bit rates in kbit/s by index, for layers I, II and III of MPEG-1 and MPEG-2.
BITRATES = {
    (1, 1): (0, 32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (1, 2): (0, 32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (1, 3): (0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (2, 1): (0, 32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (2, 2): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    (2, 3): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
RATES = {3: (44100, 48000, 32000), 2: (22050, 24000, 16000), 0: (11025, 12000, 8000)}  # by version bits
HEADER = bytes([0xFF, 0xFA, 0x64, 0xC0])  # MPEG-1 Layer III with CRC, 80 kbit/s, 48 kHz, mono


@lru_cache(4096)
def crc16(data: bytes) -> int:
    """CRC-16 of frame headers: polynomial 0x8005, first value 0xFFFF."""
    crc = 0xFFFF
    for byte in data:
        crc ^= byte << 8
        for _ in range(8):
            crc = (crc << 1 ^ (0x8005 if crc & 0x8000 else 0)) & 0xFFFF
    return crc


@lru_cache(4096)
def header(h: bytes) -> tuple[int, int, int, int, bool] | None:
    """(frame bytes, samples, sample rate, side information bytes, has CRC), or None if these four bytes are no header."""
    if len(h) < 4 or h[0] != 0xFF or h[1] & 0xE0 != 0xE0:
        return None
    version, layer, rate, kbit = h[1] >> 3 & 3, 4 - (h[1] >> 1 & 3), h[2] >> 2 & 3, h[2] >> 4
    if version == 1 or layer == 4 or rate == 3 or kbit in (0, 15):
        return None
    first = version == 3
    bits = BITRATES[1 if first else 2, layer][kbit] * 1000
    hertz, pad = RATES[version][rate], h[2] >> 1 & 1
    samples = 384 if layer == 1 else 1152 if layer == 2 or first else 576
    size = (12 * bits // hertz + pad) * 4 if layer == 1 else samples // 8 * bits // hertz + pad
    mono = h[3] >> 6 == 3
    side = (17 if mono else 32) if first else (9 if mono else 17)
    return size, samples, hertz, side if layer == 3 else 0, not h[1] & 1


def synchsafe(n: int) -> bytes:
    return bytes(n >> s & 0x7F for s in (21, 14, 7, 0))


def write(payload: bytes, n_bytes: int) -> bytes:
    """A file with ``payload`` (a multiple of 192 bytes), of which the first ``n_bytes`` are content."""
    size, _, _, side, _ = header(HEADER)
    text = b"\x03payload_bytes\0" + str(n_bytes).encode()
    tag = b"TXXX" + synchsafe(len(text)) + b"\0\0" + text
    lead = HEADER + struct.pack(">H", crc16(HEADER[2:] + bytes(side))) + bytes(side)
    rest = bytes(size - len(lead) - UNIT)
    frames = len(payload) // UNIT
    total = size * (frames + 1)
    table = b"Xing" + struct.pack(">III", 7, frames, total) + bytes(min(255, 256 * (p * frames // 100 + 1) // (frames + 1)) for p in range(100))
    plain = bytes([HEADER[0], HEADER[1] | 1]) + HEADER[2:] + bytes(side)  # the table's frame has no CRC, as is usual
    body = b"".join(lead + payload[k : k + UNIT] + rest for k in range(0, len(payload), UNIT))
    return b"ID3\x04\0\0" + synchsafe(len(tag)) + tag + (plain + table).ljust(size, b"\0") + body


def from_synchsafe(data: bytes) -> int:
    return sum((b & 0x7F) << 7 * k for k, b in enumerate(reversed(data)))


def read_tags(data: bytes) -> tuple[int, dict[str, str]]:
    """Where frames can start, and the text frames of ID3v2 (names of version 2.2 have three letters)."""
    start, tags = 0, {}
    while len(data) >= start + 10 and data[start : start + 3] == b"ID3":
        version, flags, size = data[start + 3], data[start + 5], from_synchsafe(data[start + 6 : start + 10])
        body = data[start + 10 : start + 10 + size]
        if flags & 0x80 and version < 4:
            body = body.replace(b"\xff\0", b"\xff")
        at, name_size = 0, 3 if version == 2 else 4
        if flags & 0x40 and version == 3 and len(body) >= 4:
            at = 4 + int.from_bytes(body[:4], "big")
        elif flags & 0x40 and version == 4:
            at = from_synchsafe(body[:4])
        lead = 6 if version == 2 else 10
        while at + lead <= len(body) and body[at] > 0:
            kind, sized = body[at : at + name_size].decode("latin-1"), body[at + name_size : at + 2 * name_size]
            n = from_synchsafe(sized) if version == 4 else int.from_bytes(sized, "big")
            value = body[at + lead : at + lead + n]
            if version == 4:
                if body[at + 9] & 1:  # a length of the data goes before them
                    value = value[4:]
                if (flags & 0x80) or body[at + 9] & 2:
                    value = value.replace(b"\xff\0", b"\xff")
            if kind.startswith("T") and value:
                text = value[1:].decode({1: "utf-16", 2: "utf-16-be", 3: "utf-8"}.get(value[0], "latin-1"), "replace")
                name, _, rest = text.partition("\0") if kind in ("TXXX", "TXX") else (kind, "", text)
                tags[name] = rest.rstrip("\0")
            at += lead + n
        start = min(len(data), start + 10 + size + 10 * (version == 4 and flags >> 4 & 1))
    return start, tags


def ape_tag(data: bytes, at: int, end: int) -> int:
    """Where an APE tag that ends at ``end`` begins; ``end`` if none does."""
    foot = data[end - 32 : end] if end - at >= 32 else b""
    if foot[:8] != b"APETAGEX":
        return end
    size, flags = struct.unpack("<I", foot[12:16])[0], struct.unpack("<I", foot[20:24])[0]
    start = end - size - 32 * (flags >> 31)
    return start if size >= 32 and start >= at else end


def read_table(data: bytes, at: int, lead: int) -> tuple[int | None, int | None, bytes, int] | None:
    """(frames, bytes, seek entries, samples of delay and padding) of a frame's variable-bitrate table."""
    if data[at + 36 : at + 40] == b"VBRI" and len(data) >= at + 62:
        total, frames, entries, _, width = struct.unpack(">IIHHH", data[at + 46 : at + 60])
        return frames, total, data[at + 62 : at + 62 + entries * width], 0
    p = at + lead
    if data[p : p + 4] not in (b"Xing", b"Info") or len(data) < p + 8:
        return None
    flags = struct.unpack(">I", data[p + 4 : p + 8])[0]
    p += 8
    numbers = []
    for bit in (1, 2):
        numbers.append(int.from_bytes(data[p : p + 4], "big") if flags & bit else None)
        p += 4 * bool(flags & bit)
    seek = data[p : p + 100] if flags & 4 else b""
    p += 100 * bool(flags & 4) + 4 * bool(flags & 8)
    spare = int.from_bytes(data[p + 21 : p + 24], "big") if data[p : p + 4] in (b"LAME", b"Lavf", b"Lavc") else 0
    return *numbers, seek, (spare >> 12) + (spare & 0xFFF)


def checked_bytes(h: bytes, side: int) -> int:
    """Bytes behind the checksum that it covers: side information of Layer III, bit allocation of Layer I; 0 if not known."""
    layer, mode = 4 - (h[1] >> 1 & 3), h[3] >> 6
    if layer == 1:
        return 16 if mode == 3 else 32 if mode != 1 else (4 * ((h[3] >> 4 & 3) + 1) + 32) // 2
    return side


def read(data: bytes) -> dict:
    """Offsets, sizes, exact samples, checks, table and payload of a file."""
    at, tags = read_tags(data)
    first, end = at, len(data)
    # Where a closing tag may begin. What looks like one inside a frame is none: the tag is where the chain of frames ends.
    closing = end - 128 if end - at >= 128 and data[end - 128 : end - 125] == b"TAG" else end
    ends = {closing, ape_tag(data, at, closing), ape_tag(data, at, end)} - {end}
    offsets, samples, ok, failed, skipped, hertz, table, payload = [], 0, 0, 0, 0, 0, None, []
    while at + 4 <= end:
        h = header(data[at : at + 4])
        after = at + h[0] if h else 0
        like = after + 4 <= end and header(data[after : after + 4]) and not (data[after + 1] ^ data[at + 1]) & 0xFE and not (data[after + 2] ^ data[at + 2]) & 0x0C
        whole = h and after <= end and (like or after in ends or after + 4 > end)
        if at in ends and not whole:
            break
        if not whole:
            stop = min([x for x in ends if x > at], default=end)
            step = data.find(b"\xff", at + 1, stop)
            step = stop if step < 0 else step
            skipped, at = skipped + step - at, step
            continue
        size, n, rate, side, checked = h
        lead = 4 + 2 * checked + side
        found = read_table(data, at, lead) if table is None and not offsets else None
        if found:
            table = found
        else:
            covered = checked_bytes(data[at : at + 4], side) if checked else 0
            if covered:
                good = crc16(data[at + 2 : at + 4] + data[at + 6 : at + 6 + covered]) == int.from_bytes(data[at + 4 : at + 6], "big")
                ok, failed = ok + good, failed + (not good)
            offsets.append(at)
            samples, hertz = samples + n, hertz or rate
            payload.append(data[at + lead : at + min(size, lead + UNIT)])
        at = after
    return {
        "tags": tags, "first": first, "offsets": offsets, "samples": max(0, samples - (table[3] if table else 0)), "hertz": hertz, "crc_ok": ok,
        "crc_failed": failed, "skipped": skipped, "table": table, "payload": b"".join(payload),
    }


MEDIA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("media", T.BinaryType())])
FOUND = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload_sha256", T.StringType()), T.StructField("tail_crc32", T.LongType()), T.StructField("media_bytes", T.LongType()),
    T.StructField("media_sha256", T.StringType()), T.StructField("feature", T.StringType()), T.StructField("samples", T.LongType()),
    T.StructField("sample_rate", T.IntegerType()), T.StructField("duration_s", T.DoubleType()), T.StructField("crc_ok", T.LongType()),
    T.StructField("crc_failed", T.LongType()), T.StructField("skipped_bytes", T.LongType()), T.StructField("frame_offsets", T.ArrayType(T.LongType())),
])


def to_media(docs: DataFrame) -> DataFrame:
    """doc_id and the file that carries the document's text."""

    def run(ids, texts):
        for i, t in zip(ids, texts, strict=True):
            raw = (t or "").encode()
            yield i, write(raw.ljust(max(UNIT, -(-len(raw) // UNIT) * UNIT), b" "), len(raw))

    return map_rows(docs, ["doc_id", "text"], run, MEDIA)


def from_media(media: DataFrame) -> DataFrame:
    """What the stored bytes hold: payload digests, duration, checks and frame seek offsets."""

    def run(ids, files):
        for i, data in zip(ids, files, strict=True):
            data = data or b""
            x = read(data)
            p, table = x["payload"], x["table"]
            counted = "none" if table is None else "right" if table[0] == len(x["offsets"]) and table[1] == len(data) - x["first"] else "wrong"
            feature = f"{len(x['offsets'])} frames; {x['samples']}/{x['hertz']} s; crc {x['crc_ok']} ok, {x['crc_failed']} failed; table {counted}; skipped {x['skipped']}"
            yield (
                i, int(x["tags"].get("payload_bytes", len(p))), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:]), len(data),
                hashlib.sha256(data).hexdigest(), feature, x["samples"], x["hertz"], x["samples"] / x["hertz"] if x["hertz"] else 0.0,
                x["crc_ok"], x["crc_failed"], x["skipped"], x["offsets"],
            )

    return map_rows(media, ["doc_id", "media"], run, FOUND)
