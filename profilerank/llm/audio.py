"""Audio columns: MPEG-1 Layer III streams that carry a payload, and a reader for such streams.

``read`` walks a stream as a player does: it skips an ID3v2 tag, looks for frame headers (eleven set bits, valid
fields, and a second header where the first says the frame ends), checks the CRC of protected frames, reads the
table of a Xing or Info frame, and resynchronises byte by byte after damage. It gives the exact duration (samples
and sample rate, no rounding) and the offset of every frame.

``write`` stores bytes without loss. Every frame is protected and silent (its side information codes no samples), and
the rest of the frame, the ancillary data that decoders skip, holds the payload. All frames have the highest bit rate
but the last, which takes the lowest that fits, so the stream has a variable bit rate and starts with a Xing frame.
"""

from __future__ import annotations

import hashlib
import zlib

from pyspark.sql import DataFrame

from .common import fields, map_texts

# Fixed values of the format, MPEG-1 Layer III: kbit/s by index, Hz by index, samples in a frame, side information of a
# mono and of a stereo frame.
BIT_RATES = (0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320)
SAMPLE_RATES = (44100, 48000, 32000)
FRAME_SAMPLES = 1152
SIDE_MONO, SIDE_STEREO = 17, 32
CRC_POLYNOMIAL, CRC_START = 0x8005, 0xFFFF

#: The last bytes of the payload with a checksum of their own, and what the payload is padded to.
BLOCK = 64


def _crc_table() -> list[int]:
    table = []
    for value in range(256):
        crc = value << 8
        for _ in range(8):
            crc = (crc << 1 ^ CRC_POLYNOMIAL if crc & 0x8000 else crc << 1) & 0xFFFF
        table.append(crc)
    return table


_CRC = _crc_table()


def crc16(data: bytes) -> int:
    crc = CRC_START
    for byte in data:
        crc = (crc << 8 ^ _CRC[crc >> 8 ^ byte]) & 0xFFFF
    return crc


def frame_length(bit_rate: int, sample_rate: int, padded: int) -> int:
    return 144 * bit_rate * 1000 // sample_rate + padded


def _start_of_frame(rate_index: int) -> bytes:
    """Header, CRC and side information of a protected silent mono frame at 32,000 Hz."""
    header = bytes((0xFF, 0xFA, rate_index << 4 | 2 << 2, 3 << 6))
    side = bytes(SIDE_MONO)
    return header + crc16(header[2:] + side).to_bytes(2, "big") + side


_RATE = SAMPLE_RATES[2]
_STARTS = {i: _start_of_frame(i) for i in range(1, len(BIT_RATES))}
_ROOM = {i: frame_length(BIT_RATES[i], _RATE, 0) - len(_STARTS[i]) for i in _STARTS}
_TOP = len(BIT_RATES) - 1


def _synchsafe(number: int) -> bytes:
    return bytes(number >> shift & 0x7F for shift in (21, 14, 7, 0))


def _tag(payload: bytes) -> bytes:
    """An ID3v2.4 tag with one user text frame: length and CRC-32 of the payload."""
    text = b"\x03payload\x00%d:%08x" % (len(payload), zlib.crc32(payload))
    frame = b"TXXX" + _synchsafe(len(text)) + b"\x00\x00" + text
    return b"ID3\x04\x00\x00" + _synchsafe(len(frame)) + frame


def write(payload: bytes) -> bytes:
    """A stream that holds the payload. The empty payload is a tag and a Xing frame."""
    room, start = _ROOM[_TOP], _STARTS[_TOP]
    whole = len(payload) // room
    frames = [start + payload[i * room:(i + 1) * room] for i in range(whole)]
    rest = payload[whole * room:]
    if rest:
        index = next(i for i in sorted(_ROOM) if _ROOM[i] >= len(rest))
        frames.append(_STARTS[index] + rest + bytes(_ROOM[index] - len(rest)))
    index = next(i for i in sorted(_ROOM) if _ROOM[i] >= 120)
    first_length = len(_STARTS[index]) + _ROOM[index]
    total = first_length + sum(map(len, frames))
    offsets = [first_length]
    for frame in frames:
        offsets.append(offsets[-1] + len(frame))
    # Seek table: for each hundredth of the duration, the place of its frame in 256ths of the stream.
    seek = bytes(min(255, offsets[len(frames) * i // 100] * 256 // total) for i in range(100))
    xing = b"Xing" + (7).to_bytes(4, "big") + len(frames).to_bytes(4, "big") + total.to_bytes(4, "big") + seek
    return b"".join([_tag(payload), _STARTS[index], xing, bytes(_ROOM[index] - len(xing)), *frames])


def _header(stream: bytes, at: int) -> tuple[int, int, int, int, bool] | None:
    """(length, bit rate, sample rate, side information, protected) of the frame that starts here, if one does."""
    if at + 4 > len(stream) or stream[at] != 0xFF or stream[at + 1] & 0xFE != 0xFA:
        return None
    bits, third = stream[at + 2], stream[at + 3]
    rate, hertz = bits >> 4, bits >> 2 & 3
    if rate in (0, 15) or hertz == 3 or third & 3 == 2:
        return None
    length = frame_length(BIT_RATES[rate], SAMPLE_RATES[hertz], bits >> 1 & 1)
    return length, BIT_RATES[rate], SAMPLE_RATES[hertz], SIDE_MONO if third >> 6 == 3 else SIDE_STEREO, not stream[at + 1] & 1


def read(stream: bytes) -> dict:
    """What the stream says and holds. Damaged parts are skipped and counted, never an error.

    Keys: tag (dict of user texts), frames, offsets (of the audio frames), samples, sample_rate, bad_crc, skipped
    (bytes outside frames), variable (a Xing frame is there), declared_frames, payload.
    """
    out = {"tag": {}, "offsets": [], "samples": 0, "sample_rate": 0, "bad_crc": 0, "skipped": 0, "variable": False,
           "declared_frames": None}
    at, parts, checked, first = 0, [], {}, True
    if stream[:3] == b"ID3" and len(stream) >= 10:
        end = 10 + sum((stream[6 + i] & 0x7F) << shift for i, shift in enumerate((21, 14, 7, 0)))
        at = 10
        while at + 10 <= min(end, len(stream)) and stream[at]:
            size = sum((stream[at + 4 + i] & 0x7F) << shift for i, shift in enumerate((21, 14, 7, 0)))
            if stream[at:at + 4] == b"TXXX":
                name, _, value = stream[at + 11:at + 10 + size].partition(b"\x00")
                out["tag"][name.decode("utf-8", "replace")] = value.decode("utf-8", "replace")
            at += 10 + size
        at = end
    while at < len(stream):
        header = _header(stream, at)
        # A frame counts if it ends the stream or is followed by another one: payload bytes can look like a header.
        if header is None or at + header[0] > len(stream) or (
                at + header[0] < len(stream) and _header(stream, at + header[0]) is None and not _lone(stream, at, header)):
            found = stream.find(b"\xff", at + 1)
            out["skipped"] += (found if found >= 0 else len(stream)) - at
            at = found if found >= 0 else len(stream)
            continue
        length, _, hertz, side, protected = header
        body = at + 4 + 2 * protected + side
        if protected:
            covered = stream[at + 2:at + 4] + stream[at + 6:body]
            if covered not in checked:
                if len(checked) > 1000:
                    checked.clear()
                checked[covered] = crc16(covered)
            if checked[covered] != int.from_bytes(stream[at + 4:at + 6], "big"):
                out["bad_crc"] += 1
        if first and stream[body:body + 4] in (b"Xing", b"Info"):
            out["variable"] = stream[body:body + 4] == b"Xing"
            if stream[body + 7] & 1:
                out["declared_frames"] = int.from_bytes(stream[body + 8:body + 12], "big")
        else:
            out["offsets"].append(at)
            out["samples"] += FRAME_SAMPLES
            parts.append(stream[body:at + length])
        out["sample_rate"] = out["sample_rate"] or hertz
        first = False
        at += length
    data = b"".join(parts)
    size = out["tag"].get("payload", "").partition(":")[0]
    out["payload"] = data[:int(size)] if size.isdigit() else data
    out["frames"] = len(out["offsets"])
    return out


def _lone(stream: bytes, at: int, header: tuple) -> bool:
    """Whether a protected frame proves itself by its own CRC although damage follows."""
    body = at + 6 + header[3]
    return header[4] and crc16(stream[at + 2:at + 4] + stream[at + 6:body]) == int.from_bytes(stream[at + 4:at + 6], "big")


def padded(text: bytes | None) -> bytes:
    """The bytes with zeros up to a positive multiple of 64; null is empty."""
    text = text or b""
    return text + bytes(-len(text) % BLOCK or (0 if text else BLOCK))


def to_audio(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, media binary): every whole text as an audio stream. Null is the empty text; repeated rows are rows of their own."""
    return map_texts(docs, id_col, text_col, lambda: lambda texts: [[write(padded(t)) for t in texts]], fields("media binary"))


def audio_facts(media: DataFrame, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """(id, frames, samples, sample_rate, offsets, bad_crc, skipped, payload) of every stream; a null stream is empty."""
    def setup():
        def work(streams):
            found = [read(s or b"") for s in streams]
            return [[f[k] for f in found] for k in ("frames", "samples", "sample_rate", "offsets", "bad_crc", "skipped", "payload")]

        return work

    return map_texts(media, id_col, media_col, setup, fields(
        "frames int, samples bigint, sample_rate int, offsets array<bigint>, bad_crc int, skipped bigint, payload binary"))


def media_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every text written as a stream, the stream read back, and what was read: sizes, digests, duration, offsets.

    One pass, no shuffle; payload and stream do not leave the task. Null is the empty text, whose payload is 64 zeros.
    Repeated rows and ids are rows of their own; equal texts have equal values.
    The feature holds frames, duration as samples/rate, CRC errors, skipped bytes and a digest of the frame offsets.
    """
    def setup():
        def work(texts):
            out: list[list] = [[] for _ in range(9)]
            for text in texts:
                media = write(padded(text))
                got = read(media)
                payload, offsets = got["payload"], got["offsets"]
                marks = hashlib.sha256(",".join(map(str, offsets)).encode()).hexdigest()[:16]
                row = (len(text or b""), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-BLOCK:]), len(media),
                       hashlib.sha256(media).hexdigest(),
                       f"mp3 frames={got['frames']}/{got['declared_frames']} duration={got['samples']}/{got['sample_rate']}s "
                       f"vbr={int(got['variable'])} bad_crc={got['bad_crc']} skipped={got['skipped']} offsets={marks}",
                       got["samples"], offsets)
                for column, value in zip(out, row):
                    column.append(value)
            return out

        return work

    return map_texts(docs, id_col, text_col, setup, fields(
        "n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, "
        "media_sha256 string, feature string, duration_samples bigint, frame_offsets array<bigint>"))
