"""ISO base media containers in a binary column.

``pack`` stores bytes losslessly as the samples of one track of 8-bit units:
frames of FRAME bytes in chunks, with a sync sample every GROUP frames, and the
tables that say so (sample sizes, samples per chunk, chunk offsets, times, sync
samples). ``probe`` walks nested boxes of any such file, decodes the sample
tables and the runs of fragments and gives codec, duration and the byte ranges of
the key frames of the main track, which is the first video track or else the first; sample
payloads are never decoded, only addressed. Numbers of samples are bounded by the
bytes of the file before anything is made of them.

Defined results: null bytes count as empty; the payload is padded with bytes 0
to a positive multiple of 64, so no file is without samples. A truncated or
malformed file gives ``error`` and null fields instead of a failure. Boxes of
unknown kind are skipped, 64-bit sizes and boxes up to the end of the file are
read. Equal payloads give equal files: times in headers are 0.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import add_columns

UNIT = 64  # the payload is a multiple of this
FRAME = 1024  # bytes of a sample; the last one may be shorter
PER_CHUNK = 4  # samples of a chunk
GROUP = 8  # every so many samples one is a key frame
TIMESCALE = 8000
CODEC = b"raw "

#: Boxes that hold boxes.
CONTAINERS = {b"moov", b"trak", b"mdia", b"minf", b"stbl", b"dinf", b"edts", b"udta", b"mvex", b"moof", b"traf"}
MAX_DEPTH = 12


class Malformed(ValueError):
    pass


def _box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    return struct.pack(">I4s", len(body) + 8, kind) + body


def _full(kind: bytes, *parts: bytes, flags: int = 0) -> bytes:
    return _box(kind, struct.pack(">I", flags), *parts)


_UNITY = struct.pack(">9I", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)


def padded(data: bytes) -> bytes:
    return data + b"\0" * (max(UNIT, -(-len(data) // UNIT) * UNIT) - len(data))


def pack(payload: bytes) -> bytes:
    """One file with the payload (of 1 byte or more) as its samples."""
    if not payload:
        raise ValueError("no payload")
    n = -(-len(payload) // FRAME)
    last = len(payload) - (n - 1) * FRAME
    n_chunks = -(-n // PER_CHUNK)
    duration = len(payload)  # a tick for each unit
    times = [(n - 1, FRAME), (1, last)] if n > 1 and last != FRAME else [(n, FRAME if n > 1 else last)]
    sizes = struct.pack(">II", FRAME, n) if last == FRAME else struct.pack(f">II{n}I", 0, n, *[FRAME] * (n - 1), last)
    rest = n - (n_chunks - 1) * PER_CHUNK
    runs = [(1, PER_CHUNK, 1)] if rest == PER_CHUNK else [(1, rest, 1)] if n_chunks == 1 else [(1, PER_CHUNK, 1), (n_chunks, rest, 1)]
    sync = list(range(1, n + 1, GROUP))
    ftyp = _box(b"ftyp", b"isom", struct.pack(">I", 512), b"isomiso2mp41")

    def moov(data_at: int) -> bytes:
        offsets = [data_at + i * PER_CHUNK * FRAME for i in range(n_chunks)]
        if data_at + len(payload) < 1 << 32:
            chunks = _full(b"stco", struct.pack(f">I{n_chunks}I", n_chunks, *offsets))
        else:
            chunks = _full(b"co64", struct.pack(f">I{n_chunks}Q", n_chunks, *offsets))
        entry = _box(CODEC, b"\0" * 6, struct.pack(">H", 1), struct.pack(">8x4HI", 1, 8, 0, 0, TIMESCALE << 16))
        stbl = _box(
            b"stbl",
            _full(b"stsd", struct.pack(">I", 1), entry),
            _full(b"stts", struct.pack(">I", len(times)), *[struct.pack(">II", *t) for t in times]),
            _full(b"stss", struct.pack(f">I{len(sync)}I", len(sync), *sync)),
            _full(b"stsc", struct.pack(">I", len(runs)), *[struct.pack(">III", *r) for r in runs]),
            _full(b"stsz", sizes),
            chunks,
        )
        media = _box(
            b"mdia",
            _full(b"mdhd", struct.pack(">IIIIHH", 0, 0, TIMESCALE, duration & 0xFFFFFFFF, 0x55C4, 0)),
            _full(b"hdlr", struct.pack(">I4s12x", 0, b"soun"), b"\0"),
            _box(b"minf", _full(b"smhd", b"\0" * 4), _box(b"dinf", _full(b"dref", struct.pack(">I", 1), _full(b"url ", flags=1))), stbl),
        )
        track = _full(b"tkhd", struct.pack(">IIIII8xHHHH", 0, 0, 1, 0, duration & 0xFFFFFFFF, 0, 0, 0x100, 0), _UNITY, struct.pack(">II", 0, 0), flags=7)
        head = _full(b"mvhd", struct.pack(">IIIIIHH8x", 0, 0, TIMESCALE, duration & 0xFFFFFFFF, 0x10000, 0x100, 0), _UNITY, b"\0" * 24, struct.pack(">I", 2))
        return _box(b"moov", head, _box(b"trak", track, media))

    long_mdat = len(payload) + 8 >= 1 << 32
    header = 16 if long_mdat else 8
    head = moov(0)
    head = moov(len(ftyp) + len(head) + header)
    mdat = struct.pack(">I4sQ", 1, b"mdat", len(payload) + 16) if long_mdat else struct.pack(">I4s", len(payload) + 8, b"mdat")
    return b"".join((ftyp, head, mdat, payload))


def boxes(data: memoryview, start: int = 0, end: int | None = None, depth: int = 0, path: tuple = ()):
    """(path, start of body, end) of every box, containers before their content."""
    end = len(data) if end is None else end
    at = start
    while at + 8 <= end:
        size, kind = struct.unpack_from(">I4s", data, at)
        body = at + 8
        if size == 1:
            if at + 16 > end:
                raise Malformed("cut within a box's size")
            (size,) = struct.unpack_from(">Q", data, body)
            body += 8
        elif size == 0:
            size = end - at
        if size < body - at or at + size > end:
            raise Malformed(f"box at {at} doesn't fit")
        here = (*path, kind)
        yield here, body, at + size
        if kind in CONTAINERS and depth < MAX_DEPTH:
            yield from boxes(data, body, at + size, depth + 1, here)
        at += size
    if at != end and end - at >= 8:
        raise Malformed("bytes after the last box")


def _table(data, body: int, end: int, fmt: str, skip: int = 0) -> list[tuple]:
    """Entries of a full box that begins with their number."""
    if body + 8 + skip > end:
        raise Malformed("cut table")
    (n,) = struct.unpack_from(">I", data, body + 4 + skip)
    size = struct.calcsize(fmt)
    if body + 8 + skip + n * size > end:
        raise Malformed("cut table")
    return list(struct.iter_unpack(fmt, data[body + 8 + skip : body + 8 + skip + n * size]))


class Track:
    """A track's tables: codec, timescale, sample offsets, sizes, times, sync; and its fragments."""

    def __init__(self) -> None:
        self.codec = self.handler = ""
        self.id = self.timescale = self.duration = 0
        self.sizes: list[int] = []
        self.runs: list[tuple] = []
        self.chunks: list[int] = []
        self.times: list[tuple] = []
        self.sync: list[int] | None = None
        self.defaults = (0, 0, 0)  # duration, size and flags of samples in fragments
        #: (offset, length, duration, whether a key frame) of the samples in fragments
        self.fragments: list[tuple[int, int, int, bool]] = []

    def read(self, kind: bytes, data, body: int, end: int) -> None:
        if kind == b"tkhd":
            (self.id,) = struct.unpack_from(">I", data, body + (20 if data[body] == 1 else 12))
        elif kind == b"mdhd":
            if data[body] == 1:
                self.timescale, self.duration = struct.unpack_from(">IQ", data, body + 20)
            else:
                self.timescale, self.duration = struct.unpack_from(">II", data, body + 12)
        elif kind == b"hdlr":
            self.handler = bytes(data[body + 8 : body + 12]).decode("latin-1")
        elif kind == b"stsd":
            self.codec = bytes(data[body + 12 : body + 16]).decode("latin-1")
        elif kind == b"stsz":
            one, n = struct.unpack_from(">II", data, body + 4)
            if one * n > len(data):
                raise Malformed("more samples than bytes")
            self.sizes = [one] * n if one else [x for (x,) in _table(data, body, end, ">I", 4)]
        elif kind == b"stsc":
            self.runs = _table(data, body, end, ">III")
        elif kind in (b"stco", b"co64"):
            self.chunks = [x for (x,) in _table(data, body, end, ">I" if kind == b"stco" else ">Q")]
        elif kind == b"stts":
            self.times = _table(data, body, end, ">II")
        elif kind == b"stss":
            self.sync = [x for (x,) in _table(data, body, end, ">I")]

    def ranges(self) -> list[tuple[int, int]]:
        """(offset, length) of every sample, from chunks and sizes, and then of the fragments."""
        out, sample, last = [], 0, 0
        for i, (first, per, _) in enumerate(self.runs):
            until = self.runs[i + 1][0] if i + 1 < len(self.runs) else len(self.chunks) + 1
            if not (last < first <= until <= len(self.chunks) + 1 and per):
                raise Malformed("runs of chunks out of order")
            last = first
            for chunk in range(first, until):
                at = self.chunks[chunk - 1]
                for size in self.sizes[sample : sample + per]:
                    out.append((at, size))
                    at += size
                sample += per
        if len(out) != len(self.sizes):
            raise Malformed("chunks and sizes don't agree")
        return out + [(at, size) for at, size, _, _ in self.fragments]

    def keyframes(self, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """Those of ``ranges`` that start a group; all where no table says otherwise."""
        own = ranges[: len(self.sizes)]
        keys = own if self.sync is None else [own[i - 1] for i in self.sync if 0 < i <= len(own)]
        return keys + [(at, size) for at, size, _, key in self.fragments if key]

    def seconds(self) -> float | None:
        ticks = self.duration or sum(n * d for n, d in self.times) + sum(f[2] for f in self.fragments)
        return ticks / self.timescale if self.timescale else None


class _Fragment:
    """The place of a track fragment while its runs are read; flags are those of ISO/IEC 14496-12."""

    def __init__(self, data, body: int, moof: int, tracks: list[Track]):
        flags, track = struct.unpack_from(">II", data, body)
        self.track = next((t for t in tracks if t.id == track), None)
        if self.track is None:
            raise Malformed("fragment of no track")
        at = body + 8
        self.base = moof
        if flags & 0x1:
            (self.base,) = struct.unpack_from(">Q", data, at)
            at += 8
        at += 4 * bool(flags & 0x2)
        given = list(self.track.defaults)
        for i, bit in enumerate((0x8, 0x10, 0x20)):
            if flags & bit:
                (given[i],) = struct.unpack_from(">I", data, at)
                at += 4
        self.defaults, self.next = tuple(given), self.base

    def run(self, data, body: int, end: int) -> None:
        flags, n = struct.unpack_from(">II", data, body)
        at, start, first = body + 8, self.next, None
        if flags & 0x1:
            start = self.base + struct.unpack_from(">i", data, at)[0]
            at += 4
        if flags & 0x4:
            (first,) = struct.unpack_from(">I", data, at)
            at += 4
        bits = [b for b in (0x100, 0x200, 0x400, 0x800) if flags & b]
        # a run without entries of its own is bounded by the bytes of its samples
        if at + 4 * len(bits) * n > end or not flags & 0x200 and self.defaults[1] * n > len(data) or n > len(data):
            raise Malformed("more samples than bytes")
        for i in range(n):
            duration, size, flag = self.defaults
            if i == 0 and first is not None:
                flag = first
            for b in bits:
                (x,) = struct.unpack_from(">I", data, at)
                at += 4
                duration, size, flag = (x if b == 0x100 else duration, x if b == 0x200 else size, x if b == 0x400 else flag)
            self.track.fragments.append((start, size, duration, not flag & 0x10000))
            start += size
        self.next = start


def parse(data: bytes) -> list[Track]:
    """The tracks of a file."""
    view, tracks, fragment, moof = memoryview(data), [], None, 0
    try:
        for path, body, end in boxes(view):
            if path[-1] == b"trak":
                tracks.append(Track())
            elif tracks and b"trak" in path:
                tracks[-1].read(path[-1], view, body, end)
            elif path[-1] == b"trex":
                track, _, *given = struct.unpack_from(">5I", view, body + 4)
                for t in tracks:
                    if t.id == track:
                        t.defaults = tuple(given)
            elif path[-1] == b"moof":
                moof, fragment = body - 8, None
            elif path[-1] == b"tfhd":
                fragment = _Fragment(view, body, moof, tracks)
            elif path[-1] == b"trun":
                if fragment is None:
                    raise Malformed("run outside a fragment")
                fragment.run(view, body, end)
    except (struct.error, IndexError) as e:
        raise Malformed(str(e)) from e
    if not tracks:
        raise Malformed("no track")
    return tracks


def main_track(tracks: list[Track]) -> Track:
    """The first video track, or else the first track."""
    return next((t for t in tracks if t.handler == "vide"), tracks[0])


PROBE = [
    ("codec", "string"),
    ("duration", "double"),
    ("n_samples", "int"),
    ("keyframes", "array<struct<offset:long,length:long>>"),
    ("error", "string"),
]


def probe_bytes(data: bytes) -> tuple:
    """codec, duration in seconds, number of samples, key frames, error; of the main track."""
    try:
        track = main_track(parse(data))
        ranges = track.ranges()
        if any(a < 0 or a + n > len(data) for a, n in ranges):
            raise Malformed("samples beyond the end")
        return track.codec, track.seconds(), len(ranges), track.keyframes(ranges), None
    except (Malformed, struct.error, IndexError) as e:
        return None, None, None, None, str(e) or "malformed"


def payload(data: bytes) -> bytes:
    """The samples of the main track, read by their byte ranges."""
    view = memoryview(data)
    return b"".join(view[a : a + n] for a, n in main_track(parse(data)).ranges())


def store(df: DataFrame, text: str = "text", media: str = "media") -> DataFrame:
    """Add a file of each text's UTF-8 bytes, padded."""

    def make():
        def f(texts):
            return [pa.array([pack(padded((t or "").encode())) for t in texts.to_pylist()], pa.binary())]

        return f

    return add_columns(df, [text], [(media, "binary")], make)


def probe(df: DataFrame, media: str = "media") -> DataFrame:
    """Add codec, duration, n_samples, keyframes and error of each file."""

    def make():
        kinds = [pa.string(), pa.float64(), pa.int32(), pa.list_(pa.struct([("offset", pa.int64()), ("length", pa.int64())])), pa.string()]

        def f(files):
            rows = [probe_bytes(x or b"") for x in files.to_pylist()]
            columns = [list(c) for c in zip(*rows, strict=True)]
            columns[3] = [None if k is None else [{"offset": a, "length": n} for a, n in k] for k in columns[3]]
            return [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]

        return f

    return add_columns(df, [media], PROBE, make)


def read_back(df: DataFrame, media: str = "media") -> DataFrame:
    """Add payload_bytes, payload_sha256 and tail_crc32 of the stored samples."""

    def make():
        def f(files):
            rows = []
            for x in files.to_pylist():
                try:
                    p = payload(x or b"")
                    rows.append((len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-UNIT:])))
                except Malformed:
                    rows.append((None, None, None))
            n, sha, crc = zip(*rows, strict=True)
            return [pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array(crc, pa.int64())]

        return f

    return add_columns(df, [media], [("payload_bytes", "long"), ("payload_sha256", "string"), ("tail_crc32", "long")], make)


def media_digest(docs: DataFrame) -> DataFrame:
    """Of every text: payload and file digests, and a feature string of the tables."""
    stored = store(docs.select("doc_id", "text"))
    got = read_back(probe(stored))
    ranges = F.array_join(F.transform("keyframes", lambda k: F.concat_ws("+", k["offset"], k["length"])), ",")
    return got.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "payload_bytes",
        "payload_sha256",
        "tail_crc32",
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        F.concat_ws(";", F.concat(F.lit("codec="), F.trim("codec")), F.format_string("duration=%.6f", "duration"), F.concat(F.lit("samples="), "n_samples"), F.concat(F.lit("keyframes="), ranges)).alias("feature"),
    )
