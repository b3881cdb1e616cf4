"""Media columns (operator 5): PNG files in binary columns, read back and hashed.

write_png() frames 8-bit grey samples as PNG chunks (length, type, data, CRC-32) around one zlib
stream, each row under the filter that suits it best; read_png() walks the chunks, tests every
checksum, inflates, and undoes the five row filters with numpy. feature() is a low-frequency cosine-transform hash: the samples are averaged
onto a 32 by 32 grid, transformed, and the 8 by 8 lowest frequencies (without the mean) are
compared with their median, 64 bits in all.

Nulls count as empty texts; an empty text is stored as 576 bytes of 255. Equal texts, also of repeated
rows, give equal files and features; frequencies equal to the median have a bit of 0. An empty table
gives an empty table, null ids stay null, and columns of any other name are left out. Rows are handled
one at a time and leave in parts of bounded bytes, so memory is bounded by the longest text.
"""

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common
from tidemark.llm.common import slices

#: The contract's row width: payloads are padded to a positive multiple of this.
WIDTH = 576
PAD = 255
SIGNATURE = b"\x89PNG\r\n\x1a\n"
GRID, LOW = 32, 8


def payload(data: bytes) -> bytes:
    return data + bytes([PAD]) * (-len(data) % WIDTH or (0 if data else WIDTH))


def chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(data, zlib.crc32(kind)))


def predicted(kind: int, left: np.ndarray, above: np.ndarray, corner: np.ndarray) -> np.ndarray:
    """What each filter expects of samples from their neighbours (16-bit numbers): none, left, above, their mean, the nearest of three."""
    if kind == 0:
        return np.zeros_like(left)
    if kind in (1, 2):
        return left if kind == 1 else above
    if kind == 3:
        return (left + above) >> 1
    a, b, c = np.abs(above - corner), np.abs(left - corner), np.abs(left + above - 2 * corner)
    return np.where((a <= b) & (a <= c), left, np.where(b <= c, above, corner))


def write_png(samples: np.ndarray, level: int = 1) -> bytes:
    """A grey 8-bit PNG. Each row takes the filter whose differences are least in sum, as signed numbers; of equal ones the first."""
    rows, width = samples.shape
    x = samples.astype(np.int16)
    left, above, corner = np.zeros_like(x), np.zeros_like(x), np.zeros_like(x)
    left[:, 1:], above[1:], corner[1:, 1:] = x[:, :-1], x[:-1], x[:-1, :-1]
    rest = np.stack([(x - predicted(k, left, above, corner)).astype(np.uint8) for k in range(5)])
    kinds = np.abs(rest.view(np.int8).astype(np.int16)).sum(axis=2, dtype=np.int64).argmin(axis=0)
    raw = np.empty((rows, width + 1), dtype=np.uint8)
    raw[:, 0], raw[:, 1:] = kinds, rest[kinds, np.arange(rows)]
    return SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", width, rows, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw.tobytes(), level)) + chunk(b"IEND", b"")


def chunks(png: bytes):
    """(type, data) of every chunk; ValueError where a checksum or the frame is wrong."""
    if png[:8] != SIGNATURE:
        raise ValueError("not a PNG")
    at = 8
    while at < len(png):
        if at + 12 > len(png):
            raise ValueError("cut short")
        n, kind = struct.unpack(">I4s", png[at : at + 8])
        data = png[at + 8 : at + 8 + n]
        if len(data) < n or png[at + 8 + n : at + 12 + n] != struct.pack(">I", zlib.crc32(data, zlib.crc32(kind))):
            raise ValueError(f"checksum of {kind!r}")
        yield kind, data
        at += 12 + n
        if kind == b"IEND":
            return
    raise ValueError("no end chunk")


def unfilter(images: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """Undo the filters of 8-bit grey images of one width, each given as (kind of every row, rows).

    Kinds: 0 none, 1 left, 2 above, 3 mean of both, 4 nearest of three. A sample needs its left, upper and
    corner neighbours, which stand on the two diagonals before its own, so all samples of a diagonal are
    undone at a time, those of all images together. Images without filters are given back as they are.
    """
    for kinds, _ in images:
        if len(kinds) and kinds.max() > 4:
            raise ValueError(f"filter {kinds.max()}")
    some = [k for k, (kinds, _) in enumerate(images) if kinds.any()]
    out = [rows for _, rows in images]
    if not some:
        return out
    counts = np.array([len(out[k]) for k in some])
    width = out[some[0]].shape[1]
    begin = np.cumsum(counts + 1) - counts  # of each image, below a row of zeros
    depth = np.concatenate([np.arange(n) for n in counts])
    place = np.repeat(begin, counts) + depth
    kinds = np.concatenate([images[k][0] for k in some])
    rows = np.concatenate([out[k] for k in some])
    # by depth, so that the rows of a diagonal stand together
    order = np.argsort(depth, kind="stable")
    depth, place, kinds, rows = depth[order], place[order], kinds[order], rows[order]
    edges = np.searchsorted(depth, np.arange(counts.max() + 1))
    done = np.zeros((int((counts + 1).sum()), width + 1), dtype=np.int16)
    flat, line = done.reshape(-1), width + 1
    for d in range(width + int(counts.max()) - 1):
        low, high = edges[max(0, d - width + 1)], edges[min(int(counts.max()), d + 1)]
        column = d - depth[low:high]
        at = place[low:high] * line + column + 1
        left, up, corner = flat[at - 1], flat[at - line], flat[at - line - 1]
        kind = kinds[low:high]
        guess = np.select([kind == 0, kind == 1, kind == 2, kind == 3], [0, left, up, (left + up) >> 1], predicted(4, left, up, corner))
        flat[at] = (rows[np.arange(low, high), column] + guess) & 255
    for k, b, n in zip(some, begin.tolist(), counts.tolist(), strict=True):
        out[k] = done[b : b + n, 1:].astype(np.uint8)
    return out


def filtered_rows(png: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The filter of every row and the rows as stored of an 8-bit grey PNG, every checksum tested."""
    head, body = None, []
    for kind, data in chunks(png):
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", data)
        elif kind == b"IDAT":
            body.append(data)
    if head is None or head[2:] != (8, 0, 0, 0, 0):
        raise ValueError("not a plain 8-bit grey PNG")
    width, rows = head[:2]
    flat = zlib.decompress(b"".join(body))
    if len(flat) != rows * (width + 1):
        raise ValueError("wrong number of samples")
    raw = np.frombuffer(flat, dtype=np.uint8).reshape(rows, width + 1)
    return raw[:, 0], raw[:, 1:]


def read_png(png: bytes) -> np.ndarray:
    """The samples of an 8-bit grey PNG."""
    return unfilter([filtered_rows(png)])[0]


def cosines(n: int, low: int) -> np.ndarray:
    """The first rows of the orthonormal cosine transform of n points."""
    k, x = np.arange(low)[:, None], np.arange(n)[None, :]
    return np.cos(np.pi * k * (2 * x + 1) / (2 * n)) * np.where(k == 0, np.sqrt(1 / n), np.sqrt(2 / n))


LOWEST = cosines(GRID, LOW)


def feature(samples: np.ndarray) -> str:
    """16 hex digits; the mean's bit is 0. Images with fewer rows than the grid repeat rows."""
    rows, width = samples.shape
    across = samples.reshape(rows, GRID, -1).mean(axis=2) if width % GRID == 0 else np.stack([c.mean(axis=1) for c in np.array_split(samples, GRID, axis=1)], axis=1)
    if rows < GRID:
        grid = across[np.arange(GRID) * rows // GRID]
    else:
        cuts = np.arange(GRID) * rows // GRID
        grid = np.add.reduceat(across, cuts, axis=0) / np.diff(np.append(cuts, rows))[:, None]
    low = np.round(LOWEST @ grid @ LOWEST.T, 6).ravel()
    bits = low > np.median(low[1:])
    bits[0] = False
    return np.packbits(bits).tobytes().hex()


FIELDS = [("n_bytes", pa.int64(), "long"), ("media", pa.binary(), "binary"), ("payload", pa.binary(), "binary"), ("feature", pa.string(), "string")]


def store(texts: list[str]) -> list[tuple]:
    """Of every text: unpadded length, the PNG, the payload as read back from the PNG, and its feature."""
    data = [text.encode("utf-8", "replace") for text in texts]
    pngs = [write_png(np.frombuffer(payload(d), dtype=np.uint8).reshape(-1, WIDTH)) for d in data]
    read = unfilter([filtered_rows(png) for png in pngs])
    return [(len(d), png, samples.tobytes(), feature(samples)) for d, png, samples in zip(data, pngs, read, strict=True)]


def media(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_bytes, media (the PNG), payload (read back from it) and feature of every row."""
    return _mapped(docs, id_column, text_column, FIELDS, lambda row: row)


def digests(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The same rows with files and payloads hashed where they are made."""

    def digest(row: tuple) -> tuple:
        n, png, back, mark = row
        return n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-32:]), len(png), hashlib.sha256(png).hexdigest(), mark

    long, string = (pa.int64(), "long"), (pa.string(), "string")
    fields = [("n_bytes", *long), ("payload_bytes", *long), ("payload_sha256", *string), ("tail_crc32", *long), ("media_bytes", *long), ("media_sha256", *string), ("feature", *string)]
    return _mapped(docs, id_column, text_column, fields, digest)


def _mapped(docs: DataFrame, id_column: str, text_column: str, fields: list, finish) -> DataFrame:
    kept = docs.select(F.col(id_column).alias("doc_id"), common.text_or_empty(text_column).alias("text"))

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):  # files of many texts at once would fill memory
                rows = [finish(row) for row in store(part.column(1).to_pylist())]
                columns = [pa.array(c, kind) for c, (_, kind, _) in zip(zip(*rows, strict=True), fields, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], ["doc_id", *[name for name, _, _ in fields]])

    kind = kept.schema["doc_id"].dataType.simpleString()
    return kept.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{name} {sql}" for name, _, sql in fields))


def op5_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text stored as PNG, read back, and described."""
    return digests(common.table(spark, sf_dir, "documents"))
