"""SentencePiece encoding and decoding with byte offsets (operator 10).

The model's own normaliser is replaced by one that remembers where every normalised byte came
from: each step takes the longest prefix that the model's compiled character map knows (or one
character where it knows none), then white space is escaped and the dummy prefix added. The
normalised text is segmented by the library with normalisation switched off, and the pieces'
byte lengths, laid end to end over the alignment, give each piece's span in the original bytes.

No piece of a model usually holds a word boundary inside it; merges then never cross one, so
words are segmented once and remembered (a bounded table). Models that do have such pieces are
segmented text by text. Decoding is the library's own.

Nulls count as empty texts; an empty text has the end id alone. Repeated rows give repeated results, null
ids stay null, an empty table gives an empty table, and columns of any other name are left out. Of
equally good merges the library takes the leftmost. Texts are taken in parts of bounded bytes, so
memory is bounded by the longest text.
"""

import hashlib
import re
import struct
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common
from tidemark.llm.common import slices

SPACE = "▁"
#: Segmented words remembered by a Python worker at most (it starts anew when full).
REMEMBERED = 150_000


class CharsMap:
    """The model's compiled character map: a double-array trie over UTF-8, then the strings."""

    def __init__(self, blob: bytes):
        size = struct.unpack("<I", blob[:4])[0] if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], dtype="<u4").tolist() if blob else []
        self.out = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest known prefix at a place, and what replaces it."""
        if not self.units:
            return None
        units, node, best = self.units, 0, None
        node ^= (units[0] >> 10) << ((units[0] & 512) >> 6)
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != data[i]:
                break
            node ^= (unit >> 10) << ((unit & 512) >> 6)
            if unit >> 8 & 1:
                value = units[node] & 0x7FFFFFFF
                best = i + 1 - at, self.out[value : self.out.index(b"\0", value)]
        return best


def char_bytes(lead: int) -> int:
    return 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4


class Pieces:
    """One model: align(text), encode(text) -> ids and byte spans, decode(ids)."""

    def __init__(self, model: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        spec = proto.ModelProto()
        spec.ParseFromString(model)
        rules = spec.normalizer_spec
        self.chars = CharsMap(rules.precompiled_charsmap)
        self.dummy, self.squeeze, self.escape = rules.add_dummy_prefix, rules.remove_extra_whitespaces, rules.escape_whitespaces
        self.plain = not self.chars.units and not self.squeeze and self.escape and self.dummy and not spec.trainer_spec.treat_whitespace_as_suffix
        self.suffix = spec.trainer_spec.treat_whitespace_as_suffix
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        rules.add_dummy_prefix = rules.remove_extra_whitespaces = rules.escape_whitespaces = False
        rules.precompiled_charsmap, rules.name = b"", "identity"
        self.segmenter = sentencepiece.SentencePieceProcessor(model_proto=spec.SerializeToString())
        pieces = [p.piece for p in spec.pieces]
        kinds = [p.type for p in spec.pieces]
        self.lengths = np.array([1 if k == 6 else len(p.encode()) for p, k in zip(pieces, kinds, strict=True)], dtype=np.int64)
        self.names = [str(i) for i in range(len(pieces))]
        marks = np.array([0 if k == 6 else p.count(SPACE) for p, k in zip(pieces, kinds, strict=True)], dtype=np.int64)
        self.plain_lengths = self.lengths - marks * (len(SPACE.encode()) - 1)
        self.end = self.library.eos_id()
        usual = [p for p, k in zip(pieces, kinds, strict=True) if k == 1]
        own = any(k == 4 for k in kinds)
        bytewise = spec.trainer_spec.byte_fallback
        self.by_word = bytewise and not own and not self.suffix and not any(SPACE in p.lstrip(SPACE) for p in usual)
        breaks = "\n" if not any("\n" in p for p in usual) else ""
        self.cut = re.compile(f"{SPACE}+[^{SPACE}{breaks}]*|[^{SPACE}{breaks}]+|[{breaks}]" if breaks else f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
        self.words: dict[str, tuple] = {}

    def align(self, text: str) -> tuple[str, np.ndarray, np.ndarray]:
        """The normalised text, and for each of its bytes the span of original bytes it came from."""
        data = text.encode("utf-8", "replace")
        mark = SPACE.encode() if self.escape else b" "
        if self.plain:
            raw = np.frombuffer(data, dtype=np.uint8)
            width = np.where(raw == 32, 3, 1)
            begin = np.repeat(np.arange(len(raw)), width)
            first = np.zeros(len(mark) if len(raw) else 0, dtype=np.int64)
            return (SPACE + text.replace(" ", SPACE)) if text else "", np.concatenate([first, begin]), np.concatenate([first, begin + 1])
        out, begin, end, at = [], [], [], 0
        steps = []
        while at < len(data):
            known = self.chars.longest(data, at)
            n, new = known if known else (char_bytes(data[at]), data[at : at + char_bytes(data[at])])
            steps.append((at, at + n, new))
            at += n
        if self.squeeze:
            while steps and steps[0][2] == b" ":
                steps.pop(0)
            while steps and steps[-1][2] == b" ":
                steps.pop()
        if self.dummy and steps and not self.suffix:
            out.append(mark)
            begin += [steps[0][0]] * len(mark)
            end += [steps[0][0]] * len(mark)
        before = bool(self.squeeze)
        for a, b, new in steps:
            if self.squeeze and before:
                new = new.lstrip(b" ")
            if not new:
                continue
            before = new.endswith(b" ") and self.squeeze
            new = new.replace(b" ", mark)
            out.append(new)
            begin += [a] * len(new)
            end += [b] * len(new)
        if self.squeeze:
            while out and out[-1] == mark and len(out) > 1:
                cut = len(out.pop())
                del begin[-cut:], end[-cut:]
        if self.dummy and steps and self.suffix:
            out.append(mark)
            begin += [len(data)] * len(mark)
            end += [len(data)] * len(mark)
        return b"".join(out).decode("utf-8", "replace"), np.array(begin, dtype=np.int64), np.array(end, dtype=np.int64)

    def segment(self, normals: list[str]) -> list[str]:
        """The ids of normalised texts, as decimal numbers joined by a space."""
        name = self.names.__getitem__
        if not self.by_word:
            return [" ".join(map(name, ids)) for ids in self.segmenter.encode(normals, num_threads=1)]
        known, cut = self.words, []
        for normal in normals:
            units = normal[1:].split(SPACE) if normal[:1] == SPACE else [""]
            if normal and "" in units:  # runs of spaces, or none in front: these units keep their spaces
                units = [SPACE + u for u in self.cut.findall(normal)]
            cut.append(units if normal else [])
        fresh = set(chain.from_iterable(cut)).difference(known)
        if len(known) + len(fresh) > REMEMBERED:
            known.clear()
            fresh = set(chain.from_iterable(cut))
        if fresh:
            fresh = list(fresh)
            found = self.segmenter.encode([u[1:] if u[:1] == SPACE else SPACE + u for u in fresh], num_threads=1)
            known.update(zip(fresh, [" ".join(map(name, ids)) for ids in found], strict=True))
        return [" ".join(map(known.__getitem__, units)) for units in cut]

    def encode_many(self, texts: list[str]) -> list[tuple]:
        """For each text its ids as numbers in a string and as an array, with the end id, and the span
        of original bytes of each (the end id: empty, at the end)."""
        if self.plain and self.by_word:
            aligned = [(SPACE + t.replace(" ", SPACE) if t else "", None, None) for t in texts]
        else:
            aligned = [self.align(t) for t in texts]
        out = []
        for text, (normal, begin, end), said in zip(texts, aligned, self.segment([a[0] for a in aligned]), strict=True):
            ids = np.fromstring(said, dtype=np.int32, sep=" ") if said else np.zeros(0, dtype=np.int32)
            if begin is None and SPACE not in text:
                # the map is the identity: a piece holds its own bytes, a space mark one; the first mark is the dummy prefix
                ends = np.cumsum(self.plain_lengths[ids]) - 1
                begins = ends - self.plain_lengths[ids]
                begins[:1] = 0
            else:
                if begin is None:
                    _, begin, end = self.align(text)
                lengths = self.lengths[ids]
                if len(ids) and int(lengths.sum()) != len(begin):  # unknown characters
                    lengths = np.array([len(p.surface.encode()) for p in self.segmenter.encode(normal, return_type="proto").pieces], dtype=np.int64)
                stop = np.cumsum(lengths)
                begins, ends = (begin[stop - lengths], end[stop - 1]) if len(ids) else (stop, stop)
            n = len(text.encode("utf-8", "replace"))
            out.append((f"{said} {self.end}" if said else str(self.end), np.append(ids, np.int32(self.end)), np.append(begins, n), np.append(ends, n)))
        return out

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        """The texts that the library decodes ids to."""
        return self.library.decode([x.tolist() for x in ids], num_threads=1) if ids else []


def model_bytes(path: str | None = None) -> bytes:
    """The model file, read on the driver; 0.5 MB for a vocabulary of 32,000."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    with open(path, "rb") as f:
        return f.read()


OUTPUTS = {"n_tokens": "long", "ids": "array<int>", "begins": "array<long>", "ends": "array<long>", "decoded": "string"}


def encode(docs: DataFrame, model: str | None = None, id_column: str = "doc_id", text_column: str = "text", outputs: tuple = tuple(OUTPUTS)) -> DataFrame:
    """doc_id and the chosen outputs of every row: ids, their byte spans in the original text, the decoded text."""
    blob = model_bytes(model)
    kept = docs.select(F.col(id_column).alias("doc_id"), common.text_or_empty(text_column).alias("text"))
    made = {
        "n_tokens": (pa.int64(), lambda pieces, r: len(r[1])),
        "ids": (pa.list_(pa.int32()), lambda pieces, r: r[1]),
        "begins": (pa.list_(pa.int64()), lambda pieces, r: r[2]),
        "ends": (pa.list_(pa.int64()), lambda pieces, r: r[3]),
        "decoded": (pa.string(), lambda pieces, r: pieces.decode([r[1]])[0]),
    }

    def run(batches):
        pieces = Pieces(blob)
        for batch in batches:
            for part in slices(batch, "text"):
                rows = pieces.encode_many(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array([made[o][1](pieces, r) for r in rows], made[o][0]) for o in outputs]], ["doc_id", *outputs])

    kind = kept.schema["doc_id"].dataType.simpleString()
    return kept.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{o} {OUTPUTS[o]}" for o in outputs))


def digests(docs: DataFrame, model: str | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """What encode() makes, hashed where it is made: spans and ids of a corpus outweigh its texts.

    n_uncovered counts the original bytes that no piece's span holds (0 for an exact alignment).
    """
    blob = model_bytes(model)
    kept = docs.select(F.col(id_column).alias("doc_id"), common.text_or_empty(text_column).alias("text"))

    def one(said: str, ids: np.ndarray, begins: np.ndarray, ends: np.ndarray, decoded: str) -> tuple:
        gaps = int(np.maximum(begins[1:] - ends[:-1], 0).sum()) + int(begins[0]) if len(ids) > 1 else 0
        spans = np.stack([begins, ends]).astype("<i8").tobytes()
        return len(ids), hashlib.sha256(said.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(), gaps, hashlib.md5(spans).hexdigest()

    def run(batches):
        pieces = Pieces(blob)
        for batch in batches:
            for part in slices(batch, "text"):
                found = pieces.encode_many(part.column(1).to_pylist())
                rows = [one(*r, text) for r, text in zip(found, pieces.decode([r[1] for r in found]), strict=True)]
                kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_uncovered", "spans_md5"])

    kind = kept.schema["doc_id"].dataType.simpleString()
    return kept.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, n_uncovered long, spans_md5 string")


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids and decoded text, as digests."""
    return digests(common.table(spark, sf_dir, "documents"))
