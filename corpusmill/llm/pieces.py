"""SentencePiece encoding that keeps offsets, and decoding.

``Normalizer`` walks the model's compiled character map by longest prefix and
records for each normalised character the byte of the source it came from, so
each piece is projected to a span of original bytes. ``PieceCodec`` cuts the
normalised text where no piece of the vocabulary can cross (a space mark after
anything else) and looks each chunk up in a bounded cache; the installed
library's merge loop, with its own normaliser switched off, fills the misses.
Only ids are cached; spans, decimals and decoded bytes come from a text's ids
by tables of the vocabulary.
"""

from __future__ import annotations

import hashlib
import re
import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.common import in_parts, table

MARK = "▁"
#: Chunks up to this length are cached, and a full cache is emptied.
CACHED_LENGTH = 48
CACHE_ENTRIES = 300_000
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def proto_fields(data: bytes) -> Iterator[tuple[int, int, object, bytes]]:
    """(field, wire type, value, raw bytes) of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = data[at]
            at += 1
            out |= (byte & 127) << shift
            if byte < 128:
                return out
            shift += 7

    while at < len(data):
        begin, key = at, varint()
        if key & 7 == 0:
            value: object = varint()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or varint()
            value, at = data[at : at + size], at + size
        yield key >> 3, key & 7, value, data[begin:at]


class CharMap:
    """The compiled map: a double-array trie over UTF-8 bytes and its replacements."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0]
        self.units = struct.unpack_from(f"<{size // 4}I", blob, 4)
        self.replacements = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Bytes consumed and their replacement at ``at``; None if no key matches."""
        units, node, found = self.units, 0, None
        unit = units[0]
        node ^= (unit >> 10) << ((unit & 0x200) >> 6)
        for n in range(at, len(data)):
            node ^= data[n]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != data[n]:
                break
            node ^= (unit >> 10) << ((unit & 0x200) >> 6)
            if unit >> 8 & 1:
                found = (n + 1 - at, units[node] & 0x7FFFFFFF)
        if found is None:
            return None
        end = self.replacements.index(0, found[1])
        return found[0], self.replacements[found[1] : end]


class Normalizer:
    def __init__(self, charmap: CharMap | None, dummy: bool, squeeze: bool, escape: bool, user: tuple[str, ...] = ()):
        self.charmap, self.dummy, self.squeeze, self.escape = charmap, dummy, squeeze, escape
        self.space = MARK if escape else " "
        self.user = [u.encode() for u in sorted(user, key=len, reverse=True)]
        self.plain = charmap is None and not squeeze and not user

    def steps(self, data: bytes) -> Iterator[tuple[int, str]]:
        """Source bytes and normalised characters, longest match first."""
        at = 0
        while at < len(data):
            own = next((u for u in self.user if data.startswith(u, at)), None)
            hit = (len(own), own) if own else self.charmap and self.charmap.longest(data, at)
            if not hit:
                lead = data[at]
                size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                hit = size, data[at : at + size]
            yield hit[0], hit[1].decode("utf-8", "replace")
            at += hit[0]

    def normalize(self, text: str) -> tuple[str, list[int]]:
        """The normalised text and the source byte of each character, with the end of the source at last."""
        data = text.encode()
        if not data:
            return "", [0]
        chars, starts, at = [], [], 0
        if self.dummy:
            chars.append(self.space)
            starts.append(0)
        blank = self.squeeze
        for size, new in self.steps(data):
            if self.squeeze and blank:
                new = new.lstrip(" ")
            for c in new:
                chars.append(self.space if c == " " else c)
                starts.append(at)
            if new:
                blank = new.endswith(" ")
            at += size
        if self.squeeze:
            while chars and chars[-1] == self.space and len(chars) > self.dummy:
                chars.pop()
                starts.pop()
            if len(chars) == self.dummy:
                chars, starts = [], []
        return "".join(chars), [*starts, at]

    def aligned(self, text: str) -> tuple[str, np.ndarray]:
        """What ``normalize`` gives; without a map each character is its own step, and all are placed at once."""
        if not self.plain or not text:
            normal, starts = self.normalize(text)
            return normal, np.array(starts, np.int32)
        data = np.frombuffer(text.encode(), np.uint8)
        starts = np.flatnonzero((data & 0xC0) != 0x80)
        normal = (" " if self.dummy else "") + text
        starts = np.concatenate([np.zeros(int(self.dummy), np.int64), starts, [len(data)]]).astype(np.int32)
        return normal.replace(" ", MARK) if self.escape else normal, starts


def _joined(table: pa.Array, ids: np.ndarray) -> bytes:
    """The entries of a table of bytes at ``ids``, end to end."""
    _, cuts, data = table.take(pa.array(ids)).buffers()
    return data.to_pybytes()[: np.frombuffer(cuts, np.int32)[len(ids)]] if len(ids) else b""


class PieceCodec:
    def __init__(self, path: str):
        import sentencepiece

        with open(path, "rb") as f:
            data = f.read()
        fields = list(proto_fields(data))
        self.surface, self.kind = [], []
        spec = {2: b"", 3: 1, 4: 1, 5: 1}
        for number, _, value, _ in fields:
            if number == 1:
                piece = {n: v for n, _, v, _ in proto_fields(value)}
                self.surface.append(piece[1].decode())
                self.kind.append(piece.get(3, NORMAL))
            elif number == 3:
                spec |= {n: v for n, _, v, _ in proto_fields(value)}
        user = tuple(s for s, k in zip(self.surface, self.kind, strict=True) if k == USER)
        self.normalizer = Normalizer(CharMap(spec[2]) if spec[2] else None, bool(spec[3]), bool(spec[4]), bool(spec[5]), user)
        # the library over text that is normalised already: identity, no prefix, spaces kept and not escaped
        bare = b"\x0a\x08identity\x18\x00\x20\x00\x28\x00"
        inner = b"".join(raw for number, _, _, raw in fields if number != 3) + b"\x1a" + bytes([len(bare)]) + bare
        self.library = sentencepiece.SentencePieceProcessor(model_proto=inner)
        inside = any(MARK in s.lstrip(MARK) for s, k in zip(self.surface, self.kind, strict=True) if k in (NORMAL, USER))
        self.cut = None if inside else re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
        self.odd = {i for i, k in enumerate(self.kind) if k not in (NORMAL, USER)}
        #: By id: value of a byte piece (else -1), characters that the piece begins, decimals, and the bytes it is decoded to.
        self.byte, self.begun = np.full(len(self.kind), -1, np.int16), np.array([*map(len, self.surface)], np.int32)
        spelled = [s.replace(MARK, " ").encode() for s in self.surface]
        for i in self.odd:
            if self.kind[i] == BYTE:
                self.byte[i] = int(self.surface[i][3:5], 16)
                self.begun[i], spelled[i] = self.byte[i] & 0xC0 != 0x80, bytes([self.byte[i]])
            elif self.kind[i] == UNKNOWN:
                self.begun[i], spelled[i] = 1, " ⁇ ".encode()
            elif self.kind[i] == CONTROL:
                spelled[i] = b""
        self.spelled = pa.array(spelled, pa.binary())
        self.decimals = pa.array([b"%d," % i for i in range(len(self.kind))], pa.binary())
        #: By chunk: its ids.
        self.cache: dict[str, bytes] = {}

    def chunks(self, normal: str) -> list[str]:
        return self.cut.findall(normal) if self.cut else [normal] if normal else []

    def _decoded(self, ids: list[int]) -> str:
        out, raw = [], bytearray()
        for i in ids:
            if self.kind[i] == BYTE:
                raw.append(int(self.surface[i][3:5], 16))
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            if self.kind[i] == UNKNOWN:
                out.append(" ⁇ ")
            elif self.kind[i] != CONTROL:
                out.append(self.surface[i])
        if raw:
            out.append(raw.decode("utf-8", "replace"))
        return "".join(out).replace(MARK, " ")

    def _part(self, chunk: str, ids: list[int]) -> bytes:
        """What the cache holds for a chunk: its ids as int32."""
        return array("i", ids).tobytes()

    def _encoded(self, chunks: list[str]) -> Iterator[tuple[str, bytes]]:
        """Each chunk and its part."""
        return zip(chunks, map(self._part, chunks, self.library.encode(chunks, num_threads=1)), strict=True)

    def learn(self, chunks: list[str]) -> None:
        """Put chunks into the cache."""
        if len(self.cache) + len(chunks) > CACHE_ENTRIES:
            self.cache.clear()
        self.cache.update(self._encoded(chunks))

    def _ids(self, normal: str) -> np.ndarray:
        """The ids of a normalised text."""
        chunks = self.chunks(normal)
        cache = self.cache
        try:
            return np.frombuffer(b"".join([*map(cache.__getitem__, chunks)]), np.int32)
        except KeyError:
            pass
        missing = {c for c in chunks if c not in cache}
        long = {c for c in missing if len(c) > CACHED_LENGTH}
        self.learn([*(missing - long)] if len(cache) + len(missing) <= CACHE_ENTRIES else [c for c in set(chunks) if len(c) <= CACHED_LENGTH])
        found = dict(self._encoded([*long])) if long else {}
        parts = [found.get(c) or cache[c] for c in chunks] if found else [*map(cache.__getitem__, chunks)]
        return np.frombuffer(b"".join(parts), np.int32)

    def _projected(self, text: str, normal: str, source: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of the source at which pieces begin and end."""
        sizes, values = self.begun.take(ids), self.byte.take(ids)
        ends = np.cumsum(sizes, dtype=np.int32)
        # none lies beyond the text
        bounds = source.take(ends, mode="clip")
        odd = np.flatnonzero(values >= 0)
        if not len(odd):
            # pieces join: each begins where the one before ends
            first = np.empty_like(bounds)
            first[:1], first[1:] = source[:1], bounds[:-1]
            return first, bounds
        # bytes behind the first of a character begin none
        at = ends - np.maximum(sizes, 1)
        first, own = source.take(at), np.arange(len(odd))
        lead = np.maximum.accumulate(np.where(sizes[odd] > 0, own, 0))
        k, a, b = own - lead, first[odd], source.take(at[odd] + 1, mode="clip")
        if self.normalizer.plain:
            # only marks for spaces differ from their source, and in length too
            value = values[odd][lead]
            same = b - a == 1 + (value >= 0xC0).astype(np.int32) + (value >= 0xE0) + (value >= 0xF0)
        else:
            data = text.encode()
            same = np.array([data[x:y] == normal[n].encode() for x, y, n in zip(a.tolist(), b.tolist(), at[odd].tolist(), strict=True)])
        first[odd], bounds[odd] = np.where(same, a + k, a), np.where(same, a + k + 1, b)
        return first, bounds

    def arrays(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, first and end bytes of the pieces; bytes are those of the source in UTF-8.

        A byte piece covers its own byte where the character was not changed,
        and the whole source of the character where it was.
        """
        normal, source = self.normalizer.aligned(text)
        ids = self._ids(normal)
        return ids, *self._projected(text, normal, source, ids)

    def whole(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes, bytes]:
        """What ``arrays`` gives, the text that the ids decode to in UTF-8, and the ids in decimals joined by commas."""
        ids, first, end = self.arrays(text)
        decoded = _joined(self.spelled, ids)
        if self.normalizer.dummy and decoded.startswith(b" "):
            decoded = decoded[1:]
        return ids, first, end, decoded, _joined(self.decimals, ids)[:-1]

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """(id, first byte, end byte) of each piece."""
        ids, first, end = self.arrays(text)
        return [*zip(ids.tolist(), first.tolist(), end.tolist(), strict=True)]

    def decode(self, ids: list[int]) -> str:
        # pieces that are neither bytes nor unknown spell the text
        out = "".join([self.surface[i] for i in ids]).replace(MARK, " ") if self.odd.isdisjoint(ids) else self._decoded(ids)
        return out[1:] if self.normalizer.dummy and out.startswith(" ") else out


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


_codecs: dict[str, PieceCodec] = {}


def _codec(path: str | None) -> PieceCodec:
    """One codec for each model and task; its cache goes with the task, so stages that follow have the room."""
    path = path or model_path()
    if path not in _codecs:
        _codecs[path] = PieceCodec(path)
    return _codecs[path]


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``docs`` with ids, starts and ends: the pieces of ``text`` and their byte spans.

    Null texts count as empty and get empty arrays. Other columns pass through
    unless they bear one of those names, which this replaces. ``path`` is the
    model's file on the executors, the installed 32k model if not given.
    """
    own = [c for c in docs.columns if c not in ("ids", "starts", "ends")]
    kinds = dict(docs.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in own) + ", ids array<int>, starts array<int>, ends array<int>"

    def run(batches):
        codec = _codec(path)
        for batch in in_parts(batches, own.index("text")):
            rows = [codec.arrays(t.as_py() or "") for t in batch.column(own.index("text"))]
            cuts = pa.array(np.cumsum([0, *(len(r[0]) for r in rows)]), pa.int32())
            new = [pa.ListArray.from_arrays(cuts, pa.array(np.concatenate([r[k] for r in rows]), pa.int32())) for k in range(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*own, "ids", "starts", "ends"])

    return docs.select(*own).mapInArrow(run, schema)


def encode_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and spans_sha256 of each (doc_id, text), from the ids and spans of ``encode``.

    ``spans_sha256`` is taken over the first and end bytes of all pieces as
    little-endian 32-bit numbers. A null text counts as empty and has no
    tokens; repeated rows are encoded one by one; an empty table gives an
    empty table. Other columns are not read, so clashing names do no harm.
    A text is encoded whole, however long; only chunks without a space mark
    are looked up, and those beyond ``CACHED_LENGTH`` are not kept.
    """

    def run(batches):
        codec = _codec(path)
        for batch in in_parts(batches, 1):
            out = ([], [], [], [])
            for text in batch.column(1):
                ids, first, end, decoded, numbers = codec.whole(text.as_py() or "")
                out[0].append(len(ids))
                out[1].append(hashlib.sha256(numbers).hexdigest())
                out[2].append(hashlib.sha256(decoded).hexdigest())
                spans = hashlib.sha256(first.astype("<i4", copy=False).tobytes())
                spans.update(end.astype("<i4", copy=False).tobytes())
                out[3].append(spans.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out[0], pa.int64()), *(pa.array(o, pa.string()) for o in out[1:])], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_sha256 string")


def decode(rows: DataFrame, path: str | None = None) -> DataFrame:
    """``rows`` with ``decoded``, the text of the array column ``ids``; null stays null."""

    @F.pandas_udf("string")
    def run(ids):
        codec = _codec(path)
        return ids.map(lambda x: None if x is None else codec.decode([int(i) for i in x]))

    return rows.withColumn("decoded", run("ids"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(table(spark, sf_dir, "documents"))
