"""SentencePiece encoding and decoding with the original byte span of every piece.

The text is normalised here, by the longest prefixes of the model's compiled character map, and each
normalised byte remembers the original byte it comes from. The library then cuts the normalised text,
with its own normaliser switched off, and the pieces' byte lengths are projected back.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from tallyhouse.llm.tables import small_batches, text_of

SPACE = "▁".encode()
#: Texts are cut into groups of about this many characters for one call of the library.
GROUP_CHARS = 4_000_000


class CharacterMap:
    """The compiled map of a model: a double-array trie over UTF-8 and the replacement strings."""

    def __init__(self, compiled: bytes):
        self.units: list[int] = []
        self.strings = b""
        if compiled:
            (size,) = struct.unpack_from("<I", compiled)
            self.units = list(struct.unpack_from(f"<{size // 4}I", compiled, 4))
            self.strings = compiled[4 + size:]

    def longest(self, data: bytes, start: int) -> tuple[int, bytes] | None:
        """Length of the longest rule that ``data`` has at ``start``, and what it becomes."""
        units, found = self.units, None
        if not units:
            return None

        def child(unit: int) -> int:
            return (unit >> 10) << ((unit & 0x200) >> 6)

        at = child(units[0])
        for i in range(start, len(data)):
            at ^= data[i]
            if at >= len(units) or units[at] & 0x800000FF != data[i]:
                break
            unit = units[at]
            at ^= child(unit)
            if unit >> 8 & 1:
                found = i + 1 - start, units[at] & 0x7FFFFFFF
        if found is None:
            return None
        return found[0], self.strings[found[1]:self.strings.index(b"\0", found[1])]


class Pieces:
    """One model: normalising, cutting, projecting and decoding."""

    def __init__(self, model: bytes):
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        spec = proto.normalizer_spec
        self.prefix = spec.add_dummy_prefix
        self.squeeze = spec.remove_extra_whitespaces
        self.escape = SPACE if spec.escape_whitespaces else b" "
        self.suffix = proto.trainer_spec.treat_whitespace_as_suffix
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.symbols = sorted((p.piece.encode() for p in proto.pieces if p.type == p.USER_DEFINED),
                              key=len, reverse=True)
        self.whole = sentencepiece.SentencePieceProcessor(model_proto=model)
        spec.precompiled_charsmap = b""
        spec.add_dummy_prefix = spec.remove_extra_whitespaces = spec.escape_whitespaces = False
        self.cutter = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        # A byte piece stands for one byte, any other for its spelling.
        self.lengths = np.array([1 if p.type == p.BYTE else len(p.piece.encode()) for p in proto.pieces])
        self.unknown = next((i for i, p in enumerate(proto.pieces) if p.type == p.UNKNOWN), -1)

    @property
    def plain(self) -> bool:
        """No rule, no squeezing: only spaces are escaped and a prefix added."""
        return not (self.map.units or self.squeeze or self.symbols or self.suffix)

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text and, for each of its bytes and its end, the original byte."""
        data = text.encode()
        if not data:
            return "", np.zeros(1, np.int64)
        if self.plain:
            return self._escaped(text, data)
        out, origin = bytearray(), []

        def put(what: bytes, at: int) -> None:
            out.extend(what)
            origin.extend([at] * len(what))

        def step(at: int) -> tuple[int, bytes]:
            symbol = next((s for s in self.symbols if data.startswith(s, at)), None)
            if symbol:
                return len(symbol), symbol
            rule = self.map.longest(data, at)
            if rule:
                return rule
            lead = data[at]
            size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            return size, data[at:at + size]

        at = 0
        while self.squeeze and at < len(data):
            size, to = step(at)
            if to.strip(b" "):
                break
            at += size
        if at == len(data):
            return "", np.full(1, at)
        if self.prefix and not self.suffix:
            put(self.escape, at)
        spaced = self.squeeze
        while at < len(data):
            size, to = step(at)
            if spaced:
                to = to.lstrip(b" ")
            if to:
                for i in range(len(to)):
                    put(self.escape if to[i:i + 1] == b" " else to[i:i + 1], at)
                spaced = self.squeeze and to.endswith(b" ")
            elif not self.squeeze:
                spaced = False
            at += size
        end = at
        while self.squeeze and out.endswith(self.escape):
            end = origin[-len(self.escape)]
            del out[-len(self.escape):], origin[-len(self.escape):]
        if self.prefix and self.suffix:
            put(self.escape, end)
        return out.decode(), np.array([*origin, end], np.int64)

    def _escaped(self, text: str, data: bytes) -> tuple[str, np.ndarray]:
        width = np.where(np.frombuffer(data, np.uint8) == 32, len(self.escape), 1)
        origin = np.repeat(np.arange(len(data)), width)
        lead = self.escape if self.prefix else b""
        norm = lead.decode() + text.replace(" ", self.escape.decode())
        return norm, np.concatenate([np.zeros(len(lead), np.int64), origin, [len(data)]])

    def project(self, ids: np.ndarray, norm: str, origin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last (exclusive) original byte of every piece."""
        lengths = self.lengths[ids]
        if self.unknown >= 0 and (ids == self.unknown).any():
            surfaces = [len(p.surface.encode()) for p in self.cutter.encode(norm, return_type="proto").pieces]
            lengths = np.array(surfaces, np.int64)
        ends = np.cumsum(lengths)
        return origin[ends - lengths], origin[ends]

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Ids, begins and ends of each text."""
        for group in grouped(texts):
            normal = [self.normalise(t) for t in group]
            for ids, (norm, origin) in zip(self.cutter.encode([n for n, _ in normal], num_threads=1), normal,
                                           strict=True):
                ids = np.array(ids, np.int32)
                yield ids, *self.project(ids, norm, origin)

    def decode(self, ids: np.ndarray) -> str:
        return self.whole.decode(ids.tolist())


def grouped(texts: list[str]) -> Iterator[list[str]]:
    group, size = [], 0
    for t in texts:
        group.append(t)
        size += len(t)
        if size > GROUP_CHARS:
            yield group
            group, size = [], 0
    if group:
        yield group


@lru_cache(2)
def loaded(model: bytes) -> Pieces:
    return Pieces(model)


def _shipped(docs: DataFrame, model_path: str):
    """The model file's bytes for every task; a file of fixed size, read where the job is started."""
    with open(model_path, "rb") as f:
        return small_batches(docs.sparkSession).sparkContext.broadcast(f.read())


def _source(docs: DataFrame, names: list[str], text: str) -> tuple[DataFrame, str]:
    """The rows with their texts as ``_text``, and the schema of the other columns but those named as results."""
    source = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in names], text_of(docs, text).alias("_text"))
    return source, "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in source.schema if f.name != "_text")


def encode(docs: DataFrame, model_path: str, text: str = "text", spans: bool = True, decoded: bool = False) -> DataFrame:
    """Every row of ``docs`` with ``ids`` and, unless switched off, ``begins`` and ``ends``: the pieces' original byte spans.

    If asked for, ``decoded`` is the text decoded from the ids, in the same pass.
    Null texts count as empty and have no pieces. A piece of the added prefix spans no byte. Rows stay
    as they are, repeated ones too; input columns named as a result are replaced.
    """
    model = _shipped(docs, model_path)
    names = ["ids", "begins", "ends"][:3 if spans else 1]
    texts = ["decoded"] if decoded else []
    source, schema = _source(docs, names + texts, text)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pieces = loaded(model.value)
            found = list(pieces.encode(pdf.pop("_text").tolist()))
            yield pdf.assign(**{name: [f[k] for f in found] for k, name in enumerate(names)},
                             **{name: [pieces.decode(f[0]) for f in found] for name in texts})

    return source.mapInPandas(run, schema + ", ".join([f"{n} array<int>" for n in names] + [f"{n} string" for n in texts]))


def decode(rows: DataFrame, model_path: str, ids: str = "ids") -> DataFrame:
    """Every row with ``decoded``, the text of its ids; no ids, or null, are the empty text."""
    model = _shipped(rows, model_path)
    source = rows.select(*[F.col(f"`{c}`") for c in rows.columns if c != "decoded"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(decoded=[loaded(model.value).decode(np.asarray([] if x is None else x, np.int32)) for x in pdf[ids]])

    return source.mapInPandas(run, ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema], "decoded string"]))


def digest(pieces: Pieces, texts: list[str]) -> Iterator[tuple[int, str, str]]:
    """Number of ids, and the SHA-256 of the ids and of the text decoded from them."""
    def sha(data: str) -> str:
        return hashlib.sha256(data.encode()).hexdigest()

    for ids, begins, ends in pieces.encode(texts):
        if len(ids) and (begins > ends).any():
            raise ValueError("a piece's span ends before it begins")
        yield len(ids), sha(",".join(map(str, ids.tolist()))), sha(pieces.decode(ids))


def round_trip(docs: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """Every row of ``docs`` with ``n_tokens``, ``ids_sha256``, ``decoded_sha256``: encoded, decoded, digested in one pass."""
    model = _shipped(docs, model_path)
    names = ["n_tokens", "ids_sha256", "decoded_sha256"]
    source, schema = _source(docs, names, text)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = list(digest(loaded(model.value), pdf.pop("_text").tolist()))
            yield pd.concat([pdf, pd.DataFrame(rows, columns=names, index=pdf.index)], axis=1)

    return source.mapInPandas(run, schema + "n_tokens long, ids_sha256 string, decoded_sha256 string")


def query(docs: DataFrame, model_path: str) -> DataFrame:
    """``op3``: the digests of every whole text."""
    return round_trip(docs.select("doc_id", "text"), model_path).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
