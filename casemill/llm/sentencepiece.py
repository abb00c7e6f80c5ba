"""SentencePiece models run by the ``tokenizers`` library.

The model file is parsed here, field by field of its protobuf: pieces with score and type, the kind of
model, and the normaliser. From them a fast tokenizer is rebuilt: the precompiled character map, white
space handling and the metaspace marker; BPE merges ranked by the score of their result, or the scores
of a unigram model; and byte fallback. No piece holds a marker behind another character (checked on
loading, else texts are not split), so a text falls into units that start with the marker and are
encoded one by one with the same result.

The distinct units of a batch are encoded together by several threads in each task. Each of them is
also encoded by the ``sentencepiece`` library; ``parity`` says whether all units of a text agree.
Texts that hold the marker itself are one unit. Decoding joins the bytes of the pieces; bytes that are
no UTF-8 become U+FFFD, and a marker in the text comes back as a space.

Null texts have null ids, and empty texts none. The model is given as bytes, read on the driver from a
path that is a parameter; it is a few hundred kilobytes and goes to the executors as a broadcast.
Other columns stay as they are, but for those named ``ids``, ``parity`` or ``decoded``, which the results
replace. An empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from ._shared import small_batches

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
KEPT = 400_000
DECODED = 1 << 20
JOINED = 200


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}[kind] if kind != 2 else varint()
        yield tag >> 3, data[at : at + size]
        at += size


def parse(model: bytes) -> dict:
    """Pieces (text, score, type), kind of model, and normaliser of a SentencePiece model."""
    pieces, trainer, normaliser = [], {}, {}
    for number, value in fields(model):
        if number == 1:
            own = dict(fields(value))
            score = struct.unpack("<f", own[2])[0] if 2 in own else 0.0
            pieces.append((own.get(1, b"").decode(), score, own.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(fields(value))
        elif number == 3:
            normaliser = dict(fields(value))
    return {"pieces": pieces, "kind": trainer.get(3, UNIGRAM), "byte_fallback": bool(trainer.get(35, 0)), "charsmap": normaliser.get(2, b""), "dummy_prefix": bool(normaliser.get(3, 1)), "squeeze": bool(normaliser.get(4, 1)), "escape": bool(normaliser.get(5, 1))}


def by_units(model: dict) -> bool:
    """Whether a text can be cut before each run of markers without changing its pieces."""
    return model["escape"] and not any(MARK in text.lstrip(MARK) for text, _, kind in model["pieces"] if kind in (NORMAL, USER))


def merges(pieces: list[tuple[str, float, int]]) -> list[tuple[str, str]]:
    """All ways to make a piece of two pieces, the best score first."""
    rank = {text: k for k, (text, _, kind) in enumerate(pieces) if kind == NORMAL}
    found = []
    for text, score, kind in pieces:
        if kind == NORMAL:
            found += [(-score, rank[text], rank[text[:i]], rank[text[i:]], text[:i], text[i:]) for i in range(1, len(text)) if text[:i] in rank and text[i:] in rank]
    return [(a, b) for *_, a, b in sorted(found)]


def build(model: dict):
    """The tokenizer of a parsed model."""
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    pieces = model["pieces"]
    unknown = next((k for k, p in enumerate(pieces) if p[2] == UNKNOWN), None)
    if model["kind"] == BPE:
        core = models.BPE({p[0]: k for k, p in enumerate(pieces)}, merges(pieces), unk_token=pieces[unknown][0] if unknown is not None else None, fuse_unk=True, byte_fallback=model["byte_fallback"])
    elif model["kind"] == UNIGRAM:
        core = models.Unigram([(p[0], p[1]) for p in pieces], unk_id=unknown, byte_fallback=model["byte_fallback"])
    else:
        raise ValueError(f"SentencePiece model of kind {model['kind']}: unigram (1) and BPE (2) are supported")
    tokenizer = Tokenizer(core)
    steps = [normalizers.Precompiled(model["charsmap"])] if model["charsmap"] else []
    if model["squeeze"]:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model["dummy_prefix"]:
        steps.append(normalizers.Prepend(" "))
    if model["escape"]:
        steps.append(normalizers.Replace(" ", MARK))
    tokenizer.normalizer = normalizers.Sequence(steps)
    if by_units(model):
        tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}*[^{MARK}]+|{MARK}+"), "isolated")
    tokenizer.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *([decoders.Strip(" ", 1, 0)] if model["dummy_prefix"] else [])])
    tokenizer.add_tokens([AddedToken(p[0], normalized=False) for p in pieces if p[2] == USER])
    tokenizer.encode_special_tokens = True
    return tokenizer


@lru_cache(1)
def _loaded(model: bytes, threads: int):
    os.environ.update(RAYON_NUM_THREADS=str(threads), TOKENIZERS_PARALLELISM="true")
    parsed = parse(model)
    return parsed, build(parsed)


class Codec:
    """Encodes and decodes by way of distinct units, which are kept up to KEPT of them."""

    def __init__(self, model: bytes, threads: int, verify: bool):
        self.parsed, self.fast = _loaded(model, threads)
        self.units = by_units(self.parsed) and self.parsed["dummy_prefix"] and not (self.parsed["squeeze"] or self.parsed["charsmap"])
        self.index: dict[str, int] = {}  # place of each unit's ids: flat[ends[place] : ends[place + 1]]
        self.flat, self.ends = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.bad: set[str] = set()
        self.begins = np.array([p[0].startswith(MARK) for p in self.parsed["pieces"]])
        self.core = build(self.parsed)
        self.core.normalizer = self.core.pre_tokenizer = None
        table = [bytes([int(p[0][3:5], 16)]) if p[2] == BYTE else p[0].replace(MARK, " ").encode() for p in self.parsed["pieces"]]
        self.sizes = np.array([len(x) for x in table])
        self.starts, self.bytes = np.cumsum(self.sizes) - self.sizes, np.frombuffer(b"".join(table), dtype=np.uint8)
        self.other = None
        if verify:
            import sentencepiece

            self.other = sentencepiece.SentencePieceProcessor(model_proto=model)

    def cut(self, text: str) -> list[str]:
        """The units of a text, each without its first marker."""
        if not self.units or MARK in text or text[-1:] in ("", " "):
            return [text] if text else []
        if "  " in text or text[0] == " ":
            return [u[1:] for u in re.findall(" *[^ ]+| +$", " " + text)]
        return text.split(" ")

    def learn(self, new: list[str]) -> None:
        """Encode units by several threads, and compare them with the other library."""
        odd = [u for u in new if " " in u or MARK in u or not self.units]
        plain = list(set(new).difference(odd)) if odd else new
        parts = [plain[i : i + JOINED] for i in range(0, len(plain), JOINED)]
        joined = self.core.encode_batch_fast([MARK + MARK.join(p) for p in parts], add_special_tokens=False)
        ids = np.array(list(chain.from_iterable(e.ids for e in joined)), dtype=np.int32)
        starts = np.flatnonzero(self.begins[ids])
        if len(starts) != len(plain):
            raise ValueError("the model has a unit that doesn't begin with the marker")
        alone = [e.ids for e in self.fast.encode_batch_fast(odd, add_special_tokens=False)]
        if self.other:
            self.compare(parts, [e.ids for e in joined])
            self.bad.update(u for u, x, y in zip(odd, alone, self.other.encode(odd, num_threads=1), strict=True) if x != y)
        sizes = np.concatenate([np.diff(np.append(starts, len(ids))), np.array([len(x) for x in alone], dtype=np.int64)])
        self.index.update(zip(chain(plain, odd), range(len(self.ends) - 1, len(self.ends) - 1 + len(sizes)), strict=True))
        self.flat = np.concatenate([self.flat, ids, *(np.array(x, dtype=np.int32) for x in alone)])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])

    def compare(self, parts: list[list[str]], ids: list[list[int]]) -> None:
        for part, own, told in zip(parts, ids, self.other.encode([" ".join(p) for p in parts], num_threads=1), strict=True):
            if own != told:
                single = self.fast.encode_batch_fast(part, add_special_tokens=False)
                self.bad.update(u for u, x, y in zip(part, single, self.other.encode(part, num_threads=1), strict=True) if x.ids != y)

    def encode(self, texts: list[str]) -> tuple[pa.ListArray, list[bool | None]]:
        units = [self.cut(t) for t in texts]
        if len(self.index) > KEPT:
            self.index, self.flat, self.ends = {}, np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.learn(list(set().union(*units).difference(self.index)))
        counts = np.cumsum([0, *map(len, units)])
        at = np.fromiter(map(self.index.__getitem__, chain.from_iterable(units)), dtype=np.int64, count=counts[-1])
        sizes = self.ends[at + 1] - self.ends[at]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        flat = self.flat[np.repeat(self.ends[at] - upto[:-1], sizes) + np.arange(upto[-1])]
        same = [self.other and not self.bad.intersection(u) for u in units] if self.bad else [bool(self.other) or None] * len(units)
        return pa.ListArray.from_arrays(pa.array(upto[counts], pa.int32()), pa.array(flat)), same

    def decode(self, ids: pa.ListArray) -> list[bytes]:
        """The UTF-8 bytes of each list of ids, without the space in front."""
        values, ends = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
        sizes, out = self.sizes[values], []
        upto = np.concatenate([[0], np.cumsum(sizes)])
        for a in range(0, len(values), DECODED):
            own = slice(a, min(a + DECODED, len(values)))
            places = np.repeat(self.starts[values[own]] - (upto[own] - upto[a]), sizes[own]) + np.arange(upto[own.stop] - upto[a])
            out.append(self.bytes[places].tobytes())
        data = b"".join(out)
        texts = (data[upto[x] : upto[y]] for x, y in zip(ends[:-1], ends[1:], strict=True))
        return [t[1:] if self.parsed["dummy_prefix"] and t[:1] == b" " else t for t in texts]


def _encoder(model, threads: int, verify: bool):
    def run(batches):
        codec = Codec(model.value, threads, verify)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("text"))
            ids, same = codec.encode([t or "" for t in column.to_pylist()])
            ids = pc.if_else(column.is_valid(), ids, pa.scalar(None, ids.type)) if column.null_count else ids
            yield pa.record_batch([batch.column(batch.schema.get_field_index("rest")), ids, pa.array(same, pa.bool_())], names=["rest", "ids", "parity"])

    return run


def _decoder(model, threads: int):
    def run(batches):
        codec = Codec(model.value, threads, False)
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("ids"))
            told = [t.decode("utf-8", "replace") if known else None for t, known in zip(codec.decode(ids), ids.is_valid().to_pylist(), strict=True)]
            yield pa.record_batch([batch.column(batch.schema.get_field_index("rest")), pa.array(told, pa.string())], names=["rest", "decoded"])

    return run


def _model(spark, path: str):
    """The model's bytes as a broadcast, by a path that Spark reads."""
    return spark.sparkContext.broadcast(bytes(spark.read.format("binaryFile").load(path if "://" in path else f"file://{path}").first()["content"]))


def encode(docs: DataFrame, path: str = MODEL, threads: int = 2, verify: bool = True) -> DataFrame:
    """``docs`` with ``ids`` (array of int) and ``parity`` (both libraries agree on every unit of the text)."""
    small_batches(docs.sparkSession, 500)
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("rest"), F.col("text").cast("string").alias("text"))
    schema = T.StructType([held.schema["rest"], T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("parity", T.BooleanType())])
    out = held.mapInArrow(_encoder(_model(docs.sparkSession, path), threads, verify), schema)
    return out.select(*[F.col(f"rest.`{c}`") for c in docs.columns if c not in ("ids", "parity")], "ids", "parity")


def decode(encoded: DataFrame, path: str = MODEL, threads: int = 2) -> DataFrame:
    """Rows with ``ids`` and their text in ``decoded``."""
    held = encoded.select(F.struct(*[F.col(f"`{c}`") for c in encoded.columns]).alias("rest"), "ids")
    schema = T.StructType([held.schema["rest"], T.StructField("decoded", T.StringType())])
    out = held.mapInArrow(_decoder(_model(encoded.sparkSession, path), threads), schema)
    return out.select(*[F.col(f"rest.`{c}`") for c in encoded.columns if c != "decoded"], "decoded")
