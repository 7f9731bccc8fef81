"""Byte-level BPE by sentencepiece: a model serialised from a file of ranks, encoding, decoding."""

from __future__ import annotations

import base64
import gc
import hashlib
import itertools
import operator
import re
import struct
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Letter of byte 0; one letter per byte keeps any bytes a valid text without spaces.
FIRST_LETTER = 0x100
LETTER_OF_BYTE = {b: FIRST_LETTER + b for b in range(256)}

UNKNOWN, BPE = 2, 2  # sentencepiece: type of the unknown piece, model type


def read_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary of a rank file: base64 of a token's bytes, space, rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def mapped(data: bytes) -> str:
    """Bytes as letters, one each."""
    return data.decode("latin-1").translate(LETTER_OF_BYTE)


def _varint(value: int) -> bytes:
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    return bytes(out) + bytes([value])


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value & (1 << 64) - 1)


def _block(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def serialised(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model of tokens in the order of their ranks.

    A piece is a token's bytes as letters, its score the negative rank, so the
    pair of lowest rank merges first. The unknown piece comes last; there are no
    other special pieces. The normaliser is the identity: no prefix, no removed
    or escaped spaces.
    """
    pieces = [
        _block(1, _block(1, mapped(t).encode()) + _varint(2 << 3 | 5) + struct.pack("<f", -rank))
        for rank, t in enumerate(tokens)
    ]
    unknown = _block(1, _block(1, b"<unk>") + _number(3, UNKNOWN))
    trainer = _number(3, BPE) + _number(4, len(tokens) + 1) + _number(40, len(tokens))
    trainer += b"".join(_number(field, -1) for field in (41, 42, 43))  # no begin, end, padding
    normaliser = _block(1, b"identity") + b"".join(_number(field, 0) for field in (3, 4, 5))
    return b"".join(pieces) + unknown + _block(2, trainer) + _block(3, normaliser)


#: A run of spaces (Unicode white space, unlike Python's without U+001C to U+001F) and the non-spaces after it.
STRETCH = re.compile(r"[^\S\x1c-\x1f]*[\S\x1c-\x1f]+|[^\S\x1c-\x1f]+")
#: A place to cut: a space after a non-space.
CUT = re.compile(r"(?<=\S) ")


def grouped(texts: Iterable[str], length: int) -> Iterator[list[tuple[str, bool]]]:
    """Lists of (piece of a text, whether it is the text's last), together about ``length`` code points long."""
    group: list[tuple[str, bool]] = []
    size = 0
    for text in texts:
        start = 0
        while True:
            cut = CUT.search(text, start + length) if len(text) - start > length else None
            end = cut.start() if cut else len(text)
            group.append((text[start:end], cut is None))
            size += end - start
            if size >= length:
                yield group
                group, size = [], 0
            if cut is None:
                break
            start = end
    if group:
        yield group


class ByteBPE:
    """Encoder and decoder of one vocabulary; what it holds grows with the vocabulary only.

    ``pattern`` splits texts into pre-tokens. None of its matches may reach
    from a non-space over a following space, nor look at what lies beyond; so a
    text may be cut there, and stretches of spaces and the non-spaces after
    them, which recur far more often than texts, are encoded once and kept.
    A pre-token that is itself a token is that token, even where the merges
    don't lead to it; such tokens are found once, when the model is loaded.
    """

    cached = 1 << 19  # stretches whose ids a worker keeps
    cached_length = 64  # longer stretches are encoded anew
    group_length = 1 << 22  # code points split at once

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks {len(missing)} of the 256 bytes")
        self.pattern = pattern
        self.tokens = sorted(ranks, key=ranks.__getitem__)
        self.ids = np.array([ranks[t] for t in self.tokens], np.int64)
        if self.ids[0] < 0 or (np.diff(self.ids) == 0).any():
            raise ValueError("ranks must be distinct and not negative")
        self.model = serialised(self.tokens)
        self.key = hashlib.sha256(self.model + pattern.encode() + self.ids.tobytes()).hexdigest()

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def _load(self) -> None:
        self._processor = sentencepiece.SentencePieceProcessor(model_proto=self.model)
        self._split = regex.compile(self.pattern)
        self._known: dict[str, bytes] = {}
        found = self._processor.encode([mapped(t) for t in self.tokens], num_threads=1)
        self._whole = {t: [at] for at, (t, ids) in enumerate(zip(self.tokens, found)) if ids != [at]}
        self._dense = len(self.ids) == self.ids[-1] + 1
        self._flat = np.frombuffer(b"".join(self.tokens), np.uint8)
        self._lengths = np.array([len(t) for t in self.tokens], np.int32)
        self._starts = (np.cumsum(self._lengths) - self._lengths).astype(np.int32)

    def worker(self) -> ByteBPE:
        """This model as kept by the Python worker, loaded once per process."""
        kept = _WORKERS.setdefault(self.key, self)
        if not hasattr(kept, "_processor"):
            kept._load()
        return kept

    def _learn(self, stretches: set[str]) -> dict[str, bytes]:
        """The ids of stretches, as bytes of 32-bit numbers.

        Stretches that begin with a space and end without meet each other where
        texts may be cut, so they are split together.
        """
        plain = [s for s in stretches if s[0] == " " and not s[-1].isspace()]
        rest = list(stretches.difference(plain))
        parts = self._split.findall("".join(plain))
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64))
        n_parts = np.searchsorted(ends, np.cumsum(np.fromiter(map(len, plain), np.int64))) + 1
        alone = [self._split.findall(s) for s in rest]
        n_parts = np.r_[n_parts, len(parts) + np.cumsum(np.fromiter(map(len, alone), np.int64))]
        parts.extend(itertools.chain.from_iterable(alone))
        data = [p.encode() for p in parts]
        letters = mapped(b"".join(data))
        cuts = itertools.pairwise(itertools.accumulate(map(len, data), initial=0))
        found = self._processor.encode([letters[i:j] for i, j in cuts], num_threads=1)
        if self._whole:
            found = [self._whole.get(d, i) for d, i in zip(data, found)]
        places = np.fromiter(itertools.chain.from_iterable(found), np.int64)
        flat = self.ids[places].astype(np.int32).tobytes()
        n_ids = np.r_[0, np.cumsum(np.fromiter(map(len, found), np.int64))]
        bounds = itertools.pairwise([0, *(4 * n_ids[n_parts]).tolist()])
        return {s: flat[i:j] for s, (i, j) in zip(itertools.chain(plain, rest), bounds)}

    def encode_all(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """Ids of each text, pre-token by pre-token, without special tokens.

        Texts are gathered to groups of bounded length, long ones are cut, and
        the stretches of a group that are not known are encoded together.
        """
        known = self._known
        parts: list[bytes] = []
        for group in grouped(texts, self.group_length):
            split = [STRETCH.findall(part) for part, _ in group]
            found = [list(map(known.get, stretches)) for stretches in split]
            new: set[str] = set()
            for stretches, ids in zip(split, found):
                new.update(itertools.compress(stretches, map(operator.is_, ids, itertools.repeat(None))))
            learned = {}
            if new:
                with without_gc():
                    learned = self._learn(new)
                if len(known) + len(new) > self.cached:  # go on with those that this group met again
                    kept = [(s, i) for each in zip(split, found) for s, i in zip(*each) if i is not None]
                    known.clear()
                    known.update(kept)
                known.update((s, i) for s, i in learned.items() if len(s) <= self.cached_length)
            for (_, last), stretches, ids in zip(group, split, found):
                parts += [learned[s] if i is None else i for s, i in zip(stretches, ids)] if new else ids
                if last:
                    yield np.frombuffer(b"".join(parts), np.int32)
                    parts = []

    def encode(self, text: str) -> list[int]:
        (ids,) = self.encode_all([text])
        return ids.tolist()

    def decode(self, ids: np.ndarray | list[int]) -> bytes:
        """Bytes of ids, by the inverse mapping; an id outside of the vocabulary is an error."""
        ids = np.asarray(ids, np.int64)
        at = ids if self._dense else np.searchsorted(self.ids, ids)
        if len(ids) and (at.min() < 0 or at.max() >= len(self.ids) or (not self._dense and (self.ids[at] != ids).any())):
            raise KeyError("an id is not in the vocabulary")
        lengths = self._lengths[at]
        ends = np.cumsum(lengths)
        shift = np.repeat(self._starts[at] - ends + lengths, lengths)
        return self._flat[shift + np.arange(len(shift), dtype=np.int32)].tobytes()


@contextmanager
def without_gc() -> Iterator[None]:
    """No garbage collection while many lists without cycles are made."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


_WORKERS: dict[str, ByteBPE] = {}


def _lists(ids: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0] + [len(i) for i in ids]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, np.concatenate([*ids, np.empty(0, np.int32)]))


def encode(model: ByteBPE, text: Column) -> Column:
    """Ids (array of int) of whole texts; a null text counts as empty, an empty text has none."""

    @F.arrow_udf("array<int>")
    def ids_of(texts: pa.Array) -> pa.Array:
        return _lists(list(model.worker().encode_all(t or "" for t in texts.to_pylist())))

    return ids_of(text)


def decode(model: ByteBPE, ids: Column) -> Column:
    """Bytes (binary) of ids; null ids count as none."""

    @F.arrow_udf("binary")
    def bytes_of(lists: pa.Array) -> pa.Array:
        bpe = model.worker()
        return pa.array([bpe.decode(i.values.to_numpy()) if i.is_valid else b"" for i in lists], pa.binary())

    return bytes_of(ids)


def encode_and_decode(model: ByteBPE, text: Column) -> Column:
    """``ids`` of whole texts and the bytes (``decoded``) that these ids decode to, as one struct.

    ``decode`` of ``encode`` beside the ids themselves would encode each text
    twice: Spark runs functions that feed each other in one step, a chain for
    each column.
    """

    @F.arrow_udf("ids array<int>, decoded binary")
    def round_trip(texts: pa.Array) -> pa.Array:
        bpe = model.worker()
        ids = list(bpe.encode_all(t or "" for t in texts.to_pylist()))
        decoded = pa.array([bpe.decode(i) for i in ids], pa.binary())
        return pa.StructArray.from_arrays([_lists(ids), decoded], ["ids", "decoded"])

    return round_trip(text)


def encoded(docs: DataFrame, model: ByteBPE) -> DataFrame:
    """Rows (doc_id, ids, decoded) of whole texts: their ids and the bytes these decode to.

    A null text counts as empty; empty texts have no ids. Long texts are split
    into pre-tokens piece by piece. Repeated rows and null ids keep their rows,
    other columns are ignored, an empty table gives no rows.
    """
    return docs.select("doc_id", encode_and_decode(model, F.col("text")).alias("coded")).select("doc_id", "coded.*")


def digests(rows: DataFrame) -> DataFrame:
    """Rows (doc_id, n_tokens, ids_sha256, decoded_sha256) of encoded documents."""
    joined = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
