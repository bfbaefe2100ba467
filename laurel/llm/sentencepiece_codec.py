"""SentencePiece encoding by streaming Viterbi over a vocabulary file, and decoding.

The best segmentation maximises the sum of the pieces' scores; among equals the one whose last pieces are longest stays.  A scan holds
scores for the longest piece's length only.  As soon as all paths that are still alive lead back to one boundary, the ids before it are
committed and forgotten, so that memory follows from the vocabulary and not from the text.  Boundaries that no piece of the vocabulary can
cross, such as those before a blank, are convergence points known beforehand; parts between them are looked up when they have been seen.

Characters outside the vocabulary become bytes where the vocabulary has byte pieces, else the unknown id.  Null and empty texts have no
ids.  Decoding gives the text back, except that U+2581, which stands for a blank inside pieces, comes back as a blank, as it does in the
library, and that normalisation named in the vocabulary file stays applied.  Repeated rows give repeated results; other columns stay as they are.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from laurel.llm.common import held

BLANK = "▁"
#: Parts of texts that a worker remembers (twice this number at most, those used lately among them), and their greatest length.
MEMO, MEMO_CHARS = 400_000, 64
#: Bytes of ids and text that are passed on together.
BLOCK = 4 << 20
#: Below the lowest score, as much as the library takes off for an unknown character.
UNKNOWN_PENALTY = 10.0


class Vocabulary:
    """Pieces, scores and byte pieces of a model file; the file's own segmentation algorithm is not used."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as model
        proto = model.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        kind = model.ModelProto.SentencePiece
        self.pieces = {p.piece: (i, p.score) for i, p in enumerate(proto.pieces) if p.type in (kind.NORMAL, kind.USER_DEFINED)}
        self.bytes = {int(p.piece[1:-1], 16): i for i, p in enumerate(proto.pieces) if p.type == kind.BYTE}
        self.unknown = next((i for i, p in enumerate(proto.pieces) if p.type == kind.UNKNOWN), 0)
        spec = proto.normalizer_spec
        self.prefix, self.identity = spec.add_dummy_prefix, spec.name == "identity" and not spec.remove_extra_whitespaces
        self.library = None if self.identity else SentencePieceProcessor(model_file=path)
        # control pieces decode to nothing
        self.out = [p.piece.replace(BLANK, " ").encode() if p.type in (kind.NORMAL, kind.USER_DEFINED)
                    else bytes([int(p.piece[1:-1], 16)]) if p.type == kind.BYTE
                    else " ⁇ ".encode() if p.type == kind.UNKNOWN else b"" for p in proto.pieces]
        self.longest = max(map(len, self.pieces), default=1)
        self.unknown_score = min((s for _, s in self.pieces.values()), default=0.0) - UNKNOWN_PENALTY
        self.prefixes = {p[:k] for p in self.pieces for k in range(1, len(p))}
        crossing = any(BLANK in p.lstrip(BLANK) for p in self.pieces)
        lines = not any("\n" in p and len(p) > 1 for p in self.pieces)
        # where no piece crosses into a blank, or over a line end, texts are cut there
        self.cut = None if crossing else re.compile(rf"\n|{BLANK}*[^{BLANK}\n]+|{BLANK}+" if lines else rf"{BLANK}*[^{BLANK}]+|{BLANK}+")

    @cached_property
    def joins(self) -> set[str]:
        """All two neighbouring characters inside a piece: no piece crosses other boundaries."""
        return {p[k:k + 2] for p in self.pieces for k in range(len(p) - 1)}

    def stretches(self, part: str) -> list[str]:
        """part, cut at boundaries that no piece can cross."""
        joins, out, at = self.joins, [], 0
        for k in range(1, len(part)):
            if part[k - 1:k + 1] not in joins:
                out.append(part[at:k])
                at = k
        out.append(part[at:])
        return out

    @cached_property
    def steps(self) -> dict[str, tuple[int, float, bool]]:
        """Id (-1: none), score, and whether longer pieces begin so, of each piece and beginning of one."""
        begun = {p: (-1, 0.0, True) for p in self.prefixes}
        return begun | {p: (i, score, p in begun) for p, (i, score) in self.pieces.items()}

    def normal(self, text: str) -> str:
        if self.library:
            return self.library.normalize(text)
        text = text.replace(" ", BLANK)
        return BLANK + text if self.prefix and text else text

    def character(self, c: str) -> list[int]:
        """Ids of a character that no piece holds."""
        return [self.bytes[b] for b in c.encode()] if self.bytes else [self.unknown]


def viterbi(text: str, v: Vocabulary) -> Iterator[list[int]]:
    """Ids of the best segmentation of a normalised text, a list for each committed stretch."""
    step_of, unknown_score, longest = v.steps.get, v.unknown_score, v.longest
    base, n = 0, len(text)
    score: dict[int, float] = {0: 0.0}  # of the boundaries ahead, at most the longest piece away
    back: dict[int, tuple[int, int]] = {}  # boundary: start and id of its best last piece; id -1 is an unknown character
    reach, check = 0, 4 * longest
    for i in range(n):
        here, single = score.pop(i), False
        for j in range(i + 1, min(n, i + longest) + 1):
            step = step_of(text[i:j])
            if step is None:
                break
            id_, gain, more = step
            if id_ >= 0:
                total = here + gain
                if j not in score or total > score[j]:
                    score[j], back[j] = total, (i, id_)
                if j == i + 1:
                    single = True
                if j > reach:
                    reach = j
            if not more:
                break
        if not single:
            total = here + unknown_score
            if i + 1 not in score or total > score[i + 1]:
                score[i + 1], back[i + 1] = total, (i, -1)
            reach = max(reach, i + 1)
        if reach == i + 1:
            meet = reach  # every path ends here
        elif i + 1 - base >= check:
            live = set(score)
            while len(live) > 1:  # follow the furthest path back until all have met
                last = max(live)
                live.remove(last)
                live.add(back[last][0])
            meet = live.pop()
            check = 4 * longest if meet > base else i + 1 - base + 4 * longest
        else:
            continue
        if meet > base:
            ids, at = [], meet
            while at > base:
                at, id_ = back[at]
                if id_ >= 0:
                    ids.append(id_)
                else:
                    ids += reversed(v.character(text[at]))
            ids.reverse()
            yield ids
            base = meet
            back = {k: b for k, b in back.items() if k > base} if reach > base else {}
            if len(score) == 1:
                score = {k: 0.0 for k in score}  # sums start again where all paths met


class Codec:
    def __init__(self, path: str):
        self.v = Vocabulary(path)
        self.memo: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def segment(self, part: str) -> bytes:
        if len(part) > MEMO_CHARS:
            return b"".join(np.array(ids, "<i4").tobytes() for ids in viterbi(part, self.v))
        out = self.old.get(part)
        if out is None:
            some = self.v.stretches(part)
            if len(some) > 1:
                get = self.memo.get
                out = b"".join([self.segment(x) if (known := get(x)) is None else known for x in some])
            else:
                out = np.array([x for ids in viterbi(part, self.v) for x in ids], "<i4").tobytes()
        if len(self.memo) >= MEMO:
            self.memo, self.old = {}, self.memo
        self.memo[part] = out
        return out

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, "<i4")
        text = self.v.normal(text)
        if self.v.cut is None:
            data = b"".join(np.array(ids, "<i4").tobytes() for ids in viterbi(text, self.v))
        else:
            segment = self.segment
            data = b"".join([segment(p) if (known := self.memo.get(p)) is None else known for p in self.v.cut.findall(text)])
        return np.frombuffer(data, "<i4")

    def decode(self, ids: np.ndarray | list[int] | None) -> str:
        if ids is None or not len(ids):
            return ""
        out = self.v.out
        text = b"".join([out[i] for i in (ids.tolist() if isinstance(ids, np.ndarray) else ids)]).decode("utf-8", "replace")
        return text[1:] if self.v.prefix and text[:1] == " " else text


def codec_of(path: str) -> Codec:
    """One for all tasks of a worker."""
    return held(Codec, path)


def coded(text: Column, path: str) -> Column:
    """Struct of ids, their ids_crc32, and the text that they decode to, in one step and with one vocabulary."""

    @F.pandas_udf("ids array<int>, ids_crc32 long, text string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = codec_of(path)

        def out(held: list[np.ndarray]) -> pd.DataFrame:
            return pd.DataFrame({"ids": pd.Series(held, dtype=object), "ids_crc32": pd.Series([zlib.crc32(x.tobytes()) for x in held], dtype="int64"),
                                 "text": pd.Series([codec.decode(x) for x in held], dtype=object)})

        for texts in parts:
            held, size = [], 0
            for t in texts:
                held.append(codec.encode(t))
                size += held[-1].nbytes
                if size > BLOCK:
                    yield out(held)
                    held, size = [], 0
            if held or not len(texts):
                yield out(held)

    return run.asNondeterministic()(text)


def encode(text: Column, path: str) -> Column:
    """Array of ids."""

    @F.pandas_udf("array<int>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = codec_of(path)
        for texts in parts:
            yield pd.Series([codec.encode(t) for t in texts], dtype=object)

    return run.asNondeterministic()(text)


def decode(ids: Column, path: str) -> Column:
    @F.pandas_udf("string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = codec_of(path)
        for some in parts:
            yield pd.Series([codec.decode(x) for x in some], dtype=object)

    return run.asNondeterministic()(ids)


def ids_crc32(ids: Column) -> Column:
    """Unsigned crc32 of ids as little-endian 32-bit integers."""

    @F.pandas_udf("long")
    def run(some: pd.Series) -> pd.Series:
        return pd.Series([zlib.crc32(np.asarray(x, "<i4").tobytes()) if x is not None else 0 for x in some], dtype="int64")

    return run(ids)
