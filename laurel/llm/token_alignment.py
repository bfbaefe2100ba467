"""Cross-tokenizer alignment of whole texts by an associative fragment monoid.

Two tokenizers, A and B, cut the same bytes.  Where tokens of both end, a group ends.  A fragment is what a stretch of a text says about that:
its head (tokens up to the first common end, which may belong to a group that began before), its closed groups, and its tail (tokens behind the
last common end).  Two neighbouring fragments compose to one: tail and next head form a group.  Composition is associative and has an identity, so
fragments of a text can be composed in any tree.

Both tokenizers go on independently after places where a blank follows a character that is no white space, A also before other white space there
(``Tokenizers`` checks the vocabulary of B; with pieces that cross blanks texts are encoded whole).  Short texts are composed of the parts between those
places inside one task, and parts seen lately are looked up.  Texts of more than ``long_chars`` are dealt to tasks in chunks of about ``chunk_chars``; a
chunk has A's tokens from A's first such place in it to the one in the next chunk, and B's likewise, so that its fragment is open at both ends; then fragments
are composed by ``FAN`` neighbours at a time, round by round.  A stretch without such a place is one chunk, as it has to be encoded whole.

Links are the pairs of an A and a B token whose byte ranges overlap.  They are counted by pair over the corpus: in each task first, then by key.  Tasks
look counts up in sorted files (``lookup``).

A null or empty text, or one that a tokenizer does not give back, has no tokens.  Repeated rows count each; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate, chain, islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laurel.llm.lookup import lookup, write_lookup
from laurel.session import staged

LONG_CHARS, CHUNK_CHARS, FAN = 1 << 16, 1 << 15, 8
#: Parts that a worker remembers: twice this number at most, those used lately among them.
MEMO, MEMO_CHARS = 120_000, 48
#: Characters of text that are encoded together, links that are looked up together, parts that A encodes as one text.
BLOCK, LINKS, JOINED = 1 << 20, 2_000_000, 256
#: A blank behind a character that is no white space begins a part, but for a last one: B adds a part's first blank itself, to what is not empty.
PART = re.compile(r" (?:[^ ]+|(?<=\s) +| \Z)*")
CUT_A = re.compile("(?<=\\S)(?=[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000])")
CUT_B = re.compile(r"(?<=\S)(?= (?!\Z))")


class Tokenizers:
    """A: a byte-level BPE of the tokenizers library; B: a SentencePiece model.  Bytes of every id."""

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        known = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves in a byte-level vocabulary
        spare = {256 + i: b for i, b in enumerate(b for b in range(256) if b not in set(known))}
        byte_of = {chr(b): b for b in known} | {chr(c): b for c, b in spare.items()}
        words = self.a.get_vocab()
        self.bytes_a = [b""] * (max(words.values()) + 1)
        for w, i in words.items():
            self.bytes_a[i] = bytes(byte_of[c] for c in w) if all(c in byte_of for c in w) else w.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.size_a, self.size_b = list(map(len, self.bytes_a)), list(map(len, self.bytes_b))
        self.crossing = any("▁" in p.lstrip("▁") for i, p in enumerate(pieces) if not self.b.is_control(i))
        self.sizes_a, self.sizes_b = np.array(self.size_a), np.array(self.size_b)
        n = max(len(self.size_a), len(self.size_b))
        #: Decimal ids of A, inside and at the end of a group, and of B, as they are written.
        self.written = np.array([[f"{i}{mark}" for i in range(n)] for mark in (",", "|", ",", ";")], object)
        self.shift = max(1, (len(self.bytes_b) - 1).bit_length())

    def encode_a(self, texts: list[str]) -> list[list[int] | None]:
        """Ids of texts that begin with a blank, as B's are; a text that the ids do not give back has None."""
        return given_back(texts, self._ids_a(texts), self.bytes_a)

    def _ids_a(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text.  Texts are encoded JOINED at a time: no token crosses from a character that is no white space to a blank."""
        out: list[list[int]] = []
        joined = [texts[i:i + JOINED] for i in range(0, len(texts), JOINED)]
        found = self.a.encode_batch_fast(["".join(x) for x in joined], add_special_tokens=False)
        for some, e in zip(joined, found):
            ids = e.ids
            ends = np.cumsum(self.sizes_a[ids])
            want = np.cumsum([len(x.encode("utf-8", "replace")) for x in some])
            cut = np.searchsorted(ends, want)
            if any(x[-1:].isspace() for x in some[:-1]) or not len(ids) or cut[-1] >= len(ends) or (ends[cut] != want).any():
                out += [e.ids for e in self.a.encode_batch_fast(some, add_special_tokens=False)]
            else:
                at = [0, *(cut + 1).tolist()]
                out += [ids[i:j] for i, j in zip(at, at[1:])]
        return out

    def encode_b(self, texts: list[str]) -> list[list[int] | None]:
        return given_back(texts, self.b.encode([t[1:] for t in texts], num_threads=1), self.bytes_b)


def given_back(texts: list[str], found: list[list[int]], bytes_of: list[bytes]) -> list[list[int] | None]:
    join = lambda ids: b"".join(map(bytes_of.__getitem__, ids))
    if join(chain.from_iterable(found)) == "".join(texts).encode("utf-8", "replace"):
        # each text begins with a blank behind which no token goes on, so all are given back if they are together
        return found
    return [ids if join(ids) == t.encode("utf-8", "replace") else None for t, ids in zip(texts, found)]


@dataclass
class Open:
    """Tokens of an open group: ids and sizes in bytes, for A and B."""

    a: list[int] = field(default_factory=list)
    size_a: list[int] = field(default_factory=list)
    b: list[int] = field(default_factory=list)
    size_b: list[int] = field(default_factory=list)

    def __add__(self, other: Open) -> Open:
        return Open(self.a + other.a, self.size_a + other.size_a, self.b + other.b, self.size_b + other.size_b)

    def part(self, i: int, j: int, k: int, m: int) -> Open:
        return Open(self.a[i:j], self.size_a[i:j], self.b[k:m], self.size_b[k:m])

    def text(self) -> str:
        return ",".join(map(str, self.a)) + "|" + ",".join(map(str, self.b))

    def links(self, shift: int) -> list[int]:
        """Code of every overlapping pair: the id of A, then that of B in the low bits."""
        out, i, j = [], 0, 0
        a, b, ends_a, ends_b = self.a, self.b, list(accumulate(self.size_a)), list(accumulate(self.size_b))
        while i < len(a) and j < len(b):
            out.append(a[i] << shift | b[j])
            x, y = ends_a[i], ends_b[j]
            i += x <= y
            j += y <= x
        return out

    def dump(self) -> bytes:
        return np.array([len(self.a), len(self.b), *self.a, *self.size_a, *self.b, *self.size_b], "<i4").tobytes()

    @classmethod
    def load(cls, data: bytes) -> Open:
        x = np.frombuffer(data, "<i4").tolist()
        n, m = x[:2]
        return cls(x[2:2 + n], x[2 + n:2 + 2 * n], x[2 + 2 * n:2 + 2 * n + m], x[2 + 2 * n + m:])


@dataclass
class Fragment:
    """head, closed groups (their text and links) and tail; ``cut`` is False if no group ends inside, and all is in head.

    ``lead`` is how many bytes behind A's first token B's begins (negative: before).  Heads end and tails begin where tokens of both end.
    """

    cut: bool = False
    lead: int = 0
    head: Open = field(default_factory=Open)
    tail: Open = field(default_factory=Open)
    groups: list[str] = field(default_factory=list)
    n_groups: int = 0
    links: list[int] = field(default_factory=list)

    def empty(self) -> bool:
        return not (self.cut or self.head.a or self.head.b)

    def then(self, other: Fragment, shift: int) -> Fragment:
        """Composition: what lies open between both is looked through for common ends again, as each may have held one of the two tokens."""
        if self.empty() or other.empty():
            return other if self.empty() else self
        f = scan(self.tail + other.head, 0, shift) if self.cut else scan(self.head + other.head, self.lead, shift)
        f.lead = self.lead
        if self.cut:
            f.head, f.groups, f.n_groups, f.links = self.head, self.groups + f.groups, self.n_groups + f.n_groups, self.links + f.links
        if other.cut:
            f.tail, f.groups, f.n_groups, f.links = other.tail, f.groups + other.groups, f.n_groups + other.n_groups, f.links + other.links
        return f


def scan(o: Open, lead: int, shift: int) -> Fragment:
    """Fragment of tokens.  The places where the first of them begin are ends of tokens before them."""
    ends_a, ends_b = list(accumulate(o.size_a)), list(accumulate(o.size_b, initial=lead))[1:]
    common = sorted({0, *ends_a} & {lead, *ends_b})
    if not common:
        return Fragment(False, lead, o)
    out, i, j = Fragment(True, lead), 0, 0
    for n, end in enumerate(common):
        ii, jj = bisect_right(ends_a, end, i), bisect_right(ends_b, end, j)
        group = o.part(i, ii, j, jj)
        if n == 0:
            out.head = group
        else:
            out.groups.append(group.text())
            out.links += group.links(shift)
            out.n_groups += 1
        i, j = ii, jj
    out.tail = o.part(i, len(ends_a), j, len(ends_b))
    return out


def whole(f: Fragment, shift: int) -> Fragment:
    """The fragment of a text from its beginning to its end, which both are ends of groups."""
    edge = Fragment(True)
    return edge.then(f, shift).then(edge, shift)


def closed(a: list[list[int]], b: list[list[int]], t: Tokenizers) -> list[tuple[int, str, bytes]]:
    """Number of groups, their text and the links' codes of parts that begin and end with a group, all at once.

    The parts' tokens lie behind each other, so that their ends are common ends.
    """
    n_a, n_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (a, b))
    ids_a, ids_b = (np.fromiter(chain.from_iterable(x), np.int64, n.sum()) for x, n in ((a, n_a), (b, n_b)))
    ends_a, ends_b = np.cumsum(t.sizes_a[ids_a]), np.cumsum(t.sizes_b[ids_b])
    # between two neighbouring ends of either lies one link
    both = np.union1d(ends_a, ends_b)
    at_a, at_b = np.searchsorted(ends_a, both), np.searchsorted(ends_b, both)
    codes = (ids_a[at_a].astype(np.uint64) << np.uint64(t.shift)) | ids_b[at_b].astype(np.uint64)
    shared = (ends_a[at_a] == both) & (ends_b[at_b] == both)
    last_a, last_b = np.zeros(len(ids_a), bool), np.zeros(len(ids_b), bool)
    last_a[at_a[shared]] = True
    last_b[at_b[shared]] = True
    groups_a, groups_b = (np.cumsum(x) - x for x in (last_a, last_b))  # number of each token's group
    before_a, before_b = (np.concatenate(([0], np.flatnonzero(x) + 1)) for x in (last_a, last_b))  # tokens before each group
    words = np.empty(len(ids_a) + len(ids_b), object)
    words[np.arange(len(ids_a)) + before_b[groups_a]] = t.written[last_a.astype(np.int64), ids_a]
    words[np.arange(len(ids_b)) + before_a[groups_b + 1]] = t.written[2 + last_b.astype(np.int64), ids_b]
    stop_a, stop_b = np.cumsum(n_a), np.cumsum(n_b)
    stop_words, stop_groups = (stop_a + stop_b).tolist(), np.cumsum(last_a)[stop_a - 1].tolist()
    stop_links = (8 * (np.searchsorted(both, ends_a[stop_a - 1]) + 1)).tolist()
    words, codes, out = words.tolist(), codes.tobytes(), []
    w = g = c = 0
    for ww, gg, cc in zip(stop_words, stop_groups, stop_links):
        out.append((gg - g, "".join(words[w:ww]), codes[c:cc]))
        w, g, c = ww, gg, cc
    return out


_kept: dict = {}


def tokenizers(path_a: str, path_b: str) -> Tokenizers:
    """One for all tasks of a worker."""
    if (path_a, path_b) not in _kept:
        _kept.clear()
        _kept[path_a, path_b] = Tokenizers(path_a, path_b)
    return _kept[path_a, path_b]


class Aligner:
    """Aligns texts part by part.  Two generations of parts are remembered: when the young one is full it becomes the old one."""

    def __init__(self, t: Tokenizers):
        self.t, self.young, self.old = t, {}, {}

    def learn(self, parts: list[str]) -> dict[str, tuple | None]:
        """Of each part: numbers of A and B tokens and of groups, the groups' text, the links' codes; None if it is not given back."""
        found = dict.fromkeys(parts)
        both = zip(parts, self.t.encode_a(parts), self.t.encode_b(parts))
        good = [(p, a, b) for p, a, b in both if a and b]
        if good:
            parts, a, b = zip(*good)
            found.update((p, (len(x), len(y), *got)) for p, x, y, got in zip(parts, a, b, closed(a, b, self.t)))
        return found

    def align(self, texts: list[str | None]) -> list[tuple]:
        """n_a, n_b, n_groups, sha256 of the groups, codes of the links (64-bit), for each text."""
        split = [() if not x else [" " + x] if self.t.crossing else PART.findall(" " + x) for x in texts]
        new, known = [], {}
        for p in set().union(*split):
            if p in self.young:
                known[p] = self.young[p]
            elif p in self.old:
                known[p] = self.old[p]
            else:
                new.append(p)
        new.sort(key=lambda p: p[-1:].isspace())  # those that end in white space are encoded one by one
        known.update(self.learn(new))
        for p, x in known.items():
            if len(p) <= MEMO_CHARS:
                self.young[p] = x
                if len(self.young) >= MEMO:
                    self.young, self.old = {}, self.young
        out = []
        for parts in split:
            got = [known[p] for p in parts]
            if not got or None in got:
                out.append((0, 0, 0, "", b""))
                continue
            n_a, n_b, groups, text, codes = zip(*got)
            out.append((sum(n_a), sum(n_b), sum(groups), hashlib.sha256("".join(text)[:-1].encode()).hexdigest(), b"".join(codes)))
        return out


SHAPE = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, codes binary, times binary"


def rows_of(ids: list, found: list[tuple]) -> pa.RecordBatch:
    """Links as distinct codes and how often each occurs."""
    codes, times, links = [], [], []
    for x in found:
        c, n = np.unique(np.frombuffer(x[4], "<u8"), return_counts=True)
        codes.append((c.astype("<u4") if not len(c) or c[-1] < 1 << 32 else c).tobytes())
        times.append((n.astype("<u1") if not len(n) or n.max() < 256 else n.astype("<u8")).tobytes())
        links.append(len(x[4]) // 8)
    columns = [pa.array(ids, pa.int64()), *[pa.array([x[i] for x in found], pa.int64()) for i in range(3)], pa.array(links, pa.int64()),
               pa.array([x[3] for x in found], pa.string()), pa.array(codes, pa.binary()), pa.array(times, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "codes", "times"])


def links_of(codes: bytes, times: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes and their numbers; their widths follow from the lengths."""
    if not codes:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    width = {4: (4, 1), 8: (8, 1), 0.5: (4, 8), 1: (8, 8)}[len(codes) / len(times)]
    return np.frombuffer(codes, f"<u{width[0]}").astype(np.int64), np.frombuffer(times, f"<u{width[1]}").astype(np.int64)


def short_texts(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """docs: doc_id, text."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(tokenizers(path_a, path_b))
        for part in parts:
            ids, texts, size = [], [], 0
            for i, t in zip(part.column(0), part.column(1)):
                ids.append(i.as_py())
                texts.append(t.as_py())
                size += len(texts[-1] or "")
                if size > BLOCK:
                    yield rows_of(ids, aligner.align(texts))
                    ids, texts, size = [], [], 0
            if ids:
                yield rows_of(ids, aligner.align(texts))

    return docs.mapInArrow(run, SHAPE)


def chunks_of(text: str, chunk_chars: int, crossing: bool) -> Iterator[tuple[str, str, int]]:
    """Of space + text: A's stretch and B's stretch of each chunk, and where B's begins, in bytes from where A's does."""
    text = " " + text
    at_a = at_b = 0
    for end in range(chunk_chars, len(text) + chunk_chars, chunk_chars):
        last = end >= len(text) or crossing
        to_a = len(text) if last else max(at_a, m.start() if (m := CUT_A.search(text, max(1, end))) else len(text))
        to_b = len(text) if last else max(at_b, m.start() if (m := CUT_B.search(text, max(1, end))) else len(text))
        size = lambda x, y: len(text[x:y].encode("utf-8", "replace"))
        yield text[at_a:to_a], text[at_b:to_b], size(at_a, at_b) if at_b >= at_a else -size(at_b, at_a)
        at_a, at_b = to_a, to_b
        if to_a == to_b == len(text):
            return


def frames(rows: Iterator[dict], size: int = 64) -> Iterator[pd.DataFrame]:
    while some := list(islice(rows, size)):
        frame = pd.DataFrame(some)
        yield frame.assign(doc_id=pd.array([None if pd.isna(x) else int(x) for x in frame["doc_id"]], "Int64"))


STRETCH = "row string, no long, doc_id long, a string, b string, begin long"
PIECE = "row string, no long, doc_id long, good boolean, n_a long, n_b long, cut boolean, lead long, head binary, tail binary, groups string, n_groups long, links binary"


def piece(row: str, no: int, doc_id: int | None, good: bool, n_a: int, n_b: int, f: Fragment) -> dict:
    return {"row": row, "no": no, "doc_id": doc_id, "good": good, "n_a": n_a, "n_b": n_b, "cut": f.cut, "lead": f.lead, "head": f.head.dump(), "tail": f.tail.dump(),
            "groups": ";".join(f.groups), "n_groups": f.n_groups, "links": np.array(f.links, "<u8").tobytes()}


def fragment_of(r: dict) -> Fragment:
    links = np.frombuffer(r["links"], "<u8").tolist()
    return Fragment(r["cut"], int(r["lead"]), Open.load(r["head"]), Open.load(r["tail"]), r["groups"].split(";") if r["groups"] else [], int(r["n_groups"]), links)


def long_texts(docs: DataFrame, path_a: str, path_b: str, chunk_chars: int, fan: int = FAN) -> DataFrame:
    """docs: doc_id, text (of every length).  Chunks are dealt to tasks by (row, number)."""

    def cut(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        crossing = tokenizers(path_a, path_b).crossing
        made = ({"row": row, "no": no, "doc_id": doc_id, "a": a, "b": b, "begin": begin}
                for part in parts for row, doc_id, text in zip(part["row"], part["doc_id"], part["text"])
                for no, (a, b, begin) in enumerate(chunks_of(text, chunk_chars, crossing)))
        return frames(made)

    def align(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = tokenizers(path_a, path_b)

        def of(r) -> dict:
            a, b = (encode([x])[0] if x else [] for encode, x in ((t.encode_a, r.a), (t.encode_b, r.b)))
            good = a is not None and b is not None
            o = Open(a, [t.size_a[i] for i in a], b, [t.size_b[i] for i in b]) if good else Open()
            f = scan(o, int(r.begin), t.shift) if good and (a or b) else Fragment()
            return piece(r.row, r.no, r.doc_id, good, len(a or ()), len(b or ()), f)

        return frames(of(r) for part in parts for r in part.itertuples())

    def compose(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("no")
        good, shift = bool(part["good"].all()), tokenizers(path_a, path_b).shift
        total = Fragment()
        for r in part.itertuples() if good else ():
            total = total.then(fragment_of(r._asdict()), shift)
        made = piece(key[0], int(part["no"].iloc[0]) // fan, part["doc_id"].iloc[0], good, int(part["n_a"].sum()), int(part["n_b"].sum()), total)
        return next(frames(iter([made])))

    def finish(parts: Iterator[pd.DataFrame]) -> Iterator[pa.RecordBatch]:
        shift = tokenizers(path_a, path_b).shift
        for part in parts:
            for r in part.to_pylist():
                if r["good"] and (r["n_a"] or r["n_b"]):
                    f = whole(fragment_of(r), shift)
                    found = (r["n_a"], r["n_b"], f.n_groups, hashlib.sha256(";".join(f.groups).encode()).hexdigest(), np.array(f.links, "<u8").tobytes())
                else:
                    found = (0, 0, 0, "", b"")
                yield rows_of([r["doc_id"]], [found])

    # a row of its own for each text, fixed by staging; texts are dealt as chunks, so that a long one is encoded by many tasks
    named = staged(docs.select(F.expr("uuid()").alias("row"), "doc_id", "text").mapInPandas(cut, STRETCH), "alignment-chunks")
    spread = named.repartition(F.col("row"), F.col("no"))
    left = staged(spread.mapInPandas(align, PIECE), "alignment-fragments")
    most = left.agg(F.max("no")).first()[0] or 0
    while most:
        left = staged(left.groupBy("row", F.expr(f"no div {fan}").alias("_part")).applyInPandas(compose, PIECE), "alignment-fragments")
        most //= fan
    return left.mapInArrow(finish, SHAPE)


def aligned(docs: DataFrame, path_a: str, path_b: str, text: str = "text", key: str = "doc_id", long_chars: int = LONG_CHARS,
            chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, and the links as distinct codes (codes) with their numbers (times)."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    is_long = F.coalesce(F.length("text") > long_chars, F.lit(False))
    short = short_texts(rows.where(~is_long), path_a, path_b)
    long_ = rows.where(is_long)
    if long_.isEmpty():
        return short
    return short.unionByName(long_texts(long_, path_a, path_b, chunk_chars))


def pair_counts(found: DataFrame) -> DataFrame:
    """code and n (links of the corpus), summed in each task first."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def total() -> tuple[np.ndarray, np.ndarray]:
            code, back = np.unique(np.concatenate([c for c, _ in held]), return_inverse=True)
            n = np.zeros(len(code), np.int64)
            np.add.at(n, back, np.concatenate([n for _, n in held]))
            return code, n

        def out() -> Iterator[pa.RecordBatch]:
            code, n = total()
            for i in range(0, len(code), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(code[i:i + 100_000]), pa.array(n[i:i + 100_000])], names=["code", "n"])

        for part in parts:
            for c, n in zip(part.column(0), part.column(1)):
                held.append(links_of(c.as_py(), n.as_py()))
                size += len(held[-1][0])
                if size > LINKS:
                    held = [total()]
                    size = len(held[0][0])
                    if 2 * size > LINKS:
                        yield from out()
                        held, size = [], 0
        if held:
            yield from out()

    return found.select("codes", "times").mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def with_pair_counts(found: DataFrame, shift: int) -> DataFrame:
    """Adds n_best (links whose count is the highest that their B id has, ties included) and count_sum (counts over links)."""
    counts = staged(pair_counts(found), "pair-counts")
    b = F.col("code").bitwiseAND((1 << shift) - 1)
    best = counts.groupBy(b.alias("_b")).agg(F.max("n").alias("_most"))
    table = counts.withColumn("_b", b).join(best, "_b").select(F.col("code").alias("low"), F.lit(0).cast("long").alias("high"), "n",
                                                                (F.col("n") == F.col("_most")).cast("long").alias("best"))
    shards = write_lookup(table, ["n", "best"], "pair-table")

    def look(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = lookup(shards)

        def out(held: list, rows: list[int]) -> tuple[list[int], list[int]]:
            code, times = (np.concatenate(x) for x in zip(*held))
            distinct, back = np.unique(code, return_inverse=True)
            n, is_best = at.probe(distinct, np.zeros(len(distinct), np.int64), 2)[:, back]
            ends = np.cumsum(rows)
            cut = lambda x: np.diff(np.concatenate(([0], np.cumsum(x)))[np.concatenate(([0], ends))]).tolist()
            return cut(is_best * times), cut(n * times)

        for part in parts:
            best_, sum_, held, rows = [], [], [], []
            for c, n in zip(part.column("codes"), part.column("times")):
                held.append(links_of(c.as_py(), n.as_py()))
                rows.append(len(held[-1][0]))
                if sum(rows) > LINKS:
                    x, y = out(held, rows)
                    best_ += x
                    sum_ += y
                    held, rows = [], []
            if held:
                x, y = out(held, rows)
                best_ += x
                sum_ += y
            keep = [part.column(c) for c in KEPT]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(best_, pa.int64()), pa.array(sum_, pa.int64())], names=[*KEPT, "n_best", "count_sum"])

    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    return found.mapInArrow(look, schema)


KEPT = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


def alignment(docs: DataFrame, path_a: str, path_b: str, text: str = "text", key: str = "doc_id", long_chars: int = LONG_CHARS,
              chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """One row for each row of docs: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    found = staged(aligned(docs, path_a, path_b, text, key, long_chars, chunk_chars), "alignments")
    return with_pair_counts(found, tokenizers(path_a, path_b).shift)
