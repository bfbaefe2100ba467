"""Personal data: pattern spans, and a skip-chain conditional random field that adds spans the patterns miss.

Words (runs without white space) that hold a digit or ``@`` are the field's variables, each with one label: none, email, ip, card or phone.  Potentials:

- a word's features: its shape, counts of digits, checks (Luhn, parts up to 255), its neighbours' shapes and the word before it;
- chain: the labels of two neighbouring variables; other words are known to be none;
- skip: all words of a document that are alike (equal, or equal in their digits, or in the last seven of them) share one hidden variable, which favours that they agree, however
  far apart they are.  A group of n words costs n potentials, not n * n.

Marginals come from loopy sum-product message passing, ROUNDS rounds for all documents of a batch at once; a document's result depends on itself only.
A word is added where its label has at least SURE of the marginal and its base spans do not touch it; neighbouring words with one phone or card make one span, which has to hold
as many digits as its kind does (and a card's to pass Luhn's check).

Learning is piecewise: unary weights by logistic regression, chain and skip potentials from counts, all on the pattern spans of at most ``fit_rows`` rows that
have variables (chosen by hash), with as many words again whose checks are broken on purpose.  Without such rows only pattern spans are found.

Null and empty texts have no spans.  Repeated rows give repeated results; other columns stay as they are.  Texts are taken whole.
Spans are code points, end exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
LABELS = 1 + len(KINDS)
BITS = 12
#: Rows to learn from, at most; rounds of messages; least marginal of an added word.
FIT_ROWS, ROUNDS, SURE = 3_000, 12, 0.8
#: Variables that messages are passed between at once.
BATCH = 20_000

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# a run of digits is tried at its beginning only, and taken whole: what follows it is no digit
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
MARK = re.compile(r"[0-9@]")
VARIABLE = re.compile(r"[^\s]*[0-9@][^\s]*")
#: Marks around a word that are not part of it.
EDGES = ".,;:!?()[]{}<>\"'|#*$%&"


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(2 * d - 9 * (d > 4) for d in map(int, digits[-2::-2]))
    return (odd + even) % 10 == 0


def digits_of(s: str) -> str:
    return "".join(DIGIT.findall(s))


def small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def emails(text: str) -> Iterator[tuple[int, int]]:
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        if m := DOMAIN.match(text, at + 1):
            while start > free and text[start - 1] in LOCAL:
                start -= 1
            if start < at:
                yield start, m.end()
                free = m.end()
                at = text.find("@", free)
                continue
        free, at = at + 1, text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of what the patterns find, by start, then kind."""
    found = [(a, "email", b) for a, b in emails(text)]
    if DIGIT.search(text):
        found += [(m.start(), "ip", m.end()) for m in IP.finditer(text) if all(map(small, m[0].split(".")))]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14 and 14 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
                found.append((m.start(), "card", m.end()))
        if "+" in text:
            found += [(m.start(), "phone", m.end()) for m in PHONE.finditer(text) if 10 <= len(digits_of(m[0])) <= 15]
    return ordered(found)


def doubtful(text: str) -> list[tuple[int, str, int]]:
    """Runs that look like a card or phone but fail its check: they may hold one beside other digits, so nothing is learned from them."""
    found = {(m.start(), "card", m.end()) for m in CARD.finditer(text)} | {(m.start(), "phone", m.end()) for m in PHONE.finditer(text)}
    return ordered(s for s in found.difference(base_spans(text)) if len(digits_of(text[s[0]:s[2]])) >= 10)


def ordered(found) -> list[tuple[int, str, int]]:
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[1]), s[2]))


# variables of a text

@dataclass
class Words:
    """Variables of one text: their spans without marks around them, the words, and whether the one before is their neighbour."""

    spans: list[tuple[int, int]]
    words: list[str]
    joined: list[bool]
    before: list[str]
    after: list[str]


def variables(text: str) -> Words:
    out, end = Words([], [], [], [], []), -1
    for m in VARIABLE.finditer(text):
        word = m[0]
        core = word.strip(EDGES)
        a = m.start() + (word.find(core) if core else 0)
        out.spans.append((a, a + len(core)))
        out.words.append(core)
        gap = text[end:m.start()] if end >= 0 else None
        out.joined.append(gap is not None and (len(gap) <= 3 and gap.isspace()))
        out.before.append(neighbour(text[max(0, m.start() - 32):m.start()], -1))
        out.after.append(neighbour(text[m.end():m.end() + 32], 0))
        end = m.end()
    return out


def neighbour(near: str, which: int) -> str:
    parts = near.split()
    return parts[which] if parts else ""


SHAPES = [(re.compile(r"[0-9]"), "0"), (re.compile(r"[A-Z]"), "A"), (re.compile(r"[^\W\d_]"), "a")]


def shape(word: str, most: int = 24) -> str:
    """Digits as 0, letters as a or A; runs of letters once, runs of digits with their length up to 9."""
    word = word[:most]
    for pattern, mark in SHAPES:
        word = pattern.sub(mark, word)
    word = re.sub(r"([Aa])\1+", r"\1", word)
    return re.sub(r"0+", lambda m: str(min(9, len(m[0]))), word)


def features(w: Words, i: int) -> list[int]:
    word, digits = w.words[i], digits_of(w.words[i][:64])
    own = shape(word)
    names = [f"s{own}", f"n{min(len(digits), 20)}", f"l{min(len(word), 24)}", f"b{shape(w.before[i])}", f"a{shape(w.after[i])}", f"t{w.before[i][:12].lower()}",
             f"s{own}b{shape(w.before[i])}", f"s{own}a{shape(w.after[i])}", f"c{int(14 <= len(digits) <= 19 and luhn(digits))}{int(digits == word)}",
             f"i{int(word.count('.') == 3 and all(map(str.isdigit, word.split('.'))) and all(map(small, word.split('.'))))}", f"e{int('@' in word)}{int('.' in word)}", "1"]
    return [xxhash.xxh32_intdigest(n) >> (32 - BITS) for n in names]


N_FEATURES = 12


def alike(word: str) -> list[str]:
    """Names of the groups of words that a word is in."""
    digits = digits_of(word)
    keys = [f"w{word.lower()}"]
    if len(digits) >= 7:
        keys += [f"d{digits}", f"e{digits[-7:]}"]
    return keys


def observed(w: Words, found: list[tuple[int, str, int]]) -> np.ndarray:
    """Label of each variable by the spans that touch it, 0 for none."""
    out = np.zeros(len(w.words), np.int64)
    spans = [(a, b, 1 + KINDS.index(k)) for a, k, b in found]
    at = 0
    for i, (a, b) in enumerate(w.spans):
        while at < len(spans) and spans[at][1] <= a and at + 1 < len(spans):
            at += 1
        for x, y, k in spans[max(0, at - 3):at + 4]:
            if x < b and a < y:
                out[i] = k
    return out


# the field

@dataclass
class Field:
    #: Log potentials: unary weights by feature and label, chain by label pair, and of agreement with a group's hidden label.
    unary: np.ndarray
    chain: np.ndarray
    agree: float

    def marginals(self, scores: np.ndarray, left: np.ndarray, member: np.ndarray, group: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
        """Of every variable, by loopy sum-product.

        scores: unary log potentials.  left: variables whose right neighbour, the next one, is joined to them.  member, group: memberships in groups.
        """
        n, right = len(scores), left + 1
        groups = int(group.max()) + 1 if len(group) else 0
        skip = np.where(np.eye(LABELS, dtype=bool), self.agree, 0.0)
        forth, back = np.zeros((len(left), LABELS)), np.zeros((len(left), LABELS))  # to the right, to the left
        up, down = np.zeros((len(member), LABELS)), np.zeros((len(member), LABELS))  # to the group, to the word
        for _ in range(rounds):
            total = scores.copy()
            np.add.at(total, right, forth)
            np.add.at(total, left, back)
            np.add.at(total, member, down)
            hidden = np.zeros((groups, LABELS))
            np.add.at(hidden, group, up)
            forth, back = (_normal(_through(total[left] - back, self.chain)), _normal(_through(total[right] - forth, self.chain.T)))
            up, down = (0.5 * up + 0.5 * _normal(_through(total[member] - down, skip)), 0.5 * down + 0.5 * _normal(_through(hidden[group] - up, skip)))
        total = scores.copy()
        np.add.at(total, right, forth)
        np.add.at(total, left, back)
        np.add.at(total, member, down)
        p = np.exp(total - total.max(1, keepdims=True)) if n else total
        return p / p.sum(1, keepdims=True)


def _through(message: np.ndarray, potential: np.ndarray) -> np.ndarray:
    """log of the sum over the sender's labels."""
    top = message.max(1, keepdims=True) if len(message) else message[:, :1]
    return np.log(np.exp(message - top) @ np.exp(potential)) + top


def _normal(message: np.ndarray) -> np.ndarray:
    return message - message.mean(1, keepdims=True)


def edges(texts: list[Words]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """left, member and group (see Field.marginals) of the variables of some texts."""
    left, member, group, n, names = [], [], [], 0, 0
    for w in texts:
        left += [n + i - 1 for i, joined in enumerate(w.joined) if joined and i]
        groups: dict[str, list[int]] = {}
        for i, word in enumerate(w.words):
            for key in alike(word):
                groups.setdefault(key, []).append(n + i)
        for some in groups.values():
            if len(some) > 1:
                member += some
                group += [names] * len(some)
                names += 1
        n += len(w.words)
    return np.array(left, np.int64), np.array(member, np.int64), np.array(group, np.int64)


def broken(word: str) -> str | None:
    """A word like this one whose checks fail: a digit of a card is another one, a part of an address is above 255."""
    if word.isdigit() and len(word) >= 14:
        return word[:-1] + str((int(word[-1]) + 5) % 10)
    if word.count(".") == 3 and word.replace(".", "").isdigit():
        head, _, rest = word.partition(".")
        return f"{int(head[:6]) + 256}.{rest}"
    return None


def learn(texts: list[str], steps: int = 150) -> Field | None:
    rows, labels, pairs, same = [], [], np.ones((LABELS, LABELS)), np.ones(2)
    for text in texts:
        w = variables(text)
        y = observed(w, base_spans(text))
        unsure = (observed(w, doubtful(text)) > 0) & (y == 0)
        for i in np.flatnonzero(~unsure).tolist():
            rows.append(features(w, i))
            if y[i] and (wrong := broken(w.words[i])):
                rows.append(features(Words(w.spans, [*w.words[:i], wrong, *w.words[i + 1:]], w.joined, w.before, w.after), i))
                labels += [y[i], 0]
            else:
                labels.append(y[i])
        left, member, group = edges([w])
        left, sure = left[~unsure[left] & ~unsure[left + 1]], ~unsure[member]
        member, group = member[sure], group[sure]
        np.add.at(pairs, (y[left], y[left + 1]), 1)
        for g in np.unique(group):
            some = y[member[group == g]]
            if some.any():
                same += [(some[1:] == some[:-1]).sum(), (some[1:] != some[:-1]).sum()]
    if not rows or not any(labels):
        return None
    x, y = np.array(rows), np.array(labels)
    unary = _regression(x, y, steps)
    # chain potentials beside the labels' own shares: how much more often two labels are neighbours than by chance
    share = pairs.sum(1, keepdims=True) * pairs.sum(0, keepdims=True) / pairs.sum()
    agree = float(np.clip(np.log(same[0] / same[1]) / 2, 0.5, 3.0))
    return Field(unary, np.clip(np.log(pairs / share), -3, 3), agree)


def _regression(x: np.ndarray, y: np.ndarray, steps: int, penalty: float = 1e-3) -> np.ndarray:
    """Multinomial logistic regression over hashed features by accelerated gradient steps; labels weigh alike in sum, but none counts most."""
    weight = 1 / np.bincount(y, minlength=LABELS).clip(1)[y]
    weight /= weight.sum()
    target = np.eye(LABELS)[y]
    w = ahead = np.zeros((1 << BITS, LABELS))
    rate = 4.0 / x.shape[1]
    for t in range(steps):
        z = ahead[x].sum(1)
        p = np.exp(z - z.max(1, keepdims=True))
        p = (p / p.sum(1, keepdims=True) - target) * weight[:, None]
        grad = np.stack([np.bincount(x.ravel(), np.repeat(p[:, k], x.shape[1]), 1 << BITS) for k in range(LABELS)], 1)
        step = ahead - rate * (LABELS * grad + penalty * ahead)
        ahead = step + (t / (t + 3)) * (step - w)
        w = step
    return w


def added(field: Field, texts: list[Words], base: list[list[tuple[int, str, int]]], whole: list[str]) -> list[list[tuple[int, str, int]]]:
    """Spans of words that the field labels and no pattern touches, for each text."""
    x = [features(w, i) for w in texts for i in range(len(w.words))]
    if not x:
        return [[] for _ in texts]
    known = np.concatenate([observed(w, b) for w, b in zip(texts, base)])
    scores = field.unary[np.array(x)].sum(1)
    scores[known > 0] = -12.0
    scores[known > 0, known[known > 0]] = 12.0  # what a pattern has found is evidence
    p = field.marginals(scores, *edges(texts))
    best = np.where((p.max(1) >= SURE) & (known == 0), p.argmax(1), 0)
    out, at = [], 0
    for w, text in zip(texts, whole):
        got, some = best[at:at + len(w.words)], []
        at += len(w.words)
        i = 0
        while i < len(got):
            j = i + 1
            if got[i]:
                kind = KINDS[got[i] - 1]
                while kind in ("phone", "card") and j < len(got) and got[j] == got[i] and w.joined[j]:
                    j += 1
                # a card may be one word or several
                for a, b in ([(i, j)] if holds(kind, text[w.spans[i][0]:w.spans[j - 1][1]]) else [(k, k + 1) for k in range(i, j)]):
                    s = (w.spans[a][0], kind, w.spans[b - 1][1])
                    if kind == "phone" and text[s[0] - 1:s[0]] == "(":
                        s = (s[0] - 1, kind, s[2])
                    if holds(kind, text[s[0]:s[2]]):
                        some.append(s)
            i = j
        out.append(some)
    return out


def holds(kind: str, span: str) -> bool:
    """Whether a span has what every one of its kind has."""
    digits = digits_of(span)
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 10 <= len(digits) <= 15 and re.fullmatch(r"[\x20()+.0-9-]+", span) is not None
    if kind == "ip":
        return span.count(".") == 3 and all(p.isdigit() and small(p) for p in span.split("."))
    return "@" in span and any(True for _ in emails(span))


# Spark

def has_variables(text: Column) -> Column:
    return F.coalesce(text.rlike("[0-9@]"), F.lit(False))


def fit(docs: DataFrame, fit_rows: int = FIT_ROWS, text: str = "text", key: str = "doc_id") -> Field | None:
    """Learn from at most fit_rows rows with variables whose ids and texts hash lowest; only what lies around variables comes to the driver."""
    rows = docs.where(has_variables(F.col(text))).select(F.xxhash64(F.col(key).cast("string"), F.col(text)).alias("_hash"), F.col(text).alias("_text"))
    bound = rows.select("_hash").distinct().orderBy("_hash").limit(fit_rows).agg(F.max("_hash")).first()[0]
    if bound is None:
        return None

    @F.pandas_udf("string")
    def near(texts: pd.Series) -> pd.Series:
        return pd.Series([surroundings(t) for t in texts], dtype=object)

    chosen = rows.where(F.col("_hash") <= bound).select("_hash", near("_text").alias("_near")).groupBy("_hash").agg(F.min("_near").alias("_near"))
    return learn(list(chosen.toPandas().sort_values("_hash")["_near"]))


def surroundings(text: str, reach: int = 64, most: int = 8_192) -> str:
    """What lies around the variables of a text, joined by line ends; a document adds at most so many characters to what is learned from."""
    out, end = [], -1
    for m in MARK.finditer(text):
        a, b = max(0, m.start() - reach), m.end() + reach
        if a <= end:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
        end = b
        if sum(y - x for x, y in out) > most:
            break
    return "\n\n\n\n".join(text[a:b] for a, b in out)


SPANS = "struct<base:array<struct<start:int,kind:string,end:int>>,added:array<struct<start:int,kind:string,end:int>>>"


def personal_data(text: Column, field: Field | None, spark) -> Column:
    """Struct of base and added spans.  The field's size is fixed (4096 features by 5 labels)."""
    shared = spark.sparkContext.broadcast(field)

    @F.pandas_udf(SPANS)
    def scan(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        as_rows = lambda s: [{"start": a, "kind": k, "end": b} for a, k, b in s]
        for texts in parts:
            base: list = [[] for _ in range(len(texts))]
            more: list = [[] for _ in range(len(texts))]
            held, words, size = [], [], 0

            def flush() -> None:
                if held and model is not None:
                    for i, some in zip(held, added(model, words, [base[i] for i in held], [texts.iloc[i] for i in held])):
                        more[i] = some
                held.clear()
                words.clear()

            for i, t in enumerate(texts):
                if t and MARK.search(t):
                    base[i] = base_spans(t)
                    if model is not None:
                        held.append(i)
                        words.append(variables(t))
                        size += len(words[-1].words)
                        if size > BATCH:
                            flush()
                            size = 0
            flush()
            yield pd.DataFrame({"base": [as_rows(s) for s in base], "added": [as_rows(s) for s in more]})

    return scan.asNondeterministic()(text)


def in_order(spans: Column) -> Column:
    """Spans by start, then by kind as listed in KINDS, then by end."""
    place = F.create_map(*[F.lit(v) for i, k in enumerate(KINDS) for v in (k, i)])
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), place[s["kind"]].alias("place"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.transform(F.array_sort(keyed), lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
