"""Language ID in two levels: a language family first, then one-versus-one linear support vector machines inside it.

Families are learned too: the languages' mean vectors are merged, nearest first, into about the square root of their number.
Features are hashed letter trigrams of the lower-cased text, square roots scaled to unit length.  The machines are fitted on a
bounded sample of labelled rows (``fit_rows``), whose vectors have a fixed size however long the texts are; every text is predicted whole.

Null texts and texts without a letter are ``und`` with score 0, as is all if there is nothing to learn from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
BITS = 12
SIZE = 1 << BITS
#: Rows of the fitting sample over all languages.
FIT_ROWS = 3_000
SLICE = 1 << 20
ROWS = 256


def vector(text: str | None) -> np.ndarray | None:
    """Unit vector of hashed letter trigrams; runs of other characters count as one space.  None without a letter."""
    if not text or not any(map(str.isalpha, text)):
        return None
    counts = np.zeros(SIZE, np.int64)
    for i in range(0, len(text), SLICE):
        c = np.frombuffer((" " + text[max(0, i - 2):i + SLICE].lower() + " ").encode("utf-32-le", "replace"), np.uint32)
        c = np.where(((c >= 97) & (c <= 122)) | (c >= 0xC0), c, np.uint32(0))
        c = c[np.concatenate(([True], (c[1:] != 0) | (c[:-1] != 0)))]
        if len(c) > 2:
            h = (c[:-2] * np.uint32(0x9E3779B1) ^ c[1:-1] * np.uint32(0x85EBCA77) ^ c[2:] * np.uint32(0xC2B2AE3D)) * np.uint32(0x27D4EB2F)
            counts += np.bincount(h >> np.uint32(32 - BITS), minlength=SIZE)
    v = np.sqrt(counts, dtype=np.float32)
    return v / max(float(np.linalg.norm(v)), 1e-9)


def svm(x: np.ndarray, y: np.ndarray, penalty: float = 1e-4, steps: int = 120) -> np.ndarray:
    """Linear support vector machine (squared hinge loss, classes weighed alike) by accelerated gradient steps; the bias comes last, as x's last column of ones."""
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32)
    w = ahead = np.zeros(x.shape[1], np.float32)
    rate = 1 / (2 * 2.0 + penalty)  # rows have squared length 2 with the bias, weights sum to 1
    for t in range(steps):
        slack = np.maximum(0, 1 - y * (x @ ahead))
        step = ahead - rate * (penalty * ahead - 2 * x.T @ (weight * y * slack))
        ahead = step + (t / (t + 3)) * (step - w)
        w = step
    return w


@dataclass
class Model:
    families: list[list[str]]
    #: One column for each family, against all others; then one for each pair inside a family.
    planes: np.ndarray
    pairs: list[tuple[str, str]]

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        margins = x @ self.planes[:-1] + self.planes[-1]
        n = len(self.families)
        family = margins[:, :n].argmax(1)
        sure = 1 / (1 + np.exp(-2 * margins[:, :n].max(1))) if n > 1 else np.ones(len(x))
        lang, score = np.empty(len(x), object), np.zeros(len(x))
        for f, names in enumerate(self.families):
            rows = np.flatnonzero(family == f)
            votes, total = np.zeros((len(rows), len(names))), np.zeros((len(rows), len(names)))
            for k, (a, b) in enumerate(self.pairs):
                if a in names:
                    m = margins[rows, n + k]
                    for name, sign in ((a, 1), (b, -1)):
                        i = names.index(name)
                        votes[:, i] += sign * m > 0
                        total[:, i] += 1 / (1 + np.exp(-2 * sign * m))
            best = np.lexsort((total, votes), axis=1)[:, -1] if len(rows) else np.zeros(0, int)
            lang[rows] = np.array(names, object)[best]
            share = total[np.arange(len(rows)), best] / (len(names) - 1) if len(names) > 1 else 1.0
            score[rows] = sure[rows] * share
        return list(lang), np.round(np.clip(score, 0, 1), 6)


def families_of(means: dict[str, np.ndarray]) -> list[list[str]]:
    """Languages in about sqrt(n) families, merging the two whose means are nearest on average."""
    groups = [[k] for k in sorted(means)]
    while len(groups) > max(1, round(len(means) ** 0.5)):
        near = {(i, j): np.mean([means[a] @ means[b] for a in groups[i] for b in groups[j]])
                for i, j in combinations(range(len(groups)), 2)}
        i, j = max(near, key=near.get)
        groups[i] += groups.pop(j)
    return groups


def learn(x: np.ndarray, lang: np.ndarray) -> Model:
    """x: a vector in each row, with a one behind it."""
    names = sorted(set(lang))
    means = {k: (m := x[lang == k, :SIZE].mean(0)) / max(float(np.linalg.norm(m)), 1e-9) for k in names}
    families = families_of(means)
    sign = lambda hit: np.where(hit, 1, -1).astype(np.float32)
    planes = [svm(x, sign(np.isin(lang, f))) if len(families) > 1 else np.ones(SIZE + 1, np.float32) for f in families]
    pairs = [p for f in families for p in combinations(f, 2)]
    for a, b in pairs:
        rows = (lang == a) | (lang == b)
        planes.append(svm(x[rows], sign(lang[rows] == a)))
    return Model(families, np.stack(planes, 1), pairs)


def packed(v: np.ndarray) -> bytes:
    """The places and values of a vector that are not 0, as far as that is shorter."""
    at = np.flatnonzero(v).astype("<u2")
    return v.astype("<f4").tobytes() if 6 * len(at) >= 4 * SIZE else at.tobytes() + v[at].astype("<f4").tobytes()


def unpacked(data: bytes, out: np.ndarray) -> None:
    """Puts a packed vector into a row of zeros."""
    if len(data) == 4 * SIZE:
        out[:] = np.frombuffer(data, "<f4")
    else:
        n = len(data) // 6
        out[np.frombuffer(data, "<u2", n)] = np.frombuffer(data, "<f4", n, 2 * n)


def vectors(text: Column) -> Column:
    @F.pandas_udf("binary")
    def make(texts: pd.Series) -> pd.Series:
        return pd.Series([None if (v := vector(t)) is None else packed(v) for t in texts], dtype=object)

    return make.asNondeterministic()(text)


def fit(rows: DataFrame, fit_rows: int = FIT_ROWS, text: str = "text", lang: str = "lang", key: str = "doc_id") -> Model | None:
    """Learn from about fit_rows rows, as many of each language as there are: those whose keys hash lowest within it."""
    labelled = rows.select(F.col(text).alias("_text"), F.col(lang).alias("_lang"), F.xxhash64(key).alias("_hash"))
    labelled = labelled.where("_text IS NOT NULL AND _lang IS NOT NULL")
    counts = {r["_lang"]: r["n"] for r in labelled.groupBy("_lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    each = -(-fit_rows // len(counts))
    top = F.lit(1 << 32)
    share = F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, min(1.0, each / n))])
    chosen = labelled.where(F.pmod("_hash", top) < F.element_at(share, F.col("_lang")) * top)
    got = (chosen.select("_lang", "_hash", vectors(F.col("_text")).alias("_v")).where("_v IS NOT NULL")
           .orderBy("_hash", "_lang", "_v").limit(2 * fit_rows).toPandas())
    if got.empty:
        return None
    # one matrix in the driver, into which vectors go one by one
    x = np.zeros((len(got), SIZE + 1), np.float32)
    x[:, SIZE] = 1
    for row, v in zip(x, got["_v"]):
        unpacked(v, row[:SIZE])
    langs = got["_lang"].to_numpy()
    del got
    return learn(x, langs)


def predict(text: Column, model: Model | None, spark) -> Column:
    """Struct of lang and score.  The model's size follows from the number of languages, not of rows."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for texts in parts:
            langs, scores = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
            for i in range(0, len(texts) if m else 0, ROWS):
                got = [(i + j, v) for j, t in enumerate(texts.iloc[i:i + ROWS]) if (v := vector(t)) is not None]
                if got:
                    at = [j for j, _ in got]
                    langs[at], scores[at] = m.predict(np.stack([v for _, v in got]))
            yield pd.DataFrame({"lang": langs, "score": scores})

    return run.asNondeterministic()(text)


def held_out(doc_id: Column) -> Column:
    """One of four folds by id is never learned from; a null id is in none."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))
