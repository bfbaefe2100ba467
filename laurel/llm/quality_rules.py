"""Quality rules: a decision list learned from labelled statistics, as ordered Spark conditional expressions.

``text_stats`` measures whole texts.  ``fit`` learns rules for rejected rows by sequential covering: each rule grows literal by literal
on two thirds of the rows it has left, is pruned on the other third, and stays if it is precise there; rows it covers are taken out
before the next.  ``DecisionList.kept`` is the list as one CASE expression of the statistics.

Null and empty texts have zero words.  Without labels of both values the list is empty and keeps all.  Repeated rows are measured each.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE, SYMBOLS = b" \t\n\v\f\r", b"#*$%&|<>"
SPACES = SPACE.decode()
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct_words", "n_upper", "n_digits",
         "n_bars", "n_marks", "longest_word")
#: Rows of the bounded fitting sample, and the most rules of a list.
FIT_ROWS, MAX_RULES = 10_000, 16
SLICE = 1 << 20


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more, the first occurrence included."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), np.int64, n)
    pairs = np.unique(w[:-1] * len(ids) + w[1:], return_inverse=True)[1]
    _, window, count = np.unique(pairs[:-1] * len(ids) + w[2:], return_inverse=True, return_counts=True)
    hit = count[window] > 1
    covered = np.zeros(n, bool)
    for i in range(3):
        covered[i:n - 2 + i] |= hit
    return int(covered.sum())


def measure(text: str | None) -> tuple[int, ...]:
    data = (text or "").encode()
    at = np.zeros(256, np.int64)
    for i in range(0, len(data), SLICE):
        at += np.bincount(np.frombuffer(data, np.uint8, min(SLICE, len(data) - i), i), minlength=256)
    words = data.split()  # bytes split at exactly these six ASCII spaces
    lines = Counter(x for x in (text or "").split("\n") if x.strip(SPACES))
    points = int(at.sum() - at[0x80:0xC0].sum())  # bytes that begin a code point
    return (len(words), points - int(at[list(SPACE)].sum()), int(at[list(SYMBOLS)].sum()), lines.total() - len(lines),
            repeated_words(words), lines.total(), len(set(words)), int(at[65:91].sum()), int(at[48:58].sum()), int(at[ord("|")]),
            int(at[ord("!")] + at[ord("?")]), max(map(len, words), default=0))


def text_stats(text: Column) -> Column:
    """Struct of the statistics of a text, as longs."""

    @F.pandas_udf(", ".join(f"{s} long" for s in STATS))
    def stats(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            yield pd.DataFrame([measure(t) for t in texts], columns=list(STATS), dtype="int64")

    return stats.asNondeterministic()(text)


def ratio(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def features() -> dict[str, Column]:
    """What the rules may test, as expressions of the statistics."""
    return {
        "n_words": F.col("n_words").cast("double"), "mean_word": ratio("word_chars", "n_words"),
        "symbol_share": ratio("n_symbols", "word_chars"), "dup_line_share": ratio("n_dup_lines", "n_lines"),
        "repeat_share": ratio("n_repeat_words", "n_words"), "distinct_share": ratio("n_distinct_words", "n_words"),
        "upper_share": ratio("n_upper", "word_chars"), "digit_share": ratio("n_digits", "word_chars"),
        "bars_per_word": ratio("n_bars", "n_words"), "marks_per_word": ratio("n_marks", "n_words"),
        "words_per_line": ratio("n_words", "n_lines"), "longest_word": F.col("longest_word").cast("double"),
    }


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass
class Rule:
    """Feature, True for at least or False for below, threshold: all have to hold."""

    literals: list[tuple[str, bool, float]]

    def covers(self, x: dict[str, np.ndarray]) -> np.ndarray:
        hit = np.ones(len(next(iter(x.values()))), bool)
        for name, above, cut in self.literals:
            hit &= (x[name] >= cut) == above
        return hit

    def column(self) -> Column:
        known = features()
        hit = F.lit(True)
        for name, above, cut in self.literals:
            hit &= (known[name] >= F.lit(cut)) if above else (known[name] < F.lit(cut))
        return hit

    def __str__(self) -> str:
        return " and ".join(f"{n} {'>=' if a else '<'} {c:.6g}" for n, a, c in self.literals)


@dataclass
class DecisionList:
    rules: list[Rule] = field(default_factory=list)

    def kept(self) -> Column:
        """The list as one conditional expression; the first rule that covers a row rejects it, else it is kept."""
        if not self.rules:
            return F.lit(True)
        case = F.when(self.rules[0].column(), F.lit(False))
        for r in self.rules[1:]:
            case = case.when(r.column(), F.lit(False))
        return case.otherwise(F.lit(True))

    def rule_number(self) -> Column:
        """1 for the first rule and so on; null where none covers the row."""
        return F.coalesce(*[F.when(r.column(), F.lit(i)) for i, r in enumerate(self.rules, 1)], F.lit(None).cast("int"))


def best_literal(x: dict[str, np.ndarray], bad: np.ndarray, among: np.ndarray) -> tuple[float, tuple[str, bool, float] | None]:
    """The threshold test with the highest FOIL gain over the rows in among."""
    p0, n0 = int((bad & among).sum()), int((~bad & among).sum())
    before = np.log2(p0 / (p0 + n0))
    best: tuple[float, tuple[str, bool, float] | None] = (0.0, None)
    for name, values in x.items():
        order = np.argsort(values[among], kind="stable")
        v, b = values[among][order], bad[among][order]
        cuts = np.flatnonzero(np.diff(v) > 0) + 1  # rows from here on are above
        if not len(cuts):
            continue
        below_p = np.cumsum(b)[cuts - 1]
        below_n = cuts - below_p
        for above, p, n in ((False, below_p, below_n), (True, p0 - below_p, n0 - below_n)):
            gain = np.where(p > 0, p * (np.log2(np.maximum(p, 1) / np.maximum(p + n, 1)) - before), 0.0)
            i = int(np.argmax(gain))
            if gain[i] > best[0] + 1e-9:
                best = (float(gain[i]), (name, above, float((v[cuts[i] - 1] + v[cuts[i]]) / 2)))
    return best


def grow(x: dict[str, np.ndarray], bad: np.ndarray, most: int) -> Rule:
    rule, among = Rule([]), np.ones(len(bad), bool)
    while len(rule.literals) < most and (bad & among).any() and (~bad & among).any():
        _, literal = best_literal(x, bad, among)
        if literal is None:
            break
        rule.literals.append(literal)
        among = rule.covers(x)
    return rule


def prune(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> tuple[Rule, float]:
    """The shortest beginning of the rule with the best (p - n) / (p + n), and its precision."""
    best = (-2.0, rule, 0.0)
    for k in range(1, len(rule.literals) + 1):
        short = Rule(rule.literals[:k])
        hit = short.covers(x)
        p, n = int((hit & bad).sum()), int((hit & ~bad).sum())
        worth = (p - n) / (p + n) if p + n else -1.0
        if worth > best[0] + 1e-9:
            best = (worth, short, p / max(p + n, 1))
    return best[1], best[2]


def learn(x: dict[str, np.ndarray], bad: np.ndarray, max_rules: int = MAX_RULES, max_literals: int = 4,
          min_precision: float = 0.9) -> DecisionList:
    """Sequential covering over feature arrays and the rejected rows."""
    found, left = DecisionList(), np.ones(len(bad), bool)
    third = np.arange(len(bad)) % 3 == 2
    while len(found.rules) < max_rules:
        parts = [left & ~third, left & third]
        if any(not (bad & p).any() for p in parts) or not (~bad & parts[0]).any():
            break
        a, b = ({k: v[p] for k, v in x.items()} for p in parts)
        rule, precision = prune(grow(a, bad[parts[0]], max_literals), b, bad[parts[1]])
        if not rule.literals or precision < min_precision:
            break
        found.rules.append(rule)
        left &= ~rule.covers(x)
    return found


def fit(stats: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, **options) -> DecisionList:
    """Learn from at most fit_rows labelled rows: those whose ids hash lowest, whatever the size of the table.

    stats: doc_id and the statistics; labels: doc_id and quality (0: reject).  Rows with nulls in either are left out.
    """
    chosen = (labels.select("doc_id", "quality").where("doc_id IS NOT NULL AND quality IS NOT NULL")
              .orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(fit_rows))
    names = features()
    rows = (stats.join(chosen, "doc_id").select("doc_id", "quality", *[c.alias(f"_{k}") for k, c in names.items()])
            .orderBy(F.xxhash64("doc_id"), "doc_id", "quality", *[f"_{k}" for k in names]).limit(fit_rows).toPandas())
    if rows.empty:
        return DecisionList()
    return learn({k: rows[f"_{k}"].to_numpy(float) for k in names}, rows["quality"].to_numpy() == 0, **options)
