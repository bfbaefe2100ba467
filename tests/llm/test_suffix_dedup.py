"""Repeated byte strings, against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from laurel.llm import induced_sort, queries, suffix_dedup
from laurel.llm.common import table

N = suffix_dedup.LENGTH


def brute_suffixes(t):
    b = t.tolist()
    return sorted(range(len(b)), key=lambda i: b[i:])


@pytest.mark.parametrize("seed", range(60))
def test_suffix_array(seed, monkeypatch, tmp_path):
    rng = np.random.default_rng(seed)
    symbols, n = int(rng.choice([1, 2, 3, 5, 40])), int(rng.integers(1, 150))
    t = rng.integers(1, symbols + 1, n)
    if seed % 4 == 0:
        t = np.tile(t[:max(1, n // 6)], 6)
    if seed % 2:
        monkeypatch.setattr(induced_sort, "STEP", 64)
        monkeypatch.setattr(induced_sort, "IN_MEMORY", 16)  # queues on disk
    t = np.append(t, 0)
    assert induced_sort.suffix_array(t, symbols + 1, str(tmp_path)).tolist() == brute_suffixes(t)
    assert not list(tmp_path.iterdir())


def brute(texts):
    data = [(t or "").encode() for t in texts]
    often = Counter(d[i:i + N] for d in data for i in range(len(d) - N + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - N + 1):
            if often[d[i:i + N]] > 1:
                gone[i:i + N] = True
        edges = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0)).reshape(-1, 2).tolist()
        out.append((len(d), int(gone.sum()), [tuple(e) for e in edges], bytes(np.frombuffer(d, np.uint8)[~gone])))
    return out


def words(rng, chars):
    out = ""
    while len(out) < chars:
        out += rng.choice("äbcdefghijklmnop") * rng.randint(1, 3) + rng.choice(("", " ", "x"))
    return out[:chars]


@pytest.fixture(scope="module")
def cases():
    rng = random.Random(4)
    passages = [words(rng, n) for n in (150, 190, 200, 201, 260, 420, 700)]
    texts = []
    for _ in range(70):
        t = words(rng, rng.randint(0, 300))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 3)
            t += p[a:len(p) - rng.randint(0, len(p) // 3)] + words(rng, rng.randint(0, 250))
        texts.append(t)
    # copies, one byte apart, periodic, inside one text, nothing
    texts += [texts[0], texts[0], texts[1][:-1] + "!", "ab" * 300, "ab" * 101, "a" * 199, "a" * 200, "a" * 400, "", None, "z" + "q" * 201]
    own = words(rng, 260)
    return texts + [own + "|" + own, own[:199] + "-" + own[:199]]


@pytest.mark.parametrize("hot,shard", [(10_000, 8 << 20), (2, 3_000)])
def test_removal_equals_brute_force(spark, cases, hot, shard):
    docs = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string").repartition(5)
    got = suffix_dedup.suffix_dedup(docs, hot_runs=hot, shard_bytes=shard).orderBy("doc_id").collect()
    assert len(got) == len(cases)
    for r, expect in zip(got, brute(cases)):
        b = r["bytes"]
        assert (b["n_bytes"], b["n_removed"], [(s["start"], s["end"]) for s in b["spans"]], bytes(b["kept"])) == expect, r["doc_id"]


def test_texts_longer_than_a_piece(monkeypatch):
    rng = random.Random(6)
    text = words(rng, 3_000).encode()
    whole = [r for _, _, r in suffix_dedup.scan([text.decode()], suffix_dedup.Scanner())]
    monkeypatch.setattr(suffix_dedup, "SCAN_BYTES", 500)
    starts = {}
    for data, where, (first, last, a, _, _) in suffix_dedup.scan([text.decode()], suffix_dedup.Scanner()):
        (_, offset, here, _), = where
        for i, j, x in zip(first, last, a):
            for s in range(i, j + 1):
                assert data[s:s + N] == text[offset + s:offset + s + N]
                assert offset + s not in starts
                starts[offset + s] = x
    (first, last, a, _, _), = whole
    assert starts == {s: x for i, j, x in zip(first, last, a) for s in range(i, j + 1)} and len(starts) == len(text) - N + 1


def test_odd_and_empty_tables(spark, odd):
    texts = [r["text"] for r in odd.collect()]
    got = suffix_dedup.suffix_dedup(odd, out="_b").select("text", "_b.*").collect()
    expect = Counter((t, n, gone, kept) for t, (n, gone, _, kept) in zip(texts, brute(texts)))
    assert Counter((r["text"], r["n_bytes"], r["n_removed"], bytes(r["kept"])) for r in got) == expect
    assert suffix_dedup.suffix_dedup(odd.limit(0)).isEmpty()


def test_query(spark, small):
    docs = {r["doc_id"]: r["text"] for r in table(spark, small, "documents").collect()}
    got = {r["doc_id"]: r for r in queries.op8_suffix_array_dedup(spark, small).collect()}
    assert len(got) == len(docs)
    for (i, _), (n, gone, edges, kept) in zip(docs.items(), brute(docs.values())):
        r = got[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (n, gone, len(edges), hashlib.sha256(kept).hexdigest())
