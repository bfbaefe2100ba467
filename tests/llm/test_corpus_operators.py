"""Operators over whole tables, against brute force, other libraries and exact round trips."""

import gc
import hashlib
import random
import tracemalloc
import weakref
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from laurel.llm import components, decontaminate, line_dedup, order_minhash, queries, sentencepiece_codec, token_output
from laurel.llm.common import shared_folder, table

PIECES = queries.tokenizer_file("piece_bpe_32k.model")
WORDS = queries.tokenizer_file("word_bpe_49k.json")
SPACES = " \t\n\v\f\r"


# SentencePiece

@pytest.fixture(scope="module")
def reference():
    """The library's own Viterbi over the same pieces and scores."""
    from sentencepiece import SentencePieceProcessor
    from sentencepiece import sentencepiece_model_pb2 as model
    proto = model.ModelProto()
    with open(PIECES, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = model.TrainerSpec.UNIGRAM
    return SentencePieceProcessor(model_proto=proto.SerializeToString())


TEXTS = ["", " ", "Hello world", "  two  blanks\n\n and a\ttab ", "größer ß Ж日本語 \U0001f600 é", "a▁b", "x" * 300, "=" * 100 + "-" * 50, "The representation of responsibility, springframework!"]


def test_encoding_equals_the_library(spark, small, reference):
    codec = sentencepiece_codec.Codec(PIECES)
    texts = TEXTS + [r["text"][:3000] for r in table(spark, small, "documents").limit(60).collect()]
    for t in texts:
        # single precision sums of the library may settle ties of long texts otherwise; its words are compared one by one
        for part in [t] if len(t) < 400 else t.split():
            mine, theirs = codec.encode(part).tolist(), reference.encode(part)
            if mine != theirs:
                total = lambda ids: sum(reference.get_score(i) for i in ids)
                assert total(mine) >= total(theirs), part
        assert codec.decode(codec.encode(t)) == t.replace("▁", " ")


def toy(pieces, prefix=False):
    v = object.__new__(sentencepiece_codec.Vocabulary)
    v.pieces = {p: (i, s) for i, (p, s) in enumerate(pieces.items())}
    v.bytes, v.unknown, v.prefix, v.library = {}, len(pieces), prefix, None
    v.longest = max(map(len, pieces))
    v.unknown_score = min(pieces.values()) - 10
    v.prefixes = {p[:k] for p in pieces for k in range(1, len(p))}
    return v


def best_score(text, v):
    best = [0.0] + [None] * len(text)
    for i in range(len(text)):
        ends = {i + 1: v.unknown_score} | {i + len(p): s for p, (_, s) in v.pieces.items() if text.startswith(p, i)}
        for j, s in ends.items():
            if best[j] is None or best[i] + s > best[j]:
                best[j] = best[i] + s
    return best[-1]


@pytest.mark.parametrize("seed", range(15))
def test_streaming_equals_full_viterbi(seed):
    rng = random.Random(seed)
    pieces = {"".join(rng.choice("ab") for _ in range(rng.randint(1, 6))): -float(rng.randint(1, 40)) for _ in range(12)}
    v = toy(pieces)
    text = "".join(rng.choice("ab" * 20 + "c") for _ in range(400))
    stretches = list(sentencepiece_codec.viterbi(text, v))
    ids = [i for s in stretches for i in s]
    names = list(pieces)
    score = sum(v.unknown_score if i == v.unknown else pieces[names[i]] for i in ids)
    assert abs(score - best_score(text, v)) < 1e-6
    assert sum(len(names[i]) if i < len(names) else 1 for i in ids) == len(text)


def test_paths_that_meet_late_are_still_committed():
    # every boundary is crossed by some piece, yet the paths have one ancestor
    v = toy({"ab": -1.0, "ba": -9.0, "a": -9.0, "b": -9.0})
    stretches = list(sentencepiece_codec.viterbi("ab" * 1_000, v))
    assert len(stretches) > 20 and sum(map(len, stretches)) == 1_000
    # where they never meet, nothing may be committed before the end
    v = toy({"aa": -1.0, "aaa": -9.0, "a": -5.0})
    assert [len(s) for s in sentencepiece_codec.viterbi("a" * 2_001, v)] == [1_001]


def test_sentencepiece_query(spark, small):
    docs = {r["doc_id"]: r["text"] for r in table(spark, small, "documents").collect()}
    codec = sentencepiece_codec.Codec(PIECES)
    got = queries.op3_sentencepiece(spark, small).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = codec.encode(docs[r["doc_id"]])
        assert (r["n_tokens"], r["ids_crc32"]) == (len(ids), zlib.crc32(ids.tobytes()))
        assert r["round_trip"] and r["decoded_sha256"] == hashlib.sha256(docs[r["doc_id"]].encode()).hexdigest()


def test_sentencepiece_of_odd_table(spark, odd):
    coded = odd.withColumn("ids", sentencepiece_codec.encode(F.col("text"), PIECES)).withColumn("back", sentencepiece_codec.decode(F.col("ids"), PIECES))
    for r in coded.collect():
        assert r["back"] == (r["text"] or "").replace("▁", " ")
    assert coded.limit(0).isEmpty()


# line dedup

def brute_lines(rows):
    holders = defaultdict(set)
    for n, (i, text) in enumerate(rows):
        for line in (text or "").split("\n"):
            key = line.strip(SPACES)
            if len(key) >= 20:
                holders["".join(c.lower() if "A" <= c <= "Z" else c for c in key)].add(n)
    rank = lambda i: float("-inf") if i is None else i
    out = []
    for i, text in rows:
        lines, kept = (text or "").split("\n"), []
        for line in lines:
            key = "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACES))
            h = holders.get(key, ())
            if not (len(h) >= 3 and rank(i) != max(rank(rows[n][0]) for n in h)):
                kept.append(line)
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


order = lambda rows: sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


@pytest.mark.parametrize("shard_keys,cache", [(1 << 18, 1 << 27), (3, 200)])
def test_line_dedup(spark, odd, small, shard_keys, cache, monkeypatch):
    docs = odd.select("doc_id", "text").union(table(spark, small, "documents").select("doc_id", "text"))
    files = line_dedup.build_index(line_dedup.repeated_lines(docs), shard_keys)
    assert shard_keys > 3 or len(files) > 5
    monkeypatch.setattr(line_dedup, "CACHE_BYTES", cache)
    got = line_dedup.drop_lines(docs, files).select("doc_id", "lines.*").collect()
    rows = [tuple(r) for r in docs.collect()]
    assert order(map(tuple, got)) == order(brute_lines(rows))


def test_index_cache_drops_the_least_recently_used(tmp_path):
    rng = np.random.default_rng(0)
    low, high = rng.integers(0, 1 << 63, (2, 5_000), dtype=np.uint64) * np.uint64(2)
    number = ((low >> np.uint64(20)) & np.uint64((1 << 44) - 1)) % np.uint64(7)
    files = []
    for s in range(7):
        at = number == s
        shard = line_dedup.Shard.build(low[at], high[at], np.arange(5_000)[at] + 3, np.arange(5_000)[at])
        (tmp_path / f"{s}").write_bytes(b"".join(shard.dump()))
        files.append([f"file://{tmp_path}/{s}"])
    index = line_dedup.Index(files, cache_bytes=30_000)
    count, largest = index.probe(low, high)
    assert (count == np.arange(5_000) + 3).all() and (largest == np.arange(5_000)).all() and len(index.cache) < 7
    assert (index.probe(low, high ^ np.uint64(1))[0] == 0).all()
    strange = rng.integers(0, 1 << 63, 5_000, dtype=np.uint64)
    assert (index.probe(strange, strange)[0] == 0).all()


def test_perfect_hash_is_minimal():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 62, 20_000, dtype=np.uint64))
    h = line_dedup.PerfectHash.build(keys)
    assert sorted(h.places(keys)) == list(range(len(keys)))
    assert len(h.bits) * 64 < 5 * len(keys)
    assert (line_dedup.PerfectHash.build(keys[:0]).places(keys) == -1).all()


def test_line_dedup_keeps_other_columns(spark, odd):
    got = line_dedup.line_dedup(odd, out="_lines")
    assert got.count() == odd.count() and set(odd.columns) < set(got.columns)
    assert line_dedup.line_dedup(odd.limit(0)).isEmpty()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_with_sql(spark, small, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    df = queries.QUERIES[name](spark, small)
    expect = con.execute(queries.ORACLES[name]).df()[df.columns]
    assert order(df.toPandas().itertuples(index=False, name=None)) == order(expect.itertuples(index=False, name=None))


# Order MinHash

def words(rng, n):
    return [rng.choice("abcdefghijklmnopqrstuvwxyz") + rng.choice("aeiou") + str(rng.randint(0, 40)) for _ in range(n)]


def brute_similarity(a, b):
    """Longest common subsequence of 5-word windows, by the plain table."""
    x, y = decontaminate.words_of(a), decontaminate.words_of(b)
    if not x or not y:
        return float((a or "") == (b or ""))
    if min(len(x), len(y)) < 5:
        return float(x == y)
    x, y = ([tuple(w[i:i + 5]) for i in range(len(w) - 4)] for w in (x, y))
    row = [0] * (len(y) + 1)
    for u in x:
        last = row
        row = [0]
        for j, v in enumerate(y, 1):
            row.append(last[j - 1] + 1 if u == v else max(last[j], row[-1]))
    return row[-1] / (len(x) + len(y) - row[-1])


def edited(rng, w, edits):
    w = list(w)
    for _ in range(edits):
        i = rng.randrange(len(w))
        w[i:i + rng.randint(0, 1)] = words(rng, rng.randint(0, 2))
    return w


@pytest.mark.parametrize("seed", range(20))
def test_similarity_equals_brute_force(seed):
    rng = random.Random(seed)
    a = words(rng, rng.randint(1, 120))
    if seed % 3 == 0:
        a = a * 2  # repeated windows
    b = edited(rng, a, rng.randint(0, 4)) or ["q"]
    if seed % 4 == 0:
        b = b + words(rng, len(a) // 5)  # a longer end
    full = brute_similarity(" ".join(a), " ".join(b))
    got = order_minhash.similarity(" ".join(a), " ".join(b))
    assert got == (pytest.approx(full) if full >= 0.8 else 0.0)


def test_long_pair_edited_at_both_ends_takes_linear_memory():
    n = 20_000
    x = [*range(n)]
    y = [-1, *range(1, n - 1), -2]
    tracemalloc.start()
    try:
        assert order_minhash.banded(x, y, n // 5) == n - 2
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 10e6


@pytest.mark.parametrize("masks", [0, 4, 10_000])
def test_alignment_by_places_and_by_bits_is_the_same(monkeypatch, masks):
    rng = random.Random(masks)
    monkeypatch.setattr(order_minhash, "MASKS", masks)
    for _ in range(60):
        x = [rng.randrange(rng.choice((2, 9, 90))) for _ in range(rng.randint(0, 40))]
        y = [rng.randrange(9) for _ in range(rng.randint(0, 40))]
        band = rng.randint(0, 12)
        row = [0] * (len(y) + 1)
        for i, u in enumerate(x):
            last, row = row, [0]
            for j, v in enumerate(y):
                row.append(last[j] + 1 if u == v and abs(i - j) <= band else max(last[j + 1], row[-1]))
        assert order_minhash.banded(x, y, band) == row[-1]


def brute_classes(rows):
    texts = sorted({t or "" for _, t in rows})
    root = {t: t for t in texts}
    def find(t):
        while root[t] != t:
            t = root[t]
        return t
    for i, a in enumerate(texts):
        for b in texts[:i]:
            if find(a) != find(b) and brute_similarity(a, b) >= 0.8:
                root[find(a)] = find(b)
    ids = defaultdict(list)
    for i, t in rows:
        ids[find(t or "")].append(i)
    least = {k: min((i for i in v if i is not None), default=None) for k, v in ids.items()}
    return [(i, least[find(t or "")]) for i, t in rows]


@pytest.fixture(scope="module")
def family_rows():
    rng = random.Random(5)
    rows, shared = [], words(rng, 60)
    for f in range(6):
        origin = words(rng, rng.choice((4, 60, 150, 300)))
        for _ in range(rng.choice((1, 3, 8))):
            rows.append(edited(rng, origin, rng.choice((0, 1, 1, 2))) or ["z"])
    rows += [shared + words(rng, 30) for _ in range(10)]  # a passage in common is not a near copy
    text = [" ".join(w) for w in rows] + ["", None, "", "!!!", "one two three", "One, two three.", "one two four"]
    ids = list(range(len(text)))
    rng.shuffle(ids)
    return [*zip(ids, text), (None, text[0]), (ids[0], text[0]), (ids[0], text[3])]


def test_classes_equal_brute_force(spark, family_rows):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in family_rows], "doc_id long, text string, class_id string, low int").repartition(3)
    got = order_minhash.classes(docs).collect()
    assert order((r["doc_id"], r["class_id"]) for r in got) == order(brute_classes(family_rows))
    kept = order_minhash.one_of_each(docs).collect()
    groups = brute_classes(family_rows)
    # the class of known ids has its smallest id; each class gives one row
    assert sorted(r["doc_id"] for r in kept) == sorted(set(c for _, c in groups)) and kept[0].asDict().keys() == docs.first().asDict().keys()


def test_outsiders_meet_the_rest_of_their_bucket(spark):
    """A bucket whose picked members are alike to nobody still gives all links."""
    rng = random.Random(2)
    a, b = words(rng, 80), words(rng, 80)
    texts = [" ".join(x) for x in (words(rng, 80), a, [*a[:40], "new", *a[41:]], b, [*b[:9], *b[10:]], words(rng, 80))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    node = docs.select(*order_minhash.node_of(F.col("text")), F.size(F.split("text", " ")).cast("long").alias("n"))
    ids = node.orderBy("low").collect()
    members = node.crossJoin(spark.createDataFrame([(1, ids[0]["low"], ids[0]["high"])], "bucket long, low_p long, high_p long"))
    none = spark.createDataFrame([], "node string, root string")
    tried = spark.createDataFrame([], "low_a long, high_a long, low_b long, high_b long")
    nodes = docs.select(*order_minhash.node_of(F.col("text")), "text")
    pairs = order_minhash.outsiders(members, none, tried, nodes)
    assert 2 <= pairs.count() < 6
    assert order_minhash.verified(pairs, nodes).count() == 2


class Handed:
    """Stands for a table and gives the function that its rows would be handed to."""

    def select(self, *columns):
        return self

    def mapInPandas(self, run, schema):
        return run


def test_a_worker_keeps_the_tables_of_one_step_only(spark):
    sign = order_minhash.signatures(Handed(), "text")
    codec = weakref.ref(sentencepiece_codec.codec_of(PIECES))
    assert sentencepiece_codec.codec_of(PIECES) is codec()
    assert len(list(sign(iter([pd.DataFrame({"low": [1], "high": [1], "_text": ["one two three four five six"]})])))) == 1
    gc.collect()
    assert codec() is None


def test_signing_remembers_few_words_and_texts(spark):
    sign = order_minhash.signatures(Handed(), "text")
    rows = 3_000
    parts = (pd.DataFrame({"low": range(i, i + 100), "high": range(i, i + 100), "_text": [" ".join(f"w{k * 100 + j}" for j in range(100)) for k in range(i, i + 100)]})
             for i in range(0, rows, 100))
    tracemalloc.start()
    try:
        found = sum(len(set(zip(p["low"], p["high"]))) for p in sign(parts))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found == rows
    assert peak < 15 << 20


def test_windows_of_many_texts_are_hashed_at_once(monkeypatch):
    rng, rounds, mixed = random.Random(15), [], order_minhash.mix64
    monkeypatch.setattr(order_minhash, "mix64", lambda x, seed: rounds.append(len(x)) or mixed(x, seed))
    texts = [words(rng, rng.choice((1, 4, 5, 30, 90))) * rng.choice((1, 1, 2)) for _ in range(200)] + [[], ["a"] * 9]
    found = [(w, h.tolist()) for w, h in order_minhash.hashed(iter(texts))]
    assert [w for w, _ in found] == texts
    # one round for each word of a window and one more; a further one for each text that has windows again
    assert len(rounds) <= 2 * (order_minhash.WINDOW + 1) + sum(len({*zip(*(w[i:] for i in range(5)))}) < len(w) - 4 for w in texts)
    for w, h in found:
        alone = order_minhash.window_hashes([w])[0].tolist()
        assert h == alone and len(set(h)) == len(h) == (max(1, len(w) - 4) if w else 0)
        first = w[:max(5, len(w) // 2)]
        assert not w or order_minhash.window_hashes([first])[0].tolist() == h[:max(1, len(first) - 4)]


def test_buckets_hold_the_least_windows_of_each_order(monkeypatch):
    odd = order_minhash.multipliers()
    h = np.random.default_rng(3).integers(0, 1 << 64, 400, dtype=np.uint64)

    def least(some):
        return [sorted(range(len(some)), key=lambda i: int(some[i]) * int(a) % (1 << 64))[:6] for a in odd]

    def buckets(some, kept):
        out = order_minhash.mix64(np.arange(len(odd), dtype=np.uint64), 11)
        for at, i in enumerate(np.sort(kept, axis=1).T):
            out = order_minhash.mix64(out, at) + some[i]
        return order_minhash.mix64(out, 6).tolist()

    for some in (h, h[:12]):
        assert order_minhash.buckets_of(some, odd).tolist() == buckets(some, least(some))
    with monkeypatch.context() as m:
        m.setattr(order_minhash, "SLICE", 100)
        assert order_minhash.buckets_of(h, odd).tolist() == buckets(h, least(h))
    # two windows of one hash, of which the first order takes either
    kept = least(h)
    last = kept[0][5]
    twin = next(i for i in range(len(h)) if i != last and all(i not in k for k in kept))
    h[twin] = h[last]
    got = order_minhash.buckets_of(h, odd).tolist()
    assert len(got) == len(odd)
    assert got[0] in (buckets(h, kept)[0], buckets(h, [[*k[:5], twin] for k in kept])[0])


def test_outsiders_that_share_several_buckets_meet_once(spark):
    text = " ".join(words(random.Random(4), 60))
    texts = spark.createDataFrame([(i, i, text) for i in range(4)], "low long, high long, text string")
    # bucket 2 has another picked one: there 3 is inside, and all others are outsiders
    members = spark.createDataFrame([(b, i, i, 60, p, p) for b, p in ((1, 0), (2, 3), (3, 0)) for i in range(4)],
                                    "bucket long, low long, high long, n long, low_p long, high_p long")
    none = spark.createDataFrame([], "node string, root string")
    met = order_minhash.meetings(order_minhash.outside(members, none, texts)).collect()
    assert sorted({tuple(sorted((r["low_a"], r["low_b"]))) for r in met}) == [(i, j) for i in range(4) for j in range(i + 1, 4)]
    assert len(met) == 6


def test_components_look_at_each_link_once(spark, monkeypatch):
    rng, looked = random.Random(8), []
    origin = words(rng, 120)
    texts = [" ".join([*origin[:i], "new", *origin[i + 1:]]) for i in range(0, 120, 2)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = components.components
    monkeypatch.setattr(order_minhash, "components", lambda new: looked.append(new.count()) or found(new))
    got = order_minhash.classes(docs).collect()
    assert {r["class_id"] for r in got} == {0}
    assert 2 * sum(looked) <= sum(r["n_joining_links"] for r in got)


def test_window_maps_let_every_similar_pair_through(spark):
    rng = random.Random(9)
    pairs = []
    for _ in range(200):
        a = words(rng, rng.choice((3, 5, 9, 60, 400))) * rng.choice((1, 1, 2))
        pairs.append((" ".join(a), " ".join(edited(rng, a, rng.choice((0, 1, 2, 9))) or ["z"])))
    df = spark.createDataFrame(pairs, "a string, b string").select(
        "a", "b", *[order_minhash.window_map(F.col(c)).alias(f"m{c}") for c in "ab"], *[F.size(F.split(c, " ")).alias(f"n{c}") for c in "ab"])
    rows = df.select("a", "b", order_minhash.may_be_alike("na", "ma", "nb", "mb").alias("may")).collect()
    for r in rows:
        assert r["may"] or order_minhash.similarity(r["a"], r["b"]) == 0.0
    assert any(not r["may"] for r in rows)


def test_bound_by_window_maps_is_code_that_the_jvm_compiles(spark):
    """Methods above 8000 bytes are interpreted, at many times the cost for each pair."""
    df = spark.createDataFrame([], "na int, ma array<long>, nb int, mb array<long>").where(order_minhash.may_be_alike("na", "ma", "nb", "mb"))
    code = df._jdf.queryExecution().debug().codegenToSeq()
    sizes = [code.apply(i)._3().maxMethodCodeSize() for i in range(code.length())]
    assert not sizes or 0 < max(sizes) <= 8_000


def test_near_duplicates_of_odd_and_empty_tables(spark, odd):
    got = order_minhash.classes(odd).collect()
    assert len(got) == odd.count()
    assert order((r["doc_id"], r["class_id"]) for r in got) == order(brute_classes([(r["doc_id"], r["text"]) for r in odd.collect()]))
    assert order_minhash.classes(odd.limit(0)).isEmpty()


def test_recall_of_buckets(spark):
    rng = random.Random(8)
    rows = []
    for f in range(150):
        a = words(rng, 120)
        rows += [(2 * f, " ".join(a)), (2 * f + 1, " ".join(edited(rng, a, 2)))]
    alike = [f for f in range(150) if brute_similarity(rows[2 * f][1], rows[2 * f + 1][1]) >= 0.8]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in order_minhash.classes(docs).collect()}
    found = [f for f in alike if got[2 * f + 1] == 2 * f]
    assert len(alike) > 100 and len(found) >= 0.98 * len(alike)


def short_pairs():
    """Texts of 5 to 14 words with one word more, less or changed at an end."""
    rng = random.Random(12)
    for n in range(5, 15):
        for _ in range(40):
            w = words(rng, n)
            new = words(rng, 1)
            for other in (w + new, new + w, w[1:], w[:-1], w[:-1] + new, new + w[1:], w[1:] + new):
                yield " ".join(w), " ".join(other)


def test_short_texts_one_end_word_apart_meet():
    odd, seen = order_minhash.multipliers(), Counter()
    signs = lambda t: dict(zip(*(x.tolist() for x in order_minhash.signs_of(decontaminate.words_of(t), {}, odd))))
    for a, b in short_pairs():
        alike = brute_similarity(a, b) >= 0.8
        x, y = signs(a), signs(b)
        # a part meets whole texts only
        assert not alike or any(not (x[k] and y[k]) for k in x.keys() & y.keys()), (a, b)
        seen[alike] += 1
    assert seen[True] > 500 and seen[False] > 500


@pytest.mark.parametrize("letters", ["a", "ab", "abc"])
def test_short_texts_with_loops_meet_as_brute_force_says(letters):
    """Texts of few different words, where windows inside can be left out: those of at most SHORT windows meet if and only if they are alike."""
    rng, odd = random.Random(len(letters)), order_minhash.multipliers()
    longest = order_minhash.SHORT + 4
    texts = {" ".join(rng.choice(letters) * rng.randint(1, 6) for _ in range(rng.randint(1, 5))).replace(" ", "") for _ in range(400)}
    texts |= {(letters * 9)[:n] for n in range(1, longest + 1)}
    texts |= {t[:i] + t[i + g:] for t in [*texts] for g in (1, 2) for i in range(0, len(t), 3)} - {""}
    texts = sorted(" ".join(t) for t in texts if len(t) <= longest)[::len(letters)]
    buckets = [dict(zip(*(x.tolist() for x in order_minhash.signs_of(t.split(), {}, odd)))) for t in texts]
    tables = [max(1, len(t.split()) - 4) >= 12 for t in texts]
    alike = 0
    for i, a in enumerate(texts):
        for j in range(i):
            x, y = buckets[i], buckets[j]
            meet = any(not (x[k] and y[k]) for k in x.keys() & y.keys())
            if order_minhash.similarity(a, texts[j]) > 0:
                alike += 1
                assert meet, (a, texts[j])
            else:
                assert not meet or tables[i] and tables[j], (a, texts[j])
    assert alike > 5


def test_classes_of_short_texts_equal_brute_force(spark):
    """Also many texts that share all but an end word: they are alike through the text that they share only."""
    rng = random.Random(13)
    rows = [t for pair in [*short_pairs()][::37] for t in pair]
    for n in (8, 9, 12, 13, 16):
        shared = words(rng, n)
        rows += [" ".join(shared + words(rng, 1)) for _ in range(12)] + ([" ".join(shared)] if n != 9 else [])
    rows = [*enumerate(rows)]
    got = order_minhash.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert order((r["doc_id"], r["class_id"]) for r in got) == order(brute_classes(rows))


def test_links_are_named_as_those_that_join_the_class(spark):
    """Of a class of near copies only links that join it are looked at; no column says that these are all."""
    rng = random.Random(14)
    origin = words(rng, 60)
    rows = [(i, " ".join([*origin[:-1], f"end{i}"])) for i in range(12)]
    got = order_minhash.classes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert "n_links" not in got.columns
    assert {r["class_id"] for r in got.collect()} == {0} and {r["n_joining_links"] > 0 for r in got.collect()} == {True}


def test_near_dedup_query(spark, small):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, small, "documents").collect()]
    short = [r for r in rows if len(r[1]) < 6_000]
    docs = spark.createDataFrame(short, "doc_id long, text string")
    got = order_minhash.classes(docs).collect()
    assert order((r["doc_id"], r["class_id"]) for r in got) == order(brute_classes(short))
    assert queries.op6_order_minhash(spark, small).count() == len(rows)


def test_components_of_long_paths(spark):
    links = [(f"{i:05d}", f"{i + 1:05d}") for i in range(300) if i % 100 != 99] + [("zz", "a0")]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(links, "a string, b string")).collect()}
    assert all(got[f"{i:05d}"] == f"{i // 100 * 100:05d}" for i in range(300)) and got["zz"] == "a0"
    assert components.components(spark.createDataFrame([], "a string, b string")).isEmpty()


# token ids

@pytest.mark.parametrize("seed", range(6))
def test_elias_fano(seed):
    rng = np.random.default_rng(seed)
    n = [0, 1, 5, 1_000, 3_000, 700][seed]
    values = np.sort(rng.integers(0, [1, 1 << 40, 3, 1 << 50, 100, 1 << 20][seed], n, dtype=np.uint64))
    ef = token_output.EliasFano.build(values)
    import io
    back = token_output.EliasFano.load(io.BytesIO(ef.dump()))
    assert (back.select(np.arange(n)) == values).all()
    if n > 100:
        assert len(ef.dump()) * 8 < n * (2.2 + max(0, np.log2(float(values[-1]) / n))) + 600


def brute_tokens(rows):
    from tokenizers import Tokenizer
    t, start, out = Tokenizer.from_file(WORDS), 0, []
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] is not None, r[1])):
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("partitions", [1, 5])
def test_token_files(spark, odd, small, partitions):
    special = spark.createDataFrame([(500, "a<|endoftext|>b <|startoftext|> it's\t　x́ don't 12 é", "en")], "doc_id long, text string, lang string")
    docs = (odd.select("doc_id", "text").union(special.select("doc_id", "text"))
            .union(table(spark, small, "documents").select("doc_id", "text"))).repartition(4)
    manifest = token_output.write_shards(docs, WORDS, shared_folder(spark, "t"), 49_408, partitions=partitions)
    got = sorted((tuple(r) for r in token_output.read_shards(manifest, rows=7).collect()), key=lambda r: r[1])
    assert got == brute_tokens([tuple(r) for r in docs.collect()])


def test_token_files_of_an_empty_table(spark, odd):
    manifest = token_output.write_shards(odd.limit(0), WORDS, shared_folder(spark, "t"), 49_408)
    assert token_output.read_shards(manifest).isEmpty()


def test_token_query(spark, small):
    got = sorted((tuple(r) for r in queries.op7_token_output(spark, small).collect()), key=lambda r: r[1])
    assert got == brute_tokens([tuple(r) for r in table(spark, small, "documents").select("doc_id", "text").collect()])


# pipeline

def test_pipeline_stages(spark, small):
    docs = table(spark, small, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = [(r["doc_id"], r["text"]) for r in docs.collect()]
        out = stage(spark, docs, small)
        if name != "sentencepiece":
            assert out.columns == table(spark, small, "documents").columns and out.dtypes == docs.dtypes
        after = {r["doc_id"]: r for r in out.collect()}
        if name == "language_id":
            assert set(after) == {i for i, t in before if any(map(str.isalpha, t or ""))}
        elif name == "line_dedup":
            expect = {i: t for i, _, n, t in brute_lines(before) if not (n and not t.strip())}
            assert {i: r["text"] for i, r in after.items()} == expect
            assert all(r["n_chars"] == len(r["text"]) for r in after.values())
        elif name == "near_dedup":
            short = [r for r in before if len(r[1]) < 3_000]
            stay = {i for i, c in brute_classes(short) if i == c}
            assert all((i in after) == (i in stay) for i, _ in short)
        elif name == "decontamination":
            items = [tuple(r) for r in table(spark, small, "benchmark").select(F.col("item_id").cast("string"), "text").collect()]
            tables = decontaminate.searchers(decontaminate.windows_of(items))
            for i, t in before:
                n, spans, _ = decontaminate.search(t, tables)
                hit = sum(s["end"] - s["start"] for s in spans)
                assert (i in after) == (not (hit and 20 * hit >= n))
        else:
            codec = sentencepiece_codec.Codec(PIECES)
            assert set(after) == {i for i, _ in before} and all(r["round_trip"] for r in after.values())
            assert all(list(after[i]["ids"]) == codec.encode(t).tolist() for i, t in before)
        docs = spark.createDataFrame(list(after.values()), out.schema)
    assert len(after) < len(rows)


def test_pipeline_of_odd_and_empty_tables(spark, odd, small):
    for docs in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, small)
            rows = docs.collect()
            docs = spark.createDataFrame(rows, docs.schema)
        assert (len(rows) > 3) == (len(rows) > 0)


def test_run_is_the_stages(spark, small):
    assert corpus_pipeline.run(spark, small).where("round_trip").count() > 100


def test_one_of_each_keeps_columns_of_any_name(spark):
    rows = [(1, "a b c d e f g", 7, 8, "x"), (2, "a b c d e f g", 9, 9, "y"), (3, None, None, 1, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _n int, _low long, _omh_i string")
    assert sorted(map(tuple, order_minhash.one_of_each(docs).collect())) == [rows[0], rows[2]]
