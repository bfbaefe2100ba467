"""Personal data, phrase collocations and tokenizer alignment, against brute force."""

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from laurel.llm import collocations, lookup, pii, queries, token_alignment
from laurel.llm import quotient_filter as qf
from laurel.llm.common import table

# personal data


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def brute_pii(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [(m.start(), "email", m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), "ip", m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), "card", m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 14 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [(m.start(), "phone", m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(digits(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[1]), s[2]))


def test_pattern_spans_of_random_texts():
    rng = random.Random(3)
    bits = ["a@", "b.c", "@", ".", "1", "22", "255.", "256", ".3", "+", " ", "-", "(4", "4465758382889437", "+1 (743) 555-3824", "x", "é", "\n", "0"]
    for _ in range(5_000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(1, 25)))
        assert pii.base_spans(text) == brute_pii(text), text


@pytest.mark.parametrize("unit", ["1", "a", "@", "a@", "a.", "1.", "+1", "+1)", "1 ", "1-"])
def test_long_texts_take_linear_time(unit):
    assert isinstance(pii.base_spans(unit * 300_000), list)


def test_messages_give_exact_marginals_on_trees():
    rng = np.random.default_rng(5)
    field = pii.Field(np.zeros((1, pii.LABELS)), rng.normal(size=(pii.LABELS, pii.LABELS)), 1.3)
    scores = rng.normal(size=(4, pii.LABELS))
    # 0 - 1 are neighbours; 1, 2 and 3 are alike
    left, member, group = np.array([0]), np.array([1, 2, 3]), np.array([0, 0, 0])
    exact = np.zeros_like(scores)
    for y in itertools.product(range(pii.LABELS), repeat=4):
        weight = np.exp(sum(scores[i, k] for i, k in enumerate(y)) + field.chain[y[0], y[1]])
        weight *= sum(np.exp(field.agree * sum(y[m] == h for m in member)) for h in range(pii.LABELS))
        for i, k in enumerate(y):
            exact[i, k] += weight
    exact /= exact.sum(1, keepdims=True)
    assert np.abs(field.marginals(scores, left, member, group, rounds=60) - exact).max() < 1e-6


def test_distant_alike_words_share_their_label():
    field = pii.Field(np.zeros((1, pii.LABELS)), np.zeros((pii.LABELS, pii.LABELS)), 2.0)
    scores = np.zeros((3, pii.LABELS))
    scores[0, 4] = 12.0
    scores[1, 0] = scores[2, 0] = 0.5
    p = field.marginals(scores, np.zeros(0, int), np.array([0, 1]), np.array([0, 0]))
    assert p[1].argmax() == 4 and p[2].argmax() == 0


LETTER = ["Write to jo.{i}@mail{i}.example.com soon", "call +1 ({a}) 555-{b} about it", "from {c}.{i}.9.77 at night", "paid by {card} once",
          "on page {i} of {b} lines", "version {i}.{i} and {b}"]


def letters(n):
    rng = random.Random(7)
    out = []
    for i in range(n):
        body = f"4{rng.randrange(10**14):014d}"
        card = next(body + str(k) for k in range(10) if luhn(body + str(k)))
        out.append(". ".join(s.format(i=i % 200, a=rng.randrange(200, 900), b=f"{rng.randrange(10**4):04d}", c=rng.randrange(1, 255), card=card)
                             for s in rng.sample(LETTER, 4)))
    return out


def test_the_field_adds_what_the_patterns_drop_and_nothing_else(spark):
    texts = letters(300)
    card = re.search(r"4\d{15}", " ".join(texts))[0]
    wrong = card[:-1] + str((int(card[-1]) + 5) % 10)
    odd = [f"call +1 (743) 555-3824 {card} now", f"paid by {card} {card} twice", f"paid by {wrong} once", "4 lines on page 5555 of 2024", None, "", "no mark"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts + odd)], "doc_id long, text string")
    field = pii.fit(docs.where("doc_id < 300"))
    got = {r["doc_id"]: r["s"] for r in docs.select("doc_id", pii.personal_data(F.col("text"), field, spark).alias("s")).collect()}
    for i, t in enumerate(texts + odd):
        assert [tuple(s) for s in got[i]["base"]] == brute_pii(t or "")
    assert not any(got[i]["added"] for i in range(300))
    assert [(s["kind"], odd[0][s["start"]:s["end"]]) for s in got[300]["added"]] == [("phone", "+1 (743) 555-3824"), ("card", card)]
    assert [odd[1][s["start"]:s["end"]] for s in got[301]["added"]] == [card, card]
    assert not any(got[i]["added"] for i in range(302, 307))


def test_without_rows_to_learn_from_only_patterns_count(spark, odd):
    field = pii.fit(odd.where("false"))
    assert field is None
    found = odd.select("text", pii.personal_data(F.col("text"), field, spark).alias("s")).collect()
    assert len(found) == 16 and all([tuple(s) for s in r["s"]["base"]] == brute_pii(r["text"] or "") and not r["s"]["added"] for r in found)


def test_pii_query(spark, small):
    texts = {r["doc_id"]: r["text"] for r in table(spark, small, "documents").collect()}
    rows = queries.op11_pii(spark, small).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = brute_pii(texts[r["doc_id"]] or "")
        name = lambda s: f"{s[1]}:{s[0]}:{s[2]}"
        assert r["base_sha256"] == hashlib.sha256(",".join(map(name, base)).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[1] == k for s in base) for k in pii.KINDS]
        assert set(map(name, base)) <= set(r["spans"].split(",")) | {""}
        assert len(list(filter(None, r["spans"].split(",")))) == len(base) + r["n_added"]


# collocations

def brute_phrases(rows, least, top=2_000, longest=5):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = lang or "und"
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for p in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", p)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, count in f.items():
        often = {g: a for g, a in count.items() if len(g) > 1 and a >= least}
        gone = {g[i:i + k] for g, a in often.items() for k in range(2, len(g)) for i in range(len(g) - k + 1) if a >= often[g[i:i + k]]}
        found = []
        for g, a in often.items():
            if g not in gone:
                score, _, left, right = min((1000 * a * n[lang] // (count[g[:k]] * count[g[k:]]), k, count[g[:k]], count[g[k:]]) for k in range(1, len(g)))
                found.append((-score, -a, " ".join(g).encode(), left, right))
        out += [(lang, i, p.decode(), -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize("n,bits", [(2, 1), (2, 17), (3, 21), (4, 16), (5, 13), (5, 26), (5, 40)])
def test_quotient_filters_keep_and_add_counts(n, bits):
    rng = np.random.default_rng(n * bits)
    parts = [rng.integers(0, min(1 << bits, 40), (n, m)).astype(np.uint64) * np.uint64(max(1, (1 << bits) // 40)) % np.uint64(1 << bits) for m in (500, 1, 900)]
    want = Counter(tuple(map(int, g)) for p in parts for g in p.T)
    ranges = defaultdict(list)
    for p in parts:
        for f in qf.filters_of(p, bits, 3):
            ranges[f.prefix].append(qf.QuotientFilter.load(f.dump()))
    got = Counter()
    for some in ranges.values():
        f = qf.QuotientFilter.load(qf.merged(some).dump())
        assert (np.diff(f.limbs.astype(object), axis=1)[0] >= 0).all()
        got.update(dict(zip((tuple(map(int, g)) for g in f.ngrams().T), f.counts.tolist())))
    assert got == want and len(ranges) <= 8


def test_counts_of_every_size_fit(spark):
    counts = np.array([1, 127, 128, 1 << 14, (1 << 50) + 3], np.int64)
    assert (qf._from_varints(np.frombuffer(qf._varints(counts), np.uint8)) == counts).all()


def test_collocations_of_small_texts(spark, odd, monkeypatch):
    rng = random.Random(2)
    words = ["New", "york", "the", "of", "a", "état", "x y", "日本", "b-c"]
    rows = [(" ".join(rng.choice(words) + rng.choice(["", "", "", ",", "\n", "\t", "."]) for _ in range(rng.randint(0, 60))), rng.choice(["en", "de", None]))
            for _ in range(150)]
    rows += [(r["text"], r["lang"]) for r in odd.collect()] + [("new york is big " * 40, "en")]
    docs = spark.createDataFrame(rows, "text string, lang string").withColumn("n", F.lit("clash")).repartition(3)
    for held, slice_ in ((250_000, 1 << 20), (5, 8)):
        monkeypatch.setattr(collocations, "HELD", held)
        monkeypatch.setattr(collocations, "SLICE", slice_)
        got = sorted(map(tuple, collocations.collocations(docs, least=6).collect()))
        assert got == brute_phrases(rows, 6) and len(got) > 50
    assert collocations.collocations(docs, least=10**6).count() == 0


def test_products_may_pass_64_bits(spark):
    big = 3 * 10**12
    grams = spark.createDataFrame([([1], big), ([2], big - 1), ([1, 2], big // 7)], "gram array<long>, n long")
    words = spark.createDataFrame([(1, "en", "a"), (2, "en", "b")], "id long, lang string, word string")
    totals = spark.createDataFrame([("en", 10**15)], "lang string, n long")
    row = collocations.scored(grams, words, totals, 100).first()
    assert row["score"] == 1000 * (big // 7) * 10**15 // (big * (big - 1)) and row["phrase"] == "a b"


def test_collocations_query(spark, small):
    rows = [(r["text"], r["lang"]) for r in table(spark, small, "documents").collect()]
    assert sorted(map(tuple, queries.op12_collocations(spark, small).collect())) == brute_phrases(rows, 100)


# lookup tables

def test_lookup_finds_keys_of_many_shards(spark):
    rng = np.random.default_rng(1)
    low = rng.integers(-(1 << 62), 1 << 62, 3_000)
    low[:600] = np.repeat(low[:200], 3)  # several keys share their low half
    high = np.arange(3_000)
    rows = spark.createDataFrame([(int(a), int(b), int(i), -int(i)) for i, (a, b) in enumerate(zip(low, high), 1)], "low long, high long, x long, y long")
    files = lookup.write_lookup(rows, ["x", "y"], "test-table", shard_keys=100)
    assert len(files) > 10
    table_ = lookup.Lookup(files, cache_bytes=4_000)
    got = table_.probe(np.concatenate([low, low + 1]), np.concatenate([high, high]), 2)
    assert (got[0] == np.concatenate([np.arange(1, 3_001), np.zeros(3_000)])).all() and (got[1] == -got[0]).all()
    assert table_.reads == len(files)  # once a block, however small the cache
    assert not lookup.Lookup([]).probe(low, high)[0].any()


# alignment

BITS = ["a", "b", " ", "  ", "\n", "\n\n ", "\t", "é", "ß", "日本", "\x1c", "\x85", "\xa0", "!", "123", "'s", "<|endoftext|>", "</s>", "<0x41>", "▁", "　", "word", "x" * 30,
        "\U0001f600", "\r\n"]


def brute_alignment(rows, a_path, b_path):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer
    a_lib, b_lib = Tokenizer.from_file(a_path), SentencePieceProcessor(model_file=b_path)
    a_lib.encode_special_tokens = True
    t = token_alignment.Tokenizers(a_path, b_path)
    out, count = [], Counter()
    for doc_id, text in rows:
        a = a_lib.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_lib.encode(text) if text else []
        whole = (" " + text).encode() if text else b""
        if b"".join(t.bytes_a[i] for i in a) != whole or b"".join(t.bytes_b[i] for i in b) != whole:
            a, b = [], []
        ends = [list(itertools.accumulate(len(x[i]) for i in ids)) for x, ids in ((t.bytes_a, a), (t.bytes_b, b))]
        groups, links, i, j = [], [], 0, 0
        for end in sorted(set(ends[0]) & set(ends[1])):
            p, q = i, j
            while i < len(a) and ends[0][i] <= end:
                i += 1
            while j < len(b) and ends[1][j] <= end:
                j += 1
            groups.append(",".join(map(str, a[p:i])) + "|" + ",".join(map(str, b[q:j])))
            for k in range(p, i):
                links += [(a[k], b[m]) for m in range(q, j)
                          if ends[0][k] > ends[1][m] - len(t.bytes_b[b[m]]) and ends[1][m] > ends[0][k] - len(t.bytes_a[a[k]])]
        count.update(links)
        out.append((doc_id, len(a), len(b), groups, links))
    best = defaultdict(int)
    for (_, y), n in count.items():
        best[y] = max(best[y], n)
    return [(i, a, b, len(g), len(x), sum(count[p] == best[p[1]] for p in x), sum(count[p] for p in x),
             hashlib.sha256(";".join(g).encode()).hexdigest() if a else "") for i, a, b, g, x in out]


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
PATHS = "byte_bpe_50k.json", "piece_bpe_32k.model"


def same_rows(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("long_chars,chunk_chars", [(1 << 16, 1 << 15), (30, 7), (150, 64)])
def test_alignment_of_whole_texts_and_of_chunks(spark, odd, long_chars, chunk_chars):
    rng = random.Random(1)
    rows = [(r["doc_id"], r["text"][:2_000] if r["text"] else r["text"]) for r in odd.collect()]
    rows += [(100 + i, "".join(rng.choice(BITS) for _ in range(rng.randint(0, 90)))) for i in range(200)]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, row string, no int").repartition(3)
    paths = [queries.tokenizer_file(p) for p in PATHS]
    same_rows(token_alignment.alignment(docs, *paths, long_chars=long_chars, chunk_chars=chunk_chars).collect(), brute_alignment(rows, *paths))


def test_fragments_compose_in_any_tree():
    rng = random.Random(4)
    shift = 10
    for _ in range(300):
        n = rng.randint(1, 40)
        cut = lambda: sorted({n, *rng.sample(range(1, n + 1), rng.randint(0, n - 1))})
        ends_a, ends_b = cut(), cut()
        tokens = lambda ends, at: [(i + at, y - x) for i, (x, y) in enumerate(zip([0, *ends], ends))]
        a, b = tokens(ends_a, 1), tokens(ends_b, 500)

        def fragment_of(i, j, k, m):
            start_a, start_b = ([0, *ends_a][i], [0, *ends_b][k])
            if i == j and k == m:
                return token_alignment.Fragment()
            o = token_alignment.Open([x for x, _ in a[i:j]], [s for _, s in a[i:j]], [x for x, _ in b[k:m]], [s for _, s in b[k:m]])
            return token_alignment.scan(o, start_b - start_a, shift)

        want = token_alignment.whole(fragment_of(0, len(a), 0, len(b)), shift)
        at_a, at_b = (sorted(rng.choices(range(len(x) + 1), k=4)) for x in (a, b))
        parts = [fragment_of(*x) for x in zip([0, *at_a], [*at_a, len(a)], [0, *at_b], [*at_b, len(b)])]
        p, q, r, s, t = parts
        then = lambda x, y: x.then(y, shift)
        trees = [then(then(then(then(p, q), r), s), t), then(p, then(q, then(r, then(s, t)))), then(then(p, q), then(r, then(s, t)))]
        for tree in trees:
            got = token_alignment.whole(tree, shift)
            assert (got.groups, got.links, got.n_groups, got.tail.a, got.tail.b) == (want.groups, want.links, want.n_groups, [], [])


def test_alignment_query(spark, small):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, small, "documents").collect()]
    same_rows(queries.op13_token_alignment(spark, small).collect(), brute_alignment(rows, *[queries.tokenizer_file(p) for p in PATHS]))


def test_no_documents(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert collocations.collocations(none).count() == 0
    assert token_alignment.alignment(none, *[queries.tokenizer_file(p) for p in PATHS]).count() == 0
    assert none.select(pii.personal_data(F.col("text"), pii.fit(none), spark)).count() == 0


class Frame:
    """Stands for a table: keeps the function that is given for its tasks."""

    def select(self, *_):
        return self

    def mapInArrow(self, run, _):
        self.run = run
        return self

    def groupBy(self, *_):
        return self

    def applyInPandas(self, *_):
        return self


def test_ngrams_of_all_lengths_share_one_bound(monkeypatch):
    monkeypatch.setattr(collocations, "GRAMS", 3_000)
    held, filters_of = [], qf.filters_of
    monkeypatch.setattr(qf, "filters_of", lambda ids, *more: held.append(ids.shape[1]) or filters_of(ids, *more))
    frame, rng = Frame(), np.random.default_rng(2)
    collocations.ngram_counts(frame, (3, 4, 5), 8, 3, 1)
    blocks = [rng.integers(1, 200, 300).astype("<u8") for _ in range(40)]
    rows = [r for b in frame.run(pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary())], names=["ids"]) for x in blocks) for r in b.to_pylist()]
    assert sum(held) == 40 * (298 + 297 + 296) and max(held) <= 3_000
    assert sum(qf.QuotientFilter.load(r["filter"]).counts.sum() for r in rows) == sum(held)


def test_remembered_words_of_all_languages_share_one_bound(spark, monkeypatch):
    most = []

    class Table:
        def probe(self, low, high):
            most.append(len(low))
            return (np.abs(low) % 3,)
    monkeypatch.setattr(collocations, "lookup", lambda _: Table())
    rng = random.Random(4)
    rows = [(f"l{i % 5}", " ".join(f"w{rng.randrange(400)}" for _ in range(60))) for i in range(400)]
    part = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], names=["lang", "text"])

    def ids():
        frame = Frame()
        collocations.encoded(frame, [])
        return b"".join(x.as_py() for b in frame.run(iter([part])) for x in b.column(0))
    whole, once = ids(), sum(most)
    monkeypatch.setattr(collocations, "MEMO", 500)
    most.clear()
    assert ids() == whole and sum(most) > 1.2 * once


def test_staged_word_numbers_lie_in_short_rows(spark, monkeypatch):
    class Table:
        def probe(self, low, high):
            return (np.abs(low) % 7,)
    monkeypatch.setattr(collocations, "lookup", lambda _: Table())
    monkeypatch.setattr(collocations, "CELL", 64)
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(300)}" + rng.choice(["", "", "", "."]) for _ in range(3_000)), "", "w1 w2 " * 100, None]
    frame = Frame()
    collocations.encoded(frame, [])
    part = pa.RecordBatch.from_arrays([pa.array(["en"] * 4), pa.array(texts)], names=["lang", "text"])
    cells = [np.frombuffer(x.as_py(), "<u8") for b in frame.run(iter([part])) for x in b.column(0)]
    assert len(cells) > 20 and all(len(c) and c[-1] == 0 for c in cells)
    # cut at the first 0 from so many words on, which lies far behind in the text of 200 words only
    assert sorted(map(len, cells))[-2] < 2 * 64 and max(map(len, cells)) < 64 + 202


@pytest.mark.parametrize("slice_", [7, 100, 1 << 20])
def test_ngrams_of_long_rows_are_counted_in_slices(monkeypatch, slice_):
    monkeypatch.setattr(collocations, "GRAMS", 400)
    monkeypatch.setattr(collocations, "SLICE", slice_)
    held, filters_of = [], qf.filters_of
    monkeypatch.setattr(qf, "filters_of", lambda ids, *more: held.append(ids.shape[1]) or filters_of(ids, *more))
    rng = np.random.default_rng(6)
    cells = [rng.integers(0, 9, m).astype("<u8") for m in (2_000, 1, 3, 700)]
    cells = [np.where(rng.random(len(c)) < 0.05, 0, c) for c in cells]
    # without pairs of an odd and a higher number
    pairs = {(a, b) for a in range(1, 9) for b in range(1, 9) if not (a % 2 and b > a)}

    class Table:
        def probe(self, low, high):
            known = {tuple(int(x[0]) for x in collocations.pair_keys(np.array([a], np.uint64), np.array([b], np.uint64))) for a, b in pairs}
            return (np.array([(a, b) in known for a, b in zip(low.tolist(), high.tolist())], np.int64),)
    monkeypatch.setattr(collocations, "lookup", lambda _: Table())
    for bits in (4, 33):
        frame, want, got = Frame(), Counter(), Counter()
        collocations.ngram_counts(frame, (3, 5), bits, 3, 1, [])
        for c in cells:
            for n in (3, 5):
                grams = (tuple(map(int, c[i:i + n])) for i in range(len(c) - n + 1))
                want.update(g for g in grams if all(x in pairs for x in zip(g, g[1:])))
        part = pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in cells], pa.binary())], names=["ids"])
        for f in (qf.QuotientFilter.load(r["filter"]) for b in frame.run(iter([part])) for r in b.to_pylist()):
            got.update(dict(zip((tuple(map(int, g)) for g in f.ngrams().T), f.counts.tolist())))
        assert got == want and len(got) > 100
    assert max(held) <= 400


def test_ranges_are_merged_without_sorting_all_at_once(monkeypatch):
    monkeypatch.setattr(qf, "RUN", 500)
    most, counted = [], qf.counted
    monkeypatch.setattr(qf, "counted", lambda limbs, *more: most.append(limbs.shape[1]) or counted(limbs, *more))
    rng = np.random.default_rng(7)
    for n, bits in ((2, 9), (3, 24), (5, 30)):
        want, filters, one = Counter(), [], None
        for _ in range(60):
            p = rng.integers(0, 400, (n, 100)).astype(np.uint64)
            p[:, :20] = 1
            p[1:, 20:40] = 2
            for f in qf.filters_of(p, bits, 0):
                f.counts[0] += 1 << 32
                filters.append(f)
                want.update(dict(zip((tuple(map(int, g)) for g in f.ngrams().T), f.counts.tolist())))
        most.clear()
        got = list(qf.merged_parts(iter(filters)))
        assert max(most) < 1_000 and len(got) > 4
        numbers = [x for f in got for x in (f.limbs[0].astype(object) if len(f.limbs) == 1 else f.limbs.T.tolist())]
        assert all(a < b for a, b in zip(numbers, numbers[1:]))
        found = [(tuple(map(int, g)), c) for f in got for g, c in zip(f.ngrams().T, f.counts.tolist())]
        assert dict(found) == want and len(found) == len(want)
    assert not list(qf.merged_parts(iter([])))
