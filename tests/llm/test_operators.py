"""Each operator against a brute-force version on a small table with nulls,
empty and long texts, ties, repeated rows and extra columns."""

from __future__ import annotations

import collections
import hashlib
import math
import os
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from meterline.llm import (ann, bitsliced, langid, linededup, mixing, packing, pitman_yor, queries, simhash, substring,
                           url_filter)
from meterline.session import scratch_path

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, "
        "n int, word string, key int, leaf int, size int, ctx int, fp int, spans int, kept_text string, n_lines string, rare int")
SMALL = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sample_texts():
    rng = np.random.default_rng(3)
    vocab = [f"w{i}" for i in range(60)] + ["the", "of", "é", "ß", "Über"]
    prose = lambda n: " ".join(rng.choice(vocab, n))
    passage, notice = prose(45), "Served by node 17 on port 8080 in zone a b c d"
    texts = [None, "", " \t\n ", "one", "one two", prose(300), prose(80) + " " + passage + " " + prose(30), passage,
             prose(25) + "\n" + passage + "\n" + prose(10), "a " * 70, "b a " * 60, "x\u2028y z\u00a0q " * 30, prose(20000)]
    texts += [f"{prose(15)}\n{notice.replace('17', str(k)).replace('8080', str(9000 + k))}\n{prose(12)}" for k in range(5)]
    base = prose(200)
    texts += [base, base, base + " tail", base.upper(), base.replace("w1 ", "w2 ")]
    return texts


@pytest.fixture(scope="module")
def docs(spark):
    texts = sample_texts()
    rows = [(i, t, [None, "en", "de"][i % 3], [None, "s1", "s2", "s3"][i % 4], None) + (None,) * 11 for i, t in enumerate(texts)]
    rows.append(rows[6])  # a repeated row
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def plain(docs):
    return sorted((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect() if r["text"] is not None) + \
        [(r["doc_id"], None) for r in docs.collect() if r["text"] is None]


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def brute_print(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints, radius):
    ids = sorted(prints)
    label = {i: i for i in ids}
    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return {i: root(i) for i in ids}


def test_simhash(docs, plain):
    got = simhash.simhash_components(docs).collect()
    prints = {i: brute_print(t) for i, t in plain}
    assert len(got) == docs.count()
    assert {r["doc_id"]: r["fingerprint"] for r in got} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {r["doc_id"]: r["component_id"] for r in got} == brute_components(prints, 2)


def test_spark_hash_is_xxh64(spark):
    assert spark.sql("select xxhash64('a b c')").first()[0] & (2**64 - 1) == xxhash.xxh64_intdigest(b"a b c", 42)


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_covering_finds_every_near_pair(spark, radius):
    rng = np.random.default_rng(radius)
    centres = rng.integers(0, 2**63, 40).astype(object)
    prints = {}
    for i in range(400):
        p = int(centres[i % 40])
        for b in rng.integers(0, 64, rng.integers(0, 6)):
            p ^= 1 << int(b)
        prints[i] = p
    first = {}
    for i, p in prints.items():
        first.setdefault(p, i)
    rows = spark.createDataFrame([(i, p - (1 << 64) if p >> 63 else p) for p, i in first.items()], "id long, fp long")
    links = [(r["a"], r["b"]) for r in simhash.near_links(rows, radius).collect()]
    by_id = {i: p for p, i in first.items()}
    assert all((by_id[a] ^ by_id[b]).bit_count() <= radius for a, b in links)
    got = {i: i for i in first.values()}
    from meterline.llm.components import connected_components
    found = connected_components(spark.createDataFrame(links or [(0, 0)], "a long, b long"))
    got.update({r["id"]: r["component"] for r in found.collect()})
    assert got == brute_components({i: p for p, i in first.items()}, radius)


def test_components_of_a_chain_and_a_star(spark):
    from meterline.llm.components import connected_components
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + k) for k in range(1, 80)] + [(7, 7)]
    got = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + k: 100 for k in range(80)}}


def brute_substring(plain, window=20):
    seen, out = set(), {}
    for i, t in sorted(dict(plain).items()):
        w = words(t)
        gone = set()
        for s in range(len(w) - window + 1):
            g = tuple(w[s:s + window])
            if g in seen:
                gone.update(range(s, s + window))
            seen.add(g)
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def test_substring(docs, plain):
    rows = substring.remove_repeats(docs).collect()
    assert len(rows) == docs.count()
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], hashlib.sha256(r["kept_text"].encode()).hexdigest()) for r in rows}
    assert got == brute_substring(plain)
    assert sum(x[1] for x in got.values()) > 300


@pytest.mark.parametrize("seed", range(4))
def test_anchors_are_the_same_wherever_a_window_stands(seed):
    """Equal windows in other surroundings get the same anchor and name."""
    rng = np.random.default_rng(seed)
    word = lambda: [str(x).encode() for x in rng.integers(0, [2, 5, 50, 5000][seed], 40)]
    inside = [(w * 3)[:int(rng.integers(20, 60))] for w in (word() for _ in range(30))]
    seen = collections.defaultdict(set)
    for _ in range(5):
        docs = [word() + x + word() for x in inside]
        found = substring.blocks([b" ".join(d) for d in docs], 20)
        for key, d, s, n in zip(found["key"], found["doc"], found["start"], found["n"]):
            for k in range(s, s + n):
                seen[tuple(docs[d][k:k + 20])].add(int(key))
    assert all(len(keys) == 1 for keys in seen.values())


def test_word_names():
    texts = [b"", b" \t", b"a", b"x" * 300 + b" y\x0b" + b"z" * 257, b"\x08q \xc3\xa9\x85 " + b"k" * 9, b"x" * 256,
             b"x" * 255 + b" x  a\n", b"k" * 8 + b" " + b"k" * 16, b"a\x00 a", b"x" * 300]
    names, at = substring.named(texts)
    words = [t.split() for t in texts]
    assert np.diff(at).tolist() == [len(w) for w in words]
    by_word = collections.defaultdict(set)
    for w, name in zip((x for w in words for x in w), names.tolist()):
        by_word[w].add(name)
    assert all(len(x) == 1 for x in by_word.values()) and len(set.union(*by_word.values())) == len(by_word)


def test_packing(docs, plain):
    from tokenizers import Tokenizer
    model = Tokenizer.from_file(packing.tokenizer_path())
    rows = packing.pack(docs).collect()
    ids = {i: model.encode(t or "", add_special_tokens=False).ids + [0] for i, t in plain}
    by_doc = collections.defaultdict(set)
    for r in rows:
        part = np.array(ids[r["doc_id"]][r["start"]:r["start"] + r["length"]], "<u4")
        assert r["start"] == 2048 * r["piece"] and zlib.crc32(part.tobytes()) == r["ids_crc32"]
        by_doc[r["doc_id"]].add((r["piece"], r["length"]))
    for i, own in ids.items():
        assert sum(n for _, n in by_doc[i]) == len(own)
        assert all(n == 2048 for p, n in by_doc[i] if p < len(by_doc[i]) - 1)
    check_places(rows)


def check_places(rows, slack=1.02):
    places = collections.defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(places) <= math.ceil(sum(r["length"] for r in rows) / 2048) * slack + 1


def test_special_tokens_and_case_are_encoded_as_in_the_whole_text():
    from tokenizers import Tokenizer
    model = Tokenizer.from_file(packing.tokenizer_path())
    texts = ["A<|endoftext|>b <|ENDOFTEXT|> It's I'LL 12 ab\u0301c \u212b \x85x\u00a0y", "ÀÉ ǅ İstanbul\x1cq", "the. The, THE"]
    got = packing.WordTokenizer(packing.tokenizer_path()).ids([t.encode() for t in texts])
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [model.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("seed", range(3))
def test_plan_places_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    counts = collections.Counter(int(x) for x in np.minimum(2048, rng.lognormal(5 + seed, 1, 3000).astype(int) + 1))
    plan = packing.plan_rounds(counts)
    ranks, fill = collections.defaultdict(list), collections.defaultdict(list)
    for length, first, many, sequence, offset in plan:
        ranks[length] += range(first, first + many)
        for k in range(many):
            fill[sequence + k].append((offset, length))
    assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in counts.items()}
    for own in fill.values():
        assert [o for o, _ in sorted(own)] == np.cumsum([0, *(n for _, n in sorted(own))])[:-1].tolist()
    assert max(o + n for own in fill.values() for o, n in own) <= 2048
    assert len(fill) <= max(math.ceil(sum(n * c for n, c in counts.items()) / 2048) * 1.02 + 1,
                            sum(c for n, c in counts.items() if n > 1024) * 1.001)


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(700, 24)).astype(np.float32)
    rows = [(i, [float(y) for y in v], 1, "x", 2) for i, v in enumerate(x)]
    rows[10] = (10, None, 1, "x", 2)
    rows[11] = (11, [0.0] * 24, 1, "x", 2)
    rows[12] = (12, [float("nan")] + [1.0] * 23, 1, "x", 2)
    rows[13] = (13, [None] + [1.0] * 23, 1, "x", 2)
    rows[14] = (14, rows[15][1], 1, "x", 2)  # a tie
    rows[16] = (16, [1.0, 2.0], 1, "x", 2)   # another length
    rows[17] = (17, [float("inf")] * 24, 1, "x", 2)
    rows.append(rows[20])
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, v int, t string, part int")


def test_nearest(vectors):
    good = {r["vec_id"]: np.array(r["embedding"], float) for r in vectors.collect()
            if r["embedding"] and None not in r["embedding"] and np.isfinite(r["embedding"]).all() and any(r["embedding"])}
    rows = ann.nearest(vectors, F.col("vec_id") % 20 == 0).collect()
    got = collections.defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    hits = total = 0
    for q in (i for i in good if i % 20 == 0):
        away = sorted((math.sqrt(((good[q] - x) ** 2).sum()), i) for i, x in good.items() if i != q and len(x) == len(good[q]))
        true = [i for _, i in away[:10]]
        dist = {i: d for d, i in away}
        assert all(abs(s - dist[i]) < 1e-12 for i, s in got[q]) and len(got[q]) == 10
        assert [i for i, _ in got[q]] == [i for _, i in sorted((s, i) for i, s in got[q])]
        hits, total = hits + len({*true} & {i for i, _ in got[q]}), total + 10
    assert hits >= 0.9 * total


def test_top_k(vectors):
    good = {r["vec_id"]: [math.floor(256 * x) for x in r["embedding"]] for r in vectors.collect()
            if r["embedding"] and None not in r["embedding"] and np.isfinite(r["embedding"]).all()}
    rows = bitsliced.top_k(vectors, F.col("vec_id") % 16 == 0).collect()
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in rows}
    want = {}
    for q in (i for i in good if i % 16 == 0):
        scores = sorted((-sum(a * b for a, b in zip(good[q], x)), i) for i, x in good.items() if i != q and len(x) == len(good[q]))
        want.update({(q, k + 1): (i, -s) for k, (s, i) in enumerate(scores[:5])})
    assert got == want and len(rows) == len(want)


def test_top_k_of_large_components(spark):
    values = [[3.0e5, -1.0], [2.0 ** 22, 2.0 ** 22], [-5.0, 2.0 ** 20], [1.0, 2.0], [2.0 ** 53, 0.0], [2.0 ** 54, 1.0], [1e300, 1.0]]
    rows = bitsliced.top_k(spark.createDataFrame(list(enumerate(values)), "vec_id long, embedding array<double>"), F.lit(True)).collect()
    good = [[math.floor(256 * x) for x in v] for v in values[:5]]
    held = lambda x: min(max(x, -2 ** 63), 2 ** 63 - 1)
    for q in range(5):
        scores = sorted((-held(sum(a * b for a, b in zip(good[q], x))), i) for i, x in enumerate(good) if i != q)
        assert [(r["vec_id"], r["score"]) for r in rows if r["query_id"] == q] == [(i, -s) for s, i in scores]
    assert len(rows) == 20


def test_language_model(docs, plain):
    out = pitman_yor.held_out(F.col("doc_id"))
    got = pitman_yor.score(docs, out).collect()
    texts = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    token = lambda t: [*(t or "").encode().lower().split(), b" "]
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    counts = collections.Counter(w for i, t in texts if not held(i) for w in token(t))
    n, v = sum(counts.values()), len(counts)
    text_of = dict(texts)
    assert len(got) == len(texts)
    for r in got:
        w = token(text_of[r["doc_id"]])
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (
            len(w), sum(x in counts for x in w), n, held(r["doc_id"]))
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w))
        assert r["score"] < 0
    # Words looked up by the join score as those in the matrix: the seating alone differs between runs.
    joined = {r["doc_id"]: r["score"] for r in pitman_yor.score(docs, out, head=5).collect()}
    assert all(joined[r["doc_id"]] == pytest.approx(r["score"], rel=0.02, abs=0.3) for r in got)


def test_language_model_beats_the_base_on_held_out_text(spark):
    rows = queries.op5_lm_score(spark, SMALL).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert rows[0] > rows[1]


def test_language_model_stages_little(spark):
    """All tables a run leaves staged, those of five sweeps among them, against the bytes of its text."""
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{k}" for k in rng.zipf(1.2, 2000) % 50_000) for _ in range(200)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    scratch = os.path.dirname(scratch_path(spark, "x")).removeprefix("file:")
    before = set(os.listdir(scratch))
    assert pitman_yor.score(rows, F.col("doc_id") % 7 == 2).count() == 200
    new = [os.path.join(d, f) for x in set(os.listdir(scratch)) - before for d, _, fs in os.walk(os.path.join(scratch, x)) for f in fs]
    assert 0 < sum(map(os.path.getsize, new)) < 1.6 * sum(map(len, texts))


def test_pairs_are_counted_once_each_packed(spark):
    """Pair counts against a plain count, with every word short, some and none; repeated rows count again."""
    texts = ["a b a b c", "a B", None, "", "x y z a b", "a b a b c"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr(
        "doc_id", "cast(text as binary) text")
    want = collections.Counter()
    for t in texts:
        words = [b" ", *(t or "").lower().encode().split(), b" "]
        want.update(zip(words, words[1:]))
    name = {b" ": 0, **{w.encode(): int(pitman_yor.tokens([w.encode()])[0][0]) for w in "abcxyz"}}
    for head in (7, 2, 0):
        own = np.array(sorted(name.values())[:head], np.uint64)
        lookup = pitman_yor.Lookup(own)
        shown = {int(lookup.ids(np.array([k], np.uint64))[0]): w for w, k in name.items()}
        assert len(shown) == 7 and sum(0 <= k < head for k in shown) == head
        got = collections.Counter()
        known = spark.sparkContext.broadcast(lookup)
        for r in pitman_yor.pair_table(rows, known, 3).collect():
            u, w, *more = pitman_yor.unpack([r["blob"]], {pitman_yor.ONCE: 2, pitman_yor.STATE: 5, pitman_yor.TAIL: 3}[r["kind"]])
            for k in range(len(u)):
                got[shown[int(u[k])], shown[int(w[k])]] += int(more[0][k]) if more else 1
        assert got == want


def test_packed_columns_and_lookups_come_back():
    rng = np.random.default_rng(5)
    columns = [rng.integers(-2**63, 2**63 - 1, 1000), np.arange(1000), np.zeros(1000, np.int64)]
    got = pitman_yor.unpack([pitman_yor.pack(*columns), pitman_yor.pack(*columns)], 3)
    assert all((np.concatenate((x, x)) == y).all() for x, y in zip(columns, got))
    keys = np.unique(rng.integers(0, 2**63, 5000).astype(np.uint64))
    asked = np.concatenate((keys[::3], keys[:50] + np.uint64(1)))
    want = {int(k): i for i, k in enumerate(keys)}
    assert pitman_yor.Lookup(keys).find(asked).tolist() == [want.get(int(k), -1) for k in asked]


def test_every_preceding_word_is_a_context(spark):
    """100 words, each always followed by its own partner: all of these pairs are learnt."""
    texts = [" ".join(f"first{k} second{k}" for k in np.random.default_rng(i).permutation(100)) for i in range(40)]
    asked = [" ".join(f"first{k} second{k}" for k in range(100)), " ".join(f"first{k} second{(k + 1) % 100}" for k in range(100))]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts + asked)], "doc_id long, text string")
    for head in (200_000, 3):
        got = {r["doc_id"]: r["score"] for r in pitman_yor.score(rows, F.col("doc_id") >= 40, head=head).collect()}
        assert got[40] > got[41] + 100 and got[40] > -250  # half of the tokens are certain


def test_predictive_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    c = rng.integers(0, 30, (50, 3))
    t = np.zeros_like(c)
    for u in range(3):
        own = c[:, u] > 0
        t[own, u] = pitman_yor.seat(c[own, u], np.full(own.sum(), 0.7), 0.6, rng)
    assert ((t >= (c > 0)) & (t <= c)).all()
    at_root = t.sum(1)
    t0 = np.where(at_root > 0, pitman_yor.seat(np.maximum(at_root, 1), np.full(50, 0.5), 0.7, rng), 0)
    v = int((at_root > 0).sum())
    r = pitman_yor.Restaurants(0.6, 0.7, 1.0, v, c.sum(0).astype(float), t.sum(0).astype(float), int(t0.sum()))
    root = r.root(at_root[at_root > 0], t0[at_root > 0])
    new = r.root(np.array([0]), np.array([0]))[0]
    assert root.sum() + new == pytest.approx(1)
    for u in range(3):
        own = (c[:, u] - 0.6 * t[:, u])[at_root > 0] + r.new_table()[u] * root
        assert (own.sum() + r.new_table()[u] * new) / (r.theta + c[:, u].sum()) == pytest.approx(1)


def test_seating_agrees_with_one_by_one():
    rng = np.random.default_rng(2)
    def slow():
        t = 1
        for i in range(1, 40):
            t += rng.random() < 2.0 / (i - 0.5 * t + 2.0)
        return t
    fast = pitman_yor.seat(np.full(4000, 40), np.full(4000, 2.0), 0.5, rng)
    assert np.mean([slow() for _ in range(4000)]) == pytest.approx(fast.mean(), rel=0.03)


@pytest.mark.parametrize("c, a, d", [(2, 1.0, 0.5), (9, 3.0, 0.7), (100, 1.0, 0.5), (100, 1.0, 0.8), (100, 5.0, 0.9), (40, 60.0, 0.3),
                                     (400, 90.0, 0.95), (3000, 5.0, 0.6), (3000, 200.0, 0.8)])
def test_table_counts_have_their_exact_law(c, a, d):
    """Weights a^t * S(c, t) by the recursion S(n+1, t) = S(n, t-1) + (n - d t) S(n, t)."""
    log_s, t = np.full(c + 1, -np.inf), np.arange(c + 1)
    log_s[1] = 0
    with np.errstate(divide="ignore"):
        for n in range(1, c):
            log_s[1:] = np.logaddexp(log_s[:-1], log_s[1:] + np.log(np.maximum(n - d * t[1:], 0)))
    w = log_s + t * math.log(a)
    p = np.exp(w - w.max())
    p /= p.sum()
    got = pitman_yor.draw_tables(np.full(20_000, c), np.full(20_000, a), d, np.random.default_rng(4))
    mean, sd = (p * t).sum(), math.sqrt((p * t * t).sum() - (p * t).sum() ** 2)
    assert got.mean() == pytest.approx(mean, abs=5 * sd / math.sqrt(20_000) + (0.01 * mean if c > pitman_yor.EXACT else 0))
    assert np.abs(np.cumsum(np.bincount(got, minlength=c + 1)) / 20_000 - np.cumsum(p)).max() < (0.02 if c <= pitman_yor.EXACT else 0.04)


URLS = ["http://www.example.com/en/1", "https://EXAMPLE.com/en/x?y#z", "http://a.b.example.com/en/", "http://example.com/de/en/",
        "http://example.com", "http://x.net/es/1/2/3", "http://net/fr/", "http://x.net/fr", "http://x.net/frx/", None, "", "nonsense",
        "http://", "http://example.org/en/", "ftp://u@notcom/x", "http://com/", "a://b://c/d", "http://x.com?/en/", "http://x.com#q"]


def test_url_filter(spark):
    rows = [(i, u, None, "k") for i, u in enumerate(URLS)] + [(0, URLS[0], None, "k")]
    pages = spark.createDataFrame(rows, "page_id long, url string, keys string, host string")
    got = url_filter.filter_urls(pages, queries.URL_RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        u = URLS[r["page_id"]]
        host, path = "", ""
        if u and "://" in u:
            rest = u.split("://", 1)[1]
            host = re.split(r"[/?#]", rest)[0]
            path = re.split(r"[?#]", rest[len(host):])[0]
            host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        fits = [(len(h + p), h + p, k) for k, h, p in queries.URL_RULES
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, None, "allow"))
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, best[1], best[2])
    with pytest.raises(ValueError):
        url_filter.filter_urls(pages, [("block", "a.b", "/x")])
    assert {r["verdict"] for r in url_filter.filter_urls(pages, []).collect()} == {"allow"}


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(20000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = universe.filter("hash(key) % 7 = 0").unionByName(spark.sql("select 'outside' key"))
    cascade = url_filter.Cascade(listed, universe, bits_per_key=4, hashes=2)
    assert len(cascade.levels) > 3
    wrong = universe.withColumn("in", cascade.holds(F.col("key"))).filter("in <> (hash(key) % 7 = 0)")
    assert wrong.count() == 0


def test_cascade_of_few_keys_over_a_large_universe(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "MAX_LISTED", 100)
    universe = spark.range(300_000).select(F.concat(F.lit("k"), "id").alias("key"))
    cascade = url_filter.Cascade(universe.filter("key in ('k1', 'k77', 'k4096')"), universe)
    held = universe.filter(cascade.holds(F.col("key"))).collect()
    assert {r["key"] for r in held} == {"k1", "k77", "k4096"}


def test_mixing(docs):
    rows = mixing.mix(docs).collect()
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    texts = [(r["doc_id"], r["source"], r["text"]) for r in docs.collect()]
    sizes = collections.Counter()
    for _, s, t in texts:
        sizes[s] += len(words(t))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, free, rest = {}, set(order), sum(sizes.values())
    while True:
        target.update({s: rest * weight[s] / sum(weight[x] for x in free) for s in free})
        over = {s for s in free if target[s] > 3 * sizes[s]}
        if not over:
            break
        target.update({s: 3 * sizes[s] for s in over})
        rest -= sum(3 * sizes[s] for s in over)
        free -= over
    source = {i: s for i, s, _ in texts}
    size = {i: len(words(t)) for i, _, t in texts}
    taken = collections.Counter()
    assert len(rows) == len(texts)
    for r in rows:
        s = source[r["doc_id"]]
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == sizes[s] and r["target"] == pytest.approx(target[s])
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3
        taken[s] += r["taken"]
    for s in order:  # as near as whole documents of these few can come
        assert abs(taken[s] - target[s]) <= max(size[i] for i, x in source.items() if x == s)


def test_mixing_comes_near_its_targets_over_rounds(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.expr("repeat('a ', 1 + cast(pow(hash(id) % 30, 2) as int))").alias("text"),
                                    F.expr("if(id % 3 = 0, 'x', concat('y', id % 5))").alias("source"))
    rows = mixing.mix(docs, block=64).join(docs.select("doc_id", "source"), "doc_id")
    off = rows.groupBy("source").agg((F.sum("taken") / F.first("target")).alias("r")).collect()
    assert all(abs(r["r"] - 1) < 0.005 for r in off)


def brute_lines(plain, depth=3, similarity=0.8, min_docs=3):
    lines = []
    for i, t in dict(plain).items():
        for k, line in enumerate([] if t is None else t.split("\n")):
            w = ["<*>" if re.search("[0-9]", x) else x for x in words(line)]
            if w:
                lines.append((i, k, w, (len(w), tuple(w[:depth]))))
    leaf_docs, rows = collections.defaultdict(set), collections.defaultdict(list)
    for i, _, w, leaf in lines:
        leaf_docs[leaf].add(i)
        rows[leaf].append(w)
    templates = {}
    for leaf, own in rows.items():
        votes = [min(collections.Counter(c).items(), key=lambda x: (-x[1], x[0])) for c in zip(*own)]
        templates[leaf] = [tok if 2 * n >= len(own) else None for tok, n in votes]
    groups, group_docs = {}, collections.defaultdict(set)
    for i, k, w, leaf in lines:
        if len(leaf_docs[leaf]) >= min_docs:
            fit = sum(a == b for a, b in zip(w, templates[leaf])) / len(w) >= similarity
            groups[i, k] = (leaf,) if fit else (leaf, tuple(w))
            group_docs[groups[i, k]].add(i)
    return {(i, k) for (i, k), g in groups.items() if len(group_docs[g]) >= min_docs and i > min(group_docs[g])}


def test_line_dedup(docs, plain):
    gone = brute_lines(plain)
    assert len(gone) >= 4
    rows = linededup.drop_recurring_lines(docs).collect()
    assert len(rows) == docs.count()
    text = dict(plain)
    for r in rows:
        lines = [] if text[r["doc_id"]] is None else text[r["doc_id"]].split("\n")
        kept = [x for k, x in enumerate(lines) if (r["doc_id"], k) not in gone]
        assert (r["n_lines"], r["n_dropped"]) == (len(lines), len(lines) - len(kept))
        assert r["kept_text"] == (None if text[r["doc_id"]] is None else "\n".join(kept))


def test_language_id(spark, docs):
    rows = queries.op10_language_id(spark, SMALL).join(spark.read.parquet(f"{SMALL}/documents.parquet"), "doc_id")
    held = rows.filter("held_out")
    assert held.filter("lang = lang_pred").count() >= 0.97 * held.count()
    profiles = langid.learn_profiles(spark.read.parquet(f"{SMALL}/documents.parquet"))
    got = langid.identify(docs, profiles).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    no_letter = {r["doc_id"] for r in docs.collect() if not any(c.isalpha() for c in r["text"] or "")}
    assert {r["doc_id"] for r in got if r["lang_pred"] == "und"} == no_letter


def test_rank_order_distance():
    p = langid.Profiles({"x": [ord("a"), ord("b")], "y": [ord("b"), ord("c")]}, 3)
    assert langid.ranked(b"b b a", 2).tolist() == [ord("b"), langid.PAD << 21 | ord("b")]
    lang, score = p.predict(b"a")
    own = langid.ranked(b"a", 3)
    out = {k: sum(abs(v.index(c) - i) if c in v else 3 for i, c in enumerate(own)) for k, v in (("x", [97, 98]), ("y", [98, 99]))}
    assert lang == min(out, key=lambda k: (out[k], k)) and score == pytest.approx(1 - min(out.values()) / (3 * len(own)))


@pytest.mark.parametrize("apply", [
    lambda d: simhash.simhash_components(d), lambda d: substring.remove_repeats(d), lambda d: packing.pack(d),
    lambda d: pitman_yor.score(d, F.lit(False)), lambda d: mixing.mix(d), lambda d: linededup.drop_recurring_lines(d),
    lambda d: langid.identify(d, langid.learn_profiles(d)),
    lambda d: url_filter.filter_urls(d.select(F.col("doc_id").alias("page_id"), F.col("text").alias("url")), queries.URL_RULES),
    lambda d: ann.nearest(d.selectExpr("doc_id vec_id", "array(1.0d) embedding"), F.lit(True)),
    lambda d: bitsliced.top_k(d.selectExpr("doc_id vec_id", "array(1.0d) embedding"), F.lit(True)),
])
def test_empty_tables_give_no_rows(empty, apply):
    assert apply(empty).collect() == []
