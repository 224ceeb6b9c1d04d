"""Texts that share an id, repeated rows, and rows without an id: each text is
judged on its own, and none is lost or multiplied."""

from __future__ import annotations

import collections
import time
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from meterline.llm import linededup, packing, substring
from meterline.llm.common import BATCH_ROWS, FREE_SHUFFLES, SLICE_ROWS, staged

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA).repartition(3)


def line(k, n=12):
    return " ".join(f"{chr(97 + (k + j) % 26)}{chr(97 + k % 23)}x{chr(97 + j)}" for j in range(n))


def test_line_dedup_by_text(spark):
    notice = line(1)
    rows = [(1, f"{line(2)}\n{notice}"), (2, f"{notice}\n{line(3)}"), (3, notice), (3, f"{line(4)}\n{line(5)}"), (3, f"{line(4)}\n{line(5)}"),
            (None, f"{line(6)}\n{notice}"), (None, line(7)), (None, None), (4, None), (2, f"{notice}\n{line(3)}")]
    got = linededup.drop_recurring_lines(frame(spark, rows))
    want = [(1, rows[0][1], 0), (2, line(3), 1), (3, "", 1), (3, rows[3][1], 0), (3, rows[3][1], 0), (None, line(6), 1), (None, line(7), 0),
            (None, None, 0), (4, None, 0), (2, line(3), 1)]
    assert sorted(((r["doc_id"], r["kept_text"], r["n_dropped"]) for r in got.collect()), key=repr) == sorted(want, key=repr)


def test_many_dropped_lines(spark):
    """A text of 200,000 lines, half of them dropped, is not lines x lines."""
    common = "\n".join(f"the common line number {chr(97 + k % 26)}{chr(97 + k // 26 % 26)} ends" for k in range(600))
    long = "\n".join(x for k in range(330) for x in (common.split("\n")[k % 600], f"own word{chr(97 + k % 26)} of {chr(97 + k // 26)} here")) + "\n"
    rows = [(k, common) for k in range(3)] + [(9, long * 300)]
    got = {r["doc_id"]: r for r in linededup.drop_recurring_lines(frame(spark, rows)).collect()}
    assert got[9]["n_lines"] == 330 * 2 * 300 + 1 and got[9]["n_dropped"] == 330 * 300
    assert got[1]["n_dropped"] == 600 and got[0]["n_dropped"] == 0


def brute_substring(rows, window=20):
    """Distinct (id, text) in order, null ids last."""
    texts = sorted({(i is None, i or 0, t or "") for i, t in rows}, key=lambda x: (x[0], x[1]))
    seen, out = {}, {}
    for last, i, t in texts:
        w, gone = t.split(), set()
        for s in range(len(w) - window + 1):
            key = tuple(w[s:s + window])
            if key in seen:
                gone |= set(range(s, s + window))
            seen.setdefault(key, (last, i, s))
        out[None if last else i, t] = " ".join(x for k, x in enumerate(w) if k not in gone)
    return out


def test_substring_by_text(spark):
    a, z, q = (" ".join(f"{c}{k}" for k in range(40)) for c in "azq")
    tail = " ".join(f"t{k}" for k in range(5))
    rows = [(1, a[:-4]), (2, f"{a} {tail}"), (2, z), (2, z), (3, q), (None, f"{q} end"), (None, z), (None, None), (5, None), (6, "one two")]
    got = [(r["doc_id"], r["n_words"], r["kept_text"]) for r in substring.remove_repeats(frame(spark, rows)).collect()]
    brute = brute_substring(rows)
    want = [(i, len((t or "").split()), brute[i, t or ""]) for i, t in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert (2, 40, z) in got and (None, 41, "end") in got


@pytest.mark.parametrize("ids", ["shared", "null", "own"])
def test_mixing_takes_what_it_planned(spark, ids):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    texts = [" ".join(f"w{k}x{j}" for j in range(3 + k % 9)) for k in range(80)]
    key = {"shared": lambda k: k // 2, "null": lambda k: None, "own": lambda k: k}[ids]
    rows = [(key(k), t, "en", f"s{k % 3}", len(t)) for k, t in enumerate(texts)] + [(key(5), texts[5], "en", "s2", len(texts[5]))] * 2
    docs = staged(spark.createDataFrame(rows, SCHEMA).repartition(4), "test-rows")
    stage = dict(corpus_pipeline.STAGES)["source_mixing"]
    taken = collections.Counter(tuple(r) for r in stage(spark, docs, "").collect())
    have = collections.Counter(rows)
    assert set(taken) <= set(have) and all(n <= 3 * have[r] for r, n in taken.items())
    size = lambda c: sum(n * len(r[1].split()) for r, n in c.items())
    assert abs(size(taken) / size(have) - 1) < 0.05
    again = spark.createDataFrame(rows[::-1], SCHEMA).coalesce(1)  # a rerun of another layout draws the same
    assert collections.Counter(tuple(r) for r in stage(spark, again, "").collect()) == taken


def test_language_id_keeps_rows_without_an_id(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs = docs.withColumn("doc_id", F.when(F.col("doc_id") % 3 > 0, F.col("doc_id") % 40))
    stage = dict(corpus_pipeline.STAGES)["language_id"]
    assert collections.Counter(map(tuple, stage(spark, docs, "").collect())) == collections.Counter(map(tuple, docs.collect()))


def test_packing_keeps_rows_without_an_id(spark):
    rows = [(None, line(k % 7, 300)) for k in range(40)] + [(None, None)] * 20 + [(k % 5, line(k, 3)) for k in range(30)]
    got = packing.pack(frame(spark, rows), capacity=256).collect()
    assert collections.Counter(r["doc_id"] for r in got if r["piece"] == 0) == collections.Counter(i for i, _ in rows)
    ends = collections.defaultdict(list)
    for r in got:
        ends[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in ends.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 256


def test_marks_are_cut_off_where_the_tokenizer_cuts():
    from tokenizers import Tokenizer
    model = Tokenizer.from_file(packing.tokenizer_path())
    words = ["end.", "it's.", "'s", "a'", "don't!", "x<|endoftext|>", "a<|", "é!", "éa!?", "ab\u0301!", "a..b..", "A.B.", "1.", "a1.", "...", "a'.", "q\u00a0z!", "<|startoftext|>!"]
    got = packing.WordTokenizer(packing.tokenizer_path()).ids([w.encode() for w in words] + [" ".join(words).encode()])
    import numpy as np
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [model.encode(t, add_special_tokens=False).ids for t in [*words, " ".join(words)]]


def test_a_word_is_encoded_once_whatever_marks_follow():
    from tokenizers import Tokenizer
    model = Tokenizer.from_file(packing.tokenizer_path())
    texts = ["N\u00c9! n\u00e9? n\u00e9 end. End, END\x0b\x0cfin;  <b>", "n\u00e9... fin \u00e6\u00df\u00b5\u00aa! \u0130a! \u03a3\u03a3. n\u0303! A<|endoftext|>B n\u00e9!", "", " \t"]
    words = packing.WordTokenizer(packing.tokenizer_path())
    got = [g for t in texts for g in words.ids([t.encode()])]
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [model.encode(t, add_special_tokens=False).ids for t in texts]
    known = words.known.to_pylist()
    assert len(known) == len(set(known)) and {"n\u00e9", "end", "fin"} <= set(known)
    assert not {"n\u00e9!", "n\u00e9?", "n\u00e9...", "end.", "fin;"} & set(known)


@pytest.mark.parametrize("cache", [20, 120, 400])
def test_a_worker_forgets_words_and_stays_right(monkeypatch, cache):
    from tokenizers import Tokenizer
    monkeypatch.setattr(packing, "WORD_CACHE", cache)
    model = Tokenizer.from_file(packing.tokenizer_path())
    rng = np.random.default_rng(5)
    letters = np.array(list("abcde\u00e9\u0142"))
    texts = [" ".join("".join(rng.choice(letters, rng.integers(1, 4))) + rng.choice(["", ".", "'s", "1"]) for _ in range(40)) for _ in range(40)]
    words = packing.WordTokenizer(packing.tokenizer_path())
    for t in texts:
        assert [np.frombuffer(g, "<u4").tolist() for g in words.ids([t.encode()])] == [model.encode(t, add_special_tokens=False).ids]
        assert len(words.known) <= cache + 120 and words.known[0].as_py() == ""
        assert len(words.known) == len(words.first) == len(words.size) == len(words.met)


def test_a_batch_looks_each_word_up_once(monkeypatch):
    from tokenizers import Tokenizer
    model = Tokenizer.from_file(packing.tokenizer_path())
    known = packing.WordTokenizer(packing.tokenizer_path())
    looked, numbers = [], known.numbers
    monkeypatch.setattr(known, "numbers", lambda words: (looked.extend(words.to_pylist()), numbers(words))[1])
    # A search in an array hashes all known words each time.
    monkeypatch.setattr(packing.pc, "index_in", lambda *a, **k: pytest.fail("known words are hashed again"))
    texts = [" ".join(f"{'\u00c9b' * (k % 5)}word{'abcdefghij'[k % 10]}{'xyz' * (j % 7)}" for j in range(k, k + 150)) for k in range(SLICE_ROWS)]
    got = [ids for part in packing.chunks([t.encode() for t in texts]) for ids in known.ids(part)]
    assert sum(map(len, texts)) > 1_000_000 and len(looked) == len(set(looked)) > 50
    for k in range(0, SLICE_ROWS, 37):
        assert np.frombuffer(got[k], "<u4").tolist() == model.encode(texts[k], add_special_tokens=False).ids
    assert known.number == {w: i for i, w in enumerate(known.known.to_pylist())}
    known.keep_met()
    assert known.number == {w: i for i, w in enumerate(known.known.to_pylist())}


@pytest.mark.parametrize("texts", [[], [""], ["", " \n\t", ""], ["", "1", "!"], ["\u00c9\u00ff \u00b5\u00aa\u00ba\u00df"]])
def test_texts_without_words_or_without_letters(texts):
    from tokenizers import Tokenizer
    model = Tokenizer.from_file(packing.tokenizer_path())
    got = packing.WordTokenizer(packing.tokenizer_path()).ids([t.encode() for t in texts])
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [model.encode(t, add_special_tokens=False).ids for t in texts]


def test_a_worker_gives_memory_back_after_a_task(monkeypatch):
    import pyarrow as pa
    from meterline.llm.common import SLICE_ROWS, map_rows
    released = []
    pool = type("Pool", (), {"release_unused": lambda self: released.append(1)})()
    frame = type("Frame", (), {"mapInArrow": lambda self, run, schema: run})()
    batches = [pa.record_batch({"x": list(range(n))}) for n in (SLICE_ROWS + 1, 3)]
    monkeypatch.setattr(pa, "default_memory_pool", lambda: pool)
    found = [b.num_rows for b in map_rows(frame, lambda b: b, "x long")(iter(batches))]
    assert found == [SLICE_ROWS, 1, 3] and released == [1]


def test_staging_leaves_no_shuffle_files(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    files = lambda: {str(f) for d in folders for f in Path(d).rglob("shuffle_*")}
    before, setting = files(), spark.conf.get(FREE_SHUFFLES)
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    got = staged(rows, "test-shuffles")
    for _ in range(50):  # files go in the background
        if left := files() - before:
            time.sleep(0.1)
    assert not left and spark.conf.get(FREE_SHUFFLES) == setting
    assert got.agg(F.sum("n")).first()[0] == 1000 and got.count() == 7


def test_staging_sends_small_batches_to_python(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.num_rows], pa.int64())], names=["n"])

    setting = spark.conf.get(BATCH_ROWS)
    got = staged(spark.range(0, 3000, 1, 1).mapInArrow(sizes, "n long"), "test-batches", texts=True).collect()
    assert sum(r["n"] for r in got) == 3000 and max(r["n"] for r in got) <= SLICE_ROWS
    assert spark.conf.get(BATCH_ROWS) == setting
