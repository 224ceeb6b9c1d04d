"""Language ID by rank-order profiles of character n-grams.

A language's profile is its most frequent 1- to 3-grams in rank order.  A
document's own profile, taken over its whole text, is compared with each
language's by the out-of-place distance: how far each n-gram's rank is from
its rank in the language, and the profile length where the language lacks it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from meterline.llm.common import bucket_of, map_rows, text_bytes

UNKNOWN = "und"
PAD = 1  # stands for every run of non-letters, and for the ends of a text

_tables: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Code point -> lower-case code point of a letter, else PAD (built once per worker)."""
    if not _tables:
        lower = np.full(0x110000, PAD, np.int64)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                lower[c] = ord(low) if len(low) == 1 else c
        _tables.append(lower)
    return _tables[0]


def grams(text: bytes) -> np.ndarray:
    """All 1- to 3-grams of a text as numbers, 21 bits a code point; words are
    joined and bounded by one PAD.  No letter: empty."""
    cps = _letters()[np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le", "replace"), "<u4")]
    cps = np.concatenate(([PAD], cps, [PAD]))
    keep = np.ones(len(cps), bool)
    keep[1:] = (cps[1:] != PAD) | (cps[:-1] != PAD)
    cps = cps[keep]
    if len(cps) < 3:
        return np.empty(0, np.int64)
    two = cps[:-1] << 21 | cps[1:]
    return np.concatenate((cps[cps != PAD], two, two[:-1] << 21 | cps[2:]))


def ranked(text: bytes, length: int) -> np.ndarray:
    """A text's ``length`` most frequent n-grams, most frequent first, ties by number."""
    codes, counts = np.unique(grams(text), return_counts=True)
    if len(codes) > 4 * length:  # order only those that can be among the first
        least = np.partition(counts, -length)[-length]
        codes, counts = codes[counts >= least], counts[counts >= least]
    return codes[np.argsort(-counts, kind="stable")[:length]]


class Profiles:
    """Language profiles: ``table[i, k]`` is the rank of ``codes[i]`` in ``langs[k]``."""

    def __init__(self, profiles: dict[str, list[int]], length: int):
        self.length, self.langs = length, sorted(profiles)
        self.codes = np.unique(np.array([c for p in profiles.values() for c in p], np.int64))
        self.table = np.full((len(self.codes) + 1, len(self.langs)), -1, np.int32)
        for k, lang in enumerate(self.langs):
            self.table[np.searchsorted(self.codes, profiles[lang]), k] = np.arange(len(profiles[lang]))

    def predict(self, text: bytes | None) -> tuple[str, float]:
        """The nearest language (ties: the first by code point) and its
        nearness, 1 for equal profiles and 0 for none in common."""
        own = ranked(text, self.length) if text and self.langs else ()
        if not len(own):
            return UNKNOWN, 0.0
        at = np.searchsorted(self.codes, own)
        found = np.append(self.codes, -1)[at] == own
        there = self.table[np.where(found, at, len(self.codes))]
        out = np.where(there < 0, self.length, np.abs(there - np.arange(len(own))[:, None])).sum(0)
        best = int(out.argmin())
        return self.langs[best], 1.0 - float(out[best]) / (self.length * len(own))


def held_out(doc_id: Column, modulus: int = 5, remainder: int = 0) -> Column:
    return F.crc32(doc_id.cast("string")) % modulus == remainder


def learn_profiles(documents: DataFrame, length: int = 300, sample_rows: int = 2000) -> Profiles:
    """Profiles of every ``lang`` in ``documents`` (rows with null text or lang
    take no part).  Fitted on about ``sample_rows`` documents of a language:
    those whose id's hash is under the language's share, so the sample does not
    depend on the layout of the table.  The driver gets ``length`` rows a
    language."""
    rows = documents.filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    shares = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()
    fold = 1 << 30
    pick = F.lit(False)
    for r in shares:
        limit = min(fold, -(-fold * sample_rows // r["n"]))
        pick = pick | ((F.col("lang") == r["lang"]) & (bucket_of(fold, F.col("doc_id")) < limit))

    def count(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        langs, texts = batch.column(2).to_pylist(), batch.column(1)
        out: list[list] = [[], [], []]
        for lang in sorted(set(langs)):
            found = [grams(t.as_py()) for t, own in zip(texts, langs) if own == lang]
            codes, counts = np.unique(np.concatenate(found), return_counts=True)
            out[0] += [lang] * len(codes)
            out[1].append(codes)
            out[2].append(counts)
        return pa.record_batch([pa.array(out[0], pa.string()), *(pa.array(np.concatenate(x)) for x in out[1:])],
                               names=["lang", "code", "n"])

    counts = map_rows(text_bytes(rows.filter(pick), "lang"), count, "lang string, code long, n long")
    totals = counts.groupBy("lang", "code").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "code"))
    top = totals.withColumn("place", place).filter(F.col("place") <= length).select("lang", "code", "place").collect()
    profiles: dict[str, list[int]] = {}
    for r in sorted(top, key=lambda r: r["place"]):
        profiles.setdefault(r["lang"], []).append(r["code"])
    return Profiles(profiles, length)


def identify(documents: DataFrame, profiles: Profiles, keep: tuple = ()) -> DataFrame:
    """(doc_id, lang_pred, score) of every row's whole text, and the columns
    named in ``keep`` (``text`` as text).

    Null or empty text, text without a letter, and no learned language give
    ``und`` with score 0.  Repeated rows give equal rows; other columns are
    never read unless kept."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [profiles.predict(t.as_py()) for t in batch.column(1)]
        told = {"lang_pred": pa.array([x[0] for x in found], pa.string()), "score": pa.array([x[1] for x in found], pa.float64())}
        own = {"doc_id": batch.column(0), "text": batch.column(1).cast(pa.string()),
               **dict(zip(others, batch.columns[2:]))}
        return pa.record_batch({**told, **{c: own[c] for c in ("doc_id", *keep)}})

    others = [c for c in keep if c != "text"]
    kinds = dict(documents.select(*others).dtypes) | {"text": "string"}
    return map_rows(text_bytes(documents, *others), run, ", ".join(
        ["lang_pred string", "score double", "doc_id long", *(f"`{c}` {kinds[c]}" for c in keep)]))
