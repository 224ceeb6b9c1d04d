"""URL rules through Bloom filter cascades (DataFrame functions only).

A listed key is a host and a path prefix written together (``example.com/en/``).
A page's candidate keys are its host and every parent domain, each with every
path prefix that ends in ``/``, for the (labels, depth) shapes the list uses.
All distinct candidate keys of the corpus are the key universe.  Level 1 of a
cascade is a Bloom filter of the listed keys; level 2 one of the universe's
false positives of level 1; level 3 of the listed keys that level 2 wrongly
holds; and so on until a level makes no mistake.  Over that universe membership
is then exact, and judging a page needs only its own row: the filters are
constants of the expression, no join.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, functions as F

from meterline.llm.common import staged

ALLOW, BLOCK = "allow", "block"

# A level's bits are constants of the query plan, so their size is checked.
MAX_LISTED = 200_000


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    rest = F.substring(url, F.locate("://", url) + 3, F.length(url))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.locate("://", url) > 0, lower).otherwise("")


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    rest = F.substring(url, F.locate("://", url) + 3, F.length(url))
    return F.when(F.locate("://", url) > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def key_shape(host: str, path: str) -> tuple[int, int]:
    return host.count(".") + 1, path.count("/")


def candidate_keys(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """The page's keys of the given (host labels, path depth) shapes."""
    labels, segments = F.split(host, r"\."), F.split(path, "/")
    keys = [
        F.when((F.size(labels) >= n) & (F.size(segments) > depth) & (host != ""),
               F.concat(F.array_join(F.slice(labels, -n, n), "."),
                        F.array_join(F.slice(segments, 1, depth), "/"), F.lit("/")))
        for n, depth in shapes]
    return F.array_distinct(F.array_compact(F.array(*keys))) if keys else F.array().cast("array<string>")


class Level:
    """One Bloom filter: ``hashes`` positions per key in ``bits`` bits.  The
    words are computed by Spark; the driver holds them only to write them into
    expressions, and ``MAX_LISTED`` bounds them."""

    def __init__(self, keys: DataFrame, count: int, seed: int, bits_per_key: int, hashes: int):
        self.seed, self.hashes = seed, hashes
        self.bits = 64 * -(-max(1, count * bits_per_key) // 64)
        rows = (keys.select(F.explode(F.array(*self.positions(F.col("key")))).alias("p"))
                .groupBy(F.expr("p div 64").alias("word"))
                .agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("bits")).collect())
        words = [0] * (self.bits // 64)
        for r in rows:
            words[r["word"]] = r["bits"]
        self.words = words

    def positions(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(self.seed), F.lit(i)), F.lit(self.bits)) for i in range(self.hashes)]

    def holds(self, key: Column) -> Column:
        words = F.from_json(F.lit(json.dumps(self.words)), "array<bigint>")  # folded to one constant
        hit = F.lit(True)
        for p in self.positions(key):
            word = F.element_at(words, (F.floor(p / 64) + 1).cast("int"))
            hit = hit & (F.bit_get(word, (p % 64).cast("int")) == 1)
        return hit


class Cascade:
    """Exact membership in ``listed`` for every key of ``universe`` (both with
    one column ``key``, without nulls; listed keys outside the universe are
    allowed).  An empty list holds nothing."""

    def __init__(self, listed: DataFrame, universe: DataFrame, bits_per_key: int = 10, hashes: int = 3,
                 max_levels: int = 40):
        listed = staged(listed.select("key").distinct(), "cascade-listed")
        n = listed.count()
        if n > MAX_LISTED:
            raise ValueError(f"{n} listed keys; the filters are written into the query, at most {MAX_LISTED}")
        self.levels: list[Level] = []
        if n == 0:
            return
        # So many more halvings leave no more false positives of level 1 than an eighth of the listed keys.
        more = max(0, math.ceil(math.log2(max(1, universe.count()) / n)))
        bits_per_key, hashes = bits_per_key + -(-3 * more // 2), hashes + more
        # The other side of level 1: universe keys that are not listed.
        inside, outside = listed, universe.select("key").distinct().join(F.broadcast(listed), "key", "left_anti")
        for depth in range(max_levels):
            # Later levels hold few keys and may err half the time, as the next level corrects them.
            level = Level(inside, n, depth, bits_per_key if depth == 0 else 4, hashes if depth == 0 else 2)
            self.levels.append(level)
            wrong = staged(outside.filter(level.holds(F.col("key"))), f"cascade-{depth}")
            n = wrong.count()
            if n == 0:
                return
            if n > MAX_LISTED:
                raise ValueError(f"level {depth + 1} has {n} false positives; raise bits_per_key")
            inside, outside = wrong, inside
        raise RuntimeError("the cascade did not end; raise bits_per_key")

    def holds(self, key: Column) -> Column:
        """Level 1 misses: not listed.  It hits: listed unless level 2 hits,
        and that unless level 3 hits, and so on."""
        member = F.lit(bool(self.levels) and len(self.levels) % 2 == 1)
        for depth in reversed(range(len(self.levels))):
            member = F.when(~self.levels[depth].holds(key), F.lit(depth % 2 == 1)).otherwise(member)
        return member


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]], *, id_col: str = "page_id",
                url_col: str = "url", default: str = ALLOW, bits_per_key: int = 10, hashes: int = 3) -> DataFrame:
    """Judge each url by the longest rule that fits: (page_id, host, path,
    rule, verdict).

    ``rules``: (``allow`` or ``block``, host, path); a path ends in ``/``.  A
    rule fits its host and all subdomains where the url's path starts with the
    rule's.  Two cascades hold the block and the allow keys over all candidate
    keys of ``pages``.  No key listed: no rule, and the verdict is ``default``.

    Null urls and urls without ``://``: empty host and path, no rule.  Repeated
    rows stay, one output row per input row; other columns are ignored.  No
    rules or no pages: every verdict is ``default``, or no rows.
    """
    bad = [r for r in rules if r[0] not in (ALLOW, BLOCK) or not r[2].startswith("/") or not r[2].endswith("/") or not r[1]]
    if bad:
        raise ValueError(f"a rule is (allow or block, host, path that starts and ends with /): {bad}")
    spark = pages.sparkSession
    shapes = sorted({key_shape(host, path) for _, host, path in rules})
    url = F.col(url_col)
    rows = pages.select(F.col(id_col).alias("page_id"), F.coalesce(url_host(url), F.lit("")).alias("host"),
                        F.coalesce(url_path(url), F.lit("")).alias("path"))
    keyed = rows.withColumn("keys", candidate_keys(F.col("host"), F.col("path"), shapes))
    universe = staged(keyed.select(F.explode("keys").alias("key")).distinct(), "url-universe")

    def cascade(kind: str) -> Cascade:
        listed = F.array(*(F.lit(host + path) for verdict, host, path in rules if verdict == kind))
        return Cascade(spark.range(1).select(F.explode(listed.cast("array<string>")).alias("key")), universe,
                       bits_per_key, hashes)

    blocks, allows = cascade(BLOCK), cascade(ALLOW)
    judged = keyed.withColumn("fits", F.filter(F.transform("keys", lambda k: F.struct(
        F.length(k).alias("n"), k.alias("rule"),
        F.when(blocks.holds(k), BLOCK).when(allows.holds(k), ALLOW).alias("verdict"))),
        lambda x: x["verdict"].isNotNull()))
    best = F.array_max("fits")
    return judged.select("page_id", "host", "path", best["rule"].alias("rule"),
                         F.coalesce(best["verdict"], F.lit(default)).alias("verdict"))
