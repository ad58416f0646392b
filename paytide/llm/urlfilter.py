"""URL rules by a Bloom filter cascade: exact membership without a join.

A rule is a host and the beginning of a path. Every URL has a few candidate keys: the ends
of its host and the beginnings of its path in the shapes that occur in the list. The keys of
all URLs are the universe. Level 0 encodes the listed keys; level 1 those keys of the
universe that level 0 takes by mistake; level 2 the listed keys that level 1 takes by
mistake; and so on until a level makes no mistake. A key of the universe is then listed or
not by the first level that does not know it, without error.

Levels are built from partial bitmaps in Spark; the driver holds the bits of one segment of
at most `segment_keys` listed keys. A longer list is cut into segments by hash, and the
URLs pass the segments one after the other.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paytide.llm.frames import fresh, quoted, staged, without
from paytide.llm.text import mix

#: Listed keys of one segment; its levels hold about 2 bytes for each.
SEGMENT_KEYS = 10_000_000
#: A key is told by two 64-bit hashes; more levels than this would mean that two keys share both.
MAX_LEVELS = 200

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HOST = r"(?s)^.*?://([^/?#]*)"
PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"


def host_of(url: Column) -> Column:
    """What follows the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty
    for a null URL and one without `://`."""
    return F.translate(F.coalesce(F.regexp_extract(url, HOST, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(url, PATH, 1), F.lit(""))


@dataclass(frozen=True)
class Level:
    """One Bloom filter; `number` makes its hashes differ from those of other levels."""

    number: int
    n_bits: int
    n_hashes: int
    words: np.ndarray | None = None

    @classmethod
    def sized(cls, number: int, keys: int, rate: float) -> Level:
        """A filter for so many keys that takes others by mistake at about `rate`."""
        n_bits = max(64, math.ceil(keys * -math.log(rate) / math.log(2) ** 2))
        return cls(number, n_bits, max(1, round(-math.log2(rate))))

    def places(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Bit positions, `(n_hashes, n)`."""
        turn = np.uint64((self.number + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
        first = mix(h1.view(np.uint64) + turn)
        step = mix(h2.view(np.uint64) ^ turn) | np.uint64(1)
        count = np.arange(self.n_hashes, dtype=np.uint64)[:, None]
        return ((first + count * step) % np.uint64(self.n_bits)).astype(np.int64)

    def holds(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        at = self.places(h1, h2)
        bits = (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
        return bits.all(axis=0)


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def listed(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Whether keys of the universe are listed; exact for these, and only for these."""
        out = np.full(len(h1), len(self.levels) % 2 == 1)
        open_ = np.arange(len(h1))
        for i, level in enumerate(self.levels):
            known = level.holds(h1[open_], h2[open_])
            out[open_[~known]] = i % 2 == 1
            open_ = open_[known]
        return out


def _hashes(key: str) -> list[Column]:
    # Seeded by a value before the key: hashing it after would only extend the first hash.
    return [F.xxhash64(F.col(key)).alias("h1"), F.xxhash64(F.lit(1), F.col(key)).alias("h2")]


def _numbers(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return batch["h1"].to_numpy(), batch["h2"].to_numpy()


def _encoded(keys: DataFrame, level: Level) -> Level:
    """`level` with the bits of all `keys`; partial bitmaps meet by word."""

    def run(batches):
        for batch in batches:
            bits = np.unique(level.places(*_numbers(batch)))
            if not len(bits):
                continue
            words, first = np.unique(bits >> 6, return_index=True)
            masks = np.bitwise_or.reduceat(np.uint64(1) << (bits & 63).astype(np.uint64), first)
            yield pa.RecordBatch.from_arrays(
                [pa.array(words), pa.array(masks.view(np.int64))], names=["word", "mask"]
            )

    parts = keys.select("h1", "h2").mapInArrow(run, "word long, mask long")
    found = parts.groupBy("word").agg(F.bit_or("mask").alias("mask")).toPandas()
    words = np.zeros((level.n_bits + 63) // 64, np.uint64)
    words[found["word"].to_numpy(np.int64)] = found["mask"].to_numpy(np.int64).view(np.uint64)
    return Level(level.number, level.n_bits, level.n_hashes, words)


def _taken(keys: DataFrame, level: Level) -> DataFrame:
    """The rows of `keys` that the level holds."""

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(level.holds(*_numbers(batch)), pa.bool_()))

    return keys.mapInArrow(run, keys.schema)


def build_cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """The cascade of `listed` over `universe`; both hold the hashes `h1`, `h2` of their keys.

    Repeated keys do no harm. The universe is read twice, once for its size and once through
    level 0; all further levels see only what level 0 takes. No listed keys give a cascade
    without levels, by which nothing is listed.
    """
    listed = staged(listed.select("h1", "h2").distinct())
    n = listed.count()
    if not n:
        return Cascade(())
    others = universe.agg(F.approx_count_distinct("h1")).first()[0]
    # The customary choice: the first level leaves about as many mistakes as half the list.
    rate = min(0.5, max(1e-6, n / (math.sqrt(2) * max(others, 1))))
    levels = [_encoded(listed, Level.sized(0, n, rate))]
    both = _taken(universe.select("h1", "h2"), levels[0]).withColumn("listed", F.lit(0))
    rest = staged(
        both.union(listed.withColumn("listed", F.lit(1))).groupBy("h1", "h2").agg(F.max("listed").alias("listed"))
    )
    while len(levels) < MAX_LEVELS:
        side = (len(levels) + 1) % 2  # 1 at even levels, which encode listed keys
        wrong = rest.filter(F.col("listed") == side)
        n = wrong.count()
        if not n:
            return Cascade(tuple(levels))
        levels.append(_encoded(wrong, Level.sized(len(levels), n, 0.5)))
        rest = staged(_taken(rest, levels[-1]))
    raise RuntimeError("two keys of the universe share both hashes")


def _shapes(rules: DataFrame) -> list[tuple[int, int]]:
    """Labels of the host and length of the path, for every shape in the list. There are no
    more than the most labels times the longest path."""
    labels = F.size(F.split("host", r"\.")).alias("labels")
    rows = rules.select(labels, F.length("path").alias("chars")).distinct().collect()
    return sorted((r["labels"], r["chars"]) for r in rows)


def _candidates(shapes: list[tuple[int, int]], host: str, path: str) -> Column:
    """Keys that a rule fitting the URL must have, the longest first (then the longer host)."""
    if not shapes:
        return F.expr("array()").cast("array<struct<size:int,host_size:int,key:string>>")
    drawn = ", ".join(f"named_struct('labels', {a}, 'chars', {b})" for a, b in shapes)
    return F.expr(
        f"sort_array(transform(filter(array({drawn}),"
        f" s -> size(split({host}, '[.]')) >= s.labels AND length({path}) >= s.chars),"
        f" s -> named_struct("
        f"'size', length(substring_index({host}, '.', -s.labels)) + s.chars,"
        f" 'host_size', length(substring_index({host}, '.', -s.labels)),"
        f" 'key', concat(substring_index({host}, '.', -s.labels), left({path}, s.chars)))), false)"
    )


def judge_urls(
    df: DataFrame,
    rules: DataFrame,
    url_col: str = "url",
    *,
    otherwise: str = "allow",
    segment_keys: int = SEGMENT_KEYS,
) -> DataFrame:
    """`df` with `host`, `path`, `rule` and `verdict`; columns of these names are replaced.

    `rules` has `host`, `path` and `action` (`allow` or `block`). A rule fits its host and
    all subdomains of it, if the URL's path begins with the rule's (an empty path begins only
    with an empty one); the longest fitting rule decides, of two as long the one with the
    longer host, and of equal rules the one that blocks. `rule` is its host and path, null
    where none fits; `otherwise` is the verdict there. Rules with a null host, path or
    action are left out; repeated rules count once; no rules at all fit nothing.

    Null URLs and those without `://` have an empty host and path. Rows are judged one by
    one: ties, repeats, null or repeated ids do no harm, long URLs are read whole, an empty
    table gives an empty table. URLs are not shuffled; the list may be of any length.
    """
    df = without(df, ["host", "path", "rule", "verdict"])
    lower = F.translate("host", UPPER, LOWER).alias("host")
    rules = staged(
        rules.select(lower, "path", "action")
        .filter("host IS NOT NULL AND path IS NOT NULL AND action IN ('allow', 'block')")
        .select("host", "path", "action", F.concat("host", "path").alias("key"))
    )
    keys = rules.select(*_hashes("key"), (F.col("action") == "block").alias("block"))
    keys = staged(keys.groupBy("h1", "h2").agg(F.max("block").alias("block")))

    candidates, ones, twos, marks = fresh(df, "candidates", "ones", "twos", "marks")
    url = quoted(url_col)
    keyed = df.withColumns({"host": host_of(url), "path": path_of(url)})
    keyed = keyed.withColumn(candidates, _candidates(_shapes(rules), "host", "path"))
    universe = keyed.select(F.explode(F.col(f"{candidates}.key")).alias("key")).select(*_hashes("key"))

    n_segments = max(1, math.ceil(keys.count() / segment_keys))
    judged = keyed.withColumns(
        {
            ones: F.expr(f"transform({candidates}, c -> xxhash64(c.key))"),
            twos: F.expr(f"transform({candidates}, c -> xxhash64(1, c.key))"),
            marks: F.expr(f"transform({candidates}, c -> 0)"),
        }
    )
    for segment in range(n_segments):
        own = F.pmod("h2", F.lit(n_segments)) == segment
        here = keys.filter(own)
        known = build_cascade(here, universe.filter(own))
        blocked = build_cascade(here.filter("block"), here)
        judged = _marked(judged, known, blocked, segment, n_segments, (ones, twos, marks))
        if segment < n_segments - 1:
            judged = staged(judged)

    best = F.expr(f"array_position(transform({marks}, m -> m > 0), true)")
    mark = F.when(best > 0, F.element_at(marks, best.cast("int")))
    return judged.select(
        *[quoted(c) for c in df.columns],
        "host",
        "path",
        F.when(best > 0, F.element_at(f"{candidates}.key", best.cast("int"))).alias("rule"),
        F.when(mark == 2, "block").when(mark == 1, "allow").otherwise(otherwise).alias("verdict"),
    )


def _marked(df, known: Cascade, blocked: Cascade, segment: int, n_segments: int, names) -> DataFrame:
    """`df` with the marks of the candidates in one segment: 1 allowed, 2 blocked."""
    ones, twos, marks = (df.columns.index(name) for name in names)

    def run(batches):
        for batch in batches:
            lists = batch.column(ones)
            h1, h2 = (batch.column(i).flatten().to_numpy() for i in (ones, twos))
            mark = batch.column(marks).flatten().to_numpy().copy()
            here = np.flatnonzero(h2 % n_segments == segment)  # the sign of the divisor, as pmod
            here = here[known.listed(h1[here], h2[here])]
            mark[here] = 1 + blocked.listed(h1[here], h2[here])
            sizes = np.diff(lists.offsets.to_numpy())
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            columns = list(batch.columns)
            columns[marks] = pa.ListArray.from_arrays(pa.array(offsets), pa.array(mark, pa.int32()))
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return df.mapInArrow(run, T.StructType(df.schema.fields))


def oracle(rules: list[tuple[str, str, str]], pages: str = "pages") -> str:
    """The same question as SQL for DuckDB."""
    rows = ", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in rules)
    best = "order by length(r.host || r.path) desc, length(r.host) desc, r.action desc limit 1"
    fits = (
        "(p.host = r.host or ends_with(p.host, '.' || r.host)) and starts_with(p.path, r.path)"
    )
    return f"""
        with rules(host, path, action) as (values {rows}),
        parsed as (
            select page_id,
                translate(coalesce(regexp_extract(url, '{HOST}', 1), ''), '{UPPER}', '{LOWER}') as host,
                coalesce(regexp_extract(url, '{PATH}', 1), '') as path
            from {pages}),
        judged as (
            select p.*,
                (select r.host || r.path from rules r where {fits} {best}) as rule,
                (select r.action from rules r where {fits} {best}) as action
            from parsed p)
        select page_id, host, path, rule, coalesce(action, 'allow') as verdict from judged"""
