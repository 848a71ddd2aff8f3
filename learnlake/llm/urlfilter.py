"""URL filters: a cascade of Bloom filters answers exactly which keys are listed.

The key universe is every key that a URL of the corpus can ask for: each suffix of its host with each beginning of its
path. The first filter holds the listed keys of the universe; the keys it lets through by mistake go into the second,
the listed keys that the second holds by mistake into the third, and so on until nothing is let through by mistake. A
key is listed if the first filter that rejects it is an even one. No answer needs a join or the list itself.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from learnlake.llm.frames import annotate
from learnlake.session import written

FIRST = 2.0**-12  # false positive rate of the first filter; the later ones halve
LATER = 0.5
ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str  # begins with "/"

    @property
    def key(self) -> str:
        return self.host + self.path


class Bloom:
    """A bit array and a number of hashes; keys are (n, 2) arrays of 64-bit hashes."""

    def __init__(self, bits: int, hashes: int, level: int):
        self.bits, self.hashes, self.level = max(64, bits), max(1, hashes), level
        self.words = np.zeros(-(-self.bits // 64), np.uint64)

    @classmethod
    def sized(cls, keys: int, rate: float, level: int) -> "Bloom":
        hashes = max(1, round(-np.log2(rate)))
        return cls(int(np.ceil(max(1, keys) * hashes / np.log(2))), hashes, level)

    def _places(self, keys: np.ndarray) -> np.ndarray:
        a, b = keys[:, :1], keys[:, 1:] | np.uint64(1)
        salt = np.uint64((self.level * 0x9E3779B97F4A7C15) % (1 << 64))
        h = a + (b ^ salt) * np.arange(1, self.hashes + 1, dtype=np.uint64)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        return h % np.uint64(self.bits)

    def add(self, keys: np.ndarray) -> None:
        at = self._places(keys).ravel()
        np.bitwise_or.at(self.words, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))

    def has(self, keys: np.ndarray) -> np.ndarray:
        at = self._places(keys)
        bit = (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)
        return bit.astype(bool).all(axis=1)


def listed(levels: list[Bloom], keys: np.ndarray) -> np.ndarray:
    """Which keys of the universe are listed."""
    out, open_ = np.zeros(len(keys), bool), np.ones(len(keys), bool)
    for i, level in enumerate(levels):
        passed = np.zeros(len(keys), bool)
        passed[open_] = level.has(keys[open_])
        out[open_ & ~passed] = i % 2 == 1
        open_ = passed
    out[open_] = len(levels) % 2 == 1
    return out


def hashes(keys: Iterable[str]) -> np.ndarray:
    raw = [k.encode("utf-8", "surrogatepass") for k in keys]
    pairs = [(xxhash.xxh64_intdigest(k, 1), xxhash.xxh64_intdigest(k, 2)) for k in raw]
    return np.array(pairs, np.uint64).reshape(-1, 2)


# ---- keys of a URL


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for NULL and for text without ``://``."""
    rest = F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url)))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, capitals, capitals.lower()), path


def asked(host: str, path: str, shapes: list[tuple[int, int]]) -> Iterator[str]:
    """Keys that a rule for this URL can have, the longest first: suffixes of the host with beginnings of the path.

    ``shapes`` are the lengths of the rules' hosts and paths; only keys of these are made, so that a host of any length has
    no more keys than there are shapes.
    """
    if not host:
        return
    fits = {
        host[len(host) - m:] + path[:n] for m, n in shapes
        if 0 < m <= len(host) and n <= len(path) and (m == len(host) or host[len(host) - m - 1] == ".")
    }
    yield from sorted(fits, key=lambda k: (-len(k), k))


@dataclass
class Filter:
    shapes: list[tuple[int, int]]  # lengths of the rules' hosts and paths
    allow: list[Bloom]
    block: list[Bloom]


def cascade(universe: DataFrame, own: list[str], rate: float = FIRST) -> list[Bloom]:
    """The filters that answer for ``own`` keys over ``universe`` (column ``key``, no repeats).

    Only keys that a filter lets through by mistake are gathered, level by level; the first filter's rate falls with the
    universe, so that their number stays below that of the listed keys or a few thousand.
    """
    total = universe.count()
    room = max(len(own), 4096)
    rate = min(rate, room / max(1, total))
    first = Bloom.sized(len(own), rate, 0)
    first.add(hashes(own))
    levels = [first]
    spark = universe.sparkSession
    shared, names = spark.sparkContext.broadcast(first), frozenset(own)

    def wrong(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.array(batch.column(0).to_pylist(), object)
            if len(keys):
                keys = [k for k in keys[shared.value.has(hashes(keys))] if k not in names]
            yield pa.RecordBatch.from_arrays([pa.array(list(keys), pa.string())], names=["key"])

    through = [r[0] for r in universe.select("key").mapInArrow(wrong, "key string").collect()]
    inside, outside = hashes(own), hashes(through)
    while len(outside):
        level = Bloom.sized(len(outside), LATER, len(levels))
        level.add(outside)
        levels.append(level)
        inside, outside = outside, inside[level.has(inside)] if len(inside) else inside
        if len(levels) > 200:
            raise ValueError("two keys of the universe have the same hashes")
    return levels


def fit(urls: DataFrame, rules: list[Rule]) -> Filter:
    """``urls``: one column ``url``. The universe is made of the distinct host and path beginnings of the whole table."""
    shapes = sorted({(len(r.host), len(r.path)) for r in rules})
    host, path = split_url(F.col("url"))
    heads = F.substring(path, 1, max((n for _, n in shapes), default=0))
    pairs = urls.select(host.alias("host"), heads.alias("path")).distinct()

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            keys = sorted({k for h, p in rows for k in asked(h, p, shapes)})
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string())], names=["key"])

    universe = written(pairs.mapInArrow(expand, "key string").distinct(), "url-keys")
    wanted = {v: [r.key for r in rules if r.verdict == v] for v in (ALLOW, BLOCK)}
    return Filter(shapes, cascade(universe, wanted[ALLOW]), cascade(universe, wanted[BLOCK]))


def judge(pages: DataFrame, filters: Filter, keep: list[str], default: str = ALLOW) -> DataFrame:
    """``keep`` columns, ``host``, ``path``, ``rule`` (NULL if none fits) and ``verdict`` (``default`` if none fits).

    The longest listed key decides; allow wins over block for the same key. A NULL url, or one without ``://``, has an
    empty host and path and no rule. Repeated rows are judged alike; an empty table gives no rows; other columns are not
    read. ``filters`` must have been fitted on a table that holds these urls.
    """
    host, path = split_url(F.col("url"))
    parts = pages.select(*[F.col(c) for c in keep], host.alias("_host"), path.alias("_path"))
    parts = parts.withColumn("text", F.concat("_host", "_path"))  # the first slash parts them again

    def build(shared: Filter) -> Callable[[pa.Array], dict]:
        known: dict[tuple[str, str], tuple[str | None, str]] = {}

        def run(texts: pa.Array) -> dict:
            top = max((n for _, n in shared.shapes), default=0)
            cuts = [(t, t.find("/") if "/" in t else len(t)) for t in texts.to_pylist()]
            heads = [(t[:n], t[n: n + top]) for t, n in cuts]
            if len(known) > 100_000:
                known.clear()
            new = [h for h in dict.fromkeys(heads) if h not in known]
            keys = [list(asked(h, p, shared.shapes)) for h, p in new]
            flat = [k for own in keys for k in own]
            hashed = hashes(flat)
            allow, block = listed(shared.allow, hashed), listed(shared.block, hashed)
            at = 0
            for head, own in zip(new, keys):
                known[head] = (None, default)
                for i, key in enumerate(own, at):
                    if allow[i] or block[i]:
                        known[head] = (key, ALLOW if allow[i] else BLOCK)
                        break
                at += len(own)
            return {
                "rule": pa.array([known[h][0] for h in heads], pa.string()),
                "verdict": pa.array([known[h][1] for h in heads], pa.string()),
            }

        return run

    scored = annotate(parts, [*keep, "_host", "_path"], "rule string, verdict string", build, filters)
    return scored.withColumnsRenamed({"_host": "host", "_path": "path"})
