"""URL filter lists as a cascade of Bloom filters with exact answers.

A list of rules (host and path prefix) becomes a set of keys. A url has a key
for each suffix of its host's labels and each prefix of its path that a rule
could have; all keys of all urls of the corpus are the universe. Level 0 is a
Bloom filter of the listed keys. Level 1 holds the keys of the universe that
level 0 takes for listed by mistake, level 2 the listed keys that level 1 takes
for such mistakes, and so on until a level makes none. A key's membership is
the parity of the first level that lacks it, which is exact for every key of
the universe and needs no join: the cascade is a few bytes per listed key.

Only level 0 is held against the whole universe, once. Its mistakes are distinct
keys, whose number its size is chosen to hold near that of the list; if more
come up than planned, level 0 is made larger. All further levels only concern
the list and these mistakes.

Verdicts: each kind of rule (allow, block) has a cascade of its own. Of a url's
listed keys the longest decides (block, should both kinds list it); a url
without listed key is allowed.

Defined results: null urls and urls without ``://`` have empty host and path and
no key; an empty host or a path that does not start with a rule's path fits no
rule; an empty list blocks nothing; hosts are compared in lower case (A-Z only);
repeated urls get repeated rows; other columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import map_arrow

#: Mistakes of level 0 that may be fetched to the driver, per listed key.
MISTAKES_PER_KEY = 4
MIN_MISTAKES = 1000


class Bloom:
    def __init__(self, n: int, rate: float, salt: int):
        self.salt = salt
        self.m = max(64, math.ceil(-n * math.log(rate) / math.log(2) ** 2))
        self.k = max(1, round(self.m / max(1, n) * math.log(2)))
        self.bits = np.zeros((self.m + 7) // 8, np.uint8)

    def _at(self, key: str) -> list[int]:
        h = xxhash.xxh3_128_intdigest(key.encode(), self.salt)
        a, b = h & (1 << 64) - 1, h >> 64 | 1
        return [(a + i * b) % self.m for i in range(min(self.k, 40))]

    def add(self, key: str) -> None:
        for i in self._at(key):
            self.bits[i >> 3] |= 1 << (i & 7)

    def __contains__(self, key: str) -> bool:
        return all(self.bits[i >> 3] >> (i & 7) & 1 for i in self._at(key))


@dataclass
class Cascade:
    levels: list[Bloom] = field(default_factory=list)

    def __contains__(self, key: str) -> bool:
        for i, level in enumerate(self.levels):
            if key not in level:
                return i % 2 == 1
        return len(self.levels) % 2 == 1

    @property
    def size_bytes(self) -> int:
        return sum(len(b.bits) for b in self.levels)


def first_level(listed: Iterable[str], universe: int, more_bits: int = 0) -> Bloom:
    listed = list(listed)
    rate = min(0.5, max(1e-9, math.sqrt(0.5) * max(1, len(listed)) / max(1, universe))) / 2**more_bits
    out = Bloom(len(listed), rate, 0)
    for key in listed:
        out.add(key)
    return out


def further_levels(top: Bloom, listed: set[str], mistakes: set[str]) -> Cascade:
    """The cascade under ``top``, given all its mistakes in the universe."""
    out, inside, outside = Cascade([top]), set(listed), set(mistakes)
    while outside:
        level = Bloom(len(outside), 0.5, len(out.levels))
        for key in outside:
            level.add(key)
        out.levels.append(level)
        inside, outside = outside, {key for key in inside if key in level}
    return out


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def keys_of(host: str, path: str, lengths: list[int]) -> list[tuple[int, str]]:
    """(length of the rule, key) for each rule that could fit."""
    if not host:
        return []
    labels = host.split(".")
    hosts = [".".join(labels[i:]) for i in range(len(labels))]
    return [(len(h) + n, h + path[:n]) for h in hosts for n in lengths if len(path) >= n]


@dataclass
class UrlFilter:
    """``rules``: (verdict, host, path prefix). Build it on the urls it will judge."""

    allow: Cascade
    block: Cascade
    lengths: list[int]

    @classmethod
    def build(cls, urls: DataFrame, rules: Iterable[tuple[str, str, str]], url_col: str = "url") -> UrlFilter:
        rules = list(rules)
        lengths = sorted({len(path) for _, _, path in rules})
        lists = {v: {host + path for verdict, host, path in rules if verdict == v} for v in ("allow", "block")}
        host, path = split_url(F.col(url_col))
        parts = urls.select(host.alias("host"), path.alias("path"))
        n_keys = max(1, 3 * len(lengths) * parts.count())
        cascades, more = {}, 0
        while True:
            tops = {v: first_level(keys, n_keys, more) for v, keys in lists.items()}
            limit = max(MIN_MISTAKES, MISTAKES_PER_KEY * len(rules))

            def mistaken(batches: Iterator[pa.RecordBatch], tops=tops) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    found = set()
                    for h, p in set(zip(*(c.to_pylist() for c in batch.columns), strict=True)):
                        for _, key in keys_of(h, p, lengths):
                            found |= {(v, key) for v, top in tops.items() if key in top and key not in lists[v]}
                    kinds, names = zip(*found, strict=True) if found else ((), ())
                    yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(names, pa.string())], names=["verdict", "key"])

            found = map_arrow(parts, mistaken, "verdict string, key string").distinct().limit(limit + 1).collect()
            if len(found) <= limit:
                break
            more += 3
        for v, keys in lists.items():
            cascades[v] = further_levels(tops[v], keys, {r["key"] for r in found if r["verdict"] == v})
        return cls(cascades["allow"], cascades["block"], lengths)

    def judge(self, pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
        """Per row: host, path, the rule that decides (else null) and the verdict."""
        host, path = split_url(F.col(url_col))
        me = self

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rules, verdicts = [], []
                for h, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                    rule, verdict = None, "allow"
                    for _, key in sorted(keys_of(h, p, me.lengths), reverse=True):
                        if key in me.block or key in me.allow:
                            rule, verdict = key, "block" if key in me.block else "allow"
                            break
                    rules.append(rule)
                    verdicts.append(verdict)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rules, pa.string()), pa.array(verdicts, pa.string())], names=[id_col, "host", "path", "rule", "verdict"])

        rows = pages.select(F.col(id_col).cast("long").alias(id_col), host.alias("host"), path.alias("path"))
        return map_arrow(rows, run, f"{id_col} long, host string, path string, rule string, verdict string")
