"""Replays against a turn-by-turn brute force."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from cargolens.llm import quarantine
from cargolens.llm.queries import op12_quarantine_release

COLUMNS = ["conv_id", "turn", "status", "attempts", "first_at", "last_at", "release_no", "state"]
SCHEMA = "conv_id long, turn long, role string, text string"


def crc(text):
    return zlib.crc32(text.encode())


def brute(rows):
    by, out = {}, []
    for conv, turn, text in rows:
        if conv is None or turn is None:
            out.append((conv, turn) + (None,) * 6)
        else:
            by.setdefault(conv, []).append((turn, crc(text or "")))
    for conv, turns in by.items():
        turns.sort()
        res = []
        for p, (turn, _) in enumerate(turns):
            h = lambda k: crc(f"{k}:{conv}:{turn}")  # noqa: B023, E731
            back = h(0) % 5
            parent = res[p - back] if 0 < back <= p else None
            if parent and parent[0] != "delivered":
                res.append(["blocked", 0, None, None])
                continue
            at = max(7 * p, parent[3] if parent else 0)
            one = ["delivered", 1, at, at]
            if h(1) % 101 < 50:
                repaired, now, a = 7 * p + h(2) % 101, at, 1
                while now < repaired or h(a + 2) % 3 == 0:
                    if a == 6:
                        one = ["dead", 6, at, now]
                        break
                    now += 20 * 2 ** (a - 1)
                    a += 1
                else:
                    one = ["delivered", a, at, now]
            res.append(one)
        order = sorted((i for i, r in enumerate(res) if r[0] == "delivered"), key=lambda i: (res[i][3], i))
        state, released = 0, {}
        for k, i in enumerate(order, 1):
            state += k * turns[i][1]
            released[i] = (k, (state + 2**63) % 2**64 - 2**63)
        out += [(conv, turns[i][0], *r, *released.get(i, (None, None))) for i, r in enumerate(res)]
    return out


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is not None, x) if not isinstance(x, str) else (True, x) for x in r))


def odd_rows(n=400, seed=1):
    rnd = random.Random(seed)
    rows = [(c, t, f"text {c} {t}") for c in range(30) for t in range(rnd.randint(1, n // 10))]
    rows += [(99, t, "long") for t in range(n)]  # over the bound of the tests
    rows += [(99, 5, None), (99, 5, "long"), (3, 0, "text 3 0"), (7, -4, ""), (None, 1, "x"), (2, None, "x"), (None, None, None)]
    rnd.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(c, t, "user", x) for c, t, x in rows], SCHEMA)


def test_whole_query_is_brute_force(spark, sf):
    got = op12_quarantine_release(spark, sf)
    assert got.columns == COLUMNS
    turns = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "text").collect()
    assert ordered(got.collect()) == ordered(brute(turns))


@pytest.mark.parametrize("block, halo, n", [(64, 140, 400), (9, 4, 60)])
def test_long_conversations_in_blocks(spark, block, halo, n):
    rows = odd_rows(n)
    got = quarantine.replay(frame(spark, rows), longest=35, block=block, halo=halo)
    assert ordered(got.select(*COLUMNS).collect()) == ordered(brute(rows))


def test_odd_rows_and_clashing_columns(spark):
    rows = odd_rows(60)
    df = frame(spark, rows).withColumns({c: F.lit("x") for c in ("conv", "crc", "p", "bucket", "range", "status", "n")})
    assert ordered(quarantine.replay(df).select(*COLUMNS).collect()) == ordered(brute(rows))


def test_empty(spark):
    assert quarantine.replay(frame(spark, [])).select(*COLUMNS).collect() == []
