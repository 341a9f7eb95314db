"""The compact form of fingerprints holds the same anchors in under half the characters."""

import random

import numpy as np

from cargolens.llm import queries, syncmers


def test_the_query_writes_all_anchors_in_six_characters_each(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    whole = {r["doc_id"]: r for r in syncmers.fingerprints(docs).collect()}
    got = queries.op4_closed_syncmers(spark, sf).collect()
    assert len(got) == len(whole)
    for r in got:
        for column in ("fingerprint", "edited_fingerprint"):
            assert syncmers.to_text(syncmers.from_compact(r[column])) == whole[r["doc_id"]][column]
        assert (r["near_edited"], r["near_next"]) == (whole[r["doc_id"]]["near_edited"], whole[r["doc_id"]]["near_next"])
    chars = lambda rows: sum(len(r["fingerprint"]) + len(r["edited_fingerprint"]) for r in rows)
    assert chars(got) < chars(whole.values()) / 2


def test_distant_and_first_anchors():
    rng = random.Random(4)
    for n in (0, 1, 2, 300):
        at = sorted(rng.sample(range(1 << 31 if n < 300 else 9000), n))
        print_ = np.sort(np.array([rng.randrange(1 << 32) << 32 | p for p in at], np.uint64))
        assert (syncmers.from_compact(syncmers.to_compact(print_)) == print_).all()
    for at in ([0, 15, 30], [0, 16, 33], [14], [15], [16]):
        print_ = np.array([i << 32 | p for i, p in enumerate(at)], np.uint64)
        assert syncmers.from_compact(syncmers.to_compact(print_)).tolist() == print_.tolist()
