"""Fingerprints of long texts."""

import random

from cargolens.llm import syncmers


def made(seed, n):
    rng = random.Random(seed)
    return "".join(rng.choice("abcdefghij ") for _ in range(n))


def fingerprint(text):
    return syncmers.fingerprint(syncmers.codes_of(text))


def hashes(text):
    return {x.split("@")[0] for x in syncmers.to_text(fingerprint(text)).split(";")}


def test_a_passage_that_long_texts_share_leaves_common_anchors():
    passage = made(3, 400)
    x, y = (made(s, 60_000) + passage + made(s + 1, 60_000) for s in (10, 20))
    assert len(hashes(x) & hashes(y)) >= len(syncmers.anchors(syncmers.codes_of(passage), 16, 6)[0])


def test_a_small_substitution_in_a_long_text_shows():
    x = made(4, 60_000)
    y = x[:30_000] + "#" + x[30_001:]
    assert hashes(x) != hashes(y) and 0.99 < syncmers.likeness(fingerprint(x), fingerprint(y)) < 1


def test_an_insertion_in_the_middle_keeps_both_halves():
    x = made(5, 4_000)
    assert syncmers.likeness(fingerprint(x), fingerprint(x[:2_000] + made(6, 60) + x[2_000:])) > 0.9
