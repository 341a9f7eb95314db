"""The byte-level automaton: small vocabularies by brute force, bounded tables, long words."""

import random

import pytest

from cargolens.llm import bpe
from cargolens.llm.queries import tokenizer_path


def merged(word, ranks):
    """Greedy merging by rank."""
    parts = [bytes([b]) for b in word]
    while True:
        best = min((ranks.get((a, b), 1 << 30), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))) if len(parts) > 1 else (1 << 30, 0)
        if best[0] == 1 << 30:
            return parts
        pair = parts[best[1]], parts[best[1] + 1]
        out, i = [], 0
        while i < len(parts):
            if tuple(parts[i : i + 2]) == pair:
                out.append(pair[0] + pair[1])
                i += 2
            else:
                out.append(parts[i])
                i += 1
        parts = out


def made(rng, merges, letters=b"abc"):
    labels = [bytes([b]) for b in letters]
    pairs = []
    for _ in range(merges):
        a, b = rng.choice(labels), rng.choice(labels)
        if a + b not in labels:
            pairs.append((a, b))
            labels.append(a + b)
    ids = {x: i for i, x in enumerate(labels)}
    return bpe.MergeAutomaton({i: x for x, i in ids.items()}, [(ids[a], ids[b], ids[a + b]) for a, b in pairs]), {p: k for k, p in enumerate(pairs)}


@pytest.mark.parametrize("seed", range(30))
def test_small_vocabularies(seed):
    rng = random.Random(seed)
    automaton, ranks = made(rng, rng.randrange(1, 25))
    for _ in range(300):
        word = bytes(rng.choice(b"abc") for _ in range(rng.randrange(0, 25)))
        assert [automaton.labels[i] for i in automaton.encode(word)] == merged(word, ranks), word


def test_every_word_goes_through_the_table():
    automaton, _ = made(random.Random(1), 12)
    for label in list(automaton.labels.values()):
        automaton.encode(label)
    assert len(automaton.states) > 3 and all(automaton.table[s] for s in list(automaton.table))
    with pytest.raises(ValueError, match="lacks a byte"):
        automaton.encode(b"z")


def test_the_table_starts_anew_when_it_is_full(monkeypatch):
    from tokenizers import Tokenizer

    library, own = Tokenizer.from_file(tokenizer_path()), bpe.ByteBPE(tokenizer_path())
    monkeypatch.setattr(bpe, "TABLE_ENTRIES", 300)
    monkeypatch.setattr(bpe, "CACHE_CHUNKS", 20)
    rng = random.Random(2)
    for _ in range(400):
        text = " ".join("".join(rng.choices("etaoinshrdlu'é.,0123", k=rng.randrange(1, 14))) for _ in range(10))
        assert own.encode(text) == library.encode(text, add_special_tokens=False).ids
    assert len(own.automaton.table) < 500 and len(own.automaton.gone) <= 300


def test_long_words():
    from tokenizers import Tokenizer

    library, own = Tokenizer.from_file(tokenizer_path()), bpe.load(tokenizer_path())
    for text in ("a" * 60_000, "ab" * 30_000, "-" * 50_000 + "é" * 20_000, "\n" * 40_000):
        assert own.encode(text) == library.encode(text, add_special_tokens=False).ids
