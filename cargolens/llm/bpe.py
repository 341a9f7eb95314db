"""Byte-pair encoding and decoding with a tokenization automaton.

The merge list is compiled, one merge after the other, into a deterministic
automaton over tokens. It starts as a single state with a loop for each of the
256 bytes. The gadget of a merge ``u v -> w`` takes the state that all arcs
``u`` enter, splits off a copy for them that has lost its arc ``v``, and adds
arcs ``w`` that enter the state arcs ``v`` entered before. After the last merge
the paths from the start state are exactly the token sequences that greedy
merging by rank produces.

States share their history with the state they were split from, so that the
automaton takes memory in proportion to the merges.

Texts come as bytes, so the automaton over tokens is turned into a deterministic
one over bytes. After some bytes of a word, its state is the state that the
tokens so far lead to and, for each place where a token may be under way, the
place in the tree of tokens and the state before it. For each byte the transition
table has the next state and the last token of what has been read, of which there
is exactly one. A pre-split word is encoded by one transition for each byte; its
tokens are then read off from its end, each token's length leading to the one
before. A row of the table is computed when a byte is first met in its state, and
kept: written out in full for this kind of vocabulary, the arcs between tokens
alone would be some 10^8. Decoding emits the labels of the arcs.

Defined results: null text counts as empty; an empty text has no ids; a text of
any length is encoded whole; repeated rows give repeated results; columns other
than the id and text are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import sys
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import map_arrow, text_or_empty

#: Fixed value: how byte-level vocabularies of this kind split a text into words.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: A chunk that is one word by ``SPLIT``, for letters whose class is beyond doubt.
_ONE_WORD = re.compile("[ ]?[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch

#: A blank between white space, or between white space and the end: here a word
#: may reach over the blank, so that the text can't be cut before it.
_STRADDLES = re.compile(r"\s \s|\s $")

#: Chunks remembered by a worker, in each of two generations.
CACHE_CHUNKS = 150_000
#: Entries of the transition table that a worker keeps before it starts anew.
TABLE_ENTRIES = 500_000


def byte_names() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    out = {chr(b): b for b in plain}
    out |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    return out


class _Table(dict):
    """Transition table: state | byte -> next state, states being multiples of 256.
    Entries are plain numbers, so the table costs no garbage collection."""

    def __init__(self, compute):
        super().__init__()
        self.compute = compute

    def __missing__(self, key: int) -> int:
        found = self[key] = self.compute(key >> 8, key & 255)
        return found


#: The state before a word: any token may come first.
START = -1
#: Later than any merge, and what stands for an arc that was never lost.
LATEST, NEVER = 1 << 60, 1 << 61


class MergeAutomaton:
    """The automaton of a merge list, with tokens as arc labels."""

    def __init__(self, labels: dict[int, bytes], merges: list[tuple[int, int, int]]):
        self.labels = labels
        self.ids = {b: i for i, b in labels.items()}
        #: state -> (state it was split from, merge that split it)
        self.origin: list[tuple[int, int]] = [(-1, -1)]
        #: state -> arcs that it lost itself: token -> merge
        self.lost: list[dict[int, int]] = [{}]
        #: token -> state that its arcs enter
        self.enters = {i: 0 for i, b in labels.items() if len(b) == 1}
        #: (state, token) -> when its arc was lost; kept once all merges are in
        self.gone: dict[int, int] = {}
        own = [0]  # tokens whose arcs enter a state
        own[0] = len(self.enters)
        #: merged token -> (left part, merge)
        self.left: dict[int, tuple[int, int]] = {}
        for k, (u, v, w) in enumerate(merges):
            self._gadget(k, u, v, w, own)
            self.gone.clear()
        #: the tree of tokens: node << 8 | byte -> node; the token that ends at a node, whether longer ones go on
        self.tree: dict[int, int] = {}
        self.token_at, self.goes_on = [-1], bytearray(1)
        for label, token in self.ids.items():
            if token in self.enters:
                self._plant(label, token)
        self.length = {i: len(b) for i, b in labels.items()}
        self.reset()

    def _gadget(self, k: int, u: int, v: int, w: int, own: list[int]) -> None:
        if u not in self.enters or v not in self.enters:
            return  # a part that no merge makes
        target = self.enters[v]
        state = self.enters[u]
        if not self.has_arc(state, v):
            return  # what earlier merges leave never has v behind u
        if own[state] > 1 or u == v:  # what enters with w must keep the arc
            own[state] -= 1
            self.origin.append((state, k))
            self.lost.append({})
            own.append(1)
            state = self.enters[u] = len(self.origin) - 1
        self.lost[state].setdefault(v, k)
        if w not in self.left:
            self.left[w] = (u, k)
            self.enters[w] = target
            own[target] += 1

    def _plant(self, label: bytes, token: int) -> None:
        node = 0
        for byte in label:
            self.goes_on[node] = 1
            key = node << 8 | byte
            node = self.tree.get(key, 0)
            if not node:
                node = self.tree[key] = len(self.token_at)
                self.token_at.append(-1)
                self.goes_on.append(0)
        self.token_at[node] = token

    def reset(self) -> None:
        """An empty transition table. A state is the last token and (node of the token
        tree, state of the token automaton before it) for each token that may be under
        way, longest first; the first one is that before a word."""
        self.states: list[tuple[int, tuple]] = [(-1, ())]
        self.numbers: dict[tuple[int, tuple], int] = {}
        self.last: list[int] = [-1]
        self.table = _Table(self.transition)

    def transition(self, number: int, byte: int) -> int:
        token, open_ = self.states[number]
        begun, last = [], -1
        for node, before in (*open_, (0, self.enters[token] if token >= 0 else START)):
            if node := self.tree.get(node << 8 | byte):
                token = self.token_at[node]
                if last < 0 <= token and (before == START or self.has_arc(before, token)):
                    last = token
                if self.goes_on[node]:
                    begun.append((node, before))
        if last < 0:
            raise ValueError("the vocabulary lacks a byte")
        to = (last, tuple(begun))
        found = self.numbers.get(to)
        if found is None:
            found = self.numbers[to] = len(self.states)
            self.states.append(to)
            self.last.append(last)
        return found << 8

    def has_arc(self, state: int, token: int) -> bool:
        """Whether ``token`` may follow a token whose arcs enter ``state``.

        An arc is there if none of the parts it grew from, down its left side,
        had been lost by the time of the merge that used that part.
        """
        part, until, left, gone, base = token, LATEST, self.left, self.gone, state << 20
        while True:
            lost = gone.get(base | part)
            if (self.lost_at(state, part) if lost is None else lost) <= until:
                return False
            if part not in left:
                return True
            part, until = left[part]

    def lost_at(self, state: int, part: int) -> int:
        """The merge with which a state, or one it was split from while it was that, lost its arc."""
        found, before, origin, lost = NEVER, LATEST, self.origin, self.lost
        at = state
        while at >= 0:
            k = lost[at].get(part, NEVER)
            if k <= before and k < found:
                found = k
            at, born = origin[at]
            before = min(before, born)
        if len(self.gone) >= TABLE_ENTRIES:
            self.gone.clear()
        self.gone[state << 20 | part] = found
        return found

    def encode(self, word: bytes) -> list[int]:
        """Ids of one pre-split word."""
        if len(self.table) > TABLE_ENTRIES:
            self.reset()
        table, state, path = self.table, 0, []
        for byte in word:
            state = table[state | byte]
            path.append(state)
        length, lasts, at, out = self.length, self.last, len(word), []
        while at:
            last = lasts[path[at - 1] >> 8]
            out.append(last)
            at -= length[last]
        out.reverse()
        return out


def _packed(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class _Chunks(dict):
    """Chunk of text -> its ids as little-endian bytes, in two bounded generations."""

    def __init__(self, encode):
        super().__init__()
        self.encode, self.old = encode, {}

    def __missing__(self, chunk: str) -> bytes:
        found = self.old.get(chunk)
        if found is None:
            found = self.encode(chunk)
        if len(chunk) > 64:
            return found
        if len(self) >= CACHE_CHUNKS:
            self.old = dict(self)
            self.clear()
        self[chunk] = found
        return found


def read_vocabulary(path: str, with_merges: bool = True) -> tuple[dict[int, bytes], dict[str, int], list[tuple[int, int, int]]]:
    """Labels by id, ids of special tokens, and merges as ids."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    names = byte_names()
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    labels = {i: bytes(names[c] for c in s) for s, i in spec["model"]["vocab"].items() if s not in special}
    merges = []
    if with_merges:
        by_bytes = {b: i for i, b in labels.items()}
        for m in spec["model"]["merges"]:
            a, b = m.split(" ") if isinstance(m, str) else m
            a, b = bytes(names[c] for c in a), bytes(names[c] for c in b)
            merges.append((by_bytes[a], by_bytes[b], by_bytes[a + b]))
    return labels, special, merges


class ByteBPE:
    """Encodes and decodes whole texts with a byte-level vocabulary file."""

    def __init__(self, path: str):
        labels, self.special, merges = read_vocabulary(path)
        self.automaton = MergeAutomaton(labels, merges)
        top = max([*labels, *self.special.values()]) + 1
        self.arc_label: list[bytes] = [labels.get(i, b"") for i in range(top)]
        for s, i in self.special.items():
            self.arc_label[i] = s.encode()
        self._split = regex.compile(SPLIT).findall
        self._cut_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.chunks = _Chunks(self._encode_chunk)

    def _encode_chunk(self, chunk: str) -> bytes:
        encode = self.automaton.encode
        if _ONE_WORD(chunk):
            return _packed(encode(chunk.encode()))
        return _packed([i for word in self._split(chunk) for i in encode(word.encode())])

    def _encode_plain(self, text: str) -> bytes:
        if not text:
            return b""
        if _STRADDLES.search(text):
            return self._encode_chunk(text)
        first, *rest = text.split(" ")
        chunks = self.chunks
        return b"".join([chunks[first] if first else b"", *map(chunks.__getitem__, [" " + c for c in rest])])

    def encode_bytes(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self._cut_special and any(s in text for s in self.special):
            parts = self._cut_special.split(text)
            return b"".join(np.uint32(self.special[p]).astype("<u4").tobytes() if p in self.special else self._encode_plain(p) for p in parts)
        return self._encode_plain(text)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), "<u4").tolist()

    def decode_bytes(self, ids: Iterable[int]) -> bytes:
        """The labels of the arcs; bytes that are no UTF-8 become U+FFFD."""
        raw = b"".join(map(self.arc_label.__getitem__, ids))
        return raw.decode("utf-8", "replace").encode()


@functools.lru_cache(maxsize=2)
def load(path: str) -> ByteBPE:
    """One automaton for each worker process."""
    return ByteBPE(path)


def encode_decode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Per row: ``n_tokens``, digests of the ids and of the decoded text, and with
    ``with_ids`` the ids and the decoded text themselves."""
    schema = f"{id_col} long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(tokenizer_path)
        for batch in batches:
            cols: list[list] = [[] for _ in range(5)]
            for text in batch.column(1).to_pylist():
                raw = bpe.encode_bytes(text)
                ids = np.frombuffer(raw, "<u4").tolist()
                back = bpe.decode_bytes(ids)
                cols[0].append(len(ids))
                cols[1].append(hashlib.sha256(raw).hexdigest())
                cols[2].append(hashlib.sha256(back).hexdigest())
                if with_ids:
                    cols[3].append(ids)
                    cols[4].append(back.decode())
            arrays = [batch.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string())]
            names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                arrays += [pa.array(cols[3], pa.list_(pa.int32())), pa.array(cols[4], pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return map_arrow(docs.select(F.col(id_col).cast("long").alias(id_col), text_or_empty(text_col).alias("text")), run, schema)
