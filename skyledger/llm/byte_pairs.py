"""Byte-level BPE over all words of a block of texts at once, by replaying the merges in rank order.

The block is cut into words by the pattern of the tokenizer, and its different words are laid out as one row of symbols.
An inverted index leads from the rank of a pair of neighbouring symbols to the places where it stands. The least rank is
taken, all its places are merged, and only the pairs on either side of a merged place are looked up and indexed anew.
"""

from __future__ import annotations

import base64
import heapq
import json
from collections.abc import Callable
from functools import cache

import numpy as np
import pyarrow as pa
import tiktoken
import tokenizers

from skyledger.llm.text_arrays import Run, code_points

#: What the tokenizers here take as words; `boundaries` follows it over whole arrays.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
OTHER, LETTER, NUMBER, SPACE = range(4)
NONE = np.int32(np.iinfo(np.int32).max)


def _classes(matching: Callable[[str, str], str]) -> np.ndarray:
    """OTHER, LETTER, NUMBER or SPACE for every code point, told by the characters of a text that match a pattern."""
    text = "".join(chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000)
    out = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        out[np.frombuffer(matching(pattern, text).encode("utf-32-le"), np.uint32)] = kind
    return out


@cache
def tiktoken_classes() -> np.ndarray:
    """The classes of code points by the Unicode tables of the tiktoken library."""
    single = {bytes([b]): b for b in range(256)}

    def matching(pattern: str, text: str) -> str:
        return bytes(tiktoken.Encoding("classes", pat_str=pattern, mergeable_ranks=single, special_tokens={}).encode_ordinary(text)).decode()

    return _classes(matching)


@cache
def tokenizers_classes() -> np.ndarray:
    """The classes of code points by the Unicode tables of the tokenizers library."""

    def matching(pattern: str, text: str) -> str:
        split = tokenizers.pre_tokenizers.Split(tokenizers.Regex(f"{pattern}+"), "removed", invert=True)
        return "".join(part for part, _ in split.pre_tokenize_str(text))

    return _classes(matching)


def _code_points(run: Run) -> tuple[np.ndarray, np.ndarray]:
    """The code points of a run and the byte at which each begins."""
    if not len(run.data) or run.data.max() < 0x80:
        return run.data.astype(np.uint32), np.arange(len(run.data))
    return np.frombuffer(run.data.tobytes().decode().encode("utf-32-le"), np.uint32), np.flatnonzero(code_points(run.data))


def boundaries(run: Run, classes: np.ndarray) -> np.ndarray:
    """The bytes at which the words of a run begin; words follow each other without a gap and none spans two texts."""
    points, at = _code_points(run)
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = classes[points]
    first = np.zeros(n + 1, bool)
    first[np.searchsorted(at, run.offsets)] = True
    begins = first.copy()
    begins[1:n] |= kind[1:] != kind[:-1]
    starts = np.flatnonzero(begins[:n])
    ends = np.append(starts[1:], n)
    # the last white space before a word stands alone, or belongs to the word if it is a blank
    inner = (kind[starts] == SPACE) & ~first[ends]
    last = ends[inner] - 1
    begins[last] = True
    begins[ends[inner][points[last] == 0x20]] = False
    # an apostrophe that begins a word takes the letters of a contraction with it, and no more
    quote = starts[(points[starts] == 0x27) & (ends - starts == 1) & begins[starts] & (ends < n) & ~first[ends]]
    padded = np.append(points, [0, 0])
    one, two = padded[quote + 1], np.where(first[np.minimum(quote + 2, n)], 0, padded[quote + 2])
    length = np.where(np.isin(one, [ord(c) for c in "stmd"]), 1, 0)
    for a, b in ("re", "ve", "ll"):
        length[(one == ord(a)) & (two == ord(b))] = 2
    quote, length = quote[length > 0], length[length > 0]
    begins[quote + 1] = False
    begins[quote + 1 + length] = True
    return at[np.flatnonzero(begins[:n])]


class Merges:
    """A vocabulary: the bytes of every id, and for pairs of ids the rank of their merge and the id it makes."""

    def __init__(self, tokens: list[bytes], left: np.ndarray, right: np.ndarray, ranks: np.ndarray, made: np.ndarray):
        self.tokens = pa.array(tokens, pa.binary())
        self._size = len(tokens)
        keys = left.astype(np.int64) * self._size + right
        order = np.argsort(keys)
        self._keys, self._ranks = np.append(keys[order], np.iinfo(np.int64).max), np.append(ranks[order], NONE).astype(np.int32)
        #: The id that the merge of a rank makes; ranks that no pair has make none.
        self.made = np.full(int(ranks.max(initial=0)) + 1, -1, np.int32)
        self.made[ranks] = made
        single = {t[0]: i for i, t in reversed(list(enumerate(tokens))) if len(t) == 1}
        self.bytes = np.array([single.get(b, -1) for b in range(256)], np.int32)
        if (self.bytes < 0).any():
            raise ValueError("the vocabulary lacks single bytes")
        least = np.full(self._size, NONE, np.int32)
        np.minimum.at(least, left, ranks.astype(np.int32))
        np.minimum.at(least, right, ranks.astype(np.int32))
        #: Ranks whose merge can make a pair of a lower rank, which then comes first.
        self.unruly = (self.made >= 0) & (least[self.made] < np.arange(len(self.made)))

    @classmethod
    def from_ranks(cls, data: bytes) -> Merges:
        """From lines of base64 and rank: any two neighbours merge whose bytes together are in the vocabulary."""
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        pairs = [(ranks[t[:k]], ranks[t[k:]], r) for t, r in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
        left, right, rank = np.array(pairs, np.int64).reshape(-1, 3).T
        return cls(tokens, left, right, rank, rank)

    @classmethod
    def from_json(cls, data: bytes) -> Merges:
        """From a file of the tokenizers library, with a vocabulary of byte-level characters and merges in rank order."""
        model = json.loads(data)["model"]
        vocabulary, of = model["vocab"], byte_of_character()
        tokens = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            tokens[i] = bytes(of[c] for c in token) if all(c in of for c in token) else token.encode()
        parts = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left, right = (np.array([vocabulary[p[k]] for p in parts], np.int64) for k in (0, 1))
        return cls(tokens, left, right, np.arange(len(parts)), np.array([vocabulary[a + b] for a, b in parts], np.int64))

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ranks of pairs, NONE for pairs that do not merge."""
        keys = left.astype(np.int64) * self._size + right
        found = np.searchsorted(self._keys, keys)
        return np.where(self._keys[found] == keys, self._ranks[found], NONE)


def byte_of_character() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: visible characters of Latin-1 for themselves,
    those from U+0100 on for the other bytes in order."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + k): b for k, b in enumerate(hidden)}


class _Replay:
    """The symbols of some words during the replay."""

    def __init__(self, merges: Merges, data: np.ndarray, offsets: np.ndarray):
        self.merges = merges
        n = len(data)
        self.token = merges.bytes[data]
        self.word = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        self.next, self.before = np.arange(1, n + 1), np.arange(-1, n - 1)
        full = offsets[:-1] < offsets[1:]
        self.next[offsets[1:][full] - 1] = -1
        self.before[offsets[:-1][full]] = -1
        self.live = np.ones(n, bool)
        self.rank = np.full(n, NONE, np.int32)
        #: Inverted index: rank of a pair to the places of its left symbol, and a heap of the ranks in it.
        self.places: dict[int, list[np.ndarray]] = {}
        self.waiting: list[int] = []
        self._index(np.flatnonzero(self.next >= 0))

    def _index(self, at: np.ndarray) -> None:
        """Look up the pairs that begin at some places and index those that merge."""
        ranks = self.merges.ranks_of(self.token[at], self.token[self.next[at]])
        self.rank[at] = ranks
        found = ranks != NONE
        at, ranks = at[found], ranks[found]
        if not len(at):
            return
        order = np.argsort(ranks, kind="stable")
        at, ranks = at[order], ranks[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        begins = [0, *cuts.tolist(), len(at)]
        for rank, i, j in zip(ranks[begins[:-1]].tolist(), begins[:-1], begins[1:]):
            self._add(rank, at[i:j])

    def _add(self, rank: int, at: np.ndarray) -> None:
        if rank in self.places:
            self.places[rank].append(at)
        else:
            self.places[rank] = [at]
            heapq.heappush(self.waiting, rank)

    def _apart(self, at: np.ndarray) -> np.ndarray:
        """From the left on, the places whose pair shares no symbol with one taken before."""
        touch = self.next[at[:-1]] == at[1:]
        if not touch.any():
            return at
        n = np.arange(len(at))
        begin = np.maximum.accumulate(np.where(np.append(True, ~touch), n, 0))
        return at[(n - begin) % 2 == 0]

    def _until_lower(self, rank: int, at: np.ndarray) -> np.ndarray:
        """The places up to the first of each word whose merge makes a pair of a lower rank."""
        made = np.full(len(at), self.merges.made[rank])
        after, left = self.next[self.next[at]], self.before[at]
        merged = np.append(False, left[1:] == self.next[at[:-1]])
        right_rank = np.where(after >= 0, self.merges.ranks_of(made, self.token[after]), NONE)
        left_rank = np.where(left >= 0, self.merges.ranks_of(np.where(merged, made, self.token[left]), made), NONE)
        lower = np.minimum(right_rank, left_rank) < rank
        if not lower.any():
            return at
        word = self.word[at]
        first = np.append(True, word[1:] != word[:-1])
        earlier = np.cumsum(lower) - lower
        keep = earlier == earlier[np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))]
        self._add(rank, at[~keep])
        return at[keep]

    def run(self) -> None:
        while self.waiting:
            rank = heapq.heappop(self.waiting)
            lists = self.places.pop(rank)
            at = lists[0] if len(lists) == 1 else np.concatenate(lists)
            at = at[self.rank[at] == rank]
            if len(at) > 1:
                at = self._apart(np.unique(at))
            if not len(at):
                continue
            if self.merges.unruly[rank]:
                at = self._until_lower(rank, at)
            self._merge(rank, at)

    def _merge(self, rank: int, at: np.ndarray) -> None:
        gone = self.next[at]
        after = self.next[gone]
        self.token[at] = self.merges.made[rank]
        self.next[at] = after
        inner = after >= 0
        self.before[after[inner]] = at[inner]
        self.live[gone] = False
        self.rank[gone] = NONE
        self.rank[at] = NONE
        left = self.before[at]
        touched = np.concatenate([left[left >= 0], at[inner]])
        if len(touched):
            self._index(touched)


def encode_words(merges: Merges, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a column of words one after another, and where those of each word begin (one more than words)."""
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if offsets[-1] else np.zeros(0, np.uint8)
    replay = _Replay(merges, data, offsets - offsets[0])
    replay.run()
    counts = np.bincount(replay.word[replay.live], minlength=len(words))
    return replay.token[replay.live], np.concatenate([[0], np.cumsum(counts)])


def encode_run(merges: Merges, run: Run, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts of a run one after another, and where those of each text begin (one more than texts)."""
    starts = boundaries(run, classes)
    if not len(starts):
        return np.zeros(0, np.int32), np.zeros(run.count + 1, np.int64)
    offsets = np.append(starts, len(run.data)).astype(np.int32)
    words = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(run.data))])
    coded = words.dictionary_encode()
    ids, begins = encode_words(merges, coded.dictionary)
    which = coded.indices.to_numpy()
    ends = np.concatenate([[0], np.cumsum(np.diff(begins)[which])])
    spread = np.repeat(begins[which] - ends[:-1], np.diff(ends)) + np.arange(ends[-1])
    return ids[spread], ends[np.searchsorted(starts, run.offsets)]
