"""Pre-tokens and BPE of a public tokenizer file with lower-cased words and word ends.

``PreTokens`` cuts texts as the file's own normalizer and pre-tokenizer do.  Texts
of plain characters take a regular expression; any other text, and any that holds
a special string, goes through the library's components, so that Unicode rules are
the library's.  Both ways give pre-tokens as strings; special strings come apart.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import lru_cache
from heapq import heappop, heappush
from itertools import chain

import numpy as np

# characters on which the library's normalizer does nothing but lower-case and fold white space
_PLAIN = re.compile("[\t-\r -~À-ÖØ-öø-ÿ]*")
_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")
# the split rule as the file states it; other files are refused
_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


_SPACE = re.compile("[ \t-\r]")


def windows(text: str, size: int = 1 << 20) -> list[str]:
    """A long text cut at white space, which no pre-token, special string or composed character spans."""
    out, start = [], 0
    while len(text) - start > size:
        found = _SPACE.search(text, start + size)
        if not found:
            break
        out.append(text[start : found.start()])
        start = found.start()
    return [*out, text[start:]]


def tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=1)
def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary: itself if printable, else the next free one from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + rest.index(b)) for b in range(256)]


class PreTokens:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self.spec = json.load(f)
        rules = [x.get("pattern", {}).get("Regex") for x in self.spec["pre_tokenizer"]["pretokenizers"]]
        if _RULE not in rules or self.spec["model"]["end_of_word_suffix"] != "</w>":
            raise ValueError(f"{path} cuts words by other rules")
        self.library = tokenizer(path)
        self.special = {t["content"]: t["id"] for t in self.spec["added_tokens"]}
        self._special = re.compile("|".join(map(re.escape, self.special)))
        self._bytes = {c: b for b, c in enumerate(byte_letters())}

    def plain(self, text: str) -> bool:
        return _PLAIN.fullmatch(text) is not None and self._special.search(text) is None

    def words(self, text: str) -> list[str]:
        """Pre-tokens of a plain text."""
        return _WORDS.findall(text.lower())

    def parts(self, text: str) -> tuple[list[bytes], int]:
        """Pre-tokens of any text as bytes, and the number of special strings in it."""
        pieces = self._special.split(text)
        out = []
        for piece in pieces:
            if piece:
                for shown, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(piece)):
                    out.append(bytes(self._bytes[c] for c in shown))
        return out, len(pieces) - 1


class Encoder:
    """Ids of whole texts as the library gives them, without added special tokens.

    In a plain text, what stands between white space is encoded by itself, once as long
    as it is remembered.  It is cut into pre-tokens here, and these go through the
    library's model in long lines, so that its normalizer, which would change nothing,
    is not run for each.  Any other text goes through the library as it is.
    """

    REMEMBERED, LINE = 500_000, 2000

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer, pre_tokenizers

        self.remembered = remembered
        self.pre = PreTokens(path)
        self.model = Tokenizer(self.pre.library.model)
        steps = [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        self.model.pre_tokenizer = pre_tokenizers.Sequence(steps)
        vocab = self.pre.spec["model"]["vocab"]
        self.ends_word = np.zeros(max(vocab.values()) + 1, bool)
        self.ends_word[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        del self.pre.spec
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.starts = array("I"), array("q", [0])

    def _learn(self, chunks: list[str]) -> None:
        """Store the ids of plain lower-case chunks: each pre-token ends with the one id that ends a word."""
        for k in range(0, len(chunks), self.LINE):
            some = chunks[k : k + self.LINE]
            words = [_WORDS.findall(c) for c in some]
            line = [" ".join(chain.from_iterable(words))]
            ids = np.array(self.model.encode_batch_fast(line, add_special_tokens=False)[0].ids, np.uint32)
            ends = np.concatenate(([0], np.flatnonzero(self.ends_word[ids]) + 1))
            stops = ends[np.cumsum([len(w) for w in words])] + len(self.ids)
            self.known.update(zip(some, range(len(self.starts) - 1, len(self.starts) - 1 + len(some)), strict=True))
            self.ids.frombytes(ids.tobytes())
            self.starts.frombytes(stops.astype(np.int64).tobytes())

    def _store(self, text: str) -> int:
        """Store the ids of any text, under no name."""
        self.ids.extend(self.pre.library.encode(text, add_special_tokens=False).ids)
        self.starts.append(len(self.ids))
        return len(self.starts) - 2

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and where each text starts (one more entry at the end)."""
        if len(self.starts) > self.remembered:
            self._forget()
        cut: list[list[str] | str] = []
        owner = []
        for k, text in enumerate(texts):
            for part in windows(text):
                cut.append(part.lower().split() if self.pre.plain(part) else part)
                owner.append(k)
        self._learn(list(set().union(*(c for c in cut if isinstance(c, list))) - self.known.keys()))
        places = [[*map(self.known.__getitem__, c)] if isinstance(c, list) else [self._store(c)] for c in cut]
        at = np.fromiter(chain.from_iterable(places), np.int64)
        starts = np.frombuffer(self.starts, np.int64)
        sizes = starts[at + 1] - starts[at]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        ids = np.frombuffer(self.ids, np.uint32) if len(self.ids) else np.zeros(0, np.uint32)
        flat = ids[np.repeat(starts[at] - ends[:-1], sizes) + np.arange(ends[-1])]
        del starts, ids  # an array that is looked at cannot grow
        words = np.zeros(len(texts), np.int64)
        np.add.at(words, np.array(owner, np.int64), [len(p) for p in places])
        return flat, ends[np.concatenate(([0], np.cumsum(words)))]


@lru_cache(maxsize=1)
def encoder(path: str, remembered: int = Encoder.REMEMBERED) -> Encoder:
    """The encoder of a worker, which keeps what it has learned from task to task."""
    return Encoder(path, remembered)


class RankedMerges:
    """Byte-pair merging of many pre-tokens at once, in ragged numpy arrays.

    In each round every sequence applies its own lowest-rank pair at all places,
    left to right; sequences without a pair that has a rank are done.  Beyond
    ``LONG`` symbols a sequence is worked on by itself: its places wait by rank, and a
    round touches only those of the lowest rank and their neighbours.
    """

    LONG = 1024

    def __init__(self, spec: dict):
        vocab = spec["model"]["vocab"]
        letters = byte_letters()
        self.inside = np.array([vocab[c] for c in letters], np.int64)
        self.end = np.array([vocab[c + "</w>"] for c in letters], np.int64)
        self.width = max(vocab.values()) + 1
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] * self.width + vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order, made[order]
        self.none = len(pairs)

    def counts(self, tokens: list[bytes]) -> np.ndarray:
        """Number of symbols that survive in each pre-token."""
        long = [k for k, t in enumerate(tokens) if len(t) > self.LONG]
        if long:
            out = np.zeros(len(tokens), np.int64)
            out[long] = [self.long_count(tokens[k]) for k in long]
            rest = [k for k, t in enumerate(tokens) if len(t) <= self.LONG]
            out[rest] = self.counts([tokens[k] for k in rest])
            return out
        sizes = np.array([len(t) for t in tokens], np.int64)
        left = sizes.copy()
        raw = np.frombuffer(b"".join(tokens), np.uint8)
        symbols = self.inside[raw]
        ends = np.cumsum(sizes)
        last = ends[sizes > 0] - 1
        symbols[last] = self.end[raw[last]]
        owner = np.repeat(np.arange(len(tokens)), sizes)
        while len(symbols) > 1:
            joined = owner[1:] == owner[:-1]
            key = symbols[:-1] * self.width + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = joined & (self.keys[at] == key)
            rank = np.where(known, self.ranks[at], self.none)
            first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            group = np.cumsum(np.concatenate(([True], owner[1:] != owner[:-1]))) - 1
            lowest = np.minimum.reduceat(np.concatenate((rank, [self.none])), first)
            hit = known & (rank == lowest[group[:-1]])
            if not hit.any():
                break
            # overlapping places are runs of one repeated symbol: every second one is taken
            place = np.arange(len(hit))
            opens = hit & ~np.concatenate(([False], hit[:-1]))
            began = np.maximum.accumulate(np.where(opens, place, 0))
            hit &= (place - began) % 2 == 0
            left -= np.bincount(owner[:-1][hit], minlength=len(left))
            symbols[:-1][hit] = self.made[at[hit]]
            keep = np.concatenate(([True], ~hit))
            busy = (lowest < self.none)[group]  # the others are done
            keep &= busy
            symbols, owner = symbols[keep], owner[keep]
        return left

    def found(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair of symbols (``none``: no merge), and what it makes."""
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], self.none), self.made[at]

    def long_count(self, token: bytes) -> int:
        """Number of symbols that survive in one long sequence: work in proportion to its merges, not its rounds."""
        raw = np.frombuffer(token, np.uint8)
        n = len(raw)
        symbols = self.inside[raw]
        symbols[-1] = self.end[raw[-1]]
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)  # n and -1: none
        rank, made = np.full(n, self.none), np.zeros(n, np.int64)
        rank[:-1], made[:-1] = self.found(symbols[:-1], symbols[1:])
        waiting: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def wait(places: np.ndarray) -> None:
            places = places[rank[places] < self.none]
            order = np.argsort(rank[places], kind="stable")
            places = places[order]
            own = rank[places]
            cuts = np.flatnonzero(np.diff(own)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(places)], strict=True):
                if b > a:
                    r = int(own[a])
                    if r not in waiting:
                        waiting[r] = []
                        heappush(queue, r)
                    waiting[r].append(places[a:b])

        wait(np.arange(n))
        left = n
        while queue:
            r = heappop(queue)
            places = np.unique(np.concatenate(waiting.pop(r)))
            places = places[rank[places] == r]
            if not len(places):
                continue
            # overlapping places are runs of one repeated symbol: every second one is taken
            follows = np.concatenate(([False], after[places[:-1]] == places[1:]))
            at = np.arange(len(places))
            began = np.maximum.accumulate(np.where(follows, 0, at))
            places = places[(at - began) % 2 == 0]
            gone = after[places]
            symbols[places] = made[places]
            rank[gone] = self.none
            after[places] = after[gone]
            inner = after[places] < n
            before[after[places][inner]] = places[inner]
            left -= len(places)
            # pairs that changed: each merged symbol with the next one, and the one before it with it
            changed = np.unique(np.concatenate((places, before[places][before[places] >= 0])))
            last = after[changed] >= n
            rank[changed[last]] = self.none
            changed = changed[~last]
            rank[changed], made[changed] = self.found(symbols[changed], symbols[after[changed]])
            wait(changed)
        return left
