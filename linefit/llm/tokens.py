"""Token ids of whole texts, by the ``tokenizers`` library.

White space never lies inside a token of the vocabulary used here, so a text's ids are those of
its words, one after the other. Each process keeps the ids of words it has met. New words of
plain Latin letters, digits and signs are merged many at a time in numpy by the tokenizer
file's own merge table; the library encodes all others, and texts for which Python and the
library disagree about white space as a whole.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from linefit.llm.common import once_per_process

DEFAULT = "word_bpe_49k.json"
#: Words kept in a process (twice as many at most), and the longest of them.
KEPT_WORDS, KEPT_LENGTH = 200_000, 64
#: Characters that only Python takes as white space.
_DOUBTFUL = re.compile("[\x1c-\x1f]")
_BEYOND_LATIN = re.compile("[^\x00-\xff]")


def tokenizer_path(name: str) -> str:
    """The file on this machine: a path, or a name in the installed ``public_tokenizers``."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def load_tokenizer(name: str):
    from tokenizers import Tokenizer

    def load():
        tokenizer = Tokenizer.from_file(tokenizer_path(name))
        tokenizer.no_padding()
        tokenizer.no_truncation()
        return tokenizer

    return once_per_process("tokens", ("tokenizer", name), load)


class MergeTable:
    """BPE over many words at once, for words that need no normalising but lower case.

    ``ids_of`` takes words of the characters in ``SIMPLE``. They hold no apostrophe and no bar,
    so their parts are runs of letters, single digits and runs of other signs.
    """

    SIMPLE = re.compile("[!-&(-{}~À-ÖØ-öø-ÿ]+")
    #: What a tokenizer file must say for this to apply.
    RULES = {
        "normalizer": ["NFC", "Replace", "Lowercase"], "pre_tokenizer": ["Split", "ByteLevel"],
    }
    SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    NONE = np.iinfo(np.int32).max

    @classmethod
    def of(cls, path: str) -> MergeTable | None:
        with open(path, encoding="utf-8") as f:
            found = json.load(f)
        model, (normal, pre) = found["model"], (found.get(k) or {} for k in cls.RULES)
        kinds = {
            "normalizer": [x["type"] for x in normal.get("normalizers", [])],
            "pre_tokenizer": [x["type"] for x in pre.get("pretokenizers", [])],
        }
        plain = (
            kinds == cls.RULES and pre["pretokenizers"][0]["pattern"].get("Regex") == cls.SPLIT
            and model["type"] == "BPE" and model.get("end_of_word_suffix") == "</w>"
            and not model.get("dropout") and not model.get("ignore_merges")
            and all("|" in t["content"] for t in found["added_tokens"])
        )
        return cls(model) if plain else None

    def __init__(self, model: dict):
        vocabulary = model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        # the usual printable stand-ins of bytes
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = {b: chr(b) for b in shown}
        letters |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in letters)}
        self.inner = np.array([vocabulary[letters[b]] for b in range(256)], np.int32)
        self.last = np.array([vocabulary[letters[b] + "</w>"] for b in range(256)], np.int32)
        self.merged = np.array([vocabulary[a + b] for a, b in pairs], np.int32)
        keys = np.array([vocabulary[a] << 32 | vocabulary[b] for a, b in pairs], np.int64)
        # an open table: where a key's place is taken, the next ones are tried
        self.bits = 19
        self.keys, self.ranks = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, self.NONE, np.int32)
        waiting = np.arange(len(keys))[::-1]  # of equal keys the last rank stays, as in the library
        waiting = waiting[np.unique(keys[waiting], return_index=True)[1]]
        at, self.tries = self._place(keys[waiting]), 0
        while len(waiting):
            self.tries += 1
            free = np.flatnonzero(self.keys[at] < 0)
            free = free[np.unique(at[free], return_index=True)[1]]
            self.keys[at[free]], self.ranks[at[free]] = keys[waiting[free]], waiting[free]
            rest = np.ones(len(waiting), bool)
            rest[free] = False
            waiting, at = waiting[rest], (at[rest] + 1) & ((1 << self.bits) - 1)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 32 | right
        at = self._place(keys)
        found = np.where(self.keys[at] == keys, self.ranks[at], self.NONE)
        open_ = np.flatnonzero((found == self.NONE) & (self.keys[at] >= 0))
        for _ in range(self.tries):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            hit = self.keys[at[open_]] == keys[open_]
            found[open_[hit]] = self.ranks[at[open_[hit]]]
            open_ = open_[~hit & (self.keys[at[open_]] >= 0)]
        return found

    def ids_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and for each word where its own end."""
        data = np.frombuffer("\n".join(words).lower().encode() + b"\n", np.uint8)
        letter = (data >= 128) | ((data >= 97) & (data <= 122))
        digit = (data >= 48) & (data <= 57)
        kind = np.where(letter, 1, np.where(digit, 2, np.where(data == 10, 0, 3)))
        begins = (kind != np.append(0, kind[:-1])) | (kind == 2)
        used = kind > 0
        word = np.cumsum(~used)[used]
        part = np.cumsum(begins[used], dtype=np.int32)
        data = data[used]
        last = np.append(part[1:] != part[:-1], True)
        symbols = np.where(last, self.last[data], self.inner[data])
        done_ids, done_at = [], []
        place = np.arange(len(symbols), dtype=np.int32)  # of a symbol's first byte
        rank = np.full(len(symbols), self.NONE, np.int32)
        inside = np.flatnonzero(~last)
        rank[inside] = self._rank(symbols[inside], symbols[inside + 1])
        while len(symbols):
            starts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
            least = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, len(part)))
            least = np.repeat(least, sizes)
            active = least < self.NONE
            if not active.all():
                done_ids.append(symbols[~active])
                done_at.append(place[~active])
                symbols, place, part, rank, least = (x[active] for x in (symbols, place, part, rank, least))
                if not len(symbols):
                    break
            merge = rank == least
            twice = merge[1:] & merge[:-1]  # such as the two pairs of "aaa": every second one waits
            if twice.any():
                for i in np.flatnonzero(twice) + 1:
                    merge[i] = merge[i] and not merge[i - 1]
            at = np.flatnonzero(merge)
            symbols[at] = self.merged[rank[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            where = np.cumsum(keep) - 1
            symbols, place, part, rank = (x[keep] for x in (symbols, place, part, rank))
            at = where[at]
            changed = np.zeros(len(symbols), bool)
            changed[at] = True
            changed[at[at > 0] - 1] = True
            near = np.flatnonzero(changed)
            joined = near[np.append(part[1:] == part[:-1], False)[near]]
            rank[near] = self.NONE
            rank[joined] = self._rank(symbols[joined], symbols[joined + 1])
        ids, at = np.concatenate(done_ids), np.concatenate(done_at)
        order = np.argsort(at)
        return ids[order], np.searchsorted(word[at[order]], np.arange(len(words)), side="right")


class WordEncoder:
    """Ids of texts as little-endian bytes of ``dtype``."""

    def __init__(self, name: str, kept: int = KEPT_WORDS):
        self.library, self.kept = load_tokenizer(name), kept
        self.dtype = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # those that are met again move to the known ones
        self.table = MergeTable.of(tokenizer_path(name))

    def whole(self, text: str) -> bytes:
        ids = self.library.encode(text, add_special_tokens=False).ids
        return np.array(ids, self.dtype).tobytes()

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        if not self.table:
            return self._by_library(words)
        simple = MergeTable.SIMPLE.fullmatch
        plain, other = [], []
        for word in words:
            (plain if simple(word) else other).append(word)
        # a comma or stop after a letter is a part of its own, and often the rest is known
        ended = [w for w in plain if w[-1] in ",." and w[-2:-1].isalpha()]
        known, cores = self.known, {w[:-1] for w in ended}
        bare = list({*(w for w in plain if w[-1] not in ",." or not w[-2:-1].isalpha()),
                     *(w for w in cores if w not in known), ",", "."})
        found = dict(zip(bare, self._cut(*self.table.ids_of(bare))))
        for word in ended:
            core = word[:-1]
            found[word] = (found.get(core) or known[core]) + found[word[-1]]
        for mark in {",", "."}.difference(plain):
            del found[mark]
        found.update(self._by_library(other))
        return found

    def _by_library(self, words: list[str]) -> dict[str, bytes]:
        found = {}
        for start in range(0, len(words), 20_000):
            part = words[start : start + 20_000]
            encoding = self.library.encode(part, is_pretokenized=True, add_special_tokens=False)
            ends = np.searchsorted(np.array(encoding.word_ids), np.arange(len(part)), side="right")
            found.update(zip(part, self._cut(np.array(encoding.ids), ends)))
        return found

    def _cut(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        data, stops = ids.astype(self.dtype).tobytes(), (ends * self.dtype.itemsize).tolist()
        return [data[a:b] for a, b in zip([0, *stops], stops)]

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """In the order of ``texts``; about two million characters are taken together."""
        group, size = [], 0
        for text in texts:
            group.append(text)
            size += len(text)
            if size > 2_000_000:
                yield from self._group(group)
                group, size = [], 0
        yield from self._group(group)

    def _group(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > self.kept:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        # Arrow's white space is Python's; what lies before or after all words comes as an empty one
        whole = [bool(_DOUBTFUL.search(text)) for text in texts]
        # lower case is what the library makes of it later, and fewer words are new;
        # but special tokens are sought in the text as it is
        split = pc.utf8_split_whitespace(pa.array([
            "" if doubtful else text if "<|" in text or _BEYOND_LATIN.search(text) else text.lower()
            for text, doubtful in zip(texts, whole)
        ], pa.string()))
        ends = split.offsets.to_numpy()[1:]
        coded = split.values.dictionary_encode()
        which = coded.indices.to_numpy()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        parts = list(map(known.get, distinct))
        new = [i for i, part in enumerate(parts) if part is None]
        known.update((w, older[w]) for i in new if (w := distinct[i]) in older)
        found = self._learn([w for i in new if (w := distinct[i]) not in known])
        known.update(found)
        for i in new:
            parts[i] = known[distinct[i]]
        for word in found:
            if len(word) > KEPT_LENGTH:
                del known[word]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // self.dtype.itemsize
        first = np.cumsum(sizes) - sizes
        many = sizes[which]
        stops = np.append(0, np.cumsum(many))
        ids = np.frombuffer(b"".join(parts), self.dtype)
        ids = ids[np.repeat(first[which] - stops[:-1], many) + np.arange(stops[-1])]
        out, start = [], 0
        for text, doubtful, stop in zip(texts, whole, stops[ends].tolist()):
            out.append(self.whole(text) if doubtful else ids[start:stop].tobytes())
            start = stop
        return out


def word_encoder(name: str, kept: int = KEPT_WORDS) -> WordEncoder:
    return once_per_process("tokens", ("words", name, kept), lambda: WordEncoder(name, kept))
