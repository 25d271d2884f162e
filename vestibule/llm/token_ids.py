"""Token ids of whole texts by a public tokenizer, each distinct piece encoded once.

White space ends every token of the vocabularies used here, and so does the step
from an ASCII letter to ASCII punctuation or a digit. Texts are cut there, equal
pieces are found by a hash and compared byte by byte, and the tokenizers library
encodes each new piece once per worker; the ids of a text are those of its pieces in
order.
"""

from __future__ import annotations

import os
from functools import cache
from itertools import chain

import numpy as np

from vestibule.llm.words import SPACE, same_spans, span_hashes

# Pieces that a worker remembers before it forgets those that came once only, how
# many new ones it collects before they join the others, and how many are encoded at
# a time.
REMEMBERED = 700_000
RECENT = 100_000
ENCODED = 8192
# Words that are encoded as one text, and the fixed sign of the vocabulary for a word's end.
WORDS = 256
WORD_END = "</w>"
# Rows and bytes of text encoded at a time.
ENCODE_ROWS = 1024
BLOCK = 1 << 20

_LETTER, _CUT, _OTHER = 1, 2, 0
_CLASS = np.zeros(256, np.uint8)
_CLASS[0x61:0x7B] = _LETTER
_CLASS[0x41:0x5B] = _LETTER
_CLASS[0x21:0x41] = _CUT  # ASCII punctuation and digits
_CLASS[0x5B:0x61] = _CUT
_CLASS[0x7B:0x7F] = _CUT
_CLASS[ord("'")] = _OTHER  # may begin a contraction
_BLANKS = bytes.maketrans(b"\t\n\r", b"   ")


class _Memory:
    """Pieces and their ids by the hash of the piece, in sorted arrays."""

    def __init__(self):
        self.keys = np.empty(0, np.uint64)
        self.again = np.empty(0, bool)
        self.begin, self.length, self.ids = _nothing(np.uint32)
        self.at, self.size, self.raw = _nothing(np.uint8)

    def find(self, keys, block, starts, size) -> tuple[np.ndarray, np.ndarray]:
        """Where each piece's key stands or would stand, and whether the piece is there."""
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        held = np.flatnonzero(known)
        same = self.size[at[held]] == size[held]
        known[held[~same]] = False
        held = held[same]
        known[held] = same_spans(block, starts[held], self.raw, self.at[at[held]], size[held])
        return at, known

    def add(self, other: _Memory) -> None:
        """Take in the pieces of another; of two with the same key the older stays."""
        at = np.searchsorted(self.keys, other.keys)
        inside = at < len(self.keys)
        new = np.ones(len(at), bool)
        new[inside] = self.keys[at[inside]] != other.keys[inside]
        at = at[new]
        self.keys = np.insert(self.keys, at, other.keys[new])
        self.again = np.insert(self.again, at, other.again[new])
        self.begin = np.insert(self.begin, at, other.begin[new] + len(self.ids))
        self.length = np.insert(self.length, at, other.length[new])
        self.ids = np.concatenate([self.ids, other.ids])
        self.at = np.insert(self.at, at, other.at[new] + len(self.raw))
        self.size = np.insert(self.size, at, other.size[new])
        self.raw = np.concatenate([self.raw, other.raw])

    def drop(self, kept: np.ndarray) -> None:
        """Only the pieces ``kept`` stay listed; their bytes and ids stay where they are."""
        for name in ("keys", "again", "begin", "length", "at", "size"):
            setattr(self, name, getattr(self, name)[kept])

    def keep(self, kept: np.ndarray) -> None:
        self.ids = self.ids[_ranges(self.begin[kept], self.length[kept])]
        self.raw = self.raw[_ranges(self.at[kept], self.size[kept])]
        self.keys, self.length, self.size = self.keys[kept], self.length[kept], self.size[kept]
        self.begin, self.at = _starts(self.length), _starts(self.size)
        self.again = np.zeros(len(self.keys), bool)


def _starts(size: np.ndarray) -> np.ndarray:
    """Where each of some things begins that follow each other."""
    return (np.cumsum(size) - size).astype(np.int32)


def _nothing(kind) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.empty(0, np.int32), np.empty(0, np.int32), np.empty(0, kind)


def _ranges(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """All positions of the ranges, one after another."""
    end = np.cumsum(length)
    return np.repeat(begin - end + length, length) + np.arange(end[-1] if len(end) else 0)


class Encoder:
    """Ids of texts by one tokenizer file of the ``tokenizers`` library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.memory, self.recent = _Memory(), _Memory()

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each text's ids begin (one entry more than texts)."""
        ids, counts, at = [], [], 0
        while at < len(texts):
            size, end = 0, at
            while end < len(texts) and (end == at or size + len(texts[end]) <= BLOCK):
                size += len(texts[end])
                end += 1
            found, n = self._encode_block(texts[at:end])
            ids.append(found)
            counts.append(n)
            at = end
        first = np.zeros(len(texts) + 1, np.int64)
        if counts:
            np.cumsum(np.concatenate(counts), out=first[1:])
        return np.concatenate(ids) if ids else np.empty(0, np.uint32), first

    def _encode_block(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        joined = b" " + b" ".join(texts).translate(_BLANKS) + b" "
        if b"<|" not in joined:  # special strings keep their case
            joined = joined.lower()
        block = np.frombuffer(joined, np.uint8)
        filled = block != SPACE
        kind = _CLASS[block]
        cut = (kind[:-1] == _LETTER) & (kind[1:] == _CUT)
        starts = np.flatnonzero(filled[1:] & (~filled[:-1] | cut)) + 1
        ends = np.flatnonzero(filled[:-1] & (~filled[1:] | cut)) + 1
        if b"<|" in joined:  # a piece with a special string stays whole
            starts, ends = _join_special(joined, starts, ends)
        keys, place, inverse = np.unique(
            span_hashes(block, starts, ends), return_index=True, return_inverse=True
        )
        size = ends - starts
        same = size == size[place][inverse]
        at = np.flatnonzero(same)
        same[at] = same_spans(block, starts[at], block, starts[place][inverse[at]], size[at])
        if not same.all():  # two pieces in one hash: each one for itself
            apart = np.flatnonzero(~same)
            keys = np.append(keys, np.zeros(len(apart), np.uint64))
            inverse[apart] = np.arange(len(place), len(keys))
            place = np.append(place, apart)
        by_hash = len(keys) - np.count_nonzero(~same)
        begin, length, ids = self._look_up(joined, block, keys, by_hash, starts[place], ends[place])
        begin, length = begin[inverse], length[inverse]
        total = np.zeros(len(inverse) + 1, np.int64)
        np.cumsum(length, out=total[1:])
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        bounds = np.concatenate([[1], np.cumsum(sizes + 1) + 1])
        return ids[_ranges(begin, length)], np.diff(total[np.searchsorted(starts, bounds)])

    def _look_up(self, joined: bytes, block, keys, by_hash: int, starts, ends):
        """Begin and length of each piece's ids, and the ids; new pieces are encoded first.

        The first ``by_hash`` pieces have ascending keys; the others share a key with one
        of them, or with a remembered piece, and are not remembered.
        """
        if len(self.recent.keys) > RECENT:
            self.memory.add(self.recent)
            self.recent = _Memory()
            if len(self.memory.keys) > REMEMBERED:
                again = self.memory.again
                few = again.sum() <= REMEMBERED // 2
                self.memory.keep(again if few else np.zeros(len(again), bool))
        size = ends - starts
        old, in_old = self.memory.find(keys, block, starts, size)
        place, in_recent = self.recent.find(keys, block, starts, size)
        in_old[by_hash:] = in_recent[by_hash:] = False
        in_recent &= ~in_old
        self.memory.again[old[in_old]] = True
        self.recent.again[place[in_recent]] = True
        new = np.flatnonzero(~in_old & ~in_recent)
        found = self._encoded(joined, block, keys[new], starts[new], ends[new])
        # The ids of recent pieces follow those of the others, those of new ones come last.
        begin, length = np.empty(len(keys), np.int64), np.empty(len(keys), np.int64)
        used = place[in_recent]
        for where, memory, at, base in (
            (in_old, self.memory, old[in_old], 0),
            (in_recent, self.recent, used, len(self.memory.ids)),
            (new, found, np.arange(len(new)), len(self.memory.ids) + len(self.recent.ids)),
        ):
            begin[where], length[where] = memory.begin[at] + base, memory.length[at]
        ids = _Joined(self.memory.ids, self.recent.ids, found.ids)
        # What shares its key with another piece of the block or of the memory is passed over.
        found.drop(np.flatnonzero(new < by_hash))
        self.recent.add(found)
        return begin, length, ids

    def _encoded(self, joined: bytes, block, keys, starts, ends) -> _Memory:
        """The pieces with their ids, in the order given."""
        pieces = [
            joined[s:e].decode("utf-8", "replace")
            for s, e in zip(starts.tolist(), ends.tolist(), strict=True)
        ]
        letters = np.fromiter(map(str.isalpha, pieces), bool, len(pieces))
        length, ids = np.empty(len(pieces), np.int32), [np.empty(0, np.uint32)]
        begin, held = np.empty(len(pieces), np.int32), 0
        for which, encode in ((letters, self._words), (~letters, self._apart)):
            every = np.flatnonzero(which)
            for k in range(0, len(every), ENCODED):
                at = every[k : k + ENCODED]
                found, length[at] = encode([pieces[i] for i in at.tolist()])
                begin[at] = _starts(length[at]) + held
                held += len(found)
                ids.append(found)
        out = _Memory()
        out.keys, out.size = keys, (ends - starts).astype(np.int32)
        out.at = _starts(out.size)
        out.raw = block[_ranges(starts, ends - starts)]
        out.length, out.begin = length, begin
        out.again = np.zeros(len(keys), bool)
        out.ids = np.concatenate(ids)
        return out

    def _apart(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces one after another, and how many each has."""
        encoded = self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
        encoded = [e.ids for e in encoded]
        length = np.fromiter(map(len, encoded), np.int64, len(encoded))
        return np.fromiter(chain.from_iterable(encoded), np.uint32, int(length.sum())), length

    def _words(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for pieces of letters only: each is a word, whose last id alone ends one.

        So many are encoded as one text. Where its words are not as many as the pieces, as
        when lower case adds a sign to a letter, those pieces are encoded apart.
        """
        parts = [pieces[at : at + WORDS] for at in range(0, len(pieces), WORDS)]
        texts = [" ".join(part) for part in parts]
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ids, lengths = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
        for part, found in zip(parts, encoded, strict=True):
            own = np.array(found.ids, np.uint32)
            last = np.flatnonzero(self.ends_word[own])
            length = np.diff(last, prepend=-1)
            if len(last) != len(part) or last[-1] != len(own) - 1:
                own, length = self._apart(part)
            ids.append(own)
            lengths.append(length)
        return np.concatenate(ids), np.concatenate(lengths)


class _Joined:
    """Some arrays read as one."""

    def __init__(self, *arrays: np.ndarray):
        self.arrays = arrays

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        out, begin = np.empty(len(at), np.uint32), 0
        for array in self.arrays:
            own = np.flatnonzero((at >= begin) & (at < begin + len(array)))
            out[own] = array[at[own] - begin]
            begin += len(array)
        return out


def _join_special(joined: bytes, starts: np.ndarray, ends: np.ndarray):
    """Undo the cuts inside every run between blanks that holds ``<|``."""
    gap = np.ones(len(starts), bool)
    gap[1:] = starts[1:] > ends[:-1]
    run = np.cumsum(gap) - 1
    special = set()
    at = joined.find(b"<|")
    while at >= 0:
        special.add(int(run[np.searchsorted(starts, at, "right") - 1]))
        at = joined.find(b"<|", at + 2)
    inner = np.isin(run, list(special)) & ~gap
    return starts[~inner], ends[np.append(~inner[1:], True)]


@cache
def encoder(path: str) -> Encoder:
    """One encoder per file and worker process."""
    return Encoder(path)
