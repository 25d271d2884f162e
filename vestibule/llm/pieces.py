"""Encoding and decoding by a merge-type piece vocabulary of the sentencepiece library.

A text starts as one symbol per character, each space written as U+2581 and one more
in front. Every two neighbours that together are a piece wait in an agenda, ordered
by the score of that piece and then from left to right; the best pair is joined, the
pairs with its new neighbours enter the agenda, and pairs that a join has overtaken
are passed over when they come up. A character without a piece becomes its bytes.

Pieces of such a vocabulary have U+2581, and as a rule all punctuation, in front only
(this is read off the vocabulary), so nothing joins across the start of a word: each
word has an agenda of its own. A worker remembers the ids of short words, and of words
with the punctuation behind them up to the next space; words that are new to it are
joined together, one pair per word at a time, in arrays. The library is asked for the ids
of every run between spaces that a worker meets for the first time, with each batch.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import cache, cached_property
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vestibule.llm.shared import byte_slices, map_arrow, record, utf8

# The sign for a space, and what the library writes for the unknown id
# and for a byte that belongs to no character.
SPACE = "▁"
UNKNOWN = " ⁇ "
NO_CHARACTER = "�"
# Runs and words that a worker remembers before it starts afresh, and their longest.
REMEMBERED = 600_000
LONGEST = 48
# Words whose symbols are joined at a time, and the rank of a pair that makes no piece.
TOGETHER = 1 << 14
NEVER = np.int64(1 << 40)
# Bytes of text whose words are held at a time, and characters of the table of pairs.
WORDS_OF = 1 << 20
FIRST = 1 << 9


def join_symbols(word: str, order: dict[str, int]) -> list[str]:
    """The symbols of ``word`` when no two neighbours make a piece any more.

    ``order`` ranks the pieces, the first to be made lowest. A symbol is known by where
    it starts; the agenda holds rank, start and length of what two neighbours would make,
    as one integer.
    """
    n, rank_of, push = len(word), order.get, heappush
    width = max(20, n.bit_length())
    high, low = 2 * width, (1 << width) - 1
    length, before = [1] * n, list(range(-1, n))
    length.append(-n)  # nothing follows the last symbol
    agenda = [
        rank << high | start << width | 2
        for start in range(n - 1)
        if (rank := rank_of(word[start : start + 2])) is not None
    ]
    heapify(agenda)
    while agenda:
        entry = heappop(agenda)
        start, size = entry >> width & low, entry & low
        first = length[start]
        middle = start + first
        if not first or first + length[middle] != size:
            continue  # one of the two has been joined otherwise since
        length[start], length[middle] = size, 0
        end, left = start + size, before[start]
        if left >= 0 and (rank := rank_of(word[left:end])) is not None:
            push(agenda, rank << high | left << width | end - left)
        if end < n:
            before[end] = start
            size += length[end]
            if (rank := rank_of(word[start : start + size])) is not None:
                push(agenda, rank << high | start << width | size)
    return [word[start : start + size] for start, size in enumerate(length) if size > 0]


def word_patterns(pieces: Iterable[str]) -> tuple[re.Pattern, re.Pattern]:
    """One finds words that no piece reaches across, the other places between such words.

    A word is a run of letters and digits with the other characters in front of it;
    control characters that only ever are pieces by themselves are words of their own.
    Letters and digits that some piece has before another character count as such.
    """
    pairs = {piece[k : k + 2] for piece in pieces for k in range(len(piece) - 1)}
    inner = {c for c in set().union(*pieces) if re.match(r"[^\W_]", c)}
    while wrong := {a for a, b in pairs if a in inner and b not in inner}:
        inner -= wrong
    if any(a != SPACE == b for a, b in pairs):
        raise ValueError("not a vocabulary of pieces within words")
    odd = "_" + "".join(c for c in set().union(*pieces) - inner if re.match(r"[^\W_]", c))
    alone = {chr(c) for c in range(0x20)}.difference(*pairs)
    odd, lone = (re.escape("".join(sorted(chars))) for chars in (odd, alone))
    front = f"(?:[^\\w{lone}]|[{odd}])"
    inner = f"[^\\W{odd}]"
    words = re.compile(f"{front}*{inner}+|{front}+|[{lone}]")
    return words, re.compile(f"(?<={inner})(?!{inner})|(?<=[{lone}])|(?=[{lone}])")


class _Packed(dict):
    """The id of a symbol, or the ids of its bytes, as packed integers."""

    def __init__(self, ids: dict[str, int], byte_ids: list[int]):
        super().__init__((piece, np.int32(i).tobytes()) for piece, i in ids.items())
        self.byte_ids = byte_ids

    def __missing__(self, symbol: str) -> bytes:
        return np.array([self.byte_ids[b] for b in symbol.encode()], np.int32).tobytes()


class Agendas:
    """``join_symbols`` for many short words at once.

    All agendas are one array with the rank of every two neighbours. In each round every
    word joins its best pair, the leftmost of equal ones, and the ranks beside it are
    looked up again; words without a pair leave.
    """

    def __init__(self, ids: dict[str, int], order: dict[str, int]):
        symbols = dict(ids)
        self.of_char = np.full(0x110000, -1, np.int32)
        for char in sorted(set().union(*ids)):
            self.of_char[ord(char)] = symbols.setdefault(char, 1 << 24 | ord(char))
        made = [
            (symbols[piece[:k]], symbols[piece[k:]], order[piece], ids[piece])
            for piece in ids
            for k in range(1, len(piece))
            if piece[:k] in symbols and piece[k:] in symbols
        ]
        left, right, rank, joined = np.array(made, np.int64).reshape(-1, 4).T
        pairs = left << 32 | right
        by_pair = np.argsort(pairs)
        # One more pair that is never asked for, so that every search ends inside.
        self.pairs = np.append(pairs[by_pair], np.iinfo(np.int64).max)
        self.rank = np.append(rank[by_pair], NEVER)
        self.joined = np.append(joined[by_pair], -1)
        # The pairs of characters below FIRST, and of U+2581, once more as a table.
        self.place = np.full(0x110000, -1, np.int16)
        self.place[1:FIRST] = np.arange(1, FIRST)
        self.place[ord(SPACE)] = 0
        symbol = self.of_char[np.append(ord(SPACE), np.arange(1, FIRST))].astype(np.int64)
        found = self._rank(np.repeat(symbol, FIRST), np.tile(symbol, FIRST))
        self.first_rank, self.first_joined = found

    def _rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        pair = left << 32 | right
        at = np.searchsorted(self.pairs, pair)
        return np.where(self.pairs[at] == pair, self.rank[at], NEVER), self.joined[at]

    def join(self, words: list[str]) -> list[bytes | None]:
        """The packed ids of each word; none for a word with a character without a piece."""
        chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        symbol = self.of_char[chars].astype(np.int64)
        size = np.fromiter(map(len, words), np.int64, len(words))
        word = np.repeat(np.arange(len(words)), size)
        rank, joined = np.full(len(symbol), NEVER), np.full(len(symbol), -1)
        place = self.place[chars].astype(np.int64)
        inside = word[1:] == word[:-1]
        fast = inside & (place[1:] >= 0) & (place[:-1] >= 0)
        at = np.flatnonzero(fast)
        pair = place[at] * FIRST + place[at + 1]
        rank[at], joined[at] = self.first_rank[pair], self.first_joined[pair]
        at = np.flatnonzero(inside & ~fast)
        rank[at], joined[at] = self._rank(symbol[at], symbol[at + 1])
        done_words, done_symbols = [], []
        while len(word):
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            best = np.minimum.reduceat(rank, first)
            counts = np.diff(np.append(first, len(word)))
            if (best == NEVER).any():
                ended = np.repeat(best == NEVER, counts)
                done_words.append(word[ended])
                done_symbols.append(symbol[ended])
                word, symbol, rank, joined = (x[~ended] for x in (word, symbol, rank, joined))
                best, counts = best[best != NEVER], counts[best != NEVER]
                if not len(word):
                    break
            at = np.flatnonzero(rank == np.repeat(best, counts))
            at = at[np.append(True, word[at[1:]] != word[at[:-1]])]
            symbol[at] = joined[at]
            stay = np.ones(len(word), bool)
            stay[at + 1] = False
            at -= np.arange(len(at))  # one symbol has gone before each
            word, symbol, rank, joined = (x[stay] for x in (word, symbol, rank, joined))
            beside = np.concatenate([at - 1, at])
            beside = beside[(beside >= 0) & (beside < len(word) - 1)]
            rank[at] = NEVER
            rank[at[at > 0] - 1] = NEVER
            beside = beside[word[beside] == word[beside + 1]]
            rank[beside], joined[beside] = self._rank(symbol[beside], symbol[beside + 1])
        none = np.empty(0, np.int64)
        word, symbol = (np.concatenate([none, *x]) for x in (done_words, done_symbols))
        symbol = symbol[np.argsort(word, kind="stable")]
        first = np.concatenate([[0], np.cumsum(np.bincount(word, minlength=len(words)))])
        odd = np.concatenate([[0], np.cumsum((symbol < 0) | (symbol >> 24 > 0))])
        known = (np.diff(odd[first]) == 0).tolist()
        packed, first = symbol.astype(np.int32).tobytes(), (4 * first).tolist()
        return [
            packed[s:e] if whole else None
            for s, e, whole in zip(first[:-1], first[1:], known, strict=True)
        ]


# A word is remembered with the punctuation behind it, as far as the next space.
RUNS = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


class PieceModel(dict):
    """A vocabulary file; as a dict, the ids of runs met before, as packed integers.

    A run goes up to the next space; its words have a dict of their own.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        model, n = self.library, self.library.get_piece_size()
        kinds = [(model.is_control(i), model.is_unknown(i), model.is_byte(i)) for i in range(n)]
        names = [model.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not any(kinds[i])]
        self.ids = {names[i]: i for i in plain}
        scores = sorted({-model.get_score(i) for i in plain})
        place = {score: rank for rank, score in enumerate(scores)}
        self.order = {names[i]: place[-model.get_score(i)] for i in plain}
        self.word, self.cut = word_patterns(self.ids)
        self.words: dict[str, bytes] = {}
        self.wrong: set[str] = set()
        byte = {int(names[i][1:-1], 16): i for i in range(n) if kinds[i][2]}
        if len(byte) < 256:
            raise ValueError("not a vocabulary with a piece for every byte")
        self.packed = _Packed(self.ids, [byte[b] for b in range(256)])
        # What an id stands for: text, or one byte to be joined with those beside it.
        self.is_byte = np.array([kind[2] for kind in kinds])
        self.texts = [
            "" if control else UNKNOWN if unknown else name.replace(SPACE, " ")
            for name, (control, unknown, _) in zip(names, kinds, strict=True)
        ]
        self.raws = [text.encode() for text in self.texts]
        for value, i in byte.items():
            self.raws[i] = bytes([value])
        for i, (control, _, _) in enumerate(kinds):
            if control:  # ends a run of bytes without a text of its own: never whole UTF-8
                self.raws[i] = b"\xff"

    @cached_property
    def agendas(self) -> Agendas:
        """Made when first needed: who only reads single words has no use for it."""
        return Agendas(self.ids, self.order)

    def __missing__(self, run: str) -> bytes:
        """The ids of a run that is too long to be remembered, word by word."""
        words = self.word.findall(run)
        packed = b"".join([self.words.get(word) or self._join(word) for word in words])
        self._check([run], [packed])
        return packed

    def _join(self, word: str) -> bytes:
        """A word that is too long to be remembered, or has a character without a piece."""
        return b"".join(map(self.packed.__getitem__, join_symbols(word, self.order)))

    def _check(self, runs: list[str], packed: list[bytes]) -> None:
        """Ask the library for the ids of runs, and note those that it has others for.

        It puts a space in front by itself, so a run is handed over without its first.
        """
        at = [k for k, run in enumerate(runs) if run[0] == SPACE and len(run) > 1]
        texts = [runs[k][1:].replace(SPACE, " ") for k in at]
        for k, ids in zip(at, self.library.encode(texts, num_threads=1), strict=True):
            if np.array(ids, np.int32).tobytes() != packed[k]:
                self.wrong.add(runs[k])

    def _learn(self, runs: set[str]) -> None:
        """Remember the short ones of ``runs`` and their words; start afresh from time to time."""
        if len(self) > REMEMBERED or len(self.words) > REMEMBERED:
            self.clear()
            self.words.clear()
        new = [run for run in runs - self.keys() if len(run) <= LONGEST]
        found = [self.word.findall(run) for run in new]
        known = self.words
        words = list(set().union(*found) - known.keys())
        for at in range(0, len(words), TOGETHER):
            part = words[at : at + TOGETHER]
            for word, packed in zip(part, self.agendas.join(part), strict=True):
                known[word] = self._join(word) if packed is None else packed
        packed = [
            known[own[0]] if len(own) == 1 else b"".join([known[word] for word in own])
            for own in found
        ]
        self._check(new, packed)
        self.update(zip(new, packed, strict=True))

    def agrees(self, text: str) -> bool:
        """Whether the library has the same ids for every run of ``text``."""
        shown = SPACE + text.replace(" ", SPACE)
        return not self.wrong or self.wrong.isdisjoint(RUNS.findall(shown))

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text; an empty one has none."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of every text."""
        return self.encode_as_is([SPACE + t.replace(" ", SPACE) if t else "" for t in texts])

    def encode_as_is(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of texts, or of parts of texts, with their spaces written as U+2581."""
        runs = [RUNS.findall(text) for text in texts]
        self._learn(set().union(*runs))
        return [np.frombuffer(b"".join(map(self.__getitem__, r)), np.int32) for r in runs]

    def decode(self, ids: np.ndarray) -> str:
        """The text of any ids; the space in front of the first word goes.

        Bytes side by side make characters; one that belongs to none is U+FFFD.
        """
        raw = b"".join(map(self.raws.__getitem__, ids.tolist()))
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            text = self._decode_loose(ids)
        # Only a piece of text, not a control id or a byte, can bring the space that goes.
        shown = np.flatnonzero([self.is_byte[i] or bool(self.texts[i]) for i in ids[:64].tolist()])
        if not len(shown) and len(ids) > 64:
            return self.decode(ids[64:])
        first = ids[shown[0]] if len(shown) else None
        bare = first is None or self.is_byte[first] or self.texts[first] == UNKNOWN
        return text if bare else text.removeprefix(" ")

    def _decode_loose(self, ids: np.ndarray) -> str:
        out, run = [], bytearray()
        for i in [*ids.tolist(), None]:
            if i is not None and self.is_byte[i]:
                run += self.raws[i]
                continue
            out.append(loose_utf8(bytes(run)))
            run.clear()
            out.append("" if i is None else self.texts[i])
        return "".join(out)


def loose_utf8(raw: bytes) -> str:
    """Bytes as text; each byte that is not part of a whole character becomes U+FFFD."""
    out, at = [], 0
    while at < len(raw):
        for size in (1, 2, 3, 4):
            try:
                out.append(raw[at : at + size].decode())
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append(NO_CHARACTER)
            at += 1
    return "".join(out)


@cache
def piece_model(path: str) -> PieceModel:
    """One model per file and worker process."""
    return PieceModel(path)


_ENCODED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("ids", pa.list_(pa.int32())),
        ("decoded", pa.string()),
        ("agrees", pa.bool_()),
    ]
)


def encode_pieces(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """``(doc_id, ids, decoded, agrees)`` per row of ``docs``.

    ``ids`` are those of the whole text without begin or end ids, ``decoded`` what they
    read back as. ``agrees`` says whether the sentencepiece library has the same ids for
    every run between spaces, asked when a worker first meets it, and reads the ids of
    the whole text back alike; the columns before it are the agenda's own either way.
    Null and empty texts have no ids and read back empty. Repeated rows stay, ties of
    score go to the left, an empty table gives no rows, other columns are not read. Texts
    go to Python a megabyte at a time and a longer one by itself; the agenda of a word of
    ``n`` characters holds at most ``3n`` pairs.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = piece_model(model)
        for rows in byte_slices(batches, "raw", WORDS_OF):
            texts = [raw.decode("utf-8", "replace") for raw in rows["raw"]]
            ids = pieces.encode_all(texts)
            decoded = [pieces.decode(i) for i in ids]
            read_back = pieces.library.decode([i.tolist() for i in ids], num_threads=1)
            agrees = [
                pieces.agrees(text) and own == theirs
                for text, own, theirs in zip(texts, decoded, read_back, strict=True)
            ]
            first = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            flat = np.concatenate([np.empty(0, np.int32), *ids])
            lists = pa.ListArray.from_arrays(pa.array(first), pa.array(flat))
            yield record(
                _ENCODED, doc_id=rows["doc_id"], ids=lists, decoded=decoded, agrees=agrees
            )

    doc_id = F.col("doc_id").cast("bigint")
    return map_arrow(docs.select(doc_id, utf8(F.col(text)).alias("raw")), encode, _ENCODED)
