import random

import numpy as np
import pytest
from cases import documents, frame, prose, raw, repeated_bytes, spans, thue_morse

from vestibule.llm import packed
from vestibule.llm import suffix_dedup as sd
from vestibule.llm.shared import ddl
from vestibule.llm.words import mix


def check(spark, rows, length=400, gram=64):
    got = sd.repeated_spans(frame(spark, rows), length=length, gram=gram).collect()
    found = sorted(
        (r.row.doc_id, r.n_bytes, r.n_removed, [tuple(s) for s in r.spans], bytes(r.kept)) for r in got
    )
    want = []
    for (doc_id, text), flags in zip(rows, repeated_bytes(rows, length), strict=True):
        kept = bytes(b for b, f in zip(raw(text), flags) if not f)
        want.append((doc_id, len(flags), sum(flags), spans(flags), kept))
    assert found == sorted(want)
    return want


def test_against_every_string(spark):
    rows = documents(3)
    passage = "é" * 3 + prose(random.Random(9), 80)
    rows += [(500 + i, f"{i} ü{passage}ü {i}") for i in range(4)]
    assert sum(w[2] for w in check(spark, rows)) > 1000


@pytest.mark.parametrize("seed", range(2))
def test_short_strings(spark, seed):
    """Strings of 12 bytes over few letters: all kinds of overlaps."""
    rng = random.Random(seed)
    letters = "ab" if seed else "abcé"
    rows = [(i, "".join(rng.choices(letters, k=rng.choice((0, 5, 11, 12, 30, 190, 900))))) for i in range(12)]
    rows += [(50, None), (51, "ab" * 300), (52, "q" * 700)]
    check(spark, rows, length=12, gram=5)


def test_long_texts_go_in_pieces(monkeypatch):
    monkeypatch.setattr(sd, "PIECE", 200)
    rng = random.Random(7)
    raws = ["".join(rng.choices("ab", k=n)).encode() for n in (0, 30, 950, 3, 150, 201, 12)]
    batch = sd.Batch(raws, 12, 5)
    runs = list(batch.anchors())
    values = np.unique(np.concatenate([v for v, *_ in runs]))
    starts, keys = batch.suffixes(values)
    want = [b + k for b, r in zip(batch.begins, raws, strict=True) for k in range(len(r) - 11)]
    assert starts.tolist() == want
    of_string = {}
    for start, key in zip(starts.tolist(), keys.tolist(), strict=True):
        text = batch.block[start : start + 12].tobytes()
        assert of_string.setdefault(text, key) == key


def test_length_bounds(spark):
    once = "".join(chr(0x4E00 + i) for i in range(500))
    exact = prose(random.Random(1), 200)[:400]
    rows = [(0, once), (1, f"A{exact}B"), (2, f"C{exact}D"), (3, exact[:399]), (4, "")]
    got = check(spark, rows)
    assert [w[2] for w in got] == [0, 400, 400, 0, 0]
    assert check(spark, []) == []


def test_whole_characters(spark):
    body = "é" * 250
    rows = [(0, f"a{body}b"), (1, f"c{body}d"), (2, None)]
    got = sd.repeated_spans(frame(spark, rows), length=401, gram=64, characters=True).collect()
    kept = {r.row.doc_id: bytes(r.kept).decode() for r in got}
    assert kept == {0: "ab", 1: "cd", 2: ""}
    assert sd.whole_characters("aéb".encode(), [(1, 2)]) == []
    assert sd.whole_characters("aéb".encode(), [(2, 4)]) == [(3, 4)]


@pytest.mark.parametrize("seed", range(4))
def test_merge_sort_orders_suffixes(seed):
    rng = np.random.default_rng(seed)
    block = rng.integers(97, 97 + 1 + seed, 900).astype(np.uint8)
    most = 40
    starts = rng.permutation(len(block) - most)
    h = sd._Hashes(sd.prefix_hashes(block), sd.prefix_hashes(block, sd.PRIME), starts)
    whole = h.whole(starts, most)
    keys = np.array([block[s] for s in starts], np.uint64) % np.uint64(2)
    order = sd.merge_sort(block, h, whole, keys, most)
    text = block.tobytes()
    want = sorted(range(len(starts)), key=lambda i: (keys[i], text[starts[i] : starts[i] + most], i))
    assert order.tolist() == want


def test_common_extension_and_long_prefix_hashes(monkeypatch):
    monkeypatch.setattr(sd, "PIECE", 64)
    rng = np.random.default_rng(1)
    block = rng.integers(97, 99, 500).astype(np.uint8)
    h = sd.prefix_hashes(block)
    a, b = rng.integers(0, 400, (2, 300))
    got = sd.common_extension(h, a, b, 60)
    for x, y, n in zip(a, b, got, strict=True):
        most = next((k for k in range(60) if block[x + k] != block[y + k]), 60)
        assert n == most


@pytest.mark.parametrize("batches", [1, 24])
def test_strings_made_to_collide_are_kept_apart(spark, batches, monkeypatch):
    """The words of Thue and Morse have one hash modulo 2 ** 64, whatever the base."""
    monkeypatch.setattr(packed, "LEAST", batches)
    first, second = thue_morse(2048)
    rows = [(0, first), (1, second), (2, first[:1500]), (3, "x" + second[5:1400]), (4, first[:1023])]
    rows += [(5, f"{thue_morse(1024)[0]}.")]
    check(spark, rows, length=1024)
    check(spark, [(0, first[:1024]), (1, second[:1024])], length=1024)


def test_suffixes_that_agree_in_both_hashes_are_sorted_as_they_are(monkeypatch):
    batch = sd.Batch([b"abab" * 3 + b"cdcd" * 3 + b"abab"], 4, 2)
    starts = np.arange(0, 25, dtype=np.int64)
    keys = np.zeros(len(starts), np.uint64)
    same = np.zeros(len(starts), np.uint64)
    order, equal = batch._verified(np.arange(len(starts)), starts, same, keys)
    found = [batch.block[s : s + 4].tobytes() for s in starts[order]]
    assert found == sorted(found)
    assert equal.tolist() == [k > 0 and found[k] == found[k - 1] for k in range(len(found))]
    assert sorted(order.tolist()) == starts.tolist()


def test_prime_hash_of_spans():
    rng = np.random.default_rng(3)
    block = rng.integers(0, 256, 3000).astype(np.uint8)
    block[2000:] = block[500:1500]
    h = sd.prefix_hashes(block, sd.PRIME)
    a = rng.integers(500, 1300, 200)
    n = rng.integers(1, 200, 200)
    assert (sd.PRIME.span(h, a, n) == sd.PRIME.span(h, a + 1500, n)).all()
    assert (sd.PRIME.span(h, a, n) < sd.PRIME.modulus).all()
    base, value = int(sd.PRIME.power[1]), 0
    for b in block[:50].tolist():
        value = (value * base + int(sd.PRIME.bytes[b])) % sd.PRIME.modulus
    assert sd.PRIME.span(h, np.array([0]), np.array([50])).tolist() == [value]


def test_values_that_differ_in_the_check_count_apart(spark):
    asked = [packed.requests(b, np.array([7, 9], np.uint64), np.array([1, 1]), 1, np.array([c, 5])) for b, c in ((0, 1), (1, 1), (2, 4))]
    rows = spark.createDataFrame([r for t in asked for r in t.to_pylist()], ddl(packed.REQUEST))
    got = packed.totals(rows, lambda values, total: bytes(total.astype(np.uint8))).collect()
    assert {r.batch: list(r.answer) for r in got} == {0: [2, 3], 1: [2, 3], 2: [1, 3]}


def test_sliding_min():
    rng = np.random.default_rng(0)
    for n in (1, 5, 17, 100):
        values = mix(rng.integers(0, 50, n, dtype=np.uint64))
        for width in (1, 2, 7, 17, 100, 101):
            want = [values[i : i + width].min() for i in range(n - width + 1)]
            assert sd.sliding_min(values, width).tolist() == want


def test_rows_without_an_id_and_spans_of_few_words(spark):
    """Without ids rows are told apart by their texts; ``words`` leaves spans of fewer words."""
    rng = random.Random(5)
    few, many = "".join(rng.choices("abcdefgh", k=300)), " ".join(rng.choices("abcd", k=150))
    rows = [(None, f"{k} {few} {k * 7}") for k in range(20)]
    rows += [(None, f"{k} {many} {k * 7}") for k in range(20)] + [(None, None), (None, many)]
    for words, left in ((0, 21), (20, 21 - 20)):
        got = sd.repeated_spans(frame(spark, rows), length=200, characters=True, words=words).collect()
        assert len(got) == len(rows)
        gone = sorted(r.n_removed for r in got if r.n_removed)
        assert len(gone) == 20 + left and gone[0] >= 299
