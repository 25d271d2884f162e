"""Alignment of two vocabularies, against the libraries and all overlaps of whole texts."""

import hashlib
import random
from collections import Counter, defaultdict

import duckdb
import pytest
from cases import documents, frame
from test_queries import sample
from tokenizers import Tokenizer

from vestibule.llm import alignment
from vestibule.llm.pieces import SPACE, piece_model
from vestibule.llm.queries import BYTE_VOCABULARY, PIECE_VOCABULARY, queries, tokenizer_path

PATHS = (tokenizer_path(BYTE_VOCABULARY), tokenizer_path(PIECE_VOCABULARY))


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATHS[0])
    tokenizer.encode_special_tokens = True
    return tokenizer


def char_bytes():
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in kept]
    return {chr(b): b for b in kept} | {chr(256 + k): b for k, b in enumerate(rest)}


def tokens(library, text):
    """Both sides' ids with the bytes of each token."""
    table, pieces = char_bytes(), piece_model(PATHS[1]).library
    a = library.encode(" " + text, add_special_tokens=False).ids
    a = [(i, bytes(table[c] for c in library.id_to_token(i))) for i in a]
    b = []
    for i in pieces.encode(text):
        name = pieces.id_to_piece(i)
        b.append((i, bytes([int(name[1:-1], 16)]) if pieces.is_byte(i) else name.replace(SPACE, " ").encode()))
    return a, b


def spans(side):
    out, at = [], 0
    for i, raw in side:
        out.append((at, at + len(raw), i))
        at += len(raw)
    return out


def expected(library, rows):
    """Per row doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and the groups."""
    found, held = [], Counter()
    for doc_id, text in rows:
        sides = tokens(library, text) if text else ([], [])
        if any(b"".join(raw for _, raw in side) != f" {text}".encode() for side in sides):
            sides = ([], [])
        a, b = map(spans, sides)
        both = sorted({end for _, end, _ in a} & {end for _, end, _ in b})
        groups, start = [], 0
        for end in both:
            groups.append(
                "|".join(
                    ",".join(str(i) for s, e, i in side if start <= s and e <= end) for side in (a, b)
                )
            )
            start = end
        links, first = [], 0
        for s, e, i in a:
            while first < len(b) and b[first][1] <= s:
                first += 1
            for t, f, j in b[first:]:
                if t >= e:
                    break
                links.append((i, j))
        held.update(set(links))
        found.append((doc_id, len(a), len(b), len(groups), links, ";".join(groups)))
    most = defaultdict(int)
    for (i, _), n in held.items():
        most[i] = max(most[i], n)
    return [
        (d, a, b, g, len(links), sum(held[p] == most[p[0]] for p in links), sum(held[p] for p in links), t)
        for d, a, b, g, links, t in found
    ]


def odd_rows():
    """Texts where the two sides disagree for long, special strings, and lossy ones."""
    rng = random.Random(11)
    parts = ["é", "中文", "<|endoftext|>", "<s>", "aaaa", "  ", "\n\n", "\t", "'s", "12", "ing", "😀", " x"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(1, 25))) for _ in range(40)]
    texts += [f"a{SPACE}b", SPACE, "Ａ" * 60, "中" * 300, "a" * 500, "<unk> <0x41>", "x" * 30 + " y" * 200]
    return list(enumerate(texts, 5000))


@pytest.mark.parametrize("chunk", [7, 64, 1 << 16])
def test_alignment_equals_all_overlaps(spark, library, chunk, monkeypatch):
    monkeypatch.setattr(alignment, "FAN_IN", 2)
    rows = [(i, t) for i, t in documents(3) if len(t or "") < 900] + odd_rows()
    rows += [(None, "no id one"), (None, "no id two"), rows[-1]]
    if chunk < 50:  # the smallest chunks are for the odd texts
        rows = rows[-60:]
    got = alignment.align_tokens(frame(spark, rows), *PATHS, chunk=chunk)
    got = [tuple(r) for r in alignment.alignment_digests(got).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(got, key=key) == sorted(digested_all(expected(library, rows)), key=key)


def digested_all(rows):
    return [
        (*row[:-1], hashlib.sha256(row[-1].encode()).hexdigest() if row[-1] else "") for row in rows
    ]


def test_batches_in_many_salts_count_alike(spark, library, monkeypatch):
    monkeypatch.setattr(alignment, "SALT_BATCHES", 1)
    monkeypatch.setattr(alignment, "BATCH_BYTES", 300)
    rows = [(i, t) for i, t in documents(4) if len(t or "") < 600]
    aligned = alignment.align_tokens(frame(spark, rows), *PATHS, chunk=500)
    got = sorted(map(tuple, alignment.alignment_digests(aligned).collect()))
    assert got == sorted(digested_all(expected(library, rows)))


def test_long_text_and_long_word(spark, library):
    rng = random.Random(12)
    texts = ["".join(rng.choices("abcdefgh é\n.", k=400_000)), "é" * 120_000, "z" * 200_000]
    aligned = alignment.align_tokens(frame(spark, list(enumerate(texts))), *PATHS)
    got = {r.doc_id: r for r in alignment.alignment_digests(aligned).collect()}
    for doc_id, text in enumerate(texts):
        a, b = tokens(library, text)
        ends = {e for _, e, _ in spans(a)} & {e for _, e, _ in spans(b)}
        row = got[doc_id]
        assert (row.n_a, row.n_b, row.n_groups) == (len(a), len(b), len(ends))
        assert row.n_links == len(a) + len(b) - len(ends)


def test_empty_table(spark):
    empty = alignment.align_tokens(frame(spark, []), *PATHS)
    assert alignment.alignment_digests(empty).count() == 0


def test_composing_is_associative():
    """Any way to bracket the chunks of a text gives the same open ends and closed runs."""
    sizes = alignment.sides(*PATHS).sizes
    models = alignment.sides(*PATHS)
    text = " " + "ab中é  cd, ef's 12\n" * 30
    cuts = [
        [0] + [alignment._cut(m, s, k) for k in range(9, len(text), 9)] + [len(text)]
        for m, s in ((models.a, text), (models.b, text.replace(" ", SPACE)))
    ]
    leaves = []
    for k in range(len(cuts[0]) - 1):
        starts = tuple(len(text[: c[k]].encode()) for c in cuts)
        gap = alignment.Gap(starts, models.encode(*(text[c[k] : c[k + 1]] for c in cuts)))
        leaves.append(alignment.Fragment.of(gap, sizes))

    def reduced(order):
        parts = [(found, [run] if run else []) for found, run in leaves]
        while len(parts) > 1:
            k = order(len(parts) - 1)
            found, run = parts[k][0].then(parts[k + 1][0], sizes)
            parts[k : k + 2] = [(found, parts[k][1] + ([run] if run else []) + parts[k + 1][1])]
        found, runs = parts[0]
        closed = sorted((r.starts[0], r.ids[0].tolist(), r.ids[1].tolist()) for r in runs if len(r.ids[0]))
        ids = [sum((r[side] for r in closed), []) for side in (1, 2)]
        return ids, found.left.ids[0].tolist(), found.right.ids[1].tolist()

    rng = random.Random(13)
    whole = reduced(lambda n: 0)
    assert whole[1:] == ([], [])
    assert whole[0] == [ids.tolist() for ids in models.encode(text, text)]
    for _ in range(10):
        assert reduced(rng.randrange) == whole


def test_the_query_over_the_sample(spark, library):
    folder = sample("0.001")
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet'").fetchall()
    got = sorted(map(tuple, queries()["op11_token_alignment"](spark, folder).collect()))
    assert got == sorted(digested_all(expected(library, rows)))
