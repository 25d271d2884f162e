import random

import pytest
from cases import ALNUM, frame, raw, words

from vestibule.llm import license_scan as ls

LICENSE_TEXTS = [
    "Released under the MIT License.",
    "Licensed under CC-BY 4.0; see the Apache License and the apache   license",
    "This work is licensed under the GNU General Public License, version 3.",
    "gnu general public licence; GNU GENERAL PUBLIC LICENSE",
    "cc by cc by mit apache license mit license",
    "Permission is hereby granted, FREE of charge, to any person obtaining a copy of this software "
    "and associated documentation files, to deal in the Software with restriction and without "
    "limitation the rights to use, copy, modify, merge, publish, distribute",
]
TEXTS = [None, "", "  ", "mitlicense", "é mit license é", *LICENSE_TEXTS]


def base_places(text):
    found, labels = [], set()
    held = words(text)
    for phrase, label in ls.BASE_PHRASES.items():
        parts = phrase.encode().split()
        for i in range(len(held) - len(parts) + 1):
            if held[i : i + len(parts)] == parts:
                found.append(i)
                labels.add(label)
    return found, ",".join(sorted(labels))


def longest_ending(held, templates):
    """Matching statistics by trying every length."""
    out = []
    for end in range(1, len(held) + 1):
        best = 0
        for start in range(end):
            run = held[start:end]
            if any(
                run == t[i : i + len(run)] for t in templates for i in range(len(t) - len(run) + 1)
            ):
                best = len(run)
                break
        out.append(best)
    return out


def test_base_columns_follow_the_contract(spark):
    rows = list(enumerate(TEXTS)) * 2  # repeated rows
    got = ls.scan_licenses(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    for row in got:
        text = TEXTS[row.doc_id]
        places, labels = base_places(text)
        assert row.n_words == len(words(text))
        assert row.n_base == len(places)
        assert (row.first_word, row.last_word) == (min(places, default=None), max(places, default=None))
        assert row.base_labels == labels
        assert set(filter(None, labels.split(","))) <= set(row.labels.split(","))
        assert 0 <= row.score <= 1


def test_template_spans(spark):
    rows = [(0, LICENSE_TEXTS[0]), (1, LICENSE_TEXTS[5]), (2, LICENSE_TEXTS[2]), (3, "the software")]
    got = {r.doc_id: r for r in ls.scan_licenses(frame(spark, rows)).collect()}
    assert got[0].labels == "mit,mit-release" and got[0].score == 1.0
    assert got[1].labels == "mit-notice" and got[1].base_labels == ""
    assert 0.6 <= got[1].score < 1
    (span,) = [s for s in got[1].spans if s.label == "mit-notice"]
    assert span.start == 0 and span.end == len(words(LICENSE_TEXTS[5]))
    assert got[2].labels == "gpl,gpl-3.0"
    assert got[3].labels == "" and got[3].score == 0.0 and got[3].spans == []


def test_empty_table(spark):
    assert ls.scan_licenses(frame(spark, [])).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_matching_statistics(seed):
    rng = random.Random(seed)
    letters = "abc"
    templates = {f"t{k}": " ".join(rng.choices(letters, k=9)) for k in range(3)}
    auto = ls.LicenseAutomaton(templates, {"a b": "ab", "c": "c"})
    held = [w.encode() for w in rng.choices(letters + "z", k=80)]
    held_templates = [t.encode().split() for t in (*templates.values(), "a b", "c")]
    scan, lengths = ls.Scan(auto), []
    for word in held:
        scan.feed([word])
        lengths.append(scan.length if word in auto.vocabulary else 0)
    assert lengths == longest_ending(held, held_templates)
    found = [i for i in range(len(held) - 1) if held[i : i + 2] == [b"a", b"b"]]
    found += [i for i, w in enumerate(held) if w == b"c"]
    assert sorted(scan.base) == sorted(found)


def test_blocks_split_no_word():
    rng = random.Random(3)
    text = "".join(rng.choices("ab -éZ", k=5000)).encode()
    whole = ALNUM.findall(text.lower())
    for size in (1, 2, 7, 64, 10**6):
        assert [w for block in ls.word_blocks(text, size) for w in block] == whole
    assert list(ls.word_blocks(raw("x" * 50), 8)) == [[b"x" * 50]]
