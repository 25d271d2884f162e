"""Small inputs with awkward rows, and plain counterparts of what the operators do."""

import random
import re
from collections import defaultdict

ALNUM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLANK = re.compile(rb"[^\x20\x09-\x0D]+")
VOCABULARY = [f"w{i}" for i in range(400)]


def raw(text):
    return (text or "").encode()


def thue_morse(length):
    """Two different strings of a and b with one polynomial hash modulo 2 ** 64."""
    swap = str.maketrans("ab", "ba")
    first = "a"
    while len(first) < length:
        first += first.translate(swap)
    return first[:length], first[:length].translate(swap)


def words(text, pattern=ALNUM):
    return pattern.findall(raw(text).lower())


def prose(rng, n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


def edited(rng, text, edits):
    """``text`` with some words replaced."""
    out = text.split()
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"x{rng.randrange(10**6)}"
    return " ".join(out)


def documents(seed=1):
    """``(doc_id, text)``: nulls, empties, copies, near copies, shared passages, a long text."""
    rng = random.Random(seed)
    passage = prose(rng, 90)
    texts = [None, "", "   ", "one", "Two words", "é ü", "\x00 a\x7fb   c", "a" * 1500]
    texts += [prose(rng, rng.randrange(1, 120)) for _ in range(20)]
    base = prose(rng, 100)
    texts += [base] * 5 + [base.upper(), base.replace(" ", "\n")]
    texts += [edited(rng, base, rng.randrange(1, 6)) for _ in range(25)]
    for length in (30, 60, 150, 400):
        again = prose(rng, length)
        texts += [edited(rng, again, rng.randrange(0, 1 + length // 25)) for _ in range(6)]
    texts += [f"{prose(rng, 40)} {passage} {prose(rng, 40)}" for _ in range(8)]
    texts += [(prose(rng, 8) + "\n") * 30, prose(rng, 6000)]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    return rows + [rows[0], rows[-1]]  # two rows stand twice


def frame(spark, rows, partitions=3):
    """``documents`` with extra columns whose names the operators use themselves."""
    clashing = ("raw", "row", "rid", "batch", "bucket", "node", "score", "kept", "n_words", "key")
    schema = "doc_id bigint, text string, " + ", ".join(f"`{c}` string" for c in clashing)
    made = spark.createDataFrame([(i, t, *["extra"] * len(clashing)) for i, t in rows], schema)
    return made.repartition(partitions)


def shingles(text, size=5):
    found = words(text, BLANK)
    if len(found) < size:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + size]) for i in range(len(found) - size + 1)}


def jaccard_components(rows, percent=80):
    """``{(doc_id, n_shingles, component_id)}`` by comparing all pairs."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (_, x) in enumerate(sets):
        for b in range(a):
            y = sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                parent[root(a)] = root(b)
    smallest = defaultdict(list)
    for a, (i, _) in enumerate(sets):
        smallest[root(a)].append(i)
    return sorted((i, len(s), min(smallest[root(a)])) for a, (i, s) in enumerate(sets))


def repeated_bytes(rows, length=400):
    """Per row a flag for every byte that a repeated string of ``length`` bytes covers."""
    places = defaultdict(int)
    for _, text in rows:
        data = raw(text)
        for k in range(len(data) - length + 1):
            places[data[k : k + length]] += 1
    out = []
    for _, text in rows:
        data, end = raw(text), 0
        flags = bytearray(len(data))
        for k in range(len(data) - length + 1):
            if places[data[k : k + length]] > 1:
                flags[max(k, end) : k + length] = b"\1" * (k + length - max(k, end))
                end = k + length
        out.append(flags)
    return out


def spans(flags):
    return [(m.start(), m.end()) for m in re.finditer(b"\1+", bytes(flags))]
