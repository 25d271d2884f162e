"""The registered queries and the pipeline over the sample tables."""

import hashlib
import random
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest
from cases import frame, jaccard_components, prose, raw, repeated_bytes, spans, words

import corpus_pipeline
from vestibule.llm.queries import oracle_sql, queries, tokenizer_path

TABLES = ("documents", "benchmark", "labels", "conversations", "embeddings")


def sample(sf):
    folder = Path(f"/root/testdata/sf{sf}")
    if not folder.exists():
        pytest.skip("sample tables are not here")
    return str(folder)


def connect(folder):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS FROM '{folder}/{table}.parquet'")
    return con


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_oracle(spark, name, sf):
    want = connect(sample(sf)).sql(oracle_sql()[name])
    got = queries()[name](spark, sample(sf)).select(*want.columns)
    assert Counter(map(tuple, got.collect())) == Counter(want.fetchall())


def test_every_operator_has_one_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries())
    assert numbers == list(range(1, 14))


def test_repeated_bytes_of_the_sample(spark):
    folder = sample("0.001")
    rows = connect(folder).sql("SELECT doc_id, text FROM documents").fetchall()
    want = []
    for (doc_id, text), flags in zip(rows, repeated_bytes(rows), strict=True):
        kept = bytes(b for b, f in zip(raw(text), flags) if not f)
        n_spans = sum(f and not p for f, p in zip(flags, [0, *flags]))
        digest = hashlib.sha256(kept).hexdigest()
        want.append((doc_id, len(flags), sum(flags), n_spans, digest, kept.decode("utf-8", "replace")))
    assert sorted(map(tuple, queries()["op10_suffix_dedup"](spark, folder).collect())) == sorted(want)


def test_nearest_vectors_of_the_sample(spark):
    folder = sample("0.01")
    rows = connect(folder).sql("SELECT vec_id, embedding FROM embeddings").fetchall()
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    got = {}
    for row in queries()["op7_cross_polytope"](spark, folder).collect():
        got.setdefault(row.query_id, {})[row.vec_id] = row.score
    hits = total = 0
    for q in ids[ids % 20 == 0].tolist():
        score = vectors @ vectors[ids == q][0]
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != q][:20]
        hits += len(set(ids[order].tolist()) & set(got[q]))
        total += len(order)
        assert len(got[q]) == 20
        assert all(abs(score[ids == v][0] - s) < 1e-12 for v, s in got[q].items())
    assert hits >= 0.9 * total


def test_classifier_separates_held_out_rows(spark):
    folder = sample("0.01")
    quality = dict(connect(folder).sql("SELECT doc_id, quality FROM labels").fetchall())
    right = total = 0
    for row in queries()["op2_quality_pu"](spark, folder).collect():
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0)
        if row.held_out and row.doc_id in quality:
            right += row.predicted == quality[row.doc_id]
            total += 1
    assert right >= 0.9 * total


def test_pipeline_stages_against_brute_force(spark):
    folder = sample("0.001")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, before = docs.columns, None
    benchmark = connect(folder).sql("SELECT text FROM benchmark").fetchall()
    wanted = {tuple(w[k : k + 13]) for (t,) in benchmark for w in [words(t)] for k in range(max(1, len(w) - 12))}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name == "best-fit packing":
            break
        assert out.columns == columns and out.dtypes == docs.dtypes
        rows = sorted(map(tuple, out.collect()))
        if name == "quality classifier":
            scored = queries()["op2_quality_pu"](spark, folder).collect()
            assert {r[0] for r in rows} == {r.doc_id for r in scored if r.predicted}
        if name == "n-gram jaccard join":
            groups = jaccard_components([r[:2] for r in before])
            assert {r[0] for r in rows} == {c for _, _, c in groups}
        if name == "suffix-array dedup":
            cut = repeated_bytes([r[:2] for r in before], corpus_pipeline.PASSAGE_BYTES)
            assert len(rows) == len(before) and sum(map(sum, cut)) > 0
            for old, flags in zip(before, cut, strict=True):  # spans of few words stay
                for start, end in spans(flags):
                    if len(raw(old[1])[start:end].split()) < corpus_pipeline.PASSAGE_WORDS:
                        flags[start:end] = bytes(end - start)
            for row, old, flags in zip(rows, before, cut, strict=True):
                kept = bytes(b for b, f in zip(raw(old[1]), flags) if not f)
                text = raw(row[1])
                assert len(kept) <= len(text) <= len(kept) + 6 * sum(f != p for f, p in zip(flags, flags[1:]))
                assert row[4] == len(row[1])
        if name == "benchmark decontamination":
            kept = {r[0] for r in rows}
            for doc_id, text, *_ in before:
                held, hit = words(text), set()
                for k in range(len(held)):
                    for n in {len(w) for w in wanted}:
                        if tuple(held[k : k + n]) in wanted:
                            hit |= set(range(k, min(k + n, len(held))))
                assert (doc_id in kept) != (bool(hit) and 20 * len(hit) >= len(held))
        docs = spark.createDataFrame(out.collect(), out.schema)
        before = rows
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    total = sum(len(library.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in before)
    pieces = out.collect()
    assert sum(p.length for p in pieces) == total
    assert {p.doc_id for p in pieces} == {r[0] for r in before}
    assert len({p.sequence_id for p in pieces}) <= total / 4096 * 1.02 + 1


def test_pipeline_over_awkward_rows(spark):
    """Nulls, repeated rows and extra columns pass; an empty table gives no rows."""
    folder = sample("0.001")
    good = spark.read.parquet(f"{folder}/documents.parquet").limit(30)
    odd = spark.createDataFrame([(900, None), (901, ""), (None, "some words here"), (900, None)], "doc_id bigint, text string")
    docs = good.unionByName(odd, allowMissingColumns=True).unionByName(good.limit(3))
    for made in (docs.selectExpr("*", "'x' AS raw", "1 AS rid", "'y' AS kept", "2 AS `score`"), docs.limit(0)):
        out = made
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, out, folder)
            assert out.columns == made.columns
        assert corpus_pipeline.STAGES[-1][1](spark, out, folder).columns[0] == "doc_id"
        out.count()


def test_one_row_of_each_near_duplicate_group_stays(spark):
    """Rows are told apart, not ids: no copy is left, and no content goes with the copies."""
    rng = random.Random(4)
    long, other, lone, unnamed = (prose(rng, 120) for _ in range(4))
    rows = [(1, long), (1, long), (5, long), (None, long)]  # repeats, a copy, one without id
    rows += [(7, other), (2, other + " more"), (7, lone), (None, unnamed), (None, unnamed)]
    rows += [(8, None), (9, "")]
    out = corpus_pipeline.near_duplicates(spark, frame(spark, rows), "")
    want = [(1, long), (2, other + " more"), (7, lone), (None, unnamed), (8, None), (9, "")]
    assert Counter((r.doc_id, r.text) for r in out.collect()) == Counter(want)
    assert out.dtypes == frame(spark, rows).dtypes
    cut = corpus_pipeline.repeated_passages(spark, out, "")
    assert Counter((r.doc_id, r.text) for r in cut.collect()) == Counter(want)


def test_decontamination_judges_rows(spark, tmp_path):
    """A hit row without an id goes, and a clean row stays beside a hit one of its id."""
    rng = random.Random(5)
    item, clean, other = (prose(rng, 40) for _ in range(3))
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, item), (None, clean), (1, item), (1, clean), (2, other), (2, other), (3, None)]
    out = corpus_pipeline.decontamination(spark, frame(spark, rows), str(tmp_path))
    want = [(None, clean), (1, clean), (2, other), (2, other), (3, None)]
    assert Counter((r.doc_id, r.text) for r in out.collect()) == Counter(want)


def test_passages_of_over_fifty_words_are_cut(spark):
    """Whatever their bytes, down to words of four letters; shorter ones stay."""
    rng = random.Random(6)
    word = lambda n: "".join(rng.choices("abcdefghijklmnop", k=n))
    passage = lambda n, size: " ".join(word(size) for _ in range(n))
    rows, want = [], {}
    for k, (n, size) in enumerate([(51, 4), (55, 5), (60, 9), (400, 6), (45, 9), (30, 14)]):
        shared = passage(n, size)
        for copy in (10 * k, 10 * k + 1):
            rows.append((copy, f"{passage(30, 6)} {shared} {passage(30, 6)}"))
            want[copy] = n > 50
    rows += [(100 + k, passage(200, 6)) for k in range(5)]
    out = corpus_pipeline.repeated_passages(spark, frame(spark, rows), "").collect()
    was = dict(rows)
    for row in out:
        words_gone = len(was[row.doc_id].split()) - len(row.text.split())
        assert words_gone > 45 if want.get(row.doc_id) else words_gone == 0, row.doc_id
