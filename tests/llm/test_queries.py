"""Registered queries against plain versions, round trips and held-out labels, over whole tables (LLM_SF_DIR)."""

from __future__ import annotations

import hashlib
import os
import zlib
from collections import defaultdict

import numpy as np
import pytest
from llm import plain

from cadence.llm import licenses, queries
from compare import connect, duck_rows, spark_rows

SF_DIR = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def docs(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]


def rows(spark, name):
    return queries.QUERIES[name](spark, SF_DIR).collect()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracles(spark, name):
    names, got = spark_rows(queries.QUERIES[name](spark, SF_DIR))
    expected, want = duck_rows(connect(SF_DIR), queries.ORACLES[name])
    assert names == expected and got == want


def test_op1(spark, docs):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows(spark, "op1_jaccard")}
    assert got == plain.components(docs, 3, 90)


def test_op3(spark, docs):
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows(spark, "op3_repeats")}
    assert got == plain.without_repeats(docs)


def test_op4(spark, docs):
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in rows(spark, "op4_exact")}
    assert got == plain.equal_texts(docs)


def _labels(spark, name):
    return {r["doc_id"]: r[name] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}


@pytest.mark.parametrize("name,label,least", [("op5_quality", "quality", 0.75), ("op6_toxicity", "toxic", 0.9)])
def test_held_out(spark, name, label, least):
    got = rows(spark, name)
    want = _labels(spark, label)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert all(0 <= r["score"] <= 1 for r in got)
    pairs = [(r["predicted"], want[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in want]
    assert sum(a == b for a, b in pairs) >= least * len(pairs)


def test_op7(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = defaultdict(list)
    bins = defaultdict(list)
    for r in rows(spark, "op7_packing"):
        got[r["doc_id"]].append(r)
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    assert got.keys() == {d for d, _ in docs}
    for (d, _), e in zip(docs, tokenizer.encode_batch([t or "" for _, t in docs], add_special_tokens=False), strict=True):
        ids, at = np.array([*e.ids, 0], np.uint32), 0
        for k, r in enumerate(sorted(got[d], key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (k, at)
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            assert k == 0 or r["length"] == 2048
            at += r["length"]
        assert at == len(ids)
    total = 0
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 2048
        total += at
    assert len(bins) <= -(-total // 2048) * 1.02 + 2


def test_op8(spark):
    want = defaultdict(list)
    table = spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    for c, t, r, x in [*map(tuple, table), *queries.CONFLICT]:
        want[c].append((t, r, x or ""))
    got = {r["conv_id"]: r for r in rows(spark, "op8_chat")}
    assert got.keys() == want.keys()
    for c, turns in want.items():
        turns.sort()
        said = [x for _, r, x in turns if r == "assistant"]
        assert got[c]["n_turns"] == len(turns)
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        assert got[c]["loss_chars"] == sum(map(len, said))
        assert got[c]["loss_sha256"] == hashlib.sha256("".join(said).encode()).hexdigest()
        assert got[c]["formatted_chars"] > sum(len(x) for _, _, x in turns)


def test_op9(spark, docs):
    got = rows(spark, "op9_mixing")
    source = {r["doc_id"]: r["source"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    size = {d: len(plain.words(t)) for d, t in docs}
    sizes, taken, most = defaultdict(int), defaultdict(int), defaultdict(int)
    for d, s in source.items():
        sizes[s] += size[d]
    want = plain.shares(sizes)
    assert {r["doc_id"] for r in got} == set(size)
    for r in got:
        s = source[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (size[r["doc_id"]], sizes[s])
        assert r["target"] == pytest.approx(want[s], rel=1e-6)
        assert r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
        most[s] = max(most[s], r["size"])
    for s, t in want.items():
        assert abs(taken[s] - t) <= max(0.05 * t, min(most[s] / 2, 0.1 * t)), (s, taken[s], t)
    assert rows(spark, "op9_mixing") == got


def test_op13(spark, docs):
    got = {r["doc_id"]: r for r in rows(spark, "op13_licenses")}
    assert got.keys() == {d for d, _ in docs}
    for d, text in docs:
        n, base = plain.base_phrases(text, licenses.BASE)
        r, own = got[d], sorted({label for _, label in base})
        assert (r["n_words"], r["n_base"], r["base_labels"]) == (n, len(base), ",".join(own))
        assert (r["first_word"], r["last_word"]) == ((base[0][0], base[-1][0]) if base else (None, None))
        assert set(own) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1


def test_op10(spark):
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    ids = np.array([r["vec_id"] for r in table])
    x = np.array([r["embedding"] for r in table], np.float64)
    got = defaultdict(list)
    for r in rows(spark, "op10_neighbours"):
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    hits = total = 0
    place = {v: i for i, v in enumerate(ids)}
    for q in ids[ids % 20 == 0]:
        sims = x @ x[place[q]]
        order = [i for i in np.lexsort((ids, -sims)) if ids[i] != q][:20]
        mine = sorted(got[q])
        assert [r for r, _, _ in mine] == list(range(1, len(order) + 1))
        assert all(s == pytest.approx(sims[place[v]], abs=1e-12) for _, v, s in mine)
        hits += len({v for _, v, _ in mine} & {ids[i] for i in order})
        total += len(order)
    assert hits >= 0.9 * total
    print("recall", hits / total)
