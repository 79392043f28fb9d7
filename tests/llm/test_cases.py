"""Odd tables: nulls in any column, empty and very long texts, repeated rows, empty tables, clashing names."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from llm import plain

import corpus_pipeline
from cadence.llm import chat, exact, fixity, jaccard, license_rules, licenses, manifest, mixing, neighbours, packing, quality, queries, repeats, toxicity, trie

DOC = "doc_id long, text string, lang string, source string, n_chars long, score double, slice long, rank int, digest string, label int"


def prose(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice(["ba", "to", "mi", "ren", "sol"]) for _ in range(r.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    a = prose(1, 60)
    near = a.split()
    near[30] = "other"
    rows = [
        (1, a, "en", "s0"), (2, a.replace(" ", " \t\n", 3), "en", "s0"), (3, " ".join(near), "en", None), (4, None, None, "s1"),
        (5, "", "de", "s1"), (6, "  \n ", None, None), (7, prose(2, 30_000), "en", "s1"), (8, "one", "en", "s2"),
        (9, "x" * 70_000, "en", "s2"), (10, prose(3, 25) + " " + a, "en", "s0"), (11, prose(4, 300), "fr", "s0"), (11, prose(4, 300), "fr", "s0"), (None, prose(5, 40), "en", "s0"),
    ]
    return spark.createDataFrame([(*r, 0, 0.5, 3, 1, "d", None) for r in rows], DOC)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 1, 0), (7, None, None), (None, 1, 1), (8, 0, 1)], "doc_id long, quality int, toxic int")


def unique(df):
    return [(r["doc_id"], r["text"]) for r in df.dropDuplicates(["doc_id"]).collect() if r["doc_id"] is not None]


def test_jaccard(odd, empty):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(odd, n=3, percent=80).collect()}
    assert got.pop(None)[1] is None
    assert got == plain.components(unique(odd), 3, 80)
    assert jaccard.jaccard_components(empty).count() == 0


def test_jaccard_of_bare_tables(spark):
    """One document, unrelated documents, texts without a word: nothing links, and nothing fails."""
    for texts in ([prose(1, 40)], [prose(k, 50) for k in range(3)], [None, "", " \n"], ["a", None]):
        got = jaccard.jaccard_components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
        assert {(r["doc_id"], r["component_id"]) for r in got} == {(i, i) for i in range(len(texts))}


@pytest.mark.parametrize("partitions", [1, 8, 64])
def test_jaccard_under_partitions(spark, partitions):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(docs.repartition(partitions, "doc_id"), n=3, percent=90).collect()}
    assert got == plain.components(unique(docs), 3, 90)


def test_jaccard_families(spark):
    """Near copies in chains, sparse bands and small sets, against all pairs."""
    r = random.Random(9)
    docs = []
    for f in range(12):
        base = prose(100 + f, r.choice([9, 12, 20, 33, 70, 200, 600])).split()
        for _ in range(14):
            docs.append((len(docs), " ".join(base)))
            base = list(base)
            base[r.randrange(len(base))] = prose(r.random(), 1) + "q"
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for n, percent in ((3, 90), (1, 90), (5, 80)):
        got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in jaccard.jaccard_components(df, n=n, percent=percent).collect()}
        assert got == plain.components(docs, n, percent)


def test_unrelated_sets_share_no_cell():
    """Empty bands are foreseen: sets of any size leave the catch-all cell to themselves, and linked ones meet."""
    r = np.random.default_rng(5)
    draw = lambda n: np.unique(r.integers(0, 1 << 64, n, dtype=np.uint64))
    for percent in (80, 90):
        bound = jaccard.Bound(percent)
        for n in (4, 12, 50, 200, 320, 500, 800, 2_000, 5_000):
            own = [jaccard.cells(draw(n), bound) for _ in range(20)]
            assert len(np.unique(np.concatenate([np.unique(c) for c in own]))) == sum(len(np.unique(c)) for c in own)
            assert np.mean([len(c) for c in own]) < 4 * n
    for percent in (50, 80, 90):
        bound = jaccard.Bound(percent)
        for n in (4, 11, 45, 61, 320, 800):
            for _ in range(20):
                shared, rest = draw(n), draw(n)
                most = n * (100 - percent) // percent
                for a, b in ((shared, np.union1d(shared, rest[:most])), (np.union1d(shared, rest[: most // 2]), np.union1d(shared, rest[most // 2 : most]))):
                    joint = len(np.union1d(a, b))
                    assert 100 * n >= percent * joint and (joint == n or len(np.intersect1d(jaccard.cells(a, bound), jaccard.cells(b, bound))))


def test_jaccard_blocks(spark, monkeypatch):
    """Leaves and verification in blocks, smaller than a cell and a home, against all pairs of sets."""
    monkeypatch.setattr(jaccard, "LEAF", 3)
    monkeypatch.setattr(jaccard, "TOGETHER", 2)
    monkeypatch.setattr(jaccard, "COLUMNS", 16)
    r = random.Random(4)
    sets = {t: sorted({e for e in range(60) if r.random() < 0.9}) for t in range(12)}
    want = {(a, b) for a in sets for b in sets if a < b and 100 * len({*sets[a]} & {*sets[b]}) >= 80 * len({*sets[a]} | {*sets[b]})}
    bound = jaccard.Bound(80)
    known = [(t, len(s), [sum(e % jaccard.GROUPS == g for e in s) for g in range(jaccard.GROUPS)], jaccard.words.planes(np.diff(np.array(s, np.uint64), prepend=np.uint64(0)))) for t, s in sets.items()]
    known = spark.createDataFrame(known, "tag long, n long, counts array<int>, members binary")
    members = spark.createDataFrame([(7, t, t, len(s), 0.0, 1.0) for t, s in sets.items()], "cell long, tag long, label long, n long, lo double, hi double")
    pairs = jaccard._boxed_pairs(members, known.select("tag", "counts"), bound)
    assert want <= {tuple(x) for x in pairs.collect()}
    homes = known.selectExpr("tag", "n as size", "tag % 2 as home")
    got = jaccard._linked(pairs, homes, known, bound)
    assert 0 < len(want) < 66 and {(min(x), max(x)) for x in got.collect()} == want


def test_jaccard_reports_a_pair_once():
    """Two points that share two cells are a pair in the first of them, and none where the finer counts allow no link."""
    import pyarrow as pa

    def pairs(points, steps):
        of = jaccard._pairs_of_leaves(jaccard.Bound(80), 0.2, True, steps)
        batches = (pa.RecordBatch.from_pylist([{"cell": cell, "points_a": points}]) for cell in (5, 9))
        return [(r["a"], r["b"]) for b in of(batches) for r in b.to_pylist()]

    finer = [[0] * jaccard.FINER for _ in range(2)]
    for k, f in enumerate(finer):
        for g in range(10):
            f[g if g < 6 else g + k * jaccard.GROUPS] = 1
    rows = [{"tag": k, "label": k, "size": 10, "lo": 0.0, "hi": 1.0, "first": [5, 9]} for k in range(2)]
    counts = [r | {"counts": np.array([1] * 10 + [0] * (jaccard.GROUPS - 10), np.int32)} for r in rows]
    assert pairs(counts, ("counts",)) == [(0, 1)]
    assert pairs([r | {"finer": jaccard.words.planes(np.array(f, np.int32))} for r, f in zip(rows, finer, strict=True)], ("counts", "finer")) == []
    assert pairs([r | {"finer": jaccard.words.planes(np.array(finer[0], np.int32))} for r in rows], ("counts", "finer")) == [(0, 1)]


def test_jaccard_gathers_crowded_cells(spark, monkeypatch):
    """Cells with much the same members become one, with every member once; others stay as they are."""
    monkeypatch.setattr(jaccard, "LEAF", 4)
    monkeypatch.setattr(jaccard, "LEAVES", 2)
    inside = {c: [t for t in range(40) if t % 7 != c] for c in range(7)} | {20: list(range(100, 120)), 30: [0, 1, 100]}
    rest = [(1000 + c, t, c, t, 0.1, 0.1, 9) for c, tags in inside.items() for t in tags]
    rest = spark.createDataFrame(rest, "a long, tag long, cell long, label long, lo double, hi double, n long")
    lead = max(range(7), key=lambda c: (len(inside[c]), c))
    checked = rest.selectExpr("a", "tag as b", "lo", "hi")
    got = jaccard._gathered(rest, checked).collect()
    whole = [r for r in got if r["cell"] < 0]
    assert len({r["cell"] for r in whole}) == 1 and sorted(r["tag"] for r in whole) == list(range(40))
    assert {(r["a"], r["n"], r["label"] - r["tag"]) for r in whole} == {(1000 + lead, 9, 0)}
    assert all((r["lo"], r["hi"]) == ((0.1, 0.1) if r["tag"] in inside[lead] else (0.0, 1.0)) for r in whole)
    assert sorted((r["cell"], r["tag"]) for r in got if r["cell"] >= 0) == sorted((c, t) for c in (20, 30) for t in inside[c])


def test_jaccard_large_family(spark, monkeypatch):
    """Near copies of one text that mostly don't link, in small bundles, against all pairs."""
    monkeypatch.setattr(jaccard, "LEAF", 3)
    monkeypatch.setattr(jaccard, "LEAVES", 2)
    r = random.Random(3)
    base, docs = prose(77, 160).split(), []
    for d in range(70):
        text = list(base)
        for k in r.sample(range(160), r.choice([1, 3, 5])):
            text[k] = f"own{d}x{k}"
        docs.append((d, " ".join(text)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for n, percent in ((5, 80), (3, 90)):
        got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in jaccard.jaccard_components(df, n=n, percent=percent).collect()}
        want = plain.components(docs, n, percent)
        assert got == want and 1 < len({c for _, c in want.values()}) < 70


def test_repeats(odd, empty):
    changed, rest = repeats.remove_repeats(odd)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in [*changed.collect(), *rest.withColumn("n_removed", rest["n_words"] * 0).collect()]}
    got.pop(None)
    assert got == {d: v[:2] for d, v in plain.without_repeats(unique(odd)).items()}
    assert changed.count() + rest.count() == odd.count()
    assert all(x.count() == 0 for x in repeats.remove_repeats(empty))


def test_exact(spark, odd, empty):
    rows = exact.exact_dedup(odd).collect()
    assert len(rows) == odd.count()
    keep = {r["doc_id"]: r["keep_id"] for r in rows}
    assert (keep[2], keep[5], keep[6], keep[11], keep[None]) == (1, 4, 6, 11, None)
    stay = exact.keep_first(odd)
    assert stay.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in stay.collect()) == sorted(map(str, [1, 3, 4, 6, 7, 8, 9, 10, 11, None]))
    assert exact.exact_dedup(empty).count() == 0 and exact.keep_first(empty).count() == 0


def test_index_persists(spark):
    index = exact.DigestIndex(spark, "digests_of_test", 3)
    first = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    more = spark.createDataFrame([(0, "a  b"), (5, "d"), (6, "d")], "doc_id long, text string")
    assert {r["doc_id"]: r["kept"] for r in index.add(first).collect()} == {1: True, 2: True}
    assert {r["doc_id"]: (r["keep_id"], r["kept"]) for r in index.add(more).collect()} == {0: (1, False), 5: (5, True), 6: (5, False)}
    assert index.add(more).filter("keep_id = 5").count() == 2 and index.table().count() == 3
    spark.sql("DROP TABLE digests_of_test")


def test_scores(spark, odd, empty, labels):
    for f, name in ((toxicity.score_toxicity, "toxic"), (quality.score_quality, "quality")):
        got = f(odd, labels, label=name).collect()
        assert len(got) == odd.count() and all(0 <= r["score"] <= 1 for r in got)
        assert f(empty, labels, label=name).count() == 0
        assert f(odd, labels.limit(0), label=name).count() == odd.count()
    assert toxicity.keep_clean(odd, labels).columns == odd.columns


def test_quality_equals_a_plain_fit(spark):
    """Features, weights, cut and scores of a small table, one text and one Newton step after another."""
    r = random.Random(12)
    texts = []
    for k in range(60):
        good = " ".join(prose(r.random(), 5).capitalize() + "." for _ in range(r.randint(1, 6)))
        bad = "\n".join([prose(r.random(), 3)] * r.randint(2, 5)) + " $$$ 123 " + "X! " * r.randint(0, 9)
        texts.append((k, good if k % 3 else bad, int(k % 3 > 0)))
    texts += [(100, None, 0), (101, "", 1), (102, "é" * 50, None), (103, " \n ", None)]
    docs = spark.createDataFrame([(k, t) for k, t, _ in texts], "doc_id long, text string")
    labels = spark.createDataFrame([(k, y) for k, _, y in texts], "doc_id long, quality int")
    got = {x["doc_id"]: x["score"] for x in quality.score_quality(docs, labels).collect()}
    want = plain.quality_scores([(k, t) for k, t, _ in texts], {k: y for k, _, y in texts}, quality._SIGNS)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-6) for k in want)


def test_decoding_equals_exhaustive_search():
    """The reading of short tokens against all ways through their lattices."""
    r = random.Random(13)
    corpus = np.array([r.choice([0, 0, 1, 5, 40]) for _ in range(28**3)], np.float64)
    lexicon = dict.fromkeys(["idiot", "bad", "ab", "a", "toad", "aad"], 2.0)
    decoder = toxicity.Decoder(corpus, lexicon)
    seen = 0
    for _ in range(400):
        token = "".join(r.choice(["a", "b", "d", "i", "o", "t", "1", "0", "4", "!", "-", ".", " ", "aaa", "ooo", "$"]) for _ in range(r.randint(1, 6)))
        ways = plain.readings(decoder.lattice(token), decoder.log, lexicon, decoder.listed, toxicity.HALF)
        best = sorted(ways.items(), key=lambda x: -x[1])
        if len(best) == 1 or best[0][1] - best[1][1] > 1e-9:
            assert decoder.read(token) == best[0][0], (token, best[:3])
            seen += 1
    assert seen > 300


def test_lexicon_and_score_by_plain_counts(spark):
    """The first word is the most significant one by counting, its weight its log odds; a text scores by its strongest word."""
    r = random.Random(14)
    rows = [(k, f"{prose(k, 6)} {'vile ' if k < 40 else ''}{'foul ' if 30 <= k < 45 else ''}n{k}", int(k < 45)) for k in range(120)]
    lexicon, none, rate = toxicity.learn_lexicon(spark.createDataFrame(rows, "doc_id long, text string, label int"))
    has = {w: [y for _, t, y in rows if w in t.split()] for w in {w for _, t, _ in rows for w in t.split()} if w.isalpha()}
    base = sum(y for *_, y in rows) / len(rows)

    def evidence(ys):
        t, n = sum(ys), len(ys)
        return 2 * sum(k * math.log(k / (n * p)) for k, p in ((t, base), (n - t, 1 - base)) if k) if t > n * base else 0.0

    assert rate == base and next(iter(lexicon)) == max(has, key=lambda w: evidence(has[w])) == "vile"
    assert lexicon["vile"] == pytest.approx(math.log((sum(has["vile"]) + 0.5) / (len(has["vile"]) - sum(has["vile"]) + 0.5)))
    model = object.__new__(toxicity.Model)
    model.lexicon, model.none, model.rate, model.corpus = lexicon, none, rate, np.ones(28**3)
    logit = lambda p: math.log(p / (1 - p))
    for text in ("all is well", "a vile thing", "v1le and vile", "V I L E", "vile foul", r.choice(rows)[1]):
        terms = toxicity.found(text, lexicon, toxicity.Decoder(model.corpus, lexicon))
        odds = max([lexicon[w] for w in terms], default=none) + 0.25 * max(0, len(terms) - 1)
        assert logit(model.score(terms)) == pytest.approx(max(-30, min(30, odds)))
        assert bool(terms) == any(w in lexicon for w in ["vile", "foul"] if w in text.lower().replace(" ", "").replace("1", "i"))


@pytest.mark.parametrize("text", ["an 1d10t", "i d i o t", "you idiooooot!", "P@thet1c,", "w0rthle$$", "s*t*u*p*i*d", "$tupid"])
def test_deobfuscation(text):
    lexicon = dict.fromkeys(["idiot", "pathetic", "worthless", "stupid"], 3.0)
    decoder = toxicity.Decoder(np.ones(28**3), lexicon)
    assert toxicity.found(text, lexicon, decoder)
    assert not toxicity.found("THE!! a$$$ word%%% on 2 may at 10:30, v2.0", lexicon, decoder)


@pytest.mark.parametrize(
    "text,want",
    [("a i d i o t", ["idiot"]), ("s t u p i d i d i o t", ["stupid", "idiot"]), ("i d i o t i am", ["idiot"]), ("you a s t u p 1 d i d i o t i say", ["stupid", "idiot"]), ("$tupid-1d10t", ["stupid", "idiot"]), ("a p a t h e t i c i d i o t", ["pathetic", "idiot"])],
)
def test_spaced_words_in_a_run(text, want):
    """A run of single characters is cut into words: its neighbours don't hide a spaced word."""
    lexicon = dict.fromkeys(["idiot", "pathetic", "worthless", "stupid"], 3.0)
    assert toxicity.found(text, lexicon, toxicity.Decoder(np.ones(28**3), lexicon)) == want


@pytest.mark.parametrize("text,want", [("stu" + 90 * "u" + "pid", ["stupid"]), ("stu" + 90_000 * "u" + "pid", ["stupid"]), ("x " * 60 + "i d i o t", ["idiot"]), ("x " * 20_000 + "s t u p i d", ["stupid"]), ("w0rd-" * 40 + "1d10t", ["idiot"])])
def test_long_disguises(text, want):
    """A disguised token is read to its end."""
    lexicon = dict.fromkeys(["idiot", "pathetic", "worthless", "stupid"], 3.0)
    assert toxicity.found(text, lexicon, toxicity.Decoder(np.ones(28**3), lexicon)) == want


def test_lexicon_is_whole(spark):
    """More significant words than 400, and words of two letters or of more than 40."""
    letters = lambda k: "".join("abcdefghij"[int(x)] for x in f"{k:04d}")
    crowd = " ".join(letters(k) for k in range(450))
    rows = [(i, f"{crowd} n{letters(i)}", 1) for i in range(30)]
    rows += [(100 + i, f"zq n{letters(100 + i)}", 1) for i in range(18)] + [(200 + i, f"{'w' * 50} n{letters(200 + i)}", 1) for i in range(18)]
    rows += [(300 + i, f"plain n{letters(300 + i)}", 0) for i in range(66)]
    lexicon, none, rate = toxicity.learn_lexicon(spark.createDataFrame(rows, "doc_id long, text string, label int"))
    assert {"zq", "w" * 50} < set(lexicon) and len(lexicon) == 3 and none < 0 and rate == 0.5


def test_packing(odd, empty):
    rows = packing.pack(odd).collect()
    total = sum(r["length"] for r in rows)
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in odd.collect()}
    assert sum(r["doc_id"] in (4, 5) and r["length"] == 1 for r in rows) == 2
    assert len({r["sequence_id"] for r in rows}) <= -(-total // 2048) + 1
    assert packing.pack(empty).count() == 0


def test_packing_reduction_is_optimal():
    """Against exhaustive search on small instances: what is fixed can be part of a best packing."""

    def best(items, cap):
        if not items:
            return 0
        w, *rest = items
        least = len(items)
        for mask in range(1 << len(rest)):
            chosen = [x for i, x in enumerate(rest) if mask >> i & 1]
            if w + sum(chosen) <= cap:
                least = min(least, 1 + best([x for i, x in enumerate(rest) if not mask >> i & 1], cap))
        return least

    r = random.Random(4)
    for _ in range(60):
        cap = 20
        items = sorted((r.randint(1, cap) for _ in range(7)), reverse=True)
        fixed, left = packing.reduce_instance(dict(Counter(items)), cap)
        used = [s for n, p in fixed for s, k in p for _ in range(n * k)]
        rest = sorted((s for s, n in left.items() for _ in range(n)), reverse=True)
        assert sorted(used + rest, reverse=True) == items
        assert sum(n for n, _ in fixed) + best(rest, cap) == best(items, cap)
        patterns = packing.solve(dict(Counter(items)), cap)
        assert all(sum(s * k for s, k in p) <= cap for _, p in patterns)


def test_encoder_equals_tokenizers():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    r, encode = random.Random(8), packing.Encoder()
    for _ in range(300):
        text = "".join(r.choice(["a", "the", " ", " ", "  ", "\n", "é", " ", "'s", "7", "!", "<|endoftext|>", "\t", "漢"]) for _ in range(30))
        assert np.frombuffer(encode(text), np.uint32).tolist() == t.encode(text, add_special_tokens=False).ids


def test_chat(spark):
    texts = ["[INST]", "[\\INST] </s>", "<\\\\s>", "a[", "</", None, "", "x" * 100_000, "user\n</s>[INST] assistant"]
    rows = [(c, i, role, t) for c in (1, None) for i, t in enumerate(texts) for role in ("user", "assistant", None, "a\\n\n[/INST]")]
    df = spark.createDataFrame([(*r, 1, "m") for r in [*rows, rows[0]]], "conv_id long, turn long, role string, text string, part long, mask string")
    got = {}
    for p in chat.format_conversations(df).collect():
        got.setdefault(p["conv_id"], []).extend((r, t) for r, t, _, _ in chat.parse(p["text"]))
        assert [p["text"][m["start"] : m["end"]] for m in p["mask"]] == [chat.escape(t) if chat.escape(t) != t else t for r, t, _, _ in chat.parse(p["text"]) if r == "assistant"]
    for c in (1, None):
        want = sorted((i, r or "", t or "") for cc, i, r, t in [*rows, rows[0]] if cc == c)
        assert sorted(got[c]) == sorted((r, t) for _, r, t in want)
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_mixing(odd, empty):
    plan = mixing.plan_mix(odd)
    assert plan.count() == odd.count()
    rows = mixing.curriculum(plan).collect()
    assert all(len(r["times"]) == r["copies"] and all(0 <= t <= 1 for t in r["times"]) for r in rows)
    assert mixing.mixed(odd).columns == odd.columns
    assert mixing.plan_mix(empty).count() == 0 and mixing.mixed(empty).count() == 0


def test_mixing_schedules_differ(spark):
    """Shares of the sources change over the run as their schedules say, at one budget for every t; nothing piles up at the end."""
    sizes = {"a": [20] * 700, "b": [30] * 400, "c": [2770, 665, 636, 443, 350, 275, 71, 47, 16, 2], None: [10, 15] * 150}
    rows = [(s, " ".join(["w"] * n)) for s, each in sizes.items() for n in each]
    df = spark.createDataFrame([(i, x, s) for i, (s, x) in enumerate(rows)], "doc_id long, text string, source string")
    plan = mixing.plan_mix(df)
    trained = [(t, r["size"], r["source"]) for r in mixing.curriculum(plan).collect() for t in r["times"]]
    goal = {r["source"]: (r["target"], r["lean"] * mixing.DRIFT) for r in plan.collect()}
    assert abs(sum(t * tilt for t, tilt in goal.values())) < 1e-6 and max(abs(tilt) for _, tilt in goal.values()) == pytest.approx(mixing.DRIFT)
    assert max(t for t, _, _ in trained) < 1
    for x in (0.25, 0.5, 0.75):
        words = Counter()
        for t, n, s in trained:
            words[s] += n * (t < x)
        for s, (target, tilt) in goal.items():
            if s != "c":
                assert words[s] == pytest.approx(target * (x + tilt * (x * x - x)), rel=0.02)
        assert abs(sum(words.values()) - x * sum(t for t, _ in goal.values())) <= max(sizes["c"])
    assert goal["a"][1] < 0 < goal["c"][1]
    flat = [t for r in mixing.curriculum(plan, 0).collect() for t in r["times"]]
    assert len(flat) == len(trained) and all(0 <= t < 1 for t in flat)


def test_mixing_of_few_large_documents(spark):
    """Sources whose sizes barely leave a choice still come near their targets."""
    r = random.Random(3)
    sizes = {"a": [2770, 665, 636, 443, 350, 275, 71, 47, 16, 2], "b": [900, 40, 30], "c": [500, 490, 480, 20], None: [1] * 60, "d": [r.randint(1, 3000) for _ in range(40)]}
    rows = [(s, " ".join(["w"] * n)) for s, each in sizes.items() for n in each]
    df = spark.createDataFrame([(i, x, s) for i, (s, x) in enumerate(rows)], "doc_id long, text string, source string")
    plan = mixing.plan_mix(df).collect()
    want = plain.shares({s: sum(x) for s, x in sizes.items()})
    assert len(plan) == len(rows)
    for s, each in sizes.items():
        mine = [x for x in plan if x["source"] == s]
        need = want[s] - mine[0]["passes"] * sum(each)
        sums = {0}
        for n in each:
            sums |= {x + n for x in sums if x + n <= need + 1e-6}
        taken = sum(x["size"] * x["copies"] for x in mine)
        assert taken <= want[s] + 1e-6
        assert want[s] - taken <= max(need - max(sums) + 0.1 * want[s], 0.05 * want[s]), (s, taken, want[s])


def test_neighbours(spark):
    r = np.random.default_rng(0)
    v = [x.tolist() for x in r.standard_normal((60, 8))]
    rows = [(i, x, "c") for i, x in enumerate(v)] + [(100, None, "c"), (101, [0.0] * 8, "c"), (102, [float("nan")] * 8, "c"), (103, [1.0, None] * 4, "c"), (104, [1.0], "c"), (None, v[0], "c"), (3, v[3], "c"), (200, v[3], "c")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, node string")
    graph = neighbours.Graph(df)
    got = graph.search(graph.rows.filter("vec_id % 20 = 0").select("vec_id", "vec").distinct(), 5, id="vec_id").collect()
    for q in (0, 20, 40):
        sims = sorted(((-float(np.dot(v[q], x)), i) for i, x in [*enumerate(v), (200, v[3])] if i != q))[:5]
        assert [(x["rank"], x["vec_id"]) for x in sorted((x for x in got if x["query_id"] == q), key=lambda x: x["rank"])] == [(k + 1, i) for k, (_, i) in enumerate(sims)]
    assert neighbours.Graph(df.limit(0)).search(df.select("vec_id", "embedding").limit(0), 5, id="vec_id", vector="embedding").count() == 0


def test_neighbours_of_repeated_rows(spark, tmp_path):
    """Through the registered query: a repeated row asks once, an id with two vectors gets the best of both."""
    v = np.random.default_rng(1).standard_normal((90, 8)).tolist()
    rows = [*enumerate(v), (0, v[0]), (0, v[0]), (20, v[20]), (40, v[41])]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = queries.op10_neighbours(spark, str(tmp_path)).collect()
    for q in (0, 20, 40, 60, 80):
        asked = [np.array(x) for i, x in rows if i == q]
        want = sorted((-max(float(np.dot(a, x)) for a in asked), i) for i, x in {(i, tuple(x)) for i, x in rows} if i != q)[:20]
        assert [x["vec_id"] for x in sorted((x for x in got if x["query_id"] == q), key=lambda x: x["rank"])] == [i for _, i in want]


@pytest.mark.parametrize("kind", ["outlier", "cluster", "large", "small"])
def test_neighbours_recall(spark, kind):
    """Recall against all pairs beside one row of norm 1,000, in a cluster far closer than a hundredth, and where squares overflow or vanish."""
    r = np.random.default_rng(5)
    v = r.standard_normal((700, 16))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    if kind == "outlier":
        v[699] *= 1_000
    elif kind == "cluster":
        v[:300] = v[0] + 1e-4 * r.standard_normal((300, 16))
    else:  # scores of the large ones would overflow, so queries are scaled down
        v *= 1e160 if kind == "large" else 1e-170
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    graph = neighbours.Graph(df)
    hits = {}
    unit = {"large": 1e-160, "small": 1e170}.get(kind, 1.0)
    asked = spark.createDataFrame([(i, (v[i] * unit).tolist()) for i in range(0, 700, 20)], "vec_id long, vec array<double>")
    for x in graph.search(asked, 20, id="vec_id").collect():
        hits.setdefault(x["query_id"], set()).add(x["vec_id"])
    recall = [len(hits[q] & set([i for i in np.argsort(-(v @ (v[q] * unit)), kind="stable") if i != q][:20])) / 20 for q in range(0, 700, 20)]
    assert np.mean(recall) >= 0.9


def test_fixity(spark):
    rows = [(1, "u", "a"), (1, "u", "b"), (2, None, None), (None, "u", "n"), (-5, "u", ""), (10**15, "u", "z"), (7, "u", "same")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "page_id long, url string, html string, key long, digest string")
    other = spark.createDataFrame([(*r, 1, "x") for r in [(1, "u", "b"), (1, "u", "a"), (2, "", "!"), (-5, "u", ""), (10**15, "u", "z"), (8, "u", "same")]], df.schema)
    found = {r["key"]: r["status"] for r in fixity.audit(df, other)[1].collect()}
    assert found == {2: "changed", None: "missing", 7: "missing", 8: "extra"}
    assert fixity.audit(df, df)[1].count() == 0 and fixity.audit(df.limit(0), df.limit(0))[1].count() == 0
    assert fixity.audit(df, df.limit(0))[1].count() == 6


def _license_texts():
    r = random.Random(6)
    pieces = ["GNU", "General", "Public", "License", "apache", "LICENSE", "cc", "BY", "by", "nc", "sa", "4.0", "mit", "MIT", "license", "version", "2", "v3", "lesser", "and", "é", "licensed under the", "all rights reserved", "SPDX-License-Identifier:", "copyright 2020"]
    return ["".join(r.choice(pieces) + r.choice([" ", "  ", "-", "\n", ", ", "", "\x7f", "\u00a0"]) for _ in range(r.randint(0, 60))) for _ in range(400)]


def test_license_base():
    for text in [*_license_texts(), "", "cc by" * 3, "CC-BY cc/by CC by nc", "the gnu general  public\nLICENSE", "xmit license", "mit licenses", "ÄCC BY", "CC BYé", "cc by " * 20_000]:
        n, base, _ = licenses.scan_text(text.encode())
        assert (n, base) == plain.base_phrases(text, licenses.BASE)


def test_license_suppression():
    """The one-pass resolution against every pair, and the keyword gate against trying every rule."""
    for text in _license_texts():
        low = text.encode().lower()
        found = [(m.start(), m.end(), rule.priority, i, rule.label) for i, rule in enumerate(licenses.rules()) for m in rule.pattern.finditer(low)]
        assert sorted(licenses.detections(low)) == sorted(found)
        assert sorted(licenses.resolved(found)) == plain.unsuppressed(found)


@pytest.mark.parametrize(
    "text,want",
    [
        ("Licensed under the Apache License, Version 2.0.", {"apache"}), ("GNU General Public License, version 3", {"gpl-3"}), ("Licensed under CC BY-NC 4.0.", {"cc-by-nc"}), ("cc by", {"cc-by"}),
        ("SPDX-License-Identifier: BSD-3-Clause", {"bsd-3-clause"}), ("SPDX-License-Identifier: GPL-2.0-or-later", {"gpl-2.0"}), ("https://creativecommons.org/licenses/by-sa/4.0/", {"cc-by-sa"}),
        ("Mozilla Public Licence v. 2.0", {"mpl-2.0"}), ("under the GPLv2 or later", {"gpl-2"}), ("THE GPL", {"gpl"}), ("released into the public domain", {"public-domain"}), ("new BSD license", {"bsd-3-clause"}),
        ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software", {"mit"}), ("GNU Lesser General Public License v2.1", {"lgpl-2"}), ("Das ist mit Lizenz gemacht", set()), ("mitlicense, apaches, gplx", set()),
        ("Eclipse Public License 2.0", {"epl-2.0"}), ("Unauthorized copying of this file, via any medium, is strictly prohibited", {"proprietary"}),
    ],
)
def test_license_rules(text, want):
    assert {label for *_, label in licenses.scan_text(text.encode())[2]} == want


def test_license_scan(spark, odd, empty):
    texts = [None, "", "The MIT License. " * 3, "x" * 100_000 + " cc by", "MIT License; Apache License"]
    df = spark.createDataFrame([(i, t, 5, "l") for i, t in enumerate(texts)] + [(None, "cc by", 5, "l")] * 2, "doc_id long, text string, n_words int, labels string")
    got = {r["doc_id"]: tuple(r)[1:7] for r in licenses.scan(df).collect()}
    assert got == {0: (0, 0, None, None, "", ""), 1: (0, 0, None, None, "", ""), 2: (9, 3, 1, 7, "mit", "mit"), 3: (3, 1, 1, 1, "cc-by", "cc-by"), 4: (4, 2, 0, 2, "apache,mit", "apache,mit"), None: (2, 1, 0, 0, "cc-by", "cc-by")}
    assert licenses.scan(odd).count() == odd.count() and licenses.scan(empty).count() == 0
    assert all(0 <= r["score"] <= 1 and (r["score"] > 0) == (r["labels"] != "") for r in licenses.scan(df).collect())
    assert len(licenses.rules()) > 300 and all(rule.gate for rule in licenses.rules()) and license_rules.TEXTS


def _trie(spark, sequences):
    rows = [(c, i + 1, f"{len(r)}:{hashlib.md5((r + t).encode()).hexdigest()}"[-32:] + str(len(t.encode()))) for c, s in sequences.items() for i, (r, t) in enumerate(s)]
    df = spark.createDataFrame(rows, "conv_id long, depth long, item string")
    got = trie.prefix_trie(df, spark.createDataFrame([(c,) for c in sequences], "conv_id long")).collect()
    assert len({(r["conv_id"], r["depth"]) for r in got}) == len(got)
    return {(r["conv_id"], r["depth"]): tuple(r)[2:] for r in got}


@pytest.mark.parametrize("longest", [0, 1, 2, 5, 8, 37])
def test_trie(spark, longest):
    """Depths at and between powers of two, copies, prefixes of each other, empty sequences."""
    r = random.Random(longest)
    sequences = {}
    for c in range(60):
        base = list(sequences[r.choice(list(sequences))]) if sequences and r.random() < 0.7 else []
        base = base[: r.randint(0, longest)]
        while len(base) < longest and r.random() < 0.85:
            base.append((r.choice(["user", "assistant", ""]), r.choice(["", "a", "é", "long text"])))
        sequences[c * 3 - 20] = base
    assert _trie(spark, sequences) == plain.trie(sequences)


def test_trie_of_odd_tables(spark):
    """Nulls in any column, ties, repeated rows, a long text, clashing names, an empty table, a conversation without a beginning to share."""
    rows = [(0, None, "user", "first"), (0, 2, None, None), (0, 2, None, None), (0, 1, "assistant", "x" * 100_000), (3, 1, "user", "b"), (3, 1, "user", "a"), (7, 5, "", ""), (None, 1, "user", "lost"), (-2, 1, "user", "first"), (11, None, "user", "first"), (10, 0, "user", "first")]
    df = spark.createDataFrame([(*r, 1, "d", 2) for r in rows], "conv_id long, turn long, role string, text string, pos int, d string, depth int")
    own = {}
    for c, _, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        own.setdefault(c, []).append((role or "", text or ""))
    h = {c: zlib.crc32(str(c).encode()) % 9 for c in own}
    donor = {c: c - int(math.fmod(c, 5)) for c in own}
    want = plain.trie({c: own.get(donor[c], [])[: h[c]] + s[h[c] :] for c, s in own.items()})
    got = trie.prefix_trie(*queries.shared_starts(queries.stage(trie.turns(df), "turns"))).collect()
    assert {(r["conv_id"], r["depth"]): tuple(r)[2:] for r in got} == want
    assert trie.prefix_trie(*queries.shared_starts(queries.stage(trie.turns(df.limit(0)), "turns"))).count() == 0


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_manifest(spark, levels):
    """Against a plain tree: one source over several tiers, lone leaves, many sources, nulls, repeats, clashing columns."""
    rows = [(i, "big", "en", i, f"Text {i}") for i in range(600)] + [(1000 + i, f"s{i}", None, None, prose(i, 3).title()) for i in range(40)]
    rows += [(5, None, None, None, None), (None, None, "", 0, ""), (None, "big", "x", 1, "A:b"), (7, "big", "en", 7, "Text 7"), (2**62 + 1, "", "é", -3, "Ö A"), (-4, "é", "-", 5, "z" * 50_000)]
    names = "doc_id long, source string, lang string, n_chars long, text string, rank int, n string, g string, block int, digest string"
    df = spark.createDataFrame([(*r, 1, "n", "g", 2, "d") for r in rows], names).repartition(7)
    hurt = lambda d: d is not None and d % 5 == 0
    got = manifest.manifest(df, queries.F.lower("text"), queries.F.coalesce(queries.F.col("doc_id") % 5 == 0, queries.F.lit(False)), levels).collect()
    want = plain.manifest(rows, lambda r: (*r[:4], r[4].lower() if hurt(r[0]) and r[4] is not None else r[4]))
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert manifest.manifest(df.limit(0)).count() == 0
    one = manifest.manifest(df.filter("source = 's3'")).collect()
    assert [(r["leaf"], r["leaf"], r["leaf"], r["leaf"]) for r in one] == [(r["subroot"], r["root"], r["folded_root"], r["leaf"]) for r in one] and len(one) == 1


def test_stages(spark, odd, empty, labels, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for table in (odd, empty):
        docs = table
        for _, step in corpus_pipeline.STAGES[:-1]:
            docs = step(spark, docs, str(tmp_path))
            assert docs.columns == odd.columns
            docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() >= docs.count()


def test_pipeline(spark):
    """The whole run on the smallest tables, stage by stage against plain versions."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    scores = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs, spark.read.parquet(f"{sf}/labels.parquet")).collect()}
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if scores[r["doc_id"]] < toxicity.THRESHOLD]
    kept = plain.equal_texts(rows)
    rows = [r for r in rows if kept[r[0]][2]]
    near = plain.components(rows, 5, 80)
    rows = [r for r in rows if near[r[0]][1] == r[0]]
    got = corpus_pipeline.run(spark, sf).collect()
    assert {r["doc_id"] for r in got} <= {d for d, _ in rows}
    stage = docs.filter(docs["doc_id"].isin([d for d, _ in rows]))
    copies = {r["doc_id"]: r["copies"] for r in mixing.plan_mix(stage).collect()}
    assert Counter(r["doc_id"] for r in got if r["piece"] == 0) == Counter({d: n for d, n in copies.items() if n})
