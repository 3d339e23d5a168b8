"""Language, licences, neighbours, decontamination, quality and the pipeline on small inputs."""

import random
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from barloom.llm.decontaminate import align, benchmark_copies, without_copies
from barloom.llm.frames import table
from barloom.llm.language import Pieces, fit_languages, forward, identify
from barloom.llm.licenses import license_scan
from barloom.llm.neighbours import nearest
from barloom.llm.queries import QUERIES, WORD_TOKENIZER, rated
from barloom.llm.quality import fit_quality, fitted, kept_by_quality, quality_scores
from tests.llm.test_duplicates import brute_components, brute_repeats

PIECES = public_tokenizers.path("piece_bpe_32k.model")


# ---- language ----


def test_forward_sums_all_segmentations():
    known = Pieces(PIECES)
    chance = np.append(np.random.default_rng(0).random(len(known)), 0.0)
    number = {p: k for k, p in enumerate(known.pieces)}

    def total(word):
        if not word:
            return 1.0
        return sum(chance[number[word[:k]]] * total(word[k:]) for k in range(1, len(word) + 1) if word[:k] in number)

    for word in (b" the", b" strasse", "é à".encode(), b" nation"):
        cuts = known.cuts(np.frombuffer(word, np.uint8)[None])
        assert forward(cuts, chance[None])[0, 0, -1] == pytest.approx(total(word))


def test_language(spark, documents):
    rng = random.Random(2)
    words = {"aa": "der die und nicht ein strasse haus".split(), "bb": "the and not a house street with".split()}
    rows = [(k, " ".join(rng.choices(words[x], k=20)), x) for k, x in enumerate(["aa", "bb"] * 40)]
    odd = [(900, None, "aa"), (901, "", None), (902, "12 345 !!", "bb"), (903, "UND NICHT DER " + "x" * 5000, None), (None, "the house", None), (903, "und", None)]
    docs = documents(rows + odd, "score")
    model = fit_languages(docs.where("doc_id % 4 < 2"), PIECES)
    got = {(r["doc_id"], r["lang_pred"]): r["score"] for r in identify(docs, model, PIECES).collect()}
    assert all((k, x) in got for k, _, x in rows)
    assert got[(900, "und")] == got[(901, "und")] == got[(902, "und")] == 0.0
    assert (903, "aa") in got and (None, "bb") in got and all(0 <= s <= 1 for s in got.values())
    assert fit_languages(docs.limit(0), PIECES) is None
    assert {r["lang_pred"] for r in identify(docs, None, PIECES).collect()} == {"und"}
    assert identify(docs.limit(0), model, PIECES).count() == 0


def test_language_held_out(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    rows = QUERIES["op2_language"](spark, sf).where("held_out").join(docs, "doc_id").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.95


# ---- licences ----


def brute_licenses(rows, templates, least):
    words = lambda t: [w for w in re.sub("[^a-z0-9]+", " ", re.sub("[A-Z]", lambda m: m[0].lower(), t)).split(" ") if w]
    grams = lambda w: {(a, b) for a, b in zip(w, w[1:], strict=False)}
    out = {}
    for d, t in rows:
        units = dict.fromkeys([*(t or "").split("\n"), *re.split("\n[ \t\r]*\n", t or ""), t or ""]) if t is not None else {}
        for u in units:
            best = {}
            for name, text in templates:
                a, b = grams(words(u)), grams(words(text))
                if a and b:
                    best[name] = max(best.get(name, 0), round(2 * len(a & b) / (len(a) + len(b)), 6))
            for name, x in best.items():
                if x >= least:
                    old = out.get((d, name), (0, 0))
                    out[(d, name)] = (max(old[0], x), old[1] + 1)
    return {(d, n, *v) for (d, n), v in out.items()}


def test_licenses(spark, documents):
    templates = (("one", "Free for all uses, without any limits."), ("one", "Free for some uses."), ("two", "No use at all is allowed here"), ("none", "Word"))
    rows = [
        (1, "FREE, for all uses!\nwithout any limits"), (1, "FREE, for all uses!\nwithout any limits"), (2, "Free for all uses, without any limits.\n\ntext"), (3, None), (4, ""), (5, "no use at all is allowed\nhere"),
        (None, "free for some uses"), (6, "free for all uses without any limits " * 300), (7, "word\nWord"), (8, "free for some uses\nFree for some uses"), (9, "Frée for sôme uses"),
    ]
    for least in (0.5, 0.8, 1.0):
        got = {tuple(r) for r in license_scan(documents(rows, "dice"), templates, least).collect()}
        assert got >= {x for x in brute_licenses(rows[1:], templates, least) if x[0] != 1} and {x[:3] for x in got} == {x[:3] for x in brute_licenses(rows, templates, least)}
    assert license_scan(documents(rows, "dice").limit(0), templates).count() == 0


# ---- neighbours ----


def test_neighbours(spark):
    rng = np.random.default_rng(3)
    rows = [(k, rng.standard_normal(24).tolist(), 1) for k in range(700)]
    rows += [(700 + k, rows[5][1], 1) for k in range(60)]  # copies: ties go to the smaller id
    bad = [(2000, None, 1), (2020, [0.0] * 24, 1), (2040, [float("nan")] * 24, 1), (2060, [None] * 24, 1), (2080, [1.0] * 3, 1), (None, rows[0][1], 1), (2100, [], 1), (2120, [float("inf")] * 24, 1)]
    frame = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, score int")
    for block, queries in ((8192, 2048), (90, 7)):
        got = {}
        for r in nearest(frame, F.col("vec_id") % 20 == 0, k=10, block=block, queries=queries).collect():
            got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
        ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
        hits = 0
        assert sorted(got) == [k for k in ids.tolist() if k % 20 == 0]
        for q, found in got.items():
            score = (x * x[ids == q][0]).sum(1)
            want = [int(ids[k]) for k in np.lexsort((ids, -score)) if ids[k] != q][:10]
            hits += len(set(want) & {f[1] for f in found})
            assert [f[0] for f in sorted(found)] == list(range(1, 11)) and all(abs(f[2] - score[ids == f[1]][0]) < 1e-12 for f in found)
        assert hits >= 0.95 * 10 * len(got)
        assert [f[1] for f in sorted(got[700])][:3] == [5, 701, 702]
    few = nearest(frame.where("vec_id < 4"), F.col("vec_id") == 0, k=10)
    assert few.count() == 3 and nearest(frame.limit(0), F.lit(True)).count() == 0
    same = nearest(frame.where("vec_id >= 700 AND vec_id < 760"), F.col("vec_id") == 700, k=5).collect()
    assert [r["vec_id"] for r in sorted(same, key=lambda r: r["rank"])] == [701, 702, 703, 704, 705]


def test_neighbours_recall(spark, sf):
    rows = table(spark, sf, "embeddings").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], np.float64)
    found = {(r["query_id"], r["vec_id"]) for r in QUERIES["op4_nearest_neighbours"](spark, sf).collect()}
    want = {(int(q), int(ids[k])) for q in ids[ids % 20 == 0] for k in [k for k in np.argsort(-(x @ x[ids == q][0]), kind="stable") if ids[k] != q][:20]}
    assert len(found & want) >= 0.9 * len(want)


# ---- decontamination ----


def brute_align(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            h[i + 1, j + 1] = max(0, h[i, j] + (1 if x == y else -1), h[i, j + 1] - 1, h[i + 1, j] - 1)
    return h.max()


def test_alignment_equals_brute_force():
    rng = np.random.default_rng(5)
    for _ in range(200):
        a, b = rng.integers(0, 4, rng.integers(1, 12)), rng.integers(0, 4, rng.integers(1, 20))
        assert align(a, b)[0] == brute_align(a.tolist(), b.tolist())


def test_decontamination(spark, documents):
    rng = random.Random(7)
    say = lambda n: " ".join(f"w{rng.randrange(60)}" if rng.random() < 0.6 else f"r{rng.randrange(5000)}" for _ in range(n))
    items = [(k, say(30)) for k in range(12)] + [(50, None), (51, ""), (52, "only two"), (3, "another item of the same name " + say(8))]
    clean = [(k, say(300)) for k in range(100)]
    dirty = []
    for k in range(12):
        words = items[k][1].split()
        for j in rng.sample(range(30), 6):  # every fifth word replaced, two dropped
            words[j] = "changed"
        del words[10:12]
        dirty.append((200 + k, f"{say(50)} {items[k][1].upper() if k % 2 else ' '.join(words)} {say(50)}"))
    odd = [(300, None), (301, ""), (None, items[0][1]), (302, (items[1][1] + " ") * 40), (302, "x"), (303, items[2][1] + "\n" + items[4][1])]
    docs = documents(clean + dirty + odd, "item_id")
    tests = spark.createDataFrame(items, "item_id long, text string")
    for block in (20_000, 4):
        rows = benchmark_copies(docs, tests, block=block).collect()
        got = {(r["doc_id"], r["item_id"]) for r in rows}
        assert got >= {(200 + k, k) for k in range(12)} | {(None, 0), (302, 1), (303, 2), (303, 4)}
        assert not {d for d, _ in got} & {d for d, _ in clean + odd[:2]}
        text = dict(clean + dirty + odd)
        whole = next(r for r in rows if r["doc_id"] == 201)
        assert text[201].encode()[whole["start_byte"] : whole["end_byte"]].decode().lower() == items[1][1] and whole["score"] == 1.0
        kept = without_copies(docs, tests, block=block)
        assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted([d for d, _ in clean] + [300, 301, 302])
    assert benchmark_copies(docs, tests.limit(0)).count() == 0 and without_copies(docs, tests.limit(0)).count() == docs.count()
    assert benchmark_copies(docs.limit(0), tests).count() == 0


# ---- quality ----


def test_ordinal_regression_orders_grades():
    rng = np.random.default_rng(1)
    grades = rng.integers(0, 4, 600)
    found = [np.unique(np.append(rng.integers(100, 300, 10), 10 + g)) for g in grades]
    ends = np.cumsum([0, *map(len, found)])
    model = fitted(np.concatenate(found), ends, grades, 3, ridge=1e-3)
    assert (np.diff(model.thresholds) > 0).all()
    p = model.at_least(np.concatenate(found), ends)
    assert (np.diff(p, axis=1) <= 0).all() and np.corrcoef(p.sum(1), grades)[0, 1] > 0.95


def test_quality(spark, documents):
    rng = random.Random(8)
    say = lambda bad: " ".join(rng.choices([f"w{k}" for k in range(80)], k=60) + ["awful"] * bad)
    rows = [(k, say(k % 3 == 0)) for k in range(400)]
    odd = [(900, None), (901, ""), (None, "awful w1 w2"), (902, "w1 " * 9000), (902, say(1))]
    docs = documents(rows + odd, "keep")
    ratings = spark.createDataFrame([(k, 2 if k % 3 else 0) for k in range(300)] + [(3, 2), (None, 0), (5, None)], "doc_id long, grade int")
    model = fit_quality(docs, ratings, top=2)
    scores = quality_scores(docs, model, tail=2).collect()
    held = [r for r in scores if r["doc_id"] is not None and 300 <= r["doc_id"] < 400]
    assert len(scores) == len(rows + odd) and np.mean([r["keep"] == bool(r["doc_id"] % 3) for r in held]) > 0.97
    assert all(0 <= r["p_tail"] <= 1 and 0 <= r["expected_grade"] <= 2 for r in scores)
    kept = kept_by_quality(docs, model, tail=2)
    assert kept.columns == docs.columns and kept.count() == sum(r["keep"] for r in scores)
    assert fit_quality(docs, ratings.limit(0), top=2) is None
    assert quality_scores(docs, None, tail=2).where("keep").count() == len(rows + odd) and quality_scores(docs.limit(0), model, tail=2).count() == 0
    assert kept_by_quality(docs, None, tail=2).count() == docs.count()


# ---- pipeline ----


def test_pipeline_stages_equal_brute_force(spark, sf):
    docs = table(spark, sf, "documents")
    names = docs.columns
    pairs = lambda frame: sorted((r["doc_id"], r["text"]) for r in frame.collect())
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality classifier"](spark, docs, sf).cache()
    grades = {r["doc_id"]: r["grade"] for r in rated(spark, sf).collect()}
    kept = {r["doc_id"] for r in good.collect()}
    assert good.columns == names and np.mean([(d in kept) == (g == 2) for d, g in grades.items()]) > 0.95
    single = stages["n-gram Jaccard join"](spark, good, sf).cache()
    rows = pairs(good)
    assert single.columns == names and pairs(single) == [(d, t) for (d, t), (_, _, c) in zip(rows, brute_components(rows), strict=True) if c == d]
    cut = stages["suffix-array dedup"](spark, single, sf).cache()
    rows = pairs(single)
    lengths = {d: w[0] - w[1] for (d, _), w in zip(rows, brute_repeats([t for _, t in rows], corpus_pipeline.REPEAT_BYTES), strict=True)}
    assert cut.columns == names and all(0 <= lengths[d] - len(t.encode()) < 8 for d, t in pairs(cut)) and len(lengths) == cut.count()
    clean = stages["benchmark decontamination"](spark, cut, sf).cache()
    items = [r["text"] for r in table(spark, sf, "benchmark").collect()]
    assert clean.columns == names and not [d for d, t in pairs(clean) if any(x in t for x in items)]
    assert {d for d, t in pairs(cut) if any(x in t for x in items)} | {d for d, _ in pairs(clean)} <= {d for d, _ in pairs(cut)}
    packed = stages["packing"](spark, clean, sf).collect()
    assert {r["doc_id"] for r in packed} == {d for d, _ in pairs(clean)} and max(r["offset"] + r["length"] for r in packed) <= 4096
    assert WORD_TOKENIZER


def test_pipeline_takes_odd_rows(spark, documents, sf):
    odd = documents([(1, None), (2, ""), (None, "no id"), (3, "same text here and there"), (3, "same text here and there"), (4, "x " * 4000)])
    for frame in (odd, odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            frame = stage(spark, frame, sf)
        assert frame.count() >= 0


def test_pipeline_tells_rows_of_one_id_apart(spark, documents, sf):
    words = [f"w{k}" for k in range(60)]
    rows = [(1, " ".join(words)), (5, " ".join(words[1:])), (5, "another text of id five"), (5, "another text of id five"), (-2, " ".join(words[:-1] + ["z"])), (None, "no id")]
    kept = corpus_pipeline.near_duplicates(spark, documents(rows), sf)
    assert sorted((r["doc_id"] is not None, r["doc_id"], r["text"]) for r in kept.collect()) == [(False, None, "no id"), (True, -2, rows[4][1]), (True, 5, rows[2][1])]
