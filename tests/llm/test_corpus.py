"""Similarity join, decontamination, classifiers and the pipeline."""

from __future__ import annotations

import itertools
import random
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from cohortloom.llm import crf, decontamination, jaccard, labelled, toxicity

SCHEMA = "doc_id long, text string"
SMALL = "/root/testdata/sf0.001"


def shingles(text, k):
    words = tuple((text or "").encode().lower().split())
    if not words:
        return set()
    return {words} if len(words) < k else {words[i : i + k] for i in range(len(words) - k + 1)}


def brute_components(rows, k, percent):
    sets = [shingles(text, k) for _, text in rows]
    group = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        shared, union = len(sets[i] & sets[j]), len(sets[i] | sets[j])
        if union and 100 * shared >= percent * union and group[i] != group[j]:
            old = group[j]
            group = [group[i] if g == old else g for g in group]
    lowest = {}
    for (doc_id, _), g in zip(rows, group, strict=True):
        lowest[g] = min(lowest.get(g, doc_id), doc_id)
    return Counter((doc_id, len(s), lowest[g]) for (doc_id, _), s, g in zip(rows, sets, group, strict=True))


def near_copies(seed=3):
    """Chains of edited copies, exact copies, boilerplate, short and blank texts."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    common = " ".join(rng.choices(words, k=12))
    rows = []
    for base in range(12):
        text = rng.choices(words, k=rng.choice([4, 8, 20, 60, 150]))
        for _ in range(rng.choice([1, 2, 6, 12])):
            rows.append(" ".join(text) + (f"\n{common}" if base % 3 == 0 else ""))
            text = list(text)
            if rng.random() < 0.7:
                text[rng.randrange(len(text))] = rng.choice(words)
    rows += ["", None, "  \n", "one", "One", "one two three", "ONE two  three", "É é", "é É"]
    return [(100 + 3 * i, text) for i, text in enumerate(rows)]


def bridge():
    """Three texts in a chain of similarity 0.9; the outer ones are further apart than the threshold."""
    words = [f"w{i}" for i in range(60)]
    left, right = list(words), list(words)
    left[0], left[2], right[-1], right[-3] = "a", "b", "c", "d"
    return " ".join(left), " ".join(words), " ".join(right)


def test_a_set_under_null_ids_alone_links_its_neighbours(spark):
    left, middle, right = bridge()
    rows = [(1, left), (None, middle), (None, middle), (2, right), (2, right), (2, "quite another text than the others are")]
    got = Counter((r.doc_id, r.component_id) for r in jaccard.classes(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect())
    assert got == Counter({(1, 1): 1, (None, 1): 2, (2, 1): 2, (2, 2): 1})
    big = 2**60 + 1  # beyond what floating numbers tell apart
    rows = [(big, left), (None, middle), (big + 1, right), (None, None)]
    got = Counter((r.doc_id, r.component_id) for r in jaccard.classes(spark.createDataFrame(rows, SCHEMA).coalesce(1)).collect())
    assert got == Counter({(big, big): 1, (None, big): 1, (big + 1, big): 1, (None, None): 1})


def test_windows_prune_and_lose_nothing():
    """Later pivots meet few members, and the labels are those of all comparisons."""
    rng = np.random.default_rng(6)
    chain = [np.sort(rng.choice(5000, 200, replace=False)).astype(np.uint64) for _ in range(6)]
    for at in range(240):
        near = chain[at].copy()
        near[rng.integers(0, 200, 12)] = 5000 + 12 * at + np.arange(12)
        chain.append(np.unique(near))
    met = []
    region = jaccard.Region(chain, 85)
    linked = region.linked
    region.linked = lambda own, size, near=None: met.append(near.sum()) or linked(own, size, near)
    labels = region.labels()
    assert met and np.mean(met) < len(chain) / 2
    whole = np.array([[100 * len(np.intersect1d(a, b)) >= 85 * len(np.union1d(a, b)) for b in chain] for a in chain])
    expected = np.arange(len(chain))
    while True:
        lowest = np.array([expected[row].min() for row in whole])
        if (lowest == expected).all():
            break
        expected = lowest
    assert ((labels[:, None] == labels) == (expected[:, None] == expected)).all()


@pytest.mark.parametrize("limits", [{}, {"TASK_SHINGLES": 300}, {"MEASURED": 1, "BLOCK_CELLS": 50, "BUCKET_CELLS": 20, "SEEN": 2}])
def test_components_match_all_pairs(spark, monkeypatch, limits):
    for name, limit in limits.items():
        monkeypatch.setattr(jaccard, name, limit)
        monkeypatch.setattr(jaccard, "PIVOTS", 4)
        monkeypatch.setattr(jaccard, "MORE_PIVOTS", 3)
    rows = near_copies()
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA + ", node int, region int")
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.classes(docs).collect())
    expected = brute_components(rows, 4, 85)
    blank = {i for i, t in rows if not (t or "").split()}
    assert {x for x in got if x[0] in blank} == {(i, 0, i) for i in blank}
    assert got == expected


def test_regions_of_shared_passages_are_narrowed(spark, monkeypatch):
    """Texts that only share a passage chain into one region; what goes beyond a task is the group of near copies."""
    large, regions, whole, narrow = [], [], jaccard.join_large, jaccard.narrowed
    monkeypatch.setattr(jaccard, "join_large", lambda members, percent: large.append({r.node for r in members.collect()}) or whole(members, percent))
    monkeypatch.setattr(jaccard, "narrowed", lambda members, percent: regions.append(members.count()) or narrow(members, percent))
    for name, limit in {"TASK_SHINGLES": 1500, "PIVOTS": 4, "MORE_PIVOTS": 6, "BLOCK_CELLS": 700, "BUCKET_CELLS": 200}.items():
        monkeypatch.setattr(jaccard, name, limit)
    rng = random.Random(11)
    passages = [[f"p{i}x{j}" for j in range(100)] for i in range(2)]
    texts = [passages[i % 2] + [f"own{i}x{j}" for j in range(40)] for i in range(40)]
    texts += [t[:-4] + ["edited"] + t[-3:] for t in texts[:4]] + [t[:60] + ["edited"] + t[61:] for t in texts[2:4]]
    copied = [f"c{j}" for j in range(140)]
    for _ in range(20):
        copied = list(copied)
        copied[rng.randrange(140)] = f"w{rng.randrange(400)}"
        texts.append(copied)
    rows = [(100 + i, " ".join(t)) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.classes(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect())
    assert got == brute_components(rows, 4, 85)
    assert regions == [66] and [len(nodes) for nodes in large] == [20]


def test_linked_sets_share_a_cell():
    rng = np.random.default_rng(5)
    cells = jaccard.Cells(85)
    for size in (7, 20, 21, 60, 400, 1500):
        for _ in range(30):
            base = rng.integers(0, 1 << 63, size, dtype=np.uint64)
            most = (15 * 2 * size) // 185
            drop = int(rng.integers(0, most + 1))
            other = np.concatenate([base[drop:], rng.integers(0, 1 << 63, most - drop, dtype=np.uint64)])
            shared = size - drop
            if 100 * shared >= 85 * (size + len(other) - shared):
                assert np.intersect1d(cells.of(size, base), cells.of(len(other), other)).size


def test_sets_that_share_a_part_seldom_meet():
    """A shingle alone in its class makes no meeting: of 150 pairs that share a fifth, few meet."""
    rng = np.random.default_rng(7)
    cells, met = jaccard.Cells(85), 0
    for _ in range(150):
        size = int(rng.integers(400, 620))
        common = rng.integers(0, 1 << 63, size // 5, dtype=np.uint64)
        a, b = (np.concatenate([common, rng.integers(0, 1 << 63, size - size // 5, dtype=np.uint64)]) for _ in range(2))
        met += np.intersect1d(cells.of(size, a), cells.of(size, b)).size > 0
    assert met <= 10
    # Sets of frequent shingles alone enter as many cells as any others.
    assert len(cells.of(500, a[:0])) == len(cells.of(500, a))


def test_only_wanted_texts_are_fetched(spark):
    rows = spark.range(5000).selectExpr("id", "xxhash64(id) AS key", "'t' AS text")
    wanted = rows.filter("id % 100 = 3").select(rows.key.alias("wanted"))
    got = [r.id for r in jaccard.marked(rows, wanted).collect()]
    assert {i for i in range(5000) if i % 100 == 3} <= set(got) and len(got) <= 60
    assert len(got) == len(set(got)) and jaccard.marked(rows, wanted.limit(0)).count() == 0


def test_ids_that_repeat_or_are_null(spark):
    text = " ".join(f"x{i}" for i in range(30))
    docs = spark.createDataFrame([(5, text), (5, text), (None, text), (2, text + " y"), (9, "other words here now")], SCHEMA)
    rows = jaccard.classes(docs).collect()
    assert sorted((r.doc_id or 0, r.component_id) for r in rows) == [(0, 2), (2, 2), (5, 2), (5, 2), (9, 9)]
    kept = jaccard.representatives(docs).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["2", "9", "None"]
    assert jaccard.classes(docs.limit(0)).count() == 0


def brute_alignment(item, text):
    score = np.zeros((len(item) + 1, len(text) + 1))
    for i, j in itertools.product(range(1, len(item) + 1), range(1, len(text) + 1)):
        same = 1.0 if item[i - 1] == text[j - 1] else -0.5
        score[i, j] = max(0, score[i - 1, j - 1] + same, score[i - 1, j] - 0.5, score[i, j - 1] - 0.5)
    return score.max()


def test_alignment_is_smith_waterman():
    rng = np.random.default_rng(1)
    for _ in range(50):
        item, text = rng.integers(0, 4, rng.integers(1, 12)), rng.integers(-1, 4, rng.integers(0, 30))
        assert decontamination.align(item, text)[0] == pytest.approx(brute_alignment(item, text))


def test_edited_passages_are_found_and_clean_texts_are_not(spark, monkeypatch):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choices(words, k=30))) for i in range(12)] + [(90, None), (91, "two words")]
    docs, expected = [], set()
    for i, text in items[:12]:
        edited = [rng.choice(words) if rng.random() < 0.1 else w for w in text.split()]
        del edited[rng.randrange(30)]
        docs.append((i, "clean " * 20 + " ".join(edited).upper() + "! tail" * 20))
        expected.add((i, i))
        docs.append((100 + i, " ".join(rng.choices(words, k=200))))
    docs += [(200, None), (201, ""), (None, items[0][1]), (202, "two words")]
    frame = spark.createDataFrame([(*d, "k", 0) for d in docs], SCHEMA + ", key string, item int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for chars in (decontamination.BLOCK_CHARS, 900):  # one block and several
        monkeypatch.setattr(decontamination, "BLOCK_CHARS", chars)
        got = {(r.doc_id, r.item_id) for r in decontamination.matches(frame, bench).collect()}
        assert got == expected | {(None, 0)}
    kept = decontamination.without_matches(frame, bench)
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} == {100 + i for i in range(12)} | {200, 201, 202}
    assert decontamination.matches(frame.limit(0), bench).count() == 0
    assert decontamination.matches(frame, bench.limit(0)).count() == 0


def test_regularly_edited_copies_are_found(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(2000)]
    items = [(i, " ".join(rng.choices(words, k=20 + 3 * i))) for i in range(12)]
    docs, expected = [], set()
    for i, text in items:
        for every in (4, 5, 6):
            edited = [f"x{rng.random()}" if k % every == every - 1 else w for k, w in enumerate(text.split())]
            docs.append((10 * i + every, "head " * 30 + " ".join(edited) + " tail" * 30))
            expected.add((10 * i + every, i))
        docs.append((10 * i, text))  # a whole copy makes the intact grams more frequent
        expected.add((10 * i, i))
    found = decontamination.matches(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == expected


def test_words_rule_out_no_alignment():
    rng = random.Random(6)
    for _ in range(200):
        size, words = rng.randrange(3, 9), rng.randrange(3, 9)
        rows = [(i, " ".join(f"w{rng.randrange(words)}" for _ in range(size))) for i in range(5)]
        own = decontamination.Items(rows, 3)
        text = own.numbers(" ".join(f"w{rng.randrange(words + 2)}" for _ in range(rng.randrange(3, 60))))
        grams, near = set(own.grams(text).tolist()) - {-1}, {item for item, _ in own.near(text, 0.5)}
        for item, item_words in enumerate(own.words):
            if grams.intersection(own.grams(item_words).tolist()) and brute_alignment(item_words, text) >= 0.5 * size:
                assert item in near


def test_marginals_are_those_of_all_labellings():
    rng = np.random.default_rng(4)
    sizes = np.array([3, 1, 5])
    unary, pair = rng.normal(size=(9, 2)), rng.normal(size=(2, 2))
    got, expected_pairs = crf.Chains(sizes).marginals(unary, pair)
    pairs, start = np.zeros((2, 2)), 0
    for size in sizes:
        total, marginal, own = 0.0, np.zeros((size, 2)), np.zeros((2, 2))
        for labels in itertools.product((0, 1), repeat=int(size)):
            weight = np.exp(sum(unary[start + i, y] for i, y in enumerate(labels)) + sum(pair[a, b] for a, b in itertools.pairwise(labels)))
            total += weight
            for i, y in enumerate(labels):
                marginal[i, y] += weight
            for a, b in itertools.pairwise(labels):
                own[a, b] += weight
        assert np.allclose(got[start : start + size], marginal / total)
        pairs += own / total
        start += size
    assert np.allclose(pairs, expected_pairs)


def good_and_bad():
    rng = random.Random(6)
    words = [f"{a}{b}" for a in ("the", "an", "re", "ing", "tion") for b in ("sh", "ea", "nd", "er")]
    docs = []
    for i in range(160):
        lines = [" ".join(rng.choices(words, k=12)).capitalize() + "." for _ in range(4)]
        if i % 4 == 0:
            lines[1:3] = [" ".join(f"{w}$$$" for w in rng.choices(words, k=12)), "BUY!! NOW!! " * 8]
        docs.append((i, "\n".join(lines), int(i % 4 != 0), int(i % 5 == 0)))
        if i % 5 == 0:
            docs[-1] = (i, docs[-1][1] + " you moron are worthless", *docs[-1][2:])
    return docs


def test_line_field_separates_and_defines_empty_texts(spark):
    rows = spark.createDataFrame(good_and_bad(), SCHEMA + ", label int, toxic int")
    field = crf.fit(rows)
    extra = spark.createDataFrame([(900, None, None, None), (900, "", None, None), (None, " \n ", None, None), (901, "x" * 200_000, None, None)], rows.schema)
    scored = rows.unionByName(extra).withColumn("score", crf.score(field)).collect()
    assert all((r.score >= 0.7) == bool(r.label) for r in scored if r.label is not None)
    assert all(r.score == pytest.approx(field.prior) for r in scored if not (r.text or "").strip())
    assert all(0 <= r.score <= 1 for r in scored)
    alone = crf.fit(rows.filter("label = 1"))
    assert alone.scores(["anything", ""]).tolist() == [1.0, 1.0]
    assert crf.fit(rows.limit(0)).scores(["x"]).tolist() == [1.0]


def test_lexicon_catches_misspellings_and_spares_quotation(spark):
    rows = spark.createDataFrame(good_and_bad(), SCHEMA + ", quality int, label int").withColumnRenamed("doc_id", "id")
    model = toxicity.fit(rows)
    assert {"moron", "worthless"} <= set(model.lexicon.words)
    reader = toxicity.Reader(model.lexicon)
    plain, abuse, misspelled, quoted = model.scores(
        reader, ["Thesh rend ingea.", "You moron.", "Such a wortless morron.", 'He said "moron" is a word that some wrote.']
    )
    assert plain < 0.5 < 0.7 < misspelled <= abuse
    assert reader.features("you moron")[0] > reader.features("a moron")[0] > reader.features('said "moron" once')[0]
    assert quoted < abuse
    empty = rows.limit(0)
    assert toxicity.fit(empty).scores(reader, ["x"]).tolist() == [0.0]
    scored = spark.createDataFrame([(1, None), (1, "")], SCHEMA).select(toxicity.score(model).alias("s")).collect()
    assert scored[0].s == scored[1].s < 0.5


def test_words_and_stems_of_a_family_are_found_misspelled():
    toxic = {"idiot$": 100, "idiots$": 40, "idio": 140, "idiot": 40, "worthle": 60, "worthless$": 30, "worthlessly$": 30}
    lexicon = toxicity.build_lexicon(toxic, {}, 200, 200)
    assert set(lexicon.stems) == {"idio", "worthle"}
    assert lexicon.match("idjot")[::2] == ("idiot", 1)
    assert lexicon.match("idjots")[::2] == ("idiots", 1)
    assert lexicon.match("idiotic")[::2] == ("idio", 0)
    assert lexicon.match("wirthlenesses")[::2] == ("worthle", 1)
    assert lexicon.match("idaho") is None
    assert lexicon.match("northern") is None


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = _next(row, i, x, b)
    return row[-1]


def _next(row, i, x, b):
    out = [i]
    for j, y in enumerate(b, 1):
        out.append(min(out[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
    return out


def test_trie_walk_finds_every_term_within_its_edits():
    rng = random.Random(8)
    terms = {"moron": 5.0, "worthless": 4.0, "disgusting": 3.0, "scum": 6.0}
    lexicon = toxicity.Lexicon(terms, {})
    for _ in range(3000):
        word = list(rng.choice(list(terms)))
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(word))
            word[at : at + 1] = rng.choice(["", "x", word[at] + "y"])
        word = "".join(word)
        close = [t for t in terms if edits(t, word) <= toxicity.edits_for(len(t))]
        found = lexicon.match(word)
        assert (found is not None) == bool(close), word
        if found:
            assert found[2] == min(edits(t, word) for t in close)


def test_training_rows_leave_the_fold_out(spark):
    docs = spark.createDataFrame([(i, f"t{i}", "x") for i in range(200)], SCHEMA + ", label string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    rows = labelled.training_rows(docs, labels, "toxic", 3, 1, 50)
    held = {r.doc_id for r in docs.filter(labelled.held_out("doc_id", 3, 1)).collect()}
    ids = {r.id for r in rows.collect()}
    assert len(ids) == 50 and not ids & held and held


def test_pipeline_stages_keep_the_columns_and_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    known = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    columns, at = docs.columns, docs
    seen = []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, at, SMALL).write.parquet(f"{tmp_path}/{number}")
        at = spark.read.parquet(f"{tmp_path}/{number}")
        seen.append(at)
    assert [frame.columns for frame in seen[:-1]] == [columns] * 4
    ids = [{r.doc_id for r in frame.select("doc_id").collect()} for frame in seen]
    assert ids[0] >= ids[1] >= ids[2] == ids[3] == ids[4]
    good = {i for i, q in known.items() if q == 1}
    assert len(good - ids[0]) <= 0.05 * len(good)
    rows = [(r.doc_id, r.text) for r in seen[0].collect()]
    assert ids[1] == {c for _, _, c in brute_components(rows, 5, 80)}


@pytest.mark.parametrize("n", [3, 5, 8, 12])
def test_grams_of_any_length_find_every_exact_copy(n):
    """Many words, so that a gram as one number in a base would not fit 64 bits."""
    rng = random.Random(n)
    words = [f"v{i}" for i in range(20_000)]
    texts = [(i, " ".join(rng.sample(words, 20))) for i in range(1500)]
    items = decontamination.Items(texts, n)
    for number, (_, text) in enumerate(texts):
        at, grams = items.hits(items.numbers(f"before it {text} after it"))
        assert at.tolist() == list(range(2, 2 + 20 - n + 1))
        assert all(number in items.holders[g] for g in grams.tolist())
    at, _ = items.hits(items.numbers(" ".join(rng.choices(words, k=2000))))
    assert len(at) < 3


def test_samples_bound_rows_not_ids(spark):
    docs = [(i % 6, f"text {i}") for i in range(600)] + [(None, "nobody")]
    labels = [(i, i % 2, 0) for i in range(6)] + [(1, 0, 0), (None, 1, 1)]
    frame = spark.createDataFrame(docs, SCHEMA)
    marked = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = labelled.training_rows(frame, marked, "quality", 4, 2, 4).collect()
    again = labelled.training_rows(frame.repartition(7), marked, "quality", 4, 2, 4).collect()
    assert len(rows) <= 4 and len({r.id for r in rows}) == len(rows)
    assert sorted(rows) == sorted(again) and all(r.label == r.id % 2 for r in rows)
