"""Spelling variants, centroid clustering and license scans against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortloom.llm import centroids, licenses, variants

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# Spelling variants


def brute_words(rows):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                found[run] += 1
    return {word: n for word, n in found.items() if n >= 5}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_groups(counts):
    near = {w: [x for x in counts if one_edit(w, x)] for w in counts}
    best = {w: min(others, key=lambda x: (-counts[x], x)) for w, others in near.items() if others}
    form = {w: x for w, x in best.items() if counts[x] >= 5 * counts[w]}

    def root(word):
        while word in form:
            word = form[word]
        return word

    return {(w, form.get(w), root(w), n, len(near[w]), counts[form[w]] if w in form else None) for w, n in counts.items()}


def word_table(rng, size, letters="abé"):
    words = {"".join(rng.choices(letters, k=rng.randint(6, 9))) for _ in range(size)}
    return {w: rng.choice([5, 6, 25, 30, 130, 700, 3500]) for w in words}


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_match_brute_force(spark, seed):
    """Few letters over many stretches: long chains, letters in a row, ties."""
    counts = word_table(random.Random(seed), 260)
    counts |= {"aaaaaa": 5, "aaaaaaa": 25, "aaaaaaaa": 125, "aaaaaaaaa": 625, "aaaaaaaaaa": 3125, "a" * 300: 7, "a" * 301: 50}
    got = variants.group(spark.createDataFrame(list(counts.items()), "word string, n long"))
    assert {tuple(r) for r in got.collect()} == brute_groups(counts)


def test_node_numbers_are_those_of_tries(spark):
    counts = word_table(random.Random(5), 300)
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    for key, turn in ((F.col("word"), 1), (F.reverse("word"), -1)):
        of, back = {}, {}
        for row in variants.with_nodes(words, key, "t").collect():
            word = row.word[::turn]
            for length, node in enumerate(row.nodes):
                assert of.setdefault(word[:length], node) == node
                assert back.setdefault(node, word[:length]) == word[:length]
    assert len({r.number for r in variants.with_nodes(words, F.col("word"), "t").collect()}) == len(counts)


def test_words_are_counted_as_stated(spark):
    rng = random.Random(9)
    vocabulary = ["Straße", "strasse", "ÉLÈVES", "élèves", "lantern", "LANTERN", "short", "x" * 5000, "naïve1"]
    rows = [(i % 400, " ".join(rng.choices(vocabulary, k=30))) for i in range(600)]
    rows += [(None, "lantern lantern Ÿlantern Klantern"), (7, None), (8, ""), (9, " \n ")]
    docs = spark.createDataFrame([(a, b, "w", 1) for a, b in rows], "doc_id long, text string, word string, n int")
    assert {r.word: r.n for r in variants.counted_words(docs).collect()} == brute_words(rows)


def test_no_words(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert variants.group(variants.counted_words(empty)).collect() == []
    lonely = spark.createDataFrame([("lonesome", 9)], "word string, n long")
    assert [tuple(r) for r in variants.group(lonely).collect()] == [("lonesome", None, "lonesome", 9, 0, None)]


# Centroids


def brute_clusters(rows, k=40, rounds=5, dims=4):
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest()
    middles = [list(v) for _, v in sorted(good, key=lambda r: (name(r[0]), r[1]))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), at) for at, c in enumerate(middles))

    for _ in range(rounds):
        mine = defaultdict(list)
        for _, v in good:
            mine[nearest(v)[1]].append(v)
        for at, vectors in mine.items():
            middles[at] = [sum(x) // len(vectors) for x in zip(*vectors, strict=True)]
    found = [(i, *reversed(nearest(v))) for i, v in good]
    total = Counter()
    for _, at, distance in found:
        total[at] += distance
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middles]
    longest = (1 << 63) - 1
    return Counter(
        (i, at, min(d, longest), min(total[at], longest), min(sum(total.values()), longest), digest[at]) for i, at, d in found
    )


def cluster(spark, rows, k=40):
    data = spark.createDataFrame([(i, v, "c", 0) for i, v in rows], "vec_id long, embedding array<double>, cluster string, id int")
    found, middles = centroids.fit(data.repartition(5), k=k, dims=4)
    return Counter(tuple(r) for r in centroids.with_inertia(found, middles).collect())


def test_clusters_match_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = [(i, list(map(float, rng.normal(i % 7, 0.4, 4)))) for i in range(400)]
    rows += [(1000, [0.25] * 4)] * 60 + [(None, [0.25, 1.0, -1.0, 2.0])] * 3  # copies, ties and null ids
    rows += [(2000, None), (2001, []), (2002, [1.0] * 3), (2003, [1.0, None, 1.0, 1.0]), (2004, [1.0, math.nan, 1.0, math.inf])]
    assert cluster(spark, rows, 12) == brute_clusters(rows, 12)
    assert cluster(spark, rows, 12) == brute_clusters(rows, 12)


def test_ties_and_few_vectors(spark):
    grid = [(i, [float(i % 3), float(i % 2), 0.0, 0.0]) for i in range(30)]
    assert cluster(spark, grid) == brute_clusters(grid)
    assert cluster(spark, [(5, [-0.001, 1.0, 2.0, 3.0])]) == brute_clusters([(5, [-0.001, 1.0, 2.0, 3.0])])
    assert cluster(spark, []) == Counter()
    assert cluster(spark, [(1, None)]) == Counter()


def test_large_components_are_exact(spark):
    rng = random.Random(8)
    rows = [(i, [rng.choice([-1, 1]) * rng.random() * 10 ** rng.choice([0, 5, 6, 9]) for _ in range(4)]) for i in range(80)]
    assert cluster(spark, rows, 9) == brute_clusters(rows, 9)


def test_bounds_never_exceed_distances():
    rng = np.random.default_rng(1)
    vectors = rng.integers(-300, 300, (500, 64))
    axes = np.linalg.qr(rng.normal(size=(64, 16)))[0]
    rotation = centroids.Rotation(axes, vectors.mean(axis=0))
    turned, residual, norm = rotation.apply(vectors)
    middles = vectors[:40]
    t, r, n = rotation.apply(middles)
    stored = turned.astype(np.float32).astype(float)
    bound = ((stored[:, None] - t) ** 2).sum(2) + (residual[:, None] - r) ** 2 - centroids.MARGIN * (norm[:, None] + n)
    assert (bound <= ((vectors[:, None] - middles) ** 2).sum(2)).all()


# Licenses


def brute_license(rows):
    """Every start of every notice is tried, without an index; weights by the same definition of rarity."""
    cut = [re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER)) for _, text in rows]
    holding = Counter(w for words in cut for w in set(words))
    idf = lambda w: math.log((len(rows) + 2) / (holding[w] + 1))
    out = []
    for (doc_id, _), words in zip(rows, cut, strict=True):
        places = [(a, label) for label, p in licenses.PHRASES for a in range(len(words)) if words[a : a + len(p.split())] == p.split()]
        scores = [(label, 1.0) for _, label in places]
        for label, text, phrases in licenses.NOTICES:
            notice = text.split()
            keys = sorted(set(notice), key=lambda w: (-idf(w), w))[: licenses.KEYS]
            for start in range(-len(notice), len(words)):
                stand = [0 <= start + notice.index(w) < len(words) and words[start + notice.index(w)] == w for w in keys]
                stretch = words[max(start - licenses.SLACK, 0) : max(start + len(notice) + licenses.SLACK, 0)]
                if sum(stand) < licenses.AGREE or any(f" {p} " not in f" {' '.join(stretch)} " for p in phrases):
                    continue
                near = [w in words[max(start + i - 2, 0) : max(start + i + 3, 0)] for i, w in enumerate(notice)]
                share = sum(idf(w) for w, x in zip(notice, near, strict=True) if x) / sum(map(idf, notice))
                if share >= licenses.ACCEPTED:
                    scores.append((label, min(1.0, share)))
        starts = [a for a, _ in places]
        labels = sorted({label for label, _ in scores})
        out.append((
            doc_id, len(words), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({label for _, label in places})), ",".join(labels), round(max((s for _, s in scores), default=0.0), 9),
        ))
    return Counter(out)


def license_rows():
    rng = random.Random(3)
    prose = ["the", "software", "license", "version", "2", "of", "any", "red", "tree", "is", "free"]
    rows = []
    for number, (_, text, _) in enumerate(licenses.NOTICES):
        words = text.split()
        for change in range(4):
            edited = list(words)
            for _ in range(change):
                at = rng.randrange(len(edited))
                edited[at : at + 1] = rng.choice([[], [edited[at], "really"], ["changed"]])
            around = rng.choices(prose, k=rng.randint(0, 30))
            rows.append((10 * number + change, " ".join([*around, *edited, *rng.choices(prose, k=9)])))
    rows += [
        (900, "Released under the MIT License."), (901, "under the mit licenses, under the MIT-license; UNDER\nTHE MIT LICENSE"),
        (902, "CC BY-NC 4.0 cc by nc cc by nc"), (903, "Apache License, Version 2.0 apache license version 2"), (904, "ccbync under themit license"),
        (905, "under the mIt license Kite"), (906, "é under the mit licenseé"), (None, "cc by nc"), (None, None), (907, ""), (908, " .,\n"),
        (909, "cc by nc " * 3000), (910, "x" * 90000), (900, "Released under the MIT License."), (911, "\U0001f600cc by nc \U0001f600 cc by nc"),
        (912, "standing alone: version 2 0 of no license"),
    ]
    return rows


def test_licenses_match_brute_force(spark):
    rows = license_rows()
    docs = spark.createDataFrame([(a, b, ["x"], 1) for a, b in rows], "doc_id long, text string, words array<string>, label int")
    got = [tuple(r) for r in licenses.digest(licenses.scan(docs.repartition(4))).collect()]
    assert Counter((*r[:-1], round(r[-1], 9)) for r in got) == brute_license(rows)


def test_edited_notices_are_labelled(spark):
    whole = [(label, " ".join(["before", text, "after it"])) for label, text, _ in licenses.NOTICES]
    docs = spark.createDataFrame([*whole, ("none", "the public software license is free of any version")], "doc_id string, text string")
    got = {(r.doc_id, r.labels) for r in licenses.digest(licenses.scan(docs)).collect()}
    assert all(label in labels.split(",") for label, labels in got if label != "none")
    assert ("none", "") in got


def test_license_scan_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert licenses.digest(licenses.scan(empty)).collect() == []
    one = spark.createDataFrame([("a", "cc by nc")], "doc_id string, text string")
    assert [r.first_word for r in licenses.digest(licenses.scan(one)).collect()] == [0]
