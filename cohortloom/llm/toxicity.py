"""Toxicity from a learned lexicon, matched through Levenshtein automata.

The lexicon comes from labelled documents: words, and word beginnings shared by a
family of words, that toxic documents hold far more often than clean ones, and too
often for chance. Its words form a trie, and Levenshtein automata are intersected with
it, so that misspelled terms are found without listing their variants; a misspelling
that clean documents use as a word of its own does not count. Around every match a window of text tells quotation
(quote marks, reporting words) from abuse (address), and weighs the match. A logistic
curve over a document's weighted matches gives its score.

The fit uses a bounded sample of labelled documents: two thirds for the lexicon, one
third for the curve.

Defined cases: a null or empty text has no match and scores what clean text scores.
Rows with equal or null ids are scored one by one. Columns other than the text are
never read. Without documents of both labels in the sample every score is the share
of toxic ones.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import stored, text_of

WORD = re.compile(r"[^\W_]+")
MIN_STEM = 4
MIN_SUPPORT = 5
MIN_ODDS = 2.5
MIN_GAIN = 15.0  # about one chance in 10,000 for a term that means nothing
WINDOW = 60  # characters on each side of a match
CACHED_WORDS = 500_000
# Marks and words of quotation and of address.
QUOTES = "\"“”„«»"
REPORTING = frozenset("said says quote quoted called word term wrote dit mot dijo palabra sagte wort".split())
ADDRESS = frozenset("you your youre tu vous toi usted tú du ihr dich euch".split())
QUOTED, REPORTED, ADDRESSED, MISSPELLED = 0.5, 0.7, 1.2, 0.7


def edits_for(size: int) -> int:
    return 0 if size < 5 else 1 if size < 9 else 2


def stem_edits(size: int) -> int:
    """Fewer than for words: "moro" is a misspelled moron, but no beginning of its family."""
    return edits_for(size - 2)


class TrieAutomaton:
    """The strings within each term's edits of some term: the lexicon trie under a Levenshtein automaton.

    A state holds the trie nodes that the letters so far may have reached, with the
    fewest edits for each; a node is left out once its edits exceed what any term below
    it allows. A stem is a term that any ending may follow: once met within its edits it
    stays met, and the walk goes on for closer terms. States and steps are built when a word first needs them and then kept,
    so that a word costs one lookup a letter and most words end after a few.
    """

    def __init__(self, terms: dict[str, float], stems: dict[str, float] | None = None) -> None:
        self.children: list[dict[str, int]] = [{}]
        self.allowed = [0]
        self.ends: list[tuple[str, float] | None] = [None]
        self.open: list[tuple[str, float] | None] = [None]
        for term, weight, ends in [*((t, w, self.ends) for t, w in terms.items()), *((t, w, self.open) for t, w in (stems or {}).items())]:
            node, most = 0, edits_for(len(term)) if ends is self.ends else stem_edits(len(term))
            self.allowed[0] = max(self.allowed[0], most)
            for letter in term:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.allowed.append(0)
                    self.ends.append(None)
                    self.open.append(None)
                node = self.children[node][letter]
                self.allowed[node] = max(self.allowed[node], most)
            ends[node] = (term, weight)
        self.numbers: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.steps: list[dict[str, int]] = []
        self.found: list[tuple[str, float, int] | None] = []
        self.met: list[tuple[int, float, str] | None] = []
        self.start = self.state({0: 0}, None)

    def state(self, reached: dict[int, int], met: tuple[int, float, str] | None) -> int:
        """The number of the state of these nodes and all that leaving out letters of terms adds."""
        waiting = list(reached)
        while waiting:
            node = waiting.pop()
            for child in self.children[node].values():
                edits = reached[node] + 1
                if edits <= self.allowed[child] and edits < reached.get(child, edits + 1):
                    reached[child] = edits
                    waiting.append(child)
        nodes = tuple(sorted(reached.items()))
        stems = [(e, -self.open[n][1], self.open[n][0]) for n, e in nodes if self.open[n] and e <= stem_edits(len(self.open[n][0]))]
        met = min([*stems, *([met] if met else [])], default=None)
        key = (nodes, met)
        if key not in self.numbers:
            self.numbers[key] = len(self.states)
            self.states.append(nodes)
            self.met.append(met)
            self.steps.append({})
            whole = [(e, -self.ends[n][1], self.ends[n][0]) for n, e in nodes if self.ends[n] and e <= edits_for(len(self.ends[n][0]))]
            best = min([*whole, *([met] if met else [])], default=None)
            self.found.append(best and (best[2], -best[1], best[0]))
        return self.numbers[key]

    def step(self, number: int, letter: str) -> int:
        known = self.steps[number].get(letter)
        if known is None:
            reached: dict[int, int] = {}
            for node, edits in self.states[number]:
                moves = [(child, edits + (own != letter)) for own, child in self.children[node].items()]
                for there, cost in [*moves, (node, edits + 1)]:
                    if cost <= self.allowed[there] and cost < reached.get(there, cost + 1):
                        reached[there] = cost
            known = self.steps[number][letter] = self.state(reached, self.met[number])
        return known

    def match(self, word: str) -> tuple[str, float, int] | None:
        """(term, weight, edits) of the closest term."""
        at = self.start
        for letter in word:
            at = self.step(at, letter)
            if not self.states[at]:
                break
        return self.found[at]


@dataclass
class Lexicon:
    """Terms with weights. A term is a whole word, or a stem that any ending may follow."""

    words: dict[str, float]
    stems: dict[str, float]
    innocent: set[str] = field(default_factory=set)

    def __post_init__(self) -> None:
        self.automaton = TrieAutomaton(self.words, self.stems)
        self.stem_sizes = sorted({len(stem) for stem in self.stems})

    def match(self, word: str) -> tuple[str, float, int] | None:
        """(term, weight, edits) of the best match of a word in lower case."""
        if word in self.words:
            return (word, self.words[word], 0)
        for size in self.stem_sizes:
            if size <= len(word) and word[:size] in self.stems:
                return (word[:size], self.stems[word[:size]], 0)
        found = self.automaton.match(word)
        return found if found and word not in self.innocent else None


def context(text: str, start: int, end: int) -> float:
    """How far a match counts as abuse, from the text around it."""
    before, after = text[max(0, start - WINDOW) : start], text[end : end + WINDOW]
    before, after = before[before.rfind("\n") + 1 :], after.split("\n", 1)[0]
    weight = 1.0
    opened = sum(before.count(q) for q in QUOTES) % 2 == 1
    if opened and any(q in after for q in QUOTES):
        weight *= QUOTED
    near = set(WORD.findall(before)[-6:]) | set(WORD.findall(after)[:6])
    if near & REPORTING:
        weight *= REPORTED
    if near & ADDRESS:
        weight *= ADDRESSED
    return weight


class Reader:
    """Match features of documents; remembers the words it has met."""

    def __init__(self, lexicon: Lexicon) -> None:
        self.lexicon, self.known = lexicon, {}

    def features(self, text: str) -> list[float]:
        """(log of the matches' sum, log of the sum per 100 words, 1)."""
        low = text.lower()
        words = WORD.findall(low)
        if len(self.known) > CACHED_WORDS:
            self.known = {}
        distinct, known = set(words), self.known
        for word in distinct.difference(known):
            known[word] = self.lexicon.match(word)
        hits = {word for word in distinct if known[word] is not None}
        if not hits:
            return [0.0, 0.0, 1.0]
        total = 0.0
        for found in WORD.finditer(low):
            if found[0] in hits:
                _, weight, edits = known[found[0]]
                total += weight * MISSPELLED**edits * context(low, found.start(), found.end())
        return [math.log1p(total), math.log1p(100 * total / len(words)), 1.0]


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    curve: np.ndarray | None
    prior: float

    def scores(self, reader: Reader, texts: list[str]) -> np.ndarray:
        if self.curve is None:
            return np.full(len(texts), self.prior)
        rows = np.array([reader.features(text) for text in texts], dtype=float).reshape(-1, 3)
        return 1 / (1 + np.exp(-(rows @ self.curve)))


def terms_of(text: str) -> set[str]:
    """Words, closed by $, and their beginnings."""
    words = set(WORD.findall(text.lower()))
    return {w + "$" for w in words} | {w[:k] for w in words for k in range(MIN_STEM, min(len(w), 12))}


def counted(rows: DataFrame, only: dict | None) -> DataFrame:
    """(term, n): in how many documents each term occurs; only given terms where `only` is set."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        for frame in frames:
            for text in frame["text"]:
                terms = terms_of(text)
                total.update(terms if only is None else terms.intersection(only))
        if total:
            yield pd.DataFrame({"term": list(total), "n": list(total.values())})

    return rows.select("text").mapInPandas(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def gain(toxic: int, clean: int, n_toxic: int, n_clean: int) -> float:
    """Log-likelihood ratio (G squared) of a term's counts against equal frequency in both kinds of documents."""
    share, out = (toxic + clean) / (n_toxic + n_clean), 0.0
    for seen, of in ((toxic, n_toxic), (clean, n_clean)):
        for n, expected in ((seen, of * share), (of - seen, of * (1 - share))):
            out += 2 * n * math.log(n / expected) if n else 0.0
    return out


def build_lexicon(toxic: dict[str, int], clean: dict[str, int], n_toxic: int, n_clean: int, innocent: set[str] = frozenset()) -> Lexicon:
    odds = {
        term: math.log(((n + 0.5) / (n_toxic + 1)) / ((clean.get(term, 0) + 0.5) / (n_clean + 1)))
        for term, n in toxic.items()
    }
    strong = {t: w for t, w in odds.items() if w >= MIN_ODDS and gain(toxic[t], clean.get(t, 0), n_toxic, n_clean) >= MIN_GAIN}
    words = {term[:-1]: w for term, w in strong.items() if term.endswith("$")}
    one_word: Counter = Counter()  # the most frequent word with a beginning
    for term, n in toxic.items():
        if term.endswith("$"):
            for k in range(MIN_STEM, len(term)):
                one_word[term[:k]] = max(one_word[term[:k]], n)
    stems: dict[str, float] = {}
    for stem in sorted((t for t in strong if not t.endswith("$")), key=len):
        covered = any(stem[:k] in stems for k in range(MIN_STEM, len(stem)))
        if not covered and one_word[stem] < 0.9 * toxic[stem]:
            stems[stem] = strong[stem]
    return Lexicon(words, stems, set(innocent))


def fit(rows: DataFrame, penalty: float = 1e-3) -> ToxicityModel:
    """Fit on (id, text, label) rows, whose number the caller has bounded; label 1 marks a toxic document."""
    third = F.pmod(F.xxhash64("id", "text"), F.lit(3)) == 0
    sample = stored(rows.withColumn("fold", third), "toxicity-sample")
    counts = {(r.label, r.fold): r["count"] for r in sample.groupBy("label", "fold").count().collect()}
    n_toxic, n_clean = counts.get((1, False), 0), counts.get((0, False), 0)
    every = sum(counts.values())
    prior = sum(n for (label, _), n in counts.items() if label == 1) / every if every else 0.0
    if not n_toxic or not n_clean:
        return ToxicityModel(Lexicon({}, {}), None, prior)
    learn = sample.filter(~F.col("fold"))
    found = counted(learn.filter("label = 1"), None).filter(F.col("n") >= MIN_SUPPORT)
    toxic = {r.term: r.n for r in found.collect()}  # of a bounded sample
    clean = {r.term: r.n for r in counted(learn.filter("label = 0"), dict.fromkeys(toxic)).collect()}
    lexicon = build_lexicon(toxic, clean, n_toxic, n_clean)
    lexicon = Lexicon(lexicon.words, lexicon.stems, near_words(learn.filter("label = 0"), lexicon))

    def described(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(lexicon)
        for frame in frames:
            yield pd.DataFrame({"label": frame["label"], "x": [reader.features(text) for text in frame["text"]]})

    found = sample.filter("fold").select("label", "text").mapInPandas(described, "label int, x array<double>").collect()
    found = sorted((r.label, r.x) for r in found)
    x, y = np.array([r[1] for r in found], dtype=float).reshape(-1, 3), np.array([r[0] for r in found], dtype=float)
    curve = np.array([1.0, 1.0, math.log((prior + 1e-3) / (1 - prior + 1e-3))])
    for _ in range(50):  # Newton steps
        if not len(y):
            break
        p = 1 / (1 + np.exp(-np.clip(x @ curve, -30, 30)))
        slope = x.T @ (p - y) / len(y) + penalty * curve
        bend = (x * (p * (1 - p))[:, None]).T @ x / len(y) + penalty * np.eye(3)
        curve = curve - np.linalg.solve(bend, slope)
    return ToxicityModel(lexicon, curve, prior)


def near_words(rows: DataFrame, lexicon: Lexicon) -> set[str]:
    """Words of clean documents that would pass for misspelled terms."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[str] = set()
        for frame in frames:
            for text in frame["text"]:
                seen.update(WORD.findall(text.lower()))
        matched = [w for w in seen if (m := lexicon.match(w)) is not None and m[2] > 0]
        if matched:
            yield pd.DataFrame({"word": matched})

    return {r.word for r in rows.select("text").mapInPandas(run, "word string").distinct().collect()}


def score(model: ToxicityModel, text_col: str = "text") -> Column:
    """The score of a text, between 0 and 1; higher is more toxic."""

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        reader = Reader(model.lexicon)
        for series in texts:
            yield pd.Series(model.scores(reader, series.tolist()))

    return scored(text_of(text_col))
