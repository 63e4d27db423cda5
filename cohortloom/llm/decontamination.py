"""Find benchmark items in training documents, edited or not.

Items give word n-grams, and every one is a seed: a choice among them, by rarity or
otherwise, can fall on just the edited places. A document and an item that share a
gram are aligned by Smith-Waterman around the shared grams, unless the words alone
rule the threshold out: no alignment scores more than the best run of an item's words
that the text holds, or of a text's words that the item holds, less what the words
between them cost at least. The score is the best local alignment over that of
the whole item, so replaced, dropped and inserted words cost a little each.

The items are the fixed side: they are read in blocks of bounded size, each block
goes to every task and meets all documents. Documents are never shuffled, and no
item, however often copied, gathers rows anywhere.

Defined cases: null and empty texts match nothing. Words are runs of letters and
digits in lower case. Items of fewer than `n` words identify nothing and match
nothing. Rows with equal or null ids are documents of their own; equal rows give
equal results. An empty table on either side gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm.common import chunks, text_of

WORD = re.compile(r"[^\W_]+")
BLOCK_CHARS = 16_000_000  # of items in one block
MATCH, MISMATCH, GAP = 1.0, -0.5, -0.5
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class Items:
    """A block of items as word numbers, with the items of every gram."""

    def __init__(self, rows: list[tuple[int, str]], n: int) -> None:
        self.n = n
        self.vocabulary: dict[str, int] = {}
        self.ids: list = []
        self.words: list[np.ndarray] = []
        for item_id, text in rows:
            words = WORD.findall(text.lower())
            if len(words) >= n:
                self.ids.append(item_id)
                numbers = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
                self.words.append(np.array(numbers, dtype=np.int64))
        self.sizes = np.array([len(w) for w in self.words], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.concatenate([np.empty(0, dtype=np.int64), *self.words])
        own = [np.unique(self.grams(w)) for w in self.words]
        self.codes = np.unique(np.concatenate([np.empty(0, dtype=np.uint64), *own]))
        self.own = [np.searchsorted(self.codes, grams) for grams in own]
        held = np.concatenate([np.empty(0, dtype=np.int64), *self.own])
        by = np.repeat(np.arange(len(own)), [len(g) for g in own])[np.argsort(held, kind="stable")]
        self.holders = np.split(by, np.cumsum(np.bincount(held, minlength=len(self.codes)))[:-1])

    def grams(self, words: np.ndarray) -> np.ndarray:
        """One odd 64-bit number a gram, whatever its length; 0 where it has a word that no item has."""
        size = len(words) - self.n + 1
        if size <= 0:
            return np.empty(0, dtype=np.uint64)
        parts = [words[i : i + size] for i in range(self.n)]
        out = np.zeros(size, dtype=np.uint64)
        for part in parts:
            out = (out ^ (out >> np.uint64(29)) ^ part.astype(np.uint64)) * MULTIPLIER
        out |= np.uint64(1)
        out[np.minimum.reduce(parts) < 0] = 0
        return out

    def numbers(self, text: str) -> np.ndarray:
        get = self.vocabulary.get
        return np.array([get(w, -1) for w in WORD.findall(text.lower())], dtype=np.int64)

    def hits(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in the text, gram indices) of the items' grams."""
        grams = self.grams(words)
        at = np.flatnonzero(grams)
        if not len(at) or not len(self.codes):
            return at[:0], at[:0]
        index = np.minimum(np.searchsorted(self.codes, grams[at]), len(self.codes) - 1)
        same = self.codes[index] == grams[at]
        return at[same], index[same]

    def near(self, words: np.ndarray, threshold: float) -> Iterator[tuple[int, list[int]]]:
        """(item, places of its grams) for each item that shares a gram with a text and whose words allow the threshold."""
        at, grams = self.hits(words)
        if not len(at):
            return
        items = np.unique(np.concatenate([self.holders[g] for g in np.unique(grams).tolist()]))
        present = np.zeros(len(self.vocabulary) + 1, dtype=bool)
        present[words] = True
        present[-1] = False  # a word that no item has
        sizes = self.sizes[items]
        first = np.cumsum(sizes) - sizes
        inside = np.repeat(self.starts[items] - first, sizes) + np.arange(sizes.sum())
        found = np.add.reduceat(present[self.flat[inside]], first, dtype=np.int64)
        for item in items[found * MATCH >= threshold * sizes * MATCH].tolist():
            own, least = self.words[item], threshold * len(self.words[item]) * MATCH
            shared = np.zeros(len(present), dtype=bool)
            shared[own] = True
            if best_run(present[own]) >= least and best_run(shared[words]) >= least:
                yield item, at[np.isin(grams, self.own[item])].tolist()


def best_run(shared: np.ndarray) -> float:
    """The most that any run of words can score when only the shared ones can match."""
    total = np.concatenate([[0.0], np.cumsum(np.where(shared, MATCH, max(MISMATCH, GAP)))])
    return float((total - np.minimum.accumulate(total)).max())


def align(item: np.ndarray, text: np.ndarray) -> tuple[float, int]:
    """(best local score, end of the alignment in the text) of Smith-Waterman over words."""
    steps = np.arange(len(text) + 1) * -GAP
    row, best, end = np.zeros(len(text) + 1), 0.0, 0
    for word in item:
        here = np.zeros(len(text) + 1)
        here[1:] = np.maximum(row[:-1] + np.where(text == word, MATCH, MISMATCH), row[1:] + GAP)
        np.maximum(here, 0, out=here)
        # A gap in the item of any length: the best earlier cell less its distance.
        row = np.maximum.accumulate(here + steps) - steps
        at = int(row.argmax())
        if row[at] > best:
            best, end = float(row[at]), at
    return best, end


def regions(places: list[int], size: int, total: int) -> list[tuple[int, int]]:
    """Parts of a text around shared grams that may hold one alignment, apart from each other."""
    out: list[list[int]] = []
    for at in sorted(places):
        low, high = max(0, at - 2 * size), min(total, at + 2 * size)
        if out and low <= out[-1][1]:
            out[-1][1] = high
        else:
            out.append([low, high])
    return [(a, b) for a, b in out]


def block_matches(docs: DataFrame, items: Items, threshold: float) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)
    id_field = T.StructField("id", docs.schema["id"].dataType)
    schema = (
        T.StructType([id_field])
        .add("item", T.IntegerType())
        .add("score", T.DoubleType())
        .add("first_word", T.LongType())
        .add("end_word", T.LongType())
    )

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for frame in chunks(frames, 1000):
            out = []
            for doc_id, text in zip(frame["id"], frame["text"], strict=True):
                words = own.numbers(text)
                for item, places in own.near(words, threshold):
                    size = len(own.words[item])
                    parts = regions(places, size, len(words))
                    (best, end), low = max((align(own.words[item], words[a:b]), a) for a, b in parts)
                    if best >= threshold * size * MATCH:
                        out.append((doc_id, item, best / (size * MATCH), max(0, low + end - size), low + end))
            if out:
                yield pd.DataFrame(out, columns=["id", "item", "score", "first_word", "end_word"])

    return docs.select("id", "text").mapInPandas(score, schema)


def matches(
    docs: DataFrame,
    items: DataFrame,
    n: int = 3,
    threshold: float = 0.5,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
) -> DataFrame:
    """(id, item, score, first_word, end_word): a row for each document and item that align well enough.

    `score` is 1 for a whole unedited copy. The words at which the alignment ends are exact, where it begins is
    estimated from the item's length.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    own = items.select(F.col(item_col).alias("item_id"), text_of(text_col).alias("text"))
    total = own.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = total // BLOCK_CHARS + 1
    out = None
    for block in range(blocks):
        part = own.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        found = Items([(r.item_id, r.text) for r in part.collect()], n)  # at most about BLOCK_CHARS
        names = found.ids
        scored = block_matches(rows, found, threshold)
        named = scored.join(F.broadcast(_names(docs, names, own)), "item").drop("item")
        out = named if out is None else out.unionByName(named)
    return out.select(F.col("id").alias(id_col), F.col("item_id").alias(item_col), "score", "first_word", "end_word")


def _names(docs: DataFrame, names: list, own: DataFrame) -> DataFrame:
    """The items of one block by their number in it."""
    schema = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", own.schema["item_id"].dataType)])
    return docs.sparkSession.createDataFrame(list(enumerate(names)), schema)


def without_matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that hold no item. A document is known by its id and its text, so that null ids count too."""
    keyed = docs.select(F.struct("*").alias("doc"), F.xxhash64(F.col(id_col).cast("string"), text_col).alias("key"))
    rows = keyed.select(F.col("key").alias(id_col), F.col(f"doc.{text_col}").alias(text_col))
    bad = matches(rows, items, id_col=id_col, text_col=text_col, **options).select(F.col(id_col).alias("key")).distinct()
    return keyed.join(bad, "key", "left_anti").select("doc.*")
