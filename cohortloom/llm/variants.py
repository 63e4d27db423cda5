"""Spelling variants: words one edit apart, through pairs of trie nodes.

Words are counted over all documents. Sorted, they are a trie in preorder: a word shares
with the one before it the nodes of their common beginning, and its other beginnings are
new nodes. Every task numbers the nodes of its stretch of the sorted words; nodes that
reach over an edge between stretches take their number from where they begin, which the
first and last words of the stretches tell. Reversed words give the nodes of endings.

A word then is a row of integer pairs: (node before a position, node behind it) with the
position skipped, and (node before, node behind) between two positions. Words with the
same skipping pair differ in one replaced letter; a word whose inner pair is another's
skipping pair lacks one letter of it. No comparison of strings follows, none is missed
and none is wrong. Words of one skipping pair differ in one letter, so there are at most
as many as letters (`LETTERS`), and one word with that inner pair: groups are bounded by
the alphabet, whatever the table holds.

Defined cases: a null text has no words; a null id counts as empty text where an id is
hashed. Repeated rows count as often as they stand. Among near words of equal count the
smallest by code points is the form. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from os.path import commonprefix

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import stored, text_of

# The letters of words, and how one run in 199 loses a letter.
LETTERS = r"A-Za-zÀ-ÿ"
DAMAGED = 199

STRETCH = 40  # bits for the nodes or words of one task
RATIO = 5  # a form is that much more frequent at least


def plain_lower(word: Column) -> Column:
    """A-Z in lower case, other letters as they are."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.lower(word) == word, word).otherwise(F.translate(word, upper, upper.lower()))


def damaged(word: Column, doc_id: Column) -> Column:
    """The word, less one letter where the hash of document and word says so."""
    hashed = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word).cast("binary"))
    at = (hashed % F.char_length(word)).cast("int")
    shorter = F.concat(F.left(word, at), F.substring(word, at + 2, F.char_length(word)))
    return F.when(hashed % DAMAGED == 0, shorter).otherwise(word)


def counted_words(
    docs: DataFrame, shortest: int = 6, least: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(word, n) of words of at least `shortest` letters and `least` occurrences."""
    # A match is as long as it can be, so a run of fewer letters is no match and a longer one is whole.
    runs = F.expr(f"regexp_extract_all(text, '[{LETTERS}]{{{shortest},}}', 0)")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(f"`{text_col}`").alias("text"))
    words = rows.select("id", F.explode(runs).alias("run")).select("id", plain_lower(F.col("run")).alias("run"))
    words = words.select(damaged(F.col("run"), F.col("id")).alias("word")).where(F.char_length("word") >= shortest)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def _edges(ordered: DataFrame) -> list[tuple[int, str, str]]:
    """(stretch, first word, last word): one row a task."""
    rows = ordered.groupBy("stretch").agg(F.min("key").alias("first"), F.max("key").alias("last")).collect()
    return sorted((r.stretch, r.first, r["last"]) for r in rows)


class Nodes:
    """Numbers of trie nodes in one stretch of sorted words.

    A node that is a beginning of the stretch's last word may go on in the next stretch,
    so its number says (stretch, length); all others are counted. One that the stretch
    shares with the end of the stretch before takes its number from there.
    """

    def __init__(self, stretch: int, last: str, inherited: list[int]):
        self.base, self.last, self.inherited = stretch << STRETCH, last, inherited
        # Longest-lived nodes first: the numbers up to the last word's length are set aside.
        self.next = self.base + len(last) + 1
        self.word, self.path = "", inherited[:1] or [self.base]

    def of(self, word: str, first: str) -> list[int]:
        """Numbers of the beginnings of a word, the empty one included."""
        shared = len(commonprefix((self.word, word)))
        ahead = len(commonprefix((word, self.last)))
        old = min(len(commonprefix((word, first))), len(self.inherited) - 1)
        path = self.path[: shared + 1]
        for length in range(shared + 1, len(word) + 1):
            if length <= old:
                path.append(self.inherited[length])
            elif length <= ahead:
                path.append(self.base + length)
            else:
                path.append(self.next)
                self.next += 1
        self.word, self.path = word, path
        return path


def _inherited(edges: list[tuple[int, str, str]]) -> dict[int, list[int]]:
    """Numbers of the nodes that each stretch shares with the one before: one path a task."""
    result, ending, before = {}, [], ""
    for stretch, first, last in edges:
        shared = ending[: len(commonprefix((before, first))) + 1]
        result[stretch] = shared
        own = min(len(commonprefix((first, last))), len(shared) - 1)
        ending = [shared[i] if i <= own else (stretch << STRETCH) + i for i in range(len(last) + 1)]
        before = last
    return result


def sorted_stretches(words: DataFrame, key: Column, name: str) -> DataFrame:
    """(key, other columns, stretch), sorted within stretches that follow each other; stored, so that stretches stay."""
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = words.withColumn("key", key).repartitionByRange(parts, "key").sortWithinPartitions("key")
    return stored(ranged.withColumn("stretch", F.spark_partition_id().cast("long")), name)


def with_nodes(words: DataFrame, key: Column, name: str) -> DataFrame:
    """(word, n, number, nodes): nodes of all beginnings of the key, and a number that ascends with the key."""
    ordered = sorted_stretches(words, key, name)
    edges = _edges(ordered)
    inherited = _inherited(edges)
    places = {stretch: (first, last) for stretch, first, last in edges}

    def number(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state, at = {}, {}
        for frame in frames:
            numbers, paths = [], []
            for stretch, word in zip(frame.stretch.tolist(), frame.key.tolist(), strict=True):
                if stretch not in state:
                    first, last = places[stretch]
                    state = {stretch: Nodes(stretch, last, inherited[stretch])}
                    at = {stretch: stretch << STRETCH}
                paths.append(list(state[stretch].of(word, places[stretch][0])))
                numbers.append(at[stretch])
                at[stretch] += 1
            yield pd.DataFrame({"word": frame.word, "n": frame.n, "number": numbers, "nodes": paths})

    # Dealt by stretch: a scan may split or join the files of stretches.
    dealt = ordered.repartition("stretch").sortWithinPartitions("stretch", "key")
    return stored(dealt.mapInPandas(number, "word string, n bigint, number bigint, nodes array<bigint>"), f"{name}-nodes")


def pairs(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((number, word, n), (before, behind, entry)): every word's pairs of trie nodes.

    An entry has number, n, `inner` (between two positions, none skipped) and `first`:
    of equal letters in a row one skipped position stands for all, so that a word that
    lacks one of them is met once.
    """
    begins = with_nodes(words, F.col("word"), "begins")
    ends = with_nodes(words, F.reverse("word"), "ends").select("word", F.col("nodes").alias("ends"))
    both = begins.join(ends, "word").withColumn("size", F.char_length("word")).withColumn("letters", F.split("word", ""))

    def entry(before: Column, behind: Column, inner: bool, first: Column) -> Column:
        facts = F.struct("number", "n", F.lit(inner).alias("inner"), first.alias("first"))
        return F.struct(before.alias("before"), behind.alias("behind"), facts.alias("entry"))

    def node(nodes: str, at: Column) -> Column:
        return F.get(F.col(nodes), at)

    def skipping(i: Column) -> Column:
        first = ~F.coalesce(F.get("letters", i) == F.get("letters", i - 1), F.lit(False))
        return entry(node("nodes", i), node("ends", F.col("size") - 1 - i), False, first)

    def between(i: Column) -> Column:
        return entry(node("nodes", i), node("ends", F.col("size") - i), True, F.lit(False))

    skips = F.transform(F.sequence(F.lit(0), F.col("size") - 1), skipping)
    inners = F.transform(F.sequence(F.lit(0), F.col("size")), between)
    return begins.select("number", "word", "n"), both.select(F.inline(F.concat(skips, inners)))


def near_words(pairs_of: DataFrame) -> DataFrame:
    """(number, n_near, best): how many words are near, and the most frequent one's count and negated number."""
    groups = pairs_of.groupBy("before", "behind").agg(F.collect_list("entry").alias("entries")).where(F.size("entries") > 1)

    def met(m: Column) -> Column:
        lacking = F.filter("entries", lambda x: ~x["inner"] & x["first"])
        others = F.filter("entries", lambda x: (x["number"] != m["number"]) & (~x["inner"] | m["first"]))
        return F.when(m["inner"], lacking).otherwise(others)

    members = groups.select(F.explode(F.transform("entries", lambda m: F.struct(m["number"].alias("number"), met(m).alias("met")))).alias("m"))
    found = members.select(
        "m.number",
        F.size("m.met").alias("n_near"),
        F.array_max(F.transform("m.met", lambda x: F.struct(x["n"].alias("n"), (-x["number"]).alias("negated")))).alias("best"),
    )
    return found.where("n_near > 0").groupBy("number").agg(F.sum("n_near").alias("n_near"), F.max("best").alias("best"))


def roots(forms: DataFrame, most: int) -> DataFrame:
    """(number, root) by following (number, form) to the end.

    Counts grow `RATIO`-fold with every step, so there are few; pointers double theirs each round.
    """
    steps = max(1, math.ceil(math.log(max(most, 2), RATIO)))
    up = forms.select("number", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps))):
        further = up.select(F.col("number").alias("root"), F.col("root").alias("_further"))
        up = stored(up.join(further, "root", "left").select("number", F.coalesce("_further", "root").alias("root")), "roots")
    return up


def group(words: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) from (word, n): near words within one edit, and what each is a variant of."""
    known, pairs_of = pairs(stored(words, "words"))
    near = stored(near_words(pairs_of), "near")
    facts = known.join(near, "number", "left")
    forms = facts.where(F.col("best.n") >= RATIO * F.col("n")).select(
        "number", (-F.col("best.negated")).alias("form"), F.col("best.n").alias("form_n")
    )
    forms = stored(forms, "forms")
    most = known.agg(F.max("n")).first()[0] or 0
    linked = forms.join(roots(forms, most), "number")
    # Inner joins of the variants alone: the words without a form never meet a null key.
    for column in ("form", "root"):
        named = known.select(F.col("number").alias(column), F.col("word").alias(f"{column}_word"))
        linked = linked.join(named, column)
    linked = linked.select("number", F.col("form_word").alias("form"), F.col("root_word").alias("root"), "form_n")
    return facts.join(linked, "number", "left").select(
        "word",
        "form",
        F.coalesce("root", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        "form_n",
    )
