"""Concatenate and cut: documents end to end in one token stream, cut into equal windows.

A first pass turns every input partition into token ids, numbers them within the
partition and stores them. The partition totals, one row a partition, give each
partition its place in the stream by a prefix sum. A second pass over the stored
ids cuts windows by arithmetic alone, so no text and no id is ever shuffled; a
document that crosses a window boundary yields one piece on each side.

Defined cases: a null or empty text is its end mark alone. Rows with equal or
null ids are documents of their own. An empty table gives no pieces. Columns
other than the id and the text are ignored.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import chain
from unicodedata import is_normalized

import numpy as np
import pandas as pd
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm.common import chunks, map_text, stored, text_of

# A worker keeps its encoder, so these bound what stays in memory: some 100 MB. Each is
# the size of one generation of a cache, which keeps two.
MAX_CACHED_PIECES = 200_000

# The same pieces of lower-case texts of Latin-1 letters, by a quicker matcher: letters, digits, and what is neither.
_LETTERS, _DIGITS, _SPACES = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
LATIN_PIECE = re.compile(f"[{_LETTERS}]+|[{_DIGITS}]|[^{_SPACES}{_LETTERS}{_DIGITS}]+")
PIECE = regex.compile(r"\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
WORD_END = "</w>"
_ENCODERS: dict[str, WordEncoder] = {}


def is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Generations(dict):
    """A cache of bounded size that keeps what is used.

    When the young generation is full it becomes the old one, and the old one goes; what
    is found in the old one moves to the young. So frequent words are never lost.
    """

    def __init__(self, most: int) -> None:
        super().__init__()
        self.most, self.old = most, {}

    def absent(self, keys: set) -> set:
        """Those of the keys that are in neither generation; the others are young afterwards."""
        if len(self) > self.most:
            self.old = dict(self)
            self.clear()
        wanted = keys.difference(self)
        known = {key for key in wanted if key in self.old}
        self.update(zip(known, map(self.old.__getitem__, known), strict=True))
        return wanted - known


class WordEncoder:
    """Ids of texts under a tokenizer that drops case and never merges across white space.

    Texts are put together from pieces, which repeat, so each distinct one is encoded once.
    A worker process keeps its encoder for all its tasks, with a cache of two generations.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.pieces: dict[str, bytes] = Generations(MAX_CACHED_PIECES)

    @classmethod
    def of(cls, path: str) -> WordEncoder:
        if path not in _ENCODERS:
            _ENCODERS[path] = cls(path)
        return _ENCODERS[path]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        split = [self.pieces_of(text) for text in texts]
        self.learn(self.pieces.absent(set(chain.from_iterable(split))))
        ids = self.pieces.__getitem__
        return [b"".join(map(ids, pieces)) for pieces in split]

    def learn(self, new: set[str]) -> None:
        needed = sorted(new)
        letters = [piece for piece in needed if piece.isalpha()]
        rest = [piece for piece in needed if not piece.isalpha()]
        self.pieces.update(zip(letters, self.runs(letters), strict=True))
        self.pieces.update(zip(rest, self.singly(rest), strict=True))

    @classmethod
    def pieces_of(cls, text: str) -> list[str]:
        """The pieces of a text in order: of the whole text where it is plain, else word by word."""
        if cls.plain(text):
            lowered = text.lower()
            return (LATIN_PIECE if is_latin(lowered) else PIECE).findall(lowered)
        words = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        return list(chain.from_iterable(map(cls.parts, words)))

    @staticmethod
    def plain(text: str) -> bool:
        """Whether the tokenizer encodes letters, digits and other signs of a text apart from each other."""
        if "'" in text or "<|" in text or "\u03a3" in text or "\u0130" in text:
            return False
        return text.isascii() or (is_normalized("NFC", text) and is_normalized("NFC", text.lower()))

    @classmethod
    def parts(cls, word: str) -> list[str]:
        """What the tokenizer encodes apart from each other; the word itself where that is not plain."""
        return PIECE.findall(word.lower()) if cls.plain(word) else [word]

    def singly(self, words: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(x.ids, dtype="<u4").tobytes() for x in found]

    def runs(self, words: list[str]) -> list[bytes]:
        """As `singly`, in one call: each word of letters closes with its only end-of-word token."""
        if not words:
            return []
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, dtype="<u4")
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(words) or ends[-1] != len(ids):
            return self.singly(words)
        raw, starts = ids.tobytes(), [0, *(4 * ends[:-1]).tolist()]
        return [raw[a:b] for a, b in zip(starts, (4 * ends).tolist(), strict=True)]


def tokenized(docs: DataFrame, tokenizer: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """(part, start, id, n_tokens, ids): every document's place within its input partition."""
    id_type = docs.schema[id_col].dataType
    schema = (
        T.StructType()
        .add("part", T.IntegerType())
        .add("start", T.LongType())
        .add("id", id_type)
        .add("n_tokens", T.LongType())
        .add("ids", T.BinaryType())
    )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, part, start = WordEncoder.of(tokenizer), TaskContext.get().partitionId(), 0
        end = end_id.to_bytes(4, "little")
        for frame in chunks(frames, 1000):
            ids = [found + end for found in encoder.encode(frame["text"].tolist())]
            sizes = pd.Series([len(x) // 4 for x in ids], dtype="int64")
            places = start + sizes.cumsum() - sizes
            start += int(sizes.sum())
            yield pd.DataFrame(
                {"part": part, "start": places, "id": frame["id"].to_numpy(), "n_tokens": sizes, "ids": ids}
            )

    return map_text(docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")), run, schema)


def pack(
    docs: DataFrame,
    tokenizer: str,
    length: int = 2048,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row a piece: id, start (in its document), length, ids, doc_tokens, sequence_id, offset.

    Every sequence but the last is full, so the padding of the whole table is
    below one sequence.
    """
    tokens = stored(tokenized(docs, tokenizer, end_id, id_col, text_col), "tokens")
    totals = tokens.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    # One row an input partition, whatever the partitions hold.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    # The map over partitions has a row for each of them, tens of bytes: a bounded broadcast.
    placed = tokens.join(F.broadcast(bases), "part").withColumn("at", F.col("base") + F.col("start"))
    cut = placed.withColumn(
        "sequence_id",
        F.explode(F.sequence(F.expr(f"at div {length}"), F.expr(f"(at + n_tokens - 1) div {length}"))),
    )
    first = F.greatest(F.col("sequence_id") * length, F.col("at"))
    last = F.least((F.col("sequence_id") + 1) * length, F.col("at") + F.col("n_tokens"))
    pieces = cut.select(
        F.col("id").alias(id_col),
        (first - F.col("at")).alias("start"),
        (last - first).alias("length"),
        "ids",
        F.col("n_tokens").alias("doc_tokens"),
        "sequence_id",
        (first - F.col("sequence_id") * length).alias("offset"),
    )
    return pieces.withColumn("ids", F.expr("substring(ids, cast(start * 4 + 1 as int), cast(length * 4 as int))"))


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids): each window's ids in order; a group is at most one window of pieces."""
    parts = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.expr("array_join(transform(parts, p -> hex(p.ids)), '')").alias("ids")).select(
        "sequence_id", F.unhex("ids").alias("ids")
    )


def piece_digest(pieces: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    crc = F.crc32("ids").alias("ids_crc32")
    return pieces.select(id_col, "start", "length", crc, "doc_tokens", "sequence_id", "offset")
