"""Exact Jaccard similarity join by regions, pivots and triangle-inequality windows.

A document is a set of word shingles, and two link when their Jaccard distance is at
most the radius. Links are wanted up to connectivity: every document gets the
smallest id it can reach.

Regions. Pivot documents alone cannot cut this space, because unrelated documents all
lie at distance 1 from each other. So the first regions come from the symmetric
difference, which is a metric too: a linked pair differs in at most D shingles, D
following from their sizes. Shingles are dealt into D + 1 + r classes by hash; at
least r + 1 classes of a linked pair are equal. A document enters a cell for each class
but its r smallest, in an order that follows from what a class holds: the largest equal
class of a pair has r others below it in both documents, so every linked pair shares a
cell, whatever it holds, and a shingle alone in its class seldom makes a meeting. Shingles
that very many documents share are left out of the classes first, which only lowers the
difference. Cells that share
documents form a region. Most cells have one member, so tasks pack their cells by bucket
before the shuffle.

Pivots. Within a region documents are compared with pivots. Documents linked to a
pivot need no comparison with each other. The next pivots are documents outside the
largest component so far: two documents with a missing link are in different
components, so at least one of them is, and becomes a pivot in turn. When every
document outside the largest component has been one, the region is joined exactly.
Known distances to earlier pivots prune by the triangle inequality: documents whose
distances to any of them differ by more than the radius are not compared. A region
that does not fit a task, mostly a chain of documents that share passages, is first
narrowed: its documents meet anew by their rarest shingles, which gives smaller regions.
One that still does not fit is cut into Voronoi cells of its first pivots, dealt over
tasks, and a pivot is copied only to the cells within its window.

Documents with equal sets are one node throughout. Shingles and sets are known by
64-bit hashes.

Defined cases: null and blank texts have no shingles and link with nothing. Fewer
words than a shingle has are one shingle, of all words. Rows with equal ids link as
any others; their component is the smallest id. Null ids stand apart: they link, but
do not become a component's id while there is another. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm.common import chunks, discard, marked, salted_left_join, stored, text_of
from cohortloom.llm.graph import components

BLOCK = 4000  # documents in which a shingle's frequency is looked at together,
BLOCK_SHINGLES = 2_000_000  # or fewer, as long as their sets have so many shingles
BLOCK_CELLS = 500_000  # entries that are packed together
BUCKET_CELLS = 1_000_000  # entries that are met in one group
HOT_SHARE = 0.01
TABLE_SHARE = 0.002
TASK_SHINGLES = 3_000_000  # of a region joined within one task
MEASURED = 8  # pivots within a task whose distances to all members are kept
PIVOTS = 16  # first pivots of a larger region
MORE_PIVOTS = 4096  # pivots of a larger region in each later round
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
SEEN = 250_000  # sets that a task remembers having entered


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of a public 64-bit mixer)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sets of shingle hashes. Words are parted by ASCII white space; only A-Z change case.

    A word's hash is the sum over its bytes of a random number for the byte times one for
    its place in the word, taken for all words of a text at once.
    """

    SPACE = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))
    BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * MULTIPLIER)

    def __init__(self, k: int) -> None:
        self.k, self.places = k, np.empty(0, dtype=np.uint64)

    def numbers(self, text: str) -> np.ndarray:
        """The hashes of the words in order."""
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), dtype=np.uint8)
        inside = np.zeros(len(raw) + 2, dtype=np.int8)
        np.logical_not(self.SPACE[raw], out=inside[1:-1], casting="unsafe")
        edges = np.flatnonzero(np.diff(inside))
        starts, lengths = edges[::2], edges[1::2] - edges[::2]
        if not len(starts):
            return np.empty(0, dtype=np.uint64)
        if lengths.max() > len(self.places):
            self.places = mixed((np.arange(2 * int(lengths.max()), dtype=np.uint64) + np.uint64(1 << 32)) * MULTIPLIER) | np.uint64(1)
        firsts = np.cumsum(lengths) - lengths
        within = np.arange(lengths.sum()) - np.repeat(firsts, lengths)
        weighed = self.BYTES[raw[inside[1:-1].view(bool)]] * self.places[within]
        return mixed(np.add.reduceat(weighed, firsts) + lengths.astype(np.uint64))

    def shingles(self, text: str) -> np.ndarray:
        """The sorted distinct shingles."""
        numbers = self.numbers(text)
        if not len(numbers):
            return numbers
        k = min(self.k, len(numbers))
        out = np.full(len(numbers) - k + 1, k, dtype=np.uint64)
        for i in range(k):
            out = out * MULTIPLIER + numbers[i : i + len(out)]
        out = np.sort(mixed(out))
        new = np.ones(len(out), dtype=bool)
        np.not_equal(out[1:], out[:-1], out=new[1:])
        return out[new]


class Cells:
    """The cells that a set enters under a similarity threshold, given in percent."""

    def __init__(self, percent: int) -> None:
        self.percent, self.step = percent, math.log(100 / percent)
        self.schemes: dict[int, tuple[int, int]] = {}

    def scheme(self, number: int) -> tuple[int, int]:
        """(classes, r) for pairs whose larger set is in this size bucket."""
        if number not in self.schemes:
            largest = math.floor(math.exp((number + 1) * self.step) + 1e-9)
            differ = 2 * largest * (100 - self.percent) // (100 + self.percent)
            spare = max(3, math.ceil(0.025 * largest))
            self.schemes[number] = (differ + 1 + spare if differ else 0, spare)
        return self.schemes[number]

    def of(self, size: int, rest: np.ndarray) -> np.ndarray:
        """Cells of a set of `size` shingles, of which `rest` are not left out.

        Linked sets are in the same size bucket or in neighbouring ones; they meet under
        the scheme of the larger. Where no difference is allowed, sets link when equal.
        """
        bucket, out = math.floor(math.log(size) / self.step), []
        for number in (bucket, bucket + 1):
            classes, spare = self.scheme(number)
            if not classes:
                continue
            place = ((rest >> np.uint64(17)) % np.uint64(classes)).astype(np.int64)
            counts, sums = np.bincount(place, minlength=classes), np.zeros(classes, dtype=np.uint64)
            np.add.at(sums, place, rest)
            key = np.uint64(number << 40) + np.arange(classes, dtype=np.uint64)
            held = mixed(sums + mixed(key + (counts.astype(np.uint64) << np.uint64(52))))
            out.append(held[np.lexsort((held, counts))[spare:]])
        return np.concatenate(out) if out else np.empty(0, dtype=np.uint64)


def survey(rows: DataFrame, k: int) -> DataFrame:
    """(id, key, size, node) of every document, and (shingle, n) of shingles that stand out in a block.

    Within a block of documents, each different set counts once; a shingle stands out from
    HOT_SHARE of the block on. One pass over the texts serves both.
    """
    # Ids pass as text: a column of whole numbers with nulls would become floating in pandas.
    schema = T.StructType().add("id", T.StringType()).add("key", T.LongType())
    schema = schema.add("size", T.LongType()).add("node", T.LongType()).add("shingle", T.LongType()).add("n", T.LongType())
    nothing = {"id": None, "key": None, "size": None, "node": None}

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, block, documents, held = Shingler(k), {}, 0, 0
        for frame in chunks(frames, 1000):
            sets = [shingler.shingles(text) for text in frame["text"]]
            nodes = [set_number(own) for own in sets]
            described = {"id": frame["id"].to_numpy(), "key": frame["key"].to_numpy(), "size": list(map(len, sets)), "node": nodes}
            yield pd.DataFrame({**described, "shingle": None, "n": None}, columns=schema.names)
            for node, own in zip(nodes, sets, strict=True):
                if node not in block:
                    block[node] = own
                    held += len(own)
            documents += len(frame)
            if documents >= BLOCK or held >= BLOCK_SHINGLES:
                yield from standing_out(block, documents)
                block, documents, held = {}, 0, 0
        yield from standing_out(block, documents)

    def standing_out(block: dict[int, np.ndarray], documents: int) -> Iterator[pd.DataFrame]:
        if block:
            values, counts = np.unique(np.concatenate(list(block.values())), return_counts=True)
            hot = counts >= max(20, HOT_SHARE * documents)
            if hot.any():
                found = {"shingle": values[hot].astype(np.int64), "n": counts[hot].astype(np.int64)}
                yield pd.DataFrame({**nothing, **found}, columns=schema.names)

    return rows.withColumn("id", F.col("id").cast("string")).mapInPandas(run, schema).withColumn("id", F.col("id").cast(rows.schema["id"].dataType))


def frequent_shingles(surveyed: DataFrame, documents: int) -> np.ndarray:
    """Sorted shingles that stand out in blocks and are frequent in the whole table.

    Those whose counts add up to TABLE_SHARE of all documents, which can be at most
    (mean set size) / TABLE_SHARE, whatever the table's size.
    """
    found = surveyed.where("shingle IS NOT NULL").groupBy("shingle").agg(F.sum("n").alias("n"))
    hot = [row.shingle for row in found.where(F.col("n") >= TABLE_SHARE * documents).collect()]
    return np.sort(np.array(hot, dtype=np.int64).astype(np.uint64))


ENTRY = 6  # bytes of a cell in a packed block, besides those that its bucket says
PACKED = "bucket long, cells binary, owners binary, nodes binary, a binary, b binary"


def bucket_bits(entries: int) -> int:
    """The bits of a cell that number its bucket: a bucket has at most about BUCKET_CELLS entries."""
    return max(5, math.ceil(math.log2(max(1, entries) / BUCKET_CELLS)))


def partitions(frame: DataFrame, bits: int) -> int:
    """As many partitions as buckets, so that a task's share does not grow with the table."""
    return max(1 << bits, int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def packed(cells: np.ndarray, owners: np.ndarray, ordered: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """(cells, owners, nodes) in bytes; owners are numbers into `ordered`, of which the nodes list those in use."""
    entries = np.ascontiguousarray(cells).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :ENTRY]
    used, short = np.unique(owners, return_inverse=True)
    return entries.tobytes(), short.astype("<u4" if len(used) > 65535 else "<u2").tobytes(), ordered[used].tobytes()


def unpacked(entries: bytes, owners: bytes, listed: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The cells of one bucket and the node of each."""
    wide = np.zeros((len(entries) // ENTRY, 8), dtype=np.uint8)
    wide[:, :ENTRY] = np.frombuffer(entries, dtype=np.uint8).reshape(-1, ENTRY)
    known = np.frombuffer(listed, dtype=np.int64)
    return wide.view("<u8").ravel(), known[np.frombuffer(owners, dtype="<u2" if len(owners) == 2 * len(wide) else "<u4")]


def sorted_block(cells: list[np.ndarray], nodes: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The cells in order, the number of the owner of each, and the nodes that the numbers stand for."""
    number = np.argsort(np.argsort(np.array(nodes)))  # by size, so the smallest owner is the smallest node
    flat = np.concatenate(cells)
    owners = np.repeat(number, list(map(len, cells))).astype(np.uint32)
    at = np.lexsort((owners, flat))
    return flat[at], owners[at], np.sort(np.array(nodes, dtype=np.int64))


def by_bucket(flat: np.ndarray, owners: np.ndarray, ordered: np.ndarray, bits: int) -> list[tuple[int, bytes, bytes, bytes]]:
    """(bucket, cells, owners, nodes) of each bucket of cells in order."""
    bucket = (flat >> np.uint64(64 - bits)).astype(np.int64)
    short = flat >> np.uint64(16 - bits) if bits < 16 else flat
    numbers, starts = np.unique(bucket, return_index=True)
    ends = [*starts[1:], len(flat)]
    return [(b, *packed(short[s:e], owners[s:e], ordered)) for b, s, e in zip(numbers, starts, ends, strict=True)]


def pack(cells: list[np.ndarray], nodes: list[int], bits: int) -> pd.DataFrame:
    """One entry of each cell by bucket, and the links (a, b) of the others with it."""
    flat, owners, ordered = sorted_block(cells, nodes)
    first = np.ones(len(flat), dtype=bool)
    np.not_equal(flat[1:], flat[:-1], out=first[1:])
    low = owners[np.flatnonzero(first)[np.cumsum(first) - 1]]
    own = np.unique(np.stack([owners[~first], low[~first]]), axis=1) if not first.all() else np.empty((2, 0), dtype=np.uint32)
    own = own[:, own[0] != own[1]]
    out = [(*row, b"", b"") for row in by_bucket(flat[first], owners[first], ordered, bits)]
    out[0] = (*out[0][:4], ordered[own[0]].tobytes(), ordered[own[1]].tobytes())
    return pd.DataFrame(out, columns=["bucket", "cells", "owners", "nodes", "a", "b"])


def bucket_entries(part: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The cells of a bucket in order, the node of each, and where each cell starts."""
    blocks = [unpacked(*row) for row in zip(part["cells"], part["owners"], part["nodes"], strict=True)]
    cells, nodes = (np.concatenate(x) for x in zip(*blocks, strict=True))
    at = np.argsort(cells, kind="stable")
    cells, nodes = cells[at], nodes[at]
    return cells, nodes, np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]]))


def connected(blocks: DataFrame, bits: int) -> DataFrame:
    """(a, b): the members of each cell, whatever block they came in, connected with the smallest."""

    def meet(part: pd.DataFrame) -> pd.DataFrame:
        cells, nodes, starts = bucket_entries(part)
        low = np.repeat(np.minimum.reduceat(nodes, starts), np.diff([*starts, len(cells)]))
        far = nodes != low
        a = np.concatenate([nodes[far], *[np.frombuffer(x, np.int64) for x in part["a"]]])
        b = np.concatenate([low[far], *[np.frombuffer(x, np.int64) for x in part["b"]]])
        return pd.DataFrame({"a": a, "b": b}).drop_duplicates()

    return blocks.repartition(partitions(blocks, bits), "bucket").groupBy("bucket").applyInPandas(meet, "a long, b long")


def cell_edges(rows: DataFrame, hot: np.ndarray, k: int, percent: int, shingles: int) -> DataFrame:
    """(a, b): every set that shares a cell is connected with the smallest of the cell.

    Most cells have one member, so what is shuffled is kept small: a task links the members
    that it holds itself, and sends one of each cell, packed by bucket, as six bytes and a
    number into the block's list of nodes. A cell that very many sets enter thus sends one
    entry a block, however many there are. A chance meeting of two cells only puts
    documents into one region; whether they link is decided there.
    """
    shared = rows.sparkSession.sparkContext.broadcast(hot)
    bits = bucket_bits(shingles)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, entered, seen, left_out = Shingler(k), Cells(percent), set(), shared.value
        cells, nodes, held = [], [], 0
        for frame in frames:
            for text in frame["text"]:
                own = shingler.shingles(text)
                node = set_number(own)
                if not len(own) or node in seen:
                    continue
                if len(seen) > SEEN:
                    seen = set()
                seen.add(node)
                rest = own
                if len(left_out):
                    at = np.minimum(np.searchsorted(left_out, own), len(left_out) - 1)
                    rest = own[left_out[at] != own]
                found = entered.of(len(own), rest)
                if len(found):
                    cells.append(found)
                    nodes.append(node)
                    held += len(found)
                if held >= BLOCK_CELLS:
                    yield pack(cells, nodes, bits)
                    cells, nodes, held = [], [], 0
        if held:
            yield pack(cells, nodes, bits)

    return connected(rows.select("text").mapInPandas(run, PACKED), bits)


def set_number(own: np.ndarray) -> int:
    return int.from_bytes(blake2b(own.tobytes(), digest_size=8).digest(), "little", signed=True)


def rare_edges(large: DataFrame, percent: int) -> DataFrame:
    """(a, b): sets of a region that share one of their rarest shingles, connected with the smallest that has it.

    `large` has (region, node, shingles), a row a node. Each of two linked sets has at least
    `percent` of its shingles in common with the other. So in any order of all shingles, here
    from the rarest in the region to the most frequent, the first that both have is among the
    first size - ceil(percent of size) + 1 of either. Shingles are counted by bucket; one that
    a single set has meets nobody, so only the others go back to their sets.
    """
    bits = bucket_bits(large.agg(F.sum(F.length("shingles"))).first()[0] // 8)
    parts = partitions(large, bits)

    def spread(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cells, nodes, held = [], [], 0
        columns = ["bucket", "cells", "owners", "nodes"]
        for frame in frames:
            salts = mixed(frame["region"].to_numpy().astype(np.int64).view(np.uint64))
            for salt, node, own in zip(salts, frame["node"].tolist(), frame["shingles"], strict=True):
                cells.append(mixed(np.frombuffer(own, np.uint64) + salt))
                nodes.append(node)
                held += len(cells[-1])
                if held >= BLOCK_CELLS:
                    yield pd.DataFrame(by_bucket(*sorted_block(cells, nodes), bits), columns=columns)
                    cells, nodes, held = [], [], 0
        if held:
            yield pd.DataFrame(by_bucket(*sorted_block(cells, nodes), bits), columns=columns)

    def count(part: pd.DataFrame) -> pd.DataFrame:
        """For each share of the sets, their shingles in this bucket that occur more than once, with how often."""
        cells, nodes, starts = bucket_entries(part)
        often = np.diff([*starts, len(cells)])
        n = np.repeat(often, often)
        cells, nodes, n = cells[n > 1], nodes[n > 1], np.minimum(n[n > 1], 65535)
        at = np.argsort(nodes % parts, kind="stable")
        cells, nodes, n = cells[at], nodes[at], n[at]
        ordered, owners = np.unique(nodes, return_inverse=True)
        shares, starts = np.unique(nodes % parts, return_index=True)
        out = [
            (share, part["bucket"].iloc[0], n[s:e].astype("<u2").tobytes(), *packed(cells[s:e], owners[s:e], ordered))
            for share, s, e in zip(shares, starts, [*starts[1:], len(nodes)], strict=True)
        ]
        return pd.DataFrame(out, columns=["share", "bucket", "n", "cells", "owners", "nodes"])

    def choose(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """The rarest shingles of a share of the sets, packed as cells."""
        nothing = pd.DataFrame(columns=["bucket", "cells", "owners", "nodes", "a", "b"])
        if left.empty:
            return nothing
        blocks = [unpacked(*row) for row in zip(left["cells"], left["owners"], left["nodes"], strict=True)]
        buckets = left["bucket"].to_numpy().astype(np.uint64) << np.uint64(48)
        cells = mixed(np.concatenate([own | bucket for (own, _), bucket in zip(blocks, buckets, strict=True)]))
        nodes = np.concatenate([node for _, node in blocks])
        n = np.concatenate([np.frombuffer(x, "<u2") for x in left["n"]])
        at = np.lexsort((cells, n, nodes))
        cells, nodes = cells[at], nodes[at]
        ordered, starts, shared = np.unique(nodes, return_index=True, return_counts=True)
        sizes = right.set_index("node")["size"].loc[ordered].to_numpy()
        # The shingles that a set has alone come first in its order.
        most = np.maximum(0, shared + (-sizes * percent // 100) + 1)
        kept = [cells[s : s + m] for s, m in zip(starts[most > 0], most[most > 0], strict=True)]
        return pack(kept, ordered[most > 0].tolist(), bits) if kept else nothing

    blocks = large.select("region", "node", "shingles").mapInPandas(spread, "bucket long, cells binary, owners binary, nodes binary")
    dealt = blocks.repartition(parts, "bucket").groupBy("bucket")
    counted = dealt.applyInPandas(count, "share long, bucket long, n binary, cells binary, owners binary, nodes binary")
    sizes = large.select(F.pmod("node", F.lit(parts)).cast("long").alias("share"), "node", (F.length("shingles") / 8).cast("long").alias("size"))
    return connected(counted.groupBy("share").cogroup(sizes.groupBy("share")).applyInPandas(choose, PACKED), bits)


def narrowed(large: DataFrame, percent: int) -> DataFrame:
    """Stored (region, weight, count, node, shingles) in the regions of rare shingles; sets that share none are left out."""
    edges = stored(rare_edges(large, percent).distinct(), "regions-meetings")
    regions = components(edges, "narrowed").withColumnRenamed("label", "region")
    members = regions.join(large.select("node", (F.length("shingles") / 8).cast("long").alias("size")), "node")
    weights = members.groupBy("region").agg(F.sum("size").alias("weight"), F.count("*").alias("count"))
    wanted = stored(members.join(weights, "region").select("region", "weight", "count", F.col("node").alias("wanted")), "narrowed-members")
    found = marked(large.select(F.col("node").alias("key"), "shingles"), wanted).join(wanted, F.col("key") == F.col("wanted"))
    out = stored(found.select("region", "weight", "count", F.col("wanted").alias("node"), "shingles"), "regions-narrowed")
    discard(edges, wanted)
    return out


class Region:
    """Sets of one region in memory, sorted by size, with their links found so far."""

    def __init__(self, sets: list[np.ndarray], percent: int) -> None:
        self.percent = percent
        sizes = np.array([len(s) for s in sets])
        self.order = np.argsort(sizes, kind="stable")
        self.sizes = sizes[self.order]
        flat = np.concatenate([sets[i] for i in self.order])
        self.words, self.flat = np.unique(flat, return_inverse=True)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        # Members of each word, word after word.
        owners = np.repeat(np.arange(len(sets)), self.sizes)
        self.holders = owners[np.argsort(self.flat, kind="stable")]
        self.held = np.concatenate([[0], np.cumsum(np.bincount(self.flat, minlength=len(self.words)))])

    def known(self, shingles: np.ndarray) -> np.ndarray:
        """Numbers into `words` of those shingles that the region has."""
        at = np.minimum(np.searchsorted(self.words, shingles), len(self.words) - 1)
        return at[self.words[at] == shingles]

    def window(self, size: int) -> tuple[int, int]:
        """The range of members whose size allows a link."""
        low = np.searchsorted(self.sizes, -(-size * self.percent // 100), side="left")
        high = np.searchsorted(self.sizes, size * 100 // self.percent, side="right")
        return int(low), int(high)

    def shared(self, own: np.ndarray, low: int, high: int) -> np.ndarray:
        """How many shingles (numbers into `words`) each member of a range shares with a set."""
        if low >= high:
            return np.empty(0, dtype=np.int64)
        marked = np.zeros(len(self.words), dtype=bool)
        marked[own] = True
        hits = marked[self.flat[self.starts[low] : self.starts[high]]].astype(np.int32)
        return np.add.reduceat(hits, self.starts[low:high] - self.starts[low])

    def met(self, own: np.ndarray, listed: np.ndarray) -> np.ndarray:
        """As `shared` for all members, through the members of each word: quick where words are rare."""
        at = np.repeat(self.held[own] - (np.cumsum(listed) - listed), listed) + np.arange(listed.sum())
        return np.bincount(self.holders[at], minlength=len(self.sizes))

    def shared_of(self, own: np.ndarray, members: np.ndarray) -> np.ndarray:
        """As `shared`, for some members."""
        if not len(members):
            return np.empty(0, dtype=np.int64)
        marked = np.zeros(len(self.words), dtype=bool)
        marked[own] = True
        sizes = self.sizes[members]
        first = np.cumsum(sizes) - sizes
        at = np.repeat(self.starts[members] - first, sizes) + np.arange(sizes.sum())
        return np.add.reduceat(marked[self.flat[at]].astype(np.int32), first)

    def linked(self, own: np.ndarray, size: int, near: np.ndarray | None = None) -> np.ndarray:
        """Members linked with a set of the given size, of which `own` are in `words`; with `near`, among these."""
        low, high = self.window(size)
        members = np.arange(low, high) if near is None else low + np.flatnonzero(near[low:high])
        listed = self.held[own + 1] - self.held[own]
        if listed.sum() < self.sizes[members].sum():
            shared = self.met(own, listed)[members]
        else:
            shared = self.shared_of(own, members)
        union = size + self.sizes[members] - shared
        return members[100 * shared >= self.percent * union]

    def labels(self) -> np.ndarray:
        """The component of every member, in the order the sets were given.

        Members are compared with one pivot after another. The first few pivots are measured
        against all members; a later one only meets members whose distance to each of those
        differs from its own by the radius at most, as the triangle inequality demands.
        """
        n, radius = len(self.sizes), 1 - self.percent / 100 + 1e-9
        label, waiting = np.arange(n), np.ones(n, dtype=bool)
        measured: list[np.ndarray] = []
        while True:
            sizes = np.bincount(label, minlength=n)
            open_ = np.flatnonzero(waiting & (label != sizes.argmax() if n > 1 else False))
            if not len(open_):
                break
            # Pivots of one component follow each other until it is joined to the largest.
            pivot = int(open_[0])
            waiting[pivot] = False
            own, size = self.flat[self.starts[pivot] : self.starts[pivot + 1]], int(self.sizes[pivot])
            if len(measured) < MEASURED:
                shared = self.met(own, self.held[own + 1] - self.held[own])
                union = size + self.sizes - shared
                measured.append(1 - shared / union)
                found = np.flatnonzero(100 * shared >= self.percent * union)
            else:
                near = np.ones(n, dtype=bool)
                for distance in measured:
                    near &= np.abs(distance - distance[pivot]) <= radius
                found = self.linked(own, size, near)
            together = np.unique(label[np.append(found, pivot)])
            if len(together) > 1:
                label[np.isin(label, together)] = together[0]
        out = np.empty(n, dtype=np.int64)
        out[self.order] = label
        return out


def join_small(members: DataFrame, percent: int) -> DataFrame:
    """(node, label) of regions that fit a task; a region's members are brought together by its number."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        nodes = part["node"].to_numpy()
        label = Region([np.frombuffer(s, np.uint64) for s in part["shingles"]], percent).labels()
        smallest = pd.Series(nodes).groupby(label).transform("min")
        return pd.DataFrame({"node": nodes, "label": smallest.to_numpy()})

    return members.groupBy("region").applyInPandas(run, "node long, label long")


def join_large(members: DataFrame, percent: int) -> DataFrame:
    """(node, label) of regions too large for a task: stored (region, weight, count, node, shingles) in Voronoi cells."""
    radius = 1 - percent / 100
    first = F.pmod(F.xxhash64("node"), F.greatest(F.lit(1), F.col("count") / PIVOTS).cast("long")) == 0
    pivots = members.filter(first).select("region", "node", "shingles")
    # The expected number of pivots is PIVOTS in each region, whatever its size.
    listed = pivots.groupBy("region").agg(F.collect_list(F.struct("node", "shingles")).alias("pivots"))
    parts = F.ceil(F.col("weight") / (TASK_SHINGLES // 4))
    dealt = members.withColumn("part", F.pmod(F.xxhash64("node", F.lit(1)), parts))
    spread = listed.join(members.groupBy("region").agg(F.first("weight").alias("weight")), "region")
    spread = spread.select("region", "pivots", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"))
    spread = stored(spread, "regions-pivots")

    def place(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """Distances of a part of a region to the pivots, and the cell of the nearest."""
        sets = [np.frombuffer(s, np.uint64) for s in left["shingles"]]
        pivot_list = right["pivots"].iloc[0] if len(right) else []
        distance = np.ones((len(sets), len(pivot_list)), dtype=np.float32)
        if sets:
            region = Region(sets, percent)
            for j, pivot in enumerate(pivot_list):
                own = np.frombuffer(pivot["shingles"], np.uint64)
                shared = region.shared(region.known(own), 0, len(sets))
                distance[region.order, j] = 1 - shared / (len(own) + region.sizes - shared)
        home = distance.argmin(axis=1) if len(pivot_list) else np.zeros(len(sets), dtype=int)
        out = left[["region", "weight", "count", "node", "shingles"]].assign(cell=home)
        return out.assign(distances=pd.Series(list(distance), index=out.index, dtype=object))

    schema = "region long, weight long, count long, node long, shingles binary, cell int, distances array<float>"
    placed = stored(dealt.groupBy("region", "part").cogroup(spread.groupBy("region", "part")).applyInPandas(place, schema), "regions-placed")
    # Cells are dealt in slices that fit a task, so that a crowded cell is several.
    crowd = placed.groupBy("region", "cell").agg(
        F.sum(F.length("shingles") / 8).alias("mass"),
        F.min(F.get("distances", F.col("cell"))).alias("near"),
        F.max(F.get("distances", F.col("cell"))).alias("far"),
    )
    crowd = stored(crowd.withColumn("slices", F.ceil(F.col("mass") / TASK_SHINGLES).cast("int")), "regions-crowd")
    homes = placed.join(crowd.select("region", "cell", "slices"), ["region", "cell"])
    homes = stored(homes.withColumn("slice", F.pmod(F.xxhash64("node", F.lit(2)), "slices").cast("int")), "regions-homes")
    first_pivots = stored(pivots.select("node"), "regions-first")
    # Each of these holds all sets of the regions; the homes are enough from here on.
    discard(members, spread, placed)
    done, edges = first_pivots.limit(0), None
    asked = homes.join(first_pivots, "node", "left_semi")

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """Links of a slice of a cell with the pivots copied to it."""
        out: list[tuple[int, int]] = []
        if len(left) and len(right):
            region = Region([np.frombuffer(s, np.uint64) for s in left["shingles"]], percent)
            nodes = left["node"].to_numpy()[region.order]
            far = np.vstack(left["distances"].to_list())[region.order]
            for node, own, distances in zip(right["node"], right["shingles"], right["distances"], strict=True):
                numbers = np.frombuffer(own, np.uint64)
                low, high = region.window(len(numbers))
                # The window of every first pivot has to hold for some member of the slice.
                near = (np.abs(far[low:high] - np.asarray(distances)) <= radius + 1e-5).all(axis=1)
                if near.any():
                    found = region.linked(region.known(numbers), len(numbers))
                    out += [(int(node), int(other)) for other in nodes[found] if other != node]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    while True:
        # A pivot goes to a cell only if some member may lie within the radius of it.
        reach = crowd.select("region", F.col("cell").alias("to"), "near", "far", "slices")
        copies = asked.select("region", "node", "shingles", "distances").join(reach, "region")
        away = F.get("distances", F.col("to"))
        copies = copies.filter((away <= F.col("far") + radius + 1e-5) & (away >= F.col("near") - radius - 1e-5))
        copies = copies.select("region", F.col("to").alias("cell"), "node", "shingles", "distances", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
        copies = stored(copies, "regions-copies")
        keys = ["region", "cell", "slice"]
        found = homes.groupBy(*keys).cogroup(copies.groupBy(*keys)).applyInPandas(compare, "a long, b long")
        found = stored(found, "regions-links")
        discard(copies)
        edges = found if edges is None else edges.unionByName(found)
        done = stored(done.unionByName(asked.select("node")), "regions-done")
        labels = components(edges, "regions")
        state = homes.select("region", "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        sizes = state.groupBy("region", "label").count()
        largest = sizes.groupBy("region").agg(F.max_by("label", F.struct("count", "label")).alias("label"))
        outside = state.join(largest, ["region", "label"], "left_anti").join(done, "node", "left_anti")
        waiting = outside.groupBy("region").count().withColumnRenamed("count", "waiting")
        some = F.pmod(F.xxhash64("node", F.lit(3)), F.greatest(F.lit(1), F.col("waiting") / MORE_PIVOTS).cast("long")) == 0
        chosen = stored(outside.join(waiting, "region").filter(some).select("node"), "regions-chosen")
        if chosen.isEmpty():
            if outside.isEmpty():
                return state.select("node", "label")
            chosen = stored(outside.select("node"), "regions-chosen")
        asked = homes.join(chosen, "node", "left_semi")


def classes(
    docs: DataFrame, k: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_shingles, component_id) of every document."""
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    rows = rows.select("id", F.xxhash64("text").alias("key"), "text")
    surveyed = stored(survey(rows, k), "jaccard-survey")
    seen = surveyed.where("node IS NOT NULL").select("id", "key", "size", "node")
    documents, shingles = seen.agg(F.count("*"), F.sum("size")).first()
    hot = frequent_shingles(surveyed, documents)
    # A set is known by the smallest id of its documents, null only where no other is; its
    # text is found again by that id and the text's hash, so repeated and null ids do no harm.
    holder = F.min(F.struct(F.col("id").isNull().alias("without"), "id", "key")).alias("holder")
    sets = seen.filter("size > 0").groupBy("node").agg(holder, F.first("size").alias("size"), F.count("*").alias("n"))
    sets = sets.select("node", "size", F.col("holder.id").alias("first"), F.col("holder.key").alias("key"), "n")
    edges = stored(cell_edges(rows, hot, k, percent, shingles or 0).distinct(), "jaccard-meetings")
    regions = components(edges, "cells").withColumnRenamed("label", "region")
    discard(edges)
    members = regions.join(sets.select("node", "size", "first", "key"), "node")
    labels = join_regions(rows, members, k, percent)
    # Ids of classes that are linked to another, or that more than one document has.
    linked = sets.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    lowest = linked.groupBy("label").agg(F.min("first").alias("component_id"), F.count("*").alias("classes"))
    shared = linked.join(lowest, "label").filter("n > 1 or classes > 1").select("node", "component_id")
    joined = salted_left_join(seen.select("id", "size", "node"), shared, ["node"])
    component = F.when(F.col("size") > 0, F.coalesce("component_id", "id")).otherwise(F.col("id"))
    return joined.select(F.col("id").alias(id_col), F.col("size").alias("n_shingles"), component.alias("component_id"))


def join_regions(rows: DataFrame, members: DataFrame, k: int, percent: int) -> DataFrame:
    """(node, label) for (node, region, size, first, key): the components within regions.

    Regions are weighed by the sizes that are known, before any text is fetched. Shingles
    go straight to their region's task; only those of regions too large for one are stored.
    """

    def shingled(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, done = Shingler(k), set()
        for frame in chunks(frames, 1000):
            sets = [shingler.shingles(text) for text in frame["text"]]
            # Another text may have the wanted one's hash; repeated rows are needed once.
            new = []
            for node, own in zip(frame["node"].tolist(), sets, strict=True):
                new.append(node not in done and node == set_number(own))
                if new[-1]:
                    done.add(node)
            out = frame[["region", "weight", "count", "node"]].assign(shingles=[own.tobytes() for own in sets])
            yield out[np.array(new, dtype=bool)]

    weights = members.groupBy("region").agg(F.sum("size").alias("weight"), F.count("*").alias("count"))
    weighed = stored(members.join(weights, "region"), "jaccard-members")
    schema = "region long, weight long, count long, node long, shingles binary"

    def fetched(which: str) -> DataFrame:
        wanted = weighed.filter(which).select("region", "weight", "count", "node", "first", F.col("key").alias("wanted"))
        # Only texts of members are shuffled, the join being exact. Copies of a text under
        # different ids spread over tasks, because the id is part of the key.
        found = marked(rows, wanted).join(wanted, (F.col("key") == F.col("wanted")) & F.col("id").eqNullSafe(F.col("first")))
        return found.select("region", "weight", "count", "node", "text").mapInPandas(shingled, schema)

    small, beyond = f"weight <= {TASK_SHINGLES}", f"weight > {TASK_SHINGLES}"
    labels, done = join_small(fetched(small).select("region", "node", "shingles"), percent), [weighed]
    if not weighed.filter(beyond).isEmpty():
        large = stored(fetched(beyond), "regions-large")
        if large.count() > large.select("node").distinct().count():
            # A skewed join has split the rows of one text over tasks.
            repeated, large = large, stored(large.dropDuplicates(["node"]), "regions-large")
            discard(repeated)
        finer = narrowed(large, percent)
        discard(large)
        done.append(finer)
        labels = labels.unionByName(join_small(finer.filter(small).select("region", "node", "shingles"), percent))
        if not finer.filter(beyond).isEmpty():
            labels = labels.unionByName(join_large(stored(finer.filter(beyond), "regions-large"), percent))
    found = stored(labels.distinct(), "jaccard-labels")
    discard(*done)
    return found


def representatives(
    docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One document of each group of linked ones: that with the smallest id.

    Rows that share an id stay or go together; rows with a null id stay.
    """
    groups = classes(docs, k, percent, id_col, text_col)
    gone = groups.filter(F.col("component_id") != F.col(id_col)).select(id_col).distinct()
    return docs.join(gone, id_col, "left_anti").select(*docs.columns)
