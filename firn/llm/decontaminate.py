"""Benchmark decontamination with an FM-index per training shard.

A shard is a run of rows of one partition, up to ``shard_words`` indexed words.
Its words become symbols of the test phrases' vocabulary; a word that no phrase
has can be in no occurrence, so runs of known words shorter than the shortest
phrase are left out, which loses nothing.  The shard's suffix array gives the
Burrows-Wheeler transform, held as a wavelet matrix; all phrases are searched
backwards at once through its ranks, and each hit's position is found by
walking back to a sampled suffix position.  Occurrences merge into removal
spans of each document.

Phrases are the windows of ``window`` consecutive words of every item; a
shorter item is one phrase.  Words are ``[0-9a-z]`` and all code points over
0x7F, after lower-casing A-Z.

Scale: one narrow pass over the documents, without a shuffle.  More items than
``block_bytes`` of text go to the tasks in blocks, one stored pass each, one after the other, so neither driver nor tasks hold
more than a block (ids that share a hash go together, an item is never cut); hits are then merged by text and joined to
the rows.  A task holds one shard's rows and index.

Defined cases: null or empty text has no words; null items and items without
words have no phrase; a null item_id counts as an empty id; copies of an item
count once per id; repeated rows are treated alike; input columns travel inside a struct, so
their names can't clash; very long texts are searched whole; empty tables give empty or clean results.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firn.llm.common import stored

# Everything that isn't part of a word turns to a space, A-Z to a-z.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32
               for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


class WaveletMatrix:
    """Ranks of symbols in a sequence, one bit level at a time, for arrays of queries."""

    def __init__(self, seq: np.ndarray, sigma: int):
        self.bits = max(1, int(sigma - 1).bit_length())
        self.ones, self.zeros = [], []
        for level in range(self.bits - 1, -1, -1):
            bit = ((seq >> level) & 1).astype(bool)
            self.ones.append(np.concatenate(([0], np.cumsum(bit, dtype=np.int32))).astype(np.int32))
            self.zeros.append(int(len(seq) - self.ones[-1][-1]))
            seq = np.concatenate((seq[~bit], seq[bit]))

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position."""
        low, high = np.zeros_like(at), at
        for k, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            bit = (symbol >> (self.bits - 1 - k)) & 1
            low = np.where(bit, zeros + ones[low], low - ones[low])
            high = np.where(bit, zeros + ones[high], high - ones[high])
        return high - low

    def access(self, at: np.ndarray) -> np.ndarray:
        symbol = np.zeros_like(at)
        for ones, zeros in zip(self.ones, self.zeros):
            bit = ones[at + 1] - ones[at]
            at = np.where(bit, zeros + ones[at], at - ones[at])
            symbol = symbol * 2 + bit
        return symbol


def suffix_array(seq: np.ndarray) -> np.ndarray:
    """By prefix doubling; ``seq`` ends in a symbol that is the least and occurs once."""
    order = np.argsort(seq, kind="stable")
    step, n = 1, len(seq)
    rank = np.empty(n, np.int64)
    rank[order] = np.cumsum(np.concatenate(([0], np.diff(seq[order]) != 0)))
    while rank[order[-1]] < n - 1:
        key = rank * n
        key[:-step] += rank[step:]
        order = np.argsort(key, kind="stable")
        rank[order] = np.cumsum(np.concatenate(([0], np.diff(key[order]) != 0)))
        step *= 2
    return order


class FMIndex:
    """Backward search and location in a sequence of symbols >= 1."""

    def __init__(self, seq: np.ndarray, sigma: int, sample: int = 8):
        seq = np.concatenate((seq, [0])).astype(np.int64)
        order = suffix_array(seq)
        last = seq[order - 1]
        self.matrix = WaveletMatrix(last, sigma)
        self.first = np.concatenate(([0], np.cumsum(np.bincount(seq, minlength=sigma))))[:sigma]
        self.n = len(seq)
        marked = order % sample == 0
        self.marks = np.concatenate(([0], np.cumsum(marked)))
        self.samples = order[marked]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row interval of each phrase; ``phrases`` is 2-D, all of one length."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.n, np.int64)
        for symbol in phrases.T[::-1]:
            low = self.first[symbol] + self.matrix.rank(symbol, low)
            high = self.first[symbol] + self.matrix.rank(symbol, high)
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Position of the suffix in each row: back to a sampled one, then forward by the steps taken."""
        at, steps = rows.copy(), np.zeros_like(rows)
        while len(todo := np.flatnonzero(self.marks[at + 1] == self.marks[at])):
            symbol = self.matrix.access(at[todo])
            at[todo] = self.first[symbol] + self.matrix.rank(symbol, at[todo])
            steps[todo] += 1
        return self.samples[self.marks[at]] + steps


class Phrases:
    """The windows of a block of items: vocabulary, phrase matrix per length, items of each phrase."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        owners: dict[tuple[bytes, ...], set[int]] = defaultdict(set)
        self.ids = sorted({i for i, _ in items})
        number = {i: k for k, i in enumerate(self.ids)}
        for item, text in items:
            words = words_of(text)
            for k in range(max(1, len(words) - window + 1) if words else 0):
                owners[tuple(words[k:k + window])].add(number[item])
        # 0 ends the sequence, 1 parts its runs, words begin at 2
        self.vocabulary = {w: k + 2 for k, w in enumerate(sorted({w for p in owners for w in p}))}
        self.by_length = {}
        for n in sorted({len(p) for p in owners}):
            own = [p for p in owners if len(p) == n]
            self.by_length[n] = (np.array([[self.vocabulary[w] for w in p] for p in own], np.int64),
                                 [sorted(owners[p]) for p in own])
        self.shortest = min(self.by_length, default=0)


class _Shard:
    """Texts of consecutive rows, of which the runs of known words are indexed together."""

    def __init__(self, phrases: Phrases):
        self.phrases, self.n_words, self.parts, self.starts, self.size = phrases, [], [], [], 0

    def add(self, text: bytes | None) -> None:
        words = words_of(text) if text else []
        row = len(self.n_words)
        self.n_words.append(len(words))
        get = self.phrases.vocabulary.get
        symbols = np.array([get(w, 0) for w in words], np.int64)
        edges = np.flatnonzero(np.diff(np.concatenate(([False], symbols > 0, [False])).astype(np.int8)))
        for a, b in edges.reshape(-1, 2):
            if b - a >= self.phrases.shortest:
                self.starts.append((self.size, row, a))
                self.parts.append(symbols[a:b])
                self.parts.append(np.ones(1, np.int64))
                self.size += int(b - a) + 1

    def spans(self) -> tuple[list, list]:
        """For each row the merged (start, end) word spans and the items that occur."""
        spans: list[list] = [[] for _ in self.n_words]
        items: list[set] = [set() for _ in self.n_words]
        if not self.parts:
            return spans, items
        index = FMIndex(np.concatenate(self.parts), len(self.phrases.vocabulary) + 2)
        starts = np.array([s[0] for s in self.starts])
        rows = np.array([s[1] for s in self.starts])
        offset = np.array([s[2] for s in self.starts])
        cover = np.zeros(self.size + 1, np.int64)
        for n, (matrix, owners) in self.phrases.by_length.items():
            low, high = index.search(matrix)
            times = high - low
            if not times.sum():
                continue
            which = np.repeat(np.arange(len(times)), times)
            at = index.locate(np.repeat(low, times) + np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times))
            np.add.at(cover, at, 1)
            np.add.at(cover, at + n, -1)
            row = rows[np.searchsorted(starts, at, "right") - 1]
            for r, w in np.unique(np.stack((row, which), 1), axis=0).tolist():
                items[r].update(owners[w])
        hit = np.flatnonzero(np.diff(np.concatenate(([0], np.cumsum(cover[:-1]) > 0, [0])).astype(np.int8))).reshape(-1, 2)
        runs = np.searchsorted(starts, hit[:, 0], "right") - 1 if len(hit) else []
        for (a, b), k in zip(hit.tolist(), runs):
            begin = int(offset[k]) + a - int(starts[k])
            spans[rows[k]].append((begin, begin + b - a))
        return spans, items


_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])
_FOUND = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()),
                                                     T.StructField("end", T.IntegerType())]))),
    T.StructField("items", T.ArrayType(T.StringType()))])


def _search(phrases: Phrases, shard_words: int, shard_bytes: int):
    """Arrow batches (row, text) to (row, text, found)."""
    def finish(held: list, shard: _Shard):
        spans, items = shard.spans()
        at = 0
        for batch in held:
            part = slice(at, at + batch.num_rows)
            at += batch.num_rows
            found = pa.StructArray.from_arrays([
                pa.array(shard.n_words[part], pa.int64()),
                pa.array([[{"start": a, "end": b} for a, b in s] for s in spans[part]], pa.list_(_SPAN)),
                pa.array([[phrases.ids[i] for i in sorted(x)] for x in items[part]], pa.list_(pa.string()))],
                names=["n_words", "spans", "items"])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), found], names=["row", "text", "found"])

    def run(batches):
        held, shard, nbytes = [], _Shard(phrases), 0
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                for text in part.column(1).cast(pa.binary()).to_pylist():
                    shard.add(text)
                held.append(part)
                nbytes += part.nbytes
                if shard.size >= shard_words or nbytes >= shard_bytes:
                    yield from finish(held, shard)
                    held, shard, nbytes = [], _Shard(phrases), 0
        if held:
            yield from finish(held, shard)
    return run


def block_count(items: DataFrame, text_col: str, block_bytes: int) -> int:
    """In how many blocks of about ``block_bytes`` at most the items go to the tasks."""
    total = items.agg(F.sum(F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)) + 32)).first()[0] or 0
    return -(-total // block_bytes)


def item_blocks(items: DataFrame, id_col: str, text_col: str, blocks: int):
    """The items as lists of (id, text), one block after the other."""
    rows = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                        F.coalesce(F.encode(F.col(text_col), "UTF-8"), F.lit(b"")).alias("text"))
    for k in range(blocks):
        yield [(r.id, bytes(r.text)) for r in rows.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == k).collect()]


def find_phrases(docs: DataFrame, items: DataFrame, keep: list[str], text_col: str = "text",
                 item_id: str = "item_id", item_text: str = "text", window: int = 10,
                 shard_words: int = 1_000_000, shard_bytes: int = 32 << 20, block_bytes: int = 8 << 20) -> DataFrame:
    """``row`` (a struct of the columns in ``keep``), n_words, spans (merged, in words) and items."""
    rows = docs.select(F.struct(*keep).alias("row"), F.col(text_col).alias("text"))
    sizes = block_count(items, item_text, block_bytes)
    if sizes <= 1:
        phrases = Phrases(next(item_blocks(items, item_id, item_text, 1), []), window)
        found = _pass(rows, phrases, shard_words, shard_bytes)
        return found.select("row", "found.n_words", "found.spans", "found.items")
    return _in_passes(rows, items, item_id, item_text, sizes, window, shard_words, shard_bytes)


def _pass(rows: DataFrame, phrases: Phrases, shard_words: int, shard_bytes: int) -> DataFrame:
    schema = T.StructType([rows.schema["row"], T.StructField("text", T.StringType()), T.StructField("found", _FOUND)])
    return rows.mapInArrow(_search(phrases, shard_words, shard_bytes), schema)


def _in_passes(rows: DataFrame, items: DataFrame, item_id: str, item_text: str, blocks: int, window: int, shard_words: int,
               shard_bytes: int) -> DataFrame:
    """One stored pass over the texts for each block of items.  What is found depends on the text alone, so a pass
    keeps (128-bit hash of the text, spans, items) of texts with hits; these are merged by hash and joined to the rows."""
    text = F.coalesce("text", F.lit(""))
    key = F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))
    keyed, hits = rows.select(key.alias("row"), "text"), None
    for k, block in enumerate(item_blocks(items, item_id, item_text, blocks)):
        found = _pass(keyed, Phrases(block, window), shard_words, shard_bytes).where(F.size("found.spans") > 0)
        found = stored(found.select(F.col("row").alias("key"), F.lit(k).alias("block"), "found.spans", "found.items"), "phrase-hits")
        hits = found if hits is None else hits.union(found)
    hits = hits.groupBy("key.a", "key.b", "block").agg(F.any_value("spans").alias("spans"), F.any_value("items").alias("items"))
    hits = hits.groupBy("a", "b").agg(merge_spans(F.flatten(F.collect_list("spans"))).alias("spans"),
                                      F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    words = F.regexp_count(text, F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")).cast("long")
    out = rows.select("row", words.alias("n_words"), key.alias("key")).alias("r").join(
        hits.alias("h"), (F.col("r.key.a") == F.col("h.a")) & (F.col("r.key.b") == F.col("h.b")), "left")
    return out.select("r.row", "r.n_words", F.coalesce("h.spans", F.expr("cast(array() as array<struct<start:int,end:int>>)")).alias("spans"),
                      F.coalesce("h.items", F.expr("cast(array() as array<string>)")).alias("items"))


def merge_spans(spans):
    """Sorted spans without overlaps, from spans in any order."""
    kind = "array<struct<start:int,end:int>>"

    def step(acc, x):
        last = F.get(acc, F.size(acc) - 1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))
        return (F.when(last["end"] >= x["start"],
                       F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(joined)))
                .otherwise(F.concat(acc, F.array(x))))
    return F.aggregate(F.array_sort(spans), F.expr(f"cast(array() as {kind})"), step)


def clean_documents(docs: DataFrame, items: DataFrame, text_col: str = "text", **how) -> DataFrame:
    """The documents in which no phrase occurs, all columns unchanged."""
    found = find_phrases(docs, items, docs.columns, text_col, **how).where(F.size("spans") == 0)
    return found.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
