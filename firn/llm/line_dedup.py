"""Incremental, reversible line dedup: sharded cuckoo filters over exact reference counts.

``LineIndex`` is a versioned store in a shared folder with four tables:

* ``postings``: for each document inserted its id and the distinct keys of its long lines,
* ``deleted``: ids of deleted documents and the version that deleted them,
* ``refs``: the exact reference counts, one row a key: number of documents, largest id,
* ``filters``: one cuckoo filter a shard of the keys that ``min_docs`` documents or more hold.

``insert`` adds the counts of new documents, ``delete`` takes those of old ones back.  Keys whose
count rises to ``min_docs`` go into their shard's filter, keys that fall below it come out again; only the
exact counts say so, so a filter never loses another key's entry.  A shard that gets full is built anew from
the counts.  Everything an operation changes becomes visible by one commit.

``strip`` tests every line of a text against the filters, inside the task that reads the text.  Only the few
lines that pass are shuffled to the exact counts, which drop false positives and say which document keeps the line.

Scale: counts combine on the map side (a document names a key once), so a line that a third of all documents hold is
one row a task.  Filters take about 3 to 6 bytes a repeated key.  They are broadcast in blocks of whole shards of at most
``block_bytes``, one pass over the line keys a block; blocks are dropped as they are done.  Suspects join the counts
by key with one row on that side, so the planner can split a hot key.

Defined cases: null or empty text is one empty line; every row counts as a document, also where ids repeat; a line stays in
all rows that have the key's largest id, and in a row with a null id only where all holders have
none; keys are known by their 128-bit XXH3; very long texts and lines are used
whole; deleting unknown ids changes nothing; other columns, whatever their names, stay in ``row``; empty input gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from firn.llm.common import shared_folder, shuffle_partitions, stored
from firn.sources.versions import VersionedStore

STRIPPED = " \t\n\x0b\x0c\r"
KEY = "struct<h1:long,h2:long>"
SLOTS = 4  # of a bucket
ROWS = 512  # of an Arrow batch that a task works on at once


def _pieces(batches):
    for b in batches:
        for k in range(0, b.num_rows, ROWS):
            yield b.slice(k, ROWS)


# keys of lines

def line_keys(texts: pa.Array, min_chars: int) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """All lines, the offsets of each text's lines, and position and 128-bit hash of every line with a long key."""
    lists = pc.split_pattern(pc.fill_null(texts, ""), pattern="\n")
    lines, offsets = lists.flatten(), lists.offsets.to_numpy()
    keys = pc.ascii_lower(pc.utf8_trim(lines, characters=STRIPPED))
    at = np.flatnonzero(pc.greater_equal(pc.utf8_length(keys), min_chars).to_numpy(zero_copy_only=False))
    digests = b"".join(xxhash.xxh3_128_digest(k) for k in keys.take(pa.array(at)).cast(pa.binary()).to_pylist())
    return lines, offsets - offsets[0], at, np.frombuffer(digests, "<i8").reshape(-1, 2)


def _postings(min_chars: int):
    def keyed(batches):
        for b in _pieces(batches):
            _, offsets, at, h = line_keys(b.column("text"), min_chars)
            row = np.searchsorted(offsets, at, "right") - 1
            order = np.lexsort((h[:, 1], h[:, 0], row))
            row, h = row[order], h[order]
            new = np.ones(len(row), bool)
            new[1:] = (np.diff(row) != 0) | (np.diff(h[:, 0]) != 0) | (np.diff(h[:, 1]) != 0)
            starts = np.searchsorted(row[new], np.arange(b.num_rows + 1)).astype(np.int32)
            keys = pa.StructArray.from_arrays([pa.array(h[new, 0]), pa.array(h[new, 1])], ["h1", "h2"])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_hash"), pa.ListArray.from_arrays(pa.array(starts), keys)],
                                             ["doc_id", "text_hash", "lines"])
    return keyed


# cuckoo filters of 16-bit fingerprints; 0 is a free slot

def places(h1: np.ndarray, h2: np.ndarray, buckets) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprint and both buckets of each key; ``buckets`` is a power of two, of one filter or of each key's."""
    fp = np.maximum(h2.view(np.uint64) >> np.uint64(48), np.uint64(1)).astype(np.uint16)
    mask = np.asarray(buckets, np.int64) - 1
    first = ((h1.view(np.uint64) >> np.uint64(24)).astype(np.int64)) & mask
    return fp, first, first ^ _step(fp, mask)


def _step(fp, mask):
    return (np.asarray(fp, np.int64) * 0x5BD1E995 >> 8) & mask


def cuckoo_insert(table: np.ndarray, h1: np.ndarray, h2: np.ndarray, kicks: int = 500) -> bool:
    """Puts all keys into ``table`` (buckets x slots); False if one found no place."""
    fp, *both = places(h1, h2, len(table))
    left = np.arange(len(fp))
    for bucket in both:  # as many as have room in their first, then in their second bucket
        left = left[np.argsort(bucket[left], kind="stable")]
        b = bucket[left]
        rank = np.arange(len(b)) - np.searchsorted(b, b)
        fits = rank < (table[b] == 0).sum(1)
        slot = np.argsort(table[b[fits]] != 0, axis=1, kind="stable")[np.arange(fits.sum()), rank[fits]]
        table[b[fits], slot] = fp[left[fits]]
        left = left[~fits]
    mask = len(table) - 1
    for k in left:
        f, b = fp[k], int(both[1][k])
        for turn in range(kicks):
            free = np.flatnonzero(table[b] == 0)
            if len(free):
                table[b, free[0]] = f
                break
            slot = turn % SLOTS
            f, table[b, slot] = table[b, slot], f
            b = int(b ^ _step(f, mask))
        else:
            return False
    return True


def cuckoo_delete(table: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> None:
    """Takes one entry of each key out; the keys must have been inserted."""
    for f, *both in zip(*places(h1, h2, len(table))):
        for b in both:
            at = np.flatnonzero(table[b] == f)
            if len(at):
                table[b, at[0]] = 0
                break


def cuckoo_build(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    buckets = 1 << max(2, int(np.ceil(np.log2(max(1, len(h1)) / (0.75 * SLOTS)))))
    while True:
        table = np.zeros((buckets, SLOTS), np.uint16)
        if cuckoo_insert(table, h1, h2):
            return table
        buckets *= 2


class FilterBlock:
    """The filters of some shards, laid end to end."""

    def __init__(self, shards: int, rows):
        self.shards, self.offset, self.buckets = shards, np.full(shards, -1, np.int64), np.ones(shards, np.int64)
        at, parts = 0, [np.zeros((0, SLOTS), np.uint16)]
        for r in rows:
            t = np.frombuffer(bytes(r.table), np.uint16).reshape(-1, SLOTS)
            self.offset[r.shard], self.buckets[r.shard] = at, len(t)
            at += len(t)
            parts.append(t)
        self.table = np.concatenate(parts)

    def contains(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Positions of the keys that a filter here has."""
        shard = np.mod(h1, self.shards)
        here = np.flatnonzero(self.offset[shard] >= 0)
        h1, h2, shard = h1[here], h2[here], shard[here]
        fp, first, second = places(h1, h2, self.buckets[shard])
        found = np.zeros(len(here), bool)
        for bucket in (first, second):
            found |= (self.table[self.offset[shard] + bucket] == fp[:, None]).any(1)
        return here[found]


# what the store does with them

FILTER = "shard int, n_keys long, table binary"


def _update_filter(key: tuple, old: pd.DataFrame, changes: pd.DataFrame) -> pd.DataFrame:
    """One shard's filter with its changes; a null table asks for a new filter."""
    up = changes["up"].to_numpy(dtype=bool)
    h1, h2 = (changes[c].to_numpy(np.int64) for c in ("h1", "h2"))
    n = (int(old["n_keys"].iloc[0]) if len(old) else 0) + int(up.sum()) - int((~up).sum())
    table = None
    if len(old) and n <= 0.9 * len(old["table"].iloc[0]) / 2:
        table = np.frombuffer(bytes(old["table"].iloc[0]), np.uint16).reshape(-1, SLOTS).copy()
        cuckoo_delete(table, h1[~up], h2[~up])
        if not cuckoo_insert(table, h1[up], h2[up]):
            table = None
    return pd.DataFrame({"shard": [key[0]], "n_keys": [n], "table": [None if table is None else table.tobytes()]})


def _new_filter(key: tuple, keys: pd.DataFrame) -> pd.DataFrame:
    table = cuckoo_build(keys["h1"].to_numpy(np.int64), keys["h2"].to_numpy(np.int64))
    return pd.DataFrame({"shard": [key[0]], "n_keys": [len(keys)], "table": [table.tobytes()]})


def _suspects(block):
    def test(batches):
        for b in _pieces(batches):
            lists = b.column("lines")
            keys, offsets = lists.flatten(), lists.offsets.to_numpy()
            h1, h2 = (np.ascontiguousarray(keys.field(k).to_numpy()) for k in (0, 1))
            at = block.value.contains(h1, h2)
            row = pa.array(np.searchsorted(offsets - offsets[0], at, "right") - 1)
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(row), b.column("text_hash").take(row),
                                              pa.array(h1[at]), pa.array(h2[at])], ["doc_id", "text_hash", "h1", "h2"])
    return test


def _rebuild(min_chars: int):
    def rebuild(batches):
        for b in _pieces(batches):
            texts, drops = pc.fill_null(b.column("text"), ""), b.column("drops")
            hit = np.flatnonzero(drops.is_valid().to_numpy(zero_copy_only=False))
            gone = [{(d["h1"], d["h2"]) for d in x} for x in drops.take(pa.array(hit)).to_pylist()]
            lines, offsets, at, h = line_keys(texts.take(pa.array(hit)), min_chars)
            keep = np.ones(len(lines), bool)
            for k, row, key in zip(at, np.searchsorted(offsets, at, "right") - 1, map(tuple, h.tolist())):
                keep[k] = key not in gone[row]
            n_dropped, new = np.zeros(b.num_rows, np.int64), {}
            for k, row in enumerate(hit):
                stays = keep[offsets[k]:offsets[k + 1]]
                n_dropped[row] = len(stays) - stays.sum()
                new[row] = "\n".join(lines[offsets[k]:offsets[k + 1]].filter(pa.array(stays)).to_pylist())
            if new:
                mask = np.zeros(b.num_rows, bool)
                mask[hit] = True
                texts = pc.replace_with_mask(texts, pa.array(mask), pa.array([new[r] for r in hit], texts.type))
            n_lines = pc.add(pc.count_substring(pc.fill_null(b.column("text"), ""), "\n"), 1).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("row"), n_lines, pa.array(n_dropped), texts], ["row", "n_lines", "n_dropped", "kept_text"])
    return rebuild


class LineIndex:
    """Line dedup state in the folder ``path``.  ``shards`` is fixed when the folder is new; ``id_type`` is that of the ids."""

    def __init__(self, spark: SparkSession, path: str | None = None, min_docs: int = 3, min_chars: int = 20,
                 shards: int | None = None, id_type: str = "long", block_bytes: int = 64 << 20):
        self.spark, self.min_docs, self.min_chars = spark, min_docs, min_chars
        self.shards, self.id_type, self.block_bytes = shards or shuffle_partitions(spark), id_type, block_bytes
        self.store = VersionedStore(spark, path or shared_folder(spark, "line-index"), {
            "postings": ("batch", f"doc_id {id_type}, text_hash long, lines array<{KEY}>, batch long"),
            "deleted": ("batch", f"doc_id {id_type}, batch long"),
            "refs": ("shard", f"h1 long, h2 long, n_docs long, n_before long, keeper {id_type}, shard int"),
            "filters": ("shard", f"{FILTER.replace('shard int, ', '')}, shard int")})

    def _texts(self, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
        text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
        return docs.select(F.col(f"`{id_col}`").cast(self.id_type).alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))

    def _keyed(self, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
        return self._texts(docs, id_col, text_col).mapInArrow(
            _postings(self.min_chars), f"doc_id {self.id_type}, text_hash long, lines array<{KEY}>")

    def _shard(self):
        return F.pmod("h1", F.lit(self.shards).cast("long")).cast("int")

    def live_postings(self) -> DataFrame:
        p, d = self.store.read("postings").alias("p"), self.store.read("deleted").alias("d")
        return p.join(d, F.col("p.doc_id").eqNullSafe(F.col("d.doc_id")) & (F.col("d.batch") > F.col("p.batch")), "left_anti")

    def refs(self) -> DataFrame:
        """``(h1, h2, n_docs, keeper)``: the keys that live documents hold."""
        return self.store.read("refs").where("n_docs > 0").select("h1", "h2", "n_docs", "keeper")

    def insert(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> int:
        """Adds documents; returns the new version."""
        version = self.store.version() + 1
        folder = self.store.stage("postings", self._keyed(docs, id_col, text_col).withColumn("batch", F.lit(version).cast("long")))
        added = self.store.read("postings", staged=True, only=folder).select("doc_id", F.explode("lines").alias("k"))
        added = added.groupBy("k.h1", "k.h2").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keeper"))
        counts = (self.refs().withColumn("n_before", F.col("n_docs"))
                  .unionByName(added.withColumn("n_before", F.lit(0).cast("long")))
                  .groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_before").alias("n_before"), F.max("keeper").alias("keeper")))
        self._stage_counts(counts)
        return self.store.commit()

    def delete(self, ids: DataFrame, id_col: str = "doc_id") -> int:
        """Takes all documents with these ids back; returns the new version."""
        version = self.store.version() + 1
        ids = stored(ids.select(F.col(f"`{id_col}`").cast(self.id_type).alias("doc_id")).distinct(), "deleted-ids")
        live = self.live_postings()
        same = F.col("p.doc_id").eqNullSafe(F.col("i.doc_id"))
        gone = live.alias("p").join(ids.alias("i"), same, "left_semi").select(F.explode("lines").alias("k"))
        gone = stored(gone.groupBy("k.h1", "k.h2").agg(F.count("*").alias("n_gone")), "deleted-keys")
        rest = live.alias("p").join(ids.alias("i"), same, "left_anti").select("doc_id", F.explode("lines").alias("k"))
        rest = (rest.select("doc_id", "k.h1", "k.h2").join(gone, ["h1", "h2"], "left_semi")
                .groupBy("h1", "h2").agg(F.max("doc_id").alias("next_keeper")))
        shards = [f"shard={r[0]}" for r in gone.select(self._shard()).distinct().collect()]  # names of partitions
        counts = (self.store.read("refs", only=shards).where("n_docs > 0").select("h1", "h2", "n_docs", "keeper")
                  .join(gone, ["h1", "h2"], "left").join(rest, ["h1", "h2"], "left")
                  .select("h1", "h2", (F.col("n_docs") - F.coalesce("n_gone", F.lit(0))).alias("n_docs"), F.col("n_docs").alias("n_before"),
                          F.when(F.col("n_gone").isNull(), F.col("keeper")).otherwise(F.col("next_keeper")).alias("keeper")))
        self.store.stage("deleted", ids.withColumn("batch", F.lit(version).cast("long")))
        self._stage_counts(counts)
        return self.store.commit()

    def _stage_counts(self, counts: DataFrame) -> None:
        """Writes the shards of ``counts`` and brings their filters up to date."""
        written = self.store.stage("refs", counts.withColumn("shard", self._shard()).hint("rebalance", "shard"))
        refs = self.store.read("refs", staged=True, only=written)
        up, down = F.col("n_docs") >= self.min_docs, F.col("n_before") >= self.min_docs
        changes = refs.where(up != down).select("shard", "h1", "h2", up.alias("up"))
        old = self.store.read("filters", only=written).select("shard", "n_keys", "table")
        new = stored(old.groupBy("shard").cogroup(changes.groupBy("shard")).applyInPandas(_update_filter, FILTER), "line-filters")
        full = new.where("table IS NULL").select("shard")
        built = refs.where(up).join(full, "shard", "left_semi").select("shard", "h1", "h2").groupBy("shard").applyInPandas(_new_filter, FILTER)
        self.store.stage("filters", new.where("table IS NOT NULL").union(built))

    def _blocks(self):
        """Filters in blocks of whole shards, each at most ``block_bytes`` (or one shard)."""
        filters = self.store.read("filters")
        sizes = sorted((r.shard, r.bytes) for r in filters.select("shard", F.length("table").alias("bytes")).collect())
        block, total = [], 0
        for shard, size in sizes:
            if block and total + size > self.block_bytes:
                yield filters.where(F.col("shard").isin(block))
                block, total = [], 0
            block.append(shard)
            total += size
        if block:
            yield filters.where(F.col("shard").isin(block))

    def suspects(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """``(doc_id, text_hash, h1, h2)``: lines that pass the filters; all repeated lines and a few others."""
        blocks, keyed = list(self._blocks()), self._keyed(docs, id_col, text_col)
        if len(blocks) > 1:
            keyed = stored(keyed, "line-keys")
        schema, found = f"doc_id {self.id_type}, text_hash long, h1 long, h2 long", None
        for rows in blocks:
            block = self.spark.sparkContext.broadcast(FilterBlock(self.shards, rows.collect()))
            part = stored(keyed.mapInArrow(_suspects(block), schema), "line-suspects")
            found = part if found is None else found.union(part)
            block.destroy()
        return self.spark.createDataFrame([], schema) if found is None else found

    def strip(self, docs: DataFrame, keep: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """``(row, n_lines, n_dropped, kept_text)``: the texts of indexed documents without their repeated lines;
        ``row`` has the columns ``keep`` (all)."""
        counts = self.refs().where(F.col("n_docs") >= self.min_docs)
        drops = (self.suspects(docs, id_col, text_col).join(counts, ["h1", "h2"]).where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
                 .groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("h1", "h2")).alias("drops")))
        row = F.struct(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)]).alias("row")
        text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
        rows = docs.select(row, F.col(f"`{id_col}`").cast(self.id_type).alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
        joined = rows.alias("r").join(drops.alias("d"), F.col("r.doc_id").eqNullSafe(F.col("d.doc_id"))
                                      & (F.col("r.text_hash") == F.col("d.text_hash")), "left").select("r.row", "r.text", "d.drops")
        schema = StructType([joined.schema["row"], StructField("n_lines", LongType()), StructField("n_dropped", LongType()),
                             StructField("kept_text", StringType())])
        return joined.mapInArrow(_rebuild(self.min_chars), schema)
