"""Near-duplicate detection: MinHash signatures in a multi-index Hamming join.

1. A document's set is its distinct 5-word shingles as 64-bit hashes.  Equal sets
   form a class; its least id stands for it.
2. A class has a signature of 48 b-bit minwise values (b = 16), cut into 12
   chunks of 4.  Two signatures that differ in at most 23 of the 48 have, by pigeonhole,
   a chunk with at most one difference.  So every chunk is enumerated with each one of
   its 4 values left out: 48 keys a class.  All pairs under the threshold share a key.
3. Round one compares each class with up to ``tries`` hubs: of each of its keys the class whose
   keys are the most common, which is the one that others were copied from if any is.  Full sets confirm
   the links, and components are built.
4. Round two takes the keys whose classes still are in different components.  A class of n
   shingles of which u occur in no other such class overlaps with none by more than n - u, and two classes
   overlap by no more than their shingles do in each of 256 hashed buckets; classes and
   pairs that these bounds exclude are left out, which loses nothing.  The rest are formed
   in blocks and confirmed on full sets too, however many places of their signatures agree: sharing a key is the only
   threshold on signatures.  Each pair comes up in the first of its keys only.  Pairs inside a component add nothing to it, so the components are those of all links.

A pair at similarity 0.75 differs in 12 of 48 values on average; the chance that it
shares no key is (1 - p)^12 with p = 0.74, about 1e-7.

Scale: no pair is made inside a component, and a key's hub is found on the map side.
A key with more than ``block`` classes is dealt over block pairs, so no task takes a whole key.
Sets are rebuilt from the texts of linked classes only; they are never collected.

Defined cases: null text or a text without words has an empty set and links with
nothing; a text of fewer than five words has one shingle; a null id is never a
component's id (its row has a null component unless its class has other ids); repeated rows
are copies of each other; empty input gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firn.llm.common import stored
from firn.llm.components import connected_components

SHINGLE = 5
VALUES, CHUNK = 48, 4  # signature length; values in a chunk
BUCKETS = 256
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(20240607)
_XOR = _rng.integers(0, 1 << 32, VALUES, dtype=np.uint32)
_MUL = _rng.integers(0, 1 << 32, VALUES, dtype=np.uint32) | np.uint32(1)
SIGNATURE = "id long, n_shingles long, set_a long, set_b long, signature binary"


class _WordHashes(dict):
    """64-bit hash of each word, remembered while there are few enough."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def shingle_set(text: bytes | None, hashes: _WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text; words part at ASCII white space."""
    words = text.translate(_LOWER).split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    h = np.array([hashes[w] for w in words], np.uint64)
    n = min(SHINGLE, len(h))
    out = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        out = (out ^ h[k:len(h) - n + 1 + k]) * _MIX
        out ^= out >> np.uint64(29)
    return np.unique(out)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The low 16 bits, well mixed, of the least value of each of the hash functions."""
    h = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    least = np.full(VALUES, 0xFFFFFFFF, np.uint32)
    for a in range(0, len(h), 4096):
        x = (h[a:a + 4096, None] ^ _XOR) * _MUL
        least = np.minimum(least, (x ^ (x >> np.uint32(15))).min(axis=0))
    return ((least * np.uint32(0x85EBCA6B)) >> np.uint32(16)).astype(np.uint16)


def _signatures(batches):
    hashes = _WordHashes()
    for batch in batches:
        rows = []
        for a in range(0, batch.num_rows, 512):
            part = batch.slice(a, 512)
            for text in part.column(1).cast(pa.binary()).to_pylist():
                s = shingle_set(text, hashes)
                both = (s ^ (s >> np.uint64(31))) * _MIX
                rows.append((len(s), int(s.sum(dtype=np.uint64).view(np.int64)), int(both.sum(dtype=np.uint64).view(np.int64)),
                             signature(s).tobytes() if len(s) else None))
        n, a, b, sig = zip(*rows) if rows else ((),) * 4
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.int64()),
                                          pa.array(b, pa.int64()), pa.array(sig, pa.binary())],
                                         names=["id", "n_shingles", "set_a", "set_b", "signature"])


def signature_keys(signatures: np.ndarray) -> np.ndarray:
    """The keys of each signature: a chunk's values with one left out, and which one."""
    chunks = signatures.reshape(len(signatures), VALUES // CHUNK, CHUNK).astype(np.int64)
    keys = []
    for gone in range(CHUNK):
        rest = [k for k in range(CHUNK) if k != gone]
        value = (chunks[:, :, rest[0]] << 32) | (chunks[:, :, rest[1]] << 16) | chunks[:, :, rest[2]]
        keys.append(value | ((np.arange(VALUES // CHUNK) * CHUNK + gone) << 48))
    return np.concatenate(keys, axis=1)


def _as_matrix(column, width: int = VALUES) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, width)


def _keys(batches):
    for batch in batches:
        if batch.num_rows:
            keys = signature_keys(_as_matrix(batch.column(1)))
            ids = np.repeat(batch.column(0).to_numpy(), keys.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(ids)], names=["key", "id"])


def _sets(batches):
    hashes = _WordHashes()
    for batch in batches:
        for a in range(0, batch.num_rows, 512):
            part = batch.slice(a, 512)
            sets = [shingle_set(t, hashes).view(np.int64) for t in part.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["id", "shingles"])


def _bucket_counts(batches):
    """How many of a set's shingles fall into each bucket; not used for sets of over 65535, whose counts may not fit."""
    for batch in batches:
        sets = batch.column(1).to_numpy(zero_copy_only=False)
        counts = [np.bincount(np.asarray(x, np.int64) & (BUCKETS - 1), minlength=BUCKETS).astype(np.uint16).tobytes() for x in sets]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.binary())], names=["id", "buckets"])


def _close_pairs(percent: int, cells: int = 1_000_000):
    """Rows (key, i, j, side, component, id, n, most, signature, buckets) sorted by (key, i, j): pairs of
    different components, one from block i and one from block j, that can overlap enough (``most`` bounds a
    set's overlap with any other, the buckets that of a pair)."""
    def enough(both, n, m):  # 100 both >= percent (n + m - both)
        return (100 + percent) * both >= percent * (n + m)

    def of(key, side, component, ids, n, most, sig, buckets):
        left, right = np.flatnonzero(side <= 1), np.flatnonzero(side >= 1)
        step = max(1, cells // max(1, len(right)))
        for a in range(0, len(left), step):
            l = left[a:a + step]
            able = enough(np.minimum(most[l][:, None], most[right][None, :]), n[l][:, None], n[right][None, :])
            x, y = np.nonzero(able & (component[l][:, None] != component[right][None, :]))
            x, y = l[x], right[y]
            for b in range(0, len(x), cells // VALUES):
                u, v = x[b:b + cells // VALUES], y[b:b + cells // VALUES]
                same = (sig[u] == sig[v]).reshape(-1, VALUES // CHUNK, CHUNK)
                # the first key of the pair: its first chunk with one difference at most
                chunk = (same.sum(axis=2) >= CHUNK - 1).argmax(axis=1)
                first = chunk * CHUNK + same[np.arange(len(chunk)), chunk].argmin(axis=1)
                u, v = u[first == key >> 48], v[first == key >> 48]
                for c in range(0, len(u), cells // BUCKETS):
                    s, t = u[c:c + cells // BUCKETS], v[c:c + cells // BUCKETS]
                    fits = enough(np.minimum(buckets[s], buckets[t]).sum(axis=1, dtype=np.int64), n[s], n[t])
                    fits |= np.minimum(n[s], n[t]) > 65535
                    s, t = ids[s[fits]], ids[t[fits]]
                    yield np.stack((np.minimum(s, t), np.maximum(s, t)), 1)

    def run(batches):
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            rest = pa.concat_tables([rest, table]).combine_chunks() if rest is not None else table
            yield from cut(rest, False)
            at = starts(rest)
            rest = rest.slice(at[-1]) if len(at) else rest
        if rest is not None:
            yield from cut(rest, True)

    def starts(table):
        new = np.zeros(table.num_rows, bool)
        new[:1] = True
        for c in ("key", "i", "j"):
            g = table.column(c).to_numpy()
            new[1:] |= g[1:] != g[:-1]
        return np.flatnonzero(new)

    def cut(table, end):
        """Whole groups; the last one may go on in the next batch."""
        if not table.num_rows:
            return
        at = np.append(starts(table), table.num_rows)
        columns = [table.column(c).to_numpy() for c in ("key", "side", "component", "id", "n", "most")]
        sig, buckets = _as_matrix(table.column("signature")), _as_matrix(table.column("buckets"), BUCKETS)
        found = [np.empty((0, 2), np.int64)]
        for a, b in zip(at[:-1], at[1:] if end else at[1:-1]):
            key, *rest = (c[a:b] for c in columns)
            found += of(int(key[0]), *rest, sig[a:b], buckets[a:b])
        found = np.unique(np.concatenate(found), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])
    return run


def shingle_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``(id, shingles)`` of the documents in ``ids``; ``docs`` has unique id and text."""
    return stored(docs.join(stored(ids, "near-wanted"), "id", "left_semi").mapInArrow(_sets, "id long, shingles array<long>"), "near-sets")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int = 75) -> DataFrame:
    """The pairs (a, b) whose full shingle sets overlap enough."""
    a, b = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), sets.select(
        F.col("id").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(b, "b").join(a, "a").withColumn("both", both)
            .where(100 * F.col("both") >= percent * (F.size("sa") + F.size("sb") - F.col("both"))).select("a", "b"))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75,
               block: int = 1024, tries: int = 3) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row per document."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    signed = stored(texts.mapInArrow(_signatures, SIGNATURE), "near-signatures")
    alike = ["n_shingles", "set_a", "set_b"]
    classes = stored(signed.where("n_shingles > 0 and id is not null").groupBy(*alike)
                     .agg(F.min("id").alias("rep"), F.first("signature").alias("signature")), "near-classes")
    keyed = classes.select("rep", "signature").mapInArrow(_keys, "key long, id long")
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = stored(keyed.join(shared, "key"), "near-members")
    # one row per class: copies of an id would double the pairs
    reps = texts.join(classes.select(F.col("rep").alias("id")), "id", "left_semi")
    reps = reps.dropDuplicates(["id"]) if _repeated(signed) else reps

    common = members.groupBy("id").agg(F.sum("n").alias("common"))
    ranked = members.join(common, "id")
    hubs = ranked.groupBy("key").agg(F.max(F.struct("common", (-F.col("id")).alias("id"))).alias("hub"))
    stars = (members.join(hubs.select("key", (-F.col("hub.id")).alias("hub")), "key").where("id <> hub")
             .groupBy("id", "hub").agg(F.count("*").alias("keys")))
    best = Window.partitionBy("id").orderBy(F.desc("keys"), "hub")  # at most as many rows as a class has keys
    nearest = stored(stars.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= tries)
                     .select(F.col("hub").alias("a"), F.col("id").alias("b")), "near-stars")
    first = stored(confirmed(nearest, shingle_sets(reps, _ends(nearest)), percent), "near-links")
    one = connected_components(first)

    placed = stored(members.join(one, "id", "left").select(
        "key", "id", F.coalesce("component", "id").alias("component")), "near-placed")
    open_keys = stored(placed.join(_mixed(placed), "key", "left_semi"), "near-open")
    sets = shingle_sets(reps, open_keys.select("id").distinct())
    able = stored(_able(sets, classes, percent), "near-able")
    left = open_keys.join(able, "id")
    left = left.join(_mixed(left), "key")
    g = F.ceil(F.col("members") / block).cast("long")
    dealt = (left.withColumn("mine", F.pmod(F.xxhash64("id"), g))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), g - 1)))
             .select("key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
                     F.when(F.col("mine") == F.col("other"), 1).when(F.col("mine") < F.col("other"), 0).otherwise(2)
                     .alias("side"), "component", "id", "n", "most", "signature", "buckets"))
    pairs = (dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
             .mapInArrow(_close_pairs(percent), "a long, b long"))
    pairs = stored(pairs, "near-pairs")
    second = confirmed(pairs, sets.join(_ends(pairs), "id", "left_semi"), percent)
    whole = connected_components(first.union(second))

    member = classes.join(whole, classes["rep"] == whole["id"], "left").select(
        *alike, F.coalesce("component", "rep").alias("class_component"))
    out = signed.drop("signature").join(member, alike, "left")
    component = F.when(F.col("n_shingles") > 0, F.col("class_component")).otherwise(F.col("id"))
    return out.select(F.col("id").alias("doc_id"), "n_shingles", component.alias("component_id"),
                      F.col("id").eqNullSafe(component).alias("kept"))


def _mixed(placed: DataFrame) -> DataFrame:
    """The keys whose classes are in different components, and how many classes they have."""
    return (placed.groupBy("key").agg(F.count("*").alias("members"), F.min("component").alias("low"), F.max("component").alias("high"))
            .where("low < high").select("key", "members"))


def _able(sets: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """``(id, n, most, signature, buckets)`` of the classes that can link to another one of ``sets``:
    ``most`` of the n shingles also occur in others of them."""
    alone = (sets.select("id", F.explode("shingles").alias("shingle")).groupBy("shingle")
             .agg(F.count("*").alias("times"), F.min("id").alias("id")).where("times = 1")
             .groupBy("id").agg(F.count("*").alias("alone")))
    n = F.col("n_shingles")
    most = n - F.coalesce("alone", F.lit(0))
    return (sets.mapInArrow(_bucket_counts, "id long, buckets binary")
            .join(classes.select(F.col("rep").alias("id"), "n_shingles", "signature"), "id")
            .join(alone, "id", "left").where(100 * most >= percent * n)
            .select("id", n.alias("n"), most.alias("most"), "signature", "buckets"))


def _repeated(signed: DataFrame) -> bool:
    """Whether an id occurs twice."""
    return not signed.where("id is not null").groupBy("id").count().where("count > 1").isEmpty()


def distinct_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The columns of ``docs``, of each group of near-duplicates the document with the
    least id (all rows that share it); rows with a null id stay."""
    gone = stored(near_dedup(docs, id_col, text_col, **how).where("not kept").select(F.col("doc_id").alias("_gone")), "near-gone")
    return docs.join(gone, F.col(id_col) == F.col("_gone"), "left_anti")
