"""Exact deduplication by a Golomb-coded fingerprint exchange.

1. Every partition hashes its texts to fingerprints of log2(rows) +
   ``extra_bits`` bits, and sends each owner (a range of fingerprints) one message:
   its distinct fingerprints, sorted, as Golomb-Rice coded gaps.
2. An owner decodes its messages, finds the fingerprints that occur more than
   once, and answers each message with a bitmap, one bit per fingerprint.
3. Senders read the bitmaps against the messages they sent.  Documents with a
   marked fingerprint are suspects; only their texts are shuffled, and grouping by the
   text itself verifies the bytes.

Scale: a message holds one partition's share of a range; an owner holds about
``per_owner`` fingerprints.  Copies of a text meet once per partition: the
sender merges them before it sends, and grouping by text combines on the map
side.  Joins that a hot text skews have one row per text on one side, so the
planner can split the other.  Messages are written to the shared checkpoint
folder; a lost executor costs its tasks only.

Defined cases: null text counts as empty; of equal texts the largest id stays;
rows of equal id and text are kept or dropped together; a null id is kept
only if all ids of its group are null; empty input gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firn.llm.common import shuffle_partitions, stored

MESSAGE = "owner int, sender int, n int, shift int, quotients binary, rests binary, repeated binary"


def rice_encode(values: np.ndarray, shift: int) -> tuple[bytes, bytes]:
    """Gaps of sorted non-negative ints: quotients in unary (a 1 ends each), rests in ``shift`` bits."""
    gaps = np.diff(values, prepend=0).astype(np.int64)
    ends = np.cumsum((gaps >> shift) + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1 if len(ends) else 0, np.uint8)
    unary[ends] = 1
    rests = (gaps[:, None] >> np.arange(shift)[None, :]) & 1
    return np.packbits(unary).tobytes(), np.packbits(rests.astype(np.uint8)).tobytes()


def rice_decode(n: int, shift: int, quotients: bytes, rests: bytes) -> np.ndarray:
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(quotients, np.uint8)))[:n]
    high = np.diff(ends, prepend=-1) - 1
    bits = np.unpackbits(np.frombuffer(rests, np.uint8), count=n * shift).reshape(n, shift).astype(np.int64)
    return np.cumsum((high.astype(np.int64) << shift) + bits @ (np.int64(1) << np.arange(shift, dtype=np.int64)))


def _send(bits: int, owners: int):
    width = -(-(1 << bits) // owners)  # fingerprints in an owner's range

    def send(frames):
        parts = [f["fp"].to_numpy() for f in frames]
        fps, times = np.unique(np.concatenate(parts), return_counts=True) if parts else (np.empty(0, np.int64),) * 2
        if not len(fps):
            return
        sender, at = TaskContext.get().partitionId(), fps // width
        rows = []
        for owner in np.unique(at):
            a, b = np.searchsorted(at, [owner, owner + 1])
            own = fps[a:b] - owner * width
            shift = max(1, int(math.log2(max(2.0, 0.69 * width / len(own)))))
            rows.append((owner, sender, len(own), shift, *rice_encode(own, shift), np.packbits(times[a:b] > 1).tobytes()))
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in MESSAGE.split(", ")])
    return send


def _answer(messages: pd.DataFrame) -> pd.DataFrame:
    sent = [rice_decode(m.n, m.shift, m.quotients, m.rests) for m in messages.itertuples()]
    seen, times = np.unique(np.concatenate(sent), return_counts=True)
    twice = seen[times > 1]
    return pd.DataFrame({"owner": messages["owner"], "sender": messages["sender"],
                         "marked": [np.packbits(np.isin(x, twice, assume_unique=True)).tobytes() for x in sent]})


def _receive(bits: int, owners: int):
    width = -(-(1 << bits) // owners)

    def receive(frames):
        for f in frames:
            found = [np.empty(0, np.int64)]
            for m in f.itertuples():
                marks = np.frombuffer(m.marked, np.uint8) | np.frombuffer(m.repeated, np.uint8)
                if marks.any():
                    own = rice_decode(m.n, m.shift, m.quotients, m.rests)
                    found.append(own[np.unpackbits(marks, count=m.n).astype(bool)] + m.owner * width)
            yield pd.DataFrame({"fp": np.unique(np.concatenate(found))})
    return receive


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", extra_bits: int = 8,
                per_owner: int = 2_000_000) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``, one row per document."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    hashed = stored(texts.select("doc_id", F.xxhash64("text").alias("hash"), F.sha2("text", 256).alias("text_sha256")),
                    "dedup-hashes")
    n = hashed.count()
    bits = min(48, math.ceil(math.log2(max(2, n))) + extra_bits)
    owners = max(min(shuffle_partitions(spark), n // 1000 + 1), math.ceil(n / per_owner))
    fp = F.shiftrightunsigned("hash", 64 - bits).alias("fp")
    messages = stored(hashed.select(fp).mapInPandas(_send(bits, owners), MESSAGE), "dedup-messages")
    answers = messages.groupBy("owner").applyInPandas(_answer, "owner int, sender int, marked binary")
    suspects = stored(messages.join(answers, ["owner", "sender"]).mapInPandas(_receive(bits, owners), "fp long")
                      .distinct(), "dedup-suspects")
    groups = (texts.withColumn("hash", F.xxhash64("text"))
              .join(suspects, F.shiftrightunsigned("hash", 64 - bits) == F.col("fp"), "left_semi")
              .groupBy("hash", "text").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
              .where("group_size > 1")
              .select("hash", F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size"))
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return (hashed.join(groups, ["hash", "text_sha256"], "left")
            .select("doc_id", keep.alias("keep_id"),
                    F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                    F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256"))
