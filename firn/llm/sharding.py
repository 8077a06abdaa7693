"""Minimax contiguous sharding (DataFrame only).

Documents with equal texts form an atomic group of the summed size.  Groups
stand in the order of their text's SHA-256; the order is cut into ``n``
contiguous shards so that the largest shard is as small as any such cut
allows.  A binary search finds that capacity; a capacity is feasible if
filling shards greedily from the left needs at most ``n``.

Scale: the search runs on a histogram of the order, never on all groups.  It
starts with 4096 cells (three hex digits).  A cell of more than one group
counts as divisible anywhere for the lower bound of the capacity and as one
piece for the upper bound; cells in which a cut may fall between the two are
split by three more digits, until the bounds meet or only single groups
remain.  The driver holds at most some thousand cells a cut.  Slots come
from counts per (shard, cell of the id's hash) and a window inside a cell.
Only ids, sizes and hashes are shuffled.

With a group above the mean the greedy fill would leave shards empty, so
among all cuts of the smallest capacity each shard ends where its load is
nearest to an even share of what is left.

Defined cases: null text has no bytes and is a group of its own per id; empty
input gives no rows; rows of equal id and text share a group and get
different slots; more shards than groups leaves shards empty.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firn.llm.common import stored

DIGITS = 3  # hex digits by which a cell is split
SLOT_CELLS = 4096


def _histogram(rows: DataFrame, prefixes: list[str] | None, digits: int) -> dict[str, tuple[int, bool]]:
    """Bytes of the cells of ``digits`` digits inside ``prefixes`` (all if None), and whether a cell is a single group."""
    if prefixes is not None:
        rows = rows.where(F.substring("text_key", 1, digits - DIGITS).isin(prefixes))
    cells = rows.groupBy(F.substring("text_key", 1, digits).alias("cell")).agg(
        F.sum("size").alias("bytes"), (F.min("text_key") == F.max("text_key")).alias("single"))
    return {r["cell"]: (int(r["bytes"]), r["single"]) for r in cells.collect()}


def _fill(starts: list[int], solid: list[bool], capacity: int, n: int) -> tuple[bool, list[int]]:
    """Greedy fill from the left: whether ``n`` shards hold everything, and the
    byte position of each cut.  ``starts`` has the byte position of each piece and the end; a piece that
    isn't ``solid`` can be cut anywhere."""
    cuts, at, end = [], 0, starts[-1]
    for _ in range(n):
        if at >= end:
            break
        reach = at + capacity
        if reach >= end:
            at = end
        else:
            k = bisect_right(starts, reach) - 1  # the piece that the reach falls into
            to = starts[k] if solid[k] else reach
            if to <= at:
                return False, cuts
            at = to
        cuts.append(at)
    return at >= end, cuts


def _least_capacity(starts: list[int], solid: list[bool], n: int) -> int:
    low, high = -(-starts[-1] // n), starts[-1]
    while low < high:
        mid = (low + high) // 2
        if _fill(starts, solid, mid, n)[0]:
            high = mid
        else:
            low = mid + 1
    return low


def shard_cuts(rows: DataFrame, n: int) -> tuple[int, list[str]]:
    """The least capacity and the text keys at which shards 1 to n - 1 begin; ``rows`` has text_key and size."""
    cells = _histogram(rows, None, DIGITS)
    if not cells:
        return 0, []
    while True:
        names = sorted(cells)
        starts = [0]
        for c in names:
            starts.append(starts[-1] + cells[c][0])
        single = [cells[c][1] for c in names]
        low = _least_capacity(starts, single, n)
        high = _least_capacity(starts, [True] * len(names), n)
        if low == high:
            break
        first, last = _fill(starts, single, low, n)[1], _fill(starts, [True] * len(names), high, n)[1]
        early = _fill(starts, [True] * len(names), low, n)[1]
        late = _fill(starts, single, high, n)[1]
        split = set()
        for j in range(n - 1):
            ends = [x[j] if j < len(x) else starts[-1] for x in (first, last, early, late)]
            a, b = bisect_right(starts, min(ends)) - 1, bisect_right(starts, max(ends)) - 1
            split |= {names[k] for k in range(max(0, a - 1), min(b + 1, len(names))) if not single[k]}
        digits = min((len(c) for c in split), default=0)
        split = sorted(c for c in split if len(c) == digits)
        if not split or digits + DIGITS > 64:
            low = high
            break
        for c in split:
            del cells[c]
        cells |= _histogram(rows, split, digits + DIGITS)
    return low, _even_cuts(names, starts, low, n)


def _even_cuts(names: list[str], starts: list[int], capacity: int, n: int) -> list[str]:
    """Of the cuts that keep to the capacity, those nearest to even shares."""
    end, latest_rest = starts[-1], [starts[-1]]
    for _ in range(n):  # the least position from which the shards after it still hold the rest
        k = next(i for i, s in enumerate(starts) if latest_rest[-1] - s <= capacity)
        latest_rest.append(starts[k])
    cuts, at = [], 0
    for j in range(1, n):
        least, most = latest_rest[n - j], at + capacity
        even = at + (end - at) / (n - j + 1)
        fits = [s for s in starts if max(least, at) <= s <= most]
        at = min(fits, key=lambda s: abs(s - even)) if fits else min(most, end)
        k = min(bisect_right(starts, at) - 1, len(names))
        cuts.append(names[k] if k < len(names) else "g")  # "g" is behind all hex digits
    return cuts


def shard(docs: DataFrame, n: int = 8, id_col: str = "doc_id", text_col: str = "text",
          keep: list[str] | None = None) -> DataFrame:
    """``(doc_id, size, text_crc32, shard, slot)`` of every document, or
    its columns in ``keep`` with shard and slot."""
    text, id_ = F.col(text_col), F.col(id_col)
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1
    key = F.coalesce(F.sha2(text, 256), F.sha2(F.concat(F.lit("null:"), F.coalesce(id_.cast("string"), F.lit(""))), 256))
    own = F.struct(id_.alias("doc_id"), size.alias("size"), F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"))
    rows = docs.select(own.alias("own"), key.alias("text_key"), size.alias("size"))
    light = stored(rows, "shard-rows")
    cuts = shard_cuts(light, n)[1]
    number = sum((F.when(F.col("text_key") >= c, 1).otherwise(0) for c in cuts), F.lit(0))

    def placed(rows: DataFrame) -> DataFrame:
        return (rows.withColumn("shard", number.cast("int"))
                .withColumn("cell", F.pmod(F.xxhash64("own.doc_id", "text_key"), F.lit(SLOT_CELLS))))
    counts = placed(light).groupBy("shard", "cell").agg(F.count("*").alias("n"))
    upto = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("shard", "cell", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before"))
    inside = Window.partitionBy("shard", "cell").orderBy("own.doc_id", "text_key")
    rows = light if keep is None else docs.select(own.alias("own"), key.alias("text_key"), F.struct(*keep).alias("row"))
    out = (placed(rows).join(counts, ["shard", "cell"])
           .withColumn("slot", (F.col("before") + F.row_number().over(inside) - 1).cast("long")))
    columns = ["own.*"] if keep is None else [F.col(f"row.`{c}`").alias(c) for c in keep]
    return out.select(*columns, "shard", "slot")


def sharded_documents(docs: DataFrame, n: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``shard`` and ``slot`` (columns of these names give way to them)."""
    return shard(docs, n, id_col, text_col, [c for c in docs.columns if c not in ("shard", "slot")])
