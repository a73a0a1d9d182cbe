"""Shards of nearly equal bytes by histogram sort: probe key boundaries, count exactly, refine, then exchange once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears_mart.llm.columns import byte_length, fields, whole_row
from arrears_mart.stages import stage_table

_DIGIT, _LEAST_DIGIT = 12, 4  # a round probes 2^12 boundaries in all, but 2^4 in each interval at least
_MOST_PARTS = 4096
_LOWEST = -(1 << 63)


@dataclass(frozen=True)
class Splitter:
    """A 128-bit key boundary with the exact bytes and rows below it."""

    value: int
    bytes_below: int
    rows_below: int


def _key_bits(taken: int) -> tuple[Column, Column]:
    """The first `taken` bits of the 128-bit key (_k1, _k2), in key order, as two longs."""
    first = F.shiftrightunsigned(F.col("_k1").bitwiseXOR(F.lit(_LOWEST)), 64 - min(taken, 64))
    if taken <= 64:
        return first, F.lit(0).cast("long")
    return first, F.shiftrightunsigned(F.col("_k2").bitwiseXOR(F.lit(_LOWEST)), 128 - taken)


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >= 1 << 63 else bits


def _prefix_pair(prefix: int, taken: int) -> tuple[int, int]:
    if taken <= 64:
        return _signed(prefix), 0
    return _signed(prefix >> (taken - 64)), prefix & ((1 << (taken - 64)) - 1)


def find_splitters(keys: DataFrame, goals: list[float], tolerances: list[float]) -> list[Splitter]:
    """For each goal (bytes below, rising) a boundary within its tolerance, or the nearest one that rows allow.

    `keys` has _k1, _k2 and size. Every round counts, in one job, bytes and rows below each probe of all intervals that
    still hold an unmet goal: at most 4096 counts, or 16 for each goal, come to the driver, whatever the number of rows.
    """
    found: dict[int, Splitter] = {}
    # Intervals by the key bits that lead to them, with bytes and rows below and the goals in them.
    open_: dict[int, tuple[int, int, list[int]]] = {0: (0, 0, list(range(len(goals))))}
    taken = 0
    while open_:
        digit = max(_DIGIT - (len(open_) - 1).bit_length(), _LEAST_DIGIT)
        step = min(digit, (64 if taken < 64 else 128) - taken)
        p1, p2 = _key_bits(taken + step)
        level = keys.select(p1.alias("p1"), p2.alias("p2"), "size", *((c.alias(n) for c, n in zip(_key_bits(taken), ("q1", "q2"))) if taken else ()))
        if taken:
            wanted = keys.sparkSession.createDataFrame([_prefix_pair(p, taken) for p in open_], "q1 long, q2 long")
            level = level.join(F.broadcast(wanted), ["q1", "q2"])  # a row for each unmet goal at most
        counts = level.groupBy("p1", "p2").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).collect()
        taken += step
        cells: dict[int, list[tuple[int, int, int]]] = {}
        for r in counts:
            p = r.p1 % (1 << 64) if taken <= 64 else ((r.p1 % (1 << 64)) << (taken - 64)) | r.p2
            cells.setdefault(p >> step, []).append((p, r.b, r.n))
        further: dict[int, tuple[int, int, list[int]]] = {}
        for interval, (below, rows, wanted_goals) in open_.items():
            waiting = list(wanted_goals)
            for p, size, n in sorted(cells.get(interval, [])):
                here = [g for g in waiting if goals[g] < below + size]
                waiting = waiting[len(here) :]
                low = Splitter(p << (128 - taken), below, rows)
                high = Splitter((p + 1) << (128 - taken), below + size, rows + n)
                for g in here:
                    near = min((low, high), key=lambda s: abs(s.bytes_below - goals[g]))
                    if abs(near.bytes_below - goals[g]) <= tolerances[g] or n == 1 or taken == 128:
                        found[g] = near
                    else:
                        further.setdefault(p, (below, rows, []))[2].append(g)
                below, rows = below + size, rows + n
            for g in waiting:  # nothing lies above these goals
                found[g] = Splitter((interval + 1) << (128 - taken + step), below, rows)
        open_ = further
    return [found[g] for g in range(len(goals))]


def _parts_below(splitters: list[Splitter]) -> Column:
    """How many splitters are not above the key, by halving: a row meets about log2 of them."""
    if not splitters:
        return F.lit(0)

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        value = splitters[mid].value
        if value >= 1 << 128:
            return search(low, mid)
        s1, s2 = (value >> 64) + _LOWEST, (value & ((1 << 64) - 1)) + _LOWEST
        above = (F.col("_k1") > s1) | ((F.col("_k1") == s1) & (F.col("_k2") >= s2))
        return F.when(above, search(mid + 1, high)).otherwise(search(low, mid))

    return search(0, len(splitters))


def shard_documents(
    docs: DataFrame,
    shards: int = 40,
    text_col: str = "text",
    id_col: str = "doc_id",
    tolerance: float = 0.005,
    part_bytes: int = 256 << 20,
) -> DataFrame:
    """`docs` with size, text_crc32, law, shard, slot and grown_shard (columns so named are replaced, all others kept).

    The law is `bytes`: a shard's bytes differ from the mean by at most `tolerance` of it for each of its two ends, or
    by what one row holds. The key is a hash of the text, then one of the id: equal texts stand together and part only
    where a group is too large for its shard. Rows of equal text and id are never parted. A shard is written by several
    tasks of about `part_bytes`, _MOST_PARTS at most in all; slots run on through them from the exact counts below each boundary. Null texts have no
    bytes and a null checksum, null ids are one id; an empty table gives an empty result.
    """
    text = F.col(text_col)
    keys = {
        "size": byte_length(text) + 16,
        "text_crc32": F.crc32(text.cast("binary")),
        "_k1": F.xxhash64(text, text.isNull()),
        "_k2": F.xxhash64(F.col(id_col), F.lit(1)),
    }
    narrow = stage_table(docs.select(*[c.alias(n) for n, c in keys.items()]).select("_k1", "_k2", "size"), "shard-keys")
    total = narrow.agg(F.sum("size")).first()[0] or 0
    parts = max(1, min(round(total / shards / part_bytes), _MOST_PARTS // shards))
    goals = [total * i / (shards * parts) for i in range(1, shards * parts)]
    mean = total / shards
    loose = [tolerance if (i + 1) % parts == 0 else 0.1 / parts for i in range(len(goals))]
    found = find_splitters(narrow, goals, [mean * t for t in loose]) if total else [Splitter(1 << 128, 0, 0)] * len(goals)
    # Inner boundaries stay between those of their shard.
    for i in range(len(found)):
        if (i + 1) % parts:
            low = found[i - (i % parts) - 1] if i >= parts else Splitter(0, 0, 0)
            top = i - (i % parts) + parts - 1
            found[i] = max(low, min(found[i], found[top] if top < len(found) else found[i], key=lambda s: s.value), key=lambda s: s.value)
    inner = {i for i in range(len(found)) if (i + 1) % parts}
    if inner:
        for s in range(shards):
            own = [i for i in range(s * parts, (s + 1) * parts - 1)]
            for i, x in zip(own, sorted((found[i] for i in own), key=lambda x: x.value)):
                found[i] = x
    starts = [0, *(s.rows_below for s in found)]
    first_slot = F.array(*[F.lit(starts[p] - starts[p - p % parts]).cast("long") for p in range(shards * parts)])
    names = [c for c in docs.columns if c not in ("size", "text_crc32", "law", "shard", "slot", "grown_shard")]
    placed = docs.select(whole_row(docs).alias("_row"), *[c.alias(n) for n, c in keys.items()]).withColumn("_part", _parts_below(found))
    placed = placed.repartitionById(shards * parts, "_part").sortWithinPartitions("_k1", "_k2")
    # The number within its task is the lower half of this id.
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return placed.select(
        *fields("_row", names),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.floor(F.col("_part") / parts).cast("int").alias("shard"),
        (F.element_at(first_slot, F.col("_part") + 1) + within).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
