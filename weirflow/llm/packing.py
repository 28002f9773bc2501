"""Best-fit packing of documents into training sequences of several permitted lengths.

Lengths are UTF-8 bytes, the tokens of a byte-level model. A document longer than the largest capacity is cut into pieces of that
length. Pieces are dealt by hash into shards of about ``SHARD`` pieces, and each shard is packed by variable-capacity best-fit,
largest first: a piece goes to the open bin that it fills best; where none has room a new bin is opened, of the capacity with
the least cost per byte among those allowed that hold it. The shard is packed once for each largest capacity that may be opened, all bins are
then downsized to the least capacity that holds their contents, and the packing that costs least is kept. A shard leaves
a few bins half filled at most, so dealing costs little and nothing is packed in one place.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import ship

CAPACITIES = (2048, 4096, 8192, 16384)
#: A bin costs its capacity, PER_BIN for being a sequence, and attention, which grows with the square of its length.
PER_BIN, QUADRATIC = 128, 1 / 32768
SHARD = 50_000


def _fill(sizes: list[int], opened: list[int], capacities: list[int], cost) -> list[int]:
    """The bin of each size; sizes descend. A bin is opened among ``opened``, or if none holds the piece, the least that does."""
    rooms: list[tuple[int, int]] = []  # (room left, bin), ascending
    out, n = [], 0
    for size in sizes:
        at = bisect_left(rooms, (size, -1))
        if at < len(rooms):
            room, where = rooms.pop(at)
        else:
            fitting = [c for c in opened if c >= size] or [next(c for c in capacities if c >= size)]
            room, where = min(fitting, key=lambda c: (cost(c) / c, c)), n
            n += 1
        out.append(where)
        if room > size or not size:
            insort(rooms, (room - size, where))
    return out


def pack(sizes: list[int], capacities=CAPACITIES, per_bin: float = PER_BIN, quadratic: float = QUADRATIC) -> tuple[list[int], list[int]]:
    """The bin of each size, and the capacity of each bin. Sizes descend; none is larger than the largest capacity."""
    capacities = sorted(capacities)

    def cost(c: int) -> float:
        return per_bin + c + quadratic * c * c

    best = None
    for most in range(1, len(capacities) + 1):
        bins = _fill(sizes, capacities[:most], capacities, cost)
        used = [0] * (max(bins, default=-1) + 1)
        for b, s in zip(bins, sizes):
            used[b] += s
        fitted = [next(c for c in capacities if c >= u) for u in used]
        if best is None or sum(map(cost, fitted)) < best[0]:
            best = (sum(map(cost, fitted)), bins, fitted)
    return best[1], best[2]


def pack_documents(docs: DataFrame, text: str = "text", capacities=CAPACITIES, per_bin: float = PER_BIN, quadratic: float = QUADRATIC, shard: int = SHARD) -> DataFrame:
    """One row per piece of each document: where it comes from, and where it goes.

    Returns doc_id, piece, piece_start and piece_length (bytes of the text's UTF-8), bin_id, bin_capacity, bin_used and position (the
    byte of the bin at which the piece begins). A null or empty text is one piece of length 0, so every row of ``docs`` is in some
    bin. Rows with equal ids are packed each. Other columns are not read; an empty table gives no rows.
    """
    spark = ship(docs.sparkSession)
    largest = max(capacities)
    sizes = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n"))
    pieces = sizes.withColumn("piece", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("n") / largest) - 1, F.lit(0)).cast("int"))))
    start = F.col("piece").cast("long") * largest
    pieces = pieces.select("doc_id", "piece", start.alias("piece_start"), F.least(F.col("n") - start, F.lit(largest)).alias("piece_length"))
    shards = max(1, math.ceil(pieces.count() / shard))
    # The row's place in its partition tells rows with equal ids apart, so that they spread too.
    pieces = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", F.monotonically_increasing_id() % 1024), F.lit(shards)).cast("int"))

    def packed(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["piece_length", "doc_id", "piece"], ascending=[False, True, True], ignore_index=True)
        bins, fitted = pack(pdf["piece_length"].tolist(), capacities, per_bin, quadratic)
        pdf["bin"] = bins
        pdf["bin_id"] = [f"{s}-{b}" for s, b in zip(pdf["shard"], bins)]
        pdf["bin_capacity"] = [fitted[b] for b in bins]
        lengths = pdf.groupby("bin")["piece_length"]
        pdf["bin_used"] = lengths.transform("sum")
        pdf["position"] = lengths.cumsum() - pdf["piece_length"]
        return pdf.drop(columns=["shard", "bin"])

    fields = "doc_id long, piece int, piece_start long, piece_length long, bin_id string, bin_capacity int, bin_used long, position long"
    return pieces.groupBy("shard").applyInPandas(packed, fields)
