"""Filling sequences of fixed capacity with whole texts, planned over the histogram of lengths."""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections import defaultdict

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import stored

PLAN = "length long, rank_lo long, rank_hi long, bin long, per_bin long, offset long"
#: Pieces ranked by one task at most, whatever a length's share.
RANKED = 200_000


def plan(histogram: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Best fit, longest first, over counts: ``(slots, bins)``. A slot (length, rank_lo, rank_hi, bin, per_bin, offset) places the
    pieces of that length with rank in [rank_lo, rank_hi): ``per_bin`` to a bin from ``bin`` on, the first at ``offset``.

    Open bins with the same room lie together as ranges of bin numbers, so a step handles all pieces of a length and all bins
    of a room at once. Lengths are at most ``capacity``; the work and the plan depend on it, not on the number of pieces.
    """
    slots, bins = [], 0
    rooms: list[int] = []  # rooms that have open bins, ascending
    open_bins: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room -> (first bin, number)

    def leave(room: int, first: int, number: int) -> None:
        if room and number:
            if not open_bins[room]:
                insort(rooms, room)
            open_bins[room].append((first, number))

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, number = open_bins[room].pop()
                if not open_bins[room]:
                    rooms.pop(at)
                each = room // length  # a bin in use stays the tightest until nothing more fits
                full = min(number, left // each)
                used = full * each
                if full:
                    slots.append((length, rank, rank + used, first, each, capacity - room))
                    leave(room - each * length, first, full)
                rest = left - used if full < number else 0
                if rest:
                    rest = min(rest, each)
                    slots.append((length, rank + used, rank + used + rest, first + full, rest, capacity - room))
                    leave(room - rest * length, first + full, 1)
                    full += 1
                leave(room, first + full, number - full)
                rank, left = rank + used + rest, left - used - rest
            else:
                each = capacity // length
                new = math.ceil(left / each)
                leave(capacity, bins, new)
                bins += new
    return slots, bins


def pack(df: DataFrame, id_col: str, length_col: str, capacity: int) -> DataFrame:
    """(id, piece, start, length, sequence, offset): the place of each text in sequences of ``capacity``. A text longer than that
    is cut into pieces of ``capacity`` (the last has the rest); no other is split. ``start`` is the piece's place in its text,
    ``offset`` in its sequence.

    Texts of length 0 or null take no room: one row, length 0, sequence and offset null. Ids may be null or repeated; rows with
    equal id and length are interchangeable. Empty tables give no rows.
    """
    spark = df.sparkSession
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(length_col).cast("long"), F.lit(0)).alias("n"))
    cuts = F.when(F.col("n") > 0, F.sequence(F.lit(0), F.floor((F.col("n") - 1) / capacity))).otherwise(F.array(F.lit(0).cast("long")))
    pieces = rows.select("id", "n", F.explode(cuts).alias("piece")).select("id", "piece", (F.col("piece") * capacity).alias("start"), F.least(F.lit(capacity), F.col("n") - F.col("piece") * capacity).alias("length"))
    pieces = stored(pieces, "pieces")
    counts = {r["length"]: r["n"] for r in pieces.where("length > 0").groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``capacity`` rows
    salts = max(1, math.ceil(max(counts.values(), default=0) / RANKED))
    salted = pieces.where("length > 0").withColumn("salt", F.pmod(F.xxhash64("id", "piece"), F.lit(salts)))
    per_salt = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = per_salt.select("length", "salt", (F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("before"))
    ranked = salted.withColumn("nth", F.row_number().over(Window.partitionBy("length", "salt").orderBy("id", "piece")))
    ranked = ranked.join(before, ["length", "salt"]).withColumn("rank", F.col("before") + F.col("nth") - 1)
    slots = F.broadcast(spark.createDataFrame(plan(counts, capacity)[0], PLAN))  # its size depends on the capacity only
    taken = ranked.alias("p").join(slots.alias("s"), F.expr("p.length = s.length and p.rank >= s.rank_lo and p.rank < s.rank_hi"))
    nth = F.col("rank") - F.col("rank_lo")
    placed = taken.select("id", "piece", "start", "p.length", F.expr("bin + (rank - rank_lo) div per_bin").alias("sequence"), (F.col("offset") + nth % F.col("per_bin") * F.col("p.length")).alias("offset"))
    none = pieces.where("length <= 0").select("id", "piece", "start", "length", F.lit(None).cast("long").alias("sequence"), F.lit(None).cast("long").alias("offset"))
    return placed.union(none).withColumnRenamed("id", id_col)
