"""Minimum-cost-flow resharding: from the sizes of old shards and new capacities to new shard files.

Old shards are sources, new shards sinks, staying costs nothing, moving costs a unit a byte (through
one hub, so the network has few arcs). The flow says how many bytes go from which shard to which: at
most one block for each old and new shard together. A block becomes a run of an old shard's rows, in
an order that spreads sizes evenly, cut at the row nearest to the block's end. Rows are whole, so
shards miss their capacities by part of a row; further flows between the shards as they then are
move the smallest rows first, until no shard is off by more than the smallest row or nothing gets
better. All this reads (shard, size, position) of the rows only. Then the files of the shards that
lose or get rows are written, each text moving once; the other shards' rows stay where they are.

A NULL text has no bytes. Equal texts and rows that repeat are dealt like others: a row is known by
its place in its file. Columns named ``shard`` and ``slot`` are replaced. An empty table gives no
rows and no blocks.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from subscope.llm import common

#: Bytes that a row takes beside its text, and bytes of a shard's file.
ROW_BYTES, FILE_BYTES = 16, 64 << 20
#: Old and new shards at most; their sizes, blocks and cuts are handled by the driver.
MOST_SHARDS = 4096
#: Flows at most; each leaves a small part of the deviation of the one before.
ROUNDS = 6


class Block(NamedTuple):
    """``size`` bytes of shard ``old`` that go to shard ``new``."""

    old: int
    new: int
    size: int


class Layout(NamedTuple):
    """``rows`` of the documents with their shard and slot; the folder of the written shards (one
    sub-folder each), the shards whose files were written, and the bytes that changed their shard."""

    rows: DataFrame
    path: str
    written: list[int]
    moved: int


def flow(arcs: list[tuple], source, sink) -> list[int]:
    """Flow on each arc (tail, head, capacity, cost >= 0) of a maximum flow of least cost, by
    shortest augmenting paths with node potentials."""
    graph, ends = defaultdict(list), []
    for k, (tail, head, capacity, cost) in enumerate(arcs):
        graph[tail].append(2 * k)
        graph[head].append(2 * k + 1)
        ends += [[head, capacity, cost], [tail, 0, -cost]]
    potential = defaultdict(int)
    while True:
        far, via, heap, count = {source: 0}, {}, [(0, 0, source)], 0
        done = set()
        while heap:
            d, _, node = heapq.heappop(heap)
            if node in done:
                continue
            done.add(node)
            for e in graph[node]:
                head, left, cost = ends[e]
                step = d + cost + potential[node] - potential[head]
                if left > 0 and head not in done and step < far.get(head, step + 1):
                    far[head], via[head] = step, e
                    count += 1
                    heapq.heappush(heap, (step, count, head))
        if sink not in far:
            return [ends[2 * k + 1][1] for k in range(len(arcs))]
        furthest = max(far.values())
        for node in graph:
            potential[node] += far.get(node, furthest)
        path, node = [], sink
        while node != source:
            path.append(via[node])
            node = ends[via[node] ^ 1][0]
        amount = min(ends[e][1] for e in path)
        for e in path:
            ends[e][1] -= amount
            ends[e ^ 1][1] += amount


def blocks(old: dict[int, int], capacities: dict[int, tuple[int, int]]) -> list[Block]:
    """The blocks that bring the new shards to sizes within their (least, most) bytes and move the
    fewest bytes; what stays is a block from a shard to itself."""
    total = sum(old.values())
    if not sum(low for low, _ in capacities.values()) <= total <= sum(high for _, high in capacities.values()):
        raise ValueError("the capacities do not hold the rows' bytes")
    arcs = [("all", ("old", i), size, 0) for i, size in sorted(old.items()) if size]
    arcs += [(("old", i), ("new", i), size, 0) for i, size in sorted(old.items()) if size and i in capacities]
    arcs += [(("old", i), "hub", size, 1) for i, size in sorted(old.items()) if size]
    arcs += [("hub", ("new", j), high, 0) for j, (_, high) in sorted(capacities.items())]
    # what a shard must get comes first: the rest costs more than any way around it
    arcs += [(("new", j), "end", low, 0) for j, (low, _) in sorted(capacities.items())]
    arcs += [(("new", j), "end", high - low, 4) for j, (low, high) in sorted(capacities.items()) if high > low]
    stays, out, into = [], [], []
    for (tail, head, _, _), size in zip(arcs, flow(arcs, "all", "end"), strict=True):
        if size and head == "hub":
            out.append([tail[1], size])
        elif size and tail == "hub":
            into.append([head[1], size])
        elif size and head != "end" and tail != "all":
            stays.append(Block(tail[1], head[1], size))
    # blocks through the hub: both lists are used up in order
    moves, k = [], 0
    for i, left in out:
        while left:
            part = min(left, into[k][1])
            moves.append(Block(i, into[k][0], part))
            left -= part
            into[k][1] -= part
            k += into[k][1] == 0
    return stays + moves


def _placed(docs: DataFrame) -> tuple[DataFrame, Column]:
    """The documents and a hash of each row's place: its file's name and its number there."""
    for again in (False, True):
        docs = common.saved(docs, "documents") if again else docs
        try:
            where = docs.metadataColumn("_metadata")
            place = F.xxhash64(where["file_name"], where["row_index"], docs["doc_id"])
            docs.select(place).schema  # noqa: B018 - resolves the column
            return docs, place
        except AnalysisException:
            if again:
                raise
    raise AssertionError


def _sizes(rows: DataFrame) -> tuple[dict[int, int], dict[int, int]]:
    """Bytes and largest row of each shard."""
    found = rows.groupBy("shard").agg(F.sum("size").alias("size"), F.max("size").alias("largest")).limit(MOST_SHARDS + 1).collect()
    if len(found) > MOST_SHARDS:
        raise ValueError(f"more than {MOST_SHARDS} shards")
    return {r["shard"]: r["size"] for r in found}, {r["shard"]: r["largest"] for r in found}


def _cuts(rows: DataFrame, ends: list[tuple[int, int]], rank: str, bits: int) -> dict[tuple[int, int], tuple[int, int]]:
    """For each (shard, bytes) the first (rank, place), in that order, of the rows whose middle lies
    at or beyond so many bytes of the shard's rows.

    Sums by rank, then by leading bits of the place, lead to a few rows, and only these are ordered.
    """
    spark = rows.sparkSession
    rows = rows.select("shard", F.expr(rank).cast("long").alias("rank"), "place", "size", F.shiftright("place", 64 - bits).cast("long").alias("lead"))
    here = [(shard, end, 0) for shard, end in ends]
    names: list[str] = []
    for name in (["rank", "lead"] if rank != "0" else ["lead"]):
        keys = ["shard", *names]
        cells = spark.createDataFrame(here, "shard int, end long, before long" + "".join(f", {n} long" for n in names))
        if names:  # only the cells that an end lies in; a row for each end at most
            rows = rows.join(F.broadcast(cells.select(keys).distinct()), keys, "left_semi")
        sums = rows.groupBy(*keys, name).agg(F.sum("size").alias("size"))
        upto = sums.withColumn("upto", F.sum("size").over(Window.partitionBy(*keys).orderBy(name)))
        met = upto.join(F.broadcast(cells), keys).where((F.col("before") + F.col("upto") >= F.col("end")) & (F.col("before") + F.col("upto") - F.col("size") < F.col("end")))
        names.append(name)
        here = [(r["shard"], r["end"], r["before"] + r["upto"] - r["size"], *(r[n] for n in names)) for r in met.collect()]
    cells = spark.createDataFrame(here, "shard int, end long, before long" + "".join(f", {n} long" for n in names))
    keys = ["shard", *names]
    rows = rows.join(F.broadcast(cells.select(keys).distinct()), keys, "left_semi")
    upto = rows.withColumn("upto", F.sum("size").over(Window.partitionBy(*keys).orderBy("place").rowsBetween(Window.unboundedPreceding, 0)))
    beyond = 2 * (F.col("before") + F.col("upto")) - F.col("size") >= 2 * F.col("end")
    met = upto.join(F.broadcast(cells), keys).groupBy("shard", "end").agg(F.min("rank").alias("rank"), F.min("lead").alias("lead"), F.min(F.when(beyond, F.col("place"))).alias("place"))
    out = {}
    for r in met.collect():
        after = (r["lead"] + 1) << (64 - bits)  # none: the cut is where the next cell begins
        later = (r["rank"], after) if after < 1 << 63 else (r["rank"] + 1, -(1 << 63))
        out[r["shard"], r["end"]] = later if r["place"] is None else (r["rank"], r["place"])
    return out


def _dealt(rows: DataFrame, cuts: list[tuple[int, int, int, int, int]], rank: str) -> DataFrame:
    """``rows`` with their new shard: that of the last cut (shard, rank, place, number, new) not after them."""
    if not cuts:
        return rows
    spark = rows.sparkSession
    table = spark.createDataFrame(cuts, "_old int, rank long, place long, number int, new int")
    cut = F.array_sort(F.collect_list(F.struct("rank", "place", "number", "new"))).alias("_cuts")
    table = table.groupBy("_old").agg(cut)  # a row for each shard
    own = F.struct(F.expr(rank).cast("long").alias("rank"), F.col("place").alias("place"))
    before = F.filter("_cuts", lambda x: F.struct(x["rank"].alias("rank"), x["place"].alias("place")) <= own)
    joined = rows.join(F.broadcast(table), rows["shard"] == table["_old"], "left")
    return joined.withColumn("shard", F.coalesce(F.try_element_at(before, F.lit(-1))["new"], F.col("shard"))).drop("_old", "_cuts")


def equal(total: int, shards: int, tolerance: float = 0.0, largest: dict[int, int] | None = None) -> dict[int, tuple[int, int]]:
    """Capacities of shards 0 to ``shards - 1``: equal to a byte, or within ``tolerance`` of that. A
    shard whose ``largest`` row is above its share holds just that row; the others share the rest."""
    alone: dict[int, int] = {}
    while True:
        rest, others = total - sum(alone.values()), [j for j in range(shards) if j not in alone]
        over = {j: largest[j] for j in others if (largest or {}).get(j, 0) * len(others) > rest} if len(others) > 1 else {}
        if not over:
            break
        # the largest first: it makes the others' share smaller
        top = max(over, key=over.get)
        alone[top] = over[top]
    each = alone | {j: rest // len(others) + (k < rest % len(others)) for k, j in enumerate(others)}
    return {j: (int(each[j] * (1 - tolerance)), each[j] + int(each[j] * tolerance)) for j in range(shards)}


def solved(rows: DataFrame, shards: int, tolerance: float = 0.0) -> list[tuple[list, str]]:
    """The rounds (cuts, rank) that deal ``rows`` (shard, size, place) to shards of equal bytes."""
    sizes, largest = _sizes(rows)
    if not sizes:
        return []
    total = sum(sizes.values())
    count, least = rows.agg(F.count("*"), F.min("size")).first()
    # about 1,000 rows of each old shard share their leading bits
    bits = min(24, max(4, (count // (1000 * len(sizes))).bit_length()))
    rounds: list[tuple[list, str]] = []
    best, dealt = None, rows
    while len(rounds) < ROUNDS:
        first = not rounds
        rank = "0" if first else "size"
        capacities = equal(total, shards, tolerance, largest)
        own, order = defaultdict(list), []
        for block in blocks(sizes, capacities):
            own[block.old].append(block)
        for shard, mine in own.items():
            # at first what stays comes first; later the smallest rows go
            mine.sort(key=lambda b, shard=shard, first=first: (b.new == shard) != first)
            done = 0
            for block in mine:
                order.append((shard, done, block.new))
                done += block.size
        ends = [(shard, at) for shard, at, _ in order if at]
        found = _cuts(dealt, ends, rank, bits) if ends else {}
        lowest = (-1, -(1 << 63))
        cuts = [(shard, *(found[shard, at] if at else lowest), k, new) for k, (shard, at, new) in enumerate(order) if len(own[shard]) > 1 or new != shard]
        after = _dealt(dealt, cuts, rank)
        have, largest = _sizes(after)
        off = [max(low - have.get(j, 0), have.get(j, 0) - high, 0) for j, (low, high) in equal(total, shards, tolerance, largest).items()]
        if best is not None and sum(x * x for x in off) >= best:
            break
        rounds.append((cuts, rank))
        best, dealt, sizes = sum(x * x for x in off), after, have
        if max(off) <= least:
            break
    return rounds


def reshard(docs: DataFrame, old: Column, shards: int, tolerance: float = 0.0, text: str = "text") -> Layout:
    """The documents in ``shards`` files of near equal bytes, from their shards ``old`` (integers,
    NULL counts as 0).

    A shard's size may be off the mean by the share ``tolerance``; then fewer bytes move, and shards
    that need not change are not written. ``slot`` numbers a shard's rows from 0.
    """
    spark = docs.sparkSession
    if not 1 <= shards <= MOST_SHARDS:
        raise ValueError(f"1 to {MOST_SHARDS} shards")
    own = [c for c in docs.columns if c not in ("shard", "slot")]
    docs, place = _placed(docs.select("*", F.coalesce(old.cast("int"), F.lit(0)).alias("_old_shard")))
    size = F.coalesce(F.octet_length(F.col(text).cast("string")), F.lit(0)).cast("long") + ROW_BYTES
    whole = docs.select(F.struct(*own).alias("doc"), F.col("_old_shard").alias("shard"), size.alias("size"), place.alias("place"))
    narrow = common.saved(whole.select("shard", "size", "place"), "sizes")
    total = narrow.agg(F.sum("size")).first()[0] or 0
    rounds = solved(narrow, shards, tolerance)

    def dealt(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("_from", F.col("shard"))
        for cuts, rank in rounds:
            rows = _dealt(rows, cuts, rank)
        # a second hash orders a shard's rows, and its leading bits name the file
        rows = rows.withColumn("_by", F.shiftrightunsigned(F.xxhash64("place", F.lit(1)), 24))
        files = F.ceil(F.lit(total / shards / FILE_BYTES)).cast("long")
        return rows.withColumn("_file", F.shiftright(F.col("_by") * F.greatest(files, F.lit(1)), 40).cast("int"))

    moves = dealt(narrow).groupBy("_from", "shard").agg(F.sum("size").alias("size")).where("_from <> shard").collect() if rounds else []
    written = sorted({r["_from"] for r in moves if r["_from"] < shards} | {r["shard"] for r in moves})
    counts = dealt(narrow).groupBy("shard", "_file").agg(F.count("*").alias("rows"))
    running = Window.partitionBy("shard").orderBy("_file")
    counts = common.saved(counts.select("shard", "_file", (F.sum("rows").over(running) - F.col("rows")).alias("_before")), "files")
    within = F.row_number().over(Window.partitionBy("shard", "_file").orderBy("_by", "place")) - 1

    def slotted(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("_slot", within).join(counts, ["shard", "_file"])
        return rows.select("doc.*", "shard", (F.col("_before") + F.col("_slot")).cast("long").alias("slot"))

    # a shard's number each, and no more than MOST_SHARDS
    touched = F.broadcast(spark.createDataFrame([(j,) for j in written], "shard int"))
    everything = dealt(whole)
    path = common.work_dir(spark, "shards")
    new = slotted(everything.join(touched, "shard", "left_semi"))
    new.write.option("compression", "zstd").partitionBy("shard").parquet(path)
    rows = spark.read.schema(new.schema).parquet(path).select(*new.columns)
    if len(written) < shards:
        rows = rows.unionByName(slotted(everything.join(touched, "shard", "left_anti")))
    return Layout(rows, path, written, sum(r["size"] for r in moves))
