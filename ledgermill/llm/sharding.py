"""Sharding by balanced label propagation, in native expressions only.

Documents of equal text are linked with each other. Each group of copies starts spread evenly over all shards. In
each round the copies in a shard see, through a join, how many of their neighbours every shard holds, and move to
the shard with most of them. What wants to go from shard to shard is weighed against what the shards have room
for (those that leave make room, too), and within each quota the moves with the greatest gain come first, by prefix
sums; the copies at the limit move in part. A move only goes where the greater pile is, so rounds end; what
does not fit a shard stays in as few others as have room. Documents without links have no vote: they fill the shards
to the same level, the large ones first.

Copies are alike, so a group is one row with its copies per shard, whatever share of all rows it has, and no pair is ever
made. Prefix sums go over ranges of hashes, about as many as a range has rows, so no task holds a group, a shard or all rows.
The driver sees sums per shard and per pair of shards.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm.keys import NO_ID
from ledgermill.session import settle

SHARDS = 8
MAX_ROUNDS = 12
LARGE = 64  # a document above 1/64 of a shard is dealt by itself: 64 x shards of them at most
REPEATS_AT_ONCE = 1 << 14
GROUP = ["t", "size", "crc"]


def _range(key: Column, bits: int) -> Column:
    return F.shiftrightunsigned(key, 64 - bits) if bits else F.lit(0).cast("long")


def with_sum_before(df: DataFrame, groups: list[str], key: str, value: str, ties: list[str], bits: int) -> DataFrame:
    """Add ``before``: the sum of ``value`` over the rows of the group with a smaller hash ``key`` (then ``ties``).

    Sums of ``2 ** bits`` ranges of hashes are accumulated first, then the rows inside each range.
    """
    placed = df.withColumn("range_", _range(F.col(key), bits))
    by = [*groups, "range_"]
    sums = placed.groupBy(*by).agg(F.sum(value).alias("sum_"))
    earlier = Window.partitionBy(*groups).orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("base_", F.coalesce(F.sum("sum_").over(earlier), F.lit(0))).drop("sum_")
    inside = Window.partitionBy(*by).orderBy(key, *ties).rowsBetween(Window.unboundedPreceding, -1)
    joined = placed.join(sums, by).withColumn("before", F.col("base_") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return joined.drop("range_", "base_")


def level(loads: list[int], rest: int) -> list[float]:
    """What each shard gets of ``rest`` so that the least loaded end at one level."""
    order = sorted(loads)
    for n in range(1, len(order) + 1):
        height = (sum(order[:n]) + rest) / n
        if n == len(order) or height <= order[n]:
            return [max(0.0, height - x) for x in loads]
    return []


def quotas(want: dict[tuple[int, int], int], room: list[float]) -> dict[tuple[int, int], float]:
    """The greatest shares of the wanted flows, found by scaling down, with which no shard takes more than its room and what leaves it."""
    flow = {k: float(v) for k, v in want.items()}
    for _ in range(200):
        settled = True
        for j in range(len(room)):
            into = sum(v for (_, b), v in flow.items() if b == j)
            away = sum(v for (a, _), v in flow.items() if a == j)
            may = max(0.0, room[j] + away)
            if into > may * (1 + 1e-9):
                settled = False
                flow = {k: v * may / into if k[1] == j else v for k, v in flow.items()}
        if settled:
            break
    else:  # what is still too much is cut for good, without the room that leaving makes
        for j in range(len(room)):
            into = sum(v for (_, b), v in flow.items() if b == j)
            if into > max(0.0, room[j]):
                flow = {k: v * max(0.0, room[j]) / into if k[1] == j else v for k, v in flow.items()}
    return flow


def _numbers(df: DataFrame, columns: list[Column]) -> list[int]:
    return [x or 0 for x in df.agg(*columns).first()]


def _array(values: list) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _moves(cut: DataFrame, open_shards: list[int], shards: int, small: float) -> DataFrame:
    """``GROUP, i, j, k, gain, bytes``: the copies in shard i of each group that want to go to shard j.

    They go to the open shard with most of the group; small piles leave a full shard for a smaller pile, too, as that one can't come.
    """

    def rank(s: Column | int) -> Column:
        return F.struct(F.element_at("c", F.lit(s) + 1 if isinstance(s, int) else s + 1).alias("c"), (shards - F.pmod(s - F.col("h"), F.lit(shards))).alias("tie"), (F.lit(s) if isinstance(s, int) else s).cast("int").alias("s"))

    best = cut.withColumn("best", F.array_max(F.array(*[rank(s) for s in open_shards])))
    ranks = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), rank)
    is_open = _array([s in open_shards for s in range(shards)])
    shut = lambda x: ~F.element_at(is_open, x["s"] + 1) & ((x["c"] <= F.col("best.c")) | (x["c"] * F.col("size") <= small))
    moving = F.filter(ranks, lambda x: (x["c"] > 0) & (F.col("best.c") > 0) & ((x < F.col("best")) | shut(x)))
    rows = best.select(*GROUP, "best", F.inline(moving)).withColumnsRenamed({"c": "k", "s": "i"})
    return rows.select(
        *GROUP, "i", F.col("best.s").alias("j"), "k", F.col("best.c").alias("gain"), (F.col("k") * F.col("size")).alias("bytes")
    )


def _moved(moves: DataFrame, quota: dict[tuple[int, int], float], want: dict[tuple[int, int], int], bits: int) -> DataFrame:
    """``moves`` with ``moved``: the copies that the quotas let go, greatest gain first."""
    free = {k for k, v in quota.items() if v >= want[k] * (1 - 1e-9)}
    limit = F.create_map(*[F.lit(x) for (i, j), v in sorted(quota.items()) for x in (f"{i}-{j}", int(v))])
    rows = moves.withColumn("limit", limit[F.concat_ws("-", "i", "j")])
    easy = reduce(lambda a, b: a | b, [(F.col("i") == i) & (F.col("j") == j) for i, j in sorted(free)], F.lit(False))
    done = rows.where(easy).withColumn("moved", F.col("k"))
    # ten bits of gain (each power of two is a class), then hash
    rank = 63 - F.floor(F.log2(F.col("gain") + 1)).cast("long")
    key = F.shiftleft(rank, 57).bitwiseOR(F.shiftrightunsigned(F.xxhash64(F.lit(4), *GROUP), 7))
    tight = with_sum_before(rows.where(~easy).withColumn("key", key), ["i", "j"], "key", "bytes", GROUP, min(20, bits + 7))
    fits = F.floor((F.col("limit") - F.col("before")) / F.col("size"))
    tight = tight.withColumn("moved", F.greatest(F.lit(0), F.least(F.col("k"), fits)).cast("long"))
    return done.select(*GROUP, "i", "j", "moved").union(tight.select(*GROUP, "i", "j", "moved")).where("moved > 0")


def propagated(groups: DataFrame, shards: int, target: float, name: str = "labels") -> DataFrame:
    """``GROUP, c`` with the copies of each group per shard, from ``GROUP, n``; no shard gets more than ``target`` bytes."""
    start = F.pmod(F.xxhash64(F.lit(2), *GROUP), F.lit(shards)).cast("int")
    spread = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda s: F.floor(F.col("n") / shards) + (F.pmod(s - F.col("h"), F.lit(shards)) < F.col("n") % shards).cast("long"),
    )
    cut = settle(groups.withColumn("h", start).withColumn("c", spread), name)
    bits = math.ceil(math.log2(max(cut.count(), 1)) / 2)
    load = lambda s: F.sum(F.col("c")[s] * F.col("size"))
    fixed, parts, open_shards, full = [0] * shards, [], list(range(shards)), set()
    for _ in range(MAX_ROUNDS):
        loads = _numbers(cut, [load(s) for s in range(shards)])
        room = [target - a - b for a, b in zip(loads, fixed)]
        if not open_shards:
            break
        moves = settle(_moves(cut, open_shards, shards, target / LARGE), name)
        want = {(r.i, r.j): r.b for r in moves.groupBy("i", "j").agg(F.sum("bytes").alias("b")).collect()}
        if not want:
            break
        flow = quotas(want, room)
        moved = _moved(moves, flow, want, bits)
        per_shard = [F.coalesce(F.sum(F.when(F.col("i") == s, F.col("moved"))), F.lit(0)).alias(f"m{s}") for s in range(shards)]
        gone = moved.groupBy(*GROUP).agg(F.first("j").alias("j"), F.sum("moved").alias("all"), *per_shard)
        left = F.array(*[F.col("c")[s] - F.coalesce(F.col(f"m{s}"), F.lit(0)) + F.when(F.col("j") == s, F.col("all")).otherwise(0) for s in range(shards)])
        now = cut.join(gone, GROUP, "left").select(*GROUP, "n", "h", left.alias("c"), F.col("j").isNotNull().alias("went"))
        now = settle(now, name)
        whole = F.array_max("c") == F.col("n")
        parts.append(now.where(whole).select(*GROUP, "c"))
        fixed = [a + b for a, b in zip(fixed, _numbers(now.where(whole), [load(s) for s in range(shards)]))]
        went = now.where("went").limit(1).count()
        cut = now.where(~whole).drop("went")
        loads = _numbers(cut, [load(s) for s in range(shards)])
        room = [target - a - b for a, b in zip(loads, fixed)]
        full |= {j for (i, j), v in flow.items() if v < want[i, j] * (1 - 1e-9)}
        before, open_shards = open_shards, [s for s in range(shards) if s not in full or room[s] > target / LARGE]
        if not went and open_shards == before:
            break
    return reduce(DataFrame.union, [*parts, cut.select(*GROUP, "c")])


def _dealt_large(large: DataFrame, loads: list[int], shards: int) -> DataFrame:
    """``GROUP, shard``: each of the few large documents, greatest first, to the shard that is least loaded then."""
    one = F.struct(F.col("size"), F.col("t"), F.col("crc"))
    listed = large.agg(F.sort_array(F.collect_list(one), asc=False).alias("l"))
    start = F.struct(_array([int(x) for x in loads]).cast("array<bigint>").alias("loads"), F.array().cast("array<int>").alias("to"))

    def deal(state: Column, doc: Column) -> Column:
        s = F.array_position(state["loads"], F.array_min(state["loads"])).cast("int") - 1
        loads = F.transform(state["loads"], lambda x, i: x + F.when(i == s, doc["size"]).otherwise(0))
        return F.struct(loads.alias("loads"), F.concat(state["to"], F.array(s)).alias("to"))

    dealt = listed.select("l", F.aggregate("l", start, deal, lambda state: state["to"]).alias("to"))
    rows = dealt.select(F.inline(F.zip_with("l", "to", lambda d, s: F.struct(d["t"].alias("t"), d["size"].alias("size"), d["crc"].alias("crc"), s.alias("shard")))))
    return rows.select(*GROUP, "shard")


def placed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """``k_id, t, size, crc, m, shard, slot``: m repeated rows in a shard, from the given slot on."""
    rows = docs.select(
        F.coalesce(F.col(id_col), F.lit(NO_ID)).alias("k_id"),
        F.xxhash64(text_col).alias("t"),
        (F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col(text_col)), F.lit(0)).alias("crc"),
    )
    units = settle(rows.groupBy("k_id", *GROUP).agg(F.count("*").alias("m")), "units")
    count, total = _numbers(units, [F.sum("m"), F.sum(F.col("m") * F.col("size"))])
    bits = math.ceil(math.log2(max(count, 1)) / 2)
    target = total / shards
    units = units.withColumn("key", F.xxhash64(F.lit(1), "k_id", *GROUP))
    groups = settle(units.groupBy(*GROUP).agg(F.sum("m").alias("n")), "groups")

    # where few documents are left to even out, a shard may take a little more than its share
    free = _numbers(groups.where("n = 1"), [F.sum("size")])[0]
    quota = target + max(0.0, target / LARGE - free / shards)
    linked = settle(propagated(groups.where("n > 1"), shards, quota), "labels")
    loads = _numbers(linked, [F.sum(F.col("c")[s] * F.col("size")) for s in range(shards)])
    alone = groups.where("n = 1").drop("n")
    large = settle(_dealt_large(alone.where(F.col("size") > target / LARGE), loads, shards), "large")
    more = {r.shard: r.b for r in large.groupBy("shard").agg(F.sum("size").alias("b")).collect()}
    loads = [x + more.get(s, 0) for s, x in enumerate(loads)]
    share = level(loads, total - sum(loads))
    until = [sum(share[: s + 1]) for s in range(shards - 1)]
    small = alone.where(F.col("size") <= target / LARGE).withColumn("one", F.lit(0)).withColumn("key", F.xxhash64(F.lit(5), *GROUP))
    small = with_sum_before(small, ["one"], "key", "size", GROUP, bits)
    middle = F.col("before") + F.col("size") / 2
    last = max(s for s, x in enumerate(share) if x > 0 or s == 0)
    shard = F.least(F.size(F.filter(_array(until), lambda x: x <= middle)), F.lit(last))
    single = large.union(small.select(*GROUP, shard.alias("shard")))
    own = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: (s == F.col("shard")).cast("long"))
    layout = linked.select(*GROUP, "c").union(single.select(*GROUP, own.alias("c")))

    # the places of a group's copies in its shards, and of each row among the copies
    ranges = units.withColumn("range_", _range(F.col("key"), bits))
    sums = ranges.groupBy(*GROUP, "range_").agg(F.sum("m").alias("sum_"))
    earlier = Window.partitionBy(*GROUP).orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("base_", F.coalesce(F.sum("sum_").over(earlier), F.lit(0))).drop("sum_").join(layout, GROUP)
    inside = Window.partitionBy(*GROUP, "range_").orderBy("key", "k_id").rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranges.join(sums, [*GROUP, "range_"]).withColumn("rank", F.col("base_") + F.coalesce(F.sum("m").over(inside), F.lit(0)))

    def piece(s: Column) -> Column:
        first = F.aggregate(F.slice("c", 1, s), F.lit(0).cast("long"), lambda a, x: a + x)
        last_ = first + F.element_at("c", s + 1)
        part = F.least(F.col("rank") + F.col("m"), last_) - F.greatest(F.col("rank"), first)
        return F.struct(s.cast("int").alias("shard"), part.alias("m"))

    pieces = F.filter(F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), piece), lambda x: x["m"] > 0)
    found = ranked.select("k_id", *GROUP, "key", F.inline(pieces))
    found = settle(found, "pieces")
    return with_sum_before(found, ["shard"], "key", "m", ["k_id", *GROUP], bits).withColumnRenamed("before", "slot").drop("key")


def sharded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row; the law is near equal bytes.

    Rows of equal text are in as few shards as hold them. Slots count the rows of a shard from 0, in an order that is random but the
    same in every run. A size is the text's UTF-8 bytes plus 1, so NULL and empty texts have size 1 and checksum 0; NULL texts
    are equal to each other. A text larger than its share of all bytes has a shard for itself, as near as that goes. Repeated
    rows are copies like others, with a slot each; NULL ids stay NULL; an empty table gives no row.
    ``grown_shard`` is NULL: a further shard would take documents from all. Only the two named columns are read.
    """
    found = placed(docs, id_col, text_col, shards)
    blocks = F.sequence(F.lit(0).cast("long"), F.floor((F.col("m") - 1) / REPEATS_AT_ONCE))
    many = found.where(F.col("m") > REPEATS_AT_ONCE).withColumn("block", F.explode(blocks)).repartition("shard", "slot", "block")
    rows = found.where(F.col("m") <= REPEATS_AT_ONCE).withColumn("block", F.lit(0).cast("long")).unionByName(many)
    first = F.col("block") * REPEATS_AT_ONCE
    here = F.sequence(first, F.least(first + REPEATS_AT_ONCE, F.col("m")) - 1)
    return rows.withColumn("at", F.explode(here)).select(
        F.when(F.col("k_id") != NO_ID, F.col("k_id")).alias("doc_id"),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("slot") + F.col("at")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
