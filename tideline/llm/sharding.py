"""Shards of equal row counts that keep linked documents together: balanced label propagation.

Documents with equal texts are linked. Every document starts in a shard chosen by its id. A round
of propagation looks at how a group's members are spread and moves members towards the shard where
most of them can be together, as far as that shard's quota allows; rounds end when nothing moves.
Members of one group in one shard are alike, so the propagated state is a table of (group, shard,
members) cells: joins and sums of cells, never of a group's rows. Documents without links come last
and fill every shard to its quota, which is the total divided by the shards, to one row.

Everything is DataFrame operations. Positions inside groups and shards come from two-level running
totals (buckets first, then rows of one bucket), so no window holds a whole group or shard, and a
group that holds a third of all rows spreads over many buckets; it is cut only where a quota ends.

Defined results: a null text has no bytes and no links; empty texts are linked like all equal
texts; repeated rows are rows of their own (ties among them are broken arbitrarily but fixed, in a
written table); an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tideline.session import materialize

SHARDS = 24
ROUNDS = 12
# Rounds end when no more than this share of the linked documents still moves.
MOVED_SHARE = 0.002
# Rows that one window partition holds on average.
BUCKET_ROWS = 20_000


def _buckets(n_rows: int) -> int:
    return max(1, -(-n_rows // BUCKET_ROWS))


def running_total(df: DataFrame, keys: list[str], bucket: Column, order: list[str], value: Column,
                  into: str) -> DataFrame:
    """Add the sum of ``value`` over the rows before each row, per ``keys``, ordered by bucket.

    The totals of buckets are summed first; a window over rows spans one bucket only.
    """
    rows = df.withColumn("bucket_", bucket).withColumn("value_", value)
    sums = rows.groupBy(*keys, "bucket_").agg(F.sum("value_").alias("sum_"))
    per_key = Window.partitionBy(*keys).orderBy("bucket_")
    before = sums.withColumn("before_", F.sum("sum_").over(per_key) - F.col("sum_")).drop("sum_")
    inside = Window.partitionBy(*keys, "bucket_").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    rows = rows.withColumn("upto_", F.sum("value_").over(inside))
    out = rows.join(before, [*keys, "bucket_"])
    total = F.col("before_") + F.col("upto_") - F.col("value_")
    return out.withColumn(into, total).drop("bucket_", "value_", "before_", "upto_")


def _quota(n_rows: int, shards: int) -> list[int]:
    return [n_rows // shards + (s < n_rows % shards) for s in range(shards)]


def _numbers(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("bigint") for v in values])


def _by_share(number: Column, shares: list[int]) -> Column:
    """The shard whose share of ``0 .. sum(shares) - 1`` holds ``number``."""
    out = F.lit(len(shares) - 1)
    for s in reversed(range(len(shares))):
        out = F.when(number < sum(shares[: s + 1]), F.lit(s)).otherwise(out)
    return out


def _large_size(quota: list[int]) -> int:
    return max(2, max(quota) // 4)


def _place_large(linked: DataFrame, quota: list[int]) -> tuple[DataFrame, list[int]]:
    """Cells of the groups of at least a quarter of a shard, and what is left of the quotas.

    There are at most four such groups per shard, so they are placed one by one, the largest
    first, into the emptiest shards; one that is larger than a shard is split over several.
    """
    large = linked.filter(F.col("whole") >= _large_size(quota)).orderBy(F.desc("whole"), "g").collect()
    room, cells = list(quota), []
    for group in large:
        left = group.whole
        while left:
            shard = max(range(len(room)), key=lambda s: (room[s], -s))
            n = min(left, room[shard])
            cells.append((bytes(group.g), shard, n))
            room[shard] -= n
            left -= n
    rows = F.array(*[
        F.struct(F.lit(g).alias("g"), F.lit(s).alias("shard"), F.lit(n).cast("bigint").alias("n"))
        for g, s, n in cells
    ])
    if not cells:
        rows = F.array().cast("array<struct<g:binary,shard:int,n:bigint>>")
    return linked.sparkSession.range(1).select(F.inline(rows)), room


def exchange(wanted: dict[tuple[int, int], int], room: list[int]) -> dict[tuple[int, int], int]:
    """How many of the wanted moves between shards can be made: swaps, then moves into free room.

    A move into a shard uses up its room and makes room where it came from.
    """
    made = {(s, t): min(n, wanted.get((t, s), 0)) for (s, t), n in wanted.items()}
    room = list(room)
    progress = True
    while progress:
        progress = False
        for (s, t), n in sorted(wanted.items(), key=lambda x: (-x[1], x[0])):
            more = min(n - made[s, t], room[t])
            if more > 0:
                made[s, t] += more
                room[t] -= more
                room[s] += more
                progress = True
    return made


def propagate(cells: DataFrame, quota: list[int], n_buckets: int, rounds: int = ROUNDS) -> DataFrame:
    """Move members between ``cells(g, shard, n)`` until groups are together, within ``quota``.

    What reaches the driver per round is one load per shard and one flow per pair of shards.
    """
    shards = len(quota)
    quota_of = F.element_at(_numbers(quota), F.col("shard") + 1)
    for number in range(rounds):
        load = {r.shard: r.n for r in cells.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
        room = [quota[s] - load.get(s, 0) for s in range(shards)]
        room_of = F.element_at(_numbers([max(r, 0) for r in room]), F.col("shard") + 1)
        # A shard that holds nothing but one group is settled; the rest of the group goes on.
        open_ = cells.filter(F.col("n") < quota_of)
        whole = open_.groupBy("g").agg(F.sum("n").alias("whole"))
        # How much of its group a shard can hold; the best one attracts the group.
        together = F.least(F.col("whole"), F.col("n") + room_of)
        # Ties fall another way each round, so members that found no room may wait or be joined.
        tie = F.xxhash64("g", "shard", F.lit(number)).alias("tie")
        rank = F.struct(together.alias("together"), "n", tie, "shard")
        target = open_.join(whole, "g").groupBy("g").agg(F.max(rank).alias("best")).select(
            "g", F.col("best.shard").alias("target")
        )
        moving = materialize(open_.join(target, "g").filter("shard <> target"))
        flows = moving.groupBy("shard", "target").agg(F.sum("n").alias("n")).collect()
        made = exchange({(r.shard, r.target): r.n for r in flows}, room)
        if sum(made.values()) <= MOVED_SHARE * sum(load.values()):
            break
        ordered = running_total(
            moving, ["shard", "target"], F.pmod(F.xxhash64("g"), F.lit(n_buckets)), ["g"], F.col("n"),
            "earlier",
        )
        limits = _numbers([made.get((s, t), 0) for s in range(shards) for t in range(shards)])
        limit = F.element_at(limits, F.col("shard") * shards + F.col("target") + 1)
        moved = F.least(F.col("n"), F.greatest(limit - F.col("earlier"), F.lit(0)))
        accepted = materialize(
            ordered.withColumn("moved", moved).filter("moved > 0").select("g", "shard", "target", "moved")
        )
        changes = cells.unionByName(
            accepted.select("g", "shard", (-F.col("moved")).alias("n"))
        ).unionByName(accepted.select("g", F.col("target").alias("shard"), F.col("moved").alias("n")))
        cells = materialize(changes.groupBy("g", "shard").agg(F.sum("n").alias("n")).filter("n > 0"))
    return cells


def _within(cells: DataFrame, quota: list[int], n_buckets: int) -> tuple[DataFrame, list[int]]:
    """Cut cells at their shard's quota and send the rest where there is room; rows still free."""
    load = {r.shard: r.n for r in cells.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    room = [q - load.get(s, 0) for s, q in enumerate(quota)]
    if min(room) >= 0:
        return cells, room
    placed = running_total(
        cells, ["shard"], F.pmod(F.xxhash64("g"), F.lit(n_buckets)), ["g"], F.col("n"), "earlier"
    )
    limit = F.element_at(_numbers(quota), F.col("shard") + 1)
    stays = F.least(F.col("n"), F.greatest(limit - F.col("earlier"), F.lit(0)))
    cut = materialize(placed.withColumn("stays", stays).select("g", "shard", "n", "stays"))
    over = cut.select("g", (F.col("n") - F.col("stays")).alias("n")).filter("n > 0")
    over = running_total(
        over.withColumn("all", F.lit(0)), ["all"], F.pmod(F.xxhash64("g"), F.lit(n_buckets)), ["g"],
        F.col("n"), "earlier",
    )
    parts = _spread(over.select("g", "n", "earlier"), [max(r, 0) for r in room])
    kept = cut.filter("stays > 0").select("g", "shard", F.col("stays").alias("n"))
    cells = materialize(kept.unionByName(parts).groupBy("g", "shard").agg(F.sum("n").alias("n")))
    return _within(cells, quota, n_buckets)


def _spread(rows: DataFrame, room: list[int]) -> DataFrame:
    """Lay rows of length ``n`` end to end over the rooms; one row per room that one touches."""
    ends = [sum(room[: i + 1]) for i in range(len(room))]
    starts = [e - r for e, r in zip(ends, room)]
    spans = F.array(*[
        F.struct(F.lit(s).cast("int").alias("shard"), F.lit(a).cast("bigint").alias("a"),
                 F.lit(b).cast("bigint").alias("b"))
        for s, (a, b) in enumerate(zip(starts, ends)) if b > a
    ])
    row_end = F.col("earlier") + F.col("n")
    touched = F.filter(spans, lambda x: (x["a"] < row_end) & (x["b"] > F.col("earlier")))
    part = F.least(F.col("x.b"), row_end) - F.greatest(F.col("x.a"), F.col("earlier"))
    return rows.withColumn("x", F.explode(touched)).select("g", "x.shard", part.alias("n"))


def shard_documents(docs: DataFrame, key: str = "doc_id", text: str = "text",
                    shards: int = SHARDS) -> DataFrame:
    """Per document: key, ``size``, ``text_crc32``, ``shard`` and ``slot`` (from 0 in its shard)."""
    body = F.col(text).cast("binary")
    rows = materialize(
        docs.select(
            F.col(key).alias("id"),
            (F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 8).alias("size"),
            F.crc32(F.coalesce(body, F.lit(b""))).alias("text_crc32"),
            F.unhex(F.md5(body)).alias("g"),
        ).withColumn("row", F.monotonically_increasing_id())
        # A document without text is linked with nothing: a group of its own.
        .withColumn("g", F.coalesce("g", F.unhex(F.md5(F.concat(F.lit("row "), "row").cast("binary")))))
    )
    n_rows = rows.count()
    n_buckets = _buckets(n_rows)
    quota = _quota(n_rows, shards)
    bucket = F.pmod(F.xxhash64("row"), F.lit(n_buckets))

    # Groups of at least two are linked; their members per bucket and per first shard.
    in_bucket = materialize(
        rows.groupBy("g", bucket.alias("bucket")).agg(F.count("*").alias("n"))
    )
    linked = materialize(in_bucket.groupBy("g").agg(F.sum("n").alias("whole")).filter("whole > 1"))
    in_bucket = materialize(in_bucket.join(linked.select("g"), "g"))
    large, rest_quota = _place_large(linked, quota)
    small = linked.filter(F.col("whole") < _large_size(quota)).select("g")
    ticket = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(max(1, sum(rest_quota))))
    cells = rows.select("g", _by_share(ticket, rest_quota).alias("shard")).join(small, "g")
    cells = materialize(cells.groupBy("g", "shard").agg(F.count("*").alias("n")))
    cells, room = _within(propagate(cells, rest_quota, n_buckets), rest_quota, n_buckets)
    cells = cells.select("g", "shard", "n").unionByName(large)

    # A group's rows take its cells in order of the shards: by bucket, then inside the bucket.
    taken = cells.groupBy("g").agg(F.array_sort(F.collect_list(F.struct("shard", "n"))).alias("cells"))
    ahead = Window.partitionBy("g").orderBy("bucket")
    heads = in_bucket.withColumn("ahead", F.sum("n").over(ahead) - F.col("n")).join(taken, "g").select(
        "g", "bucket", "ahead", "cells"
    )
    marked = materialize(
        rows.withColumn("bucket", bucket).join(heads, ["g", "bucket"], "left")
        .withColumn("linked", F.col("cells").isNotNull())
        .select("row", "id", "size", "text_crc32", "g", "bucket", "linked", "ahead", "cells")
    )
    inside = Window.partitionBy("g", "bucket").orderBy("id", "row")
    position = F.col("ahead") + F.row_number().over(inside) - 1
    shard = F.aggregate(
        "cells",
        F.struct(F.lit(0).cast("bigint").alias("end"), F.lit(-1).alias("shard")),
        lambda acc, c: F.struct(
            (acc["end"] + c["n"]).alias("end"),
            F.when((acc["shard"] < 0) & (F.col("position") < acc["end"] + c["n"]), c["shard"])
            .otherwise(acc["shard"]).alias("shard"),
        ),
    )["shard"]
    together = marked.filter("linked").withColumn("position", position).withColumn("shard", shard)
    # Documents without links fill what is left of every quota.
    free = running_total(
        marked.filter("not linked").withColumn("all", F.lit(0)), ["all"], F.col("bucket"),
        ["id", "row"], F.lit(1).cast("bigint"), "position",
    )
    filled = _by_share(F.col("position"), room)
    columns = ["row", "id", "size", "text_crc32", "bucket", "shard"]
    placed = materialize(
        together.select(columns).unionByName(free.withColumn("shard", filled).select(columns))
    )
    slots = running_total(
        placed, ["shard"], F.col("bucket"), ["row"], F.lit(1).cast("bigint"), "slot"
    )
    return slots.select(
        F.col("id").alias(key), "size", "text_crc32", F.col("shard").cast("int").alias("shard"), "slot"
    )
