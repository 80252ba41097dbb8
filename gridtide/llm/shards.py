"""Sharding by balanced label propagation: linked documents move to their neighbours' shards under capacity quotas.

Everything is DataFrame code over one narrow row per document; texts are read once and never shuffled. Documents are
linked through groups (equal texts). Each round sums up every group's documents by shard, proposes the shard where most
of the group is, and lets through as many moves between every two shards as their free capacity allows. At the end the
surplus of overfull shards, unlinked documents first, fills the others, so that sizes differ by one row at most.
A group that is larger than a shard fills whole shards, its last rows a part of one more; the others move round it.

Only tables of shards x shards come to the driver. Groups are summed up before they are shuffled; joins on a group have
one row per group on one side, so a group with a third of all rows can be split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gridtide.session import stored

SHARDS, ROUNDS, SLACK = 8, 12, 0.1  # rounds at most; it ends when no document wants to move


def _quotas(moves: list[list[int]], loads: list[int], capacity: float) -> list[list[float]]:
    """The share of the wanted moves from shard i to shard j that may go, so that no shard ends above its capacity."""
    n = len(loads)
    share = [[1.0] * n for _ in range(n)]
    for _ in range(200):
        fits = True
        for j in range(n):
            came = sum(share[i][j] * moves[i][j] for i in range(n))
            went = sum(share[j][i] * moves[j][i] for i in range(n))
            free = max(0.0, capacity - loads[j] + went)
            if came > free + 0.5:
                fits = False
                for i in range(n):
                    share[i][j] *= free / came
        if fits:
            break
    return share


def _goals(total: int, shards: int) -> list[int]:
    """The rows that each shard ends with."""
    return [total // shards + (j < total % shards) for j in range(shards)]


def _unit(*parts: Column) -> Column:
    """A number in [0, 1) from a hash."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 20)) / F.lit(float(1 << 20))


def _pieces(members: list[int], goals: list[int]) -> tuple[list[list[tuple[int, int]]], list[int]]:
    """For groups that no shard can hold: `(shard, rows)` of each piece, on as few shards as possible, and the room left in every shard."""
    room, pieces = list(goals), []
    for m in members:
        mine = []
        for j, goal in enumerate(goals):  # whole shards first
            if room[j] == goal and 0 < goal <= m:
                mine.append((j, goal))
                room[j], m = 0, m - goal
        pieces.append((mine, m))
    for mine, left in sorted(pieces, key=lambda p: -p[1]):
        while left:
            fits = [j for j in range(len(room)) if room[j] >= left]
            j = min(fits, key=room.__getitem__) if fits else max(range(len(room)), key=room.__getitem__)
            n = min(left, room[j])
            mine.append((j, n))
            room[j], left = room[j] - n, left - n
    return [mine for mine, _ in pieces], room


def _upto(values: list[int]) -> Column:
    return F.array(*[F.lit(sum(values[: j + 1])).cast("long") for j in range(len(values))])


def _place_large(state: DataFrame, large: list, goals: list[int]) -> tuple[DataFrame, DataFrame, list[int]]:
    """The rows of groups larger than a shard with their shards, all other rows dealt to the room that is left, and the rows placed in each shard."""
    pieces, room = _pieces([r["members"] for r in large], goals)
    index = F.array_position(F.array(*[F.lit(r["group"]) for r in large]), F.col("group"))
    big = state.filter(index > 0)
    # Places inside a group, found as those inside a shard are.
    ranked = _ranked(big.select("row", "group", F.lit(True).alias("linked"), index.cast("int").alias("shard")))
    ends = F.array(*[_upto([n for _, n in mine]) for mine in pieces])
    shards = F.array(*[F.array(*[F.lit(j) for j, _ in mine]) for mine in pieces])
    piece = F.size(F.filter(F.element_at(ends, F.col("shard")), lambda x: x <= F.col("rank"))) + 1
    ranked = ranked.select("row", F.element_at(F.element_at(shards, F.col("shard")), piece).alias("shard"))
    placed = big.select("row", "group").join(ranked, "row").select("row", "group", F.lit(True).alias("linked"), "shard")
    at = F.pmod(F.xxhash64("row"), F.lit(max(1, sum(room))).cast("long"))
    shard = F.size(F.filter(_upto(room), lambda x: x <= at)).cast("int")
    others = state.filter(index == 0).withColumn("shard", shard)
    return placed, others, [goal - free for goal, free in zip(goals, room)]


def propagate(rows: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS, slack: float = SLACK) -> DataFrame:
    """`row, group, linked, shard` from `row, group`: labels after some rounds, near even sizes."""
    sizes = rows.groupBy("group").agg(F.count(F.lit(1)).alias("members"))
    total = rows.count()
    capacity = total / shards * (1 + slack)
    state = rows.join(sizes, "group").select("row", "group", "members", (F.col("members") > 1).alias("linked"), F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int").alias("shard"))
    state = stored(state, "labels")
    # Fewer than shards groups, or as many: each has more rows than a shard's share. They fill whole shards, and the others move round them.
    goals = _goals(total, shards)
    large = state.filter((F.col("members") > max(goals, default=0)) & F.col("linked")).groupBy("group").agg(F.max("members").alias("members")).orderBy(F.desc("members"), "group").collect()
    placed, fixed = None, [0] * shards
    if large:
        placed, state, fixed = _place_large(state, large, goals)
        placed, state = stored(placed, "placed"), stored(state, "labels")
    for step in range(rounds):
        votes = state.filter("linked").groupBy("group", "shard").agg(F.count(F.lit(1)).alias("n"))
        goal = votes.groupBy("group").agg(F.max(F.struct("n", F.xxhash64("group", "shard").alias("tie"), "shard")).alias("best")).select("group", F.col("best.shard").alias("goal"))
        wanted = stored(state.join(goal, "group", "left").withColumn("goal", F.coalesce("goal", "shard")), "moves")
        moves, loads = [[0] * shards for _ in range(shards)], list(fixed)
        # Rows without links fill the shards at the end; only linked ones need room now.
        for a, b, n in wanted.filter("linked").groupBy("shard", "goal").count().collect():
            loads[a] += n
            if a != b:
                moves[a][b] += n
        if not any(map(any, moves)):
            state = wanted.drop("goal")
            break
        share = F.array(*[F.array(*[F.lit(float(x)) for x in line]) for line in _quotas(moves, loads, capacity)])
        # A group moves as one, unless it is so large that it would upset a shard by itself.
        chance = F.when(F.col("members") > capacity / 4, _unit(F.col("row"), F.lit(step))).otherwise(_unit(F.col("group"), F.lit(step)))
        goes = chance < F.element_at(F.element_at(share, F.col("shard") + 1), F.col("goal") + 1)
        state = wanted.select("row", "group", "members", "linked", F.when(goes, F.col("goal")).otherwise(F.col("shard")).alias("shard"))
    state = state.drop("members")
    return state if placed is None else state.unionByName(placed)


def _ranked(state: DataFrame) -> DataFrame:
    """`row, shard, rank`: the place of each row in its shard, linked ones first, members of a group together."""
    ordered = state.repartitionByRange("shard", F.expr("NOT linked"), "group", "row").sortWithinPartitions("shard", F.expr("NOT linked"), "group", "row")
    ordered = stored(ordered.select("row", "shard", F.monotonically_increasing_id().alias("at")), "ordered")
    ordered = ordered.withColumn("part", F.shiftright("at", 33))
    # One row per partition and shard: partitions are ranges, so these are at most partitions + shards.
    runs = ordered.groupBy("shard", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = runs.alias("x").join(runs.alias("y"), F.expr("x.shard = y.shard AND y.part < x.part"), "left").groupBy("x.shard", "x.part", "x.first").agg(F.coalesce(F.sum("y.n"), F.lit(0)).alias("before"))
    return ordered.join(F.broadcast(before), ["shard", "part"]).select("row", "shard", (F.col("at") - F.col("first") + F.col("before")).alias("rank"))


def cut_links(placed: DataFrame, group: list[str], shard: str = "shard") -> DataFrame:
    """`groups, links, cut`: the linked groups, the links that hold them together (one less than members), and how many the shards cut.

    What the method minimises; a group over k shards costs k - 1 links.
    """
    members = placed.groupBy(*group, shard).agg(F.count(F.lit(1)).alias("n")).groupBy(*group).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("shards"))
    linked = members.filter("n > 1")
    return linked.agg(F.count(F.lit(1)).alias("groups"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("links"), F.coalesce(F.sum(F.col("shards") - 1), F.lit(0)).alias("cut"))


def assign(docs: DataFrame, id: str = "doc_id", text: str = "text", shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """One row per row of `docs`: `id, size, text_crc32, law, shard, slot, grown_shard`.

    Law `rows`: the shards' counts differ by one at most. `size` is the text's UTF-8 bytes plus 1, `slot` counts a
    shard's rows from 0 without gaps, `grown_shard` is null under this law. Documents with equal texts are linked; null
    counts as empty text. Rows with equal or null ids are kept apart. Fewer rows than shards leave shards empty.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"), F.md5(body.cast("binary")).alias("group"))
    rows = stored(rows, "rows")
    ranked = _ranked(propagate(rows.select("row", "group"), shards, rounds))
    loads = [0] * shards
    for shard, n in ranked.groupBy("shard").count().collect():
        loads[shard] = n
    total = sum(loads)
    goals = _goals(total, shards)
    surplus = [max(0, a - b) for a, b in zip(loads, goals)]
    room = [max(0, b - a) for a, b in zip(loads, goals)]
    longs = lambda values: F.array(*[F.lit(v).cast("long") for v in values])
    own = F.col("shard") + 1
    over = F.col("rank") - F.element_at(longs(goals), own)
    # The number of a surplus row among all of them, and the shard whose room that number falls into.
    number = over + F.element_at(longs([sum(surplus[:j]) for j in range(shards)]), own)
    upto = [sum(room[: j + 1]) for j in range(shards)]
    to = F.size(F.filter(longs(upto), lambda x: x <= number))
    placed = ranked.select("row", "shard", "rank", F.when(over >= 0, number).alias("number"), F.when(over >= 0, to).alias("to"))
    slot = F.element_at(longs(loads), F.col("to") + 1) + F.col("number") - F.element_at(longs([0, *upto]), F.col("to") + 1)
    placed = placed.select("row", F.coalesce("to", "shard").cast("int").alias("shard"), F.coalesce(slot, F.col("rank")).alias("slot"))
    return rows.join(placed, "row").select(F.col(id), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
