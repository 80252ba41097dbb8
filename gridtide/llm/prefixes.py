"""The prefix trie of rebuilt conversations, from fingerprints that compose; no rebuilt text is ever made.

Fingerprints are pairs (length, value) with value = sum of t_i * m**i over the turns, for three moduli; pairs of two sequences
combine to (l1 + l2, v1 + m**l1 * v2), which is associative. One pass gives every prefix of every stored
conversation. A prefix of a rebuilt conversation is a prefix of its base's turns, or that head combined with a piece of its own turns,
whose pair is the difference of two of its own prefixes, shifted. The parent's fingerprint follows from a node's own and its
last turn. A row of the trie is thus a few numbers and a reference to a stored turn.

Prefixes with one fingerprint form a node. Its members' last turns must have one digest, and where members refer to different
stored turns, their texts are read and compared; by induction over the depth the sequences are then equal. If any
differ, other multipliers are taken.

Sums over subtrees need no walk: every node is named by its smallest member, so the nodes that one conversation names
form one chain, from the first depth at which no smaller conversation shares its path down to its end. A subtree's leaves and shared bytes
are sums over its members of values of their chains.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from gridtide.llm import words as W
from gridtide.session import stored

# The three largest primes below 2**31.
PRIMES = (2147483647, 2147483629, 2147483587)
LANES = range(len(PRIMES))
DIGIT, DIGITS = 64, 6  # powers are products of table values, one for each base-64 digit of the exponent
BLOCK_IDS = 4096
NO_ENDS = hashlib.sha256(b"").hexdigest()


def _multipliers(seed: int) -> list[int]:
    return [int(x) % (p - 3) + 2 for x, p in zip(W.constants(len(PRIMES), 100 + seed), PRIMES)]


def _power(base: int, prime: int, exponent: str) -> str:
    """SQL for base ** exponent modulo the prime, for exponents from 0 to 64**6 - 1."""
    out = None
    for d in range(DIGITS):
        table = ", ".join(f"{pow(base, k * DIGIT**d, prime)}L" for k in range(DIGIT))
        value = f"array({table})[CAST(shiftright({exponent}, {6 * d}) & {DIGIT - 1} AS INT)]"
        out = value if out is None else f"({out} * {value}) % {prime}"
    return out


def _packed(depth: str = "depth", name: str = "f") -> list[Column]:
    """The key of a prefix: its three values and its depth in two numbers."""
    return [F.expr(f"shiftleft({name}0, 32) | {name}1").alias("key1"), F.expr(f"shiftleft({name}2, 32) | {depth}").alias("key2")]


def _turns(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    return conversations.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"), digest.alias("digest"), F.octet_length(text).cast("long").alias("bytes"), role.alias("role"), text.alias("text"),
    )


def _prefixes(turns: DataFrame, multipliers: list[int], seed: int) -> DataFrame:
    """`conv, pos, bytes, u0..u2` (the turn), `f0..f2, upto` (the prefix up to it), `turn, digest`.

    Turns are sorted over the cluster, so a conversation of any length is spread; pieces of one that lies in several
    partitions are combined like any two sequences.
    """
    narrow = turns.select("conv", "turn", F.unhex("digest").alias("digest"), "bytes")
    order = ("conv", "turn", "digest")
    placed = narrow.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"part": F.spark_partition_id(), "row": F.monotonically_increasing_id()})
    placed = stored(placed, "turns")
    lane = lambda k: F.conv(F.substring(F.hex("digest"), 1 + 8 * ((k + seed) % 8), 8), 16, 10).cast("long") % PRIMES[k]
    here = Window.partitionBy("part", "conv").orderBy("row")
    local = placed.withColumns({f"u{k}": lane(k) for k in LANES}).withColumn("at", F.row_number().over(here).cast("long"))
    local = local.withColumns({f"x{k}": F.expr(f"(u{k} * {_power(multipliers[k], PRIMES[k], 'at')}) % {PRIMES[k]}") for k in LANES})
    upto = here.rowsBetween(Window.unboundedPreceding, 0)
    local = local.withColumns({f"l{k}": F.sum(f"x{k}").over(upto) % PRIMES[k] for k in LANES} | {"lb": F.sum("bytes").over(upto)})
    local = stored(local.drop("row", *[f"x{k}" for k in LANES]), "pieces")

    # A conversation in several partitions is the first or last of each: at most two rows per partition.
    edges = placed.groupBy("part").agg(F.min("conv").alias("lo"), F.max("conv").alias("hi")).select("part", F.explode(F.array("lo", "hi")).alias("conv")).distinct()
    split = edges.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("conv")
    pieces = local.join(F.broadcast(split), "conv").groupBy("conv", "part").agg(F.max("at").alias("n"), F.max_by(F.struct("lb", *[f"l{k}" for k in LANES]), "at").alias("whole"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("off", F.coalesce(F.sum("n").over(before), F.lit(0)))
    pieces = pieces.withColumns({f"w{k}": F.expr(f"(whole.l{k} * {_power(multipliers[k], PRIMES[k], 'off')}) % {PRIMES[k]}") for k in LANES})
    pieces = pieces.select("conv", "part", "off", F.coalesce(F.sum("whole.lb").over(before), F.lit(0)).alias("ob"), *[(F.coalesce(F.sum(f"w{k}").over(before), F.lit(0)) % PRIMES[k]).alias(f"o{k}") for k in LANES])
    joined = local.join(F.broadcast(stored(pieces, "joins")), ["conv", "part"], "left")
    moved = lambda k: F.expr(f"IF(off IS NULL, l{k}, (o{k} + l{k} * {_power(multipliers[k], PRIMES[k], 'coalesce(off, 0L)')}) % {PRIMES[k]})")
    return joined.select(
        "conv", (F.coalesce("off", F.lit(0)) + F.col("at")).alias("pos"), "bytes", (F.coalesce("ob", F.lit(0)) + F.col("lb")).alias("upto"), *[f"u{k}" for k in LANES], *[moved(k).alias(f"f{k}") for k in LANES], "turn", "digest",
    )


def _rebuilt(prefixes: DataFrame, base: Callable, head: Callable, multipliers: list[int]) -> DataFrame:
    """One row per prefix of every rebuilt conversation, the empty one included: its key, its last turn, and where that is stored."""
    convs = prefixes.groupBy("conv").agg(F.max("pos").alias("n"))
    plan = convs.withColumn("base", base(F.col("conv")).cast("long"))
    plan = plan.withColumn("head", F.when(F.col("base") == F.col("conv"), 0).otherwise(F.coalesce(head(F.col("conv")), F.lit(0))).cast("long"))
    plan = plan.join(convs.select(F.col("conv").alias("base"), F.col("n").alias("n_base")), "base", "left")
    plan = plan.withColumn("taken", F.least("head", F.coalesce("n_base", F.lit(0))))
    plan = stored(plan.withColumn("size", F.col("taken") + F.greatest(F.col("n") - F.col("head"), F.lit(0))).drop("n_base"), "plan")

    values = ["bytes", *[f"u{k}" for k in LANES]]
    lanes = [f"f{k}" for k in LANES]
    source = prefixes.select(F.col("conv").alias("src"), "pos", "upto", *values, *lanes)
    heads = source.join(plan.filter("taken > 0").select("conv", "base", "taken", "size"), (F.col("src") == F.col("base")) & (F.col("pos") <= F.col("taken"))).withColumn("depth", F.col("pos"))
    named = lambda df, x: df.select("conv", *[F.col(f"f{k}").alias(f"{x}{k}") for k in LANES], F.col("upto").alias(f"{x}b"))
    cut_base = named(heads.filter("depth = taken"), "a")
    longer = plan.filter("n > head")
    cut_own = named(source.join(longer.filter("head > 0").select("conv", "head"), (F.col("src") == F.col("conv")) & (F.col("pos") == F.col("head"))), "b")
    cuts = longer.join(cut_base, "conv", "left").join(cut_own, "conv", "left").na.fill(0, [f"{x}{k}" for x in "ab" for k in (*LANES, "b")])
    tails = source.join(cuts, (F.col("src") == F.col("conv")) & (F.col("pos") > F.col("head")))
    # Own turns from `head` on, as a sequence of their own, after the base's head.
    inverse = [pow(m, -1, p) for m, p in zip(multipliers, PRIMES)]
    shift = lambda k: _power(inverse[k], PRIMES[k], "(head - taken)")
    joined = {f"f{k}": F.expr(f"(a{k} + IF(head = taken, f{k} - b{k} + {PRIMES[k]}, ((f{k} - b{k} + {PRIMES[k]}) % {PRIMES[k]}) * {shift(k)})) % {PRIMES[k]}") for k in LANES}
    tails = tails.withColumns(joined | {"upto": F.col("ab") + F.col("upto") - F.col("bb"), "depth": F.col("pos") - F.col("head") + F.col("taken")})
    columns = ["conv", "size", "depth", "src", "pos", "upto", *values, *lanes]
    zero = F.lit(0).cast("long")
    roots = plan.select("conv", "size", *[zero.alias(c) for c in columns[2:]])
    rows = roots.unionByName(heads.select(*columns)).unionByName(tails.select(*columns))
    return rows.select("conv", "src", "pos", "bytes", "upto", *_packed(), F.expr("shiftleft(u0, 32) | u1").alias("turn1"), F.col("u2").alias("turn2"), (F.col("depth") == F.col("size")).alias("last"))


def _ends(rows: DataFrame) -> DataFrame:
    """`key1, key2, ends_sha256` of the nodes at which some conversation ends.

    Ids are sorted over the cluster by node and joined to blocks of text where they lie; a hash over many ids then reads blocks, as a stream.
    """
    keys = [("key1", pa.int64()), ("key2", pa.int64())]

    def join(batches):
        key, first, held = None, None, []

        def block():
            return pa.RecordBatch.from_pydict({"key1": pa.array([key[0]], pa.int64()), "key2": pa.array([key[1]], pa.int64()), "first": pa.array([first], pa.int64()), "ids": pa.array([",".join(held)], pa.string())})

        for batch in batches:
            for a, b, c in zip(*(batch.column(x).to_pylist() for x in ("key1", "key2", "conv"))):
                if held and (key != (a, b) or len(held) == BLOCK_IDS):
                    yield block()
                    held = []
                if not held:
                    key, first = (a, b), c
                held.append(str(c))
        if held:
            yield block()

    def digest(batches):
        key, state = None, None

        def out(done):
            return pa.RecordBatch.from_pydict({k: pa.array([d[i] for d, _ in done], t) for i, (k, t) in enumerate(keys)} | {"ends_sha256": pa.array([s.hexdigest() for _, s in done], pa.string())})

        for batch in batches:
            done = []
            for a, b, ids in zip(*(batch.column(x).to_pylist() for x in ("key1", "key2", "ids"))):
                if key == (a, b):
                    state.update(b"," + ids.encode())
                    continue
                if key:
                    done.append((key, state))
                key, state = (a, b), hashlib.sha256(ids.encode())
            if done:
                yield out(done)
        if key:
            yield out([(key, state)])

    order = ("key1", "key2", "conv")
    blocks = rows.filter("last").select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(join, "key1 long, key2 long, first long, ids string")
    return blocks.repartition("key1", "key2").sortWithinPartitions("key1", "key2", "first").mapInArrow(digest, "key1 long, key2 long, ends_sha256 string")


def _clash(rows: DataFrame, nodes: DataFrame, prefixes: DataFrame, turns: DataFrame) -> bool:
    """Whether a node has members with different last turns: by digest, and by text where they are stored in different places."""
    if nodes.filter("turn1 <> turn1_max OR turn2 <> turn2_max").limit(1).count():
        return True
    several = nodes.filter("src <> src_max OR pos <> pos_max").select("key1", "key2")
    # Distinct first: what follows a join on the node alone must not need the rows of a node together.
    refs = rows.select("key1", "key2", "src", "pos").distinct().join(several, ["key1", "key2"], "left_semi")
    places = prefixes.select(F.col("conv").alias("src"), "pos", "turn", "digest")
    refs = stored(refs.join(places, ["src", "pos"]).select("key1", "key2", F.struct("src", "turn", F.lower(F.hex("digest"))).alias("place")), "references")
    texts = turns.select(F.struct("conv", "turn", "digest").alias("place2"), "role", "text")
    read = refs.join(texts, F.col("place") == F.col("place2")).groupBy("key1", "key2")
    read = read.agg(F.min("role").alias("r"), F.max("role").alias("r2"), F.min("text").alias("t"), F.max("text").alias("t2"))
    return read.filter("r <> r2 OR t <> t2").limit(1).count() > 0


def build_trie(conversations: DataFrame, base: Callable[[Column], Column], head: Callable[[Column], Column], conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The nodes of the trie of all rebuilt conversations, as a table.

    `base` and `head` give, from a column of conversation ids, the conversation whose first turns are taken, and how many (0 or more). A conversation c is
    rebuilt from the first `head` turns of its base (all if it has fewer, none if there is no such conversation), then its
    own turns after its first `head`; one that is its own base stays as it is. A node is a sequence of turns (role and text) with which
    some rebuilt conversation starts; the empty one, at depth 0, is the root of all.

    `conv_id` is the smallest conversation with the prefix, `depth` its turns, `parent_conv_id` the parent's `conv_id` (null for the root), `n_convs`
    the conversations that start with it, `n_children` the nodes one turn longer, `n_leaves` the childless nodes in its subtree (itself included),
    `saved_tokens` the sum over the subtree of (n_convs - 1) times the bytes of the node's last text, `ends_sha256` the hash
    of the ids that end here, ascending and joined by commas; `n_ends` counts them.

    Turns are ordered by `turn`, null first, ties by a digest of role and text; repeated rows are repeated turns. Null roles and texts
    are empty. Rows without a conversation id are left out. Conversations without turns end at the root. Other columns are not
    used, whatever their names. An empty table has no nodes.
    """
    turns = _turns(conversations, conv, turn, role, text)
    seed = 0
    while True:
        multipliers = _multipliers(seed)
        prefixes = _prefixes(turns, multipliers, seed)
        rows = stored(_rebuilt(prefixes, base, head, multipliers), "prefixes")
        first = rows.groupBy("key1", "key2").agg(
            F.min("conv").alias("conv"), F.min(F.col("upto") - F.col("bytes")).alias("before"), F.count(F.lit(1)).alias("n_convs"), F.count_if("last").alias("n_ends")
        )
        # Of each conversation: the bytes that a smaller one has on its path, and whether its end is a leaf that it names.
        chains = first.groupBy("conv").agg(F.min("before").alias("shared"), F.max((F.col("n_convs") == F.col("n_ends")).cast("long")).alias("leaf"))
        whole = rows.filter("last").select("conv", F.col("upto").alias("total"))
        members = whole.join(chains, "conv", "left").select("conv", F.coalesce("shared", "total").alias("shared"), F.coalesce("leaf", F.lit(0)).alias("leaf"))
        more = F.greatest(F.col("shared") - F.col("upto") + F.col("bytes"), F.lit(0))
        nodes = stored(rows.join(members, "conv").groupBy("key1", "key2").agg(
            F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.count_if("last").alias("n_ends"), F.sum("leaf").alias("n_leaves"), F.sum(more).alias("saved_tokens"),
            F.min("turn1").alias("turn1"), F.max("turn1").alias("turn1_max"), F.min("turn2").alias("turn2"), F.max("turn2").alias("turn2_max"),
            F.min("src").alias("src"), F.max("src").alias("src_max"), F.min("pos").alias("pos"), F.max("pos").alias("pos_max"),
        ), "nodes")
        if not _clash(rows, nodes, prefixes, turns):
            break
        seed += 1

    open_ = nodes.withColumns({"depth": F.expr("key2 & 4294967295"), "f0": F.expr("shiftright(key1, 32)"), "f1": F.expr("key1 & 4294967295"), "f2": F.expr("shiftright(key2, 32)")})
    open_ = open_.withColumns({"u0": F.expr("shiftright(turn1, 32)"), "u1": F.expr("turn1 & 4294967295"), "u2": F.col("turn2")})
    # The parent's fingerprint: the node's without its last turn.
    lanes = {f"p{k}": F.expr(f"(f{k} - (u{k} * {_power(multipliers[k], PRIMES[k], 'depth')}) % {PRIMES[k]} + {PRIMES[k]}) % {PRIMES[k]}") for k in LANES}
    up = open_.withColumns(lanes)
    parent = [c.alias(n) for c, n in zip(_packed("(depth - 1)", "p"), ("up1", "up2"))]
    up = up.select("key1", "key2", "conv_id", "depth", "n_convs", "n_ends", "n_leaves", "saved_tokens", *parent)
    children = up.filter("depth > 0").groupBy(F.col("up1").alias("key1"), F.col("up2").alias("key2")).agg(F.count(F.lit(1)).alias("n_children"))
    names = nodes.select(F.col("key1").alias("up1"), F.col("key2").alias("up2"), F.col("conv_id").alias("parent_conv_id"))
    full = up.join(children, ["key1", "key2"], "left").join(_ends(rows), ["key1", "key2"], "left")
    # The root has children without bound, so its name is added by value.
    root = nodes.filter("key2 & 4294967295 = 0").select(F.col("conv_id").alias("root"))
    below = full.join(names.filter("up2 & 4294967295 > 0"), ["up1", "up2"], "left").join(F.broadcast(root), how="left")
    return below.select(
        "conv_id", "depth", F.expr("CASE WHEN depth = 1 THEN root WHEN depth > 1 THEN parent_conv_id END").alias("parent_conv_id"), "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"), "n_ends",
    )
