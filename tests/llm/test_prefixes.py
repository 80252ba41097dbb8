import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gridtide.llm import prefixes

SCHEMA = "conv_id long, turn long, role string, text string, depth string, src string, pos string"


def own_turns(rows):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            digest = hashlib.sha256(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).hexdigest()
            own[c].append((turn is not None, turn, digest, (role or "", text or "")))
    return {c: [x[3] for x in sorted(t, key=lambda x: (x[0], x[1] or 0, x[2]))] for c, t in own.items()}


def plain(rows, base, head):
    own = own_turns(rows)
    rebuilt = {c: (own.get(base(c), [])[: head(c)] + t[head(c) :] if base(c) != c else t) for c, t in own.items()}
    members = defaultdict(list)
    for c, t in rebuilt.items():
        for d in range(len(t) + 1):
            members[tuple(t[:d])].append(c)
    children = defaultdict(list)
    for seq in members:
        if seq:
            children[seq[:-1]].append(seq)
    leaves, saved = {}, {}
    for seq in sorted(members, key=len, reverse=True):
        leaves[seq] = sum(leaves[k] for k in children[seq]) if children[seq] else 1
        saved[seq] = sum(saved[k] for k in children[seq]) + ((len(members[seq]) - 1) * len(seq[-1][1].encode()) if seq else 0)
    out = []
    for seq, m in members.items():
        ends = sorted(c for c in m if len(rebuilt[c]) == len(seq))
        out.append((min(m), len(seq), min(members[seq[:-1]]) if seq else None, len(m), len(children[seq]), leaves[seq], saved[seq], hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(), len(ends)))
    return sorted(out, key=repr)


def check(spark, rows, base, head, parts=5):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "n_ends")
    got = prefixes.build_trie(df, base[0], head[0]).select(*names).collect()
    assert sorted(map(tuple, got), key=repr) == plain(rows, base[1], head[1])


BY_FIVE = (lambda c: c - c % 5, lambda c: c - c % 5)
BY_HASH = (lambda c: F.crc32(c.cast("string").cast("binary")) % 9, lambda c: zlib.crc32(str(c).encode()) % 9)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)
    openings = [("user", f"é opening {k}") for k in range(3)]
    out = []
    for c in range(150):
        if c % 20 == 10:
            continue  # a base that is not there
        turns = [rng.choice(openings)] if rng.random() < 0.7 else []
        turns += [(rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "", None, f"own {rng.randrange(20)}"])) for _ in range(rng.randrange(0 if turns else 1, 12))]
        out += [(c, k if k else None, r, t, "x", None, None) for k, (r, t) in enumerate(turns)]
    out += [(1000 + k, 0, "user", "copy", None, None, None) for k in range(50)]  # equal conversations; most lose their turn to a head
    out += [(2000, k, "user", f"turn {k % 7}", None, None, None) for k in range(700)]  # a third of all rows, over partitions
    out += [(2003, k, "user", f"turn {k % 7}", None, None, None) for k in range(650)]
    return out + out[:7] + [(None, 0, "user", "lost", None, None, None), (7, 3, "user", "tie", None, None, None), (7, 3, "assistant", "tie", None, None, None)]


def test_against_brute_force(spark, rows, monkeypatch):
    monkeypatch.setattr(prefixes, "BLOCK_IDS", 3)
    check(spark, rows, BY_FIVE, BY_HASH)


def test_long_heads_and_one_base(spark, rows):
    """Every conversation takes up to 300 turns of the long one."""
    check(spark, [r for r in rows if r[0] is None or r[0] < 40 or r[0] >= 2000], (lambda c: F.lit(2000), lambda c: 2000), (lambda c: c % 300, lambda c: c % 300))


def test_clashing_fingerprints_are_seen(spark, rows, monkeypatch):
    """With multipliers of one, turns in another order have the same value; the next ones are taken."""
    seeds, real = [], prefixes._multipliers
    monkeypatch.setattr(prefixes, "_multipliers", lambda seed: seeds.append(seed) or ([1, 1, 1] if seed == 0 else real(seed)))
    swapped = [(c, k, "user", t, None, None, None) for c, order in ((300, "ABC"), (305, "BAC")) for k, t in enumerate(order)]
    check(spark, [r for r in rows if r[0] is not None and r[0] < 40] + swapped, BY_FIVE, BY_HASH)
    assert seeds == [0, 1]


def test_different_texts_of_one_digest_are_seen(spark):
    """Digests that do not tell two texts apart are found out by reading the stored turns."""
    turns = spark.createDataFrame([(c, 0, "00" * 32, 1, "user", "ab"[c]) for c in range(2)], "conv long, turn long, digest string, bytes long, role string, text string")
    found = prefixes._prefixes(turns, prefixes._multipliers(0), 0)
    rows = prefixes._rebuilt(found, lambda c: c, lambda c: F.lit(0), prefixes._multipliers(0))
    nodes = rows.groupBy("key1", "key2").agg(*[f(c).alias(c + n) for c in ("turn1", "turn2", "src", "pos") for f, n in ((F.min, ""), (F.max, "_max"))])
    assert prefixes._clash(rows, nodes, found, turns)
    assert not prefixes._clash(rows, nodes, found, turns.withColumn("text", F.lit("a")))


def test_empty_table(spark):
    assert prefixes.build_trie(spark.createDataFrame([], SCHEMA), BY_FIVE[0], BY_HASH[0]).count() == 0
