import collections
import zlib

from gridtide.llm.shards import _pieces, _quotas, assign, cut_links, propagate

from .conftest import SCHEMA


def check(rows, source, shards=8):
    assert sorted((r.doc_id for r in rows), key=repr) == sorted((x[0] for x in source), key=repr)
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert 0 <= r.shard < shards and r.law == "rows" and r.grown_shard is None
    counts = [len(slots[j]) for j in range(shards)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_law_and_values(spark, docs, corpus, nothing):
    rows = assign(docs.selectExpr("*", "1 AS shard", "2 AS slot", "3 AS size")).collect()
    check(rows, corpus)
    texts = {(i, zlib.crc32((t or "").encode()), len((t or "").encode()) + 1) for i, t, *_ in corpus}
    assert {(r.doc_id, r.text_crc32, r.size) for r in rows} == texts
    assert assign(nothing).count() == 0
    few = corpus[:3]
    check(assign(spark.createDataFrame(few, SCHEMA)).collect(), few)


def test_groups_stay_together_and_a_huge_one_is_spread(spark):
    rows = [(i, f"group {i % 400}" if i < 1600 else f"own {i}", "", "", 0) for i in range(4000)]
    placed = assign(spark.createDataFrame(rows, SCHEMA), shards=4).collect()
    check(placed, rows, 4)
    where = collections.defaultdict(set)
    for r in placed:
        if r.doc_id < 1600:
            where[r.doc_id % 400].add(r.shard)
    split = sum(len(v) > 1 for v in where.values())
    assert split <= 8, split
    rows = [(i, "the same" if i % 2 else f"own {i}", "", "", 0) for i in range(700)]
    check(assign(spark.createDataFrame(rows, SCHEMA)).collect(), rows)


def test_quotas_respect_capacity():
    moves, loads = [[0, 90, 0], [10, 0, 0], [50, 60, 0]], [100, 100, 110]
    share = _quotas(moves, loads, 110)
    for j in range(3):
        after = loads[j] + sum(share[i][j] * moves[i][j] - share[j][i] * moves[j][i] for i in range(3))
        assert after <= 111


def test_small_groups_are_not_cut_where_nothing_forces_it(spark):
    """A few dozen groups among many single documents, several times over."""
    for seed in range(3):
        rows = [(i, f"group {seed} {i % 37}" if i < 150 else f"own {seed} {i}", "", "", 0) for i in range(1000)]
        placed = assign(spark.createDataFrame(rows, SCHEMA))
        found = cut_links(placed, ["size", "text_crc32"]).first()
        assert (found.groups, found.links, found.cut) == (37, 113, 0)


def test_propagation_ends_with_less_cut_than_it_began_with(spark):
    """A group of a third of all rows has to be spread; the others end whole, and no shard is far above its share."""
    rows = spark.range(6000).selectExpr("id AS row", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN concat('g', id div 12) ELSE concat('own', id) END AS group")
    cuts = [cut_links(propagate(rows, 8, rounds).filter("group <> 'hot'"), ["group"]).first().cut for rounds in (0, 1, 12)]
    assert cuts[0] > 500 and cuts[1] < cuts[0] / 3 and cuts[2] <= cuts[1] and cuts[2] <= 10
    loads = [r["count"] for r in propagate(rows).groupBy("shard").count().collect()]
    assert len(loads) == 8 and max(loads) <= 6000 / 8 * 1.12
    assert tuple(cut_links(spark.createDataFrame([], "group string, shard int"), ["group"]).first()) == (0, 0, 0)


def test_groups_larger_than_a_shard_take_as_few_shards_as_can_hold_them(spark):
    """A third and a fifth of all rows, over eight shards: three and two shards, and no small group is cut for them."""
    text = lambda i: "first" if i % 3 == 0 else "second" if i % 5 == 1 else f"group {i // 20}" if i % 2 else f"own {i}"
    rows = [(i, text(i), "", "", 0) for i in range(3000)]
    placed = assign(spark.createDataFrame(rows, SCHEMA)).collect()
    check(placed, rows)
    where = collections.defaultdict(set)
    for r in placed:
        where[text(r.doc_id)].add(r.shard)
    assert len(where["first"]) == 3 and len(where["second"]) == 2
    assert sum(len(v) - 1 for k, v in where.items() if k.startswith("group")) <= 10
    everything = [(i, "the same", "", "", 0) for i in range(21)]
    check(assign(spark.createDataFrame(everything, SCHEMA)).collect(), everything)


def test_pieces_fill_whole_shards_first():
    pieces, room = _pieces([1000, 400], [375] * 8)
    assert [sorted(n for _, n in mine) for mine in pieces] == [[250, 375, 375], [25, 375]]
    assert sum(room) == 3000 - 1400 and pieces[0][-1][0] == pieces[1][-1][0]
    assert _pieces([], [2, 1]) == ([], [2, 1]) and sum(_pieces([15], [2] * 7 + [1])[1]) == 0
