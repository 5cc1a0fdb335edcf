"""Components against all pairs; routing and traversal lose no link."""

import random

import numpy as np
import pytest

from gaugeline.llm import sigtree
from gaugeline.llm.common import mixed
from gaugeline.llm.sigtree import Rule, Tree, links


def shingles(text, width):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    if len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute(rows, rule):
    """(n, component) of each id; texts of one id count together."""
    sets = [(i, shingles(t, rule.width)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and rule.linked(len(a & b), len(a), len(b)):
                low, high = sorted((find(i), find(j)))
                parent[high] = low
    return sorted((i, len(s), find(i) if s else i) for i, s in sets)


def result(frame, rule=Rule()):
    got = sigtree.similar_documents(frame, rule=rule).collect()
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in got)


def near_copies(seed, texts=40, words=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [rng.choices(vocabulary, k=rng.randrange(1, words)) for _ in range(6)]
    rows = []
    for i in range(texts):
        text = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            text[rng.randrange(len(text))] = rng.choice(vocabulary)
        if rng.random() < 0.3:
            text = text[: rng.randrange(len(text)) + 1]
        rows.append((i, " ".join(text)))
    return rows


@pytest.mark.parametrize("rule", [Rule(), Rule(5, 80), Rule(2, 95)])
def test_near_copies(docs, rule):
    rows = near_copies(rule.percent, words=150)
    assert result(docs(*rows), rule) == brute(rows, rule)


def test_given_documents(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert result(documents) == brute(rows, Rule())


@pytest.mark.parametrize("percent", [80, 90, 97])
def test_linked_sets_always_share_a_signature(percent):
    rule = Rule(percent=percent)
    rng = np.random.default_rng(percent)
    linked = 0
    for _ in range(1500):
        size = int(rng.integers(1, 200))
        pool = mixed(rng.integers(0, 1 << 62, size * 2).astype(np.uint64))
        left = np.unique(pool[:size])
        drop, add = rng.integers(0, 1 + size // 8, 2)
        right = np.unique(np.concatenate([left[drop:], pool[size : size + add]]))
        common = len(np.intersect1d(left, right))
        if len(right) and common < max(len(left), len(right)) and rule.linked(common, len(left), len(right)):
            linked += 1
            (mine, need), (other, need_other) = rule.signatures(left), rule.signatures(right)
            met = 0
            for c in {int(x) % 128 for x in mine}:
                own, its = (x % np.uint64(128) == c for x in (mine, other))
                if its.any():
                    together = len(np.intersect1d(mine[own], other[its]))
                    met = max(met, together >= max(need[own][0], need_other[its][0]))
            assert met
    assert linked > 50


@pytest.mark.parametrize("percent", [80, 90])
@pytest.mark.parametrize("two", [False, True])
def test_traversal_finds_the_components(percent, two):
    rule = Rule(percent=percent)
    rng = np.random.default_rng(percent)
    base = [mixed(rng.integers(0, 1 << 62, int(rng.integers(20, 120))).astype(np.uint64)) for _ in range(25)]
    sets = []
    for _ in range(300):
        one = base[rng.integers(len(base))]
        keep = rng.random(len(one)) > rng.choice([0, 0.02, 0.06, 0.15])
        sets.append(np.unique(np.concatenate([one[keep], one[:3]])))
    sides = [list(range(0, 300, 2)), list(range(1, 300, 2))] if two else [list(range(300))] * 2

    def components(pairs):
        groups = sigtree.Groups(300)
        for a, b in pairs:
            groups.join(a, b)
        tops = {}
        return [tops.setdefault(groups.find(i), len(tops)) for i in range(300)]

    want = [
        (a, b) for a in sides[0] for b in sides[1]
        if a != b and rule.linked(len(np.intersect1d(sets[a], sets[b])), len(sets[a]), len(sets[b]))
    ]
    trees = [Tree([sets[i] for i in side]) for side in (sides if two else sides[:1])]
    got = [(sides[0][a], sides[1][b]) for a, b in links(rule, *trees)]
    assert set(got) <= {*want, *((b, a) for a, b in want)}
    assert components(got) == components(want)
    assert len(got) < 300


def test_tiles_of_a_large_block(docs, monkeypatch):
    monkeypatch.setattr(sigtree, "TILE_BYTES", 4000)
    rows = near_copies(8, texts=80, words=80)
    assert result(docs(*rows), Rule(3, 90)) == brute(rows, Rule(3, 90))


def test_common_passages_make_no_blocks(docs):
    rule = Rule(5, 80)
    rng = random.Random(3)
    passages = [[f"p{i}_{j}" for j in range(10)] for i in range(8)]
    rows = []
    for i in range(400):
        own = [f"t{i}_{j}" for j in range(220)]
        for at, passage in enumerate(passages):
            own[30 * at : 30 * at] = passage
        rows.append((i, " ".join(own)))
    for i in range(3):  # and a near copy of some
        words = rows[i][1].split()
        words[rng.randrange(len(words))] = "other"
        rows.append((400 + i, " ".join(words)))
    frame = docs(*rows)
    met = sigtree._meetings(frame.select("doc_id", "text"), rule).collect()
    # all texts have the passages, but share less than a tenth
    assert 3 <= len(met) < 100
    joined = {(i, c) for i, _, c in result(frame, rule) if i != c}
    assert joined == {(400, 0), (401, 1), (402, 2)}


def test_a_large_block_is_copied_in_rounds(docs, monkeypatch):
    rule = Rule(3, 90)
    monkeypatch.setattr(sigtree, "TILE_BYTES", 4000)
    rng = random.Random(5)
    base = [f"w{j}" for j in range(100)]
    rows = []
    for i in range(90):
        text = list(base)
        for _ in range(rng.randrange(4)):
            text[rng.randrange(100)] = f"x{rng.randrange(200)}"
        rows.append((i, " ".join(text[: rng.choice([100, 98, 70])])))
    seen = []

    def watched(tiled, rule, most, made=sigtree._tile_pairs):
        pairs = sigtree.settled(made(tiled, rule, most))
        seen.append((tiled.collect(), pairs.collect(), most))
        return pairs

    monkeypatch.setattr(sigtree, "_tile_pairs", watched)
    assert result(docs(*rows), rule) == brute(rows, rule)
    ((members, pairs, most),) = seen
    sets = {}
    for row in members:
        sets.setdefault((row.block, row.tile), []).append(row.n)
    tiles = {x for x in sets if x[1] > 0}
    assert len({r["round"] for r in pairs}) > 1
    # every two tiles of a block with sizes that may link, once
    want = [
        (block, i, j) for block, i in tiles for other, j in tiles
        if block == other and i <= j
        and any(rule.linked(min(x, y), x, y) for x in sets[block, i] for y in sets[block, j])
    ]
    got = [(r.block, r.i, r.j) for r in pairs]
    assert len(got) == len(set(got)) and set(want) <= set(got)
    held = {x: 8 * sum(ns) for x, ns in sets.items()}
    for number in {r["round"] for r in pairs}:
        copied = sum(held[r.block, t] for r in pairs if r["round"] == number for t in {r.i, r.j})
        assert copied <= most + 2 * max(held.values()) * len({r.block for r in pairs})


def test_odd_rows(docs):
    long = " ".join(f"x{i}" for i in range(20_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "One"), (6, "one two"), (7, long), (8, long + " y"), (9, long)]
    assert result(docs(*rows)) == brute(rows, Rule())
    assert sigtree.similar_documents(docs()).count() == 0


def test_null_and_repeated_ids(docs):
    text = "a b c d e f g h"
    got = sigtree.similar_documents(docs((None, text), (7, text), (7, "other words of seven here"), (9, "other words of seven here"))).collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in got) == [
        ("7", "7"), ("7", "7"), ("9", "7"), ("None", "7"),
    ]


def test_rules_out_of_range():
    for percent in (79, 100):
        with pytest.raises(ValueError):
            Rule(percent=percent)


def test_the_query_and_its_sql(spark):
    import duckdb

    from gaugeline.llm.oracles import ORACLES
    from gaugeline.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.001"
    got = QUERIES["op5_ngram_jaccard"](spark, sf_dir).toPandas()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = con.execute(ORACLES["op5_ngram_jaccard"]).df()
    assert sorted(map(tuple, got[sorted(got)].values.tolist())) == sorted(
        map(tuple, want[sorted(want)].values.tolist())
    )
