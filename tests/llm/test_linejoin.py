import random
from collections import Counter
from itertools import combinations, permutations

import numpy as np
import pyarrow as pa
import pytest

from sensorloom.llm import linedup
from sensorloom.llm.components import components
from sensorloom.llm.shingles import Powers


def changed(line, rng, edits):
    out = list(line)
    for _ in range(edits):
        i = rng.randrange(len(out) + 1)
        kind = rng.randrange(3)
        if kind == 0 or i == len(out):
            out.insert(i, rng.choice("abé😀"))
        elif kind == 1:
            del out[i]
        else:
            out[i] = rng.choice("abé")
    return "".join(out)


def test_different_lines_are_never_one():
    """Lines of the same words in another order have one parity mask; their short hashes meet, their nodes don't."""
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda".split()
    rng = random.Random(1)
    lines = {" ".join(rng.sample(words, 11)) for _ in range(300_000)}
    lines |= {f"page {n} of the catalogue, printed on {n % 28 + 1}/{n % 12 + 1}/20{n % 90 + 10}" for n in range(700_000)}
    assert len(set(map(linedup.node_of, lines))) == len(lines)
    # Texts that a polynomial modulo 2**64 takes for one.
    thue = "".join("ab"[bin(n).count("1") % 2] for n in range(2048))
    assert linedup.node_of(thue) != linedup.node_of(thue.translate(str.maketrans("ab", "ba")))


def test_permuted_lines_stay(documents):
    words = "some words that stand here in any order".split()
    texts = ["\n".join(" ".join(p) for p in list(permutations(words))[k :: 40][:60]) for k in range(40)]
    docs = documents(list(enumerate(texts)))
    different = {line for t in texts for line in t.split("\n")}
    assert linedup._lines(docs, True).select("node").distinct().count() == len(different)
    rows = {(r.doc_id, r.line_no): r for r in linedup.near_duplicate_lines(docs)[0].collect()}
    assert len(rows) == sum(len(t.split("\n")) for t in texts)


@pytest.mark.parametrize("most", [1, 2, 3])
def test_lanes_equal_one_by_one(most):
    rng = random.Random(most)
    for _ in range(30):
        base = "".join(rng.choice("abé ") for _ in range(rng.randint(10, 40)))
        lines = [changed(base, rng, rng.randint(0, 5)) for _ in range(40)] + [base, base[1:] + "x", "", base * 2]
        rows = np.array(rng.sample(range(len(lines)), 30))
        points = np.frombuffer(base.encode("utf-32-le"), np.uint32)
        lanes = linedup.Lanes(lines)
        assert lanes.distances(points, rows, most).tolist() == [linedup.edit_distance(base, lines[r], most) for r in rows]
        fitting = np.array([r for r in range(len(lines)) if 0 <= len(lines[r]) - len(base) <= most])
        for before in range(most + 1):
            shared = lanes.share(points, fitting, before, most)
            assert shared.tolist() == [linedup.first_shared(base, lines[r], most) < before for r in fitting]


def _table(lines, segment=0):
    short = linedup.nodes_of(lines, Powers())
    return pa.table({"line": lines, "node": pa.array(map(linedup.node_of, lines), pa.binary()), "node_short": short, "segment": [segment] * len(lines)})


def test_blocks_count_partners_and_keep_what_is_connected():
    rng = random.Random(9)
    lines = sorted({"a shared beginning " + "".join(rng.choice("abc") for _ in range(5)) + " and end" for _ in range(150)})
    near = [(a, b) for a, b in combinations(lines, 2) if linedup.edit_distance(a, b, 2) <= 2]
    for cut in (150, 60):
        parts = [lines[:cut], lines[cut:]]
        found = [linedup.block_partners(_table(x), _table(y), 2).to_pylist() for x in parts for y in parts]
        every = [r for x in parts for y in parts for r in linedup.block_partners(_table(x), _table(y), 2, True).to_pylist()]
        partners = Counter()
        for r in (r for rows in found for r in rows if r["b"] is None):
            partners[r["a"]] += r["n"]
        degree = Counter(linedup.node_of(x) for pair in near for x in pair)
        assert partners == degree
        assert {frozenset((r["a"], r["b"])) for r in every} == {frozenset(map(linedup.node_of, p)) for p in near} and len(every) == len(near)
        links = [(r["a"], r["b"]) for rows in found for r in rows if r["b"] is not None]
        assert all(len([r for r in rows if r["b"] is not None]) < 300 for rows in found)

        def roots(pairs):
            root = {linedup.node_of(x): linedup.node_of(x) for x in lines}

            def find(x):
                while root[x] != x:
                    x = root[x]
                return x

            for a, b in pairs:
                root[find(a)] = find(b)
            return len({find(x) for x in root})

        assert roots(links) == roots([tuple(map(linedup.node_of, p)) for p in near])


@pytest.mark.parametrize("paired,block", [(64, 1024), (3, 90), (10_000, 1024)])
def test_a_group_of_near_lines(spark, documents, monkeypatch, paired, block):
    """Rows follow the lines, not their pairs, whatever is paired one by one and however the blocks are cut."""
    monkeypatch.setattr(linedup, "PAIRED", paired)
    monkeypatch.setattr(linedup, "BLOCK_LINES", block)
    lines = [f"page {n:03d} of the catalogue of all the things that there are" for n in range(600)]
    rng = random.Random(2)
    lines += [f"{changed('another line, that some others are like', rng, 2)}" for _ in range(50)]
    lines = sorted(set(lines))
    docs = documents([(k, "\n".join(lines[k::5] + lines[:3])) for k in range(5)])
    found, every = linedup.near_duplicate_lines(docs, busy_places=4)
    degree = Counter()
    for a, b in combinations(lines, 2):
        if abs(len(a) - len(b)) <= 2 and linedup.edit_distance(a, b, linedup.edits_allowed(a, b, 2)) <= linedup.edits_allowed(a, b, 2):
            degree[a] += 1
            degree[b] += 1
    got = {(r.doc_id, r.line_no): r.n_links for r in found.collect()}
    assert got == {(k, n): degree[line] for k in range(5) for n, line in enumerate(lines[k::5] + lines[:3])}
    if paired < 100:
        links, partners, _ = linedup.near_lines(linedup._lines(docs, True))
        assert links.count() < 20 * len(lines) and partners.count() < 20 * len(lines) < every.count()


def test_runs_over_several_batches(spark, monkeypatch):
    """A run of a key may lie in several Arrow batches, and a long one is passed on, not held."""
    monkeypatch.setattr(linedup, "PAIRED", 5)
    rows = [(k, 64 * n, role) for k, size in enumerate([1, 2, 5, 6, 40, 3, 1]) for n, role in enumerate([0] * (size // 2 + 1) + [24] * (size - size // 2 - 1))]
    rows += [(50, 64 * n, 16) for n in range(30)]  # nobody is indexed there
    df = spark.createDataFrame(rows, "key bigint, node bigint, role tinyint")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        met = linedup._meetings(df, 2).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    crowded = Counter(r.key for r in met if r.key is not None)
    assert crowded == {3: 6, 4: 40}
    indexed = {k: size // 2 + 1 for k, size in ((1, 2), (2, 5), (5, 3))}
    sizes = {1: 2, 2: 5, 5: 3}
    wanted = sum(indexed[k] * (indexed[k] - 1) // 2 + indexed[k] * (sizes[k] - indexed[k]) for k in sizes)
    assert len([r for r in met if r.key is None]) == wanted


def test_components_of_binary_nodes(spark):
    links = spark.createDataFrame([(bytes([a]), bytes([b])) for a, b in [(1, 2), (2, 3), (9, 7)]], "a binary, b binary")
    got = {bytes(r.node): bytes(r.root) for r in components(links).collect()}
    assert got == {b"\x01": b"\x01", b"\x02": b"\x01", b"\x03": b"\x01", b"\x09": b"\x07", b"\x07": b"\x07"}


def test_very_long_lines(documents):
    rng = random.Random(3)
    long = "".join(rng.choice("abcdefgh ") for _ in range(300_000))
    rows = [(1, long), (2, long[:150_000] + "X" + long[150_001:]), (3, long[:-1]), (4, long[::-1])]
    got = {r.doc_id: (r.first_doc, r.n_links) for r in linedup.near_duplicate_lines(documents(rows))[0].collect()}
    assert got == {1: (1, 2), 2: (1, 2), 3: (1, 2), 4: (4, 0)}

