import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorloom.llm import linedup, neardup
from sensorloom.llm.components import components
from sensorloom.llm.shingles import Powers, mixed, shingle_hashes, word_hashes


def classes(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(2)
    pairs = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(160)] + [(1000, i) for i in range(900, 1000)] + [(2000 + i, 2001 + i) for i in range(40)]
    pairs += pairs[:20] + [(5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    wanted = classes(pairs, {x for p in pairs for x in p})
    assert got == {n: r for n, r in wanted.items() if any(n in p and p[0] != p[1] for p in pairs)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_word_hashes_do_not_depend_on_the_cut(monkeypatch):
    text = np.frombuffer(("one twö  three\tone " * 50 + "x" * 500 + " end").encode(), np.uint8)
    whole = word_hashes(text, Powers())
    monkeypatch.setattr("sensorloom.llm.shingles.CHUNK", 64)
    assert (word_hashes(text, Powers()) == whole).all()
    assert len(whole) == 202 and whole[0] == whole[3] and whole[0] != whole[1]
    assert len(shingle_hashes(whole)) == 198 and len(shingle_hashes(whole[:3])) == 1 and len(shingle_hashes(whole[:0])) == 0


def test_samples_agree_with_the_similarity():
    rng = np.random.default_rng(1)
    for share in (0.3, 0.6, 0.9):
        members = rng.integers(0, 1 << 62, 400).astype(np.uint64)
        weights = rng.uniform(0.5, 6, 400)
        n = int(400 * share)
        a = (np.sort(members[:n + 20]), weights[np.argsort(members[:n + 20])])
        b = (np.sort(members[20:]), weights[20:][np.argsort(members[20:])] * 1.1)
        agree = np.mean(neardup.weighted_samples(*a, 3000) == neardup.weighted_samples(*b, 3000))
        assert agree == pytest.approx(neardup.similarity(a, b), abs=0.04)


def test_block_links():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 62, 60).astype(np.uint64)
    texts = []
    for i in range(40):
        own = np.unique(np.concatenate([rng.choice(base, 52, replace=False), rng.integers(0, 1 << 62, 2).astype(np.uint64)]))
        times = rng.integers(1, 3, len(own)) if i % 4 == 0 else np.ones(len(own), np.int64)
        texts.append((i, own, times, times * np.where(own % 3 == 0, 2.0, 1.0)))
    found = neardup.block_links(texts[:15], texts, 0.8)
    pairs = [(i, j) for i in range(15) for j in range(40) if i != j and neardup.similarity(texts[i][1::2], texts[j][1::2]) >= 0.8]
    assert classes([(i, j) for i, j, _ in found], range(40)) == classes(pairs, range(40))
    for i, j, value in found:
        assert value == pytest.approx(neardup.similarity(texts[i][1::2], texts[j][1::2]))


def shingles(text):
    words = (text or "").split()
    n = min(5, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()


def edited(text, rng, changes):
    words = text.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = rng.choice("alpha beta gamma delta".split()) + str(rng.randrange(1000))
    return " ".join(words)


def near_rows(prose):
    rng = random.Random(4)
    rows, base = [], [prose(150, s) for s in range(12)]
    for text in base:
        rows += [text, text] + [edited(text, rng, rng.choice((1, 2, 3, 5, 12))) for _ in range(6)]
    # A large group of near copies, and a passage that many texts share.
    rows += [edited(base[0], rng, 2) for _ in range(60)]
    passage = prose(60, 99)
    rows += [prose(120, 500 + i) + " " + passage for i in range(60)]
    rows += [None, "", "", "one two", "one two", "one three", " \n "]
    return list(enumerate(rows))


@pytest.mark.parametrize(("stars", "block"), [(2, 1 << 19), (1, 1 << 19), (1, 3000), (4, 1)])
def test_near_duplicates_against_all_pairs(documents, prose, monkeypatch, stars, block):
    monkeypatch.setattr(neardup, "STARS", stars)
    monkeypatch.setattr(neardup, "BLOCK", block)
    rows = near_rows(prose)
    found, links = neardup.near_duplicates(documents(rows))
    got = {r.doc_id: r for r in found.collect()}
    sets = {i: shingles(t) for i, t in rows}
    text = {i: t or "" for i, t in rows}
    alike, apart = [], []
    for a, b in combinations(sets, 2):
        shared, both = len(sets[a] & sets[b]), len(sets[a] | sets[b])
        if text[a] == text[b] or both and shared / both >= 0.82:
            alike.append((a, b))
        elif not both or shared / both >= 0.78:
            apart.append((a, b))  # TF-IDF weights may put these on either side
    wanted = classes(alike, sets)
    assert all(got[a].class_id == got[b].class_id for a, b in alike)
    wide = classes(alike + apart, sets)
    assert all(wide[r.doc_id] == wide[r.class_id] for r in got.values())
    assert sum(r.kept for r in got.values()) == len({r.class_id for r in got.values()}) <= len(set(wanted.values()))
    assert all(r.similarity >= 0.8 for r in links.collect())


def test_document_frequencies_count_least_shingles():
    rng = np.random.default_rng(8)
    postings = [(rng.integers(0, 30, n).astype(np.uint64) << np.uint64(24)) | rng.integers(0, 5, n).astype(np.uint64) for n in (40, 1, 25)]
    found = neardup.document_frequencies(postings)
    every = set(np.concatenate(postings).tolist())
    for own, df in zip(postings, found):
        assert df.tolist() == [len({p for p in every if p >> 24 == int(x) >> 24}) for x in own]


def tfidf_sets(texts):
    """Weighted sets by definition: documents of the same least shingle count once in a frequency."""
    sets = [np.unique(shingle_hashes(word_hashes(np.frombuffer(t.encode(), np.uint8), Powers())), return_counts=True) for t in texts]
    holders = {}
    for own, _ in sets:
        for s in own.tolist():
            holders.setdefault(s, set()).add(int(own[0]))
    idf = {s: 1 + np.log((1 + len(texts)) / (1 + len(h))) for s, h in holders.items()}
    return [(own, times * np.array([idf[s] for s in own.tolist()])) for own, times in sets]


@pytest.mark.parametrize(("batch", "range_", "block"), [(1 << 21, 1 << 25, 1 << 19), (5000, 20000, 2000)])
def test_rare_words_decide(documents, prose, monkeypatch, batch, range_, block):
    """Texts that share a template and differ in rare words stay apart; texts that differ in common passages meet."""
    monkeypatch.setattr(neardup, "BATCH", batch)
    monkeypatch.setattr(neardup, "RANGE", range_)
    monkeypatch.setattr(neardup, "BLOCK", block)
    template, one, other = prose(90, 1), prose(30, 2), prose(30, 3)
    texts = [template + " " + prose(9, 100 + i) for i in range(60)]
    texts += [prose(120, 200 + i) + " " + (one if i % 2 else other) for i in range(160)]
    own = [prose(200, 400 + i) for i in range(10)]
    texts += [o + " " + end for o in own for end in (one, other)]
    texts += [prose(250, 500 + i) + " " + template for i in range(60)]
    sets = tfidf_sets(texts)
    near = [(a, b) for a, b in combinations(range(len(texts)), 2) if neardup.similarity(sets[a], sets[b]) >= 0.8]
    found, links = neardup.near_duplicates(documents(list(enumerate(texts))))
    got = {r.doc_id: r.class_id for r in found.collect()}
    assert got == classes(near, range(len(texts)))
    assert sorted(near) == [(i, i + 1) for i in range(220, 240, 2)]
    value = [r.similarity for r in links.collect()]
    assert sorted(value) == pytest.approx(sorted(neardup.similarity(sets[a], sets[b]) for a, b in near))
    plain = [shingles(t) for t in texts]
    assert all(len(plain[0] & p) / len(plain[0] | p) > 0.8 for p in plain[1:60])
    assert all(len(plain[a] & plain[b]) / len(plain[a] | plain[b]) < 0.8 for a, b in near)


def colliding(hashes, shift, wanted=lambda i: True):
    """Two places whose hashes agree in the bits that ``shift`` leaves."""
    seen = {}
    for i, key in enumerate(shift(hashes).tolist()):
        if wanted(i) and seen.setdefault(key, i) != i:
            return seen[key], i


def test_frequencies_tell_hashes_apart(documents, prose):
    """Least shingles that agree in their first 24 mixed bits, and shingles that agree in their last 40, are different."""
    shared = "five words that many share"
    own = [f"{shared} {i}" for i in range(40_000)]
    powers = Powers()
    both = [shingle_hashes(word_hashes(np.frombuffer(t.encode(), np.uint8), powers)) for t in own]
    a, b = colliding(np.array([h.min() for h in both]), lambda h: mixed(h) >> np.uint64(40), lambda i: both[i][1] < both[i][0])
    body = prose(30, 1)
    texts = [own[a], own[b], shared + " " + body, shared + " " + body + " more"]

    count = 6_000_000
    numbers = word_hashes(np.frombuffer(" ".join(map(str, range(count))).encode(), np.uint8), powers)
    low = shingle_hashes(numbers) & np.uint64((1 << 40) - 1)
    order = np.argsort(low)
    at = np.flatnonzero(np.diff(low[order]) == 0)[0]
    c, d = (" ".join(str(i + k) for k in range(5)) for i in order[at : at + 2].tolist())
    body = prose(30, 2)
    texts += [c + " " + body, c + " " + body + " more", d + " " + prose(30, 3)]

    sets = tfidf_sets(texts)
    found, links = neardup.near_duplicates(documents(list(enumerate(texts))))
    assert {r.doc_id: r.class_id for r in found.collect()} == {0: 0, 1: 1, 2: 2, 3: 2, 4: 4, 5: 4, 6: 6}
    wanted = sorted(neardup.similarity(sets[a], sets[a + 1]) for a in (2, 4))
    assert sorted(r.similarity for r in links.collect()) == pytest.approx(wanted, rel=1e-9)


@pytest.mark.parametrize(("batch", "piece"), [(1 << 21, 1 << 20), (3000, 100), (1, 1 << 20)])
def test_frequencies_by_definition(documents, prose, monkeypatch, batch, piece):
    """Whatever the batches, also where documents of one least shingle are more than one of them."""
    monkeypatch.setattr(neardup, "BATCH", batch)
    monkeypatch.setattr(neardup, "RANGE", 4 * batch + 5000)
    monkeypatch.setattr(neardup, "PIECE", piece)
    texts = [t or "" for _, t in near_rows(prose)]
    docs = documents(list(enumerate(texts))).selectExpr("doc_id", "md5(text) node", "text")
    made = neardup._signatures(docs, len(texts), sum(map(len, texts))).collect()
    sets = tfidf_sets(texts)
    assert sorted(r.doc_id for r in made) == list(range(len(texts)))
    for r in made:
        shingles, weights = sets[r.doc_id]
        own = neardup.shingle_hashes(word_hashes(np.frombuffer(texts[r.doc_id].encode(), np.uint8), Powers()))
        times = np.unique(own, return_counts=True)[1]
        assert times * neardup.idf(np.frombuffer(r.dfs, np.int32), len(texts)) == pytest.approx(weights)


def test_one_of_each_class_stays(documents, prose):
    text = prose(80)
    rows = [(7, text), (3, text), (None, text), (9, text + " more"), (3, text), (4, None), (5, None), (6, prose(80)), (6, prose(90))]
    docs = documents(rows)
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect() if r.text) == sorted([(3, text), (6, rows[7][1]), (6, rows[8][1])])
    assert [r.doc_id for r in kept.collect() if r.text is None] == [4]
    assert neardup.keep_one(docs.limit(0)).count() == 0
    assert {r.class_id for r in neardup.near_duplicates(documents([(None, "a b")]))[0].collect()} == {None}


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def mutated(line, rng, edits):
    out = list(line)
    for _ in range(edits):
        i, kind = rng.randint(0, len(out)), rng.randrange(3)
        if kind == 0 or i >= len(out):
            out.insert(i, rng.choice("abé😀 "))
        elif kind == 1:
            del out[i]
        else:
            out[i] = rng.choice("abé ")
    return "".join(out).replace("\n", "")


def test_edit_distance():
    rng = random.Random(5)
    for _ in range(3000):
        a = "".join(rng.choice("abé ") for _ in range(rng.randint(0, 30)))
        b = mutated(a, rng, rng.randint(0, 5))
        for most in range(4):
            assert linedup.edit_distance(a, b, most) == min(levenshtein(a, b), most + 1)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_every_near_line_meets(edits):
    rng, powers = random.Random(edits), Powers()
    met = 0
    for _ in range(3000):
        a = "".join(rng.choice("abé ") for _ in range(rng.randint(8, 50)))
        b = mutated(a, rng, rng.randint(1, edits + 1))
        if a == b or levenshtein(a, b) > linedup.edits_allowed(a, b, edits):
            continue
        a, b = sorted((a, b), key=len)
        nodes = linedup.nodes_of([a, b], powers)
        assert bin((int(nodes[0]) ^ int(nodes[1])) & linedup._MASK).count("1") <= 2 * edits
        own, _ = linedup.join_keys([a], nodes[:1], False, edits, powers)
        met += 1
        assert set(own.tolist()) & set(linedup.join_keys([b], nodes[1:], True, edits, powers)[0].tolist())
    assert met > 500


@pytest.mark.parametrize("broadcast", [1_000_000, 0])
def test_near_lines_against_all_pairs(documents, prose, monkeypatch, broadcast):
    monkeypatch.setattr(linedup, "BROADCAST_LINES", broadcast)
    rng = random.Random(6)
    base = [prose(rng.randint(1, 14), s) for s in range(25)]
    texts = []
    for _ in range(60):
        lines = [mutated(rng.choice(base), rng, rng.choice((0, 0, 1, 2, 4))) for _ in range(rng.randint(0, 6))]
        texts.append("\n".join(lines))
    # Lines that differ in a number: all of them share their segments.
    texts += ["\n".join(f"page {i} of the catalogue of all the things that there are" for i in range(k, 400, 4)) for k in range(4)]
    rows = list(enumerate([*texts, None, "", "\n \n", texts[0], "a\nb"])) + [(0, texts[0])]
    found, links = linedup.near_duplicate_lines(documents(rows))
    places = [(i, n, line) for i, t in set(rows) for n, line in enumerate((t or "").split("\n")) if line.strip(" \t\n\x0b\x0c\r")]
    different = sorted({line for *_, line in places})
    pairs = [(a, b) for a, b in combinations(different, 2) if abs(len(a) - len(b)) <= 2 and levenshtein(a, b) <= linedup.edits_allowed(a, b, 2)]
    assert links.count() == len(pairs)
    root = classes(pairs, different)
    first, degree = {}, dict.fromkeys(different, 0)
    for i, n, line in sorted(places):
        first.setdefault(root[line], (i, n))
    for a, b in pairs:
        degree[a] += 1
        degree[b] += 1
    got = {(r.doc_id, r.line_no): ((r.first_doc, r.first_line), r.n_links, r.kept) for r in found.collect()}
    assert got == {(i, n): (first[root[line]], degree[line], first[root[line]] == (i, n)) for i, n, line in places}


def test_repeated_lines_go(documents, prose):
    shared, own = prose(20), [prose(40, s) for s in range(4)]
    rows = [(2, own[0] + "\n" + shared), (1, shared + "\n" + own[1]), (3, shared[:-1] + "\nshort one.\n" + own[2]), (4, own[0] + "\n" + own[0]), (5, own[0]), (6, None), (7, "")]
    docs = documents([*rows, rows[0]])
    out = linedup.drop_repeated_lines(docs)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    got = sorted((r.doc_id, r.text, r.n_chars) for r in out.collect())
    wanted = [(1, rows[1][1]), (2, own[0]), (2, own[0]), (3, "short one.\n" + own[2]), (6, None), (7, "")]
    assert [g[:2] for g in got] == wanted
    assert all(n == len(t or "") for _, t, n in got)
    assert linedup.drop_repeated_lines(docs.limit(0)).count() == 0
    assert linedup.drop_repeated_lines(docs.drop("n_chars")).count() == 6


def test_null_ids_come_last(documents):
    line = "the same line stands in all of these documents"
    found, _ = linedup.near_duplicate_lines(documents([(None, line), (4, line)]))
    assert {(r.doc_id, r.kept) for r in found.collect()} == {(None, False), (4, True)}
    assert found.filter(F.col("first_doc") == 4).count() == 2
