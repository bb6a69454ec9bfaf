import random
import re

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from sensorloom.llm import decontam, neardup


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def weighted(tokens):
    return {tuple(tokens[i : i + 5]): sum(map(len, tokens[i : i + 5])) for i in range(len(tokens) - 4)}


def similarity(a, b):
    a, b = weighted(a), weighted(b)
    shared = sum(a[s] for s in a.keys() & b.keys())
    return shared / (sum(a.values()) + sum(b.values()) - shared) if a and b else 0.0


def best_window(text, item):
    text, item = words(text), words(item)
    n = len(item)
    return max((similarity(text[i : i + n], item) for i in range(max(1, len(text) - n + 1))), default=0.0)


def fixture(prose):
    rng = random.Random(3)
    items = [(i, prose(rng.randint(12, 60), 1000 + i)) for i in range(20)] + [(90, "too short now"), (91, None), (92, "")]
    rows = []
    for i in range(150):
        own, item = prose(rng.randint(5, 150), i), items[i % 20][1].split()
        if i % 3:
            for _ in range(rng.choice((0, 0, 1, 2, 4))):
                at = rng.randrange(len(item))
                item[at : at + rng.randint(0, 1)] = rng.choice(([], ["other"], ["two", "more"]))
            cut = rng.randrange(len(own))
            own = f"{own[:cut]} {' '.join(item).upper() if i % 5 == 0 else ' '.join(item)}\n{own[cut:]}"
        rows.append((i, own))
    rows += [(500, items[3][1]), (501, " ".join(items[3][1].split()[1:])), (502, None), (503, ""), (504, "a b"), (None, items[4][1]), (500, items[5][1])]
    return rows, items


def benchmark_table(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string").select("*", *[F.lit("x").alias(c) for c in ("doc_id", "words", "n", "print", "h", "j")])


@pytest.mark.parametrize("broadcast", [500_000, 0])
def test_windows_against_all_windows(spark, documents, prose, monkeypatch, broadcast):
    monkeypatch.setattr(decontam, "BROADCAST_SHINGLES", broadcast)
    monkeypatch.setattr(decontam, "BROADCAST_DOCS", broadcast)
    rows, items = fixture(prose)
    out = decontam.contaminated(documents([*rows, rows[0]]), benchmark_table(spark, items))
    got = {}
    for r in out.collect():
        got.setdefault((r.doc_id, r.item_id), []).append(r.similarity)
    wanted = {}
    for doc_id, text in rows:
        for item_id, item in items:
            best = best_window(text, item)
            if best >= 0.8:
                wanted.setdefault((doc_id, item_id), []).append(best)
    assert len(wanted) > 40
    assert got.keys() == wanted.keys()
    for key, values in wanted.items():
        assert sorted(got[key]) == pytest.approx(sorted(values))


def test_windows_meet_only_the_items_that_led_to_them(spark, documents, prose, monkeypatch):
    """Forty items of one length: a window is compared with one of them, not with all."""
    items = [(i, prose(30, 5000 + i)) for i in range(40)] + [(100 + i, prose(6 + i, 6000 + i)) for i in range(7)]
    rows = [(i, f"{prose(20, i)} {item} {prose(20, 500 + i)}") for i, (_, item) in enumerate(items)]
    joins, join = [], decontam.spread_join
    monkeypatch.setattr(decontam, "spread_join", lambda *args: joins.append(join(*args)) or joins[-1])
    found = decontam.contaminated(documents(rows), benchmark_table(spark, items)).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(i, item_id) for i, (item_id, _) in enumerate(items)}
    assert all(r.similarity == pytest.approx(1.0) for r in found)
    met = joins[0].select("key", "variant").distinct().groupBy("key").count()
    assert met.agg(F.max("count")).first()[0] == 1 and met.count() < 20 * len(items)


def test_very_long_texts_and_many_copies_of_a_window(spark, documents, prose):
    item = prose(25, 1)
    long = f"{prose(4000, 2)} {item} {prose(4000, 3)}"
    rows = [(1, long), (2, " ".join([item] * 40)), (3, prose(4000, 4)), *[(10 + i, item) for i in range(30)]]
    found = decontam.contaminated(documents(rows), benchmark_table(spark, [(7, item)])).collect()
    assert {r.doc_id for r in found} == {1, 2, *range(10, 40)} and all(r.similarity == pytest.approx(1.0) for r in found)
    assert {r.doc_id: r.start for r in found}[1] == 4000 and {r.doc_id: r.start for r in found}[2] == 0


def test_blocks_meet_within_the_radius(spark):
    rng = random.Random(1)
    rows = []
    for _ in range(500):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(0, 19)):
            b ^= 1 << bit
        rows.append(tuple(x - (1 << 64) if x >= 1 << 63 else x for x in (a, b)))
    df = spark.createDataFrame(rows, "a bigint, b bigint")
    met = df.select(F.arrays_overlap(decontam.blocks(F.col("a")), decontam.blocks(F.col("b"))).alias("met"))
    assert met.filter("met").count() == 500


def test_empty_tables(spark, documents, prose):
    docs, items = documents([(1, prose(30)), (2, None)]), benchmark_table(spark, [(1, prose(20))])
    assert decontam.contaminated(docs.limit(0), items).count() == 0
    assert decontam.contaminated(docs, items.limit(0)).count() == 0
    assert decontam.drop_contaminated(docs, items.limit(0)).count() == 2


@pytest.fixture
def corpus(spark, documents, prose, tmp_path):
    rng = random.Random(11)
    clean = {i: "\n".join(prose(rng.randint(30, 50), 100 * i + k) for k in range(3)) for i in range(1, 40)}
    item = prose(30, 77)
    rows = [(i, t, rng.choice(["web", "book", None])) for i, t in clean.items()]
    rows += [(100 + i, clean[i], "web") for i in range(1, 6)]  # copies
    near = [" ".join(w if k % 70 else "changed" for k, w in enumerate(clean[i].replace("\n", " ").split())) for i in range(10, 14)]
    rows += [(200 + i, clean[10 + i].replace("\n", " "), "web") for i in range(4)] + [(210 + i, t, "book") for i, t in enumerate(near)]
    rows += [(300, clean[1] + "\n" + prose(40, 5) + " " + item + " " + prose(40, 6), "web")]  # a leak
    rows += [(301, prose(60, 8).replace(" ", "*** "), "web"), (302, None, None), (303, "", "web"), (304, "Home | News | Sport | Contact\n" * 30, "web")]
    sf_dir = str(tmp_path)
    documents(rows, clashing=False).write.parquet(f"{sf_dir}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id bigint, text string").write.parquet(f"{sf_dir}/benchmark.parquet")
    return sf_dir, {r[0]: r[1] for r in rows}


def test_pipeline(spark, corpus):
    sf_dir, texts = corpus
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, sf_dir)
        assert after.columns == docs.columns and after.dtypes == docs.dtypes
        path = f"{sf_dir}/stage-{len(kept)}"
        after.write.parquet(path)
        docs = spark.read.parquet(path)
        kept.append({r.doc_id: r.text for r in docs.collect()})
    clean = set(range(1, 40))
    assert kept[0].keys() == texts.keys() - {301, 302, 303, 304}
    # Exact copies have no line of their own; the other documents keep theirs.
    assert kept[1].keys() == kept[0].keys() - {101, 102, 103, 104, 105}
    assert all(kept[1][i] == texts[i] for i in clean) and texts[1].split("\n")[0] not in kept[1][300]
    assert clean - set(range(10, 14)) <= kept[2].keys() and len(kept[2].keys() & {10, 200, 210}) == 1
    assert kept[3].keys() == kept[2].keys() - {300}
    result = corpus_pipeline.run(spark, sf_dir)
    assert {r.doc_id for r in result.collect()} <= kept[3].keys()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert sorted(map(repr, result.collect())) == sorted(map(repr, last.collect()))


def test_near_stage_against_brute_force(spark, corpus):
    """What line dedup leaves has no two texts of similarity 0.8 after the near-duplicate stage."""
    sf_dir, _ = corpus
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = [words(r.text) for r in neardup.keep_one(docs).collect()]
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in kept]
    for i, a in enumerate(sets):
        for b in sets[:i]:
            assert len(a & b) < 0.82 * len(a | b) or not a | b


def test_stages_on_an_empty_table(spark, corpus):
    sf_dir, _ = corpus
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0


def test_near_dedup_keeps_texts_of_one_template(documents, prose):
    """A template of many other documents weighs little, so its texts stay; a near copy without one goes."""
    template = prose(90, 1)
    texts = [template + " " + prose(9, 100 + i) for i in range(12)]
    texts += [prose(250, 500 + i) + " " + template for i in range(60)]
    own = prose(200, 900)
    texts += [own, own + " more"]
    texts += [prose(40, 1000 + i) for i in range(180)]  # the template stands in less than a third
    kept = {r.doc_id for r in corpus_pipeline.near_dedup(None, documents(list(enumerate(texts))), "").collect()}
    assert kept == set(range(len(texts))) - {73}
