from collections import Counter

import corpus_pipeline
import pytest

from sensorloom.llm import mixing, quality


def brute(text):
    text = text or ""
    spaces = " \t\n\x0b\x0c\r"
    words, word = [], ""
    for c in text + " ":
        if c in spaces:
            words += [word] if word else []
            word = ""
        else:
            word += c
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if line.strip(spaces)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


CASES = [
    None, "", "  \n\t ", "one", "a b c a b c a b c", "a a a a", "x\x1cy\x85z\xa0w", "l\nl\nl \n\nl", "é# 😀* <b>|&", "a b c d a b c " * 40,
    "w " * 30000, "\n" * 5000, "a b\na b\nc",
]


def test_counts(documents):
    rows = quality.quality(documents(list(enumerate(CASES)))).collect()
    assert len(rows) == len(CASES)
    for row in rows:
        counts = brute(CASES[row.doc_id])
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == counts
        assert row.base_failed == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert not (row.kept and row.base_failed)


@pytest.mark.parametrize(
    ("line", "fails"),
    [
        ("A plain sentence that ends as it should.", False), ("word*** word### word&&& word", True), ("Home | News | Sport | Contact", True),
        ("It costs $5 & more, e.g. 50% off.", False), ("All rights reserved.", True), ("Wow!! Is that so?! Yes it is, said the man to them", False),
        ("and so all rights reserved by " + "the owners " * 20, False), ("-", False), ("a - b", False),
    ],
)
def test_line_rules(line, fails):
    assert quality.line_fails(line, len(line.split())) == fails


def test_lines_lost(documents, prose):
    good, junk = prose(60), " ".join(f"{w}***" for w in prose(200).split())
    docs = documents([(1, good), (2, junk), (3, good + "\n" + junk), (4, junk[:100] + "\n" + good + "\nAll rights reserved."), (5, None), (1, good)])
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 1, 4]
    assert {r.text for r in kept.filter("doc_id = 1").collect()} == {good}
    assert quality.keep_good(docs.limit(0)).count() == 0
    failed = {r.doc_id: r.failed_lines for r in quality.quality(docs).collect()}
    assert failed[4] == [0, 2] and failed[1] == []


def test_failed_lines_go(documents, prose):
    good, more = prose(60, 1), prose(30, 2)
    menu, legal = "Home | News | Sport | Contact", "All rights reserved."
    docs = documents([(1, f"{menu}\n{good}\n\n{legal}\n{more}\n{legal}"), (2, f"{good}\n\n{more}\n"), (3, f"{menu}\n" * 30 + good)])
    kept = quality.keep_good(docs)
    assert kept.dtypes == docs.dtypes
    rows = {r.doc_id: r for r in kept.collect()}
    assert {i: r.text for i, r in rows.items()} == {1: f"{good}\n\n{more}", 2: f"{good}\n\n{more}\n"}
    assert all(r.n_chars == len(r.text) and r._kept == "x15" for r in rows.values())
    assert quality.keep_good(docs.drop("n_chars")).count() == 2


def targets(sizes, weights=(5, 2, 1), most=3):
    """Reshare by hand until no source is above its limit."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped = set()
    while True:
        left = sum(sizes.values()) - sum(most * sizes[s] for s in capped)
        open_ = [s for s in names if s not in capped]
        share = {s: weight[s] * left / sum(weight[t] for t in open_) for s in open_}
        above = {s for s in open_ if share[s] > most * sizes[s]}
        if not above:
            return share | {s: float(most * sizes[s]) for s in capped}
        capped |= above


def test_mix(documents, prose):
    rows = [(i, prose(5 + i % 40), ["a", "b", "é", None, "tiny", "Z"][min(i % 9, 5)]) for i in range(400)]
    rows += [(1000, "one word", "tiny2"), (1001, None, "a"), (1002, "", None), (1003, "x y", "empty"), (None, "no id here", "b")]
    rows += [rows[5]] * 3 + [(2000 + i, " \t", "blank") for i in range(3)]
    docs = documents(rows)
    out = mixing.mix_sources(docs).collect()
    assert len(out) == len(rows)
    assert sorted(map(repr, out)) == sorted(map(repr, mixing.mix_sources(docs.repartition(7), rows_per_bucket=1).collect()))
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    wanted = targets({s: sizes[s] for s in {r[2] for r in rows}})
    taken = Counter()
    for r in out:
        taken[r.source] += r.taken
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(wanted[r.source])
        assert 0 <= r.taken <= 3 * r["size"]
    for s, target in wanted.items():
        assert abs(taken[s] - target) <= 0.5 + 1e-6
    assert sum(wanted.values()) == pytest.approx(sum(sizes.values()))
    # Whole epochs first: within a source only one document is taken in part.
    for s in wanted:
        own = [(r.taken, r["size"]) for r in out if r.source == s and r["size"]]
        assert sum(t % n != 0 for t, n in own) <= 1
    assert mixing.mix_sources(docs.limit(0)).count() == 0


def test_mix_of_empty_texts(documents):
    out = mixing.mix_sources(documents([(1, None, None), (2, "", "a")])).collect()
    assert [(r["size"], r.target, r.taken) for r in out] == [(0, 0.0, 0)] * 2


def test_stage_names():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "near dedup", "decontamination", "mixing"]
