"""How far each source's use of words departs from the other sources of its language, by count cells.

A term's share in a group follows from two numbers only: how often it stands in the group, and how
often in the whole language. So terms are gathered in cells of (group count, language count), the
measure is evaluated once per cell, and cells are ranked by how many terms stand before them; only
the cells that reach the report are expanded into terms. Counts of a document's words are added up
where the document lies; one shuffle by term then has all counts of a term together.

The measure between two sources is summed over all kept terms of the language. Terms in neither
source, and terms in only one, are cells of (count, 0), whose sizes follow from each source's own
histogram of counts; only terms that both sources hold are visited, and add to one sum per pair of
sources before anything is shuffled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from sensorloom.operators.ordering import spread_join
from sensorloom.session import written

LEAST_DOCUMENTS = 3
TERMS_RANKED = 200
UNIT = 1_000_000_000
#: Distinct (group, term) counts that a task holds before it passes them on.
MOST_HELD = 200_000
#: ASCII letters in lower case and all bytes of longer code points stand; everything else parts terms.
_LETTERS = bytes(b if b >= 0x80 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text: runs of letters, only A-Z lower-cased."""
    # Bytes above 0x7F are no white space to ``split`` without a locale, so code points stay whole.
    return text.translate(_LETTERS).split()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts per (lang, source, term) of this task's documents; each group also comes with a null term."""
    held: dict[tuple, tuple[Counter, Counter]] = {}

    def passed_on() -> Iterator[pa.RecordBatch]:
        for (lang, source), (times, docs) in held.items():
            terms = [None, *times]
            columns = [pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string())]
            columns.append(pa.array(terms, pa.binary()).cast(pa.string()))
            columns += [pa.array([0, *times.values()], pa.int64()), pa.array([0, *map(docs.__getitem__, times)], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "times", "docs"])
        held.clear()

    entries = 0
    for batch in batches:
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            times, docs = held.setdefault((lang, source), (Counter(), Counter()))
            terms = terms_of(text.as_py())
            entries -= len(times)
            times.update(terms)
            docs.update(set(terms))
            entries += len(times)
            if entries > MOST_HELD:
                yield from passed_on()
                entries = 0
    yield from passed_on()


def kept_terms(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """A stored row per kept ``term`` of a ``lang``: its count ``total``, and ``groups`` of (source, times), by source.

    Each lang also has a row with a null term, whose ``groups`` are all its sources.
    """
    text = [F.coalesce(F.col(c), F.lit("")) for c in ("lang", "source", "text")]
    rows = docs.select(*text[:2], text[2].cast("binary"))
    counts = rows.mapInArrow(_counted, "lang string, source string, term string, times bigint, docs bigint")
    # Dealt by (lang, term) once: a term's counts per source and its total then need no further shuffle.
    by_source = counts.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("times").alias("times"), F.sum("docs").alias("docs"))
    terms = by_source.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("times").alias("total"), F.array_sort(F.collect_list(F.struct("source", "times"))).alias("groups")
    )
    return written(terms.filter(F.col("term").isNull() | (F.col("docs") >= least_documents)).drop("docs"), "kept-terms")


def _share(times: Column, size: Column) -> Column:
    """``1 + floor(10^9 (times + 1) / size)``, exactly; the product of a larger count does not fit a long."""
    fits = times < F.lit((1 << 63) // UNIT - 2)
    short = F.call_function("div", F.when(fits, (times + 1) * F.lit(UNIT)).otherwise(F.lit(0)), size)
    wide = F.call_function("div", (times + 1).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)"), size.cast("decimal(20,0)"))
    return 1 + F.when(fits, short).otherwise(wide.cast("bigint"))


def _gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _sizes(terms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored: ``size`` (N + V, 1 at least) and ``kept`` (V) per (lang, source), sources without terms included, and per lang."""
    langs = written(terms.groupBy("lang").agg(F.count("term").alias("kept"), F.sum("total").alias("_all")), "langs")
    entry = F.explode("groups").alias("g")
    groups = terms.select("lang", entry).groupBy("lang", F.col("g.source").alias("source")).agg(F.sum("g.times").alias("_n"))
    groups = spread_join(groups, langs.withColumnRenamed("lang", "_lang"), F.col("lang") == F.col("_lang"), "inner", ["source"])
    size = F.greatest(F.col("_n") + F.col("kept"), F.lit(1))
    groups = written(groups.select("lang", "source", size.alias("size"), "kept"), "groups")
    return groups, langs.select("lang", F.greatest(F.col("_all") + F.col("kept"), F.lit(1)).alias("size"), "kept")


def _with_size(rows: DataFrame, groups: DataFrame, source: str, name: str) -> DataFrame:
    """``rows`` with the size of the group (lang, ``source``) as ``name``; a busy group's rows are spread."""
    known = groups.select(F.col("lang").alias("_lang"), F.col("source").alias("_group"), F.col("size").alias(name))
    on = (F.col("lang") == F.col("_lang")) & (F.col(source) == F.col("_group"))
    return spread_join(rows, known, on, "inner", rows.columns).drop("_lang", "_group")


def source_gaps(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """Per ordered pair ``source``, ``item`` of a lang's sources the measure summed over all kept terms as ``value``."""
    none = F.lit(0).cast("bigint")

    def both_ways(rows: DataFrame, value) -> DataFrame:
        """Rows of (lang, a, b, ...) give their share to the pair (a, b) and to (b, a), added up before they are dealt."""
        sums = rows.groupBy("lang", "a", "b").agg(F.sum(value("a", "b")).alias("_ab"), F.sum(value("b", "a")).alias("_ba"))
        ends = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item"), F.col("_ab").alias("value")),
                                 F.struct(F.col("b").alias("source"), F.col("a").alias("item"), F.col("_ba").alias("value")))).alias("e")
        return sums.select("lang", ends).select("lang", "e.*")

    def none_of(side: str) -> Column:
        return F.col(f"{side}_none")

    # Terms in both sources: what they add beyond the cells in which one or both counts are 0.
    first = terms.filter("term is not null").select("lang", F.posexplode("groups").alias("at", "x"), "groups")
    first = first.select("lang", F.col("x.source").alias("a"), F.col("x.times").alias("_a"), F.slice("groups", F.col("at") + 2, F.size("groups")).alias("_rest"))
    first = _with_size(first.filter(F.size("_rest") > 0), groups, "a", "a_size")
    first = first.withColumn("a_p", _share(F.col("_a"), F.col("a_size"))).withColumn("a_none", _share(none, F.col("a_size")))
    met = first.select("lang", "a", "a_p", "a_none", F.explode("_rest").alias("y"))
    met = _with_size(met.select("lang", "a", "a_p", "a_none", F.col("y.source").alias("b"), F.col("y.times").alias("_b")), groups, "b", "b_size")
    met = met.withColumn("b_p", _share(F.col("_b"), F.col("b_size"))).withColumn("b_none", _share(none, F.col("b_size")))

    def together(s: str, t: str) -> Column:
        p, q = F.col(f"{s}_p"), F.col(f"{t}_p")
        return _gap(p, q) - _gap(p, none_of(t)) - _gap(none_of(s), q) + _gap(none_of(s), none_of(t))

    # Cells of (count, 0): one row per distinct count of a source and other source of the lang.
    cells = terms.filter("term is not null").select("lang", F.explode("groups").alias("g"))
    cells = cells.groupBy("lang", F.col("g.source").alias("a"), F.col("g.times").alias("_a")).agg(F.count("*").alias("terms"))
    cells = _with_size(written(cells, "count-cells"), groups, "a", "a_size")
    others = groups.select(F.col("lang").alias("_lang"), F.col("source").alias("b"), F.col("size").alias("b_size"))
    alone = cells.withColumn("a_p", _share(F.col("_a"), F.col("a_size"))).withColumn("a_none", _share(none, F.col("a_size")))
    same_lang = F.col("lang") == F.col("_lang")
    alone = spread_join(alone, others, same_lang & (F.col("a") != F.col("b")), "inner", ["a", "_a"]).withColumn("b_none", _share(none, F.col("b_size")))

    def with_none(s: str, t: str) -> Column:
        held = F.col("a_p")
        more = _gap(held, none_of("b")) if s == "a" else _gap(none_of("b"), held)
        return F.col("terms") * (more - _gap(none_of(s), none_of(t)))

    # Every ordered pair, as if no term stood in either source.
    pairs = spread_join(groups, others, same_lang & (F.col("source") != F.col("b")), "inner", ["source"])
    base = F.col("kept") * _gap(_share(none, F.col("size")), _share(none, F.col("b_size")))
    every = pairs.select("lang", "source", F.col("b").alias("item"), base.alias("value"))
    parts = every.unionByName(both_ways(met, together)).unionByName(both_ways(alone, with_none))
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def distinctive_terms(terms: DataFrame, groups: DataFrame, langs: DataFrame, most: int = TERMS_RANKED) -> DataFrame:
    """Per (lang, ``source``) the first ``most`` terms that it uses more than its lang, by the measure: ``item``, ``value``, ``rank``."""
    entries = terms.filter("term is not null").select("lang", "term", "total", F.explode("groups").alias("g"))
    entries = entries.select("lang", F.col("g.source").alias("source"), "term", F.col("g.times").alias("times"), "total")
    cells = written(entries.groupBy("lang", "source", "times", "total").agg(F.count("*").alias("terms")), "term-cells")
    valued = _with_size(cells, groups, "source", "_size")
    known = langs.select(F.col("lang").alias("_lang"), F.col("size").alias("_whole"))
    valued = spread_join(valued, known, F.col("lang") == F.col("_lang"), "inner", cells.columns).drop("_lang")
    p, q = _share(F.col("times"), F.col("_size")), _share(F.col("total"), F.col("_whole"))
    valued = valued.withColumn("_p", p).withColumn("_q", q).filter("_p > _q").withColumn("value", _gap(F.col("_p"), F.col("_q")))
    valued = written(valued.select("lang", "source", "times", "total", "terms", "value"), "cell-values")

    # A value holds a term at least, so the first ``most`` values hold the first ``most`` terms.
    falling = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    values = valued.groupBy("lang", "source", "value").agg(F.sum("terms").alias("terms"))
    values = values.withColumn("_place", F.row_number().over(falling)).filter(F.col("_place") <= most)
    before = F.coalesce(F.sum("terms").over(falling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    values = values.withColumn("_before", before).filter(F.col("_before") < most).select("lang", "source", "value")
    reached = written(valued.join(values, ["lang", "source", "value"]).select(
        *[F.col(c).alias(f"_{c}") for c in ("lang", "source", "times", "total")], "value"), "cells-reached")
    same = F.lit(True)
    for c in ("lang", "source", "times", "total"):
        same = same & (F.col(c) == F.col(f"_{c}"))
    named = spread_join(entries, reached, same, "inner", ["term"])
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term")
    ranked = named.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
    return ranked.select("lang", "source", F.col("term").alias("item"), "value", "rank")


def source_divergence(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, most_terms: int = TERMS_RANKED) -> DataFrame:
    """``lang``, ``source``, ``part`` (``pair`` or ``term``), ``item``, ``value`` and ``rank`` from 1.

    A lang keeps the terms in at least ``least_documents`` of its documents; with N the count of kept
    terms in a group (or lang) and V their number, a term that stands there ``count`` times has
    ``p = 1 + floor(10^9 (count + 1) / (N + V))``, and the measure of p against q is
    ``floor((p - q)^2 / q)``. ``pair`` ranks the lang's other sources by the sum over all kept terms, q
    being theirs; ``term`` ranks the kept terms that the source holds with p above the lang's q, up
    to ``most_terms``. Equal values come by the UTF-8 order of the item.

    A null text, lang or source counts as empty. A row is a document, so repeated rows count each. Texts
    without terms still make their group known. A lang that keeps no term gives pairs of value 0.
    Very long texts and terms are taken whole; a task holds one text's terms at a time beside its
    counts. An empty table gives no rows, and other columns are ignored.
    """
    terms = kept_terms(docs, least_documents)
    groups, langs = _sizes(terms)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = source_gaps(terms, groups).withColumn("rank", F.row_number().over(order))
    both = pairs.withColumn("part", F.lit("pair")).unionByName(
        distinctive_terms(terms, groups, langs, most_terms).withColumn("part", F.lit("term")))
    return both.select("lang", "source", "part", "item", "value", "rank")
