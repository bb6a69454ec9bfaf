"""Personal data, and the terms around it that give it away.

Protected entities are e-mail addresses, internet addresses, card and telephone numbers. A term of a
line that holds an entity, or of the line above or below, discloses it as far as their pointwise mutual
information, over the different lines of the corpus, reaches the entity's own information content. How
often the term stands there is taken at the lower end of what so few lines allow. Terms that disclose
most of it are generalised to what kind of word they are, those that disclose nearly all of it are removed.

All of it is DataFrame expressions. Places of matches come from splitting a text at a pattern: the
lengths of what lies between and of the matches add up to where each match begins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sensorloom.llm.common import WORD, whole
from sensorloom.operators.ordering import fits_broadcast
from sensorloom.session import written

# The kinds in the order in which they are listed, their patterns, and what a text needs to hold any.
# Quantifiers that never need to give back are possessive, so no text makes them slow or deep.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
HINTS = {"email": r"@[A-Za-z0-9-]", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){15}", "phone": r"\+[0-9]"}
KINDS = (*PATTERNS, "term")
TERM = r"\p{L}[\p{L}\p{N}_'-]{2,}+"
BYTE = r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})$"
#: A term's share of an entity's lines counts as its lower bound at so many standard errors (95 % on one side).
ERRORS = 1.645
#: Shares of an entity's information from which a term that discloses it is generalised, and removed.
GENERALISE, REMOVE = 0.8, 0.95
#: Terms up to which they are broadcast to be counted; beyond it they are joined by shuffle.
BROADCAST_TERMS = 300_000
_ROW = ["_id", "hash"]


def _same(left: str, right: str) -> Column:
    return F.col(f"{left}._id").eqNullSafe(F.col(f"{right}._id")) & (F.col(f"{left}.hash") == F.col(f"{right}.hash"))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        twice = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return total + F.when(i % 2 == 0, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str) -> Column:
    value, n = F.col("value"), F.length(_digits(F.col("value")))
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda part: part.rlike(BYTE))
    if kind == "card":
        return n.between(16, 19) & F.when(n.between(16, 19), _luhn(_digits(value))).otherwise(False)
    if kind == "phone":
        return n.between(8, 15)
    return F.lit(True)


def located(rows: DataFrame, by: list[str], text: str, pattern: str) -> DataFrame:
    """A row per match of ``pattern`` in ``text`` with its ``value``, ``start`` and ``end``, and the columns ``by``.

    ``by`` must name each row. The matches of one text are the rows of one window; a text is never paired with another.
    """
    between, matches = F.split(text, pattern, -1), F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
    parts = F.arrays_zip(F.transform(between, F.length).alias("gap"), matches.alias("value"))
    spread = rows.select(*by, F.posexplode(parts).alias("_n", "_part"))
    spread = spread.select(*by, "_n", F.col("_part.gap").alias("_gap"), F.col("_part.value").alias("value")).filter(F.col("value").isNotNull())
    upto = Window.partitionBy(*by).orderBy("_n").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("_gap") + F.length("value")).over(upto)
    return spread.select(*by, "value", end.cast("int").alias("end")).select(*by, "value", (F.col("end") - F.length("value")).alias("start"), "end")


def find_entities(holders: DataFrame) -> DataFrame:
    """The base spans (``_id``, ``hash``, ``kind``, ``start``, ``end``, ``value``) of texts that each stand once in ``holders``."""
    found = None
    for kind, pattern in PATTERNS.items():
        own = located(holders.filter(F.col("text").rlike(HINTS[kind])), _ROW, "text", pattern).filter(_valid(kind))
        own = own.select(*_ROW, F.lit(kind).alias("kind"), "start", "end", "value")
        found = own if found is None else found.unionAll(own)
    return found


def _terms(line: Column) -> Column:
    """The different terms of a line without its entities, in lower case."""
    bare = line
    for pattern in PATTERNS.values():
        bare = F.regexp_replace(bare, pattern, " ")
    return F.array_distinct(F.regexp_extract_all(F.lower(bare), F.lit(TERM), F.lit(0)))


def lower_share(k: Column, n: Column, errors: float = ERRORS) -> Column:
    """The lower bound of a share seen ``k`` times in ``n`` (Wilson's score interval); 0.27 for one in one."""
    p, z = k / n, F.lit(errors)
    return (p + z * z / (2 * n) - z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def disclosing_terms(docs: DataFrame, lines: DataFrame, share: float = GENERALISE) -> DataFrame:
    """``entity``, ``place``, ``term`` with ``disclosed``, the share of the entity's information that the term gives away.

    ``lines`` has ``entity``, ``place``, ``line``: the lines with an entity (0), above (-1) and below them (1).
    Probabilities are shares of all different lines with a word, so that a passage counts once however
    often it is copied. The term's share of the lines at a place is its ``lower_share``.
    """
    held = lines.select("entity", "place", "line").distinct()
    by_entity = held.groupBy("entity", "place").agg(F.count("*").alias("n_entity"))
    joint = held.select("entity", "place", F.explode(_terms(F.col("line"))).alias("term")).groupBy("entity", "place", "term")
    joint = joint.agg(F.count("*").alias("n_both")).join(by_entity, ["entity", "place"])

    # Every different line, by its different words.
    split = docs.select(F.explode(F.split(whole(), "\n")).alias("line")).filter(F.col("line").rlike(WORD))
    n_all = split.select(F.xxhash64("line").alias("hash")).distinct().count()
    information = F.log(n_all / F.col("n_entity"))

    def disclosed(n_term: Column) -> Column:
        mutual = F.log(n_all * lower_share(F.col("n_both"), F.col("n_entity")) / n_term)
        return F.when(information > 0, F.least(mutual / information, F.lit(1.0))).otherwise(0.0)

    # A term stands on as many lines at least as beside the entity.
    joint = written(joint.filter(disclosed(F.col("n_both")) >= share), "joint")
    wanted = written(joint.select("term").distinct(), "terms")
    words = split.distinct().select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("line"), F.lit(TERM), F.lit(0)))).alias("term"))
    if wanted.count() <= BROADCAST_TERMS and fits_broadcast(wanted):
        by_term = words.join(F.broadcast(wanted), "term").groupBy("term").agg(F.count("*").alias("n_term"))
    else:  # counted in each task first, so that few rows of a frequent word are joined
        by_term = words.groupBy("term").agg(F.count("*").alias("n_term")).join(wanted, "term")
    scored = joint.join(by_term, "term", "left").withColumn("n_term", F.greatest("n_both", F.coalesce("n_term", F.lit(0))))
    return scored.select("entity", "place", "term", disclosed(F.col("n_term")).alias("disclosed")).filter(F.col("disclosed") >= share)


def find_personal(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(every document's ``_id`` and ``hash``, the spans of those that have any).

    ``_id`` is ``doc_id``. The spans are ``_id``, ``hash``, ``kind``, ``start``, ``end``, ``disclosed``:
    the base spans, and the terms that disclose an entity of their line or the lines beside it, where no base span is.
    """
    keyed = docs.select(F.col("doc_id").alias("_id"), F.xxhash64(whole()).alias("hash"), whole().alias("text"))
    some = None
    for hint in HINTS.values():
        some = F.col("text").rlike(hint) if some is None else some | F.col("text").rlike(hint)
    holders = written(keyed.filter(some).dropDuplicates(_ROW), "holders")
    base = written(find_entities(holders), "entities")

    held = holders.join(base.select(*_ROW).distinct().alias("b"), (F.col("b._id").eqNullSafe(holders["_id"])) & (F.col("b.hash") == holders["hash"]), "left_semi")
    lines = held.select(*_ROW, F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    upto = Window.partitionBy(*_ROW).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    after = F.sum(F.length("line") + 1).over(upto)
    lines = lines.withColumn("until", after).withColumn("since", F.col("until") - F.length("line") - 1)
    inside = _same("l", "b") & (F.col("b.start") >= F.col("l.since")) & (F.col("b.start") < F.col("l.until"))
    entity = F.concat_ws(":", F.col("b.kind"), F.when(F.col("b.kind").isin("card", "phone"), _digits(F.col("b.value"))).otherwise(F.lower("b.value")))
    # A line with a word, and those of them above and below.
    line = ["line_no", "since", "line"]
    beside = Window.partitionBy(*_ROW).orderBy("line_no")
    spread = lines.filter(F.col("line").rlike(WORD)).withColumns({"above": F.lag(F.struct(*line)).over(beside), "below": F.lead(F.struct(*line)).over(beside)})
    spread = spread.alias("l").join(base.alias("b"), inside).select("l._id", "l.hash", "l.line_no", "l.since", "l.line", "l.above", "l.below", entity.alias("entity"))
    around = F.array(*[F.struct(F.lit(at).alias("place"), own.alias("at")) for at, own in ((0, F.struct(*line)), (-1, F.col("above")), (1, F.col("below")))])
    with_entity = spread.select(*_ROW, "entity", F.explode(around).alias("c")).filter(F.col("c.at").isNotNull())
    with_entity = written(with_entity.select(*_ROW, "entity", "c.place", "c.at.*").distinct(), "lines")

    terms = written(disclosing_terms(docs, with_entity), "disclosing")
    told = with_entity.select(*_ROW, "line_no", "entity", "place").join(terms, ["entity", "place"]).groupBy(*_ROW, "line_no", "term").agg(F.max("disclosed").alias("disclosed"))
    marked = with_entity.join(terms.select("entity", "place").distinct(), ["entity", "place"], "left_semi").select(*_ROW, "line_no", "since", "line").distinct()
    places = located(marked, [*_ROW, "line_no", "since"], "line", TERM)
    places = places.select(*_ROW, "line_no", "since", F.lower("value").alias("term"), "start", "end")
    hit = places.alias("l").join(told.alias("b"), _same("l", "b") & (F.col("l.line_no") == F.col("b.line_no")) & (F.col("l.term") == F.col("b.term")))
    hit = hit.select("l._id", "l.hash", (F.col("since") + F.col("start")).cast("int").alias("start"), (F.col("since") + F.col("end")).cast("int").alias("end"), "disclosed")
    free = hit.alias("l").join(base.alias("b"), _same("l", "b") & (F.col("l.start") < F.col("b.end")) & (F.col("b.start") < F.col("l.end")), "left_anti")
    extra = free.select(*_ROW, F.lit("term").alias("kind"), "start", "end", "disclosed")
    spans = base.select(*_ROW, "kind", "start", "end", F.lit(1.0).alias("disclosed")).unionAll(extra)
    return keyed.select(*_ROW), written(spans, "spans")


def personal_spans(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``spans`` (kind, start, end; by kind as listed, then start) of every document.

    A null or empty text has no spans. Rows equal in ``doc_id`` and text get equal spans; a null
    ``doc_id`` is kept. An empty table gives no rows. Other columns are ignored.
    """
    rows, spans = find_personal(docs)
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int")
    listed = spans.groupBy(*_ROW).agg(F.sort_array(F.collect_list(F.struct(rank.alias("rank"), "start", "end", "kind"))).alias("spans"))
    joined = rows.alias("l").join(listed.alias("b"), _same("l", "b"), "left")
    none = F.array().cast("array<struct<rank:int,start:int,end:int,kind:string>>")
    return joined.select(F.col("l._id").alias("doc_id"), F.coalesce("spans", none).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """The counts and joined spans of ``personal_spans``."""

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "term")
    return found.select("doc_id", *[count(k) for k in PATTERNS], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data replaced by its kind, and disclosing terms generalised or removed.

    All columns stay. Where spans overlap, the first one is replaced and those that begin inside it are not.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*names)
    at = docs.columns.index("text")
    text, doc_id = F.col(names[at]), F.col(names[docs.columns.index("doc_id")])
    _, spans = find_personal(docs)
    before = Window.partitionBy(*_ROW).orderBy("start", "end", "kind").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("_until", F.coalesce(F.max("end").over(before), F.lit(0))).filter("start >= _until")
    label = F.when(F.col("kind") != "term", F.concat(F.lit("["), F.upper("kind"), F.lit("]"))).when(F.col("disclosed") >= REMOVE, "").otherwise("[TERM]")
    cuts = spans.groupBy(*_ROW).agg(F.sort_array(F.collect_list(F.struct("start", "end", label.alias("label")))).alias("cuts"))
    same = doc_id.eqNullSafe(F.col("_id")) & (F.xxhash64(F.coalesce(text, F.lit(""))) == F.col("hash"))

    def piece(i: Column) -> Column:
        since = F.when(i > 0, F.get("cuts", i - 1)["end"]).otherwise(0)
        cut = F.get("cuts", i)
        upto = F.coalesce(cut["start"], F.length(text))
        return F.concat(F.substring(text, since + 1, upto - since), F.coalesce(cut["label"], F.lit("")))

    clean = F.array_join(F.transform(F.sequence(F.lit(0), F.size("cuts")), piece), "")
    joined = rows.join(cuts, same, "left")
    return joined.select(*[F.when(F.col("cuts").isNull(), text).otherwise(clean).alias(n) if i == at else F.col(n) for i, n in enumerate(names)]).toDF(*docs.columns)
