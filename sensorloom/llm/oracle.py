"""The registered text queries as SQL, where SQL can express them."""

from sensorloom.llm import quality

WORD = r"[^\x20\x09-\x0D]+"
_STOCK = " or ".join(f"contains(lower(line), '{p}')" for p in quality.BOILERPLATE)

#: ``docs`` (rid, doc_id, text, ...) judged line by line; ``judged`` has a row per rid.
QUALITY = f"""docs as (select row_number() over () as rid, * replace (coalesce(text, '') as text) from documents),
lines as (
  select rid, line_no, line, len(regexp_extract_all(line, '{WORD}')) as n,
    len(regexp_extract_all(line, '{quality.MARKED}')) as marked,
    len(regexp_extract_all(regexp_replace(line, '[\\x20\\x09-\\x0D]', '  ', 'g'), '{quality.SEPARATOR}')) as parted
  from (select rid, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as line_no from docs)),
line_sums as (
  select rid, sum(n) filter (where 100 * marked > {quality.MOST_MARKED} * n
      or (parted > 1 and 100 * parted > {quality.MOST_SEPARATORS} * n)
      or (n <= {quality.MOST_BOILERPLATE_WORDS} and ({_STOCK}))) as lost,
    count(*) - count(distinct line) as dup
  from lines where n > 0 group by rid),
words as (
  select rid, unnest(w) as word, generate_subscripts(w, 1) as pos
  from (select rid, regexp_extract_all(text, '{WORD}') as w from docs)),
windows as (
  select rid, pos, word as a, lead(word) over p as b, lead(word, 2) over p as c from words window p as (partition by rid order by pos)),
twice as (
  select rid, pos from (select *, count(*) over (partition by rid, a, b, c) as times from windows where c is not null) where times > 1),
covered as (
  select rid, count(distinct pos + k) as n from twice, (values (0), (1), (2)) as t(k) group by rid),
counted as (
  select docs.*, len(regexp_extract_all(text, '{WORD}')) as n_words,
    cast(length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) as bigint) as word_chars,
    cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    coalesce(dup, 0) as n_dup_lines, coalesce(covered.n, 0) as n_repeat_words, coalesce(lost, 0) as lost
  from docs left join line_sums using (rid) left join covered using (rid)),
judged as (
  select *, n_words < {quality.LEAST_WORDS} or 100 * n_repeat_words > {quality.MOST_REPEATED} * n_words as base_failed,
    not (n_words < {quality.LEAST_WORDS} or 100 * n_repeat_words > {quality.MOST_REPEATED} * n_words
      or 100 * lost > {quality.MOST_LOST} * n_words) as kept
  from counted)"""


def mixing_sql(documents: str = "documents") -> str:
    """The mix of ``documents`` as a list of common tables that ends in ``mixed``."""
    return f"""sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) as size,
    md5(concat_ws('|', 'mix', cast(doc_id as varchar), md5(coalesce(text, '')))) as k
  from {documents}),
sources as (
  select source, cast(sum(size) as bigint) as source_size,
    [5, 2, 1][(row_number() over (order by source nulls last) - 1) % 3 + 1] as w
  from sized group by source),
sorted as (
  select *, 3 * source_size as cap, row_number() over (order by 3.0 * source_size / w, source nulls last) as n from sources),
shares as (
  select *, cast(sum(source_size) over () - coalesce(sum(cap) over (order by n rows between unbounded preceding and 1 preceding), 0) as double)
    / (sum(w) over (order by n rows between current row and unbounded following)) as share from sorted),
uncapped as (select coalesce(min_by(share, n) filter (where cap >= w * share), 0) as share from shares),
targets as (
  select source, source_size, least(cast(cap as double), w * uncapped.share) as target from sorted, uncapped),
placed as (
  select s.*, source_size, target, coalesce(sum(size) over (partition by s.source order by k, doc_id rows between unbounded preceding and 1 preceding), 0) as before
  from sized s join targets t on s.source is not distinct from t.source),
epochs as (select *, case when source_size > 0 then cast(round(target) as bigint) // source_size else 0 end as e from placed),
mixed as (
  select doc_id, source, size, source_size, target,
    cast(e * size + greatest(0, least(cast(round(target) as bigint) - e * source_size - before, size)) as bigint) as taken
  from epochs)"""


#: ``vectors`` (vec_id, label, v): whole components; the label is as it stands in the table.
VECTORS = """vectors as (
  select vec_id, cast(label as bigint) as label, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
  from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)"""

#: ``shares`` (lang, source, term, c, p, total, q) over all groups and kept terms of their lang.
SHARES = r"""docs as (
  select row_number() over () as rid, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as text from documents),
words as (
  select rid, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from docs),
kept as (select lang, term, count(*) as total from words group by all having count(distinct rid) >= 3),
langs as (select lang, sum(total) + count(*) as size from kept group by lang),
counts as (select lang, source, term, count(*) as c from words semi join kept using (lang, term) group by all),
pairs_of as (select * from (select distinct lang, source from docs) join kept using (lang)),
filled as (select p.*, coalesce(c, 0) as c from pairs_of p left join counts using (lang, source, term)),
groups as (select lang, source, sum(c) + count(*) as size from filled group by all),
shares as (
  select f.lang, f.source, term, c, cast(1 + cast(1000000000 as hugeint) * (c + 1) // g.size as bigint) as p,
    cast(1 + cast(1000000000 as hugeint) * (total + 1) // l.size as bigint) as q
  from filled f join groups g on f.lang = g.lang and f.source = g.source join langs l on f.lang = l.lang)"""


ORACLE: dict[str, str] = {
    "op4_mixing": f"with {mixing_sql()} select doc_id, size, source_size, target, taken from mixed",
    "op6_quality": f"""with {QUALITY} select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept
  from judged""",
    "op11_negatives": f"""with {VECTORS},
labelled as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, v from vectors where label is not null),
scored as (
  select a.vec_id as anchor_id, b.vec_id, a.label = b.label as alike, cast(list_dot_product(a.v, b.v) as bigint) as score
  from labelled a join labelled b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scored where alike
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5),
ranked as (
  select p.*, s.vec_id as negative_id, s.score as negative_score,
    cast(row_number() over (partition by p.anchor_id, positive_id order by s.score desc, s.vec_id) as int) as rank
  from positives p join scored s on p.anchor_id = s.anchor_id and not s.alike
    and 80 * positive_score <= 100 * s.score and 100 * s.score <= 100 * positive_score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from ranked where rank <= 5""",
    "op12_topk": f"""with {VECTORS},
ranked as (
  select q.vec_id as query_id, x.vec_id, cast(list_dot_product(q.v, x.v) as bigint) as score,
    cast(row_number() over (partition by q.vec_id order by cast(list_dot_product(q.v, x.v) as bigint) desc, x.vec_id) as int) as rank
  from vectors q join vectors x on q.vec_id <> x.vec_id where q.vec_id % 50 = 0)
select query_id, rank, vec_id, score from ranked where rank <= 5""",
    "op13_divergence": f"""with {SHARES},
summed as (
  select s.lang, s.source, t.source as item, cast(sum((s.p - t.p) * (s.p - t.p) // t.p) as bigint) as value
  from shares s join shares t on s.lang = t.lang and s.term = t.term and s.source <> t.source group by all),
sources as (select distinct lang, source from docs),
pairs as (
  select s.lang, s.source, 'pair' as part, t.source as item, coalesce(value, 0) as value
  from sources s join sources t on s.lang = t.lang and s.source <> t.source
    left join summed m on m.lang = s.lang and m.source = s.source and m.item = t.source),
terms as (select lang, source, 'term' as part, term as item, (p - q) * (p - q) // q as value from shares where c > 0 and p > q),
ranked as (
  select *, cast(row_number() over (partition by lang, source, part order by value desc, item) as int) as rank
  from (select * from pairs union all select * from terms))
select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= 200""",
}
