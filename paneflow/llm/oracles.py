"""SQL counterparts of the text queries that SQL can express."""

from __future__ import annotations

from paneflow.llm.licenses import ABOUT, BY_NAME, BY_SHORT, HINT, PHRASES, RULES, SENTENCES, SHORT_PHRASES, WORDS, identifiers, rule_key
from paneflow.llm.mixing import STEP
from paneflow.llm.quality import Limits

_SPACE = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]+"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


CHATS = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
  sha256(coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn nulls first, role, text), '')) as loss_sha256,
  cast(sum(24 + length(regexp_replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '<(\\*)\|', '<\\\1|', 'g'))
      + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g'))) as bigint) as formatted_chars,
  cast(0 as bigint) as n_attachments, cast(0 as bigint) as n_attachment_tokens
from turns group by conv_id
"""


def _licenses() -> str:
    """Every piece stands between two bars of its own; a known sentence may hold such a double bar for a blank."""
    known = ", ".join(f"({quoted(s)}, {quoted(name)})" for s, name in identifiers().items())
    longest = lambda texts: "|".join(sorted(texts, key=len, reverse=True))
    made = [longest(SENTENCES), f"(?:{longest(PHRASES)}) (?:{longest(BY_NAME)})", f"(?:{longest(SHORT_PHRASES)}) (?:{longest(BY_SHORT)})"]
    sentence = "|".join(made).replace(" ", r"(?: |\|\|)")
    phrase, names = longest(PHRASES), longest(BY_NAME)
    runs = [(quoted(rule_key(ids)), quoted(name)) for ids, name in RULES]
    steps, last = [], "r0"
    for k, (run, name) in enumerate(runs, 1):
        steps.append(
            f"r{k} as (select doc_id, ids, n_unknown, replace(seq, {run}, ',#,') as seq,"
            f" case when contains(seq, {run}) and not list_contains(found, {name}) then list_append(found, {name}) else found end as found from {last})"
        )
        last = f"r{k}"
    return rf"""
with known(sentence, name) as (values {known}),
cut as (
  select doc_id, unnest(string_split(regexp_replace(text, '([.!?;:]){_SPACE}+', '\1' || chr(10), 'g'), chr(10))) as s,
    generate_subscripts(string_split(regexp_replace(text, '([.!?;:]){_SPACE}+', '\1' || chr(10), 'g'), chr(10)), 1) as place
  from documents where regexp_matches(text, '{WORDS}')
),
plain as (
  select doc_id, place, regexp_replace(trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g'), ' '), '^(dnl|rem) ', '') as piece from cut
),
barred as (select doc_id, string_agg('|' || piece || '|', '' order by place) as t from plain where piece <> '' group by doc_id),
split as (
  select doc_id, unnest(regexp_extract_all(t, {quoted(chr(92) + '|(' + sentence + '|[^|]*)' + chr(92) + '|')}, 1)) as s,
    generate_subscripts(regexp_extract_all(t, {quoted(chr(92) + '|(' + sentence + '|[^|]*)' + chr(92) + '|')}, 1), 1) as place
  from barred
),
named as (
  select doc_id, place, t.sentence, coalesce(k.name, u.name) as name from (
    select doc_id, place, replace(s, '||', ' ') as sentence, regexp_replace(replace(s, '||', ' '), '^(?:{phrase}) ((?:{names}).*)$', 'under \1') as key from split
  ) t left join known k on t.sentence = k.sentence left join known u on key = u.sentence
),
sums as (
  select doc_id, string_agg(name, ',' order by place) as ids, string_agg(',' || name || ',', '' order by place) as seq,
    count(*) filter (where name is null and regexp_matches(sentence, '{HINT}') and regexp_matches(sentence, '{ABOUT}')) as n_unknown
  from named group by doc_id
),
r0 as (
  select d.doc_id, coalesce(ids, '') as ids, coalesce(n_unknown, 0) as n_unknown, coalesce(seq, '') as seq, cast([] as varchar[]) as found
  from documents d left join sums s on d.doc_id = s.doc_id
),
{", ".join(steps)}
select doc_id, array_to_string(found, ',') as licenses, ids as sentence_ids, n_unknown from {last}
"""


def _quality(limits: Limits = Limits()) -> str:
    return rf"""
with docs as (select doc_id, coalesce(source, '') as host, coalesce(text, '') as text from documents),
words as (
  select doc_id, unnest(regexp_extract_all(text, '{_WORD}')) as w, generate_subscripts(regexp_extract_all(text, '{_WORD}'), 1) as i from docs
),
three as (
  select doc_id, i, w || ' ' || lead(w, 1) over p || ' ' || lead(w, 2) over p as t from words window p as (partition by doc_id order by i)
),
again as (select doc_id, i, count(*) over (partition by doc_id, t) as n from three where t is not null),
places as (select doc_id, i, lead(i) over (partition by doc_id order by i) as following from again where n > 1),
repeats as (select doc_id, sum(least(3, coalesce(following - i, 3))) as n_repeat_words from places group by doc_id),
counts as (select doc_id, count(*) as n_words, sum(length(w)) as word_chars from words group by doc_id),
raw as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as place from docs),
dups as (select doc_id, count(*) - count(distinct line) as n_dup_lines from raw where regexp_matches(line, '{_WORD}') group by doc_id),
lines as (
  select doc_id, host, place, lower(trim(regexp_replace(line, '{_SPACE}+', ' ', 'g'), ' ')) as line
  from raw join docs using (doc_id) where regexp_matches(line, '{_WORD}')
),
told as (select doc_id, string_agg(line, chr(10) order by place) as same from lines group by doc_id),
marked as (select l.*, same from lines l join told using (doc_id)),
hosts as (select host, count(distinct coalesce(same, '')) as host_docs from docs left join told using (doc_id) group by host),
hot as (
  select m.host, m.line from marked m join hosts h on m.host = h.host group by m.host, m.line, host_docs
  having count(distinct same) >= {limits.min_docs} and count(distinct same) > host_docs * cast({limits.max_share} as double)
),
lost as (
  select m.doc_id, sum(len(string_split(m.line, ' '))) as removed_words from marked m join hot h on m.host = h.host and m.line = h.line group by m.doc_id
),
all_ as (
  select d.doc_id, coalesce(n_words, 0) as n_words, coalesce(word_chars, 0) as word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) as n_symbols, coalesce(n_dup_lines, 0) as n_dup_lines,
    coalesce(n_repeat_words, 0) as n_repeat_words, coalesce(removed_words, 0) as removed_words
  from docs d left join counts c on d.doc_id = c.doc_id left join dups u on d.doc_id = u.doc_id
    left join repeats r on d.doc_id = r.doc_id left join lost o on d.doc_id = o.doc_id
)
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars, cast(n_symbols as bigint) as n_symbols,
  cast(n_dup_lines as bigint) as n_dup_lines, cast(n_repeat_words as bigint) as n_repeat_words,
  n_words < {limits.min_words} or 100 * n_repeat_words > {limits.max_repeat_percent} * n_words as base_failed,
  not (n_words < {limits.min_words} or 100 * n_repeat_words > {limits.max_repeat_percent} * n_words)
    and n_words - removed_words >= n_words * cast({limits.min_left} as double) as kept,
  cast(removed_words as bigint) as removed_words
from all_
"""


def _mixing(seed: int = 11, power: float = 0.5) -> str:
    number = "cast(cast('0x' || substr(md5({}), 1, 13) as bigint) as double) / 4503599627370496.0"
    return f"""
with recursive sums as (
  select coalesce(source, '') as source, cast(sum(coalesce(strlen(text), 0) + 1) as bigint) as n_bytes from documents group by 1
),
weighted as (select source, n_bytes, pow(cast(n_bytes as double), {power}) as weight from sums),
rates as (
  select source, weight / (select sum(weight) from weighted) * (select sum(n_bytes) from weighted) / n_bytes as rate from weighted
),
steps as (select source, cast(ceil(rate / {STEP}) as integer) as steps, rate / ceil(rate / {STEP}) as mean from rates),
cdf as (
  select source, mean, 0 as k, exp(-mean) as p, exp(-mean) as c from steps
  union all
  select source, mean, k + 1, p * mean / (k + 1), c + p * mean / (k + 1) from cdf where k + 1 <= cast(ceil(mean + 12 * sqrt(mean) + 40) as integer)
),
drawn as (
  select d.doc_id, s.source, step.j, {number.format(f"'{seed}:' || coalesce(cast(d.doc_id as varchar), '') || ':' || cast(step.j as varchar)")} as u
  from documents d join steps s on coalesce(d.source, '') = s.source, lateral (select unnest(range(1, s.steps + 1)) as j) as step
),
counts as (
  select doc_id, source, cast(sum((select count(*) from cdf where cdf.source = drawn.source and cdf.c <= drawn.u)) as bigint) as n from drawn group by doc_id, source
)
select doc_id, source, cast(copy as integer) as copy, md5('{seed}:order:' || coalesce(cast(doc_id as varchar), '') || ':' || cast(copy as varchar)) as place
from (select doc_id, source, unnest(range(0, n)) as copy from counts)
"""


AUDIT = rf"""
with letters(x, bit) as (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders as (
  select a.x || b.x || c.x || d.x || e.x as filter_order from letters a, letters b, letters c, letters d, letters e
  where a.bit + b.bit + c.bit + d.bit + e.bit = 31
),
steps as (
  select filter_order, step, bit,
    coalesce(sum(bit) over (partition by filter_order order by step rows between unbounded preceding and 1 preceding), 0)::bigint as before
  from (select filter_order, unnest([1, 2, 3, 4, 5]) as step from orders) s join letters on x = substring(filter_order, step, 1)
),
docs as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '{_WORD}') as w from documents
),
masks as (
  select doc_id, part,
    (len(w) < 200)::bigint + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::bigint
    + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t))::bigint + 8 * regexp_matches(t, '[#$%&*|]')::bigint
    + 16 * coalesce(doc_id > min(doc_id) over (partition by t), false)::bigint as mask
  from docs
),
good as (select distinct doc_id from labels where quality = 1),
toxic as (select distinct doc_id from labels where toxic = 1),
cells as (
  select part, mask, count(*) as n, count(g.doc_id) as n_good, count(t.doc_id) as n_toxic
  from masks m left join good g on m.doc_id = g.doc_id left join toxic t on m.doc_id = t.doc_id group by all
),
sums as (
  select part, filter_order, step, bit, sum(case when mask & (bit | before) = 0 then n else 0 end) as kept,
    sum(case when mask & bit > 0 and mask & before = 0 then n else 0 end) as removed,
    sum(case when mask & bit > 0 and mask & before > 0 then n else 0 end) as redundant,
    sum(case when mask = bit then n else 0 end) as unique_fails,
    sum(case when mask & bit > 0 and mask & before = 0 then n_good else 0 end) as good_lost,
    sum(case when mask & bit > 0 and mask & before = 0 then n_toxic else 0 end) as toxic_lost
  from cells cross join steps group by all
)
select part, filter_order, step::integer as step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant,
  unique_fails::bigint as unique_fails, good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
  (sum(removed) over (partition by part, bit))::bigint as shapley
from sums
"""

ARCHIVES = """
with payloads as (select page_id, coalesce(url, '') as url, coalesce(html, '') as body from pages),
told as (
  select page_id, strlen(body) as n, sha256(body) as digest,
    row_number() over (partition by body order by page_id nulls last, url) as place,
    first_value(page_id) over (partition by body order by page_id nulls last, url) as first_id
  from payloads
)
select page_id, n::bigint as payload_bytes, digest as payload_digest, case when n < 100 or place = 1 then 'response' else 'revisit' end as record_type,
  case when n >= 100 and place > 1 then first_id end as refers_to
from told
"""

NEGATIVES = """
with finite as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x::double))) = 0
),
scored as (
  select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same, list_inner_product(a.v, b.v)::bigint as score
  from finite a join finite b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id
),
positives as (
  select anchor_id, other_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5
)
select p.anchor_id, positive_id, row_number() over w::integer as rank, other_id as negative_id, positive_score, score as negative_score
from positives p join scored s on p.anchor_id = s.anchor_id and not s.same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
window w as (partition by p.anchor_id, positive_id order by score desc, other_id)
qualify row_number() over w <= 10
"""


ORACLES = {
    "op11_filter_audit": AUDIT,
    "op12_warc_bundles": ARCHIVES,
    "op13_hard_negatives": NEGATIVES,
    "op2_chat_formatting": CHATS,
    "op4_license_scan": _licenses(),
    "op6_quality_rules": _quality(),
    "op7_source_mixing": _mixing(),
}
