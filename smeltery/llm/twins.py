"""SQL twins of the operators that SQL can follow."""

# Every window of 20 words, of which all but the first of its kind remove their words.
REPEATED_WORDS = r"""
with texts as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
windows as (
  select doc_id, i, array_to_string(list_slice(words, i, i + 19), ' ') as said
  from (select doc_id, words, unnest(range(1, len(words) - 18)) as i from texts)),
later as (
  select doc_id, i from windows qualify row_number() over (partition by said order by doc_id, i) > 1),
gone as (select distinct doc_id, unnest(range(i, i + 20)) as i from later),
marked as (
  select w.doc_id, w.i, w.word, g.i is not null as removed
  from (select doc_id, unnest(range(1, len(words) + 1)) as i, unnest(words) as word from texts) w
  left join gone g on w.doc_id = g.doc_id and w.i = g.i),
kept as (
  select doc_id, count_if(removed) as n_removed,
    coalesce(string_agg(word, ' ' order by i) filter (where not removed), '') as said
  from marked group by doc_id)
select t.doc_id, cast(len(words) as bigint) as n_words, cast(coalesce(n_removed, 0) as bigint) as n_removed,
  sha256(coalesce(said, '')) as kept_sha256
from texts t left join kept k on t.doc_id = k.doc_id
"""

# Every string of 100 bytes, two hexadecimal digits a byte; removed runs are merged before cutting.
REPEATED_BYTES = r"""
with texts as (select doc_id, hex(encode(coalesce(text, ''))) as digits from documents),
windows as (
  select doc_id, i, substr(digits, 2 * i + 1, 200) as said
  from (select doc_id, digits, unnest(range(0, length(digits) // 2 - 99)) as i from texts)),
later as (
  select doc_id, i from windows qualify row_number() over (partition by said order by doc_id, i) > 1),
starts as (
  select doc_id, i, lag(i) over (partition by doc_id order by i) as before from later),
runs as (
  select doc_id, i, sum(case when before is null or i > before + 100 then 1 else 0 end)
    over (partition by doc_id order by i) as run from starts),
spans as (
  select doc_id, run, min(i) as a, max(i) + 100 as b from runs group by doc_id, run),
between_spans as (
  select s.doc_id, lag(b, 1, 0) over (partition by s.doc_id order by a) as a, s.a as b from spans s
  union all select t.doc_id, coalesce(max(s.b), 0), length(any_value(digits)) // 2
    from texts t left join spans s on t.doc_id = s.doc_id group by t.doc_id),
kept as (
  select p.doc_id, string_agg(substr(digits, 2 * a + 1, 2 * (b - a)), '' order by a) as digits
  from between_spans p join texts t on p.doc_id = t.doc_id group by p.doc_id),
counted as (select doc_id, sum(b - a) as n_removed, count(*) as n_spans from spans group by doc_id)
select t.doc_id, cast(length(t.digits) // 2 as bigint) as n_bytes,
  cast(coalesce(n_removed, 0) as bigint) as n_removed, cast(coalesce(n_spans, 0) as bigint) as n_spans,
  sha256(unhex(k.digits)) as kept_sha256
from texts t join kept k on t.doc_id = k.doc_id left join counted c on t.doc_id = c.doc_id
"""

# All pairs of a label, and what links reach.
NEAR_VECTORS = r"""
with recursive good as (
  select vec_id, label, cast(embedding as double[]) as e from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (
  select a.vec_id as a, b.vec_id as b from good a join good b
    on a.label = b.label and len(a.e) = len(b.e) and a.vec_id <> b.vec_id
  where list_cosine_similarity(a.e, b.e) >= 0.98),
reached as (
  select a, b from links union select r.a, l.b from reached r join links l on r.b = l.a),
named as (select a, least(a, min(b)) as component_id from reached group by a),
counted as (select a, count(*) as n_links from links group by a)
select v.vec_id, coalesce(n_links, 0) as n_links, coalesce(component_id, v.vec_id) as component_id,
  coalesce(component_id, v.vec_id) = v.vec_id as kept
from embeddings v left join named n on v.vec_id = n.a left join counted c on v.vec_id = c.a
"""

# Every run of one to three words of a piece is counted; sums and products are of 128 bits.
COLLOCATIONS = r"""
with texts as (
  select coalesce(lang, 'und') as lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as said from documents),
pieces as (select lang, unnest(regexp_split_to_array(said, '[.,;:!?\x0A-\x0D]')) as piece from texts),
worded as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as words from pieces),
tokens as (select lang, words, unnest(range(1, len(words) + 1)) as i from worded),
runs as (
  select lang, 1 as size, words[i] as phrase from tokens
  union all select lang, 2, words[i] || ' ' || words[i + 1] from tokens where i + 1 <= len(words)
  union all select lang, 3, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] from tokens
    where i + 2 <= len(words)),
counts as (select lang, size, phrase, count(*) as f from runs group by all),
totals as (select lang, cast(sum(f) as bigint) as n from counts where size = 1 group by lang),
candidates as (
  select lang, size, phrase, f as a, string_split(phrase, ' ') as w from counts where size > 1 and f >= 10),
inner_ones as (
  select lang, w[1] || ' ' || w[2] as phrase, a from candidates where size = 3
  union all select lang, w[2] || ' ' || w[3], a from candidates where size = 3),
longer as (select lang, phrase, max(a) as a from inner_ones group by all),
own as (
  select c.* from candidates c left join longer g on c.lang = g.lang and c.phrase = g.phrase and c.size = 2
  where g.a is null or 100 * g.a < 50 * c.a),
cuts as (
  select lang, phrase, a, 1 as k, w[1] as first, array_to_string(w[2:], ' ') as rest from own
  union all select lang, phrase, a, 2, w[1] || ' ' || w[2], w[3] from own where size = 3),
judged as (
  select c.lang, c.phrase, c.a, k, l.f as l, r.f as r,
    cast(cast(c.a as hugeint) * c.a * 1000000 // (cast(l.f as hugeint) * r.f) as bigint) as score
  from cuts c join counts l on c.lang = l.lang and c.first = l.phrase
    join counts r on c.lang = r.lang and c.rest = r.phrase),
best as (
  select * from judged qualify row_number() over (partition by lang, phrase order by score, k) = 1)
select b.lang, row_number() over (partition by b.lang order by score desc, a desc, phrase) as rank,
  phrase, a, l, r, n, score
from best b join totals t on b.lang = t.lang
qualify rank <= 2000
"""
