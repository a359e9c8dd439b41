"""SQL that says what the registered queries return, for those that SQL can express.

The rest (4, 6, 8, 9, 10) are tested in part: against the library, enumeration, or labels that were held out.
"""

from __future__ import annotations

OP1_SUBSTRING_DEDUP = """
with w as (select doc_id, regexp_extract_all(coalesce(text,''), '[^\\x20\\x09-\\x0D]+') w from documents),
p as (select doc_id, w, unnest(range(1, len(w) - 33)) i from w where len(w) >= 35),
win as (select doc_id, i, md5(array_to_string(w[i:i+34], ' ')) h from p),
rep as (select h from win group by h having count(*) > 1),
hit as (select doc_id, i from win semi join rep using (h)),
gone as (select distinct doc_id, unnest(range(i, i + 35)) i from hit),
cut as (select doc_id, list(i) g from gone group by doc_id),
res as (select d.doc_id, len(w) n_words, coalesce(len(g), 0) n_removed, list_filter(w, lambda x, i: not list_contains(coalesce(g, []), i)) k from w d left join cut c on c.doc_id = d.doc_id)
select doc_id, cast(n_words as bigint) n_words, cast(n_removed as bigint) n_removed, sha256(array_to_string(k, ' ')) kept_sha256 from res
"""

OP2_LINE_DEDUP = """
with l as (select doc_id, unnest(list_zip(list_transform(range(1, len(s) + 1), lambda x: x), s)) z from (select doc_id, string_split(coalesce(text, ''), chr(10)) s from documents)),
k as (select doc_id, z[1] i, z[2] line, translate(trim(z[2], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') key from l),
many as (select key from k where key <> '' group by key having count(distinct doc_id) >= 10)
select doc_id, count(*) n_lines, count(*) filter (m.key is not null) n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by i) filter (m.key is null), '')) kept_sha256
from k left join many m on m.key = k.key group by doc_id
"""

OP3_QUALITY_RULES = """
with d as (select doc_id, lang, source, string_split(coalesce(text, ''), chr(10)) s, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') w, len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) n_symbols from documents),
g as (select doc_id, unnest(range(1, len(w) - 1)) i, w from d where len(w) > 2),
g3 as (select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] x from g),
rep as (select doc_id, x from g3 group by all having count(*) > 1),
hit as (select distinct doc_id, unnest([i, i + 1, i + 2]) p from g3 semi join rep using (doc_id, x)),
nrep as (select doc_id, count(*) n from hit group by doc_id),
f as (select d.doc_id, lang, source, len(w) n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) word_chars, n_symbols,
   len(list_filter(s, lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]'))) - len(list_distinct(list_filter(s, lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))) n_dup_lines,
   coalesce(n, 0) n_repeat_words, len(s) n_lines from d left join nrep using (doc_id)),
b as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words base_failed, n_symbols / nullif(n_words, 0) symbols, word_chars / nullif(n_words, 0) word_length, n_dup_lines / n_lines dup_lines, n_repeat_words / nullif(n_words, 0) repeats from f),
l as (unpivot (select lang, source, symbols, word_length, dup_lines, repeats from b where not base_failed) on symbols, word_length, dup_lines, repeats into name measure value x),
k as (select lang, source, measure, case when x > 0 then ceil(ln(x) / ln(1.0025e0 / 0.9975e0)) end bin, count(*) n from l group by all),
lv as (select 0 lv, lang, source, measure, bin, n from k union all select 1, lang, null, measure, bin, sum(n) from k group by all union all select 2, null, null, measure, bin, sum(n) from k group by all),
c as (select *, sum(n) over (partition by lv, lang, source, measure order by bin nulls first) below, sum(n) over (partition by lv, lang, source, measure) tot, case when bin is null then 0 else 2 / (1.0025e0 / 0.9975e0 + 1) * pow(1.0025e0 / 0.9975e0, bin) end v from lv),
q as (select lv, lang, source, measure, sum(n) n, min(v) filter (below >= 0.01e0 * tot) q01, min(v) filter (below >= 0.05e0 * tot) q05, min(v) filter (below >= 0.1e0 * tot) q10, min(v) filter (below >= 0.25e0 * tot) q25, min(v) filter (below >= 0.5e0 * tot) q50,
   min(v) filter (below >= 0.75e0 * tot) q75, min(v) filter (below >= 0.9e0 * tot) q90, min(v) filter (below >= 0.95e0 * tot) q95, min(v) filter (below >= 0.99e0 * tot) q99 from c group by all),
sp as (select *, case when q75 > q50 then q75 when q90 > q50 then q90 when q95 > q50 then q95 when q99 > q50 then q99 end up, case when q25 < q50 then q25 when q10 < q50 then q10 when q05 < q50 then q05 when q01 < q50 then q01 end down from q),
f1 as (select *, up + 5 * (up - q50) hi, down - 5 * (q50 - down) lo from sp),
fen as (select q0.lang, q0.source, q0.measure, coalesce(case when q0.n >= 50 then q0.hi end, case when q1.n >= 50 then q1.hi end, q2.hi) hi, coalesce(case when q0.n >= 50 then q0.lo end, case when q1.n >= 50 then q1.lo end, q2.lo) lo
   from (from f1 where lv = 0) q0 join (from f1 where lv = 1) q1 on q1.lang is not distinct from q0.lang and q1.measure = q0.measure join (from f1 where lv = 2) q2 on q2.measure = q0.measure),
w as (select lang, source, max(hi) filter (measure = 'symbols') s, max(hi) filter (measure = 'word_length') h, max(lo) filter (measure = 'word_length') lo, max(hi) filter (measure = 'dup_lines') dl, max(hi) filter (measure = 'repeats') r from fen group by all)
select doc_id, cast(n_words as bigint) n_words, cast(word_chars as bigint) word_chars, cast(n_symbols as bigint) n_symbols, cast(n_dup_lines as bigint) n_dup_lines, cast(n_repeat_words as bigint) n_repeat_words, base_failed,
  not base_failed and coalesce(symbols <= s, true) and coalesce(word_length <= h, true) and coalesce(word_length >= lo, true) and coalesce(dup_lines <= dl, true) and coalesce(repeats <= r, true) kept
from b left join w on w.lang is not distinct from b.lang and w.source is not distinct from b.source
"""

OP5_SOURCE_MIX = """
with s as (select doc_id, text, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) size from documents),
src as (select source, cast(sum(size) as double) source_size from s group by source),
w as (select *, [5, 2, 1][(row_number() over (order by source nulls last) - 1) % 3 + 1] weight, sum(source_size) over () * 1.5e0 budget from src),
o as (select *, 2 * source_size most, row_number() over (order by 2 * source_size / weight, source nulls last) r from w),
f as (select a.r, any_value(a.budget) - coalesce(sum(b.most) filter (b.r < a.r), 0) rest, sum(b.weight) filter (b.r >= a.r) ws from o a cross join o b group by a.r),
g as (select o.*, rest / ws rate, rest / ws * weight >= most stops from o join f using (r)),
t as (select source, cast(source_size as bigint) source_size, case when stops then most else weight * (select arg_min(rate, r) from g where not stops) end target from g),
p as (select s.doc_id, s.source, s.size, sum(s.size) over (partition by s.source order by md5(concat(s.doc_id, '|', coalesce(s.text, ''))), s.size rows between unbounded preceding and current row) - s.size b from s)
select doc_id, size, source_size, target,
  cast(case when source_size = 0 then 0 else floor(floor(target) / source_size) * size + greatest(0, least(size, floor(target) - floor(floor(target) / source_size) * source_size - b)) end as bigint) taken
from p join t on t.source is not distinct from p.source
"""

OP7_NGRAM_JOIN = """
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text,''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') w from documents),
sh as (select distinct doc_id, array_to_string(w[i:i+4], ' ') s from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) i from w where len(w) > 0)),
n as (select doc_id, count(*) n from sh group by doc_id),
pair as (select a.doc_id x, b.doc_id y, count(*) c from sh a join sh b on a.s = b.s and a.doc_id < b.doc_id group by all),
link as (select x, y from pair join n p on p.doc_id = x join n q on q.doc_id = y where 100 * c >= 80 * (p.n + q.n - c)),
edge as (select x, y from link union all select y, x from link),
reach(doc_id, r) as (select doc_id, doc_id from documents union select reach.doc_id, edge.y from reach join edge on edge.x = reach.r)
select d.doc_id, coalesce(any_value(n.n), 0) n_shingles, min(r) component_id from documents d join reach on reach.doc_id = d.doc_id left join n on n.doc_id = d.doc_id group by d.doc_id
"""

_LINKS, _, _JOINED = OP7_NGRAM_JOIN.rpartition("\nselect ")
OP7_NGRAM_LINKS = f"""{_LINKS},
joined as (select {_JOINED})
select joined.*, coalesce(c, 0) n_links from joined left join (select x, count(*) c from edge group by x) k on k.x = joined.doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_substring_dedup": OP1_SUBSTRING_DEDUP,
        "op2_line_dedup": OP2_LINE_DEDUP,
        "op3_quality_rules": OP3_QUALITY_RULES,
        "op5_source_mix": OP5_SOURCE_MIX,
        "op7_ngram_join": OP7_NGRAM_JOIN,
        "op7_ngram_links": OP7_NGRAM_LINKS,
    }
