"""DuckDB SQL for those operators' queries whose results SQL can express: the contracts said again, by brute force."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"'[^\x20\x09-\x0D]+'"
_ITEM_WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

#: Windows of 13 words, or of a whole shorter item, compared as text.
DECONTAMINATION = f"""
with dw as (select doc_id, regexp_extract_all({_LOWER}, {_ITEM_WORDS}) w from documents),
iw as (select item_id, regexp_extract_all({_LOWER}, {_ITEM_WORDS}) w from benchmark),
win as (select item_id, w, least(13, len(w)) k, unnest(range(1, len(w) - least(13, len(w)) + 2)) i from iw where len(w) > 0),
iwin as (select distinct item_id, k, array_to_string(w[i : i + k - 1], ' ') s from win),
ks as (select distinct k from iwin),
places as (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) i from dw, ks where len(w) >= k),
m as (select doc_id, item_id, i, k from (select doc_id, k, i, array_to_string(w[i : i + k - 1], ' ') s from places) join iwin using (k, s)),
hit as (select doc_id, count(distinct p) n_hit from (select doc_id, unnest(range(i, i + k)) p from m) group by 1),
found as (select doc_id, count(*) n_items, string_agg(item, ',' order by item) items from (select distinct doc_id, cast(item_id as varchar) item from m) group by 1)
select doc_id, cast(len(w) as bigint) n_words, cast(coalesce(n_hit, 0) as bigint) n_hit, cast(coalesce(n_items, 0) as bigint) n_items, sha256(coalesce(items, '')) items_sha256,
coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) contaminated
from dw left join hit using (doc_id) left join found using (doc_id)"""

#: Every pair of documents with a common shingle is compared; components by the least id over links.
NEAR_DUPLICATES = f"""
with recursive dw as (select doc_id, regexp_extract_all({_LOWER}, {_WORDS}) w from documents),
s as (select distinct doc_id, array_to_string(w[i : i + k - 1], ' ') s from (select doc_id, w, least(2, len(w)) k, unnest(range(1, len(w) - least(2, len(w)) + 2)) i from dw where len(w) > 0)),
n as (select doc_id, count(*) n from s group by 1),
sets as (select n, any_value(doc_id) a, min(doc_id) least_id, list(doc_id) ids from (select doc_id, n, md5(string_agg(s, chr(10) order by s)) h from s join n using (doc_id) group by 1, 2) group by n, h),
own as (select s.s, s.doc_id a, x.n, x.least_id from s join sets x on x.a = s.doc_id),
shared as (select p.least_id x, q.least_id y, count(*) c, p.n np, q.n nq from own p join own q on p.s = q.s and p.least_id < q.least_id and 5 * least(p.n, q.n) >= 4 * greatest(p.n, q.n) group by 1, 2, 4, 5),
link as (select x, y from shared where 100 * c >= 80 * (np + nq - c)),
edge as (select x, y from link union select y, x from link),
reach(x, y) as (select x, y from edge union select r.x, e.y from reach r join edge e on e.x = r.y),
named as (select least_id, least(least_id, coalesce(m, least_id)) c from sets left join (select x, min(y) m from reach group by 1) on x = least_id),
member as (select unnest(ids) doc_id, n, c from sets join named using (least_id))
select d.doc_id, cast(coalesce(m.n, 0) as bigint) n_shingles, coalesce(m.c, d.doc_id) component_id, coalesce(m.c, d.doc_id) = d.doc_id kept from documents d left join member m using (doc_id)"""

#: Base counts, and the lines that more documents of a host hold than 5 and 1 % of them.
QUALITY = r"""
with d as (select doc_id, coalesce(source, '') host, coalesce(text, '') t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w from documents),
win as (select doc_id, i, array_to_string(w[i : i + 4], ' ') s from (select doc_id, w, unnest(range(1, len(w) - 3)) i from d where len(w) > 4)),
twice as (select doc_id, i from win join (select doc_id, s from win group by 1, 2 having count(*) > 1) using (doc_id, s)),
rep as (select doc_id, count(distinct p) n from (select doc_id, unnest(range(i, i + 5)) p from twice) group by 1),
line as (select doc_id, host, l, regexp_extract_all(translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') w from (select doc_id, host, unnest(string_split(t, chr(10))) l from d)),
full_line as (select doc_id, host, l, w, list_transform(w, lambda x: case when regexp_full_match(x, '[0-9]+') then '0' else x end) z from line where len(w) > 0),
dup as (select doc_id, count(*) - count(distinct l) n from full_line group by 1),
own as (select doc_id, host, len(w) n, array_to_string(case when list_distinct(z) = ['0'] then w else z end, ' ') s from full_line),
hosts as (select host, count(distinct doc_id) docs from d group by 1),
often as (select host, s from (select host, s, count(distinct doc_id) n from own group by 1, 2) join hosts using (host) where n > 5 and n > 0.01 * docs),
gone as (select doc_id, cast(sum(n) as bigint) n from own join often using (host, s) group by 1),
x as (select d.doc_id, cast(len(w) as bigint) n_words, cast(coalesce(list_sum(list_transform(w, lambda v: length(v))), 0) as bigint) word_chars,
cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) n_symbols, coalesce(dup.n, 0) n_dup_lines, coalesce(rep.n, 0) n_repeat_words, coalesce(gone.n, 0) g
from d left join dup using (doc_id) left join rep using (doc_id) left join gone using (doc_id)),
y as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words base_failed from x)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and n_words - g >= 10 and 2 * (n_words - g) >= n_words kept, g n_removed_words from y"""

#: Every string of 50 bytes, in hexadecimal, with the smallest document that it starts in.
SUFFIXES = """
with d as (select doc_id, hex(encode(coalesce(text, ''))) h from documents),
p as (select doc_id, regexp_extract_all(h, '.{1,1000}') p from d),
piece as (select doc_id, (j - 1) * 500 base, p[j] || coalesce(p[j + 1][1:98], '') t, len(p[j]) // 2 m from (select doc_id, p, unnest(range(1, len(p) + 1)) j from p)),
st as (select doc_id, base + i i, t[2 * i + 1 : 2 * i + 100] s from (select *, unnest(range(0, m)) i from piece) where 2 * i + 100 <= len(t)),
gone as (select doc_id, i from st join (select s, min(doc_id) f from st group by 1) using (s) where f < doc_id),
run as (select doc_id, min(i) a, max(i) + 50 b from (select doc_id, i, sum(fresh) over (partition by doc_id order by i rows unbounded preceding) g
 from (select doc_id, i, case when i - lag(i) over (partition by doc_id order by i) <= 50 then 0 else 1 end fresh from gone)) group by doc_id, g),
cut as (select doc_id, coalesce(lag(b) over (partition by doc_id order by a), 0) lo, a hi from run union all select doc_id, max(b), 1000000000 from run group by 1),
rest as (select doc_id, string_agg(substring(h, 2 * lo + 1, 2 * (hi - lo)), '' order by lo) r from cut join d using (doc_id) group by 1),
n as (select doc_id, sum(b - a) removed, count(*) spans from run group by 1)
select doc_id, cast(len(h) // 2 as bigint) n_bytes, cast(coalesce(removed, 0) as bigint) n_removed, cast(coalesce(spans, 0) as bigint) n_spans, sha256(unhex(coalesce(r, h))) kept_sha256
from d left join n using (doc_id) left join rest using (doc_id)"""

#: The shortest runs of lines with 50 words, forwards from and backwards up to each line, compared as text.
LINES = r"""
with l as (select doc_id, k, l, len(w) n, array_to_string(w, ' ') s from (select doc_id, k, l, regexp_extract_all(l, '[^\x20\x09-\x0D]+') w
 from (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) l, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) k from documents))),
own as (select doc_id, k, s, row_number() over (partition by doc_id order by k) - 1 i, sum(n) over (partition by doc_id order by k rows unbounded preceding) c, n from l where n > 0),
ends as (select x.doc_id, x.i a, min(y.i) b from own x asof join own y on x.doc_id = y.doc_id and y.c >= x.c - x.n + 50 group by 1, 2
 union select y.doc_id, max(x.i), y.i from own y asof join own x on x.doc_id = y.doc_id and x.c - x.n <= y.c - 50 group by 1, 3),
win as (select e.doc_id, a, b, string_agg(s, chr(10) order by i) t from ends e join own o on o.doc_id = e.doc_id and o.i between a and b group by 1, 2, 3),
first as (select t, min((doc_id, a)) f from win group by 1),
gone as (select distinct doc_id, unnest(range(a, b + 1)) i from win join first using (t) where f < (doc_id, a)),
run as (select doc_id, min(i) a, max(i) + 1 b from (select doc_id, i, i - row_number() over (partition by doc_id order by i) g from gone) group by doc_id, g),
r as (select doc_id, sum(b - a) removed, count(*) n, string_agg(a || ':' || b, ',' order by a) runs from run group by 1),
kept as (select l.doc_id, string_agg(l.l, chr(10) order by l.k) t from l left join own o on o.doc_id = l.doc_id and o.k = l.k left join gone g on g.doc_id = o.doc_id and g.i = o.i where g.i is null group by 1),
n as (select doc_id, count(*) n from own group by 1)
select d.doc_id, coalesce(n.n, 0) n_lines, cast(coalesce(removed, 0) as bigint) n_removed, coalesce(r.n, 0) n_runs, coalesce(runs, '') runs, sha256(coalesce(kept.t, '')) kept_sha256
from documents d left join n using (doc_id) left join r using (doc_id) left join kept using (doc_id)"""

#: All anchors against all rows.
HARD_NEGATIVES = """
with r as (select vec_id id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end l, list_transform(embedding, lambda x: floor(256 * cast(x as double))) v from embeddings
 where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.id a, b.id b, a.l = b.l same, cast(list_dot_product(a.v, b.v) as bigint) s from r a join r b on a.id % 50 = 0 and a.id <> b.id),
pos as (select a, b p, s ps from s where same qualify row_number() over (partition by a order by s desc, b) <= 5),
neg as (select pos.a, p, ps, s.b n, s.s ns, row_number() over (partition by pos.a, p order by s.s desc, s.b) k from pos join s on s.a = pos.a and not s.same and 50 * ps <= 100 * s.s and 100 * s.s <= 95 * ps)
select a anchor_id, p positive_id, cast(k as int) "rank", n negative_id, ps positive_score, ns negative_score from neg where k <= 3"""

#: Every stretch of six words that is found again a period later; neighbouring ones make a run.
PERIODIC_RUNS = r"""
with h as (select doc_id, text, xor(list_reduce(list_prepend(4294967295::ubigint, list_transform(string_split(cast(doc_id as varchar), ''), lambda c: ascii(c)::ubigint)),
  lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384::ubigint * (x & 1)))), 4294967295::ubigint) h from documents),
o as (select doc_id, h, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w from h),
z as (select doc_id, w, h % 10 = 0 and len(w) > 0 alt, len(w) n, cast((h // 10) % greatest(len(w), 1) as bigint) a, cast((h // 10) % 8 as bigint) g from o),
d as (select doc_id, n, case when alt then list_transform(range(0, n), lambda i: w[1 + (case when i < a then i else a + (i - a) % (1 + (n - a) // (3 + g)) end)]) else w end w from z),
six as (select doc_id, n, i, array_to_string(w[i + 1 : i + 6], ' ') s from (select doc_id, n, w, unnest(range(0, n - 5)) i from d where n >= 12)),
twice as (select x.doc_id, x.i, y.i - x.i p from six x join six y on x.doc_id = y.doc_id and x.s = y.s and y.i > x.i and 2 * (y.i - x.i) <= x.n),
own as (select doc_id, p, min(i) s, max(i) + 6 + p - min(i) len from (select *, i - row_number() over (partition by doc_id, p order by i) k from twice) group by doc_id, p, k),
run as (select doc_id, s, len, min(p) p from own where len >= greatest(12, 2 * p) group by doc_id, s, len),
best as (select *, row_number() over (partition by doc_id order by len desc, s, p) k from run),
said as (select doc_id, count(*) n, string_agg(s || ',' || len || ',' || p || chr(10), '' order by s, p) t from run group by 1),
gone as (select distinct doc_id, unnest(range(s + p, s + len)) i from run),
kept as (select x.doc_id, string_agg(x.t, ' ' order by x.i) t from (select doc_id, unnest(w) t, generate_subscripts(w, 1) - 1 i from d) x left join gone using (doc_id, i) where gone.doc_id is null group by 1)
select d.doc_id, coalesce(said.n, 0) n_runs, s "start", len "length", p "period", 1000 * len // p exponent_milli, sha256(coalesce(said.t, '')) runs_sha256, sha256(coalesce(kept.t, '')) collapsed_sha256
from d left join said using (doc_id) left join (select * from best where k = 1) b using (doc_id) left join kept using (doc_id)"""
