"""The registered queries of this subpackage, and SQL answers where SQL can express them."""

from __future__ import annotations

from statmart.llm.ball_tree import op4_exact_top_k
from statmart.llm.chat_format import op10_chat_perspectives
from statmart.llm.cross_polytope import op13_embedding_near_dedup
from statmart.llm.divergence import DIVERGENCE_SQL, op11_source_divergence
from statmart.llm.fill_middle import FILL_IN_MIDDLE_SQL, op12_fill_in_middle
from statmart.llm.html_text import op3_html_text
from statmart.llm.language_id import op2_language_id
from statmart.llm.near_dedup import op1_minhash_near_dedup
from statmart.llm.packing import op5_best_fit_packing
from statmart.llm.pieces import op8_sentencepiece
from statmart.llm.quality_model import op9_quality_classifier
from statmart.llm.quality_rules import op6_quality_rules
from statmart.llm.url_filter import RULES, op7_url_filter

QUERIES = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_language_id": op2_language_id,
    "op3_html_text": op3_html_text,
    "op4_exact_top_k": op4_exact_top_k,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_quality_rules": op6_quality_rules,
    "op7_url_filter": op7_url_filter,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_chat_perspectives": op10_chat_perspectives,
    "op11_source_divergence": op11_source_divergence,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_embedding_near_dedup": op13_embedding_near_dedup,
}


def _url_filter_sql() -> str:
    rules = ", ".join(f"('{rule}', '{verdict}')" for rule, verdict in RULES)
    return rf"""
with rules(rule, verdict) as (values {rules}),
split as (
    select page_id,
           coalesce(case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) end, '') as rest
    from pages
),
parts as (
    select page_id,
           translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path,
           row_number() over () as nr
    from split
),
fits as (
    select nr, rule, verdict, row_number() over (partition by nr order by length(rule) desc, rule desc) as best
    from parts, rules
    where (host = split_part(rule, '/', 1) or ends_with(host, '.' || split_part(rule, '/', 1)))
      and starts_with(path, substr(rule, strpos(rule, '/')))
)
select p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') as verdict
from parts p left join fits f on f.nr = p.nr and f.best = 1
"""


TOP_K_SQL = """
with whole as (
    select row_number() over () as nr, vec_id,
           list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as q
    from embeddings
    where vec_id is not null and len(embedding) > 0
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
scored as (
    select a.nr, a.vec_id as query_id, b.vec_id,
           cast(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) as bigint) as score
    from whole a join whole b on a.nr <> b.nr and len(a.q) = len(b.q)
    where a.vec_id % 50 = 0
)
select query_id, cast(row_number() over (partition by nr order by score desc, vec_id) as integer) as rank, vec_id, score
from scored
qualify rank <= 5
"""

CHAT_SQL = """
with turns as (
    select conv_id, turn, role, text, replace(coalesce(text, ''), '<|', '<||') as body,
           row_number() over (partition by conv_id order by turn nulls first, role nulls first, text nulls first) - 1 as seq
    from conversations
),
speakers as (select distinct conv_id, role as participant from conversations where role is not null and role <> 'system'),
seen as (
    select t.conv_id, s.participant, t.seq, t.turn, t.role as speaker, coalesce(t.role = s.participant, false) as is_assistant,
           case when t.role = s.participant then '<|assistant|>' || chr(10)
                when t.role = 'system' then '<|system|>' || chr(10)
                when t.role is null then '<|user|>' || chr(10)
                else '<|user name=' || replace(t.role, '<|', '<||') || '|>' || chr(10) end as marker,
           body
    from turns t join speakers s on t.conv_id is not distinct from s.conv_id
),
written as (select *, marker || body || '<|end|>' || chr(10) as segment from seen),
placed as (
    select *, cast(sum(length(segment)) over (partition by conv_id, participant order by seq) as bigint) as ending from written
)
select conv_id, participant, seq, turn, speaker, is_assistant, segment, ending - length(segment) as start, ending as "end",
       case when is_assistant then ending - length(segment) + length(marker) end as train_start,
       case when is_assistant then ending - 1 end as train_end
from placed
"""

ORACLE = {
    "op4_exact_top_k": TOP_K_SQL,
    "op7_url_filter": _url_filter_sql(),
    "op10_chat_perspectives": CHAT_SQL,
    "op11_source_divergence": DIVERGENCE_SQL,
    "op12_fill_in_middle": FILL_IN_MIDDLE_SQL,
}
