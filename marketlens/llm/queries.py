"""The queries of the subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from marketlens.llm import (
    alignment,
    chat,
    codes,
    decontamination,
    fingerprints,
    language,
    licenses,
    neighbours,
    packing,
    pages,
    quality,
    simhash,
    substrings,
)

_OPERATORS = [
    neighbours.op1_nearest_neighbours,
    pages.op4_html_extraction,
    packing.op10_best_fit_packing,
    licenses.op2_license_scan,
    quality.op5_quality_classifier,
    language.op8_language_id,
    substrings.op6_substring_dedup,
    simhash.op3_simhash_near_dedup,
    decontamination.op7_benchmark_decontamination,
    chat.op9_chat_formatting,
    codes.op11_vector_codes,
    fingerprints.op12_document_fingerprints,
    alignment.op13_tokenizer_alignment,
]

_CHAT_SQL = r"""
with rows as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), shown as (
    select *,
        replace(replace(replace(role, '\', '\b'), '<', '\l'), '[', '\s') as role_shown,
        replace(replace(replace(text, '\', '\b'), '<', '\l'), '[', '\s') as text_shown
    from rows
)
select conv_id,
    count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
    coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
    sum(length(replace(role_shown, chr(10), '\n')) + length(text_shown) + 10)::bigint as formatted_chars
from shown group by conv_id
"""


#: Entries start as the parts of the 64 smallest ids; two rounds; parts assigned again.
_CODES_SQL = """
with kept as (
    select vec_id, label, [floor(256 * x::double)::bigint for x in embedding] as v, len(embedding) // 16 as w
    from embeddings
    where embedding is not null and len(embedding) > 0
      and len([x for x in embedding if x is null or not isfinite(x)]) = 0
), cells as (
    select vec_id, label, part, place, v[part * w + place + 1] as x
    from kept, range(16) as p(part), range(1024) as c(place) where place < w
), seeds as (
    select vec_id, row_number() over (order by vec_id) - 1 as entry from kept order by vec_id limit 64
), book0 as (
    select entry, part, place, x as y from cells join seeds using (vec_id)
)"""
_CODES_ROUND = """, near{n} as (
    select vec_id, part, min(d * 64 + entry) as best from (
        select vec_id, part, entry, sum((x - y) * (x - y))::bigint as d
        from cells join book{n} using (part, place) group by vec_id, part, entry
    ) group by vec_id, part
)"""
_CODES_MOVE = """, sums{n} as (
    select best % 64 as entry, part, place, sum(x)::bigint as s, count(*) as n
    from near{n} join cells using (vec_id, part) group by all
), book{m} as (
    select entry, part, place, coalesce((s - ((s % n) + n) % n) // n, y) as y
    from book{n} left join sums{n} using (entry, part, place)
)"""
_CODES_END = """, found as (
    select vec_id, string_agg(printf('%02x', (best % 64)::int), '' order by part) as code, sum(best // 64)::bigint as error
    from near2 group by vec_id
), books as (
    select sha256(string_agg(y::bigint::string, ',' order by part, entry, place)) as codebooks_sha256 from book2
)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256
from found join kept using (vec_id), books
"""


def _codes_sql() -> str:
    rounds = "".join(_CODES_ROUND.format(n=n) + _CODES_MOVE.format(n=n, m=n + 1) for n in (0, 1))
    return _CODES_SQL + rounds + _CODES_ROUND.format(n=2) + _CODES_END


def registered() -> dict:
    return {function.__name__: function for function in _OPERATORS}


def oracle_sql() -> dict[str, str]:
    return {"op9_chat_formatting": _CHAT_SQL, "op11_vector_codes": _codes_sql()}
