"""SQL for DuckDB with the results of those queries that SQL can express."""

from __future__ import annotations

from stayline.llm.licenses import LICENSES

#: The least share of a template's shingles.
CONTAINMENT = 0.8

#: Distinct five-word shingles of a text; a text of fewer words is one shingle.
SHINGLES = r"""
word_lists as (
  select doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9_\x{{80}}-\x{{10FFFF}}]+') as w from {table}),
sets as (
  select distinct doc_id, array_to_string(w[i : i + 4], ' ') as shingle
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) as i from word_lists))"""


def _near() -> str:
    return f"""with recursive {SHINGLES.format(table="documents")},
        sizes as (select doc_id, count(*) as n from sets group by doc_id),
        pairs as (select a.doc_id as x, b.doc_id as y, count(*) as common from sets a join sets b using (shingle)
          where a.doc_id <> b.doc_id group by all),
        links as (select x, y, common = s.n and common = t.n as same from pairs
          join sizes s on s.doc_id = x join sizes t on t.doc_id = y where 5 * common >= 4 * (s.n + t.n - common)),
        reach as (select doc_id as x, doc_id as y from documents
          union select r.x, l.y from reach r join links l on l.x = r.y),
        heads as (select x, min(y) as head from reach group by x),
        counted as (select x, count(*) as n, min(y) filter (where same) as twin from links group by x)
        select d.doc_id, least(d.doc_id, coalesce(c.twin, d.doc_id)) as class_id, h.head as group_id,
          coalesce(c.n, 0) as n_links, d.doc_id = h.head as kept
        from documents d join heads h on h.x = d.doc_id left join counted c on c.x = d.doc_id"""


def _licenses() -> str:
    """Templates at five words, or at their own number if they have fewer, against the texts' shingles of that number."""
    listed = ", ".join("({}, '{}', '{}')".format(i, name, text.replace("'", "''")) for i, (name, text) in enumerate(LICENSES))
    word = r"'[a-z0-9_\x{80}-\x{10FFFF}]+'"
    return f"""with templates as (
          select i, license, regexp_extract_all(lower(body), {word}) as w from (values {listed}) as v(i, license, body)),
        wanted as (select distinct i, k, array_to_string(w[p : p + k - 1], ' ') as shingle
          from (select i, w, k, unnest(range(1, len(w) - k + 2)) as p
            from (select i, w, least(len(w), 5) as k from templates))),
        sizes as (select i, count(*) as n from wanted group by i),
        texts as (select doc_id, regexp_extract_all(lower(coalesce(text, '')), {word}) as w from documents),
        had as (select distinct doc_id, k, array_to_string(w[p : p + k - 1], ' ') as shingle
          from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as p
            from texts, (select distinct k from wanted) where len(w) >= k)),
        held as (select doc_id, i, count(*) as n from had join wanted using (k, shingle) group by all)
        select doc_id, license, max(held.n::double / sizes.n) as containment
        from held join sizes using (i) join templates using (i) where held.n >= {CONTAINMENT} * sizes.n
        group by doc_id, license"""


def _repeats(length: int = 200) -> str:
    return f"""with d as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
        windows as (select doc_id, p, md5(substr(h, 2 * p + 1, {2 * length})) as k
          from (select doc_id, h, unnest(range(0, len(h) // 2 - {length - 1})) as p from d)),
        hits as (select doc_id, p from (select doc_id, p, count(*) over (partition by k) as n from windows) where n > 1),
        runs as (select doc_id, min(p) as a, max(p) + {length} as b from (
            select doc_id, p, sum(fresh) over (partition by doc_id order by p) as run from (
              select doc_id, p, (p > coalesce(lag(p) over (partition by doc_id order by p), -1000000) + {length})::int as fresh
              from hits)) group by doc_id, run),
        gaps as (select doc_id, a, b, coalesce(lag(b) over (partition by doc_id order by a), 0) as since from runs),
        heads as (select doc_id, count(*) as n_spans, sum(b - a) as n_removed, max(b) as stop,
            string_agg(substr(h, 2 * since + 1, 2 * (a - since)), '' order by a) as kept
          from gaps join d using (doc_id) group by doc_id)
        select doc_id, len(h) // 2 as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0) as n_spans,
          sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(stop, 0) + 1))) as kept_sha256
        from d left join heads using (doc_id)"""


def _conversations() -> str:
    """The best edits from each row on, from the last row up: cost, letters and repaired rows per state."""
    def least(*options: str) -> str:
        return f"list_sort({' || '.join(options)})[1]"

    def put(cost: str, letter: str, role: str, text: str, rest: str) -> str:
        return (f"{{'c': {cost} + {rest}.c, 'a': '{letter}' || {rest}.a, "
                f"'t': chr(10) || {role} || ':' || {text} || {rest}.t}}")

    follows = {0: 2, 1: 2, 2: 3, 3: 2}
    roles = {q: "'assistant'" if q == 2 else "'user'" for q in range(4)}
    kept = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    rows, inserts = [], {}
    for q in range(4):
        options = [f"[{{'c': 3 + q{q}.c, 'a': 'D' || q{q}.a, 't': q{q}.t}}]"]
        for initial, to in kept[q].items():
            options.append(f"case when stays and initial = '{initial}' then [{put('cut', 'K', 'role', 'text', f'q{to}')}] "
                           "else [] end")
        options.append(f"case when stays then [{put('2 + cut', 'R', roles[q], 'text', f'q{follows[q]}')}] else [] end")
        rows.append(f"{least(*options)} as w{q}")
    inserts = {q: "[" + put("2", "I", roles[q], "''", f"{'v' if q < 2 else 'w'}{follows[q]}") + "]" for q in range(4)}
    ends = {0: "{'c': 0, 'a': '', 't': ''}", 2: put("2", "I", roles[2], "''", "{'c': 0, 'a': '', 't': ''}"),
            3: "{'c': 0, 'a': '', 't': ''}"}
    ends[1] = put("2", "I", roles[1], "''", f"({ends[2]})")
    return f"""with recursive crc as (select list_transform(range(256), lambda n : list_reduce(range(8),
              lambda c, x : case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end, n)) as t),
        marked as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
            xor(4294967295, list_reduce(
              list_transform(string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''),
                lambda k : unicode(k)::bigint),
              lambda c, b : xor(t[(xor(c, b) & 255) + 1], c >> 8), 4294967295::bigint)) % 20 as kind
          from conversations, crc),
        damaged as (select conv_id, turn, case when kind = 4 then 'user' else role end as role,
            case when kind = 1 then '' when kind = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
            unnest(range(case when kind = 3 then 2 else 1 end)) as copy
          from marked where kind <> 0),
        placed as (select *, row_number() over w as i, count(*) over (partition by conv_id) as n,
            row_number() over (partition by conv_id, role, text order by turn nulls first, copy) > 1 as seen,
            substr(role, 1, 1) as initial, lag(substr(role, 1, 1)) over w as earlier,
            regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) as ending
          from damaged window w as (partition by conv_id order by turn nulls first, role, sha256(text), copy)),
        faults as (select *, ending = '' as blank, ending <> '' and seen as duplicate,
            ending <> '' and not seen and ending not in ('.', '!', '?') as truncated,
            ending <> '' and not seen as stays, truncated::int as cut from placed),
        best as (
          select distinct conv_id, n + 1 as i, {", ".join(f"{ends[q]} as q{q}" for q in range(4))} from faults
          union all
          select conv_id, i, v0, v1, v2, v3 from (
            select *, {least("[w0]", inserts[0])} as v0, {least("[w1]", inserts[1])} as v1 from (
              select *, {least("[w2]", inserts[2])} as v2, {least("[w3]", inserts[3])} as v3 from (
                select f.conv_id, f.i, {", ".join(rows)}
                from best b join faults f on f.conv_id is not distinct from b.conv_id and f.i = b.i - 1)))),
        counted as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
            count(*) filter (where blank) as blank, count(*) filter (where duplicate) as duplicate,
            count(*) filter (where truncated) as truncated,
            count(*) filter (where i > 1 and earlier || initial not in ('su', 'ua', 'au')) as illegal
          from faults group by conv_id)
        select c.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank,
          coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated,
          coalesce(illegal, 0)::bigint as illegal, coalesce(q0.c, 0)::bigint as cost, coalesce(q0.a, '') as audit,
          sha256(coalesce(substr(q0.t, 2), '')) as repaired_sha256
        from (select distinct conv_id from conversations) c
          left join counted k on k.conv_id is not distinct from c.conv_id
          left join best b on b.conv_id is not distinct from c.conv_id and b.i = 1"""


def _filters() -> str:
    return """with words as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as t,
            regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents),
        marks as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id),
        docs as (select part, [len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w),
              100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * len(t), regexp_matches(t, '[#$%&*|]'),
              coalesce(words.doc_id > min(words.doc_id) over (partition by t), false)] as f,
            coalesce(good, 0) as good, coalesce(toxic, 0) as toxic
          from words left join marks on marks.doc_id = words.doc_id),
        kinds as (select part, f, count(*) as n, sum(good) as good, sum(toxic) as toxic from docs group by all),
        letters as (select unnest(range(1, 6)) as i),
        orders as (select [a.i, b.i, c.i, d.i, e.i] as o
          from letters a, letters b, letters c, letters d, letters e
          where len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
        steps as (select o, step, o[step] as own, o[1 : step - 1] as earlier from orders, range(1, 6) as s(step)),
        met as (select part, o, step, own, n, good, toxic, f[own] as fails, len(list_filter(f, lambda x : x)) = 1 as alone,
            len(list_filter(earlier, lambda x : f[x])) > 0 as out from kinds, steps),
        rows as (select part, o, step, own,
            sum(n) filter (where not out and not fails) as kept, sum(n) filter (where not out and fails) as removed,
            sum(n) filter (where out and fails) as redundant, sum(n) filter (where fails and alone) as unique_fails,
            sum(good) filter (where not out and fails) as good_lost,
            sum(toxic) filter (where not out and fails) as toxic_lost
          from met group by all)
        select part, array_to_string(list_transform(o, lambda x : 'ABCDE'[x]), '') as filter_order, step::int as step,
          coalesce(kept, 0)::bigint as kept, coalesce(removed, 0)::bigint as removed,
          coalesce(redundant, 0)::bigint as redundant, coalesce(unique_fails, 0)::bigint as unique_fails,
          coalesce(good_lost, 0)::bigint as good_lost, coalesce(toxic_lost, 0)::bigint as toxic_lost,
          sum(coalesce(removed, 0)) over (partition by part, own)::bigint as shapley
        from rows"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_jaccard_forest": _near(),
        "op4_stream_dedup": """
            with d as (select doc_id, coalesce(text, '') as t from documents)
            select doc_id, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
                   doc_id = max(doc_id) over (partition by t) as kept, sha256(t) as text_sha256
            from d""",
        "op6_license_scan": _licenses(),
        "op10_suffix_dedup": _repeats(),
        "op11_conversation_repair": _conversations(),
        "op13_filter_audit": _filters(),
    }
