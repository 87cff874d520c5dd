"""The queries in DuckDB's SQL, where SQL expresses them."""

from __future__ import annotations

from ledgerlens.llm import sharding

UNIFORM = "cast(cast('0x' || substr(md5({}), 1, 13) as bigint) as double) / 4503599627370496.0"

MIX_SOURCES = f"""
with counts as (select source as src, count(*) as n from documents group by source),
rates as (
  select src, rate, cast(greatest(1, ceil(rate / 16.0)) as int) as parts, rate / greatest(1, ceil(rate / 16.0)) as mean
  from (select src, (select sum(n) from counts) / (select count(*) from counts) / n as rate from counts)
),
cumulative as (
  select src, k, sum(case when mean = 0 then (k = 0)::int else exp(k * ln(mean) - mean - lgamma(k + 1.0)) end)
    over (partition by src order by k) as p
  from rates, range(97) as r(k)
),
row_hashes as (
  select *, md5(concat_ws(':', coalesce(cast(doc_id as varchar), '~'), coalesce(md5(text), '~'))) as h from documents
),
draws as (
  select d.h, count(c.k) as n
  from row_hashes d join rates r on d.source is not distinct from r.src, range(1, 1000) as j(j), cumulative c
  where j.j <= r.parts and c.src is not distinct from r.src
    and c.p <= {UNIFORM.format("concat_ws(':', '2', d.h, cast(j.j as varchar))")}
  group by d.h, d.doc_id, d.text
),
copies as (
  select d.doc_id, d.text, d.lang, d.source, d.n_chars, r.rate, cast(w.n as int) as copies, d.h
  from row_hashes d join draws w on d.h = w.h join rates r on d.source is not distinct from r.src
)
select doc_id, text, lang, source, n_chars, rate, copies, cast(c as int) as copy,
  md5('shuffle 2:' || h || ':' || cast(c as varchar)) as shuffle_key
from (select *, unnest(range(copies)) as c from copies)
"""

# Fixed value: the polynomial of CRC-32, bits reversed.
CRC_POLYNOMIAL = 0xEDB88320


def _crc_table() -> list[int]:
    table = []
    for byte in range(256):
        for _ in range(8):
            byte = (byte >> 1) ^ (CRC_POLYNOMIAL if byte & 1 else 0)
        table.append(byte)
    return table


def feistel_shards() -> str:
    """Rows by doc_id through the rounds one by one; the few beyond the last row number go on in the recursion."""
    rounds = []
    for i, (a, b, c) in enumerate(sharding._round_keys(20)):
        moved, other, size = ("hi", "lo", "high") if i % 2 == 0 else ("lo", "hi", "low")
        mixed = f"((({other} * {a} + {b}) % {sharding.PRIME} * {c} % {sharding.SECOND_PRIME}) >> 3)"
        rounds.append((moved, f"({moved} + {mixed} % {size}) % {size}"))
    inner = "select i, n, high, low, x // low as hi, x % low as lo from {}"
    for moved, value in rounds:
        kept = "lo" if moved == "hi" else "hi"
        inner = f"select i, n, high, low, {value} as {moved}, {kept} from ({inner})"
    step = f"select i, n, high, low, hi * low + lo as x from ({inner})"
    table = "[" + ", ".join(map(str, _crc_table())) + "]"
    return f"""
with recursive numbered as (
  select *, row_number() over (order by doc_id) - 1 as i, count(*) over () as n from documents
),
grid as (
  select i, n, high, cast(ceil(n / high) as bigint) as low, i as x
  from (select i, n, cast(ceil(sqrt(n)) as bigint) as high from numbered)
),
walk as (
  {step.format("grid")}
  union all
  {step.format("(select * from walk where x >= n)")}
),
checksums as (
  select i, xor(list_reduce(list_prepend(4294967295::bigint, string_split(trim(regexp_replace(hex(encode(coalesce(text, ''))), '(..)', '\\1 ', 'g')), ' ')
    .list_filter(lambda h: h <> '').list_transform(lambda h: cast('0x' || h as bigint))),
    lambda crc, byte: xor(crc >> 8, ({table}::bigint[])[(xor(crc, byte) & 255) + 1])), 4294967295::bigint) as crc
  from numbered
)
select d.doc_id, cast(strlen(coalesce(d.text, '')) + 1 as bigint) as size, c.crc as text_crc32, 'rows' as law,
  cast(w.x % 8 as int) as shard, cast(w.x // 8 as bigint) as slot, cast(null as int) as grown_shard
from numbered d join walk w on w.i = d.i and w.x < w.n join checksums c on c.i = d.i
"""


def _crc(text: str) -> str:
    """CRC-32 of a text that is not empty, byte by byte."""
    table = "[" + ", ".join(map(str, _crc_table())) + "]"
    return f"""xor(list_reduce(list_prepend(4294967295::bigint, list_transform(
    list_filter(string_split(trim(regexp_replace(hex(encode({text})), '(..)', '\\1 ', 'g')), ' '), lambda h: h <> ''),
    lambda h: cast('0x' || h as bigint))),
    lambda crc, byte: xor(crc >> 8, ({table}::bigint[])[(xor(crc, byte) & 255) + 1])), 4294967295::bigint)"""


# What the repaired rows may end in (n nothing, s, u, a), an initial and where it leads; and the inserts between two ends.
FOLLOWS = (("n", "s", "s"), ("n", "u", "u"), ("s", "u", "u"), ("a", "u", "u"), ("u", "a", "a"))
INSERTS = {"n": ("", "u", "ua"), "s": ("", "u", "ua"), "u": ("", "a", "au"), "a": ("", "u", "ua")}
CLOSINGS = {"n": "", "s": "ua", "u": "a", "a": ""}


def _lines(initials: str) -> str:
    """Empty rows of these roles, each on a new line."""
    return " || ".join(["''", *["chr(10) || '" + {"u": "user:", "a": "assistant:"}[i] + "'" for i in initials]])


def conversation_repair() -> str:
    """All ways to edit a conversation row by row, of which each step keeps the best for every end."""
    edits = []
    for before, many in INSERTS.items():
        edits.append(f"('{before}', '{before}', 'D', '', 3, '')")
        for inserted in many:
            at = inserted[-1] if inserted else before
            for end, initial, after in FOLLOWS:
                if end != at:
                    continue
                lines, cost, letters = _lines(inserted), 2 * len(inserted), "I" * len(inserted)
                edits.append(f"('{before}', '{after}', '{letters}K', '{initial}', {cost}, {lines})")
                if initial != "s":
                    edits.append(f"('{before}', '{after}', '{letters}R', '{initial}', {cost + 2}, {lines})")
    closings = [f"('{end}', {2 * len(c)}, '{'I' * len(c)}', {_lines(c)})" for end, c in CLOSINGS.items()]
    word = "[^\\x20\\x09-\\x0D]"
    return f"""
with recursive edits(before, after, edit, initial, cost, lines) as (values {', '.join(edits)}),
closings(ending, cost, edit, lines) as (values {', '.join(closings)}),
summed as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    {_crc("coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ')")} % 20 as fault
  from conversations),
damaged as (
  select conv_id, turn, case when fault = 4 then 'user' else role end as role,
    case fault when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
  from summed, range(2) as t(copy) where fault <> 0 and (copy = 0 or fault = 3)),
placed as materialized (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as k from damaged),
judged as materialized (
  select conv_id, turn, role, text, k, left(role, 1) as initial,
    lag(left(role, 1)) over (partition by conv_id order by k) as before,
    case when not regexp_matches(text, '{word}') then 'blank'
      when row_number() over (partition by conv_id, role, text order by k) > 1 then 'duplicate'
      when not regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') then 'truncated' else '' end as kind
  from placed),
walk as (
  select distinct conv_id, cast(0 as bigint) as k, 'n' as ending,
    {{'cost': cast(0 as bigint), 'audit': '', 'body': ''}} as best from conversations
  union all
  select conv_id, k, after, min({{'cost': cost, 'audit': audit, 'body': body}}) from (
    select r.conv_id, r.k, e.after, cast(w.best.cost + e.cost + case when e.edit <> 'D' and r.kind = 'truncated' then 1 else 0 end as bigint) as cost,
      w.best.audit || e.edit as audit,
      case when e.edit = 'D' then w.best.body else w.best.body || e.lines || chr(10)
        || case when e.edit not like '%R' then r.role when e.initial = 'u' then 'user' else 'assistant' end || ':' || r.text end as body
    from walk w join judged r on r.conv_id is not distinct from w.conv_id and r.k = w.k + 1 join edits e on e.before = w.ending
    where e.edit = 'D' or (r.kind not in ('blank', 'duplicate') and (e.edit like '%R' or e.initial = r.initial)))
  group by conv_id, k, after),
faults as (
  select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count(*) filter (where kind = 'blank') as blank, count(*) filter (where kind = 'duplicate') as duplicate,
    count(*) filter (where kind = 'truncated') as truncated,
    count(*) filter (where before is not null and before || initial not in ('su', 'ua', 'au')) as illegal
  from judged group by conv_id),
ends as (
  select w.conv_id, min({{'cost': w.best.cost + c.cost, 'audit': w.best.audit || c.edit, 'body': w.best.body || c.lines}}) as best
  from walk w join closings c using (ending) left join faults f on f.conv_id is not distinct from w.conv_id
  where w.k = coalesce(f.n, 0) group by w.conv_id)
select e.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
  coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, cast(e.best.cost as bigint) as cost,
  e.best.audit as audit, sha256(substr(e.best.body, 2)) as repaired_sha256
from ends e left join faults f on f.conv_id is not distinct from e.conv_id"""


def vector_codes() -> str:
    """Lloyd's rounds one after the other, every part against every entry; vectors of 8 equal parts."""
    distance = "list_sum(list_transform(list_zip(a.part, b.part), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    ctes = [
        """ints as materialized (
  select row_number() over (order by vec_id nulls last) as r, vec_id, label,
    list_transform(embedding, lambda x: cast(floor(4096 * cast(x as double)) as bigint)) as v
  from embeddings
  where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding))""",
        """parts as materialized (
  select r, p, v[p * (len(v) // 8) + 1 : (p + 1) * (len(v) // 8)] as part from ints, range(8) as t(p))""",
        "book0 as materialized (select p, r - 1 as e, part from parts where r <= 16)",
    ]
    for k in range(7):
        ctes.append(
            f"""near{k} as materialized (
  select a.r, a.p, any_value(a.part) as part, arg_min(b.e, {distance} * 16 + b.e) as e, min({distance}) as d
  from parts a join book{k} b on a.p = b.p group by a.r, a.p)"""
        )
        if k < 6:
            ctes.append(
                f"""book{k + 1} as materialized (
  select b.p, b.e, coalesce(m.part, b.part) as part from book{k} b left join (
    select p, e, list((s - ((s % n + n) % n)) // n order by i) as part from (
      select p, e, i, cast(sum(x) as bigint) as s, count(*) as n from (
        select p, e, unnest(part) as x, generate_subscripts(part, 1) as i from near{k}) group by p, e, i)
    group by p, e) m on b.p = m.p and b.e = m.e)"""
            )
    text = ",\n".join(ctes)
    return f"""with {text},
codes as (
  select r, string_agg(format('{{:02x}}', e), '' order by p) as code, cast(sum(d) as bigint) as error from near6 group by r),
digest as (
  select sha256(string_agg(cast(c as varchar), ',' order by p, e, i)) as codebooks_sha256 from (
    select p, e, unnest(part) as c, generate_subscripts(part, 1) as i from book6))
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256
from ints join codes using (r), digest"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_mix_sources": MIX_SOURCES,
        "op5_feistel_shards": feistel_shards(),
        "op11_conversation_repair": conversation_repair(),
        "op12_vector_codes": vector_codes(),
    }
