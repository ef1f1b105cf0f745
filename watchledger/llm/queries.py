"""The registered queries of this subpackage, and their SQL where it can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from watchledger.llm import (
    chat,
    conversation_repair,
    decontamination,
    exact_dedup,
    filter_audit,
    mixing,
    quality,
    secret_scan,
    simhash,
    token_counts,
    topk,
    toxicity,
    warc,
)
from watchledger.llm.common import held_out, scratch_for, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``function(spark, folder) -> DataFrame`` under ``name``."""

    def add(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return add


# -- 1 -----------------------------------------------------------------------

_MIX_SQL = r"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
         coalesce(doc_id::varchar, 'text:' || md5(coalesce(text, ''))) as draw_key
  from documents),
sources as (
  select source, sum(size)::bigint as source_size from sized group by source),
weighted as (
  select *, 3.0::double * source_size as most,
         [5.0::double, 2.0::double, 1.0::double][
           1 + ((row_number() over (order by source asc nulls last)) - 1) % 3] as weight
  from sources),
levels as (
  select *, ((sum(source_size) over ())::double
      - coalesce(sum(most) over (order by most / weight, source asc nulls last
          rows between unbounded preceding and 1 preceding), 0))
      / sum(weight) over (order by most / weight, source asc nulls last
          rows between current row and unbounded following) as level
  from weighted),
targets as (
  select source, source_size, least(most, (max(level) over ()) * weight) as target from levels),
rates as (
  select doc_id, size, source_size, target, draw_key,
         case when source_size > 0 then target / source_size else 0 end as rate
  from sized join targets on sized.source is not distinct from targets.source)
select doc_id, size, source_size, target,
  (size * (floor(rate) + case when
     ('0x' || substr(md5('17:' || draw_key), 1, 13))::bigint / 4503599627370496.0::double < rate - floor(rate)
     then 1 else 0 end))::bigint as taken
from rates
"""


@query("op1_mix_sources", _MIX_SQL)
def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    planned = mixing.mix_plan(docs)
    return planned.select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        (F.col("mix_size") * F.col("mix_copies")).cast("long").alias("taken"),
    )


# -- 2 -----------------------------------------------------------------------

TOKENIZER = "word_bpe_49k.json"
TOKEN_LIMIT = 2048


@query("op2_token_counts")
def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, folder, "documents")
    counted = token_counts.token_counts(docs, public_tokenizers.path(TOKENIZER))
    return counted.select("*", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


# -- 3 -----------------------------------------------------------------------

_CHAT_SQL = r"""
with ordered as (
  select conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
    order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as turns
  from conversations where conv_id is not null group by conv_id),
answered as (
  select conv_id, turns, list_filter(range(1, len(turns) + 1), lambda i: turns[i].role = 'assistant') as answers
  from ordered),
paired as (
  select conv_id, turns as chosen, list_transform(range(1, len(turns) + 1), lambda i: {
      'role': turns[i].role,
      'text': case when i = answers[-1]
        then coalesce(case when len(answers) > 1 then turns[answers[-2]].text end, '')
        else turns[i].text end}) as rejected
  from answered),
shared as (
  select *, coalesce(list_min(list_filter(range(1, len(chosen) + 1),
    lambda i: chosen[i] is distinct from rejected[i])) - 1, len(chosen))::int as n
  from paired),
cut as (
  select conv_id, n, chosen[1:n] as p, chosen[n + 1:] as c, rejected[n + 1:] as r from shared),
texts as (
  select conv_id, n, len(c) + len(r) = 0 as is_tie,
    list_transform([p, c, r], lambda ts: list_transform(ts, lambda t: '<|' || replace(t.role, '<|', '< |') || '|>' || chr(10))) as heads,
    list_transform([p, c, r], lambda ts: list_transform(ts, lambda t: replace(t.text, '<|', '< |') || '<|end|>')) as bodies,
    list_transform([p, c, r], lambda ts: list_transform(ts, lambda t: t.role = 'assistant')) as trained
  from cut),
placed as (
  select *,
    list_transform(range(1, 4), lambda k: array_to_string(list_transform(range(1, len(heads[k]) + 1),
      lambda i: heads[k][i] || bodies[k][i] || chr(10)), '')) as rendered,
    list_transform(range(1, 4), lambda k: array_to_string(list_transform(
      list_filter(range(1, len(heads[k]) + 1), lambda i: trained[k][i]),
      lambda i: (list_sum(list_transform(range(1, i + 1), lambda j: length(heads[k][j])))
          + coalesce(list_sum(list_transform(range(1, i), lambda j: length(bodies[k][j]) + 1)), 0))::bigint
        || ':' || (list_sum(list_transform(range(1, i + 1), lambda j: length(heads[k][j]) + length(bodies[k][j]))) + i - 1)::bigint),
      ',')) as masks
  from texts)
select conv_id, n::bigint as prompt_turns, rendered[1] as prompt, rendered[2] as chosen, masks[2] as chosen_mask,
  rendered[3] as rejected, masks[3] as rejected_mask, is_tie
from placed
"""


@query("op3_chat_preferences", _CHAT_SQL)
def op3_chat_preferences(spark: SparkSession, folder: str) -> DataFrame:
    whole = chat.conversations(table(spark, folder, "conversations"))
    formatted = chat.format_preferences(chat.stale_answers(whole))
    return formatted.select(
        "conv_id",
        F.col("prompt_turns").cast("long").alias("prompt_turns"),
        "prompt",
        "chosen",
        chat.listed(F.col("chosen_mask")).alias("chosen_mask"),
        "rejected",
        chat.listed(F.col("rejected_mask")).alias("rejected_mask"),
        "is_tie",
    )


# -- 4 -----------------------------------------------------------------------


@query("op4_toxicity")
def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    categories = {"poor": F.col("quality") == 0, "toxic": F.col("toxic") == 1}
    chain = toxicity.train(docs, table(spark, folder, "labels"), categories)
    return toxicity.score_documents(docs, chain).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("poor").alias("poor_score"),
        F.col("toxic").alias("score"),
        (F.col("toxic") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


# -- 5 -----------------------------------------------------------------------

_LEAKS_SQL = r"""
with words as (
  select 'd' as side, row_number() over () as row_no, doc_id as id,
    regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') as w
  from documents
  union all
  select 'i', row_number() over (), item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+')
  from benchmark),
sizes as (select distinct least(len(w), 5) as size from words where side = 'i' and len(w) > 0),
shingled as (
  select distinct side, row_no, id, s from (
    select side, row_no, id, unnest(list_transform(range(1, len(w) - size + 2),
      lambda i: array_to_string(w[i:i + size - 1], ' '))) as s
    from words, sizes
    where len(w) >= size and (side = 'd' or size = least(len(w), 5)))),
items as (select row_no, id as item_id, count(*) as n from shingled where side = 'i' group by all),
held as (
  select d.row_no as doc_no, d.id as doc_id, i.row_no as item_no, count(*) as n_found
  from shingled d join shingled i on d.s = i.s and d.side = 'd' and i.side = 'i'
  group by all)
select doc_id, item_id, n as n_shingles, n_found, n_found / n as containment
from held join items on items.row_no = held.item_no
where n_found >= greatest(ceil(n * 0.8::double - 1e-9), 1)
"""


@query("op5_benchmark_leaks", _LEAKS_SQL)
def op5_benchmark_leaks(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return decontamination.contaminated_documents(docs, table(spark, folder, "benchmark"))


# -- 6 -----------------------------------------------------------------------


@query("op6_quality")
def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, folder, "labels"))
    scored = quality.score_documents(docs, model)
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )


# -- 7 -----------------------------------------------------------------------


def _spans_sql(kind: int, pattern: str, keep: str = "true") -> str:
    """Spans of one kind from the pieces between matches and the matches."""
    return rf"""
  select row_no, doc_id, list_filter(list_transform(range(1, len(hits) + 1), lambda i: {{
      'start': (list_sum(list_transform(pieces[1:i], lambda p: length(p)))
        + coalesce(list_sum(list_transform(hits[1:i - 1], lambda h: length(h))), 0))::int,
      'kind': {kind},
      'end': (list_sum(list_transform(pieces[1:i], lambda p: length(p)))
        + list_sum(list_transform(hits[1:i], lambda h: length(h))))::int,
      'hit': hits[i]}}), lambda s: {keep}) as spans
  from (select row_no, doc_id, string_split_regex(t, {pattern}) as pieces, regexp_extract_all(t, {pattern}) as hits
        from whole)"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _secrets_sql() -> str:
    assign, hit, run = _quoted(secret_scan.ASSIGN), "s.hit", "g"
    candidate = _quoted(secret_scan.CANDIDATE)

    def allowed(text: str) -> str:
        return " or ".join(
            f"regexp_full_match({text}, {_quoted(p)})" for p in secret_scan.ALLOW
        )

    width = secret_scan.WINDOW
    entropy = (
        f"list_max(list_transform(range(1, greatest(length({run}) - {width - 1}, 1) + 1),"
        f" lambda j: list_entropy(string_split(substr({run}, j, {width}), ''))))"
    )
    # Each run of a class, as if it stood alone; no shorter than a window.
    random = " or ".join(
        f"len(list_filter(regexp_extract_all({hit}, {_quoted(c.pattern)}), lambda {run}:"
        f" length({run}) >= least(length({hit}), {width}) and not ({allowed(run)})"
        f" and {entropy} >= {c.threshold})) > 0"
        for c in secret_scan.CLASSES
    )
    kinds = ", ".join(_quoted(k) for k in secret_scan.KINDS)
    joined = f"[{kinds}][s.kind + 1] || ':' || s.start || ':' || s.end"
    parts = " union all ".join(
        [
            _spans_sql(0, assign, f"length(regexp_extract({hit}, {assign}, 2)) >= 12"),
            _spans_sql(1, _quoted(secret_scan.ACCESS)),
            _spans_sql(2, _quoted(secret_scan.HEX)),
            _spans_sql(3, candidate, f"not ({allowed(hit)}) and ({random})"),
        ]
    )
    return f"""
with whole as (select row_number() over () as row_no, doc_id, coalesce(text, '') as t from documents),
found as ({parts}),
merged as (
  select doc_id, list_sort(flatten(list(spans))) as spans from found group by row_no, doc_id)
select doc_id,
  len(list_filter(spans, lambda s: s.kind = 0)) as n_assign,
  len(list_filter(spans, lambda s: s.kind = 1)) as n_access,
  len(list_filter(spans, lambda s: s.kind = 2)) as n_hex,
  sha256(array_to_string(list_transform(list_filter(spans, lambda s: s.kind < 3),
    lambda s: {joined}), ',')) as base_sha256,
  array_to_string(list_transform(spans, lambda s: {joined}), ',') as spans
from merged
"""


@query("op7_secret_scan", _secrets_sql())
def op7_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scanned = secret_scan.scan_documents(docs)
    spans, base = F.col("spans"), secret_scan.KINDS[:3]

    def count(kind: int):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(base)]
    digest = F.sha2(secret_scan.listed(spans, base).cast("binary"), 256)
    return scanned.select(
        "doc_id",
        *counts,
        digest.alias("base_sha256"),
        secret_scan.listed(spans).alias("spans"),
    )


# -- 8 -----------------------------------------------------------------------


@query("op8_simhash_components")
def op8_simhash_components(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


# -- 9 -----------------------------------------------------------------------

_TOPK_SQL = """
with usable as (
  select vec_id, min(list_transform(embedding, lambda x: floor(64 * x::double))) as v
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
  group by vec_id),
padded as (
  select vec_id, list_concat(v, list_resize([]::double[], (max(len(v)) over () - len(v))::bigint, 0::double)) as v
  from usable),
scored as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
  from padded q join padded c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id),
ranked as (
  select query_id, row_number() over (partition by query_id order by score desc, vec_id) as rank, vec_id, score
  from scored)
select query_id, rank::int as rank, vec_id, score from ranked where rank <= 20
"""


@query("op9_exact_top_k", _TOPK_SQL)
def op9_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = topk.finite_vectors(
        table(spark, folder, "embeddings"),
        "vec_id",
        "embedding",
        lambda x: F.floor(64 * x.cast("double")).cast("double"),
    )
    found = topk.top_k(vectors, F.col("id") % 20 == 0, 20)
    return found.withColumn("score", F.col("score").cast("long"))


# -- 10 ----------------------------------------------------------------------

_WARC_SQL = """
with paid as (
  select page_id, encode(coalesce(html, '')) as payload from pages),
digested as (
  select page_id, octet_length(payload) as payload_bytes, sha256(payload) as digest,
         upper(sha1(payload)) as hex from paid),
first as (
  select digest, min(page_id) as first_id from digested where payload_bytes >= 0 group by digest)
select page_id, payload_bytes,
  array_to_string(list_transform(range(0, 8), lambda g: array_to_string(list_transform([15, 10, 5, 0], lambda b:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + (((('0x' || substr(hex, 1 + 5 * g::int, 5))::bigint) >> b) & 31)::int, 1)), '')), '') as payload_digest,
  case when first_id is null or page_id is not distinct from first_id
    then 'response' else 'revisit' end as record_type,
  case when page_id is distinct from first_id then first_id end as refers_to
from digested left join first using (digest)
"""


@query("op10_warc_round_trip", _WARC_SQL)
def op10_warc_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    archives, written = warc.archive_pages(table(spark, folder, "pages"))
    return warc.read_archives(archives, written).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


# -- 11 ----------------------------------------------------------------------

_COPIES_SQL = r"""
with normal as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents)
select doc_id, min(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
  row_number() over (partition by t order by doc_id nulls last) = 1 as kept, sha256(t) as text_sha256
from normal
"""


@query("op11_exact_dedup", _COPIES_SQL)
def op11_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The table comes in as two loads, lower ids first, as a corpus that grows."""
    scratch = scratch_for(spark, None)
    rows = exact_dedup.digested(table(spark, folder, "documents"), scratch)
    count, low, high = rows.agg(F.count(F.lit(1)), F.min("id"), F.max("id")).first()
    index = exact_dedup.DigestIndex(
        spark, scratch.folder("index"), exact_dedup.buckets_for(count)
    )
    early = F.coalesce(F.col("id") <= ((low or 0) + (high or 0)) // 2, F.lit(False))
    index.add(rows.where(early), "1")
    index.add(rows.where(~early), "2")
    return index.resolve(rows).select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


# -- 12 ----------------------------------------------------------------------

_AUDIT_SQL = r"""
with worded as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
  from documents),
marked as (
  select part,
    (len(w) < 100)::int + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::int
      + 4 * (100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t))::int
      + 8 * regexp_matches(t, '[#$%&*|]')::int
      + 16 * coalesce(doc_id > min(doc_id) over (partition by t), false)::int as failed,
    coalesce(doc_id in (select doc_id from labels where quality = 1 and doc_id is not null), false) as good,
    coalesce(doc_id in (select doc_id from labels where toxic = 1 and doc_id is not null), false) as toxic
  from worded),
tallied as (
  select part, failed, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic
  from marked group by part, failed),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
orders as (
  select a.x || b.x || c.x || d.x || e.x as filter_order
  from letters a, letters b, letters c, letters d, letters e
  where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps as (
  select filter_order, step::int as step, substr(filter_order, step::int, 1) as letter,
    (1 << (strpos('ABCDE', substr(filter_order, step::int, 1)) - 1)::int) as bit,
    coalesce(list_sum(list_transform(range(1, step), lambda i:
      1 << (strpos('ABCDE', substr(filter_order, i::int, 1)) - 1)::int)), 0)::int as before
  from orders, range(1, 6) as s(step)),
counted as (
  select part, filter_order, step, letter,
    coalesce(sum(n) filter (failed & (before | bit) = 0), 0)::bigint as kept,
    coalesce(sum(n) filter (failed & before = 0 and failed & bit <> 0), 0)::bigint as removed,
    coalesce(sum(n) filter (failed & before <> 0 and failed & bit <> 0), 0)::bigint as redundant,
    coalesce(sum(n) filter (failed = bit), 0)::bigint as unique_fails,
    coalesce(sum(good) filter (failed & before = 0 and failed & bit <> 0), 0)::bigint as good_lost,
    coalesce(sum(toxic) filter (failed & before = 0 and failed & bit <> 0), 0)::bigint as toxic_lost
  from tallied, steps group by part, filter_order, step, letter)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) over (partition by part, letter))::bigint as shapley
from counted
"""


@query("op12_filter_audit", _AUDIT_SQL)
def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    tallied = filter_audit.tally(
        table(spark, folder, "documents"),
        filter_audit.text_failures(F.col("text")),
        table(spark, folder, "labels"),
        {"good_lost": F.col("quality") == 1, "toxic_lost": F.col("toxic") == 1},
    )
    return filter_audit.audit(tallied, "ABCDE", ["good_lost", "toxic_lost"])


# -- 13 ----------------------------------------------------------------------


_REPAIR_SQL = r"""
with given as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as k
  from conversations),
drawn as (
  select *, xor(list_reduce(
      list_transform(range(1, length(k) + 1), lambda i: ascii(substr(k, i::int, 1))::bigint),
      lambda c, b: list_reduce([0, 1, 2, 3, 4, 5, 6, 7]::bigint[], lambda d, j:
        case when d & 1 = 1 then xor(d >> 1, 3988292384::bigint) else d >> 1 end, xor(c, b)),
      4294967295::bigint), 4294967295::bigint) % 20 as kind
  from given),
damaged as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
    case when kind = 1 then '' when kind = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
  from drawn, range(0, 2) as copies(copy)
  where kind <> 0 and (copy = 0 or kind = 3)),
placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as p from damaged),
judged as (
  select conv_id, turn, role, text, p,
    coalesce(list_position(['s', 'u', 'a'], left(role, 1)), 4) as r,
    case when not regexp_matches(text, '[^\x20\x09-\x0D]') then 1
      when row_number() over (partition by conv_id, role, text order by p) > 1 then 2
      when not regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') then 3 else 0 end as f
  from placed),
whole as (
  select conv_id, list({'r': r, 'f': f, 'role': role, 'text': text} order by p) as rows,
    coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count(*) filter (f = 1) as blank, count(*) filter (f = 2) as duplicate, count(*) filter (f = 3) as truncated
  from judged group by conv_id),
solved as (
  select *, list_reduce(rows, lambda s, x: list_transform([CLOSED_S], lambda c: [
      {'c': c[1].c + 4, 'a': c[1].a || 'D'},
      least({'c': c[2].c + 4, 'a': c[2].a || 'D'},
        {'c': c[1].c + case when x.r <> 1 or x.f in (1, 2) then 1000000000 when x.f = 3 then 3 else 0 end, 'a': c[1].a || 'K'}),
      least({'c': c[3].c + 4, 'a': c[3].a || 'D'}, TAKE_1_2, TAKE_2_2, TAKE_4_2),
      least({'c': c[4].c + 4, 'a': c[4].a || 'D'}, TAKE_3_3)])[1],
    [{'c': 0::bigint, 'a': ''}, {'c': 1000000000::bigint, 'a': ''}, {'c': 1000000000::bigint, 'a': ''},
     {'c': 1000000000::bigint, 'a': ''}]) as s
  from whole),
best as (
  select *, list_transform([CLOSED_S], lambda c: least(c[1], c[4]))[1] as b from solved),
lettered as (
  select *, list_filter(string_split(b.a, ''), lambda x: x <> '') as letters from best),
kept as (
  select *, list_filter(range(1, len(letters) + 1), lambda j: letters[j] <> 'D') as places from lettered),
spelled as (
  select *, list_transform(places, lambda j: {
      'letter': letters[j],
      'row': rows[len(list_filter(letters[1:j], lambda x: x <> 'I'))]}) as turns
  from kept),
repaired as (
  select *, (len(turns) > 0 and turns[1].letter = 'K' and turns[1].row.r = 1)::int as lead from spelled),
audited as (
  select conv_id, gaps, blank, duplicate, truncated,
    len(list_filter(range(1, len(rows)), lambda i:
      not ([rows[i].r, rows[i + 1].r] in ([1, 2], [2, 3], [3, 2])))) as illegal,
    b.c as cost, b.a as audit,
    sha256(array_to_string(list_transform(range(1, len(turns) + 1), lambda q:
      case when turns[q].letter = 'K' then turns[q].row.role
        when (q - lead) % 2 = 1 then 'user' else 'assistant' end
      || ':' || case when turns[q].letter = 'I' then '' else turns[q].row.text end), chr(10))) as repaired_sha256
  from repaired),
ids as (select distinct conv_id from conversations)
select ids.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank,
  coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated,
  coalesce(illegal, 0)::bigint as illegal, coalesce(cost, 0)::bigint as cost, coalesce(audit, '') as audit,
  coalesce(repaired_sha256, sha256('')) as repaired_sha256
from ids left join audited on ids.conv_id is not distinct from audited.conv_id
"""


def _repair_sql() -> str:
    """The cheapest edits by dynamic programming over the rows, forwards."""

    def close(s: str) -> str:
        """One more turn may be inserted."""
        more = "{{'c': {0}.c + 3, 'a': {0}.a || 'I'}}"
        user = ", ".join(more.format(f"{s}[{k}]") for k in (1, 2, 4))
        assistant = more.format(f"{s}[3]")
        return f"[{s}[1], {s}[2], least({s}[3], {user}), least({s}[4], {assistant})]"

    twice = f"list_transform([{close('s')}], lambda t: {close('t')})[1]"
    sql = _REPAIR_SQL.replace("CLOSED_S", twice)
    for state, role in ((1, 2), (2, 2), (4, 2), (3, 3)):
        cost = (
            f"case when x.f in (1, 2) then 1000000000 when x.f = 3 then 3 else 0 end"
            f" + case when x.r = {role} then 0 else 3 end"
        )
        letter = f"case when x.r = {role} then 'K' else 'R' end"
        sql = sql.replace(
            f"TAKE_{state}_{role}",
            f"{{'c': c[{state}].c + {cost}, 'a': c[{state}].a || {letter}}}",
        )
    return sql


@query("op13_conversation_repair", _repair_sql())
def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    given = table(spark, folder, "conversations")
    audits, turns = conversation_repair.repair(conversation_repair.damage(given))
    digests = conversation_repair.digest_turns(turns)
    whole = conversation_repair.together([given.select("conv_id"), audits, digests], "conv_id")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return whole.select(
        "conv_id",
        *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"),
    )
