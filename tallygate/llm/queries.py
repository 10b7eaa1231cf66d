"""The registered queries of this subpackage, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygate.llm import chat, decontaminate, html_text, language, licenses, negatives, packing, quality, repeats, sentencepieces, simhash, toxicity, turns
from tallygate.llm.common import LOWER, UPPER, WORD, table, vocabulary


#: A conversation that holds the marks of the format, escaped and plain.
MARKED = r"\### Assistant: </turn> ok"


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests read back from the formatted text of every conversation and of conversation -7."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = [F.struct(F.lit(n).cast("long").alias("turn"), F.lit(role).alias("role")) for n, role in enumerate(("user", "assistant"))]
    marked = spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), F.inline(F.array(*turns)))
    return chat.read_back(chat.formatted(given.union(marked.withColumn("text", F.lit(MARKED)))))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and templates of every document."""
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that a string of 400 bytes with a copy anywhere covers."""
    cut = repeats.without_repeats(table(spark, sf_dir, "documents"), least=400, keep="none")
    n_kept = F.coalesce(F.octet_length("kept"), F.lit(0)).cast("long")
    return cut.select(
        "row.doc_id",
        F.coalesce(F.octet_length("row.text"), F.lit(0)).cast("long").alias("n_bytes"),
        (F.coalesce(F.octet_length("row.text"), F.lit(0)) - n_kept).cast("long").alias("n_removed"),
        F.size("begins").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned outside the held-out third."""
    return language.held_out_prediction(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category probabilities of every document by the classifier chain."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    near = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return near.select(
        "doc_id", F.lower(F.lpad(F.hex("fp0"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of every document and whether the fixed and the learned rules keep it."""
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sequence and offset of every piece of every document."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary())


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside benchmark windows, and the items found."""
    found = decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    named = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(named, 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op11_sentencepieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded text of every document."""
    found = sentencepieces.encoded(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, after some labels were changed."""
    given = table(spark, sf_dir, "embeddings")
    changed = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(negatives.prepared(given, changed), F.col("vec_id") % 100 == 0)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest edits of every conversation after damage."""
    return turns.repaired(turns.damaged(table(spark, sf_dir, "conversations")), with_turns=False)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_format": op1_chat_format,
    "op2_licenses": op2_licenses,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_language": op4_language,
    "op5_toxicity": op5_toxicity,
    "op6_simhash": op6_simhash,
    "op7_html_text": op7_html_text,
    "op8_quality_rules": op8_quality_rules,
    "op9_packing": op9_packing,
    "op10_decontaminate": op10_decontaminate,
    "op11_sentencepieces": op11_sentencepieces,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_conversation_repair": op13_conversation_repair,
}

_OP1 = rf"""
    with turns as (
        select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
        union all values (-7, 0, 'user', '{MARKED}'), (-7, 1, 'assistant', '{MARKED}')),
    spelled as (
        select *, length(regexp_replace(text, '(\\*)(###|</turn>)', '\\\1\2', 'g')) as body from turns)
    select conv_id, count(*) as n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
        coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
        sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
        sum(length(role) + body + length('###  :') + 1 + length(' </turn>') + 1)::bigint as formatted_chars
    from spelled group by conv_id
"""

#: Every string of 400 bytes by its digest; bytes are two hex digits. Texts are cut into overlapping
#: blocks first, as the place of a character in a long string takes a scan.
_OP3 = """
    with given as (
        select row_number() over () as r, doc_id, hex(encode(coalesce(text, ''))) as h from documents),
    blocks as (
        select r, off, substr(h, 2 * off + 1, 2 * (400 + 399)) as b
        from (select r, h, unnest(range(0, greatest(len(h) // 2 - 399, 0), 400)) as off from given)),
    strings as (
        select r, off + i as s, md5(substr(b, 2 * i + 1, 800)) as digest
        from (select r, off, b, unnest(range(0, least(400, len(b) // 2 - 399))) as i from blocks)),
    repeated as (
        select r, s from strings where digest in (select digest from strings group by digest having count(*) > 1)),
    runs as (
        select r, min(s) as a, max(s) + 400 as z
        from (
            select r, s, sum(begins) over (partition by r order by s) as run
            from (select r, s, case when s <= lag(s) over (partition by r order by s) + 400 then 0 else 1 end as begins
                  from repeated))
        group by r, run),
    ends as (
        select r, a, z, lag(z, 1, 0) over (partition by r order by a) as before from runs),
    removed as (
        select r, count(*) as n_spans, sum(z - a) as n_removed, max(z) as last from runs group by r),
    left_over as (
        select r, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' order by a) as front
        from ends join given using (r) group by r)
    select doc_id, (len(h) // 2)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed,
        coalesce(n_spans, 0)::bigint as n_spans,
        sha256(unhex(coalesce(front, '') || substr(h, 2 * coalesce(last, 0) + 1))) as kept_sha256
    from given left join removed using (r) left join left_over using (r)
"""

_OP10 = rf"""
    with d as (
        select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') as w
        from documents),
    b as (
        select item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') as w
        from benchmark),
    wins as (
        select distinct item_id, n, array_to_string(w[s:s + n - 1], ' ') as gram
        from (select item_id, w, least(10, len(w)) as n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as s
              from b where len(w) > 0)),
    grams as (
        select doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') as gram
        from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as s
              from d, (select distinct n from wins))),
    hits as (select doc_id, s, n, item_id from grams join wins using (n, gram)),
    words as (
        select doc_id, count(distinct place) as n_hit
        from (select doc_id, unnest(range(s, s + n)) as place from hits) group by doc_id),
    items as (
        select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as listed
        from (select distinct doc_id, item_id::varchar as item_id from hits) group by doc_id)
    select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
        coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(listed, '')) as items_sha256,
        coalesce(n_hit, 0) > 0 as contaminated
    from d left join words using (doc_id) left join items using (doc_id)
"""

_OP12 = """
    with rows as (
        select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end::bigint as label,
            list_transform(embedding, lambda x: floor(256 * x::double)) as v
        from embeddings
        where vec_id is not null and label is not null and embedding is not null
            and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    anchors as (select row_number() over () as a, * from rows where vec_id % 100 = 0),
    pairs as (
        select a, anchors.vec_id as anchor_id, rows.vec_id, rows.label = anchors.label as same,
            list_inner_product(anchors.v, rows.v)::bigint as score
        from anchors, rows where rows.label <> anchors.label or rows.vec_id <> anchors.vec_id),
    positives as (
        select *, row_number() over (partition by a order by score desc, vec_id) as p
        from pairs where same qualify p <= 5)
    select p.anchor_id, p.vec_id as positive_id, n.vec_id as negative_id, p.score as positive_score,
        n.score as negative_score,
        row_number() over (partition by p.a, p.p order by n.score desc, n.vec_id)::int as rank
    from positives p join pairs n
        on n.a = p.a and not n.same and 30 * p.score <= 100 * n.score and 100 * n.score <= 90 * p.score
    qualify rank <= 10
"""

def _grown(state: str, letter: str, cost: str, line: str) -> str:
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 'l': {state}.l || {line}}}"


def _least(*options: str) -> str:
    return f"list_min([{', '.join(options)}])"


_NEW_USER, _NEW_ASSISTANT = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
_FAR = "{'c': 1000000000::bigint, 'a': '', 'l': ''}"
_MORE = "case when fault = 't' then 5 else 0 end"
_STAY = "case when fault in ('b', 'd') then 1000000000 else 0 end"


def _kept_if(state: str, initial: str) -> str:
    cost = f"{_MORE} + {_STAY} + case when role[1] = '{initial}' then 0 else 1000000000 end"
    return _grown(state, "K", cost, "chr(10) || role || ':' || text")


def _retyped(state: str, new: str) -> str:
    return _grown(state, "R", f"1 + {_MORE} + {_STAY}", f"{new} || text")


def _deleted(state: str) -> str:
    return _grown(state, "D", "2", "''")


#: The lattice row by row: w0 to w3 are the least (cost, initials, turns) in each state, i2 and i3 the
#: same after insertions. CRC-32 is worked out bit by bit.
_OP13 = rf"""
    with recursive given as (
        select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
            coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as spelled
        from conversations),
    dealt as (
        select *, xor(4294967295, list_reduce(
            list_concat([4294967295::bigint], flatten(list_transform(str_split(spelled, ''),
                lambda ch: [ascii(ch)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
            lambda c, x: case when x >= 0 then xor(c, x) else xor(c >> 1, 3988292384 * (c & 1)) end)) % 20 as kind
        from given),
    damaged as (
        select conv_id, turn, case when kind = 4 then 'user' else role end as role,
            case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
            unnest(case when kind = 3 then [0, 1] else [0] end) as copy
        from dealt where kind <> 0),
    bared as (
        select *, regexp_replace(text, '[ 	-
]+$', '') as bare,
            row_number() over (partition by conv_id order by turn nulls first, role,
                sha256(length(role)::varchar || ':' || role || text), copy) as spot
        from damaged),
    rows as (
        select *, case when bare = '' then 'b'
            when row_number() over (partition by conv_id, role, text order by spot) > 1 then 'd'
            when right(bare, 1) not in ('.', '!', '?') then 't' else '' end as fault,
            lag(role[1]) over (partition by conv_id order by spot) || role[1] as pair
        from bared),
    summed as (
        select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps,
            count(*) filter (fault = 'b') as blank, count(*) filter (fault = 'd') as duplicate,
            count(*) filter (fault = 't') as truncated, count(*) filter (pair not in ('su', 'ua', 'au')) as illegal,
            max(spot) as n
        from rows group by conv_id),
    walk as (
        select conv_id, 0::bigint as spot, {{'c': 0::bigint, 'a': '', 'l': ''}} as w0, {_FAR} as w1, {_FAR} as w2, {_FAR} as w3
        from summed
        union all
        select conv_id, spot + 1, {_deleted("w0")},
            {_least(_deleted("w1"), _kept_if("w0", "s"))},
            {_least(_deleted("i2"), *[f(x, y) for x in ("w0", "w1", "i3") for f, y in ((_kept_if, "u"), (_retyped, _NEW_USER))])},
            {_least(_deleted("i3"), _kept_if("i2", "a"), _retyped("i2", _NEW_ASSISTANT))}
        from (
            select *, {_least("w3", _grown("i2", "I", "5", _NEW_ASSISTANT))} as i3
            from (select *, {_least("w2", *[_grown(x, "I", "5", _NEW_USER) for x in ("w0", "w1", "w3")])} as i2 from walk)) w
        join (select conv_id as of_conv, spot as of_at, role, text, fault from rows) r
            on of_conv is not distinct from conv_id and of_at = spot + 1),
    ended as (
        select s.*, {_least("w0", _grown(_grown("w1", "I", "5", _NEW_USER), "I", "5", _NEW_ASSISTANT), _grown("w2", "I", "5", _NEW_ASSISTANT), "w3")} as best
        from walk join summed s on s.conv_id is not distinct from walk.conv_id and s.n = walk.spot)
    select c.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank,
        coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated,
        coalesce(illegal, 0)::bigint as illegal, coalesce(best.c, 0)::bigint as cost, coalesce(best.a, '') as audit,
        sha256(coalesce(substr(best.l, 2), '')) as repaired_sha256
    from (select distinct conv_id from conversations) c
    left join ended on ended.conv_id is not distinct from c.conv_id
"""

ORACLE_SQL: dict[str, str] = {
    "op1_chat_format": _OP1,
    "op2_licenses": licenses.oracle_sql(),
    "op3_suffix_dedup": _OP3,
    "op10_decontaminate": _OP10,
    "op12_hard_negatives": _OP12,
    "op13_conversation_repair": _OP13,
}
