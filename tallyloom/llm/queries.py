"""The registered queries of the training-data operators, and the same in DuckDB SQL where that can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import chat, contamination, fingerprints, html, jaccard, langid, lines, mixing, negatives, oddsketch, repeats, trie, urls

Query = Callable[[SparkSession, str], DataFrame]

# The rules that the URL query applies, as verdict, host and path.
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
MIX_WEIGHTS = {"src0": 0.1, "src1": 0.2}
MIX_DEFAULT_WEIGHT = 0.05
MIX_SEED = 17


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sources(
        table(spark, folder, "documents"), MIX_WEIGHTS, seed=MIX_SEED, default_weight=MIX_DEFAULT_WEIGHT
    )


def op2_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = repeats.cut_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op3_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = contamination.find_contamination(docs, table(spark, folder, "benchmark"))
    n_hit = contamination.n_hit(F.col("hit_spans"))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
        "longest_match",
    )


def op4_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, folder, "documents"))


def op5_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    rendered = chat.rotate_perspectives(table(spark, folder, "conversations"))
    return rendered.withColumns(
        {c: F.array_join(F.col(c).cast("array<string>"), ",") for c in ("mask_starts", "mask_ends")}
    )


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    done = lines.dedup_lines(table(spark, folder, "documents"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op7_html_text(spark: SparkSession, folder: str) -> DataFrame:
    extracted = html.extract_text(table(spark, folder, "pages").select("page_id", "url", "html"))
    return extracted.withColumn("n_chars", F.length("text").cast("long"))


def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, urls.RULES)
    return urls.match_rules(table(spark, folder, "pages"), rules, keep=["page_id"])


def op9_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    marked = fingerprints.with_fingerprint(docs, F.col("text"), "print")
    paired = fingerprints.with_next(marked, "doc_id", ["text", "print"])
    n_chars = F.length("text")
    moved = F.floor(n_chars / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n_chars - moved), F.substring(F.col("next_text"), F.lit(1), moved))
    changed = paired.withColumn("edited", edited).withColumn("n_chars", n_chars.cast("long")).drop("text", "next_text")
    both = fingerprints.with_fingerprint(changed, F.col("edited"), "edited_print")
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.as_text(F.col("print")).alias("fingerprint"),
        fingerprints.as_text(F.col("edited_print")).alias("edited_fingerprint"),
        fingerprints.likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        fingerprints.likeness(F.col("print"), F.col("next_print")).alias("near_next"),
    )


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def language_model(docs: DataFrame) -> langid.Model:
    return langid.fit(docs.where(~held_out()))


def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = langid.identify(docs.select("doc_id", "text"), language_model(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, folder, "embeddings").withColumn("label", noisy)
    return negatives.mine_hard_negatives(rows, F.col("vec_id") % 100 == 0)


def op12_odd_sketches(spark: SparkSession, folder: str) -> DataFrame:
    return oddsketch.near_duplicates(table(spark, folder, "documents"))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns, convs = trie.share_heads(table(spark, folder, "conversations"))
    return trie.prefix_trie(turns, convs).expanded().drop("node")


OP1_SQL = f"""
with size as (
    select coalesce(source, '') as s, sum(coalesce(length(text), 0))::double as size from documents group by 1
), given as (
    select s, size,
        case s {" ".join(f"when '{k}' then {v}::double" for k, v in MIX_WEIGHTS.items())} else {MIX_DEFAULT_WEIGHT}::double end as weight
    from size where size > 0
), rates as (
    select s, 1.0::double * weight / (select sum(weight::decimal(28,12))::double from given) * (select sum(size) from given) / size as rate from given
), terms as (
    select s, rate, k, exp(-rate + k * ln(rate) - lgamma(k + 1)) as term
    from rates, lateral (select unnest(range(0, ceil(rate + 10 * sqrt(rate) + 40)::bigint + 1)) as k) t
), steps as (
    select s, rate, sum(term) over (partition by s order by k) as step from terms
), drawn as (
    select d.*, r.s, r.rate,
        (('0x' || substr(md5('{MIX_SEED}:' || coalesce(doc_id::varchar, '')), 1, 13))::bigint + 0.5::double) / {float(16**13)}::double as u
    from documents d join rates r on coalesce(d.source, '') = r.s
), counted as (
    select doc_id, text, lang, source, n_chars, d.rate, (select count(*) from steps t where t.s = d.s and t.step <= d.u) as n_copies
    from drawn d
), copies as (
    select *, unnest(range(0, n_copies)) as copy from counted where n_copies > 0
)
select *, (('0x' || substr(md5('{MIX_SEED + 1}:' || coalesce(doc_id::varchar, '') || ':' || copy::varchar), 1, 13))::bigint + 0.5::double)
    / {float(16**13)}::double as shuffle_key
from copies
"""

SQL_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP6_SQL = f"""
with line as (
    select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
        unnest(range(len(string_split(coalesce(text, ''), chr(10))))) as position
    from documents
), keyed as (
    select *, translate(trim(line, {SQL_SPACE}), '{lines.UPPER}', '{lines.LOWER}') as key from line
), many as (
    select key, max(doc_id) as kept_in from keyed where length(key) >= 40 group by key having count(distinct doc_id) >= 5
), marked as (
    select k.*, m.key is not null and k.doc_id <> m.kept_in as gone from keyed k left join many m on k.key = m.key
)
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
    sha256(coalesce(string_agg(line, chr(10) order by position) filter (not gone), '')) as kept_sha256
from marked group by doc_id
"""

OP8_SQL = f"""
with rules(verdict, host, path) as (
    values {", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)}
), split as (
    select page_id,
        translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), '{urls.UPPER}', '{urls.LOWER}') as host,
        coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') as path
    from pages
), fitting as (
    select s.page_id, r.host || r.path as rule, r.verdict
    from split s join rules r on (s.host = r.host or ends_with(s.host, '.' || r.host)) and starts_with(s.path, r.path)
), best as (
    select page_id, arg_max(rule, length(rule)) as rule, arg_max(verdict, length(rule)) as verdict from fitting group by page_id
)
select page_id, s.host, s.path, b.rule, coalesce(b.verdict, 'allow') as verdict from split s left join best b using (page_id)
"""

OP11_SQL = """
with kept as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
        list_transform(embedding, lambda x: floor(x::double * 256)::bigint::hugeint) as vec
    from embeddings
    where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select a.vec_id as anchor_id, r.vec_id, a.label = r.label as same,
        coalesce(list_sum(list_transform(list_zip(a.vec, r.vec), lambda p: p[1] * p[2])), 0)::bigint as score
    from kept a join kept r on a.vec_id <> r.vec_id where a.vec_id % 100 = 0
), positives as (
    select anchor_id, vec_id as positive_id, score as positive_score from scored where same
    qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select p.anchor_id, positive_id, row_number() over (partition by p.anchor_id, positive_id order by score desc, vec_id)::int as rank,
    vec_id as negative_id, positive_score, score as negative_score
from positives p join scored s on s.anchor_id = p.anchor_id and not same
    and 80 * positive_score <= 100 * score and score <= positive_score
qualify rank <= 5
"""

# CRC-32 bit by bit: of each byte, eight steps of the reversed polynomial.
SQL_CRC32 = """xor(list_reduce([4294967295] || flatten(list_transform(range(1, len(c::varchar) + 1),
    lambda i: [ascii(substr(c::varchar, i, 1))::bigint, 0, 0, 0, 0, 0, 0, 0])),
    lambda a, b: case when xor(a, b) & 1 = 1 then xor(xor(a, b) >> 1, 3988292384) else xor(a, b) >> 1 end), 4294967295)"""

OP13_SQL = f"""
with raw as (
    select conv_id as c, row_number() over (partition by conv_id order by turn nulls first) as r,
        coalesce(role, '') as role, coalesce(text, '') as text
    from conversations where conv_id is not null
), conv as (
    select c, count(*) as n, {SQL_CRC32} % 9 as h, c - c % 5 as base from raw group by c
), known as (
    select k.*, least(k.h, coalesce(b.n, 0)) as taken from conv k left join conv b on b.c = k.base
), turns as (
    select k.c, r as d, role, text from known k join raw on raw.c = k.base and r <= h
    union all
    select k.c, r - h + taken, role, text from known k join raw on raw.c = k.c and r > h
), paths as (
    select c, d, octet_length(encode(text)) as b,
        string_agg(sha256(role) || sha256(text), '') over (partition by c order by d rows unbounded preceding) as path
    from turns
    union all
    select c, 0, 0, '' from conv
), node as (
    select path, min(d) as depth, min(c) as conv_id, count(*) as n_convs, min(b) as b from paths group by path
), finish as (
    select path, string_agg(c::varchar, ',' order by c) as ids from paths p
    where d = (select max(d) from paths q where q.c = p.c) group by path
), kids as (
    select left(path, len(path) - 128) as path, count(*) as n from node where depth > 0 group by 1
), under as (
    select left(n.path, 128 * k) as path, count(*) filter (kids.n is null) as n_leaves, sum((n_convs - 1) * b) as saved
    from node n left join kids using (path), lateral (select unnest(range(0, n.depth + 1)) as k) t group by 1
)
select n.conv_id, n.depth::bigint as depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(kids.n, 0)::bigint as n_children,
    n_leaves::bigint as n_leaves, saved::bigint as saved_tokens, sha256(coalesce(ids, '')) as ends_sha256
from node n join under using (path) left join kids using (path) left join finish using (path)
left join node p on n.depth > 0 and p.path = left(n.path, len(n.path) - 128)
"""

OP5_SQL = r"""
with said as (
    select conv_id, turn, role, replace(coalesce(text, ''), '<|im_', '<❘im_') as body from conversations where conv_id is not null
), who as (
    select distinct conv_id, role as perspective from said where role is not null and role <> 'system'
), message as (
    select conv_id, perspective, coalesce(role = perspective, false) as trained, body || '<|im_end|>' as said,
        '<|im_start|>' || case when role = perspective then 'assistant' when role = 'system' then 'system' when role is null then 'user'
            else 'user name=' || replace(role, '<|im_', '<❘im_') end || chr(10) as head,
        row_number() over (partition by conv_id, perspective order by turn nulls first, role nulls first, body) as pos
    from said join who using (conv_id)
), placed as (
    select *, sum(length(head) + length(said) + 1) over (partition by conv_id, perspective order by pos) - 1 as stop from message
)
select conv_id, perspective, 0::bigint as part, count(*) as n_turns, count(*) filter (trained) as n_trained,
    string_agg(head || said || chr(10), '' order by pos) as rendered,
    string_agg((stop - length(said))::bigint::varchar, ',' order by pos) filter (trained) as mask_starts,
    string_agg(stop::bigint::varchar, ',' order by pos) filter (trained) as mask_ends
from placed group by conv_id, perspective
"""

LLM_QUERIES: dict[str, Query] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_decontaminate": op3_decontaminate,
    "op4_ngram_jaccard": op4_ngram_jaccard,
    "op5_chat_format": op5_chat_format,
    "op6_line_dedup": op6_line_dedup,
    "op7_html_text": op7_html_text,
    "op8_url_filter": op8_url_filter,
    "op9_fingerprints": op9_fingerprints,
    "op10_language_id": op10_language_id,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_odd_sketches": op12_odd_sketches,
    "op13_prefix_trie": op13_prefix_trie,
}
LLM_ORACLE_SQL: dict[str, str] = {
    "op1_mix_sources": OP1_SQL,
    "op5_chat_format": OP5_SQL,
    "op6_line_dedup": OP6_SQL,
    "op8_url_filter": OP8_SQL,
    "op11_hard_negatives": OP11_SQL,
    "op13_prefix_trie": OP13_SQL,
}
