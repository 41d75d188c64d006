"""The registered queries of these operators, with production settings, and their SQL forms."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import (
    chat_format,
    embedding_dedup,
    html_extraction,
    language_id,
    line_dedup,
    mixing,
    packing,
    pii,
    prefix_trie,
    quality_rules,
    simhash_dedup,
    spelling_variants,
    substring_dedup,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    return packing.pack(table(spark, folder, "documents"), tokenizer_path())


@query
def op2_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return html_extraction.extract(table(spark, folder, "pages"))


@query
def op3_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash_dedup.near_duplicates(table(spark, folder, "documents"))
    return found.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))


#: What both turns of the conversation that ``op4_chat_format`` adds say.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


@query
def op4_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations and one of control strings, formatted and read back."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"),
    )
    return chat_format.read_back(chat_format.formatted(turns.unionByName(extra)))


def held_out(doc_id: Column) -> Column:
    """Documents that nothing is learned from. A null doc_id is one of them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


@query
def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from those not held out."""
    docs = table(spark, folder, "documents")
    labelled = docs.filter(~held_out(F.col("doc_id"))).select("text", "lang")
    found = language_id.identify(docs, language_id.fit(labelled))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op6_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Links and component of every vector."""
    return embedding_dedup.near_duplicates(table(spark, folder, "embeddings"))


@query
def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All documents without the lines that many sites share."""
    return with_length(line_dedup.remove_boilerplate(table(spark, folder, "documents")))


def with_length(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long"))


@query
def op8_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document."""
    docs = table(spark, folder, "documents")
    return pii.detect(docs, pii.fit(docs))


@query
def op9_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """The mixture of all documents by flattened source sizes, in random order."""
    return mixing.replication(table(spark, folder, "documents"))


@query
def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Measures and verdict of every document."""
    return quality_rules.quality(table(spark, folder, "documents"))


#: One run in so many loses a code point.
DAMAGED = 199


@query
def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Words of all documents with their forms and roots; planted misspellings among them."""
    words = spelling_variants.word_counts(table(spark, folder, "documents"), DAMAGED)
    return spelling_variants.variants(words)


@query
def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Trie of all conversations, each begun like the first one of its hundred."""
    turns = table(spark, folder, "conversations").filter("conv_id is not null")
    paths = prefix_trie.prefixes(
        prefix_trie.turn_digests(turns),
        "conv_id - conv_id % 100",
        "cast(crc32(cast(cast(conv_id as string) as binary)) % 6 as int)",
    )
    return prefix_trie.trie(paths)


@query
def op13_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What every document keeps when passages of earlier documents go."""
    kept = substring_dedup.remove_repeats(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


SQL["op7_line_dedup"] = f"""
with lines as (
  select doc_id, source, position, raw,
    trim(raw, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as line
  from (
    select doc_id, source, unnest(string_split(text, chr(10))) as raw,
      unnest(range(len(string_split(text, chr(10))))) as position
    from documents
  )
), spread as (
  select line, min((doc_id, position)) as first
  from lines where line <> ''
  group by line having count(distinct source) >= greatest({line_dedup.MIN_SITES}, least(
    (select count(distinct source) from documents),
    ceil({line_dedup.MIN_SITES * line_dedup.FULL_CHARS}::double / length(line))))
), remaining as (
  select doc_id, string_agg(raw, chr(10) order by position) as left_text
  from lines left join spread using (line)
  where first is null or first = (doc_id, position)
  group by doc_id
)
select doc_id, case when text is not null then coalesce(left_text, '') end as text, lang, source,
  length(case when text is not null then coalesce(left_text, '') end)::bigint as n_chars
from documents left join remaining using (doc_id)
"""

SQL["op9_source_mixing"] = f"""
with recursive sizes as (
  select source, count(*) as n, round(pow(count(*)::double, {mixing.TEMPERATURE}) * 1e6)::hugeint as whole
  from documents group by source
), rates as (
  select source, whole::double / (select sum(whole) from sizes)::double
    * (select sum(n) from sizes)::double / n as rate
  from sizes
), cdf(source, rate, k, p, c) as (
  select source, rate, 0, exp(-rate), exp(-rate) from rates
  union all
  select source, rate, k + 1, p * rate / (k + 1), c + p * rate / (k + 1) from cdf
  where k < floor(rate + 12 * sqrt(rate) + 24)
), drawn as (
  select d.doc_id, d.source, d.text, c.rate, count(*) as copies
  from documents d join cdf c on d.source is not distinct from c.source
    and c.c <= ('0x' || substr(md5('{mixing.SEED}:' || d.doc_id || ':1'), 1, 13))::bigint / 4503599627370496.0
  group by all
), exploded as (
  select doc_id, source, text, rate, unnest(range(copies))::int as copy from drawn
)
select doc_id, source, copy, rate,
  md5('{mixing.SEED}:order:' || doc_id || ':' || copy) as shuffle_key, text
from exploded
"""

SQL["op4_chat_format"] = f"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '{CONTROL_TEXT}'
  union all select -1, 1, 'assistant', '{CONTROL_TEXT}'
), marked as (
  select *, coalesce(lag(role) over w <> role, true) as opens,
    length(text) + len(regexp_extract_all(text, '[<\\[]\\\\*{chat_format.TAILS}')) as escaped
  from turns window w as (partition by conv_id order by turn)
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn)) as turns_sha256,
  sum(case when role = 'assistant' then length(text) else 0 end)::bigint as loss_chars,
  sha256(coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn), '')) as loss_sha256,
  sum(escaped + case when not opens then 5 when role = 'system' then 15 when role = 'user' then 13
    when role = 'assistant' then 7 else 19 + length(role) end)::bigint as formatted_chars
from marked group by conv_id
"""

SQL["op6_embedding_dedup"] = f"""
with recursive units as (
  select vec_id, label, list_transform(embedding, lambda x: x::double) as v from embeddings
  where label is not null and vec_id is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0
), links as (
  select a.vec_id as a, b.vec_id as b from units a join units b
    on a.label = b.label and a.vec_id <> b.vec_id and len(a.v) = len(b.v)
  where list_cosine_similarity(a.v, b.v) >= {embedding_dedup.COSINE}
), reached(a, b) as (
  select a, b from links union select r.a, l.b from reached r join links l on r.b = l.a
), counted as (
  select a, count(*) as n from links group by a
), smallest as (
  select a, min(b) as b from reached group by a
)
select vec_id, coalesce(n, 0)::bigint as n_links, least(vec_id, coalesce(b, vec_id)) as component_id,
  vec_id <= coalesce(b, vec_id) as kept
from embeddings e left join counted c on e.vec_id = c.a left join smallest s on e.vec_id = s.a
"""

SQL["op13_substring_dedup"] = rf"""
with docs as (
  select row_number() over () as r, doc_id,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
  from documents
), starts as (
  select r, doc_id, words, unnest(range(1, len(words) - {substring_dedup.WINDOW} + 2)) as s from docs
), windows as (
  select r, doc_id, s, md5(array_to_string(words[s:s + {substring_dedup.WINDOW - 1}], ' ')) as content
  from starts
), owners as (
  select content, min(doc_id) as owner from windows group by content
), gone as (
  select r, s from windows join owners using (content) where owner < doc_id
), placed as (
  select r, unnest(words) as word, unnest(range(1, len(words) + 1)) as p from docs
), judged as (
  select placed.r, p, word, coalesce(p - max(s) over (partition by placed.r order by p)
    < {substring_dedup.WINDOW}, false) as removed
  from placed left join gone on placed.r = gone.r and p = s
), left_over as (
  select r, count(*) filter (removed) as n_removed,
    string_agg(word, ' ' order by p) filter (not removed) as kept
  from judged group by r
)
select doc_id, len(words)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed,
  sha256(coalesce(kept, '')) as kept_sha256
from docs left join left_over using (r)
"""


def crc32_sql(codes: str) -> str:
    """CRC-32 of bytes: ``codes`` is a list of lists, each a byte and eight times -1."""
    return f"""xor(4294967295, list_reduce(list_prepend(4294967295::bigint, flatten({codes})),
      lambda a, x: case when x >= 0 then xor(a, x) else xor(a >> 1, 3988292384 * (a & 1)) end))"""


_STEPS = ", ".join(["-1::bigint"] * 8)
_TEXT_CODES = f"""list_transform(string_split(%s, ''), lambda c: case when ord(c) < 128
      then [ord(c)::bigint, {_STEPS}] else [195::bigint, {_STEPS}, ord(c)::bigint - 64, {_STEPS}] end)"""

SQL["op11_spelling_variants"] = f"""
with recursive found as (
  select doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) as given from documents
), runs as (
  select doc_id, translate(given, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run,
    count(*) as n
  from found where length(given) >= {spelling_variants.MIN_LENGTH} group by all
), drawn as (
  select run, n, coalesce({crc32_sql(_TEXT_CODES % "doc_id || ':' || run")}, 1) as h from runs
), damaged as (
  select n, case when h % {DAMAGED} = 0
    then left(run, h % length(run)) || substr(run, h % length(run) + 2) else run end as word
  from drawn
), words as (
  select word, sum(n)::bigint as n from damaged
  where length(word) >= {spelling_variants.MIN_LENGTH}
  group by word having sum(n) >= {spelling_variants.MIN_COUNT}
), cut as (
  select word, n, unnest(range(1, length(word) + 1)) as place from words
), holes as (
  select word, n, place, left(word, place - 1) as head, substr(word, place + 1) as tail from cut
), pairs as (
  select a.word, b.word as near, b.n as near_n
  from holes a join holes b on a.head = b.head and a.tail = b.tail and a.word <> b.word
  union select h.word, w.word, w.n from holes h join words w on w.word = head || tail
  union select w.word, h.word, h.n from holes h join words w on w.word = head || tail
), best as (
  select word, count(*) as n_near, arg_min(near, (-near_n, near)) as near, max(near_n) as near_n
  from pairs group by word
), judged as (
  select w.word, w.n, coalesce(n_near, 0) as n_near,
    case when near_n >= {spelling_variants.FORM_RATIO} * w.n then near end as form,
    case when near_n >= {spelling_variants.FORM_RATIO} * w.n then near_n end as form_n
  from words w left join best using (word)
), steps(word, root) as (
  select word, word from judged
  union all select s.word, j.form from steps s join judged j on j.word = s.root where j.form is not null
), ends as (
  select s.word, s.root from steps s join judged j on j.word = s.root where j.form is null
)
select word, form, root, n, n_near::bigint as n_near, form_n::bigint as form_n
from judged join ends using (word)
"""

SQL["op12_prefix_trie"] = f"""
with said as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first) as place
  from conversations where conv_id is not null
), convs as (
  select conv_id, conv_id - conv_id % 100 as leader, {crc32_sql(_TEXT_CODES % "conv_id::varchar")} % 6 as h
  from (select distinct conv_id from said)
), rebuilt as (
  select c.conv_id, 0 as own, place, role, text from convs c join said s on s.conv_id = leader and place <= h
  union all
  select conv_id, 1, place, role, text from convs join said using (conv_id) where place > h
), chained as (
  select conv_id, length(text) as chars, row_number() over w as depth,
    md5(string_agg(sha256(length(role) || ':' || role || text), '') over w) as key
  from rebuilt window w as (partition by conv_id order by own, place)
), paths as (
  select conv_id, 0 as depth, '' as key, null as parent, 0 as chars from convs
  union all
  select conv_id, depth, key, lag(key, 1, '') over (partition by conv_id order by depth), chars from chained
), nodes as (
  select key, min(conv_id) as conv_id, min(depth) as depth, min(parent) as parent,
    count(*) as n_convs, (count(*) - 1) * min(chars) as own
  from paths group by key
), families as (
  select parent, count(*) as n_children from nodes where parent is not null group by parent
), ends as (
  select key, sha256(string_agg(conv_id::varchar, ',' order by conv_id)) as ends_sha256
  from (select * from paths qualify row_number() over (partition by conv_id order by depth desc) = 1)
  group by key
), totals as (
  select above.key, count(*) filter (n_children is null) as n_leaves, sum(n.own) as saved_tokens
  from nodes n left join families f on f.parent = n.key
    join paths above on above.conv_id = n.conv_id and above.depth <= n.depth
  group by above.key
)
select n.conv_id, n.depth::bigint as depth, p.conv_id as parent_conv_id, n.n_convs,
  coalesce(n_children, 0)::bigint as n_children, n_leaves, saved_tokens::bigint as saved_tokens,
  coalesce(ends_sha256, sha256('')) as ends_sha256
from nodes n join totals using (key) left join nodes p on p.key = n.parent
  left join families f on f.parent = n.key left join ends on ends.key = n.key
"""
