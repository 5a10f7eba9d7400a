"""One query for each operator, over its whole table."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from layercake.llm import (bpe, graph_search, html_text, jaccard_join, line_dedup, mask_search, packing, phrase_index,
                           postings, prefix_trie, span_dedup, token_files, toxicity, vector_dedup)
from layercake.llm.common import read


def tokenizer_path() -> str:
    """Tokenizer file of the queries: LAYERCAKE_TOKENIZER, or the installed public one."""
    path = os.environ.get("LAYERCAKE_TOKENIZER")
    if not path:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    return str(path)


def op1_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_search.nearest(spark, read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op2_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_dedup.digests(spark, read(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_files.write(spark, read(spark, sf_dir, "documents"), token_files.token_folder(spark),
                                 tokenizer_path(), end_id=2)
    return token_files.read_index(manifest)


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(spark, read(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("n_lines_before").alias("n_lines"), F.col("n_lines_removed").alias("n_removed"),
                      F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, packing.pieces(read(spark, sf_dir, "documents"), tokenizer_path()))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(read(spark, sf_dir, "documents"), tokenizer_path())


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(spark, read(spark, sf_dir, "pages"))


def op9_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.dedup(spark, read(spark, sf_dir, "embeddings"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    lexicon = toxicity.fit(spark, docs, read(spark, sf_dir, "labels"), ~toxicity.held_out())
    scored = toxicity.score(docs.select("doc_id", "text"), lexicon)
    return scored.select("doc_id", F.coalesce(toxicity.held_out(), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_phrase_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrase_index.decontaminate(spark, read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), n=10)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["ends"] - x["begins"])
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
                        (F.size("spans") > 0).alias("contaminated"))


def op12_mask_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = postings.build(spark, read(spark, sf_dir, "documents"))
    return mask_search.search(spark, index, read(spark, sf_dir, "benchmark"), k=10)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = prefix_trie.turns(read(spark, sf_dir, "conversations"))
    turns, conversations = prefix_trie.rebuild(spark, own)
    at = prefix_trie.prefixes(spark, turns, conversations)
    digests = prefix_trie.end_digests(prefix_trie.ends(at, conversations))
    nodes = prefix_trie.trie(spark, at, conversations)
    return nodes.join(digests, prefix_trie.PREFIX, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.coalesce("digest", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


QUERIES = {f.__name__: f for f in (op1_graph_search, op2_span_dedup, op3_token_files, op4_jaccard_join, op5_line_dedup, op6_packing, op7_bpe, op8_html,
                                   op9_vector_dedup, op10_toxicity, op11_phrase_index, op12_mask_search,
                                   op13_prefix_trie)}

# For the SQL only: A-Z as a-z, and the terms of a text.
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

ORACLE_SQL = {
    "op5_line_dedup": f"""
with lines as (
  select distinct doc_id, text, string_split(text, chr(10)) as parts from documents where text is not null),
windows as (
  select doc_id, text, i, array_to_string(list_slice(parts, i + 1, i + {line_dedup.RUN}), chr(10)) as content
  from (select doc_id, text, parts, unnest(range(0, greatest(len(parts) - {line_dedup.RUN - 1}, 0))) as i from lines)),
placed as (
  select *, row_number() over (partition by content order by doc_id nulls first, i) as place from windows),
gone as (
  select distinct doc_id, text, unnest(range(i, i + {line_dedup.RUN})) as j from placed where place > 1),
listed as (select doc_id, text, list(j) as js from gone group by all)
select d.doc_id,
       case when d.text is null then 0 else len(string_split(d.text, chr(10))) end as n_lines,
       coalesce(len(g.js), 0) as n_removed,
       sha256(case when g.js is null then coalesce(d.text, '') else
         array_to_string(list_transform(list_filter(range(0, len(string_split(d.text, chr(10)))),
           lambda j: not list_contains(g.js, j)), lambda j: string_split(d.text, chr(10))[j + 1]), chr(10)) end) as kept_sha256
from documents d left join listed g on d.doc_id is not distinct from g.doc_id and d.text = g.text
""",
    "op11_phrase_index": f"""
with d as (
  select doc_id, coalesce(regexp_extract_all({_LOWER}, '{_TERM}'), []) as w from documents),
b as (
  select item_id, regexp_extract_all({_LOWER}, '{_TERM}') as w from benchmark where text is not null),
cut as (
  select distinct item_id, least(len(w), 10) as k, array_to_string(list_slice(w, i, i + 9), ' ') as g
  from (select *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from b where len(w) > 0)),
sizes as (select distinct k from cut),
grams as (
  select doc_id, i, k, array_to_string(list_slice(w, i, i + k - 1), ' ') as g
  from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as i from d, sizes where len(w) >= k)),
found as (select g.doc_id, g.i, g.k, c.item_id from grams g join cut c on g.k = c.k and g.g = c.g),
words as (select doc_id, count(*) as n_hit from (
  select distinct doc_id, unnest(range(i, i + k)) as p from (select distinct doc_id, i, k from found)) group by doc_id),
items as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as joined from (
  select distinct doc_id, cast(item_id as varchar) as item from found) group by doc_id)
select d.doc_id, cast(len(d.w) as bigint) as n_words, coalesce(words.n_hit, 0) as n_hit,
       coalesce(items.n_items, 0) as n_items, sha256(coalesce(items.joined, '')) as items_sha256,
       coalesce(words.n_hit, 0) > 0 as contaminated
from d left join words using (doc_id) left join items using (doc_id)
""",
    "op12_mask_search": f"""
with words as (
  select doc_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) as t from documents where text is not null),
tf as (select doc_id, t, count(*) as tf from words group by doc_id, t),
n as (select doc_id, cast(sum(tf) as bigint) as n from tf group by doc_id),
total as (select count(*) as docs, cast(sum(n) as bigint) as terms from n),
asked as (
  select item_id, t, count(*) as repeats from (
    select item_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) as t from benchmark where text is not null) group by item_id, t),
weights as (
  select t, cast(floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)::double)) as bigint) as w
  from (select t, count(*) as df from tf group by t), total),
scored as (
  select a.item_id, tf.doc_id, cast(sum(a.repeats * w.w *
    ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (25 + (75 * n.n * total.docs) // total.terms)))) as bigint) as score
  from asked a join weights w using (t) join tf using (t) join n using (doc_id), total group by a.item_id, tf.doc_id),
ranked as (
  select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scored where score > 0)
select item_id, cast(rank as int) as rank, doc_id, score from ranked where rank <= 10
""",
    "op13_prefix_trie": """
with t as (
  select conv_id as c, row_number() over (partition by conv_id order by turn nulls first, role, text) as p,
         coalesce(role, '') as role, coalesce(text, '') as said from conversations where conv_id is not null),
-- crc32 of the decimal number, bit by bit
convs as (
  select c, c - c % 20 as base, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(
    string_split(cast(c as varchar), ''), lambda x: cast(ascii(x) as bigint))),
    lambda a, x: list_reduce([xor(a, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: xor(y >> 1, (y & 1) * 3988292384))), 4294967295) % 4 as h
  from (select distinct c from t)),
borrowed as (select v.c, t.p as d, t.role, t.said from convs v join t on t.c = v.base and t.p <= v.h),
taken as (select c, count(*) as n from borrowed group by c),
turns as (
  select * from borrowed union all
  select t.c, t.p - v.h + coalesce(k.n, 0), t.role, t.said
  from t join convs v on t.c = v.c left join taken k on k.c = t.c where t.p > v.h),
steps as (
  select c, d, len(regexp_extract_all(said, '[^\\x20\\x09-\\x0D]+')) as words,
         string_agg(sha256(len(role) || ':' || role || said), '' order by d) over (partition by c order by d) as path
  from turns),
prefixes as (select c, 0 as d, 0 as words, '' as path from convs union all select * from steps),
nodes as (select d, path, min(c) as conv_id, count(*) as n_convs, min(words) as words from prefixes group by d, path),
lasts as (select c, max(d) as d from prefixes group by c),
ended as (
  select a.d, a.path, string_agg(cast(a.c as varchar), ',' order by a.c) as joined
  from prefixes a join lasts using (c, d) group by a.d, a.path),
-- the prefixes of a node are those of the conversation that names it
above as (select n.conv_id, n.d, n.n_convs, n.words, a.d as up_d, a.path as up
          from nodes n join prefixes a on a.c = n.conv_id and a.d <= n.d),
children as (select up_d as d, up as path, count(*) as n from above where up_d = d - 1 group by 1, 2),
leaves as (select b.up_d as d, b.up as path, count(*) as n from above b
           join nodes n on n.conv_id = b.conv_id and n.d = b.d
           left join children k on k.d = n.d and k.path = n.path where k.n is null group by 1, 2),
saved as (select up_d as d, up as path, cast(sum((n_convs - 1) * words) as bigint) as n from above group by 1, 2),
parents as (select b.conv_id, b.d, p.conv_id as parent from above b join nodes p on p.d = b.up_d and p.path = b.up
            where b.up_d = b.d - 1)
select n.conv_id, cast(n.d as bigint) as depth, p.parent as parent_conv_id, n.n_convs, coalesce(k.n, 0) as n_children,
       l.n as n_leaves, s.n as saved_tokens, sha256(coalesce(e.joined, '')) as ends_sha256
from nodes n left join parents p on p.conv_id = n.conv_id and p.d = n.d
left join children k on k.d = n.d and k.path = n.path left join leaves l on l.d = n.d and l.path = n.path
left join saved s on s.d = n.d and s.path = n.path left join ended e on e.d = n.d and e.path = n.path
""",
}
