"""One query for each operator, over its whole table, with the settings meant for production."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orelayer.llm.byte_bpe import encode_texts
from orelayer.llm.common import table
from orelayer.llm.decontaminate import contaminated
from orelayer.llm.lattice_lm import lattice_scores, read_pieces
from orelayer.llm.lexical_search import rank_documents
from orelayer.llm.line_dedup import dedup_lines
from orelayer.llm.minhash import document_prints
from orelayer.llm.prefix_trie import forked, prefix_nodes, turn_rows
from orelayer.llm.quality_votes import judge
from orelayer.llm.simhash import near_groups
from orelayer.llm.token_spans import section_tokens
from orelayer.llm.toxicity import fit_toxicity, score_toxicity
from orelayer.llm.transcripts import recover_roles
from orelayer.llm.wrappers import extract_text
from orelayer.session import Workspace

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


_LINES = r"""
with d as (select doc_id, coalesce(text, '') as text from documents),
l as (
  select doc_id, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as pos from d
),
k as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l
),
r as (select key, min(doc_id) as first from k where length(key) >= 10 group by key having count(distinct doc_id) >= 2),
m as (select k.doc_id, k.pos, k.line, r.key is not null and k.doc_id <> r.first as gone from k left join r on k.key = r.key)
select doc_id, count(*) as n_lines, cast(sum(case when gone then 1 else 0 end) as bigint) as n_dropped,
       sha256(coalesce(string_agg(case when gone then null else line end, chr(10) order by pos), '')) as kept_sha256
from m group by doc_id
"""


@query("op6_line_dedup", _LINES)
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents"), Workspace(spark, "op6"))
    return out.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op10_quality_votes")
def op10_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, _ = judge(table(spark, sf_dir, "documents"), Workspace(spark, "op10"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality"
    )


@query("op8_simhash")
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"), Workspace(spark, "op8"), width=3, max_bits=3)


@query("op9_byte_bpe")
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode_texts(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, ids_col=False)


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"), Workspace(spark, "op1"))
    return score_toxicity(docs, model)


@query("op2_token_spans")
def op2_token_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return section_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, rule="most")


@query("op4_lattice_lm")
def op4_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces, scores = read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    return lattice_scores(table(spark, sf_dir, "documents"), pieces, scores, Workspace(spark, "op4"), class_col="lang")


@query("op7_decontaminate")
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Workspace(spark, "op7"))


@query("op3_wrappers")
def op3_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"), Workspace(spark, "op3"))


@query("op5_transcripts")
def op5_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recover_roles(table(spark, sf_dir, "conversations"), Workspace(spark, "op5"))


_TRIE = """
with recursive crc as (
  select conv_id, list_reduce(
    list_prepend(4294967295::bigint, flatten(list_transform(string_split(conv_id::varchar, ''), lambda c: [ord(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, x: case when x >= 0 then xor(a, x) else xor(a >> 1, 3988292384::bigint * (a & 1)) end) as c
  from (select distinct conv_id from conversations where conv_id is not null)
),
heads as (select conv_id, xor(c, 4294967295::bigint) % 9 as h from crc),
turns as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id order by turn nulls first, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) as pos
  from conversations where conv_id is not null
),
built as (
  select h.conv_id, t.pos, t.role, t.text from heads h join turns t on t.conv_id = h.conv_id - h.conv_id % 5 and t.pos <= h.h
  union all
  select h.conv_id, 100 + t.pos, t.role, t.text from heads h join turns t on t.conv_id = h.conv_id and t.pos > h.h
),
placed as (select conv_id, row_number() over (partition by conv_id order by pos) as d, md5(strlen(role) || ':' || role || text) as turn, strlen(text) as size from built),
prefixes as (select conv_id, d, string_agg(turn, '') over (partition by conv_id order by d) as prefix, size from placed
             union all select conv_id, 0, '', 0 from heads),
last as (select conv_id, max(d) as d from prefixes group by conv_id),
nodes as (
  select prefix, max(p.d) as depth, min(p.conv_id) as conv_id, count(*) as n_convs, max(size) as size,
         sha256(coalesce(string_agg(case when p.d = l.d then p.conv_id::varchar end, ',' order by p.conv_id), '')) as ends_sha256
  from prefixes p join last l on l.conv_id = p.conv_id group by prefix
),
parents as (select left(prefix, length(prefix) - 32) as prefix, count(*) as n from nodes where depth > 0 group by 1),
counted as (select n.*, coalesce(p.n, 0) as n_children from nodes n left join parents p on p.prefix = n.prefix),
above as (select prefix, unnest(range(0, depth + 1)) as d, n_children, (n_convs - 1) * size as own from counted),
sums as (select left(prefix, (32 * d)::bigint) as prefix, count(*) filter (where n_children = 0) as n_leaves, sum(own) as saved from above group by 1)
select c.conv_id, c.depth::bigint as depth, u.conv_id as parent_conv_id, c.n_convs::bigint as n_convs, c.n_children::bigint as n_children,
       s.n_leaves::bigint as n_leaves, s.saved::bigint as saved_tokens, c.ends_sha256
from counted c join sums s on s.prefix = c.prefix
left join nodes u on c.depth > 0 and u.prefix = left(c.prefix, length(c.prefix) - 32)
"""


@query("op11_prefix_trie", _TRIE)
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_nodes(forked(turn_rows(table(spark, sf_dir, "conversations"))), Workspace(spark, "op11"))


_RANKED = r"""
with t as (
  select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from documents
),
i as (
  select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from benchmark
),
d as (select doc_id, count(*) as n from t group by doc_id),
s as (select count(*) as docs, sum(n)::bigint as terms from d),
f as (select term, doc_id, count(*) as tf from t where term in (select term from i) group by term, doc_id),
w as (select term, floor(1000 * ln((2 * s.docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w from f, s group by term, s.docs),
m as (select doc_id, 100 - 50 + (50 * n * s.docs) // s.terms as m from d, s),
r as (
  select i.item_id, f.doc_id, sum(w.w * ((1000000000 * f.tf) // (1000 * f.tf + 20 * m.m)))::bigint as score
  from i join f on f.term = i.term join w on w.term = i.term join m on m.doc_id = f.doc_id group by 1, 2
),
o as (select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score from r where score > 0)
select * from o where rank <= 50
"""


@query("op13_lexical_search", _RANKED)
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Workspace(spark, "op13"))


@query("op12_minhash")
def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = document_prints(table(spark, sf_dir, "documents"), Workspace(spark, "op12"))
    text = lambda c: F.lower(F.hex(c)).alias(c)
    return out.select(
        F.col("id").alias("doc_id"), "n_chars", text("edited_sha256"), text("fingerprint"), text("edited_fingerprint"), "near_edited", "near_next", "component_id"
    )
