"""One query per operator over the test tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gidlake.llm import (byte_bpe, decontamination, neighbours, packing, passages, pii, prefixes, quality, repair, secrets, simhash,
                         spelling, toxicity)
from gidlake.llm.common import table


def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_repair_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_tokens(table(spark, sf_dir, "documents"))


def op4_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.substring_duplicates(table(spark, sf_dir, "documents"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_packing(table(spark, sf_dir, "documents"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_neighbours(table(spark, sf_dir, "embeddings"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.byte_bpe_digest(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_personal_data, op2_toxicity, op3_repair_tokens, op4_passages, op5_best_fit_packing, op6_secrets, op7_decontamination, op8_quality,
    op9_simhash, op10_neighbours, op11_spelling, op12_prefix_trie, op13_byte_bpe)}
SQL = {
    "op7_decontamination": """
with d as (select row_number() over () rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') w from documents),
b as (select cast(item_id as varchar) item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') w from benchmark),
bw as (select distinct item_id, k, array_to_string(w[i:i + k - 1], ' ') s
       from (select item_id, w, least(13, len(w)) k, unnest(range(1, len(w) - least(13, len(w)) + 2)) i from b where len(w) > 0)),
sizes as (select distinct k from bw),
dw as (select rid, i, k, array_to_string(w[i:i + k - 1], ' ') s from (select rid, w, k, unnest(range(1, len(w) - k + 2)) i from d, sizes where len(w) >= k)),
m as (select rid, i, dw.k, item_id from dw join bw on dw.s = bw.s and dw.k = bw.k),
hit as (select rid, count(distinct p) n from (select rid, unnest(range(i, i + k)) p from (select distinct rid, i, k from m)) group by rid),
it as (select rid, count(distinct item_id) n, string_agg(distinct item_id, ',' order by item_id) s from m group by rid)
select doc_id, cast(len(w) as bigint) n_words, cast(coalesce(hit.n, 0) as bigint) n_hit, cast(coalesce(it.n, 0) as bigint) n_items,
       sha256(coalesce(it.s, '')) items_sha256, coalesce(hit.n, 0) > 0 and 20 * coalesce(hit.n, 0) >= len(w) contaminated
from d left join hit using (rid) left join it using (rid)""",
    "op12_prefix_trie": """
with t as (select conv_id, coalesce(role, '') r, coalesce(text, '') t,
             row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) k
           from conversations where conv_id is not null),
c as (select conv_id, list({'r': r, 't': t} order by k) own,
        xor(list_reduce(list_concat([4294967295], list_transform(string_split(cast(conv_id as varchar), ''), lambda x: cast(ascii(x) as bigint))),
          lambda crc, x: list_reduce([xor(crc, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, i: xor(v >> 1, (v & 1) * 3988292384))), 4294967295) % 6 h
      from t group by conv_id),
b as (select c.conv_id, list_concat(coalesce(base.own[1:c.h], []), c.own[c.h + 1:]) s from c left join c base on base.conv_id = c.conv_id - c.conv_id % 100),
p as (select conv_id, d, len(s) size, s[1:d] head, cast(case when d > 0 then length(s[d].t) else 0 end as bigint) chars
      from (select *, unnest(range(0, len(s) + 1)) d from b)),
m as (select conv_id, d, size, chars, min(conv_id) over (partition by head) rep from p),
n as (select rep conv_id, d, count(*) n_convs, any_value(chars) chars, sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where d = size), '')) ends_sha256
      from m group by rep, d),
u as (select n.*, m.rep parent_conv_id from n left join m on m.conv_id = n.conv_id and m.d = n.d - 1),
k as (select parent_conv_id conv_id, d - 1 d, count(*) n_children from u where d > 0 group by all),
e as (select u.*, coalesce(n_children, 0) n_children from u left join k using (conv_id, d)),
x as (select m.rep conv_id, m.d, sum(cast(e.n_children = 0 as bigint)) n_leaves, sum((e.n_convs - 1) * e.chars) saved from e join m on m.conv_id = e.conv_id and m.d <= e.d group by m.rep, m.d)
select e.conv_id, cast(e.d as bigint) depth, e.parent_conv_id, e.n_convs, e.n_children, cast(x.n_leaves as bigint) n_leaves, cast(x.saved as bigint) saved_tokens, e.ends_sha256
from e join x using (conv_id, d)""",
}
