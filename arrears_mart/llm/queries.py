"""The operators as queries over the test tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears_mart.llm import alignment, language, line_rules, mixing, phrase_index, pii, ranked_search, sharding, simhash, token_counts, toxicity, url_filter, weak_labels
from arrears_mart.stages import stage_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op2_toxicity")
def op2(spark, folder):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    scored = toxicity.score_documents(docs.select("doc_id", "text"), labels)
    return scored.select("doc_id", "held_out", "score", "predicted")


@query("op5_simhash")
def op5(spark, folder):
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


_PHRASE_SQL = r"""
with d as (
  select doc_id, [x for x in regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') if x <> ''] w from documents
), b as (
  select item_id, [x for x in regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') if x <> ''] w from benchmark
), win as (
  select item_id, least(len(w), 10) size, array_to_string(list_slice(w, s, s + 9), ' ') g
  from b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) t(s) where len(w) > 0
), lengths as (select distinct size from win), grams as (
  select doc_id, s, size, array_to_string(list_slice(w, s, s + size - 1), ' ') g
  from d, lengths, unnest(range(1, len(w) - size + 2)) t(s)
), found as (
  select distinct doc_id, s, grams.size, item_id from grams join win using (g) where grams.size = win.size
), hits as (
  select doc_id, count(distinct p) n_hit from (select doc_id, unnest(range(s, s + size)) p from found) group by 1
), items as (
  select doc_id, count(*) n_items, string_agg(i, ',' order by i) l
  from (select distinct doc_id, cast(item_id as varchar) i from found where item_id is not null) group by 1
)
select doc_id, cast(len(w) as bigint) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items,
  sha256(coalesce(l, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from d left join hits using (doc_id) left join items using (doc_id)
"""


@query("op9_decontamination", _PHRASE_SQL)
def op9(spark, folder):
    found = phrase_index.decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    digest = F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")


@query("op1_sharding")
def op1(spark, folder):
    placed = sharding.shard_documents(table(spark, folder, "documents").select("doc_id", "text"))
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


_WORDS_SQL = r"[x for x in regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') if x <> '']"


def _seats_sql(name: str, units: str, group: str, unit: str, size: str) -> str:
    """Common table expressions that deal `seats` to units by highest quotients; the last one is `name`."""
    over = f"partition by {group}" if group else ""
    return f"""{name}_base as (
  select *, cast(floor(({size} * case when 2 * seats > n and total > 0 then (2 * seats - n) / total else 0 end + 1) / 2)
    as bigint) base from (select *, count(*) over ({over}) n, cast(sum({size}) over ({over}) as double) total from {units})
), {name}_open as (select *, seats - sum(base) over ({over}) open from {name}_base
), {name}_asked as (
  select *, row_number() over ({over} order by {size} / (2 * (base + more) + 1) desc, {unit}, more) place
  from {name}_open, unnest(range(0, n + 1)) t(more) where {size} > 0
), {name}_won as (
  select {f"{group}, " if group else ""}{unit}, count(*) won from {name}_asked where place <= open group by all
), {name} as (
  select * exclude (base, n, total, open, won), base + coalesce(won, 0) quota
  from {name}_open left join {name}_won using ({f"{group}, " if group else ""}{unit})
)"""


_MIX_SQL = f"""
with sized as (
  select doc_id, coalesce(source, '') src, source is null none, len({_WORDS_SQL}) size,
    md5('mix|' || coalesce(cast(doc_id as varchar), '')) code from documents
), binned as (select *, cast('0x' || substr(code, 1, 3) as integer) bin from sized
), totals as (
  select *, row_number() over (order by none, src) - 1 as rank from (
    select src, none, cast(sum(size) as bigint) source_size from binned group by 1, 2)
), weighted as (select *, case rank % 3 when 0 then 5 when 1 then 2 else 1 end weight, 3 * source_size cap from totals
), leveled as (
  select *, (sum(source_size) over () - coalesce(sum(cap) over (order by cap / weight, rank
      rows between unbounded preceding and 1 preceding), 0))
    / sum(weight) over (order by cap / weight, rank rows between current row and unbounded following) as lvl from weighted
), goal as (
  select src, none, rank, source_size, least(cast(cap as double), weight * max(lvl) over ()) target,
    cast(greatest(least(64, floor(sum(source_size) over () / 10000)), 1) as bigint) tokens,
    sum(source_size) over () everything from leveled
), seated as (select *, cast(floor(everything / tokens + 0.5) as bigint) seats from goal
), {_seats_sql("by_source", "seated", "", "rank", "target")}
, shards as (
  select src, none, bin // 256 as shard, cast(sum(size) as bigint) length from binned group by 1, 2, 3
), shared as (
  select s.*, b.source_size, b.target, b.tokens, b.quota seats from shards s join by_source b using (src, none)
), {_seats_sql("dealt", "shared", "src, none", "shard", "length")}
, placed as (
  select *, bin // 256 as shard, coalesce(sum(size) over (partition by src, none, bin // 256 order by bin, code, doc_id, size
    rows between unbounded preceding and 1 preceding), 0) start from binned
), joined as (
  select p.*, d.source_size, d.target, d.length, least(d.quota * d.tokens, 3 * d.length) take
  from placed p join dealt d using (src, none, shard)
)
select doc_id, cast(size as bigint) size, source_size, target, cast(case when length = 0 then 0 else
  (take // length) * size + greatest(least(take % length - start, size), 0) end as bigint) taken from joined
"""


@query("op8_mixing", _MIX_SQL)
def op8(spark, folder):
    docs = table(spark, folder, "documents")
    sized = docs.select("doc_id", "source", mixing.token_size(F.col("text")).alias("size"))
    taken = mixing.mix(stage_table(sized, "mix-sizes"))
    return taken.select("doc_id", "size", "source_size", "target", "taken")


@query("op6_token_counts")
def op6(spark, folder):
    counted = token_counts.count_tokens(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 4096)


_LINES_SQL = rf"""
with docs as (
  select doc_id, coalesce(source, '') host, source is null as none, coalesce(text, '') text, {_WORDS_SQL} w,
    [x for x in string_split(coalesce(text, ''), chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] l from documents
), windows as (
  select doc_id, p, array_to_string(list_slice(w, p, p + 4), ' ') g from docs, unnest(range(1, len(w) - 3)) t(p)
), twice as (
  select doc_id, p from (select doc_id, p, count(*) over (partition by doc_id, g) n from windows) where n > 1
), covered as (
  select doc_id, count(distinct q) n from (select doc_id, unnest(range(p, p + 5)) q from twice) group by 1
), line as (
  select doc_id, host, none, trim(regexp_replace(translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x20\x09-\x0D]+', ' ', 'g')) t, len([y for y in regexp_split_to_array(x, '[\x20\x09-\x0D]+') if y <> '']) held
  from (select doc_id, host, none, unnest(l) x from docs)
), frequent as (
  select host, none, t from line join (select host, none, count(distinct doc_id) documents from docs group by 1, 2) using (host, none)
  group by host, none, t, documents having count(distinct doc_id) > 10 and count(distinct doc_id) > 0.001 * documents
), removed as (
  select doc_id, sum(held) r from line join frequent using (host, none, t) group by 1
), base as (
  select doc_id, cast(len(w) as bigint) n_words, cast(length(array_to_string(w, '')) as bigint) word_chars,
    cast(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) as bigint) n_symbols,
    cast(len(l) - len(list_distinct(l)) as bigint) n_dup_lines, coalesce(n, 0) n_repeat_words, coalesce(r, 0) r
  from docs left join covered using (doc_id) left join removed using (doc_id)
)
select * exclude r, n_words < 10 or 100 * n_repeat_words > 20 * n_words base_failed,
  not (n_words < 10 or 100 * n_repeat_words > 20 * n_words) and n_words - r >= 0.5 * n_words kept from base
"""


@query("op4_line_rules", _LINES_SQL)
def op4(spark, folder):
    return line_rules.judge_documents(table(spark, folder, "documents")).drop("n_removed")


@query("op7_url_filter")
def op7(spark, folder):
    return url_filter.judge_urls(table(spark, folder, "pages")).drop("score")


@query("op10_pii")
def op10(spark, folder):
    return pii.digest(pii.detect(table(spark, folder, "documents")))


@query("op3_weak_labels")
def op3(spark, folder):
    scored = weak_labels.score_quality(table(spark, folder, "documents").select("doc_id", "text"))
    return scored.select("doc_id", "score", "kept")


_SEARCH_SQL = r"""
with d as (
  select doc_id, [x for x in regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') if x <> ''] t from documents
), i as (
  select item_id, unnest([x for x in regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') if x <> '']) term from benchmark
), total as (select count(*) docs, sum(len(t)) held from d where len(t) > 0
), posted as (
  select doc_id, term, count(*) tf, any_value(n) n from (select doc_id, len(t) n, unnest(t) term from d) group by all
), weighted as (
  select term, cast(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) as bigint) w
  from posted, total group by term, docs
), scored as (
  select item_id, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // held)))) as bigint) score
  from i join posted using (term) join weighted using (term), total group by item_id, doc_id
)
select item_id, cast(rank as integer) as rank, doc_id, score from (
  select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scored where score > 0
) where rank <= 20
"""


@query("op13_ranked_search", _SEARCH_SQL)
def op13(spark, folder):
    return ranked_search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op11_alignment")
def op11(spark, folder):
    first, second = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    found = alignment.align_documents(table(spark, folder, "documents"), first, second)
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@query("op12_language")
def op12(spark, folder):
    return language.identify(table(spark, folder, "documents"))
