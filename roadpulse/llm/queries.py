"""Registered queries of the text operators and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.align import alignment_counts
from roadpulse.llm.chat import format_reply_trees, read_turns, reply_chains, text_under_loss
from roadpulse.llm.common import id_remainder
from roadpulse.llm.decontaminate import find_contamination
from roadpulse.llm.exact import exact_groups
from roadpulse.llm.infill import fill_in_middle, restore_middle
from roadpulse.llm.language import identify, train_language_model
from roadpulse.llm.lm import lm_scores
from roadpulse.llm.mixing import mix_sources
from roadpulse.llm.quality import score_quality, train_quality_model
from roadpulse.llm.repeats import repeated_passages
from roadpulse.llm.secrets import (
    KINDS,
    find_secrets,
    joined_spans,
    labelled_tokens,
    train_secret_model,
)
from roadpulse.llm.sharding import shard_documents
from roadpulse.llm.simhash import near_groups


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _held_out(divisor: int, remainder: int):
    """Whether the hash of an id keeps a row out of learning; a null id is never learned from."""
    return id_remainder(F.col("doc_id"), divisor) == remainder


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = train_language_model(docs, ~_held_out(4, 2))
    return identify(docs, model).select(
        "doc_id", F.coalesce(_held_out(4, 2), F.lit(False)).alias("held_out"),
        "lang_pred", "score", "rejected",
    )


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = train_quality_model(docs, labels, ~_held_out(5, 0))
    return score_quality(docs, model).select(
        "doc_id", F.coalesce(_held_out(5, 0), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"), "difference",
    )


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = train_secret_model(labelled_tokens(docs))
    # Where the list of spans of a text without secrets is empty, so is every column.
    spans = find_secrets(docs, model)

    def of_kind(kind: str):
        return F.filter("spans", lambda s: s["kind"] == KINDS.index(kind))

    def number(kind: str):
        return F.size(of_kind(kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != KINDS.index("random"))
    return spans.select(
        "doc_id", number("assign"), number("access"), number("hex"), number("random"),
        F.sha2(joined_spans(base), 256).alias("base_sha256"),
        joined_spans(F.col("spans")).alias("spans"),
    )


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    digits = F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint")
    return near_groups(_table(spark, sf_dir, "documents")).select("doc_id", digits, "component_id")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(_table(spark, sf_dir, "documents"), 40)


def op6_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores, model = lm_scores(_table(spark, sf_dir, "documents"), ~_held_out(10, 0))
    return scores.select(
        "doc_id", F.coalesce(_held_out(10, 0), F.lit(False)).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("bigint").alias("train_tokens"), "base_score", "score",
    )


def op7_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(_table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("word_ranges", F.lit(0).cast("bigint"),
                      lambda total, r: total + r["stop"] - r["start"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"),
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Longer documents are preferred: twofold from 50 words, fourfold from 500."""
    return mix_sources(_table(spark, sf_dir, "documents"), size_steps=((50, 2.0), (500, 4.0))).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_counts(_table(spark, sf_dir, "documents"))


def op12_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256"]
    formatted = fill_in_middle(_table(spark, sf_dir, "documents"))
    return restore_middle(formatted, carry=kept).select(*kept, "restored_sha256")


def _escape_probe(spark: SparkSession) -> DataFrame:
    """Conversation -7: both turns say control strings and a backslash."""
    first = F.col("id") == 0
    return spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(first, "user").otherwise("assistant").alias("role"),
        F.lit(r"\### Assistant: </turn> ok").alias("text"),
    )


def op13_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    messages, links = reply_chains(said.unionByName(_escape_probe(spark)))
    chats = format_reply_trees(messages, links, best=1)
    turns = F.transform(
        read_turns(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    )
    loss = text_under_loss(F.col("formatted"), F.col("spans"))
    return chats.withColumns({"said": turns, "loss": loss}).select(
        F.col("tree").alias("conv_id"), F.size("said").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join("said", ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )


QUERIES = {
    f.__name__: f
    for f in (op1_language, op2_quality, op3_secrets, op4_simhash, op5_sharding, op6_lm, op7_exact, op8_decontamination, op9_repeats, op10_mixing, op11_alignment, op12_infill, op13_chat)
}

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_WINDOWS = r"""
with words as (
    select doc_id, doc_id as d, list_filter(string_split_regex({lowered}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w
    from documents
), items as (
    select cast(item_id as varchar) as item, list_filter(string_split_regex({lowered}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w
    from benchmark
), windows as (
    select distinct item, least(len(w), 10) as k,
           array_to_string(w[pos : pos + least(len(w), 10) - 1], ' ') as passage
    from (select item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as pos from items where len(w) > 0)
), lengths as (select distinct k from windows
), places as (
    select d, k, pos, array_to_string(w[pos : pos + k - 1], ' ') as passage
    from (select d, w, k, unnest(range(1, len(w) - k + 2)) as pos from words, lengths where len(w) >= k)
), found as (
    select d, p.k, pos, item from places p join windows n on p.passage = n.passage and p.k = n.k
), hits as (
    select d, count(distinct word) as n_hit from (select d, unnest(range(pos, pos + k)) as word from found) group by d
), who as (
    select d, count(*) as n_items, string_agg(item, ',' order by item) as ids from (select distinct d, item from found) group by d
)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit,
       coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from words left join hits using (d) left join who using (d)
"""

ORACLES = {
    "op7_exact": f"""
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
       doc_id = max(doc_id) over same as kept, sha256(t) as text_sha256
from (select doc_id, {_LOWERED} as t from documents)
window same as (partition by t)
""",
    "op8_decontamination": _WINDOWS.format(lowered=_LOWERED),
    "op10_mixing": r"""
with recursive sized as (
    select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
           (cast('0x' || substr(md5(concat(coalesce(cast(doc_id as varchar), ''), ':', md5(coalesce(text, '')))), 1, 13) as bigint) + 0.5)
             / 4503599627370496.0 as u
    from documents
), sources as (
    select source, cast(sum(size) as bigint) as source_size,
           [5, 2, 1][1 + cast((row_number() over (order by source nulls last) - 1) % 3 as int)] as weight
    from sized group by source
), steps as (
    select *, sum(source_size * 3) over fill as closed, sum(weight) over fill as closed_weight,
           coalesce(sum(source_size * 3) over earlier, 0) as before,
           coalesce(sum(weight) over earlier, 0) as before_weight,
           sum(source_size) over () as words, sum(weight) over () as weights
    from sources
    window fill as (order by source_size / weight, source nulls last rows unbounded preceding),
           earlier as (order by source_size / weight, source nulls last rows between unbounded preceding and 1 preceding)
), marked as (
    select *, source_size * 3 * (weights - before_weight) <= weight * (words - before) as full from steps
), level as (
    select max(words) - coalesce(sum(case when "full" then source_size * 3 end), 0) as remaining,
           max(weights) - coalesce(sum(case when "full" then weight end), 0) as shares
    from marked
), targets as (
    select source, source_size,
           case when "full" then cast(source_size * 3 as double)
                else cast(weight * remaining as double) / cast(shares as double) end as target
    from marked, level
), planned as (
    select *, case when source_size > 0 then cast(floor(target / source_size) as bigint) else 0 end as whole from targets
), started as (
    select *, target - whole * source_size as words_left,
           case when source_size > 0 then target / source_size - whole else 0 end as p from planned
), tastes as (
    select source, taste, sum(size) as words
    from (select *, case when size >= 500 then 4.0::double when size >= 50 then 2.0::double else 1.0::double end as taste from sized)
    group by all
), lists as (
    select source, list({'taste': taste, 'words': words::double} order by taste) as entries from tastes group by source
), halved as (
    select s.source, s.words_left, l.entries, 0.0::double as low, 1.0::double as high, 0 as step
    from started s join lists l on s.source is not distinct from l.source
    union all
    select source, words_left, entries, case when short then middle else low end, case when short then high else middle end, step + 1
    from (
        select *, (low + high) / 2 as middle,
               list_sum(list_transform(entries, lambda e: e.words * (1 - pow(1 - (low + high) / 2, e.taste)))) < words_left as short
        from halved where step < 52
    )
), chances as (
    select s.*, p.source_size, p.target, p.whole, p.words_left, p.p,
           1 - pow(1 - h.high, case when s.size >= 500 then 4.0::double when s.size >= 50 then 2.0::double else 1.0::double end) as chance
    from sized s join started p on s.source is not distinct from p.source
    join halved h on s.source is not distinct from h.source and h.step = 52
), ranked as (
    select *, u * (1 - chance) / (u * (1 - chance) + (1 - u) * chance) as z from chances
), running as (
    select *, sum(size) over (partition by source order by z, doc_id, size rows unbounded preceding) as ends from ranked
)
select doc_id, size, source_size, target,
       cast((whole + case when p > 0 and 2 * ends - size <= 2 * words_left then 1 else 0 end) * size as bigint) as taken
from running
""",
    "op12_infill": r"""
with draws as (
    select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') as lines,
           sha256(concat('7:', coalesce(cast(doc_id as varchar), ''))) as h
    from documents
), cuts as (
    select *, cast(len(lines) as bigint) as n,
           cast(concat('0x', substr(h, 1, 8)) as bigint) % (len(lines) + 1) as one,
           cast(concat('0x', substr(h, 9, 8)) as bigint) % (len(lines) + 1) as two,
           case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') then 'plain'
                when cast(concat('0x', substr(h, 25, 8)) as bigint) % 100 < 50 then 'spm' else 'psm' end as form
    from draws
), parts as (
    select *, array_to_string(lines[1 : least(one, two)], '') as prefix,
           array_to_string(lines[least(one, two) + 1 : greatest(one, two)], '') as middle,
           array_to_string(lines[greatest(one, two) + 1 :], '') as suffix
    from cuts
)
select doc_id, n, form,
       case when form <> 'plain' then length(prefix) end as prefix_chars,
       case when form <> 'plain' then length(middle) end as middle_chars,
       sha256(case form when 'plain' then t when 'psm' then concat('<P>', prefix, '<S>', suffix, '<M>', middle)
                        else concat('<S>', suffix, '<P>', prefix, '<M>', middle) end) as output_sha256,
       sha256(t) as restored_sha256
from parts
""",
    "op13_chat": r"""
with said as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -7, 0, 'user', '\### Assistant: </turn> ok'
    union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
select conv_id, count(*) as n_turns,
       sha256(string_agg(concat(role, chr(10), text, chr(10)), '' order by turn nulls first, role, text)) as turns_sha256,
       cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
       cast(sum(length(role) + 15 + length(regexp_replace(text, '(### |</turn>)', '\\\1', 'g'))) as bigint) as formatted_chars
from said group by conv_id
""",
}
