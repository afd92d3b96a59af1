"""Registered queries of the training-data operators, with SQL where it can express them."""

from __future__ import annotations

from opsfold.llm import (
    alignment,
    decontaminate,
    linededup,
    linefreq,
    neardup,
    passages,
    repeats,
    search,
    tokencount,
    toxicity,
)
from opsfold.llm.frames import documents, prepare
from opsfold.llm.packing import pack
from opsfold.llm.sharding import shard_rows
from opsfold.llm.wavelet import write_and_read

SHARDS = 40


def op1_feistel_sharding(spark, sf_dir):
    prepare(spark)
    return shard_rows(documents(spark, sf_dir), SHARDS)


def op2_near_duplicate_passages(spark, sf_dir):
    prepare(spark)
    return passages.near_duplicate_passages(documents(spark, sf_dir))


def op3_near_duplicates(spark, sf_dir):
    prepare(spark)
    found = neardup.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", "class_id", "class_size", "is_kept")


def op4_toxicity(spark, sf_dir):
    prepare(spark)
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.score(docs, toxicity.train(docs, labels, toxicity.label_categories()))


def op5_best_fit_packing(spark, sf_dir):
    prepare(spark)
    return pack(documents(spark, sf_dir))


def op6_decontamination(spark, sf_dir):
    prepare(spark)
    return decontaminate.matches(documents(spark, sf_dir),
                                 spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op7_line_frequency(spark, sf_dir):
    prepare(spark)
    return linefreq.line_frequency_filter(documents(spark, sf_dir))


def op8_wavelet_tokens(spark, sf_dir):
    prepare(spark)
    return write_and_read(documents(spark, sf_dir))


def op9_repeated_bytes(spark, sf_dir):
    prepare(spark)
    return repeats.repeated_bytes(documents(spark, sf_dir)).drop("spans")


def op10_edited_token_counts(spark, sf_dir):
    prepare(spark)
    return tokencount.edited_counts(documents(spark, sf_dir))


def op11_token_alignment(spark, sf_dir):
    prepare(spark)
    return alignment.align(documents(spark, sf_dir))


def op12_ranked_search(spark, sf_dir):
    prepare(spark)
    return search.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_line_dedup(spark, sf_dir):
    prepare(spark)
    return linededup.line_digests(documents(spark, sf_dir))


def queries():
    return {f.__name__: f for f in (
        op1_feistel_sharding, op2_near_duplicate_passages, op3_near_duplicates, op4_toxicity,
        op5_best_fit_packing, op6_decontamination, op7_line_frequency, op8_wavelet_tokens,
        op9_repeated_bytes, op10_edited_token_counts, op11_token_alignment,
        op12_ranked_search, op13_line_dedup)}


# Plain SQL for the line-frequency query: windows of eight words are unnested and grouped.
LINE_FREQUENCY_SQL = rf"""
with d as (select row_number() over () as r, doc_id, source, coalesce(text, '') as t from documents),
w as (select *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls
      from d),
at8 as (select doc_id, ws, unnest(generate_series(1, len(ws) - 7)) as i from w),
win as (select doc_id, i, array_to_string(ws[i:i + 7], ' ') as k from at8),
twice as (select doc_id, k from win group by doc_id, k having count(*) > 1),
inside as (select distinct doc_id, unnest(generate_series(i, i + 7)) as j
           from win join twice using (doc_id, k)),
covered as (select doc_id, count(*) as n from inside group by doc_id),
lines as (select r, doc_id, source,
                 trim(regexp_replace(lower(unnest(ls)), '[\x20\x09-\x0D]+', ' ', 'g')) as line from w),
limits as (select source, greatest({linefreq.MIN_DOCS}, count(*) * {linefreq.MAX_SHARE}) as most
           from d group by source),
frequent as (select source, line from lines join limits using (source)
             group by source, line, most having count(distinct r) > most),
removed as (select doc_id, sum(length(line) - length(replace(line, ' ', '')) + 1) as n
            from lines join frequent using (source, line) group by doc_id),
c as (select w.doc_id, cast(len(ws) as bigint) as n_words,
             cast(length(array_to_string(ws, '')) as bigint) as word_chars,
             cast(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
             cast(len(ls) - len(list_distinct(ls)) as bigint) as n_dup_lines,
             cast(coalesce(covered.n, 0) as bigint) as n_repeat_words,
             cast(coalesce(removed.n, 0) as bigint) as n_removed_words
      from w left join covered using (doc_id) left join removed using (doc_id)),
f as (select *, n_words < {linefreq.MIN_WORDS}
                or 100 * n_repeat_words > {linefreq.MAX_REPEAT_PERCENT} * n_words as base_failed from c)
select *, not base_failed and n_words - n_removed_words >= {linefreq.MIN_KEPT_WORDS}
          and n_words - n_removed_words >= {linefreq.MIN_KEPT_SHARE} * n_words as kept
from f"""


# Rows are numbered, so that equal ids and texts stay documents of their own.
LINE_DEDUP_SQL = rf"""
with d as (select row_number() over () as r, doc_id,
                  string_split(coalesce(text, ''), chr(10)) as ls from documents),
l as (select r, unnest(ls) as line, unnest(generate_series(1, len(ls))) as pos from d),
k as (select *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                          '{linededup.UPPER}', '{linededup.LOWER}') as key from l),
frequent as (select key from k where length(key) >= {linededup.MIN_CHARS}
             group by key having count(distinct r) >= {linededup.MIN_DOCS}),
m as (select k.*, f.key is null as stays from k left join frequent f on k.key = f.key)
select any_value(d.doc_id) as doc_id, count(*) as n_lines,
       count(*) filter (not stays) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (stays), '')) as kept_sha256
from m join d using (r) group by r"""


# Only A-Z are lower-cased; "documents" are numbered, as ids may repeat.
RANKED_SEARCH_SQL = rf"""
with d as (select row_number() over () as r, doc_id, regexp_extract_all(
             translate(text, '{linededup.UPPER}', '{linededup.LOWER}'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as ts from documents),
t as (select r, unnest(ts) as term from d),
tfs as (select r, term, count(*) as tf from t group by r, term),
sizes as (select r, sum(tf)::bigint as n from tfs group by r),
totals as (select count(*) as nn, sum(n)::bigint as ll from sizes),
norms as (select r, 50 + ((50 * n * nn) // ll) as m from sizes, totals),
dfs as (select term, count(*) as df from tfs group by term),
items as (select row_number() over () as i, item_id, list_distinct(regexp_extract_all(
            translate(text, '{linededup.UPPER}', '{linededup.LOWER}'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as ts from benchmark),
wanted as (select i, item_id, unnest(ts) as term from items),
weighed as (select i, item_id, term,
                   floor(1000 * ln((2 * nn + 2)::double / (2 * df + 1)::double))::bigint as w
            from wanted join dfs using (term), totals),
scores as (select i, item_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::bigint as score
           from weighed join tfs using (term) join norms using (r) group by i, item_id, r),
ranked as (select item_id, row_number() over (partition by i order by score desc,
                                              doc_id nulls first)::integer as rank, doc_id, score
           from scores join d using (r) where score > 0)
select item_id, rank, doc_id, score from ranked where rank <= {search.TOP}"""


def oracle_sql():
    return {"op7_line_frequency": LINE_FREQUENCY_SQL, "op12_ranked_search": RANKED_SEARCH_SQL,
            "op13_line_dedup": LINE_DEDUP_SQL}
