"""Queries over the driver's tables, each with the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weft.functions import text as X
from weft.functions.keys import identity_key
from weft.operators import dedupe, graph, identity, reports, rules, sampling, selection, sequential
from weft.session import table
from weft.streaming import metrics

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


DUR_OK = "duration is not null and not isnan(duration) and duration > 0"
MISSING = "('', 'unknown', 'none', 'nan', 'null')"


def sql_key(c: str) -> str:
    k = rf"lower(regexp_replace({c}, '^\s+|\s+$', '', 'g'))"
    return f"(CASE WHEN {k} IN {MISSING} OR trim(regexp_replace({k}, '^[^:]*:', '')) IN {MISSING} THEN NULL ELSE {k} END)"


def ok_clips(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "clips").where(DUR_OK)


# --- text -------------------------------------------------------------------


def sql_norm(c: str) -> str:
    return rf"regexp_replace(nfc_normalize(lower({c})), '[^\p{{L}}\p{{N}}\p{{M}}]', '', 'g')"


@query(f"SELECT clip_id, {sql_norm('text')} AS norm FROM clips WHERE text IS NOT NULL")
def text_norm(s, d):
    return table(s, d, "clips").where("text is not null").select("clip_id", X.normal_text(F.col("text")).alias("norm"))


@query(r"SELECT clip_id, len(regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}]+(?:[''’-][\p{L}\p{M}\p{N}]+)*')) AS words FROM clips WHERE text IS NOT NULL")
def text_tokens(s, d):
    return table(s, d, "clips").where("text is not null").select("clip_id", F.size(X.tokens(F.col("text"))).alias("words"))


@query(rf"""WITH c AS (SELECT clip_id, text, duration, len(regexp_extract_all(lower(text), '[\p{{L}}\p{{M}}\p{{N}}]+(?:[''’-][\p{{L}}\p{{M}}\p{{N}}]+)*')) AS w FROM clips WHERE text IS NOT NULL AND {DUR_OK})
SELECT clip_id, round((CASE WHEN regexp_matches(text, '[฀-๿က-႟]') OR w = 0 THEN length(regexp_replace(text, '\s', '', 'g')) ELSE w END) / duration, 4) AS rate FROM c""")
def speech_rate(s, d):
    return ok_clips(s, d).where("text is not null").select("clip_id", F.round(X.speaking_rate(F.col("text"), F.col("duration")), 4).alias("rate"))


@query("SELECT clip_id, upper(substr(control_en, 1, 1)) || lower(substr(control_en, 2)) AS control FROM clips WHERE control_en IS NOT NULL")
def sentence_case(s, d):
    return table(s, d, "clips").where("control_en is not null").select("clip_id", X.sentence_case(F.col("control_en")).alias("control"))


@query("SELECT clip_id, regexp_replace(text, '[^一-鿿]', '', 'g') AS han FROM clips WHERE regexp_matches(text, '[一-鿿]')")
def cjk_projection(s, d):
    return table(s, d, "clips").where(F.col("text").rlike("[一-鿿]")).select("clip_id", X.cjk_only(F.col("text")).alias("han"))


@query(rf"SELECT case_id, seed, report_id, coalesce(numeric, regexp_matches(text, '\p{{Nd}}|{X.THAI_NUMBERS}')) AS numeric_text FROM report_items")
def numeric_flag(s, d):
    return table(s, d, "report_items").select("case_id", "seed", "report_id", X.is_numeric_text(F.col("text"), F.col("numeric")).alias("numeric_text"))


@query("SELECT lang, count(*) AS clips FROM clips WHERE regexp_matches(text, 'Ã[\u0080-¿]|Â[\u0080-¿]|â(?:€|[\u0080-¿])|ðŸ|�') GROUP BY lang")
def mojibake_flag(s, d):
    return table(s, d, "clips").where(X.is_mojibake(F.col("text"))).groupBy("lang").agg(F.count("*").alias("clips"))


@query(r"""WITH t AS (SELECT clip_id, regexp_replace(text, '^\s*[(（][^()（）]*[)）]\s*', '') AS bare, text, control_en FROM clips WHERE text IS NOT NULL)
SELECT clip_id, bare, CASE WHEN trim(coalesce(control_en, '')) <> '' THEN '(' || control_en || ')' || bare ELSE bare END AS prefixed FROM t WHERE bare <> text OR control_en IS NOT NULL""")
def control_prefix(s, d):
    c = table(s, d, "clips").where("text is not null").select("clip_id", "text", "control_en", X.without_prefix(F.col("text")).alias("bare"))
    return c.where("bare <> text or control_en is not null").select("clip_id", "bare", X.with_prefix(F.col("control_en"), F.col("bare")).alias("prefixed"))


@query(r"""WITH r AS (SELECT lang, coalesce(lang = 'th', false) AS th, CASE WHEN lang = 'th' THEN length(regexp_replace(text, '\s', '', 'g')) ELSE len(regexp_extract_all(text, '\S+')) END AS n FROM report_items)
SELECT lang, CASE WHEN th THEN CASE WHEN n BETWEEN 2 AND 10 THEN 'short' WHEN n BETWEEN 18 AND 40 THEN 'medium' WHEN n BETWEEN 50 AND 90 THEN 'long' END
 ELSE CASE WHEN n BETWEEN 1 AND 4 THEN 'short' WHEN n BETWEEN 6 AND 12 THEN 'medium' WHEN n BETWEEN 16 AND 30 THEN 'long' END END AS bucket, count(*) AS items FROM r GROUP BY 1, 2""")
def length_buckets(s, d):
    return table(s, d, "report_items").select("lang", X.length_bucket(F.col("text"), F.col("lang")).alias("bucket")).groupBy("lang", "bucket").agg(F.count("*").alias("items"))


@query(f"SELECT case_id, seed, report_id, length({sql_norm('text')}) > 0 AND length({sql_norm('hyp')}) > 1.4 * length({sql_norm('text')}) AS long_hyp FROM report_items WHERE hyp IS NOT NULL AND text IS NOT NULL")
def over_read_flag(s, d):
    return table(s, d, "report_items").where("hyp is not null and text is not null").select("case_id", "seed", "report_id", X.over_read(F.col("hyp"), F.col("text")).alias("long_hyp"))


@query("SELECT clip_id, ('0x' || substr(sha256('order:' || clip_id), 1, 8))::BIGINT AS h FROM clips")
def stable_hash(s, d):
    return table(s, d, "clips").select("clip_id", X.hash_integer("order", F.col("clip_id")).alias("h"))


# --- rules ------------------------------------------------------------------

REASONS = f"""WITH r AS (SELECT *, list_sort(list_filter([
 CASE WHEN text IS NULL OR trim(text) = '' THEN 'text_missing' END, CASE WHEN contains(text, '�') THEN 'text_encoding' END,
 CASE WHEN duration IS NULL OR isnan(duration) OR duration <= 0 THEN 'duration_invalid' END,
 CASE WHEN NOT isnan(duration) AND duration > 0 AND (duration < 3 OR duration > 30) THEN 'duration_range' END,
 CASE WHEN NOT coalesce(speaker_verified, false) THEN 'identity_unverified' END, CASE WHEN split IS NULL THEN 'split_missing' END], lambda x: x IS NOT NULL)) AS reasons FROM clips)
"""


@query("SELECT id, label, quality FROM sources WHERE license IN ('CC0', 'CC-BY-3.0', 'CC-BY-4.0', 'Apache-2.0') AND quality >= 60 AND kind NOT IN ('local')")
def row_filter(s, d):
    return table(s, d, "sources").where(rules.row_filter([("license", "in", ["CC0", "CC-BY-3.0", "CC-BY-4.0", "Apache-2.0"]), ("quality", ">=", 60), ("kind", "not_in", ["local"])])).select("id", "label", "quality")


@query(REASONS + "SELECT clip_id, array_to_string(reasons, ',') AS reasons FROM r WHERE len(reasons) > 0")
def reasons_multi(s, d):
    c = table(s, d, "clips").select("clip_id", rules.reasons(rules.clip_rules()).alias("reasons"))
    return c.where(F.size("reasons") > 0).select("clip_id", F.array_join("reasons", ",").alias("reasons"))


@query("""SELECT reason, count(*) AS clips FROM (SELECT CASE WHEN text IS NULL OR trim(text) = '' THEN 'text_missing' WHEN contains(text, '�') THEN 'text_encoding'
 WHEN duration IS NULL OR isnan(duration) OR duration <= 0 THEN 'duration_invalid' WHEN duration < 3 OR duration > 30 THEN 'duration_range'
 WHEN NOT coalesce(speaker_verified, false) THEN 'identity_unverified' WHEN split IS NULL THEN 'split_missing' END AS reason FROM clips) GROUP BY reason""")
def reasons_first(s, d):
    return table(s, d, "clips").select(rules.first_reason(rules.clip_rules()).alias("reason")).groupBy("reason").agg(F.count("*").alias("clips"))


@query(REASONS + "SELECT reason, count(*) AS rows FROM (SELECT unnest(reasons) AS reason FROM r) GROUP BY reason")
def reject_histogram(s, d):
    return rules.reason_counts(table(s, d, "clips").select(rules.reasons(rules.clip_rules()).alias("reasons")))


@query(REASONS + f"""SELECT coalesce(s.lang, '?') AS lang, count(*) AS clips, round(sum(duration), 3) AS seconds FROM (
 SELECT source_id, audio, arg_min(duration, (ingested_at, clip_id)) AS duration FROM r WHERE NOT list_has_any(reasons, ['text_missing', 'text_encoding', 'duration_invalid', 'duration_range']) GROUP BY source_id, audio) k
 LEFT JOIN sources s ON s.id = k.source_id GROUP BY 1""")
def curation_summary(s, d):
    bad = F.array(*[F.lit(x) for x in ("text_missing", "text_encoding", "duration_invalid", "duration_range")])
    ok = table(s, d, "clips").where(~F.arrays_overlap(rules.reasons(rules.clip_rules()), bad))
    first = ok.groupBy("source_id", "audio").agg(F.min_by("duration", F.struct("ingested_at", "clip_id")).alias("duration"))
    langs = table(s, d, "sources").select(F.col("id").alias("source_id"), "lang")
    return first.join(langs, "source_id", "left").groupBy(F.coalesce("lang", F.lit("?")).alias("lang")).agg(F.count("*").alias("clips"), F.round(F.sum("duration"), 3).alias("seconds"))


# --- duplicates, leakage, identity --------------------------------------------


@query("SELECT arg_min(clip_id, (ingested_at, clip_id)) AS clip_id, audio FROM clips GROUP BY audio")
def exact_dup_keep_first(s, d):
    return dedupe.keep_first(table(s, d, "clips").select("audio", "ingested_at", "clip_id"), ["audio"], ["ingested_at", "clip_id"]).select("clip_id", "audio")


@query(r"""WITH n AS (SELECT doc_id, regexp_replace(lower(text), '[^\p{L}\p{N}\p{M}]', '', 'g') AS norm FROM documents WHERE text IS NOT NULL)
SELECT min(doc_id) AS first_doc, count(*) AS copies FROM n WHERE norm <> '' GROUP BY norm HAVING count(*) > 1""")
def exact_text_copies(s, d):
    n = table(s, d, "documents").select("doc_id", F.sha2(X.normal_text(F.col("text")), 256).alias("h"), F.length(X.normal_text(F.col("text"))).alias("n"))
    return n.where("n > 0").groupBy("h").agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("copies")).where("copies > 1").select("first_doc", "copies")


@query()
def near_text_leakage(s, d):
    c = table(s, d, "clips").where("split = 'train' and text is not null").select(F.col("clip_id").alias("id"), F.lower(F.trim("lang")).alias("lang"), X.normal_text(X.without_prefix(F.col("text"))).alias("norm"))
    h = table(s, d, "tl_short_holdout_20260918").where("text is not null").select(F.col("source_sentence_id").alias("item"), F.lower(F.trim("lang")).alias("lang"), X.normal_text(F.col("text")).alias("norm")).distinct()
    return dedupe.near_text(c, h)


MEMBERS = f"""m AS (SELECT clip_id AS id, split, 'audio' AS kind, audio AS key FROM clips UNION ALL SELECT clip_id, split, 'origin', coalesce(origin_audio, audio) FROM clips
 UNION ALL SELECT clip_id, split, 'speaker', {sql_key('speaker')} FROM clips WHERE speaker_verified
 UNION ALL SELECT clip_id, split, 'session', source_id || '|' || {sql_key('session')} FROM clips)"""


@query(f"WITH {MEMBERS} SELECT kind, count(*) AS keys FROM (SELECT kind, key FROM m WHERE key IS NOT NULL AND split IS NOT NULL GROUP BY kind, key HAVING bool_or(split = 'train') AND bool_or(split <> 'train')) GROUP BY kind")
def split_leak_check(s, d):
    return identity.split_leaks(table(s, d, "clips"))


@query(f"""WITH {MEMBERS}, p AS (SELECT DISTINCT kind, key FROM m WHERE split IN ('val', 'test') AND key IS NOT NULL)
SELECT DISTINCT id AS clip_id FROM m SEMI JOIN p USING (kind, key) WHERE split = 'train'""")
def memberships_leak(s, d):
    c = table(s, d, "clips")
    m = identity.memberships(c).join(c.select(F.col("clip_id").alias("id"), "split"), "id")
    held = m.where("split in ('val', 'test')").select("kind", "key").distinct()
    return m.where("split = 'train'").join(held, ["kind", "key"], "left_semi").select(F.col("id").alias("clip_id")).distinct()


@query(f"""WITH {MEMBERS}, bad AS (SELECT clip_id FROM clips WHERE contains(text, '�')), k AS (SELECT DISTINCT kind, key FROM m WHERE kind IN ('audio', 'origin') AND id IN (SELECT clip_id FROM bad))
SELECT id, array_to_string(list_sort(list(DISTINCT kind)), ',') AS through FROM m JOIN k USING (kind, key) GROUP BY id""")
def suspicion_propagation(s, d):
    c = table(s, d, "clips")
    return identity.propagate(c, c.where(F.col("text").contains("�")).select(F.col("clip_id").alias("id"))).select("id", F.array_join("through", ",").alias("through"))


COMPONENTS = f"""WITH RECURSIVE m AS (SELECT clip_id AS id, 'o' || coalesce(origin_audio, audio) AS key FROM clips UNION ALL SELECT clip_id, 's' || {sql_key('speaker')} FROM clips WHERE speaker_verified
 UNION ALL SELECT clip_id, 'e' || source_id || '|' || {sql_key('session')} FROM clips), f AS (SELECT id, min(id) OVER (PARTITION BY key) AS first FROM m WHERE key IS NOT NULL),
e AS (SELECT DISTINCT id AS a, first AS b FROM f WHERE id <> first UNION SELECT first, id FROM f WHERE id <> first),
cc(id, root) USING KEY (id) AS (SELECT clip_id, clip_id FROM clips UNION SELECT e.b, min(cc.root) FROM cc JOIN e ON e.a = cc.id JOIN recurring.cc AS old ON old.id = e.b WHERE cc.root < old.root GROUP BY e.b)"""


@query(COMPONENTS + " SELECT root, count(*) AS clips FROM cc GROUP BY root")
def identity_components(s, d):
    return identity.components(table(s, d, "clips")).groupBy(F.col("group_id").alias("root")).agg(F.count("*").alias("clips"))


@query(COMPONENTS + """, r AS (SELECT c.clip_id, root, coalesce(lang, '') AS lang, coalesce(reference_only, false) AS ref FROM clips c JOIN cc ON cc.id = c.clip_id),
l AS (SELECT root, lang, count(*) AS k FROM r WHERE NOT ref GROUP BY ALL), g AS (SELECT root, lang, sum(k) OVER (PARTITION BY root) AS n FROM l QUALIFY row_number() OVER (PARTITION BY root ORDER BY k DESC, lang) = 1),
q AS (SELECT lang, least(200, greatest(1, least(16, floor(count(*) / 5)), round(count(*) * 0.02))) AS quota FROM r WHERE NOT ref GROUP BY lang),
o AS (SELECT root, quota, coalesce(sum(n) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, lead(root) OVER w AS after FROM g LEFT JOIN q USING (lang) WINDOW w AS (PARTITION BY lang ORDER BY sha256('split:' || root), root))
SELECT clip_id, r.root AS group_id, lang, CASE WHEN before < quota AND after IS NOT NULL THEN 'val' ELSE 'train' END AS split FROM r LEFT JOIN o USING (root)""")
def split_records(s, d):
    return identity.split_records(table(s, d, "clips"))


@query(f"""WITH k AS (SELECT clip_id, {sql_key('speaker')} AS who, lang, coalesce(origin_audio, audio) AS origin, duration FROM clips WHERE speaker_verified AND lang IS NOT NULL),
b AS (SELECT * FROM k WHERE who IS NOT NULL), o AS (SELECT who, lang, origin, min((sha256('ref:' || clip_id), clip_id)) AS o FROM b WHERE duration BETWEEN 3 AND 10 AND NOT isnan(duration) GROUP BY ALL),
n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY who, lang ORDER BY o) AS n FROM o) WHERE n <= 2),
c AS (SELECT b.clip_id, min((CASE WHEN n.lang = b.lang THEN 2 WHEN n.lang IN ('zh', 'en') THEN 0 ELSE 1 END, n.o, n.lang)) AS c FROM b JOIN n ON n.who = b.who AND n.origin <> b.origin GROUP BY b.clip_id)
SELECT clip_id, c[2][2] AS ref_id, c[3] AS ref_lang, c[1] AS tier FROM c""")
def reference_pairing(s, d):
    return identity.reference_pairs(table(s, d, "clips"))


GROUPS = "g AS (SELECT source_id AS group_id, coalesce(s.lang, '?') AS lang, count(*) AS n, source_id = 'lantern_en' AS pinned FROM clips c LEFT JOIN sources s ON s.id = c.source_id GROUP BY ALL)"


@query(f"""WITH {GROUPS}, t AS (SELECT *, sum(n) OVER (PARTITION BY lang) AS total, coalesce(sum(CASE WHEN pinned THEN n END) OVER (PARTITION BY lang), 0) AS held FROM g),
q AS (SELECT *, least(200, greatest(1, least(16, floor(total / 5)), round(total * 0.02))) AS quota, sha256('split:' || group_id) AS h FROM t),
f AS (SELECT *, coalesce(sum(n) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, lead(group_id) OVER w AS after FROM q WHERE NOT pinned WINDOW w AS (PARTITION BY lang ORDER BY h, group_id))
SELECT group_id, CASE WHEN held + before < quota AND after IS NOT NULL THEN 'val' ELSE 'train' END AS split FROM f UNION ALL SELECT group_id, 'val' FROM q WHERE pinned""")
def group_split(s, d):
    langs = table(s, d, "sources").select(F.col("id").alias("source_id"), "lang")
    g = table(s, d, "clips").select("source_id").join(langs, "source_id", "left").groupBy(F.col("source_id").alias("group_id"), F.coalesce("lang", F.lit("?")).alias("lang")).agg(F.count("*").alias("n"))
    return identity.quota_split(g.withColumn("pinned", F.col("group_id") == "lantern_en"))


# --- sampling and mixing -------------------------------------------------------


@query(f"""WITH b AS (SELECT clip_id, source_id, duration, coalesce(sum(duration) OVER (PARTITION BY source_id ORDER BY sha256('budget:' || clip_id), clip_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
 FROM clips WHERE {DUR_OK}) SELECT clip_id, source_id FROM b WHERE before < 300""")
def budget_window(s, d):
    return sampling.within_budget(ok_clips(s, d), ["source_id"], F.col("duration"), F.lit(300.0), "clip_id").select("clip_id", "source_id")


@query("SELECT origin_audio, count(*) AS uses FROM clips GROUP BY origin_audio HAVING count(*) > 3")
def exposure_over_cap(s, d):
    return table(s, d, "clips").groupBy("origin_audio").agg(F.count("*").alias("uses")).where("uses > 3")


@query(f"""WITH u AS (SELECT source_id AS id, sum(duration) AS sec FROM clips WHERE {DUR_OK} GROUP BY 1), p AS (SELECT m.mix_name, s.lang, m.weight / sum(m.weight) OVER (PARTITION BY mix_name) AS share, sec FROM mix_plan m LEFT JOIN u USING (id) LEFT JOIN sources s ON s.id = m.id)
SELECT mix_name, coalesce(lang, '?') AS lang, round(sum(share), 6) AS requested, round(sum(sec) / sum(sum(sec)) OVER (PARTITION BY mix_name), 6) AS available FROM p GROUP BY 1, 2""")
def language_shares(s, d):
    u = ok_clips(s, d).groupBy(F.col("source_id").alias("id")).agg(F.sum("duration").alias("sec"))
    p = table(s, d, "mix_plan").join(u, "id", "left").join(table(s, d, "sources").select("id", "lang"), "id", "left")
    p = p.withColumn("share", F.col("weight") / F.sum("weight").over(W.partitionBy("mix_name")))
    g = p.groupBy("mix_name", F.coalesce("lang", F.lit("?")).alias("lang")).agg(F.round(F.sum("share"), 6).alias("requested"), F.sum("sec").alias("sec"))
    return g.select("mix_name", "lang", "requested", F.round(F.col("sec") / F.sum("sec").over(W.partitionBy("mix_name")), 6).alias("available"))


@query("SELECT clip_id, source_id, row_number() OVER (PARTITION BY source_id ORDER BY sha256('turn:' || clip_id), clip_id) AS turn FROM clips")
def interleave(s, d):
    return sampling.interleave(table(s, d, "clips").select("clip_id", "source_id"), "source_id", "clip_id")


@query("SELECT case_id, (row_number() OVER (ORDER BY case_id) - 1) % 4 AS shard FROM tl_short_holdout_20260918")
def residue_shard(s, d):
    return sampling.shard(table(s, d, "tl_short_holdout_20260918").select("case_id"), ["case_id"], 4)


@query("SELECT report_id, case_id, seed, cer FROM (SELECT *, row_number() OVER (PARTITION BY report_id, lang ORDER BY cer DESC, case_id, seed, scored_at, hyp) AS n FROM report_items WHERE cer IS NOT NULL AND NOT isnan(cer)) WHERE n <= 5")
def top_k_risk(s, d):
    r = table(s, d, "report_items").where("cer is not null and not isnan(cer)")
    return sampling.top_k(r, ["report_id", "lang"], [F.desc("cer"), F.col("case_id"), F.col("seed"), F.col("scored_at"), F.asc_nulls_last("hyp")], 5).select("report_id", "case_id", "seed", "cer")


@query(f"""WITH c AS (SELECT clip_id, greatest(duration - 3.0, 0.0) AS room FROM clips WHERE {DUR_OK}), w AS (SELECT clip_id, room, unnest([round(i * 1.5, 6) for i in range(0, floor(room / 1.5)::BIGINT + 1)]) AS start FROM c)
SELECT clip_id, start FROM w UNION ALL SELECT clip_id, round(room, 6) FROM c WHERE round(floor(room / 1.5) * 1.5, 6) < round(room, 6)""")
def fixed_windows(s, d):
    return ok_clips(s, d).select("clip_id", F.explode(sampling.fixed_windows(F.col("duration"), 3.0, 1.5)).alias("start"))


@query("SELECT lang, source_sentence_id FROM (SELECT DISTINCT lang, source_sentence_id FROM tl_short_holdout_20260918) QUALIFY row_number() OVER (PARTITION BY lang ORDER BY sha256('pick:' || source_sentence_id), source_sentence_id) <= 20")
def stratified_pick(s, d):
    h = table(s, d, "tl_short_holdout_20260918").select("lang", "source_sentence_id").distinct()
    return sampling.top_k(h, ["lang"], [X.hash_order("pick", F.col("source_sentence_id")), F.col("source_sentence_id")], 20)


# --- summaries -------------------------------------------------------------------


@query(f"""SELECT split, count(*) AS clips, round(sum(duration), 3) AS seconds, count(DISTINCT CASE WHEN speaker_verified THEN {sql_key('speaker')} END) AS speakers,
 count(DISTINCT origin_audio) AS origins, count(control_en) AS controlled FROM clips WHERE {DUR_OK} GROUP BY split""")
def dataset_summary(s, d):
    return ok_clips(s, d).groupBy("split").agg(
        F.count("*").alias("clips"), F.round(F.sum("duration"), 3).alias("seconds"), F.countDistinct(F.when(F.col("speaker_verified"), identity_key(F.col("speaker")))).alias("speakers"),
        F.countDistinct("origin_audio").alias("origins"), F.count("control_en").alias("controlled"),
    )


@query(f"""SELECT source_id, round(median(duration), 6) AS median, round(sum(CASE WHEN duration < 8 THEN duration ELSE 0 END) / sum(duration), 6) AS short_share,
 count(*) FILTER (duration >= 3 AND duration < 8) AS d3_8, count(*) FILTER (duration >= 8 AND duration < 15) AS d8_15, count(*) FILTER (duration >= 15 AND duration <= 30) AS d15_30 FROM clips WHERE {DUR_OK} GROUP BY source_id""")
def coverage(s, d):
    x = F.col("duration")
    return ok_clips(s, d).groupBy("source_id").agg(
        F.round(F.median(x), 6).alias("median"), F.round(F.sum(F.when(x < 8, x).otherwise(0)) / F.sum(x), 6).alias("short_share"),
        F.count_if((x >= 3) & (x < 8)).alias("d3_8"), F.count_if((x >= 8) & (x < 15)).alias("d8_15"), F.count_if((x >= 15) & (x <= 30)).alias("d15_30"),
    )


@query(f"""WITH a AS (SELECT source_id, count(*) AS n, sum(duration) AS h FROM clips WHERE split = 'train' AND {DUR_OK} GROUP BY 1), b AS (SELECT source_id, count(*) AS n, sum(duration) AS h FROM clips WHERE split = 'test' AND {DUR_OK} GROUP BY 1)
SELECT coalesce(a.source_id, b.source_id) AS source_id, coalesce(b.n, 0) - coalesce(a.n, 0) AS rows_delta, round(coalesce(b.h, 0) - coalesce(a.h, 0), 3) AS seconds_delta FROM a FULL JOIN b ON a.source_id = b.source_id""")
def composition_diff(s, d):
    side = lambda split, p: ok_clips(s, d).where(F.col("split") == split).groupBy("source_id").agg(F.count("*").alias(f"n{p}"), F.sum("duration").alias(f"h{p}"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return side("train", "a").join(side("test", "b"), "source_id", "full_outer").select("source_id", (zero("nb") - zero("na")).alias("rows_delta"), F.round(zero("hb") - zero("ha"), 3).alias("seconds_delta"))


@query(f"""SELECT source_id, round(quantile_cont(duration, 0.01), 6) AS p1, round(quantile_cont(duration, 0.5), 6) AS p50, round(quantile_cont(duration, 0.9), 6) AS p90, round(quantile_cont(duration, 0.99), 6) AS p99,
 list_sort(list(duration))[least(count(*), floor(0.9 * count(*)) + 1)::BIGINT] AS p90_rank FROM clips WHERE {DUR_OK} GROUP BY source_id""")
def percentile_pack(s, d):
    q = ok_clips(s, d).groupBy("source_id").agg(F.percentile("duration", F.array(*[F.lit(x) for x in (0.01, 0.5, 0.9, 0.99)])).alias("q"), reports.nearest_rank(F.collect_list("duration"), 0.9).alias("p90_rank"))
    return q.select("source_id", *[F.round(F.col("q")[i], 6).alias(n) for i, n in enumerate(("p1", "p50", "p90", "p99"))], "p90_rank")


# --- reports ----------------------------------------------------------------------

NN = lambda c: f"CASE WHEN NOT isnan({c}) THEN {c} END"
UNIQ = "u AS (SELECT * FROM report_items QUALIFY row_number() OVER (PARTITION BY report_id, case_id, seed ORDER BY scored_at DESC, coalesce(hyp, '') DESC, audio_sec DESC, cer DESC) = 1)"


@query(f"""SELECT report_id, lang, count(*) AS items, round(avg({NN('cer')}), 4) AS cer, round(avg(CASE WHEN NOT coalesce(numeric, false) THEN {NN('cer')} END), 4) AS cer_plain, round(avg({NN('wer')}), 4) AS wer,
 round(avg(over_read::INT), 4) AS over_read_rate, round(avg(suspected_truncation::INT), 4) AS truncation_rate,
 list_sort(list({NN('len_ratio')}) FILTER (len_ratio IS NOT NULL AND NOT isnan(len_ratio)))[least(count({NN('len_ratio')}), floor(0.9 * count({NN('len_ratio')})) + 1)::BIGINT] AS len_ratio_p90 FROM report_items GROUP BY report_id, lang""")
def report_agg(s, d):
    return reports.report_aggregate(table(s, d, "report_items"), ["report_id", "lang"])


@query(f"SELECT report_id, lang, count(*) AS items, round(avg(c), 6) AS cer FROM (SELECT report_id, coalesce(lang, '?') AS lang, {NN('cer')} AS c FROM report_items) GROUP BY GROUPING SETS ((report_id), (report_id, lang))")
def by_lang_grouping_sets(s, d):
    return reports.by_language(table(s, d, "report_items"))


@query(f"""WITH p AS (SELECT report_id, case_id, stddev_samp({NN('cer')}) AS s, max({NN('cer')}) - min({NN('cer')}) AS r FROM report_items GROUP BY 1, 2 HAVING count(*) > 1)
SELECT report_id, count(*) AS cases, round(avg(s), 6) AS mean_std, round(avg(r), 6) AS mean_range FROM p GROUP BY 1""")
def seed_stability(s, d):
    return reports.seed_stability(table(s, d, "report_items"))


@query("SELECT report_id, case_id, seed, count(*) AS copies, count(DISTINCT ref_audio) AS refs FROM report_items GROUP BY 1, 2, 3 HAVING count(*) > 1")
def duplicate_items(s, d):
    return table(s, d, "report_items").groupBy("report_id", "case_id", "seed").agg(F.count("*").alias("copies"), F.countDistinct("ref_audio").alias("refs")).where("copies > 1")


@query("""WITH e AS (SELECT * FROM (SELECT DISTINCT report_id FROM report_items), (SELECT DISTINCT case_id FROM report_items), (SELECT DISTINCT seed FROM report_items))
SELECT report_id, count(*) AS missing FROM e ANTI JOIN report_items r USING (report_id, case_id, seed) GROUP BY 1""")
def missing_items(s, d):
    r = table(s, d, "report_items")
    have = r.select("report_id", "case_id", "seed").distinct()
    # the cases and seeds of a report set are few and fixed by its plan
    full = have.select("report_id").distinct().crossJoin(have.select("case_id").distinct()).crossJoin(have.select("seed").distinct())
    return full.join(have, ["report_id", "case_id", "seed"], "left_anti").groupBy("report_id").agg(F.count("*").alias("missing"))


def _two(s, d) -> tuple[DataFrame, DataFrame]:
    """Items of the second and the first seed of the first report, as candidate and base."""
    r = table(s, d, "report_items")
    first = r.agg(F.min("report_id").alias("report_id"))
    r = r.join(F.broadcast(first), "report_id")  # one row
    ids = r.select("seed").distinct().withColumn("n", F.row_number().over(W.orderBy("seed")))
    u = reports.unique_items(r.select("report_id", "case_id", "seed", "lang", "text", "hyp", "cer", "audio_sec", "scored_at")).join(ids, "seed").withColumn("seed", F.lit(0))
    return u.where("n = 2"), u.where("n = 1")


PAIRS = f"""WITH {UNIQ}, i AS (SELECT seed, row_number() OVER (ORDER BY seed) AS n FROM (SELECT DISTINCT seed FROM report_items WHERE report_id = (SELECT min(report_id) FROM report_items))),
 b AS (SELECT u.*, i.n FROM u JOIN i USING (seed) WHERE report_id = (SELECT min(report_id) FROM report_items)), p AS (SELECT x.case_id, 0 AS seed, x.lang, round(x.cer - y.cer, 12) AS delta FROM b x JOIN b y ON x.case_id = y.case_id AND x.n = 2 AND y.n = 1
 WHERE x.cer IS NOT NULL AND y.cer IS NOT NULL AND NOT isnan(x.cer) AND NOT isnan(y.cer) AND x.text IS NOT DISTINCT FROM y.text)
"""


@query(PAIRS + "SELECT case_id, seed, lang, round(delta, 6) AS delta FROM p")
def paired_delta(s, d):
    a, b = _two(s, d)
    return reports.paired(a, b, "cer").select("case_id", "seed", "lang", F.round("delta", 6).alias("delta"))


@query(PAIRS + ", c AS (SELECT lang, case_id, avg(delta) AS d FROM p GROUP BY 1, 2) SELECT lang, count(*) AS cases, round(avg(d), 6) AS mean_delta, count(*) FILTER (round(d, 12) < 0) AS better, count(*) FILTER (round(d, 12) > 0) AS worse FROM c GROUP BY 1")
def case_equal_mean(s, d):
    a, b = _two(s, d)
    return reports.case_equal_mean(reports.paired(a, b, "cer"), ["lang"])


@query(PAIRS + "SELECT lang, count(*) FILTER (delta > 0.05) AS redline, count(*) FILTER (delta > 0 AND delta <= 0.05) AS noise FROM p GROUP BY 1")
def gates_redline(s, d):
    a, b = _two(s, d)
    p = reports.paired(a, b, "cer")
    return p.groupBy("lang").agg(F.count_if(F.col("delta") > 0.05).alias("redline"), F.count_if((F.col("delta") > 0) & (F.col("delta") <= 0.05)).alias("noise"))


@query(PAIRS + """, c AS (SELECT lang, case_id, avg(delta) AS d FROM p GROUP BY 1, 2), v AS (SELECT lang, list(d ORDER BY case_id) AS v FROM c GROUP BY 1),
m AS (SELECT lang, len(v) AS n, list_sum([v[('0x' || substr(sha256('7:' || b || ':' || i), 1, 8))::BIGINT % len(v) + 1] for i in range(0, len(v))]) / len(v) AS m FROM v, range(0, 200) AS r(b))
SELECT lang, max(n) AS cases, round(quantile_cont(m, 0.025), 6) AS low, round(quantile_cont(m, 0.975), 6) AS high FROM m GROUP BY 1""")
def bootstrap_ci(s, d):
    a, b = _two(s, d)
    per = reports.paired(a, b, "cer").groupBy("lang", "case_id").agg(F.avg("delta").alias("d"))
    return reports.hash_bootstrap(per, "lang", "d")


ALL_PAIRS = f"""WITH {UNIQ}, p AS (SELECT x.report_id, x.case_id, x.seed, x.lang, round(x.cer - y.cer, 12) AS delta FROM u x JOIN u y ON x.case_id = y.case_id AND x.seed = y.seed
 WHERE y.report_id = (SELECT min(report_id) FROM report_items) AND x.report_id > y.report_id AND x.cer IS NOT NULL AND y.cer IS NOT NULL AND NOT isnan(x.cer) AND NOT isnan(y.cer) AND x.text IS NOT DISTINCT FROM y.text)
"""


@query(ALL_PAIRS + "SELECT report_id, case_id, seed, lang, round(delta, 6) AS delta FROM p")
def paired_delta_reports(s, d):
    return reports.paired_reports(table(s, d, "report_items"), "cer").select("report_id", "case_id", "seed", "lang", F.round("delta", 6).alias("delta"))


@query(ALL_PAIRS + ", c AS (SELECT report_id, lang, case_id, avg(delta) AS d FROM p GROUP BY 1, 2, 3) SELECT report_id, lang, count(*) AS cases, round(avg(d), 6) AS mean_delta, count(*) FILTER (round(d, 12) < 0) AS better, count(*) FILTER (round(d, 12) > 0) AS worse FROM c GROUP BY 1, 2")
def case_equal_mean_reports(s, d):
    return reports.case_equal_mean(reports.paired_reports(table(s, d, "report_items"), "cer"), ["report_id", "lang"])


@query(ALL_PAIRS + "SELECT report_id, lang, count(*) FILTER (delta > 0.05) AS redline, count(*) FILTER (delta > 0 AND delta <= 0.05) AS noise FROM p GROUP BY 1, 2")
def gates_redline_reports(s, d):
    p = reports.paired_reports(table(s, d, "report_items"), "cer")
    return p.groupBy("report_id", "lang").agg(F.count_if(F.col("delta") > 0.05).alias("redline"), F.count_if((F.col("delta") > 0) & (F.col("delta") <= 0.05)).alias("noise"))


@query(ALL_PAIRS + """, c AS (SELECT report_id, lang, case_id, avg(delta) AS d FROM p GROUP BY 1, 2, 3), v AS (SELECT report_id, lang, list(d ORDER BY case_id) AS v FROM c GROUP BY 1, 2),
m AS (SELECT report_id, lang, len(v) AS n, list_sum([v[('0x' || substr(sha256('7:' || b || ':' || i), 1, 8))::BIGINT % len(v) + 1] for i in range(0, len(v))]) / len(v) AS m FROM v, range(0, 200) AS r(b))
SELECT report_id, lang, max(n) AS cases, round(quantile_cont(m, 0.025), 6) AS low, round(quantile_cont(m, 0.975), 6) AS high FROM m GROUP BY 1, 2""")
def bootstrap_ci_reports(s, d):
    per = reports.paired_reports(table(s, d, "report_items"), "cer").groupBy("report_id", "lang", "case_id").agg(F.avg("delta").alias("d"))
    return reports.hash_bootstrap(per, ["report_id", "lang"], "d")


@query(f"""WITH k AS (SELECT report_id, case_id, min((coalesce(length({sql_norm('hyp')}), 0) = 0, coalesce(over_read, false), coalesce({NN('cer')}, 1e9), seed)) AS k FROM report_items GROUP BY 1, 2)
SELECT report_id, case_id, k[4] AS seed, CASE WHEN k[3] < 1e9 THEN round(k[3], 6) END AS cer FROM k""")
def keep_best(s, d):
    return reports.keep_best(table(s, d, "report_items"))


@query("""WITH m AS (SELECT case_id, median(audio_sec) AS med FROM report_items WHERE audio_sec IS NOT NULL AND NOT isnan(audio_sec) GROUP BY 1)
SELECT report_id, count(*) FILTER (audio_sec > 2.5 * med) AS runaway, count(*) FILTER (audio_sec > 1.8 * med AND audio_sec <= 2.5 * med) AS slow FROM report_items JOIN m USING (case_id) WHERE audio_sec IS NOT NULL AND NOT isnan(audio_sec) GROUP BY 1""")
def runaway_flags(s, d):
    r = table(s, d, "report_items").where("audio_sec is not null and not isnan(audio_sec)")
    m = r.groupBy("case_id").agg(F.median("audio_sec").alias("med"))
    x = r.join(m, "case_id")
    return x.groupBy("report_id").agg(F.count_if(F.col("audio_sec") > 2.5 * F.col("med")).alias("runaway"), F.count_if((F.col("audio_sec") > 1.8 * F.col("med")) & (F.col("audio_sec") <= 2.5 * F.col("med"))).alias("slow"))


# --- vectors, events, star schema -----------------------------------------------


@query("""WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS n FROM embeddings)
SELECT a.label, a.vec_id, b.vec_id AS next_id, round(list_cosine_similarity(a.v, b.v), 5) AS cosine FROM e a JOIN e b ON a.label = b.label AND b.n = a.n + 1""")
def cosine_pairs(s, d):
    e = table(s, d, "embeddings").withColumn("n", F.row_number().over(W.partitionBy("label").orderBy("vec_id")))
    b = e.select("label", (F.col("n") - 1).alias("n"), F.col("vec_id").alias("next_id"), F.col("embedding").alias("w"))
    return e.join(b, ["label", "n"]).select("label", "vec_id", "next_id", F.round(X.cosine(F.col("embedding"), F.col("w")), 5).alias("cosine"))


@query("SELECT time_bucket(INTERVAL '1 hour', ts) AS start, event_type, count(*) AS events, round(sum(value), 4) AS value FROM events GROUP BY 1, 2")
def tumbling_events(s, d):
    return metrics.tumbling(table(s, d, "events")).withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w > INTERVAL '30 minutes' OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
x AS (SELECT user_id, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM g) SELECT user_id, max(sid) AS sessions, count(*) AS events FROM x GROUP BY 1""")
def sessionize(s, d):
    w = W.partitionBy("user_id").orderBy("ts", "event_id")
    gap = (F.col("ts") - F.lag("ts").over(w)) > F.expr("interval 30 minutes")
    e = table(s, d, "events").withColumn("new", F.when(gap | F.lag("ts").over(w).isNull(), 1).otherwise(0))
    return e.groupBy("user_id").agg(F.sum("new").alias("sessions"), F.count("*").alias("events"))


@query("""SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, round(avg(l_discount), 6) AS avg_disc, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2""")
def pricing_summary(s, d):
    r = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return table(s, d, "lineitem").where("l_shipdate <= timestamp_ntz '1998-09-02 00:00:00'").groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), F.round(F.sum(r), 2).alias("revenue"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count("*").alias("n"))


@query("SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def nation_revenue(s, d):
    li = table(s, d, "lineitem").select("l_orderkey", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("r"))
    per = li.groupBy("l_orderkey").agg(F.sum("r").alias("r"))  # reduced before the joins
    o = table(s, d, "orders").select("o_orderkey", "o_custkey")
    c = table(s, d, "customer").select("c_custkey", "c_nationkey").join(table(s, d, "nation").select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
    return per.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey")).groupBy("n_name").agg(F.round(F.sum("r"), 2).alias("revenue"))


@query()
def word_errors(s, d):
    r = table(s, d, "report_items").where("hyp is not null and text is not null")
    words = F.when(F.col("lang").isin(*X.WORD_LANGUAGES), sequential.word_error_rate(X.normal_text(F.col("hyp"), True), X.normal_text(F.col("text"), True)))
    return r.select("report_id", "case_id", "seed", F.round(words, 6).alias("word_errors"), F.round(sequential.sequence_ratio("hyp", "text"), 6).alias("similarity"))


@query()
def truncation_flag(s, d):
    r = table(s, d, "report_items").where("hyp is not null and text is not null")
    return r.select("report_id", "case_id", "seed", sequential.is_truncated(X.normal_text(F.col("hyp")), X.normal_text(F.col("text"))).alias("truncated"))


@query()
def char_errors(s, d):  # the SQL distance counts bytes, so there is no twin
    r = table(s, d, "report_items").where("hyp is not null and text is not null")
    return r.select("report_id", "case_id", "seed", F.round(X.character_error_rate(X.normal_text(F.col("hyp")), X.normal_text(F.col("text"))), 6).alias("char_errors"))


@query()
def char_errors_all(s, d):
    r = table(s, d, "report_items").where("hyp is not null and text is not null")
    return r.select("report_id", "case_id", "seed", F.round(X.character_error_rate(F.col("hyp"), F.col("text")), 6).alias("char_errors"))


@query()
def speaker_clusters(s, d):
    return sequential.leader_clusters(table(s, d, "embeddings"), "label", "vec_id", "embedding")


@query()
def replay_budget(s, d):
    c = ok_clips(s, d).select("source_id", "clip_id", "duration")
    return sequential.trim_to_budget(c, "source_id", "clip_id", "duration", 600.0)


@query("SELECT list_sort(list(DISTINCT source_id))[1] AS first_source, l.lang, count(*) AS clips FROM clips c JOIN (SELECT id, coalesce(lang, '?') AS lang FROM sources) l ON l.id = c.source_id GROUP BY l.lang")
def source_by_language(s, d):
    langs = table(s, d, "sources").select(F.col("id").alias("source_id"), F.coalesce("lang", F.lit("?")).alias("lang"))
    return table(s, d, "clips").select("source_id").join(langs, "source_id").groupBy("lang").agg(F.min("source_id").alias("first_source"), F.count("*").alias("clips"))


@query("SELECT o_orderpriority, count(*) AS orders FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R') GROUP BY 1")
def returned_orders(s, d):
    back = table(s, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(s, d, "orders").join(back, "o_orderkey", "left_semi").groupBy("o_orderpriority").agg(F.count("*").alias("orders"))


@query("SELECT r_name, c_mktsegment, count(*) AS customers, round(avg(c_acctbal), 4) AS balance FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, c_mktsegment)")
def segment_rollup(s, d):
    n = table(s, d, "nation").join(table(s, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    c = table(s, d, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return c.rollup("r_name", "c_mktsegment").agg(F.count("*").alias("customers"), F.round(F.avg("c_acctbal"), 4).alias("balance"))


@query("SELECT id, lang, quality, row_number() OVER (ORDER BY lang NULLS FIRST, quality DESC, id) AS position, row_number() OVER (PARTITION BY lang, expressive ORDER BY quality DESC, id) = 1 AS preferred FROM sources")
def source_catalog(s, d):
    src = table(s, d, "sources")  # the registry is small and fixed
    return src.select(
        "id", "lang", "quality", F.row_number().over(W.orderBy(F.asc_nulls_first("lang"), F.desc("quality"), "id")).alias("position"),
        (F.row_number().over(W.partitionBy("lang", "expressive").orderBy(F.desc("quality"), "id")) == 1).alias("preferred"),
    )


@query("SELECT report_id, case_id, seed FROM report_items ORDER BY CASE WHEN regexp_full_match(case_id, '[0-9]+') THEN 0 ELSE 1 END, TRY_CAST(case_id AS BIGINT) NULLS LAST, case_id, seed, report_id, scored_at, hyp NULLS LAST")
def case_order(s, d):
    r = table(s, d, "report_items").withColumn("digits", F.col("case_id").rlike("^[0-9]+$"))
    return r.orderBy(F.desc("digits"), F.asc_nulls_last(F.col("case_id").try_cast("bigint")), "case_id", "seed", "report_id", "scored_at", F.asc_nulls_last("hyp")).select("report_id", "case_id", "seed")


@query("""SELECT report_id, case_id, seed, row_number() OVER (ORDER BY CASE WHEN regexp_full_match(case_id, '[0-9]+') THEN 0 ELSE 1 END, TRY_CAST(CASE WHEN regexp_full_match(case_id, '[0-9]+') THEN case_id END AS BIGINT) NULLS LAST,
 case_id NULLS FIRST, seed NULLS FIRST, report_id NULLS FIRST, scored_at NULLS FIRST, hyp NULLS LAST) AS position FROM report_items""")
def case_positions(s, d):
    digits = F.coalesce(F.col("case_id").rlike(r"^[0-9]+\z"), F.lit(False))
    number = F.when(digits, F.col("case_id").try_cast("bigint"))
    order = [digits.desc(), number.asc_nulls_last(), F.asc("case_id"), F.asc("seed"), F.asc("report_id"), F.asc("scored_at"), F.asc_nulls_last("hyp")]
    r = table(s, d, "report_items").select("report_id", "case_id", "seed", "scored_at", "hyp")
    return selection.ordered_positions(r, order).select("report_id", "case_id", "seed", "position")


@query("""WITH a AS (SELECT DISTINCT case_id FROM report_items WHERE seed = (SELECT min(seed) FROM report_items)), b AS (SELECT DISTINCT case_id FROM report_items WHERE seed = (SELECT max(seed) FROM report_items))
SELECT 'both' AS part, count(*) AS cases FROM (SELECT * FROM a INTERSECT SELECT * FROM b) UNION ALL SELECT 'first_only', count(*) FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT 'last_only', count(*) FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def case_sets(s, d):
    r = table(s, d, "report_items")
    ends = F.broadcast(r.agg(F.min("seed").alias("lo"), F.max("seed").alias("hi")))  # one row
    per = r.join(ends).groupBy("case_id").agg(F.max(F.col("seed") == F.col("lo")).alias("a"), F.max(F.col("seed") == F.col("hi")).alias("b"))
    parts = {"both": F.col("a") & F.col("b"), "first_only": F.col("a") & ~F.col("b"), "last_only": ~F.col("a") & F.col("b")}
    counts = per.agg(*[F.count_if(p).alias(n) for n, p in parts.items()])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(n).alias("part"), F.col(n).alias("cases")) for n in parts])).alias("x")).select("x.part", "x.cases")


@query("""SELECT turn_type, split, count(*) AS clips, round(avg(rate), 4) AS rate FROM clips WHERE rate IS NOT NULL AND NOT isnan(rate) GROUP BY CUBE (turn_type, split)""")
def turn_cube(s, d):
    return table(s, d, "clips").where("rate is not null and not isnan(rate)").cube("turn_type", "split").agg(F.count("*").alias("clips"), F.round(F.avg("rate"), 4).alias("rate"))


@query("""SELECT time_bucket(INTERVAL '1 hour', ts) + (h.h * INTERVAL '-1 hour') AS start, event_type, count(*) AS events FROM events, (VALUES (0), (1)) h(h) GROUP BY 1, 2""")
def sliding_events(s, d):
    return metrics.sliding(table(s, d, "events")).withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("SELECT event_id, user_id, value, (props->>'k')::INT AS k FROM events WHERE (props->>'k')::INT > 50 AND value > 0")
def json_props(s, d):
    return table(s, d, "events").where("value > 0").select("event_id", "user_id", "value", F.get_json_object("props", "$.k").try_cast("int").alias("k")).where("k > 50")


@query("""WITH c AS (SELECT clip_id, recorded_at, ingested_at, source_id FROM clips) SELECT source_id, count(*) FILTER (ingested_at - recorded_at > INTERVAL '7 days') AS late, max(ingested_at) AS last FROM c GROUP BY 1""")
def late_arrivals(s, d):
    late = (F.col("ingested_at") - F.col("recorded_at")) > F.expr("interval 7 days")
    return table(s, d, "clips").groupBy("source_id").agg(F.count_if(late).alias("late"), F.max("ingested_at").alias("last"))
