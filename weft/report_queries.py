"""Further queries of the core: screening, gates and summaries, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weft.functions import text as X
from weft.operators import gates, reports, sampling, screening
from weft.queries import DUR_OK, NN, UNIQ, ok_clips, query, sql_norm
from weft.session import table

U = f"WITH {UNIQ}"


def unique(s, d):
    return reports.unique_items(table(s, d, "report_items"))


# --- screening ----------------------------------------------------------------


@query(r"""WITH c AS (SELECT *, regexp_replace(CASE WHEN control_en <> '' AND starts_with(text, '(' || control_en || ')') THEN substr(text, length(control_en) + 3) ELSE text END, '^\s+|\s+$', '', 'g') AS bare FROM clips
 WHERE lang IN ('en', 'id', 'tl') AND NOT coalesce(reference_only, false) AND text IS NOT NULL AND duration >= 5 AND NOT isnan(duration) AND NOT isinf(duration)),
w AS (SELECT *, len(regexp_extract_all(bare, '[\p{L}\p{N}]+(?:[''’-][\p{L}\p{N}]+)*')) AS words FROM c WHERE NOT regexp_matches(bare, '[฀-๿က-႟㐀-鿿]'))
SELECT clip_id, words, round(words / duration, 3) AS rate, sha256('[' || to_json(coalesce(origin_audio, audio, '')) || ', ' || to_json(bare) || ', ' || to_json(lang) || ', ' || round(duration, 3) || ']') AS review_key FROM w WHERE words > 0 AND words / duration <= 0.8""")
def slow_speech_review(s, d):
    f = screening.slow_speech(F.col("text"), F.coalesce("control_en", F.lit("")), F.col("lang"), F.col("duration"), F.col("reference_only"), F.coalesce("origin_audio", "audio"))
    return table(s, d, "clips").where("text is not null").select("clip_id", f.alias("x")).where("x is not null").select("clip_id", "x.*")


@query(rf"""WITH i AS (SELECT CASE WHEN regexp_matches(text, '[ÃÂÅÄ�]') THEN 'encoding_suspect' WHEN regexp_matches(text, '[()（）\[\]{{}}]') THEN 'body_control_like_punctuation' WHEN regexp_matches(text, '\p{{C}}') THEN 'control_or_unassigned_unicode'
 WHEN regexp_matches(text, '\p{{Nd}}|{X.THAI_NUMBERS}') THEN 'numeric' WHEN length(text) NOT BETWEEN 10 AND 300 THEN 'length' ELSE 'none' END AS issue, lang FROM clips WHERE text IS NOT NULL)
SELECT lang, issue, count(*) AS clips FROM i GROUP BY 1, 2""")
def intake_issues(s, d):
    c = table(s, d, "clips").where("text is not null").select("lang", F.coalesce(screening.intake_issue(F.col("text")), F.lit("none")).alias("issue"))
    return c.groupBy("lang", "issue").agg(F.count("*").alias("clips"))


@query(rf"""WITH r AS (SELECT *, regexp_extract_all(hyp, '\S+') AS w, regexp_extract_all(regexp_replace(nfc_normalize(lower(hyp)), '[^\p{{L}}\p{{N}}\p{{M}}\s]', '', 'g'), '\S+') AS m FROM report_items WHERE hyp IS NOT NULL)
SELECT report_id, count(*) AS items, count(*) FILTER (NOT same AND audio_sec > 0 AND chars / audio_sec > 40) AS fast, count(*) FILTER (NOT same AND lang IN ('en', 'id', 'tl') AND len(w) >= 8 AND len(m) > 0 AND len(list_distinct(m)) / len(m) <= 0.4) AS repeated
FROM (SELECT *, coalesce({sql_norm('hyp')} = {sql_norm('text')}, false) AS same, length(array_to_string(w, '')) AS chars FROM r) GROUP BY 1""")
def transcript_patterns(s, d):
    p = screening.transcript_patterns(F.col("hyp"), F.col("text"), F.col("lang"), F.col("audio_sec"))
    r = table(s, d, "report_items").where("hyp is not null").select("report_id", p.alias("p"))
    return r.groupBy("report_id").agg(F.count("*").alias("items"), F.count_if(F.array_contains("p", "asr_character_rate_gt_40")).alias("fast"), F.count_if(F.array_contains("p", "asr_repetition_low_diversity")).alias("repeated"))


@query(f"""SELECT lang, CASE WHEN duration < 2 THEN 28 WHEN duration < 5 THEN 24 ELSE 22 END AS steps, count(*) AS clips, round(sum(((1280 - (round(duration * 16000)::BIGINT % 1280)) % 1280) / 16000), 4) AS padding FROM clips WHERE {DUR_OK} GROUP BY 1, 2""")
def inference_plan(s, d):
    samples = F.round(F.col("duration") * 16000).cast("bigint")
    return ok_clips(s, d).groupBy("lang", screening.inference_steps(F.col("duration")).alias("steps")).agg(F.count("*").alias("clips"), F.round(F.sum(F.coalesce(screening.padding_seconds(samples, 1280, 16000), F.lit(0.0))), 4).alias("padding"))


# --- clips ----------------------------------------------------------------------


@query("""SELECT lang, count(*) FILTER (speaker_verified) AS verified_speaker_rows, count(*) FILTER (control_en <> '' AND emotion_verified) AS verified_control_rows, count(*) FILTER (reference_only) AS reference_rows, count(*) AS rows FROM clips GROUP BY lang""")
def coverage_counters(s, d):
    yes = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    return table(s, d, "clips").groupBy("lang").agg(yes(F.col("speaker_verified")).alias("verified_speaker_rows"), yes((F.col("control_en") != "") & F.col("emotion_verified")).alias("verified_control_rows"), yes(F.col("reference_only")).alias("reference_rows"), F.count("*").alias("rows"))


@query(f"""SELECT CASE WHEN grouping(lang) = 1 THEN 'overall' ELSE lang END AS scope, count(*) AS rows, round(sum(duration) / 3600, 6) AS hours, round(median(duration), 6) AS p50, round(avg((reference_only IS TRUE)::INT), 6) AS reference_rate, round(avg((duration BETWEEN 3 AND 8)::INT), 6) AS mid_share
FROM (SELECT coalesce(lang, 'unknown') AS lang, duration, reference_only FROM clips WHERE {DUR_OK}) GROUP BY GROUPING SETS ((), (lang))""")
def data_metrics(s, d):
    c = ok_clips(s, d).select(F.coalesce("lang", F.lit("unknown")).alias("lang"), "duration", F.coalesce("reference_only", F.lit(False)).alias("ref"))
    g = c.groupingSets([[], ["lang"]], "lang").agg(F.grouping("lang").alias("g"), F.count("*").alias("rows"), F.round(F.sum("duration") / 3600, 6).alias("hours"), F.round(F.median("duration"), 6).alias("p50"), F.round(F.avg(F.col("ref").cast("int")), 6).alias("reference_rate"), F.round(F.avg(F.col("duration").between(3, 8).cast("int")), 6).alias("mid_share"))
    return g.select(F.when(F.col("g") == 1, "overall").otherwise(F.col("lang")).alias("scope"), "rows", "hours", "p50", "reference_rate", "mid_share")


@query(f"""WITH a AS (SELECT lang, audio, min(clip_id) AS clip_id, arg_min(duration, clip_id) AS duration FROM clips WHERE lang IS NOT NULL AND audio IS NOT NULL AND {DUR_OK} GROUP BY 1, 2)
SELECT lang, clip_id, duration FROM a QUALIFY row_number() OVER (PARTITION BY lang ORDER BY abs(duration - 5), clip_id) <= 3""")
def closest_references(s, d):
    a = ok_clips(s, d).where("lang is not null and audio is not null").groupBy("lang", "audio").agg(F.min(F.struct("clip_id", "duration")).alias("x")).select("lang", "x.*")
    return sampling.top_k(a, ["lang"], [F.abs(F.col("duration") - 5), F.col("clip_id")], 3).select("lang", "clip_id", "duration")


@query(rf"""WITH b AS (SELECT lang, CASE WHEN duration <= 5 THEN '3-5' WHEN duration <= 8 THEN '5-8' ELSE '8-30' END AS band, clip_id FROM clips WHERE text IS NOT NULL AND lang IS NOT NULL AND NOT regexp_matches(text, '\p{{Nd}}|{X.THAI_NUMBERS}') AND duration BETWEEN 3 AND 30)
SELECT lang, band, clip_id FROM b QUALIFY row_number() OVER (PARTITION BY lang, band ORDER BY sha256('band:' || clip_id), clip_id) <= 5""")
def band_picks(s, d):
    c = ok_clips(s, d).where("text is not null and lang is not null and duration between 3 and 30").where(~X.is_numeric_text(F.col("text")))
    b = c.select("lang", F.when(F.col("duration") <= 5, "3-5").when(F.col("duration") <= 8, "5-8").otherwise("8-30").alias("band"), "clip_id")
    return sampling.top_k(b, ["lang", "band"], [X.hash_order("band", F.col("clip_id")), F.col("clip_id")], 5)


@query(f"""WITH t AS (SELECT lang, sum(duration) AS sec FROM clips WHERE split = 'train' AND lang IS NOT NULL AND {DUR_OK} GROUP BY 1), k AS (SELECT count(*) AS n, sum(sec) AS total, min(sec) AS least FROM t)
SELECT lang, round(sec, 3) AS seconds, round(least(total, 2 * least * n) / n, 3) AS budget FROM t, k""")
def balanced_budget(s, d):
    t = ok_clips(s, d).where("split = 'train' and lang is not null").groupBy("lang").agg(F.sum("duration").alias("sec"))
    k = F.broadcast(t.agg(F.count("*").alias("n"), F.sum("sec").alias("total"), F.min("sec").alias("least")))  # one row
    return t.join(k).select("lang", F.round("sec", 3).alias("seconds"), F.round(F.least(F.col("total"), 2 * F.col("least") * F.col("n")) / F.col("n"), 3).alias("budget"))


# --- reports ----------------------------------------------------------------------

SEVERE = f"(coalesce({NN('cer')} > 0.2, false) OR coalesce(over_read, false) OR coalesce(length({sql_norm('hyp')}), 0) = 0)"


@query(f"{U}, f AS (SELECT *, {SEVERE} AS severe FROM u) SELECT report_id, lang, count(*) AS items, count(*) FILTER (severe) AS severe FROM f GROUP BY 1, 2")
def severe_items(s, d):
    u = unique(s, d)
    return u.groupBy("report_id", "lang").agg(F.count("*").alias("items"), F.count_if(gates.severe(u)).alias("severe"))


@query(f"""{U}, f AS (SELECT *, {SEVERE} AS severe, coalesce({NN('cer')}, 0) AS c0 FROM u),
g AS (SELECT x.report_id, y.lang, count(*) AS n, count(*) FILTER (x.severe AND NOT y.severe) AS new, count(*) FILTER (y.severe AND NOT x.severe) AS mended, avg(x.c0) - avg(y.c0) AS d FROM f x JOIN f y ON x.case_id = y.case_id AND x.seed = y.seed
 WHERE y.report_id = (SELECT min(report_id) FROM report_items) AND x.report_id > y.report_id GROUP BY 1, 2),
p AS (SELECT *, CASE WHEN new + mended = 0 THEN 1.0 ELSE list_sum([exp(lgamma(new + mended + 1) - lgamma(i + 1) - lgamma(new + mended - i + 1) - (new + mended) * ln(2)) for i in range(new, new + mended + 1)]) END AS pw,
 CASE WHEN new + mended = 0 THEN 1.0 ELSE list_sum([exp(lgamma(new + mended + 1) - lgamma(i + 1) - lgamma(new + mended - i + 1) - (new + mended) * ln(2)) for i in range(mended, new + mended + 1)]) END AS pb FROM g)
SELECT report_id, lang, n, new, mended, round(pw, 4) AS p_worse, round(pb, 4) AS p_better, pw < 0.1 OR round(d, 12) > 0.01 AS worse, pb < 0.05 AS better FROM p""")
def severe_compare(s, d):
    return gates.severe_compare(unique(s, d))


@query(f"""{U}, m AS (SELECT report_id, CASE WHEN grouping(lang) = 1 THEN 'overall' ELSE lang END AS scope, avg({NN('audio_sec')}) AS sec, avg({NN('cer')}) AS cer FROM u WHERE NOT coalesce(numeric, false) GROUP BY GROUPING SETS ((report_id), (report_id, lang))),
b AS (SELECT * FROM m WHERE report_id = (SELECT min(report_id) FROM u) AND scope IS NOT NULL)
SELECT m.report_id, scope, round(round(m.sec / nullif(b.sec, 0) - 1, 12), 6) AS growth, coalesce(round(m.sec / nullif(b.sec, 0) - 1, 12) > 0.10 AND abs(round(m.cer - b.cer, 12)) <= 0.01, false) AS inflated FROM m JOIN b USING (scope) WHERE m.report_id > b.report_id""")
def duration_gates(s, d):
    return gates.duration_gates(unique(s, d))


@query(f"""{U} SELECT report_id, lang, seed, count(*) AS items, count(*) FILTER (over_read) AS over_read, count(*) FILTER (over_read AND coalesce({NN('len_ratio')}, 0) < 2) AS moderate, count(*) FILTER ({NN('len_ratio')} >= 2) AS catastrophic, max(coalesce({NN('len_ratio')}, 0)) AS worst FROM u GROUP BY 1, 2, 3""")
def seed_severity(s, d):
    ratio = F.coalesce(reports.metric("len_ratio"), F.lit(0.0))
    over = F.coalesce("over_read", F.lit(False))
    return unique(s, d).groupBy("report_id", "lang", "seed").agg(F.count("*").alias("items"), F.count_if(over).alias("over_read"), F.count_if(over & (ratio < 2)).alias("moderate"), F.count_if(ratio >= 2).alias("catastrophic"), F.max(ratio).alias("worst"))


@query(f"""{U}, n AS (SELECT *, row_number() OVER (PARTITION BY report_id, case_id ORDER BY seed) - 1 AS k FROM u),
p AS (SELECT a.report_id, CASE WHEN b.cer < a.cer THEN b.len_ratio ELSE a.len_ratio END AS picked, (a.len_ratio + b.len_ratio) / 2 AS single FROM n a JOIN n b ON a.report_id = b.report_id AND a.case_id = b.case_id AND b.k = a.k + 1 AND a.k % 2 = 0
 WHERE a.cer IS NOT NULL AND b.cer IS NOT NULL AND a.len_ratio IS NOT NULL AND b.len_ratio IS NOT NULL AND NOT isnan(a.cer) AND NOT isnan(b.cer) AND NOT isnan(a.len_ratio) AND NOT isnan(b.len_ratio))
SELECT report_id, count(*) AS pairs, round(avg(picked), 4) AS picked, round(avg(single), 4) AS single FROM p GROUP BY 1""")
def best_of_two(s, d):
    w = W.partitionBy("report_id", "case_id").orderBy("seed")  # a case's seeds are few
    u = unique(s, d).select("report_id", "case_id", "seed", reports.metric("cer").alias("c"), reports.metric("len_ratio").alias("r"))
    n = u.withColumn("k", F.row_number().over(w) - 1).withColumn("c2", F.lead("c").over(w)).withColumn("r2", F.lead("r").over(w))
    p = n.where("k % 2 = 0 and c is not null and c2 is not null and r is not null and r2 is not null")
    picked = F.when(F.col("c2") < F.col("c"), F.col("r2")).otherwise(F.col("r"))
    return p.groupBy("report_id").agg(F.count("*").alias("pairs"), F.round(F.avg(picked), 4).alias("picked"), F.round(F.avg((F.col("r") + F.col("r2")) / 2), 4).alias("single"))


@query(f"""{U}, p AS (SELECT x.report_id, y.lang, x.case_id, coalesce(y.control, '') <> '' AS led, {NN('x.cer')} - {NN('y.cer')} AS delta FROM u x JOIN u y ON x.case_id = y.case_id AND x.seed = y.seed WHERE y.report_id = (SELECT min(report_id) FROM u) AND x.report_id > y.report_id),
c AS (SELECT report_id, lang, led, case_id, avg(delta) AS m FROM p WHERE delta IS NOT NULL GROUP BY 1, 2, 3, 4)
SELECT report_id, lang, count(*) FILTER (led) AS led_cases, count(*) FILTER (NOT led) AS plain_cases, round(avg(m) FILTER (led) - avg(m) FILTER (NOT led), 6) AS interaction FROM c GROUP BY 1, 2""")
def control_interaction(s, d):
    x = gates.against_first(unique(s, d).withColumn("cer", reports.metric("cer")), ["lang", "control", "cer"])
    p = x.select("report_id", F.col("b.lang").alias("lang"), "case_id", (F.coalesce("b.control", F.lit("")) != "").alias("led"), (F.col("c.cer") - F.col("b.cer")).alias("delta")).where("delta is not null")
    c = p.groupBy("report_id", "lang", "led", "case_id").agg(F.avg("delta").alias("m"))
    led = F.avg(F.when(F.col("led"), F.col("m"))) - F.avg(F.when(~F.col("led"), F.col("m")))
    return c.groupBy("report_id", "lang").agg(F.count_if("led").alias("led_cases"), F.count_if(~F.col("led")).alias("plain_cases"), F.round(led, 6).alias("interaction"))


@query(f"""{U} SELECT case_id, seed, count(*) AS reports, count(*) = (SELECT count(DISTINCT report_id) FROM report_items) AS complete, count(DISTINCT hyp) AS transcripts, round(min({NN('cer')}), 6) AS lowest, round(max({NN('cer')}) - min({NN('cer')}), 6) AS spread FROM u GROUP BY 1, 2""")
def repeatability(s, d):
    r = table(s, d, "report_items")
    all_ = F.broadcast(r.agg(F.count_distinct("report_id").alias("_all")))  # one row
    cer = reports.metric("cer")
    g = unique(s, d).groupBy("case_id", "seed").agg(F.count("*").alias("reports"), F.count_distinct("hyp").alias("transcripts"), F.round(F.min(cer), 6).alias("lowest"), F.round(F.max(cer) - F.min(cer), 6).alias("spread"))
    return g.join(all_).select("case_id", "seed", "reports", (F.col("reports") == F.col("_all")).alias("complete"), "transcripts", "lowest", "spread")


@query(f"""{U} SELECT lang, coalesce(nullif(trim(control), ''), 'unknown') AS control, count(*) AS items, count({NN('cer')}) AS known, count(*) FILTER ({NN('cer')} > 0.2) AS tail FROM u GROUP BY 1, 2""")
def tail_by_control(s, d):
    cer = reports.metric("cer")
    return unique(s, d).groupBy("lang", F.coalesce(F.nullif(F.trim("control"), F.lit("")), F.lit("unknown")).alias("control")).agg(F.count("*").alias("items"), F.count(cer).alias("known"), F.count_if(cer > 0.2).alias("tail"))


@query(f"""{U}, f AS (SELECT case_id, lang, report_id, seed FROM u WHERE {SEVERE}) SELECT case_id, lang, count(DISTINCT report_id) AS reports, count(*) AS failures, array_to_string(list_sort(list(DISTINCT seed)), ',') AS seeds FROM f GROUP BY 1, 2""")
def failure_cases(s, d):
    u = unique(s, d)
    f = u.where(gates.severe(u))  # a case's seeds are few
    return f.groupBy("case_id", "lang").agg(F.count_distinct("report_id").alias("reports"), F.count("*").alias("failures"), F.concat_ws(",", F.transform(F.array_sort(F.collect_set("seed")), lambda x: x.cast("string"))).alias("seeds"))
