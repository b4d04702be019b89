"""The pN_ queries over the driver's tables, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.llm.capping import beyond_cap
from weft.llm.encoding import garbled_records, restore_text
from weft.llm.language import identify_languages, language_cases
from weft.llm.leakage import leaked_passages
from weft.llm.mixing import Mix
from weft.llm.overlap import CrossSplit
from weft.llm.packing import pack_documents
from weft.llm.quality import document_quality, junk_documents
from weft.llm.splits import related_groups, split_components, split_report
from weft.llm.tokens import encode_documents
from weft.session import table

HELD_OUT = "tl_short_holdout_20260918"


def p1_found(s: SparkSession, d: str) -> DataFrame:
    return language_cases(table(s, d, "clips"), table(s, d, "lang_reference"), table(s, d, "common_words"))


def p1_languages(s: SparkSession, d: str) -> DataFrame:
    found = identify_languages(table(s, d, "clips"), table(s, d, "lang_reference"), table(s, d, "common_words"))
    return found.select("clip_id", "label_lang", "lang", "confidence", F.size("stretches").alias("stretches"))


def p1_stretches(s: SparkSession, d: str) -> DataFrame:
    found = identify_languages(table(s, d, "clips").where("text is not null"), table(s, d, "lang_reference"), table(s, d, "common_words"))
    return found.where(F.size("stretches") > 1).select("clip_id", F.posexplode("stretches").alias("n", "x")).select("clip_id", "n", "x.lang", "x.confidence", "x.start", "x.end")


def p2_found(s: SparkSession, d: str) -> DataFrame:
    return garbled_records(table(s, d, "clips"), table(s, d, "lang_reference"))


def p2_restored(s: SparkSession, d: str) -> DataFrame:
    return restore_text(table(s, d, "clips"), table(s, d, "lang_reference")).where("garbled").select("clip_id", "text")


def p3_found(s: SparkSession, d: str) -> DataFrame:
    return related_groups(table(s, d, "clips"))


def p3_split(s: SparkSession, d: str) -> DataFrame:
    return split_components(table(s, d, "clips"), table(s, d, "sources"), table(s, d, "split_targets"))


def p3_shares(s: SparkSession, d: str) -> DataFrame:
    return split_report(p3_split(s, d), table(s, d, "split_targets"))


def p4_mix(s: SparkSession, d: str) -> DataFrame:
    return Mix(table(s, d, "clips"), table(s, d, "mix_plan")).records()


def p4_shares(s: SparkSession, d: str) -> DataFrame:
    return Mix(table(s, d, "clips"), table(s, d, "mix_plan")).report(table(s, d, "sources"))


def p4_found(s: SparkSession, d: str) -> DataFrame:
    return p4_shares(s, d).where("short").select("mix_name", "id")


def p5_found(s: SparkSession, d: str) -> DataFrame:
    return CrossSplit(table(s, d, "clips")).clip_pairs().select("clip_id_a", "clip_id_b")


def p5_report(s: SparkSession, d: str) -> DataFrame:
    return CrossSplit(table(s, d, "clips")).report()


def p6_found(s: SparkSession, d: str) -> DataFrame:
    return leaked_passages(table(s, d, "clips"), table(s, d, HELD_OUT), table(s, d, "lang_reference"))


def p6_report(s: SparkSession, d: str) -> DataFrame:
    return p6_found(s, d).groupBy("source_sentence_id").agg(F.count("*").alias("clips"), F.min("clip_id").alias("first_clip"))


def p7_found(s: SparkSession, d: str) -> DataFrame:
    return beyond_cap(table(s, d, "clips"))


def p7_kept(s: SparkSession, d: str) -> DataFrame:
    clips = table(s, d, "clips").select("clip_id", "speaker", "emotion", "dnsmos_overall")
    return clips.join(beyond_cap(clips), "clip_id", "left_anti")


def p8_ids(s: SparkSession, d: str) -> DataFrame:
    return encode_documents(table(s, d, "documents"))


def p9_pack(s: SparkSession, d: str) -> DataFrame:
    return pack_documents(table(s, d, "documents"), table(s, d, "pack_capacity")).items


def p9_report(s: SparkSession, d: str) -> DataFrame:
    caps = table(s, d, "pack_capacity")
    return pack_documents(table(s, d, "documents"), caps).report(caps)


def p10_found(s: SparkSession, d: str) -> DataFrame:
    return junk_documents(table(s, d, "documents"), table(s, d, "lang_reference"), table(s, d, "common_words"))


def p10_stats(s: SparkSession, d: str) -> DataFrame:
    return document_quality(table(s, d, "documents"), table(s, d, "lang_reference"), table(s, d, "common_words"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        p1_found, p1_languages, p1_stretches, p2_found, p2_restored, p3_found, p3_split, p3_shares, p4_found, p4_mix, p4_shares,
        p5_found, p5_report, p6_found, p6_report, p7_found, p7_kept, p8_ids, p9_pack, p9_report, p10_found, p10_stats,
    )
}

_MISSING = "('', 'unknown', 'none', 'nan', 'null')"


def _key(c: str) -> str:
    k = rf"lower(regexp_replace({c}, '^\s+|\s+$', '', 'g'))"
    return f"(CASE WHEN {k} IN {_MISSING} OR trim(regexp_replace({k}, '^[^:]*:', '')) IN {_MISSING} THEN NULL ELSE {k} END)"


_CAPPED = f"""
WITH k AS (
  SELECT clip_id, speaker, emotion, dnsmos_overall, {_key('speaker')} AS who, coalesce({_key('emotion')}, '') AS what FROM clips),
r AS (SELECT *, CASE WHEN who IS NULL THEN 1 ELSE row_number() OVER (PARTITION BY who, what
        ORDER BY CASE WHEN isnan(dnsmos_overall) THEN NULL ELSE dnsmos_overall END DESC NULLS LAST, clip_id) END AS n FROM k)
"""

_TIED = f"""
WITH RECURSIVE m AS (SELECT clip_id AS id, 's' || {_key('speaker')} AS key FROM clips WHERE speaker_verified UNION ALL SELECT clip_id, 'e' || source_id || '|' || {_key('session')} FROM clips),
f AS (SELECT id, min(id) OVER (PARTITION BY key) AS first FROM m WHERE key IS NOT NULL),
e AS (SELECT DISTINCT id AS a, first AS b FROM f WHERE id <> first UNION SELECT first, id FROM f WHERE id <> first),
cc(id, root) USING KEY (id) AS (SELECT clip_id, clip_id FROM clips UNION SELECT e.b, min(cc.root) FROM cc JOIN e ON e.a = cc.id JOIN recurring.cc AS old ON old.id = e.b WHERE cc.root < old.root GROUP BY e.b)
"""

ORACLES: dict[str, str] = {
    "p3_found": _TIED + "SELECT id AS clip_id, root AS group_id FROM cc QUALIFY count(*) OVER (PARTITION BY root) > 1",
    "p7_found": _CAPPED + "SELECT clip_id FROM r WHERE n > 20",
    "p7_kept": _CAPPED + "SELECT clip_id, speaker, emotion, dnsmos_overall FROM r WHERE n <= 20",
    "p4_found": """
WITH u AS (SELECT source_id AS id, coalesce(audio, '-' || clip_id) AS a, arg_min(duration, (ingested_at, clip_id)) AS s
           FROM clips WHERE split = 'train' AND duration > 0 AND NOT isnan(duration) AND source_id IS NOT NULL GROUP BY 1, 2),
t AS (SELECT id, sum(s) AS sec FROM u GROUP BY id),
p AS (SELECT m.mix_name, m.id, m.max_repeat, coalesce(t.sec, 0) AS sec, m.weight / sum(m.weight) OVER (PARTITION BY m.mix_name) AS share,
             coalesce(max(m.requested_train_hours) OVER (PARTITION BY m.mix_name) * 3600, sum(coalesce(t.sec, 0)) OVER (PARTITION BY m.mix_name)) AS budget
      FROM mix_plan m LEFT JOIN t ON t.id = m.id)
SELECT mix_name, id FROM p WHERE sec * max_repeat < share * budget""",
    "p6_found": r"""
WITH h AS (SELECT DISTINCT source_sentence_id AS sid, string_split(trim(regexp_replace(lower(nfc_normalize(text)), '[^\p{L}\p{M}\p{N}]+', ' ', 'g')), ' ') AS w
           FROM tl_short_holdout_20260918),
g AS (SELECT DISTINCT sid, ' ' || array_to_string(list_slice(w, i, i + 5), ' ') || ' ' AS p FROM (SELECT sid, w, unnest(range(1, len(w) - 4)) AS i FROM h)),
c AS (SELECT clip_id, ' ' || trim(regexp_replace(lower(nfc_normalize(text)), '[^\p{L}\p{M}\p{N}]+', ' ', 'g')) || ' ' AS t FROM clips WHERE split = 'train' AND text IS NOT NULL)
SELECT DISTINCT clip_id, sid AS source_sentence_id FROM c JOIN g ON contains(c.t, g.p)""",
}
