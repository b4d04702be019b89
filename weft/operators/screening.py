"""Row filters for clips, texts and transcripts: each a Column that names what is wrong, or null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weft.functions.keys import strip_blanks
from weft.functions.text import is_numeric_text, normal_text

#: Languages whose speaking rate is judged by words (fixed values).
SPACED = ("en", "id", "tl")
#: Letters of scripts without blanks between words (fixed values).
UNSPACED_SCRIPT = "[฀-๿က-႟㐀-鿿]"
WORD = r"[\p{L}\p{N}]+(?:['’-][\p{L}\p{N}]+)*"


def json_text(c: Column) -> Column:
    """A string as JSON, letters as they are."""
    for old, new in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        c = F.replace(c, F.lit(old), F.lit(new))
    return F.concat(F.lit('"'), c, F.lit('"'))


def slow_speech(text: Column, control: Column, lang: Column, seconds: Column, reference_only: Column, source: Column) -> Column:
    """Words, words a second and review key of a text too short for its sound; null where there is nothing to review.

    At least 5 s at no more than 0.8 words a second, in languages with blanks
    between words, without a leading ``(control)``. References, other scripts and
    unusable durations are never reviewed.
    """
    prefix = F.concat(F.lit("("), control, F.lit(")"))
    bare = strip_blanks(F.when((control != "") & F.startswith(text, prefix), F.substr(text, F.length(prefix) + 1)).otherwise(text))
    words = F.size(F.regexp_extract_all(bare, F.lit(WORD), F.lit(0)))
    usable = lang.isin(*SPACED) & ~F.coalesce(reference_only, F.lit(False)) & ~bare.rlike(UNSPACED_SCRIPT) & ~F.isnan(seconds) & (seconds < float("inf"))
    key = F.sha2(F.concat(F.lit("["), F.concat_ws(", ", json_text(F.coalesce(source, F.lit(""))), json_text(bare), json_text(lang), F.round(seconds, 3).cast("string")), F.lit("]")), 256)
    found = F.struct(words.alias("words"), F.round(words / seconds, 3).alias("rate"), key.alias("review_key"))
    return F.when(usable & (words > 0) & (seconds >= 5) & (words / seconds <= 0.8), found)


def intake_issue(text: Column, numeric: Column | None = None) -> Column:
    """The first reason not to take a text in: encoding, brackets, controls, numbers, length of 10 to 300."""
    return (
        F.when(text.rlike("[ÃÂÅÄ�]"), "encoding_suspect")
        .when(text.rlike(r"[()（）\[\]{}]"), "body_control_like_punctuation")
        .when(text.rlike(r"\p{C}"), "control_or_unassigned_unicode")
        .when(is_numeric_text(text, numeric), "numeric")
        .when(~F.length(text).between(10, 300), "length")
    )


def transcript_patterns(hyp: Column, ref: Column, lang: Column, seconds: Column) -> Column:
    """Signs of a made-up transcript: over 40 characters a second; at least eight words of which at most 0.4 are distinct.

    None where transcript and reference agree once normalised.
    """
    words = F.filter(F.split(strip_blanks(hyp), r"(?U)\s+"), lambda w: w != "")
    norm = F.filter(F.split(strip_blanks(normal_text(hyp, True)), r"(?U)\s+"), lambda w: w != "")
    letters = F.aggregate(words, F.lit(0), lambda n, w: n + F.length(w))
    fast = F.when((seconds > 0) & (letters / seconds > 40), "asr_character_rate_gt_40")
    again = F.when(lang.isin(*SPACED) & (F.size(words) >= 8) & (F.size(norm) > 0) & (F.size(F.array_distinct(norm)) / F.size(norm) <= 0.4), "asr_repetition_low_diversity")
    return F.when(F.coalesce(normal_text(hyp) == normal_text(ref), F.lit(False)), F.array().cast("array<string>")).otherwise(F.array_compact(F.array(fast, again)))


def transcript_rejection(segments: Column, text: Column, detected: Column, accepted: list[str], least_logprob: float | None = None, most_silence: float | None = None) -> Column:
    """Why a transcript is refused, or an empty string.

    ``segments`` are ``struct<start,end,avg_logprob,no_speech_prob>``, weighed by their seconds.
    """
    base = F.get(F.split(F.coalesce(detected, F.lit("")), "-"), F.lit(0))
    wrong = (F.coalesce(text, F.lit("")) == "") | ((F.coalesce(detected, F.lit("")) != "") & ~base.isin(*accepted))
    weight = lambda s: F.greatest(s["end"] - s["start"], F.lit(0.0))
    total = F.aggregate(segments, F.lit(0.0), lambda a, s: a + weight(s))

    def mean(field: str) -> Column:
        return F.aggregate(segments, F.lit(0.0), lambda a, s: a + weight(s) * s[field]) / F.nullif(total, F.lit(0.0))

    out = F.when(wrong, F.concat(F.lit("empty_text_or_language:"), F.coalesce(detected, F.lit(""))))
    if least_logprob is not None:
        out = out.when(mean("avg_logprob") < least_logprob, F.concat(F.lit("unintelligible:logprob="), F.format_string("%.2f", mean("avg_logprob"))))
    if most_silence is not None:
        out = out.when(mean("no_speech_prob") > most_silence, F.concat(F.lit("unintelligible:no_speech="), F.format_string("%.2f", mean("no_speech_prob"))))
    return out.otherwise("")


def label_reasons(text: Column, spoken: Column, written: Column, high_quality: Column) -> Column:
    """Why an external label does not confirm a text: not of high quality, or neither form equal once normalised."""
    same = lambda v: F.coalesce((normal_text(v) != "") & (normal_text(v) == normal_text(text)), F.lit(False))
    poor = F.when(~F.coalesce(high_quality, F.lit(False)), "granary_not_high_quality")
    other = F.when(~(same(spoken) | same(written)), "granary_transcript_disagreement")
    return F.array_compact(F.array(poor, other))


def inference_steps(seconds: Column) -> Column:
    """Steps by the length of the reference: under 2 s 28, under 5 s 24, else 22."""
    return F.when(seconds < 2, 28).when(seconds < 5, 24).otherwise(22)


def padding_seconds(samples: Column, patch: int, rate: int) -> Column:
    """Seconds from ``samples`` to the next multiple of ``patch``; null for no samples."""
    return F.when(samples > 0, F.pmod(-samples, F.lit(patch)) / rate)
