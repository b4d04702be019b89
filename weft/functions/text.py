"""Scalar text functions as Column builders."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weft.functions.keys import strip_blanks

#: Thai number words that make a text numeric without digits (fixed values).
THAI_NUMBERS = "ศูนย์|หนึ่ง|สอง|สาม|สี่|ห้า|หก|เจ็ด|แปด|เก้า|สิบ|ยี่สิบ|ร้อย|พัน|หมื่น|แสน|ล้าน|บาท|เปอร์เซนต์"
#: Traces of UTF-8 read as Latin-1 (a fixed pattern).
MOJIBAKE = "Ã[\u0080-¿]|Â[\u0080-¿]|â(?:€|[\u0080-¿])|ðŸ|�"
#: Bounds of the length buckets, in words and in Thai characters; between two buckets is none (fixed values).
BUCKETS = {"short": (1, 4), "medium": (6, 12), "long": (16, 30)}
THAI_BUCKETS = {"short": (2, 10), "medium": (18, 40), "long": (50, 90)}
#: Languages whose words stand between blanks, so that word errors mean something (fixed values).
WORD_LANGUAGES = ("en", "id", "tl", "vi")
UNSPACED = "[฀-๿က-႟]"


@F.pandas_udf(T.StringType())
def _composed(c: pd.Series) -> pd.Series:
    return c.map(lambda t: unicodedata.normalize("NFC", t.replace("Σ", "σ").lower()), na_action="ignore")


def lower_composed(c: Column) -> Column:
    """Lower case (a final sigma as any other) in normal form C; only texts beyond ASCII leave the JVM."""
    plain = c.rlike(r"^[\x00-\x7F]*$")
    return F.when(plain, F.lower(c)).otherwise(_composed(F.when(~plain, c)))


def normal_text(c: Column, keep_blanks: bool = False) -> Column:
    """Lower case in normal form C, letters, marks and numbers only; optionally with blanks."""
    return F.regexp_replace(lower_composed(c), r"[^\p{L}\p{N}\p{M}\s]" if keep_blanks else r"[^\p{L}\p{N}\p{M}]", "")


def tokens(c: Column) -> Column:
    """Words with inner apostrophes and hyphens."""
    return F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}\p{M}\p{N}]+(?:['’-][\p{L}\p{M}\p{N}]+)*"), F.lit(0))


def speaking_rate(text: Column, seconds: Column) -> Column:
    """Words a second; characters a second where words are not spaced or missing."""
    words = F.size(tokens(text))
    units = F.when(text.rlike(UNSPACED) | (words == 0), F.length(F.regexp_replace(text, r"\s", ""))).otherwise(words)
    return F.when((seconds > 0) & ~F.isnan(seconds), units / seconds)


def sentence_case(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(c.substr(F.lit(2), F.length(c))))


def cjk_only(c: Column) -> Column:
    return F.regexp_replace(c, "[^一-鿿]", "")


def without_prefix(c: Column) -> Column:
    """Without a leading control prefix in round brackets."""
    return F.regexp_replace(c, r"^\s*[(（][^()（）]*[)）]\s*", "")


def with_prefix(control: Column, c: Column) -> Column:
    return F.when(F.trim(F.coalesce(control, F.lit(""))) != "", F.concat(F.lit("("), control, F.lit(")"), c)).otherwise(c)


def is_numeric_text(c: Column, override: Column | None = None) -> Column:
    found = c.rlike(r"\p{Nd}|" + THAI_NUMBERS)
    return F.coalesce(override, found) if override is not None else found


def is_mojibake(c: Column) -> Column:
    return c.rlike(MOJIBAKE)


def length_bucket(text: Column, lang: Column) -> Column:
    """Short, medium or long by words between blanks, in Thai by characters that are no blanks; null in the gaps."""
    thai = F.coalesce(lang == "th", F.lit(False))
    bare = strip_blanks(text)
    n = F.when(thai, F.length(F.regexp_replace(text, r"(?U)\s", ""))).when(bare == "", 0).otherwise(F.size(F.split(bare, r"(?U)\s+")))
    out = F.lit(None).cast("string")
    for name in BUCKETS:
        (lo, hi), (tlo, thi) = BUCKETS[name], THAI_BUCKETS[name]
        out = F.when(F.when(thai, n.between(tlo, thi)).otherwise(n.between(lo, hi)), name).otherwise(out)
    return out


def character_error_rate(hyp: Column, ref: Column) -> Column:
    """Edits a character of the reference between texts as they are; normalise both first to compare what was said."""
    return F.levenshtein(hyp, ref) / F.greatest(F.length(ref), F.lit(1))


def over_read(hyp: Column, ref: Column) -> Column:
    """Whether the hypothesis has over 1.4 times the letters of a reference that has some."""
    h, r = F.length(normal_text(hyp)), F.length(normal_text(ref))
    return (r > 0) & (h > F.lit(1.4) * r)


def hash_order(*parts: Column | str) -> Column:
    """A reproducible order without random numbers: hex SHA-256 of the joined parts."""
    cols = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    return F.sha2(F.concat_ws(":", *cols), 256)


def hash_integer(*parts: Column | str) -> Column:
    """The first eight hex digits of ``hash_order`` as BIGINT."""
    return F.conv(F.substring(hash_order(*parts), 1, 8), 16, 10).cast("bigint")


def safe_id(c: Column) -> Column:
    return F.substring(F.regexp_replace(c, r"[^A-Za-z0-9_-]+", "_"), 1, 80)


def source_alias(c: Column) -> Column:
    return F.regexp_replace(c, r"(_r2[23]boost)+$", "")


def cosine(a: Column, b: Column) -> Column:
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return dot / F.nullif(norm(a) * norm(b), F.lit(0.0))
