"""Finding and restoring text that was decoded with a wrong encoding."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Single-byte encodings that UTF-8 text is wrongly read with (fixed values).
WRONG_SINGLE = ("cp1252", "mac_roman", "cp437", "cp850", "cp1251", "cp1250", "koi8_r", "cp866", "cp874")
#: Multi-byte encodings that UTF-8 text is wrongly read with (fixed values).
WRONG_MULTI = ("gbk", "big5", "shift_jis", "euc_kr")
#: Legacy encodings whose bytes are wrongly read as Western text (fixed values).
LEGACY = ("cp874", "gb18030", "big5", "cp1258")
#: Characters that are right in text of any language, beside the letters that
#: the reference text of a language has: punctuation, symbols and accents
#: (fixed values).
COMMON = "…—–‘’“”«»‹›·•°±£€₱¥₫฿½¼¾×÷™®©§¶†‡ªº¿¡²³¹µ×ñÑéÉèêëçàâäáíïîóôöúüûœæßøåÅãõ、。，！？；：（）《》〈〉【】「」『』～％　"
STEP_BITS = 6
UNSEEN_BITS = 30
AGAIN_BITS = 10
MAX_STEPS = 3
MAX_REFERENCE = 20_000


def _reading(codec: str) -> dict[str, int]:
    """Byte of each character above ASCII that the codec may have made."""
    table: dict[str, int] = {}
    for b in range(0x80, 0x100):
        if b < 0xA0:
            table[chr(b)] = b  # bytes without a character stay as they are
        try:
            table[bytes([b]).decode(codec)] = b
        except UnicodeDecodeError:
            pass
    if codec == "cp1252":
        table.update({chr(b): b for b in range(0xA0, 0x100)})
    return table


def _chars(table: dict[str, int], lo: int, hi: int) -> str:
    return "[" + "".join(re.escape(c) for c, b in table.items() if lo <= b <= hi) + "]"


def _utf8_runs(table: dict[str, int]) -> str:
    tail = _chars(table, 0x80, 0xBF)
    if "เ" in table:  # right Thai text is full of single matches, but not of such pairs
        three = f"(?:{_chars(table, 0xE0, 0xE0)}{_chars(table, 0xB8, 0xB9)}{tail}|{_chars(table, 0xE1, 0xEF)}{tail}{{2}})"
        return f"(?:{three}){{2,}}|{_chars(table, 0xE2, 0xE2)}{_chars(table, 0x80, 0x9F)}{tail}"
    return f"(?:{_chars(table, 0xC2, 0xDF)}{tail}|{_chars(table, 0xE0, 0xEF)}{tail}{{2}}|{_chars(table, 0xF0, 0xF4)}{tail}{{3}})+"


class Repairer:
    """Chooses among decodings of a text by description length.

    The length of a candidate is the size of its zstandard frame under the best
    of the per-language dictionaries (the reference text of the language), plus
    ``UNSEEN_BITS`` and ``AGAIN_BITS`` an occurrence for each character that neither the reference of
    that language nor ``COMMON`` has, plus ``STEP_BITS`` for each re-decoding
    in its chain. All distinct readings up to ``MAX_STEPS`` are followed, also
    through readings that are longer themselves. The text stays unchanged
    unless a candidate is shorter.
    """

    def __init__(self, reference: dict[str, str]):
        self.tables = {c: _reading(c) for c in WRONG_SINGLE}
        self.runs = {c: re.compile(_utf8_runs(t)) for c, t in self.tables.items()}
        self.marks = {c: (frozenset(k for k, v in t.items() if v >= 0xC2), frozenset(k for k, v in t.items() if v < 0xC0)) for c, t in self.tables.items()}
        thai = {chr(o) for o in range(0xE00, 0xE80)}
        self.odd = frozenset(k for c, t in self.tables.items() if c != "cp874" for k in t) - thai
        self.legacy = {}
        for codec, t in self.tables.items():
            if codec != "cp874":
                each = "".join(re.escape(c) for c in t)
                self.legacy[codec] = re.compile(f"[{each}]{{3}}[{each}\\x00-\\x7f]*")
        self.three = re.compile("[" + "".join(re.escape(c) for c in self.odd) + "]{3}")
        self.wide = re.compile(r"[⺀-鿿가-힣豈-﫿＀-￯]")
        self.high = re.compile(r"[^\x00-\x7f]+")
        self.broken = re.compile("[\x80-\x84\x86-\x9f�]")
        self.models = {}
        for lang, text in sorted(reference.items()):
            data = zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(level=3)
            press = zstandard.ZstdCompressor(dict_data=data, write_content_size=False, write_dict_id=False, write_checksum=False)
            known = set(text) | set(text.upper()) | set(text.lower()) | set(COMMON)
            self.models[lang] = (press, {c for c in known if ord(c) > 127})
        self.languages = {
            "thai": [x for x in self.models if any("฀" <= c <= "๿" for c in self.models[x][1])],
            "han": [x for x in self.models if any("一" <= c <= "鿿" for c in self.models[x][1])],
        }
        self.latin = [x for x in self.models if x not in self.languages["thai"] and x not in self.languages["han"]] or list(self.models)

    def suspicious(self, text: str) -> bool:
        """Cheap and wide: whether any decoding is worth trying."""
        if text.isascii():
            return False
        chars = set(text)
        if self.broken.search(text):
            return True
        for codec, (lead, tail) in self.marks.items():
            if not chars.isdisjoint(lead) and not chars.isdisjoint(tail) and self.runs[codec].search(text):
                return True
        if len(chars & self.odd) > 2 and self.three.search(text):
            return True
        return self.wide.search(text) is not None and any(True for _ in self._multi(text))

    def length(self, text: str) -> float:
        """Description length in bits under the best language."""
        langs = self.languages["thai"] if re.search("[฀-๿]", text) else self.languages["han"] if re.search("[一-鿿]", text) else self.latin
        high = {c for c in text if ord(c) > 127 and unseen_matters(c)}
        data, best = text.encode("utf-8", "replace"), float("inf")
        for lang in langs or self.latin:
            press, known = self.models[lang]
            odd = [c for c in high if c not in known and not (("一" <= c <= "鿿") and lang in self.languages["han"])]
            best = min(best, 8 * len(press.compress(data)) + sum(UNSEEN_BITS + AGAIN_BITS * text.count(c) for c in odd))
        return best

    def _single(self, text: str) -> Iterator[str]:
        for codec, pattern in self.runs.items():
            table = self.tables[codec]

            def undo(m: re.Match, table: dict[str, int] = table) -> str:
                try:
                    return bytes(table[c] for c in m.group()).decode("utf-8")
                except UnicodeDecodeError:
                    return m.group()

            new = pattern.sub(undo, text)
            if new != text:
                yield new

    def _multi(self, text: str) -> Iterator[str]:
        for codec in WRONG_MULTI:
            def undo(m: re.Match, codec: str = codec) -> str:
                try:
                    return m.group().encode(codec).decode("utf-8")
                except UnicodeError:
                    return m.group()

            new = self.high.sub(undo, text)
            if new != text:
                yield new

    def _legacy(self, text: str) -> Iterator[str]:
        for wrong, pattern in self.legacy.items():
            if not pattern.search(text):
                continue
            table = self.tables[wrong]
            for codec in LEGACY:

                def undo(m: re.Match, codec: str = codec, table: dict[str, int] = table) -> str:
                    try:
                        return bytes(table.get(c, ord(c)) for c in m.group()).decode(codec)
                    except (UnicodeDecodeError, ValueError):
                        return m.group()

                if codec == "cp1258" and wrong != "cp1252":
                    continue
                new = pattern.sub(undo, text)
                if new != text and self._fits(new, codec):
                    yield new

    @staticmethod
    def _fits(text: str, codec: str) -> bool:
        """Whether most letters above ASCII are of the encoding's own script."""
        if codec == "cp1258":
            return True
        high = [c for c in text if c > "\x7f"]
        lo, hi = ("฀", "๿") if codec == "cp874" else ("一", "鿿")
        own = sum(1 for c in high if lo <= c <= hi)
        return own * 10 >= len(high) * 6

    def repair(self, text: str) -> tuple[bool, str]:
        """Whether the text is garbled, and the best reading of it."""
        if not self.suspicious(text):
            return False, text
        if cyrillic(text):
            return self.broken.search(text) is not None, text
        base = best = self.length(text)
        chosen, front, seen = text, [text], {text}
        for step in range(1, MAX_STEPS + 1):
            nxt = []
            for s in front:
                for new in (*self._single(s), *self._multi(s), *self._legacy(s)):
                    if new in seen:
                        continue
                    seen.add(new)
                    nxt.append(new)
                    cost = self.length(new) + STEP_BITS * step
                    if cost < best:
                        best, chosen = cost, new
            front = nxt
        return best < base or self.broken.search(text) is not None, chosen


_CYRILLIC = re.compile("[\u0400-\u052f]+")
_VOWEL = re.compile("[аеёиоуыэюяіїєўүөәъ]", re.IGNORECASE)


def cyrillic(text: str) -> bool:
    """Whether the characters above ASCII are words of a language written in Cyrillic, which no reference need have.

    Nearly all of them are letters, in words of one case but for a capital at the start, with a
    vowel in nearly each longer one. UTF-8 read in a Cyrillic encoding changes case and signs within words.
    """
    words = _CYRILLIC.findall(text)
    letters = sum(map(len, words))
    high = sum(1 for c in text if c > "\x7f" and c not in COMMON)
    if letters < 8 or letters < 0.95 * high:
        return False
    even = sum(len(w) for w in words if w.islower() or w.istitle() or w.isupper())
    long = [w for w in words if len(w) > 3]
    return even >= 0.95 * letters and len(long) * 5 >= len(words) and sum(1 for w in long if _VOWEL.search(w)) >= 0.9 * len(long)


def unseen_matters(c: str) -> bool:
    """Emoji, invisible and private characters are right in any text."""
    o = ord(c)
    return not (o >= 0x1F000 or 0x2000 <= o <= 0x200F or 0x2028 <= o <= 0x202F or 0x205F <= o <= 0x206F or o in (0xA0, 0xAD, 0xFEFF, 0x85) or 0x300 <= o <= 0x36F or 0x2600 <= o <= 0x27BF or 0xFE00 <= o <= 0xFE0F)


_KEPT: dict[int, Repairer] = {}


def repairer(reference: dict[str, str]) -> Repairer:
    """One repairer a Python worker for each reference."""
    key = hash(tuple(sorted(reference.items())))
    if key not in _KEPT:
        _KEPT[key] = Repairer(reference)
    return _KEPT[key]


def reference_texts(lang_reference: DataFrame) -> dict[str, str]:
    """Reference text of each language, on the driver; the table is bounded."""
    rows = lang_reference.where("lang is not null and text is not null").orderBy("ref_id").select("lang", "text").limit(MAX_REFERENCE + 1).collect()
    if len(rows) > MAX_REFERENCE:
        raise ValueError(f"the reference may have {MAX_REFERENCE} rows at most")
    out: dict[str, list[str]] = {}
    for r in rows:
        out.setdefault(r["lang"], []).append(r["text"])
    return {k: "\n".join(v) for k, v in out.items()}


def common_word_rows(common_words: DataFrame, most: int = MAX_REFERENCE) -> list[tuple[str | None, str]]:
    """``lang, word`` of each common word in a fixed order, on the driver; the table is bounded."""
    rows = common_words.where("word is not null").select("lang", "word").distinct().orderBy("lang", "word").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"the common words may have {most} rows at most")
    return [(r["lang"], r["word"]) for r in rows]


def restore_text(clips: DataFrame, lang_reference: DataFrame, id_col: str = "clip_id", text_col: str = "text") -> DataFrame:
    """``clip_id, garbled, text``: every record with its best reading.

    Null text is not garbled and stays null, empty and blank text stays as it
    is. A text with replacement or stray control characters is garbled even if
    no decoding brings the original back; then the best reading found is given.
    Whole texts are read whatever their length; there is no shuffle.
    """
    reference = reference_texts(lang_reference)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fix = repairer(reference)
        for batch in batches:
            pairs = [fix.repair(t) if t else (False, t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([p[0] for p in pairs], pa.bool_()), pa.array([p[1] for p in pairs], pa.string())], names=["clip_id", "garbled", "text"])

    return clips.select(F.col(id_col).cast("bigint").alias("clip_id"), F.col(text_col).alias("text")).mapInArrow(run, "clip_id bigint, garbled boolean, text string")


def garbled_records(clips: DataFrame, lang_reference: DataFrame) -> DataFrame:
    """Ids of the garbled records; ASCII texts never leave the JVM."""
    high = clips.select("clip_id", "text").where(F.col("text").rlike(r"[^\x00-\x7F]"))
    return restore_text(high, lang_reference).where("garbled").select("clip_id")
