"""Per-document text statistics, and prose told from junk by learned rules."""

from __future__ import annotations

import random
import sys
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm.encoding import common_word_rows, reference_texts

#: Bounds of what the driver may hold: common words, and labelled documents to learn from.
MAX_COMMON, LABELLED = 20_000, 2_400
#: Characters worked on together; a longer text is worked on alone.
TOGETHER = 500_000
#: Words that a Han character and a Thai syllable stand for where the length of a piece matters, and words of an item that reads like prose.
HAN_WEIGHT, THAI_WEIGHT, ITEM_WORDS = 0.7, 0.8, 10
#: A repeat counts if the same three words stood at most so many words before.
NEAR_WORDS = 256
#: Characters that end a line of prose (fixed values).
ENDS = ".!?…。！？；;:：”»\"'’)）」』"
#: Characters that end a sentence before a blank or line end, and those that do so anywhere (fixed values).
STOPS, WIDE_STOPS = ".!?…", "。！？"
#: Signs of data, markup and code, which prose does not run across (fixed values).
SEPARATORS = "|;={}<>[]•·\\~^*_#\t"
#: Commas (fixed values), and signs that begin an item of a list.
COMMAS, BULLETS = ",，、", "-–—*•·#>|"
INVISIBLE = "\u00ad\u200b\u200c\u200d\u200e\u200f\u2060\ufeff"
#: Statistics the rules may test.
FEATURES = ("flow", "long4", "long8", "common4", "listed", "mean_piece", "mean_run", "common_share", "digit_share", "symbol_share", "odd_share", "end_punct_share", "short_lines", "distinct_lines", "repeat_share", "bullet_share", "mean_word")
COUNTS = ("chars", "words", "lines")
LETTER, NUMBER, BLANK, THAI, HAN, JOINER, BREAK, HIDDEN = (1 << i for i in range(8))
STOP, WIDE, SEPARATOR, COMMA, BULLET, END, VOWEL, LEADING, CONSONANT, SYMBOL, SLASH, CLOSER = (1 << i for i in range(8, 20))


@cache
def _table() -> tuple[np.ndarray, np.ndarray]:
    """Classes and lower case of every character."""
    every = [chr(i) for i in range(sys.maxunicode + 1) if not 0xD800 <= i < 0xE000]
    text = "".join(every)
    kind = np.zeros(sys.maxunicode + 1, dtype=np.int32)
    for pattern, flag in ((r"[\p{L}\p{M}]", LETTER), (r"\p{N}", NUMBER), (r"[\s\p{Z}]", BLANK), (r"[\p{P}\p{S}]", SYMBOL), (r"[\p{Han}]", HAN), ("[\u0e01-\u0e5b]", THAI)):
        kind[[ord(c) for c in regex.findall(pattern, text)]] |= flag
    for chars, flag in (("'’-", JOINER), ("\n\r", BREAK), (INVISIBLE, HIDDEN), (STOPS, STOP), (WIDE_STOPS, WIDE), (SEPARATORS, SEPARATOR), (COMMAS, COMMA), (BULLETS, BULLET), (ENDS, END), ("/·", SLASH), (".)）", CLOSER), ("bcdfghjklmnpqrstvwxz", CONSONANT)):
        kind[[ord(c) for c in chars]] |= flag
    for lo, hi in ((0xE30, 0xE3A), (0xE47, 0xE4E)):
        kind[lo : hi + 1] |= VOWEL
    kind[0xE40:0xE45] |= LEADING
    lower = np.arange(sys.maxunicode + 1, dtype=np.uint32)
    for c in every:
        if (low := c.lower()) != c and len(low) == 1:
            lower[ord(c)] = ord(low)
    return kind, lower


def _mixed(codes: np.ndarray, place: np.ndarray) -> np.ndarray:
    h = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + place.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _hash(word: str) -> int:
    codes = np.array([ord(c) for c in word], dtype=np.uint64)
    return int(_mixed(codes, np.arange(len(codes))).sum(dtype=np.uint64))


class Statistics:
    """Statistics of texts in numpy, over the characters of many texts at once.

    ``common`` are words that stand alone; those of unspaced scripts count
    wherever they occur.
    """

    def __init__(self, common: list[str]):
        own = {unicodedata.normalize("NFC", w.lower()) for w in common if w}
        dense = {w for w in own if any("\u0e00" <= c <= "\u0e7f" or "\u3400" <= c <= "\u9fff" for c in w)}
        self.spaced = np.array(sorted(_hash(w) for w in own - dense), dtype=np.uint64)
        self.dense = {n: np.array(sorted(_hash(w) for w in dense if len(w) == n), dtype=np.uint64) for n in sorted({len(w) for w in dense})}

    @staticmethod
    def _among(h: np.ndarray, known: np.ndarray) -> np.ndarray:
        if not len(known):
            return np.zeros(len(h), dtype=bool)
        at = np.searchsorted(known, h)
        at[at == len(known)] = 0
        return known[at] == h

    def of(self, texts: list[str]) -> dict[str, np.ndarray]:
        kinds, lower = _table()
        n = len(texts)
        own = [unicodedata.normalize("NFC", t) for t in texts]
        codes = np.frombuffer(("\n".join(own) + "\n").encode("utf-32-le"), dtype=np.uint32)
        doc = np.repeat(np.arange(n), [len(t) + 1 for t in own])
        kind = kinds[codes]
        if (kind & HIDDEN).any():
            keep = (kind & HIDDEN) == 0
            codes, doc, kind = codes[keep], doc[keep], kind[keep]
        low, size = lower[codes], len(codes)

        def has(flag: int) -> np.ndarray:
            return (kind & flag) != 0

        def before(a: np.ndarray, k: int = 1) -> np.ndarray:
            out = np.zeros(size, dtype=a.dtype)
            out[k:] = a[:-k]
            return out

        def after(a: np.ndarray) -> np.ndarray:
            out = np.zeros(size, dtype=a.dtype)
            out[:-1] = a[1:]
            return out

        def per(ids: np.ndarray, count: int, weights: np.ndarray | None = None) -> np.ndarray:
            return np.bincount(ids, weights, minlength=count)[:count]

        letter, number, solid, thai, han, newline = has(LETTER), has(NUMBER), ~has(BLANK), has(THAI), has(HAN), has(BREAK)
        chars = per(doc, n) - 1
        # words: unbroken letters and numbers, also around an apostrophe or hyphen; a Han character; a Thai syllable, roughly
        inner = letter | number
        inner |= has(JOINER) & before(inner) & after(inner)
        leading, vowel = has(LEADING), has(VOWEL)
        syllable = thai & (leading | (letter & ~vowel & after(vowel) & ~before(leading)))
        start = inner & (~before(inner) | han | before(han) | syllable | (thai != before(thai)))
        at = np.flatnonzero(start)
        wdoc, nw = doc[at], len(at)
        word = np.cumsum(start) - 1
        inside = np.flatnonzero(inner)
        wid = word[inside]
        h = np.zeros(nw, dtype=np.uint64)
        if nw:
            h = np.add.reduceat(_mixed(low[inside], inside - at[wid]), np.flatnonzero(np.r_[True, wid[1:] != wid[:-1]]))
        length = per(wid, nw)
        digits, alphas = per(wid, nw, number[inside]), per(wid, nw, letter[inside])
        hard = (kinds[low] & CONSONANT) != 0
        five = hard & before(hard) & before(hard, 2) & before(hard, 3) & before(hard, 4)
        odd = ((digits > 0) & (alphas > 0)) | (per(word[five], nw) > 0)
        common = self._among(h, self.spaced)
        hits = [at[common]]
        if self.dense and (thai.any() or han.any()):
            spots = np.flatnonzero((thai | han) & letter)
            for k, known in self.dense.items():
                some = spots[spots + k <= size]
                hits.append(some[self._among(sum((_mixed(low[some + j], np.full(1, j)) for j in range(k)), np.zeros(len(some), np.uint64)), known)])
        hits = np.concatenate(hits)
        words = per(wdoc, n)
        # lines with text
        line = np.cumsum(newline) - newline
        full = np.flatnonzero(solid)
        first = np.flatnonzero(np.r_[True, line[full][1:] != line[full][:-1]]) if len(full) else np.zeros(0, np.int64)
        begin, width = full[first], np.diff(np.r_[first, len(full)])
        end = full[np.r_[first[1:], len(full)] - 1] if len(full) else begin
        ldoc, ended = doc[begin], (kind[end] & END) != 0
        lines = per(ldoc, n)
        spot = np.arange(len(full)) - np.repeat(first, width)
        lhash = np.add.reduceat(_mixed(low[full], spot), first) if len(full) else np.zeros(0, np.uint64)
        order = np.lexsort((lhash, ldoc))
        fresh = np.r_[len(order) > 0, (lhash[order][1:] != lhash[order][:-1]) | (ldoc[order][1:] != ldoc[order][:-1])][: len(order)]
        distinct = per(ldoc[order[fresh]], n)
        bullet = (kind[begin] & BULLET) != 0
        named = letter | number  # a), 1. or 12) and a blank
        for k in (1, 2, 3):
            ok = begin[begin + k + 1 < size]
            bullet[: len(ok)] |= np.logical_and.reduce([named[ok + j] for j in range(k)]) & ((kind[ok + k] & CLOSER) != 0) & ~solid[ok + k + 1]
        # a piece ends with a sentence, a sign of data, or a line unless the line only wraps
        split = newline | has(SEPARATOR) | has(WIDE) | (has(STOP) & (after(~solid) | after(has(END)))) | (has(JOINER | SLASH) & before(~solid) & after(~solid))
        if len(begin) > 1:
            goes_on = (width[:-1] >= 36) & ~ended[:-1] & ~bullet[1:] & (letter | number)[begin[1:]] & (ldoc[1:] == ldoc[:-1]) & (line[begin[1:]] == line[begin[:-1]] + 1)
            for a, b in zip(end[:-1][goes_on], begin[1:][goes_on]):
                split[a + 1 : b] &= ~newline[a + 1 : b]
        piece = np.cumsum(split) - split
        pieces = int(piece[-1]) + 1 if size else 0
        weight = np.where(han[at], HAN_WEIGHT, np.where(thai[at], THAI_WEIGHT, 1.0))
        pw, pc = per(piece[at], pieces, weight), per(piece[full], pieces)
        item = per(piece[begin[bullet]], pieces) > 0
        stretch = np.cumsum(split | has(COMMA))
        sw = per(stretch[at], int(stretch[-1]) + 1, weight)
        sdoc = np.zeros(len(sw), dtype=np.int64)
        sdoc[stretch] = doc
        commas, pnum, podd, phit = per(piece[has(COMMA)], pieces), per(piece[number], pieces), per(piece[at[odd]], pieces), per(piece[hits], pieces)
        pdoc = np.zeros(pieces, dtype=np.int64)
        pdoc[piece] = doc
        spread = pw >= 3 * (commas + 1)
        flowing = (pw >= np.where(item, ITEM_WORDS, 5)) & (phit >= 1) & spread & (pnum <= 0.3 * pc) & (podd <= 0.25 * np.maximum(pw, 1))
        total = per(pdoc, n, pc)
        # three words that stood shortly before
        again = np.zeros(n)
        if nw > 2:
            gram = h[:-2] * np.uint64(0x9E3779B97F4A7C15) + h[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + h[2:]
            gram ^= wdoc[:-2].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
            whole = np.flatnonzero(wdoc[:-2] == wdoc[2:])
            order = whole[np.argsort(gram[whole], kind="stable")]
            near = (gram[order][1:] == gram[order][:-1]) & (np.diff(order) <= NEAR_WORDS)
            again = per(wdoc[order[1:][near]], n)

        def ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            return np.round(a / np.maximum(b, 1), 6)

        def share(which: np.ndarray) -> np.ndarray:
            return ratio(per(pdoc, n, pc * which), total)

        return {
            "chars": chars, "words": words, "lines": lines,
            "flow": share(flowing), "long4": share(pw >= 4), "long8": share(pw >= 8), "common4": share((pw >= 4) & (phit >= 1)), "listed": share(~spread),
            "mean_piece": ratio(words, per(pdoc, n, pw > 0)), "mean_run": ratio(per(sdoc, n, sw * sw), per(sdoc, n, sw)), "common_share": np.minimum(ratio(per(doc[hits], n), words), 1.0),
            "digit_share": ratio(per(doc[number], n), chars), "symbol_share": ratio(per(doc[has(SYMBOL)], n), chars), "odd_share": ratio(per(wdoc[odd], n), words),
            "end_punct_share": ratio(per(ldoc[ended], n), lines), "short_lines": ratio(per(ldoc[width < 25], n), lines), "distinct_lines": ratio(distinct, lines),
            "repeat_share": ratio(again, words - 2), "bullet_share": ratio(per(ldoc[bullet], n), lines), "mean_word": ratio(per(wdoc, n, length), words),
        }


def text_statistics(docs: DataFrame, common_words: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of statistics a document, from one Arrow pass over the whole texts.

    ``chars``, ``words`` and ``lines`` (with text) without invisible characters;
    a Han character is a word, and so is roughly a syllable of Thai, which has no blanks between words.
    ``mean_word`` in characters; shares of digits (any numbers) and symbols (any punctuation or symbol) among the
    characters, of odd and of common words among the words, of lines that end in punctuation, are
    shorter than 25 characters, begin like an item, or are distinct; ``repeat_share`` of the word trigrams
    that stood at most ``NEAR_WORDS`` words before. A text is also cut into pieces at
    sentence ends, signs of data and line ends (not where a line only wraps); ``long4``
    and ``long8`` are the shares of characters in pieces of so many words, ``common4`` those with a common word,
    ``listed`` those with a comma every three words, ``flow`` those of at least
    five words (ten in an item), one of them common, few commas, digits and odd words, ``mean_piece`` is the words a piece,
    and ``mean_run`` the mean over words of the words between two commas or ends of pieces; here a Han character
    counts 0.7 words and a Thai syllable 0.8.
    Null text gives null statistics, empty and blank text zeros. Nothing is shuffled.
    """
    listed = [w for _, w in common_word_rows(common_words, MAX_COMMON)]
    names = ("doc_id", *COUNTS, *FEATURES)
    types = [pa.int64()] * 4 + [pa.float64()] * len(FEATURES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Statistics(listed)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            at = 0
            while at < len(texts):
                stop, size = at + 1, len(texts[at] or "")
                while stop < len(texts) and size + len(texts[stop] or "") <= TOGETHER:
                    size += len(texts[stop] or "")
                    stop += 1
                some = texts[at:stop]
                got, null = make.of([t or "" for t in some]), np.array([t is None for t in some])
                columns = [pa.array(got[c], t, mask=null) if t == pa.float64() else pa.array(got[c].astype(np.int64), t, mask=null) for c, t in zip(names[1:], types[1:])]
                yield pa.RecordBatch.from_arrays([ids.slice(at, stop - at), *columns], names=list(names))
                at = stop

    kinds = ", ".join(f"{c} {'double' if c in FEATURES else 'bigint'}" for c in names)
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, kinds)


def labelled_documents(reference: dict[str, str], n: int = LABELLED, seed: int = 7) -> list[tuple[int, str, int]]:
    """``doc_id, text, is_prose`` made from reference sentences, whose kind is known by construction.

    Prose: paragraphs, dialogue, transcripts without punctuation, wrapped lines, short sentences,
    sentences with figures, verses, headings and short lists. Others: enumerations, tables, records, logs, code, dumps,
    made-up words, symbols, one phrase over and over, and prose drowned in any of these. Field names, tags and
    other words of the latter are random syllables or pieces of sentences.
    """
    rng = random.Random(seed)
    langs = sorted(reference)
    if not langs:
        return []
    lines = {k: [s for s in reference[k].split("\n") if s.strip()] for k in langs}
    abc = "abcdefghijklmnopqrstuvwxyz"

    def made(most: int = 4) -> str:
        return "".join(rng.choice("bcdfghjklmnpqrstvwxz") + rng.choice("aeiou") + rng.choice(["", "", "q", "x", "rz", "r", "n", "k", "s", "ng"]) for _ in range(rng.randint(1, most)))

    def letters(lo: int, hi: int, of: str) -> str:
        return "".join(rng.choice(of) for _ in range(rng.randint(lo, hi)))

    def number() -> str:
        return rng.choice([str(rng.randint(0, 9999)), f"{rng.random():.{rng.randint(1, 5)}f}", f"{rng.random() * 90:.2f}", f"{rng.randint(0, 23):02d}:{rng.randint(0, 59):02d}", f"20{rng.randint(10, 39)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}"])

    def pick(lang: str, k: int) -> list[str]:
        return rng.sample(lines[lang], k) if k <= len(lines[lang]) else [rng.choice(lines[lang]) for _ in range(k)]

    def phrase(lang: str, lo: int = 1, hi: int = 5) -> str:
        s = rng.choice(lines[lang])
        if lang in ("zh", "th"):
            s = regex.sub(r"[\p{P}\s]+", "", s)
            size = rng.randint(lo, hi) * (2 if lang == "zh" else 4)
            a = rng.randrange(max(1, len(s) - size))
            return s[a : a + size]
        w = regex.sub(r"[^\p{L}\p{M}\p{N}'’ -]", "", s).split()
        k = rng.randint(lo, hi)
        a = rng.randrange(max(1, len(w) - k))
        return " ".join(w[a : a + k])

    def turn(lang: str, lo: int, hi: int) -> str:
        a = phrase(lang, lo, hi)
        if rng.random() < 0.3:
            a += rng.choice(["，", "、"] if lang == "zh" else [" "] if lang == "th" else [", "]) + phrase(lang, 2, 5)
        return a[:1].upper() + a[1:] + rng.choice("。？！" if lang == "zh" else ["", " ", "?"] if lang == "th" else "..?!")

    def junk(lang: str, size: int) -> str:
        k = max(6, size // 22)
        names = [rng.choice([made(2), made(3), phrase(lang, 1, 1)]) for _ in range(rng.randint(2, 6))]

        def cell() -> str:
            return rng.choice([number(), number(), phrase(lang, 1, 4), made(3), letters(2, 6, abc)])

        kind = rng.randrange(17)
        if kind < 3:
            mark = [rng.choice(["- ", "* ", "• ", "[ ] ", "", "> "]), "{}) ", "{}. "][kind]
            return "\n".join(mark.format(i + 1) + phrase(lang) + rng.choice(["", "", ".", f" {number()}"]) for i in range(k))
        if kind == 3:
            return rng.choice([" | ", "; ", ", ", ", ", " / ", " · ", "、"]).join(phrase(lang, 1, 3) for _ in range(k))
        if kind in (4, 5):
            a, mid, b = rng.choice([("| ", " | ", " |"), ("", ",", ""), ("", "\t", ""), ("", ";", ""), ("", "  ", "")])
            rows = [names, *[[cell() for _ in names] for _ in range(k // 2)]]
            return "\n".join(a + mid.join(r) + b for r in rows)
        if kind == 6:
            mid, dash = rng.choice([": ", "=", " = ", " -> "]), rng.choice(["", "- ", "  "])
            return rng.choice(["\n", " "]).join(f"{dash}{x}{mid}{cell()}" for _ in range(k // len(names) + 1) for x in names)
        if kind == 7:
            tags = [made(2).upper() for _ in range(3)]
            return "\n".join(f"[{number()}] {rng.choice(tags)} {phrase(lang, 1, 4)} {number()}" for _ in range(k // 2))
        if kind == 8:
            a, b = rng.choice(["[]", "()", "<>", "  "])
            return " ".join(f"{a}{number()}{b}" for _ in range(k))
        if kind == 9:
            entries = [rng.choice([made(2).title(), phrase(lang, 1, 2), number(), made(2) + "." + letters(2, 3, abc), rng.choice("«»‹›→←✓×") + " " + made(2)]) for _ in range(8)]
            return rng.choice(["\n", " ", " | "]).join(rng.choice(entries) for _ in range(k))
        if kind == 10:
            unit = rng.choice([phrase(lang, 1, 1), phrase(lang), phrase(lang), rng.choice(lines[lang])])
            return rng.choice([" ", "\n", ". ", ", "] + [""] * (lang in ("th", "zh"))).join([unit] * (size // max(1, len(unit)) + 5))
        if kind == 11:
            return " ".join(letters(3, 12, abc) for _ in range(k * 2))
        if kind == 12:
            return " ".join(letters(8, 60, abc + abc.upper() + "0123456789+/") for _ in range(k))
        if kind == 13:
            return " ".join(letters(2, 8, "!@#$%^&*()_+-=<>?/|~{}[]") for _ in range(k * 2))
        if kind == 14:
            pad = " " * rng.choice([2, 4])
            return "\n".join(f"{letters(2, 5, abc)} {made(2)}({letters(1, 4, abc)}) {{\n{pad}{made(2)} = {made(1)}[{number()}];\n{pad}{letters(3, 6, abc)} {made(2)}({letters(1, 4, abc)});\n}}" for _ in range(k // 4 + 1))
        if kind == 15:
            return "\n".join(f"{i:08x}  " + " ".join(letters(2, 2, "0123456789abcdef") for _ in range(16)) for i in range(0, k * 8, 16))
        return " ".join(made(5) for _ in range(k * 3))

    def prose(lang: str, k: int) -> str:
        kind, s = rng.randrange(11), pick(lang, k)
        glue = "" if lang == "zh" else " "
        flat = regex.sub(r"[.,;?!…。，；？！]", " " if lang == "zh" else "", glue.join(s))
        if kind == 0:
            return "\n".join(f"{phrase(lang, 1, 2)}: {x}" for x in s)
        if kind == 1:
            if rng.random() < 0.3:
                return "\n".join(rng.choice(["“{}”", "- {}", "— {}", "“{}” " + phrase(lang, 2, 4) + "."]).format(x) for x in s)
            a, b = rng.choice(["“”", '""', "「」"] if lang == "zh" else ["“”", '""'])
            return "\n".join(a + turn(lang, 3, 9) + b + rng.choice(["", glue + phrase(lang, 2, 4) + "."]) for _ in range(k + 3))
        if kind == 2:
            return flat.lower()
        if kind == 3 and lang not in ("zh", "th"):
            width, out, row = rng.randint(40, 80), [], ""
            for w in glue.join(s).split():
                if len(row) + len(w) > width:
                    out.append(row)
                    row = ""
                row = (row + " " + w).strip()
            return "\n".join([*out, row])
        if kind == 4:
            return f"# {phrase(lang)} {rng.randint(1, 40)}\n\n{glue.join(s)}\n\n" + "\n".join(f"- {phrase(lang)}" for _ in range(rng.randint(0, 3)))
        if kind == 5:
            return glue.join(s).upper()
        if kind == 6:  # short sentences
            return glue.join(turn(lang, 4, 9) for _ in range(2 * k + 2))
        if kind == 7:  # figures in sentences
            out = []
            for x in s:
                for _ in range(rng.randint(0, 3)):
                    a = rng.randrange(len(x)) if lang in ("zh", "th") else x.find(" ", rng.randrange(len(x)))
                    x = x[:a] + f" {number()}{rng.choice(['', '', '%'])}" + x[a:] if a > 0 else x
                out.append(x)
            return glue.join(out)
        if kind == 8:  # verses
            if lang in ("zh", "th"):
                return "\n".join(flat[i : i + (14 if lang == "zh" else 30)] for i in range(0, len(flat), 14 if lang == "zh" else 30))
            w = flat.split()
            return "\n".join(" ".join(w[i : i + 6]) for i in range(0, len(w), 6))
        if kind == 9:  # many commas
            w = glue.join(s).split(" ")
            return " ".join(x + "," if rng.random() < 0.2 and x[-1:].isalpha() else x for x in w)
        return rng.choice(["\n\n", "\n", glue]).join(glue.join(s[i : i + 3]) for i in range(0, k, 3))

    out = []
    for i in range(n):
        lang = langs[i % len(langs)]
        kind = rng.random()
        if kind < 0.45:
            out.append((i, prose(lang, rng.choice([1, 2, 3, 4, 5, 6, 8, 12, 30, 80])), 1))
        elif kind < 0.85:
            out.append((i, junk(lang, rng.choice([80, 200, 500, 1000, 3000])), 0))
        else:
            text = prose(lang, rng.randint(1, 5))
            share = rng.choice([0.15, 0.25, 0.7, 0.8])
            other = junk(lang, int(len(text) * share / (1 - share)))
            got = len(other) / (len(other) + len(text))
            if 0.4 < got < 0.62:
                continue
            out.append((i, "\n".join([text, other] if rng.random() < 0.5 else [other, text]), int(got < 0.5)))
    return out


Rule = list[tuple[str, str, float]]
#: Splits tried in vain before a list of rules ends.
AGAIN = 8
#: Pruning rows of class 0 that a rule must cover.
LEAST = 5


def induce_rules(x: np.ndarray, y: np.ndarray, names: tuple[str, ...] = FEATURES, seed: int = 3, max_rules: int = 24) -> list[Rule]:
    """An ordered list of rules for class 0 by incremental reduced-error pruning.

    Again and again: two thirds of the rows left grow a rule, test by test, of
    greatest information gain, until it covers no row of the other class; the
    rest prunes its last tests while ``(p - n) / (p + n)`` does not fall. The
    rule joins the list and its rows leave; a rule wrong in more than a tenth
    of its pruning rows (worth below 0.8), or right in fewer than ``LEAST``, is grown again from another split, and
    ends the list when ``AGAIN`` splits in a row give no better one. Of several tests of one
    statistic in a direction only the last, the narrowest, is kept.
    """
    rng = np.random.default_rng(seed)
    left = np.ones(len(y), dtype=bool)
    rules: list[Rule] = []
    failed = 0

    def covers(rule: Rule, rows: np.ndarray) -> np.ndarray:
        m = np.ones(len(rows), dtype=bool)
        for f, op, v in rule:
            c = rows[:, names.index(f)]
            m &= (c <= v) if op == "<=" else (c >= v)
        return m

    while len(rules) < max_rules and failed < AGAIN and (y[left] == 0).sum() >= 3:
        idx = rng.permutation(np.flatnonzero(left))
        cut = len(idx) * 2 // 3
        gx, gy, px, py = x[idx[:cut]], y[idx[:cut]], x[idx[cut:]], y[idx[cut:]]
        rule: Rule = []
        m = np.ones(len(gy), dtype=bool)
        while (gy[m] == 1).any() and len(rule) < 6:
            p0, n0 = (gy[m] == 0).sum(), (gy[m] == 1).sum()
            best = (0.0, None)
            for j, f in enumerate(names):
                col = gx[m, j]
                order = np.argsort(col, kind="stable")
                v, pos = col[order], (gy[m][order] == 0)
                p, n = np.cumsum(pos), np.cumsum(~pos)
                ends = np.flatnonzero(np.r_[v[1:] != v[:-1], False])
                if not len(ends):
                    continue
                mid = (v[ends] + v[ends + 1]) / 2
                for op, pp, nn in (("<=", p[ends], n[ends]), (">=", p0 - p[ends], n0 - n[ends])):
                    with np.errstate(divide="ignore", invalid="ignore"):
                        g = pp * (np.log2(pp / (pp + nn)) - np.log2(p0 / (p0 + n0)))
                    g = np.nan_to_num(g, nan=-1.0)
                    k = int(g.argmax())
                    if g[k] > best[0] + 1e-9:
                        best = (float(g[k]), (f, op, round(float(mid[k]), 4)))
            if best[1] is None:
                break
            rule.append(best[1])
            m &= covers([best[1]], gx)

        def worth(r: Rule) -> float:
            c = covers(r, px)
            p, n = (py[c] == 0).sum(), (py[c] == 1).sum()
            return (p - n) / (p + n) if p + n else -1.0

        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule = rule[:-1]
        if not rule or worth(rule) < 0.8 or (py[covers(rule, px)] == 0).sum() < LEAST:
            failed += 1
            continue
        failed = 0
        rule = list({(f, op): (f, op, v) for f, op, v in rule}.values())
        rules.append(rule)
        left &= ~covers(rule, x)
    return rules


def rules_case(rules: list[Rule]) -> str:
    """The rules as one SQL CASE expression: 1 prose, 0 other, null for no text."""
    arms = " ".join("WHEN " + " AND ".join(f"{f} {op} {v!r}" for f, op, v in r) + " THEN 0" for r in rules)
    return f"CASE WHEN chars IS NULL OR words + symbol_share + digit_share = 0 THEN NULL {arms} ELSE 1 END"


def learn_rules(lang_reference: DataFrame, common_words: DataFrame) -> list[Rule]:
    """Rules from documents labelled by construction; at most ``LABELLED`` of them."""
    made = labelled_documents(reference_texts(lang_reference))
    if not made:
        return []
    got = Statistics([w for _, w in common_word_rows(common_words, MAX_COMMON)]).of([t for _, t, _ in made])
    return induce_rules(np.column_stack([got[f] for f in FEATURES]), np.array([y for _, _, y in made]))


def document_quality(docs: DataFrame, lang_reference: DataFrame, common_words: DataFrame) -> DataFrame:
    """Statistics of each document and ``is_prose`` (1, 0, or null for blank text).

    With an empty reference there are no rules, and any text counts as prose.
    """
    rules = learn_rules(lang_reference, common_words)
    return text_statistics(docs, common_words).withColumn("is_prose", F.expr(rules_case(rules)))


def junk_documents(docs: DataFrame, lang_reference: DataFrame, common_words: DataFrame) -> DataFrame:
    """Ids of documents with text, less than half of which is running prose."""
    return document_quality(docs, lang_reference, common_words).where("is_prose = 0").select("doc_id")
