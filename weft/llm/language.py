"""Language of each text and of each stretch of a mixed text, by cross-parsing."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weft.llm.encoding import common_word_rows, reference_texts, repairer

LANGS = ("en", "id", "th", "tl", "vi", "zh")
#: Spellings of the six languages: codes and names (fixed values).
ALIASES = {
    "en": "en eng english inggris ingles",
    "id": "id in ind indonesian indonesia bahasa",
    "th": "th tha thai siamese ไทย ภาษาไทย",
    "tl": "tl tgl fil filipino pilipino tagalog",
    "vi": "vi vie vietnamese việt tiếng",
    "zh": "zh zho chi cmn chinese mandarin putonghua 中文 汉语 漢語 普通话 hans hant",
}
ALIAS = {word: lang for lang, words in ALIASES.items() for word in words.split()}
#: Most frequent short texts that join the reference text, and their greatest length.
STOCK, STOCK_CHARS = 600, 40
SWITCH = 3.0
#: A stretch counts as a clause with at least so many words, or characters of unspaced script,
#: and so many phrases fewer than in the text's main language.
MIN_WORDS, MIN_THAI, MIN_HAN, MIN_GAIN = 3, 10, 5, 3.0

TOKEN = re.compile(r"[฀-๿]+|[㐀-鿿]+|[a-zA-ZÀ-ÖØ-öø-ɏ̀-ͯḀ-ỿ]+(?:['’\-][a-zA-ZÀ-ÖØ-öø-ɏ̀-ͯḀ-ỿ]+)*")
INVISIBLE = re.compile("[\xad​-‏⁠-⁤﻿]")
PREFIX = re.compile(r"^\s*(?:\([^()]*\)|\[[^\[\]]*\]|（[^（）]*）|【[^【】]*】)")


def label_language(label: str | None) -> str | None:
    """The language a label names, or null if it names none of the six."""
    if label is None:
        return None
    word = label.strip().lower()
    return ALIAS.get(word) or ALIAS.get(re.split(r"[-_ ]", word)[0])


class SuffixAutomaton:
    """All substrings of a text; counts the phrases of a greedy cross-parse."""

    def __init__(self, text: str):
        nxt: list[dict[str, int]] = [{}]
        link, length = [-1], [0]
        last = 0
        for ch in text:
            cur = len(nxt)
            nxt.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p != -1 and ch not in nxt[p]:
                nxt[p][ch] = cur
                p = link[p]
            if p != -1:
                q = nxt[p][ch]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    clone = len(nxt)
                    nxt.append(dict(nxt[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p != -1 and nxt[p].get(ch) == q:
                        nxt[p][ch] = clone
                        p = link[p]
                    link[q] = link[cur] = clone
            last = cur
        self.next = nxt

    def phrases(self, s: str) -> int:
        """Longest matches needed to cover ``s``; a character never seen is one."""
        nxt, root = self.next, self.next[0]
        n, state, open_ = 0, root, False
        for ch in s:
            t = state.get(ch)
            if t is None:
                n += open_
                t = root.get(ch)
                if t is None:
                    n, open_, state = n + 1, False, root
                    continue
            state, open_ = nxt[t], True
        return n + open_


class Identifier:
    def __init__(self, reference: dict[str, str]):
        self.langs = tuple(x for x in LANGS if x in reference)
        self.models = {}
        for lang in self.langs:
            text = unicodedata.normalize("NFC", reference[lang]).lower()
            words = TOKEN.findall(INVISIBLE.sub("", text))
            self.models[lang] = SuffixAutomaton(" " + "  ".join(words) + " ")
        self.alphabet = {lang: frozenset(m.next[0]) for lang, m in self.models.items()}
        self.kept: dict[str, tuple[float, ...]] = {}

    def cost(self, token: str) -> tuple[float, ...]:
        """Phrases of the token in each language, per eight characters of unspaced script."""
        got = self.kept.get(token)
        if got is not None:
            return got
        unspaced = token[0] >= "฀" and not "Ḁ" <= token[0] <= "ỿ"
        out = []
        for lang in self.langs:
            if unspaced and token[0] not in self.alphabet[lang] and self.alphabet[lang].isdisjoint(token):
                out.append(float(len(token)))
            else:
                out.append(float(self.models[lang].phrases(token if unspaced else f" {token} ")))
        made = tuple(out)
        if not unspaced:
            if len(self.kept) >= 200_000:
                self.kept.clear()
            self.kept[token] = made
        return made

    def tokens(self, text: str) -> list[tuple[int, int, str]]:
        m = PREFIX.match(text)
        start = m.end() if m and m.end() < len(text) else 0
        body = text[start:]
        if not body.isascii():
            body = unicodedata.normalize("NFC", body)
            if INVISIBLE.search(body):
                body = INVISIBLE.sub("", body)
        return [(x.start() + start, x.end() + start, x.group()) for x in TOKEN.finditer(body.lower())]

    def stretches(self, tokens: list[tuple[int, int, str]], costs: np.ndarray) -> list[tuple[int, int, int]]:
        """Cheapest labelling with ``SWITCH`` phrases for each change of language."""
        n, k = costs.shape
        back = np.zeros((n, k), dtype=np.int64)
        best = costs[0].copy()
        for i in range(1, n):
            j = int(best.argmin())
            change = best[j] + SWITCH
            stay = best <= change
            back[i] = np.where(stay, np.arange(k), j)
            best = np.where(stay, best, change) + costs[i]
        path = [int(best.argmin())]
        for i in range(n - 1, 0, -1):
            path.append(int(back[i, path[-1]]))
        path.reverse()
        runs, a = [], 0
        for i in range(1, n + 1):
            if i == n or path[i] != path[a]:
                runs.append((a, i, path[a]))
                a = i
        return runs

    def identify(self, text: str) -> list[tuple[str, float, int, int]]:
        """``(language, confidence, start, end)`` of the text's stretches, largest language first."""
        tokens = self.tokens(text)
        if not tokens or not self.langs:
            return []
        rows = [self.cost(t[2]) for t in tokens]
        total = [sum(c) for c in zip(*rows)]
        order = sorted(range(len(total)), key=total.__getitem__)
        main = order[0]
        gain = 0.0
        for r in rows:
            low = min(r)
            if low < r[main]:
                gain += r[main] - low
        whole = [(self.langs[main], self._confidence(total, main), tokens[0][0], tokens[-1][1])]
        if gain < MIN_GAIN:
            return whole
        costs = np.asarray(rows)
        runs = self.stretches(tokens, costs)
        if len(runs) == 1:
            return whole
        mass: dict[int, float] = {}
        for a, b, lang in runs:
            mass[lang] = mass.get(lang, 0.0) + sum(len(t[2]) for t in tokens[a:b])
        main = max(mass, key=lambda x: (mass[x], -x))
        held = []
        for a, b, lang in runs:
            sums = costs[a:b].sum(axis=0)
            if lang != main:
                letters = sum(len(t[2]) for t in tokens[a:b])
                first = tokens[a][2][0]
                enough = letters >= MIN_THAI if "฀" <= first <= "๿" else letters >= MIN_HAN if "㐀" <= first <= "鿿" else b - a >= MIN_WORDS
                if not enough or sums[main] - sums[lang] < MIN_GAIN:
                    lang = main
            if held and held[-1][2] == lang:
                held[-1] = (held[-1][0], b, lang)
            else:
                held.append((a, b, lang))
        out = []
        for a, b, lang in held:
            sums = costs[a:b].sum(axis=0).tolist()
            out.append((self.langs[lang], self._confidence(sums, lang), tokens[a][0], tokens[b - 1][1]))
        return out

    @staticmethod
    def _confidence(total: list[float], lang: int) -> float:
        other = min(c for i, c in enumerate(total) if i != lang) if len(total) > 1 else total[lang] + 1
        return round(max(0.0, min(1.0, (other - total[lang]) / max(other, 1.0) * 2)), 4)


def stock_phrases(clips: DataFrame, top: int = STOCK, chars: int = STOCK_CHARS) -> dict[str, str]:
    """Short texts that recur, under the language most of their labels name.

    A bounded sample of labelled rows to fit on: the ``top`` most frequent
    texts of at most ``chars`` characters, counted over all rows.
    """
    rows = (
        clips.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & (F.length("text") <= chars) & (F.length(F.trim("text")) > 1))
        .groupBy(F.lower(F.trim("text")).alias("t"), F.lower(F.trim("lang")).alias("l"))
        .count()
    )
    w = W.partitionBy("t")
    rows = rows.withColumn("n", F.sum("count").over(w)).where("n >= 5 and count * 10 >= n * 2").orderBy(F.desc("n"), "t", F.desc("count"), "l").limit(8 * top).collect()
    votes: dict[str, dict[str, int]] = {}
    for r in rows:
        lang = label_language(r["l"])
        if lang:
            own = votes.setdefault(r["t"], {})
            own[lang] = own.get(lang, 0) + r["count"]
    out: dict[str, list[str]] = {}
    for text, own in list(votes.items())[:top]:
        lang = max(own, key=lambda x: (own[x], x))
        out.setdefault(lang, []).append(text)
    return {k: "\n".join(v) for k, v in out.items()}


_KEPT: dict[int, Identifier] = {}


def identifier(reference: dict[str, str]) -> Identifier:
    key = hash(tuple(sorted(reference.items())))
    if key not in _KEPT:
        _KEPT[key] = Identifier(reference)
    return _KEPT[key]


def identify_languages(clips: DataFrame, lang_reference: DataFrame, common_words: DataFrame | None = None) -> DataFrame:
    """Language, confidence and stretches of every record's text.

    ``clip_id, label_lang, lang, confidence, stretches, garbled, wrong``:
    ``label_lang`` is the language the label names (null: none), ``lang`` that
    of most of the text, ``stretches`` its parts as ``(lang, confidence, start,
    end)``, one for a text of one language, and ``wrong`` says that the label is
    missing or another, or the text mixes languages. A suffix automaton a
    language holds its reference text; each word costs the longest matches
    needed to cover it, and the language with the fewest phrases wins; a change
    of language within a text costs ``SWITCH`` phrases. ``garbled`` is found
    out only where ``wrong``. A leading bracketed prefix is left out. Texts
    without letters, blank and null texts have no language, no stretches and
    are not wrong. Ties go to the language first in ``LANGS``. With an
    empty reference no text has a language. No shuffle.
    """
    plain = reference_texts(lang_reference)
    fitted = dict(plain)
    if common_words is not None:
        for lang, word in common_word_rows(common_words.where("lang is not null")):
            fitted[lang] = fitted.get(lang, "") + "\n" + word
    for lang, text in stock_phrases(clips).items():
        fitted[lang] = fitted.get(lang, "") + "\n" + text
    item = pa.struct([("lang", pa.string()), ("confidence", pa.float64()), ("start", pa.int32()), ("end", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, fix = identifier(fitted), repairer(plain)
        labels: dict[str | None, str | None] = {}
        for batch in batches:
            got_label, main, conf, wrong, garbled, ends = [], [], [], [], [], [0]
            parts: tuple[list, list, list, list] = ([], [], [], [])
            for text, label in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if label not in labels:
                    labels[label] = label_language(label)
                named = labels[label]
                got_label.append(named)
                found = model.identify(text) if text and not text.isspace() else []
                for x in found:
                    for column, value in zip(parts, x):
                        column.append(value)
                ends.append(len(parts[0]))
                bad = False
                if found:
                    size: dict[str, int] = {}
                    for lang, _, a, b in found:
                        size[lang] = size.get(lang, 0) + b - a
                    top = max(size, key=lambda x: size[x])
                    main.append(top)
                    conf.append(max(c for lang, c, _, _ in found if lang == top))
                    bad = len(size) > 1 or named != top
                else:
                    main.append(None)
                    conf.append(None)
                wrong.append(bad)
                garbled.append(fix.repair(text)[0] if bad else False)
            flat = pa.StructArray.from_arrays([pa.array(v, f.type) for v, f in zip(parts, item)], fields=list(item))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(got_label, pa.string()), pa.array(main, pa.string()), pa.array(conf, pa.float64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat), pa.array(garbled, pa.bool_()), pa.array(wrong, pa.bool_())],
                names=["clip_id", "label_lang", "lang", "confidence", "stretches", "garbled", "wrong"],
            )

    return clips.select(F.col("clip_id").cast("bigint").alias("clip_id"), "text", F.col("lang").alias("label")).mapInArrow(
        run,
        "clip_id bigint, label_lang string, lang string, confidence double, stretches array<struct<lang:string,confidence:double,start:int,end:int>>, garbled boolean, wrong boolean",
    )


def language_cases(clips: DataFrame, lang_reference: DataFrame, common_words: DataFrame | None = None) -> DataFrame:
    """``clip_id, found_lang`` for each language of a text that needs a new label."""
    found = identify_languages(clips.where("text is not null"), lang_reference, common_words)
    return found.where("wrong and not garbled").select("clip_id", F.explode(F.array_distinct(F.col("stretches.lang"))).alias("found_lang"))
