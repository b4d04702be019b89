"""Held-out sentences inside training text, by multi-pattern search."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm.encoding import reference_texts, repairer
from weft.llm.letters import words

#: Words in a row that make a leak, and the most held-out rows accepted.
WORDS, MAX_ITEMS = 6, 200_000
BLOCK = 3


class WuManber:
    """Finds which of many strings occur in a text.

    Only the first ``m`` characters of each string count for skipping, ``m``
    being the shortest length. A block table tells for the last ``BLOCK``
    characters of the window how far no string can begin; at shift 0 the
    block's bucket of strings is narrowed by the hash of their last block and
    first characters and compared directly.
    """

    def __init__(self, patterns: dict[str, frozenset[str]]):
        self.of = patterns
        self.m = m = min(map(len, patterns), default=0)
        self.default = m - BLOCK + 1
        self.shift: dict[str, int] = {}
        self.bucket: dict[str, dict[str, list[str]]] = {}
        for p in patterns:
            for i in range(BLOCK, m + 1):
                b = p[i - BLOCK : i]
                s = m - i
                if s < self.shift.get(b, self.default):
                    self.shift[b] = s
            self.bucket.setdefault(p[m - BLOCK : m], {}).setdefault(p[:BLOCK], []).append(p)

    def search(self, text: str) -> set[str]:
        """Names of all strings that occur in ``text``."""
        m, n, out = self.m, len(text), set()
        if not m or n < m:
            return out
        get, default, end = self.shift.get, self.default, m
        while end <= n:
            s = get(text[end - BLOCK : end], default)
            if s:
                end += s
                continue
            start = end - m
            own = self.bucket.get(text[end - BLOCK : end])
            if own:
                for p in own.get(text[start : start + BLOCK], ()):
                    if text.startswith(p, start):
                        out |= self.of[p]
            end += 1
        return out


def passages(sentences: list[tuple[str, str]], n: int = WORDS) -> dict[str, frozenset[str]]:
    """All runs of ``n`` words of the sentences, with blanks at both ends."""
    found: dict[str, set[str]] = {}
    for name, text in sentences:
        w = words(text).split()
        for i in range(len(w) - n + 1):
            found.setdefault(" " + " ".join(w[i : i + n]) + " ", set()).add(name)
    return {p: frozenset(v) for p, v in found.items()}


def leaked_passages(clips: DataFrame, holdout: DataFrame, lang_reference: DataFrame, n: int = WORDS) -> DataFrame:
    """``clip_id, source_sentence_id``: train clips that hold a held-out passage.

    A passage is ``n`` consecutive words of a sentence, whatever stands between
    them that is no letter; sentences of fewer words cannot leak. One row a
    clip and sentence, though a sentence has several rows. Null and blank texts
    hold nothing; sentences without id go by their ``case_id``; garbled clips
    are left out. The held-out set is bounded by ``MAX_ITEMS`` and goes to the
    workers; clips are scanned once without shuffle, whatever their length.
    """
    rows = holdout.where("text is not null").select(F.coalesce("source_sentence_id", "case_id").alias("i"), "text").where("i is not null").distinct().limit(MAX_ITEMS + 1).collect()
    if len(rows) > MAX_ITEMS:
        raise ValueError(f"more than {MAX_ITEMS} held-out rows")
    patterns = passages(sorted((r["i"], r["text"]) for r in rows), n)
    reference = reference_texts(lang_reference)
    kept: list[WuManber] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not kept:
            kept.append(WuManber(patterns))
        search, fix = kept[0].search, repairer(reference)
        for batch in batches:
            ids, names = [], []
            for clip, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                hits = search(f" {words(text)} ")
                if hits and not fix.repair(text)[0]:
                    for name in sorted(hits):
                        ids.append(clip)
                        names.append(name)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(names, pa.string())], names=["clip_id", "source_sentence_id"])

    train = clips.where("split = 'train' and text is not null").select(F.col("clip_id").cast("bigint").alias("clip_id"), "text")
    return train.mapInArrow(run, "clip_id bigint, source_sentence_id string")
