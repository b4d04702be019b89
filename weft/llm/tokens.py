"""Encoding a corpus with a public byte-level BPE, reusing shared chunks."""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER_DIR = "/opt/tokenizers"
#: The pre-tokenizer pattern of the byte_bpe_50k vocabulary (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Between these characters the pattern always ends a piece, whatever stands
#: around them: before white space, and between letters, digits and others,
#: but not after an apostrophe, which may begin a contraction. Separators that
#: libraries class differently never count.
ODD = r"\x1c-\x1f\x85᠎​"
SAFE = (
    rf"(?<=[^\s{ODD}])(?=[ \t\n\r])"
    rf"|(?<=\p{{L}})(?=[^\s\p{{L}}{ODD}])"
    rf"|(?<=\p{{N}})(?=[^\s\p{{N}}{ODD}])"
    rf"|(?<=[^\s\p{{L}}\p{{N}}'{ODD}])(?=[\p{{L}}\p{{N}}])"
)
WINDOW = 6
MASK = 127
MAX_CACHED = 50_000


class ChunkEncoder:
    """Exact token ids by encoding content-defined chunks once.

    A chunk ends where a rolling hash of the last ``WINDOW`` characters has
    zeros under ``MASK``, so equal passages of different documents fall into
    equal chunks. Of a chunk, the part between its first and last safe boundary
    is encoded once and kept; the rest joins the neighbouring chunk's rest and
    that join is encoded anew, from safe boundary to safe boundary, where the
    ids agree with those of the whole text. A chunk without safe boundary goes
    into the join as a whole.
    """

    def __init__(self, name: str = "byte_bpe_50k", directory: str = TOKENIZER_DIR):
        import regex
        import tiktoken

        with open(Path(directory) / f"{name}.tiktoken", "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.encode = tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.first = regex.compile(SAFE)
        self.last = regex.compile(r"(?r)" + SAFE)
        self.chunks: dict[str, tuple[str, array, str] | None] = {}
        self.joins: dict[str, array] = {}

    def _chunk(self, s: str) -> tuple[str, array, str] | None:
        m = self.first.search(s)
        if m is None:
            made = None
        else:
            a, b = m.start(), self.last.search(s).start()
            made = (s[:a], array("i", self.encode(s[a:b])), s[b:])
        if len(self.chunks) >= MAX_CACHED:
            self.chunks.clear()
        self.chunks[s] = made
        return made

    def _join(self, s: str) -> array:
        ids = array("i", self.encode(s))
        if len(self.joins) >= MAX_CACHED:
            self.joins.clear()
        self.joins[s] = ids
        return ids

    def into(self, text: str, out: array) -> None:
        """Append the ids of ``text`` to ``out``."""
        if not text:
            return
        codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        cuts = [len(text)]
        if len(codes) > WINDOW:
            h = codes[WINDOW - 1 :] * np.uint32(2654435761)
            for k in range(1, WINDOW):
                h = h + codes[WINDOW - 1 - k : len(codes) - k] * np.uint32((2654435761 * 33**k + k) & 0xFFFFFFFF | 1)
            cuts = (np.flatnonzero(((h >> np.uint32(13)) & np.uint32(MASK)) == 0) + WINDOW).tolist()
            if not cuts or cuts[-1] != len(text):
                cuts.append(len(text))
        chunks, joins, pending, start = self.chunks, self.joins, "", 0
        for end in cuts:
            s = text[start:end]
            start = end
            part = chunks.get(s, 0)
            if part == 0:
                part = self._chunk(s)
            if part is None:
                pending += s
                continue
            head = pending + part[0]
            if head:
                ids = joins.get(head)
                out += self._join(head) if ids is None else ids
            out += part[1]
            pending = part[2]
        if pending:
            ids = joins.get(pending)
            out += self._join(pending) if ids is None else ids


_ENCODERS: dict[tuple[str, str], ChunkEncoder] = {}


def encoder(name: str = "byte_bpe_50k", directory: str = TOKENIZER_DIR) -> ChunkEncoder:
    """One encoder a Python worker, kept across tasks."""
    key = (name, directory)
    if key not in _ENCODERS:
        _ENCODERS[key] = ChunkEncoder(name, directory)
    return _ENCODERS[key]


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = "byte_bpe_50k", directory: str = TOKENIZER_DIR) -> DataFrame:
    """``doc_id, ids``: token ids without special tokens, one row a document.

    Null and empty texts give an empty list; strings that look like special
    tokens are ordinary text. No shuffle; only the two columns are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(name, directory)
        for batch in batches:
            out, ends = array("i"), [0]
            for text in batch.column(1).to_pylist():
                if text:
                    enc.into(text, out)
                ends.append(len(out))
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(out, dtype=np.int32) if len(out) else np.zeros(0, np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=["doc_id", "ids"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id bigint, ids array<int>")


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = "byte_bpe_50k", directory: str = TOKENIZER_DIR) -> DataFrame:
    """``doc_id, tokens``: the number of ids of each document, 0 for null and empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(name, directory)
        for batch in batches:
            sizes = []
            for text in batch.column(1).to_pylist():
                out = array("i")
                if text:
                    enc.into(text, out)
                sizes.append(len(out))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], names=["doc_id", "tokens"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id bigint, tokens bigint")
