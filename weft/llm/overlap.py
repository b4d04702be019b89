"""The same or nearly the same text in evaluation and training splits."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm.letters import letters_of
from weft.session import materialise

MIN_LETTERS, PERCENT = 20, 10
#: Ratio of the lengths in a band, letters in a block of a band and in a piece that is hashed at once, and candidates handled together.
BAND, BLOCK_LETTERS, PIECE_LETTERS, MAX_PAIRS = 1.08, 48_000_000, 500_000, 100_000
#: Bits of a hashed gram in a table and in the set of all grams of a table, evaluation texts in a table, and words of a bit plane (they fit the caches).
GRAM_BITS, SET_BITS, TOGETHER, PLANE_WORDS = 14, 20, 2_048, 16_384
#: Grams of a text that are counted, the rarest first, for each 100 edits allowed, and besides.
COUNTED, SPARE = 140, 2


def allowed(longer: np.ndarray | int):
    """Edits allowed between texts of which the longer has so many letters."""
    return longer * PERCENT // 100


@lru_cache(1 << 16)
def most_edits(n: int) -> int:
    """Most edits between a text of ``n`` letters and any other."""
    longest = n
    while longest + 1 - n <= allowed(longest + 1):
        longest += 1
    return int(allowed(longest))


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    ends = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=ends[1:])
    return np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32), ends


def _runs(codes: np.ndarray, w: int, n: int) -> np.ndarray:
    """32-bit hashes of all runs of ``w`` letters, with ``n`` entries."""
    h = np.zeros(n, dtype=np.uint32)
    m = max(0, len(codes) - w + 1)
    for j in range(w):
        h[:m] *= np.uint32(0x01000193)
        h[:m] += codes[j : j + m]
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return h


def _sketch(codes: np.ndarray, ends: np.ndarray, q: int, words: int) -> np.ndarray:
    """Parity of each text's runs of ``q`` letters in ``64 * words`` buckets.

    An edit takes away at most ``q`` runs and adds at most ``q``, so the
    sketches of two texts differ in at most ``2 * q`` bits an edit: a filter
    that loses nothing.
    """
    size, out = 64 * words, []
    step = max(1, (1 << 21) // size)
    for at in range(0, len(ends) - 1, step):
        own = ends[at : at + step + 1]
        rows = len(own) - 1
        part = codes[own[0] : own[-1]]
        own = own - own[0]
        cell = np.repeat(np.arange(rows, dtype=np.int64) * size, np.diff(own))
        cell += _runs(part, q, len(part)) >> np.uint32(32 - (size.bit_length() - 1))
        for j in range(1, q):  # no run may reach into the next text
            last = own[1:] - j
            cell[last[last >= own[:-1]]] = rows * size
        odd = np.bincount(cell, minlength=rows * size + 1)[:-1].astype(np.uint8)
        odd &= 1
        out.append(np.packbits(odd.reshape(rows, size), axis=1).view(np.uint64))
    return np.concatenate(out)


def _differ(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Bits in which rows ``x`` of ``a`` and ``y`` of ``b`` differ."""
    n = np.bitwise_count(a[x] ^ b[y]).view(np.uint64)  # one byte a word, summed in 16-bit lanes
    lanes = np.uint64(0x00FF00FF00FF00FF)
    n = (n & lanes) + ((n >> np.uint64(8)) & lanes)
    if n.shape[1] > 1:
        n = n.sum(axis=1, keepdims=True)
    return ((n[:, 0] * np.uint64(0x0001000100010001)) >> np.uint64(48)).astype(np.int64)


def banded_distance(a: np.ndarray, la: np.ndarray, b: np.ndarray, lb: np.ndarray, tau: np.ndarray) -> np.ndarray:
    """Edit distances of padded rows of ``a`` and ``b``; more than ``tau`` comes out as a larger number.

    All pairs advance together through a band of ``max(tau)`` on both sides;
    a pair whose whole band exceeds its ``tau`` leaves early.
    """
    k = int(tau.max())
    n, width, big = len(a), 2 * k + 1, np.int16(k + 1)
    offs = (np.arange(width) - k).astype(np.int16)
    row = np.minimum(np.where(offs >= 0, offs, big), big).astype(np.int16)[None, :].repeat(n, 0)
    out = np.full(n, k + 1, dtype=np.int32)
    slope = np.arange(width, dtype=np.int16)[None, :]
    rows = np.arange(n)
    wide = np.concatenate([np.full((n, k), 0xFFFFFFFF, dtype=np.uint32), b, np.full((n, k + a.shape[1] + 1), 0xFFFFFFFE, dtype=np.uint32)], axis=1)
    for i in range(1, a.shape[1] + 1):
        diag = row + (wide[:, i - 1 : i - 1 + width] != a[:, i - 1 : i])  # b[j - 1] for j = i + offs
        np.minimum(diag[:, :-1], row[:, 1:] + np.int16(1), out=diag[:, :-1])
        if i <= k:
            diag[:, : k - i] = big
            diag[:, k - i] = i
        diag -= slope
        np.minimum.accumulate(diag, axis=1, out=diag)
        diag += slope
        row = np.minimum(diag, big)
        done = la == i
        if done.any():
            at = lb[done] - i + k
            ok = (at >= 0) & (at < width)
            out[rows[done][ok]] = row[done][ok, at[ok]]
        if i % 12 == 0:
            live = (la > i) & (row.min(axis=1) <= tau)
            if not live.all():
                if not live.any():
                    break
                row, wide, a, la, lb, tau, rows = row[live], wide[live], a[live], la[live], lb[live], tau[live], rows[live]
    return out


def _gram(n: int) -> int:
    """Letters of a gram for texts of about ``n`` letters: ``n // gram`` exceeds the edits allowed by enough to tell texts apart."""
    return 4 if n < 150 else 5


def _pieces(texts: list[str]) -> Iterator[list[str]]:
    size, start = 0, 0
    for stop, text in enumerate(texts, 1):
        size += len(text)
        if size >= PIECE_LETTERS or stop == len(texts):
            yield texts[start:stop]
            size, start = 0, stop


def _rows(hashes: np.ndarray, cell: np.ndarray) -> np.ndarray:
    """Rows of a table for grams that stand in a cell."""
    h = cell.astype(np.uint32) * np.uint32(0x9E3779B1)
    h ^= hashes
    h *= np.uint32(0x85EBCA6B)
    return h >> np.uint32(32 - GRAM_BITS)


class Grams:
    """Texts in the order of their lengths, and of each the rarest of the grams that stand side by side, as hashes and table rows."""

    def __init__(self, texts: list[str], q: int, width: int, often: np.ndarray):
        self.order = np.argsort([len(t) for t in texts], kind="stable")
        hashes, rows, lengths, counts, least = [], [], [], [], []
        for piece in _pieces([texts[i] for i in self.order.tolist()]):
            codes, ends = _codes(piece)
            n = np.diff(ends)
            sizes = {m: most_edits(m) for m in np.unique(n).tolist()}
            edits = np.array([sizes[m] for m in n.tolist()])
            g = n // q
            owner, first = np.repeat(np.arange(len(n)), g), np.cumsum(g) - g
            inside = (np.arange(len(owner)) - first[owner]) * q
            h = _runs(codes, q, len(codes))[ends[owner] + inside]
            rarest = np.argsort((owner << 32) + often[h >> np.uint32(32 - SET_BITS)])
            used = np.minimum(g, edits * COUNTED // 100 + SPARE)
            rarest = rarest[np.arange(len(owner)) - first[owner] < used[owner]]
            hashes.append(h[rarest])
            rows.append(_rows(hashes[-1], inside[rarest] // width).astype(np.uint16))
            lengths.append(n)
            counts.append(used)
            least.append(np.maximum(0, used - edits))
        self.hashes, self.rows, self.length, self.count, self.least = map(np.concatenate, (hashes, rows, lengths, counts, least))
        self.start = np.cumsum(self.count) - self.count


def _often(texts: list[str], q: int) -> np.ndarray:
    """How often grams of each hash occur."""
    out = np.zeros(1 << SET_BITS, dtype=np.int64)
    for piece in _pieces(texts):
        codes, _ = _codes(piece)
        out += np.bincount(_runs(codes, q, len(codes)) >> np.uint32(32 - SET_BITS), minlength=1 << SET_BITS)
    return out


def _shares(texts: list[str]) -> np.ndarray:
    """Shares of the letters in each text, by their last six bits."""
    codes, ends = _codes(texts)
    cell = np.repeat(np.arange(len(texts)) * 64, np.diff(ends)) + (codes & np.uint32(63))
    return (np.bincount(cell, minlength=len(texts) * 64).reshape(-1, 64) / np.diff(ends)[:, None]).astype(np.float32)


def _alike(texts: list[str]) -> list[np.ndarray]:
    """The indexes of the texts in groups of like letters (mostly a language each), of like lengths, for one table each."""
    length = np.array([len(t) for t in texts])
    group, k = np.zeros(len(texts), dtype=np.int64), min(32, len(texts) // 256)
    if k > 1:
        some = np.concatenate([_shares(piece) for piece in _pieces(texts[:: max(1, len(texts) // 4_000)])])
        mean = some.mean(axis=0, keepdims=True)
        apart = lambda x: (x**2).sum(axis=1)[:, None] + (mean**2).sum(axis=1) - 2 * np.einsum("ij,kj->ik", x, mean)
        while len(mean) < k:
            mean = np.concatenate([mean, some[[apart(some).min(axis=1).argmax()]]])
        for _ in range(8):
            own = apart(some).argmin(axis=1)
            mean = np.stack([some[own == i].mean(axis=0) if (own == i).any() else mean[i] for i in range(k)])
        group = np.concatenate([apart(_shares(piece)).argmin(axis=1) for piece in _pieces(texts)])
    order = np.lexsort((length, group))
    return [part[at : at + TOGETHER] for part in np.split(order, np.flatnonzero(np.diff(group[order])) + 1) for at in range(0, len(part), TOGETHER)]


class SharedGrams:
    """Counts which grams of a text occur in each of many evaluation texts.

    A text is cut into grams side by side. An edit breaks at most one of them, so of
    any ``g`` of them at least ``g`` less the edits allowed occur in a near text, at most
    those edits off their place: a filter that loses nothing. For each hashed gram and cell
    of ``width`` letters there is a row of bits, one for each evaluation text that
    has it there or as far off as edits can move it. The rows of a text's grams are
    added up bit by bit, 64 evaluation texts in a word, so the cost of a pair is the
    same whether the texts share stock phrases or not. Texts of which too few grams
    occur in any of the evaluation texts, or whose length fits none, are left out before.
    """

    def __init__(self, texts: list[str], q: int, width: int):
        self.count, words = len(texts), -(-len(texts) // 64)
        self.table = np.zeros(((1 << GRAM_BITS) + 1, words), dtype=np.uint64)  # the last row is of no gram
        self.any = np.zeros(1 << SET_BITS, dtype=bool)
        lengths = [len(t) for t in texts]
        self.shortest, self.longest = min(lengths), max(lengths)
        for at in range(0, len(texts), 1_024):
            codes, ends = _codes(texts[at : at + 1_024])
            rows = len(ends) - 1
            n = np.diff(ends).astype(np.int32)
            flags = np.zeros((1 << GRAM_BITS, -(-rows // 64) * 64), dtype=bool)
            owner = np.repeat(np.arange(rows, dtype=np.int32), n)
            place = np.arange(len(codes), dtype=np.int32) - ends[:-1].astype(np.int32)[owner]
            inside = np.flatnonzero(place + q <= n[owner])
            hashes, owner, place = _runs(codes, q, len(codes))[inside], owner[inside], place[inside]
            off = np.array([most_edits(x) for x in n.tolist()], dtype=np.int32)[owner]
            cell, last = np.maximum(0, place - off) // width, (place + off) // width
            self.any[hashes >> np.uint32(32 - SET_BITS)] = True
            while len(cell):
                flags.reshape(-1)[_rows(hashes, cell) * np.uint32(flags.shape[1]) + owner.view(np.uint32)] = True
                more = np.flatnonzero(cell < last)
                hashes, owner, cell, last = hashes[more], owner[more], cell[more] + 1, last[more]
            self.table[:-1, at // 64 : at // 64 + flags.shape[1] // 64] = np.packbits(flags, axis=1, bitorder="little").view(np.uint64)

    def candidates(self, grams: Grams) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Indexes of evaluation and other texts that share enough grams; in pieces."""
        first, last = np.searchsorted(grams.length, [-(-self.shortest * (100 - PERCENT) // 100), self.longest * 100 // (100 - PERCENT) + 1])
        if first == last:
            return
        begin = grams.start[first]
        there = self.any[grams.hashes[begin : grams.start[last - 1] + grams.count[last - 1]] >> np.uint32(32 - SET_BITS)]
        enough = np.add.reduceat(there, grams.start[first:last] - begin, dtype=np.int64) >= grams.least[first:last]
        texts, step = first + np.flatnonzero(enough), max(1, PLANE_WORDS // self.table.shape[1])
        for at in range(0, len(texts), step):
            own = texts[at : at + step]
            nth = np.arange(int(grams.count[own].max()))[:, None]
            spot = np.minimum(grams.start[own] + nth, len(grams.rows) - 1)
            rows = np.where(nth < grams.count[own], grams.rows[spot], 1 << GRAM_BITS)
            reached = self._reached(rows, grams.least[own])
            y, word = np.nonzero(reached)
            bit = np.flatnonzero(np.unpackbits(reached[y, word].view(np.uint8), bitorder="little"))
            e = word[bit >> 6] * 64 + (bit & 63)
            real = e < self.count
            yield e[real], grams.order[own[y[bit >> 6]][real]]

    def _reached(self, rows: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Bits of the evaluation texts that have at least ``least[i]`` of the grams ``rows[:, i]``."""
        shape = (rows.shape[1], self.table.shape[1])
        top = int(least.max()).bit_length()  # a count begins so that it passes 2 ** top when enough are there
        levels: list[list[np.ndarray]] = [[] for _ in range(top)]
        over, free = np.zeros(shape, dtype=np.uint64), []
        start = (1 << top) - least
        over[start >= 1 << top] = ~np.uint64(0)
        for j in range(top):
            levels[j].append(np.where((start >> j & 1).astype(bool)[:, None], ~np.uint64(0), np.uint64(0)).repeat(shape[1], axis=1))

        def carry(j: int, x: np.ndarray) -> None:
            if j < top:
                levels[j].append(x)
            else:
                np.bitwise_or(over, x, out=over)
                free.append(x)

        def add(j: int) -> None:
            while j < top and len(levels[j]) > 2:
                a, b, c = levels[j]
                t = free.pop() if free else np.empty(shape, dtype=np.uint64)
                np.bitwise_xor(a, b, out=t)
                np.bitwise_and(a, b, out=a)
                np.bitwise_xor(t, c, out=b)
                np.bitwise_and(t, c, out=t)
                np.bitwise_or(a, t, out=a)
                levels[j] = [b]
                free.extend((t, c))
                carry(j + 1, a)
                j += 1

        for row in rows if top else ():
            levels[0].append(self.table.take(row, axis=0, out=free.pop() if free else np.empty(shape, dtype=np.uint64), mode="clip"))
            add(0)
        for j in range(top):
            add(j)
            if len(levels[j]) == 2:
                carry(j + 1, np.bitwise_and(*levels[j]))
        return over


def segment_join(eval_texts: list[str], train_texts: list[str]) -> list[tuple[int, int, int]]:
    """``(eval index, train index, distance)`` of all pairs within the allowed edits.

    Candidates share enough grams and pass filters that lose nothing (lengths,
    sketches of runs of letters); they are verified by banded dynamic
    programming. Both sides are taken in pieces of bounded size.
    """
    out: list[tuple[int, int, int]] = []
    if not eval_texts or not train_texts:
        return out
    longest = max(map(len, train_texts))
    q, width = _gram(longest), most_edits(longest) + 1
    grams, found, n = Grams(train_texts, q, width, _often(eval_texts, q)), [], 0
    words = 1 << min(9, max(3, (max(longest, *map(len, eval_texts)) // 16).bit_length()))  # 4 to 8 bits a letter of the longest text
    held, train = _Sketches(eval_texts, words), _Sketches(train_texts, words)
    for own in _alike(eval_texts):
        for e, t in SharedGrams([eval_texts[i] for i in own.tolist()], q, width).candidates(grams):
            found.append((own[e], t))
            n += len(e)
            if n >= MAX_PAIRS:
                out += _near(held, train, found)
                found, n = [], 0
    return out + _near(held, train, found)


class _Sketches:
    """Texts and their sketches, made when they are first asked for."""

    def __init__(self, texts: list[str], words: int):
        self.texts, self.length = texts, np.array([len(t) for t in texts])
        self.sketch, self.made = np.empty((len(texts), words), dtype=np.uint64), np.zeros(len(texts), dtype=bool)

    def of(self, own: np.ndarray) -> np.ndarray:
        new = np.zeros(len(self.texts), dtype=bool)
        new[own] = True
        new = np.flatnonzero(new & ~self.made)
        if len(new):
            self.sketch[new] = _sketch(*_codes([self.texts[i] for i in new.tolist()]), 4, self.sketch.shape[1])
            self.made[new] = True
        return self.sketch


def _near(held: _Sketches, train: _Sketches, found: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int, int]]:
    out: list[tuple[int, int, int]] = []
    if not found:
        return out
    e, t = (np.concatenate(x) for x in zip(*found))
    el, tl = held.length, train.length
    tau = allowed(np.maximum(el[e], tl[t]))
    ok = np.flatnonzero(np.abs(el[e] - tl[t]) <= tau)
    e, t, tau = e[ok], t[ok], tau[ok]
    a, b, kept = held.of(e), train.of(t), [ok[:0]]
    step = max(1, 480_000 // a.shape[1])
    for at in range(0, len(e), step):
        some = slice(at, at + step)
        kept.append(at + np.flatnonzero(_differ(a, e[some], b, t[some]) <= 8 * tau[some]))
    ok = np.concatenate(kept)
    e, t = e[ok], t[ok]
    order = np.argsort(el[e], kind="stable")
    e, t = e[order], t[order]
    at = 0
    while at < len(e):
        longest = int(max(el[e[at]], tl[t[at]]))
        step = max(1, min(2_000, 4_000_000 // max(1, longest * 3)))
        x, y = e[at : at + step], t[at : at + step]
        tau = allowed(np.maximum(el[x], tl[y]))
        a, b = np.zeros((len(x), int(el[x].max())), np.uint32), np.zeros((len(y), int(tl[y].max())), np.uint32)
        for r, (i, j) in enumerate(zip(x.tolist(), y.tolist())):
            a[r, : el[i]] = np.frombuffer(held.texts[i].encode("utf-32-le"), dtype=np.uint32)
            b[r, : tl[j]] = np.frombuffer(train.texts[j].encode("utf-32-le"), dtype=np.uint32)
        d = banded_distance(a, el[x], b, tl[y], tau)
        good = d <= tau
        out += zip(x[good].tolist(), y[good].tolist(), d[good].tolist())
        at += step
    return out


def _band(c):
    return F.floor(F.log(F.greatest(c, F.lit(MIN_LETTERS)) / F.lit(float(MIN_LETTERS))) / F.lit(math.log(BAND)) + F.lit(1e-9)).cast("int")


def kinds(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Each text's kind by its letters (0 Thai, 1 Han, 2 other letters beyond ASCII, 3 ASCII), and a bit for each kind its near texts may have.

    An edit moves twice a script's letters less all letters by at most 2, and
    100 times the marked letters less 13 times all letters by at most 100.
    """
    kind, near = np.full(len(texts), 3, np.int32), np.full(len(texts), 8, np.int32)
    high = [i for i, t in enumerate(texts) if not t.isascii()]  # most_edits(n) < 0.13 * n, so near texts of ASCII ones are of their kind
    kind[high], near[high] = _kinds([texts[i] for i in high])
    return kind, near


def _kinds(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    codes, ends = _codes(texts)
    n = np.diff(ends)
    edits = {m: most_edits(m) for m in np.unique(n).tolist()}
    k = np.array([edits[m] for m in n.tolist()], dtype=np.int64)

    def count(flag: np.ndarray) -> np.ndarray:
        return np.add.reduceat(flag, ends[:-1], dtype=np.int64) if len(n) else n

    thai, han = 2 * count((codes >= 0xE00) & (codes < 0xE80)) - n, 2 * count((codes >= 0x3400) & (codes < 0xA000)) - n
    marked = 100 * count(codes > 127) - 13 * n
    kind = np.where(thai > 0, 0, np.where(han > 0, 1, np.where(marked > 0, 2, 3)))
    sure = [thai - 2 * k > 0, han - 2 * k > 0, marked - 100 * k > 0]
    may = [thai + 2 * k > 0, (han + 2 * k > 0) & ~sure[0], (marked + 100 * k > 0) & ~sure[0] & ~sure[1], ~sure[0] & ~sure[1] & ~sure[2]]
    return kind.astype(np.int32), sum(m.astype(np.int32) << i for i, m in enumerate(may))


class CrossSplit:
    """Near pairs of texts between evaluation and training clips.

    Texts are reduced to letters; those of fewer than 20 take no part, nor do
    clips without text or split. Equal texts become one text of two 64-bit
    hashes, so copies cost one comparison. A training text goes to one cell, of
    its kind of letters and band of lengths; an evaluation text, of which there
    are fewer, to each cell where its near texts can be (about four). Cells are cut
    into blocks of bounded letters; each pair of an evaluation and a training
    block of a cell is joined in one task, whose size does not grow with the data or with
    a hot length. Empty tables give no pairs.
    """

    def __init__(self, clips: DataFrame):
        spark = clips.sparkSession

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own = letters_of(batch.column(1).to_pylist())
                keep = [i for i, t in enumerate(own) if len(t) >= MIN_LETTERS]
                own, rest = [own[i] for i in keep], batch.take(pa.array(keep, pa.int64()))
                kind, near = kinds(own)
                yield pa.RecordBatch.from_arrays([rest.column(0), pa.array(own, pa.string()), rest.column(2), rest.column(3), pa.array(kind), pa.array(near)], names=["clip_id", "letters", "split", "source_id", "kind", "near"])

        used = clips.where("text is not null and split in ('train', 'val', 'test')").select(F.col("clip_id").cast("bigint").alias("clip_id"), "text", F.col("split").cast("string").alias("split"), F.col("source_id").cast("string").alias("source_id"))
        norm = used.mapInArrow(run, "clip_id bigint, letters string, split string, source_id string, kind int, near int")
        norm = norm.withColumn("h1", F.xxhash64("letters")).withColumn("h2", F.xxhash64(F.lit("weft"), "letters"))
        norm = materialise(norm, "overlap-letters")
        self.members = norm.select("h1", "h2", "clip_id", "split", "source_id")
        is_train = F.col("split") == "train"
        texts = norm.groupBy("h1", "h2").agg(F.first(F.struct("letters", "kind", "near")).alias("x"), F.max(is_train).alias("train"), F.max(~is_train).alias("held")).select("h1", "h2", "x.*", "train", "held", F.length("x.letters").alias("n"))
        texts = materialise(texts, "overlap-texts")
        lo, hi = F.greatest(F.ceil(F.col("n") * (100 - PERCENT) / 100), F.lit(MIN_LETTERS)), F.floor(F.col("n") * 100 / (100 - PERCENT))
        train = texts.where("train").withColumn("band", _band(F.col("n")))
        may = F.filter(F.array(*[F.lit(i) for i in range(4)]), lambda i: F.expr("near").bitwiseAND(F.call_function("shiftleft", F.lit(1), i)) != 0)
        held = texts.where("held").withColumn("kind", F.explode(may)).withColumn("band", F.explode(F.sequence(_band(lo), _band(hi))))
        cell = ["kind", "band"]
        sized = held.groupBy(cell).agg(F.sum("n").alias("e")).join(train.groupBy(cell).agg(F.sum("n").alias("t")), cell).collect()  # a row a cell: four kinds, a band each 8 % of length
        cells, blocks = [], 0
        for r in sorted(sized):
            ne, nt = -(-r["e"] // BLOCK_LETTERS), -(-r["t"] // BLOCK_LETTERS)
            cells.append((r["kind"], r["band"], ne, nt, blocks))
            blocks += ne * nt
        cells = F.broadcast(spark.createDataFrame(cells, "kind int, band int, ne bigint, nt bigint, base bigint"))
        all_of = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
        held = held.join(cells, cell).withColumn("eb", F.pmod(F.col("h1"), F.col("ne"))).withColumn("tb", all_of("nt"))
        train = train.join(cells, cell).withColumn("tb", F.pmod(F.col("h1"), F.col("nt"))).withColumn("eb", all_of("ne"))
        cols = [(F.col("base") + F.col("eb") * F.col("nt") + F.col("tb")).alias("block"), "h1", "h2", "letters"]
        work = held.select(*cols, F.lit(True).alias("is_held")).unionByName(train.select(*cols, F.lit(False).alias("is_held")))

        def join(group: pa.Table) -> pa.Table:
            flag = np.array(group.column("is_held").to_pylist(), dtype=bool)
            text, h1, h2 = group.column("letters").to_pylist(), group.column("h1").to_numpy(), group.column("h2").to_numpy()
            e, t = np.flatnonzero(flag), np.flatnonzero(~flag)
            hits = segment_join([text[i] for i in e], [text[i] for i in t])
            x, y = e[[h[0] for h in hits]] if hits else e[:0], t[[h[1] for h in hits]] if hits else t[:0]
            return pa.table({"e1": h1[x], "e2": h2[x], "t1": h1[y], "t2": h2[y], "edits": pa.array([h[2] for h in hits], pa.int32())})

        # a few partitions a block, at most some thousands: adaptive execution would merge them by bytes, not by work
        work = work.repartition(max(1, min(4096, 4 * blocks)), "block")
        self.pairs = materialise(work.groupBy("block").applyInArrow(join, "e1 bigint, e2 bigint, t1 bigint, t2 bigint, edits int"), "overlap-pairs")

    def clip_pairs(self) -> DataFrame:
        """``clip_id_a, clip_id_b`` (smaller first), edits, and split and source of both sides."""
        e = self.members.where("split <> 'train'").select(F.col("h1").alias("e1"), F.col("h2").alias("e2"), F.col("clip_id").alias("held_id"), F.col("split"), F.col("source_id").alias("held_source"))
        t = self.members.where("split = 'train'").select(F.col("h1").alias("t1"), F.col("h2").alias("t2"), F.col("clip_id").alias("train_id"), F.col("source_id").alias("train_source"))
        both = self.pairs.join(e, ["e1", "e2"]).join(t, ["t1", "t2"])
        return both.select(F.least("held_id", "train_id").alias("clip_id_a"), F.greatest("held_id", "train_id").alias("clip_id_b"), "edits", "split", "held_source", "train_source")

    def report(self) -> DataFrame:
        """Pairs and held-out clips concerned, per split and source of the held-out clip."""
        # counted from text pairs and member counts: copies are not expanded
        t = self.members.where("split = 'train'").groupBy(F.col("h1").alias("t1"), F.col("h2").alias("t2")).agg(F.count("*").alias("nt"))
        per = self.pairs.join(t, ["t1", "t2"]).groupBy("e1", "e2").agg(F.sum("nt").alias("pairs"), F.sum(F.when(F.col("edits") == 0, F.col("nt")).otherwise(0)).alias("same"))
        e = self.members.where("split <> 'train'").select(F.col("h1").alias("e1"), F.col("h2").alias("e2"), "split", "source_id")
        return e.join(per, ["e1", "e2"]).groupBy("split", "source_id").agg(F.count("*").alias("held_clips"), F.sum("pairs").alias("pairs"), F.sum("same").alias("same_text_pairs"))
