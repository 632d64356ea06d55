"""Periodic runs of words: a stretch that repeats itself with some period.

A run is a stretch of words whose smallest period is q, at least
max(24, 3 q) words long, that can't be extended keeping q.  Each of its words
stands in it at least three times.

Splitting.  A word that stands fewer than three times in a segment can be in
no run there, so it splits the segment; the parts are counted again, until no
segment changes; parts under 24 words are dropped.  Counting is one sort over
all segments of a chunk of texts.

Lag scan.  For lags up to 16 each surviving word is compared with the one lag
words on, and long enough stretches of equality are runs.  Longer lags are
scanned where a recurrence calls for it: for lags from Q to Q + Q // 2 =: W a
run reaches over some multiple of Q // 2 + 1 (an anchor) and W + lag words
on, and in a run the window of W words at the anchor comes back after the
period and no sooner.  So each anchor's window is compared (by rolling hash)
with the W - Q + 1 that begin there, the first match is scanned word by word
in both directions, and the next Q is W + 1: about one comparison a word and
scale, with scales growing by half, whatever the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.words import CHUNK_BYTES, SPACE, WORD_BASE, Words, buffers, inverse, powers, word_chunks
from strata.session import ship

LEAST = 24              # words of a run at least
TIMES = 3               # periods of a run at least
DENSE = 16              # lags up to here are scanned everywhere
SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def surviving(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(begin, end) of the segments that frequency splitting leaves of the
    texts ``codes[first[i]:first[i + 1]]``."""
    at = np.arange(len(codes))
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    kinds = np.int64(codes.max() + 1) if len(codes) else 1
    while len(at):
        new = np.empty(len(at), bool)
        new[0] = True
        new[1:] = (np.diff(at) != 1) | (np.diff(text[at]) != 0)
        begin = np.flatnonzero(new)
        length = np.diff(np.append(begin, len(at)))
        segment = np.repeat(np.arange(len(begin)), length)
        key = segment * kinds + codes[at]
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        edge = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        often = np.empty(len(at), bool)
        times = np.diff(np.append(edge, len(at)))
        often[order] = np.repeat(times >= TIMES, times)
        often &= np.repeat(length >= LEAST, length)
        if often.all():
            return np.stack([at[begin], at[begin] + length], 1)
        at = at[often]
    return np.empty((0, 2), np.int64)


def _stretches(equal: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the stretches of at least ``least`` true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], equal, [False]]).view(np.int8)))
    begin, end = edges[::2], edges[1::2]
    long = end - begin >= least
    return begin[long], end[long]


def _primitive(codes: np.ndarray, start: int, period: int) -> bool:
    """Whether the period's words are no shorter word repeated (the stretch
    is at least three periods long, so a smaller period divides it)."""
    rest, factor = period, 2
    while rest > 1:
        if factor * factor > rest:
            factor = rest
        if rest % factor == 0:
            q = period // factor
            if np.array_equal(codes[start:start + period], codes[start + q:start + q + period]):
                return False
            while rest % factor == 0:
                rest //= factor
        factor += 1
    return True


def _equal_words(a: np.ndarray, b: np.ndarray) -> int:
    """Words that two arrays have in common from the beginning on."""
    low, step, n = 0, 64, min(len(a), len(b))
    while low < n:
        high = min(low + step, n)
        differ = np.flatnonzero(a[low:high] != b[low:high])
        if len(differ):
            return low + int(differ[0])
        low, step = high, step * 2
    return n


def _far(codes: np.ndarray, hashes: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(begin, end, period) of the runs of one segment with a period over
    DENSE; some may come twice, some may have a smaller period."""
    n = len(codes)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * powers(WORD_BASE, n), out=sums[1:])
    back = powers(inverse(WORD_BASE), n)
    low = DENSE + 1
    while TIMES * low <= n:
        width, step = low + low // 2, low // 2 + 1
        window = (sums[width:] - sums[:-width]) * back[:n - width + 1]
        lags = width - low + 1
        # anchors with room for the window after the smallest lag; lags beyond the end match nothing
        anchors = np.arange(0, n - width - low + 1, step)
        if len(anchors):
            ahead = np.zeros(int(anchors[-1]) + width + 1, np.uint64)
            take = min(len(ahead), len(window))
            ahead[:take] = window[:take]
            known = np.zeros(len(ahead), bool)
            known[:take] = True
            view = np.lib.stride_tricks.sliding_window_view
            match = view(ahead, lags)[anchors + low] == window[anchors][:, None]
            match &= view(known, lags)[anchors + low]
            hit = match.any(1)
            done: dict[int, int] = {}
            for a, lag in zip(anchors[hit].tolist(), (match[hit].argmax(1) + low).tolist()):
                if a + width + lag <= done.get(lag, 0):
                    continue
                end = a + lag + _equal_words(codes[a:], codes[a + lag:])
                begin = a - _equal_words(codes[:a][::-1], codes[:a + lag][::-1])
                done[lag] = end
                if end - begin >= TIMES * lag:
                    yield begin, end, lag
        low = width + 1


def find_runs(codes: np.ndarray, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(begin, end, period) rows of all runs of texts, ordered by begin, then
    period; positions count through all texts."""
    segments = surviving(codes, first)
    found: set[tuple[int, int, int]] = set()
    if len(segments):
        # the segments one after another, with one place between them that equals nothing
        lengths = segments[:, 1] - segments[:, 0]
        gaps = np.cumsum(lengths + 1) - lengths - 1
        total = int(lengths.sum()) + len(lengths)
        at = np.full(total, -1, np.int64)
        inside = np.ones(total, bool)
        inside[gaps + lengths] = False
        at[inside] = np.repeat(segments[:, 0] - gaps, lengths) + np.flatnonzero(inside)
        row = np.where(inside, codes[at], -1 - np.arange(total))
        for lag in range(1, min(DENSE, total - 1) + 1):
            for b, e in zip(*_stretches(row[:-lag] == row[lag:], max(LEAST, TIMES * lag) - lag)):
                begin = int(at[b])
                if _primitive(codes, begin, lag):
                    found.add((begin, begin + int(e - b) + lag, lag))
        for low, high in segments[lengths > TIMES * DENSE].tolist():
            for begin, end, lag in _far(codes[low:high], hashes[low:high]):
                if end - begin >= LEAST and _primitive(codes[low:high], begin, lag):
                    found.add((low + begin, low + end, lag))
    rows = sorted(found, key=lambda r: (r[0], r[2]))
    return np.array(rows, np.int64).reshape(-1, 3)


def _chunks(column: pa.Array) -> Iterator[tuple[Words, np.ndarray]]:
    """Words of chunks of texts and their hashes.  A text longer than a chunk
    is read in pieces cut at white space, so that only its word positions and
    hashes (24 bytes a word) are held for it as a whole."""
    data, offsets = buffers(column)
    low, n = 0, len(offsets) - 1
    while low < n:
        high = min(max(int(np.searchsorted(offsets, offsets[low] + CHUNK_BYTES, "right")) - 1, low + 1), n)
        if high == low + 1 and offsets[high] - offsets[low] > CHUNK_BYTES:
            whole = data[offsets[low]:offsets[high]]
            starts, ends, hashes, at = [], [], [], 0
            while at < len(whole):
                cut = at + CHUNK_BYTES
                while cut < len(whole) and not SPACE[whole[cut]]:
                    space = np.flatnonzero(SPACE[whole[cut:cut + CHUNK_BYTES]])
                    cut = cut + int(space[0]) if len(space) else cut + CHUNK_BYTES
                w = next(word_chunks(pa.array([whole[at:cut].tobytes()], pa.large_binary())))
                starts.append(w.start + at)
                ends.append(w.end + at)
                hashes.append(w.hashes())
                at = cut
            start = np.concatenate(starts)
            yield (Words(low, whole, start, np.concatenate(ends), np.array([0, len(start)]), np.array([0, len(whole)])),
                   np.concatenate(hashes))
        else:
            for w in word_chunks(column.slice(low, high - low)):
                w.low += low
                yield w, w.hashes()
        low = high


def _kept_text(w: Words, kept: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one space."""
    text = w.owner()
    size = w.end - w.start
    at = np.flatnonzero(kept)
    joint = np.zeros(len(kept), bool)                     # a space after this word
    joint[at[:-1]] = text[at[:-1]] == text[at[1:]]
    edges = np.zeros(len(w.data) + 1, np.int8)
    edges[w.start[at]] = 1
    edges[w.end[at]] -= 1                                 # adjacent words are of different texts
    mask = np.cumsum(edges[:-1], dtype=np.int8).astype(bool)
    out = w.data.copy()
    spaces = w.end[joint]
    out[spaces] = 0x20
    mask[spaces] = True
    ends = np.concatenate([[0], np.cumsum(np.where(kept, size + joint, 0))])[w.first]
    return pa.LargeStringArray.from_buffers(len(w.first) - 1, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(out[mask])).cast(pa.string())


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for w, hashes in _chunks(batch.column(1)):
            codes = np.unique(hashes, return_inverse=True)[1].astype(np.int64)
            runs = find_runs(codes, hashes, w.first)
            depth = np.zeros(len(codes) + 1, np.int64)
            np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
            np.add.at(depth, runs[:, 1], -1)
            kept = np.cumsum(depth[:-1]) == 0
            text = np.searchsorted(w.first, runs[:, 0], "right") - 1
            items = pa.StructArray.from_arrays([pa.array(runs[:, 0] - w.first[text]), pa.array(runs[:, 1] - runs[:, 0]), pa.array(runs[:, 2])],
                                               ["start", "length", "period"])
            ends = np.searchsorted(text, np.arange(len(w.first)))
            yield pa.record_batch([batch.column(0).slice(w.low, len(w.first) - 1), pa.array(w.counts.astype(np.int64)),
                                   pa.ListArray.from_arrays(pa.array(ends, pa.int32()), items), _kept_text(w, kept)],
                                  ["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, collapsed), one row per input row.

    ``runs`` are structs (start word, length, period) ordered by start, then
    period; ``collapsed`` holds the words that no run contains after its first
    ``period`` words, joined by one space.  Words are runs of characters other
    than space and 0x09-0x0D; equal words are words with equal 64-bit hashes.

    Null, empty and blank texts have no words, no runs and an empty text; a
    null id stays null; repeated rows give repeated rows; an empty table gives
    no rows; other columns are not read.  A text needs memory for its bytes
    three times and some 150 bytes a word at most.
    """
    ship(df.sparkSession)
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(_collapse, SCHEMA)
