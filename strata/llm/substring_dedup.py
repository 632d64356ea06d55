"""Removal of passages that an earlier document already has.

Every window of ``words`` consecutive words gets a rolling (Rabin-Karp)
64-bit hash.  The windows of a scan task are counted there first: of equal
windows only the document with the smallest id goes on, the others are
settled, so a passage that a third of all documents share is sent once per
task.  The rest is shuffled by hash range in packed arrays (hash, document,
word position); each range finds the smallest document of every hash and
sends the positions of repeated windows to the documents, where overlapping
windows merge into maximal intervals and their words are cut.

Two windows count as equal when their 64-bit hashes are equal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.words import word_chunks
from strata.session import ship

HOLD_WINDOWS = 2_000_000        # windows counted together in a scan task
RANGE_WINDOWS = 1_000_000       # windows a hash range is sized for
BUCKET_BYTES = 8 << 20          # text that is cut together
CHUNK = 2 << 20
PACKED = pa.schema([("range", pa.int64()), ("target", pa.int64()), ("n", pa.int64()),
                    ("hash", pa.binary()), ("place", pa.binary())])
FLAGGED = pa.schema([("target", pa.int64()), ("n", pa.int64()), ("place", pa.binary())])


def pack(doc: np.ndarray, pos: np.ndarray) -> bytes:
    """Documents and positions as differences, byte plane by byte plane."""
    import zstandard

    d = np.diff(doc, prepend=np.int64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()
    p = np.diff(pos, prepend=np.int32(0)).view(np.uint8).reshape(-1, 4).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(d + p)


def unpack(place: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    import zstandard

    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(place), np.uint8)
    d = np.ascontiguousarray(raw[:8 * n].reshape(8, n).T).view(np.int64).ravel()
    p = np.ascontiguousarray(raw[8 * n:].reshape(4, n).T).view(np.int32).ravel()
    return np.cumsum(d), np.cumsum(p, dtype=np.int32)


def runs(sorted_keys: np.ndarray) -> np.ndarray:
    """Start of each run of equal keys, and the end of the last."""
    if not len(sorted_keys):
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(sorted_keys[1:] != sorted_keys[:-1]) + 1, [len(sorted_keys)]])


def not_smallest(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by hash, and which entries in it have an equal hash in a smaller document."""
    order = np.argsort(h, kind="stable")
    cut = runs(h[order])
    if len(cut) < 2:
        return order, np.zeros(0, bool)
    sorted_doc = doc[order]
    return order, sorted_doc > np.repeat(np.minimum.reduceat(sorted_doc, cut[:-1]), np.diff(cut))


def by_target(doc: np.ndarray, pos: np.ndarray, targets: int) -> Iterator[tuple[int, int, bytes]]:
    """Packed places, one piece for each target bucket of documents."""
    target = doc % targets
    order = np.lexsort((pos, doc, target))
    doc, pos, target = doc[order], pos[order], target[order]
    cut = runs(target)
    for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist()):
        yield int(target[lo]), hi - lo, pack(doc[lo:hi], pos[lo:hi])


def count_locally(h: np.ndarray, doc: np.ndarray, pos: np.ndarray, bits: int, targets: int) -> pa.RecordBatch:
    order, later = not_smallest(h, doc)
    rows = [((t * 7919) % (1 << bits), t, n, None, place)
            for t, n, place in by_target(doc[order[later]], pos[order[later]], targets)]
    send = order[~later]
    span = h[send] >> np.uint64(64 - bits)                   # ascending, as the order is by hash
    cut = runs(span)
    drop = bits // 8
    for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist()):
        at = np.sort(send[lo:hi])                            # scan order: small differences
        rows.append((int(span[lo]), None, hi - lo,
                     np.ascontiguousarray(h[at].view(np.uint8).reshape(-1, 8)[:, :8 - drop]).tobytes(),
                     pack(doc[at], pos[at])))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), PACKED.types)], schema=PACKED)


def settle_range(table: pa.Table, drop: int, targets: int) -> pa.Table:
    """All sent windows of one hash range: the places of those that a smaller document has too."""
    out, hashes, docs, places = [], [], [], []
    for target, n, h, place in zip(*(table.column(c).to_pylist() for c in ("target", "n", "hash", "place"))):
        if h is None:
            out.append((target, n, place))
            continue
        full = np.zeros((n, 8), np.uint8)
        full[:, :8 - drop] = np.frombuffer(h, np.uint8).reshape(n, 8 - drop)
        doc, pos = unpack(place, n)
        hashes.append(full.view(np.uint64).ravel())
        docs.append(doc)
        places.append(pos)
    if hashes:
        h, doc, pos = np.concatenate(hashes), np.concatenate(docs), np.concatenate(places)
        order, later = not_smallest(h, doc)
        out.extend(by_target(doc[order[later]], pos[order[later]], targets))
    cols = list(zip(*out)) or [[], [], []]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cols, FLAGGED.types)], schema=FLAGGED)


def cut_documents(flags: pa.Table, docs: pa.Table, words: int) -> pa.Table:
    """Documents of one bucket with their flagged windows: the words that stay."""
    from itertools import compress

    found = [unpack(p, n) for p, n in zip(flags.column("place").to_pylist(), flags.column("n").to_pylist())]
    at = {}
    if found:
        doc, pos = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
        order = np.argsort(doc, kind="stable")
        doc, pos = doc[order], pos[order]
        cut = runs(doc)
        at = {int(doc[lo]): pos[lo:hi] for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist())}
    ids = docs.column("id")
    n_words, n_removed, kept, spans = [], [], [], []
    for i, text in zip(ids.to_pylist(), docs.column("text")):
        w = (text.as_py() or "").encode().split()      # exactly the bytes 0x20 and 0x09-0x0D separate
        flagged = at.get(i) if i is not None else None
        n_words.append(len(w))
        if flagged is None:
            n_removed.append(0)
            spans.append([])
            kept.append(b" ".join(w))
            continue
        step = np.zeros(len(w) + 1, np.int32)
        np.add.at(step, flagged, 1)
        np.add.at(step, flagged + words, -1)
        gone = np.cumsum(step[:-1]) > 0
        edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
        spans.append([{"start": a, "end": b} for a, b in edge.reshape(-1, 2).tolist()])
        n_removed.append(int(gone.sum()))
        kept.append(b" ".join(compress(w, (~gone).tolist())))
    return pa.table({"id": ids, "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
                     "kept_text": pa.array(kept, pa.binary()).cast(pa.string()),
                     "removed": pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))})


def prime_from(n: int) -> int:
    while any(n % p == 0 for p in range(2, int(n ** 0.5) + 1)):
        n += 1
    return n


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 13) -> DataFrame:
    """One row per input row: (id, n_words, n_removed, kept_text, removed).

    ``kept_text`` joins the words that stay by one space; ``removed`` lists
    the maximal removed intervals of word positions [start, end).  A word
    goes if a window over it also starts in a document with a smaller id;
    windows are judged on the input.  Null and empty texts have no words.
    A document with a null id is neither smaller nor larger than another:
    it stays whole.  Rows that repeat an id don't remove one another.
    Other columns are not read; an empty table gives no rows.
    """
    ship(df.sparkSession)
    docs = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(8, int(size // (6 * RANGE_WINDOWS)).bit_length())
    targets = prime_from(max(251, size // BUCKET_BYTES))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            ids = b.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            for c in word_chunks(b.column(1), CHUNK):
                h, at = c.windows(c.hashes(), words)
                owner = c.owner()[at]
                held.append((h, ids[c.low + owner], (at - c.first[owner]).astype(np.int32)))
                n += len(h)
                if n >= HOLD_WINDOWS:
                    yield count_locally(*(np.concatenate(x) for x in zip(*held)), bits, targets)
                    held, n = [], 0
        if n:
            yield count_locally(*(np.concatenate(x) for x in zip(*held)), bits, targets)

    sent = docs.where("id is not null and text is not null").mapInArrow(
        scan, "range long, target long, n long, hash binary, place binary")
    flags = sent.groupBy("range").applyInArrow(lambda t: settle_range(t, bits // 8, targets),
                                               "target long, n long, place binary")
    placed = docs.withColumn("target", F.pmod(F.coalesce("id", F.xxhash64("text")), F.lit(targets)))
    out = flags.groupBy("target").cogroup(placed.groupBy("target")).applyInArrow(
        lambda f, d: cut_documents(f, d, words),
        "id long, n_words long, n_removed long, kept_text string, removed array<struct<start:int,end:int>>")
    return out.withColumnRenamed("id", id_col)
