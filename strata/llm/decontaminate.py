"""Benchmark items inside documents: size-partitioned MinHash containment search.

Items are partitioned by the size of their shingle set (classes of up to
1, 2, 4, 8 ... shingles).  For a class of up to s shingles every document is
cut into windows of 2 s shingles that start every s, so an item of the class
that a document holds lies inside one window, and a window that holds 80 %
of it has a Jaccard similarity of at least 0.19 with it, however long the
document is.  Each of PERMUTATIONS minimum hashes is a band of its own: one
equal minimum makes a candidate, and 0.81^64 (about 1 in 700,000) bounds the
chance that a contained item has none.  Candidates are verified by the exact
containment of the item's shingles in the whole document.

Only items' band keys, as a Bloom filter of fixed size, go to every task;
the keys themselves meet in a join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.words import mix, word_chunks
from strata.llm.worker import begin, give_back
from strata.session import materialize, ship, small_batches

SHINGLE = 5
PERCENT = 80
PERMUTATIONS = 64
BLOOM_BITS = 24                 # a fixed 2 MB filter for keys and one for shingles
ITEM_TASKS = 16
CHUNK = 1 << 18                 # bytes of text that a worker takes apart at once


def permutations() -> tuple[np.ndarray, np.ndarray]:
    k = mix(np.arange(1, 2 * PERMUTATIONS + 1, dtype=np.uint64))
    return (k[::2] | np.uint64(1)).astype(np.uint32), k[1::2].astype(np.uint32)


def band_keys(minimum: np.ndarray, band: int, size_class: int) -> np.ndarray:
    return mix(minimum.astype(np.uint64) | np.uint64((band << 8 | size_class) << 32))


def bloom_places(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << BLOOM_BITS) - 1)
    return (keys & mask).astype(np.int64), ((keys >> np.uint64(32)) & mask).astype(np.int64)


class Bloom:
    def __init__(self, packed: bytes):
        self.bytes = np.frombuffer(packed, np.uint8)

    def has(self, places: np.ndarray) -> np.ndarray:
        return (self.bytes[places >> 3] << (places & 7).astype(np.uint8)) > 127

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        a, b = bloom_places(keys)
        found = self.has(a)
        at = np.flatnonzero(found)
        found[at] = self.has(b[at])
        return found


def size_class(n: np.ndarray) -> np.ndarray:
    """0 for one shingle, else the class of up to 2^class shingles."""
    return np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64)


def item_sets(items: DataFrame, k: int) -> DataFrame:
    """(item, class, shingles, keys) for every distinct item text with words."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, c = permutations()
        for b in batches:
            rows = []
            for w in word_chunks(b.column(1)):
                s, owner = w.shingles(w.hashes(lower=True), k)
                for i in np.unique(owner).tolist():
                    own = np.unique(s[owner == i])
                    cls = int(size_class(np.array([len(own)]))[0])
                    low = own.astype(np.uint32)
                    keys = [int(band_keys((low * a[j] + c[j]).min(keepdims=True), j, cls).view(np.int64)[0]) for j in range(len(a))]
                    rows.append((b.column(0)[w.low + i].as_py(), cls, own.view(np.int64).tolist(), keys))
            cols = list(zip(*rows)) or [[]] * 4
            types = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, types)], ["item", "class", "shingles", "keys"])

    return materialize(items.select("item", "text").dropDuplicates(["item"])
                       .mapInArrow(each, "item long, class int, shingles array<long>, keys array<long>"), "items")


def bloom_of(values: DataFrame, scatter: bool = False) -> bytes:
    """The filter of a long column, as at most ITEM_TASKS filters of fixed
    size.  ``scatter`` mixes the values' bits first, for keys that aren't hashes."""
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << BLOOM_BITS, bool)
        for b in batches:
            keys = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for place in bloom_places(mix(keys) if scatter else keys):
                bits[place] = True
        packed = np.packbits(bits).tobytes()
        del bits                        # the worker may rest after this
        give_back()
        yield pa.record_batch([pa.array([packed], pa.binary())], ["bits"])

    out = np.zeros(1 << BLOOM_BITS >> 3, np.uint8)
    for row in values.coalesce(ITEM_TASKS).mapInArrow(fill, "bits binary").collect():
        out |= np.frombuffer(row.bits, np.uint8)
    return out.tobytes()


def window_hits(s: np.ndarray, owner: np.ndarray, classes: list[int], bloom: Bloom) -> tuple[np.ndarray, np.ndarray]:
    """(owner, key) of the windows' band keys that may be an item's."""
    a, c = permutations()
    low = s.astype(np.uint32)
    first = np.concatenate([[0], np.flatnonzero(np.diff(owner)) + 1])
    size = np.diff(np.concatenate([first, [len(owner)]]))
    plans = []
    for cls in classes:
        blocks = (size + (1 << cls) - 1) >> cls
        begin = np.repeat(first, blocks) + ((np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)) << cls)
        plans.append((cls, begin, owner[begin]))
    owners, keys = [], []
    for j in range(PERMUTATIONS):
        value = low * a[j]
        value += c[j]
        for cls, begin, own in plans:
            least = np.minimum.reduceat(value, begin)
            least[:-1] = np.where(own[:-1] == own[1:], np.minimum(least[:-1], least[1:]), least[:-1])
            key = band_keys(least, j, cls)
            hit = np.flatnonzero(bloom(key))
            if len(hit):
                owners.append(own[hit])
                keys.append(key[hit])
    if not keys:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(owners), np.concatenate(keys)


def leaks(docs: DataFrame, items: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(text_key, item, containment) for every document text (by ``text_key``)
    and item (by its text's hash) with a containment of percent / 100 or more."""
    ship(docs.sparkSession)
    sets = item_sets(items, k)
    classes = sorted(r["class"] for r in sets.select("class").distinct().collect())       # at most 64
    blooms = docs.sparkSession.sparkContext.broadcast(
        (bloom_of(sets.select(F.explode("keys"))), bloom_of(sets.select(F.explode("shingles")))))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("decontaminate")
        key_bloom, shingle_bloom = map(Bloom, blooms.value)
        for b in batches:
            for w in word_chunks(b.column(1), CHUNK):
                s, owner = w.shingles(w.hashes(lower=True), k)
                if not len(s) or not classes:
                    continue
                own, keys = window_hits(s, owner, classes, key_bloom)
                if not len(own):
                    continue
                some = shingle_bloom(s) & np.isin(owner, own)
                held_s, held_o = s[some].view(np.int64), owner[some]
                rows = [(b.column(0)[w.low + i].as_py(), np.unique(keys[own == i]).view(np.int64).tolist(),
                         np.unique(held_s[held_o == i]).tolist()) for i in np.unique(own).tolist()]
                types = [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], ["text_key", "keys", "held"])
            give_back()

    with small_batches(docs.sparkSession):
        hits = materialize(docs.select("text_key", "text").where("text is not null")
                           .mapInArrow(scan, "text_key string, keys array<long>, held array<long>").dropDuplicates(["text_key"]), "hits")
    pairs = (hits.select("text_key", F.explode("keys").alias("key"))
             .join(sets.select("item", F.explode("keys").alias("key")), "key").select("text_key", "item").distinct())
    common = F.size(F.array_intersect("held", "shingles"))
    return (pairs.join(hits.select("text_key", "held"), "text_key").join(sets.select("item", "shingles"), "item")
            .where(100 * common >= percent * F.size("shingles"))
            .select("text_key", "item", (common / F.size("shingles")).alias("containment")))


def contamination(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(id, contaminated, n_items, items, containment), one row per input row.

    Words are runs of bytes other than space and 0x09-0x0D, A-Z lower-cased;
    a set holds the distinct shingles of k words, or the whole sequence of a
    shorter text.  An item leaks into a document that holds percent / 100 of
    its shingles or more; ``items`` lists the ids of such items in order,
    ``containment`` is the largest share (null if none).  Documents and items
    without words neither leak nor are leaked into; rows with equal texts,
    whatever their ids, get the same answer; ids may be null or repeat.
    Other columns are not read.
    """
    docs = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).withColumn("text_key", F.md5("text"))
    items = benchmark.select(F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{item_text_col}`").alias("text")).withColumn("item", F.xxhash64("text"))
    found = leaks(docs, items, k, percent)
    by_text = (found.join(items.select("item", "item_id").distinct(), "item").groupBy("text_key")
               .agg(F.sort_array(F.collect_set("item_id")).alias("items"), F.countDistinct("item").alias("n_items"),
                    F.max("containment").alias("containment")))
    return (docs.select("id", "text_key").join(by_text, "text_key", "left")
            .select(F.col("id").alias(id_col), F.col("n_items").isNotNull().alias("contaminated"),
                    F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), "items", "containment"))


def clean(df: DataFrame, benchmark: DataFrame, text_col: str = "text", item_text_col: str = "text",
          k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``df`` that no item leaks into, with all their columns."""
    docs = df.select(F.md5(f"`{text_col}`").alias("text_key"), F.col(f"`{text_col}`").alias("text"))
    items = benchmark.select(F.xxhash64(f"`{item_text_col}`").alias("item"), F.col(f"`{item_text_col}`").alias("text"))
    found = leaks(docs, items, k, percent).select("text_key").distinct()
    rows = df.select(F.struct("*").alias("row"), F.md5(f"`{text_col}`").alias("text_key"))
    return rows.join(found, "text_key", "left_anti").select("row.*")
