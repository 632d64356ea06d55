"""Byte-pair encoding and decoding as streaming transducers.

Encoding.  Merges are applied lowest rank first, leftmost first.  Whatever
follows a known prefix can only change its tokens from right to left: the
first unknown symbol may take part in a merge (u, v) at its left, which
changes u; the symbol run that begins with u may then take part in a merge
(u2, v2) of a higher rank, where u is v2 or the first part of v2, of that
part's first part and so on; and so forth.  Ranks rise along such a chain, so
the longest one has a bounded length, and the symbols of its left parts are
the merge list's *sufficient lookahead*: tokens that end at least that many
symbols before the unknown are stable.  ``Merges.lookahead`` is the longest
chain, from one pass over the rules by falling rank.  ``Merges.stream`` reads
symbols, merges a window of fixed size, emits the stable tokens and goes on
behind them, so memory does not grow with a pre-token, and cost is linear.

Decoding.  Ids become bytes by a table; ``ByteText`` turns any cut of the
bytes into text, holding back at most one unfinished character.

Normalizer and pre-tokenizer are the tokenizer's own (an ASCII pre-token of a
known pattern is cut here); merges, window and decoding are this module's.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import os
import re
from collections.abc import Iterable, Iterator
from itertools import islice, repeat
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.units import Encoder, UnitCache, byte_letters
from strata.llm.worker import kept
from strata.session import ship

WINDOW = 4096           # symbols merged at once, beside the lookahead
SLICE_BYTES = 4 << 20   # text bytes an output batch is made of (a longer text is a batch of its own)
IDS_AT_ONCE = 1 << 16   # ids whose bytes are put together at once in decoding


class Merges:
    """The merge rules of a byte-pair tokenizer file's model."""

    def __init__(self, model: dict):
        if model["type"] != "BPE" or model.get("dropout") or model.get("continuing_subword_prefix") or model.get("ignore_merges"):
            raise ValueError("not a plain byte-pair model")
        vocab, self.suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        self.inner = {t: i for t, i in vocab.items() if len(t) == 1}
        cut = len(self.suffix)
        self.last = {t[:-cut]: i for t, i in vocab.items() if len(t) == cut + 1 and t.endswith(self.suffix)} if cut else self.inner
        self.rules: dict[tuple[int, int], tuple[int, int]] = {}
        self.ranks: dict[tuple[int, int], int] = {}     # the same as numbers: the least is found sooner
        self.made: list[int] = []                       # rank -> token
        self.size = {i: 1 for i in (*self.inner.values(), *self.last.values())}
        parts = []
        for rank, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            u, v, w = vocab[a], vocab[b], vocab[a + b]
            if u not in self.size or v not in self.size or w in self.size:
                raise ValueError("a merge uses a token that no earlier merge makes, or makes one again")
            self.size[w] = self.size[u] + self.size[v]
            self.rules[u, v] = rank, w
            self.ranks[u, v] = rank
            self.made.append(w)
            parts.append((u, v, w))
        self.lookahead = self._lookahead(parts)

    def _lookahead(self, parts: list[tuple[int, int, int]]) -> int:
        """Symbols of the left parts on the longest chain of rules with rising
        ranks, each rule's left part being a first part of the next one's
        right part."""
        first = {w: u for u, _, w in parts}
        longest: dict[int, int] = {}        # token -> longest chain whose first rule's right part begins with it
        for u, v, _ in reversed(parts):
            chain = self.size[u] + longest.get(u, 0)
            head: int | None = v
            while head is not None:
                longest[head] = max(longest.get(head, 0), chain)
                head = first.get(head)
        return max(longest.values(), default=1)

    def merge(self, ids: list[int]) -> list[int]:
        """All merges of one symbol run, lowest rank first, leftmost first."""
        return self._few(ids) if len(ids) <= 48 else self._many(ids)

    def _few(self, ids: list[int]) -> list[int]:
        get, made, ids = self.ranks.get, self.made, list(ids)
        none = len(made)
        ranks = [get(p, none) for p in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            ids[i:i + 2] = [made[best]]
            del ranks[i]
            if i:
                ranks[i - 1] = get((ids[i - 1], ids[i]), none)
            if i < len(ranks):
                ranks[i] = get((ids[i], ids[i + 1]), none)
        return ids

    def _many(self, ids: list[int]) -> list[int]:
        get, ids, n = self.rules.get, list(ids), len(ids)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r[0], i, r[1]) for i in range(n - 1) if (r := get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            rank, i, w = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or get((ids[i], ids[j])) != (rank, w):
                continue                    # one of the two is gone
            ids[i], ids[j], after[i] = w, -1, after[j]
            if after[i] < n:
                before[after[i]] = i
                if r := get((w, ids[after[i]])):
                    heapq.heappush(heap, (r[0], i, r[1]))
            if before[i] >= 0 and (r := get((ids[before[i]], w))):
                heapq.heappush(heap, (r[0], before[i], r[1]))
        return [t for t in ids if t >= 0]

    def stream(self, symbols: Iterable[str], window: int = WINDOW) -> Iterator[int]:
        """Token ids of one pre-token, read symbol by symbol and emitted once
        stable.  At most ``window + 2 * lookahead`` symbols are held."""
        held: list[int] = []
        size, inner, limit = self.size, self.inner, window + 2 * self.lookahead
        last = ""
        if isinstance(symbols, str) and len(symbols) <= limit:      # one window holds it
            last, held, symbols = symbols[-1:], [inner[c] for c in symbols], ()
        for last in symbols:
            if len(held) >= limit:
                stable, at = len(held) - self.lookahead, 0
                for t in self.merge(held):
                    if at + size[t] > stable:
                        break
                    at += size[t]
                    yield t
                del held[:at]
            held.append(inner[last])
        if held:
            held[-1] = self.last[last]
            yield from self.merge(held)


class ByteText:
    """Bytes in any cut -> text as soon as it is complete; what is no UTF-8
    becomes U+FFFD, one for each maximal part of a character."""

    def __init__(self):
        self._machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, data: bytes) -> str:
        return self._machine.decode(data)

    def finish(self) -> str:
        rest = self._machine.decode(b"", True)
        self._machine.reset()
        return rest


# pre-tokens of printable ASCII in lower case, for tokenizers of kind "words"
ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
SPACED_WORD = re.compile(r" ?[A-Za-z]+")


class Transducer:
    """Text to ids and back for one tokenizer file."""

    def __init__(self, spec: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        doc = json.loads(spec)
        self.merges = Merges(doc["model"])
        self.cutter = Encoder(spec)         # segments, units, and the library's normalizer and pre-tokenizer
        self.kind, lib = self.cutter.kind, self.cutter.lib
        if doc.get("post_processor") or self.kind == "whole":
            raise ValueError("pre-tokens of this tokenizer file are not known to end at white space")
        self.normalizer, self.pre_tokenizer = lib.normalizer, lib.pre_tokenizer
        self.specials = {t.content: i for i, t in lib.get_added_tokens_decoder().items()}
        decoder = (doc.get("decoder") or {}).get("type")
        if decoder not in (None, "ByteLevel"):
            raise ValueError(f"decoder {decoder} is not handled")
        # without a decoder the library joins the tokens themselves by a space
        self.joint = b"" if decoder else b" "
        byte_of = {c: b for b, c in enumerate(byte_letters())}
        raw = (lambda t: bytes(byte_of[c] for c in t) if all(c in byte_of for c in t) else t.encode()) if decoder else str.encode
        self.bytes = {i: raw(t) + self.joint for t, i in lib.get_vocab(with_added_tokens=True).items()}
        self.dtype = np.dtype("<u2" if max(self.bytes) < 1 << 16 else "<u4")
        self.cache = UnitCache(self, lambda ids: np.array(ids, self.dtype).tobytes(), lambda a, b: a + b)

    def pre_tokens(self, unit: str) -> Iterable[str]:
        """The unit's pre-tokens as strings of byte letters."""
        if unit.isascii() and unit.isprintable() and self.kind == "words":
            return ASCII_WORDS.findall(unit.lower())
        if self.kind == "spaced" and SPACED_WORD.fullmatch(unit):
            return [unit.replace(" ", "Ġ")]
        text = self.normalizer.normalize_str(unit) if self.normalizer else unit
        return (p for p, _ in self.pre_tokenizer.pre_tokenize_str(text))

    def unit(self, unit: str) -> list[int]:
        return [t for p in self.pre_tokens(unit) for t in self.merges.stream(p)]

    def encode(self, text: str) -> bytes:
        """Serialized ids of a text; special strings are tokens of their own."""
        get = self.cache.__getitem__
        return b"".join(self.dtype.type(self.specials[part]).tobytes() if part in self.specials
                        else b"".join(map(get, self.cutter.units(part))) for part in self.cutter.segments(text))

    def decode(self, ids: Iterable[int], n: int) -> Iterator[str]:
        """Pieces of the text of ``n`` ids; ids without a token are skipped."""
        machine, ids, get, end = ByteText(), iter(ids), self.bytes.get, len(self.joint)
        held = b""                          # the joint after the last token waits for a next one
        for low in range(0, n, IDS_AT_ONCE):
            data = held + b"".join(map(get, islice(ids, min(IDS_AT_ONCE, n - low)), repeat(b"")))
            held, data = (data[len(data) - end:], data[:len(data) - end]) if end else (b"", data)
            yield machine.feed(data)
        yield machine.finish()


def transducer(spec: str, key: str) -> Transducer:
    """The worker's transducer for a tokenizer file (key: a hash of the file)."""
    return kept("bpe_stream", key, lambda: Transducer(spec))


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    low, held, widths = 0, 0, pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
    for i, width in enumerate(widths):
        if i > low and held + width > SLICE_BYTES:
            yield batch.slice(low, i - low)
            low, held = i, 0
        held += width
    yield batch.slice(low)


def _lists(raw: list[bytes], dtype: np.dtype) -> pa.Array:
    ends = np.cumsum([0, *map(len, raw)]) // dtype.itemsize
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(raw), dtype).astype("i4")))


def _run(df: DataFrame, tokenizer_path: str, work, schema: str) -> DataFrame:
    ship(df.sparkSession)
    spec = Path(tokenizer_path).read_text()
    key = hashlib.sha256(spec.encode()).hexdigest()
    shared = df.sparkSession.sparkContext.broadcast(spec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from work(transducer(shared.value, key), batch)

    return df.mapInArrow(run, schema)


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))


def encode_texts(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>), one row per input row, as the tokenizers
    library encodes whole texts without added special tokens.

    Null and empty texts have no ids; a null id stays null; repeated rows give
    repeated rows; an empty table gives no rows; other columns are not read.
    A tokenizer file with another model, a post-processor or pre-tokens that
    may cross white space raises ValueError.
    """
    def work(t: Transducer, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for b in _slices(batch, 1):
            raw = [t.encode(x) if (x := s.as_py()) else b"" for s in b.column(1)]
            yield pa.record_batch([b.column(0), _lists(raw, t.dtype)], ["doc_id", "ids"])

    return _run(_texts(df, id_col, text_col), tokenizer_path, work, "doc_id long, ids array<int>")


def decode_ids(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text), one row per input row, as the library decodes with
    special tokens kept.  Null ids give null, no ids the empty text; ids
    without a token and null elements are skipped."""
    def work(t: Transducer, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for low in range(0, len(batch), 64):
            b = batch.slice(low, 64)
            texts = [None if ids is None else "".join(t.decode(ids, len(ids))) for ids in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{ids_col}`").cast("array<int>").alias("ids"))
    return _run(rows, tokenizer_path, work, "doc_id long, text string")


def round_trip(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, decoded): both directions in one pass, so ids don't
    travel to the JVM and back.  Odd values as in ``encode_texts``."""
    def work(t: Transducer, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for b in _slices(batch, 1):
            raw = [t.encode(x) if (x := s.as_py()) else b"" for s in b.column(1)]
            texts = []
            for r in raw:
                ids = np.frombuffer(r, t.dtype)
                texts.append("".join(t.decode(ids.tolist(), len(ids))))
            yield pa.record_batch([b.column(0), _lists(raw, t.dtype), pa.array(texts, pa.string())], ["doc_id", "ids", "decoded"])

    return _run(_texts(df, id_col, text_col), tokenizer_path, work, "doc_id long, ids array<int>, decoded string")
