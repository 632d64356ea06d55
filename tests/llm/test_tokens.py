import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from strata.llm.token_counts import token_counts
from strata.llm.token_files import decoder, read_document, read_index, read_token_files, write_token_files
from strata.llm.units import Encoder, UnitCache
from strata.session import scratch_path
from tests.llm import data

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_counts_are_the_librarys(spark, path):
    lib = Tokenizer.from_file(path)
    rows = data.odd_texts()
    got = token_counts(data.documents(spark, rows), path).collect()
    want = [(i, len((t or "").encode()), n := len(lib.encode(t, add_special_tokens=False).ids) if t else 0, n > 512) for i, t in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert token_counts(data.empty(spark), path).count() == 0


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_units_put_a_text_together(path):
    spec = open(path).read()
    enc, lib = Encoder(spec), Tokenizer.from_file(path)
    cache = UnitCache(enc, list, lambda a, b: a + b)
    for text in ["Word, word. WORD! \n\nNext\tline\x0b a,b 's it's don't. été, ÉTÉ; İ ßß. x́,  wide　sp",
                 "a|b|", "!!.,", ".\n.", "\n\n", "Á.", "ΣΣ Σ.", "  two  three   ", "\x85x\x1dy\x1c", "12,345.67."]:
        got = [x for part in enc.segments(text) for u in enc.units(part) for x in cache[u]]
        assert got == lib.encode(text, add_special_tokens=False).ids, text


def test_token_files_round_trip(spark):
    lib = Tokenizer.from_file(WORD)
    rows = data.odd_texts()
    path = scratch_path(spark, "test-tokens")
    write_token_files(data.documents(spark, rows), path, WORD, shard_bytes=40_000)
    got = sorted(map(tuple, read_token_files(spark, path).collect()), key=lambda r: r[1])
    ids = {i: [] for i, _ in rows}
    for i, t in rows:
        ids[i].append((lib.encode(t, add_special_tokens=False).ids if t else []) + [1])
    assert [r[0] for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    start = 0
    for i, at, n, crc in got:
        assert at == start and (n, crc) in [(len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for x in ids[i]]
        start += n
    dictionary = bytes(spark.read.parquet(f"{path}/dictionary").first().bytes)
    files = [bytes(r.content) for r in spark.read.format("binaryFile").load(f"{path}/data").collect()]
    assert len(files) > 3
    found = [x for f in files if (x := read_document(f, dictionary, 8)) is not None]
    assert len(found) == 1 and found[0].tolist() == ids[8][0]
    with pytest.raises(ValueError):
        decoder(read_index(files[0])[0], dictionary + b"x")


def test_token_files_of_nothing(spark):
    path = scratch_path(spark, "test-tokens")
    write_token_files(data.empty(spark), path, WORD)
    assert read_token_files(spark, path).count() == 0


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_runs_of_marks_are_encoded_once(path):
    enc = Encoder(open(path).read())
    words = [a + b + c for a in "kvz" for b in "aeo" for c in ("rt", "É", "it's", "3", "")]
    units = [w + m for w in words for m in ("!!", "***", ".,$", "'!", "!'", "|>", "_")]
    want, calls, encode = [enc.encode(u) for u in units], [], enc.encode
    enc.encode = lambda text: calls.append(text) or encode(text)
    cache = UnitCache(enc, list, lambda a, b: a + b)
    assert [cache[u] for u in units] == want
    assert not [c for c in calls if c[-1] == "*" and c[:-3].isalpha()]
