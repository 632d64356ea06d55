import hashlib
import heapq

from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm.warc import LoserTree, capture_histories, records, unpacked, url_key, write_warc
from strata.session import scratch_path


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 9)), max_size=9))
def test_loser_tree_merges(runs):
    runs = [sorted((x, i, k) for k, x in enumerate(r)) for i, r in enumerate(runs)]
    assert list(LoserTree([iter(r) for r in runs])) == list(heapq.merge(*runs))


def test_url_keys():
    assert url_key("HTTPS://user@News.Example.com:8080/A?b=1#c") == "com,example,news)/A?b=1"
    assert url_key("") == ")/" and url_key("example.org") == "org,example)/"


def test_round_trip(spark):
    big, hard = "hé" * 60_000, "WARC/1.1\r\nContent-Length: 5\r\n\r\nx\r\n\r\n\r\n\r\n" * 5
    pages = [(i, f"http://h{i % 3}.org/{i % 5}", body) for i, body in enumerate(["", None, "s", "s", big, hard, big, hard, "<p>" * 50, "x" * 99, "x" * 99])]
    pages += [(20, None, big), (None, "http://a\r\nWARC-Type: x", big), (4, "http://h1.org/4", big), (21, "", "\r\n\r\n"), (-5, "http://h1.org/4", hard)]
    df = spark.createDataFrame([(*p, "clash", "x") for p in pages], "page_id long, url string, html string, id string, digest string").repartition(4)
    path = scratch_path(spark, "test-warc")
    write_warc(df, path)
    got = capture_histories(spark, path).orderBy("position").collect()
    body = lambda p: (p[2] or "").encode()                                                                      # noqa: E731
    want = []
    for p in pages:
        first = min((q[0] for q in pages if body(q) == body(p) and q[0] is not None), default=None)
        again = len(body(p)) >= 100 and p[0] is not None and first < p[0]
        want.append((p[0], len(body(p)), hashlib.sha256(body(p)).hexdigest(), "revisit" if again else "response", first if again else None))
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=repr) == sorted(want, key=repr)
    assert [r.position for r in got] == list(range(len(pages)))
    keys = [(r.url_key, r.captured) for r in got]
    assert keys == sorted(keys)
    # every index entry leads to its record
    files = {r.path.rsplit("/", 1)[1]: unpacked(bytes(r.content)) for r in spark.read.format("binaryFile").load(path).collect()}
    for r in got:
        at, length, fields, _ = next(records(files[r.run][r.offset:r.offset + r.length]))
        assert fields["WARC-Payload-Digest"] == f"sha256:{r.payload_digest}" and length == r.length


def test_no_pages(spark):
    path = scratch_path(spark, "test-warc")
    write_warc(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert capture_histories(spark, path).count() == 0
