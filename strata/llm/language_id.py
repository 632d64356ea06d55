"""Language identification by fusing evidence.

For each language l, with everything estimated from the data::

    log P(l | row) ~ log prior of the row's host (l)
                   + log likelihood of the text under l
                   + log P(declared language | l) + log P(address suffix | l)

Text: hashed byte trigrams of the whole text, a multinomial model per
language fitted on about ``PER_LANGUAGE`` labelled texts each, or on all of
a language that has fewer, however long they are.  The mean
log likelihood counts as TEXT_WEIGHT trigrams at most, because neighbouring
trigrams aren't independent.  An "und" hypothesis (all trigrams alike) takes
what is in none of the languages.

Declared language and address suffix: how often rows whose text is clearly
in l declare or have it, from grouped counts over all rows.  Host priors:
grouped counts per host, smoothed towards its domain, that towards its
suffix, that towards all rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.words import LOWER, SPACE, buffers
from strata.llm.worker import begin, give_back
from strata.session import materialize, ship

OPERATOR = "language_id"
PER_LANGUAGE = 1_000
HELD = 64                       # languages whose counts are in memory at once
SEED = 17
MAX_LANGUAGES = 512             # score tables of 256 KB each that every Python worker holds
BUCKETS = 1 << 16
TEXT_WEIGHT = 60
ALPHA = 0.1
HOST_ROWS, KIND_ROWS = 20.0, 1.0    # pseudo-rows of the level above, and of each declared value
UND_PRIOR = 0.01
CLEAR = 0.9
UNDETERMINED = "und"
CHUNK = 1 << 19                 # bytes of text that are scored or counted at once
CELLS = 1 << 19                # rows times languages that are fused at once


def trigrams(data: np.ndarray) -> np.ndarray:
    """Bucket of the three bytes from each position on; white space counts as spaces."""
    b = LOWER[data].astype(np.uint32)
    b[SPACE[data]] = 32
    code = b[:-2] << np.uint32(16)
    code |= b[1:-1] << np.uint32(8)
    code |= b[2:]
    code *= np.uint32(2654435761)
    code >>= np.uint32(16)
    return code


def subtag(tag: Column) -> Column:
    """Primary language subtag of a label: lower case, without region or script.

    A label that does not start with two letters stands for itself; "und"
    and blank labels name no language (null)."""
    whole = F.lower(F.trim(tag))
    found = F.regexp_extract(whole, "^[a-z]{2,}", 0)
    name = F.when(found != "", found).otherwise(whole)
    return F.when((name != "") & (name != UNDETERMINED), name)


def trigram_counts(texts: pa.Array) -> np.ndarray:
    """Trigrams per bucket of all texts, each to its end."""
    data, offsets = buffers(texts)
    out = np.zeros(BUCKETS, np.int64)
    for begin, end in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        for low in range(begin, end - 2, CHUNK):
            out += np.bincount(trigrams(data[low:min(end, low + CHUNK + 2)]), minlength=BUCKETS)
    return out


def partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(l, bucket, n) of a task's (l, text) rows; at most HELD languages are held at once."""
    begin(OPERATOR)
    held: dict[int, np.ndarray] = {}

    def emptied() -> Iterator[pa.RecordBatch]:
        while held:
            l, counts = held.popitem()         # noqa: E741
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), l, np.int32)), pa.array(at.astype(np.int32)), pa.array(counts[at])], ["l", "bucket", "n"])

    for b in batches:
        label = b.column(0).to_numpy(zero_copy_only=False)
        for l in np.unique(label):             # noqa: E741
            counts = trigram_counts(b.column(1).take(pa.array(np.flatnonzero(label == l))))
            held[int(l)] = held.get(int(l), 0) + counts
            if len(held) >= HELD:
                yield from emptied()
    yield from emptied()


def fit(df: DataFrame, text_col: str, label_col: str, per_language: int = PER_LANGUAGE) -> tuple[list[str], np.ndarray]:
    """Languages and log P(trigram | language) for every label found, labels
    as by subtag(), from whole texts of three bytes or more.

    A language of at most ``per_language`` such texts is fitted on all of
    them, a larger one on a random sample of about that many (seeded, so the
    same files give the same sample).  The trigrams are counted in Spark.
    More than MAX_LANGUAGES languages raise a ValueError: none is left out."""
    ship(df.sparkSession)
    text = F.col(f"`{text_col}`")
    rows = (df.select(subtag(F.col(f"`{label_col}`")).alias("name"), text.alias("text"))
            .where(F.col("name").isNotNull() & (F.octet_length("text") > 2)))
    found = {r.name: r["count"] for r in rows.groupBy("name").count().limit(MAX_LANGUAGES + 1).collect()}
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages are labelled in {label_col}")
    names = sorted(found)
    table = np.empty((BUCKETS, len(names)), np.float32, order="F")
    if not names:
        return names, table
    shares = df.sparkSession.createDataFrame([(n, i, min(1.0, per_language / found[n])) for i, n in enumerate(names)], "name string, l int, share double")
    taken = rows.withColumn("at", F.rand(SEED)).join(F.broadcast(shares), "name").where("at < share").select("l", "text")
    counted = materialize(taken.mapInArrow(partial_counts, "l int, bucket int, n long").groupBy("l", "bucket").agg(F.sum("n").alias("n")), "trigram-counts")
    for low in range(0, len(names), HELD):
        part = counted.where(F.col("l").between(low, low + HELD - 1)).toArrow()
        counts = np.zeros((min(HELD, len(names) - low), BUCKETS))
        counts[part["l"].to_numpy() - low, part["bucket"].to_numpy()] = part["n"].to_numpy()
        table[:, low:low + HELD] = np.log((counts + ALPHA) / (counts.sum(axis=1, keepdims=True) + ALPHA * BUCKETS)).T
    return names, table


def mean_scores(column: pa.Array, table: np.ndarray) -> pa.Array:
    """Per text: mean log likelihood of its trigrams for each language, then their
    number.  A piece of CHUNK bytes is scored at once, however long the texts are."""
    data, offsets = buffers(column)
    n, width = len(offsets) - 1, table.shape[1]
    many = np.maximum(np.diff(offsets) - 2, 0)
    sums = np.zeros((n, width))
    last = int(offsets[-1])
    for low in range(int(offsets[0]), last - 2, CHUNK):
        high = min(low + CHUNK, last - 2)
        first, stop = int(np.searchsorted(offsets, low, "right")) - 1, int(np.searchsorted(offsets, high, "left"))
        begins = np.maximum(offsets[first:stop], low)
        ends = np.minimum(offsets[first:stop] + many[first:stop], high)
        some = np.flatnonzero(ends > begins)
        if len(some):
            begins, ends = begins[some] - low, ends[some] - low
            code, run = trigrams(data[low:high + 2]), np.zeros(high - low + 1)
            for j in range(width):
                np.cumsum(table[:, j][code], dtype=np.float64, out=run[1:])
                sums[first + some, j] += run[ends] - run[begins]
    out = np.zeros((n, width + 1), np.float32)
    out[:, :width] = sums / np.maximum(many, 1)[:, None]
    out[:, width] = many
    flat = pa.array(out.ravel())
    return pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * (width + 1), width + 1, dtype=np.int32)), flat)


def scores(df: DataFrame, text: Column, table: np.ndarray) -> Column:
    shared = df.sparkSession.sparkContext.broadcast(table)

    @F.arrow_udf("array<float>")
    def score(column: pa.Array) -> pa.Array:
        begin(OPERATOR)
        found = mean_scores(column, shared.value)
        give_back()
        return found

    return score(text)


def address_parts(url: Column) -> list[Column]:
    """Host, registered-domain guess (last two labels) and suffix of a URL."""
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*://)?(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return [host.alias("host"), F.substring_index(host, ".", -2).alias("domain"), F.substring_index(host, ".", -1).alias("suffix")]


def markup_language(html: Column) -> Column:
    """The primary language subtag that the html element declares, or null."""
    found = F.lower(F.regexp_extract(html, r"""(?i)<html[^>]*?\slang\s*=\s*["']?([A-Za-z]+)""", 1))
    return F.when(found != "", found)


def page_text(html: Column) -> Column:
    """Text of a page: without scripts, styles, comments and tags."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    return F.regexp_replace(bare, r"<[^>]*>|&[A-Za-z0-9#]+;", " ")


def _log_sum(values: np.ndarray) -> np.ndarray:
    top = values.max(axis=1)
    return top + np.log(np.exp(values - top[:, None]).sum(axis=1))


def _text_terms(column: pa.Array, languages: int) -> tuple[np.ndarray, np.ndarray]:
    """Log likelihoods of the languages and, last, of "und", as weighted
    trigrams; and whether the text has any."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, languages + 1)
    weight = np.minimum(x[:, -1], TEXT_WEIGHT)
    terms = np.column_stack([x[:, :-1], np.full(len(x), -np.log(BUCKETS))]) * weight[:, None]
    return terms, x[:, -1] > 0


def _dense(column: pa.Array, languages: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts by language of each row's (l, n) pairs, and whether the row has a list."""
    out = np.zeros((len(column), languages))
    many = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    pairs = column.flatten()
    out[np.repeat(np.arange(len(column)), many), pairs.field("l").to_numpy(zero_copy_only=False)] = pairs.field("n").to_numpy(zero_copy_only=False)
    return out, column.is_valid().to_numpy(zero_copy_only=False)


def _parts(columns: tuple[pa.Array, ...], languages: int) -> Iterator[tuple[pa.Array, ...]]:
    step = max(1, CELLS // (languages + 1))
    for low in range(0, len(columns[0]), step):
        yield tuple(c.slice(low, step) for c in columns)


KINDS = ("declared", "suffix")
LEVELS = ("host", "domain", "suffix")
FOUND = pa.struct([("language", pa.string()), ("confidence", pa.float64()), ("text_language", pa.string()), ("accepted", pa.bool_())])


class Evidence:
    """Grouped counts over all rows: for each host, domain, suffix and
    declared language the list of (language, rows clearly in it).  Only the
    languages that occur are listed, so many languages cost no width."""

    def __init__(self, rows: DataFrame, names: list[str]):
        self.names, width = names, len(names)

        @F.arrow_udf("int")
        def clear(scores: pa.Array) -> pa.Array:
            found = []
            for (column,) in _parts((scores,), width):
                terms, some = _text_terms(column, width)
                best = terms.argmax(axis=1)
                sure = np.exp(terms.max(axis=1) - _log_sum(terms)) >= CLEAR      # of one language at most
                found.append(np.where(sure & some & (best < width), best, -1))
            return pa.array(np.concatenate(found) if found else np.empty(0), pa.int32())

        counted = materialize(rows.select("declared", "host", "domain", "suffix", clear("scores").alias("l"))
                              .groupBy("declared", "host", "domain", "suffix", "l").agg(F.count("*").alias("n")), "language-counts")
        self.total = np.ones(width)
        for r in counted.where("l >= 0").groupBy("l").agg(F.sum("n").alias("n")).collect():
            self.total[r.l] += r.n
        hosts = self._listed(counted, "host", "domain")
        for key, above in (("domain", "suffix"), ("suffix", None)):
            hosts = hosts.join(self._listed(counted, key, above).withColumnRenamed(key, "up"), F.col(key).eqNullSafe(F.col("up")), "left").drop(key, "up")
        self.hosts = materialize(hosts.withColumnRenamed("host", "host_value"), "host-priors")
        self.kinds = {k: materialize(self._listed(counted.where(f"{k} is not null and {k} <> ''"), k, None)
                                     .select(F.col(k).alias(f"{k}_value"), F.col(f"{k}_n").alias(f"{k}_given")), f"given-{k}") for k in KINDS}
        self.values = {k: table.count() for k, table in self.kinds.items()}

    def _listed(self, counted: DataFrame, key: str, above: str | None) -> DataFrame:
        """A row per key: its list of (l, n), and the key of the level above."""
        up = [F.min(above).alias(above)] if above else []
        sums = counted.groupBy(key, "l").agg(F.sum("n").alias("n"), *up)
        return sums.groupBy(key).agg(F.collect_list(F.when(F.col("l") >= 0, F.struct("l", "n"))).alias(f"{key}_n"), *up)

    def fuse(self, rows: DataFrame, text: Column | None = None, table: np.ndarray | None = None) -> DataFrame:
        """``rows`` with language, confidence, text_language and accepted, from
        their ``scores``, or from ``text`` scored here by ``table``."""
        shared = None if text is None else rows.sparkSession.sparkContext.broadcast(table)
        rows = rows.join(self.hosts, F.col("host").eqNullSafe(F.col("host_value")), "left")
        for k, table in self.kinds.items():
            rows = rows.join(table, F.col(k) == F.col(f"{k}_value"), "left")
        names, width, total, values = [*self.names, UNDETERMINED], len(self.names), self.total, self.values
        labels = np.array(names, object)

        def fused(scores: pa.Array, *lists: pa.Array) -> pa.Array:
            begin(OPERATOR)
            text, some = _text_terms(scores, width)
            prior = (total / total.sum())[None]
            for column in lists[2::-1]:                 # suffix, domain, host
                own, _ = _dense(column, width)
                prior = (own + HOST_ROWS * prior) / (own.sum(axis=1) + HOST_ROWS)[:, None]
            terms = text.copy()
            terms[:, :-1] += np.log(prior)
            terms[:, -1] += np.log(UND_PRIOR)
            for k, column in zip(KINDS, lists[3:]):     # "und" gets the evidence of the average language
                own, has = _dense(column, width)
                given = np.where(has[:, None], np.log((own + KIND_ROWS) / (total + KIND_ROWS * values[k])), 0.0)
                terms[:, :-1] += given
                terms[:, -1] += given.mean(axis=1)
            language = labels[terms.argmax(axis=1)]
            return pa.StructArray.from_arrays(
                [pa.array(language, pa.string()), pa.array(np.exp(terms.max(axis=1) - _log_sum(terms))),
                 pa.array(np.where(some, labels[text.argmax(axis=1)], None), pa.string()), pa.array(some & (language != UNDETERMINED))],
                fields=list(FOUND))

        @F.arrow_udf("language string, confidence double, text_language string, accepted boolean")
        def fuse_lists(scores: pa.Array, host: pa.Array, domain: pa.Array, suffix: pa.Array, declared: pa.Array, suffix_given: pa.Array) -> pa.Array:
            if shared is not None:
                begin(OPERATOR)
                scores = mean_scores(scores, shared.value)
            parts = [fused(*p) for p in _parts((scores, host, domain, suffix, declared, suffix_given), width)]
            give_back()
            return pa.concat_arrays(parts) if parts else pa.array([], FOUND)

        lists = [F.col(f"{k}_n") for k in LEVELS] + [F.col(f"{k}_given") for k in KINDS]
        return rows.withColumn("found", fuse_lists(F.col("scores") if text is None else text, *lists)).select("row", "declared", "host", "found.*")


def identify(df: DataFrame, text: Column, declared: Column, address: list[Column], model: tuple[list[str], np.ndarray],
             keep: list[str] | None = None, within: Column | None = None) -> DataFrame:
    """(row, declared, host, text_language, language, confidence, accepted),
    one row per input row; ``row`` holds the input columns (or those in ``keep``).
    ``within`` is the text as a part of ``row``, if that holds it: texts that go
    along anyway are scored where the evidence is joined, by the same worker.

    A null, empty or very short text (under three bytes) has no likelihood:
    its language comes from the other evidence and it is not accepted.  A
    null or unknown declared language or suffix gives no evidence; a null
    host counts as a host of its own.  Ties go to the first language by
    name.  Repeated rows count as often as they come; an empty table gives
    no rows.
    """
    ship(df.sparkSession)
    names, table = model
    kept = F.struct(*[F.col(f"`{c}`") for c in keep]) if keep else F.struct("*")
    rows = df.select(kept.alias("row"), text.alias("text"), declared.alias("declared"), *address)
    if not names:
        return rows.select("row", "declared", "host", F.lit(None).cast("string").alias("text_language"), F.lit(UNDETERMINED).alias("language"),
                           F.lit(1.0).alias("confidence"), F.lit(False).alias("accepted"))
    scored = rows.withColumn("scores", scores(df, F.col("text"), table))
    # the scores are computed once, without the texts, for the counts and again where rows pass on
    evidence = Evidence(scored.select("declared", "host", "domain", "suffix", "scores"), names)
    found = evidence.fuse(scored.drop("text")) if within is None else evidence.fuse(rows.drop("text"), within, table)
    return found.select("row", "declared", "host", "text_language", "language", "confidence", "accepted")


def identify_documents(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Documents: ``lang`` is the declared language, ``source`` the host."""
    host = F.col("source")
    return identify(docs, F.col("text"), subtag(F.col("lang")),
                    [host.alias("host"), F.lit("").alias("domain"), F.lit("").alias("suffix")],
                    fit(docs, "text", "lang"), keep, F.col("row.text") if keep is None else None)


def identify_pages(pages: DataFrame, labelled: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Pages: the html element declares a language, the URL gives host and suffix;
    the text model comes from labelled documents."""
    return identify(pages, page_text(F.col("html")), markup_language(F.col("html")), address_parts(F.col("url")),
                    fit(labelled, "text", "lang"), keep)
