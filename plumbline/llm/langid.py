"""Language by fusion of evidence: text likelihoods, declared language, address suffix, host priors.

* Text: byte trigrams hashed into a fixed number of buckets, counted over all documents whose
  declared language is one of ``languages``: the fixed ones and every language that enough documents
  declare. A trigram that no language has seen has the same share in all. One more class, ``OTHER``,
  stands for all that is none of them: its shares are between those of all documents and equal ones. A text's likelihood is tempered, since neighbouring
  trigrams are no independent evidence.
* Declared language and address suffix: how often each value occurs with each language, where the
  language is the one that the text alone suggests; one grouping each.
* Host: the share of a language on a host, smoothed by the host's domain, that by all documents.

The sum of the logarithms is normalised to posteriors. A document is rejected if it has no trigram
of letters, if ``OTHER`` is most probable, or if no language is more probable than the others together.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.arrow import octets, sliced
from plumbline.llm.stored import stored
from plumbline.llm.tokens import PIECE, cut, parts

LANGUAGES = ("en", "fr", "de", "es")
OTHER = "other"
#: Rows, and their share of those that declare a language, from which a declared language has a profile.
ENOUGH_ROWS, ENOUGH_SHARE = 100, 0.001
BUCKETS = 1 << 16

#: Trigrams that count in full; of more the weight grows ever slower.
INDEPENDENT = 100.0
#: Documents that a level of the host prior lends to the level below.
LENT = 10.0
LEAST_POSTERIOR = 0.5
#: How probable ``OTHER`` is beside a language before anything is known: few trigrams do not suffice.
OTHER_PRIOR = 0.001
#: Occurrences from which a language is trusted to have a trigram.
SUPPORT = 3

_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[65:91] += 32
_FOLDED[[b for b in range(128) if not chr(b).isalpha()]] = 32


_APART = _FOLDED[np.arange(256)] == 32


def _buckets(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the trigrams with a letter in the middle of all texts, and where each text's begin."""
    joined = b" " + b"   ".join(t or b"" for t in texts) + b"   "
    data = _FOLDED[np.frombuffer(joined, dtype=np.uint8)].astype(np.uint32)
    code = data[:-2] | data[1:-1] << np.uint32(8) | data[2:] << np.uint32(16)
    blank = data == 32
    counted = np.flatnonzero(~(blank[1:-1] | blank[:-2] & blank[2:]))
    buckets = (code[counted] * np.uint32(0x9E3779B1)) >> np.uint32(16)
    starts = np.concatenate(([0], np.cumsum([len(t or b"") + 3 for t in texts])))
    return buckets, np.searchsorted(counted, starts)


def _pieces(texts: list[bytes | None], most: int) -> Iterator[tuple[int, int, list[bytes | None]]]:
    """Texts by range, a long one alone and in pieces cut between letters: a trigram has a letter in its middle
    and never two signs that are none, so each is in one piece."""
    for a, b in parts(texts, most):
        if b - a == 1 and len(texts[a] or b"") > PIECE:
            for piece in cut(texts[a], _APART):
                yield a, b, [piece]
        else:
            yield a, b, texts[a:b]


def _counted(batches: Iterator[pa.RecordBatch], languages: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((len(languages), BUCKETS), dtype=np.int64)
    place = {name: i for i, name in enumerate(languages)}
    for batch in sliced(batches, 1):
        declared, texts = batch.column(0).to_pylist(), octets(batch.column(1))
        for language, i in place.items():
            own = [t for t, d in zip(texts, declared) if d == language]
            for _, _, piece in _pieces(own, 1 << 20):
                counts[i] += np.bincount(_buckets(piece)[0], minlength=BUCKETS)
    language, bucket = np.nonzero(counts)
    yield pa.RecordBatch.from_pydict(
        {
            "language": pa.array(language, pa.int32()),
            "bucket": pa.array(bucket, pa.int32()),
            "n": pa.array(counts[language, bucket], pa.int64()),
        }
    )


def profiles(docs: DataFrame, languages: tuple[str, ...] = LANGUAGES) -> np.ndarray:
    """Logarithms of trigram probabilities, a row per language; its size does not depend on the data."""
    return _shares(_gram_counts(docs, languages))


def _gram_counts(docs: DataFrame, languages: tuple[str, ...]) -> np.ndarray:
    rows = (
        docs.where(F.col("declared").isin(*languages))
        .select("declared", "text")
        .mapInArrow(partial(_counted, languages=languages), "language int, bucket int, n long")
        .groupBy("language", "bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    counts = np.zeros((len(languages), BUCKETS))
    counts[rows["language"].to_numpy(np.int64), rows["bucket"].to_numpy(np.int64)] = rows["n"]
    return counts


def _shares(counts: np.ndarray) -> np.ndarray:
    overall = (counts.sum(axis=0) + 0.5) / (counts.sum() + 0.5 * BUCKETS)
    shares = (counts + 200.0 * overall) / (counts.sum(axis=1, keepdims=True) + 200.0)
    # What no language has seen tells nothing; what one has seen is smoothed by all of them.
    unseen = counts.sum(axis=0) == 0
    shares[:, unseen] = shares[:, unseen].min(axis=0)
    return np.log(shares).astype(np.float32)


def with_other(counts: np.ndarray) -> np.ndarray:
    """The profile of counts with one more row, for texts of no language: half the roots of the languages' mean
    shares, half equal shares. What a language has ``SUPPORT`` times and at least a quarter as often as
    equal shares would is no more frequent there than in that language, so that rare words of a language
    do not speak against it."""
    profile = _shares(counts)
    shares = np.exp(profile.astype(np.float64))
    roots, top = np.sqrt(shares.mean(axis=0)), shares.max(axis=0)
    other = 0.5 * roots / roots.sum() + 0.5 / BUCKETS
    other = np.where((top >= 0.25 / BUCKETS) & (counts.max(axis=0) >= SUPPORT), np.minimum(other, top), other)
    return np.concatenate((profile, np.log(other)[None].astype(np.float32)))


def declared_languages(evidence: DataFrame) -> tuple[str, ...]:
    """The fixed languages and others that enough rows declare, at most one for each ``ENOUGH_SHARE``."""
    tags = evidence.where(F.col("declared").rlike("^[a-z]{2,3}(-[a-z0-9]{1,8})*$") & (F.col("declared") != OTHER))
    counted = tags.groupBy("declared").agg(F.count("*").alias("n"))
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    least = max(ENOUGH_ROWS, ENOUGH_SHARE * total)
    rows = counted.where((F.col("n") >= least) & ~F.col("declared").isin(*LANGUAGES)).collect()
    return (*LANGUAGES, *sorted(r["declared"] for r in rows))


def _scored(batches: Iterator[pa.RecordBatch], profile: np.ndarray) -> Iterator[pa.RecordBatch]:
    by_bucket = np.ascontiguousarray(profile.T)
    for batch in sliced(batches, 1):
        texts = octets(batch.column(1))
        sums = np.zeros((len(texts), len(profile)))
        sizes = np.zeros(len(texts), dtype=np.int64)
        for a, b, piece in _pieces(texts, 1 << 18):
            buckets, first = _buckets(piece)
            sizes[a:b] += np.diff(first)
            running = np.zeros((len(buckets) + 1, len(profile)))
            np.cumsum(by_bucket[buckets], axis=0, dtype=np.float64, out=running[1:])
            sums[a:b] += running[first[1:]] - running[first[:-1]]
        flat = pa.array(sums.reshape(-1))
        lists = pa.ListArray.from_arrays(
            pa.array(np.arange(len(texts) + 1, dtype=np.int32) * len(profile)), flat
        )
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(batch.column(i) for i in range(2, batch.num_columns)), pa.array(sizes), lists],
            names=["doc_id", "row_hash", "declared", "host", "suffix", "n_grams", "likelihoods"],
        )


def page_evidence(pages: DataFrame) -> DataFrame:
    """``(doc_id, text, declared, host, suffix)`` of raw pages, as :func:`identified` takes them."""
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1))
    declared = F.lower(F.regexp_extract("html", r"(?i)<html[^>]*\blang\s*=\s*[\"']?([A-Za-z]+)", 1))
    bare = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    return pages.select(
        F.col("page_id").cast("long").alias("doc_id"),
        bare.alias("text"),
        F.nullif(declared, F.lit("")).alias("declared"),
        F.nullif(host, F.lit("")).alias("host"),
        F.nullif(F.regexp_extract(host, r"\.([a-z]+)$", 1), F.lit("")).alias("suffix"),
    )


def document_evidence(docs: DataFrame) -> DataFrame:
    """The same of documents: ``lang`` is what the source declares, ``source`` stands for the host."""
    host = F.lower(F.col("source").cast("string"))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.lower(F.col("lang").cast("string")).alias("declared"),
        host.alias("host"),
        F.nullif(F.regexp_extract(host, r"\.([a-z]+)$", 1), F.lit("")).alias("suffix"),
    )


def _at(array: str, i: int) -> Column:
    return F.col(array)[i]


def _best(values: list[Column], languages: tuple[str, ...], top: Column | None = None) -> Column:
    """The language of the greatest value, which may be given; of equal ones the first."""
    top = F.greatest(*values) if top is None else top
    return reduce(
        lambda other, pair: F.when(pair[0] == top, F.lit(pair[1])).otherwise(other),
        reversed(list(zip(values, languages))),
        F.lit(None).cast("string"),
    )


def _counts(rows: DataFrame, key: str, languages: tuple[str, ...]) -> DataFrame:
    return rows.groupBy(key).agg(*[F.count_if(F.col("suggested") == x).alias(x) for x in languages])


def _emission(rows: DataFrame, key: str, languages: tuple[str, ...]) -> DataFrame:
    """Per value of a column the logarithms of its probability under each language."""
    counts = _counts(rows.where(F.col(key).isNotNull()), key, languages)
    # One row of totals; values and languages are few numbers whatever the size of the table.
    totals = counts.agg(F.count("*"), *[F.coalesce(F.sum(x), F.lit(0)) for x in languages]).first()
    logs = [
        F.log((F.col(x) + 0.5) / F.lit(total + 0.5 * (totals[0] + 1))) for x, total in zip(languages, totals[1:])
    ]
    return stored(counts.select(key, F.array(*logs).alias(f"{key}_logs")), "evidence")


def _priors(rows: DataFrame, languages: tuple[str, ...]) -> DataFrame:
    """Per host the logarithms of its language shares, smoothed by its domain and by all rows."""
    hosts = _counts(rows.where("host IS NOT NULL"), "host", languages).withColumn(
        "domain", F.substring_index("host", ".", -2)
    )
    domains = hosts.groupBy("domain").agg(*[F.sum(x).alias(f"d_{x}") for x in languages])
    totals = rows.agg(*[F.count_if(F.col("suggested") == x) for x in languages]).first()

    def total(prefix: str) -> Column:
        return reduce(lambda a, b: a + b, [F.col(f"{prefix}{x}") for x in languages])

    def share(x: str, count: int) -> Column:
        everywhere = (count + 1) / (sum(totals) + len(languages))
        domain = (F.col(f"d_{x}") + F.lit(LENT * everywhere)) / (total("d_") + LENT)
        return (F.col(x) + LENT * domain) / (total("") + LENT)

    logs = [F.log(share(x, count)) for x, count in zip(languages, totals)]
    joined = hosts.join(domains, "domain").select("host", F.array(*logs).alias("host_logs"))
    # Written, its size is known to the planner: a small table is joined without dealing the documents.
    return stored(joined, "priors")


def identified(
    evidence: DataFrame,
    languages: tuple[str, ...] | None = None,
    least: float = LEAST_POSTERIOR,
) -> DataFrame:
    """``(doc_id, row_hash, declared, language, posterior, n_grams, kept)`` for every row.

    ``evidence`` has ``doc_id, text, declared, host, suffix``. A null or unknown declaration, host or
    suffix is no evidence. A text without a trigram of letters, null and empty ones included, has no
    language and is rejected, and so is one of no language that is known; its posterior is that of ``OTHER``.
    Without ``languages`` these are :func:`declared_languages`. ``row_hash`` names the text with its evidence, so equal rows have equal
    verdicts, whatever their id. Of equally probable languages the first counts. An empty table has no rows. Long texts
    are counted in pieces of a megabyte, cut where no trigram is.
    """
    languages = languages or declared_languages(evidence)
    profile = with_other(_gram_counts(evidence, languages))
    languages = (*languages, OTHER)
    scored = stored(
        evidence.select(
            "doc_id",
            "text",
            F.xxhash64("text", "declared", "host", "suffix").alias("row_hash"),
            "declared",
            "host",
            "suffix",
        ).mapInArrow(
            partial(_scored, profile=profile),
            "doc_id long, row_hash long, declared string, host string, suffix string, n_grams long,"
            " likelihoods array<double>",
        ),
        "likelihoods",
    )
    prior = [0.0] * (len(languages) - 1) + [math.log(OTHER_PRIOR)]
    alone = [_at("likelihoods", i) + F.lit(prior[i]) for i in range(len(languages))]
    suggested = scored.where("n_grams > 0").withColumn("suggested", _best(alone, languages))
    declared = _emission(suggested, "declared", languages)
    suffixes = _emission(suggested, "suffix", languages)
    joined = (
        scored.join(declared, "declared", "left")
        .join(suffixes, "suffix", "left")
        .join(_priors(suggested, languages), "host", "left")
    )
    weight = F.lit(INDEPENDENT) / (F.lit(INDEPENDENT) + F.col("n_grams"))
    sums = [
        weight * _at("likelihoods", i)
        + F.lit(prior[i])
        + F.coalesce(_at("declared_logs", i), F.lit(0.0))
        + F.coalesce(_at("suffix_logs", i), F.lit(0.0))
        + F.coalesce(_at("host_logs", i), F.lit(0.0))
        for i in range(len(languages))
    ]
    names = [f"s_{i}" for i in range(len(languages))]
    fused = joined.select("doc_id", "row_hash", "declared", "n_grams", *[s.alias(n) for n, s in zip(names, sums)])
    # Written: a filter on the verdict would be pushed below and repeat every sum in every comparison, which is
    # more code than a class can hold.
    fused = stored(fused.withColumn("top", F.greatest(*names)), "fused")
    columns, top = [F.col(n) for n in names], F.col("top")
    some = F.col("n_grams") > 0
    posterior = F.lit(1.0) / reduce(lambda a, b: a + b, [F.exp(c - top) for c in columns])
    best = _best(columns, languages, top)
    return (
        fused.withColumn("posterior", F.when(some, posterior).otherwise(F.lit(0.0)))
        .withColumn("language", F.when(some, F.nullif(best, F.lit(OTHER))))
        .select(
            "doc_id",
            "row_hash",
            "declared",
            "language",
            "posterior",
            "n_grams",
            (F.col("language").isNotNull() & (F.col("posterior") >= least)).alias("kept"),
        )
    )


def only_identified(docs: DataFrame) -> DataFrame:
    """The rows of documents that :func:`identified` does not reject, unchanged."""
    found = identified(document_evidence(docs))
    # Written, its size is known to the planner: where few are rejected the texts are not shuffled.
    rejected = stored(found.where("NOT kept").select("row_hash").distinct(), "rejected")
    evidence = F.xxhash64(
        F.col("text").cast("string"),
        F.lower(F.col("lang").cast("string")),
        F.lower(F.col("source").cast("string")),
        F.nullif(F.regexp_extract(F.lower(F.col("source").cast("string")), r"\.([a-z]+)$", 1), F.lit("")),
    )
    return docs.join(rejected, evidence == rejected["row_hash"], "left_anti")
