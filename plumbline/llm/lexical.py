"""Ranked lexical search: the best documents for every item, by MaxScore with bounds on pairs of terms.

1. Items become their distinct terms. Terms are maximal runs of ASCII letters, digits and all other
   characters beyond ASCII, with A-Z lower-cased, as 64-bit hashes. Items share passes of about
   ``TERMS_A_PASS`` terms, which bounds what is broadcast; each pass reads the documents once.
2. A scan leaves, of each document, how many terms it has and which terms of items how often.
3. Documents are indexed in shards of about ``POSTINGS`` postings: for each term a list of documents and
   impacts with its greatest impact, and for each chosen pair of terms the *intersection list* of the
   documents that hold both, with the greatest joint impact. A pair is chosen where two terms are
   neighbours in the order of weights of an item, so an item has half as many pairs as terms.
4. A task keeps the best documents of each item over all its shards. In a shard an item's terms are
   units, its pairs and what is left over. A pair adds at most its greatest joint impact, or, where only one
   of its terms stands, that one's: mostly far less than the sum of both. Units are ordered by what they
   can add. A document whose last unit is the j-th is looked at only if the bounds of the units before it
   and what stands of the j-th reach the threshold: through the whole list of a term if the term alone
   is enough, else through the intersection list if both are, else not at all. What is looked at is scored from
   the last unit down, and given up once what is left cannot reach the threshold.
5. A first look at a few shards gives thresholds to start from. Each task's best are merged in two steps.

Nothing is lost: a skipped document is below the threshold, and equal scores are always looked at.

Defined results. Null or empty texts have no terms, and an item without terms, or whose terms no document
has, has no rows. Rows that repeat an item_id are one item with the terms of all; each row of the documents
is a document of its own, also when its id repeats. A null doc_id comes first among equal scores. Empty
tables give no rows; other columns are not read. Texts beyond a megabyte are read in pieces cut between
terms.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.arrow import octets
from plumbline.llm.stored import stored
from plumbline.llm.tokens import Powers, cut, parts, words

#: Best documents of an item.
BEST = 50
#: Postings of a shard, terms of the items of a pass, and shards that are looked at first.
POSTINGS, TERMS_A_PASS, FIRST_LOOK = 1 << 18, 1 << 18, 8
#: Groups in which the tasks' best are merged first.
MERGED = 256

#: Bytes between terms: all ASCII but letters and digits.
BETWEEN = np.zeros(256, dtype=bool)
BETWEEN[:128] = True
BETWEEN[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False

_FIRST = np.iinfo(np.int64).min


def _term_counts(texts: list[bytes | None], powers: Powers) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Hashes of terms with the text they stand in: ``(first text, text - first, hash)``."""
    for a, b in parts(texts, 1 << 20):
        groups = [texts[a:b]] if b - a > 1 else [[piece] for piece in cut(texts[a] or b"", BETWEEN)]
        for group in groups:
            found = words(group, powers, BETWEEN)
            yield a, np.repeat(np.arange(len(group)), np.diff(found.first)), found.hashes


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers = Powers()
    for batch in batches:
        for first, text, hashes in _term_counts(octets(batch.column(1)), powers):
            both = np.unique(np.stack((text, hashes.view(np.int64))), axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(both[0] + first)), pa.array(both[1])], names=["item_id", "hash"]
            )


@dataclass
class Query:
    """Items of a pass: item ``i`` has ``terms[first[i]:first[i + 1]]``, places in ``hashes``."""

    ids: list
    first: np.ndarray
    terms: np.ndarray
    hashes: np.ndarray

    @classmethod
    def of(cls, rows: pa.Table) -> Query:
        ids = rows.column("item_id").to_pylist()
        names = {i: n for n, i in enumerate(sorted(set(ids), key=lambda i: (i is not None, i or 0)))}
        number = np.array([names[i] for i in ids], dtype=np.int64)
        hashes, terms = np.unique(rows.column("hash").to_numpy().view(np.uint64), return_inverse=True)
        order = np.lexsort((terms, number))
        first = np.searchsorted(number[order], np.arange(len(names) + 1))
        return cls(list(names), first, terms[order].astype(np.int32), hashes)

    def weighed(self, weights: np.ndarray) -> Query:
        """Each item's terms in order of falling weight; those of weight 0 add nothing and go."""
        number = np.repeat(np.arange(len(self.ids)), np.diff(self.first))
        some = weights[self.terms] > 0
        number, terms = number[some], self.terms[some]
        order = np.lexsort((terms, -weights[terms], number))
        return Query(self.ids, np.searchsorted(number, np.arange(len(self.ids) + 1)), terms[order], self.hashes)

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """The chosen pairs, one per row, and for each place in ``terms`` the pair that begins there or -1."""
        place = np.arange(len(self.terms)) - np.repeat(self.first[:-1], np.diff(self.first))
        size = np.repeat(np.diff(self.first), np.diff(self.first))
        begins = np.flatnonzero((place % 2 == 0) & (place + 1 < size))
        at = np.full(len(self.terms), -1, dtype=np.int32)
        if not len(begins):
            return np.empty((0, 2), dtype=np.int32), at
        both = np.sort(np.stack((self.terms[begins], self.terms[begins + 1]), axis=1), axis=1)
        pairs, number = np.unique(both, axis=0, return_inverse=True)
        at[begins] = number.reshape(-1)
        return pairs, at


def _matched(batches: Iterator[pa.RecordBatch], hashes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Of each document with terms: their number, and which of ``hashes`` stand there how often."""
    powers, size = Powers(), len(hashes)
    for batch in batches:
        texts = octets(batch.column(1))
        n = np.zeros(len(texts), dtype=np.int64)
        keys, counts = [], []
        for first, text, found in _term_counts(texts, powers):
            n[first : first + 1 + (text[-1] if len(text) else 0)] += np.bincount(text, minlength=1)
            at = np.searchsorted(hashes, found)
            at[at == size] = 0
            known = hashes[at] == found if size else np.zeros(len(found), dtype=bool)
            key, count = np.unique((text[known] + first) * size + at[known], return_counts=True)
            keys.append(key)
            counts.append(count)
        key = np.concatenate(keys) if keys else np.zeros(0, dtype=np.int64)
        count = np.concatenate(counts) if counts else np.zeros(0, dtype=np.int64)
        if len(key) and (key[1:] <= key[:-1]).any():
            # A long text came in pieces.
            key, inverse = np.unique(key, return_inverse=True)
            count = np.bincount(inverse, count).astype(np.int64)
        text, term = np.divmod(key, max(size, 1))
        some = np.flatnonzero(n)
        offsets = np.append(np.searchsorted(text, some), len(text)).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pa.array(some)),
                pa.array(n[some]),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(term.astype(np.int32))),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(count.astype(np.int32))),
            ],
            names=["doc_id", "n", "terms", "counts"],
        )


def _runs(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin, and the end."""
    if not len(values):
        return np.zeros(1, dtype=np.int64)
    return np.concatenate(([0], np.flatnonzero(values[1:] != values[:-1]) + 1, [len(values)]))


@dataclass
class Shard:
    """Lists of some documents by term and by pair. ``starts`` and ``pair_starts`` are their borders."""

    terms: np.ndarray
    starts: np.ndarray
    docs: np.ndarray
    impacts: np.ndarray
    tops: np.ndarray
    pairs: np.ndarray
    pair_starts: np.ndarray
    pair_docs: np.ndarray
    pair_tops: np.ndarray

    @classmethod
    def built(cls, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, pairs: np.ndarray, n: int) -> Shard:
        order = np.argsort(term, kind="stable")
        term, doc, impact = term[order], doc[order], impact[order]
        starts = _runs(term)
        terms = term[starts[:-1]]
        tops = np.maximum.reduceat(impact, starts[:-1]) if len(terms) else impact[:0]
        at = np.searchsorted(terms, pairs)
        at[at == len(terms)] = 0
        there = (terms[at] == pairs).all(axis=1) if len(terms) else np.zeros(len(pairs), dtype=bool)
        held, value = np.zeros(n, dtype=bool), np.zeros(n, dtype=np.int64)
        number, docs, best = [], [], []
        for i in np.flatnonzero(there).tolist():
            a, b = at[i]
            if starts[a + 1] - starts[a] > starts[b + 1] - starts[b]:
                a, b = b, a
            first, other = slice(starts[a], starts[a + 1]), slice(starts[b], starts[b + 1])
            held[doc[first]], value[doc[first]] = True, impact[first]
            both = held[doc[other]]
            if both.any():
                found = doc[other][both]
                number.append(i)
                docs.append(found)
                best.append(int((value[found] + impact[other][both]).max()))
            held[doc[first]] = False
        return cls(
            terms, starts, doc, impact, tops,
            np.array(number, dtype=np.int32), np.cumsum([0, *map(len, docs)]),
            np.concatenate(docs) if docs else doc[:0], np.array(best, dtype=np.int64),
        )


_LISTS = {
    "terms": np.int32, "starts": np.int32, "docs": np.int32, "impacts": np.int64, "tops": np.int64,
    "pairs": np.int32, "pair_starts": np.int32, "pair_docs": np.int32, "pair_tops": np.int64,
}
_SHARDS = "shard long, doc_ids array<bigint>, " + ", ".join(
    f"{name} array<{'int' if kind == np.int32 else 'bigint'}>" for name, kind in _LISTS.items()
)


def _indexed(
    batches: Iterator[pa.RecordBatch], weights: np.ndarray, pairs: np.ndarray, postings: int
) -> Iterator[pa.RecordBatch]:
    """Shards of neighbouring documents; ``m`` is what a document's length adds."""
    number = TaskContext.get().partitionId() << 32
    waiting, size = [], 0

    def shard() -> pa.RecordBatch:
        ids = pa.concat_arrays([w[0] for w in waiting])
        doc = np.repeat(np.arange(len(ids)), np.concatenate([w[1] for w in waiting]))
        term, impact = (np.concatenate([w[i] for w in waiting]) for i in (2, 3))
        own = Shard.built(term, doc, impact, pairs, len(ids))
        lists = [pa.array([getattr(own, name).astype(kind)]) for name, kind in _LISTS.items()]
        whole = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), whole, *lists], names=["shard", "doc_ids", *_LISTS])

    for batch in batches:
        ids, m = batch.column(0), batch.column(1).to_numpy()
        lengths = batch.column(2).value_lengths().to_numpy()
        ends = np.cumsum(lengths)
        term = batch.column(2).flatten().to_numpy()
        tf = batch.column(3).flatten().to_numpy().astype(np.int64)
        impact = weights[term] * (1_000_000_000 * tf // (1000 * tf + 20 * np.repeat(m, lengths)))
        start = 0
        while start < len(ids):
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + postings - size, "right")))
            own = slice(done, ends[stop - 1])
            waiting.append((ids.slice(start, stop - start), lengths[start:stop], term[own], impact[own]))
            size += ends[stop - 1] - done
            start = stop
            if size >= postings or start < len(ids):
                yield shard()
                waiting, size, number = [], 0, number + 1
    if waiting:
        yield shard()


def _candidates(shard: Shard, units: list, order: np.ndarray, before: np.ndarray, least: int) -> np.ndarray:
    """Documents that can reach ``least``; ``before`` is what the units before each in ``order`` can add."""
    lists = []
    for j, u in enumerate(order.tolist()):
        alone, together = units[u]
        missing = least - before[j]
        short = False
        for a in alone:
            if shard.tops[a] >= missing:
                lists.append(shard.docs[shard.starts[a] : shard.starts[a + 1]])
            else:
                short = True
        if short and together is not None and shard.pair_tops[together] >= missing:
            lists.append(shard.pair_docs[shard.pair_starts[together] : shard.pair_starts[together + 1]])
    if not lists:
        return np.zeros(0, dtype=np.int32)
    return lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))


def best_of(shard: Shard, units: list, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents of a shard that score ``least`` or more, and their scores.

    A unit is ``(lists, pair)``: the lists of the terms that the shard has, and, of two terms, their
    intersection list, or None where no document holds both.
    """
    tops, pair_tops = shard.tops, shard.pair_tops
    bounds = np.array(
        [max(0 if pair is None else pair_tops[pair], max(tops[a] for a in lists)) for lists, pair in units], dtype=np.int64
    )
    order = np.argsort(bounds, kind="stable")
    before = np.cumsum(bounds[order]) - bounds[order]
    found = _candidates(shard, units, order, before, least)
    scores = np.zeros(len(found), dtype=np.int64)
    for j in range(len(order) - 1, -1, -1):
        for a in units[order[j]][0]:
            docs = shard.docs[shard.starts[a] : shard.starts[a + 1]]
            at = np.searchsorted(docs, found)
            at[at == len(docs)] = 0
            scores += np.where(docs[at] == found, shard.impacts[shard.starts[a] : shard.starts[a + 1]][at], 0)
        open_ = scores + before[j] >= least
        if not open_.all():
            found, scores = found[open_], scores[open_]
        if not len(found):
            break
    return found, scores


def _units(shard: Shard, terms: np.ndarray, pair_at: np.ndarray) -> list:
    at = np.searchsorted(shard.terms, terms)
    at[at == len(shard.terms)] = 0
    there = (shard.terms[at] == terms).tolist()
    lists = np.searchsorted(shard.pairs, pair_at)
    held = np.append(shard.pairs, -2)[lists] == pair_at
    at, lists, held, paired = at.tolist(), lists.tolist(), held.tolist(), (pair_at >= 0).tolist()
    units, i = [], 0
    while i < len(at):
        wide = 2 if paired[i] else 1
        both = [at[k] for k in range(i, i + wide) if there[k]]
        if both:
            units.append((both, lists[i] if paired[i] and held[i] else None))
        i += wide
    return units


def _searched(
    batches: Iterator[pa.RecordBatch], query: Query, pair_at: np.ndarray, least: np.ndarray, best: int
) -> Iterator[pa.RecordBatch]:
    """The best documents of each item over all shards of a task, none below ``least``."""
    least = least.copy()
    tops: list = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), []) for _ in query.ids]
    for batch in batches:
        for row in range(batch.num_rows):
            column = lambda name: batch.column(batch.schema.get_field_index(name))[row].values  # noqa: E731, B023
            shard = Shard(*[column(name).to_numpy() for name in _LISTS])
            ids = column("doc_ids")
            order = ids.fill_null(_FIRST).to_numpy()
            missing = ids.is_null().to_numpy(zero_copy_only=False)
            if not len(shard.terms):
                continue
            for i in range(len(query.ids)):
                own = slice(query.first[i], query.first[i + 1])
                units = _units(shard, query.terms[own], pair_at[own])
                if not units:
                    continue
                found, scores = best_of(shard, units, int(least[i]))
                if not len(found):
                    continue
                score, doc, null = tops[i]
                score, doc = np.append(score, scores), np.append(doc, order[found])
                null = np.append(np.asarray(null, dtype=bool), missing[found])
                keep = np.lexsort((doc, ~null, -score))[:best]
                tops[i] = score[keep], doc[keep], null[keep]
                if len(keep) == best:
                    least[i] = max(least[i], score[keep[-1]])
    task = TaskContext.get().partitionId()
    for i, (score, doc, null) in enumerate(tops):
        if len(score):
            yield pa.RecordBatch.from_pydict(
                {
                    "item": pa.array(np.full(len(score), i, dtype=np.int32)),
                    "item_id": pa.array([query.ids[i]] * len(score), pa.int64()),
                    "doc_id": pa.array(doc, mask=np.asarray(null, dtype=bool)),
                    "score": pa.array(score),
                    "task": pa.array(np.full(len(score), task, dtype=np.int32)),
                }
            )


def _ranked(found: DataFrame, best: int, *by: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)


def _looked(shards: DataFrame, query: Query, pair_at: np.ndarray, least: np.ndarray, best: int) -> DataFrame:
    found = shards.mapInArrow(
        partial(_searched, query=query, pair_at=pair_at, least=least, best=best),
        "item int, item_id long, doc_id long, score long, task int",
    )
    merged = _ranked(found.withColumn("part", F.expr(f"pmod(hash(task), {MERGED})")), best, "item", "part")
    return _ranked(merged.drop("rank"), best, "item")


def searched(docs: DataFrame, query: Query, best: int = BEST, postings: int = POSTINGS) -> DataFrame:
    """``(item_id, rank, doc_id, score)`` of the items of one pass over all documents."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    matched = stored(
        rows.mapInArrow(
            partial(_matched, hashes=query.hashes), "doc_id long, n long, terms array<int>, counts array<int>"
        ),
        "matched",
    )
    n, length = matched.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = matched.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).toPandas()
    weights = np.zeros(len(query.hashes), dtype=np.int64)
    weights[held["term"]] = [math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) for df in held["df"].tolist()]
    query = query.weighed(weights)
    pairs, pair_at = query.pairs()
    # Decimals: the product outgrows 64 bits where its quotient does not.
    m = f"50 + (CAST(n AS DECIMAL(38, 0)) * CAST(50 AS DECIMAL(38, 0)) * {n}BD) div {max(length, 1)}BD AS m"
    shards = stored(
        matched.where("size(terms) > 0")
        .selectExpr("doc_id", m, "terms", "counts")
        .mapInArrow(partial(_indexed, weights=weights, pairs=pairs, postings=postings), _SHARDS),
        "shards",
    )
    least = np.ones(len(query.ids), dtype=np.int64)
    some = max(1, shards.count() // FIRST_LOOK)
    if some > 1:
        first = _looked(shards.where(f"pmod(xxhash64(shard), {some}) = 0"), query, pair_at, least, best)
        last = first.where(F.col("rank") == best).select("item", "score").toPandas()
        least[last["item"]] = np.maximum(last["score"], 1)
    found = _looked(shards, query, pair_at, least, best)
    return found.select("item_id", "rank", "doc_id", "score")


def ranked(
    docs: DataFrame, items: DataFrame, best: int = BEST, postings: int = POSTINGS, terms_a_pass: int = TERMS_A_PASS
) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: each item's ``best`` documents with a score above 0."""
    terms = stored(
        items.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
        .mapInArrow(_item_terms, "item_id long, hash long")
        .distinct(),
        "item_terms",
    )
    passes = max(1, -(-terms.count() // terms_a_pass))
    found = None
    for number in range(passes):
        own = terms.where(f"pmod(xxhash64(item_id), {passes}) = {number}")
        result = searched(docs, Query.of(own.toArrow()), best, postings)
        found = result if found is None else found.union(result)
    return found
