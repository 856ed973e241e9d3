"""Benchmark decontamination: BM25 over test items with block-max WAND, then a check of both parts.

Spark builds the index: test items are cut into units of at most ``UNIT`` words, a posting holds the
share of the unit's own BM25 score that a term brings. Every document is cut into overlapping
passages, long enough that each unit that a document holds is inside one. A passage asks the index
for all units whose score reaches the threshold. First the terms' greatest shares are summed; only
where they reach it the posting lists are read, with block maxima to skip what cannot. An item that
is found this way counts if enough of the trigrams of its question and of the words of its answer stand near
one of the passages that retrieved it: no further before or behind it than the item is long.

The index is dealt over shards of at most ``SHARD`` units by item, and the documents meet one shard
after the other, so what a task holds of the index has a fixed bound.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.arrow import octets, sliced
from plumbline.llm.stored import stored
from plumbline.llm.tokens import Powers, hashes, mixed, parts, words

UNIT, PASSAGE, STRIDE = 32, 64, 32
K1, B = 1.2, 0.75
THRESHOLD, OVERLAP = 0.5, 0.6
SHARD, BLOCK = 4096, 64
#: Words that are compared together in questions and in answers; an answer may be very short.
GRAMS = (3, 1)
#: Columns into which units are folded where passages are bounded.
FOLD = 1024
#: Words of a long text that are searched together.
SEARCHED = 1 << 14

# Letters, digits and the bytes of longer characters make words.
_APART = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def _folded(column: pa.Array) -> list[bytes | None]:
    return octets(pc.utf8_lower(column))


def _terms(texts: list[bytes | None], powers: Powers):
    return words(texts, powers, _APART)


def _grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Distinct hashes of ``size`` neighbouring words, of all words where there are fewer."""
    size = min(size, len(hashes))
    if not size:
        return hashes[:0]
    last = len(hashes) - size + 1
    out = np.zeros(last, dtype=np.uint64)
    for i in range(size):
        out = mixed(out * np.uint64(31) + hashes[i : last + i])
    return np.unique(out)


def _question_and_answer(text: bytes) -> tuple[bytes, bytes]:
    """The last sentence is the answer; of a single sentence it is the second half of the words."""
    bare = text.rstrip(b" \t\r\n.?!")
    cut = max(bare.rfind(c) for c in (b". ", b"? ", b"! ", b"\n", b".\n"))
    if cut >= 0 and bare[: cut + 1].strip(b" \t\r\n.?!"):
        return bare[: cut + 1], bare[cut + 1 :]
    pieces = bare.split()
    half = (len(pieces) + 1) // 2
    return b" ".join(pieces[:half]), b" ".join(pieces[half:])


def _units_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers = Powers()
    for batch in batches:
        out = {"item_id": [], "unit": [], "term": [], "tf": [], "length": []}
        for item, text in zip(batch.column(0).to_pylist(), _folded(batch.column(1))):
            found = _terms([text], powers).hashes
            n = -(-len(found) // UNIT)
            for unit, part in enumerate(np.array_split(found, n) if n else ()):
                terms, counts = np.unique(part, return_counts=True)
                out["item_id"] += [item] * len(terms)
                out["unit"] += [unit] * len(terms)
                out["term"] += terms.view(np.int64).tolist()
                out["tf"] += counts.tolist()
                out["length"] += [len(part)] * len(terms)
        yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64()) for k, v in out.items()})


def index(items: DataFrame, text: str = "text") -> DataFrame:
    """Postings ``(item_id, unit, term, share)``: a term's part of the unit's own BM25 score."""
    rows = stored(
        items.where("item_id IS NOT NULL")
        .select(F.col("item_id").cast("long"), F.col(text).cast("string"))
        .distinct()
        .mapInArrow(_units_of, "item_id long, unit long, term long, tf long, length long"),
        "units",
    )
    units = rows.select("item_id", "unit", "length").distinct()
    number, mean = units.agg(F.count("*"), F.coalesce(F.avg("length"), F.lit(1.0))).first()
    held = rows.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log(1 + (F.lit(number) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    saturation = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / F.lit(mean)))
    weighted = rows.join(held, "term").withColumn("weight", idf * saturation)
    own = weighted.groupBy("item_id", "unit").agg(F.sum("weight").alias("own"))
    return weighted.join(own, ["item_id", "unit"]).select(
        "item_id", "unit", "term", (F.col("weight") / F.col("own")).alias("share")
    )


class Index:
    """Posting lists of one shard, with the greatest share of each list and of each block."""

    def __init__(self, postings, items):
        self.items = postings[["item_id", "unit"]].drop_duplicates().to_numpy()
        number = {tuple(x): i for i, x in enumerate(self.items.tolist())}
        terms = postings["term"].to_numpy().view(np.uint64)
        unit = np.array([number[x] for x in zip(postings["item_id"], postings["unit"])], dtype=np.int64)
        order = np.lexsort((unit, terms))
        terms, unit, share = terms[order], unit[order], postings["share"].to_numpy()[order]
        self.terms, first = np.unique(terms, return_index=True)
        self.greatest = np.maximum.reduceat(share, first) if len(first) else share
        bounds = [*first.tolist(), len(terms)]
        self.lists = []
        for a, b in zip(bounds[:-1], bounds[1:]):
            blocks = [float(share[i : min(i + BLOCK, b)].max()) for i in range(a, b, BLOCK)]
            self.lists.append((unit[a:b].tolist(), share[a:b].tolist(), blocks))
        sizes = np.diff(bounds)
        self.columns = int(min(FOLD, max(1, len(self.items))))
        # Terms of several blocks: their greatest share in each column.
        frequent = np.flatnonzero(sizes > BLOCK)
        self.frequent = np.full(len(sizes), -1)
        self.frequent[frequent] = np.arange(len(frequent))
        self.most = np.zeros((len(frequent), self.columns), dtype=np.float32)
        for row, t in enumerate(frequent.tolist()):
            own = slice(bounds[t], bounds[t + 1])
            np.maximum.at(self.most[row], unit[own] % self.columns, share[own])
        self.first, self.sizes, self.unit, self.share = np.array(bounds[:-1], dtype=np.int64), sizes, unit, share
        self.bits = np.zeros(1 << 20, dtype=bool)
        self.bits[(self.terms & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        powers = Powers()
        self.parts, self.reach = {}, {}
        for item, text in items:
            pair = _question_and_answer(text or b"")
            hashes = [_terms([p], powers).hashes for p in pair]
            self.parts[item] = [(min(g, len(h)), _grams(h, g)) for g, h in zip(GRAMS, hashes)]
            self.reach[item] = sum(map(len, hashes))

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The term number of each word, or -1."""
        out = np.full(len(hashes), -1, dtype=np.int64)
        if not len(self.terms):
            return out
        maybe = np.flatnonzero(self.bits[(hashes & np.uint64((1 << 20) - 1)).astype(np.int64)])
        at = np.searchsorted(self.terms, hashes[maybe])
        at[at == len(self.terms)] = 0
        same = self.terms[at] == hashes[maybe]
        out[maybe[same]] = at[same]
        return out

    def search(self, query: list[int], threshold: float) -> dict[int, float]:
        """Block-max WAND: all units whose score for the query's distinct terms reaches the threshold."""
        cursors = [[self.lists[t][0][0], 0, float(self.greatest[t]), t] for t in query]
        found = {}
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, -1
            for k, cursor in enumerate(cursors):
                bound += cursor[2]
                if bound >= threshold - 1e-9:
                    pivot = k
                    break
            if pivot < 0:
                break
            unit = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == unit:
                pivot += 1
            upper, until = 0.0, None
            for cursor in cursors[: pivot + 1]:
                units, _, blocks = self.lists[cursor[3]]
                at = bisect_left(units, unit, cursor[1])
                if at < len(units):
                    block = at // BLOCK
                    upper += blocks[block]
                    end = units[min((block + 1) * BLOCK, len(units)) - 1]
                    until = end if until is None else min(until, end)
            if upper >= threshold - 1e-9:
                target = unit
                if cursors[0][0] == unit:
                    score = 0.0
                    for cursor in cursors[: pivot + 1]:
                        score += self.lists[cursor[3]][1][cursor[1]]
                    if score >= threshold - 1e-9:
                        found[unit] = score
                    target = unit + 1
            else:
                # Nothing before the end of the shortest block, or the next list, can reach it.
                target = (until if until is not None else unit) + 1
                if pivot + 1 < len(cursors):
                    target = min(target, cursors[pivot + 1][0])
                target = max(target, unit + 1)
            left = []
            for k, cursor in enumerate(cursors):
                if k <= pivot and cursor[0] < target:
                    units = self.lists[cursor[3]][0]
                    cursor[1] = bisect_left(units, target, cursor[1])
                    if cursor[1] >= len(units):
                        continue
                    cursor[0] = units[cursor[1]]
                left.append(cursor)
            cursors = left
        return found

    def candidates(
        self, hashes: np.ndarray, first: np.ndarray, threshold: float
    ) -> list[dict[int, list[tuple[float, int, int]]]]:
        """For each text the items whose units its passages retrieve, with score, start and end of each passage."""
        number = self.numbers(hashes)
        spans = [
            (t, s, min(s + PASSAGE, b))
            for t, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist()))
            for s in range(a, max(a + 1, b - PASSAGE + STRIDE), STRIDE)
        ]
        out: list[dict[int, list]] = [{} for _ in first[1:]]
        for k in np.flatnonzero(self._bounds(number, first) >= threshold - 1e-4).tolist():
            t, s, e = spans[k]
            own = number[s:e]
            best: dict[int, float] = {}
            for unit, score in self.search(np.unique(own[own >= 0]).tolist(), threshold).items():
                item = int(self.items[unit, 0])
                best[item] = max(best.get(item, 0.0), score)
            for item, score in best.items():
                out[t].setdefault(item, []).append((score, s, e))
        return out

    def retrieved(self, hashes: np.ndarray, first: np.ndarray, threshold: float) -> list[dict[int, list]]:
        """:meth:`candidates` of texts; a long one is searched in runs of ``SEARCHED`` words. Runs begin where a
        passage does and share the words of their last passage, so the passages are the same."""
        if len(first) != 2 or first[1] - first[0] <= SEARCHED + STRIDE:
            return self.candidates(hashes, first, threshold)
        out: dict[int, list] = {}
        # A last run of no more than a stride holds no passage of its own.
        for start in range(0, len(hashes) - PASSAGE + STRIDE, SEARCHED):
            own = hashes[start : start + SEARCHED + PASSAGE - STRIDE]
            (found,) = self.candidates(own, np.array([0, len(own)]), threshold)
            for item, places in found.items():
                out.setdefault(item, []).extend((score, s + start, e + start) for score, s, e in places)
        return [out]

    def verified(self, item: int, own: np.ndarray, places: list[tuple[float, int, int]]) -> list[float]:
        """The shares of an item's question and answer near the passage that has most of both; ``own`` are
        the words of the text."""
        best = [0.0, 0.0]
        for _, s, e in places:
            near = own[max(0, s - self.reach[item]) : e + self.reach[item]]
            shares = [float(np.isin(grams, _grams(near, size)).mean()) if size else 1.0 for size, grams in self.parts[item]]
            best = max(best, shares, key=lambda x: (min(x), sum(x)))
        return best

    def _bounds(self, number: np.ndarray, first: np.ndarray) -> np.ndarray:
        """For each passage at least the score of its best unit."""
        sizes = np.diff(first)
        passages = np.maximum(1, -(-(sizes - PASSAGE) // STRIDE) + 1)
        before = np.concatenate(([0], np.cumsum(passages)))
        total = int(before[-1])
        known = np.flatnonzero(number >= 0)
        if not len(known):
            return np.zeros(total)
        term = number[known]
        text = np.searchsorted(first, known, side="right") - 1
        at = (known - first[text]) // STRIDE
        held_by = np.zeros((total, len(self.most)), dtype=np.float32)
        cells = np.zeros(total * self.columns)
        # With passages of two strides a word is in the passage of its stride and in the one before.
        for back in range(PASSAGE // STRIDE):
            place = at - back
            inside = (place >= 0) & (place < passages[text])
            passage = before[text[inside]] + place[inside]
            held = term[inside]
            few = self.frequent[held] < 0
            held_by[passage[~few], self.frequent[held[~few]]] = 1
            passage, held = passage[few], held[few]
            n = self.sizes[held]
            posting = np.repeat(self.first[held] - np.cumsum(n) + n, n) + np.arange(n.sum())
            cell = np.repeat(passage * self.columns, n) + self.unit[posting] % self.columns
            cells += np.bincount(cell, self.share[posting], len(cells))
        return (cells.reshape(total, self.columns) + held_by @ self.most).max(axis=1)


def _leaks_of(
    batches: Iterator[pa.RecordBatch], shard: Index, threshold: float, overlap: float
) -> Iterator[pa.RecordBatch]:
    powers = Powers()
    for batch in sliced(batches, 1):
        ids, texts = batch.column(0).to_pylist(), _folded(batch.column(1))
        keys = batch.column(2).to_pylist()
        rows = []
        for a, b in parts(texts):
            own_hashes, first = hashes(texts[a:b], powers, _APART)
            for i, items in enumerate(shard.retrieved(own_hashes, first, threshold)):
                if not items:
                    continue
                start = int(first[i])
                own = own_hashes[start : first[i + 1]]
                for item, places in items.items():
                    shares = shard.verified(item, own, [(score, s - start, e - start) for score, s, e in places])
                    if min(shares) >= overlap:
                        rows.append((ids[a + i], keys[a + i], item, max(p[0] for p in places), *shares))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)],
            names=["doc_id", "text_hash", "item_id", "score", "question_overlap", "answer_overlap"],
        )


def leaks(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    threshold: float = THRESHOLD,
    overlap: float = OVERLAP,
) -> DataFrame:
    """``(doc_id, text_hash, item_id, score, question_overlap, answer_overlap)`` for every document
    and test item that it holds; ``items`` has ``item_id`` and ``text``.

    ``score`` is the best share of a unit's BM25 score in a passage, the overlaps are those near one passage. Case, punctuation and white
    space do not matter. Null, empty and blank texts hold nothing and items without words are held
    by nothing; items without an id are left out. Repeated rows of documents repeat, repeated items
    do not. Documents without an id are searched too and named by ``text_hash``. Other columns are
    not read. A long text is hashed in pieces of a megabyte and searched in runs of ``SEARCHED`` words.
    """
    named = items.where("item_id IS NOT NULL").select(
        F.col("item_id").cast("long"), F.col("text").cast("string")
    )
    postings = stored(index(named), "postings")
    count = postings.select("item_id", "unit").distinct().count()
    shards = max(1, -(-count // SHARD))
    searched = docs.select(
        F.col("doc_id").cast("long"),
        F.col(text).cast("string").alias("text"),
        F.xxhash64(F.col(text).cast("string")).alias("text_hash"),
    )
    found = []
    for k in range(shards):
        own = F.pmod(F.xxhash64("item_id"), F.lit(shards)) == k
        # Of items that repeat an id with another text, the greatest text counts for the check.
        texts = named.where(own).groupBy("item_id").agg(F.max("text").alias("text")).toPandas()
        folded = _folded(pa.array(texts["text"].tolist(), pa.string()))
        pairs = list(zip(texts["item_id"].astype(int).tolist(), folded))
        shard = Index(postings.where(own).toPandas(), pairs)
        found.append(
            searched.mapInArrow(
                partial(_leaks_of, shard=shard, threshold=threshold, overlap=overlap),
                "doc_id long, text_hash long, item_id long, score double, question_overlap double,"
                " answer_overlap double",
            )
        )
    return reduce(DataFrame.unionByName, found)


def decontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no test item, unchanged."""
    held = stored(leaks(docs, items).select("text_hash").distinct(), "leaks")
    return docs.join(held, F.xxhash64(F.col("text").cast("string")) == held["text_hash"], "left_anti")
