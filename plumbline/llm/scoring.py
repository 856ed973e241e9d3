"""Language-model scores of documents by logistic context mixing over their whole texts.

1. Words are counted over all training documents, those whose ``crc32(id) mod 10`` is not 0.
2. The contexts of all training texts fill the predictors' tables, whose size follows the number of
   distinct words; each task adds up what it reads, the tasks' cells are added slot block by slot block.
3. Every task learns a mixer online from all its training texts; weights are averaged by how much was
   learned in each gate, what the refining tables gathered is added.
4. Each whole text is coded in its task as one stream of bytes.
5. For the unigram score a document adds up its words. The most frequent words, at most ``FREQUENT``,
   are known to every task; the others of each document are joined with the table of words.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.arrow import octets, sliced
from plumbline.llm.mixing import (
    END,
    GATES,
    STEPS,
    Mixer,
    gathered,
    in_lines,
    in_order,
    nodes_of,
    odds_and_trust,
    own_slots,
    paired,
    slots_of,
    step_for,
    trust_left,
)
from plumbline.llm.stored import stored
from plumbline.llm.tokens import Powers, parts, words

#: Words that every task knows.
FREQUENT = 1 << 17
#: Slots that are added together, and bytes after which a task hands its counts on.
SLOT_BLOCK, HANDED_ON = 1 << 14, 1 << 28

#: Bytes of texts that are coded together; their words are known once.
TOGETHER = 1 << 19

_END_HASH = -1
#: Type of the large counts of all tasks together.
_TOTAL = "<f4"


def _counts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words of each batch, with their occurrences in training documents."""
    powers = Powers()
    for batch in sliced(batches, 1):
        train = np.array(batch.column(0).to_pylist(), dtype=bool)
        texts = octets(batch.column(1))
        for a, b in parts(texts, 1 << 20):
            found = words(texts[a:b], powers)
            sizes = np.diff(found.first)
            weight = np.repeat(train[a:b], sizes)
            order, new = in_order(found.hashes)
            first = np.flatnonzero(new)
            at = order[first]
            hashes = found.hashes[at]
            n = np.add.reduceat(weight[order], first, dtype=np.int64) if len(first) else np.zeros(0, dtype=np.int64)
            data = found.data.tobytes()
            spelled = [data[s:e] for s, e in zip(found.starts[at].tolist(), found.ends[at].tolist())]
            yield pa.RecordBatch.from_pydict(
                {
                    "hash": pa.array(np.append(hashes.view(np.int64), _END_HASH)),
                    "word": pa.array([*spelled, END], pa.binary()),
                    "n": pa.array(np.append(n, int(train[a:b].sum()))),
                }
            )


def _form(text: bytes | None) -> bytes:
    """What is coded of a text: its words, each with a blank behind it, and the end."""
    return b" ".join([*(text or b"").lower().split(), END])


def _forms_of(batches: Iterator[pa.RecordBatch]) -> Iterator[list[bytes]]:
    for batch in sliced(batches, 0):
        texts = octets(batch.column(0))
        for a, b in parts(texts, TOGETHER):
            yield [_form(t) for t in texts[a:b]]


def _packed(part: np.ndarray, large: str) -> bytes:
    """The cells of a slot block: a bit for each that is not zero, a byte for each count, and counts from 255 on
    in full, in the given type."""
    cells = part > 0
    counts = part[cells]
    most = counts[counts >= 255].astype(large)
    return np.packbits(cells).tobytes() + np.minimum(counts, 255).astype(np.uint8).tobytes() + most.tobytes()


def _unpacked(found: bytes, large: str) -> np.ndarray:
    """Zeros and ones of a slot block."""
    part = np.zeros(2 * SLOT_BLOCK, dtype=np.float32 if large == _TOTAL else float)
    bits = len(part) // 8
    cells = np.flatnonzero(np.unpackbits(np.frombuffer(found, np.uint8, bits)))
    counts = np.frombuffer(found, np.uint8, len(cells), bits).astype(part.dtype)
    counts[counts == 255] = np.frombuffer(found[bits + len(cells) :], large)
    part[cells] = counts
    return part.reshape(2, -1)


def _cells_of(tables: np.ndarray, large: str = "<u4") -> pa.RecordBatch:
    """The cells that are not zero, by slot block, packed; ``tables`` are zeros and ones, or their leaves."""
    blocks, found = [], []
    for first in range(0, tables.shape[-1], SLOT_BLOCK):
        own = tables[..., first : first + SLOT_BLOCK]
        if own.any():
            own = nodes_of(own, first) if own.ndim == 1 else own
            part = np.zeros((2, SLOT_BLOCK), dtype=tables.dtype)
            part[:, : own.shape[1]] = own
            blocks.append(first)
            found.append(_packed(part, large))
    return pa.RecordBatch.from_pydict({"block": pa.array(blocks, pa.int64()), "counts": pa.array(found, pa.binary())})


@dataclass
class Counts:
    """Zeros and ones by slot, in packed slot blocks. The driver hands them to the tasks as they are; a task
    unpacks the form it needs once, block by block, and lets go of each."""

    slots: int
    blocks: dict[int, bytes]
    #: Whether this is a task's own copy.
    own: bool = False

    def __reduce__(self) -> tuple:
        return Counts, (self.slots, self.blocks, True)

    @classmethod
    def of(cls, tables: np.ndarray) -> Counts:
        cells = _cells_of(tables, _TOTAL)
        return cls(tables.shape[1], dict(zip(cells["block"].to_pylist(), cells["counts"].to_pylist())))

    def parts(self) -> Iterator[tuple[int, np.ndarray]]:
        for first in list(self.blocks):
            found = self.blocks.pop(first) if self.own else self.blocks[first]
            yield first, _unpacked(found, _TOTAL)[:, : self.slots - first]

    def tables(self) -> np.ndarray:
        tables = np.zeros((2, self.slots), dtype=np.float32)
        for first, part in self.parts():
            tables[:, first : first + part.shape[1]] = part
        return tables

    def pairs(self) -> np.ndarray:
        """What :func:`plumbline.llm.mixing.paired` makes of the tables."""
        return self.left()[0]

    def left(self) -> tuple[np.ndarray, np.ndarray]:
        """What :meth:`plumbline.llm.mixing.Mixer.learn` needs to know of the counts."""
        pairs = in_lines(self.slots, np.complex64)
        steps = np.zeros((own_slots(self.slots), 2), dtype=np.int8)
        start = self.slots - len(steps)
        for first, part in self.parts():
            end = first + part.shape[1]
            pairs[first:end] = paired(part)
            if end > start:
                low = max(first, start)
                steps[low - start : end - start] = trust_left(part[:, low - first :])
        return pairs, steps

    def odds(self) -> tuple[np.ndarray, np.ndarray]:
        """What :func:`plumbline.llm.mixing.log_odds` makes of the tables."""
        odds = in_lines(self.slots, np.float32)
        seen = np.zeros(own_slots(self.slots), dtype=np.int8)
        start = self.slots - len(seen)
        for first, part in self.parts():
            end = first + part.shape[1]
            odds[first:end], trust = odds_and_trust(part)
            if end > start:
                low = max(first, start)
                seen[low - start : end - start] = trust[low - first :]
        return odds, seen


def _tables_of(batches: Iterator[pa.RecordBatch], slots: int) -> Iterator[pa.RecordBatch]:
    powers, leaves, size = Powers(), np.zeros(slots, dtype=np.uint32), 0
    for forms in _forms_of(batches):
        gathered(forms, np.ones(len(forms)), leaves, powers)
        size += sum(map(len, forms))
        if size >= HANDED_ON:
            yield _cells_of(leaves)
            leaves[:], size = 0, 0
    yield _cells_of(leaves)


def _added(rows: pa.Table) -> pa.Table:
    total = sum(_unpacked(found, "<u4") for found in rows.column("counts").to_pylist())
    return pa.table(
        {
            "block": rows.column("block").slice(0, 1),
            "counts": pa.array([total.astype(np.float32).tobytes()], pa.binary()),
        }
    )


def _added_packed(rows: pa.Table) -> pa.Table:
    total = np.frombuffer(_added(rows).column("counts")[0].as_py(), np.float32)
    return pa.table(
        {"block": rows.column("block").slice(0, 1), "counts": pa.array([_packed(total, _TOTAL)], pa.binary())}
    )


def counts_of(texts: DataFrame, step: int) -> Counts:
    """Zeros and ones by slot, from the column ``text`` of all rows; their size is bounded by that of the step."""
    slots = slots_of(step)
    rows = (
        texts.select("text")
        .mapInArrow(partial(_tables_of, slots=slots), "block long, counts binary")
        .groupBy("block")
        .applyInArrow(_added_packed, "block long, counts binary")
        .toArrow()
    )
    return Counts(slots, dict(zip(rows["block"].to_pylist(), rows["counts"].to_pylist())))


def predictors(texts: DataFrame, step: int) -> np.ndarray:
    """The counts of :func:`counts_of` as an array."""
    return counts_of(texts, step).tables()


def _learned_of(batches: Iterator[pa.RecordBatch], counts: Counts) -> Iterator[pa.RecordBatch]:
    """What a task learned, a row per gate: how much, the weights times that, the refining counts."""
    powers, mixer, first, tables = Powers(), Mixer(), Mixer(), counts.left()
    seen = np.zeros(GATES)
    for forms in _forms_of(batches):
        seen += mixer.learn(forms, np.ones(len(forms)), tables, powers)
    rows = np.concatenate(
        (seen[:, None], mixer.weights * seen[:, None], mixer.ones - first.ones, mixer.total - first.total), axis=1
    )
    own = np.flatnonzero(seen)
    yield pa.RecordBatch.from_pydict(
        {"gate": pa.array(own, pa.int32()), "sums": pa.array([r.tobytes() for r in rows[own]], pa.binary())}
    )


def _gate_added(rows: pa.Table) -> pa.Table:
    found = np.stack([np.frombuffer(r, float) for r in rows.column("sums").to_pylist()])
    # In order of size, the sum does not depend on the order of tasks.
    total = np.sort(found, axis=0).sum(axis=0)
    return pa.table({"gate": rows.column("gate").slice(0, 1), "sums": pa.array([total.tobytes()], pa.binary())})


def learned(texts: DataFrame, counts: Counts | np.ndarray) -> Mixer:
    """A mixer that has read the column ``text`` of all rows once, each partition from the same start."""
    counts = counts if isinstance(counts, Counts) else Counts.of(counts)
    rows = (
        texts.select("text")
        .mapInArrow(partial(_learned_of, counts=counts), "gate int, sums binary")
        .groupBy("gate")
        .applyInArrow(_gate_added, "gate int, sums binary")
        .toPandas()
    )
    mixer = Mixer()
    for gate, sums in zip(rows["gate"], rows["sums"]):
        seen, weights, ones, total = np.split(
            np.frombuffer(sums, float), np.cumsum([1, mixer.weights.shape[1], STEPS])
        )
        mixer.weights[gate] = weights / seen
        mixer.ones[gate] += ones
        mixer.total[gate] += total
    return mixer


def _summed(
    batches: Iterator[pa.RecordBatch], table: tuple, smoothing: tuple, mixer: Mixer, counts: Counts
) -> Iterator[pa.RecordBatch]:
    """For each row its code's length and its frequent words summed up, and one row for each of its other
    words."""
    frequent, n = table
    base = _base(n, *smoothing)
    end = int(np.searchsorted(frequent, np.uint64(2**64 - 1)))
    powers, odds = Powers(), counts.odds()
    for batch in sliced(batches, 1):
        keys, texts = batch.column(0).to_numpy(), octets(batch.column(1))
        for a, b in parts(texts, TOGETHER):
            found = words(texts[a:b], powers)
            forms = [_form(t) for t in texts[a:b]]
            sizes = np.array([len(form) for form in forms], dtype=np.int64)
            bits = mixer.lengths(forms, *odds, powers)
            count = np.diff(found.first)
            # Equal words side by side, and those of a text in them: a word is looked up once.
            order, new = in_order(found.hashes)
            distinct, which = found.hashes[order[new]], np.cumsum(new) - 1
            text = np.repeat(np.arange(b - a), count)[order]
            at = np.searchsorted(frequent, distinct)
            at[at == len(frequent)] = 0
            known = (frequent[at] == distinct)[which]
            own, of = at[which[known]], text[known]
            size = b - a
            rare = np.flatnonzero(~known)
            rare_hash, rare_text = distinct[which[rare]], text[rare]
            new = np.ones(len(rare), dtype=bool)
            new[1:] = (rare_hash[1:] != rare_hash[:-1]) | (rare_text[1:] != rare_text[:-1])
            first = np.flatnonzero(new)
            times = np.diff(np.append(first, len(rare)))
            zero = np.zeros(len(first))
            nothing = np.zeros(len(first), dtype=np.int64)
            yield pa.RecordBatch.from_pydict(
                {
                    "row_key": pa.array(np.concatenate((keys[a:b], keys[a:b][rare_text[first]]))),
                    # A row of sums has its own key here, which spreads it and meets no word.
                    "hash": pa.array(np.concatenate((keys[a:b], rare_hash[first].view(np.int64)))),
                    "times": pa.array(np.concatenate((np.zeros(size, dtype=np.int64), times))),
                    "ends": pa.array(np.concatenate((np.ones(size, dtype=np.int64), nothing))),
                    "tokens": pa.array(np.concatenate((count + 1, nothing))),
                    "known": pa.array(
                        np.concatenate(
                            (np.bincount(of, n[own] > 0, size).astype(np.int64) + int(n[end] > 0), nothing)
                        )
                    ),
                    "base": pa.array(np.concatenate((np.bincount(of, base[own], size) + base[end], zero))),
                    "bits": pa.array(np.concatenate((bits, zero))),
                    "bytes": pa.array(np.concatenate((sizes, nothing))),
                }
            )


def _least_frequent(vocabulary: DataFrame, most: int = FREQUENT) -> int:
    """A count that at most ``most`` words reach, from a histogram in eighths of powers of two."""
    steps = F.ceil(F.log2("n") * 8).cast("int")
    rows = vocabulary.where("n > 0").groupBy(steps.alias("step")).agg(F.count("*").alias("words")).collect()
    total, least = 0, None
    for row in sorted(rows, key=lambda r: -r["step"]):
        total += row["words"]
        if total >= most:
            break
        least = row["step"]
    # A word of a step has more than the greatest count of the step below.
    return 2**62 if least is None else math.floor(2 ** ((least - 1) / 8)) + 1


def _base(n, tokens: int, distinct: int):
    return np.log10((n + 0.1) / (tokens + 0.1 * (distinct + 1)))


def scored(docs: DataFrame, text: str = "text") -> DataFrame:
    """Scores of every row: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    bits_per_byte``.

    Tokens are the words between ASCII white space, A-Z in lower case, and one end. ``score`` is the
    model's log10 probability of the words in their order and the end, ``bits_per_byte`` its bits over the bytes that
    were coded: the words, a blank behind each, and the end. A null or empty text is an end only. Repeated rows repeat their
    scores and count in training each time; so do rows that share an id. A row without an id counts as
    training. Without any training row every count is zero. Other columns are not read.
    """
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("long").cast("string")) % 10 == 0, F.lit(False))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col(text).cast("string").alias("text"),
        held_out.alias("held_out"),
    )
    keyed = rows.withColumn("row_key", F.xxhash64("doc_id", "text"))
    vocabulary = stored(
        rows.select(~F.col("held_out"), "text")
        .mapInArrow(_counts_of, "hash long, word binary, n long")
        .groupBy("hash", "word")
        .agg(F.sum("n").alias("n")),
        "words",
    )
    totals = vocabulary.where("n > 0").agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    smoothing = (int(totals[0]), int(totals[1]))
    train = rows.where("NOT held_out")
    counts = counts_of(train, step_for(smoothing[1]))
    mixer = learned(train, counts)
    most = (F.col("hash") == _END_HASH) | (F.col("n") >= _least_frequent(vocabulary))
    top = vocabulary.where(most).select("hash", "n").toPandas()
    if not len(top):
        top.loc[0] = [_END_HASH, 0]
    frequent = top["hash"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(frequent)
    table = (frequent[order], top["n"].to_numpy(float)[order])
    sums = keyed.select("row_key", "text").mapInArrow(
        partial(_summed, table=table, smoothing=smoothing, mixer=mixer, counts=counts),
        "row_key long, hash long, times long, ends long, tokens long, known long, base double, bits double,"
        " bytes long",
    )
    others = vocabulary.select("hash", F.col("n").alias("c"))
    floor = smoothing[0] + 0.1 * (smoothing[1] + 1)
    rare = F.col("times") > 0
    joined = sums.join(others, "hash", "left").select(
        "row_key",
        "ends",
        "tokens",
        "bytes",
        F.when(rare & (F.col("c") > 0), F.col("times")).otherwise(F.col("known")).alias("known"),
        F.when(rare, F.col("times") * F.log10((F.col("c") + 0.1) / floor)).otherwise(F.col("base")).alias("base"),
        "bits",
    )
    added = joined.groupBy("row_key").agg(
        *[F.sum(c).alias(c) for c in ("ends", "tokens", "bytes", "known", "base", "bits")]
    )
    # Equal rows have added up under one key, each with one end.
    one = {c: F.col(c) / F.col("ends") for c in ("tokens", "bytes", "known", "base", "bits")}
    return (
        keyed.select("doc_id", "held_out", "row_key")
        .join(added, "row_key")
        .select(
            "doc_id",
            "held_out",
            one["tokens"].cast("long").alias("n_tokens"),
            one["known"].cast("long").alias("n_known"),
            F.lit(smoothing[0]).cast("long").alias("train_tokens"),
            one["base"].alias("base_score"),
            (-one["bits"] * F.lit(math.log10(2))).alias("score"),
            (one["bits"] / one["bytes"]).alias("bits_per_byte"),
        )
    )
