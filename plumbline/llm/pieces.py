"""SentencePiece encoding and decoding for vocabularies of merges.

Adjacent symbols that form a piece wait in an agenda ordered by the piece's score, then by place;
the best pair is merged, its new neighbours enter the agenda, and outdated entries are skipped.

Where no piece of the vocabulary reaches across (before a word, around a line feed, between a letter
and most punctuation) a text falls into segments that are encoded on their own and remembered. The sentencepiece library encodes every segment that
an Arrow batch adds to the memory; where it disagreed its ids would count, and ``n_differing``
would tell.
"""

from __future__ import annotations

import hashlib
import re
import sys
from array import array
from collections.abc import Iterator
from functools import partial
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.arrow import chunks, sliced

SPACE = "▁"

#: Characters that count as letters where a text is parted.
LETTER = "[A-Za-zÀ-ÖØ-öø-ɏ]"
NONE = 1 << 40

#: Segments that a Python worker remembers, and the longest remembered one.
REMEMBERED, LONGEST = 1 << 19, 48


def model_bytes(path: str) -> bytes:
    """A model file as seen by the driver; it travels to the workers with the job."""
    with open(path, "rb") as file:
        return file.read()


class Agenda:
    """Merges by score over the pieces of a model."""

    def __init__(self, library: sentencepiece.SentencePieceProcessor):
        size = library.vocab_size()
        pieces = [library.id_to_piece(i) for i in range(size)]
        special = [
            library.is_byte(i) or library.is_control(i) or library.is_unknown(i) or library.is_unused(i)
            for i in range(size)
        ]
        self.ids = {p: i for i, p in enumerate(pieces) if not special[i]}
        scores = sorted({library.get_score(i) for i in self.ids.values()}, reverse=True)
        place = {score: i for i, score in enumerate(scores)}
        self.ranks = {p: place[library.get_score(i)] for p, i in self.ids.items() if len(p) > 1}
        self.unknown = library.unk_id()
        self.octets = {int(pieces[i][3:5], 16): i for i in range(size) if library.is_byte(i)}
        self.numbered = sorted(self.ids.values(), key=lambda i: -library.get_score(i))
        self.number = {pieces[i]: n for n, i in enumerate(self.numbered)}
        self.merges = self._merges()
        self.segments = self._segments()

    def _segments(self) -> re.Pattern | None:
        """A pattern for parts of a text that no piece reaches across, or None if there are none.

        It may part a text before a word, around characters that are pieces only by themselves, and
        between a letter and a character that follows a letter in no piece.
        """
        pieces = self.ids
        alone = "".join(c for c in "\n\t" if not any(c in p for p in pieces if len(p) > 1))
        if "\n" not in alone or any(SPACE in p.lstrip(SPACE) for p in pieces):
            return None
        after: dict[str, set[str]] = {}
        for p in pieces:
            for a, c in zip(p, p[1:]):
                if re.match(LETTER, a) and not re.match(LETTER, c):
                    after.setdefault(c, set()).add(a)
        joins = "|".join(
            f"(?<=[{re.escape(''.join(sorted(letters)))}]){re.escape(c)}"
            for c, letters in sorted(after.items())
        )
        other = f"[^{LETTER[1:-1]}{SPACE}{alone}]"
        letters = rf"(?:{LETTER}+(?:(?:{joins}){other}*)?)+" if joins else f"{LETTER}+"
        return re.compile(
            rf"{SPACE}*{other}*{letters}|{SPACE}*{other}+|{SPACE}+|[{alone}]"
        )

    def _merges(self) -> dict[int, int]:
        """For two pieces, as numbers in the order of scores, the piece that they merge into."""
        number = self.number
        return {
            number[p[:i]] << 16 | number[p[i:]]: number[p]
            for p in self.ids
            for i in range(1, len(p))
            if p[:i] in number and p[i:] in number
        }

    def encode(self, segment: str) -> list[int]:
        if len(segment) <= 40 and SPACE + SPACE not in segment:
            return self._few(segment)
        return self._ids(self._many(list(segment)))

    def _few(self, segment: str) -> list[int]:
        """The agenda of a short segment is a list by place; its best entry is the leftmost minimum.

        Pieces are numbered by score here, so an entry is the number of the piece that it makes.
        """
        none, get = NONE, self.merges.get
        try:
            symbols = [self.number[c] for c in segment]
        except KeyError:
            return self._ids(self._many(list(segment)))
        agenda = [get(a << 16 | b, none) for a, b in zip(symbols, symbols[1:])]
        while agenda:
            best = min(agenda)
            if best == none:
                break
            i = agenda.index(best)
            symbols[i] = best
            del symbols[i + 1], agenda[i]
            if i < len(agenda):
                agenda[i] = get(best << 16 | symbols[i + 1], none)
            if i:
                agenda[i - 1] = get(symbols[i - 1] << 16 | best, none)
        return [self.numbered[n] for n in symbols]

    def _many(self, symbols: list[str]) -> list[str]:
        """The agenda of a long segment is a heap; outdated entries are skipped."""
        ranks = self.ranks
        n = len(symbols)
        heap = []
        for i in range(n - 1):
            rank = ranks.get(symbols[i] + symbols[i + 1])
            if rank is not None:
                heap.append(rank << 32 | i)
        heapify(heap)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        while heap:
            entry = heappop(heap)
            i = entry & 0xFFFFFFFF
            j = after[i]
            if not symbols[i] or j >= n:
                continue
            merged = symbols[i] + symbols[j]
            if ranks.get(merged) != entry >> 32:
                continue
            symbols[i], symbols[j] = merged, ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                rank = ranks.get(merged + symbols[k])
                if rank is not None:
                    heappush(heap, rank << 32 | i)
            h = before[i]
            if h >= 0:
                rank = ranks.get(symbols[h] + merged)
                if rank is not None:
                    heappush(heap, rank << 32 | h)
        return [s for s in symbols if s]

    def _ids(self, symbols: list[str]) -> list[int]:
        get, out = self.ids.get, []
        for symbol in symbols:
            found = get(symbol)
            if found is not None:
                out.append(found)
            elif self.octets:
                out.extend(self.octets[b] for b in symbol.encode())
            else:
                out.append(self.unknown)
        return out


class Encoder:
    """Whole texts to ids, with a memory of segments and the library beside it."""

    def __init__(self, model: bytes, bos: bool = True, eos: bool = True):
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.agenda = Agenda(self.library)
        self.head = self._packed([self.library.bos_id()] if bos else [])
        self.tail = self._packed([self.library.eos_id()] if eos else [])
        self.known: dict[str, bytes] = {}

    @staticmethod
    def _packed(ids: list[int]) -> bytes:
        return array("I", ids).tobytes() if sys.byteorder == "little" else np.array(ids, dtype="<u4").tobytes()

    def _learn(self, segments: list[str]) -> tuple[dict[str, bytes], set[str]]:
        """Ids of new segments, and those segments whose ids had to give way to the library's."""
        own = [self.agenda.encode(s) for s in segments]
        # After a line feed the library adds no space, and the line feed stands for itself.
        checked = [ids[2:] for ids in self.library.encode(["\n" + s for s in segments], num_threads=1)]
        learned = {s: self._packed(ids) for s, ids in zip(segments, own)}
        corrected = {s: self._packed(b) for s, a, b in zip(segments, own, checked) if a != b}
        return learned | corrected, set(corrected)

    def encode(self, texts: list[str]) -> tuple[list[bytes], list[int]]:
        """Packed little-endian ids of each text, and in how many of its segments the library differs."""
        if self.agenda.segments is None:
            own = [self.agenda.encode(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
            checked = self.library.encode(texts, num_threads=1)
            # Equal lists or not: in both cases the library's are the right ones.
            packed = [self.head + self._packed(ids) + self.tail for ids in checked]
            return packed, [int(a != b) for a, b in zip(own, checked)]
        find = self.agenda.segments.findall
        split = [find(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        known = self.known
        fresh = list({s for segments in split for s in segments if s not in known})
        learned, differing = self._learn(fresh) if fresh else ({}, set())
        if len(known) + len(learned) > REMEMBERED:
            # Start again with what this batch uses.
            used = {s for segments in split for s in segments}
            known = self.known = {s: known[s] for s in used if s in known}
        known.update(learned)
        get = known.__getitem__
        packed = [self.head + b"".join(map(get, segments)) + self.tail for segments in split]
        wrong = [sum(s in differing for s in segments) if differing else 0 for segments in split]
        for s in fresh:
            if len(s) > LONGEST:
                known.pop(s, None)
        return packed, wrong

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.library.decode(ids)


#: Characters of the texts that are encoded together inside a batch.
TOGETHER = 1 << 20


def _pieces_of(batches: Iterator[pa.RecordBatch], model: bytes, bos: bool, eos: bool, digests: bool):
    encoder = Encoder(model, bos, eos)
    for batch in sliced(batches, 1):
        texts = [t or "" for t in batch.column(1).to_pylist()]
        for a, b in chunks([len(t) + 1 for t in texts], TOGETHER):
            packed, wrong = encoder.encode(texts[a:b])
            ids = [np.frombuffer(p, dtype="<u4") for p in packed]
            columns = {
                "doc_id": batch.column(0).slice(a, b - a),
                "n_tokens": pa.array([len(i) for i in ids], pa.int64()),
                "n_differing": pa.array(wrong, pa.int64()),
            }
            if digests:
                back = encoder.decode([i.tolist() for i in ids])
                columns["ids_sha256"] = pa.array([hashlib.sha256(p).hexdigest() for p in packed])
                columns["decoded_sha256"] = pa.array(
                    [hashlib.sha256(t.encode()).hexdigest() for t in back]
                )
            else:
                columns["ids"] = pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)


def _selected(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col(text).cast("string").alias("text"))


def encoded(
    docs: DataFrame, model: bytes, text: str = "text", bos: bool = True, eos: bool = True
) -> DataFrame:
    """``(doc_id, n_tokens, n_differing, ids)`` for every row; a null text counts as empty.

    An empty text has the begin and end ids only. Repeated rows repeat, other columns are not read,
    and a row without an id is encoded like any other.
    """
    return _selected(docs, text).mapInArrow(
        partial(_pieces_of, model=model, bos=bos, eos=eos, digests=False),
        "doc_id long, n_tokens long, n_differing long, ids array<int>",
    )


def _texts_of(batches: Iterator[pa.RecordBatch], model: bytes) -> Iterator[pa.RecordBatch]:
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    for batch in batches:
        ids = [list(i or ()) for i in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_pydict(
            {"doc_id": batch.column(0), "text": pa.array([library.decode(i) if i else "" for i in ids])}
        )


def decoded(frame: DataFrame, model: bytes, ids: str = "ids") -> DataFrame:
    """``(doc_id, text)``: the text of each row's ids; null or no ids give an empty text."""
    return frame.select(F.col("doc_id").cast("long"), F.col(ids).cast("array<int>").alias("ids")).mapInArrow(
        partial(_texts_of, model=model), "doc_id long, text string"
    )


def round_trips(
    docs: DataFrame, model: bytes, text: str = "text", bos: bool = True, eos: bool = True
) -> DataFrame:
    """Digests of ids and of the text they decode to, for every row; ids never leave the worker."""
    return _selected(docs, text).mapInArrow(
        partial(_pieces_of, model=model, bos=bos, eos=eos, digests=True),
        "doc_id long, n_tokens long, n_differing long, ids_sha256 string, decoded_sha256 string",
    )
