"""Token counts of whole texts, without their ids: whole tokens are counted, only the rest is merged.

Offline, once per model, two things are proven on the driver. No piece of the vocabulary reaches across
the borders at which a text is parted into pre-tokens (``Agenda.segments``), so the counts of
pre-tokens add up. And of the vocabulary's strings those are listed that are one pre-token and that the
library encodes, alone, as one token: each of them counts one wherever it stands.

In the tasks a pre-token of that list is counted by looking it up; the others are merged by the
sentencepiece library, all new ones of a batch together, and remembered by their count.

Defined results. A null or empty text has no tokens and no bytes. Repeated rows repeat, a row without an
id is counted like any other, an empty table has no rows, and other columns are not read. Long texts are
parted a window at a time, so a text of any length costs its own size and one window; a single pre-token
(a run of letters without a break) is merged whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.arrow import chunks
from plumbline.llm.pieces import SPACE, Agenda

#: Tokens above which a text is over the limit.
LIMIT = 4096
#: Counts that a worker remembers, and the longest remembered pre-token.
REMEMBERED, LONGEST = 1 << 18, 48
#: Characters that are parted together, and that a window of a longer text has.
WINDOW = 1 << 19


def whole_tokens(model: bytes) -> list[str]:
    """The vocabulary's strings that are one pre-token and, encoded alone, one token."""
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    agenda = Agenda(library)
    if agenda.segments is None:
        return []
    candidates = [p for p in agenda.ids if agenda.segments.fullmatch(p)]
    # Behind a line feed the library adds no space; the line feed and what stands for a space before
    # it are tokens of their own.
    before = len(library.encode("\n"))
    found = library.encode(["\n" + p for p in candidates], num_threads=1)
    return [p for p, ids in zip(candidates, found) if ids[before:] == [agenda.ids[p]]]


class Counter:
    """Counts of texts' tokens by the counts of their pre-tokens."""

    def __init__(self, model: bytes, proven: list[str]):
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.segments = Agenda(self.library).segments
        self.proven = dict.fromkeys(proven, 1)
        self.known = dict(self.proven)
        self.before = len(self.library.encode("\n"))

    def windows(self, text: str, size: int = WINDOW) -> Iterator[list[str]]:
        """Pre-tokens of a text, window by window; one that a window cuts begins the next window."""
        text = SPACE + text.replace(" ", SPACE)
        find, start, width = self.segments.findall, 0, size
        while start + width < len(text):
            found = find(text[start : start + width])
            # Only the last one could go on behind the window.
            found.pop()
            if found:
                yield found
                start += sum(map(len, found))
                width = size
            else:
                width *= 2
        yield find(text[start:])

    def _counted(self, split: list[list[str]]) -> list[int]:
        own = {s for segments in split for s in segments}
        fresh = [s for s in own if s not in self.known]
        if fresh:
            if len(self.known) + len(fresh) > REMEMBERED + len(self.proven):
                # Start again with what stands here.
                fresh = [s for s in own if s not in self.proven]
                self.known = dict(self.proven)
            ids = self.library.encode(["\n" + s for s in fresh], num_threads=1)
            self.known.update({s: len(i) - self.before for s, i in zip(fresh, ids)})
        get = self.known.__getitem__
        counts = [sum(map(get, segments)) for segments in split]
        for s in fresh:
            if len(s) > LONGEST:
                del self.known[s]
        return counts

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text, without begin and end."""
        if self.segments is None:
            return [len(ids) for ids in self.library.encode(texts, num_threads=1)]
        if len(texts) == 1 and len(texts[0]) > WINDOW:
            return [sum(self._counted([part])[0] for part in self.windows(texts[0]))]
        find = self.segments.findall
        return self._counted([find(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts])


def _counts_of(batches: Iterator[pa.RecordBatch], model: bytes, proven: list[str], limit: int):
    counter = Counter(model, proven)
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(1)), 0).cast(pa.int64())
        for a, b in chunks(lengths.to_numpy(zero_copy_only=False) + 1, WINDOW):
            counts = counter.count([t or "" for t in batch.column(1).slice(a, b - a).to_pylist()])
            n = pa.array(counts, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), lengths.slice(a, b - a), n, pc.greater(n, limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )


def token_counts(docs: DataFrame, model: bytes, text: str = "text", limit: int = LIMIT) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` for every row."""
    return docs.select(F.col("doc_id").cast("long"), F.col(text).cast("string").alias("text")).mapInArrow(
        partial(_counts_of, model=model, proven=whole_tokens(model), limit=limit),
        "doc_id long, n_bytes long, n_tokens long, over_limit boolean",
    )
