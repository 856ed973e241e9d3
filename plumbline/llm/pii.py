"""Personal data in whole texts, plain and disguised, with spans in code points of the source.

Plain identifiers are found by their patterns. For disguised ones two transducers rewrite a text and
keep, for every character written, the span of source characters it came from: the first replaces
look-alike characters and drops invisible ones, the second turns spelled digits and written-out
"at", "dot" and "plus", alone or beside brackets and signs, into the characters they stand for. What the detectors find in the rewritten
text is mapped back. Only texts with a sign of a disguise are rewritten, whole.
"""

from __future__ import annotations

import bisect
import re
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.arrow import chunks
from plumbline.llm.tokens import PIECE, Powers, cut, parts, words

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

# Letters of other scripts that look like a Latin letter.
LOOK_ALIKE = dict(zip("аеорсухіјѕһԁԛԝοαινρυАВЕКМНОРСТХІЈЅΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aeopcyxijshdqwoaivpuABEKMHOPCTXIJSABEZHIKMNOPTYX"))
# Characters that cannot be seen.
INVISIBLE = "­​‌‍⁠﻿"
# Dashes and full stops of other scripts.
OTHER_SIGNS = {**dict.fromkeys("‐‑‒–−", "-"), **dict.fromkeys("。｡․", ".")}
# Digits in English, French, German and Spanish.
SPELLED = {
    "0": "zero oh zéro null cero",
    "1": "one un une eins uno",
    "2": "two deux zwei zwo dos",
    "3": "three trois drei tres",
    "4": "four quatre vier cuatro",
    "5": "five cinq fünf cinco",
    "6": "six sechs seis",
    "7": "seven sept sieben siete",
    "8": "eight huit acht ocho",
    "9": "nine neuf neun nueve",
}
# Endings of addresses that may be written out in plain words.
ENDINGS = "com org net edu gov info biz io de fr es it uk eu at ch nl"
# Country codes that may end an address in plain words, without those that are everyday words.
COUNTRIES = frozenset(
    "ac ad ae af ag ai al ao aq ar au aw ax az ba bb bd bf bg bh bi bj bm bn bo br bs bt bw by bz ca cc cd cf cg ci ck"
    " cl cm cn co cr cu cv cw cx cy cz dj dk dm dz ec ee eg er et fi fj fk fm fo ga gd ge gf gg gh gi gl gm gn gp gq gr"
    " gs gt gu gw gy hk hm hn hr ht hu id ie il im iq ir je jm jo jp ke kg kh ki km kn kp kr kw ky kz lb lc li lk lr ls"
    " lt lu lv ly ma mc md mg mh mk ml mm mn mo mp mq mr ms mt mu mv mw mx mz nc nf ng ni np nr nu nz om pa pe pf pg ph"
    " pk pl pm pn pr ps pt pw py qa re ro rs ru rw sa sb sc sd sg sh si sk sl sm sn sr ss st sv sx sy sz tc td tf tg th"
    " tj tk tl tm tn tr tt tv tw tz ua ug uy uz va vc ve vg vi vn vu wf ws ye yt za zm zw".split()
)
# Bytes of numbers, and bytes that may stand between their digits.
_COUNTS = np.array([chr(b) in "0123456789+" for b in range(256)])
_GAP = np.array([chr(b) in " \t,.()-" for b in range(256)])
# Bytes that are no letters; those of longer characters count as letters.
_NO_LETTER = np.array([b < 128 and not chr(b).isalpha() for b in range(256)])


def _characters() -> dict[str, str]:
    """What the first transducer writes for a character; nothing for invisible ones.

    Besides the fixed lists these are all characters whose compatibility form is one of the
    characters of identifiers.
    """
    wanted = _LOCAL | set("@()")
    table = {}
    for code in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= code < 0xE000 or 0x3400 <= code < 0xA000 or 0xAC00 <= code < 0xD7B0:
            continue
        c = chr(code)
        form = unicodedata.normalize("NFKC", c)
        if form in wanted and c not in "ªº¹²³":
            table[c] = form
        elif unicodedata.decimal(c, None) is not None:
            table[c] = str(unicodedata.decimal(c))
    return table | LOOK_ALIKE | OTHER_SIGNS | dict.fromkeys(INVISIBLE, "")


class Detector:
    """The patterns of both kinds, compiled once for a worker."""

    def __init__(self):
        self.characters = _characters()
        self.table = str.maketrans(self.characters)
        self.codes = np.array(sorted(map(ord, self.characters)), dtype=np.uint32)
        self.sizes = np.array([len(self.characters[chr(c)]) for c in self.codes.tolist()], dtype=np.int8)
        # Below this range only two characters are replaced, so most texts are passed at once.
        self.maybe_odd = re.compile("[\xad\u017f\u0250-\U0010ffff]")
        self.digit_of = {w: d for d, names in SPELLED.items() for w in names.split()}
        word = "(?:" + "|".join(sorted(self.digit_of, key=len, reverse=True)) + ")"
        token = rf"(?:{word}|[0-9]+)"
        name = r"[A-Za-z0-9_%+-]+(?:\.[A-Za-z0-9_%+-]+)*"
        label = r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*"
        dot = r"[ \t]+dot[ \t]+"
        self.endings = frozenset(ENDINGS.split())
        # No address has more labels than these bounds allow.
        wordy = (
            rf"(?<![A-Za-z0-9._%+-]){name}(?:{dot}{name}){{0,30}}(?:[ \t]+at[ \t]+|[ \t]*@[ \t]*)"
            rf"{label}(?:{dot}{label}){{0,30}}(?:{dot}|\.)(?P<top>[A-Za-z]{{2,}})(?![A-Za-z0-9-])"
        )
        gap = r"[ \t,.()-]{1,3}"
        between = rf"(?:[ \t]+(?:dot|point)[ \t]+|{gap})"
        self.spelled_run = re.compile(
            rf"(?<!\w)(?:(?:plus|\+)[ \t]*)?{word}(?!\w)(?:{between}{token}(?!\w)){{3,}}|"
            rf"(?<!\w)(?:plus[ \t]+|\+)[0-9]+(?:{between}{token}(?!\w)){{3,}}",
            re.IGNORECASE,
        )
        self.digit_word = re.compile(rf"(?<!\w){word}(?!\w)", re.IGNORECASE)
        self.wordy = re.compile(wordy, re.IGNORECASE)
        self.bracket = re.compile(
            r"[\[({<][ \t]*+(?:(?P<at>at|@)|(?:dot|\.))[ \t]*+[\])}>][ \t]*+", re.IGNORECASE
        )
        self.powers = Powers()
        spelled = [w.encode() for w in (*self.digit_of, "plus")]
        self.spelled = np.sort(words([b" ".join(spelled)], self.powers, _NO_LETTER).hashes)
        self.dot = words([b"dot"], self.powers, _NO_LETTER).hashes[0]
        self.written = re.compile(r"[ \t]+(?P<word>at|dot|point)[ \t]+|[ \t]*(?P<sign>@)[ \t]*", re.IGNORECASE)

    # -- the identifiers themselves

    def plain(self, text: str) -> dict[str, list[tuple[int, int]]]:
        """Spans by kind, leftmost and without overlap inside a kind."""
        found = {"email": self._emails(text) if "@" in text else []}
        if _DIGIT.search(text):
            found["ip"] = self._addresses(text)
            found["card"] = [m.span() for m in _CARD.finditer(text) if self._is_card(m[0])]
            found["phone"] = [
                m.span()
                for m in (_PHONE.finditer(text) if "+" in text else ())
                if 8 <= len(_DIGIT.findall(m[0])) <= 15
            ]
        return {kind: found.get(kind, []) for kind in KINDS}

    @staticmethod
    def _emails(text: str) -> list[tuple[int, int]]:
        found, end, at = [], 0, text.find("@")
        while at >= 0:
            start = at
            while start > end and text[start - 1] in _LOCAL:
                start -= 1
            if start < at and (domain := _DOMAIN.match(text, at + 1)):
                end = domain.end()
                found.append((start, end))
            at = text.find("@", max(at + 1, end))
        return found

    @staticmethod
    def _addresses(text: str) -> list[tuple[int, int]]:
        found = []
        for run in _DOTTED.finditer(text):
            parts = run[0].split(".")
            start = run.start()
            for i in range(0, len(parts) - 3, 4):
                four = parts[i : i + 4]
                end = start + sum(map(len, four)) + 3
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                    found.append((start, end))
                start = end + 1
        return found

    @staticmethod
    def _is_card(text: str) -> bool:
        digits = [int(c) for c in text if c not in " -"]
        if not 16 <= len(digits) <= 19:
            return False
        doubled = [2 * d - 9 * (d > 4) for d in digits[-2::-2]]
        return (sum(digits[-1::-2]) + sum(doubled)) % 10 == 0

    # -- the disguises

    def disguised(self, texts: list[str]) -> list[bool]:
        """Which texts show a sign of a disguise: a look-alike or invisible character, a bracketed
        "at" or "dot", the word "dot", two spelled digits in a row, or one beside digits or a plus sign."""
        out = []
        encoded = [t.encode() for t in texts]
        for a, b in parts(encoded):
            if b - a == 1 and len(encoded[a]) > PIECE:
                # A spelled digit at either end of a piece may have another one beside it.
                pieces = (self._signs([piece]) for piece in cut(encoded[a], _NO_LETTER))
                out.append(any(bool(sign.any() or digit[:1].any() or digit[-1:].any()) for sign, digit, _ in pieces))
                continue
            sign, _, first = self._signs(encoded[a:b])
            total = np.concatenate(([0], np.cumsum(sign)))
            out += (total[first[1:]] > total[first[:-1]]).tolist()
        return [
            sign or bool(self.bracket.search(t)) or (not t.isascii() and self._odd(t))
            for sign, t in zip(out, texts)
        ]

    def _signs(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which words are signs of a disguise, which are spelled digits, and where each text's words begin."""
        found = words(texts, self.powers, _NO_LETTER)
        at = np.searchsorted(self.spelled, found.hashes)
        at[at == len(self.spelled)] = 0
        digit = self.spelled[at] == found.hashes
        sign = found.hashes == self.dot
        sign[:-1] |= digit[:-1] & digit[1:]
        sign |= digit & self._beside(found)
        return sign, digit, found.first

    @staticmethod
    def _beside(found) -> np.ndarray:
        """Which words have a digit or a plus sign up to three signs away."""
        out = np.zeros(len(found.starts), dtype=bool)
        for ends, way in ((found.starts - 1, -1), (found.ends, 1)):
            near = np.ones(len(ends), dtype=bool)
            for k in range(4):
                at = ends + way * k
                near &= (at >= 0) & (at < len(found.data))
                byte = found.data[np.where(near, at, 0)]
                out |= near & _COUNTS[byte]
                near &= _GAP[byte]
        return out

    def _odd(self, text: str) -> bool:
        return bool(self.maybe_odd.search(text)) and not self.characters.keys().isdisjoint(text)

    def rewritten(self, text: str) -> tuple[str, np.ndarray]:
        """The text after both transducers, and start and end in the source of each of its characters."""
        once, spans = self._mapped(text)
        edits, end = [], 0
        # Brackets first, so that what is written in words may stand beside them.
        for m in self.bracket.finditer(once):
            start = m.start()
            while start > end and once[start - 1] in " \t":
                start -= 1
            end = m.end()
            edits.append((start, end, "@" if m["at"] else "."))
        once, spans, marks = self._edited(once, spans, edits)
        edits, marked = [], set(marks)
        for m in self.wordy.finditer(once):
            bracketed = bisect.bisect_left(marks, m.end()) > bisect.bisect_left(marks, m.start())
            if not bracketed and "@" not in m[0] and not self._known_ending(m):
                continue
            signs = list(self.written.finditer(once, m.start(), m.end()))
            if bracketed or any((w["word"] or "").lower() == "dot" for w in signs):
                edits += [
                    (w.start(), w.end(), "." if (w["word"] or "at").lower() != "at" else "@") for w in signs
                ]
        for m in self.spelled_run.finditer(once):
            edits += self._digits(once, m.start(), m.end(), marked)
        return self._edited(once, spans, edits)[:2]

    def _known_ending(self, m: re.Match) -> bool:
        """In plain words only, endings that are everyday words are none."""
        top = m["top"].lower()
        return top in self.endings or (len(top) == 2 and top in COUNTRIES)

    def _mapped(self, text: str) -> tuple[str, np.ndarray]:
        """Each character as what it looks like, and its span: eight bytes a character."""
        size = np.ones(len(text), dtype=np.int8)
        if not text.isascii():
            for start in range(0, len(text), 1 << 20):
                codes = np.frombuffer(text[start : start + (1 << 20)].encode("utf-32-le", "surrogatepass"), dtype="<u4")
                odd = np.flatnonzero(codes >= 128)
                at = np.minimum(np.searchsorted(self.codes, codes[odd]), len(self.codes) - 1)
                known = self.codes[at] == codes[odd]
                size[start + odd[known]] = self.sizes[at[known]]
        spans = np.empty((2, int(size.sum(dtype=np.int64))), dtype=np.int32)
        spans[0] = np.repeat(np.arange(len(text), dtype=np.int32), size)
        np.add(spans[0], 1, out=spans[1])
        return text.translate(self.table), spans

    @staticmethod
    def _edited(once: str, spans: np.ndarray, edits: list) -> tuple[str, np.ndarray, list[int]]:
        """A text after edits, the source span of each character, and where edits put one."""
        if not edits:
            return once, spans, []
        out, back, marks, at, size = [], [], [], 0, 0
        for start, end, to in sorted(edits):
            if start < at:
                continue
            out.append(once[at:start])
            back.append(spans[:, at:start])
            size += start - at
            if to:
                marks.append(size)
                out.append(to)
                back.append(np.array([[spans[0, start]], [spans[1, end - 1]]], dtype=np.int32))
                size += 1
            at = end
        out.append(once[at:])
        back.append(spans[:, at:])
        return "".join(out), np.concatenate(back, axis=1), marks

    def _digits(self, text: str, start: int, end: int, marked: set[int]) -> list[tuple[int, int, str]]:
        """Edits for a run of spelled digits: digits for words, nothing for the gaps beside them."""
        edits = []
        if text[start : start + 4].lower() == "plus":
            rest = re.compile(r"plus[ \t]*", re.IGNORECASE).match(text, start)
            edits.append((start, rest.end(), "+"))
        last = None
        for w in self.digit_word.finditer(text, start, end):
            if last is not None:
                gap = text[last : w.start()]
                if gap == "." and last in marked:
                    pass
                elif gap.strip(" \t,.-()") == "" and gap:
                    edits.append((last, w.start(), ""))
                elif self.written.fullmatch(gap):
                    edits.append((last, w.start(), "."))
            edits.append((w.start(), w.end(), self.digit_of[w[0].lower()]))
            last = w.end()
        return edits

    def spans(self, text: str, disguised: bool) -> list[tuple[str, int, int, bool, str]]:
        """``(kind, start, end, plain, value)`` by kind and start; values are normalised."""
        base = self.plain(text)
        found = [(k, s, e, True, text[s:e]) for k in KINDS for s, e in base[k]]
        if disguised:
            seen, back = self.rewritten(text)
            for kind, spans in self.plain(seen).items():
                for s, e in spans:
                    start, end = int(back[0, s]), int(back[1, e - 1])
                    if text[start:end] != seen[s:e] and not any(
                        start < b and a < end for a, b in base[kind]
                    ):
                        found.append((kind, start, end, False, seen[s:e]))
            found.sort(key=lambda f: (KINDS.index(f[0]), f[1]))
        return found


SPAN = "struct<kind:string,start:long,end:long,plain:boolean,value:string>"
_SPANS = pa.list_(
    pa.struct(
        [
            ("kind", pa.string()),
            ("start", pa.int64()),
            ("end", pa.int64()),
            ("plain", pa.bool_()),
            ("value", pa.string()),
        ]
    )
)


def _spans_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    detector = Detector()
    names = ("kind", "start", "end", "plain", "value")
    for batch in batches:
        sizes = [1 + len(t or "") for t in batch.column(1).to_pylist()]
        for a, b in chunks(sizes, 1 << 22):
            texts = batch.column(1).slice(a, b - a).to_pylist()
            texts = [t or "" for t in texts]
            signs = detector.disguised(texts)
            found = [[dict(zip(names, s)) for s in detector.spans(*t)] for t in zip(texts, signs)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), pa.array(found, _SPANS)], names=["doc_id", "spans"]
            )


def personal_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(doc_id, spans)`` for every row: kind, start, end, whether plain, and normalised value.

    Offsets are code points of the source, the end exclusive. Plain identifiers always stay; a
    disguised one is added unless it overlaps a plain one of its kind. Null and empty texts have no
    spans, repeated rows repeat, a row without an id is scanned like any other, other columns
    are not read, and an empty table has no rows. A long text without a sign of a disguise costs its own size; one with a
    sign costs some twenty bytes a character more while it is rewritten.
    """
    return docs.select(
        F.col("doc_id").cast("long"), F.col(text).cast("string").alias("text")
    ).mapInArrow(_spans_of, f"doc_id long, spans array<{SPAN}>")


def joined(spans):
    """``kind:start:end`` of an array of spans, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def counted(frame: DataFrame) -> DataFrame:
    """Digest columns of the spans of each row; the counts are those of plain identifiers."""
    plain = F.filter("spans", lambda s: s["plain"])

    def number(kind: str):
        return F.size(F.filter(plain, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return frame.select(
        "doc_id",
        *[number(kind) for kind in KINDS],
        F.sha2(joined(plain), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
        F.size(F.filter("spans", lambda s: ~s["plain"])).cast("long").alias("n_disguised"),
    )
