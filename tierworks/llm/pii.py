"""Personal data, plain and disguised: detectors over normalised text, with spans in the source's characters.

Two transducers rewrite a text and remember where each output character came from:

* characters: look-alikes of other scripts, full-width and mathematical forms and other digits become ASCII,
  invisible characters vanish;
* words: runs of spelled digits become digits, ``(at)``, ``[dot]`` and the like become ``@`` and ``.`` where an address
  or a number can stand.

Both are lists of edits (source start, source end, output), so a text without disguises costs nothing and a span of
the output maps back by bisection. The detectors run over the source (base spans) and, where there was an edit, over
the rewritten text; what they find there is added if an edit lies in it and no base span of its kind overlaps it.

Detectors look for the one character or the digits that their kind cannot do without and grow from there, so their
time is linear, also in a run of a million letters. Spans count code points, ends are exclusive.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import cache
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tierworks.llm import arrays

KINDS = ("email", "ip", "card", "phone")

#: Letters of other scripts that look like an ASCII letter.
LOOKALIKES = {
    # Cyrillic
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "о": "o",
    "р": "p", "ԛ": "q", "г": "r", "ѕ": "s", "т": "t", "ѵ": "v", "ԝ": "w", "х": "x", "у": "y",
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ѕ": "S",
    "Т": "T", "Х": "X", "У": "Y",
    # Greek
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T",
    "Υ": "Y", "Χ": "X",
    # Latin
    "ı": "i", "ɑ": "a", "ɡ": "g", "ɩ": "i",
    # signs
    "\u2024": ".", "\u3002": ".", "\u2010": "-", "\u2011": "-", "\u2012": "-", "\u2013": "-", "\u2212": "-",
    "\u00a0": " ", "\u2007": " ", "\u202f": " ",
}

#: Characters that show nothing.
INVISIBLE = "\u00ad\u180e\u200b\u200c\u200d\u2060\ufeff"

#: The digits from nought to nine in four languages, accented and plain.
SPELLED = (
    ("zero", "oh", "zéro", "null", "cero"),
    ("one", "un", "eins", "uno"),
    ("two", "deux", "zwei", "zwo", "dos"),
    ("three", "trois", "drei", "tres"),
    ("four", "quatre", "vier", "cuatro"),
    ("five", "cinq", "fünf", "fuenf", "cinco"),
    ("six", "sechs", "seis"),
    ("seven", "sept", "sieben", "siete"),
    ("eight", "huit", "acht", "ocho"),
    ("nine", "neuf", "neun", "nueve"),
)

#: Words for the signs of an address, and for the sign before a country's number.
AT_WORDS = ("at", "arroba", "arobase", "klammeraffe")
DOT_WORDS = ("dot", "point", "punkt", "punto")
PLUS_WORDS = ("plus",)

#: Last labels that make ``name at host dot label`` an address where no bracket says so.
LAST_LABELS = frozenset(
    "ai app at au be biz br ca cat ch cl cn co com cz de dev dk edu es eu fi fr gov gr hu ie in info int io it jp kr me mil mx net nl no nz org pe pl pt ro ru se uk us".split()
)

_DIGIT_OF = {word: str(n) for n, words in enumerate(SPELLED) for word in words}


def _any(words) -> str:
    return "(?:" + "|".join(sorted(words, key=lambda w: (-len(w), w))) + ")"


_OPEN, _CLOSE = r"[\[({<]", r"[\])}>]"
#: A sign in brackets says what it is by itself; a bare word needs blanks around it.
_BRACKET_AT = rf"[ ]{{0,2}}{_OPEN}[ ]?(?:{_any(AT_WORDS)}|@)[ ]?{_CLOSE}[ ]{{0,2}}"
_BRACKET_DOT = rf"[ ]{{0,2}}{_OPEN}[ ]?(?:{_any(DOT_WORDS)}|\.)[ ]?{_CLOSE}[ ]{{0,2}}"
_WORD_AT = rf"[ ]{{1,2}}{_any(AT_WORDS)}[ ]{{1,2}}"
_WORD_DOT = rf"[ ]{{1,2}}{_any(DOT_WORDS)}[ ]{{1,2}}"
_LOCAL, _LABEL = r"[A-Za-z0-9._%+-]", r"[A-Za-z0-9-]"

_FLAGS = re.IGNORECASE
AT = re.compile(rf"(?P<bracket>{_BRACKET_AT})|(?P<word>{_WORD_AT})|@", _FLAGS)
DOT = re.compile(rf"(?P<bracket>{_BRACKET_DOT})|(?P<word>{_WORD_DOT})|\.", _FLAGS)
LABEL = re.compile(rf"{_LABEL}+")
NUMBER_DOT = re.compile(rf"(?<=[0-9])(?:{_BRACKET_DOT}|{_WORD_DOT})(?=[0-9])", _FLAGS)
_BETWEEN = r"[ ,;/_-]{1,3}"
_SPELLED = rf"(?<![^\W\d_])(?:{_any(_DIGIT_OF)})(?![^\W\d_])"
_ITEM = rf"(?:{_SPELLED}|[0-9]+)"
DIGITS = re.compile(rf"(?:(?<![^\W\d_]){_any(PLUS_WORDS)}[ ]{{1,2}})?{_ITEM}(?:(?:{_BRACKET_DOT}|{_WORD_DOT}|{_BETWEEN}){_ITEM})*", _FLAGS)
DIGIT_PART = re.compile(rf"(?P<dot>{_BRACKET_DOT}|{_WORD_DOT})|(?P<plus>{_any(PLUS_WORDS)}[ ]{{1,2}})|(?P<digits>[0-9]+)|(?P<word>[^\W\d_]+)|(?P<between>[ ,;/_-]+)", _FLAGS)

#: What a text must hold for the word transducer to have anything to do.
HINT = re.compile(rf"{_OPEN}[ ]?(?:{_any(AT_WORDS + DOT_WORDS)}|[@.])[ ]?{_CLOSE}|(?<![^\W_]){_any((*DOT_WORDS, *PLUS_WORDS))}[ ]|{_SPELLED}{_BETWEEN}{_ITEM}|[0-9]{_BETWEEN}{_SPELLED}", _FLAGS)

PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
QUADS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
NUMBER = re.compile(r"[0-9]+")
LOCAL = re.compile(rf"{_LOCAL}+")
DOMAIN = re.compile(rf"{_LABEL}+(?:\.{_LABEL}+)+")

Span = tuple[int, int]


class Edit(NamedTuple):
    start: int
    end: int
    out: str


class Rewritten:
    """A text after some edits, and the way back."""

    def __init__(self, source: str, edits: list[Edit]) -> None:
        parts, at = [], 0
        for e in edits:
            parts += [source[at : e.start], e.out]
            at = e.end
        self.text = "".join([*parts, source[at:]])
        self.edits = edits
        shift = [0, *accumulate(len(e.out) - (e.end - e.start) for e in edits)]
        #: where each edit's output begins and ends
        self.begins = [e.start + s for e, s in zip(edits, shift)]
        self.ends = [b + len(e.out) for b, e in zip(self.begins, edits)]

    def origin(self, span: Span) -> Span:
        """The source characters that the span of the rewritten text was made from."""
        return self._back(span[0], True), self._back(span[1] - 1, False) + 1

    def _back(self, at: int, first: bool) -> int:
        k = bisect_right(self.begins, at) - 1
        if k >= 0 and at < self.ends[k]:
            return self.edits[k].start if first else self.edits[k].end - 1
        k = bisect_right(self.ends, at) - 1
        return at if k < 0 else self.edits[k].end + at - self.ends[k]

    def touched(self, source_span: Span) -> bool:
        """Whether an edit lies within the source span."""
        k = bisect_left(self.edits, (source_span[0],))
        return k < len(self.edits) and self.edits[k].end <= source_span[1]


# --- transducers -------------------------------------------------------------------------------------------------


@cache
def plain(char: str) -> str | None:
    """What the character transducer writes for a character above ASCII; None: the character itself."""
    if char in INVISIBLE:
        return ""
    if char in LOOKALIKES:
        return LOOKALIKES[char]
    if char.isdecimal():
        return str(unicodedata.decimal(char))
    wide = unicodedata.normalize("NFKC", char)
    return wide if len(wide) == 1 and wide.isascii() and wide > " " and unicodedata.decomposition(char).startswith("<") else None


def characters(text: str) -> list[Edit]:
    if text.isascii():
        return []
    odd = {c for c in set(text) if c > "\x7f" and plain(c) is not None}
    if not odd:
        return []
    found = re.compile(f"[{re.escape(''.join(sorted(odd)))}]")
    return [Edit(m.start(), m.end(), plain(m[0])) for m in found.finditer(text)]


def words(text: str) -> list[Edit]:
    """Edits that write spelled digits and disguised signs plainly; they do not overlap."""
    if not HINT.search(text):
        return []
    edits = sorted([*_digit_edits(text), *_address_edits(text)])
    kept: list[Edit] = []
    for e in edits:
        if not kept or e.start >= kept[-1].end:
            kept.append(e)
    return kept


def _digit_edits(text: str) -> Iterator[Edit]:
    for run in DIGITS.finditer(text):
        parts = list(DIGIT_PART.finditer(text, run.start(), run.end()))
        spelled = [p.lastgroup == "word" for p in parts]
        if not any(spelled) or len(parts) < 3:
            continue
        for k, p in enumerate(parts):
            if p.lastgroup == "plus":
                yield Edit(*p.span(), "+")
            elif p.lastgroup == "dot":
                yield Edit(*p.span(), ".")
            elif p.lastgroup == "word":
                yield Edit(*p.span(), _DIGIT_OF.get(p[0].casefold(), p[0]))
            elif p.lastgroup == "between" and (spelled[k - 1] or spelled[k + 1]):
                yield Edit(*p.span(), "")


def _address_edits(text: str) -> Iterator[Edit]:
    for m in NUMBER_DOT.finditer(text):
        yield Edit(*m.span(), ".")
    free = 0
    for m in AT.finditer(text):
        if m.start() < free or not m.start() or not re.match(_LOCAL, text[m.start() - 1]):
            continue
        edits, words_only, at = [], m.lastgroup != "bracket", m.end()
        if m.lastgroup:
            edits.append(Edit(*m.span(), "@"))
        label, last, dots = LABEL.match(text, at), "", 0
        while label:
            at = label.end()
            dot = DOT.match(text, at)
            label = dot and LABEL.match(text, dot.end())
            if label:
                dots, last = dots + 1, label[0].lower()
                if dot.lastgroup:
                    words_only = words_only and dot.lastgroup == "word"
                    edits.append(Edit(*dot.span(), "."))
        hidden_dot = any(e.out == "." for e in edits)
        if dots and edits and (not words_only or hidden_dot and last in LAST_LABELS):
            free = at
            yield from edits
            yield from _local_edits(text, m.start())


def _local_edits(text: str, end: int) -> Iterator[Edit]:
    """``first dot last`` before the sign: dots in brackets, back to where the name begins."""
    at = end
    while True:
        low = at
        while low and re.match(_LOCAL, text[low - 1]):
            low -= 1
        back = re.search(rf"{_BRACKET_DOT}\Z", text[max(0, low - 20) : low], _FLAGS)
        if low == at or not back:
            return
        start = max(0, low - 20) + back.start()
        if not start or not re.match(_LOCAL, text[start - 1]):
            return
        yield Edit(start, low, ".")
        at = start


# --- detectors ---------------------------------------------------------------------------------------------------


def emails(text: str) -> Iterator[Span]:
    done, at = 0, text.find("@")
    while at >= 0:
        low = _run_before(text, at, done)
        domain = DOMAIN.match(text, at + 1) if low < at else None
        if domain:
            yield low, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def _run_before(text: str, at: int, least: int) -> int:
    """Where the run of name characters before ``at`` begins, not before ``least``."""
    width = 64
    while True:
        low = max(least, at - width)
        piece = text[low:at]
        k = len(piece)
        last = None
        for last in _NOT_LOCAL.finditer(piece):
            pass
        if last:
            return low + last.end()
        if low == least:
            return at - k
        width *= 4


_NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")


def addresses(text: str) -> Iterator[Span]:
    """Chains of numbers, four at a time; what does not fit is passed over."""
    for chain in QUADS.finditer(text):
        if "." not in chain[0]:
            continue
        numbers = list(NUMBER.finditer(text, chain.start(), chain.end()))
        for k in range(0, len(numbers) - 3, 4):
            four = numbers[k : k + 4]
            if all(_byte(n[0]) for n in four):
                yield four[0].start(), four[3].end()


def _byte(digits: str) -> bool:
    kept = digits.lstrip("0")
    return len(kept) <= 3 and int(kept or "0") <= 255


def cards(text: str) -> Iterator[Span]:
    for m in CARD.finditer(text):
        digits = re.sub("[ -]", "", m[0]) if len(m[0]) <= 40 else ""
        if 16 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def luhn(digits: str) -> bool:
    doubled = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (doubled + sum(int(d) for d in digits[::-2])) % 10 == 0


def phones(text: str) -> Iterator[Span]:
    at = text.find("+")
    while at >= 0:
        m = PHONE.match(text, at)
        if m:
            if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                yield m.span()
            at = text.find("+", m.end())
        else:
            at = text.find("+", at + 1)


DETECTORS = dict(zip(KINDS, (emails, addresses, cards, phones), strict=True))


def base_spans(text: str) -> dict[str, list[Span]]:
    return {kind: list(find(text)) for kind, find in DETECTORS.items()}


def added_spans(text: str, base: dict[str, list[Span]], suspect: bool = True) -> dict[str, list[Span]]:
    """What shows only after rewriting, in the source's characters; ``suspect``: see :func:`suspects`."""
    found: dict[str, list[Span]] = {kind: [] for kind in KINDS}
    edits = characters(text)
    if not edits and not suspect:
        return found
    first = Rewritten(text, edits)
    second = Rewritten(first.text, words(first.text))
    if not first.edits and not second.edits:
        return found
    for kind, find in DETECTORS.items():
        for span in find(second.text):
            middle = second.origin(span)
            source = first.origin(middle)
            if not second.touched(middle) and not first.touched(source):
                continue
            k = bisect_left(base[kind], source)
            near = base[kind][max(0, k - 1) : k + 1]
            if not any(s < source[1] and source[0] < e for s, e in near):
                found[kind].append(source)
    return found


def listed(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{kind}:{s}:{e}" for kind in KINDS for s, e in sorted(spans[kind]))


# --- which texts are worth rewriting ------------------------------------------------------------------------------

_OPENER = arrays.byte_class(lambda x: chr(x) in "[({<")
_DIGIT = arrays.byte_class(lambda x: 0x30 <= x <= 0x39)


def _packed(words) -> np.ndarray:
    """Words of up to 8 bytes as integers; letters above ASCII in both cases, as only A-Z are lower-cased."""
    both = {w for word in words for w in (word, "".join(c if c.isascii() else c.upper() for c in word))}
    return np.array(sorted(int.from_bytes(w.encode(), "little") for w in both if len(w.encode()) <= 8), np.uint64)


_DIGIT_WORDS, _SIGN_WORDS = _packed(_DIGIT_OF), _packed((*DOT_WORDS, *PLUS_WORDS))


def suspects(block: arrays.Block) -> np.ndarray:
    """Texts of a block in which the word transducer may find something, their characters left as they are.

    It needs a bracket, a word for a dot or a plus, or a spelled digit beside another one or beside a number.
    """
    out = np.zeros(len(block.bounds) - 1, bool)
    if not len(block.data):
        return out
    low = arrays.LOWER[block.data]
    found = arrays.words(low, block.bounds, arrays.WORD_CHARS)
    size = found.ends - found.starts
    code = np.zeros(len(size), np.uint64)
    for k in range(8):
        at = np.minimum(found.starts + k, len(low) - 1)
        code |= np.where(k < size, low[at], 0).astype(np.uint64) << np.uint64(8 * k)
    spelled = np.isin(code, _DIGIT_WORDS) & (size <= 8)
    item = spelled | (_DIGIT[low[found.starts]] & _DIGIT[low[found.ends - 1]])
    beside = np.zeros(len(size), bool)
    beside[:-1] |= item[1:]
    beside[1:] |= item[:-1]
    hits = found.starts[(spelled & beside) | (np.isin(code, _SIGN_WORDS) & (size <= 8))]
    hits = np.concatenate((hits, np.flatnonzero(_OPENER[block.data])))
    out[np.searchsorted(block.bounds, hits, "right") - 1] = True
    return out


# --- on Spark ----------------------------------------------------------------------------------------------------

SPAN_TYPE = T.ArrayType(
    T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("added", T.BooleanType())])
)
_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("added", pa.bool_())]))


def find_pii(df: DataFrame, text: str = "text", into: str = "pii") -> DataFrame:
    """``df`` with an array ``into`` of ``kind, start, end, added``: base spans and those behind disguises.

    Sorted by kind in the order of ``KINDS``, then start. Offsets count code points, ends are exclusive. NULL and empty texts
    have none. Each row is judged by itself, so repeated rows are judged alike, and a text of any length is read
    whole; a column of ``df`` named like ``into`` is an error.
    """
    if into in df.columns:
        raise ValueError(f"the table has a column {into!r}")
    schema = T.StructType([*df.schema.fields, T.StructField(into, SPAN_TYPE)])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in arrays.blocks(batches, text):
            rows = block.rows
            cells = []
            values = rows.column(rows.schema.get_field_index(text)).to_pylist()
            for value, suspect in zip(values, suspects(block), strict=True):
                base = base_spans(value or "")
                added = added_spans(value or "", base, suspect)
                cells.append([
                    {"kind": kind, "start": s, "end": e, "added": new}
                    for kind in KINDS
                    for s, e, new in sorted([(s, e, False) for s, e in base[kind]] + [(s, e, True) for s, e in added[kind]])
                ])
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(cells, _ARROW_SPANS)], [*rows.schema.names, into])

    return df.mapInArrow(find, schema)


def listed_spans(pii: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(pii, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def masked(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with every span of the text replaced by its kind in angle brackets; a span that overlaps one before is cut."""
    return df.mapInArrow(_mask(text), df.schema)


def _mask(text: str):
    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in arrays.blocks(batches, text):
            rows, cells = block.rows, []
            place = rows.schema.get_field_index(text)
            for value, suspect in zip(rows.column(place).to_pylist(), suspects(block), strict=True):
                if value:
                    base = base_spans(value)
                    added = added_spans(value, base, suspect)
                    parts, at = [], 0
                    for s, e, kind in sorted((s, e, kind) for kind in KINDS for s, e in [*base[kind], *added[kind]]):
                        if e > at:
                            parts += [value[at : max(s, at)], f"<{kind}>"]
                            at = e
                    value = "".join([*parts, value[at:]])
                cells.append(value)
            yield rows.set_column(place, rows.schema.field(place), pa.array(cells, rows.schema.field(place).type))

    return mask
