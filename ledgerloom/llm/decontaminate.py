"""Benchmark decontamination by templates.

Words become canonical: lower case without marks at their ends, and a typed placeholder for numbers and units, in a
second form for names (capitalised words, a run of them as one) too; a number and unit in one word are two slots, and a word with
numbers and operators is read part by part. Windows of canonical words are joined by hash with those of the benchmark: all words of a
batch are read and hashed as arrays, and only documents with a window of the benchmark are looked at word by word. A pair of windows counts only if its words agree and its slots are consistent: over the whole run of windows each
value of the benchmark stands for one value of the document, and different values for different ones. So a question is
also caught when its numbers, names and units were changed.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import cut, pieces_of, range_hashes, shingles, text_batches, words

# Words for numbers and units.
NUMBERS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty "
    "thirty forty fifty sixty seventy eighty ninety hundred thousand million billion"
).split()
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles metre metres meter meters kilometre kilometres kilometer kilometers mg g kg gram grams kilogram "
    "kilograms ounce ounces pound pounds ton tons tonne tonnes ml l litre litres liter liters gallon gallons second seconds minute minutes hour hours "
    "day days week weeks month months year years cent cents dollar dollars euro euros usd eur gbp percent degree degrees watt watts volt volts"
).split()

_MARKS = b" .,;:!?\"'()[]{}<>*#$%&|_-`~"
_NUMBER = re.compile(r"[+-]?\d[\d.,/:]*")
_JOINED = re.compile(r"([+-]?\d[\d.,/:]*)([^\W\d_]+)")
_ORDINAL, _HALVES = {b"st", b"nd", b"rd", b"th"}, {b"am", b"pm"}
_SPELLED_ORDINAL = set(b"first second third fourth fifth sixth seventh eighth ninth".split())
_ENDS = set(b.to_bytes() for b in b".,;:!?")
_SPELLED, _UNITS = {n.encode() for n in NUMBERS}, {u.encode() for u in UNITS}
#: Benchmark windows of one broadcast; a larger benchmark is taken in that many windows at a time.
SHARD_WINDOWS = 500_000
_REMEMBERED = 20_000  # words a task remembers in their canonical form

MATCH = "array<struct<item_id:long,start:int,n_words:int,changed:int>>"


#: Different literal words of a template that is shorter than a window, and different words of an item that is met anywhere word by word;
#: an item of fewer is met where it is all of a line.
FEW = 3
_PARTS = re.compile(r"\d+(?:[.,:/]\d+)*|[^\W\d_]+|[^\w\s,;]")
_OPERATORS = set("=+*/^()<>,;")


@dataclass
class Word:
    """Hashes of the canonical forms and of the word itself, the slot's type ('' for a literal word) and value, and whether a mark ends a name here."""

    plain: int
    named: int
    raw: int
    kind: str
    value: bytes
    ends: bool = False


def _slot(code: int, kind: str, value: bytes) -> Word:
    return Word(code, code, xxhash.xxh64_intdigest(value), kind, value)


def canonical(word: bytes) -> tuple[Word, ...]:
    """One word, or a number and its unit written as one."""
    core = word.strip(_MARKS)
    text = core.decode(errors="replace")
    low = text.lower().encode()
    if _NUMBER.fullmatch(text) or low in _SPELLED:
        return (_slot(1, "number", low.replace(b",", b"")),)
    if low in _UNITS:
        return (_slot(2, "unit", low),)
    joined = _JOINED.fullmatch(text.lower())
    if joined:
        number, unit = (x.encode() for x in joined.groups())
        if unit in _ORDINAL:
            return (_slot(1, "number", low),)
        if unit in _UNITS or unit in _HALVES:
            return _slot(1, "number", number.replace(b",", b"")), _slot(2, "unit", unit)
    parts = low.split(b"-")
    numeral = [bool(_NUMBER.fullmatch(p.decode(errors="replace"))) or p in _SPELLED for p in parts]
    if len(parts) > 1 and all(numeral[:-1]):
        if numeral[-1] or parts[-1] in _SPELLED_ORDINAL:
            return (_slot(1, "number", low),)
        if parts[-1] in _UNITS:
            return _slot(1, "number", b"-".join(parts[:-1])), _slot(2, "unit", parts[-1])
    if any(c.isdecimal() for c in text) and not _OPERATORS.isdisjoint(text):
        parts = tuple(_part(x) for x in _PARTS.findall(text.lower()))
        if parts:
            return parts
    plain = xxhash.xxh64_intdigest(low)
    if text[:1].isupper() and len(text) > 1:
        ends = word.rstrip(b"\"')]}*_")[-1:] in _ENDS and len(text) > 2  # not an initial or a short title
        return (Word(plain, 3, plain, "name", low, ends),)
    return (Word(plain, plain, plain, "", low),)


def _part(text: str) -> Word:
    """A number, a run of letters or a sign inside a word."""
    data = text.encode()
    if text[0].isdecimal():
        return _slot(1, "number", data.replace(b",", b""))
    plain = xxhash.xxh64_intdigest(data)
    return Word(plain, plain, plain, "", data)


class Canonical:
    """Canonical words with those met before remembered, up to a bound."""

    def __init__(self):
        self.known: dict[bytes, tuple[Word, ...]] = {}

    def __call__(self, items: list[bytes]) -> list[tuple[Word, ...]]:
        known, out = self.known, []
        for w in items:
            got = known.get(w)
            if got is None:
                if len(known) >= _REMEMBERED:
                    known.clear()
                got = known[w] = canonical(w)
            out.append(got)
        return out


class Sequence:
    """The words of a text in one form; in the named form a run of names is one."""

    def __init__(self, read: list[tuple[Word, ...]], form: str):
        self.form = form
        self.own = [w for parts in read for w in parts]
        self.hashes = np.array([getattr(w, form) for w in self.own], dtype=np.uint64)
        at = np.arange(len(read)) if len(self.own) == len(read) else np.repeat(np.arange(len(read)), [len(parts) for parts in read])
        self.first, self.edges = at, None
        if form == "named":
            name = self.hashes == 3
            goes_on = np.flatnonzero(name[1:] & name[:-1]) + 1
            goes_on = [i for i in goes_on.tolist() if not self.own[i - 1].ends]
            if goes_on:
                stays = np.delete(np.arange(len(self.own)), goes_on)
                self.edges = np.append(stays, len(self.own))
                self.hashes, self.first = self.hashes[stays], at[stays]
        self.last = at if self.edges is None else at[self.edges[1:] - 1]

    def __len__(self) -> int:
        return len(self.hashes)

    def slot(self, at: int) -> tuple[str, bytes] | None:
        """Type and value where this form has a slot."""
        if self.edges is None:
            w = self.own[at]
            return (w.kind, w.value) if w.kind and (self.form == "named" or w.kind != "name") else None
        parts = self.own[self.edges[at] : self.edges[at + 1]]
        return (parts[0].kind, b" ".join(w.value for w in parts)) if parts[0].kind else None

    def words(self, start: int, end: int) -> tuple[int, int]:
        """Where a run begins and ends in words of the text."""
        return int(self.first[start]), int(self.last[end - 1]) + 1


FORMS = ("plain", "named", "raw")


@dataclass
class Index:
    """Hashed windows of some benchmark items, by form, width and whether the whole item has to match: sorted hashes with the item and start of each."""

    window: int
    items: dict[tuple[int, str], Sequence] = field(default_factory=dict)
    tables: dict[tuple[str, int, bool], tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=dict)
    ids: list[int] = field(default_factory=list)
    lines: dict[bytes, list[int]] = field(default_factory=dict)  # items of few words by their hashes
    sought: "Sought | None" = None

    @staticmethod
    def build(texts: list[tuple[int, str]], window: int, literals: int) -> "Index":
        """Windows with enough literal words stand for themselves. An item with other windows, or shorter than one, is also sought as a whole,
        by its window of most literal words; and its other windows are sought word by word if their words differ enough. What is left of an
        item after that is sought as a line of its own."""
        index, rows, read = Index(window), {}, Canonical()
        for number, (_, text) in enumerate(texts):
            own = read(words(text))
            if own and len({w.raw for parts in own for w in parts}) < FEW:
                index.lines.setdefault(Sequence(own, "raw").hashes.tobytes(), []).append(number)
            for form in FORMS:
                index.items[number, form] = seq = Sequence(own, form)
                width = min(window, len(seq))
                if not width:
                    continue
                literal = [{int(seq.hashes[i]) for i in range(s, s + width) if not seq.slot(i)} for s in range(len(seq) - width + 1)]
                if form == "raw":
                    seen = [{int(h) for h in seq.hashes[s : s + width]} for s in range(len(literal))]
                    # the plain form has the other windows
                    strong = [s for s in range(len(literal)) if literal[s] and len(literal[s]) < literals <= len(seen[s])]
                    whole = min(map(len, literal)) < literals and len({int(h) for h in seq.hashes}) >= FEW
                else:
                    strong = [s for s in range(len(literal)) if len(literal[s]) >= literals]
                    own_words = len({int(h) for i, h in enumerate(seq.hashes) if not seq.slot(i)})
                    whole = len(strong) < len(literal) and own_words >= (FEW if len(seq) < window else 1)
                for s in strong:
                    rows.setdefault((form, width, False), []).append((number, s))
                if whole:
                    rows.setdefault((form, width, True), []).append((number, max(range(len(literal)), key=lambda s: len(literal[s]))))
        index.ids = [item for item, _ in texts]
        index.sought = Sought.of([text for _, text in texts], rows, sorted({i for places in index.lines.values() for i in places}), window)
        for (form, width, whole), places in rows.items():
            hashes = np.array([_hash(index.items[i, form].hashes[s : s + width], width)[0] for i, s in places], dtype=np.uint64)
            order = np.argsort(hashes, kind="stable")
            index.tables[form, width, whole] = hashes[order], np.array([p[0] for p in places])[order], np.array([p[1] for p in places])[order]
        return index

    def matches(self, text: str, read: "Canonical") -> list[dict]:
        """Longest consistent runs of windows, by item: item_id, start, n_words, and how many slots have other values."""
        own = read(words(text))
        hits: dict[tuple[int, str, int], set[tuple[int, int]]] = {}
        seqs: dict[str, Sequence] = {}
        shingled: dict[tuple[str, int], np.ndarray] = {}
        for (form, width, whole), (hashes, items, starts) in self.tables.items():
            if form not in seqs:
                seqs[form] = Sequence(own, form)
            if len(seqs[form]) < width:
                continue
            if (form, width) not in shingled:
                shingled[form, width] = _hash(seqs[form].hashes, width)
            got = shingled[form, width]
            left = np.searchsorted(hashes, got)
            for at in np.flatnonzero(hashes[np.minimum(left, len(hashes) - 1)] == got):
                k = left[at]
                while k < len(hashes) and hashes[k] == got[at]:
                    shift, size = int(at) - int(starts[k]), len(self.items[items[k], form])
                    if not whole:
                        hits.setdefault((int(items[k]), form, shift), set()).add((int(at), width))
                    elif shift >= 0 and shift + size <= len(seqs[form]):
                        hits.setdefault((int(items[k]), form, shift), set()).add((shift, size))
                    k += 1
        runs: dict[int, list[tuple[int, int, int]]] = {}
        if self.lines:
            at = 0
            for line in text.split("\n"):
                n = len(words(line))
                if n:
                    for item in self.lines.get(Sequence(own[at : at + n], "raw").hashes.tobytes(), ()):
                        runs.setdefault(item, []).append((at, at + n, 0))
                at += n
        for (item, form, shift), places in hits.items():
            runs.setdefault(item, []).extend(self._runs(seqs[form], self.items[item, form], shift, sorted(places, key=lambda p: (p[0], -p[1]))))
        out = []
        for item, found in runs.items():
            kept: list[tuple[int, int, int]] = []
            for start, end, changed in sorted(found, key=lambda r: (r[0], -r[1], r[2])):
                if all(end > e for _, e, _ in kept):  # else it lies in one that begins no later
                    kept.append((start, end, changed))
            out += [{"item_id": self.ids[item], "start": s, "n_words": e - s, "changed": c} for s, e, c in kept]
        return sorted(out, key=lambda m: (m["item_id"], m["start"], m["n_words"], m["changed"]))

    @staticmethod
    def _runs(own: Sequence, item: Sequence, shift: int, places: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
        """Runs of windows that overlap or touch and whose slots agree. Where a window disagrees with the run so far, the next run begins
        with the earliest of the windows before it that all agree with it."""
        alike = [(at, w) for at, w in places if (own.hashes[at : at + w] == item.hashes[at - shift : at - shift + w]).all()]
        slots = [[(y, own.slot(i)) for i in range(at, at + w) if (y := item.slot(i - shift))] for at, w in alike]

        def agree(there: dict, back: dict, more: list) -> bool:
            return all(there.setdefault(y, x) == x and back.setdefault(x, y) == y for y, x in more)

        runs, first, end, there, back = [], None, -1, {}, {}

        def close() -> None:
            if first is not None and there is not None:
                runs.append((*own.words(alike[first][0], end), sum(a != b for a, b in there.items())))

        for k, (at, width) in enumerate(alike):
            new_there, new_back = dict(there), dict(back)
            if first is not None and at <= end and agree(new_there, new_back, slots[k]):
                there, back, end = new_there, new_back, max(end, at + width)
                continue
            new_there, new_back = {}, {}
            if not agree(new_there, new_back, slots[k]):
                continue  # it disagrees with itself
            close()
            begin, reach, last = k, at, end
            while first is not None and at <= last and begin > first:
                try_there, try_back = dict(new_there), dict(new_back)
                if alike[begin - 1][0] + alike[begin - 1][1] < reach or not agree(try_there, try_back, slots[begin - 1]):
                    break
                begin, new_there, new_back = begin - 1, try_there, try_back
                reach = alike[begin][0]
            first, there, back = begin, new_there, new_back
            end = max(a + w for a, w in alike[begin : k + 1])
        close()
        return runs


@lru_cache(1)
def _odd() -> frozenset[str]:
    """Characters whose case or digits the array form reads otherwise than the word form: texts with these are looked at word by word."""
    def is_odd(c: str) -> bool:
        low = c.lower()
        return (c != low) != c.isupper() or len(low.encode()) != len(c.encode()) or c == "\u03a3" or c.isdecimal()

    return frozenset(c for c in map(chr, range(0x80, sys.maxunicode + 1)) if not "\ud800" <= c < "\ue000" and is_odd(c))


def is_odd(text: str) -> bool:
    return not text.isascii() and not _odd().isdisjoint(text)


def _flags(values: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(values)] = True
    return out


_IS_BLANK, _IS_MARK, _IS_DIGIT, _IS_CLOSER, _IS_END = (_flags(x) for x in (b" \t\n\v\f\r", _MARKS, b"0123456789", b"\"')]}*_", b".,;:!?"))
_LEAD = np.ones(256, dtype=np.int64)  # bytes of a character by its first one
_LEAD[0xC0:0xE0], _LEAD[0xE0:0xF0], _LEAD[0xF0:] = 2, 3, 4


@lru_cache(20_000)
def _literal(data: bytes) -> int:
    block = np.frombuffer(data, dtype=np.uint8)
    return int(range_hashes(block, np.array([0]), np.array([len(block)]))[0])


@lru_cache(1)
def _special() -> np.ndarray:
    return np.sort(np.array([_literal(w) for w in _SPELLED | _UNITS], dtype=np.uint64))


@dataclass
class Codes:
    """The canonical parts of some texts as arrays: hashes by form, text, whether a name ends there, and whether a line begins and ends."""

    hashes: dict[str, np.ndarray]
    text: np.ndarray
    opens: np.ndarray
    closes: np.ndarray

    @staticmethod
    def read(texts: list[str]) -> "Codes":
        blocks = [_read_block(*block) for block in pieces_of(texts)]
        plain, named, raw, ends, owner, opens = (np.concatenate(x) for x in zip(*blocks)) if blocks else (np.zeros(0, dtype=np.uint64),) * 6
        opens, ends, owner = opens.astype(bool), ends.astype(bool), owner.astype(np.int64)
        opens[1:] |= owner[1:] != owner[:-1]
        opens[:1] = True
        closes = np.append(opens[1:], True)[: len(opens)]
        codes = Codes({"plain": plain, "raw": raw}, owner, opens, closes)
        name = named == 3
        goes_on = np.zeros(len(name), dtype=bool)
        goes_on[1:] = name[1:] & name[:-1] & ~ends[:-1] & (owner[1:] == owner[:-1])
        codes.hashes["named"], codes.named_text = named[~goes_on], owner[~goes_on]
        return codes

    def text_of(self, form: str) -> np.ndarray:
        return self.named_text if form == "named" else self.text


def _read_block(data: np.ndarray, low: np.ndarray, owner_of: np.ndarray, piece_starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Parts of a block of whole words: plain, named and raw hashes, whether a name ends, the text, and whether a line begins."""
    inside = ~_IS_BLANK[data]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    breaks = np.cumsum(data == 10)
    at_start = breaks[start] if len(start) else start
    opens = np.concatenate((at_start[:1] > 0, at_start[1:] != at_start[:-1]))
    owner = owner_of[np.searchsorted(piece_starts, start, side="right") - 1]
    # without marks at the ends
    s, e = start.copy(), end.copy()
    first, last = (np.flatnonzero(m) for m in (_IS_MARK[data[start]], _IS_MARK[data[end - 1]])) if len(start) else (start, start)
    if len(first) or len(last):
        core = np.append(np.flatnonzero(~_IS_MARK[data]), len(data))
        s[first] = np.minimum(core[np.searchsorted(core, start[first])], end[first])
        e[last] = np.minimum(core[np.searchsorted(core, end[last]) - 1] + 1, end[last])
        e = np.maximum(e, s)
    plain = range_hashes(low, s, e)
    # names: a capital first, and more letters
    safe = np.minimum(s, len(data) - 1)
    width = _LEAD[data[safe]]
    capital = np.zeros(len(s), dtype=bool)
    for k in range(4):
        at = np.minimum(safe + k, len(data) - 1)
        capital |= (k < width) & (data[at] != low[at])
    name = capital & (e - s > width)
    named = np.where(name, np.uint64(3), plain)
    ends = np.zeros(len(s), dtype=np.uint8)
    marked = np.flatnonzero(name & (e < end))
    if len(marked):
        points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
        other = np.flatnonzero(~_IS_CLOSER[data])
        tail = other[np.searchsorted(other, end[marked]) - 1]
        ends[marked] = _IS_END[data[tail]] & (points[e[marked]] - points[s[marked]] > 2)
    raw = plain.copy()
    # words with numbers, units or parts are few; these are read one by one
    digits, hyphens = (np.concatenate(([0], np.cumsum(m))) for m in (_IS_DIGIT[data], data == 45))
    special = _special()
    place = np.minimum(np.searchsorted(special, plain), len(special) - 1)
    one_by_one = np.flatnonzero((digits[e] > digits[s]) | (hyphens[e] > hyphens[s]) | (special[place] == plain))
    parts, several = np.ones(len(s), dtype=np.int64), {}
    for i in one_by_one.tolist():
        got = canonical(data[start[i] : end[i]].tobytes())
        if len(got) == 1 and got[0].kind in ("", "name"):
            continue
        if len(got) == 1:
            plain[i], named[i], raw[i], ends[i] = got[0].plain, got[0].named, got[0].raw, 0
        else:
            parts[i], several[i] = len(got), got
    if not several:
        return plain, named, raw, ends, owner, opens
    where = np.cumsum(parts) - parts
    plain, named, raw, ends, owner, opens = (np.repeat(x, parts) for x in (plain, named, raw, ends, owner, opens))
    for i, got in several.items():
        for k, w in enumerate(got):
            at = where[i] + k
            literal = _literal(w.value) if not w.kind else None
            plain[at], named[at], raw[at], ends[at] = (w.plain, w.named, w.raw, 0) if literal is None else (literal, literal, literal, 0)
            opens[at] &= k == 0
    return plain, named, raw, ends, owner, opens


@dataclass
class Sought:
    """Hashes of the windows of a benchmark as the array form has them: sorted, by form and width, and those that begin a line."""

    tables: dict[tuple[str, int], np.ndarray]
    lines: dict[int, np.ndarray]

    @staticmethod
    def of(texts: list[str], rows: dict, line_items: list[int], window: int) -> "Sought":
        codes = Codes.read(texts)
        first = {form: np.searchsorted(codes.text_of(form), np.arange(len(texts))) for form in FORMS}
        tables: dict[tuple[str, int], list] = {}
        for (form, width, _), places in rows.items():
            hashes = shingles(codes.hashes[form], width)
            tables.setdefault((form, width), []).append(hashes[[first[form][i] + start for i, start in places]])
        lines: dict[int, list] = {}
        for i in line_items:
            size = int((codes.text == i).sum())
            lines.setdefault(min(size, window), []).append(shingles(codes.hashes["raw"][first["raw"][i] :][:size], min(size, window))[:1])
        return Sought({k: np.unique(np.concatenate(v)) for k, v in tables.items()}, {k: np.unique(np.concatenate(v)) for k, v in lines.items()})

    def texts(self, texts: list[str]) -> np.ndarray:
        """Which texts hold a window of the benchmark; texts the array form cannot read are among them."""
        hit = np.fromiter(map(is_odd, texts), dtype=bool, count=len(texts))
        codes = Codes.read(["" if odd else t for odd, t in zip(hit, texts)])
        made: dict[tuple[str, int], np.ndarray] = {}
        for (form, width), hashes in self.tables.items():
            owner = codes.text_of(form)
            got = made[form, width] = shingles(codes.hashes[form], width)
            found = np.flatnonzero(_among(got, hashes))
            hit[owner[found[owner[found] == owner[found + width - 1]]]] = True
        for width, hashes in self.lines.items():
            got = made["raw", width] if ("raw", width) in made else shingles(codes.hashes["raw"], width)
            found = np.flatnonzero(_among(got, hashes) & codes.opens[: len(got)])
            hit[codes.text[found]] = True
        return hit


def _among(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which values a sorted table holds; most are sorted out by some of their bits."""
    bits = max(16, int(len(table)).bit_length() + 5)
    seen = np.zeros(1 << bits, dtype=bool)
    seen[(table >> np.uint64(64 - bits)).astype(np.int64)] = True
    maybe = np.flatnonzero(seen[(values >> np.uint64(64 - bits)).astype(np.int64)])
    out = np.zeros(len(values), dtype=bool)
    if len(table):
        place = np.minimum(np.searchsorted(table, values[maybe]), len(table) - 1)
        out[maybe] = table[place] == values[maybe]
    return out


def _hash(values: np.ndarray, width: int) -> np.ndarray:
    return shingles(values, width)


def match_benchmark(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 8, literals: int = 5
) -> DataFrame:
    """All columns of docs with matches: an array of (item_id, start, n_words, changed), in words of the document; empty for a clean document.

    A window with `literals` different words that are no slots matches by itself. One with fewer matches word by word if `literals` of its words differ,
    and its whole item does with all slots consistent; an item shorter than a window has to have FEW different literal words for that, or FEW different
    words for a match word by word; an item of fewer matches a line that holds nothing else. Items with null id or text, or without words,
    match nothing; items with equal text all match. Null and empty documents have no matches. A
    column of docs named matches is replaced. Rows are judged one by one from whole texts; repeated rows and empty tables are nothing
    special. The benchmark is broadcast in shards of a bounded number of windows; every document meets every shard, one shard after the
    other, and of more than one shard only the matches are kept in between.
    """
    spark = docs.sparkSession
    text_batches(spark)
    items = benchmark.select(F.col(item_id).cast("long").alias("item"), F.col(item_text).alias("t")).where("item is not null and t is not null")
    size = F.sum(F.size(F.split(F.trim("t"), r"\s+")).cast("long"))
    n = items.agg(F.coalesce(size, F.lit(0))).first()[0]
    shards = max(1, -(-2 * n // SHARD_WINDOWS))

    def index_of(shard: int):
        own = items.where(F.pmod(F.xxhash64("item"), F.lit(shards)) == shard).orderBy("item", "t").collect()
        return spark.sparkContext.broadcast(Index.build([(r["item"], r["t"]) for r in own], window, literals))

    if shards == 1:
        return docs.withColumn("matches", _matcher(index_of(0))(F.col(text)))
    # matches hang on the text alone, so they meet their rows again by two hashes of it
    key = {"__t1": F.xxhash64(text), "__t2": F.xxhash64(F.lit("again"), F.col(text))}
    found = None
    for shard in range(shards):
        index = index_of(shard)
        met = docs.select(F.col(text).alias("__text")).withColumn("__matches", _matcher(index)(F.col("__text"))).where(F.size("__matches") > 0)
        met = cut(met.select(F.xxhash64("__text").alias("__t1"), F.xxhash64(F.lit("again"), "__text").alias("__t2"), "__matches").dropDuplicates(["__t1", "__t2"]))
        index.unpersist()
        found = met if found is None else found.unionByName(met)
    found = found.groupBy("__t1", "__t2").agg(F.sort_array(F.flatten(F.collect_list("__matches"))).alias("__matches"))
    matches = F.coalesce("__matches", F.from_json(F.lit("[]"), MATCH))
    return docs.withColumns(key).join(found, ["__t1", "__t2"], "left").withColumn("matches", matches).drop("__t1", "__t2", "__matches")


def _matcher(index):
    @F.pandas_udf(MATCH)
    def match(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        read = Canonical()
        for batch in texts:
            own = ["" if t is None else t for t in batch]
            hit = index.value.sought.texts(own)
            yield pd.Series([index.value.matches(t, read) if h else [] for t, h in zip(own, hit)])

    return match
