"""Removal of repeated passages by suffix automata over reference shards.

A window is a run of consecutive words; a word goes when a window over it has been seen before, in a document of smaller
id or earlier in its own. Automata of a whole corpus have no bounded size, so they are not broadcast: a shard's automaton
is built where everything that can match it meets. Each window has an anchor, the smallest hash among its
runs of a few words, and equal windows have equal anchors. Anchors met once are dropped; for the others the pieces of text
whose windows have that anchor are gathered, in order of documents, and streamed through an online suffix automaton:
the matching statistics at each word tell whether the window ending there was seen. Pieces that fully match add nothing.

Pieces repeated inside one map task are settled there, so a passage in every document sends one piece per task; an
anchor with very many pieces is cut further, one window each, by the hash of the window. Whole copies of a text are
settled by their hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import batches, cut, mix, shingles, signed, whole_groups, word_hashes

_FIRST = -(1 << 63)
_PIECE = 256  # windows of a piece at most


def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over all runs of width values."""
    out, have = x, 1
    while have < width:
        step = min(have, width - have)
        out, have = pick(out[: len(out) - step], out[step:]), have + step
    return out


def anchors(hashes: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The anchor of each window, and the anchor values once for each place where they stand."""
    grams = shingles(hashes, gram)
    width = window - gram + 1
    least = _slide(grams, width, np.minimum)
    around = np.concatenate([np.zeros(width - 1, dtype=np.uint64), least, np.zeros(width - 1, dtype=np.uint64)])
    return least, grams[_slide(around, width, np.maximum) == grams]


class SuffixAutomaton:
    """An online suffix automaton of several word sequences that also reports matching statistics."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]

    def match(self, words: list, window: int) -> list[bool]:
        """For each word, whether the window ending there occurs in what was added before."""
        nxt, link, length = self.next, self.link, self.length
        state, n, out = 0, 0, []
        for w in words:
            while state and w not in nxt[state]:
                state = link[state]
                n = length[state]
            if w in nxt[state]:
                state, n = nxt[state][w], n + 1
            out.append(n >= window)
        return out

    def add(self, words: list, window: int) -> list[bool]:
        """The same, while adding the words one by one, so that a sequence is also matched with its own beginning."""
        nxt, link, length = self.next, self.link, self.length
        state, n, last, out = 0, 0, 0, []
        for w in words:
            while state and w not in nxt[state]:
                state = link[state]
                n = length[state]
            if w in nxt[state]:
                state, n = nxt[state][w], n + 1
            out.append(n >= window)
            last = self._extend(last, w)
            while state and n <= length[link[state]]:
                state = link[state]
        return out

    def _extend(self, last: int, w) -> int:
        nxt, link, length = self.next, self.link, self.length
        if w in nxt[last]:
            q = nxt[last][w]
            return q if length[q] == length[last] + 1 else self._clone(last, q, w)
        new = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][w]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, q, w)
        return new

    def _clone(self, p: int, q: int, w) -> int:
        nxt, link, length = self.next, self.link, self.length
        copy = len(nxt)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        link[q] = copy
        while p >= 0 and nxt[p].get(w) == q:
            nxt[p][w] = copy
            p = link[p]
        return copy


def _spots(window: int, gram: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches(frames, 256):
            hashes, offsets = word_hashes(frame["text"])
            values, counts = [], []
            for a, b in zip(offsets, offsets[1:]):
                found, n = np.unique(anchors(hashes[a:b], window, gram)[1], return_counts=True) if b - a >= window else (np.zeros(0, np.uint64), [])
                values.append(signed(found))
                counts.append(np.asarray(n, dtype=np.int32))
            yield pd.DataFrame({"d": frame["d"].to_numpy(), "h1": frame["h1"].to_numpy(), "h2": frame["h2"].to_numpy(), "n_words": np.diff(offsets), "anchors": values, "places": counts})

    return run


_ROW = "key long, d long, h1 long, start int, windows int, words binary"


def _pieces(window: int, gram: int, many: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[bytes, tuple[int, int, int]] = {}
        for frame in batches(frames, 256):
            hashes, offsets = word_hashes(frame["text"])
            out = []
            for at, row in enumerate(frame.itertuples(index=False)):
                own = hashes[offsets[at] : offsets[at + 1]]
                if len(own) < window:
                    continue
                least, _ = anchors(own, window, gram)
                least = signed(least)
                known = np.asarray(row.known)
                order = np.argsort(known)
                found = np.minimum(np.searchsorted(known, least, sorter=order), len(known) - 1)
                hot = np.asarray(row.places)[order][found] > many
                wanted = known[order][found] == least
                hashed = signed(shingles(own, window)) if (hot & wanted).any() else None
                edges = np.flatnonzero(np.concatenate(([True], (least[1:] != least[:-1]) | hot[1:] | hot[:-1], [True])))
                words = row.text.encode().split()
                for a, b in zip(edges, edges[1:]):
                    if not wanted[a]:
                        continue
                    for s in range(a, b, _PIECE):
                        n = min(b - s, _PIECE)
                        text = b" ".join(words[s : s + n + window - 1])
                        key = int(hashed[s]) if hot[a] else int(least[s])
                        name = xxhash.xxh3_128_digest(text)
                        place = (row.d, row.h1, s)
                        if seen.get(name) == place:
                            continue  # of a row equal in id and text
                        if name in seen:
                            out.append((int(mix(np.array([row.d ^ row.h1], dtype=np.int64).view(np.uint64)).view(np.int64)[0]), row.d, row.h1, s, n, None))
                        else:
                            seen[name] = place
                            out.append((key, row.d, row.h1, s, n, text))
            yield pd.DataFrame(out, columns=["key", "d", "h1", "start", "windows", "words"])

    return run


def _repeats_itself(words: list[bytes], window: int) -> bool:
    n = len(words) - window + 1
    return len({tuple(words[i : i + window]) for i in range(n)}) < n


def seen_windows(pieces: list[list[bytes]], window: int) -> list[list[bool]]:
    """For each window of each piece, in order, whether it occurs earlier: in a piece before, or further left in its own.

    A piece is added to the automaton only for what it brings: not when all its windows are known, nor at the end.
    """
    automaton, out = SuffixAutomaton(), []
    for at, words in enumerate(pieces):
        flags = automaton.match(words, window) if at else [False] * len(words)
        known = all(flags[window - 1 :])
        if not known and (at < len(pieces) - 1 or _repeats_itself(words, window)):
            flags = automaton.add(words, window)
        out.append(flags[window - 1 :])
    return out


def _matched(window: int):
    def ranges(frames: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        for frame in whole_groups(frames, ["key"]):
            key = frame["key"].to_numpy()
            edges = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
            d, h1, start, windows, words = (frame[c].tolist() for c in ("d", "h1", "start", "windows", "words"))
            for a, b in zip(edges, edges[1:]):
                fresh, known = [], {}
                for i in range(a, b):
                    place = (d[i], h1[i], start[i])
                    if words[i] is None or known.get(words[i], place) != place:
                        yield d[i], h1[i], start[i], windows[i]
                    elif words[i] not in known:  # else of a row equal in id and text
                        known[words[i]] = place
                        fresh.append(i)
                pieces = [words[i].split() for i in fresh]
                if len(pieces) == 1 and not _repeats_itself(pieces[0], window):
                    continue
                for i, flags in zip(fresh, seen_windows(pieces, window)):
                    if True in flags:
                        change = np.flatnonzero(np.diff(np.array([False, *flags, False], dtype=np.int8))).tolist()
                        for x, y in zip(change[::2], change[1::2]):
                            yield d[i], h1[i], start[i] + x, y - x

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = []
        for r in ranges(frames):
            rows.append(r)
            if len(rows) >= 20_000:
                yield pd.DataFrame(rows, columns=["d", "h1", "start", "windows"])
                rows = []
        yield pd.DataFrame(rows, columns=["d", "h1", "start", "windows"])

    return run


def _kept(window: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches(frames, 256):
            out = []
            for row in frame.itertuples(index=False):
                words = row.text.encode().split() if row.text else []
                gone = np.zeros(len(words) + 1, dtype=np.int64)
                for f in row.flags if row.flags is not None else ():
                    gone[f["start"]] += 1
                    gone[min(len(words), f["start"] + f["windows"] + window - 1)] -= 1
                covered = np.cumsum(gone[:-1]) > 0
                kept = b" ".join([w for w, c in zip(words, covered) if not c]) if covered.any() else b" ".join(words)
                out.append((len(words), int(covered.sum()), kept.decode()))
            yield pd.DataFrame(out, columns=["n_words", "n_removed", "kept_text"]).assign(d=frame["d"].to_numpy(), no_id=frame["no_id"].to_numpy())

    return run


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 20, gram: int = 8, many: int = 4096
) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_removed, kept_text (kept words with one blank between).

    Words are runs between ASCII blanks, compared as bytes. Documents are ordered by id, rows without id before all others, rows of
    one id by a hash of their text; rows equal in both count as one, and its flags hold for all of them. Null and empty texts have no words; texts shorter than the
    window lose nothing. Other columns are ignored; an empty table gives an empty result.
    """
    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    # rows without id share d, so what belongs to a row is found by d and h1; the two joins with the texts take the same columns, so that
    # Spark exchanges them once
    base = base.select(F.coalesce("doc_id", F.lit(_FIRST)).alias("d"), F.xxhash64("text").alias("h1"), F.col("doc_id").isNull().alias("no_id"), "text")
    described = base.select("d", "h1", F.xxhash64(F.lit("again"), "text").alias("h2"), "text").mapInPandas(_spots(window, gram), "d long, h1 long, h2 long, n_words int, anchors array<long>, places array<int>")
    spots = cut(described.where(F.col("n_words") >= window))
    first = spots.groupBy("h1", "h2").agg(F.min("d").alias("first"), F.count("*").alias("copies")).where("copies > 1").drop("copies")
    ranked = cut(spots.select("d", "h1", "h2", "n_words").join(first, ["h1", "h2"]).where("d > first"))
    copies = ranked.select("d", "h1", F.lit(0).alias("start"), (F.col("n_words") - window + 1).alias("windows"))
    leads = spots.join(ranked.select("d", "h1", "h2"), ["d", "h1", "h2"], "left_anti")
    placed = leads.select("d", "h1", F.explode(F.arrays_zip("anchors", "places")).alias("x")).select("d", "h1", F.col("x.anchors").alias("anchor"), F.col("x.places").alias("places"))
    repeated = placed.groupBy("anchor").agg(F.sum("places").cast("int").alias("places")).where("places > 1")
    wanted = cut(
        placed.select("d", "h1", "anchor").join(repeated, "anchor").groupBy("d", "h1")
        .agg(F.collect_set(F.struct("anchor", "places")).alias("x")).select("d", "h1", F.col("x.anchor").alias("known"), F.col("x.places").alias("places"))
    )
    pieces = (
        base.join(wanted, ["d", "h1"]).select("d", "h1", "no_id", "text", "known", "places")
        .sortWithinPartitions("d", "h1")
        .mapInPandas(_pieces(window, gram, many), _ROW)
    )
    matched = (
        pieces.repartition("key").sortWithinPartitions("key", "d", "h1", "start").mapInPandas(_matched(window), "d long, h1 long, start int, windows int")
    )
    flags = matched.union(copies).groupBy("d", "h1").agg(F.collect_set(F.struct("start", "windows")).alias("flags"))
    return (
        base.join(flags, ["d", "h1"], "left")
        .select("d", "no_id", "text", "flags")
        .mapInPandas(_kept(window), "d long, no_id boolean, n_words long, n_removed long, kept_text string")
        .select(F.expr("if(no_id, null, d)").alias("doc_id"), "n_words", "n_removed", "kept_text")
    )
