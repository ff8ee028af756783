"""Source divergence, vector codes and quality rules against brute force, with odd rows."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm import divergence, quality_rules, vector_codes

DOCS = T.StructType([T.StructField("doc_id", T.LongType())] + [T.StructField(c, T.StringType()) for c in ("lang", "source", "text")])


# source divergence


def brute_audit(rows, least_docs, top):
    terms = lambda t: re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    df, n, sources = Counter(), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source, found = lang or "", source or "", terms(text)
        sources[lang].add(source)
        df.update((lang, t) for t in set(found))
        n[lang, source].update(found)
    out = set()
    for lang, names in sources.items():
        kept = sorted(t for (of, t), d in df.items() if of == lang and d >= least_docs)
        p = {}
        for name in [*names, None]:
            count = n[lang, name] if name is not None else sum((n[lang, s] for s in names), Counter())
            total = sum(count[t] for t in kept) + 5 * len(kept)
            p[name] = {t: 1 + 10**9 * (count[t] + 5) // total for t in kept}
        for s in names:
            far = sorted(((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in names if o != s))
            out |= {(lang, s, "pair", o.decode(), -v, k) for k, (v, o) in enumerate(far, 1)}
            more = sorted((p[None][t] - p[s][t], t.encode()) for t in kept if n[lang, s][t] and p[s][t] > p[None][t])
            out |= {(lang, s, "term", t.decode(), -v, k) for k, (v, t) in enumerate(more[:top], 1)}
    return out


def audited(docs, **how):
    rows = divergence.audit_sources(docs, **how).collect()
    got = {(r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in rows}
    assert len(got) == len(rows)
    return got


def odd_documents():
    rng = random.Random(11)
    stems = ["Abcdefgh", "abcdefghi", "abcdefghijklmnop", "ABCDEFGHIJKLMNOPq", "é", "été", "straße", "x", "zz", "日本語のことば", "a" * 70, "a" * 71, "a" * 70 + "b", "\U0001f600"]
    rows = []
    for _ in range(300):
        text = "".join(rng.choice(stems[: rng.randrange(2, len(stems) + 1)]) + rng.choice([" ", "\n", "7", "-", "\t_"]) for _ in range(rng.randrange(0, 40)))
        rows.append((rng.choice(["en", "de", None]), rng.choice(["a", "b", "B", None, ""]), text))
    rows += [("fr", "only", "seul"), ("it", "p", None), ("it", "q", ""), ("en", "long", "Abcdefgh " * 50_000), ("en", "long", "é" * 300_000)]
    return rows + rows[:20]


def test_audit_equals_brute_force(spark, monkeypatch):
    rows = odd_documents()
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], DOCS).selectExpr("*", "1 as n", "2 as p", "'x' as term", "3 as total", "4 as bucket")
    assert audited(docs.repartition(5), least_docs=10, top=4) == brute_audit(rows, 10, 4)
    for name, value in {"SHARD_BYTES": 2000, "ROWS_PER_TASK": 7, "CELLS": 20, "SOURCES_PER_TASK": 2}.items():  # many shards, tasks and blocks
        monkeypatch.setattr(divergence, name, value)
    assert audited(docs.repartition(3), least_docs=3, top=50) == brute_audit(rows, 3, 50)


def test_audit_of_nothing(spark):
    assert audited(spark.createDataFrame([], DOCS)) == set()
    one = spark.createDataFrame([(1, None, None, None), (2, "", "s", "a b c")], DOCS)
    assert audited(one) == {("", "", "pair", "s", 0, 1), ("", "s", "pair", "", 0, 1)}


def test_shares_are_exact_where_products_leave_64_bits(spark):
    big = spark.range(1).select(F.lit(123_456_789_012_345).alias("n"), F.lit(987_654_321_098_765).alias("total"))
    assert big.select(divergence.share("n", "total")).first()[0] == 1 + 10**9 * (123_456_789_012_345 + 5) // 987_654_321_098_765


def test_pointers_come_in_byte_order():
    texts = [r[2] or "" for r in odd_documents()]
    data, offsets = divergence._bytes(pa.array(["skipped", *texts]).slice(1))
    start, length = divergence.term_pointers(data, offsets)
    order, new = divergence.sort_pointers(data, start, length)
    terms = [data[s : s + n].tobytes() for s, n in zip(start[order], length[order])]
    assert terms == sorted(terms) and new.tolist() == [True] + [a != b for a, b in zip(terms, terms[1:])]
    assert sorted(terms) == sorted(t.encode() for text in texts for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text))


# vector codes


def brute_codes(rows, rounds=2):
    """rows: (vec_id, components, label) that can be coded, by id."""
    whole = [[int(np.floor(np.float64(x) * 256)) for x in v] for _, v, _ in rows]
    width = len(whole[0]) // 16
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for v in whole[:64]] for p in range(16)]
    best = lambda part, book: min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(16):
            of = defaultdict(list)
            for v in whole:
                of[best(cut(v, p), books[p])[1]].append(cut(v, p))
            books[p] = [[sum(c) // len(of[k]) for c in zip(*of[k])] if of[k] else e for k, e in enumerate(books[p])]
    found = [[best(cut(v, p), books[p]) for p in range(16)] for v in whole]
    errors, by_label = [sum(d for d, _ in f) for f in found], Counter()
    for (_, _, label), e in zip(rows, errors):
        by_label[label] += e
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted((i, "".join(f"{k:02x}" for _, k in f), e, by_label[label], sha) for (i, _, label), f, e in zip(rows, found, errors))


VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType())])


def coded(vectors):
    rows = vector_codes.compress_vectors(vectors).collect()
    return sorted((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in rows)


@pytest.mark.parametrize("n", [3, 64, 400])
def test_codes_equal_brute_force(spark, n, monkeypatch):
    rng = np.random.default_rng(n)
    base = (rng.integers(-40, 40, (n, 32)) / 128 + rng.normal(0, 0.001, (n, 32)) * (np.arange(n) % 2)[:, None]).astype(np.float32)
    base[n // 2 :] = base[: n - n // 2]  # ties and repeated vectors
    rows = [(i * 7 - 9, [float(x) for x in v], None if i % 5 == 0 else i % 3) for i, v in enumerate(base)]
    odd = [(-100, None, 1), (-101, [], 1), (-102, [None] + [0.0] * 31, 1), (-103, [float("nan")] * 32, 1), (-104, [float("inf")] * 32, 1)]
    vectors = spark.createDataFrame([*rows, *odd], VECTORS).selectExpr("*", "'x' as code", "1 as error", "2 as of_label", "3 as n")
    want = brute_codes(rows)
    assert coded(vectors.repartition(3)) == want
    monkeypatch.setattr(vector_codes, "SUBTREE", 5)
    monkeypatch.setattr(vector_codes, "ROWS_AT_ONCE", 30)
    assert coded(vectors.repartition(1)) == want


def test_codes_of_odd_tables(spark):
    assert coded(spark.createDataFrame([], VECTORS)) == []
    assert coded(spark.createDataFrame([(1, None, 1), (2, [1.0] * 15, 1)], VECTORS)) == []
    rows = [(5, [0.5] * 16, 1), (5, [0.5] * 16, 1), (None, [0.25] * 16, None), (6, [1.0] * 32, 1), (7, [3e6] * 16, 1)]
    got = vector_codes.compress_vectors(spark.createDataFrame(rows, VECTORS)).collect()
    # another length and a component too large are left out; equal rows share the first entry, and the second stays as it was
    assert sorted((r.vec_id or 0, r.code, r.error) for r in got) == [(0, "02" * 16, 0), (5, "00" * 16, 0), (5, "00" * 16, 0)]


def test_trie_distances_equal_direct_ones():
    rng = np.random.default_rng(4)
    parts, entries = rng.integers(-9, 9, (9000, 4)), rng.integers(-9, 9, (64, 4))
    leaves, leaf = vector_codes.distinct_parts(parts)
    assert (leaves[leaf] == parts).all() and [tuple(x) for x in leaves.tolist()] == sorted(set(map(tuple, parts.tolist())))
    nearest, error = vector_codes.walk(leaves, entries)
    direct = ((leaves[:, None, :] - entries[None]) ** 2).sum(axis=2)
    assert (nearest == direct.argmin(axis=1)).all() and (error == direct.min(axis=1)).all()


# quality rules


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    repeated = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeated), len(lines)


def rule_documents():
    rng = random.Random(13)
    rows = []
    for i in range(600):
        words = [rng.choice(["alpha", "beta", "gamma", "naïve", "delta,", "日本"]) + str(rng.randrange(40)) for _ in range(rng.randrange(0, 120))]
        rows.append((i, rng.choice(["en", "de", None]), rng.choice(["a", "b", None]), "".join(w + rng.choice([" ", " ", "\n", "\t"]) for w in words)))
    rows += [(1000, "en", "a", None), (1001, "en", "a", ""), (1002, "en", "a", " \n\t "), (1003, "en", "a", "### *** " * 40), (1004, "xx", "rare", " ".join(f"gamma{i}" for i in range(30)))]
    rows += [(1005, "en", "a", "\n".join(f"$$$ word{i} %%%" for i in range(60))), (1006, "en", "a", " ".join("x" * 90 + str(i) for i in range(40)))]
    rows += [(1007, "en", "b", "one two three four five six " * 3 + " ".join(f"v{i}" for i in range(200))), (1008, "en", "b", "a b c\n" * 9 + "a b c \n")]
    return rows + rows[:5]


def test_rule_counts_equal_brute_force(spark):
    rows = rule_documents() + [(2000, "en", "a", "long word " * 100_000), (2001, "en", "a", " ".join(f"k{i % 70000}" for i in range(100_000)))]
    got = quality_rules.text_counts(spark.createDataFrame(rows, ["doc_id", "lang", "source", "text"]).repartition(3)).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
    assert Counter((r.doc_id, *[r[c] for c in names]) for r in got) == Counter((r[0], *brute_counts(r[3])) for r in rows)


def brute_kept(rows):
    counts = [brute_counts(r[3]) for r in rows]
    failed = [n < 10 or 100 * rep > 20 * n for n, _, _, _, rep, _ in counts]
    rates = [(1000 * c // max(n, 1), 1000 * s // max(n, 1), 1000 * d // max(ln, 1), 1000 * rep // max(n, 1)) for n, c, s, d, rep, ln in counts]
    cut = lambda v: v >> max(v.bit_length() - 7, 0) << max(v.bit_length() - 7, 0)

    def quartiles(k, keep):
        values = sorted(cut(rates[i][k]) for i, r in enumerate(rows) if not failed[i] and keep(r))
        at = lambda q: values[-(-q * len(values) // 4) - 1]
        return (len(values), at(1), at(3)) if values else (0, 0, 0)

    out = []
    for i, row in enumerate(rows):
        ok = not failed[i]
        for k, (spread, both) in enumerate([(100, True), (50, False), (75, False), (30, False)]):
            tries = [lambda r: r[1:3] == row[1:3], lambda r: r[1] == row[1], lambda r: True]
            found = [quartiles(k, t) for t in tries]
            _, low, high = next((f for f in found[:2] if f[0] >= 100), found[2])
            far = 6 * max(high - low, spread)
            ok &= rates[i][k] <= high + far and not (both and rates[i][k] < low - far)
        out.append((row[0], failed[i], ok))
    return Counter(out)


def test_rules_equal_brute_force_and_do_not_hang_on_partitions(spark):
    rows = rule_documents()
    docs = spark.createDataFrame(rows, ["doc_id", "lang", "source", "text"]).selectExpr("*", "1 as rule", "2 as n_words", "3 as low", "4 as t_lang")
    got = quality_rules.apply_rules(docs.repartition(4)).collect()
    assert Counter((r.doc_id, r.base_failed, r.kept) for r in got) == brute_kept(rows)
    assert all(r.kept == (not r.failed_rules) for r in got)
    why = {r.doc_id: r.failed_rules for r in got}
    assert why[1000] == why[1001] == why[1003] == ["base"] and "symbols" in why[1005] and why[1006] == ["word_length"] and why[1004] == []
    again = quality_rules.apply_rules(docs.coalesce(1)).collect()
    assert Counter(map(str, again)) == Counter(map(str, got))


def test_rules_of_nothing(spark):
    assert quality_rules.apply_rules(spark.createDataFrame([], DOCS)).count() == 0
    only = quality_rules.apply_rules(spark.createDataFrame([(None, None, None, None)], DOCS)).first()
    assert only.base_failed and not only.kept and only.n_words == 0


def test_sketches_merge(spark):
    rng = np.random.default_rng(2)
    values = rng.integers(0, 10**9, 5000) >> rng.integers(0, 30, 5000)
    frame = spark.createDataFrame(pd.DataFrame({"part": np.arange(5000) % 7, "rate": values}))
    parts = quality_rules.sketch(frame, ["part"])
    merged = quality_rules.quartiles(parts.withColumn("all", F.lit(1)).groupBy("all", "bucket").agg(F.sum("n").alias("n")), ["all"]).first()
    exact = np.sort(values)[[1249, 3749]]
    assert merged["size"] == 5000 and all(x * 63 / 64 <= q <= x for q, x in zip((merged.low, merged.high), exact))
