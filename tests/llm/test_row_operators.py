"""Sharding, mixing, chats, vectors and the classifier on small tables with odd rows."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import chat, mixing, near_vectors, quality, sharding

from .conftest import prose


def test_shards_are_even_gapless_and_keep_groups(make_docs):
    rng = random.Random(1)
    rows = [(i, prose(rng, rng.randrange(5, 60))) for i in range(3000)]
    rows += [(i, rows[i % 40][1]) for i in range(3000, 3200)] + [(i, "the same text everywhere " * 4) for i in range(3200, 4700)]
    docs = make_docs([*rows, (5000, None), (5001, ""), (5002, "é" * 500), (None, "x"), (7, "y")]).withColumn("slot", F.lit("old"))
    out = sharding.shard_by_bytes(docs, shards=8, rows_per_run=100).collect()
    assert len(out) == docs.count() and {r.shard for r in out} == set(range(8))
    total = [sum(r["size"] for r in out if r.shard == s) for s in range(8)]
    assert max(total) - min(total) <= 0.05 * sum(total) / 8
    assert all(r["size"] == len((r.text or "").encode()) + 8 for r in out)
    for s in range(8):
        slots = sorted(r.slot for r in out if r.shard == s)
        assert slots == list(range(len(slots)))
    small = {}
    for r in out:
        if r.text and not r.text.startswith("the same"):
            small.setdefault(r.text, set()).add(r.shard)
    assert all(len(s) == 1 for s in small.values())
    again = sharding.shard_by_bytes(docs.repartition(7), shards=8, rows_per_run=100).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in out} == {(r.doc_id, r.shard, r.slot) for r in again}


def test_shards_of_few_rows(make_docs):
    assert sharding.shard_by_bytes(make_docs([]), shards=4).count() == 0
    out = sharding.shard_by_bytes(make_docs([(1, "a"), (1, "a"), (2, "bb")]), shards=24).collect()
    assert len(out) == 3 and all(0 <= r.shard < 24 for r in out)
    assert len({r.shard for r in out if r.text == "a"}) == 1


def test_targets():
    got = mixing.targets({"a": 100, "b": 100, "c": 10, None: 50})
    assert got == pytest.approx({"a": 5 * 270 / 7, "b": 2 * 270 / 7, "c": 20, None: 100})
    assert mixing.targets({"a": 0, "b": 0}) == {"a": 0, "b": 0} and mixing.targets({}) == {}


def test_pivot_moves_words_without_loss():
    rng = np.random.default_rng(1)
    size, key = rng.integers(1, 500, 3000), rng.integers(0, 2**62, 3000)
    words = size * rng.uniform(0.01, 0.99, 3000)
    extra, left = mixing.pivot(key, size, words, 0, 9, last=False)
    assert sum(e < 0 for e in extra) <= 1
    assert sum(left) == pytest.approx(words.sum())
    assert all(e < 0 or abs(w - e * s) < 1e-6 for e, w, s in zip(extra, left, size))
    expected = np.mean([np.array(mixing.pivot(key[:40], size[:40], words[:40], 0, s, True)[0]) for s in range(3000)], axis=0)
    assert np.abs(expected - words[:40] / size[:40]).max() < 0.05


def test_mixture_meets_targets_and_reruns_agree(make_docs):
    rng = random.Random(3)
    rows = [(i, prose(rng, rng.randrange(1, 50)), rng.choice(["a", "a", "a", "b", "c", None])) for i in range(3000)]
    rows += [(9000, None, "b"), (9001, "", "zero"), (5, rows[5][1], rows[5][2]), (None, "one two", "a")]
    docs = make_docs(rows).withColumns({
        "size": F.coalesce(F.size(F.split("text", " ")), F.lit(0)), "key": F.xxhash64("doc_id", "source", "text"), "target": F.lit("old")})
    docs = docs.withColumn("size", F.when(F.coalesce("text", F.lit("")) == "", 0).otherwise(F.col("size")))
    out = mixing.mix_sources(docs, leaf_rows=50, fan_in=3).collect()
    assert len(out) == len(rows)
    for source in {r.source for r in out}:
        own = [r for r in out if r.source == source]
        assert sum(r["size"] for r in own) == own[0].source_size
        assert abs(sum(r.taken for r in own) - own[0].target) <= 50
        assert all(r.taken == r.copies * r["size"] <= 2 * r["size"] for r in own)
    again = mixing.mix_sources(docs.repartition(5), leaf_rows=50, fan_in=3).collect()
    assert sorted((str(r.doc_id), r.taken) for r in out) == sorted((str(r.doc_id), r.taken) for r in again)
    assert mixing.mix_sources(docs.limit(0)).count() == 0


ODD = ["</s>", "<|user|>", "<|>", "<\\|", "<\\\\/s>", "\\", "a<", "|>", "<s>", "[INST] x [/INST]", "\n\n", "", None, "é😀<|", "<<|", "<\\s>", "$1 \\1"]


def test_chats_round_trip(spark):
    rng = random.Random(4)
    rows = []
    for conv in range(40):
        for turn in range(rng.randrange(1, 9) if conv else 300):
            rows.append((conv, turn, rng.choice(["user", "assistant", "assistant", "system", "odd|<\\role", None]), "".join(str(rng.choice(ODD) or "") for _ in range(3)) or None))
    rows += [(50, None, "user", "first"), (50, 1, "user", "b"), (50, 1, "user", "a"), (50, 1, "user", "a"), (None, 1, "assistant", "x"), (None, 2, None, None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    made = chat.format_chats(turns)
    out = made.select("*", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_learnt(F.col("formatted"), F.col("loss_spans")).alias("learnt")).collect()
    want = {}
    for c, t, r, x in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((r or "", x or ""))
    assert {r.conv_id: [tuple(t) for t in r.turns] for r in out} == want
    for r in out:
        assert r.learnt == [x for role, x in want[r.conv_id] if role == "assistant"]
        assert r.n_blocks == 1 + sum(a[0] != b[0] for a, b in zip(want[r.conv_id], want[r.conv_id][1:]))
        assert r.formatted.count("</s>") == r.n_blocks
    assert chat.format_chats(turns.limit(0)).count() == 0


def brute_links(rows, cosine=0.98):
    def usable(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    n = [0] * len(rows)
    label = [r[0] for r in rows]
    pairs = []
    for i, (a, x, l) in enumerate(rows):
        for j, (b, y, m) in enumerate(rows[:i]):
            if None not in (a, b, l) and l == m and usable(x) and usable(y) and len(x) == len(y):
                if np.dot(x, y) / np.linalg.norm(x) / np.linalg.norm(y) >= cosine:
                    n[i], n[j] = n[i] + 1, n[j] + 1
                    pairs.append((i, j))
    for _ in rows:
        for i, j in pairs:
            label[i] = label[j] = min(label[i], label[j])
    return sorted((str(r[0]), k, c) for r, k, c in zip(rows, n, label))


@pytest.mark.parametrize("block", [4096, 40])
def test_near_vectors_are_brute_force(spark, block):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(150, 8))
    near = base[rng.integers(0, 150, 150)] + rng.normal(size=(150, 8)) * 0.07
    tight = base[:1] + rng.normal(size=(60, 8)) * 0.05
    rows = [(i, v.tolist(), int(i % 3 == 0)) for i, v in enumerate(np.vstack([base, near, tight, tight[:5], 3 * tight[:2]]))]
    rows += [(900, None, 1), (901, [], 1), (902, [0.0] * 8, 1), (903, [float("nan")] * 8, 1), (904, [None] * 8, 1), (905, rows[0][1], None), (906, [1.0, 2.0], 1), (None, rows[0][1], 1), (907, [float("inf")] * 8, 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("rep", F.lit(1))
    out = near_vectors.link_near_vectors(table, block_rows=block).collect()
    assert sorted((str(r.vec_id), r.n_links, r.component_id) for r in out) == brute_links(rows)
    assert near_vectors.link_near_vectors(table.limit(0)).count() == 0


def test_dual_traversal_in_few_dimensions():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2000, 3))
    x /= np.linalg.norm(x, axis=1)[:, None]
    weight = rng.integers(1, 4, len(x))
    tree = near_vectors.cover_tree(x)
    assert tree.children
    links, _ = near_vectors.dual_links(x, weight, tree, None, 0.98)
    hit = x @ x.T >= 0.98
    np.fill_diagonal(hit, False)
    assert (links == hit @ weight).all()


def test_quality_learns_from_its_folds_only(spark, make_docs):
    rng = random.Random(6)
    rows = [(i, prose(rng, rng.randrange(20, 80)) if i % 3 else "!! ## " * rng.randrange(5, 40)) for i in range(900)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(900)] + [(3, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    docs = make_docs([*rows, (2000, None), (2001, ""), (None, "x y")]).withColumn("score", F.lit("old"))
    out = {r.doc_id: r for r in quality.score_quality(docs, labels).collect()}
    assert len(out) == 903 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out.values())
    held = [i for i in range(900) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(out[i].held_out == (i in set(held)) for i in range(900)) and out[None].held_out is False
    assert np.mean([out[i].predicted == int(i % 3 > 0) for i in held]) > 0.98
    flipped = labels.withColumn("quality", F.when(quality.held_out_by_id(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r.doc_id: r.score for r in quality.score_quality(docs, flipped).collect()}
    assert all(abs(again[i] - out[i].score) < 1e-6 for i in held)
    none = quality.score_quality(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {none[0].score}
    assert quality.score_quality(docs.limit(0), labels).count() == 0


def test_isotonic_levels():
    x, y = np.arange(6.0), np.array([0.0, 1.0, 0.0, 1.0, 0.5, 1.0])
    _, levels = quality.isotonic(x, y, np.ones(6))
    assert list(levels) == [0.0, 0.5, 0.75, 1.0]




def test_mixing_comes_near_its_targets_and_keeps_clashing_columns(make_docs):
    rng = random.Random(21)
    rows = [(i, prose(rng, rng.choice([3, 5, 40, 300]) if i % 50 else 6000), f"s{i % 7}") for i in range(700)]
    docs = make_docs(rows).withColumns({"size": F.size(F.split("text", " ")).cast("long"), "key": F.xxhash64("doc_id", "text")})
    own = ["whole", "extra", "of", "leaves", "part", "source_no", "bucket", "words", "gap", "units"]
    mixed = mixing.mix_sources(docs.withColumns({c: F.lit(c) for c in own}), leaf_rows=20)
    assert all(mixed.where(F.col(c) == c).count() == len(rows) for c in own)
    got = mixed.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max("copies").alias("most")).collect()
    assert len(got) == 7 and all(abs(r.taken - r.target) <= 12 and r.most <= 2 for r in got)
    again = mixing.mix_sources(docs.repartition(5), leaf_rows=20)
    assert {(r.doc_id, r.copies) for r in again.collect()} == {(r.doc_id, r.copies) for r in mixed.collect()}


def test_long_conversations_read_back(spark):
    n = 5000
    turns = [(1, i, ["user", "assistant"][i % 3 > 0], f"turn <|{i}|> </s> é" * (i % 4)) for i in range(n)]
    made = chat.format_chats(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    out = made.select("*", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_learnt(F.col("formatted"), F.col("loss_spans")).alias("learnt")).first()
    assert [(t.role, t.text) for t in out.turns] == [t[2:] for t in turns]
    assert out.learnt == [t[3] for t in turns if t[2] == "assistant"]
