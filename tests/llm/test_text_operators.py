"""Operators on texts against brute force, with nulls, empty and long texts, ties and repeated rows."""

import random

import numpy as np
import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerloom.llm import decontaminate, pseudo_likelihood, shingle_join, substring_dedup, token_counts
from ledgerloom.llm.common import components, signed, word_hashes

from .conftest import prose


def corpus(seed, n=60):
    rng = random.Random(seed)
    rows = [(i, prose(rng, rng.randrange(1, 90))) for i in range(n)]
    passage = prose(rng, 45)
    for i in range(n, n + 25):
        words = rows[rng.randrange(n)][1].split()
        for _ in range(rng.randrange(0, 4)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(9)}"
        rows.append((i, " ".join(words) + (" " + passage if i % 4 == 0 else "")))
    rows += [(100, None), (101, ""), (102, " \t\n"), (103, "a b"), (104, "A  b"), (105, "a " * 300), (106, "a b c d " * 40), (107, prose(rng, 3000)), (108, rows[5][1])]
    return rows


def linked_components(rows, k, percent):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    label = {i: i for i in sets}
    changed = True
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in pairs:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return {(i, len(sets[i]), label[i]) for i in sets}


@pytest.mark.parametrize("k,percent,rows_in_block", [(4, 85, 4096), (5, 80, 3), (2, 60, 8)])
def test_jaccard_join_is_brute_force(make_docs, k, percent, rows_in_block):
    rows = corpus(k)
    out = shingle_join.jaccard_join(make_docs(rows), k=k, percent=percent, block_rows=rows_in_block, text_rows=rows_in_block)
    assert {tuple(r) for r in out.collect()} == linked_components(rows, k, percent)


def test_jaccard_join_odd_rows(make_docs):
    rows = [(3, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (None, None), (1, "A B c d e f"), (9, None)]
    out = shingle_join.jaccard_join(make_docs(rows), k=4, percent=85).collect()
    assert sorted(map(tuple, out), key=str) == sorted([(3, 3, 1), (3, 3, 1), (None, 3, 1), (None, 0, None), (1, 3, 1), (9, 0, 9)], key=str)
    assert shingle_join.jaccard_join(make_docs([])).count() == 0


def test_bound_never_below_overlap():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a, b = (np.unique(rng.integers(0, 300, rng.integers(1, 200)).astype(np.uint64)) for _ in range(2))
        bound = np.minimum(shingle_join.count_vector(a, 64), shingle_join.count_vector(b, 64)).sum()
        assert bound >= len(np.intersect1d(a, b))


def without_repeats(rows, window=20):
    seen, out = set(), {}
    for i, t in sorted(rows):
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            key = tuple(w[s : s + window])
            if key in seen:
                gone[s : s + window] = [True] * window
            seen.add(key)
        out[i] = (len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode())
    return out


@pytest.mark.parametrize("many", [4096, 1])
def test_substring_dedup_is_brute_force(make_docs, many):
    rows = corpus(11)
    out = substring_dedup.remove_repeats(make_docs(rows), many=many).collect()
    assert {r.doc_id: tuple(r[1:]) for r in out} == without_repeats(rows)


def test_substring_dedup_odd_rows(make_docs):
    long = " ".join(f"q{i}" for i in range(30))
    rows = [(7, long), (None, long), (8, long + " "), (8, None), (9, "Q0 " + long[3:])]
    got = sorted(map(tuple, substring_dedup.remove_repeats(make_docs(rows)).collect()), key=str)
    want = [(7, 30, 30, ""), (None, 30, 0, long), (8, 30, 30, ""), (8, 0, 0, ""), (9, 30, 29, "Q0")]
    assert got == sorted(want, key=str)
    assert substring_dedup.remove_repeats(make_docs([])).count() == 0


@pytest.mark.parametrize("many", [4096, 1])
def test_rows_equal_in_id_and_text_count_as_one(make_docs, many):
    rng = random.Random(12)
    rows = [(i, prose(rng, 60)) for i in range(4)]
    rows += [(4, rows[1][1]), (5, prose(rng, 30) + " " + " ".join(rows[2][1].split()[10:40])), (6, "a b c d " * 30), (-(1 << 62), prose(rng, 40))]
    want = without_repeats(rows)
    for parts in (1, 5):
        docs = make_docs(rows + rows[::-1] + rows[:3] + [(None, rows[0][1] + " z")] * 2).repartition(parts)
        out = [tuple(r) for r in substring_dedup.remove_repeats(docs, many=many).collect()]
        assert [r[1:] for r in out if r[0] is None] == [(61, 0, rows[0][1] + " z")] * 2
        named = [r for r in out if r[0] not in (None, 0)]
        assert sorted(named) == sorted((i, *want[i]) for i, _ in rows + rows + rows[:3] if i)
        assert [r[1:] for r in out if r[0] == 0] == [(60, 60, "")] * 3


def test_rows_without_id_are_gathered_by_text(make_docs, monkeypatch):
    rng = random.Random(13)
    passage = prose(rng, 25)
    rows = [(None, f"{prose(rng, 30)} a{i} {passage} b{i} {prose(rng, 30)}") for i in range(30)]
    lists = []
    kept = substring_dedup.cut
    monkeypatch.setattr(substring_dedup, "cut", lambda df: lists.append(kept(df)) or lists[-1])
    out = substring_dedup.remove_repeats(make_docs(rows)).collect()
    assert sum(r.n_removed for r in out) == 29 * 25 and len(out) == 30
    anchors = [df for df in lists if "known" in df.columns][0]
    assert anchors.count() == 30 and anchors.agg(F.max(F.size("known"))).first()[0] < 30


def test_automaton_statistics():
    rng = random.Random(3)
    for _ in range(200):
        window, seen, want = rng.choice([2, 3, 4]), set(), []
        pieces = [[rng.choice("abc") for _ in range(rng.randrange(window, 25))] for _ in range(5)]
        for words in pieces:
            flags = []
            for j in range(len(words) - window + 1):
                key = tuple(words[j : j + window])
                flags.append(key in seen)
                seen.add(key)
            want.append(flags)
        assert substring_dedup.seen_windows(pieces, window) == want


def test_token_counts_are_the_library(make_docs):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(5)
    letters = [chr(i) for i in range(0x20, 0x180)] + list("'''sstdlmrevE ") * 6 + ["<|endoftext|>", "<|startoftext|>", "́", "İ", "Σ", "K", "　", "\x85", "\x1c", "\n", "中"]
    rows = [(i, "".join(rng.choice(letters) for _ in range(rng.randrange(0, 60)))) for i in range(400)]
    rows += [(500, None), (501, ""), (502, "word " * 3000), (503, "x" * 50_000)]
    out = {r.doc_id: r for r in token_counts.count_tokens(make_docs(rows).withColumn("n_tokens", F.lit("old"))).collect()}
    for i, text in rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        assert (out[i].n_bytes, out[i].n_tokens, out[i].over_limit) == (len((text or "").encode()), n, n > 2048)
    assert token_counts.count_tokens(make_docs([])).count() == 0


def test_whole_tokens_are_proven():
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    whole = token_counts.whole_tokens(library)
    assert len(whole) > 10_000 and all(len(library.model.tokenize(w)) == 1 for w in list(whole)[:500])


BENCH = [
    (1, "Alice has 3 apples and buys 14 more apples at the market in Paris today"),
    (2, "the quick river runs under seven old stone bridges before it meets the sea"), (3, None), (4, ""), (5, "two of two"),
]


def test_templates_catch_changed_slots(spark, make_docs):
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    rows = [
        (1, "well: " + BENCH[0][1] + " and so on"), (2, "so Bob has 7 apples and buys 20 more apples at the market in Rome today"),
        (3, "Bob has 7 apples and buys 7 more oranges"), (4, "THE QUICK RIVER RUNS UNDER SEVEN OLD STONE BRIDGES"), (5, None), (6, ""), (7, "nothing here to be found at all, two of two"),
        (8, "Bob has 3 pears and buys 14 more pears at a market in Rome"), (1, "well: " + BENCH[0][1] + " and so on"),
    ]
    found = decontaminate.match_benchmark(make_docs(rows).withColumn("matches", F.lit(1)), bench)
    got = sorted((r.doc_id, m.item_id, m.start, m.n_words, m.changed) for r in found.collect() for m in r.matches)
    assert got == [(1, 1, 1, 15, 0), (1, 1, 1, 15, 0), (2, 1, 1, 15, 4), (4, 2, 0, 9, 0)]
    assert found.count() == len(rows)
    assert decontaminate.match_benchmark(make_docs([]), bench).count() == 0
    assert all(not r.matches for r in decontaminate.match_benchmark(make_docs(rows), bench.limit(0)).collect())


def test_inconsistent_slots_do_not_match(spark, make_docs):
    item = "take 5 of the red stones then put 5 of the blue stones into another basket"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(1, item.replace("5", "8")), (2, item.replace("5", "8", 1).replace("put 5", "put 9"))]
    got = {r.doc_id: [m.n_words for m in r.matches] for r in decontaminate.match_benchmark(make_docs(rows), bench).collect()}
    assert got[1] == [16] and max(got[2]) < 16


def test_items_of_few_literals_match_as_a_whole(spark, make_docs):
    items = [
        (1, "What is 17 times 24?"), (2, "What is the capital of France?"), (3, "Compute 12 + 34 + 5 + 61 + 7 + 80 + 9 + 44 + 3"), (4, "Name three primes"),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(i, f"so: {t} indeed") for i, t in items]
    rows += [(11, "so: What is 6 times 95? yes"), (12, "and What is the capital of Spain? yes"), (13, "Compute 2 + 4 + 50 + 1 + 70 + 8 + 99 + 14 + 31"), (14, "Name seven primes")]
    rows += [(21, "What is 6 plus 95?"), (23, "Compute 2 + 4 + 4 + 1 + 70 + 8 + 99 + 14 + 31"), (24, "3 + 3 + 3 + 3 + 3 + 3 + 3 + 3")]
    got = {r.doc_id: [(m.item_id, m.n_words) for m in r.matches] for r in decontaminate.match_benchmark(make_docs(rows), bench).collect()}
    assert got == {1: [(1, 5)], 2: [(2, 6)], 3: [(3, 18)], 4: [(4, 3)], 11: [(1, 5)], 12: [(2, 6)], 13: [(3, 18)], 14: [], 21: [], 23: [], 24: []}


def test_slots_inside_words_and_names_of_several_words(spark, make_docs):
    items = [
        (1, "put 5kg of sand near 7kg of lime then add 9kg of clay on the 3rd day at 12am sharp"),
        (2, "John Smith pays for twenty-one loaves while John Smith sells NASA some pies that McDonald made with Anna Maria Berg today"),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [
        (1, "put 50kg of sand near 8kg of lime then add 2lb of clay on the 3rd day".replace("2lb", "2 kg") + " at 11pm sharp"),
        (2, "so: Ann pays for seven loaves while Ann sells O'Brien some pies that ESA made with Bo today"),
        (3, "put a 5kgx of sand near the lime"),
    ]
    got = {r.doc_id: [(m.item_id, m.start, m.n_words) for m in r.matches] for r in decontaminate.match_benchmark(make_docs(rows), bench).collect()}
    assert got == {1: [(1, 0, 21)], 2: [(2, 1, 17)], 3: []}


def test_decontamination_in_shards(spark, make_docs, monkeypatch):
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    rows = [(1, BENCH[0][1]), (2, BENCH[1][1]), (3, "clean")]
    whole = {r.doc_id: sorted(r.matches) for r in decontaminate.match_benchmark(make_docs(rows), bench).collect()}
    monkeypatch.setattr(decontaminate, "SHARD_WINDOWS", 20)
    assert {r.doc_id: sorted(r.matches) for r in decontaminate.match_benchmark(make_docs(rows), bench).collect()} == whole


def test_pseudo_likelihood_is_a_sum_over_words(make_docs):
    rng = random.Random(2)
    rows = [(i, " ".join(f"w{min(rng.randrange(30), rng.randrange(30))}" for _ in range(rng.randrange(1, 60)))) for i in range(80)]
    rows += [(100 + i, " ".join(f"x{k}" for k in range(i * 50, i * 50 + 80))) for i in range(60)]  # more words than outputs
    rows += [(90, None), (91, ""), (92, rows[0][1]), (None, rows[0][1])]
    docs = make_docs(rows)
    out = {r.doc_id: r for r in pseudo_likelihood.score_pseudo_likelihood(docs.withColumn("score", F.lit(1))).collect()}
    words = pseudo_likelihood.vocabulary(docs, "text")
    network = pseudo_likelihood.train(docs, "text", "doc_id", words)
    counts = {signed(np.array([w], dtype=np.uint64))[0]: n for w, n in zip(*np.unique(word_hashes([t for _, t in rows], lower=True)[0], return_counts=True))}
    classed = 0
    for i, text in rows[:20] + rows[80:90]:
        hashes, offsets = word_hashes([text], lower=True)
        ids = words.ids(hashes)
        total = 0.0
        for at in range(len(ids)):
            hidden = np.zeros(pseudo_likelihood.WIDTH)
            for k, shift in enumerate([-3, -2, -1, 1, 2, 3]):
                there = at + shift
                hidden += network.inputs[k][ids[there] if 0 <= there < len(ids) else words.size]
            group, own = divmod(ids[at], pseudo_likelihood.GROUP)
            for weights, bias, k in ((network.gates, network.gate_bias, group), (network.outputs[group], network.bias[group], own)):
                logits = np.tanh(hidden) @ weights + bias
                total += logits[k] - np.log(np.exp(logits).sum())
            if ids[at] >= pseudo_likelihood.FREQUENT:
                classed += 1
                total += np.log(counts[signed(hashes[at : at + 1])[0]]) - words.log_class[ids[at] - pseudo_likelihood.FREQUENT]
        assert out[i].n_words == len(ids) and abs(out[i].score - total) < 1e-2
    assert classed
    assert (out[90].n_words, out[90].score, out[90].mean_score) == (0, 0.0, None)
    assert out[92].score == out[0].score == out[None].score
    met = np.array(sorted(counts.values()))
    entropy = -(met / met.sum() * np.log(met / met.sum())).sum()
    assert sum(r.score for r in out.values()) / sum(r.n_words for r in out.values()) > -1.1 * entropy
    assert pseudo_likelihood.score_pseudo_likelihood(make_docs([])).count() == 0


@pytest.mark.parametrize("known", [1 << 20, 40, 0])
def test_words_of_a_class_have_their_own_counts(make_docs, monkeypatch, known):
    monkeypatch.setattr(pseudo_likelihood, "KNOWN", known, raising=False)
    rng = random.Random(4)
    common = [f"c{i}" for i in range(pseudo_likelihood.FREQUENT)]
    rows = [(i, " ".join(common)) for i in range(60)]
    rows += [(i, " ".join(f"r{min(rng.randrange(900), rng.randrange(900))}" for _ in range(rng.randrange(1, 60)))) for i in range(60, 160)]
    rows += [(200, rows[70][1]), (None, rows[70][1]), (201, None), (202, "")]
    docs = make_docs(rows)
    out = {r.doc_id: r for r in pseudo_likelihood.score_pseudo_likelihood(docs).collect()}
    words = pseudo_likelihood.vocabulary(docs, "text")
    network = pseudo_likelihood.train(docs, "text", "doc_id", words)
    all_words = np.concatenate([word_hashes([t])[0] for _, t in rows])
    n = dict(zip(*(x.tolist() for x in np.unique(all_words, return_counts=True))))
    of_class = np.bincount(words.ids(all_words), minlength=words.size)
    for i, text in rows:
        hashes, offsets = word_hashes([text])
        ids = words.ids(hashes)
        total = network.log_probabilities(pseudo_likelihood.windows(ids, offsets, words.size), ids).sum() if len(ids) else 0
        total += sum(np.log(n[h] / of_class[k]) for h, k in zip(hashes.tolist(), ids.tolist()) if k >= pseudo_likelihood.FREQUENT)
        assert out[i].n_words == len(ids) and abs(out[i].score - total) < 1e-2
    assert len(out) == len(rows) and out[200].score == out[None].score == out[70].score


def test_all_documents_train(make_docs):
    docs = make_docs([(i, f"a r{i} r{i} b" if i < 300 else "a b") for i in range(6000)])
    words = pseudo_likelihood.vocabulary(docs, "text")
    network = pseudo_likelihood.train(docs, "text", "doc_id", words)
    own = words.ids(word_hashes([" ".join(f"r{i}" for i in range(300))])[0])
    moved = (network.inputs != pseudo_likelihood.Network.start(words).inputs).any(axis=2)
    assert (own < pseudo_likelihood.FREQUENT).all() and moved[2][own].all() and moved[3][own].all()


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 90), (90, 95), (7, 7), (None, 3), (200, 201), (201, 202), (200, 202)]
    out = {r.node: r.component for r in components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert out == {i: 1 for i in range(1, 41)} | {100: 90, 95: 90, 90: 90} | {200: 200, 201: 200, 202: 200}
    assert components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_word_hashes_of_long_texts():
    texts = ["a " * 700_000 + "x" * 2_000_000 + " b", " ", None, "q a", "x" * 2_000_000]
    hashes, offsets = word_hashes(texts)
    assert list(offsets) == [0, 700_002, 700_002, 700_002, 700_004, 700_005]
    assert hashes[0] == hashes[5] == hashes[-2] and hashes[700_000] == hashes[-1]


def test_array_reading_equals_word_reading():
    rng = random.Random(6)
    read = decontaminate.Canonical()
    vocab = (
        "x=3,y=4 5kg McDonald NASA. twenty-one \"Quoted\" (see ÉCOLE Straße ÎLE 3rd 12am a- --- 7-9 well-known - % 4,000 3/4 x+y f(2)=9 Ann O'Brien don't I A. "
        "Dr. Dr.) 1e5 minutes ten Zwölf, ß 日本 ... 'Tis"
    ).split()
    texts = ["".join(rng.choice(vocab) + rng.choice([" ", "\n", "  ", "\t"]) for _ in range(rng.randrange(0, 60))) for _ in range(200)]
    texts += ["", " \n", "--- ...", "Word " * 120_000, "y" * 600_000 + " Tail"]
    codes = decontaminate.Codes.read(texts)
    for form in decontaminate.FORMS:
        meant = {}
        for i, text in enumerate(texts):
            exact = decontaminate.Sequence(read(decontaminate.words(text)), form).hashes.tolist()
            arrays = codes.hashes[form][codes.text_of(form) == i].tolist()
            assert len(exact) == len(arrays)
            assert all(meant.setdefault(a, b) == b for a, b in zip(exact, arrays))
        assert len(set(meant.values())) == len(meant)
    assert [decontaminate.is_odd(t) for t in ("Straße É", "ΟΔΟΣ", "١٢", "İstanbul", "ǅ")] == [False, True, True, True, True]


def test_parts_of_words_and_lines_of_few_words(spark, make_docs):
    items = [(1, "x=3,y=4 find x+y now please"), (2, "Compute 5!"), (3, "no no no no no no no no no no no"), (4, "Why?")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [
        (1, "so x=5,y=9 find x+y now please ok"), (2, "first\nCompute 5!\nlast"), (3, "we Compute 5! here"), (4, "compute 6!"), (5, items[2][1]),
        (6, items[2][1] + " no"), (7, "why"), (8, "x=5,y=5 find x+y now please"), (9, "why not\n\n  WHY ?!\n" * 2),
    ]
    got = {r.doc_id: [(m.item_id, m.start, m.n_words) for m in r.matches] for r in decontaminate.match_benchmark(make_docs(rows), bench).collect()}
    assert got == {1: [(1, 1, 5)], 2: [(2, 1, 2)], 3: [], 4: [], 5: [(3, 0, 11)], 6: [(3, 0, 11), (3, 1, 11)], 7: [(4, 0, 1)], 8: [], 9: []}


def test_a_second_run_that_overlaps_keeps_its_head(spark, make_docs):
    item = "a 5 b c d e f g h 6 i j k l m n 5 o p q r s t u v"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    out = decontaminate.match_benchmark(make_docs([(1, item.replace("5", "8", 1))]), bench).first().matches
    assert [(m.start, m.n_words, m.changed) for m in out] == [(0, 16, 1), (2, 23, 0)]


def naive_matches(doc, item, window=8, literals=5):
    """Whether any window of strong words agrees, with its slots, in the plain or named form: every pair of places tried."""
    read = decontaminate.Canonical()
    for form in ("plain", "named"):
        d, b = (decontaminate.Sequence(read(decontaminate.words(t)), form) for t in (doc, item))
        for i in range(len(b) - window + 1):
            if len({int(h) for k, h in enumerate(b.hashes[i : i + window]) if not b.slot(i + k)}) < literals:
                continue
            for j in range(len(d) - window + 1):
                if (d.hashes[j : j + window] == b.hashes[i : i + window]).all():
                    there, back = {}, {}
                    pairs = [(b.slot(i + k), d.slot(j + k)) for k in range(window) if b.slot(i + k)]
                    if all(there.setdefault(y, x) == x and back.setdefault(x, y) == y for y, x in pairs):
                        return True
    return False


def test_documents_found_equal_the_naive_search(spark, make_docs):
    rng = random.Random(8)
    vocab = "Red stones 5 7 9 Ann Bo the of river runs under bridge kg metres seven and old sea 3kg".split()
    items = [(i, " ".join(rng.choice(vocab) for _ in range(14))) for i in range(25)]
    docs = []
    for i in range(120):
        own = [rng.choice(vocab) for _ in range(20)]
        if i % 2:
            head = rng.randrange(0, 5)
            part = items[i % 25][1].split()[head : head + 9]
            own[4:4] = [{"5": "9", "7": "5", "Ann": "Bo"}.get(w, w) if i % 3 else w for w in part]
        docs.append((i, " ".join(own)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, m.item_id) for r in decontaminate.match_benchmark(make_docs(docs), bench).collect() for m in r.matches}
    naive = {(d, b) for d, t in docs for b, x in items if naive_matches(t, x)}
    assert naive <= got
    few = {b for b, x in items if decontaminate.Index.build([(b, x)], 8, 5).tables.keys() & {(f, 8, w) for f in decontaminate.FORMS for w in (True,)} or ("raw", 8, False) in decontaminate.Index.build([(b, x)], 8, 5).tables}
    assert all(b in few for d, b in got - naive)  # what is found besides are items with windows of few literal words
