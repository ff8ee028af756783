"""Each stage of the pipeline on its own input, against brute force or the rule it follows."""

import random
from collections import Counter

import pytest

import corpus_pipeline
from ledgerloom.llm import mixing

from .conftest import SCHEMA, prose
from .test_text_operators import linked_components

ITEM = "the quick river runs under seven old stone bridges before it meets the wide sea at last"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(8)
    rows = [(i, prose(rng, rng.randrange(30, 90)), "en", f"src{i % 4}", 0) for i in range(300)]
    rows += [(i, "!!## $$ || " * rng.randrange(10, 30) + str(i), "en", "src0", 0) for i in range(300, 420)]
    rows += [(i, rows[i % 7][1] + " more", "en", "src1", 0) for i in range(420, 450)]
    rows += [(450, prose(rng, 40) + " " + ITEM, "en", None, 0), (451, prose(rng, 60), None, None, None)]
    folder = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, int(i < 300 or i >= 420), 0) for i in range(452)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), rows


def ids(df):
    return sorted(r.doc_id for r in df.collect())


def test_stages(spark, corpus):
    folder, rows = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    good = corpus_pipeline.keep_quality(spark, docs, folder)
    assert good.columns == corpus_pipeline.COLUMNS
    assert ids(good) == [r[0] for r in rows if not 300 <= r[0] < 420]
    one = corpus_pipeline.keep_one_of_near_duplicates(spark, good, folder)
    want = sorted(i for i, _, low in linked_components([(r[0], r[1]) for r in rows if not 300 <= r[0] < 420], 5, 80) if i == low)
    assert ids(one) == want and 420 not in want
    clean = corpus_pipeline.drop_benchmark(spark, one, folder)
    assert ids(clean) == [i for i in want if i != 450]
    kept = {r.doc_id: r for r in clean.collect()}
    mixed = corpus_pipeline.mix(spark, clean, folder)
    taken = Counter(ids(mixed))
    assert mixed.columns == corpus_pipeline.COLUMNS and set(taken) <= set(kept) and max(taken.values()) <= 2
    sizes = Counter()
    for r in kept.values():
        sizes[r.source] += len(r.text.split())
    for source, target in mixing.targets(dict(sizes)).items():
        assert abs(sum(n * len(kept[i].text.split()) for i, n in taken.items() if kept[i].source == source) - target) < 90
    placed = corpus_pipeline.shard(spark, mixed, folder)
    assert Counter(ids(placed)) == taken
    assert placed.groupBy("shard", "slot").count().where("count > 1").count() == 0


def test_run_is_the_stages_in_order(spark, corpus):
    folder, _ = corpus
    out = corpus_pipeline.run(spark, folder)
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "quality classifier" and len(corpus_pipeline.STAGES) == 5
    assert {"doc_id", "text", "lang", "source", "n_chars", "shard", "slot"} <= set(out.columns)
    again = corpus_pipeline.run(spark, folder)
    key = lambda r: (r.doc_id, r.shard, r.slot)
    assert sorted(map(key, out.collect())) == sorted(map(key, again.collect()))


def test_odd_rows_and_empty_tables(spark, corpus):
    folder, _ = corpus
    same = "one two three four five six seven"
    odd = spark.createDataFrame([(1, same, None, None, None), (1, same, None, None, None), (None, same, "en", "a", 3), (None, None, None, None, None), (5, None, "en", "a", 0), (6, "", "en", "a", 0)], SCHEMA)
    assert sorted(str(r.doc_id) for r in corpus_pipeline.keep_one_of_near_duplicates(spark, odd, folder).collect()) == ["1", "5", "6", "None"]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd, folder).count() >= 0
        assert stage(spark, odd.limit(0), folder).count() == 0


def test_near_duplicates_with_shared_or_no_ids(spark, corpus):
    folder, _ = corpus
    rng = random.Random(21)
    a, b, c, d = (prose(rng, 40) for _ in range(4))
    rows = [(1, a), (1, b), (2, a + " more"), (3, b + " more"), (None, c), (None, c), (None, c + " more"), (4, d), (None, d), (1, a), (None, None), (None, None), (7, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA)
    kept = corpus_pipeline.keep_one_of_near_duplicates(spark, docs, folder).collect()
    got = sorted(((r.doc_id, r.text) for r in kept), key=str)
    without = [t for i, t in got if i is None and t is not None]
    assert len(without) == 1 and without[0] in (c, c + " more")
    assert [r for r in got if r[0] is not None or r[1] is None] == sorted([(1, a), (1, b), (4, d), (7, None), (None, None)], key=str)
