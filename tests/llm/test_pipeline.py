import random

import corpus_pipeline as P
from clickscope.llm.queries import language_model
from tests.conftest import SF_SMALL
from tests.llm.helpers import DOCS, prose, write_table
from tests.llm.test_decontam import slow as contaminated
from tests.llm.test_mixing import n_words, slow as mix
from tests.llm.test_simhash import expected as near


def _tables(spark, folder, rows, items):
    write_table(spark.createDataFrame(rows, DOCS + ", size string, shard string"), folder, "documents")
    write_table(spark.createDataFrame(items, "item_id long, text string"), folder, "benchmark")


def _corpus():
    rng = random.Random(11)
    items = [(i, prose(rng, 40)) for i in range(3)]
    rows = [(i, prose(rng, rng.choice([20, 80, 300])), "en", f"s{i % 4}" if i % 5 else "s0", 1, "x", "y") for i in range(60)]
    rows += [(60 + i, rows[i][1], "en", "s1", 1, "x", "y") for i in range(8)]  # copies
    rows += [(70 + i, f"{prose(rng, 150)} {items[i % 3][1]} {prose(rng, 90)}", "en", "s2", 1, "x", "y") for i in range(6)]
    rows += [(80, None, "en", "s1", None, "x", "y"), (81, "", None, None, 0, None, None), (82, "12 34 !!", "en", "s1", 8, "x", "y"),
             (3, rows[3][1], "en", "s3", 1, "x", "y"), (None, prose(rng, 70), None, None, None, None, None)]
    return rows, items


def test_stages_equal_brute_force(spark, tmp_dir):
    rows, items = _corpus()
    _tables(spark, tmp_dir, rows, items)
    docs, columns = spark.read.parquet(f"{tmp_dir}/documents.parquet"), None
    model = language_model(spark, tmp_dir)
    columns = docs.columns
    kept = {}
    for name, stage in P.STAGES:
        docs = stage(spark, docs, tmp_dir)
        if name != P.STAGES[-1][0]:
            assert docs.columns == columns
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        kept[name] = [r.asDict() for r in docs.collect()]
    ident = lambda rs: sorted(((r["doc_id"], r["text"]) for r in rs), key=repr)
    letters = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    want = [r for r in letters if model.predict([r[1].encode()])[1][0] >= model.threshold]
    assert len(want) >= len(letters) - 2
    first = kept["language_id"]
    assert ident(first) == sorted(((r[0], r[1]) for r in want), key=repr)
    classes, _ = near([(r["doc_id"], r["text"]) for r in first])
    second = kept["simhash_near_dedup"]
    assert sorted(r["doc_id"] for r in second if r["doc_id"] is not None) == sorted({c for _, _, c in classes if c is not None})
    assert len(second) == len({c for _, _, c in classes if c is not None}) + sum(c is None for _, _, c in classes)
    third = kept["benchmark_decontamination"]
    dirty = {r[0] for r in contaminated([(r["doc_id"], r["text"]) for r in second], items)}
    assert dirty == {70, 71, 72, 73, 74, 75}
    assert ident(third) == ident(r for r in second if r["doc_id"] not in dirty)
    taken = {}
    for r in kept["source_mixing"]:
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + n_words(r["text"])
    plan = mix([(r["doc_id"], r["source"], n_words(r["text"])) for r in third])
    assert taken == {d: t for d, _, _, _, t in plan if t}
    last = kept["sharding"]
    assert ident(last) == ident(kept["source_mixing"]) and {r["shard"] for r in last} <= set(range(16))


def test_run_gives_the_columns_of_documents_and_shards(spark):
    got = P.run(spark, SF_SMALL)
    assert {"doc_id", "text", "lang", "source", "n_chars", "shard", "slot"} <= set(got.columns)
    assert got.count() > 50


def test_empty_documents(spark, tmp_dir):
    write_table(spark.createDataFrame([], DOCS), tmp_dir, "documents")
    write_table(spark.createDataFrame([], "item_id long, text string"), tmp_dir, "benchmark")
    assert P.run(spark, tmp_dir).collect() == []
