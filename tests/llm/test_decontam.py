import random

from clickscope.llm import decontam as D
from clickscope.llm.queries import op6_benchmark_containment
from tests.conftest import SF_SMALL
from tests.llm.helpers import empty_docs, odd_docs, prose

ITEMS = "item_id long, text string"


def slow_shingles(text, k=5):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or "")).encode().split()
    return {tuple(w[i: i + k]) for i in range(len(w) - k + 1)}


def slow(docs, items, threshold=0.8):
    out = []
    sets = [(i, slow_shingles(t)) for i, t in dict.fromkeys(items)]
    for d, t in docs:
        there = slow_shingles(t)
        for i, s in sets:
            if s and len(s & there) >= threshold * len(s):
                out.append((d, i, len(s), len(s & there)))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r["doc_id"], r["item_id"], r["n_shingles"], r["n_shared"]) for r in df.collect()), key=repr)


def test_query_equals_brute_force(spark):
    docs = [(r[0], r[1]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    items = [(r[0], r[1]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    got = found(op6_benchmark_containment(spark, SF_SMALL))
    assert got and got == slow(docs, items)


def _planted(rng):
    items = [(i, prose(rng, n)) for i, n in enumerate((5, 6, 12, 20, 21, 40, 70, 150, 600))]
    items += [(3, items[3][1]), (3, prose(rng, 15)), (90, "too short"), (91, None), (92, ""), (None, prose(rng, 30))]
    docs = []
    for d in range(60):
        w = prose(rng, rng.choice([0, 10, 100, 3000])).split()
        item = (rng.choice(items)[1] or "").split()
        how = d % 4
        if how == 1:  # whole
            at = rng.randrange(len(w) + 1)
            w[at:at] = item
        elif how == 2:  # some words changed
            item = [x if rng.random() > 0.03 else "zz" for x in item]
            at = rng.randrange(len(w) + 1)
            w[at:at] = item
        elif how == 3 and len(item) > 30:  # in two places
            half = len(item) // 2
            w = item[half - 4:] + w + item[: half + 4]
        docs.append((d, " ".join(w).title() if d % 3 else "\n".join(w)))
    return docs, items


def test_planted_items_in_long_documents(spark):
    for seed in range(3):
        docs, items = _planted(random.Random(seed))
        frame = spark.createDataFrame(docs, "doc_id long, text string")
        bench = spark.createDataFrame(items, ITEMS)
        want = slow(docs, items)
        assert len(want) > 15
        assert found(D.contaminated_pairs(frame, bench)) == want
        assert found(D.contaminated_pairs(frame, bench, items_at_once=4)) == want
        clean = D.decontaminate(frame, bench)
        assert sorted(r["doc_id"] for r in clean.collect()) == sorted({d for d, _ in docs} - {r[0] for r in want})


def test_one_block_of_items_is_held_at_a_time(spark, monkeypatch):
    """Twelve blocks: a broadcast is destroyed before the next one is made, and only the last is left in the plan."""
    rng = random.Random(21)
    items = [(i, prose(rng, 12)) for i in range(24)]
    docs = [(i, f"{prose(rng, 30)} {t} {prose(rng, 9)}") for i, t in items] + [(100 + i, prose(rng, 40)) for i in range(5)]
    frame, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEMS)
    live, most = set(), []
    real = D.broadcast_value

    def counted(spark, value):
        sent, value_of = real(spark, value)
        live.add(id(sent))
        most.append(len(live))

        class Sent:
            def destroy(self):
                live.remove(id(sent))
                sent.destroy()
        return Sent(), value_of
    monkeypatch.setattr(D, "broadcast_value", counted)
    for work in (lambda: found(D.contaminated_pairs(frame, bench, items_at_once=2)) == slow(docs, items),
                 lambda: sorted(r["doc_id"] for r in D.decontaminate(frame, bench, items_at_once=2).collect()) == list(range(100, 105)),
                 lambda: [len(r["hits"]) for r in D.contained_items(frame, bench, "hits", items_at_once=2).orderBy("doc_id").collect()] == [1] * 24 + [0] * 5):
        live.clear()
        most.clear()
        assert work()
        assert most == [1] * 12


def test_candidates_are_few_and_complete():
    rng = random.Random(8)
    docs, items = _planted(rng)
    index = D.build_index([(i, t and t.encode()) for i, t in items])
    near = D.candidates(index, [t.encode() for _, t in docs])
    for (d, t), c in zip(docs, near, strict=True):
        hit = {n for n in range(len(index.ids)) if len(index.sets[n] & D.shingles(t.encode())) >= 0.8 * len(index.sets[n])}
        assert hit <= c
    assert sum(map(len, near)) < len(docs) * len(items) / 4


def test_odd_rows(spark):
    docs, rows = odd_docs(spark, extra=("matches", "item_id"))
    items = [(1, rows[2][1]), (2, rows[5][1]), (None, rows[3][1]), (4, None)]
    bench = spark.createDataFrame([(*i, "x") for i in items], ITEMS + ", doc_id string")
    assert found(D.contaminated_pairs(docs, bench)) == slow([(r[0], r[1]) for r in rows], items)
    kept = D.decontaminate(docs, bench)
    assert kept.columns == docs.columns


def test_empty_tables(spark):
    none = spark.createDataFrame([], ITEMS)
    docs, rows = odd_docs(spark)
    assert D.decontaminate(docs, none).count() == len(rows)
    assert D.contaminated_pairs(docs, none).count() == 0
    assert D.contaminated_pairs(empty_docs(spark), spark.createDataFrame([(1, prose(random.Random(1), 9))], ITEMS)).count() == 0


def test_values_follow_from_the_chance_of_a_miss():
    assert D.minhash_values(0.8, 1e-6) == 49  # a similarity of a quarter at least
    assert D.minhash_values(0.5, 1e-6) > 49


def test_no_short_item_is_missed():
    rng = random.Random(12)
    items = [(i, prose(rng, 5 + i % 8).encode()) for i in range(400)]
    index = D.build_index(items)
    for i, t in items:
        w = prose(rng, 400).encode().split()
        at = rng.randrange(len(w))
        got = D.matches(index, [b" ".join([*w[:at], t.upper(), *w[at:]])])[0]
        assert i in [m["item_id"] for m in got]


def test_short_items_equal_brute_force():
    rng = random.Random(13)
    vocabulary = prose(rng, 4).split()  # so that items share shingles
    items = list(dict.fromkeys((i, " ".join(rng.choices(vocabulary, k=rng.randint(5, 13)))) for i in range(150)))
    docs = [(d, " ".join(rng.choices(vocabulary, k=rng.choice([0, 4, 60, 400])))) for d in range(40)]
    index = D.build_index([(i, t.encode()) for i, t in items])
    got = [(d, m["item_id"], m["n_shingles"], m["n_shared"]) for (d, _), found in
           zip(docs, D.matches(index, [t.encode() for _, t in docs]), strict=True) for m in found]
    short = {i for i, t in items if len(slow_shingles(t)) <= D.SHORT}
    want = [x for x in slow(docs, items) if x[1] in short]
    assert want and sorted((x for x in got if x[1] in short), key=repr) == want
