import random

from clickscope.llm.queries import op3_quotation_links
from clickscope.llm.quotes import _placed, link_quotations, parse, quote_level
from tests.conftest import SF_SMALL

TURNS = "conv_id long, turn long, role string, text string"


def rows(df):
    return {(r["conv_id"], r["turn"]): r for r in df.collect()}


def test_levels():
    assert quote_level("> > deep") == (2, "deep")
    assert quote_level(">>> x > y") == (3, "x > y")
    assert quote_level("a > b") == (0, "a > b")
    assert quote_level(" >") == (1, "")


def test_parse():
    own, quoted = parse("Hi\nOn Monday, A wrote:\n> one\n>> two\n> three\n\nYes\n> four\nNo\n")
    assert own == "Hi\n\nYes\nNo" and quoted == [(1, "one"), (2, "two"), (1, "three"), (1, "four")]
    assert parse(None) == parse("") == ("", [])
    assert parse("no quotes\nat all") == ("no quotes\nat all", [])


THREAD = [(1, 0, "a", "The plan is ready.\nShall we start on Monday?"), (1, 1, "b", "I like tea."),
          (1, 2, "c", "> shall we  START on monday?\nYes, Monday."), (1, 3, "a", ">> Shall we start on Monday?\n> Yes, Monday.\nGood."),
          (1, 4, "b", "> I like tea.\nSo do I."), (1, 5, "c", "> nobody said this\nHm."), (2, 0, "a", "> Yes, Monday.\nother talk"),
          (1, 6, "b", "> Good.\n> Yes, Monday.\nFine.")]


def test_links_threads_and_order(spark):
    got = rows(link_quotations(spark.createDataFrame(THREAD, TURNS)))
    assert {k: r["reply_to"] for k, r in got.items()} == {(1, 0): None, (1, 1): None, (1, 2): 0, (1, 3): 2, (1, 4): 1, (1, 5): None,
                                                          (2, 0): None, (1, 6): 2}
    assert {k[1]: (r["thread"], r["depth"]) for k, r in got.items() if k[0] == 1} == {
        0: (0, 0), 1: (1, 0), 2: (0, 1), 3: (0, 2), 4: (1, 1), 5: (5, 0), 6: (0, 2)}
    order = sorted((r["position"], k[1]) for k, r in got.items() if k[0] == 1)
    assert order == [(0, 0), (1, 2), (2, 3), (3, 6), (4, 1), (5, 4), (6, 5)]
    assert got[(1, 3)]["text"] == "Good." and got[(1, 3)]["chat"] == "<|a|>\nGood.\n"
    assert not any(line.startswith(">") for r in got.values() for line in r["text"].split("\n"))


def test_long_chain(spark):
    chain = [(1, i, "u", f"> message {i - 1}\nmessage {i}" if i else "message 0") for i in range(70)]
    got = rows(link_quotations(spark.createDataFrame(chain, TURNS)))
    assert all(r["depth"] == t and r["thread"] == 0 and r["position"] == t for (_, t), r in got.items())


def test_places_across_buckets(spark):
    """Long threads among short ones: a turn's place counts what comes before it by (top, turn)."""
    rng = random.Random(5)
    turns = {(c, t): (0 if t % 3 == 0 else 700 if t > 700 and t % 3 == 1 else t) for c in ("", "c1") for t in rng.sample(range(-20, 3000), 1500)}
    turns |= {("c2", -(1 << 63)): -(1 << 63), ("c2", 5): 5}
    df = spark.createDataFrame([(c, t, top) for (c, t), top in turns.items()], "__conv string, __turn long, __top long")
    got = {(r["__conv"], r["__turn"]): r["position"] for r in _placed(df).collect()}
    want = {}
    for c in ("", "c1", "c2"):
        own = sorted((top, t) for (d, t), top in turns.items() if d == c)
        want |= {(c, t): i for i, (_, t) in enumerate(own)}
    assert got == want


def test_a_passage_that_many_repeat_links_to_the_first(spark):
    many = [(1, i, "u", "same words") for i in range(300)] + [(1, 300 + i, "v", f"> same words\nanswer {i}") for i in range(300)]
    got = rows(link_quotations(spark.createDataFrame(many, TURNS)))
    assert {r["reply_to"] for (_, t), r in got.items() if t >= 300} == {0}


def test_odd_rows(spark):
    odd = [(None, 0, "a", "x"), (None, 1, None, "> x\ny"), (1, None, "a", "z"), (1, 1, "b", "> z\nw"), (1, 1, "b", "> z\nw"), (1, 1, "b", None),
           (1, 2, "c", ""), (3, 0, "a", ">"), (4, 7, "a", "> q"), (4, 7, "a", "q"), (5, 0, "a", "w " * 200_000)]
    df = spark.createDataFrame([(*r, 1, "e") for r in odd], TURNS + ", position long, depth string")
    got = link_quotations(df).collect()
    assert len(got) == len(odd)
    by = [(r["conv_id"], r["turn"], r["text"], r["depth"], r["thread"], r["position"]) for r in got]
    assert by.count((1, 1, "w", 1, None, 1)) == 2 and (1, 1, "", 1, None, 1) in by
    assert (None, 1, "y", 1, 0, 1) in by and (4, 7, "", 0, 7, 0) in by
    assert link_quotations(df.where("false")).collect() == []


def test_query_covers_every_message(spark):
    want = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").collect()
    got = op3_quotation_links(spark, SF_SMALL).collect()
    assert sorted((r["conv_id"], r["turn"], r["text"].strip("\n")) for r in want) == sorted((r["conv_id"], r["turn"], r["text"]) for r in got)


def test_deeper_levels_link_where_shallower_ones_do_not(spark):
    thread = [(1, 0, "a", "The plan is ready."), (1, 1, "b", "Other talk."), (1, 2, "c", ">> The plan is ready.\nFine."),
              (1, 3, "d", "> an edited passage\n>> Other talk.\nYes."), (1, 4, "e", ">>> The plan is ready.\n>> Fine.\nGood."),
              (1, 5, "f", "> Fine.\n>> The plan is ready.\nWell.")]
    got = rows(link_quotations(spark.createDataFrame(thread, TURNS)))
    assert {t: r["reply_to"] for (_, t), r in got.items()} == {0: None, 1: None, 2: 0, 3: 1, 4: 2, 5: 2}
