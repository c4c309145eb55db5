import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clickscope.llm import bpe as B
from clickscope.llm.queries import op13_forced_boundary_bpe
from tests.conftest import SF_SMALL
from tests.llm.helpers import empty_docs, odd_docs

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
ENCODER = B.Encoder(open(PATH, encoding="utf-8").read())
# marks that normalisation composes, letters that change their length in lower case, white space of all kinds, added tokens
ODD = ["a", "B", "ß", "İ", "́", "Σ", "ς", " ", "\n", "\x1c", "\x85", "\xa0", "　", "'s", "'LL", "'", "<|endoftext|>", "<|startoftext|",
       "9", "٣", "한", "각", "ﬁ", "😀", "Å", "!", "</w>", "_", "e", "‍", "ͅ", "\x00", "Ǆ", "Ⅷ", "\U0010fffd"]


def packed(ids):
    return np.array(ids, dtype="<u4").tobytes()


def library(text):
    ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
    return packed(ids), LIBRARY.decode(ids, skip_special_tokens=False)


def digest(data):
    return hashlib.sha256(data).hexdigest()


def expected(doc_id, text):
    ids, decoded = library(text)
    return doc_id, len(ids) // 4, digest(ids), digest(decoded.encode())


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()), key=repr)


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=40), st.lists(st.sampled_from(ODD), max_size=14).map("".join)))
def test_texts_are_encoded_and_decoded_as_by_the_library(text):
    ids, decoded = library(text)
    assert ENCODER.encode(text.encode()) == ids
    assert ENCODER.decode(ids) == decoded


def cuts(word):
    ids, begins = ENCODER.fragments([word])
    return np.flatnonzero(begins).tolist()


def test_no_token_spans_a_forced_boundary_and_words_are_cut_there():
    assert ENCODER.inside[ord("t"), ord("h")] and not ENCODER.inside[ord("q"), ord("z")]
    assert not any("qz" in t for t in ENCODER.tokens.values())
    assert cuts(b"the") == [0]
    assert 7 in cuts(b"helloqqzqhello") and len(cuts(b"zqzqzqhello")) > 1


def test_both_ways_of_merging_agree():
    rng = random.Random(3)
    words = ["".join(rng.choice("aehinrst") for _ in range(rng.randint(1, 60))).encode() for _ in range(300)] + [b"a" * n for n in range(1, 40)]
    together = ENCODER.merged(*ENCODER.fragments(words), long=1000)
    by_queue = ENCODER.merged(*ENCODER.fragments(words), long=0)
    assert all((x == y).all() for x, y in zip(together, by_queue, strict=True))


def test_long_words_and_a_full_memo(monkeypatch):
    monkeypatch.setattr(B, "_MEMO", 5)
    monkeypatch.setattr(B, "_SLICE", 30)
    enc = B.Encoder(open(PATH, encoding="utf-8").read())
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choice("abcdé.ö́") for _ in range(rng.choice((2, 9, 200)))) for _ in range(n)) for n in (0, 1, 29, 30, 31, 400, 2, 3)]
    texts += ["a" * 30_000 + "zq" * 5_000 + " end", "", "x<|endoftext|>" * 50, "one"]
    want = [library(t)[0] for t in texts]
    assert enc.encode_all([t.encode() for t in texts]) == want == [enc.encode(t.encode()) for t in texts]
    assert max(map(len, [*enc._chunks, *enc._words])) <= B._MEMO_BYTES


def test_query_equals_the_library(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    assert found(op13_forced_boundary_bpe(spark, SF_SMALL)) == sorted((expected(r["doc_id"], r["text"]) for r in docs), key=repr)


def test_odd_rows_extra_columns_and_empty_table(spark, tmp_dir):
    df, rows = odd_docs(spark, extra=("ids", "decoded", "n_tokens"))
    df.write.parquet(f"{tmp_dir}/documents.parquet")
    assert found(op13_forced_boundary_bpe(spark, tmp_dir)) == sorted((expected(r[0], r[1]) for r in rows), key=repr)
    empty_docs(spark).write.parquet(f"{tmp_dir}/none/documents.parquet")
    assert found(op13_forced_boundary_bpe(spark, f"{tmp_dir}/none")) == []


def test_ids_and_texts_come_from_the_operator(spark):
    encoder_of = B.encoder(spark, PATH)
    df = spark.createDataFrame([("Hello wörld <|endoftext|>",), (None,)], "text string")
    got = (df.select(B.encode(F.col("text"), encoder_of).alias("ids")).withColumn("n", B.id_count(F.col("ids")))
           .withColumn("back", B.decode(F.col("ids"), encoder_of)).collect())
    ids, decoded = library("Hello wörld <|endoftext|>")
    assert [(bytes(r.ids), r.n, r.back) for r in got] == [(ids, len(ids) // 4, decoded), (b"", 0, "")]
    assert spark.range(1).select(B.decode(F.lit(None).cast("binary"), encoder_of)).first()[0] == ""


@pytest.mark.parametrize("change", [{"decoder": {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": True}},
                                    {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}},
                                    {"model": {"type": "BPE", "vocab": {"a": 0}, "merges": []}}])
def test_other_tokenizer_files_are_refused(change):
    with pytest.raises(ValueError):
        B.Encoder(json.dumps(json.load(open(PATH, encoding="utf-8")) | change))
