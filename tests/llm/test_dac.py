import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from strata.llm import dac
from strata.llm.queries import new_folder, tokenizer_path
from tests.llm.helpers import awkward, docs_of, empty


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2 ** 32 - 1), max_size=2000))
def test_codes_round_trip_and_random_access(ids):
    x = np.array(ids, np.uint32)
    levels = dac.encode(x)
    assert (dac.decode(levels) == x).all()
    at = np.arange(len(x))[::-3]
    assert (dac.take(levels, at) == x[at]).all()


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="abST.,'1 \n\t 　éßøªʼƀ—\x1c😀日", max_size=30), max_size=8))
def test_pieces_give_the_tokenizers_ids(texts):
    enc = dac.encoder(tokenizer_path())
    flat, n = enc.encode(pa.array(texts, pa.large_string()))
    want = [e.ids for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert flat.tolist() == sum(want, []) and n.tolist() == [len(w) for w in want]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["<|endoftext|>", "<|endof", "text|>", "<|", "a", "B", " ", "\n", ",", "é", "日"]),
                         max_size=12).map("".join), max_size=6))
def test_added_tokens_give_the_ids_of_the_file_as_given(texts):
    flat, n = dac.encoder(tokenizer_path()).encode(pa.array(texts, pa.large_string()))
    want = [e.ids for e in Tokenizer.from_file(tokenizer_path()).encode_batch(texts, add_special_tokens=False)]
    assert flat.tolist() == sum(want, []) and n.tolist() == [len(w) for w in want]


def test_added_tokens_in_files(spark):
    texts = ["a <|endoftext|> b", "<|endof", "text|> c", "<|endoftext|><|endoftext|>", None]
    path = new_folder(spark, "tokens")
    dac.write(docs_of(spark, texts), path, tokenizer_path())
    got = {r["doc_id"]: r["ids"] for r in dac.read(spark, path).collect()}
    tok = Tokenizer.from_file(tokenizer_path())
    assert got == {i: [*tok.encode(t or "", add_special_tokens=False).ids, dac.END_ID] for i, t in enumerate(texts)}
    assert got[0] == [64, 220, 50256, 275, 0]


def test_memory_of_pieces_is_bounded():
    enc = dac.PieceEncoder(tokenizer_path(), keep=10)
    for k in range(4):
        enc.encode(pa.array([" ".join(f"w{i}x{k}" for i in range(8))]))
        assert len(enc.known) <= 10


def test_files_of_awkward_rows(spark):
    df = awkward(spark)
    path = new_folder(spark, "tokens")
    dac.write(df, path, tokenizer_path(), block_ids=1000)
    got = sorted((r.asDict() for r in dac.read(spark, path).collect()), key=lambda r: r["start"])
    tok = dac.encoder(tokenizer_path()).tokenizer
    want = sorted(tuple(tok.encode(r["text"] or "", add_special_tokens=False).ids) + (0,)
                  for r in df.collect())
    assert sorted(tuple(r["ids"]) for r in got) == want
    ids = [r["doc_id"] for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    stream = [t for r in got for t in r["ids"]]
    assert [r["start"] for r in got] == np.cumsum([0] + [r["n_tokens"] for r in got])[:-1].tolist()
    for r in dac.digest(spark, path).collect():
        part = stream[r["start"]:r["start"] + r["n_tokens"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
    some = [0, 7, len(stream) - 1, len(stream) // 2]
    assert {r["position"]: r["id"] for r in dac.lookup(spark, path, some).collect()} \
        == {p: stream[p] for p in some}


def test_empty_table_writes_no_block(spark):
    path = new_folder(spark, "tokens")
    dac.write(empty(spark), path, tokenizer_path())
    assert dac.digest(spark, path).count() == 0


def test_numpy_ids_need_no_sign():
    assert dac.decode(dac.encode(np.array([2 ** 31, 5], np.uint32))).tolist() == [2 ** 31, 5]
    assert pytest.approx(0) == len(dac.decode(dac.encode(np.array([], np.uint32))))
