import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lamina.llm import tokens

PIECES = ["a", "Word", "'s", "'ll", " ", "  ", "\n", "\t", "1", "23", ".", "!", "é", "ß", "　", "\xa0", "\x1c", "日本", "🙂", "<|endoftext|>", "²", "\x85", "-", "_"]


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokens.tokenizer_path())
    return t


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=12).map("".join))
def test_pieces_are_encoded_as_the_whole_text(text):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokens.tokenizer_path()) if not hasattr(test_pieces_are_encoded_as_the_whole_text, "t") else test_pieces_are_encoded_as_the_whole_text.t
    test_pieces_are_encoded_as_the_whole_text.t = t
    assert np.frombuffer(tokens.encoder(tokens.tokenizer_path()).encode(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=50))
def test_coding_round_trip(values):
    control, data = tokens.pack(np.array(values, np.uint32))
    assert len(control) == -(-len(values) // 4)
    assert tokens.unpack(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), len(values)).tolist() == values
    doc_ids, lengths, found = tokens.read_block(tokens.block(np.array([7]), np.array([len(values)]), np.array(values, np.uint32)))
    assert (doc_ids.tolist(), lengths.tolist(), found.tolist()) == ([7], [len(values)], values)


def test_added_tokens_are_those_of_the_library(whole):
    text = "one <|endoftext|> two"
    assert np.frombuffer(tokens.encoder(tokens.tokenizer_path()).encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids
    assert 50256 in whole.encode(text, add_special_tokens=False).ids


def test_a_small_table_forgets_but_stays_right(whole, monkeypatch):
    monkeypatch.setattr(tokens, "CACHED", 3)
    text = "The quick brown fox, the slow dog. The quick brown fox!"
    assert np.frombuffer(tokens.Encoder(tokens.tokenizer_path()).encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_round_trip_through_files(docs_of, odd_rows, whole):
    docs = docs_of(odd_rows).withColumns({"part": F.lit(1), "ids": F.lit(2), "tie": F.lit(3)})
    blocks, ranks = tokens.write_tokens(docs, tokens.tokenizer_path(), 2)
    found = tokens.read_tokens(blocks, ranks).orderBy("start").collect()
    want = sorted((2**63 - 1 if i is None else i, [*whole.encode(t or "", add_special_tokens=False).ids, 2]) for i, t, *_ in odd_rows)
    assert [r["doc_id"] for r in found] == [i for i, _ in want]
    assert sorted((r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in found) == want
    assert [r["start"] for r in found] == np.cumsum([0, *(r["n_tokens"] for r in found)]).tolist()[:-1]
    counts = np.bincount([x for _, ids in want for x in ids])
    order = [r["id"] for r in ranks.orderBy("rank").collect()]
    assert [int(counts[i]) for i in order] == sorted((int(c) for c in counts if c), reverse=True)


def test_digest(docs_of, whole):
    ids = [*whole.encode("hello big world", add_special_tokens=False).ids, 2]
    rows = tokens.digest(docs_of([(3, "hello big world"), (1, None)])).orderBy("start").collect()
    assert [tuple(r) for r in rows] == [(1, 0, 1, zlib.crc32(np.array([2], "<u4").tobytes())), (3, 1, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))]


def test_empty_table(docs_of):
    assert tokens.digest(docs_of([(1, "a")]).limit(0)).count() == 0


def test_order_of_files(spark, tmp_path, docs_of):
    docs_of([(5, "b"), (1, "c"), (9, "a")]).coalesce(1).write.parquet(str(tmp_path / "d"))
    found = tokens.digest(spark.read.parquet(str(tmp_path / "d")), in_file_order=True).orderBy("start").collect()
    assert [r["doc_id"] for r in found] == [5, 1, 9]


def test_signs_and_words_of_new_lines_are_encoded_once(whole, monkeypatch):
    code, seen = tokens.Encoder(tokens.tokenizer_path()), []
    named = code.model.tokenize

    class Model:
        def tokenize(self, letters):
            seen.append(letters)
            return named(letters)

    code.model = Model()
    text = "so one, two, three, été, deux. trois.\none four.\none, été\n\ntwo *** a,, b,, c&&&\none"
    assert np.frombuffer(code.encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids
    assert len(seen) == len(set(seen)) and len(seen) > 10


def test_ids_before_ranking_are_deleted(spark, docs_of):
    from pathlib import Path

    from lamina.session import work_dir

    blocks, ranks = tokens.write_tokens(docs_of([(1, "one two"), (2, "one")]), tokens.tokenizer_path(), 2, "gone")
    left = {p.name.rsplit("-", 1)[0] for p in (Path(work_dir(spark).removeprefix("file://")) / "lamina").glob("llm-gone-*")}
    assert left == {"llm-gone-blocks", "llm-gone-ranks"} and blocks.count() == 1 and ranks.count() > 1
