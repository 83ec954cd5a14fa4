"""BPE round trip and packing against the tokenizers library."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from siftwork.llm import bpe, packing, queries

from .helpers import awkward, documents

ODD = awkward() + [
    "  two  spaces ", "a\n\n b\t\tc ", "don't we'll 'S x's!! x'.y", "<|endoftext|>hi<|endoftext|> ", "\x1c a \x1cb\x85c",
    "é" * 500, "ab" * 3000, "x" * 97 + "y1" * 300, "ΑΣ ΣΑΣ", "á ́b", "<|startoftext|>x", "İstanbul", "foo.’bar…«x».y!'s", "12a3 a_b",
]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tokens"))
    documents(spark, ODD).write.parquet(f"{folder}/documents.parquet")
    return folder


def test_round_trip_is_the_library(spark, tables):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = {r["doc_id"]: r for r in queries.QUERIES["op2_bpe_round_trip"](spark, tables).collect()}
    assert len(rows) == len(ODD)
    for i, text in enumerate(ODD):
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        assert rows[i]["n_tokens"] == len(ids)
        assert rows[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert rows[i]["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest()


def test_long_words_merge_like_short_ones():
    data = open(public_tokenizers.path("byte_bpe_50k.json"), "rb").read()
    codec = bpe.Codec(data)
    for word in (b"the", b"internationalisation", b"aaaaaaaaaaaaaaaaaaaaaaab", bytes(range(65, 91)) * 3):
        assert np.frombuffer(codec.merge_short([word])[0], "<i4").tolist() == codec.merge_long(word)


def test_packing_places_every_piece_once(spark, tables):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = queries.QUERIES["op8_best_fit_packing"](spark, tables).toPandas()
    expected = {}
    for i, text in enumerate(ODD):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        for k, at in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[at : at + 4096], "<u4")
            expected[i, k] = (at, len(part), zlib.crc32(part.tobytes()))
    found = {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows.itertuples()}
    assert found == expected
    for _, group in rows.sort_values("offset").groupby("sequence_id"):
        assert group.offset.tolist() == np.r_[0, group.length.cumsum()[:-1]].tolist()
        assert group.length.sum() <= 4096


@pytest.mark.parametrize("seed", range(6))
def test_patterns_use_the_histogram_exactly(seed):
    draw = np.random.default_rng(seed)
    counts = np.bincount(draw.integers(1, 65, draw.integers(1, 400)), minlength=65)
    used = np.zeros_like(counts)
    sequences = 0
    for times, lengths in packing.solve(counts, 64):
        assert times > 0 and sum(lengths) <= 64
        sequences += times
        np.add.at(used, lengths, times)
    assert (used == counts).all()
    assert sequences <= 1.1 * -(-int((counts * np.arange(65)).sum()) // 64) + 1


def test_complements_are_found_as_single_pair_and_triple():
    left = np.zeros(101, np.int64)
    left[[40, 30, 20]] = 1
    assert packing._complement(left, 40) == [40]
    assert packing._complement(left, 70) == [40, 30]
    assert sorted(packing._complement(left, 90)) == [20, 30, 40]
    assert packing._complement(left, 80) == []
    left[20] = 3
    assert packing._complement(left, 60) in ([40, 20],)
    left[[40, 30]] = 0
    assert packing._complement(left, 60) == [20, 20, 20]


def test_empty_table(spark):
    empty = documents(spark, [])
    assert bpe.encode_texts(empty, public_tokenizers.path("byte_bpe_50k.json")).count() == 0
    assert packing.packed_documents(empty, public_tokenizers.path("word_bpe_49k.json")).count() == 0


def test_ids_decode_by_themselves_with_nulls_and_other_columns(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    ids = bpe.encode_texts(documents(spark, ODD), path)
    rows = [(r["doc_id"], None if r["doc_id"] == 0 else list(r["ids"]), "x") for r in ids.collect()]
    table = spark.createDataFrame(rows, "doc_id long, ids array<int>, text string")
    back = {r["doc_id"]: r["text"] for r in bpe.decode_ids(table, path).collect()}
    whole = {r["doc_id"]: r["decoded"] for r in bpe.round_trip(documents(spark, ODD), path).collect()}
    assert back.pop(0) == "" and whole.pop(0) == (ODD[0] or "")
    assert back == whole == {i: t or "" for i, t in enumerate(ODD) if i}
