"""Token lengths and token files against the tokenizer itself."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from soleprint.llm import encode, lengths, token_file
from soleprint.llm.catalog import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "  a  b ", "a\n\n b\t\tc \r\n", "tail \n", "\n lead", "a  b", "a\x1c b!\x0b c", "x<|endoftext|> y",
    " <|endoftext|>", "a  <|endoftext|>  b", "don't  we'll 12 345!? ñandú ÉÉ　 z", "!! !!! ##\n#",
    "é ​ ﻿ x", "你好 世界\nok",
]


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_pieces_encode_like_whole_texts(plain):
    encoder = encode.Encoder(PATH)
    for text, ids in zip(ODD, encoder(ODD), strict=True):
        assert np.frombuffer(ids, np.int32).tolist() == plain(text), repr(text)


def test_pieces_encode_alike_without_a_mark(plain):
    texts = ODD + ["<|endoftext and |> <|", "a<|endoftext", "|>b", "_a__b_!x_",
                    "\nÉté  ǅungla ƻ x×y ÷ŉ", "".join(map(chr, range(0xC0, 0x250)))]
    encoder, bare = encode.Encoder(PATH), encode.Encoder(PATH)
    assert encoder.mark == ("<|endoftext|>", 50256)
    bare.mark, bare.uncut = None, bare.tokenizer.pre_tokenizer
    many = texts + [f"w{i} x_{i}-{i}é" for i in range(3 * encode.TOGETHER)]
    assert encoder(many) == bare(many)
    for text, ids in zip(texts, encoder(texts), strict=True):
        assert np.frombuffer(ids, np.int32).tolist() == plain(text), repr(text)


def test_length_query(spark, sf_dir, plain):
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()
    sizes = np.array([len(plain(r["text"])) for r in texts])
    got = {r["n_tokens"]: r for r in QUERIES["op4_length_histogram"](spark, sf_dir).collect()}
    assert set(got) == set(sizes.tolist())
    for limit, row in got.items():
        assert row["n_docs"] == (sizes == limit).sum() and row["docs_over"] == (sizes > limit).sum()
        assert row["tokens_over"] == sizes[sizes > limit].sum()
        assert row["total_tokens"] == sizes.sum()
        assert row["kept_tokens"] == np.minimum(sizes, limit).sum()
        assert row["lost_tokens"] == sizes.sum() - row["kept_tokens"]
        assert row["share_fitting"] == pytest.approx((sizes <= limit).mean())


def check_index(rows, plain, index):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    got = sorted((tuple(r) for r in index.collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [d for d, _ in rows]
    at, crcs = 0, {}
    for doc_id, start, n_tokens, crc in got:
        assert start == at
        at += n_tokens
        crcs.setdefault(doc_id, []).append((n_tokens, crc))
    want = {}
    for doc_id, text in rows:
        ids = np.array([*plain(text), 0], "<u4")
        want.setdefault(doc_id, []).append((len(ids), zlib.crc32(ids.tobytes())))
    assert {d: sorted(v) for d, v in crcs.items()} == {d: sorted(v) for d, v in want.items()}


def test_token_query(spark, sf_dir, plain):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    check_index([tuple(r) for r in rows], plain, QUERIES["op7_token_orc"](spark, sf_dir))


def test_edges(spark, tmp_path, plain):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, "again"), (3, "again"), (None, "x y"),
                                                  (None, None), (99, "long text " * 100_000)]
    docs = spark.createDataFrame([(*r, "z", 0) for r in rows],
                                 "doc_id long, text string, ids string, part int")
    token_file.write_tokens(docs, str(tmp_path / "a"), PATH)
    tokens = token_file.read_tokens(spark, str(tmp_path / "a"))
    check_index(rows, plain, token_file.token_index(tokens))
    assert tokens.where("doc_id = 99").count() == 1
    token_file.write_tokens(docs.limit(0), str(tmp_path / "b"), PATH)
    empty = token_file.read_tokens(spark, str(tmp_path / "b"))
    assert token_file.token_index(empty).count() == 0
    none = lengths.token_lengths(docs.limit(0), PATH)
    assert lengths.context_limits(lengths.length_histogram(none)).count() == 0
    assert lengths.token_lengths(docs, PATH).count() == len(rows)


def test_words_go_to_the_model_alone(plain, tmp_path):
    letters = "".join(map(chr, [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x250)]))
    texts = [letters, "na\nïve señor ", " Ñandú", "a<|b", "x\x1fy", "x y", "", "Hello  wörld\n" * 50]
    texts += [" ".join(letters[i:i + n] for i in range(0, len(letters), n)) for n in range(1, 9)]
    encoder, bare = encode.Encoder(PATH), encode.Encoder(PATH)
    assert encoder.direct
    cut = []
    encoder._joined = lambda pieces: cut.extend(pieces) or encode.Encoder._joined(encoder, pieces)
    bare.direct = False
    assert encoder(texts) == bare(texts)
    assert cut and not any(encode.WORD.fullmatch(piece) for piece in cut)
    for text, ids in zip(texts, encoder(texts), strict=True):
        assert np.frombuffer(ids, np.int32).tolist() == plain(text), repr(text)
    # A token of one's own may lie in a word: then words go the whole way.
    for i, token in enumerate(["ello", " ", " wör"]):
        own = Tokenizer.from_file(PATH)
        own.add_tokens([token])
        own.save(str(tmp_path / f"{i}.json"))
        assert not encode.Encoder(str(tmp_path / f"{i}.json")).direct


def test_a_piece_is_looked_up_once():
    class Looks(dict):
        n = 0

        def get(self, key):
            Looks.n += 1
            return super().get(key)

    encoder = encode.Encoder(PATH)
    encoder.kept = Looks(encoder.kept)
    encoder(["one two one", "two!"])
    assert Looks.n == 7  # with the empty piece that ends each text
    assert {"one", " two", " one", "two", "!"} <= set(encoder.kept)
