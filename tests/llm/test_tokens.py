import hashlib
import os
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from tests.llm.helpers import ODD, no_documents, odd_documents, small
from tidewell.llm import pieces, token_counts, token_files
from tidewell.llm.base import folder

os.environ["TOKENIZERS_PARALLELISM"] = "false"
WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def library(path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def both(spark):
    return odd_documents(spark).select("doc_id", "text").unionByName(small(spark, "documents", "doc_id", "text"))


def by_text(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("entries", [2, 32768])
def test_counts_are_the_library_s(spark, entries):
    docs = both(spark)
    tok = library(BYTES)
    want = by_text(
        (r.doc_id, len((r.text or "").encode()), n := len(tok.encode(r.text or "", add_special_tokens=False).ids), n > 512)
        for r in docs.collect()
    )
    assert by_text(tuple(r) for r in token_counts.token_counts(docs, BYTES, entries=entries).collect()) == want


def test_counts_with_another_tokenizer_go_to_the_library(spark):
    docs = odd_documents(spark)
    tok = library(WORDS)
    want = by_text(len(tok.encode(r.text or "", add_special_tokens=False).ids) for r in docs.collect())
    assert by_text(r.n_tokens for r in token_counts.token_counts(docs, WORDS).collect()) == want
    assert token_counts.token_counts(no_documents(spark), BYTES).count() == 0


def test_code_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 4, 5, 1000):
        ranks = (rng.integers(0, 2**32, n) >> rng.integers(0, 33, n)).astype(np.uint32)
        control, data = token_files.encode_ranks(ranks)
        assert len(control) == -(-n // 4)
        assert len(data) == sum(max(1, -(-int(x).bit_length() // 8)) for x in ranks)
        back = token_files.decode_ranks(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), n)
        assert back.tolist() == ranks.tolist()


def test_files_hold_the_library_s_ids_in_order(spark):
    docs = both(spark)
    tok = library(WORDS)
    path = folder(spark, "test")
    token_files.write_token_files(docs, WORDS, path, shard_docs=50, block_ids=500)
    rows = sorted(token_files.read_token_files(spark, path).collect(), key=lambda r: r.start)
    want = by_text((r.doc_id, [*tok.encode(r.text or "", add_special_tokens=False).ids, 1]) for r in docs.collect())
    assert by_text((r.doc_id, r.ids) for r in rows) == want
    assert [r.doc_id for r in rows] == sorted((r.doc_id for r in rows), key=lambda i: (i is not None, i or 0))
    at = 0
    for r in rows:
        assert (r.start, r.n_tokens) == (at, len(r.ids))
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at += r.n_tokens
    vocabulary = spark.read.parquet(f"{path}/vocabulary").orderBy("rank").collect()
    assert [r.n for r in vocabulary] == sorted((r.n for r in vocabulary), reverse=True)
    assert sum(r.n for r in vocabulary) == at


def test_files_of_no_documents(spark):
    path = folder(spark, "test")
    token_files.write_token_files(no_documents(spark), WORDS, path)
    assert token_files.read_token_files(spark, path).count() == 0


def test_pieces_are_the_library_s():
    coder = pieces.PieceCoder(PIECES)
    assert coder.plain
    random.seed(5)
    texts = [t or "" for t in ODD]
    texts += ["".join(random.choice("ab c\n日é▁1.") for _ in range(random.randrange(80))) for _ in range(300)]
    texts += ["".join(random.choice("etaoinshr  ") for _ in range(random.randrange(900))) for _ in range(200)]
    ids, sizes = coder.encode(pa.array(texts))
    for text, part in zip(texts, np.split(ids, np.cumsum(sizes)[:-1]), strict=True):
        want = coder.library.encode(text)
        assert part.tolist() == want
        assert coder.decode(part) == coder.library.decode(want)
    # any ids, not only a text's
    for _ in range(200):
        some = np.array([random.randrange(32000 if random.random() < 0.5 else 300) for _ in range(random.randrange(8))], np.int32)
        assert coder.decode(some) == coder.library.decode(some.tolist())


def test_long_units_are_merged_in_rounds():
    """Texts without a blank take the same path as others, in far fewer rounds than they have characters."""
    rng = random.Random(7)
    coder = pieces.PieceCoder(PIECES)
    common = [chr(c) for c in range(0x4E00, 0x9FA5) if coder.of_point[c] >= 0]
    letters = "".join(rng.choice("etaoinshrdlu") for _ in range(5000))
    parts = ["an", "na", "ing", "in", "ation", "the", "he", "th"]
    texts = {
        letters: 1000,
        "a" * 200_000: 50,
        "ab" * 20_000: 50,
        "".join(rng.choice(parts) for _ in range(50_000)): 200,
        "".join(rng.choice(common) for _ in range(50_000)): 50,
        "".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(5000)): 50,
        "%064x" % rng.getrandbits(256) * 500: 100,
        "-=" * 5000 + "=" * 5000 + "é日" * 500: 50,
    }
    for text, most in texts.items():
        ids, sizes = coder.encode(pa.array([text]))
        assert ids.tolist() == coder.library.encode(text)
        assert sizes.tolist() == [len(ids)]
        assert coder.rounds_run <= most
    ids, _ = coder.encode(pa.array(list(texts)))  # met before, side by side
    assert ids.tolist() == [i for t in texts for i in coder.library.encode(t)]
    alphabets = ["ab", "etaoin", "ing", "abcdefghijklmnopqrstuvwxyz", "日本語的是", "ABCabc123", "аеионтс", "- =*"]
    mixed = ["".join(rng.choice(a) for _ in range(rng.randrange(1, 400))) for a in alphabets for _ in range(60)]
    ids, sizes = coder.encode(pa.array(mixed))
    assert [p.tolist() for p in np.split(ids, np.cumsum(sizes)[:-1])] == coder.library.encode(mixed)


def test_a_small_memory_changes_nothing():
    coder = pieces.PieceCoder(PIECES)
    coder.memory.bound = 3
    texts = [t or "" for t in ODD] * 2
    ids, sizes = coder.encode(pa.array(texts))
    assert [p.tolist() for p in np.split(ids, np.cumsum(sizes)[:-1])] == coder.library.encode(texts)


def test_digests(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    docs = both(spark)

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    want = []
    for r in docs.collect():
        ids = library.encode(r.text or "")
        want.append((r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    got = pieces.digests(pieces.encode_pieces(docs, PIECES)).collect()
    assert by_text(tuple(r) for r in got) == by_text(want)
    assert pieces.encode_pieces(no_documents(spark), PIECES).count() == 0


def test_counts_of_texts_with_other_blanks_and_marks(spark):
    """Curly quotes, dashes, double blanks and foreign blanks are cut like any other text; none goes whole to the library."""
    kinds = ["“quoted” — dash", "a  b   c ", "x  y  z", "　 w 　v", "tab\t t\n n \r\n r", "y" * 5000, "日本 語 ", " \x1f u \x85 q",
             "it ' s 's ' t", "  lead", "trail  ", "é ́x", "﻿ b ​ c   d", "1 2  3 ½ 4"]
    rng = random.Random(4)
    texts = kinds + ["".join(rng.choice([*"ab1'!—é日 \t\n", "  ", " ", "　", " ", "'s"]) for _ in range(60)) for _ in range(400)]
    counter = token_counts._counter(public_tokenizers.path("byte_bpe_50k.json"))
    assert counter.proven(pa.array(texts)).all()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(df, public_tokenizers.path("byte_bpe_50k.json")).collect()}
    want = counter.lengths(texts)
    assert [got[i] for i in range(len(texts))] == want
