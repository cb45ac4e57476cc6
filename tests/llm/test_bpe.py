import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from feedweave.llm import bpe, catalog

PATH, PATTERN = catalog.RANKS, catalog.PATTERN


@pytest.fixture(scope="module")
def reference():
    ranks = bpe.load_ranks(PATH).ranks
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts():
    rng = random.Random(5)
    texts = ["", "a" * 3000, " " * 2000 + "x", "=-" * 400, "aaa aaaa aaaaa  \n\n\n \t x", "<|endoftext|> hi", "日本語テキスト🎉🎉 é", "'s 't're x'll I'M", "\r\n\r\n", "x" * 50_000]
    texts += ["".join(rng.choice("abcdeht inrs  \n'=-_0123🎉éß") for _ in range(rng.randint(1, 80))) for _ in range(400)]
    tokens = [t for t in bpe.load_ranks(PATH).tokens if len(t) > 2]
    texts += [b"".join(rng.choice(tokens)[: rng.randint(1, 9)] for _ in range(6)).decode("utf8", "ignore").replace(" ", "") for _ in range(400)]
    return texts


def test_replay_equals_word_by_word_encoder(reference):
    texts = odd_texts()
    got = bpe.Encoder(PATH, PATTERN).encode([*texts, None]).to_pylist()
    assert got == [*[reference.encode_ordinary(t) for t in texts], []]


def test_other_vocabulary():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    own = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.load_ranks(path).ranks, special_tokens={})
    texts = odd_texts()
    assert bpe.Encoder(path, PATTERN).encode(texts).to_pylist() == [own.encode_ordinary(t) for t in texts]


def test_forgetting_words_changes_nothing(monkeypatch, reference):
    monkeypatch.setattr(bpe, "REMEMBERED_WORDS", 10)
    encoder, texts = bpe.Encoder(PATH, PATTERN), odd_texts()
    for a in range(0, len(texts), 50):
        assert encoder.encode(texts[a : a + 50]).to_pylist() == [reference.encode_ordinary(t) for t in texts[a : a + 50]]


def test_round_trip_and_digests(spark, reference, monkeypatch):
    texts = [*odd_texts()[:60], None, "the same", "the same"]
    docs = spark.createDataFrame([(k, t, "old", 7) for k, t in enumerate(texts)], "doc_id long, text string, tokens string, x int")
    tokens = bpe.encode(docs, PATH, PATTERN)
    assert tokens.columns == ["doc_id", "text", "x", "tokens"]
    decoded = {r["doc_id"]: bytes(r["decoded"]) for r in bpe.decode(tokens, PATH).collect()}
    digests = bpe.round_trip(docs, PATH, PATTERN)
    assert digests.columns == ["doc_id", "x", "tokens", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert "tokens" not in bpe.round_trip(docs.drop("tokens"), PATH, PATTERN, with_tokens=False).columns
    rows = digests.collect()
    assert len(rows) == len(texts)
    for r in rows:
        data = (texts[r["doc_id"]] or "").encode()
        ids = reference.encode_ordinary(data.decode())
        assert (r["n_tokens"], r["tokens"], decoded[r["doc_id"]]) == (len(ids), ids, data)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(data).hexdigest()
    assert bpe.encode(docs.where("false"), PATH, PATTERN).count() == 0
    assert bpe.round_trip(docs.where("false"), PATH, PATTERN).count() == 0


def test_decode_of_odd_lists(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, [64, 65])], "id long, tokens array<int>")
    found = {r["id"]: bytes(r["decoded"]) for r in bpe.decode(df, PATH).collect()}
    ranks = bpe.load_ranks(PATH)
    assert found == {1: b"", 2: b"", 3: ranks.tokens[64] + ranks.tokens[65]}
    with pytest.raises(Exception, match="not in the vocabulary"):
        bpe.decode(spark.createDataFrame([(1, [10**6])], "id long, tokens array<int>"), PATH).collect()
