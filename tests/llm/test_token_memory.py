"""A worker's piece caches are bounded by characters as well as by count."""

from meterflow.llm import packing, tokens


def test_long_pieces_turn_the_caches_over():
    enc = tokens.PieceEncoder(tokens.tokenizer_path("word_bpe_49k.json"), 1000)
    texts = [f"start {'x' * 2000}{i} end" for i in range(60)]
    whole = [t.encode() for t in texts]
    got = []
    for t in texts:
        got += enc.encode([t])
        assert sum(map(len, enc.known)) <= 1000 // 2 * tokens.PIECE_BYTES + 4100
    assert sum(map(len, enc.known)) + sum(map(len, enc.older)) < sum(map(len, whole)) / 2
    assert got == enc._direct(texts)


def test_packing_beside_other_work_caches_few_pieces(spark):
    docs = spark.createDataFrame([(i, f"some words {i} here\n" * 30) for i in range(50)], "doc_id long, text string")
    here = packing.pack_documents(docs, lasting=False).orderBy("doc_id", "piece").collect()
    there = packing.pack_documents(docs).orderBy("doc_id", "piece").collect()
    assert [r[:5] for r in here] == [r[:5] for r in there] and len(here) == 50


def test_ids_are_those_of_the_whole_text():
    texts = ["a\n\n\nb", "a\n\n\tb", "x\t\n\n y", "One, two; (three). It's x's, 'tis!\nFour.", "É, é. İ-- ²,\n\nZ<a>", "", " \n", "a\n", " \n\n b"]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        enc = tokens.PieceEncoder(tokens.tokenizer_path(name), 1000)
        assert enc.encode(texts) == enc._direct(texts)


def test_punctuation_and_case_share_a_piece():
    texts = ["the word word, word. word! (word)", "é word word; Word, WORD."]
    enc = tokens.PieceEncoder(tokens.tokenizer_path("byte_bpe_50k.json"), 1000)
    assert enc.encode(texts[:1]) == enc._direct(texts[:1])
    assert set(enc.known) == {"\nthe", "word", "(word"}
    enc = tokens.PieceEncoder(tokens.tokenizer_path("word_bpe_49k.json"), 1000)
    assert enc.encode(texts) == enc._direct(texts)
    assert set(enc.known) == {"the", "word", "(word", "é"}
