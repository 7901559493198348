from __future__ import annotations

import public_tokenizers
from helpers import docs_df, sf_table
from tokenizers import Tokenizer

from vigil.llm import bytebpe, tokencount
from vigil.llm.common import table

PATH = public_tokenizers.path("byte_bpe_50k.json")
EDGES = ["", " ", "\n\n  x", "a" * 5000, "<|endoftext|>", "x<|endoftext|> y<|endoftext|>", "it's they'LL we're", "tab\tnbsp\xa0\x85\x1c\x1f end  ", "naïve ÄÖ 中文字 👩‍👩‍👧 ½²x", "‐–—’s ’ll", "  1234567 ٣٤ x²", "\x00\x01"]


def test_every_text_as_the_library(spark):
    tok = Tokenizer.from_file(PATH)
    got = {r.doc_id: r for r in tokencount.count_tokens(table(spark, "/root/testdata/sf0.01", "documents")).collect()}
    rows = sf_table("documents")
    assert len(got) == len(rows)
    want = tok.encode_batch([r["text"] or "" for r in rows], add_special_tokens=False)
    for r, e in zip(rows, want):
        g = got[r["doc_id"]]
        assert (g.n_bytes, g.n_tokens, g.over_limit) == (len((r["text"] or "").encode()), len(e.ids), len(e.ids) > 1024)


def test_edges(spark):
    tok = Tokenizer.from_file(PATH)
    rows = [(i, t) for i, t in enumerate(EDGES)] + [(0, ""), (None, "a b"), (99, None)]
    out = tokencount.count_tokens(docs_df(spark, rows)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens) for r in out) == sorted((i is None, i or 0, len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    assert tokencount.count_tokens(docs_df(spark, [])).count() == 0


def test_other_vocabularies(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    low = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs = docs_df(spark, list(enumerate(EDGES)))
    assert {r.doc_id: r.n_tokens for r in tokencount.count_tokens(docs, "piece_bpe_32k.model").collect()} == {i: len(model.encode(t)) for i, t in enumerate(EDGES)}
    assert {r.doc_id: r.n_tokens for r in tokencount.count_tokens(docs, "word_bpe_49k.json").collect()} == {i: len(low.encode(t, add_special_tokens=False).ids) for i, t in enumerate(EDGES)}


def test_classes_of_the_agreed_characters():
    pre = bytebpe.Pretokens(Tokenizer.from_file(PATH))
    agreed = [chr(c) for c in range(0x3000) if bytebpe.AGREED.fullmatch(chr(c))]
    assert len(agreed) > 600
    for c in agreed:
        probe = f"a{c}b 1{c}2 {c}{c} .{c}. {c}"
        assert pre.split(probe) == pre.by_library(probe), hex(ord(c))


def test_proof_and_merges():
    tok = Tokenizer.from_file(PATH)
    whole = bytebpe.prove_whole(PATH)
    assert 40_000 < len(whole) < tok.get_vocab_size() and "<|endoftext|>" not in whole
    for text, i in list(whole.items())[::97]:
        assert tok.encode(text, add_special_tokens=False).ids == [i]
    counter = tokencount.Counter(PATH, whole)
    assert counter.count("the house and the garden") == 5 and counter.costs.merged == 0
    counter.count("zzqxj zzqxj")
    assert counter.costs.merged == 2  # at the start and after a space, each once
