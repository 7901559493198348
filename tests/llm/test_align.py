from __future__ import annotations

import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from helpers import docs_df
from tokenizers import Tokenizer

from vigil.llm import align
from vigil.llm.bytebpe import byte_strings
from vigil.llm.common import table

COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_overlaps", "n_best", "count_sum", "groups_sha256"]


def plain(texts):
    """Figures of every text by comparing all offsets one by one."""
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    a_bytes = byte_strings(tok)

    def piece(i):
        p = model.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode()

    docs, links = [], Counter()
    for t in texts:
        a = tok.encode(" " + (t or ""), add_special_tokens=False).ids if t else []
        b = model.encode(t) if t else []
        whole = (" " + (t or "")).encode()
        if not t or b"".join(a_bytes[i] for i in a) != whole or b"".join(map(piece, b)) != whole:
            docs.append(([], [], [], []))
            continue
        sides = []
        for ids, size in ((a, lambda i: len(a_bytes[i])), (b, lambda i: len(piece(i)))):
            at, spans = 0, []
            for i in ids:
                spans.append((at, at + size(i), i))
                at += size(i)
            sides.append(spans)
        ends = [{e for _, e, _ in s} for s in sides]
        cuts = sorted(ends[0] & ends[1])
        groups, lo = [], 0
        for hi in cuts:
            groups.append("|".join(",".join(str(i) for s, e, i in side if lo <= s and e <= hi) for side in sides))
            lo = hi
        by_end = [{e: i for _, e, i in s} for s in sides]
        mine = [(by_end[0][e], by_end[1][e]) for e in cuts]
        touching = sum(1 for s, e, _ in sides[0] for x, y, _ in sides[1] if s < y and x < e) if len(whole) < 400 else None
        links.update(mine)
        docs.append((a, b, groups, mine, touching))
    most = Counter()
    for (_, b), n in links.items():
        most[b] = max(most[b], n)
    out = []
    for a, b, groups, mine, *touching in docs:
        best = sum(links[p] == most[p[1]] for p in mine)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        out.append((len(a), len(b), len(groups), len(mine), touching[0] if touching else 0, best, sum(links[p] for p in mine), digest))
    return out


EDGES = ["", None, "x", " x", "a  b\tc\n\nd", "<|endoftext|> </s> <s>", "▁ differs", "中文 👩‍👩‍👧 naïve", "the the the house", "The house, the garden; 12345 antidisestablishmentarianism", "x" * 300, "<0x41>", "\x00a"]


@pytest.mark.parametrize("hot", [align.HOT, 30, 1])
def test_edges_with_any_number_of_broadcast_pairs(spark, hot):
    rows = list(enumerate(EDGES)) + [(2, "x"), (None, "the house")]
    got = align.alignment(docs_df(spark, rows), hot=hot).collect()
    want = Counter((d, *w) for (d, _), w in zip(rows, plain([t for _, t in rows])))
    assert Counter((r.doc_id, *(r[c] for c in COLUMNS)) for r in got) == want
    assert align.alignment(docs_df(spark, [])).count() == 0


def test_whole_table(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in align.alignment(docs).collect()}
    for (d, _), w in zip(rows, plain([t for _, t in rows])):
        g = got[d]
        assert g[:4] + g[5:] == w[:4] + w[5:] and w[4] in (None, g[4])
