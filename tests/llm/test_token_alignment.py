"""Alignment against a plain reading of the definition: whole texts, decoded bytes, counted links."""
import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tessera.llm import queries
from tessera.llm import token_alignment as A
from tessera.llm.queries import BYTE_BPE, PIECE_BPE

ODD = ["a  b \n c ", "é日本\U0001f600x 王", " lead", "trail ", "a\0b </s> <s>", "x<|endoftext|>y", "▁x a", "x ▁ y", "  a　b", "tab\there", "\x1c a \x85b",
       "é ﬁ Ⅷ", "’s it's 'll a 's", "日本 語\n\n  x", "a ​ b", "𐍈 <0x41> x", " ", "\n", "नमस्ते दुनिया", "x" * 300 + " " + "é" * 90]


@pytest.fixture(scope="module")
def plain():
    """(n_a, n_b, groups, links) of a text, from its joined bytes alone."""
    a, b = Tokenizer.from_file(BYTE_BPE), sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    a.encode_special_tokens = True
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte_of = {chr(c): c for c in keep} | {chr(256 + i): c for i, c in enumerate(c for c in range(256) if c not in keep)}

    def read(text):
        if not text:
            return 0, 0, "", []
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        raw_a = [bytes(byte_of[c] for c in a.id_to_token(i)) for i in ids_a]
        raw_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not b"".join(raw_a) == b"".join(raw_b) == b" " + text.encode():
            return 0, 0, "", []
        ends = lambda raw: [sum(map(len, raw[:k + 1])) for k in range(len(raw))] if len(raw) < 400 else __import__("itertools").accumulate(map(len, raw))
        ends_a, ends_b = list(ends(raw_a)), list(ends(raw_b))
        groups, links, i, j = [], [], 0, 0
        for cut in sorted(set(ends_a) & set(ends_b)):
            to_i, to_j = ends_a.index(cut, i) + 1, ends_b.index(cut, j) + 1
            groups.append(",".join(map(str, ids_a[i:to_i])) + "|" + ",".join(map(str, ids_b[j:to_j])))
            links.append((ids_a[to_i - 1], ids_b[to_j - 1]))
            i, j = to_i, to_j
        return len(ids_a), len(ids_b), ";".join(groups), links

    return read


def expected(rows, plain):
    read = [(i, *plain(t)) for i, t in rows]
    count = Counter(x for *_, links in read for x in links)
    top = {}
    for (_, b), n in count.items():
        top[b] = max(n, top.get(b, 0))
    return sorted(((i, n_a, n_b, g.count(";") + 1 if g else 0, len(ls), sum(count[x] == top[x[1]] for x in ls), sum(count[x] for x in ls),
                    hashlib.sha256(g.encode()).hexdigest() if g else "") for i, n_a, n_b, g, ls in read), key=str)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def aligned(docs):
    return sorted((tuple(r) for r in A.align_tokenizers(docs, BYTE_BPE, PIECE_BPE).select(*COLUMNS).collect()), key=str)


@pytest.mark.parametrize("chunk_bytes", [2000, 4 << 20])
def test_equals_the_definition(spark, make_docs, awkward, plain, monkeypatch, chunk_bytes):
    rows = awkward + [(100 + i, t) for i, t in enumerate(ODD)]
    monkeypatch.setattr(A, "CHUNK_BYTES", chunk_bytes)
    assert aligned(make_docs(rows).repartition(3)) == expected(rows, plain)


def test_empty_table(spark, make_docs):
    assert aligned(make_docs([])) == []
    assert aligned(make_docs([(1, None), (2, "")])) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2)]


def test_packed_alignment_gives_byte_spans(plain):
    aligner = A.load(BYTE_BPE, PIECE_BPE)
    for text in [t for t in ODD if plain(t)[0]]:
        found = aligner.aligned([text])
        (digits,), (a,), (b,) = aligner.groups_text(found), found.each("a"), found.each("b")
        a, b = aligner.packed(a), aligner.packed(b)
        raw, at = b" " + text.encode(), 0
        groups = aligner.groups(a, b)
        assert digits.decode() == plain(text)[2] == ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for *_, x, y in groups)
        for start, end, ids_a, ids_b in groups:
            assert start == at and b"".join(aligner.bytes_a[i] for i in ids_a) == b"".join(aligner.bytes_b[i] for i in ids_b) == raw[start:end]
            at = end
        assert at == len(raw)


def test_spans_are_refined_by_decoded_bytes():
    widths = lambda spans, lengths: A.refined_widths(*np.array(spans).T, np.array(lengths)).tolist()
    assert widths([(0, 1), (1, 4), (4, 5)], [1, 3, 1]) == [1, 3, 1]
    # two pieces of one three-byte character, both reported with its whole span; then one that goes on after it
    assert widths([(0, 3), (0, 3), (3, 4)], [2, 1, 1]) == [2, 1, 1]
    assert widths([(1, 3)], [3]) == [3]


def test_words_are_kept_over_two_generations(monkeypatch, plain):
    monkeypatch.setattr(A, "_CACHE_UNITS", 3)
    aligner = A.Aligner(BYTE_BPE, PIECE_BPE)
    texts = [f"alpha beta w{i} v{i}\nalpha" for i in range(20)]
    for t in texts:
        assert aligner.groups_text(aligner.aligned([t]))[0].decode() == plain(t)[2]
    assert len(aligner._recent.index) + len(aligner._before.index) < 16


def test_texts_share_a_cache_without_mixing_their_beginnings(plain):
    aligner = A.Aligner(BYTE_BPE, PIECE_BPE)
    texts = ["\na b", "x\na b", " a", "a", "x a", "\n\na", "x\n\na", "日\n本", "a\u2581b", "a\n\u2581b", "", None, "x\n'll"]
    for some in (texts, texts[::-1]):
        got = [g.decode() for g in aligner.groups_text(aligner.aligned(some))]
        assert got == [plain(t)[2] for t in some]


def test_registered_query(spark, plain):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op13_token_alignment(spark, sf)
    assert got.columns[:8] == COLUMNS
    assert sorted((tuple(r) for r in got.select(*COLUMNS).collect()), key=str) == expected(rows, plain)


def test_no_cycle_search_while_words_are_aligned(monkeypatch):
    import gc

    aligner = A.load(BYTE_BPE, PIECE_BPE)
    seen = []

    def known(self, keys):
        seen.append(gc.isenabled())
        raise LookupError

    monkeypatch.setattr(A.Aligner, "_known", known)
    with pytest.raises(LookupError):
        aligner.aligned(["a word"])
    assert seen == [False] and gc.isenabled()  # back on, also when the words fail
