import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pagelake.llm import packing, tokens

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "",
    "<|endoftext|> a<|endoftext|>b  c<|startoftext|>x",
    "aaaaaaa aaa!!!! ½²x   y z  ",
    "日本語 テスト　です",
    "é x́\x1c\x0b\x85 z 'll don't   \n\n x",
    "A" * 5000,
    " " * 70 + "x",
    "İΣΣ ς 1234 v2.0 it's IT'S",
    "́abc ́",
]
text = st.text(alphabet=st.sampled_from(list("abcdeAB 'éßÉñ1\n\t.,!<|>½日́ ")), max_size=60)


@settings(max_examples=150, deadline=None)
@given(st.lists(text, max_size=6))
def test_counts_and_ids_are_the_librarys(texts):
    texts = texts + ODD
    got = tokens.token_counts(texts, BYTE)
    assert got == [len(e.ids) for e in Tokenizer.from_file(BYTE).encode_batch(texts, add_special_tokens=False)]
    ids = packing.encode([t.encode() for t in texts], WORD, 1)
    want = Tokenizer.from_file(WORD).encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(i, "<u4").tolist() for i in ids] == [e.ids + [1] for e in want]


def test_count_tokens_on_odd_rows(odd):
    got = sorted(map(tuple, tokens.count_tokens(odd, limit=3).collect()), key=repr)
    assert len(got) == odd.count()
    assert (1, 0, 0, False) in got and (2, 0, 0, False) in got
    assert got.count((4, 8, 2, False)) == 2
    assert [g for g in got if g[0] == 6][0][1:] == (70_000, len(Tokenizer.from_file(BYTE).encode("x" * 70_000).ids), True)
    assert tokens.count_tokens(odd.where("false")).collect() == []


def brute_fill(lengths, free):
    sums = {0}
    for n, k in lengths.items():
        for _ in range(k):
            sums |= {s + n for s in sums if s + n <= free}
    return max(sums)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 5), max_size=8), st.integers(0, 100))
def test_best_fill_is_the_closest_sum(lengths, free):
    used = packing.best_fill(lengths, free)
    assert all(0 < k <= lengths[n] for n, k in used.items())
    assert sum(n * k for n, k in used.items()) == brute_fill(lengths, free)


@pytest.mark.parametrize("capacity", [1, 7, 64])
def test_every_id_lies_in_one_piece(docs_of, capacity):
    texts = [f"word{i} " * (i % 11) for i in range(200)] + ["tie tie tie"] * 100
    docs = docs_of(texts, parts=2)
    rows = packing.pack_documents(docs, capacity=capacity).collect()
    want = {i: e.ids + [1] for i, e in enumerate(Tokenizer.from_file(WORD).encode_batch(texts, add_special_tokens=False))}
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    for i, ids in want.items():
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes()) == r.ids_crc32
            at += r.length
        assert at == len(ids)
    for s in by_seq.values():
        s.sort(key=lambda r: r.offset)
        assert [r.offset for r in s] == np.cumsum([0] + [r.length for r in s]).tolist()[:-1]
        assert sum(r.length for r in s) <= capacity
    # at most one short sequence for each of the two partitions
    assert sum(sum(r.length for r in s) < capacity for s in by_seq.values()) <= 2


def test_equal_lengths_are_cut_rather_than_padded():
    packer = packing.Packer(2048, 0)
    for i in range(50):
        packer.add(b"\1\0\0\0" * 1100, i, 1100)
    packer.pack()
    assert packer.next_id == -(-50 * 1100 // 2048)


def test_packing_odd_rows(odd):
    rows = packing.pack_documents(odd).collect()
    assert sum(r.length for r in rows if r.doc_id in (1, 2, 3)) == 3
    assert len([r for r in rows if r.doc_id == 4]) == 2 and any(r.doc_id is None for r in rows)
    assert packing.pack_documents(odd.where("false")).collect() == []
