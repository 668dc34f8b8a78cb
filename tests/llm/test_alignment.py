"""Token alignment against tokens of whole texts, two pointers and sets."""

import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from quantis.llm import alignment
from quantis.llm.tokencount import byte_symbols
from quantis.llm.wordbatch import texts, utf8
from tests.llm.test_operators_on_odd_rows import collected, same

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tokens():
    """Ids and bytes of both libraries for a whole text."""
    a, b, byte = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B), byte_symbols()
    a.encode_special_tokens = True

    def run(text):
        ia, ib = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        ta = [bytes(byte[c] for c in a.id_to_token(i)) for i in ia]
        tb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ib]
        return ia, ib, ta, tb

    return run


def brute_links(tokens, text):
    """(a place, b place, a, b, shared bytes) of all overlapping tokens, and the groups."""
    if not text:
        return [], []
    ia, ib, ta, tb = tokens(text)
    whole = (" " + text).encode()
    if b"".join(ta) != whole or b"".join(tb) != whole:
        return [], []
    ends_a, ends_b = np.cumsum([len(t) for t in ta]), np.cumsum([len(t) for t in tb])
    common = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
    links, j = [], 0
    for i, end in enumerate(ends_a):
        start = end - len(ta[i])
        while ends_b[j] <= start:
            j += 1
        k = j
        while k < len(tb) and ends_b[k] - len(tb[k]) < end:
            links.append((i, k, ia[i], ib[k], int(min(end, ends_b[k]) - max(start, ends_b[k] - len(tb[k])))))
            k += 1
    groups, i, j = [], 0, 0
    for e in common:
        ga, gb = [], []
        while i < len(ia) and ends_a[i] <= e:
            ga.append(i)
            i += 1
        while j < len(ib) and ends_b[j] <= e:
            gb.append(j)
            j += 1
        groups.append((ga, gb))
    return links, [([ia[i] for i in ga], [ib[j] for j in gb], ga, gb) for ga, gb in groups]


def brute_report(tokens, rows):
    found = [(i, *brute_links(tokens, t)) for i, t, *_ in rows]
    held = collections.Counter(p for _, links, _ in found for p in {x[2:4] for x in links})
    top = collections.Counter()
    for (a, _), n in held.items():
        top[a] = max(top[a], n)
    out = []
    for i, links, groups in found:
        body = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b, _, _ in groups)
        out.append(
            (
                i, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), len(links),
                sum(len(g[0]) * len(g[1]) for g in groups), hashlib.sha256(body.encode()).hexdigest() if groups else "",
                sum(held[x[2:4]] == top[x[2]] for x in links), sum(held[x[2:4]] for x in links),
            )
        )
    return out


HARD = [
    "  two  spaces ", " lead", "tail ", "a\n b\t c \n  d", "<|endoftext|> <s> x</s><unk>", "▁ marks ▁▁ x", "x▁y", "\x00 \x01", "ﬁ ﬃ",
    "日本 語 😀 é è", "word's they'll 12 345 $%& --- ...", "  a  b　 c", "naïve em  line", " ", "   ", "\n", "a " * 400,
]


@pytest.mark.parametrize("table", ["odd", "clashing"])
def test_report_equals_whole_texts(request, tokens, odd_rows, table):
    got = collected(alignment.report(request.getfixturevalue(table), A, B))
    same(got, brute_report(tokens, odd_rows))


def test_report_on_hard_texts(spark, tokens):
    rows = [(i, t) for i, t in enumerate(HARD)] + [(90, "the same"), (91, "the same"), (None, "the same"), (92, None)]
    got = collected(alignment.report(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), A, B))
    same(got, brute_report(tokens, rows))
    assert {r[0] for r in got if r[1] == 0} >= {5, 6, 92}  # marks that are no spaces, and nothing


def test_empty_table(empty):
    assert collected(alignment.report(empty, A, B)) == []
    assert collected(alignment.links(empty, A, B)) == []


def test_links_and_shared_links(spark, tokens):
    rows = [(i, t) for i, t in enumerate(HARD)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = [(i, *brute_links(tokens, t)) for i, t in rows]
    same(collected(alignment.links(df, A, B)), [(i, *x) for i, links, _ in found for x in links])
    same(collected(alignment.shared_links(df, A, B)), [(i, a, b) for i, _, groups in found for g in groups for a in g[2] for b in g[3]])


def test_chunks_have_the_tokens_of_whole_texts(tokens):
    """Random texts of everything that a cut could go wrong at."""
    parts = ["a", "b's", " ", "  ", "\n", "\t", " ", " ", "　", "\u0085", "é", "日", "😀", "12", "...", "'ll", "\x1c", "\x7f", "ا", "▁", "<s>", "~"]
    rng = random.Random(5)
    lines = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 30))) for _ in range(3000)]
    u = alignment.Unit([utf8(texts(pa.array(lines)))], A, B)
    x, a_first, b_first = u.whole()
    for k, line in enumerate(lines):
        ia, ib, ta, tb = tokens(line)
        if b"".join(ta) == b"".join(tb) == (" " + line).encode():
            assert x.a[a_first[k] : a_first[k + 1]].tolist() == ia and x.b[b_first[k] : b_first[k + 1]].tolist() == ib, line
        else:
            assert a_first[k] == a_first[k + 1] and b_first[k] == b_first[k + 1]


def test_products_equal_dense_ones():
    rng = np.random.default_rng(3)
    left, right = rng.integers(0, 3, (17, 9)) * rng.integers(0, 2, (17, 9)), rng.integers(0, 3, (9, 13))

    def csr(m):
        return alignment.Csr(np.concatenate([[0], np.cumsum((m > 0).sum(axis=1))]), np.nonzero(m)[1], m[m > 0], m.shape[1])

    for block in (1, 20, 10_000):
        out = np.zeros((17, 13), int)
        for i, j, v in csr(left).product(csr(right), block):
            out[i, j] += v
        assert (out == left @ right).all()
    t = csr(left).transposed()
    assert t.rows == 9 and (np.diff(t.first) == (left > 0).sum(axis=0)).all()
