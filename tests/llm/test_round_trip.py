"""Encoding and decoding in one worker (operator 8 in the pipeline)."""

import contextlib
import io

import public_tokenizers
import pytest

from quantis.llm import bpe
from tests.llm.test_operators_on_odd_rows import collected, same

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def plan_of(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_ids_are_decoded_by_the_worker_that_puts_them_together(odd):
    out = bpe.encoded_rows(odd, WORD_BPE)
    assert plan_of(out).count("MapInArrow") == 2  # the words and the places; no third worker after the ids


@pytest.mark.parametrize("table", ["odd", "clashing", "empty"])
def test_round_trip_is_encode_and_decode(request, table):
    docs = request.getfixturevalue(table)
    both = bpe.decode(bpe.encode(docs, WORD_BPE), WORD_BPE)
    listed = lambda df: [(i, tuple(ids), text) for i, ids, text in collected(df)]
    same(listed(bpe.round_trip(docs, WORD_BPE)), listed(both))
