"""A worker process that goes from one operator to the next keeps nothing of the first."""

import pyarrow as pa
import pytest

from flowatlas.llm import common, neardup, secrets, tokens, toxicity

TEXTS = [f"user{i} wrote AKIA{'Q' * 12}{i:04d} and went" if i % 3 else "nothing to see" for i in range(1200)]


def words_of_an_encoder():
    common.KEPT.clear()
    e = tokens.encoder(tokens.tokenizer_path())
    list(e.encode([t.encode() for t in TEXTS]))
    assert tokens.encoder(tokens.tokenizer_path()) is e and len(e.keys) > 10


def batch(as_bytes):
    texts = [t.encode() for t in TEXTS] if as_bytes else TEXTS
    return pa.RecordBatch.from_arrays([pa.array(range(len(TEXTS))), pa.array([0] * len(TEXTS)), pa.array(texts)], names=["id", "_h", "t"])


@pytest.mark.parametrize("task", [
    lambda: secrets.scan_batches([batch(False).select(["id", "t"])]),
    lambda: neardup._sets([batch(True)], 5),
    lambda: toxicity._scored([batch(True)], lambda _: toxicity.Lexicon([pa.array([], pa.uint64()).to_numpy()] * 3, [pa.array([], pa.float64()).to_numpy()] * 3), 2)])
def test_the_next_operator_lets_the_encoder_go(task):
    words_of_an_encoder()
    next(iter(task()))
    assert not common.KEPT


def test_secrets_are_found_in_slices_of_a_batch():
    out = list(secrets.scan_batches([batch(False).select(["id", "t"])]))
    assert [b.num_rows for b in out] == [500, 500, 200]
    assert [i for b in out for i in b.column(0).to_pylist()] == list(range(1200))
    compiled = secrets.compile_rules()
    assert [[(s["kind"], s["first"], s["end"]) for s in x] for b in out for x in b.column(1).to_pylist()] == [secrets.find_spans(t, compiled) for t in TEXTS]
