import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from flowatlas.llm import packing, wavelet
from flowatlas.llm.tokens import TextEncoder, crc32_u32, tokenizer_path

from data import awkward_documents, clashing, frame, prose


@pytest.fixture(scope="module")
def enc():
    return TextEncoder(tokenizer_path(), max_words=50)


def test_encoder_equals_library(enc):
    assert enc.by_word
    r = random.Random(1)
    alphabet = "aB'sé½Σ́ßÖ×÷ \t\n \x1c\x85<|>endoftext|'re'D9٣中ﬁ!İK"
    texts = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 40))) for _ in range(3000)]
    texts += ["<|endoftext|>x y<|startoftext|>", "", prose(1, 500)] + [x[1] or "" for x in awkward_documents()]
    got = [np.frombuffer(b, enc.dtype) for b in enc.encode([t.encode() for t in texts])]
    assert all(np.array_equal(a, b) for a, b in zip(got, enc._library(texts)))
    assert len(enc.words) <= 50


@pytest.mark.parametrize("n", [1024, 2048, 4096])
def test_words_of_equal_hash_keep_their_own_ids(n):
    """The encoder's hash cannot tell a Thue-Morse word from its complement."""
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    texts = [one, f"x {one.translate(str.maketrans('ab', 'ba'))} y", one.upper(), "x y"]
    for order in (texts, texts[::-1]):
        enc = TextEncoder(tokenizer_path())
        for batch in (order, order[:1], order[1:]):
            got = [np.frombuffer(b, enc.dtype) for b in enc.encode([t.encode() for t in batch])]
            assert all(np.array_equal(a, b) for a, b in zip(got, enc._library(batch)))


@pytest.mark.parametrize("spread", [0, 7, (1 << 64) - 1])
def test_hash_table_tells_words_of_one_hash_and_one_slot_apart(monkeypatch, spread):
    """Hashes cut to a few values: every batch mixes words of one hash, of all
    lengths around the pieces of eight bytes; more batches than slots at first."""
    from flowatlas.llm import tokens
    real = tokens.mix
    monkeypatch.setattr(tokens, "mix", lambda x: real(x) & np.uint64(spread))
    r = random.Random(3)
    words = ["".join(r.choice("abé") for _ in range(n)) for n in (*range(1, 20), 31, 32, 33, 63, 64, 65, 66, 200) for _ in range(3)]
    words += [w[:-1] + "z" for w in words if len(w) > 1] + ["a\0", "a"]
    enc = TextEncoder(tokenizer_path())
    for _ in range(4):
        texts = [" ".join(r.choices(words, k=r.randint(0, 9))) for _ in range(150)] + [f"w{i:05d} x{r.random()}" for i in range(100)]
        got = [np.frombuffer(b, enc.dtype) for b in enc.encode([t.encode() for t in texts])]
        assert all(np.array_equal(a, b) for a, b in zip(got, enc._library(texts), strict=True))


def test_table_finds_kept_words_and_no_others():
    enc = TextEncoder(tokenizer_path())
    words = [f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676 % 26)}" for i in range(9000)]
    enc._plain([" ".join(words).encode()])
    assert len(enc.keys) == 9000 and len(enc.slots) >= 3 * 9000
    assert enc._find(enc.keys).tolist() == list(range(9000))
    assert set(enc._find(enc.keys + np.uint64(1)).tolist()) == {-1}


def _ids(enc, text):
    return np.append(enc._library([text or ""])[0].astype("<u4"), np.uint32(1))


@pytest.mark.parametrize("capacity", [5, 12, 64])
def test_plan_places_every_piece_once(capacity):
    r = random.Random(capacity)
    for _ in range(200):
        lengths = sorted(r.sample(range(1, capacity + 1), r.randint(0, min(capacity, 9))))
        counts = [r.randint(0, 25) for _ in lengths]
        plan, used = packing.pack_counts(lengths, counts, capacity)
        bins, of = {}, dict(zip(lengths, counts))
        for i, (n, rank, first, per, offset) in enumerate(plan):
            end = plan[i + 1][1] if i + 1 < len(plan) and plan[i + 1][0] == n else of[n]
            for k in range(end - rank):
                bins.setdefault(first + k // per, []).append((offset + k % per * n, n))
        assert sorted(bins) == list(range(used)) and sum(map(len, bins.values())) == sum(counts)
        for b in bins.values():
            at = 0
            for o, n in sorted(b):
                assert o == at
                at += n
            assert at <= capacity and sum(3 * n > capacity for _, n in b) <= 2


def test_packing_awkward(spark, enc):
    rows = awkward_documents()
    docs = clashing(frame(spark))
    out = packing.pack_documents(docs, tokenizer_path()).collect()
    want = []
    for i, text, *_ in rows:
        ids = _ids(enc, text)
        want += [(i, p, s, len(ids[s:s + 4096]), crc32_u32(ids[s:s + 4096])) for p, s in enumerate(range(0, len(ids), 4096))]
    key = lambda t: tuple(-1 if x is None else x for x in t)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out), key=key) == sorted(want, key=key)
    seqs = {}
    for r in out:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in seqs.values():
        assert [o for o, _ in sorted(s)] == list(np.cumsum([0] + [n for _, n in sorted(s)][:-1])) and sum(n for _, n in s) <= 4096
    assert len(seqs) <= -(-sum(r.length for r in out) // 4096) + 1
    assert packing.pack_documents(docs.limit(0), tokenizer_path()).count() == 0


def test_sequences_hold_the_ids(spark, enc):
    docs = frame(spark, [(i, prose(i, 7 * i + 1), "en", "a", 0) for i in range(20)])
    packed = packing.place_pieces(
        spark.createDataFrame(packing.cut_pieces(docs, tokenizer_path(), 64).collect(),
                              packing.PIECES.format(id="long")), 64)
    pieces = {(r.sequence_id, r.offset): bytes(r.ids) for r in packed.collect()}
    for s in packing.sequences(packed).collect():
        assert bytes(s.ids) == b"".join(pieces[k] for k in sorted(pieces) if k[0] == s.sequence_id)
        assert len(s.ids) == 4 * s.n_tokens <= 4 * 64


def test_shard_access_rank_select():
    r = np.random.default_rng(1)
    for n in (0, 1, 7, 999, 300_000):
        x = (r.zipf(1.3, n) % 49408).astype(np.uint16)
        s = wavelet.Shard(wavelet.encode_shard(x, pa.array([1], pa.int64()), [n], 16))
        assert np.array_equal(s.ids(), x)
        for i in r.integers(0, n, 20).tolist() if n else []:
            t = int(x[i])
            assert s.access(i) == t and s.rank(t, i) == int((x[:i] == t).sum()) and s.select(t, s.rank(t, i)) == i
            assert s.count(t) == int((x == t).sum())
        assert s.count(65535) == 0 and s.rank(1 << 20, n) == 0
        if n == 999:
            assert s.occurrences(5) == np.flatnonzero(x == 5).tolist()
        with pytest.raises(IndexError):
            s.access(n)


def test_shards_awkward(spark, enc, tmp_path):
    rows = awkward_documents() + [(100 + i, prose(i, 9), "en", "a", 0) for i in range(400)]
    manifest = wavelet.write_shards(clashing(frame(spark, rows)), f"file://{tmp_path}/s", tokenizer_path(), shard_tokens=300)
    got = wavelet.read_documents(manifest).collect()
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    start, want = 0, []
    for i, text, *_ in rows:
        ids = _ids(enc, text)
        want.append((start, i, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == sorted(want)
    assert manifest.count() > 1
    ends = wavelet.occurrences(manifest, 1).count()
    assert ends >= len(rows)
    empty = wavelet.write_shards(frame(spark, []), f"file://{tmp_path}/e", tokenizer_path())
    assert wavelet.read_documents(empty).count() == 0
