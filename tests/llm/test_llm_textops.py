import numpy as np
import pyarrow as pa

from llm_fixtures import plain_texts
from tidemark.llm.textops import BLOCK_BYTES, hashes_in_order, shingles_of, text_chunks, word_hashes, words_of


def shingle_ids(texts, limit):
    out = {}
    for lo, hi, data, offsets in text_chunks(pa.array(texts), limit):
        row, hashes = shingles_of(data, offsets, 5)
        for k in range(hi - lo):
            out[lo + k] = hashes[row == k].tolist()
    return out


def test_words_are_those_of_bytes_split():
    texts = [t for _, t, _ in plain_texts()]
    for lo, hi, data, offsets in text_chunks(pa.array(texts), 500):
        first, last, row = words_of(data, offsets)
        for k in range(hi - lo):
            got = [data[a:b].tobytes() for a, b, r in zip(first, last, row) if r == k]
            assert got == texts[lo + k].encode().split()


def test_hashes_do_not_depend_on_chunks_and_tell_words_apart():
    texts = [t for _, t, _ in plain_texts()]
    assert shingle_ids(texts, 100) == shingle_ids(texts, 1 << 21)
    words = sorted({w for t in texts for w in t.encode().split()})
    data = np.frombuffer(b" ".join(words), dtype=np.uint8)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = ends - [len(w) for w in words]
    assert len(set(word_hashes(data, starts, ends).tolist())) == len(words)


def test_shingles_follow_the_definition():
    texts = ["", "  ", "one", "a b c d", "A b c d e", "a b c d e f a b c d e"]
    got = shingle_ids(texts, 1 << 20)
    assert [len(got[k]) for k in range(6)] == [0, 0, 1, 1, 1, 7]
    assert got[4][0] == got[5][0] == got[5][-1]


def test_null_counts_as_empty_and_slices_work():
    column = pa.array(["skip", None, "b c", None])[1:]
    assert [(lo, hi, data.tobytes()) for lo, hi, data, _ in text_chunks(column)] == [(0, 3, b"b c")]
    assert list(text_chunks(pa.array([], pa.string()))) == []


def test_hashes_by_blocks_equal_those_of_the_whole():
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abcde"), rng.integers(1, 9))) for _ in range(60_000)] + ["x" * (BLOCK_BYTES + 9), "end"]
    data = np.frombuffer(" ".join(words).encode(), dtype=np.uint8)
    first, last, _ = words_of(data, np.array([0, len(data)]))
    assert np.array_equal(hashes_in_order(data, first, last), word_hashes(data, first, last))


def test_chunks_of_either_string_type_and_of_slices():
    texts = ["one", None, "", "zwei drei", "\u6771\u4eac"]
    for kind in (pa.string(), pa.large_string()):
        column = pa.array(["skipped", *texts], kind).slice(1)
        got = [bytes(data[offsets[k] : offsets[k + 1]]).decode() for lo, hi, data, offsets in text_chunks(column, 4) for k in range(hi - lo)]
        assert got == [t or "" for t in texts]
