import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from skyledger.llm import text_arrays as ta

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab AÉé\n\t", max_size=12)), max_size=8)


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.integers(1, 40))
def test_words_and_shingles_equal_plain_python(texts, run_bytes):
    at, seen = 0, {}
    for run in ta.runs(pa.array(texts, pa.string()), run_bytes):
        assert run.first == at
        at += run.count
        w = ta.words(run, ~ta.WHITE, ta.FOLD)
        hashes, begins = ta.shingles(w.hashes, w.at, 3)
        for i in range(run.count):
            text = texts[run.first + i] or ""
            own = re.findall("[^\x20\x09-\x0d]+", text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
            assert [bytes(run.data[s:e]).decode().lower() for s, e in zip(w.starts[w.at[i] : w.at[i + 1]], w.ends[w.at[i] : w.at[i + 1]])] == [x.lower() for x in own]
            plain = [tuple(own[k : k + 3]) for k in range(max(len(own) - 2, 1))] if own else []
            got = hashes[begins[i] : begins[i + 1]].tolist()
            assert len(got) == len(plain)
            for shingle, h in zip(plain, got):
                assert seen.setdefault(shingle, h) == h
    assert at == len(texts)
    assert len(set(seen.values())) == len(seen)


def test_a_text_longer_than_a_run_is_one_run():
    texts = pa.array(["a" * 5_000_000, None, "b"], pa.large_string())
    found = list(ta.runs(texts, 100))
    assert [r.count for r in found] == [1, 2]
    assert ta.words(found[0], ta.LETTERS).ends.tolist() == [5_000_000]


def test_a_slice_of_a_column_is_read_from_its_own_begin():
    (run,) = ta.runs(pa.array(["one", "two words", "three"]).slice(1, 1))
    assert bytes(run.data) == b"two words"
    assert np.diff(run.offsets).tolist() == [9]
