import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import tokenizers

from skyledger.llm import byte_pairs as bp
from skyledger.llm import merge_replay
from skyledger.llm import text_arrays as ta

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "b", "'", "s", "re", "ll", " ", "  ", "\t", "\n", "'s", "é", "中", "1", "२", ".", "!!", "ing", "ation", " ", "　", "🙂", "the", "x", "'ve", "'d", "S", "<|endoftext|>"]


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("reference", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def texts():
    dice = random.Random(1)
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    out = ["".join(dice.choice(PARTS) for _ in range(dice.randint(0, 60))) for _ in range(4000)]
    out += ["".join(dice.choices(every, k=40)) for _ in range(1000)]
    return out + ["", "'", "'s", "'re'", "a" * 5000, "ab" * 3000, " " * 3000, "\r\n\r\n x", "!" * 999, "0" * 777, "x" * 70_000]


def encoded(merges, texts, classes, block=1 << 16):
    out = []
    for run in ta.runs(pa.array(texts, pa.large_string()), block):
        ids, begins = bp.encode_run(merges, run, classes)
        out += [ids[i:j].tolist() for i, j in zip(begins, begins[1:])]
    return out


def test_the_pattern_is_that_of_the_vocabulary():
    assert bp.PATTERN == public_tokenizers.PATTERN


def test_ids_equal_those_of_tiktoken(reference, texts):
    merges = bp.Merges.from_ranks(open(RANKS, "rb").read())
    assert encoded(merges, texts, bp.tiktoken_classes()) == [reference.encode_ordinary(t) for t in texts]


def test_ids_equal_those_of_tokenizers(texts):
    merges = bp.Merges.from_json(open(JSON, "rb").read())
    library = tokenizers.Tokenizer.from_file(JSON)
    library.encode_special_tokens = True
    assert encoded(merges, texts, bp.tokenizers_classes()) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_a_merge_that_makes_a_pair_of_a_lower_rank():
    # "abc" is made of "a" and "bc", or "ab" and "c", and ranks below both, so each "bc" is followed at once by "abc"
    tokens = [bytes([b]) for b in range(256)] + [b"abcd", b"abc", b"bc", b"ca", b"cab"]
    ranks = {t: i for i, t in enumerate(tokens)}
    merges = bp.Merges.from_ranks(b"\n".join(base64.b64encode(t) + b" %d" % i for t, i in ranks.items()))
    assert merges.unruly.any()
    library = tiktoken.Encoding("own", pat_str=bp.PATTERN, mergeable_ranks=ranks, special_tokens={})
    dice = random.Random(2)
    texts = ["".join(dice.choice("abcd") for _ in range(dice.randint(1, 30))) for _ in range(3000)] + ["abc" * 400, "bca" * 400, "abcd" * 300]
    assert encoded(merges, texts, bp.tiktoken_classes()) == [library.encode_ordinary(t) for t in texts]


def test_a_vocabulary_without_single_bytes_is_refused():
    with pytest.raises(ValueError):
        bp.Merges([b"a", b"b"], np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))


def test_a_large_vocabulary_file_is_refused(monkeypatch):
    monkeypatch.setattr(merge_replay, "LARGEST_VOCABULARY", 1000)
    with pytest.raises(ValueError):
        merge_replay.read_file(RANKS)


def test_awkward_rows(awkward, reference):
    digest = lambda b: hashlib.sha256(b).hexdigest()
    got = sorted(map(repr, (tuple(r) for r in merge_replay.digests(awkward, RANKS).collect())))
    want = []
    for r in awkward.select("doc_id", "text").collect():
        ids = reference.encode_ordinary(r["text"] or "")
        want.append(repr((r["doc_id"], len(ids), digest(" ".join(map(str, ids)).encode()), digest((r["text"] or "").encode()))))
    assert got == sorted(want)


def test_whole_table_comes_back(table, reference):
    docs = table("documents")
    back = merge_replay.decode(merge_replay.encode(docs, RANKS), RANKS)
    texts = dict(docs.select("doc_id", "text").collect())
    for row in back.collect():
        assert bytes(row["decoded"]).decode() == (texts[row["doc_id"]] or "")
        assert row["ids"] == reference.encode_ordinary(texts[row["doc_id"]] or "")


def test_empty_table(awkward):
    assert merge_replay.digests(awkward.limit(0), RANKS).collect() == []
