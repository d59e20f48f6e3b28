import hashlib
from collections import Counter, defaultdict
from itertools import accumulate

import pandas as pd
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from skyledger.llm import alignment, entries
from skyledger.llm.byte_pairs import byte_of_character

VOCABULARY, MODEL = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def sides():
    a = tokenizers.Tokenizer.from_file(VOCABULARY)
    a.encode_special_tokens = True
    of = byte_of_character()
    known = {i: bytes(of[c] for c in t) for t, i in a.get_vocab().items() if t != "<|endoftext|>"}
    b = sentencepiece.SentencePieceProcessor(model_file=MODEL)

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    def tokens(text):
        ids = a.encode(" " + text, add_special_tokens=False).ids
        return [(i, known[i]) for i in ids], [(i, piece(i)) for i in b.encode(text)]

    return tokens


def brute(rows, tokens):
    """n_a, n_b, n_groups, n_links, n_best, count_sum and the groups of every text, over all pairs of token ends."""
    cut, links = [], []
    for _, text in rows:
        groups, own = [], []
        a, b = tokens(text) if text else ([], [])
        want = (" " + (text or "")).encode()
        if b"".join(t for _, t in a) != want or b"".join(t for _, t in b) != want:
            a, b = [], []
        ends = [dict(zip(accumulate(len(t) for _, t in side), (i for i, _ in side))) for side in (a, b)]
        held = [[], []]
        for end in sorted(set(ends[0]) | set(ends[1])):
            for side, ids in zip(ends, held):
                ids += [str(side[end])] if end in side else []
            if end in ends[0] and end in ends[1]:
                groups.append("|".join(map(",".join, held)))
                own.append((ends[0][end], ends[1][end]))
                held = [[], []]
        cut.append((len(a), len(b), len(groups), ";".join(groups)))
        links.append(own)
    counts = Counter(p for own in links for p in own)
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return sorted(
        repr((doc_id, *c[:3], len(own), sum(counts[p] == best[p[1]] for p in own), sum(counts[p] for p in own), c[3]))
        for (doc_id, _), c, own in zip(rows, cut, links)
    )


def result(docs):
    scored = alignment.link_scores(alignment.align(docs, VOCABULARY, MODEL))
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    return sorted(repr(tuple(r)) for r in scored.select(*columns).collect())


def test_whole_table(table, sides):
    docs = table("documents")
    assert result(docs) == brute([tuple(r) for r in docs.select("doc_id", "text").collect()], sides)


def test_awkward_rows(spark, awkward, sides):
    odd = [(8, "▁ is rewritten"), (9, "<|endoftext|> <s> <unk> </s>"), (10, "中文 🙂 é́"), (11, "\x00 \r\n\t x"), (12, " "), (13, "ﬁ ①"), (14, "  a   b ")]
    more = spark.createDataFrame(odd, "doc_id long, text string")
    docs = awkward.unionByName(more, allowMissingColumns=True)
    assert result(docs) == brute([tuple(r) for r in docs.select("doc_id", "text").collect()], sides)


def test_empty_table(awkward):
    assert result(awkward.limit(0)) == []
    assert result(awkward.filter("text is null or text = ''")) == sorted(repr((i, 0, 0, 0, 0, 0, 0, "")) for i in (2, 3, None))


def test_registered_query(spark, table, sides):
    found = entries.queries()["op13_token_alignment"](spark, "/root/testdata/sf0.001")
    rows = {r["doc_id"]: r for r in found.collect()}
    docs = table("documents").select("doc_id", "text").collect()
    assert set(rows) == {r["doc_id"] for r in docs}
    for want in map(eval, brute([tuple(r) for r in docs], sides)):
        got = rows[want[0]]
        digest = hashlib.sha256(want[7].encode()).hexdigest() if want[1] else ""
        assert (got["n_a"], got["n_b"], got["n_groups"], got["n_links"], got["n_best"], got["count_sum"], got["groups_sha256"]) == (*want[1:7], digest)


cuts = st.lists(st.lists(st.integers(1, 4), min_size=1, max_size=12), min_size=1, max_size=4)


@settings(max_examples=200, deadline=None)
@given(cuts, st.randoms(use_true_random=False))
def test_overlaps_are_all_pairs_that_share_a_byte(sizes, dice):
    def side(lists):
        rows, at = [], 0
        for doc, own in enumerate(lists):
            for n in own:
                rows.append((doc, at, at + n, len(rows)))
                at += n
        return pd.DataFrame(rows, columns=["doc", "start", "end", "id"])

    def recut(own):
        left, out = sum(own), []
        while left:
            out.append(dice.randint(1, min(left, 5)))
            left -= out[-1]
        return out

    a, b = side(sizes), side([recut(own) for own in sizes])
    met = alignment.overlaps(a, b)
    got = sorted(zip(met["a"], met["b"]))
    want = sorted((x.id, y.id) for x in a.itertuples() for y in b.itertuples() if x.start < y.end and y.start < x.end)
    assert got == want
