import re
from collections import Counter

import pytest

from skyledger.llm.repetition import NGRAM_SHARES, judge


def plain(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    chars = sum(map(len, words))

    def covered(n, later_only):
        seen, out = Counter(), set()
        total = Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
        for i in range(len(words) - n + 1):
            gram = tuple(words[i : i + n])
            seen[gram] += 1
            if total[gram] > 1 and (not later_only or seen[gram] > 1):
                out.update(range(i, i + n))
        return out

    lines, dup, dup_chars = set(), 0, 0
    for line in text.split("\n"):
        own = re.findall("[^\x20\x09-\x0d]+", line)
        if own and line in lines:
            dup, dup_chars = dup + 1, dup_chars + sum(map(len, own))
        if own:
            lines.add(line)
    repeat = len(covered(3, False))
    out = {"n_words": len(words), "word_chars": chars, "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_dup_lines": dup, "n_repeat_words": repeat}
    out["dup_line_share"] = dup_chars / max(chars, 1)
    for n in NGRAM_SHARES:
        out[f"dup_{n}gram_share"] = sum(len(words[i]) for i in covered(n, True)) / max(chars, 1)
    out["base_failed"] = len(words) < 50 or 100 * repeat > 50 * len(words)
    out["kept"] = not out["base_failed"] and out["dup_line_share"] <= 0.25 and all(out[f"dup_{n}gram_share"] <= s for n, s in NGRAM_SHARES.items())
    return out


def test_documents_equal_plain_python(table):
    texts = {r["doc_id"]: r["text"] for r in table("documents").collect()}
    got = judge(table("documents")).collect()
    assert len(got) == len(texts)
    for r in got:
        want = plain(texts[r["doc_id"]])
        assert {k: pytest.approx(v) for k, v in want.items()} == {k: r[k] for k in want}


@pytest.mark.parametrize("text, kept", [("\n".join(f"line {i} has word{i}a and word{i}b" for i in range(20)), True), ("\n".join(["a line that is said again and again"] * 20), False)])
def test_verdict(frame, text, kept):
    assert judge(frame([(1, text)], "doc_id long, text string")).first()["kept"] is kept


def test_awkward_rows(awkward):
    got = judge(awkward).collect()
    rows = awkward.select("doc_id", "text").collect()
    assert [r["doc_id"] for r in got] == [r["doc_id"] for r in rows]
    for r, row in zip(got, rows):
        if row["text"] is None or len(row["text"]) < 1_000:
            want = plain(row["text"])
            assert {k: r[k] for k in want} == want
    assert judge(awkward.limit(0)).count() == 0
