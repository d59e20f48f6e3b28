import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from skyledger.llm import pii_spans

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) * (2 if i % 2 else 1) for i, d in enumerate(reversed(digits))]
    return sum(n // 10 + n % 10 for n in doubled) % 10 == 0


def plain(text):
    """The base rules as they are stated."""
    digits = lambda t: re.sub("[^0-9]", "", t)
    passes = {
        "email": lambda t: True,
        "ip": lambda t: all(int(p) <= 255 for p in t.split(".")),
        "card": lambda t: 16 <= len(digits(t)) <= 19 and luhn(digits(t)),
        "phone": lambda t: 8 <= len(digits(t)) <= 15,
    }
    return {k: [m.span() for m in re.finditer(p, text) if passes[k](m[0])] for k, p in PATTERNS.items()}


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="a1@.-_ +2é4(", max_size=40))
def test_base_spans_equal_the_patterns(text):
    assert pii_spans.base_spans(text) == plain(text)


@pytest.mark.parametrize(
    "text, kind, hidden",
    [
        ("mail john.doe [at] mail (dot) example (dot) com now", "email", "john.doe [at] mail (dot) example (dot) com"),
        ("jane at host dot org ok", "email", "jane at host dot org"),
        ("name @ host.com", "email", "name @ host.com"),
        ("to jоhn@exаmple.com please", "email", "jоhn@exаmple.com"),
        ("john\u200b@mail.com", "email", "john\u200b@mail.com"),
        ("４２４２ " * 3 + "４２４２", "card", "４２４２ " * 3 + "４２４２"),
        ("call plus four nine one five two three four five six seven!", "phone", "plus four nine one five two three four five six seven"),
        ("four two " * 7 + "four two", "card", "four two " * 7 + "four two"),
        ("at 192[.]168[.]1[.]20 or so", "ip", "192[.]168[.]1[.]20"),
        ("at 192 dot 168 dot 1 dot 20", "ip", "192 dot 168 dot 1 dot 20"),
        ("write to ivan at mail dot ru today", "email", "ivan at mail dot ru"),
        ("or name AT host DOT xyz, please", "email", "name AT host DOT xyz"),
        ("pablo arroba correo punto es", "email", "pablo arroba correo punto es"),
        ("ring +49 one seven 6123 4567 now", "phone", "+49 one seven 6123 4567"),
        ("plus one (five five five) one two three four five six seven", "phone", "plus one (five five five) one two three four five six seven"),
        ("host one two seven point zero point zero point one is up", "ip", "one two seven point zero point zero point one"),
        ("ten dots: 10 dot zero dot 0 dot two five", "ip", "10 dot zero dot 0 dot two five"),
        ("card 4242 4242 4242 four two four two", "card", "4242 4242 4242 four two four two"),
    ],
)
def test_disguised_spans_are_found_where_they_stand(text, kind, hidden):
    base, added = pii_spans.find(text)
    assert [text[s:e] for s, e in added[kind]] == [hidden]
    assert base == plain(text)
    assert hidden not in pii_spans.redact(text, added)


@pytest.mark.parametrize("text", ["un un de une et un", "the cat at the dot of noon", "1. 2. 3. 4", "one two", "we met at host.com today", "(at) the end", "café naïve … €"])
def test_prose_is_left_alone(text):
    base, added = pii_spans.find(text)
    assert not any(base.values()) and not any(added.values())


def test_plain_spans_are_not_listed_twice():
    text = "a@b.co and аnna@b.co"
    base, added = pii_spans.find(text)
    assert base["email"] == plain(text)["email"]
    assert [text[s:e] for s, e in added["email"]] == ["аnna@b.co"]


def test_all_documents_equal_the_patterns(table):
    docs = {r["doc_id"]: r["text"] for r in table("documents").collect()}
    for r in pii_spans.personal_data(table("documents")).collect():
        want = plain(docs[r["doc_id"]])
        listed = ",".join(f"{k}:{s}:{e}" for k in want for s, e in want[k])
        assert [r[f"n_{k}"] for k in want] == [len(v) for v in want.values()]
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert set(listed.split(",")) <= set(r["spans"].split(","))


def test_awkward_rows(awkward):
    got = pii_spans.personal_data(awkward).collect()
    assert len(got) == awkward.count()
    assert [(r["spans"], r["redacted"]) for r in got if r["doc_id"] == 2] == [("", None)]
    assert all(r["spans"] == "" for r in got)
    assert pii_spans.personal_data(awkward.limit(0)).count() == 0


@pytest.mark.parametrize(
    "text",
    [
        "we arrived at some point last year, one or two of us at a time",
        "look at the dot on the map, and at this dot in red",
        "am Punkt eins, zwei oder drei; auf den Punkt gebracht",
        "at one point two of the three came back",
        "chapter one point two point three, page four hundred",
        "one plus two (three, four) is nine or seven",
        "llegó a este punto uno dos veces",
        "call 5 or six of the 12 people on 2024-01-05",
        "v1.2.3.4 and section 3.1.4.1.5",
    ],
)
def test_prose_stays_clean(text):
    base, added = pii_spans.find(text)
    assert added == {k: [] for k in pii_spans.KINDS}


def test_recall_on_made_disguises():
    import random

    dice = random.Random(4)
    names = {"0": ["zero", "null"], "1": ["one", "eins"], "2": ["two", "dos"], "3": ["three", "trois"], "4": ["four"], "5": ["five"], "6": ["six"], "7": ["seven"], "8": ["eight"], "9": ["nine"]}
    spelled = lambda ds: " ".join(dice.choice(names[d]) for d in ds)
    words = ["anna", "j.doe", "info", "mail", "post", "acme", "x-ray"]
    made = {"email": [], "ip": [], "card": [], "phone": []}
    for _ in range(200):
        at, dot = dice.choice([" at ", " [at] ", "(at)", " @ "]), dice.choice([" dot ", " [dot] ", "(dot)"])
        made["email"].append(f"{dice.choice(words)}{at}{dice.choice(words[3:])}{dot}{dice.choice(['ru', 'com', 'xyz', 'kr', 'online', 'co.uk'])}")
        made["ip"].append(dice.choice([" dot ", " point "]).join(dice.choice([str, lambda n: spelled(str(n))])(dice.randint(0, 255)) for _ in range(4)))
        digits = "".join(dice.choice("0123456789") for _ in range(15))
        digits += next(d for d in "0123456789" if luhn(digits + d))
        k = dice.randint(1, 16)
        made["card"].append(f"{spelled(digits[:k])} {digits[k:]}".strip())
        number = "".join(dice.choice("0123456789") for _ in range(10))
        k = dice.randint(1, 9)
        made["phone"].append(f"{dice.choice(['+', 'plus '])}{dice.choice('1234')} {number[:k]} {spelled(number[k:])}")
    for kind, texts in made.items():
        whole = lambda t: any(e - s >= len(t) - 2 for spans in pii_spans.find(f"see: {t} ; end") for s, e in spans[kind])
        found = sum(map(whole, texts))
        assert found >= 0.97 * len(texts), kind
