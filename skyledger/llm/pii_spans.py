"""Personal data in text, plain or disguised, with offsets into the text as it stands.

A text is rewritten by transducers: characters that only look like ASCII become ASCII and invisible ones go, disguised
at and dot signs become signs, spelled digits become digits. Each keeps, for every character it writes, the stretch of
characters it came from, so what is found in the rewritten text is reported where it stands in the source.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def emails(text: str) -> list[Span]:
    """Leftmost addresses: the longest stretch of local characters before an @ that a dotted domain follows."""
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            found.append((start, m.end()))
        end = m.end() if m else at + 1
        at = text.find("@", end)
    return found


def ips(text: str) -> list[Span]:
    """Four numbers joined by dots, none above 255."""
    return [m.span() for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def cards(text: str) -> list[Span]:
    """Runs of 16 to 19 digits, single blanks or hyphens between them, with a right check digit."""
    out = []
    for m in _CARD.finditer(text):
        if 16 <= m.end() - m.start() <= 40:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and _luhn(digits):
                out.append(m.span())
    return out


def phones(text: str) -> list[Span]:
    """A plus sign and 8 to 15 digits with blanks, brackets, dots and hyphens between them."""
    return [m.span() for m in _PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]


FINDERS: dict[str, Callable[[str], list[Span]]] = {"email": emails, "ip": ips, "card": cards, "phone": phones}


def base_spans(text: str) -> dict[str, list[Span]]:
    """Spans of each kind that stand in the text undisguised."""
    has_digit = _ANY_DIGIT.search(text) is not None
    return {
        "email": emails(text) if "@" in text else [],
        "ip": ips(text) if has_digit and "." in text else [],
        "card": cards(text) if has_digit else [],
        "phone": phones(text) if has_digit and "+" in text else [],
    }


_ANY_DIGIT = re.compile("[0-9]")

# Letters of other scripts that are drawn like a Latin one.
LOOK_ALIKES = {
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "У": "Y", "І": "I", "Ѕ": "S", "Ј": "J",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j", "ԁ": "d", "һ": "h", "ԛ": "q", "ԝ": "w",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ο": "o", "ν": "v", "ι": "i", "α": "a", "ρ": "p", "ı": "i", "ɡ": "g", "ⅼ": "l",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", "․": ".", "。": ".", "｡": ".", "·": ".",
    "\u00a0": " ", "\u2002": " ", "\u2003": " ", "\u2009": " ", "\u202f": " ", "\u3000": " ",
}
# Characters without a shape of their own.
INVISIBLE = frozenset("\u00ad\u200b\u200c\u200d\u200e\u200f\u2060\u2061\u2062\u2063\ufeff")
# The digits by name in the languages of the texts.
SPELLED = {
    "0": "zero oh null cero zéro", "1": "one eins uno un une", "2": "two zwei zwo dos deux", "3": "three drei tres trois", "4": "four vier cuatro quatre",
    "5": "five fünf cinco cinq", "6": "six sechs seis", "7": "seven sieben siete sept", "8": "eight acht ocho huit", "9": "nine neun nueve neuf",
}
# Last labels of domain names that follow a dot spelled by a word that prose has too ("at some point last").
LAST_LABELS = frozenset("com org net edu gov mil int info biz io co ai app dev me eu uk us ca au de fr es it nl be ch at pl se no dk fi pt ie mx br ar jp cn in example test".split())
# Words before a spelled dot that make it a plain word ("look at the dot on").
NO_HOSTS = frozenset("the a an this that each every one some any no which its his her their our my your".split())
DIGIT_OF = {name: digit for digit, names in SPELLED.items() for name in names.split()}

_NAMED = "|".join(sorted(DIGIT_OF, key=len, reverse=True))
_GAP = r"(?:[\x20\t]*[-,.()][\x20\t]*|[\x20\t]+)"
#: A run of at least this many named digits is a number. Fewer are plain words, unless the run is a phone number with its
#: plus sign or has the digits of a card, written ones counted.
LEAST_NAMED = 3
_DIGITS = re.compile(rf"(?<![^\W_])(?:(?:plus|más|mas){_GAP})?(?:\+[\x20]?)?(?:{_NAMED}|[0-9]+)(?:{_GAP}(?:{_NAMED}|[0-9]+))+(?![^\W_])", re.I)
_A_DIGIT = re.compile(rf"({_NAMED})|([0-9]+)", re.I)
_PLUS = re.compile(r"(?:plus|más|mas|\+)", re.I)
_OPEN, _SHUT = r"[\[({<]", r"[\])}>]"
_AT_NAMES, _DOT_NAMES = r"at|arroba|arobase|chez|klammeraffe|@", r"dot|punkt|punto|point|period|\."
_SIGNS = re.compile(
    rf"[\x20\t]*{_OPEN}[\x20\t]*(?:(?P<at>{_AT_NAMES})|(?P<dot>{_DOT_NAMES}))[\x20\t]*{_SHUT}[\x20\t]*|[\x20\t]*[_*-](?P<at2>at)[_*-][\x20\t]*|[\x20\t]*[_*-](?P<dot2>dot)[_*-][\x20\t]*", re.I
)
#: name at host dot org, the signs as plain words or spaced, which only together make an address.
_SPOKEN = re.compile(
    r"(?<![A-Za-z0-9._%+@-])[A-Za-z0-9_%+-]+(?:(?:\.|\x20(?:dot|punkt|punto|point)\x20)[A-Za-z0-9_%+-]+){0,4}(?P<at>\x20?@\x20?|\x20(?:at|arroba|arobase)\x20)"
    r"[A-Za-z0-9-]+(?P<rest>(?:(?:\.|\x20\.\x20|\x20(?:dot|punkt|punto|point)\x20)[A-Za-z0-9-]+)+)(?![A-Za-z0-9-])", re.I
)
_SPOKEN_DOT = re.compile(r"\x20(?:dot|punkt|punto|point|\.)\x20", re.I)
_OCTET = rf"(?:(?:{_NAMED})(?:[\x20\t]+(?:{_NAMED})){{0,2}}|[0-9]{{1,3}})"
_STOP = r"(?:[\x20\t]*\.[\x20\t]*|\x20(?:dot|punkt|punto|point)\x20)"
_NAMED_IP = re.compile(rf"(?<![^\W_])(?<![0-9.]){_OCTET}(?:{_STOP}{_OCTET}){{3}}(?![^\W_])(?!\.[0-9])", re.I)
_IP_PARTS = re.compile(rf"(?P<stop>{_STOP})|(?P<named>{_NAMED})|(?P<gap>[\x20\t]+)", re.I)
_HOST = re.compile("[A-Za-z0-9-]+")
# What a text must hold, in lower case, for any of the above to apply.
_FOREIGN = re.compile("[^\x00-\x7fÀ-İĲ-ɏ]")
_TRACES = ("dot", "punkt", "punto", "point", "period", "arroba", "arobase", "klammeraffe", "@ ", " @", "at_", "at-", "at*")
_NAMED_RUN = re.compile(rf"(?:{_NAMED}){_GAP}(?:(?:{_NAMED}|[0-9]+){_GAP})*?(?:{_NAMED})(?![^\W_])")


_NAMED_DIGIT = re.compile(rf"(?<![^\W_])(?:{_NAMED})(?![^\W_])")
_MANY_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9]){6}")


def _disguised(text: str) -> bool:
    """Whether a rewriting rule may apply to the text."""
    if not text.isascii() and _FOREIGN.search(text):
        return True
    low = text.lower()
    if any(t in low for t in _TRACES) or _NAMED_RUN.search(low):
        return True
    if _NAMED_DIGIT.search(low) and ("+" in low or "plus" in low or _MANY_DIGITS.search(low)):
        return True
    return any(c in text for c in "[({<") and _SIGNS.search(text) is not None


@cache
def ascii_of(c: str) -> str:
    """The ASCII character that c stands for, empty for one without shape, c itself if there is none."""
    if c in INVISIBLE:
        return ""
    if c in LOOK_ALIKES:
        return LOOK_ALIKES[c]
    digit = unicodedata.decimal(c, None)
    if digit is not None:
        return str(digit)
    plain = unicodedata.normalize("NFKC", c)
    return plain if len(plain) == 1 and plain.isascii() else c


class Rewritten:
    """A text and, for each of its characters, the stretch of the source that it stands for."""

    def __init__(self, text: str):
        self.text = text
        self.starts: list[int] | range = range(len(text))
        self.ends: list[int] | range = range(1, len(text) + 1)

    def apply(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace stretches, given in order and apart from each other."""
        if not edits:
            return
        text, starts, ends, at = [], [], [], 0
        for begin, end, new in [*edits, (len(self.text), len(self.text), "")]:
            text.append(self.text[at:begin])
            starts.extend(self.starts[at:begin])
            ends.extend(self.ends[at:begin])
            text.append(new)
            for k in range(len(new)):
                # all characters of a replacement stand for the whole stretch, but the first begins and the last ends it
                starts.append(self.starts[begin])
                ends.append(self.ends[end - 1])
            at = end
        self.text, self.starts, self.ends = "".join(text), starts, ends

    def source(self, span: Span) -> Span:
        return self.starts[span[0]], self.ends[span[1] - 1]


def _digit_edits(text: str) -> list[tuple[int, int, str]]:
    """Every named digit of a number, with the gaps between named digits."""
    edits = []
    for m in _DIGITS.finditer(text):
        parts = list(_A_DIGIT.finditer(text, m.start(), m.end()))
        named = sum(p[1] is not None for p in parts)
        plus = _PLUS.match(text, m.start(), m.end())
        digits = sum(1 if p[1] else len(p[0]) for p in parts)
        if named < LEAST_NAMED and not (named and ((plus and 8 <= digits <= 15) or 16 <= digits <= 19)):
            continue
        if plus and plus[0] != "+":
            edits.append((plus.start(), parts[0].start(), "+"))
        for k, p in enumerate(parts):
            named_next = k + 1 < len(parts) and (p[1] or parts[k + 1][1])
            end = parts[k + 1].start() if named_next else p.end()
            if p[1] or end > p.end():
                if p[1]:
                    edits.append((p.start(), end, DIGIT_OF[p[1].lower()]))
                else:
                    edits.append((p.end(), end, ""))
    return edits


def _ip_edits(text: str) -> list[tuple[int, int, str]]:
    """Named digits and spelled dots of four numbers joined by dots, at least one of them disguised."""
    edits = []
    for m in _NAMED_IP.finditer(text):
        for p in _IP_PARTS.finditer(text, m.start(), m.end()):
            new = "." if p["stop"] else DIGIT_OF[p["named"].lower()] if p["named"] else ""
            if new != p[0]:
                edits.append((p.start(), p.end(), new))
    return edits


def _is_address(m: re.Match, found: list, out: Rewritten) -> bool:
    """Whether name, at, host, dot and label are an address and no prose.

    A sign at is disguised only together with a dot, since a plain "at" before a written domain is prose. After a spelled
    "dot" any label of letters ends an address, unless the host is a word like "the"; the other words for a dot are common
    in prose and must lead to a known last label.
    """
    if m["at"].strip() == "@":
        return True
    labels = _SPOKEN_DOT.split(m["rest"])
    last, host = labels[-1].rpartition(".")[2], _HOST.match(m.string, m.end("at"))[0].lower()
    if host in NO_HOSTS:
        return False
    if any(out.text[k] == "." and out.ends[k] - out.starts[k] > 1 for k in range(m.start("rest"), m.end("rest"))):
        return True  # a dot that stood in brackets
    if len(found) < 2:
        return False
    dots = {d[0].strip().lower() for d in _SPOKEN_DOT.finditer(m["rest"])}
    return last.lower() in LAST_LABELS or (dots <= {"dot", "."} and re.fullmatch("[A-Za-z]{2,}", last) is not None)


def rewrite(text: str) -> Rewritten | None:
    """The text with its disguises undone; None if it has none."""
    if not _disguised(text):
        return None
    out = Rewritten(text)
    out.apply([(i, i + 1, a) for i, c in enumerate(text) if c > "\x7f" and (a := ascii_of(c)) != c])
    out.apply([(m.start(), m.end(), "@" if m["at"] or m["at2"] else ".") for m in _SIGNS.finditer(out.text)])
    edits = []
    for m in _SPOKEN.finditer(out.text):
        found = [(d.start(), d.end(), ".") for d in _SPOKEN_DOT.finditer(out.text, m.start(), m.start("at"))]
        found.append((m.start("at"), m.end("at"), "@"))
        found += [(d.start(), d.end(), ".") for d in _SPOKEN_DOT.finditer(out.text, m.start("rest"), m.end())]
        if _is_address(m, found, out):
            edits += found
    out.apply(edits)
    out.apply(_ip_edits(out.text))
    out.apply(_digit_edits(out.text))
    return out if out.text != text else None


def find(text: str) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
    """Spans of each kind in code points: those that stand plainly, and those that only the rewritten text shows.

    A disguised span that a plain one of its kind covers is not listed again.
    """
    base = base_spans(text)
    added: dict[str, list[Span]] = {k: [] for k in KINDS}
    hidden = rewrite(text)
    if hidden is not None:
        for kind, spans in base_spans(hidden.text).items():
            known = iter(sorted(base[kind]))
            plain = next(known, None)
            for span in map(hidden.source, spans):
                while plain is not None and plain[1] < span[1]:
                    plain = next(known, None)
                if plain is None or not (plain[0] <= span[0] and span[1] <= plain[1]):
                    added[kind].append(span)
    return base, added


def redact(text: str, spans: dict[str, list[Span]]) -> str:
    """The text with every span replaced by the name of its kind; overlapping spans become one, named by the first."""
    out, at = [], 0
    for start, end, kind in sorted((s, e, k) for k in spans for s, e in spans[k]):
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


def listed(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k in KINDS for s, e in sorted(spans[k]))


SCHEMA = "doc_id {id}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long, redacted string"


def _scanner(with_text: bool):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[str, list] = {k: [] for k in ("base_sha256", "spans", "redacted")}
            counts: dict[str, list[int]] = {k: [] for k in (*KINDS, "added")}
            for text in batch.column("text").to_pylist():
                base, added = find(text or "")
                every = {k: sorted({*base[k], *added[k]}) for k in KINDS}
                for k in KINDS:
                    counts[k].append(len(base[k]))
                counts["added"].append(sum(map(len, every.values())) - sum(map(len, base.values())))
                rows["base_sha256"].append(hashlib.sha256(listed(base).encode()).hexdigest())
                rows["spans"].append(listed(every))
                rows["redacted"].append(redact(text, every) if with_text and text is not None else None)
            columns = [batch.column("doc_id"), *(pa.array(counts[k], pa.int64()) for k in KINDS), pa.array(rows["base_sha256"]), pa.array(rows["spans"])]
            names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added", "redacted"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts["added"], pa.int64()), pa.array(rows["redacted"], pa.string())], names=names)

    return scan


def personal_data(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """Personal data of every row of docs (doc_id, text).

    n_email, n_ip, n_card and n_phone count plain spans, and base_sha256 is the digest of their list; spans lists all,
    disguised ones too, as kind:start:end in code points, end exclusive, by kind and start; n_added counts the disguised
    ones. redacted is the text with all spans replaced by their kind, null if ``with_text`` is false. Null and empty texts
    have no spans. Each row is scanned by itself; other columns are not read.
    """
    own = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return own.mapInArrow(_scanner(with_text), SCHEMA.format(id=own.schema["doc_id"].dataType.simpleString()))
