"""Personal data: high-recall candidates, boosted trees, calibrated redaction.

Fixed rules find four kinds of strictly valid spans (``BASE``); these are
always reported. Broad generators propose further, overlapping spans (phone
numbers without a country sign, mail addresses spelled with "at" and "dot",
IPv6 addresses, also shortened ones, bank account and social security numbers). Boosted trees score a candidate
by its format and by the words around it; it is selected if its score
reaches the threshold of its kind. The trees are trained on a labelled table
that :func:`labelled_rows` makes from formats and contexts with a fixed
seed; the thresholds are calibrated on the part of the table that the trees
have not seen, as the lowest score with at least ``PRECISION`` of the rows
above it right. Of overlapping selected candidates the best-scored stays,
and none overlaps a base span. The generators hold no bound of length but
those that the formats have themselves: groups of 2 to 5 digits for a phone
number, up to 34 characters for a bank account.

Null texts are empty: no spans. Rows are independent, so repeated rows get
equal spans; an empty table gives an empty result. Texts are searched whole;
every pattern moves forward by at least what it read, so very long runs of
one character class stay linear.
"""

from __future__ import annotations

import hashlib
import ipaddress
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.frames import typed
from mercato.llm.trees import BoostedTrees
from mercato.llm.words import text_chunks

BASE_KINDS = ["email", "ip", "card", "phone"]
ADDED_KINDS = ["spelled_email", "ipv6", "local_phone", "ssn", "iban"]
KINDS = BASE_KINDS + ADDED_KINDS
PRECISION = 0.995
SEED = 20240501

Span = tuple[int, int, str]  # start, end, kind

# A base match always starts at the beginning of its run of digits, so the
# look-behinds change no match; they stop the search from retrying inside a run.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """The strict spans of all four kinds."""
    out: list[Span] = []
    at, last = text.find("@"), 0
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL_CHARS:
            start -= 1
        end = at + 1
        if start < at and (m := DOMAIN.match(text, at)):
            out.append((start, m.end(), "email"))
            end = last = m.end()
        else:  # no start before this sign can match, and the local part holds no sign
            last = at + 1
        at = text.find("@", end)
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.group().split(".")):
            out.append((*m.span(), "ip"))
    for m in CARD.finditer(text):
        digits = _digits(m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((*m.span(), "card"))
    for m in PHONE.finditer(text):
        if 9 <= len(_digits(m.group())) <= 15:
            out.append((*m.span(), "phone"))
    return out


GENERATORS = {
    "spelled_email": re.compile(
        r"(?<![\w.+-])[A-Za-z0-9._+-]++(?:"
        r"\x20?[\[(](?:at|AT)[\])]\x20?[A-Za-z0-9-]++(?:(?:\x20?[\[(](?:dot|DOT)[\])]\x20?|\x20(?:dot|DOT)\x20|\.)[A-Za-z0-9-]++)++"
        r"|\x20(?:at|AT)\x20[A-Za-z0-9-]++(?:\x20(?:dot|DOT)\x20[A-Za-z0-9-]++)++)"
    ),
    "ipv6": re.compile(r"(?<![\w:])(?=[0-9A-Fa-f]*+:[0-9A-Fa-f]*+:)[0-9A-Fa-f:]++(?!\w)"),
    "local_phone": re.compile(r"(?<![\w.+-])\(?[0-9]{2,5}\)?(?:[\x20./-][0-9]{2,5}){1,4}(?![\w-])"),
    "ssn": re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"),
    "iban": re.compile(r"(?<!\w)[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,4})?(?!\w)"),
}
# fixed values: words that announce a kind
CUES = {
    "spelled_email": {"mail", "email", "e-mail", "contact", "write", "correo", "courriel"},
    "ipv6": {"ip", "ipv6", "host", "server", "address", "addr", "ping"},
    "local_phone": {"phone", "tel", "telephone", "call", "fax", "mobile", "cell", "telefon", "teléfono", "téléphone", "dial"},
    "ssn": {"ssn", "social", "security"},
    "iban": {"iban", "account", "konto", "bank", "compte", "cuenta"},
}
COUNTER_CUES = {"version", "v", "isbn", "page", "pages", "order", "invoice", "item", "ref", "date", "on", "section", "chapter", "score", "price", "usd", "eur", "$", "€", "no", "nr"}
DOMAIN_ENDS = {"com", "org", "net", "edu", "gov", "info", "io", "eu", "uk", "us", "de", "fr", "es", "it", "nl", "at", "ch", "be"}  # fixed values
CONTEXT = 40  # characters before a candidate that are looked at


def iban_valid(s: str) -> bool:
    s = s.replace(" ", "")
    return s.isalnum() and 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def ipv6_valid(s: str) -> bool:
    try:
        ipaddress.IPv6Address(s)
    except ValueError:
        return False
    return True


def features(text: str, start: int, end: int, kind: str) -> list[float]:
    """Format and context of a candidate."""
    s = text[start:end]
    digits = _digits(s)
    groups = re.split(r"[^0-9A-Za-z]+", s.strip("()"))
    before = re.findall(r"[^\W\d_]+(?:-[^\W\d_]+)?|[$€]", text[max(0, start - CONTEXT) : start].lower())[-4:]
    lead = text[start - 1] if start else " "
    tail = text[end] if end < len(text) else " "
    sizes = [len(g) for g in groups] or [0]
    return [
        KINDS.index(kind),
        len(s),
        len(digits),
        sum(c.isalpha() for c in s),
        len(groups),
        sizes[0],
        sizes[-1],
        max(sizes),
        float(s.startswith("(")),
        float("." in s),
        float("-" in s),
        float("/" in s),
        float(" " in s),
        len(set(digits)),
        float(bool(re.fullmatch(r"(?:19|20)?[0-9]{2}[./-][0-9]{1,2}[./-](?:19|20)?[0-9]{2}", s))),
        float(digits[:1] == "0"),
        float(kind == "iban" and iban_valid(s)),
        float(kind == "ssn" and s[:3] not in ("000", "666") and s[:1] != "9" and s[4:6] != "00" and s[7:] != "0000"),
        float(kind == "ipv6" and ipv6_valid(s)),
        float(kind == "spelled_email" and groups[-1].lower() in DOMAIN_ENDS),
        float("(" in s or "[" in s),
        float(any(w in CUES[kind] for w in before)),
        float(any(w in COUNTER_CUES for w in before[-2:])),
        float(lead in ' \n\t("'),
        float(tail in " \n\t.,;:)\"'!?"),
    ]


def candidates(text: str) -> list[Span]:
    out = []
    for kind, pattern in GENERATORS.items():
        for m in pattern.finditer(text):
            s, e = m.span()
            if kind == "ipv6" and text[e - 1] == ":" and text[e - 2] != ":":
                e -= 1  # a colon that ends the phrase
            out.append((s, e, kind))
    return out


def labelled_rows(n: int = 6000, seed: int = SEED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, labels and kinds of ``n`` made-up candidates in context.

    Each row is a span of one of the formats below, true or a look-alike,
    after a cue, a counter-cue or neutral words. A number in a phone format
    is none after a counter-cue ("order 555-123-4567")."""
    rng = random.Random(seed)
    num = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    word = lambda: "".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(2, 9)))

    def iban(valid: bool) -> str:
        body, land = num(18), rng.choice(["DE", "FR", "ES", "GB", "NL"])
        rest = 98 - int("".join(str(int(c, 36)) for c in body + land + "00")) % 97
        s = f"{land}{rest if valid else (rest + rng.randint(1, 96)) % 97:02d}{body}"
        return s if rng.random() < 0.5 else " ".join(s[i : i + 4] for i in range(0, len(s), 4))

    def phone() -> str:
        sep = rng.choice([" ", "-", "."])
        return rng.choice([f"({num(3)}) {num(3)}-{num(4)}", f"{num(3)}{sep}{num(3)}{sep}{num(4)}", f"0{num(3)}{sep}{num(3)}{sep}{num(4)}", f"0{num(1)} {num(2)} {num(2)} {num(2)} {num(2)}"])

    def mail(at: str) -> str:
        dot = rng.choice([".", " dot "] if at == " at " else [".", " (dot) ", "[dot]"])
        return f"{word()}{rng.choice(['.', '_', ''])}{word()}{at}{word()}{dot}{rng.choice(sorted(DOMAIN_ENDS))}"

    def ipv6() -> str:
        part = lambda k: ":".join(f"{rng.randrange(1, 65536):x}" for _ in range(k))
        return rng.choice([part(8), f"2001:{part(rng.randint(1, 3))}::{part(rng.randint(1, 2))}", f"fe80::{part(rng.randint(1, 4))}"])

    def hexes(k: int) -> str:
        return "".join(rng.choice("abcdefABCDEF") for _ in range(k))

    true = {
        "spelled_email": lambda: mail(rng.choice([" (at) ", "[at]", " [AT] ", "(at)", " at "])),
        "ipv6": ipv6,
        "local_phone": phone,
        "ssn": lambda: f"{rng.randint(1, 665):03d}-{rng.randint(1, 99):02d}-{rng.randint(1, 9999):04d}",
        "iban": lambda: iban(True),
    }
    false = {
        "spelled_email": lambda: rng.choice([f"{word()} (at) {word()}.{num(1)}", f"{word()} at {word()} dot {word()}{word()}", f"{word()} at {num(2)} dot {num(2)}"]),
        "ipv6": lambda: rng.choice([f"{num(2)}:{num(2)}:{num(2)}", f"{num(1)}:{num(2)}:{num(2)}:{num(2)}", "::", f"::{hexes(4)}", f"{hexes(3)}::{hexes(4)}", "::1"]),
        "local_phone": lambda: rng.choice([f"20{num(2)}-0{rng.randint(1, 9)}-{rng.randint(10, 28)}", f"{num(2)}.{num(2)}.20{num(2)}", f"{num(2)}/{num(2)}", f"{num(3)}-{num(3)}", f"{num(2)}.{num(2)}", f"{num(4)}-{num(4)}", f"{num(3)} {num(3)}"]),
        "ssn": lambda: rng.choice([f"000-{num(2)}-{num(4)}", f"9{num(2)}-{num(2)}-{num(4)}", f"{num(3)}-00-{num(4)}"]),
        "iban": lambda: iban(False),
    }
    x, y, kinds = [], [], []
    while len(y) < n:
        kind, label = rng.choice(ADDED_KINDS), rng.random() < 0.5
        cue = rng.random()
        lead = [word() for _ in range(rng.randint(0, 4))]
        if cue < (0.6 if label else 0.05):
            lead.append(rng.choice(sorted(CUES[kind])))
        elif cue > (0.98 if label else 0.5):
            lead.append(rng.choice(sorted(COUNTER_CUES)))
        span = (true if label else false)[kind]()
        if kind == "local_phone" and lead and lead[-1] in COUNTER_CUES:
            lead, span = (lead[:-1], span) if label else (lead, rng.choice([span, phone()]))
        text = " ".join([*lead, span + rng.choice(["", "", ".", ",", ":", ";"]), word()])
        for a, b, k in candidates(text):
            if k == kind:
                x.append(features(text, a, b, k))
                y.append(float(label))
                kinds.append(kind)
                break
    return np.array(x, float), np.array(y), np.array(kinds)


class Model:
    """Boosted trees and a threshold per kind."""

    def __init__(self, trees: BoostedTrees, thresholds: dict[str, float]):
        self.trees, self.thresholds = trees, thresholds

    def select(self, text: str, base: list[Span]) -> list[Span]:
        """The candidates to add to ``base``: no two spans overlap that are not both base."""
        found = [c for c in candidates(text) if not any(c[0] < e and s < c[1] for s, e, _ in base)]
        if not found:
            return []
        scores = self.trees.predict(np.array([features(text, *c) for c in found], float))
        out: list[Span] = []
        for score, (s, e, kind) in sorted(zip(scores.tolist(), found, strict=True), key=lambda p: (-p[0], p[1])):
            if score >= self.thresholds[kind] and not any(s < b and a < e for a, b, _ in out):
                out.append((s, e, kind))
        return out


@lru_cache(maxsize=1)
def train(n: int = 6000) -> Model:
    """Trees on two thirds of the labelled table, thresholds on the rest."""
    x, y, kinds = labelled_rows(n)
    held = np.arange(len(y)) % 3 == 2
    trees = BoostedTrees().fit(x[~held], y[~held])
    score, thresholds = trees.predict(x[held]), {}
    for kind in ADDED_KINDS:
        rows = kinds[held] == kind
        order = np.argsort(-score[rows], kind="stable")
        s, right = score[rows][order], y[held][rows][order]
        good = np.cumsum(right) >= PRECISION * np.arange(1, len(s) + 1)
        good &= np.append(s[1:] < s[:-1], True)  # equal scores are selected together
        thresholds[kind] = max(0.5, float(s[np.flatnonzero(good)[-1]])) if good.any() else 2.0
    return Model(trees, thresholds)


def _may_hold(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts with an @, at least four digits, a bracket, a colon pair, or "dot" between spaces."""

    def count(hit: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(hit)])
        return total[offsets[1:]] - total[offsets[:-1]]

    digits = count((buf >= 48) & (buf <= 57))
    brackets = count((buf == 40) | (buf == 91))
    colons = count(buf == 58)
    dot = np.zeros(len(buf), bool)
    low = buf | 32
    dot[2:-2] = (buf[:-4] == 32) & (low[1:-3] == 100) & (low[2:-2] == 111) & (low[3:-1] == 116) & (buf[4:] == 32)
    return (digits >= 4) | (count(buf == 64) > 0) | (brackets > 0) | (colons > 1) | (count(dot) > 0)


def digest(spans: list[Span]) -> str:
    order = sorted((s, KINDS.index(k), e, k) for s, e, k in spans)
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in order)


SPAN_SCHEMA = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, redacted string"


def _scan(model: Model, schema, redact: bool, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = hashlib.sha256(b"").hexdigest()
        for batch in batches:
            column = batch.column(text_at)
            counts = {k: np.zeros(len(column), np.int64) for k in BASE_KINDS}
            shas, spans, clean = [nothing] * len(column), [""] * len(column), {}
            for lo, _, buf, offsets in text_chunks(column):
                for i in (lo + np.flatnonzero(_may_hold(buf, offsets))).tolist():
                    text = column[i].as_py()
                    base = base_spans(text)
                    every = base + model.select(text, base)
                    if not every:
                        continue
                    for _, _, k in base:
                        counts[k][i] += 1
                    shas[i] = hashlib.sha256(digest(base).encode()).hexdigest()
                    spans[i] = digest(every)
                    if redact:
                        clean[i] = redacted(text, every)
            found = [pa.array(counts[k]) for k in BASE_KINDS] + [pa.array(shas), pa.array(spans)]
            texts = pa.nulls(len(column), pa.string())
            if redact:
                changed = np.zeros(len(column), bool)
                changed[list(clean)] = True
                new = pa.array([clean.get(i) for i in range(len(column))], pa.string()) if clean else texts
                texts = pc.if_else(pa.array(changed), new, column.cast(pa.string()))
            kept = [batch.column(i) for i in range(batch.num_columns) if i != text_at]
            yield pa.RecordBatch.from_arrays([*kept, *found, texts], names=schema.fieldNames())

    return run


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each run of overlapping spans replaced by its first kind."""
    out, at = [], 0
    for s, e, k in sorted(spans):
        if s >= at:
            out += [text[at:s], f"[{k.upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def find(docs: DataFrame, redact: bool = False) -> DataFrame:
    """``doc_id``, base counts and spans of every row, and with ``redact`` the cleaned text."""
    schema = typed("doc_id long, " + SPAN_SCHEMA)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    out = rows.mapInArrow(_scan(train(), schema, redact, 1), schema)
    return out if redact else out.drop("redacted")


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with the spans replaced in ``text``; the other columns are unchanged
    but for ``n_chars``, which follows the text where there is such a column."""
    other = [c for c in docs.columns if c != "text"]
    packed = docs.select(F.struct(*other).alias("__row"), F.col("text").cast("string").alias("text"))
    schema = typed(f"__row {packed.schema['__row'].dataType.simpleString()}, {SPAN_SCHEMA}")
    done = packed.mapInArrow(_scan(train(), schema, True, 1), schema)
    columns = {c: F.col("__row").getField(c) for c in other} | {"text": F.col("redacted")}
    if "n_chars" in columns:
        columns["n_chars"] = F.char_length("redacted").cast(docs.schema["n_chars"].dataType)
    return done.select(*[columns[c].alias(c) for c in docs.columns])
