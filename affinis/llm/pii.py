"""Personal data in texts, also where it is disguised, with spans in the source text.

The base detectors look at the text as it is. Disguised data are found behind a
chain of transducers: one undoes homoglyphs and invisible characters, one reads
spelled digits, one reads "at" and "dot". Each keeps, for every character it
writes, the stretch of source it came from, so what the same detectors find in
the normalised text is mapped back to the source. Such a span is added unless a
base span of its kind holds it already; base spans always stay.

All scans are linear in the text: detectors start from the one character that
none of their matches can lack, and runs are entered at their first character.

Defined cases: a NULL or empty text has no spans; a span added by the method may
overlap base spans; equal rows give equal results; an empty table gives no rows;
all columns are kept, and ``pii`` and ``text`` replace columns of that name.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from string import ascii_letters

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
SPANS = "array<struct<kind:string,start:int,end:int,base:boolean>>"

# Letters that look like Latin ones, each with the letter it stands for.
CYRILLIC = "аА бВ еЕ кК мМ нН оО рР сС тТ уУ хХ іІ јЈ ѕЅ һҺ ԁԀ ԛԚ ԝԜ"
CYRILLIC_AS = "aA bB eE kK mM hH oO pP cC tT yY xX iI jJ sS hH dD qQ wW"
GREEK = "αΑ Β εΕ Ζ Η ιΙ κΚ Μ νΝ οΟ ρΡ τΤ υΥ χΧ"
GREEK_AS = "aA B eE Z H iI kK M vN oO pP tT uY xX"
INVISIBLE = "­​‌‍⁠﻿"
DIGITS = ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine")

Found = list[tuple[str, int, int]]


class Tape:
    """A text with the source stretch of each of its characters."""

    def __init__(self, text: str, starts: list[int] | range, ends: list[int] | range):
        self.text, self.starts, self.ends = text, starts, ends

    @classmethod
    def of(cls, text: str) -> Tape:
        return cls(text, range(len(text)), range(1, len(text) + 1))

    def rewrite(self, edits: list[tuple[int, int, str]]) -> Tape:
        """Replaces stretches, given in order; what is written for one maps to all of its source."""
        if not edits:
            return self
        text, starts, ends, at = [], [], [], 0
        for a, b, new in edits:
            if a < at:
                continue
            text += [self.text[at:a], new]
            starts += self.starts[at:a]
            ends += self.ends[at:a]
            starts += [self.starts[a]] * len(new)
            ends += [self.ends[b - 1]] * len(new)
            at = b
        text.append(self.text[at:])
        starts += self.starts[at:]
        ends += self.ends[at:]
        return Tape("".join(text), starts, ends)


def _homoglyphs() -> dict[str, str]:
    """Non-ASCII characters that are ASCII under compatibility normalisation or decimal digits, the letters above, and invisible ones."""
    table = {}
    for code in (*range(0x80, 0x3000), *range(0xFE00, 0x10000), *range(0x1D400, 0x1D800)):
        char = chr(code)
        plain = unicodedata.normalize("NFKC", char)
        if len(plain) == 1 and " " < plain <= "~":
            table[char] = plain
        elif unicodedata.decimal(char, None) is not None:
            table[char] = str(unicodedata.decimal(char))
    for letters, plain in ((CYRILLIC, CYRILLIC_AS), (GREEK, GREEK_AS)):
        table |= {a: b for a, b in zip(letters, plain) if a != " "}
    return table | dict.fromkeys(INVISIBLE, "")


def undo_homoglyphs() -> Callable[[Tape], Tape]:
    table = _homoglyphs()

    def run(tape: Tape) -> Tape:
        # one look at the characters in use: a class of this many is slow to match at each place
        if tape.text.isascii() or table.keys().isdisjoint(set(tape.text)):
            return tape
        return tape.rewrite([(at, at + 1, table[char]) for at, char in enumerate(tape.text) if char in table])

    return run


def read_digits() -> Callable[[Tape], Tape]:
    """Rewrites runs of at least seven spelled or written digits, of which four are spelled."""
    value = {w: str(d) for d, w in enumerate(DIGITS)} | {"oh": "0", "dot": ".", "point": ".", "dash": "-", "hyphen": "-", "plus": "+"}
    words = "|".join(sorted(value, key=len, reverse=True))
    run_of = re.compile(rf"(?<![A-Za-z0-9])(?:(?:{words}|[0-9]{{1,4}})(?:[ \t,-]{{1,2}}|(?![A-Za-z0-9]))){{7,}}", re.I)
    piece = re.compile(rf"({words})|([0-9]+)|([ \t,-]+)", re.I)
    spelled = set(DIGITS)

    def run(tape: Tape) -> Tape:
        if spelled.isdisjoint(tape.text.lower().replace("-", " ").replace(",", " ").split()):
            return tape
        edits = []
        for m in run_of.finditer(tape.text):
            parts = [(p.start(), p.end(), p.lastindex, p[0].lower()) for p in piece.finditer(tape.text, m.start(), m.end())]
            if sum(p[2] == 1 and p[3] in spelled for p in parts) < 4:
                continue
            while parts and parts[-1][2] == 3:
                parts.pop()
            edits += [(a, b, value[s]) if kind == 1 else (a, b, "") for a, b, kind, s in parts if kind != 2]
        return tape.rewrite(edits)

    return run


def read_at_dot() -> Callable[[Tape], Tape]:
    """Rewrites bracketed "at" and "dot", and bare ones where a host with spelled dots follows."""
    bracketed = re.compile(r"\s{0,2}[\[({<]\s{0,2}(at|dot|@|\.)\s{0,2}[\])}>]\s{0,2}", re.I)
    host = re.compile(r"(?: at |@)(?!dot )[A-Za-z0-9-]++(?:(?: dot |\.)(?!dot\b)[A-Za-z0-9-]++)++", re.I)
    bare = re.compile(r" at | dot ", re.I)
    local = frozenset(ascii_letters + "0123456789._%+-")

    def name_before(text: str, end: int, floor: int) -> int:
        """Where the local part that ends at ``end`` starts; ``floor`` is as far as another one has been read."""
        while end > floor and text[end - 1] in local:
            end -= 1
        return end

    def run(tape: Tape) -> Tape:
        text = tape.text
        if "(" in text or "[" in text or "{" in text or "<" in text:
            signs = {"at": "@", "dot": "."}
            tape = tape.rewrite([(m.start(), m.end(), signs.get(m[1].lower(), m[1])) for m in bracketed.finditer(text)])
            text = tape.text
        if " dot " not in text.lower():
            return tape
        edits, floor = [], 0
        for m in host.finditer(text):
            if " dot " not in m[0].lower():
                continue
            edits += [(p.start(), p.end(), "@" if "a" in p[0].lower() else ".") for p in bare.finditer(text, m.start(), m.end())]
            at, before = m.start(), []
            while True:  # john dot doe at ...
                start = name_before(text, at, floor)
                if start == at:
                    if before:
                        before.pop()  # nothing stands before that dot
                    break
                if start - 5 < floor or text[start - 5 : start].lower() != " dot ":
                    break
                at = start - 5
                before.append((at, at + 5, "."))
            edits += before
            floor = m.end()
        return tape.rewrite(sorted(edits))

    return run


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def detectors() -> Callable[[str], Found]:
    """The base detectors: leftmost non-overlapping matches of each kind, those that fail their test dropped."""
    local, host = re.compile(r"[A-Za-z0-9._%+-]"), re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
    card = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
    phone = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
    dotted = re.compile(r"[0-9]\.[0-9]")
    long_run = re.compile(r"(?:[0-9][\x20-]?){15}[0-9]")

    def emails(text: str) -> Iterator[tuple[int, int]]:
        end, at = 0, text.find("@")
        while at >= 0:
            start = at
            while start > end and local.match(text, start - 1):
                start -= 1
            m = host.match(text, at) if start < at else None
            if m:
                yield start, (end := m.end())
            at = text.find("@", max(at + 1, end))

    def small(part: str) -> bool:
        part = part.lstrip("0")
        return len(part) < 4 and int(part or 0) <= 255

    def run(text: str) -> Found:
        found = [("email", a, b) for a, b in emails(text)]
        if dotted.search(text):
            found += [("ip", *m.span()) for m in ip.finditer(text) if all(map(small, m[0].split(".")))]
        if long_run.search(text):
            for m in card.finditer(text):
                digits = m[0].replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and _luhn(digits):
                    found.append(("card", *m.span()))
        if "+" in text:
            for m in phone.finditer(text):
                if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                    found.append(("phone", *m.span()))
        return found

    return run


def finder() -> Callable[[str | None], list[tuple[str, int, int, bool]]]:
    """Function from a text to ``(kind, start, end, base)``, by kind and then by start."""
    detect = detectors()
    chain = (undo_homoglyphs(), read_digits(), read_at_dot())

    def run(text: str | None) -> list[tuple[str, int, int, bool]]:
        if not text:
            return []
        base = detect(text)
        spans = {(kind, a, b): True for kind, a, b in base}
        tape = Tape.of(text)
        for transducer in chain:
            tape = transducer(tape)
        if tape.text != text:
            held: dict[str, list[tuple[int, int]]] = {}
            for kind, a, b in base:
                held.setdefault(kind, []).append((a, b))
            for kind, a, b in detect(tape.text):
                start, end = tape.starts[a], tape.ends[b - 1]
                if not any(x <= start and end <= y for x, y in held.get(kind, ())):
                    spans.setdefault((kind, start, end), False)
        return sorted(((*s, b) for s, b in spans.items()), key=lambda s: (KINDS.index(s[0]), s[1], s[2]))

    return run


def personal_spans(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    find = finder()
    names = ("kind", "start", "end", "base")
    for batch in texts:
        yield pd.Series([[dict(zip(names, s)) for s in find(t)] for t in batch])


def redacted(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Each stretch of personal data becomes the name of its kind in angle brackets; overlapping ones become one."""
    find = finder()

    def redact(text: str | None) -> str | None:
        spans = sorted((a, -b, kind) for kind, a, b, _ in find(text))
        if not spans:
            return text
        out, at, end, label = [], 0, -1, ""
        for a, b, kind in spans:
            if a < end:
                end = max(end, -b)
                continue
            if end >= 0:
                out.append(label)
                at = end
            out.append(text[at:a])
            end, label = -b, f"<{kind}>"
        return "".join([*out, label, text[end:]])

    for batch in texts:
        yield batch.map(redact, na_action="ignore")


def find_personal_data(docs: DataFrame) -> DataFrame:
    """``docs`` with ``pii``, the spans in code points, end exclusive."""
    return docs.withColumn("pii", F.pandas_udf(personal_spans, SPANS)("text"))


def redact_personal_data(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data taken out of ``text``."""
    return docs.withColumn("text", F.pandas_udf(redacted, "string")("text"))


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
