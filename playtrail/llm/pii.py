"""Personal data behind disguises: a transducer rewrites homoglyphs, spelled digits and at/dot disguises and
keeps for each character the place it came from; identifiers found in its output are mapped back."""

import hashlib
import re
import sys
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

Span = tuple[str, int, int]

# The kinds in their order, with the pattern of each.
KINDS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
ORDER = {kind: k for k, kind in enumerate(KINDS)}
EMAIL_RUN = re.compile(r"[A-Za-z0-9._%+@-]*")

# Letters of other scripts that look like Latin ones, in pairs.
LOOKALIKES = (
    "аaеeоoрpсcуyхxіiјjѕsԁdһhӏlԛqԝwАAВBЕEКKМMНHОOРPСCТTХXЅSІIЈJ"
    "αaοoρpνvιiκkΑAΒBΕEΖZΗHΙIΚKΜMΝNΟOΡPΤTΥYΧXıiɡg"
)
# Characters without width, and marks that stand for at, dot, plus and a dash.
INVISIBLE = "­​‌‍⁠﻿"
MARKS = {"＠": "@", "﹫": "@", "．": ".", "。": ".", "․": ".", "‧": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", " ": " ", " ": " "}

# The digits as words, in English, German, French and Spanish.
DIGIT_WORDS = (
    "zero one two three four five six seven eight nine",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
)
# How "at", "dot", "plus" and a dash are spelled, and ends of host names
# that aren't words of a text as well.
AT_WORDS, DOT_WORDS, PLUS_WORDS, DASH_WORDS = "at|arroba|arobase", "dot|punkt|point|punto", "plus", "dash|minus|hyphen"
TOP_DOMAINS = (
    "com|org|net|edu|gov|mil|info|biz|io|ai|app|dev|tv|uk|fr|eu|ch|nl|ca|au|jp|cn|br|mx|ru|pl|dk|fi|example|"
    "de|es|se|cz|hu|gr|pt|ro|ie|nz|za|kr|tr|ua|ar|cl|co|cc|xyz|online|site|shop|cloud|tech|test|invalid"
)
# Words that stand before "at" or between "at" and "dot" in plain sentences.
NO_HOSTS = "the|a|an|this|that|some|any|one|each|every|which|what|no|my|your|our|his|her|its|their|these|those"
NO_NAMES = (
    "us|me|them|him|her|it|you|online|available|more|out|up|found|here|there|visit|look|information|info|details|website|site|"
    "page|is|are|was|were|be|and|or|work|works|live|shop|read|see|only|also|now|directly"
)
# An identifier has so many digits at least, other than an address of four numbers.
LEAST_DIGITS = 9


def _plain_characters() -> dict[int, str]:
    """Every character whose compatibility form is one plain character, and every other script's digits."""
    table = {}
    for code in range(128, sys.maxunicode + 1):
        if 0xD800 <= code < 0xE000:
            continue
        mark = chr(code)
        plain = unicodedata.normalize("NFKC", mark)
        digit = unicodedata.decimal(mark, None)
        if digit is not None:
            table[code] = str(int(digit))
        elif len(plain) == 1 and " " < plain < "\x7f":
            table[code] = plain
    table |= {ord(a): b for a, b in zip(LOOKALIKES[::2], LOOKALIKES[1::2], strict=True)}
    return table | {ord(a): b for a, b in MARKS.items()} | dict.fromkeys(map(ord, INVISIBLE), "")


def _luhn(digits: str) -> bool:
    total = 0
    for k, digit in enumerate(map(int, reversed(digits))):
        total += digit if k % 2 == 0 else digit * 2 - 9 * (digit > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def _valid(kind: str, found: str) -> bool:
    if kind == "ip":
        return all(len(part.lstrip("0")) <= 3 and int(part) <= 255 for part in found.split("."))
    if kind == "card":
        digits = _digits(found)
        return 12 <= len(digits) <= 19 and _luhn(digits)
    return kind != "phone" or 9 <= len(_digits(found)) <= 15


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches lie within runs of characters that an address can have; only runs with an @ are looked at."""
    at, searched = text.find("@"), 0
    while at >= 0:
        start = at
        while start > searched and EMAIL_RUN.fullmatch(text, start - 1, start):
            start -= 1
        end = EMAIL_RUN.match(text, at).end()
        yield from (match.span() for match in KINDS["email"].finditer(text, start, end))
        searched = end
        at = text.find("@", end)


def base_spans(text: str) -> list[Span]:
    """What the patterns find in the text as it stands, leftmost and without overlap for each kind."""
    spans = [("email", *span) for span in _emails(text)] if "@" in text else []
    for kind, mark in (("ip", "."), ("card", ""), ("phone", "+")):
        if mark in text:
            spans += ((kind, *m.span()) for m in KINDS[kind].finditer(text) if _valid(kind, m.group()))
    return in_order(spans)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda span: (span[1], ORDER[span[0]], span[2]))


class Transducer:
    """Rewrites disguises. Output characters come with the source places where each begins and ends."""

    def __init__(self):
        self.characters = _plain_characters()
        codes = sorted(self.characters)
        runs, first = [], codes[0]
        for code, following in zip(codes, [*codes[1:], None], strict=True):
            if following != code + 1:
                runs.append(f"{re.escape(chr(first))}-{re.escape(chr(code))}")
                first = following
        self.homoglyph = re.compile(f"[{''.join(runs)}]")
        self.values = {word: str(n) for words in DIGIT_WORDS for n, word in enumerate(words.split())}
        word = "|".join(sorted(self.values, key=len, reverse=True))
        gap = r"[ \t]*+(?:[-,.\n][ \t]*+)?+"
        solid = rf"(?:[0-9]++|(?:{word}|{PLUS_WORDS}|{DOT_WORDS}|{DASH_WORDS})(?![^\W_])|[+().])"
        # Digits, plain and as words, in a row, with spelled marks between them.
        self.number = re.compile(rf"(?i)(?<![^\W_])(?:[0-9]++|(?:{word}|{PLUS_WORDS})(?![^\W_])|[+(])(?:{gap}{solid})++")
        self.token = re.compile(
            rf"(?i)(?P<digit>{word})(?![^\W_])|(?P<plus>{PLUS_WORDS})(?![^\W_])|(?P<dot>{DOT_WORDS})(?![^\W_])|(?P<dash>{DASH_WORDS})(?![^\W_])|(?P<plain>[0-9]+)|(?P<gap>.)", re.S
        )
        left, right = r"(?<![ \t])[ \t]*+[(\[{<][ \t]*+", r"[ \t]*+[)\]}>][ \t]*+"
        self.at = re.compile(rf"(?i){left}(?:{AT_WORDS}|@){right}|(?<![ \t])[ \t]++@[ \t]++")
        self.dot = re.compile(rf"(?i){left}(?:{DOT_WORDS}|\.){right}")
        label, end = r"[A-Za-z0-9-]+", r"(?![A-Za-z0-9])"
        bare_dot = rf"(?:[ \t]+(?:{DOT_WORDS}|\.)[ \t]+)"
        host = rf"{label}(?:(?:{bare_dot}|\.){label})*"
        # Bare words need each other: name at host dot end. "at boiling point it" is a sentence, and so may
        # be a spaced full stop: behind these the end is one that hosts have, otherwise any letters.
        known = rf"{host}{bare_dot}(?:{TOP_DOMAINS}){end}"
        spelled = rf"(?!(?:{NO_HOSTS})[ \t]){host}[ \t]+(?:dot|punkt|punto)[ \t]+[A-Za-z]{{2,}}{end}"
        foreign = rf"{host}[ \t]+(?:{DOT_WORDS})[ \t]+[A-Za-z]{{2,}}{end}"
        before = r"(?<=[A-Za-z0-9_%+-])"
        self.spelled_address = re.compile(
            rf"(?i){before}(?:(?P<at>[ \t]++at[ \t]++)(?:{spelled}|{known})"
            rf"|(?P<other>[ \t]++(?:arroba|arobase)[ \t]++)(?:{foreign}|{known}|{label}(?:\.{label})*?\.(?:{TOP_DOMAINS}){end})"
            rf"|(?P<mark>[ \t]*+@[ \t]*+)(?:{spelled}|{known}))(?:{bare_dot}(?:{TOP_DOMAINS}){end})*"
        )
        # A bare "at" before a host as it is written, but not "visit us at" one.
        self.half_spelled = re.compile(
            rf"(?i){before}[ \t]++at[ \t]++(?!www\.)(?={label}(?:\.{label})*?\.(?:{TOP_DOMAINS})(?![A-Za-z0-9/:-]|\.[A-Za-z0-9]))"
        )
        self.no_name = re.compile(rf"(?i)(?:.*[^A-Za-z0-9._%+-])?(?:{NO_NAMES})", re.S)
        self.bare_dot = re.compile(rf"(?i){bare_dot}")
        self.digit_shape = re.compile(r"[OolI|](?<=[0-9].)(?=[0-9])")

    def __call__(self, text: str) -> tuple[str, list[int], list[int]] | None:
        """The text rewritten, or nothing if no rule applies: the rules themselves tell, there is no sign looked for before."""
        tape = (text, None, None)
        for stage in (self._homoglyphs, self._spelled_numbers, self._addresses, self._digit_shapes):
            tape = _rewritten(tape, list(stage(tape[0])))
        return tape if tape[1] is not None else None

    def _homoglyphs(self, text: str):
        if not text.isascii():
            for match in self.homoglyph.finditer(text):
                yield match.start(), match.end(), self.characters[ord(match.group())]

    def _spelled_numbers(self, text: str):
        for match in self.number.finditer(text):
            if not re.search(r"[^\W\d_]", match.group()):
                continue
            # Gaps between digits go; other characters stay as they are.
            parts = [(m.lastgroup, m.start(), m.end(), m.group()) for m in self.token.finditer(text, *match.span())]
            solid = [k for k, part in enumerate(parts) if part[0] != "gap" or part[3] in "+()."]
            n_words = sum(part[0] == "digit" for part in parts)
            n_digits = n_words + sum(len(part[3]) for part in parts if part[0] == "plain")
            n_dots = sum(part[0] == "dot" or part[3] == "." for part in parts)
            four = n_dots >= 3 and n_digits >= 4
            if not (four or n_words >= 3 or n_words and n_digits >= LEAST_DIGITS):
                continue
            beside = {k: (i, j) for i, j in zip(solid, solid[1:]) for k in range(i + 1, j)}
            for k, (kind, start, end, found) in enumerate(parts):
                if kind == "digit":
                    yield start, end, self.values[found.lower()]
                elif kind in ("plus", "dot", "dash"):
                    yield start, end, {"plus": "+", "dot": ".", "dash": "-"}[kind]
                elif kind == "gap" and found not in "+().":
                    # Numbers that stand side by side behind an address of four are no part of it.
                    if not four or any(parts[i][0] != "plain" for i in beside[k]):
                        yield start, end, ""

    def _addresses(self, text: str):
        if any(mark in text for mark in "([{<@"):
            yield from ((m.start(), m.end(), "@") for m in self.at.finditer(text))
            yield from ((m.start(), m.end(), ".") for m in self.dot.finditer(text))
        for match in self.spelled_address.finditer(text):
            start, end = match.span(match.lastgroup)
            yield start, end, "@"
            yield from ((m.start(), m.end(), ".") for m in self.bare_dot.finditer(text, end, match.end()))
        for match in self.half_spelled.finditer(text):
            if not self.no_name.fullmatch(text, max(0, match.start() - 40), match.start()):
                yield match.start(), match.end(), "@"

    def _digit_shapes(self, text: str):
        """Letters that look like a digit, with a digit on either side."""
        for match in self.digit_shape.finditer(text):
            yield match.start(), match.end(), "0" if match.group() in "Oo" else "1"


def _rewritten(tape, edits):
    """The tape after edits `(start, end, new text)`; of edits that overlap, the first and longest holds."""
    if not edits:
        return tape
    text, begins, ends = tape
    if begins is None:
        begins, ends = list(range(len(text))), list(range(1, len(text) + 1))
    out, first, last, at = [], [], [], 0
    for start, end, new in sorted(edits, key=lambda e: (e[0], -e[1])):
        if start < at:
            continue
        out.append(text[at:start])
        first += begins[at:start]
        last += ends[at:start]
        out.append(new)
        first += [begins[start]] * len(new)
        last += [ends[end - 1]] * len(new)
        at = end
    out.append(text[at:])
    return "".join(out), first + begins[at:], last + ends[at:]


def all_spans(text: str, transducer: Transducer) -> tuple[list[Span], list[Span]]:
    """The base spans, and those with the disguised ones. A disguised span within a base span adds nothing."""
    base = base_spans(text)
    if (tape := transducer(text)) is None:
        return base, base
    plain, begins, ends = tape
    covered = [(start, end) for _, start, end in base]
    added = {
        (kind, begins[start], ends[end - 1])
        for kind, start, end in base_spans(plain)
        if not any(a <= begins[start] and ends[end - 1] <= b for a, b in covered)
    }
    return base, in_order([*base, *added])


def _written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def find_pii(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`, one row for each row of `df`.

    Counts and the digest are of the base spans; `spans` has also those that only the transducer reveals.
    Offsets count code points of the text as it stands, ends exclusive. Null and empty texts have no
    spans. Repeated rows stay repeated, an empty table gives no rows, other columns are ignored.
    Nothing is shuffled; a task holds a batch of texts, and one text's tape at a time.
    """

    def run(batches):
        transducer = Transducer()
        for batch in batches:
            rows = []
            for value in batch.column(1):
                base, spans = all_spans(value.as_py() or "", transducer)
                counts = [sum(span[0] == kind for span in base) for kind in KINDS]
                rows.append((*counts, hashlib.sha256(_written(base).encode()).hexdigest(), _written(spans)))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    kind = df.schema[doc_id].dataType.simpleString()
    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return df.select(doc_id, text).mapInArrow(run, f"doc_id {kind}, {counts}, base_sha256 string, spans string")


def masked(text: str, spans: list[Span], mark: str = "[{}]") -> str:
    """The text with every span replaced by its kind; overlapping spans make one gap, named by the first."""
    out, at = [], 0
    for kind, start, end in in_order(spans):
        if start >= at:
            out += [text[at:start], mark.format(kind)]
        at = max(at, end)
    return "".join([*out, text[at:]])
