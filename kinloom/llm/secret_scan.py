"""Secret scans by assignment-aware lexing, on top of three base patterns.

Source and configuration text is lexed into name-literal pairs: `name = "literal"`,
`name: literal`, `"name": "literal"`, `name := "a" + other`, `name: type = "literal"`, `table["name"] = "literal"`,
`a = name = "literal"`, `user, name = "x", "literal"`, `call("name", "literal")`, `<name>literal</name>`, `name: |` with an indented block.
A value may be a list, stand in parentheses or be a call's arguments; what stands in braces belongs to the names there. Strings that
follow each other or are added are scored as one. Literals may be quoted, triple-quoted or in backticks, with a prefix such as r or f;
a bare word is one if it is the whole value and no expression (`readLine()`, `a.b`, a plain word without a digit).

A literal bound to a name is a constant; a later binding that uses the name carries the literal on, so
`k = "..."; password = k` marks the literal at its own place. Bindings are nodes of a graph whose edges go to the
constants they use; how far names tell is passed back along them once, so the work is linear in the text. Literals
are scored by the sensitive words in the names they reach and by their own look.

Defined cases: null or empty text has no spans; an empty table gives an empty
result; repeated rows are scanned alike; no text is cut.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinloom.llm.arrow_map import map_text, texts_of
from kinloom.llm.spans import Span, digest, joined

ORDER = {"assign": 0, "access": 1, "hex": 2, "literal": 3}
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")

# Words in a name and how far they tell that its value is a secret.
NAME_WORDS = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "pass": 1.0, "passphrase": 1.0, "passcode": 1.0, "secret": 1.0, "secrets": 1.0, "token": 0.9,
    "apikey": 1.0, "accesskey": 1.0, "privatekey": 1.0, "secretkey": 1.0, "authkey": 1.0, "credential": 0.9, "credentials": 0.9,
    "bearer": 0.9, "auth": 0.5, "key": 0.5, "api": 0.3, "access": 0.3, "private": 0.5, "signing": 0.5, "encryption": 0.5, "client": 0.1,
}
#: Score from which a literal is reported; a name tells up to 1, its literal up to 1.
LEAST_SCORE = 1.4
#: How far a name must tell for what it is bound to to be looked at.
LEAST_TOLD = 0.4
LEAST_LENGTH = 8
_PLACEHOLDER = re.compile(r"(?i)(?:change_?me|example|placeholder|redacted|your[_-].*|x+|\*+|none|null|true|false|todo|dummy|<.*|\$\{.*|\{\{.*|%\(.*)\Z")

_NAME = r"[A-Za-z_$][A-Za-z0-9_$.-]*+"
# Patterns never look twice at what they passed: what repeats is possessive, and values are scanned by hand.
_BINDING = re.compile(rf"""(?<![A-Za-z0-9_$.-])(["'`]?)({_NAME})\1(?:[ \t]*+\])?[ \t]*+(:=|=>|=(?![=>~])|[?!]?:(?![:=]))[ \t]*+""")
_STRING = {'"': re.compile(r'"(?:[^"\\\n]|\\.)*+"'), "'": re.compile(r"'(?:[^'\\\n]|\\.)*+'")}
_PREFIX_AT = re.compile(r"""[rRbBuUfF@$]{1,2}(?=["'`])""")
#: Literals over several lines: what opens them, and their rest.
_LONG = {q: re.compile(rf"(?:[^\\]|\\.)*?{q}", re.DOTALL) for q in ('"""', "'''", "`")}
#: A type between a colon and an equals sign holds no single colon, so it ends before any later binding.
_TYPE = re.compile(r"(?:&'|[A-Za-z0-9_.<>\[\],|&*? \t()]|::)++")
_BARE_AT = re.compile(r"""[^\s"'`,;<>(){}\[\]]++""")
_WORD_AT = re.compile(r"[A-Za-z_$][A-Za-z0-9_$]*+(?:(?:\.|::|->)[A-Za-z_$][A-Za-z0-9_$]*+)*+")
_COMMA_AT = re.compile(r"[ \t]*+,[ \t]*+")
_WORDLIKE = re.compile(r"[A-Za-z0-9_$.+*/-]++")
_CALL_AT = re.compile(r"[ \t]*+[(\[]")
_OVER_AT = re.compile(r"[ \t]*+(?:[\n,)\]}]|\Z|[ \t](?:#|//))")
_EMPTY_LINE = re.compile(r"\n[ \t\r]*+\n")
_BLANKS = re.compile(r"[ \t\r\f\v]++")
_HUMP = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_ELEMENT = re.compile(rf"<({_NAME})(?:[ \t][^<>\n]*+)?>([^<>\n]*+)</\1>")
_CALLED = re.compile(rf"""\([ \t]*+(["'])({_NAME})\1[ \t]*+,[ \t]*+(?=["'`])""")
_TARGETS = re.compile(rf"(?m)^[ \t]*+({_NAME}(?:[ \t]*+,[ \t]*+{_NAME})++)[ \t]*+=(?!=)[ \t]*+")
_BLOCK_AT = re.compile(r"[|>][-+0-9]*+[ \t]*+\n")


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each base kind, those that fail its length dropped."""
    found = [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    return found + [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]


def name_score(name: str) -> float:
    """How sensitive a name is: its words, joined neighbours included, at most 1."""
    words = [w.lower() for w in _HUMP.findall(name)]
    pairs = [a + b for a, b in zip(words, words[1:], strict=False)]
    return min(1.0, sum(NAME_WORDS.get(w, 0.0) for w in {*words, *pairs}))


def literal_score(value: str) -> float:
    """Entropy of the characters in relation to what a random literal of this length has."""
    if len(value) < LEAST_LENGTH or _PLACEHOLDER.match(value):
        return 0.0
    n = len(value)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    mixed = any(c.isdigit() for c in value) or not value.islower()
    return min(1.0, entropy / min(4.0, math.log2(n))) * (1.0 if mixed else 0.4)


class Binding:
    """What a name is bound to: groups of literals (spans), and the bindings whose constants it uses."""

    __slots__ = ("before", "groups", "number", "told", "used")

    def __init__(self, number: int, told: float) -> None:
        self.number, self.told = number, told
        self.groups: list[list[tuple[int, int]]] = []
        self.used: set[int] = set()
        #: What its names were bound to before, which is what they mean in its own value.
        self.before: dict[str, int | None] = {}


class Lexer:
    """The bindings of a text, in reading order; literals over several lines are read for bindings after the rest."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.bindings: list[Binding] = []
        self.constants: dict[str, int] = {}
        self.regions = [(0, len(text))]
        #: Up to where each kind of quote is known not to close.
        self.open: dict[str, int] = {}
        self.equals = self.line = -1
        for m in _ELEMENT.finditer(text) if "</" in text else ():
            if inner := m[2].strip():
                at = m.start(2) + m[2].index(inner)
                self.bind(m[1]).groups.append([(at, at + len(inner))])
        while self.regions:
            start, end = self.regions.pop()
            self.open = {}
            self.equals = self.line = self.covered = -1
            self.region(start, end)

    def bind(self, *names: str) -> Binding:
        own = Binding(len(self.bindings), 0.0)
        self.bindings.append(own)
        for name in names:
            self.name_too(own, name)
        return own

    def name_too(self, own: Binding, name: str) -> None:
        own.told = max(own.told, name_score(name))
        own.before.setdefault(name, self.constants.get(name))
        self.constants[name] = own.number

    def region(self, start: int, end: int) -> None:
        text = self.text
        for m in _CALLED.finditer(text, start, end):
            if name_score(m[2]) > LEAST_TOLD and (string := self.quoted(m.end(), end)):
                self.bind(m[2]).groups.append([string[:2]])
        for m in _TARGETS.finditer(text, start, end):
            self.targets(m, end)
        at = start
        while binding := _BINDING.search(text, at, end):
            at = self.value(*self.opened(binding, end), end)

    def targets(self, m: re.Match, end: int) -> None:
        """Several names, several values."""
        at = m.end()
        for name in re.split(r"[ \t]*,[ \t]*", m[1]):
            if string := self.quoted(at, end):
                self.bind(name).groups.append([string[:2]])
                at = string[2]
            elif bare := _BARE_AT.match(self.text, at, end):
                at = bare.end()
            else:
                return
            comma = _COMMA_AT.match(self.text, at, end)
            if not comma:
                return
            at = comma.end()

    def opened(self, m: re.Match, end: int) -> tuple[Binding, int]:
        """The binding that begins here, its type passed, and where its value starts."""
        names, at = [m[2]], m.end()
        if m[3].endswith(":"):
            if self.equals < at:
                self.equals = self.text.find("=", at, end)
                self.equals = end if self.equals < 0 else self.equals
            if self.line < at:
                self.line = self.text.find("\n", at, end)
                self.line = end if self.line < 0 else self.line
            stop = self.equals
            if at < stop < self.line and self.text[stop : stop + 2] not in ("==", "=>") and (kind := _TYPE.match(self.text, at, stop)) and kind.end() == stop:
                told = self.text[at:stop]
                if told[-1] in " \t" or not any(c.isdigit() for c in told):  # else the end of a bare literal
                    if len(told) < 200 and name_score(told) > LEAST_TOLD:  # `log: password = "..."`: a name, or a type that tells
                        names.append(told.strip())
                    at = stop + 1
                    if blanks := _BLANKS.match(self.text, at, end):
                        at = blanks.end()
        return self.bind(*names), at

    def quoted(self, at: int, end: int) -> tuple[int, int, int] | None:
        """Start and end of the string literal that begins here, and where its quotes end."""
        text = self.text
        if prefix := _PREFIX_AT.match(text, at, end):
            at = prefix.end()
        if text[at : at + 1] not in ("\"", "'", "`"):
            return None
        for quotes, rest in _LONG.items():
            if text.startswith(quotes, at) and at >= self.open.get(quotes, 0):
                if closed := rest.match(text, at + len(quotes), end):
                    found = at + len(quotes), closed.end() - len(quotes), closed.end()
                    if "\n" in text[found[0] : found[1]]:
                        self.regions.append(found[:2])
                    return found
                self.open[quotes] = end  # no later one closes either
        quote = text[at]
        if quote == "`" or at < self.open.get(quote, 0):
            return None
        if string := _STRING[quote].match(text, at, end):
            return at + 1, string.end() - 1, string.end()
        line = text.find("\n", at, end)
        self.open[quote] = end if line < 0 else line  # nor does another one on this line
        return None

    def bare(self, own: Binding, at: int, end: int) -> int:
        """A value that begins with a bare word: the literal itself, a constant, or the start of an expression."""
        text = self.text
        found, name = _BARE_AT.match(text, at, end), _WORD_AT.match(text, at, end)
        if not found:
            return at + 1
        follows = text[found.end() : found.end() + 1]
        if name and name.end() == found.end() and self.use(own, name, end):
            return name.end()
        if follows and follows in "\"'`([{":
            if name:
                self.use(own, name, end)
            return name.end() if name else at + 1
        if name and _WORDLIKE.fullmatch(found[0]):
            # Letters, digits and operators: a literal if it is the whole value and no plain word or path.
            single = any(c.isdigit() for c in found[0]) and ("." not in found[0] or len(found[0]) >= 32) and _OVER_AT.match(text, found.end(), end)
            if not single:
                self.use(own, name, end)
                return name.end()
        own.groups.append([found.span()])
        return found.end()

    def use(self, own: Binding, name: re.Match, end: int) -> bool:
        """Note that a binding uses a constant, if the word is one and no call."""
        number = own.before[name[0]] if name[0] in own.before else self.constants.get(name[0])
        if number is None or _CALL_AT.match(self.text, name.end(), end):
            return False
        own.used.add(number)
        return True

    def block(self, own: Binding, at: int, end: int) -> int:
        """The indented lines below a name that stands for them; returns where they end."""
        text = self.text
        line = text.rfind("\n", 0, at) + 1
        indent = len(text[line:at]) - len(text[line:at].lstrip(" -"))
        start = stop = text.index("\n", at) + 1
        while stop < end:
            after = text.find("\n", stop, end)
            after = end if after < 0 else after + 1
            body = text[stop:after]
            if body.strip() and len(body) - len(body.lstrip(" ")) <= indent:
                break
            stop = after
        if inner := text[start:stop].strip():
            first = start + text[start:stop].index(inner)
            own.groups.append([(first, first + len(inner))])
        return stop

    def value(self, own: Binding, at: int, end: int) -> int:
        """Read the value of a binding and all bindings within its brackets; returns where it ends."""
        text = self.text
        brackets: list[str] = []
        braces = 0
        stack = [(own, 0, 0)]  # bindings, with the brackets and braces open at their start
        fresh, joint = True, False
        if header := _BLOCK_AT.match(text, at, end):
            if own.told > LEAST_TOLD and at >= self.covered:  # else part of a block that counts as a whole
                self.covered = self.block(own, at, end)
            return header.end()
        last = ""  # the character before, blanks apart
        while at < end:
            own, _, inside = stack[-1]
            if blanks := _BLANKS.match(text, at, end):
                at = blanks.end()
                continue
            c = text[at]
            item = bool(brackets) and last in ("(", "[", "{", ",", ";", "\n")
            if (c.isalpha() or c in "_$" or item and c in "\"'`") and last != "?" and (m := _BINDING.match(text, at, end)) and text[m.end() : m.end() + 1] not in ("", "\n"):
                if fresh and m[3] == "=" and not m[1]:  # one more name of the same value
                    self.name_too(own, m[2])
                    at = m.end()
                elif brackets:
                    own, at = self.opened(m, end)
                    stack.append((own, len(brackets), braces))
                    fresh, joint, last = True, False, m[3]
                else:
                    return at
            elif string := self.quoted(at, end):
                if braces == inside:  # else it belongs to names within the braces
                    if joint and own.groups:
                        own.groups[-1].append(string[:2])
                    else:
                        own.groups.append([string[:2]])
                    joint = True
                at, fresh, last = string[2], False, '"'
            elif c in "([{":
                brackets.append(c)
                braces += c == "{"
                at, fresh, joint, last = at + 1, False, False, c
            elif c in ")]}":
                if not brackets:
                    return at
                braces -= brackets.pop() == "{"
                while stack[-1][1] > len(brackets):
                    stack.pop()
                at, fresh, joint, last = at + 1, False, False, c
            elif c in ",;\n":
                if not brackets or c == "\n" and _EMPTY_LINE.match(text, at, end):
                    return at + 1  # a blank line ends whatever is open
                if len(stack) > 1 and stack[-1][1] == len(brackets):
                    stack.pop()
                    joint = False
                at, fresh, joint, last = at + 1, False, joint and c == "\n", c
            elif not brackets and (c == "#" or text.startswith("//", at)):
                return at + 1
            elif fresh:
                at, fresh, joint, last = self.bare(own, at, end), False, False, "a"
            elif word := _WORD_AT.match(text, at, end):
                if braces == inside:
                    self.use(own, word, end)
                at, joint, last = word.end(), False, "a"
            else:
                at, joint, last = at + 1, joint and c == "+", c
        return end


def literal_spans(text: str) -> list[Span]:
    """Literals that reach a sensitive name, by themselves or through constants."""
    if "=" not in text and ":" not in text and "</" not in text and "(" not in text:
        return []
    bindings = Lexer(text).bindings
    best = [b.told if b.told > LEAST_TOLD else 0.0 for b in bindings]
    found: set[Span] = set()
    for k in range(len(bindings) - 1, -1, -1):  # a binding uses earlier ones only
        if not best[k]:
            continue
        for used in bindings[k].used:
            best[used] = max(best[used], best[k])
        for group in bindings[k].groups:
            if best[k] + literal_score("".join(text[a:b] for a, b in group)) >= LEAST_SCORE:
                found |= {(a, b, "literal") for a, b in group if a < b}
    return sorted(found)


FIELDS = [("n_assign", T.LongType()), ("n_access", T.LongType()), ("n_hex", T.LongType()), ("base_sha256", T.StringType()), ("spans", T.StringType())]


def _make() -> Callable:
    none = digest([], ORDER)

    def work(texts: pa.Array) -> list:
        filled = pc.fill_null(texts, "")
        # Linear-time automata pick the few texts that the matchers need to see.
        maybe = pc.or_(pc.match_substring_regex(filled, r"(?i)password|passwd|secret|token|api_?key"), pc.match_substring_regex(filled, r"AKIA|[0-9a-f]{32}"))
        maybe = pc.or_(maybe, pc.match_substring_regex(filled, "[=:]|</")).to_pylist()
        rows = []
        for text, look in zip(texts_of(texts), maybe, strict=True):
            if not look:
                rows.append((0, 0, 0, none, ""))
                continue
            base = base_spans(text)
            kinds = Counter(kind for _, _, kind in base)
            rows.append((kinds["assign"], kinds["access"], kinds["hex"], digest(base, ORDER), joined(base + literal_spans(text), ORDER)))
        return [list(x) for x in zip(*rows, strict=True)]

    return work


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, digest of the base spans and all spans of every document."""
    return map_text(docs, _make, [F.col(text_col)], FIELDS, keep=[F.col(id_col)])


def mask(text: str, fill: str = "[SECRET]") -> str:
    """The text with every secret replaced: of an assignment, its value alone."""
    regions = [m.span(2) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    regions += [(start, end) for start, end, kind in base_spans(text) + literal_spans(text) if kind != "assign"]
    out, done = [], 0
    for start, end in sorted(regions):
        if start >= done:
            out += [text[done:start], fill]
        done = max(done, end)
    return "".join(out) + text[done:]


def masked_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with secrets in the text replaced; all other columns and null texts as they were."""

    def make() -> Callable:
        scan_slice = _make()

        def work(texts: pa.Array) -> list:
            spans = scan_slice(texts)[-1]
            return [[mask(x) if own else x for x, own in zip(texts.to_pylist(), spans, strict=True)]]

        return work

    name = "__masked"
    out = map_text(docs, make, [F.col(text_col)], [(name, T.StringType())], keep=[F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("__row")])
    return out.select(*[(F.col(name) if c == text_col else F.col("__row").getField(c)).alias(c) for c in docs.columns])
