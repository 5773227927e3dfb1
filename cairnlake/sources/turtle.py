"""Turtle text as triples: prefixes, bases, lists of predicates and objects, blank nodes, collections, every form of literal.

The text comes in chunks, and no more of it is held than the token that is being read and a chunk. A statement's triples come
together once it has ended; after a fault reading goes on at the next statement.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from urllib.parse import urljoin

from pyspark.sql import DataFrame, SparkSession

from .triples import ESCAPES

# Terms of the Turtle and RDF syntax.
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
XSD = "http://www.w3.org/2001/XMLSchema#"
RDF_TYPE, FIRST, REST, NIL = (RDF + x for x in ("type", "first", "rest", "nil"))

#: Characters after a token without which it isn't known to have ended; the longest token; triples of one statement that are held together.
MARGIN, LONGEST, TOGETHER = 64, 64_000_000, 100_000

TOKEN = re.compile(
    r"""\s+|\#[^\n]*
    |(?P<iri><[^<>"{}|^`\x00-\x20]*>)
    |(?P<long>\"\"\"(?:[^"\\]++|\\.|"(?!""))*+\"\"\"|'''(?:[^'\\]++|\\.|'(?!''))*+''')
    |(?P<text>"(?:[^"\\\n\r]++|\\.)*+"|'(?:[^'\\\n\r]++|\\.)*+')
    |(?P<word>@prefix\b|@base\b|(?:prefix|base)(?=\s))
    |(?P<lang>@[A-Za-z]+(?:-[A-Za-z0-9]+)*)
    |(?P<number>[+-]?(?:\d+\.\d*|\.?\d+)(?:[eE][+-]?\d+)?(?<!\.))
    |(?P<node>_:[\w](?:[\w.-]*[\w-])?)
    |(?P<name>(?:\w[\w.-]*)?:(?:(?:[\w:%-]|\\[-_~.!$&'()*+,;=/?\#@%])(?:(?:[\w.:%-]|\\[-_~.!$&'()*+,;=/?\#@%])*(?:[\w:%-]|\\.))?)?)
    |(?P<bare>a|true|false)(?![\w:-])
    |(?P<mark>\^\^|[.;,\[\]()])""",
    re.X | re.S | re.I,
)
#: What more text may end: an IRI, a string in one or three quotes.
OPEN = re.compile(r"""<[^<>"{}|^`\x00-\x20]*\Z|"(?:[^"\\\n\r]++|\\.)*+\\?\Z|'(?:[^'\\\n\r]++|\\.)*+\\?\Z""", re.S)
STATEMENT_END = re.compile(r"\.[ \t]*(?:#[^\n]*)?\r?\n")
ESCAPE = re.compile(r"\\(?:u([0-9A-Fa-f]{4})|U([0-9A-Fa-f]{8})|(.))", re.S)


def plain(text: str) -> str:
    """Without backslash escapes."""

    def one(m: re.Match) -> str:
        return chr(int(m[1] or m[2], 16)) if m[1] or m[2] else ESCAPES.get(m[0], m[3])

    return ESCAPE.sub(one, text)


class Fault(ValueError):
    """What isn't Turtle, and the line where it is."""

    def __init__(self, message: str, line: int):
        super().__init__(f"line {line}: {message}")


class Tokens:
    """Tokens of a text that comes in chunks."""

    def __init__(self, chunks: Iterable[str]):
        self.chunks, self.held, self.at, self.last, self.over, self.lines = iter(chunks), "", 0, 0, False, 1

    def more(self, keep: int) -> None:
        """Lets go what comes before `keep` and reads on: as much again as is left, so that a long token is looked at few times."""
        self.lines += self.held.count("\n", 0, keep)
        parts, size = [self.held[keep:]], len(self.held) - keep
        while size >= 0:
            if (chunk := next(self.chunks, None)) is None:
                self.over = True
                break
            parts.append(chunk)
            size -= len(chunk)
        self.held, self.at, self.last = "".join(parts), self.at - keep, max(0, self.last - keep)

    def fault(self, message: str) -> Fault:
        return Fault(message, self.lines + self.held.count("\n", 0, self.last))

    def unfinished(self, m: re.Match | None) -> bool:
        """Whether more text may make another token of what begins here."""
        if self.over:
            return False
        if not m:
            return len(self.held) - self.at <= MARGIN or self.held.startswith(('"""', "'''"), self.at) or bool(OPEN.match(self.held, self.at))
        # Two quotes before a third one are no empty string.
        return len(self.held) - m.end() <= MARGIN or (m.lastgroup == "text" and m.end() - self.at == 2 and self.held[m.end()] == self.held[self.at])

    def next(self) -> tuple[str, str]:
        while True:
            m = TOKEN.match(self.held, self.at)
            if self.unfinished(m):
                if len(self.held) - self.at > LONGEST:
                    raise self.fault(f"a token of more than {LONGEST} characters")
                self.more(self.at)
            elif self.at == len(self.held):
                return "end", ""
            elif not m:
                self.last = self.at
                raise self.fault(f"not Turtle: {self.held[self.at : self.at + 40]!r}")
            else:
                self.last, self.at = self.at, m.end()
                if m.lastgroup:
                    return m.lastgroup, m[0]

    def skip_statement(self) -> None:
        """Goes on after the next dot that ends a line, from the last token on."""
        self.at = self.last
        while not (m := STATEMENT_END.search(self.held, self.at)):
            if self.over:
                self.at = len(self.held)
                return
            self.at = max(self.at, self.held.rfind("\n") + 1)
            if len(self.held) - self.at > LONGEST:
                self.at = len(self.held)
            self.more(self.at)
        self.at = m.end()


class Reader:
    """The triples of a text, in order. The text is a string or comes in chunks; file tells its blank nodes from those of other texts."""

    def __init__(self, text: str | Iterable[str], file: str = ""):
        self.tokens, self.base, self.names, self.file, self.nodes = Tokens([text] if isinstance(text, str) else text), "", {}, file, 0
        self.kind, self.value = "start", ""

    def take(self) -> tuple[str, str]:
        now = self.kind, self.value
        if self.kind != "end":
            self.kind, self.value = self.tokens.next()
        return now

    def mark(self, value: str) -> bool:
        if (self.kind, self.value) == ("mark", value):
            self.take()
            return True
        return False

    def need(self, value: str) -> None:
        if not self.mark(value):
            raise self.tokens.fault(f"{value!r} expected, {self.value!r} found")

    def iri(self) -> str:
        kind, value = self.kind, self.value
        if kind == "iri":
            out = urljoin(self.base, plain(value[1:-1])) if self.base else plain(value[1:-1])
        elif kind == "name":
            prefix, _, local = value.partition(":")
            if prefix not in self.names:
                raise self.tokens.fault(f"no prefix {prefix!r}")
            out = self.names[prefix] + re.sub(r"\\(.)", r"\1", local)
        else:
            raise self.tokens.fault(f"an IRI expected, {value!r} found")
        self.take()
        return out

    def node(self) -> str:
        """A blank node that no other file has."""
        self.nodes += 1
        return f"_:{self.file}b{self.nodes}"

    def term(self) -> Iterator[tuple]:
        """Triples of a nested node, then (o, kind, lang, datatype)."""
        kind, value = self.kind, self.value
        if kind in ("iri", "name"):
            yield self.iri(), "iri", None, None
        elif kind == "node":
            yield f"_:{self.file}{self.take()[1][2:]}", "bnode", None, None
        elif self.mark("["):
            s = self.node()
            if not self.mark("]"):
                yield from self.about(s)
                self.need("]")
            yield s, "bnode", None, None
        elif self.mark("("):
            yield from self.collection()
        elif kind in ("text", "long"):
            self.take()
            lexical, lang, of = plain(value[3:-3] if kind == "long" else value[1:-1]), None, None
            if self.kind == "lang":
                lang = self.take()[1][1:].lower()
            elif self.mark("^^"):
                of = self.iri()
            yield lexical, "literal", lang, of
        elif kind == "number":
            self.take()
            yield value, "literal", None, XSD + ("double" if "e" in value.lower() else "decimal" if "." in value else "integer")
        elif kind == "bare" and value in ("true", "false"):
            self.take()
            yield value, "literal", None, XSD + "boolean"
        else:
            raise self.tokens.fault(f"a term expected, {value!r} found")

    def about(self, s: str) -> Iterator[tuple]:
        """Predicates and objects of a subject."""
        while True:
            if (self.kind, self.value) == ("bare", "a"):
                self.take()
                p = RDF_TYPE
            else:
                p = self.iri()
            while True:
                for found in self.term():
                    if len(found) == 6:
                        yield found
                    else:
                        yield s, p, *found
                if not self.mark(","):
                    break
            if not self.mark(";"):
                return
            while self.mark(";"):
                pass
            if (self.kind, self.value) in (("mark", "."), ("mark", "]")):
                return

    def collection(self) -> Iterator[tuple]:
        """Triples of a list, then its first node; the list of nothing is rdf:nil."""
        head = last = None
        while not self.mark(")"):
            own = self.node()
            if last:
                yield last, REST, own, "bnode", None, None
            head, last = head or own, own
            for found in self.term():
                yield found if len(found) == 6 else (own, FIRST, *found)
        if last:
            yield last, REST, NIL, "iri", None, None
        yield (head, "bnode", None, None) if head else (NIL, "iri", None, None)

    def directive(self) -> None:
        word = self.take()[1].lower()
        if word.endswith("prefix"):
            kind, name = self.kind, self.value
            if kind != "name" or not name.endswith(":"):
                raise self.tokens.fault(f"a prefix expected, {name!r} found")
            self.take()
            self.names[name[:-1]] = self.iri()
        else:
            self.base = self.iri()
        if word[0] == "@":
            self.need(".")

    def statement(self) -> Iterator[tuple]:
        *inner, (s, kind, *_) = self.term()
        if kind == "literal":
            raise self.tokens.fault(f"a literal can't be a subject: {s!r}")
        yield from inner
        if not (inner and (self.kind, self.value) == ("mark", ".")):
            yield from self.about(s)
        if (self.kind, self.value) != ("mark", "."):
            raise self.tokens.fault(f"'.' expected, {self.value!r} found")

    def triples(self, problems: list[str] | None = None) -> Iterator[tuple]:
        """The triples of each statement once it has ended (of a statement with more than TOGETHER, as they come).

        Without problems a fault is an error. With them it is added there, the faulty statement is left out, and
        reading goes on at the next one.
        """
        while self.kind != "end":
            try:
                if self.kind == "start" or (self.kind, self.value) == ("mark", "."):
                    self.kind, self.value = self.tokens.next()
                if self.kind == "word":
                    self.directive()
                elif self.kind != "end":
                    held: list[tuple] = []
                    for t in self.statement():
                        held.append(t)
                        if len(held) > TOGETHER:
                            yield from held
                            held = []
                    yield from held
            except RecursionError as e:
                raise self.tokens.fault("nested too deep") from e
            except Fault as e:
                if problems is None:
                    raise
                problems.append(str(e))
                self.tokens.skip_statement()
                self.kind, self.value = "start", ""


def read_turtle(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Triples of Turtle files, and (file, entry, problem) of each; see archives.read_dump.

    strict: what isn't Turtle is an error. Otherwise faulty statements are left out, and a row with nothing but file and problem says what is wrong.
    """
    from .archives import read_dump

    return read_dump(spark, path, damaged="strict" if strict else "statement", names=r".")
