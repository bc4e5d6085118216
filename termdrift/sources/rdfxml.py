"""RDF/XML as triples, read as a stream: any prefixes, any of the abbreviations that the grammar allows."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import urljoin
from xml.parsers import expat

RDF, XML = "http://www.w3.org/1999/02/22-rdf-syntax-ns#", "http://www.w3.org/XML/1998/namespace"
#: Attributes that say how an element is to be read; all others are properties.
SYNTAX = {RDF + x for x in ("about", "ID", "nodeID", "resource", "parseType", "datatype", "bagID")}
URI, BLANK, LITERAL = "uri", "blank", "literal"
Triple = tuple[str, str, str, str]


class Frame:
    """An open element: a node (subject), or a property of one (with the object found so far)."""

    __slots__ = ("base", "is_node", "items", "kind", "last", "mode", "object", "predicate", "subject", "text")

    def __init__(self, is_node: bool, base: str, subject: str = "", predicate: str = "", mode: str = ""):
        self.is_node, self.base, self.subject, self.predicate, self.mode = is_node, base, subject, predicate, mode
        self.text: list[str] = []
        self.object = self.kind = self.last = None
        self.items = 0


class Reader:
    """Collects triples (subject, predicate, object, kind of the object); blank nodes start with _:."""

    def __init__(self, base: str = ""):
        self.out: list[Triple] = []
        self.stack: list[Frame] = []
        self.base, self.blanks, self.raw = base, 0, 0
        self.parser = expat.ParserCreate(namespace_separator="\n")
        self.parser.buffer_text = True
        self.parser.StartElementHandler, self.parser.EndElementHandler, self.parser.CharacterDataHandler = self.start, self.end, self.data

    def feed(self, data: bytes, last: bool = False) -> list[Triple]:
        """The triples that data completes; raises expat.ExpatError if the document isn't well formed."""
        self.parser.Parse(data, last)
        done, self.out = self.out, []
        return done

    @staticmethod
    def name(tag: str) -> str:
        return tag.replace("\n", "")

    def blank(self, name: str | None = None) -> str:
        if name is not None:
            return f"_:n{name}"
        self.blanks += 1
        return f"_:{self.blanks}"

    def node(self, base: str, attributes: dict[str, str]) -> tuple[str, str]:
        """What a node element or an empty property is about, and of which kind that is."""
        if (about := attributes.get(RDF + "about")) is not None:
            return self.resolved(base, about), URI
        if (own := attributes.get(RDF + "ID")) is not None:
            return self.resolved(base, f"#{own}"), URI
        return self.blank(attributes.get(RDF + "nodeID")), BLANK

    @staticmethod
    def resolved(base: str, value: str) -> str:
        return value if ":" in value.split("/", 1)[0] else urljoin(base, value) if base else value

    def properties(self, subject: str, base: str, attributes: dict[str, str]) -> None:
        for name, value in attributes.items():
            if name == RDF + "type":
                self.out.append((subject, name, self.resolved(base, value), URI))
            elif name not in SYNTAX and not name.startswith(XML):
                self.out.append((subject, name, value, LITERAL))

    def start(self, tag: str, raw: dict[str, str]) -> None:
        if self.raw:  # within a literal of markup: only its text is kept
            self.raw += 1
            return
        name, attributes = self.name(tag), {self.name(k): v for k, v in raw.items()}
        above = self.stack[-1] if self.stack else None
        base = attributes.get(XML + "base", above.base if above else self.base)
        if above is None and name == RDF + "RDF":
            self.stack.append(Frame(True, base, mode="document"))
        elif above is None or above.mode == "document" or not above.is_node:
            self.open_node(name, base, attributes, above)
        else:
            self.open_property(name, base, attributes, above)

    def open_node(self, name: str, base: str, attributes: dict[str, str], above: Frame | None) -> None:
        subject, kind = self.node(base, attributes)
        self.stack.append(Frame(True, base, subject))
        if name != RDF + "Description":
            self.out.append((subject, RDF + "type", name, URI))
        self.properties(subject, base, attributes)
        if above is None or above.is_node:
            return
        if above.mode == "Collection":
            cell = self.blank()
            self.out.append((cell, RDF + "first", subject, kind))
            if above.last is None:
                above.object, above.kind = cell, BLANK
            else:
                self.out.append((above.last, RDF + "rest", cell, BLANK))
            above.last = cell
        else:
            above.object, above.kind = subject, kind

    def open_property(self, name: str, base: str, attributes: dict[str, str], above: Frame) -> None:
        if name == RDF + "li":
            above.items += 1
            name = f"{RDF}_{above.items}"
        mode = attributes.get(RDF + "parseType", "")
        frame = Frame(False, base, above.subject, name, mode if mode in ("", "Resource", "Collection") else "Literal")
        self.stack.append(frame)
        if frame.mode == "Literal":
            self.raw = 1
        elif frame.mode == "Resource":
            frame.object, frame.kind = self.blank(), BLANK
            frame.is_node, frame.subject, frame.last = True, frame.object, above.subject
        elif (resource := attributes.get(RDF + "resource")) is not None:
            frame.object, frame.kind = self.resolved(base, resource), URI
        elif RDF + "nodeID" in attributes:
            frame.object, frame.kind = self.blank(attributes[RDF + "nodeID"]), BLANK
        elif any(k not in SYNTAX and not k.startswith(XML) for k in attributes):
            frame.object, frame.kind = self.blank(), BLANK
        if frame.object is not None and frame.mode == "":
            self.properties(frame.object, base, attributes)

    def data(self, text: str) -> None:
        if self.stack and not self.stack[-1].is_node:
            self.stack[-1].text.append(text)

    def end(self, tag: str) -> None:
        if self.raw > 1:
            self.raw -= 1
            return
        self.raw = 0
        frame = self.stack.pop()
        if frame.mode == "Resource":
            self.out.append((frame.last, frame.predicate, frame.object, BLANK))
        elif not frame.is_node:
            if frame.mode == "Collection":
                self.close_list(frame)
            if frame.object is None:
                frame.object, frame.kind = "".join(frame.text), LITERAL
            self.out.append((frame.subject, frame.predicate, frame.object, frame.kind))

    def close_list(self, frame: Frame) -> None:
        nil = RDF + "nil"
        if frame.last is None:
            frame.object, frame.kind = nil, URI
        else:
            self.out.append((frame.last, RDF + "rest", nil, URI))


def triples(chunks: Iterator[bytes], base: str = "") -> Iterator[list[Triple]]:
    """Lists of triples, in the document's order, as its bytes come in."""
    reader = Reader(base)
    for data in chunks:
        yield reader.feed(data)
    yield reader.feed(b"", True)
