"""Records of one XML document: the direct children of its root, read as they stream by."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from xml.parsers import expat
from xml.sax.saxutils import quoteattr

_XML_BLANK = " \t\r\n"


@dataclass
class XmlRecord:
    """Attributes and child elements in document order, by local name."""

    name: str
    attributes: list[tuple[str, str]]
    children: list[tuple[str, str]] = field(default_factory=list)
    nested: set[str] = field(default_factory=set)

    def columns(self) -> list[tuple[str, bool]]:
        """(name, is attribute), attributes first, one entry per name ignoring case."""
        found: dict[str, tuple[str, bool]] = {}
        for name, _ in self.attributes:
            found.setdefault(name.upper(), (name, True))
        for name, _ in self.children:
            found.setdefault(name.upper(), (name, False))
        return list(found.values())

    def values(self) -> dict[str, str]:
        """Upper-cased name to text; an attribute hides an element, the first element wins."""
        found: dict[str, str] = {}
        for name, text in [*self.attributes, *self.children]:
            found.setdefault(name.upper(), text)
        return found


def _local(name: str) -> str:
    return name.rsplit(" ", 1)[-1]


class _RecordBuilder:
    """Collects records from parser events; keeps no more than the record being read."""

    def __init__(self):
        self.depth = 0
        self.record: XmlRecord | None = None
        self.parts: list[str] = []
        self.run: list[str] = []
        self.in_cdata = False
        self.done: list[XmlRecord] = []
        self.namespaces: dict[str, str] = {}

    def attach(self, parser) -> None:
        parser.StartElementHandler = self.start
        parser.EndElementHandler = self.end
        parser.CharacterDataHandler = self.run.append
        parser.CommentHandler = lambda text: self.flush()
        parser.ProcessingInstructionHandler = lambda target, data: self.flush()
        parser.StartCdataSectionHandler = lambda: self.flush(cdata=True)
        parser.EndCdataSectionHandler = lambda: self.flush(cdata=False)
        parser.StartDoctypeDeclHandler = self.refuse_doctype
        parser.StartNamespaceDeclHandler = self.declare

    @staticmethod
    def refuse_doctype(*_) -> None:
        raise ValueError("XML with a DOCTYPE declaration is not read.")

    def declare(self, prefix: str | None, uri: str) -> None:
        if self.depth == 0 and prefix:
            self.namespaces[prefix] = uri

    def flush(self, cdata: bool | None = None) -> None:
        """Ends a run of text; a run of blanks outside CDATA does not count."""
        text = "".join(self.run)
        self.run.clear()
        if self.depth >= 3 and (self.in_cdata or text.strip(_XML_BLANK)):
            self.parts.append(text)
        if cdata is not None:
            self.in_cdata = cdata

    def start(self, name: str, attributes: list[str]) -> None:
        self.flush()
        self.depth += 1
        if self.depth == 2:
            pairs = [(_local(k), v) for k, v in zip(attributes[::2], attributes[1::2])]
            self.record = XmlRecord(_local(name), [pair for pair in pairs if not pair[0].startswith("xmlns")])
        elif self.depth == 3:
            self.parts = []
            self.child = _local(name)
        elif self.depth == 4:
            self.record.nested.add(self.child.upper())

    def end(self, name: str) -> None:
        self.flush()
        if self.depth == 3:
            self.record.children.append((self.child, "".join(self.parts)))
        elif self.depth == 2:
            self.done.append(self.record)
        self.depth -= 1


def iter_records(
    pieces: Iterable[bytes],
    record: str | None = None,
    namespaces: dict[str, str] | None = None,
    complete: bool = False,
) -> Iterator[XmlRecord]:
    """Records of the document given in pieces; `record` keeps root children of that name, ignoring case.

    `namespaces` receives the prefixes the root declares. A `complete` document must end with its root.
    """
    builder = _RecordBuilder()
    parser = expat.ParserCreate(namespace_separator=" ")
    parser.ordered_attributes = True
    parser.buffer_text = True
    builder.attach(parser)
    if namespaces is not None:
        builder.namespaces = namespaces
    for piece in pieces:
        parser.Parse(piece, False)
        ready, builder.done = builder.done, []
        for found in ready:
            if record is None or found.name.upper() == record.upper():
                yield found
    if complete:
        parser.Parse(b"", True)


def root_tag(namespaces: dict[str, str]) -> bytes:
    """A root that declares `namespaces`, to read records cut out of their document."""
    declared = "".join(f" xmlns:{prefix}={quoteattr(uri)}" for prefix, uri in namespaces.items())
    return f"<r{declared}>".encode()


def parse_record(text: str, namespaces: dict[str, str]) -> XmlRecord:
    return next(iter_records([root_tag(namespaces), text.encode()]))
