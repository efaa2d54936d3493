"""Cell text from raw markup: runs between tags are joined first, entities are decoded last.

Spark's parser decodes entities while it copies a nested child's markup, after which an escaped `<b>` looks like a tag.
So `shielded` escapes every `&` once more and turns CDATA sections into escaped text before a record is parsed, and
`cell_text` assembles a cell of what the parser gives: every `<` in it is real markup. Runs of blanks between tags do not count, blanks in
CDATA sections do.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: An empty element in place of a comment, an instruction or either end of a CDATA section: it ends a run of text.
BREAK = "<lakelens.break/>"
# Characters that XML does not allow mark where such a part was and where a section's text ends.
_PART = r"(?s)<!--.*?-->|<\?.*?\?>|<!\[CDATA\[(.*?)\]\]>"
_OPEN, _CLOSE = "\x01", "\x02"
_TAG = r"""</?[\p{L}_:][^<>"']*(?:"[^"]*"[^<>"']*|'[^']*'[^<>"']*)*>"""
_BLANK = r"^[ \t\r\n]*$"


def _escaped_section(text: Column) -> Column:
    """The text of a CDATA section, whose `&` is escaped once already, as text that means the same."""
    for old, new in (("&amp;", "&amp;amp;"), ("<", "&amp;lt;"), (">", "&amp;gt;"), (" ", "&amp;#32;"), ("\t", "&amp;#9;"), ("\n", "&amp;#10;"), ("\r", "&amp;#10;")):
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def shielded(record: Column) -> Column:
    """The record's markup without comments and sections, its entities kept as text."""
    safe = F.replace(record, F.lit("&"), F.lit("&amp;"))
    pieces = F.split(F.regexp_replace(safe, _PART, f"{_OPEN}$1{_CLOSE}"), _OPEN)

    def part(piece: Column) -> Column:
        section = F.substring_index(piece, _CLOSE, 1)
        rest = F.substring(piece, F.length(section) + 2, F.length(piece))
        return F.concat(F.lit(BREAK), _escaped_section(section), F.lit(BREAK), rest)

    cut = F.concat(pieces[0], F.array_join(F.transform(F.slice(pieces, 2, F.size(pieces)), part), ""))
    return F.when(F.contains(record, F.lit("<!")) | F.contains(record, F.lit("<?")), cut).otherwise(safe)


def decoded(text: Column) -> Column:
    """The text with its entities replaced; only text that holds any goes through the parser."""
    # A leading character keeps blanks that are all there is.
    xml = F.concat(F.lit("<r><v>."), F.replace(text, F.lit(">"), F.lit("&gt;")), F.lit("</v></r>"))
    parsed = F.from_xml(xml, "v string", {"ignoreSurroundingSpaces": "false", "mode": "FAILFAST"})["v"]
    return F.when(F.contains(text, F.lit("&")), F.substring(parsed, 2, F.length(text))).otherwise(text)


def cell_text(markup: Column) -> Column:
    """The text of a shielded child: its runs between tags, decoded."""
    runs = F.filter(F.split(markup, _TAG), lambda run: ~run.rlike(_BLANK))
    plain = F.when(markup.rlike(_BLANK), F.lit("")).otherwise(markup)
    return decoded(F.when(F.contains(markup, F.lit("<")), F.array_join(runs, "")).otherwise(plain))
