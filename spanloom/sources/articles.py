"""Structured article XML to text, a section index whose positions never move, references and citation markers.

One pass over the parser's events, without a tree: a table tells by (where we are, which element begins) what an element is: a
region, a block of text, something to pass through, or something to leave out.  Blocks carry the regions they stand in; positions
are the running sum of the blocks' lengths, and a region's span is that of its first and last filled block.

Reference lists, figures, tables and formulas are left out (what follows them stays), citation markers stay; blanks are collapsed within a
block and blocks are joined by a blank line.  A region's labels come from its heading or type, else from the region around it, else
``other``; regions are listed inner before outer.  Input that is no article fails that row only.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate
from xml.etree import ElementTree as ET

import pyarrow as pa
from pyspark.sql import DataFrame

from spanloom.functions.text import CODE_HEADING, DATA_HEADING, HEADINGS, SECTION_TYPES

#: Elements dropped before the text is taken.
DROPPED = frozenset((
    "ref-list", "table-wrap", "table-wrap-group", "fig", "fig-group", "graphic", "inline-graphic", "inline-formula", "disp-formula",
    "tex-math", "supplementary-material", "media"))
#: Titles of regions that have no heading of their own.
NAMED = {"abstract": ("abstract", "Abstract"), "ack": ("other", "Acknowledgements")}
HEAD = 180  # characters by which a paragraph is found again

# where -> element -> what it opens there; "*" is any other element
_OPENS = {
    "outside": {"article": "article", "*": "outside"},
    "article": {"front": "front", "body": "body", "back": "back", "*": "left out"},
    "front": {"abstract": "named", "article-title": "heading", "*": "front"},
    "body": {"sec": "region", "*": "loose"},
    "back": {"sec": "region", "notes": "region", "ack": "named", "*": "left out"},
    "region": {"sec": "region", "notes": "region", "title": "title", "*": "block"},
    "block": {"*": "block"}, "left out": {"*": "left out"},
}
_LIKE = {"named": "block", "loose": "block", "title": "block", "heading": "block"}  # what is inside them is like a block's inside


def labels_of(title: str | None, section_type: str | None = None) -> list[str]:
    """The labels of a heading, as :func:`spanloom.functions.text.heading_labels` gives them."""
    found = [SECTION_TYPES[section_type.lower()]] if section_type and section_type.lower() in SECTION_TYPES else []
    if title:
        found += [n for n, p in (("data_availability", DATA_HEADING), ("code_availability", CODE_HEADING)) if n not in found and re.search(p, title)]
        found = found or [n for n, p in HEADINGS if re.search(p, title)][:1]
    return found


class Events:
    """A parser target that gathers blocks, regions, references and markers."""

    def __init__(self) -> None:
        self.where = ["outside"]
        self.names: list[str] = []
        self.seen: set[str] = set()
        self.blocks: list[tuple[list[str], int]] = []  # pieces, region
        self.regions: list[dict] = []  # kind, title slot, type, parent, labels
        self.inside: list[int] = []  # the open regions
        self.loose: int | None = None
        self.heading: list[str] | None = None
        self.closed: list[int] = []
        self.takers: list[tuple[int, list[str], str]] = []  # open elements that take text: depth, pieces, what for
        self.paragraphs: list[list[str]] = []
        self.refs: dict[str, dict[str, str]] = {}
        self.marks: list[tuple[list[str], list[str], list[str]]] = []  # ids, paragraph, marker
        self.ref = ""

    def _region(self, kind: str, type_: str | None = None) -> int:
        self.regions.append({"kind": kind, "type": type_, "title": None, "parent": self.inside[-1] if self.inside else None})
        return len(self.regions) - 1

    def _take(self, pieces: list[str], use: str) -> None:
        self.takers.append((len(self.names), pieces, use))

    def _block(self, region: int) -> None:
        self.blocks.append(([], region))
        self._take(self.blocks[-1][0], "block")

    def start(self, tag: str, attributes: dict[str, str]) -> None:
        name, at = tag.rsplit("}", 1)[-1], self.where[-1]
        self.names.append(name)
        self._part()
        opens = _OPENS[_LIKE.get(at, at)]
        what = opens.get(name, opens["*"])
        if name in DROPPED and at != "outside":
            what = "left out"
        elif at in ("article", "outside") and what in _OPENS and what != "left out" and name in ("article", "front", "body", "back"):
            what = "left out" if name in self.seen else what  # the first of each counts
            self.seen.add(name)
        elif what == "region":
            if at == "body":
                self._end_loose()
            self.inside.append(self._region("section", attributes.get("sec-type") or attributes.get("notes-type")))
            self.blocks.append(([], self.inside[-1]))  # its title's place
            self.regions[self.inside[-1]]["slot"] = len(self.blocks) - 1
        elif what == "title":
            region = self.regions[self.inside[-1]]
            if region["title"] is None:
                region["title"] = self.blocks[region["slot"]][0]
                self._take(region["title"], "block")
            else:
                what = "left out"
        elif what == "named":
            self._block(self._region(name))
        elif what == "loose":
            self.loose = self._region("loose") if self.loose is None else self.loose
            self._block(self.loose)
        elif what == "block" and at == "region":
            self._block(self.inside[-1])
        elif what == "heading":
            self.heading, what = ([], what) if self.heading is None else (self.heading, "left out")
            if what == "heading":
                self._take(self.heading, "block")
        self.where.append(what)
        if "article" in self.seen:
            self._citation(name, attributes)

    def _citation(self, name: str, attributes: dict[str, str]) -> None:
        if name in ("p", "title"):
            self.paragraphs.append([])
            self._take(self.paragraphs[-1], "paragraph")
        elif name == "xref":
            marker: list[str] = []
            around = next((pieces for _, pieces, use in reversed(self.takers) if use == "paragraph"), None)
            if around is not None:
                self.marks.append(((attributes.get("rid") or "").split(), around, marker))
            self._take(marker, "marker")
        elif name == "ref":
            self.ref = attributes.get("id") or ""
        elif name == "pub-id" and self.ref:
            kind = (attributes.get("pub-id-type") or "").lower()
            if kind in ("doi", "pmid"):
                self._take([], f"id {kind}")

    def _part(self) -> None:
        """An element's edge parts the text on its two sides."""
        for _, pieces, use in self.takers:
            if use != "block" or self.where[-1] != "left out":
                pieces.append(" ")

    def data(self, text: str) -> None:
        for _, pieces, use in self.takers:
            if use != "block" or self.where[-1] != "left out":
                pieces.append(text)

    def end(self, tag: str) -> None:
        name, what = self.names.pop(), self.where.pop()
        while self.takers and self.takers[-1][0] > len(self.names):
            _, pieces, use = self.takers.pop()
            if use.startswith("id ") and (value := "".join(pieces).strip()):
                self.refs.setdefault(self.ref, {})[use[3:]] = value
        if name == "ref":
            self.ref = ""
        if what == "region":
            self.closed.append(self.inside.pop())
        elif what == "named":
            self.closed.append(len(self.regions) - 1)
        elif what == "body":
            self._end_loose()
        self._part()

    def _end_loose(self) -> None:
        if self.loose is not None:
            self.closed.append(self.loose)
            self.loose = None

    def close(self) -> Events:
        return self

    def parts(self) -> dict:
        """{doc_title, text, sections, refs, marks}."""
        texts = [_squeezed(pieces) for pieces, _ in self.blocks]
        filled = [i for i, t in enumerate(texts) if t]
        starts = dict(zip(filled, accumulate((len(texts[i]) + 2 for i in filled), initial=0)))
        spans: dict[int, tuple[int, int]] = {}
        for i in filled:
            region: int | None = self.blocks[i][1]
            while region is not None:
                spans[region] = spans.get(region, (starts[i], 0))[0], starts[i] + len(texts[i])
                region = self.regions[region]["parent"]
        titles, labels = {}, {}
        for k, r in enumerate(self.regions):  # the outer before the inner
            named = NAMED.get(r["kind"], ("other", ""))
            titles[k] = _squeezed(r["title"] or []) if r["kind"] == "section" else named[1]
            labels[k] = (labels_of(titles[k], r["type"]) or labels.get(r["parent"], ["other"])) if r["kind"] == "section" else [named[0]]
        sections = [{"labels": labels[k], "title": titles[k], "start": spans[k][0], "end": spans[k][1]} for k in self.closed if k in spans]
        refs = [{"rid": k, "doi": v["doi"].lower().removeprefix("https://doi.org/") if "doi" in v else None, "pmid": v.get("pmid")} for k, v in self.refs.items()]
        marks = [{"rids": ids, "head": _squeezed(around), "marker": _squeezed(own)} for ids, around, own in self.marks if ids]
        marks = [m | {"head": m["head"][:HEAD], "inside": m["head"].find(m["marker"]) if m["marker"] else -1} for m in marks if len(m["head"]) >= 20]
        return {"doc_title": _squeezed(self.heading or []) or None, "text": "\n\n".join(texts[i] for i in filled), "sections": sections, "refs": refs, "marks": marks}


def _squeezed(pieces: list[str]) -> str:
    return " ".join("".join(pieces).split())


def parse_article(xml: bytes | str) -> dict:
    """{doc_title, text, sections, refs, marks} of one article; raises ValueError where there is none."""
    try:
        parser = ET.XMLParser(target=Events())
        parser.feed(xml)
        found = parser.close()
    except ET.ParseError as e:
        raise ValueError(f"not well-formed: {e}") from None
    if "article" not in found.seen:
        raise ValueError("no article element")
    return found.parts()


_SCHEMA = {
    "doc_title": (pa.string(), "string"), "text": (pa.string(), "string"),
    "sections": (pa.list_(pa.struct([("labels", pa.list_(pa.string())), ("title", pa.string()), ("start", pa.int32()), ("end", pa.int32())])),
                 "array<struct<labels:array<string>,title:string,start:int,`end`:int>>"),
    "refs": (pa.list_(pa.struct([("rid", pa.string()), ("doi", pa.string()), ("pmid", pa.string())])), "array<struct<rid:string,doi:string,pmid:string>>"),
    "marks": (pa.list_(pa.struct([("rids", pa.list_(pa.string())), ("head", pa.string()), ("marker", pa.string()), ("inside", pa.int32())])),
              "array<struct<rids:array<string>,head:string,marker:string,inside:int>>"),
}


def article_parts(files: DataFrame) -> DataFrame:
    """(doc_id, doc_title, text, sections, refs, marks, error) of rows (doc_id, content); a row that fails keeps its error, not the job."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, errors = [], []
            for content in batch.column(1).to_pylist():
                try:
                    made.append(parse_article(content or b""))
                    errors.append(None)
                except ValueError as e:
                    made.append(dict.fromkeys(_SCHEMA))
                    errors.append(str(e))
            columns = [pa.array([m[k] for m in made], kind) for k, (kind, _) in _SCHEMA.items()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, pa.array(errors, pa.string())], ["doc_id", *_SCHEMA, "error"])

    return files.select("doc_id", "content").mapInArrow(run, "doc_id string, " + ", ".join(f"{k} {ddl}" for k, (_, ddl) in _SCHEMA.items()) + ", error string")


def parse_articles(files: DataFrame) -> DataFrame:
    """(doc_id, doc_title, text, sections, error), see :func:`article_parts`."""
    return article_parts(files).select("doc_id", "doc_title", "text", "sections", "error")
