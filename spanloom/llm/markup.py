"""Clean text with its structure from text that carries HTML, Markdown, wiki or LaTeX residue (problem 2).

* **Marks.** One scanner knows the marks of the four kinds where they stand as marks; signs in their plain sense
  (comparisons, prices, footnote stars, ``C#``, names with underscores, sets in braces) are not marks.  A text with at
  least one mark carries residue.
* **Style tree.** The element branches of all texts of one host are merged by their node: the path with each element's place
  among its siblings of that name, counted from the first and, as a second node, from the last.  A node's importance is the
  greater of two entropies: of its presentation (how its children vary between pages) and of its content (how its words
  vary).  Nodes that look and read alike on the host's pages (menus, notices) fall below the threshold and their branches are
  removed from every page before it is converted; a page has one branch of a node at most, so what is removed is what was
  counted.  Headings and other labels are alike by their office (``Background``) and go with a noisy branch around them only.  Nodes, styles and words are counted in Spark over all pages with elements.
* **Conversion.** Marks go, round by round until none is left, what they say about structure stays: ``blocks`` lists the
  headings (with level), list items, code and formulas as half-open code point ranges of the clean text.  Formulas keep their
  notation, also outside dollar signs (``\\alpha``), code its lines.  A template comes out as what stands in its places, unless it
  names a source or directs the editors.

The style tree alone cannot find marks of Markdown, wiki or LaTeX, nor a lone tag, so residue is told by the scanner; the
tree decides only what is dropped from pages.

Defined results.  Null or empty text: no residue, the text as it is, no blocks.  Unclosed or stray marks are removed alone.
Repeated rows give repeated results, and the style tree counts pages of the same host and text once.  Null host: the texts without host form one.  Whole texts are scanned.  An empty table
gives an empty result.
"""

from __future__ import annotations

import html
import html.entities

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from spanloom.plans.lineage import cut

#: Element names of HTML, article XML and wiki extensions.
ELEMENTS = (
    "a abbr abstract ack acronym address article article-title aside b bdi bdo big blockquote body bold br button caption center cite code col "
    "colgroup dd def-list del details dfn disp-formula disp-quote div dl dt em ext-link fig figcaption figure fn font footer form graphic h1 h2 "
    "h3 h4 h5 h6 head header hr html i iframe img inline-formula input ins italic kbd label li link list list-item main mark math media meta "
    "monospace nav nowiki ol option overline p pre q ref roman s samp sans-serif sc script sec section select small source span strike strong "
    "style styled-content sub sup supplementary-material svg syntaxhighlight table table-wrap tbody td tex-math tfoot th thead title tr tt u "
    "ul underline uri var video wbr xref"
).split()
#: Elements that stand on lines of their own.
BLOCK = frozenset(
    "abstract address article aside blockquote body center dd def-list details disp-formula disp-quote div dl dt fig figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header html li list list-item main nav ol p pre sec section table table-wrap tbody tfoot thead title tr ul".split()
)

#: Elements that name what follows them; to be alike on many pages is their office, so they go with a noisy branch only.
LABELS = frozenset("h1 h2 h3 h4 h5 h6 title th dt".split())
#: LaTeX commands that only lay text out, and those whose arguments are part of a formula; other bare commands are symbols.
LAYOUT = (
    "appendix bf bfseries bigskip centering clearpage em emph footnotesize frontmatter hfill hline hspace huge indent it item itshape label large "
    "ldots linebreak listoffigures listoftables maketitle medskip newline newpage noindent normalfont normalsize pagebreak par quad qquad raggedright rm "
    "rmfamily sc scshape sf sffamily sl small smallskip tableofcontents textbf textit textrm texttt tiny tt ttfamily vfill vspace").split()
IN_FORMULA = "frac dfrac tfrac binom sqrt hat bar vec tilde dot overline mathrm mathbf mathit mathcal mathbb mathsf operatorname sum prod int lim".split()
#: First words of templates that name a source or direct the editors; of others what stands in their places is text.
SILENT_TEMPLATES = "cite citation ref refn reflist sfn harv harvnb efn notelist main see about redirect infobox navbox category defaultsort toc clear stub".split()

MAX_SENT_HOSTS = 20_000  # hosts with noise whose paths are broadcast

_NAME = "|".join(sorted(map(re.escape, ELEMENTS), key=len, reverse=True))
_ATTRS = r"""(?:\s+[A-Za-z_:][\w:.-]*\s*=\s*(?:"[^"<>]*"|'[^'<>]*'|[^\s"'<>=]+))"""
# Every alternative begins with a literal, so the scan skips from one possible first character to the next; a line's
# beginning is its newline (the scanner puts one before the text), a look-behind stands after the character it precedes.
_TAG = [rf"</?(?i:{_NAME}|[a-z]\w*:[a-z][\w-]*){_ATTRS}*\s*/?>", rf"</?[A-Za-z][\w:.-]*{_ATTRS}+\s*/?>", r"</[A-Za-z][\w:.-]*\s*>",
        r"<!--.*?-->", r"<!\[CDATA\[.*?\]\]>", r"<!(?i:doctype)[^>]*>", r"<\?[a-z][^>]*\?>"]
_ENTITY = r"&(?:#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"
_IMAGE = r"!\[[^\[\]\n]*\]\([^()\s]*(?:[ \t]+\"[^\"\n]*\")?\)"
_LINK = r"\[[^\[\]\n]*\]\([^()\s]*(?:[ \t]+\"[^\"\n]*\")?\)"
_STAR = r"\*(?<![\w*]\*)(?=[^\s*])[^*\n]*[^\s*]\*(?![\w*])"
_LOW = r"_(?<![\w_]_)(?=[^\s_])[^_\n]*[^\s_]_(?![\w_])"
_MATH = r"\$[^$\n]*[\\^_{][^$\n]*\$"
_INLINE = [_IMAGE, _LINK, r"\*\*", r"__(?<!\w__)(?=[^\s_])[^\n]*?[^\s_]__(?!\w)", r"~~", r"`[^`\n]+`", r"```", _STAR, _LOW,
           r"\[\[", r"\]\]", r"\{\{", r"\}\}", r"''", r"\\[A-Za-z]+\*?", r"\\[%&_#$(){}\[\]]", _MATH, r"\$\$"]
_LINE = [r"[ \t]*(?:```|~~~)", r" {0,3}\#{1,6}[ \t]+\S", r" {0,3}[^\s=|>#*+-][^\n]*\n {0,3}(?:={3,}|-{3,})[ \t]*(?=\n|\Z)",
         r" {0,3}(?:-{3,}|\*{3,}|_{3,})[ \t]*(?=\n|\Z)", r"[ \t]*\|?[ \t]*:?-{3,}:?[ \t]*\|[-:| \t]*(?=\n|\Z)", r"[ \t]*\|[^\n]*\|[ \t]*(?=\n|\Z)",
         r"[ \t]*[*+-][ \t]+(?=\S)", r" {0,3}>[ \t]+\S", r"\{\|", r"\|[-}]", r"={2,6}[^=\n]+={2,6}[ \t]*(?=\n|\Z)", r"[*#:;]+[ \t]+\S"]

_first = {"<": _TAG, "&": [_ENTITY]}
for _x in _INLINE:
    _first.setdefault(_x.lstrip("\\")[0], []).append(_x)
_first["\n"] = ["\n" + _x for _x in _LINE]
MARK = re.compile("|".join(x for group in _first.values() for x in group), re.DOTALL)

def _is_mark(found: str) -> bool:
    return found[0] != "&" or found[1] == "#" or found[1:] in html.entities.html5

def has_residue(text: str | None) -> bool:
    """Does ``text`` carry a mark of any of the four kinds?"""
    return bool(text) and any(_is_mark(m.group()) for m in MARK.finditer("\n" + text))

# --- conversion -----------------------------------------------------------------------------------------------------

_OPEN, _CLOSE, _KEEP = "\x02", "\x03", "\x04"  # structure begins (kind, level, colon), ends; a kept verbatim stretch
_ANY_TAG = re.compile("|".join(_TAG), re.DOTALL)
_PARTS = re.compile(rf"<(/?)((?:(?i:{_NAME})|[A-Za-z][\w:.-]*))((?:{_ATTRS})*)\s*(/?)>")

_VERBATIM = [(re.compile(p, re.DOTALL | re.IGNORECASE), kind) for p, kind in (
    (r"(?:(?<=\n)|(?<=\A))[ \t]*(?:```|~~~)[^\n]*\n(.*?)\n?[ \t]*(?:```|~~~)[ \t]*(?=\n|\Z)", "code"),
    (r"<pre\b[^>]*>\s*(?:<code\b[^>]*>)?(.*?)(?:</code>)?\s*</pre>", "code"),
    (r"<(?:syntaxhighlight|source)\b[^>]*>\n?(.*?)\n?</(?:syntaxhighlight|source)>", "code"),
    (r"\\begin\{(?:verbatim|lstlisting|minted)\}(?:\[[^\]\n]*\])?\n?(.*?)\n?\\end\{(?:verbatim|lstlisting|minted)\}", "code"),
    (r"\\begin\{(?:equation|align|gather|multline|eqnarray|displaymath|math)\*?\}\s*(.*?)\s*\\end\{(?:equation|align|gather|multline|eqnarray|displaymath|math)\*?\}", "formula"),
    (r"<(?:math|tex-math|\w+:math)\b[^>]*>(.*?)</(?:math|tex-math|\w+:math)>", "formula"),
    (r"\$\$(.+?)\$\$", "formula"), (r"\\\[(.+?)\\\]", "formula"), (r"\\\((.+?)\\\)", "formula"),
    (r"\$([^$\n]*[\\^_{][^$\n]*)\$", "formula"), (rf"(\\(?:{'|'.join(IN_FORMULA)})(?![A-Za-z])(?:\s?(?:_|\^)?\{{(?:[^{{}}]|\{{[^{{}}]*\}})*\}})+)", "formula"), (r"<code\b[^>]*>(.*?)</code>", "code"), (r"`([^`\n]+)`", "code"),
)]

def _structure(kind: str, level: int, inner: str) -> str:
    return f"{_OPEN}{kind}{level}:{inner.strip()}{_CLOSE}"

_BLOCK_RULES = [(re.compile(p, re.DOTALL | re.IGNORECASE), r) for p, r in (
    (r"<!--.*?-->|<!doctype[^>]*>|<\?[a-z][^>]*\?>|<(script|style)\b[^>]*>.*?</\1\s*>", lambda m: ""),
    (r"<!\[CDATA\[(.*?)\]\]>", lambda m: m[1]),
    (r"<h([1-6])\b[^>]*>(.*?)</h[1-6]\s*>", lambda m: "\n" + _structure("heading", int(m[1]), m[2]) + "\n"),
    (r"<title\b[^>]*>(.*?)</title\s*>", lambda m: "\n" + _structure("heading", 1, m[1]) + "\n"),
    (r"\n {0,3}(#{1,6})[ \t]+([^\n]*?)[ \t]*#*[ \t]*(?=\n)", lambda m: "\n" + _structure("heading", len(m[1]), m[2])),
    (r"\n {0,3}([^\s=|>#*+-][^\n]*)\n {0,3}(={3,}|-{3,})[ \t]*(?=\n)", lambda m: "\n" + _structure("heading", 1 if m[2][0] == "=" else 2, m[1])),
    (r"\n(={2,6})[ \t]*([^=\n]+?)[ \t]*={2,6}[ \t]*(?=\n)", lambda m: "\n" + _structure("heading", len(m[1]), m[2])),
    (r"\\((?:sub)*)(?:section|paragraph|chapter)\*?\{([^{}]*)\}", lambda m: "\n" + _structure("heading", 1 + len(m[1]) // 3, m[2]) + "\n"),
    (r"<li\b[^>]*>(.*?)(?:</li\s*>|(?=<li\b|</[uo]l))", lambda m: "\n" + _structure("item", 1, m[1]) + "\n"),
    (r"\\item\b(?:\[[^\]\n]*\])?[ \t]*([^\n]*)", lambda m: "\n" + _structure("item", 1, m[1])),
    (r"\n[ \t]*[*+-][ \t]+(?=\S)([^\n]*)", lambda m: "\n" + _structure("item", 1, m[1])),
    (r"\n([*#]+)[ \t]+(?=\S)([^\n]*)", lambda m: "\n" + _structure("item", len(m[1]), m[2])),
    (r"\n[;:]+[ \t]+(?=\S)| {0,3}(?<=\n)>[ \t]+(?=\S)|\n {0,3}>[ \t]+(?=\S)", lambda m: "\n"),
    (r"\n {0,3}(?:-{3,}|\*{3,}|_{3,})[ \t]*(?=\n)|\n[ \t]*\|?[ \t]*:?-{3,}:?[ \t]*\|[-:| \t]*(?=\n)|\n\{\|[^\n]*|\n\|[-}][^\n]*", lambda m: ""),
    (r"\n[ \t]*\|([^\n]*?)\|?[ \t]*(?=\n)", lambda m: "\n" + "\t".join(x.strip() for x in m[1].split("|"))),
    (r"</t[dh]\s*>\s*(?=<t[dh]\b)", lambda m: "\t"),
    (r"\\(?:begin|end)\{[^{}\n]*\}(?:\[[^\]\n]*\])?", lambda m: "\n"),
)]

_TEMPLATE = re.compile(r"\{\{([^{}]*)\}\}")


def _template(inner: str) -> str:
    """What a wiki template says in its places; nothing if it names a source or directs the editors."""
    name, *places = inner.split("|")
    if (name.split() or [""])[0].lower() in SILENT_TEMPLATES:
        return ""
    return " ".join(x.strip() for x in places if "=" not in x)


_INLINE_RULES = [(re.compile(p, re.DOTALL), r) for p, r in (
    (r"!?\[([^\[\]\n]*)\]\([^()\s]*(?:[ \t]+\"[^\"\n]*\")?\)", r"\1"),
    (r"\[\[(?:[^\[\]|\n]*\|)?([^\[\]|\n]*)\]\]", r"\1"), (r"\[\[|\]\]|\{\{|\}\}", ""),
    (r"~?\\(?:cite|citep|citet|label|ref|eqref|pageref|bibliography|bibliographystyle|usepackage|documentclass)\*?(?:\[[^\]\n]*\])?\{[^{}]*\}", ""),
    (r"\\footnote\{([^{}]*)\}", r" (\1)"), (r"\{\\[A-Za-z]+[ \t]+([^{}]*)\}", r"\1"), (r"\\[A-Za-z]+\*?\{([^{}]*\{[^{}]*\}[^{}]*|[^{}]*)\}", r"\1"),
    (r"\\([%&_#$(){}\[\]])", r"\1"), (rf"\\(?:{'|'.join(LAYOUT)})(?![A-Za-z])\*?[ \t]?", ""),
    (r"''+", ""), (r"\*\*+", ""), (r"~~", ""), (r"(?<!\w)__(?=[^\s_])([^\n]*?[^\s_])__(?!\w)", r"\1"),
    (r"(?<![\w*])\*(?=[^\s*])([^*\n]*[^\s*])\*(?![\w*])", r"\1"), (r"(?<![\w_])_(?=[^\s_])([^_\n]*[^\s_])_(?![\w_])", r"\1"), (r"```", ""),
)]

_SYMBOL = re.compile(r"(\\[A-Za-z]+(?:[_^](?:\{[^{}]*\}|[A-Za-z0-9]))*)")  # what is left of LaTeX is notation: \alpha_{1}


def _untag(m: re.Match) -> str:
    parts = _PARTS.fullmatch(m.group())
    return "\n" if parts and (parts[2].lower() in BLOCK or parts[2].lower() in ("br", "hr") or parts[2].lower().endswith(":p")) else ""

def clean(text: str | None, noise: dict[str, frozenset[str]] | None = None) -> tuple[str | None, list[tuple[str, int, int, int]]]:
    """The clean text and its blocks (kind, level, start, end); ``noise``: see :func:`drop_branches`."""
    if not text or not has_residue(text):
        return text, []
    text = re.sub("[\x02-\x04]", "", text)
    if noise:
        text = drop_branches(text, noise)
    kept: list[tuple[str, str]] = []

    def keep(kind: str):
        def put(m: re.Match) -> str:
            kept.append((kind, html.unescape(m[1])))
            return f"{_KEEP}{len(kept) - 1}{_KEEP}"
        return put

    text = "\n" + text + "\n"
    before = None
    while text != before:  # entities may hide tags, tags may hide marks; every round takes marks away
        before = text
        for pattern, kind in _VERBATIM:
            text = pattern.sub(keep(kind), text)
        for pattern, rule in _BLOCK_RULES:
            text = pattern.sub(rule, text)
        while text != (text := _TEMPLATE.sub(lambda m: _template(m[1]), text)):
            pass  # the inner before the outer ones
        for pattern, rule in _INLINE_RULES:
            text = pattern.sub(rule, text)
        text = _SYMBOL.sub(keep("formula"), text)
        text = _ANY_TAG.sub(_untag, text)
        text = re.sub(_ENTITY, lambda m: re.sub("[\x02-\x04]", "", html.unescape(m.group())), text)
    text = re.sub(r"[ \t\u00a0]*\n[ \t]*", "\n", re.sub(r"[ ]{2,}", " ", text))
    text = re.sub(r"\n{3,}", "\n\n", text).strip()
    out, blocks, open_, at = [], [], [], 0
    for m in re.finditer(rf"{_OPEN}([a-z]+)(\d):|{_CLOSE}|{_KEEP}(\d+){_KEEP}|[^{_OPEN}{_CLOSE}{_KEEP}]+", text):
        if m[1]:
            open_.append((m[1], int(m[2]), at))
        elif m[3]:
            kind, inner = kept[int(m[3])]
            inner = re.sub(rf"{_KEEP}(\d+){_KEEP}", lambda k: kept[int(k[1])][1], inner)
            out.append(inner)
            blocks.append((kind, 0, at, at + len(inner)))
            at += len(inner)
        elif m.group() == _CLOSE:
            if open_:
                kind, level, start = open_.pop()
                blocks.append((kind, level, start, at))
        else:
            out.append(m.group())
            at += len(m.group())
    return "".join(out), sorted(blocks, key=lambda b: (b[2], -b[3]))

# --- style tree -----------------------------------------------------------------------------------------------------

def branches(text: str) -> list[tuple[str, str, int, int]]:
    """Every block element's (path of names with their class or id, children, start, end), in the order of their ends."""
    return [b[:4] for b in placed_branches(text)]

def placed_branches(text: str) -> list[tuple[str, str, int, int, tuple[str, str]]]:
    """:func:`branches` with the two nodes of each: every name of the path with its place among the siblings of that name,
    from the first (``ul>1/li>2``) and from the last (``ul>-1/li>-3``); a class or id cannot hold the sign."""
    stack: list[list] = []
    opened: list[tuple[int, str, int]] = []  # by order of the starts: number of the parent, name, place
    siblings: dict[tuple[int, str], int] = {}
    found = []

    def close(end: int) -> None:
        path, start, children, number = stack.pop()
        found.append((path, " ".join(children), start, end, number))

    for m in _PARTS.finditer(text):
        name = m[2].lower()
        if name not in BLOCK or m[4]:
            continue
        if not m[1]:
            mark = re.search(r"(?i)\b(?:class|id)\s*=\s*[\"']?([^\"'\s>]+)", m[3] or "")
            label = name + (f".{mark[1]}" if mark else "")
            if stack:
                stack[-1][2].append(label)
            parent = stack[-1][3] if stack else -1
            siblings[parent, label] = place = siblings.get((parent, label), 0) + 1
            stack.append([(stack[-1][0] + "/" if stack else "") + label, m.start(), [], len(opened)])
            opened.append((parent, label, place))
        elif any(x[0].rsplit("/", 1)[-1].split(".")[0] == name for x in stack):
            while stack[-1][0].rsplit("/", 1)[-1].split(".")[0] != name:
                close(m.start())
            close(m.end())
    while stack:
        close(len(text))
    nodes: list[tuple[str, str]] = []
    for parent, label, place in opened:
        first, last = (x + "/" for x in nodes[parent]) if parent >= 0 else ("", "")
        nodes.append((f"{first}{label}>{place}", f"{last}{label}>{place - siblings[parent, label] - 1}"))
    return [(*b[:4], nodes[b[4]]) for b in found]

def _words(branch: str) -> set[str]:
    return set(re.findall(r"\w+", _ANY_TAG.sub(" ", branch).lower()))

def drop_branches(text: str, noise: dict[str, frozenset[str]]) -> str:
    """``text`` without the branches of the nodes of ``noise`` that say what their host's pages say there: at least half of a
    branch's words are among the node's usual ones."""
    def usual(branch: str, node: str) -> bool:
        own = _words(branch)
        return len(own & noise[node]) * 2 >= len(own)

    cuts, out, at = sorted((s, e) for _, _, s, e, nodes in placed_branches(text) if any(n in noise and usual(text[s:e], n) for n in nodes)), [], 0
    for start, end in cuts:
        if start >= at:
            out.append(text[at:start])
        at = max(at, end)
    return "".join(out) + text[at:]

def noise_paths(marked: DataFrame, threshold: float = 0.15, least_pages: int = 20) -> DataFrame:
    """(host, noise): nodes of low importance per host with their usual words (on at least half of the pages that have the
    node), from all distinct pages of ``marked`` (host, key, text) with elements.

    With m pages that have a node, the presentation's importance is the entropy of its children's patterns to base m;
    the content's is one less the mean, over its words, of the word's entropy over the pages (ln n / ln m for a word on n
    of them).  A node on fewer than ``least_pages`` pages is never noise.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(h, nodes, s, sorted(_words(t[a:b])))
                    for h, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                    for path, s, a, b, nodes in placed_branches(t) if path.rsplit("/", 1)[-1].split(".")[0] not in LABELS]
            columns = list(zip(*rows)) if rows else [[], [], [], []]
            kinds = (pa.string(), pa.list_(pa.string()), pa.string(), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["host", "nodes", "style", "words"])

    pages = marked.where(F.col("text").contains("<")).select("host", "text").distinct()  # copies of a page are one page
    seen = cut(pages.mapInArrow(run, "host string, nodes array<string>, style string, words array<string>"))
    seen = seen.select("host", F.explode("nodes").alias("path"), "style", "words")
    styles = seen.groupBy("host", "path", "style").agg(F.count(F.lit(1)).alias("n"))
    look = styles.groupBy("host", "path").agg(F.sum("n").alias("m"), F.sum(F.col("n") * F.log("n")).alias("nln"))
    words = seen.select("host", "path", F.explode("words").alias("word")).groupBy("host", "path", "word").agg(F.count(F.lit(1)).alias("n"))
    content = words.groupBy("host", "path").agg(F.avg(F.log("n")).alias("lnn"))
    joined = look.where(F.col("m") >= least_pages).join(content, ["host", "path"], "left")
    presentation = (F.log("m") - F.col("nln") / F.col("m")) / F.log("m")
    importance = F.greatest(presentation, 1 - F.coalesce("lnn", F.lit(0.0)) / F.log("m"))
    low = joined.where(importance < threshold).select("host", "path", "m")
    usual = words.join(low, ["host", "path"]).where(F.col("n") * 2 >= F.col("m")).groupBy("host", "path").agg(F.collect_list("word").alias("words"))
    nodes = low.join(usual, ["host", "path"], "left").select("host", F.struct("path", F.coalesce("words", F.array().cast("array<string>")).alias("words")).alias("node"))
    return nodes.groupBy("host").agg(F.array_sort(F.collect_list("node")).alias("noise"))

def residue(df: DataFrame) -> DataFrame:
    """The rows of ``df`` (field, row_key, host, text) whose text carries residue; no shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([has_residue(t) for t in batch.column("text").to_pylist()], pa.bool_()))

    return df.mapInArrow(run, df.schema)

def clean_texts(df: DataFrame) -> DataFrame:
    """(field, row_key, clean, blocks) of every row of ``df`` (field, row_key, host, text) that carries residue."""
    df = df.select("field", "row_key", F.coalesce("host", F.lit("")).alias("host"), "text")
    marked = cut(residue(df))
    noise = cut(noise_paths(marked))
    # few hosts have noise: a checked size is sent to the pages where they lie, a larger one is joined by host
    ready = marked.join(F.broadcast(noise) if noise.count() <= MAX_SENT_HOSTS else noise, "host", "left")
    kind = pa.list_(pa.struct([("kind", pa.string()), ("level", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [clean(t, {x["path"]: frozenset(x["words"]) for x in n or ()}) for t, n in zip(batch.column("text").to_pylist(), batch.column("noise").to_pylist())]
            blocks = [[dict(zip(("kind", "level", "start", "end"), b)) for b in bs] for _, bs in done]
            yield pa.RecordBatch.from_arrays(
                [batch.column("field"), batch.column("row_key"), pa.array([c for c, _ in done], pa.string()), pa.array(blocks, kind)],
                ["field", "row_key", "clean", "blocks"])

    return ready.mapInArrow(run, "field string, row_key string, clean string, blocks array<struct<kind:string,level:int,start:int,end:int>>")
