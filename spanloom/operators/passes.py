"""Declarative passes: classes and attributes to prompt, response schema, validator and drift; requests and their estimate."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import Column, DataFrame, functions as F, types as T

from spanloom.operators.records import drift
from spanloom.operators.spans import fixed_windows, piece

#: The shape of a request and the constants of its estimate.
TEMPERATURE, MOST_OUTPUT = 0, 16_384
CHARS_PER_TOKEN, OUTPUT_PER_REQUEST = 4.15, 400


@dataclass
class Attribute:
    name: str
    type: str = "string"
    values: list[str] = field(default_factory=list)


@dataclass
class FactClass:
    name: str
    description: str
    attributes: dict[str, Attribute]
    examples: list[dict] = field(default_factory=list)
    absence: dict[str, str] | None = None


@dataclass
class Pass:
    name: str
    version: str
    classes: dict[str, FactClass]
    applies_to: list[str] = field(default_factory=list)
    sections: list[str] | None = None
    window_chars: int = 30_000
    text_source: str = "full_text"
    anchor_radius: int = 1_500

    @classmethod
    def of(cls, raw: dict, vocabulary: Callable[[str], list[str]]) -> Pass:
        """A pass from its parsed definition; ``vocabulary`` resolves the closed lists by name."""
        def attribute(name: str, spec: dict) -> Attribute:
            return Attribute(name, spec.get("type", "string"), [str(v) for v in vocabulary(spec["vocabulary"])] if spec.get("vocabulary") else [])

        classes = {n: FactClass(n, c.get("description", ""), {a: attribute(a, s or {}) for a, s in (c.get("attributes") or {}).items()}, c.get("examples") or [], c.get("absence_attributes"))
                   for n, c in raw["classes"].items()}
        rest = {k: raw[k] for k in ("sections", "window_chars", "text_source", "anchor_radius") if k in raw}
        return cls(raw["pass"], str(raw["version"]), classes, list(raw.get("applies_to") or []), **rest)

    @classmethod
    def load(cls, path: str, vocabularies: str) -> Pass:
        """A pass from YAML files."""
        import yaml

        return cls.of(yaml.safe_load(Path(path).read_text()), lambda name: yaml.safe_load(Path(vocabularies, f"{name}.yaml").read_text())["values"])

    def prompt(self, preamble: str | None = None) -> tuple[str, str]:
        """What stands before and after the text in every prompt of the pass."""
        lines = ["Extract evidence-linked facts from the text of a publication.", *([preamble] if preamble else []),
                 "Answer with JSON that matches the response schema.", "Rules:",
                 "- source_quote is copied verbatim from the text, one stretch of at most 300 characters.",
                 "- Give every attribute; use \"not_stated\" where the text gives no value; one value an attribute.",
                 "- Prefer listed values; a stated value outside the list is given as written.",
                 "- One record a fact; an empty list for a class without facts; nothing from outside the text."]
        for c in self.classes.values():
            lines += [f"Class {c.name}: {c.description.strip()}"]
            for a in c.attributes.values():
                kind = "list of" if a.type == "array" else "one of" if a.values else ""
                lines.append(f"  {a.name}: {kind} {json.dumps(a.values) if a.values else 'text as written'}".replace("  text", " text"))
            for e in c.examples:
                shown = [{"source_quote": x["span"]} | {k: v for k, v in x.items() if k != "span"} for x in e["extractions"]]
                lines.append(f"  Example: {json.dumps(e['text'], ensure_ascii=False)} -> {json.dumps({c.name: shown}, ensure_ascii=False)}")
        return "\n".join([*lines, "Text:", "<<<", ""]), "\n>>>"

    def response_schema(self) -> dict:
        """The response's JSON schema; closed lists are not enforced, so that drift shows."""
        kind = lambda a: {"type": "ARRAY", "items": {"type": "STRING"}} if a.type == "array" else {"type": "STRING"}
        item = lambda c: {"type": "OBJECT", "properties": {"source_quote": {"type": "STRING"}} | {a.name: kind(a) for a in c.attributes.values()}, "required": ["source_quote", *c.attributes]}
        return {"type": "OBJECT", "properties": {n: {"type": "ARRAY", "items": item(c)} for n, c in self.classes.items()}, "required": list(self.classes)}

    def payload_type(self) -> T.StructType:
        """The same as a Spark type, every attribute as a string (lists as JSON)."""
        item = lambda c: T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("source_quote", *c.attributes)]))
        return T.StructType([T.StructField(n, item(c)) for n, c in self.classes.items()])

    def issues(self, response: object) -> list[str]:
        """What is structurally wrong with a parsed response; empty if nothing."""
        if not isinstance(response, dict):
            return ["not an object"]
        out = []
        for name, c in self.classes.items():
            items = response.get(name, None)
            if name not in response:
                out.append(f"{name}: missing")
            elif not isinstance(items, list):
                out.append(f"{name}: not a list")
            else:
                for i, x in enumerate(items):
                    if not isinstance(x, dict):
                        out.append(f"{name}[{i}]: not an object")
                        continue
                    out += [f"{name}[{i}]: no source_quote"] * (not x.get("source_quote")) + [f"{name}[{i}]: no {a}" for a in c.attributes if a not in x]
        return out

    def drift(self, cls: str, attributes: Column) -> Column:
        own = self.classes[cls].attributes.values()
        return drift(attributes, {a.name: a.values for a in own}, [a.name for a in own if a.type == "array"])


def request_config(schema: dict, most: int = MOST_OUTPUT) -> Column:
    """The settings of a request as an object."""
    config = F.lit(json.dumps({"responseMimeType": "application/json", "responseSchema": schema, "temperature": TEMPERATURE, "maxOutputTokens": most}))
    return F.from_json(config, F.schema_of_json(config))


def requests(texts: DataFrame, p: Pass, windows: DataFrame | None = None, preamble: str | None = None) -> DataFrame:
    """(key, doc_id, window_index, window_start, window_end, request): one request per (document, window).

    Without ``windows`` (doc_id, window_index, window_start, window_end) every text is cut into fixed ones.
    """
    before, after = p.prompt(preamble)
    t = texts.where("text IS NOT NULL").select("doc_id", "text")
    w = fixed_windows(t, F.length("text"), p.window_chars) if windows is None else t.join(windows, "doc_id")
    body = F.concat(F.lit(before), piece(F.col("text"), F.col("window_start"), F.col("window_end")), F.lit(after))
    request = F.struct(F.array(F.struct(F.lit("user").alias("role"), F.array(F.struct(body.alias("text"))).alias("parts"))).alias("contents"), request_config(p.response_schema()).alias("generationConfig"))
    return w.select(F.concat_ws("|", "doc_id", "window_index", "window_start").alias("key"), "doc_id", "window_index", "window_start", "window_end", request.alias("request"))


def estimate(reqs: DataFrame, rate_in: float, rate_out: float, thinking: float = 0.0) -> DataFrame:
    """One row: requests, tokens in and out, cost; rates are for a million tokens."""
    chars = F.sum(F.length(F.col("request.contents")[0]["parts"][0]["text"]))
    n = F.count(F.lit(1))
    tokens_in = F.floor(F.coalesce(chars, F.lit(0)) / CHARS_PER_TOKEN)
    tokens_out = F.floor(n * OUTPUT_PER_REQUEST * (1 + thinking))
    return reqs.agg(n.alias("n_requests"), tokens_in.alias("tokens_in"), tokens_out.alias("tokens_out"), F.round((tokens_in * rate_in + tokens_out * rate_out) / 1e6, 6).alias("cost"))
