"""JSON of model responses: strict, extracted, repaired, rebuilt."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

RESULTS = "array<struct<id:string,summary:string>>"


def label_map(c: Column) -> Column:
    """Strict parse to map<string,string>; null where the text is no object."""
    return F.from_json(c, "map<string,string>")


def json_string(c: Column) -> Column:
    """A string as JSON text; null as null."""
    return F.regexp_replace(F.to_json(F.array(c)), r"^\[|\]$", "")


def comments_json(keys: Column, values: Column) -> Column:
    """Two arrays as one JSON object: of equal keys the last counts, null keys are left out."""
    later = lambda i: F.slice(keys, i + 2, F.size(keys))
    pairs = F.zip_with(keys, values, lambda k, v: F.struct(k.alias("k"), v.alias("v")))
    pairs = F.filter(pairs, lambda x, i: x.k.isNotNull() & ~F.array_contains(F.coalesce(later(i), F.array()), x.k))
    return F.concat(F.lit("{"), F.array_join(F.transform(pairs, lambda x: F.concat(json_string(x.k), F.lit(":"), json_string(x.v))), ","), F.lit("}"))


def json_part(c: Column) -> Column:
    """The JSON inside a response: a fenced block, else from the first brace to the last."""
    fenced, braced = F.regexp_extract(c, r"(?s)```json(.*?)(?:```|$)", 1), F.regexp_extract(c, r"(?s)(\{.*\})", 1)
    picked = F.when(F.contains(c, F.lit("```json")), fenced).when(braced != "", braced).otherwise(c)
    return F.regexp_replace(F.replace(picked, F.lit("```"), F.lit("")), F.lit(r"^\s+|\s+$"), F.lit(""))


def part_of(response: str) -> str:
    """json_part() of one string."""
    found = re.search(r"(?s)```json(.*?)(?:```|$)", response) or re.search(r"(?s)(\{.*\})", response)
    return (found[1] if found else response).replace("```", "").strip()


def rebuilt(whole: str, headings: Sequence[str]) -> list[str]:
    """Summaries out of a response that is no JSON: each text after the first heading, up to the next
    numbered line, followed by the first text after each further heading."""

    def texts(k: int) -> list[str]:
        end = rf"(?:\n|\\n){k + 2}\.|$" if k + 1 < len(headings) else r"\n|\\n|$"
        return [x.strip() for x in re.findall(rf"(?s){re.escape(headings[k])}(.*?)(?:{end})", whole)]

    more = [h + x[0] for k, h in enumerate(headings) if k and (x := texts(k))]
    return ["\n".join([headings[0] + x, *more]) for x in texts(0)]


def merged(a: Column, b: Column) -> Column:
    """Two maps as one; b's values win."""
    return F.map_concat(F.map_filter(a, lambda k, _: ~F.map_contains_key(b, k)), b)


#: A property name without quotes.
_BARE = re.compile(r"([A-Za-z_]\w*)\s*:")


def repair(raw: str) -> str:
    """One pass over the characters: raw line breaks inside strings are escaped, missing commas between
    values and stray ones before a bracket are mended, bare property names are quoted, and what is open at the end is closed."""
    out: list[str] = []
    opened: list[str] = []
    inside = skip = False
    after = 0
    for i, ch in enumerate(raw):
        if i < after:
            continue
        if inside:
            if skip:
                skip = False
            elif ch == "\\":
                skip = True
            elif ch == '"':
                rest = raw[i + 1 :].lstrip()
                if rest[:1] in ("", ",", ":", "}", "]", '"', "{") or rest[:3] == "```":
                    inside = False
                else:
                    ch = '\\"'  # a quote inside the string
            out.append({"\n": "\\n", "\r": "\\r", "\t": "\\t"}.get(ch, ch))
            continue
        last = next((x for x in reversed(out) if not x.isspace()), "")
        if last in ("{", ",") and (name := _BARE.match(raw, i)):
            out.append(f'"{name[1]}":')
            after = name.end()
            continue
        if ch in "\"{[" and last in ('"', "}", "]"):
            out.append(",")
        if ch in "}]" and last == ",":
            del out[len(out) - 1 - out[::-1].index(",")]
        if ch == '"':
            inside = True
        elif ch in "{[":
            opened.append("}" if ch == "{" else "]")
        elif ch in "}]" and opened:
            opened.pop()
        out.append(ch)
    return "".join([*out, '"' if inside else "", *reversed(opened)])


def _pairs(value) -> list[tuple[str, str]] | None:
    if not isinstance(value, dict) or not isinstance(value.get("results"), list):
        return None
    return [(str(x.get("id", "")), str(x.get("summary", ""))) for x in value["results"] if isinstance(x, dict)]


def parse_response(whole: str | None, part: str | None) -> list[tuple[str, str]]:
    """(id, summary) pairs of a response: strict, repaired, by matching ids and summaries of equal
    number, or by the sections between ids."""
    for attempt in (lambda: part or "", lambda: repair(part or "")):
        try:
            got = _pairs(json.loads(attempt(), strict=False))
        except ValueError:
            continue
        if got is not None:
            return got
    ids = re.findall(r'"id"\s*:\s*"(id\d+)"', whole or "")
    said = re.findall(r'"summary"\s*:\s*"((?:[^"\\]|\\.)*)"', whole or "")
    if ids and len(ids) == len(said):
        return [(i, s.replace("\\n", "\n").replace('\\"', '"')) for i, s in zip(ids, said, strict=True)]
    sections = re.split(r'"id"\s*:\s*"id\d+"', whole or "")[1:]
    found = [(f"id{i}", re.sub(r'^[\s,]*"summary"\s*:\s*"?', "", x).strip(' \n",{}[]')) for i, x in enumerate(sections, 1)]
    return [(i, x) for i, x in found if x]


@F.pandas_udf(ArrayType(StructType([StructField("id", StringType()), StructField("summary", StringType())])))
def _resilient(whole: pd.Series, part: pd.Series) -> pd.Series:
    return pd.Series([[{"id": i, "summary": s} for i, s in parse_response(w, p)] for w, p in zip(whole, part, strict=True)])


def results(c: Column) -> Column:
    """array<struct<id,summary>> of a response, as far as it can be read; empty for null."""
    return _resilient(c, json_part(c))


def strict_results(c: Column) -> Column:
    """The same for well-formed responses, natively; null where the text is not."""
    return F.from_json(json_part(c), f"struct<results:{RESULTS}>")["results"]
