"""Settings and rule tables in the plain subset of YAML: nested maps, lists, scalars and comments, by indentation."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


def scalar(text: str) -> object:
    t = text.strip()
    if t[:1] in "'\"" and t[-1:] == t[:1] and len(t) >= 2:
        return t[1:-1]
    if t in ("", "~", "null"):
        return None
    if t in ("true", "false"):
        return t == "true"
    if re.fullmatch(r"[+-]?\d+", t):
        return int(t)
    if re.fullmatch(r"[+-]?\d+\.\d+", t):
        return float(t)
    if t.startswith("[") and t.endswith("]"):
        return [scalar(x) for x in t[1:-1].split(",") if x.strip()]
    return t


_KEY = re.compile(r"""^("[^"]*"|'[^']*'|[^\s'"#:\-\[{][^:#]*?)\s*:(?:\s+(.*))?$""")


def parse(text: str) -> object:
    """The value of a document; an empty one is an empty map."""
    lines = []
    for raw in text.splitlines():
        line = re.sub(r"""^((?:[^'"#]|'[^']*'|"[^"]*")*?)(?:\s#.*|#.*)?$""", r"\1", raw).rstrip() if "#" in raw else raw.rstrip()
        if line.strip() and line.strip() != "---":
            lines.append((len(line) - len(line.lstrip()), line.strip()))
    value, _ = _block(lines, 0, lines[0][0] if lines else 0)
    return {} if value is None else value


def _block(lines: list[tuple[int, str]], i: int, indent: int) -> tuple[object, int]:
    out: object = None
    while i < len(lines) and lines[i][0] == indent:
        text = lines[i][1]
        if text.startswith("- ") or text == "-":
            out = [] if out is None else out
            rest = text[1:].strip()
            inner = indent + len(text) - len(rest) if rest else indent + 1
            if _KEY.match(rest):
                lines[i] = (inner, rest)  # a map that begins on the line of its mark
                value, i = _block(lines, i, inner)
            elif rest:
                value, i = scalar(rest), i + 1
            else:
                i += 1
                value, i = _block(lines, i, lines[i][0]) if i < len(lines) and lines[i][0] > indent else (None, i)
            out.append(value)
            continue
        m = _KEY.match(text)
        if not m:
            raise ValueError(f"not understood: {text}")
        out = {} if out is None else out
        key = str(scalar(m[1]))
        i += 1
        if m[2]:
            out[key] = scalar(m[2])
        elif i < len(lines) and (lines[i][0] > indent or (lines[i][0] == indent and lines[i][1].startswith("-"))):
            out[key], i = _block(lines, i, lines[i][0])
        else:
            out[key] = None
    return out, i


def rules(spark: SparkSession, text: str, key: str = "rules") -> DataFrame:
    """(id, field, value): the entries of a rule table in long form, to be joined like any other table."""
    table = parse(text)
    entries = table.get(key, []) if isinstance(table, dict) else table
    rows = [(str(e.get("id")), str(k), None if v is None else str(v)) for e in entries for k, v in e.items() if k != "id"]
    return spark.createDataFrame(rows, "id string, field string, value string")
