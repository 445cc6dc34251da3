"""Safe parsing and classification of raw documents.

One Arrow-batched pass gives each document's class and a generic form: the
attributes of its flames and of their direct children. All features are column
expressions over that (``features``). Entity declarations are refused. The parse
is marked by materialising it (``parsed`` is one mapInArrow node): filters on
its fields do not run it twice.
"""

from __future__ import annotations

import re
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame

_DECLARATION = re.compile(rb"^\s*<\?xml[^?]*\?>\s*", re.DOTALL)
_MAP = pa.map_(pa.string(), pa.string())
_FLAME = pa.struct([("attrs", _MAP), ("final_below", pa.bool_()), ("symmetry", pa.list_(_MAP)), ("xforms", pa.list_(_MAP)), ("finals", pa.list_(_MAP))])
FLAME_DDL = "struct<attrs: map<string,string>, final_below: boolean, symmetry: array<map<string,string>>, xforms: array<map<string,string>>, finals: array<map<string,string>>>"
_PARSED = [("kind", pa.string()), ("error", pa.string()), ("frame_count", pa.int32()), ("genome", _FLAME), ("wrapped", pa.list_(_FLAME))]
_DDL = {"kind": "string", "error": "string", "frame_count": "int", "genome": FLAME_DDL, "wrapped": f"array<{FLAME_DDL}>"}


class Refused(Exception):
    """An entity declaration."""


class Element:
    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []

    def below(self, tag: str):
        """Descendants of a name, in document order; iterative, so depth is no limit."""
        stack = self.children[::-1]
        while stack:
            e = stack.pop()
            if e.tag == tag:
                yield e
            stack += e.children[::-1]


class Outline:
    """The names of a document's elements alone: its root, and those below it."""

    def __init__(self, tags: list[str]):
        self.tag, self.inner = tags[0], tags[1:]

    def below(self, tag: str):
        return (t for t in self.inner if t == tag)


def _name(x: str) -> str:
    return "{" + x if "}" in x else x


def _parse(data: bytes, start, end=None) -> None:
    def refuse(*_):
        raise Refused("entity declarations are refused")

    p = expat.ParserCreate(namespace_separator="}")
    p.StartElementHandler, p.EndElementHandler = start, end
    p.EntityDeclHandler = p.UnparsedEntityDeclHandler = p.ExternalEntityRefHandler = refuse
    p.Parse(data, True)


def tree(data: bytes) -> Element:
    open_: list[Element] = [Element("", {})]

    def start(tag, attrs):
        e = Element(_name(tag), {_name(k): v for k, v in attrs.items()})
        open_[-1].children.append(e)
        open_.append(e)

    _parse(data, start, lambda _: open_.pop())
    return open_[0].children[0]


def outline(data: bytes) -> Outline:
    tags: list[str] = []
    _parse(data, lambda tag, _: tags.append(_name(tag)))
    return Outline(tags)


def _flame(e: Element) -> dict:
    of = lambda tag: [list(c.attrs.items()) for c in e.children if c.tag == tag]
    return {"attrs": list(e.attrs.items()), "final_below": next(e.below("finalxform"), None) is not None, "symmetry": of("symmetry"), "xforms": of("xform"), "finals": of("finalxform")}


def frames(raw: bytes) -> int:
    return raw.count(b"<flame ") + raw.count(b"<flame>")


def _wrapped(body: bytes, read=tree) -> list:
    return list(read(b"<root>" + body + b"</root>").below("flame"))


def classify(raw: bytes, read=tree) -> tuple[str, str | None, int | None, Element | Outline | str | None]:
    """(kind, error, frame count, genome) of a document; the first rule that fits.
    With ``outline`` as ``read`` the genome is no element, and the rest is the same."""
    if not raw:
        return "corrupt", "zero-byte", None, None
    body = _DECLARATION.sub(b"", raw, count=1).lstrip()
    if not body:
        return "corrupt", "empty-after-decl", None, None

    def by_number(found: list, none: str):
        if len(found) == 1:
            return "genome", None, 1, found[0]
        return ("animation", None, frames(raw), None) if found else ("corrupt", none, None, None)

    try:
        root = read(body)
    except (expat.ExpatError, Refused) as e:
        if "junk after document element" in str(e):
            return ("animation", None, frames(raw), None) if frames(raw) >= 2 else ("corrupt", "junk-after-document", None, None)
        try:
            return by_number(_wrapped(body, read), "no-flame-elements")
        except (expat.ExpatError, Refused):
            return "corrupt", f"parse: {str(e)[:80]}", None, None
    if root.tag == "flame":
        return "genome", None, 1, root
    return by_number(list(root.below("flame")), f"no-flame-in-{root.tag}")


def manifest_flames(raw: bytes, read=tree) -> list | None:
    """All flames of a document within a synthetic root; null if that fails."""
    try:
        return _wrapped(_DECLARATION.sub(b"", raw, count=1), read) or None
    except (expat.ExpatError, Refused):
        return None


def is_document(raw: bytes) -> bool:
    """Whether fetched bytes are a document: any flame at any depth."""
    return b"<flame" in raw and manifest_flames(raw.lstrip(), outline) is not None


def parsed(raw: DataFrame, *, genome: bool = True, wrapped: bool = True) -> DataFrame:
    """``raw`` (with a binary column content) and kind, error, frame_count, the
    genome's flame, and all flames for the manifest. Null content is zero-byte.
    Flames that are not asked for are neither parsed nor sent, and are no columns."""
    names = raw.columns
    at = names.index("content")
    made = [(n, t) for n, t in _PARSED if (genome or n != "genome") and (wrapped or n != "wrapped")]

    def fold(batches):
        for b in batches:
            out = []
            for raw_bytes in b.column(at).to_pylist():
                content = raw_bytes or b""
                *row, own = classify(content, tree if genome else outline)
                if genome:
                    row.append(None if own is None else _flame(own))
                if wrapped:
                    every = manifest_flames(content)
                    row.append(None if every is None else [_flame(x) for x in every])
                out.append(row)
            columns = list(zip(*out)) if out else [[]] * len(made)
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(list(c), t) for c, (_, t) in zip(columns, made)]], names=[*names, *[n for n, _ in made]])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in raw.schema.fields)
    return raw.mapInArrow(fold, f"{fields}, " + ", ".join(f"{n} {_DDL[n]}" for n, _ in made))


def kinds(raw: DataFrame) -> DataFrame:
    """(gen, byte_size, kind) of each document, as the index has them, by names
    and number of elements alone."""
    out = pa.schema([("gen", pa.int32()), ("byte_size", pa.int64()), ("kind", pa.string())])

    def fold(batches):
        for b in batches:
            contents = [x or b"" for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(x) for x in contents], pa.int64()), pa.array([classify(x, outline)[0] for x in contents], pa.string())], schema=out)

    return raw.select(raw["gen"].cast("int"), "content").mapInArrow(fold, "gen int, byte_size long, kind string")


def checked(raw: DataFrame) -> DataFrame:
    """``raw`` (with a binary column content) and valid: whether it is a document."""
    names = raw.columns
    at = names.index("content")

    def fold(batches):
        for b in batches:
            valid = pa.array([is_document(x or b"") for x in b.column(at).to_pylist()], pa.bool_())
            yield pa.RecordBatch.from_arrays([*b.columns, valid], names=[*names, "valid"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in raw.schema.fields)
    return raw.mapInArrow(fold, f"{fields}, valid boolean")
