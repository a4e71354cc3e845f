"""JSON access through VARIANT: absent, null, wrong type and empty stay apart.

Paths are read from a variant column given by name.  The expressions are built as SQL
text: a claim needs dozens of them, and one parse per expression is cheaper for the
driver than a call per node.

Every look-up by path compares the names of the fields before it and copies what it finds.
A document read under a ``Shape`` is cast once to a struct instead, which meets every field
once; the functions below answer from the struct where it settles the question, and look up
the path only for what is missing or odd.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Double backslashes: these texts are SQL string literals.
EMPTY_JSON = (
    r'^(null|""|false|\\[\\]|\\{\\}|-?0+(\\.0*)?([eE][+-]?[0-9]+)?)$'
)


LEAVES = {"variant": ["text", "kind"], "number": ["text", "kind", "double"]}


class Shape(str):
    """Name of a variant column, with what columns ``<name>_parts`` and ``<name>_leaves`` hold of it.

    A shape is a dict of fields; a field is a dict (an object), a list of one shape (an array),
    ``string``, ``variant`` or ``number``.  Strings settle texts; a variant settles type and presence
    as well, and has its text and type word among the leaves, a number its double too.  ``texts`` are
    paths looked up once: the first code of a long list costs less so than a cast of all codes.
    """

    def __new__(cls, name: str, fields: dict, texts: tuple[str, ...] = ()):
        self = super().__new__(cls, name)
        self.parts, self.leaves, self.type, self.known = f"{name}_parts", f"{name}_leaves", _type_of(fields), {}
        self._add(fields, self.parts, "")
        self.texts = texts
        self.known |= {path: (self.leaf(path, "text"), "string") for path in texts}
        return self

    @property
    def columns(self) -> list[str]:
        return [str(self), self.parts, self.leaves]

    def _add(self, shape, sql: str, path: str) -> None:
        if path:
            self.known[path] = (sql, {dict: "object", list: "array"}.get(type(shape), shape))
        if isinstance(shape, dict):
            for name, child in shape.items():
                self._add(child, f"{sql}.{name}", f"{path}.{name}" if path else name)
        elif isinstance(shape, list):
            self._add(shape[0], f"get({sql}, 0)", f"{path}[0]")

    def leaf(self, path: str, what: str) -> str:
        return f"{self.leaves}.{re.sub('[^A-Za-z0-9]+', '_', path)}_{what}"

    def read(self, df: DataFrame) -> DataFrame:
        """``df`` with the parts and leaves of the variant column.

        Both go through one-element explodes, below which no filter is pushed: the optimizer would repeat the
        cast per reference.
        """
        fields = []
        for path, (sql, held) in self.known.items():
            if held in LEAVES:
                found = {
                    "text": f"try_variant_get({sql}, '$', 'string')", "kind": _word(sql),
                    "double": f"try_variant_get({sql}, '$', 'double')",
                }
                for what in LEAVES[held]:
                    fields += [f"'{self.leaf(path, what).partition('.')[2]}'", found[what]]
        for path in self.texts:
            fields += [f"'{self.leaf(path, 'text').partition('.')[2]}'", _look_up(self, path, "string")]
        cast = F.expr(f"try_variant_get({self}, '$', '{self.type}')")
        out = df.withColumn(self.parts, F.explode(F.array(cast)))
        return out.withColumn(self.leaves, F.explode(F.array(F.expr(f"named_struct({', '.join(fields)})"))))


def _type_of(shape) -> str:
    if isinstance(shape, dict):
        return f"struct<{', '.join(f'{n}: {_type_of(s)}' for n, s in shape.items())}>"
    if isinstance(shape, list):
        return f"array<{_type_of(shape[0])}>"
    return "variant" if shape in LEAVES else shape


def _known(v: str, path: str) -> tuple[str | None, str | None]:
    """(SQL of the part, its kind) at a path the shape holds."""
    return v.known.get(path, (None, None)) if isinstance(v, Shape) else (None, None)


def parse(text: Column) -> Column:
    """NULL for text that is not JSON."""
    return F.try_parse_json(text)


def is_object_text(text: Column) -> Column:
    """Whether text that parses holds an object at its root."""
    return F.coalesce(F.ltrim(text, F.lit(" \t\r\n")).startswith("{"), F.lit(False))


def _look_up(v: str, path: str, dtype: str = "variant") -> str:
    return f"try_variant_get({v}, '$.{path}', '{dtype}')"


def _word(value: str) -> str:
    return f"regexp_extract(schema_of_variant({value}), '^[A-Z]+', 0)"


def _get(v: str, path: str, dtype: str = "variant") -> str:
    part, held = _known(v, path)
    if held in LEAVES:
        what = {"string": "text", "double": "double"}.get(dtype)
        if what in LEAVES[held]:
            return v.leaf(path, what)
        return part if dtype == "variant" else f"try_variant_get({part}, '$', '{dtype}')"
    return part if held == dtype else _look_up(v, path, dtype)


def _present(v: str, path: str) -> str:
    part, held = _known(v, path)
    if held in LEAVES:
        return f"{part} IS NOT NULL"
    looked_up = f"{_look_up(v, path)} IS NOT NULL"
    return f"({part} IS NOT NULL OR {looked_up})" if held else looked_up


def _kind(v: str, path: str) -> str:
    part, held = _known(v, path)
    if held in LEAVES:
        return v.leaf(path, "kind")
    looked_up = (
        f"WHEN {_look_up(v, path + '[0]')} IS NOT NULL THEN 'ARRAY' ELSE {_word(_look_up(v, path))} END"
    )
    if held in ("object", "array"):
        return f"CASE WHEN {part} IS NOT NULL THEN '{held.upper()}' {looked_up}"
    return f"CASE {looked_up}"


def get(v: str, path: str, dtype: str = "variant") -> Column:
    return F.expr(_get(v, path, dtype))


def text(v: str, path: str, default: str | None = None) -> Column:
    """String at a path; ``default`` only where the path is absent, not where it is null."""
    if default is None:
        return get(v, path, "string")
    found = _get(v, path, "string")
    return F.expr(
        f"CASE WHEN {found} IS NOT NULL THEN {found} WHEN NOT ({_present(v, path)}) THEN '{default}' END"
    )


def present(v: str, path: str) -> Column:
    return F.expr(_present(v, path))


def part(v: Shape, path: str) -> Column:
    """The cast part of a document at a path its shape holds."""
    return F.expr(_known(v, path)[0])


def length(v: str, path: str) -> Column:
    """Number of elements of an array, or of keys of an object; 0 when absent, NULL for anything else."""
    sizes = [f"size({_look_up(v, path, t)})" for t in ("array<variant>", "map<string,variant>")]
    looked_up = f"WHEN {_look_up(v, path)} IS NULL THEN 0 ELSE coalesce({', '.join(sizes)}) END"
    held, kind_held = _known(v, path)
    if kind_held == "array":
        return F.expr(f"CASE WHEN {held} IS NOT NULL THEN size({held}) {looked_up}")
    return F.expr(f"CASE {looked_up}")


# Describing or printing a variant walks all of it.  The tests below first look for a
# first element or a known child, which settles normal documents without the walk.


def kind(v: str, path: str) -> Column:
    """Type word at a path (OBJECT, ARRAY, STRING, VOID, ...); NULL when absent."""
    return F.expr(_kind(v, path))


def kind_not_in(v: str, path: str, allowed: list[str]) -> Column:
    """True where something other than the allowed types is present."""
    names = ", ".join(f"'{a}'" for a in allowed)
    return F.expr(f"coalesce(({_kind(v, path)}) NOT IN ({names}), false)")


def is_object_or_absent(v: str, path: str, child: str) -> Column:
    """True for an object or nothing; ``child`` is the field an object normally has."""
    part, held = _known(v, path)
    settled = f"{part} IS NOT NULL OR " if held == "object" else ""
    return F.expr(
        f"{settled}{_present(v, f'{path}.{child}')} OR coalesce(({_kind(v, path)}) = 'OBJECT', true)"
    )


def truthy(v: str, path: str, child: str = "[0]") -> Column:
    """False for absent, null, empty string, zero, false, empty array and empty object.

    ``child`` is what a filled value normally has: a first element, or ``.field``.  Only
    a text that an empty value could print as needs the exact, quoted form.
    """
    printed = _look_up(v, path, "string")
    exact = f"""CASE WHEN {_look_up(v, path + child)} IS NOT NULL THEN true
          WHEN {printed} IS NULL THEN false
          WHEN {printed} IN ('', 'false', 'null', '[]', '{{}}') OR {printed} RLIKE '^-?0'
            THEN NOT to_json({_look_up(v, path)}) RLIKE '{EMPTY_JSON}'
          ELSE true END"""
    part, held = _known(v, path)
    if held == "string" or held in LEAVES:
        # Whatever is there prints as something, and only an empty string as nothing.
        printed = _get(v, path, "string")
        exact = f"""CASE WHEN {printed} IS NULL OR {printed} = '' THEN false
          WHEN {printed} IN ('false', 'null', '[]', '{{}}') OR {printed} LIKE '0%' OR {printed} LIKE '-0%'
            THEN {exact}
          ELSE true END"""
    elif held == "array":
        exact = f"CASE WHEN {part} IS NOT NULL THEN size({part}) > 0 ELSE {exact} END"
    elif held == "object":
        exact = f"CASE WHEN {_present(v, path + child)} THEN true ELSE {exact} END"
    return F.expr(exact)
