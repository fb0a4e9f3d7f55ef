"""Ligand checks. A ligand is one row with its whole file in `content`, so no check shuffles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenlake import fixed_values as fv

# The element as a word; the white space before it must be on the same line.
_WORD = rf"[ \t\f\r\x0B]({'|'.join(fv.UNSUPPORTED_ELEMENTS)})\s"


# Fields 6-8 of a line, or as many of them as there are.
_COORDS = r"^\s*+(?:\S++\s++){5}(\S++(?:\s++\S++){0,2}+)"


def _line_at(text: Column, position: Column) -> Column:
    """1-based number of the line holding a 1-based character position."""
    head = F.substr(text, F.lit(1), position)
    return F.length(head) - F.length(F.replace(head, F.lit("\n"))) + 1


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with value computed once, also where the optimizer copies the expression."""
    return F.transform(F.array(value), use)[0]


def _element(text: Column, dialect: str) -> Column:
    if dialect == "shell":
        first, *others = fv.UNSUPPORTED_ELEMENTS
        found = F.when(text.contains(f" {first} "), first)
        for name in others:
            found = found.when(F.lower(text).contains(f" {name.lower()} "), name)
        return found
    return F.nullif(F.regexp_extract(text, _WORD, 1), F.lit(""))


def _element_line(text: Column, dialect: str) -> Column:
    if dialect == "shell":
        return F.lit(None).cast("int")
    position = F.regexp_instr(text, F.lit(_WORD))
    return F.when(position > 0, _line_at(text, position))


def _duplicate_line(text: Column, dialect: str, include_hetatm: bool) -> Column:
    """Sorting a file's (fields, line) pairs puts copies side by side: n log n per ligand."""

    def keyed(line: Column, index: Column) -> Column:
        fields = F.regexp_replace(F.regexp_extract(line, _COORDS, 1), r"\s+", ":")
        is_atom = line.contains("ATOM") if dialect == "shell" else line.startswith("ATOM")
        if include_hetatm:
            is_atom = is_atom | line.startswith("HETATM")
        return F.struct(
            F.when(is_atom, fields).alias("key"), (index + 1).alias("line")
        )

    def second_of_pair(atoms: Column) -> Column:
        n = F.greatest(F.size(atoms) - 1, F.lit(0))
        pairs = F.arrays_zip(F.slice(atoms, F.lit(1), n).alias("a"), F.slice(atoms, F.lit(2), n).alias("b"))
        return F.filter(pairs, lambda p: p["a"]["key"] == p["b"]["key"])

    atoms = F.filter(F.transform(F.split(text, "\n"), keyed), lambda a: a["key"].isNotNull())
    repeats = _let(F.sort_array(atoms), second_of_pair)
    return F.array_min(F.transform(repeats, lambda p: p["b"]["line"]))


def flag_elements(ligands: DataFrame, dialect: str = "aws", col: str = "content") -> DataFrame:
    """Add `element`: the unsupported element found, else null, and `element_line`.

    aws: first line with the element as a word between white space. shell: B, then Si, then
    Sn between blanks anywhere, Si and Sn in any case; `element_line` is null there.
    """
    text = F.col(col)
    return ligands.withColumns({"element": _element(text, dialect), "element_line": _element_line(text, dialect)})


def flag_duplicate_coords(
    ligands: DataFrame, dialect: str = "aws", include_hetatm: bool = False, col: str = "content"
) -> DataFrame:
    """Add `duplicate_line`: first line repeating fields 6-8 of an earlier ATOM line, else null.

    ATOM lines start with the word (aws) or hold it anywhere (shell); HETATM lines count only
    with `include_hetatm`. Fields are compared as text.
    """
    return ligands.withColumn("duplicate_line", _duplicate_line(F.col(col), dialect, include_hetatm))


def ligand_verdict(
    ligands: DataFrame,
    precedence: str = "aws",
    include_hetatm: bool = False,
    col: str = "content",
) -> DataFrame:
    """Add `verdict` (`ok` or the failure text) and `info` for the status list.

    aws: the earliest offending line decides, the element first on a shared line.
    shell: B, Si, Sn, then coordinates.
    """
    def judge(found: Column) -> Column:
        element, line, duplicate = found["element"], found["element_line"], found["duplicate_line"]
        by_element = element.isNotNull()
        if precedence == "aws":
            by_element = by_element & (duplicate.isNull() | (line <= duplicate))
        verdict = (
            F.when(by_element, F.concat(F.lit(fv.FAILED_ELEMENTS), element, F.lit(")")))
            .when(duplicate.isNotNull(), fv.FAILED_COORDINATES)
            .otherwise("ok")
        )
        info = F.when(by_element, F.concat(F.lit(fv.ELEMENTS_INFO), element)).when(
            duplicate.isNotNull(), fv.COORDINATES_INFO
        )
        return F.struct(verdict.alias("verdict"), info.alias("info"))

    text = F.col(col)
    found = F.struct(
        _element(text, precedence).alias("element"),
        _element_line(text, precedence).alias("element_line"),
        _duplicate_line(text, precedence, include_hetatm).alias("duplicate_line"),
    )
    return (
        ligands.withColumn("_judged", _let(found, judge))
        .withColumns({"verdict": F.col("_judged.verdict"), "info": F.col("_judged.info")})
        .drop("_judged")
    )


def with_smiles(ligands: DataFrame, col: str = "content") -> DataFrame:
    """Add `smiles`: last field of the first line holding `SMILES`, else null."""
    line = F.rtrim(F.regexp_extract(F.col(col), r"(?m)^.*SMILES.*$", 0))
    return ligands.withColumn("smiles", F.nullif(F.regexp_extract(line, r"(\S+)\s*$", 1), F.lit("")))
