"""Scores, timings and poses from the text docking programs leave behind."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from screenlake import fixed_values as fv


@dataclass(frozen=True)
class ProgramRule:
    """How to find the score in a program's log.

    `pattern` has one group holding the score. `names` match exactly, `prefixes` also
    match longer names. `last` takes the last hit in the log instead of the first, and
    `marker` looks only at the first line holding that text.
    """

    names: tuple[str, ...]
    pattern: str
    prefixes: tuple[str, ...] = ()
    last: bool = False
    marker: str = ""

    def matches(self, program: Column) -> Column:
        hit = program.isin(*self.names) if self.names else F.lit(False)
        for prefix in self.prefixes:
            hit = hit | program.startswith(prefix)
        return hit

    def score(self, log: Column) -> Column:
        if self.marker:
            log = F.regexp_extract(log, rf"(?m)^.*{self.marker}.*$", 0)
        if self.last:
            found = F.regexp_extract_all(log, F.lit(self.pattern), F.lit(1))
            text = F.try_element_at(found, F.lit(-1))
        else:
            text = F.regexp_extract(log, self.pattern, 1)
        return F.trim(text).try_cast("double")


# Log patterns of the supported programs. `[ \t]` keeps a match on one line.
DEFAULT_RULES: tuple[ProgramRule, ...] = (
    ProgramRule(fv.VINA_PROGRAMS, r"(?m)^[ \t]+1[ \t]+([-0-9.]+)\s", fv.VINA_PREFIXES),
    ProgramRule((), r"(?m)^1    [ \t]*([-0-9.]+)", fv.SMINA_PREFIXES, last=True),
    ProgramRule(fv.ADFR_PROGRAMS, r"^.*: (.*)$", marker="FEB"),
    ProgramRule(fv.PLANTS_PROGRAMS, r"^[^,]*,([^,]*)", marker="conf_01"),
)

_extra_rules: dict[str, ProgramRule] = {}


def register_program(name: str, pattern: str, last: bool = False) -> None:
    """Add a program; `pattern` has one group holding the score."""
    _extra_rules[name] = ProgramRule((name,), pattern, last=last)


def unregister_program(name: str) -> None:
    _extra_rules.pop(name, None)


def rules() -> tuple[ProgramRule, ...]:
    return tuple(_extra_rules.values()) + DEFAULT_RULES


def is_known_program(program: Column) -> Column:
    known = F.lit(False)
    for rule in rules():
        known = known | rule.matches(program)
    return F.coalesce(known, F.lit(False))


def score_of(program: Column, log: Column) -> Column:
    """Score in the log, null where the program is unknown or left none."""
    out = None
    for rule in rules():
        hit, value = rule.matches(program), rule.score(log)
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out


# Fixed value: the block the timing wrapper prints, ` user real system` then three numbers.
TIMING_PATTERN = r"user real system[ \t]*\n[ \t]*([0-9.]+)[ \t]+([0-9.]+)[ \t]+([0-9.]+)"


def timing_of(log: Column, part: str) -> Column:
    group = {"user": 1, "real": 2, "system": 3}[part]
    return F.regexp_extract(log, TIMING_PATTERN, group).try_cast("double")


def first_pose_of(text: Column) -> Column:
    """Text up to and including the line of the first `ENDMDL`; null without one."""
    mark = F.locate("ENDMDL", text)
    rest = F.substr(text, mark)
    return F.when(mark > 0, F.concat(F.substr(text, F.lit(1), mark - 1), F.substring_index(rest, "\n", 1)))


def one_place(value: Column) -> Column:
    """Text with one decimal, rounded as C and Python print it: exact value, ties to even.

    The fraction is scaled by a power of two into a whole number, which is exact, and rounded
    there; a score below 2**-7 cannot be near a tie, so its lost bits do not matter.
    """
    unit = 1 << 59
    size = F.abs(value)
    scaled = ((size - F.floor(size)) * float(unit)).cast("long") * 10
    digit, rest = F.shiftright(scaled, 59), scaled.bitwiseAND(F.lit(unit - 1))
    up = (rest > unit // 2) | ((rest == unit // 2) & (digit % 2 == 1))
    tenths = F.floor(size) * 10 + digit + F.when(up, 1).otherwise(0)
    sign = F.when(value < 0, "-").otherwise("")
    whole = F.floor(tenths / 10).cast("long").cast("string")
    return F.when(value.isNotNull(), F.concat(sign, whole, F.lit("."), (tenths % 10).cast("string")))


def histogram_bin(score: Column) -> Column:
    """Bin 23: s >= 0; 0: -5 < s < 0; 1-20: half a unit each from -5 down; 21: from -15; 22: from -20."""
    depth = -score.cast("double")
    return (
        F.when(depth <= 0, 23)
        .when(depth < 5, 0)
        .when(depth < 15, F.floor((depth - 5) * 2).cast("int") + 1)
        .when(depth < 20, 21)
        .when(depth.isNotNull(), 22)
    )
