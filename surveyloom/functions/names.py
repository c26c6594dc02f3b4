"""Header names. Pure functions over lists of strings: column metadata, never rows."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

# The header formats of the editions.
TUPLE_HEADER = r"""^\(\s*(['"])(.*?)\1\s*,\s*(['"])(.*)\3\s*\)$"""
CODE_PREFIX = r"^\d+(\.[a-zA-Z0-9]+)*[\s_]+"
UNSAFE_RUN = r"[^a-z0-9]+"

Step = dict[str, str]

# Column that orders the rows of a raw edition as its files do; it passes harmonisation under this name.
POSITION = "_position"


@lru_cache(maxsize=1)
def accent_table() -> tuple[str, str]:
    """Arguments of ``translate`` that take accents off lower-case text.

    First the characters that are an ASCII letter or digit under an accent, each with its base;
    then the combining marks, which have no counterpart and are dropped.
    """
    accented, bases, marks = [], [], []
    # Planes 2 to 13 hold ideographs only.
    for char in map(chr, chain(range(0x80, 0x20000), range(0xE0000, 0xE1000))):
        if unicodedata.category(char) == "Mn":
            marks.append(char)
        elif unicodedata.decomposition(char):
            decomposed = unicodedata.normalize("NFD", char)
            base = "".join(c for c in decomposed if unicodedata.category(c) != "Mn")
            if base.isascii() and (base.islower() or base.isdigit()):
                accented.append(char)
                bases.append(base)
    return "".join(accented + marks), "".join(bases)


@lru_cache(maxsize=1)
def _unaccent() -> dict[int, int | None]:
    accented, bases = accent_table()
    return str.maketrans(accented[:len(bases)], bases, accented[len(bases):])


def normalise_name(name: str) -> str:
    """Lower case, no accents, every run of other characters one underscore."""
    return re.sub(UNSAFE_RUN, "_", str(name).lower().translate(_unaccent())).strip("_")


def match_key(name: str) -> str:
    """Key under which two spellings of a column name are the same column."""
    return normalise_name(str(name).replace("%", "pct"))


def unwrap_tuple(header: str) -> str:
    """Label of a header written as a ``('code', 'label')`` pair, with either quote."""
    found = re.match(TUPLE_HEADER, header.strip(), flags=re.S)
    return found.group(4) if found else header


def clean_header(header: str) -> str:
    """Raw header of any edition to its plain column name."""
    label = unwrap_tuple(str(header)).strip()
    return match_key(re.sub(CODE_PREFIX, "", label))


def suffix_twins(names: Sequence[str]) -> list[str]:
    """Number repeats ``x, x_1, x_2``; a number some other column already uses is skipped."""
    taken = set(names)
    repeats: dict[str, int] = {}
    out = []
    for name in names:
        if name not in repeats:
            repeats[name] = 0
            out.append(name)
            continue
        number = repeats[name] + 1
        while f"{name}_{number}" in taken:
            number += 1
        repeats[name] = number
        taken.add(f"{name}_{number}")
        out.append(f"{name}_{number}")
    return out


def clean_headers(headers: Sequence[str]) -> list[str]:
    """Plain, unique column names for the raw headers of one edition."""
    return suffix_twins([h if h == POSITION else clean_header(h) for h in headers])


def mapping_step(pairs: Mapping[str, str] | Iterable[tuple[str, str]]) -> Step:
    """One set of renames, applied all at once, so the order of its entries cannot matter.

    Names are brought to match-key form. An entry that renames a column to itself, a source
    with two targets, and a cycle are rejected.
    """
    items = pairs.items() if isinstance(pairs, Mapping) else pairs
    step: Step = {}
    for source, target in items:
        old, new = match_key(source), match_key(target)
        if old == new:
            raise ValueError(f"mapping renames {old!r} to itself")
        if step.get(old, new) != new:
            raise ValueError(f"mapping gives {old!r} two targets")
        step[old] = new
    for start in step:
        seen, name = {start}, step[start]
        while name in step:
            if name in seen:
                raise ValueError(f"mapping has a cycle through {name!r}")
            seen.add(name)
            name = step[name]
    return step


def inverted(pairs: Mapping[str, str]) -> Step:
    """The step that undoes ``pairs``."""
    return mapping_step([(target, source) for source, target in pairs.items()])


def steps_for(rows: Iterable[tuple[str, int, str, str]], edition: str) -> list[Step]:
    """Ordered steps of one edition from mapping rows ``(edition, step, source, target)``."""
    by_step: dict[int, list[tuple[str, str]]] = {}
    for row_edition, step, source, target in rows:
        if str(row_edition) == str(edition):
            by_step.setdefault(int(step), []).append((source, target))
    return [mapping_step(by_step[number]) for number in sorted(by_step)]


def keep_positions(names: Sequence[tuple[int, str]], keep: str = "last") -> list[tuple[int, str]]:
    """One ``(position, name)`` per name: the first or the last of each set of twins."""
    if keep not in ("first", "last"):
        raise ValueError("keep is 'first' or 'last'")
    chosen: dict[str, int] = {}
    for position, name in names:
        if keep == "last" or name not in chosen:
            chosen[name] = position
    return sorted((position, name) for name, position in chosen.items())


def resolve(names: Sequence[str], steps: Sequence[Step], keep: str = "last") -> list[tuple[int, str]]:
    """Columns left after every step, as ``(original position, final name)``.

    Twins that a step creates are reduced before the next step runs.
    """
    slots = keep_positions(list(enumerate(names)), keep)
    for step in steps:
        slots = keep_positions([(position, step.get(name, name)) for position, name in slots], keep)
    return slots


@dataclass(frozen=True)
class Origin:
    """Where a raw column of an edition went: its last rename, and its final name unless a twin took its place."""

    position: int
    header: str
    clean: str
    name: str | None
    step: int


def trace(headers: Sequence[str], steps: Sequence[Step], keep: str = "last") -> list[Origin]:
    """What ``clean_headers`` and ``resolve`` make of every raw column; steps count from 1, 0 is the cleaning.

    A column that a twin replaced has no name, and the step after which it went.
    """
    clean = clean_headers(headers)
    names: dict[int, str | None] = dict(enumerate(clean))
    changed = dict.fromkeys(names, 0)
    slots = list(enumerate(clean))
    for number, step in enumerate([{}, *steps]):
        renamed = [(position, step.get(name, name)) for position, name in slots]
        left = dict(keep_positions(renamed, keep))
        for (position, before), (_, after) in zip(slots, renamed):
            if position not in left:
                names[position], changed[position] = None, number
            elif after != before:
                names[position], changed[position] = after, number
        slots = sorted(left.items())
    return [Origin(i, header, clean[i], names[i], changed[i]) for i, header in enumerate(headers)]


def repeated_names(names: Sequence[str]) -> list[str]:
    """Names that occur more than once."""
    seen: set[str] = set()
    repeats: dict[str, None] = {}
    for name in names:
        if name in seen:
            repeats[name] = None
        seen.add(name)
    return list(repeats)


def pick_columns(available: Sequence[str], wanted: Sequence[str]) -> list[str]:
    """Available columns that the wanted list names, in the wanted order, each once."""
    by_key = {match_key(name): name for name in available}
    found = (by_key.get(match_key(name)) for name in wanted)
    return list(dict.fromkeys(name for name in found if name is not None))


def common_names(schemas: Sequence[Sequence[str]], lead: Sequence[str] = ()) -> list[str]:
    """Columns every schema has, in the order of the first, with ``lead`` in front."""
    others = [set(names) for names in schemas[1:]]
    shared = [name for name in schemas[0] if all(name in other for other in others)]
    return [n for n in lead if n in shared] + [n for n in shared if n not in lead]


def diff_names(base: Sequence[str], other: Sequence[str]) -> dict[str, list[str]]:
    """Matched, missing and new columns of ``other`` against ``base``."""
    return {
        "matched": [n for n in base if n in set(other)],
        "missing": [n for n in base if n not in set(other)],
        "new": [n for n in other if n not in set(base)],
    }


def names_with(names: Sequence[str], words: Sequence[str]) -> list[str]:
    """Names that contain any of the words, ignoring case."""
    return [n for n in names if any(w.lower() in n.lower() for w in words)]
