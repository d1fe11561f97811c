"""License detection by ordered signature rules.

A rule is a regex over the lower-cased text, with a label, a rank and a keyword: one word that
every match of the rule holds. The keyword prefilter comes first: one pass finds which keywords a
text holds at all, and only rules with their keyword present run, so most texts run none. A keyword
is a single word because whatever stands between words may be a line break or a comment mark. Rules are written by hand as a list of licenses and
a list of the forms in which a license is named (title, notice, identifier, address, grant); every
pair of them is one rule. Overlapping detections are resolved in order: a stronger form goes
before a weaker one, a longer match before a shorter one, and a detection that lies within a
stronger one's interval is suppressed.

The base phrases are rules too. They are counted at all places, and their labels always stay.

Words are runs of ASCII letters and digits and of all characters beyond ASCII, in the text with
A to Z lower-cased. Defined results: a null or empty text has no words and no labels, a score
of 0, and null places. Repeated rows give repeated rows; null document ids stay null. An empty
table gives no rows. Only the two named columns are read.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from branchyard.llm.common import column, lower_ascii, python_tasks, texts_of, word_spans

IN_WORD = np.zeros(256, bool)
IN_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
WORD = rb"0-9a-z\x80-\xff"
GAP = rb"[^" + WORD + rb"]+"

#: Phrase and label of the base rules.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Label, keywords, names and versions of licenses. A version "" is a name without one.
#: The keyword of a name is the first of the keywords that is a word of it.
LICENSES = (
    ("mit", "mit expat", ("mit", "expat"), ("",)),
    ("apache", "apache asl", ("apache", "apache software", "asl"), ("", "1.0", "1.1", "2.0")),
    ("gpl", "general", ("gnu general public", "general public"), ("", "1", "2", "3")),
    ("gpl", "gpl", ("gnu gpl", "gpl"), ("", "1", "2", "3")),
    ("lgpl", "lesser", ("gnu lesser general public", "lesser general public"), ("", "2.1", "3")),
    ("lgpl", "lgpl", ("gnu lgpl", "lgpl"), ("", "2.0", "2.1", "3")),
    ("agpl", "affero", ("gnu affero general public", "affero general public"), ("", "1", "3")),
    ("agpl", "agpl", ("gnu agpl", "agpl"), ("", "3")),
    ("bsd", "bsd", ("bsd", "new bsd", "modified bsd", "simplified bsd", "bsd 2 clause", "bsd 3 clause", "bsd 4 clause"), ("",)),
    ("mpl", "mozilla", ("mozilla public",), ("", "1.0", "1.1", "2.0")),
    ("mpl", "mpl", ("mpl",), ("", "1.1", "2.0")),
    ("epl", "eclipse", ("eclipse public",), ("", "1.0", "2.0")),
    ("cddl", "development", ("common development and distribution",), ("", "1.0", "1.1")),
    ("isc", "isc", ("isc",), ("",)),
    ("zlib", "zlib", ("zlib", "zlib libpng"), ("",)),
    ("boost", "boost", ("boost software",), ("", "1.0")),
    ("artistic", "artistic", ("artistic",), ("", "1.0", "2.0")),
    ("cc-by", "attribution", ("creative commons attribution",), ("", "2.0", "3.0", "4.0")),
    ("cc-by-sa", "sharealike", ("creative commons attribution sharealike",), ("", "3.0", "4.0")),
    ("cc0", "cc0", ("cc0",), ("", "1.0")),
    ("unlicense", "unlicense", ("unlicense",), ("",)),
    ("wtfpl", "wtfpl", ("wtfpl",), ("",)),
    ("python", "python psf", ("python software foundation", "psf"), ("", "2.0")),
    ("ofl", "sil", ("sil open font",), ("", "1.1")),
    ("eupl", "european", ("european union public",), ("", "1.1", "1.2")),
)

#: How a license is named, as a pattern with {name} and {version}, and its strength.
FORMS = (
    (r"licensed under (?:the )?(?:terms of )?(?:the )?{name}(?: public)?(?: licen[cs]e)?{version}", 1.0),
    (r"(?:released|distributed|available|published|provided) under (?:the )?(?:terms of )?(?:the )?{name}(?: licen[cs]e)?{version}", 0.95),
    (r"spdx license identifier {name}{version}", 0.95),
    (r"(?:the )?{name} licen[cs]e{version}", 0.8),
    (r"licen[cs]e {name}{version}", 0.7),
)

#: The signatures that do not follow a form: label, keyword, words, strength.
NOTICES = (
    ("mit", "hereby", "permission is hereby granted free of charge to any person obtaining a copy", 1.0),
    ("apache", "apache", "apache org licenses license 2 0", 0.95),
    ("bsd", "redistribution", "redistribution and use in source and binary forms", 0.9),
    ("gpl", "foundation", "published by the free software foundation", 0.8),
    ("gpl", "gpl", "gnu org licenses gpl", 0.9),
    ("lgpl", "lgpl", "gnu org licenses lgpl", 0.9),
    ("agpl", "agpl", "gnu org licenses agpl", 0.9),
    ("isc", "permission", "permission to use copy modify and or distribute this software for any purpose", 0.9),
    ("cc-by", "creativecommons", "creativecommons org licenses by", 0.9),
    ("cc-by-sa", "creativecommons", "creativecommons org licenses by sa", 0.95),
    ("cc0", "creativecommons", "creativecommons org publicdomain zero", 0.9),
    ("unlicense", "domain", "released into the public domain", 0.8),
    ("boost", "boost", "boost org license", 0.9),
    ("mpl", "mozilla", "mozilla org mpl", 0.9),
)


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: bytes
    pattern: re.Pattern
    strength: float
    base: bool = False


def signature(words: str) -> re.Pattern:
    """A pattern over bytes in which a space is any run of what is no word."""
    body = words.encode().replace(b" ", GAP)
    return re.compile(rb"(?<![" + WORD + rb"])" + body + rb"(?![" + WORD + rb"])")


def _version(version: str) -> str:
    if not version:
        return ""
    number = version.replace(".", "(?: |[.])") if "." in version else version + "(?:[.]0)?"
    return rf"(?: version| v)?(?: |v| v){number}(?: only| or later)?"


@lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    """All rules, the strongest first; base rules are marked."""
    out = [Rule(label, phrase.split()[0].encode(), signature(phrase), 0.75, True) for phrase, label in BASE]
    for label, keywords, names, versions in LICENSES:
        for name in names:
            keyword = next(word for word in keywords.split() if word in name.split())
            for version in versions:
                for form, strength in FORMS:
                    words = form.format(name=name, version=_version(version))
                    out.append(Rule(label, keyword.encode(), signature(words), strength + 0.01 * bool(version) * (strength < 1)))
    out += [Rule(label, keyword.encode(), signature(words), strength) for label, keyword, words, strength in NOTICES]
    return tuple(sorted(out, key=lambda rule: -rule.strength))


@lru_cache(maxsize=1)
def prefilter() -> tuple:
    """An automaton over all keywords, and the rules of each keyword."""
    by_keyword: dict[str, list[int]] = {}
    for k, rule in enumerate(rules()):
        by_keyword.setdefault(rule.keyword.decode(), []).append(k)
    automaton = ahocorasick.Automaton()
    for keyword, numbers in by_keyword.items():
        automaton.add_word(keyword, numbers)
    automaton.make_automaton()
    return automaton


def detections(text: str) -> list[tuple[int, int, Rule]]:
    """(start, end, rule) by byte of the lower-cased text: what is left when weaker ones within stronger ones go.

    Base detections are all kept.
    """
    present = {k for _, numbers in prefilter().iter(text) for k in numbers}
    return resolved(text.encode(), [rules()[k] for k in sorted(present)]) if present else []


def resolved(data: bytes, tried: list[Rule] | tuple[Rule, ...]) -> list[tuple[int, int, Rule]]:
    """The detections of some rules, in the order of rules(), without the weaker ones within stronger ones."""
    found = []
    for rule in tried:
        found += [(m.start(), m.end(), rule) for m in rule.pattern.finditer(data)]
    found.sort(key=lambda d: (-d[2].strength, d[0] - d[1], d[0]))
    kept: list[tuple[int, int, Rule]] = []
    # the detections so far that no other one holds: starts and ends both grow
    starts: list[int] = []
    ends: list[int] = []
    for start, end, rule in found:
        at = bisect_right(starts, start)
        held = at > 0 and ends[at - 1] >= end
        if rule.base or not held:
            kept.append((start, end, rule))
        if not held:
            low, high = bisect_left(starts, start), bisect_right(ends, end)
            starts[low:high], ends[low:high] = [start], [end]
    return kept


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for data in texts_of(batch):
            low = lower_ascii(data)
            starts, _ = word_spans(low, IN_WORD)
            found = detections(low.tobytes().decode())
            # base phrases have no repeated words, so their matches cannot overlap and finditer finds all
            base = np.searchsorted(starts, sorted(s for s, _, rule in found if rule.base))
            base_labels = {rule.label for _, _, rule in found if rule.base}
            rows.append(
                {
                    "n_words": len(starts),
                    "n_base": len(base),
                    "first_word": int(base[0]) if len(base) else None,
                    "last_word": int(base[-1]) if len(base) else None,
                    "base_labels": ",".join(sorted(base_labels)),
                    "labels": ",".join(sorted({rule.label for _, _, rule in found})),
                    "score": max((rule.strength for _, _, rule in found), default=0.0),
                    "spans": [{"label": rule.label, "start": s, "end": e, "score": rule.strength} for s, e, rule in sorted(found, key=lambda d: d[:2])],
                }
            )
        made = pa.Table.from_pylist(rows, ROWS).to_batches()
        for part in made:
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), *part.columns], names=["doc_id", *part.schema.names])


ROWS = pa.schema(
    [
        ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
        ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
        ("spans", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))),
    ]
)


def license_scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts and places of the base phrases, labels, a score and all detections.

    ``n_base`` counts the places of base phrases, ``first_word`` and ``last_word`` are the words
    (from 0) at which the first and last begin. ``spans`` holds every detection that stays, by
    byte of the text. ``score`` is the strength of the strongest one.
    """
    python_tasks(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label string, start long, end long, score double>>"
    return rows.mapInArrow(_scanned, schema)
