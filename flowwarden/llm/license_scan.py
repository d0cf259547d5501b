"""License scanning by ordered signature rules.

Rules are regular expressions over a text's words (lower-cased, joined by one space), built from
license families, their versions and the forms in which they are named, and hand-written signatures of license
bodies.  A rule runs only where its keyword occurs, which every match of the rule has.  Every rule has a priority; a detection that lies within another of higher or equal
priority, or within a longer one of the same license family, is suppressed.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from flowwarden.llm.text import Words, batch_rows, fresh, letters_and_digits, lower_table

# The base phrases and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# License families: label, name in words, short names, versions.
FAMILIES = (
    ("agpl", "gnu affero general public license", ("agpl",), ("1.0", "3.0")),
    ("lgpl", "gnu (?:lesser|library) general public license", ("lgpl",), ("2.0", "2.1", "3.0")),
    ("gpl", "gnu general public license", ("gpl", "gnu gpl"), ("1.0", "2.0", "3.0")),
    ("apache", "apache(?: software)? license", ("apache",), ("1.0", "1.1", "2.0")),
    ("mpl", "mozilla public license", ("mpl",), ("1.0", "1.1", "2.0")),
    ("epl", "eclipse public license", ("epl",), ("1.0", "2.0")),
    ("cddl", "common development and distribution license", ("cddl",), ("1.0", "1.1")),
    ("eupl", "european union public licen[cs]e", ("eupl",), ("1.0", "1.1", "1.2")),
    ("osl", "open software license", ("osl",), ("1.0", "2.0", "2.1", "3.0")),
    ("afl", "academic free license", ("afl",), ("1.1", "1.2", "2.0", "2.1", "3.0")),
    ("artistic", "artistic license", ("artistic",), ("1.0", "2.0")),
    ("ofl", "(?:sil )?open font license", ("ofl",), ("1.0", "1.1")),
    ("bsl", "boost software license", ("bsl",), ("1.0",)),
    ("gfdl", "gnu free documentation license", ("gfdl",), ("1.1", "1.2", "1.3")),
    ("cpl", "common public license", ("cpl",), ("1.0",)),
    ("zpl", "zope public license", ("zpl",), ("1.1", "2.0", "2.1")),
    ("odbl", "open (?:data commons open )?database license", ("odbl",), ("1.0",)),
    ("php", "php license", ("php",), ("3.0", "3.01")),
    ("cc-by-nc-nd", "creative commons attribution non ?commercial no ?deriv(?:ative)?s", ("cc by nc nd",), ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nc-sa", "creative commons attribution non ?commercial share ?alike", ("cc by nc sa",), ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nc", "creative commons attribution non ?commercial", ("cc by nc",), ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nd", "creative commons attribution no ?deriv(?:ative)?s", ("cc by nd",), ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by-sa", "creative commons attribution share ?alike", ("cc by sa",), ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by", "creative commons attribution", ("cc by",), ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("mit", "mit license", ("mit",), ()),
    ("isc", "isc license", ("isc",), ()),
    ("bsd-2-clause", "(?:simplified bsd|bsd 2 clause|2 clause bsd) license", ("bsd 2 clause",), ()),
    ("bsd-3-clause", "(?:(?:new|revised|modified) bsd|bsd 3 clause|3 clause bsd) license", ("bsd 3 clause",), ()),
    ("bsd", "bsd license", ("bsd",), ()),
    ("zlib", "zlib(?: libpng)? license", ("zlib",), ()),
    ("unlicense", "the unlicense", ("unlicense",), ()),
    ("cc0", "creative commons zero", ("cc0",), ("1.0",)),
    ("postgresql", "postgresql licen[cs]e", ("postgresql",), ()),
    ("python", "python software foundation license", ("psf", "python"), ("2.0",)),
    ("openssl", "openssl license", ("openssl",), ()),
)

#: Further names of a family.
NAMES = (("cc0", "cc0 license"),)

# Phrases of license bodies and notices: label, family, phrase.
BODIES = (
    ("mit", "mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("bsl-1.0", "bsl", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("isc", "isc", "distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("bsd", "bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd-3-clause", "bsd-3-clause", "may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("apache-2.0", "apache", "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license"),
    ("apache-2.0", "apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("gpl-1.0", "gpl", "the license agreements of most software companies try to keep users at the mercy of those companies"),
    ("gpl-2.0", "gpl", "by contrast the gnu general public license is intended to guarantee your freedom to share and change free software"),
    ("gpl-3.0", "gpl", "the gnu general public license is a free copyleft license for software and other kinds of works"),
    ("agpl-3.0", "agpl", "the gnu affero general public license is a free copyleft license for software and other kinds of works"),
    ("lgpl-2.1", "lgpl", "this is the first released version of the lesser gpl it also counts as the successor of the gnu library public license"),
    ("lgpl-3.0", "lgpl", "this version of the gnu lesser general public license incorporates the terms and conditions of version 3 of the gnu general public license"),
    ("mpl-2.0", "mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-1.1", "mpl", "the contents of this file are subject to the mozilla public license version 1 1"),
    ("epl", "epl", "the accompanying program is provided under the terms of this eclipse public license"),
    ("ofl-1.1", "ofl", "the goals of the open font license ofl are to stimulate worldwide development of collaborative font projects"),
    ("zlib", "zlib", "in no event will the authors be held liable for any damages arising from the use of this software"),
    ("unlicense", "unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc0-1.0", "cc0", "the laws of most jurisdictions throughout the world automatically confer exclusive copyright and related rights"),
    ("cc0-1.0", "cc0", "the person who associated a work with this deed has dedicated the work to the public domain"),
    ("postgresql", "postgresql", "distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("python-2.0", "python", "this license agreement is between the python software foundation psf and the individual or organization"),
    ("openssl", "openssl", "this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("php", "php", "this product includes php software freely available from"),
    ("artistic-1.0", "artistic", "the intent of this document is to state the conditions under which a package may be copied"),
)

#: Score of the forms, from a bare name to a machine-readable identifier.
NAMED, VERSIONED, GRANTED, BODY, IDENTIFIED = 0.6, 0.75, 0.9, 0.95, 1.0
BASE_SCORE = 0.5


@dataclass(frozen=True)
class Rule:
    label: str
    family: str
    keyword: str
    priority: int
    score: float
    pattern: re.Pattern


def build_rules() -> list[Rule]:
    """For each family and version: identifier, grant, versioned name; for each family: grant and bare name; and the bodies.

    Each short name, and each name, has rules of its own, so that the keyword is in every match: the name's longest
    plain word, or the short name's first.  More exact forms have higher priority.
    """
    out = []

    def rule(label: str, family: str, keyword: str, priority: int, score: float, pattern: str) -> None:
        out.append(Rule(label, family, keyword, priority, score, re.compile(rf"(?<![^ ])(?:{pattern})(?![^ ])")))

    later = "(?: or (?:any )?later(?: version)?| only)?"
    grant = "(?:(?:re)?licen[cs]ed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?"
    for family, first, shorts, versions in FAMILIES:
        names = [first, *(n for f, n in NAMES if f == family)]
        plain = [max(re.findall(r"[a-z0-9]{3,}", re.sub(r"\((?:[^()]|\([^()]*\))*\)\??|\[[a-z]+\]", " ", n)), key=len) for n in names]
        for version in (*versions, None):
            words = version.replace(".", " ") if version else ""
            if version and version.endswith(".0"):
                words = words[:-2] + "(?: 0)?"
            number = f"(?: licen[cs]e)?(?: version| v)? {words}(?! \\d){later}" if version else ""
            glued = ""
            if version:
                number = f"{number}|(?: licen[cs]e)? v{words}(?! \\d){later}"
                glued = f"(?:{number}|v{words}(?! \\d){later})"
                number = f"(?:{number})"
            label = f"{family}-{version}" if version else family
            more = 1 if version else 0
            for name, word in zip(names, plain, strict=True):
                rule(label, family, word, 6 + more, GRANTED, f"{grant}(?:{name}){number}")
                if version:
                    rule(label, family, word, 4, VERSIONED, f"(?:{name}){number}")
            for short in shorts:
                word = short.split(" ")[0]
                rule(label, family, "spdx", 8 + more, IDENTIFIED, f"spdx license identifier {short}{glued}")
                if version:
                    rule(label, family, word, 3, VERSIONED, f"{short}{glued}")
                rule(label, family, word, 5 + more, GRANTED, f"{grant}{short}{glued}")
        for name, word in zip(names, plain, strict=True):
            rule(family, family, word, 2, NAMED, f"(?:{name})")
        if " " in shorts[0]:
            rule(family, family, shorts[0].split(" ")[0], 1, NAMED, shorts[0])
    for label, family, phrase in BODIES:
        rule(label, family, phrase, 8, BODY, phrase)
    return sorted(out, key=lambda r: -r.priority)


#: Words joined by one space that have none of these, and no phrase of a body, have no detection.
GATE = re.compile(
    b"licen[cs]|spdx|creative commons|(?<![^ \n])(?:"
    + b"|".join(sorted({s.split(" ")[0].encode() for _, _, shorts, _ in FAMILIES for s in shorts}))
    + b")(?:v[0-9]+)?(?![^ \n])"
)
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def maybe(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> list[int]:
    """Rows of lower-cased texts whose words, joined by one space, have what the gate or a body asks for."""
    data = np.insert(data, offsets[:-1], 10)
    row_start = offsets[:-1] + np.arange(len(offsets) - 1)
    inside = table[data]
    keep = inside.copy()
    keep[1:] |= inside[:-1]  # one byte after each word
    keep[row_start] = True
    line = np.where(inside, data, 32).astype(np.uint8)
    line[row_start] = 10  # no match runs over the end of a row
    first = (np.cumsum(keep) - 1)[row_start]
    raw = line[keep].tobytes()
    at = [m.start() for m in GATE.finditer(raw)]
    for _, _, phrase in BODIES:
        want = phrase.encode()
        place = raw.find(want)
        while place >= 0:
            at.append(place)
            place = raw.find(want, place + 1)
    return np.unique(np.searchsorted(first, np.array(at, np.int64), "right") - 1).tolist()


class Scanner:
    def __init__(self, rules: list[Rule] | None = None):
        self.by_keyword: dict[str, list[Rule]] = {}
        for r in rules or build_rules():
            self.by_keyword.setdefault(r.keyword, []).append(r)

    def scan(self, lowered: bytes) -> tuple[list[tuple[int, str]], list[tuple[int, int, str, float]]]:
        """Base places (word, label), and detections (first word, word after the last, label, score)."""
        line = " " + " ".join(w.decode("utf-8", "replace") for w in WORD.findall(lowered)) + " "
        gaps = [m.start() for m in re.finditer(" ", line)]  # a word's place is the number of spaces before it, less one
        base = []
        for phrase, label in PHRASES:
            at = line.find(f" {phrase} ")
            while at >= 0:
                base.append((bisect_left(gaps, at), label))
                at = line.find(f" {phrase} ", at + 1)
        found = []
        for keyword, rules in self.by_keyword.items():
            if keyword in line:
                found += [(m.start(), m.end(), r) for r in rules for m in r.pattern.finditer(line)]
        # Higher priority first, then longer, then earlier: what lies within a kept one is suppressed.
        found.sort(key=lambda f: (-f[2].priority, f[0] - f[1], f[0], f[2].label))
        kept: list[tuple[int, int, int, Rule]] = []  # in order of start; the third number only breaks ties
        longest = 0
        for place, (a, b, r) in enumerate(found):
            around = kept[bisect_left(kept, (a - longest,)) : bisect_left(kept, (a + 1,))]
            if any(x <= a and b <= y for x, y, *_ in around):
                continue
            within = kept[bisect_left(kept, (a,)) : bisect_left(kept, (b,))]
            for k in within:  # shorter, of higher priority, of the same family
                if k[1] <= b and k[3].family == r.family and b - a > k[1] - k[0]:
                    del kept[bisect_left(kept, k[:3])]
            insort(kept, (a, b, place, r))
            longest = max(longest, b - a)
        spans = [(bisect_left(gaps, a) - 1, bisect_left(gaps, b), r.label, r.score) for a, b, _, r in kept]
        return sorted(base), spans


SPAN = "array<struct<first_word:bigint,end_word:bigint,label:string,score:double>>"


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds `n_words`, `n_base`, `first_word`, `last_word`, `base_labels`, `labels`, `score` and `detections` to every row.

    Words are runs of 0-9, a-z and characters beyond ASCII after A-Z are lower-cased.  `n_base` counts all places of
    the base phrases; `first_word` and `last_word` are their smallest and largest start, or null.
    `labels` are those of the base phrases and of the detections, distinct and sorted; `score` is
    the best of both, 0 without any.  A null or empty text has no words and no labels.  Repeated rows stay, an
    empty table gives an empty one; added names that are taken get an underscore.
    """
    kinds = T.StructType.fromDDL(
        f"n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, detections {SPAN}"
    )
    names = [fresh(docs, f.name) for f in kinds]
    schema = T.StructType([*docs.schema.fields, *[T.StructField(n, f.dataType) for n, f in zip(names, kinds, strict=True)]])
    place = docs.columns.index(text)
    span = pa.list_(pa.struct([("first_word", pa.int64()), ("end_word", pa.int64()), ("label", pa.string()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, table, lower = Scanner(), letters_and_digits(), lower_table()
        for batch in batches:
            counts = np.zeros(batch.num_rows, np.int64)
            rows: dict[int, tuple] = {}
            for a, _, data, offsets in batch_rows(batch, batch.schema.names[place]):
                data = lower[data]
                words = Words(data, offsets, table)
                counts[a : a + len(offsets) - 1] = np.diff(words.first)
                for row in maybe(data, offsets, table):
                    rows[a + row] = scanner.scan(data[offsets[row] : offsets[row + 1]].tobytes())
            out = []
            for i in range(batch.num_rows):
                base, spans = rows.get(i, ((), ()))
                own = sorted({label for _, label in base})
                labels = sorted({*own, *(s[2] for s in spans)})
                score = max([BASE_SCORE * bool(base), *(s[3] for s in spans)])
                out.append((len(base), base[0][0] if base else None, base[-1][0] if base else None, ",".join(own), ",".join(labels), score, spans))
            columns = [pa.array(counts)] + [
                pa.array([o[i] for o in out], t)
                for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64()))
            ]
            detections = [[dict(zip(("first_word", "end_word", "label", "score"), s, strict=True)) for s in o[6]] for o in out]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns, pa.array(detections, span)], names=schema.names)

    return docs.mapInArrow(run, schema)
