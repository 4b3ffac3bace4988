"""License scans: ordered signature rules with a keyword prefilter.

Rules are made from a table of licences and a list of forms (identifier, link,
grant, name with version, name); others are words of a licence's own text or of
its notice header. A rule is tried only on texts that hold its
keyword. Detections are ordered by priority, then length, then place; one whose
span lies inside an accepted span is dropped. Base phrases are counted on words
and always stay.

Defined cases: a null or empty text has no words, no places, score 0. Repeated
rows are scanned alike. An empty table gives an empty one.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shoptrail.llm import words as W
from shoptrail.llm.tables import text_rows

# Phrases and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# Label, names (regular expressions), versions, keyword, address.
LICENSES = (
    ("gpl", ("gnu general public licen[sc]e", "gnu gpl", "gpl"), ("1.0", "2.0", "3.0"), ("gnu general", "gpl"), "gnu.org/licenses/gpl"),
    ("lgpl", ("gnu lesser general public licen[sc]e", "gnu library general public licen[sc]e", "lgpl"), ("2.0", "2.1", "3.0"), ("lesser general", "library general", "lgpl"), "gnu.org/licenses/lgpl"),
    ("agpl", ("gnu affero general public licen[sc]e", "agpl"), ("1.0", "3.0"), ("affero", "agpl"), "gnu.org/licenses/agpl"),
    ("gfdl", ("gnu free documentation licen[sc]e", "gfdl"), ("1.1", "1.2", "1.3"), ("free documentation", "gfdl"), "gnu.org/licenses/fdl"),
    ("apache", ("apache software licen[sc]e", "apache licen[sc]e"), ("1.0", "1.1", "2.0"), ("apache",), "apache.org/licenses/license"),
    ("mit", ("mit/x11 licen[sc]e", "mit licen[sc]e", "expat licen[sc]e"), (), ("mit", "expat"), "opensource.org/licenses/mit"),
    ("bsd-2-clause", ("simplified bsd licen[sc]e", "bsd 2[- ]clause licen[sc]e", "freebsd licen[sc]e"), (), ("bsd",), "opensource.org/licenses/bsd-2-clause"),
    ("bsd-3-clause", ("new bsd licen[sc]e", "modified bsd licen[sc]e", "bsd 3[- ]clause licen[sc]e"), (), ("bsd",), "opensource.org/licenses/bsd-3-clause"),
    ("bsd", ("bsd licen[sc]e", "bsd-style licen[sc]e"), (), ("bsd",), "opensource.org/licenses/bsd-license"),
    ("mpl", ("mozilla public licen[sc]e", "mpl"), ("1.0", "1.1", "2.0"), ("mozilla", "mpl"), "mozilla.org/mpl"),
    ("epl", ("eclipse public licen[sc]e", "epl"), ("1.0", "2.0"), ("eclipse", "epl"), "eclipse.org/legal/epl"),
    ("cddl", ("common development and distribution licen[sc]e", "cddl"), ("1.0", "1.1"), ("common development", "cddl"), "opensource.org/licenses/cddl"),
    ("cpl", ("common public licen[sc]e",), ("1.0",), ("common public",), "opensource.org/licenses/cpl"),
    ("eupl", ("european union public licen[sc]e", "eupl"), ("1.0", "1.1", "1.2"), ("european union", "eupl"), "eupl.eu"),
    ("artistic", ("artistic licen[sc]e",), ("1.0", "2.0"), ("artistic",), "perlfoundation.org/artistic"),
    ("bsl", ("boost software licen[sc]e",), ("1.0",), ("boost",), "boost.org/license"),
    ("isc", ("isc licen[sc]e",), (), ("isc",), "opensource.org/licenses/isc"),
    ("zlib", ("zlib/libpng licen[sc]e", "zlib licen[sc]e"), (), ("zlib",), "zlib.net/zlib_license"),
    ("unlicense", ("the unlicen[sc]e",), (), ("unlicen",), "unlicense.org"),
    ("wtfpl", ("wtfpl", "do what the fuck you want to public licen[sc]e"), ("2.0",), ("wtfpl", "do what the"), "wtfpl.net"),
    ("psf", ("python software foundation licen[sc]e", "psf licen[sc]e"), ("2.0",), ("python software", "psf"), "docs.python.org/3/license"),
    ("php", ("php licen[sc]e",), ("3.0", "3.01"), ("php",), "php.net/license"),
    ("ofl", ("sil open font licen[sc]e", "open font licen[sc]e"), ("1.0", "1.1"), ("open font",), "scripts.sil.org/ofl"),
    ("odbl", ("open database licen[sc]e", "odbl"), ("1.0",), ("open database", "odbl"), "opendatacommons.org/licenses/odbl"),
    ("odc-by", ("open data commons attribution licen[sc]e",), ("1.0",), ("open data commons",), "opendatacommons.org/licenses/by"),
    ("pddl", ("public domain dedication and licen[sc]e", "pddl"), ("1.0",), ("public domain", "pddl"), "opendatacommons.org/licenses/pddl"),
    ("cc0", ("creative commons zero", "cc0", "cc zero"), ("1.0",), ("creative commons", "cc0", "cc zero"), "creativecommons.org/publicdomain/zero"),
    ("cc-by-nc-nd", ("creative commons attribution[- ]noncommercial[- ]noderiv(?:ative)?s", "cc[- ]by[- ]nc[- ]nd"), ("2.0", "2.5", "3.0", "4.0"), ("creative commons", "cc by", "cc-by"), "creativecommons.org/licenses/by-nc-nd"),
    ("cc-by-nc-sa", ("creative commons attribution[- ]noncommercial[- ]sharealike", "cc[- ]by[- ]nc[- ]sa"), ("2.0", "2.5", "3.0", "4.0"), ("creative commons", "cc by", "cc-by"), "creativecommons.org/licenses/by-nc-sa"),
    ("cc-by-nc", ("creative commons attribution[- ]noncommercial", "cc[- ]by[- ]nc"), ("2.0", "2.5", "3.0", "4.0"), ("creative commons", "cc by", "cc-by"), "creativecommons.org/licenses/by-nc/"),
    ("cc-by-nd", ("creative commons attribution[- ]noderiv(?:ative)?s", "cc[- ]by[- ]nd"), ("2.0", "2.5", "3.0", "4.0"), ("creative commons", "cc by", "cc-by"), "creativecommons.org/licenses/by-nd/"),
    ("cc-by-sa", ("creative commons attribution[- ]sharealike", "cc[- ]by[- ]sa"), ("2.0", "2.5", "3.0", "4.0"), ("creative commons", "cc by", "cc-by"), "creativecommons.org/licenses/by-sa"),
    ("cc-by", ("creative commons attribution", "cc[- ]by"), ("2.0", "2.5", "3.0", "4.0"), ("creative commons", "cc by", "cc-by"), "creativecommons.org/licenses/by/"),
)
# Statements that name no licence: label, pattern, keyword, confidence.
STATEMENTS = (
    ("all-rights-reserved", r"all rights reserved", "rights reserved", 0.5),
    ("proprietary", r"proprietary and confidential", "proprietary", 0.8),
    ("proprietary", r"unauthori[sz]ed (?:copying|reproduction|distribution)", "unauthori", 0.7),
    ("public-domain", r"(?:released|placed|dedicated|is) (?:in|into|to) the public domain", "public domain", 0.8),
    ("copyright-notice", r"copyright (?:\(c\) |\xc2\xa9 )?\d{4}", "copyright", 0.4),
    ("non-commercial", r"for non-?commercial use only", "commercial use", 0.6),
)
# A licence's own words, which need not name it: label, words (regular expressions) with any gap between them, keyword, confidence.
BODIES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "hereby", 0.95),
    ("bsl", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this licen[sc]e", "hereby", 0.95),
    ("isc", "permission to use copy modify and(?:/or)? distribute this software for any purpose with or without fee is hereby granted", "hereby", 0.9),
    ("postgresql", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted", "hereby", 0.95),
    ("hpnd", "permission to use copy modify distribute and sell this software and its documentation for any purpose is hereby granted", "hereby", 0.9),
    ("bsd", "redistributions? and use in source and binary forms with or without modification(?:s)? are permitted", "redistribution", 0.9),
    ("bsd-2-clause", "materials provided with the distribution this software is provided by", "redistribution", 0.9),
    ("bsd-3-clause", "names? of its contributors may be used to endorse or promote products derived from this software", "endorse", 0.9),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment", "advertising", 0.95),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages", "authors", 0.9),
    ("zlib", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software", "altered", 0.95),
    ("apache", "you may not use this file except in compliance with the licen[sc]e", "compliance", 0.85),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the licen[sc]e is distributed on an as is basis", "applicable", 0.85),
    ("mpl-2.0", "if a copy of the mpl was not distributed with this file you can obtain one at", "mpl", 0.95),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered", 0.95),
    ("wtfpl", "you just do what the fuck you want to", "fuck", 0.9),
    ("ofl", "neither the font software nor any of its individual components in original or modified versions may be sold by itself", "font", 0.95),
    ("artistic", "the intent of this document is to state the conditions under which a package may be copied", "intent", 0.9),
    ("psf", "psf is making python available to licensee", "licensee", 0.95),
    ("json", "the software shall be used for good not evil", "evil", 0.95),
    ("beerware", "as long as you retain this notice you can do whatever you want with this stuff", "retain", 0.95),
    ("openssl", "this product includes software developed by the openssl project", "openssl", 0.9),
    ("cc0", "waive(?:s|d)? all copyright and related", "waive", 0.8),
)
# Notices that tell the version after the publisher: label, name, versions, keyword.
NOTICES = (
    ("gpl", "gnu general public licen[sc]e", ("1", "2", "3"), "general"),
    ("lgpl", "gnu l(?:esser|ibrary) general public licen[sc]e", ("2", "2.1", "3"), "general"),
    ("agpl", "gnu affero general public licen[sc]e", ("1", "3"), "affero"),
)
_WORD, _GAP = rb"[0-9a-z\x80-\xff]", rb"[^0-9a-z\x80-\xff]"


@dataclass(frozen=True)
class Signature:
    label: str
    keywords: tuple[bytes, ...]
    pattern: re.Pattern[bytes]
    priority: int
    confidence: float


def _compiled(text: str) -> re.Pattern[bytes]:
    body = text.encode("latin-1").replace(b"[- ]", rb"[-\s]+").replace(b" ?", rb"\s*").replace(b" ", rb"\s+")
    return re.compile(rb"(?<!" + _WORD + rb")(?:" + body + rb")(?!" + _WORD + rb")")


def _spread(text: str) -> re.Pattern[bytes]:
    """Words with any punctuation, line break or comment mark between them."""
    body = (_GAP + rb"+").join(w.encode() for w in text.split(" "))
    return re.compile(rb"(?<!" + _WORD + rb")" + body + rb"(?!" + _WORD + rb")")


def signatures() -> list[Signature]:
    """All rules, the most telling form of a licence first."""
    out = []
    for label, names, versions, keys, address in LICENSES:
        keywords = tuple(k.encode() for k in keys)
        out.append(Signature(label, (address.encode(),), re.compile(re.escape(address.encode())), 90, 0.95))
        name = "|".join(names)
        for version in versions:
            exact, short = f"{label}-{version}", re.escape(version).replace(r"\.0", r"(?:\.0)?")
            out.append(Signature(exact, (b"spdx",), _compiled(rf"spdx-license-identifier: ?{re.escape(label)}-{short}(?:-only|-or-later|\+)?"), 100, 1.0))
            numbered = rf"(?:{name})(?:,)?(?: |-)(?:version |v\.? ?)?{short}"
            out.append(Signature(exact, keywords, _compiled(rf"(?:licensed|released|distributed|available|published|covered) (?:under|by) (?:the )?(?:terms of (?:the )?)?{numbered}"), 80, 0.95))
            out.append(Signature(exact, keywords, _compiled(numbered), 70, 0.9))
        out.append(Signature(label, (b"spdx",), _compiled(rf"spdx-license-identifier: ?{re.escape(label)}"), 95, 1.0))
        out.append(Signature(label, keywords, _compiled(rf"(?:licensed|released|distributed|available|published|covered) (?:under|by) (?:the )?(?:terms of (?:the )?)?(?:{name})"), 60, 0.85))
        # Bare names: a short one says nothing without the word licence beside it.
        out += [Signature(label, keywords, _compiled(n if "licen" in n or " " in n else rf"{n} licen[sc]e"), 50, 0.7) for n in names]
    out += [Signature(label, (key.encode(),), _spread(words), 65, sure) for label, words, key, sure in BODIES]
    for label, name, versions, key in NOTICES:
        for version in versions:
            words = rf"{name} as published by the free software foundation(?:[^0-9a-z]+either)? version {re.escape(version)}(?!\.[1-9])"
            out.append(Signature(f"{label}-{version if '.' in version else version + '.0'}", (key.encode(),), _spread(words), 75, 0.95))
    out += [Signature(label, (key.encode(),), _compiled(pattern), 30, sure) for label, pattern, key, sure in STATEMENTS]
    return out


def _base_pattern(phrase: str) -> re.Pattern[bytes]:
    body = (_GAP + rb"+").join(w.encode() for w in phrase.split())
    return re.compile(rb"(?<!" + _WORD + rb")" + body + rb"(?!" + _WORD + rb")")


class Scanner:
    """Rules compiled once per task."""

    def __init__(self) -> None:
        self.rules = signatures()
        self.by_keyword: dict[bytes, list[int]] = {}
        for i, rule in enumerate(self.rules):
            for key in rule.keywords:
                self.by_keyword.setdefault(key, []).append(i)
        self.base = [(p.split()[0].encode(), p.split()[-1].encode(), _base_pattern(p), label) for p, label in BASE.items()]

    def detections(self, text: bytes) -> list[tuple[int, int, str, float]]:
        """Accepted (start, end, label, confidence) of a lower-cased text, in order of place."""
        gated = sorted({i for key, rules in self.by_keyword.items() if key in text for i in rules})
        found = [(-self.rules[i].priority, m.start() - m.end(), m.start(), i, m.end()) for i in gated for m in self.rules[i].pattern.finditer(text)]
        accepted: list[tuple[int, int, str, float]] = []
        # The accepted spans that no other one contains, in order: both their starts and their ends rise.
        starts: list[int] = []
        ends: list[int] = []
        for _, _, start, i, end in sorted(found):
            before = bisect_right(starts, start)
            if before and ends[before - 1] >= end:
                continue
            accepted.append((start, end, self.rules[i].label, self.rules[i].confidence))
            low = high = bisect_left(starts, start)
            while high < len(ends) and ends[high] <= end:
                high += 1
            starts[low:high], ends[low:high] = [start], [end]
        return sorted(accepted)

    def base_places(self, text: bytes) -> list[tuple[int, str]]:
        """Where base phrases begin, with their labels."""
        return [(m.start(), label) for first, last, pattern, label in self.base if first in text and last in text for m in pattern.finditer(text)]


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scanner = Scanner()
    for piece in W.chunks(batches):
        w = W.split(piece["text"], W.ALNUM, lower=True, hashed=False)
        low, rows = w.data.tobytes(), []
        for k in range(piece.num_rows):
            a, b = int(w.offsets[k]), int(w.offsets[k + 1])
            text = low[a:b]
            places = scanner.base_places(text)
            at = np.searchsorted(w.starts, [a + p for p, _ in places]) - w.first[k] if places else []
            spans = scanner.detections(text)
            base = sorted({label for _, label in places})
            score = 1.0 - float(np.prod([1.0 - c for *_, c in spans])) if spans else 0.0
            rows.append((
                len(places), int(min(at)) if places else None, int(max(at)) if places else None, ",".join(base),
                ",".join(sorted({*base, *(s[2] for s in spans)})), max(score, 0.6 if places else 0.0),
                [{"start": s[0], "end": s[1], "label": s[2], "confidence": s[3]} for s in spans],
            ))
        names = SCHEMA_NAMES[2:]
        columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(_TYPES)]
        yield pa.RecordBatch.from_arrays([piece["doc_id"], pa.array(w.counts, pa.int64()), *columns], ["doc_id", "n_words", *names])


_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("label", pa.string()), ("confidence", pa.float64())])
_TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(_SPAN))
SCHEMA_NAMES = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")
SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string,"
    " score double, spans array<struct<start:int,end:int,label:string,confidence:double>>"
)


def scan(docs: DataFrame) -> DataFrame:
    """Each document's detections: spans are byte ranges of the lower-cased text."""
    return text_rows(docs).mapInArrow(_batches, SCHEMA)
